"""Language ID by prediction by partial matching (PPM).

Each language has a tree of byte contexts of up to ``ORDER`` bytes with the counts of the
bytes that followed. In a context seen ``n`` times with ``d`` distinct next bytes the escape
probability is ``d / (n + d)``; a byte's probability is its share of the rest plus the escape
probability times its probability in the next shorter context, down to a uniform one over
256 bytes. So the probabilities of all bytes sum to one in every context, and a text's code
length in a language is the exact sum of ``-log2 p`` over its bytes. A context that a tree
lacks uses its longest suffix that the tree has.

The counts are frozen after fitting, so every (context, byte) code length is worked out once
per worker; scoring a text is one look-up per byte and language, over the whole text. The
language with the shortest code wins (ties: the first in order of name); ``score`` is its
posterior probability under equal priors.

Fitting uses a bounded sample: about ``per_language`` distinct labelled texts per language,
picked by a hash of the text. Only text and label are read.

Defined results: a text that is null or has no letter is ``und`` with score 0; if there is
no labelled text to learn from, every text is ``und``. Repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortac.llm.shared import free_name

ORDER = 3
PER_LANGUAGE = 500
UNDECIDED = "und"
_LATIN = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(_LATIN.search(text)) or any(map(str.isalpha, text))


def _padded(text: str) -> np.ndarray:
    return np.frombuffer(b"\0" * ORDER + text.encode("utf-8", "replace"), np.uint8)


def _grams(data: np.ndarray) -> np.ndarray:
    """For each byte after the padding: the byte and the ORDER bytes before it, as one number."""
    n = len(data) - ORDER
    out = np.zeros(n, np.uint32)
    for k in range(ORDER + 1):
        out = out << np.uint32(8) | data[k : k + n]
    return out


def count_grams(rows: pd.DataFrame) -> pd.DataFrame:
    """Counts of all (ORDER + 1)-byte strings in the texts of one language (a bounded sample)."""
    grams, counts = np.unique(np.concatenate([_grams(_padded(t)) for t in rows["text"]]), return_counts=True)
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "grams": [grams.astype("<u4").tobytes()], "counts": [counts.astype("<i8").tobytes()]})


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> dict[str, tuple[bytes, bytes]]:
    """Frozen statistics: language -> its (gram, count) arrays, from about ``per_language``
    distinct texts of each language in ``labelled`` (text, lang)."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    share = 1 << 20
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.countDistinct(F.xxhash64("text")).alias("n")).collect()}  # one row a language
    if not sizes:
        return {}
    keep = F.lit(False)
    for lang, n in sizes.items():
        keep = keep | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("text"), F.lit(share)) < max(1, share * per_language // n)))
    sample = rows.where(keep).dropDuplicates(["lang", "text"])
    found = sample.groupBy("lang").applyInPandas(count_grams, "lang string, grams binary, counts binary").collect()
    return {r["lang"]: (bytes(r["grams"]), bytes(r["counts"])) for r in sorted(found, key=lambda r: r["lang"])}


@dataclass
class Tables:
    """Code lengths of every (context, byte class)."""

    langs: list[str]
    classes: np.ndarray  # byte -> class; all bytes never seen share the last class
    node: np.ndarray  # three byte classes -> context row
    bits: np.ndarray  # context row * n_classes + class -> code length per language

    @classmethod
    def build(cls, stats: dict[str, tuple[bytes, bytes]]) -> Tables:
        langs = list(stats)
        if not langs:
            return cls([], np.zeros(256, np.uint8), np.zeros(1, np.int32), np.zeros((1, 0), np.float32))
        grams = {k: (np.frombuffer(g, "<u4"), np.frombuffer(c, "<i8")) for k, (g, c) in stats.items()}
        seen = np.zeros(256, bool)
        seen[0] = True  # the padding
        for g, _ in grams.values():
            for shift in range(0, 8 * (ORDER + 1), 8):
                seen[np.unique(g >> np.uint32(shift) & np.uint32(255))] = True
        n = int(seen.sum()) + 1
        classes = np.full(256, n - 1, np.uint8)
        classes[seen] = np.arange(n - 1)

        def coded(g: np.ndarray, k: int) -> np.ndarray:
            """The last k bytes of the grams as classes in base n."""
            out = np.zeros(len(g), np.int64)
            for shift in range(8 * (k - 1), -1, -8):
                out = out * n + classes[g >> np.uint32(shift) & np.uint32(255)]
            return out

        # Order 0 has one row; the rows of order k follow those of order k - 1.
        probs = np.full((1, n, len(langs)), 1 / 256)
        for j, (g, c) in enumerate(grams.values()):
            probs[0, :, j] = blend(np.bincount(coded(g, 1), c, n)[None], probs[0, :, j][None])[0]
        rows, start, where = [probs], 0, np.zeros(1, np.int64)
        for k in range(1, ORDER + 1):
            contexts = np.unique(np.concatenate([coded(g, k + 1) // n for g, _ in grams.values()]))
            shorter = where[contexts % n ** (k - 1)]
            flat = np.concatenate(rows)
            here = flat[shorter]
            for j, (g, c) in enumerate(grams.values()):
                cell = coded(g, k + 1)
                at = np.searchsorted(contexts, cell // n) * n + cell % n
                here[:, :, j] = blend(np.bincount(at, c, len(contexts) * n).reshape(len(contexts), n), here[:, :, j])
            start = len(flat)
            rows.append(here)
            longer = np.tile(where, n)  # a context's row if it is known, else its suffix's
            longer[contexts] = start + np.arange(len(contexts))
            where = longer
        bits = -np.log2(np.concatenate(rows)).astype(np.float32)
        return cls(langs, classes, where.astype(np.int32), bits.reshape(-1, len(langs)))

    def code_lengths(self, text: str) -> np.ndarray:
        """Bits of ``text`` in each language."""
        c, n = self.classes[_padded(text)].astype(np.int32), len(self.bits) // self.rows
        size = len(c) - ORDER
        context = np.zeros(size, np.int32)
        for k in range(ORDER):
            context = context * n + c[k : k + size]
        at = self.node[context] * n + c[ORDER:]
        return self.bits[at].sum(axis=0, dtype=np.float64)

    @property
    def rows(self) -> int:
        return len(self.bits) // (int(self.classes.max()) + 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs or not has_letter(text):
            return UNDECIDED, 0.0
        bits = self.code_lengths(text)
        best = int(bits.argmin())
        return self.langs[best], float(1 / np.exp2(bits[best] - bits).sum())


def blend(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Rows of probabilities: counts with the escape probability spread as in ``shorter``. A row
    without counts is the shorter context's."""
    total, distinct = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
    return np.where(total > 0, (counts + distinct * shorter) / np.maximum(total + distinct, 1), shorter)


_tables: dict[int, Tables] = {}


def predict(
    docs: DataFrame, stats: dict[str, tuple[bytes, bytes]], text: str = "text", lang_pred: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``docs`` with the columns named lang_pred and score added (replacing columns of those names). ``stats`` comes from ``fit``; its size is bounded by
    the sample, and it is sent to each worker once."""
    shared = docs.sparkSession.sparkContext.broadcast(stats)
    key = shared._jbroadcast.id()

    @F.pandas_udf("lang_pred string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if key not in _tables:
            _tables.clear()
            _tables[key] = Tables.build(shared.value)
        tables = _tables[key]
        for texts in batches:
            yield pd.DataFrame([tables.predict(t) for t in texts], columns=["lang_pred", "score"])

    found = free_name(docs, "guess")
    return docs.withColumn(found, guess(docs[text])).withColumns({lang_pred: F.col(found)["lang_pred"], score: F.col(found)["score"]}).drop(found)


def is_held_out(doc_id: str = "doc_id", folds: int = 5):
    """Rows that no model may learn from: crc32 of the id as text is divisible by ``folds``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))
