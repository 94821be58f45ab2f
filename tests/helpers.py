"""Small builders for literal genotype rows and VCF files used by the tests."""

from __future__ import annotations

import gzip
import struct
import textwrap
import zlib

SF001 = "/root/testdata/sf0.001"

GENO_DDL = (
    "file string, sample_rank int, sample string, contig string, pos int, end int, ref string, "
    "alts array<string>, gt array<int>, dp int, gq int, ad array<int>"
)


def geno(spark, rows):
    """rows: dicts with any of the genotype fields; defaults fill the rest."""
    base = dict(file="f.vcf.gz", sample_rank=0, sample="S0", contig="chr1", pos=100, end=None, ref="A",
                alts=["C", "G"], gt=[0, 1], dp=30, gq=50, ad=[15, 15, 0])
    out = []
    for r in rows:
        d = dict(base, **r)
        if d["end"] is None:
            d["end"] = d["pos"]
        out.append(tuple(d[k] for k in ["file", "sample_rank", "sample", "contig", "pos", "end", "ref", "alts",
                                         "gt", "dp", "gq", "ad"]))
    return spark.createDataFrame(out, GENO_DDL)


def vcf_text(body: str, samples: list[str], contigs: list[str]) -> str:
    """A VCF document from whitespace-separated body lines (no spaces inside fields)."""
    head = ["##fileformat=VCFv4.2"] + [f"##contig=<ID={c}>" for c in contigs]
    head.append("\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"] + samples))
    lines = ["\t".join(ln.split()) for ln in textwrap.dedent(body).splitlines() if ln.strip()]
    return "\n".join(head + lines) + "\n"


def write_multimember_gzip(path, text: str, members: int = 3) -> None:
    data = text.encode()
    step = max(1, len(data) // members)
    with open(path, "wb") as f:
        for i in range(0, len(data), step):
            f.write(gzip.compress(data[i : i + step]))


def _bgzf_block(payload: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    cdata = c.compress(payload) + c.flush()
    bsize = 12 + 6 + len(cdata) + 8 - 1
    header = b"\x1f\x8b\x08\x04" + b"\x00\x00\x00\x00" + b"\x00\xff" + struct.pack("<H", 6)
    extra = b"BC" + struct.pack("<H", 2) + struct.pack("<H", bsize)
    trailer = struct.pack("<I", zlib.crc32(payload) & 0xFFFFFFFF) + struct.pack("<I", len(payload))
    return header + extra + cdata + trailer


def write_bgzf(path, text: str, block_payload: int = 200) -> None:
    """BGZF file with small blocks (so a small split size cuts lines across blocks)."""
    data = text.encode()
    with open(path, "wb") as f:
        for i in range(0, len(data), block_payload):
            f.write(_bgzf_block(data[i : i + block_payload]))
        f.write(_bgzf_block(b""))
