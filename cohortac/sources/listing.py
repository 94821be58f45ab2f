"""Listing of folders in tasks: the driver holds the folders that were named, not the files in them.

Folders are listed through ``pyarrow.fs`` (like the block reader's files); a local one streams, of others a
task holds the entries of one folder at a time.
"""

from __future__ import annotations

import os
import stat
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortac.session import reliable_checkpoint
from cohortac.sources.bgzf import _open

ENTRIES = "path string, name string, length long, folder boolean, below int, pattern string"
BATCH = 10_000  # entries that a task hands out at a time
FOLDERS_A_TASK = 4  # of each core's share
_GLOB = "*?[{\\"
# A folder that is a file in parts.
_IN_PARTS = (".vcf", ".vcf.gz", ".vcf.bgz")


def hidden(name: str) -> bool:
    """Names that Spark's own listing leaves out."""
    out = name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)
    return out and not name.startswith(("_common_metadata", "_metadata"))


def _entries(folder: str) -> Iterator[tuple[str, int, bool]]:
    """(name, length, is a folder) of what lies in ``folder``."""
    import pyarrow.fs as pafs

    fs, at = _open(folder)
    if isinstance(fs, pafs.LocalFileSystem):
        with os.scandir(at) as found:
            for entry in found:
                try:
                    about = entry.stat()
                except FileNotFoundError:  # a broken link, or gone meanwhile
                    continue
                yield os.fsencode(entry.name).decode("utf-8", "replace"), about.st_size, stat.S_ISDIR(about.st_mode)
        return
    for entry in fs.get_file_info(pafs.FileSelector(at)):
        yield entry.base_name, entry.size or 0, entry.type == pafs.FileType.Directory


def _listed(folders: DataFrame, tasks: int) -> DataFrame:
    """``ENTRIES`` of ``folders`` (path, pattern); a folder in there that is a file in parts is listed as well."""

    def look(path: str, pattern: str | None, below: int) -> Iterator[tuple]:
        for name, length, folder in _entries(path):
            if hidden(name) and not (folder and pattern):  # a folder that a pattern matches is listed whatever its name
                continue
            full = f"{path.rstrip('/')}/{name}"
            yield full, name, length, folder, below, pattern
            if folder and below == 1 and pattern is None and name.endswith(_IN_PARTS):
                yield from look(full, pattern, 2)

    def batches(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["path", "name", "length", "folder", "below", "pattern"]
        held: list[tuple] = []
        for batch in rows:
            for path, pattern in zip(batch["path"], batch["pattern"]):
                for entry in look(path, pattern, 1):
                    held.append(entry)
                    if len(held) >= BATCH:
                        yield pd.DataFrame(held, columns=columns)
                        held = []
        if held:
            yield pd.DataFrame(held, columns=columns)

    return folders.select("path", "pattern").repartition(tasks, "path").mapInPandas(batches, ENTRIES)


def _reached(fs, path: str) -> bool:
    """Whether tasks can list this store (Hadoop knows more of them)."""
    if fs.getUri().getScheme() == "file":
        return True
    import pyarrow.fs as pafs

    try:
        store, at = _open(path)
        return store.get_file_info(at).type == pafs.FileType.Directory
    except Exception:  # no such store, or no way to it
        return False


def files_below(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[str]]:
    """(path, length, below) of the files that ``paths`` name (below 0) or that lie one or two folders below, hidden and empty
    ones left out; and the paths, qualified, that cannot be listed in tasks or do not exist. Of a glob
    pattern the driver expands all but the last part, which tasks match."""
    conf, hadoop = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs
    others: list[str] = []
    named: list[tuple] = []
    folders: list[tuple] = []
    globs: dict[str, tuple[str, str]] = {}  # by the whole path: the last part's pattern
    for p in paths:
        hp = hadoop.Path(str(p))
        fs = hp.getFileSystem(conf)
        hp = fs.makeQualified(hp)
        whole, last, parent = hp.toString(), hp.getName(), hp.getParent()
        if not any(c in hp.toUri().getPath() for c in _GLOB):
            if not fs.exists(hp):
                others.append(whole)
                continue
            status = fs.getFileStatus(hp)
            if not status.isDirectory():
                if not hidden(last):
                    named.append((whole, last, status.getLen(), False, 0, None))
            elif _reached(fs, whole):
                folders.append((whole, None))
            else:
                others.append(whole)
            continue
        regex = None if any(c in "{}\\" for c in whole) or parent is None else hadoop.GlobPattern(last).compiled().pattern()
        above = [] if regex is None else [s.getPath().toString() for s in fs.globStatus(parent) or [] if s.isDirectory()]
        if not above or not all(_reached(fs, a) for a in above):
            others.append(whole)
            continue
        globs[whole] = regex
        folders += [(a, whole) for a in above]
    tasks = FOLDERS_A_TASK * spark.sparkContext.defaultParallelism
    files = spark.createDataFrame(named, ENTRIES)
    inside = spark.createDataFrame([f for f in folders if f[1] is None], "path string, pattern string")
    if globs:
        regexes = spark.createDataFrame([(k, f"^(?:{v})\\z") for k, v in globs.items()], "pattern string, regex string")
        above = spark.createDataFrame([f for f in folders if f[1] is not None], "path string, pattern string")
        matches = _listed(above, min(len(folders), tasks)).join(F.broadcast(regexes), "pattern").where(F.expr("name RLIKE regex"))
        matches = reliable_checkpoint(matches.drop("regex"))
        found = {r.pattern for r in matches.select("pattern").distinct().collect()}
        others += [g for g in globs if g not in found]
        files = files.unionByName(matches.where("NOT folder").withColumn("below", F.lit(0)))
        inside = inside.unionByName(matches.where("folder").select("path", F.lit(None).cast("string").alias("pattern")))
    below = _listed(inside.distinct(), max(1, min(inside.count(), tasks)))
    files = files.unionByName(below.where("NOT folder"))
    return files.where("length > 0").select("path", "length", "below"), others
