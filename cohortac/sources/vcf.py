"""Text VCF as DataFrames: lines -> sites -> genotype calls, header samples, contigs and types.

Plain ``.vcf`` files and plain gzip (which does not split anyway) are read with Spark's text source.
BGZF files, told by their first bytes, go through the ``vcf_bgzf`` Python data source, which splits
them at block boundaries; those of one split are read as gzip too. Everything after the line read is
built-in column expressions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortac.constants import SUPPORTED_EXTENSIONS
from cohortac.session import broadcast_if_bounded, ensure_parallelism, reliable_checkpoint
from cohortac.functions.genotype import gt_text, parse_float_as_int, parse_gt, parse_int, parse_int_list

_EXT_ALTERNATION = "|".join(e.replace(".", r"\.") for e in SUPPORTED_EXTENSIONS)
_EXT_REGEX = f"({_EXT_ALTERNATION})$"
# A part of a file that is a directory.
_PART = r"^(.*\.vcf(?:\.gz|\.bgz)?)/[^/]*$"

OPEN_COST = "spark.sql.files.openCostInBytes"
LISTED_FILE_BYTES = 1 << 16  # what a listed file counts for when files are packed into tasks


# ---------------------------------------------------------------- input files
def is_supported_name(name) -> Column:
    """File name ends with one of the accepted extensions."""
    n = F.col(name) if isinstance(name, str) else name
    return n.rlike(_EXT_REGEX)


def file_label(name) -> Column:
    """Dataset label of a file: its name without a known extension, else the name unchanged."""
    n = F.col(name) if isinstance(name, str) else name
    base = F.regexp_extract(n, r"([^/]*)$", 1)
    return F.regexp_replace(base, _EXT_REGEX, "")


def input_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, length) of the inputs, each once: a directory gives its direct children with an accepted
    extension, a file is taken as is, a glob pattern is expanded and each match treated the same way.

    A directory with the name of a VCF file (as Spark writes one) is one file in parts, whatever the names of
    the parts; a directory of such directories gives all of them.

    Folders are listed by tasks and the listing is written once, so the driver holds no row per file. Empty
    files and hidden ones (``.`` or ``_`` first) are not listed. A store that only Hadoop knows, and a
    pattern with ``{}``, goes through Spark's file index, which holds its files on the driver.
    """
    from cohortac.sources.listing import files_below

    listed, others = files_below(spark, paths)
    found = listed.where(_is_input(F.col("below"))).select("path", "length")
    if others:
        found = found.unionByName(indexed_files(spark, others))
    before = spark.conf.get(OPEN_COST)
    spark.conf.set(OPEN_COST, str(LISTED_FILE_BYTES))
    try:
        return reliable_checkpoint(found.distinct())
    finally:
        spark.conf.set(OPEN_COST, before)


def _is_input(below: Column) -> Column:
    """Whether ``path``, so many folders below a named or matched one, is an input."""
    in_parts = F.col("path").rlike(_PART)
    return (below == 0) | ((below == 1) & (is_supported_name("path") | in_parts)) | ((below == 2) & in_parts)


def indexed_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, length) of the inputs by a scan that reads no content. Paths of one depth are listed
    together: what lies at their own depth was named (or matched) itself, what lies one deeper is a directory's child."""
    conf = spark._jsc.hadoopConfiguration()
    depths: dict[int, list[str]] = {}
    for p in paths:
        hp = spark._jvm.org.apache.hadoop.fs.Path(str(p))
        name = hp.getFileSystem(conf).makeQualified(hp).toString()
        depths.setdefault(name.count("/"), []).append(name)
    found = None
    for depth, names in sorted(depths.items()):
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(names).select("path", "length")
        below = F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit(""))) - depth
        taken = listed.where(_is_input(below))
        found = taken if found is None else found.unionByName(taken)
    return spark.createDataFrame([], "path string, length long") if found is None else found


def select_input_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths of ``input_files``, for readers that take a list (Spark's file index holds it on the
    driver as well)."""
    return [r.path for r in input_files(spark, paths).orderBy("path").toLocalIterator()]


def read_vcf_lines(spark: SparkSession, paths: list[str], expand: bool = True, contigs: list[str] | None = None, split_bytes: int | None = None) -> DataFrame:
    """All lines of the given VCF files as (file, value); file is the full path (of a file in parts the
    directory's). With ``contigs`` only
    header lines and the records of those contigs, dropped as early as the source allows."""
    from cohortac.sources.bgzf import DEFAULT_SPLIT_BYTES, register, sniffed

    split_bytes = split_bytes or DEFAULT_SPLIT_BYTES
    if expand:
        files = input_files(spark, paths)
    else:
        files = spark.createDataFrame([(str(p), None) for p in paths], "path string, length long")
    zipped = F.col("path").endswith(".gz")
    named = [(r.path, r.length, r.path.endswith(".bgz")) for r in files.where(~zipped).toLocalIterator()]
    sniff = sniffed(files.where(zipped))
    text, blocks = [], []
    for path, length, bgzf in sorted(named + sniff, key=lambda f: f[0]):
        if path.endswith(".bcf"):
            raise ValueError("BCF is binary; convert it to VCF text (bcftools view) before reading")
        # A BGZF file that would be one split gains nothing from the block reader (a .bgz name hides it from Spark).
        small = length is not None and length <= split_bytes and path.endswith(".gz")
        (blocks if bgzf and not small else text).append(path)
    parts = []
    if text:
        lines = spark.read.text(text).select(F.col("_metadata.file_path").alias("file"), F.col("value"))
        own = F.when(F.col("value").startswith("#"), F.lit("")).otherwise(F.substring_index("value", "\t", 1))
        parts.append(lines if contigs is None else lines.where(own.isin("", *contigs)))
    if blocks:
        register(spark)
        lines = spark.read.format("vcf_bgzf").option("paths", "\n".join(blocks)).option("splitBytes", str(split_bytes)).load()
        parts.append((lines if contigs is None else lines.where(F.col("contig").isin("", *contigs))).select("file", "value"))
    if not parts:
        return spark.createDataFrame([], "file string, value string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # A few small files, or plain gzip ones (which do not split), would leave most cores idle.
    return ensure_parallelism(out.withColumn("file", F.regexp_replace("file", _PART, "$1")))


# ---------------------------------------------------------------- header
def header_samples(lines: DataFrame) -> DataFrame:
    """(file, sample_rank, sample) from each file's '#CHROM' line, in column order."""
    h = lines.where(F.col("value").startswith("#CHROM")).select("file", F.split("value", "\t").alias("f"))
    return h.select(
        "file", F.posexplode(F.when(F.size("f") > 9, F.slice("f", 10, F.size("f") - 9)).otherwise(F.array()))
    ).select("file", F.col("pos").cast("int").alias("sample_rank"), F.col("col").alias("sample"))


def header_contigs(lines: DataFrame) -> DataFrame:
    """(file, contig) for every '##contig=<ID=...>' header line."""
    return lines.where(F.col("value").startswith("##contig=")).select(
        "file", F.regexp_extract("value", r"ID=([^,>]+)", 1).alias("contig")
    )


def header_float_keys(lines: DataFrame) -> DataFrame:
    """(file, float_keys): the FORMAT keys that a file's header declares as Float."""
    declared = lines.where(F.col("value").startswith("##FORMAT=")).select(
        "file", F.regexp_extract("value", r"[<,]ID=([^,>]+)", 1).alias("key"), F.regexp_extract("value", r"[<,]Type=([^,>]+)", 1).alias("type")
    )
    return declared.where(F.col("type") == "Float").groupBy("file").agg(F.array_sort(F.collect_set("key")).alias("float_keys"))


def with_float_keys(sites: DataFrame, float_keys: DataFrame) -> DataFrame:
    """Sites with their file's Float FORMAT keys (one small row per file, counted before it is broadcast)."""
    return sites.join(broadcast_if_bounded(float_keys), "file", "left")


# ---------------------------------------------------------------- records
def site_columns(fields: Column) -> list[tuple[str, Column]]:
    """(contig, pos, end, ref, alts, format, calls) from a data line split on tabs.

    ``end`` is INFO/END when present and not before pos, else pos + len(ref) - 1 (the extent). An ALT
    of '.' gives an empty list. ``calls`` holds the raw sample columns in header order.
    """
    f = fields
    pos = parse_int(F.get(f, 1))
    ref = F.get(f, 3)
    alt_txt = F.get(f, 4)
    info_end = parse_int(F.regexp_extract(F.get(f, 7), r"(?:^|;)END=([0-9]+)(?:;|$)", 1))
    return [
        ("contig", F.get(f, 0)),
        ("pos", pos),
        ("end", F.coalesce(F.when(info_end >= pos, info_end), pos + F.length(ref) - 1).cast("int")),
        ("ref", ref),
        ("alts", F.when(alt_txt.isNull() | (alt_txt == "."), F.array().cast("array<string>")).otherwise(F.split(alt_txt, ","))),
        ("format", F.split(F.get(f, 8), ":")),
        ("calls", F.when(F.size(f) > 9, F.slice(f, 10, F.size(f) - 9)).otherwise(F.array().cast("array<string>"))),
    ]


def parse_sites(lines: DataFrame) -> DataFrame:
    """Data lines -> (file, contig, pos, end, ref, alts, format, calls)."""
    d = lines.where(~F.col("value").startswith("#") & (F.length("value") > 0)).select(
        "file", F.split("value", "\t").alias("f")
    )
    return d.select("file", *[c.alias(n) for n, c in site_columns(F.col("f"))])


FORMAT_KEYS = ("GT", "DP", "GQ", "AD")


def explode_samples(sites: DataFrame) -> DataFrame:
    """One row per (record, sample column): adds sample_rank and the raw ``call`` text. The places
    of the FORMAT keys are found once per record. Sites with ``sexes`` (one per sample column)
    give each call its ``sex``."""
    drop = ("calls", "sexes")
    cols = [c for c in sites.columns if c not in drop]
    places = [F.array_position("format", k).cast("int").alias(f"_i{k}") for k in FORMAT_KEYS]
    if "sexes" not in sites.columns:
        exploded = sites.select(*cols, *places, F.posexplode("calls").alias("sample_rank", "call"))
        return exploded.withColumn("sample_rank", F.col("sample_rank").cast("int"))
    both = sites.select(*cols, *places, F.posexplode(F.arrays_zip("calls", "sexes")).alias("sample_rank", "_c"))
    return both.select(
        *cols, *[f"_i{k}" for k in FORMAT_KEYS], F.col("sample_rank").cast("int"), F.col("_c.calls").alias("call"), F.col("_c.sexes").alias("sex")
    ).where(F.col("call").isNotNull() & F.col("sex").isNotNull())


def call_fields(exploded: DataFrame) -> DataFrame:
    """FORMAT look-ups of GT, DP, GQ, AD as raw text (NULL when absent or '.'); each call is split once."""
    cols = [c for c in exploded.columns if c not in [f"_i{k}" for k in FORMAT_KEYS]]
    parts = exploded.withColumn("_v", F.split("call", ":"))

    def field(k: str) -> Column:
        raw = F.when(F.col(f"_i{k}") > 0, F.get(F.col("_v"), F.col(f"_i{k}") - 1))
        return F.when(raw != ".", raw).alias(f"{k.lower()}_text")

    return parts.select(*cols, *map(field, FORMAT_KEYS))


def sites_to_genotypes(sites: DataFrame) -> DataFrame:
    """Parsed records -> genotype calls (file, sample_rank, contig, pos, end, ref, alts, gt, dp, gq, ad),
    with ``region`` and ``sex`` when the sites have regions and sexes.

    GT alleles beyond the ALT list become missing; DP/GQ/AD are parsed tolerantly. Keys in the
    sites' ``float_keys`` (declared Float in the file's header) are truncated to integers.
    """
    calls = call_fields(explode_samples(sites))

    def number(key: str) -> Column:
        text = F.col(f"{key.lower()}_text")
        if "float_keys" not in sites.columns:
            return parse_int(text)
        is_float = F.coalesce(F.array_contains("float_keys", key), F.lit(False))
        return F.when(is_float, parse_float_as_int(text)).otherwise(parse_int(text))

    return calls.select(
        *[c for c in ("region", "sex") if c in calls.columns],
        "file",
        "sample_rank",
        "contig",
        "pos",
        "end",
        "ref",
        "alts",
        parse_gt("gt_text", F.size("alts")).alias("gt"),
        number("DP").alias("dp"),
        number("GQ").alias("gq"),
        parse_int_list("ad_text").alias("ad"),
    )


def read_vcf_genotypes(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(genotypes, header samples, header contigs) of a set of VCF files."""
    lines = read_vcf_lines(spark, paths)
    sites = with_float_keys(parse_sites(lines), header_float_keys(lines))
    return sites_to_genotypes(sites), header_samples(lines), header_contigs(lines)


# ---------------------------------------------------------------- writer (fixtures, round trips)
def call_text(gt="gt", dp="dp", gq="gq", ad="ad", phased=None) -> Column:
    """GT:DP:GQ:AD text of a call, '.' for missing values."""
    g = gt_text(gt)
    if phased is not None:
        g = F.when(F.col(phased), F.regexp_replace(g, "/", "|")).otherwise(g)
    depths = F.coalesce(F.array_join(F.col(ad).cast("array<string>"), ",", "."), F.lit("."))
    ad_txt = F.when(depths.contains("."), F.lit(".")).otherwise(depths)
    return F.concat_ws(
        ":",
        g,
        F.coalesce(F.col(dp).cast("string"), F.lit(".")),
        F.coalesce(F.col(gq).cast("string"), F.lit(".")),
        ad_txt,
    )


COPY_CHUNK = 1 << 16
SPOT_CALLS = 1 << 20  # calls of a file at one position that one task may assemble
PART_CALLS = 500_000  # calls that a task assembles into lines, about
LINE_BYTES = 4 << 20  # text that it hands out at a time, about
CELL_BYTES = 16  # of a sample column in it, about


SITE = ["file", "contig", "pos", "end", "ref", "alts"]


def to_vcf_lines(genotypes: DataFrame, samples: DataFrame | None = None, in_order: bool = False) -> DataFrame:
    """Format genotype calls as multi-sample VCF text lines (file, value), headers included; with
    ``in_order`` partitioned and sorted as they stand in a file (``in_file_order``).

    ``samples`` gives each file's (sample_rank, sample) columns (default: those named in the calls). A sample without a call
    at a record gets './.'; a sample with several calls at one record spreads them over
    repeated lines (copy k of every sample goes to line k). INFO carries END only for gVCF
    blocks.

    Calls are written once with their text, range-partitioned by position and sorted, and lines are
    assembled from rows that follow each other. Only if some position has more than ``SPOT_CALLS`` calls
    they are counted by text instead, and copies are expanded in chunks that are spread over tasks before the per-line
    assembly: a record repeated a huge number of times never sits in one task.
    """
    has_phase = "phased" in genotypes.columns
    named = ["sample"] if samples is None else []
    calls = reliable_checkpoint(genotypes.select(*SITE, "sample_rank", *named, call_text(phased="phased" if has_phase else None).alias("call")))
    # What the header needs: a row per file, contig and sample.
    seen = reliable_checkpoint(calls.select("file", "contig", "sample_rank", *named).distinct())
    if samples is None:
        samples = seen.select("file", "sample_rank", "sample").distinct()
    spots = calls.groupBy("file", "contig", "pos").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    spread = (spots["most"] or 0) > SPOT_CALLS
    width = broadcast_if_bounded(samples.groupBy("file").agg(F.max("sample_rank").alias("max_rank")))  # one row per file, counted first
    info = F.when(F.get(F.col("alts"), 0) == "<NON_REF>", F.concat(F.lit("END="), F.col("end").cast("string"))).otherwise(
        F.lit(".")
    )
    fixed = F.concat_ws(
        "\t",
        F.col("contig"),
        F.col("pos").cast("string"),
        F.lit("."),
        F.col("ref"),
        F.when(F.size("alts") == 0, F.lit(".")).otherwise(F.array_join("alts", ",")),
        F.lit("."),
        F.lit("."),
        info,
        F.lit("GT:DP:GQ:AD"),
    )
    if spread:
        counted = reliable_checkpoint(calls.groupBy(*SITE, "sample_rank", "call").agg(F.count(F.lit(1)).alias("_c")))
        body = _lines_by_chunks(counted, width, fixed)
    else:
        body = _lines_in_place(calls, width, fixed, max(calls.sparkSession.sparkContext.defaultParallelism, -(-(spots["all"] or 0) // PART_CALLS)))
    names = samples.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("sample_rank", "sample"))).alias("s"))
    chrom = names.select(
        "file",
        F.concat(
            F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"),
            F.array_join(F.transform("s", lambda x: x["sample"]), "\t"),
        ).alias("value"),
    )
    contigs = seen.select("file", "contig").distinct().select(
        "file", F.concat(F.lit("##contig=<ID="), F.col("contig"), F.lit(">")).alias("value")
    )
    fmt = names.select("file", F.lit("##fileformat=VCFv4.2").alias("value"))
    headers = fmt.unionByName(contigs).unionByName(chrom)
    if not in_order:
        return headers.unionByName(body)
    if spread:
        return in_file_order(headers.unionByName(body))
    # The parts of a union come one after the other: headers, then the position ranges.
    return in_file_order(headers).unionByName(body)


def _lines_by_chunks(counted: DataFrame, width: DataFrame, fixed: Column) -> DataFrame:
    """(file, value) of the records in counted calls; any number of copies spreads over tasks."""
    before = Window.partitionBy(*SITE, "sample_rank").orderBy("call").rowsBetween(Window.unboundedPreceding, -1)
    mult = counted.withColumn("_start", F.coalesce(F.sum("_c").over(before), F.lit(0)) + 1)
    chunks = mult.select(
        "*", F.explode(F.sequence(F.lit(0), F.floor((F.col("_c") - 1) / COPY_CHUNK).cast("long"))).alias("_chunk")
    ).repartition(*SITE, "sample_rank", "_chunk")
    lo = F.col("_start") + F.col("_chunk") * COPY_CHUNK
    hi = F.least(F.col("_start") + F.col("_c") - 1, lo + COPY_CHUNK - 1)
    copies = chunks.select(*SITE, "sample_rank", "call", F.explode(F.sequence(lo, hi)).alias("dup"))
    lines = copies.groupBy(*SITE, "dup").agg(F.map_from_entries(F.collect_list(F.struct("sample_rank", "call"))).alias("m")).join(width, "file")
    cols = F.transform(F.sequence(F.lit(0), F.col("max_rank")), lambda i: F.coalesce(F.element_at("m", i), F.lit("./.")))
    return lines.select("file", F.concat_ws("\t", fixed, F.array_join(cols, "\t")).alias("value"))


def _lines_in_place(calls: DataFrame, width: DataFrame, fixed: Column, parts: int) -> DataFrame:
    """(file, value) of the records in the calls, in file order over ``parts`` ranges of positions."""

    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("\x02"))

    alts = F.coalesce(F.array_join("alts", "\x01", "\x02"), F.lit("\x03"))
    dealt = calls.repartitionByRange(parts, "file", "contig", "pos").join(width, "file").where(F.col("sample_rank").between(0, F.col("max_rank")))
    rows = dealt.select("*", F.concat_ws("\t", *map(text, ("contig", "pos", "end", "ref")), alts).alias("_site"), fixed.alias("fixed"))
    rows = rows.sortWithinPartitions("file", "contig", "pos", "_site", "sample_rank", "call")
    return rows.select("file", "_site", "fixed", "max_rank", "sample_rank", "call").mapInArrow(_assembled, "file string, value string")


def _assembled(batches):
    """Lines of sorted calls (file, _site, fixed, max_rank, sample_rank, call): copy k of each sample on line k."""
    import pyarrow as pa

    held = []  # batches that end with the record which the next one may go on with
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        opens = _openings(batch)
        if len(opens) == 1 and _same_record(held[0], batch):
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        last = rows.num_rows - batch.num_rows + int(opens[-1])
        yield from _record_lines(rows.slice(0, last))
        held = rows.slice(last).to_batches()
    if held:
        yield from _record_lines(pa.Table.from_batches(held).combine_chunks())


def _same_record(one, other) -> bool:
    """Whether the last record of ``one`` is the first of ``other``."""
    at = one.num_rows - 1
    return all(one.column(c)[at] == other.column(c)[0] for c in ("_site", "file"))


def _openings(rows) -> np.ndarray:
    """The first row of every record."""
    import pyarrow.compute as pc

    change = np.zeros(rows.num_rows, bool)
    change[:1] = True
    for c in ("_site", "file"):
        values = rows.column(c)
        change[1:] |= pc.not_equal(values.slice(1), values.slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(change)


def _record_lines(rows):
    """(file, value) of whole records, at most about ``LINE_BYTES`` at a time."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if not rows.num_rows:
        return
    rows = rows.to_batches()[0]
    opens, n = _openings(rows), rows.num_rows
    record = np.repeat(np.arange(len(opens)), np.diff(opens, append=n))
    rank = rows.column("sample_rank").to_numpy(zero_copy_only=False).astype(np.int64)
    # The copy that a row is: its place among the calls of its sample in the record.
    first = np.flatnonzero(np.concatenate(([True], (record[1:] != record[:-1]) | (rank[1:] != rank[:-1]))))
    sizes = np.diff(first, append=n)
    copy = np.arange(n) - np.repeat(first, sizes)
    lines = np.maximum.reduceat(copy, opens) + 1  # of each record
    before = np.cumsum(lines) - lines
    widths = rows.column("max_rank").to_numpy(zero_copy_only=False).astype(np.int64)[opens] + 1
    line_record = np.repeat(np.arange(len(opens)), lines)
    ends = np.cumsum(widths[line_record])  # of the lines, in cells
    starts = ends - widths[line_record]
    line = before[record] + copy
    cell = starts[line] + rank
    order = np.argsort(line, kind="stable")
    cell, line = cell[order], line[order]
    calls = pa.concat_arrays([rows.column("call"), pa.array(["./."], rows.column("call").type)])
    at, most = 0, LINE_BYTES // CELL_BYTES
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + most, side="right")))
        a, b = np.searchsorted(line, (at, to))
        source = np.full(ends[to - 1] - starts[at], n)
        source[cell[a:b] - starts[at]] = order[a:b]
        offsets = np.append(starts[at:to], ends[to - 1]) - starts[at]
        cells = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), calls.take(pa.array(source)))
        own = pa.array(opens[line_record[at:to]])
        values = pc.binary_join_element_wise(rows.column("fixed").take(own), pc.binary_join(cells, "\t"), "\t")
        yield pa.RecordBatch.from_arrays([rows.column("file").take(own), values], names=["file", "value"])
        at = to


FILE_ORDER = ["file", "_place", "_contig", "_pos", "value"]


def _places() -> list[Column]:
    v = F.col("value")
    place = F.when(v.startswith("##fileformat"), 0).when(v.startswith("##"), 1).when(v.startswith("#"), 2).otherwise(3)
    fields = F.split(v, "\t", 3)
    return [place.alias("_place"), F.get(fields, 0).alias("_contig"), parse_int(F.get(fields, 1)).alias("_pos")]


def in_file_order(lines: DataFrame) -> DataFrame:
    """(file, value) lines range-partitioned and sorted as they stand in a file: header, then records by contig
    and position. A file spreads over as many tasks as its size asks for."""
    keyed = lines.select("file", "value", *_places())
    return keyed.repartitionByRange(*FILE_ORDER).sortWithinPartitions(*FILE_ORDER).select("file", "value")


def write_vcf_parts(lines: DataFrame, folder: str, in_order: bool = False) -> None:
    """Write (file, value) lines as text, one directory ``file=<name>`` of parts per file; ``in_order`` says that
    they are in file order already."""
    if in_order:
        ordered = lines.withColumn("_n", F.monotonically_increasing_id()).sortWithinPartitions("file", "_n").select("file", "value")
    else:
        ordered = in_file_order(lines)
    ordered.write.partitionBy("file").text(folder)
