"""Text VCF ingest: plain, multi-member gzip, BGZF split at small sizes."""

import gzip
import os
import random

import pyarrow as pa
import pytest

from cohortac.operators.regions import region_overlap_scan
from cohortac.plans.pipeline import Filters, count_dataset, count_sites
from cohortac.sources import bgzf, vcf
from cohortac.sources.bgzf import _Batches, register, write_bgzf_parts
from cohortac.sources.vcf import (
    header_contigs,
    header_samples,
    in_file_order,
    input_files,
    parse_sites,
    read_vcf_genotypes,
    read_vcf_lines,
    select_input_files,
    sites_to_genotypes,
    write_vcf_parts,
)
from helpers import vcf_text, write_bgzf, write_multimember_gzip

SAMPLES = ["P", "Q", "R"]
# One record or more for each branch of the reader: reference block; AD first and phased calls; three ALTs
# with a spanning deletion; calls beyond the ALT list; END with haploid calls; FORMAT of GT alone; a field
# left off at the end.
BODY = """
chr2  50       .  T     <NON_REF>  .   .  END=95               GT:DP        0/0:33                 0/0:21               ./.:0
chr2  120      .  C     T          .   .  .                    AD:GT:DP:GQ  9,14:0/1:23:88         30,2:0|1:32:61       0,17:1|1:17:20
chr2  133      .  TAAC  T,TA,*     .   .  AF=0.1,0.2,0.1       GT:GQ:DP:AD  1/2:55:40:8,16,16,0    3/1:47:26:0,13,0,13  0/2:12:44:22,0,22,0
chr2  140      .  G     A          60  .  .                    GQ:DP:GT     30:15:0/7              30:16:5/0            30:17:./.
chrX  60000    .  G     A          .   .  .                    GT:DP:GQ     1/1:19                 0/0:20:.             0/1:.:40
chrX  2800000  .  A     <DUP>      .   .  SVTYPE=DUP;END=2800900  GT:DP     0:30                   1:.                  0/1:28
chrX  2900000  .  T     C          .   .  .                    GT           1/1                    0/1                  1|1
"""


def write_all(tmp_path):
    text = vcf_text(BODY, SAMPLES, ["chr2", "chrX"])
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.vcf").write_text(text)
    write_multimember_gzip(d / "b.vcf.gz", text, members=4)
    write_bgzf(d / "c.vcf.bgz", text, block_payload=64)
    (d / "notes.txt").write_text("x")
    return d, text


def test_select_input_files(spark, tmp_path):
    d, _ = write_all(tmp_path)
    got = sorted(os.path.basename(p) for p in select_input_files(spark, [str(d)]))
    assert got == ["b.vcf.gz", "c.vcf.bgz"]  # direct children with an accepted extension only
    got = select_input_files(spark, [str(d / "a.vcf")])
    assert [os.path.basename(p) for p in got] == ["a.vcf"]  # a file path is taken as is
    got = sorted(os.path.basename(p) for p in select_input_files(spark, [str(d / "*.vcf*")]))
    assert got == ["a.vcf", "b.vcf.gz", "c.vcf.bgz"]  # glob matches are taken like explicit files
    got = sorted(os.path.basename(p) for p in select_input_files(spark, [str(tmp_path / "i*")]))
    assert got == ["b.vcf.gz", "c.vcf.bgz"]  # a matched directory gives its accepted children


def test_named_and_listed_files_are_read_once(spark, tmp_path):
    d, _ = write_all(tmp_path)
    (d / "deep").mkdir()
    (d / "deep" / "e.vcf.gz").write_bytes(b"")
    both = [str(d), str(d / "b.vcf.gz"), str(d / "notes.txt"), str(tmp_path / "in" / "*.bgz")]
    got = input_files(spark, both)
    assert sorted((os.path.basename(r.path), r.length) for r in got.collect()) == [
        (n, os.path.getsize(d / n)) for n in ("b.vcf.gz", "c.vcf.bgz", "notes.txt")]
    assert "content" not in got._jdf.queryExecution().executedPlan().toString()


def test_plain_gzip_is_read_without_python(spark, tmp_path):
    """Plain gzip goes to Spark's text source, by its first bytes; BGZF of several splits to the block reader."""
    text = vcf_text(BODY * 30, SAMPLES, ["chr2", "chrX"])
    write_multimember_gzip(tmp_path / "a.vcf.gz", text, members=3)
    write_bgzf(tmp_path / "b.vcf.gz", text, block_payload=90)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    plain = read_vcf_lines(spark, [str(tmp_path / "a.vcf.gz")], split_bytes=1000)
    blocks = read_vcf_lines(spark, [str(tmp_path / "b.vcf.gz")], split_bytes=1000)
    assert "FileScan text" in plan(plain) and "vcf_bgzf" not in plan(plain) and "Python" not in plan(plain)
    assert "vcf_bgzf" in plan(blocks) and "FileScan text" not in plan(blocks)
    assert sorted(r.value for r in plain.collect()) == sorted(r.value for r in blocks.collect())
    many = tmp_path / "many"
    many.mkdir()
    for k in range(bgzf.FEW_FILES + 3):  # so many are looked at by tasks
        (write_bgzf if k % 2 else write_multimember_gzip)(many / f"{k}.vcf.gz", text[:500])
    found = bgzf.sniffed(input_files(spark, [str(many)]))
    assert sorted((int(os.path.basename(p).split(".")[0]), b) for p, _, b in found) == [(k, k % 2 == 1) for k in range(bgzf.FEW_FILES + 3)]


def test_files_in_parts(spark, tmp_path):
    """A file written in parts (text or BGZF) is one file again when it is read, its header in the first part."""
    rng = random.Random(4)
    texts = {}
    for name in ("one.vcf.gz", "two.vcf.bgz"):
        body = "\n".join(f"chr{rng.randint(1, 3)} {rng.randint(1, 9999)} . A C . . . GT:DP 1/1:{k} 0/1:7 ./.:." for k in range(2000))
        texts[name] = vcf_text(body, SAMPLES, ["chr2", "chrX"]).rstrip("\n").split("\n")
    lines = spark.createDataFrame([(f, v) for f, t in texts.items() for v in t], "file string, value string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_vcf_parts(lines, str(tmp_path / "text"))
        paths = sorted(r.path for r in write_bgzf_parts(in_file_order(lines), str(tmp_path / "bgzf"), block=999).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(paths) > 4 and sum("one.vcf.gz" in p for p in paths) > 1  # no task has a whole file
    whole = b"".join(open(p, "rb").read() for p in paths if "one.vcf.gz" in p)
    joined = gzip.decompress(whole).decode().rstrip("\n").split("\n")  # blocks can be joined: the parts are the file
    assert joined[:4] == texts["one.vcf.gz"][:1] + sorted(texts["one.vcf.gz"][1:3]) + texts["one.vcf.gz"][3:4] and sorted(joined) == sorted(texts["one.vcf.gz"])
    for folder in ("text", "bgzf"):
        got = read_vcf_lines(spark, [str(tmp_path / folder)], split_bytes=5000)
        by = {}
        for r in got.collect():
            by.setdefault(os.path.basename(r.file).removeprefix("file="), []).append(r.value)
        assert {f: sorted(v) for f, v in by.items()} == {f: sorted(t) for f, t in texts.items()}
        assert sorted(r.sample_rank for r in header_samples(got).collect()) == [0, 0, 1, 1, 2, 2]
        one = read_vcf_lines(spark, [str(tmp_path / folder / "*one.vcf.gz")])
        assert one.select("file").distinct().count() == 1


def test_all_formats_same_lines(spark, tmp_path):
    d, text = write_all(tmp_path)
    want = sorted(text.rstrip("\n").split("\n"))
    for name in ["a.vcf", "b.vcf.gz", "c.vcf.bgz"]:
        lines = read_vcf_lines(spark, [str(d / name)], expand=False)
        assert sorted(r.value for r in lines.collect()) == want, name


def test_bgzf_split_sizes(spark, tmp_path):
    text = vcf_text(BODY * 40, SAMPLES, ["chr2", "chrX"])
    p = tmp_path / "big.vcf.bgz"
    write_bgzf(p, text, block_payload=97)
    want = sorted(text.rstrip("\n").split("\n"))
    register(spark)
    for split in [50, 333, 1000, 100000]:
        df = spark.read.format("vcf_bgzf").option("path", str(p)).option("splitBytes", str(split)).load()
        got = sorted(r.value for r in df.collect())
        assert got == want, split


def test_parse_sites_and_genotypes(spark, tmp_path):
    d, _ = write_all(tmp_path)
    lines = read_vcf_lines(spark, [str(d / "a.vcf")], expand=False)
    sites = {(r.contig, r.pos): r for r in parse_sites(lines).collect()}
    assert sites[("chr2", 50)].end == 95 and sites[("chrX", 2800000)].end == 2800900  # INFO/END
    assert sites[("chr2", 133)].alts == ["T", "TA", "*"] and sites[("chr2", 133)].end == 136
    g = {(r.pos, r.sample_rank): r for r in sites_to_genotypes(parse_sites(lines)).collect()}
    assert g[(120, 1)].gt == [0, 1] and g[(120, 1)].ad == [30, 2] and g[(120, 2)].gq == 20  # phase ignored, FORMAT order followed
    assert g[(133, 1)].gt == [3, 1] and g[(133, 0)].ad == [8, 16, 16, 0]
    assert g[(140, 0)].gt == [0, None] and g[(140, 1)].gt == [None, 0]  # beyond the one ALT -> missing
    assert g[(140, 2)].gt == [None, None] and g[(140, 2)].dp == 17
    assert g[(60000, 0)].gq is None and g[(60000, 1)].gq is None and g[(60000, 2)].dp is None  # left off, '.', '.'
    assert g[(2800000, 0)].gt == [0] and g[(2800000, 1)].dp is None
    assert all(g[(2900000, k)].dp is None for k in range(3))  # FORMAT without DP
    hs = sorted((r.sample_rank, r.sample) for r in header_samples(lines).collect())
    assert hs == list(enumerate(SAMPLES))
    assert sorted(r.contig for r in header_contigs(lines).collect()) == ["chr2", "chrX"]


def test_count_from_vcf(spark, tmp_path):
    d, _ = write_all(tmp_path)
    lines = read_vcf_lines(spark, [str(d / "a.vcf")], expand=False)
    drop = Filters(on_unsupported="drop")
    by_calls = count_dataset(sites_to_genotypes(parse_sites(lines)), filters=drop, header_samples=header_samples(lines))
    by_sites = count_sites(parse_sites(lines), header_samples(lines), filters=drop)
    key = lambda r: (r.pos, r.alt)
    assert sorted(by_calls.counts.collect(), key=key) == sorted(by_sites.counts.collect(), key=key)
    # Two chrX records lie outside the PARs: P has two hom events, Q and R one of each kind.
    assert {r.sample: (r.n_hom, r.n_het, r.sex) for r in by_sites.samples.collect()} == {"P": (2, 0, "XY"), "Q": (1, 1, "XX"), "R": (1, 1, "XX")}
    c = {(r.pos, r.alt): r for r in by_sites.counts.collect()}
    assert all(p != 50 for p, _ in c)  # reference block
    t = c[(120, "T")]
    assert (t.XX_AC, t.XX_AC_hom, t.XY_AC, t.XY_AC_hom, t.n_samples, t.DP_sum) == (3, 1, 1, 0, 3, 72.0)
    # 133: P's T has AB 0.2 and Q's 0, both fail; P's TA passes, R's has GQ 12; '*' is not counted
    assert (c[(133, "T")].XX_AC, c[(133, "T")].XY_AC, c[(133, "T")].n_samples) == (0, 0, 2)
    assert (c[(133, "TA")].XX_AC, c[(133, "TA")].XY_AC, c[(133, "TA")].DP2_sum) == (0, 1, 1600.0 + 1936.0)
    assert (133, "*") not in c
    assert (140, "A") not in c and c[(140, "G")].n_samples == 1  # half-missing calls are dropped
    assert c[(60000, "A")].XY_AC == 0 and c[(60000, "A")].n_samples == 1  # no GQ; R has no DP
    assert c[(2800000, "<DUP>")].n_samples == 1 and c[(2800000, "A")].DP_sum == 30.0
    assert all(p != 2900000 for p, _ in c)


def test_end_before_the_record_is_ignored(spark, tmp_path):
    p = tmp_path / "e.vcf"
    p.write_text(vcf_text("chr1 500 . ACG A . . END=100 GT:DP 0/1:20\nchr1 700 . A C . . END=700 GT:DP 0/1:20", ["S"], ["chr1"]))
    sites = parse_sites(read_vcf_lines(spark, [str(p)]))
    assert sorted((r.pos, r.end) for r in sites.collect()) == [(500, 502), (700, 700)]
    assert region_overlap_scan(sites, "chr1", 400, 600).count() == 1


def test_float_depth_and_quality_are_truncated_only_if_declared(spark, tmp_path):
    body = "chr1 10 . A C . . . GT:DP:GQ 1/1:30.9:45.7 1/1:31:nan"
    plain = vcf_text(body, ["S1", "S2"], ["chr1"])
    typed = plain.replace("##contig", "##FORMAT=<ID=GQ,Number=1,Type=Float,Description=q>\n##FORMAT=<ID=DP,Number=1,Type=Float>\n##contig", 1)
    got = {}
    for name, text in (("plain", plain), ("typed", typed)):
        p = tmp_path / f"{name}.vcf"
        p.write_text(text)
        got[name] = sorted((r.dp, r.gq) for r in read_vcf_genotypes(spark, [str(p)])[0].collect() if r.dp)
    assert got == {"plain": [(31, None)], "typed": [(30, 45), (31, None)]}


def test_gzip_of_any_name_and_long_lines(spark, tmp_path):
    """BGZF is told from plain gzip by its blocks; lines of several MB stream in bounded batches."""
    long_line = "chr1\t10\t.\tA\tC\t.\t.\t.\tGT:DP\t" + "\t".join(["0/1:20"] * 600_000)
    text = "#CHROM\n" + f"{long_line}\n" * 6 + "last"
    write_bgzf(tmp_path / "a.vcf.gz", text, block_payload=60_000)
    (tmp_path / "b.vcf.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "empty.vcf.gz").write_bytes(b"")
    register(spark)
    for name, split in (("a", False), ("b", True)):
        path = str(tmp_path / f"{name}.vcf.gz")
        df = spark.read.format("vcf_bgzf").option("path", path).option("splitBytes", "20000").load()
        assert df.rdd.getNumPartitions() > 1
        assert sorted(r.n for r in df.selectExpr("length(value) AS n").collect()) == sorted(map(len, text.split("\n")))
        assert (df.rdd.glom().map(len).filter(bool).count() == 1) == split  # plain gzip does not split
    assert read_vcf_lines(spark, [str(tmp_path / "empty.vcf.gz")]).count() == 0
    batches = _Batches("x")
    held = [b.nbytes for b in batches.lines_of(iter([b"y" * 9_000_000, b"\n" + b"z" * 9_000_000 + b"\n"] * 5))]
    assert max(held) < 2 * _Batches.BYTES and len(held) >= 5


def test_count_without_header_table(spark, tmp_path):
    d, _ = write_all(tmp_path)
    lines = read_vcf_lines(spark, [str(d / "a.vcf")], expand=False)
    ds = count_dataset(sites_to_genotypes(parse_sites(lines)), filters=Filters(on_unsupported="drop"))
    assert sorted((r.sample_rank, r.sample, r.sex) for r in ds.samples.collect()) == [(0, None, "XY"), (1, None, "XX"), (2, None, "XX")]
    assert ds.counts.count() > 0


def _calls(spark, rows):
    schema = "file string, sample_rank int, sample string, contig string, pos int, end int, ref string, alts array<string>, gt array<int>, phased boolean, dp int, gq int, ad array<int>"
    return spark.createDataFrame(rows, schema)


def _odd_calls(spark):
    """Repeated calls, records that share their text but not their end, missing values, a sample without calls."""
    rng, rows = random.Random(5), []
    for f, width in (("b.vcf", 3), ("a.vcf", 4)):
        for _ in range(400):
            pos, rank = rng.choice([7, 70, 700, None]), rng.randrange(width - 1)
            alts = rng.choice([["C"], ["<NON_REF>"], ["C", "T"], [], None])
            gt = rng.choice([[0, 1], [1, None], [None, None], [1], None])
            ad = rng.choice([[3, 4], [None, 4], [], None])
            rows.append((f, rank, f"S{rank}", rng.choice(["chr1", "chr10", "chr2"]), pos, rng.choice([7, 80, None]), "A", alts, gt, rng.random() < 0.5, rng.choice([5, None]), 9, ad))
        rows.append((f, width - 1, f"S{width - 1}", "chr1", 7, 7, "A", ["C"], [0, 0], False, 5, 9, [1, 1]))
    return _calls(spark, rows)


def test_lines_assembled_in_place_are_those_of_chunks(spark, monkeypatch):
    g = _odd_calls(spark)
    got = sorted(map(tuple, vcf.to_vcf_lines(g, in_order=True).collect()))
    named = sorted(map(tuple, vcf.to_vcf_lines(g, g.select("file", "sample_rank", "sample").distinct()).collect()))
    monkeypatch.setattr(vcf, "SPOT_CALLS", 0)
    monkeypatch.setattr(vcf, "COPY_CHUNK", 2)
    assert got == named == sorted(map(tuple, vcf.to_vcf_lines(g, in_order=True).collect()))
    calls = sum(c not in ("./.",) for _, v in got if not v.startswith("#") for c in v.split("\tGT:DP:GQ:AD\t")[1].split("\t"))
    assert calls == g.count()


def test_lines_come_in_file_order_after_one_exchange_of_the_calls(spark, monkeypatch):
    monkeypatch.setattr(vcf, "LINE_BYTES", 300)
    lines = vcf.to_vcf_lines(_odd_calls(spark), in_order=True)
    place = lambda v: (0, "", 0) if v.startswith("##f") else (1, "", 0) if v.startswith("##") else (2, "", 0) if v[0] == "#" else (3, v.split("\t")[0], 0)
    for name in ("a.vcf", "b.vcf"):
        own = [r.value for r in lines.where(lines["file"] == name).collect()]
        assert [place(v) for v in own] == sorted(map(place, own))
    plan = lines.select("file", "value")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("RepartitionByExpression") == 2  # of the headers, of the calls


def test_lines_of_records_over_several_batches(spark, monkeypatch):
    """Records over several batches, several copies, ranks beyond the header's; calls cross one exchange only, as they are."""
    columns = ("file", "_site", "fixed", "max_rank", "sample_rank", "call")
    rows = [("f", "s1", "one", 2, 0, "a")] * 2 + [("f", "s1", "one", 2, 2, "b")] * 5 + [("f", "s2", "one", 2, 1, "c"), ("g", "s2", "two", 0, 0, "d")]
    wanted = [("f", f"one\t{a}\t./.\tb") for a in ("a", "a", "./.", "./.", "./.")] + [("f", "one\t./.\tc\t./."), ("g", "two\td")]
    for size in (1, 2, 3, 100):
        monkeypatch.setattr(vcf, "LINE_BYTES", 16 * size)
        batches = [pa.RecordBatch.from_pylist([dict(zip(columns, r)) for r in rows[k : k + size]]) for k in range(0, len(rows), size)]
        got = [(r["file"], r["value"]) for b in vcf._assembled(iter(batches)) for r in b.to_pylist()]
        assert got == wanted
    assert list(vcf._assembled(iter([]))) == []
    g = _odd_calls(spark)
    few = g.where("sample_rank = 0").select("file", "sample_rank", "sample").distinct()
    lines = [r.value for r in vcf.to_vcf_lines(g, few, in_order=True).collect() if not r.value.startswith("#")]
    assert lines and all(len(v.split("\tGT:DP:GQ:AD\t")[1].split("\t")) == 1 for v in lines)
    calls = sum(v.split("\tGT:DP:GQ:AD\t")[1] != "./." for v in lines)
    assert calls == g.where("sample_rank = 0").count()


def test_header_files_lie_in_folders_and_are_listed_in_few_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    cost = spark.conf.get(vcf.OPEN_COST)
    names = spark.range(400).select(F.concat(F.lit("c"), F.col("id").cast("string"), F.lit(".vcf")).alias("name"))
    assert sorted(r.name for r in bgzf.make_header_files(names, str(tmp_path)).collect()) == sorted(f"c{i}.vcf" for i in range(400))
    folders = [f for f in os.listdir(tmp_path) if not f.startswith(".")]
    assert len(folders) > bgzf.NAME_FOLDERS / 2
    assert len(input_files(spark, [f"{tmp_path}/*"]).collect()) == 0  # .vcf is taken only as a file
    assert sorted(os.path.basename(r.path) for r in input_files(spark, [f"{tmp_path}/*/*"]).collect()) == sorted(f"c{i}.vcf" for i in range(400))
    assert spark.conf.get(vcf.OPEN_COST) == cost


def test_listing_in_tasks(spark, tmp_path, monkeypatch):
    """The same files as by Spark's file index, of which the driver holds every file; that is not used."""
    texts = {
        "d/a.vcf.gz": "x", "d/b.txt": "x", "d/_c.vcf.gz": "x", "d/.e.vcf.gz": "x", "d/f.vcf.bgz": "", "d/g.vcf": "x", "d/h h.bcf": "x", "d/sub/i.vcf.gz": "x",
        "d/p.vcf.gz/part-0": "x", "d/p.vcf.gz/_SUCCESS": "x", "d/p.vcf.gz/deep/q": "x", "d/_r.vcf/part-0": "x", "d/sub/deep.vcf/part-0": "x", "e1/k.bcf": "x", "e2/l.bcf": "x",
        "e2/m.vcf.gz": "x", "_n/o.bcf": "x", "whole.vcf.bgz/one": "x", "whole.vcf.bgz/two.txt": "x", "d/_x=1.bcf": "x",
    }
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    os.symlink(tmp_path / "nowhere", tmp_path / "d" / "link.vcf.gz")
    given = [["d"], ["d/*"], ["*"], ["e?"], ["e[12]/*.bcf"], ["e*/*"], ["whole.vcf.bgz"], ["d/g.vcf", "d", "e1"], ["d/*", "d/a.vcf.gz"], ["{e1,e2}"], ["d/_*"], ["*/sub"]]
    given = [[f"{tmp_path}/{p}" for p in paths] for paths in given]
    want = [sorted(map(tuple, vcf.indexed_files(spark, paths).distinct().collect())) for paths in given]
    assert len(want[0]) > 3 and all(want[:9])
    index = vcf.indexed_files
    monkeypatch.setattr(vcf, "indexed_files", lambda s, paths: index(s, paths) if any("{" in p for p in paths) else pytest.fail(f"indexed: {paths}"))
    for paths, files in zip(given, want):
        assert sorted(map(tuple, input_files(spark, paths).collect())) == files, paths
    monkeypatch.undo()
    for nothing in (f"{tmp_path}/none", f"{tmp_path}/none*", f"{tmp_path}/none*/a"):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            input_files(spark, [nothing])
    assert input_files(spark, []).collect() == []
