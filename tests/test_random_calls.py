"""Random calls against a plain-Python statement of the rules (pile rows and sex inference)."""

import random

import pytest

from cohortac.constants import DEFAULT_CONTIGS
from cohortac.operators.sex import infer_sex
from cohortac.plans.pipeline import Filters, pile_for
from helpers import geno

POSITIONS = [100, 2_781_479, 2_781_480, 3_000_000, 56_887_902, 56_887_903, 57_217_415, 57_217_416, 155_701_382,
             155_701_383, 156_000_000]
CONTIGS = ["chr1", "chrX", "chrY", "chrM", "X", "chr2"]
ALTS = [["C", "G"], ["*", "G"], ["C", "<NON_REF>"], ["<NON_REF>"], ["T"]]


def random_rows(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        alts = rnd.choice(ALTS)
        idx = [0] + list(range(1, len(alts) + 1)) + [None]
        ploidy = rnd.choice([1, 2, 2, 2, 3])
        rows.append(dict(
            sample_rank=rnd.randrange(6),
            contig=rnd.choice(CONTIGS),
            pos=rnd.choice(POSITIONS),
            alts=alts,
            gt=[rnd.choice(idx) for _ in range(ploidy)],
            dp=rnd.choice([None, 0, 5, 9, 10, 11, 30]),
            gq=rnd.choice([None, 0, 19, 20, 99]),
            ad=rnd.choice([None, [10, 10, 10], [2, 20, 5], [6, 24, 0], [None, 3, 3], [1]]),
        ))
    return rows


def expected_pile(rows, sex_of, min_dp=10, min_gq=20, min_ab=0.2):
    out = []
    for r in rows:
        contig, pos, alts, sex, dp = r["contig"], r["pos"], r["alts"], sex_of[r["sample_rank"]], r["dp"]
        if contig not in DEFAULT_CONTIGS or not alts or alts[0] == "<NON_REF>":
            continue
        is_x, is_y = contig in ("chrX", "X"), contig in ("chrY", "Y")
        nonpar_x = 2_781_479 < pos < 155_701_383
        nonpar_y = 2_781_479 < pos < 56_887_903 or pos > 57_217_415
        if is_y and not (sex == "XY" and nonpar_y):
            continue
        if dp is None:
            continue
        hemi = sex == "XY" and ((is_x and nonpar_x) or (is_y and nonpar_y))
        passed = (r["gq"] if r["gq"] is not None else 0) >= min_gq
        het_c, hom_c = ((1, 0, 1), (1, 0, 1)) if hemi else ((1, 0, 0), (2, 1, 0))

        def ab_ok(a):
            ad = r["ad"]
            try:
                v = ad[a - 1] / dp
            except Exception:  # missing AD / entry, DP 0, index outside the list
                v = 0.0
            return v > min_ab

        gt = r["gt"]
        alleles = []
        if len(gt) == 2:
            a, b = gt
            if (a == 0 and b == 0) or (a is None and b is None):
                alleles = [("A", (0, 0, 0), passed)]
            elif a == 0 and b is not None:
                alleles = [(alts[b - 1], het_c, passed and ab_ok(b))]
            elif b == 0 and a is not None:
                alleles = [(alts[a - 1], het_c, passed and ab_ok(a))]
            elif a is not None and b is not None and a == b:
                alleles = [(alts[a - 1], hom_c, passed)]
            elif a is not None and b is not None:
                alleles = [(alts[a - 1], het_c, passed and ab_ok(a)), (alts[b - 1], het_c, passed and ab_ok(b))]
            # half-missing: dropped in 'drop' mode
        elif len(gt) == 1:
            a = gt[0]
            alleles = [("A", (0, 0, 0), passed)] if a in (0, None) else [(alts[a - 1], (1, 0, 1), passed)]
        for alt, (ac, hom, hem), ok in alleles:
            if alt == "*":
                continue
            vals = ((ac, hom, hem, 0) if ok else (0, 0, 0, 0)) if dp >= min_dp else (0, 0, 0, 1)
            zero = (0, 0, 0, 0)
            xx, xy = (vals, zero) if sex == "XX" else (zero, vals)
            out.append((contig, pos, alt, *xx, *xy, dp))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pile_matches_rules(spark, seed):
    rows = random_rows(seed)
    sex_of = {i: ("XX" if i % 2 == 0 else "XY") for i in range(6)}
    samples = spark.createDataFrame([("f.vcf.gz", i, s) for i, s in sex_of.items()], "file string, sample_rank int, sex string")
    p = pile_for(geno(spark, rows), samples, filters=Filters(on_unsupported="drop"))
    cols = ["contig", "pos", "alt", "XX_AC", "XX_AC_hom", "XX_AC_hemi", "XX_n_DP_discarded",
            "XY_AC", "XY_AC_hom", "XY_AC_hemi", "XY_n_DP_discarded", "DP"]
    got = sorted((tuple(r) for r in p.select(*cols).collect()), key=str)
    assert got == expected_pile(rows, sex_of)


def expected_sex(rows):
    counts = {}
    for r in rows:
        counts.setdefault(r["sample_rank"], [0, 0])
        end = r["pos"]
        if not (r["contig"] == "chrX" and r["pos"] <= 155_701_382 and end >= 2_781_480):
            continue
        gt = r["gt"]
        if gt in ([None], [None, None]):
            continue
        if len(gt) == 2 and gt[0] is not None and gt[0] == gt[1]:
            counts[r["sample_rank"]][0] += 1
        elif len(gt) == 2:
            counts[r["sample_rank"]][1] += 1
        elif len(gt) == 1 and gt[0] > 1:
            counts[r["sample_rank"]][1] += 1
        elif len(gt) == 1:  # haploid 0/1 in 'drop' mode: a single copy
            counts[r["sample_rank"]][0] += 1
    out = {}
    for k, (hom, het) in counts.items():
        tot = hom + het
        out[k] = (hom, het, "XX" if tot == 0 else ("XY" if het / tot < 0.2 else "XX"))
    return out


@pytest.mark.parametrize("seed", [4, 5])
def test_sex_inference_matches_rules(spark, seed):
    rows = random_rows(seed, n=300)
    rnd = random.Random(seed)
    for r in rows:  # lean the samples one way or the other
        if r["contig"] == "chrX" and r["sample_rank"] % 2 and rnd.random() < 0.8:
            r["gt"] = [1, 1]
    got = {r.sample_rank: (r.n_hom, r.n_het, r.sex) for r in infer_sex(geno(spark, rows), on_unsupported="drop").collect()}
    assert got == expected_sex(rows)
