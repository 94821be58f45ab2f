"""The command line runs count -> finalize -> inspect on VCF files."""

import os
import subprocess
import sys

from test_vcf import write_all

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(*args):
    env = dict(os.environ, PYTHONPATH=REPO)
    return subprocess.run([sys.executable, "-m", "cohortac", *args], cwd=REPO, env=env, capture_output=True, text=True, timeout=600)


def test_cli_count_finalize_inspect(tmp_path):
    d, _ = write_all(tmp_path)
    out, res = str(tmp_path / "counts"), str(tmp_path / "result")
    r = run("count", str(d), "-o", out, "-r", "chr2,chrX", "--min-GQ", "0", "--on-unsupported", "drop")
    assert r.returncode == 0, r.stderr[-2000:]
    r = run("finalize", out, "-o", res)
    assert r.returncode == 0, r.stderr[-2000:]
    r = run("inspect", res + "/result", "XX_AC > 0")
    assert r.returncode == 0, r.stderr[-2000:]
    lines = r.stdout.strip().split("\n")
    header = lines[0].split("\t")
    assert {"region", "contig", "pos", "ref", "alt", "XX_AN", "XX_AC", "DP_mean", "DP_std"} <= set(header)
    rows = [dict(zip(header, ln.split("\t"))) for ln in lines[1:]]
    assert rows and all(int(r["XX_AC"]) > 0 for r in rows)
    tsv = str(tmp_path / "tsv")
    r = run("inspect", res, "XX_AC > 0", "-o", tsv)
    assert r.returncode == 0, r.stderr[-2000:]
    written = [ln for f in sorted(os.listdir(tsv)) if f.endswith(".csv") for ln in open(os.path.join(tsv, f)).read().splitlines()[1:]]
    assert len(written) == len(rows)
