"""The command-line jobs over exported text and CSV files."""

import glob

from tests.conftest import SF001
from wayfare.plans import cli, jobs
from wayfare.sinks import versions


def _read(pattern, mode="r"):
    parts = [open(p, mode).read() for p in sorted(glob.glob(pattern))]
    return (b"" if "b" in mode else "").join(parts)


def test_word_count_job(spark, tmp_path):
    src = jobs.document_text_files(spark, SF001)
    out = str(tmp_path / "wc")
    cli.word_count_job(spark, src, out)
    lines = _read(out + "/part-*").splitlines()
    got = {w: int(n) for w, n in (l.split("\t") for l in lines)}
    exp = {r.word: r.n for r in jobs.word_count(spark, SF001).collect()}
    assert got == exp
    assert len(glob.glob(out + "/part-*")) == 1  # one byte-ordered file by default
    words = [l.split("\t")[0] for l in lines]
    assert words == sorted(words, key=lambda w: w.encode())
    out3 = str(tmp_path / "wc3")
    cli.word_count_job(spark, src, out3, reducers=3)
    routes = {w[0].lower(): p for p in range(3) for w in _read(f"{out3}/part={p}/part-*").splitlines()}
    assert routes == {"m": 0, "n": 1, "o": 2, "p": 0, "q": 1}
    assert sorted(_read(out3 + "/part=*/part-*").splitlines()) == sorted(lines)


def test_two_leg_and_monthly_jobs(spark, tmp_path):
    src = jobs.flight_csv_files(spark, SF001)
    cli.two_leg_job(spark, src, str(tmp_path / "twoleg"))
    assert _read(str(tmp_path / "twoleg") + "/part-*") == "221\t3722.0\t16.84162895927602\n"
    target = cli.monthly_job(spark, src, str(tmp_path / "monthly"))
    text = _read(target + "/part-*", "rb")
    exp = {r.line for r in jobs.monthly_delay_text(spark, SF001).collect()}
    assert set(text.decode().split("\r\n")[:-1]) == exp


def test_populate_and_compute_jobs(spark, tmp_path):
    src = jobs.flight_csv_files(spark, SF001)
    table = str(tmp_path / "flights")
    assert [cli.populate_job(spark, src, table) for _ in range(2)] == [1, 2]
    assert versions.read(spark, table).count() == 6000  # the second load changes nothing
    exp = {r.line for r in jobs.monthly_delay_text(spark, SF001).collect()}
    for by_range in (False, True):
        target = cli.compute_job(spark, table, str(tmp_path / f"out{by_range}"), by_range=by_range)
        assert set(_read(target + "/part-*", "rb").decode().split("\r\n")[:-1]) == exp


def test_monthly_named_parts(spark, tmp_path):
    import os

    src = jobs.flight_csv_files(spark, SF001)
    out = str(tmp_path / "named")
    cli.monthly_job(spark, src, out, named_parts=True)
    files = sorted(f for f in os.listdir(out) if not f.startswith("."))
    assert files and all(f.startswith("average_delay_") for f in files)
    exp = {r.line for r in jobs.monthly_delay_text(spark, SF001).collect()}
    got = _read(out + "/average_delay_*", "rb").decode().split("\r\n")
    assert set(got[:-1]) == exp
