"""Sinks and the tab-separated re-read."""

import glob

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

SPARK_ERRORS = (PySparkException, Py4JJavaError)

from wayfare.sinks import write_key_value_text, write_lines, write_single_row
from wayfare.sources.text import read_lines, read_tab_parts


def test_key_value_text_and_reread(spark, tmp_path):
    out = str(tmp_path / "wc")
    df = spark.createDataFrame([("of", 3), ("Of", 1), ("many", 2)], "word string, n long").coalesce(1)
    write_key_value_text(df, out, "word", "n")
    lines = [r.value for r in read_lines(spark, out).collect()]
    assert lines == ["Of\t1", "many\t2", "of\t3"]
    back = read_tab_parts(spark, out, "word string, n long").collect()
    assert {(r.word, r.n) for r in back} == {("of", 3), ("Of", 1), ("many", 2)}
    with pytest.raises(SPARK_ERRORS):
        write_key_value_text(df, out, "word", "n")  # errorifexists


def test_single_row_file(spark, tmp_path):
    out = str(tmp_path / "total")
    df = spark.createDataFrame([(466756, 23651106, 50.67124150519758)], "n long, s long, a double")
    write_single_row(df, out)
    parts = glob.glob(out + "/part-*")
    assert len(parts) == 1
    assert open(parts[0]).read() == "466756\t23651106\t50.67124150519758\n"


def test_crlf_lines_overwrite(spark, tmp_path):
    out = str(tmp_path / "average_delay")
    df = spark.createDataFrame([("9E, (1, 18)",)], "line string")
    write_lines(df, out)
    write_lines(df, out)  # overwrite
    data = b"".join(open(p, "rb").read() for p in glob.glob(out + "/part-*"))
    assert data == b"9E, (1, 18)\r\n"


def test_average_delay_report(spark, tmp_path):
    from tests.conftest import SF001
    from wayfare.plans import jobs
    from wayfare.sinks import write_average_delay

    target = write_average_delay(jobs.monthly_delay_text(spark, SF001), str(tmp_path))
    assert target.endswith("/average_delay")
    data = b"".join(open(p, "rb").read() for p in glob.glob(target + "/part-*"))
    lines = data.split(b"\r\n")
    assert lines[-1] == b"" and len(lines) == 21
    assert all(line.count(b"(") == 12 for line in lines[:-1])


def test_named_parts(spark, tmp_path):
    import os

    from tests.conftest import SF001
    from wayfare.plans import jobs
    from wayfare.sinks import write_named_parts

    out = str(tmp_path / "report")
    text = jobs.monthly_delay_text(spark, SF001).coalesce(1)
    names = write_named_parts(text, out, "average_delay_")
    assert [os.path.basename(n) for n in names] == ["average_delay_00000"]
    visible = lambda: sorted(f for f in os.listdir(out) if not f.startswith("."))
    assert visible() == ["average_delay_00000"]  # (local disks add .crc sidecars)
    lines = open(os.path.join(out, "average_delay_00000"), "rb").read().split(b"\r\n")
    assert len(lines) == 21 and lines[-1] == b""
    with pytest.raises(FileExistsError):
        write_named_parts(text, out, "average_delay_")
    write_named_parts(text, out, "average_delay_", overwrite=True)
    assert visible() == ["average_delay_00000"]


def test_single_row_double_format(spark, tmp_path):
    """A double sum renders like the original result line (2.3651106E7)."""
    out = str(tmp_path / "out")
    df = spark.createDataFrame([(466756, 23651106.0, 50.67124150519758)], "n long, s double, a double")
    write_single_row(df, out)
    assert open(glob.glob(out + "/part-*")[0]).read() == "466756\t2.3651106E7\t50.67124150519758\n"


def test_dump_writes_every_row(spark, tmp_path):
    from wayfare.sinks import dump

    out = str(tmp_path / "dump")
    dump(spark.range(50).selectExpr("id", "nullif(id, 7) as b"), out)
    lines = {r.value for r in spark.read.text(out).collect()}
    assert lines == {f"({i},{'' if i == 7 else i})" for i in range(50)}
