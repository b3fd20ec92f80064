"""Word operators: tokeniser edges, case, routing, and A1 = A2 = A3."""

import glob

from pyspark.sql import functions as F

from tests.conftest import SF001
from wayfare.operators import words as W
from wayfare.plans import jobs
from wayfare.sinks import write_routed


def _docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_tokeniser_delimiters(spark):
    toks = [r.word for r in W.tokens(_docs(spark, ["  Make\tnow  \fquo. x"])).collect()]
    assert toks == ["Make", "now", "quo.", "x"]
    kept = [r.word for r in W.letter_tokens(_docs(spark, ["  Make\tnow  \fquo. x"])).collect()]
    assert kept == ["Make", "now", "quo."]


def test_vertical_tab_does_not_split(spark):
    toks = [r.word for r in W.tokens(_docs(spark, ["mo\u000bno"])).collect()]
    assert toks == ["mo\u000bno"]


def test_case_and_punctuation_are_distinct_keys(spark):
    counts = {r.word: r.n for r in W.word_count(W.letter_tokens(_docs(spark, ["Of of of, of"]))).collect()}
    assert counts == {"Of": 1, "of": 2, "of,": 1}


def test_letters_parameter(spark):
    got = {r.word for r in W.letter_tokens(_docs(spark, ["apple Banana cherry mango"]), letters="ab").collect()}
    assert got == {"apple", "Banana"}


def test_partition_rule_matches_mod(spark):
    counts = spark.createDataFrame([(w, 1) for w in ["m1", "N2", "o3", "P4", "q5", "zz"]], "word string, n long")
    routed = {r.word: r.part for r in W.route_by_initial(counts, 3).collect()}
    assert routed == {"m1": 0, "N2": 1, "o3": 2, "P4": 0, "q5": 1, "zz": 0}


def test_hot_route_is_split_and_every_file_sorted(spark, tmp_path):
    """One letter holds 90 % of the words; its rows go to several files."""
    words = [f"o{i:05d}" for i in range(9000)] + [f"{c}{i}" for c in "mnpq" for i in range(250)]
    source, out = str(tmp_path / "counts"), str(tmp_path / "routed")
    spark.createDataFrame([(w, 1) for w in words], "word string, n long").repartition(8).write.parquet(source)
    routed = W.route_by_initial(spark.read.parquet(source), 3)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        write_routed(routed, out, "part", ["word"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    assert len(glob.glob(f"{out}/part=2/part-*")) > 1
    rows = spark.read.parquet(out).select("word", "part", "_metadata.file_path", "_metadata.row_index").collect()
    assert sorted(r.word for r in rows) == sorted(words)
    for file in {r.file_path for r in rows}:
        inside = [r.word for r in sorted((r for r in rows if r.file_path == file), key=lambda r: r.row_index)]
        assert inside == sorted(inside)


def test_three_local_aggregation_forms_agree(spark):
    toks = jobs._letter_tokens(spark, SF001)
    a1 = W.word_count(toks)
    a2 = W.roll_up_term_frequency(W.doc_term_frequency(jobs._letter_tokens(spark, SF001, keep=["doc_id"])))
    a3n = W.word_count_native_tally(toks)
    for other in (a2, a3n):
        assert a1.exceptAll(other).count() == 0 and other.exceptAll(a1).count() == 0


def test_word_count_plan_has_partial_aggregate(spark):
    plan = jobs.word_count(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert "Python" not in plan and "ArrowEval" not in plan


def test_letter_totals(spark):
    counts = spark.createDataFrame([("mad", 2), ("Moo", 3), ("of", 5)], "word string, n long")
    got = {r.letter: (r.n_words, r.n_tokens) for r in W.letter_totals(counts).collect()}
    assert got == {"m": (2, 5), "o": (1, 5)}


def test_document_lines_split(spark):
    from wayfare.sources.text import document_lines

    lines = [r.value for r in document_lines(_docs(spark, ["a\nb\r\nc\rd"])).collect()]
    assert lines == ["a", "b", "c", "d"]
