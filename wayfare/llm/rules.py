"""Quality rules with cross-document line frequency, in DataFrame operations.

Rules on the words of a document come first. Then its lines are hashed under a
normalised key, the distinct documents of each line are counted for each host,
lines above the limits are removed, and documents left with too few words are
rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import SPACE, SPACE_CHARS, boxed, content_key, materialise, unboxed, without

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
# A line is removed where so many documents of its host have it.
MIN_DOCUMENTS = 10
# A document is depleted with fewer words than MIN_WORDS or this share left.
MIN_LEFT = 0.3

METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")


def with_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the word counts of the base rules (null texts: zeros).

    Columns build on one another in separate projections, each used more than
    once, so that Spark computes each only once. Repeated windows: the windows
    of a text with equal ones are sorted by hash, those beside an equal one
    are kept, and each covers the words up to the next kept window.
    """
    step = docs.withColumns({"_body": F.coalesce(F.col(text), F.lit(""))})
    step = step.withColumns({"_words": words_of(F.col("_body")), "_lines": lines_with_words(F.col("_body"))})
    step = step.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    step = step.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
        "n_symbols": F.regexp_count("_body", F.lit(SYMBOLS)).cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
    })
    window = lambda i: F.xxhash64(*[F.get(F.col("_hashes"), i + k) for k in range(WINDOW)])
    starts = F.when(F.size("_hashes") >= WINDOW, F.sequence(F.lit(0), F.size("_hashes") - WINDOW)).otherwise(
        F.array().cast("array<int>"))
    step = step.withColumn("_windows", F.transform(starts, window)).drop("_body", "_words", "_lines", "_hashes")
    order = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("_order", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), order))
    hash_at = lambda i: F.get(F.col("_order"), i)["h"]
    tied = F.filter("_order", lambda w, i: w["h"].eqNullSafe(hash_at(i - 1)) | w["h"].eqNullSafe(hash_at(i + 1)))
    step = step.withColumn("_tied", F.sort_array(tied.getField("i"))).drop("_windows", "_order")
    steps = F.transform("_tied", lambda at, i: F.least(
        F.coalesce(F.get(F.col("_tied"), i + 1) - at, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0), lambda total, n: total + n)
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("_tied")


def line_rows(rows: DataFrame) -> DataFrame:
    """(host, document, place, key, words) for each line with a word."""
    each = rows.select("_host", "_doc1", "_doc2",
                       F.posexplode_outer(F.split(F.lower(F.coalesce("_text", F.lit(""))), "\n", -1)).alias("_place", "line"))
    line = each.withColumn("line", F.btrim("line", F.lit(SPACE_CHARS))).where("line <> ''")
    return line.select("_host", "_doc1", "_doc2", "_place", F.xxhash64("line").alias("_k1"),
                       F.xxhash64(F.lit("second"), "line").alias("_k2"),
                       F.size(F.split("line", SPACE + "+")).alias("_words"))


def apply_rules(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    host: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    min_share: float = 0.0,
    min_left: float = MIN_LEFT,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with the base counts,
    base_failed, n_removed_words and kept. Columns that are not kept, such as
    the text, stay where they are read.

    base_failed: fewer than ten words, or more than 20 % of them in repeated
    windows. A line is above the limit where at least ``min_documents``
    documents of its host have it, copies and documents without an id
    included; ``min_share`` asks for a share of the host's documents, too.
    A document is a row, but rows of equal id and text are one. kept is false
    when base_failed, or when the removed lines leave fewer than ten words or
    less than ``min_left`` of them. Null and empty texts have zero counts and
    fail. A null host is a host of its own. Equal rows get equal results; an
    empty table gives an empty table; very long texts are handled whole.
    Columns of the input with the names of the added ones give way; any other
    name is safe.

    A line or host with a third of all rows is counted by pre-aggregation:
    distinct (host, line, document) first, then sums.
    """
    base = without(docs, *METRICS, "base_failed", "n_removed_words", "kept")
    first, second = content_key(doc_id, text)
    rows = docs.select(boxed([c for c in (keep or base.columns) if c in base.columns]), first.alias("_doc1"), second.alias("_doc2"),
                       F.col(text).alias("_text"), F.col(host).alias("_host"))
    lines = materialise(line_rows(rows), "host_lines")
    common = lines.groupBy("_host", "_k1", "_k2").agg(F.count_distinct("_doc1", "_doc2").alias("_n")).where(
        F.col("_n") >= min_documents)
    if min_share > 0:
        hosts = rows.groupBy("_host").agg(F.count_distinct("_doc1", "_doc2").alias("_of"))
        common = (common.alias("c").join(hosts.alias("t"), F.col("c._host").eqNullSafe(F.col("t._host")))
                  .where(F.col("_n") >= min_share * F.col("_of")).select("c._host", "_k1", "_k2"))
    removed = (lines.alias("l").join(common.alias("c"), (F.col("l._k1") == F.col("c._k1"))
                                     & (F.col("l._k2") == F.col("c._k2"))
                                     & F.col("l._host").eqNullSafe(F.col("c._host")))
               # equal rows give each of their lines more than once
               .select("_doc1", "_doc2", "_place", "_words").distinct()
               .groupBy("_doc1", "_doc2").agg(F.sum("_words").alias("_removed")))
    measured = with_metrics(rows.drop("_host"), "_text").drop("_text")
    return _verdict(measured.join(removed, ["_doc1", "_doc2"], "left"), min_left)


def _verdict(rows: DataFrame, min_left: float) -> DataFrame:
    gone = F.coalesce(F.col("_removed"), F.lit(0)).cast("bigint")
    left = F.col("n_words") - F.col("n_removed_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumns({"n_removed_words": gone, "base_failed": failed})
    kept = ~F.col("base_failed") & (left >= MIN_WORDS) & (left >= min_left * F.col("n_words"))
    return unboxed(rows, {c: F.col(c) for c in [*METRICS, "base_failed", "n_removed_words"]} | {"kept": kept})
