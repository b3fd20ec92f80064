"""Word counting: tokenise, filter by initial, count (globally, per document,
per partition) and route the result by initial.

Skew: a single word (``of``) may hold a large share of all tokens. Every
count here is a hash aggregate with a map-side partial step, so each task
ships at most one row per distinct word; nothing is ever grouped by
initial letter before aggregation (letter ``o`` alone can hold 40 % of the
tokens), routing by letter happens only after the counts are final.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.predicates import DEFAULT_LETTERS, starts_with_letter
from wayfare.functions.scalar import first_char

# Fixed value: the tokeniser's delimiters are exactly space, tab, LF, CR and
# FF (not ``\s``, which would also split on vertical tab).
TOKEN_DELIMITERS = "[ \\t\\n\\r\\f]+"


def tokens(df: DataFrame, text_col: str = "text", keep: list[str] | None = None,
           out: str = "word") -> DataFrame:
    """One row per token; a leading/trailing delimiter gives no empty token."""
    tok = F.explode(F.split(F.col(text_col), TOKEN_DELIMITERS)).alias(out)
    return df.select(*(keep or []), tok).where(F.col(out) != "")


def letter_tokens(df: DataFrame, text_col: str = "text", letters: str = DEFAULT_LETTERS,
                  keep: list[str] | None = None) -> DataFrame:
    """P1 + P2: tokens whose first character is one of ``letters`` (any case)."""
    t = tokens(df, text_col, keep)
    return t.where(starts_with_letter(F.col("word"), letters))


def word_count(words: DataFrame) -> DataFrame:
    """A1: occurrences per (case-sensitive, punctuation-kept) token."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def doc_term_frequency(words: DataFrame, doc_col: str = "doc_id") -> DataFrame:
    """A2: term frequency per document."""
    return words.groupBy(doc_col, "word").agg(F.count(F.lit(1)).alias("tf"))


def roll_up_term_frequency(tf: DataFrame) -> DataFrame:
    """A2 roll-up: global counts from per-document counts."""
    return tf.groupBy("word").agg(F.sum("tf").alias("n"))


def word_count_native_tally(words: DataFrame) -> DataFrame:
    """A3, JVM form: tally per input partition, then the global sum."""
    per_part = words.groupBy(F.spark_partition_id().alias("pid"), "word").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_part.groupBy("word").agg(F.sum("n").alias("n"))


# O3: route by initial: m -> 0, n -> 1 % k, o -> 2 % k, p -> 3 % k,
# q -> 4 % k, anything else -> 0 (generalised to any letter string).
def initial_partition(word: Column, k: int, letters: str = DEFAULT_LETTERS) -> Column:
    if k <= 0:
        return F.lit(0)
    initial = F.lower(first_char(word))
    expr = F.lit(0)
    for i, letter in reversed(list(enumerate(letters.lower()))):
        expr = F.when(initial == letter, F.lit(i % k)).otherwise(expr)
    return expr


def route_by_initial(counts: DataFrame, k: int, letters: str = DEFAULT_LETTERS) -> DataFrame:
    """O3: every counted word with its route ``part``, a column computed in
    place; ``sinks.write_routed`` lays the files out by it."""
    return counts.withColumn("part", initial_partition(F.col("word"), k, letters))


def letter_totals(counts: DataFrame) -> DataFrame:
    """Tokens and distinct words per (lower-cased) initial, from final counts."""
    return counts.groupBy(F.lower(first_char(F.col("word"))).alias("letter")).agg(
        F.count(F.lit(1)).alias("n_words"), F.sum("n").alias("n_tokens")
    )
