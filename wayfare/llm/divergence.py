"""Source divergence audit: how the sources of a language differ in their words.

Every partition folds its documents into hash stripes: term -> (documents,
occurrences by source), spilled when they grow. Stripes are merged by key, and
the merged stripes of the kept terms directly give the divergences of every
two sources and of a source from its language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.common import materialise, row_slices, texts_as_bytes

MIN_DOCUMENTS, TOP = 10, 10
SCALE = 1_000_000_000
# Counts that a task's stripes hold before they are spilled, and bytes of a
# text folded at once.
STRIPE_COUNTS, SLICE_BYTES = 1_000_000, 1 << 20
# Sources compared at once, cells of a matrix of shares, and blocks of sums of
# two times SOURCE_BLOCK sources that a task holds before it spills them.
SOURCE_BLOCK, CELLS, SUM_BLOCKS = 128, 1 << 20, 256
# Groups (language, source) whose totals a task is given at once.
GROUPS = 1 << 18

STRIPES = "lang string, term string, documents bigint, sources array<string>, counts array<bigint>"
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def term_counts(text: bytes) -> Counter:
    """How often a UTF-8 text has each term: runs of letters A-Z (lower-cased)
    and characters beyond ASCII. Long texts are split a slice at a time."""
    body, found, at = text.translate(_TABLE), Counter(), 0
    while at < len(body):
        stop = body.find(b" ", at + SLICE_BYTES)
        stop = len(body) if stop < 0 else stop
        found.update(body[at:stop].split())
        at = stop
    return found


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    lang, term, documents, sources, counts = zip(*rows) if rows else ((),) * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(documents, pa.int64()),
         pa.array(sources, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64()))],
        names=["lang", "term", "documents", "sources", "counts"])


def fold(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """Stripes of every task: (lang, term, documents, sources, counts). A
    stripe without a term names the sources of a language, with counts 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes: dict[tuple, dict] = {}  # (lang, term) -> {None: documents, source: occurrences}
        held = 0

        def spill() -> Iterator[pa.RecordBatch]:
            rows = [(k[0], k[1], s.pop(None), list(s), list(s.values())) for k, s in stripes.items()]
            stripes.clear()
            for at in range(0, len(rows), 20_000):
                yield _batch(rows[at:at + 20_000])

        for whole in batches:
            for batch in row_slices(whole):
                names = [x.to_pylist() for x in batch.columns[:2]]
                for tongue, origin, body in zip(*names, texts_as_bytes(batch.column(2))):
                    stripes.setdefault((tongue, None), {None: 0}).setdefault(origin, 0)
                    for term, n in term_counts(body).items():
                        stripe = stripes.get((tongue, term))
                        if stripe is None:
                            stripe = stripes[tongue, term] = {None: 0}
                            held += 1
                        stripe[None] += 1
                        if origin in stripe:
                            stripe[origin] += n
                        else:
                            stripe[origin] = n
                            held += 1
                    if held > STRIPE_COUNTS:
                        yield from spill()
                        held = 0
        yield from spill()

    return docs.select(F.coalesce(lang, F.lit("")), F.coalesce(source, F.lit("")), F.col(text)).mapInArrow(run, STRIPES)


def _totals(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The stripes of totals of some whole merged stripes: per language, no
    term, the number of terms and the occurrences of all by source."""
    for tongue in rows["lang"].unique():
        some = rows.filter(pa.compute.equal(rows["lang"], tongue))
        code = some["sources"].combine_chunks().flatten().dictionary_encode()
        counts = some["counts"].combine_chunks().flatten().to_numpy()
        sums = np.zeros(len(code.dictionary), np.int64)
        np.add.at(sums, code.indices.to_numpy(), counts)
        n_terms = some.num_rows - some["term"].null_count
        yield _batch([(tongue.as_py(), None, n_terms, code.dictionary.to_pylist(), sums.tolist())])


def merge(stripes: DataFrame, min_documents: int) -> DataFrame:
    """One stripe for each (lang, term) in ``min_documents`` documents or
    more, and partial totals of these: stripes without a term, whose documents
    are the number of terms and whose counts are sums over terms."""

    def join(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Merge rows sorted by key, all rows of whose keys are here."""
        lang, term = (rows[c].combine_chunks() for c in ("lang", "term"))
        same = pa.compute.and_(pa.compute.equal(lang[1:], lang[:-1]),
                               pa.compute.fill_null(pa.compute.equal(term[1:], term[:-1]), False))
        both_null = pa.compute.and_(pa.compute.is_null(term[1:]), pa.compute.is_null(term[:-1]))
        same = pa.compute.or_(same, pa.compute.and_(both_null, pa.compute.equal(lang[1:], lang[:-1])))
        new = np.concatenate([[True], ~same.to_numpy(zero_copy_only=False)])
        key, firsts = np.cumsum(new) - 1, np.nonzero(new)[0]
        documents = np.add.reduceat(rows["documents"].to_numpy(), firsts)
        sources, counts = (rows[c].combine_chunks() for c in ("sources", "counts"))
        code = sources.flatten().dictionary_encode()
        owner = np.repeat(key, pa.compute.list_value_length(sources).to_numpy())
        width = max(1, len(code.dictionary))
        cell, at = np.unique(owner * width + code.indices.to_numpy(), return_inverse=True)
        sums = np.zeros(len(cell), np.int64)
        np.add.at(sums, at, counts.flatten().to_numpy())
        ends = np.searchsorted(cell // width, np.arange(len(firsts) + 1))
        names = code.dictionary.take(pa.array(cell % width))
        offsets = pa.array(ends, pa.int32())
        merged = pa.Table.from_arrays(
            [lang.take(pa.array(firsts)), term.take(pa.array(firsts)), pa.array(documents),
             pa.ListArray.from_arrays(offsets, names), pa.ListArray.from_arrays(offsets, pa.array(sums))],
            names=rows.column_names)
        kept = merged.filter(pa.compute.or_(pa.compute.is_null(merged["term"]),
                                            pa.compute.greater_equal(merged["documents"], min_documents)))
        if kept.num_rows:
            yield from kept.filter(pa.compute.is_valid(kept["term"])).combine_chunks().to_batches()
            yield from _totals(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            if not rows.num_rows:
                continue
            # the last key may go on in the next batch
            last = rows.slice(rows.num_rows - 1)
            tongue, term = last["lang"][0], last["term"][0]
            other = pa.compute.not_equal(rows["lang"], tongue)
            if term.is_valid:
                other = pa.compute.or_(other, pa.compute.fill_null(pa.compute.not_equal(rows["term"], term), True))
            else:
                other = pa.compute.or_(other, pa.compute.is_valid(rows["term"]))
            n = int(pa.compute.sum(other).as_py() or 0)
            if n:
                yield from join(rows.slice(0, n))
            rest = rows.slice(n)
        if rest is not None and rest.num_rows:
            yield from join(rest)

    dealt = stripes.repartition("lang", "term").sortWithinPartitions("term", "lang")
    return dealt.mapInArrow(run, STRIPES)


def share(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / whole) for count + 2 <= whole, three
    digits at a time: exact in 64 bits for wholes below 9 * 10**15."""
    rest, out = count + 2, np.zeros_like(count)
    for _ in range(3):
        rest = rest * 1000
        digits = rest // whole
        out = out * 1000 + digits
        rest -= digits * whole
    return out + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most SCALE + 1."""
    return (p - q) ** 2 // (p + q)


class Totals:
    """What the shares of one language are made of."""

    def __init__(self, sources: list[str], sums: np.ndarray, n_terms: int):
        self.sources, self.sums, self.n_terms = sources, sums, n_terms
        self.place = {s: i for i, s in enumerate(sources)}

    def shares(self, counts: np.ndarray) -> np.ndarray:
        return share(counts, (self.sums + 2 * self.n_terms)[None, :])

    def whole(self, counts: np.ndarray) -> np.ndarray:
        return share(counts.sum(1), self.sums.sum() + 2 * self.n_terms)


def emit(stripes: DataFrame, totals: dict[str, Totals], top: int) -> DataFrame:
    """Rows (lang, source, part, item, value): partial sums of the pairs and
    candidates for the top terms, from some merged stripes at a time."""

    def dense(rows: pa.Table, known: Totals) -> np.ndarray:
        lists = rows["sources"].combine_chunks()
        code = lists.flatten().dictionary_encode()
        place = np.array([known.place[s] for s in code.dictionary.to_pylist()], np.int64)
        out = np.zeros((rows.num_rows, len(known.sources)), np.int64)
        owner = np.repeat(np.arange(rows.num_rows), pa.compute.list_value_length(lists).to_numpy())
        out[owner, place[code.indices.to_numpy()]] = rows["counts"].combine_chunks().flatten().to_numpy()
        return out

    def result(lang: str, part: str, sources: list, items: list, values: np.ndarray) -> pa.RecordBatch:
        n = len(sources)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * n, pa.string()), pa.array(sources, pa.string()), pa.array([part] * n, pa.string()),
             pa.array(items, pa.string()), pa.array(values, pa.int64())], names=["lang", "source", "part", "item", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}

        def spill() -> Iterator[pa.RecordBatch]:
            for (lang, i, j), block in sums.items():
                names = totals[lang].sources
                a, b = np.nonzero(np.ones_like(block, bool) if i < j else np.triu(np.ones_like(block, bool), 1))
                left, right = [names[i + k] for k in a], [names[j + k] for k in b]
                yield result(lang, "pair", left + right, right + left, np.tile(block[a, b], 2))
            sums.clear()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            for lang in table["lang"].unique().to_pylist():
                known = totals[lang]
                n = len(known.sources)
                some = table.filter(pa.compute.equal(table["lang"], lang))
                for at in range(0, some.num_rows, max(1, CELLS // n)):
                    rows = some.slice(at, max(1, CELLS // n))
                    counts = dense(rows, known)
                    shares = known.shares(counts)
                    yield from tops(lang, known, rows["term"].to_pylist(), counts, shares)
                    for i in range(0, n, SOURCE_BLOCK):
                        for j in range(i, n, SOURCE_BLOCK):
                            left, right = shares[:, i:i + SOURCE_BLOCK], shares[:, j:j + SOURCE_BLOCK]
                            if (lang, i, j) not in sums and len(sums) >= SUM_BLOCKS:
                                yield from spill()
                            block = sums.setdefault((lang, i, j), np.zeros((left.shape[1], right.shape[1]), np.int64))
                            for k in range(left.shape[1]):
                                first = k + 1 if i == j else 0
                                block[k, first:] += gap(left[:, k:k + 1], right[:, first:]).sum(0)
        yield from spill()

    def tops(lang: str, known: Totals, terms: list[str], counts: np.ndarray, shares: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The ``top`` terms of every source among these rows."""
        whole = known.whole(counts)
        order = np.argsort(np.array([t.encode() for t in terms], object), kind="stable")
        sources, items, values = [], [], []
        for k, name in enumerate(known.sources):
            own = order[(counts[order, k] > 0) & (shares[order, k] > whole[order])]
            value = gap(shares[own, k], whole[own])
            best = np.argsort(-value, kind="stable")[:top]
            sources += [name] * len(best)
            items += [terms[i] for i in own[best]]
            values.append(value[best])
        yield result(lang, "term", sources, items, np.concatenate(values))

    return stripes.mapInArrow(run, "lang string, source string, part string, item string, value bigint")


def no_gaps(groups: DataFrame, totals: dict[str, Totals]) -> DataFrame:
    """Every two sources of a language with the sum 0, which pairs without
    terms keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names = totals[lang].sources
                for at in range(0, len(names), 10_000):
                    others = [s for s in names[at:at + 10_000] if s != source]
                    n = len(others)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                         pa.array(["pair"] * n, pa.string()), pa.array(others, pa.string()), pa.array([0] * n, pa.int64())],
                        names=["lang", "source", "part", "item", "value"])

    return groups.select("lang", "source").mapInArrow(
        run, "lang string, source string, part string, item string, value bigint")


def source_divergences(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    top: int = TOP,
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group (lang, source)
    of ``docs``.

    A language keeps the V terms in at least ``min_documents`` of its
    documents. A group, and the language as a whole, gives each kept term with
    c occurrences the share p = 1 + floor(10**9 (c + 2) / (N + 2 V)), N the
    occurrences of all kept terms there. Part ``pair``: each other source of
    the language with the sum of floor((p - q)^2 / (p + q)) over all kept
    terms, 0 without any. Part ``term``: the ``top`` kept terms that the group
    has and that have a larger share there than in the language, with their
    own gap. Ranks go by value, largest first, then item in UTF-8 order.

    Null texts, languages and sources count as empty strings. Every row is a
    document, repeated ones too. Very long texts are split a slice at a time.
    An empty table gives an empty table; only the three columns are read, so
    names of others do no harm.

    A task's stripes, sums and matrices are bounded; a stripe has at most one
    count for each source of its language, and the result has a row for each
    pair of these. Totals reach the tasks for at most ``GROUPS`` groups at
    once (a language is not divided); more are further passes over the merged
    stripes.
    """
    stripes = materialise(fold(docs, text, lang, source), "stripes")
    merged = materialise(merge(stripes, min_documents), "merged_stripes")
    partial = merged.where(F.col("term").isNull())
    each = partial.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("g"))
    groups = materialise(each.groupBy("lang", F.col("g.sources").alias("source"))
                         .agg(F.sum("g.counts").alias("total")), "groups")
    terms = partial.groupBy("lang").agg(F.sum("documents").alias("n_terms"))
    n_passes = max(1, -(-groups.count() // GROUPS))
    number = F.pmod(F.xxhash64("lang"), F.lit(n_passes))
    parts = []
    for k in range(n_passes):
        table = groups.where(number == k).join(terms, "lang").toPandas()
        totals = {name: Totals(g["source"].tolist(), g["total"].to_numpy(np.int64), int(g["n_terms"].iloc[0]))
                  for name, g in table.groupby("lang", sort=False)}
        kept = merged.where(F.col("term").isNotNull() & (number == k))
        parts.append(materialise(emit(kept, totals, top).unionByName(no_gaps(groups.where(number == k), totals)), "gaps"))
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    keys = ["lang", "source", "part"]
    # a term is in one merged stripe, a pair in many
    sums = rows.groupBy(*keys, "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy(*keys).orderBy(F.desc("value"), "item")
    ranked = sums.withColumn("rank", F.row_number().over(best))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))
