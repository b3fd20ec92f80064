"""Decontamination, spelling variants and source divergence against their SQL
or a brute-force version, with odd rows and with every bound made small."""

import itertools
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001
from wayfare.llm import decontaminate, divergence, spelling
from wayfare.testing import duck_views, frames_equal

LOWER = {c: c + 32 for c in range(65, 91)}
CLASHES = ["n_words", "n_hit", "spans", "items", "contaminated", "_row", "_doc1", "_doc2", "_text", "pieces", "piece",
           "_spans", "_pieces", "term", "rank", "value", "part", "item", "word", "n", "form", "root", "documents"]


def oracle(name, **tables):
    con = duckdb.connect()
    for table, (schema, rows) in tables.items():
        con.execute(f"CREATE TABLE {table} ({schema})")
        if rows:
            con.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return con.sql(E.oracle_sql()[name]).df()


def write(spark, folder, **tables):
    for table, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(folder / f"{table}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", ["op11_decontaminate", "op13_divergence"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    duck_views(con, SF001, ["documents", "benchmark"])
    ok, why = frames_equal(E.queries()[name](spark, SF001).toArrow(), con.sql(E.oracle_sql()[name]).to_arrow_table())
    assert ok, why


# ------------------------------------------------------------ decontamination
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my ny xi"
ITEMS = [(1, PASSAGE), (2, "Short  ITEM, here"), (3, PASSAGE), (None, "nobody knows this item at all or its id today"),
         (4, None), (5, " .,- "), (6, "one " * 12), (10, PASSAGE + " omikron pi"), (7, "solo")]
DOCS = [
    (1, f"Before. {PASSAGE.upper()} after"), (2, None), (3, ""), (4, "a short item here, and SHORT-ITEM-HERE"),
    (5, "one " * 11 + "two " + "one " * 9), (6, "and nobody knows this item at all or its id today too"),
    (7, "alpha beta gamma delta epsilon zeta eta theta iota"), (8, PASSAGE.replace("zeta", "zita")),
    (9, "solo solo"), (10, "soloist café soloé"), (None, PASSAGE), (11, "filler " * 3_000 + PASSAGE),
    (12, "  ☃ beta gamma delta epsilon zeta eta theta iota kappa lambda"),
]


def contract(found):
    listed = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        listed.alias("items_sha256"), "contaminated").toPandas()


@pytest.fixture(scope="module")
def leaks(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("shard", [1 << 21, 60])
def test_windows_of_odd_items_in_odd_texts(spark, leaks, monkeypatch, shard):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)  # 60: a shard for about each item
    got = contract(decontaminate.find_benchmark_words(*leaks))
    exp = oracle("op11_decontaminate", documents=("doc_id BIGINT, text VARCHAR", DOCS),
                 benchmark=("item_id BIGINT, text VARCHAR", ITEMS))
    ok, why = frames_equal(got[got.doc_id.notna()], exp[exp.doc_id.notna()])  # the SQL joins by id
    assert ok, why
    assert got[got.doc_id.isna()].iloc[0]["n_hit"] == 14
    by = got.set_index("doc_id")
    assert by.loc[1, "n_hit"] == 14 and by.loc[1, "n_items"] == 3 and by.loc[5, "n_hit"] == 11
    assert by.loc[6, "n_hit"] == 10 and by.loc[6, "n_items"] == 0 and not by.loc[[7, 8, 10], "contaminated"].any()


def test_spans_items_and_other_columns(spark, leaks):
    docs, items = leaks
    wide = docs.withColumns({c: F.lit("mine") for c in CLASHES})
    got = {r["doc_id"]: r for r in decontaminate.find_benchmark_words(wide, items).collect()}
    assert [tuple(s) for s in got[4]["spans"]] == [(1, 4), (5, 8)] and got[4]["items"] == ["2"]
    assert got[1]["items"] == ["1", "10", "3"] and got[1]["text"] == DOCS[0][1] and got[3]["spans"] == []
    assert all(got[1][c] == "mine" for c in CLASHES[5:])
    assert [tuple(s) for s in got[11]["spans"]] == [(3_000, 3_014)]


def test_repeated_rows_and_empty_tables(spark, leaks):
    docs, items = leaks
    twice = decontaminate.find_benchmark_words(docs.unionByName(docs), items.unionByName(items))
    once = sorted(map(str, contract(decontaminate.find_benchmark_words(docs, items)).itertuples(index=False)))
    assert sorted(map(str, contract(twice).itertuples(index=False))) == sorted(once * 2)
    assert decontaminate.find_benchmark_words(docs.limit(0), items).count() == 0
    assert decontaminate.find_benchmark_words(docs, items.limit(0)).where("contaminated").count() == 0


@pytest.mark.parametrize("slice_bytes, piece_words", [(1 << 20, 4096), (40, 13), (7, 40)])
def test_search_matches_plain_scan(monkeypatch, slice_bytes, piece_words):
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", piece_words)
    rng = np.random.default_rng(5)
    words = lambda n, kinds: " ".join(f"w{x}" for x in rng.integers(0, kinds, n))
    items = [words(n, 3) for n in (1, 2, 5, 9, 10, 11, 30, 60)] + [words(40, 9)]
    pieces = [p for i in items for p in decontaminate.cut_pieces(decontaminate.word_slices(i.encode()))]
    patterns = decontaminate.Patterns(pieces)
    windows = set()
    for item in items:
        w = item.split()
        k = min(10, len(w))
        windows |= {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    owners = {tuple(p.decode().split()[i:i + 10]) for p in pieces for i in range(max(1, len(p.split()) - 9))}
    assert owners == windows
    for text in [words(n, k) for n in (0, 3, 9, 80, 400) for k in (2, 3, 9)] + [f"x {items[6]} y {items[8]}", items[-1]]:
        w = text.split()
        hit = {p for v in windows for i in range(len(w) - len(v) + 1) if tuple(w[i:i + len(v)]) == v for p in range(i, i + len(v))}
        total, spans, _ = patterns.search(text.encode())
        assert total == len(w)
        assert {p for s, e in zip(spans[::2], spans[1::2]) for p in range(s, e)} == hit
        assert sum(spans[1::2]) - sum(spans[::2]) == len(hit)


# --------------------------------------------------------------------- spelling
def slow_groups(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = crc % len(run)
            counts[run[:at] + run[at + 1:] if crc % 97 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: set() for w in n}
    for a, b in itertools.combinations(n, 2):
        short, long = sorted((a, b), key=len)
        if len(short) == len(long):
            close = sum(x != y for x, y in zip(a, b)) == 1
        else:
            close = len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))
        if close:
            near[a].add(b)
            near[b].add(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 2 * n[w]:
            form[w] = best
    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n)


def groups(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def variants(seed, n):
    rng = np.random.default_rng(seed)
    base = ["spelling", "variant", "écoleÿ", "aabbaabb", "neighbour", "zzzzz"]
    words = []
    for _ in range(n):
        w = list(base[rng.integers(0, len(base))])
        for _ in range(rng.integers(0, 3)):
            at = int(rng.integers(0, len(w)))
            kind, letter = rng.integers(0, 3), "abzéÿ"[rng.integers(0, 5)]
            w = w[:at] + ([] if kind == 0 else [letter] if kind == 1 else [letter, w[at]]) + w[at + 1:]
        words.append("".join(w))
    return words


ODD = [(None, "Spelling SPELLING spelling Ÿ spellıng"), (900, None), (901, ""), (902, "123 ☃ _"),
       (903, ("L" * 3000 + " ") * 4 + ("l" * 2999 + " ") * 9 + ("l" * 2999 + "m ") * 3), (904, "Écoleÿ " * 8)]


def test_groups_match_all_pairs(spark, monkeypatch):
    words = variants(3, 4000)
    rows = [(i, " ".join(words[i * 40:i * 40 + 40])) for i in range(100)] + ODD + ODD[:1]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = slow_groups(rows)
    assert sum(r[1] is not None for r in expected) > 50 and any(r[1] not in (None, r[2]) for r in expected)
    wide = docs.withColumns({c: F.lit("mine") for c in CLASHES})
    assert groups(spelling.variant_groups(wide)) == expected
    # filters in parts and rounds, few bits (many false positives), many tasks, early spills
    for name, value in [("BROADCAST_BLOCKS", 300), ("BITS_PER_WORD", 4), ("TASK_WORDS", 50), ("COUNTED", 20), ("EDITS", 500)]:
        monkeypatch.setattr(spelling, name, value)
    assert len(spelling.rounds({5: 64, 6: 200, 7: 90})) == 2
    assert groups(spelling.variant_groups(docs)) == expected
    assert spelling.variant_groups(docs.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1 << 20, 64, 5])
def test_runs_do_not_depend_on_slices(monkeypatch, size):
    text = " ".join(variants(4, 200)) + " " + "k" * 500 + "€" + "q" * 70
    whole = spelling.run_counts(text, "17")
    monkeypatch.setattr(spelling, "SLICE_CHARS", size)
    assert spelling.run_counts(text, "17") == whole
    assert sum(whole.values()) == len(re.findall("[A-Za-zÀ-ÿ]+", text))


def test_filters_know_all_their_words():
    words = sorted({w.encode("latin-1") for w in variants(6, 3000) if len(w) == 8})
    (_, letters), = spelling.by_length(words)
    h = spelling.hashes(letters)
    for start, stop in [(0, 640), (0, 300), (300, 640)]:
        shard = spelling.Shard(640, start, stop, 10)
        filters = np.zeros(10 + stop - start, np.uint64)
        for second in (False, True):
            at, bits = spelling.spots_in(shard, h, second)
            np.bitwise_or.at(filters, at[at >= 0], bits[at >= 0])
        first = spelling.spots(h, 640, False)[0]
        assert spelling.probe(filters, shard, h).tolist() == np.nonzero((first >= start) & (first < stop))[0].tolist()


# ------------------------------------------------------------------- divergence
def audit_rows():
    rng = np.random.default_rng(8)
    rows = []
    for i in range(260):
        lang = ["en", "de", None, "x"][i % 4 if i % 8 else 0]
        terms = [f"t{'abcdefgh'[x]}" for x in rng.integers(0, 8, rng.integers(0, 30))]
        rows.append((i, " ".join(terms).upper() if i % 3 else " ".join(terms), lang, [None, "a", "b", "é", "c"][rng.integers(0, 5)]))
    rows += [(300, None, "en", "a"), (301, "", "lonely", "only"), (302, "fewer than ten documents", "few", "p"), (303, None, "few", "q"),
             (304, "ta " * 60_000 + "été Ta9tb", "en", "hot"), (305, "ta tb", "de", "a"), (305, "ta tb", "de", "a")]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_divergences_match_sql(spark, monkeypatch, small):
    rows = audit_rows()
    if small:  # a spill a document, a block for each two sources, sums spilled, passes by language
        for name, value in [("STRIPE_COUNTS", 5), ("SOURCE_BLOCK", 2), ("SUM_BLOCKS", 1), ("GROUPS", 3), ("CELLS", 10)]:
            monkeypatch.setattr(divergence, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    got = divergence.source_divergences(docs.withColumns({c: F.lit("mine") for c in CLASHES})).toPandas()
    exp = oracle("op13_divergence", documents=("doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR", rows))
    ok, why = frames_equal(got, exp)
    assert ok, why
    few = got[got.lang == "few"]
    assert sorted(zip(few.source, few.item, few.value, few["rank"])) == [("p", "q", 0, 1), ("q", "p", 0, 1)]
    assert divergence.source_divergences(docs.limit(0)).count() == 0


def test_merge_joins_keys_across_batches(spark):
    stripes = [("en", "t" if i % 3 else None, 1 if i % 3 else 0, [f"s{i % 4}"], [i]) for i in range(400)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        merged = divergence.merge(spark.createDataFrame(stripes, divergence.STRIPES), 10).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    (term,) = [r for r in merged if r["term"] == "t"]
    assert term["documents"] == sum(1 for i in range(400) if i % 3)
    assert dict(zip(term["sources"], term["counts"])) == {f"s{k}": sum(i for i in range(400) if i % 3 and i % 4 == k) for k in range(4)}


def test_shares_are_exact():
    counts = np.array([0, 1, 10**12, 9 * 10**15 - 3], np.int64)
    for whole in (9 * 10**15 - 1, 10**13 + 7):
        fit = counts[counts + 2 <= whole]
        assert divergence.share(fit, np.int64(whole)).tolist() == [1 + 10**9 * (int(c) + 2) // whole for c in fit]
    p = np.array([10**9 + 1, 5, 1], np.int64)
    assert divergence.gap(p, p[::-1].copy()).tolist() == [(int(a) - int(b))**2 // (int(a) + int(b)) for a, b in zip(p, p[::-1])]
