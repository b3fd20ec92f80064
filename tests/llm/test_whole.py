"""Inputs on which an operator once did less than the whole job."""

import itertools
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.llm.test_operators import groups_by
from wayfare.llm import language, lines, mixing, neighbours, pii, rules, simhash, toxicity
from wayfare.llm.components import connected_components
from wayfare.testing import frames_equal


# -------------------------------------------------------------- quality rules
FOOTER = "\nthe common footer of this host"


@pytest.mark.parametrize("n, share, gone", [(300, 0.0, True), (3000, 0.0, True), (300, 0.01, True), (3000, 0.01, False)])
def test_line_limits_count_documents(spark, n, share, gone):
    """Ten documents with a footer, four of them copies and one without an
    id, lose it, however large their host, unless a share is asked for."""
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    rows = [(i, "hot", own(i) + (FOOTER if i < 6 else "")) for i in range(n)]
    rows += [(n + i, "hot", rows[0][2]) for i in range(3)] + [(None, "hot", rows[0][2])]
    rows += [(n + 10, "hot", None), (n + 11, None, rows[0][2]), (n + 12, "cold", rows[0][2]), (0, "hot", rows[0][2])]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = rules.apply_rules(docs, min_share=share).select(
        "doc_id", *rules.METRICS, "base_failed", "kept", "n_removed_words").toPandas()
    assert (got["n_removed_words"] > 0).sum() == (11 if gone else 0)  # the repeated row counts once and loses it, too
    if share == 0.0:
        con = duckdb.connect()
        con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, text VARCHAR)")
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
        exp = con.sql(E.oracle_sql()["op8_quality_rules"]).df()
        apart = lambda df: df[df.doc_id.notna() & (df.doc_id != 0)]  # noqa: E731  (the SQL joins by id)
        ok, why = frames_equal(apart(got), apart(exp))
        assert ok, why


# ------------------------------------------------------------------- toxicity
def test_toxic_texts_of_any_length_are_learnt(spark):
    """Every toxic text is over 4,000 bytes, with one toxic passage in it."""
    rng = np.random.default_rng(17)
    word = lambda n: " ".join(f"c{x}" for x in rng.integers(0, 60, n))
    rows = [(i, f"{word(450)} {'you vile scum ' * 4} {word(450)}" if i % 4 == 0 else word(int(rng.integers(5, 900)))) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(240)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert min(len(t) for i, t in rows if i % 4 == 0) > 3000
    assert sum(got[i] == int(i % 4 == 0) for i in range(240)) >= 232


def test_windows_are_spaced_over_the_whole_text():
    text = b" ".join(b"w%d" % i for i in range(10_000))
    some = toxicity.windows_of(text, 20)
    assert len(some) == 20 and some[0].startswith(b"w0 ") and some[-1].endswith(b" w9999")
    assert toxicity.windows_of(b"") == [b""] and len(toxicity.windows_of(text, 10**6)) == 417


# -------------------------------------------------------------- personal data
@pytest.mark.parametrize("text, spans", [
    ("Call 415-555-0187, 415-555-0188", ["415-555-0187", "415-555-0188"]),
    ("Call 415-555-0187, 415-555-0188; 212-555-0199.", ["415-555-0187", "415-555-0188", "212-555-0199"]),
    ("4111 1111 1111 1111, 415-555-0187", ["415-555-0187"]),
    ("4111 1111 1111 1111 415-555-0187", []),
    ("(415) 555 0187 (415) 555 0188", ["(415) 555 0187", "(415) 555 0188"]),
])
def test_neighbouring_spans_are_kept_apart(text, spans):
    places = [m.span() for m in re.finditer(r"\S+", text)]
    tags = np.array([0 if text[a:b] == "Call" else pii.KINDS.index("phone") + 1 for a, b in places], np.int8)
    got = pii.added_spans(text, tags, pii.base_spans(text))
    assert [text[a:b] for _, a, b in got] == spans


# ---------------------------------------------------------------- clashing names
INTERNAL = ["_row", "_doc1", "_doc2", "_text", "_host", "_words", "_lines", "_order", "_removed", "_dropped", "_place",
            "_source", "_split", "_inside", "_below", "_body", "_hashes", "_windows", "_tied", "source_no", "base", "extra",
            "count", "k1", "k2", "first", "line", "_k1", "_k2", "_n", "fingerprint_", "k", "_component"]


@pytest.mark.parametrize("apply", [rules.apply_rules, lines.dedup_lines, mixing.mix, simhash.one_of_each_group])
def test_internal_names_are_safe(spark, apply):
    rows = [(i, f"line one of {i % 7}\nand a common line\n" + "some more words " * (i % 5), f"s{i % 3}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plain = apply(docs)
    wide = apply(docs.withColumns({c: F.lit(f"my {c}") for c in INTERNAL}))
    assert set(wide.columns) == set(plain.columns) | set(INTERNAL)
    assert wide.select(*INTERNAL).distinct().collect() == [tuple(f"my {c}" for c in INTERNAL)]
    assert sorted(map(str, wide.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


# ----------------------------------------------------------------- embeddings
def vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")


def numbered(spark, rows):
    nodes = neighbours.classes(vectors(spark, rows), "vec_id", "embedding")
    return nodes.withColumn("node", F.col("least")).cache()


def test_few_links_are_audited_by_planted_copies(spark):
    """No vector of 6,000 is linked: copies of some tell the recall."""
    nodes = numbered(spark, np.random.default_rng(11).normal(0, 1, (6000, 24)))
    plants = neighbours.planted_copies(nodes, 6000, 0.95).withColumn("node", -1 - F.monotonically_increasing_id()).cache()
    n = plants.count()
    assert 150 < n < 400
    found = plants.select("node", F.col("origin").alias("src"), F.lit(0.96).alias("sim"))
    lists = lambda some: some.select("src", F.col("node").alias("dst"), "sim")
    none = spark.createDataFrame([], "node long, n long")
    assert neighbours.audit(nodes, 6000, none, plants, lists(found), 12, 0.95) == (1.0, n)
    half = found.where("node % 2 = 0")
    assert neighbours.audit(nodes, 6000, none, plants, lists(half), 12, 0.95) == (pytest.approx(half.count() / n), n)


def test_isolated_pairs_are_found(spark):
    """Ten near pairs among 8,000 unrelated vectors."""
    rng = np.random.default_rng(15)
    rows = rng.normal(0, 1, (8000, 32))
    rows[7990:] = rows[:10] + rng.normal(0, 0.2, (10, 32)) * 1.2
    linked = {(int(a), int(b)) for a, b in zip(*np.nonzero(neighbours.unit(rows) @ neighbours.unit(rows).T >= 0.95)) if a < b}
    got = {r["vec_id"]: r for r in neighbours.near_duplicates(vectors(spark, rows)).where("n_links > 0").collect()}
    assert len(linked) >= 5 and sum(a in got and b in got for a, b in linked) >= 0.9 * len(linked)
    assert set(got) <= {x for p in linked for x in p}


def test_bounds_hold_for_one_large_component(spark):
    """One component dwarfs the others, which the 8-bit codes then lose."""
    rng = np.random.default_rng(16)
    rows = rng.normal(0, 1, (300, 200))
    rows[:, 0] = 40
    codes, off = neighbours.coded(list(rows))
    x = neighbours.unit(rows)
    gap = np.abs(neighbours.decode(codes) @ neighbours.decode(codes).T - x @ x.T)
    assert (gap <= off[:, None] + off).all() and off.max() > 0.01


def test_recall_below_the_bar_is_an_error(spark, monkeypatch):
    rows = np.random.default_rng(12).normal(0, 1, (40, 16))
    rows[20] = rows[0] * 1.01 + 1e-4
    none = spark.createDataFrame([], neighbours.PAIRS + ", new int")
    monkeypatch.setattr(neighbours, "descend", lambda nodes, *_: (none, nodes.select("node").limit(0)))
    with pytest.raises(RuntimeError, match="recall 0.0000 over 2 vectors"):
        neighbours.near_duplicates(vectors(spark, rows)).count()


@pytest.mark.parametrize("at_once", [4096, 1])
def test_full_lists_lose_no_links_between_groups(spark, monkeypatch, at_once):
    """Each list is filled by its own sub-group; sub-groups are at cosine 0.96.
    With few units at once, groups meet through lists of their first vectors."""
    rng, sizes, descend = np.random.default_rng(13), [], neighbours.descend
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 32)
    monkeypatch.setattr(neighbours, "UNITS_AT_ONCE", at_once)
    monkeypatch.setattr(neighbours, "descend", lambda n, size, *more: sizes.append(size) or descend(n, size, *more))
    axes = np.eye(24)[:4]
    centres = [0.96**0.5 * axes[0] + 0.2 * e for e in axes[1:]]
    rows = [*(c + rng.normal(0, 1e-4, 24) for c in centres for _ in range(80)), *rng.normal(0, 1, (60, 24))]
    got = {r["vec_id"]: r for r in neighbours.near_duplicates(vectors(spark, rows)).collect()}
    assert sizes == [12]
    assert [got[i]["n_links"] for i in range(300)] == [239] * 240 + [0] * 60
    assert [got[i]["component_id"] for i in range(300)] == [0] * 240 + list(range(240, 300))
    assert [i for i in got if not got[i]["kept"]] == list(range(1, 240))


# ------------------------------------------------------------------ languages
def test_rare_languages_are_learnt(spark):
    common, rare = "the dog and the cat that we could see ", "den hund und die katze sehen wir nicht "
    rows = [(i, (rare if i % 400 == 7 else common) * 2, "de" if i % 400 == 7 else "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, rows=40)
    assert model.names == ["de", "en"]
    texts = spark.createDataFrame([(1, rare), (2, common), (3, "could the cat see qqxw zzvk")], "doc_id long, text string")
    assert [r["lang_pred"] for r in language.identify(texts, model).orderBy("doc_id").collect()] == ["de", "en", "en"]


# -------------------------------------------------------------------- simhash
@pytest.mark.parametrize("limit", [1, 2, 3])
def test_links_across_blocks_use_the_limit(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "BLOCKS", 16)
    rng = np.random.default_rng(14)
    codes = [0x2A5 << 40 | int(c) for c in rng.integers(0, 1 << 24, 40)]
    codes += [c ^ ((1 << limit) - 1 << 59) for c in codes]  # partners differ in bits that their blocks share
    found = simhash.links(spark.createDataFrame([(c,) for c in sorted(codes)], "code bigint"), limit)
    got = {r["node"]: r["component"] for r in connected_components(found).collect()}
    close = lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= limit
    expected = groups_by(sorted(codes), [(a, b) for a, b in itertools.combinations(sorted(codes), 2) if close(a, b)])
    assert {c: got.get(c, c) for c in codes} == expected
