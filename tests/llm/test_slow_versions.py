"""Whole queries and long texts against slow versions of their methods."""

import hashlib
import math
import zlib

import numpy as np
import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tests.llm.test_operators import regex_spans, slow_fingerprint
from wayfare.llm import quality, simhash

LABELS = "doc_id long, quality int"


# ---------------------------------------------------------- quality classifier
def slow_passages(text):
    """Features of each passage, from the definition and word by word."""
    words = text.split()
    table = quality._byte_classes()
    rows = []
    for at in range(0, max(1, len(words)), quality.PASSAGE_WORDS):
        part = words[at:at + quality.PASSAGE_WORDS]
        row = np.zeros(quality.CLASSES + 5)
        for byte in b"".join(part):
            row[table[byte]] += table[byte] > 0
        row /= max(1, row.sum())
        if part:
            shout = [w for w in part if sum(65 <= b <= 90 for b in w) > 1 and not any(97 <= b <= 122 for b in w)]
            row[quality.CLASSES:] = [sum(map(len, part)) / len(part) / 10, len(shout) / len(part),
                                     sum(a == b for a, b in zip(part, part[1:])) / len(part),
                                     len(set(part)) / len(part), len(part) / quality.PASSAGE_WORDS]
        rows.append(row)
    return np.array(rows)


def slow_score(model, text):
    """Gated attention over the passages of one text, passage by passage."""
    w = {k: v.astype(np.float64) for k, v in model.w.items()}
    hidden, weights = [], []
    for row in slow_passages(text):
        x = np.clip((row - model.mean) / model.scale, -8, 8)
        h = np.tanh(x @ w["encode"] + w["encode0"])
        gate = 1 / (1 + np.exp(-(h @ w["gate"] + w["gate0"])))
        weights.append(math.exp(np.tanh(h @ w["tanh"] + w["tanh0"]) * gate @ w["weigh"]))
        hidden.append(h)
    z = np.average(hidden, axis=0, weights=weights)
    return 1 / (1 + math.exp(-(z @ w["score"] + w["score0"][0])))


ODD = [b"", b" \n\t", b"One", b"  AB AB ab Ab 12 \x01 \xc3\xa9t\xc3\xa9 (x) #", b"same " * 200,
       b" ".join(b"W%d" % (i % 70) for i in range(1000)), b"long" * 500 + b" and " * 70]


def test_passages_match_their_definition():
    x, first = quality.encode(ODD)
    for text, s, e in zip(ODD, first, [*first[1:], len(x)]):
        np.testing.assert_allclose(x[s:e], slow_passages(text), atol=1e-5)


@pytest.mark.parametrize("size", [40, 700, 5000])
def test_long_texts_are_encoded_in_pieces(size):
    whole, pieces = quality.encode(ODD * 2), quality.encode(ODD * 2, size)
    for a, b in zip(whole, pieces):
        np.testing.assert_array_equal(a, b)
    assert b"".join(quality.pieces(ODD[5], size)) == ODD[5]
    assert quality.encode([])[0].shape == (0, quality.CLASSES + 5)


def test_quality_query_matches_slow_scores(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    model = quality.train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    got = E.queries()["op1_quality_mil"](spark, SF001).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        assert r["score"] == pytest.approx(slow_score(model, texts[r["doc_id"]]), abs=2e-4)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.3)


def test_a_rare_class_is_learnt(spark):
    """One bad text in a hundred, and fewer rows to learn from than texts."""
    rng = np.random.default_rng(5)
    good = lambda: " ".join("abcdefgh"[:int(n)] for n in rng.integers(2, 9, 120))
    rows = [(i, "#### 00 || %% 11 " * 40 if i % 100 == 7 else good()) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 100 != 7)) for i, _ in rows], LABELS)
    got = quality.score(docs, quality.train(docs, labels, rows=60)).collect()
    assert sum(r["predicted"] == int(r["doc_id"] % 100 != 7) for r in got) == len(rows)


# --------------------------------------------------------------------- SimHash
@pytest.mark.parametrize("size", [1, 9, 64, 1 << 20])
def test_fingerprints_do_not_depend_on_slices(size):
    rng = np.random.default_rng(3)
    texts = ["", " \n ", "One", "Two words", "a b c", "a" * 300 + " b", "Ärger\x0bMIT Ümlaut \t und  mehr",
             " ".join(f"W{x}" for x in rng.integers(0, 40, 700))]
    for text in texts:
        assert simhash.fingerprint(text.encode(), size=size) == slow_fingerprint(text)
    for width in (1, 2, 5):
        for text in texts:
            assert simhash.fingerprint(text.encode(), width, size) == simhash.fingerprint(text.encode(), width)


# ------------------------------------------------------------------------- PII
def test_personal_data_query_matches_the_patterns(spark):
    kinds = ["email", "ip", "card", "phone"]
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = E.queries()["op3_personal_data"](spark, SF001).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        base = sorted(regex_spans(texts[r["doc_id"]]), key=lambda s: (kinds.index(s[0]), s[1]))
        listed = [f"{k}:{s}:{e}" for k, s, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        spans = [tuple(x.split(":")) for x in r["spans"].split(",") if x]
        assert set(listed) <= {":".join(x) for x in spans}
        assert spans == sorted(spans, key=lambda x: (kinds.index(x[0]), int(x[1])))
        counts = [len([x for x in spans if x[0] == k]) for k in kinds]
        assert len(spans) - len(base) == r["n_added"]
        own = [r[f"n_{k}"] for k in kinds]
        assert own in (counts, [sum(b[0] == k for b in base) for k in kinds])
