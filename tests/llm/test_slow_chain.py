"""Toxicity scores word by word, and the pipeline against brute force."""

import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tests.llm.test_operators import groups_by, slow_fingerprint, slow_targets
from tests.llm.test_slow_versions import slow_score
from wayfare.llm import mixing, packing, quality, toxicity


# ------------------------------------------------------------------- toxicity
def slow_grams(word):
    """Rows of a word's 3-grams and 4-grams; one of a word without letters."""
    body = b"^" + word + b"$"
    row = lambda n: (n % 2**32 * 2654435761 % 2**32 >> 16) % toxicity.NGRAM_ROWS
    rows = []
    for at in range(max(1, len(body) - 2)):
        a, b, c = (body + b"\0")[at:at + 3]
        three = a * 40503 + b * 10007 + c * 31
        rows.append(row(three))
        if at + 4 <= len(body):
            rows.append(row(three + body[at + 3] * 65599 + 17))
    return rows


class SlowRecurrent:
    """The network on one window, word after word in double precision."""

    def __init__(self, model):
        self.w = {k: v.astype(np.float64) for k, v in model.w.items()}
        self.vocabulary, self.known = model.vocabulary, {}

    def gates(self, word):
        if word not in self.known:
            bare = toxicity.plain(word)
            x = np.concatenate([self.w["words"][self.vocabulary.get(bare, 0)], self.w["grams"][slow_grams(bare)].mean(0)])
            self.known[word] = {way: x @ self.w[f"{way}_in"] + self.w[f"{way}_in0"] for way in ("fore", "back")}
        return self.known[word]

    def read(self, words, way):
        n, h, out = toxicity.HIDDEN, np.zeros(toxicity.HIDDEN), []
        for word in words:
            a, b = self.gates(word)[way], h @ self.w[f"{way}_re"] + self.w[f"{way}_re0"]
            z, r = np.split(1 / (1 + np.exp(-(a + b)[:2 * n])), 2)
            c = np.tanh(a[2 * n:] + r * b[2 * n:])
            h = z * h + (1 - z) * c
            out.append(h)
        return out

    def logit(self, words):
        if not words:
            return self.w["out0"][0]
        states = np.hstack([self.read(words, "fore"), self.read(words[::-1], "back")[::-1]])
        weights = np.exp(np.tanh(states @ self.w["attend"] + self.w["attend0"]) @ self.w["weigh"])
        return np.average(states, axis=0, weights=weights) @ self.w["out"] + self.w["out0"][0]

    def score(self, text):
        words, starts = text.split(), [0]
        while starts[-1] + toxicity.WINDOW_WORDS < len(words):
            starts.append(starts[-1] + toxicity.STRIDE)
        return 1 / (1 + math.exp(-max(self.logit(words[s:s + toxicity.WINDOW_WORDS]) for s in starts)))


@pytest.mark.parametrize("n", [0, 1, 8, 9, 31, 32, 33, 55, 56, 57, 80, 81])
def test_windows_cover_every_word(n):
    start, size, first = toxicity.cut(np.array([n, 0, n]))
    seen = Counter(w for s, k in zip(start[:first[1]], size[:first[1]]) for w in range(s, s + k))
    assert set(seen) == set(range(n)) and max(seen.values(), default=1) <= 2
    assert len(start) == 2 * first[1] + 1 and size[first[1]] == 0


def test_toxicity_query_matches_slow_scores(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    slow = SlowRecurrent(toxicity.train(docs, spark.read.parquet(f"{SF001}/labels.parquet")))
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    got = E.queries()["op4_toxicity_gru"](spark, SF001).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        assert r["score"] == pytest.approx(slow.score(texts[r["doc_id"]]), abs=2e-4)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.5)


# ------------------------------------------------------------------- pipeline
def slow_lines(texts, least=10):
    """Texts less the lines whose key is in ``least`` documents or more."""
    split = {i: [(line, line.strip(b" \t\n\x0b\x0c\r").lower()) for line in t.split(b"\n")] for i, t in texts.items()}
    held = Counter(k for lines in split.values() for k in {key for _, key in lines})
    return {i: b"\n".join(line for line, key in lines if not key or held[key] < least) for i, lines in split.items()}


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = quality.train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    scores = {i: slow_score(model, (r["text"] or "").encode()) for i, r in rows.items()}
    assert all(abs(s - 0.3) > 2e-4 for s in scores.values())  # no score is too near the limit to tell
    good = {i: (rows[i]["text"] or "").encode() for i, s in scores.items() if s > 0.3}
    texts = {i: t.decode() for i, t in slow_lines(good).items()}
    codes = {i: slow_fingerprint(t) for i, t in texts.items()}
    linked = [(a, b) for a, b in itertools.combinations(codes, 2) if (codes[a] ^ codes[b]).bit_count() <= 2]
    texts = {i: texts[i] for i, least in groups_by(list(codes), linked).items() if i == least}
    assert 0 < len(texts) < len(good) < len(rows)

    packed = defaultdict(Counter)
    places = E.queries()["pipeline"](spark, SF001).toPandas()
    for r in places.itertuples():
        packed[r.doc_id][r.piece, r.n_tokens, r.text] += 1
    # documents are whole, once or twice, and no other document is there
    copies = Counter()
    for i, found in packed.items():
        cut = packing.cut(texts[i].encode(), packing.MAX_TOKENS)
        copies[i] = found.total() // len(cut)
        assert copies[i] in (1, 2)
        assert found == Counter({(k, n, t.decode()): copies[i] for k, (n, t) in enumerate(cut)})
    # what each source has comes near its target
    size = {i: len(t.encode().split()) for i, t in texts.items()}
    words, taken = Counter(), Counter()
    for i, n in size.items():
        words[rows[i]["source"]] += n
        taken[rows[i]["source"]] += n * copies[i]
    for name, target in slow_targets(words).items():
        assert abs(taken[name] - target) <= 1 + 0.02 * target
    # and is what the mix of the documents that brute force keeps takes
    kept = spark.createDataFrame([(i, rows[i]["source"], t) for i, t in texts.items()], "doc_id long, source string, text string")
    assert {r["doc_id"]: r["repeats"] for r in mixing.mix(kept).collect()} == {i: copies[i] for i in texts}
    # buckets with the least padding, and full batches but for the last
    lengths, counts = np.unique(places["n_tokens"], return_counts=True)
    bounds = np.array(packing.bucket_bounds(lengths.astype(np.int64), counts, packing.BUCKETS))
    assert (bounds[np.searchsorted(bounds, places["n_tokens"])] == places["bucket_len"]).all()
    for bucket, part in places.groupby("bucket_len"):
        room = max(1, packing.BATCH_TOKENS // max(1, bucket))
        assert sorted(part["batch"] * room + part["slot"]) == list(range(len(part)))
        assert part["slot"].max() < room
