"""Quality classifier: attention-based multiple-instance learning.

A text is a bag of passages. Every passage is encoded from its characters and
words, gated attention learnt from the document labels weighs the passages,
and the weighted passage representation is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import Adam, append_columns, labelled_ids, labelled_sample, row_slices, sigmoid, texts_as_bytes

PASSAGE_WORDS = 64
# Labelled documents to learn from, and passages of each (evenly spaced).
SAMPLE_ROWS = 3000
SAMPLE_PASSAGES = 48
THRESHOLD = 0.3
# Texts encoded at once; encoding needs about thirty times as much memory.
BATCH_BYTES = 2 << 20
HIDDEN, ATTENTION = 16, 8
EPOCHS, RATE, SEED = 150, 0.03, 42

# Byte classes: letters, digits, bytes of other letters, then signs one by one.
SIGNS = b".,;:!?|#$%&*<>()[]{}\"'-_/\\@=+~^`"
CLASSES = 5 + len(SIGNS)


def _byte_classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)  # 0: spaces and control bytes
    table[ord("a"):ord("z") + 1] = 1
    table[ord("A"):ord("Z") + 1] = 2
    table[ord("0"):ord("9") + 1] = 3
    table[128:] = 4
    for i, sign in enumerate(SIGNS):
        table[sign] = 5 + i
    return table


def pieces(text: bytes, size: int) -> Iterator[bytes]:
    """``text`` in pieces of whole passages and about ``size`` bytes; one is
    longer only where a single passage is. All but the first begin at a word."""
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    at, ahead = 0, size
    while len(text) - at > ahead:
        space = blank[np.frombuffer(text, np.uint8, ahead, at)]
        starts = np.nonzero(~space & np.concatenate([[True], space[:-1]]))[0]
        whole = (len(starts) - 1) // PASSAGE_WORDS * PASSAGE_WORDS
        if whole > 0:
            yield text[at:at + int(starts[whole])]
            at, ahead = at + int(starts[whole]), size
        else:
            ahead *= 2
    yield text[at:]


def encode(texts: list[bytes], size: int = BATCH_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every text, and each text's first row.

    Passages do not depend on one another, so at most about ``size`` bytes are
    encoded at once: short texts together, a longer one piece by piece.
    """
    parts: list[np.ndarray] = [np.zeros((0, CLASSES + 5), np.float32)]
    first, rows, held, held_bytes = [], 0, [], 0
    for text in texts:
        if held and held_bytes + len(text) > size:
            x, starts = _encode(held)
            parts.append(x)
            first += (starts + rows).tolist()
            rows, held, held_bytes = rows + len(x), [], 0
        if len(text) <= size:
            held.append(text)
            held_bytes += len(text)
            continue
        first.append(rows)
        for piece in pieces(text, size):
            parts.append(_encode([piece])[0])
            rows += len(parts[-1])
    if held:
        x, starts = _encode(held)
        parts.append(x)
        first += (starts + rows).tolist()
    return np.concatenate(parts), np.array(first, np.int64)


def _encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Shares of byte classes, mean word length, words in capitals, words equal
    to the one before in their passage, distinct words, and how full the
    passage is. A text without words is one passage of zeros.
    """
    body = np.frombuffer(b"".join(t + b"\n" for t in texts) or b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    table = _byte_classes()
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    space = blank[body]
    begins = ~space & np.concatenate([[True], space[:-1]])
    starts = np.nonzero(begins)[0]
    stops = np.nonzero(space & np.concatenate([[False], ~space[:-1]]))[0]
    owner = np.searchsorted(ends, starts, side="right")
    words = np.bincount(owner, minlength=len(texts))
    first_word = np.cumsum(words) - words
    place = np.arange(len(starts)) - first_word[owner]
    passages = np.maximum(1, -(-words // PASSAGE_WORDS))
    first = np.cumsum(passages) - passages
    total = int(passages.sum())
    row = first[owner] + place // PASSAGE_WORDS
    out = np.zeros((total, CLASSES + 5), np.float32)
    if not len(starts):
        return out, first
    kinds = table[body]
    # every byte belongs to the word begun last (those before any, to the first)
    word_no = np.maximum(np.cumsum(begins, dtype=np.int32) - 1, 0)
    cell = (row * CLASSES).astype(np.int32)[word_no]
    cell += kinds
    out[:, :CLASSES] = np.bincount(cell, minlength=total * CLASSES).reshape(total, CLASSES)
    out[:, 0] = 0
    n_bytes = out[:, :CLASSES].sum(1, keepdims=True)
    out[:, :CLASSES] /= np.maximum(n_bytes, 1)
    n_words = np.bincount(row, minlength=total)
    lower = np.add.reduceat((kinds == 1).astype(np.int32), starts)
    upper = np.add.reduceat((kinds == 2).astype(np.int32), starts)
    # a hash of each word: its bytes weighted by their place (modulo 64)
    weight = np.random.default_rng(SEED).integers(1, 1 << 40, 64, dtype=np.uint64)
    at = np.arange(len(body), dtype=np.int32) - starts.astype(np.int32)[word_no]
    at &= 63
    term = weight[at]
    term *= body
    term[space] = 0
    code = np.add.reduceat(term, starts)
    same = np.concatenate([[False], (code[1:] == code[:-1]) & (row[1:] == row[:-1])])
    order = np.lexsort((code, row))
    r, c = row[order], code[order]
    fresh = np.concatenate([[True], (r[1:] != r[:-1]) | (c[1:] != c[:-1])])
    distinct = np.bincount(r[fresh], minlength=total)
    some = np.maximum(n_words, 1)
    out[:, CLASSES] = np.bincount(row, stops - starts, total) / some / 10
    out[:, CLASSES + 1] = np.bincount(row, (upper > 1) & (lower == 0), total) / some
    out[:, CLASSES + 2] = np.bincount(row, same, total) / some
    out[:, CLASSES + 3] = distinct / some
    out[:, CLASSES + 4] = n_words / PASSAGE_WORDS
    return out, first


class GatedAttention:
    """Passage encoder, gated attention and document score."""

    def __init__(self, features: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
        self.w = {"encode": draw(features, HIDDEN), "encode0": np.zeros(HIDDEN, np.float32),
                  "tanh": draw(HIDDEN, ATTENTION), "tanh0": np.zeros(ATTENTION, np.float32),
                  "gate": draw(HIDDEN, ATTENTION), "gate0": np.zeros(ATTENTION, np.float32),
                  "weigh": draw(ATTENTION), "score": draw(HIDDEN), "score0": np.zeros(1, np.float32)}
        self.mean, self.scale = np.zeros(features, np.float32), np.ones(features, np.float32)

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        w = self.w
        bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
        h = np.tanh(x @ w["encode"] + w["encode0"])
        t = np.tanh(h @ w["tanh"] + w["tanh0"])
        s = sigmoid(h @ w["gate"] + w["gate0"])
        e = (t * s) @ w["weigh"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return {"bag": bag, "h": h, "t": t, "s": s, "a": a, "z": z, "p": sigmoid((z @ w["score"] + w["score0"]).astype(np.float64))}

    def normal(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def fit(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> GatedAttention:
        """Learn the bags' labels ``y``; a bag of ``weight`` 2 counts as two."""
        weight = np.ones(len(y)) if weight is None else weight
        share = (weight / weight.sum()).astype(np.float32)
        self.mean, self.scale = x.mean(0), x.std(0) + 0.01
        x, w, y = self.normal(x).astype(np.float32), self.w, y.astype(np.float32)
        adam = Adam(w, RATE)
        for _ in range(EPOCHS):
            f = self.forward(x, first)
            bag, h, t, s, a = (f[k] for k in ("bag", "h", "t", "s", "a"))
            miss = ((f["p"] - y) * share).astype(np.float32)
            dz = miss[:, None] * w["score"]
            da = (h * dz[bag]).sum(1)
            de = a * (da - np.add.reduceat(a * da, first)[bag])
            dg = de[:, None] * w["weigh"]
            dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
            dh = (a[:, None] * dz[bag] + dt @ w["tanh"].T + ds @ w["gate"].T) * (1 - h * h)
            grads = {"encode": x.T @ dh, "encode0": dh.sum(0), "tanh": h.T @ dt, "tanh0": dt.sum(0),
                     "gate": h.T @ ds, "gate0": ds.sum(0), "weigh": (t * s).T @ de,
                     "score": f["z"].T @ miss, "score0": miss.sum(keepdims=True)}
            adam.update({k: g + 1e-4 * w[k] for k, g in grads.items()})
        return self

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x, first = encode(texts)
        return self.forward(self.normal(x), first)["p"]


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
          rows: int = SAMPLE_ROWS) -> GatedAttention:
    """Learn from at most ``rows`` labelled documents (crc32 modulo 5 not 0).

    At most half of them come from either class, so that a rare one is learnt
    too; a document weighs as many labelled ones as it stands for, so scores
    keep to the shares of the classes. Passages are encoded in tasks; the
    driver gets numbers, no texts, at most ``SAMPLE_PASSAGES`` rows a document.
    Without labels every score is 0.5.
    """
    sample = labelled_sample(docs, labels, label, rows, doc_id, per_class=True, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in row_slices(whole, BATCH_BYTES)):
            texts = texts_as_bytes(batch.column(0))
            x, first = encode(texts)
            lists = []
            for s, e in zip(first, [*first[1:], len(x)]):
                rows_ = np.unique(np.linspace(s, e - 1, min(e - s, SAMPLE_PASSAGES)).astype(int))
                lists.append(x[rows_].ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(lists, pa.list_(pa.float32()))],
                names=["chance", "label", "x"])

    got = (sample.select(text, F.xxhash64(doc_id, text).alias("chance"), F.col("label").cast("double"))
           .mapInArrow(run, "chance bigint, label double, x array<float>")
           .orderBy("chance").limit(rows).toArrow())
    model = GatedAttention(CLASSES + 5)
    y = got["label"].to_numpy()
    if not len(y):
        model.w = {k: np.zeros_like(v) for k, v in model.w.items()}
        return model
    bags = [np.asarray(v, np.float32).reshape(-1, CLASSES + 5) for v in got["x"].to_pylist()]
    first = np.cumsum([0, *map(len, bags[:-1])])
    good, bad = (labelled_ids(labels, label, doc_id)
                 .agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first())
    ones = max(1, int(y.sum()))
    weight = np.where(y == 1, max(good, 1) / ones, max(bad, 1) / max(1, len(y) - ones))
    return model.fit(np.concatenate(bags), first, y, weight)


def score(docs: DataFrame, model: GatedAttention, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from
    ``threshold`` on). Whole texts are scored, very long ones encoded piece by
    piece; null and empty texts are one passage of zeros. Equal texts get equal
    scores but for rounding in single precision; an empty table gives an
    empty table; columns of the input with these names give way."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            p = model.score(texts_as_bytes(batch.column(batch.schema.get_field_index(text))))
            yield [pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))]

    return append_columns(docs, T.StructType([T.StructField("score", T.DoubleType()),
                                              T.StructField("predicted", T.IntegerType())]), make, BATCH_BYTES)
