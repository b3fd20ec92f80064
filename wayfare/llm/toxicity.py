"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word enters as the sum of two parts: an embedding of the word (if learnt)
and the mean embedding of its character n-grams. Forward and backward gated
recurrent units read windows of words, attention pools their states, and a
text scores as its most toxic window.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import Adam, WordIds, append_columns, labelled_sample, ngrams, row_slices, sigmoid, texts_as_bytes

WINDOW_WORDS, STRIDE = 32, 24
THRESHOLD = 0.5
# Labelled documents to learn from (half toxic, if there are as many), of any
# length, and windows of each, evenly spaced over its whole text.
SAMPLE_ROWS, SAMPLE_WINDOWS = 2400, 128
EMBED, HIDDEN, ATTENTION = 6, 6, 6
NGRAM_ROWS = 1 << 13
MIN_WORD_TEXTS = 3
STEPS, BATCH_TEXTS, RATE, SEED = 160, 96, 0.02, 42
# Distinct words whose inputs a task remembers, and words and windows at once.
KNOWN_WORDS, WORDS_AT_ONCE, WINDOWS_AT_ONCE = 250_000, 20_000, 2048
EDGE_SIGNS = b".,;:!?|#$%&*<>()[]{}\"'-_/\\=+~^`"


def plain(word: bytes) -> bytes:
    return word.lower().strip(EDGE_SIGNS)


def cut(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, first): overlapping windows that cover texts of so many
    words, one text after the other, and each text's first window. A text
    without words has one empty window."""
    counts = np.maximum(1, -(-(lengths - (WINDOW_WORDS - STRIDE)) // STRIDE))
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(lengths)), counts)
    step = (np.arange(len(owner)) - first[owner]) * STRIDE
    base = np.cumsum(lengths) - lengths
    return base[owner] + step, np.minimum(WINDOW_WORDS, lengths[owner] - step), first


def to_ids(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts as rows of word ids (0: no word), and each text's
    first row."""
    start, size, first = cut(lengths)
    place = np.arange(WINDOW_WORDS)
    ids = np.append(flat, 0).take(start[:, None] + place, mode="clip")
    ids[place >= size[:, None]] = 0
    return ids, first


class Recurrent:
    """The network and its training, in numpy."""

    def __init__(self, vocabulary: dict[bytes, int], seed: int = SEED):
        self.vocabulary = vocabulary  # row 0: any other word
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        flat = lambda *shape: np.zeros(shape, np.float32)
        self.w = {"words": draw(0.05, len(vocabulary) + 1, EMBED), "grams": draw(0.05, NGRAM_ROWS, EMBED)}
        for way in ("fore", "back"):
            self.w |= {f"{way}_in": draw((2 * EMBED) ** -0.5, 2 * EMBED, 3 * HIDDEN), f"{way}_in0": flat(3 * HIDDEN),
                       f"{way}_re": draw(HIDDEN**-0.5, HIDDEN, 3 * HIDDEN), f"{way}_re0": flat(3 * HIDDEN)}
        self.w |= {"attend": draw((2 * HIDDEN) ** -0.5, 2 * HIDDEN, ATTENTION), "attend0": flat(ATTENTION),
                   "weigh": draw(ATTENTION**-0.5, ATTENTION), "out": draw((2 * HIDDEN) ** -0.5, 2 * HIDDEN), "out0": flat(1)}

    def inputs(self, words: list[bytes]) -> dict:
        """What the embeddings of distinct words are made of."""
        known = [plain(x) for x in words]
        rows = np.array([self.vocabulary.get(x, 0) for x in known], np.int64)
        grams, counts = ngrams(known, NGRAM_ROWS) if known else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return {"rows": rows, "grams": grams, "starts": np.cumsum(counts) - counts, "counts": counts}

    def embed(self, parts: dict) -> np.ndarray:
        if not len(parts["rows"]):
            return np.zeros((0, 2 * EMBED), np.float32)
        grams = np.add.reduceat(self.w["grams"][parts["grams"]], parts["starts"], axis=0)
        return np.concatenate([self.w["words"][parts["rows"]], grams / parts["counts"][:, None]], axis=1).astype(np.float32)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Inputs of the gates, (direction, word, gate); word 0 is none."""
        gates = np.zeros((2, len(x) + 1, 3 * HIDDEN), np.float32)
        for k, way in enumerate(("fore", "back")):
            gates[k, 1:] = x @ self.w[f"{way}_in"] + self.w[f"{way}_in0"]
        return gates

    def read(self, gates: np.ndarray, ids: np.ndarray, way: str, states: np.ndarray, keep: list | None = None) -> None:
        """Fill states (time, window, HIDDEN) of one direction; words of id 0
        leave the state as it is."""
        re, re0 = self.w[f"{way}_re"], self.w[f"{way}_re0"]
        gates = gates[0 if way == "fore" else 1]
        by_time = np.ascontiguousarray(ids.T)
        h = np.zeros((len(ids), HIDDEN), np.float32)
        for t in range(len(by_time)) if way == "fore" else range(len(by_time) - 1, -1, -1):
            a = gates.take(by_time[t], axis=0)
            b = h @ re
            b += re0
            zr = a[:, :2 * HIDDEN] + b[:, :2 * HIDDEN]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = r * b[:, 2 * HIDDEN:]
            c += a[:, 2 * HIDDEN:]
            np.tanh(c, out=c)
            new = h - c
            new *= z
            new += c
            live = None
            if not by_time[t].all():
                live = (by_time[t] > 0)[:, None]
                new = np.where(live, new, h)
            if keep is not None:
                keep.append((t, h, z, r, c, b[:, 2 * HIDDEN:], np.bool_(True) if live is None else live))
            h = states[t] = new

    def states(self, gates: np.ndarray, ids: np.ndarray, kept: dict | None = None) -> np.ndarray:
        out = np.empty((ids.shape[1], len(ids), 2 * HIDDEN), np.float32)
        self.read(gates, ids, "fore", out[:, :, :HIDDEN], kept and kept["fore"])
        self.read(gates, ids, "back", out[:, :, HIDDEN:], kept and kept["back"])
        return out

    def pool(self, states: np.ndarray, ids: np.ndarray) -> dict:
        live = (ids.T > 0)
        u = np.tanh(states @ self.w["attend"] + self.w["attend0"])
        e = np.where(live, u @ self.w["weigh"], np.float32(-1e9))
        e = np.exp(e - e.max(0)) * live
        a = e / np.maximum(e.sum(0), np.float32(1e-9))
        c = (a[:, :, None] * states).sum(0)
        return {"u": u, "a": a, "c": c, "logit": c @ self.w["out"] + self.w["out0"]}

    def logits(self, gates: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = [np.zeros(0, np.float32)]
        for s in range(0, len(ids), WINDOWS_AT_ONCE):
            part = ids[s:s + WINDOWS_AT_ONCE]
            out.append(self.pool(self.states(gates, part), part)["logit"])
        return np.concatenate(out)

    def gradients(self, parts: dict, x: np.ndarray, ids: np.ndarray, y: np.ndarray) -> dict:
        """Of the mean cross-entropy of windows ``ids`` with labels ``y``."""
        w, gates = self.w, self.project(x)
        kept: dict[str, list] = {"fore": [], "back": []}
        states = self.states(gates, ids, kept)
        p = self.pool(states, ids)
        miss = (sigmoid(p["logit"]) - y).astype(np.float32) / len(y)
        g = {"out": p["c"].T @ miss, "out0": miss.sum(keepdims=True)}
        dc = miss[:, None] * w["out"]
        da = (states * dc).sum(2)
        de = p["a"] * (da - (p["a"] * da).sum(0))
        du = de[:, :, None] * w["weigh"] * (1 - p["u"] ** 2)
        g |= {"weigh": np.einsum("tna,tn->a", p["u"], de), "attend": np.einsum("tnh,tna->ha", states, du),
              "attend0": du.sum((0, 1))}
        dstates = p["a"][:, :, None] * dc + du @ w["attend"].T
        dgates = np.zeros_like(gates)
        for k, way in enumerate(("fore", "back")):
            re = w[f"{way}_re"]
            dre, dre0 = np.zeros_like(re), np.zeros(3 * HIDDEN, np.float32)
            din = np.empty((ids.shape[1], len(ids), 3 * HIDDEN), np.float32)
            dh = np.zeros((len(ids), HIDDEN), np.float32)
            for t, h, z, r, c, bc, live in reversed(kept[way]):
                dh = dh + dstates[t, :, k * HIDDEN:(k + 1) * HIDDEN]
                d = np.where(live, dh, 0)
                dz, dcand = d * (h - c) * z * (1 - z), d * (1 - z) * (1 - c * c)
                dr = dcand * bc * r * (1 - r)
                din[t] = np.concatenate([dz, dr, dcand], axis=1)
                db = np.concatenate([dz, dr, dcand * r], axis=1)
                dre += h.T @ db
                dre0 += db.sum(0)
                dh = np.where(live, d * z + db @ re.T, dh)
            g |= {f"{way}_re": dre, f"{way}_re0": dre0}
            dgates[k] = sum_rows(ids.T.ravel(), din.reshape(-1, 3 * HIDDEN), dgates.shape[1])
        dx = np.zeros_like(x)
        for k, way in enumerate(("fore", "back")):
            d = dgates[k, 1:]
            g |= {f"{way}_in": x.T @ d, f"{way}_in0": d.sum(0)}
            dx += d @ w[f"{way}_in"].T
        g["words"] = sum_rows(parts["rows"], dx[:, :EMBED], len(w["words"]))
        each = np.repeat(dx[:, EMBED:] / parts["counts"][:, None], parts["counts"], axis=0)
        g["grams"] = sum_rows(parts["grams"], each, NGRAM_ROWS)
        return g


def sum_rows(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows that go to each of ``n`` places."""
    return np.stack([np.bincount(at, c, n) for c in rows.T], axis=1).astype(np.float32)


def subset(parts: dict, words: np.ndarray) -> dict:
    """The inputs of some of the words."""
    counts = parts["counts"][words]
    starts = np.cumsum(counts) - counts
    grams = np.repeat(parts["starts"][words] - starts, counts) + np.arange(counts.sum())
    return {"rows": parts["rows"][words], "grams": parts["grams"][grams], "starts": starts, "counts": counts}


def windows_of(text: bytes, most: int = SAMPLE_WINDOWS) -> list[bytes]:
    """The overlapping windows of a text, or ``most`` of them, evenly spaced
    from the first to the last."""
    words = text.split()
    start, size, _ = cut(np.array([len(words)]))
    pick = np.arange(len(start)) if len(start) <= most else np.linspace(0, len(start) - 1, most).astype(int)
    return [b" ".join(words[start[i]:start[i] + size[i]]) for i in pick]


def fit(texts: list[list[bytes]], y: np.ndarray, seed: int = SEED) -> Recurrent:
    """Train on the windows of texts: in every step the windows that now score highest
    stand for their texts (two for texts that are not toxic)."""
    bags = [[w.split() for w in windows] for windows in texts]
    split = [[x for w in bag for x in w] for bag in bags]
    names = {x: i for i, x in enumerate(sorted(set(chain.from_iterable(split))))}
    lengths = np.array([len(x) for x in split], np.int64)
    flat = np.fromiter((names[x] for x in chain.from_iterable(split)), np.int64)
    plains = sorted({plain(x) for x in names})
    number = {x: i for i, x in enumerate(plains)}
    of_plain = np.array([number[plain(x)] for x in names], np.int64)
    # texts of either label that have a word or an n-gram
    owner = np.repeat(np.arange(len(texts)), lengths)
    pairs = np.unique(owner * len(plains) + of_plain[flat]) if len(flat) else flat
    label = y.astype(np.int64)
    seen = np.zeros((len(plains), 2))
    np.add.at(seen, (pairs % max(1, len(plains)), label[pairs // max(1, len(plains))]), 1)
    frequent = np.nonzero(seen.sum(1) >= MIN_WORD_TEXTS)[0]
    model = Recurrent({plains[i]: k + 1 for k, i in enumerate(frequent.tolist())}, seed)
    if not len(y) or y.min() == y.max():
        model.w["out"][:] = 0
        model.w["out0"][:] = 0 if not len(y) else (4 if y[0] else -4)
        return model
    # a first guess of every embedding's first place: log odds by label
    total = np.bincount(label, minlength=2)
    odds = lambda n: np.log((n[:, 1] + 0.5) / (total[1] + 1)) - np.log((n[:, 0] + 0.5) / (total[0] + 1))
    model.w["words"][1:, 0] = np.clip(odds(seen[frequent]), -4, 4) / 2
    parts = model.inputs(list(names))
    of_gram = np.zeros((NGRAM_ROWS, 2))
    for words, k in zip(np.split(flat, np.cumsum(lengths)[:-1]), label):
        of_gram[np.unique(subset(parts, np.unique(words))["grams"]), k] += 1
    model.w["grams"][:, 0] = np.clip(odds(of_gram), -4, 4)

    rng = np.random.default_rng(seed)
    adam = Adam(model.w, RATE)
    by_class = [np.nonzero(label == c)[0] for c in (0, 1)]
    counts = np.array([len(bag) for bag in bags])
    ids = np.zeros((counts.sum(), WINDOW_WORDS), np.int64)
    for row, words in zip(ids, chain.from_iterable(bags)):
        row[:len(words)] = [names[x] + 1 for x in words]
    first = np.cumsum(counts) - counts
    stops = first + counts
    for _ in range(STEPS):
        pick = np.concatenate([rng.choice(c, min(len(c), BATCH_TEXTS // 2), replace=False) for c in by_class])
        rows = np.concatenate([np.arange(first[i], stops[i]) for i in pick])
        used, here = np.unique(np.append(0, ids[rows].ravel()), return_inverse=True)
        here = here[1:].reshape(-1, WINDOW_WORDS)
        some = subset(parts, used[1:] - 1)
        x = model.embed(some)
        logit = model.logits(model.project(x), here)
        best, wanted, at = [], [], 0
        for i in pick:
            size = stops[i] - first[i]
            top = at + np.argsort(-logit[at:at + size])[: 1 if label[i] else 2]
            best.extend(top.tolist())
            wanted.extend([label[i]] * len(top))
            at += size
        grads = model.gradients(some, x, here[best], np.array(wanted, np.float32))
        adam.update({k: np.clip(v, -1, 1) for k, v in grads.items()})
    return model


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
          rows: int = SAMPLE_ROWS) -> Recurrent:
    """Learn from at most ``rows`` labelled documents (crc32 modulo 5 not 0),
    half of them toxic if there are as many, whatever their length. Texts are
    cut in the tasks: ``SAMPLE_WINDOWS`` windows of each reach the driver at
    most. Null and empty texts are one window without words."""
    sample = labelled_sample(docs, labels, label, rows, doc_id, True, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_slices(whole):
                bags = [windows_of(t) for t in texts_as_bytes(batch.column(0))]
                yield pa.RecordBatch.from_arrays([pa.array(bags, pa.list_(pa.binary())), batch.column(1), batch.column(2)],
                                                 names=["windows", "label", "chance"])

    cut_up = sample.select(F.col(text), F.col("label").cast("double"), F.xxhash64(doc_id, text).alias("chance")).mapInArrow(
        run, "windows array<binary>, label double, chance bigint")
    # an id may be that of many rows
    got = cut_up.orderBy("chance").limit(rows).toArrow()
    return fit(got["windows"].to_pylist(), got["label"].to_numpy())


class Scorer:
    """Scores texts in a task; remembers the gate inputs of words it has met."""

    def __init__(self, model: Recurrent):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.ids = WordIds()
        self.gates = np.zeros((2, 1 << 12, 3 * HIDDEN), np.float32)

    def learn(self) -> None:
        need, have = len(self.ids) + 1, len(self.ids) - len(self.ids.new) + 1
        if need > self.gates.shape[1]:
            wider = np.zeros((2, max(need, 2 * have), 3 * HIDDEN), np.float32)
            wider[:, :have] = self.gates[:, :have]
            self.gates = wider
        for s in range(0, len(self.ids.new), WORDS_AT_ONCE):
            part = self.ids.new[s:s + WORDS_AT_ONCE]
            gates = self.model.project(self.model.embed(self.model.inputs(part)))
            self.gates[:, have + s:have + s + len(part)] = gates[:, 1:]
        self.ids.new = []

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        split = [t.split() for t in texts]
        if len(self.ids) > KNOWN_WORDS:
            self.forget()
        flat = self.ids.of(list(chain.from_iterable(split))) + 1
        if self.ids.new:
            self.learn()
        rows, first = to_ids(flat, np.array([len(x) for x in split], np.int64))
        return sigmoid(np.maximum.reduceat(self.model.logits(self.gates, rows), first).astype(np.float64))


def score(docs: DataFrame, model: Recurrent, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from
    ``threshold`` on). Windows of 32 words overlap by 8, so every word of the
    text is in one or two; very long texts are scored whole. Null and empty texts are one window without words. Equal texts get equal
    scores but for rounding in single precision; an empty table gives an empty table; columns of
    the input with these names give way."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        scorer = Scorer(model)
        for batch in batches:
            p = scorer.score(texts_as_bytes(batch.column(batch.schema.get_field_index(text))))
            yield [pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))]

    return append_columns(docs, T.StructType([T.StructField("score", T.DoubleType()),
                                              T.StructField("predicted", T.IntegerType())]), make)
