"""Language identification of mixed-language text.

The script of a word narrows the candidate languages, character n-grams score
the word for each of them, and Viterbi with a switching penalty labels spans.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import WordIds, append_columns, held_out, ngrams, texts_as_bytes, with_rank

# Documents of each language to learn from, chosen by a hash of the id.
SAMPLE_ROWS = 1000
NGRAM_ROWS = 1 << 15
# Nats that a change of language between two words costs, how many
# observations the n-grams of a word count for, and what a word outside a
# language's scripts costs.
SWITCH, WORD_WEIGHT, WRONG_SCRIPT = 6.0, 3.0, 30.0
MIN_SCRIPT_SHARE = 0.05
KNOWN_WORDS, WORDS_AT_ONCE = 250_000, 20_000
BATCH_BYTES = 4 << 20

# First code point of each run of Unicode and the script of its
# letters ("" where several scripts mix).
SCRIPT_STARTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x07C0, "Nko"), (0x0800, ""),
    (0x08A0, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, ""), (0x1780, "Khmer"),
    (0x1800, "Mongolian"), (0x18B0, ""), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, ""), (0x3040, "Kana"),
    (0x3100, "Bopomofo"), (0x3130, "Hangul"), (0x3190, ""), (0x3400, "Han"), (0xA000, ""), (0xAC00, "Hangul"),
    (0xD800, ""), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB07, ""), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"),
    (0xFE00, ""), (0xFE70, "Arabic"), (0xFF00, ""), (0xFF21, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"),
    (0xFFDD, ""), (0x20000, "Han"), (0x323B0, ""),
]
STARTS = [s for s, _ in SCRIPT_STARTS]
SCRIPTS = sorted({n for _, n in SCRIPT_STARTS})


SCRIPT_NUMBERS = [SCRIPTS.index(n) for _, n in SCRIPT_STARTS]
LATIN = SCRIPTS.index("Latin")


def lowered(word: bytes) -> tuple[bytes, int]:
    """The word in lower case and the script of its first letter (-1: none)."""
    if word.isascii():
        low = word.lower()
        return low, LATIN if low != word.upper() else -1
    plain = word.decode("utf-8", "replace").lower()
    for sign in plain:
        if sign.isalpha():
            return plain.encode(), SCRIPT_NUMBERS[bisect_right(STARTS, ord(sign)) - 1]
    return plain.encode(), -1


class Languages:
    """Log probabilities of n-grams and the scripts of each learnt language."""

    def __init__(self, names: list[str], grams: np.ndarray, scripts: np.ndarray):
        self.names = names
        share = scripts / np.maximum(scripts.sum(1, keepdims=True), 1)
        self.scripts = share >= MIN_SCRIPT_SHARE  # (language, script)
        # all languages count the same, or one with few texts would be the
        # likeliest for every n-gram that none has
        total = grams.sum(1, keepdims=True)
        smooth = grams * (total.max(initial=1) / np.maximum(total, 1)) + 0.1
        self.logp = np.log(smooth / smooth.sum(1, keepdims=True)).T.astype(np.float32)  # (n-gram, language)

    def scores(self, words: list[bytes]) -> np.ndarray:
        """A row of scores for each word, 0 for the best language; words
        without letters are 0 throughout. A script that no language has
        narrows nothing."""
        plain, scripts = zip(*map(lowered, words))
        scripts = np.array(scripts, np.int64)
        rows, counts = ngrams(plain, NGRAM_ROWS)
        mean = np.add.reduceat(self.logp[rows], np.cumsum(counts) - counts, axis=0) / counts[:, None]
        fits = self.scripts.T[scripts]
        fits[~fits.any(1)] = True
        out = WORD_WEIGHT * mean - np.where(fits, 0, WRONG_SCRIPT).astype(np.float32)
        out -= out.max(1, keepdims=True)
        out[scripts < 0] = 0
        return out.astype(np.float32)


def viterbi(scores: np.ndarray, flat: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word of every text: ``flat`` gives each
    word's row of ``scores``, texts one after the other. All texts move on
    together, longest first, so that those that have ended drop off the end."""
    n_langs = scores.shape[1]
    path = np.zeros(len(flat), np.int16)
    order = np.argsort(-lengths, kind="stable")
    base = (np.cumsum(lengths) - lengths)[order]
    left = lengths[order]
    steps = int(left[0]) if len(left) else 0
    if not steps:
        return path
    alive = np.searchsorted(-left, -np.arange(steps), side="left")  # texts longer than t
    came = np.zeros((len(flat), n_langs), np.int8 if n_langs < 127 else np.int16)
    own = np.arange(n_langs, dtype=came.dtype)
    best = scores[flat[base[:alive[0]]]].astype(np.float64)
    ends = best.copy()
    for t in range(1, steps):
        n = alive[t]
        best = best[:n]
        top = best.argmax(1)
        turn = best[np.arange(n), top] - switch
        at = base[:n] + t
        stay = best >= turn[:, None]
        came[at] = np.where(stay, own, top[:, None].astype(came.dtype))
        best = np.where(stay, best, turn[:, None]) + scores[flat[at]]
        ends[:n] = best
    now = ends.argmax(1)
    for t in range(steps - 1, -1, -1):
        n = alive[t]
        at = base[:n] + t
        path[at] = now[:n]
        if t:
            now[:n] = came[at, now[:n]]
    return path


class Tagger:
    """Labels texts in a task; remembers the scores of words it has met."""

    def __init__(self, model: Languages):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.ids = WordIds()
        self.scores = np.zeros((1 << 12, len(self.model.names)), np.float32)

    def learn(self) -> None:
        need, have = len(self.ids), len(self.ids) - len(self.ids.new)
        if need > len(self.scores):
            wider = np.zeros((max(need, 2 * have), self.scores.shape[1]), np.float32)
            wider[:have] = self.scores[:have]
            self.scores = wider
        for s in range(0, len(self.ids.new), WORDS_AT_ONCE):
            part = self.ids.new[s:s + WORDS_AT_ONCE]
            self.scores[have + s:have + s + len(part)] = self.model.scores(part)
        self.ids.new = []

    def tag(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, list[str]]:
        """(language, share of the lettered words in it, spans) of each text."""
        if not self.model.names or not texts:
            return ["und"] * len(texts), np.zeros(len(texts)), [""] * len(texts)
        split = [t.split() for t in texts]
        words = list(chain.from_iterable(split))
        if len(self.ids) > KNOWN_WORDS:
            self.forget()
        flat = self.ids.of(words)
        if self.ids.new:
            self.learn()
        lengths = np.array([len(x) for x in split], np.int64)
        path = viterbi(self.scores, flat, lengths)
        lettered = self.scores[flat].any(1) if len(self.model.names) > 1 else None
        owner = np.repeat(np.arange(len(texts)), lengths)
        n_langs = len(self.model.names)
        weight = None if lettered is None else lettered.astype(np.float64)
        votes = np.bincount(owner * n_langs + path, weight, len(texts) * n_langs).reshape(-1, n_langs)
        total = votes.sum(1)
        top = votes.argmax(1)
        share = votes[np.arange(len(texts)), top] / np.maximum(total, 1)
        names, spans = [], []
        first = np.cumsum(lengths) - lengths
        cuts = np.nonzero(np.diff(path, prepend=-1) != 0)[0]
        for i, text in enumerate(texts):
            if total[i] == 0 and not any(map(str.isalpha, text.decode("utf-8", "replace"))):
                names.append("und")
                spans.append("")
                share[i] = 0
                continue
            names.append(self.model.names[top[i]])
            lo, hi = first[i], first[i] + lengths[i]
            inner = cuts[np.searchsorted(cuts, lo, side="right"):np.searchsorted(cuts, hi)]
            edges = [lo, *inner.tolist(), hi]
            spans.append(",".join(f"{self.model.names[path[s]]}:{s - lo}:{e - lo}" for s, e in zip(edges, edges[1:])))
        return names, share, spans


def train(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
          rows: int = SAMPLE_ROWS) -> Languages:
    """Learn every language of the documents whose crc32 modulo 4 is not 2,
    each from at most ``rows`` of them, however rare it is. N-grams are counted in tasks; the driver gets one
    count for each language and hashed n-gram, never texts."""
    known = docs.where(F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id, 4, 2))
    ids = known.select(doc_id, lang).distinct()
    ranked = with_rank(ids, [lang], F.xxhash64(F.lit("sample"), doc_id), [F.col(doc_id)], "_place")
    picked = ranked.where(F.col("_place") <= rows).drop("_place")
    sample = docs.select(doc_id, lang, text).join(F.broadcast(picked), [doc_id, lang]).select(lang, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), texts_as_bytes(batch.column(1))):
                words = [lowered(w) for w in body.split()]
                counts = found.setdefault(name, np.zeros(NGRAM_ROWS + len(SCRIPTS), np.int64))
                if words:
                    grams, _ = ngrams([w for w, _ in words], NGRAM_ROWS)
                    scripts = np.array([s for _, s in words if s >= 0], np.int64)
                    counts += np.bincount(np.append(grams, scripts + NGRAM_ROWS), minlength=len(counts))
        for name, counts in found.items():
            at = np.nonzero(counts)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])],
                names=["lang", "cell", "n"])

    cells = (sample.mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell")
             .agg(F.sum("n").alias("n")).toArrow())
    langs = cells["lang"].to_pylist()
    names = sorted(set(langs))
    place = {n: i for i, n in enumerate(names)}
    counts = np.zeros((len(names), NGRAM_ROWS + len(SCRIPTS)), np.float64)
    counts[[place[x] for x in langs], cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return Languages(names, counts[:, :NGRAM_ROWS], counts[:, NGRAM_ROWS:])


def identify(docs: DataFrame, model: Languages, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` (the language of most words), ``score`` (its
    share of the words with letters) and ``lang_spans``
    (``language:first word:end word``, comma-joined).

    Null texts and texts without a letter are ``und`` with score 0, as is
    everything if no language was learnt; ties go to the first name. Equal
    texts get equal results; an empty table gives an empty table; columns of
    the input with these names give way."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        tagger = Tagger(model)
        for batch in batches:
            names, share, spans = tagger.tag(texts_as_bytes(batch.column(batch.schema.get_field_index(text))))
            yield [names, pa.array(share, pa.float64()), spans]

    added = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                          T.StructField("lang_spans", T.StringType())])
    return append_columns(docs, added, make, BATCH_BYTES)
