"""Toxicity by multiple-instance learning.

Only documents carry labels. A sentence's probability comes from a logistic model over its words, word beginnings and,
where words aren't spaced, pairs of neighbouring characters; a sentence without any feature of the model has none. A
document's is the noisy-or of its sentences and of a leak that is the same for all documents, 1 - (1 - leak) *
prod(1 - p), so that length alone makes no document toxic. The model is fitted to document labels through the noisy-or, so the weight of a document falls on the
sentences that explain it, and those can be located afterwards.

Words are hashed whole, to 64 bits, and beginnings by whole characters of any script. A-Z counts as a-z; other letters
are told apart by case. Sentences end at newlines, at . ! ? and at their kin in other scripts.

The model is fitted on the driver from at most SAMPLE labelled documents with SAMPLE_BYTES of text, those with the least
hash of their doc_id, and keeps at most FEATURES features, each of which occurs in LEAST_DOCS of these documents or more;
every document is scored over its whole text.

Defined results: a null or empty text has no sentence and scores 0; a sentence of more than PIECE bytes is scored in
parts of about that length; without labelled documents of both kinds every score is 0; a document labelled more than once
counts as toxic if any label says so; null labels are ignored; repeated rows are scored each; a null doc_id is returned
as null and is not held out; extra columns are ignored by `query` and kept by `drop_toxic`."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, Words, mix, runs_of, sample_texts, slices

#: Labelled documents that the model is fitted on, at most, and the bytes of their texts; bytes that are handled at a time there.
SAMPLE, SAMPLE_BYTES, FIT_BYTES = 8000, 64_000_000, 1_500_000
THRESHOLD = 0.7
#: Features that the model keeps, documents that a feature must occur in, and standard errors that its log-odds must be above 0.
FEATURES, LEAST_DOCS, SURE = 3000, 5, 2.0
#: Of squared weights, in the loss; chosen by folds of training rows.
PENALTY = 1e-6
#: Lengths, in characters, of the word beginnings that are features besides the word itself.
PREFIXES = (4, 5, 6)
#: Bytes of text that are scored at a time.
PIECE = 2_000_000
_ENDS = np.zeros(256, bool)
_ENDS[[10, 33, 46, 63]] = True  # newline ! . ?
#: Ends of sentences outside ASCII (group 1), and signs and spaces there.
_MARKS = re.compile(
    "(。|｡|！|？|．|…|‼|⁇|⁈|⁉|؟|۔|।|॥|։|።|፧)".encode()
    + rb"|\xe2\x80[\x80-\xbf]|\xe3\x80[\x80-\x9f]|\xef\xbc[\x80-\x8f]|\xc2[\x80-\xa9\xab-\xb4\xb6-\xb9\xbb-\xbf]|\xd8\x8c"
)
#: A multiplier and its inverse modulo 2^64, for hashes of any stretch of text from sums over the bytes before it.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PAIR = 64


def folded(text: bytes) -> bytes:
    """Lower case for A-Z, and a newline or spaces for signs outside ASCII, byte for byte."""
    text = text.lower()
    return text if text.isascii() else _MARKS.sub(lambda m: (b"\n" if m[1] else b" ").ljust(len(m[0])), text)


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of _BASE and of its inverse."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


class Sentences:
    """The sentences of some texts that have words, and their features as 64-bit keys."""

    def __init__(self, texts: list[bytes]):
        words = Words([folded(x) for x in texts], ALNUM)
        self.words = words
        stops = np.cumsum(_ENDS[words.data], dtype=np.int32)
        number = stops[words.starts]
        new = np.ones(len(words), bool)
        new[1:] = (number[1:] != number[:-1]) | (words.doc[1:] != words.doc[:-1])
        self.first_word = np.flatnonzero(new)
        self.of_word = np.cumsum(new) - 1
        self.doc = words.doc[self.first_word]
        self.n_texts = len(texts)

    def __len__(self) -> int:
        return len(self.first_word)

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(words, their keys): whole words; their beginnings; pairs of neighbouring characters of three bytes or more."""
        data, starts, ends = self.words.data, self.words.starts, self.words.ends
        up, down = powers(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])

        def key(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
            return mix((sums[b] - sums[a]) * down[a] + np.uint64(kind))

        every = np.arange(len(starts))
        yield every, key(starts, ends, 0)
        lead = (data & 0xC0) != 0x80
        at = np.flatnonzero(lead)
        number = np.cumsum(lead, dtype=np.int32) - 1  # of the character that each byte belongs to
        size = number[ends] - number[starts]
        for n in PREFIXES:
            long = every[size >= n]
            yield long, key(starts[long], at[number[starts[long]] + n], n)
        wide = data[at] >= 0xE0
        pair = np.flatnonzero(wide[:-1] & wide[1:])
        if len(pair):
            yield np.searchsorted(starts, at[pair], side="right") - 1, key(at[pair], at[pair + 2], _PAIR)


@dataclass
class Model:
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -np.inf
    leak: float = -np.inf  # log-odds, as the bias

    def __post_init__(self):
        self.seen = np.zeros(1 << 16, bool)
        self.seen[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)

    def hits(self, sentences: Sentences) -> tuple[np.ndarray, np.ndarray]:
        """(sentence, feature) of every occurrence of a feature."""
        rows, cols = [], []
        for words, keys in sentences.features() if len(self.keys) else ():
            maybe = np.flatnonzero(self.seen[self._slot(keys)])
            at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
            found = self.keys[at] == keys[maybe]
            rows.append(sentences.of_word[words[maybe[found]]])
            cols.append(at[found])
        return (np.concatenate(rows), np.concatenate(cols)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def sentence_scores(self, sentences: Sentences) -> np.ndarray:
        rows, cols = self.hits(sentences)
        n = len(sentences)
        logit = self.bias + np.bincount(rows, self.weights[cols], minlength=n)
        return np.where(np.bincount(rows, minlength=n) > 0, 1 / (1 + np.exp(-np.clip(logit, -500, 500))), 0.0)

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: its score, its number of sentences, the worst one's score and that one's bounds in bytes (-1 without any that has a feature)."""
        n = len(texts)
        clean, count, worst, bounds = np.zeros(n), np.zeros(n, np.int64), np.zeros(n), np.full((n, 2), -1)
        owner, offset, parts = [], [], []
        for i, text in enumerate(texts):
            for at, part in pieces(text):
                owner.append(i), offset.append(at), parts.append(part)
        owner, offset = np.array(owner, np.int64), np.array(offset, np.int64)
        for own in runs_of(parts, PIECE):
            s = Sentences(parts[own])
            each, doc = self.sentence_scores(s), owner[own][s.doc]
            np.add.at(clean, doc, np.log1p(-np.minimum(each, 1 - 1e-12)))
            np.add.at(count, doc, 1)
            order = np.lexsort((-each, doc))
            top = order[np.flatnonzero(np.diff(doc[order], prepend=-1))]
            top = top[each[top] > worst[doc[top]]]
            last_word = np.append(s.first_word[1:], len(s.words))[top] - 1
            shift = (offset[own] - s.words.bounds[:-1])[s.doc[top]]
            worst[doc[top]] = each[top]
            bounds[doc[top]] = np.stack([s.words.starts[s.first_word[top]] + shift, s.words.ends[last_word] + shift], 1)
        clean -= (count > 0) * np.logaddexp(0, self.leak)
        return 0.0 - np.expm1(clean), count, worst, bounds


def pieces(text: bytes) -> Iterator[tuple[int, bytes]]:
    """(first byte, bytes) of the text's parts of PIECE bytes at most: cut after a sentence's end or, without one, a space or a character."""
    at = 0
    while len(text) - at > PIECE:
        found = [m.end() for m in _CUTS.finditer(text, at + PIECE // 2, at + PIECE)]
        space = text.rfind(b" ", at + PIECE // 2, at + PIECE) + 1
        cut = found[-1] if found else space or at + PIECE
        while text[cut] & 0xC0 == 0x80:
            cut -= 1
        yield at, text[at:cut]
        at = cut
    yield at, text[at:]


_CUTS = re.compile(rb"[\n!.?]|\xe3\x80\x82|\xef\xbc[\x81\x9f]")


def _select(texts: list[bytes], toxic: np.ndarray) -> np.ndarray:
    """Sorted keys of the features that mark toxic documents most surely.

    What occurs in one toxic document alone can't be sure; so only the others are counted in clean documents."""
    keys, pos = np.zeros(0, np.uint64), np.zeros(0)
    bad = [texts[i] for i in np.flatnonzero(toxic)]
    for part in runs_of(bad, FIT_BYTES):
        s = Sentences(bad[part])
        found = np.concatenate([_pairs(s.words.doc[w], f)[1] for w, f in s.features()])
        keys, index = np.unique(np.concatenate([keys, found]), return_inverse=True)
        pos = np.bincount(index, np.concatenate([pos, np.ones(len(found))]))
    keep = pos >= 2
    keys, pos = keys[keep], pos[keep]
    neg = np.zeros(len(keys))
    good = [texts[i] for i in np.flatnonzero(toxic == 0)]
    for part in runs_of(good, FIT_BYTES) if len(keys) else ():
        s = Sentences(good[part])
        for w, f in s.features():
            at = np.minimum(np.searchsorted(keys, f), len(keys) - 1)
            known = keys[at] == f
            neg += np.bincount(_pairs(s.words.doc[w[known]], at[known].astype(np.uint64))[1].astype(np.int64), minlength=len(keys))
    keep = pos + neg >= LEAST_DOCS
    keys, pos, neg = keys[keep], pos[keep], neg[keep]
    n = toxic.sum()
    odds = np.log((pos + 0.5) / (n - pos + 0.5)) - np.log((neg + 0.5) / (len(toxic) - n - neg + 0.5))
    sure = odds / np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
    best = np.argsort(-sure, kind="stable")[:FEATURES]
    return np.sort(keys[best[sure[best] > SURE]])


def _pairs(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    order = np.lexsort((key, doc))
    doc, key = doc[order].astype(np.uint64), key[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return np.stack([doc[new], key[new]])


def loss_and_gradient(theta: np.ndarray, rows: np.ndarray, cols: np.ndarray, doc: np.ndarray, toxic: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood of the labels through the noisy-or, and its gradient by weights and, last, bias and leak.

    rows, cols: (sentence, feature) of every occurrence; doc: the documents of sentences with features."""
    n, weights, bias, leak = len(toxic), theta[:-2], theta[-2], theta[-1]
    z = bias + np.bincount(rows, weights[cols], minlength=len(doc))
    p, always = 1 / (1 + np.exp(-np.clip(z, -500, 500))), 1 / (1 + np.exp(-leak))
    clean = -np.bincount(doc, np.logaddexp(0, z), minlength=n) - np.logaddexp(0, leak)  # log of 1 - score
    clean = np.minimum(clean, -1e-9)
    loss = -np.where(toxic > 0, np.log(-np.expm1(clean)), clean).mean() + penalty * (weights**2).sum() / 2
    pull = np.where(toxic > 0, np.exp(clean) / np.expm1(clean), 1.0)  # of the loss, by the sum of log-odds terms
    step = pull[doc] * p
    grad = np.append(np.bincount(cols, step[rows], minlength=len(weights)), [step.sum(), pull.sum() * always]) / n
    grad[:-2] += penalty * weights
    return loss, grad


def fit(texts: list[bytes], toxic: np.ndarray, steps: int = 300, rate: float = 0.1, penalty: float = PENALTY) -> Model:
    """The model that makes the labels likeliest through the noisy-or, by Adam over all documents at once."""
    toxic = np.asarray(toxic, float)
    if not len(toxic) or toxic.min() == toxic.max():
        return Model()
    model = Model(_select(texts, toxic), np.zeros(0), 0.0)
    rows, cols, doc, base = [], [], [], 0
    for part in runs_of(texts, FIT_BYTES):
        s = Sentences(texts[part])
        r, c = model.hits(s)
        used, r = np.unique(r, return_inverse=True)
        rows.append(r + base)
        cols.append(c)
        doc.append(s.doc[used] + part.start)
        base += len(used)
    rows, cols, doc = map(np.concatenate, (rows, cols, doc))
    theta = np.append(np.full(len(model.keys), 1.0), [-4.0, -4.0])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        grad = loss_and_gradient(theta, rows, cols, doc, toxic, penalty)[1]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        theta -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Model(model.keys, theta[:-2], float(theta[-2]), float(theta[-1]))


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on at most SAMPLE labelled documents that are not held out."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(~held_out())
    each = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    sample = each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the sample has SAMPLE rows at most, so it may be broadcast; a document that repeats counts once
    once = own.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = sample_texts(once.orderBy(F.xxhash64("doc_id"), "doc_id"), "text", SAMPLE_BYTES)
    return fit([(r.text or "").encode() for r in rows], np.array([r.toxic for r in rows]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_sentences, and the offending sentence: its score and its bounds in the text's UTF-8 bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = pickle.loads(shared.value)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                score, count, worst, bounds = own.score(texts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score), pa.array(count), pa.array(worst), pa.array(bounds[:, 0]), pa.array(bounds[:, 1])], ["doc_id", "score", "n_sentences", "worst_score", "worst_start", "worst_end"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, score double, n_sentences long, worst_score double, worst_start long, worst_end long")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = scored(docs, train(docs, labels))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_sentences", "worst_start", "worst_end")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below THRESHOLD, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(train(docs, labels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = pickle.loads(shared.value)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                yield part.filter(pa.array(own.score(texts)[0] < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
