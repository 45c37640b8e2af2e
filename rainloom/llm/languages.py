"""Language identification by language-bitmask n-gram filters.

Every language has a Bloom filter of the four-byte n-grams that mark it. The filters are bit-sliced: a slot of the table
holds one bit for each language, so the AND of an n-gram's slots names all languages that contain it at once. A text's
n-grams are looked up together, each language's bits are counted, the counts are corrected for the filter's false
positives and set against what the language's own texts reach, and the greatest decides.

The filters are fitted on the driver from at most SAMPLE texts with a language and SAMPLE_BYTES of text. Each language has
the same share of SAMPLE, so rare ones are learned too: its texts with the least hash of their doc_id, shortened evenly
where SAMPLE_BYTES are exceeded. With more languages than SAMPLE, those that sort first by hash are learned. Every text
is scored whole.

Defined results: a null text, or one without a letter, is `und` with score 0, and so is every text if no language was
learned; languages that tie are decided by name; rows that repeat are scored each; a null doc_id is returned as null
and is not held out; extra columns are ignored; an empty table gives no rows."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import runs_of, sample_texts, slices

#: Texts that the filters are fitted on, at most, and their bytes; bytes that are counted at a time.
SAMPLE, SAMPLE_BYTES, COUNT_BYTES = 4000, 64_000_000, 1_000_000
#: Tasks that a language's documents are dealt to when the least hashes are looked for.
PARTS = 64
GRAM = 4
#: Slots of the table, as a power of two, and slots for each n-gram.
SLOTS, HASHES = 20, 2
#: An n-gram marks a language if it occurs so often there, and at this part at least of its greatest rate in any language.
LEAST_COUNT, SHARE = 5, 0.25
UNKNOWN = "und"
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' n-grams over letters and spaces, and where each text's begin, with the end at the end.

    A text is bounded by spaces; n-grams that reach into the next text count as spaces alone."""
    data = _FOLD[np.frombuffer(b" ".join([b"", *texts, b" " * GRAM]), np.uint8)]
    starts = np.cumsum([0, *(len(x) + 1 for x in texts)])
    wide = data.astype(np.uint32)
    gram = wide[: -GRAM + 1].copy()
    for j in range(1, GRAM):
        gram <<= np.uint32(8)
        gram |= wide[j : len(wide) - GRAM + 1 + j]
    for j in range(1, GRAM - 1):
        gram[starts[1:] - j] = 0x20202020
    return gram[: starts[-1]], starts


class Filters:
    def __init__(self, texts: list[bytes], languages: list[str], slots: int = SLOTS):
        self.languages = sorted(set(languages))
        self.shift = np.uint32(32 - slots)
        n = len(self.languages)
        kind = next((t for t in (np.uint8, np.uint16, np.uint32) if n <= 8 * np.dtype(t).itemsize), np.uint64)
        self.tables = [np.zeros(1 << slots, kind) for _ in range(-(-n // 64))]
        self.rate = self.false = np.zeros(n)
        if not n:
            return
        code = np.searchsorted(self.languages, languages)
        counted = []
        for k in range(n):
            keys, counts = np.zeros(0, np.uint32), np.zeros(0)
            own = [texts[i] for i in np.flatnonzero(code == k)]
            for part in runs_of(own, COUNT_BYTES):
                found, times = np.unique(grams(own[part])[0], return_counts=True)
                keys, index = np.unique(np.concatenate([keys, found]), return_inverse=True)
                counts = np.bincount(index, np.concatenate([counts, times]))
            solid = keys != 0x20202020
            counted.append((keys[solid], counts[solid], max(counts[solid].sum(), 1)))
        every = np.unique(np.concatenate([k for k, _, _ in counted]))
        best = np.zeros(len(every))
        for keys, counts, total in counted:
            at = np.searchsorted(every, keys)
            best[at] = np.maximum(best[at], counts / total)
        self.rate = np.zeros(n)
        for k, (keys, counts, total) in enumerate(counted):
            keep = (counts >= LEAST_COUNT) & (counts / total >= SHARE * best[np.searchsorted(every, keys)])
            self.rate[k] = max(counts[keep].sum() / total, 1e-6)
            table, bit = self.tables[k // 64], kind(1 << (k % 64))
            for at in self._slots(keys[keep]):
                table[at] |= bit
        fill = np.array([np.count_nonzero(self.tables[k // 64] & kind(1 << (k % 64))) for k in range(n)]) / (1 << slots)
        self.false = fill**HASHES

    def _slots(self, gram: np.ndarray) -> Iterator[np.ndarray]:
        for m in _MULTIPLIERS[:HASHES]:
            yield ((gram ^ (gram >> np.uint32(15))) * m) >> self.shift

    def lookup(self, gram: np.ndarray) -> list[np.ndarray]:
        """Bitmasks of the languages whose filters contain each n-gram, 64 languages to a mask."""
        at = list(self._slots(gram))
        out = []
        for table in self.tables:
            mask = table[at[0]]
            for more in at[1:]:
                mask &= table[more]
            out.append(mask)
        return out

    def shares(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages): corrected parts of each text's n-grams, relative to the languages' own texts."""
        gram, starts = grams(texts)
        solid = gram != 0x20202020
        total = np.add.reduceat(solid, starts[:-1], dtype=np.int64)[:, None]
        masks = self.lookup(gram)
        hits = np.empty((len(texts), len(self.languages)))
        for k in range(len(self.languages)):
            mask = masks[k // 64]
            hits[:, k] = np.add.reduceat((mask >> mask.dtype.type(k % 64) & mask.dtype.type(1)) * solid, starts[:-1], dtype=np.int64)
        return np.maximum(hits - total * self.false, 0) / (1 - self.false) / np.maximum(total, 1) / self.rate

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        if not self.languages or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        shares = self.shares(texts)
        best = np.argmax(shares, axis=1)
        top, total = shares[np.arange(len(texts)), best], shares.sum(axis=1)
        score = np.where(total > 0, top / np.maximum(total, 1e-12), 0.0)
        names = []
        for i, text in enumerate(texts):
            known = text.isascii() and text.lower() != text.upper() or any(c.isalpha() for c in text.decode())
            names.append(self.languages[best[i]] if known else UNKNOWN)
            if not known:
                score[i] = 0.0
        return names, score


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame) -> Filters:
    """Fits on at most SAMPLE texts with a language that are not held out, as many of each language."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    usable = own.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    # the sample is found by narrow columns first, so that its texts alone move
    ids = usable.select(F.col("doc_id").alias("id"), F.col("lang").alias("of")).distinct()
    tongues = ids.select("of").distinct().orderBy(F.xxhash64("of"), "of").limit(SAMPLE).count()
    if not tongues:
        return Filters([], [])
    each = SAMPLE // tongues
    # least hashes of a language: array_agg would hold all of them, a rank in parts holds `each` of a part
    part = F.pmod(F.xxhash64("id"), F.lit(PARTS))
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.xxhash64("id"), "id"))
    few = ids.withColumn("part", part).withColumn("k", rank("of", "part")).where(F.col("k") <= each).drop("k", "part")
    chosen = few.withColumn("k", rank("of")).where(F.col("k") <= each).orderBy("k", F.xxhash64("of"), "of").limit(SAMPLE)
    # SAMPLE rows at most, so it may be broadcast; a document that repeats under a language counts once
    rows = usable.join(F.broadcast(chosen), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("of")))
    once = rows.groupBy("lang", "doc_id").agg(F.min("k").alias("k"), F.min("text").alias("text")).orderBy("k", F.xxhash64("lang"), "lang")
    found = sample_texts(once.select("lang", "text"), "text", SAMPLE_BYTES)
    return Filters([r.text.encode() for r in found], [r.lang for r in found])


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(filters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Filters = pickle.loads(shared.value)
        for batch in batches:
            for part, texts in slices(batch, "text", 2_000_000):
                names, score = own.predict(texts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names), pa.array(score)], ["doc_id", "lang_pred", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, lang_pred string, score double")


def query(docs: DataFrame) -> DataFrame:
    return identify(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
