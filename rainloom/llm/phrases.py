"""Benchmark decontamination by a stored positional inverted index that is distributed by documents.

Each segment, a run of documents, has an index of its own: for every term the sorted positions of its tokens. Segments
are rows of a table (`build_index`); searching reads that table alone. A phrase starts from its rarest term in the
segment: that term's postings, less its offset in the phrase, are the places to try, and they are intersected with the
other terms' postings, less their offsets, from rare to frequent. Proximity asks for all terms inside a span, in any
order, and starts from the rarest term as well.

Benchmark items are sent to the segments in blocks of about ITEM_BYTES, one block alive at a time; long items are cut
into pieces that share all but one of a window's words, so no window is lost. With more than one block each is held
against the stored index, and the blocks' hits are merged by document.

Defined results: words are runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] after lower-casing A-Z; null texts have none;
an item of fewer words than the window, but not none, is one window; an item is near if its first WINDOW words, or all
if there are fewer, stand inside NEAR words of the document; items with the same id count once; an item with a null id
still hits, and its id is the empty string; a null doc_id is returned as null; repeated documents give a row each; extra
columns are ignored by `query` and kept by `drop_contaminated`; an empty benchmark leaves every document clean."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, NULL_ID, Words, expand, materialize, slices, sliding_min

WINDOW, NEAR = 10, 20
#: Benchmark text that is broadcast at a time, and of a piece of an item.
ITEM_BYTES, PIECE_BYTES = 32_000_000, 1_000_000
#: Document text of a segment.
SEGMENT_BYTES = 2_000_000
#: Places that are tried at a time.
TRIED = 1_000_000


@dataclass
class Segment:
    """Some documents' words as posting lists. vocabulary: the terms; positions: those of the terms' tokens, term by term,
    from starts; first: each document's first position, and the number of words at the end."""

    vocabulary: pa.Array
    starts: np.ndarray
    positions: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Segment:
        words = Words([x.lower() for x in texts], ALNUM)
        coded = words.array().dictionary_encode()
        code, n = coded.indices.to_numpy(), len(coded.dictionary)
        # a stable sort of small integers is a radix sort
        order = np.argsort(code.astype(np.uint16) if n < 65536 else code, kind="stable")
        return cls(coded.dictionary, np.append(0, np.cumsum(np.bincount(code, minlength=n))), order, words.first)

    def __post_init__(self):
        self.size = int(self.first[-1])
        self.doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def pack(self) -> tuple[bytes, bytes, bytes, bytes]:
        """Terms, numbers of tokens, positions and first positions; gaps are stored, bytes of equal weight together."""
        terms = zstandard.compress(b" ".join(self.vocabulary.to_pylist()), 1)
        return terms, *(_packed(np.diff(x, prepend=0)) for x in (self.starts[1:], self.positions, self.first))

    @classmethod
    def unpack(cls, terms: bytes, counts: bytes, positions: bytes, first: bytes) -> Segment:
        vocabulary = zstandard.decompress(terms).split()
        return cls(pa.array(vocabulary, pa.large_binary()), np.append(0, _unpacked(counts)), _unpacked(positions), _unpacked(first))

    def keyed(self) -> np.ndarray:
        """All postings as one sorted list: term times the number of words, plus position."""
        return np.repeat(np.arange(len(self.vocabulary)) * self.size, np.diff(self.starts)) + self.positions


def _packed(gaps: np.ndarray) -> bytes:
    return len(gaps).to_bytes(4, "little") + zstandard.compress(gaps.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    planes = np.frombuffer(zstandard.decompress(data[4:]) if n else b"", np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").ravel(), dtype=np.int64)


@dataclass
class Items:
    """Pieces of benchmark items, in order of `first`, as terms of a vocabulary. leads: whether a piece begins its item."""

    ids: list[str]
    leads: np.ndarray
    vocabulary: pa.Array
    terms: np.ndarray
    first: np.ndarray
    window: int

    @classmethod
    def of(cls, rows: list[tuple], window: int = WINDOW) -> Items:
        """rows: (item_id, text) or (item_id, text, whether the piece begins its item)."""
        words = Words([(r[1] or "").encode().lower() for r in rows], ALNUM)
        coded = words.array().dictionary_encode()
        return cls(["" if r[0] is None else str(r[0]) for r in rows], np.array([r[2] if len(r) > 2 else True for r in rows], bool), coded.dictionary, coded.indices.to_numpy().astype(np.int64), words.first, window)

    def windows(self) -> Iterator[tuple[int, np.ndarray]]:
        """(size, first terms) of all windows by their size."""
        sizes = np.diff(self.first)
        whole = np.flatnonzero(sizes >= self.window)
        yield self.window, expand(self.first[whole], sizes[whole] - self.window + 1)
        for size in np.unique(sizes[(sizes > 0) & (sizes < self.window)]).tolist():
            yield size, self.first[:-1][sizes == size]

    def of_term(self, at: np.ndarray) -> np.ndarray:
        """The piece that each place in `terms` belongs to."""
        return np.searchsorted(self.first, at, side="right") - 1


class Search:
    """Items against one segment."""

    def __init__(self, segment: Segment, items: Items):
        self.segment, self.items = segment, items
        own = pc.index_in(items.vocabulary, value_set=segment.vocabulary).fill_null(-1).to_numpy().astype(np.int64)
        counts = np.where(own < 0, 0, np.append(np.diff(segment.starts), 0)[own])
        self.term, self.count = own[items.terms], counts[items.terms]
        self.keys = np.append(segment.keyed(), np.iinfo(np.int64).max)

    def _rarest(self, term: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, position) for all postings of each query's term, about TRIED at a time."""
        upto = np.cumsum(count)
        a = 0
        while a < len(count):
            b = max(a + 1, int(np.searchsorted(upto, upto[a] - count[a] + TRIED, side="right")))
            yield np.repeat(np.arange(a, b), count[a:b]), self.segment.positions[expand(self.segment.starts[term[a:b]], count[a:b])]
            a = b

    def phrases(self) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(first terms, size, first positions) of all windows that occur, once for each occurrence."""
        s = self.segment
        for size, every in self.items.windows():
            least = sliding_min(self.count, size) if len(every) else every
            every = every[least[every] > 0]
            for c in range(0, len(every), 100_000):
                at = every[c : c + 100_000]
                order = np.argsort(self.count[at[:, None] + np.arange(size)], axis=1, kind="stable")
                rare = at + order[:, 0]
                for of, pos in self._rarest(self.term[rare], self.count[rare]):
                    pos = pos - order[of, 0]
                    keep = (pos >= 0) & (pos + size <= s.size)
                    of, pos = of[keep], pos[keep]
                    keep = s.doc[pos] == s.doc[pos + size - 1]
                    of, pos = of[keep], pos[keep]
                    for step in range(1, size):
                        if not len(of):
                            break
                        k = order[of, step]
                        wanted = self.term[at[of] + k] * s.size + pos + k
                        keep = self.keys[np.searchsorted(self.keys, wanted)] == wanted
                        of, pos = of[keep], pos[keep]
                    if len(of):
                        yield at[of], size, pos

    def near(self, span: int = NEAR) -> Iterator[tuple[int, list[int]]]:
        """(piece, positions): places of a term from which all of an item's first words follow inside `span` words."""
        s, items = self.segment, self.items
        sets, whose = [], []
        for i in np.flatnonzero(items.leads & (np.diff(items.first) > 0)).tolist():
            places = np.arange(items.first[i], min(items.first[i + 1], items.first[i] + items.window))
            if self.count[places].all():
                terms, at = np.unique(self.term[places], return_index=True)
                sets.append(terms[np.argsort(self.count[places[at]], kind="stable")])
                whose.append(i)
        if not sets:
            return
        most = max(map(len, sets))
        table = np.array([np.append(t, np.full(most - len(t), t[0])) for t in sets])
        counts = np.diff(s.starts)
        found: dict[int, set[int]] = {}
        for of, pos in self._rarest(table[:, 0], counts[table[:, 0]]):
            for step in range(1, most):
                base = table[of, step] * s.size
                # the next posting of that term from span - 1 words before on; other terms' are out of reach
                after = self.keys[np.searchsorted(self.keys, base + np.maximum(pos - span + 1, 0))]
                keep = after <= base + np.minimum(pos + span - 1, s.size - 1)
                of, pos = of[keep], pos[keep]
            for q, r in zip(of.tolist(), pos.tolist(), strict=True):
                found.setdefault(whose[q], set()).update(self._spans(sets[q], r, span))
        yield from ((i, sorted(p)) for i, p in found.items() if p)

    def _spans(self, terms: np.ndarray, r: int, span: int) -> list[int]:
        """Places of a term, up to r, from which all terms follow inside `span` words of r's document."""
        s = self.segment
        d = int(s.doc[r])
        low, high = max(r - span + 1, int(s.first[d])), min(r + span, int(s.first[d + 1]))
        held = np.zeros((len(terms), high - low + 1), np.int64)
        for k, t in enumerate(terms.tolist()):
            a, b = np.searchsorted(self.keys, [t * s.size + low, t * s.size + high])
            held[k, self.keys[a:b] - t * s.size - low + 1] = 1
        upto = np.cumsum(held, axis=1)
        starts = np.arange(r - low + 1)
        full = (upto[:, np.minimum(starts + span, high - low)] - upto[:, starts] > 0).all(axis=0)
        return (low + starts[full & held[:, 1 : len(starts) + 1].any(axis=0)]).tolist()


# -- the stored index -----------------------------------------------------------------------------------------------

_INDEX = "segment long, doc_ids array<bigint>, tags array<bigint>, terms binary, counts binary, positions binary, first binary"


def build_index(docs: DataFrame) -> DataFrame:
    """The index as rows to be stored: one for each segment, with its documents, terms and posting lists.

    tags: hashes of the texts, which tell documents with the same doc_id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, texts in slices(batch, "text", SEGMENT_BYTES):
                values = [number, part.column("doc_id").to_pylist(), part.column("tag").to_pylist(), *Segment.of(texts).pack()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)
                number += 1

    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 4]
    names = ["segment", "doc_ids", "tags", "terms", "counts", "positions", "first"]
    text = F.col("text").cast("string")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    return own.mapInArrow(run, _INDEX)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Segment]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            yield row, Segment.unpack(*(row.column(c)[0].as_py() for c in ("terms", "counts", "positions", "first")))


def search_index(index: DataFrame, items: Items, span: int | None = None) -> DataFrame:
    """Matches (doc_id, item_id, kind, start, n_words): phrase for each occurrence of a window; near, if a span is given,
    for each place from which all of an item's first words follow inside that many words."""
    shared = index.sparkSession.sparkContext.broadcast(pickle.dumps(items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Items = pickle.loads(shared.value)
        for row, s in _segments(batches):
            doc_ids, search = row.column("doc_ids")[0].as_py(), Search(s, own)
            found = [(int(i), "phrase", size, int(p)) for at, size, pos in search.phrases() for i, p in zip(own.of_term(at), pos, strict=True)]
            found += [(i, "near", span, p) for i, places in (search.near(span) if span else ()) for p in places]
            rows = [(doc_ids[s.doc[p]], own.ids[i], kind, p - int(s.first[s.doc[p]]), size) for i, kind, size, p in found]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("n_words", pa.int64())])
    return index.mapInArrow(run, "doc_id long, item_id string, kind string, start long, n_words long")


def search_documents(index: DataFrame, block: bytes, every: bool = True) -> DataFrame:
    """Rows (segment, place, doc_id, tag, n_words, hits, items, near): the positions of a document's covered words, and the
    ids of items with phrases and near ones. Every document has a row, or those with hits alone."""
    shared = index.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Items = pickle.loads(shared.value)
        for row, s in _segments(batches):
            search, step = Search(s, own), np.zeros(s.size + 1, np.int64)
            items: dict[int, set[str]] = {}
            near: dict[int, set[str]] = {}
            for at, size, pos in search.phrases():
                np.add.at(step, pos, 1)
                np.add.at(step, pos + size, -1)
                for d, i in np.unique(np.stack([s.doc[pos], own.of_term(at)], 1), axis=0).tolist():
                    items.setdefault(d, set()).add(own.ids[i])
            for i, places in search.near():
                for d in np.unique(s.doc[places]).tolist():
                    near.setdefault(d, set()).add(own.ids[i])
            hit = np.flatnonzero(np.cumsum(step[:-1]) > 0)
            docs = np.arange(len(s.first) - 1) if every else np.array(sorted({*items, *near}), np.int64)
            cuts = np.searchsorted(hit, s.first)
            hits = [hit[cuts[d] : cuts[d + 1]] - s.first[d] for d in docs]
            names = lambda of: pa.array([sorted(of.get(d, ())) for d in docs.tolist()], pa.list_(pa.string()))
            ids, tags = (row.column(c).flatten().take(pa.array(docs)) for c in ("doc_ids", "tags"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row.column("segment")[0].as_py()] * len(docs), pa.int64()), pa.array(docs), ids, tags, pa.array(np.diff(s.first)[docs]), pa.array(hits, pa.list_(pa.int64())), names(items), names(near)],
                ["segment", "place", "doc_id", "tag", "n_words", "hits", "items", "near"],
            )

    return index.mapInArrow(run, "segment long, place long, doc_id long, tag long, n_words long, hits array<bigint>, items array<string>, near array<string>")


def item_pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id, piece and text: items as they are or, above PIECE_BYTES, as pieces that overlap by all but one word of a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                parts = [text or ""]
                if len(parts[0].encode()) > PIECE_BYTES:
                    words = Words([text.encode().lower()], ALNUM)
                    joined, at = words.joined()
                    step = max(1, PIECE_BYTES * len(words) // max(1, len(joined)))
                    parts = [joined[at[a] : at[min(a + step + window - 1, len(words))]].decode() for a in range(0, max(1, len(words) - window + 1), step)]
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(parts), pa.string()), pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.string())], ["item_id", "piece", "text"])

    own = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "item_id string, piece long, text string")


def item_blocks(benchmark: DataFrame, window: int = WINDOW) -> tuple[int, Iterator[bytes]]:
    """The number of blocks of about ITEM_BYTES, and the blocks of items, pickled, each fetched when it is its turn."""
    own = item_pieces(benchmark, window)
    total = own.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-total // ITEM_BYTES))

    def blocks() -> Iterator[bytes]:
        for k in range(n):
            part = own if n == 1 else own.where(F.pmod(F.xxhash64("item_id", "piece", "text"), F.lit(n)) == k)
            yield pickle.dumps(Items.of([(r.item_id, r.text, r.piece == 0) for r in part.collect()], window))

    return n, blocks()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, tag, n_words, n_hit, items and near (sorted ids of those with windows that occur, and of near ones) of every document."""
    index = materialize(build_index(docs), "postings")
    n, blocks = item_blocks(benchmark, window)
    if n == 1:
        found = search_documents(index, next(blocks))
    else:
        parts = [materialize(search_documents(index, block, every=k == 0), "hits") for k, block in enumerate(blocks)]
        union = parts[0]
        for part in parts[1:]:
            union = union.unionAll(part)
        every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
        found = union.groupBy("segment", "place").agg(F.min("doc_id").alias("doc_id"), F.min("tag").alias("tag"), F.max("n_words").alias("n_words"), every("hits"), every("items"), every("near"))
    return found.select("doc_id", "tag", "n_words", F.size("hits").cast("long").alias("n_hit"), "items", "near")


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = contamination(docs, benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), F.size("near").cast("long").alias("n_near"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, with all their columns. What is joined to them are ids and hashes of texts with hits."""
    key = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(NULL_ID))
    hit = contamination(docs, benchmark).where("n_hit > 0").select(key("doc_id").alias("key"), "tag").distinct()
    # the document travels as one column, so none of its names can clash
    rows = docs.select(F.struct("*").alias("row"), key("doc_id").alias("key"), F.xxhash64(F.col("text").cast("string")).alias("tag"))
    return rows.join(materialize(hit, "contaminated"), ["key", "tag"], "left_anti").select("row.*")


ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
q AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
      FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
g AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM q) WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, i, n FROM g JOIN q USING (n, s)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
-- near items: all of their first ten words inside twenty words of the document
e AS (SELECT row_number() OVER () AS r, coalesce(CAST(item_id AS VARCHAR), '') AS x, list_distinct(w[1:10]) AS ws FROM b WHERE len(w) > 0),
f AS (SELECT r, x, len(ws) AS k, unnest(ws) AS s FROM e),
o AS (SELECT doc_id, unnest(w) AS s, unnest(range(1, len(w) + 1)) AS i FROM d),
a AS (SELECT doc_id, r FROM (SELECT DISTINCT doc_id, s FROM o) JOIN f USING (s) GROUP BY doc_id, r, k HAVING count(*) = k),
c AS (SELECT doc_id, r, x, k, s, i FROM a JOIN f USING (r) JOIN o USING (doc_id, s)),
v AS (SELECT doc_id, count(DISTINCT x) AS n_near FROM (SELECT y.doc_id, y.x FROM c y JOIN c z ON y.doc_id = z.doc_id AND y.r = z.r AND z.i BETWEEN y.i AND y.i + 19
      GROUP BY y.doc_id, y.r, y.x, y.k, y.i HAVING count(DISTINCT z.s) = y.k) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, coalesce(CAST(item_id AS VARCHAR), '') AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id) LEFT JOIN v USING (doc_id)
"""
