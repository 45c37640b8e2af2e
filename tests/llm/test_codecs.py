import hashlib
import random
import tracemalloc
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rainloom.llm import flac, media, token_blocks
from rainloom.llm.common import NULL_ID, slices

from .conftest import bag

PATH = public_tokenizers.path("word_bpe_49k.json")
SAMPLES = [b"", b"a" * 64, bytes(range(256)) * 40, bytes(9000), np.random.default_rng(0).bytes(6400), "é日本 text ".encode() * 900, b"the river " * 700]


def test_flac_round_trip_by_both_decoders():
    payloads = [media.payload(x) for x in SAMPLES]
    streams = flac.encode(payloads)
    signed = [(np.frombuffer(p, np.uint8) ^ 0x80).tobytes() for p in payloads]
    assert flac.decode(streams) == signed and [flac.decode_plain(s) for s in streams] == signed
    head = flac.read_head(streams[3])
    assert (head.channels, head.bits, head.samples, len(head.seek)) == (1, 8, len(payloads[3]), 3)
    first, block = flac.seek(streams[2], 5000)
    assert first == 4096 and block == signed[2][4096:8192]
    assert flac.decode([]) == [] and flac.encode([]) == []


@pytest.mark.parametrize("frames", [127, 128, 129, 2047, 2048, 2049])
def test_flac_frame_numbers_of_every_length(frames):
    text = (b"the river stone lies north of the cloud. " * 220_000)[: frames * flac.BLOCK - 16]
    payload = media.payload(text)
    signed = (np.frombuffer(payload, np.uint8) ^ 0x80).tobytes()
    stream = flac.encode([b"a" * 64, payload])[1]
    assert flac.decode([stream]) == [signed]
    for frame in {0, 127, 128, frames - 1} & set(range(frames)):
        first, block = flac.seek(stream, frame * flac.BLOCK + 9)
        assert first == frame * flac.BLOCK and block == signed[first : first + flac.BLOCK]
    if frames < 200:
        assert flac.decode_plain(stream) == signed


def test_flac_runs_of_frames(monkeypatch):
    payloads = [media.payload(x) for x in SAMPLES]
    whole = flac.encode(payloads)
    monkeypatch.setattr(flac, "FRAMES", 2)
    assert flac.encode(payloads) == whole and flac.decode(whole) == [(np.frombuffer(p, np.uint8) ^ 0x80).tobytes() for p in payloads]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(max_size=5000), min_size=1, max_size=5))
def test_flac_any_bytes(texts):
    payloads = [media.payload(x) for x in texts]
    assert [(np.frombuffer(s, np.uint8) ^ 0x80).tobytes() for s in flac.decode(flac.encode(payloads))] == payloads


@pytest.mark.parametrize("at", [-1, -40, 70, 200])
def test_flac_damage_is_found(at):
    stream = bytearray(flac.encode([media.payload(b"the river stone " * 300)])[0])
    stream[at] ^= 4
    with pytest.raises(flac.FlacError):
        flac.decode([bytes(stream)])
    with pytest.raises(flac.FlacError):
        flac.decode([bytes(stream[:-9])])


class Writer:
    """Bits of a frame written one by one."""

    def __init__(self):
        self.bits = ""

    def put(self, value, n):
        self.bits += format(value & ((1 << n) - 1), f"0{n}b") if n else ""

    def unary(self, n):
        self.bits += "0" * n + "1"

    def bytes(self):
        self.bits += "0" * (-len(self.bits) % 8)
        return int(self.bits, 2).to_bytes(len(self.bits) // 8)


def test_plain_decoder_on_stereo_partitions_escapes_and_wasted_bits():
    rng = random.Random(4)
    left = [rng.randrange(-3000, 3000) * 2 for _ in range(32)]
    right = [x + rng.randrange(-9, 9) * 2 for x in left]
    w = Writer()
    for value, n in ((0x3FFE, 14), (0, 2), (6, 4), (0, 4), (8, 4), (4, 3), (0, 1), (0, 8), (31, 8)):
        w.put(value, n)
    w.put(flac._crc_plain(w.bytes(), 7, 8), 8)
    # the left channel: fixed, order 1, one wasted bit, two partitions, the second one escaped
    half = [x >> 1 for x in left]
    w.put(0, 1), w.put(9, 6), w.put(1, 1), w.unary(0), w.put(half[0], 15), w.put(0, 2), w.put(1, 4)
    residual = [b - a for a, b in zip(half, half[1:], strict=False)]
    w.put(10, 4)
    for r in residual[:15]:
        u = r << 1 ^ r >> 63
        w.unary(u >> 10), w.put(u, 10)
    w.put(15, 4), w.put(14, 5)
    for r in residual[15:]:
        w.put(r, 14)
    # the side channel: verbatim at one bit more
    w.put(0, 1), w.put(1, 6), w.put(0, 1)
    for a, b in zip(left, right, strict=True):
        w.put(a - b, 17)
    frame = w.bytes()
    frame += flac._crc_plain(frame, 0x8005, 16).to_bytes(2)
    info = (32).to_bytes(2) * 2 + bytes(6) + (8000 << 44 | 1 << 41 | 15 << 36 | 32).to_bytes(8) + bytes(16)
    stream = b"fLaC\x80" + len(info).to_bytes(3) + info + frame
    pcm = np.frombuffer(flac.decode([stream])[0], "<i2").reshape(-1, 2)
    assert pcm[:, 0].tolist() == left and pcm[:, 1].tolist() == right


def test_media_query(docs, no_docs, rows):
    found = media.query(docs)
    expected = []
    for r in rows:
        b = (r[1] or "").encode()
        p = media.payload(b)
        expected.append((r[0], len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    assert bag(found, "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == sorted(expected, key=repr)
    for r in found.join(media.to_flac(docs).select("doc_id", "n_bytes", "media"), ["doc_id", "n_bytes"]).collect():
        if hashlib.sha256(r.media).hexdigest() == r.media_sha256:  # ids repeat
            x = np.frombuffer(flac.decode_plain(r.media), np.int8).tolist()
            crossings = sum((a < 0) != (b < 0) for a, b in zip(x, x[1:], strict=False))
            assert r.media_bytes == len(r.media)
            assert r.feature == f"mean={sum(x) * 1000 // len(x)};energy={sum(v * v for v in x) * 1000 // len(x)};crossings={crossings};peak={max(map(abs, x))}"
    assert found.select("payload_sha256", "media_sha256", "feature").distinct().count() == len({e[3] for e in expected})
    assert media.query(no_docs).count() == 0


def test_pcm_blocks(spark):
    text = "the river stone " * 600
    stored = media.to_flac(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"))
    blocks = media.pcm_blocks(stored.unionByName(spark.createDataFrame([(3, 0, b"fLaC"), (4, 0, None)], "doc_id long, n_bytes long, media binary"))).orderBy("doc_id", "block").collect()
    assert [(b.doc_id, b.block, b.first_sample, b.n_samples) for b in blocks[:4]] == [(1, 0, 0, 4096), (1, 1, 4096, 4096), (1, 2, 8192, 1408), (2, 0, 0, 64)]
    assert (np.frombuffer(b"".join(b.pcm for b in blocks[:3]), np.uint8) ^ 0x80).tobytes() == text.encode()
    assert [(b.doc_id, b.error is not None) for b in blocks[4:]] == [(3, True)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=400), max_size=4))
def test_blocks_round_trip(documents):
    lengths = np.array([len(d) for d in documents], np.int64)
    ids = np.array([x for d in documents for x in d], np.uint32)
    payloads = token_blocks.encode_blocks(ids, lengths)
    back, sizes = token_blocks.decode_blocks(payloads)
    assert back.tolist() == ids.tolist() and sizes.tolist() == lengths.tolist()
    for d, p in zip(documents, payloads, strict=True):
        for k in range(-(-len(d) // 128)):
            assert token_blocks.read_block(p, k).tolist() == d[128 * k : 128 * k + 128]


ODD = ["it's <|endoftext|> OK", "DON'T o'sell ''s \"'re x's't i'm,5'd we'll'", "a1b2 ß İstanbul", "é é", "a\xa0b c", "\x1c\x1d hi", "ſ ŉ", "１２ ٣", "x" * 3000, "", " \n", "ÀÉ ÿ´¨", "日本語", "don't", "a'S b'LL ''", "'s", "x--y..z 12,345"]


def test_encoder_equals_the_library(rows):
    own = token_blocks.TextEncoder(PATH)
    texts = ODD + [r[1] or "" for r in rows]
    for _ in range(2):  # the second time from the cache
        assert [x.tolist() for x in own.encode(texts)] == [own.whole.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abstreLMd'’ \n\t.,-01éÉßİſ<|>end日́"), max_size=40))
def test_encoder_on_any_text(text):
    own = token_blocks.encoder(PATH)
    assert own.encode([text])[0].tolist() == own.whole.encode(text, add_special_tokens=False).ids


def test_encoder_on_every_character():
    own = token_blocks.TextEncoder(PATH)
    texts = [t for c in [*range(0x250), 0x300, 0x3A3, 0x2028, 0xFEFF, 0xFFFD, 0x1F600] for t in (chr(c), f"Ab{chr(c)}cD 1{chr(c)}{chr(c)}'s <{chr(c)}")]
    assert [x.tolist() for x in own.encode(texts)] == [own.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert own.encode([]) == []
    for broken in (b"a\xc3", b"\xc3a", b"\x80", b"\xff"):
        with pytest.raises(UnicodeDecodeError):
            own.encode_all([b"plain", broken, b"plain"])


def test_words_of_many_slices_stay_known(monkeypatch):
    monkeypatch.setattr(token_blocks, "CACHE", 300)
    own, learnt = token_blocks.TextEncoder(PATH), Counter()
    learn = own._learn
    monkeypatch.setattr(own, "_learn", lambda new: (learnt.update(new), learn(new)))
    made = ("".join(x) for x in product("bcdfghjklm", "aeiou", "npqrst", "aeiou", "vwxyz"))
    common = [next(made) for _ in range(100)]
    for _ in range(40):
        text = " ".join([*common, *(next(made) for _ in range(60))])
        assert own.encode([text])[0].tolist() == own.whole.encode(text, add_special_tokens=False).ids
    assert len(learnt) == 100 + 40 * 60 and set(learnt.values()) == {1}
    assert len(own.known) <= 300 + 160


def test_slices_take_out_one_run_at_a_time():
    batch = pa.record_batch([pa.array(range(5)), pa.array(["ab", None, "", "éé", "c"])], ["n", "text"])
    for part, first in ((batch, 0), (batch.slice(1), 1)):
        texts = [b"ab", b"", b"", "éé".encode(), b"c"][first:]
        for limit in (1, 3, 6, 100):
            found = list(slices(part, "text", limit))
            assert [x for _, t in found for x in t] == texts and [x for rows, _ in found for x in rows["n"].to_pylist()] == list(range(first, 5))
            assert all(sum(map(len, t[:-1])) < limit for _, t in found) and all(sum(map(len, t)) >= limit for _, t in found[:-1])
    large = pa.record_batch([pa.array([f"{k}" + "y" * 3000 for k in range(5000)])], ["text"])
    tracemalloc.start()
    assert sum(len(t) for _, t in slices(large, "text", 1_000_000)) == 5000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5_000_000


def test_token_query(docs, no_docs, rows):
    tok, start, expected = Tokenizer.from_file(PATH), 0, []
    tag = {r.t: r.h for r in docs.selectExpr("coalesce(text, '') AS t").selectExpr("t", "xxhash64(t) AS h").collect()}
    for r in sorted(rows, key=lambda r: (NULL_ID if r[0] is None else r[0], tag[r[1] or ""])):
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [1]
        expected.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert bag(token_blocks.query(docs), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)
    assert token_blocks.query(no_docs).count() == 0
