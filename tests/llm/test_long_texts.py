"""Every query and the pipeline on texts of 1 and 20 MB, beside null, empty and repeated ones."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from rainloom.llm.queries import QUERIES

from .conftest import passage


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(3)
    part = passage(rng, 30_000)
    long = "".join(f"{part[a : a + 3000]} n{k} {k * 7919 % 10007}. " for k, a in enumerate(rng.randrange(len(part) - 3000) for _ in range(6700)))
    other = "".join(f"m{k} {k * 104729 % 1009} {part[k % 900 * 100 : k % 900 * 100 + 900]}\n" for k in range(1000)) + " ".join(f"only{k}" for k in range(40))
    texts = [long, other, None, "", "one two three", other, part[:5000], "the vilest words of all " * 9, "plain and quiet words here " * 9]
    out = tmp_path_factory.mktemp("long")
    ids = list(range(len(texts)))
    names = ["en" if k % 2 else None for k in ids]
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts, "lang": names, "source": pa.array(["a", None, "b"] * 3), "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}), out / "documents.parquet")
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "quality": pa.array([0] * 9, pa.int64()), "toxic": pa.array([0] * 7 + [1, 0], pa.int64())}), out / "labels.parquet")
    pq.write_table(pa.table({"item_id": pa.array([1, 2], pa.int64()), "text": [" ".join(f"only{k}" for k in range(40)), "never seen before in any text of these"]}), out / "benchmark.parquet")
    pq.write_table(pa.table({"conv_id": pa.array([1, 1, 2], pa.int64()), "turn": pa.array([0, 1, 0], pa.int64()), "role": ["user", "assistant", "user"], "text": [long, other, None]}), out / "conversations.parquet")
    return str(out), texts


def test_sizes(folder):
    assert len(folder[1][0]) > 20_000_000 and len(folder[1][1]) > 900_000


#: Those over vectors, which have no texts.
VECTORS = {"op11_topk_search", "op13_embedding_whitening"}


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - VECTORS))
def test_queries(spark, folder, name):
    path, texts = folder
    found = QUERIES[name](spark, path).toArrow().to_pylist()
    if name == "op5_chat_formatting":
        own = {r["conv_id"]: r for r in found}
        assert set(own) == {-1, 1, 2} and own[1]["loss_sha256"] == hashlib.sha256(texts[1].encode()).hexdigest()
        assert own[1]["turns_sha256"] == hashlib.sha256(f"user\n{texts[0]}\nassistant\n{texts[1]}\n".encode()).hexdigest()
        return
    own = {r["doc_id"]: r for r in found}
    assert sorted(own) == list(range(9)) and len(found) == 9
    words = [len((t or "").split()) for t in texts]
    if name == "op1_flac_media":
        for k, t in enumerate(texts):
            b = (t or "").encode()
            b += bytes(-len(b) % 64 or (0 if b else 64))
            assert (own[k]["payload_bytes"], own[k]["payload_sha256"], own[k]["tail_crc32"]) == (len(b), hashlib.sha256(b).hexdigest(), zlib.crc32(b[-64:]))
    elif name == "op3_decontamination":
        assert [own[k]["contaminated"] for k in range(9)] == [k in (1, 5) for k in range(9)] and own[1]["n_hit"] == 40
    elif name == "op4_token_blocks":
        ends = [own[k]["start"] + own[k]["n_tokens"] for k in range(9)]
        assert [own[k]["start"] for k in range(9)] == [0, *ends[:-1]] and own[0]["n_tokens"] > 3_000_000
    elif name == "op6_pareto_mixing":
        assert [own[k]["size"] for k in range(9)] == words
    elif name == "op8_substring_dedup":
        assert [own[k]["n_words"] for k in range(9)] == words and own[5]["n_removed"] == words[5] and own[4]["n_removed"] == 0
    elif name == "op9_simhash_near_dedup":
        assert own[5]["component_id"] == own[1]["component_id"] <= 1 and own[5]["fingerprint"] == own[1]["fingerprint"]
    elif name == "op12_importance_resampling":
        runs = [len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())) for t in texts]
        assert [own[k]["n_features"] for k in range(9)] == [max(2 * n - 1, 0) for n in runs] and own[0]["n_features"] > 6_000_000
    elif name == "op10_jump_sharding":
        assert own[0]["text_crc32"] == zlib.crc32(texts[0].encode())


def test_pipeline(spark, folder):
    path, texts = folder
    found = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in found} <= {0, 2, 3, 4, 6, 7, 8} and 0 in {r.doc_id for r in found}
