import zlib

import numpy as np

import corpus_pipeline
from rainloom.llm import mixing, phrases, simhash, token_blocks, toxicity
from rainloom.llm.common import table


def test_stages_by_plain_versions(spark, sf_dir):
    """Every stage against what the operators' queries, which have their own plain versions, say of its input."""
    docs = table(spark, sf_dir, "documents").cache()
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-dedup", "benchmark decontamination", "source mixing", "token output"]
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    want = [
        lambda d: ids(toxicity.query(d, table(spark, sf_dir, "labels")).where("predicted = 0")),
        lambda d: ids(simhash.query(d).where("doc_id = component_id")),
        lambda d: ids(phrases.query(d, table(spark, sf_dir, "benchmark")).where("NOT contaminated")),
        lambda d: sorted(r.doc_id for r in mixing.query(d).collect() for _ in range(r.copies)),
    ]
    for (_, stage), expected in zip(corpus_pipeline.STAGES, want, strict=False):
        out = stage(spark, docs, sf_dir).cache()
        assert out.columns == columns and ids(out) == expected(docs) and 0 < len(ids(out))
        docs = out
    tokens = corpus_pipeline.STAGES[4][1](spark, docs, sf_dir)
    found = sorted(tokens.collect(), key=lambda r: r.start)
    own = token_blocks.encoder(__import__("public_tokenizers").path("word_bpe_49k.json"))
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()))
    assert [r.doc_id for r in found] == [d for d, _ in texts]
    start = 0
    for r, (_, t) in zip(found, texts, strict=True):
        encoded = np.append(own.whole.encode(t, add_special_tokens=False).ids, 1).astype("<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(encoded), zlib.crc32(encoded.tobytes()))
        start += r.n_tokens
    again = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, tokens.collect()))


def test_stages_on_odd_tables(spark, docs, no_docs, sf_dir):
    for given in (docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, given, sf_dir)
            assert out.columns == given.columns and out.count() <= 3 * given.count()
        tokens = corpus_pipeline.STAGES[4][1](spark, given, sf_dir)
        assert tokens.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and tokens.count() == given.count()
