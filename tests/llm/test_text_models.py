import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rainloom.llm import languages, phrases, toxicity

from .conftest import bag


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def hits(text, items, window=10):
    w, n, ids = words_of(text), set(), set()
    for item, t in items:
        v = words_of(t)
        size = min(window, len(v))
        for i in range(len(v) - size + 1 if size else 0):
            for j in range(len(w) - size + 1):
                if w[j : j + size] == v[i : i + size]:
                    n |= set(range(j, j + size))
                    ids.add("" if item is None else str(item))
    return len(w), len(n), sorted(ids)


def test_contamination(spark, docs, no_docs, rows, monkeypatch):
    shared = rows[7][1]
    items = [(10, shared), (9, "one"), (100, None), (101, "... !"), (None, rows[16][1].upper()), (7, "RIVER, stone"), (7, "cloud signal amber field"), (11, "never seen anywhere at all")]
    bench = spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, doc_id string")
    expected = sorted(((r[0], *hits(r[1], items)) for r in rows), key=repr)
    assert sum(bool(e[2]) for e in expected) > 10
    assert bag(phrases.contamination(docs, bench), "doc_id", "n_words", "n_hit", "items") == expected
    clean = phrases.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not e[2] for e in expected)
    assert phrases.query(no_docs, bench).count() == 0
    assert {r.n_hit for r in phrases.query(docs, bench.limit(0)).collect()} == {0}
    close = lambda w, own: any(own <= set(w[p : p + 20]) for p in range(len(w)))
    near = lambda t: len({i for i, v in items if words_of(v) and close(words_of(t), set(words_of(v)[:10]))})
    expected_near = sorted(((r[0], near(r[1])) for r in rows), key=repr)
    assert bag(phrases.query(docs, bench), "doc_id", "n_near") == expected_near
    # items in pieces, several blocks that are merged by document, and places tried in parts
    monkeypatch.setattr(phrases, "ITEM_BYTES", 500)
    monkeypatch.setattr(phrases, "PIECE_BYTES", 70)
    monkeypatch.setattr(phrases, "TRIED", 3)
    assert phrases.item_pieces(bench, 10).count() > len(items) + 5 and phrases.item_blocks(bench)[0] > 2
    found = phrases.contamination(docs, bench)
    assert bag(found.selectExpr("doc_id", "n_words", "n_hit", "items", "size(near) AS n"), "doc_id", "n_words", "n_hit", "items") == expected
    assert bag(found.selectExpr("doc_id", "size(near) AS n"), "doc_id", "n") == expected_near


def test_segments_come_back_as_they_were(rows):
    texts = [(r[1] or "").encode() for r in rows]
    s = phrases.Segment.of(texts)
    back = phrases.Segment.unpack(*s.pack())
    assert back.vocabulary.to_pylist() == s.vocabulary.to_pylist()
    for name in ("starts", "positions", "first"):
        assert (getattr(back, name) == getattr(s, name)).all()
    tokens = np.empty(s.size, object)
    for k, term in enumerate(s.vocabulary.to_pylist()):
        tokens[s.positions[s.starts[k] : s.starts[k + 1]]] = term.decode()
    assert tokens.tolist() == [w for r in rows for w in words_of(r[1])]


def test_stored_index_phrases_and_proximity(spark, tmp_path):
    texts = ["a b c d", "c x a y b", "a a b", None, "b c"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    phrases.build_index(docs).write.parquet(str(tmp_path / "ix"))
    index = spark.read.parquet(str(tmp_path / "ix"))
    items = phrases.Items.of([(1, "a b"), (2, "c a b"), (3, "q")])
    found = bag(phrases.search_index(index, items, 5), "doc_id", "item_id", "kind", "start")
    phrase = [(0, "1", "phrase", 0), (2, "1", "phrase", 1)]
    near = []
    for k, t in enumerate(texts):
        w = (t or "").split()
        for item, v in ((1, {"a", "b"}), (2, {"a", "b", "c"})):
            near += [(k, str(item), "near", i) for i in range(len(w)) if w[i] in v and v <= set(w[i : i + 5])]
    assert found == sorted(phrase + near, key=repr)


def labelled(n=700, seed=2):
    rng = np.random.default_rng(seed)
    plain = ["w" + "".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    bad = ["vilest", "grimstemon", "grimstemar", "grimsteol"]
    texts, toxic = [], []
    for _ in range(n):
        sentences = [" ".join(rng.choice(plain, 8)) for _ in range(rng.integers(1, 30))]
        y = rng.random() < 0.3
        if y:
            sentences[rng.integers(len(sentences))] += " " + str(rng.choice(bad))
        texts.append(". ".join(sentences) + ".")
        toxic.append(int(y))
    return texts, toxic


def test_toxicity_learns_from_documents_and_locates_sentences(spark):
    texts, toxic = labelled()
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)] + [(9000, None, ""), (9001, "", ""), (None, "vilest thing", ""), (0, texts[0], "")], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(k, 0, t) for k, t in enumerate(toxic)] + [(5, 1, None), (None, 1, 1), (123456, 0, 1)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.query(docs, labels).collect()}
    assert len(found) == len(texts) + 3 and toxicity.query(docs, labels).count() == len(texts) + 4
    own = [k for k in range(len(texts)) if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all(found[k].held_out == (k in own) for k in range(len(texts)))
    right = np.mean([found[k].predicted == toxic[k] for k in own])
    assert right > 0.97, right
    assert found[9000].score == found[9001].score == 0 and found[9000].n_sentences == 0 and found[None].held_out is False
    for k in [k for k in own if toxic[k] and found[k].predicted][:20]:
        r = found[k]
        assert re.search("vilest|grimste", texts[k].encode()[r.worst_start : r.worst_end].decode())
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == docs.count() - sum(r.predicted for r in toxicity.query(docs, labels).collect())


def test_toxicity_without_labels(docs, no_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.query(docs, none).collect()} == {0.0}
    assert toxicity.query(no_docs, none).count() == 0


def plain_hash(text, kind):
    h = kind
    for i, b in enumerate(text.encode()):
        h += (b + 1) * pow(toxicity._BASE, i, 2**64)
    h %= 2**64
    for c in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ h >> 33) * c % 2**64
    return h ^ h >> 33


def plain_score(text, weights, bias, leak):
    """By sentence, word and character: score, number of sentences and the worst one's score."""
    clean, n, worst = 0.0, 0, 0.0
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    for sentence in re.split("[\n!.?。！？…؟।]", low):
        words = re.findall("[0-9a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u05ff\u0620-\u06d3\u0900-\u0963\u0970-\u1fff\u2c00-\u2fff\u3040-\ufeff\U00010000-\U0010ffff]+", sentence)
        if not words:
            continue
        found = []
        for w in words:
            found += [plain_hash(w, 0)] + [plain_hash(w[:k], k) for k in (4, 5, 6) if len(w) >= k]
            found += [plain_hash(w[i : i + 2], 64) for i in range(len(w) - 1) if min(w[i : i + 2]) >= "\u0800"]
        n += 1
        if found := [f for f in found if f in weights]:
            p = 1 / (1 + np.exp(-bias - sum(weights[f] for f in found)))
            clean, worst = clean + np.log1p(-min(p, 1 - 1e-12)), max(worst, p)
    return -np.expm1(clean - (np.logaddexp(0, leak) if n else 0)), n, worst


ODD_TEXTS = ["今日は良い。明日は悪い！終わり。", "Это медведный день. Хорошо… да", "vilest grimstemon? Nope!\n\n. . ok", "", " . ! ", "naïve—dash “quoted” words… end", "ไทยไม่มีวรรค grimste", "w" * 50, "ABC grimstemar.grimsteol", "a，b、c。d"]


def test_scores_equal_a_plain_scorer():
    texts, toxic = labelled(300)
    texts += ["今日は悪い日だ。" if k % 2 else "今日は良い日だ。" for k in range(60)]
    toxic += [k % 2 for k in range(60)]
    model = toxicity.fit([t.encode() for t in texts], np.array(toxic))
    weights = dict(zip(model.keys.tolist(), model.weights.tolist(), strict=True))
    given = ODD_TEXTS + texts[:60] + texts[-4:]
    score, count, worst, bounds = model.score([t.encode() for t in given])
    plain = [plain_score(t, weights, model.bias, model.leak) for t in given]
    assert count.tolist() == [n for _, n, _ in plain]
    np.testing.assert_allclose(score, [p for p, _, _ in plain], atol=1e-9)
    np.testing.assert_allclose(worst, [w for _, _, w in plain], atol=1e-9)
    for t, w, (a, b) in zip(given, worst, bounds, strict=True):
        assert (a == -1) == (w == 0)
        if a >= 0:
            np.testing.assert_allclose(plain_score(t.encode()[a:b].decode(), weights, model.bias, model.leak)[1:], (1, w), atol=1e-9)


def test_length_alone_is_not_toxic():
    texts, toxic = labelled(300)
    model = toxicity.fit([t.encode() for t in texts], np.array(toxic))
    clean = [t for t, y in zip(texts, toxic, strict=True) if not y]
    short, long = model.score([clean[0].encode(), b"Nothing is said here at all. " * 200_000])[0]
    assert long <= short + 1e-9 < 0.5


def test_long_texts_are_scored_in_pieces(monkeypatch):
    texts, toxic = labelled(300)
    model = toxicity.fit([t.encode() for t in texts], np.array(toxic))
    given = [" ".join(texts[a : a + 40]).encode() for a in (0, 40, 80)] + [b"", "悪い。".encode() * 900]
    whole = model.score(given)
    monkeypatch.setattr(toxicity, "PIECE", 3000)
    for a, b in zip(model.score(given), whole, strict=True):
        np.testing.assert_allclose(a, b, atol=1e-12)
    for t in [*given, b"x" * 10_000, "é".encode() * 5000]:
        parts = list(toxicity.pieces(t))
        assert b"".join(p for _, p in parts) == t and all(len(p) <= 3000 and t[a : a + len(p)] == p for a, p in parts)
        assert [p.decode() for _, p in parts] and max(len(p) for _, p in parts) <= 3000


@pytest.mark.parametrize("bad, good", [("internationalism", "internationally"), ("медведный", "медведок"), ("今日は悪い日だ", "今日は良い日だ")])
def test_words_alike_at_their_beginning(bad, good):
    toxic = np.arange(300) % 3 == 0
    texts = [f"alpha{k % 7} beta gamma {bad if y else good} delta. other words here.".encode() for k, y in enumerate(toxic)]
    assert ((toxicity.fit(texts, toxic).score(texts)[0] >= toxicity.THRESHOLD) == toxic).all()


def test_gradient_of_the_noisy_or():
    rng = np.random.default_rng(5)
    rows, cols, doc = rng.integers(0, 30, 80), rng.integers(0, 6, 80), np.sort(rng.integers(0, 9, 30))
    args = (rows, cols, doc, (np.arange(10) % 3 == 0).astype(float), 0.01)
    theta = rng.normal(size=8)
    found, eps = toxicity.loss_and_gradient(theta, *args)[1], 1e-6
    for k in range(8):
        up, down = theta.copy(), theta.copy()
        up[k] += eps
        down[k] -= eps
        slope = (toxicity.loss_and_gradient(up, *args)[0] - toxicity.loss_and_gradient(down, *args)[0]) / (2 * eps)
        assert abs(slope - found[k]) < 1e-6


def plain_languages(texts, names, asked):
    """Names and scores by dictionaries of n-grams and one bit set for each language."""
    fold = lambda t: bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in b" " + t + b"    ")

    def grams(t):
        folded = fold(t)
        return [int.from_bytes(folded[i : i + 4]) for i in range(len(t) - 1) if folded[i : i + 4].strip()]

    slots = lambda g: [((g ^ g >> 15) * m & 0xFFFFFFFF) >> 12 for m in (0x9E3779B1, 0x85EBCA6B)]
    counts = {n: Counter(g for t, m in zip(texts, names, strict=True) if m == n for g in grams(t)) for n in sorted(set(names))}
    total = {n: sum(c.values()) for n, c in counts.items()}
    kept = {n: {g for g, k in c.items() if k >= 5 and k / total[n] >= 0.25 * max(counts[m][g] / total[m] for m in counts)} for n, c in counts.items()}
    bits = {n: {s for g in kept[n] for s in slots(g)} for n in counts}
    rate = {n: sum(counts[n][g] for g in kept[n]) / total[n] for n in counts}
    out = []
    for t in asked:
        own = grams(t)
        share = {}
        for n in counts:
            false = (len(bits[n]) / 2**20) ** 2
            hits = sum(all(s in bits[n] for s in slots(g)) for g in own)
            share[n] = max(hits - len(own) * false, 0) / (1 - false) / max(len(own), 1) / rate[n]
        best = max(share, key=lambda n: (share[n], [-ord(c) for c in n]))
        out.append((best, share[best] / sum(share.values()) if sum(share.values()) else 0.0))
    return out


def test_languages_equal_a_plain_version(spark, sf_dir):
    docs = [r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang").collect() if r.text and r.lang]
    texts, names = [r.text.encode()[:1500] for r in docs[:40]], [r.lang for r in docs[:40]]
    texts = [t.decode(errors="ignore").encode() for t in texts]
    asked = [t[:400].decode(errors="ignore").encode() for t in texts[:15]] + ["Ωμέγα".encode(), b"zzzz qqqq", b"the der la", b"a"]
    found, score = languages.Filters(texts, names).predict(asked)
    plain = plain_languages(texts, names, asked)
    np.testing.assert_allclose(score, [s for _, s in plain], atol=1e-9)
    assert found == [n for n, _ in plain]


def test_rare_languages_are_learned(spark, monkeypatch):
    """A language with a few texts among many keeps its share of the sample."""
    monkeypatch.setattr(languages, "SAMPLE", 40)
    rows = [(k, "the river and the stone north of the cloud " * 3, "en") for k in range(900)] + [(1000 + k, "żółw gęś ćma łąka źrebię " * 5, "pl") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert languages.train(docs).languages == ["en", "pl"]
    found = {r.doc_id: r.lang_pred for r in languages.query(docs).collect()}
    assert [found[k] for k, _, _ in rows] == [lang for _, _, lang in rows]


def test_language_filters(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame([(90001, None, "en"), (90002, "", None), (90003, "12 34 !!", "fr"), (90004, "ЖЖ ЩЩ", None), (None, "the of and", "en")], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in languages.query(docs.unionByName(extra, allowMissingColumns=True)).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    own = [k for k, r in found.items() if r.held_out and k in truth]
    assert all(r.held_out == (k is not None and zlib.crc32(str(k).encode()) % 4 == 2) for k, r in found.items())
    assert np.mean([found[k].lang_pred == truth[k] for k in own if truth[k]]) > 0.97
    assert [found[k].lang_pred for k in (90001, 90002, 90003)] == ["und"] * 3 and found[90004].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in found.values())


def test_filters_hold_all_their_ngrams():
    texts = [b"abcd efgh " * 9, b"wxyz efgh " * 9]
    f = languages.Filters(texts * 5, ["aa", "bb"] * 5)
    gram = lambda s: np.frombuffer(s, ">u4").astype(np.uint32)
    mask = f.lookup(np.concatenate([gram(b"abcd"), gram(b"wxyz"), gram(b"efgh")]))[0]
    assert (mask & 1).tolist() == [1, 0, 1] and (mask >> 1 & 1).tolist() == [0, 1, 1]
    many = languages.Filters([bytes([97 + k % 26, 97 + k // 26]) * 40 for k in range(70)], [f"l{k:02}" for k in range(70)])
    assert len(many.tables) == 2 and many.predict([b"fcfcfcfcfcfc"])[0] == ["l57"]


def test_languages_on_odd_tables(docs, no_docs):
    assert languages.query(docs).count() == docs.count() and languages.query(no_docs).count() == 0
    assert {r.lang_pred for r in languages.query(docs.drop("lang").selectExpr("*", "cast(null as string) lang")).collect()} == {"und"}
