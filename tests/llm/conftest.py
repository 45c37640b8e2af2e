import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, shard string, __key string, score int"
WORDS = "the of and river stone north cloud signal amber field über straße niño café 42 x9 old-time token, end.".split()


def passage(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def made_rows() -> list[tuple]:
    """Documents with nulls in any column, empty and long texts, copies, near copies, shared passages, repeated rows and ids."""
    rng = random.Random(7)
    shared = passage(rng, 60)
    texts = [None, "", " \t\n", "one", "A b", passage(rng, 12), passage(rng, 13), shared, "\x00\x7f \x0b control", "日本語 のテキスト です", "😀 " * 20]
    texts += [passage(rng, rng.randint(14, 90)) for _ in range(24)]
    texts += [passage(rng, 20) + " " + shared + "\n" + passage(rng, 15) for _ in range(8)]
    long = passage(rng, 3000)
    texts += [long, long.replace("river", "stream", 1), long.upper(), "same words here " * 40, texts[14], texts[14], texts[20] + " and more"]
    rows = [(k * 3 % 97, t, ("en", "de", None)[k % 3], ("b", "a", None, "B")[k % 4], None if k % 5 else len(t or ""), "clash", "clash", "clash", 1) for k, t in enumerate(texts)]
    rows += [rows[14], rows[14], rows[0], (rows[15][0], "another text under the same id " + shared, "en", "a", 1, None, None, None, None)]
    rows += [(None, shared, "en", "a", 1, None, None, None, None), (None, None, None, None, None, None, None, None, None), (None, "null id twice", None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return made_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
