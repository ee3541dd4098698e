import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `key` string, `label` int, `size` double, `later` long, `_key` long"
#: Rows that every operator must take: nulls everywhere, empty, blank and very long texts, copies, repeated rows.
WORDS = "the of and to in court held appeal section order judge case law party claim fact plea writ bench stay".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed"]) + (rng.choice(".,") if rng.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    long = prose(1, 6000)
    base = prose(2, 120)
    texts = [None, "", " \n\t", "One", "Zwölf Böcke.", base, base, base + " appended tail words here", prose(3, 90) + " " + base, long, "x" * 500, "Ünïcödé – 漢字 кириллица " * 9, "!!! ??? ..."]
    rows = [(k, t, ["en", "de", None, "fr"][k % 4], ["b", "a", None][k % 3], None if t is None else len(t), "k", 1, 0.5, 7, 8) for k, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, base, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def odd_labels(spark):
    return spark.createDataFrame([(k, (k % 2) if k != 4 else None, (k // 2) % 2, "x") for k in range(13)] + [(None, 1, 1, "x"), (5, 0, 1, "x"), (7, 9, 9, "x")], "doc_id long, quality int, toxic int, text string")


@pytest.fixture
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@pytest.fixture
def benchmark_items(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")
