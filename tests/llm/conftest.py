import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

WORDS = [a + b for a in "ka lo mi nu pe ra so tu ve xi".split() for b in "ban del fir gos hun jat".split()]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def awkward_rows():
    """Ordinary texts, near and exact copies, nulls, empties, a long text, repeated rows."""
    rng = random.Random(7)
    base = [sentence(rng, 60) for _ in range(12)]
    near = base[0].split()
    near[30] = "other"
    rows = list(enumerate(base)) + [(20, " ".join(near)), (21, base[1]), (21, base[1]), (22, base[2].upper())]
    rows += [(30, None), (31, ""), (32, " \n\t "), (33, "one two"), (34, "one two"), (None, base[3]), (None, None)]
    rows += [(40, sentence(rng, 60_000)), (41, "!!! $$$ ###"), (42, "émigré 日本 🙂 " + base[4]), (43, "spam spam " * 50)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    docs = spark.createDataFrame(awkward_rows, "doc_id long, text string")
    clashing = "kept n_words score label cluster size rep data root _text_in tokens key copies block position".split()
    return docs.select("*", F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"), *[F.lit("x").alias(c) for c in clashing])


@pytest.fixture(scope="session")
def small_dir(spark, awkward, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    awkward.write.parquet(f"{folder}/documents.parquet")
    rng = random.Random(9)
    labels = [Row(doc_id=i, quality=int(i < 35), toxic=0) for i in (0, 2, 3, 4, 5, 6, 7, 8, 9, 40, 41, 43)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, sentence(rng, 20)), (2, None), (3, ""), (4, "three short words"), (None, "unknown"), (4, "three short words")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    pages = [(1, "u", "<article><p>a</p></article>" * 10), (2, "v", "<article><p>a</p></article>" * 10), (3, None, None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(4)], i % 3) for i in range(0, 300, 10)] + [(5, None, 1), (6, [None], 1), (None, [0.1], 2)]
    made = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    made.selectExpr("*", "'x' AS id", "0 AS rank", "'y' AS block", "1 AS score").write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_dir(spark, small_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "benchmark", "pages", "embeddings"):
        spark.read.parquet(f"{small_dir}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder
