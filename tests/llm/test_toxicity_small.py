import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corvox.llm import toxicity


@pytest.fixture
def small(spark, tmp_path):
    """150 labelled texts, a quarter of them with planted words."""
    draw = random.Random(8)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(3, 6))) for _ in range(400)]
    rows, labels = [], []
    for i in range(150):
        own = [draw.choice(words) for _ in range(draw.randint(20, 60))]
        if i % 4 == 0:
            for w in ("vilezz", "nastyqq", "grimxx"):
                own.insert(draw.randrange(len(own)), w)
        rows.append((i, " ".join(own)))
        labels.append((i, 1, int(i % 4 == 0)))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)


def test_few_labelled_texts_give_a_model(spark, small):
    docs, folder = small
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert {"vilezz", "nastyqq", "grimxx"} <= set(model.odds)
    left = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, folder).collect()}
    assert sum(i % 4 == 0 for i in left) <= 3 and sum(i % 4 > 0 for i in left) >= 108


@pytest.mark.parametrize(("sf", "least", "false"), [("sf0.01", 0.8, 0.03), ("sf0.1", 0.93, 0.03)])
def test_held_out_rows_of_the_given_tables(spark, sf, least, false):
    """The area under the curve of rows that the fit never saw, and the clean ones among them that are called toxic."""
    folder = f"/root/testdata/{sf}"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    own = docs.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    rows = toxicity.scored(own.select("doc_id", "text", "toxic"), model).select("toxic", "score", "predicted").collect()
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == k] for k in (1, 0))
    wins = sum((a > b) + (a == b) / 2 for a in toxic for b in clean)
    assert wins >= least * len(toxic) * len(clean)
    assert sum(s >= 0.5 for s in clean) <= false * len(clean)


def test_one_label_only_gives_no_model(spark, small):
    docs, folder = small
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumn("toxic", F.lit(0))
    assert {r["predicted"] for r in toxicity.scored(docs, toxicity.fit(docs, labels)).collect()} == {0}
    assert toxicity.fit(docs, labels.withColumn("toxic", F.lit(1))).odds == {}
