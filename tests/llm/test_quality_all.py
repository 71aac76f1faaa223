import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import quality


def strengths(ranking, texts):
    # Features are stored in single precision.
    return np.array([quality.features(t.encode()).astype("<f4").astype(float) @ ranking.weights for t in texts])


def test_threshold_comes_from_all_labelled_documents(spark):
    """More documents of each class than any bounded sample held: as many lie below as are marked bad."""
    docs = [(i, ("ab " * (i % 7 + 1) + "!?" * (i % 5)) if i % 9 < 4 else "word, " * (i % 11 + 1) + str(i)) for i in range(9000)]
    marks = [(i, int(i % 9 >= 4) if i % 50 else int(i % 9 < 4)) for i, _ in docs]
    ranking = quality.fit(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(marks, "doc_id long, quality int"), F.col("doc_id") < 0)
    found = strengths(ranking, [t for _, t in docs])
    bad = sum(q == 0 for _, q in marks)
    assert bad > 3000 and len(docs) - bad > 3000
    assert ranking.threshold == pytest.approx(quality.quantile(found, np.ones(len(found)), bad / len(found)), abs=1e-9)


@pytest.mark.parametrize("bad", [1, 3, 40, 300])
def test_every_labelled_document_is_compared(spark, bad):
    """However rare a class: each document has one first block, and meets the other class in all its blocks."""
    docs = spark.range(1000).selectExpr("id AS doc_id", "concat('text ', id) AS text").unionByName(
        spark.createDataFrame([(0, None), (7, "again")], "doc_id long, text string"))
    known = spark.range(900).selectExpr("id AS doc_id", f"CAST(id >= {bad} AS INT) AS quality")
    blocks = quality._blocks(docs, known, F.col("doc_id") >= 800).collect()
    own = sum(sum(r.own) for r in blocks)
    assert own == 802
    alone = sum(len(set(r.quality)) < 2 for r in blocks)
    assert alone <= 0.05 * len(blocks)
    assert max(len(r.quality) for r in blocks) < 8 * quality.BLOCK_DOCS


def test_weights_are_at_the_minimum(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat(CASE WHEN id % 3 = 0 THEN 'a, ' ELSE 'B; 1' END, 1 + id % 6) AS text")
    known = spark.range(400).selectExpr("id AS doc_id", "CAST(id % 3 = 0 OR id % 10 = 1 AS INT) AS quality")
    blocks = quality._blocks(docs, known, F.lit(False)).localCheckpoint()
    weights = quality.fit_blocks(blocks)
    loss, _ = quality._loss(blocks, weights)
    draw = np.random.default_rng(0)
    for step in (1e-3, 0.1, 1.0):
        assert all(quality._loss(blocks, weights + step * draw.normal(size=len(weights)))[0] > loss - 1e-5 for _ in range(3))
