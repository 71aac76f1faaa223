import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import ann, topk


def _brute(rows, every, k, quantise):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v is not None and len(v)
            and all(x is not None and np.isfinite(x) for x in v) and (quantise or any(v))]
    if quantise:
        good = [(i, np.floor(256 * v)) for i, v in good]
    out = []
    for i, q in good:
        if i % every == 0:
            near = sorted((-float(q @ v), j) for j, v in good if j != i and len(v) == len(q))[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(near, 1)]
    return sorted(out)


def _odd(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=6))]) for i in range(120)]
    rows += [(200, None), (250, [1.0] * 5 + [None]), (300, [float("nan")] * 6), (350, [float("inf")] + [0.0] * 5),
             (400, [0.0] * 6), (450, []), (500, [1.0, 2.0]), (501, [0.5, -2.0]), (None, [1.0] * 6)]
    rows += [(i, rows[0][1]) for i in range(600, 640)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 AS rank", "2 AS score", "3 AS ids", "4 AS block", "5 AS vector")
    return rows, df


@pytest.mark.parametrize("block", [16, 8192])
def test_top_k_equals_brute_force(spark, block):
    rows, df = _odd(spark)
    got = sorted(tuple(r) for r in topk.search(df, block_rows=block).collect())
    assert got == _brute(rows, 50, 5, True)


def test_threshold_search_stops_early():
    x = np.zeros((1000, 3))
    x[:, 0] = np.arange(1000)
    rows, scores = topk.threshold_search(x, topk.sorted_lists(x), np.array([1.0, 0, 0]), 3)
    assert len(rows) == 16 and sorted(scores)[-3:] == [997, 998, 999]


def test_share_of_rows_met():
    """Where a few components carry the product the bound stops early; where all are alike it cannot."""
    rng = np.random.default_rng(2)
    alike = np.floor(256 * rng.normal(size=(4_000, 32)))
    uneven = np.floor(256 * rng.normal(size=(4_000, 32)) * 0.3 ** np.arange(32))
    shares = []
    for x in (uneven, alike):
        lists, met = topk.sorted_lists(x), 0
        for q in x[::200]:
            rows, scores = topk.threshold_search(x, lists, q, 6)
            assert sorted(scores)[-6:] == sorted(x @ q)[-6:] and len(set(rows.tolist())) == len(rows)
            met += len(rows)
        shares.append(met / (20 * len(x)))
    assert shares[0] < 0.5 and shares[1] <= 1


def test_nearest_rows_keep_ties():
    assert ann.nearest_rows(np.array([5, 1, 3, 3, 9]), 2).tolist() == [1, 2, 3]
    assert ann.nearest_rows(np.array([5, 1, 3]), 3).tolist() == [0, 1, 2]


def test_top_k_of_huge_components(spark):
    df = spark.createDataFrame([(0, [1e300, 1.0]), (50, [1e17, -3.0]), (1, [2.0, 4e18])], "vec_id long, embedding array<double>")
    assert topk.search(df).count() == 4


@pytest.mark.parametrize("block", [64, 8192])
def test_full_rerank_equals_brute_force(spark, block):
    rows, df = _odd(spark)
    got = sorted(tuple(r) for r in ann.search(df, every=20, k=20, share=1.0, block_rows=block).collect())
    want = _brute(rows, 20, 20, False)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12)


def test_recall_with_production_settings(spark):
    embeddings = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in embeddings.collect()]
    want = {(r[0], r[2]) for r in _brute(rows, 20, 20, False)}
    got = {(r.query_id, r.vec_id) for r in ann.search(embeddings).collect()}
    assert len(got & want) >= 0.9 * len(want)


def drawn(n, seed=1):
    """Distinct vectors from the mean and covariance of each label of the real ones."""
    real = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pandas().dropna()
    rng, out = np.random.default_rng(seed), []
    for _, same in real.groupby("label"):
        x = np.stack(same["embedding"])
        out.append(rng.multivariate_normal(x.mean(axis=0), np.cov(x.T), -(-n * len(x) // len(real))))
    x = np.concatenate(out)
    return np.float32(x[rng.permutation(len(x))[:n]])


@pytest.mark.parametrize("n", [8_192, 16_384])
def test_recall_where_the_share_decides(spark, n):
    x = drawn(n)
    n = len(x)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {(r.query_id, r.vec_id) for r in ann.search(df).collect()}
    x, asked = np.float64(x), np.arange(0, n, 20)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    near = np.argpartition(-scores, 19, axis=1)[:, :20]
    want = {(int(q), int(v)) for q, row in zip(asked, near) for v in row}
    assert len(got & want) >= 0.92 * len(want)


def test_footrule_counts_missing_pivots_at_the_end():
    orders = np.array([[0, 1], [1, 0], [2, 3], [0, 2]])
    files = {p: (r, s) for p, r, s in ann.inverted_files(orders, 4)}
    full = lambda a, b: sum(abs((list(a).index(p) if p in a else 2) - (list(b).index(p) if p in b else 2)) for p in range(4))
    for i, order in enumerate(orders):
        assert ann.footrule(order, files, 4, 2).tolist() == [full(order, o) for o in orders], i


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.search(none).count() == topk.search(none).count() == 0
    assert ann.search(none.select("vec_id", F.lit(None).cast("array<float>").alias("embedding"))).columns == ["query_id", "rank", "vec_id", "score"]
