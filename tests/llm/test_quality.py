import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import quality, registry


def brute_features(text):
    def kind(byte):
        c = chr(byte)
        if c in "\t\v\f\r ":
            return "blank"
        if c == "\n":
            return "line"
        if byte >= 128:
            return "other"
        if byte < 33 or byte == 127:
            return "control"
        return "digit" if c.isdigit() else "low" if c.islower() else "up" if c.isupper() else c

    row = {}
    kinds = [kind(b) for b in b"\n" + text + b"\n"]
    for pair in zip(kinds, kinds[1:]):
        row[pair] = row.get(pair, 0) + 1
    return sorted(np.sqrt(n / (len(kinds) - 1)) for n in row.values())


@settings(deadline=None, max_examples=100)
@given(st.binary(max_size=60), st.integers(1, 20))
def test_features_cover_the_whole_text_whatever_the_slices(text, step):
    whole = quality.features(text)
    assert np.allclose(sorted(x for x in whole[:-8] if x), brute_features(text))
    kept, quality.SLICE_BYTES = quality.SLICE_BYTES, step
    try:
        assert np.allclose(quality.features(text), whole)
    finally:
        quality.SLICE_BYTES = kept


def test_pairs_are_ranked_as_by_plain_descent():
    draw = np.random.default_rng(1)
    good, bad = draw.normal(0.6, 1, (40, 3)), draw.normal(0, 1, (30, 3))
    found = quality.fit_pairs(good, bad, pairs=2000, rounds=500)
    i, j = (lambda d: (d.integers(40, size=2000), d.integers(30, size=2000)))(np.random.default_rng(quality.SEED))
    slow = np.zeros(3)
    gaps = good[i] - bad[j]
    for _ in range(20_000):
        slow += 0.05 * ((gaps / (1 + np.exp(gaps @ slow))[:, None]).mean(axis=0) - quality.RIDGE * slow)
    assert np.allclose(found, slow, atol=1e-3)


def test_threshold_is_the_quantile():
    assert quality.quantile(np.array([3.0, 1.0, 2.0, 4.0]), np.ones(4), 0.5) == 2.5
    assert quality.quantile(np.array([3.0, 1.0, 2.0]), np.array([1.0, 6.0, 1.0]), 0.75) == 1.5
    ranking = quality.Ranking(np.ones(1), 7.0)
    assert np.isclose(ranking.score(np.array([7.0]))[0], quality.CUT)
    assert (np.diff(ranking.score(np.array([-1e9, 0.0, 8.0, 1e9]))) > 0).all()


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = registry.queries()["op13_quality"](spark, sf_dir)
    rows = found.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out AND quality IS NOT NULL").collect()
    good = [r.predicted for r in rows if r.quality == 1]
    bad = [r.predicted for r in rows if r.quality == 0]
    assert len(good) > 20 and np.mean(good) >= 0.95
    assert len(bad) > 3 and np.mean(bad) <= 0.2


def test_all_documents_are_scored_by_their_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r.doc_id: r for r in registry.queries()["op13_quality"](spark, sf_dir).collect()}
    texts = docs.select("doc_id", "text").collect()
    assert len(found) == len(texts)
    by_text = {}
    for r in texts:
        row = found[r.doc_id]
        assert row.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
        assert by_text.setdefault(r.text or "", row.score) == row.score


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (3, 0), (4, 1), (4, 0), (5, None), (6, 1), (7, 1), (None, 1), (8, 5), (99, 0)], "doc_id long, quality int")
    found = quality.classify(odd_docs, labels).collect()
    assert len(found) == odd_docs.count() and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (2, 3)}) == 1
    assert [(r.doc_id, r.quality) for r in quality.labelled(labels).orderBy("doc_id").collect()] == [
        (1, 1), (2, 0), (3, 0), (4, 1), (6, 1), (7, 1), (99, 0)]
    assert quality.classify(no_docs, labels).collect() == []
    # One class or none: nothing is preferred, and nothing is thrown out.
    for few in (labels.limit(0), labels.filter("quality = 1")):
        assert {r.predicted for r in quality.classify(odd_docs, few).collect()} == {1}
    clash = quality.rank(odd_docs.selectExpr("*", "'s' AS score", "1 AS strength"), quality.Ranking(np.zeros(quality.N_FEATURES), 0.0))
    assert clash.count() == odd_docs.count() and set(odd_docs.columns) < set(clash.columns)
