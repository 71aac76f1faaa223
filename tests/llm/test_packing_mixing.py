import itertools
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.llm import mixing, packing
from ledgerlens.llm.common import n_words


def _padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= size) - size) for size, n in histogram.items())


@settings(deadline=None, max_examples=80)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 4))
def test_boundaries_are_optimal(histogram, buckets):
    bounds = packing.optimal_boundaries(histogram, buckets)
    top, rest = max(histogram), sorted(set(histogram) - {max(histogram)})
    best = min(_padding(histogram, [*c, top]) for k in range(buckets) for c in itertools.combinations(rest, min(k, len(rest))))
    assert len(bounds) <= buckets and _padding(histogram, bounds) == best


def test_pack_covers_every_token_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("n", n_words(F.col("text")))
    rows = packing.pack(docs, "n", max_len=100, buckets=4, token_budget=600).collect()
    by_doc, batches = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, r.n_tokens))
        if r.bucket_len is not None:
            batches[r.bucket_len, r.batch].append(r.slot)
            assert r.n_tokens <= r.bucket_len and r.padding == r.bucket_len - r.n_tokens
    for d in docs.collect():
        assert sum(n for _, n in by_doc[d.doc_id]) == d.n
        assert [s for s, _ in sorted(by_doc[d.doc_id])] == list(range(0, max(d.n, 1), 100))
    assert len({b for b, _ in batches}) <= 4
    last = {b: max(k for c, k in batches if c == b) for b, _ in batches}
    for (b, k), slots in batches.items():
        full = 600 // b
        assert sorted(slots) == list(range(len(slots))) and (len(slots) == full or k == last[b] and len(slots) < full)


def test_pack_does_not_depend_on_the_cluster(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("n", n_words(F.col("text")))
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in ("8", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append(sorted(map(tuple, packing.pack(docs, "n").collect()), key=str))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_pack_odd(odd_docs, no_docs):
    rows = packing.pack(odd_docs.withColumn("n", n_words(F.col("text"))), "n", max_len=16).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3, 4, 5, 6, 7, 8, None}
    assert all(r.bucket_len is None and r.batch is None for r in rows if r.doc_id in (2, 3, 5))
    assert packing.pack(no_docs, "n").count() == 0


def _targets(sizes, cycle, share, most):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    open_, target, total = set(names), {}, share * sum(sizes.values())
    while open_:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if total * weight[s] / w > most * sizes[s]}
        if not over:
            target.update({s: total * weight[s] / w for s in open_})
            break
        for s in over:
            target[s] = most * sizes[s]
            total -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("share", [1.0, 0.3, 2.5, 9.0])
def test_mix_meets_targets(spark, sf_dir, share):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix(docs, share=share).collect()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.size == 0 or r.taken % r.size == 0 and r.taken <= 3 * r.size
        assert r.taken in (r.size * r.epochs, r.size * (r.epochs + 1))
    want = _targets(sizes, (5, 2, 1), share, 3)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    assert {r.source: pytest.approx(r.target) for r in rows} == want
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs.orderBy(F.desc("doc_id")), share=share).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_mix_prefers_good_documents(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"))
    labels = spark.range(4000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    chosen = mixing.mix(mixing.with_quality(docs, labels), share=0.4).filter("taken > 0").groupBy(F.col("doc_id") % 2).count().collect()
    assert dict(chosen)[1] > 2 * dict(chosen)[0]


def test_mix_odd(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.taken == 0 for r in rows if r.size == 0)
    assert {r.source for r in rows} == {"s1", "s2", "s3", None}
    assert mixing.mix(no_docs).count() == 0
