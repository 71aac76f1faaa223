from collections import Counter

import pytest

import corpus_pipeline
from ledgerlens.llm import mixing, neardup

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect())


@pytest.fixture()
def labelled_dir(spark, tmp_path):
    spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_mixing_takes_every_row_by_itself(spark, labelled_dir):
    """Null ids and repeated ids or rows: each row comes as often as the operator takes it."""
    draw = [(None if i % 4 == 0 else i % 9, "w " * (1 + i * 7 % 13), "en", "ab"[i % 2] if i % 5 else None) for i in range(60)]
    draw += [draw[0]] * 5 + [(70, None, None, "a"), (71, "", "en", "b")]
    rows = [(*r, len(r[1] or "")) for r in draw]
    docs = spark.createDataFrame(rows, DDL)
    got = rows_of(corpus_pipeline.mix_sources(spark, docs, labelled_dir))
    labels = spark.read.parquet(f"{labelled_dir}/labels.parquet")
    mixed = mixing.mix(mixing.with_quality(docs, labels)).collect()
    words = Counter()
    for (_, text, _, source, _), n in got.items():
        words[source] += n * len(text.split())
    want = Counter()
    for r in mixed:
        want[r.source] += r.taken
    assert words == +want
    times = Counter()
    for r in mixed:
        if r.taken:
            times[r.doc_id, r.source, r.size] += r.taken // r.size
    found = Counter()
    for (doc_id, text, _, source, _), n in got.items():
        found[doc_id, source, len(text.split())] += n
    assert found == times
    assert set(got) <= set(rows)


def test_two_null_ids_are_not_mixed_up(spark, labelled_dir):
    rows = [(None, "a " * 10, "en", "big", 20), (None, "b " * 3, "en", "small", 6), (None, "c " * 40, "en", "none", 80)]
    docs = spark.createDataFrame(rows, DDL)
    got = rows_of(corpus_pipeline.mix_sources(spark, docs, labelled_dir))
    mixed = {r.source: r.taken // r.size for r in mixing.mix(docs).collect()}
    assert {r[3]: n for r, n in got.items()} == {s: n for s, n in mixed.items() if n}
    assert len(set(mixed.values())) > 1


def test_stages_keep_columns_and_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, empty, sf_dir)
        assert kept.columns == docs.columns and kept.count() == 0, name
    assert corpus_pipeline.pack(spark, empty, sf_dir).count() == 0


def test_run_ends_in_the_sequences_of_what_the_stages_keep(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir), f"test-{name}")
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids and left, name
        ids = left
    want = Counter((r.doc_id, len((r.text or "").encode().split())) for r in docs.select("doc_id", "text").collect())
    got: Counter = Counter()
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        got[r.doc_id] += r.n_tokens
    total: Counter = Counter()
    for (doc_id, n), times in want.items():
        total[doc_id] += n * times
    assert +got == +total


def test_texts_and_pairs_are_looked_at_once(spark, sf_dir):
    """A filter on what Python returns must not make Spark run the Python code twice."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert plan(corpus_pipeline.language_id(spark, docs, sf_dir)).count("ArrowEvalPython") == 1
    signed = spark.createDataFrame([(1, b"a" * 100), (2, b"a" * 90 + b"b" * 10)], "id long, signature binary")
    pairs = neardup.near(spark.createDataFrame([(1, 2)], "a long, b long"), signed)
    assert plan(pairs).count("ArrowEvalPython") == 1
    assert [tuple(r) for r in pairs.collect()] == [(1, 2, 10)]
