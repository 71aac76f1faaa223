import hashlib
import re
import time
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpus_pipeline import repeated_passages
from ledgerlens.llm import suffixes

N = suffixes.LENGTH


def brute(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p:p + N] for _, t in texts for p in range(len(t) - N + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for p in range(len(t) - N + 1):
            if seen[t[p:p + N]] > 1:
                gone[p:p + N] = True
        gone = gone[:len(t)]
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def _got(df):
    return sorted((tuple(r) for r in suffixes.digest(df).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_documents_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert _got(docs) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_planted_passages(spark, monkeypatch):
    rng = np.random.default_rng(4)
    noise = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    passages = [noise(n) for n in (399, 400, 401, 430, 700, 1500)]
    rows = [(i, noise(int(rng.integers(0, 300))) + passages[i % 6] + noise(int(rng.integers(0, 300)))) for i in range(60)]
    rows += [(100, "é" * 500), (101, "a" * 1000), (102, noise(2000) * 2), (103, passages[1]), (103, passages[1]), (None, passages[4]),
             (104, None), (105, ""), (106, passages[5][100:499] + "!" + passages[5][300:701]), (107, "ab" * 300 + "ba" * 300)]
    # Halves of one passage joined with halves of another: matches on one side of an anchor only.
    rows += [(200 + i, passages[5][:200 + 20 * i] + passages[4][200:500 + 10 * i]) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS uid_", "2 AS place", "3 AS marks_")
    assert _got(df) == brute(rows)


def test_odd_documents(odd_docs, no_docs):
    assert _got(odd_docs) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert suffixes.digest(no_docs).count() == 0


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x & 3 for x in b)), max_size=8), max_size=6))
def test_loser_tree_merges_front_coded_runs(runs):
    coded = [suffixes.encode_run([(s, s[::-1], i, j) for j, s in enumerate(sorted(r))]) for i, r in enumerate(runs)]
    out = list(suffixes.merge_runs([suffixes.decode_run(c) for c in coded]))
    strings = [o[1] for o in out]
    assert strings == sorted(s for r in runs for s in r)
    assert all(o[2] == o[1][::-1] for o in out)
    for a, b in zip(out, out[1:]):
        assert b[0] == suffixes._common(a[1], b[1])


def test_pipeline_cuts_passages_of_over_50_words(spark):
    rng = np.random.default_rng(6)
    some = lambda n: " ".join("".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(1, 9))) for _ in range(n))
    passages = [some(n) for n in (49, 50, 51, 52, 62, 90)] + [" ".join("abcde"[x] for x in rng.integers(0, 5, 51)), some(30), some(30)]
    rows = [(i, f"{some(9)} {p} {some(7)}") for i, p in enumerate(passages * 2)]
    # Two short repeats side by side are no long one.
    rows += [(50, f"{some(3)} {passages[7]} {passages[8]}"), (51, passages[2] + "x " + some(5)), (None, passages[3]), (52, None)]
    texts = [(t or "").encode() for _, t in rows]
    spans = [[m.span() for m in re.finditer(rb"\S+", t)] for t in texts]
    windows = [[(w[j][0], w[j + 50][1]) for j in range(len(w) - 50)] for w in spans]
    seen = Counter(t[x:y] for t, w in zip(texts, windows) for x, y in w)
    want = {}
    for (i, _), t, w in zip(rows, texts, windows):
        gone = np.zeros(len(t), dtype=bool)
        for x, y in w:
            gone[x:y] |= seen[t[x:y]] > 1
        want[i] = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes().decode()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    assert {r.doc_id: r.text for r in repeated_passages(spark, df, "").collect()} == want
    assert all(len(want[i]) < len(t) - 100 for i, t in rows[2:7])


def test_anchors_do_not_depend_on_the_stretch(monkeypatch):
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, k, n).astype(np.uint8) for k, n in ((4, 5000), (1, 900), (256, 399), (2, 400), (256, 0), (256, 1700))]
    data, ends = np.concatenate(texts), np.cumsum([len(t) for t in texts])
    want = suffixes.anchors(data, ends, N)
    assert len(want[0]) > 20
    for stretch in (1, 7, 500, 3000):
        monkeypatch.setattr(suffixes, "STRETCH", stretch)
        at, prints = suffixes.anchors(data, ends, N)
        assert at.tolist() == want[0].tolist() and prints.tolist() == want[1].tolist()


def test_ranges_of_many_documents_are_joined_in_columns():
    """Half a million ranges take no more than their columns, and join as one by one."""
    import tracemalloc

    rng = np.random.default_rng(9)
    n = 500_000
    row, start = rng.integers(0, 5_000, n), rng.integers(0, 200_000, n).astype(np.int32)
    stop = start + rng.integers(1, 900, n).astype(np.int32)
    tracemalloc.start()
    got = suffixes.joined(row, start, stop, 5_001)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * n
    want = [[] for _ in range(5_001)]
    for r, x, y in sorted(zip(row.tolist(), start.tolist(), stop.tolist())):
        if want[r] and x <= want[r][-1]["stop"]:
            want[r][-1]["stop"] = max(want[r][-1]["stop"], y)
        else:
            want[r].append({"start": x, "stop": y})
    assert got.to_pylist() == want
    none = np.zeros(0, dtype=np.int32)
    assert suffixes.joined(none, none, none, 2).to_pylist() == [[], []]


def test_passages_that_occur_again_are_told_by_the_text_and_once(spark):
    """Passages of two words: across documents, inside one, overlapping, and in a row that occurs twice."""
    rows = [(1, "aa bb cc dd"), (2, "xx bb cc yy"), (3, "qq rr qq rr qq"), (4, "uu vv"), (4, "uu vv"), (None, "ww cc dd"), (5, "bbcc dd"), (6, "")]
    texts = [(i, t.encode()) for i, t in rows]
    df = spark.createDataFrame([(n, t, [(0, len(t))]) for n, (_, t) in enumerate(texts)], "_uid long, text binary, removed array<struct<start:int,stop:int>>")
    df = df.withColumn("_uid", F.when(F.col("_uid") == 4, 3).otherwise(F.col("_uid")))  # the row that occurs twice
    spans = {n: [m.span() for m in re.finditer(rb"\S+", t)] for n, (_, t) in enumerate(texts)}
    pairs = [(min(n, 3) if n == 4 else n, w[j][0], w[j + 1][1]) for n, w in spans.items() for j in range(len(w) - 1)]
    seen = Counter(texts[n][1][x:y] for n, x, y in pairs)
    want = sorted({p for p in pairs if seen[texts[p[0]][1][p[1]:p[2]]] > 1})
    for parts in (1, 7):
        got = sorted(tuple(r) for r in suffixes.find_passages(df, 2, parts).distinct().collect())
        assert got == want and len(want) == 9


def test_tables_between_leave_no_shuffle_files(spark, sf_dir):
    """Disk is held by the tables that are still read, not by what the writes before have shuffled."""
    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}

    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), shuffled()
    found = suffixes.repeated_words(docs, 51)
    for _ in range(40):
        if not (left := shuffled() - before):
            break
        time.sleep(0.25)
    assert not left
    assert found.count() == docs.count()
