import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import ngrams
from ledgerlens.llm.registry import op4_ngram_trie


@settings(deadline=None, max_examples=80)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2**45)), max_size=300))
def test_elias_fano(values):
    values = sorted(values)
    ef, _ = ngrams.EliasFano.from_buffer(ngrams.EliasFano.encode(np.array(values, dtype=np.uint64)).to_bytes(), 0)
    assert ef.get(np.arange(len(values))).tolist() == values
    asked = np.array([*values, *(v + 1 for v in values), 0, 7, 2**46], dtype=np.uint64)
    assert ef.find(asked).tolist() == [values.index(v) if v in values else -1 for v in asked.tolist()]


def test_level_keeps_the_successors_of_each_context():
    context, word = np.array([0, 0, 2, 2, 2]), np.array([3, 9, 0, 4, 9])
    data = ngrams.Level.encode(context, word, 4, 10, np.log10([.1, .2, .3, .4, .5]), *ngrams.quantise(np.zeros(4)))
    level = ngrams.Level(ngrams.Reader(data))
    assert [level.successors(c).tolist() for c in range(4)] == [[3, 9], [], [0, 4, 9], []]
    assert level.find(np.array([0, 1, 2, 2, 3]), np.array([9, 9, 4, 5, 0])).tolist() == [1, -1, 3, -1, -1]
    assert level.log(np.array([3])) == np.log10(.4)


def brute(rows, order=3, least=2, d=0.75):
    """The same model from plain dictionaries, without quantisation."""
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in rows}
    train = [tokens[i] for i, _ in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    grams = [Counter() for _ in range(order + 1)]
    for t in train:
        padded = [None, *t]
        for p in range(1, len(padded)):
            for n in range(1, order + 1):
                if p - n + 1 >= 0:
                    grams[n][tuple(padded[p - n + 1:p + 1])] += 1
    total, kinds = sum(grams[1].values()), len(grams[1])
    kept = [None, grams[1], *({g: n for g, n in grams[k].items() if n >= least} for k in range(2, order + 1))]
    after = {}
    for k in range(2, order + 1):
        for g, n in kept[k].items():
            after.setdefault(g[:-1], {})[g[-1]] = n

    def p(context, w):
        if not context:
            return (grams[1][(w,)] + 1) / (total + kinds + 1)
        lower = p(context[1:], w)
        if context not in (kept[len(context)]):
            return lower
        whole = kept[len(context)][context]
        follow = after.get(context, {})
        left = 1 - sum(n - d for n in follow.values()) / whole
        return (follow[w] - d) / whole + left * lower if w in follow else left * lower

    out = {}
    for i, t in tokens.items():
        padded = [None, *t]
        base = sum(np.log10(p((), w)) for w in t)
        full = sum(np.log10(p(tuple(padded[max(0, j - order + 1):j]), padded[j])) for j in range(1, len(padded)))
        out[i] = (len(t), sum(grams[1][(w,)] > 0 for w in t), total, base, full)
    return out


def test_scores_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    got = {r.doc_id: r for r in ngrams.learn_and_score(docs).collect()}
    assert set(got) == set(want)
    for i, (n, known, total, base, full) in want.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(full, abs=0.02 * n)  # 8-bit codes
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


def test_odd_documents(spark, odd_docs, no_docs):
    got = ngrams.learn_and_score(odd_docs).collect()
    want = brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert len(got) == odd_docs.count()
    for r in got:
        if r.doc_id != 6:
            assert r.n_tokens == want[r.doc_id][0]
    assert ngrams.learn_and_score(no_docs).count() == 0
    unseen = spark.createDataFrame([(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2), "a b")], "doc_id long, text string")
    r = ngrams.learn_and_score(unseen).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_query_keeps_all_ngrams(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(ngrams, "SHARD_BYTES", 40_000)  # more shards than partitions
    monkeypatch.setattr(ngrams, "CHUNK", 1_000)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want, pruned = brute(rows, least=1), brute(rows)
    got = {r.doc_id: r for r in op4_ngram_trie(spark, sf_dir).collect()}
    assert set(got) == set(want)
    for i, (n, known, total, base, full) in want.items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (n, known, total)
        assert got[i].score == pytest.approx(full, abs=0.02 * n)
    assert any(got[i].score > pruned[i][4] + 0.5 * got[i].n_tokens for i in want if got[i].held_out)


@settings(deadline=None, max_examples=60)
@given(st.dictionaries(st.integers(0, 2**64 - 1), st.integers(1, 2**40), max_size=50))
def test_blobs(counts):
    keys = np.array(sorted(counts), dtype=np.uint64)
    sums = np.array([counts[k] for k in sorted(counts)], dtype=np.int64)
    data = ngrams._differences(keys) if len(keys) else b""
    assert ngrams._from_differences(data).tolist() == keys.tolist()
    assert ngrams._wide(ngrams._narrow(sums), len(keys)).tolist() == sums.tolist()


def test_a_search_in_a_sequence_is_a_few_steps(monkeypatch):
    """An upper part keeps one or two values, whatever the width of the low part."""
    rng = np.random.default_rng(5)
    values = np.unique(rng.integers(0, 2**17 * 50_000, 50_000).astype(np.uint64))
    ef, _ = ngrams.EliasFano.from_buffer(ngrams.EliasFano.encode(values).to_bytes(), 0)
    looked, lows = [], ngrams.EliasFano._lows
    monkeypatch.setattr(ngrams.EliasFano, "_lows", lambda self, index: looked.append(len(index)) or lows(self, index))
    assert ef.find(values).tolist() == list(range(len(values)))
    assert sum(looked) < 4 * len(values)


def test_hashes_of_long_and_short_words_agree():
    words = [b"a", b"Zebra", b"x" * ngrams.PLACES, b"y" * (ngrams.PLACES + 1), bytes(range(128, 256))]
    together = ngrams.hash_words([b" ".join(words)])[0]
    assert together.tolist() == [ngrams.hash_words([w])[0][0] for w in words] + [1]
