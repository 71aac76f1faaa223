import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import periods, registry


def brute(words, least):
    """Every stretch whose smallest period reaches the length and that no neighbour extends."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = first - q, i - first + q
            if length < max(least, 3 * q):
                continue
            smaller = any(all(words[j] == words[j - d] for j in range(start + d, start + length)) for d in range(1, q))
            if not smaller:
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words, 24)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
    )


def numbers(words):
    return np.array(words, dtype=np.int64)


PIECES = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=6)


@settings(deadline=None, max_examples=300)
@given(PIECES, st.sampled_from([1, 2, 3, 5, 6, 9, 12, 24]))
def test_runs_equal_brute_force(pieces, least):
    words = [x for part, times in pieces for x in part * times]
    assert sorted(periods.online_runs(numbers(words), least), key=lambda r: (r[0], r[2])) == brute(words, least)


@settings(deadline=None, max_examples=60)
@given(st.integers(10, 90), st.integers(3, 5), st.integers(0, 40), st.randoms())
def test_long_periods(period, times, tail, random):
    part = [random.randrange(3) for _ in range(period)]
    words = [7, 8] + part * times + part[:tail] + [9]
    assert sorted(periods.online_runs(numbers(words)), key=lambda r: (r[0], r[2])) == brute(words, 24)


def test_runs_are_emitted_in_the_order_in_which_they_end():
    words = [0] * 30 + list(range(1, 50)) + [1, 2] * 20 + [5] * 24
    ends = [s + n for s, n, _ in periods.online_runs(numbers(words))]
    assert ends == sorted(ends) and len(ends) == 3


def test_one_word_a_million_times_is_not_quadratic():
    assert list(periods.online_runs(np.zeros(1_000_000, np.int64))) == [(0, 1_000_000, 1)]


@pytest.mark.parametrize("rows", [
    [(1, "a " * 23), (2, "a " * 24), (3, "a b " * 12), (4, "x " + "a b c " * 8 + "a y"), (5, "a b c d e f g h i " * 3)],
    [(10, " ".join(f"w{i}" for i in range(500))), (None, "a " * 40), (11, None), (12, ""), (13, " \t\n")],
    [(i, "one two three four five " * 40 + f"end{i}") for i in range(60)],
])
def test_query_equals_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, periods.digest(docs).collect()), key=str) == sorted((brute_row(*r) for r in rows), key=str)


def test_given_documents_equal_brute_force(spark, sf_dir):
    found = {r.doc_id: tuple(r) for r in registry.queries()["op11_periodic_runs"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(docs)
    short = [r for r in docs if len((r.text or "").split()) < 1500]
    assert len(short) > 150
    for r in short:
        assert found[r.doc_id] == brute_row(r.doc_id, r.text)


def test_odd_rows(odd_docs, no_docs):
    found = periods.digest(odd_docs).collect()
    short = [r for r in odd_docs.select("doc_id", "text").collect() if r.doc_id != 4]
    assert sorted((tuple(r) for r in found if r.doc_id != 4), key=str) == sorted(
        (brute_row(*r) for r in short), key=str)
    long = [r for r in found if r.doc_id == 4][0]
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 20000, 5)
    assert periods.digest(no_docs).collect() == []
    runs = periods.find_runs(odd_docs).filter("doc_id = 4").first()
    assert bytes(runs.collapsed) == b"lorem ipsum dolor sit amet,"
