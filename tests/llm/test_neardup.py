import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.llm import neardup
from ledgerlens.llm.components import components, extended


def _set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = {i: _set(t) for i, t in rows}
    posting, common = {}, {}
    for i, s in sets.items():
        for x in s:
            posting.setdefault(x, []).append(i)
    for ids in posting.values():
        for a in ids:
            for b in ids:
                if a < b:
                    common[a, b] = common.get((a, b), 0) + 1
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())


def test_documents_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sorted(tuple(r) for r in neardup.near_duplicates(docs).collect())
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("block", [16, neardup.BLOCK])
def test_chains_and_groups_without_a_common_centre(spark, monkeypatch, block):
    """A long chain whose neighbours alone are linked, and a large group of copies with changed words."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng, rows = np.random.default_rng(1), []
    words = [f"w{i}" for i in range(400)]
    rows += [(i, " ".join(words[6 * i:6 * i + 60])) for i in range(50)]
    base = [f"v{i}" for i in range(120)]
    for i in range(300):
        own = list(base)
        for j in rng.integers(0, 120, rng.integers(0, 5)):
            own[j] = f"x{rng.integers(0, 10 ** 6)}"
        rows.append((1000 + i, " ".join(own)))
    got = sorted(tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows)


def test_odd_documents(odd_docs, no_docs):
    got = {r.doc_id: tuple(r)[1:] for r in neardup.near_duplicates(odd_docs).collect()}
    assert got[2] == (0, 2, True) and got[3] == (0, 3, True) and got[5] == (0, 5, True)
    assert got[1] == (1, 1, True) and got[6] == (1, 1, False)
    assert got[None] == (2, None, True) and got[4] == (5, 4, True)
    assert neardup.near_duplicates(odd_docs).count() == odd_docs.count()
    assert neardup.near_duplicates(no_docs).count() == 0


@settings(deadline=None, max_examples=30)
@given(st.integers(0, neardup.DISTANCE), st.integers(0, 10 ** 6))
def test_all_pairs_under_the_distance_share_a_key(errors, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 256, neardup.SIZE).astype(np.uint8)
    y = x.copy()
    at = rng.choice(neardup.SIZE, errors, replace=False)
    y[at] ^= rng.integers(1, 256, errors).astype(np.uint8)
    keys = neardup.filed_keys(np.stack([x, y]))
    assert set(keys[0]) & set(keys[1])


@settings(deadline=None, max_examples=30)
@given(st.integers(0, neardup.DISTANCE), st.integers(0, 10 ** 6))
def test_no_pair_under_the_distance_is_turned_away_by_its_sketch(errors, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 256, neardup.SIZE).astype(np.uint8)
    y = x.copy()
    y[:errors] ^= rng.integers(1, 256, errors).astype(np.uint8)
    marks = neardup.sketch(np.stack([x, y]))
    assert neardup.sketch_distance(marks[0], marks[1]) <= neardup.SKETCH_FAR


@settings(deadline=None, max_examples=50)
@given(st.integers(0, 10 ** 6), st.booleans())
def test_links_of_rows_equal_brute_force(seed, two):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 30))
    sets = [np.unique(rng.integers(0, 12, rng.integers(1, 12)).astype(np.uint64)) for _ in range(n)]
    side, groups = rng.integers(0, 2, n) if two else np.zeros(n, int), rng.integers(0, 4, n)
    if two:
        side[0] = 0
    pairs = {(i, j) for i in range(n) for j in range(n) if groups[i] != groups[j]
             and (side[i] != side[j] or not (side == 1).any()) and neardup.similar(sets[i], sets[j])}
    got = {(int(i), int(j)) for i, j in neardup.links_of_rows(side, groups, sets, 75)}
    assert got <= pairs
    assert {frozenset((groups[i], groups[j])) for i, j in got} == {frozenset((groups[i], groups[j])) for i, j in pairs}


@settings(deadline=None, max_examples=5)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=30))
def test_components(spark, edges):
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {i: i for e in edges for i in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {i: c for i, c in label.items() if any(i in e and e[0] != e[1] for e in edges)}


@settings(deadline=None, max_examples=8, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40), st.integers(0, 40))
def test_components_and_later_edges_equal_union_find(spark, edges, cut):
    def smallest(pairs):
        of = {x: x for p in pairs for x in p if p[0] != p[1]}
        for _ in of:
            for u, v in pairs:
                if u != v:
                    of[u] = of[v] = min(of[u], of[v])
        return of

    table = lambda rows: spark.createDataFrame(rows, "u long, v long")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    early = components(table(edges[:cut]))
    assert rows(early) == sorted(smallest(edges[:cut]).items())
    assert rows(extended(early, table(edges[cut:]))) == sorted(smallest(edges).items())


def test_a_chain_takes_few_rounds(spark):
    chain = spark.range(300).selectExpr("id * 7919 % 301 AS u", "(id + 1) * 7919 % 301 AS v")
    assert {r.component for r in components(chain).collect()} == {0}


def test_homes_that_are_near_are_told_by_bridges_not_by_pairs():
    """200 near documents, each its own home and group, under 30 keys: pairs would be 19,900."""
    n, keys = 200, 30
    ids = np.tile(np.arange(n), keys)
    marks = np.zeros((len(ids), neardup.SKETCHED // 16), dtype=np.uint64)
    far = ids >= n - 10  # these are near each other, not the rest
    marks[far] = np.iinfo(np.uint64).max
    key = np.repeat(np.arange(keys), n).astype(np.uint64)
    units, bridges = neardup.crossing(key, ids, ids, ids, np.zeros(len(ids), np.int64), marks)
    assert not len(units)
    assert sorted(map(tuple, bridges.tolist())) == [(0, i) for i in range(1, n - 10)] + [(n - 10, i) for i in range(n - 9, n)]
    one = np.zeros(len(ids), np.int64)
    units, bridges = neardup.crossing(key, ids, ids, one, one, marks)
    assert units.tolist() == [[0, 0, 0]] and not len(bridges)


def test_links_between_homes_equal_brute_force(spark, monkeypatch):
    """Without the rounds, what the first centres leave apart is found by what is left to compare alone."""
    monkeypatch.setattr(neardup, "ROUNDS", 0)
    rng, rows = np.random.default_rng(3), []
    base = [f"v{i}" for i in range(120)]
    for i in range(150):
        own = list(base)
        for j in rng.integers(0, 120, rng.integers(2, 9)):
            own[j] = f"x{rng.integers(0, 3)}"
        rows.append((i, " ".join(own)))
    bridged = []
    left_over = neardup.left_over
    monkeypatch.setattr(neardup, "left_over", lambda placed: bridged.append(left_over(placed)) or bridged[-1])
    # Only pairs of the nearest signatures give homes: the others have to be bridged.
    near = neardup.near
    monkeypatch.setattr(neardup, "near", lambda pairs, signed: near(pairs, signed).filter("distance <= 15"))
    got = sorted(tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows)
    assert len(bridged) == 2


def test_pairs_whose_sizes_rule_a_link_out_go_before_their_signatures_are_compared(spark):
    signed = spark.createDataFrame([(i, bytes(neardup.SIZE), n) for i, n in ((1, 75), (2, 100), (3, 74))], "id long, signature binary, size long")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long")
    got = neardup.near(pairs, signed)
    assert sorted(map(tuple, got.collect())) == [(1, 2, 0), (1, 3, 0)]
    assert got.count() == 2
