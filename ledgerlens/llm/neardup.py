"""Near-duplicate documents: MinHash signatures, a multi-index Hamming join, exact confirmation.

A document's set of shingles gives ``SIZE`` hash minima, of which ``8`` bits each are kept. The
signature is split into ``CHUNKS`` chunks of ``WIDE`` minima. Two signatures that differ in at most
``DISTANCE = 2 * CHUNKS - 1`` minima have, by the pigeonhole principle, a chunk with at most one
difference; so each chunk is filed once for every place at which that one difference may be, with
the other ``WIDE - 1`` minima as key. All such pairs share a key. Beyond that distance a pair still
shares one unless every chunk differs twice: at a similarity of 0.75 that is 2 in 10^9.

Candidates never leave a key as all pairs. Every member of a key is first linked with one centre;
confirmed links are joined to components; only pairs of different components are looked at again,
until none is left that has not been compared on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow, batch, lower_words, mix64, slices, utf8
from ledgerlens.llm.components import components, extended
from ledgerlens.session import drop, settled

WORDS = 5
PERCENT = 75
CHUNKS, WIDE = 20, 5
SIZE = CHUNKS * WIDE
DISTANCE = 2 * CHUNKS - 1
# Signatures of a pair at the similarity differ in 25 of 100 minima on average, standard deviation
# 4.3; a candidate further apart than this cannot be a link but for 1 case in 10^6.
FAR = 48
# Four bits of 96 minima differ in no more places than the signatures: what is turned away here is too far.
SKETCHED, SKETCH_FAR = 96, FAR
ROUNDS = 2
# Documents of a home, and bytes of their sets, that are compared in one task with those of another block.
BLOCK, BLOCK_BYTES = 4_096, 8 << 20
SLICE_BYTES = 1 << 20
PART_KEYS = 1 << 20  # keys that one task sorts, on average

SIGNED = "doc_id long, n_shingles long, digest binary, signature binary"
FILED = "part int, keys binary, ids binary, groups binary, homes binary, blocks binary, sketches binary"
LEFT = "home long, x long, y long, a long, b long"
PAIRS = "a long, b long"

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _factors() -> tuple[np.ndarray, np.ndarray]:
    steps = np.arange(1, 2 * SIZE + 1, dtype=np.uint64)
    drawn = mix64(steps * _MULTIPLY)
    return drawn[:SIZE] | np.uint64(1), drawn[SIZE:]


_A, _B = _factors()


class Shingler:
    """Sets of shingles as sorted 64-bit hashes; remembers the hashes of a batch's words."""

    def __init__(self, words: int = WORDS):
        self.words = words

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        memory: dict[bytes, int] = {}
        out = []
        for text in texts:
            words = lower_words(text)
            for w in set(words).difference(memory):
                memory[w] = xxhash.xxh3_64_intdigest(w)
            h = np.fromiter(map(memory.__getitem__, words), dtype=np.uint64, count=len(words))
            if not len(h):
                out.append(h)
                continue
            n = min(self.words, len(h))
            # A sequence shorter than a shingle is one of its own kind: its length is part of it.
            acc = np.full(len(h) - n + 1, n, dtype=np.uint64)
            for i in range(n):
                acc = mix64(acc * _MULTIPLY + h[i:len(h) - n + 1 + i])
            out.append(np.unique(acc))
        return out


def signature(hashes: np.ndarray) -> bytes:
    least = np.full(SIZE, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 2048):
        least = np.minimum(least, (hashes[i:i + 2048, None] * _A + _B).min(axis=0))
    return (mix64(least) & np.uint64(0xFF)).astype(np.uint8).tobytes()


def sign(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, digest, signature``; the digest tells equal sets, null for empty ones."""
    schema = arrow(SIGNED)

    def run(batches):
        shingles = Shingler()
        for b in batches:
            for part in slices(b, "text", SLICE_BYTES):
                sets = shingles(part.column("text").to_pylist())
                yield batch(
                    schema, part.column("doc_id"), [len(s) for s in sets],
                    [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                    [signature(s) if len(s) else None for s in sets])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text")).mapInArrow(run, SIGNED)


def filed_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of every signature, one row each: chunk, place of the allowed difference, other minima."""
    chunks = signatures.reshape(len(signatures), CHUNKS, WIDE).astype(np.uint64)
    out = np.empty((len(signatures), CHUNKS, WIDE), dtype=np.uint64)
    for drop in range(WIDE):
        key = (np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDE) + np.uint64(drop))[None, :]
        for j in range(WIDE):
            if j != drop:
                key = (key << np.uint64(8)) | chunks[:, :, j]
        out[:, :, drop] = key
    return out.reshape(len(signatures), -1)


def star_pairs(keys, ids, groups, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Each member with the centre of its key, if that is in another group.

    In the first round (``salt`` 0) the centre is the member whose id hashes lowest, the same one for
    as many keys as possible. Later it is a member of the key's largest group, another one for each
    key and round, so that a document that is still apart meets many of the group.
    """
    order = np.lexsort((ids, keys))
    keys = keys[order]
    kept, run, ids, groups = _mixed_rows(keys, ids[order], groups[order])
    keys = keys[kept]
    if not len(ids):
        return ids, ids
    if salt:
        order = np.lexsort((groups, run))
        new = np.concatenate([[True], (run[order][1:] != run[order][:-1]) | (groups[order][1:] != groups[order][:-1])])
        members = np.empty(len(ids), dtype=np.int64)
        members[order] = np.diff(np.append(np.flatnonzero(new), len(ids)))[np.cumsum(new) - 1]
        rank = mix64(ids.astype(np.uint64) * _MULTIPLY ^ mix64(keys ^ np.uint64(salt << 48)))
        order = np.lexsort((rank, groups, -members, run))
    else:
        order = np.lexsort((mix64(ids.astype(np.uint64) * _MULTIPLY), run))
    first = order[np.concatenate([[True], run[order][1:] != run[order][:-1]])]
    centre, of = ids[first][run], groups[first][run]
    keep = of != groups
    return centre[keep], ids[keep]


def _mixed_rows(keys, ids, groups):
    """Of rows in the order of keys: those of keys with two groups or more, and the number of each one's key."""
    if not len(keys):
        return np.zeros(0, bool), np.zeros(0, np.int64), ids, groups
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    several = np.minimum.reduceat(groups, starts) != np.maximum.reduceat(groups, starts)
    sizes = np.diff(np.append(starts, len(keys)))
    keep = np.repeat(several, sizes)
    return keep, np.repeat(np.cumsum(several) - 1, sizes)[keep], ids[keep], groups[keep]


def sketch(signatures: np.ndarray) -> np.ndarray:
    """Four bits of 96 of the minima in six numbers: enough to turn most strangers away."""
    bits = (signatures[:, :SKETCHED] & 15).astype(np.uint64).reshape(len(signatures), SKETCHED // 16, 16)
    return (bits << np.arange(0, 64, 4, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)


def sketch_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x ^ y
    d = (d | d >> np.uint64(1) | d >> np.uint64(2) | d >> np.uint64(3)) & np.uint64(0x1111111111111111)
    return np.bitwise_count(d).sum(axis=-1)


def merged(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``root``, the least number that each one is joined with, after ``x`` and ``y`` are joined pairwise."""
    root = root.copy()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in zip(*(c.tolist() for c in _distinct(x, y))):
        a, b = sorted((find(a), find(b)))
        root[b] = a
    while (root[root] != root).any():
        root = root[root]
    return root


def crossing(keys, ids, groups, homes, blocks, sketches) -> tuple[np.ndarray, np.ndarray]:
    """What is left to compare of the pairs of one key in different groups, the largest group's own never.

    Members of one home are told as units ``(home, block, block)`` that are compared as a whole, so a
    large group of documents that stay apart gives a few blocks instead of all its pairs. Of members of
    different homes that are near only their homes are told, as bridges ``(home, home)``, each home once
    with the least of all those that it is joined with here: their units follow when they are one home.
    """
    order = np.lexsort((ids, keys))
    homes, blocks, sketches = homes[order], blocks[order], sketches[order]
    keep, run, ids, groups = _mixed_rows(keys[order], ids[order], groups[order])
    homes, blocks, sketches = homes[keep], blocks[keep], sketches[keep]
    units = []
    if not len(ids):
        return np.zeros((0, 3), np.int64), np.zeros((0, 2), np.int64)
    names, number = np.unique(homes, return_inverse=True)
    root = np.arange(len(names))
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    same = lambda x: np.minimum.reduceat(x, starts) == np.maximum.reduceat(x, starts)
    simple = same(homes) & same(blocks)
    units.append(np.stack([homes[starts], blocks[starts], blocks[starts]], axis=1)[simple])
    for s, stop in zip(starts[~simple].tolist(), np.append(starts[1:], len(run))[~simple].tolist()):
        g, h, b, n, marks = groups[s:stop], homes[s:stop], blocks[s:stop], number[s:stop], sketches[s:stop]
        _, where, count = np.unique(g, return_inverse=True, return_counts=True)
        minor = np.flatnonzero(where != int(np.argmax(count)))
        by_home = np.argsort(h)
        mixed = _mixed_rows(h[by_home], by_home, g[by_home])[0]
        for home in np.unique(h[by_home[mixed]]):
            x, y = np.unique(b[minor[h[minor] == home]]), np.unique(b[h == home])
            x, y = np.repeat(x, len(y)), np.tile(y, len(x))
            units.append(np.stack([np.full(len(x), home), np.minimum(x, y), np.maximum(x, y)], axis=1))
        for k in range(0, len(minor), 256):
            part, joint = minor[k:k + 256], root[n]
            left, right = np.nonzero((joint[part][:, None] != joint[None, :]) & (g[part][:, None] != g[None, :]))
            close = sketch_distance(marks[part[left]], marks[right]) <= SKETCH_FAR
            if close.any():
                root = merged(root, joint[part[left[close]]], joint[right[close]])
    joined = np.flatnonzero(root != np.arange(len(root)))
    return np.unique(np.concatenate(units), axis=0), np.stack([names[root[joined]], names[joined]], axis=1)


def _filed(signed: DataFrame, parts: int) -> DataFrame:
    """Keys of ``signed`` (``id, grp, signature``, maybe ``home, block``) as blobs for each of ``parts``."""
    schema = arrow(FILED)
    numbers = [c for c in ("id", "grp", "home", "block") if c in signed.columns]

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                some = b.slice(i, 2048)
                data = np.frombuffer(b"".join(some.column("signature").to_pylist()), dtype=np.uint8).reshape(-1, SIZE)
                keys = filed_keys(data).ravel()
                columns = [np.repeat(some.column(c).to_numpy(), CHUNKS * WIDE) for c in numbers]
                part = (mix64(keys) % np.uint64(parts)).astype(np.int64)
                order = np.lexsort((keys, part))
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                found = [(p, order[x:y]) for p, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
                blobs = [[c[o].tobytes() for _, o in found] for c in (keys, *columns)]
                if "home" in numbers:
                    marks = np.repeat(sketch(data), CHUNKS * WIDE, axis=0)
                    blobs.append([marks[o].tobytes() for _, o in found])
                blobs += [[b""] * len(found)] * (6 - len(blobs))
                yield batch(schema, [p for p, _ in found], *blobs)

    return signed.select(*numbers, "signature").mapInArrow(run, FILED)


def _read_filed(table: pa.Table):
    join = lambda c, t: np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=t)
    return join("keys", np.uint64), *(join(c, np.int64) for c in ("ids", "groups", "homes", "blocks")), join("sketches", np.uint64).reshape(-1, SKETCHED // 16)


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pairs[:, 0], pairs[:, 1]


def _parts(signed: DataFrame) -> int:
    """Number of parts that keys are dealt into: it follows the number of documents."""
    least = int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-signed.count() * CHUNKS * WIDE // PART_KEYS))


def candidates(signed: DataFrame, salt: int = 0) -> DataFrame:
    """Pairs ``a < b`` of different groups that share a key, one side being the key's centre."""
    parts = _parts(signed)
    schema = arrow(PAIRS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _read_filed(pa.Table.from_batches(list(batches)))
        yield batch(schema, *_distinct(*star_pairs(*columns[:3], salt)))

    return _filed(signed, parts).groupBy("part").applyInArrow(run, PAIRS).distinct()


def left_over(signed: DataFrame) -> DataFrame:
    """Units ``home, x, y`` that are still to be compared and bridges ``a, b`` between homes: see ``crossing``."""
    parts = _parts(signed)
    schema = arrow(LEFT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, bridges = crossing(*_read_filed(pa.Table.from_batches(list(batches))))
        none = lambda n: pa.nulls(n, pa.int64())
        yield batch(schema, units[:, 0], units[:, 1], units[:, 2], none(len(units)), none(len(units)))
        yield batch(schema, *[none(len(bridges))] * 3, bridges[:, 0], bridges[:, 1])

    return _filed(signed, parts).groupBy("part").applyInArrow(run, LEFT).distinct()


def links_of_units(units: DataFrame, placed: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``u, v`` between different groups of the two blocks of each unit, on full sets."""
    ddl = "u long, v long"
    schema = arrow(ddl)
    full = placed.select("id", "grp", "home", "block").join(sets, "id")

    def side(name: str, number: int) -> DataFrame:
        some = units if name == "x" else units.filter("x <> y")
        block = full.withColumnRenamed("home", "_home").withColumnRenamed("block", "_block")
        return some.join(block, (F.col("home") == F.col("_home")) & (F.col(name) == F.col("_block"))).select(
            "home", "x", "y", F.lit(number).alias("side"), "id", "grp", "hashes")

    def compare(table: pa.Table) -> pa.Table:
        side, ids, groups = (table.column(c).to_numpy() for c in ("side", "id", "grp"))
        found = links_of_rows(side, groups, [np.frombuffer(h.as_buffer(), dtype=np.uint64) for h in table.column("hashes")], percent)
        return pa.Table.from_batches([batch(schema, ids[found[:, 0]], ids[found[:, 1]])])

    return side("x", 0).unionByName(side("y", 1)).groupBy("home", "x", "y").applyInArrow(compare, ddl)


def links_of_rows(side: np.ndarray, groups: np.ndarray, hashes: list[np.ndarray], percent: int) -> np.ndarray:
    """Numbers ``i, j`` of rows of different groups that are linked: rows of side 0 with those of side 1, or
    all with all where there is one side.

    A row's common shingles with all rows of the other side are counted at once. Of its links with one
    group the first is told, since a group is connected already; rows of the largest group are told
    by those that they are linked with.
    """
    sizes = np.array([len(h) for h in hashes])
    _, codes = np.unique(np.concatenate(hashes), return_inverse=True)
    rows_of = np.split(codes, np.cumsum(sizes)[:-1])
    has = np.zeros(codes.max() + 1, dtype=bool)
    kinds, counts = np.unique(groups, return_counts=True)
    minor = np.flatnonzero(groups != kinds[np.argmax(counts)])
    found = [np.zeros((0, 2), dtype=np.int64)]
    for one in (0, 1):
        mine = minor[side[minor] == one]
        other = np.flatnonzero(side == 1 - one) if (side == 1).any() else np.arange(len(side))
        if not len(mine) or not len(other):
            continue
        theirs = np.concatenate([rows_of[j] for j in other])
        starts = np.concatenate([[0], np.cumsum(sizes[other])[:-1]])
        for i in mine:
            has[rows_of[i]] = True
            common = np.add.reduceat(has[theirs], starts, dtype=np.int64)
            has[rows_of[i]] = False
            near = (100 * common >= percent * (sizes[i] + sizes[other] - common)) & (groups[other] != groups[i])
            _, first = np.unique(groups[other[near]], return_index=True)
            found.append(np.stack([np.full(len(first), i), other[near][first]], axis=1))
    return np.concatenate(found)


def similar(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def near(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Adds ``distance`` of the signatures and drops pairs too far apart, or of too different ``size`` (if ``signed`` has
    it), to be a link."""
    sized = "size" in signed.columns
    side = lambda name: signed.select(
        F.col("id").alias(name), F.col("signature").alias(f"s{name}"), *[F.col("size").alias(f"n{name}")] * sized)

    @F.pandas_udf("int")
    def distance(x, y):
        import pandas as pd

        m = lambda s: np.frombuffer(b"".join(s), dtype=np.uint8).reshape(-1, SIZE)
        return pd.Series((m(x) != m(y)).sum(axis=1).astype(np.int32)) if len(x) else pd.Series([], dtype="int32")

    # Not deterministic in name only: the filter stays above, so a pair is looked at once.
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    if sized:
        both = both.filter(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
    return both.withColumn(
        "distance", distance.asNondeterministic()("sa", "sb")).filter(F.col("distance") <= FAR).select("a", "b", "distance")


def shingle_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, hashes`` of the named documents: the full sets, sorted."""
    ddl = "id long, hashes binary"
    schema = arrow(ddl)

    def run(batches):
        shingles = Shingler()
        for b in batches:
            for part in slices(b, "text", SLICE_BYTES):
                sets = shingles(part.column("text").to_pylist())
                yield batch(schema, part.column("id"), [s.tobytes() for s in sets])

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), utf8(F.col("text")).alias("text"))
    return texts.join(ids, "id", "left_semi").mapInArrow(run, ddl)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs ``u, v`` whose full sets reach the similarity."""
    schema = arrow("u long, v long")
    side = lambda name: sets.select(F.col("id").alias(name), F.col("hashes").alias(f"h{name}"))

    def run(batches):
        for b in batches:
            view = lambda h: np.frombuffer(h.as_buffer(), dtype=np.uint64)
            keep = [similar(view(x), view(y), percent) for x, y in zip(b.column("ha"), b.column("hb"))]
            keep = pa.array(keep, type=pa.bool_())
            yield batch(schema, b.column("a").filter(keep), b.column("b").filter(keep))

    joined = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")
    return joined.select("a", "b", "ha", "hb").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``doc_id, n_shingles, component_id, kept``.

    Words are lower-cased (A-Z only) runs without white space; a set holds the distinct shingles of
    five words, or the whole sequence where there are fewer. Documents are linked when their sets have
    100 * intersection >= 75 * union, and belong to the smallest ``doc_id`` reachable. Null or empty
    text has no shingle and is linked with nothing. Equal sets are joined before any comparison.
    Rows of the same id are the same document; their texts should agree, else the smaller digest
    stands for the id. A row without id is kept and has no component. An empty table gives no rows.
    """
    signed = settled(sign(docs), "neardup-signatures")
    known = signed.filter("doc_id IS NOT NULL AND digest IS NOT NULL")
    same = known.groupBy("n_shingles", "digest").agg(F.min("doc_id").alias("id"), F.min("signature").alias("signature"))
    # Several texts of one id: one of them stands for it.
    reps = settled(same.groupBy("id").agg(F.min(F.struct("digest", "signature", "n_shingles")).alias("x")).select(
        "id", F.col("x.signature").alias("signature"), F.col("x.n_shingles").alias("size")), "neardup-sets")

    stars = settled(candidates(reps.withColumn("grp", F.col("id"))), "neardup-stars")
    pairs = settled(near(stars, reps), "neardup-pairs")
    texts = docs.join(_members(stars).select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    sets = settled(shingle_sets(texts, reps), "neardup-shingles")

    # First the nearest centre of each document, then what that has left apart.
    order = Window.partitionBy("b").orderBy("distance", "a")
    first = pairs.withColumn("_n", F.row_number().over(order)).filter("_n = 1")
    found = components(confirmed(first, sets))
    found = extended(found, confirmed(_apart(pairs, found), sets))
    members = reps.join(_members(stars), "id", "left_semi")
    # Further rounds let what is still apart meet others; the last one compares whatever is left. A pair that
    # was a candidate before is linked or no link, so it is not looked at again.
    met, seen = [pairs.select("a", "b")], [stars]
    for salt in range(1, ROUNDS + 1):
        grouped = _grouped(members, found)
        fresh = candidates(grouped, salt=salt).join(reduce(DataFrame.union, seen), ["a", "b"], "left_anti")
        seen.append(settled(fresh, "neardup-candidates"))
        met.append(settled(near(seen[-1], reps).select("a", "b"), "neardup-round"))
        found = extended(found, confirmed(met[-1], sets))
        drop(grouped)
    # Documents whose signatures are near have one home, which is cut into blocks.
    grouped = _grouped(members, found)
    homes = components(reduce(DataFrame.union, met).select(F.col("a").alias("u"), F.col("b").alias("v")))
    placed = settled(_placed(grouped, homes, sets), "neardup-placed")
    drop(*seen, pairs, *met[1:], grouped)
    left = settled(left_over(placed), "neardup-left")
    units, bridges = left.filter("home IS NOT NULL").select("home", "x", "y"), left.filter("a IS NOT NULL").select("a", "b")
    moved, still_left = None, None
    if not bridges.isEmpty():
        # Homes with near documents become one, in which no key has near documents of different homes any more.
        homes = extended(homes, bridges.select(F.col("a").alias("u"), F.col("b").alias("v")))
        ends = _members(bridges).select(F.col("id").alias("home"))
        moved = settled(_placed(placed.join(ends, "home", "left_semi").select("id", "grp", "signature"), homes, sets), "neardup-moved")
        still_left = settled(left_over(moved), "neardup-moved-left")
        units = units.join(ends, "home", "left_anti")
    inside = links_of_units(units, placed, sets)
    if moved is not None:
        inside = inside.unionByName(links_of_units(still_left.filter("home IS NOT NULL").select("home", "x", "y"), moved, sets))
    labels = extended(found, inside)
    drop(sets, reps, homes, placed, left, *(t for t in (moved, still_left) if t is not None))

    # Copies lead to their representative, which leads to its component.
    named = same.select(F.col("n_shingles").alias("_n"), F.col("digest").alias("_d"), F.col("id").alias("_rep"))
    out = signed.join(named, (F.col("n_shingles") == F.col("_n")) & (F.col("digest") == F.col("_d")), "left").join(
        labels, F.col("_rep") == F.col("id"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "_rep", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _grouped(members: DataFrame, labels: DataFrame) -> DataFrame:
    grouped = members.join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("grp"), "signature")
    return settled(grouped, "neardup-groups")


def _placed(grouped: DataFrame, homes: DataFrame, sets: DataFrame) -> DataFrame:
    """``grouped`` with ``home`` and ``block``; a document that is near no other is its own home."""
    sizes = homes.join(sets.select("id", F.octet_length("hashes").alias("bytes")), "id").groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).alias("blocks"))
    places = homes.join(sizes, "component").select("id", F.col("component").alias("home"), F.pmod(F.xxhash64("id"), "blocks").alias("block"))
    return grouped.join(places, "id", "left").select(
        "id", "grp", "signature", F.coalesce("home", "id").alias("home"), F.coalesce("block", F.lit(0)).cast("long").alias("block"))


def _members(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose two sides are in different components as yet."""
    side = lambda name: labels.select(F.col("id").alias(name), F.col("component").alias(f"c{name}"))
    return pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").filter(
        F.coalesce("ca", "a") != F.coalesce("cb", "b"))
