"""Quality of documents by Bradley-Terry pairwise ranking.

A document's strength is a weighted sum of features of its text. In a preference pair a document marked
good is preferred to one marked bad with probability ``1 / (1 + exp(bad - good))``; the weights minimise
the logistic loss over the differences of the pairs' features. The threshold is a quantile of the
strengths of the labelled documents: as many lie below it as are marked bad. The score is the logistic
function of the distance to it, shifted so that the threshold scores ``CUT``.

Features, all taken over the whole text: square roots of the frequencies of pairs of neighbouring
characters' kinds (letters, digits, blanks, line ends, each ASCII mark by itself, bytes of other
letters), and how the words and lines repeat. No feature names a word or a language.

All labelled documents are learned from. They meet in hashed blocks, in each of which every good one is
compared with every bad one, so the pairs grow with the documents and not with their square. One job a
step adds up the slopes of all blocks; the driver holds sums alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow, utf8
from ledgerlens.session import drop, materialise

CUT = 0.3
# Documents of the larger class in a block, and those of the smaller one that it has at least on average:
# where they are rarer, each goes to several blocks.
BLOCK_DOCS = 32
BLOCK_RARE = 8
# Pairs of ``fit_pairs``, and steps of ``fit_blocks`` with the earlier ones that bend each of them.
PAIRS = 30_000
STEPS = 60
HISTORY = 10
# Parts that one look at the strengths cuts their range into.
PARTS = 4_096
RIDGE = 1e-4
ROUNDS = 300
SLICE_BYTES = 1 << 20
SEED = 13


def _kinds() -> np.ndarray:
    """The kind of every byte."""
    kind = np.full(256, 5)  # bytes of letters beyond ASCII
    kind[:33] = 6  # other control characters
    kind[[9, 11, 12, 13, 32]] = 0
    kind[10] = 1
    kind[48:58], kind[97:123], kind[65:91] = 2, 3, 4
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    kind[marks] = 7 + np.arange(len(marks))
    kind[127] = 6
    return kind


_KIND = _kinds()
KINDS = int(_KIND.max()) + 1
N_FEATURES = KINDS * KINDS + 8


def _repeats(text: bytes) -> list[float]:
    words = text.split()
    n = max(len(words), 1)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        float(bool(words)), np.log1p(len(words)) / 10, np.log1p(len(counts)) / 10, len(text) / n / 10, len(counts) / n,
        len(set(zip(words, words[1:]))) / max(n - 1, 1), max(counts.values(), default=0) / n,
        len(set(lines)) / max(len(lines), 1),
    ]


def features(text: bytes) -> np.ndarray:
    """Features of a whole text; an empty one has only its line end."""
    pairs = np.zeros(KINDS * KINDS)
    for at in range(0, len(text) + 1, SLICE_BYTES):
        # A line end before and behind the text; pieces overlap by the byte that both pairs share.
        piece = (b"\n" if at == 0 else text[at - 1:at]) + text[at:at + SLICE_BYTES]
        if at + SLICE_BYTES > len(text):
            piece += b"\n"
        kind = _KIND[np.frombuffer(piece, np.uint8)]
        pairs += np.bincount(kind[:-1] * KINDS + kind[1:], minlength=KINDS * KINDS)
    return np.concatenate([np.sqrt(pairs / pairs.sum()), _repeats(text)])


@dataclass(frozen=True)
class Ranking:
    weights: np.ndarray
    threshold: float

    def strength(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.weights

    def score(self, strength: np.ndarray) -> np.ndarray:
        shift = np.log(CUT / (1 - CUT)) - self.threshold
        return 1 / (1 + np.exp(-np.clip(strength + shift, -500, 500)))


def fit_pairs(good: np.ndarray, bad: np.ndarray, seed: int = SEED, pairs: int = PAIRS, rounds: int = ROUNDS) -> np.ndarray:
    """Weights that minimise the mean logistic loss of drawn pairs and a small ridge, by accelerated descent:
    what ``fit_blocks`` does, for rows in memory."""
    weights = np.zeros(good.shape[1])
    if not len(good) or not len(bad):
        return weights
    draw = np.random.default_rng(seed)
    i, j = draw.integers(len(good), size=pairs), draw.integers(len(bad), size=pairs)

    def back(pull: np.ndarray) -> np.ndarray:
        return (np.bincount(i, pull, len(good)) @ good - np.bincount(j, pull, len(bad)) @ bad) / pairs

    # The steepest curvature of the loss, by power iteration.
    way, steep = np.ones_like(weights), 0.0
    for _ in range(30):
        way = way / max(np.linalg.norm(way), 1e-300)
        way = back((good @ way)[i] - (bad @ way)[j])
        steep = float(np.linalg.norm(way))
    step = 1 / (0.3 * steep + RIDGE)
    ahead = weights.copy()
    for k in range(rounds):
        margin = (good @ ahead)[i] - (bad @ ahead)[j]
        pull = 1 / (1 + np.exp(np.clip(margin, -500, 500)))
        after = ahead + step * (back(pull) - RIDGE * ahead)
        ahead = after + k / (k + 3) * (after - weights)
        weights = after
    return weights


def quantile(values: np.ndarray, mass: np.ndarray, share: float) -> float:
    """The middle between the values that part the mass nearest to the share."""
    order = np.argsort(values, kind="stable")
    values, upto = values[order], np.cumsum(mass[order])
    at = int(np.argmin(np.abs(upto[:-1] - share * upto[-1]))) if len(values) > 1 else 0
    return float(values[at] + values[min(at + 1, len(values) - 1)]) / 2


def labelled(labels: DataFrame) -> DataFrame:
    """One 0/1 ``quality`` for each ``doc_id`` that has one: the highest."""
    return labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("quality"))


def held_out_column() -> Column:
    """Documents that nothing is learned from: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


_BLOCK = "block long, quality binary, own binary, n binary, at binary, value binary"


def _blocks(docs: DataFrame, known: DataFrame, held_out: Column) -> DataFrame:
    """One row a block of labelled documents: of each its ``quality``, whether this is its ``own`` first
    block, and the places and values of the ``n`` features that are not zero.

    A document of the larger class is in one block; one of the smaller class in several, evenly spread, if
    it is rare.
    """
    counts = {r.quality: r.n for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    many, few = max(counts.values(), default=0), min(counts.values(), default=0)
    blocks = max(1, -(-many // BLOCK_DOCS))
    copies = min(blocks, max(1, -(-BLOCK_RARE * blocks // max(few, 1))))
    rare = min(counts, key=lambda q: (counts[q], q), default=0)
    ddl = "doc_id long, at binary, value binary"
    schema = arrow(ddl)

    def measure(batches):
        for b in batches:
            rows = [features(t).astype("<f4") for t in b.column("text").to_pylist()]
            places = [np.flatnonzero(r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array([p.astype("<u2").tobytes() for p in places], pa.binary()),
                 pa.array([r[p].tobytes() for r, p in zip(rows, places)], pa.binary())], schema=schema)

    # Features are joined, not texts, which are larger.
    texts = docs.filter("doc_id IS NOT NULL").filter(~held_out).select("doc_id", utf8(F.col("text")).alias("text"))
    joined = texts.mapInArrow(measure, ddl).join(known.select(F.col("doc_id").cast("long").alias("doc_id"), "quality"), "doc_id")
    times = F.when(F.col("quality") == rare, copies).otherwise(1)
    dealt = joined.withColumn("copy", F.explode(F.sequence(F.lit(0), times - 1))).withColumn(
        "block", F.pmod(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(blocks)) + F.col("copy") * (blocks // copies), F.lit(blocks)))
    out = arrow(_BLOCK)

    def gather(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("quality", "doc_id", "copy", "at", "value"))))
        packed = [np.array([r[0] for r in rows], "u1"), np.array([r[2] == 0 for r in rows], "u1"),
                  np.array([len(r[3]) // 2 for r in rows], "<u2")]
        columns = [*(p.tobytes() for p in packed), b"".join(r[3] for r in rows), b"".join(r[4] for r in rows)]
        return pa.Table.from_arrays([table.column("block").slice(0, 1), *(pa.array([c], pa.binary()) for c in columns)], schema=out)

    return dealt.groupBy("block").applyInArrow(gather, _BLOCK)


def _unpacked(batches):
    """Of every block: quality, own, start of each document's features, their places and values."""
    for b in batches:
        for quality, own, n, at, value in zip(*(b.column(c).to_pylist() for c in ("quality", "own", "n", "at", "value"))):
            n = np.frombuffer(n, "<u2").astype(int)
            yield (np.frombuffer(quality, "u1"), np.frombuffer(own, "u1") > 0, np.cumsum(n) - n, n,
                   np.frombuffer(at, "<u2").astype(int), np.frombuffer(value, "<f4").astype(float))


def _strengths(weights: np.ndarray, start: np.ndarray, at: np.ndarray, value: np.ndarray) -> np.ndarray:
    # Every text has a feature that is not zero, its line end.
    return np.add.reduceat(value * weights[at], start)


def _loss(blocks: DataFrame, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean logistic loss of all pairs with the ridge, and its slope."""
    schema = arrow("sums binary")

    def add(batches):
        total = np.zeros(2 + N_FEATURES)
        for quality, _, start, n, at, value in _unpacked(batches):
            strength, good = _strengths(weights, start, at, value), quality == 1
            margin = strength[good][:, None] - strength[~good][None, :]
            pull = 1 / (1 + np.exp(np.clip(margin, -500, 500)))
            slope = np.zeros(len(quality))
            slope[good], slope[~good] = -pull.sum(axis=1), pull.sum(axis=0)
            total[0] += np.logaddexp(0, -margin).sum()
            total[1] += margin.size
            total[2:] += np.bincount(at, value * np.repeat(slope, n), N_FEATURES)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], schema=schema)

    # One row of sums a task, added in the order of their bytes: runs agree.
    rows = sorted(bytes(r.sums) for r in blocks.mapInArrow(add, "sums binary").collect())
    total = np.sum([np.frombuffer(r) for r in rows], axis=0) if rows else np.zeros(2 + N_FEATURES)
    pairs = max(total[1], 1.0)
    return total[0] / pairs + RIDGE / 2 * float(weights @ weights), total[2:] / pairs + RIDGE * weights


def fit_blocks(blocks: DataFrame, steps: int = STEPS) -> np.ndarray:
    """Weights that minimise the mean logistic loss of all pairs of all blocks and a small ridge, by
    quasi-Newton steps of limited memory."""
    weights = np.zeros(N_FEATURES)
    loss, slope = _loss(blocks, weights)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if not slope.any():
            break
        way, shares = -slope, []
        for moved, bent in reversed(past):
            shares.append((moved @ way) / (moved @ bent))
            way = way - shares[-1] * bent
        way = way * ((past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / np.linalg.norm(slope))
        for (moved, bent), share in zip(past, reversed(shares)):
            way = way + (share - (bent @ way) / (moved @ bent)) * moved
        step = 1.0
        while True:
            ahead, ahead_slope = _loss(blocks, weights + step * way)
            if ahead <= loss + 1e-4 * step * float(slope @ way) or step < 1e-6:
                break
            step /= 2
        if ahead >= loss:
            break
        moved, bent = step * way, ahead_slope - slope
        done = loss - ahead <= 1e-6 * loss
        weights, loss, slope = weights + moved, ahead, ahead_slope
        if moved @ bent > 0:
            past = [*past, (moved, bent)][-HISTORY:]
        if done:
            break
    return weights


def _at_rank(strengths: DataFrame, rank: int) -> float:
    """The ``rank``-th smallest strength, from 1: the range is cut into parts, and the one with it cut again."""
    lo, hi = strengths.agg(F.min("strength"), F.max("strength")).first()
    while lo < hi:
        share = (F.col("strength") - F.lit(lo)) / F.lit(hi - lo)
        part = F.least(F.floor(share * PARTS), F.lit(PARTS - 1)).alias("part")
        inside = strengths.filter(F.col("strength").between(lo, hi)).groupBy(part).agg(
            F.count(F.lit(1)).alias("n"), F.min("strength").alias("lo"), F.max("strength").alias("hi"))
        for r in sorted(inside.collect(), key=lambda r: r.part):
            if rank <= r.n:
                lo, hi = r.lo, r.hi
                break
            rank -= r.n
    return lo


def fit(docs: DataFrame, labels: DataFrame, held_out: Column) -> Ranking:
    """The ranking of all labelled documents that are not held out. Of rows that share an id each counts.

    Without documents of both classes all texts are of equal strength, at the threshold.
    """
    blocks = materialise(_blocks(docs, labelled(labels).filter(~held_out), held_out), "quality-blocks")
    weights = fit_blocks(blocks)
    if not weights.any():
        return Ranking(weights, 0.0)
    schema = arrow("quality int, strength double")

    def measure(batches):
        for quality, own, start, _, at, value in _unpacked(batches):
            strength = _strengths(weights, start, at, value)
            yield pa.RecordBatch.from_arrays([pa.array(quality[own], pa.int32()), pa.array(strength[own])], schema=schema)

    strengths = materialise(blocks.mapInArrow(measure, "quality int, strength double"), "quality-strengths")
    bad = strengths.filter("quality = 0").count()
    threshold = (_at_rank(strengths, bad) + _at_rank(strengths, bad + 1)) / 2
    drop(blocks, strengths)
    return Ranking(weights, threshold)


def rank(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """``docs`` with ``strength`` and ``score`` of ``text`` alone; all other columns are kept.

    Whole texts are read; null ones count as empty. Equal texts get equal scores, an empty table none.
    """
    @F.pandas_udf("strength double, score double")
    def measure(texts):
        import pandas as pd

        strength = np.array([ranking.strength(features(t)) for t in texts], dtype=float)
        return pd.DataFrame({"strength": strength, "score": ranking.score(strength)})

    names = [c for c in docs.columns if c not in ("strength", "score")]
    return docs.withColumn("__ranked", measure(utf8(F.col("text")))).select(
        *[F.col(f"`{c}`") for c in names], "__ranked.strength", "__ranked.score")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document, learned from the labels of those that are not held out."""
    docs = docs.select("doc_id", "text")
    ranked = rank(docs, fit(docs, labels, held_out_column()))
    return ranked.select("doc_id", held_out_column().alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))
