"""Packing: optimal length buckets by dynamic programming, token-budget batches inside each."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import materialise


# Sequences of a bucket are numbered in so many groups (2 to this power) that follow one another.
GROUP_BITS = 14


def optimal_boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Ascending bucket lengths (at most ``buckets``) with the least total padding.

    Every sequence is padded to the smallest boundary not below its length. Boundaries are lengths
    that occur; the last is the longest. Ties take the smaller boundary.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[int(n)] for n in lengths], dtype=np.int64)
    below = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    size, k = len(lengths), min(buckets, len(lengths))
    # best[j]: least padding of the first j lengths with the buckets used so far.
    best = np.full(size + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    choices = []
    for _ in range(k):
        nxt, choice = best.copy(), np.arange(size + 1)
        for j in range(1, size + 1):
            cost = best[:j] + lengths[j - 1] * (below[j] - below[:j]) - (tokens[j] - tokens[:j])
            i = int(np.argmin(cost))
            if cost[i] < nxt[j]:
                nxt[j], choice[j] = cost[i], i
        choices.append(choice)
        best = nxt
    out, j = [], size
    for choice in reversed(choices):
        if choice[j] != j:
            out.append(int(lengths[j - 1]))
            j = int(choice[j])
    return sorted(out)


def sequences(docs: DataFrame, length: str, max_len: int) -> DataFrame:
    """``doc_id, piece, start, n_tokens``: documents longer than ``max_len`` are cut into pieces.

    A document of null or no length gives one row with piece 0 and no tokens.
    """
    whole = docs.select("doc_id", F.greatest(F.coalesce(F.col(length), F.lit(0)), F.lit(0)).cast("long").alias("_len"))
    last = F.greatest(F.ceil(F.col("_len") / max_len) - 1, F.lit(0))
    return whole.select("doc_id", "_len", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * max_len).alias("start"),
        F.least(F.col("_len") - F.col("piece") * max_len, F.lit(max_len)).cast("long").alias("n_tokens"))


def pack(
    docs: DataFrame, length: str, max_len: int = 2048, buckets: int = 8, token_budget: int = 65_536,
) -> DataFrame:
    """Per sequence: ``doc_id, piece, start, n_tokens, bucket_len, batch, slot, padding``.

    ``length`` names the column with a document's tokens. The histogram of sequence lengths has at
    most ``max_len`` entries whatever the input, so it alone goes to the driver. A batch of a bucket
    holds ``max(1, token_budget // bucket_len)`` sequences, all full but the bucket's last; ``batch``
    counts from 0 inside the bucket, ``slot`` inside the batch, in the order of a stable hash.
    Sequences without tokens have null ``bucket_len, batch, slot, padding``: nothing is packed.
    Other columns are not read; repeated ids are separate sequences; an empty table gives no rows.
    """
    pieces = materialise(sequences(docs, length, max_len), "pack-sequences")
    histogram = {r["n_tokens"]: r["n"] for r in pieces.filter("n_tokens > 0").groupBy("n_tokens").agg(
        F.count("*").alias("n")).collect()}
    bounds = optimal_boundaries(histogram, buckets)
    none = F.lit(None).cast("long")
    bucket = none
    for b in reversed(bounds):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b).cast("long")).otherwise(bucket)
    bucket = F.when(F.col("n_tokens") > 0, bucket)
    placed = pieces.withColumn("bucket_len", bucket).withColumn("_h", F.xxhash64("doc_id", "piece", "n_tokens"))
    # The order is that of the hash, whatever the cluster: its high bits cut it into groups.
    placed = placed.withColumn("_g", F.shiftright("_h", 64 - GROUP_BITS))
    before = Window.partitionBy("bucket_len").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("bucket_len", "_g").agg(F.count("*").alias("_n")).select(
        F.col("bucket_len").alias("_b"), F.col("_g").alias("_og"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("bucket_len", "_g").orderBy("_h", "doc_id", "piece")
    numbered = placed.withColumn("_rn", F.row_number().over(inside) - 1).join(
        offsets, (F.col("bucket_len") == F.col("_b")) & (F.col("_g") == F.col("_og")), "left")
    place = F.col("_offset") + F.col("_rn")
    per_batch = F.greatest(F.floor(F.lit(token_budget) / F.col("bucket_len")), F.lit(1))
    return numbered.select(
        "doc_id", "piece", "start", "n_tokens", "bucket_len",
        F.floor(place / per_batch).cast("long").alias("batch"),
        F.when(F.col("bucket_len").isNotNull(), place % per_batch).cast("long").alias("slot"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
    )
