"""Mixing sources to target weights: Efraimidis-Spirakis sampling on DataFrame functions only.

Every document draws an exponential key with rate equal to its quality weight; the smallest keys of
a source come first. A source that must give more than all its words gives every document whole
epochs first, and the fraction that is left goes to the documents with the smallest keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import n_words
from ledgerlens.session import materialise

# Keys are cut into so many slices; only the slice in which a budget ends is ordered row by row.
SLICES = 65_536


def quality_weight(quality: Column) -> Column:
    """Sampling weight of a document: good 2, bad 0.5, unknown 1."""
    return F.when(quality == 1, 2.0).when(quality == 0, 0.5).otherwise(1.0)


def with_quality(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, source``, the words of the text as ``_words``, and ``_weight`` from ``labels``; with
    several labels of a document the best counts.

    Words are counted in the scan: no text travels through the join.
    """
    best = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max("quality").alias("_quality"))
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("_words"), *keep)
    return sized.join(best, sized["doc_id"] == best["_id"], "left").withColumn(
        "_weight", quality_weight(F.col("_quality"))).drop("_id", "_quality")


def uniform(doc_id: Column, seed: int) -> Column:
    """A number inside (0, 1) that depends on the id and the seed alone: 52 bits of a stable hash."""
    text = F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def source_targets(sizes: DataFrame, cycle: tuple, share: float, max_epochs: int) -> DataFrame:
    """``source``, ``source_size``, ``target``: weights go round ``cycle`` in code-point order, null last.

    The water level rises until the targets add up: a source stops at ``max_epochs`` times its size
    and the others share the excess by weight. One row a source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    weighed = per_source.withColumn("_n", F.row_number().over(by_name)).withColumn(
        "_w", F.element_at(weights, ((F.col("_n") - 1) % len(cycle) + 1).cast("int"))).withColumn(
        "_cap", F.col("source_size") * max_epochs)
    # In the order in which a rising level fills the sources.
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), "_n")
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(upto), F.lit(0))) / (
        F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(upto), F.lit(0.0)))
    filled = weighed.withColumn("_level", level).withColumn("_open", F.col("_level") * F.col("_w") <= F.col("_cap"))
    # The level of the first source that is not filled holds for all after it; earlier ones are full.
    final = F.min(F.when(F.col("_open"), F.struct((F.col("_cap") / F.col("_w")).alias("r"), "_n", "_level"))).over(every)
    return filled.withColumn("_final", final["_level"]).select(
        "source", "source_size",
        F.coalesce(F.least(F.col("_cap").cast("double"), F.col("_final") * F.col("_w")), F.col("_cap").cast("double")).alias("target"),
    )


def mix(
    docs: DataFrame, seed: int = 7, cycle: tuple = (5, 2, 1), share: float = 1.0, max_epochs: int = 3,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, epochs, taken, sample_key``.

    ``docs`` has ``doc_id, source``, ``text`` or its number of words as ``_words`` and, if quality counts,
    ``_weight`` (positive; null is 1). Columns named in ``keep`` go with their rows.
    ``taken`` is the number of words the mix takes, repeats counted: ``size`` times the whole epochs,
    plus ``size`` for the documents of the last, partial epoch. A source ends within half a document
    of its target. Null or empty text has size 0 and is never taken. Null sources are one source.
    Rows with the same ``doc_id`` share a key and are ordered by size; all rows are returned, and
    other columns are not read. An empty table gives an empty result. Reruns agree.
    """
    weight = F.coalesce(F.col("_weight"), F.lit(1.0)) if "_weight" in docs.columns else F.lit(1.0)
    sizes = materialise(docs.select(
        "doc_id", "source", *keep, (F.col("_words") if "_words" in docs.columns else n_words(F.col("text"))).alias("size"),
        (-F.log(uniform(F.col("doc_id"), seed)) / weight).alias("sample_key"),
    ), "mix-sizes")
    targets = materialise(source_targets(sizes, cycle, share, max_epochs).withColumn(
        "epochs", F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))).withColumn(
        "_rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")

    # 1 - exp(-key) is even over (0, 1) for weight 1 and never falls as the key grows.
    slice_no = F.floor((1.0 - F.exp(-F.col("sample_key"))) * SLICES)
    sliced = sizes.withColumn("_slice", slice_no)
    sums = sliced.groupBy("source", "_slice").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    named = targets.select(F.col("source").alias("_s"), "_rest")
    edge = placed.join(named, F.col("source").eqNullSafe(F.col("_s"))).filter(
        "_before < _rest AND _before + _sum >= _rest").select(
        F.col("source").alias("_es"), F.col("_slice").alias("_edge"), "_before")
    per_source = materialise(targets.join(edge, F.col("source").eqNullSafe(F.col("_es")), "left").select(
        F.col("source").alias("_s"), "source_size", "target", "epochs", "_rest", "_edge", "_before",
        F.col("_es").isNotNull().alias("_has"), F.lit(True).alias("_known")), "mix-sources")

    joined = sliced.join(per_source, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    inside = Window.partitionBy("source").orderBy("sample_key", "doc_id", "size")
    at_edge = joined.filter("_slice = _edge").withColumn(
        "_cum", F.col("_before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rest = joined.filter("NOT (_slice <=> _edge)").withColumn("_cum", F.lit(None).cast("long"))
    # Whole slices count when they lie before the edge; without an edge nothing is left to give.
    chosen = F.when(F.col("_cum").isNotNull(), 2 * F.col("_cum") + F.col("size") <= 2 * F.col("_rest")).otherwise(
        F.when(F.col("_edge").isNotNull(), F.col("_slice") < F.col("_edge")).otherwise(F.lit(False)))
    return at_edge.unionByName(rest).select(
        "doc_id", "source", "size", "source_size", "target", "epochs",
        (F.col("size") * (F.col("epochs") + F.when(chosen, 1).otherwise(0))).cast("long").alias("taken"),
        "sample_key", *keep,
    )
