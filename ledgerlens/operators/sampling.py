"""Train/test split and class balancing. All draws come from a stable hash of the row id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.neighbours import CELL_ROWS, group_key, nearest_neighbours
from ledgerlens.operators.ranking import first_by_hash, hash_row_number, stable_hash, unit_interval
from ledgerlens.session import materialise

SEED = 42
# Neighbours used to make and to clean synthetic rows.
SMOTE_NEIGHBOURS = 5
ENN_NEIGHBOURS = 3
# Copies of one row made by one task step; more copies are spread over more tasks.
_COPIES_PER_BLOCK = 1000


def class_counts(df: DataFrame, label: str = "label") -> dict[int, int]:
    """Rows per class: one small aggregate."""
    return {int(r[0]): int(r[1]) for r in df.groupBy(label).count().collect()}


def class_balance(df: DataFrame, stage: str, label: str = "label") -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.lit(stage).alias("stage"), "label", "n")


def stratified_split(
    df: DataFrame, test_size: float = 0.2, seed: int = SEED, label: str = "label", key: str = "id"
) -> DataFrame:
    """Adds ``part`` ('train' or 'test'); every class gives the same share, rounded half up."""
    wanted = F.floor(F.col("_of") * test_size + 0.5)
    decided = first_by_hash(df, label, key, seed, wanted, "_test")
    return decided.withColumn("part", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def fold_of(key: str, n_splits: int, seed: int = SEED):
    """Fold number 0 .. n_splits-1 of a row."""
    draw = F.conv(F.substring(stable_hash(key, f"fold-{seed}"), 1, 8), 16, 10).cast("long")
    return F.pmod(draw, F.lit(n_splits)).cast("int")


def _group(groups: list[str]) -> Column:
    return F.struct(*[F.col(g) for g in groups])


def under_sample(
    df: DataFrame, seed: int = SEED, label: str = "label", key: str = "id", groups: list[str] | None = None
) -> DataFrame:
    """Every class, in each group, down to the size of the smallest one there."""
    groups = groups or []
    classes = df.withColumn("_class", F.struct(_group(groups).alias("of"), F.col(label).alias("label"))) if groups else df
    if groups:
        # One row for each class and hash bucket is all that this window sees.
        size = F.min("_of").over(Window.partitionBy(F.col("_group")["of"]))
        return first_by_hash(classes, "_class", key, f"under-{seed}", size, "_kept").where("_kept").drop("_kept", "_class")
    counts = class_counts(df, label)
    if not counts:
        return df
    size = F.lit(min(counts.values()))
    return first_by_hash(df, label, key, f"under-{seed}", size, "_kept").where("_kept").drop("_kept")


def _copies_wanted(rows: DataFrame, groups: list[str]) -> dict[str, tuple[int, int, int]]:
    """For each group that needs synthetic rows: its smaller class, and how many copies each of its rows
    gives and how many of them give one more. As many rows as there are groups and classes."""
    counts: dict[str, dict[int, int]] = {}
    counted = rows.groupBy(group_key(groups).alias("g"), "label").agg(F.count(F.lit(1)).alias("n"))
    for g, label, n in counted.collect():
        counts.setdefault(g, {})[label] = n
    wanted = {}
    for g, classes in counts.items():
        small = min(classes, key=lambda c: (classes[c], -c))
        need = max(classes.values()) - classes[small]
        if len(classes) > 1 and need and classes[small] > 1:
            wanted[g] = (small, *divmod(need, classes[small]))
    return wanted


def smote(
    df: DataFrame, features: list[str], seed: int = SEED, k: int = SMOTE_NEIGHBOURS,
    label: str = "label", key: str = "id", cell_rows: int = CELL_ROWS, groups: list[str] | None = None,
) -> DataFrame:
    """``(groups, id, label, features)`` with synthetic minority rows until the classes are equal.

    A synthetic row lies between a minority row and one of its k nearest minority rows. The draws
    go round the minority rows in hashed order, so their numbers differ by one at most. With ``groups``
    each group is balanced by itself, all of them in one neighbour search.
    """
    groups = groups or []
    rows = df.select(
        *groups,
        F.col(key).cast("string").alias("id"),
        F.col(label).cast("int").alias("label"),
        *[F.col(f"`{c}`").cast("double").alias(c) for c in features],
    )
    wanted = _copies_wanted(rows, groups)
    if not wanted:
        return rows

    def of_group(i: int) -> Column:
        pairs = [F.lit(x) for g, values in wanted.items() for x in (g, values[i])]
        return F.try_element_at(F.create_map(*pairs), group_key(groups))

    # Numbered before the search, so that the search is not evaluated for the numbering as well.
    minority = materialise(
        hash_row_number(rows.where(F.col("label") == of_group(0)), groups, "id", f"smote-{seed}", "_rn"), "minority"
    )
    numbered = nearest_neighbours(minority, minority, features, k, True, cell_rows, groups)
    copies = of_group(1) + F.when(F.col("_rn") <= of_group(2), 1).otherwise(0)
    per_block = F.lit(_COPIES_PER_BLOCK)
    blocks = numbered.withColumn("_copies", copies.cast("int")).where("_copies > 0").withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / per_block).cast("int")))
    )
    blocks = blocks.repartition(*groups, "id", "_block")
    last = F.least(F.col("_copies"), (F.col("_block") + 1) * per_block)
    drawn = blocks.withColumn(
        "_copy", F.explode(F.sequence(F.col("_block") * per_block + 1, last))
    )
    draw = F.concat_ws("|", "id", "_copy")
    pick = F.conv(F.substring(stable_hash(draw, f"neighbour-{seed}"), 1, 8), 16, 10).cast("long")
    drawn = drawn.withColumn(
        "_to", F.element_at("neighbours", (F.pmod(pick, F.size("neighbours")) + 1).cast("int"))["vec"]
    ).withColumn("_u", unit_interval(stable_hash(draw, f"step-{seed}")))
    made = drawn.select(
        *groups,
        F.concat_ws("#", "id", "_copy").alias("id"),
        "label",
        *[
            (F.col(f"`{c}`") + F.col("_u") * (F.col("_to")[i] - F.col(f"`{c}`"))).alias(c)
            for i, c in enumerate(features)
        ],
    )
    return rows.unionByName(made)


def edited(
    grown: DataFrame, features: list[str], k: int = ENN_NEIGHBOURS, cell_rows: int = CELL_ROWS,
    groups: list[str] | None = None,
) -> DataFrame:
    """Without the rows whose nearest neighbours, in their group, do not all share their class."""
    near = nearest_neighbours(grown, grown, features, k, True, cell_rows, groups, vectors=False)
    agree = F.forall("neighbours", lambda x: x["label"] == F.col("label"))
    return near.where(agree).select(*grown.columns)


def smote_enn(
    df: DataFrame, features: list[str], seed: int = SEED, k: int = SMOTE_NEIGHBOURS,
    k_clean: int = ENN_NEIGHBOURS, label: str = "label", key: str = "id", cell_rows: int = CELL_ROWS,
    groups: list[str] | None = None,
) -> DataFrame:
    """SMOTE, then without the rows whose nearest neighbours do not all share their class."""
    grown = materialise(smote(df, features, seed, k, label, key, cell_rows, groups), "smote")
    return edited(grown, features, k_clean, cell_rows, groups)


def resample(
    df: DataFrame, kind: str | None, features: list[str], seed: int = SEED, groups: list[str] | None = None
) -> DataFrame:
    """``(groups, id, label, features)`` balanced by 'under', 'smote' or 'combine', each group by itself;
    None leaves it as is."""
    rows = df.select(*(groups or []), F.col("id").cast("string").alias("id"), "label", *features)
    if kind is None:
        return rows
    if kind == "under":
        return under_sample(rows, seed, groups=groups)
    if kind == "smote":
        return smote(rows, features, seed, groups=groups)
    if kind == "combine":
        return smote_enn(rows, features, seed, groups=groups)
    raise ValueError(f"unknown sampling {kind!r}: use 'under', 'smote', 'combine' or None")
