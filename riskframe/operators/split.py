"""Exact, repeatable stratified splits and fold assignment.

The split is a pure function of (id, seed, class sizes), computed by the hash cut
plan: the first ``round(test_size * n_c)`` rows of class ``c`` in hash order go to
``test``, the next ``round(val_size * (n_c - n_test))`` to ``val``, the rest to
``train``. Val is a fraction of the *remaining* rows, so defaults give 64/16/20.
Not ``randomSplit`` (depends on partitioning) nor ``sampleBy`` (Bernoulli, inexact).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.plans.hashcuts import assign_by_rank

SPLITS = ("train", "val", "test")


def assign_split(
    df: DataFrame,
    id_col: str = "txn_id",
    target_col: str = "Class",
    test_size: float = 0.2,
    val_size: float = 0.2,
    seed: int = 42,
    stratify: bool = True,
) -> DataFrame:
    """Add ``split`` ('train' | 'val' | 'test'); all other columns unchanged."""
    strata = [target_col] if stratify else []

    def ranks(n):
        n = n.cast("double")
        n_test = F.round(F.lit(float(test_size)) * n)
        return [n_test, n_test + F.round(F.lit(float(val_size)) * (n - n_test))]

    out = assign_by_rank(df, strata, id_col, seed, ranks, "_part")
    return out.withColumn("split", F.element_at(F.array(*map(F.lit, ("test", "val", "train"))), F.col("_part") + 1)).drop("_part")


def kfold_assign(
    df: DataFrame, k: int = 5, id_col: str = "txn_id", target_col: str = "Class", seed: int = 42,
    stratify: bool = True,
) -> DataFrame:
    """T4: folds are runs of the hash order of each class, cut at ``floor(n j / k)``:
    balanced, stratified, and assigned without ranking or moving rows."""
    strata = [target_col] if stratify else []
    return assign_by_rank(df, strata, id_col, seed, lambda n: [F.floor(n * j / F.lit(k)) for j in range(1, k)], "fold")


def split_summary(df: DataFrame, target_col: str = "Class") -> DataFrame:
    """Rows, positives and positive percentage per split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(target_col).cast("long")).alias("positives"),
        F.round(F.sum(F.col(target_col).cast("double")) / F.count(F.lit(1)) * 100.0, 6).alias("positive_pct"),
    )


def split_frames(df: DataFrame, target_col: str = "Class") -> dict[str, tuple[DataFrame, DataFrame]]:
    """Reference-style bundle ``{split: (X, y)}`` as projections of one split frame."""
    out = {}
    for s in SPLITS:
        part = df.where(F.col("split") == s)
        out[s] = (part.drop(target_col, "split"), part.select(target_col))
    return out
