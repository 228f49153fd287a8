"""Exact area under the ROC curve, for many score lists at once and any number of classes (L3).

Rows of one score are first joined into a cell (partial aggregation), so ties
count one half and the work after that grows with distinct scores. A cell needs
the negatives below it: a running sum in score order. A group of at most
``MAX_CELLS`` cells is one window; a larger one is cut at approximate quantiles
of its scores into pieces of about that size, each piece is one window, and
the pieces' totals, a few rows a group, give what lies below a piece. So no
task holds a whole large group, and cells are exact whatever the cuts.

Rows without a score or a class are no cases and are left out. A group without both
kinds of rows has no curve: its area is null.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.session import checkpoint_root

MAX_CELLS = 1_000_000
# Cut points sent to every task: at most this many numbers.
MAX_BROADCAST_CUTS = 100_000


def _below_by_pieces(cells: DataFrame, group: list[str], pieces: int) -> DataFrame:
    """``cells`` with ``__below``: negatives of the group with a lower score."""
    at = [k / pieces for k in range(1, pieces)]
    cuts = cells.groupBy(*group).agg(F.percentile_approx("__score", at, 100 * pieces).alias("__cuts"))
    checkpoint_root(cells.sparkSession)
    cuts = cuts.checkpoint(eager=True)
    small = cuts.count() * pieces <= MAX_BROADCAST_CUTS
    sent = F.broadcast if small else (lambda df: df)
    piece = F.size(F.filter("__cuts", lambda c: c < F.col("__score")))
    placed = _join_groups(cells, sent(cuts), group).withColumn("__piece", piece).drop("__cuts")
    totals = placed.groupBy(*group, "__piece").agg(F.sum("__neg").alias("__n"))
    before = Window.partitionBy(*group).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    start = totals.select(*group, "__piece", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*group, "__piece").orderBy("__score").rowsBetween(Window.unboundedPreceding, -1)
    run = placed.withColumn("__inside", F.coalesce(F.sum("__neg").over(inside), F.lit(0)))
    return _join_groups(run, sent(start), [*group, "__piece"]).withColumn("__below", F.col("__start") + F.col("__inside"))


def _join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join that keeps null keys as a group of their own."""
    named = right.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"__r{i}")) for i, k in enumerate(keys)]
    return left.join(named, cond).drop(*[f"__r{i}" for i in range(len(keys))])


def grouped_auc(scored: DataFrame, group: Sequence[str], score: str | Column, positive: str | Column,
                max_cells: int = MAX_CELLS, largest: int | None = None) -> DataFrame:
    """``group``, ``n_pos``, ``n_neg`` and ``auc`` of every group.

    A caller that knows the rows of the largest group gives them as ``largest``; otherwise the cells are
    counted first.
    """
    group = list(group) or ["__all"]
    s = F.col(score) if isinstance(score, str) else score
    y = F.col(positive) if isinstance(positive, str) else positive
    cases = scored.withColumn("__score", s.cast("double")).withColumn("__y", y.cast("boolean"))
    if group == ["__all"]:
        cases = cases.withColumn("__all", F.lit(0))
    cases = cases.filter("__score is not null and __y is not null")
    cells = cases.groupBy(*group, "__score").agg(F.count_if("__y").alias("__pos"), F.count_if(~F.col("__y")).alias("__neg"))
    if largest is None or largest > max_cells:
        checkpoint_root(scored.sparkSession)
        cells = cells.checkpoint(eager=True)
        largest = cells.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0] or 0
    if largest <= max_cells:
        before = Window.partitionBy(*group).orderBy("__score").rowsBetween(Window.unboundedPreceding, -1)
        ranked = cells.withColumn("__below", F.coalesce(F.sum("__neg").over(before), F.lit(0)))
    else:
        ranked = _below_by_pieces(cells, group, 2 * math.ceil(largest / max_cells))
    # Twice the pairs won, as whole numbers: exact in any order (38 digits).
    wins = F.sum((F.col("__pos") * (2 * F.col("__below") + F.col("__neg"))).cast("decimal(38,0)"))
    out = ranked.groupBy(*group).agg(F.sum("__pos").alias("n_pos"), F.sum("__neg").alias("n_neg"), wins.alias("__wins"))
    area = F.col("__wins").cast("double") / (2 * F.col("n_pos").cast("double") * F.col("n_neg").cast("double"))
    out = out.withColumn("auc", F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), area)).drop("__wins")
    return out.drop("__all") if group == ["__all"] else out


def auc_per_class(scored: DataFrame, label: str, scores: Mapping[object, str], max_cells: int = MAX_CELLS) -> DataFrame:
    """One-versus-rest area of every class: ``class, n_rows, share, auc``.

    ``scores`` maps each class to the column with its score. ``share`` is the class's
    part of the rows that carry one of these classes; rows of other classes are
    left out. A class without rows, or with all of them, has no area.
    """
    if len(scores) < 2:
        raise ValueError("at least two classes are needed")
    known = scored.filter(F.col(label).isin(*scores))
    each = F.explode(F.array(*[
        F.struct(F.lit(str(c)).alias("class"), F.col(col).cast("double").alias("score"), (F.col(label) == F.lit(c)).alias("own"))
        for c, col in scores.items()]))
    flat = known.select(each.alias("c")).select("c.class", "c.score", "c.own")
    found = grouped_auc(flat, ["class"], "score", "own", max_cells)
    return found.select("class", F.col("n_pos").alias("n_rows"), (F.col("n_pos") / (F.col("n_pos") + F.col("n_neg"))).alias("share"), "auc")


def weighted_auc(scored: DataFrame, label: str, scores: Mapping[object, str], max_cells: int = MAX_CELLS) -> DataFrame:
    """Areas of all classes weighted by their shares, as one row ``auc_weighted``.

    For two classes scored by p and 1 - p this is the plain area.
    """
    parts = auc_per_class(scored, label, scores, max_cells).filter("auc is not null")
    return parts.agg((F.sum(F.col("share") * F.col("auc")) / F.sum("share")).alias("auc_weighted"))
