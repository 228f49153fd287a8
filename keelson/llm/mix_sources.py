"""Operator 1: mixing sources to target weights by hash-threshold histograms.

Every row gets a 56-bit hash of its id and size. Per source, sizes are summed
by hash bucket; the running sum over 256 buckets finds the bucket in which the
word budget runs out, and only that bucket is divided again by the next eight
bits, until it holds one row. What lies below the threshold is taken: a
filter, no sort. A second copy has a threshold nested in the first, as a
source repeats only once all of it is taken. What the boundary row leaves open
is filled by the same search among the rows that still fit, round by round
until none does; where all of them fit together, all are taken. Last, each
source takes one more row if that brings it nearer to its target.

Defined results: a null or empty text has size 0 and is never taken; a null
source is a source of its own and comes last; rows with equal hash (copies of
one id) are told apart by their position in the scan, which only decides which
of the equal rows count; an empty table gives an empty result; columns other
than ``doc_id``, ``source`` and ``text`` are not read, and carried as they are by
``mix_documents``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import WORD, source_key, stash
from keelson.operators.rank import rank_within_groups

HASH_BITS, POS_BITS, DIGIT = 56, 64, 8
LEVELS = (HASH_BITS + POS_BITS) // DIGIT


def row_size():
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({
        "__size": row_size(), "__key": source_key("source"), "__pos": F.monotonically_increasing_id(),
    }).withColumn("__hash", F.shiftrightunsigned(F.xxhash64(F.lit("mix"), F.col("doc_id"), F.col("__size")),
                                                 64 - HASH_BITS))


def source_targets(rows: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Per source: rows' total, weight and target, by proportional filling.

    The level (words per weight) rises until the sources below their cap take
    up the whole budget; each round is one aggregate over the source table.
    """
    per = rows.groupBy("__key").agg(F.sum("__size").alias("__total"), F.first("source").alias("__source"))
    per = per.withColumn("__all", F.lit(0)).withColumn("__null", F.col("__source").isNull())
    ranked = rank_within_groups(per, ["__all"], ["__null", "__source"], rank_col="__rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = stash(ranked.select("__key", "__total", F.element_at(
        cycle, ((F.col("__rank") - 1) % len(weights) + 1).cast("int")).alias("__weight")), "mix-sources")
    budget = share * float(per.agg(F.sum("__total")).first()[0] or 0)
    cap, level = most * F.col("__total"), 0.0
    while True:
        under = cap >= level * F.col("__weight")
        full, weight = per.agg(F.sum(F.when(~under, cap).otherwise(0.0)),
                               F.sum(F.when(under, F.col("__weight")).otherwise(0.0))).first()
        if not weight or (budget - full) / weight <= level:
            break
        level = (budget - full) / weight
    return per.withColumn("__target", F.least(cap.cast("double"), F.lit(level) * F.col("__weight")))


def _digit(level: int):
    """The ``level``-th group of eight bits of (hash, position)."""
    column, shift = (("__hash", HASH_BITS - DIGIT * (level + 1)) if level < HASH_BITS // DIGIT
                     else ("__pos", HASH_BITS + POS_BITS - DIGIT * (level + 1)))
    return F.shiftrightunsigned(F.col(column), shift).bitwiseAND(255)


def _below(hash_to: str, pos_to: str):
    return (F.col("__hash") < F.col(hash_to)) | ((F.col("__hash") == F.col(hash_to)) & (F.col("__pos") < F.col(pos_to)))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per ``__key`` the (hash, position) below which rows sum up to ``__budget``.

    Returns ``__key, __h, __p, __left``; ``__left`` is the budget still open.
    Rows that sum up to no more than the budget all lie below.
    """
    rows = rows.filter("__size > 0").select("__key", "__size", "__hash", "__pos")
    open_ = budgets.select("__key", F.col("__budget").alias("__left"), F.lit(0).cast("bigint").alias("__h"),
                           F.lit(0).cast("bigint").alias("__p"))
    done = None
    for level in range(LEVELS):
        in_hash = level < HASH_BITS // DIGIT
        shift = (HASH_BITS if in_hash else HASH_BITS + POS_BITS) - DIGIT * (level + 1)
        if level == 0:
            inside = F.lit(True)
        elif in_hash:
            inside = F.shiftrightunsigned("__hash", shift + DIGIT) == F.shiftrightunsigned("__h", shift + DIGIT)
        else:
            inside = F.col("__hash") == F.col("__h")
            if level > HASH_BITS // DIGIT:
                inside &= F.shiftrightunsigned("__pos", shift + DIGIT) == F.shiftrightunsigned("__p", shift + DIGIT)
        sums = (rows.join(open_, "__key").filter(inside)
                .groupBy("__key", _digit(level).alias("__digit"))
                .agg(F.sum("__size").alias("__sum"), F.count(F.lit(1)).alias("__n")))
        upto = Window.partitionBy("__key").orderBy("__digit").rowsBetween(Window.unboundedPreceding, 0)
        run = sums.withColumns({"__run": F.sum("__sum").over(upto),
                                "__all": F.sum("__sum").over(Window.partitionBy("__key"))})
        # Below the first level the boundary lies inside the bucket.
        fits = F.col("__all") <= F.col("__left") if level == 0 else F.lit(False)
        at = (run.join(open_, "__key").filter((F.col("__run") > F.col("__left")) | fits)
              .groupBy("__key", "__left", "__h", "__p", fits.alias("__whole"), "__all")
              .agg(F.min(F.struct("__digit", "__run", "__sum", "__n")).alias("b")))
        step = F.col("b.__digit").cast("bigint") * F.lit(1 << shift if shift < 63 else 0).cast("bigint")
        whole = F.col("__whole")
        found = stash(at.select(
            "__key", (F.col("__left") - F.when(whole, F.col("__all")).otherwise(F.col("b.__run") - F.col("b.__sum"))).alias("__left"),
            F.when(whole, F.lit(1 << HASH_BITS)).otherwise(F.col("__h") + step if in_hash else F.col("__h")).alias("__h"),
            (F.col("__p") if in_hash else F.col("__p") + step).alias("__p"),
            F.when(whole, 0).otherwise(F.col("b.__n")).alias("__n")), "mix-cut")
        single = found.filter("__n <= 1").select("__key", "__left", "__h", "__p")
        done = single if done is None else done.unionByName(single)
        open_ = found.filter("__n > 1").drop("__n")
        if open_.isEmpty():
            break
    return done


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Rows with the number of copies the mix takes.

    ``share`` of all words is divided over the sources by ``weights``, which
    repeat in code-point order of the sources (null last); no target exceeds
    ``most`` (at most 2) times its source. Returns ``doc_id, source, size,
    source_size, target, copies, taken``.
    """
    rows = stash(_keyed(docs.select("doc_id", "source", "text")).drop("text"), "mix-rows")
    plan = decide(rows, weights, share, most)
    return _apply(rows, plan).select("doc_id", "source", F.col("__size").alias("size"),
                                     F.col("__total").alias("source_size"), F.col("__target").alias("target"),
                                     F.col("__copies").alias("copies"),
                                     (F.col("__copies") * F.col("__size")).alias("taken"))


def mix_documents(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
                  most: float = 2.0) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    # The documents' own columns travel as one, whatever their names.
    keyed = _keyed(docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")))
    rows = stash(keyed.select("doc_id", "source", "__size", "__key", "__pos", "__hash"), "mix-rows")
    taken = _apply(keyed, decide(rows, weights, share, most)).filter("__copies > 0")
    return (taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select("__row.*"))


def decide(rows: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Per source: the copies everything gets, and the cuts for one more."""
    if not 0 < most <= 2:
        raise ValueError("most must be above 0 and at most 2")
    targets = source_targets(rows, weights, share, most)
    whole = (F.col("__total") > 0) & (F.col("__target") >= F.col("__total"))
    plan = targets.withColumn("__base", F.when(whole, 1).otherwise(0)).withColumn(
        "__budget", F.col("__target") - F.col("__base") * F.col("__total"))
    # A budget that covers the source exactly has no boundary row.
    all_of = F.lit(1 << HASH_BITS).cast("bigint")
    open_ = plan.filter("__budget > 0 and __budget < __total")
    closed = plan.select("__key", "__total", "__target", "__base",
                         F.when((F.col("__budget") >= F.col("__total")) & (F.col("__total") > 0), all_of)
                         .otherwise(F.lit(0).cast("bigint")).alias("__whole"))
    cuts, left, k = closed, rows, 0
    still = open_.select("__key", F.col("__budget").alias("__open"))
    while True:
        found = thresholds(left, open_)
        found = stash(found.withColumn("__gap", F.col("__left")), "mix-fill")
        gap = open_.select("__key", F.col("__budget").alias(f"__gap{k}"))
        cuts = stash(cuts.join(gap.join(found.select("__key", F.col("__h").alias(f"__h{k}"),
                                                     F.col("__p").alias(f"__p{k}")), "__key"), "__key", "left"),
                     "mix-plan")
        still = stash(still.join(found.select("__key", "__gap"), "__key", "left").select(
            "__key", F.coalesce("__gap", "__open").alias("__open")), "mix-open")
        open_ = found.filter("__gap >= 1").select("__key", F.col("__gap").alias("__budget"))
        now = left.join(found.select("__key", F.col("__h").alias("__h_"), F.col("__p").alias("__p_"), "__gap"), "__key")
        left = now.filter(~_below("__h_", "__p_") & (F.col("__size") <= F.col("__gap"))).select(*left.columns)
        if left.isEmpty():
            break
        left, k = stash(left, "mix-left"), k + 1
    # One more row: the one that comes nearest to the target, if nearer than without it.
    over = F.abs(F.col("__size") - F.col("__open"))
    rest = (rows.join(cuts, "__key").filter(~_taken_more(cuts)).select(*rows.columns).join(still, "__key")
            .filter((F.col("__size") > 0) & (over <= F.col("__open"))))
    last = rest.groupBy("__key").agg(F.min(F.struct(over.alias("over"), "__hash", "__pos")).alias("b"))
    return stash(cuts.join(last.select("__key", F.col("b.__hash").alias("__last_h"), F.col("b.__pos").alias("__last_p")),
                           "__key", "left"), "mix-plan")


def _taken_more(plan: DataFrame):
    """Whether a row is taken once more than the base of its source."""
    more = F.col("__hash") < F.col("__whole")
    for c in plan.columns:
        if c.startswith("__gap"):
            k = c[len("__gap"):]
            more |= F.coalesce((F.col("__size") <= F.col(c)) & _below(f"__h{k}", f"__p{k}"), F.lit(False))
    if "__last_h" in plan.columns:
        more |= F.coalesce((F.col("__hash") == F.col("__last_h")) & (F.col("__pos") == F.col("__last_p")), F.lit(False))
    return more


def _apply(rows: DataFrame, plan: DataFrame) -> DataFrame:
    more = _taken_more(plan)
    return (rows.join(plan, "__key").withColumn(
        "__copies", F.when(F.col("__size") > 0, F.col("__base") + F.when(more, 1).otherwise(0)).otherwise(0)))
