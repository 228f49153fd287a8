"""Feature lookups (J1) and training-set assembly.

A lookup is a row-preserving left join of a base frame against a feature
table on the table's primary key. Contract:

* every base row comes out exactly once: the feature key must be a primary
  key (checked before the join unless the caller vouches for it), so the join
  cannot fan out;
* an unmatched or null base key gives null features;
* output columns are the base columns (lookup keys included), then the
  looked-up features in lookup order;
* a feature name that already exists in the base frame is an error unless it
  is renamed.

Physical plan: only the key and the requested features of the feature table
are read (column pruning reaches the scan). The join strategy is left to the
optimizer: a feature side under the broadcast threshold (a size check made
from statistics, and again at runtime by adaptive execution) becomes a
broadcast hash join with no shuffle of the base; a large feature side becomes
a sort-merge join whose skewed partitions adaptive execution splits (that
covers a hot key and a mass of null keys alike). Where skew-join splitting is
off, ``salt_null_keys`` gives null-key rows, which can never match, a spread
of salts as part of a composite join key, so they do not all land in one
shuffle partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators.keys import assert_primary_key, pk_violations

# Null base keys are spread over this many salt values (per lookup).
NULL_KEY_SALTS = 512
_SALT = "__lookup_salt"


def _as_list(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


@dataclass(frozen=True)
class FeatureLookup:
    """Which features to fetch from which table, and by which base column.

    ``table`` is a catalog table name or a DataFrame. ``primary_key`` names the
    feature table's key columns; for catalog tables it defaults to the table's
    ``primary_keys`` property, otherwise to the lookup key names.
    ``rename`` maps feature names to output names.
    """

    table: object
    feature_names: Sequence[str]
    lookup_key: str | Sequence[str]
    primary_key: str | Sequence[str] | None = None
    rename: Mapping[str, str] = field(default_factory=dict)

    def output_names(self) -> list[str]:
        return [self.rename.get(f, f) for f in self.feature_names]


def _resolve(spec: FeatureLookup, base: DataFrame) -> tuple[DataFrame, list[str], bool]:
    """Feature frame, its key columns, and whether the key is already vouched for."""
    spark = base.sparkSession
    if isinstance(spec.table, DataFrame):
        feat = spec.table
        keys = _as_list(spec.primary_key) or _as_list(spec.lookup_key)
        return feat, keys, False
    from keelson.sinks.tables import table_primary_keys  # catalog helpers

    name = str(spec.table)
    feat = spark.table(name)
    declared = table_primary_keys(spark, name)
    keys = _as_list(spec.primary_key) or declared or _as_list(spec.lookup_key)
    # A catalog feature table had its key checked when it was written.
    return feat, keys, bool(declared) and declared == keys


def _prepare(base: DataFrame, spec: FeatureLookup) -> tuple[DataFrame, list[str], list[str], list[str], bool]:
    """Validate a lookup; return (pruned feature side, lookup keys, key aliases, outputs, vouched)."""
    feat, pk, vouched = _resolve(spec, base)
    lk = _as_list(spec.lookup_key)
    if len(lk) != len(pk):
        raise ValueError(f"lookup key {lk} and primary key {pk} differ in length")
    for k in lk:
        if k not in base.columns:
            raise ValueError(f"lookup key {k!r} is not a base column")
    missing = [f for f in list(spec.feature_names) + pk if f not in feat.columns]
    if missing:
        raise ValueError(f"columns {missing} not in feature table {spec.table!r}")
    outs = spec.output_names()
    clash = [o for o in outs if o in base.columns]
    if clash:
        raise ValueError(f"feature names {clash} already exist in the base frame; rename them")
    if len(set(outs)) != len(outs):
        raise ValueError(f"duplicate feature output names {outs}")
    # Only key + requested features are read from the feature side.
    key_alias = [f"__fk{i}" for i in range(len(pk))]
    right = feat.select(*[F.col(k).alias(a) for k, a in zip(pk, key_alias)],
                        *[F.col(f).alias(o) for f, o in zip(spec.feature_names, outs)])
    return right, lk, key_alias, outs, vouched


def check_primary_keys(sides: Sequence[tuple[str, DataFrame, list[str]]]) -> None:
    """A6 for several feature tables in one job (one aggregate per table, unioned)."""
    if not sides:
        return
    if len(sides) == 1:
        name, right, keys = sides[0]
        assert_primary_key(right, keys, name=name)
        return
    flagged = [pk_violations(right, keys).select(F.lit(i).alias("spec"))
               for i, (_, right, keys) in enumerate(sides)]
    bad = reduce(DataFrame.unionByName, flagged).groupBy("spec").agg(F.count(F.lit(1))).collect()
    if bad:
        name, right, keys = sides[min(r["spec"] for r in bad)]
        assert_primary_key(right, keys, name=name)


def _join(base: DataFrame, right: DataFrame, lk: list[str], key_alias: list[str], outs: list[str],
          salt_null_keys: bool) -> DataFrame:
    cond: Column = reduce(lambda a, b: a & b,
                          [base[k] == right[a] for k, a in zip(lk, key_alias)])
    left = base
    if salt_null_keys:
        # Composite key (key..., salt): rows with a null key get salt 1..N and
        # spread over N shuffle partitions; every other row, and every feature
        # row, has salt 0. A struct keeps the optimizer from folding the
        # feature side's constant salt out of the join keys.
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in lk])
        salt = F.when(any_null, 1 + F.pmod(F.xxhash64(*[F.col(c) for c in base.columns]),
                                           F.lit(NULL_KEY_SALTS))).otherwise(F.lit(0))
        left = base.withColumn(_SALT, F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(lk)],
                                               salt.cast("int").alias("s")))
        right = right.withColumn(_SALT, F.struct(*[F.col(a).alias(f"k{i}") for i, a in enumerate(key_alias)],
                                                 F.lit(0).alias("s")))
        cond = left[_SALT] == right[_SALT]
    joined = left.join(right, cond, "left")
    return joined.select(*[left[c] for c in base.columns], *[right[o] for o in outs])


def lookup(base: DataFrame, spec: FeatureLookup, check_keys: bool = True,
           salt_null_keys: bool = False) -> DataFrame:
    """Left-join one feature table onto ``base`` by key."""
    right, lk, key_alias, outs, vouched = _prepare(base, spec)
    if check_keys and not vouched:
        check_primary_keys([(str(spec.table), right, key_alias)])
    return _join(base, right, lk, key_alias, outs, salt_null_keys)


def training_set(base: DataFrame, lookups: Sequence[FeatureLookup], label: str | None = None,
                 exclude_columns: Sequence[str] = (), check_keys: bool = True,
                 salt_null_keys: bool = False) -> DataFrame:
    """Fold the lookups over the base frame; keep the label column.

    Lookups whose features are all excluded are skipped, so an unused feature
    table costs nothing (a plain left join is not removed by the optimizer).
    """
    if label is not None and label not in base.columns:
        raise ValueError(f"label column {label!r} is not in the base frame")
    excluded = set(exclude_columns)
    out = base
    checks = []
    for spec in lookups:
        if all(o in excluded for o in spec.output_names()):
            continue
        right, lk, key_alias, outs, vouched = _prepare(out, spec)
        if check_keys and not vouched:
            checks.append((str(spec.table), right, key_alias))
        out = _join(out, right, lk, key_alias, outs, salt_null_keys)
    check_primary_keys(checks)
    keep = [c for c in out.columns if c not in excluded or c == label]
    if label is not None:
        keep = [c for c in keep if c != label] + [label]
    return out.select(*keep)
