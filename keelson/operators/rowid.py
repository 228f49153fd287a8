"""Stable 32-hex row ids.

Source rows may be exact copies of each other (a feature set unioned with
itself), so the content alone does not identify a row. The id is
``md5(text of every column # copy ordinal)`` (see ``functions.hashing``: no two
contents share a text, and the session time zone does not matter), where the ordinal numbers the
copies of one content 1..n. It depends on nothing but the data: the same rows
get the same ids at any partition count and after any task retry.

Physical plan. With ``unique_fast_path``, a first, cheap pass counts a 64-bit
hash of each row's content (one long per distinct hash per map task is
shuffled, not the row) and keeps the hashes that occur more than once. When that set is bounded (checked, then
broadcast), rows with a hash seen once are unique contents: their ordinal is
1 and their id is computed where they are read, with no shuffle. Only rows
whose hash repeats (copies, and the rare hash collision) take the counting
path; if copies are everywhere, all rows do.

Counting path: copies are counted with a group-by on all columns, which
combines copies on the map side before the shuffle. The ordinals are then
re-created from the counts, so the output has as many rows as the input:

* a content with at most ``CHUNK`` copies expands where it lands;
* a hot content (say a third of all rows are one and the same row) is first
  cut into chunks of ``CHUNK`` ordinals, the chunks are spread over the
  cluster by a shuffle of chunk descriptors only, and each chunk expands on
  its own task.

The counts feed both branches, so they are checkpointed once to the shared
checkpoint folder (adaptive execution does not share the aggregate's shuffle
between two branches); both branches then read the checkpoint instead of
re-running the scan and the shuffle, and the lineage is cut there.

With a natural key (unique by contract) the id is the hash of the key and
nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.hashing import row_text
from keelson.session import checkpoint_root

CHUNK = 1 << 16
# Up to this many repeated content hashes, unique rows skip the counting path.
DUP_BROADCAST_MAX = 1_000_000
_HASH = "__content_hash"
_N = "__copies"
_CHUNK = "__chunk"
_ORD = "__ordinal"


def _id_expr(df: DataFrame, cols: Sequence[str], ordinal: Column) -> Column:
    return F.md5(F.concat(row_text(df, cols), F.lit("#"), ordinal.cast("string")))


def add_row_id(df: DataFrame, id_col: str = "id", key: str | Sequence[str] | None = None,
               chunk: int = CHUNK, unique_fast_path: bool = False,
               broadcast_max: int | None = None) -> DataFrame:
    """A 32-hex id per row, distinct for copies, stable across runs.

    ``unique_fast_path`` turns on the hash pre-pass: worth it when most rows
    are unique and wide (the full-row shuffle is skipped for them); when most
    rows have copies, as in a feature set unioned with itself, it only adds a
    pass, so it is off by default.
    """
    if id_col in df.columns:
        raise ValueError(f"column {id_col!r} already exists")
    if key is not None:
        keys = [key] if isinstance(key, str) else list(key)
        return df.withColumn(id_col, F.md5(row_text(df, keys)))

    cols = df.columns
    checkpoint_root(df.sparkSession)
    if not unique_fast_path:
        return _ids_by_count(df, cols, id_col, chunk)
    limit = DUP_BROADCAST_MAX if broadcast_max is None else broadcast_max
    # Which 64-bit content hashes occur more than once: a shuffle of one long
    # per distinct hash per task, not of whole rows.
    hashed = df.withColumn(_HASH, F.xxhash64(*[F.col(c) for c in cols]))
    repeated = (hashed.groupBy(_HASH).agg(F.count(F.lit(1)).alias(_N))
                .where(F.col(_N) > 1).select(_HASH).checkpoint(eager=True))
    if repeated.count() > limit:
        # Copies everywhere: every row takes the counting path.
        return _ids_by_count(df, cols, id_col, chunk)
    small = F.broadcast(repeated)  # size checked just above
    unique = (hashed.join(small, _HASH, "left_anti")
              .select(*cols, _id_expr(df, cols, F.lit(1)).alias(id_col)))
    copies = hashed.join(small, _HASH, "left_semi").drop(_HASH)
    return unique.unionByName(_ids_by_count(copies, cols, id_col, chunk))


def _ids_by_count(df: DataFrame, cols: list[str], id_col: str, chunk: int) -> DataFrame:
    """Ordinals re-created from per-content copy counts (see the module notes)."""
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(_N)).checkpoint(eager=True)

    small = counted.where(F.col(_N) <= chunk).withColumn(
        _ORD, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(_N))))

    hot = (counted.where(F.col(_N) > chunk)
           .withColumn(_CHUNK, F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                    F.floor((F.col(_N) - 1) / chunk).cast("bigint"))))
           .repartition(F.xxhash64(*cols, F.col(_CHUNK)))
           .withColumn(_ORD, F.explode(F.sequence(
               F.col(_CHUNK) * chunk + 1,
               F.least(F.col(_N), (F.col(_CHUNK) + 1) * chunk))))
           .drop(_CHUNK))

    both = small.unionByName(hot)
    return both.select(*cols, _id_expr(both, cols, F.col(_ORD)).alias(id_col))
