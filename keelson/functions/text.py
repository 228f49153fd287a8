"""Scalar text helpers (F2-F4): path parts, timestamp text, "name: version".

Built-in expressions only, so they stay in whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def relative_path(col: Column | str, marker: str) -> Column:
    """the part after the first ``marker`` and before the next one.

    Null when the marker does not occur (splitting would have no second part).
    """
    c = _c(col)
    return F.when(F.instr(c, marker) > 0, F.split_part(c, F.lit(marker), F.lit(2)))


def format_timestamp(col: Column | str, pattern: str = TIMESTAMP_TEXT) -> Column:
    """Timestamp as text in the session time zone."""
    return F.date_format(_c(col), pattern)


def name_version(name: Column | str, version: Column | str) -> Column:
    """F2 / D3: the ``"name: version"`` text of a dataset reference."""
    return F.concat_ws(": ", _c(name), _c(version).cast("string"))
