"""Row predicates shared by extract, quality and SCD2 operators."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(columns) -> Column:
    """``a IS NULL OR b IS NULL ...`` (never NULL itself)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    if not cols:
        return F.lit(False)
    return reduce(or_, [c.isNull() for c in cols])


def changed(target_cols, source_cols, null_safe: bool = False) -> Column:
    """Change predicate between a target and a source row.

    Default is SQL three-valued ``t.a != s.a OR ...``: a comparison with a
    NULL on either side is NULL, i.e. "not a change" once used as a join
    condition. ``null_safe=True`` counts NULL -> value and value -> NULL as
    changes (``NOT (t.a <=> s.a)``).
    """
    pairs = list(zip(target_cols, source_cols))
    if not pairs:
        return F.lit(False)
    if null_safe:
        terms = [~t.eqNullSafe(s) for t, s in pairs]
    else:
        terms = [t != s for t, s in pairs]
    return reduce(or_, terms)


def after_watermark(column: str, mark) -> Column:
    """Strict ``column > mark`` (the incremental extract predicate).

    Spark pushes this comparison into the JDBC query and into Parquet row
    group filters; the mark travels as a typed literal, never spliced text.
    """
    return F.col(column) > F.lit(mark)


def after_keyset(column: str, id_column: str, mark, last_id) -> Column:
    """Keyset predicate ``(wm > mark) OR (wm = mark AND id > last_id)``.

    Unlike the plain watermark it does not lose rows that share the mark's
    timestamp but arrived after the previous extract.
    """
    wm, ident = F.col(column), F.col(id_column)
    return (wm > F.lit(mark)) | ((wm == F.lit(mark)) & (ident > F.lit(last_id)))


def up_to_keyset(column: str, id_column: str, mark, last_id) -> Column:
    """``(wm < mark) OR (wm = mark AND id <= last_id)``: the rows that ``after_keyset`` leaves out, but those with NULLs."""
    wm, ident = F.col(column), F.col(id_column)
    return (wm < F.lit(mark)) | ((wm == F.lit(mark)) & (ident <= F.lit(last_id)))


DEFAULT_WATERMARK = dt.datetime(1900, 1, 1, tzinfo=dt.timezone.utc)
