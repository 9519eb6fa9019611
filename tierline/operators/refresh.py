"""Full-refresh silver load (truncate + insert, as one overwrite)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.operators.quality import with_quarantine
from tierline.schemas import TableSpec


def full_refresh(batch: DataFrame, spec: TableSpec) -> DataFrame:
    """Registry projection (by name, never by position) + quarantine flag."""
    df = batch.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])
    if spec.has_quarantine:
        df = with_quarantine(df, spec.quarantine_if_null)
    return df
