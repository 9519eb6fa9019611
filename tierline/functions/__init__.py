"""Column-level helpers (JVM-side expressions only; no Python UDFs)."""

from tierline.functions.money import as_double, line_value, money, ratio
from tierline.functions.predicates import (DEFAULT_WATERMARK, after_keyset, after_watermark,
                                           any_null, changed)
from tierline.functions.time import (days_between, epoch_ms_text, iso_text, parse_event_ts,
                                     run_metadata, ts_text)

__all__ = ["as_double", "line_value", "money", "ratio", "DEFAULT_WATERMARK", "after_keyset",
           "after_watermark", "any_null", "changed", "days_between", "epoch_ms_text", "iso_text",
           "parse_event_ts", "run_metadata", "ts_text"]
