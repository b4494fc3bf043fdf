"""Column expressions for cleaning and calendar logic (all JVM-side)."""

from snapweave.functions.dates import (
    iso_week,
    iso_year,
    report_monday,
    week_from_logical_date,
    week_list,
    weeks_from_spec,
    weeks_sequence,
)
from snapweave.functions.keys import composite_key, key_complete, normalize_key, strip, zero_fill
from snapweave.functions.numeric import to_numeric, to_numeric_any

__all__ = [
    "composite_key", "iso_week", "iso_year", "key_complete", "normalize_key",
    "report_monday", "strip", "to_numeric", "to_numeric_any", "week_from_logical_date", "week_list",
    "weeks_from_spec", "weeks_sequence", "zero_fill",
]
