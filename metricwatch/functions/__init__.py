from metricwatch.functions.columns import (
    anscombe,
    cutoff_day,
    normalize_account_id,
    python_float_text,
    to_day,
    unit_draw,
    unit_draw_sql,
)
from metricwatch.functions.plan import cut_lineage

__all__ = [
    "anscombe", "cut_lineage", "cutoff_day", "normalize_account_id",
    "python_float_text", "to_day", "unit_draw", "unit_draw_sql",
]
