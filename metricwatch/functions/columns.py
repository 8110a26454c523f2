"""Column expressions shared by the operators (B1, B2, B4, F13 and the hashed draws)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_account_id(c: Column | str) -> Column:
    """B1: cast to string and delete every non-digit; an id with no digits becomes NULL.

    NULL (rather than the empty string) keeps digit-less ids from matching each other in a join.
    """
    digits = F.regexp_replace(_col(c).cast("string"), r"[^0-9]", "")
    return F.nullif(digits, F.lit(""))


def to_day(c: Column | str) -> Column:
    """B2: truncate a timestamp (or date, or ISO string) to its calendar date."""
    return F.to_date(_col(c))


def cutoff_day(tz: str, now: Column | str | _dt.datetime | None = None,
               now_zone: str | None = None) -> Column:
    """B4: "yesterday" in the named time zone, as a DATE column.

    ``now`` defaults to ``current_timestamp()``. A timezone-aware ``datetime`` or a TIMESTAMP
    column is an instant and gives the same answer under every session time zone. A
    TIMESTAMP_NTZ column (or naive string) is a wall-clock reading; ``now_zone`` names the zone it
    was read in (default: the session zone).
    """
    if now is None:
        ts = F.current_timestamp()
    elif isinstance(now, _dt.datetime):
        if now.tzinfo is None:
            raise ValueError("cutoff_day needs a timezone-aware datetime")
        utc_wall = now.astimezone(_dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
        ts = F.lit(utc_wall).cast("timestamp_ntz")
        now_zone = "UTC"
    else:
        ts = _col(now)
    if now_zone is None:
        local = F.convert_timezone(None, F.lit(tz), ts)
    else:
        local = F.convert_timezone(F.lit(now_zone), F.lit(tz), ts.cast("timestamp_ntz"))
    return F.date_sub(F.to_date(local), 1)


def anscombe(c: Column | str) -> Column:
    """variance-stabilizing transform of a count, 2·sqrt(x + 3/8)."""
    return F.lit(2.0) * F.sqrt(_col(c).cast("double") + F.lit(0.375))


def unit_draw(*parts: Column | str) -> Column:
    """Deterministic draw in [0, 1) from the first 32 bits of md5 over ``parts`` joined by '|'.

    Pure SQL functions only, so every executor (and any SQL engine with md5) gets the same value
    for the same inputs; no Python, no state, no dependence on partitioning.
    """
    key = F.concat_ws("|", *[_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def unit_draw_sql(*parts: str) -> str:
    """The same draw as :func:`unit_draw`, as SQL expression text over column names/literals."""
    joined = ", ".join(f"CAST({p} AS STRING)" for p in parts)
    return f"(CAST(conv(substr(md5(concat_ws('|', {joined})), 1, 8), 16, 10) AS DOUBLE) / 4294967296.0)"


def node_hash_sql(*parts: str) -> str:
    """md5 over ``parts`` joined by '|', as SQL expression text."""
    return f"md5(concat_ws('|', {', '.join(f'CAST({p} AS STRING)' for p in parts)}))"


def hash_draw_sql(hash_col: str, at: int) -> str:
    """Draw in [0, 1) from the 8 hex digits of ``hash_col`` that begin at ``at`` (1-based)."""
    return f"(CAST(conv(substr({hash_col}, {at}, 8), 16, 10) AS DOUBLE) / 4294967296.0)"


def python_float_text(c: Column | str, decimals: int = 6) -> Column:
    """Render a double the way Python's ``str(float)`` does for the values alerts carry.

    Whole values below 1e15 print as '<int>.0'; other values print with at most ``decimals``
    decimals and no trailing zeros ('12.3', '0.0005'), which is Python's text for a value
    already rounded to that many decimals. NULL stays NULL.
    """
    x = _col(c).cast("double")
    whole = (x == F.floor(x)) & (F.abs(x) < F.lit(1e15))
    fixed = F.regexp_replace(F.format_string(f"%.{decimals}f", x), "0+$", "")
    fixed = F.when(fixed.endswith("."), F.concat(fixed, F.lit("0"))).otherwise(fixed)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(whole, F.concat(x.cast("bigint").cast("string"), F.lit(".0"))).otherwise(fixed))
