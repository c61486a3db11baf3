"""Column expressions (all built-in Spark functions, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_ts(seconds: str | Column, ntz: bool = True) -> Column:
    """Epoch seconds -> timestamp (H1/B1).

    ``ntz=True`` gives a wall-clock ``timestamp_ntz`` in UTC that does not
    depend on the session time zone; ``ntz=False`` gives the instant as a
    ``timestamp`` (what a watermark needs). Neither goes through a string,
    so no hour of a daylight-saving change is ambiguous.
    """
    s = _col(seconds)
    if ntz:
        return F.timestamp_add("SECOND", s, F.expr(_EPOCH))
    return F.timestamp_seconds(s)


def ts_to_epoch(ts: str | Column) -> Column:
    """``timestamp_ntz`` (UTC wall clock) -> epoch seconds, zone independent."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), _col(ts))


def ts_to_micros(ts: str | Column) -> Column:
    """``timestamp_ntz`` (UTC wall clock) -> epoch microseconds."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _col(ts))


def ntz_to_instant(ts: str | Column) -> Column:
    """``timestamp_ntz`` read as UTC wall clock -> ``timestamp`` instant
    (microseconds kept), independent of the session time zone. Watermarks
    need the instant type."""
    return F.timestamp_micros(ts_to_micros(ts))


def instant_to_ntz(ts: str | Column) -> Column:
    """``timestamp`` instant -> UTC wall-clock ``timestamp_ntz``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), F.expr(_EPOCH))


SPLIT_RANGE = 1 << 32


def split_digest(*cols: str | Column) -> Column:
    """First 8 hex digits of ``md5(concat_ws(',', keys))``."""
    key = F.concat_ws(",", *[_col(c).cast("string") for c in cols])
    return F.substring(F.md5(key), 1, 8)


def split_hash(*cols: str | Column) -> Column:
    """Deterministic hash in ``[0, 2**32)`` from the key columns.

    First 8 hex digits of ``md5(concat_ws(',', keys))`` read as an unsigned
    integer. Independent of partitioning and of the engine: DuckDB computes
    the same value with ``('0x' || substr(md5(...), 1, 8))::BIGINT``.
    """
    return F.conv(split_digest(*cols), 16, 10).cast("bigint")


def discount(rank: str | Column) -> Column:
    """DCG position discount ``1 / log2(rank + 1)`` (H2)."""
    return F.lit(1.0) / F.log2(_col(rank).cast("double") + F.lit(1.0))


def ratio_or_zero(numerator: str | Column, denominator: str | Column) -> Column:
    """``n / d`` when ``d > 0``, else ``0.0`` (D5). Guarded before dividing,
    so it is also safe under ANSI mode."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d > 0, n.cast("double") / d.cast("double")).otherwise(F.lit(0.0))


def run_stamp() -> Column:
    """Run timestamp string ``yyyyMMdd_HHmmss`` (H6); one instant per query."""
    return F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")
