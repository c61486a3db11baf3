"""One row per key, the one with the greatest ordering columns.

Written as an aggregate, so copies are combined map-side and no task holds a
whole group. If all other columns are of fixed width (whole numbers, dates,
timestamps, booleans) they are packed into one decimal that sorts like the
columns do: its maximum is a hash aggregate. Other types use the maximum of a
struct, which Spark sorts for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import instant_to_ntz, ts_to_micros

#: Bits of each type's whole numbers; a null is one value more, the least.
_BITS = {
    T.BooleanType: 1, T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.DateType: 32,
    T.LongType: 64, T.TimestampType: 64, T.TimestampNTZType: 64,
}
_DIGITS = 38


def _whole(name: str, kind: T.DataType) -> Column:
    """The column as a whole number that sorts like it."""
    c = F.col(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return ts_to_micros(c)
    return c.cast("int") if isinstance(kind, T.BooleanType) else c


def _back(whole: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(whole.cast("int"))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(whole.cast("bigint"))
    if isinstance(kind, T.TimestampNTZType):
        return instant_to_ntz(F.timestamp_micros(whole.cast("bigint")))
    return whole.cast("int").cast("boolean") if isinstance(kind, T.BooleanType) else whole.cast(kind)


def _range(kind: T.DataType) -> int:
    return (1 << _BITS[type(kind)]) + 1


def packable(kinds: Sequence[T.DataType]) -> bool:
    size = 1
    for kind in kinds:
        if type(kind) not in _BITS:
            return False
        size *= _range(kind)
    return size < 10**_DIGITS


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the greatest in ``order`` (all other columns, the
    deciding ones first; nulls are least). Same columns as ``df``."""
    keys, order = list(keys), list(order)
    kinds = [df.schema[c].dataType for c in order]
    if not order:
        return df.select(*keys).distinct()
    if len(order) == 1:
        return df.groupBy(*keys).agg(F.max(order[0]).alias(order[0])).select(*df.columns)
    if not packable(kinds):
        best = F.max(F.struct(*order)).alias("_best")
        out = df.groupBy(*keys).agg(best)
        return out.select(*keys, *[F.col("_best")[c].alias(c) for c in order]).select(*df.columns)
    number = f"decimal({_DIGITS},0)"
    literal = lambda n: F.lit(str(n)).cast(number)
    packed = literal(0)
    for c, kind in zip(order, kinds):
        low = 0 if isinstance(kind, T.BooleanType) else -(1 << (_BITS[type(kind)] - 1))
        place = F.coalesce(_whole(c, kind).cast(number) - literal(low - 1), literal(0))
        packed = (packed * literal(_range(kind))).cast(number) + place
    out = df.groupBy(*keys).agg(F.max(packed.cast(number)).alias("_rest"))
    columns = {}
    for c, kind in reversed(list(zip(order, kinds))):
        low = 0 if isinstance(kind, T.BooleanType) else -(1 << (_BITS[type(kind)] - 1))
        place = F.pmod(F.col("_rest"), literal(_range(kind)))
        out = out.withColumn(f"_p_{c}", place.cast(number))
        out = out.withColumn("_rest", F.floor((F.col("_rest") - F.col(f"_p_{c}")) / literal(_range(kind))).cast(number))
        whole = (F.col(f"_p_{c}") + literal(low - 1)).cast(number)
        columns[c] = F.when(F.col(f"_p_{c}") > 0, _back(whole, kind)).alias(c)
    return out.select(*[columns.get(c, F.col(c)) for c in df.columns])
