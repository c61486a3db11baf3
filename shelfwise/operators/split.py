"""Reproducible splits.

The default split is a deterministic hash of the ``(user, item)`` pair: the
same pair always lands in the same part, whatever the partitioning, the
cluster or the engine (DuckDB reproduces it), and a pair that occurs twice
cannot leak from train into test. No shuffle, no sort: a projection.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import SPLIT_RANGE, split_digest
from shelfwise.schema import ITEM, USER

PART = "part"


def thresholds(weights: Sequence[float]) -> list[int]:
    """Upper hash bounds of all parts but the last, in 2**-32 steps. A weight
    too small for a step of its own is an error, not an empty part."""
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative and not all zero")
    cuts, acc = [0], 0.0
    for w in weights:
        acc += w
        cuts.append(int(round(acc / total * SPLIT_RANGE)))
    cuts[-1] = SPLIT_RANGE
    for w, low, high in zip(weights, cuts, cuts[1:]):
        if w > 0 and high <= low:
            raise ValueError(f"weight {w} of {total} is below the split's resolution")
    return cuts[1:-1]


def assign_parts(
    df: DataFrame,
    weights: Sequence[float] = (0.8, 0.2),
    names: Sequence[str] = ("train", "test"),
    keys: Sequence[str] = (USER, ITEM),
) -> DataFrame:
    """Add a ``part`` column: the 32-bit key hash cut at the cumulative
    weights (80/20 -> the lowest 80% of the hash range is train)."""
    if len(weights) != len(names):
        raise ValueError("one name per weight")
    digest = split_digest(*keys)
    expr = F.lit(names[-1])
    for cut, name in reversed(list(zip(thresholds(weights), names[:-1]))):
        # Eight hex digits are ordered as the number they spell.
        below = digest < F.lit(f"{cut:08x}") if cut < SPLIT_RANGE else F.lit(True)
        expr = F.when(below, F.lit(name)).otherwise(expr)
    return df.withColumn(PART, expr)


def hash_split(
    df: DataFrame,
    weights: Sequence[float] = (0.8, 0.2),
    names: Sequence[str] = ("train", "test"),
    keys: Sequence[str] = (USER, ITEM),
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The parts as separate DataFrames (each a filter over the
    same projection; persist the input if it is expensive to recompute).
    ``keep`` stores the rows with their part, so that rows read several times
    are hashed once."""
    tagged = assign_parts(df, weights, names, keys)
    if keep is not None:
        tagged = keep(tagged)
    return {n: tagged.filter(F.col(PART) == n).drop(PART) for n in names}


def train_test_split(df: DataFrame, keys: Sequence[str] = (USER, ITEM),
                     keep: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """80/20 train/test."""
    return hash_split(df, (0.8, 0.2), ("train", "test"), keys, keep)


def train_val_test_split(
    df: DataFrame,
    train_ratio: float = 0.8,
    val_ratio: float = 0.1,
    keys: Sequence[str] = (USER, ITEM),
) -> dict[str, DataFrame]:
    """80/10/10 train/val/test; the remainder goes to test."""
    rest = max(0.0, 1.0 - train_ratio - val_ratio)
    return hash_split(df, (train_ratio, val_ratio, rest), ("train", "val", "test"), keys)


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """Spark's sampling split, as the reference's pipeline uses it. Parts
    depend on the input partitioning; prefer :func:`hash_split`."""
    return df.randomSplit(list(weights), seed=seed)


# -- exact sizes ---------------------------------------------------------------

#: Hexadecimal digits by which a cut is narrowed per pass: at most 16**4 counts
#: of one pass reach the driver.
DIGITS = 4
_DIGEST = 32


def exact_parts(df: DataFrame, ratios: Sequence[float] = (0.8, 0.1),
                names: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """B12 with the reference's sizes: every part but the last has exactly
    ``int(n * ratio)`` rows, the last one the rest. Adds a ``part`` column.

    Rows are in the order of the md5 of all their columns, and the cuts of that
    order are found without a sort: one pass counts rows by the digest's first
    four digits, the next ones count by the next four digits inside the buckets
    that a cut falls into, until a cut lies between two buckets or the digest is
    used up. Then each row is compared with the cuts' digests. Equal rows have
    equal digests; where a cut falls among them they are dealt by number, not by
    row: they are one row with a count on the way. Independent of partitioning;
    nulls in any column are values like others."""
    if len(names) != len(ratios) + 1 or any(r < 0 for r in ratios) or sum(ratios) > 1 + 1e-9:
        raise ValueError("one name more than ratios, which add up to at most 1")
    columns = df.columns
    if {PART, "_digest", "_n"} & set(columns):
        raise ValueError("part, _digest and _n are columns of the result")
    text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    rows = df.withColumn("_digest", F.md5(text))
    counts = _bucket_counts(rows, DIGITS, None)
    total, sizes = sum(counts.values()), []
    for r in ratios:
        sizes.append(int(total * r))
    cuts = [sum(sizes[:i + 1]) for i in range(len(sizes))]
    # per cut: (digest prefix, rows before that bucket); rows below the prefix come before the cut
    found = [_crossing(counts, 0, c) for c in cuts]
    digits = DIGITS
    while digits < _DIGEST:
        inside = {p for (p, before), c in zip(found, cuts) if p is not None and before < c}
        if not inside:
            break
        digits += DIGITS
        counts = _bucket_counts(rows, digits, inside)
        found = [(p, before) if p is None or before == c or p not in inside
                 else _crossing({k: v for k, v in counts.items() if k.startswith(p)}, before, c)
                 for (p, before), c in zip(found, cuts)]
    part = F.lit(names[-1])
    for (prefix, _), name in reversed(list(zip(found, names))):
        part = F.lit(name) if prefix is None else F.when(F.col("_digest") < prefix, name).otherwise(part)
    # digests that a cut falls into
    split = {p for (p, before), c in zip(found, cuts) if p is not None and before < c}
    plain = rows.where(~F.col("_digest").isin(list(split))) if split else rows
    out = plain.withColumn(PART, part).drop("_digest")
    for digest in split:
        out = out.unionByName(_dealt(rows.where(F.col("_digest") == digest), columns, digest, found, cuts, names))
    return out


def _bucket_counts(rows: DataFrame, digits: int, inside: set[str] | None) -> dict[str, int]:
    own = rows if inside is None else rows.where(F.substring("_digest", 1, digits - DIGITS).isin(list(inside)))
    return {r["k"]: r["count"] for r in own.groupBy(F.substring("_digest", 1, digits).alias("k")).count().collect()}


def _crossing(counts: dict[str, int], before: int, cut: int) -> tuple[str | None, int]:
    """The bucket that the cut falls into or stands in front of, and the rows
    before it; None behind the last bucket."""
    for key in sorted(counts):
        if before + counts[key] > cut:
            return key, before
        before += counts[key]
    return None, before


def _dealt(rows: DataFrame, columns: Sequence[str], digest: str, found, cuts, names) -> DataFrame:
    """Rows of one digest (equal rows, as good as always), dealt to the parts
    by number: the first of them up to the first cut, and so on."""
    distinct = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    before = next(b for p, b in found if p == digest)
    last = F.sum("_n").over(Window.orderBy(*columns)) + before  # a handful of rows
    first = last - F.col("_n")
    pieces = []
    for low, high, name in zip([0, *cuts], [*cuts, None], names):
        top = last if high is None else F.least(last, F.lit(high))
        pieces.append(F.struct(F.lit(name).alias(PART), F.greatest(top - F.greatest(first, F.lit(low)), F.lit(0)).alias("m")))
    dealt = distinct.withColumn("_p", F.array(*pieces)).withColumn("_p", F.explode("_p")).where("_p.m > 0")
    return dealt.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_p.m"))).alias("_n"),
                        F.col("_p")[PART].alias(PART)).drop("_n")
