"""Upsert of interactions: latest row per key (K4).

The reference's table writer promises "create or update" but overwrites.
Here an upsert is a new snapshot (written with ``sources.sinks.write_table``):
``base UNION ALL changes``, one row per key, the row with the greatest
``order`` columns winning; a key with millions of versions is combined
map-side (see :mod:`shelfwise.operators.latest`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from shelfwise.operators.latest import best_row


def upsert(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    rest = [c for c in base.columns if c not in keys and c not in order]
    return best_row(base.unionByName(changes.select(*base.columns)), keys, [*order, *rest])
