from shelfwise.functions.columns import (
    discount,
    epoch_to_ts,
    instant_to_ntz,
    ntz_to_instant,
    ratio_or_zero,
    run_stamp,
    split_digest,
    split_hash,
    ts_to_epoch,
)

__all__ = [
    "discount",
    "epoch_to_ts",
    "instant_to_ntz",
    "ntz_to_instant",
    "ratio_or_zero",
    "run_stamp",
    "split_digest",
    "split_hash",
    "ts_to_epoch",
]
