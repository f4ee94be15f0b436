"""Scalar column helpers.  All are built-in Spark expressions (no Python UDFs)."""

from peerscope.functions.scalar import (
    bounded_broadcast,
    exact_mean,
    growing,
    join_null_safe,
    money_cents,
    money_sum,
    round_half_even,
    safe_ratio,
    stable_hash,
    strip_ws,
    title_case,
    try_number,
)

__all__ = [
    "bounded_broadcast",
    "exact_mean",
    "growing",
    "join_null_safe",
    "money_cents",
    "money_sum",
    "round_half_even",
    "safe_ratio",
    "stable_hash",
    "strip_ws",
    "title_case",
    "try_number",
]
