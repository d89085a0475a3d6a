"""Rows whose key the target does not hold yet."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .lookups import lookup_join


def new_keys_only(incoming: DataFrame, existing: DataFrame, keys: list[str], split_hot: bool = False) -> DataFrame:
    """Incoming rows with keys absent from `existing`. Null equals null; repeats within `incoming` stay."""
    held = existing.select(*keys).distinct()
    return lookup_join(incoming, held, keys, "left_anti", null_safe=True, split_hot=split_hot)
