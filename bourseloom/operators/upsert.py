"""Insert-ignore and upsert by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from bourseloom.operators.dedupe import keep_first, keep_latest


def new_keys(existing: DataFrame, incoming: DataFrame, key: Sequence[str],
             arrival: Sequence[str]) -> DataFrame:
    """Incoming rows, one per key (first arrival), whose key is not stored yet.

    Only key columns of ``existing`` are read, and its copies collapse before the shuffle.
    """
    batch = keep_first(incoming, key, arrival)
    return batch.join(existing.select(*key).distinct(), list(key), "left_anti")


def insert_ignore(existing: DataFrame, incoming: DataFrame, key: Sequence[str],
                  arrival: Sequence[str]) -> DataFrame:
    """Existing rows plus the new keys: the first arrival of a key wins, a replay adds nothing."""
    return existing.unionByName(new_keys(existing, incoming, key, arrival))


def upsert_latest(existing: DataFrame, incoming: DataFrame, key: Sequence[str],
                  arrival: Sequence[str]) -> DataFrame:
    """Last arrival per key replaces the whole row, nulls included."""
    return keep_latest(existing.unionByName(incoming), key, arrival)
