"""Joining a large table with a lookup table of unknown size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cashcycle.sources.storage import stage


def join_lookup(rows: DataFrame, lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left-join ``rows`` with a lookup that has one row per key.

    The lookup is written first, so that Spark knows its size. Up to the session's
    broadcast threshold it is broadcast and the rows stay where they are. Beyond it
    both sides are shuffled, and adaptive execution splits the partition of a hot key
    into several tasks. Random salts would spread such a key too, but a task repeated
    after a lost executor would draw other salts and could lose or double rows.
    """
    return rows.join(stage(lookup, "lookup"), list(on), "left")
