"""Placement of rows on shards through a permutation-filled lookup table."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots of the table: a prime, about a hundred for each of `SHARDS`, so that the shares of any
#: two shards differ by at most one slot in about a hundred.
SLOTS = 6421
SHARDS = tuple(f"shard-{k:02d}" for k in range(64))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> list[int]:
    """For each slot the position of its shard in `shards`.

    Each shard prefers the slots offset, offset + skip, offset + 2 skip, ... (modulo the prime
    number of slots, so this visits each once). Shards take turns: each claims the first slot of
    its order that is free. A shard that is added or removed moves few slots between the others.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime number and not below the number of shards")
    at = [_number(f"offset:{name}") % slots for name in shards]
    skip = [_number(f"skip:{name}") % (slots - 1) + 1 for name in shards]
    owner = [-1] * slots
    for turn in range(slots):
        k = turn % len(shards)
        while owner[at[k]] >= 0:
            at[k] = (at[k] + skip[k]) % slots
        owner[at[k]] = k
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: 60 bits of its text's MD5 modulo the slots. Null: as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % slots).cast("int")


def assign_shards(
    df: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """Every row's `key` with its slot (int) and shard (string); one row per input row.

    The table has `slots` entries, whatever the size of the input, and goes to the tasks as a
    constant of the plan: placing a row is one hash and one access, without a shuffle. Equal keys,
    repeated rows too, share a shard; null keys go where the empty text goes; an empty table gives
    an empty result. Other columns are not returned, so their names cannot clash.
    """
    names = [shards[k] for k in lookup_table(shards, slots)]
    table = F.split(F.lit("\n".join(names)), "\n")  # folded into one literal by the optimizer
    return df.select(F.col(key).alias(key), slot_of(F.col(key), slots).alias("slot")).select(
        key, "slot", F.element_at(table, F.col("slot") + 1).alias("shard")
    )
