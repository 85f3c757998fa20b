"""Shard placement by a permutation-filled lookup table.

Every shard walks the slots of a table of prime size in an order of its own (an offset and a
step from a hash of its name) and the shards take turns to claim their next free slot. A key
goes to the shard that owns slot ``hash(key) mod size``: one lookup, whatever the number of
shards. Adding or removing a shard moves few other keys.

The table has ``size`` rows whatever the data, so it is broadcast; keys are hashed and looked
up with DataFrame functions only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import col, fresh

TABLE_SIZE = 65_537


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill_table(shards: Sequence[str] | Mapping[str, int], size: int = TABLE_SIZE) -> list[int]:
    """Owner (position in ``shards``) of each slot. A mapping gives a shard so many claims a turn.

    The order of ``shards`` does not matter for who owns what: turns go by name. ``size`` must be
    a prime, else a step may never reach some slots; names must differ.
    """
    names = list(shards)
    if not names or len(set(names)) < len(names):
        raise ValueError("shards need distinct names, one at least")
    if size < len(names) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be a prime not below the number of shards")
    claims = [shards[n] if isinstance(shards, Mapping) else 1 for n in names]
    if min(claims) < 1:
        raise ValueError("a shard claims one slot a turn at least")
    turns = sorted(range(len(names)), key=lambda i: names[i])
    at = [_number(n, "offset") % size for n in names]
    step = [_number(n, "step") % (size - 1) + 1 for n in names]
    owner, free = [-1] * size, size
    while True:
        for i in turns:
            for _ in range(claims[i]):
                while owner[at[i]] >= 0:
                    at[i] = (at[i] + step[i]) % size
                owner[at[i]] = i
                free -= 1
                if not free:
                    return owner


def table_frame(spark: SparkSession, owner: Sequence[int], slot: str = "slot", shard: str = "shard") -> DataFrame:
    """The lookup table as rows (slot, shard)."""
    listed = F.split(F.lit(",".join(map(str, owner))), ",")
    return spark.range(1).select(F.posexplode(listed).alias(slot, shard)).select(slot, F.col(shard).cast("int"))


def place(
    df: DataFrame,
    key: str,
    shards: Sequence[str] | Mapping[str, int],
    size: int = TABLE_SIZE,
    slot_col: str = "slot",
    shard_col: str = "shard",
) -> DataFrame:
    """``df`` with the slot and the shard of every row.

    Equal keys share a shard, a null key goes where the empty text goes, and existing columns of
    the result's names are replaced. An empty table stays empty. No row moves: there is no shuffle.
    """
    keep = [c for c in df.columns if c.lower() not in {slot_col.lower(), shard_col.lower()}]
    at, there = fresh("slot_of_key", df), fresh("slot_of_table", df)
    found = fresh("owner", df)
    hashed = F.pmod(F.xxhash64(F.coalesce(col(key).cast("string"), F.lit(""))), F.lit(size)).cast("int")
    table = table_frame(df.sparkSession, fill_table(shards, size), there, found)
    joined = df.withColumn(at, hashed).join(F.broadcast(table), F.col(at) == F.col(there))
    return joined.select(*map(col, keep), F.col(at).alias(slot_col), F.col(found).alias(shard_col))
