"""Placement of rows in shards by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in an order of its own, a
walk from one slot by one step.  The shards take turns, in order of their names,
each claiming the first free slot of its order as often as its weight says, until
the table is full.  A row's slot is a hash of its key; the table, whose size is
fixed, is broadcast, so placing a row takes one lookup and no shuffle.  When a
shard goes or comes, few rows but its own move.

``write_sharded`` writes whole rows by shard: rows are dealt to tasks by ranges of shard and slot, so a task writes few shards,
and a large shard is written by several tasks.

Any key has a slot, a null key too; equal keys go to the same shard.  Repeated rows are kept.  No rows: no shards.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.scratch import shared_dir

#: A prime: every step walks through all slots.
SLOTS = 65_537


def _hash(name: str, salt: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8, salt=salt).digest(), "little")


def lookup_table(shards: dict[str, int], slots: int = SLOTS) -> np.ndarray:
    """For each slot the number of its shard, in order of names; ``shards`` gives each a weight of 1 or more."""
    names = sorted(shards)
    if not names or slots < len(names) or any(shards[n] < 1 for n in names) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("a table needs shards of weight 1 or more and a prime number of slots, no fewer than shards")
    at = [_hash(n, b"offset") % slots for n in names]
    step = [_hash(n, b"step") % (slots - 1) + 1 if slots > 2 else 1 for n in names]
    table, free = np.full(slots, -1, np.int32), slots
    while free:
        for i, name in enumerate(names):
            for _ in range(min(shards[name], free)):
                while table[at[i]] >= 0:
                    at[i] = (at[i] + step[i]) % slots
                table[at[i]] = i
                free -= 1
    return table


def placed(rows: DataFrame, key_cols: list[str], shards: dict[str, int], slots: int = SLOTS) -> DataFrame:
    """``rows`` with the slot and the shard of each; columns of these names are replaced."""
    names, spark = sorted(shards), rows.sparkSession
    table = spark.createDataFrame([(i, names[s]) for i, s in enumerate(lookup_table(shards, slots).tolist())], "i int, name string")
    slot = F.pmod(F.xxhash64(*key_cols), F.lit(slots)).cast("int")
    # the row travels as one column, so no name of its own meets the table's
    kept = [c for c in rows.columns if c not in ("slot", "shard")]
    found = rows.select(slot.alias("at"), F.struct(*kept).alias("row")).join(F.broadcast(table), F.col("at") == F.col("i"))
    return found.select("row.*", F.col("at").alias("slot"), F.col("name").alias("shard"))


def write_sharded(rows: DataFrame, key_cols: list[str], shards: dict[str, int], slots: int = SLOTS) -> DataFrame:
    """Writes whole rows to a folder for each shard, and returns them as read back from there, with their slot and shard."""
    spark = rows.sparkSession
    dealt = placed(rows, key_cols, shards, slots)
    path = f"{shared_dir(spark)}/sharded-{uuid.uuid4().hex}"
    dealt.repartitionByRange("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)
