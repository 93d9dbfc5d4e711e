"""Placement by a permutation-filled lookup table.

Every shard orders the slots of a prime-sized table by a permutation of its own (offset and
skip from hashes of its name).  Shards take turns; each claims the first slot of its order
that is still free.  The full table spreads slots evenly (counts differ by one at most), and
losing a shard moves few other slots.  Its size is a parameter, not the data's, so it is
broadcast and a key finds its shard by one hash and one look-up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LARGEST = 1 << 20  # slots; what is broadcast stays below some 20 MB


def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: Sequence[str], slots: int = 65537) -> list[int]:
    """Number of the shard in every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names")
    if not _prime(slots) or not len(shards) <= slots <= LARGEST:
        raise ValueError(f"slots must be a prime, at least the number of shards and at most {LARGEST}")
    seeds = [hashlib.sha256(s.encode()).digest() for s in shards]
    at = [int.from_bytes(d[:8], "big") % slots for d in seeds]
    skip = [int.from_bytes(d[8:16], "big") % (slots - 1) + 1 for d in seeds]
    table = [-1] * slots
    free = slots
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            table[at[i]] = i
            free -= 1
            if not free:
                return table


def place(docs: DataFrame, shards: Sequence[str], slots: int = 65537, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, slot, shard) for every row; equal ids have the same place, a null id too."""
    spark = docs.sparkSession
    schema = T.StructType([T.StructField("slot", T.IntegerType(), False), T.StructField("shard", T.StringType(), False)])
    table = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(fill(shards, slots))], schema)
    slot = F.pmod(F.xxhash64(id_col), F.lit(slots)).cast("int")
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), slot.alias("slot"))
    return keyed.join(F.broadcast(table), "slot").select("doc_id", "slot", "shard")


def write_shards(docs: DataFrame, path: str, shards: Sequence[str], slots: int = 65537, id_col: str = "doc_id") -> None:
    """Write every row below ``path``/shard=<name>.  Tasks write what they read; nothing is shuffled."""
    spark = docs.sparkSession
    table = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(fill(shards, slots))], "slot int, shard string")
    names = [c for c in docs.columns if c not in ("slot", "shard")]
    keyed = docs.select(*names, F.pmod(F.xxhash64(id_col), F.lit(slots)).cast("int").alias("slot"))
    keyed.join(F.broadcast(table), "slot").drop("slot").write.partitionBy("shard").parquet(path)
