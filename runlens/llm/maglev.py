"""Document sharding by a permutation-filled lookup table.

Every shard has a permutation of the ``size`` (a prime) slots, given by an
offset and a step from its name's hash.  Shards take turns; at its turn a
shard claims the first slot of its permutation that is still free, until no
slot is.  A shard's share is within one slot of any other's, and when a
shard joins or leaves few slots change hands.

The table has ``size`` entries whatever the data, so it is filled once on
the driver and travels as one constant array; placement is a hash, a
remainder and an array lookup in generated code: no shuffle, no join, and a
hot key costs no more than any other.

Cases: a null key is placed by the hash of the empty string; equal keys are
always placed alike; columns named like the results are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 65_537
RESULT = ("slot", "shard")


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def fill(shards: list[str], size: int = SIZE) -> list[int]:
    """Shard number of every slot."""
    if not is_prime(size):
        raise ValueError("the table's size must be prime, so that every step visits every slot")
    if not 0 < len(shards) <= size or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, at least one and at most as many as slots")
    place = [_number(f"offset:{s}") % size for s in shards]
    step = [_number(f"step:{s}") % (size - 1) + 1 for s in shards]
    table = [-1] * size
    left = size
    while left:
        for i in range(len(shards)):
            while table[place[i]] >= 0:
                place[i] = (place[i] + step[i]) % size
            table[place[i]] = i
            left -= 1
            if not left:
                break
    return table


def slot(key: Column, size: int = SIZE) -> Column:
    """Slot of a key: 60 bits of its MD5, modulo the table's size."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(df: DataFrame, key_col: str, shards: list[str], size: int = SIZE) -> DataFrame:
    """Input columns plus ``slot`` and ``shard`` (its name)."""
    names = F.split(F.lit("\n".join(shards)), "\n")
    table = F.split(F.lit(",".join(map(str, fill(shards, size)))), ",")
    df = df.drop(*RESULT).withColumn("slot", slot(F.col(key_col), size))
    return df.withColumn("shard", F.get(names, F.get(table, F.col("slot")).cast("int")))
