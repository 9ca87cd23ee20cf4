"""Permutation-filled lookup table for placing rows on shards (native).

Every shard has a preference order over the slots of a prime-sized table: a
start and a stride, both from hashes of its name. The shards take turns; in
its turn a shard claims the first slot of its order that is still free (a
shard of weight w gets w turns a round). The table is small and fixed by its
parameters alone, never by the data, so it is broadcast; a row's slot is a
hash of its key modulo the table's size, and its shard is what stands there.

When a shard is added or lost, about 1/n of the keys move, and shares differ
by at most one slot per unit of weight while all shards are of equal weight.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_SLOTS = 65_537
MAX_SLOTS = 2_000_003


def _is_prime(n: int) -> bool:
    if n < 2:
        return False
    i = 2
    while i * i <= n:
        if n % i == 0:
            return False
        i += 1
    return True


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], slots: int = DEFAULT_SLOTS,
                 weights: Sequence[int] | None = None) -> list[int]:
    """The shard number of each slot. ``slots`` must be a prime of at most
    ``MAX_SLOTS`` and no smaller than the sum of the weights."""
    weights = [1] * len(shards) if weights is None else list(weights)
    if not shards or len(set(shards)) != len(shards) or len(weights) != len(shards):
        raise ValueError("shards must be distinct names, each with a weight")
    if any(w < 1 for w in weights):
        raise ValueError("weights must be positive")
    if not _is_prime(slots) or slots > MAX_SLOTS or slots < sum(weights):
        raise ValueError(f"slots must be a prime from the number of shards to {MAX_SLOTS}")
    place = [_number(f"start:{name}") % slots for name in shards]
    stride = [_number(f"stride:{name}") % (slots - 1) + 1 if slots > 2 else 1 for name in shards]
    table, left = [-1] * slots, slots
    while left:
        for k in range(len(shards)):
            for _ in range(weights[k]):
                if not left:
                    break
                while table[place[k]] >= 0:
                    place[k] = (place[k] + stride[k]) % slots
                table[place[k]] = k
                left -= 1
    return table


def slot_of(key: Column, slots: int) -> Column:
    """First 60 bits of the key's MD5, modulo ``slots``. A null key counts as
    the empty string."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.lit(slots).cast("long")


def assign_shards(df: DataFrame, key: Column, shards: Sequence[str], slots: int = DEFAULT_SLOTS,
                  weights: Sequence[int] | None = None) -> DataFrame:
    """``df`` with ``slot`` (long) and ``shard`` (the shard's name).

    Every row is placed (null keys like the empty string; equal keys share a
    shard; repeated rows stay). Columns named slot or shard are replaced. An
    empty table stays empty. No shuffle: the table of ``slots`` rows is
    broadcast, and its size is a parameter with an upper bound."""
    names = list(shards)
    rows = [(i, names[k]) for i, k in enumerate(lookup_table(names, slots, weights))]
    lookup = df.sparkSession.createDataFrame(rows, "slot long, shard string")
    df = df.withColumn("slot", slot_of(key, slots)).drop("shard")
    return df.join(F.broadcast(lookup), "slot", "left").select(
        *[c for c in df.columns if c.lower() != "slot"], "slot", "shard")
