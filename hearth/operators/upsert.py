"""Keyed merges of observation batches into a current listings table.

There is no MERGE INTO for plain parquet tables, so a merge is a set
operation: the batch is first reduced to one row per key (an aggregate
that combines map-side, so a hot key costs one row per partition), then
combined with the target by a full outer join on the key. Both join sides
hold unique keys, so no key can skew the join.

Update-on-conflict (the listing upsert): a new key is inserted with the
values of its first observation in the batch; every later observation of
a key — in the same batch or a later one — replaces only the rent and
``last_seen``. Ignore-on-conflict (the CSV seed): existing keys are kept
as they are and a new key is inserted from its first batch row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import LISTING_KEY, TARGET

TABLE_COLUMNS = ("id", "title", TARGET, "neighborhood", "rooms", "is_pet_friendly",
                 "first_seen", "last_seen")


def rollup_observations(obs: DataFrame, key: Sequence[str] = LISTING_KEY, seq: str = "id",
                        observed_at: str = "last_seen") -> DataFrame:
    """Table state after upserting ``obs`` one row at a time in ``seq`` order into an empty table.

    id, rooms, pets and first_seen come from the first observation of a key,
    rent and last_seen from the last one.
    """
    s = F.col(seq)
    return (obs.groupBy(*key).agg(
        F.min_by(F.col("id"), s).alias("id"),
        F.max_by(F.col(TARGET), s).alias(TARGET),
        F.min_by(F.col("rooms"), s).alias("rooms"),
        F.min_by(F.col("is_pet_friendly"), s).alias("is_pet_friendly"),
        F.min_by(F.col(observed_at), s).alias("first_seen"),
        F.max_by(F.col(observed_at), s).alias("last_seen"))
        .select(*TABLE_COLUMNS))


def upsert_update(target: DataFrame, batch: DataFrame, key: Sequence[str] = LISTING_KEY,
                  seq: str = "id", observed_at: str = "last_seen") -> DataFrame:
    """Merge ``batch`` into ``target``: insert new keys, update rent and last_seen of existing ones."""
    return merge_rolled(target, rollup_observations(batch, key, seq, observed_at), key)


def merge_rolled(target: DataFrame, rolled: DataFrame, key: Sequence[str] = LISTING_KEY) -> DataFrame:
    """``upsert_update`` with a batch that is reduced to one row per key already."""
    b = rolled.alias("b")
    t = target.select(*TABLE_COLUMNS).alias("t")
    cond = [F.col(f"t.{k}") == F.col(f"b.{k}") for k in key]
    j = t.join(b, cond, "full_outer")
    matched_t = F.col("t.id").isNotNull()

    def first(c):  # kept from the target when present
        return F.when(matched_t, F.col(f"t.{c}")).otherwise(F.col(f"b.{c}"))

    def latest(c):  # replaced by the batch when present
        return F.when(F.col("b.id").isNotNull(), F.col(f"b.{c}")).otherwise(F.col(f"t.{c}"))

    out = {"id": first("id"), TARGET: latest(TARGET), "rooms": first("rooms"),
           "is_pet_friendly": first("is_pet_friendly"), "first_seen": first("first_seen"),
           "last_seen": latest("last_seen")}
    for k in key:
        out[k] = F.coalesce(F.col(f"t.{k}"), F.col(f"b.{k}"))
    return j.select(*[out[c].alias(c) for c in TABLE_COLUMNS])


def first_per_key(batch: DataFrame, key: Sequence[str] = LISTING_KEY, seq: str = "id") -> DataFrame:
    cols = batch.columns
    return (batch.groupBy(*key).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(seq)).alias("_r"))
            .select("_r.*"))


def upsert_ignore(target: DataFrame, batch: DataFrame, key: Sequence[str] = LISTING_KEY,
                  seq: str = "id") -> DataFrame:
    """Insert keys not yet in ``target`` (first batch row per key); existing rows untouched."""
    new = first_per_key(batch, key, seq).join(target.select(*key), list(key), "left_anti")
    return target.unionByName(new.select(*target.columns))
