"""Deterministic, repartition-stable row split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import SEED, TRAIN_PERCENT


def split_bucket(key: Column, seed: int = SEED) -> Column:
    """0..99 from the first 32 bits of md5(key || '|' || seed)."""
    h = F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}"))), 1, 8), 16, 10)
    return (h.cast("long") % 100).cast("int")


def is_train(key: Column, seed: int = SEED, train_percent: int = TRAIN_PERCENT) -> Column:
    return split_bucket(key, seed) < train_percent
