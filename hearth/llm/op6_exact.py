"""Exact dedup by deterministic block naming.

A text (A-Z lower-cased, null as empty) is cut into blocks of ``BLOCK_CHARS`` code points. The distinct
blocks are sorted and get integer names; then adjacent pairs of names get names of their own, round
by round, until every text is one name. Equal texts get the same name and different texts never do:
names are handed out per distinct content, not computed by a hash.

Block contents are shuffled once, reduced to distinct blocks before that shuffle, so a group of copies
sends one block per task. Rows find their block's name by the block's 64-bit hash; where two distinct
blocks of the table share that hash, these (and only these) are told apart by their full content.
Later rounds move only pairs of integers.

Defined results: of equal texts the largest doc_id stays; a null id is smaller than any other, and a
group of null ids only keeps null. Rows with the same id and text count each in ``group_size`` and
are all marked kept when that id stays. Empty texts form one group. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, free, kept_rows, written

BLOCK_CHARS = 2048
NO_NAME = -(1 << 62)  # the missing right half of a pair


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def _blocks(text: Column, size: int) -> Column:
    """The text cut into blocks of ``size`` code points (one empty block for an empty text)."""
    n = F.greatest(F.ceil(F.length(text) / F.lit(size)), F.lit(1)).cast("int")
    return F.when(n == 1, F.array(text)).otherwise(
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(text, i * size + 1, F.lit(size))))


def _name_sorted(distinct: DataFrame, *cols: str) -> DataFrame:
    """An integer name for each row of a table of distinct contents, in sorted order within each range of names."""
    return distinct.sortWithinPartitions(*cols).withColumn("name", F.monotonically_increasing_id())


def block_names(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows (doc_id, text_sha256, pos, name): the named blocks of every distinct (id, text).

    Only (name, hash) of a block is written, not its content. Blocks whose hash another one shares get names of
    their own, below zero, and are joined by content.
    """
    t = docs.select("doc_id", normalised(F.col("text")).alias("_t"))
    distinct = t.select(F.explode(_blocks(F.col("_t"), block_chars)).alias("block")).distinct()
    names = written(_name_sorted(distinct, "block").select("name", F.xxhash64("block").alias("h")), "blocks", few=True)
    shared = written(names.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "shared", few=True)
    cut = t.select("doc_id", F.sha2("_t", 256).alias("text_sha256"),
                   F.posexplode(_blocks(F.col("_t"), block_chars)).alias("pos", "block"))
    cut = cut.withColumn("h", F.xxhash64("block"))
    if shared.isEmpty():
        return cut.drop("block").join(names, "h").drop("h")
    told = distinct.withColumn("h", F.xxhash64("block")).join(shared, "h", "left_semi")
    told = written(_name_sorted(told, "h", "block").select("h", "block", (-1 - F.col("name")).alias("exact")), "told", few=True)
    # blocks whose hash two contents share carry the content along; the others only the hash
    cut = cut.join(shared.withColumn("_told", F.lit(True)), "h", "left")
    cut = cut.withColumn("block", F.when(F.col("_told"), F.col("block")))
    plain = names.join(shared, "h", "left_anti").select("h", "name")
    return (cut.join(plain, "h", "left").join(told, ["h", "block"], "left")
            .select("doc_id", "text_sha256", "pos", F.coalesce("name", "exact").alias("name")))


def name_documents(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per row: doc_id, text_sha256, level, name. (level, name) is one identity per distinct text."""
    named = written(block_names(docs, block_chars), "named")
    key = ["doc_id", "text_sha256"]
    done = named.groupBy(*key).agg(F.max("pos").alias("last"), F.count(F.when(F.col("pos") == 0, 1)).alias("rows"),
                                   F.max(F.when(F.col("pos") == 0, F.col("name"))).alias("name"))
    done = written(done, "done", few=True)
    whole = done.where("last = 0").select(*key, F.lit(0).alias("level"), "name", "rows")
    many = done.where("last > 0").select(*key, "rows", "last")
    longest = many.agg(F.max("last")).first()[0]
    if longest is None:
        free(named)
        return whole
    # texts of several blocks: one row per (text, position), repeated rows already folded into `rows`
    at = named.groupBy(*key, "pos").agg(F.max("name").alias("name"))
    at = written(at.join(many.select(F.col("doc_id").alias("d"), F.col("text_sha256").alias("t"), "last", "rows"),
                         F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_sha256") == F.col("t")))
                 .drop("d", "t"), "level", few=True)
    free(named)
    parts, level = [whole], 0
    while longest > 0:
        level += 1
        pairs = at.groupBy(*key, "last", "rows", F.floor(F.col("pos") / 2).alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NO_NAME)).alias("right"))
        pairs = written(pairs, "pairs", few=True)
        names = written(_name_sorted(pairs.select("left", "right").distinct(), "left", "right"), "names", few=True)
        at = written(pairs.join(names, ["left", "right"]).select(
            *key, F.floor(F.col("last") / 2).alias("last"), "rows", "pos", "name"), "level", few=True)
        free(pairs, names)
        longest //= 2
        parts.append(at.where("last = 0").select(*key, F.lit(level).alias("level"), "name", "rows"))
        at = at.where("last > 0")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _placed(docs: DataFrame, block_chars: int) -> DataFrame:
    """Per (doc_id, text_sha256): rows, keep_id, group_size, kept."""
    named = written(name_documents(docs, block_chars), "identity", few=True)
    # a group's size and kept id are aggregated (combined before the shuffle); the join back is split by AQE if hot
    groups = named.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"))
    return named.join(groups, ["level", "name"]).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def exact_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    out = _placed(docs, block_chars).withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", "text_sha256")


def drop_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with one row of each distinct text, of the id that ``exact_duplicates`` keeps; all columns stay.

    Rows are decided by id and text: a repeated id loses only the texts that another id keeps.
    """
    placed = _placed(docs, block_chars).withColumn("key", F.unhex("text_sha256"))
    return kept_rows(docs, placed, F.unhex(F.sha2(normalised(F.col("text")), 256)))
