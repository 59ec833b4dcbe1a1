"""Mixing sources to target weights by a low-discrepancy schedule.

Every document has a size in words. Targets per source are given (or derived by ``source_targets``).
The mix is a sequence of equal slots of ``block`` words. Slot k falls on the golden-ratio point
``k * 2654435769 mod 2**32``; the cumulative target weights map the point to a source, and the slot's
rank within its source picks the next block of that source. A source's documents are put in a
shuffled order (by a hash of seed and id) and laid end to end; this line is cut into blocks of
``block`` words, and rank r takes block r modulo the number of blocks, so repeats spread evenly. A
slot beyond the cap (twice each block) is not used. ``taken`` is the number of a document's words in
the blocks taken, repeats counted.

All of it is DataFrame work. Running sums are taken in two levels (hash ranges within a source, then
the ranges' totals), so a source with a third of all rows is never one task's to sort; slots are
ranked in chunks of fixed length the same way.

Defined results: null or empty texts have size 0 and take 0 words; a null source is a source of its
own (last in order); a null id is shuffled as the text "null"; repeated rows count each; with no
words at all every target is 0. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

# --- fixed values
WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 2654435769  # odd number nearest 2**32 / golden ratio
POINTS = 1 << 32
PERIOD = 1 << 31  # k is taken modulo this, so that k * GOLDEN stays below 2**63
BLOCK = 64  # words in a slot
RANGES = 4096  # hash ranges within a source (three hex digits)
CHUNK = 1 << 10  # slots ranked together


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_sizes(docs: DataFrame, seed: int = 42) -> DataFrame:
    """(doc_id, source, size, _mix): size in words and the shuffling hash."""
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"),
                       word_count(F.col("text")).alias("size"), key.alias("_mix"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5,
                   cap: float = 2.0) -> DataFrame:
    """Per source: source, source_size, weight, target. One row per source; only source totals meet here.

    Sources in code point order, null last, take the weights in turn and share ``share`` times all
    words; a target stops at ``cap`` times its source's words and the excess goes to the others by weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (turn + 1).cast("int"))
    per = per.withColumn("weight", w.cast("long"))
    # fill in order of size per weight: a source is capped when the level of what remains would exceed its cap
    total = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("source_size").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumns({"_all": F.sum("source_size").over(total), "_before": before, "_left": left})
    rest = F.col("_all") * F.lit(float(share)) - F.col("_before") * F.lit(float(cap))
    capped = rest * F.col("weight") > F.col("source_size") * F.lit(float(cap)) * F.col("_left")
    per = per.withColumns({"_rest": rest, "_capped": capped})
    first = F.min(F.when(~F.col("_capped"), F.struct(
        (-F.col("_left")).alias("l"), F.col("_rest").alias("r")))).over(total)
    per = per.withColumn("_level", first)
    level = F.col("_level.r") * F.col("weight") / (-F.col("_level.l"))
    return per.select("source", "source_size", "weight",
                      F.when(F.col("_capped"), F.col("source_size") * F.lit(float(cap)))
                       .otherwise(level).cast("double").alias("target"))


def slot_schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """The schedule: slot, source id (``_s``), rank of the slot within its source (from 0)."""
    spark = targets.sparkSession
    per = targets.select("_s", "target", "source_size")
    line = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumns({"_cum": F.sum("target").over(line), "_sum": F.sum("target").over(whole)})
    hi = F.when(F.col("_sum") > 0, F.floor(F.col("_cum") / F.col("_sum") * F.lit(float(POINTS)))).otherwise(0)
    per = per.withColumn("_hi", hi.cast("long"))
    per = per.withColumn("_lo", F.coalesce(F.lag("_hi").over(Window.orderBy("_s")), F.lit(0).cast("long")))
    per = written(per.select("_s", "_lo", "_hi", "_sum"), "weights", few=True)
    total = per.agg(F.max("_sum")).first()[0] or 0.0
    slots = int(-(-total // block))
    point = (F.col("slot") % PERIOD) * F.lit(GOLDEN) % F.lit(POINTS)
    # the point's top 12 bits give its cell; each source meets the cells its weights touch
    cell = F.shiftright(F.col("_p"), 20)
    s = spark.range(slots).withColumnRenamed("id", "slot").withColumn("_p", point).withColumn("_cell", cell)
    cells = per.where("_hi > _lo").withColumn(
        "_cell", F.explode(F.sequence(F.shiftright("_lo", 20), F.shiftright(F.col("_hi") - 1, 20))))
    hit = (s.join(cells, "_cell").where("_p >= _lo and _p < _hi")
           .select("slot", "_s", F.floor(F.col("slot") / CHUNK).alias("_chunk")))
    hit = written(hit, "slots")
    per_chunk = hit.groupBy("_s", "_chunk").agg(F.count("*").alias("_n"))
    run = Window.partitionBy("_s").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = per_chunk.select("_s", "_chunk", F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_s", "_chunk").orderBy("slot")) - 1
    return (hit.withColumn("_i", inside).join(start, ["_s", "_chunk"])
            .select("slot", "_s", (F.col("_start") + F.col("_i")).alias("rank")))


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
                block: int = BLOCK, seed: int = 42) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken."""
    sizes = written(document_sizes(docs, seed), "sizes")
    targets = source_targets(sizes, weights, share, cap)
    targets = written(targets.withColumn("_s", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last()))), "targets", few=True)
    # each document's place on its source's line: inside its hash range, plus the ranges before
    lined = sizes.where("size > 0").join(
        targets.select("source", "_s", "source_size"),
        sizes.source.eqNullSafe(targets.source)).drop(targets.source)
    lined = lined.withColumn("_range", F.substring("_mix", 1, 3))
    by = Window.partitionBy("_s", "_range").orderBy("_mix", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    lined = lined.withColumn("_end", F.sum("size").over(by))
    ranges = lined.groupBy("_s", "_range").agg(F.sum("size").alias("_n"))
    run = Window.partitionBy("_s").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_s", "_range", F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_before"))
    lined = lined.join(ranges, ["_s", "_range"]).select(
        "doc_id", "source", "size", "_mix", "_s", (F.col("_before") + F.col("_end") - F.col("size")).alias("_from"),
        (F.col("_before") + F.col("_end")).alias("_to"))
    lined = written(lined, "line")
    # how often each block is taken
    blocks = F.ceil(F.col("source_size") / F.lit(block))
    used = (slot_schedule(targets, block).join(targets.select("_s", "source_size"), "_s")
            .where(F.col("rank") < blocks * F.lit(int(cap)))
            .groupBy("_s", (F.col("rank") % blocks).alias("_block")).agg(F.count("*").alias("_times")))
    piece = F.explode(F.sequence(F.floor(F.col("_from") / block), F.floor((F.col("_to") - 1) / block)))
    pieces = lined.select("_s", "_mix", "doc_id", "size", "_from", "_to", piece.alias("_block"))
    words = (F.least("_to", (F.col("_block") + 1) * block) - F.greatest("_from", F.col("_block") * block))
    taken = (pieces.join(used, ["_s", "_block"]).groupBy("_s", "_from")
             .agg(F.sum(words * F.col("_times")).alias("taken")))
    out = lined.join(taken, ["_s", "_from"], "left").select("_s", "doc_id", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    empty = sizes.where("size = 0").join(
        targets.select("source", "_s"), sizes.source.eqNullSafe(targets.source)).drop(targets.source)
    out = out.unionByName(empty.select("_s", "doc_id", "size", F.lit(0).cast("long").alias("taken")))
    return out.join(targets.select("_s", "source", "source_size", "target"), "_s").select(
        "doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it: ``taken`` over ``size``, rounded half up (so 0,
    1 or 2 times under the default cap); documents without words are not in the mix. Rows with the same id
    share what that id takes. All columns stay."""
    taken = mix_sources(docs, **options).groupBy(F.col("doc_id").alias("_id")).agg(
        F.sum("taken").alias("_t"), F.sum("size").alias("_n"))
    times = F.when(F.col("_n") > 0, F.floor(F.col("_t") / F.col("_n") + F.lit(0.5))).otherwise(0).cast("int")
    taken = taken.select("_id", times.alias("_times")).where("_times > 0")
    rows = docs.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*docs.columns)
