"""Structured model replies: rendering observation rows as replies and parsing them back.

``render_replies`` turns listing rows into reply texts of bounded size
(``group_size`` consecutive ids per reply) in several root shapes, so the
parser sees every listing and every case the extraction step has to handle. ``parse_replies``
is the extraction side: repair the root, validate all-or-nothing, explode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import TARGET
from ..functions import json as J
from ..functions.binding import let

# Root shapes (a test-data rule, not a business rule):
# 0 object with listings, 1 the same in a ```json fence, 2 bare array, 3 one listing object,
# 4 object without listings or title, 5 bare ``` fence (not stripped → unparsable),
# 6 text that is not JSON, 7 object with listings and quoted integer rents.
# Groups of consecutive ids take the shapes below in turn, so every listing is in a reply: a group of
# shape 3 gives one reply per listing. The shapes without listings, 4 and 6, are extra replies.
# Rents are written as integers, except raw decimals when the group's number is divisible by 5.
GROUP_SHAPES = (0, 1, 2, 3, 5, 7)
EXTRA_SHAPES = {0: 6, 1: 4}  # by the group's place in the turn
REPLIES_PER_GROUP = 8


def _quote(c: Column) -> Column:
    """JSON literal of a string column (``null`` for NULL)."""
    j = F.to_json(F.array(c))
    return F.substring(j, 2, F.length(j) - 2)


def _num(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def render_replies(listings: DataFrame, group_size: int = 4) -> DataFrame:
    """(reply_id, shape, reply) with at most ``group_size`` listings per reply; no listing is left out."""
    group = F.floor(F.col("id") / group_size).cast("long")
    turn = (group % len(GROUP_SHAPES)).cast("int")
    shape = F.element_at(F.array(*[F.lit(s) for s in GROUP_SHAPES]), turn + 1)
    rid = group * REPLIES_PER_GROUP + F.when(shape == 3, F.col("id") % group_size).otherwise(0)
    rent = F.col(TARGET)
    rent_int = F.round(rent).cast("int").cast("string")
    rent_txt = (F.when(rent.isNull(), F.lit("null"))
                .when(shape == 7, F.concat(F.lit('"'), rent_int, F.lit('"')))
                .when(group % 5 == 0, rent.cast("string"))
                .otherwise(rent_int))
    pets = F.coalesce(F.lower(F.col("is_pet_friendly").cast("string")), F.lit("null"))
    item = F.concat(F.lit('{"title": '), _quote(F.col("title")),
                    F.lit(', "monthly_rent_eur": '), rent_txt,
                    F.lit(', "neighborhood": '), _quote(F.col("neighborhood")),
                    F.lit(', "rooms": '), _num(F.col("rooms")),
                    F.lit(', "is_pet_friendly": '), pets, F.lit("}"))
    grouped = (listings.select(rid.cast("long").alias("reply_id"), shape.alias("shape"), F.col("id"), item.alias("item"))
               .groupBy("reply_id", "shape")
               .agg(F.sort_array(F.collect_list(F.struct("id", "item"))).alias("_items")))
    items = F.transform("_items", lambda s: s["item"])
    arr = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    obj = F.concat(F.lit('{"listings": '), arr, F.lit("}"))
    s = F.col("shape")
    reply = (F.when(s.isin(0, 7), obj)
             .when(s == 1, F.concat(F.lit("```json\n"), obj, F.lit("\n```")))
             .when(s == 2, arr)
             .when(s == 3, F.element_at(items, 1))
             .otherwise(F.concat(F.lit("```\n"), obj, F.lit("\n```"))))
    full = grouped.select("reply_id", "shape", reply.alias("reply"))
    extra = F.element_at(F.create_map(*[F.lit(x) for kv in EXTRA_SHAPES.items() for x in kv]), turn)
    junk = (listings.select(group.alias("_g"), extra.alias("shape")).where(F.col("shape").isNotNull()).distinct()
            .withColumn("reply_id", F.col("_g") * REPLIES_PER_GROUP + F.col("shape")))
    text = F.when(F.col("shape") == 4, F.concat(F.lit('{"page": '), F.col("reply_id").cast("string"),
                                                F.lit(', "results": []}'))).otherwise(
        F.lit("No apartments were found on this page."))
    return full.unionByName(junk.select("reply_id", "shape", text.alias("reply")))


def _parsed(replies: DataFrame) -> DataFrame:
    """(reply_id, _r) with _r = struct(root_kind, n_candidates, accepted, listings)."""
    return replies.select("reply_id", J.parse_and_coerce(F.col("reply")).alias("_r"))


def _fields(cols):
    """Several fields of _r through one binding (so _r is not recomputed per field)."""
    return let(F.col("_r"), lambda r: F.struct(*[r[c].alias(c) for c in cols]))


def repair_replies(replies: DataFrame) -> DataFrame:
    """(reply_id, root_kind, n_candidates): the root shape and the repaired list size."""
    return (_parsed(replies).select("reply_id", _fields(["root_kind", "n_candidates"]).alias("_o"))
            .select("reply_id", "_o.*"))


def validate_replies(replies: DataFrame) -> DataFrame:
    """(reply_id, accepted, n_listings): one invalid listing rejects the whole reply."""
    out = let(F.col("_r"), lambda r: F.struct(
        r["accepted"].alias("accepted"),
        F.when(r["accepted"], F.size(r["listings"])).otherwise(F.lit(0)).cast("int").alias("n_listings")))
    return _parsed(replies).select("reply_id", out.alias("_o")).select("reply_id", "_o.*")


def reply_listings(replies: DataFrame, all_or_nothing: bool = True) -> DataFrame:
    """Listings of accepted replies, one row each: (reply_id, position, five typed fields).

    ``all_or_nothing=False`` keeps the valid listings of partly invalid replies instead.
    """
    if all_or_nothing:
        items = let(F.col("_r"), lambda r: F.when(r["accepted"], r["listings"]))
    else:
        items = let(F.col("_r"), lambda r: F.filter(r["listings"], J.listing_ok))
    rows = (_parsed(replies).select("reply_id", F.posexplode(items).alias("_pos", "_l"))
            .select("reply_id", (F.col("_pos") + 1).cast("int").alias("position"), "_l"))
    return rows.select("reply_id", "position", *[F.col(f"_l.{c}").alias(c) for c in J.LISTING_FIELDS])
