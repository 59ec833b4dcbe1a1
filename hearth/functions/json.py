"""Model-reply parsing with the VARIANT type (no Python UDFs).

Reply text → strip → drop ```json / ``` fences → ``try_parse_json`` → root
repair → all-or-nothing validation of the five required listing fields with
lax coercion:

* strings (title, neighborhood): JSON strings only;
* integers (rent, rooms): JSON integers, integral decimals (``500.0``),
  integer strings (``"500"``) and booleans; ``500.5`` is invalid;
* booleans (pets): JSON booleans, integers 0/1 and the strings
  0/1/f/t/false/true/n/y/no/yes/off/on (any case).

A missing or NULL field invalidates its listing, and one invalid listing
rejects the whole reply.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .text import py_strip, strip_fences

# --- fixed values -----------------------------------------------------------
# Strings accepted as booleans (lax mode).
TRUE_STRINGS = ("1", "on", "t", "true", "y", "yes")
FALSE_STRINGS = ("0", "off", "f", "false", "n", "no")

_INTEGRAL_KINDS = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def kind(v: Column) -> Column:
    """Type name of a variant value: OBJECT<…>, ARRAY<…>, STRING, BIGINT, DECIMAL(p,s), BOOLEAN, VOID."""
    return F.schema_of_variant(v)


def field(x: Column, name: str) -> Column:
    return F.try_variant_get(x, f"$.{name}", "variant")


LISTING_FIELDS = ("title", "monthly_rent_eur", "neighborhood", "rooms", "is_pet_friendly")


def probe(x: Column) -> Column:
    """Per element, each field once with its type name (kinds are computed once, then reused)."""
    parts = [kind(x).alias("k")]
    for i, name in enumerate(LISTING_FIELDS):
        f = field(x, name)
        parts += [f.alias(f"v{i}"), kind(f).alias(f"k{i}")]
    return F.struct(*parts)


def _str_value(v: Column, k: Column) -> Column:
    return F.when(k == "STRING", F.try_variant_get(v, "$", "string"))


def _int_value(v: Column, k: Column) -> Column:
    dec = F.try_variant_get(v, "$", "decimal(38,18)")
    as_int = F.try_variant_get(v, "$", "bigint")
    s = F.try_variant_get(v, "$", "string")
    wide = (F.when(k.isin(*_INTEGRAL_KINDS) | (k == "BOOLEAN"), as_int)
            .when(k.startswith("DECIMAL") | k.isin("DOUBLE", "FLOAT"),
                  F.when(dec == F.floor(dec), dec.cast("bigint")))
            .when(k == "STRING", F.when(s.rlike(r"^\s*[+-]?[0-9]+(\.0+)?\s*$"), dec.cast("bigint"))))
    return F.when(wide.between(-(2 ** 31), 2 ** 31 - 1), wide.cast("int"))


def _bool_value(v: Column, k: Column) -> Column:
    s = F.lower(F.trim(F.try_variant_get(v, "$", "string")))
    i = F.try_variant_get(v, "$", "bigint")
    dec = F.try_variant_get(v, "$", "decimal(38,18)")
    return (F.when(k == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
            .when(k == "STRING", F.when(s.isin(*TRUE_STRINGS), F.lit(True))
                  .when(s.isin(*FALSE_STRINGS), F.lit(False)))
            .when(k.isin(*_INTEGRAL_KINDS), F.when(i == 1, F.lit(True)).when(i == 0, F.lit(False)))
            .when(k.startswith("DECIMAL") | k.isin("DOUBLE", "FLOAT"),
                  F.when(dec == 1, F.lit(True)).when(dec == 0, F.lit(False))))


def coerce(p: Column) -> Column:
    """Typed listing from a probe struct; ``ok`` is false when any field fails validation."""
    title = _str_value(p["v0"], p["k0"])
    rent = _int_value(p["v1"], p["k1"])
    nbh = _str_value(p["v2"], p["k2"])
    rooms = _int_value(p["v3"], p["k3"])
    pets = _bool_value(p["v4"], p["k4"])
    return F.struct(F.coalesce(p["k"].startswith("OBJECT"), F.lit(False)).alias("is_object"),
                    title.alias("title"), rent.alias("monthly_rent_eur"), nbh.alias("neighborhood"),
                    rooms.alias("rooms"), pets.alias("is_pet_friendly"))


def listing_ok(c: Column) -> Column:
    """For a coerced listing: an object with all five fields valid."""
    return (c["is_object"] & c["title"].isNotNull() & c["monthly_rent_eur"].isNotNull()
            & c["neighborhood"].isNotNull() & c["rooms"].isNotNull() & c["is_pet_friendly"].isNotNull())


def parse_reply(text: Column) -> Column:
    """Reply text → VARIANT (SQL NULL when the cleaned text is not JSON)."""
    return F.try_parse_json(strip_fences(py_strip(text)))


def root_kind(v: Column) -> Column:
    """listings | array | single | other | string | invalid (numbers, booleans, null, junk)."""
    k = kind(v)
    return (F.when(v.isNull(), F.lit("invalid"))
            .when(k.startswith("OBJECT") & field(v, "listings").isNotNull(), F.lit("listings"))
            .when(k.startswith("ARRAY"), F.lit("array"))
            .when(k.startswith("OBJECT") & field(v, "title").isNotNull(), F.lit("single"))
            .when(k.startswith("OBJECT"), F.lit("other"))
            .when(k == "STRING", F.lit("string"))
            .otherwise(F.lit("invalid")))


def candidates(v: Column, rk: Column) -> Column:
    """The repaired listing array (array<variant>); NULL when the reply is rejected here."""
    arr = F.try_variant_get(v, "$", "array<variant>")
    lst = field(v, "listings")
    has_name = F.array_contains(F.try_variant_get(v, "$", "array<string>"), "listings")
    s = F.try_variant_get(v, "$", "string")
    empty = F.array().cast("array<variant>")
    return (F.when(rk == "listings", F.try_variant_get(lst, "$", "array<variant>"))
            .when(rk == "array", F.when(~F.coalesce(has_name, F.lit(False)), arr))
            .when(rk == "single", F.array(v))
            .when(rk == "other", empty)
            .when(rk == "string", F.when(~s.contains("listings"), empty)))


def coerce_all(cands: Column) -> Column:
    """array<variant> → array of coerced listings (two passes so each field's kind is computed once)."""
    return F.transform(F.transform(cands, probe), coerce)


def parse_and_coerce(text: Column) -> Column:
    """struct(root_kind, n_candidates, accepted, listings) for a reply text, each step evaluated once."""
    def with_root(v):
        return let(F.struct(v.alias("v"), root_kind(v).alias("rk")), _with_candidates)

    def _with_candidates(r):
        return let(F.struct(r["rk"].alias("rk"), coerce_all(candidates(r["v"], r["rk"])).alias("c")), _finish)

    def _finish(x):
        ok = F.coalesce(F.forall(x["c"], listing_ok), F.lit(False))
        n = F.size(x["c"])
        return F.struct(x["rk"].alias("root_kind"),
                        F.when(n >= 0, n.cast("int")).alias("n_candidates"),
                        ok.alias("accepted"), x["c"].alias("listings"))

    return let(parse_reply(text), with_root)
