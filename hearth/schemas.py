"""Schemas shared by readers, writers and validators."""

import json

from pyspark.sql import types as T

LISTING_COLUMNS = ("id", "title", "monthly_rent_eur", "neighborhood", "rooms",
                   "is_pet_friendly", "first_seen", "last_seen")

# NOT NULL (title, rent, neighborhood) is checked by the validation operators, not the schema,
# so that rows breaking it can be reported rather than failing the read.
LISTING_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("monthly_rent_eur", T.DoubleType(), True),
    T.StructField("neighborhood", T.StringType(), True),
    T.StructField("rooms", T.IntegerType(), True),
    T.StructField("is_pet_friendly", T.BooleanType(), True),
    T.StructField("first_seen", T.TimestampNTZType(), True),
    T.StructField("last_seen", T.TimestampNTZType(), True),
])

# One listing as the extraction model must return it (all fields required).
REPLY_LISTING_SCHEMA = T.StructType([
    T.StructField("title", T.StringType(), False),
    T.StructField("monthly_rent_eur", T.IntegerType(), False),
    T.StructField("neighborhood", T.StringType(), False),
    T.StructField("rooms", T.IntegerType(), False),
    T.StructField("is_pet_friendly", T.BooleanType(), False),
])

REPLY_SCHEMA = T.StructType([
    T.StructField("listings", T.ArrayType(REPLY_LISTING_SCHEMA, False), False),
])

_JSON_TYPES = {"string": "string", "integer": "integer", "long": "integer", "double": "number", "boolean": "boolean"}


def json_schema(kind: T.DataType) -> dict:
    """JSON Schema of a Spark type."""
    if isinstance(kind, T.StructType):
        return {"type": "object", "properties": {f.name: json_schema(f.dataType) for f in kind.fields},
                "required": [f.name for f in kind.fields if not f.nullable]}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": json_schema(kind.elementType)}
    return {"type": _JSON_TYPES[kind.typeName()]}


def reply_json_schema() -> str:
    """The reply's JSON Schema as text (what is handed to an extraction model)."""
    return json.dumps(json_schema(REPLY_SCHEMA))
