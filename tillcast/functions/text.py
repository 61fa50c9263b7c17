"""Names, URIs and JSON messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def registered_uri(name: Column, version: Column) -> Column:
    return F.concat_ws("/", F.lit("models:"), name, version.cast("string"))


def name_of(name_version: Column) -> Column:
    return F.split(name_version, ":")[0]


def version_of(name_version: Column) -> Column:
    return F.split(name_version, ":")[1].cast("int")


def json_object(**fields: Column) -> Column:
    return F.to_json(F.struct(*[value.alias(key) for key, value in fields.items()]))


_JSON_TYPES = {bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType(), str: T.StringType()}


def any_pair_matches(message: Column, wanted: dict[str, object] | None) -> Column:
    """True when the JSON object holds at least one of the wanted key/value pairs."""
    if not wanted:
        return F.lit(False)
    fields = [T.StructField(key, _JSON_TYPES[type(value)]) for key, value in wanted.items()]
    parsed = F.from_json(message, T.StructType(fields))
    matched = F.lit(False)
    for key, value in wanted.items():
        matched = matched | F.coalesce(parsed[key] == F.lit(value), F.lit(False))
    return matched
