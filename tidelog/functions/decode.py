"""Decode JSON log payloads under a declared schema (JVM-side, no UDF).

The result equals ``spark.read.schema(s).json(lines)`` in PERMISSIVE mode,
expressed as column functions so that it runs inside the streaming plan:

* a blank payload (JSON white space only) or an empty root array gives no row;
* a root array of objects gives one row per element;
* a root array with a null element gives one all-null row in all;
* malformed text, a truncated document, ``null`` or a scalar gives one
  all-null row (rows are never lost);
* a number decoded into a string field keeps its text; a nested object or
  array decoded into a string field keeps its raw JSON text;
* the last of duplicate keys wins; text after the first document is ignored.

Three ways of matching payload keys to the declared names:

``lower_all``  (default, parity) lower-case the whole payload, keys and values,
               and match lower-case names;
``keep_values`` match keys case-insensitively, values untouched;
``exact``      match keys exactly as declared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, MapType, StringType, StructField, StructType,
                               VariantType)

MODES = ("lower_all", "keep_values", "exact")
# Fixed value: the white space of JSON.
JSON_SPACE = " \t\r\n"


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _lower_type(t: DataType) -> DataType:
    """The same type with every struct field name lower-cased, at any depth."""
    if isinstance(t, StructType):
        return StructType([StructField(f.name.lower(), _lower_type(f.dataType), True)
                           for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(_lower_type(t.elementType), t.containsNull)
    if isinstance(t, MapType):
        return MapType(t.keyType, _lower_type(t.valueType), t.valueContainsNull)
    return t


def _lower_schema(schema: StructType) -> StructType:
    return _lower_type(schema)


def decode_json(df: DataFrame, schema: StructType, value_col: str = "value",
                mode: str = "lower_all", keep: list[str] | None = None) -> DataFrame:
    """Decode ``value_col`` (string or binary) into the fields of ``schema``.

    ``keep`` lists envelope columns to carry next to the decoded fields
    (for example ``partition`` and ``offset``); they are repeated on every
    row a root array produces.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    keep = list(keep or [])
    src = df.select(*map(_quoted, keep), _quoted(value_col).cast("string").alias("__payload"))
    if mode == "keep_values":
        return _decode_keep_case(src, schema, keep)
    parsed, schema = decode_payload(F.col("__payload"), schema, mode)
    rows = src.select(*map(_quoted, keep), F.explode(_row_list(parsed, schema)).alias("__row"))
    return rows.select(*map(_quoted, keep), *[F.col("__row").getField(f.name).alias(f.name)
                                for f in schema.fields])


def decode_payload(payload: Column, schema: StructType, mode: str) -> tuple[Column, StructType]:
    """The documents of a payload as an array (null if it does not parse), and
    the schema they have, for modes ``lower_all`` and ``exact``."""
    if mode == "lower_all":
        schema, payload = _lower_schema(schema), F.lower(payload)
    return F.from_json(payload, ArrayType(schema)), schema


def _row_list(parsed: Column, element: DataType) -> Column:
    """The rows one payload yields, as one array for ``explode``: none for a
    blank payload or an empty root array, one null row for a payload that
    does not parse or an array with a null element, else the parsed documents.

    Kept as a single expression on purpose: a separate filter on the parsed
    value would be pushed below the source's shuffle and parse every payload
    again there.
    """
    blank = F.length(F.btrim(F.col("__payload"), F.lit(JSON_SPACE))) == 0
    empty = F.array().cast(ArrayType(element))
    one_null = F.array(F.lit(None).cast(element))
    whole = F.transform(F.array(parsed), lambda p: F.when(F.exists(p, lambda x: x.isNull()), one_null).otherwise(p))
    return (F.when(F.col("__payload").isNull() | blank, empty)
            .otherwise(F.coalesce(whole[0], one_null)))


def _documents(payload: Column, value: DataType) -> Column:
    """The payload's documents, each as a map from key to ``value``; arrays
    are told from objects by the first character that is no white space."""
    one = MapType(StringType(), value)
    is_array = F.ltrim(payload, F.lit(JSON_SPACE)).startswith("[")
    return F.when(is_array, F.from_json(payload, ArrayType(one))).otherwise(F.array(F.from_json(payload, one)))


def _decode_keep_case(src: DataFrame, schema: StructType, keep: list[str]) -> DataFrame:
    """Case-insensitive key match that leaves values as sent.

    Each document is read as ``map<string,string>`` (scalars keep their text,
    nested values keep their raw JSON); for each declared field the last map
    entry whose lower-cased key equals the lower-cased field name wins. The
    keys are lower-cased once per document into a separate array, so keys
    that differ only in case never collide in a map.

    A declared type other than string needs to know whether a value was sent
    as a JSON string, which its text does not tell; only then are the
    documents read a second time, as variants.
    """
    payload = F.col("__payload")
    text = MapType(StringType(), StringType())
    typed = any(not isinstance(f.dataType, StringType) for f in schema.fields)
    rows = _row_list(_documents(payload, StringType()), text)
    if typed:
        kinds = _row_list(_documents(payload, VariantType()), MapType(StringType(), VariantType()))
        rows = F.arrays_zip(rows.alias("m"), F.transform(kinds, lambda m: F.transform(
            F.map_values(m), lambda v: F.schema_of_variant(v) == "STRING")).alias("q"))
    else:
        rows = F.transform(rows, lambda m: F.struct(m.alias("m")))
    own = (src.select(*map(_quoted, keep), F.explode(rows).alias("__row"))
           .select(*map(_quoted, keep),
                   F.reverse(F.transform(F.map_keys("__row.m"), F.lower)).alias("__k"),
                   F.reverse(F.map_values("__row.m")).alias("__v"),
                   *([F.reverse("__row.q").alias("__q")] if typed else [])))
    out = []
    for f in schema.fields:
        # first match in the reversed entries = last matching key in the document
        pos = F.array_position("__k", f.name.lower())
        at = lambda c, pos=pos: F.when(pos > 0, F.element_at(c, pos.cast("int")))
        value = at("__v")
        if not isinstance(f.dataType, StringType):
            value = _typed(value, at("__q"), f.dataType)
        out.append(value.alias(f.name))
    return own.select(*map(_quoted, keep), *out)


def _typed(text: Column, was_string: Column, kind: DataType) -> Column:
    """The text of one JSON value under the declared type, as the JSON reader
    takes it: a JSON string again as a string, anything else, whose text the
    parser gave back, as the JSON it is."""
    wrapper = StructType([StructField("v", kind)])
    string = F.to_json(F.struct(text.alias("v")))
    bare = F.concat(F.lit('{"v":'), text, F.lit("}"))
    return F.from_json(F.when(was_string, string).otherwise(bare), wrapper).getField("v")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` decoded rows, for local debugging only (L1)."""
    return df.limit(n)
