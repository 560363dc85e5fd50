"""Payload decode: equal to Spark's own JSON reader on every payload shape."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidelog.functions.decode import decode_json

SCHEMA_DDL = "a string, b string, c string"

# Payload shapes (fixed fixture values) and the rows the reader gives.
SHAPES = [
    '{"a":"X","b":"y","c":"z"}',
    '[{"a":"r1"},{"a":"r2"}]',
    '{"a":"trunc',
    '{"a":"x","b":',
    '[{"a":"x"},',
    'not json',
    'null',
    '5',
    '[1,2]',
    '{}',
    '{"a":null}',
    '',
    '   ',
    '[]',
    '{"a":"t"} trailing',
    '{"a":"q"}{"a":"w"}',
]


def _key(t):
    return tuple((x is None, "" if x is None else str(x)) for x in t)


def _reader_rows(spark, lines, schema):
    rdd = spark.sparkContext.parallelize(lines, 1)
    return sorted((tuple(r) for r in spark.read.schema(schema).json(rdd).collect()), key=_key)


def _ours(spark, lines, schema, mode):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return sorted((tuple(r) for r in decode_json(df, schema, mode=mode).collect()), key=_key)


@pytest.mark.parametrize("payload", SHAPES)
def test_shape_equals_reader(spark, payload):
    schema = StructType.fromDDL(SCHEMA_DDL)
    expected = _reader_rows(spark, [payload], schema)
    assert _ours(spark, [payload], schema, "exact") == expected


def test_all_shapes_together(spark):
    schema = StructType.fromDDL(SCHEMA_DDL)
    assert _ours(spark, SHAPES, schema, "exact") == _reader_rows(spark, SHAPES, schema)


@pytest.mark.parametrize("payload", SHAPES)
def test_keep_values_equals_reader_on_shapes(spark, payload):
    # payload keys are lower-case here, so case-insensitive matching changes nothing
    schema = StructType.fromDDL(SCHEMA_DDL)
    assert _ours(spark, [payload], schema, "keep_values") == _reader_rows(spark, [payload], schema)


def test_root_array_and_blank_rows(spark):
    schema = StructType.fromDDL(SCHEMA_DDL)
    got = _ours(spark, ['[{"a":"r1"},{"a":"r2"}]', "", "[]"], schema, "lower_all")
    assert got == [("r1", None, None), ("r2", None, None)]


def test_case_modes(spark):
    schema = StructType.fromDDL(SCHEMA_DDL)
    both = '{"A":"u","a":"l"}'
    upper_only = '{"A":"x"}'
    for mode in ("lower_all", "keep_values", "exact"):
        assert _ours(spark, [both], schema, mode) == [("l", None, None)]
    assert _ours(spark, [upper_only], schema, "exact") == [(None, None, None)]
    assert _ours(spark, [upper_only], schema, "lower_all") == [("x", None, None)]
    assert _ours(spark, [upper_only], schema, "keep_values") == [("x", None, None)]


def test_nested_and_number_text(spark):
    schema = StructType.fromDDL(SCHEMA_DDL)
    p = '{"B":{"k":[1,"X"]},"a":1.50}'
    lower = _ours(spark, [p], schema, "lower_all")
    keep = _ours(spark, [p], schema, "keep_values")
    assert lower[0][0] == "1.5" and keep[0][0] == "1.5"
    assert lower[0][1] == '{"k":[1,"x"]}'
    assert keep[0][1] == '{"k":[1,"X"]}'


def test_values_keep_case_in_keep_values(spark):
    schema = StructType.fromDDL("encMid string, userKey string")
    p = '{"ENCMID":"AbC","userkey":"XyZ"}'
    assert _ours(spark, [p], schema, "keep_values") == [("AbC", "XyZ")]
    assert _ours(spark, [p], schema, "lower_all") == [("abc", "xyz")]


def test_typed_fields_keep_values(spark):
    schema = StructType.fromDDL("n int, d double, t timestamp, s string")
    p = '{"N":7,"d":"2.5","T":"2024-01-01T00:00:00Z","s":3}'
    row = _ours(spark, [p], schema, "keep_values")[0]
    assert row[0] == 7 and row[1] is None and row[3] == "3"   # a quoted number is no number, as for the reader
    assert row[2] is not None


def test_keep_envelope_columns(spark):
    schema = StructType.fromDDL(SCHEMA_DDL)
    df = spark.createDataFrame([(3, 10, '[{"a":"1"},{"a":"2"}]')], "partition int, offset long, value string")
    got = decode_json(df, schema, keep=["partition", "offset"]).orderBy("a").collect()
    assert [(r.partition, r.offset, r.a) for r in got] == [(3, 10, "1"), (3, 10, "2")]


def test_binary_value(spark):
    schema = StructType.fromDDL(SCHEMA_DDL)
    df = spark.createDataFrame([('{"a":"b"}',)], "v string").select(F.col("v").cast("binary").alias("value"))
    assert [tuple(r) for r in decode_json(df, schema).collect()] == [("b", None, None)]


def test_bad_mode(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    with pytest.raises(ValueError):
        decode_json(df, StructType.fromDDL(SCHEMA_DDL), mode="nope")


def test_nested_declared_types_lower_all(spark):
    schema = StructType.fromDDL("Dev struct<osType: string, Tags: array<struct<Name: string>>>, n int")
    p = '{"DEV":{"OsType":"IOS","tags":[{"NAME":"A"}]},"N":3}'
    row = _ours(spark, [p], schema, "lower_all")[0]
    assert row[0]["ostype"] == "ios" and row[0]["tags"][0]["name"] == "a" and row[1] == 3


@pytest.mark.parametrize("mode", ["lower_all", "keep_values", "exact"])
def test_each_payload_is_parsed_once(spark, events, mode):
    from tidelog.sources.events_feed import EVENTS_SPEC, raw_log
    d = decode_json(raw_log(events), EVENTS_SPEC.row_schema, mode=mode)
    plan = d._jdf.queryExecution().executedPlan().toString()
    parses = plan.count("from_json(")
    assert parses == (2 if mode == "keep_values" else 1)   # keep_values: object or array form
    import re
    # no Filter operator: nothing pushed below the feed's shuffle to parse again
    assert not re.search(r"(^|[-)]\s)Filter ", plan, re.M)


@pytest.mark.parametrize("mode", ["lower_all", "keep_values", "exact"])
@pytest.mark.parametrize("payload", ["\n", " \r\n", "\t", "\n[{\"a\":\"1\"},{\"a\":\"2\"}]", " \r\n{\"a\":\"1\"}", "[{\"a\":\"1\"},null]",
                                     "[null]", "\n[]", "{\"a\":null}", "\x0b"])
def test_white_space_and_null_elements_as_the_reader(spark, mode, payload):
    schema = StructType.fromDDL("a string")
    lines = spark.sparkContext.parallelize([payload])
    expected = [tuple(r) for r in spark.read.schema(schema).json(lines).collect()]
    assert sorted(_ours(spark, [payload], schema, mode), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("doc", ['{"v":5,"w":"x"}', '{"v":"5"}', '{"v":"true","b":"true"}', '{"b":true,"d":1.5}',
                                 '{"v":"1,\\"v\\":2"}', '{"d":"2.5"}', '{"t":"2024-01-01T00:00:00Z"}', '{"l":[1,2]}',
                                 '{"l":"[1,2]"}', '{"v":null}', '{"v":3000000000}', '{"v":1.5}'])
def test_typed_fields_as_the_reader(spark, doc):
    schema = StructType.fromDDL("v int, w string, b boolean, d double, t timestamp, l array<int>")
    lines = spark.sparkContext.parallelize([doc])
    expected = [tuple(r) for r in spark.read.schema(schema).json(lines).collect()]
    assert _ours(spark, [doc], schema, "keep_values") == expected


@pytest.mark.parametrize("mode", ["lower_all", "keep_values", "exact"])
def test_odd_column_names(spark, mode):
    schema = StructType([StructField(n, StringType()) for n in ("user-id", "a b", "x.y")])
    assert _ours(spark, ['{"user-id":"1","a b":"2","x.y":"3"}'], schema, mode) == [("1", "2", "3")]
