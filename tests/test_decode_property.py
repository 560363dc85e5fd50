"""Property: the decode equals Spark's own JSON reader on random payloads."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import StructType

from tidelog.functions.decode import decode_json

KEYS = ["a", "b", "c", "A", "B", "x"]
scalars = st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6),
                    st.floats(allow_nan=False, allow_infinity=False, width=32),
                    st.text(alphabet="abcXYZ 09_-", max_size=6))
values = st.recursive(scalars, lambda inner: st.one_of(
    st.lists(inner, max_size=3), st.dictionaries(st.sampled_from(KEYS), inner, max_size=3)),
    max_leaves=5)
docs = st.dictionaries(st.sampled_from(KEYS), values, max_size=5).map(json.dumps)
damaged = st.tuples(docs, st.integers(0, 30)).map(lambda t: t[0][: t[1]])
payloads = st.one_of(docs, docs, damaged,
                     st.lists(docs, max_size=3).map(lambda xs: "[" + ",".join(xs) + "]"),
                     st.sampled_from(["", "  ", "null", "5", "[]", "not json", '"s"']))


def _key(t):
    return tuple((x is None, "" if x is None else str(x)) for x in t)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(payloads, min_size=1, max_size=40))
def test_decode_equals_reader(spark, batch):
    schema = StructType.fromDDL("a string, b string, c string")
    expected = sorted((tuple(r) for r in spark.read.schema(schema).json(
        spark.sparkContext.parallelize(batch, 1)).collect()), key=_key)
    df = spark.createDataFrame([(p,) for p in batch], "value string")
    got = sorted((tuple(r) for r in decode_json(df, schema, mode="exact").collect()), key=_key)
    assert got == expected
    # lower_all equals the reader on the lower-cased payload
    low = [p.lower() for p in batch]
    expected_low = sorted((tuple(r) for r in spark.read.schema(schema).json(
        spark.sparkContext.parallelize(low, 1)).collect()), key=_key)
    got_low = sorted((tuple(r) for r in decode_json(df, schema, mode="lower_all").collect()), key=_key)
    assert got_low == expected_low


def _lower_top_keys(p: str) -> str:
    """The payload with only its top-level keys lower-cased (last key wins)."""
    try:
        doc = json.loads(p)
    except ValueError:
        return p
    def low(d):
        if not isinstance(d, dict):
            return d
        out = {}
        for k, v in d.items():
            out.pop(k.lower(), None)
            out[k.lower()] = v
        return out
    if isinstance(doc, list):
        return json.dumps([low(d) for d in doc])
    return json.dumps(low(doc))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(docs, st.lists(docs, max_size=3).map(lambda xs: "[" + ",".join(xs) + "]")),
                min_size=1, max_size=40))
def test_keep_values_equals_reader_on_lowered_keys(spark, batch):
    schema = StructType.fromDDL("a string, b string, c string")
    lowered = [_lower_top_keys(p) for p in batch]
    expected = sorted((tuple(r) for r in spark.read.schema(schema).json(
        spark.sparkContext.parallelize(lowered, 1)).collect()), key=_key)
    df = spark.createDataFrame([(p,) for p in batch], "value string")
    got = sorted((tuple(r) for r in decode_json(df, schema, mode="keep_values").collect()), key=_key)
    assert got == expected
