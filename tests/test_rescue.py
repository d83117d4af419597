"""JSON documents of any depth: what fits, and what is kept by its path."""

import json
from datetime import datetime

from conftest import rows
from pyspark.sql import types as T

from tidemark.operators.rescue import rescue_document
from tidemark.session import scratch_path
from tidemark.streaming import streams

_INNER = T.StructType().add("f", T.DoubleType()).add("g", T.StringType())
SCHEMA = (
    T.StructType()
    .add("a", T.IntegerType())
    .add("b", T.StructType().add("c", T.IntegerType()).add("e", _INNER))
    .add("t", T.TimestampType())
    .add("l", T.ArrayType(T.StructType().add("x", T.IntegerType())))
    .add("m", T.MapType(T.StringType(), T.IntegerType()))
    .add("p.q", T.BooleanType())
    .add("d", T.DecimalType(5, 2))
    .add("v", T.VariantType())
)

CASES = [
    ('{"a":1,"b":{"c":2,"d":3}}', {"a": 1, "b": {"c": 2, "e": None}}, {"b.d": 3}),
    ('{"a":"x","b":{"c":2.5,"e":{"f":1,"g":7,"h":[1,{"i":2}]}},"z":{"y":null}}',
     {"b": {"c": None, "e": {"f": 1.0, "g": "7"}}}, {"a": "x", "b.c": 2.5, "b.e.h": [1, {"i": 2}], "z": {"y": None}}),
    ('{"a":null,"b":5,"t":"2024-01-02T03:04:05","p.q":true,"r.s":1}',
     {"t": datetime(2024, 1, 2, 3, 4, 5), "p.q": True}, {"b": 5, "`r.s`": 1}),
    ('{"a":99999999999,"t":"soon","b":{"e":[1]},"p.q":"yes","d":1.5}', {"b": {"c": None, "e": None}, "d": 1.5},
     {"a": 99999999999, "t": "soon", "b.e": [1], "`p.q`": "yes"}),
    ('{"l":[{"x":1},{"x":2}],"m":{"k":1}}', {"l": [{"x": 1}, {"x": 2}], "m": {"k": 1}}, None),
    ('{"l":[{"x":1},{"x":"no","w":3},4],"m":{"k":"no","n":2}}', {"l": [{"x": 1}, {"x": None}, None], "m": {"k": None, "n": 2}},
     {"l": [{"x": 1}, {"x": "no", "w": 3}, 4], "m": {"k": "no", "n": 2}}),
    ('{"l":7,"m":[],"d":12345.678}', {}, {"l": 7, "m": [], "d": 12345.678}),
    ("{}", {}, None),
    (None, {}, None),
]
WHOLE = ["", "not json", "[1,2]", "5", "null", '{"a":1', '{"a":1,"a":2}', '{"a":1} {"a":2}', '{"a":1},{"a":2}', '{"a":1}],[2', '{"a":1}}']


def plain(value):
    if isinstance(value, T.Row):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, list):
        return [plain(v) for v in value]
    return value


def test_fields_and_what_is_left(spark):
    df = spark.createDataFrame([(n, c[0], "old") for n, c in enumerate(CASES)], "document int, body string, a string")
    found = rescue_document(df, "body", SCHEMA).drop("v")
    assert found.columns == ["document", "a", "b", "t", "l", "m", "p.q", "d", "_rescued_data"]
    for r, (_, fields, left) in zip(rows(found, "document"), CASES, strict=True):
        got = {k: plain(v) for k, v in zip(found.columns, r, strict=True)}
        expected = dict.fromkeys(SCHEMA.names) | fields
        for name in set(SCHEMA.names) - {"v"}:
            value = float(got[name]) if name == "d" and got[name] is not None else got[name]
            assert value == expected[name], (r, name)
        assert (json.loads(got["_rescued_data"]) if got["_rescued_data"] else None) == left


def test_texts_that_are_no_object_stay_whole(spark):
    found = rescue_document(spark.createDataFrame([(t,) for t in WHOLE], "_rescued_data string"), "_rescued_data", SCHEMA)
    assert sorted(r["_rescued_data"] for r in found.collect()) == sorted(WHOLE)
    assert all(r["a"] is None and r["b"] is None for r in found.collect())
    empty = rescue_document(spark.createDataFrame([], "body string"), "body", SCHEMA)
    assert empty.collect() == []


def test_no_value_is_lost(spark):
    """Fields and rescued paths together have every plain value of the document."""

    def leaves(value):
        if isinstance(value, dict):
            return sum((leaves(v) for v in value.values()), [])
        if isinstance(value, list):
            return sum((leaves(v) for v in value), [])
        return [] if value is None else [str(value)]

    for text, _, _ in CASES[:7]:
        r = rescue_document(spark.createDataFrame([(text,)], "body string"), "body", SCHEMA).drop("v").first()
        kept = leaves(plain(r)) + leaves(json.loads(r["_rescued_data"] or "{}"))
        for leaf in leaves(json.loads(text)):
            assert any(leaf.rstrip("0").rstrip(".") in k or k.startswith(leaf[:10]) for k in kept), (text, leaf)


def test_streamed_documents(spark, tmp_path):
    (tmp_path / "in").mkdir()
    texts = [c[0] for c in CASES if c[0] is not None] + WHOLE[1:]
    (tmp_path / "in" / "a.json").write_text("\n".join(texts))
    path = scratch_path(spark, "documents")
    stream = streams.document_stream(spark, str(tmp_path / "in"), SCHEMA).drop("v")
    streams.run_bounded(streams.append_sink(stream, f"{path}/rows", f"{path}/check"))
    found = spark.read.parquet(f"{path}/rows")
    batch = rescue_document(spark.createDataFrame([(t,) for t in texts], "value string"), "value", SCHEMA).drop("v")
    shown = ["_rescued_data", "a", "b", "t", "p.q"]
    pick = lambda df: sorted(repr([r[c] for c in shown]) for r in df.collect())
    assert pick(found) == pick(batch)
