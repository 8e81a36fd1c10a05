"""Path mapping, schema reconciliation and quarantine of raw JSON lines."""

import itertools
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian import schemas as S
from meridian.operators.json_paths import Target, flatten_json, parse_path, targets_from_file
from meridian.plans import staging as stg
from meridian.session import scratch_dir
from meridian.sources import json_lines as jl
from tests.conftest import rows


def lines_of(spark, texts, folder="v1"):
    path = scratch_dir(spark, "t-json")
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(f"{path}/{folder}")
    return jl.read_lines(spark, f"{path}/*")


# --- paths ---------------------------------------------------------------------------

def test_parse_path():
    assert parse_path("$.a.b_2[3]['x y'][\"q\"]") == ["a", "b_2", 3, "x y", "q"]
    assert parse_path("$") == []
    for bad in ("a.b", "$.", "$.a b", "$[x]", "$.a[", "$..a"):
        with pytest.raises(ValueError):
            parse_path(bad)


def test_flatten_takes_missing_odd_and_nested_values(spark):
    lines = lines_of(spark, [
        '{"id":"1","a":{"x":"1.5","o":{"p":[1,2,{"q":true}]},"new":null},"w z":"s","extra":[1]}',
        '{"id":2,"a":{"x":"no number"}}', '{"id":"3","a":"text instead"}', '{"id":"4","a":null}', "{}"])
    t = [Target("id", "$.id"), Target("x", "$.a.x", "double"), Target("o", "$.a.o"), Target("q", "$.a.o.p[2].q", "boolean"), Target("wz", "$['w z']")]
    got = flatten_json(lines, t).withColumn("unmapped", F.to_json("unmapped"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([
        ("1", 1.5, '{"p":[1,2,{"q":true}]}', True, "s", '{"a.new":null,"extra":[1]}'),
        ("2", None, None, None, None, None), ("3", None, None, None, None, None), ("4", None, None, None, None, None),
        (None, None, None, None, None, None)], key=str)


def test_path_file_maps_by_position(spark):
    table = T.StructType([T.StructField("n", T.LongType()), T.StructField("c", T.StringType())])
    t = targets_from_file(json.dumps({"jsonpaths": ["$.deep.n", "$['c d']"]}), table)
    assert rows(flatten_json(lines_of(spark, ['{"deep":{"n":7},"c d":"x"}']), t, rest=None)) == [(7, "x")]
    with pytest.raises(ValueError):
        targets_from_file('{"jsonpaths": ["$.a"]}', table)


def test_business_has_all_its_columns_in_order():
    assert [t.column for t in stg.BUSINESS_TARGETS] == S.STG_BUSINESS.fieldNames()
    assert len(stg.BUSINESS_TARGETS) == 52
    assert {t.column: t.ddl for t in stg.BUSINESS_TARGETS}["latitude"] == "decimal(8,6)"


# --- reconciliation ------------------------------------------------------------------

TYPES = ["void", "boolean", "bigint", "decimal(38,0)", "double", "string", "array", "object"]


def test_widen_is_a_lattice_join():
    for a, b, c in itertools.product(TYPES, repeat=3):
        assert jl.widen(a, b) == jl.widen(b, a)
        assert jl.widen(jl.widen(a, b), c) == jl.widen(a, jl.widen(b, c))
    assert all(jl.widen(a, a) == a and jl.widen(a, "void") == a and jl.widen(a, "string") == "string" for a in TYPES)
    assert jl.widen("bigint", "double") == "double" and jl.widen("boolean", "bigint") == "string" and jl.widen("array", "object") == "string"


DECLARED = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("gone", T.StringType())])


def test_reconcile_keeps_every_field(spark):
    lines = lines_of(spark, ['{"id":"a","n":1,"m":1,"mix":1,"o":{"k":1},"nul":null,"big":12345678901234567890,"it\'s":1}',
                             '{"id":"b","n":"2","m":1.5,"mix":"x","big":1}', '{"id":"c","n":"three","mix":[1]}', "not json", "[1]"])
    fields = jl.reconcile(lines, DECLARED)
    assert [(f.name, f.ddl, f.origin) for f in fields] == [
        ("id", "string", "declared"), ("n", "bigint", "declared"), ("gone", "string", "declared"),
        ("big", "decimal(38,0)", "inferred"), ("it's", "bigint", "inferred"), ("m", "double", "inferred"), ("mix", "string", "conflict"),
        ("nul", "string", "inferred"), ("o", "variant", "inferred")]
    got = jl.read_reconciled(lines.filter("record IS NOT NULL AND line LIKE '{%'"), fields).withColumn("o", F.to_json("o"))
    assert [(r["id"], r["n"], r["m"], r["mix"], r["o"]) for r in got.orderBy("id").collect()] == [
        ("a", 1, 1.0, "1", '{"k":1}'), ("b", 2, 1.5, "x", None), ("c", None, None, "[1]", None)]
    drift = {(r.field, r.found): (r.n, r.lost) for r in jl.drift_report(lines, fields).collect()}
    assert drift[("n", "string")] == (2, 1) and drift[("n", "bigint")] == (1, 0)
    assert drift[("gone", "absent")] == (3, 0) and drift[("m", "absent")] == (1, 0)


def test_reconcile_of_nothing(spark):
    lines = lines_of(spark, [])
    assert [f.name for f in jl.reconcile(lines, DECLARED)] == ["id", "n", "gone"]
    assert jl.drift_report(lines, jl.reconcile(lines, DECLARED)).collect() == []


def test_too_many_fields_are_refused(spark, monkeypatch):
    monkeypatch.setattr(jl, "MAX_FIELDS", 3)
    with pytest.raises(ValueError):
        jl.reconcile(lines_of(spark, [json.dumps({f"k{i}": i for i in range(5)})]), DECLARED)


# --- quarantine ----------------------------------------------------------------------

REQUIRED = {"id": "string", "n": "double"}
LINES = ['{"id":"ok","n":1}', '{"id":"cut","n":2', '{"id":"x" "n":1}', '["id"]', '{"n":1}', '{"id":"w","n":"many"}', '{"id":null,"n":1}',
         "", "   ", '{"id":"dup","id":"dup","n":1}', '  {"id":"pad","n":3}  ', "null"]


def test_reasons(spark):
    df = spark.createDataFrame([(x,) for x in [*LINES, None]], "line string").withColumns({"vintage": F.lit("v"), "record": F.try_parse_json("line")})
    got = {r.line: r.reason for r in jl.classify(df, REQUIRED).collect()}
    assert got == {LINES[0]: None, LINES[1]: "cut_short", LINES[2]: "malformed", LINES[3]: "not_an_object", LINES[4]: "missing:id",
                   LINES[5]: "wrong_type:n", LINES[6]: "missing:id", "": "blank", "   ": "blank", LINES[9]: "malformed", LINES[10]: None,
                   "null": "not_an_object", None: "blank"}


def test_quarantine_batch_replaced_and_replayed(spark):
    path = scratch_dir(spark, "t-quarantine")
    for batch, texts in (("b1", LINES), ("b2", LINES[:2]), ("b1", LINES)):          # b1 is loaded twice
        df = spark.createDataFrame([(x,) for x in texts], "line string").withColumns({"vintage": F.lit("v"), "record": F.try_parse_json("line")})
        jl.quarantine(jl.split_lines(jl.classify(df, REQUIRED))[1], path, batch)
    kept = spark.read.parquet(path)
    assert kept.count() == 10 + 1
    assert kept.filter("kind = 'missing'").count() == 2
    good, bad = jl.replay(spark, path, lambda line, reason: F.when(reason == "cut_short", F.concat(line, F.lit("}"))).otherwise(line), REQUIRED)
    assert [r.line for r in good.collect()] == ['{"id":"cut","n":2}'] * 2
    assert bad.count() == 9


def test_lines_are_told_apart_without_a_map_of_their_fields(spark):
    lines = ["", " \t", None, '{"k": 1}', ' \t{"k": 2}\r', '{"k": "x"}', '{"k": null}', '{"j": 1}', '[{"k": 1}]', '"k"', "7", "null",
             '{"k": 1', '{"k": 1}}', '{"k": 1}\u0000', '\t{"k": 1', "{", "}", '{"k": {"k": 1}}', '{"a.b": 3, "it\'s": 4, "k": 5}']
    df = spark.createDataFrame([(x,) for x in lines], "line string").withColumn("record", jl.parsed("line")).withColumn("vintage", F.lit("v"))
    text = lambda c: [r[0] for r in df.select(F.to_json(c)).collect()]
    assert text(F.col("record")) == text(F.try_parse_json("line"))
    out = jl.classify(df, {"k": "bigint"})
    want = ["blank", "blank", "blank", None, None, "wrong_type:k", "missing:k", "missing:k", "not_an_object", "not_an_object", "not_an_object",
            "not_an_object", "cut_short", None, None, "malformed", "cut_short", "malformed", "wrong_type:k", None]
    got = {r["line"]: r["reason"] for r in out.collect()}
    assert [got[x] for x in lines] == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapType" not in plan and "map<" not in plan
    named = jl.classify(df.where(F.col("line").contains("a.b")), {"a.b": "bigint", "it's": "bigint", "k": "bigint"})
    assert named.first()["reason"] is None
