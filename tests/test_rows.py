"""Rows made by Python code, and rows of differing keys."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.sources import rows

SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False), T.StructField("name", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("at", T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.StringType())])),
    T.StructField("when", T.DateType()), T.StructField("price", T.DecimalType(5, 2)), T.StructField("m", T.MapType(T.StringType(), T.LongType())),
])


def test_violations():
    good = [
        (1, "a", 1.5, ["x", None], {"x": 1}, datetime.date(2024, 1, 1), decimal.Decimal("123.45"), {"k": 1}),
        {"id": 2}, (3, None, 2, None, (1, "y"), None, None, None), (1, None, None, [], None, None, decimal.Decimal("1E+2"), {}),
    ]
    assert [rows.violation(r, SCHEMA) for r in good] == [None] * 4
    bad = {
        "row.id: missing": {"name": "x"},
        "row.id: 4294967296 is too large for int": (1 << 32, *[None] * 7),
        "row.id: bool for int": (True, *[None] * 7),
        "row.name: int for string": (1, 5, *[None] * 6),
        "row.score: str for double": {"id": 1, "score": "1.5"},
        "row.tags[1]: int for string": {"id": 1, "tags": ["a", 2]},
        "row.tags: str for array<string>": {"id": 1, "tags": "a"},
        "row.at.x: str for bigint": {"id": 1, "at": {"x": "1"}},
        "row.at: no such field z": {"id": 1, "at": {"z": 1}},
        "row.when: datetime for date": {"id": 1, "when": datetime.datetime(2024, 1, 1)},
        "row.price: 1.234 does not fit decimal(5,2)": {"id": 1, "price": decimal.Decimal("1.234")},
        "row.price: 1234 does not fit decimal(5,2)": {"id": 1, "price": decimal.Decimal("1234")},
        "row.m['k']: str for bigint": {"id": 1, "m": {"k": "v"}},
        "row: 2 values for 8 fields": (1, "a"),
        "row: int for struct<id:int,name:string,score:double,tags:array<string>,at:struct<x:bigint,y:string>,when:date,price:decimal(5,2),m:map<string,bigint>>": 5,
        "row: no such field color": {"id": 1, "color": 2},
    }
    assert {rows.violation(r, SCHEMA): r for r in bad.values()} == bad


def test_declared_rows(spark):
    def make(source):
        for k in range(source["n"]):
            yield (k, f"s{k}", float(k), ["t"], (k, None), None, decimal.Decimal(k % 100), {"k": k}) if k % 3 else {"id": None, "name": "lost"}
        if source["n"] == 4:
            yield None

    source = spark.createDataFrame([(0,), (4,), (10_000,)], "n int")
    good, rejected = rows.declared_rows(source, make, SCHEMA)
    assert [f.dataType for f in good.schema.fields] == [f.dataType for f in SCHEMA.fields]
    assert good.count() == 2 + 6_666
    row = good.where("id = 1").first()
    assert row.asDict(True) == {"id": 1, "name": "s1", "score": 1.0, "tags": ["t"], "at": {"x": 1, "y": None}, "when": None, "price": decimal.Decimal("1.00"), "m": {"k": 1}}
    found = rejected.where("source LIKE '%: 4}'").orderBy("place").collect()
    assert [(r.place, r.reason) for r in found] == [(0, "row.id: missing"), (3, "row.id: missing"), (4, "row: missing")]
    assert "lost" in found[0].value and rejected.count() == 3 + 3_334
    empty, none = rows.declared_rows(source.where("false"), make, SCHEMA)
    assert empty.count() == none.count() == 0


def test_loose_rows(spark):
    texts = ['{"a":1,"b":"x"}', '{"a":2,"c":[1,2]}', '{"b":3,"d":{"e":1}}', '{"d":{"f":"q"}}', '{"b":{"k":[1]}}', '{"g":null}', "no object", None]
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    got = rows.loose_rows(df, "j")
    assert got.schema.simpleString() == "struct<a:bigint,b:string,c:array<bigint>,d:struct<e:bigint,f:string>,g:string>"
    values = [r.asDict(True) for r in got.collect()]
    assert len(values) == len(texts)
    assert values[4]["b"] == '{"k":[1]}' and values[2] == {"a": None, "b": "3", "c": None, "d": {"e": 1, "f": None}, "g": None}
    again = rows.loose_rows(df.select(F.try_parse_json("j").alias("v")), "v")
    assert again.schema == got.schema
    with pytest.raises(ValueError):
        rows.loose_rows(spark.createDataFrame([("[1]",)], "j string"), "j")
