import pytest
from pyspark.sql import functions as F, types as T

from chronofold.operators.jsontext import (
    evolve_json_schema,
    flatten_json,
    flatten_variant,
    infer_json_schema,
    merged_schema,
    narrowed,
    parse_json,
    split_rejects,
)
from chronofold.operators.nested import flatten_records
from helpers import plan, rows
from test_nested import ITEMS, PARENTS, TRIPS, trips  # noqa: F401

SCHEMA = TRIPS.replace(" not null", "")


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, raw string")


def test_messages_to_rows(spark):
    df = texts(
        spark,
        '{"trip": 3, "stops": [{"place": "mill", "boxes": 2}, {"place": "inn"}, {"minutes": 8, "x": 1}]}',
        '{"stops": [], "driver": {"depot": "quay"}}',
        '{"trip": 5, "driver": {"badge": "b-9", "depot": null}, "stops": [{"minutes": 30, "boxes": 4, "place": "port"}]}',
        '{"trip": 6, "driver": null}',
    )
    assert rows(flatten_json(df, "raw", SCHEMA, "stops", PARENTS, ITEMS)) == {
        (3, None, None, "mill", 2, None): 1,
        (3, None, None, "inn", None, None): 1,
        (3, None, None, None, None, 8): 1,
        (None, None, "quay", None, None, None): 1,
        (5, "b-9", None, "port", 4, 30): 1,
        (6, None, None, None, None, None): 1,
    }


@pytest.mark.parametrize("mode", ["PERMISSIVE", "FAILFAST"])
def test_plain_and_deep_elements_and_names_with_dots(spark, mode):
    df = texts(spark, '{"w": ["x", "y"], "s": [{"p": {"n": 1, "m": 2}, "a.b": 3}]}')
    schema = "w array<string>, s array<struct<p: struct<n: int, m: int>, `a.b`: int>>"
    words = flatten_json(df, "raw", schema, "w", {}, {"word": ""}, mode=mode)
    assert rows(words) == {("x",): 1, ("y",): 1}
    deep = flatten_json(df, "raw", schema, "s", {"w": "w"}, {"n": "p.n", "ab": "`a.b`"}, mode=mode)
    assert [(r.n, r.ab) for r in deep.collect()] == [(1, 3)]


def test_round_trip(spark, trips):  # noqa: F811
    as_text = trips.select(F.to_json(F.struct("trip", "driver", "stops")).alias("raw"))
    parsed = flatten_json(as_text, "raw", SCHEMA, "stops", PARENTS, ITEMS)
    assert rows(parsed) == rows(flatten_records(trips, "stops", PARENTS, ITEMS))


@pytest.mark.parametrize(
    "raw, expected, rejected",
    [
        ('{"a": 1, "b": {"c": "x"}}', (1, "x"), False),
        ('{"a": 1}', (1, None), False),
        ('{"a": 1, "z": 9}', (1, None), False),
        ('{"A": 1}', (None, None), False),
        ('{"a": "one", "b": {"c": "x"}}', (None, "x"), True),
        ('{"a": 1.5, "b": {"c": "x"}}', (None, "x"), True),
        ('{"a": 99999999999, "b": {"c": "x"}}', (None, "x"), True),
        ('{"a": 1, "b"', (None, None), True),
        ("no json", (None, None), True),
        ("", (None, None), False),
        (None, (None, None), False),
    ],
)
def test_permissive_parsing(spark, raw, expected, rejected):
    schema = "a int, b struct<c: string>"
    df = texts(spark, raw)
    assert parse_json(df, "raw", schema).selectExpr("a", "b.c").first()[1] == expected[1]
    parsed = parse_json(df, "raw", schema, keep=["n"], corrupt="bad")
    clean, rejects = split_rejects(parsed, "bad")
    assert (clean.count(), rejects.count()) == ((0, 1) if rejected else (1, 0))
    if rejected:
        assert rejects.first()["bad"] == raw
    else:
        assert clean.selectExpr("a", "b.c").first() == expected


def test_failfast(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        parse_json(texts(spark, "no json"), "raw", "a int", mode="FAILFAST").collect()


def test_explicit_schema_must_be_a_struct(spark):
    with pytest.raises(ValueError, match="struct"):
        parse_json(texts(spark, "[1]"), "raw", "array<int>")


def test_inferred_schema(spark):
    df = texts(
        spark,
        '{"a": 1, "b": {"c d": "x", "VOID": [1, 2.5]}, "t": null}',
        '{"a": 2.5, "ok": true}',
        "no json",
    )
    schema = infer_json_schema(df, "raw")
    assert schema.simpleString() == (
        "struct<a:double,b:struct<VOID:array<double>,c d:string>,ok:boolean,t:string>"
    )
    parsed = parse_json(df, "raw", schema).collect()
    assert parsed[0].b["c d"] == "x" and parsed[0].b["VOID"] == [1.0, 2.5]
    assert parsed[1].a == 2.5 and parsed[1].ok is True


def test_inference_keeps_digits(spark):
    df = texts(spark, '{"id": 12345678901234567890, "f": 1.25}', '{"id": 7, "f": 100.5}')
    schema = infer_json_schema(df, "raw")
    assert schema["id"].dataType == T.DecimalType(20, 0) and schema["f"].dataType == T.DoubleType()
    assert [str(r.id) for r in parse_json(df, "raw", schema).collect()] == ["12345678901234567890", "7"]
    exact = infer_json_schema(df, "raw", fractions="decimal")
    assert exact["f"].dataType == T.DecimalType(5, 2)
    with pytest.raises(ValueError, match="fractions"):
        infer_json_schema(df, "raw", fractions="float")


def test_inference_skips_what_is_no_object(spark):
    df = texts(spark, "[1, 2]", '{"a": 1}', "7", "no json", None, '"text"')
    assert infer_json_schema(df, "raw").simpleString() == "struct<a:bigint>"
    with pytest.raises(ValueError, match="no JSON object"):
        infer_json_schema(texts(spark, "no json", "[1]"), "raw")


def test_only_named_fields_are_parsed(spark, trips):  # noqa: F811
    as_text = trips.select(F.to_json(F.struct("trip", "driver", "stops")).alias("raw"))
    parents, items = {"depot": "Driver.depot"}, {"place": "place", "minutes": "minutes"}
    flat = flatten_json(as_text, "raw", SCHEMA, "stops", parents, items)
    assert rows(flat) == rows(flatten_records(trips, "stops", parents, items))
    text = plan(flat)
    assert "StructField(depot," in text
    parsed = text[text.index("from_json(") : text.index("to_json") if "to_json" in text else None]
    assert "StructField(badge," not in parsed.split("PERMISSIVE")[0]
    assert "StructField(boxes," not in parsed.split("PERMISSIVE")[0]


def test_narrowed_schema():
    schema = T.DataType.fromDDL(
        "a int, b struct<c: int, d: struct<e: int, f: int>>, g array<struct<h: int, i: int>>, "
        "j map<string, struct<k: int, l: int>>, m int"
    )
    assert narrowed(schema, ["b.D.e", "g.h", "j.k", "A"]).simpleString() == (
        "struct<a:int,b:struct<d:struct<e:int>>,g:array<struct<h:int>>,"
        "j:map<string,struct<k:int,l:int>>>"
    )
    assert narrowed(schema, ["b", "b.c", "g"]).simpleString() == (
        "struct<b:struct<c:int,d:struct<e:int,f:int>>,g:array<struct<h:int,i:int>>>"
    )
    assert narrowed(schema, ["`b`.c"]).simpleString() == "struct<b:struct<c:int>>"


def test_failfast_still_checks_fields_that_are_not_used(spark):
    df = texts(spark, '{"a": 1, "b": "no number", "c": [{"d": 1}]}')
    schema = "a int, b int, c array<struct<d: int>>"
    flat = flatten_json(df, "raw", schema, "c", {"a": "a"}, {"d": "d"})
    assert rows(flat) == {(1, 1): 1}
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        flatten_json(df, "raw", schema, "c", {"a": "a"}, {"d": "d"}, mode="FAILFAST").collect()


def test_column_of_the_same_name_as_a_field(spark):
    df = spark.createDataFrame([("x", '{"raw": 1}')], "id string, raw string")
    assert rows(parse_json(df, "raw", "raw int", keep=["id"])) == {("x", 1): 1}


def test_inference_parses_each_object_once(spark):
    texts = ['{"a": 1}', ' \t\r\n{"b": {"c": "x"}}', "[1, 2]", '{"a": ', "null", "7", '"{"', "", None, '{"a": 2.5}']
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    found = infer_json_schema(df, "raw")
    assert found.simpleString() == "struct<a:double,b:struct<c:string>>"
    with pytest.raises(ValueError, match="no JSON object"):
        infer_json_schema(df.where("raw like '[%' or raw = '{\"a\": '"), "raw")


def kind(text):
    return T.DataType.fromDDL(text)


LATTICE = [
    ("bigint", "double", "double"), ("bigint", "decimal(20,0)", "decimal(20,0)"), ("decimal(5,2)", "bigint", "decimal(21,2)"),
    ("decimal(38,0)", "decimal(38,10)", "double"), ("void", "struct<a:int>", "struct<a:int>"), ("string", "bigint", "string"),
    ("boolean", "bigint", "string"), ("struct<a:bigint>", "array<bigint>", "string"), ("array<void>", "array<bigint>", "array<bigint>"),
    ("struct<a:bigint,b:void>", "struct<b:string,c:double>", "struct<a:bigint,b:string,c:double>"),
    ("array<struct<x:bigint>>", "array<struct<x:double,y:void>>", "array<struct<x:double,y:void>>"),
]


@pytest.mark.parametrize("one,other,both", LATTICE)
def test_merged_schemas(spark, one, other, both):
    one, other, both = map(kind, (one, other, both))
    assert merged_schema(one, other) == both
    assert merged_schema(one, one) == one and merged_schema(both, one) == both and merged_schema(both, other) == both
    swapped = merged_schema(other, one)
    assert merged_schema(swapped, both).simpleString() == swapped.simpleString()


def test_merging_in_any_order(spark):
    import itertools

    kinds = [kind(k) for k in ("bigint", "double", "decimal(12,2)", "void", "string", "array<bigint>", "struct<a:bigint>", "boolean")]
    for a, b, c in itertools.product(kinds, repeat=3):
        assert merged_schema(a, b) == merged_schema(b, a)
        assert merged_schema(merged_schema(a, b), c) == merged_schema(a, merged_schema(b, c))


def test_a_schema_evolves_over_batches(spark, schema):
    table = f"{schema}.feed"
    batches = [
        ['{"a": 1, "n": null}', "no json"], [], ["[1]"], ['{"a": 2.5, "b": [{"x": null}]}'], ['{"a": 1}'], ['{"b": [{"x": 3}], "n": {"m": true}}'],
        ['{"a": "text", "b": 5}'],
    ]
    found = [evolve_json_schema(spark.createDataFrame([(t,) for t in b], "raw string"), "raw", table).simpleString() for b in batches]
    assert found == [
        "struct<a:bigint,n:string>", *["struct<a:bigint,n:string>"] * 2, *["struct<a:double,n:string,b:array<struct<x:string>>>"] * 2,
        "struct<a:double,n:struct<m:boolean>,b:array<struct<x:bigint>>>", "struct<a:string,n:struct<m:boolean>,b:string>",
    ]
    changes = {r["batch"]: r["changes"] for r in spark.table(table).collect()}
    assert changes == {
        1: ["+ a: bigint", "+ n: void"],
        2: ["a: bigint -> double", "+ b: array<struct<x:void>>"],
        3: ["n: void -> struct<m:boolean>", "b[].x: void -> bigint"],
        4: ["a: double -> string", "b: array<struct<x:bigint>> -> string"],
    }
    last = T.DataType.fromDDL(found[-1])
    every = spark.createDataFrame([(t,) for b in batches for t in b], "raw string")
    parsed = parse_json(every, "raw", last)
    assert {r["a"] for r in parsed.collect()} == {"1", "2.5", "text", None}


def test_variants_of_any_shape(spark):
    texts = ['{"id": 1, "items": [{"p": "a", "q": 2}, {"p": 7}, 5, null]}', '{"id": 2, "items": []}', '{"id": "x", "items": null}', "[1]", "no json", None, '{"id": 3, "items": {"u": {"p": "o"}}}', '{"id": 4, "items": "text"}']
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    parents, items = {"id": ("$.id", "int")}, {"p": ("$.p", "string"), "q": ("$.q", "int")}
    got = rows(flatten_variant(df, "raw", "$.items", parents, items, position="n"))
    empty = {(2, None, None, None): 1, (None, None, None, None): 4, (4, None, None, None): 1}
    full = {(1, 0, "a", 2): 1, (1, 1, "7", None): 1, (1, 2, None, None): 1, (1, 3, None, None): 1, (3, 0, "o", None): 1}
    assert got == empty | full
    assert rows(flatten_variant(df, "raw", "$.items", parents, items, outer=False, position="n")) == full
