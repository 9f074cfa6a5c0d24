"""Types, predicates, parameters, functions, refusals and capabilities."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tarn
from tarn.errors import TarnError, normalize_error
from tarn.functions import collections as coll
from tarn.functions import json as js
from tarn.functions.datetimes import datetime_operation
from tarn.operators import relational, textindex, textsearch
from tarn.predicates import compile_predicate, quote
from tarn.session import Session, convert_parameters
from tarn.streaming import stream
from tarn.types import bind, parse_type, type_family


def refused(feature, f, *a, **k):
    with pytest.raises(TarnError) as e:
        f(*a, **k)
    assert e.value.kind == "unsupported_feature" and e.value.feature == feature


@pytest.fixture(scope="module")
def values(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DecimalType(12, 2)), T.StructField("active", T.IntegerType())])
    return spark.createDataFrame([(1, Decimal("7.50"), 0), (2, Decimal("12.50"), 1), (3, Decimal("20.25"), 1)], schema)


def ids(df, predicate, context=None):
    return sorted(r["id"] for r in df.where(compile_predicate(predicate, df.schema, context)).collect())


@pytest.mark.parametrize(
    ("predicate", "expected"),
    [
        (("gt", "amount", Decimal(10)), [2, 3]),
        (("eq", "active", True), [2, 3]),
        (("eq", "active", False), [1]),
        (("and", [("eq", "active", True), ("gte", "amount", Decimal(15))]), [3]),
        (("not", ("in", "id", [1, 2])), [3]),
        (("eq", "id", None), []),
        (("eq", ("field", "id"), ("field", "active")), []),
        (("lte", "id", ("context", "n")), [1, 2]),
        (("neq", "id", ("literal", 2)), [1, 3]),
    ],
)
def test_predicates(values, predicate, expected):
    assert ids(values, predicate, {"n": 2}) == expected


@pytest.mark.parametrize("predicate", [("and", []), ("or", []), ("in", "id", []), ("huh", "id", 1), ("eq", 5, 1), ("eq", "id"), None, "x"])
def test_invalid_predicates(predicate):
    with pytest.raises(TarnError) as e:
        compile_predicate(predicate)
    assert e.value.kind == "invalid_predicate"


def test_values_that_are_refused():
    with pytest.raises(TarnError) as e:
        compile_predicate(("eq", "id", ("context", "missing")), None, {})
    assert e.value.kind == "missing_context"
    for bad in (("unsafe_sql", "1=1"), ("unsafe_fragment", "x"), ("other", 1)):
        with pytest.raises(TarnError) as e:
            compile_predicate(("eq", "id", bad))
        assert e.value.kind == "invalid_command"


def test_like_ignores_case_and_has_no_escape(spark):
    df = spark.createDataFrame([(1, "Main OFFICE"), (2, "a\\b"), (3, None)], "id long, title string")
    assert ids(df, ("like", "title", "%office%")) == [1]
    assert ids(df, ("like", "title", "a\\B")) == [2]
    assert ids(df, ("not_like", "title", "%office%")) == [2]


def test_types():
    assert parse_type(" DECIMAL(12, 2) ") == T.DecimalType(12, 2)
    assert parse_type("varchar(20)") == T.StringType() and parse_type("bigint") == T.LongType()
    assert [type_family(t) for t in ("int", "real", "numeric", "text", "blob", "boolean", "date", "datetime", "json", "fts5")] == ["integer", "float", "decimal", "string", "binary", "boolean", "date", "naive_datetime", "map", "text_search_document"]
    assert bind(True, T.IntegerType()) == 1 and bind(0, T.BooleanType()) is False and bind("2020-01-02", T.DateType()) == dt.date(2020, 1, 2)
    with pytest.raises(ValueError):
        parse_type("nonsense")


def test_parameters():
    text, args = convert_parameters("a = $2 AND b = $10 AND c = '$1 ?' AND d = $2 -- $3\n", list(range(1, 11)))
    assert text == "a = :p2 AND b = :p10 AND c = '$1 ?' AND d = :p2 -- $3\n" and args == {"p2": 2, "p10": 10}
    assert convert_parameters("? ?", ["a", None]) == (":p1 :p2", {"p1": "a", "p2": None})
    with pytest.raises(TarnError):
        convert_parameters("$2", [1])


def test_identifiers():
    assert quote("a.b`c") == "`a`.`b``c`"


def test_datetime(spark):
    refused("datetime_operation", datetime_operation, "format", F.col("x"), "YYYY", timezone="America/Denver")
    refused("datetime_operation", datetime_operation, "format", F.col("x"), "YYYY", epoch_storage="seconds")
    refused("datetime_operation", datetime_operation, "extract", F.col("x"), "YYYY")
    df = spark.createDataFrame([("2020-03-04 05:06:07",), ("bad",), (None,)], "x string")
    got = df.select(*(datetime_operation("format", F.col("x"), f, timezone="", epoch_storage=False).alias(f) for f in ("YYYY", "MM", "DD", "HH24", "zz"))).collect()
    assert [tuple(r) for r in got] == [("2020", "03", "04", "05", "2020-03-04 05:06:07"), (None,) * 4 + ("bad",), (None,) * 5]


@pytest.fixture(scope="module")
def docs(spark):
    rows = ['{"a":1,"b":{"c":"x"},"t":[2,"2",true,null],"n":null,"f":1.5,"y":true}', '{"a":"1","t":[],"b":{"c":"y"}}', "[1,2]", "not json", None, '"text"']
    return spark.createDataFrame(list(enumerate(rows)), "id long, body string")


def hits(df, column):
    return [r["id"] for r in df.where(column).orderBy("id").collect()]


def values_of(df, column):
    return [r[0] for r in df.orderBy("id").select(column).collect()]


def test_json(docs):
    body = F.col("body")
    assert hits(docs, js.contains(body, {"a": 1})) == [0] and hits(docs, js.contains(body, {"a": "1", "b": {"c": "y"}})) == [1]
    assert hits(docs, js.contains(body, {"y": True})) == [0] and hits(docs, js.contains(body, {"f": 1.5})) == [0]
    assert hits(docs, js.contains(body, {})) == [0, 1, 2, 3, 4, 5] and hits(docs, js.contains(body, {"n": None})) == []
    assert hits(docs, js.exists(body, "n")) == [0] and hits(docs, js.exists(body, "z")) == []
    assert hits(docs, js.array_contains(body, 2, "t")) == [0] and hits(docs, js.array_contains(body, "2", "t")) == [0] and hits(docs, js.array_contains(body, 2)) == [2]
    assert hits(docs, js.array_contains_any(body, [], "t")) == [] and len(hits(docs, js.array_contains_all(body, [], "t"))) == 6
    assert values_of(docs, js.type_of(body)) == ["object", "object", "array", None, None, "text"]
    assert values_of(docs, js.type_of(body, "y"))[0] == "true" and values_of(docs, js.type_of(body, "n"))[0] == "null"
    assert values_of(docs, js.array_length(body, "t")) == [4, 0, None, None, None, None] and values_of(docs, js.array_length(body))[0] == 0
    assert values_of(docs, js.extract(body, "t[0]", "integer"))[0] == 2
    assert js.render_path("$") == "$" and js.render_path("$.a.b[0]") == "$.a.b[0]"
    for bad in ("a-b", ["x y"], [-1]):
        with pytest.raises(ValueError):
            js.render_path(bad)
    with pytest.raises(ValueError):
        js.contains(body, {"a": [1]})
    with pytest.raises(ValueError):
        js.extract(body, "a", "uuid")
    refused("json_contains", js.contains, body, [1])
    for name in ("json_extract_path", "json_extract_path_text", "json_set"):
        refused("json_operation", js.json_operation, name, body)


def test_collections(spark):
    df = spark.createDataFrame([(1, "b"), (1, None), (1, "a"), (1, "a"), (2, None)], "k long, v string")
    got = {r["k"]: tuple(r)[1:] for r in df.groupBy("k").agg(coll.json_array(F.col("v")), coll.json_array(F.col("v"), True), coll.joined_text(F.col("v"))).collect()}
    assert got == {1: ('[null,"a","a","b"]', '[null,"a","b"]', "a,a,b"), 2: ("[null]", "[null]", None)}
    refused("collection_operation", coll.collection_operation, "array_agg", F.col("v"), order_by=["v"])
    refused("collection_operation", coll.collection_operation, "string_agg", F.col("v"), distinct=True)
    refused("collection_operation", coll.collection_operation, "median", F.col("v"))


def test_text_search(spark):
    rows = [(1, "The quick brown fox", "x"), (2, "quick the fox, BROWN!", "quick"), (3, "nothing here", "foxes"), (4, None, None)]
    df = spark.createDataFrame(rows, "id long, title string, body string")
    find = lambda q, mode=None, f="title": hits(df, textsearch.match(f, q, mode))
    assert find("quick fox") == [1, 2] and find('"quick brown"') == [1] and find("quick brown", "phrase") == [1]
    assert find("fox NOT the") == [] and find("nothing OR brown") == [1, 2, 3] and find("noth*") == [3]
    assert find("(nothing OR fox) AND the") == [1, 2] and find("fo*", None, ["title", "body"]) == [1, 2, 3]
    domain = tarn.Domain("t", {"title": "fts5", "body": "text", "tag": "text"}, text_search=frozenset({"tag"}), joined=frozenset({"tag"}))
    assert textsearch.match("title", "fox", None, domain) is not None
    refused("text_search", textsearch.match, "body", "fox", None, domain)
    refused("text_search", textsearch.match, [], "fox")
    refused("text_search", textsearch.match, "title", "fox", "fuzzy")
    refused("text_search", textsearch.match, "title", " !! ")
    refused("text_search", textsearch.bm25, df, "id", ["title"], "fox", ["heavy"])
    refused("text_search", textsearch.bm25, df, "id", ["tag"], "fox", None, None, domain)
    ranked = textsearch.bm25(df, "id", ["title", "body"], "nothing", {"title": 2.0, "body": 1.0}).collect()
    assert [r["id"] for r in ranked] == [3] and ranked[0]["rank"] < 0
    assert textsearch.phrase('"a b"') == '"a b"' and textsearch.phrase('a "b"') == '"a ""b"""'


def test_a_stored_index_finds_what_a_scan_finds(spark, tmp_path):
    rows = [(1, "The quick brown fox, the fox", "x"), (2, "quick the fox, BROWN!", "quick"), (3, "nothing here", "foxes"), (4, None, None), (5, "", "the the fox"), (6, "fox of of the", None)]
    df = spark.createDataFrame(rows, "id long, title string, body string")
    index = textindex.TextIndex(spark, f"file://{tmp_path}/index").build(df, "id", ["title", "body"])
    for query, mode in [("quick fox", None), ('"quick brown"', None), ("of of the", "phrase"), ("the the", "phrase"), ("of of of", "phrase"), ("fox NOT the", "boolean"), ("nothing OR brown", None), ("fo* NOT quick", None), ("(nothing OR fox) AND the", None), ("absent", None), ('"absent fox" OR here', None)]:
        assert sorted(r["key"] for r in index.search(query, mode).collect()) == hits(df, textsearch.match(["title", "body"], query, mode)), query
        weights = {"title": 2.0, "body": 0.5}
        scan = {r["id"]: round(r["rank"], 9) for r in textsearch.bm25(df, "id", ["title", "body"], query, weights, mode).collect()}
        assert {r["key"]: round(r["rank"], 9) for r in index.bm25(query, weights, mode).collect()} == scan, query
    refused("text_search", index.search, "fox", "fuzzy")
    refused("text_search", index.bm25, "fox", {"title": "heavy"})
    plan = index.search("fox")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,fox)" in plan and "title" not in plan


def test_joins_that_are_refused(spark):
    df = spark.range(1)
    for how in ("right", "full", "lateral"):
        refused("join", relational.join, df, df, "id", how)
    refused("stream", stream)
    refused("rollup", Session(spark).query(df).rollup, "id")


def test_capabilities(spark):
    assert tarn.supports("cte") and tarn.supports("json_rowset") and not tarn.supports("rollup") and not tarn.supports("anything")
    assert tarn.capability("text_search")["default_mode"] == "websearch" and tarn.capability("stream") == {"feature": "stream", "supported": False}
    live, dead = tarn.write_capabilities(Session(spark)), tarn.write_capabilities(None)
    assert live["protocol_version"] == 1 and live["write_graph"] and live["generated_keys"] == "returning" and not live["merge"] and live["server_version"]
    assert dead["server_version"] is None and not dead["write_graph"] and dead["generated_keys"] is False


def test_sessions(spark):
    s = tarn.connect(spark, {"database": "/root/testdata/sf0.001", "foreign_keys": "off", "busy_timeout": 5, "cache_size": 3})
    assert not s.foreign_keys and tarn.connect(spark, s) is s and tarn.connect(spark).database is None
    for options, kind in ((7, "invalid_connection_options"), ({"busy_timeout": -1}, "invalid_busy_timeout"), ({"busy_timeout": "x"}, "invalid_busy_timeout")):
        with pytest.raises(TarnError) as e:
            tarn.connect(spark, options)
        assert e.value.kind == kind
    r = s.execute("SELECT r_regionkey AS k FROM {region} WHERE r_regionkey < ? ORDER BY 1", [2])
    assert r.columns == ["k"] and r.rows == [[0], [1]] and r.maps() == [{"k": 0}, {"k": 1}]
    with pytest.raises(TarnError) as e:
        s.execute("SELECT nonsense FROM {region}")
    assert e.value.kind == "execution_failed" and e.value.details["condition"]
    assert "Scan parquet" in s.explain(s.table("region"))
    tarn.disconnect(s)
    tarn.disconnect(None)


def test_time_limit(spark):
    slow = spark.range(0, 10**13, 1, 4).selectExpr("sum(sqrt(id)) AS s")
    with pytest.raises(TarnError) as e:
        Session(spark).execute(slow, timeout=700)
    assert e.value.kind == "timeout"


def test_errors():
    assert normalize_error(ValueError("x")).kind == "execution_failed"
    e = TarnError("timeout", "m")
    assert normalize_error(e) is e
    with pytest.raises(ValueError):
        TarnError("no such kind", "m")
