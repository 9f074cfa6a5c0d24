"""The engine's queries over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .domain import Domain, Reference
from .functions import collections as coll
from .functions import json as js
from .functions.datetimes import datetime_operation
from .operators import relational, textindex, textsearch
from .plans.statements import Statements
from .plans.writes import Batch, Binding, Command, Graph, Node, Row, Writer
from .session import Session
from .sources.scratch import private_folder
from .sources.store import Store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    """Register a function of a Session as a query under its own name."""

    def add(f: Callable[[Session], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Session(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ------------------------------------------------------------------------------------- filters


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'FURNITURE'")
def filter_eq(s):
    return s.query("customer").filter(("c_mktsegment", "FURNITURE")).select("c_custkey", "c_name").df


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderdate >= TIMESTAMP '1996-01-01'")
def filter_range(s):
    return s.query("orders").filter(("and", [("gt", "o_totalprice", Decimal(100000)), ("gte", "o_orderdate", "1996-01-01")])).select("o_orderkey", "o_totalprice").df


@query("SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' OR o_totalprice < 5000) AND NOT (o_orderpriority = '1-URGENT') AND o_custkey != 7 AND o_custkey <= 1000")
def filter_and_or_not(s):
    tree = ("and", [("or", [("eq", "o_orderstatus", "F"), ("lt", "o_totalprice", 5000)]), ("not", ("eq", "o_orderpriority", "1-URGENT")), ("neq", "o_custkey", 7), ("lte", "o_custkey", ("context", "most"))])
    return s.query("orders").given(most=1000).filter(tree).select("o_orderkey").df


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey IN (1, 3)")
def filter_in(s):
    return s.query("nation").filter(("in", "n_regionkey", [1, 3])).select("n_nationkey", "n_name").df


@query("SELECT e.event_id, e.v IS NULL AS missing FROM (SELECT event_id, CASE WHEN value > 50 THEN value END AS v FROM events) e WHERE e.v IS NULL OR (e.v IS NOT NULL AND event_id % 2 = 0)")
def filter_null(s):
    df = s.table("events").select("event_id", F.when(F.col("value") > 50, F.col("value")).alias("v"), (F.col("event_id") % 2).alias("odd"))
    return s.query(df).filter(("or", [("is_null", "v"), ("and", [("not_null", "v"), ("eq", "odd", 0)])])).select("event_id", F.col("v").isNull().alias("missing")).df


@query("SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE lower('%WIDGET%')")
def ilike(s):
    return s.query("part").filter(("like", "p_name", "%WIDGET%")).select("p_partkey", "p_name").df


@query("SELECT p_partkey, p_name FROM part WHERE lower(p_name) NOT LIKE lower('%WIDGET%')")
def not_ilike(s):
    return s.query("part").filter(("not_like", "p_name", "%WIDGET%")).select("p_partkey", "p_name").df


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 200000")
def sql_numbered_parameters(s):
    return s.sql("SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = $2 AND o_totalprice > $1", [Decimal(200000), "O"])


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_acctbal > 9000 AND c_nationkey = 3")
def sql_positional_parameters(s):
    return s.sql("SELECT c_custkey, c_nationkey FROM {customer} WHERE c_acctbal > ? AND c_nationkey = ? AND '?' <> '$1'", [9000, 3])


# --------------------------------------------------------------------------------------- joins


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def join_inner(s):
    return s.query("nation").join("region", F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name").df


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000")
def join_left(s):
    big = s.table("orders").where(F.col("o_totalprice") > 300000).select("o_orderkey", "o_custkey")
    return s.query("customer").join(big, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey").df


@query("SELECT r_name, n_name FROM region CROSS JOIN nation")
def join_cross(s):
    return s.query("region").join("nation", how="cross").select("r_name", "n_name").df


@query("SELECT o_orderkey, c_custkey FROM (SELECT * FROM orders WHERE o_totalprice > 300000) RIGHT JOIN customer ON o_custkey = c_custkey")
def right_emulated(s):
    big = s.table("orders").where(F.col("o_totalprice") > 300000)
    return s.query(big).right_join("customer", F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_custkey").df


@query("SELECT c.c_custkey, s.s_suppkey FROM (SELECT * FROM customer WHERE c_acctbal > 0) c FULL JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON c.c_custkey = s.s_suppkey * 7")
def full_emulated(s):
    c, p = s.table("customer").where("c_acctbal > 0"), s.table("supplier").where("s_acctbal > 0")
    return s.query(c).full_join(p, F.col("c_custkey") == F.col("s_suppkey") * 7).select("c_custkey", "s_suppkey").df


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)")
def semi_exists(s):
    return s.query("customer").join(s.table("orders").where("o_totalprice > 250000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey").df


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)")
def anti_exists(s):
    return s.query("customer").join(s.table("orders").where("o_totalprice > 250000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey").df


@query("SELECT a.n_name, b.r_name FROM nation a JOIN region b ON a.n_regionkey = b.r_regionkey WHERE b.r_name LIKE 'A%'")
def attached_folder(s):
    s.attach(s.database, "other")
    return s.query("nation").join("other.region", F.col("n_regionkey") == F.col("r_regionkey")).filter(F.col("r_name").startswith("A")).select("n_name", "r_name").df


@query("SELECT n_name, r_name, sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END)::BIGINT AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def memory_tables(s):
    s.register("small", s.query("nation").join("region", F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name").df)
    return s.query("customer").join("small", F.col("c_nationkey") == F.col("n_nationkey")).aggregate("n_name", "r_name", customers=F.sum((F.col("c_acctbal") > 0).cast("long"))).df


# --------------------------------------------------------------------------------- aggregation


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
    round(avg(l_discount), 6) AS avg_disc, min(l_quantity) AS min_qty, max(l_quantity) AS max_qty, count(*)::BIGINT AS n
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def agg_group(s):
    return s.query("lineitem").filter(("lte", "l_shipdate", "1998-09-02")).aggregate(
        "l_returnflag", "l_linestatus", sum_qty=F.round(F.sum("l_quantity"), 2), revenue=F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2),
        avg_disc=F.round(F.avg("l_discount"), 6), min_qty=F.min("l_quantity"), max_qty=F.max("l_quantity"), n=F.count("*"),
    ).df


@query("SELECT count(*)::BIGINT AS n FROM lineitem")
def count_star(s):
    return s.query("lineitem").aggregate(n=F.count("*")).df


@query("SELECT o_custkey, count(*)::BIGINT AS n FROM orders GROUP BY 1 HAVING count(*) > 15")
def agg_having(s):
    return s.query("orders").aggregate("o_custkey", n=F.count("*")).filter(("gt", "n", 15)).df


@query("SELECT n_regionkey, '[' || string_agg('\"' || n_name || '\"', ',' ORDER BY n_name) || ']' AS names FROM nation GROUP BY 1")
def json_array_agg(s):
    return s.query("nation").collect_values(["n_regionkey"], "names", "json_agg", "n_name").df


@query("SELECT c_nationkey, '[' || string_agg(DISTINCT '\"' || c_mktsegment || '\"', ',' ORDER BY '\"' || c_mktsegment || '\"') || ']' AS segments FROM customer GROUP BY 1")
def json_array_agg_distinct(s):
    return s.query("customer").collect_values(["c_nationkey"], "segments", "array_agg", "c_mktsegment", distinct=True).df


@query("SELECT e.event_type, '[' || string_agg(coalesce(v::VARCHAR, 'null'), ',' ORDER BY v NULLS FIRST) || ']' AS vals FROM (SELECT event_type, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS v FROM events) e GROUP BY 1")
def json_array_agg_nulls(s):
    df = s.table("events").select("event_type", F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("v"))
    return df.groupBy("event_type").agg(coll.json_array(F.col("v")).alias("vals"))


@query("SELECT n_regionkey, string_agg(n_name, '; ' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def string_agg(s):
    return s.query("nation").collect_values(["n_regionkey"], "names", "string_agg", "n_name", delimiter="; ").df


# ------------------------------------------------------------------------------------- windows


@query("SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders")
def win_row_number(s):
    return s.query("orders").window(rn=F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))).select("o_orderkey", "o_custkey", "rn").df


@query("""SELECT c_custkey, rank() OVER w AS r, dense_rank() OVER w AS d, round(percent_rank() OVER w, 6) AS p, round(cume_dist() OVER w, 6) AS c,
    ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS q FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_mktsegment)""")
def win_rank(s):
    w = W.partitionBy("c_nationkey").orderBy("c_mktsegment")
    return s.query("customer").window(r=F.rank().over(w), d=F.dense_rank().over(w), p=F.round(F.percent_rank().over(w), 6), c=F.round(F.cume_dist().over(w), 6), q=F.ntile(4).over(W.partitionBy("c_nationkey").orderBy("c_custkey"))).select("c_custkey", "r", "d", "p", "c", "q").df


@query("""SELECT event_id, lag(event_id) OVER w AS before, lead(event_id, 2) OVER w AS later, first_value(event_id) OVER w AS first,
    last_value(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last,
    nth_value(event_id, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win_lag(s):
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return s.query("events").window(before=F.lag("event_id").over(w), later=F.lead("event_id", 2).over(w), first=F.first("event_id").over(w), last=F.last("event_id").over(whole), second=F.nth_value("event_id", 2).over(whole)).select("event_id", "before", "later", "first", "last", "second").df


@query("""SELECT l_orderkey, l_linenumber, sum(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)::BIGINT AS near,
    count(*) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)::BIGINT AS within FROM lineitem""")
def win_frame(s):
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber")
    return s.query("lineitem").window(near=F.sum("l_linenumber").over(w.rowsBetween(-1, 1)), within=F.count("*").over(w.rangeBetween(-2, 0))).select("l_orderkey", "l_linenumber", "near", "within").df


@query("SELECT c_custkey, sum(c_custkey) OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW)::BIGINT AS total FROM customer")
def win_groups_frame(s):
    return relational.groups_frame(s.table("customer"), "c_custkey", ["c_mktsegment"], ["c_nationkey"], 1, 0, "total").select("c_custkey", "total")


# ------------------------------------------------------------------------------ order and sets


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_k(s):
    return s.query("orders").select("o_orderkey", "o_totalprice").order_by(F.desc("o_totalprice"), "o_orderkey").limit(25).df


@query("SELECT n_name, n_nationkey FROM nation ORDER BY 1 LIMIT 5 OFFSET 3")
def order_ordinal_offset(s):
    return s.query("nation").select("n_name", "n_nationkey").order_by(1).limit(5, 3).df


@query("SELECT n_nationkey AS k FROM nation UNION SELECT r_regionkey FROM region")
def union(s):
    return s.query(s.table("nation").select(F.col("n_nationkey").alias("k"))).union(s.table("region").select("r_regionkey")).df


@query("SELECT n_nationkey AS k FROM nation UNION ALL SELECT r_regionkey FROM region")
def union_all(s):
    return s.query(s.table("nation").select(F.col("n_nationkey").alias("k"))).union(s.table("region").select("r_regionkey"), distinct=False).df


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def intersect(s):
    return s.query(s.table("customer").select(F.col("c_custkey").alias("k"))).intersect(s.table("orders").select("o_custkey")).df


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 250000")
def except_(s):
    return s.query(s.table("customer").select(F.col("c_custkey").alias("k"))).except_(s.table("orders").where("o_totalprice > 250000").select("o_custkey")).df


_CTE = "WITH big AS (SELECT o_custkey, count(*) AS n FROM {o} WHERE o_totalprice > 200000 GROUP BY o_custkey) SELECT c_custkey, c_name, CAST(n AS BIGINT) AS n FROM {c} JOIN big ON c_custkey = o_custkey"


@query(_CTE.format(o="orders", c="customer"))
def cte(s):
    return s.sql(_CTE.format(o="{orders}", c="{customer}"))


_RECURSIVE = "WITH RECURSIVE walk(k, depth) AS (SELECT CAST(0 AS INT), 0 UNION ALL SELECT n_nationkey, depth + 1 FROM walk JOIN {n} ON n_nationkey = k * 2 + 1 OR n_nationkey = k * 2 + 2 WHERE depth < 6) SELECT k, depth, n_name FROM walk JOIN {n} ON k = n_nationkey"


@query(_RECURSIVE.format(n="nation"))
def recursive_cte(s):
    return s.sql(_RECURSIVE.format(n="{nation}"))


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND o_totalprice > (SELECT avg(o_totalprice) FROM orders)")
def subqueries(s):
    return s.sql("SELECT o_orderkey FROM {orders} WHERE o_custkey IN (SELECT c_custkey FROM {customer} WHERE c_mktsegment = 'BUILDING') AND o_totalprice > (SELECT avg(o_totalprice) FROM {orders})")


# --------------------------------------------------------------------------------------- dates


def _part(form: str, sql: str):
    def run(s):
        return s.table("events").select("event_id", datetime_operation("format", F.col("ts"), form).alias("part"))

    return run, f"SELECT event_id, strftime(ts, '{sql}') AS part FROM events"


for _name, _form, _sql in (("dt_year", "YYYY", "%Y"), ("dt_month", "MM", "%m"), ("dt_day", "DD", "%d"), ("dt_hour24", "HH24", "%H")):
    _run, _text = _part(_form, _sql)
    _run.__name__ = _name
    query(_text)(_run)


@query("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS part FROM events")
def dt_text(s):
    return s.table("events").select("event_id", datetime_operation("format", F.date_trunc("second", "ts").cast("timestamp_ntz"), "other").alias("part"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE strftime(ts, '%Y') END AS part FROM events")
def dt_bad_text(s):
    text = F.when(F.col("event_id") % 4 == 0, "no date").otherwise(F.col("ts").cast("string"))
    return s.table("events").select("event_id", datetime_operation("format", text, "YYYY").alias("part"))


# ---------------------------------------------------------------------------------------- JSON

#: A richer document for each event, built alike on both sides.
_DOC = """'{"k": ' || (event_id % 7) || ', "s": "' || event_type || '", "f": ' || (event_id % 5) || '.5, "b": ' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END ||
    ', "n": null, "o": {"x": ' || (event_id % 3) || '}, "a": [1, "' || (event_id % 4) || '", ' || (event_id % 4) || ', true]' || CASE WHEN event_id % 6 = 0 THEN ', "only": 1' ELSE '' END || '}'"""


def _docs(s) -> DataFrame:
    return s.table("events").selectExpr("event_id", f"{_DOC} AS doc")


def _over(select: str, where: str = "") -> str:
    return f"WITH d AS (SELECT event_id, {_DOC} AS doc FROM events) SELECT event_id{', ' + select if select else ''} FROM d{' WHERE ' + where if where else ''}"


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract_int(s):
    return s.table("events").select("event_id", js.json_operation("json_extract", F.col("props"), path="$.k", cast="integer").alias("k"))


@query(_over("json_extract_string(doc, '$.s') AS t, json_extract_string(doc, '$.o.x') AS x"))
def json_extract_text(s):
    return _docs(s).select("event_id", js.json_operation("json_extract_text", F.col("doc"), path="s").alias("t"), js.json_operation("json_extract_text", F.col("doc"), path="$.o.x").alias("x"))


@query(_over("CAST(json_extract(doc, '$.f') AS DECIMAL(38,10)) AS d"))
def json_extract_decimal(s):
    return _docs(s).select("event_id", js.extract(F.col("doc"), "$.f", "decimal").alias("d"))


@query(_over("CAST(json_extract(doc, '$.f') AS DOUBLE) AS f"))
def json_extract_float(s):
    return _docs(s).select("event_id", js.extract(F.col("doc"), "$.f", "float").alias("f"))


@query(_over("CASE WHEN json_extract_string(doc, '$.b') = 'true' THEN 1 ELSE 0 END AS b"))
def json_extract_bool(s):
    return _docs(s).select("event_id", js.extract(F.col("doc"), "$.b", "boolean").alias("b"))


@query(_over("", "CAST(json_extract(doc, '$.k') AS BIGINT) = 3 AND CAST(json_extract(doc, '$.o.x') AS BIGINT) = 1"))
def json_contains(s):
    return _docs(s).where(js.json_operation("json_contains", F.col("doc"), value={"k": 3, "o": {"x": 1}})).select("event_id")


@query(_over("json_exists(doc, '$.only') AS only, json_exists(doc, '$.n') AS n, json_exists(doc, '$.z') AS z"))
def json_key_exists(s):
    return _docs(s).select("event_id", js.json_operation("json_exists", F.col("doc"), path="only").alias("only"), js.json_operation("json_path_exists", F.col("doc"), path="$.n").alias("n"), js.exists(F.col("doc"), "z").alias("z"))


_TYPE = "CASE json_type(doc, '$.{0}') WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'VARCHAR' THEN 'text' WHEN 'DOUBLE' THEN 'real' WHEN 'BOOLEAN' THEN json_extract_string(doc, '$.{0}') ELSE lower(json_type(doc, '$.{0}')) END AS {0}"


@query(_over(", ".join(map(_TYPE.format, "ksfbnoaz"))))
def json_typeof(s):
    return _docs(s).select("event_id", *(js.json_operation("json_typeof", F.col("doc"), path=p).alias(p) for p in "ksfbnoaz"))


@query(_over(", ".join(f"json_array_length(doc, '$.{p}')::BIGINT AS {p}" for p in "akz")))
def json_array_length(s):
    return _docs(s).select("event_id", *(js.json_operation("json_array_length", F.col("doc"), path=p).alias(p) for p in "akz"))


@query(_over("", "event_id % 4 = 2"))
def json_array_contains(s):
    return _docs(s).where(js.array_contains(F.col("doc"), 2, "a")).select("event_id")


@query(_over("", "event_id % 4 IN (2, 3)"))
def json_array_contains_any(s):
    return _docs(s).where(js.array_contains_any(F.col("doc"), [2, "3"], "a")).select("event_id")


@query(_over("", "event_id % 4 = 3"))
def json_array_contains_all(s):
    return _docs(s).where(js.array_contains_all(F.col("doc"), [3, "3", True], "a")).select("event_id")


@query("""SELECT r_regionkey, '{"key":' || r_regionkey || ',"name":"' || r_name || '","none":null}' AS doc, '[]' AS empty FROM region""")
def json_build_object(s):
    return s.table("region").select("r_regionkey", js.json_operation("json_build_object", pairs={"key": F.col("r_regionkey"), "name": F.col("r_name"), "none": F.lit(None).cast("string")}).alias("doc"), js.json_operation("json_empty_array").alias("empty"))


@query(_over("").replace("SELECT event_id FROM d", "SELECT event_id, i - 1 AS index, CASE i WHEN 1 THEN '1' WHEN 4 THEN 'true' ELSE (event_id % 4)::VARCHAR END AS value FROM d, (VALUES (1), (2), (3), (4)) t(i)"))
def json_rowset(s):
    return js.json_rows(_docs(s), "doc", "a").select("event_id", "index", "value")


@query(_over("json_extract_string(json_extract(doc, '$.t'), '$') AS d").replace(_DOC, "'{\"t\": \"' || strftime(ts, '%Y-%m-%d') || '\"}'"))
def json_extract_date(s):
    docs = s.table("events").select("event_id", F.concat(F.lit('{"t": "'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"}')).alias("doc"))
    return docs.select("event_id", js.json_operation("json_extract", F.col("doc"), path="$.t", cast="date").alias("d"))


# ----------------------------------------------------------------------------------- full text

_T = "list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '')"


_MATCH = f"SELECT doc_id FROM (SELECT doc_id, {_T} AS w FROM documents) WHERE (list_contains(w, 'the') AND list_contains(w, 'license')) OR list_contains(w, 'que')"


@query(_MATCH)
def fts_match(s):
    return s.query("documents").match("text", "the license OR que").select("doc_id").df


_PHRASE = f"SELECT doc_id FROM (SELECT doc_id, ' ' || array_to_string({_T}, ' ') || ' ' AS t FROM documents) WHERE contains(t, ' of the ')"


@query(_PHRASE)
def fts_phrase(s):
    return s.query("documents").match("text", "of the", "phrase").select("doc_id").df


_BOOLEAN = f"SELECT doc_id FROM (SELECT doc_id, {_T} AS w FROM documents) WHERE list_contains(w, 'the') AND len(list_filter(w, lambda x: starts_with(x, 'licen'))) > 0 AND NOT list_contains(w, 'mit')"


@query(_BOOLEAN)
def fts_boolean(s):
    return s.query("documents").match(["text"], "the AND licen* NOT mit", "boolean").select("doc_id").df


@query(f"""WITH d AS (SELECT doc_id, {_T} AS w FROM documents), n AS (SELECT doc_id, len(w) AS l, len(list_filter(w, lambda x: x = 'license')) AS a, len(list_filter(w, lambda x: x = 'version')) AS b FROM d),
    t AS (SELECT count(*) AS docs, avg(l) AS avgl, sum(CASE WHEN a > 0 THEN 1 ELSE 0 END) AS da, sum(CASE WHEN b > 0 THEN 1 ELSE 0 END) AS db FROM n)
    SELECT doc_id, round(-(greatest(ln((docs - da + 0.5) / (da + 0.5)), 1e-6) * (a * 2.2) / (a + 1.2 * (0.25 + 0.75 * l / avgl)) + greatest(ln((docs - db + 0.5) / (db + 0.5)), 1e-6) * (b * 2.2) / (b + 1.2 * (0.25 + 0.75 * l / avgl))), 6) AS rank
    FROM n, t WHERE a > 0 OR b > 0""")
def fts_bm25(s):
    ranked = textsearch.bm25(s.table("documents").select("doc_id", "text"), "doc_id", "text", "license OR version")
    return ranked.select("doc_id", F.round("rank", 6).alias("rank"))


@query(f"""WITH d AS (SELECT doc_id, {_T} AS w, {_T.replace("text", "lang")} AS v FROM documents),
    n AS (SELECT doc_id, len(w) + len(v) AS l, len(list_filter(w, lambda x: x = 'license')) AS aw, len(list_filter(v, lambda x: x = 'license')) AS av, len(list_filter(w, lambda x: x = 'en')) AS bw, len(list_filter(v, lambda x: x = 'en')) AS bv FROM d),
    t AS (SELECT count(*) AS docs, avg(l) AS avgl, sum(CASE WHEN aw + av > 0 THEN 1 ELSE 0 END) AS da, sum(CASE WHEN bw + bv > 0 THEN 1 ELSE 0 END) AS db FROM n),
    f AS (SELECT *, aw + 4.0 * av AS a, bw + 4.0 * bv AS b, 1.2 * (0.25 + 0.75 * l / avgl) AS k FROM n, t)
    SELECT doc_id, round(-(greatest(ln((docs - da + 0.5) / (da + 0.5)), 1e-6) * (a * 2.2) / (a + k) + greatest(ln((docs - db + 0.5) / (db + 0.5)), 1e-6) * (b * 2.2) / (b + k)), 6) AS rank
    FROM f WHERE aw > 0 OR av > 0 OR bw > 0 OR bv > 0""")
def fts_bm25_weights(s):
    ranked = textsearch.bm25(s.table("documents").select("doc_id", "text", "lang"), "doc_id", ["text", "lang"], "license OR en", weights={"text": 1.0, "lang": 4.0})
    return ranked.select("doc_id", F.round("rank", 6).alias("rank"))


def _index(s, *fields) -> textindex.TextIndex:
    return textindex.TextIndex(s.spark, private_folder(s.spark, "index")).build(s.table("documents"), "doc_id", fields)


@query(f"SELECT 'match' AS mode, doc_id FROM ({_MATCH}) UNION ALL SELECT 'phrase', doc_id FROM ({_PHRASE}) UNION ALL SELECT 'boolean', doc_id FROM ({_BOOLEAN})")
def fts_index(s):
    """Searches of a stored index: the rows that a scan of the texts gives."""
    index = _index(s, "text")
    found = {"match": index.search("the license OR que"), "phrase": index.search("of the", "phrase"), "boolean": index.search("the AND licen* NOT mit", "boolean")}
    parts = [df.select(F.lit(mode).alias("mode"), F.col("key").alias("doc_id")) for mode, df in found.items()]
    return parts[0].union(parts[1]).union(parts[2])


@query(ORACLES["fts_bm25_weights"])
def fts_index_bm25(s):
    ranked = _index(s, "text", "lang").bm25("license OR en", {"text": 1.0, "lang": 4.0})
    return ranked.select(F.col("key").alias("doc_id"), F.round("rank", 6).alias("rank"))


# -------------------------------------------------------------------------------------- writes

CUSTOMER = Domain("customer", {"c_custkey": "bigint", "c_name": "text", "c_nationkey": "integer", "c_acctbal": "double", "c_mktsegment": "text"}, key=("c_custkey",), not_null=frozenset({"c_name"}), generated="c_custkey")
ORDERS = Domain("orders", {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "text", "o_totalprice": "double"}, key=("o_orderkey",), refs=(Reference("o_custkey", "customer", "c_custkey"),), generated="o_orderkey")
_C = "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer"
_O = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"


def _store(s, *, orders: bool = False) -> Store:
    """A private copy of the tables that a write query changes."""
    store = Store(s.spark, private_folder(s.spark, "store"))
    store.create(CUSTOMER, s.table("customer").withColumn("c_nationkey", F.col("c_nationkey").cast("bigint")))
    if orders:
        store.create(ORDERS, s.table("orders").where("o_orderkey >= 0"))
    return store


def _new(key: int | None, name: str, nation: int = 5) -> tuple:
    given = (("c_name", ("literal", name)), ("c_nationkey", nation), ("c_acctbal", 1.5), ("c_mktsegment", ("literal", "NEW")))
    return given if key is None else (("c_custkey", key), *given)


@query(_C + " UNION ALL SELECT 900000001, 'Inserted', 5, 1.5, 'NEW'")
def write_insert(s):
    store = _store(s)
    Writer(store).execute(Command("insert", "customer", _new(900000001, "Inserted"), returning="all"))
    return store.table("customer")


@query("SELECT c_custkey, CASE WHEN c_nationkey = 3 AND c_acctbal > 0 THEN 'changed' ELSE c_name END AS c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, CASE WHEN c_nationkey = 3 AND c_acctbal > 0 THEN c_name ELSE c_mktsegment END AS c_mktsegment FROM customer")
def write_update(s):
    store = _store(s)
    Writer(store).execute(Command("update", "customer", (("c_name", "changed"), ("c_mktsegment", ("field", "c_name"))), ("and", [("eq", "c_nationkey", ("context", "nation")), ("gt", "c_acctbal", 0)])), {"nation": 3})
    return store.table("customer")


@query(_C + " WHERE NOT coalesce(c_acctbal < 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY'), false)")
def write_delete(s):
    store = _store(s)
    Writer(store).execute(Command("delete", "customer", predicate=("and", [("lt", "c_acctbal", 0), ("in", "c_mktsegment", ["BUILDING", "MACHINERY"])])))
    return store.table("customer")


@query("SELECT c_custkey, CASE WHEN c_custkey = 10 THEN 'Upserted' ELSE c_name END AS c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer UNION ALL SELECT 900000002, 'Fresh', 5, 1.5, 'NEW'")
def write_upsert(s):
    store, rule = _store(s), {"conflict_target": ["c_custkey"], "upsert_update_fields": ["c_name"]}
    writer = Writer(store)
    writer.execute(Command("upsert", "customer", _new(10, "Upserted"), metadata=rule))
    writer.execute(Command("upsert", "customer", _new(900000002, "Fresh"), metadata=rule))
    return store.table("customer")


@query(_C)
def write_upsert_nothing(s):
    store = _store(s)
    Writer(store).execute(Command("upsert", "customer", _new(10, "Ignored"), metadata={"conflict_target": ["c_custkey"], "upsert_update_fields": []}))
    return store.table("customer")


@query(_O + " UNION ALL SELECT 900000001, 10, 'N', 2.5")
def write_guarded(s):
    store = _store(s, orders=True)
    guard = {"foreign_key_guards": [{"field": "o_custkey", "relation": "customer", "target_field": "c_custkey"}]}
    row = lambda key, customer: (("o_orderkey", key), ("o_custkey", customer), ("o_orderstatus", "N"), ("o_totalprice", 2.5))
    writer = Writer(store)
    writer.execute(Command("insert", "orders", row(900000001, 10), metadata=guard))
    writer.execute(Command("insert", "orders", row(900000002, -77), metadata=guard, expected_cardinality=("at_most", 1)))
    return store.table("orders")


@query(_C + " WHERE c_custkey <> 12 UNION ALL SELECT 900000003, 'A', 5, 1.5, 'NEW' UNION ALL SELECT 900000004, 'B', 5, 1.5, 'NEW'")
def write_batch(s):
    from .errors import TarnError

    store = _store(s)
    writer = Writer(store)
    writer.execute(Batch((Command("insert", "customer", _new(900000003, "A")), Command("insert", "customer", _new(900000004, "B")), Command("delete", "customer", predicate=("eq", "c_custkey", 12)))))
    try:  # a batch that fails leaves nothing behind
        writer.execute(Batch((Command("delete", "customer", predicate=("eq", "c_custkey", 13)), Command("insert", "customer", _new(900000003, "again")))))
    except TarnError:
        pass
    return store.table("customer")


@query("SELECT 'customer' AS relation, max(c_custkey) + 1 AS k, max(c_custkey) + 1 AS parent FROM customer UNION ALL SELECT 'orders', (SELECT max(o_orderkey) + 1 FROM orders), max(c_custkey) + 1 FROM customer")
def write_graph(s):
    store = _store(s, orders=True)
    parent = Command("insert", "customer", _new(None, "Parent"), returning=["c_custkey"])
    child = Command("insert", "orders", (("o_orderstatus", "N"), ("o_totalprice", 9.5)), returning=["o_orderkey"])
    nodes = (Node("root", "customer", (Row("root", parent),)), Node("child", "orders", (Row("0", child, (Binding("o_custkey", "root", "root", "c_custkey"),)),)))
    Writer(store).execute(Graph(nodes, ("root", "root")))
    new = store.table("customer").where("c_name = 'Parent'").select(F.lit("customer").alias("relation"), F.col("c_custkey").alias("k"), F.col("c_custkey").alias("parent"))
    return new.union(store.table("orders").where("o_orderstatus = 'N'").select(F.lit("orders"), "o_orderkey", "o_custkey"))


@query(_C + " UNION ALL SELECT c_custkey + 900000000, c_name, c_nationkey::BIGINT, c_acctbal, 'COPY' FROM customer WHERE c_nationkey < 5")
def write_insert_select(s):
    store = _store(s)
    Writer(store).append("customer", s.table("customer").where("c_nationkey < 5").withColumns({"c_custkey": F.col("c_custkey") + 900000000, "c_mktsegment": F.lit("COPY")}))
    return store.table("customer")


@query("SELECT c_custkey, 'changed' AS c_name, c_acctbal FROM customer WHERE c_nationkey = 3 AND c_acctbal > 0")
def write_returning(s):
    """What an update returns: the rows it changed, as they are after it."""
    where = ("and", [("eq", "c_nationkey", 3), ("gt", "c_acctbal", 0)])
    done = Writer(_store(s)).execute(Command("update", "customer", (("c_name", "changed"),), where, returning=["c_custkey", "c_name", "c_acctbal"]))
    return s.spark.createDataFrame([tuple(r.values()) for r in done.rows], "c_custkey bigint, c_name string, c_acctbal double")


@query("SELECT c_custkey, c_nationkey = 3 AS seen FROM customer")
def write_now(s):
    """The system's time as a value: set where the predicate holds, and not later than now."""
    domain = Domain("visits", {"c_custkey": "bigint", "c_nationkey": "bigint", "c_seen": "datetime"}, key=("c_custkey",))
    store = Store(s.spark, private_folder(s.spark, "store")).create(domain, s.table("customer").selectExpr("c_custkey", "cast(c_nationkey as bigint) AS c_nationkey", "cast(null as timestamp_ntz) AS c_seen"))
    Writer(store).execute(Command("update", "visits", (("c_seen", ("literal", ("system", "now"))),), ("eq", "c_nationkey", 3)))
    seen = F.col("c_seen").isNotNull() & (F.col("c_seen") <= F.localtimestamp()) & (F.col("c_seen") > F.localtimestamp() - F.expr("interval 1 hour"))
    return store.table("visits").select("c_custkey", F.coalesce(seen, F.lit(False)).alias("seen"))


@query(_O + " WHERE o_custkey IS DISTINCT FROM 10 UNION ALL SELECT 900000001, 10, 'N', 2.5 UNION ALL SELECT 900000002, 10, 'N', 3.5")
def write_delete_missing(s):
    """A graph writes two orders of a customer; the customer's other orders go."""
    store = _store(s, orders=True)
    order = lambda key, price: Command("insert", "orders", (("o_orderkey", key), ("o_custkey", 10), ("o_orderstatus", "N"), ("o_totalprice", price)), returning=["o_orderkey"])
    node = Node("orders", "orders", (Row("0", order(900000001, 2.5)), Row("1", order(900000002, 3.5))), delete_missing=("o_custkey",))
    Writer(store).execute(Graph((node,), ("orders", "0")))
    return store.table("orders")


@query("SELECT * FROM (VALUES ('unique', 'execution_failed'), ('required', 'execution_failed'), ('reference', 'execution_failed'), ('referred', 'execution_failed'), ('cardinality', 'cardinality_mismatch')) t(attempt, kind), (SELECT count(*)::BIGINT AS customers FROM customer), (SELECT count(*)::BIGINT AS orders FROM orders)")
def write_refused(s):
    """Writes that constraints refuse, how, and that they leave the tables as they were."""
    from .errors import TarnError

    store = _store(s, orders=True)
    attempts = {
        "unique": Command("insert", "customer", _new(10, "taken")),
        "required": Command("update", "customer", (("c_name", None),), ("eq", "c_custkey", 10)),
        "reference": Command("insert", "orders", (("o_orderkey", 900000001), ("o_custkey", -5))),
        "referred": Command("delete", "customer", predicate=("gt", "c_custkey", 0)),
        "cardinality": Command("delete", "orders", predicate=("gt", "o_orderkey", 0), expected_cardinality=("exactly", 1)),
    }
    kinds = []
    for name, command in attempts.items():
        try:
            Writer(store).execute(command)
        except TarnError as e:
            kinds.append((name, e.kind))
    sizes = [store.table(t).agg(F.count("*").alias(f"{t}s" if t == "customer" else t)) for t in ("customer", "orders")]
    return s.spark.createDataFrame(kinds, "attempt string, kind string").crossJoin(sizes[0]).crossJoin(sizes[1])


@query(_C + " WHERE c_custkey <> 14 UNION ALL SELECT 900000005, 'outer', 5, 1.5, 'NEW' UNION ALL SELECT 900000006, 'kept', 5, 1.5, 'NEW'")
def write_savepoints(s):
    """A transaction with two inner ones: one is kept, the other undone alone."""
    store = _store(s)
    writer = Writer(store)

    def undone(tx):
        writer.execute(Command("delete", "customer", predicate=("gt", "c_custkey", 0)))
        raise LookupError("undo this level only")

    def work(tx):
        writer.execute(Command("insert", "customer", _new(900000005, "outer")))
        writer.transaction(lambda inner: writer.execute(Command("insert", "customer", _new(900000006, "kept"))))
        try:
            writer.transaction(undone)
        except LookupError:
            pass
        writer.execute(Command("delete", "customer", predicate=("eq", "c_custkey", 14)))

    writer.transaction(work)
    return store.table("customer")


@query("SELECT c_custkey, CASE WHEN c_nationkey = 4 THEN 'replaced, from x' ELSE c_name END AS c_name, c_nationkey::BIGINT AS c_nationkey, CASE WHEN c_nationkey = 4 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer")
def sql_replace(s):
    """REPLACE of many rows at once: those whose keys it takes go, in one rewrite."""
    db = Statements(Writer(_store(s)))
    db.execute("REPLACE INTO customer (c_custkey, c_name, c_nationkey, c_mktsegment) SELECT c_custkey, 'replaced, from x', c_nationkey, c_mktsegment FROM customer WHERE c_nationkey = ?", [4])
    return db.frame("SELECT * FROM customer")


@query("SELECT c_nationkey::BIGINT AS nation, count(*)::BIGINT AS customers, 'from sums, customer' AS label FROM customer WHERE c_acctbal > 0 AND c_nationkey <> 7 GROUP BY 1")
def sql_statements(s):
    """CREATE, INSERT .. SELECT, UPDATE, DELETE and a query, as texts; names inside literals are literals."""
    db = Statements(Writer(_store(s)))
    db.execute("CREATE TABLE sums (nation BIGINT PRIMARY KEY, customers BIGINT NOT NULL, label VARCHAR)")
    db.execute("INSERT INTO sums (nation, customers, label) SELECT c_nationkey, count(*), 'x WHERE y' FROM customer WHERE c_acctbal > $1 GROUP BY c_nationkey", [0])
    db.execute("UPDATE sums SET label = 'from sums, customer' WHERE label = 'x WHERE y' AND nation + 0 = nation")
    db.execute("DELETE FROM sums WHERE nation = 7 -- WHERE nation = 8")
    return db.frame("SELECT nation, customers, label FROM sums")


@query("SELECT n_name, r_name, '{nation} $1 ?' AS text FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey = 2")
def sql_attached(s):
    s.attach(s.database, "other")
    return s.sql("SELECT n_name, r_name, '{nation} $1 ?' AS text FROM {nation} JOIN {other.region} r ON n_regionkey = r.r_regionkey WHERE r_regionkey = ?", [2])


@query("SELECT 1 AS active, 12.5 AS amount UNION ALL SELECT 1, 20.25")
def typed_parameters(s):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("active", T.IntegerType()), T.StructField("amount", T.DecimalType(12, 2))])
    df = s.spark.createDataFrame([(0, Decimal("7.50")), (1, Decimal("12.50")), (1, Decimal("20.25"))], schema)
    return s.query(df).filter(("and", [("eq", "active", True), ("gt", "amount", Decimal(10))])).df
