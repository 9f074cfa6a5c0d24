"""The write layer on a table store: parcels of a garden and visits to them."""

import datetime as dt
import threading
from decimal import Decimal

import pytest

from tarn import Batch, Binding, Command, Domain, Graph, Node, Reference, Row, Store, TarnError, Writer
from tarn.plans.writes import cardinality_holds

PARCEL = Domain("parcel", {"no": "integer", "bed": "varchar", "spot": "integer", "crop": "varchar", "kilos": "decimal(8,2)", "sown": "date"}, key=("no",), unique=(("bed", "spot"),), not_null=frozenset({"bed", "spot"}), generated="no")
# a key of two columns, a reference to the table itself and one to parcels
VISIT = Domain("visit", {"visitor": "varchar", "turn": "integer", "parcel": "bigint", "note": "text", "host": "bigint"}, key=("visitor", "turn"), not_null=frozenset({"parcel"}), refs=(Reference("parcel", "parcel", "no"), Reference("host", "visit", "turn")))


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/garden").create(PARCEL).create(VISIT)


@pytest.fixture
def writer(store):
    return Writer(store)


def sow(bed, spot, crop="kale", returning=("no",), **more):
    return Command("insert", "parcel", (("bed", bed), ("spot", spot), ("crop", ("literal", crop))), returning=list(returning), **more)


def visit(visitor, turn, parcel, **more):
    return Command("insert", "visit", (("visitor", visitor), ("turn", turn), ("parcel", parcel), *((k, more.pop(k)) for k in ("note", "host") if k in more)), **more)


def crops(store):
    return [r["crop"] for r in store.table("parcel").orderBy("bed", "spot").collect()]


def kind(f, *a, **k):
    with pytest.raises(TarnError) as e:
        f(*a, **k)
    return e.value.kind, e.value.details


def test_one_parcel_through_a_season(store, writer):
    planted = Command("insert", "parcel", (("bed", ("context", "bed")), ("spot", 4), ("crop", "leek"), ("kilos", "0.5"), ("sown", "2030-03-09")), returning=["no", "kilos", "sown"])
    got = writer.execute(planted, {"bed": "north"})
    assert (got.operation, got.affected_rows, got.rows) == ("insert", 1, [{"no": 1, "kilos": Decimal("0.50"), "sown": dt.date(2030, 3, 9)}])
    where = ("or", [("and", [("eq", "bed", ("context", "bed")), ("lt", "kilos", Decimal(1))]), ("is_null", "spot")])
    got = writer.execute(Command("update", "parcel", (("kilos", 12), ("crop", ("field", "bed"))), where, ["crop", "kilos"]), {"bed": "north"})
    assert got.rows == [{"crop": "north", "kilos": Decimal("12.00")}]
    rule = {"conflict_target": ["spot", "bed"], "upsert_update_fields": ["crop"]}  # a unique key, in another order
    again = Command("upsert", "parcel", (("bed", "north"), ("spot", 4), ("crop", "onion"), ("kilos", 3)), returning=["no", "crop", "kilos"], metadata=rule)
    assert writer.execute(again).rows == [{"no": 1, "crop": "onion", "kilos": Decimal("12.00")}]
    gone = writer.execute(Command("delete", "parcel", predicate=("like", "crop", "ON%"), returning="all"))
    assert gone.rows == [{"no": 1, "bed": "north", "spot": 4, "crop": "onion", "kilos": Decimal("12.00"), "sown": dt.date(2030, 3, 9)}]
    assert store.table("parcel").count() == 0 and writer.execute(sow("south", 1)).rows == [{"no": 2}]


def test_a_write_of_too_many_rows_is_undone(store, writer):
    writer.execute(Batch((sow("a", 1, "pea"), sow("a", 2, "bean"), sow("b", 1, "corn"))))
    for limit in (("exactly", 1), ("at_most", 1), ("at_least", 3), ("between", 3, 5)):
        update = Command("update", "parcel", (("crop", "weed"),), ("eq", "bed", "a"), expected_cardinality=limit)
        assert kind(writer.execute, update) == ("cardinality_mismatch", {"expected": limit, "actual": 2})
    assert crops(store) == ["pea", "bean", "corn"]


def test_a_batch_is_all_or_nothing(store, writer):
    assert kind(writer.execute, Batch((sow("a", 1), sow("a", 2), sow("a", 1))))[0] == "execution_failed"
    assert kind(writer.execute, Batch((sow("a", 1), visit("ann", 1, 77))))[0] == "execution_failed"
    assert store.table("parcel").count() == 0 == store.table("visit").count()


def graph_of(*visits, bed="g", **node):
    rows = tuple(Row(str(i), Command("insert", "visit", (("visitor", v), ("turn", t)), returning=["turn"]), (Binding("parcel", "plot", "p", "no"),)) for i, (v, t) in enumerate(visits))
    return Graph((Node("plot", "parcel", (Row("p", sow(bed, 1, returning=())),)), Node("visits", "visit", rows, **node)), ("plot", "p"))


def test_a_graph_hands_generated_keys_on(store, writer):
    writer.execute(sow("first", 1))
    shown = writer.preview(graph_of(("ann", 1), ("bob", 1)))
    assert [s["params"][-1] for s in shown.statements[1:]] == ["<plot.p.no>", "<plot.p.no>"] and store.table("parcel").count() == 1
    got = writer.execute(graph_of(("ann", 1), ("bob", 1)))
    assert (got.operation, got.affected_rows, got.rows) == ("graph", 3, [{"no": 2}])
    assert got.metadata["node_strategies"] == {"plot": "ordered_fallback", "visits": "ordered_fallback"}
    assert sorted(tuple(r) for r in store.table("visit").select("visitor", "parcel").collect()) == [("ann", 2), ("bob", 2)]


def test_a_graph_deletes_what_it_leaves_out(store, writer):
    writer.execute(graph_of(("ann", 1), ("ann", 2), ("bob", 1)))
    again = graph_of(("ann", 3), bed="h", delete_missing=("visitor",))
    rows = tuple(Row(r.id, Command("insert", "visit", r.command.assignments, returning=["visitor", "turn"]), r.bindings) for r in again.nodes[1].rows)
    done = writer.execute(Graph((again.nodes[0], Node("visits", "visit", rows, delete_missing=("visitor",))), again.root))
    assert done.affected_rows == 4  # a parcel, a visit, and two old visits of the same visitor
    assert sorted((r["visitor"], r["turn"]) for r in store.table("visit").collect()) == [("ann", 3), ("bob", 1)]


def test_graphs_in_the_wrong_order(writer):
    early = Graph((Node("visits", "visit", (Row("v", Command("insert", "visit", (("visitor", "x"),)), (Binding("parcel", "plot", "p", "no"),)),)), Node("plot", "parcel", (Row("p", sow("z", 1)),))), ("plot", "p"))
    assert kind(writer.execute, early)[0] == "invalid_command"
    assert kind(writer.execute, Graph((Node("plot", "parcel", (Row("p", sow("z", 1)),)),), ("plot", "q")))[0] == "invalid_command"


def test_guards(store, writer):
    guard = {"foreign_key_guards": [{"field": "parcel", "relation": "parcel", "target_field": "no"}]}
    writer.execute(sow("a", 1))
    assert writer.execute(visit("ann", 1, 1, metadata=guard)).affected_rows == 1
    assert kind(writer.execute, visit("ann", 2, 404, metadata=guard)) == ("cardinality_mismatch", {"expected": ("exactly", 1), "actual": 0})
    assert writer.execute(visit("ann", 2, 404, metadata=guard, expected_cardinality=("at_most", 1))).affected_rows == 0
    for value in (("field", "turn"), ("literal", ("system", "now"))):
        assert kind(writer.execute, visit("ann", 2, value, metadata=guard))[0] == "invalid_foreign_key_guard"
    assert kind(writer.execute, Command("update", "visit", (("note", "x"),), ("eq", "turn", 1), metadata=guard))[0] == "invalid_foreign_key_guard"
    assert store.table("visit").count() == 1


def test_constraints(spark, store, writer, tmp_path):
    writer.execute(Batch((sow("a", 1), sow("a", 2), visit("ann", 1, 1), visit("ann", 2, 2, host=1))))
    assert kind(writer.execute, Command("insert", "parcel", (("bed", "c"),)))[1]["columns"] == ["bed", "no", "spot"]
    assert kind(writer.execute, visit("ann", 2, 1))[0] == "execution_failed"  # both columns of the key are taken
    assert writer.execute(visit("bob", 2, 1)).affected_rows == 1
    assert kind(writer.execute, visit("bob", 3, 1, host=9))[0] == "execution_failed"
    assert kind(writer.execute, Command("update", "parcel", (("spot", 1),), ("eq", "spot", 2)))[1]["columns"] == ["bed", "spot"]
    assert kind(writer.execute, Command("update", "visit", (("parcel", None),), ("eq", "visitor", "bob")))[0] == "execution_failed"
    assert kind(writer.execute, Command("delete", "parcel", predicate=("eq", "no", 2)))[0] == "execution_failed"
    assert kind(writer.execute, Command("delete", "visit", predicate=("and", [("eq", "turn", 1), ("eq", "visitor", "ann")])))[1]["field"] == "host"
    loose = Store(spark, f"file://{tmp_path}/loose", foreign_keys=False).create(PARCEL).create(VISIT)
    assert Writer(loose).execute(visit("ann", 1, 404)).affected_rows == 1


def test_what_is_checked_before_anything_runs(writer):
    k = lambda c, ctx=None: kind(writer.execute, c, ctx)[0]
    for operation in ("update", "delete"):
        assert k(Command(operation, "parcel")) == "missing_predicate"
    assert k(Command("insert", "parcel")) == "invalid_command" and k("INSERT") == "invalid_command" and k(Command("merge", "parcel")) == "invalid_command"
    assert k(Command("insert", "parcel", (("crop", ("context", "who")),)), {"other": 1}) == "missing_context"
    assert k(Command("insert", "parcel", (("crop", ("unsafe_fragment", "1; --")),))) == "invalid_command"
    assert k(Command("insert", "parcel", (("crop", "x"),), returning={"no": 1})) == "invalid_command"
    assert k(Command("delete", "parcel", predicate=("and", []))) == "invalid_predicate"
    assert k(Command("insert", "orchard", (("crop", "x"),))) == "execution_failed"
    rules = [{}, {"conflict_target": []}, {"conflict_target": ["no"]}, {"conflict_target": ["no"], "upsert_update_fields": ["crop", "crop"]}, {"conflict_target": ["no"], "upsert_update_fields": ["kilos"]}, {"conflict_target": [""], "upsert_update_fields": []}]
    assert {k(Command("upsert", "parcel", (("no", 1), ("crop", "x")), metadata=m)) for m in rules} == {"invalid_command"}


def test_upsert_of_no_fields_keeps_the_row(store, writer):
    writer.execute(sow("a", 1, "pea"))
    rule = {"conflict_target": ["bed", "spot"], "upsert_update_fields": []}
    assert writer.execute(Command("upsert", "parcel", (("bed", "a"), ("spot", 1), ("crop", "weed")), metadata=rule)).affected_rows == 0
    assert writer.execute(Command("upsert", "parcel", (("bed", "a"), ("spot", 2), ("crop", "bean")), metadata=rule)).affected_rows == 1
    assert crops(store) == ["pea", "bean"]
    partial = {"conflict_target": ["bed"], "upsert_update_fields": []}
    assert kind(writer.execute, Command("upsert", "parcel", (("bed", "a"), ("spot", 3)), metadata=partial))[0] == "execution_failed"


def test_levels_of_a_transaction(store, writer):
    def work(tx):
        writer.execute(sow("a", 1, "pea"))
        with pytest.raises(TarnError):
            writer.execute(Batch((sow("b", 1), sow("a", 1))))
        assert writer.transaction(lambda inner: writer.execute(sow("c", 1, "corn"))).affected_rows == 1
        assert store.table("parcel").count() == 0  # nothing is published yet
        return tx.read("parcel").count()

    assert writer.transaction(work) == 2 and crops(store) == ["pea", "corn"]

    def fail(tx):
        writer.execute(Command("delete", "parcel", predicate=("not_null", "no")))
        raise KeyError("hail")

    with pytest.raises(KeyError):
        writer.transaction(fail)
    assert crops(store) == ["pea", "corn"] and store.vacuum() >= 1 and crops(store) == ["pea", "corn"]


def test_one_writer_at_a_time(spark, store):
    hasty = Store(spark, store.root, busy_timeout=50)
    with store.lock():
        assert kind(Writer(hasty).execute, sow("a", 1))[0] == "store_busy"
    held, release = threading.Event(), threading.Event()

    def hold():
        with store.lock():
            held.set()
            release.wait(5)

    holder = threading.Thread(target=hold)
    holder.start()
    held.wait(5)
    threading.Timer(0.3, release.set).start()
    assert Writer(Store(spark, store.root, busy_timeout=10_000)).execute(sow("b", 1)).affected_rows == 1
    holder.join()


def test_only_files_with_a_matching_row_are_written_again(store, writer):
    files = lambda: set(store.load()["parcel"].files)
    for spot in (1, 2, 3):
        writer.execute(sow("a", spot, f"crop {spot}"))
    before = files()
    assert len(before) == 3  # a file an insert, none of them empty
    writer.execute(Command("update", "parcel", (("kilos", 7),), ("in", "spot", [2])))
    assert len(before & files()) == 2 and len(files()) == 3
    writer.execute(Command("delete", "parcel", predicate=("eq", "spot", 9)))
    assert len(before & files()) == 2
    writer.execute(Command("delete", "parcel", predicate=("gte", "spot", 2)))
    assert len(before & files()) == 1 and crops(store) == ["crop 1"]


def test_many_small_files_are_put_together(store, writer):
    for spot in range(4):
        writer.execute(sow("a", spot, f"crop {spot}"))
    assert store.compact("parcel") == 3 and store.compact("parcel") == 0 and len(store.load()["parcel"].files) == 1
    assert crops(store) == [f"crop {i}" for i in range(4)] and writer.execute(sow("b", 1)).rows == [{"no": 5}]


def test_preview_runs_nothing(store, writer):
    where = ("and", [("gt", "kilos", 1), ("in", "bed", ["x", "y"]), ("not", ("is_null", "crop"))])
    shown = writer.preview(Batch((sow("a", 1), Command("update", "parcel", (("crop", "n"),), where), Command("delete", "parcel", predicate=("not_like", "crop", "%a")))))
    assert [s["params"] for s in shown.statements] == [["a", 1, "kale"], ["n", 1, "x", "y"], ["%a"]]
    assert shown.statements[1]["text"] == "UPDATE `parcel` SET `crop` = ? WHERE (`kilos` > ? AND `bed` IN (?, ?) AND NOT (`crop` IS NULL))"
    assert shown.metadata["atomic"] and store.table("parcel").count() == 0


def test_cardinalities():
    assert cardinality_holds(2, ("at_most", 2)) and not cardinality_holds(3, ("at_most", 2)) and cardinality_holds(3, ("at_least", 3))
    assert cardinality_holds(2, ("between", 1, 3)) and not cardinality_holds(0, ("between", 1, 3)) and cardinality_holds(9, ("many",))


def test_domains_are_checked():
    assert kind(Domain, "t", {"a": "int"}, key=("b",))[0] == "invalid_domain"


def test_rows_of_a_frame_are_appended(spark, store, writer):
    rows = spark.range(40).selectExpr("concat('bed ', id % 4) AS bed", "cast(id AS long) AS spot", "cast(id / 4 AS double) AS kilos")
    assert writer.append("parcel", rows).affected_rows == 40
    numbers = {r["no"] for r in store.table("parcel").collect()}
    assert len(numbers) == 40 and writer.execute(sow("single", 1)).rows[0]["no"] > max(numbers)
    assert store.table("parcel").where("kilos = 2.25").count() == 1
    for bad in (rows, rows.selectExpr("'same' AS bed", "1L AS spot"), rows.drop("spot"), rows.selectExpr("*", "1 AS depth")):
        assert kind(writer.append, "parcel", bad)[0] == "execution_failed"
    assert kind(writer.append, "visit", spark.sql("SELECT 'ann' AS visitor, 1 AS turn, 12345 AS parcel"))[0] == "execution_failed"
    own = spark.sql(f"SELECT 'ann' AS visitor, t AS turn, {min(numbers)} AS parcel, t AS host FROM VALUES (1), (2) AS v(t)")
    assert writer.append("visit", own).affected_rows == 2 and store.table("parcel").count() == 41
