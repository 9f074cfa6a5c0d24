"""SQL statements on a table store: a small observatory's log."""

import datetime as dt
from decimal import Decimal

import pytest

import tarn
from tarn import Statements, TarnError, Writer
from tarn.plans.statements import parse_table


@pytest.fixture
def db(spark, tmp_path):
    session = tarn.connect(spark, {"database": f"file://{tmp_path}/sky", "busy_timeout": 100})
    s = Statements(Writer(session.store()))
    s.execute("CREATE TABLE telescope (code VARCHAR PRIMARY KEY, aperture DOUBLE NOT NULL, site VARCHAR)")
    s.execute('CREATE TABLE IF NOT EXISTS "night" (n INTEGER PRIMARY KEY AUTOINCREMENT, held_on DATE NOT NULL, telescope VARCHAR REFERENCES telescope(code), seeing DECIMAL(6,3), UNIQUE (held_on, telescope))')
    s.execute("INSERT INTO telescope (code, aperture, site) VALUES ('T1', 3.5, 'ridge'), ('T2', 0.6, 'roof'), ('T3', 1.2, NULL)")
    return s


def rows(db, text, params=None):
    return db.execute(text, params).rows


def fails(db, text, params=None):
    with pytest.raises(TarnError) as e:
        db.execute(text, params)
    return e.value.kind


def test_definitions():
    d = parse_table("create table t (a integer, b text unique, c double precision, primary key (a, b), foreign key (a) references o (x));")
    assert d.key == ("a", "b") and d.unique == (("b",),) and d.refs[0].table == "o" and list(d.columns) == ["a", "b", "c"]
    with pytest.raises(TarnError):
        parse_table("CREATE VIEW v")


def test_parameters_and_expressions(db):
    nights = "INSERT INTO night (held_on, telescope, seeing) VALUES (?, ?, $3)"
    assert db.execute(nights, [dt.date(2031, 5, 1), "T1", Decimal("0.81")]).num_rows == 1
    assert db.execute("INSERT INTO night (held_on, telescope, seeing) SELECT DATE '2031-05-02', code, aperture / 2 FROM telescope WHERE aperture > $1", [1]).num_rows == 2
    assert rows(db, "SELECT telescope, seeing FROM night ORDER BY held_on, telescope") == [["T1", Decimal("0.810")], ["T1", Decimal("1.750")], ["T3", Decimal("0.600")]]
    assert [r[0] for r in rows(db, "SELECT count(DISTINCT n) FROM night")] == [3]
    assert db.execute("UPDATE night SET seeing = seeing * ?, telescope = coalesce(telescope, ?) WHERE held_on = DATE '2031-05-02' AND seeing < 1", [2, "T2"]).num_rows == 1
    assert rows(db, "SELECT sum(seeing) FROM night n, telescope t WHERE n.telescope = t.code AND t.site IS NULL") == [[Decimal("1.200")]]
    assert db.execute("DELETE FROM night WHERE seeing IN (0.81, 1.2)").num_rows == 2 and rows(db, "SELECT telescope FROM night") == [["T1"]]


def test_literals_are_left_alone(db):
    """Words of the language, names of tables and placeholders mean nothing inside quotes and comments."""
    assert rows(db, "SELECT 'from telescope, night', '{night}', '$1 ?', code FROM telescope -- , night\nWHERE site = 'roof'") == [["from telescope, night", "{night}", "$1 ?", "T2"]]
    assert db.execute("UPDATE telescope SET site = 'old WHERE code = 1' WHERE site = 'roof' /* WHERE 1 = 1 */").num_rows == 1
    assert db.execute("UPDATE telescope SET aperture = (CASE WHEN site LIKE '% WHERE %' THEN 9 ELSE 1 END) WHERE code = 'T2'").num_rows == 1
    assert rows(db, "SELECT site, aperture FROM telescope WHERE aperture = 9") == [["old WHERE code = 1", 9.0]]
    assert db.execute("INSERT INTO telescope (code, aperture, site) VALUES ('VALUES (1)', 2, 'it''s; here');").num_rows == 1
    assert db.execute("DELETE FROM telescope WHERE code = 'VALUES (1)' AND site <> 'x WHERE y'").num_rows == 1
    assert rows(db, "WITH night AS (SELECT 'mine' AS n) SELECT n FROM night") == [["mine"]]


def test_a_column_may_be_named_like_a_table(db):
    db.execute("INSERT INTO night (held_on, telescope) VALUES (DATE '2031-06-01', 'T1')")
    assert rows(db, "SELECT n, telescope FROM night ORDER BY n, telescope") == [[1, "T1"]]
    assert rows(db, "SELECT telescope, count(*) FROM night GROUP BY telescope") == [["T1", 1]]


def test_replace_takes_what_any_unique_key_holds(db):
    for night in ("(DATE '2031-07-01', 'T1', 1)", "(DATE '2031-07-02', 'T2', 2)", "(DATE '2031-07-03', NULL, 3)"):
        db.execute(f"INSERT INTO night (held_on, telescope, seeing) VALUES {night}")
    files = set(db.store.load()["telescope"].files)
    # the first new row takes night 1's number and night 2's date and telescope; the last one's telescope is NULL and takes nothing
    assert db.execute("REPLACE INTO night (n, held_on, telescope, seeing) VALUES (1, DATE '2031-07-02', 'T2', 9), (50, DATE '2031-07-03', NULL, 8)").num_rows == 2
    assert rows(db, "SELECT n, seeing FROM night ORDER BY n") == [[1, Decimal("9.000")], [3, Decimal("3.000")], [50, Decimal("8.000")]]
    assert set(db.store.load()["telescope"].files) == files
    assert db.execute("INSERT OR REPLACE INTO telescope (code, aperture) SELECT code, aperture + 1 FROM telescope WHERE site IS NOT NULL").num_rows == 2
    assert rows(db, "SELECT code, aperture, site FROM telescope ORDER BY code") == [["T1", 4.5, None], ["T2", 1.6, None], ["T3", 1.2, None]]


def test_refusals(db):
    db.execute("INSERT INTO night (held_on, telescope) VALUES (DATE '2031-08-01', 'T1'), (DATE '2031-08-02', 'T1')")
    constraint = ("execution_failed", "constraint_violation")
    assert fails(db, "INSERT INTO telescope (code, aperture) VALUES ('T1', 1)") == "execution_failed"
    assert fails(db, "INSERT INTO telescope (code) VALUES ('T9')") == "execution_failed"
    assert fails(db, "INSERT INTO night (held_on, telescope) VALUES (DATE '2031-08-03', 'T9')") == "execution_failed"
    assert fails(db, "DELETE FROM telescope WHERE code LIKE 'T%'") in constraint
    assert fails(db, "UPDATE night SET held_on = DATE '2031-08-01' WHERE n > 1") in constraint
    assert fails(db, "UPDATE night SET moon = 1 WHERE n = 1") == "execution_failed" and fails(db, "SELECT moon FROM night") == "execution_failed"
    assert fails(db, "DELETE FROM night") == "invalid_command"
    assert rows(db, "SELECT (SELECT count(*) FROM telescope), (SELECT count(*) FROM night)") == [[3, 2]]


def test_one_transaction(db):
    def work(tx):
        db.execute("DELETE FROM telescope WHERE code = 'T3'")
        assert rows(db, "SELECT count(*) FROM telescope") == [[2]]
        raise RuntimeError("clouds")

    with pytest.raises(RuntimeError):
        db.writer.transaction(work)
    assert rows(db, "SELECT count(*) FROM telescope") == [[3]]
    db.execute("DROP TABLE night")
    assert fails(db, "DROP TABLE night") == "invalid_command"
    db.execute("DROP TABLE IF EXISTS night")
