"""Option building only: no database is started for tests."""

import datetime as dt
from decimal import Decimal
from types import SimpleNamespace

import duckdb
import pytest

from lakemill.__main__ import adjusted, arguments, run
from lakemill.plans import feeds, measures
from lakemill.sources.relational import Connection, Split, read_table


def test_secrets_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("LAKEMILL_JDBC_USER", "reader")
    monkeypatch.delenv("LAKEMILL_JDBC_PASSWORD", raising=False)
    conn = Connection("jdbc:some://host/db", extra={"queryTimeout": "30"})
    assert conn.options(dbtable="t") == {
        "url": "jdbc:some://host/db", "user": "reader", "queryTimeout": "30", "dbtable": "t"}
    assert "password" not in repr(conn).replace("password_variable", "")


def met(predicate, value):
    """Evaluate a predicate over one value of the column k in DuckDB, as the store would."""
    return duckdb.sql(f"SELECT coalesce({predicate}, false) FROM (SELECT {value} AS k)").fetchall()[0][0]


def test_every_value_meets_one_predicate():
    split = Split("k", 4)
    lows = [1, 10, 10, 10**12]
    found = split.predicates(lows)
    assert found == ["k < 10 OR k IS NULL", "k >= 10 AND k < 1000000000000", "k >= 1000000000000"]
    for value in ("-5", "1", "9", "10", "11", "999999999999", str(10**13), "NULL::BIGINT"):
        assert [met(p, value) for p in found].count(True) == 1
    assert split.predicates([]) == split.predicates([7, 7]) == ["1 = 1"]


def test_predicates_of_times_and_text():
    times = [dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1, 12, 30, 0, 5)]
    assert Split("k", 2).predicates(times)[1] == "k >= TIMESTAMP '2024-02-01 12:30:00.000005'"
    assert Split("k", 2).predicates([dt.date(2024, 1, 1), dt.date(2024, 3, 1)])[1] == "k >= DATE '2024-03-01'"
    assert Split("k", 2).predicates(["a", "it's"])[0] == "k < 'it''s' OR k IS NULL"
    assert Split("k", 2).predicates([Decimal("1.50"), Decimal("2.25")])[1] == "k >= 2.25"
    with pytest.raises(TypeError):
        Split("k", 2).predicates([True, False])


def test_quantiles_cut_a_crowded_column_evenly():
    """Most rows sit at one end, where ranges of equal width would leave one task nearly all."""
    duckdb.sql("CREATE OR REPLACE TEMP TABLE crowd AS SELECT CASE WHEN i < 900 THEN i ELSE i * 1000000 END AS k FROM range(1000) r(i)")
    split = Split("k", 8)
    lows = [r[1] for r in duckdb.sql(split.quantile_query("crowd")).fetchall()]
    counts = [duckdb.sql(f"SELECT count(*) FROM crowd WHERE {p}").fetchall()[0][0] for p in split.predicates(lows)]
    assert sum(counts) == 1000 and len(counts) == 8 and max(counts) - min(counts) <= 1


class Reader:
    """Stands in for a session: keeps what it was asked to read."""

    def __init__(self, lows):
        self.lows, self.asked = lows, []
        self.read = self

    def format(self, name):
        return self

    def options(self, **options):
        self.asked.append(options)
        return self

    def load(self):
        return self

    def collect(self):
        return [SimpleNamespace(part=i, low=v) for i, v in enumerate(self.lows)]

    def jdbc(self, url, table, predicates, properties):
        self.asked.append((url, table, predicates, properties))


def test_a_split_scan_asks_for_the_cuts_first():
    spark = Reader([1, 5])
    read_table(spark, Connection("jdbc:x", "some.Driver"), "orders", Split("id", 2), fetch_size=7)
    query, scan = spark.asked
    assert query["dbtable"].startswith("(SELECT part, MIN(id) AS low") and query["dbtable"].endswith(") q")
    assert scan == ("jdbc:x", "orders", ["id < 5 OR id IS NULL", "id >= 5"], {"driver": "some.Driver", "fetchsize": "7"})


def test_a_feed_is_split_from_the_command_line():
    specs = adjusted(feeds.RETAIL_B, ["order_master=order_id:16"], ["order_detail"])
    by = {s.source: s for s in specs}
    assert by["order_master"].split == Split("order_id", 16) and by["order_detail"].inclusive and not by["order_master"].inclusive
    with pytest.raises(SystemExit):
        adjusted(feeds.RETAIL_B, ["nothing=id:2"], [])


class Frame:
    """Stands in for a result: keeps how it was asked to be written."""

    def __init__(self):
        self.asked = {}
        self.write = self

    def coalesce(self, tasks):
        self.asked["tasks"] = tasks
        return self

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked |= options
        return self

    def mode(self, mode):
        self.asked["mode"] = mode
        return self

    def save(self):
        self.asked["saved"] = True


@pytest.mark.parametrize("more, want", [
    ([], {"mode": "overwrite", "truncate": "true"}), (["--mode", "append", "--connections", "3"], {"mode": "append", "tasks": 3})])
def test_results_go_to_a_relational_store(monkeypatch, more, want):
    """Truncating keeps the table's definition; its own overwrite would drop the table."""
    for name in ("LAKEMILL_JDBC_USER", "LAKEMILL_JDBC_PASSWORD"):
        monkeypatch.delenv(name, raising=False)
    frame = Frame()
    monkeypatch.setitem(measures.RETAIL_B, "topten", lambda spark, dwd: frame)
    args = arguments().parse_args(["measure", "--feed", "retail_b", "--dwd", "d", "--url", "jdbc:x", "--name", "topten", *more])
    run(None, args)
    assert frame.asked == {"format": "jdbc", "url": "jdbc:x", "dbtable": "topten", "saved": True, **want}


def test_results_need_one_target():
    with pytest.raises(SystemExit):
        arguments().parse_args(["measure", "--feed", "retail_b", "--dwd", "d"])
