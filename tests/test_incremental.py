import pytest
from helpers import rows, ts

from lakemill.operators.incremental import Watermark, high_water, incremental, incremental_from, incremental_pushed

ONE, TWO = Watermark("ts", ("c",)), Watermark("greatest", ("c", "o"))
BOTH = [incremental, incremental_pushed]


def frame(spark, items):
    return spark.createDataFrame([(i, ts(c), ts(o)) for i, c, o in items], "id int, c timestamp_ntz, o timestamp_ntz")


STORED = [(1, "2024-01-01 00:00:00", "2024-01-05 00:00:00"), (2, "2024-01-02 00:00:00", None)]
SOURCE = STORED + [
    (3, "2024-01-02 00:00:00", None), (4, "2024-01-03 00:00:00", None), (5, "2024-01-01 00:00:00", "2024-01-06 00:00:00"),
    (6, "2024-01-05 00:00:00", "2024-01-05 00:00:00"), (7, None, None), (8, "2024-01-07 00:00:00", None),
]


@pytest.mark.parametrize("load", BOTH)
def test_one_time(spark, load):
    new = load(frame(spark, SOURCE), frame(spark, STORED), ONE)
    assert [r[0] for r in rows(new, "id")] == [4, 6, 8]


@pytest.mark.parametrize("load", BOTH)
def test_greater_of_two_times(spark, load):
    new = load(frame(spark, SOURCE), frame(spark, STORED), TWO)
    assert [r[0] for r in rows(new, "id")] == [5, 8]


@pytest.mark.parametrize("load", BOTH)
@pytest.mark.parametrize("mark", [ONE, TWO])
def test_empty_target_takes_everything(spark, load, mark):
    assert load(frame(spark, SOURCE), frame(spark, []), mark).count() == len(SOURCE)


@pytest.mark.parametrize("load", BOTH)
def test_text_ids_compare_as_numbers(spark, load):
    source = spark.createDataFrame([("8",), ("9",), ("10",), ("x",)], "id string")
    new = load(source, source.filter("id = '9'"), Watermark("id", ("id",)))
    assert rows(new) == [("10",)]


@pytest.mark.parametrize("load", BOTH)
def test_inclusive_repeats_the_high_water(spark, load):
    new = load(frame(spark, SOURCE), frame(spark, STORED), ONE, inclusive=True)
    assert [r[0] for r in rows(new, "id")] == [2, 3, 4, 6, 8]


def test_late_rows_at_the_high_water_come_once(spark):
    """Rows 2 is stored with the greatest mark; 3 carries it too and was committed later, 2 comes again with other content."""
    stored, source = frame(spark, STORED), frame(spark, SOURCE)
    assert [r[0] for r in rows(incremental_from(source, stored, ONE, ["id", "c", "o"]), "id")] == [3, 4, 6, 8]
    changed = frame(spark, SOURCE + [(2, "2024-01-02 00:00:00", "2024-01-01 00:00:00")])
    assert [r[0] for r in rows(incremental_from(changed, stored, ONE, ["id", "c", "o"]), "id")] == [2, 3, 4, 6, 8]
    assert [r[0] for r in rows(incremental_from(changed, stored, ONE, ["id", "c"]), "id")] == [3, 4, 6, 8]
    again = stored.unionByName(incremental_from(source, stored, ONE, ["id", "c", "o"]))
    assert incremental_from(source, again, ONE, ["id", "c", "o"]).count() == 0
    assert [r[0] for r in rows(incremental_from(source, stored, TWO, ["id", "c", "o"]), "id")] == [5, 6, 8]
    assert incremental_from(source, frame(spark, []), ONE, ["id"]).count() == len(SOURCE)


def test_high_water_of_empty_is_null(spark):
    assert high_water(frame(spark, []), TWO).first()["high"] is None


def test_pushed_literal_reaches_the_scan(spark, tmp_path):
    frame(spark, SOURCE).write.parquet(str(tmp_path / "src"))
    source = spark.read.parquet(str(tmp_path / "src"))
    plan = incremental_pushed(source, frame(spark, STORED), ONE)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c), GreaterThan(c,2024-01-02T00:00)]" in plan


def test_bad_watermark():
    with pytest.raises(ValueError):
        Watermark("size", ("c",))
    with pytest.raises(ValueError):
        Watermark("ts", ("c", "o"))


def test_only_rows_at_the_high_water_are_compared(spark):
    new = incremental_from(frame(spark, SOURCE), frame(spark, STORED), ONE, ["id", "c", "o"])
    assert [r[0] for r in rows(new, "id")] == [3, 4, 6, 8]
    assert new._jdf.queryExecution().optimizedPlan().toString().startswith("Union")  # the others pass beside the join
