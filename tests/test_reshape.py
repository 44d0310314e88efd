import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, values
from tidemark.operators import calendar as C
from tidemark.operators import reshape as R


def test_deduplicate(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    assert rows(R.deduplicate(df, ["user_id"], [F.desc("version")])) == [(1, "play", 2), (2, "pause", 1)]


def test_pivot(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    assert rows(df.groupBy("size").agg(*R.pivot("color", ["red", "blue", "blue's"]))) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    assert R.column_values(df, "color", max_records=1).first()["value"] == "red"
    with pytest.raises(ValueError):
        R.pivot("color", ["red"], agg="mode")


def test_unpivot(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1), "a", True, "n")], "id int, day date, status string, flag boolean, name string")
    got = R.unpivot(df, exclude=["id", "DAY"], remove=["name"], field_name="prop", value_name="val")
    assert rows(got) == [(1, dt.date(2020, 1, 1), "flag", "true"), (1, dt.date(2020, 1, 1), "status", "a")]


def test_union_relations(spark):
    a = spark.createDataFrame([(1, "x", 3), (2, "y", 4)], "id int, name string, n int")
    b = spark.createDataFrame([(3, "red", 5.0)], "id int, color string, n double")
    got = R.union_relations({"a": a, "b": b})
    assert got.columns == ["_source_relation", "id", "name", "n", "color"]
    assert rows(got) == [("a", 1, "x", 3, None), ("a", 2, "y", 4, None), ("b", 3, None, 5, "red")]
    assert R.union_relations({"a": a, "b": b}, exclude=["NAME"], source_column=None).columns == ["id", "n", "color"]
    assert R.union_relations({"a": a, "b": b}, {"n": "string"}, include=["n"]).schema["n"].dataType.simpleString() == "string"
    for bad in ({"include": ["a"], "exclude": ["b"]}, {"include": ["zzz"]}):
        with pytest.raises(ValueError):
            R.union_relations({"a": a, "b": b}, **bad)
    with pytest.raises(ValueError):
        R.union_tables_like(spark, "no_such_table_*")


def test_star_nullcheck_difference_series(spark):
    df = spark.createDataFrame([("", 1, None), ("a", 2, "")], "a string, b int, c string")
    assert rows(R.nullcheck_table(df)) == [("a", 2, None), (None, 1, None)]
    assert df.select(*R.star(df, ["B"], "p_", "_s")).columns == ["p_a_s", "p_c_s"]
    assert df.alias("t").select(*R.star(df, relation_alias="t")).columns == ["a", "b", "c"]
    assert rows(R.symmetric_difference(df.select("c"), df.limit(0).select("c"))) == [("a_minus_b", ""), ("a_minus_b", None)]
    assert values(R.generate_series(spark, 4)) == [1, 2, 3, 4]
    assert R.cross_series(df, 3).count() == 6


def test_spines(spark):
    days = values(C.date_spine(spark, "day", "2018-01-01", "2018-01-09"))
    assert len(days) == 9 and days[0] == dt.datetime(2018, 1, 1) and days[-1] == dt.datetime(2018, 1, 9)
    assert len(values(C.date_spine(spark, "month", "2018-01-01", "2018-06-30"))) == 6
    seconds = C.date_spine(spark, "second", "2018-01-01", "2018-01-09")
    per_task = seconds.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 8 * 86400 + 1 and len(per_task) > 1
    hours = values(C.date_spine(spark, "hour", "2018-01-01 10:15:00", "2018-01-03 11:00:00"))
    assert hours == [dt.datetime(2018, 1, 1, 10, 15) + dt.timedelta(hours=i) for i in range(49)]
    last = values(C.base_dates(spark, n_dateparts=3, as_of="2024-03-01"))
    assert [d.day for d in last] == [27, 28, 29, 1, 2]
    with pytest.raises(ValueError):
        C.base_dates(spark)


def test_date_dimension(spark):
    row = C.date_dimension(C.date_spine(spark, "day", "2020-11-29", "2020-11-29")).first().asDict()
    assert len(row) == 36
    expected = {"prior_year_date_day": "2019-11-29", "prior_year_over_year_date_day": "2019-12-01", "day_of_week": "1", "day_of_week_iso": "7", "quarter_end_date": "2020-12-31",
                "month_end_date": "2020-11-30", "year_end_date": "2020-12-31", "iso_week_of_year": "48", "prior_year_iso_week_start_date": "2019-11-25", "quarter_of_year": "4"}
    assert {k: str(row[k]) for k in expected} == expected


def test_fiscal_calendar(spark):
    dates = C.date_dimension(C.date_spine(spark, "day", "2015-01-01", "2024-12-31"))
    years = C.fiscal_year_dates(dates, year_end_month=1, week_start_day=1)
    ends = [r[0] for r in years.select("fiscal_year_end_date").distinct().collect()]
    assert ends and all(e.isoweekday() == 6 for e in ends)
    weeks = {r[0]: r[1] for r in years.groupBy("fiscal_year_number").agg(F.max("fiscal_week_of_year")).collect()}
    assert set(weeks.values()) == {52, 53}
    periods = C.fiscal_periods(dates, 1)
    lengths = {r[0]: r[1] for r in periods.filter("fiscal_year_number = 2018").groupBy("fiscal_period_number").agg(F.countDistinct("fiscal_week_of_year")).collect()}
    assert [lengths[p] for p in range(1, 13)] == [4, 5, 4] * 4
    long_year = next(y for y, w in weeks.items() if w == 53)
    last = periods.filter((F.col("fiscal_year_number") == long_year) & (F.col("fiscal_week_of_year") == 53)).first()
    assert (last["fiscal_period_number"], last["fiscal_quarter_number"], last["fiscal_period_of_quarter"]) == (12, 4, 3)
    assert C.calendar_with_fiscal(dates, year_end_month=1).count() == dates.count()
