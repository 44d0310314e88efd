import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, values
from tidemark.operators import checks as Q


@pytest.fixture
def base(spark):
    """Four rows with every kind of column."""
    return spark.createDataFrame(
        [
            (1, "2020-10-21", 0.0, 1.0, "a", "b", None, "a"),
            (2, "2020-10-22", 1.0, 0.0, "b", "ab", None, "A"),
            (3, "2020-10-23", 0.5, 0.5, "c", "abc", None, "c"),
            (4, "2020-10-23", 0.5, 0.5, "c", "abcd", None, "C"),
        ],
        "idx int, day string, x double, y double, s string, t string, n string, k string",
    )


def passes(df):
    return df.isEmpty()


def test_null_rules_differ(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert passes(Q.accepted_values(df, "v", ["a", "b"]))
    assert rows(Q.values_in_set(df, "v", ["a", "b"])) == [(None,)]
    assert rows(Q.distinct_values_in_set(df, "v", ["a", "b"])) == [(None,)]
    assert passes(Q.values_not_in_set(df, "v", ["z"]))
    assert passes(Q.lengths_equal(df, "v", 1))
    assert rows(Q.not_null(df, "v")) == [(None,)]
    numbers = spark.createDataFrame([(1,), (None,)], "v int")
    assert passes(Q.accepted_range(numbers, "v", 0, 5)) and not passes(Q.accepted_range(numbers, "v", 2))


def test_between(base):
    assert passes(Q.values_between(base, "x", 0, 1))
    assert len(rows(Q.values_between(base, "x", 0, 1, strictly=True))) == 2
    assert passes(Q.values_between(base, "x", 0, 1, strictly=True, row_condition="idx > 2"))
    with pytest.raises(ValueError):
        Q.values_between(base, "x")


def test_aggregates(base):
    assert passes(Q.max_between(base, "x", 1, 1)) and passes(Q.min_between(base, "x", 0, 0))
    assert passes(Q.mean_between(base, "x", 0.5, 0.5)) and passes(Q.sum_between(base, "x", 2, 2))
    assert passes(Q.median_between(base, "x", 0.5, 0.5)) and passes(Q.stdev_between(base, "x", 0.4, 0.41))
    assert passes(Q.quantile_between(base, "x", 0.75, 0.6, 0.65))
    assert passes(Q.unique_count_between(base, "x", 3, 3)) and passes(Q.unique_proportion_between(base, "x", 0.75, 0.75))
    assert rows(Q.max_between(base, "x", max_value=0.9, group_by=["s"])) == [("b", 1.0, False)]
    assert passes(Q.distinct_count_equals(base, "s", 3)) and not passes(Q.distinct_count_less(base, "s", 3))
    assert passes(Q.distinct_count_greater(base, "s", 2)) and passes(Q.distinct_count_equals_other(base, "s", base, "x"))


def test_sets(base):
    assert rows(Q.distinct_values_contain_set(base, "s", ["a", "z"])) == [("z",)]
    assert rows(Q.distinct_values_equal_set(base, "s", ["a", "b", "z"])) == [("c", None), (None, "z")]
    assert passes(Q.distinct_values_equal_set(base, "s", ["c", "b", "a"]))
    assert passes(Q.most_common_value_in_set(base, "s", ["c"], 1)) and rows(Q.most_common_value_in_set(base, "s", ["c"], 2)) == [("a",)]
    assert rows(Q.not_accepted_values(base, "s", ["c", "q"])) == [("c",)]


def test_records(base):
    assert passes(Q.pair_greater(base, "x", "y", or_equal=True, row_condition="idx > 1"))
    assert len(rows(Q.pair_equal(base, "x", "y"))) == 2
    assert len(rows(Q.pair_in_set(base, "x", "y", [(0, 1), (1, 0)]))) == 2
    with pytest.raises(ValueError):
        Q.pair_in_set(base, "x", "y", [(1, 2, 3)])
    assert passes(Q.multicolumn_sum(base, ["x", "y"], 4)) and not passes(Q.multicolumn_sum(base, ["x", "y"], "idx"))
    assert rows(Q.compound_unique(base, ["day", "s"])) == [("2020-10-23", "c", 2)]
    assert passes(Q.values_unique(base, "n")) and passes(Q.unique(base, "n"))
    assert rows(Q.unique_within_record(base, ["x", "y"]).select("idx", "column_values")) == [(3, 1), (4, 1)]
    assert rows(Q.unique_within_record(base, ["s", "n"]).select("idx")) == [(1,), (2,), (3,), (4,)]
    assert passes(Q.unique_within_record(base, ["s", "n"], "any_value_is_missing"))
    assert passes(Q.compound_unique(base, ["n"]))
    with pytest.raises(ValueError):
        Q.compound_unique(base, ["n"], "sometimes")


def test_casing_and_types(base):
    assert rows(Q.consistent_casing(base, "k")) == [(4, 2)] and passes(Q.consistent_casing(base, "s"))
    assert rows(Q.consistent_casing(base, "k", True)) == [("a", 2), ("c", 2)]
    assert passes(Q.values_of_type(base, "day", "date")) and len(rows(Q.values_of_type(base, "day", ["bigint", "double"]))) == 4
    assert passes(Q.schema_type_in(base, "idx", ["int", "bigint"])) and rows(Q.schema_type_in(base, "IDX", "date")) == [("IDX", "int")]


def test_strings(spark):
    df = spark.createDataFrame([("a@b.com", "12345"), ("x@y.org", "12345-678"), ("nope", None)], "m string, z string")
    assert rows(Q.match_regex(df, "m", "^[a-z]+@").select("m")) == [("nope",)]
    assert passes(Q.match_regex(df, "m", "^[A-Z]", flags="i")) and passes(Q.match_regex(df, "z", "^[0-9]{5}"))
    assert len(rows(Q.not_match_regex(df, "m", "@"))) == 2
    assert passes(Q.match_regex_list(df, "m", ["@", "^no"])) and len(rows(Q.match_regex_list(df, "m", ["@", "com$"], "all"))) == 2
    assert passes(Q.not_match_regex_list(df, "m", ["com$", "org$"])) and len(rows(Q.not_match_regex_list(df, "m", ["com$", "org$"], "all"))) == 2
    assert len(rows(Q.match_like(df, "m", "%@%"))) == 1 and passes(Q.match_like_list(df, "m", ["%@%", "no%"]))
    assert len(rows(Q.match_like_list(df, "m", ["%@%", "%com"], "all"))) == 2
    assert passes(Q.not_match_like_list(df, "m", ["%com", "%org"])) and len(rows(Q.not_match_like(df, "m", "%com"))) == 1
    assert len(rows(Q.lengths_between(df, "z", 1, 5))) == 1
    with pytest.raises(ValueError):
        Q.match_like_list(df, "m", ["a"], "most")


RANGES = [(1, "2019-01-01", "2020-01-01"), (3, "2019-01-01", "2019-07-01"), (3, "2019-09-01", None), (4, "2018-01-01", "2019-02-01")]


@pytest.mark.parametrize(
    "data,gaps,zero,bad",
    [
        ([(0, 1), (1, 2), (2, 4)], "not_allowed", False, []),
        ([(0, 1), (1, 2), (2, 4)], "required", False, [(0, 1), (1, 2)]),
        ([(0, 1), (2, 3)], "not_allowed", False, [(0, 1)]),
        ([(0, 1), (2, 3)], "allowed", False, []),
        ([(0, 3), (2, 5)], "allowed", False, [(0, 3)]),
        ([(0, 0), (1, 2)], "allowed", False, [(0, 0)]),
        ([(0, 0), (1, 2)], "allowed", True, []),
        ([(3, 1)], "allowed", False, [(3, 1)]),
        ([(0, None)], "allowed", False, [(0, None)]),
    ],
)
def test_exclusive_ranges(spark, data, gaps, zero, bad):
    df = spark.createDataFrame(data, "lo int, hi int")
    assert rows(Q.mutually_exclusive_ranges(df, "lo", "hi", None, gaps, zero).select("lo", "hi")) == bad
    with pytest.raises(ValueError):
        Q.mutually_exclusive_ranges(df, "lo", "hi", gaps="maybe")


def test_exclusive_ranges_by_group(spark):
    df = spark.createDataFrame(RANGES, "id int, a string, b string").select("id", F.col("a").cast("date").alias("a"), F.coalesce(F.col("b").cast("date"), F.lit("2099-12-31").cast("date")).alias("b"))
    assert passes(Q.mutually_exclusive_ranges(df, "a", "b", ["id"], "required"))
    assert len(rows(Q.mutually_exclusive_ranges(df, "a", "b", ["id"], "not_allowed"))) == 1


def test_sequences(spark):
    df = spark.createDataFrame([(g, v) for g in (1, 2) for v in (2, 4, 6, 8, 10)], "g int, v int")
    assert passes(Q.sequential_values(df, "v", 2, group_by=["g"])) and not passes(Q.sequential_values(df, "v", 2))
    hours = spark.createDataFrame([(dt.datetime(2021, 1, 1, h),) for h in range(4)], "t timestamp")
    assert passes(Q.sequential_values(hours, "t", 1, "hour")) and len(rows(Q.sequential_values(hours, "t", 2, "hour"))) == 3


def test_between_tables(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "g int, v int")
    b = spark.createDataFrame([(1, 1), (1, 5), (2, 3), (2, 4), (3, 9)], "g int, v int")
    assert rows(Q.equal_rowcount(a, b)) == [(3, 5, 2)] and passes(Q.equal_rowcount(a, a, ["g"]))
    assert rows(Q.equal_rowcount(a, b, ["g"])) == [(2, 1, 2, 1)]
    assert passes(Q.fewer_rows_than(a, b)) and rows(Q.fewer_rows_than(a, b, ["g"])) == [(1, 2, 2, 1)]
    assert rows(Q.fewer_rows_than(b, a)) == [(5, 3, 2)] and rows(Q.fewer_rows_than(a, a)) == [(3, 3, 1)]
    assert rows(Q.equality(a, b, ["g"])) == [("b_minus_a", 3)] and passes(Q.equality(a.unionByName(a), a))
    assert rows(Q.cardinality_equality(a, "g", b, "g")) == [("a_minus_b", 2, 1), ("b_minus_a", 2, 2), ("b_minus_a", 3, 1)]
    assert rows(Q.relationships(b, "g", a, "g")) == [(3, 1)] and passes(Q.relationships(b, "g", a, "g", "g <> 3"))
    assert passes(Q.row_count_equals_other(a, a.unionByName(a), 0.5)) and passes(Q.row_count_equals(a, 3))
    assert rows(Q.row_count_equals_other(a, b, group_by=["g"]).select("g", "expression", "compare_expression")) == [(2, 1, 2), (3, None, 1)]
    assert passes(Q.aggregation_equals_other(a, F.sum("v"), b, tolerance=16)) and passes(Q.aggregation_equals_other(a, "sum(v)", b, tolerance_percent=3))
    with pytest.raises(ValueError):
        Q.equal_expression(a, "sum(v)", b, group_by=["g"], compare_group_by=["g", "v"])


def test_group_rules(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (2, None), (3, 7), (3, 7)], "g int, v int")
    assert rows(Q.at_least_one(df, "v", ["g"])) == [(2, 0)] and passes(Q.at_least_one(df, "v"))
    assert rows(Q.not_constant(df, "v", ["g"])) == [(1, 1), (3, 1)] and passes(Q.not_constant(df, "v"))
    assert rows(Q.not_null_proportion(df, "v", 0.6, group_by=["g"])) == [(1, 0.5), (2, 0.0)]


def test_recency(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2030, 1, 1)), (2, dt.datetime(2024, 1, 9))], "g int, t timestamp")
    as_of = "2024-01-10 00:00:00"
    assert passes(Q.recency(df, "t", "day", 2, as_of)) and passes(Q.recent_data(df, "t", "day", 2, as_of))
    assert rows(Q.grouped_recent_data(df, ["g"], "t", "day", 2, as_of)) == [(1, dt.datetime(2024, 1, 1))]
    assert rows(Q.recent_data(df, "t", "day", 2, as_of, "g = 5")) == [(None,)]


def test_spread(spark):
    df = spark.createDataFrame([(g, 1.0) for g in range(20)] + [(99, 500.0)], "g int, v double")
    assert values(Q.within_n_stdevs(df, "v", ["g"])) == [99]
    days = [(dt.datetime(2024, 1, d), 100.0 + d % 2) for d in range(1, 29)] + [(dt.datetime(2024, 1, 29), 900.0)]
    series = spark.createDataFrame(days, "t timestamp, v double")
    bad = Q.within_n_moving_stdevs(series, "v", "t", "2024-01-30 05:00:00", take_diffs=False)
    assert values(bad.select("metric_period")) == [dt.datetime(2024, 1, 29)]


def test_missing_periods(spark):
    days = [dt.datetime(2020, 1, d, 7) for d in (1, 2, 3, 11, 12)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp")
    assert [d.day for d in values(Q.data_for_every_n_datepart(df, "t").orderBy("date_day"))] == [4, 5, 6, 7, 8, 9, 10]
    assert [d.day for d in values(Q.data_for_every_n_datepart(df, "t", interval=2).orderBy("date_day"))] == [5, 7, 9]
    kept = Q.data_for_every_n_datepart(df, "t", exclusion_condition="dayofweek(date_day) not in (1, 7)", start="2020-01-03", end="2020-01-06")
    assert [d.day for d in values(kept)] == [6]


def test_fields(base):
    fields = Q.schema_fields(base)
    assert passes(Q.field_exists(fields, "IDX", 0)) and rows(Q.field_exists(fields, "idx", 3)) == [("idx",)]
    assert passes(Q.field_count_equals(fields, 8)) and passes(Q.field_count_between(fields, 1, 9)) and passes(Q.field_count_equals_other(fields, fields))
    assert rows(Q.fields_contain_set(fields, ["idx", "zz"])) == [("zz",)] and rows(Q.fields_not_contain_set(fields, ["idx", "zz"])) == [("idx",)]
    assert passes(Q.fields_match_set(fields, base.columns[::-1])) and passes(Q.fields_match_ordered_list(fields, base.columns))
    assert not passes(Q.fields_match_ordered_list(fields, base.columns[::-1]))
