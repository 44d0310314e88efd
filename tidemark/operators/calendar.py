"""Date spines, the date dimension and the 4-5-4 fiscal calendar.

Every relation here has one row per calendar period: its size is set by the calendar, not by data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.session import shuffle_width

__all__ = [
    "period_rows",
    "date_spine",
    "spine_between",
    "base_dates",
    "date_dimension",
    "fiscal_year_dates",
    "fiscal_periods",
    "calendar_with_fiscal",
]


def period_rows(span: DataFrame, datepart: str) -> DataFrame:
    """One row per period between ``_lo`` and ``_hi`` of a one-row relation.

    Periods shorter than a day are made day by day: the days are dealt out to all tasks in order first, and no row
    carries a long array.
    """
    name = f"date_{datepart}"
    step = F.expr(f"INTERVAL 1 {datepart}")
    if datepart not in ("second", "minute", "hour"):
        return span.select(F.explode(F.sequence("_lo", "_hi", step)).alias(name))
    day = F.expr("INTERVAL 1 DAY")
    days = span.select("_hi", F.explode(F.sequence("_lo", "_hi", day)).alias("_day"))
    last = F.least(F.col("_hi"), F.col("_day") + day - step)
    days = days.repartitionByRange(shuffle_width(span.sparkSession), "_day")
    return days.select(F.explode(F.sequence("_day", last, step)).alias(name))


def _moment(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp")


def date_spine(spark: SparkSession, datepart: str, start, end) -> DataFrame:
    """All period starts from ``start`` up to and including ``end``."""
    return period_rows(spark.range(1).select(_moment(start).alias("_lo"), _moment(end).alias("_hi")), datepart)


def spine_between(df: DataFrame, column: str, datepart: str = "day") -> DataFrame:
    """Spine over the value range of a column, found by Spark without a driver round trip."""
    moment = F.date_trunc(datepart, F.col(column).cast("timestamp"))
    return period_rows(df.agg(F.min(moment).alias("_lo"), F.max(moment).alias("_hi")), datepart)


def base_dates(
    spark: SparkSession,
    start=None,
    end=None,
    n_dateparts: int | None = None,
    datepart: str = "day",
    as_of=None,
) -> DataFrame:
    """Explicit range, or the last ``n_dateparts`` periods up to the day after ``as_of``."""
    if start is not None and end is not None:
        return date_spine(spark, datepart, start, end)
    if n_dateparts is None or as_of is None:
        raise ValueError("give start and end, or n_dateparts and as_of")
    today = _moment(as_of).cast("date")
    low = D.add_periods(today.cast("timestamp"), -n_dateparts, datepart)
    return date_spine(spark, datepart, low, F.date_add(today, 1))


def date_dimension(spine: DataFrame, first_day: str = "monday") -> DataFrame:
    """Calendar columns for a relation with a ``date_day`` column."""
    day = F.col("date_day")
    year_ago = F.col("prior_year_date_day")
    weeks_ago = F.col("prior_year_over_year_date_day")
    base = spine.select(F.col("date_day").cast("date").alias("date_day")).withColumns(
        {
            "prior_year_date_day": F.add_months(day, -12),
            "prior_year_over_year_date_day": F.date_sub(day, 364),
        }
    )

    def quarter_start(d: Column) -> Column:
        return F.trunc(d, "quarter")

    columns = {
        "prior_date_day": D.yesterday(day),
        "next_date_day": D.tomorrow(day),
        "day_of_week": D.day_of_week(day, isoweek=False),
        "day_of_week_iso": D.day_of_week(day, isoweek=True),
        "day_of_week_name": D.day_name(day, short=False),
        "day_of_week_name_short": D.day_name(day, short=True),
        "day_of_month": D.day_of_month(day),
        "day_of_year": D.day_of_year(day),
        "week_start_date": D.week_start(day, first_day),
        "week_end_date": D.week_end(day, first_day),
        "week_of_year": D.week_of_year(day, first_day),
        "prior_year_week_start_date": D.week_start(weeks_ago, first_day),
        "prior_year_week_end_date": D.week_end(weeks_ago, first_day),
        "prior_year_week_of_year": D.week_of_year(weeks_ago, first_day),
        "iso_week_start_date": D.iso_week_start(day),
        "iso_week_end_date": D.iso_week_end(day),
        "iso_week_of_year": D.iso_week_of_year(day),
        "prior_year_iso_week_start_date": D.iso_week_start(weeks_ago),
        "prior_year_iso_week_end_date": D.iso_week_end(weeks_ago),
        "prior_year_iso_week_of_year": D.iso_week_of_year(weeks_ago),
        "month_of_year": F.month(day),
        "month_name": D.month_name(day, short=False),
        "month_name_short": D.month_name(day, short=True),
        "month_start_date": F.trunc(day, "month"),
        "month_end_date": F.last_day(day),
        "prior_year_month_start_date": F.trunc(year_ago, "month"),
        "prior_year_month_end_date": F.last_day(year_ago),
        "quarter_of_year": F.quarter(day),
        "quarter_start_date": quarter_start(day),
        "quarter_end_date": F.date_sub(F.add_months(quarter_start(day), 3), 1),
        "year_number": F.year(day),
        "year_start_date": F.trunc(day, "year"),
        "year_end_date": F.date_sub(F.add_months(F.trunc(day, "year"), 12), 1),
    }
    return base.withColumns(columns)


def fiscal_year_dates(
    dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """Days of each fiscal year; a year ends on the week end nearest to the end of its last month.

    ``dates`` is a date dimension. ``week_start_day`` counts Sunday as 1.
    """
    closing = F.col("month_of_year") == year_end_month
    fiscal = (F.col("year_number") - shift_year).alias("fiscal_year_number")
    week_starts = dates.filter(F.col("day_of_week") == week_start_day)
    # weeks that start in the closing month, ranked by distance to that month's last day
    nearness = Window.partitionBy("fiscal_year_number").orderBy("_distance")
    year_ends = (
        week_starts.filter(closing)
        .select(
            fiscal,
            F.date_add("date_day", 6).alias("fiscal_year_end_date"),
            F.abs(F.date_diff(F.date_add("date_day", 6), F.col("month_end_date"))).alias("_distance"),
        )
        .distinct()
        .withColumn("_rank", F.rank().over(nearness))
        .filter(F.col("_rank") == 1)
        .select("fiscal_year_number", "fiscal_year_end_date")
    )
    # one row per year: the single-partition window is bounded by the calendar
    by_end = Window.partitionBy(F.lit(0)).orderBy("fiscal_year_end_date")
    ranges = year_ends.withColumn(
        "fiscal_year_start_date", F.date_add(F.lag("fiscal_year_end_date").over(by_end), 1)
    ).filter(F.col("fiscal_year_start_date").isNotNull())
    # range joins as equi joins: each year and each week is expanded to its days
    year_days = ranges.withColumn(
        "date_day", F.explode(F.sequence("fiscal_year_start_date", "fiscal_year_end_date"))
    )
    week_days = week_starts.select(
        F.col("date_day").alias("week_start_date"), F.date_add("date_day", 6).alias("week_end_date")
    ).withColumn("date_day", F.explode(F.sequence("week_start_date", "week_end_date")))
    in_year = Window.partitionBy("fiscal_year_number").orderBy("week_start_date")
    return (
        dates.select("date_day")
        .join(year_days, "date_day")
        .join(week_days, "date_day")
        .select(
            "date_day",
            "fiscal_year_number",
            "fiscal_year_start_date",
            "fiscal_year_end_date",
            "week_start_date",
            "week_end_date",
            F.dense_rank().over(in_year).alias("fiscal_week_of_year"),
        )
    )


def fiscal_periods(
    dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """4-5-4 periods: quarters of 13 weeks, week 53 joins the last period."""
    week = F.col("fiscal_week_of_year")
    week_of_quarter = (week - 1) % 13
    quarter = F.least(F.floor((week - 1) / 13), F.lit(3)).cast("int")
    period = (
        F.when((week == 53) | (week_of_quarter >= 9), 3).when(week_of_quarter >= 4, 2).otherwise(1)
    )
    by_period = Window.partitionBy("fiscal_period_number").orderBy("fiscal_week_of_year")
    return (
        fiscal_year_dates(dates, year_end_month, week_start_day, shift_year)
        .withColumn("fiscal_quarter_number", quarter + 1)
        .withColumn("fiscal_period_of_quarter", period)
        .withColumn("fiscal_period_number", quarter * 3 + period)
        .withColumn("fiscal_week_of_period", F.dense_rank().over(by_period))
        .select(
            "date_day",
            "fiscal_year_number",
            "week_start_date",
            "week_end_date",
            "fiscal_week_of_year",
            "fiscal_week_of_period",
            "fiscal_period_number",
            "fiscal_quarter_number",
            "fiscal_period_of_quarter",
        )
    )


def calendar_with_fiscal(dates: DataFrame, **options) -> DataFrame:
    """Date dimension with the fiscal columns; days outside a complete fiscal year get NULL."""
    fiscal = fiscal_periods(dates, **options).select(
        "date_day",
        "fiscal_week_of_year",
        "fiscal_week_of_period",
        "fiscal_period_number",
        "fiscal_quarter_number",
        "fiscal_period_of_quarter",
    )
    return dates.join(fiscal, "date_day", "left")
