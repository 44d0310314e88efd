"""Calendars over the date range of the given tables."""

from pyspark.sql import functions as F

from tidemark.operators import calendar as C
from tidemark.plans import inputs as I
from tidemark.workload.registry import Registry
from tidemark.workload.sql import with_

QUERIES = Registry()
add = QUERIES.add
T = I.table


def _days(s, d):
    return C.spine_between(T(s, d, "orders"), "o_orderdate")


def _dimension(s, d, first_day="monday"):
    return C.date_dimension(_days(s, d), first_day)


_SPINE = "spine AS (SELECT unnest(generate_series(date_trunc('day', min(o_orderdate)), date_trunc('day', max(o_orderdate)), INTERVAL 1 DAY)) AS date_day FROM orders)"
add("date_spine", lambda s, d: _days(s, d).join(T(s, d, "lineitem").groupBy(F.to_timestamp("l_shipdate").alias("date_day")).agg(F.count(F.lit(1)).alias("n")), "date_day", "left"),
    with_(_SPINE, "SELECT date_day, n FROM spine LEFT JOIN (SELECT CAST(l_shipdate AS TIMESTAMP) AS date_day, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1) USING (date_day)"))
add("date_spine_months", lambda s, d: C.spine_between(T(s, d, "orders"), "o_orderdate", "month"),
    "SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS date_month FROM orders")
add("base_dates",
    lambda s, d: C.base_dates(s, n_dateparts=30, as_of=I.ORDERS_AS_OF).join(
        T(s, d, "orders").groupBy(F.col("o_orderdate").cast("timestamp").alias("date_day")).agg(F.count(F.lit(1)).alias("orders")), "date_day", "left"),
    "SELECT g AS date_day, n AS orders FROM (SELECT unnest(generate_series(TIMESTAMP '2001-07-02', TIMESTAMP '2001-08-02', INTERVAL 1 DAY)) AS g) "
    "LEFT JOIN (SELECT CAST(o_orderdate AS TIMESTAMP) AS d, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1) ON g = d")
add("base_dates_hours",
    lambda s, d: C.base_dates(s, "2024-01-01", "2024-01-31", datepart="hour").join(
        T(s, d, "events").groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("date_hour")).agg(F.count(F.lit(1)).alias("n")), "date_hour", "left"),
    "SELECT g AS date_hour, n FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 HOUR)) AS g) "
    "LEFT JOIN (SELECT date_trunc('hour', CAST(ts AS TIMESTAMP)) AS h, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1) ON g = h")


def _dimension_sql(monday: bool) -> str:
    def week(col, which):
        if monday or which.startswith("iso"):
            start = f"CAST(date_trunc('week', {col}) AS DATE)"
            number = f"CAST(weekofyear({col}) AS INTEGER)"
        else:
            start = f"CAST({col} - CAST(dayofweek({col}) AS INTEGER) AS DATE)"
            number = f"CAST(ceil(dayofyear({col}) / 7.0) AS INTEGER)"
        return start, f"{start} + 6", number

    d, y, w = "d", "prior_year_date_day", "prior_year_over_year_date_day"
    (ws, we, wn), (iws, iwe, iwn) = week(d, "week"), week(d, "iso")
    (pws, pwe, pwn), (piws, piwe, piwn) = week(w, "week"), week(w, "iso")
    return with_(
        _SPINE + ", base AS (SELECT CAST(date_day AS DATE) AS d, CAST(CAST(date_day AS DATE) - INTERVAL 1 YEAR AS DATE) AS prior_year_date_day, "
        "CAST(date_day AS DATE) - 364 AS prior_year_over_year_date_day FROM spine)",
        f"""SELECT d AS date_day, prior_year_date_day, prior_year_over_year_date_day, d - 1 AS prior_date_day, d + 1 AS next_date_day,
        CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(isodow(d) AS INTEGER) AS day_of_week_iso, dayname(d) AS day_of_week_name,
        substr(dayname(d), 1, 3) AS day_of_week_name_short, CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
        {ws} AS week_start_date, {we} AS week_end_date, {wn} AS week_of_year,
        {pws} AS prior_year_week_start_date, {pwe} AS prior_year_week_end_date, {pwn} AS prior_year_week_of_year,
        {iws} AS iso_week_start_date, {iwe} AS iso_week_end_date, {iwn} AS iso_week_of_year,
        {piws} AS prior_year_iso_week_start_date, {piwe} AS prior_year_iso_week_end_date, {piwn} AS prior_year_iso_week_of_year,
        CAST(month(d) AS INTEGER) AS month_of_year, monthname(d) AS month_name, substr(monthname(d), 1, 3) AS month_name_short,
        CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date,
        CAST(date_trunc('month', {y}) AS DATE) AS prior_year_month_start_date, last_day({y}) AS prior_year_month_end_date,
        CAST(quarter(d) AS INTEGER) AS quarter_of_year, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date,
        CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date, CAST(year(d) AS INTEGER) AS year_number,
        CAST(date_trunc('year', d) AS DATE) AS year_start_date, CAST(date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end_date FROM base""",
    )


add("date_dimension", _dimension, _dimension_sql(True))
add("date_dimension_sunday", lambda s, d: _dimension(s, d, "sunday"), _dimension_sql(False))


def _fiscal(month: int) -> str:
    return (
        _SPINE + ", dim AS (SELECT CAST(date_day AS DATE) AS d FROM spine), "
        f"ends AS (SELECT year(d) - 1 AS fy, d + 6 AS e, rank() OVER (PARTITION BY year(d) ORDER BY abs(d + 6 - last_day(d))) AS r FROM dim WHERE month(d) = {month} AND dayofweek(d) = 0), "
        "years AS (SELECT fy, e, CAST(lag(e) OVER (ORDER BY e) + 1 AS DATE) AS s FROM ends WHERE r = 1), "
        "weeks AS (SELECT d AS ws, d + 6 AS we FROM dim WHERE dayofweek(d) = 0), "
        "fyd AS (SELECT d AS date_day, CAST(fy AS INTEGER) AS fiscal_year_number, s AS fiscal_year_start_date, e AS fiscal_year_end_date, ws AS week_start_date, we AS week_end_date, "
        "CAST(dense_rank() OVER (PARTITION BY fy ORDER BY ws) AS INTEGER) AS fiscal_week_of_year FROM dim JOIN years ON d BETWEEN s AND e JOIN weeks ON d BETWEEN ws AND we), "
        "fp AS (SELECT *, CAST(least((fiscal_week_of_year - 1) // 13, 3) AS INTEGER) AS q, CASE WHEN fiscal_week_of_year = 53 THEN 3 WHEN (fiscal_week_of_year - 1) % 13 <= 3 THEN 1 "
        "WHEN (fiscal_week_of_year - 1) % 13 <= 8 THEN 2 ELSE 3 END AS p FROM fyd), "
        "periods AS (SELECT date_day, fiscal_year_number, week_start_date, week_end_date, fiscal_week_of_year, CAST(dense_rank() OVER (PARTITION BY q * 3 + p ORDER BY fiscal_week_of_year) AS INTEGER) AS fiscal_week_of_period, "
        "q * 3 + p AS fiscal_period_number, q + 1 AS fiscal_quarter_number, p AS fiscal_period_of_quarter FROM fp)"
    )


add("fiscal_year_dates", lambda s, d: C.fiscal_year_dates(_dimension(s, d), 1), with_(_fiscal(1), "SELECT * FROM fyd"))
add("fiscal_periods", lambda s, d: C.fiscal_periods(_dimension(s, d), 12), with_(_fiscal(12), "SELECT * FROM periods"))
add("calendar_with_fiscal",
    lambda s, d: C.calendar_with_fiscal(_dimension(s, d), year_end_month=1).select("date_day", "year_number", "fiscal_week_of_year", "fiscal_week_of_period", "fiscal_period_number", "fiscal_quarter_number", "fiscal_period_of_quarter"),
    with_(_fiscal(1), "SELECT d AS date_day, CAST(year(d) AS INTEGER) AS year_number, fiscal_week_of_year, fiscal_week_of_period, fiscal_period_number, fiscal_quarter_number, fiscal_period_of_quarter FROM dim LEFT JOIN periods ON d = date_day"))
add("sales_by_fiscal_period",
    lambda s, d: I.fct_orders(s, d).withColumn("date_day", F.to_date("order_ts")).join(C.fiscal_periods(_dimension(s, d), 1), "date_day")
    .groupBy("fiscal_year_number", "fiscal_period_number").agg(F.sum("total_amount").cast("decimal(28,2)").alias("amount")),
    with_(_fiscal(1), "SELECT fiscal_year_number, fiscal_period_number, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount FROM orders JOIN periods ON CAST(o_orderdate AS DATE) = date_day GROUP BY 1, 2"))
