"""Scalar functions over whole tables."""

from pyspark.sql import functions as F

from tidemark import functions as X
from tidemark.plans import inputs as I
from tidemark.workload.registry import Registry

QUERIES = Registry()
add = QUERIES.add
T = I.table
ORDERS = I.ORDERS_AS_OF

add("surrogate_key",
    lambda s, d: I.payments(s, d).select("payment_id", X.surrogate_key("order_id", "status", "failure_reason").alias("sk")),
    "SELECT l_orderkey * 8 + l_linenumber AS payment_id, md5(CAST(l_orderkey AS VARCHAR) || '-' || CASE l_returnflag WHEN 'N' THEN 'captured' WHEN 'R' THEN 'refunded' WHEN 'A' THEN 'failed' END "
    "|| '-' || CASE WHEN l_returnflag = 'A' THEN 'declined' ELSE '_dbt_utils_surrogate_key_null_' END) AS sk FROM lineitem")


def _gaps(s, d):
    """Two numbers per line, each missing on some rows."""
    line = T(s, d, "lineitem")
    return line.select("l_orderkey", "l_partkey", "l_linenumber", F.when(F.col("l_returnflag") != "A", F.col("l_quantity").cast("bigint")).alias("a"),
                       F.when(F.col("l_linestatus") != "F", F.col("l_suppkey")).alias("b"))


_GAPS = ("(SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS BIGINT) END AS a, CASE WHEN l_linestatus <> 'F' THEN l_suppkey END AS b FROM lineitem)")
add("safe_math",
    lambda s, d: _gaps(s, d).select("l_orderkey", X.safe_add("a", "b", "l_linenumber").alias("added"), X.safe_subtract("a", "b").alias("subtracted"), X.safe_divide("a", "b").alias("divided")),
    f"SELECT l_orderkey, COALESCE(a, 0) + COALESCE(b, 0) + l_linenumber AS added, COALESCE(a, 0) - COALESCE(b, 0) AS subtracted, CAST(a AS DOUBLE) / NULLIF(CAST(b AS DOUBLE), 0) AS divided FROM {_GAPS}")
add("haversine_distance",
    lambda s, d: T(s, d, "customer").select("c_custkey", *[F.round(X.haversine_distance(F.col("c_acctbal") / 200, F.col("c_nationkey") * 7.0, F.lit(48.1), F.lit(11.6), u), 4).alias(u) for u in ("mi", "km")]),
    "SELECT c_custkey, round(x, 4) AS mi, round(x * 1.60934, 4) AS km FROM (SELECT c_custkey, 2 * 3961 * asin(sqrt(power(sin(radians(48.1 - c_acctbal / 200) / 2), 2) + cos(radians(c_acctbal / 200)) * cos(radians(48.1)) "
    "* power(sin(radians(11.6 - c_nationkey * 7.0) / 2), 2))) AS x FROM customer)")
add("width_bucket",
    lambda s, d: T(s, d, "customer").select("c_custkey", X.width_bucket("c_acctbal", 0, 8000, 8).alias("bucket")),
    "SELECT c_custkey, CAST(CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal >= 8000 THEN 9 ELSE floor(c_acctbal / 1000) + 1 END AS BIGINT) AS bucket FROM customer")
add("url_parts",
    lambda s, d: T(s, d, "pages").select("page_id", X.url_host("url").alias("host"), X.url_path("url").alias("path"), X.url_parameter("url", "page").alias("page"), X.url_parameter("url", "ref").alias("ref")),
    "SELECT page_id, split_part(split_part(bare, '/', 1), '?', 1) AS host, split_part(substr(bare, instr(bare, '/') + 1), '?', 1) AS path, "
    "NULLIF(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page, NULLIF(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref "
    "FROM (SELECT *, replace(replace(url, 'http://', ''), 'https://', '') AS bare FROM pages)")
add("regexp_instr",
    lambda s, d: T(s, d, "documents").select("doc_id", X.regexp_instr("text", "[0-9]").alias("digit"), X.regexp_instr("text", "[A-Z]", flags="i").alias("letter"), X.regexp_instr("text", "[aeiou]", occurrence=3).alias("third_vowel"),
                                             X.regexp_instr("text", "e", position=10).alias("late_e")),
    "SELECT doc_id, CAST(CASE WHEN regexp_matches(text, '[0-9]') THEN length(regexp_extract(text, '(?s)^([^0-9]*)[0-9]', 1)) + 1 ELSE 0 END AS INTEGER) AS digit, "
    "CAST(CASE WHEN regexp_matches(text, '[A-Za-z]') THEN length(regexp_extract(text, '(?s)^([^A-Za-z]*)[A-Za-z]', 1)) + 1 ELSE 0 END AS INTEGER) AS letter, "
    "CAST(CASE WHEN regexp_matches(text, '(?s)^([^aeiou]*[aeiou]){3}') THEN length(regexp_extract(text, '(?s)^((?:[^aeiou]*[aeiou]){2}[^aeiou]*)[aeiou]', 1)) + 1 ELSE 0 END AS INTEGER) AS third_vowel, "
    "CAST(CASE WHEN instr(substr(text, 10), 'e') > 0 THEN instr(substr(text, 10), 'e') + 9 ELSE 0 END AS INTEGER) AS late_e FROM documents")
add("log_natural",
    lambda s, d: T(s, d, "customer").select("c_custkey", F.round(X.log_natural("c_acctbal"), 8).alias("log")),
    "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN round(ln(c_acctbal), 8) END AS log FROM customer")
add("uniform_bounds",
    lambda s, d: T(s, d, "events").withColumn("u", X.uniform(7)).agg(F.count_if(F.col("u").between(0, 0.999999999999)).alias("inside"), F.count(F.lit(1)).alias("n")),
    "SELECT CAST(count(*) AS BIGINT) AS inside, CAST(count(*) AS BIGINT) AS n FROM events")
add("like_pattern",
    lambda s, d: T(s, d, "pages").select("page_id", X.like_pattern("url", "%.com/%").alias("com"), X.like_pattern("url", "%page=%", False).alias("no_page")),
    "SELECT page_id, url LIKE '%.com/%' AS com, url NOT LIKE '%page=%' AS no_page FROM pages")
add("mask_partial",
    lambda s, d: T(s, d, "customer").select("c_custkey", X.mask_partial("c_name", 8).alias("masked")),
    "SELECT c_custkey, substr(c_name, 1, 8) || repeat('*', greatest(length(c_name) - 8, 0)) AS masked FROM customer")
add("decode_decimal",
    lambda s, d: T(s, d, "customer").select("c_custkey", X.decode_decimal(
        F.base64(F.unhex(F.lpad(F.right(F.hex((F.col("c_acctbal") * 100).cast("decimal(18,0)").cast("bigint")), F.lit(8)), 8, "0")))).alias("amount")),
    "SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS amount FROM customer")
add("json_fields",
    lambda s, d: T(s, d, "events").select("event_id", F.from_json("props", "k bigint, missing string").alias("p")).select("event_id", "p.k", "p.missing"),
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing FROM events")

D = "CAST(o_orderdate AS DATE)"


def _dates(name, build, sql):
    add(name, lambda s, d: T(s, d, "orders").select("o_orderkey", *build(F.col("o_orderdate"))), f"SELECT o_orderkey, {sql} FROM orders")


_dates("date_parts",
       lambda c: [X.date_part("quarter", c).alias("quarter"), X.day_of_month(c).alias("day"), X.day_of_year(c).alias("doy"), X.day_of_week(c).alias("iso_dow"), X.day_of_week(c, False).alias("us_dow"),
                  X.day_name(c).alias("dn"), X.day_name(c, False).alias("day_name"), X.month_name(c).alias("mn"), X.month_name(c, False).alias("month_name")],
       f"CAST(quarter({D}) AS INTEGER) AS quarter, CAST(day({D}) AS INTEGER) AS day, CAST(dayofyear({D}) AS INTEGER) AS doy, CAST(isodow({D}) AS INTEGER) AS iso_dow, CAST(dayofweek({D}) + 1 AS INTEGER) AS us_dow, "
       f"substr(dayname({D}), 1, 3) AS dn, dayname({D}) AS day_name, substr(monthname({D}), 1, 3) AS mn, monthname({D}) AS month_name")
_dates("weeks",
       lambda c: [X.week_start(c).alias("ws"), X.week_end(c).alias("we"), X.week_of_year(c).alias("wn"), X.week_start(c, "sunday").alias("sws"), X.week_end(c, "sunday").alias("swe"), X.week_of_year(c, "sunday").alias("swn"),
                  X.iso_week_start(c).alias("iws"), X.iso_week_end(c).alias("iwe"), X.iso_week_of_year(c).alias("iwn")],
       f"CAST(date_trunc('week', {D}) AS DATE) AS ws, CAST(date_trunc('week', {D}) AS DATE) + 6 AS we, CAST(weekofyear({D}) AS INTEGER) AS wn, "
       f"{D} - CAST(dayofweek({D}) AS INTEGER) AS sws, {D} - CAST(dayofweek({D}) AS INTEGER) + 6 AS swe, CAST(ceil(dayofyear({D}) / 7.0) AS INTEGER) AS swn, "
       f"CAST(date_trunc('week', {D}) AS DATE) AS iws, CAST(date_trunc('week', {D}) AS DATE) + 6 AS iwe, CAST(weekofyear({D}) AS INTEGER) AS iwn")
_dates("relative_days",
       lambda c: [X.yesterday(c).alias("yesterday"), X.tomorrow(c).alias("tomorrow"), X.n_days_ago(10, c).alias("ago"), X.n_days_away(10, c).alias("away")],
       f"{D} - 1 AS yesterday, {D} + 1 AS tomorrow, {D} - 10 AS ago, {D} + 10 AS away")
_dates("relative_weeks_months",
       lambda c: [X.n_weeks_ago(3, c).alias("wago"), X.n_weeks_away(3, c).alias("waway"), X.n_months_ago(2, c).alias("mago"), X.n_months_away(2, c).alias("maway"),
                  X.last_week(c).alias("last_week"), X.next_week(c).alias("next_week"), X.last_month(c).alias("last_month"), X.next_month(c).alias("next_month"),
                  X.last_month_name(c).alias("lmn"), X.next_month_name(c, False).alias("nmn"), X.last_month_number(c).alias("lmo"), X.next_month_number(c).alias("nmo")],
       f"CAST(date_trunc('week', {D} - 21) AS DATE) AS wago, CAST(date_trunc('week', {D} + 21) AS DATE) AS waway, CAST(date_trunc('month', {D} - INTERVAL 2 MONTH) AS DATE) AS mago, CAST(date_trunc('month', {D} + INTERVAL 2 MONTH) AS DATE) AS maway, "
       f"CAST(date_trunc('week', {D} - 7) AS DATE) AS last_week, CAST(date_trunc('week', {D} + 7) AS DATE) AS next_week, CAST(date_trunc('month', {D} - INTERVAL 1 MONTH) AS DATE) AS last_month, CAST(date_trunc('month', {D} + INTERVAL 1 MONTH) AS DATE) AS next_month, "
       f"substr(monthname({D} - INTERVAL 1 MONTH), 1, 3) AS lmn, monthname({D} + INTERVAL 1 MONTH) AS nmn, CAST(month({D} - INTERVAL 1 MONTH) AS INTEGER) AS lmo, CAST(month({D} + INTERVAL 1 MONTH) AS INTEGER) AS nmo")
_dates("periods_since",
       lambda c: [X.periods_since(c, ORDERS, p).cast("bigint").alias(p) for p in ("day", "week", "month", "year")],
       ", ".join(f"CAST(datediff('{p}', date_trunc('{p}', {D}), date_trunc('{p}', DATE '2001-08-01')){' ' if p != 'week' else ''} AS BIGINT) AS {p}" for p in ("day", "week", "month", "year")))


def _moments(name, build, sql):
    add(name, lambda s, d: T(s, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("t")).select("event_id", *build(F.col("t"))),
        f"SELECT event_id, {sql} FROM (SELECT event_id, CAST(ts AS TIMESTAMP) AS t FROM events)")


_moments("round_timestamp", lambda c: [X.round_timestamp(c).alias("rounded")], "CAST(date_trunc('day', t + INTERVAL 12 HOUR) AS TIMESTAMP) AS rounded")
_moments("unix_timestamps",
         lambda c: [X.to_unixtimestamp(c).alias("epoch"), X.from_unixtimestamp(F.unix_timestamp(c)).alias("s"), X.from_unixtimestamp(F.unix_millis(c), "milliseconds").alias("ms"), X.from_unixtimestamp(F.unix_micros(c), "microseconds").alias("us")],
         "epoch_us(t) // 1000000 AS epoch, date_trunc('second', t) AS s, date_trunc('millisecond', t) AS ms, t AS us")
_moments("convert_timezone",
         lambda c: [X.convert_timezone(c, "America/Los_Angeles").alias("la"), X.convert_timezone(c, "UTC", "Europe/Berlin").alias("utc")],
         "t - INTERVAL 8 HOUR AS la, t - INTERVAL 1 HOUR AS utc")
_moments("now_and_today",
         lambda c: [X.now_in(c, "Asia/Tokyo").alias("tokyo"), X.today(c, "Asia/Tokyo").alias("tokyo_day"), X.today(c).alias("utc_day")],
         "t + INTERVAL 9 HOUR AS tokyo, CAST(t + INTERVAL 9 HOUR AS DATE) AS tokyo_day, CAST(t AS DATE) AS utc_day")
