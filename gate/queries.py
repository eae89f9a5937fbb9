"""One query per operator, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gate import fixtures as fx
from gate import oracle as o
from gate.fixtures import SETTINGS, table
from gate.oracle import query
from wayside import config as cfg
from wayside.functions import numeric as num
from wayside.functions import temporal as tm
from wayside.functions import text as tx
from wayside.operators import aggregates as agg
from wayside.operators import cleaning as cl
from wayside.operators import features as ft
from wayside.operators import profiling as pf
from wayside.operators import reconcile as rc
from wayside.operators import rules as ru
from wayside.operators import star as st
from wayside.operators.exact import sum_by
from wayside.plans import jobs
from wayside.session import materialize, scratch_path
from wayside.sources import tables as io

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

TEMP, VIS, RAIN = cfg.SENSOR_COLS
# the same columns in SQL
T, V, P = (o.ident(c) for c in cfg.SENSOR_COLS)


def register(name: str, sql: str | None = None):
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = query(sql)
        return f

    return keep


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: num.round_even(F.col(f"`{c}`"), digits) for c in cols})


# ================================================================ sources and sinks

_RAW = ", ".join(o.ident(c) for c in o.RAW_COLS)


@register("s1_read_incidents", f"SELECT {_RAW} FROM incidents")
def s1(spark, sf):
    path = scratch_path(spark, "incidents-csv")
    io.write_table(fx.incidents(spark, sf), path, "csv")
    return io.read_incidents(spark, path).withColumn("Severity", F.col("Severity").cast("int"))


# every table as rows of one shape: key, texts, whole numbers, times, a double
_CONTENTS = {
    "dim_time": ('CAST("Date" AS VARCHAR)', [], ["Day", "Month", "Quarter", "Year"], [], None),
    "dim_location": (
        '"Location_id"', ["Street", "City", "County", "State", "Timezone"],
        ["Junction", "Traffic_Signal", "Crossing", "Stop", "Amenity"], [], None,
    ),
    "dim_weather": ("weather_id", ["Weather_Condition"], [], [], None),
    "accident_detail": (
        '"ID"', ["Location_id", "weather_id", "full_date", "Description"], ["Severity"],
        ["Start_Time", "End_Time"], "Duration_min",
    ),
}


def _contents_sql(name: str, source: str) -> str:
    key, texts, numbers, times, x = _CONTENTS[name]
    cells = [f"CAST({o.ident(c)} AS VARCHAR) AS t{i}" for i, c in enumerate(texts)]
    cells += [f"CAST(NULL AS VARCHAR) AS t{i}" for i in range(len(texts), 5)]
    cells += [f"CAST({o.ident(c)} AS BIGINT) AS n{i}" for i, c in enumerate(numbers)]
    cells += [f"CAST(NULL AS BIGINT) AS n{i}" for i in range(len(numbers), 5)]
    cells += [f"{o.ident(c)} AS at{i}" for i, c in enumerate(times)]
    cells += [f"CAST(NULL AS TIMESTAMP) AS at{i}" for i in range(len(times), 2)]
    cells.append(f"CAST({o.ident(x) if x else 'NULL'} AS DOUBLE) AS x")
    return f"SELECT '{name}' AS name, {key} AS k, {', '.join(cells)} FROM {source}"


_STAR_CONTENTS = "\nUNION ALL ".join(
    _contents_sql(name, "fact" if name == "accident_detail" else name) for name in _CONTENTS
)


def star_contents(star: st.Star) -> DataFrame:
    spark = star.accident_detail.sparkSession
    rows = [
        spark.sql(
            _contents_sql(name, "{t}")
            .replace('"', "`")
            .replace("VARCHAR", "STRING")
            .replace("NULL AS TIMESTAMP", "NULL AS TIMESTAMP_NTZ"),
            t=df,
        )
        for name, df in star.tables().items()
    ]
    return reduce(DataFrame.unionByName, rows)


_DAMAGED_COLS = ["ID", "row_seq", "Severity", "City", "State", "Start_Time", "Description"]


@register(
    "s1_read_damaged_files",
    """SELECT "ID", row_seq, CASE WHEN row_seq % 5 = 1 THEN NULL ELSE "Severity" END AS "Severity", "City",
 "State", "Start_Time", CASE WHEN row_seq % 3 = 0 THEN 'two' || chr(10) || 'lines, "quoted"'
  ELSE "Description" END AS "Description",
 CASE WHEN row_seq % 5 = 1 THEN 'Severity=x' END AS _bad_record FROM incidents""",
)
def s1_damaged(spark, sf):
    """Two files whose columns are in another order, damaged times, quoted line breaks."""
    root, odd = scratch_path(spark, "damaged"), F.col("row_seq") % 2 == 1
    time = F.date_format("Start_Time", "yyyy-MM-dd HH:mm:ss")
    df = fx.incidents(spark, sf).withColumns(
        {
            "Start_Time": F.when(F.col("row_seq") % 4 == 0, F.concat(time, F.lit(" UTC#")))
            .when(F.col("row_seq") % 4 == 1, F.concat(F.lit("*"), time))
            .otherwise(time),
            "Severity": F.when(F.col("row_seq") % 5 == 1, "x").otherwise(F.col("Severity").cast("string")),
            "Description": F.when(F.col("row_seq") % 3 == 0, 'two\nlines, "quoted"').otherwise(F.col("Description")),
        }
    ).select(*_DAMAGED_COLS)
    for name, part in (("a", df.where(odd)), ("b", df.where(~odd).select(*sorted(df.columns)))):
        io.write_table(part, f"{root}/{name}", "csv")
    read = io.read_incidents(spark, root, multi_line=True, keep_bad=True)
    return read.withColumn("Severity", F.col("Severity").cast("int"))


@register("s2_read_star", _STAR_CONTENTS)
def s2(spark, sf):
    root = scratch_path(spark, "star")
    io.write_star(fx.star(spark, sf), root, partition_fact=True)
    return star_contents(io.read_star(spark, root))


@register(
    "s3_read_cleaned",
    f"""SELECT "ID", "Weather_Condition",
 {o.category('"Weather_Condition"', cfg.WEATHER_RULES_CHECKING)} AS "Weather_Category"
FROM incidents""",
)
def s3(spark, sf):
    path = scratch_path(spark, "cleaned")
    io.write_table(fx.incidents(spark, sf).select("ID", "Weather_Condition"), path)
    return io.read_cleaned(spark, path)


@register("s4_write_table", "SELECT * FROM dim_location")
def s4(spark, sf):
    path = scratch_path(spark, "dim_location")
    dim = st.build_dim_location(fx.cleaned(spark, sf), SETTINGS)
    io.write_small("dim_location", dim, path)
    return io.read_table(spark, path)


# ================================================================ filters and cleaning


@register("p1_filter_years", 'SELECT "ID", "Start_Time", "Year" FROM filtered')
def p1(spark, sf):
    return fx.filtered(spark, sf).select("ID", "Start_Time", "Year")


@register(
    "p2_drop_outside_domain", 'SELECT "ID", "Severity" FROM incidents WHERE "Severity" IN (1,2,3,4)'
)
def p2(spark, sf):
    return cl.drop_outside_domain(
        fx.incidents(spark, sf).select("ID", "Severity"), "Severity", SETTINGS.severities
    )


@register(
    "p3_rows_outside_domain",
    """SELECT "ID", "Timezone" FROM incidents
WHERE NOT coalesce("Timezone" IN ('ASIA', 'EUROPE'), false)""",
)
def p3(spark, sf):
    return cl.rows_outside_domain(
        fx.incidents(spark, sf).select("ID", "Timezone"), "Timezone", ["ASIA", "EUROPE"]
    )


@register(
    "p3_outside_domain_counts",
    """SELECT "City", count(*) AS "count" FROM incidents
WHERE NOT coalesce("City" IN ('BUILDING', 'MACHINERY'), false) AND "City" IS NOT NULL GROUP BY 1""",
)
def p3_counts(spark, sf):
    bad = cl.rows_outside_domain(fx.incidents(spark, sf), "City", ["BUILDING", "MACHINERY"])
    return agg.count_by(bad, ["City"])


@register(
    "p4_impute_median",
    f"""SELECT "ID", coalesce({T}, t) AS {T}, coalesce({V}, v) AS {V}, coalesce({P}, p) AS {P}
FROM filtered, med""",
)
def p4(spark, sf):
    return cl.impute_median(fx.filtered(spark, sf)).select("ID", TEMP, VIS, RAIN)


@register(
    "p5_impute_constant",
    """SELECT "ID", "State", coalesce("City", 'Unknown') AS "City",
 coalesce("County", 'Unknown') AS "County", coalesce("Street", 'Unknown') AS "Street",
 coalesce("Weather_Condition", 'Clear') AS "Weather_Condition",
 coalesce("Junction", false) AS "Junction", coalesce("Stop", false) AS "Stop" FROM incidents""",
)
def p5(spark, sf):
    return cl.impute_constant(fx.incidents(spark, sf), SETTINGS.fill_values).select(
        "ID", "State", "City", "County", "Street", "Weather_Condition", "Junction", "Stop"
    )


@register(
    "p5_impute_exploratory",
    f"""SELECT "ID", coalesce({T}, (SELECT median({T}) FROM incidents)) AS {T},
 coalesce({V}, (SELECT median({V}) FROM incidents)) AS {V}, coalesce({P}, 0.0) AS {P},
 coalesce("City", 'Unknown') AS "City",
 coalesce("Weather_Condition", 'Unknown') AS "Weather_Condition" FROM incidents""",
)
def p5_exploratory(spark, sf):
    return cl.impute_exploratory(fx.incidents(spark, sf)).select(
        "ID", TEMP, VIS, RAIN, "City", "Weather_Condition"
    )


@register(
    "p6_impute_from_column",
    f'SELECT "ID", {T}, coalesce({V}, {T}) AS {V} FROM incidents',
)
def p6(spark, sf):
    return cl.impute_from_column(fx.incidents(spark, sf), VIS, TEMP).select("ID", TEMP, VIS)


@register("p7_clip", f'SELECT "ID", {o.clip(T, -20.0, 120.0)} AS {T} FROM incidents')
def p7(spark, sf):
    return cl.clip(fx.incidents(spark, sf), TEMP, -20, 120).select("ID", TEMP)


_MIN = o.minutes('"Start_Time"', '"End_Time"')


@register(
    "p8_duration_minutes", f'SELECT "ID", {o.clip(_MIN, 0.0, 1440.0)} AS "Duration_min" FROM incidents'
)
def p8(spark, sf):
    return cl.add_duration(fx.incidents(spark, sf)).select("ID", "Duration_min")


@register("p9_cap_column", f'SELECT "ID", {o.clip(V, 0.0, 10.0)} AS {V} FROM incidents')
def p9(spark, sf):
    return cl.cap_column(fx.incidents(spark, sf), VIS, 0, 10).select("ID", VIS)


@register(
    "p10_cap_count",
    f"""SELECT 'Temperature(F)' AS "column", count(*) FILTER (WHERE {T} < -20) AS n_low,
 count(*) FILTER (WHERE {T} > 120) AS n_high FROM incidents
UNION ALL SELECT 'Visibility(mi)', count(*) FILTER (WHERE {V} < 0),
 count(*) FILTER (WHERE {V} > 10) FROM incidents
UNION ALL SELECT 'Duration_min', count(*) FILTER (WHERE {_MIN} < 0),
 count(*) FILTER (WHERE {_MIN} > 1440) FROM incidents""",
)
def p10(spark, sf):
    df = fx.incidents(spark, sf).withColumn(
        "Duration_min", tm.minutes_between("Start_Time", "End_Time")
    )
    return cl.cap_count(df, {TEMP: (-20, 120), VIS: (0, 10), "Duration_min": (0, 1440)})


_SIGMA = f"SELECT avg({T}) - 3 * stddev_pop({T}) AS lo, avg({T}) + 3 * stddev_pop({T}) AS hi FROM incidents"
_SIGMA1 = _SIGMA.replace("3 *", "1.5 *")
_IQR = f"""SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
 (SELECT quantile_cont({T}, 0.25) AS q1, quantile_cont({T}, 0.75) AS q3 FROM incidents)"""
_IQR2 = _IQR.replace("1.5 *", "0.25 *")
_CAPPED = f"round_even({o.clip(T, 'lo', 'hi')}, 6)"


@register("p11_cap_sigma", f'SELECT "ID", {_CAPPED} AS {T} FROM incidents, ({_SIGMA1}) b')
def p11(spark, sf):
    return rounded(cl.cap_sigma(fx.incidents(spark, sf), TEMP, 1.5).select("ID", TEMP), 6, TEMP)


@register(
    "p12_drop_sigma_outliers",
    f'SELECT "ID", {T} FROM incidents, ({_SIGMA1}) b WHERE {T} >= lo AND {T} <= hi',
)
def p12(spark, sf):
    return cl.drop_sigma_outliers(fx.incidents(spark, sf), TEMP, 1.5).select("ID", TEMP)


@register(
    "p12_sigma_outliers",
    f'SELECT "ID", {T} FROM incidents, ({_SIGMA1}) b WHERE {T} < lo OR {T} > hi',
)
def p12_list(spark, sf):
    return cl.sigma_outliers(fx.incidents(spark, sf), TEMP, 1.5).select("ID", TEMP)


@register(
    "p12_sigma_summary",
    f"""SELECT round_even(lo, 6) AS lo, round_even(hi, 6) AS hi, count(*) AS n_rows,
 count(*) FILTER (WHERE {T} < lo OR {T} > hi) AS n_outliers,
 {o.r(o.pct(f"count(*) FILTER (WHERE {T} < lo OR {T} > hi)", "count(*)"), 6)} AS outlier_pct,
 count(*) FILTER (WHERE {T} >= lo AND {T} <= hi) AS n_kept
FROM incidents, ({_SIGMA}) b GROUP BY lo, hi""",
)
def p12_summary(spark, sf):
    df = fx.incidents(spark, sf)
    return rounded(
        cl.outlier_summary(df, TEMP, cl.sigma_bounds(df, TEMP)), 6, "lo", "hi", "outlier_pct"
    )


@register("p13_cap_iqr", f'SELECT "ID", {_CAPPED} AS {T} FROM incidents, ({_IQR2}) b')
def p13(spark, sf):
    return rounded(cl.cap_iqr(fx.incidents(spark, sf), TEMP, 0.25).select("ID", TEMP), 6, TEMP)


@register(
    "p14_drop_iqr_outliers",
    f'SELECT "ID", {T} FROM incidents, ({_IQR2}) b WHERE {T} >= lo AND {T} <= hi',
)
def p14(spark, sf):
    return cl.drop_iqr_outliers(fx.incidents(spark, sf), TEMP, 0.25).select("ID", TEMP)


@register(
    "p14_iqr_outliers",
    f'SELECT "ID", {T} FROM incidents, ({_IQR2}) b WHERE {T} < lo OR {T} > hi',
)
def p14_list(spark, sf):
    return cl.iqr_outliers(fx.incidents(spark, sf), TEMP, 0.25).select("ID", TEMP)


_BINS = " ".join(
    f"WHEN {T} >= {a} AND {T} < {b} THEN {o.lit(s)}"
    for a, b, s in zip(cfg.TEMP_EDGES, cfg.TEMP_EDGES[1:], cfg.TEMP_LABELS)
)


@register("p15_bin_numeric", f'SELECT "ID", CASE {_BINS} END AS "Temp_1" FROM incidents')
def p15(spark, sf):
    return cl.bin_numeric(
        fx.incidents(spark, sf), TEMP, cfg.TEMP_EDGES, cfg.TEMP_LABELS, "Temp_1"
    ).select("ID", "Temp_1")


@register(
    "p16_location_key",
    """SELECT "ID", coalesce("Street", 'Unknown') || '_' || coalesce("City", 'Unknown') AS two,
 coalesce("State", 'Unknown') || '_' || coalesce("City", 'Unknown') || '_'
  || coalesce("Street", 'Unknown') AS three FROM incidents""",
)
def p16(spark, sf):
    return fx.incidents(spark, sf).select(
        "ID",
        tx.location_key().alias("two"),
        tx.location_key(("State", "City", "Street")).alias("three"),
    )


@register(
    "p17_select_available",
    'SELECT "ID", "Start_Time", "End_Time", "Severity", "Description" FROM incidents',
)
def p17(spark, sf):
    return cl.select_available(fx.incidents(spark, sf), st.FACT_COLS)


@register(
    "p19_narrow_types",
    """SELECT 'tinyint' AS line_type,
 CASE WHEN max(l_partkey) <= 127 THEN 'tinyint' WHEN max(l_partkey) <= 32767 THEN 'smallint'
  WHEN max(l_partkey) <= 2147483647 THEN 'int' ELSE 'bigint' END AS part_type,
 CASE WHEN max(l_orderkey) <= 127 THEN 'tinyint' WHEN max(l_orderkey) <= 32767 THEN 'smallint'
  WHEN max(l_orderkey) <= 2147483647 THEN 'int' ELSE 'bigint' END AS order_type,
 count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS sum_part,
 CAST(sum(l_orderkey) AS BIGINT) AS sum_order FROM lineitem""",
)
def p19(spark, sf):
    narrow = cl.narrow_types(table(spark, sf, "lineitem"))
    return narrow.agg(
        F.max(F.typeof("l_linenumber")).alias("line_type"),
        F.max(F.typeof("l_partkey")).alias("part_type"),
        F.max(F.typeof("l_orderkey")).alias("order_type"),
        F.count(F.lit(1)).alias("n"),
        F.sum("l_partkey").alias("sum_part"),
        F.sum("l_orderkey").alias("sum_order"),
    )


_REPAIRED = (
    r"""try_cast(trim(regexp_replace(regexp_replace(trim("Start_Text"), '\.(0{9}|0{6})$', ''),"""
    r""" '[^0-9\-: .]', '', 'g')) AS TIMESTAMP)"""
)


@register("p20_repair_datetime", f'SELECT row_seq, {_REPAIRED} AS "Start_Text" FROM raw_times')
def p20(spark, sf):
    return cl.repair_datetime(fx.raw_times(spark, sf), "Start_Text")


_FORMED = r"""coalesce(regexp_matches("Start_Text", '^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$'), false)"""
_PARSES = '(try_cast("Start_Text" AS TIMESTAMP) IS NOT NULL)'


@register(
    "p21_bad_datetime_rows",
    f"""SELECT row_seq, "Start_Text", {_FORMED} AS well_formed, {_PARSES} AS parses
FROM raw_times WHERE NOT {_FORMED} OR NOT {_PARSES}""",
)
def p21(spark, sf):
    return cl.bad_datetime_rows(fx.raw_times(spark, sf), "Start_Text")


@register(
    "p21_bad_datetime_values",
    f"""SELECT "Start_Text", {_FORMED} AS well_formed, {_PARSES} AS parses, count(*) AS n
FROM raw_times WHERE "Start_Text" IS NOT NULL AND (NOT {_FORMED} OR NOT {_PARSES})
GROUP BY 1, 2, 3""",
)
def p21_values(spark, sf):
    return cl.bad_datetime_values(fx.raw_times(spark, sf), "Start_Text")


@register(
    "p21_bad_datetime_count",
    f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT {_FORMED}) AS n_bad_format,
 count(*) FILTER (WHERE NOT {_PARSES}) AS n_unparsed FROM raw_times""",
)
def p21_count(spark, sf):
    return cl.bad_datetime_count(fx.raw_times(spark, sf), "Start_Text")


# ================================================================ joins


@register(
    "j1_attach_weather_id",
    """SELECT i."ID", i."Weather_Condition", w.weather_id FROM incidents i
LEFT JOIN (SELECT "Weather_Condition", 'W' || CAST(row_number() OVER (ORDER BY min(row_seq)) AS
  VARCHAR) AS weather_id FROM incidents GROUP BY 1) w
 ON i."Weather_Condition" IS NOT DISTINCT FROM w."Weather_Condition\"""",
)
def j1(spark, sf):
    df = fx.incidents(spark, sf)
    return st.attach_weather_id(df, st.build_dim_weather(df)).select(
        "ID", "Weather_Condition", "weather_id"
    )


_JOINED = [
    "ID", "Location_id", "weather_id", "full_date", "Start_Time", "End_Time", "Severity",
    "Duration_min", "Description", "Date", "Day", "Month", "Quarter", "Year", "Street", "City",
    "County", "State", "Timezone", "Junction", "Traffic_Signal", "Crossing", "Stop", "Amenity",
    "Weather_Condition", "Hour", "DayOfWeek", "Weather_Category", "Infra_Score",
]


@register("j2_star_join", "SELECT " + ", ".join(o.ident(c) for c in _JOINED) + " FROM joined")
def j2(spark, sf):
    return st.star_join(fx.star(spark, sf), SETTINGS).select(*_JOINED)


@register(
    "j2_national_avg_severity",
    f'SELECT {o.r("avg(Severity)", 6)} AS national_avg_severity FROM joined',
)
def j2_mean(spark, sf):
    joined = st.star_join(fx.star(spark, sf), SETTINGS)
    return rounded(st.national_avg_severity(joined), 6, "national_avg_severity")


@register(
    "j3_attach_group_stats",
    """SELECT a."State", a."City", n, state_n FROM
 (SELECT "State", "City", count(*) AS n FROM incidents WHERE "State" IS NOT NULL
   AND "City" IS NOT NULL GROUP BY 1, 2) a
LEFT JOIN (SELECT "State", count(*) AS state_n FROM incidents WHERE "State" IS NOT NULL
  GROUP BY 1) s ON a."State" = s."State\"""",
)
def j3(spark, sf):
    df = fx.incidents(spark, sf)
    cities = agg.count_by(df, ["State", "City"], "n")
    states = agg.count_by(df, ["State"], "state_n").withColumnRenamed("State", "s")
    return agg.attach_group_stats(cities, states, "State", "s")


@register(
    "j4_orphans",
    """SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def j4(spark, sf):
    rich = table(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    return st.orphans(table(spark, sf, "orders"), rich, "o_custkey", "c_custkey").select(
        "o_orderkey", "o_custkey"
    )


@register(
    "j4_orphan_count",
    """SELECT CAST(count(*) AS BIGINT) AS orphan_rows, count(DISTINCT o_custkey) AS orphan_keys
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def j4_count(spark, sf):
    rich = table(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    return st.orphan_count(table(spark, sf, "orders"), rich, "o_custkey", "c_custkey")


@register(
    "j4_referential_integrity",
    "WITH lost AS (SELECT count(DISTINCT o_custkey) AS k FROM orders WHERE o_custkey NOT IN"
    " (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) "
    + o.finding(
        "schema", "'o_custkey -> c_custkey'", "referential_integrity", "k = 0", "'0 orphans'",
        "CAST(k AS VARCHAR) || ' orphans'", "lost keys:", "lost",
    ),
)
def j4_finding(spark, sf):
    rich = table(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    return ru.referential_integrity(table(spark, sf, "orders"), rich, "o_custkey", "c_custkey")


# nested WITH is not allowed after the list of CTEs
ORACLE["j4_referential_integrity"] = ORACLE["j4_referential_integrity"].replace(
    "\nWITH lost AS", ",\nlost AS"
)

_TYPED_RULES = {
    "Amenity": {"values": {True, False}},
    "Severity": {"values": {1, 2, 3, 4, 5}, "min": 2, "max": 5},
    "price": {"values": {1, 2}, "min": 0},
    "Start_Time": {"min": 5, "max": "1998-01-01 00:00:00"},
    "State": {"max": 9},
}


@register(
    "q7_typed_rules",
    f"""SELECT passed, "column", "check", expected, actual FROM (
SELECT true AS passed, 'Amenity' AS "column", 'values' AS "check", '0 other values' AS expected, '0' AS actual
UNION ALL SELECT true, 'Severity', 'values', '0 other values', '0'
UNION ALL SELECT (SELECT min("Severity") >= 2 FROM incidents), 'Severity', 'min', '>= 2.0',
 (SELECT CAST(CAST(min("Severity") AS DOUBLE) AS VARCHAR) FROM incidents)
UNION ALL SELECT (SELECT max("Severity") <= 5 FROM incidents), 'Severity', 'max', '<= 5.0',
 (SELECT CAST(CAST(max("Severity") AS DOUBLE) AS VARCHAR) FROM incidents)
UNION ALL SELECT true, 'price', 'min', '>= 0.0', (SELECT CAST(CAST(min(row_seq % 4) AS DOUBLE) AS VARCHAR) FROM incidents)
UNION ALL SELECT false, 'price', 'values', '0 other values', '2'
UNION ALL SELECT false, 'Start_Time', 'min', '>= 5.0', 'timestamp_ntz'
UNION ALL SELECT (SELECT max("Start_Time") <= TIMESTAMP '1998-01-01 00:00:00' FROM incidents), 'Start_Time', 'max',
 '<= 1998-01-01 00:00:00', (SELECT CAST(max("Start_Time") AS VARCHAR) FROM incidents)
UNION ALL SELECT false, 'State', 'max', '<= 9.0', 'string') x""",
)
def q7_typed(spark, sf):
    df = fx.incidents(spark, sf).withColumn("price", (F.col("row_seq") % 4).cast("decimal(10,2)"))
    found = ru.check_rules(df, "typed", _TYPED_RULES)
    return found.select("passed", "column", "check", "expected", "actual")


# ================================================================ aggregates


def _rollup(spark, sf, *keys):
    wanted = {
        "time": "Year" in keys,
        "location": bool({"State", "City", "dominant_infra"} & set(keys)),
        "weather": "Weather_Category" in keys,
    }
    star = fx.star(spark, sf, [d for d, on in wanted.items() if on])
    return materialize(agg.star_rollup(star, keys, SETTINGS))


@register("a1_agg_federal", "SELECT * FROM agg_federal")
def a1(spark, sf):
    return agg.agg_federal(_rollup(spark, sf, "Year", "State", "City"), SETTINGS)


@register("a2_agg_state_anomaly", "SELECT * FROM agg_state_anomaly")
def a2(spark, sf):
    return agg.agg_state_anomaly(_rollup(spark, sf, "Year", "State", "City"), SETTINGS)


@register("a3_agg_city_by_state", "SELECT * FROM agg_city_by_state")
def a3(spark, sf):
    return agg.agg_city_by_state(_rollup(spark, sf, "State", "City", "dominant_infra"), SETTINGS)


@register("a4_agg_weather_by_state", "SELECT * FROM agg_weather_by_state")
def a4(spark, sf):
    return agg.agg_weather_by_state(_rollup(spark, sf, "State", "Weather_Category"), SETTINGS)


@register("a5_agg_time_pattern", "SELECT * FROM agg_time_pattern")
def a5(spark, sf):
    return agg.agg_time_pattern(_rollup(spark, sf, "Hour", "DayOfWeek"), SETTINGS)


@register("a6_build_dim_location", "SELECT * FROM dim_location")
def a6(spark, sf):
    return st.build_dim_location(fx.cleaned(spark, sf), SETTINGS)


_HASHED = (
    """(SELECT *, CASE WHEN row_seq % 2 = 0 THEN 'x' || substr(md5("ID"), 1, 20) || 'x'
 WHEN row_seq % 5 = 0 THEN 'B-' || CAST(row_seq // 7 AS VARCHAR) ELSE "ID" END AS id2 FROM cleaned)"""
)
_FIRST = """(CASE WHEN regexp_matches(id2, '[0-9]+$')
 THEN '0' || lpad(regexp_extract(id2, '([0-9]+)$', 1), 20, '0') ELSE '1' END) || id2"""


@register(
    "a6_dim_location_hashed_ids",
    'SELECT "Location_id", '
    + ", ".join(
        f'arg_min("{c}", first) FILTER (WHERE "{c}" IS NOT NULL) AS "{c}"'
        for c in ("Street", "City", "County", "State", "Timezone")
    )
    + ", "
    + ", ".join(f'CAST(count(*) FILTER (WHERE "{c}") AS BIGINT) AS "{c}"' for c, _ in cfg.INFRA_WEIGHTS)
    + f' FROM (SELECT *, {_FIRST} AS first FROM {_HASHED}) h GROUP BY "Location_id"',
)
def a6_hashed(spark, sf):
    return st.build_dim_location(fx.hashed_ids(spark, sf), SETTINGS)


@register(
    "a8_dim_weather_hashed_ids",
    f"""SELECT 'W' || CAST(row_number() OVER (ORDER BY first) AS VARCHAR) AS weather_id, "Weather_Condition"
FROM (SELECT "Weather_Condition", min({_FIRST}) AS first FROM {_HASHED} h GROUP BY 1) d""",
)
def a8_hashed(spark, sf):
    return st.build_dim_weather(fx.hashed_ids(spark, sf))


@register("a7_build_dim_time", "SELECT * FROM dim_time")
def a7(spark, sf):
    return st.build_dim_time(fx.cleaned(spark, sf))


@register("a8_build_dim_weather", "SELECT * FROM dim_weather")
def a8(spark, sf):
    return st.build_dim_weather(fx.cleaned(spark, sf))


@register("a9_build_fact", "SELECT * FROM fact")
def a9(spark, sf):
    df = fx.cleaned(spark, sf)
    return st.build_fact(df, st.build_dim_weather(df), SETTINGS)


@register(
    "a10_count_by_state",
    'SELECT "State", count(*) AS "count" FROM incidents WHERE "State" IS NOT NULL GROUP BY 1',
)
def a10_state(spark, sf):
    return agg.count_by(fx.incidents(spark, sf), ["State"])


@register(
    "a10_count_by_state_city",
    """SELECT "State", "City", count(*) AS "count" FROM incidents
WHERE "State" IS NOT NULL AND "City" IS NOT NULL GROUP BY 1, 2""",
)
def a10_city(spark, sf):
    return agg.count_by(fx.incidents(spark, sf), ["State", "City"])


@register("a10_count_by_year", 'SELECT "Year", count(*) AS "count" FROM filtered GROUP BY 1')
def a10_year(spark, sf):
    return agg.count_by(fx.filtered(spark, sf), ["Year"])


@register("a10_count_by_hour", f'SELECT {o.HOUR} AS "Hour", count(*) AS "count" FROM incidents GROUP BY 1')
def a10_hour(spark, sf):
    df = fx.incidents(spark, sf).select(F.hour("Start_Time").alias("Hour"))
    return agg.count_by(df, ["Hour"])


@register(
    "a10_count_by_severity", 'SELECT "Severity", count(*) AS "count" FROM incidents GROUP BY 1'
)
def a10_severity(spark, sf):
    return agg.count_by(fx.incidents(spark, sf), ["Severity"])


@register(
    "a11_severity_stats",
    f"""SELECT "Severity", count("ID") AS "count", {o.r(f'avg({_MIN})', 6)} AS avg_duration_min
FROM incidents GROUP BY 1""",
)
def a11(spark, sf):
    df = fx.incidents(spark, sf).withColumn(
        "Duration_min", tm.minutes_between("Start_Time", "End_Time")
    )
    return rounded(agg.severity_stats(df), 6, "avg_duration_min")


@register(
    "a12_summary",
    """SELECT CAST(count(*) AS BIGINT) AS total_records, min("Start_Time") AS min_start,
 max("Start_Time") AS max_start, count(DISTINCT "State") AS states,
 count(DISTINCT "City") AS cities FROM filtered""",
)
def a12(spark, sf):
    return agg.summary(fx.filtered(spark, sf))


@register(
    "a13_urban_rural",
    """SELECT "ID", "Infra_Score", CASE WHEN "Infra_Score" >= (SELECT median("Infra_Score")
 FROM cleaned) THEN 'Urban' ELSE 'Rural' END AS "Urban_Rural" FROM cleaned""",
)
def a13(spark, sf):
    return ft.urban_rural(fx.cleaned(spark, sf)).select("ID", "Infra_Score", "Urban_Rural")


@register(
    "a13_urban_share",
    f"""SELECT {o.r('''avg(CASE WHEN "Infra_Score" >= (SELECT median("Infra_Score") FROM cleaned)
 THEN 1 ELSE 0 END) * 100''', 6)} AS urban_pct FROM cleaned""",
)
def a13_share(spark, sf):
    df = ft.urban_rural(fx.cleaned(spark, sf)).withColumn(
        "u", (F.col("Urban_Rural") == "Urban").cast("int")
    )
    return rounded(agg.flag_rate(df, ["u"]).select(F.col("pct").alias("urban_pct")), 6, "urban_pct")


_TOTALS = ", ".join(
    f'count(*) FILTER (WHERE "{c}") AS total_{c.lower()}' for c, _ in cfg.INFRA_WEIGHTS
)
_SCORE = " + ".join(f"total_{c.lower()} * {w}" for c, w in cfg.INFRA_WEIGHTS)


@register(
    "a14_infra_risk_score",
    f"""SELECT *, {o.r(o.ratio(_SCORE, 'total_accidents'))} AS "Infra_Risk_Score"
FROM (SELECT "State", "City", count("ID") AS total_accidents, {_TOTALS} FROM incidents
 WHERE "State" IS NOT NULL AND "City" IS NOT NULL GROUP BY 1, 2) a""",
)
def a14(spark, sf):
    return agg.infra_risk_score(agg.infra_totals(fx.incidents(spark, sf), ["State", "City"]))


_PARETO = """SELECT "Street", n, n::DOUBLE / sum(n) OVER () * 100 AS share,
 CAST(sum(n) OVER (ORDER BY n DESC, "Street" ROWS UNBOUNDED PRECEDING) AS DOUBLE)
  / sum(n) OVER () * 100 AS cum
FROM (SELECT "Street", CAST(sum("Severity") AS BIGINT) AS n FROM incidents GROUP BY 1) a"""


@register(
    "a15_pareto",
    f"""SELECT "Street", n AS "Severity", {o.r('share', 6)} AS "Percentage",
 {o.r('cum', 6)} AS "Cumulative_Percentage",
 CASE WHEN cum <= 80 THEN 'Top_80%' ELSE 'Bottom_20%' END AS "Pareto_Group" FROM ({_PARETO}) p""",
)
def a15(spark, sf):
    df = agg.pareto(fx.incidents(spark, sf), "Street", "Severity")
    return rounded(df, 6, "Percentage", "Cumulative_Percentage")


# whole cents in units of a power of two, whose sums a double holds without loss
_FRACTIONS = "CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) * {unit} AS n"


def _fractions(spark, sf, unit: float) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("long").cast("double")
    return table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", (cents * unit).alias("v"))


@register(
    "a15_pareto_tiny_fractions",
    f"""SELECT l_suppkey, n AS v, {o.r('share', 6)} AS "Percentage", {o.r('cum', 6)} AS "Cumulative_Percentage",
 CASE WHEN cum <= 80 THEN 'Top_80%' ELSE 'Bottom_20%' END AS "Pareto_Group" FROM (
 SELECT l_suppkey, n, n / sum(n) OVER () * 100 AS share,
  sum(n) OVER (ORDER BY n DESC, l_suppkey ROWS UNBOUNDED PRECEDING) / sum(n) OVER () * 100 AS cum
 FROM (SELECT l_suppkey, {_FRACTIONS.format(unit=2.0**-80)} FROM lineitem GROUP BY 1) a) p""",
)
def a15_tiny(spark, sf):
    df = agg.pareto(_fractions(spark, sf, 2.0**-80), "l_suppkey", "v")
    return rounded(df, 6, "Percentage", "Cumulative_Percentage")


@register(
    "a16_flag_rate",
    f"""SELECT {o.r('avg("Low_Visibility") * 100', 6)} AS pct, 'Low_Visibility' AS flag FROM cleaned
UNION ALL SELECT {o.r('avg("Is_High_Severity") * 100', 6)}, 'Is_High_Severity' FROM cleaned""",
)
def a16(spark, sf):
    rates = agg.flag_rate(fx.cleaned(spark, sf), ["Low_Visibility", "Is_High_Severity"])
    return rounded(rates, 6, "pct")


# ================================================================ windows, order, sets


@register(
    "w1_yoy_change",
    """SELECT "Year", n, round_even((n - lag(n) OVER (ORDER BY "Year"))::DOUBLE
 / lag(n) OVER (ORDER BY "Year") * 100, 6) AS "YoY_Change"
FROM (SELECT CAST(year("Start_Time") AS INT) AS "Year", count(*) AS n FROM incidents GROUP BY 1) a""",
)
def w1(spark, sf):
    df = fx.incidents(spark, sf).select(F.year("Start_Time").alias("Year"))
    return rounded(agg.yoy_change(agg.count_by(df, ["Year"], "n"), "Year", "n"), 6, "YoY_Change")


@register(
    "w1_yoy_change_by_state",
    """SELECT "State", "Year", n, round_even((n - lag(n) OVER w)::DOUBLE / lag(n) OVER w * 100, 6)
 AS "YoY_Change"
FROM (SELECT "State", CAST(year("Start_Time") AS INT) AS "Year", count(*) AS n FROM incidents
 WHERE "State" IS NOT NULL GROUP BY 1, 2) a WINDOW w AS (PARTITION BY "State" ORDER BY "Year")""",
)
def w1_state(spark, sf):
    df = fx.incidents(spark, sf).withColumn("Year", F.year("Start_Time"))
    counts = agg.count_by(df, ["State", "Year"], "n")
    return rounded(agg.yoy_change(counts, "Year", "n", by=["State"]), 6, "YoY_Change")


@register(
    "w2_running_share",
    """SELECT o_custkey, n, round_even(n::DOUBLE / sum(n) OVER () * 100, 6) AS share,
 round_even(CAST(sum(n) OVER (ORDER BY n DESC, o_custkey ROWS UNBOUNDED PRECEDING) AS DOUBLE)
  / sum(n) OVER () * 100, 6) AS running
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) a""",
)
def w2(spark, sf):
    counts = agg.count_by(table(spark, sf, "orders"), ["o_custkey"], "n")
    return rounded(
        agg.running_share(counts, "n", "o_custkey", "share", "running"), 6, "share", "running"
    )


@register(
    "w2_running_share_huge_fractions",
    f"""SELECT l_orderkey, n, {o.r('n / sum(n) OVER () * 100', 6)} AS share,
 {o.r('sum(n) OVER (ORDER BY n DESC, l_orderkey ROWS UNBOUNDED PRECEDING) / sum(n) OVER () * 100', 6)} AS running
FROM (SELECT l_orderkey, {_FRACTIONS.format(unit=2.0**110)} FROM lineitem GROUP BY 1) a""",
)
def w2_huge(spark, sf):
    sums = sum_by(_fractions(spark, sf, 2.0**110), ["l_orderkey"], "v", "n")
    return rounded(agg.running_share(sums, "n", "l_orderkey", "share", "running"), 6, "share", "running")


@register(
    "w3_share_of_total",
    """SELECT "State", "City", n, round_even(n::DOUBLE / sum(n) OVER (PARTITION BY "State") * 100, 6)
 AS of_state, round_even(n::DOUBLE / sum(n) OVER () * 100, 6) AS of_all
FROM (SELECT "State", "City", count(*) AS n FROM incidents WHERE "State" IS NOT NULL
 AND "City" IS NOT NULL GROUP BY 1, 2) a""",
)
def w3(spark, sf):
    df = agg.count_by(fx.incidents(spark, sf), ["State", "City"], "n")
    df = agg.share_of_total(agg.share_of_total(df, "n", "of_state", ["State"]), "n", "of_all")
    return rounded(df, 6, "of_state", "of_all")


@register(
    "w3_share_of_max",
    """SELECT "State", n, round_even(n::DOUBLE / max(n) OVER () * 10, 6) AS of_max
FROM (SELECT "State", count(*) AS n FROM incidents WHERE "State" IS NOT NULL GROUP BY 1) a""",
)
def w3_max(spark, sf):
    df = agg.count_by(fx.incidents(spark, sf), ["State"], "n")
    return rounded(agg.share_of_max(df, "n", "of_max"), 6, "of_max")


@register(
    "w4_surrogate_id",
    """SELECT "Street", first_seen, 'L' || CAST(row_number() OVER (ORDER BY first_seen, "Street")
 AS VARCHAR) AS id FROM (SELECT "Street", min(row_seq) AS first_seen FROM incidents GROUP BY 1) a""",
)
def w4(spark, sf):
    seen = fx.incidents(spark, sf).groupBy("Street").agg(F.min("row_seq").alias("first_seen"))
    return st.surrogate_id(seen, "first_seen", "Street", "L", "id")


_EARLY = """(SELECT o_custkey, row_number() OVER (ORDER BY min(o_orderkey), o_custkey) AS n FROM orders
 WHERE o_orderdate < TIMESTAMP '1993-01-01' GROUP BY 1) e"""


@register(
    "w4_kept_ids",
    f"""SELECT o_custkey, 'C' || CAST(n AS VARCHAR) AS id FROM {_EARLY}
UNION ALL SELECT o_custkey, 'C' || CAST((SELECT count(*) FROM {_EARLY})
 + row_number() OVER (ORDER BY first_seen, o_custkey) AS VARCHAR)
FROM (SELECT o_custkey, min(o_orderkey) AS first_seen FROM orders GROUP BY 1) a
WHERE o_custkey NOT IN (SELECT o_custkey FROM {_EARLY})""",
)
def w4_kept(spark, sf):
    """Customers of the first year keep their ids when the other years are loaded."""
    orders = table(spark, sf, "orders")
    early = orders.where(F.col("o_orderdate") < F.lit("1993-01-01").cast(orders.schema["o_orderdate"].dataType))
    first_seen = F.min("o_orderkey").alias("first_seen")
    ids, how = None, ("first_seen", "o_custkey", "C", "id")
    for load in (early, orders):
        ids = st.kept_ids(load.groupBy("o_custkey").agg(first_seen), *how, ids)
    return ids


@register(
    "l1_top_states",
    """SELECT "State", count(*) AS "count" FROM incidents WHERE "State" IS NOT NULL GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 10""",
)
def l1_states(spark, sf):
    return agg.top_n(fx.incidents(spark, sf), ["State"], 10)


@register(
    "l1_top_hours",
    f"""SELECT {o.HOUR} AS "Hour", count(*) AS "count" FROM incidents GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 5""",
)
def l1_hours(spark, sf):
    return agg.top_n(fx.incidents(spark, sf).select(F.hour("Start_Time").alias("Hour")), ["Hour"], 5)


@register(
    "l1_top_cities",
    """SELECT "State", "City", count(*) AS "count" FROM incidents WHERE "State" IS NOT NULL
AND "City" IS NOT NULL GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
)
def l1_cities(spark, sf):
    return agg.top_n(fx.incidents(spark, sf), ["State", "City"], 10)


def _null_sql(cols, source="incidents"):
    return "\nUNION ALL\n".join(
        f"SELECT {o.lit(c)} AS \"column\", count(*) FILTER (WHERE {o.ident(c)} IS NULL) AS missing,"
        f" (count(*) FILTER (WHERE {o.ident(c)} IS NULL))::DOUBLE / count(*) * 100 AS missing_pct"
        f" FROM {source}"
        for c in cols
    )


@register(
    "l1_top_missing",
    f"""SELECT "column", missing, round_even(missing_pct, 6) AS missing_pct
FROM ({_null_sql(o.RAW_COLS)}) x WHERE missing > 0 ORDER BY missing DESC, "column" LIMIT 3""",
)
def l1_missing(spark, sf):
    return rounded(pf.top_missing(fx.incidents(spark, sf), 3), 6, "missing_pct")


@register("l2_sort_output", "SELECT * FROM agg_city_by_state")
def l2(spark, sf):
    return agg.sort_output("agg_city_by_state", a3(spark, sf))


@register("l3_sample_head", f"SELECT {_RAW} FROM incidents ORDER BY row_seq LIMIT 1000")
def l3(spark, sf):
    return agg.sample_head(fx.incidents(spark, sf), 1000)


@register("x1_distinct_rows", 'SELECT DISTINCT "State", "County" FROM incidents')
def x1(spark, sf):
    return st.distinct_rows(fx.incidents(spark, sf), ["State", "County"])


@register(
    "x2_key_difference",
    "SELECT o_custkey AS key FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0",
)
def x2(spark, sf):
    rich = table(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    return st.key_difference(table(spark, sf, "orders"), rich, "o_custkey", "c_custkey")


@register(
    "x3_values_not_allowed",
    """SELECT DISTINCT "Severity" AS value FROM incidents WHERE "Severity" NOT IN (1, 2, 3, 4)""",
)
def x3(spark, sf):
    return ru.values_not_allowed(fx.incidents(spark, sf), "Severity", SETTINGS.severities)


# ================================================================ scalar functions

_W = '"Weather_Condition"'


def _category(name, rules, default="Clear", null_as=None):
    sql = f'SELECT "ID", {o.category(_W, rules, default, null_as)} AS category FROM incidents'

    @register(name, sql)
    def run(spark, sf):
        return fx.incidents(spark, sf).select(
            "ID", tx.categorize_text("Weather_Condition", rules, default, null_as).alias("category")
        )


_category("c1a_categorize_aggregate", cfg.WEATHER_RULES_AGGREGATE)
_category("c1b_categorize_cleaning", cfg.WEATHER_RULES_CLEANING)
_category("c1c_categorize_checking", cfg.WEATHER_RULES_CHECKING)
_category("c1d_categorize_broad", cfg.WEATHER_RULES_BROAD, "Other", "Clear")


@register(
    "c2_keyword_flag",
    f"""SELECT "ID", {o.flag(o.any_word(_W, cfg.RAIN_WORDS))} AS "Is_Rain",
 {o.flag(o.any_word(_W, cfg.SNOW_WORDS))} AS "Is_Snow",
 {o.flag(o.any_word(_W, cfg.FOG_WORDS))} AS "Is_Fog",
 {o.flag(o.any_word(_W, cfg.SNOW_WORDS_SHORT))} AS "Is_Snow_short",
 {o.flag(o.any_word(_W, cfg.FOG_WORDS_SHORT))} AS "Is_Fog_short" FROM incidents""",
)
def c2(spark, sf):
    w = "Weather_Condition"
    return fx.incidents(spark, sf).select(
        "ID",
        tx.keyword_flag(w, cfg.RAIN_WORDS).alias("Is_Rain"),
        tx.keyword_flag(w, cfg.SNOW_WORDS).alias("Is_Snow"),
        tx.keyword_flag(w, cfg.FOG_WORDS).alias("Is_Fog"),
        tx.keyword_flag(w, cfg.SNOW_WORDS_SHORT).alias("Is_Snow_short"),
        tx.keyword_flag(w, cfg.FOG_WORDS_SHORT).alias("Is_Fog_short"),
    )


_TIME_COLS = [
    "Year", "Month", "Day", "Hour", "DayOfWeek", "DayName", "Quarter", "Time_Period",
    "Is_Rush_Hour", "Is_Weekend",
]


@register(
    "d1_add_time_features",
    f"""SELECT "ID", CAST(year("Start_Time") AS INT) AS "Year",
 CAST(month("Start_Time") AS INT) AS "Month", CAST(day("Start_Time") AS INT) AS "Day",
 {o.HOUR} AS "Hour", {o.WEEKDAY} AS "DayOfWeek", dayname("Start_Time") AS "DayName",
 CAST(quarter("Start_Time") AS INT) AS "Quarter",
 {o.hours('hour("Start_Time")', cfg.HOURS_CLEANING)} AS "Time_Period",
 {o.flag(f'hour("Start_Time") IN ({o.RUSH})')} AS "Is_Rush_Hour",
 {o.flag('isodow("Start_Time") >= 6')} AS "Is_Weekend" FROM incidents""",
)
def d1(spark, sf):
    return ft.add_time_features(fx.incidents(spark, sf)).select("ID", *_TIME_COLS)


@register("d2_to_date", 'SELECT "ID", CAST("Start_Time" AS DATE) AS full_date FROM incidents')
def d2(spark, sf):
    return fx.incidents(spark, sf).select("ID", F.to_date("Start_Time").alias("full_date"))


_H = 'hour("Start_Time")'


@register(
    "d3_hour_bucket",
    f"""SELECT "ID", {o.hours(_H, cfg.HOURS_CLEANING)} AS by_cleaning,
 {o.hours(_H, cfg.HOURS_DASHBOARD)} AS by_dashboard, {o.hours(_H, cfg.HOURS_BROAD)} AS by_broad,
 {o.hours(_H, cfg.HOURS_EXPLORATORY)} AS by_exploratory FROM incidents""",
)
def d3(spark, sf):
    h = F.hour("Start_Time")
    return fx.incidents(spark, sf).select(
        "ID",
        tm.hour_bucket(h, cfg.HOURS_CLEANING).alias("by_cleaning"),
        tm.hour_bucket(h, cfg.HOURS_DASHBOARD).alias("by_dashboard"),
        tm.hour_bucket(h, cfg.HOURS_BROAD).alias("by_broad"),
        tm.hour_bucket(h, cfg.HOURS_EXPLORATORY).alias("by_exploratory"),
    )


@register("d4_is_rush_hour", f'SELECT "ID", {o.flag(f"{_H} IN ({o.RUSH})")} AS rush FROM incidents')
def d4(spark, sf):
    return fx.incidents(spark, sf).select("ID", tm.is_rush_hour(F.hour("Start_Time")).alias("rush"))


@register(
    "d5_is_weekend", f"""SELECT "ID", {o.flag('isodow("Start_Time") >= 6')} AS weekend FROM incidents"""
)
def d5(spark, sf):
    return fx.incidents(spark, sf).select(
        "ID", tm.is_weekend(tm.day_of_week("Start_Time")).alias("weekend")
    )


@register(
    "d6_day_name_from_index",
    'SELECT "ID", dayname("Start_Time") AS name FROM incidents',
)
def d6(spark, sf):
    return fx.incidents(spark, sf).select(
        "ID", tm.day_name_from_index(tm.day_of_week("Start_Time")).alias("name")
    )


@register(
    "d7_date_dimension",
    """SELECT d AS "Date", CAST(year(d) AS INT) AS "Year", CAST(quarter(d) AS INT) AS "Quarter",
 CAST(month(d) AS INT) AS "Month", monthname(d) AS "Month_Name", CAST(week(d) AS INT) AS "Week",
 CAST(day(d) AS INT) AS "Day", CAST(isodow(d) - 1 AS INT) AS "DayOfWeek",
 dayname(d) AS "DayOfWeek_Name", CAST(isodow(d) >= 6 AS INT) AS "Is_Weekend", 0 AS "Is_Holiday"
FROM (SELECT CAST(unnest(generate_series(CAST(lo AS DATE), CAST(hi AS DATE), INTERVAL 1 DAY))
  AS DATE) AS d FROM (SELECT min("Start_Time") AS lo, max("Start_Time") AS hi FROM incidents)) x""",
)
def d7(spark, sf):
    bounds = fx.incidents(spark, sf).agg(
        F.min("Start_Time").alias("start"), F.max("Start_Time").alias("end")
    )
    return ft.date_dimension(bounds)


def _scalar(name, expr_sql, make):
    @register(name, f'SELECT "ID", {expr_sql} FROM incidents')
    def run(spark, sf):
        return fx.incidents(spark, sf).select("ID", *make())


_scalar(
    "m1_high_severity_flag",
    f"""{o.flag('"Severity" >= 3')} AS flag""",
    lambda: [num.high_severity_flag("Severity").alias("flag")],
)
_WIDE = " + ".join(f'coalesce(CAST("{c}" AS INT), 0)' for c in cfg.INFRA_COLS_WIDE)
_scalar(
    "m2_infra_score",
    f"CAST({o.INFRA_SUM} AS INT) AS score, CAST({_WIDE} AS INT) AS score_wide",
    lambda: [
        num.infra_score().alias("score"),
        num.infra_score(cfg.INFRA_COLS_WIDE).alias("score_wide"),
    ],
)


@register(
    "m3_weighted_infra_score",
    f'SELECT "Location_id", CAST({o.WEIGHTED} AS BIGINT) AS score FROM dim_location',
)
def m3(spark, sf):
    return a6(spark, sf).select("Location_id", num.weighted_infra_score().alias("score"))


@register(
    "m4_dominant_feature", f'SELECT "Location_id", {o.dominant()} AS feature FROM dim_location'
)
def m4(spark, sf):
    return a6(spark, sf).select("Location_id", num.dominant_feature().alias("feature"))


_scalar(
    "m5_pct_change",
    f"""round_even(({T} - {V}) / nullif({V}, 0) * 100, 6) AS change,
 CASE WHEN {V} IS NULL OR {V} = 0 THEN 0 ELSE round_even(({T} - {V}) / nullif({V}, 0) * 100, 6) END
  AS impact""",
    lambda: [
        num.round_even(num.pct_change(TEMP, VIS), 6).alias("change"),
        num.round_even(num.impact_pct(TEMP, VIS), 6).alias("impact"),
    ],
)
_scalar(
    "m6_z_score",
    f"round_even(coalesce(({T} - {V}) / nullif({P}, 0), 0), 6) AS z",
    lambda: [num.round_even(num.z_score(TEMP, VIS, RAIN), 6).alias("z")],
)
_CAT = o.category(_W, cfg.WEATHER_RULES_AGGREGATE)


@register(
    "m7_weather_risk_score",
    f"""SELECT "ID", {o.risk_score('c', T, f'({V} * 10)')} AS score,
 {o.risk_score('c || "Description"', T, f'({V} * 10)', 0)} AS score_unknown
FROM (SELECT *, {_CAT} AS c FROM incidents) i""",
)
def m7(spark, sf):
    df = fx.incidents(spark, sf).withColumn(
        "c", tx.categorize_text("Weather_Condition", cfg.WEATHER_RULES_AGGREGATE)
    )
    wide = F.col(VIS) * 10
    unknown = F.concat("c", "Description")
    return df.select(
        "ID",
        num.weather_risk_score("c", TEMP, wide).alias("score"),
        num.weather_risk_score(unknown, TEMP, wide, 0).alias("score_unknown"),
    )


_scalar(
    "m8_risk_category",
    f"{o.risk_label(V)} AS risk",
    lambda: [num.risk_category(VIS).alias("risk")],
)
_scalar(
    "m9_anomaly_category",
    f"{o.anomaly(V)} AS anomaly",
    lambda: [num.anomaly_category(VIS).alias("anomaly")],
)
_scalar(
    "m10_severity_label",
    """CASE "Severity" WHEN 1 THEN 'Minor' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'Serious'
 WHEN 4 THEN 'Severe' ELSE 'Unknown' END AS label""",
    lambda: [num.severity_label("Severity").alias("label")],
)
_scalar(
    "m11_low_visibility_flag",
    f"{o.flag(f'{V} < 1')} AS flag",
    lambda: [num.low_visibility_flag(VIS).alias("flag")],
)
_scalar(
    "m12_round_even",
    f"round_even({T}, 1) AS one, round_even({T}, 2) AS two, round_even({V} / 8, 3) AS three",
    lambda: [
        num.round_even(TEMP, 1).alias("one"),
        num.round_even(TEMP, 2).alias("two"),
        num.round_even(F.col(VIS) / 8, 3).alias("three"),
    ],
)

# ================================================================ profiles


@register(
    "q1_null_profile",
    f"""SELECT "column", missing, round_even(missing_pct, 6) AS missing_pct
FROM ({_null_sql(o.RAW_COLS)}) x WHERE missing > 0""",
)
def q1(spark, sf):
    return rounded(pf.null_profile(fx.incidents(spark, sf)), 6, "missing_pct")


@register(
    "q2_duplicate_count",
    """SELECT CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS duplicates
FROM lineitem""",
)
def q2(spark, sf):
    return pf.duplicate_count(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "q2_duplicate_rows",
    """SELECT CAST((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM
 (SELECT DISTINCT * FROM lineitem) d) AS BIGINT) AS duplicates""",
)
def q2_rows(spark, sf):
    return pf.duplicate_count(table(spark, sf, "lineitem"))


@register(
    "q3_distinct_profile",
    "\nUNION ALL\n".join(
        f'SELECT {o.lit(c)} AS "column", count(DISTINCT {o.ident(c)}) AS n_distinct FROM incidents'
        for c in o.RAW_COLS
    ),
)
def q3(spark, sf):
    return pf.distinct_profile(fx.incidents(spark, sf))


def _range_sql(cols, source):
    return "\nUNION ALL\n".join(
        f'SELECT {o.lit(c)} AS "column", CAST(min({o.ident(c)}) AS DOUBLE) AS "min",'
        f' CAST(max({o.ident(c)}) AS DOUBLE) AS "max",'
        f" round_even((count(*) FILTER (WHERE {o.ident(c)} IS NULL))::DOUBLE / count(*) * 100, 6)"
        f" AS null_pct FROM {source}"
        for c in cols
    )


_NUMERIC = ["row_seq", "Severity", TEMP, VIS, RAIN]


@register(
    "q4_range_profile",
    _range_sql(_NUMERIC, "incidents"),
)
def q4(spark, sf):
    return rounded(pf.range_profile(fx.incidents(spark, sf)), 6, "null_pct")


@register("q4_sanity_check", _range_sql(["Duration_min", "Severity"], "cleaned"))
def q4_sanity(spark, sf):
    return rounded(pf.sanity_check(fx.cleaned(spark, sf)), 6, "null_pct")


_TYPES = {"row_seq": "bigint", "Severity": "int", TEMP: "double", VIS: "double", RAIN: "double"}
_TYPES |= {c: "timestamp_ntz" for c in ("Start_Time", "End_Time")}
_TYPES |= {
    c: "boolean"
    for c in ("Amenity", "Crossing", "Junction", "Railway", "Station", "Stop", "Traffic_Signal")
}


def _sample(c: str) -> str:
    first = f"arg_min({o.ident(c)}, row_seq) FILTER (WHERE {o.ident(c)} IS NOT NULL)"
    return f"CAST({first} AS VARCHAR)"


@register(
    "q5_column_profile",
    "\nUNION ALL\n".join(
        f'SELECT {i} AS "position", {o.lit(c)} AS "column",'
        f' {o.lit(_TYPES.get(c, "string"))} AS "type",'
        f" count({o.ident(c)}) AS non_null, {_sample(c)} AS sample,"
        f" regexp_matches({o.lit(c.lower())}, 'lat|lng|lon|coord') AS is_location"
        f" FROM incidents"
        for i, c in enumerate(o.RAW_COLS, 1)
    ),
)
def q5(spark, sf):
    return pf.column_profile(fx.incidents(spark, sf))


@register(
    "q5_shape",
    f"SELECT count(*) AS n_rows, {len(o.RAW_COLS)} AS n_columns FROM incidents",
)
def q5_shape(spark, sf):
    return pf.shape(fx.incidents(spark, sf))


def _box_sql(c):
    i = o.ident(c)
    return f"""SELECT {o.lit(c)} AS "column", {o.r('q1', 6)} AS q1, {o.r('q2', 6)} AS median,
 {o.r('q3', 6)} AS q3, min(CASE WHEN {i} >= q1 - 1.5 * (q3 - q1) THEN {i} END) AS whisker_low,
 max(CASE WHEN {i} <= q3 + 1.5 * (q3 - q1) THEN {i} END) AS whisker_high,
 count(*) FILTER (WHERE {i} < q1 - 1.5 * (q3 - q1) OR {i} > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM incidents, (SELECT quantile_cont({i}, 0.25) AS q1, quantile_cont({i}, 0.5) AS q2,
  quantile_cont({i}, 0.75) AS q3 FROM incidents) b GROUP BY q1, q2, q3"""


@register("q6_box_summary", "\nUNION ALL\n".join(_box_sql(c) for c in cfg.SENSOR_COLS))
def q6(spark, sf):
    return rounded(
        pf.box_summary(fx.incidents(spark, sf), cfg.SENSOR_COLS), 6, "q1", "median", "q3"
    )


# ================================================================ rules

_EVERY_CHECK = {
    "ID": {"null_pct_max": 0, "unique": True},
    "Severity": {"min": 1, "max": 4, "null_pct_max": 0},
    "City": {"null_pct_max": 0.005, "values": ["BUILDING", "MACHINERY", "FURNITURE"]},
    "Street": {"unique": True},
    TEMP: {"min": -20, "max": 120, "null_pct_max": 0.5},
    "Elevation": {"min": 0},
}


@register("q7_check_rules", o.rules_sql("incidents", "raw", _EVERY_CHECK, o.RAW_COLS))
def q7(spark, sf):
    return ru.check_rules(fx.incidents(spark, sf), "raw", _EVERY_CHECK)


@register(
    "q8_loader_rules",
    o.rules_sql("incidents", "loader", cfg.loader_rules(SETTINGS)),
)
def q8_loader(spark, sf):
    return ru.check_rules(fx.incidents(spark, sf), "loader", cfg.loader_rules(SETTINGS))


@register("q8_cleaner_rules", o.rules_sql("cleaned", "cleaner", cfg.cleaner_rules(SETTINGS)))
def q8_cleaner(spark, sf):
    return ru.check_rules(fx.cleaned(spark, sf), "cleaner", cfg.cleaner_rules(SETTINGS))


def _union_rules(tables, rules):
    found = [ru.check_rules(tables[name], name, rule) for name, rule in rules.items()]
    return reduce(DataFrame.unionByName, found)


def _union_rules_sql(rules, rename=None):
    return "\nUNION ALL\n".join(
        o.rules_sql((rename or {}).get(name, name), name, rule) for name, rule in rules.items()
    )


@register(
    "q8_star_rules", _union_rules_sql(cfg.star_rules(SETTINGS), {"accident_detail": "fact"})
)
def q8_star(spark, sf):
    return _union_rules(fx.star(spark, sf).tables(), cfg.star_rules(SETTINGS))


@register("q8_aggregate_rules", _union_rules_sql(cfg.aggregate_rules(SETTINGS)))
def q8_aggregates(spark, sf):
    aggs = jobs.build_aggregates(fx.star(spark, sf), SETTINGS)
    return _union_rules(aggs, cfg.aggregate_rules(SETTINGS))


@register("q9_range_findings", o.rules_sql("incidents", "raw", {VIS: {"min": 0, "max": 10}}))
def q9(spark, sf):
    return ru.range_findings(fx.incidents(spark, sf), VIS, 0, 10, "raw")


_OFF = """(SELECT count(*) FILTER (WHERE NOT coalesce(t BETWEEN 99 AND 101, false)) AS n FROM
 (SELECT sum(pct_of_state) AS t FROM agg_city_by_state GROUP BY "State") s) x"""


@register("q9_guard_range", 'SELECT "ID", "Duration_min" FROM cleaned')
def q9_guard(spark, sf):
    df = ru.guard_range(fx.cleaned(spark, sf), "Duration_min", 0, SETTINGS.duration_max_min, "cleaner")
    return df.select("ID", "Duration_min")


@register(
    "q10_check_percentages",
    o.rules_sql("agg_city_by_state", "city", {"pct_of_state": {"min": 0, "max": 100}})
    + "\nUNION ALL\n"
    + o.finding(
        "city", "'pct_of_state'", "sums_to_100", "n = 0", "'0 groups outside 99..101'",
        "CAST(n AS VARCHAR)", "groups outside:", _OFF,
    ),
)
def q10(spark, sf):
    return ru.check_percentages(a3(spark, sf), "pct_of_state", True, "State", "city")


@register(
    "q11_check_unique",
    'SELECT l_orderkey, count(*) AS "count" FROM lineitem GROUP BY 1 HAVING count(*) > 1',
)
def q11(spark, sf):
    return ru.check_unique(table(spark, sf, "lineitem"), "l_orderkey")


def _star_sql():
    parts = []
    for dim, fk, pk, counted in (
        ("dim_time", "full_date", "Date", "count(DISTINCT k)"),
        ("dim_location", "Location_id", "Location_id", "count(*)"),
        ("dim_weather", "weather_id", "weather_id", "count(*)"),
    ):
        parts.append(
            o.finding(
                "star", f"'{fk}'", "orphans", "n = 0", "'0'", "CAST(n AS VARCHAR)", "orphans:",
                f'(SELECT {counted} AS n FROM (SELECT "{fk}" AS k FROM fact) f'
                f' WHERE k NOT IN (SELECT "{pk}" FROM {dim})) x',
            )
        )
    parts.append(
        o.finding(
            "star", "'Duration_min'", "max", "m <= 1440", "'<= 1440.0'", o.text("m"),
            "largest value:", '(SELECT max("Duration_min") AS m FROM fact) x',
        )
    )
    return "\nUNION ALL\n".join(parts)


@register("q12_check_star", _star_sql())
def q12(spark, sf):
    return ru.check_star(fx.star(spark, sf), SETTINGS)


# ================================================================ reconciliation

_NUM = "coalesce(CAST({c} AS VARCHAR), 'null')"


def _n(c):
    return _NUM.format(c=c)


_BOTH = """(SELECT coalesce(m."State", a."State") || ' / ' || coalesce(m."City", a."City") AS name,
 n, n_high, p, total_accidents, total_high_severity, pct_of_state FROM
 (SELECT c."State", c."City", n, n_high, n::DOUBLE / n_state * 100 AS p FROM
  (SELECT "State", "City", count(*) AS n, count(*) FILTER (WHERE "Severity" >= 3) AS n_high
   FROM cleaned WHERE "State" IS NOT NULL GROUP BY 1, 2) c
  JOIN (SELECT "State", count(*) AS n_state FROM cleaned GROUP BY 1) s ON c."State" = s."State") m
 FULL JOIN agg_city_by_state a ON m."State" = a."State" AND m."City" = a."City") x"""

_CITY_SQL = "\nUNION ALL\n".join(
    [
        o.finding(
            "city_by_state", "name", "total_accidents",
            "n IS NOT DISTINCT FROM total_accidents", _n("n"), _n("total_accidents"),
            "aggregate says", _BOTH,
        ),
        o.finding(
            "city_by_state", "name", "total_high_severity",
            "n_high IS NOT DISTINCT FROM total_high_severity", _n("n_high"),
            _n("total_high_severity"), "aggregate says", _BOTH,
        ),
        o.finding(
            "city_by_state", "name", "pct_of_state", "abs(p - pct_of_state) < 0.1",
            _n("round_even(p, 2)"), _n("pct_of_state"), "aggregate says", _BOTH,
        ),
        o.finding(
            "city_by_state", "'pct_of_state'", "not_negative", "n = 0", "'0'",
            "CAST(n AS VARCHAR)", "negative rows:",
            "(SELECT count(*) FILTER (WHERE pct_of_state < 0) AS n FROM agg_city_by_state) x",
        ),
        o.finding(
            "city_by_state", "name", "sum_of_cities", "coalesce(n, 0) = coalesce(t, 0)", _n("n"),
            _n("t"), "aggregate says",
            """(SELECT coalesce(s."State", a."State") AS name, n, t FROM
 (SELECT "State", count(*) AS n FROM cleaned WHERE "State" IS NOT NULL GROUP BY 1) s
 FULL JOIN (SELECT "State", CAST(sum(total_accidents) AS BIGINT) AS t FROM agg_city_by_state
  GROUP BY 1) a ON s."State" = a."State") x""",
        ),
    ]
)


def _parts(spark, sf):
    # both the rows and the star are read many times
    df = materialize(fx.cleaned(spark, sf))
    return df, jobs.build_star(df, SETTINGS, verify=False)


@register("q13_reconcile_city", _CITY_SQL)
def q13(spark, sf):
    return rc.reconcile_city(a3(spark, sf), fx.cleaned(spark, sf), settings=SETTINGS)


_SIGNS = """(SELECT count(*) FILTER (WHERE "Weather_Category" = 'Clear'
  AND severity_increase_pct != 0) AS off,
 count(*) FILTER (WHERE severity_increase_pct < 0) AS neg,
 count(*) FILTER (WHERE risk_category NOT IN ('Extreme', 'High', 'Moderate', 'Low')) AS odd
FROM agg_weather_by_state) x"""
_RULE = o.category('"Weather_Condition"', cfg.WEATHER_RULES_AGGREGATE)
_WEATHER_SQL = "\nUNION ALL\n".join(
    [
        o.finding(
            "weather_by_state", "'severity_increase_pct'", "clear_is_zero", "off = 0", "'0'",
            "CAST(off AS VARCHAR)", "rows:", _SIGNS,
        ),
        o.finding(
            "weather_by_state", "'severity_increase_pct'", "not_negative", "neg = 0", "'0'",
            "CAST(neg AS VARCHAR)", "rows:", _SIGNS,
        ),
        o.finding(
            "weather_by_state", "'risk_category'", "values", "odd = 0", "'0'",
            "CAST(odd AS VARCHAR)", "rows:", _SIGNS,
        ),
        o.finding(
            "weather_by_state", "name", "severity_increase_pct",
            "abs(inc - severity_increase_pct) < 1", _n("round_even(inc, 2)"),
            _n("severity_increase_pct"), "aggregate says",
            f"""(SELECT a."State" || ' / ' || a."Weather_Category" AS name, severity_increase_pct,
 CASE WHEN ch < 0 THEN 0.0::DOUBLE ELSE ch END AS inc FROM
 (SELECT m.s, m.c, (m.v - k.v) / nullif(k.v, 0) * 100 AS ch FROM
  (SELECT "State" AS s, {_RULE} AS c, avg("Severity") AS v FROM cleaned
   WHERE "State" IS NOT NULL GROUP BY 1, 2) m
  JOIN (SELECT "State" AS s, avg("Severity") AS v FROM cleaned
   WHERE {_RULE} = 'Clear' GROUP BY 1) k ON m.s = k.s WHERE m.c != 'Clear') h
 JOIN agg_weather_by_state a ON h.s = a."State" AND h.c = a."Weather_Category") x""",
        ),
    ]
)


@register("q14_reconcile_weather", _WEATHER_SQL)
def q14(spark, sf):
    return rc.reconcile_weather(a4(spark, sf), fx.cleaned(spark, sf), settings=SETTINGS)


_TOTALS_SQL = "\nUNION ALL\n".join(
    o.finding(
        "totals", f"'{name}'", "sum_of_total_accidents", "t = n", "CAST(n AS VARCHAR)", _n("t"),
        "aggregate says",
        f"(SELECT CAST(sum(total_accidents) AS BIGINT) AS t,"
        f" (SELECT count(*) FROM cleaned) AS n FROM {name}) x",
    )
    for name in ("agg_federal", "agg_city_by_state", "agg_weather_by_state")
)


@register("q15_reconcile_totals", _TOTALS_SQL)
def q15(spark, sf):
    df, star = _parts(spark, sf)
    aggs = jobs.build_aggregates(star, SETTINGS)
    names = ("agg_federal", "agg_city_by_state", "agg_weather_by_state")
    return rc.reconcile_totals({n: aggs[n] for n in names}, df)


def _quality_sql(source):
    checks = [
        ("Severity", "domain", '"Severity" IS NULL OR "Severity" NOT IN (1, 2, 3, 4)'),
        ("Duration_min", "not_negative", '"Duration_min" < 0'),
        ("ID", "not_null", '"ID" IS NULL'),
        ("Severity", "not_null", '"Severity" IS NULL'),
        ("State", "not_null", '"State" IS NULL'),
        ("City", "not_null", '"City" IS NULL'),
    ]
    return "\nUNION ALL\n".join(
        o.finding(
            "data_quality", f"'{c}'", check, "n = 0", "'0'", "CAST(n AS VARCHAR)", "rows:",
            f"(SELECT count(*) FILTER (WHERE {bad}) AS n FROM {source}) x",
        )
        for c, check, bad in checks
    )


@register(
    "q16_check_quality",
    _quality_sql(f'(SELECT *, {_MIN} AS "Duration_min" FROM incidents) i'),
)
def q16(spark, sf):
    df = fx.incidents(spark, sf).withColumn(
        "Duration_min", tm.minutes_between("Start_Time", "End_Time")
    )
    return ru.check_quality(df, SETTINGS)


_ALL_FINDINGS = "\nUNION ALL\n".join(
    [_CITY_SQL, _WEATHER_SQL, _TOTALS_SQL, _quality_sql("cleaned")]
)


def _report_sql(findings):
    return f"""SELECT coalesce(stage, 'OVERALL') AS name,
 CASE WHEN bool_and(passed) THEN 'PASS' ELSE 'FAIL' END AS status,
 CAST(count(*) AS BIGINT) AS n_checks,
 CAST(count(*) FILTER (WHERE NOT passed) AS BIGINT) AS n_failed
FROM ({findings}) f GROUP BY ROLLUP (stage)"""


@register("q17_quality_report", _report_sql(_ALL_FINDINGS))
def q17(spark, sf):
    df, star = _parts(spark, sf)
    return rc.quality_report(
        jobs.validate_outputs(df, jobs.build_aggregates(star, SETTINGS), SETTINGS)
    )


# ================================================================ composed jobs


def _long(section, df, key, n, x):
    return df.select(
        F.lit(section).alias("section"),
        key.cast("string").alias("key"),
        n.cast("bigint").alias("n"),
        num.round_even(x, 6).alias("x"),
    )



@register(
    "k1_profile",
    f"""SELECT 'by_year' AS section, CAST("Year" AS VARCHAR) AS key, count(*) AS n,
 CAST(NULL AS DOUBLE) AS x FROM filtered GROUP BY "Year"
UNION ALL SELECT * FROM (SELECT 'top_hours', CAST({o.HOUR} AS VARCHAR), count(*) AS n, NULL
 FROM filtered GROUP BY {o.HOUR} ORDER BY n DESC, {o.HOUR} LIMIT 5) a
UNION ALL SELECT * FROM (SELECT 'top_states', "State", count(*) AS n, NULL FROM filtered
 WHERE "State" IS NOT NULL GROUP BY "State" ORDER BY n DESC, "State" LIMIT 10) b
UNION ALL SELECT * FROM (SELECT 'top_cities', "State" || ' / ' || "City", count(*) AS n, NULL
 FROM filtered WHERE "State" IS NOT NULL AND "City" IS NOT NULL GROUP BY "State", "City"
 ORDER BY n DESC, "State", "City" LIMIT 10) c
UNION ALL SELECT 'severity', CAST("Severity" AS VARCHAR), count("ID"), {o.r(f'avg({_MIN})', 6)}
 FROM filtered GROUP BY "Severity"
UNION ALL SELECT * FROM (SELECT 'missing', "column", missing, round_even(missing_pct, 6)
 FROM ({_null_sql(o.RAW_COLS, 'filtered')}) m WHERE missing > 0
 ORDER BY missing DESC, "column" LIMIT 10) d
UNION ALL SELECT 'duplicate_ids', 'ID', count(*) - count(DISTINCT "ID"), NULL FROM filtered
UNION ALL SELECT 'ranges_min', c, NULL, round_even(v, 6) FROM (
 SELECT 'Temperature(F)' AS c, min({T}) AS v FROM filtered
 UNION ALL SELECT 'Visibility(mi)', min({V}) FROM filtered
 UNION ALL SELECT 'Precipitation(in)', min({P}) FROM filtered) e
UNION ALL SELECT 'ranges_max', c, NULL, round_even(v, 6) FROM (
 SELECT 'Temperature(F)' AS c, max({T}) AS v FROM filtered
 UNION ALL SELECT 'Visibility(mi)', max({V}) FROM filtered
 UNION ALL SELECT 'Precipitation(in)', max({P}) FROM filtered) g""",
)
def k1(spark, sf):
    p = jobs.profile(fx.filtered(spark, sf))
    n, no = F.col("count"), F.lit(None).cast("double")
    parts = [
        _long("by_year", p["by_year"], F.col("Year"), n, no),
        _long("top_hours", p["top_hours"], F.col("Hour"), n, no),
        _long("top_states", p["top_states"], F.col("State"), n, no),
        _long("top_cities", p["top_cities"], F.concat_ws(" / ", "State", "City"), n, no),
        _long("severity", p["severity"], F.col("Severity"), n, F.col("avg_duration_min")),
        _long("missing", p["missing"], F.col("column"), F.col("missing"), F.col("missing_pct")),
        _long("duplicate_ids", p["duplicate_ids"], F.lit("ID"), F.col("duplicates"), no),
        _long("ranges_min", p["ranges"], F.col("column"), F.lit(None), F.col("min")),
        _long("ranges_max", p["ranges"], F.col("column"), F.lit(None), F.col("max")),
    ]
    return reduce(DataFrame.unionByName, parts)


@register("k2_clean", "SELECT * FROM cleaned")
def k2(spark, sf):
    return fx.cleaned(spark, sf)


@register(
    "k2_clean_report",
    f"""SELECT rows_in, rows_out, rows_in - rows_out AS rows_removed,
 {o.r(o.pct('rows_in - rows_out', 'rows_in'), 6)} AS removed_pct
FROM (SELECT (SELECT count(*) FROM filtered) AS rows_in, (SELECT count(*) FROM cleaned) AS rows_out)""",
)
def k2_report(spark, sf):
    before = fx.filtered(spark, sf)
    after = jobs.clean(before, SETTINGS)
    return rounded(jobs.clean_report(before, after), 6, "removed_pct")


@register("k3_build_star", _STAR_CONTENTS)
def k3(spark, sf):
    return star_contents(fx.star(spark, sf, verify=True))


_K4 = {
    "agg_federal": ('CAST("Year" AS VARCHAR)', "NULL", "yoy_change_pct", "high_severity_pct"),
    "agg_state_anomaly": ('"State"', 'CAST("Year" AS VARCHAR)', "severity_zscore", "pct_of_national"),
    "agg_city_by_state": ('"State"', '"City"', "pct_of_state", "severity_vs_state"),
    "agg_weather_by_state": (
        '"State"', '"Weather_Category"', "severity_increase_pct", "duration_increase_pct"
    ),
    "agg_time_pattern": (
        'CAST("Hour" AS VARCHAR)', 'CAST("DayOfWeek" AS VARCHAR)', "hotspot_score", "avg_severity"
    ),
}


@register(
    "k4_build_aggregates",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS name, {k1} AS k1, CAST({k2} AS VARCHAR) AS k2, total_accidents,"
        f" avg_severity, avg_duration_min, {m1} AS m1, {m2} AS m2 FROM {name}"
        for name, (k1, k2, m1, m2) in _K4.items()
    ),
)
def k4(spark, sf):
    aggs = jobs.build_aggregates(fx.star(spark, sf), SETTINGS)
    parts = [
        aggs[name].select(
            F.lit(name).alias("name"),
            F.expr(k1.replace('"', "`").replace("VARCHAR", "STRING")).alias("k1"),
            F.expr(k2.replace('"', "`").replace("VARCHAR", "STRING")).cast("string").alias("k2"),
            "total_accidents",
            "avg_severity",
            "avg_duration_min",
            F.col(m1).alias("m1"),
            F.col(m2).alias("m2"),
        )
        for name, (k1, k2, m1, m2) in _K4.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@register("k5_validate_outputs", _ALL_FINDINGS)
def k5(spark, sf):
    df, star = _parts(spark, sf)
    return jobs.validate_outputs(df, jobs.build_aggregates(star, SETTINGS), SETTINGS)


@register("k6_run_etl", _report_sql(_star_sql() + "\nUNION ALL\n" + _ALL_FINDINGS))
def k6(spark, sf):
    source, out = scratch_path(spark, "raw-csv"), scratch_path(spark, "etl")
    io.write_table(fx.incidents(spark, sf), source, "csv")
    return jobs.run_etl(spark, source, out, SETTINGS).report
