"""Incident rows derived from the given tables, in Spark and as SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from wayside.config import Settings
from wayside.operators.cleaning import filter_years
from wayside.operators.star import DIMENSIONS, Star
from wayside.plans import jobs

SETTINGS = Settings(start_year=1996, end_year=1999)

INCIDENTS_SQL = """
SELECT id AS "ID", o_orderkey AS row_seq, sev AS "Severity", st AS "Start_Time",
 st + INTERVAL '1' MINUTE * CAST(FLOOR(o_totalprice/200 - 100) AS INT) AS "End_Time",
 CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE c_mktsegment END AS "City",
 'S' || CAST(o_custkey % 300 AS VARCHAR(20)) AS "Street", r_name AS "County",
 CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE n_name END AS "State", r_name AS "Timezone",
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE c_acctbal/50 - 20 END AS "Temperature(F)",
 CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST((o_orderkey % 130) - 5 AS DOUBLE)/10 END
   AS "Visibility(mi)",
 CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey % 60 AS DOUBLE)/10 END
   AS "Precipitation(in)",
 CASE o_orderkey % 9 WHEN 0 THEN 'Light Rain' WHEN 1 THEN 'Heavy Snow' WHEN 2 THEN 'Fog'
   WHEN 3 THEN 'Mostly Cloudy' WHEN 4 THEN 'Fair' WHEN 5 THEN 'Thunderstorm'
   WHEN 6 THEN 'Ice Pellets / Rain' WHEN 7 THEN 'Patches of Fog / Windy' END
   AS "Weather_Condition",
 o_orderkey % 10 = 0 AS "Amenity", o_orderkey % 5 = 0 AS "Crossing",
 o_orderkey % 6 = 0 AS "Junction", o_orderkey % 50 = 0 AS "Railway",
 o_orderkey % 40 = 0 AS "Station", o_orderkey % 12 = 0 AS "Stop",
 o_orderkey % 4 = 0 AS "Traffic_Signal", o_orderstatus AS "Description"
FROM (SELECT 'A-' || CAST(o_orderkey AS VARCHAR(20)) AS id,
   CAST(SUBSTR(o_orderpriority,1,1) AS INT) AS sev,
   o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey * 7 % 24 AS INT) AS st, o.*, c.*, n.*, r.*
 FROM {orders} o JOIN {customer} c ON o_custkey=c_custkey
   JOIN {nation} n ON c_nationkey=n_nationkey JOIN {region} r ON n_regionkey=r_regionkey) q
"""

RAW_TIMES_SQL = """
SELECT row_seq,
 CASE row_seq % 7 WHEN 0 THEN txt || '.000000000' WHEN 1 THEN txt || '.000000'
   WHEN 2 THEN '  ' || txt || ' ' WHEN 3 THEN txt || 'Z' WHEN 4 THEN 'n/a'
   WHEN 5 THEN NULL ELSE txt END AS "Start_Text"
FROM (SELECT row_seq, CAST("Start_Time" AS VARCHAR(40)) AS txt FROM {incidents}) q
"""


HASHED_IDS_SQL = """
SELECT * EXCEPT (row_seq, "ID"), CASE WHEN row_seq % 2 = 0 THEN 'x' || substr(md5("ID"), 1, 20) || 'x'
 WHEN row_seq % 5 = 0 THEN 'B-' || CAST(row_seq DIV 7 AS STRING) ELSE "ID" END AS "ID" FROM {cleaned}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("orders", "customer", "nation", "region")
    return spark.sql(
        INCIDENTS_SQL.replace('"', "`"), **{n: table(spark, sf_dir, n) for n in names}
    )


def raw_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_TIMES_SQL.replace('"', "`"), incidents=incidents(spark, sf_dir))


def filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_years(incidents(spark, sf_dir), SETTINGS.start_year, SETTINGS.end_year)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.clean(filtered(spark, sf_dir), SETTINGS)


def star(
    spark: SparkSession, sf_dir: str, dims: Sequence[str] = DIMENSIONS, verify: bool = False
) -> Star:
    """The star of the cleaned rows; only the query about building it verifies it."""
    return jobs.build_star(cleaned(spark, sf_dir), SETTINGS, dims, verify)


def hashed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned rows without ``row_seq``, half of their IDs without a number."""
    return spark.sql(
        HASHED_IDS_SQL.replace('"', "`"), cleaned=cleaned(spark, sf_dir)
    )
