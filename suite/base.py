"""Input views over the driver tables and the registry of queries.

A view is one SQL text that both engines run. Braces mark the driver table it reads.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seepline.session import checkpointed

VIEWS: dict[str, tuple[str, str]] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def define_view(name: str, table: str, text: str) -> None:
    VIEWS[name] = (table, " ".join(text.split()))


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def numbered(df: DataFrame, column: str = "position") -> DataFrame:
    """Sorted rows with their place, from 0, over all partitions: ids that grow along the
    partitions, less what each partition skips."""
    placed = checkpointed(df.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition
    before = sizes.withColumn("_before", F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).select("_part", "_before")
    met = placed.withColumn("_part", part).join(before, "_part")
    return met.withColumn(column, F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id", "_part", "_before")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    table, text = VIEWS[name]
    return spark.sql(text, **{table: read_table(spark, folder, table)})


class Inputs:
    """The views of one data folder, built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.folder, f"wq_{name}")


def query(key: str, sql: str | None = None):
    """Register ``fn(inputs)`` under ``key``, with the SQL that gives the same rows."""

    def register(fn: Callable[[Inputs], DataFrame]):
        assert key not in QUERIES, key
        QUERIES[key] = lambda spark, folder: fn(Inputs(spark, folder))
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return fn

    return register


def with_views(body: str) -> str:
    """``body`` preceded by the views it names."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", body)]
    heads = [
        f"{v} AS ({VIEWS[v][1].replace('{' + VIEWS[v][0] + '}', VIEWS[v][0])})" for v in used
    ]
    body = body.strip()
    own = re.match(r"WITH\s+", body)
    if own:
        return "WITH " + ", ".join(heads + [body[own.end():]])
    return ("WITH " + ", ".join(heads) + " " if heads else "") + body


define_view("wq_stations", "supplier", """
SELECT CAST(1000+s_suppkey AS STRING) AS locationid, s_name AS locationname,
 CASE s_suppkey%5 WHEN 0 THEN 'Well' WHEN 1 THEN 'Spring' WHEN 2 THEN 'River/Stream' WHEN 3 THEN 'Atmosphere' END AS locationtype,
 37+CAST(s_suppkey%50 AS DOUBLE)/10 AS latitude, -114+CAST(s_suppkey%40 AS DOUBLE)/10 AS longitude,
 CASE WHEN s_acctbal<0 THEN 0 ELSE s_acctbal END AS verticalmeasure,
 CASE WHEN s_nationkey%4<>0 THEN 1 ELSE 0 END AS send,
 CASE WHEN s_suppkey%3=0 THEN CONCAT('USGS-',s_suppkey) END AS usgs_id,
 CASE WHEN s_suppkey%4=0 THEN CONCAT('W',s_suppkey) END AS win,
 CASE WHEN s_suppkey%5=0 THEN CONCAT('WR',s_suppkey) END AS wrnum
FROM {supplier}""")
define_view("wq_sites", "supplier", """
SELECT CAST(1000+s_suppkey AS STRING) AS locationid, s_name AS locationname,
 CASE WHEN s_suppkey%9=0 THEN NULL ELSE 37+CAST(s_suppkey%50 AS DOUBLE)/10 END AS latitude,
 -114+CAST(s_suppkey%40 AS DOUBLE)/10 AS longitude,
 CASE s_suppkey%3 WHEN 0 THEN 'UTAHGS' WHEN 1 THEN 'USGS-UT' ELSE 'UTAHDWQ' END AS organization,
 CONCAT('US:', CASE s_nationkey%3 WHEN 0 THEN '49' WHEN 1 THEN '04' ELSE '08' END) AS state,
 CONCAT('US:', CASE s_nationkey%3 WHEN 0 THEN '49' WHEN 1 THEN '04' ELSE '08' END, ':', CASE s_suppkey%4 WHEN 0 THEN '035' WHEN 1 THEN '049' ELSE '003' END) AS county,
 CASE s_suppkey%4 WHEN 0 THEN '16020304' WHEN 1 THEN '16030001' WHEN 2 THEN '14010005' END AS huc8,
 CASE s_suppkey%3 WHEN 0 THEN CAST(500+20*s_suppkey AS STRING) WHEN 1 THEN CONCAT('USGS-',s_suppkey) END AS altlocationid,
 CAST(s_suppkey%7 AS DOUBLE) AS offset, CASE s_suppkey%2 WHEN 0 THEN 'inbarologger' ELSE 'none' END AS barologgertype,
 CASE s_suppkey%6 WHEN 0 THEN 'Bryce' WHEN 1 THEN 'Castle Valley' WHEN 2 THEN 'Snake Valley Wetlands' WHEN 3 THEN 'Unlisted network' WHEN 4 THEN 'UGS-NGWMN' END AS qwnetworkname
FROM {supplier}""")
define_view("wq_activities", "orders", """
SELECT CONCAT('A',o_orderkey,CASE WHEN o_orderkey%7=0 THEN '-FM' ELSE '' END) AS activityid,
 CAST(1000+o_orderkey%60 AS STRING) AS monitoringlocationid,
 CAST(o_orderdate AS DATE) AS activitystartdate,
 CASE WHEN o_orderkey%11=0 THEN '25:10' WHEN o_orderkey%11=1 THEN '9:30:00' ELSE '9:30' END AS activitystarttime,
 CASE WHEN o_orderstatus='P' THEN NULL ELSE 'UNGWMN' END AS projectid,
 CASE WHEN o_orderkey%5=0 THEN NULL ELSE CAST(5+o_orderkey%20 AS DOUBLE) END AS temperature_c,
 CAST(200+o_orderkey%900 AS DOUBLE) AS conduct_uscm, CAST(6+o_orderkey%3 AS DOUBLE) AS ph
FROM {orders}""")
define_view("wq_results", "lineitem", """
SELECT CONCAT('A',l_orderkey,CASE WHEN l_orderkey%7=0 THEN '-FM' ELSE '' END) AS activityid,
 CAST(1000+l_orderkey%60 AS STRING) AS monitoringlocationid,
 CASE l_partkey%8 WHEN 0 THEN 'Nitrate' WHEN 1 THEN 'Arsenic' WHEN 2 THEN 'Sulfate as S' WHEN 3 THEN 'Orthophosphate' WHEN 4 THEN 'Ammonia and ammonium' WHEN 5 THEN 'Chloride' WHEN 6 THEN 'Sulfate' ELSE 'pH' END AS characteristicname,
 CONCAT(CASE WHEN l_discount<0.025 THEN '<' WHEN l_discount>0.095 THEN '>' ELSE '' END, CAST(CAST(l_quantity AS INT) AS STRING)) AS resultvalue,
 CASE l_partkey%8 WHEN 0 THEN 'mg/l as N' WHEN 1 THEN 'ug/L' WHEN 3 THEN 'mg/l as P' WHEN 7 THEN 'NONE' ELSE 'mg/L ' END AS resultunit,
 CAST(10*CEIL(l_quantity/10) AS DOUBLE) AS detecquantlimitmeasure, l_linenumber AS resultline
FROM {lineitem}""")
define_view("wq_majors", "lineitem", """
SELECT CONCAT('S',l_orderkey,'-',l_linenumber) AS sampleid, CAST(1000+l_orderkey%60 AS STRING) AS monitoringlocationid,
 CAST(l_shipdate AS DATE) AS sampledate,
 20+l_quantity AS Ca, CAST(5+l_partkey%30 AS DOUBLE) AS Mg, CAST(10+l_suppkey%60 AS DOUBLE) AS Na, CAST(1+l_linenumber AS DOUBLE) AS K,
 CAST(100+l_orderkey%150 AS DOUBLE) AS HCO3, CAST(l_orderkey%5 AS DOUBLE) AS CO3, CAST(10+l_partkey%80 AS DOUBLE) AS Cl,
 CASE WHEN l_orderkey%13=0 THEN NULL ELSE CAST(15+l_suppkey%90 AS DOUBLE) END AS SO4, CAST(6+l_linenumber%3 AS DOUBLE) AS pH
FROM {lineitem}""")
define_view("wq_censored", "lineitem", """
SELECT locationid, characteristic, censorship,
 CASE WHEN censorship AND locationid=2 AND l_linenumber=1 THEN CAST(60 AS DOUBLE)
      WHEN censorship THEN CAST(10*CEIL(l_quantity/10) AS DOUBLE) ELSE l_quantity END AS result
FROM (SELECT l_suppkey%20 AS locationid, l_partkey%6 AS characteristic, l_quantity, l_linenumber,
 CASE l_suppkey%20 WHEN 0 THEN FALSE WHEN 1 THEN l_discount<0.085 ELSE l_discount<0.035 END AS censorship FROM {lineitem}) x""")
# results up to a date have been published, about two thirds; the others stand under keys
# that nobody asks for, and a tenth of the locations are published under such keys alone
define_view("wq_published", "lineitem", """
SELECT CONCAT('UTAHGS-',CASE WHEN CAST(l_shipdate AS DATE) < DATE '1999-09-01' THEN 'A' ELSE 'Z' END,l_orderkey,CASE WHEN l_orderkey%7=0 THEN '-FM' ELSE '' END) AS activityid,
 CONCAT('UTAHGS-',CAST(1000+l_orderkey%60+CASE WHEN l_orderkey%60 IN (3,17,22,31,46,59) THEN 5000 ELSE 0 END AS STRING)) AS monitoringlocationid,
 CASE l_partkey%8 WHEN 0 THEN 'Nitrate' WHEN 1 THEN 'Arsenic' WHEN 2 THEN 'Sulfate as S' WHEN 3 THEN 'Orthophosphate' WHEN 4 THEN 'Ammonia and ammonium' WHEN 5 THEN 'Chloride' WHEN 6 THEN 'Sulfate' ELSE 'pH' END AS characteristicname
FROM {lineitem}""")
# a portal extract; the Spark side gives the columns their file headers
define_view("wq_portal", "lineitem", """
SELECT CASE l_suppkey%3 WHEN 0 THEN 'UTAHGS' WHEN 1 THEN 'USGS-UT' ELSE 'UTAHDWQ' END AS org,
 CASE WHEN l_orderkey%101=0 THEN NULL ELSE CONCAT('UTAHGS-A',l_orderkey) END AS act,
 CASE WHEN l_orderkey%17=0 THEN 'bad' WHEN l_orderkey%19=0 THEN '2019-13-01' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS act_date,
 CASE l_orderkey%7 WHEN 0 THEN NULL WHEN 1 THEN '9:30' WHEN 2 THEN '9:30:00' WHEN 3 THEN '930' WHEN 4 THEN '25:10' WHEN 5 THEN ' 10:45:00' ELSE '10:75' END AS act_time,
 CONCAT(CASE l_suppkey%2 WHEN 0 THEN 'UTAHGS_WQX-' ELSE 'UTAHGS-' END, CAST(1000+l_orderkey%60 AS STRING)) AS loc,
 CASE l_partkey%12 WHEN 0 THEN 'Nitrate' WHEN 1 THEN 'Arsenic' WHEN 2 THEN 'Sulfate as S' WHEN 3 THEN 'Orthophosphate' WHEN 4 THEN ' Ammonia and ammonium' WHEN 5 THEN 'Chloride' WHEN 6 THEN 'Sulfate' WHEN 7 THEN 'pH' WHEN 8 THEN 'Phosphate-phosphorus' WHEN 9 THEN 'Calcium' WHEN 10 THEN 'Bicarbonate' END AS chr,
 CASE l_linenumber%6 WHEN 0 THEN CONCAT('<', CAST(CAST(l_quantity AS INT) AS STRING)) WHEN 1 THEN '1.5d' WHEN 2 THEN 'nan' ELSE CAST(l_quantity/4 AS STRING) END AS val,
 CASE l_partkey%12 WHEN 0 THEN 'mg/l as N' WHEN 1 THEN 'ug/L  ' WHEN 3 THEN 'MG/L as P' WHEN 7 THEN 'NONE' WHEN 11 THEN NULL ELSE 'mg/L' END AS unit,
 CASE WHEN l_discount<0.025 THEN 'Not Detected' END AS cond,
 CASE WHEN l_linenumber=1 THEN 'n/a' ELSE CAST(l_quantity/8 AS STRING) END AS lim,
 'STORET' AS provider, CASE l_returnflag WHEN 'A' THEN 'J' END AS qual
FROM {lineitem}""")
define_view("wq_portal_stations", "customer", """
SELECT CONCAT(CASE c_custkey%2 WHEN 0 THEN 'UTAHGS_WQX-' ELSE 'UTAHGS-' END, CAST(1000+c_custkey%400 AS STRING)) AS loc,
 c_name AS name, CASE c_custkey%5 WHEN 0 THEN 'River/Stream' WHEN 1 THEN 'Stream: Canal' WHEN 2 THEN 'Well: Test hole not completed as a well' WHEN 3 THEN 'Spring' END AS typ,
 '16020304' AS huc, 37+CAST(c_custkey%50 AS DOUBLE)/10 AS lat, -114+CAST(c_custkey%40 AS DOUBLE)/10 AS lon,
 CASE WHEN c_acctbal<0 THEN 0 ELSE c_acctbal END AS elev, CAST(NULL AS STRING) AS aquifer, 'US' AS country, 'STORET' AS provider
FROM {customer}""")
define_view("wq_state_lab", "lineitem", """
SELECT CONCAT('SL',l_orderkey) AS sample_number, CONCAT(CAST(CAST(l_shipdate AS DATE) AS STRING),' 00:00:00') AS sample_date, '10:15' AS sample_time,
 CASE l_suppkey%22 WHEN 0 THEN 'NGWMN-FAIRFIELD WELL' WHEN 1 THEN 'BRYCE CANYON BC26W RICH' WHEN 2 THEN 'sp antelope 3' WHEN 3 THEN 'WL-T34-190605' WHEN 4 THEN 'keg spr !piez' WHEN 5 THEN 'PORCUPINE RANCH'
  WHEN 6 THEN 'irr well 13' WHEN 7 THEN 'nothing known' WHEN 8 THEN 'mud hole 2' WHEN 9 THEN 'golf moab' WHEN 10 THEN 'Jenks house' WHEN 11 THEN '401656112020301 dup' WHEN 12 THEN 'NGWMN - WL-FLOWELL WELL-2019'
  WHEN 13 THEN 'BRYCE CANYON BC22W RUBY 3' WHEN 14 THEN 'AGI3C NGWMN WL-AGI3C-2019' WHEN 15 THEN 'T8' WHEN 16 THEN 'BC51W BRYCE CANYON BRISTLE CONE' WHEN 17 THEN 'sp willow !piez' WHEN 18 THEN 'NORTH NORTH BEDKE SPRING' WHEN 19 THEN 'WL-67-3499-2019' WHEN 20 THEN 'MUD 1' END AS description,
 CASE l_linenumber%4 WHEN 0 THEN 'K. Lee' ELSE NULL END AS collector,
 CASE l_partkey%3 WHEN 0 THEN 'SM' WHEN 1 THEN 'EPA' END AS agency, CASE l_partkey%4 WHEN 0 THEN '300.0' WHEN 1 THEN '2320B' ELSE '200.8' END AS method,
 CASE l_partkey%5 WHEN 0 THEN 'Water, Filtered' WHEN 1 THEN ' Water, Filtered ' WHEN 2 THEN 'Water' END AS matrix,
 CAST(l_quantity/4 AS STRING) AS val, CAST(10*CEIL(l_quantity/10) AS DOUBLE) AS low_limit, CAST(l_linenumber AS DOUBLE) AS detect_limit,
 CASE l_partkey%6 WHEN 0 THEN 'MG-L' WHEN 1 THEN 'UG-L' WHEN 2 THEN 'NONE' WHEN 3 THEN 'UMHOS-CM' WHEN 4 THEN 'deg C' END AS units,
 CONCAT(CAST(CAST(l_shipdate AS DATE) AS STRING),' 12:00:00') AS analysis_date,
 CASE l_partkey%12 WHEN 0 THEN 'Alkalinity as Calcium Carbonate' WHEN 1 THEN 'Nitrate as Nitrogen' WHEN 2 THEN 'Total Phosphate' WHEN 3 THEN 'Ca' WHEN 4 THEN 'Hardness as Carbonate' WHEN 5 THEN 'Sulfate' WHEN 6 THEN 'Silica as SiO2' WHEN 7 THEN ' Alkalinity ' WHEN 8 THEN 'Chloride' WHEN 9 THEN 'NO3-N' WHEN 10 THEN 'Arsenic' END AS param,
 CASE l_linenumber%5 WHEN 0 THEN '<' WHEN 1 THEN '>' END AS problem, CASE l_partkey%7 WHEN 0 THEN 'U' WHEN 1 THEN 'J' END AS code
FROM {lineitem}""")
define_view("wq_epa_lab", "orders", """
SELECT 'EPA R8' AS laboratory, CONCAT('E',o_orderkey) AS lab_number, CAST(1000+o_orderkey%60 AS STRING) AS sample_name,
 CASE o_custkey%5 WHEN 0 THEN 'EPA 300.0' WHEN 1 THEN 'SM4500/B' WHEN 2 THEN '2320B' WHEN 3 THEN 'EPA200' END AS method,
 CASE o_custkey%8 WHEN 0 THEN 'Nitrate as N' WHEN 1 THEN 'Sulfate as SO4' WHEN 2 THEN 'Arsenic' WHEN 3 THEN 'Mercury as Hg' WHEN 4 THEN 'Orthophosphate as P' WHEN 5 THEN 'Ammonia as N' WHEN 6 THEN 'Chloride' ELSE 'Nitrite as N' END AS analyte,
 CAST(o_orderkey%40 AS DOUBLE)/8 AS report_limit,
 CASE o_orderkey%8 WHEN 0 THEN '<0.5' WHEN 1 THEN '>9' WHEN 2 THEN '4.2 [x]' WHEN 3 THEN '1.5d' WHEN 4 THEN '' WHEN 5 THEN '[<1]' WHEN 6 THEN NULL ELSE CAST(CAST(o_orderkey%1000 AS DOUBLE)/4 AS STRING) END AS val,
 CASE o_orderkey%9 WHEN 0 THEN 'J' WHEN 1 THEN 'B' END AS qual, CASE o_custkey%3 WHEN 0 THEN 'WET' WHEN 1 THEN 'DIS WET' ELSE 'MET' END AS class,
 CASE o_custkey%6 WHEN 0 THEN 'ug/L' WHEN 1 THEN 'mg/L' WHEN 2 THEN 'NONE' WHEN 3 THEN 'UMHOS-CM' WHEN 4 THEN 'deg C' END AS units,
 CONCAT(CAST(CAST(o_orderdate AS DATE) AS STRING), CASE o_orderkey%3 WHEN 0 THEN ' 09:05:00' WHEN 1 THEN ' 14:30:59' ELSE ' 00:00:00' END) AS sampled,
 CONCAT(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 16:00:00') AS analyzed, o_orderpriority AS batch
FROM {orders}""")
define_view("wq_domain", "part", """
SELECT p_partkey AS pk_isn,
 CASE p_partkey%8 WHEN 0 THEN 'Nitrate' WHEN 1 THEN 'Arsenic' WHEN 2 THEN 'Unused name' WHEN 3 THEN 'Orthophosphate' WHEN 4 THEN 'Sulfate' WHEN 5 THEN 'Chloride' WHEN 6 THEN 'Alkalinity, total' ELSE 'Unlisted' END AS registry_name,
 CASE WHEN p_partkey%24=8 OR p_partkey%40=1 THEN NULL WHEN p_partkey%40=3 THEN 'Nutrient, other' ELSE CASE p_partkey%8 WHEN 0 THEN 'Nutrient' WHEN 1 THEN 'Inorganics, Minor, Metals' WHEN 3 THEN 'Nutrient' WHEN 4 THEN 'Inorganics, Major, Non-metals' WHEN 5 THEN 'Inorganics, Major, Non-metals' WHEN 6 THEN 'Physical' END END AS characteristic_group_type,
 CONCAT('SRS',p_partkey%8) AS srs_id, CONCAT('CAS',p_partkey%8) AS cas_number, p_brand AS extra
FROM {part}""")
define_view("wq_substances", "part", """
SELECT CASE p_partkey%6 WHEN 0 THEN 'Nitrate' WHEN 1 THEN 'Arsenic' WHEN 2 THEN 'Orthophosphate' WHEN 3 THEN 'Chloride' WHEN 4 THEN 'Sulfate' ELSE 'Calcium' END AS epaname,
 CASE WHEN p_partkey%30<6 THEN NULL ELSE CAST(10+p_partkey%6+p_partkey%5 AS DOUBLE) END AS molecularweight,
 CASE WHEN p_partkey%7=0 THEN NULL ELSE CONCAT('F',p_partkey%21) END AS molecularformula, CONCAT('C',p_partkey%12) AS currentcasnumber
FROM {part}""")
define_view("wq_matches", "orders", """
SELECT CONCAT(CASE WHEN o_orderstatus='P' THEN 'XX' ELSE 'SL' END, o_orderkey - CASE WHEN o_orderkey%4=1 THEN 1 ELSE 0 END) AS sample_number,
 CASE WHEN o_custkey%9=0 THEN NULL ELSE CAST(CAST(1000+o_custkey%100 AS BIGINT) AS DOUBLE) END AS station_id FROM {orders}""")
# two rows of a location, with different networks or without one
define_view("wq_networks", "supplier", """
SELECT CAST(1000+s_suppkey-s_suppkey%2 AS STRING) AS locationid,
 CASE s_suppkey%6 WHEN 0 THEN 'Bryce' WHEN 1 THEN 'Castle Valley' WHEN 2 THEN 'Snake Valley Wetlands' WHEN 3 THEN 'Unlisted network' WHEN 4 THEN 'UGS-NGWMN' END AS qwnetworkname
FROM {supplier}""")
define_view("wq_counties", "nation", """
SELECT CASE n_regionkey WHEN 0 THEN '04' WHEN 1 THEN '49' ELSE '08' END AS state, n_name AS name, CONCAT('0', CAST(10+n_nationkey AS STRING)) AS county FROM {nation}""")
define_view("wq_organizations", "nation", """
SELECT CONCAT('Agency of ', n_name) AS descr, CONCAT('ORG', n_nationkey) AS value FROM {nation}""")
