"""Catalog tables derived from the driver's test tables.

The test tables hold no file catalog, so the catalog inputs are derived from
them with plain SQL that runs unchanged in Spark and in DuckDB (the oracle):

* ``remote_listing`` from ``orders``: one raw directory-listing line per order,
  with all nine name shapes, blanks in names, upper-case extensions, bad sizes,
  one nested directory and both centuries of listing dates.
* ``local_store`` from ``lineitem``: a local store with several version dates
  per partition, final and preliminary names in one group, and bad names.

Both grow linearly with the source tables; nothing is sampled or capped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

REMOTE_LISTING_SQL = """\
SELECT id, dir, name, line, mtime, size_txt FROM (
SELECT o.*, (mm || '-' || dd || '-' || substr(yyyy, 3, 2) || '  ' || hh || ':' || mi || ap || '  ' || size_txt || ' ' || name) AS line
FROM (
SELECT id, yyyy, mm, dd, mi, size_txt, hour24, mtime,
  lpad(CAST(CASE WHEN hour24 % 12 = 0 THEN 12 ELSE hour24 % 12 END AS STRING), 2, '0') AS hh,
  CASE WHEN hour24 < 12 THEN 'AM' ELSE 'PM' END AS ap,
  CASE kind WHEN 0 THEN b || '/SIHSUS/200801_/Dados' WHEN 1 THEN b || '/SIHSUS/200801_/Dados'
    WHEN 2 THEN b || '/SIASUS/200801_/Dados' WHEN 3 THEN b || '/SINASC/1996_/Dados/DNRES'
    WHEN 4 THEN b || '/SINASC/1996_/Dados/DNRES' WHEN 5 THEN b || '/SIM/PRELIM/DORES'
    WHEN 6 THEN b || '/SIM/CID10/DOFET' WHEN 7 THEN b || '/SINAN/DADOS/FINAIS'
    WHEN 8 THEN '/territorio/mapas' WHEN 9 THEN '/territorio/conversoes'
    WHEN 10 THEN '/territorio/tabelas/sub' ELSE b || '/SIM/CID10/DORES' END AS dir,
  CASE kind WHEN 0 THEN 'RD' || uf || yy || mm || '.dbc' WHEN 1 THEN 'sp' || lower(uf) || yy || mm || '.DBC'
    WHEN 2 THEN 'PA' || uf || yy || mm || substr('ab', CAST(id % 5 AS INT) + 1, 1) || '.dbc'
    WHEN 3 THEN 'DN' || uf || yyyy || '.dbc' WHEN 4 THEN 'DNEX' || yyyy || '.dbc'
    WHEN 5 THEN 'DO' || uf || yyyy || '.dbc' WHEN 6 THEN 'DOINF' || yy || '.dbc'
    WHEN 7 THEN 'DENG' || uf || yy || '.dbc' WHEN 8 THEN lower(uf) || '_mapas_' || yyyy || '.zip'
    WHEN 9 THEN uf || '_cnv.zip' WHEN 10 THEN 'tab ' || CAST(id AS STRING) || '.zip'
    ELSE CASE WHEN id % 24 = 11 THEN 'LEIAME ' || CAST(id AS STRING) || '.txt' ELSE 'DO' || uf || yyyy || '.dbc' END END AS name
FROM (
SELECT o_orderkey AS id, o_orderkey % 12 AS kind, '/dissemin/publicos' AS b, o_orderkey % 24 AS hour24,
  o_orderdate AS mtime,
  split_part('AC,AL,AP,AM,BA,CE,DF,ES,GO,MA,MT,MS,MG,PA,PB,PR,PE,PI,RJ,RN,RS,RO,RR,SC,SP,SE,TO,BR', ',', CAST(o_custkey % 28 AS INT) + 1) AS uf,
  CAST(year(o_orderdate) AS STRING) AS yyyy, substr(CAST(year(o_orderdate) AS STRING), 3, 2) AS yy,
  lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS mm, lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS dd,
  lpad(CAST(o_orderkey % 60 AS STRING), 2, '0') AS mi,
  CASE WHEN o_orderkey % 101 = 0 THEN 'n/a' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END AS size_txt
FROM orders) k) o ) z
"""

LOCAL_STORE_SQL = """\
SELECT dir, name, max(size) AS size FROM (
SELECT ds || '/' || ym AS dir,
  CASE WHEN l_orderkey % 97 = 0 THEN 'garbage' || CAST(l_linenumber AS STRING) || '.dbc'
  ELSE ds || CASE WHEN l_orderkey % 4 = 0 THEN '-preliminar' ELSE '' END || '_' || ym || '-' || uf || '@' || stamp || '.dbc' END AS name,
  CAST(floor(l_extendedprice) AS BIGINT) AS size
FROM (
SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
  split_part('sih-rd,cnes-st,sia-pa', ',', CAST(l_partkey % 3 AS INT) + 1) AS ds,
  split_part('ac,al,ap,am,ba,ce,df,es,go,ma,mt,ms,mg,pa,pb,pr,pe,pi,rj,rn,rs,ro,rr,sc,sp,se,to,br', ',', CAST(l_suppkey % 28 AS INT) + 1) AS uf,
  CAST(year(l_shipdate) AS STRING) || lpad(CAST(month(l_shipdate) AS STRING), 2, '0') AS ym,
  CAST(2020 + l_linenumber AS STRING) || lpad(CAST(month(l_shipdate) AS STRING), 2, '0') || lpad(CAST(day(l_shipdate) AS STRING), 2, '0') AS stamp
FROM lineitem) a) b GROUP BY dir, name
"""

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _view(spark: SparkSession, sf_dir: str, name: str) -> None:
    table(spark, sf_dir, name).createOrReplaceTempView(name)


def remote_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, dir, name, line, mtime, size_txt), one row per order."""
    _view(spark, sf_dir, "orders")
    return spark.sql(REMOTE_LISTING_SQL)


def local_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dir, name, size) of a local store, (dir, name) unique."""
    _view(spark, sf_dir, "lineitem")
    return spark.sql(LOCAL_STORE_SQL)


def listing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw input of the listing parser: (id, dir, line)."""
    return remote_listing(spark, sf_dir).select("id", "dir", "line")
