"""Per-dataset summaries.

Every aggregate is a plain ``groupBy`` with partial (map-side) aggregation, so a
dataset holding a third of all files is reduced to one row per map task before
the shuffle. The registry side is a fixed 113-row table (broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arquivo.sources import registry as reg
from arquivo.sources.store import write_observed


def _per_dataset(classified: DataFrame) -> DataFrame:
    ym = F.col("year") * 100 + F.col("month")
    return classified.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum(F.coalesce(F.col("size"), F.lit(0))).cast("bigint").alias("total_bytes"),
        F.min(F.coalesce(F.col("year"), F.lit(0))).alias("_ymin"),
        F.max(F.coalesce(F.col("year"), F.lit(0))).alias("_ymax"),
        F.count_if(F.col("year").isNull()).alias("_ynull"),
        F.min(ym).alias("_ymmin"),
        F.max(ym).alias("_ymmax"),
    )


def _ym_text(v):
    return F.format_string("%d-%02d", (v / 100).cast("int"), (v % 100).cast("int"))


def dataset_summary(classified: DataFrame) -> DataFrame:
    """A1, A3-A5: dataset, n_files, total_bytes, first_period, last_period.

    Range: min/max year (null counts as 0 and prints 'None') when the registry's
    partition has 'year'; 'YYYY-MM' when it has 'yearmonth'; '----' otherwise.
    Datasets without files do not appear (F7). Ordered by dataset (O1)."""
    spark = classified.sparkSession
    agg = _per_dataset(classified)
    ds = F.broadcast(reg.datasets(spark).select("dataset", "granularity"))
    j = agg.join(ds, "dataset", "left")
    gran = F.col("granularity")

    def yearly(v):
        return F.when((v == 0) & (F.col("_ynull") > 0), F.lit("None")).otherwise(v.cast("string"))

    first = (F.when(gran == "year", yearly(F.col("_ymin")))
             .when(gran == "yearmonth", _ym_text(F.col("_ymmin")))
             .otherwise(F.lit("----")))
    last = (F.when(gran == "year", yearly(F.col("_ymax")))
            .when(gran == "yearmonth", _ym_text(F.col("_ymmax")))
            .otherwise(F.lit("----")))
    return j.select(
        "dataset", "n_files", "total_bytes", first.alias("first_period"), last.alias("last_period")
    ).orderBy("dataset")


def _counted(classified: DataFrame) -> DataFrame:
    """Files and bytes per dataset: at most one row for each of the registry's datasets."""
    return classified.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.col("size"), F.lit(0))).cast("bigint").alias("b"))


def dataset_totals(classified: DataFrame) -> DataFrame:
    """A1 + A2: one row per dataset and a grand-total row (dataset null,
    is_total true). Files are counted per dataset first; only those counts are rolled up."""
    return _counted(classified).rollup("dataset").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_files"), F.sum("b").cast("bigint").alias("total_bytes"),
        (F.grouping("dataset") == 1).alias("is_total"),
    ).orderBy(F.col("is_total"), F.col("dataset"))


def summary_once(classified: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """A1 and A2 of one pass: (the summary of ``dataset_summary``, stored at ``path``; its total)."""
    rows, total = write_observed(
        dataset_summary(classified), path, n_files=F.coalesce(F.sum("n_files"), F.lit(0)),
        total_bytes=F.coalesce(F.sum("total_bytes"), F.lit(0)).cast("bigint"))
    return (rows.orderBy("dataset"),
            classified.sparkSession.createDataFrame([(total["n_files"], total["total_bytes"])], "n_files long, total_bytes long"))


def group_summary(classified: DataFrame) -> DataFrame:
    """A10 (derived) + J4: files and bytes per group and dataset, with group
    subtotals and a grand total (rollup of the counts per dataset)."""
    spark = classified.sparkSession
    g = F.broadcast(reg.datasets(spark).select("dataset", "group"))
    names = F.broadcast(reg.groups(spark))
    out = _counted(classified).join(g, "dataset", "left").rollup("group", "dataset").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_files"), F.sum("b").cast("bigint").alias("total_bytes"),
        F.grouping_id("group", "dataset").alias("level"),
    )
    return out.join(names, "group", "left").select(
        "group", "group_name", "dataset", "level", "n_files", "total_bytes"
    )


def unknown_datasets(requested: DataFrame, col: str = "dataset") -> DataFrame:
    """requested dataset keys that the registry does not know (left anti
    against the broadcast registry), one row per key."""
    spark = requested.sparkSession
    known = F.broadcast(reg.datasets(spark).select(F.col("dataset").alias(col)))
    return requested.join(known, col, "left_anti")


def select_datasets(df: DataFrame, keys: list[str] | None) -> DataFrame:
    """no keys -> all datasets; else only the known keys asked for."""
    if not keys:
        return df
    return df.filter(F.col("dataset").isin(*sorted(set(keys))))
