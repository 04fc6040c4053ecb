"""Fixed-width report lines (R1-R3) as projections over the summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arquivo.functions.formatting import fixed_point, ljust, rjust, with_fixed_point_double

MB_POW2 = 20
GB_POW2 = 30


#: Fixed value: the header of the summary.
SUMMARY_HEADER = "-----------Dataset----------|---Nº files---|--Total size--|------Period range------"


def summary_report(summary: DataFrame) -> DataFrame:
    """R1 with its header: (position, line), the header at 0, then a line per dataset."""
    lines = summary_lines(summary)  # at most one row per dataset of the registry
    numbered = lines.select(F.row_number().over(Window.orderBy("dataset")).alias("position"), "line")
    header = summary.sparkSession.range(1).select(F.lit(0).alias("position"), F.lit(SUMMARY_HEADER).alias("line"))
    return header.union(numbered)


def summary_lines(summary: DataFrame) -> DataFrame:
    """R1: 'dataset(27) | nnnnnn files | mmmmmm.m MB | from FIRST    to LAST   '.

    The range is 'first' and 'last' left-aligned in 7 each around ' to ',
    which is already 18 wide, so the reference's centring in 18 adds nothing."""
    rng = F.concat(ljust(F.col("first_period"), 7), F.lit(" to "), ljust(F.col("last_period"), 7))
    line = F.concat_ws(
        " | ",
        ljust(F.col("dataset"), 27),
        F.concat(F.format_string("%6d", F.col("n_files")), F.lit(" files")),
        F.concat(rjust(fixed_point("total_bytes", MB_POW2, 1), 9), F.lit(" MB")),
        F.concat(F.lit("from "), rng),
    )
    return summary.select("dataset", line.alias("line"))


def total_lines(totals: DataFrame) -> DataFrame:
    """R1 footer from (n_files, total_bytes): 'Total size: x.y GB', 'Total files: n files'."""
    return totals.select(
        F.concat(F.lit("Total size: "), fixed_point("total_bytes", GB_POW2, 1), F.lit(" GB"))
        .alias("size_line"),
        F.concat(F.lit("Total files: "), F.col("n_files").cast("string"), F.lit(" files"))
        .alias("files_line"),
    )


def dry_run_lines(entries: DataFrame, *others: str) -> DataFrame:
    """R2: 'dataset(27) partition(20) mmmmmm.m MB  url', beside the url and ``others``."""
    line = F.concat(
        ljust(F.col("dataset"), 27), F.lit(" "),
        ljust(F.coalesce(F.col("partition"), F.lit("")), 20), F.lit(" "),
        rjust(fixed_point("size", MB_POW2, 1), 9), F.lit(" MB  "),
        F.col("url"),
    )
    return entries.select("url", *others, line.alias("line"))


def dry_run_total_line(total: DataFrame) -> DataFrame:
    """R2 footer: 'Total: n files, x.yz GB'."""
    return total.select(
        F.concat(F.lit("Total: "), F.col("n_files").cast("string"), F.lit(" files, "),
                 fixed_point("total_bytes", GB_POW2, 2), F.lit(" GB")).alias("line")
    )


def transfer_lines(stats: DataFrame) -> DataFrame:
    """R3: 'name(40) mmm.mm MB ss.ss s rr.rr Mb/s' over A9.

    Floats are rounded on their exact binary value, ties to even (Java's formatter would
    round half-up). A transfer that took no time has no rate: ``-``."""
    df = stats
    for c in ("size_mb", "seconds", "rate_mbps"):
        df = with_fixed_point_double(df, c, 2, f"_{c}_txt")
    line = F.concat(
        ljust(F.col("filename"), 40), F.lit(" "),
        rjust(F.col("_size_mb_txt"), 6), F.lit(" MB "),
        rjust(F.col("_seconds_txt"), 5), F.lit(" s "),
        rjust(F.coalesce("_rate_mbps_txt", F.lit("-")), 5), F.lit(" Mb/s"),
    )
    return df.select("filename", line.alias("line"))


def ordered_report(lines: DataFrame, keys: list[str], header: str | None = None, footer: DataFrame | None = None) -> DataFrame:
    """(section, the keys, line) of a whole report: the header (0), ``lines`` ordered by ``keys``
    (1), and after a blank line the rows of ``footer`` (position, line) (2)."""
    kinds = {c: lines.schema[c].dataType.simpleString() for c in keys}
    body = lines.select(F.lit(1).alias("section"), F.lit(0).alias("position"), *keys, "line")
    none = [F.lit(None).cast(kinds[c]).alias(c) for c in keys]
    if header is not None:
        body = body.union(lines.sparkSession.range(1).select(F.lit(0), F.lit(0), *none, F.lit(header)))
    if footer is not None:
        blank = lines.sparkSession.range(1).select(F.lit(2), F.lit(-1), *none, F.lit(""))
        body = body.union(blank).union(footer.select(F.lit(2), F.col("position").cast("int"), *none, "line"))
    return body


def write_report(report: DataFrame, path: str, keys: list[str]) -> None:
    """Store an ``ordered_report`` as text in many part files whose names order as the report
    does: range partitions are written in their order, each sorted. Nothing goes through one task."""
    order = ["section", "position", *keys]
    report.repartitionByRange(*order, F.xxhash64("line")).sortWithinPartitions(*order, "line").select("line").write.text(path)


def read_report(spark, path: str) -> DataFrame:
    """(position, line) of a stored report, from 1. Lines are numbered within each block of a
    file, and blocks by the numbers of lines before them."""
    rows = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    block = rows.groupBy("file", "start").agg(F.count("*").alias("n"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)  # one row for each block
    block = block.select("file", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    local = rows.withColumn("own", F.row_number().over(Window.partitionBy("file", "start").orderBy("at")))
    return local.join(block, ["file", "start"]).select((F.col("before") + F.col("own")).alias("position"), "line")
