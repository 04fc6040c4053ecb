"""Raw directory listings as a DataFrame of (dir, line).

A listing dump holds the raw ``LIST`` lines of one directory; dumps are stored
under ``<root>/dir=<directory>/`` (Hive-style partitions, the directory
escaped by Spark), so the directory comes back as a partition column and a
filter on it prunes whole dumps. The archive serves Latin-1 text, so the
reader decodes with that charset; a separator that never occurs in a line
keeps each line whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NO_SEP = "\u0001"


def _reader(spark: SparkSession, encoding: str):
    return (
        spark.read.format("csv")
        .schema("line string")
        .option("sep", _NO_SEP)
        .option("quote", "\u0000")
        .option("escape", "\u0000")
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("mode", "PERMISSIVE")
    )


def read_listing(spark: SparkSession, root: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """(dir, line) for every line of every dump under ``root``."""
    df = _reader(spark, encoding).option("basePath", root).load(root)
    return df.select(F.col("dir").cast("string").alias("dir"), "line").filter(F.col("line").isNotNull())


def write_listing(df: DataFrame, root: str, mode: str = "append", encoding: str = "ISO-8859-1") -> None:
    """Store (dir, line) rows as listing dumps, one folder per directory, in the charset
    that ``read_listing`` expects. Directories are spread by range, so a task writes few."""
    (df.select("dir", "line").repartitionByRange("dir", "line").write.mode(mode).partitionBy("dir")
     .format("csv").option("sep", _NO_SEP).option("quote", "\u0000").option("escape", "\u0000")
     .option("emptyValue", "").option("encoding", encoding)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").save(root))
