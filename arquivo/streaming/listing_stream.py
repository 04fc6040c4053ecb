"""Classification of listing dumps as they arrive (Structured Streaming).

Parsing and classification are stateless row operators and the registry is a
static broadcast table, so the batch plan runs unchanged on a file stream:
each new dump is parsed, classified and appended to a catalog table
partitioned like the store (dataset / partition_dir). Progress is kept in a
checkpoint under the cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from arquivo.operators.classify import classify
from arquivo.operators.listing import listing_files, parse_listing
from arquivo.operators.partition import with_partition
from arquivo.session import scratch_path
from arquivo.sources.listing import _NO_SEP
from arquivo.sources.store import by_partition


def listing_stream(spark: SparkSession, root: str, encoding: str = "ISO-8859-1",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming (dir, line) DataFrame over listing dumps under ``root``."""
    reader = (
        spark.readStream.format("csv")
        .schema("line string, dir string")
        .option("sep", _NO_SEP)
        .option("quote", "\u0000")
        .option("escape", "\u0000")
        .option("encoding", encoding)
        .option("basePath", root)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(root).select("dir", "line")


def classified_stream(lines: DataFrame) -> DataFrame:
    """The batch chain parse -> files -> classify -> partition columns."""
    return with_partition(classify(listing_files(parse_listing(lines))))


def start_catalog_stream(spark: SparkSession, root: str, sink: str, checkpoint: str | None = None,
                         available_now: bool = True, query_name: str | None = None) -> StreamingQuery:
    """Append classified files of new dumps to a parquet catalog at ``sink``.

    Progress is kept at ``checkpoint``, by default in a folder of the shared one that is
    named by a digest of root and sink: a restart finds it from any process. Each batch
    is spread over tasks by the catalog's partition columns and a hash (see ``by_partition``),
    so a task writes few files and a batch of one dataset's month is no single task.
    """
    name = hashlib.sha256(f"{root}\n{sink}".encode()).hexdigest()[:32]
    ckpt = checkpoint or scratch_path(spark, f"catalog-stream-{name}")
    out = by_partition(classified_stream(listing_stream(spark, root)))
    writer = (
        out.writeStream.format("parquet")
        .option("checkpointLocation", ckpt)
        .partitionBy("dataset", "partition_dir")
        .outputMode("append")
    )
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink)
