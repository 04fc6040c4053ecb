"""File sources and sinks: a store tree, its files and checksums (S5, K3 input); catalog tables (K1).

Directories are listed and files hashed in tasks, through ``pyarrow.fs``: Spark's
``binaryFile`` source leaves out empty files and folders whose names begin with an
underscore, and holds a whole file in one value.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arquivo.operators.slicer import Slicer

CHUNK = 8 << 20  # bytes of a file read at once
HIDDEN = ".writing-"  # begins the name of a file while it is written
SPREAD = 16
#: Stands for an empty partition_dir in a folder name (which cannot be empty).
NO_PERIOD = "no-period"
FILE_COLUMNS = "path string, dir string, name string, size long, modified timestamp"


def located(root: str):
    """The file system of a path or URI and the path on it: without a scheme, and of an object
    store with its bucket (``s3://bucket/data`` is ``bucket/data`` there)."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(root) if ":" in root.split("/")[0] else (fs.LocalFileSystem(), root)
    return system, path.rstrip("/") or "/"


def list_step(root: str, into: bool, deeper: bool, only_files: bool):
    """A mapInArrow function over (path, size, is_dir, modified) of entries: what lies in their
    directories, all the way down with ``into``; with ``deeper`` files stay, else they go."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system = located(root)[0]
        for batch in batches:
            for path, known, is_dir, modified in zip(*(batch.column(c).to_pylist() for c in ("path", "size", "is_dir", "modified"))):
                if not is_dir:
                    found = [(path, known, False, modified)] if deeper else []
                else:
                    infos = system.get_file_info(fs.FileSelector(path, recursive=into))
                    found = [(i.path, i.size, i.type == fs.FileType.Directory, i.mtime) for i in infos
                             if not i.base_name.startswith(HIDDEN)]
                if only_files:
                    found = [x for x in found if not x[2]]
                for k in range(0, len(found), 10_000):
                    rows = list(zip(*found[k : k + 10_000]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.bool_()),
                         pa.array(rows[3], pa.timestamp("us", tz="UTC"))], names=["path", "size", "is_dir", "modified"])
    return of


def _list(spark: SparkSession, root: str, levels: int, deeper: bool) -> DataFrame:
    """Files ``levels`` levels below root, and with ``deeper`` those at other levels too.

    Each level is a pass that lists the directories of the one above, spread over the
    cluster by path; a folder of the last level is listed (or walked) by one task."""
    base = located(root)[1]
    schema = "path string, size long, is_dir boolean, modified timestamp"
    out = spark.range(1, numPartitions=1).select(
        F.lit(base).alias("path"), F.lit(None).cast("long").alias("size"), F.lit(True).alias("is_dir"),
        F.lit(None).cast("timestamp").alias("modified"))
    for level in range(levels + 1):
        last = level == levels
        out = out.mapInArrow(list_step(root, last and deeper, deeper, last), schema)
        if not last:
            out = out.repartition("path")
    rel = F.substring(F.col("path"), len(base.rstrip("/")) + 2, 1 << 20)
    name = F.substring_index(rel, "/", -1)
    return out.select(
        "path", F.when(F.contains(rel, F.lit("/")), F.regexp_extract(rel, r"^(.*)/[^/]*$", 1)).otherwise("").alias("dir"),
        name.alias("name"), "size", "modified")


def scan_store(spark: SparkSession, root: str, depth: int = 2) -> DataFrame:
    """Files exactly ``depth`` directory levels under ``root`` whose name has a dot, as
    (path, dir, name, size, modified); empty files too. ``path`` is that on the file system of
    root (see ``located``), as stored paths are; ``dir`` is relative to root."""
    return _list(spark, root, depth, deeper=False).where(F.contains("name", F.lit(".")))


def store_files(spark: SparkSession, root: str) -> DataFrame:
    """All files at any level under ``root``, those of support trees (``_documentacao``,
    ``_auxiliar``) and empty ones included; columns as ``scan_store``."""
    return _list(spark, root, 2, deeper=True)


def hash_files(files: DataFrame, root: str = "/") -> DataFrame:
    """Adds sha256 (hex) and size_bytes of the files named in column ``path`` (on the file
    system of ``root``), read in the tasks in chunks. Files are spread by path first."""
    schema = T.StructType([*files.schema.fields, T.StructField("sha256", T.StringType()), T.StructField("size_bytes", T.LongType())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system = located(root)[0]
        for batch in batches:
            digests, sizes = [], []
            for path in batch.column("path").to_pylist():
                digest, size = hashlib.sha256(), 0
                with system.open_input_stream(path) as f:
                    while data := f.read(CHUNK):
                        digest.update(data)
                        size += len(data)
                digests.append(digest.hexdigest())
                sizes.append(size)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests), pa.array(sizes, pa.int64())],
                                             names=[*batch.schema.names, "sha256", "size_bytes"])

    return files.repartition("path").mapInArrow(of, schema)


def write_files(files: DataFrame, root: str, commits: str, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """Write every row of ``files`` as one file: ``path`` (relative to root) and ``content``
    (binary; null: empty). Returns the commit list (path, size, sha256), stored at ``commits``.

    A file is written in its folder under a name of its own and then takes its place in one move,
    so no part of a file is ever seen there, and a task that runs again for a lost executor
    writes the same file again. Only rows of tasks that ended are in the commit list; names that
    begin with ``HIDDEN`` are left-overs of others, which no listing shows. Paths that are null,
    absolute, empty, leave the root or occur twice raise before anything is written.
    """
    path = F.col(path_col)
    bad = F.coalesce(~path.rlike(r"^[^/]") | path.rlike(r"(^|/)(\.\.?|)(/|$)"), F.lit(True))
    wrong = files.groupBy(path.alias("path")).agg(F.count("*").alias("n"), F.max(bad).alias("bad")).where("bad OR n > 1").limit(1).collect()
    if wrong:
        raise ValueError(f"not a path for one file under the root: {wrong[0]['path']!r}, {wrong[0]['n']} row(s)")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = located(root)
        made = set()
        for batch in batches:
            digests, sizes = [], []
            for rel, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                data = content.as_py() or b""
                folder, _, name = f"{base.rstrip('/')}/{rel}".rpartition("/")
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                own = f"{folder}/{HIDDEN}{uuid.uuid4().hex}"
                with system.open_output_stream(own) as out:
                    out.write(data)
                system.move(own, f"{folder}/{name}")
                digests.append(hashlib.sha256(data).hexdigest())
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                                             names=["path", "size", "sha256"])

    rows = files.select(path.alias("path"), F.col(content_col).cast("binary").alias("content")).repartition("path")
    rows.mapInArrow(of, "path string, size long, sha256 string").write.parquet(commits)
    return files.sparkSession.read.schema("path string, size long, sha256 string").parquet(commits)


def by_partition(df: DataFrame) -> DataFrame:
    """Rows partitioned on the catalog's partition columns and all others, so that a large
    partition spans tasks: a task writes few files. A stream cannot be sampled for ranges:
    there a partition is spread over ``SPREAD`` tasks by hash. Empty periods get their token."""
    token = F.when(F.col("partition_dir") == "", NO_PERIOD).otherwise(F.col("partition_dir"))
    rest = F.xxhash64(*[c for c in df.columns if c not in ("dataset", "partition_dir")])
    named = df.withColumn("partition_dir", token)
    if df.isStreaming:
        return named.repartition("dataset", "partition_dir", F.pmod(rest, F.lit(SPREAD)))
    return named.repartitionByRange("dataset", "partition_dir", rest)


def write_catalog(df: DataFrame, path: str, mode: str = "error") -> None:
    """K1: store a catalog table partitioned like the store layout
    (dataset / partition_dir), so period and dataset filters prune files.

    ``mode="replace"`` replaces the partitions that ``df`` has rows of and leaves all others:
    writing the same rows again, or a part of them, changes nothing and doubles nothing. The
    other modes are Spark's."""
    writer = by_partition(df).write.partitionBy("dataset", "partition_dir")
    if mode == "replace":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode(mode).parquet(path)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``write_catalog`` or the stream stored, with partition_dir as the string
    it was (empty without a period); filters on both partition columns prune folders."""
    return _stored(spark, path).withColumn(
        "partition_dir", F.when(F.col("partition_dir") == NO_PERIOD, "").otherwise(F.col("partition_dir")))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.parquet(path).schema
    texts = ("dataset", "partition_dir")
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in texts else f.dataType) for f in found])
    return spark.read.schema(schema).parquet(path)


def read_slice(spark: SparkSession, path: str, slicer: Slicer | None = None,
               datasets: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """F1, F3 and F4 on a stored catalog: the rows of ``read_catalog`` that ``slicer`` and
    ``datasets`` let pass, reading no other files.

    Time bounds become filters of the partition columns, in both modes, since a partition_dir is
    the period text of its rows; regions are pushed to the files. ``datasets`` is a list (none
    or empty: all), or a table with a column ``dataset``, of at most a registry's size, whose
    rows prune the folders when the query runs."""
    rows = _stored(spark, path)
    period = F.when(F.col("partition_dir") == NO_PERIOD, "").otherwise(F.col("partition_dir"))
    if isinstance(datasets, DataFrame):
        # Spark prunes folders at run time by a side that a comparison has filtered.
        rows = rows.join(F.broadcast(datasets.select("dataset").where("dataset >= ''").distinct()), "dataset", "left_semi")
    elif datasets:
        rows = rows.where(F.col("dataset").isin(list(datasets)))
    if slicer:
        rows = rows.where(slicer.partition_predicate(period))
        if slicer.regions:
            rows = rows.where(F.col("uf").isin(list(slicer.regions)))
    return rows.withColumn("partition_dir", period)


def write_inventory(inventory: DataFrame, table: str, path: str, buckets: int | None = None, path_col: str = "path") -> DataFrame:
    """Store an inventory (path, size, ...) as ``table`` at ``path``, bucketed and sorted by the
    stored path, and return it. ``sync_status`` and ``manifest`` on it group and join by that path without
    shuffling it: only the day's entries move. ``buckets`` should be about the shuffle partitions
    of the joins (the default), as a join with fewer buckets than that may be shuffled again.
    An existing table of that name is replaced."""
    spark = inventory.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One task writes each bucket, so a bucket is one file.
    (inventory.repartition(n, path_col).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(n, path_col).sortBy(path_col).saveAsTable(table))
    return spark.table(table)


def write_observed(df: DataFrame, path: str, **totals: Column) -> tuple[DataFrame, dict]:
    """Store ``df`` as Parquet and take ``totals`` (aggregates by name) of its rows in the same
    pass: (the stored rows, the totals). The totals are gathered by the tasks that write, of
    which each counts once however often it was tried."""
    seen = Observation()
    df.observe(seen, *(column.alias(name) for name, column in totals.items())).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get
