"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import contextvars
import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Broadcast a counted table up to this many rows (narrow rows only: some 20 MB); a larger
#: one is joined by a shuffle.
BROADCAST_ROWS = 300_000

#: Spark's setting for dropping the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The characters that separate words, as Java regex class and as SQL literal.
SPACES = r"[\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder for written intermediate tables: ``spark.checkpoint.dir`` of the
    session. Only a local master may go without (tests): it gets a temporary folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def importable(spark: SparkSession) -> None:
    """Let the Python workers of this machine import this package from where the driver
    did. (On a cluster it is installed or shipped with ``--py-files``.)"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, under one folder for each application."""
    app = spark.sparkContext.applicationId
    return os.path.join(shared_dir(spark), f"llm-{app}", f"{label}-{uuid.uuid4().hex}")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: several consumers
    read one table, the lineage ends there (a lost executor costs no earlier stage),
    and Catalyst knows its size."""
    path, conf = shared_path(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)
    settled = df.sparkSession.read.schema(df.schema).parquet(path)
    settled.settled_path = path
    if _OPEN.get():
        _OPEN.get()[-1].append(settled)
    return settled


#: The tables that each open ``scratch`` owns, innermost last.
_OPEN: contextvars.ContextVar[tuple[list[DataFrame], ...]] = contextvars.ContextVar("scratch", default=())


@contextlib.contextmanager
def scratch():
    """Own the tables settled inside: all are deleted at the end but those given to the
    function it yields, which pass to the scratch around it, if there is one. So a result
    read later must have been settled, or read only tables given to that function."""
    mine, kept, around = [], [], _OPEN.get()
    opened = _OPEN.set((*around, mine))

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.settled_path)
        return df

    try:
        yield keep
    finally:
        _OPEN.reset(opened)
        free(*(df for df in mine if df.settled_path not in kept))
        if around:
            around[-1].extend(df for df in mine if df.settled_path in kept)


def free(*frames: DataFrame) -> None:
    """Delete tables that ``settle`` wrote and nothing reads any more."""
    for df in frames:
        jvm, path = df.sparkSession._jvm, df.settled_path
        hadoop = jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)


def join_counted(left: DataFrame, right: DataFrame, on, how: str, rows: int) -> DataFrame:
    """Join with ``right``, whose row count is known: broadcast within the bound, else
    left to a shuffle join (whose hot keys adaptive execution splits)."""
    return left.join(F.broadcast(right) if rows <= BROADCAST_ROWS else right, on, how)


def word_array(text: str) -> str:
    """SQL for the array of words ``[^\\x20\\x09-\\x0D]+`` of a text column; null: none."""
    trimmed = f"trim(BOTH ' \\t\\n\\u000B\\u000C\\r' FROM coalesce({text}, ''))"
    return f"CASE WHEN {trimmed} = '' THEN array() ELSE split({trimmed}, '[\\\\x20\\\\x09-\\\\x0D]+') END"


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges`` (a long, b long) as (node, component), component
    being the smallest node reachable; only nodes with an edge to another node occur.

    Alternates large-star and small-star steps until the edges form stars. Every step is
    a partial minimum and joins; no neighbour list is gathered, so a node with a third of
    all edges is a join key that adaptive execution can split, not one task's list.
    """
    edge = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    before = None
    while True:
        old = edge
        lower = (  # nodes that are not the smallest of their neighbourhood
            edge.select("u", "v").union(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
            .groupBy("u").agg(F.min("v").alias("m")).where("m < u"))
        lower = settle(lower.select(F.col("u").alias("v"), "m"), label)
        large = edge.join(lower, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.expr(
            "CASE WHEN v = m THEN array(struct(u AS u, m AS v)) "
            "ELSE array(struct(v AS u, m AS v), struct(u AS u, m AS v)) END")).alias("e")).select("e.*").distinct()
        edge = settle(small, label)
        free(old, lower)
        seen = edge.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == before:
            return edge.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = tuple(seen)


def bits_for(rows: int, bucket: int, least: int, most: int) -> int:
    """Prefix bits with which ``rows`` spread evenly fall into buckets of about ``bucket``."""
    return min(most, max(least, math.ceil(math.log2(max(1, rows) / bucket)) if rows > bucket else least))
