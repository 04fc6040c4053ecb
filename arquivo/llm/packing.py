"""Best-fit packing of token sequences by hierarchical residual packing.

Every partition encodes its documents, cuts those longer than a sequence, and packs the
pieces best-fit (longest first) into bins. Full bins are final. Underfull bins go up
a tree of merges: a task takes the underfull bins of ``FAN`` children as items of one more
best-fit round.

What goes up is bounded without loss. Best-fit leaves at most one bin at or under half of
the capacity, and two bins over half never fit together, so a child has at most one guest
for the others, and a merge of ``FAN`` children needs at most ``FAN`` hosts. Equally full bins
are as good as each other. So a task passes on all its bins with room, but of equally full ones
no more than all merges above it can use; the others are final, as full bins are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arquivo.llm import common
from arquivo.llm.encode import encoder

FAN = 16
EQUAL = 8 * FAN  # equally full bins that go up: Spark's partitions are under 2**31, so at most 8 merges lie above one
END = 0  # the id that follows every document


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pack items best-fit, longest first (ties: first come). Returns each item's bin and
    offset, and each bin's first item."""
    place, offset, first = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    gaps: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by what is left in them
    mask = 0  # bit g: some bin has g left
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        fits = mask >> size
        if fits:
            gap = size + (fits & -fits).bit_length() - 1
            at = gaps[gap].pop()
            if not gaps[gap]:
                mask ^= 1 << gap
        else:
            at, gap = len(first), capacity
            first.append(i)
        place[i], offset[i] = at, capacity - gap
        gaps[gap - size].append(at)
        mask |= 1 << (gap - size)
    return place, offset, np.array(first, np.int64)


def _carried(fill: np.ndarray, capacity: int, nearly: int) -> np.ndarray:
    """Which bins go up: underfull ones, of equally full ones the first ``EQUAL``."""
    order = np.argsort(fill, kind="stable")
    level = fill[order]
    out = np.zeros(len(fill), bool)
    out[order] = (level < capacity - nearly) & (np.arange(len(fill)) - np.searchsorted(level, level) < EQUAL)
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
         tokenizer: str | None = None, nearly: int = 0, keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and
    ``ids``, little-endian unsigned 32-bit numbers, if ``keep_ids``).

    A document is the ids of its text and then END; a null text counts as empty, so every
    row gives at least one token. Only documents over ``capacity`` are cut: all their pieces
    are full but the first. Bins with at most ``nearly`` left are final: by default, full ones.
    Repeated rows are packed as often as they occur; null ids stay null. An empty table
    gives an empty result.
    """
    common.importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        ids, piece, start, length, crc, kept = [], [], [], [], [], []
        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                buf = encode(text).tobytes() + END.to_bytes(4, "little")
                n = len(buf) // 4
                cut = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for k, (a, b) in enumerate(zip(cut, cut[1:])):
                    ids.append(key)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(buf[4 * a : 4 * b]))
                    if keep_ids:
                        kept.append(buf[4 * a : 4 * b])
        if not ids:
            return
        size = np.array(length, np.int64)
        place, offset, first = best_fit(size, capacity)
        part = TaskContext.get().partitionId()
        fill = np.bincount(place, weights=size, minlength=len(first)).astype(np.int64)
        up = _carried(fill, capacity, nearly)
        table = pa.table({
            "id": pa.array(ids, batch.schema.field("id").type), "piece": pa.array(piece, pa.int32()),
            "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
            "ids_crc32": pa.array(crc, pa.int64()), "bin": pa.array((part << 32) + place), "offset": pa.array(offset),
            "part": pa.array(np.full(len(ids), part)), "fill": pa.array(fill[place]),
            "up": pa.array(up[place] & (offset == 0)),  # one row for each bin that goes up
        } | ({"ids": pa.array(kept, pa.binary())} if keep_ids else {}))
        yield from table.to_batches(max_chunksize=20_000)

    schema = (f"id {kind}, piece int, start long, length long, ids_crc32 long, bin long, offset long, part long, "
              "fill long, up boolean" + ", ids binary" * keep_ids)
    piece = common.settle(rows.mapInArrow(local, schema), "packing-pieces")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin", ignore_index=True)  # the same result whatever the order of arrival
        fill, name = pdf["fill"].to_numpy(np.int64), pdf["bin"].to_numpy(np.int64)
        place, offset, first = best_fit(fill, capacity)
        whole = np.bincount(place, weights=fill, minlength=len(first)).astype(np.int64)
        up = _carried(whole, capacity, nearly)[place] & (offset == 0)
        return pd.DataFrame({"bin": name, "host": name[first[place]], "shift": offset, "part": pdf["part"] // FAN,
                             "fill": whole[place], "up": up})

    open_bins = piece.where("up").select("bin", "part", "fill")
    parts = (piece.agg(F.max("part")).first()[0] or 0) + 1
    placed = piece
    while parts > 1:
        merged = common.settle(
            open_bins.groupBy(F.expr(f"part div {FAN}").alias("group")).applyInPandas(
                merge, "bin long, host long, shift long, part long, fill long, up boolean"), "packing-merges")
        moved = merged.where("bin <> host").select("bin", "host", "shift")
        placed = (common.join_counted(placed, moved, "bin", "left", moved.count())
                  .withColumn("bin", F.coalesce("host", "bin")).withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0)))
                  .drop("host", "shift"))
        open_bins = merged.where("up").select("bin", "part", "fill")
        parts = -(-parts // FAN)
    return placed.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
                         F.col("bin").alias("sequence_id"), "offset", *(["ids"] if keep_ids else []))


def op9_packing(spark, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 2048 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage_packing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's last stage: what is left is packed. Null texts are empty, repeated
    rows are packed as often as they occur, null ids stay null, an empty table gives no rows
    and other columns are ignored, whatever their names."""
    return pack(docs)
