"""Token counts by section, from one encoding of the whole document.

The fields of a row make one document, which is encoded once. The character spans of its
tokens are interval-joined with the spans of its sections (fields, or lines of fields), and
a token that crosses a boundary is allocated by an explicit rule:

* ``start``: to the section of its first character;
* ``end``: to that of its last;
* ``most``: to the section that has most of its characters (ties: the earlier);
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arquivo.llm import common
from arquivo.llm.encode import encoder

RULES = ("start", "end", "most")


def allocate(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of every token span [start, end), and whether it crosses a boundary.
    ``bounds``: the first character of every section, ascending; of sections that start at
    the same character the last is the one that is not empty."""
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    crossing = last > first
    if rule == "end":
        return last, crossing
    place = first.copy()
    if rule == "most":
        edge = np.r_[bounds, np.iinfo(np.int64).max]
        for i in np.flatnonzero(crossing):
            k = np.arange(first[i], last[i] + 1)
            share = np.minimum(edge[k + 1], ends[i]) - np.maximum(edge[k], starts[i])
            place[i] = k[share.argmax()]
    return place, crossing


def count_tokens(docs: DataFrame, id_col: str = "doc_id", fields: tuple[str, ...] = ("text",), by: str = "line",
                 rule: str = "most", tokenizer: str | None = None) -> DataFrame:
    """One row per section: id, field, section (its number in the field, from 0), n_chars,
    n_tokens, n_crossing (tokens of it that reach into another section).

    ``by``: ``field``, or ``line`` (a line has its line break; every field has at least one
    section). Fields are joined by line breaks, which belong to the field before. A null
    field is empty. The counts of a row add up to the tokens of its document. Repeated rows
    give repeated results; null ids stay null.
    """
    if by not in ("field", "line") or rule not in RULES:
        raise ValueError(f"by={by!r}, rule={rule!r}")
    common.importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), *(F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"f{i}")
                                                    for i, f in enumerate(fields)))
    kind = rows.schema["id"].dataType.simpleString()

    def sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets = encoder(tokenizer).offsets
        for batch in batches:
            ids, names, numbers, chars, tokens, crossings = [], [], [], [], [], []
            columns = [batch.column(f"f{i}").to_pylist() for i in range(len(fields))]
            for key, *values in zip(batch.column("id").to_pylist(), *columns):
                size, name, number = [], [], []
                for i, (field, value) in enumerate(zip(fields, values)):
                    part = value.split("\n") if by == "line" else [value]
                    size += [len(p) + 1 for p in part]
                    if i == len(fields) - 1:
                        size[-1] -= 1  # no line break after the last
                    name += [field] * len(part)
                    number += range(len(part))
                bounds = np.cumsum(size) - size
                starts, ends = offsets("\n".join(values))
                place, crossing = allocate(starts, ends, bounds, rule)
                ids += [key] * len(size)
                names += name
                numbers += number
                chars += size
                tokens.append(np.bincount(place, minlength=len(size)))
                crossings.append(np.bincount(place[crossing], minlength=len(size)))
            if ids:
                table = pa.table({
                    "id": pa.array(ids, batch.column("id").type), "field": pa.array(names, pa.string()),
                    "section": pa.array(numbers, pa.int32()), "n_chars": pa.array(chars, pa.int64()),
                    "n_tokens": pa.array(np.concatenate(tokens).astype(np.int64)),
                    "n_crossing": pa.array(np.concatenate(crossings).astype(np.int64))})
                yield from table.to_batches(max_chunksize=20_000)

    out = rows.mapInArrow(sections, f"id {kind}, field string, section int, n_chars long, n_tokens long, n_crossing long")
    return out.withColumnRenamed("id", id_col)


def op6_tokens(spark, sf_dir: str) -> DataFrame:
    """Token counts of every line of every document, its source as a field before the text."""
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), fields=("source", "text"))
