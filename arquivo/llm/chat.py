"""Chat formatting at token level.

A turn is written ``<s>[INST]role[/INST]text</s>``. The four control strings are reserved
ids, never the encoding of a text: role and text are encoded separately and the reserved ids
spliced between. Control strings within a role or text are escaped by a backslash after
their first character (and backslashes doubled), so that the written text too has control
strings only where the template puts them. Positions in a conversation, and with them the
loss mask (the tokens of assistant texts), are prefix sums of segment lengths.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arquivo.llm import common
from arquivo.llm.encode import encoder

CONTROL = ("<s>", "[INST]", "[/INST]", "</s>")
#: The reserved ids follow the 50,257 of the vocabulary and its one special token.
START, HEAD, BODY, END = RESERVED = (50257, 50258, 50259, 50260)
LEARNED = "assistant"
_ESCAPED = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_UNESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row per turn: conv, turn, formatted (its text), ids, and in tokens from the start
    of its conversation token_start, loss_start and loss_end (equal: nothing to learn).

    Null roles and texts are empty. Turns of a conversation are in the order of (turn, role,
    text); repeated rows are turns of their own. Rows with a null conversation id form one
    conversation; null turns come first. Other columns are ignored.
    """
    common.importable(turns.sparkSession)
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("conv", "turn")}

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = partial(encoder(tokenizer).encode, literal=True)  # control strings in texts are escaped text
        for batch in batches:
            formatted, ids, head, body = [], [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                r, t = escape(role), escape(text)
                a, b = encode(r), encode(t)
                formatted.append(f"{CONTROL[0]}{CONTROL[1]}{r}{CONTROL[2]}{t}{CONTROL[3]}")
                ids.append(np.concatenate([(START, HEAD), a, (BODY,), b, (END,)]).astype(np.int32))
                head.append(len(a) + 3)  # what stands before the text
                body.append(len(b))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("turn"), batch.column("role"), batch.column("text"),
                 pa.array(formatted, pa.string()), pa.array(ids, pa.list_(pa.int32())), pa.array(head, pa.int64()),
                 pa.array(body, pa.int64())],
                names=["conv", "turn", "role", "text", "formatted", "ids", "head", "body"])

    done = rows.mapInArrow(segments, f"conv {kinds['conv']}, turn {kinds['turn']}, role string, text string, "
                                     "formatted string, ids array<int>, head long, body long")
    before = Window.partitionBy("conv").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = done.withColumn("token_start", F.coalesce(F.sum(F.expr("head + body + 1")).over(before), F.lit(0).cast("long")))
    return placed.select(
        "conv", "turn", "formatted", "ids", "token_start", F.expr("token_start + head").alias("loss_start"),
        F.expr(f"token_start + head + IF(role = '{LEARNED}', body, 0)").alias("loss_end"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read from the
    ids and the loss spans alone. Conversations are streamed turn by turn."""
    common.importable(formatted.sparkSession)
    kind = formatted.schema["conv"].dataType.simpleString()
    ordered = (formatted.select("conv", "ids", "token_start", "loss_start", "loss_end")
               .repartition("conv").sortWithinPartitions("conv", "token_start"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder().decode
        state: dict | None = None

        def row(s: dict, kind: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([s["conv"]], kind), pa.array([s["turns"]], pa.int64()), pa.array([s["all"].hexdigest()]),
                 pa.array([s["loss"]], pa.int64()), pa.array([s["learned"].hexdigest()]), pa.array([s["chars"]], pa.int64())],
                names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv", "token_start", "loss_start", "loss_end")]
            for conv, start, a, b, ids in zip(*columns, batch.column("ids")):
                ids = ids.values.to_numpy()
                if state is None or state["conv"] != conv:
                    if state is not None:
                        yield row(state, batch.column("conv").type)
                    state = {"conv": conv, "turns": 0, "all": hashlib.sha256(), "loss": 0, "learned": hashlib.sha256(), "chars": 0}
                mark = int(np.flatnonzero(ids == BODY)[0])
                role, text = decode(ids[2:mark]), decode(ids[mark + 1 : -1])
                state["turns"] += 1
                state["chars"] += sum(map(len, CONTROL)) + len(role) + len(text)
                state["all"].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                learned = unescape(decode(ids[a - start : b - start]))
                state["loss"] += len(learned)
                state["learned"].update(learned.encode())
        if state is not None:
            yield row(state, batch.column("conv").type)

    return ordered.mapInArrow(digests, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                       "loss_sha256 string, formatted_chars long")


#: A conversation whose texts consist of control strings.
PROBE = "VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"


def op2_chat(spark, sf_dir: str) -> DataFrame:
    """The digests of all conversations and of PROBE."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return read_back(format_turns(turns.union(spark.sql(f"SELECT * FROM {PROBE}")))).withColumnRenamed("conv", "conv_id")


def _sql_escaped(x: str) -> str:
    for a, b in (("\\", "\\\\"), *((c, f"{c[0]}\\{c[1:]}") for c in CONTROL)):
        x = f"replace({x}, '{a}', '{b}')"
    return x


ORACLE = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({sum(map(len, CONTROL))} + length({_sql_escaped('role')}) + length({_sql_escaped('text')}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
