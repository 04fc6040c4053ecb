"""Benchmark decontamination by size-partitioned MinHash containment search, with
DataFrame functions only.

A document is contaminated by a test item if it contains at least ``threshold`` of the
item's distinct five-word shingles. Items are short and documents long, so the similarity
of the two sets says little; the search goes by containment instead. Items are partitioned
by size (powers of two). An item with n shingles may miss n - ceil(threshold * n) of them,
so of any n - ceil(threshold * n) + 1 shingles a contaminated document has at least one:
each item's sketch is that many smallest hashes (as many as the largest item of its
partition needs), and it finds every contaminated document. Of a document only hashes up
to the largest in any sketch are looked up. Candidates are verified by exact containment of
shingle texts.

Words are runs of letters and digits in lower case. An item with k < 5 words is one shingle
of k words, its whole text, and is found wherever a document has these words in a row: documents
are read in shingles of k words too, for just those k (at most four) that items have. Items
and documents without words never match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arquivo.llm import common

SHINGLE = 5


def _words(text: str) -> str:
    return f"filter(split(regexp_replace(lower(coalesce({text}, '')), '[^\\\\p{{L}}\\\\p{{N}}]+', ' '), ' '), x -> x <> '')"


def _grams(w: str, k: int) -> str:
    """SQL: the hashes of the runs of k words of a word array, in order."""
    gram = ", ".join(f"{w}[i + {j}]" for j in range(k))
    return (f"IF(size({w}) >= {k}, transform(sequence(0, size({w}) - {k}), i -> xxhash64({gram})), "
            "cast(array() AS array<bigint>))")


def _texts(w: str, k: int) -> str:
    """SQL: the runs of k words of a word array, as texts."""
    return (f"IF(size({w}) >= {k}, transform(sequence(1, size({w}) - {k - 1}), i -> array_join(slice({w}, i, {k}), ' ')), "
            "cast(array() AS array<string>))")


def _of_item(w: str, of) -> str:
    """SQL: the shingles of an item, which are its whole text if it has fewer than five words."""
    short = " ".join(f"WHEN size({w}) = {k} THEN {of(w, k)}" for k in range(1, SHINGLE))
    return f"array_distinct(CASE {short} ELSE {of(w, SHINGLE)} END)"


def _of_document(w: str, of, short: list[int]) -> str:
    """SQL: the shingles of a document, of five words and of every length in ``short``."""
    return "concat(" + ", ".join(of(w, k) for k in (SHINGLE, *short)) + ")"


def sketches(items: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(item, h): the sketch of every item (columns item, w), by size partition."""
    up, down = threshold
    sized = (items.select("item", F.expr(f"array_sort({_of_item('w', _grams)})").alias("hs"))
             .where("size(hs) > 0").withColumn("part", F.expr("cast(floor(log2(size(hs))) AS INT)")))
    need = sized.groupBy("part").agg(F.expr(
        f"max(size(hs) - cast(ceil({up} * size(hs) / {down}) AS INT) + 1)").alias("k"))
    # At most 31 partitions.
    return (sized.join(F.broadcast(need), "part")
            .select("item", F.explode(F.expr("slice(hs, 1, k)")).alias("h")))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """(id, rid, item, n_shared, n_shingles): the pairs of document and item whose
    containment is at least ``threshold`` (a fraction). ``rid`` tells rows with the same id
    and different texts apart; repeated rows give one pair. Null texts have no words; null
    ids stay null.
    """
    up, down = threshold
    item = common.settle(items.select(F.col(item_col).alias("item"), F.expr(_words(f"`{item_text_col}`")).alias("w"))
                         .distinct(), "decontam-items")
    sketch = common.settle(sketches(item, threshold).distinct(), "decontam-sketches")
    known = sketch.agg(F.count("*").alias("n"), F.max("h").alias("top")).first()
    few = item.where(f"size(w) BETWEEN 1 AND {SHINGLE - 1}").select(F.size("w").alias("k")).distinct()
    short = sorted(r.k for r in few.collect())  # four numbers at most
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("rid"))
    worded = rows.select("id", "rid", F.expr(_words("text")).alias("w"))
    probe = worded.select("id", "rid", F.explode_outer(F.expr(_of_document("w", _grams, short))).alias("h")).where(F.col("h") <= F.lit(known["top"]))
    hit = (common.join_counted(probe, sketch, "h", "inner", known["n"]).select("id", "rid", "item").distinct()
           .groupBy("id", "rid").agg(F.collect_set(F.struct("item")).alias("items")))
    hit = common.settle(hit, "decontam-candidates")

    found = common.join_counted(
        rows.alias("d"), hit.alias("c"), F.expr("d.rid = c.rid AND d.id <=> c.id"), "inner", hit.count())
    own = (found.select("d.id", "d.rid", F.expr(_words("d.text")).alias("w"), "c.items")
           .select("id", "rid", "items", F.expr(f"array_distinct({_of_document('w', _texts, short)})").alias("has"))
           .select("id", "rid", "has", F.explode("items").alias("i")).select("id", "rid", "has", "i.item"))
    want = item.select("item", F.expr(_of_item("w", _texts)).alias("want"))
    pair = common.join_counted(
        own.alias("o"), want.alias("i"), F.expr("o.item <=> i.item"), "inner", SHINGLE * known["n"])
    return (pair.select("o.id", "o.rid", "o.item", F.expr("size(array_intersect(want, has))").alias("n_shared"),
                        F.size("want").alias("n_shingles"))
            .where(f"{down} * n_shared >= {up} * n_shingles").distinct())


def op4_decontam(spark, sf_dir: str) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles of every contaminated document and its items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(docs, items).select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"),
        F.col("n_shared").cast("long").alias("n_shared"), F.col("n_shingles").cast("long").alias("n_shingles"))


def stage_decontam(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: contaminated documents go. Null and empty texts stay, rows
    with a null id are judged by their own text, repeated rows go or stay together, and an
    empty table stays empty. Other columns pass, whatever their names."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gone = common.settle(contaminated(docs, items).select("id", "rid").distinct(), "decontam-gone")
    on = F.expr("xxhash64(d.doc_id, d.text) = g.rid AND d.doc_id <=> g.id")
    return common.join_counted(docs.alias("d"), gone.alias("g"), on, "left_anti", gone.count())


_SQL_WORDS = ("list_filter(string_split(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), "
              "lambda x: x <> '')")

ORACLE = f"""
WITH dw AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
     iw AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
     k AS (SELECT 5 AS k UNION SELECT len(w) FROM iw WHERE len(w) BETWEEN 1 AND 4),
     d AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
           FROM dw, k WHERE len(w) >= k),
     i AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2),
             lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS s FROM iw WHERE len(w) > 0),
     n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id)
SELECT d.doc_id, i.item_id, count(*) AS n_shared, any_value(n.n_shingles) AS n_shingles
FROM i JOIN d ON d.s = i.s JOIN n ON n.item_id = i.item_id
GROUP BY d.doc_id, i.item_id HAVING 5 * count(*) >= 4 * any_value(n.n_shingles)
"""
