"""Quality rules learned as a decision list, with DataFrame functions only.

Sequential covering: a rule is a conjunction of thresholds on text statistics. It is grown
on two thirds of the labelled documents, one condition at a time, by information gain;
pruned on the other third by dropping its last conditions; kept if it is precise enough on
both; then the rows that it covers are set aside and the next rule is grown. The list
becomes an ordered CASE expression over the statistics.

Every step needs only counts of good and bad labels by statistic and threshold, which one
aggregation over the labelled rows gives; no row reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arquivo.llm import common

WINDOW = 5
#: Quantiles of the labelled rows that become thresholds.
QUANTILES = (.01, .02, .04, .06, .08, .1, .15, .2, .3, .4, .5, .6, .7, .8, .85, .9, .92, .94, .96, .98, .99)
#: The statistics a rule may use, as SQL over the counts.
RATES = {
    "mean_word": "try_divide(word_chars, n_words)",
    "symbol_rate": "try_divide(n_symbols, n_words)",
    "dup_line_rate": "try_divide(n_dup_lines, n_lines)",
    "repeat_rate": "try_divide(n_repeat_words, n_words)",
    "upper_rate": "try_divide(n_upper, word_chars)",
    "digit_rate": "try_divide(n_digits, word_chars)",
    "bang_rate": "try_divide(n_bangs, n_words)",
    "distinct_rate": "try_divide(n_distinct, n_words)",
    "stop_rate": "try_divide(n_stops, n_words)",
    "log_words": "ln(n_words + 1)",
}


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, rid) and the counts of every row's whole text; a null text counts as empty.

    n_words: words ``[^\\x20\\x09-\\x0D]+``; word_chars: code points in words; n_symbols:
    characters of ``[#*$%&|<>]``; n_lines: lines with a word; n_dup_lines: those equal to
    an earlier one; n_repeat_words: words in five-word windows that the text has twice or
    more. Windows are compared by 64-bit hash within a text.
    """
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.xxhash64(id_col, text_col).alias("rid"))
    words = text.select("id", "rid", "text", F.expr(common.word_array("text")).alias("w"))
    gram = ", ".join(f"w[i + {k}]" for k in range(WINDOW))
    hashed = words.select(
        "id", "rid", "w",
        F.expr("filter(split(text, '\\n', -1), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')").alias("lines"),
        F.expr("regexp_count(text, '[#*$%&|<>]')").alias("n_symbols"),
        F.expr("regexp_count(text, '[A-Z]')").alias("n_upper"),
        F.expr("regexp_count(text, '[0-9]')").alias("n_digits"),
        F.expr("regexp_count(text, '!')").alias("n_bangs"),
        F.expr(f"CASE WHEN size(w) >= {WINDOW} THEN transform(sequence(0, size(w) - {WINDOW}), i -> xxhash64({gram})) "
               "ELSE cast(array() AS array<bigint>) END").alias("g"))
    ranked = hashed.withColumn("ranked", F.expr(  # only texts with a repeated window need their order
        "CASE WHEN size(array_distinct(g)) < size(g) THEN array_sort(transform(g, (x, i) -> struct(x AS x, i AS i))) END"))
    starts = ranked.withColumn("starts", F.expr(
        "array_sort(transform(filter(ranked, (e, k) -> (k > 0 AND ranked[k - 1].x = e.x) "
        "OR (k + 1 < size(ranked) AND ranked[k + 1].x = e.x)), e -> e.i))"))
    covered = (f"aggregate(coalesce(starts, cast(array() AS array<int>)), struct(0 AS n, 0 AS past), "
               f"(a, p) -> struct(a.n + p + {WINDOW} - greatest(a.past, p) AS n, p + {WINDOW} AS past), a -> a.n)")
    return starts.select(
        "id", "rid", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) AS BIGINT)").alias("n_dup_lines"),
        F.expr(covered).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.col("n_upper").cast("long").alias("n_upper"), F.col("n_digits").cast("long").alias("n_digits"),
        F.col("n_bangs").cast("long").alias("n_bangs"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.expr("cast(size(filter(w, x -> length(x) <= 3)) AS BIGINT)").alias("n_stops"))


def base_failed() -> Column:
    return F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")


def _rates() -> list[Column]:
    return [F.expr(f"coalesce({sql}, 0D)").alias(name) for name, sql in RATES.items()]


class Rules:
    """A decision list: rules of conditions (statistic, '<=' or '>', threshold); a row that
    any rule covers is rejected."""

    def __init__(self, rules: list[list[tuple[str, str, float]]]):
        self.rules = rules

    def sql(self) -> str:
        """The ordered CASE over the statistics of RATES: true keeps."""
        when = " ".join("WHEN " + " AND ".join(f"{f} {op} {t!r}D" for f, op, t in rule) + " THEN false" for rule in self.rules)
        return f"CASE {when} ELSE true END" if self.rules else "true"


def _foil(p: int, n: int, whole_p: int, whole_n: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(whole_p / (whole_p + whole_n))) if p else 0.0


def learn(labelled: DataFrame, precision: float = 0.97, least: int = 5, max_rules: int = 16, max_conditions: int = 4) -> Rules:
    """Learn rules from ``labelled``: the statistics of RATES, ``bad`` (0 or 1) and ``part``
    (0 and 1: grown on, 2: pruned on). A rule covers at least ``least`` bad rows to grow on
    and is right in at least ``precision`` of the rows it covers, in either part."""
    names = list(RATES)
    cuts = labelled.agg(*(F.percentile_approx(c, list(QUANTILES), 100_000).alias(c) for c in names)).first()
    cuts = {c: sorted(set(cuts[c] or ())) for c in names}
    cuts = {c: [(a + b) / 2 for a, b in zip(v, v[1:])] for c, v in cuts.items()}  # half-way between two quantiles
    # The bin of a value is the number of thresholds below it: value > cuts[b] is bin > b.
    binned = common.settle(labelled.select("bad", "part", *(
        F.expr(f"size(filter(cast(array({', '.join(f'{t!r}D' for t in cuts[c])}) AS array<double>), t -> {c} > t))").alias(c)
        for c in names)), "quality-bins")

    def where(rule: list[tuple[str, str, int]]) -> str:
        return " AND ".join(f"{c} {op} {b}" for c, op, b in rule) or "true"

    rules: list[list[tuple[str, str, int]]] = []
    long = f"stack({len(names)}, " + ", ".join(f"'{c}', {c}" for c in names) + ") AS (name, bin)"
    while len(rules) < max_rules:
        left = binned.where(" AND ".join(f"NOT ({where(r)})" for r in rules) or "true")
        rule: list[tuple[str, str, int]] = []
        while len(rule) < max_conditions:
            counts: dict[str, dict[int, tuple[int, int]]] = {c: {} for c in names}
            grown = left.where("part < 2").where(where(rule)).select("bad", F.expr(long))
            for r in grown.groupBy("name", "bin").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect():
                counts[r["name"]][r["bin"]] = (r["p"], r["n"])  # at most statistics x (thresholds + 1) rows
            whole_p, whole_n = (sum(x[i] for x in counts[names[0]].values()) for i in (0, 1))
            if whole_p < least or not whole_n:
                break
            best = (0.0, None)
            for c in names:
                p = n = 0
                for b in range(len(cuts[c])):
                    at = counts[c].get(b, (0, 0))
                    p, n = p + at[0], n + at[1]
                    for op, x, y in (("<=", p, n), (">", whole_p - p, whole_n - n)):
                        gain = _foil(x, y, whole_p, whole_n)
                        if x >= least and gain > best[0] + 1e-9:
                            best = (gain, (c, op, b))
            if best[1] is None:
                break
            rule.append(best[1])
        if not rule:
            break
        # One aggregation counts every shortened form of the rule in both parts.
        shorter = [rule[: k + 1] for k in range(len(rule))]
        row = left.agg(*(
            F.count(F.expr(f"CASE WHEN {where(s)} AND part {part} AND bad = {bad} THEN 1 END")).alias(f"s{k}_{part[0]}_{bad}")
            for k, s in enumerate(shorter) for part in ("< 2", "= 2") for bad in (0, 1))).first()
        worth = []
        for k, s in enumerate(shorter):
            gp, gn, pp, pn = row[f"s{k}_<_1"], row[f"s{k}_<_0"], row[f"s{k}_=_1"], row[f"s{k}_=_0"]
            if gp >= least and gp >= precision * (gp + gn) and pp >= precision * (pp + pn):
                worth.append(((pp - pn) / (pp + pn) if pp + pn else 0.0, pp, -k, s))
        if not worth:
            break
        rules.append(max(worth, key=lambda x: x[:3])[3])
    return Rules([[(c, op, float(cuts[c][b])) for c, op, b in r] for r in rules])


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality") -> tuple[DataFrame, Rules]:
    """(id, rid, the counts, base_failed, kept) of every row, and the rules learned from
    ``labels`` (id, 1 good or 0 bad).

    Rows that fail the base rules are rejected and not learned from. Null labels, labels of
    unknown ids and ids with both labels are ignored; without labels of both kinds there are
    no rules and every other row is kept. Repeated rows and ties are decided alike. Null
    ids have no label.
    """
    stats = common.settle(statistics(docs, id_col, text_col).withColumn("base_failed", base_failed()), "quality-statistics")
    label = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("q")).where("q IN (0, 1) AND id IS NOT NULL")
             .groupBy("id").agg(F.min("q").alias("q"), F.max("q").alias("most")).where("q = most"))
    known = (stats.where("NOT base_failed").join(label, "id")
             .select(F.expr("1 - q").alias("bad"), F.expr("crc32(cast(id AS STRING)) % 3").alias("part"), *_rates()))
    rules = learn(common.settle(known, "quality-labelled"))
    verdict = stats.select("*", *_rates()).withColumn("kept", F.expr(f"NOT base_failed AND {rules.sql()}"))
    return verdict.drop(*RATES), rules


def op3_quality_docs(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))[0]


def op3_quality(spark, sf_dir: str) -> DataFrame:
    """doc_id, the contract's counts, base_failed and kept of every document."""
    out = op3_quality_docs(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


def stage_quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: rejected documents go, those with null or empty texts among
    them. Rows with a null id are judged by their text, repeated rows and ties alike. An
    empty table stays empty. Other columns pass, whatever their names."""
    verdict = op3_quality_docs(spark, docs, sf_dir)
    gone = common.settle(verdict.where("NOT kept").select("id", "rid").distinct(), "quality-gone")
    on = F.expr("xxhash64(d.doc_id, d.text) = g.rid AND d.doc_id <=> g.id")
    return common.join_counted(docs.alias("d"), gone.alias("g"), on, "left_anti", gone.count())
