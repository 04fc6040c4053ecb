"""Parsing of raw directory-listing lines.

A listing line looks like ``MM-DD-YY  hh:mmAM  <size or <DIR>>  name``. The name
is everything after the third blank run, inner and trailing blanks kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# date, time, size-or-<DIR>, rest of the line
DATE_RE = r"^([0-9]{1,2})-([0-9]{1,2})-([0-9]{2})$"
TIME_RE = r"^([0-9]{1,2}):([0-9]{1,2})([AaPp][Mm])$"


def _listing_timestamp_sql(date_txt: str, time_txt: str) -> str:
    """strptime('%m-%d-%y %I:%M%p') as SQL built-ins; null when it would raise.
    Two-digit years pivot like strptime: 69-99 -> 19yy, 00-68 -> 20yy (H2)."""
    d = f"split({date_txt}, '-')"
    yy = f"try_cast(get({d}, 2) AS INT)"
    h12 = f"try_cast(regexp_extract({time_txt}, '{TIME_RE}', 1) AS INT)"
    mi = f"try_cast(regexp_extract({time_txt}, '{TIME_RE}', 2) AS INT)"
    pm = f"upper(regexp_extract({time_txt}, '{TIME_RE}', 3)) = 'PM'"
    return (
        f"CASE WHEN {date_txt} RLIKE '{DATE_RE}' AND {time_txt} RLIKE '{TIME_RE}' "
        f"AND {h12} BETWEEN 1 AND 12 AND {mi} BETWEEN 0 AND 59 THEN try_make_timestamp_ntz("
        f"CASE WHEN {yy} >= 69 THEN {yy} + 1900 ELSE {yy} + 2000 END, "
        f"try_cast(get({d}, 0) AS INT), try_cast(get({d}, 1) AS INT), "
        f"{h12} % 12 + CASE WHEN {pm} THEN 12 ELSE 0 END, {mi}, 0) END"
    )


def parse_listing(df: DataFrame, line_col: str = "line", dir_col: str = "dir") -> DataFrame:
    """P1-P4 on a DataFrame of (dir, line); every input row is kept.

    Adds: filename, is_dir, datetime (TIMESTAMP_NTZ), size (bigint, 0 when not a
    number), size_invalid, size_text, extension, full_path, parse_error (null
    when fine).

    The line is split once into a struct that is ``inline``d; filters on the
    derived columns then stop at that step instead of being rewritten into
    copies of the whole parse expression below it. The outer form is used so
    that the optimizer infers no ``size(...) > 0`` filter, which it would push
    (with the whole parse inlined) below any repartition of the input.
    Expressions are SQL text so that each is built in one call.
    """
    cols = list(df.columns)
    # Leading blanks dropped, then at most four fields; the last keeps its blanks.
    # A line whose fourth field would be blanks only has three fields.
    # The split is its own projection so it runs once per line.
    staged = df.withColumn("_parts", F.expr(f"split(regexp_replace(`{line_col}`, '^\\\\s+', ''), '\\\\s+', 4)"))
    tokens = F.expr(
        f"array(named_struct('_matched', size(_parts) = 4 AND get(_parts, 3) <> '', 'is_dir', contains(`{line_col}`, '<DIR>'), "
        "'_date_txt', get(_parts, 0), '_time_txt', get(_parts, 1), "
        "'size_text', get(_parts, 2), 'filename', get(_parts, 3)))"
    )
    t = staged.select(*cols, F.inline_outer(tokens))
    out = t.select(
        *cols,
        F.expr("CASE WHEN _matched THEN filename END").alias("filename"),
        "is_dir",
        F.expr(_listing_timestamp_sql("_date_txt", "_time_txt")).alias("datetime"),
        F.expr("CASE WHEN is_dir THEN CAST(NULL AS BIGINT) "
               "ELSE coalesce(try_cast(size_text AS BIGINT), CAST(0 AS BIGINT)) END").alias("size"),
        F.expr("NOT is_dir AND _matched AND try_cast(size_text AS BIGINT) IS NULL").alias("size_invalid"),
        F.expr("CASE WHEN _matched THEN size_text END").alias("size_text"),
        "_matched",
    )
    return out.select(
        *[c for c in out.columns if c != "_matched"],
        F.expr("CASE WHEN NOT is_dir AND contains(filename, '.') "
               "THEN lower(substring_index(filename, '.', -1)) END").alias("extension"),
        F.expr(f"concat(`{dir_col}`, '/', filename)").alias("full_path"),
        F.expr("CASE WHEN NOT _matched THEN 'line has fewer than four fields' "
               "WHEN NOT is_dir AND datetime IS NULL THEN 'bad date or time' END").alias("parse_error"),
    )


def listing_files(parsed: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """File entries of a parsed listing. PERMISSIVE drops unparseable lines (see
    ``listing_rejects``); FAILFAST raises on the first one, like the reference."""
    files = parsed.filter(~F.col("is_dir"))
    if mode.upper() == "FAILFAST":
        # The check sits in a filter so that it is evaluated on every row.
        check = F.when(F.col("parse_error").isNotNull(),
                       F.raise_error(F.concat(F.lit("bad listing line: "), F.coalesce("line", F.lit("null")))))
        return files.filter(check.isNull()).drop("parse_error")
    return files.filter(F.col("parse_error").isNull()).drop("parse_error")


def listing_rejects(parsed: DataFrame) -> DataFrame:
    """Lines that could not be parsed, with the reason."""
    return parsed.filter(F.col("parse_error").isNotNull())


def listing_subdirs(parsed: DataFrame, dir_col: str = "dir") -> DataFrame:
    """Directory entries, as (parent, child) paths; input for a bounded recursive walk."""
    return parsed.filter(F.col("is_dir")).select(
        F.col(dir_col).alias("parent"),
        F.concat(F.col(dir_col), F.lit("/"), F.col("filename")).alias("child"),
    )


def bad_sizes(parsed: DataFrame) -> DataFrame:
    """P3 warnings: file lines whose size field is not an integer (size set to 0)."""
    return parsed.filter(F.col("size_invalid"))


def reachable_dirs(subdirs: DataFrame, starts: DataFrame, max_depth: int = 3) -> DataFrame:
    """F6 on parent/child listings: (start_dir, dir, depth) for every directory
    reachable from a start directory through ``<DIR>`` entries, at most
    ``max_depth`` levels down (the start itself has depth 0).

    One recursive query with a bound of its levels. A directory reached in several ways, as in
    a cycle of links, is one row with its least depth; starts given twice count once."""
    spark = subdirs.sparkSession
    return spark.sql(
        """WITH RECURSIVE walk(start_dir, dir, depth) MAX RECURSION LEVEL {levels} AS (
             SELECT DISTINCT dir, dir, 0 FROM {starts} WHERE dir IS NOT NULL
             UNION ALL
             SELECT w.start_dir, s.child, w.depth + 1 FROM walk w JOIN {subdirs} s ON s.parent = w.dir WHERE w.depth < {most})
           SELECT start_dir, dir, min(depth) AS depth FROM (SELECT * FROM walk LIMIT ALL) GROUP BY start_dir, dir""".replace(
            "{levels}", str(max_depth + 2)),
        starts=starts.select("dir"), subdirs=subdirs.select("parent", "child").distinct(), most=max_depth)


def files_in_walk(files: DataFrame, walk: DataFrame) -> DataFrame:
    """Files that lie in a walked directory, tagged with start_dir and depth."""
    return files.join(walk, "dir", "inner")
