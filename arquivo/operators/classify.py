"""Classification of listed files into dataset periods.

A file belongs to a period when it lies in the period's directory or up to
``max_depth`` levels below it, and its lower-cased name matches
``^{prefix}{shape}\\.{ext}$``. A file matched by several periods yields one row
per match (bag semantics).

Two plans give the same rows:

* ``classify`` (default): every shape is anchored at the end of the stem, so the
  prefix is whatever precedes it and the match becomes an *equi*-join on
  (directory, shape, prefix, extension) against the broadcast registry. The mask
  of a name's end (letters and digits) tells which shapes it can have; the join
  does a hash lookup.
* ``classify_by_regex``: the literal reading, a broadcast join on directory with
  the period regex as residual predicate. Regexes then come from a column, so
  they are compiled at run time; kept as the reference semantics to test against.

The registry is a fixed 175-row table, so broadcasting it is size-bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arquivo.functions.columns import (
    ancestors_from_parts,
    century_year,
    extension_of,
    normalized_dir,
    stem_before_extension,
)
from arquivo.sources import registry as reg

# A name's mask has 'a' for a letter and '9' for a digit. Every shape is a tail of the stem
# with one mask ('any' has no tail); a SIA/PA name has a version letter or none. Whatever
# masks a stem ends in, each is the end of the longest one.
_FORMS = [
    ("uf_year2_month", "aa9999"),
    ("uf_year2_month_sia_pa", "aa9999"),
    ("uf_year2_month_sia_pa", "aa9999a"),
    ("uf_year", "aa9999"),
    ("uf_year2", "aa99"),
    ("year", "9999"),
    ("year2", "99"),
    ("uf_mapas_year", "aa_aaaaa_9999"),
    ("uf_cnv", "aa_aaa"),
    ("any", ""),
]
_LITERALS = {"uf_mapas_year": "_mapas_", "uf_cnv": "_cnv"}  # what follows the UF
_MONTHLY = ("uf_year2_month", "uf_year2_month_sia_pa")
_UF_SHAPES = tuple(dict.fromkeys(s for s, mask in _FORMS if mask.startswith("aa")))
_UF_LOWER = [c.lower() for c in reg.UF_CODES]
_MONTHS = [f"{m:02d}" for m in range(1, 13)]


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _in_stem(mask: str, at: int, length: int) -> str:
    """SQL: ``length`` characters of the stem's tail with that mask, from its place ``at``."""
    return f"substring(_stem, length(_stem) - {len(mask) - at - 1}, {length})"


def _form_sql(shape: str, mask: str) -> str:
    """SQL: the decomposition of the stem into prefix and tail; null if the tail, whose mask
    is known to be right, has no UF, month or text of the shape."""
    cond = []
    if shape in _UF_SHAPES:
        cond.append(f"{_in_stem(mask, 0, 2)} IN ({_sql_list(_UF_LOWER)})")
    if shape in _MONTHLY:
        cond.append(f"{_in_stem(mask, 4, 2)} IN ({_sql_list(_MONTHS)})")
    if shape in _LITERALS:
        cond.append(f"{_in_stem(mask, 2, len(_LITERALS[shape]))} = '{_LITERALS[shape]}'")
    prefix = f"substring(_stem, 1, length(_stem) - {len(mask)})" if mask else "''"
    form = f"named_struct('shape', '{shape}', 'prefix', {prefix}, 'n', {len(mask)})"
    return f"CASE WHEN {' AND '.join(cond)} THEN {form} END" if cond else form


def _candidates(df: DataFrame) -> DataFrame:
    """Adds ``_cands``: the decompositions of ``_stem`` as (shape, prefix, n), n being the
    length of the tail. The mask of the name's end leads to the few shapes it can have, so
    no other shape is tried; the tail's fields are read only of names that a period takes."""
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    longest = max(len(mask) for _, mask in _FORMS)
    masked = df.withColumn("_mask", F.expr(
        f"translate(right(_stem, {longest}), '{letters}{digits}', '{'a' * len(letters)}{'9' * len(digits)}')"))

    def forms(mask: str) -> str:
        return "array_compact(array(" + ", ".join(_form_sql(s, m) for s, m in _FORMS if mask.endswith(m)) + "))"

    masks = sorted({m for _, m in _FORMS if m}, key=len, reverse=True)
    cases = " ".join(f"WHEN endswith(_mask, '{m}') THEN {forms(m)}" for m in masks)
    return masked.withColumn("_cands", F.expr(f"CASE {cases} ELSE {forms('')} END")).drop("_mask")


def _fields() -> dict[str, Column]:
    """Partition fields of a name (``_stem``) that was taken as ``_c``."""
    tail = "right(_stem, _c.n)"

    def century(yy: str) -> str:
        return f"CASE WHEN substring({yy}, 1, 1) IN ('7', '8', '9') THEN 1900 ELSE 2000 END + try_cast({yy} AS INT)"

    monthly, ufs = _sql_list(_MONTHLY), _sql_list(_UF_SHAPES)
    return {
        "uf": F.expr(f"CASE WHEN _c.shape IN ({ufs}) THEN left({tail}, 2) END"),
        "year": F.expr(
            f"CASE WHEN _c.shape IN ({monthly}, 'uf_year2') THEN {century(f'substring({tail}, 3, 2)')} "
            f"WHEN _c.shape = 'year2' THEN {century(tail)} "
            f"WHEN _c.shape IN ('uf_year', 'year', 'uf_mapas_year') THEN try_cast(right(_stem, 4) AS INT) END"),
        "month": F.expr(f"CASE WHEN _c.shape IN ({monthly}) THEN try_cast(substring({tail}, 5, 2) AS INT) END"),
        "version": F.expr(
            f"CASE WHEN _c.shape = 'any' THEN _stem WHEN _c.shape = 'uf_year2_month_sia_pa' THEN substring({tail}, 7, 1) END"),
    }


def _registry_broadcast(spark) -> DataFrame:
    # 175 rows, fixed: a proven size bound for the broadcast.
    return F.broadcast(reg.registry(spark))


def with_known_ancestors(files: DataFrame, max_depth: int, dirs: list[str],
                         out: str = "period_dir") -> DataFrame:
    """Explode each file into the known directories it lies under (<= max_depth
    levels), adding ``out`` and ``depth``.

    The path is split once in a projection and the ancestor array built from
    that column, so the explode only reads a column. ``explode_outer`` keeps
    the optimizer from inferring a ``size(array) > 0`` filter and pushing it,
    with the array expression inlined, below a repartition; the null rows it
    yields are dropped by the known-directory filter."""
    # An IN list of this size is planned as a hash-set lookup (InSet).
    known = F.expr("_anc.ancestor IN (" + _sql_list(sorted({_norm(d) for d in dirs})) + ")")
    staged = files.withColumn("_dparts", F.split(normalized_dir(F.col("dir")), "/")).withColumn(
        "_ancs", ancestors_from_parts("_dparts", max_depth)
    )
    exploded = staged.withColumn("_anc", F.explode_outer("_ancs"))
    return exploded.filter(F.coalesce(known, F.lit(False))).select(
        "*", F.col("_anc.ancestor").alias(out), F.col("_anc.depth").alias("depth")
    ).drop("_anc", "_ancs", "_dparts")


def _norm(d: str) -> str:
    import re
    d = re.sub("/+", "/", d)
    return d[:-1] if len(d) > 1 and d.endswith("/") else d


_with_known_ancestors = with_known_ancestors


def _prepare(files: DataFrame) -> DataFrame:
    if "extension" not in files.columns:
        files = files.withColumn("extension", extension_of(F.col("filename")))
    return files


OUT_COLS = ["dataset", "preliminary", "uf", "year", "month", "version", "period_dir", "depth"]


def classify(files: DataFrame, max_depth: int = 3) -> DataFrame:
    """C2 via the shape equi-join. Input: dir, filename (+ any columns).

    Output: input columns + dataset, preliminary, uf, year, month, version,
    period_dir, depth; one row per (file, matching period).
    """
    spark = files.sparkSession
    files = _prepare(files)
    exploded = _with_known_ancestors(files, max_depth, reg.period_dirs())
    staged = exploded.withColumn(
        "_stem", stem_before_extension(F.lower(F.col("filename")), F.col("extension"))
    )
    cand = _candidates(staged).withColumn("_c", F.explode_outer("_cands")).filter(F.col("_c").isNotNull())
    r = _registry_broadcast(spark).select(
        F.col("period_dir").alias("_r_dir"), F.col("shape").alias("_r_shape"),
        F.col("prefix").alias("_r_prefix"), F.col("extension").alias("_r_ext"),
        "dataset", "preliminary",
    )
    joined = cand.join(
        r,
        (F.col("period_dir") == F.col("_r_dir"))
        & (F.col("_c.shape") == F.col("_r_shape"))
        & (F.col("_c.prefix") == F.col("_r_prefix"))
        & (F.col("extension") == F.col("_r_ext")),
        "inner",
    )
    base_cols = [c for c in files.columns if c not in OUT_COLS]
    fields = [column.alias(name) for name, column in _fields().items()]
    return joined.select(*base_cols, "dataset", "preliminary", *fields, "period_dir", "depth")


def _extract_by_pattern(lname: Column, pattern: Column, shape: Column) -> dict[str, Column]:
    """Partition fields from the period regex (column pattern), per shape."""
    def g(i: int) -> Column:
        return F.call_function("regexp_extract", lname, pattern, F.lit(i))

    uf_shapes = ["uf_year2_month", "uf_year2_month_sia_pa", "uf_year", "uf_year2",
                 "uf_mapas_year", "uf_cnv"]
    uf = F.when(shape.isin(*uf_shapes), g(1))
    year = (
        F.when(shape.isin("uf_year2_month", "uf_year2_month_sia_pa", "uf_year2"), century_year(g(2)))
        .when(shape.isin("uf_year", "uf_mapas_year"), g(2).cast("int"))
        .when(shape == "year", g(1).cast("int"))
        .when(shape == "year2", century_year(g(1)))
    )
    month = F.when(shape.isin("uf_year2_month", "uf_year2_month_sia_pa"), g(3).cast("int"))
    version = F.when(shape == "uf_year2_month_sia_pa", g(4)).when(shape == "any", g(1))
    return {"uf": uf, "year": year, "month": month, "version": version}


def classify_by_regex(files: DataFrame, max_depth: int = 3) -> DataFrame:
    """C2/J1 read literally: broadcast join on directory, period regex as residual."""
    spark = files.sparkSession
    files = _prepare(files)
    exploded = _with_known_ancestors(files, max_depth, reg.period_dirs())
    r = _registry_broadcast(spark).select(
        F.col("period_dir").alias("_r_dir"), "dataset", "preliminary",
        F.col("pattern").alias("_r_pattern"), F.col("shape").alias("_r_shape"),
    )
    lname = F.lower(F.col("filename"))
    joined = exploded.join(
        r, (F.col("period_dir") == F.col("_r_dir")) & F.regexp_like(lname, F.col("_r_pattern")), "inner"
    )
    fields = _extract_by_pattern(lname, F.col("_r_pattern"), F.col("_r_shape"))
    base_cols = [c for c in files.columns if c not in OUT_COLS]
    return joined.select(
        *base_cols, "dataset", "preliminary",
        fields["uf"].alias("uf"), fields["year"].alias("year"),
        fields["month"].alias("month"), fields["version"].alias("version"),
        "period_dir", "depth",
    )


def unclassified(files: DataFrame, max_depth: int = 3) -> DataFrame:
    """Listed files that no period takes, decided on each row: none of its candidate
    decompositions under any of its directories is a key of the registry (a literal set of
    at most 175). One scan, no join and no shuffle."""
    columns = files.columns
    staged = _prepare(files).withColumn("_dparts", F.split(normalized_dir(F.col("dir")), "/")).withColumn(
        "_ancs", ancestors_from_parts("_dparts", max_depth)
    ).withColumn("_stem", stem_before_extension(F.lower(F.col("filename")), F.col("extension")))
    periods = [dict(zip(reg.PERIOD_SCHEMA.fieldNames(), row)) for row in reg.period_rows()]
    dirs = sorted({p["period_dir"] for p in periods})
    names = sorted({"|".join((p["shape"], p["prefix"], p["extension"])) for p in periods})
    keys = sorted({"|".join((p["period_dir"], p["shape"], p["prefix"], p["extension"])) for p in periods})
    # Most files lie under one known directory at most, and most decompositions are no
    # registered name anywhere: both are thrown out before they are put together.
    named = staged.withColumn("_ancs", F.expr(f"filter(_ancs, a -> a.ancestor IN ({_sql_list(dirs)}))"))
    named = _candidates(named).withColumn("_keys", F.expr(
        "filter(transform(_cands, c -> concat(c.shape, '|', c.prefix, '|', extension)), "
        f"k -> coalesce(k IN ({_sql_list(names)}), false))"))
    taken = F.expr(f"exists(_ancs, a -> exists(_keys, k -> concat(a.ancestor, '|', k) IN ({_sql_list(keys)})))")
    return named.filter(~F.coalesce(taken, F.lit(False))).select(*columns)


def within_depth(files: DataFrame, start_dirs: list[str], max_depth: int = 3) -> DataFrame:
    """files reachable from each start directory within ``max_depth`` levels,
    with their depth (0 = directly in the start directory)."""
    return _with_known_ancestors(files, max_depth, sorted(set(start_dirs))).withColumnRenamed(
        "period_dir", "start_dir"
    )


def with_partition_struct(df: DataFrame) -> DataFrame:
    """The nested partition struct<uf, year, month, version> of the data model."""
    return df.withColumn(
        "partition", F.struct("uf", "year", "month", "version")
    )
