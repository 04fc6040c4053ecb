"""Column expressions shared by the operators.

All of them are Catalyst built-ins (no Python UDF), so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- years ------------------------------------------------------------------

def century_year(yy: Column | str) -> Column:
    """Two-digit year of a file name; first digit 7, 8, 9 -> 19yy, else 20yy."""
    yy = col(yy)
    base = F.when(F.substring(yy, 1, 1).isin("7", "8", "9"), F.lit(1900)).otherwise(F.lit(2000))
    return (base + yy.try_cast("int")).cast("int")


def listing_year(yy: Column | str) -> Column:
    """H2: two-digit year of a listing date (strptime pivot): 69-99 -> 19yy, else 20yy."""
    v = col(yy).try_cast("int")
    return F.when(v >= 69, v + 1900).otherwise(v + 2000).cast("int")


# --- names --------------------------------------------------------------------

def extension_of(name: Column | str) -> Column:
    """Lower-cased text after the last dot; null if there is no dot."""
    name = col(name)
    return F.when(name.contains("."), F.lower(F.substring_index(name, ".", -1)))


def stem_before_extension(lname: Column, ext: Column) -> Column:
    """Lower-cased name without its final '.ext' (ext already lower-cased)."""
    return F.substring(lname, F.lit(1), F.length(lname) - F.length(ext) - 1)


def path_suffix(name: Column | str) -> Column:
    """File suffix as a path library gives it: '.ext' after the last dot, or ''
    when the dot is the first or last character (or absent)."""
    name = col(name)
    i = F.length(name) - F.locate(".", F.reverse(name)) + 1  # 1-based position of last dot
    has = (F.locate(".", F.reverse(name)) > 0) & (i > 1) & (i < F.length(name))
    return F.when(has, F.concat(F.lit("."), F.substring_index(name, ".", -1))).otherwise(F.lit(""))


def path_stem(name: Column | str) -> Column:
    """File stem as a path library gives it: the name without ``path_suffix``."""
    name = col(name)
    suf = path_suffix(name)
    return F.substring(name, F.lit(1), F.length(name) - F.length(suf))


def normalized_dir(dir_: Column | str) -> Column:
    """Directory with repeated slashes collapsed and trailing slashes dropped."""
    return F.regexp_replace(F.regexp_replace(col(dir_), "/+", "/"), "(.)/$", "$1")


def ancestors_from_parts(parts: Column | str, max_depth: int = 3) -> Column:
    """Array of struct(ancestor, depth) from the split path ``parts`` (a column
    name): the directory itself (depth 0) and its parents up to ``max_depth``
    levels; entries beyond the root are null. Fixed arity, so it stays in
    generated code; ``parts`` should be a column so the split is done once."""
    if not isinstance(parts, str):
        n = F.size(parts)
        items = []
        for i in range(max_depth + 1):
            anc = F.array_join(F.slice(parts, F.lit(1), F.greatest(n - i, F.lit(1))), "/")
            items.append(F.when(n - i >= 1, F.struct(anc.alias("ancestor"), F.lit(i).alias("depth"))))
        return F.array(*items)
    items = [
        f"CASE WHEN size({parts}) - {i} >= 1 THEN named_struct('ancestor', "
        f"array_join(slice({parts}, 1, greatest(size({parts}) - {i}, 1)), '/'), 'depth', {i}) END"
        for i in range(max_depth + 1)
    ]
    return F.expr("array(" + ", ".join(items) + ")")


def ancestors(dir_: Column | str, max_depth: int = 3) -> Column:
    """``ancestors_from_parts`` of a directory column (split inline)."""
    return ancestors_from_parts(F.split(normalized_dir(dir_), "/"), max_depth)


# --- partitions ---------------------------------------------------------------

def partition_key(uf: Column | str, year: Column | str, month: Column | str,
                  version: Column | str) -> Column:
    """P5: partition string of (uf, year, month, version), lower-cased.

    year -> 'Y'; uf -> 'U'; uf+year -> 'Y-U'; uf+year+month -> 'YMM-U'; any other
    combination -> ''. A non-empty version is appended with '-' (or alone).
    """
    uf, year, month, version = col(uf), col(year), col(month), col(version)
    y = year.cast("string")
    mm = F.lpad(month.cast("string"), 2, "0")
    base = (
        F.when(uf.isNull() & year.isNotNull() & month.isNull(), y)
        .when(uf.isNotNull() & year.isNull() & month.isNull(), uf)
        .when(uf.isNotNull() & year.isNotNull() & month.isNull(), F.concat(y, F.lit("-"), uf))
        .when(uf.isNotNull() & year.isNotNull() & month.isNotNull(),
              F.concat(y, mm, F.lit("-"), uf))
        .otherwise(F.lit(""))
    )
    has_version = version.isNotNull() & (version != F.lit(""))
    withv = F.when(
        has_version,
        F.when(base == F.lit(""), version).otherwise(F.concat(base, F.lit("-"), version)),
    ).otherwise(base)
    return F.lower(withv)


def partition_dir(year: Column | str, month: Column | str) -> Column:
    """P6: '' without a year; else 'YYYY' or 'YYYYMM'."""
    year, month = col(year), col(month)
    return (
        F.when(year.isNull(), F.lit(""))
        .when(month.isNull(), year.cast("string"))
        .otherwise(F.concat(year.cast("string"), F.lpad(month.cast("string"), 2, "0")))
    )


def period_text(year: Column | str, month: Column | str) -> Column:
    """'YYYY', 'YYYYMM' or '' as the slicer compares them (month alone too)."""
    year, month = col(year), col(month)
    return F.concat(
        F.coalesce(year.cast("string"), F.lit("")),
        F.coalesce(F.lpad(month.cast("string"), 2, "0"), F.lit("")),
    )


def stored_name(dataset: Column | str, preliminary: Column | str, partition: Column | str,
                stamp_date: Column | str, extension: Column | str) -> Column:
    """P7: '{dataset}[-preliminar][_{partition}]@{YYYYMMDD}.{ext}'."""
    dataset, preliminary, partition = col(dataset), col(preliminary), col(partition)
    name = F.concat(
        dataset,
        F.when(preliminary, F.lit("-preliminar")).otherwise(F.lit("")),
        F.when(partition != F.lit(""), F.concat(F.lit("_"), partition)).otherwise(F.lit("")),
        F.lit("@"),
        F.date_format(col(stamp_date), "yyyyMMdd"),
        F.lit("."),
        col(extension),
    )
    return name


def join_path(*parts: Column) -> Column:
    """Join path parts with '/', skipping empty parts."""
    arr = F.array(*parts)
    return F.array_join(F.filter(arr, lambda p: p.isNotNull() & (p != F.lit(""))), "/")
