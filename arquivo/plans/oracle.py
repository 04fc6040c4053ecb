"""DuckDB oracles for the registered queries.

The oracle is written independently of the Spark plans: classification is the
literal per-period regex join (not the shape equi-join), groups use window
functions, and so on. What is shared are the fixture SQL texts (the same text
runs in both engines) and the registry data, inlined as a VALUES list.
"""

from __future__ import annotations

from arquivo.plans import catalog as P
from arquivo.sources import fixtures as fx
from arquivo.sources import registry as reg

LINE_RE = r"^\s*(\S+)\s+(\S+)\s+(\S+)\s+(\S.*)$"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _registry_values() -> str:
    rows = []
    for d in reg.DATASETS.values():
        for p in d.periods:
            rows.append(
                f"({_q(d.key)}, {_q(d.group)}, {_q(reg.granularity(d.partition))}, {_q(p.dir)}, "
                f"{_q(p.shape)}, {_q(reg.period_regex(p))}, {'TRUE' if p.preliminary else 'FALSE'})"
            )
    return ("SELECT * FROM (VALUES " + ",\n".join(rows) +
            ") r(dataset, grp, granularity, period_dir, shape, pattern, preliminary)")


def _datasets_values() -> str:
    rows = [f"({_q(d.key)}, {_q(d.group)}, {_q(reg.granularity(d.partition))})"
            for d in reg.DATASETS.values()]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") d(dataset, grp, granularity)"


def _groups_values() -> str:
    rows = [f"({_q(k)}, {_q(v)})" for k, v in reg.GROUPS.items()]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") g(grp, group_name)"


def _support_values() -> str:
    rows = [f"('doc', {_q(k)}, {_q(d)})" for k, ds in reg.DOCS.items() for d in ds]
    rows += [f"('aux', {_q(k)}, {_q(d)})" for k, ds in reg.AUXILIARY.items() for d in ds]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") s(type, skey, sdir)"


def _century(x: str) -> str:
    return f"(CASE WHEN substr({x}, 1, 1) IN ('7', '8', '9') THEN 1900 ELSE 2000 END + CAST({x} AS INTEGER))"


def _slashes(x: str) -> str:
    return f"(length({x}) - length(replace({x}, '/', '')))"


def _parsed_files(lines: str) -> str:
    """CTE body: parsed file rows of a (id, dir, line) relation."""
    return f"""
SELECT id, dir, filename,
  CASE WHEN contains(filename, '.') THEN lower(regexp_extract(filename, '\\.([^.]*)$', 1)) END AS extension,
  COALESCE(size_num, 0) AS size, size_num IS NULL AS size_invalid, s_txt AS size_text,
  make_timestamp(
    CASE WHEN CAST(split_part(d_txt, '-', 3) AS INTEGER) >= 69 THEN 1900 ELSE 2000 END
      + CAST(split_part(d_txt, '-', 3) AS INTEGER),
    CAST(split_part(d_txt, '-', 1) AS INTEGER), CAST(split_part(d_txt, '-', 2) AS INTEGER),
    CAST(split_part(t_txt, ':', 1) AS INTEGER) % 12
      + CASE WHEN upper(right(t_txt, 2)) = 'PM' THEN 12 ELSE 0 END,
    CAST(substr(split_part(t_txt, ':', 2), 1, 2) AS INTEGER), 0) AS ts,
  dir || '/' || filename AS full_path
FROM (
  SELECT id, dir, line,
    regexp_extract(line, '{LINE_RE}', 1) AS d_txt, regexp_extract(line, '{LINE_RE}', 2) AS t_txt,
    regexp_extract(line, '{LINE_RE}', 3) AS s_txt, regexp_extract(line, '{LINE_RE}', 4) AS filename,
    TRY_CAST(regexp_extract(line, '{LINE_RE}', 3) AS BIGINT) AS size_num
  FROM {lines} WHERE NOT contains(line, '<DIR>') AND regexp_matches(line, '{LINE_RE}')
) x"""


def _above(table: str, directory: str) -> str:
    """The rows with each directory at most three levels above theirs (``above``, ``up``)."""
    parts = f"string_split({directory}, '/')"
    return (f"SELECT *, array_to_string({parts}[1:len({parts}) - up], '/') AS above "
            f"FROM (SELECT *, unnest(range(4)) AS up FROM {table}) WHERE up < len({parts})")


def _base_ctes() -> list[str]:
    uf_shapes = "('uf_year2_month', 'uf_year2_month_sia_pa', 'uf_year', 'uf_year2', 'uf_mapas_year', 'uf_cnv')"
    g = lambda i: f"regexp_extract(lname, pattern, {i})"
    return [
        f"remote_listing AS ({fx.REMOTE_LISTING_SQL})",
        f"pfiles AS ({_parsed_files('remote_listing')})",
        f"reg AS ({_registry_values()})",
        f"""matched AS (
SELECT f.* EXCLUDE (up, above), r.dataset, r.grp, r.preliminary, r.shape, r.pattern, r.period_dir,
  lower(f.filename) AS lname, CAST(up AS INTEGER) AS depth
FROM ({_above('pfiles', 'dir')}) f JOIN reg r ON f.above = r.period_dir
WHERE regexp_matches(lower(f.filename), r.pattern))""",
        f"""cls AS (
SELECT *,
  CASE WHEN shape IN {uf_shapes} THEN {g(1)} END AS uf,
  CAST(CASE WHEN shape IN ('uf_year2_month', 'uf_year2_month_sia_pa', 'uf_year2') THEN {_century(g(2))}
            WHEN shape IN ('uf_year', 'uf_mapas_year') THEN CAST({g(2)} AS INTEGER)
            WHEN shape = 'year' THEN CAST({g(1)} AS INTEGER)
            WHEN shape = 'year2' THEN {_century(g(1))} END AS INTEGER) AS year,
  CAST(CASE WHEN shape IN ('uf_year2_month', 'uf_year2_month_sia_pa') THEN CAST({g(3)} AS INTEGER) END AS INTEGER) AS month,
  CASE WHEN shape = 'uf_year2_month_sia_pa' THEN {g(4)} WHEN shape = 'any' THEN {g(1)} END AS version
FROM matched)""",
        """keyed AS (
SELECT *,
  lower(CASE WHEN version IS NOT NULL AND version <> '' THEN
          CASE WHEN pbase = '' THEN version ELSE pbase || '-' || version END
        ELSE pbase END) AS partition,
  CASE WHEN year IS NULL THEN '' WHEN month IS NULL THEN CAST(year AS VARCHAR)
       ELSE CAST(year AS VARCHAR) || lpad(CAST(month AS VARCHAR), 2, '0') END AS partition_dir
FROM (SELECT *,
  CASE WHEN uf IS NULL AND year IS NOT NULL AND month IS NULL THEN CAST(year AS VARCHAR)
       WHEN uf IS NOT NULL AND year IS NULL AND month IS NULL THEN uf
       WHEN uf IS NOT NULL AND year IS NOT NULL AND month IS NULL THEN CAST(year AS VARCHAR) || '-' || uf
       WHEN uf IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL
         THEN CAST(year AS VARCHAR) || lpad(CAST(month AS VARCHAR), 2, '0') || '-' || uf
       ELSE '' END AS pbase FROM cls) k)""",
        f"""entries AS MATERIALIZED (
SELECT *, '{P.ROOT}/' || dataset || CASE WHEN partition_dir <> '' THEN '/' || partition_dir ELSE '' END
  || '/' || dataset || CASE WHEN preliminary THEN '-preliminar' ELSE '' END
  || CASE WHEN partition <> '' THEN '_' || partition ELSE '' END
  || '@' || strftime(ts, '%Y%m%d') || '.' || extension AS local_path,
  full_path AS url, 'data' AS type
FROM keyed)""",
    ]


def _with(*extra: str, select: str) -> str:
    return "WITH " + ",\n".join(_base_ctes() + list(extra)) + "\n" + select


TS = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
CLASS_SELECT = (f"SELECT id, dataset, preliminary, uf, year, month, version, size, extension, "
                f"full_path, depth, {TS} AS datetime FROM cls")


def _period_text() -> str:
    return ("(COALESCE(CAST(year AS VARCHAR), '') || "
            "COALESCE(lpad(CAST(month AS VARCHAR), 2, '0'), ''))")


def _month(missing: str, bound: str) -> str:
    digits = f"replace({_q(bound)}, '-', '')"
    return f"CAST(CASE WHEN length({digits}) = 4 THEN {digits} || '{missing}' ELSE {digits} END AS INTEGER)"


def _slice_where(s) -> str:
    conds = []
    if s.regions:
        conds.append("COALESCE(uf IN (" + ", ".join(_q(r) for r in s.regions) + "), FALSE)")
    if s.start or s.end:
        if s.mode == "lexicographic":
            t = _period_text()
            if s.start:
                conds.append(f"{t} >= {_q(s.start)}")
            if s.end:
                conds.append(f"{t} <= {_q(s.end)}")
        else:
            # A year without month stands for its first month as a lower bound, its last as an upper.
            conds.append("year IS NOT NULL")
            if s.start:
                conds.append(f"year * 100 + COALESCE(month, 12) >= {_month('01', s.start)}")
            if s.end:
                conds.append(f"year * 100 + COALESCE(month, 1) <= {_month('12', s.end)}")
    return " AND ".join(conds) if conds else "TRUE"


def _support_ctes(resolve: str) -> list[str]:
    if resolve == "dataset":
        keys = f"SELECT dataset AS skey FROM ({_datasets_values()}) d"
    else:
        keys = f"SELECT DISTINCT grp AS skey FROM ({_datasets_values()}) d"
    return [
        f"slines AS ({P.support_listing_sql()})",
        f"sfiles AS ({_parsed_files('slines')})",
        f"sreg AS ({_support_values()})",
        "snorm AS (SELECT *, regexp_replace(dir, '/+', '/', 'g') AS ndir FROM sfiles)",
        f"""support AS (
SELECT f.id, f.filename, s.type, s.skey AS dataset, f.full_path AS url, f.size,
  CASE WHEN contains(f.filename, '.') THEN
    '{P.ROOT}/' || CASE s.type WHEN 'doc' THEN '_documentacao' ELSE '_auxiliar' END || '/' || s.skey || '/'
    || regexp_extract(f.filename, '^(.*)\\.([^.]*)$', 1) || '@' || strftime(f.ts, '%Y%m%d') || '.'
    || regexp_extract(f.filename, '^(.*)\\.([^.]*)$', 2) END AS local_path
FROM ({_above('snorm', 'ndir')}) f JOIN sreg s ON f.above = rtrim(s.sdir, '/')
WHERE s.skey IN ({keys}))""",
    ]


def _local_copy_cte() -> str:
    return ("local_copy AS (SELECT local_path AS path, CASE WHEN id % 7 = 0 THEN size - 1 ELSE size END AS size "
            "FROM entries WHERE id % 3 <> 0)")


def _plan_cte() -> str:
    return ("plan AS (SELECT e.* FROM entries e WHERE NOT EXISTS (SELECT 1 FROM local_copy c "
            "WHERE c.path = e.local_path AND c.size = e.size))")


def _store_ctes() -> list[str]:
    return [
        f"local_store AS ({fx.LOCAL_STORE_SQL})",
        """sp0 AS (
SELECT *, CASE WHEN strpos(name, '.') > 0 THEN length(name) - strpos(reverse(name), '.') + 1 ELSE 0 END AS ld
FROM local_store)""",
        """sp1 AS (
SELECT dir, name, size,
  CASE WHEN ld > 1 AND ld < length(name) THEN substr(name, 1, ld - 1) ELSE name END AS stem,
  CASE WHEN ld > 1 AND ld < length(name) THEN substr(name, ld) ELSE '' END AS extension
FROM sp0)""",
        """sp2 AS (
SELECT *, contains(stem, '@') AS has_at,
  regexp_extract(stem, '^(.*)@[^@]*$', 1) AS base, regexp_extract(stem, '@([^@]*)$', 1) AS date_txt
FROM sp1)""",
        """store_parsed AS (
SELECT dir, name, size, extension,
  CASE WHEN contains(base, '_') THEN split_part(base, '_', 1) ELSE base END AS dataset,
  CASE WHEN contains(base, '_') THEN regexp_extract(base, '^[^_]*_(.*)$', 1) ELSE '' END AS partition,
  CASE WHEN has_at AND regexp_matches(date_txt, '^[0-9]{8}$') THEN CAST(try_strptime(date_txt, '%Y%m%d') AS DATE) END AS date,
  CASE WHEN NOT has_at THEN 'missing ''@'' separator'
       WHEN NOT regexp_matches(date_txt, '^[0-9]{8}$') OR try_strptime(date_txt, '%Y%m%d') IS NULL THEN 'bad date'
  END AS reject_reason
FROM sp2)""",
        "store_valid AS (SELECT * FROM store_parsed WHERE reject_reason IS NULL)",
        """store_flagged AS (
SELECT *, name = max(name) OVER (PARTITION BY dir, partition) AS is_most_recent FROM store_valid)""",
    ]


def _store(select: str) -> str:
    return "WITH " + ",\n".join(_store_ctes()) + "\n" + select


def _events(select: str) -> str:
    return ("WITH tlog AS (SELECT CAST(event_id AS VARCHAR) AS filename, value AS seconds, "
            "user_id * 1000000 AS size, event_type AS dataset FROM events),\n"
            "tstats AS (SELECT *, size / 1000000 AS size_mb, "
            "CASE WHEN seconds = 0 THEN NULL ELSE (size * 8) / seconds END / 1000000 AS rate_mbps FROM tlog)\n"
            + select)


def _mb(x: str, pow2: int = 20, decimals: int = 1) -> str:
    return f"printf('%.{decimals}f', CAST({x} AS DOUBLE) / {2 ** pow2})"


def _summary_cte() -> str:
    return f"""summary AS (
SELECT a.dataset, n_files, total_bytes,
  CASE d.granularity
    WHEN 'year' THEN CASE WHEN ymin = 0 AND ynull > 0 THEN 'None' ELSE CAST(ymin AS VARCHAR) END
    WHEN 'yearmonth' THEN CAST(ymmin // 100 AS VARCHAR) || '-' || lpad(CAST(ymmin % 100 AS VARCHAR), 2, '0')
    ELSE '----' END AS first_period,
  CASE d.granularity
    WHEN 'year' THEN CASE WHEN ymax = 0 AND ynull > 0 THEN 'None' ELSE CAST(ymax AS VARCHAR) END
    WHEN 'yearmonth' THEN CAST(ymmax // 100 AS VARCHAR) || '-' || lpad(CAST(ymmax % 100 AS VARCHAR), 2, '0')
    ELSE '----' END AS last_period
FROM (SELECT dataset, count(*) AS n_files, CAST(sum(COALESCE(size, 0)) AS BIGINT) AS total_bytes,
        min(COALESCE(year, 0)) AS ymin, max(COALESCE(year, 0)) AS ymax,
        count(*) FILTER (WHERE year IS NULL) AS ynull,
        min(year * 100 + month) AS ymmin, max(year * 100 + month) AS ymmax
      FROM cls GROUP BY dataset) a
LEFT JOIN ({_datasets_values()}) d ON a.dataset = d.dataset)"""


def _dry_run_ctes() -> list[str]:
    s = P.DRY_RUN
    return _support_ctes("dataset") + [
        f"""dry AS (
SELECT dataset, type, partition, size, url FROM entries WHERE {_slice_where(s)}
UNION ALL
SELECT dataset, type, CAST(NULL AS VARCHAR) AS partition, size, url FROM support)""",
    ]


def oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    o["listing_parse"] = _with(select=(
        f"SELECT id, dir, filename, extension, size, size_invalid, {TS} AS datetime, full_path FROM pfiles"))
    o["listing_bad_sizes"] = _with(select="SELECT id, full_path, size_text, size FROM pfiles WHERE size_invalid")
    o["classify_files"] = _with(select=CLASS_SELECT)
    o["classify_equi"] = _with(select=CLASS_SELECT)
    o["unclassified_files"] = _with(select=(
        "SELECT id, dir, filename FROM pfiles p WHERE NOT EXISTS (SELECT 1 FROM cls c WHERE c.id = p.id)"))
    o["depth_filter"] = _with(select=(
        f"SELECT r.period_dir AS start_dir, f.id, f.full_path, "
        f"CAST({_slashes('f.dir')} - {_slashes('r.period_dir')} AS INTEGER) AS depth "
        f"FROM pfiles f JOIN (SELECT DISTINCT period_dir FROM reg) r "
        f"ON (f.dir = r.period_dir OR starts_with(f.dir, r.period_dir || '/')) "
        f"WHERE {_slashes('f.dir')} - {_slashes('r.period_dir')} <= 3"))
    o["partition_key"] = _with(select="SELECT id, dataset, partition FROM keyed")
    o["partition_dir"] = _with(select="SELECT id, dataset, partition_dir FROM keyed")
    o["stored_path"] = _with(select="SELECT id, dataset, local_path AS stored_path FROM entries")
    for name, s in P.SLICES.items():
        o[name] = _with(select=f"SELECT id, dataset, uf, year, month FROM cls WHERE {_slice_where(s)}")
    o["dataset_summary"] = _with(_summary_cte(), select=(
        "SELECT dataset, n_files, total_bytes, first_period, last_period FROM summary ORDER BY dataset"))
    o["dataset_summary_total"] = _with(select=(
        "SELECT dataset, count(*) AS n_files, CAST(sum(COALESCE(size, 0)) AS BIGINT) AS total_bytes, "
        "FALSE AS is_total FROM cls GROUP BY dataset UNION ALL "
        "SELECT NULL, count(*), CAST(sum(COALESCE(size, 0)) AS BIGINT), TRUE FROM cls"))
    o["group_summary"] = _with(
        f"ds AS ({_datasets_values()})", f"gn AS ({_groups_values()})",
        "cg AS (SELECT c.*, ds.grp AS g FROM cls c LEFT JOIN ds ON c.dataset = ds.dataset)",
        select=(
            "SELECT x.g AS \"group\", gn.group_name, x.dataset, x.level, x.n_files, x.total_bytes FROM ("
            "SELECT g, dataset, 0 AS level, count(*) AS n_files, CAST(sum(COALESCE(size, 0)) AS BIGINT) AS total_bytes FROM cg GROUP BY g, dataset "
            "UNION ALL SELECT g, NULL, 1, count(*), CAST(sum(COALESCE(size, 0)) AS BIGINT) FROM cg GROUP BY g "
            "UNION ALL SELECT NULL, NULL, 3, count(*), CAST(sum(COALESCE(size, 0)) AS BIGINT) FROM cg) x "
            "LEFT JOIN gn ON x.g = gn.grp"))
    o["unknown_datasets"] = _store(
        f", ds AS ({_datasets_values()})\n"
        "SELECT dataset, count(*) AS n_files FROM store_valid "
        "WHERE dataset NOT IN (SELECT dataset FROM ds) GROUP BY dataset")
    o["dry_run"] = _with(*_dry_run_ctes(), select="SELECT dataset, type, partition, size, url FROM dry")
    o["dry_run_total"] = _with(*_dry_run_ctes(), select=(
        "SELECT count(*) AS n_files, CAST(COALESCE(sum(COALESCE(size, 0)), 0) AS BIGINT) AS total_bytes FROM dry"))
    o["sync_plan"] = _with(_local_copy_cte(), _plan_cte(), select="SELECT id, dataset, local_path, size FROM plan")
    o["sync_plan_bucketed"] = o["sync_plan"]
    o["dry_run_once"] = _with(*_dry_run_ctes(), select=(
        "SELECT dataset, type, partition, url, CAST(1 AS BIGINT) AS n_files, size AS total_bytes FROM dry UNION ALL "
        "SELECT NULL, NULL, NULL, NULL, count(*), CAST(COALESCE(sum(size), 0) AS BIGINT) FROM dry"))
    o["summary_once"] = ("WITH rows_of AS (" + o["dataset_summary"] + ") SELECT * FROM (SELECT dataset, n_files, total_bytes, first_period, last_period "
                         "FROM rows_of UNION ALL SELECT NULL, CAST(COALESCE(sum(n_files), 0) AS BIGINT), CAST(COALESCE(sum(total_bytes), 0) AS BIGINT), "
                         "NULL, NULL FROM rows_of) q")
    o["listing_roundtrip"] = _with(select=(
        f"SELECT dir, filename, extension, size, size_invalid, {TS} AS datetime, full_path FROM pfiles"))
    o["sync_batches"] = _with(_local_copy_cte(), _plan_cte(), select=(
        "SELECT dataset, count(*) AS n_pending, CAST(sum(COALESCE(size, 0)) AS BIGINT) AS pending_bytes "
        "FROM plan GROUP BY dataset"))
    o["failed_files_report"] = _with(_local_copy_cte(), _plan_cte(), select=(
        "SELECT url, dataset, size FROM plan p WHERE EXISTS "
        "(SELECT 1 FROM local_copy c WHERE c.path = p.local_path) ORDER BY url"))
    o["failed_files_total"] = _with(_local_copy_cte(), _plan_cte(), select=(
        "SELECT count(*) AS n_failed, CAST(COALESCE(sum(size), 0) AS BIGINT) AS failed_bytes "
        "FROM plan p WHERE EXISTS (SELECT 1 FROM local_copy c WHERE c.path = p.local_path)"))
    o["failed_files_given"] = _with(_local_copy_cte(), _plan_cte(), select=(
        "SELECT url, dataset, size FROM plan WHERE url IN (SELECT full_path FROM pfiles WHERE id % 11 = 0) ORDER BY url"))
    o["selected_datasets"] = _with(select=(
        "SELECT id, dataset, size FROM cls WHERE dataset IN (" + ", ".join(map(_q, P.SELECTED)) + ")"))
    o["selected_types"] = _with(*_support_ctes("dataset"), select=(
        "SELECT id, type, dataset, url, size, local_path FROM entries UNION ALL "
        "SELECT id, type, dataset, url, size, local_path FROM support WHERE type = 'doc'"))
    o["catalog_entries"] = _with(*_support_ctes("dataset"), select=(
        "SELECT filename AS id, url, dataset AS \"group\", dataset, partition, "
        "type, size FROM entries UNION ALL "
        "SELECT filename, url, dataset, dataset, CAST(NULL AS VARCHAR), type, size FROM support"))
    o["support_files"] = _with(*_support_ctes("dataset"), select=(
        "SELECT id, type, dataset, url, size, local_path FROM support"))
    o["support_files_by_group"] = _with(*_support_ctes("group"), select=(
        "SELECT id, type, dataset, url, size, local_path FROM support"))
    o["catalog_union"] = _with(*_support_ctes("dataset"), select=(
        "SELECT id, type, dataset, url, size, local_path, partition FROM entries UNION ALL "
        "SELECT id, type, dataset, url, size, local_path, CAST(NULL AS VARCHAR) FROM support"))
    o["path_collisions"] = _with(select=(
        "SELECT local_path, count(*) AS n_files FROM entries GROUP BY local_path HAVING count(*) > 1"))
    o["store_parse"] = _store(
        "SELECT dir, name, dataset, partition, strftime(date, '%Y-%m-%d') AS date, extension, size FROM store_valid")
    o["store_rejects"] = _store("SELECT dir, name, reject_reason FROM store_parsed WHERE reject_reason IS NOT NULL")
    o["most_recent"] = _store("SELECT dir, name, dataset, partition, is_most_recent FROM store_flagged")
    o["version_positions"] = _store(
        "SELECT dir, name, row_number() OVER (PARTITION BY dir, partition ORDER BY name) AS position, "
        "count(*) OVER (PARTITION BY dir, partition) AS n FROM store_valid")
    o["archive_plan"] = _store(
        f"SELECT '{P.ROOT}/' || dir || '/' || name AS src_path, '{P.ARCHIVE_ROOT}/' || dir || '/' || name AS dest_path, "
        "dataset, partition, size FROM store_flagged WHERE NOT is_most_recent "
        "AND split_part(dir, '/', 1) NOT IN ('_documentacao', '_auxiliar')")
    o["manifest"] = _with(
        "hashed AS (SELECT doc_id, sha256(text) AS sha256, "
        "CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes FROM documents)",
        select=(
            "SELECT e.url, e.size, COALESCE(e.local_path, CAST(h.doc_id AS VARCHAR)) AS filepath, e.extension AS suffix, "
            "e.dataset, h.sha256, h.size_bytes, "
            "e.partition, e.preliminary, strftime(e.ts, '%Y-%m-%dT%H:%M:%S') AS remote_datetime "
            "FROM hashed h LEFT JOIN entries e ON h.doc_id = e.id"))
    o["manifest_by_path"] = _with(
        "hashed AS (SELECT d.doc_id, sha256(d.text) AS sha256, CAST(octet_length(encode(d.text)) AS BIGINT) AS size_bytes, "
        f"COALESCE(e.local_path, '{P.ROOT}/unlisted/' || CAST(d.doc_id AS VARCHAR)) AS path "
        "FROM documents d LEFT JOIN entries e ON d.doc_id = e.id)",
        select=(
            "SELECT e.url, h.path AS filepath, e.dataset, h.sha256, h.size_bytes, e.partition, "
            "strftime(e.ts, '%Y-%m-%dT%H:%M:%S') AS remote_datetime "
            "FROM hashed h LEFT JOIN entries e ON h.path = e.local_path"))
    o["store_manifest"] = _with(
        "holder AS (SELECT local_path, min(id) AS doc_id FROM entries GROUP BY local_path)",
        "files AS (SELECT sha256(d.text) AS sha256, CAST(octet_length(encode(d.text)) AS BIGINT) AS size_bytes, "
        f"COALESCE(h.local_path, '{P.ROOT}/unlisted/' || CAST(d.doc_id AS VARCHAR)) AS path "
        "FROM documents d LEFT JOIN holder h ON d.doc_id = h.doc_id)",
        select=(
            "SELECT e.url, e.size, f.path AS filepath, e.extension AS suffix, e.dataset, f.sha256, f.size_bytes, e.partition, e.preliminary, "
            "strftime(e.ts, '%Y-%m-%dT%H:%M:%S') AS remote_datetime FROM files f LEFT JOIN entries e ON f.path = e.local_path"))
    o["manifest_json"] = _with(
        "hashed AS (SELECT doc_id, sha256(text) AS sha256, "
        "CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes FROM documents)",
        select=(
            "SELECT e.url, e.size, COALESCE(e.local_path, CAST(h.doc_id AS VARCHAR)) AS filepath, e.extension AS suffix, "
            f"e.dataset, {TS.replace('ts', 'e.ts', 1)} AS created_at, h.sha256, h.size_bytes, "
            "e.partition, e.preliminary, strftime(e.ts, '%Y-%m-%dT%H:%M:%S') AS remote_datetime "
            "FROM hashed h LEFT JOIN entries e ON h.doc_id = e.id"))
    o["catalog_roundtrip"] = _with(select=CLASS_SELECT.replace("FROM cls", ", partition, partition_dir FROM keyed"))
    selected = ", ".join(_q(d) for d in P.SELECTED)
    o["catalog_slice"] = _with(select=" UNION ALL ".join(
        f"SELECT {_q(name)} AS slice, id, dataset, uf, year, month FROM cls WHERE {_slice_where(s)}"
        + (f" AND dataset IN ({selected})" if name == "slice_both" else "") for name, s in P.SLICES.items()))
    o["directory_walk"] = f"""
WITH RECURSIVE lines AS ({P.directory_listing_sql()}),
subdirs AS (SELECT DISTINCT dir AS parent, dir || '/' || regexp_extract(line, '<DIR>  (.*)$', 1) AS child FROM lines),
walk(start_dir, dir, depth) AS (
  SELECT DISTINCT '/tree/' || CAST(o_custkey % 40 AS VARCHAR), '/tree/' || CAST(o_custkey % 40 AS VARCHAR), 0 FROM orders WHERE o_custkey % 2 = 0
  UNION ALL SELECT w.start_dir, s.child, w.depth + 1 FROM walk w JOIN subdirs s ON s.parent = w.dir WHERE w.depth < 3)
SELECT start_dir, dir, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY start_dir, dir"""
    o["dry_run_report"] = _with(*_dry_run_ctes(), select=(
        "SELECT row_number() OVER (ORDER BY section, type, dataset, url, line) AS position, line FROM ("
        "SELECT 1 AS section, type, dataset, url, printf('%-27s', dataset) || ' ' || printf('%-20s', COALESCE(partition, '')) || ' ' || "
        f"printf('%9s', {_mb('size')}) || ' MB  ' || url AS line FROM dry UNION ALL SELECT 2, '', '', '', '' UNION ALL "
        "SELECT 3, '', '', '', 'Total: ' || CAST(count(*) AS VARCHAR) || ' files, ' || "
        f"{_mb('COALESCE(sum(COALESCE(size, 0)), 0)', 30, 2)} || ' GB' FROM dry) r"))
    o["transfer_stats"] = _events("SELECT filename, dataset, size, seconds, size_mb, rate_mbps FROM tstats")
    o["transfer_totals"] = _events(
        "SELECT dataset, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS total_bytes, "
        "round(sum(seconds), 6) AS total_seconds, "
        "round(CASE WHEN sum(seconds) = 0 THEN NULL ELSE (CAST(sum(size) AS BIGINT) * 8) / sum(seconds) END / 1000000, 6) AS rate_mbps "
        "FROM tlog GROUP BY dataset")
    o["report_lines"] = _with(_summary_cte(), select=(
        "SELECT dataset, printf('%-27s', dataset) || ' | ' || printf('%6d', n_files) || ' files | ' || "
        f"printf('%9s', {_mb('total_bytes')}) || ' MB | from ' || printf('%-7s', first_period) || ' to ' || "
        "printf('%-7s', last_period) AS line FROM summary"))
    o["report_with_header"] = _with(_summary_cte(), select=(
        "SELECT 0 AS position, '-----------Dataset----------|---Nº files---|--Total size--|------Period range------' AS line "
        "UNION ALL SELECT CAST(row_number() OVER (ORDER BY dataset) AS INTEGER), "
        "printf('%-27s', dataset) || ' | ' || printf('%6d', n_files) || ' files | ' || "
        f"printf('%9s', {_mb('total_bytes')}) || ' MB | from ' || printf('%-7s', first_period) || ' to ' || "
        "printf('%-7s', last_period) FROM summary"))
    o["report_totals"] = _with(select=(
        f"SELECT 'Total size: ' || {_mb('COALESCE(sum(size), 0)', 30)} || ' GB' AS size_line, "
        "'Total files: ' || CAST(count(*) AS VARCHAR) || ' files' AS files_line FROM cls"))
    o["dry_run_lines"] = _with(*_dry_run_ctes(), select=(
        "SELECT url, printf('%-27s', dataset) || ' ' || printf('%-20s', COALESCE(partition, '')) || ' ' || "
        f"printf('%9s', {_mb('size')}) || ' MB  ' || url AS line FROM dry"))
    o["dry_run_total_line"] = _with(*_dry_run_ctes(), select=(
        "SELECT 'Total: ' || CAST(count(*) AS VARCHAR) || ' files, ' || "
        f"{_mb('COALESCE(sum(COALESCE(size, 0)), 0)', 30, 2)} || ' GB' AS line FROM dry"))
    o["transfer_lines"] = _events(
        "SELECT filename, printf('%-40s', filename) || ' ' || printf('%6.2f', size_mb) || ' MB ' || "
        "printf('%5.2f', seconds) || ' s ' || COALESCE(printf('%5.2f', rate_mbps), '    -') || ' Mb/s' AS line FROM tstats")
    return o
