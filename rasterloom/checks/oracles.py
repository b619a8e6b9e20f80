"""DuckDB counterparts of the registered queries, written against the same tables."""

from __future__ import annotations

from rasterloom.checks.queries import CHUNKS, GRID, MAX_SAMPLES, SAMPLE_SIZE, SEED
from rasterloom.checks.views import PIXELS_SQL, view_sql

VIEWS = view_sql("duckdb")


def _with(views: list[str], body: str, recursive: bool = False) -> str:
    parts = [f"{v} AS ({VIEWS[v]})" for v in views]
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)}{body}"


# --- metadata ------------------------------------------------------------------------------

BASE = ["fx_mapping", "fx_typicality", "fx_files", "fx_disk", "fx_done"]

SUFFIXED = r"regexp_matches(regexp_extract(n, '[^/]*$'), '^.+\.[^.]+$')"


def _clean(key: str) -> str:
    return f""",
clean AS (SELECT src_ord, k AS artikelnummer,
   CASE WHEN {SUFFIXED} THEN n ELSE n || '.jpg' END AS image_name
 FROM (SELECT src_ord, {key} AS k, trim(image_name) AS n FROM fx_mapping) AS t
 WHERE k IS NOT NULL AND n IS NOT NULL AND n <> '')"""


def _merged(literal: bool = False) -> str:
    key = "coalesce(trim(artikelnummer), 'nan')" if literal else "trim(artikelnummer)"
    return (
        _clean(key)
        + f""",
scores AS (SELECT src_ord AS t_ord, {key} AS t_key, typicality FROM fx_typicality),
joined AS (SELECT clean.*, typicality,
   row_number() OVER (PARTITION BY image_name ORDER BY clean.src_ord, t_ord NULLS FIRST) AS rn
 FROM clean LEFT JOIN scores ON artikelnummer = t_key),
merged AS (SELECT src_ord, artikelnummer, image_name, typicality FROM joined WHERE rn = 1)"""
    )


MASTER = """,
master AS (SELECT m.src_ord, t.src_ord AS typicality_ord, trim(m.artikelnummer) AS artikelnummer,
   m.image_name, t.typicality
 FROM fx_mapping m JOIN fx_typicality t ON trim(m.artikelnummer) = trim(t.artikelnummer)),
disk_names AS (SELECT DISTINCT name FROM fx_disk WHERE regexp_matches(lower(name), '\\.(jpg|jpeg|png)$')),
named AS (SELECT *, CASE WHEN image_name IS NULL THEN ''
   WHEN regexp_matches(lower(trim(image_name)), '\\.(jpg|jpeg|png)$') THEN trim(image_name)
   ELSE trim(image_name) || '.jpg' END AS image_name_formatted FROM master),
marked AS (SELECT *, image_name_formatted IN (SELECT name FROM disk_names) AS existe_en_disco FROM named)"""

AUDIT = """,
ids_m AS (SELECT DISTINCT artikelnummer AS value FROM fx_mapping WHERE artikelnummer IS NOT NULL AND image_name IS NOT NULL),
ids_t AS (SELECT DISTINCT artikelnummer AS value FROM fx_typicality WHERE artikelnummer IS NOT NULL),
expected AS (SELECT DISTINCT CASE WHEN regexp_matches(lower(n), '\\.(jpg|jpeg|png)$') THEN n ELSE n || '.jpg' END AS value
 FROM (SELECT trim(image_name) AS n FROM fx_mapping WHERE artikelnummer IS NOT NULL AND image_name IS NOT NULL) AS t
 WHERE n <> '' AND lower(n) <> 'nan'),
on_disk AS (SELECT DISTINCT name AS value FROM fx_disk WHERE regexp_matches(lower(name), '\\.(jpg|jpeg|png)$')),
ids_only_m AS (SELECT value FROM ids_m EXCEPT SELECT value FROM ids_t),
ids_only_t AS (SELECT value FROM ids_t EXCEPT SELECT value FROM ids_m),
missing AS (SELECT value FROM expected EXCEPT SELECT value FROM on_disk),
extra AS (SELECT value FROM on_disk EXCEPT SELECT value FROM expected),
matched AS (SELECT value FROM expected INTERSECT SELECT value FROM on_disk)"""

RANKED = """,
folders AS (SELECT * FROM (VALUES ('images', 0), ('samples', 1), ('Samples', 2), ('base', 3)) AS f(dir, rank)),
best AS (SELECT name, min(rank) AS rank, arg_min(size_bytes, rank) AS input_bytes FROM fx_disk JOIN folders USING (dir) GROUP BY name),
finished AS (SELECT DISTINCT name FROM fx_done WHERE size_bytes > 0)"""

PLAN = """,
plan AS (SELECT merged.*, CASE WHEN dir IS NOT NULL THEN dir || '/' || image_name END AS input_path, input_bytes,
   'images_standardized/' || image_name AS target,
   CASE WHEN finished.name IS NOT NULL THEN 'skipped' WHEN dir IS NOT NULL THEN 'todo' ELSE 'missing' END AS status
 FROM merged LEFT JOIN best ON best.name = image_name LEFT JOIN folders USING (rank)
 LEFT JOIN finished ON finished.name = image_name)"""


def _merged_query(body: str, literal: bool = False) -> str:
    return _with(BASE, _merged(literal) + RANKED + PLAN + body)


def _master_query(body: str) -> str:
    return _with(BASE, MASTER + body)


def _audit_query(body: str) -> str:
    return _with(BASE, AUDIT + body)


ZIP = r""",
members AS (SELECT archive, member, body, member LIKE '%/' AS is_dir,
   row_number() OVER (PARTITION BY archive ORDER BY place) - 1 AS ord,
   regexp_extract(member, '[^/]*$') AS name, CAST(strlen(body) AS BIGINT) AS size_bytes FROM fx_zip),
usable AS (SELECT * FROM members WHERE NOT is_dir
   AND regexp_matches(lower(name), '^.+\.(jpg|jpeg|png|webp|bmp)$'))"""

# --- images --------------------------------------------------------------------------------


def _images(body: str) -> str:
    return f"WITH RECURSIVE {PIXELS_SQL.strip()}{body}"


def _digests(source: str, columns: str = "r, g, b", extra: str = "") -> str:
    """Size and digest of the images in a pixel table; ``extra`` adds columns to group by."""
    r, g, b = columns.split(", ")
    return f"""SELECT image_id, CAST(max(y) + 1 AS INT) AS height, CAST(max(x) + 1 AS INT) AS width,
 md5(unhex(string_agg(printf('%02x%02x%02x', CAST({b} AS INT), CAST({g} AS INT), CAST({r} AS INT)), '' ORDER BY y, x))) AS digest
 FROM {source} GROUP BY image_id"""


def _with_failures(digests: str) -> str:
    """All images; those cut to nothing by size snapping are failed."""
    return f"""
SELECT s.image_id, height, width, digest, CASE WHEN digest IS NULL THEN 'failed' ELSE 'ok' END AS status
FROM fx_sizes s LEFT JOIN ({digests}) AS d USING (image_id)"""


def _all_ok(digests: str) -> str:
    return f"\nSELECT *, 'ok' AS status FROM ({digests}) AS d"


def _taps(name: str, size: str) -> str:
    """Fixed-point filter weights (n, o, i, k) for every distinct length ``size``."""
    return f"""
{name}_n AS (SELECT DISTINCT {size} AS n, CAST({size} // 16 * 16 AS INT) AS m FROM fx_sizes WHERE {size} >= 16),
{name}_o AS (SELECT n, o, CAST(n AS DOUBLE) / m AS s, (o + CAST(0.5 AS DOUBLE)) * (CAST(n AS DOUBLE) / m) AS c
  FROM (SELECT n, m, unnest(range(0, m)) AS o FROM {name}_n) AS t),
{name}_r AS (SELECT *, greatest(0, CAST(trunc(c - 3 * s + CAST(0.5 AS DOUBLE)) AS BIGINT)) AS lo,
  least(n, CAST(trunc(c + 3 * s + CAST(0.5 AS DOUBLE)) AS BIGINT)) AS hi FROM {name}_o),
{name}_t AS (SELECT n, o, i, (i - c + CAST(0.5 AS DOUBLE)) * (CAST(1 AS DOUBLE) / s) AS t
  FROM (SELECT *, unnest(range(lo, hi)) AS i FROM {name}_r) AS u),
{name}_w AS (SELECT n, o, i, CASE WHEN t < -3 OR t >= 3 THEN CAST(0 AS DOUBLE) WHEN t = 0 THEN CAST(1 AS DOUBLE)
   ELSE sin(pi() * t) / (pi() * t) * (sin(pi() * (t / 3)) / (pi() * (t / 3))) END AS w FROM {name}_t),
{name} AS (SELECT n, o, i, CAST(trunc(v + CASE WHEN v < 0 THEN CAST(-0.5 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END) AS BIGINT) AS k
  FROM (SELECT n, o, i, w / sum(w) OVER (PARTITION BY n, o) * 4194304 AS v FROM {name}_w) AS u)"""


def _filtered(column: str) -> str:
    return f"CAST(least(255, greatest(0, floor((sum(k * {column}) + 2097152) / CAST(4194304 AS DOUBLE)))) AS INT) AS {column}"


SNAPPED = (
    ","
    + _taps("across", "w")
    + ","
    + _taps("down", "h")
    + f""",
narrow AS (SELECT image_id, h, w, y, CAST(o AS INT) AS x, {_filtered("r")}, {_filtered("g")}, {_filtered("b")}
 FROM fx_pixels JOIN across ON n = w AND i = x WHERE h >= 16 GROUP BY image_id, h, w, y, o),
snapped AS (SELECT image_id, h, w, CAST(o AS INT) AS y, x, {_filtered("r")}, {_filtered("g")}, {_filtered("b")}
 FROM narrow JOIN down ON n = h AND i = y GROUP BY image_id, h, w, x, o)"""
)

GRAY = "((19595 * r + 38470 * g + 7471 * b + 32768) >> 16)"
EDGE_GRAY = "((9798 * r + 19235 * g + 3735 * b + 16384) >> 15)"


def _gradients(name: str, source: str) -> str:
    """``{name}_g``: derivatives and magnitude of each pixel; ``{name}_c``: ridge flag."""
    row = "(PARTITION BY image_id, y ORDER BY x)"
    col = "(PARTITION BY image_id, x ORDER BY y)"
    return f""",
{name}_l AS (SELECT image_id, y, x, CAST({EDGE_GRAY} AS BIGINT) AS v FROM {source}),
{name}_h AS (SELECT image_id, y, x, lead(v, 1, v) OVER {row} - lag(v, 1, v) OVER {row} AS d,
   lead(v, 1, v) OVER {row} + 2 * v + lag(v, 1, v) OVER {row} AS s FROM {name}_l),
{name}_d AS (SELECT image_id, y, x, lead(d, 1, d) OVER {col} + 2 * d + lag(d, 1, d) OVER {col} AS dx,
   lead(s, 1, s) OVER {col} - lag(s, 1, s) OVER {col} AS dy FROM {name}_h),
{name}_g AS (SELECT *, abs(dx) + abs(dy) AS m FROM {name}_d),
{name}_n AS (SELECT *, lag(m, 1, 0) OVER {row} AS ml, lead(m, 1, 0) OVER {row} AS mr FROM {name}_g),
{name}_a AS (SELECT *, lag(m, 1, 0) OVER {col} AS up, lag(ml, 1, 0) OVER {col} AS ul, lag(mr, 1, 0) OVER {col} AS ur,
   lead(m, 1, 0) OVER {col} AS dn, lead(ml, 1, 0) OVER {col} AS dl, lead(mr, 1, 0) OVER {col} AS dr FROM {name}_n),
{name}_c AS (SELECT image_id, y, x, m, CASE
   WHEN abs(dy) * 32768 < abs(dx) * 13573 THEN m > ml AND m >= mr
   WHEN abs(dy) * 32768 > abs(dx) * 13573 + abs(dx) * 65536 THEN m > up AND m >= dn
   WHEN (dx < 0) <> (dy < 0) THEN m > ur AND m > dl
   ELSE m > ul AND m > dr END AS ridge FROM {name}_a)"""


def _linked(name: str, low: int = 100, high: int = 200) -> str:
    """``{name}_e``: edge pixels after linking weak ones to strong ones."""
    return f""",
{name}_e AS (SELECT image_id, y, x FROM {name}_c WHERE ridge AND m > {high}
 UNION SELECT c.image_id, c.y, c.x FROM {name}_e e JOIN {name}_c c ON c.image_id = e.image_id
   AND c.y BETWEEN e.y - 1 AND e.y + 1 AND c.x BETWEEN e.x - 1 AND e.x + 1
 WHERE c.ridge AND c.m > {low})"""


def _edges(name: str, source: str) -> str:
    return _gradients(name, source) + _linked(name)


FLAT = """,
flat AS (SELECT image_id, y, x, CAST(r // 32 * 32 AS INT) AS r, CAST(g // 32 * 32 AS INT) AS g,
   CAST(b // 32 * 32 AS INT) AS b FROM snapped)"""


def _laplacian(name: str, source: str) -> str:
    row = "(PARTITION BY image_id, y ORDER BY x)"
    col = "(PARTITION BY image_id, x ORDER BY y)"
    return f""",
{name}_v AS (SELECT image_id, y, x, CAST({GRAY} AS BIGINT) AS v FROM {source}),
{name}_q AS (SELECT image_id, lag(v) OVER {row} + lead(v) OVER {row} + lag(v) OVER {col} + lead(v) OVER {col} - 4 * v AS q FROM {name}_v),
{name} AS (SELECT image_id, CAST(sum(q * q) AS BIGINT) AS energy FROM {name}_q WHERE q IS NOT NULL GROUP BY image_id)"""


def _grayed(source: str) -> str:
    return f"(SELECT image_id, y, x, {GRAY} AS v FROM {source}) AS gray"


TURNED = """,
turned AS (SELECT image_id, r, g, b,
  CASE tag WHEN 1 THEN y WHEN 2 THEN y WHEN 3 THEN h - 1 - y WHEN 4 THEN h - 1 - y
    WHEN 5 THEN x WHEN 6 THEN x ELSE w - 1 - x END AS y,
  CASE tag WHEN 1 THEN x WHEN 2 THEN w - 1 - x WHEN 3 THEN w - 1 - x WHEN 4 THEN x
    WHEN 5 THEN y WHEN 8 THEN y ELSE h - 1 - y END AS x
 FROM (SELECT *, image_id % 8 + 1 AS tag FROM fx_pixels) AS t)"""

OUTLINED = """,
outlined AS (SELECT s.image_id, s.y, s.x, CASE WHEN e.image_id IS NULL THEN """ + GRAY + """ ELSE 0 END AS v
 FROM snapped s LEFT JOIN src_e e ON e.image_id = s.image_id AND e.y = s.y AND e.x = s.x)"""

MASKED = """,
masked AS (SELECT s.image_id, s.y, s.x, CASE WHEN e.image_id IS NULL THEN 0 ELSE 255 END AS v
 FROM snapped s LEFT JOIN src_e e ON e.image_id = s.image_id AND e.y = s.y AND e.x = s.x)"""

WHITENED = """,
whitened AS (SELECT s.image_id, s.y, s.x, CASE WHEN o.r > 245 AND o.g > 245 AND o.b > 245 THEN 255
   ELSE (19595 * s.r + 38470 * s.g + 7471 * s.b + 32768) >> 16 END AS v
 FROM snapped s JOIN fx_pixels o ON o.image_id = s.image_id
  AND o.y = CAST(floor((s.y + CAST(0.5 AS DOUBLE)) * (CAST(s.h AS DOUBLE) / (s.h // 16 * 16))) AS INT)
  AND o.x = CAST(floor((s.x + CAST(0.5 AS DOUBLE)) * (CAST(s.w AS DOUBLE) / (s.w // 16 * 16))) AS INT))"""


def _sweep() -> str:
    settings = ", ".join(f"({low}, {high})" for low, high in GRID)
    return f"""{_gradients("src", "fx_pixels")},
grid AS (SELECT CAST(low AS INT) AS low, CAST(high AS INT) AS high FROM (VALUES {settings}) AS g(low, high)),
swept AS (SELECT low, high, image_id, y, x FROM src_c JOIN grid ON ridge AND m > high
 UNION SELECT e.low, e.high, c.image_id, c.y, c.x FROM swept e JOIN src_c c ON c.image_id = e.image_id
   AND c.y BETWEEN e.y - 1 AND e.y + 1 AND c.x BETWEEN e.x - 1 AND e.x + 1
 WHERE c.ridge AND c.m > e.low),
totals AS (SELECT count(*) AS images, CAST(sum(h * w) AS BIGINT) AS pixels FROM fx_sizes)
SELECT low, high, images, CAST(0 AS BIGINT) AS failed, count(image_id) AS edges, pixels, count(image_id) / CAST(pixels AS DOUBLE) AS density
FROM grid LEFT JOIN swept USING (low, high) JOIN totals ON true GROUP BY low, high, images, pixels"""


def _files(body: str) -> str:
    """Bitmaps as written for the file-based queries: some cut short, some empty."""
    return _images(f""",
digests AS ({_digests("fx_pixels")}),
bitmaps AS (SELECT 'img_' || CAST(s.image_id AS STRING) || '.bmp' AS name,
   CASE WHEN s.image_id % 20 = 0 THEN 'decode_failed' WHEN s.image_id % 20 = 1 THEN 'empty_file' ELSE 'ok' END AS status,
   height, width, digest FROM fx_sizes s JOIN digests USING (image_id)){body}""")


ORACLES: dict[str, str] = {
    "scan_mapping": _with(
        ["fx_mapping"],
        "\nSELECT row_number() OVER (ORDER BY src_ord) - 1 AS position, artikelnummer, image_name FROM fx_mapping",
    ),
    "drop_artifact": _with(["fx_typicality"], "\nSELECT artikelnummer, typicality FROM fx_typicality"),
    "inventory": _with(["fx_files", "fx_disk"], "\nSELECT dir, name, size_bytes FROM fx_disk"),
    "name_listing": _with(["fx_files", "fx_disk"], "\nSELECT DISTINCT name FROM fx_disk ORDER BY name"),
    "zip_members": _with(
        ["fx_zip", "fx_done"],
        ZIP
        + r""",
fresh AS (SELECT * FROM usable WHERE name NOT IN (SELECT name FROM fx_done WHERE size_bytes > 0)),
seen AS (SELECT *, row_number() OVER (ORDER BY archive, ord) AS nr FROM fresh),
ranked AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY CASE WHEN size_bytes = 0 THEN 1 ELSE 0 END,
   CASE WHEN size_bytes = 0 THEN -nr ELSE nr END) AS rn FROM seen)
SELECT name, archive, ord, member, size_bytes, regexp_matches(member, '(^/|(^|/)\.\.(/|$))') AS raw_unsafe,
 md5(body) AS digest FROM ranked WHERE rn = 1""",
    ),
    "decode": _files(
        """
SELECT name, CASE WHEN status = 'ok' THEN height END AS height, CASE WHEN status = 'ok' THEN width END AS width,
 CASE WHEN status = 'ok' THEN digest END AS digest, status FROM bitmaps"""
    ),
    "choose_dir": _with(
        ["fx_files", "fx_disk"],
        """
SELECT dir, count(*) AS files FROM fx_disk
JOIN (VALUES ('images', 0), ('samples', 1), ('Samples', 2), ('base', 3)) AS f(dir, rank) USING (dir)
GROUP BY dir, rank ORDER BY rank LIMIT 1""",
    ),
    "clean_mapping": _with(["fx_mapping"], _clean("trim(artikelnummer)") + "\nSELECT * FROM clean"),
    "format_names": _with(
        ["fx_mapping"],
        r"""
SELECT src_ord, CASE WHEN image_name IS NULL THEN ''
 WHEN regexp_matches(lower(trim(image_name)), '\.(jpg|jpeg|png)$') THEN trim(image_name)
 ELSE trim(image_name) || '.jpg' END AS image_name_formatted FROM fx_mapping""",
    ),
    "audit_expected": _audit_query("\nSELECT value AS image_name FROM expected"),
    "missing_rows": _master_query(
        "\nSELECT artikelnummer, image_name, typicality FROM marked WHERE NOT existe_en_disco"
    ),
    "work_plan": _merged_query("\nSELECT * FROM plan"),
    "merge_metadata": _merged_query("\nSELECT * FROM merged"),
    "merge_metadata_literal": _merged_query("\nSELECT * FROM merged", literal=True),
    "master_table": _master_query("\nSELECT * FROM master"),
    "local_samples": _merged_query(
        "\nSELECT * FROM merged WHERE image_name IN (SELECT name FROM fx_disk WHERE dir = 'samples')"
    ),
    "mark_existing": _master_query(
        "\nSELECT src_ord, typicality_ord, image_name_formatted, existe_en_disco FROM marked"
    ),
    "pending": _merged_query(
        "\nSELECT src_ord, image_name FROM merged WHERE image_name NOT IN (SELECT name FROM finished)"
    ),
    "locate_inputs": _merged_query("\nSELECT image_name, input_path FROM plan"),
    "missing_inputs": _merged_query(
        """
SELECT 'check' AS run_id, image_name, artikelnummer, 'locate' AS stage,
 'no input folder holds ' || image_name AS error FROM plan WHERE status = 'missing'"""
    ),
    "audit_summary": _audit_query(
        """
SELECT (SELECT count(*) FROM ids_m) AS ids_mapping, (SELECT count(*) FROM ids_t) AS ids_typicality,
 (SELECT count(*) FROM ids_only_m) AS ids_only_mapping, (SELECT count(*) FROM ids_only_t) AS ids_only_typicality,
 (SELECT count(*) FROM expected) AS files_expected, (SELECT count(*) FROM on_disk) AS files_on_disk,
 (SELECT count(*) FROM matched) AS files_matched, (SELECT count(*) FROM missing) AS files_missing,
 (SELECT count(*) FROM extra) AS files_extra"""
    ),
    "audit_job": _with(
        BASE,
        AUDIT.rstrip().rstrip(",")
        + MASTER
        + """
SELECT (SELECT count(*) FROM ids_m) AS ids_mapping, (SELECT count(*) FROM ids_t) AS ids_typicality,
 (SELECT count(*) FROM ids_only_m) AS ids_only_mapping, (SELECT count(*) FROM ids_only_t) AS ids_only_typicality,
 (SELECT count(*) FROM expected) AS files_expected, (SELECT count(*) FROM on_disk) AS files_on_disk,
 (SELECT count(*) FROM matched) AS files_matched, (SELECT count(*) FROM missing) AS files_missing,
 (SELECT count(*) FROM extra) AS files_extra, count(*) AS rows_total,
 count(*) FILTER (existe_en_disco) AS rows_found, count(*) FILTER (NOT existe_en_disco) AS rows_missing FROM marked""",
    ),
    "existence_summary": _master_query(
        """
SELECT count(*) AS total, count(*) FILTER (existe_en_disco) AS found,
 count(*) FILTER (NOT existe_en_disco) AS missing FROM marked"""
    ),
    "run_counters": _merged_query(
        """,
sizes AS (SELECT 'img_' || CAST(vec_id AS STRING) || '.jpg' AS image_name,
  12 + vec_id % 29 AS h, 12 + vec_id * 7 % 31 AS w FROM embeddings),
outcomes AS (SELECT CASE WHEN status = 'skipped' THEN 'skipped'
   WHEN status = 'todo' AND h >= 16 AND w >= 16 THEN 'processed' ELSE 'failed' END AS status
  FROM plan LEFT JOIN sizes USING (image_name))
SELECT status, count(*) AS images FROM outcomes GROUP BY status"""
    ),
    "max_samples": _merged_query(
        f"\nSELECT src_ord, image_name FROM merged ORDER BY src_ord, image_name LIMIT {MAX_SAMPLES}"
    ),
    "eval_sample": _audit_query(
        f"""
SELECT value AS name FROM matched ORDER BY md5(value || '#{SEED}'), value LIMIT {SAMPLE_SIZE}"""
    ),
    "ids_only_mapping": _audit_query("\nSELECT value FROM ids_only_m"),
    "ids_only_typicality": _audit_query("\nSELECT value FROM ids_only_t"),
    "files_missing": _audit_query("\nSELECT value FROM missing"),
    "files_extra": _audit_query("\nSELECT value FROM extra"),
    "files_matched": _audit_query("\nSELECT value FROM matched"),
    "ingest_union": _with(
        ["fx_files", "fx_disk", "fx_zip"],
        ZIP
        + r"""
SELECT name FROM usable UNION SELECT name FROM fx_disk
 WHERE regexp_matches(lower(name), '^.+\.(jpg|jpeg|png|webp|bmp)$')""",
    ),
    "orient": _images(TURNED + _all_ok(_digests("turned"))),
    "to_rgb": _images(_all_ok(_digests("fx_pixels"))),
    "snap_dims": _images(
        """
SELECT image_id, w AS width, h AS height, CAST(w // 16 * 16 AS INT) AS target_width,
 CAST(h // 16 * 16 AS INT) AS target_height,
 CASE WHEN w < 16 OR h < 16 THEN 'too_small' END AS reason FROM fx_sizes"""
    ),
    "resample": _images(SNAPPED + _with_failures(_digests("snapped"))),
    "grayscale": _images(_all_ok(_digests(_grayed("fx_pixels"), "v, v, v"))),
    "edge_gradient": _images(
        _gradients("src", "fx_pixels")
        + """
SELECT image_id, CAST(sum(m) AS BIGINT) AS gradient, count(*) FILTER (ridge AND m > 100 AND m <= 200) AS weak,
 count(*) FILTER (ridge AND m > 200) AS strong FROM src_c GROUP BY image_id"""
    ),
    "edge_map": _images(
        SNAPPED + _edges("src", "snapped") + MASKED + _with_failures(_digests("masked", "v, v, v"))
    ),
    "whiten": _images(SNAPPED + WHITENED + _all_ok(_digests("whitened", "v, v, v"))),
    "transform_default": _images(TURNED + _all_ok(_digests(_grayed("turned"), "v, v, v"))),
    "transform_control": _images(
        SNAPPED + _edges("src", "snapped") + OUTLINED + _with_failures(_digests("outlined", "v, v, v"))
    ),
    "export_roundtrip": _master_query(
        """
SELECT row_number() OVER (ORDER BY src_ord, typicality_ord) - 1 AS position, artikelnummer, image_name,
 typicality FROM master"""
    ),
    "audit_report": _audit_query(
        """
SELECT '1_imagenes_faltantes_en_disco' AS category, value FROM missing
UNION ALL SELECT '2_imagenes_sobrantes_en_disco', value FROM extra
UNION ALL SELECT '3_ids_solo_en_csv_mapping', value FROM ids_only_m
UNION ALL SELECT '4_ids_solo_en_csv_typicality', value FROM ids_only_t"""
    ),
    "image_sink": _images(_all_ok(_digests(_grayed("fx_pixels"), "v, v, v"))),
    "zip_manifest": _with(
        ["fx_files", "fx_disk"], "\nSELECT dir || '/' || name AS member, size_bytes FROM fx_disk"
    ),
    "copy_manifest": _audit_query(
        f""",
placed AS (SELECT name, size_bytes, row_number() OVER (PARTITION BY name ORDER BY rank) AS rn FROM fx_disk
  JOIN (VALUES ('images', 0), ('samples', 1), ('Samples', 2), ('base', 3)) AS f(dir, rank) USING (dir)),
chosen AS (SELECT value FROM matched ORDER BY md5(value || '#{SEED}'), value LIMIT {SAMPLE_SIZE})
SELECT name, size_bytes, 'copied' AS status FROM placed JOIN chosen ON name = value WHERE rn = 1"""
    ),
    "chunk_plan": _merged_query(
        f""",
listed AS (SELECT image_name, row_number() OVER (ORDER BY src_ord, image_name) - 1 AS position FROM merged)
SELECT image_name, position, position // CAST(ceil((SELECT count(*) FROM merged) / CAST({CHUNKS} AS DOUBLE)) AS BIGINT) AS chunk
FROM listed"""
    ),
    "stream_pending": _images(
        f""",
digests AS ({_digests(_grayed("fx_pixels"), "v, v, v")})
SELECT 'img_' || CAST(image_id AS STRING) || '.bmp' AS name,
 CASE WHEN image_id % 20 <> 0 THEN height END AS height, CASE WHEN image_id % 20 <> 0 THEN width END AS width,
 CASE WHEN image_id % 20 <> 0 THEN digest END AS digest, image_id % 20 <> 0 AS ok
FROM digests WHERE image_id % 20 <> 1"""
    ),
    "edge_retention": _images(
        SNAPPED
        + FLAT
        + _edges("src", "snapped")
        + _edges("res", "flat")
        + """,
ids AS (SELECT DISTINCT image_id FROM snapped),
counted AS (SELECT s.image_id, count(*) AS source_edges, count(r.image_id) AS kept_edges
  FROM src_e s LEFT JOIN res_e r ON r.image_id = s.image_id AND r.y = s.y AND r.x = s.x GROUP BY s.image_id)
SELECT image_id, coalesce(source_edges, 0) AS source_edges, coalesce(kept_edges, 0) AS kept_edges,
 kept_edges / CAST(source_edges AS DOUBLE) AS retention FROM ids LEFT JOIN counted USING (image_id)"""
    ),
    "texture_ratio": _images(
        SNAPPED
        + FLAT
        + _laplacian("before", "snapped")
        + _laplacian("after", "flat")
        + """
SELECT b.image_id, b.energy AS energy_before, a.energy AS energy_after,
 CASE WHEN b.energy > 0 THEN CAST(1 AS DOUBLE) - a.energy / CAST(b.energy AS DOUBLE) END AS suppression
FROM before b JOIN after a ON a.image_id = b.image_id"""
    ),
    "param_sweep": _images(_sweep()),
}
# Batches change how often the model is called, not what it returns.
ORACLES["transform_batches"] = ORACLES["transform_control"]
