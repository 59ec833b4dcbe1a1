"""DuckDB SQL for every catalogue query with an SQL equivalent.

The views ``events lineitem part pages …`` are the driver's parquet tables.
The SQL restates each query independently (window functions, quantile_cont,
arg_min/arg_max) so that it checks the Spark plan rather than mirrors it.
"""

from __future__ import annotations

from ..constants import DROPPED_ELEMENTS
from ..functions.text import BLOCK_TAGS, ENTITIES

EV = "ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"

OBS = """obs AS (SELECT event_id AS id, 'u' || CAST(user_id AS VARCHAR) AS title,
    CASE WHEN k % 25 = 0 THEN NULL WHEN isnan(value) THEN NULL ELSE value END AS monthly_rent_eur,
    CASE WHEN k % 33 = 0 THEN NULL ELSE event_type END AS neighborhood,
    CAST(1 + k % 6 AS INTEGER) AS rooms,
    CASE WHEN k % 10 < 2 THEN TRUE WHEN k % 10 = 2 THEN NULL ELSE FALSE END AS is_pet_friendly,
    ts AS first_seen, ts AS last_seen
  FROM ev)"""

REQ = """req AS (SELECT event_id AS request_id,
    CASE WHEN k % 33 = 0 THEN NULL ELSE event_type END AS neighborhood,
    CAST(k % 6 AS INTEGER) AS rooms,
    CASE WHEN k % 10 < 2 THEN TRUE WHEN k % 10 = 2 THEN NULL ELSE FALSE END AS is_pet_friendly,
    CASE WHEN isnan(value) THEN NULL ELSE value END AS asking_price
  FROM ev)"""

SALES = """sales AS (SELECT p_name AS title,
    CASE WHEN isnan(l_extendedprice) THEN NULL ELSE l_extendedprice END AS monthly_rent_eur,
    p_brand AS neighborhood, CAST(1 + p_size % 6 AS INTEGER) AS rooms,
    CASE WHEN l_returnflag = 'R' THEN TRUE WHEN l_returnflag = 'N' THEN FALSE ELSE NULL END AS is_pet_friendly,
    l_shipdate AS last_seen, l_orderkey, l_linenumber, l_suppkey, l_extendedprice
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

VALID = """valid AS (SELECT * FROM obs
  WHERE title IS NOT NULL AND monthly_rent_eur IS NOT NULL AND neighborhood IS NOT NULL)"""


def dedup(src: str, out: str, order: str = "last_seen DESC NULLS FIRST, id DESC") -> str:
    return (f"{out} AS (SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY title, neighborhood ORDER BY {order}) AS _rn FROM {src}) WHERE _rn = 1)")


def fence(col: str, src: str, out: str) -> str:
    return (f"{out} AS (SELECT quantile_cont({col}, 0.25) - 1.5 * (quantile_cont({col}, 0.75) - "
            f"quantile_cont({col}, 0.25)) AS lo, quantile_cont({col}, 0.75) + 1.5 * "
            f"(quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) AS hi FROM {src})")


def clean_chain(src: str, out: str = "clean") -> str:
    return ",\n".join([
        f"c_nn AS (SELECT * REPLACE (coalesce(neighborhood, 'Unknown') AS neighborhood) FROM {src} "
        "WHERE monthly_rent_eur IS NOT NULL)",
        fence("monthly_rent_eur", "c_nn", "f_rent"),
        "c_rent AS (SELECT c_nn.* FROM c_nn, f_rent WHERE monthly_rent_eur IS NULL OR "
        "(monthly_rent_eur >= lo AND monthly_rent_eur <= hi))",
        fence("rooms", "c_rent", "f_rooms"),
        f"{out} AS (SELECT c_rent.* FROM c_rent, f_rooms WHERE rooms IS NULL OR (rooms >= lo AND rooms <= hi))",
    ])


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


OBS_CLEAN = with_(EV, OBS, dedup("obs", "dd"), clean_chain("dd"))
R6 = "round({}, 6)"

BUCKET = "CAST(CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || '|42'), 1, 8)) AS BIGINT) % 100 AS INTEGER)"
SPLIT = f"""split AS (SELECT *, {BUCKET} AS bucket FROM clean),
train AS (SELECT * EXCLUDE (bucket) FROM split WHERE bucket < 80),
test AS (SELECT * EXCLUDE (bucket) FROM split WHERE bucket >= 80),
prior AS (SELECT avg(monthly_rent_eur) AS prior FROM train),
te AS (SELECT neighborhood, CASE WHEN n = 1 THEN prior
           ELSE prior * (1 - 1.0 / (1 + exp(-(n - 20) / 10.0))) + mean * (1.0 / (1 + exp(-(n - 20) / 10.0))) END AS enc
       FROM (SELECT neighborhood, count(monthly_rent_eur) AS n, avg(monthly_rent_eur) AS mean
             FROM train WHERE neighborhood IS NOT NULL GROUP BY neighborhood), prior)"""


def metrics_select(keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    return (f"SELECT {k}count(*) AS n, round(avg(abs(prediction - y)), 6) AS mae, "
            "round(sqrt(avg((prediction - y) * (prediction - y))), 6) AS rmse, "
            "round(CASE WHEN var_pop(y) > 0 THEN 1 - sum((prediction - y) * (prediction - y)) / "
            "(var_pop(y) * count(*)) END, 6) AS r2, "
            "round(avg(CASE WHEN y <> 0 THEN abs((prediction - y) / y) END) * 100, 6) AS mape")


ROLL = """SELECT title, neighborhood, arg_min(id, id) AS id, arg_max(monthly_rent_eur, id) AS monthly_rent_eur,
    arg_min_null(rooms, id) AS rooms, arg_min_null(is_pet_friendly, id) AS is_pet_friendly,
    arg_min(last_seen, id) AS first_seen, arg_max(last_seen, id) AS last_seen FROM {} GROUP BY title, neighborhood"""

UPSERT_SPLIT = """mid AS (SELECT make_timestamp((epoch_us(min(last_seen)) + epoch_us(max(last_seen))) // 2) AS m FROM valid),
before AS (SELECT valid.* FROM valid, mid WHERE last_seen < m),
after AS (SELECT valid.* FROM valid, mid WHERE last_seen >= m)"""

TABLE_COLS = "id, title, monthly_rent_eur, neighborhood, rooms, is_pet_friendly, first_seen, last_seen"


def _page_text_sql() -> str:
    """Tables ``bodies``, ``cut``, ``walk`` (one row per page and cut: the open dropped element and its depth before the
    piece that follows), ``kept`` and ``texts``."""
    in_tag = """(?:[^>"'']|"[^"]*"|''[^'']*'')*"""
    raw, nested = ("script", "style"), [t for t in DROPPED_ELEMENTS if t not in ("script", "style", "img")]
    cut = ("(?is)<!--.*?-->|" + "|".join(f"<{t}\\b{in_tag}>.*?(?:</{t}\\s*>|\\z)" for t in raw)
           + f"|<img\\b{in_tag}>|</?(?:{'|'.join(nested)})\\b{in_tag}>")
    name, is_nested = "lower(regexp_extract(c, '^</?([A-Za-z]+)', 1))", ", ".join(f"'{t}'" for t in nested)
    t = f"regexp_replace(body, '(?i)<br\\s*/?>|</?(?:{'|'.join(BLOCK_TAGS)})\\b{in_tag}>', chr(10), 'g')"
    t = f"regexp_replace({t}, '(?s)<[A-Za-z/!?]{in_tag}>|<[^>]*>', '', 'g')"
    for ent, ch in ENTITIES:
        ch = ch.replace("'", "''")
        t = f"replace({t}, '{ent}', '{ch}')"
    t = f"regexp_replace({t}, '[ \\t\\r\\f]+', ' ', 'g')"
    t = f"regexp_replace({t}, ' ?\\n[ \\n]*', chr(10), 'g')"
    t = f"regexp_replace({t}, '^[ \\n]+|[ \\n]+\\z', '', 'g')"
    return f"""bodies AS (SELECT row_number() OVER () AS r, page_id, url, CASE WHEN regexp_matches(html, '(?i)<body\\b') THEN
    regexp_extract(html, '(?is)<body\\b{in_tag}>(.*?)(?:</body\\s*>|\\z)', 1) ELSE html END AS body FROM pages),
cut AS (SELECT r, regexp_extract_all(body, '{cut}') AS cs, string_split_regex(body, '{cut}') AS ps FROM bodies),
tags AS (SELECT r, i, {name} AS tag, CASE WHEN {name} NOT IN ({is_nested}) OR ({name} = 'svg' AND ends_with(c, '/>')) THEN 0
    WHEN c LIKE '</%' THEN -1 ELSE 1 END AS delta
  FROM (SELECT r, unnest(cs) AS c, unnest(range(1, len(cs) + 1)) AS i FROM cut)),
walk(r, i, open_tag, depth) AS (SELECT r, CAST(0 AS BIGINT), '', 0 FROM cut UNION ALL
  SELECT walk.r, walk.i + 1, CASE WHEN depth = 0 AND delta = 1 THEN tag ELSE open_tag END,
    CASE WHEN depth = 0 THEN greatest(delta, 0) WHEN tag = open_tag THEN depth + delta ELSE depth END
  FROM walk JOIN tags ON tags.r = walk.r AND tags.i = walk.i + 1),
kept AS (SELECT r, string_agg(ps[i + 1], '' ORDER BY i) AS body FROM walk JOIN cut USING (r) WHERE depth = 0 GROUP BY r),
texts AS (SELECT page_id, url, {t} AS text FROM (SELECT page_id, url, kept.body FROM bodies JOIN kept USING (r)))"""


PAGE_TEXT = _page_text_sql()

REPLY = """turn AS (SELECT *, id // 4 AS g, [0, 1, 2, 3, 5, 7][CAST((id // 4) % 6 AS INTEGER) + 1] AS shape FROM obs),
lst AS (SELECT g * 8 + CASE WHEN shape = 3 THEN id % 4 ELSE 0 END AS reply_id, shape, id, title, neighborhood,
    rooms, is_pet_friendly,
    CASE WHEN shape = 7 OR g % 5 <> 0 THEN CAST(round(monthly_rent_eur) AS INTEGER)
         ELSE CAST(monthly_rent_eur AS INTEGER) END AS rent,
    (monthly_rent_eur IS NOT NULL AND (shape = 7 OR g % 5 <> 0 OR monthly_rent_eur = floor(monthly_rent_eur))
     AND neighborhood IS NOT NULL AND rooms IS NOT NULL AND is_pet_friendly IS NOT NULL) AS ok
  FROM turn),
rep AS (SELECT reply_id, any_value(shape) AS shape, count(*) AS n, bool_and(ok) AS all_ok FROM lst GROUP BY reply_id
  UNION ALL SELECT DISTINCT g * 8 + CASE g % 6 WHEN 0 THEN 6 ELSE 4 END, CASE g % 6 WHEN 0 THEN 6 ELSE 4 END, 0, g % 6 = 1
  FROM turn WHERE g % 6 IN (0, 1)),
rk AS (SELECT reply_id, shape,
    CASE WHEN shape IN (0, 1, 7) THEN 'listings' WHEN shape = 2 THEN 'array' WHEN shape = 3 THEN 'single'
         WHEN shape = 4 THEN 'other' ELSE 'invalid' END AS root_kind,
    CAST(CASE WHEN shape NOT IN (5, 6) THEN n END AS INTEGER) AS n_candidates,
    all_ok AND shape NOT IN (5, 6) AS accepted
  FROM rep)"""

DEAL = """scored AS (SELECT request_id, neighborhood, asking_price,
      round(coalesce(te.enc, prior.prior), 2) AS predicted_rent_eur
    FROM req LEFT JOIN te USING (neighborhood), prior
    WHERE neighborhood IS NOT NULL AND rooms IS NOT NULL AND rooms >= 1 AND asking_price IS NOT NULL),
lab AS (SELECT *, predicted_rent_eur * 1.1 AS max_fair, predicted_rent_eur * 0.9 AS min_fair,
      CASE WHEN predicted_rent_eur > 0 THEN (asking_price - predicted_rent_eur) / predicted_rent_eur * 100
           ELSE 0.0 END AS delta_percent,
      CASE WHEN asking_price > predicted_rent_eur * 1.1 THEN 'Overpriced'
           WHEN asking_price < predicted_rent_eur * 0.9 THEN 'Great Deal' ELSE 'Fair Price' END AS deal
    FROM scored)"""


def _schema_rows(cols: list[tuple[str, str]], src: str) -> str:
    parts = []
    for i, (c, t) in enumerate(cols, 1):
        parts.append(f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS dtype, count({c}) AS non_null, "
                     f"count(*) - count({c}) AS null_count, "
                     f"CASE WHEN count(*) > 0 THEN round((count(*) - count({c})) * 100.0 / count(*), 2) "
                     f"ELSE 0.0 END AS null_percent FROM {src}")
    return "\nUNION ALL ".join(parts)


OBS_TYPES = [("id", "bigint"), ("title", "string"), ("monthly_rent_eur", "double"),
             ("neighborhood", "string"), ("rooms", "int"), ("is_pet_friendly", "boolean"),
             ("first_seen", "timestamp_ntz"), ("last_seen", "timestamp_ntz")]

LONG = """lng AS (SELECT 'rooms' AS column_name, CAST(rooms AS DOUBLE) AS value, id FROM obs WHERE rooms IS NOT NULL
  UNION ALL SELECT 'monthly_rent_eur', monthly_rent_eur, id FROM obs WHERE monthly_rent_eur IS NOT NULL),
bnd AS (SELECT column_name, quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS lo,
    quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS hi
  FROM lng GROUP BY column_name)"""

NOT_NULL_VIOL = """SELECT id, title, neighborhood, monthly_rent_eur,
  concat_ws(',', CASE WHEN title IS NULL THEN 'title' END, CASE WHEN monthly_rent_eur IS NULL THEN 'monthly_rent_eur' END,
            CASE WHEN neighborhood IS NULL THEN 'neighborhood' END) AS violations
FROM obs WHERE title IS NULL OR monthly_rent_eur IS NULL OR neighborhood IS NULL"""

ALERT_MSG = ("'🚨 **New Apartment Alert!** 🚨' || chr(10) || '**Title:** ' || coalesce(title, 'N/A') || chr(10) || '**Price:** ' || "
             "coalesce(CAST(monthly_rent_eur AS VARCHAR), 'N/A') || ' EUR' || chr(10) || '**Location:** ' || coalesce(neighborhood, 'N/A') || chr(10) || "
             "'**Rooms:** ' || coalesce(CAST(rooms AS VARCHAR), 'N/A')")

ORACLE: dict[str, str] = {
    "clean_listings": OBS_CLEAN + "SELECT * FROM clean",
    "clean_sales": with_(SALES, dedup("sales", "dd", "last_seen DESC NULLS FIRST, l_orderkey DESC, "
                                       "l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC"),
                         clean_chain("dd")) + "SELECT * FROM clean",
    "dedup_latest": with_(EV, OBS, dedup("obs", "dd")) + "SELECT * FROM dd",
    "dedup_no_timestamp": with_(EV, OBS, "o2 AS (SELECT * EXCLUDE (last_seen) FROM obs)",
                                dedup("o2", "dd", "id DESC")) + "SELECT * FROM dd",
    "clean_audit": OBS_CLEAN.rstrip("\n") + """,
s AS (SELECT (SELECT count(*) FROM obs) AS n_raw, (SELECT count(*) FROM dd) AS n_dedup,
  (SELECT count(*) FROM dd WHERE monthly_rent_eur IS NULL) AS n_no_target,
  (SELECT count(*) FROM dd WHERE monthly_rent_eur IS NOT NULL AND neighborhood IS NULL) AS n_imputed,
  (SELECT count(*) FROM c_nn) AS n1, (SELECT count(*) FROM c_rent) AS n2, (SELECT count(*) FROM clean) AS n3)
SELECT 1 AS step_no, 'deduplicate' AS step, n_raw AS rows_in, n_dedup AS rows_out, n_raw - n_dedup AS affected FROM s
UNION ALL SELECT 2, 'drop_missing_target', n_dedup, n1, n_no_target FROM s
UNION ALL SELECT 3, 'impute_neighborhood', n1, n1, n_imputed FROM s
UNION ALL SELECT 4, 'outliers_monthly_rent_eur', n1, n2, n1 - n2 FROM s
UNION ALL SELECT 5, 'outliers_rooms', n2, n3, n2 - n3 FROM s""",
    "impute_category": with_(EV, OBS) + "SELECT * REPLACE (coalesce(neighborhood, 'Unknown') AS neighborhood) "
                                        "FROM obs WHERE monthly_rent_eur IS NOT NULL",
    "fill_defaults": with_(EV, OBS) + """SELECT id, coalesce(title, 'Unknown') AS title,
  CAST(trunc(coalesce(monthly_rent_eur, 0)) AS INTEGER) AS monthly_rent_eur,
  coalesce(neighborhood, 'Unknown') AS neighborhood, CAST(coalesce(rooms, 1) AS INTEGER) AS rooms,
  coalesce(is_pet_friendly, FALSE) AS is_pet_friendly FROM obs""",
    "iqr_filter": with_(EV, OBS, fence("monthly_rent_eur", "obs", "f")) +
    "SELECT obs.* FROM obs, f WHERE monthly_rent_eur IS NULL OR (monthly_rent_eur >= lo AND monthly_rent_eur <= hi)",
    "iqr_outliers": with_(EV, OBS, fence("monthly_rent_eur", "obs", "f")) +
    "SELECT obs.* FROM obs, f WHERE monthly_rent_eur < lo OR monthly_rent_eur > hi",
    "read_projected": with_(EV, OBS) + f"SELECT {TABLE_COLS} FROM obs ORDER BY first_seen DESC NULLS FIRST",
    "latest_first": OBS_CLEAN + "SELECT * FROM clean ORDER BY last_seen DESC NULLS LAST",
    "kpi_summary": OBS_CLEAN + """SELECT count(*) AS total_listings, round(avg(monthly_rent_eur), 6) AS avg_rent_eur,
  format('{:,.2f}', avg(monthly_rent_eur)) AS avg_rent_display FROM clean""",
    "mean_by_category": OBS_CLEAN + """SELECT neighborhood, round(avg(monthly_rent_eur), 6) AS avg_rent_eur
  FROM clean WHERE neighborhood IS NOT NULL GROUP BY neighborhood ORDER BY avg_rent_eur DESC, neighborhood""",
    "category_summary_having": with_(EV, OBS) + """SELECT neighborhood, count(*) AS total_listings,
  round(avg(monthly_rent_eur), 0) AS avg_rent_eur, round(avg(rooms), 1) AS avg_rooms
FROM obs GROUP BY neighborhood HAVING count(*) > 1 ORDER BY avg_rent_eur DESC, neighborhood""",
    "profile_schema": with_(EV, OBS) + _schema_rows(OBS_TYPES, "obs"),
    "profile_nulls": with_(EV, OBS, "p AS (" + _schema_rows(
        [("monthly_rent_eur", "double"), ("neighborhood", "string"), ("rooms", "int"),
         ("is_pet_friendly", "boolean")], "obs") + ")") +
    "SELECT column_name, null_count, null_percent, non_null AS non_null_count, null_percent > 5.0 AS flagged FROM p",
    "profile_numeric": with_(EV, OBS, LONG) + """SELECT column_name, count(*) AS count, round(avg(value), 6) AS mean,
  round(quantile_cont(value, 0.5), 6) AS median, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
  round(max(value), 6) AS max, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.75), 6) AS q3,
  round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr FROM lng GROUP BY column_name""",
    "profile_anomalies": with_(EV, OBS, LONG) + """SELECT bnd.column_name, round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound,
  count_if(value < lo OR value > hi) AS outlier_count,
  round(count_if(value < lo OR value > hi) * 100.0 / (SELECT count(*) FROM obs), 2) AS outlier_percent
FROM bnd JOIN lng USING (column_name) GROUP BY bnd.column_name, lo, hi""",
    "outlier_samples": with_(EV, OBS, LONG) + """SELECT column_name, position, id, value FROM (
  SELECT column_name, CAST(row_number() OVER (PARTITION BY column_name ORDER BY id) AS INTEGER) AS position, id, value
  FROM lng JOIN bnd USING (column_name) WHERE value < lo OR value > hi) WHERE position <= 5""",
    "outlier_values": with_(EV, OBS, LONG) + """SELECT column_name, id, value
FROM lng JOIN bnd USING (column_name) WHERE value < lo OR value > hi""",
    "category_distribution": OBS_CLEAN + """SELECT neighborhood, count(*) AS listings,
  round(count(*) * 100.0 / (SELECT count(*) FROM clean), 2) AS share_percent
FROM clean WHERE neighborhood IS NOT NULL GROUP BY neighborhood""",
    "profile_categories": with_(EV, OBS) + """SELECT neighborhood, count(*) AS listings,
  round(count(*) * 100.0 / (SELECT count(*) FROM obs), 2) AS share_percent,
  (SELECT count(DISTINCT neighborhood) FROM obs) AS unique_values
FROM obs WHERE neighborhood IS NOT NULL GROUP BY neighborhood""",
    "distinct_sketches": with_(EV, OBS) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, (SELECT count(*) FROM (SELECT DISTINCT CAST(last_seen AS DATE) FROM obs)) AS days, "
        f"count(DISTINCT {c}) AS exact, TRUE AS within_error FROM obs" for c in ("title", "neighborhood", "rooms", "monthly_rent_eur")),
    "profile_boolean": with_(EV, OBS) + """SELECT count_if(is_pet_friendly) AS true_count,
  count_if(NOT is_pet_friendly) AS false_count, count_if(is_pet_friendly IS NULL) AS null_count FROM obs""",
    "top_categories": with_(EV, OBS) + """SELECT neighborhood, count(*) AS listings,
  round(count(*) * 100.0 / (SELECT count(*) FROM obs), 2) AS share_percent
FROM obs WHERE neighborhood IS NOT NULL GROUP BY neighborhood ORDER BY listings DESC, neighborhood LIMIT 5""",
    "completeness_score": with_(EV, OBS) + """SELECT count(*) AS rows, 8 AS columns,
  count(id) + count(title) + count(monthly_rent_eur) + count(neighborhood) + count(rooms) + count(is_pet_friendly)
    + count(first_seen) + count(last_seen) AS non_null_cells,
  CASE WHEN count(*) > 0 THEN round((count(id) + count(title) + count(monthly_rent_eur) + count(neighborhood)
    + count(rooms) + count(is_pet_friendly) + count(first_seen) + count(last_seen)) * 100.0 / (count(*) * 8), 6)
    ELSE 0.0 END AS completeness_percent FROM obs""",
    "quality_rates": with_(EV, OBS) + """SELECT count(*) AS rows,
  (SELECT count(*) FROM (SELECT DISTINCT title, neighborhood FROM obs)) AS distinct_keys,
  count_if(monthly_rent_eur BETWEEN 200 AND 2000 AND rooms >= 1) AS valid_rows,
  round((count(id) + count(title) + count(monthly_rent_eur) + count(neighborhood) + count(rooms)
    + count(is_pet_friendly) + count(first_seen) + count(last_seen)) * 100.0 / (count(*) * 8), 6) AS completeness_percent,
  round((SELECT count(*) FROM (SELECT DISTINCT title, neighborhood FROM obs)) * 100.0 / count(*), 6) AS uniqueness_percent,
  round(count_if(monthly_rent_eur BETWEEN 200 AND 2000 AND rooms >= 1) * 100.0 / count(*), 6) AS validity_percent
FROM obs""",
    "date_range": with_(EV, OBS) + """SELECT min(first_seen) AS min_first_seen, max(first_seen) AS max_first_seen,
  min(last_seen) AS min_last_seen, max(last_seen) AS max_last_seen FROM obs""",
    "key_violations": with_(EV, OBS) + """SELECT title, neighborhood, count(*) AS occurrences FROM obs
  GROUP BY title, neighborhood HAVING count(*) > 1""",
    "null_violations": with_(EV, OBS) + NOT_NULL_VIOL,
    "request_validation": with_(EV, REQ) + """SELECT request_id, neighborhood, rooms,
  coalesce(is_pet_friendly, FALSE) AS is_pet_friendly,
  CASE WHEN neighborhood IS NULL THEN 'neighborhood: field required' WHEN rooms IS NULL THEN 'rooms: field required'
       WHEN rooms < 1 THEN 'rooms: must be >= 1' END AS reject_reason FROM req""",
    "price_per_room": OBS_CLEAN + """SELECT id, monthly_rent_eur, rooms,
  CASE WHEN rooms > 0 THEN monthly_rent_eur / rooms ELSE 0.0 END AS price_per_room FROM clean""",
    "binary_encode": OBS_CLEAN + "SELECT id, CASE WHEN is_pet_friendly THEN 1 ELSE 0 END AS is_pet_friendly FROM clean",
    "target_encode_mean": OBS_CLEAN.rstrip("\n") + """,
m AS (SELECT neighborhood, avg(monthly_rent_eur) AS enc FROM clean WHERE neighborhood IS NOT NULL GROUP BY neighborhood)
SELECT id, neighborhood, round(coalesce(m.enc, (SELECT avg(monthly_rent_eur) FROM clean)), 6) AS neighborhood_te
FROM clean LEFT JOIN m USING (neighborhood)""",
    "engineer_features": OBS_CLEAN.rstrip("\n") + """,
m AS (SELECT neighborhood, avg(monthly_rent_eur) AS enc FROM clean WHERE neighborhood IS NOT NULL GROUP BY neighborhood)
SELECT id, round(coalesce(m.enc, (SELECT avg(monthly_rent_eur) FROM clean)), 6) AS neighborhood, rooms,
  CASE WHEN is_pet_friendly THEN 1 ELSE 0 END AS is_pet_friendly,
  round(CASE WHEN rooms > 0 THEN monthly_rent_eur / rooms ELSE 0.0 END, 6) AS price_per_room, monthly_rent_eur
FROM clean LEFT JOIN m USING (neighborhood)""",
    "model_inputs": OBS_CLEAN.rstrip("\n") + ",\n" + SPLIT + """
SELECT round(coalesce(te.enc, (SELECT prior FROM prior)), 6) AS neighborhood_te, coalesce(rooms, 0)::DOUBLE AS rooms_f,
  CASE WHEN is_pet_friendly THEN 1.0 ELSE 0.0 END::DOUBLE AS pets01, count(*)::DOUBLE AS weight,
  round(avg(monthly_rent_eur), 6) AS monthly_rent_eur
FROM train LEFT JOIN te USING (neighborhood) GROUP BY coalesce(te.enc, (SELECT prior FROM prior)), 2, 3""",
    "hash_split": OBS_CLEAN + f"SELECT id, {BUCKET} AS bucket, {BUCKET} < 80 AS is_train FROM clean",
    "target_encode_smoothed": OBS_CLEAN.rstrip("\n") + ",\n" + SPLIT + """
SELECT id, neighborhood, round(coalesce(te.enc, prior.prior), 6) AS neighborhood_te
FROM test LEFT JOIN te USING (neighborhood), prior""",
    "baseline_metrics": OBS_CLEAN.rstrip("\n") + ",\n" + SPLIT + """,
sc AS (SELECT monthly_rent_eur AS y, prior AS prediction FROM test, prior)
""" + metrics_select() + " FROM sc",
    "metrics_by_category": OBS_CLEAN.rstrip("\n") + ",\n" + SPLIT + """,
sc AS (SELECT neighborhood, monthly_rent_eur AS y, coalesce(te.enc, prior.prior) AS prediction
       FROM test LEFT JOIN te USING (neighborhood), prior)
""" + metrics_select("neighborhood") + " FROM sc GROUP BY neighborhood",
    "category_vocabulary": OBS_CLEAN.rstrip("\n") + ",\n" + SPLIT + """
SELECT neighborhood FROM (
  SELECT CAST(neighborhood AS VARCHAR) AS neighborhood FROM clean WHERE neighborhood IS NOT NULL
  UNION SELECT CAST(neighborhood AS VARCHAR) FROM te WHERE neighborhood IS NOT NULL)
WHERE lower(neighborhood) <> 'nan' ORDER BY neighborhood""",
    "upsert_update": with_(EV, OBS, VALID, UPSERT_SPLIT, f"t AS ({ROLL.format('before')})",
                           f"b AS ({ROLL.format('after')})") + """SELECT
  CASE WHEN t.id IS NOT NULL THEN t.id ELSE b.id END AS id, coalesce(t.title, b.title) AS title,
  CASE WHEN b.id IS NOT NULL THEN b.monthly_rent_eur ELSE t.monthly_rent_eur END AS monthly_rent_eur,
  coalesce(t.neighborhood, b.neighborhood) AS neighborhood,
  CASE WHEN t.id IS NOT NULL THEN t.rooms ELSE b.rooms END AS rooms,
  CASE WHEN t.id IS NOT NULL THEN t.is_pet_friendly ELSE b.is_pet_friendly END AS is_pet_friendly,
  CASE WHEN t.id IS NOT NULL THEN t.first_seen ELSE b.first_seen END AS first_seen,
  CASE WHEN b.id IS NOT NULL THEN b.last_seen ELSE t.last_seen END AS last_seen
FROM t FULL OUTER JOIN b ON t.title = b.title AND t.neighborhood = b.neighborhood""",
    "upsert_ignore": with_(EV, OBS, VALID, UPSERT_SPLIT, dedup("before", "tgt"),
                           "bf AS (SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY title, "
                           "neighborhood ORDER BY id) AS _rn FROM after) WHERE _rn = 1)") +
    f"""SELECT {TABLE_COLS} FROM tgt
UNION ALL SELECT {TABLE_COLS} FROM bf
  WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.title = bf.title AND tgt.neighborhood = bf.neighborhood)""",
    "observation_rollup": with_(EV, OBS, VALID) + f"SELECT {TABLE_COLS} FROM ({ROLL.format('valid')})",
    "page_frontier": """WITH bases AS (SELECT DISTINCT regexp_replace(url, '[?#].*$', '') AS base_url FROM pages)
SELECT base_url, CAST(r.range AS INTEGER) AS page_no,
  CASE WHEN r.range = 1 THEN base_url ELSE base_url || '?page=' || CAST(r.range AS VARCHAR) END AS url
FROM bases, range(1, 6) r""",
    "page_text": with_(PAGE_TEXT) + "SELECT page_id, text, CAST(length(text) AS INTEGER) AS n_chars FROM texts",
    "page_gate": with_(PAGE_TEXT) + """SELECT page_id, CAST(length(text) AS INTEGER) AS n_chars, CAST(segment_no AS INTEGER) AS segment_no,
  substring(text, (segment_no - 1) * 10000 + 1, 10000) AS prompt_text,
  CAST(length(substring(text, (segment_no - 1) * 10000 + 1, 10000)) AS INTEGER) AS prompt_chars
FROM (SELECT page_id, text, unnest(range(1, CAST(ceil(length(text) / 10000) AS BIGINT) + 1)) AS segment_no
      FROM texts WHERE length(text) >= 200)""",
    "reply_repair": with_(EV, OBS, REPLY) + "SELECT reply_id, root_kind, n_candidates FROM rk",
    "reply_validate": with_(EV, OBS, REPLY) + """SELECT reply_id, accepted,
  CAST(CASE WHEN accepted THEN n_candidates ELSE 0 END AS INTEGER) AS n_listings FROM rk""",
    "reply_listings": with_(EV, OBS, REPLY) + """SELECT reply_id, position, title, monthly_rent_eur, neighborhood, rooms,
  is_pet_friendly FROM (
  SELECT lst.reply_id, CAST(row_number() OVER (PARTITION BY lst.reply_id ORDER BY lst.id) AS INTEGER) AS position,
    lst.title, lst.rent AS monthly_rent_eur, lst.neighborhood, lst.rooms, lst.is_pet_friendly, rk.shape
  FROM lst JOIN rk USING (reply_id) WHERE rk.accepted AND rk.shape IN (0, 1, 2, 3, 7))
WHERE shape <> 3 OR position = 1""",
    "currency_normalise": with_(EV, """o AS (SELECT event_id AS id,
    CASE WHEN k % 25 = 0 THEN NULL WHEN isnan(value) THEN NULL ELSE value END AS rent,
    CASE WHEN k % 4 = 0 THEN 'RON' ELSE 'EUR' END AS currency,
    CASE WHEN k % 10 < 2 THEN TRUE WHEN k % 10 = 2 THEN NULL ELSE FALSE END AS is_pet_friendly FROM ev)""",
                                "q AS (SELECT *, CASE WHEN currency = 'RON' THEN rent * 5.0 ELSE rent END AS price FROM o)") +
    """SELECT id, currency, round(price, 6) AS price,
  round(CASE WHEN currency = 'RON' THEN price / 5.0 ELSE price END, 6) AS price_eur,
  coalesce(is_pet_friendly, FALSE) AS is_pet_friendly FROM q""",
    "alert_rows": with_(EV, OBS, VALID) + f"""SELECT id, title, monthly_rent_eur, neighborhood, rooms, {ALERT_MSG} AS message
FROM valid WHERE monthly_rent_eur <= 25.0 AND contains(neighborhood, 'ck')""",
    "deal_labels": OBS_CLEAN.rstrip("\n") + ",\n" + SPLIT + ",\n" + REQ + ",\n" + DEAL + """
SELECT request_id, asking_price, predicted_rent_eur, round(max_fair, 6) AS max_fair, round(min_fair, 6) AS min_fair,
  round(delta_percent, 6) AS delta_percent, deal, round(abs(delta_percent), 6) AS abs_delta_percent FROM lab""",
    "deal_quality": OBS_CLEAN.rstrip("\n") + ",\n" + SPLIT + ",\n" + REQ + ",\n" + DEAL + """,
truth AS (SELECT neighborhood, avg(monthly_rent_eur) AS tp FROM clean GROUP BY neighborhood),
j AS (SELECT lab.*, CASE WHEN asking_price > tp * 1.1 THEN 'Overpriced' WHEN asking_price < tp * 0.9 THEN 'Great Deal'
                    WHEN tp IS NOT NULL THEN 'Fair Price' END AS true_deal FROM lab LEFT JOIN truth USING (neighborhood))
SELECT count(true_deal) AS n, count_if(true_deal IS NULL) AS unlabelled, count_if(deal = 'Great Deal' AND true_deal = 'Great Deal') AS tp,
  count_if(deal = 'Great Deal' AND true_deal IS NOT NULL) AS pred_pos, count_if(true_deal = 'Great Deal') AS actual_pos,
  round(count_if(deal = true_deal) / NULLIF(count(true_deal), 0), 6) AS accuracy,
  round(count_if(deal = 'Great Deal' AND true_deal = 'Great Deal')
        / NULLIF(count_if(deal = 'Great Deal' AND true_deal IS NOT NULL), 0), 6)
    AS precision,
  round(count_if(deal = 'Great Deal' AND true_deal = 'Great Deal') / NULLIF(count_if(true_deal = 'Great Deal'), 0), 6)
    AS recall
FROM j""",
}


def _bigint_count_if(sql: str) -> str:
    """Wrap every count_if(...) in CAST(... AS BIGINT) so result types match Spark's."""
    out, i = [], 0
    key = "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j])
        out.append("CAST(" + key + _bigint_count_if(sql[j + len(key):k]) + ") AS BIGINT)")
        i = k + 1


ORACLE = {name: _bigint_count_if(sql) for name, sql in ORACLE.items()}

ORACLE["summary_stats"] = OBS_CLEAN + """SELECT min(rooms) AS min_rooms, max(rooms) AS max_rooms,
  round(avg(rooms), 6) AS avg_rooms, min(monthly_rent_eur) AS min_rent, max(monthly_rent_eur) AS max_rent,
  round(avg(monthly_rent_eur), 6) AS avg_rent, count(DISTINCT neighborhood) AS neighborhoods FROM clean"""
ORACLE["csv_roundtrip"] = ORACLE["clean_listings"]
ORACLE["table_lifecycle"] = ORACLE["clean_listings"]
ORACLE["scoring_responses"] = OBS_CLEAN.rstrip("\n") + ",\n" + SPLIT + ",\n" + REQ + """
SELECT request_id,
  CASE WHEN neighborhood IS NOT NULL AND rooms IS NOT NULL AND rooms >= 1
       THEN '{"predicted_rent_eur":' || CAST(round(coalesce(te.enc, prior.prior), 2) AS VARCHAR) || '}' END AS response,
  CASE WHEN neighborhood IS NULL THEN 'neighborhood: field required' WHEN rooms IS NULL THEN 'rooms: field required'
       WHEN rooms < 1 THEN 'rooms: must be >= 1' END AS reject_reason
FROM req LEFT JOIN te USING (neighborhood), prior"""

ORACLE["seed_load"] = with_(EV, OBS, """f AS (SELECT id, coalesce(title, 'Unknown') AS title,
    CAST(trunc(coalesce(monthly_rent_eur, 0)) AS INTEGER) AS monthly_rent_eur,
    coalesce(neighborhood, 'Unknown') AS neighborhood, CAST(coalesce(rooms, 1) AS INTEGER) AS rooms,
    coalesce(is_pet_friendly, FALSE) AS is_pet_friendly FROM obs)""") + """SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY title, neighborhood ORDER BY id) AS _rn FROM f) WHERE _rn = 1"""

ORACLE["price_window"] = with_(EV, OBS) + """SELECT id, title, neighborhood, monthly_rent_eur FROM obs
WHERE monthly_rent_eur BETWEEN 200 AND 2000"""

ORACLE["reply_ingest"] = with_(EV, OBS, REPLY, """acc AS (SELECT lst.reply_id * 1000 + CAST(row_number() OVER
    (PARTITION BY lst.reply_id ORDER BY lst.id) AS BIGINT) AS seq, lst.title, lst.neighborhood, lst.rent,
    lst.rooms, lst.is_pet_friendly, rk.shape
  FROM lst JOIN rk USING (reply_id) WHERE rk.accepted AND rk.shape IN (0, 1, 2, 3, 7)),
kept AS (SELECT * FROM acc WHERE shape <> 3 OR seq % 1000 = 1)""") + """SELECT arg_min(seq, seq) AS id, title,
  CAST(arg_max(rent, seq) AS DOUBLE) AS monthly_rent_eur, neighborhood, arg_min_null(rooms, seq) AS rooms,
  arg_min_null(is_pet_friendly, seq) AS is_pet_friendly, TIMESTAMP '2024-02-01 00:00:00' AS first_seen,
  TIMESTAMP '2024-02-01 00:00:00' AS last_seen
FROM kept GROUP BY title, neighborhood"""

# Streams started from an empty table give the batch answers.
ORACLE["stream_upsert"] = ORACLE["observation_rollup"]
ORACLE["stream_current"] = ORACLE["observation_rollup"]
ORACLE["stream_alerts"] = ORACLE["alert_rows"]
ORACLE["export_features"] = ORACLE["engineer_features"]
# sessions as gaps and islands; closed ones end before the latest hit (in milliseconds) less the delay
ORACLE["stream_alert_once"] = with_(EV, OBS, VALID) + f""", hits AS (SELECT * FROM valid WHERE monthly_rent_eur <= 25.0 AND contains(neighborhood, 'ck')),
marked AS (SELECT *, CASE WHEN last_seen - lag(last_seen) OVER w < INTERVAL 1 DAY THEN 0 ELSE 1 END AS fresh FROM hits
  WINDOW w AS (PARTITION BY title, neighborhood ORDER BY last_seen, id)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY title, neighborhood ORDER BY last_seen, id) AS session FROM marked),
sessions AS (SELECT title, neighborhood, arg_min(id, (last_seen, id)) AS id, count(*) AS hits, max(last_seen) AS last_hit
  FROM numbered GROUP BY title, neighborhood, session),
closed AS (SELECT * FROM sessions WHERE last_hit + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', max(last_seen)) FROM hits) - INTERVAL 1 DAY)
SELECT id, title, monthly_rent_eur, neighborhood, rooms, CAST(last_seen AS TIMESTAMP) AS event_time, closed.hits, {ALERT_MSG} AS message
FROM closed JOIN hits USING (id, title, neighborhood)""".replace("\n, hits AS", ",\nhits AS")
