"""Plain SQL for the registered queries, over the same views in DuckDB."""

from __future__ import annotations

TASK = "task-1"
CONDITION = (
    '{"startDate":"2024-01-05","endDate":"2024-01-25","startAge":"10","endAge":"50",'
    '"professionals":"BUILDING,MACHINERY,FURNITURE","targetPageFlow":"1,2,3,4,5,6,7"}'
)
SAMPLE_TARGET = 1000
SAMPLE_SEED = "7"
CLICK_LIMIT = 2
STREAM_SLICES = 8

#: The click tables over the test set.
VIEWS_SQL = """
WITH ev AS (
  SELECT event_id, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         strftime(ts, '%Y-%m-%d') AS day,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS sec,
         epoch_us(ts) // 1000 AS ms
  FROM events
),
user_visit_action AS (
  SELECT day AS date, user_id,
         user_id || '-' || replace(day, '-', '') AS session_id,
         k % 10 + 1 AS page_id,
         sec AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw_' || (k % 6) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k % 40 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'purchase'
              THEN (k % 20 + 1) || ',' || ((k + 7) % 20 + 1) END AS order_category_ids,
         CASE WHEN event_type = 'purchase'
              THEN ((k + 3) % 20 + 1) || ',' || ((k + 11) % 20 + 1) END AS order_product_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k % 20 + 1 AS VARCHAR) END
           AS pay_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k % 40 AS VARCHAR) END AS pay_product_ids,
         event_id % 25 AS city_id,
         event_id AS seq,
         CAST(epoch(CAST(sec AS TIMESTAMP)) AS BIGINT) AS t
  FROM ev
),
user_info AS (
  SELECT c_custkey AS user_id, CAST(10 + c_custkey % 50 AS INTEGER) AS age,
         c_mktsegment AS professional
  FROM customer
),
product_info AS (SELECT p_partkey AS product_id, p_name AS product_name FROM part),
city_info AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
ads_log AS (
  SELECT ev.ms || ' ' || replace(area, ' ', '_') || ' ' || city_name || ' '
           || user_id || ' ' || (k % 6 + 1) AS value,
         event_id AS seq
  FROM ev JOIN city_info ON event_id % 25 = city_id
),
ads AS (
  SELECT seq, CAST(split_part(value, ' ', 1) AS BIGINT) AS ms,
         split_part(value, ' ', 2) AS area, split_part(value, ' ', 3) AS city,
         split_part(value, ' ', 4) AS user_id, split_part(value, ' ', 5) AS ads_id
  FROM ads_log
)"""

SELECTED = """
va AS (
  SELECT a.* FROM user_visit_action a JOIN user_info u ON a.user_id = u.user_id
  WHERE a.date >= '2024-01-05' AND a.date <= '2024-01-25' AND u.age >= 10 AND u.age <= 50
    AND u.professional IN ('BUILDING', 'MACHINERY', 'FURNITURE')
)"""
ALL_ACTIONS = "\nva AS (SELECT * FROM user_visit_action)"


def _over(actions: str, ctes: str, select: str) -> str:
    return f"{VIEWS_SQL},{actions}{',' + ctes if ctes else ''}\n{select}"


def _all(ctes: str, select: str) -> str:
    return _over(ALL_ACTIONS, ctes, select)


def _selected(ctes: str, select: str) -> str:
    return _over(SELECTED, ctes, select)


PROFILE = """
profile AS (
  SELECT session_id, count(*) AS step_length,
         CAST((max(t) - min(t)) * 1000 AS BIGINT) AS visit_length_ms
  FROM va GROUP BY session_id
)"""


def _share(condition: str, name: str) -> str:
    part = f"count(*) FILTER (WHERE {condition})"
    return (
        f"floor(CAST(1000 AS DOUBLE) * {part} / nullif(count(*), 0) + CAST(0.5 AS DOUBLE))"
        f" / CAST(10 AS DOUBLE) AS {name}"
    )


STATS = f"""
SELECT '{TASK}' AS task_id, '{CONDITION}' AS condition, count(*) AS session_count,
  {_share('visit_length_ms > 10000', 'visit_gt_10_ratio')},
  {_share('visit_length_ms <= 10000', 'visit_le_10_ratio')},
  {_share('step_length > 5', 'step_gt_5_ratio')},
  {_share('step_length <= 5', 'step_le_5_ratio')}
FROM profile"""

SESSION_KIND = """CASE WHEN search_keyword IS NOT NULL THEN 'search'
       WHEN click_product_id <> -1 THEN 'click'
       WHEN order_product_ids IS NOT NULL THEN 'order'
       WHEN pay_product_ids IS NOT NULL THEN 'pay' END"""


def _category_kind(order_col: str) -> str:
    return f"""CASE WHEN click_category_id <> -1 THEN 'click'
       WHEN {order_col} <> '' THEN 'order'
       WHEN pay_category_ids <> '' THEN 'pay' END"""


def _csv(kind: str, value: str) -> str:
    return (
        f"coalesce(string_agg({value}, ',' ORDER BY action_time, seq)"
        f" FILTER (WHERE kind = '{kind}'), '')"
    )


INFO = f"""
marked AS (SELECT *, {SESSION_KIND} AS kind FROM va),
info AS (
  SELECT '{TASK}' AS "taskId", session_id AS "sessionId", min(action_time) AS "startTime",
    count(*) AS "stepLenth", CAST((max(t) - min(t)) * 1000 AS BIGINT) AS "visitLenth",
    {_csv('search', 'search_keyword')} AS "searchKeyWords",
    {_csv('click', 'CAST(click_product_id AS VARCHAR)')} AS "clickProductIds",
    {_csv('order', 'order_product_ids')} AS "orderProductIds",
    {_csv('pay', 'pay_product_ids')} AS "payProductIds"
  FROM marked GROUP BY session_id
)"""

HOURS = f"""
starts AS (
  SELECT session_id, substr(min(action_time), 1, 13) AS day_hour FROM va GROUP BY session_id
),
hours AS (
  SELECT day_hour, count(*) AS n_sessions,
    CAST(floor(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * {SAMPLE_TARGET}
               + CAST(0.5 AS DOUBLE)) AS BIGINT) AS quota
  FROM starts GROUP BY day_hour
),
drawn AS (
  SELECT session_id, day_hour, row_number() OVER (
    PARTITION BY day_hour ORDER BY md5('{SAMPLE_SEED}:' || session_id), session_id) AS rn
  FROM starts
),
chosen AS (SELECT session_id FROM drawn JOIN hours USING (day_hour) WHERE rn <= quota)"""


def _categories(order_col: str) -> str:
    return f"""
kinds AS (SELECT *, {_category_kind(order_col)} AS kind FROM va),
exploded AS (
  SELECT kind, unnest(string_split(
    CASE kind WHEN 'click' THEN CAST(click_category_id AS VARCHAR)
              WHEN 'order' THEN {order_col} ELSE pay_category_ids END, ',')) AS category_id
  FROM kinds WHERE kind IS NOT NULL
),
counts AS (
  SELECT category_id, count(*) FILTER (WHERE kind = 'click') AS click_count,
    count(*) FILTER (WHERE kind = 'order') AS order_count,
    count(*) FILTER (WHERE kind = 'pay') AS pay_count
  FROM exploded WHERE category_id <> '' GROUP BY category_id
),
top10 AS (
  SELECT '{TASK}' AS task_id, category_id, click_count, order_count, pay_count FROM counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, CAST(category_id AS BIGINT)
  LIMIT 10
),
session_clicks AS (
  SELECT category_id, session_id, count(*) AS click_count
  FROM va JOIN top10 ON CAST(click_category_id AS VARCHAR) = category_id
  GROUP BY category_id, session_id
)"""


CATEGORY_SESSIONS = f"""
SELECT '{TASK}' AS "taskId", category_id AS "categoryId", session_id AS "sessionId",
  click_count AS "clickCount"
FROM session_clicks
QUALIFY row_number() OVER (
  PARTITION BY category_id ORDER BY click_count DESC, session_id) <= 10"""

PAGES = """
steps AS (
  SELECT session_id, seq, page_id, lead(page_id) OVER (
    PARTITION BY session_id ORDER BY action_time, seq) AS next_page_id
  FROM va
),
visits AS (
  SELECT page_id, count(*) AS visits FROM va WHERE page_id IN (1, 2, 3, 4, 5, 6)
  GROUP BY page_id
),
jumps AS (
  SELECT page_id, page_id || '-' || next_page_id AS page_jump, count(*) AS jumps FROM steps
  WHERE next_page_id = page_id + 1 AND page_id BETWEEN 1 AND 6
  GROUP BY page_id, next_page_id
)"""

RATE = f"""
SELECT '{TASK}' AS task_id, page_jump,
  floor(jumps / CAST(visits AS DOUBLE) * 1000 + CAST(0.5 AS DOUBLE)) / CAST(10 AS DOUBLE)
    AS ratio
FROM jumps JOIN visits USING (page_id)"""

DETAIL = """
detail AS (
  SELECT area, p.product_id, product_name, city_name
  FROM user_visit_action v JOIN city_info c ON v.city_id = c.city_id
  JOIN product_info p ON p.product_id = v.click_product_id
)"""


def _remark(keys: str, whole: bool = False, out: str = "remarked") -> str:
    cut = "tenths // 10 * 10" if whole else "tenths"
    on = " AND ".join(f"g.{k} = r.{k}" for k in keys.split(", "))
    return f"""
per_city AS (
  SELECT {keys}, city_name, count(*) AS n FROM detail
  WHERE city_name <> '' GROUP BY {keys}, city_name
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, city_name) AS place,
    CAST(floor(n / CAST(sum(n) OVER (PARTITION BY {keys}) AS DOUBLE) * 1000
               + CAST(0.5 AS DOUBLE)) AS BIGINT) AS tenths
  FROM per_city
),
named AS (
  SELECT {keys}, count(*) AS cities,
    string_agg(city_name || ':' || CAST(({cut}) / CAST(10 AS DOUBLE) AS VARCHAR) || '%', ','
               ORDER BY place) FILTER (WHERE place <= 2) AS best,
    1000 - sum({cut}) FILTER (WHERE place <= 2) AS rest
  FROM ranked GROUP BY {keys}
),
{out} AS (
  SELECT {', '.join('g.' + k for k in keys.split(', '))}, g.clickcount,
    coalesce(best, '') || CASE WHEN cities > 2
      THEN ',其他:' || CAST(CAST(rest AS DOUBLE) / CAST(10 AS DOUBLE) AS VARCHAR) || '%'
      ELSE '' END AS cityremark
  FROM (SELECT {keys}, count(*) AS clickcount FROM detail GROUP BY {keys}) g
  LEFT JOIN named r ON {on}
)"""


PRODUCT_KEYS = "area, product_id, product_name"
TOP3_PRODUCTS = """
SELECT area, product_id, product_name, clickcount, cityremark FROM remarked
QUALIFY rank() OVER (PARTITION BY area ORDER BY clickcount DESC) <= 3"""

CLICKS = """
clicks AS (
  SELECT seq, ms, area, city, user_id, ads_id,
    strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS day,
    strftime(make_timestamp(ms * 1000), '%H:%M') AS hour_min,
    make_timestamp(ms // 60000 * 60000000) AS minute
  FROM ads
)"""

BATCH_OF_CLOCK = "ms // 5000"
BATCH_OF_SLICE = f"seq % {STREAM_SLICES}"


def _gate(batch: str) -> str:
    return f"""{CLICKS},
batched AS (SELECT *, {batch} AS batch FROM clicks),
batch_counts AS (
  SELECT user_id, ads_id, day, batch, count(*) AS n FROM batched
  GROUP BY user_id, ads_id, day, batch
),
with_prior AS (
  SELECT *, coalesce(sum(n) OVER (
    PARTITION BY user_id, ads_id, day ORDER BY batch
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
  FROM batch_counts
),
listed AS (
  SELECT user_id, min(batch) AS listed_batch FROM with_prior
  WHERE prior >= {CLICK_LIMIT} GROUP BY user_id
),
accepted AS (
  SELECT b.* FROM batched b LEFT JOIN listed l ON b.user_id = l.user_id
  WHERE listed_batch IS NULL OR batch <= listed_batch
),
city_counts AS (
  SELECT area, city, ads_id, day, count(*) AS click_count FROM accepted
  GROUP BY area, city, ads_id, day
),
area_counts AS (
  SELECT area, ads_id, day, CAST(sum(click_count) AS BIGINT) AS click_count FROM city_counts
  GROUP BY area, ads_id, day
)"""


STORED = f"""
SELECT p.user_id, ads_id, day, CAST(sum(n) AS BIGINT) AS click_count
FROM with_prior p LEFT JOIN listed l ON p.user_id = l.user_id
WHERE prior < {CLICK_LIMIT} AND (listed_batch IS NULL OR batch <= listed_batch)
GROUP BY p.user_id, ads_id, day"""


def _top3(table: str, order: str) -> str:
    return f"""
SELECT day, area, '[' || string_agg('{{"' || ads_id || '":' || click_count || '}}', ','
                                    ORDER BY rn) || ']' AS top_ads
FROM (SELECT *, row_number() OVER (PARTITION BY day, area ORDER BY {order}) AS rn FROM {table})
WHERE rn <= 3 GROUP BY day, area"""


TOP3 = _top3("area_counts", "click_count DESC, ads_id")
TOP3_CITY = _top3("city_counts", "click_count DESC, ads_id, city")


def _minutes(where: str) -> str:
    return f"""
SELECT ads_id, '[' || string_agg('{{"' || hour_min || '":' || n || '}}', ',' ORDER BY minute)
  || ']' AS minute_clicks
FROM (SELECT ads_id, minute, hour_min, count(*) AS n FROM accepted WHERE {where}
      GROUP BY ads_id, minute, hour_min)
GROUP BY ads_id"""


LAST_HOUR = "ms > (SELECT max(ms) FROM accepted) - 3600000"


def _ads(select: str, batch: str = BATCH_OF_CLOCK) -> str:
    return f"{VIEWS_SQL},{_gate(batch)}\n{select}"


def _keyed(key: str, field: str, value: str, source: str) -> str:
    return (
        f"\nSELECT {key} AS hash_key, {field} AS field, CAST({value} AS VARCHAR) AS value"
        f" FROM ({source})"
    )


CITY_COUNTS = "SELECT * FROM city_counts"
KEYED_CITY_COUNTS = _keyed(
    "'area_city_ads_day_clickcount'", "area || ':' || city || ':' || ads_id || ':' || day",
    "click_count", CITY_COUNTS,
)

ORACLES = {
    "load_tables": VIEWS_SQL
    + """
SELECT 'user_visit_action' AS table_name, count(*) AS n_rows, CAST(sum(seq) AS BIGINT) AS id_sum
FROM user_visit_action
UNION ALL SELECT 'user_info', count(*), CAST(sum(user_id) AS BIGINT) FROM user_info
UNION ALL SELECT 'product_info', count(*), CAST(sum(product_id) AS BIGINT) FROM product_info
UNION ALL SELECT 'city_info', count(*), CAST(sum(city_id) AS BIGINT) FROM city_info""",
    "save_table": VIEWS_SQL
    + """
SELECT date, user_id, session_id, page_id, action_time, search_keyword, click_category_id,
  click_product_id, order_category_ids, order_product_ids, pay_category_ids,
  pay_product_ids, city_id, seq
FROM user_visit_action""",
    "filtered_actions": _selected(
        "",
        """
SELECT date, user_id, session_id, page_id, action_time, search_keyword, click_category_id,
  click_product_id, order_category_ids, order_product_ids, pay_category_ids,
  pay_product_ids, city_id, seq
FROM va""",
    ),
    "action_kind": _all(
        "",
        f"SELECT seq, {SESSION_KIND} AS session_kind,"
        f" {_category_kind('order_category_ids')} AS category_kind FROM va",
    ),
    "percent_1dp": _all(
        "",
        "SELECT page_id, count(*) AS visits,"
        " floor(CAST(1000 AS DOUBLE) * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)"
        " + CAST(0.5 AS DOUBLE)) / CAST(10 AS DOUBLE) AS share FROM va GROUP BY page_id",
    ),
    "session_profile": _all(PROFILE, "SELECT * FROM profile"),
    "session_stat_info": _all(PROFILE, STATS),
    "session_stat_info_selected": _selected(PROFILE, STATS),
    "session_info": _all(INFO, "SELECT * FROM info"),
    "session_items": _all(
        INFO,
        """
SELECT session_id, kind, item,
  row_number() OVER (PARTITION BY session_id, kind ORDER BY action_time, seq) AS position
FROM (SELECT *, CASE kind WHEN 'search' THEN search_keyword
        WHEN 'click' THEN CAST(click_product_id AS VARCHAR)
        WHEN 'order' THEN order_product_ids ELSE pay_product_ids END AS item
      FROM marked WHERE kind IS NOT NULL)""",
    ),
    "sessions_per_hour": _all(HOURS, "SELECT * FROM hours"),
    "session_sample": _all(
        INFO + "," + HOURS,
        'SELECT * FROM info WHERE "sessionId" IN (SELECT session_id FROM chosen)',
    ),
    "session_sample_selected": _selected(
        INFO + "," + HOURS,
        'SELECT * FROM info WHERE "sessionId" IN (SELECT session_id FROM chosen)',
    ),
    "category_action_counts": _all(_categories("order_category_ids"), "SELECT * FROM counts"),
    "category_action_counts_product_ids": _all(
        _categories("order_product_ids"), "SELECT * FROM counts"
    ),
    "category_top10": _all(_categories("order_category_ids"), "SELECT * FROM top10"),
    "category_top10_product_ids": _all(
        _categories("order_product_ids"), "SELECT * FROM top10"
    ),
    "category_top10_selected": _selected(
        _categories("order_category_ids"), "SELECT * FROM top10"
    ),
    "category_session_counts": _all(
        _categories("order_category_ids"), "SELECT * FROM session_clicks"
    ),
    "category_top10_session_count": _all(_categories("order_category_ids"), CATEGORY_SESSIONS),
    "category_top10_session_count_selected": _selected(
        _categories("order_category_ids"), CATEGORY_SESSIONS
    ),
    "page_visit_counts": _all(PAGES, "SELECT * FROM visits"),
    "page_jumps": _all(
        PAGES,
        "SELECT session_id, seq, page_id, next_page_id, page_id || '-' || next_page_id"
        " AS page_jump FROM steps WHERE next_page_id IS NOT NULL",
    ),
    "page_jump_counts": _all(PAGES, "SELECT page_jump, jumps FROM jumps"),
    "page_convert_rate": _all(PAGES, RATE),
    "page_convert_rate_selected": _selected(PAGES, RATE),
    "area_product_click_detail": VIEWS_SQL + "," + DETAIL + "\nSELECT * FROM detail",
    "area_product_click_count": VIEWS_SQL + "," + DETAIL + "," + _remark(PRODUCT_KEYS)
    + "\nSELECT * FROM remarked",
    "city_remark": VIEWS_SQL + "," + DETAIL + "," + _remark("area")
    + "\nSELECT * FROM remarked",
    "city_remark_whole_percent": VIEWS_SQL + "," + DETAIL + "," + _remark("area", True)
    + "\nSELECT * FROM remarked",
    "area_top3_product": VIEWS_SQL + "," + DETAIL + "," + _remark(PRODUCT_KEYS)
    + TOP3_PRODUCTS,
    "area_top3_product_whole_percent": VIEWS_SQL + "," + DETAIL + ","
    + _remark(PRODUCT_KEYS, True) + TOP3_PRODUCTS,
    "ads_log_parse": VIEWS_SQL + "," + CLICKS
    + "\nSELECT seq, ms, area, city, user_id, ads_id, day, hour_min FROM clicks",
    "user_blacklist": _ads("SELECT user_id, listed_batch FROM listed"),
    "ads_log_filtered": _ads(
        "SELECT seq, ms, area, city, user_id, ads_id, day, hour_min FROM accepted"
    ),
    "user_ads_count_perday": _ads(STORED),
    "area_city_ads_day_clickcount": _ads(CITY_COUNTS),
    "area_ads_day_count": _ads("SELECT * FROM area_counts"),
    "top3_ads_per_day": _ads(TOP3),
    "top3_ads_per_day_by_city": _ads(TOP3_CITY),
    "ads_minute_counts": _ads(
        "SELECT ads_id, strftime(minute, '%Y-%m-%d %H:%M') AS minute, hour_min,"
        " count(*) AS click_count FROM accepted GROUP BY ads_id, minute, hour_min"
    ),
    "last_hour_ads_click": _ads(_minutes(LAST_HOUR)),
    "keyed_upsert": _ads(KEYED_CITY_COUNTS),
    "ads_stream": VIEWS_SQL + "," + CLICKS
    + "\nSELECT ms, area, city, user_id, ads_id, day, hour_min FROM clicks",
    "user_blacklist_stream": _ads("SELECT user_id FROM listed", BATCH_OF_SLICE),
    "ads_log_filtered_stream": _ads(
        "SELECT ms, area, city, user_id, ads_id, day, hour_min FROM accepted",
        BATCH_OF_SLICE,
    ),
    "user_ads_count_perday_stream": _ads(STORED, BATCH_OF_SLICE),
    "area_city_ads_day_clickcount_stream": _ads(KEYED_CITY_COUNTS, BATCH_OF_SLICE),
    "top3_ads_per_day_stream": _ads(
        _keyed("'top3_ads_per_day:' || day", "area", "top_ads", TOP3), BATCH_OF_SLICE
    ),
    "last_hour_ads_click_stream": _ads(
        _keyed("'last_hour_ads_click'", "ads_id", "minute_clicks", _minutes(LAST_HOUR)),
        BATCH_OF_SLICE,
    ),
}

# The report as SQL text of a session gives the same rows.
for _name in ("area_product_click_count", "area_top3_product"):
    ORACLES[f"{_name}_sql"] = ORACLES[_name]
