"""The same queries as SQL for DuckDB, on the same tables."""

from __future__ import annotations

VISIT = """
visit AS (
  SELECT o_custkey AS user_id, 's' || CAST(l_orderkey AS VARCHAR) AS session_id,
    CAST(l_linenumber AS BIGINT) AS page_id,
    TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(dd AS INT)) + to_hours(hh) + to_seconds(sec) AS action_time,
    CAST(DATE '2024-01-01' + CAST(dd AS INT) AS DATE) AS date,
    CASE WHEN k = 0 THEN 'kw' || CAST(l_partkey % 10 AS VARCHAR) END AS search_keyword,
    CASE WHEN k = 1 THEN l_suppkey % 100 ELSE -1 END AS click_category_id,
    CASE WHEN k = 1 THEN l_partkey % 100 ELSE -1 END AS click_product_id,
    CASE WHEN k = 2 THEN CAST(l_partkey % 100 AS VARCHAR) || ',' || CAST(l_suppkey % 100 AS VARCHAR) END AS order_category_ids,
    CASE WHEN k = 2 THEN CAST(l_partkey AS VARCHAR) END AS order_product_ids,
    CASE WHEN k = 3 THEN CAST(l_partkey % 100 AS VARCHAR) END AS pay_category_ids,
    CASE WHEN k = 3 THEN CAST(l_partkey AS VARCHAR) END AS pay_product_ids,
    l_suppkey % 10 AS city_id
  FROM (
    SELECT *, (l_partkey + l_suppkey) % 4 AS k, l_orderkey % 30 AS dd, (l_orderkey // 30) % 24 AS hh,
      (l_partkey * 7 + l_suppkey * 13 + l_linenumber * 101) %
      (CASE l_orderkey % 9 WHEN 0 THEN 4 WHEN 1 THEN 7 WHEN 2 THEN 10 WHEN 3 THEN 31 WHEN 4 THEN 61
        WHEN 5 THEN 181 WHEN 6 THEN 601 WHEN 7 THEN 1801 ELSE 3600 END) AS sec
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)),
act AS (SELECT * FROM visit WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-24')"""

USERS = """
users AS (
  SELECT c_custkey AS user_id, 'user' || CAST(c_custkey AS VARCHAR) AS username, c_name AS name,
    CAST(c_custkey % 60 AS INT) AS age, c_mktsegment AS professional,
    'city' || CAST(c_nationkey AS VARCHAR) AS city,
    CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer)"""

PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
    '{"product_status": ' || CAST(p_size % 2 AS VARCHAR) || '}' AS extend_info
  FROM part)"""

CITIES = """
cities(city_id, city_name, area) AS (
  VALUES (0, '北京', '华北'), (1, '上海', '华东'), (2, '南京', '华东'), (3, '广州', '华南'),
    (4, '三亚', '华南'), (5, '武汉', '华中'), (6, '长沙', '华中'), (7, '西安', '西北'),
    (8, '成都', '西南'), (9, '哈尔滨', '东北'))"""

SESSIONS = """
sess AS (
  SELECT session_id, coalesce(min(user_id) FILTER (user_id <> -1), -1) AS user_id,
    min(action_time) AS start_ts, max(action_time) AS end_ts,
    date_diff('second', min(action_time), max(action_time)) AS visit_length,
    count(*) AS step_length,
    list_sort(list(DISTINCT search_keyword) FILTER (search_keyword IS NOT NULL AND search_keyword <> '')) AS kws,
    list_sort(list(DISTINCT click_category_id) FILTER (click_category_id <> -1)) AS cats
  FROM act GROUP BY session_id),
sess_text AS (
  SELECT session_id, user_id, visit_length, step_length,
    strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS start_time,
    strftime(end_ts, '%Y-%m-%d %H:%M:%S') AS end_time,
    array_to_string(kws, ',') AS search_keywords, array_to_string(cats, ',') AS click_category_ids,
    start_ts, end_ts, kws, cats
  FROM sess)"""

#: The same over the whole log.
ALL_SESSIONS = SESSIONS.replace("FROM act", "FROM visit")

FULL = """
full_sess AS (
  SELECT s.*, u.age, u.professional, u.city, u.sex FROM sess_text s JOIN users u USING (user_id)),
kept AS (SELECT * FROM full_sess WHERE age BETWEEN 20 AND 50)"""

BASE = f"{VISIT},{USERS},{SESSIONS},{FULL}"

KEPT_EVENTS = """
kept_act AS (SELECT * FROM act WHERE session_id IN (SELECT session_id FROM kept)),
touch AS (
  SELECT session_id, click_category_id AS category_id, 1 AS c, 0 AS o, 0 AS p
    FROM kept_act WHERE click_category_id <> -1
  UNION ALL
  SELECT session_id, CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 0, 1, 0
    FROM kept_act WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT session_id, CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 0, 0, 1
    FROM kept_act WHERE pay_category_ids IS NOT NULL),
cat_counts AS (
  SELECT category_id, CAST(sum(c) AS BIGINT) AS click_count, CAST(sum(o) AS BIGINT) AS order_count,
    CAST(sum(p) AS BIGINT) AS pay_count
  FROM touch GROUP BY category_id),
top_cats AS (
  SELECT * FROM cat_counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10)"""

CATEGORY = f"{BASE},{KEPT_EVENTS}"

# Name and condition of each class.
CLASSES = {
    "visit_1s_3s": "visit_length BETWEEN 1 AND 3",
    "visit_4s_6s": "visit_length BETWEEN 4 AND 6",
    "visit_7s_9s": "visit_length BETWEEN 7 AND 9",
    "visit_10s_30s": "visit_length BETWEEN 10 AND 30",
    "visit_30s_60s": "visit_length > 30 AND visit_length <= 60",
    "visit_1m_3m": "visit_length > 60 AND visit_length <= 180",
    "visit_3m_10m": "visit_length > 180 AND visit_length <= 600",
    "visit_10m_30m": "visit_length > 600 AND visit_length <= 1800",
    "visit_30m": "visit_length > 1800",
    "step_1_3": "step_length BETWEEN 1 AND 3",
    "step_4_6": "step_length BETWEEN 4 AND 6",
    "step_7_9": "step_length BETWEEN 7 AND 9",
    "step_10_30": "step_length BETWEEN 10 AND 30",
    "step_30_60": "step_length > 30 AND step_length <= 60",
    "step_60": "step_length > 60",
}
BUCKETS_SQL = "SELECT 'session_count' AS bucket, count(*) AS n FROM kept" + "".join(
    f" UNION ALL SELECT '{name}', count(*) FILTER ({rule}) FROM kept" for name, rule in CLASSES.items()
)
RATIOS_SQL = "SELECT greatest(count(*), 1) AS session_count" + "".join(
    f", ((200 * count(*) FILTER ({rule}) + greatest(count(*), 1)) // (2 * greatest(count(*), 1))) / 100.0"
    f" AS {name.replace('visit_', 'visit_length_').replace('step_', 'step_length_')}_ratio"
    for name, rule in CLASSES.items()
) + " FROM kept"

SPLITS = """
pairs AS (
  SELECT page_id AS a, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, page_id) AS b
  FROM act),
flow(pos, a, b) AS (VALUES (1, 1, 2), (2, 2, 3), (3, 3, 4), (4, 4, 5), (5, 5, 6), (6, 6, 7)),
split_counts AS (
  SELECT pos, CAST(flow.a AS VARCHAR) || '_' || CAST(flow.b AS VARCHAR) AS split, count(pairs.a) AS n
  FROM flow LEFT JOIN pairs ON pairs.a = flow.a AND pairs.b = flow.b GROUP BY ALL),
rates AS (
  SELECT pos, split, n,
    coalesce(lag(n) OVER (ORDER BY pos), (SELECT count(*) FROM act WHERE page_id = 1)) AS prev
  FROM split_counts)"""

CLICKS = """
clicks AS (SELECT city_id, click_product_id FROM act WHERE click_product_id <> -1),
area_counts AS (
  SELECT area, click_product_id, count(*) AS click_count,
    string_agg(DISTINCT CAST(city_id AS VARCHAR) || ':' || city_name, ','
      ORDER BY CAST(city_id AS VARCHAR) || ':' || city_name) AS city_infos
  FROM clicks JOIN cities USING (city_id) GROUP BY area, click_product_id),
area_info AS (
  SELECT area, city_infos, click_product_id, click_count, product_name,
    CASE WHEN json_extract_string(extend_info, '$.product_status') = '0' THEN 'Self' ELSE 'Third Party' END AS product_status
  FROM area_counts JOIN products ON click_product_id = product_id)"""

REGION = f"{VISIT},{PRODUCTS},{CITIES},{CLICKS}"

AREA_TOP = """
area_top AS (
  SELECT area, CASE WHEN area IN ('华北', '华东') THEN 'A_Level' WHEN area IN ('华中', '华南') THEN 'B_Level'
      WHEN area IN ('西南', '西北') THEN 'C_Level' ELSE 'D_Level' END AS area_level,
    click_product_id, city_infos, click_count, product_name, product_status
  FROM area_info
  QUALIFY row_number() OVER (PARTITION BY area ORDER BY click_count DESC, click_product_id) <= 3)"""

SAMPLE = """
hourly AS (
  SELECT CAST(start_ts AS DATE) AS d, hour(start_ts) AS h, count(*) AS n FROM kept GROUP BY ALL),
quotas AS (
  SELECT d, h, least(n, n * (3000 // (SELECT count(DISTINCT d) FROM hourly)) // CAST(sum(n) OVER (PARTITION BY d) AS BIGINT)) AS quota
  FROM hourly),
picked AS (
  SELECT k.*, row_number() OVER (PARTITION BY CAST(start_ts AS DATE), hour(start_ts)
      ORDER BY md5(session_id || '|0'), session_id) AS pick
  FROM kept k),
sampled AS (
  SELECT picked.* FROM picked JOIN quotas ON CAST(start_ts AS DATE) = d AND hour(start_ts) = h
  WHERE pick <= quota)"""

TOP_SESSIONS = """
top_sess AS (
  SELECT category_id, session_id, CAST(sum(c) AS BIGINT) AS click_count
  FROM touch WHERE c = 1 AND category_id IN (SELECT category_id FROM top_cats)
  GROUP BY category_id, session_id
  QUALIFY row_number() OVER (PARTITION BY category_id ORDER BY sum(c) DESC, session_id) <= 10)"""

WORDS = """
lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
words AS (
  SELECT unnest(CASE WHEN length(line) > 0 AND length(replace(line, ' ', '')) = 0 THEN []
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word FROM lines)"""

AD_LOG = """
ad_log AS (
  SELECT epoch_us(ts) // 1000 AS ts_ms, CAST(event_id % 10 AS VARCHAR) AS province,
    CAST(event_id % 10 AS VARCHAR) AS city, user_id AS userid, event_id % 5 AS adid,
    strftime(ts, '%Y%m%d') AS date
  FROM events)"""

# Ten days arrive at a time. A user's clicks count up to and including the first arrival after
# which one ad of one day passed the threshold.
AD_FEEDBACK = f"""{AD_LOG},
arrival AS (SELECT date, (row_number() OVER (ORDER BY date) - 1) // 10 AS batch FROM (SELECT DISTINCT date FROM ad_log)),
user_day AS (SELECT date, userid, adid, count(*) AS n FROM ad_log GROUP BY ALL),
listed AS (
  SELECT userid, min(batch) AS since FROM user_day JOIN arrival USING (date) WHERE n > 2 GROUP BY userid),
allowed AS (
  SELECT ad_log.*, listed.userid IS NOT NULL AS is_listed
  FROM ad_log JOIN arrival USING (date) LEFT JOIN listed USING (userid)
  WHERE since IS NULL OR batch <= since)"""

FULL_FILTER = """age BETWEEN 20 AND 50 AND professional IN ('BUILDING', 'MACHINERY')
          AND sex = 'male' AND list_has_any(kws, ['kw1', 'kw2', 'kw3'])
          AND city IN (SELECT 'city' || CAST(i AS VARCHAR) FROM range(20) r(i))
          AND list_has_any(cats, range(60))"""

def _report_values() -> str:
    """All six reports, value by value; rows are numbered by their values as text."""
    ratios = [f"{n.replace('visit_', 'visit_length_').replace('step_', 'step_length_')}_ratio" for n in CLASSES]
    reports = {
        "session_aggr_stat": (f"({RATIOS_SQL})", {n: n for n in ("session_count", *ratios)}),
        "session_random_extract": ("sampled", {
            "sessionid": "session_id", "startTime": "start_time", "searchKeywords": "search_keywords",
            "clickCategoryIds": "click_category_ids"}),
        "top10_category": ("top_cats", {"categoryid": "category_id", "clickCount": "click_count",
                                        "orderCount": "order_count", "payCount": "pay_count"}),
        "top10_session": ("top_sess", {"categoryid": "category_id", "sessionid": "session_id",
                                       "clickCount": "click_count"}),
        "area_top3_product": ("area_top", {
            "area": "area", "areaLevel": "area_level", "productid": "click_product_id",
            "cityInfos": "city_infos", "clickCount": "click_count", "productName": "product_name",
            "productStatus": "product_status"}),
        "page_convert_rate": ("""(SELECT string_agg(split || '=' || coalesce(CAST(CAST(n AS DOUBLE)
            / nullif(prev, 0) AS VARCHAR), 'null'), '|' ORDER BY pos) AS rate FROM rates)""", {"convertRate": "rate"}),
    }
    parts = []
    for name, (rows, columns) in reports.items():
        text = [f"CAST({value} AS VARCHAR)" for value in columns.values()]
        order = ", ".join(f"{value} NULLS FIRST" for value in text)
        parts.append(f"""SELECT '{name}' AS report, taskid, CAST(place AS INT) AS row,
          unnest([{", ".join(f"'{c}'" for c in columns)}]) AS column, unnest([{", ".join(text)}]) AS value
          FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM {rows}),
            (VALUES ('run-1'), ('run-2')) t(taskid)""")
    ctes = ",".join((CATEGORY, SAMPLE, TOP_SESSIONS, PRODUCTS, CITIES, CLICKS, AREA_TOP, SPLITS))
    return f"WITH {ctes} " + " UNION ALL ".join(parts)


SESSION_COLUMNS = (
    "session_id, user_id, visit_length, step_length, start_time, end_time, "
    "search_keywords, click_category_ids"
)

ORACLE: dict[str, str] = {
    "action_scan": f"""WITH {VISIT}
        SELECT * REPLACE (strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time,
          strftime(date, '%Y-%m-%d') AS date) FROM act""",
    "session_aggregate": f"WITH {VISIT},{SESSIONS} SELECT {SESSION_COLUMNS} FROM sess_text",
    "session_values": f"""WITH {VISIT}
        SELECT DISTINCT session_id, 'keyword' AS kind, search_keyword AS value FROM visit
        WHERE search_keyword <> ''
        UNION ALL SELECT DISTINCT session_id, 'category', CAST(click_category_id AS VARCHAR) FROM visit
        WHERE click_category_id <> -1""",
    "session_full": f"WITH {BASE} SELECT {SESSION_COLUMNS}, age, professional, city, sex FROM full_sess",
    "session_filter": f"""WITH {BASE}
        SELECT {SESSION_COLUMNS}, age, professional, city, sex FROM full_sess WHERE {FULL_FILTER}""",
    "session_actions": f"""WITH {BASE}
        SELECT session_id, page_id, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time,
          search_keyword
        FROM act WHERE session_id IN (SELECT session_id FROM full_sess WHERE {FULL_FILTER})""",
    "session_log_filter": f"""WITH {BASE}
        SELECT {SESSION_COLUMNS}, age, professional, city, sex FROM full_sess WHERE {FULL_FILTER}""",
    "session_log_actions": f"""WITH {BASE}
        SELECT session_id, page_id, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time,
          search_keyword
        FROM act WHERE session_id IN (SELECT session_id FROM full_sess WHERE {FULL_FILTER})""",
    "session_buckets": f"WITH {BASE} {BUCKETS_SQL}",
    "session_ratio": f"WITH {BASE} {RATIOS_SQL}",
    "sessions_per_hour": f"""WITH {BASE},{SAMPLE}
        SELECT strftime(d, '%Y-%m-%d') || '_' || lpad(CAST(h AS VARCHAR), 2, '0') AS date_hour, n,
          CAST(sum(n) OVER (PARTITION BY d) AS BIGINT) AS day_n FROM hourly""",
    "session_sample": f"""WITH {BASE},{SAMPLE}
        SELECT session_id AS "sessionid", start_time AS "startTime", search_keywords AS "searchKeywords",
          click_category_ids AS "clickCategoryIds" FROM sampled""",
    "active_categories": f"WITH {CATEGORY} SELECT DISTINCT category_id FROM touch",
    "category_click_counts": f"""WITH {CATEGORY}
        SELECT category_id, count(*) AS click_count FROM touch WHERE c = 1 GROUP BY category_id""",
    "category_order_counts": f"""WITH {CATEGORY}
        SELECT category_id, count(*) AS order_count FROM touch WHERE o = 1 GROUP BY category_id""",
    "category_pay_counts": f"""WITH {CATEGORY}
        SELECT category_id, count(*) AS pay_count FROM touch WHERE p = 1 GROUP BY category_id""",
    "category_full_counts": f"WITH {CATEGORY} SELECT * FROM cat_counts",
    "top10_categories": f"WITH {CATEGORY} SELECT * FROM top_cats",
    "top10_sessions": f"WITH {CATEGORY},{TOP_SESSIONS} SELECT * FROM top_sess",
    "page_split_counts": f"WITH {VISIT},{SPLITS} SELECT split, n FROM split_counts WHERE n > 0",
    "page_convert_rate": f"""WITH {VISIT},{SPLITS}
        SELECT pos, split, n, prev, CAST(n AS DOUBLE) / nullif(prev, 0) AS rate FROM rates""",
    "page_convert_rate_text": f"""WITH {VISIT},{SPLITS}
        SELECT string_agg(split || '=' || coalesce(CAST(CAST(n AS DOUBLE) / nullif(prev, 0) AS VARCHAR), 'null'),
          '|' ORDER BY pos) AS convert_rate FROM rates""",
    "city_product_clicks": f"WITH {REGION} SELECT * FROM clicks",
    "area_product_clicks": f"""WITH {REGION}
        SELECT city_id, city_name, area, click_product_id FROM clicks JOIN cities USING (city_id)""",
    "area_product_clicks_left": f"""WITH {REGION}
        SELECT city_id, city_name, area, click_product_id
        FROM clicks LEFT JOIN (SELECT * FROM cities WHERE area <> '东北') USING (city_id)""",
    "area_product_counts": f"WITH {REGION} SELECT * FROM area_counts",
    "area_product_info": f"WITH {REGION} SELECT * FROM area_info",
    "area_top3_products": f"WITH {REGION},{AREA_TOP} SELECT * FROM area_top",
    "product_status": f"""WITH {PRODUCTS}
        SELECT product_id, json_extract_string(extend_info, '$.product_status') AS status_code,
          CASE WHEN json_extract_string(extend_info, '$.product_status') = '0' THEN 'Self'
            ELSE 'Third Party' END AS product_status FROM products""",
    "json_field_sql": f"""WITH {PRODUCTS}
        SELECT json_extract_string(extend_info, '$.product_status') AS status_code, count(*) AS n
        FROM products GROUP BY 1""",
    "relative_dates": f"WITH {USERS} SELECT user_id, true AS is_today, CAST(1 AS INT) AS days_between FROM users",
    "partition_tag": "SELECT DISTINCT l_suppkey, true AS in_one, true AS in_range FROM lineitem",
    "concat_long_string": f"""WITH {USERS}
        SELECT user_id, CAST(user_id AS VARCHAR) || ':' || city AS number_first,
          city || '=' || CAST(user_id AS VARCHAR) AS text_first FROM users""",
    "group_avg": f"WITH {USERS} SELECT city, avg(age) AS avg_age FROM users GROUP BY city",
    "udaf_avg": f"WITH {VISIT} SELECT city_id, avg(page_id) AS avg_page FROM visit GROUP BY city_id",
    "global_avg": f"WITH {VISIT} SELECT avg(page_id) AS avg_page FROM visit",
    "char_explode": """
        SELECT lang, col1, count(*) AS n
        FROM (SELECT lang, unnest(regexp_extract_all(text, '(?s).')) AS col1 FROM documents)
        GROUP BY lang, col1""",
    "udtf_chars": f"""WITH {USERS}
        SELECT user_id, unnest(regexp_extract_all(city, '(?s).')) AS col1 FROM users""",
    "explode_delimited": f"""WITH {VISIT}
        SELECT session_id, page_id, unnest(string_split(order_category_ids, ',')) AS category
        FROM visit WHERE order_category_ids IS NOT NULL""",
    "date_functions": f"""WITH {VISIT},{ALL_SESSIONS}
        SELECT session_id, start_time AS time, strftime(start_ts, '%Y-%m-%d') AS date,
          strftime(start_ts, '%Y%m%d%H%M') AS minute, strftime(start_ts, '%Y%m%d') AS date_key,
          strftime(start_ts, '%Y-%m-%d') AS key_date, strftime(start_ts, '%Y-%m-%d_%H') AS date_hour,
          visit_length AS seconds, start_ts < end_ts AS starts_before_end,
          start_ts > end_ts AS starts_after_end, strftime(start_ts, '%M') AS minute_of_hour
        FROM sess_text""",
    "kv_string_fields": f"""WITH {VISIT},{ALL_SESSIONS}
        SELECT session_id,
          concat('sessionid=', session_id, '|searchKeywords=', search_keywords,
            '|clickCategoryIds=', click_category_ids, '|stepLength=', step_length) AS record,
          search_keywords AS keywords, click_category_ids IS NULL AS no_category,
          concat('sessionid=', session_id, '|searchKeywords=', search_keywords,
            '|clickCategoryIds=', click_category_ids, '|stepLength=0') AS reset,
          concat('sessionid=', session_id, '|searchKeywords=', search_keywords,
            '|clickCategoryIds=', click_category_ids, '|stepLength=', step_length) AS unchanged,
          search_keywords AS trimmed
        FROM sess_text""",
    "map_join": """
        SELECT c_nationkey, c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "word_count": f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word",
    "word_split": f"""WITH {VISIT}
        SELECT CAST(len(string_split(order_category_ids, ',')) AS INT) AS pieces, count(*) AS lines
        FROM visit WHERE order_category_ids IS NOT NULL GROUP BY 1""",
    "grouped_rows": f"""WITH {VISIT},
        rows AS (
          SELECT session_id, page_id, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS moment, city_id,
            count(*) AS copies FROM visit GROUP BY ALL),
        dealt AS (
          SELECT *, CAST('0x' || substr(md5(page_id || '|' || moment || '|' || city_id), 1, 8) AS BIGINT)
            % 4 AS part
          FROM rows)
        SELECT session_id, part, CAST(sum(copies) AS BIGINT) AS n,
          string_agg(page_id || '@' || moment || '@' || city_id || '@' || copies, ';'
            ORDER BY page_id, moment, city_id, copies) AS content
        FROM dealt GROUP BY session_id, part""",
    "grouped_row_places": f"""WITH {VISIT},
        entries AS (SELECT city_id, session_id, page_id, count(*) AS copies FROM visit GROUP BY ALL)
        SELECT city_id, CAST(sum(copies) AS BIGINT) AS n, count(*) AS entries,
          CASE WHEN count(*) > 500 THEN CAST(ceil(count(*) / 500) AS BIGINT) ELSE 1 END AS parts,
          CAST(sum(page_id * copies) AS BIGINT) AS pages
        FROM entries GROUP BY city_id""",
    "behavior_ingest": """
        WITH rows AS (
          SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS item_id,
            CAST(event_id % 100 AS VARCHAR) AS category_id, event_type AS behavior,
            strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp FROM events)
        SELECT *, substr(md5(concat_ws(',', user_id, item_id, category_id, behavior, timestamp)), 1, 10)
          || '_' || timestamp AS row_key FROM rows""",
    "people_csv": f"WITH {USERS} SELECT city AS addr, avg(age) AS avg_age FROM users GROUP BY city",
    "json_ingest": "SELECT c_name AS name, c_custkey * 10 AS salary FROM customer",
    "text_lines": f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word",
    "rows_to_df": f"""WITH {VISIT}
        SELECT page_id, page_id + 1 AS plus_one, page_id * 2 AS doubled, count(*) AS n,
          CASE page_id % 2 WHEN 0 THEN 'even' ELSE 'odd' END AS page_kind
        FROM visit GROUP BY page_id""",
    "time_parse": f"""WITH {VISIT}
        SELECT session_id, page_id, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time FROM visit""",
    "custom_partition": """
        SELECT o_orderstatus, CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS INT)
          AS key_partition, count(*) AS n FROM orders GROUP BY ALL""",
    "keyed_text": """
        SELECT '(' || o_orderstatus || ',' || CAST(o_orderkey AS VARCHAR) || ')' AS value,
          CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS INT) AS key_partition
        FROM orders""",
    "report_append": f"""WITH {CATEGORY},{SAMPLE},{TOP_SESSIONS},{PRODUCTS},{CITIES},{CLICKS},{AREA_TOP},
        sizes AS (
          SELECT 'session_aggr_stat' AS report, CAST(1 AS BIGINT) AS n
          UNION ALL SELECT 'session_random_extract', (SELECT count(*) FROM sampled)
          UNION ALL SELECT 'top10_category', (SELECT count(*) FROM top_cats)
          UNION ALL SELECT 'top10_session', (SELECT count(*) FROM top_sess)
          UNION ALL SELECT 'area_top3_product', (SELECT count(*) FROM area_top)
          UNION ALL SELECT 'page_convert_rate', 1)
        SELECT report, taskid, n FROM sizes, (VALUES ('run-1'), ('run-2')) t(taskid)""",
    "report_values": _report_values(),
    "table_append": f"""WITH {USERS}
        SELECT professional, 2 * count(*) AS n, count(DISTINCT user_id) AS users
        FROM users GROUP BY professional""",
    "ad_log_parse": f"WITH {AD_LOG} SELECT * FROM ad_log",
    "ad_user_click_counts": f"""WITH {AD_LOG}
        SELECT date, userid, adid, count(*) AS click_count FROM ad_log GROUP BY ALL""",
    "ad_blacklist": f"WITH {AD_FEEDBACK} SELECT userid FROM listed",
    "ad_blacklist_stream": f"""WITH {AD_FEEDBACK}
        SELECT userid, is_listed AS listed, count(*) AS clicks FROM allowed GROUP BY ALL""",
    "ad_place_counts_stream": f"""WITH {AD_FEEDBACK}
        SELECT date, province, city, adid, count(*) AS click_count FROM allowed GROUP BY ALL""",
    "ad_running_counts": f"""WITH {AD_LOG}
        SELECT date, province, city, adid, count(*) AS click_count FROM ad_log GROUP BY ALL""",
}
