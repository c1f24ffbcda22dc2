"""Plain SQL that gives each registered query's result from the same tables."""

from __future__ import annotations

from visitloom.schemas import STEP_BUCKETS, VISIT_BUCKETS

# The action and user tables over the given tables.
_ACTIONS = """
base AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id % 100 AS product,
         strftime(ts, '%Y-%m-%d') AS d
  FROM events),
actions AS (
  SELECT d AS date, user_id, 'u' || user_id || '_' || replace(d, '-', '') AS session_id, event_id % 10 AS page_id,
         CASE event_type WHEN 'view' THEN 'search' WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'order'
              WHEN 'signup' THEN 'pay' ELSE 'other' END AS action,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k END AS click_category_id,
         CASE WHEN event_type = 'click' THEN product END AS click_product_id,
         CASE WHEN event_type = 'purchase' THEN k || ',' || (k + 37) % 100 END AS order_category_ids,
         CASE WHEN event_type = 'purchase' THEN product || ',' || (product + 1) % 100 END AS order_product_ids,
         CASE WHEN event_type = 'signup' THEN k || ',' || (k + 61) % 100 END AS pay_category_ids,
         CASE WHEN event_type = 'signup' THEN product || ',' || (product + 1) % 100 END AS pay_product_ids
  FROM base),
days AS (SELECT * FROM actions WHERE date BETWEEN '2024-01-07' AND '2024-01-29')"""

_USERS = """
users AS (
  SELECT c_custkey AS user_id, 'user' || c_custkey AS username, c_name AS name,
         CAST(c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS professional, n_name AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_SUMMARY = """
summary AS (
  SELECT session_id, min(user_id) AS user_id, min(action_time) AS start_time, max(action_time) AS end_time,
         CAST(epoch(max(CAST(action_time AS TIMESTAMP))) - epoch(min(CAST(action_time AS TIMESTAMP))) AS BIGINT)
           AS visit_length,
         CAST(count(*) AS BIGINT) AS step_length
  FROM days GROUP BY session_id)"""

# The registered queries of sessions are over all actions, those of the jobs over the days asked for.
_ALL_SUMMARY = _SUMMARY.replace("FROM days", "FROM actions")

_WITH_USERS = """
with_users AS (
  SELECT user_id, session_id, start_time, end_time, visit_length, step_length, age, professional, city, sex
  FROM summary JOIN users USING (user_id)),
selected AS (SELECT * FROM with_users WHERE age BETWEEN 20 AND 30)"""


def _ids(column: str, frame: str) -> str:
    return (
        f"SELECT session_id, CAST(unnest(string_split({column}, ',')) AS BIGINT) AS category_id "
        f"FROM {frame} WHERE {column} IS NOT NULL"
    )


def _category_counts(frame: str) -> str:
    return f"""
clicked AS (SELECT session_id, click_category_id AS category_id FROM {frame} WHERE click_category_id IS NOT NULL),
ordered AS ({_ids("order_category_ids", frame)}),
paid AS ({_ids("pay_category_ids", frame)}),
counts AS (
  SELECT category_id, CAST(sum(c) AS BIGINT) AS click_count, CAST(sum(o) AS BIGINT) AS order_count,
         CAST(sum(p) AS BIGINT) AS pay_count
  FROM (SELECT category_id, 1 AS c, 0 AS o, 0 AS p FROM clicked
        UNION ALL SELECT category_id, 0, 1, 0 FROM ordered
        UNION ALL SELECT category_id, 0, 0, 1 FROM paid)
  GROUP BY category_id)"""


_TOP = """
top AS (SELECT * FROM counts ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10)"""

_TOP_SESSIONS = """
click_counts AS (
  SELECT click_category_id AS category_id, session_id, CAST(count(*) AS BIGINT) AS click_count
  FROM days WHERE click_category_id IN (SELECT category_id FROM top) GROUP BY ALL)
SELECT category_id, session_id, click_count FROM click_counts
QUALIFY row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) <= 10"""

_ALL_TOP_SESSIONS = _TOP_SESSIONS.replace("FROM days", "FROM actions")


def _sample(frame: str) -> str:
    return f"""
started AS (
  SELECT session_id, start_time[1:10] AS date, start_time[12:13] AS hour FROM {frame}),
hours AS (SELECT date, hour, CAST(count(*) AS BIGINT) AS sessions FROM started GROUP BY ALL),
totals AS (
  SELECT *, CAST(sum(sessions) OVER (PARTITION BY date) AS BIGINT) AS day_total,
         CAST((SELECT count(DISTINCT date) FROM hours) AS BIGINT) AS days
  FROM hours),
quota AS (
  SELECT *, 1000 // days AS day_quota,
         least(sessions, CAST(floor(CAST(sessions AS DOUBLE) / day_total * (1000 // days)) AS BIGINT)) AS sample_size
  FROM totals),
places AS (
  SELECT *, row_number() OVER (PARTITION BY date, hour ORDER BY md5('42' || session_id), session_id) AS place
  FROM started),
sample AS (
  SELECT date, hour, session_id FROM places JOIN quota USING (date, hour) WHERE place <= sample_size)"""


def _list(column: str) -> str:
    return (
        f"coalesce(array_to_string(list_sort(list(DISTINCT {column}) FILTER (WHERE {column} IS NOT NULL)), ','), '')"
    )


_DETAIL_COLUMNS = (
    "user_id, session_id, page_id, action_time, search_keyword, click_category_id, click_product_id, "
    "order_category_ids, order_product_ids, pay_category_ids, pay_product_ids"
)


def _records(frame: str) -> str:
    return f"""
lists AS (
  SELECT session_id, {_list("search_keyword")} AS search_keywords, {_list("click_category_id")} AS click_category_ids
  FROM {frame} GROUP BY session_id)"""


def _statistics(frame: str) -> str:
    def condition(column: str, low: int | None, high: int | None) -> str:
        if low is None:
            return f"{column} <= {high}"
        return f"{column} >= {low}" if high is None else f"{column} BETWEEN {low} AND {high}"

    buckets = [(n, condition("visit_length", lo, hi)) for n, lo, hi in VISIT_BUCKETS]
    buckets += [(n, condition("step_length", lo, hi)) for n, lo, hi in STEP_BUCKETS]
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE {c}) AS BIGINT) AS {n}" for n, c in buckets)
    return f"""
stats AS (SELECT CAST(count(*) AS BIGINT) AS session_count, {counts} FROM {frame})"""


_RATIOS = ", ".join(
    f"CAST((2000 * {n} + session_count) // (2 * nullif(session_count, 0)) AS DOUBLE) / 1000 AS {n}"
    for n, _, _ in VISIT_BUCKETS + STEP_BUCKETS
)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


_LISTED = ("order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids")
_WIDE = """
wide AS (SELECT session_id, {lists} FROM actions GROUP BY session_id)""".format(
    lists=", ".join(
        f"{_list(column)} AS {name}"
        for column, name in (
            ("page_id", "page_ids"),
            ("action", "actions"),
            ("search_keyword", "search_keywords"),
            ("click_category_id", "click_category_ids"),
            ("click_product_id", "click_product_ids"),
        )
    )
)
_SPLIT = "".join(
    f""",
split_{column} AS (
  SELECT session_id, {_list("category_id")} AS {column} FROM ({_ids(column, "actions")}) GROUP BY session_id)"""
    for column in _LISTED
)
_SPLIT_COLUMNS = ", ".join(f"coalesce(split_{c}.{c}, '') AS {c}" for c in _LISTED)
_SPLIT_JOINS = " ".join(f"LEFT JOIN split_{c} USING (session_id)" for c in _LISTED)

_MIXED = "coalesce(search_keyword, action_time)"
_PARSED = f"try_strptime({_MIXED}, '%Y-%m-%d %H:%M:%S')"
_FIXED = "TIMESTAMP '2024-01-15 12:00:00'"

_COORDINATES = """
coordinates AS (
  SELECT c_custkey, (c_custkey * 7) % 210 - 105 AS lat, (c_custkey * 13) % 410 - 205 AS lon,
         ((c_custkey * 7) % 210 - 105) || ',' || ((c_custkey * 13) % 410 - 205) AS coordinates
  FROM customer)"""
_BAD = "(abs(lat) > 90 OR abs(lon) > 180)"

_TASKS = """
tasks AS (
  SELECT c_custkey AS task_id, c_name AS task_name, '2024-01-01 00:00:00' AS create_time,
         CAST(NULL AS VARCHAR) AS start_time, CAST(NULL AS VARCHAR) AS finish_time, 'session' AS task_type,
         'new' AS task_status,
         '{"startDate":["2024-01-07"],"endDate":["2024-01-29"],"startAge":[' || (c_custkey % 60) ||
         '],"professionals":["' || c_mktsegment || '","MACHINERY"],"cities":[]' ||
         CASE WHEN c_custkey % 2 = 1 THEN ',"sex":["female"]' ELSE '' END || '}' AS task_param
  FROM customer)"""

_RECORDS = f"""
{_records("actions")},
records AS (
  SELECT session_id, search_keywords, click_category_ids, visit_length, step_length, start_time,
         'clickCategoryIds=' || click_category_ids || '|visitLength=' || visit_length || '|stepLength='
         || step_length || '|startTime=' || start_time AS tail
  FROM summary JOIN lists USING (session_id))"""

_SESSION_SQL = f"""
SELECT summary.*, search_keywords, click_category_ids FROM summary JOIN lists USING (session_id)"""

_PEOPLE = "SELECT c_name AS name, {age} AS age FROM customer"

ORACLE: dict[str, str] = {
    "action_log": _with(_ACTIONS) + " SELECT * FROM actions",
    "user_info": _with(_USERS) + " SELECT * FROM users",
    "json_lines": """SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        CASE WHEN event_type = 'click' THEN value END AS value FROM events""",
    "people_lines": _PEOPLE.format(age="CAST(c_custkey % 60 AS INTEGER)"),
    "text_columns": _PEOPLE.format(age="CAST(c_custkey % 60 AS VARCHAR)"),
    "local_collection": """SELECT meaning, CAST(count(*) AS BIGINT) AS rows FROM orders
        JOIN (VALUES ('F', 'filled'), ('O', 'open'), ('P', 'partial')) m(s, meaning) ON o_orderstatus = s
        GROUP BY meaning""",
    "typed_people": _PEOPLE.format(
        age="CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey % 60 AS INTEGER) END"
    ),
    "view_sql": _with(_ACTIONS) + " SELECT action, CAST(count(*) AS BIGINT) AS actions FROM actions GROUP BY action",
    "global_view_sql": _with(_USERS) + " SELECT city, CAST(count(*) AS BIGINT) AS users FROM users GROUP BY city",
    "appended_tables": " UNION ALL ".join(
        "SELECT * FROM ("
        + _with(
            _ACTIONS, f"part AS (SELECT * FROM actions WHERE date {dates})", _category_counts("part"), _TOP
        )
        + " SELECT * FROM top)"
        for dates in ("<= '2024-01-18'", ">= '2024-01-19'")
    ),
    "task_by_id": _with(_TASKS) + " SELECT * FROM tasks WHERE task_id = 7",
    "actions_in_dates": _with(_ACTIONS) + " SELECT * FROM days",
    "task_parameters": _with(_TASKS)
    + " SELECT task_id, "
    + ", ".join(
        f"json_extract_string(task_param, '$.{n}[0]') AS {n}"
        for n in (
            "startDate",
            "endDate",
            "startAge",
            "endAge",
            "professionals",
            "cities",
            "sex",
            "searchKeywords",
            "clickCategoryIds",
        )
    )
    + " FROM tasks",
    "number_in_range": _with(_ACTIONS)
    + """ SELECT session_id, action_time, click_category_id,
        coalesce(click_category_id BETWEEN 20 AND 50, false) AS in_range, true AS one_sided FROM actions""",
    "any_of_list": _with(_ACTIONS)
    + """ SELECT session_id, action_time,
        coalesce(list_has_any(string_split(order_category_ids, ','), ['5', '42', '79']), false) AS list_matches,
        coalesce(search_keyword IN ('kw1', 'kw4'), false) AS value_matches, true AS nothing_asked FROM actions""",
    "equal_value": _with(_ACTIONS)
    + """ SELECT session_id, action_time, coalesce(search_keyword = 'kw3', false) AS matches,
        true AS nothing_asked FROM actions""",
    "selected_sessions": _with(_ACTIONS, _USERS, _SUMMARY, _WITH_USERS)
    + """ SELECT * FROM with_users WHERE age BETWEEN 10 AND 50 AND sex = 'male'
        AND professional IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
        AND city IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8', 'NATION_13', 'NATION_19', 'NATION_21')
        AND session_id IN (SELECT session_id FROM days WHERE search_keyword IN ('kw1', 'kw3', 'kw5', 'kw7', 'kw9'))
        AND session_id IN (SELECT session_id FROM days WHERE click_category_id IN
          (1,5,10,12,17,20,23,25,30,34,38,40,45,50,51,56,60,62,67,70,73,75,80,84,89,90,95,97))""",
    "order_actions": _with(_ACTIONS) + " SELECT * FROM actions WHERE order_category_ids IS NOT NULL",
    "projected_users": _with(_USERS) + " SELECT name, city, sex FROM users",
    "arithmetic": _with(_ACTIONS)
    + """ SELECT session_id, action_time, click_category_id + 1 AS plus_one, page_id * 2 AS doubled FROM actions""",
    "older_users": _with(_USERS) + " SELECT user_id, age FROM users WHERE age > 21",
    "teenagers": _with(_USERS) + " SELECT name, age FROM users WHERE age BETWEEN 13 AND 19",
    "even_categories": _with(_ACTIONS)
    + " SELECT session_id, action_time, click_category_id FROM actions WHERE click_category_id % 2 = 0",
    "name_labels": _with(_USERS) + " SELECT 'Name: ' || name AS value FROM users WHERE age BETWEEN 13 AND 19",
    "document_words": """SELECT doc_id, unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents
        WHERE rtrim(text, ' ') <> '' OR text = ''""",
    "invalid_coordinates": _with(_COORDINATES) + f" SELECT c_custkey, coordinates FROM coordinates WHERE {_BAD}",
    "valid_coordinates": _with(_COORDINATES) + f" SELECT c_custkey, coordinates FROM coordinates WHERE NOT {_BAD}",
    "sessions_with_users": _with(_ACTIONS, _USERS, _ALL_SUMMARY, _WITH_USERS) + " SELECT * FROM with_users",
    "selected_actions": _with(_ACTIONS, _USERS, _SUMMARY, _WITH_USERS)
    + " SELECT * FROM days WHERE session_id IN (SELECT session_id FROM selected)",
    "sampled_details": _with(_ACTIONS, _ALL_SUMMARY, _sample("summary"))
    + f" SELECT {_DETAIL_COLUMNS} FROM actions WHERE session_id IN (SELECT session_id FROM sample)",
    "joined_category_counts": _with(_ACTIONS, _category_counts("actions")) + " SELECT * FROM counts",
    "category_counts": _with(_ACTIONS, _category_counts("actions")) + " SELECT * FROM counts",
    "clicks_in_top_categories": _with(_ACTIONS, _category_counts("actions"), _TOP)
    + """ SELECT click_category_id AS category_id, session_id, CAST(count(*) AS BIGINT) AS click_count
        FROM actions WHERE click_category_id IN (SELECT category_id FROM top) GROUP BY ALL""",
    "customers_with_orders": """SELECT c_custkey AS key, c_name, o_orderkey, o_totalprice
        FROM customer JOIN orders ON c_custkey = o_custkey""",
    "customers_cogrouped_with_orders": """
        WITH placed AS (
          SELECT c_custkey + 10 AS key, c_name AS l, NULL AS r,
            (row_number() OVER (PARTITION BY c_custkey ORDER BY c_name) - 1) // 3 AS page FROM customer
          UNION ALL SELECT o_custkey, NULL, o_orderkey,
            (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 3 FROM orders)
        SELECT key, page, coalesce(string_agg(l, ',' ORDER BY l), '') AS left_values,
          coalesce(string_agg(CAST(r AS VARCHAR), ',' ORDER BY r), '') AS right_values
        FROM placed GROUP BY key, page""",
    "customers_joined_with_themselves": """SELECT coalesce(a.c_custkey, b.c_custkey + 10) AS key, a.c_acctbal AS left_value,
        b.c_acctbal AS right_value FROM customer a FULL JOIN customer b ON a.c_custkey = b.c_custkey + 10""",
    "customers_full_joined_with_orders": """SELECT coalesce(c_custkey + 10, o_custkey) AS key, c_name, o_orderkey
        FROM customer FULL JOIN orders ON c_custkey + 10 = o_custkey""",
    "session_records": _with(_ACTIONS, _ALL_SUMMARY, _records("actions")) + _SESSION_SQL,
    "session_summary": _with(_ACTIONS, _ALL_SUMMARY) + " SELECT * FROM summary",
    "wide_session_records": _with(_ACTIONS, _ALL_SUMMARY, _WIDE)
    + _SPLIT
    + f""" SELECT summary.*, page_ids, actions, search_keywords, click_category_ids, click_product_ids,
        {_SPLIT_COLUMNS} FROM summary JOIN wide USING (session_id) {_SPLIT_JOINS}""",
    "session_values": _with(_ACTIONS)
    + " UNION ".join(
        [
            f" SELECT session_id, '{name}' AS list, CAST({column} AS VARCHAR) AS value FROM actions WHERE {column} IS NOT NULL"
            for column, name in (
                ("page_id", "page_ids"),
                ("action", "actions"),
                ("search_keyword", "search_keywords"),
                ("click_category_id", "click_category_ids"),
                ("click_product_id", "click_product_ids"),
            )
        ]
        + [
            f" SELECT session_id, '{c}', unnest(string_split({c}, ',')) FROM actions WHERE {c} IS NOT NULL" for c in _LISTED
        ]
    ),
    "session_counts": _with(_ACTIONS, _ALL_SUMMARY, _statistics("summary")) + " SELECT * FROM stats",
    "selected_session_counts": _with(_ACTIONS, _USERS, _SUMMARY, _WITH_USERS, _statistics("selected"))
    + " SELECT * FROM stats",
    "session_statistics": _with(_ACTIONS, _SUMMARY, _statistics("summary"))
    + f" SELECT CAST(1 AS BIGINT) AS task_id, session_count, {_RATIOS} FROM stats",
    "click_counts": _with(_ACTIONS)
    + """ SELECT click_category_id AS category_id, CAST(count(*) AS BIGINT) AS click_count
        FROM actions WHERE click_category_id IS NOT NULL GROUP BY 1""",
    "order_counts": _with(_ACTIONS)
    + f" SELECT category_id, CAST(count(*) AS BIGINT) AS order_count FROM ({_ids('order_category_ids', 'actions')}) GROUP BY 1",
    "pay_counts": _with(_ACTIONS)
    + f" SELECT category_id, CAST(count(*) AS BIGINT) AS pay_count FROM ({_ids('pay_category_ids', 'actions')}) GROUP BY 1",
    "category_universe": _with(_ACTIONS)
    + f""" SELECT click_category_id AS category_id FROM actions WHERE click_category_id IS NOT NULL
        UNION SELECT category_id FROM ({_ids('order_category_ids', 'actions')})
        UNION SELECT category_id FROM ({_ids('pay_category_ids', 'actions')})""",
    "sessions_per_hour": _with(_ACTIONS, _ALL_SUMMARY, _sample("summary")) + " SELECT * FROM hours",
    "hourly_quota": _with(_ACTIONS, _ALL_SUMMARY, _sample("summary")) + " SELECT * FROM quota",
    "session_category_clicks": _with(_ACTIONS)
    + """ SELECT session_id, click_category_id AS category_id, CAST(count(*) AS BIGINT) AS click_count
        FROM actions WHERE click_category_id IS NOT NULL GROUP BY ALL""",
    "rows_per_keyword": _with(_ACTIONS)
    + " SELECT search_keyword, CAST(count(*) AS BIGINT) AS rows FROM actions GROUP BY search_keyword",
    "orders_per_customer": """SELECT o_custkey, page, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS values
        FROM (SELECT o_custkey, o_orderkey,
                (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4 AS page FROM orders)
        GROUP BY o_custkey, page""",
    "quantity_per_supplier": "SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY l_suppkey",
    "total_quantity": "SELECT sum(l_quantity) AS total FROM lineitem",
    "lineitem_count": "SELECT CAST(count(*) AS BIGINT) AS rows FROM lineitem",
    "orders_per_priority": """SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS rows FROM orders
        GROUP BY o_orderpriority""",
    "customer_order_map": """SELECT (row_number() OVER (ORDER BY o_custkey) - 1) // 50 AS page, o_custkey, rows
        FROM (SELECT o_custkey, CAST(count(*) AS BIGINT) AS rows FROM orders GROUP BY o_custkey)""",
    "listed_coordinates": _with(_COORDINATES)
    + f""" SELECT page, string_agg(coordinates, ',' ORDER BY coordinates) AS values
        FROM (SELECT coordinates, (row_number() OVER (ORDER BY coordinates) - 1) // 20 AS page
              FROM coordinates WHERE {_BAD}) GROUP BY page""",
    "keyed_sum": """SELECT key, CAST(sum(number) AS BIGINT) AS total FROM (
        SELECT upper(event_type) AS key, CAST(json_extract_string(props, '$.k') AS BIGINT) AS number FROM events
        UNION ALL SELECT 'VIEW', 0 UNION ALL SELECT 'REFUND', 0) GROUP BY key""",
    "joined_names": """SELECT page, string_agg(c_name || '_', '' ORDER BY c_name) AS text
        FROM (SELECT c_name, (row_number() OVER (ORDER BY c_name) - 1) // 20 AS page FROM customer) GROUP BY page""",
    "top_categories": _with(_ACTIONS, _category_counts("actions"), _TOP) + " SELECT * FROM top",
    "top_categories_of_selected": _with(
        _ACTIONS,
        _USERS,
        _SUMMARY,
        _WITH_USERS,
        "chosen AS (SELECT * FROM days WHERE session_id IN (SELECT session_id FROM selected))",
        _category_counts("chosen"),
        _TOP,
    )
    + " SELECT * FROM top",
    "ranked_categories": _with(_ACTIONS, _category_counts("days"))
    + """ SELECT *, row_number() OVER (ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id) AS position
        FROM counts""",
    "top_sessions": _with(_ACTIONS, _category_counts("actions"), _TOP, _ALL_TOP_SESSIONS),
    "sampled_sessions": _with(_ACTIONS, _ALL_SUMMARY, _sample("summary")) + " SELECT * FROM sample",
    "sampled_records": _with(_ACTIONS, _ALL_SUMMARY, _sample("summary"), _records("actions"))
    + """ SELECT session_id, start_time, search_keywords, click_category_ids
        FROM sample JOIN summary USING (session_id) JOIN lists USING (session_id)""",
    "orders_by_price": """SELECT o_orderkey, o_totalprice,
        row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS position FROM orders""",
    "orders_by_price_descending": """SELECT o_orderkey, o_totalprice,
        row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders""",
    "cheapest_orders": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 3",
    "some_actions": "SELECT CAST(3 AS BIGINT) AS rows, CAST(3 AS BIGINT) AS of_the_table",
    "distinct_pairs": _with(_ACTIONS) + " SELECT DISTINCT user_id, action FROM actions",
    "current_dates": _with(_ACTIONS)
    + """ SELECT DISTINCT session_id, 1 AS days_between, true AS now_is_today, 19 AS now_length, 10 AS today_length,
        true AS now_parses FROM actions""",
    "date_hours": _with(_ACTIONS)
    + " SELECT session_id, action_time, action_time[1:10] || '_' || action_time[12:13] AS date_hour FROM actions",
    "parsed_times": _with(_ACTIONS)
    + f""" SELECT session_id, {_MIXED} AS given, strftime({_PARSED}, '%Y-%m-%d %H:%M:%S') AS time,
        strftime({_PARSED}, '%Y-%m-%d') AS date FROM actions""",
    "before_and_after": _with(_ACTIONS)
    + f""" SELECT session_id, {_MIXED} AS given, coalesce({_PARSED} < {_FIXED}, false) AS before,
        coalesce({_PARSED} > {_FIXED}, false) AS after FROM actions""",
    "seconds_between": _with(_ACTIONS)
    + f""" SELECT session_id, {_MIXED} AS given,
        coalesce(CAST(epoch({_PARSED}) - epoch({_FIXED}) AS BIGINT), 0) AS seconds FROM actions""",
    "empty_keywords": _with(_ACTIONS)
    + """ SELECT session_id, action_time,
        coalesce(CASE WHEN page_id = 0 THEN '' ELSE search_keyword END, '') = '' AS is_empty,
        coalesce(CASE WHEN page_id = 0 THEN '' ELSE search_keyword END, '') <> '' AS is_not_empty FROM actions""",
    "trimmed_commas": _with(_ACTIONS)
    + """ SELECT session_id, action_time, order_category_ids || CASE WHEN page_id < 5 THEN ',' ELSE '' END AS trimmed
        FROM actions""",
    "two_digit_texts": _with(_ACTIONS)
    + """ SELECT session_id, action_time,
        CASE WHEN user_id BETWEEN 10 AND 99 THEN '' ELSE '0' END || user_id AS padded FROM actions""",
    "record_fields": _with(_ACTIONS, _ALL_SUMMARY, _RECORDS)
    + """ SELECT 'sessionId=' || session_id || '|searchKeywords=' || search_keywords || '|' || tail AS record,
        session_id AS session, nullif(search_keywords, '') AS keywords, CAST(step_length AS VARCHAR) AS steps,
        CAST(NULL AS VARCHAR) AS absent FROM records""",
    "changed_records": _with(_ACTIONS, _ALL_SUMMARY, _RECORDS)
    + " SELECT session_id, 'sessionId=' || session_id || '|searchKeywords=none|' || tail AS record FROM records",
    "rounded_values": """SELECT event_id, value, CAST(round(CAST(value AS DECIMAL(18, 6)), 1) AS DOUBLE) AS rounded
        FROM events""",
    "split_ids": _with(_ACTIONS)
    + """ SELECT session_id, action_time, CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT) AS category_id
        FROM actions WHERE pay_category_ids IS NOT NULL""",
    "documents_containing": "SELECT doc_id, contains(text, 'the') AS contains FROM documents",
    "job_session_aggr_stat": _with(_ACTIONS, _USERS, _SUMMARY, _WITH_USERS, _statistics("selected"))
    + f" SELECT CAST(1 AS BIGINT) AS task_id, session_count, {_RATIOS} FROM stats",
    "job_session_random_extract": _with(
        _ACTIONS, _USERS, _SUMMARY, _WITH_USERS, _sample("selected"), _records("days")
    )
    + """ SELECT session_id, start_time, search_keywords, click_category_ids
        FROM sample JOIN summary USING (session_id) JOIN lists USING (session_id)""",
    "job_session_detail": _with(_ACTIONS, _USERS, _SUMMARY, _WITH_USERS, _sample("selected"))
    + f" SELECT {_DETAIL_COLUMNS} FROM days WHERE session_id IN (SELECT session_id FROM sample)",
    "job_top10_category": _with(
        _ACTIONS,
        _USERS,
        _SUMMARY,
        _WITH_USERS,
        "chosen AS (SELECT * FROM days WHERE session_id IN (SELECT session_id FROM selected))",
        _category_counts("chosen"),
        _TOP,
    )
    + " SELECT * FROM top",
    "job_top10_category_session": _with(
        _ACTIONS,
        _USERS,
        _SUMMARY,
        _WITH_USERS,
        "chosen AS (SELECT * FROM days WHERE session_id IN (SELECT session_id FROM selected))",
        _category_counts("chosen"),
        _TOP,
        _TOP_SESSIONS,
    ),
}

_SHARES = f"session_count, {_RATIOS} FROM stats"
_ALL_STATISTICS = _with(_ACTIONS, _ALL_SUMMARY, _statistics("summary")) + f" SELECT CAST(1 AS BIGINT) AS task_id, {_SHARES}"

# The criteria of the many tasks, by customer.
_MANY_TASKS = """
asked AS (
  SELECT c_custkey AS task_id, c_custkey AS k,
         CASE WHEN k % 2 = 0 THEN '2024-01-' || lpad(CAST(1 + k % 20 AS VARCHAR), 2, '0') END AS first_day,
         CASE WHEN k % 3 <> 1 THEN '2024-01-' || lpad(CAST(10 + k % 21 AS VARCHAR), 2, '0') END AS last_day,
         CASE WHEN k % 3 = 0 THEN k % 40 END AS low, CASE WHEN k % 3 = 0 THEN k % 40 + 20 END AS high,
         CASE WHEN k % 4 = 1 THEN [c_mktsegment, 'MACHINERY'] END AS professionals,
         CASE WHEN k % 7 = 3 THEN ['NATION_' || k % 25, 'NATION_3'] END AS cities,
         CASE WHEN k % 5 = 2 THEN 'male' END AS wanted_sex,
         CASE WHEN k % 6 = 1 THEN ['kw' || k % 10, 'kw3'] END AS keywords,
         CASE WHEN k % 11 = 4 THEN [k % 100, (k + 7) % 100, (k + 50) % 100] END AS categories
  FROM customer),
seen AS (
  SELECT session_id, date, min(user_id) AS user_id, min(action_time) AS start_time, max(action_time) AS end_time,
         count(*) AS step_length, CAST(epoch(max(CAST(action_time AS TIMESTAMP))) - epoch(min(CAST(action_time AS TIMESTAMP))) AS BIGINT) AS visit_length,
         coalesce(list(DISTINCT search_keyword) FILTER (WHERE search_keyword IS NOT NULL), []) AS kws,
         coalesce(list(DISTINCT click_category_id) FILTER (WHERE click_category_id IS NOT NULL), []) AS cats
  FROM actions GROUP BY session_id, date),
met AS (
  SELECT task_id, visit_length, step_length
  FROM asked, seen JOIN users USING (user_id)
  WHERE (first_day IS NULL OR date >= first_day) AND (last_day IS NULL OR date <= last_day)
    AND (low IS NULL OR age BETWEEN low AND high) AND (professionals IS NULL OR list_contains(professionals, professional))
    AND (cities IS NULL OR list_contains(cities, city)) AND (wanted_sex IS NULL OR sex = wanted_sex)
    AND (keywords IS NULL OR list_has_any(kws, keywords)) AND (categories IS NULL OR list_has_any(cats, categories)))"""
_STATS_PER_TASK = _statistics("met").replace("stats AS (SELECT", "found AS (SELECT task_id,").rstrip()[:-1] + " GROUP BY task_id)"
_COUNTS = ["session_count", *(name for name, _, _ in VISIT_BUCKETS + STEP_BUCKETS)]
_STATS_PER_TASK += (
    ", stats AS (SELECT task_id, "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _COUNTS)
    + " FROM asked LEFT JOIN found USING (task_id))"
)

_ODD = """
lines AS (
  SELECT event_id AS n, event_type AS kind, '{"event_id": ' || event_id || ', "kind": "' || event_type || '"}' AS line
  FROM events)"""

ORACLE |= {
    "counts_in_passing": ORACLE["session_statistics"],
    "committed_statistics": ORACLE["job_session_aggr_stat"],
    "committed_top_sessions": f"SELECT *, CAST(1 AS BIGINT) AS task_id FROM ({ORACLE['job_top10_category_session']}) q",
    "task_states": """SELECT c_custkey AS task_id, CASE WHEN c_custkey = 1 THEN 'done' ELSE 'new' END AS task_status,
        CASE WHEN c_custkey = 1 THEN true END AS has_run FROM customer""",
    "task_statistics": _with(_ACTIONS, _USERS, _MANY_TASKS, _STATS_PER_TASK) + f" SELECT task_id, {_SHARES}",
    "summary_by_days": _with(_ACTIONS, _SUMMARY) + " SELECT * FROM summary",
    "statistics_by_days": _ALL_STATISTICS,
    "categories_by_days": ORACLE["category_counts"],
    "bucketed_summary": ORACLE["session_summary"],
    "bucketed_selected_actions": ORACLE["selected_actions"],
    "catalog_actions": ORACLE["actions_in_dates"],
    "inferred_columns": """SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
        CASE WHEN event_id % 50 <> 0 THEN event_type END AS kind,
        CASE WHEN event_id % 50 <> 0 AND event_type = 'click' THEN value END AS value FROM events""",
    "accepted_lines": "SELECT event_id, event_type AS kind FROM events WHERE event_id % 40 > 2",
    "rejected_lines": _with(_ODD)
    + """ SELECT CASE n % 40 WHEN 0 THEN '{' || line WHEN 1 THEN '[' || n || ']'
            ELSE '{"event_id": "' || n || ' th", "kind": "' || kind || '"}' END AS line,
        CASE n % 40 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'not an object' ELSE 'wrong type' END AS reason
        FROM lines WHERE n % 40 < 3""",
    "rejected_people": """SELECT * FROM (SELECT
        CASE c_custkey % 9 WHEN 0 THEN c_name WHEN 1 THEN c_name || ', unknown' WHEN 2 THEN c_name || ', 1, 2'
            WHEN 3 THEN ' , ' || c_custkey % 60 END AS line,
        CASE c_custkey % 9 WHEN 0 THEN 'too few values' WHEN 1 THEN 'no number' WHEN 2 THEN 'too many values'
            WHEN 3 THEN 'no name' END AS reason FROM customer) q WHERE reason IS NOT NULL""",
    "records_read_back": ORACLE["session_records"],
    "functions_in_sql": _with(_ACTIONS)
    + f""" SELECT session_id, action_time, action_time[1:10] || '_' || action_time[12:13] AS hour,
        coalesce(CAST(epoch({_PARSED}) - epoch({_FIXED}) AS BIGINT), 0) AS seconds,
        action_time < '2024-01-15 12:00:00' AS before, search_keyword IS NULL AS no_keyword, order_category_ids AS ids,
        '0' || page_id AS page, replace(order_product_ids, ',', '+') AS products, action AS kind,
        CASE WHEN user_id > 0 THEN CAST((2000 * page_id + user_id) // (2 * user_id) AS DOUBLE) / 1000 END AS share
        FROM actions""",
}
