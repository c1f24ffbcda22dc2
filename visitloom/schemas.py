"""Fixed table schemas. All columns are nullable."""

from pyspark.sql import types as T

_LONG, _INT, _DOUBLE, _TEXT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# Column names, order and types of the two input tables, the task
# table and the five result tables.
USER_VISIT_ACTION = _struct(
    ("date", _TEXT),
    ("user_id", _LONG),
    ("session_id", _TEXT),
    ("page_id", _LONG),
    ("action", _TEXT),
    ("action_time", _TEXT),
    ("search_keyword", _TEXT),
    ("click_category_id", _LONG),
    ("click_product_id", _LONG),
    ("order_category_ids", _TEXT),
    ("order_product_ids", _TEXT),
    ("pay_category_ids", _TEXT),
    ("pay_product_ids", _TEXT),
)

USER_INFO = _struct(
    ("user_id", _LONG),
    ("username", _TEXT),
    ("name", _TEXT),
    ("age", _INT),
    ("professional", _TEXT),
    ("city", _TEXT),
    ("sex", _TEXT),
)

TASK = _struct(
    ("task_id", _LONG),
    ("task_name", _TEXT),
    ("create_time", _TEXT),
    ("start_time", _TEXT),
    ("finish_time", _TEXT),
    ("task_type", _TEXT),
    ("task_status", _TEXT),
    ("task_param", _TEXT),
)

# Visit length in whole seconds, both ends included; None is open.
VISIT_BUCKETS = (
    ("visit_0s", None, 0),
    ("visit_1s_3s", 1, 3),
    ("visit_4s_6s", 4, 6),
    ("visit_7s_9s", 7, 9),
    ("visit_10s_30s", 10, 30),
    ("visit_30s_60s", 31, 60),
    ("visit_1m_3m", 61, 180),
    ("visit_3m_10m", 181, 600),
    ("visit_10m_30m", 601, 1800),
    ("visit_30m", 1801, None),
)

# Number of actions in a session, both ends included; None is open.
STEP_BUCKETS = (
    ("step_1_3", 1, 3),
    ("step_4_6", 4, 6),
    ("step_7_9", 7, 9),
    ("step_10_30", 10, 30),
    ("step_30_60", 31, 60),
    ("step_60", 61, None),
)

SESSION_AGGR_STAT = _struct(
    ("task_id", _LONG),
    ("session_count", _LONG),
    *((name, _DOUBLE) for name, _, _ in VISIT_BUCKETS + STEP_BUCKETS),
)

SESSION_RANDOM_EXTRACT = _struct(
    ("session_id", _TEXT),
    ("start_time", _TEXT),
    ("search_keywords", _TEXT),
    ("click_category_ids", _TEXT),
)

SESSION_DETAIL = _struct(
    ("user_id", _LONG),
    ("session_id", _TEXT),
    ("page_id", _LONG),
    ("action_time", _TEXT),
    ("search_keyword", _TEXT),
    ("click_category_id", _LONG),
    ("click_product_id", _LONG),
    ("order_category_ids", _TEXT),
    ("order_product_ids", _TEXT),
    ("pay_category_ids", _TEXT),
    ("pay_product_ids", _TEXT),
)

TOP10_CATEGORY = _struct(
    ("category_id", _LONG),
    ("click_count", _LONG),
    ("order_count", _LONG),
    ("pay_count", _LONG),
)

TOP10_CATEGORY_SESSION = _struct(
    ("category_id", _LONG),
    ("session_id", _TEXT),
    ("click_count", _LONG),
)

PERSON = _struct(("name", _TEXT), ("age", _INT))
