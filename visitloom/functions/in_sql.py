"""The functions of times, texts and numbers under names of their own in SQL.

Each is an expression that Spark puts in place of the call, so it is optimised and pushed down as if written out.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from visitloom.functions.times import TIME_PATTERN

#: name: (parameters with types, result type, expression)
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "parsed_time": ("t STRING", "TIMESTAMP_NTZ", f"CASE WHEN t RLIKE r'{TIME_PATTERN}' THEN try_cast(t AS TIMESTAMP_NTZ) END"),
    "time_text": ("t TIMESTAMP_NTZ", "STRING", "substring(CAST(t AS STRING), 1, 19)"),
    "date_hour": (
        "t STRING",
        "STRING",
        "CASE WHEN instr(t, ' ') > 0 THEN "
        "concat(split_part(t, ' ', 1), '_', split_part(split_part(t, ' ', 2), ':', 1)) END",
    ),
    "is_before": ("a STRING, b STRING", "BOOLEAN", "coalesce(parsed_time(a) < parsed_time(b), false)"),
    "is_after": ("a STRING, b STRING", "BOOLEAN", "coalesce(parsed_time(a) > parsed_time(b), false)"),
    "seconds_apart": (
        "a STRING, b STRING", "BIGINT", "coalesce(timestampdiff(SECOND, parsed_time(b), parsed_time(a)), 0L)"
    ),
    "no_text": ("t STRING", "BOOLEAN", "coalesce(t, '') = ''"),
    "without_commas": ("t STRING", "STRING", r"regexp_replace(t, r'^,|,\z', '')"),
    "two_digits": ("t STRING", "STRING", "CASE WHEN length(t) = 2 THEN t ELSE concat('0', t) END"),
    "id_texts": ("t STRING", "ARRAY<STRING>", "filter(split(t, ','), x -> x != '')"),
    "id_list": (
        "t STRING", "ARRAY<BIGINT>", "array_compact(transform(id_texts(t), x -> try_cast(x AS BIGINT)))"
    ),
    "record_field": (
        "r STRING, field STRING",
        "STRING",
        r"split_part(get(filter(split(r, '[|]'), e -> e RLIKE r'^[^=]*=[^=]+=*\z' "
        "AND split_part(e, '=', 1) = field), 0), '=', 2)",
    ),
    "share_3": (
        "n BIGINT, total BIGINT", "DOUBLE", "CASE WHEN total > 0 THEN ((2000 * n + total) DIV (2 * total)) / 1000.0D END"
    ),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions known to the session, in place of temporary ones of the same name; their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
