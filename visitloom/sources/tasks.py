"""Tasks and their JSON parameters."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the JSON parameters of a task.
TASK_PARAMETERS = (
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


def find_task(tasks: DataFrame, task_id: int) -> DataFrame:
    return tasks.where(F.col("task_id") == F.lit(task_id))


def task_parameter(param: Column, name: str) -> Column:
    """First element of the JSON array under `name`; NULL if missing or empty."""
    fields = F.from_json(param, "map<string,array<string>>")
    return F.get(F.element_at(fields, F.lit(name)), F.lit(0))


def with_task_parameters(tasks: DataFrame) -> DataFrame:
    """Tasks with one column per parameter."""
    return tasks.select("task_id", *(task_parameter(F.col("task_param"), n).alias(n) for n in TASK_PARAMETERS))


@dataclass(frozen=True)
class Criteria:
    """Which dates, users and behaviour a task asks for. None or () asks for nothing."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()

    @classmethod
    def from_json(cls, text: str) -> Criteria:
        """From a task's JSON: single values are the first array element, lists are
        all elements, each of which may be a comma list itself."""
        given = json.loads(text)

        def items(name: str) -> tuple[str, ...]:
            parts = (part for element in given.get(name) or () for part in str(element).split(","))
            return tuple(part for part in parts if part)

        def first(name: str) -> str | None:
            values = given.get(name) or [None]
            return str(values[0]) if values[0] not in (None, "") else None

        def number(name: str) -> int | None:
            return None if first(name) is None else int(first(name))

        return cls(
            first("startDate"),
            first("endDate"),
            number("startAge"),
            number("endAge"),
            items("professionals"),
            items("cities"),
            first("sex"),
            items("searchKeywords"),
            tuple(int(i) for i in items("clickCategoryIds")),
        )


def load_criteria(tasks: DataFrame, task_id: int) -> Criteria:
    """The criteria of a task; only its parameter text comes to the driver."""
    row = find_task(tasks, task_id).select("task_param").first()
    if row is None:
        raise LookupError(f"no task {task_id}")
    return Criteria.from_json(row["task_param"] or "{}")
