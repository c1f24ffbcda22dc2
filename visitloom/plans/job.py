"""The full job: select sessions, then build and store the five result tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.operators.categories import (
    category_counts,
    ranked_categories,
    ranking,
    top_categories,
    top_sessions,
)
from visitloom.operators.joins import rows_of
from visitloom.operators.observed import shares, store_with_counts
from visitloom.operators.positions import numbered
from visitloom.operators.predicates import date_range
from visitloom.operators.sampling import sample_sessions, sampled_details, sampled_records
from visitloom.operators.sessions import select_sessions, session_statistics, session_summary
from visitloom.session import through_storage
from visitloom.sources.sinks import TableSink
from visitloom.sources.tasks import Criteria


def statistics_job(actions: DataFrame, criteria: Criteria, task_id: int = 1) -> DataFrame:
    """Statistics of all sessions in the dates asked for."""
    days = date_range(actions, criteria.start_date, criteria.end_date)
    return session_statistics(session_summary(days), task_id)


def category_job(actions: DataFrame, criteria: Criteria) -> DataFrame:
    """The full ranking of the categories in the dates asked for, with its positions."""
    days = date_range(actions, criteria.start_date, criteria.end_date)
    return numbered(category_counts(days), *ranking())


@dataclass(frozen=True)
class JobOptions:
    task_id: int = 1
    sample_target: int = 100
    sample_seed: int = 42
    top_k: int = 10
    top_n_sessions: int = 10


class SessionJob:
    """The five result tables of one task.

    Categories are ranked by the actions of the selected sessions; top sessions
    count all actions in the dates. What several tables share (the selected
    sessions, the details, the top categories) is computed when first needed
    and stored in the scratch folder, so that it is computed once and outlives
    its executors. The actions are then scanned four times in all: for the
    sessions, the details, the top categories and their sessions.
    """

    def __init__(
        self, actions: DataFrame, users: DataFrame, criteria: Criteria, options: JobOptions = JobOptions()
    ):
        self.days = date_range(actions, criteria.start_date, criteria.end_date)
        self.users, self.criteria, self.options = users, criteria, options

    @cached_property
    def _counted_sessions(self) -> tuple[DataFrame, DataFrame]:
        return store_with_counts(select_sessions(self.days, self.users, self.criteria), "selected-sessions")

    @property
    def sessions(self) -> DataFrame:
        return self._counted_sessions[0]

    @cached_property
    def session_detail(self) -> DataFrame:
        sample = sample_sessions(self.sessions, self.options.sample_target, self.options.sample_seed)
        return through_storage(sampled_details(self.days, sample), "session-detail")

    @cached_property
    def top10_category(self) -> DataFrame:
        counts = category_counts(rows_of(self.days, self.sessions))
        return ranked_categories(through_storage(top_categories(counts, self.options.top_k), "top-categories"))

    @cached_property
    def top10_category_session(self) -> DataFrame:
        return top_sessions(self.days, self.top10_category, self.options.top_n_sessions)

    @cached_property
    def session_aggr_stat(self) -> DataFrame:
        """From counts taken while the sessions were stored."""
        return shares(self._counted_sessions[1], F.lit(self.options.task_id).cast("bigint").alias("task_id"))

    @cached_property
    def session_random_extract(self) -> DataFrame:
        return sampled_records(self.session_detail)

    def run(self, sink: TableSink) -> None:
        """Store all five tables under the task's id.

        What the task has stored before is replaced table by table, so a run that failed can be repeated.
        """
        tables = {
            "session_aggr_stat": self.session_aggr_stat.drop("task_id"),
            "session_random_extract": self.session_random_extract,
            "session_detail": self.session_detail,
            "top10_category": self.top10_category,
            "top10_category_session": self.top10_category_session,
        }
        for name, table in tables.items():
            sink.replace(table, name, self.options.task_id)
