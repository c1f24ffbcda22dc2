"""Result tables of a run that appear together or not at all.

Each attempt writes folders of its own, `location/<table>/task_id=<id>/attempt=<name>`. A manifest, written last and
put in its place by one rename, names them; readers take the latest manifest of a task. What an attempt has written
without a manifest is not read. Paths are those of any file system Spark knows.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = re.compile(r"(\d{8})\.json")

#: A row for each committed run: number counts the runs of a task from 1.
RUN_STATES = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("task_id", T.LongType()),
            ("number", T.LongType()),
            ("task_status", T.StringType()),
            ("start_time", T.StringType()),
            ("finish_time", T.StringType()),
            ("tables", T.ArrayType(T.StringType())),
        )
    ]
)


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


class _Files:
    """The few calls of the file system that manifests need."""

    def __init__(self, spark: SparkSession, location: str):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(location).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        path = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """A whole file under a new name; FileExistsError if another has been put there before."""
        folder, _, last = name.rpartition("/")
        draft = self.path(f"{folder}/.{last}-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        options = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        try:
            context.rename(self.fs.makeQualified(draft), self.fs.makeQualified(self.path(name)), options)
        except Exception as error:
            self.fs.delete(draft, False)
            if self.fs.exists(self.path(name)):
                raise FileExistsError(name) from error
            raise


@dataclass(frozen=True)
class Attempt:
    """One attempt of a task's run; `replace` has the form of TableSink's."""

    location: str
    task_id: int
    name: str
    start_time: str
    written: dict[str, str]

    def replace(self, df: DataFrame, table: str, task_id: int) -> None:
        """Write the rows of a table, once each attempt."""
        if task_id != self.task_id:
            raise ValueError(f"an attempt of task {self.task_id} holds no rows of task {task_id}")
        folder = f"{table}/task_id={task_id}/attempt={self.name}"
        df.write.mode("errorifexists").parquet(f"{self.location}/{folder}")
        self.written[table] = folder


@dataclass(frozen=True)
class RunStore:
    """Result tables under one location, a commit for each run of a task."""

    location: str

    @contextmanager
    def attempt(self, spark: SparkSession, task_id: int) -> Iterator[Attempt]:
        """Tables written inside are committed together when the block ends; an error leaves the last run's tables.

        Of two attempts at once the one that ends first is committed; the other fails with FileExistsError and can be repeated.
        """
        number = len(self._manifests(spark, task_id)) + 1
        attempt = Attempt(self.location, task_id, uuid.uuid4().hex, _now(), {})
        yield attempt
        state = {"start_time": attempt.start_time, "finish_time": _now(), "task_status": "done", "tables": attempt.written}
        _Files(spark, self.location).put(f"{self._folder(task_id)}/{number:08d}.json", json.dumps(state))

    def read(self, spark: SparkSession, table: str, schema: T.StructType, *task_ids: int) -> DataFrame:
        """Rows of a table in the latest run of each task (of all tasks, if none is named), with task_id.

        A task without a committed run, or whose run has not written this table, has no rows.
        """
        files, paths = _Files(spark, self.location), []
        for task_id in task_ids or self._tasks(files):
            manifests = self._manifests(spark, task_id)
            if manifests:
                state = json.loads(files.text(f"{self._folder(task_id)}/{manifests[-1]}"))
                paths += [f"{self.location}/{f}" for name, f in state["tables"].items() if name == table]
        with_task = T.StructType([*(f for f in schema.fields if f.name != "task_id"), T.StructField("task_id", T.LongType())])
        if not paths:
            return spark.createDataFrame([], with_task)
        reader = spark.read.schema(with_task).option("basePath", f"{self.location}/{table}")
        return reader.parquet(*paths).select(*with_task.names)

    def states(self, spark: SparkSession) -> DataFrame:
        """All committed runs: RUN_STATES."""
        files, rows = _Files(spark, self.location), []
        for task_id in self._tasks(files):
            for n, name in enumerate(self._manifests(spark, task_id), 1):
                state = json.loads(files.text(f"{self._folder(task_id)}/{name}"))
                times = state["task_status"], state["start_time"], state["finish_time"]
                rows.append((task_id, n, *times, sorted(state["tables"])))
        return spark.createDataFrame(rows, RUN_STATES)

    def with_states(self, tasks: DataFrame) -> DataFrame:
        """Tasks with status, start and finish of their latest run; those without a run stay as they are."""
        runs = self.states(tasks.sparkSession).groupBy("task_id").agg(
            F.max_by(F.struct("task_status", "start_time", "finish_time"), "number").alias("run")
        )
        joined = tasks.join(runs, "task_id", "left")
        kept = (F.coalesce(F.col(f"run.{c}"), F.col(c)).alias(c) if c in ("task_status", "start_time", "finish_time") else F.col(c) for c in tasks.columns)
        return joined.select(*kept)

    def unnamed(self, spark: SparkSession, task_id: int) -> list[str]:
        """Folders of the task that its latest run does not name: of earlier runs and of attempts that failed, or still go on."""
        files, manifests = _Files(spark, self.location), self._manifests(spark, task_id)
        state = json.loads(files.text(f"{self._folder(task_id)}/{manifests[-1]}")) if manifests else {"tables": {}}
        found = []
        for table in files.names(self.location):
            folder = f"{table}/task_id={task_id}"
            found += [f"{folder}/{name}" for name in files.names(f"{self.location}/{folder}") if name.startswith("attempt=")]
        return sorted(set(found) - set(state["tables"].values()))

    def _folder(self, task_id: int) -> str:
        return f"{self.location}/_runs/task_id={task_id}"

    def _tasks(self, files: _Files) -> list[int]:
        return sorted(int(name.partition("=")[2]) for name in files.names(f"{self.location}/_runs"))

    def _manifests(self, spark: SparkSession, task_id: int) -> list[str]:
        return [n for n in _Files(spark, self.location).names(self._folder(task_id)) if _MANIFEST.fullmatch(n)]
