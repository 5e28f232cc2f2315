"""Probes: how many rows and nulls pass a step, counted while a job's own actions run and kept in a stored table.

A probe is an observation inside a plan, so it costs no pass of its own. In batch jobs a probe is read when the write it sits in has
ended; in streams a listener hands over what each micro-batch observed. Both end up as rows of one table:
run, step, batch (null outside streams), rows, nulls (column -> count).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from isochron.operators.shape import quoted
from isochron.sources.tables import write_table

SCHEMA = "run string, step string, batch bigint, rows bigint, nulls map<string, bigint>"
ROWS, NULLS = "rows", "nulls:"


def _metrics(not_null: Sequence[str]) -> list:
    return [F.count(F.lit(1)).alias(ROWS), *[F.count_if(F.col(quoted(c)).isNull()).alias(NULLS + c) for c in not_null]]


class _Listener(StreamingQueryListener):
    """Keeps the observed metrics of every micro-batch."""

    def __init__(self, probes: Probes):
        self.probes = probes

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        for name, found in progress.get("observedMetrics", {}).items():
            if name.startswith(self.probes.prefix):
                self.probes.record(name.removeprefix(self.probes.prefix), found, progress["batchId"])

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass


class Probes:
    """The probes of one run. Numbers only come to the driver, one row for each step and micro-batch."""

    def __init__(self, spark: SparkSession, run: str):
        self.spark, self.run, self.prefix = spark, run, f"probe:{run}:"
        self.waiting: list[tuple[str, Observation]] = []
        self.found: dict[tuple[str, int | None], dict[str, int]] = {}

    def record(self, step: str, metrics: dict[str, int], batch: int | None = None) -> None:
        """A repeated micro-batch replaces what its first try counted."""
        self.found[step, batch] = {name: int(value) for name, value in metrics.items()}

    def watch(self, df: DataFrame, step: str, *not_null: str) -> DataFrame:
        """The same rows, counted when the next action runs; nulls are counted in the columns named. In a stream: in each micro-batch."""
        if df.isStreaming:
            return df.observe(self.prefix + step, *_metrics(not_null))
        observation = Observation(self.prefix + step)
        self.waiting.append((step, observation))
        return df.observe(observation, *_metrics(not_null))

    def write(self, df: DataFrame, path: str, step: str, *not_null: str, sink=write_table) -> DataFrame:
        """Write a table through a probe and give it back as stored."""
        sink(self.watch(df, step, *not_null), path)
        self.collect()
        return self.spark.read.schema(df.schema).parquet(path) if sink is write_table else df

    def collect(self) -> None:
        """Take over the numbers of probes whose action has ended. Call it after the action that the probes sit in."""
        for step, observation in self.waiting:
            self.record(step, observation.get)
        self.waiting.clear()

    @contextmanager
    def listening(self) -> Iterator[None]:
        """Take over what micro-batches observe while streams run inside."""
        listener = _Listener(self)
        self.spark.streams.addListener(listener)
        try:
            yield
        finally:
            self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()  # progress arrives behind the stream
            self.spark.streams.removeListener(listener)

    def table(self) -> DataFrame:
        rows = []
        for (step, batch), metrics in sorted(self.found.items(), key=lambda item: (item[0][0], item[0][1] or 0)):
            nulls = {name.removeprefix(NULLS): value for name, value in metrics.items() if name.startswith(NULLS)}
            rows.append((self.run, step, batch, metrics.get(ROWS, 0), nulls))
        return self.spark.createDataFrame(rows, SCHEMA).coalesce(1)

    def store(self, path: str) -> None:
        """Write the run's rows to a folder of its own below `path`; repeating a run replaces them."""
        self.table().drop("run").write.mode("overwrite").parquet(f"{path}/run={self.run}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The probes of all runs."""
    return spark.read.schema(SCHEMA).parquet(path).select("run", "step", "batch", "rows", "nulls")
