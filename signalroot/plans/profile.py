"""What each phase of a pass cost: figures of its Spark stages, read from the application's status store."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

PHASES = (
    "phase string, seconds double, jobs long, stages long, tasks long, task_seconds double, cpu_seconds double, input_bytes long, shuffle_read_bytes long, shuffle_write_bytes long, "
    "memory_spilled_bytes long, disk_spilled_bytes long, peak_execution_bytes long, peak_heap_bytes long, peak_python_bytes long"
)
STAGES = "phase string, stage long, name string, tasks long, task_seconds double, peak_execution_bytes long, disk_spilled_bytes long, shuffle_write_bytes long"
_SUMS = {"input_bytes": "inputBytes", "shuffle_read_bytes": "shuffleReadBytes", "shuffle_write_bytes": "shuffleWriteBytes", "memory_spilled_bytes": "memoryBytesSpilled", "disk_spilled_bytes": "diskBytesSpilled"}


class Profile:
    """`with profile.phase(name)` counts the jobs that are started inside; a name may come again."""

    def __init__(self, spark: SparkSession):
        self.spark, self.seconds = spark, {}

    @contextmanager
    def phase(self, name: str) -> Iterator[None]:
        sc, keys = self.spark.sparkContext, ("spark.jobGroup.id", "spark.job.description")
        before = {k: sc.getLocalProperty(k) for k in keys}
        sc.setJobGroup(self._group(name), name)
        began = time.monotonic()
        try:
            yield
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + time.monotonic() - began
            for k, v in before.items():
                sc.setLocalProperty(k, v)

    def _group(self, name: str) -> str:
        return f"profile-{id(self)}-{name}"

    def _stages(self) -> list[tuple[str, int, object]]:
        """(phase, job, stage figures) of all stages that ran; a stage that a later job skips belongs to the first."""
        jsc = self.spark.sparkContext._jsc.sc()
        jsc.listenerBus().waitUntilEmpty(60_000)
        store, groups = jsc.statusStore(), {self._group(n): n for n in self.seconds}
        found, seen = [], set()
        doubles = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.double, 0)
        each = lambda seq: (seq.apply(k) for k in range(seq.size()))
        for job in sorted(each(store.jobsList(None)), key=lambda j: j.jobId()):
            name = groups.get(job.jobGroup().get()) if job.jobGroup().isDefined() else None
            if name is None:
                continue
            for stage in each(job.stageIds()):
                if stage not in seen:
                    attempts = [s for s in each(store.stageData(stage, False, None, False, doubles)) if s.numCompleteTasks()]
                    seen |= {stage} if attempts else set()
                    found += [(name, job.jobId(), s) for s in attempts]
        return found

    def report(self) -> DataFrame:
        """PHASES, in the order in which phases began."""
        stages, rows = self._stages(), []
        for name, seconds in self.seconds.items():
            mine = [s for n, _, s in stages if n == name]
            peak = lambda metric: max((s.peakExecutorMetrics().get().getMetricValue(metric) for s in mine if s.peakExecutorMetrics().isDefined()), default=0)  # noqa: B023, E731
            rows.append((
                name, round(seconds, 3), len({j for n, j, _ in stages if n == name}), len(mine), sum(s.numCompleteTasks() for s in mine), sum(s.executorRunTime() for s in mine) / 1e3,
                sum(s.executorCpuTime() for s in mine) / 1e9, *(sum(getattr(s, f)() for s in mine) for f in _SUMS.values()),
                max((s.peakExecutionMemory() for s in mine), default=0), peak("JVMHeapMemory"), peak("ProcessTreePythonRSSMemory"),
            ))
        return self.spark.createDataFrame(rows, PHASES)

    def top_stages(self, n: int = 8) -> DataFrame:
        """The n stages that held most execution memory: a report, limited by design."""
        rows = [(name, s.stageId(), s.name(), s.numCompleteTasks(), s.executorRunTime() / 1e3, s.peakExecutionMemory(), s.diskBytesSpilled(), s.shuffleWriteBytes()) for name, _, s in self._stages()]
        return self.spark.createDataFrame(sorted(rows, key=lambda r: (-r[5], r[1]))[:n], STAGES)
