"""Spark session settings, the shared folder used to cut lineage, and jobs side by side."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "wardflow", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC and adaptive execution on.

    Shuffle width, memory and the checkpoint folder stay with the cluster's own
    settings unless they are passed here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SCRATCH: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``.

    Only a local master may go without it: there the driver and the tasks share
    one disk, so a scratch folder is safe. On a cluster the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = tempfile.mkdtemp(prefix="wardflow-")
    return _SCRATCH[app]


#: Bytes of a method of the code that Spark makes for a stage; the JVM compiles no larger ones.
METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Stages whose code the JVM would not compile, as that of a message's text, run in smaller parts."""
    before = spark.conf.get(METHOD_BYTES, None)
    spark.conf.set(METHOD_BYTES, "8000")
    try:
        yield
    finally:
        spark.conf.unset(METHOD_BYTES) if before is None else spark.conf.set(METHOD_BYTES, before)


#: Calls of ``at_once`` that run side by side. Their tasks share the cores, and so the memory, of one job.
JOBS = 4


def at_once(spark: SparkSession, calls: dict[str, Callable[[], object]], after: dict[str, list[str]] | None = None) -> dict:
    """Results of calls that start Spark jobs, run side by side in threads that take on this thread's job group.

    While the driver plans or commits one job, tasks of the others run. ``after`` names the calls that a
    call waits for, which must stand before it; where one of those fails, the call is left out. The first
    failure is raised when all calls have ended.
    """
    started: dict[str, Future] = {}

    def run(call: Callable[[], object], before: list[Future]) -> object:
        for other in before:
            other.result()
        return call()

    with ThreadPoolExecutor(JOBS) as pool:
        for name, call in calls.items():
            before = [started[n] for n in (after or {}).get(name, ()) if n in started]
            # Made anew for each call, as the properties that it hands on are the call's own from then on.
            started[name] = pool.submit(run, inheritable_thread_target(spark)(call), before)
    return {name: done.result() for name, done in started.items()}
