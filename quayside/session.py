"""Session defaults and the shared scratch location.

The library never builds its own session in library code paths; callers pass
one.  ``build_session`` exists for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every pipeline relies on.  AQE re-plans joins from runtime sizes
# (broadcast conversion, partition coalescing) and splits skewed shuffle
# partitions, which is what keeps a hot key from landing in one task.
PIPELINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def anonymous_object_store_conf() -> dict[str, str]:
    """Read public object-store buckets without credentials (s3a)."""
    return {
        "spark.hadoop.fs.s3a.aws.credentials.provider":
            "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider",
    }


def build_session(
    master: str = "local[*]",
    app_name: str = "quayside",
    shuffle_partitions: int = 8,
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the pipeline defaults."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(PIPELINE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # Loopback only: a local session must not listen on a public address.
        conf.setdefault("spark.driver.host", "127.0.0.1")
        conf.setdefault("spark.driver.bindAddress", "127.0.0.1")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only when nothing is configured (local runs and
    tests) a private folder is created and registered, so that
    ``DataFrame.checkpoint()`` and scratch tables work the same way there.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir()
    if not configured:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            configured = None
    if not configured:
        configured = tempfile.mkdtemp(prefix="quayside-ckpt-")
        sc.setCheckpointDir(configured)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint root for one run's tables."""
    root = checkpoint_root(spark)
    leaf = "/".join(p.strip("/") for p in parts if p)
    run = uuid.uuid4().hex[:12]
    return f"{root}/quayside-scratch/{leaf}/{run}" if leaf else f"{root}/quayside-scratch/{run}"


def local_dir_of(path: str) -> str | None:
    """Filesystem path for a ``file:`` or plain local URI, else None."""
    if path.startswith("file:"):
        return path[len("file:"):]
    if "://" in path:
        return None
    return path if os.path.isabs(path) else None


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quayside`` importable in Python workers, as ``--py-files`` would.

    Functions that run inside tasks (``mapInPandas``) are pickled by reference
    to their module, so every executor must be able to import the package,
    whatever the driver's working directory.  A zip of the package is added
    once per application with ``addPyFile``; Spark hands it to the executors.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package_dir = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(package_dir)
    archive = os.path.join(tempfile.mkdtemp(prefix="quayside-pyfiles-"), "quayside.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(package_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def run_concurrently(
    spark: SparkSession,
    jobs: Mapping[str, Callable[[], object]],
    workers: int = 4,
) -> dict:
    """Run independent Spark actions from a few driver threads.

    Returns name -> result, or name -> the exception the action raised, so one
    failing action does not stop the others.  Threads inherit the session's
    job tags and local properties.
    """
    def guarded(fn):
        def run():
            try:
                return fn()
            except Exception as exc:  # noqa: BLE001 - reported per job
                return exc
        return inheritable_thread_target(spark)(run)

    if not jobs:
        return {}
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(jobs)))) as pool:
        futures = {name: pool.submit(guarded(fn)) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}
