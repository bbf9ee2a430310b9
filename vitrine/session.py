"""Session builder and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Row, SparkSession


PARALLEL_CHAINS = 12


def get_spark(app: str = "vitrine", master: str | None = None, **conf: str) -> SparkSession:
    """Build or reuse a session; on a cluster the submitted settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in `spark.checkpoint.dir`. Only a local master may fall
    back to a folder of its own, since executors elsewhere could not read it.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc._jsc.sc().getCheckpointDir()
    if configured:
        if current.isEmpty():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current.isDefined():
        return current.get().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="vitrine-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the work folder that nothing else uses."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and keeps iterative plans flat."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_counted(df: DataFrame, value: Column) -> tuple[DataFrame, int]:
    """`cut_lineage`, and an aggregate of the rows it wrote; 0 without rows.

    `observe` would take it on the way, but once a session has observed anything, its closures over fitted tree models no longer serialise.
    """
    out = cut_lineage(df)
    return out, one_row(out.agg(value.cast("long").alias("value")))["value"] or 0


def one_row(df: DataFrame) -> Row:
    """Fetch a global aggregate: exactly one row, so its size does not depend on the
    data. Its values then enter later plans as literals, which keeps those plans
    flat and lets filters on them reach the scan."""
    return df.first()


def met(df: DataFrame) -> DataFrame:
    """The side of a join that is dealt out, never broadcast: a relation with a text or array key takes a whole memory page of the
    driver however small it is, and a chain of joins holds one for each until the next collection of garbage."""
    return df.hint("merge")


def together(tasks: Sequence[Callable]) -> list:
    """Run independent driver calls side by side. Model fits and iterative operators
    are long chains of short jobs; several chains fill a cluster better than one."""
    with ThreadPoolExecutor(max_workers=max(1, min(len(tasks), PARALLEL_CHAINS))) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]
