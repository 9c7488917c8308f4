"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

SETTINGS = {
    # Feed timestamps carry no zone and mean UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Landing files are small GZIP files, which cannot be split. A low open cost packs many
    # of them into one scan task, so a map-only ingest writes few, larger Parquet files.
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.files.openCostInBytes": "512k",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with `SETTINGS`, which ``settings`` may override (dots as ``__``).

    Leave ``master`` unset under spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder in ``spark.checkpoint.dir``.

    Only a local session may fall back to the machine's temporary folder: on a cluster the
    executors and a restarted driver would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/tidemark-{label}-{uuid4().hex[:12]}"


@contextmanager
def sql_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Run a block under other SQL settings, then put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
