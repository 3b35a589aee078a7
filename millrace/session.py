"""Session profile, the shared work folder and scratch databases."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Set on the builder: Spark refuses to change most of these on a live session.
BASE_PROFILE = {
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.scheduler.mode": "FAIR",
    "spark.sql.orc.filterPushdown": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
DYNAMIC_PARTITION_PROFILE = {
    "hive.exec.dynamic.partition": "true",
    "hive.exec.dynamic.partition.mode": "nonstrict",
}

_local_dirs: list[tempfile.TemporaryDirectory] = []
_open: list[Workspace] = []


def build_session(
    name: str,
    *,
    dynamic_partitions: bool = False,
    hive: bool = False,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for a job started on its own; library code takes the caller's session."""
    profile = dict(BASE_PROFILE)
    if dynamic_partitions:
        profile.update(DYNAMIC_PARTITION_PROFILE)
    profile.update(extra or {})
    builder = SparkSession.builder.appName(name)
    for key, value in profile.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for stages and round tables.

    It is what the cluster names in ``spark.checkpoint.dir``. Only a local-mode
    session without that setting gets a temporary folder, removed at exit.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_dirs:
        _local_dirs.append(
            tempfile.TemporaryDirectory(prefix="millrace-", ignore_cleanup_errors=True)
        )
    return _local_dirs[0].name


class Workspace:
    """A uniquely named database whose location lies in the shared folder.

    Tables and plain files of one run live under it; ``drop`` removes them all.
    ``folder`` puts it elsewhere, for results that shall outlive the checkpoint
    folder's clean-up; it must be one that all executors share.
    """

    def __init__(self, spark: SparkSession, label: str, folder: str | None = None):
        self.spark = spark
        self.database = f"millrace_{label}_{uuid.uuid4().hex[:12]}"
        self.location = f"{(folder or shared_dir(spark)).rstrip('/')}/{self.database}"
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{self.location}'")
        _open.append(self)

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def path(self, name: str) -> str:
        return f"{self.location}/files/{name}"

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")
        _open[:] = [other for other in _open if other is not self]

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc) -> None:
        self.drop()


def drop_workspaces() -> None:
    """Drop every workspace of this process, once no result reads them any more."""
    for workspace in list(_open):
        workspace.drop()
