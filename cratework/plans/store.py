"""Versioned Parquet tables: a version is written beside the current one and published by one atomic rename."""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from cratework.plans.control import exclusive


LAYOUT = 1  # C11: raised with any change of table formats


class Store:
    """A folder of tables. ``<table>/v=<id>/`` hold versions, ``CURRENT`` maps tables to versions.

    All tables that one step writes become visible together, when CURRENT is replaced (steps of other runs in between
    lose nothing); a failed step leaves nothing but unreferenced files. The folder must be on a file system with atomic rename that all executors share.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        os.makedirs(path, exist_ok=True)
        layout = os.path.join(path, "LAYOUT")
        if not os.path.exists(layout):
            with open(layout, "w") as f:
                f.write(str(LAYOUT))
        with open(layout) as f:
            if (found := f.read().strip()) != str(LAYOUT):
                raise RuntimeError(f"{path} has layout {found}, this engine reads layout {LAYOUT}")

    def _pointer(self) -> str:
        return os.path.join(self.path, "CURRENT")

    def versions(self) -> dict[str, str]:
        try:
            with open(self._pointer()) as f:
                return json.load(f)
        except FileNotFoundError:
            return {}

    def read(self, table: str) -> DataFrame | None:
        """The current version, or None for a table that was never written."""
        version = self.versions().get(table)
        return None if version is None else self.spark.read.parquet(os.path.join(self.path, table, f"v={version}"))

    def stage(self, table: str, df: DataFrame) -> str:
        """Write a new version without publishing it."""
        version = uuid.uuid4().hex
        df.write.parquet(os.path.join(self.path, table, f"v={version}"))
        return version

    def staged(self, table: str, version: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.path, table, f"v={version}"))

    def discard(self, table: str, version: str) -> None:
        """Remove a staged version that was never published."""
        shutil.rmtree(os.path.join(self.path, table, f"v={version}"), ignore_errors=True)

    def publish(self, staged: dict[str, str], fence=None) -> None:
        """Make staged versions current, all at once. ``fence`` is called just before and may raise to stop it."""
        with exclusive(self._pointer()):
            merged = self.versions() | staged
            fd, temporary = tempfile.mkstemp(dir=self.path)
            try:
                with os.fdopen(fd, "w") as f:
                    json.dump(merged, f, sort_keys=True)
                    f.flush()
                    os.fsync(f.fileno())
                if fence is not None:
                    fence()
                os.replace(temporary, self._pointer())
            except BaseException:
                os.unlink(temporary)
                raise
