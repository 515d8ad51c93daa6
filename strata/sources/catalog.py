"""Tables published by pointer: versioned folders and one catalog entry.

A version is written into a folder of its own and never changed.  Publishing
it is one change of the catalog entry's location, so nothing is renamed or
copied, whatever the file system: a reader that resolved the table before goes
on reading the version it saw, a later one reads the new version.  Earlier
versions stay until they are released.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strata.sources.paths import discard, exists, list_entries

VERSION = re.compile(r"v[0-9]{8}-[0-9a-f]{12}")


@dataclass(frozen=True)
class CatalogTable:
    """A table ``database.table`` whose versions lie under ``root/<table>``."""

    database: str
    table: str
    root: str

    @property
    def name(self) -> str:
        return f"`{self.database}`.`{self.table}`"

    @property
    def folder(self) -> str:
        return f"{self.root.rstrip('/')}/{self.table}"

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.databaseExists(self.database) and spark.catalog.tableExists(f"{self.database}.{self.table}")

    def location(self, spark: SparkSession) -> str | None:
        """The folder of the published version, None if there is none."""
        if not self.exists(spark):
            return None
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Location'").collect()
        return rows[0]["data_type"]

    def versions(self, spark: SparkSession) -> list[str]:
        """Names of the versions that lie in the folder, oldest first."""
        if not exists(spark, self.folder):
            return []
        return [n for n in list_entries(spark, self.folder) if VERSION.fullmatch(n)]

    def new_version(self, spark: SparkSession) -> str:
        """A folder for the next version; its number only orders versions, names never meet."""
        have = self.versions(spark)
        number = 1 + (int(have[-1][1:9]) if have else 0)
        return f"{self.folder}/v{number:08d}-{uuid.uuid4().hex[:12]}"

    def point_to(self, spark: SparkSession, version: str) -> None:
        """Publish a completely written version.

        The entry's location changes in one step.  A version with other columns
        needs a new entry, which takes two; its folders aren't touched.
        """
        new = spark.read.parquet(version).schema
        if self.exists(spark):
            if _shape(spark.table(self.name).schema) == _shape(new):
                spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{_quoted(version)}'")
                spark.catalog.refreshTable(self.name)
                return
            spark.sql(f"DROP TABLE {self.name}")  # an external table: the data stay
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        spark.catalog.createTable(self.name, path=version, source="parquet")

    def read(self, spark: SparkSession) -> DataFrame:
        """The published version; the frame keeps it when a later one is published."""
        return spark.table(self.name)

    def release(self, spark: SparkSession, keep: int = 1) -> list[str]:
        """Delete all but the published version and the ``keep`` newest others; names of what went.

        Versions newer than the published one are being written or were left
        by a failed job; they count as others, so keep as many as may be written
        or read at a time.
        """
        current = self.location(spark)
        if current is None:
            return []
        others = [v for v in self.versions(spark) if not current.rstrip("/").endswith(f"/{v}")]
        gone = others[: max(0, len(others) - keep)]
        for v in gone:
            discard(spark, f"{self.folder}/{v}")
        return gone


def _shape(schema) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")
