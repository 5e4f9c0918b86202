"""Versioned tables: a step's output is published whole, in one catalog step.

A published name is a view over one version table.  A writer makes the next version
beside it (``new_version``), and ``publish`` replaces the view, which is one catalog
operation: readers see the old version until then and the new one after it, also if
the writer is killed at any time.  The view's properties hold the version's name and
a record of what it was made from, so the record and the data change together.

Only the version before the published one is kept, for queries that still read it;
older ones, and those that a killed writer left, are dropped at the next publish.
One writer at a time per name, as for the plain steps.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import SparkSession

from tapflow.sources.tables import is_path, qualified, read_table

_VERSION, _BEFORE, _RECORD = "tapflow.version", "tapflow.before", "tapflow.made_from"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    """The properties of a published view; none for a name that does not exist."""
    if not spark.catalog.tableExists(name):
        return {}
    if spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table; only views over versions are published")
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def published_record(spark: SparkSession, table: str, db: str | None = None) -> str | None:
    return _properties(spark, _catalog_name(table, db)).get(_RECORD)


def _catalog_name(table: str, db: str | None) -> str:
    if is_path(table):
        raise ValueError(f"{table}: versions are published under catalog names")
    return qualified(db, table)


def record(spark: SparkSession, work: str, inputs: list[str], db: str | None = None) -> str:
    """A digest of the work and of every file of its inputs: path, length and time of
    change.  An input that is no table or folder (a JDBC table) is never the same."""
    digest = hashlib.sha256(work.encode())
    for name in inputs:
        try:
            files = sorted(_files(spark, name, db))
        except Exception:  # noqa: BLE001 - not a table of files
            files = [uuid.uuid4().hex]
        digest.update("\n".join([name, *files]).encode())
    return digest.hexdigest()


def _files(spark: SparkSession, name: str, db: str | None) -> list[str]:
    df = spark.read.text(name) if is_path(name) else read_table(spark, name, db)
    out = []
    for path in df.inputFiles():
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
        out.append(f"{path} {status.getLen()} {status.getModificationTime()}")
    return out


def new_version(spark: SparkSession, table: str, db: str | None = None) -> str:
    """A fresh name for the next version of ``table`` (refused where a plain table stands)."""
    _properties(spark, _catalog_name(table, db))
    return f"{table}__v{uuid.uuid4().hex}"


def publish(spark: SparkSession, table: str, version: str, made_from: str, db: str | None = None) -> None:
    """Show ``version`` under the name ``table``; then drop what no reader needs."""
    name = _catalog_name(table, db)
    before = _properties(spark, name).get(_VERSION, "")
    marks = ", ".join(f"'{k}' = '{v}'" for k, v in ((_VERSION, version), (_BEFORE, before), (_RECORD, made_from)))
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({marks}) AS SELECT * FROM {qualified(db, version)}")
    for old in versions_of(spark, table, db):
        if old not in (version.lower(), before.lower()):
            spark.sql(f"DROP TABLE IF EXISTS {qualified(db, old)}")


def versions_of(spark: SparkSession, table: str, db: str | None = None) -> list[str]:
    """All version tables of a name, also those that were never published."""
    within = f" IN {db}" if db else ""
    prefix = f"{table}__v".lower()
    found = spark.sql(f"SHOW TABLES{within}").collect()
    return sorted(r["tableName"] for r in found
                  if r["tableName"].lower().startswith(prefix) and len(r["tableName"]) == len(prefix) + 32)
