"""Names that always point at a complete table.

Readers use a view of the catalog.  A refresh fills a table of its own, and one change of
the view's definition (``ALTER VIEW``) leads readers from the version before to the new
one, also when the columns have changed.  The version before is kept, for readers that are
under way and for a rollback; older ones are dropped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

MARK = "__v"


def quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def target_of(spark: SparkSession, name: str) -> str | None:
    """The version a name points at; None for a name that is no pointer."""
    if not spark.catalog.tableExists(name) or not _is_view(spark, name):
        return None
    text = spark.sql(f"DESCRIBE EXTENDED {quoted(name)}").where("col_name = 'View Text'").first()["data_type"]
    target = text.removeprefix("SELECT * FROM ").replace("`", "")
    return target if MARK in target else None


def versions(spark: SparkSession, name: str) -> list[str]:
    """All versions of a name, the newest first."""
    database, _, table = name.rpartition(".")
    found = spark.catalog.listTables(database or None, f"{table}{MARK}*")
    prefix = f"{database}." if database else ""
    return sorted((f"{prefix}{t.name}" for t in found if not t.isTemporary), reverse=True)


def new_version(spark: SparkSession, name: str) -> str:
    """A name for the next version; those of failed refreshes are not used again."""
    known = versions(spark, name)
    number = int(known[0].rpartition(MARK)[2].split("_")[0]) + 1 if known else 1
    return f"{name}{MARK}{number:06d}_{uuid.uuid4().hex[:8]}"


def point(spark: SparkSession, name: str, version: str, keep: int = 1) -> None:
    """Lead readers of ``name`` to ``version`` in one step, then drop all but ``keep`` of the versions before.

    A plain table of that name, made otherwise, gives way first; from then on the name is
    a pointer and never missing.
    """
    before = target_of(spark, name)
    exists = spark.catalog.tableExists(name)
    if exists and not _is_view(spark, name):
        spark.sql(f"DROP TABLE {quoted(name)}")
        exists = False
    spark.sql(f"{'ALTER' if exists else 'CREATE'} VIEW {quoted(name)} AS SELECT * FROM {quoted(version)}")
    older = [v for v in versions(spark, name) if v < min(version, before or version)]
    for gone in older if keep <= 1 else older[keep - 1 :]:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(gone)}")


def rollback(spark: SparkSession, name: str) -> str:
    """Lead readers back to the version before the one they find now; returns it."""
    now = target_of(spark, name)
    earlier = [v for v in versions(spark, name) if now is not None and v < now]
    if not earlier:
        raise ValueError(f"no earlier version of {name}")
    spark.sql(f"ALTER VIEW {quoted(name)} AS SELECT * FROM {quoted(earlier[0])}")
    return earlier[0]
