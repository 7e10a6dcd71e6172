"""Publishing all tables of a report at once.

Tables are written to folders of one run, ``<path>/<name>/as_of=<day>/run=<run>``.
A run becomes visible by its manifest row, which is appended after the last
table: one small file that its commit renames into place. Until then readers
see the tables of the run published before, so a run that dies between two
tables changes nothing. Nothing published is overwritten; a re-run of a day is
a further run, and the latest manifest row of a day counts.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_date

MANIFEST = "_manifest"
MANIFEST_SCHEMA = "as_of date, seq int, run string, tables array<string>"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Every published run under ``path``: as_of, seq, run, tables (empty before the first)."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path.rstrip('/')}/{MANIFEST}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def published(spark: SparkSession, path: str) -> DataFrame:
    """The run that counts for each day: the greatest seq, ties by run id."""
    return (manifest(spark, path).groupBy("as_of")
            .agg(F.max(F.struct("seq", "run", "tables")).alias("m"))
            .select("as_of", "m.seq", "m.run", "m.tables"))


def publish_report(tables: dict[str, DataFrame], path: str, as_of) -> str:
    """Write every table, then make them visible together; returns the run id.

    A second attempt, also one that runs beside a first one still alive,
    writes to folders of its own. Folders of attempts that died stay behind,
    unread.
    """
    spark = next(iter(tables.values())).sparkSession
    base, day = path.rstrip("/"), as_date(as_of)
    run = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{base}/{name}/as_of={day.isoformat()}/run={run}")
    last = manifest(spark, path).where(F.col("as_of") == F.lit(day)).agg(F.max("seq")).first()[0]
    row = spark.createDataFrame([(day, (last or 0) + 1, run, sorted(tables))], MANIFEST_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{base}/{MANIFEST}")
    return run


def read_report(spark: SparkSession, path: str, name: str, start=None, end=None) -> DataFrame:
    """Table ``name`` of the published days in ``[start, end)``, with as_of.

    The driver reads one manifest row per published day. Without such a day
    the call raises ``LookupError``.
    """
    base = path.rstrip("/")
    runs = published(spark, path).where(F.array_contains("tables", name))
    if start is not None:
        runs = runs.where(F.col("as_of") >= F.lit(as_date(start)))
    if end is not None:
        runs = runs.where(F.col("as_of") < F.lit(as_date(end)))
    folders = [f"{base}/{name}/as_of={r['as_of'].isoformat()}/run={r['run']}"
               for r in runs.orderBy("as_of").collect()]
    if not folders:
        raise LookupError(f"no published day of {name!r} under {path}")
    return spark.read.option("basePath", f"{base}/{name}").parquet(*folders).drop("run")
