"""Writing tables, for V2 catalogs (which do it in one atomic step) and for the V1 session catalog."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.session import delete_folder


def in_v2_catalog(spark: SparkSession, table: str) -> bool:
    parts = table.split(".")
    catalog = parts[0] if len(parts) == 3 else spark.catalog.currentCatalog()
    return catalog != "spark_catalog"


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def _schema_location(spark: SparkSession, table: str) -> str:
    schema = table.rsplit(".", 1)[0] if "." in table else spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(schema).locationUri.rstrip("/")


@dataclass(frozen=True)
class Layout:
    """How a table lies on disk: partition folders, or hash buckets sorted inside by ``sort_by``.

    Revenue in buckets of its client needs no shuffle to pair up a client's months, and none to be joined with
    predictions in as many buckets of the client. Sorted by month first, a month's rows lie together in every file, so
    the monthly jobs skip the row groups of other months.
    """

    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    sort_by: tuple[str, ...] = ()

    def ddl(self) -> str:
        text = f" PARTITIONED BY ({', '.join(self.partition_by)})" if self.partition_by else ""
        if self.bucket_by:
            sort = f" SORTED BY ({', '.join(self.sort_by)})" if self.sort_by else ""
            text += f" CLUSTERED BY ({', '.join(self.bucket_by)}){sort} INTO {self.buckets} BUCKETS"
        return text


PLAIN = Layout()


def monthly(buckets: int) -> Layout:
    """The layout of revenue and of predictions."""
    return Layout(bucket_by=("clientID",), buckets=buckets, sort_by=("month", "clientID"))


def _spread(df: DataFrame, layout: Layout) -> DataFrame:
    """One writer per bucket or per partition value; a hot partition value is split over several tasks."""
    if layout.bucket_by:
        return df.repartition(layout.buckets, *layout.bucket_by)
    if layout.partition_by:
        return df.hint("rebalance", *[F.col(c) for c in layout.partition_by])
    return df


def create_table_if_absent(
    spark: SparkSession, table: str, columns: str, layout: Layout = PLAIN, file_format: str = "parquet"
) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {file_format}{layout.ddl()}")


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def layout_of(spark: SparkSession, table: str) -> Layout:
    """The layout a stored table has."""
    about = _described(spark, table)

    def names(key: str) -> tuple[str, ...]:
        return tuple(re.findall(r"[^\[\]`, ]+", about.get(key, "")))

    partitions = tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    return Layout(partitions, names("Bucket Columns"), int(about.get("Num Buckets", 0)), names("Sort Columns"))


def _columns_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _write_beside(df: DataFrame, table: str, layout: Layout) -> str:
    """Write the rows to a new table in a folder of its own, beside the table it will replace."""
    spark = df.sparkSession
    beside = f"{table}_{uuid.uuid4().hex}"
    path = f"{_schema_location(spark, table)}/{beside.rsplit('.', 1)[-1]}"
    spark.sql(f"CREATE TABLE {beside} ({_columns_of(df)}) USING parquet{layout.ddl()} LOCATION '{path}'")
    try:
        _spread(df, layout).select(*spark.table(beside).columns).write.insertInto(beside)
    except Exception:
        drop_table(spark, beside)
        delete_folder(spark, path)
        raise
    return beside


def _take_place(spark: SparkSession, table: str, beside: str) -> None:
    """Point ``table`` at the folder of ``beside`` in one catalog call; the name is never gone."""
    old, new = _described(spark, table), _described(spark, beside)["Location"]
    if old.get("Partition Provider") == "Catalog":
        _take_name(spark, table, beside)
        return
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    drop_table(spark, beside)  # the folder is not the catalog's to delete, so it stays
    spark.catalog.refreshTable(table)
    if old["Location"] != new:
        delete_folder(spark, old["Location"])


def _take_name(spark: SparkSession, table: str, beside: str) -> None:
    """Give ``beside`` the name of ``table``, in two catalog calls whatever its partitions; the old rows go afterwards.

    The catalog keeps a location for every partition, so a partitioned table cannot be pointed elsewhere in one call.
    Readers see all old or all new rows, or, between the two calls, no table; if the second call fails, the first is
    taken back.
    """
    aside = f"{table}_{uuid.uuid4().hex}"
    spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {beside} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
        raise
    spark.catalog.refreshTable(table)
    folder = _described(spark, aside)["Location"]
    drop_table(spark, aside)
    delete_folder(spark, folder)


def _write_v2(df: DataFrame, table: str, layout: Layout) -> None:
    writer = df.writeTo(table)
    spread = [F.col(c) for c in layout.partition_by]
    spread += [F.partitioning.bucket(layout.buckets, c) for c in layout.bucket_by]
    if spread:
        writer = writer.partitionedBy(*spread)
    writer.createOrReplace()


def rebuild_tables(frames: dict[str, DataFrame], layout: Layout | None = None) -> None:
    """Replace whole tables by frames that may read the tables they replace; without a layout each keeps its own.

    V1: the rows first go to folders beside the old ones, which the tables are then pointed at, so a job that fails
    half-way leaves the old tables as they were; old folders go afterwards. Where a table is partitioned, or columns or
    layout change, the new table takes the name instead.
    """
    beside = {}
    for table, df in frames.items():
        spark = df.sparkSession
        if in_v2_catalog(spark, table):
            _write_v2(_spread(df, layout or PLAIN), table, layout or PLAIN)
        else:
            kept = layout_of(spark, table) if layout is None and spark.catalog.tableExists(table) else layout or PLAIN
            beside[table] = (_write_beside(df, table, kept), kept)
    for table, (new, kept) in beside.items():
        spark = frames[table].sparkSession
        if not spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
        elif kept == layout_of(spark, table) and spark.table(table).dtypes == spark.table(new).dtypes:
            _take_place(spark, table, new)
        else:
            _take_name(spark, table, new)


def rebuild_table(df: DataFrame, table: str, layout: Layout | None = None) -> DataFrame:
    """Replace one whole table and read it."""
    rebuild_tables({table: df}, layout)
    return df.sparkSession.table(table)


def append(df: DataFrame, table: str) -> None:
    """Append by column name; values are stored in the table's types, and one that does not fit fails the job."""
    spark = df.sparkSession
    if in_v2_catalog(spark, table):
        df.writeTo(table).append()
        return
    rows = _spread(df, layout_of(spark, table))
    spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=rows)


def append_incremental(df: DataFrame, table: str) -> None:
    """Create the table on the first run, append on later ones."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        if in_v2_catalog(spark, table):
            df.limit(0).writeTo(table).create()
        else:
            create_table_if_absent(spark, table, _columns_of(df))
    append(df, table)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions that occur in ``df``; an unpartitioned table is replaced whole."""
    spark = df.sparkSession
    if in_v2_catalog(spark, table):
        df.writeTo(table).overwritePartitions()
        return
    columns = spark.table(table).columns
    rows = _spread(df.select(*columns), layout_of(spark, table))
    # The V1 insert takes this setting from the session only.
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(setting, before)
