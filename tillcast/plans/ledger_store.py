"""The ledger as catalog tables of one schema.

A ledger made with ``slices`` has its run tables partitioned by ``slice``, a hash of the run, so a delete or restore reads
and rewrites only the slices of its runs, and no experiment makes a large partition. The column is the stored tables'
own: ``append_rows`` fills it, and an opened ledger lacks it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators.ledger import COLUMNS, OPTIONAL, RUN_TABLES, Ledger
from tillcast.session import stage
from tillcast.sources import sinks

SLICE = "slice"
_SLICES_SET = "ledger.slices"


def create_ledger(spark: SparkSession, schema: str, slices: int | None = None) -> None:
    """Create the tables that are not there. ``slices``, for run tables too large to be rewritten for a delete, holds
    for new tables; rows are then appended by ``append_rows`` only."""
    sliced = f", {SLICE} int"
    for table, columns in {**COLUMNS, **OPTIONAL}.items():
        name = f"{schema}.{table}"
        if table not in RUN_TABLES or slices is None:
            sinks.create_table_if_absent(spark, name, columns)
        elif not spark.catalog.tableExists(name):
            sinks.create_table_if_absent(spark, name, columns + sliced, sinks.Layout(partition_by=(SLICE,)))
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_SLICES_SET}' = '{slices}')")


def slices_of(spark: SparkSession, table: str) -> int | None:
    """How many slices a stored run table has; None if it is not sliced."""
    if SLICE not in spark.table(table).columns:
        return None
    told = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return int(told[_SLICES_SET])


def slice_of(run: Column, slices: int) -> Column:
    return F.pmod(F.xxhash64(run), F.lit(slices)).cast("int")


def open_ledger(spark: SparkSession, schema: str, slices: list[int] | None = None) -> Ledger:
    """The stored ledger; with ``slices`` the run tables hold only the runs of these."""

    def opened(table: str) -> DataFrame:
        df = spark.table(f"{schema}.{table}")
        if SLICE not in df.columns:
            return df
        if slices is not None:
            df = df.where(F.col(SLICE).isin(slices))
        return df.drop(SLICE)

    there = [table for table in OPTIONAL if spark.catalog.tableExists(f"{schema}.{table}")]
    return Ledger(**{table: opened(table) for table in [*COLUMNS, *there]})


#: What tells one row of a table from another; rows of metrics, params and tags by run and key.
KEYS = {
    "experiments": ["experiment_id"],
    "runs": ["run_uuid"],
    "logged_models": ["model_id"],
    "model_versions": ["name", "version"],
    "registered_models": ["name"],
    "aliases": ["name", "alias"],
}


def append_rows(rows: dict[str, DataFrame], schema: str) -> None:
    """Append the rows that are not there yet, those of ``runs`` last.

    New ids are hashes of what a run is about, so a call that failed half-way can be repeated: rows that were written
    are left out, and a run shows only when all of its other rows are there.
    """
    for table, new in sorted(rows.items(), key=lambda item: item[0] == "runs"):
        spark, name = new.sparkSession, f"{schema}.{table}"
        stored = spark.table(name)
        keys = KEYS.get(table, ["run_uuid", "key"])
        slices = slices_of(spark, name) if table in RUN_TABLES else None
        if slices is not None:
            new = new.withColumn(SLICE, slice_of(F.col("run_uuid"), slices))
            keys = [*keys, SLICE]  # slices without new rows are not read
        fresh = new.select(*stored.columns).join(stored.select(*keys).distinct(), keys, "left_anti")
        sinks.append(fresh.select(*stored.columns), name)


#: Order in which a delete replaces tables. A stop in between leaves what a second call still finds and finishes: the
#: log of changes is there before anything goes, nothing points at what is gone, and a run goes after all that it has.
#: Restores and promotions go the other way round.
ORDER = (
    "changes", "aliases", "registered_models", "model_versions", "logged_models", "tags", "params", "metrics",
    "latest_metrics", "runs", "experiments",
)


def _changed(before: Ledger, after: Ledger, removing: bool) -> dict[str, DataFrame]:
    old, new = before.tables(), after.tables()
    order = ORDER if removing else ORDER[::-1]
    return {table: new[table] for table in order if table in new and new[table] is not old.get(table)}


def replace_tables(before: Ledger, after: Ledger, schema: str, removing: bool = False) -> None:
    """Rebuild the tables that a delete (``removing``), restore or promotion changed, in an order that a stop in between
    does no harm to. ``before`` is the opened ledger. ``change_runs`` is the way for runs: it rewrites only their slices.

    The changed tables are read from each other, so all new versions are computed before the first table is replaced.
    """
    changed = _changed(before, after, removing)
    for table, df in changed.items():
        slices = slices_of(df.sparkSession, f"{schema}.{table}") if table in RUN_TABLES else None
        if slices is not None:
            changed[table] = df.withColumn(SLICE, slice_of(F.col("run_uuid"), slices))
    sinks.rebuild_tables({f"{schema}.{table}": df for table, df in changed.items()})


def change_runs(
    spark: SparkSession, schema: str, run_ids: DataFrame, change: Callable[[Ledger], Ledger], removing: bool
) -> None:
    """Apply a delete (``removing``) or restore of the given runs to the stored ledger.

    ``change`` gets the ledger with the runs of the slices that hold ``run_ids``; of the run tables only these slices
    are read and written. A call that was stopped can be repeated with the same ids. A ledger whose run tables are not
    sliced is rewritten table by table.
    """
    slices = slices_of(spark, f"{schema}.runs")
    if slices is None:
        before = open_ledger(spark, schema)
        replace_tables(before, change(before), schema, removing)
        return
    of_runs = run_ids.select(slice_of(F.col("run_uuid"), slices).alias(SLICE)).distinct()
    hit = sorted(row[SLICE] for row in of_runs.collect())  # at most as many as there are slices
    if not hit:
        return
    before = open_ledger(spark, schema, hit)
    changed = _changed(before, change(before), removing)
    # Stored first: the new versions read the tables that they replace.
    of_slices = {
        table: stage(df.withColumn(SLICE, slice_of(F.col("run_uuid"), slices)), table)
        for table, df in changed.items()
        if table in RUN_TABLES
    }
    others = {table: stage(df, table) for table, df in changed.items() if table not in RUN_TABLES}
    for table in changed:
        if table in others:
            sinks.rebuild_tables({f"{schema}.{table}": others[table]})
        else:
            _replace_slices(of_slices[table], f"{schema}.{table}", hit)


def _replace_slices(df: DataFrame, table: str, hit: list[int]) -> None:
    """Overwrite the slices that have rows left and drop the others of ``hit``."""
    spark = df.sparkSession
    left = {row[SLICE] for row in df.select(SLICE).distinct().collect()}
    sinks.overwrite_partitions(df, table)
    if gone := [number for number in hit if number not in left]:
        if sinks.in_v2_catalog(spark, table):
            spark.sql(f"DELETE FROM {table} WHERE {SLICE} IN ({', '.join(map(str, gone))})")
        else:
            listed = ", ".join(f"PARTITION ({SLICE} = {number})" for number in gone)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {listed}")
    spark.catalog.refreshTable(table)


#: Finished steps of jobs that write to the ledger, with what a later step needs to know of them.
STEPS = "job string, step string, detail string"


def finished_steps(spark: SparkSession, schema: str, job: str) -> dict[str, str]:
    """Step and detail of the finished steps of a job."""
    sinks.create_table_if_absent(spark, f"{schema}.steps", STEPS)
    rows = spark.table(f"{schema}.steps").where(F.col("job") == job).groupBy("step").agg(F.min("detail").alias("detail"))
    return {row.step: row.detail for row in rows.collect()}


def finish_step(spark: SparkSession, schema: str, job: str, step: str, detail: str = "") -> None:
    sinks.append(spark.createDataFrame([(job, step, detail)], STEPS), f"{schema}.steps")
