"""Reading tables, queries and local rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the current catalog, V1 or V2."""
    return spark.table(name)


def scan_source(spark: SparkSession, name: str, columns: str) -> DataFrame:
    """A table written elsewhere; fails early when a declared column is absent or of another type."""
    df = spark.table(name)
    found = {field.name: field.dataType for field in df.schema}
    wanted = StructType.fromDDL(columns)
    wrong = [f"{f.name} {f.dataType.simpleString()}" for f in wanted if found.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"{name} lacks the declared columns: {', '.join(wrong)}")
    return df.select(*wanted.names)


def read_query(
    spark: SparkSession, query: str, date_columns: Sequence[str] | None = None, **frames: DataFrame
) -> DataFrame:
    """Result of a query; the listed columns become zone-less timestamps. ``{name}`` in the text is a given frame."""
    df = spark.sql(query, **frames)
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in date_columns or []})


def run_query(spark: SparkSession, query: str) -> None:
    """Run a statement for its effect."""
    spark.sql(query)


def read_jdbc_query(
    spark: SparkSession,
    url: str,
    query: str,
    split_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """Result of a query run by a database; with a split column it is read in parallel slices."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if split_column is None:
        return reader.option("query", query).load()
    if lower is None or upper is None:
        raise ValueError("a split column needs its lower and upper bound")
    return reader.options(
        dbtable=f"({query}) t",
        partitionColumn=split_column,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=str(partitions),
    ).load()


def literal_rows(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    return spark.createDataFrame(list(rows), columns)


def stack_by_position(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by position; names come from the first frame."""
    for other in others:
        first = first.union(other)
    return first


def frame_from_local(spark: SparkSession, data, names: Sequence[str]) -> DataFrame:
    """Local rows, array or pandas frame as a DataFrame with positional names."""
    return spark.createDataFrame(data).toDF(*names)


def random_frame(spark: SparkSession, rows: int = 20, seed: int = 123) -> DataFrame:
    """Seeded test frame: two features uniform on [0, 10), label normal with deviation 2."""
    return spark.range(rows).select(
        (F.rand(seed) * 10).alias("x0"),
        (F.rand(seed + 1) * 10).alias("x1"),
        (F.randn(seed + 2) * 2).alias("y"),
    )


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    """Tables of a schema, without the session's temporary views."""
    return sorted(table.name for table in spark.catalog.listTables(schema) if not table.isTemporary)
