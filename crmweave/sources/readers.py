"""Reading entities from files, catalog tables and JDBC sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from crmweave.functions.text import unescaped
from crmweave.specs import EntitySpec


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = False, escaped: bool = False
) -> DataFrame:
    """CSV with a header and doubled quotes.

    Without a schema the types are inferred, at the price of an extra pass over the
    files.  ``multi_line`` allows line breaks in values, but files then do not split.
    Nothing between two separators is NULL, a pair of quotes is empty text: a NULL
    marker other than the empty string keeps Spark from reading both as NULL.
    ``escaped`` undoes the escapes of ``write_bronze``, whose files have a record on each
    line and split whatever the values hold.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("nullValue", "\\N")
    reader = reader.option("multiLine", multi_line)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return unescaped(df) if escaped else df


RECORD, REASONS, RAGGED = "record", "reasons", "wrong number of fields"


def read_csv_checked(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """CSV of a known schema as two frames: typed good rows, and records that do not fit, with the reasons.

    Values are read as text and cast one by one, so each column whose value does not parse is named; a record with too
    few or too many fields is whole in ``record``. Empty text in a column that is not text is a missing value. Both
    frames read the files on their own.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema.fields]).add("__corrupt", StringType())
    raw = (
        spark.read.schema(text).option("header", True).option("escape", '"').option("nullValue", "\\N").option("multiLine", multi_line)
        # Without pruning, the number of fields is checked whatever columns are asked for.
        .option("columnPruning", False).option("columnNameOfCorruptRecord", "__corrupt").csv(path)
    )
    columns = {f.name: F.col(f"`{f.name}`") for f in schema.fields}
    filled = {
        f.name: columns[f.name] if isinstance(f.dataType, StringType) else F.nullif(F.trim(columns[f.name]), F.lit("")) for f in schema.fields
    }
    cast = {f.name: filled[f.name].try_cast(f.dataType) for f in schema.fields}
    wrong = [
        F.when(filled[f.name].isNotNull() & cast[f.name].isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}")) for f in schema.fields
    ]
    missing = [F.when(filled[f.name].isNull(), F.lit(f"{f.name} is missing")) for f in schema.fields if not f.nullable]
    reasons = F.when(F.col("__corrupt").isNotNull(), F.array(F.lit(RAGGED))).otherwise(F.array_compact(F.array(*wrong, *missing)))
    checked = raw.withColumn(REASONS, reasons)
    good = checked.where(F.size(REASONS) == 0).select(*(cast[f.name].alias(f.name) for f in schema.fields))
    as_read = F.coalesce("__corrupt", F.to_csv(F.struct(*columns.values())))
    return good, checked.where(F.size(REASONS) > 0).select(as_read.alias(RECORD), REASONS)


def quarantine(bad: DataFrame, path: str) -> DataFrame:
    """Store records that do not fit, and count them by reason; one with several reasons counts under each."""
    bad.write.mode("overwrite").parquet(path)
    stored = bad.sparkSession.read.parquet(path)
    return stored.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count("*").alias("records"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """Table of a relational source.  Filters and column choice reach the source.

    With a partition column the key range is read by ``partitions`` tasks at once;
    without one a single task reads everything.
    """
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, fetchsize=str(fetch_size), **options
    )
    if partition_column is not None:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return reader.load()


def read_entity(
    spark: SparkSession, location: str, spec: EntitySpec | None = None, multi_line: bool = False, escaped: bool = False
) -> DataFrame:
    """An entity from a ``.csv`` path (typed by its spec), a parquet path or a table name."""
    if location.endswith(".csv"):
        return read_csv(spark, location, spec.schema if spec else None, multi_line, escaped)
    if "/" in location:
        return read_parquet(spark, location)
    return spark.table(location)


def register(tables: dict[str, DataFrame]) -> None:
    """Make frames available to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, query: str, **parameters: object) -> DataFrame:
    """SQL over registered tables, with named parameters (``:name``) bound as values."""
    return spark.sql(query, args=parameters or None)
