"""Sources and sinks for postings and metric tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from ..rules import MISSING_CELLS
from .pieces import CsvLines, JsonObjects, records, running_numbers


def read_postings_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    missing: Sequence[str] = MISSING_CELLS,
    ordinal: str | None = None,
) -> DataFrame:
    """Headered CSV whose cells may hold newlines and doubled quotes.

    A large file is read in many tasks although its cells hold newlines (`pieces`). The
    first record of each file is its header; columns go by position. Cells in ``missing``
    read as null, empty lines are left out. ``ordinal`` adds a running id in file order, gapless over all
    files by path.
    """
    found = records(spark, path, CsvLines).where("number > 0")
    # A record that ends with both line end characters has them in its cells as one.
    bare = F.replace(F.expr("left(record, length(record) - 1)"), F.lit("\r\n"), F.lit("\n"))
    found = found.withColumn("record", F.when(F.col("record").endswith("\r"), bare).otherwise(F.col("record")))
    if ordinal:
        found = running_numbers(found, first=1)
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    row = F.from_csv("record", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), options)
    texts = {f.name for f in schema.fields if isinstance(f.dataType, StringType)}

    def cell(name: str) -> Column:
        value = F.col("row").getField(name)
        return (F.when(value.isin(list(missing)), F.lit(None)).otherwise(value) if name in texts else value).alias(name)

    kept = ["ordinal"] if ordinal else []
    rows = found.select(row.alias("row"), *kept)
    return rows.select(*[cell(c) for c in schema.names], *[F.col(c).alias(ordinal) for c in kept])


def read_postings_json(
    spark: SparkSession, path: str, schema: StructType, lines: bool = False
) -> DataFrame:
    """Files that each hold one JSON array of postings, or one object; a large array is read in many tasks.

    With ``lines`` every line holds an array of its own. Text that is no object gives no row.
    """
    if lines:
        return spark.read.schema(schema).json(path)
    found = records(spark, path, JsonObjects).select(F.ltrim("record", F.lit("\ufeff \t\r\n,[")).alias("record"))
    objects = found.where(F.col("record").startswith("{"))
    return objects.select(F.from_json("record", schema).alias("row")).select("row.*")


def normalise_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the listed columns; the others pass through."""
    return df.withColumnsRenamed(dict(mapping))


def write_table(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Write the given columns as parquet, replacing what was there."""
    (df.select(*columns) if columns else df).write.mode("overwrite").parquet(path)


def write_metrics(tables: Mapping[str, DataFrame], path: str) -> None:
    """Write each metric table as JSON lines under ``path/<name>``."""
    for name, table in tables.items():
        table.write.mode("overwrite").json(f"{path}/{name}")
