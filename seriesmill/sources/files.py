"""Delimited files with a declared schema, and parquet output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.columns import nan_to_null
from seriesmill.sources.publish import publish_table

# The columns of the price observation file, in file order.
PRICE_COLUMNS = {
    "Year": T.IntegerType(),
    "Month": T.IntegerType(),
    "Day": T.IntegerType(),
    "Season": T.StringType(),
    "Inflation_Rate": T.DoubleType(),
    "Exchange_Rate": T.DoubleType(),
    "GDP_Growth": T.DoubleType(),
    "Crop_Yield": T.DoubleType(),
    "Fertilizer_Price": T.DoubleType(),
    "Water_Availability": T.DoubleType(),
    "Temperature": T.DoubleType(),
    "Rainfall": T.DoubleType(),
    "Humidity": T.DoubleType(),
    "Transport_Cost": T.DoubleType(),
    "Demand_Index": T.DoubleType(),
    "Previous_Price": T.DoubleType(),
    "Food_Price": T.DoubleType(),
}
PRICE_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in PRICE_COLUMNS.items()])


FILE_ORDER = ("_file", "_file_offset", "_file_row")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = PRICE_SCHEMA,
    file_order: bool = False,
) -> DataFrame:
    """Read a headed CSV file by its declared schema; a wrong header or value is an error.

    Naming the schema saves the extra pass of type inference. NaN cells become null.
    With ``file_order`` the columns of ``FILE_ORDER`` are added; sorting by them gives
    the order of the lines in the file, for files whose order is their time order.
    """
    frame = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    if file_order:
        frame = frame.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_file_offset"),
            F.monotonically_increasing_id().alias("_file_row"),
        )
    return nan_to_null(frame)


def write_table(
    df: DataFrame, path: str, kind: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Write the table as parquet (default) or headed CSV, replacing what is there only once it is whole."""
    publish_table(df, path, kind, partition_by)
