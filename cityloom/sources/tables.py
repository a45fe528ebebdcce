"""Readers and writers of the tables between the steps.

Parquet is the format between steps: typed, columnar, and safe for names with line breaks or empty
text, which a CSV round trip changes. CSV and JSON are for the edges. No writer funnels its rows
through one task unless it is asked for one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: str | StructType, *, multi_line: bool = False) -> DataFrame:
    """CSV with a header line; columns bind to the schema by position, whatever the header says.

    ``multi_line`` reads quoted line breaks but makes every file one task. Set it for free text such
    as listing names and give many files; leave it off for tables without free text.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON lines with a declared schema. A column declared as string keeps the raw JSON text."""
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, path: str, schema: str | StructType, *, multi_line: bool = False) -> DataFrame:
    """Any of the formats, told by the end of the path (Parquet if it tells nothing)."""
    plain = path.rstrip("/").removesuffix(".gz").removesuffix(".bz2")
    if plain.endswith((".csv", "-csv")):
        return read_csv(spark, path, schema, multi_line=multi_line)
    if plain.endswith((".json", "-json")):
        return read_json(spark, path, schema)
    return read_parquet(spark, path)


# The default patterns of the text writers cut timestamps to milliseconds.
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_TIMES = {"timestampFormat": _MICROS + "XXX", "timestampNTZFormat": _MICROS}


def write_csv(df: DataFrame, path: str, *, one_file: bool = False) -> None:
    """CSV with a header; ``one_file`` puts all rows through one task, for results known to be small."""
    df = df.coalesce(1) if one_file else df
    df.write.mode("overwrite").options(**_TIMES).option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Gzip JSON lines."""
    df.write.mode("overwrite").options(**_TIMES).option("compression", "gzip").json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "lz4").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """The counterpart of ``read_table``."""
    plain = path.rstrip("/")
    if plain.endswith((".csv", "-csv")):
        write_csv(df, path)
    elif plain.endswith((".json", "-json")):
        write_json(df, path)
    else:
        write_parquet(df, path)

