"""Transaction CSV scan with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardproof.functions.columns import drop_missing
from cardproof.functions.schema import MANDATORY, transaction_schema

RAW_LINE = "_raw_line"


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    strict_header: bool = False,
    raw_line: bool = False,
) -> DataFrame:
    """Every CSV row in the declared schema; a cell that does not parse is null.

    The header is skipped and columns go by position. ``strict_header`` fails on other header names.
    ``raw_line`` adds the text of each row that did not parse cleanly.
    """
    schema = schema or transaction_schema()
    reader = spark.read.option("header", True).option("enforceSchema", not strict_header)
    if raw_line:
        schema = T.StructType([*schema.fields, T.StructField(RAW_LINE, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", RAW_LINE)
    return reader.schema(schema).csv(path)


def read_transactions(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    mandatory: Sequence[str] = MANDATORY,
    strict_header: bool = False,
) -> DataFrame:
    """Rows that have every mandatory value."""
    return drop_missing(scan_csv(spark, path, schema, strict_header), mandatory)


def read_rejects(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    mandatory: Sequence[str] = MANDATORY,
) -> DataFrame:
    """The rows that ``read_transactions`` leaves out, with the raw line where a cell did not parse.

    A second scan of the file, made only when somebody asks for the rejects.
    """
    rows = scan_csv(spark, path, schema, raw_line=True)
    missing = F.lit(False)
    for name in mandatory:
        missing = missing | F.col(name).isNull()
        if isinstance(rows.schema[name].dataType, (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(name)
    return rows.filter(missing)
