"""Declared-schema sources. No schema is ever inferred."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.session import stage

CORRUPT = "_corrupt_record"


class Csv(NamedTuple):
    rows: DataFrame
    quarantined: DataFrame


def with_csv_options(reader, schema: T.StructType):
    """A batch or stream reader of comma-separated feeds with a header and LF line ends.

    The header must name the declared columns in their order.
    """
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return reader.schema(marked).options(
        header=True,
        sep=",",
        lineSep="\n",
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
        enforceSchema=False,
    )


def csv_reader(spark: SparkSession, schema: T.StructType):
    return with_csv_options(spark.read, schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> Csv:
    """Land a feed: well-formed rows, and the text of the lines that are not.

    The parsed lines are written before they are split. Only with every column
    parsed is it sure which lines are malformed; a later query that needs few
    columns would not notice the others. A header that does not name the declared
    columns fails the read.
    """
    parsed = csv_reader(spark, schema).csv(path)
    landed = stage(
        parsed.select(
            "*",
            F.col("_metadata.file_path").alias("source_file"),
            F.col(CORRUPT).isNotNull().alias("malformed"),
        ),
        "landed",
        "malformed",
    )
    quarantined = landed.where("malformed").select(F.col(CORRUPT).alias("line"), "source_file")
    return Csv(landed.where("not malformed").select(*schema.names), quarantined)


def read_text_columns(spark: SparkSession, path: str) -> DataFrame:
    """Every column of a feed as text, named by its header, for type checks."""
    return spark.read.options(header=True, sep=",", lineSep="\n", inferSchema=False).csv(path)
