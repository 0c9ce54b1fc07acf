"""Finding extracts: folders of one file per table that share a file-name template."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.names import with_parsed_name
from tidemark.registry import Registry
from tidemark.sources.shared import literal


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``Directory, FileName, path`` of every csv file under a folder; contents are not read.

    A folder whose own name ends in ``.csv`` is listed as one file: a table written by many tasks, each
    of whose files has the header and the closing quote of its own.
    """
    paths = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("recursiveFileLookup", True)
        .load(literal(root))
        .select(F.regexp_replace("path", r"(?i)(/[^/]*\.csv)/[^/]*$", "$1").alias("path"))
        .distinct()
    )
    return paths.select(
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("Directory"),
        F.substring_index("path", "/", -1).alias("FileName"),
        "path",
    )


def is_folder(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()


def marker_files(listing: DataFrame, schema: str, table: str) -> DataFrame:
    """The file that stands for its extract in each folder, in folder order."""
    marker = f"{schema}_{table}".lower()
    return listing.where(F.lower("FileName").contains(marker)).orderBy("Directory", "FileName")


def discover_extracts(spark: SparkSession, root: str, schema: str, table: str) -> DataFrame:
    """Folder, marker file and parsed name of every extract under a root, in folder order."""
    found = marker_files(list_files(spark, root), schema, table)
    return with_parsed_name(found.select("Directory", "FileName"), "FileName")


def extract_files(
    listing: DataFrame, start: int, end: int, date: datetime, agreement: str, registry: Registry
) -> DataFrame:
    """``TableName, path`` of the files of one extract.

    Files are matched on ids, date and agreement, whatever the case of the letters.
    """
    known = F.create_map(
        *[x for t in registry.tables for x in (F.lit(t.name.lower()), F.lit(t.name))]
    )
    named = with_parsed_name(listing.select("path", "FileName"), "FileName").where(
        (F.col("ProcessingIdStart") == start)
        & (F.col("ProcessingIdEnd") == end)
        & (F.col("ExtractDate") == F.lit(date).cast("timestamp_ntz"))
        & (F.col("SharingAgreementGuid") == agreement)
    )
    table = F.lower(F.concat("SchemaName", F.lit("_"), F.col("TableName")))
    return named.select(F.try_element_at(known, table).alias("TableName"), "path").where(
        F.col("TableName").isNotNull()
    )
