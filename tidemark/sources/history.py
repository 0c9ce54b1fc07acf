"""The store: histories of the extract tables and the small control tables.

``<root>/history/<table>/ExtractId=n`` holds the rows that came with extract n. The practice is a
column, by which the files of an extract are clustered: a folder per practice and extract would make
millions of small files, while file statistics skip other practices as well.

An install writes its folders whole and only then adds its line to ``InstalledExtracts``. Readers
look at committed extracts alone, so a broken install is invisible and rerunning it replaces its
folders. The lists of practices and the column layout are snapshots under the same rule.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.tenants import PRACTICE_SCHEMA
from tidemark.operators.versioned import latest_rows
from tidemark.registry import PRACTICE, TENANT, VERSION, Registry, Table

_STAGED = (
    "FileDirectory string, ProcessingIdStart int, ProcessingIdEnd int, "
    "ExtractDate timestamp_ntz, SharingAgreementGuid string, FilenameTemplate string, "
    "StagedDate timestamp_ntz"
)

# The columns of the control tables.
CONTROL = {
    "StagedExtract": _STAGED,
    "InstalledExtracts": f"ExtractId int, {_STAGED}, InstalledDated timestamp_ntz",
    "ConfiguredPractices": PRACTICE_SCHEMA,
    "SharingOrganisations": (
        "OrganisationGuid string, HaveDetails boolean, IsInstalled boolean, CDB string, "
        "OrganisationName string, ODSCode string, PracticeDBName string"
    ),
    "TableLayout": "TableName string, Position int, ColumnName string",
    "SavedStates": "TableName string, AsOfExtract int",
    "ClusteredHistories": "TableName string, AsOfExtract int",
    "Run": "RunId int, PracticeDBName string, ExtractId int, RunDate timestamp_ntz, RunGroupId int",
    "RunText": "RunId int, LineId int, Line string",
    "OrphanValues": "ForeignKeyId int, scope string, Value string, Count long",
    "ForeignKeyErrors": "RunId int, ForeignKeyId int, Count long, DistinctCount long",
    "KeyIndex": "Target string, scope string, Value string, ExtractId int",
    "StandingOrphans": (
        "ForeignKeyId int, scope string, Value string, Count long, ExtractId int"
    ),
    "CheckedExtracts": "ExtractId int, Collation string",
    "CodeCounts": (
        "TableName string, practice string, CodeId string, MostRecentDate timestamp_ntz, CodeCount long"
    ),
    "CountedExtracts": "TableName string, ExtractId int",
    "InstallCounts": "ExtractId int, TableName string, practice string, Rows long",
    "InstallTimes": "ExtractId int, TableName string, Rows long, Seconds double",
}
SMALL = {
    "StagedExtract", "InstalledExtracts", "TableLayout", "SavedStates", "CheckedExtracts",
    "CountedExtracts", "InstallTimes", "ClusteredHistories",
}
_SNAPSHOT = [("AsOfExtract", T.IntegerType()), ("Revision", T.IntegerType())]


def control_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/control/{name}"


def history_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/history/{table}"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_control(spark: SparkSession, root: str, name: str) -> DataFrame:
    schema = T.StructType.fromDDL(CONTROL[name])
    return _read(spark, control_path(root, name), schema).select(*schema.names)


def append_control(df: DataFrame, root: str, name: str) -> None:
    _conformed(df, name).write.mode("append").parquet(control_path(root, name))


def write_batch(df: DataFrame, root: str, name: str, batch: int | str) -> None:
    """Add a batch of rows, replacing what an earlier attempt at the same batch left."""
    path = f"{control_path(root, name)}/Batch={batch}"
    _conformed(df, name).write.mode("overwrite").parquet(path)


def read_batch(spark: SparkSession, root: str, name: str, batch: int | str) -> DataFrame:
    """The rows of one batch, listed or not."""
    schema = T.StructType.fromDDL(CONTROL[name])
    return _read(spark, f"{control_path(root, name)}/Batch={batch}", schema)


def replace_control(df: DataFrame, root: str, name: str) -> None:
    """Replace a control table by rows that do not come from it."""
    _conformed(df, name).write.mode("overwrite").parquet(control_path(root, name))


def _conformed(df: DataFrame, name: str) -> DataFrame:
    schema = T.StructType.fromDDL(CONTROL[name])
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    # One file for tables of a few rows; the others grow with practices and are only packed.
    return rows.coalesce(1) if name in SMALL else rows.hint("rebalance")


def claim(spark: SparkSession, root: str, name: str, number: int, content: str) -> str:
    """Take a number for good: what its claim says, which is ``content`` if nobody had it before.

    The claim is a file that is created only if it is absent, so of two jobs that want the same number
    one gets it.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{control_path(root, 'Claims')}/{name}={number}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path.getParent())
    try:
        out = files.create(path, False)
    except Py4JJavaError as taken:
        if "AlreadyExists" not in taken.java_exception.getClass().getName():
            raise
        return _claimed(spark, files, path)
    out.write(bytearray(content.encode()))
    out.close()
    return content


def _claimed(spark: SparkSession, files, path) -> str:
    """The content of a claim; whoever holds it may still be writing it."""
    for _ in range(50):
        if files.getFileStatus(path).getLen():
            break
        time.sleep(0.1)
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def claim_numbers(spark: SparkSession, root: str, name: str, first: int, count: int) -> int:
    """The first of ``count`` numbers from ``first`` on that no other job has or gets."""
    own = uuid.uuid4().hex
    while True:
        held = claim(spark, root, name, first, f"{count} {own}")
        if held == f"{count} {own}":
            return first
        first += max(1, int((held.split() or ["0"])[0]))


def last_installed(spark: SparkSession, root: str) -> int | None:
    log = read_control(spark, root, "InstalledExtracts")
    return log.agg(F.max("ExtractId")).first()[0]


def write_snapshot(df: DataFrame, root: str, name: str, extract: int, revision: int = 0) -> None:
    path = f"{control_path(root, name)}/AsOfExtract={extract}/Revision={revision}"
    _conformed(df, name).write.mode("overwrite").parquet(path)


def snapshot_version(
    spark: SparkSession, root: str, name: str, installed: int | None
) -> tuple[int, int] | None:
    """The newest snapshot that belongs to a committed extract."""
    newest = (
        _snapshots(spark, root, name)
        .where(F.col("AsOfExtract") <= (installed or 0))
        .agg(F.max(F.struct("AsOfExtract", "Revision")))
        .first()[0]
    )
    return tuple(newest) if newest else None


def read_snapshot(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = snapshot_version(spark, root, name, last_installed(spark, root))
    return snapshot_of(spark, root, name, *(version or (-1, -1)))


def snapshot_of(
    spark: SparkSession, root: str, name: str, extract: int, revision: int = 0
) -> DataFrame:
    """One snapshot, committed or not."""
    rows = _snapshots(spark, root, name)
    return rows.where((F.col("AsOfExtract") == extract) & (F.col("Revision") == revision)).drop(
        "AsOfExtract", "Revision"
    )


def _snapshots(spark: SparkSession, root: str, name: str) -> DataFrame:
    schema = T.StructType.fromDDL(CONTROL[name])
    for column, kind in _SNAPSHOT:
        schema = schema.add(column, kind)
    return _read(spark, control_path(root, name), schema)


def read_layout(spark: SparkSession, root: str, registry: Registry) -> Registry:
    """The registry with the column layout of the store, if one is installed already."""
    layout: dict[str, list[str]] = {}
    for row in read_snapshot(spark, root, "TableLayout").orderBy("TableName", "Position").collect():
        layout.setdefault(row.TableName, []).append(row.ColumnName)
    return registry.with_layout(layout)


def layout_rows(spark: SparkSession, registry: Registry) -> DataFrame:
    rows = [(t.name, i, c) for t in registry.tables for i, c in enumerate(t.columns)]
    return spark.createDataFrame(rows, CONTROL["TableLayout"])


def write_extract(df: DataFrame, root: str, table: Table, extract: int) -> None:
    """Write the rows of one extract, replacing what an earlier attempt left.

    Practice tables are rebalanced by practice first: small practices share a file, a large one is
    split over several, and all files have a sensible size whatever the number of practices.
    """
    if table.kind == PRACTICE:
        df = df.hint("rebalance", TENANT).sortWithinPartitions(TENANT)
    df.write.mode("overwrite").parquet(f"{history_path(root, table.name)}/{VERSION}={extract}")


def read_extract(
    spark: SparkSession, root: str, table: Table, extract: int, extra: T.StructType
) -> DataFrame:
    """What an install wrote for one table, committed or not, with the extra columns it kept.

    Only the folder of that extract is listed.
    """
    schema = T.StructType(extra.fields + table.history_schema.fields)
    base = history_path(root, table.name)
    return (
        spark.read.schema(schema)
        .option("basePath", base)
        .parquet(f"{base}/{VERSION}={extract}")
        .withColumn(VERSION, F.lit(extract))
    )


def read_history(
    spark: SparkSession, root: str, table: Table, installed: int | None = None
) -> DataFrame:
    """All committed versions of a table, in declared column order with the version last."""
    if installed is None:
        installed = last_installed(spark, root)
    rows = _read(spark, history_path(root, table.name), table.history_schema)
    rows = rows.where(F.col(VERSION) <= (installed or 0))
    if table.kind == PRACTICE:
        # Rows of join-routed tables that found no practice are kept apart, never read.
        rows = rows.where(F.col(TENANT).isNotNull())
    return rows.select(*table.history_schema.names)


def state_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/state/{table}"


def save_state(spark: SparkSession, root: str, table: Table, extract: int) -> None:
    """Write the newest rows of every key as of a committed extract, deleted ones included.

    Deleted rows stay, so that no older version of their key comes back when later extracts are laid
    over the state. The state is listed last: one that was not written whole is never read.
    """
    keys = table.scoped_keys(table.history_schema.names)
    if not keys:
        raise ValueError(f"{table.name} has no key: all its rows are its state")
    if extract > (last_installed(spark, root) or 0):
        raise ValueError(f"extract {extract} is not installed")
    rows = latest_rows(recent_history(spark, root, table, extract), keys, extract)
    if table.kind == PRACTICE:
        rows = rows.hint("rebalance", TENANT).sortWithinPartitions(TENANT)
    rows.write.mode("overwrite").parquet(f"{state_path(root, table.name)}/AsOfExtract={extract}")
    entry = spark.createDataFrame([(table.name, extract)], CONTROL["SavedStates"])
    append_control(entry, root, "SavedStates")


def recent_history(
    spark: SparkSession, root: str, table: Table, extract: int | None = None
) -> DataFrame:
    """What :func:`as_of` needs for an extract (``None``: the newest): a saved state and what followed.

    The newest saved state up to the extract takes the place of all extracts it covers; only the later
    partitions of the history are listed and read. Without one this is the whole history.
    """
    installed = last_installed(spark, root) or 0
    upto = installed if extract is None else min(extract, installed)
    states = read_control(spark, root, "SavedStates").where(
        (F.col("TableName") == table.name) & (F.col("AsOfExtract") <= upto)
    )
    saved = states.agg(F.max("AsOfExtract")).first()[0]
    history = read_history(spark, root, table, installed)
    if saved is None:
        return history.where(F.col(VERSION) <= upto)
    state = spark.read.schema(table.history_schema).parquet(
        f"{state_path(root, table.name)}/AsOfExtract={saved}"
    )
    later = history.where((F.col(VERSION) > saved) & (F.col(VERSION) <= upto))
    return state.select(*later.columns).unionByName(later)


def recent_histories(
    spark: SparkSession, root: str, registry: Registry, extract: int | None = None
) -> dict[str, DataFrame]:
    return {t.name: recent_history(spark, root, t, extract) for t in registry.tables}


def read_histories(spark: SparkSession, root: str, registry: Registry) -> dict[str, DataFrame]:
    installed = last_installed(spark, root)
    return {t.name: read_history(spark, root, t, installed) for t in registry.tables}


def save_bucketed(df: DataFrame, table: Table, name: str, buckets: int, path: str) -> None:
    """Save a history bucketed and sorted on its keys, so that as-of reads in place never shuffle.

    Worth it for tables read far more often than installed; a key with a large share of the rows
    ends up in one bucket, so use the plain layout for those.
    """
    keys = table.scoped_keys(df.columns)
    if not keys:
        raise ValueError(f"{table.name} has no key to bucket on")
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys, VERSION)
        .option("path", path)
        .format("parquet")
        .saveAsTable(name)
    )
