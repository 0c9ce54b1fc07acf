"""Staging and installing an extract."""

from __future__ import annotations

import logging
import time
from collections.abc import Collection, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from tidemark import care_records
from tidemark.functions.keys import tenant_key
from tidemark.functions.names import name_template, with_parsed_name
from tidemark.operators import routing, tenants
from tidemark.operators.constraints import CONTROL_RULES, check_constraints, repeated_keys
from tidemark.operators.versioned import current
from tidemark.registry import TENANT, VERSION, Registry, Table
from tidemark.sources import history as store
from tidemark.sources.discover import discover_extracts, extract_files, is_folder, list_files
from tidemark.sources.quoted_text import (
    FILE,
    FLAGS,
    QUOTED,
    RAGGED,
    REPEATED,
    WIDE,
    Shape,
    quote_counts,
    read_extract_table,
    read_shape,
)
from tidemark.sources.recovery import read_aligned_table

log = logging.getLogger(__name__)

_KEPT = T.StructType([T.StructField(f, T.BooleanType()) for f in FLAGS])


class ExtractError(Exception):
    """An extract was refused; the store is as it was."""


@dataclass(frozen=True)
class Special:
    """The tables the install itself looks into."""

    marker_schema: str = care_records.MARKER_SCHEMA
    marker_table: str = care_records.MARKER_TABLE
    sharing: str = care_records.SHARING
    organisation: str = care_records.ORGANISATION
    store_prefix: str = "Practice"


@dataclass(frozen=True)
class Installed:
    extract: int
    counts: DataFrame
    discarded: Mapping[str, int]


def stage_extract(
    spark: SparkSession,
    root: str,
    directory: str,
    marker: str,
    registry: Registry = care_records.CARE_RECORDS,
    special: Special = Special(),
    now: datetime | None = None,
) -> Row:
    """Check the name and completeness of an extract and record it as the one staged.

    Nothing is copied: the files are read when the extract is installed.
    """
    if not store.read_control(spark, root, "StagedExtract").isEmpty():
        raise ExtractError("an extract is already staged; install it or clean staging first")
    one = spark.createDataFrame([(marker,)], "FileName string")
    name = (
        with_parsed_name(one, "FileName")
        .withColumn(
            "FilenameTemplate",
            name_template(
                F.col("ProcessingIdStart"), F.col("ProcessingIdEnd"),
                F.col("ExtractDateString"), F.col("SharingAgreementGuid"),
            ),
        )
        .first()
    )
    if name.parse_error:
        raise ExtractError(f"{marker}: {name.parse_error}")
    found = f"{name.SchemaName}_{name.TableName}".lower()
    if found != f"{special.marker_schema}_{special.marker_table}".lower():
        raise ExtractError(
            f"{marker}: not the {special.marker_schema}_{special.marker_table} file"
        )
    files = _table_files(spark, directory, name, registry)
    missing = sorted({t.name for t in registry.tables} - set(files))
    if missing:
        raise ExtractError(f"no file for table(s) {', '.join(missing)}")
    staged = Row(
        FileDirectory=directory,
        ProcessingIdStart=name.ProcessingIdStart,
        ProcessingIdEnd=name.ProcessingIdEnd,
        ExtractDate=name.ExtractDate,
        SharingAgreementGuid=name.SharingAgreementGuid,
        FilenameTemplate=name.FilenameTemplate,
        StagedDate=now or datetime.now(),
    )
    store.replace_control(
        spark.createDataFrame([staged], store.CONTROL["StagedExtract"]), root, "StagedExtract"
    )
    log.info("staged %s", name.FilenameTemplate)
    return staged


def staged_tables(
    spark: SparkSession, root: str, registry: Registry = care_records.CARE_RECORDS
) -> dict[str, DataFrame]:
    """The tables of the staged extract as they would be installed, for a look before."""
    staged = store.read_control(spark, root, "StagedExtract").first()
    if staged is None:
        raise ExtractError("no extract is staged")
    _, tables, _ = _staged_rows(spark, root, staged, registry)
    return {name: rows.drop(FILE, *FLAGS) for name, rows in tables.items()}


def clean_staging(spark: SparkSession, root: str) -> None:
    nothing = spark.createDataFrame([], store.CONTROL["StagedExtract"])
    store.replace_control(nothing, root, "StagedExtract")


def configure_practice(
    spark: SparkSession,
    root: str,
    cdb: int,
    name: str,
    ods_code: str,
    organisation: str,
    special: Special = Special(),
) -> None:
    """Add a practice by hand; it starts with the next extract installed."""
    installed = store.last_installed(spark, root)
    practices = store.read_snapshot(spark, root, "ConfiguredPractices")
    row = spark.createDataFrame(
        [
            (organisation, name, ods_code, cdb, f"{special.store_prefix}{cdb}", None, True,
             installed)
        ],
        store.CONTROL["ConfiguredPractices"],
    )
    if not tenants.already_configured(practices, row).isEmpty():
        raise ExtractError("the practice is already configured")
    version = store.snapshot_version(spark, root, "ConfiguredPractices", installed)
    extract, revision = version or (installed or 0, -1)
    store.write_snapshot(
        practices.unionByName(row), root, "ConfiguredPractices", extract, revision + 1
    )


def install_extract(
    spark: SparkSession,
    root: str,
    registry: Registry = care_records.CARE_RECORDS,
    special: Special = Special(),
    now: datetime | None = None,
) -> Installed:
    """Install the staged extract.

    Rows are read, repaired, routed and written once, under the id of the new extract. What was
    written is then checked from a few narrow columns. Only if every check passes is the extract
    added to the log, which makes it visible.
    """
    gate = tenants.install_gate(
        store.read_control(spark, root, "StagedExtract"),
        store.read_control(spark, root, "InstalledExtracts"),
    )
    staged = gate.first()
    if staged is None:
        raise ExtractError("no extract is staged")
    if _is_installed(spark, root, staged):
        # A stop between the log line and this: the install itself was complete.
        clean_staging(spark, root)
        raise ExtractError(f"{staged.FilenameTemplate} is installed already")
    if staged.Problem:
        raise ExtractError(staged.Problem)
    previous, extract = staged.PreviousExtractId, staged.NextExtractId

    registry, rows, several = _staged_rows(spark, root, staged, registry)
    _check_files({name: rows[name] for name in several})

    # Common tables go first: the sharing organisations are then read back from what was written.
    seconds: dict[str, float] = {}
    for table in registry.select(practice=False):
        seconds[table.name] = _write(rows[table.name], root, table, extract)
    common = {
        t.name: store.read_extract(spark, root, t, extract, _KEPT)
        for t in registry.select(practice=False)
    }
    held = _check_rows(common, several)

    # Both tenant lists are written as part of this extract and read back: small tables, fixed.
    practices = _practices_for(spark, root, registry, special, extract, previous)
    organisations = _organisations(spark, root, registry, special, extract, practices)
    store.write_snapshot(organisations, root, "SharingOrganisations", extract)
    organisations = store.snapshot_of(spark, root, "SharingOrganisations", extract)
    # By the key that rows are routed by: two spellings of one organisation would double its rows.
    spelled = organisations.select(tenant_key("OrganisationGuid").alias("OrganisationGuid"))
    if not repeated_keys(spelled, ["OrganisationGuid"]).isEmpty():
        raise ExtractError("an organisation is described or shared more than once")
    installed = routing.installed_practices(organisations)

    routed: dict[str, DataFrame] = {}
    in_order = sorted(registry.select(common=False), key=lambda t: t.via is not None)
    for table in in_order:
        parent = None
        if table.via:
            # Parents are read back from their written rows, practice already attached.
            parent = store.read_extract(
                spark, root, registry.table(table.via.parent), extract, _KEPT
            )
        seconds[table.name] = _write(
            routing.route_rows(rows[table.name], table, installed, parent), root, table, extract
        )
        routed[table.name] = store.read_extract(spark, root, table, extract, _KEPT)
    read = _rows_read({t.name: rows[t.name] for t in in_order})
    tallies = _tallies(routed)
    # A row routed through a parent sent twice is there twice: those tables are checked as read.
    doubled = {
        t.name: rows[t.name]
        for t in in_order
        if t.via and t.name in tallies and tallies[t.name].n != read.get(t.name, 0)
    }
    _check_tallies(tallies | _tallies(doubled), several)

    # Counted once from what was written and kept with the extract, so checks and reports read the counts.
    store.write_batch(
        _counts(routed).withColumn(VERSION, F.lit(extract)), root, "InstallCounts", extract
    )
    counts = store.read_batch(spark, root, "InstallCounts", extract).drop(VERSION)
    _check_complete({t.name: read.get(t.name, 0) for t in in_order if not t.via}, counts)
    left = {
        r.TableName: r.Rows for r in counts.where(F.col(TENANT).isNull()).collect()
    }
    joined = {t.name for t in in_order if t.via}
    stuck = [f"{n} row(s) in {t}" for t, n in sorted(left.items()) if t not in joined]
    if stuck:
        raise ExtractError("rows of no configured, sharing practice: " + "; ".join(stuck))

    held |= {
        r.TableName: r.n for r in counts.groupBy("TableName").agg(F.sum("Rows").alias("n")).collect()
    }
    times = [(extract, name, held.get(name, 0), taken) for name, taken in seconds.items()]
    store.write_batch(
        spark.createDataFrame(times, store.CONTROL["InstallTimes"]), root, "InstallTimes", extract
    )
    if previous is None:
        store.write_snapshot(store.layout_rows(spark, registry), root, "TableLayout", extract)
    if store.claim(spark, root, "Extract", extract, staged.FilenameTemplate) != (
        staged.FilenameTemplate
    ):
        raise ExtractError(f"another extract is being installed as number {extract}")
    entry = gate.select(
        F.lit(extract).alias(VERSION),
        *T.StructType.fromDDL(store.CONTROL["StagedExtract"]).names,
        F.lit(now or datetime.now()).alias("InstalledDated"),
    )
    store.append_control(entry, root, "InstalledExtracts")
    clean_staging(spark, root)
    log.info("installed extract %d", extract)
    return Installed(
        extract,
        counts.where(F.col(TENANT).isNotNull()),
        {t: n for t, n in left.items() if t in joined},
    )


def install_all(
    spark: SparkSession,
    root: str,
    folder: str,
    registry: Registry = care_records.CARE_RECORDS,
    special: Special = Special(),
) -> list[Installed]:
    """Stage and install every extract under a folder that is not installed yet, in folder order.

    A rerun goes on where an earlier one stopped: what is in the log is skipped, a staged extract
    that is in the log already is cleaned away. A refused extract stops the rest and stays unstaged.
    """
    found = discover_extracts(spark, folder, special.marker_schema, special.marker_table)
    waiting = store.read_control(spark, root, "StagedExtract").first()
    if waiting is not None and _is_installed(spark, root, waiting):
        clean_staging(spark, root)
    done = []
    for extract in found.select("Directory", "FileName").collect():
        staged = stage_extract(
            spark, root, extract.Directory, extract.FileName, registry, special
        )
        if _is_installed(spark, root, staged):
            log.info("%s is installed already", staged.FilenameTemplate)
            clean_staging(spark, root)
            continue
        try:
            done.append(install_extract(spark, root, registry, special))
        except ExtractError:
            clean_staging(spark, root)
            raise
    return done


def install_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows per installed extract, practice table and practice; without a practice: discarded ones."""
    return _of_installed(spark, root, "InstallCounts")


def install_times(spark: SparkSession, root: str) -> DataFrame:
    """Rows written per installed extract and table, and the seconds that took.

    Reading, repairing and routing happen as part of the write, so the seconds are those of all three.
    """
    return _of_installed(spark, root, "InstallTimes")


def _of_installed(spark: SparkSession, root: str, name: str) -> DataFrame:
    log_lines = store.read_control(spark, root, "InstalledExtracts").select(VERSION)
    return store.read_control(spark, root, name).join(log_lines, VERSION, "left_semi")


def _is_installed(spark: SparkSession, root: str, staged: Row) -> bool:
    """Whether the log has an extract of the same name."""
    installed = store.read_control(spark, root, "InstalledExtracts")
    same = F.upper("FilenameTemplate") == staged.FilenameTemplate.upper()
    return not installed.where(same).isEmpty()


def save_states(
    spark: SparkSession,
    root: str,
    registry: Registry = care_records.CARE_RECORDS,
    extract: int | None = None,
) -> list[str]:
    """Save the state of every keyed table as of an extract (the last one installed).

    Worth it every so many extracts: reads of the current state then skip all earlier ones. A saved
    state starts from the one before it. Returns the tables saved.
    """
    extract = store.last_installed(spark, root) if extract is None else extract
    if extract is None:
        raise ExtractError("no extract is installed")
    registry = store.read_layout(spark, root, registry)
    keyed = [t for t in registry.tables if t.keys]
    for table in keyed:
        store.save_state(spark, root, table, extract)
    return [t.name for t in keyed]


def _table_files(
    spark: SparkSession, directory: str, name: Row, registry: Registry
) -> dict[str, str]:
    found = extract_files(
        list_files(spark, directory),
        name.ProcessingIdStart,
        name.ProcessingIdEnd,
        name.ExtractDate,
        name.SharingAgreementGuid,
        registry,
    ).collect()
    files = {r.TableName: r.path for r in found}
    if len(files) < len(found):
        raise ExtractError(f"{directory}: more than one file for a table")
    return files


def _agreed_layout(registry: Registry, shapes: Mapping[str, Shape]) -> Registry:
    """Take the layout from the first extract; hold every later one to it."""
    for table in registry.tables:
        if table.columns and table.columns != shapes[table.name].columns:
            raise ExtractError(f"{table.name}: the header does not match the column layout")
    try:
        return registry.with_layout({name: shape.columns for name, shape in shapes.items()})
    except ValueError as wrong:
        raise ExtractError(str(wrong)) from wrong


def _check_files(tables: Mapping[str, DataFrame]) -> None:
    """Tables of several files: each file with rows has its closing quote."""
    problems = [
        f"{name}: {row.Problem} in {row[FILE]}"
        for name, rows in sorted(tables.items())
        for row in quote_counts(rows).where("Problem is not null").orderBy(FILE).limit(10).collect()
    ]
    if problems:
        raise ExtractError("; ".join(problems))


def _check_rows(tables: Mapping[str, DataFrame], several: Collection[str]) -> dict[str, int]:
    """Count the rows with each flag and refuse what is wrong; returns the rows per table."""
    return _check_tallies(_tallies(tables), several)


def _tallies(tables: Mapping[str, DataFrame]) -> dict[str, Row]:
    """Rows and rows with each flag per table that has any; all tables in one job over the flag columns alone.

    Each table is counted by itself before the counts are put together: counting the union of all would put
    the readers of all tables into one piece of generated code, which is too long to be compiled.
    """
    if not tables:
        return {}
    counts = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count("*").alias("n"), *[F.count_if(f).alias(f) for f in FLAGS])
            .select(F.lit(name).alias("t"), "n", *FLAGS)
            for name, df in tables.items()
        ],
    )
    return {row.t: row for row in counts.where("n > 0").collect()}


def _check_tallies(tallies: Mapping[str, Row], several: Collection[str]) -> dict[str, int]:
    """Tables of ``several`` files have a closing quote in each; those are counted by file elsewhere."""
    problems, held = [], {}
    for _, row in sorted(tallies.items()):
        log.info("%s: %d row(s)", row.t, row.n)
        held[row.t] = row.n
        if row[REPEATED]:
            problems.append(f"{row.t}: a header appears among the rows")
        if row[RAGGED]:
            problems.append(f"{row.t}: {row[RAGGED]} row(s) with a wrong number of fields")
        if row[WIDE]:
            problems.append(f"{row.t}: {row[WIDE]} row(s) with a value longer than declared")
        if row[QUOTED] == 0:
            problems.append(f"{row.t}: no row contains a trailing quote")
        elif row[QUOTED] > 1 and row.t not in several:
            problems.append(f"{row.t}: more than one row contains a trailing quote")
    if problems:
        raise ExtractError("; ".join(problems))
    return held


def _rows_read(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows per table as the files hold them: reads them again, but cuts no record into fields."""
    if not tables:
        return {}
    counts = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count("*").alias("n")).select(F.lit(name).alias("t"), "n")
            for name, df in tables.items()
        ],
    )
    return {row.t: row.n for row in counts.collect()}


def _check_complete(read: Mapping[str, int], counts: DataFrame) -> None:
    """Routing neither doubles nor loses a row: as many were written as the files hold."""
    if not read:
        return
    wrote = counts.groupBy("TableName").agg(F.sum("Rows").alias("n"))
    written = {r.TableName: r.n for r in wrote.collect()}
    problems = [
        f"{n} row(s) of {name} became {written.get(name, 0)}"
        for name, n in sorted(read.items())
        if n != written.get(name, 0)
    ]
    if problems:
        raise ExtractError("; ".join(problems))


def _organisations(
    spark: SparkSession,
    root: str,
    registry: Registry,
    special: Special,
    extract: int,
    practices: DataFrame,
) -> DataFrame:
    organisation = registry.table(special.organisation)
    staged = store.read_extract(spark, root, organisation, extract, _KEPT)
    common = current(store.recent_history(spark, root, organisation, extract - 1), organisation)
    sharing = store.read_extract(spark, root, registry.table(special.sharing), extract, _KEPT)
    return tenants.staging_organisations(sharing, practices, staged, common)


def _practices_for(
    spark: SparkSession,
    root: str,
    registry: Registry,
    special: Special,
    extract: int,
    previous: int | None,
) -> DataFrame:
    """The practices as they will stand: known ones, new ones of this extract, all activated."""
    known = store.read_snapshot(spark, root, "ConfiguredPractices")
    found = tenants.new_practices(
        _organisations(spark, root, registry, special, extract, known),
        previous,
        special.store_prefix,
    )
    practices = tenants.activate_practices(known.unionByName(found), extract, previous)
    store.write_snapshot(practices, root, "ConfiguredPractices", extract)
    practices = store.snapshot_of(spark, root, "ConfiguredPractices", extract)
    extracts = store.read_control(spark, root, "InstalledExtracts").select(VERSION)
    tables = {
        "ConfiguredPractices": practices,
        "InstalledExtracts": extracts.unionByName(
            spark.createDataFrame([(extract,)], f"{VERSION} int")
        ),
    }
    rules = {"ConfiguredPractices": CONTROL_RULES["ConfiguredPractices"]}
    broken = check_constraints(tables, rules).where("Violations > 0").collect()
    if broken:
        raise ExtractError(
            "practices break the rule(s): " + "; ".join(sorted(r.Rule for r in broken))
        )
    return practices


def _counts(routed: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and practice of what was written."""
    return reduce(
        DataFrame.unionByName,
        [routing.counts_by_practice(rows, name) for name, rows in routed.items()],
    )


def _staged_rows(
    spark: SparkSession, root: str, staged: Row, registry: Registry
) -> tuple[Registry, dict[str, DataFrame], set[str]]:
    """The registry with its layout, the repaired, flagged rows of every staged file, and the names
    of the tables that come as a folder of files."""
    files = _table_files(spark, staged.FileDirectory, staged, registry)
    shapes = {name: read_shape(spark, path) for name, path in files.items()}
    registry = _agreed_layout(store.read_layout(spark, root, registry), shapes)
    return registry, {
        name: (read_aligned_table if registry.table(name).patterns else read_extract_table)(
            spark, path, registry.table(name), shapes[name]
        )
        for name, path in files.items()
    }, {name for name, path in files.items() if is_folder(spark, path)}


def _write(rows: DataFrame, root: str, table: Table, extract: int) -> float:
    """Write a table; returns the seconds it took."""
    start = time.monotonic()
    store.write_extract(rows.drop(FILE), root, table, extract)
    seconds = time.monotonic() - start
    log.info("%s: written in %.1fs", table.name, seconds)
    return seconds
