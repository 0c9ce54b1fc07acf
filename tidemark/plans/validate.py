"""Validation runs: check every foreign key of every practice and keep the outcome."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark import care_records
from tidemark.operators.constraints import CONTROL_RULES, check_constraints
from tidemark.operators.integrity import (
    EVERYWHERE,
    orphan_samples,
    orphan_totals,
    orphan_values,
    orphan_values_as_of,
)
from tidemark.operators.report import report_lines
from tidemark.operators.results import fk_results, select_runs
from tidemark.operators.standing import arriving_keys, arriving_orphans, standing_values
from tidemark.registry import VERSION, Registry
from tidemark.sources import history as store


class ValidationError(Exception):
    """The run cannot start."""


@dataclass(frozen=True)
class Validation:
    runs: DataFrame
    errors: DataFrame
    samples: DataFrame
    lines: DataFrame
    skipped: DataFrame
    group: int | None


def plan_runs(
    practices: DataFrame, extract: int, first_run: int, group: int | None, now: datetime
) -> tuple[DataFrame, DataFrame]:
    """One run per practice that has started by the extract, and the practices that have not."""
    started = F.coalesce(F.col("StartExtractId") <= extract, F.lit(False))
    # One row per practice: a global order over the tenant list, not over data.
    order = Window.orderBy("StartExtractId", "PracticeName", "PracticeDBName")
    runs = practices.where(started).select(
        (F.row_number().over(order) + (first_run - 1)).alias("RunId"),
        "PracticeDBName",
        F.lit(extract).alias("ExtractId"),
        F.lit(now).cast("timestamp_ntz").alias("RunDate"),
        F.lit(group).cast("int").alias("RunGroupId"),
        "PracticeName",
        "ODSCode",
    )
    skipped = practices.where(~started).select(
        "PracticeDBName",
        F.when(
            F.col("StartExtractId").isNotNull(),
            F.concat(F.lit("starts with extract "), F.col("StartExtractId").cast("string")),
        ).otherwise("has no extract yet").alias("Reason"),
    )
    return runs, skipped


def per_run(runs: DataFrame, by_scope: DataFrame) -> DataFrame:
    """Outcomes by scope as outcomes by run: each run sees its practice and the common tables.

    If the outcomes tell their extract (``AsOfExtract``), each run sees those as of its own.
    """
    both = F.array("PracticeDBName", F.lit(EVERYWHERE))
    scopes = runs.select("RunId", F.col(VERSION).alias("AsOfExtract"), F.explode(both).alias("scope"))
    same = [c for c in ("scope", "AsOfExtract") if c in by_scope.columns]
    return scopes.select("RunId", *same).join(by_scope, same).drop("scope", "AsOfExtract")


def check_new_extracts(
    spark: SparkSession,
    root: str,
    registry: Registry = care_records.CARE_RECORDS,
    *,
    collation: str | None = None,
) -> list[int]:
    """Check the foreign keys of the extracts installed since the last time, one after the other.

    Each extract is read alone, and the keys that earlier ones brought from the index of them. Its new keys
    and its orphans are stored as a batch each, and the extract is listed as checked last: a job that breaks
    leaves nothing that is read, and the next one does that extract again. The collation is the
    store's: another one than the first time is refused. Returns the extracts that were checked.
    """
    registry = store.read_layout(spark, root, registry)
    # One row per extract.
    installed = store.read_control(spark, root, "InstalledExtracts").select(VERSION).collect()
    listed = store.read_control(spark, root, "CheckedExtracts").collect()
    if any((r.Collation or None) != collation for r in listed):
        raise ValidationError("the extracts so far were checked with another collation")
    last = max((r[VERSION] for r in listed), default=0)
    done = []
    for extract in sorted(r[VERSION] for r in installed if r[VERSION] > last):
        rows = {
            name: df.where(F.col(VERSION) == extract)
            for name, df in store.read_histories(spark, root, registry).items()
        }
        earlier = store.read_control(spark, root, "KeyIndex").where(F.col(VERSION) < extract)
        new = arriving_keys(rows, registry, earlier, extract, collation)
        store.write_batch(new, root, "KeyIndex", extract)
        known = store.read_control(spark, root, "KeyIndex").where(F.col(VERSION) <= extract)
        found = arriving_orphans(rows, registry, known, extract, collation)
        store.write_batch(found, root, "StandingOrphans", extract)
        line = spark.createDataFrame([(extract, collation)], store.CONTROL["CheckedExtracts"])
        store.write_batch(line, root, "CheckedExtracts", extract)
        done.append(extract)
    return done


def standing_orphans(spark: SparkSession, root: str) -> DataFrame:
    """The orphans of all extracts that are listed as checked."""
    checked = store.read_control(spark, root, "CheckedExtracts").agg(F.max(VERSION)).first()[0]
    orphans = store.read_control(spark, root, "StandingOrphans")
    return orphans.where(F.col(VERSION) <= (checked or 0))


def validate_practices(
    spark: SparkSession,
    root: str,
    registry: Registry = care_records.CARE_RECORDS,
    *,
    practice: str | None = None,
    extract: int | None = None,
    bound: int | None = None,
    mode: str = "history",
    collation: str | None = None,
    now: datetime | None = None,
) -> Validation:
    """Validate one practice, or all of them as a new run group.

    ``extract`` labels the run and decides which practices take part; the check itself looks at the
    whole history unless ``bound`` limits it. With ``mode='as_of'`` it looks at the state as of the
    extract instead, on both sides. With ``mode='standing'`` the outcome is that of the whole history (or
    up to ``bound``), but only extracts that were not checked yet are read. All practices and keys are checked by one plan, whose
    orphan values are written once and then counted and sampled.
    """
    if mode not in ("history", "as_of", "standing"):
        raise ValueError("mode is 'history', 'as_of' or 'standing'")
    installed = store.read_control(spark, root, "InstalledExtracts")
    if extract is None:
        extract = store.last_installed(spark, root)
    found = installed.where(F.col("ExtractId") == extract).select("ExtractDate").first()
    if found is None:
        raise ValidationError(f"extract {extract} is not installed")
    registry = store.read_layout(spark, root, registry)
    practices = store.read_snapshot(spark, root, "ConfiguredPractices")
    past = store.read_control(spark, root, "Run").agg(F.max("RunId"), F.max("RunGroupId")).first()
    group = None if practice else (past[1] or 0) + 1
    if practice:
        practices = practices.where(F.col("PracticeDBName") == practice)
        if practices.isEmpty():
            raise ValidationError(f"practice {practice} is not configured")
    # A run has its number for good, whether or not it succeeds, like any identity column.
    first_run = store.claim_numbers(
        spark, root, "Run", (past[0] or 0) + 1, max(1, practices.count())
    )
    runs, skipped = plan_runs(practices, extract, first_run, group, now or datetime.now())
    if practice and runs.isEmpty():
        raise ValidationError(f"practice {practice} {skipped.first().Reason}")

    histories = {}
    if mode == "standing":
        check_new_extracts(spark, root, registry, collation=collation)
    elif mode == "as_of":
        histories = store.recent_histories(spark, root, registry, extract)
    else:
        histories = store.read_histories(spark, root, registry)
    if practice:
        histories = {
            name: df.where(F.col("practice") == practice) if "practice" in df.columns else df
            for name, df in histories.items()
        }
    # All orphan values of the batch: counted, sampled and kept for looking closer.
    values_path = f"{store.control_path(root, 'OrphanValues')}/Batch={first_run}"
    if mode == "standing":
        found_values = standing_values(standing_orphans(spark, root), bound, collation)
        if practice:
            found_values = found_values.where(F.col("scope").isin(practice, EVERYWHERE))
    elif mode == "as_of":
        found_values = orphan_values_as_of(histories, registry, extract, collation=collation)
    else:
        found_values = orphan_values(histories, registry, bound=bound, collation=collation)
    found_values.write.mode("overwrite").parquet(values_path)
    values = spark.read.schema(store.CONTROL["OrphanValues"]).parquet(values_path)

    errors = per_run(runs, orphan_totals(values))
    samples = per_run(
        runs, orphan_samples(values, "Value", by=["ForeignKeyId", "scope"])
    )
    about = runs.withColumn("ExtractDate", F.lit(found.ExtractDate).cast("timestamp_ntz"))
    lines = report_lines(about, errors, samples, registry.foreign_key_frame(spark))

    # The runs come last: a run whose errors or lines are missing is never listed.
    store.write_batch(errors, root, "ForeignKeyErrors", first_run)
    store.write_batch(lines, root, "RunText", first_run)
    _check_batch(spark, root, runs, installed, first_run)
    store.write_batch(runs, root, "Run", first_run)
    return Validation(runs, errors, samples, lines, skipped, group)


def _check_batch(
    spark: SparkSession, root: str, runs: DataFrame, installed: DataFrame, batch: int
) -> None:
    """The control rules over what is about to be listed, and over the runs listed already."""
    listed = store.read_control(spark, root, "Run")
    tables = {
        "Run": runs.select(*listed.columns).unionByName(listed),
        "RunText": store.read_batch(spark, root, "RunText", batch),
        "ForeignKeyErrors": store.read_batch(spark, root, "ForeignKeyErrors", batch),
        "ConfiguredPractices": store.read_snapshot(spark, root, "ConfiguredPractices"),
        "InstalledExtracts": installed,
    }
    rules = {name: CONTROL_RULES[name] for name in ("Run", "RunText", "ForeignKeyErrors")}
    broken = check_constraints(tables, rules).where("Violations > 0").collect()
    if broken:
        raise ValidationError(
            "the runs break the rule(s): "
            + "; ".join(sorted(f"{r.TableName}: {r.Rule}" for r in broken))
        )


def compare_runs(
    spark: SparkSession,
    root: str,
    registry: Registry = care_records.CARE_RECORDS,
    *,
    distinct: bool = False,
    use_name: bool = False,
    cdb: int | None = None,
    group: int | None = None,
    comparison_group: int | None = None,
) -> DataFrame:
    """The report over stored runs: a column per run, with the change since the compared group."""
    runs = store.read_control(spark, root, "Run")
    selected = select_runs(
        runs,
        store.read_snapshot(spark, root, "ConfiguredPractices"),
        cdb=cdb,
        group=group,
        comparison_group=comparison_group,
        use_name=use_name,
    )
    errors = store.read_control(spark, root, "ForeignKeyErrors").join(
        runs.select("RunId"), "RunId", "left_semi"
    )
    return fk_results(errors, registry.foreign_key_frame(spark), selected, distinct=distinct)
