"""Practices: who shares data, who is new, who starts with this extract."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.keys import tenant_key

PRACTICE_SCHEMA = (
    "OrganisationGuid string, PracticeName string, ODSCode string, CDB int, "
    "PracticeDBName string, StartExtractId int, NewlyConfigured boolean, ConfiguredAfter int"
)


def staging_organisations(
    sharing: DataFrame, practices: DataFrame, staged: DataFrame, common: DataFrame
) -> DataFrame:
    """Every sharing organisation with what is known of it.

    Details come from the configured practices, else from the extract, else from the shared history.
    Agreements count whether or not they are flagged deleted or inactive.
    """

    def details(df: DataFrame, prefix: str, name: str, *more: str) -> DataFrame:
        return df.select(
            tenant_key("OrganisationGuid").alias("_org"),
            F.col("CDB").cast("string").alias(f"{prefix}CDB"),
            F.col(name).alias(f"{prefix}Name"),
            F.col("ODSCode").alias(f"{prefix}ODS"),
            *more,
        ).withColumn(f"{prefix}Found", F.lit(True))

    joined = (
        sharing.select("OrganisationGuid", tenant_key("OrganisationGuid").alias("_org"))
        .join(details(practices, "p", "PracticeName", "PracticeDBName"), "_org", "left")
        .join(details(staged, "s", "OrganisationName"), "_org", "left")
        .join(details(common, "c", "OrganisationName"), "_org", "left")
    )
    cdb = F.coalesce("pCDB", "sCDB", "cCDB")
    return joined.select(
        "OrganisationGuid",
        cdb.isNotNull().alias("HaveDetails"),
        F.col("pFound").isNotNull().alias("IsInstalled"),
        cdb.alias("CDB"),
        F.coalesce("pName", "sName", "cName").alias("OrganisationName"),
        F.coalesce("pODS", "sODS", "cODS").alias("ODSCode"),
        "PracticeDBName",
    )


def new_practices(
    organisations: DataFrame, last_extract: int | None, prefix: str = "Practice"
) -> DataFrame:
    """Practice rows for the organisations that have details but are not configured yet."""
    return (
        organisations.where("HaveDetails and not IsInstalled")
        .select(
            tenant_key("OrganisationGuid").alias("OrganisationGuid"),
            F.col("OrganisationName").alias("PracticeName"),
            "ODSCode",
            F.col("CDB").try_cast("int").alias("CDB"),
            F.concat(F.lit(prefix), F.col("CDB")).alias("PracticeDBName"),
            F.lit(None).cast("int").alias("StartExtractId"),
            F.lit(True).alias("NewlyConfigured"),
            F.lit(last_extract).cast("int").alias("ConfiguredAfter"),
        )
    )


def already_configured(practices: DataFrame, candidates: DataFrame) -> DataFrame:
    """The candidates whose number or organisation is taken."""
    org = tenant_key("OrganisationGuid")
    by_number = candidates.join(practices.select("CDB"), "CDB", "left_semi")
    by_organisation = candidates.withColumn("_org", org).join(
        practices.select(org.alias("_org")), "_org", "left_semi"
    )
    return by_number.unionByName(by_organisation.select(*candidates.columns)).distinct()


def activate_practices(
    practices: DataFrame, extract: int, previous: int | None
) -> DataFrame:
    """Practices configured since the previous extract start with this one."""
    starting = F.col("NewlyConfigured") & F.col("ConfiguredAfter").eqNullSafe(
        F.lit(previous).cast("int")
    )
    return practices.select(
        "OrganisationGuid",
        "PracticeName",
        "ODSCode",
        "CDB",
        "PracticeDBName",
        F.when(starting, F.lit(extract)).otherwise(F.col("StartExtractId")).alias("StartExtractId"),
        (F.col("NewlyConfigured") & ~starting).alias("NewlyConfigured"),
        F.when(~starting, F.col("ConfiguredAfter")).alias("ConfiguredAfter"),
    )


# Why an extract may not follow the last installed one.
NOT_BULK = "the first installed extract must be a bulk extract, starting at processing id 1"
NOT_LATER = "the staged extract is not later than the last installed one"


def install_gate(staged: DataFrame, installed: DataFrame) -> DataFrame:
    """Staged extracts with the id before theirs, their own, and the rule they break, if any.

    Only the newest entry of the log counts. Processing ids may start again, so a gap is no error.
    """
    newest = installed.agg(
        F.max_by(F.struct("ExtractId", "ProcessingIdEnd", "ExtractDate"), "ExtractId")
    ).scalar()
    last = newest["ExtractId"]
    problem = F.when(
        (F.col("ProcessingIdStart") != 1) & newest["ProcessingIdEnd"].isNull(), NOT_BULK
    ).when(F.col("ExtractDate") <= newest["ExtractDate"], NOT_LATER)
    return staged.select(
        *staged.columns,
        last.alias("PreviousExtractId"),
        F.coalesce(last + 1, F.lit(1)).alias("NextExtractId"),
        problem.alias("Problem"),
    )
