"""The install and validation jobs over the given tables, written as yearly extracts.

Orders arrive with the extract of their year, line items with that of the year they were shipped in:
those of an order of an earlier extract find no parent row and are discarded. Nations are the
practices; those of region 4 share their data from the third extract on. Parts of a size over 40
arrive with the third extract, customers in debt never.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks import standins as s
from tidemark.operators.versioned import as_of
from tidemark.plans.install import Installed, Special, configure_practice, install_all
from tidemark.plans import install
from tidemark.plans.code_counts import stored_code_counts, update_code_counts
from tidemark.plans.install import install_extract, save_states, stage_extract
from tidemark.plans.validate import validate_practices
from tidemark.registry import COMMON, PRACTICE, TENANT, VERSION, ForeignKey, Registry, Table, Via
from tidemark.sources import history as store
from tidemark.sources.shared import scratch_folder, written_once

REGISTRY = Registry(
    (
        Table("Org_Customer", COMMON, ("CustomerKey",), tenant=None),
        Table("Org_Nation", COMMON, ("OrganisationGuid",), tenant=None),
        Table("Org_Part", COMMON, ("PartKey",), tenant=None),
        Table("Org_Sharing", COMMON, ("OrganisationGuid",), tenant=None),
        Table("Sales_Line", PRACTICE, ("OrderKey", "LineNumber"), deleted="Deleted", tenant=None,
              via=Via("OrderKey", "Sales_Order", "OrderKey")),
        Table("Sales_Order", PRACTICE, ("OrderKey",)),
    ),
    (
        ForeignKey(1, "Sales_Order", "CustomerKey", "Org_Customer", "CustomerKey"),
        ForeignKey(2, "Sales_Line", "PartKey", "Org_Part", "PartKey"),
        ForeignKey(3, "Sales_Line", "OrderKey", "Sales_Order", "OrderKey"),
    ),
)
SPECIAL = Special("Sales", "Order", "Org_Sharing", "Org_Nation", "Nation")
YEARS = range(1995, 2002)
AGREEMENT = "0F8FAD5B-D9CB-469F-A165-70867728950E"


def _guid(nation: str) -> Column:
    return F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(F.col(nation).cast("string"), 12, "0"))


def _by_year(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Orders and line items of all years, written by year: an extract reads its own year alone."""
    def written(name: str, date: str, *columns: str) -> DataFrame:
        year = F.year(date).alias("_year")
        rows = s.given(spark, folder, name).select(*columns, date, year)
        rows = rows.where(F.col("_year").between(YEARS[0], YEARS[-1]))
        path = scratch_folder(spark, f"{name}-by-year")
        rows.write.partitionBy("_year").parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    return {
        "orders": written("orders", "o_orderdate", "o_orderkey", "o_custkey"),
        "lineitem": written(
            "lineitem", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"
        ),
    }


def _extract(
    spark: SparkSession,
    folder: str,
    year: int,
    all_orders: bool = False,
    dated: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The tables of one year's extract; ``all_orders`` sends those of nations that do not share too."""
    def of_year(name: str, date: str) -> DataFrame:
        if dated:
            return dated[name].where(F.col("_year") == year)
        return s.given(spark, folder, name).where(F.year(date) == year)

    first, third = year == YEARS[0], year == YEARS[2]
    nations = s.given(spark, folder, "nation")
    sharing = nations if year >= YEARS[2] else nations.where("n_regionkey <> 4")
    homes = s.given(spark, folder, "customer").join(
        nations if all_orders else sharing, F.col("c_nationkey") == F.col("n_nationkey")
    )
    parts = s.given(spark, folder, "part")
    arriving = parts.where("p_size <= 40") if first else parts.where(F.lit(third) & F.expr("p_size > 40"))
    customers = s.given(spark, folder, "customer").where(F.lit(first) & F.expr("c_acctbal >= 0"))
    orders, lines = of_year("orders", "o_orderdate"), of_year("lineitem", "l_shipdate")
    return {
        "Org_Customer": customers.select(F.col("c_custkey").alias("CustomerKey")),
        "Org_Nation": nations.where(F.lit(first)).select(
            _guid("n_nationkey").alias("OrganisationGuid"),
            F.col("n_nationkey").alias("CDB"),
            F.col("n_name").alias("OrganisationName"),
            F.concat(F.lit("N"), "n_nationkey").alias("ODSCode"),
        ),
        "Org_Part": arriving.select(F.col("p_partkey").alias("PartKey")),
        "Org_Sharing": sharing.select(
            _guid("n_nationkey").alias("OrganisationGuid"), F.lit("true").alias("IsActivated")
        ),
        "Sales_Line": lines.select(
            F.col("l_orderkey").alias("OrderKey"),
            F.col("l_linenumber").alias("LineNumber"),
            F.col("l_partkey").alias("PartKey"),
            s.stamp("l_shipdate").alias("Shipped"),
            F.when(F.col("l_returnflag") == "R", "true").otherwise("false").alias("Deleted"),
        ),
        "Sales_Order": orders.join(homes, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("OrderKey"),
            F.lower(_guid("n_nationkey")).alias("OrganisationGuid"),
            F.col("o_custkey").alias("CustomerKey"),
        ),
    }


def _write(df: DataFrame, folder: str, name: str) -> None:
    """A folder of files in the quoted grammar, as many as tasks write the table: every field quoted,
    records end in CR LF, the header first in each."""
    text = df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    options = {"header": True, "quoteAll": True, "escape": '"', "lineSep": "\r\n", "emptyValue": ""}
    text.write.options(**options).csv(f"{folder}/{name}")


def _write_extracts(spark: SparkSession, folder: str, to: str) -> None:
    dated = _by_year(spark, folder)
    for i, year in enumerate(YEARS):
        for table, rows in _extract(spark, folder, year, dated=dated).items():
            name = f"{1 + 1000 * i}-{1000 * (i + 1)}_{table}_{year + 1}0101000000_{AGREEMENT}.csv"
            _write(rows, f"{to}/{year}", name)


@dataclass(frozen=True)
class Store:
    root: str
    incoming: str
    done: list[Installed]


_STORES: dict[tuple[str, str], Store] = {}


def installed(spark: SparkSession, folder: str) -> Store:
    """All extracts written, installed and validated: once per session and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STORES:
        base = scratch_folder(spark, "jobs")
        _write_extracts(spark, folder, f"{base}/in")
        done = install_all(spark, f"{base}/store", f"{base}/in", REGISTRY, SPECIAL)
        validate_practices(spark, f"{base}/store", REGISTRY)
        _STORES[key] = Store(f"{base}/store", f"{base}/in", done)
    return _STORES[key]


def install_all_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What the histories hold per table, practice and extract."""
    there = installed(spark, folder)
    registry = store.read_layout(spark, there.root, REGISTRY)

    def summed(name: str) -> DataFrame:
        rows = store.read_history(spark, there.root, registry.table(name))
        scope = F.col(TENANT) if TENANT in rows.columns else F.lit("*").alias(TENANT)
        key = F.col(registry.table(name).keys[0]).try_cast("long")
        return rows.groupBy(F.lit(name).alias("TableName"), scope, VERSION).agg(
            F.count("*").alias("n"), F.coalesce(F.sum(key), F.lit(0)).alias("key_sum")
        )

    out = summed(registry.tables[0].name)
    for table in registry.tables[1:]:
        out = out.unionByName(summed(table.name))
    return out


def install_log(spark: SparkSession, folder: str) -> DataFrame:
    log = store.read_control(spark, installed(spark, folder).root, "InstalledExtracts")
    return log.select(
        VERSION, "ProcessingIdStart", "ProcessingIdEnd",
        s.stamp("ExtractDate").alias("ExtractDate"), "SharingAgreementGuid",
    )


def install_discarded(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of join-routed tables without a parent in their extract, as the installs told."""
    rows = [
        (done.extract, table, n)
        for done in installed(spark, folder).done
        for table, n in done.discarded.items()
    ]
    return spark.createDataFrame(rows, f"{VERSION} int, TableName string, n long")


def _practices(spark: SparkSession, root: str) -> DataFrame:
    return store.read_snapshot(spark, root, "ConfiguredPractices").select(
        "OrganisationGuid", "PracticeName", "ODSCode", "CDB", "PracticeDBName", "StartExtractId"
    )


def installed_practices(spark: SparkSession, folder: str) -> DataFrame:
    return _practices(spark, installed(spark, folder).root)


def validation_errors(spark: SparkSession, folder: str) -> DataFrame:
    root = installed(spark, folder).root
    runs = store.read_control(spark, root, "Run").select("RunId", "PracticeDBName", VERSION)
    errors = store.read_control(spark, root, "ForeignKeyErrors")
    return errors.join(runs, "RunId").select(
        "PracticeDBName", VERSION, "ForeignKeyId", "Count", "DistinctCount"
    )


def validation_text(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of the stored reports that name an error."""
    root = installed(spark, folder).root
    runs = store.read_control(spark, root, "Run").select("RunId", "PracticeDBName")
    lines = store.read_control(spark, root, "RunText").where(F.col("Line").contains("[ERROR]"))
    return lines.join(runs, "RunId").select("PracticeDBName", "Line")


def configure_by_hand(spark: SparkSession, folder: str) -> DataFrame:
    """Nation 3 configured before the first extract keeps the name given by hand."""
    root = scratch_folder(spark, "by-hand")
    organisation = "{00000000-0000-0000-0000-000000000003}"
    configure_practice(spark, root, 3, "By hand", "H3", organisation, SPECIAL)
    year = YEARS[0]
    marker = f"1-1000_Sales_Order_{year + 1}0101000000_{AGREEMENT}.csv"
    incoming = f"{installed(spark, folder).incoming}/{year}"
    stage_extract(spark, root, incoming, marker, REGISTRY, SPECIAL)
    install_extract(spark, root, REGISTRY, SPECIAL)
    return _practices(spark, root)


def as_of_from_state(spark: SparkSession, folder: str) -> DataFrame:
    """States saved as of extract 4, the sixth extract's read from them and what followed."""
    root = installed(spark, folder).root
    registry = store.read_layout(spark, root, REGISTRY)
    if store.read_control(spark, root, "SavedStates").isEmpty():
        save_states(spark, root, REGISTRY, 4)

    def state(name: str, *columns: str) -> DataFrame:
        table = registry.table(name)
        rows = as_of(store.recent_history(spark, root, table, 6), table, 6)
        key = F.concat_ws("/", *columns)
        return rows.select(F.lit(name).alias("TableName"), key.alias("Key"), VERSION)

    return state("Sales_Line", TENANT, "OrderKey", "LineNumber").unionByName(
        state("Org_Sharing", "OrganisationGuid")
    )


def install_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per extract, table and practice as the installs stored them; discarded rows have no practice."""
    return install.install_counts(spark, installed(spark, folder).root)


def install_times(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per extract and table, and whether the seconds were taken (they differ from run to run)."""
    times = install.install_times(spark, installed(spark, folder).root)
    return times.select(VERSION, "TableName", "Rows", (F.col("Seconds") > 0).alias("Timed"))


def code_counts_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Part counts of the line items as of the fourth and the last extract, kept extract by extract."""
    root = installed(spark, folder).root
    update_code_counts(spark, root, "Sales_Line", REGISTRY, "PartKey", "Shipped")
    counts = [
        stored_code_counts(spark, root, "Sales_Line", e).withColumn("AsOfExtract", F.lit(e))
        for e in (4, 7)
    ]
    both = counts[0].unionByName(counts[1])
    return both.withColumn("MostRecentDate", s.stamp("MostRecentDate"))


def rerun_after_refusal(spark: SparkSession, folder: str) -> DataFrame:
    """What is seen of a store whose second extract is refused, cleaned away and sent again.

    The refused one has orders of nations that do not share their data, which is found only after all its
    tables are written; nothing of it is read, and the good one takes its number and its folders.
    """
    there, root = installed(spark, folder), scratch_folder(spark, "rerun")
    bad = scratch_folder(spark, "refused")
    name = f"1001-2000_%s_{YEARS[1] + 1}0101000000_{AGREEMENT}.csv"
    for table, rows in _extract(spark, folder, YEARS[1], all_orders=True).items():
        _write(rows, bad, name % table)
    marker = f"1-1000_Sales_Order_{YEARS[0] + 1}0101000000_{AGREEMENT}.csv"
    stage_extract(spark, root, f"{there.incoming}/{YEARS[0]}", marker, REGISTRY, SPECIAL)
    install_extract(spark, root, REGISTRY, SPECIAL)
    stage_extract(spark, root, bad, name % "Sales_Order", REGISTRY, SPECIAL)
    try:
        install_extract(spark, root, REGISTRY, SPECIAL)
    except install.ExtractError as refused:
        if "no configured, sharing practice" not in str(refused):
            raise
    seen = [_seen(spark, root, "refused")]
    install.clean_staging(spark, root)
    seen.append(_seen(spark, root, "cleaned"))
    stage_extract(
        spark, root, f"{there.incoming}/{YEARS[1]}", name % "Sales_Order", REGISTRY, SPECIAL
    )
    install_extract(spark, root, REGISTRY, SPECIAL)
    seen.append(_seen(spark, root, "installed"))
    return reduce(DataFrame.unionByName, seen)


def _seen(spark: SparkSession, root: str, step: str) -> DataFrame:
    """Rows per table and extract as a reader finds them now, and how many extracts are staged."""
    registry = store.read_layout(spark, root, REGISTRY)
    counts = [
        store.read_history(spark, root, registry.table(name))
        .groupBy(F.lit(name).alias("TableName"), VERSION).agg(F.count("*").alias("n"))
        for name in ("Sales_Line", "Sales_Order", "Org_Sharing")
    ]
    staged = store.read_control(spark, root, "StagedExtract").select(
        F.lit("StagedExtract").alias("TableName"), F.lit(None).cast("int").alias(VERSION)
    ).groupBy("TableName", VERSION).agg(F.count("*").alias("n"))
    found = reduce(DataFrame.unionByName, [*counts, staged]).withColumn("Step", F.lit(step))
    # Written, since the next step changes what is counted.
    return written_once(found, "seen")


QUERIES = {
    f.__name__: f
    for f in (
        install_all_rows, install_log, install_discarded, installed_practices, validation_errors,
        validation_text, configure_by_hand, as_of_from_state, install_counts, install_times,
        code_counts_stored, rerun_after_refusal,
    )
}

_GUID = "'00000000-0000-0000-0000-' || lpad(cast(n_nationkey as varchar), 12, '0')"
_TABLES = """
order_rows as (
    select o_orderkey, o_custkey, 'Nation' || n_nationkey as practice, year(o_orderdate) - 1994 as x
    from orders join customer on o_custkey = c_custkey join nation on n_nationkey = c_nationkey
    where n_regionkey <> 4 or year(o_orderdate) >= 1997),
line_rows as (
    select l.*, practice, year(l_shipdate) - 1994 as x
    from lineitem l left join order_rows on o_orderkey = l_orderkey and x = year(l_shipdate) - 1994
    where year(l_shipdate) between 1995 and 2001),
customer_rows as (select c_custkey from customer where c_acctbal >= 0),
part_rows as (select p_partkey, case when p_size > 40 then 3 else 1 end as x from part),
bad as (
    select practice, 1 as fk, cast(o_custkey as varchar) as v from order_rows
    where o_custkey not in (from customer_rows)
    union all
    select practice, 2, cast(l_partkey as varchar) from line_rows l
    where practice is not null and not exists (
        select 1 from part_rows p where p.p_partkey = l.l_partkey and p.x <= l.x)),
errors as (
    select practice, fk, count(*) as n, count(distinct v) as d from bad group by practice, fk)
"""

_PRACTICE = """cast(n_nationkey as int) as "CDB", 'Nation' || n_nationkey as "PracticeDBName\""""

ORACLE = {
    "install_all_rows": f"""with {_TABLES}
        select 'Sales_Order' as "TableName", practice, cast(x as int) as "ExtractId", count(*) as n,
               cast(sum(o_orderkey) as bigint) as key_sum from order_rows group by all
        union all
        select 'Sales_Line', practice, cast(x as int), count(*), cast(sum(l_orderkey) as bigint)
        from line_rows where practice is not null group by all
        union all
        select 'Org_Customer', '*', 1, count(*), cast(sum(c_custkey) as bigint) from customer_rows
        having count(*) > 0
        union all
        select 'Org_Part', '*', x, count(*), cast(sum(p_partkey) as bigint) from part_rows group by x
        union all
        select 'Org_Nation', '*', 1, count(*), 0 from nation
        union all
        select 'Org_Sharing', '*', cast(i as int), count(*), 0
        from nation, range(1, 8) t(i) where n_regionkey <> 4 or i >= 3 group by i""",
    "install_log": f"""select cast(i as int) as "ExtractId",
        cast(1000 * (i - 1) + 1 as int) as "ProcessingIdStart",
        cast(1000 * i as int) as "ProcessingIdEnd",
        (1995 + i) || '-01-01 00:00:00' as "ExtractDate", '{AGREEMENT}' as "SharingAgreementGuid"
        from range(1, 8) t(i)""",
    "install_discarded": f"""with {_TABLES}
        select cast(x as int) as "ExtractId", 'Sales_Line' as "TableName", count(*) as n
        from line_rows where practice is null group by x""",
    "install_counts": f"""with {_TABLES}
        select cast(x as int) as "ExtractId", 'Sales_Order' as "TableName", practice, count(*) as "Rows"
        from order_rows where x between 1 and 7 group by all
        union all
        select cast(x as int), 'Sales_Line', practice, count(*) from line_rows group by all""",
    "install_times": f"""with {_TABLES}, r as (
            select cast(x as int) as x, 'Sales_Order' as t from order_rows
            union all select cast(x as int), 'Sales_Line' from line_rows
            union all select 1, 'Org_Customer' from customer_rows
            union all select x, 'Org_Part' from part_rows
            union all select 1, 'Org_Nation' from nation
            union all select cast(i as int), 'Org_Sharing' from nation, range(1, 8) u(i)
            where n_regionkey <> 4 or i >= 3),
        names as (select distinct t from (values ('Sales_Order'), ('Sales_Line'), ('Org_Customer'),
            ('Org_Part'), ('Org_Nation'), ('Org_Sharing')) v(t))
        select cast(i as int) as "ExtractId", names.t as "TableName",
               count(r.t) as "Rows", true as "Timed"
        from names cross join range(1, 8) u(i) left join r on r.t = names.t and r.x = i group by all""",
    "code_counts_stored": f"""with {_TABLES}
        select practice, cast(l_partkey as varchar) as "CodeId", count(*) as "CodeCount",
               strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') as "MostRecentDate",
               cast(e as int) as "AsOfExtract"
        from line_rows, (values (4), (7)) v(e)
        where practice is not null and x <= e and l_returnflag <> 'R'
        group by practice, l_partkey, e""",
    "rerun_after_refusal": f"""with {_TABLES},
        seen as (
            select 'Sales_Order' as "TableName", cast(x as int) as "ExtractId" from order_rows
            union all select 'Sales_Line', cast(x as int) from line_rows where practice is not null
            union all select 'Org_Sharing', cast(i as int) from nation, range(1, 3) t(i)
            where n_regionkey <> 4)
        select "TableName", "ExtractId", count(*) as n, step as "Step"
        from seen, (values ('refused', 1), ('cleaned', 1), ('installed', 2)) v(step, upto)
        where "ExtractId" between 1 and upto group by all
        union all select 'StagedExtract', null, 1, 'refused'""",
    "installed_practices": f"""select {_GUID} as "OrganisationGuid", n_name as "PracticeName",
        'N' || n_nationkey as "ODSCode", {_PRACTICE},
        case when n_regionkey = 4 then 3 else 1 end as "StartExtractId" from nation""",
    "validation_errors": f"""with {_TABLES} select practice as "PracticeDBName", 7 as "ExtractId",
        fk as "ForeignKeyId", n as "Count", d as "DistinctCount" from errors""",
    "validation_text": f"""with {_TABLES} select practice as "PracticeDBName",
        '     [ERROR]  ' || n || ' (' || d || ' distinct) ' || c || ' value(s) not present in ' || t
            || ' (column ' || c || ')' as "Line"
        from errors join (values (1, 'CustomerKey', 'Org_Customer'), (2, 'PartKey', 'Org_Part'))
            k(fk, c, t) using (fk)""",
    "as_of_from_state": f"""with {_TABLES}
        select 'Sales_Line' as "TableName", practice || '/' || l_orderkey || '/' || l_linenumber as "Key",
               cast(x as int) as "ExtractId"
        from line_rows where practice is not null and x <= 6 and l_returnflag <> 'R'
        union all
        select 'Org_Sharing', {_GUID}, 6 from nation""",
    "configure_by_hand": f"""select
        case n_nationkey when 3 then upper('{{00000000-0000-0000-0000-000000000003}}')
            else {_GUID} end as "OrganisationGuid",
        case n_nationkey when 3 then 'By hand' else n_name end as "PracticeName",
        case n_nationkey when 3 then 'H3' else 'N' || n_nationkey end as "ODSCode",
        {_PRACTICE}, 1 as "StartExtractId" from nation where n_regionkey <> 4""",
}
