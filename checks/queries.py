from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import jobs, standins as s
from tidemark.functions.names import with_parsed_name
from tidemark.functions.text import has_trailing_quote, listed, split_rows, without_trailing_quote
from tidemark.operators import analytics, bitmaps, code_state, integrity, intervals, results, routing
from tidemark.operators import standing, tenants, versioned
from tidemark.operators.constraints import Check, NotNull, Reference, Unique, check_constraints
from tidemark.operators.report import report_lines
from tidemark.plans.validate import per_run, plan_runs
from tidemark.registry import COMMON, PRACTICE, TENANT, VERSION, ForeignKey, Registry, Table
from tidemark.sources import quoted_text
from tidemark.sources.clustered import read_keys, write_clustered
from tidemark.sources.history import save_bucketed
from tidemark.sources.recovery import read_aligned_table, unaligned_records
from tidemark.sources.shared import scratch_folder, written_by, written_once
from tidemark.sources.views import register_views

NOW = datetime(2002, 1, 31, 12, 0)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Versioned reads


@query
def latest_rows(spark, folder):
    keys = list(s.LINEITEM.keys)
    return versioned.latest_rows(s.lineitem(spark, folder), keys, 4)


@query
def as_of_keyed(spark, folder):
    return versioned.as_of(s.lineitem(spark, folder), s.LINEITEM, 4)


@query
def current_view(spark, folder):
    return versioned.current(s.lineitem(spark, folder), s.LINEITEM)


@query
def as_of_by_practice(spark, folder):
    """The key of a practice table starts with the practice."""
    return versioned.as_of(s.lineitem_of_supplier(spark, folder), s.LINEITEM, 5)


@query
def as_of_keyless(spark, folder):
    history = s.given(spark, folder, "events").select(
        "event_id", "user_id", "event_type", "value", F.dayofmonth("ts").alias(VERSION)
    )
    return versioned.as_of(history, Table("events", PRACTICE), 15)


@query
def as_of_unversioned(spark, folder):
    return versioned.as_of(s.lineitem(spark, folder).drop(VERSION), s.LINEITEM, 4)


@query
def as_of_bucketed(spark, folder):
    """The history saved bucketed on its keys, then read in place."""
    name = f"lineitem_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    save_bucketed(
        s.lineitem(spark, folder), s.LINEITEM, name, buckets, scratch_folder(spark, "bucketed")
    )
    return versioned.as_of(spark.table(name), s.LINEITEM, 4, in_place=True)


@query
def as_of_points(spark, folder):
    """The dearest and the cheapest order, as of two extracts, from a copy clustered by key."""
    price = F.struct("o_totalprice", "o_orderkey")
    first, last = s.given(spark, folder, "orders").agg(
        F.min_by("o_orderkey", price), F.max_by("o_orderkey", price)
    ).first()
    history, path = s.lineitem(spark, folder), scratch_folder(spark, "clustered")
    write_clustered(history, s.LINEITEM.keys, path, files=128)
    wanted = [(key,) for key in (first, last) if key is not None]
    rows = read_keys(spark, path, history.schema, s.LINEITEM.keys, wanted)
    return reduce(DataFrame.unionByName, [
        versioned.as_of(rows, s.LINEITEM, extract).withColumn("AsOfExtract", F.lit(extract))
        for extract in (4, 7)
    ])


@query
def as_of_function(spark, folder):
    """The same state through SQL."""
    register_views(spark, {"lineitem": s.lineitem(spark, folder)}, s.REGISTRY)
    return spark.sql("select * from fn_lineitem(4)")


@query
def current_view_in_sql(spark, folder):
    register_views(spark, {"lineitem": s.lineitem(spark, folder)}, s.REGISTRY)
    return spark.sql(
        "select l_returnflag, l_linestatus, count(*) as n, max(shipped) as last_shipped "
        "from vw_lineitem group by all"
    )


@query
def extract_diff(spark, folder):
    return versioned.extract_diff(
        s.lineitem(spark, folder), list(s.LINEITEM.keys), 3, 4, deleted="Deleted"
    )


PART = Table("lines", COMMON, ("l_partkey",), deleted="Deleted", tenant=None)


@query
def validity_intervals(spark, folder):
    """A part's line items of a year replace those of the years before."""
    lines = s.lineitem(spark, folder).select("l_partkey", "l_orderkey", "l_linenumber", VERSION)
    return intervals.with_validity(lines, PART.keys)


@query
def diff_of_intervals(spark, folder):
    """Neighbouring extracts and the first against the last, all from intervals made once.

    Each difference is written: a union of groups by the same keys is read by key, all its branches by one task.
    """
    lines = s.lineitem(spark, folder).select(
        "l_partkey", "l_quantity", "l_returnflag", "l_linestatus", "Deleted", VERSION
    )
    made = written_once(intervals.with_validity(lines, PART.keys), "intervals")
    return reduce(DataFrame.unionByName, [
        written_once(
            intervals.diff_of_intervals(made, PART.keys, a, b, deleted=PART.deleted), "difference"
        ).withColumns({"before": F.lit(a), "after": F.lit(b)})
        for a, b in SPANS
    ])


SPANS = [*((e, e + 1) for e in range(1, 7)), (1, 7)]


# Foreign keys


def _late_orders(spark, folder):
    orders = s.given(spark, folder, "orders").select("o_orderkey", s.year_version("o_orderdate"))
    return integrity.orphans(s.lineitem(spark, folder), "l_orderkey", orders, "o_orderkey")


@query
def fk_orphan_rows(spark, folder):
    return _late_orders(spark, folder).select("l_orderkey", "l_linenumber", "shipped", VERSION)


@query
def fk_orphans_asof(spark, folder):
    return integrity.orphan_counts(_late_orders(spark, folder), "l_orderkey")


@query
def fk_orphans_missing(spark, folder):
    """Documents without a label: a check without versions."""
    return integrity.orphans(
        s.given(spark, folder, "documents").select("doc_id", "lang", "source"), "doc_id",
        s.given(spark, folder, "labels"), "doc_id", version=None,
    )


@query
def fk_all(spark, folder):
    values = integrity.orphan_values(s.histories(spark, folder), s.REGISTRY)
    return integrity.orphan_totals(values)


@query
def fk_values(spark, folder):
    return integrity.orphan_values(s.histories(spark, folder), s.REGISTRY)


@query
def fk_samples(spark, folder):
    values = integrity.orphan_values(s.histories(spark, folder), s.REGISTRY)
    return integrity.orphan_samples(values, "Value", by=["ForeignKeyId", "scope"])


def _key_columns(name, df):
    """The columns of a history that a check of its foreign keys and of those that point at it looks at."""
    keys = s.REGISTRY.foreign_keys
    used = {k.from_column for k in keys if k.from_table == name}
    used |= {k.to_column for k in keys if k.to_table == name} | {TENANT, VERSION}
    return [c for c in df.columns if c in used]


@query
def fk_by_extract(spark, folder):
    """The outcome of ``fk_all`` after each of seven extracts, each of which is read alone."""
    tables = {
        name: written_by(df.select(*_key_columns(name, df)), VERSION, name)
        for name, df in s.histories(spark, folder).items()
    }
    known = spark.createDataFrame([], standing.KEYS)
    orphans = spark.createDataFrame([], standing.ORPHANS)
    totals = []
    for extract in range(1, 8):
        rows = {name: df.where(F.col(VERSION) == extract) for name, df in tables.items()}
        new = written_once(standing.arriving_keys(rows, s.REGISTRY, known, extract), "keys")
        known = known.unionByName(new)
        found = standing.arriving_orphans(rows, s.REGISTRY, known, extract)
        orphans = orphans.unionByName(written_once(found, "orphans"))
        values = standing.standing_values(orphans, extract)
        totals.append(integrity.orphan_totals(values).withColumn("AsOfExtract", F.lit(extract)))
    return reduce(DataFrame.unionByName, totals)


@query
def fk_blank_and_resent(spark, folder):
    """Null and blank values are never orphans; parents sent again later count from the first time."""
    lines = s.lineitem_of_supplier(spark, folder)
    value = F.when(F.col("l_linenumber") == 2, " ").when(
        F.col("l_linenumber") != 1, F.col("l_partkey").cast("string")
    )
    parts = s.given(spark, folder, "part")
    first = F.when(F.col("p_size") > 40, 3).otherwise(1).alias(VERSION)
    sent = parts.where("p_size < 48").select(F.col("p_partkey").cast("string").alias("p"), first)
    sent = sent.unionByName(sent.select("p", F.lit(6).alias(VERSION)))
    sent = sent.unionByName(sent.limit(1).select(F.lit(None).cast("string").alias("p"), VERSION))
    registry = Registry(
        (Table("line", PRACTICE, ("l_orderkey",)), Table("part", COMMON, ("p",), tenant=None)),
        (ForeignKey(1, "line", "v", "part", "p"),),
    )
    return integrity.orphan_values(
        {"line": lines.select(value.alias("v"), TENANT, VERSION), "part": sent}, registry
    )


@query
def fk_caseless(spark, folder):
    """Sources written in the other case and with a trailing blank still find their parent."""
    child = s.given(spark, folder, "documents").select(
        "doc_id", F.concat(F.upper("source"), F.lit(" ")).alias("source")
    )
    parent = (
        s.given(spark, folder, "documents")
        .join(s.given(spark, folder, "labels").where("toxic = 1").select("doc_id"), "doc_id")
        .select("source")
    )
    return integrity.orphans(
        child, "source", parent, "source", version=None, collation="UTF8_LCASE_RTRIM"
    )


@query
def fk_as_of_mode(spark, folder):
    values = integrity.orphan_values_as_of(s.histories(spark, folder), s.REGISTRY, 4)
    return integrity.orphan_totals(values)


def _runs(spark, folder, extract, first_run, group):
    """The runs of one group with their errors and samples; bounded so that groups differ."""
    runs, _ = plan_runs(s.practices(spark, folder), extract, first_run, group, NOW)
    values = written_once(
        integrity.orphan_values(s.histories(spark, folder), s.REGISTRY, bound=extract),
        "orphan-values",
    )
    errors = per_run(runs, integrity.orphan_totals(values))
    samples = per_run(
        runs, integrity.orphan_samples(values, "Value", by=["ForeignKeyId", "scope"])
    )
    return runs, errors, samples


def _two_groups(spark, folder):
    """Two groups of runs, as of extracts 3 and 5, from one check of the history."""
    values = integrity.orphan_values(
        s.histories(spark, folder), s.REGISTRY, bound=5, by_extract=True
    )
    about = s.practices(spark, folder)
    first, second = plan_runs(about, 3, 1, 1, NOW)[0], plan_runs(about, 5, 101, 2, NOW)[0]
    runs = first.unionByName(second)
    errors = per_run(runs, integrity.orphan_totals_at(values, [3, 5]))
    return runs, written_once(errors, "errors")


@query
def fk_totals_at(spark, folder):
    """The totals as of each of seven extracts from one check of the whole history."""
    values = integrity.orphan_values(s.histories(spark, folder), s.REGISTRY, by_extract=True)
    return integrity.orphan_totals_at(values, range(1, 8))


@query
def planned_runs(spark, folder):
    """Runs and skipped practices for extract 1: practices that start later wait."""
    runs, skipped = plan_runs(s.practices(spark, folder), 1, 1, 1, NOW)
    return runs.select(
        "PracticeDBName", F.col("RunId").cast("string").alias("Outcome")
    ).unionByName(skipped.withColumnRenamed("Reason", "Outcome"))


@query
def fk_result_delta(spark, folder):
    _, errors = _two_groups(spark, folder)
    return results.fk_result(errors, s.REGISTRY.foreign_key_frame(spark), 101, 1)


@query
def fk_result_pivot(spark, folder):
    runs, errors = _two_groups(spark, folder)
    selected = results.select_runs(
        runs.drop("PracticeName", "ODSCode"), s.practices(spark, folder),
        group=2, comparison_group=1,
    )
    return results.fk_results(errors, s.REGISTRY.foreign_key_frame(spark), selected)


@query
def fk_distinct_merged(spark, folder):
    """Distinct orphan values per region as of extracts 3 and 7, merged from bitmaps of practices and extracts."""
    values = written_once(
        integrity.orphan_values(s.histories(spark, folder), s.REGISTRY, by_extract=True), "values"
    )
    known = spark.createDataFrame([], bitmaps.NUMBERS)
    numbers = written_once(bitmaps.new_numbers(values, known, 0), "numbers")
    made = written_once(bitmaps.value_bitmaps(values, numbers), "bitmaps")
    regions = s.given(spark, folder, "nation").select(
        s.store_name("n_nationkey").alias("scope"), "n_regionkey"
    )
    placed = made.join(regions, "scope", "left")
    return reduce(DataFrame.unionByName, [
        bitmaps.distinct_counts(
            placed.where(F.col(VERSION) <= extract), ["ForeignKeyId", "n_regionkey"]
        ).withColumn("AsOfExtract", F.lit(extract))
        for extract in (3, 7)
    ])


@query
def fk_result_text(spark, folder):
    """The same report as lines of text, its columns cells of a list."""
    runs, errors = _two_groups(spark, folder)
    selected = results.select_runs(
        runs.drop("PracticeName", "ODSCode"), s.practices(spark, folder),
        group=2, comparison_group=1,
    )
    listed = results.fk_results_listed(errors, s.REGISTRY.foreign_key_frame(spark), selected)
    return results.report_text(listed, selected)


@query
def fk_result_history(spark, folder):
    """All runs of one practice side by side, distinct counts, headed by name."""
    runs, errors = _two_groups(spark, folder)
    selected = results.select_runs(
        runs.drop("PracticeName", "ODSCode"), s.practices(spark, folder), cdb=7, use_name=True
    )
    return results.fk_results(
        errors, s.REGISTRY.foreign_key_frame(spark), selected, distinct=True
    )


@query
def run_lines(spark, folder):
    runs, errors, samples = _runs(spark, folder, 5, 1, 1)
    about = runs.withColumn("ExtractDate", F.lit(datetime(1999, 12, 31)).cast("timestamp_ntz"))
    return report_lines(about, errors, samples, s.REGISTRY.foreign_key_frame(spark))


# Counts


@query
def practice_counts(spark, folder):
    return analytics.practice_counts(
        s.practices(spark, folder), s.lineitem_of_supplier(spark, folder), s.LINEITEM
    )


def _code_counts(rows):
    return analytics.code_counts_by_practice(
        rows, "l_partkey", analytics.text_date("shipped")
    )


@query
def code_counts(spark, folder):
    rows = versioned.current(
        s.lineitem_of_supplier(spark, folder, text_dates=True), s.LINEITEM
    )
    codes = s.given(spark, folder, "part").select(
        "p_partkey", F.col("p_name").alias("Term"), F.col("p_brand").alias("ReadTermId")
    )
    described = analytics.describe_codes(
        analytics.total_code_counts(_code_counts(rows)), codes, s.REGISTRY.table("part"),
        about=["Term", "ReadTermId"],
    )
    return described.withColumn("MostRecentDate", s.stamp("MostRecentDate"))


@query
def code_counts_current(spark, folder):
    """Counts described by the current state of a dictionary that sends some codes twice."""
    rows = versioned.current(
        s.lineitem_of_supplier(spark, folder, text_dates=True), s.LINEITEM
    )
    parts = s.given(spark, folder, "part")
    entry = [F.col("p_partkey"), F.col("p_brand").alias("Term")]
    again = F.when(F.col("p_size") > 25, 2).otherwise(1).alias(VERSION)
    codes = parts.select(*entry, F.lit(1).alias(VERSION)).unionByName(
        parts.where("p_size > 25").select(
            "p_partkey", F.concat("p_brand", F.lit(" (new)")).alias("Term"), again
        )
    )
    described = analytics.describe_codes(
        analytics.total_code_counts(_code_counts(rows)), codes, s.REGISTRY.table("part"),
        state="current", about=["Term"],
    )
    return described.withColumn("MostRecentDate", s.stamp("MostRecentDate"))


@query
def code_counts_incremental(spark, folder):
    """Practice by practice over current rows: those numbered below 12 first, then the others."""
    rows = versioned.current(
        s.lineitem_of_supplier(spark, folder, text_dates=True), s.LINEITEM
    )
    early = F.substring(TENANT, 7, 2).cast("int") < 12
    state = analytics.total_code_counts(_code_counts(rows.where(early)))
    batch = analytics.total_code_counts(_code_counts(rows.where(~early)))
    folded = analytics.fold_code_counts(state, batch)
    return folded.withColumn("MostRecentDate", s.stamp("MostRecentDate"))


@query
def code_counts_standing(spark, folder):
    """Supplier counts after each of seven extracts; a part's line items of a year replace the earlier ones."""
    lines = s.lineitem_of_supplier(spark, folder, text_dates=True).select(
        TENANT, "l_partkey", "l_suppkey", "shipped", "Deleted", VERSION
    )
    rows = written_by(lines, VERSION, "lines")
    table = Table("lines", PRACTICE, ("l_partkey",), deleted="Deleted")
    state, states = spark.createDataFrame([], code_state.CODE_COUNTS), []
    for extract in range(1, 8):
        counts = code_state.code_counts_after(
            state, rows, table, extract, "l_suppkey", analytics.text_date("shipped")
        )
        state = written_once(counts, "code-counts")
        states.append(state.withColumn("AsOfExtract", F.lit(extract)))
    counted = reduce(DataFrame.unionByName, states)
    return counted.withColumn("MostRecentDate", s.stamp("MostRecentDate"))


def _starters(spark, folder):
    return s.practices(spark, folder).where("StartExtractId = 2").select(
        F.col("PracticeDBName").alias(TENANT)
    )


@query
def code_counts_refreshed(spark, folder):
    """Practices with a newer extract are counted again, the others keep what they had."""
    rows = s.lineitem_of_supplier(spark, folder, text_dates=True)
    state = _code_counts(versioned.as_of(rows, s.LINEITEM, 4))
    starters = _starters(spark, folder)
    batch = _code_counts(
        versioned.current(rows.join(starters, TENANT, "left_semi"), s.LINEITEM)
    )
    refreshed = analytics.refresh_code_counts(state, batch, starters)
    return refreshed.withColumn("MostRecentDate", s.stamp("MostRecentDate"))


@query
def code_counts_emptied(spark, folder):
    """Nation 7 sends all its rows once more, deleted: counted again, it has no counts."""
    rows = s.lineitem_of_supplier(spark, folder, text_dates=True)
    state = _code_counts(versioned.current(rows, s.LINEITEM))
    gone = rows.where(F.col(TENANT) == "Nation7")
    rows = rows.unionByName(gone.withColumns({"Deleted": F.lit("true"), VERSION: F.lit(8)}))
    recounted = spark.createDataFrame([("Nation7",), ("Nation8",)], f"{TENANT} string")
    batch = versioned.current(rows.join(recounted, TENANT, "left_semi"), s.LINEITEM)
    refreshed = analytics.refresh_code_counts(state, _code_counts(batch), recounted)
    return refreshed.withColumn("MostRecentDate", s.stamp("MostRecentDate"))


@query
def code_rows_left_out(spark, folder):
    """Seventh lines have no code; the dates of accepted returns lack their dashes."""
    rows = s.lineitem_of_supplier(spark, folder, text_dates=True).select(
        TENANT,
        F.when(F.col("l_linenumber") != 7, F.col("l_partkey")).alias("CodeId"),
        F.when(F.col("l_returnflag") == "A", F.translate("shipped", "-", ""))
        .when(F.col("l_linestatus") == "O", F.col("shipped"))
        .alias("EffectiveDate"),
    )
    return analytics.code_rows_left_out(rows)


@query
def per_tenant_sql(spark, folder):
    return analytics.across_practices(
        spark,
        "select practice, count(*) as n_rows, count(distinct l_partkey) as n_parts, "
        "max(shipped) as last_shipped from {lines} group by practice",
        lines=s.lineitem_of_supplier(spark, folder, text_dates=True),
    )


@query
def for_each_tenant(spark, folder):
    """A query that knows nothing of practices, for each of them, in one plan."""
    customers = s.given(spark, folder, "customer").withColumn(TENANT, s.store_name("c_nationkey"))
    names = s.practices(spark, folder).select(F.col("PracticeDBName").alias(TENANT))
    return analytics.by_practice(
        spark,
        "select c_mktsegment, count(*) as n from {customers} group by c_mktsegment",
        names,
        {"customers": customers},
    )


@query
def for_each_tenant_stored(spark, folder):
    """Practice by practice, each a job of its own over a stored history clustered by practice."""
    customers = s.given(spark, folder, "customer").withColumn(TENANT, s.store_name("c_nationkey"))
    customers = written_once(
        customers.hint("rebalance", TENANT).sortWithinPartitions(TENANT), "customers"
    )
    names = s.practices(spark, folder).select("PracticeDBName").toLocalIterator()
    return analytics.store_for_each_practice(
        spark,
        "select c_mktsegment, count(*) as n from {customers} group by c_mktsegment",
        (r[0] for r in names),
        {"customers": customers},
        scratch_folder(spark, "for-each"),
    )


@query
def listed_names(spark, folder):
    return s.given(spark, folder, "nation").groupBy("n_regionkey").agg(
        listed("n_name").alias("names")
    )


# Reading extracts


@query
def parse_names(spark, folder):
    """File names made of order fields; priorities and statuses make some of them wrong."""
    orders = s.given(spark, folder, "orders")
    number, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    tail = F.lpad(customer, 12, "0")
    name = F.concat(
        number, F.lit("-"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(customer),
        F.lit("_Sales_"),
        F.when(F.col("o_orderpriority") == "2-HIGH", F.lit("Order_Item")).otherwise(F.lit("Order")),
        F.lit("_"),
        F.date_format("o_orderdate", "yyyyMMdd"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", "0000").otherwise("000000"),
        F.when(F.col("o_orderpriority") == "5-LOW", "_0f8fad5b-d9cb-469f-a165-").otherwise(
            "_0F8FAD5B-D9CB-469F-A165-"
        ),
        tail,
        F.when(F.col("o_orderstatus") == "P", ".txt").otherwise(".csv"),
    )
    named = orders.select("o_orderkey", name.alias("FileName"))
    parsed = with_parsed_name(named, "FileName")
    return parsed.withColumns(
        {
            "ProcessingIdStart": F.col("ProcessingIdStart").cast("string"),
            "ProcessingIdEnd": F.col("ProcessingIdEnd").cast("string"),
            "ExtractDate": s.stamp("ExtractDate"),
        }
    )


#: A way to write a file name for each rule, and good ones.
NAMES = {
    1: "concat(k, '-', c, '_Sales_Order_', d, '000000_', g, '.txt')",
    2: "concat(k, '-', c, '_Sales_Order_Item_', d, '000000_', g, '.csv')",
    3: "concat(k, '-', c, '_Sales_Order_', d, '000000_', substring(g, 2, 40), '.csv')",
    4: "concat(k, '_Sales_Order_', d, '000000_', g, '.csv')",
    5: "concat(k, '-x', c, '_Sales_Order_', d, '000000_', g, '.csv')",
    6: "concat(k, '-', c, '_Sales_ _', d, '000000_', g, '.csv')",
    7: "concat(k, '-', c, '_Sales_Order_', d, '0000_', g, '.csv')",
    8: "concat(k, '-', c, '_Sales_Order_', d, '250000_', g, '.csv')",
    9: "concat(k, '-', c, '_Sales_Order_', d, '235959_{', lower(g), '}.CSV')",
    10: "concat(k, '-', c, '_Sales_Order_', d, '000000_', g, '.csv')",
}


@query
def parse_names_all(spark, folder):
    """File names made of order fields that break every rule in turn, and null ones."""
    way = "case o_orderkey % 11 " + " ".join(f"when {n} then {w}" for n, w in NAMES.items())
    named = s.given(spark, folder, "orders").selectExpr(
        "o_orderkey", "string(o_orderkey) k", "string(o_custkey) c",
        "date_format(o_orderdate, 'yyyyMMdd') d",
        "concat('0F8FAD5B-D9CB-469F-A165-', lpad(string(o_custkey), 12, '0')) g",
    ).selectExpr("o_orderkey", f"{way} end as FileName")
    parsed = with_parsed_name(named, "FileName")
    return parsed.select(
        "o_orderkey", "FileName", F.col("ProcessingIdStart").cast("string").alias("first_id"),
        F.col("ProcessingIdEnd").cast("string").alias("last_id"), "TableName",
        s.stamp("ExtractDate").alias("ExtractDate"), "SharingAgreementGuid", "parse_error",
    )


@query
def split_texts(spark, folder):
    pages = s.given(spark, folder, "pages").select("page_id", "url")
    return split_rows(pages, "url", "/").drop("url")


DOCUMENTS = Table(
    "documents", PRACTICE, columns=("doc_id", "text", "lang", "source", "n_chars"),
    widths={"text": 20000},
)


def _quoted_documents(spark, folder):
    """The documents written in the quoted grammar, one file per partition."""
    path = scratch_folder(spark, "quoted-documents")
    (
        s.given(spark, folder, "documents")
        .select(*DOCUMENTS.columns)
        .write.option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("lineSep", "\n")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return quoted_text.read_extract_table(spark, path, DOCUMENTS)


@query
def quoted_text_rows(spark, folder):
    return _quoted_documents(spark, folder).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.col(quoted_text.RAGGED).cast("int").alias("ragged"),
    )


@query
def quoted_text_files(spark, folder):
    """Exactly one closing quote is found in every file written."""
    return quoted_text.quote_counts(_quoted_documents(spark, folder)).agg(
        F.sum("Rows").alias("n_rows"), F.count("Problem").alias("n_problems")
    )


def _damaged_documents(spark, folder):
    """Whole texts as records that end in CR LF, a file per partition with the header in each."""
    docs = s.given(spark, folder, "documents").select("doc_id", "text")
    text = F.replace(F.coalesce("text", F.lit("")), F.lit('"'), F.lit('""'))
    number = F.col("doc_id").cast("string")
    line = F.when(F.col("doc_id") % 10 == 3, F.concat_ws('","', number, text, F.lit("more")))
    line = line.when(F.col("doc_id") % 10 == 7, F.lit('doc_id","text'))
    line = line.otherwise(F.concat_ws('","', number, text))
    path = scratch_folder(spark, "damaged")
    header, end = '"doc_id","text"', '"\r'
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    above = F.when(first, F.lit(header + "\r\n")).otherwise(F.lit(""))
    records = docs.select(F.concat(above, F.lit('"'), line, F.lit(end)).alias("value"))
    # A file of the header alone, so that no table is without one.
    alone = spark.createDataFrame([(header + "\r",)], "value string").coalesce(1)
    alone.unionByName(records).write.text(path)
    return path


@query
def quoted_text_damaged(spark, folder):
    """Records that end in CR LF; some have a field too many, some are a second header."""
    path = _damaged_documents(spark, folder)
    table = Table("documents", PRACTICE, columns=("doc_id", "text"), widths={"text": 40})
    rows = quoted_text.read_extract_table(spark, path, table)
    flags = [F.col(f).cast("int").alias(f.strip("_")) for f in quoted_text.FLAGS[1:]]
    counted = rows.select((F.col("doc_id").try_cast("long") % 10).alias("digit"), *flags)
    return counted.groupBy("digit", *[f.strip("_") for f in quoted_text.FLAGS[1:]]).agg(
        F.count("*").alias("n")
    )


def _documents_with_separators(spark, folder):
    """Whole texts as records; three in ten hold a separator in a value that nothing tells apart."""
    docs = s.given(spark, folder, "documents")
    quoted = {
        c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""'))
        for c in DOCUMENTS.columns
    }
    digit = F.col("doc_id") % 10
    quoted["text"] = (
        F.when(digit == 3, F.concat(quoted["text"], F.lit(' and "," again')))
        .when(digit == 9, F.concat(quoted["text"], F.lit('","en')))
        .otherwise(quoted["text"])
    )
    quoted["source"] = F.when(digit == 7, F.concat(F.lit('COPY","'), quoted["source"])).otherwise(
        quoted["source"]
    )
    path = scratch_folder(spark, "separators")
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    header = '"' + '","'.join(DOCUMENTS.columns) + '"'
    above = F.when(first, F.lit(header + "\n")).otherwise(F.lit(""))
    record = F.concat_ws('","', *[quoted[c] for c in DOCUMENTS.columns])
    records = docs.select(F.concat(above, F.lit('"'), record, F.lit('"')).alias("value"))
    alone = spark.createDataFrame([(header,)], "value string").coalesce(1)
    alone.unionByName(records).write.text(path)
    return path


@query
def quoted_text_recovered(spark, folder):
    """Records with a separator in a value: the recovered rows, and the ids of those in quarantine."""
    table = Table(
        "documents", PRACTICE, columns=DOCUMENTS.columns, widths={"text": 1 << 30},
        patterns={"doc_id": r"\d+", "lang": "[a-z]{2}", "n_chars": r"\d+"},
    )
    path = _documents_with_separators(spark, folder)
    rows = read_aligned_table(spark, path, table).where(~F.col(quoted_text.RAGGED))
    rest = unaligned_records(spark, path, table)
    number = F.substring_index("Record", '"', 1).cast("long")
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source",
        F.col("n_chars").cast("long").alias("n_chars"), F.lit(1).alias("alignments"),
    ).unionByName(rest.select(
        number.alias("doc_id"), *[F.lit(None).cast("string").alias(c) for c in ("text", "lang", "source")],
        F.lit(None).cast("long").alias("n_chars"), F.col("Alignments").alias("alignments"),
    ))


@query
def check_widths(spark, folder):
    return quoted_text.check_widths(s.given(spark, folder, "documents"), DOCUMENTS)


@query
def trailing_quotes(spark, folder):
    """Texts that end in a quote once line ends are gone, and what the repair makes of them."""
    text = F.col("text")
    return s.given(spark, folder, "documents").select(
        "doc_id",
        has_trailing_quote(text).cast("int").alias("quoted"),
        without_trailing_quote(text).alias("repaired"),
    )


# Installing


def _organisation_order_rows(spark, folder):
    homes = s.given(spark, folder, "customer").select(
        "c_custkey",
        F.concat(F.lit("ORG-"), F.col("c_nationkey").cast("string")).alias("OrganisationGuid"),
    )
    return (
        s.given(spark, folder, "orders")
        .join(homes, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "OrganisationGuid")
    )


def _installed(spark, folder):
    """Nations with a supplier of less than 3,000 share their data."""
    poor = s.given(spark, folder, "supplier").where("s_acctbal < 3000").select(
        F.concat(F.lit("org-"), F.col("s_nationkey").cast("string")).alias("OrganisationGuid")
    )
    sharing = s.practices(spark, folder).join(poor, "OrganisationGuid", "left_semi")
    return routing.installed_practices(
        sharing.select("OrganisationGuid", "PracticeDBName", F.lit(True).alias("IsInstalled"))
    )


@query
def route_direct(spark, folder):
    routed = routing.route_rows(
        _organisation_order_rows(spark, folder), s.REGISTRY.table("orders"),
        _installed(spark, folder),
    )
    return routing.counts_by_practice(routed, "orders")


@query
def route_via_parent(spark, folder):
    installed = _installed(spark, folder)
    orders = routing.route_rows(
        _organisation_order_rows(spark, folder), s.REGISTRY.table("orders"), installed
    )
    routed = routing.route_rows(
        s.given(spark, folder, "lineitem").select("l_orderkey"), s.LINEITEM, installed, orders
    )
    return routing.counts_by_practice(routed, "lineitem")


@query
def residual_rows(spark, folder):
    return routing.residual_rows(
        _organisation_order_rows(spark, folder), s.REGISTRY.table("orders"),
        _installed(spark, folder),
    )


def _organisations(spark, folder):
    """Nations as sharing organisations.

    Nations with a supplier of less than 3,000 are configured, the extract describes those with a
    customer of more than 9,900, the history those with a supplier of more than 5,000.
    """

    def described(table, prefix, condition):
        rows = s.given(spark, folder, table).where(condition)
        number = F.col(f"{prefix}_nationkey").cast("string")
        return rows.groupBy(
            F.concat(F.lit("ORG-"), number).alias("OrganisationGuid"), number.alias("CDB")
        ).agg(
            F.min(f"{prefix}_name").alias("OrganisationName"),
            F.concat(F.lit(prefix), F.count("*").cast("string")).alias("ODSCode"),
        )

    sharing = s.practices(spark, folder).select("OrganisationGuid")
    poor = s.given(spark, folder, "supplier").where("s_acctbal < 3000").select(
        F.concat(F.lit("org-"), F.col("s_nationkey").cast("string")).alias("OrganisationGuid")
    )
    known = s.practices(spark, folder).join(poor, "OrganisationGuid", "left_semi")
    return known, tenants.staging_organisations(
        sharing, known,
        described("customer", "c", "c_acctbal > 9900"),
        described("supplier", "s", "s_acctbal > 5000"),
    )


@query
def staging_organisations(spark, folder):
    _, organisations = _organisations(spark, folder)
    return organisations.withColumn("HaveDetails", F.col("HaveDetails").cast("int")).withColumn(
        "IsInstalled", F.col("IsInstalled").cast("int")
    )


@query
def activated_practices(spark, folder):
    """Known practices and new ones, after the new ones start with extract 8."""
    known, organisations = _organisations(spark, folder)
    new = tenants.new_practices(organisations, 7, "Nation")
    result = tenants.activate_practices(known.unionByName(new), 8, 7)
    return result.withColumn("NewlyConfigured", F.col("NewlyConfigured").cast("int")).drop(
        "ConfiguredAfter"
    )


@query
def install_gate(spark, folder):
    """Every order as a staged extract against a log of the orders that were finished."""
    orders = s.given(spark, folder, "orders")
    log = orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").cast("int").alias("ExtractId"),
        F.col("o_custkey").cast("int").alias("ProcessingIdEnd"),
        F.col("o_orderdate").alias("ExtractDate"),
    )
    staged = orders.select(
        F.col("o_custkey").cast("int").alias("ProcessingIdStart"),
        F.col("o_orderdate").alias("ExtractDate"),
        F.col("o_orderkey").alias("Staged"),
    )
    return tenants.install_gate(staged, log).withColumn("ExtractDate", s.stamp("ExtractDate"))


@query
def install_gate_first(spark, folder):
    """Every order as the first extract: only those that start at processing id 1 may be."""
    staged = s.given(spark, folder, "orders").select(
        (1 + F.col("o_custkey") % 3).cast("int").alias("ProcessingIdStart"),
        F.col("o_orderdate").alias("ExtractDate"),
        F.col("o_orderkey").alias("Staged"),
    )
    log = spark.createDataFrame([], "ExtractId int, ProcessingIdEnd int, ExtractDate timestamp")
    return tenants.install_gate(staged, log).withColumn("ExtractDate", s.stamp("ExtractDate"))


@query
def constraint_checks(spark, folder):
    tables = {
        name: s.given(spark, folder, name)
        for name in ("lineitem", "orders", "customer", "part", "labels")
    }
    rules = {
        "lineitem": (
            Unique(("l_orderkey", "l_linenumber")),
            Reference("l_partkey", "part", "p_partkey"),
            Check("l_quantity <= 49"),
        ),
        "orders": (Unique(("o_orderkey",)), Unique(("o_custkey",)), NotNull("o_orderdate")),
        "customer": (Reference("c_custkey", "orders", "o_custkey"), Check("c_acctbal >= 0")),
        "labels": (Unique(("doc_id",)),),
    }
    return check_constraints(tables, rules)


QUERIES |= jobs.QUERIES
