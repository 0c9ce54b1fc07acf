"""The same questions in plain SQL."""

from __future__ import annotations

from checks import jobs
from checks.standins import REGISTRY

STAMP = "'%Y-%m-%d %H:%M:%S'"

TABLES = f"""
lines as (
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
           l_tax, l_returnflag, l_linestatus, cast(epoch(l_shipdate) as bigint) as shipped,
           strftime(l_shipdate, {STAMP}) as shipped_text,
           case when l_returnflag = 'R' then 'true' else 'false' end as "Deleted",
           cast(year(l_shipdate) - 1994 as int) as "ExtractId"
    from lineitem),
supplier_lines as (
    select lines.*, 'Nation' || s_nationkey as practice
    from lines join supplier on l_suppkey = s_suppkey),
order_rows as (
    select o_orderkey, o_custkey, 'Nation' || c_nationkey as practice,
           cast(year(o_orderdate) - 1994 as int) as "ExtractId"
    from orders join customer on o_custkey = c_custkey),
event_rows as (
    select event_id, user_id, 'Nation' || c_nationkey as practice,
           cast(ceil(day(ts) / 5.0) as int) as "ExtractId"
    from events join customer on user_id = c_custkey),
customer_rows as (
    select c_custkey, c_nationkey, case when c_acctbal < 0 then 2 else 1 end as "ExtractId"
    from customer),
nation_rows as (
    select n_nationkey, case when n_regionkey = 4 then 2 else 1 end as "ExtractId" from nation),
part_rows as (
    select p_partkey, case when p_size > 40 then 3 else 1 end as "ExtractId" from part),
supplier_rows as (
    select s_suppkey, s_nationkey, case when s_acctbal < 0 then 2 else 1 end as "ExtractId"
    from supplier),
practices as (
    select 'org-' || n_nationkey as "OrganisationGuid", n_name as "PracticeName",
           'N' || n_nationkey as "ODSCode", n_nationkey as "CDB",
           'Nation' || n_nationkey as "PracticeDBName",
           case when n_regionkey = 4 then 2 else 1 end as "StartExtractId"
    from nation)
"""

LINE_COLUMNS = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus, shipped, "Deleted", "ExtractId\""""


def latest(source: str, keys: list[str], bound: int | None) -> str:
    names = ", ".join(keys)
    same = " and ".join(f"t.{k} = e.{k}" for k in keys)
    until = f'where "ExtractId" <= {bound}' if bound else ""
    return f"""(select t.* from {source} t join
        (select {names}, max("ExtractId") as newest from {source} {until} group by {names}) e
        on {same} and t."ExtractId" = e.newest)"""


LINE_KEYS = ["l_orderkey", "l_linenumber"]
PRACTICE_LINE_KEYS = ["practice", *LINE_KEYS]

# Per foreign key: child rows, child column, whether the child has a practice, the same of the parent.
KEYS = {
    1: ("customer_rows", "c_nationkey", False, "nation_rows", "n_nationkey", False),
    2: ("event_rows", "user_id", True, "customer_rows", "c_custkey", False),
    3: ("supplier_lines", "l_orderkey", True, "order_rows", "o_orderkey", True),
    4: ("supplier_lines", "l_partkey", True, "part_rows", "p_partkey", False),
    5: ("supplier_lines", "l_suppkey", True, "supplier_rows", "s_suppkey", False),
    6: ("order_rows", "o_custkey", True, "customer_rows", "c_custkey", False),
    7: ("supplier_rows", "s_nationkey", False, "nation_rows", "n_nationkey", False),
}


def state(source: str, n: int) -> str:
    """Only line items have several versions or deletions."""
    if source == "supplier_lines":
        return f"""(select * from {latest(source, PRACTICE_LINE_KEYS, n)}
            where "Deleted" = 'false')"""
    return f'(select * from {source} where "ExtractId" <= {n})'


def orphan_rows(bound: int | None = None, as_of: int | None = None) -> str:
    """One row per orphan child row: ForeignKeyId, scope, Value."""
    parts = []
    for number, (child, column, scoped, parent, key, inside) in KEYS.items():
        in_time = 'and f."ExtractId" >= t."ExtractId"'
        if as_of:
            child, parent, in_time = state(child, as_of), state(parent, as_of), ""
        parts.append(f"""
            select {number} as "ForeignKeyId", {'f.practice' if scoped else "'*'"} as scope,
                   cast(f.{column} as varchar) as "Value"
            from {child} f
            where {f'f."ExtractId" <= {bound} and' if bound else ''} not exists (
                select 1 from {parent} t
                where t.{key} = f.{column} {in_time}
                {'and t.practice = f.practice' if inside else ''})""")
    return " union all ".join(parts)


def runs(extract: int, first: int, group: int) -> str:
    return f"""
        select cast(row_number() over (order by "StartExtractId", "PracticeName", "PracticeDBName")
                    + {first - 1} as int) as "RunId", "PracticeDBName", {extract} as "ExtractId",
               {group} as "RunGroupId", "PracticeName", "ODSCode", "StartExtractId", "CDB"
        from practices where "StartExtractId" <= {extract}"""


def errors(run_table: str, orphan_table: str) -> str:
    return f"""
        select "RunId", "ForeignKeyId", count(*) as "Count",
               count(distinct "Value") as "DistinctCount"
        from {run_table} r join {orphan_table} o on o.scope in (r."PracticeDBName", '*')
        group by "RunId", "ForeignKeyId\""""


FK_TABLE = "fks(\"ForeignKeyId\", \"TableType\", \"FromTable\", \"FromColumn\", \"ToTable\", " \
    "\"ToColumn\") as (values " + ", ".join(
        f"({k.id}, '{REGISTRY.table(k.from_table).kind}', '{k.from_table}', '{k.from_column}', "
        f"'{k.to_table}', '{k.to_column}')"
        for k in REGISTRY.foreign_keys
    ) + ")"

TWO_GROUPS = f"""{TABLES}, {FK_TABLE},
o3 as ({orphan_rows(3)}), o5 as ({orphan_rows(5)}),
r1 as ({runs(3, 1, 1)}), r2 as ({runs(5, 101, 2)}),
errs as ({errors('r1', 'o3')} union all {errors('r2', 'o5')}),
spine as (select * from fks where "ForeignKeyId" in (select "ForeignKeyId" from errs))"""

FK_COLUMNS = '"TableType", "FromTable", "FromColumn", "ToTable", "ToColumn"'


def changed(now: str, then: str) -> str:
    now, then = f"coalesce({now}, 0)", f"coalesce({then}, 0)"
    return f"""{now} || case when {now} = {then} then ''
        when {now} > {then} then '  (+' || ({now} - {then}) || ')'
        else '  (' || ({now} - {then}) || ')' end"""


def count_of(run: str, measure: str) -> str:
    return f'max(case when e."RunId" = {run} then e."{measure}" end)'


def _pivot() -> str:
    columns = []
    for nation in range(25):
        now = f'(select "RunId" from r2 where "CDB" = {nation})'
        then = f'(select "RunId" from r1 where "CDB" = {nation})'
        columns.append(
            f"""{changed(count_of(now, 'Count'), count_of(then, 'Count'))}
            as "CDB{nation}-Ext5\""""
        )
    return f"""with {TWO_GROUPS}
        select {FK_COLUMNS}, {', '.join(columns)}
        from spine s left join errs e on s."ForeignKeyId" = e."ForeignKeyId" group by {FK_COLUMNS}"""


def _pivot_text() -> str:
    def count(run: str) -> str:
        return f'max(case when e."RunId" = {run}."RunId" then e."Count" end)'

    names = FK_COLUMNS.replace('"', "").replace(", ", "\t")
    return f"""with {TWO_GROUPS}, cells as (
            select {FK_COLUMNS}, r2."RunId", {changed(count('r2'), count('r1'))} as cell
            from spine s join r2 on true join r1 on r1."PracticeDBName" = r2."PracticeDBName"
            left join errs e on e."ForeignKeyId" = s."ForeignKeyId"
            group by {FK_COLUMNS}, r2."RunId", r1."RunId"),
        written as (
            select 1 as part, {FK_COLUMNS}, concat_ws('\t', {FK_COLUMNS},
                   string_agg(cell, '\t' order by "RunId")) as line
            from cells group by {FK_COLUMNS}
            union all
            select 0, '', '', '', '', '', '{names}\t' || string_agg('CDB' || "CDB" || '-Ext5', '\t'
                   order by "RunId") from r2)
        select cast(row_number() over (order by part, {FK_COLUMNS}) - 1 as int) as "LineId",
               line as "Line" from written"""


def _totals_by_extract() -> str:
    return f"with {TABLES}, " + ", ".join(
        f"o{e} as ({orphan_rows(bound=e)})" for e in range(1, 8)
    ) + " " + " union all ".join(
        f"""select "ForeignKeyId", scope, count(*) as "Count",
            count(distinct "Value") as "DistinctCount", {e} as "AsOfExtract" from o{e} group by all"""
        for e in range(1, 8)
    )


def _report() -> str:
    dashes = "-" * 52
    rows = f"""{TABLES}, {FK_TABLE}, o as ({orphan_rows(5)}), r as ({runs(5, 1, 1)}),
    errs as ({errors('r', 'o')}),
    d as (select e.*, f."FromTable" as ft, f."FromColumn" as fc, f."ToTable" as tt,
                 f."ToColumn" as tc
          from errs e join fks f on f."ForeignKeyId" = e."ForeignKeyId"),
    firsts as (
        select "RunId", "ForeignKeyId", "Value",
               row_number() over (partition by "RunId", "ForeignKeyId" order by "Value") as n
        from (select distinct "RunId", "ForeignKeyId", "Value"
              from r join o on o.scope in (r."PracticeDBName", '*'))),
    lines_out as (
        select "RunId", '' as a, '' as b, 0 as c, n, case n
            when 0 then 'Data Integrity Report'
            when 1 then 'Practice: ' || "ODSCode" || '/ ' || "PracticeName"
            when 2 then 'Extract Id: 5'
            when 3 then 'Extract date: 1999-12-31 00:00:00'
            when 4 then 'Validation date: 2002-01-31 12:00:00'
            else '' end as line
        from r cross join range(6) x(n)
        union all
        select "RunId", ft, '', 1, n,
            case n when 0 then '{dashes}' when 1 then '>>Table ' || ft when 2 then '{dashes}'
                   else '' end
        from (select distinct "RunId", ft from d) cross join range(4) x(n)
        union all
        select "RunId", ft, fc, 2, n, case n
            when 0 then '  >Column ' || fc
            when 2 then '     [ERROR]  ' || "Count" || ' (' || "DistinctCount" || ' distinct) '
                || fc || ' value(s) not present in ' || tt || ' (column ' || tc || ')'
            when 4 then case when "DistinctCount" > 10 then '     First ten distinct value(s) are:'
                        else '     Distinct value(s) are:' end
            else '' end
        from d cross join range(5) x(n)
        union all
        select d."RunId", ft, fc, 3, n, '         ' || "Value"
        from firsts s join d on d."RunId" = s."RunId" and d."ForeignKeyId" = s."ForeignKeyId"
        where n <= 10
        union all
        select "RunId", ft, fc, 4, 0, '' from d)"""
    return f"""with {rows}
        select "RunId", cast(row_number() over (partition by "RunId" order by a, b, c, n) as int)
               as "LineId", line as "Line" from lines_out"""


ORGANISATIONS = f"""{TABLES},
known as (
    select * from practices where "OrganisationGuid" in
        (select 'org-' || s_nationkey from supplier where s_acctbal < 3000)),
staged as (
    select 'org-' || c_nationkey as org, cast(c_nationkey as varchar) as "CDB",
           min(c_name) as name, 'c' || count(*) as ods
    from customer where c_acctbal > 9900 group by c_nationkey),
common as (
    select 'org-' || s_nationkey as org, cast(s_nationkey as varchar) as "CDB",
           min(s_name) as name, 's' || count(*) as ods
    from supplier where s_acctbal > 5000 group by s_nationkey),
organisations as (
    select p."OrganisationGuid",
           cast(coalesce(cast(k."CDB" as varchar), s."CDB", c."CDB") is not null as int)
               as "HaveDetails",
           cast(k."OrganisationGuid" is not null as int) as "IsInstalled",
           coalesce(cast(k."CDB" as varchar), s."CDB", c."CDB") as "CDB",
           coalesce(k."PracticeName", s.name, c.name) as "OrganisationName",
           coalesce(k."ODSCode", s.ods, c.ods) as "ODSCode", k."PracticeDBName"
    from practices p
    left join known k on k."OrganisationGuid" = p."OrganisationGuid"
    left join staged s on s.org = p."OrganisationGuid"
    left join common c on c.org = p."OrganisationGuid")"""

INSTALLED = """installed as (
    select distinct 'Nation' || s_nationkey as practice, s_nationkey as nation
    from supplier where s_acctbal < 3000)"""

CODES = """count(*) as "CodeCount", max(shipped_text) as "MostRecentDate\""""

NAME = """o_orderkey || '-' || case when o_orderpriority = '1-URGENT' then '' else cast(o_custkey as varchar) end
    || '_Sales_' || case when o_orderpriority = '2-HIGH' then 'Order_Item' else 'Order' end || '_'
    || strftime(o_orderdate, '%Y%m%d')
    || case when o_orderpriority = '3-MEDIUM' then '0000' else '000000' end
    || case when o_orderpriority = '5-LOW' then '_0f8fad5b-d9cb-469f-a165-'
            else '_0F8FAD5B-D9CB-469F-A165-' end
    || lpad(cast(o_custkey as varchar), 12, '0')
    || case when o_orderstatus = 'P' then '.txt' else '.csv' end"""


def _constraints() -> str:
    def row(table: str, rule: str, count: str) -> str:
        return f"""select '{table}' as "TableName", '{rule}' as "Rule",
            (select count(*) from {count}) as "Violations\""""

    def repeated(table: str, keys: str) -> str:
        return f"(select 1 from {table} group by {keys} having count(*) > 1)"

    return " union all ".join(
        [
            row("lineitem", "unique (l_orderkey, l_linenumber)",
                repeated("lineitem", "l_orderkey, l_linenumber")),
            row("lineitem", "l_partkey in part (p_partkey)",
                "lineitem where l_partkey not in (select p_partkey from part)"),
            row("lineitem", "l_quantity <= 49", "lineitem where not l_quantity <= 49"),
            row("orders", "unique (o_orderkey)", repeated("orders", "o_orderkey")),
            row("orders", "unique (o_custkey)", repeated("orders", "o_custkey")),
            row("orders", "not null (o_orderdate)", "orders where o_orderdate is null"),
            row("customer", "c_custkey in orders (o_custkey)",
                "customer where c_custkey not in (select o_custkey from orders)"),
            row("customer", "c_acctbal >= 0", "customer where not c_acctbal >= 0"),
            row("labels", "unique (doc_id)", repeated("labels", "doc_id")),
        ]
    )


def _widths() -> str:
    widths = {"doc_id": 50, "text": 20000, "lang": 50, "source": 50, "n_chars": 50}
    return " union all ".join(
        f"""select '{c}' as "ColumnName", {w} as "DeclaredWidth",
            cast(max(length(cast({c} as varchar))) as int) as "LongestValue",
            count(*) filter (where length(cast({c} as varchar)) > {w}) as "TooLong"
            from documents"""
        for c, w in widths.items()
    )


def _diff() -> str:
    payload = ", ".join(
        c.strip() for c in LINE_COLUMNS.split(",")
        if c.strip() not in ('"ExtractId"', *LINE_KEYS)
    )
    keys = ", ".join(LINE_KEYS)

    def state(n: int) -> str:
        return f"""select {keys}, count(*) as n,
            string_agg(concat_ws('|', {payload}), ';' order by concat_ws('|', {payload})) as rows
            from {latest('lines', LINE_KEYS, n)} where "Deleted" = 'false' group by {keys}"""

    return f"""with {TABLES}, a as ({state(3)}), b as ({state(4)})
        select coalesce(a.l_orderkey, b.l_orderkey) as l_orderkey,
               coalesce(a.l_linenumber, b.l_linenumber) as l_linenumber,
               coalesce(a.n, 0) as rows_before, coalesce(b.n, 0) as rows_after,
               case when a.n is null then 'added' when b.n is null then 'removed'
                    else 'changed' end as status
        from a full join b
            on a.l_orderkey = b.l_orderkey and a.l_linenumber = b.l_linenumber
        where a.rows is distinct from b.rows"""


def _part_diffs() -> str:
    """Differences per part between pairs of extracts, each state looked up anew."""
    from checks.queries import SPANS

    row = "concat_ws('|', l_quantity, l_returnflag, l_linestatus)"

    def state(n: int) -> str:
        return f"""(select l_partkey, count(*) as n, string_agg({row}, ';' order by {row}) as rows
            from {latest('lines', ['l_partkey'], n)} where "Deleted" = 'false' group by l_partkey)"""

    return f"with {TABLES} " + " union all ".join(
        f"""select coalesce(a.l_partkey, b.l_partkey) as l_partkey,
            coalesce(a.n, 0) as rows_before, coalesce(b.n, 0) as rows_after,
            case when a.n is null then 'added' when b.n is null then 'removed' else 'changed' end
                as status, {a} as before, {b} as after
        from {state(a)} a full join {state(b)} b on a.l_partkey = b.l_partkey
        where a.rows is distinct from b.rows"""
        for a, b in SPANS
    )


def _names() -> str:
    """Names by the same ways, parsed step by step in SQL."""
    from checks.queries import NAMES

    way = "case o_orderkey % 11 " + " ".join(f"when {n} then {w}" for n, w in NAMES.items()) + " end"
    guid = "^[{]?[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}[}]?$"
    return f"""
        with parts as (
            select o_orderkey, cast(o_orderkey as varchar) as k, cast(o_custkey as varchar) as c,
                   strftime(o_orderdate, '%Y%m%d') as d,
                   '0F8FAD5B-D9CB-469F-A165-' || lpad(cast(o_custkey as varchar), 12, '0') as g
            from orders),
        named as (select o_orderkey, {way} as "FileName" from parts),
        cut as (select *, string_split(left("FileName", greatest(length("FileName") - 4, 0)), '_') as p
                from named),
        ids as (select *, string_split(p[1], '-') as i,
                       try_strptime(p[4], '%Y%m%d%H%M%S') as t from cut),
        judged as (select *, case
            when "FileName" is null then 'file name is null'
            when not ends_with(lower("FileName"), '.csv') then 'file name does not end in .csv'
            when len(p) <> 5 then 'file name does not have five parts'
            when not regexp_matches(p[5], '{guid}') then 'sharing agreement is not an identifier'
            when len(i) <> 2 then 'processing ids are not a pair'
            when not regexp_matches(i[1], '^[0-9]+$') or not regexp_matches(i[2], '^[0-9]+$')
                then 'processing id is not a number'
            when trim(p[2]) = '' or trim(p[3]) = '' then 'schema or table name is empty'
            when length(p[4]) <> 14 then 'extract date is not 14 digits'
            when t is null then 'extract date is not a date' end as parse_error from ids)
        select o_orderkey, "FileName", parse_error,
            case when parse_error is null then i[1] end as first_id,
            case when parse_error is null then i[2] end as last_id,
            case when parse_error is null then p[3] end as "TableName",
            case when parse_error is null then strftime(t, {STAMP}) end as "ExtractDate",
            case when parse_error is null then upper(trim(p[5], '{{}}')) end
                as "SharingAgreementGuid"
        from judged"""


ORACLE = {
    "latest_rows": f"with {TABLES} select {LINE_COLUMNS} from {latest('lines', LINE_KEYS, 4)}",
    "as_of_keyed": f"""with {TABLES} select {LINE_COLUMNS} from {latest('lines', LINE_KEYS, 4)}
        where "Deleted" = 'false'""",
    "current_view": f"""with {TABLES} select {LINE_COLUMNS}
        from {latest('lines', LINE_KEYS, None)} where "Deleted" = 'false'""",
    "as_of_points": f"""with {TABLES},
        wanted as (
            (select o_orderkey from orders order by o_totalprice, o_orderkey limit 1) union
            (select o_orderkey from orders order by o_totalprice desc, o_orderkey desc limit 1))
        """ + " union all ".join(
            f"""select {LINE_COLUMNS}, {n} as "AsOfExtract" from {latest('lines', LINE_KEYS, n)}
            where "Deleted" = 'false' and l_orderkey in (from wanted)""" for n in (4, 7)),
    "as_of_by_practice": f"""with {TABLES} select {LINE_COLUMNS}, practice
        from {latest('supplier_lines', PRACTICE_LINE_KEYS, 5)} where "Deleted" = 'false'""",
    "as_of_keyless": """select event_id, user_id, event_type, value,
        cast(day(ts) as int) as "ExtractId" from events where day(ts) <= 15""",
    "as_of_unversioned": f"""with {TABLES}
        select {LINE_COLUMNS.replace(', "ExtractId"', '')} from lines where "Deleted" = 'false'""",
    "as_of_bucketed": f"""with {TABLES} select {LINE_COLUMNS} from {latest('lines', LINE_KEYS, 4)}
        where "Deleted" = 'false'""",
    "as_of_function": f"""with {TABLES} select {LINE_COLUMNS} from {latest('lines', LINE_KEYS, 4)}
        where "Deleted" = 'false'""",
    "current_view_in_sql": f"""with {TABLES} select l_returnflag, l_linestatus, count(*) as n,
        max(shipped) as last_shipped from {latest('lines', LINE_KEYS, None)}
        where "Deleted" = 'false' group by all""",
    "extract_diff": _diff(),
    "validity_intervals": f"""with {TABLES}, spans as (
            select l_partkey, "ExtractId",
                   lead("ExtractId") over (partition by l_partkey order by "ExtractId") as "ReplacedIn"
            from (select distinct l_partkey, "ExtractId" from lines))
        select l_partkey, l_orderkey, l_linenumber, "ExtractId", "ReplacedIn"
        from lines join spans using (l_partkey, "ExtractId")""",
    "diff_of_intervals": _part_diffs(),
    "fk_orphan_rows": f"""with {TABLES} select l_orderkey, l_linenumber, shipped, "ExtractId"
        from lines f where not exists (select 1 from orders
            where o_orderkey = f.l_orderkey and f."ExtractId" >= year(o_orderdate) - 1994)""",
    "fk_orphans_asof": f"""with {TABLES} select count(*) as "Count",
        count(distinct l_orderkey) as "DistinctCount"
        from lines f where not exists (select 1 from orders
            where o_orderkey = f.l_orderkey and f."ExtractId" >= year(o_orderdate) - 1994)""",
    "fk_orphans_missing": """select doc_id, lang, source from documents d
        where not exists (select 1 from labels l where l.doc_id = d.doc_id)""",
    "fk_all": f"""with {TABLES}, o as ({orphan_rows()}) select "ForeignKeyId", scope,
        count(*) as "Count", count(distinct "Value") as "DistinctCount" from o group by all""",
    "fk_by_extract": _totals_by_extract(),
    "fk_totals_at": _totals_by_extract(),
    "fk_values": f"""with {TABLES}, o as ({orphan_rows()}) select "ForeignKeyId", scope, "Value",
        count(*) as "Count" from o group by all""",
    "fk_samples": f"""with {TABLES}, o as (select distinct * from ({orphan_rows()}))
        select "ForeignKeyId", scope, "Value", cast(n as int) as "Position" from (
            select *, row_number() over (partition by "ForeignKeyId", scope order by "Value") as n
            from o) where n <= 10""",
    "fk_caseless": """select doc_id, upper(source) || ' ' as source from documents d
        where not exists (select 1 from documents p join labels l on p.doc_id = l.doc_id
            where toxic = 1 and lower(p.source) = lower(d.source))""",
    "fk_as_of_mode": f"""with {TABLES}, o as ({orphan_rows(as_of=4)}) select "ForeignKeyId", scope,
        count(*) as "Count", count(distinct "Value") as "DistinctCount" from o group by all""",
    "planned_runs": f"""with {TABLES}
        select "PracticeDBName", cast(row_number() over
            (order by "StartExtractId", "PracticeName", "PracticeDBName") as varchar) as "Outcome"
        from practices where "StartExtractId" <= 1
        union all
        select "PracticeDBName", 'starts with extract ' || "StartExtractId"
        from practices where "StartExtractId" > 1""",
    "fk_result_delta": f"""with {TWO_GROUPS} select {FK_COLUMNS},
        {changed(count_of('101', 'Count'), count_of('1', 'Count'))} as "Count",
        {changed(count_of('101', 'DistinctCount'), count_of('1', 'DistinctCount'))}
            as "DistinctCount"
        from spine s left join errs e on s."ForeignKeyId" = e."ForeignKeyId"
        group by {FK_COLUMNS}""",
    "fk_result_pivot": _pivot(),
    "fk_result_text": _pivot_text(),
    "fk_distinct_merged": f"with {TABLES}, o3 as ({orphan_rows(bound=3)}), o7 as ({orphan_rows(bound=7)}) "
        + " union all ".join(
            f"""select "ForeignKeyId", n_regionkey, count(distinct "Value") as "DistinctCount",
                {e} as "AsOfExtract" from o{e} left join nation on scope = 'Nation' || n_nationkey
            group by all""" for e in (3, 7)),
    "fk_result_history": f"""with {TWO_GROUPS} select {FK_COLUMNS},
        cast(coalesce(max(case when e."RunId" in (select "RunId" from r1 where "CDB" = 7)
            then "DistinctCount" end), 0) as varchar) as "NATION_7-Ext3",
        cast(coalesce(max(case when e."RunId" in (select "RunId" from r2 where "CDB" = 7)
            then "DistinctCount" end), 0) as varchar) as "NATION_7-Ext5"
        from spine s left join errs e on s."ForeignKeyId" = e."ForeignKeyId"
        group by {FK_COLUMNS}""",
    "run_lines": _report(),
    "practice_counts": f"""with {TABLES},
        c as (select practice, count(*) as n
              from {latest('supplier_lines', PRACTICE_LINE_KEYS, None)}
              where "Deleted" = 'false' group by practice)
        select "PracticeName", "PracticeDBName" as "DatabaseName",
               coalesce(n, 0) as "PatientCount"
        from practices left join c on practice = "PracticeDBName\"""",
    "code_counts": f"""with {TABLES},
        c as (select l_partkey, {CODES}
              from {latest('supplier_lines', PRACTICE_LINE_KEYS, None)}
              where "Deleted" = 'false' group by l_partkey)
        select l_partkey as "CodeId", p_name as "Term", p_brand as "ReadTermId", "CodeCount",
               "MostRecentDate" from c join part on l_partkey = p_partkey""",
    "code_counts_current": f"""with {TABLES},
        c as (select l_partkey, {CODES}
              from {latest('supplier_lines', PRACTICE_LINE_KEYS, None)}
              where "Deleted" = 'false' group by l_partkey)
        select l_partkey as "CodeId", p_brand || case when p_size > 25 then ' (new)' else '' end
                   as "Term", "CodeCount", "MostRecentDate"
        from c join part on l_partkey = p_partkey""",
    "code_counts_incremental": f"""with {TABLES}
        select l_partkey as "CodeId", {CODES}
        from {latest('supplier_lines', PRACTICE_LINE_KEYS, None)}
        where "Deleted" = 'false' group by l_partkey""",
    "code_counts_refreshed": f"""with {TABLES},
        newer as (select "PracticeDBName" from practices where "StartExtractId" = 2)
        select practice, l_partkey as "CodeId", {CODES}
        from {latest('supplier_lines', PRACTICE_LINE_KEYS, 4)}
        where "Deleted" = 'false' and practice not in (from newer)
        group by practice, l_partkey
        union all
        select practice, l_partkey, {CODES}
        from {latest('supplier_lines', PRACTICE_LINE_KEYS, None)}
        where "Deleted" = 'false' and practice in (from newer) group by practice, l_partkey""",
    "code_counts_standing": f"with {TABLES} " + " union all ".join(
        f"""select practice, cast(l_suppkey as varchar) as "CodeId", {CODES}, {e} as "AsOfExtract"
        from {latest('supplier_lines', ['practice', 'l_partkey'], e)}
        where "Deleted" = 'false' group by practice, l_suppkey"""
        for e in range(1, 8)
    ),
    "code_counts_emptied": f"""with {TABLES}
        select practice, l_partkey as "CodeId", {CODES}
        from {latest('supplier_lines', PRACTICE_LINE_KEYS, None)}
        where "Deleted" = 'false' and practice <> 'Nation7' group by practice, l_partkey""",
    "code_rows_left_out": f"""with {TABLES}
        select practice, count(*) as "AllRows", count(*) filter (l_linenumber = 7) as "NoCode",
               count(*) filter (l_linenumber <> 7 and l_returnflag = 'A') as "UnreadDate"
        from supplier_lines group by practice""",
    "per_tenant_sql": f"""with {TABLES}
        select practice, count(*) as n_rows, count(distinct l_partkey) as n_parts,
               max(shipped_text) as last_shipped from supplier_lines group by practice""",
    "for_each_tenant": """select 'Nation' || c_nationkey as practice, c_mktsegment, count(*) as n
        from customer group by all""",
    "for_each_tenant_stored": """select 'Nation' || c_nationkey as practice, c_mktsegment, count(*) as n
        from customer group by all""",
    "listed_names": """select n_regionkey, string_agg(n_name, ', ' order by n_name) as names
        from nation group by n_regionkey""",
    "parse_names": f"""
        with named as (select o_orderkey, o_custkey, o_orderdate, {NAME} as "FileName",
            case when o_orderstatus = 'P' then 'file name does not end in .csv'
                 when o_orderpriority = '2-HIGH' then 'file name does not have five parts'
                 when o_orderpriority = '1-URGENT' then 'processing id is not a number'
                 when o_orderpriority = '3-MEDIUM' then 'extract date is not 14 digits'
            end as parse_error from orders)
        select o_orderkey, "FileName",
            case when parse_error is null then cast(o_orderkey as varchar) end
                as "ProcessingIdStart",
            case when parse_error is null then cast(o_custkey as varchar) end as "ProcessingIdEnd",
            case when parse_error is null then 'Sales' end as "SchemaName",
            case when parse_error is null then 'Order' end as "TableName",
            case when parse_error is null then strftime(o_orderdate, '%Y%m%d') || '000000' end
                as "ExtractDateString",
            case when parse_error is null then strftime(o_orderdate, {STAMP}) end as "ExtractDate",
            case when parse_error is null then '0F8FAD5B-D9CB-469F-A165-'
                || lpad(cast(o_custkey as varchar), 12, '0') end as "SharingAgreementGuid",
            parse_error
        from named""",
    "split_texts": """select page_id, cast(i as int) as "Id", parts[i] as "Data"
        from (select page_id, string_split(url, '/') as parts from pages) x,
             lateral (select unnest(range(1, len(parts) + 1)) as i)""",
    "quoted_text_rows": """select doc_id, replace(text, '"', '""') as text, lang, source, n_chars,
        0 as ragged from documents""",
    "quoted_text_files": "select count(*) as n_rows, cast(0 as bigint) as n_problems from documents",
    "check_widths": _widths(),
    "trailing_quotes": """
        select doc_id, cast(q as int) as quoted,
               case when q then replace(replace(replace(text, '"', ''), chr(10), ''), chr(13), '')
                    else text end as repaired
        from (select *, ends_with(replace(replace(text, chr(10), ''), chr(13), ''), '"') as q
              from documents)""",
    "route_direct": f"""with {INSTALLED} select 'orders' as "TableName", i.practice,
        count(*) as "Rows" from orders join customer on o_custkey = c_custkey
        left join installed i on i.nation = c_nationkey group by all""",
    "route_via_parent": f"""with {INSTALLED} select 'lineitem' as "TableName", i.practice,
        count(*) as "Rows" from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey
        left join installed i on i.nation = c_nationkey group by all""",
    "residual_rows": f"""with {INSTALLED}
        select o_orderkey, 'ORG-' || c_nationkey as "OrganisationGuid"
        from orders join customer on o_custkey = c_custkey
        where c_nationkey not in (select nation from installed)""",
    "staging_organisations": f"with {ORGANISATIONS} select * from organisations",
    "activated_practices": f"""with {ORGANISATIONS}
        select "OrganisationGuid", "PracticeName", "ODSCode", "CDB", "PracticeDBName",
               "StartExtractId", 0 as "NewlyConfigured"
        from known
        union all
        select upper("OrganisationGuid"), "OrganisationName", "ODSCode", cast("CDB" as int),
               'Nation' || "CDB", 8, 0
        from organisations where "HaveDetails" = 1 and "IsInstalled" = 0""",
    "install_gate": f"""
        with last as (select o_orderkey, o_orderdate from orders where o_orderstatus = 'F'
                      order by o_orderkey desc limit 1)
        select cast(o.o_custkey as int) as "ProcessingIdStart",
               strftime(o.o_orderdate, {STAMP}) as "ExtractDate", o.o_orderkey as "Staged",
               cast(last.o_orderkey as int) as "PreviousExtractId",
               cast(last.o_orderkey + 1 as int) as "NextExtractId",
               case when o.o_orderdate <= last.o_orderdate
                    then 'the staged extract is not later than the last installed one'
               end as "Problem"
        from orders o cross join last""",
    "install_gate_first": f"""
        select cast(1 + o_custkey % 3 as int) as "ProcessingIdStart",
               strftime(o_orderdate, {STAMP}) as "ExtractDate", o_orderkey as "Staged",
               cast(null as int) as "PreviousExtractId", 1 as "NextExtractId",
               case when o_custkey % 3 <> 0 then
                   'the first installed extract must be a bulk extract, starting at processing id 1'
               end as "Problem"
        from orders""",
    "parse_names_all": _names(),
    "fk_blank_and_resent": f"""with {TABLES}
        select 1 as "ForeignKeyId", practice as scope, cast(l_partkey as varchar) as "Value",
               count(*) as "Count"
        from supplier_lines l where l_linenumber > 2 and not exists (
            select 1 from part p where p.p_partkey = l.l_partkey and p_size < 48
            and case when p_size > 40 then 3 else 1 end <= l."ExtractId")
        group by practice, l_partkey""",
    "quoted_text_recovered": """select doc_id,
        case doc_id % 10 when 9 then null
            when 3 then coalesce(replace(text, '"', '""'), '') || ' and "," again'
            else nullif(replace(text, '"', '""'), '') end as text,
        case when doc_id % 10 <> 9 then nullif(replace(lang, '"', '""'), '') end as lang,
        case doc_id % 10 when 9 then null
            when 7 then 'COPY","' || coalesce(replace(source, '"', '""'), '')
            else nullif(replace(source, '"', '""'), '') end as source,
        case when doc_id % 10 <> 9 then n_chars end as n_chars,
        case when doc_id % 10 = 9 then 2 else 1 end as alignments from documents""",
    "quoted_text_damaged": """
        select digit, cast(digit is null as int) as repeated_header,
               cast(coalesce(digit = 3, false) as int) as ragged,
               cast(wide as int) as wide, count(*) as n
        from (select case when doc_id % 10 <> 7 then doc_id % 10 end as digit,
                     coalesce(doc_id % 10 <> 7 and length(substring(text, 1, 60)) > 40, false) as wide
              from documents) group by all""",
    "constraint_checks": _constraints(),
}

ORACLE |= jobs.ORACLE
