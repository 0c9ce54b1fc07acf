import random
import re
from dataclasses import replace
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tests.extracts import FEW, LAYOUT, bulk, patient, write_extract
from tests.test_quoted_text import save
from tidemark.plans.install import ExtractError, install_extract, stage_extract
from tidemark.registry import COMMON, Registry, Table
from tidemark.sources import history as store, quoted_text as q, recovery

COLUMNS = ["Id", "Note", "Code", "More", "Day"]
TABLE = Table(
    "t", COMMON, ("Id",), tenant=None, columns=tuple(COLUMNS), widths={"Note": 12, "More": 9, "*": 8},
    patterns={"Id": r"\d+", "Code": "[a-c]{2}", "Day": r"\d{2}"},
)


def ways(pieces):
    """All ways to give each column neighbouring pieces that fit it."""
    found = []
    for cuts in combinations(range(1, len(pieces)), len(COLUMNS) - 1):
        ends = [0, *cuts, len(pieces)]
        values = ['","'.join(pieces[a:b]) for a, b in zip(ends, ends[1:])]
        if all(
            not v or (len(v) <= TABLE.width(c) and (c not in TABLE.patterns or re.fullmatch(TABLE.patterns[c], v)))
            for c, v in zip(COLUMNS, values)
        ):
            found.append(values)
    return found


def test_against_all_ways(spark):
    draw = random.Random(3)
    words = ["", "7", "12", "ab", "cc", "abc", "word", "long words", "x"]
    data = [
        (i, [draw.choice(words) for _ in range(draw.randrange(1, 9))]) for i in range(600)
    ]
    data += [(600 + i, [str(i), "a word", "ab", "more", "", "12"]) for i in range(20)]
    data += [(700, ["1", "x", "ab", "y", "12"]), (701, [""] * 7), (702, [""])]
    df = spark.createDataFrame(data, "i int, p array<string>")
    way = df.select("i", "p", recovery.alignment(F.col("p"), TABLE).alias("w")).collect()
    seen = set()
    for r in way:
        expected = ways(r.p)
        assert r.w.ways == min(2, len(expected)), r.p
        seen.add(r.w.ways)
        if len(expected) == 1:
            ends = [0, *r.w.cuts]
            assert ['","'.join(r.p[a:b]) for a, b in zip(ends, ends[1:])] == expected[0]
    assert seen == {0, 1, 2}


@pytest.mark.parametrize("line_end", ["\r\n", "\n"])
def test_a_table_with_separators_in_values(spark, tmp_path, line_end):
    given = [
        {"Id": "1", "Note": "plain", "Code": "ab", "More": "x", "Day": "01"},
        {"Id": "2", "Note": 'a","b c', "Code": "ab", "More": "", "Day": "02"},
        {"Id": "3", "Note": 'n","ab', "Code": "ab", "More": "x", "Day": "03"},
        {"Id": "4", "Note": "n", "Code": "", "More": 'X","Y', "Day": "04"},
    ]
    path = save(tmp_path, _written(given, line_end))
    rows, rest = recovery.read_aligned_table(spark, path, TABLE), recovery.unaligned_records(spark, path, TABLE)
    found = {r.Id: r for r in rows.collect() if not r[q.RAGGED]}
    assert sorted(found) == ["1", "2", "4"]
    assert found["2"].Note == 'a","b c' and found["2"].More is None
    assert found["4"].Code is None and found["4"].More == 'X","Y'
    assert not any(r[f] for r in found.values() for f in (q.WIDE, q.REPEATED))
    assert rows.count() == 4 and rows.where(F.col(q.QUOTED)).count() == 1
    assert rows.columns == q.read_extract_table(spark, path, TABLE).columns
    assert [(r.FieldCount, r.Alignments, r.Record[0]) for r in rest.collect()] == [(6, 2, "3")]
    # The last record closes the file, whichever way it is read.
    alone = save(tmp_path, _written(given[1:2], line_end), "alone.csv")
    [row] = recovery.read_aligned_table(spark, alone, TABLE).collect()
    assert row[q.QUOTED] and row.Day == "02"


def _written(rows, line_end):
    lines = [COLUMNS, *([r[c] for c in COLUMNS] for r in rows)]
    return "".join('"' + '","'.join(line) + '"' + line_end for line in lines)


def test_too_few_fields_and_second_headers_stay_out(spark, tmp_path):
    body = _written([{c: "1" for c in COLUMNS}], "\n") + '"1","2"\n'
    path = save(tmp_path, body + _written([], "\n"))
    table = replace(TABLE, patterns={"Id": r"\d+"})
    rows = recovery.read_aligned_table(spark, path, table)
    assert [r.Id for r in rows.where(~F.col(q.RAGGED) & ~F.col(q.REPEATED)).collect()] == ["1"]
    assert rows.where(F.col(q.REPEATED)).count() == 1
    rest = recovery.unaligned_records(spark, path, table).collect()
    assert [(r.FieldCount, r.Alignments) for r in rest] == [(2, 0)]
    with pytest.raises(ValueError):
        Registry((replace(TABLE, patterns={"None": "x"}),))


def test_an_install_takes_recovered_rows_and_refuses_others(spark, tmp_path):
    """Without patterns the extract is refused, as it is where they do not settle a record."""
    name = "Admin_Patient"
    known = {c: "[0-9A-F-]+" for c in LAYOUT[name] if c not in ("Surname", "ODSCode")} | {
        "PatientGuid": r"P\d+", "Deleted": "true|false", "ProcessingId": r"\d+",
    }

    def few(patterns):
        return Registry(
            tuple(replace(t, patterns=patterns if t.name == name else {}) for t in FEW.tables),
            FEW.foreign_keys,
        )

    tables = bulk()
    tables[name] = [patient(1, 1, Surname='Smith","Jones'), patient(2, 1)]
    _, marker = write_extract(tmp_path / "in", "1-9", "20170101020000", tables)
    for number, patterns in enumerate(({}, {"PatientGuid": r"P\d+"}, known)):
        root = str(tmp_path / f"store{number}")
        stage_extract(spark, root, str(tmp_path / "in"), marker, few(patterns))
        if patterns is not known:
            with pytest.raises(ExtractError, match="Admin_Patient: 1 row.s. with a wrong number"):
                install_extract(spark, root, few(patterns))
            continue
        install_extract(spark, root, few(patterns))
        registry = store.read_layout(spark, root, few(patterns))
        found = store.read_history(spark, root, registry.table(name))
        assert sorted((r.PatientGuid, r.Surname, r.Deleted) for r in found.collect()) == [
            ("P1", 'Smith"",""Jones', "false"), ("P2", "Name2", "false"),
        ]


def test_a_filter_does_not_cut_the_record_again_for_every_place(spark, tmp_path):
    """A filter over the flag is moved below the cut; the pieces must stay bound there."""
    path = tmp_path / "t.csv"
    path.write_text('"' + '","'.join(COLUMNS) + '"\n"1","a","b","ab","x","01"\n', newline="")
    rows = recovery.read_aligned_table(spark, str(path), TABLE).where(~F.col(q.RAGGED))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(value") <= 10
    assert [(r.Id, r.Note, r.Code, r.More, r.Day) for r in rows.collect()] == [
        ("1", 'a","b', "ab", "x", "01")
    ]
