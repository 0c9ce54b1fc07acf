import pytest
from pyspark.sql import functions as F

from tests.extracts import text
from tidemark.registry import COMMON, Table
from tidemark.sources import quoted_text as q
from tidemark.sources.discover import discover_extracts, list_files
from tidemark.sources.shared import shared_folder

COLUMNS = ["Id", "Note", "Last"]
TABLE = Table("t", COMMON, ("Id",), tenant=None, columns=tuple(COLUMNS), widths={"Note": 12})


def save(tmp_path, body, name="t.csv"):
    path = tmp_path / name
    path.write_bytes(body.encode("utf-8"))
    return str(path)


def records(n):
    return [
        {"Id": str(i), "Note": f'a\r\nb "{i}"' if i % 3 else "", "Last": f"z{i}"}
        for i in range(1, n + 1)
    ]


@pytest.mark.parametrize("line_end", ["\r\n", "\n"])
def test_values_and_flags(spark, tmp_path, line_end):
    path = save(tmp_path, text(COLUMNS, records(4), line_end))
    shape = q.read_shape(spark, path)
    assert shape.columns == tuple(COLUMNS) and shape.line_end == line_end
    found = {r.Id: r for r in q.read_extract_table(spark, path, TABLE).collect()}
    assert sorted(found) == ["1", "2", "3", "4"]
    assert found["1"].Note == 'a\r\nb ""1""'
    assert found["3"].Note is None
    assert [found[i].Last for i in "1234"] == ["z1", "z2", "z3", "z4"]
    assert [found[i][q.QUOTED] for i in "1234"] == [False, False, False, True]
    assert not any(r[q.RAGGED] or r[q.REPEATED] or r[q.WIDE] for r in found.values())


@pytest.mark.parametrize("line_end", ["\r\n", "\n"])
def test_a_file_is_cut_anywhere(spark, tmp_path, line_end):
    """Every split size gives the same rows: no record is lost or doubled at a boundary."""
    expected = records(60)
    path = save(tmp_path, text(COLUMNS, expected, line_end))
    shape = q.read_shape(spark, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (37, 100, 333):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            df = q.read_extract_table(spark, path, TABLE, shape)
            assert df.rdd.getNumPartitions() > 3
            found = df.agg(
                F.count("*"), F.count_distinct("Id"), F.count_if(q.QUOTED), F.count_if(q.RAGGED),
                F.min("Last"),
            ).first()
            assert tuple(found) == (60, 60, 1, 0, "z1"), size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_header_alone_and_no_final_line_end(spark, tmp_path):
    alone = save(tmp_path, text(COLUMNS, []), "alone.csv")
    assert q.read_extract_table(spark, alone, TABLE).count() == 0
    body = text(COLUMNS, records(2)).removesuffix("\r\n")
    rows = q.read_extract_table(spark, save(tmp_path, body, "open.csv"), TABLE)
    assert [r.Last for r in rows.orderBy("Id").collect()] == ["z1", "z2"]
    with pytest.raises(ValueError, match="empty"):
        q.read_shape(spark, save(tmp_path, "", "empty.csv"))
    with pytest.raises(ValueError, match="not quoted"):
        q.read_shape(spark, save(tmp_path, "Id,Note\n", "plain.csv"))


def test_a_row_like_the_header_stays(spark, tmp_path):
    """Only the first record is the header, even if a first field starts with a doubled quote."""
    path = save(tmp_path, text(COLUMNS, [{"Id": '"Id', "Note": "Note", "Last": "x"}]))
    assert q.read_extract_table(spark, path, TABLE).first().Id == '""Id'


def test_damage_shows(spark, tmp_path):
    whole = text(COLUMNS, records(3))

    def counts(body, name):
        rows = q.read_extract_table(spark, save(tmp_path, body, name), TABLE)
        return rows.agg(*[F.count_if(f).alias(f) for f in q.FLAGS]).first()

    assert counts(whole[:-4], "cut.csv")[q.QUOTED] == 0
    assert counts(whole * 2, "joined.csv")[q.REPEATED] == 1
    ended = [{"Id": "1", "Note": "", "Last": 'the "end"'}, {"Id": "2", "Last": "x"}]
    assert counts(text(COLUMNS, ended), "ended.csv")[q.QUOTED] == 2
    body = text(COLUMNS, []) + '"1","a","b","x"\r\n'
    assert counts(body, "ragged.csv")[q.RAGGED] == 1
    rejected = q.rejected_records(spark, save(tmp_path, body, "ragged2.csv"), TABLE).first()
    assert rejected.FieldCount == 4 and rejected.Record.startswith('1","a","b","x')
    assert counts(text(COLUMNS, [{"Id": "1", "Note": "x" * 13}]), "wide.csv")[q.WIDE] == 1


def test_quote_counts_and_widths(spark, tmp_path, rows):
    save(tmp_path, text(COLUMNS, records(3)), "a.csv")
    save(tmp_path, text(COLUMNS, records(2))[:-4], "b.csv")
    save(tmp_path, text(COLUMNS, []), "c.csv")
    found = q.quote_counts(q.read_extract_table(spark, str(tmp_path), TABLE))
    assert rows(found, "Rows", "QuotedRows", "Problem") == [
        (2, 0, "no row contains a trailing quote"), (3, 1, None),
    ]
    df = spark.createDataFrame([("1", "x" * 20, None), ("22", "y", None)], "Id string, Note string, Last string")
    assert rows(q.check_widths(df, TABLE)) == [
        ("Id", 50, 2, 0), ("Last", 50, None, 0), ("Note", 12, 20, 1),
    ]


def test_discovery(spark, tmp_path):
    guid = "0f8fad5b-d9cb-469f-a165-70867728950e"
    for folder, start in (("b", 26), ("a", 1)):
        (tmp_path / folder).mkdir()
        for table in ("Admin_Location", "Admin_OrganisationLocation"):
            save(tmp_path / folder, "x", f"{start}-50_{table}_20170102030405_{guid}.CSV")
    save(tmp_path, "x", "notes.txt")
    assert list_files(spark, str(tmp_path)).count() == 4
    found = discover_extracts(spark, str(tmp_path), "Admin", "Location").collect()
    assert [(r.Directory[-1], r.ProcessingIdStart) for r in found] == [("a", 1), ("b", 26)]


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
