import pytest

from tidemark.functions.keys import guid_text, is_filled, tenant_key, whole_number
from tidemark.functions.names import with_parsed_name
from tidemark.functions.text import (
    has_trailing_quote,
    listed,
    parts,
    split_rows,
    without_trailing_quote,
)

GUID = "0f8fad5b-d9cb-469f-a165-70867728950e"


def test_names(spark):
    cases = {
        f"1-25_Admin_Location_20170102030405_{GUID}.csv": None,
        f"1-25_Admin_Location_20170102030405_{{{GUID.upper()}}}.CSV": None,
        None: "null",
        f"1-25_Admin_Location_20170102030405_{GUID}.txt": "end in .csv",
        f"1-25_Admin_Location_{GUID}.csv": "five parts",
        f"1-25_Admin_Loc_ation_20170102030405_{GUID}.csv": "five parts",
        "1-25_Admin_Location_20170102030405_nope.csv": "identifier",
        f"125_Admin_Location_20170102030405_{GUID}.csv": "a pair",
        f"1-2-5_Admin_Location_20170102030405_{GUID}.csv": "a pair",
        f"1-x_Admin_Location_20170102030405_{GUID}.csv": "not a number",
        f"1-2.0_Admin_Location_20170102030405_{GUID}.csv": "not a number",
        f"1-25__Location_20170102030405_{GUID}.csv": "is empty",
        f"1-25_Admin_ _20170102030405_{GUID}.csv": "is empty",
        f"1-25_Admin_Location_2017010203040_{GUID}.csv": "14 digits",
        f"1-25_Admin_Location_20171302030405_{GUID}.csv": "not a date",
        f"1-25_Admin_Location_2017010203040x_{GUID}.csv": "not a date",
        ".csv": "five parts",
        "": "end in .csv",
    }
    names = spark.createDataFrame([(n,) for n in cases], "name string")
    found = {r["name"]: r for r in with_parsed_name(names, "name").collect()}
    for name, problem in cases.items():
        row = found[name]
        if problem:
            assert problem in row.parse_error, name
            assert row.ProcessingIdStart is None and row.SharingAgreementGuid is None
        else:
            assert row.parse_error is None
            assert (row.ProcessingIdStart, row.ProcessingIdEnd) == (1, 25)
            assert (row.SchemaName, row.TableName) == ("Admin", "Location")
            assert str(row.ExtractDate) == "2017-01-02 03:04:05"
            assert row.SharingAgreementGuid == GUID.upper()


@pytest.mark.parametrize("delimiter", ["_", ".", "|", "\\", "^"])
def test_split(spark, rows, delimiter):
    texts = ["", "a", f"a{delimiter}b", f"{delimiter}a{delimiter}{delimiter}", delimiter]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    expected = sorted(
        ((t, i, part) for t in texts for i, part in enumerate(t.split(delimiter), 1)), key=repr
    )
    assert rows(split_rows(df, "t", delimiter), "t", "Id", "Data") == expected


def test_split_takes_one_character():
    with pytest.raises(ValueError):
        parts("t", "ab")


def test_values(spark):
    df = spark.createDataFrame(
        [(None,), ("",), ("  ",), ("x",), ('end"\r\n',), ('say "no"',), ('a"b',)], "t string"
    )
    found = {
        r.t: r for r in df.select(
            "t",
            is_filled("t").alias("filled"),
            has_trailing_quote("t").alias("quoted"),
            without_trailing_quote("t").alias("repaired"),
        ).collect()
    }
    assert [found[t].filled for t in (None, "", "  ", "x")] == [False, False, False, True]
    assert found['end"\r\n'].quoted and found['end"\r\n'].repaired == "end"
    assert found['say "no"'].repaired == "say no"
    assert not found['a"b'].quoted and found['a"b'].repaired == 'a"b'
    assert found[None].quoted is False and found[None].repaired is None


def test_identifiers(spark):
    df = spark.createDataFrame([(f"{{{GUID}}}", " +12 ", "b"), ("x", "1e3", "a")], "g string, n string, t string")
    good, bad = df.select(
        guid_text("g"), tenant_key("g"), whole_number("n")
    ).collect()
    assert tuple(good) == (GUID.upper(), GUID.upper(), 12)
    assert tuple(bad) == (None, "X", None)
    assert df.agg(listed("t").alias("x")).first().x == "a, b"
    assert df.where("false").agg(listed("t", "'").alias("x")).first().x is None
    assert df.agg(listed("t", "'").alias("x")).first().x == "a'b"
