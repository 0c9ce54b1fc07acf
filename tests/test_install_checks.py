import pytest

from tidemark.plans.install import ExtractError, _check_complete, _check_tallies, _rows_read, _tallies
from tidemark.sources.quoted_text import FLAGS

SCHEMA = "v int, " + ", ".join(f"{f} boolean" for f in FLAGS)


def test_each_table_is_tallied_by_itself_and_empty_ones_are_left_out(spark):
    one = spark.createDataFrame([(1, True, False, False, False), (2, False, False, False, None)], SCHEMA)
    tables = {"a": one, "b": one.where("v > 9"), "c": one.unionByName(one)}
    tallies = _tallies(tables)
    assert {t: r.n for t, r in tallies.items()} == {"a": 2, "c": 4}
    assert _rows_read(tables) == {"a": 2, "b": 0, "c": 4}
    assert _tallies({}) == {} and _rows_read({}) == {}
    assert _check_tallies(tallies, {"c"}) == {"a": 2, "c": 4}
    with pytest.raises(ExtractError, match="^c: more than one row contains a trailing quote$"):
        _check_tallies(tallies, ())


def test_rows_doubled_or_lost_on_the_way_are_told(spark):
    wrote = spark.createDataFrame([("a", 2), ("a", 1), ("b", 4)], "TableName string, Rows long")
    _check_complete({"a": 3, "b": 4}, wrote)
    with pytest.raises(ExtractError, match=r"^2 row\(s\) of a became 3; 1 row\(s\) of c became 0$"):
        _check_complete({"a": 2, "c": 1}, wrote)
