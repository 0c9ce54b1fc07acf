"""Tables that come as a folder of files, each with its header and its closing quote."""

import glob
import os

import pytest

from tests import extracts as x
from tidemark.care_records import CARE_RECORDS
from tidemark.plans.install import ExtractError, install_all
from tidemark.sources import history as store
from tidemark.sources.discover import list_files

END = '"\r\n'


def split(path, parts):
    """The file as a folder of its name with so many files in it."""
    with open(path, encoding="utf-8", newline="") as file:
        header, *records = file.read().removesuffix(END).split(END + '"')
    os.remove(path)
    os.makedirs(path)
    for i in range(parts):
        text = (END + '"').join([header, *records[i::parts]]) + END
        with open(f"{path}/part-{i}.csv", "w", encoding="utf-8", newline="") as file:
            file.write(text)
    return len(records)


@pytest.fixture
def extract(tmp_path):
    def of(name):
        folder = str(tmp_path / name)
        x.write_extract(f"{folder}/e1", "1-100", "20170101020000", x.bulk())
        return folder
    return of


def rows_of(spark, root):
    registry = store.read_layout(spark, root, CARE_RECORDS)
    return {
        t.name: sorted(map(tuple, store.read_history(spark, root, t).collect()), key=repr)
        for t in registry.tables
    }


def test_same_rows_as_from_one_file(spark, extract, tmp_path):
    one, several = extract("one"), extract("several")
    files = sorted(glob.glob(f"{several}/e1/*.csv"))
    cut = [split(path, 3) for path in files]
    assert max(cut) >= 3, "some table has rows in every file"
    listed = {(r.FileName, r.path.rsplit("/", 2)[-2]) for r in list_files(spark, several).collect()}
    assert listed == {(os.path.basename(f), "e1") for f in files}
    install_all(spark, f"{tmp_path}/s1", one)
    install_all(spark, f"{tmp_path}/s2", several)
    assert rows_of(spark, f"{tmp_path}/s1") == rows_of(spark, f"{tmp_path}/s2")


def test_a_file_cut_off_is_refused(spark, extract, tmp_path):
    folder = extract("cut")
    path = max(glob.glob(f"{folder}/e1/*.csv"), key=os.path.getsize)
    assert split(path, 2) >= 2
    with open(f"{path}/part-1.csv", "rb+") as file:
        file.truncate(os.path.getsize(f"{path}/part-1.csv") - len(END))
    with pytest.raises(ExtractError, match="no row contains a trailing quote in .*part-1.csv"):
        install_all(spark, f"{tmp_path}/s", folder)
