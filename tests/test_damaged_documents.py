"""The damaged text query meets whole texts: line ends, quotes and more than one file."""

from pyspark.sql import functions as F

from checks.queries import QUERIES, _damaged_documents
from tidemark.registry import PRACTICE, Table
from tidemark.sources import quoted_text as q


def saved(spark, tmp_path, rows, parts):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_whole_texts_reach_the_reader(spark, tmp_path):
    texts = [f'line {i}\n\r\nthe "quoted" part' + " word" * (100 * (i % 4)) for i in range(40)]
    given = [(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)] + [(40, None, "en", "src0", None)]
    folder = saved(spark, tmp_path, given, 4)
    path = _damaged_documents(spark, folder)
    files = spark.read.text(path).select(F.col("_metadata.file_path")).distinct().count()
    assert files > 2
    table = Table("documents", PRACTICE, columns=("doc_id", "text"), widths={"text": 40})
    found = q.read_extract_table(spark, path, table)
    got = {int(r.doc_id): r for r in found.where(~F.col(q.REPEATED)).collect()}
    assert sorted(got) == [i for i in range(41) if i % 10 != 7] and got[40].text is None
    for i, t in enumerate(texts):
        if i in got:  # the last record of a file loses its quotes and line ends with the closing quote
            assert got[i].text == ("".join(c for c in t if c not in '"\r\n') if got[i][q.QUOTED] else t.replace('"', '""'))
    assert found.where(F.col(q.REPEATED)).count() == 4 and found.where(F.col(q.RAGGED)).count() == 4
    assert found.where(q.QUOTED).count() >= 1
    counted = QUERIES["quoted_text_damaged"](spark, folder)
    assert counted.agg(F.sum("n")).first()[0] == 41


def test_empty_table(spark, tmp_path):
    assert QUERIES["quoted_text_damaged"](spark, saved(spark, tmp_path, [], 1)).count() == 0
