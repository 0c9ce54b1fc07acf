from pyspark.sql import functions as F

from tidemark.llm.quality_rules import judged, kept_documents


def test_clashing_columns(table, prose):
    docs = table([(i, " ".join(prose(30 + 2 * i, i)), "en", "s") for i in range(40)])
    plain = sorted(r.doc_id for r in kept_documents(docs).collect())
    names = ("__quality", "__f", "__limits", "given", "verdict", "f", "b", "part", "lang_key", "source_key", "level", "kept", "measure")
    clashing = docs.withColumns({c: F.lit("x") for c in names})
    found = kept_documents(clashing)
    assert found.columns == clashing.columns and sorted(r.doc_id for r in found.collect()) == plain
    assert found.where("__quality = 'x'").count() == len(plain)
    seen = judged(clashing)
    assert sorted(seen.columns) == sorted(clashing.columns)
    assert sorted(r.doc_id for r in seen.where("__quality.kept").collect()) == plain
