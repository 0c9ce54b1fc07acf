import duckdb
from pyspark.sql import functions as F

from tidemark.llm.mixing import BLOCK, mixed_copies, mixed_documents, mixed_words, schedule
from tidemark.llm.oracle import ORACLE

GIVEN = "/root/testdata/sf0.01"


def test_sources_come_near_their_targets():
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{GIVEN}/documents.parquet'")
    con.execute(f"create table mix as {ORACLE['op8_source_mixing']}")
    rows = con.execute(
        "select any_value(target), sum(taken), any_value(source_size), sum(size), max(taken - 2 * size) from mix "
        "join documents using (doc_id) group by source order by source"
    ).fetchall()
    assert len(rows) == 20 and all(size == total and worst <= 0 for *_, size, total, worst in rows)
    assert all(abs(taken - target) <= max(3 * BLOCK, 0.02 * target) for target, taken, *_ in rows)
    assert abs(sum(r[0] for r in rows) - 1.5 * sum(r[2] for r in rows)) < 1


def test_schedule_spreads_each_source_evenly(spark):
    aims = spark.createDataFrame(
        [("=a", 600_000, 0, 2576980377), ("=b", 300_000, 2576980377, 3865470566), ("=c", 100_000, 3865470566, 1 << 32)],
        "key string, words long, lo long, hi long",
    )
    slots = schedule(spark, aims, 100).collect()
    assert sorted(s.slot for s in slots) == list(range(10_000))
    for key, share in (("=a", 0.6), ("=b", 0.3), ("=c", 0.1)):
        own = sorted((s.slot, s["rank"]) for s in slots if s.key == key)
        assert [r for _, r in own] == list(range(len(own)))
        assert all(abs((i + 1) - share * (slot + 1)) < 4 for i, (slot, _) in enumerate(own))


def test_pieces_tile_the_documents(table, prose):
    rows = [(i, " ".join(prose(10 + 37 * i % 400, i)), "en", f"s{i % 3}") for i in range(60)] + [(99, None, "en", None)]
    docs = table(rows)
    pieces = mixed_words(docs, 64).where("slot is not null").collect()
    words = {i: len(t.split()) for i, t, *_ in rows if t}
    assert all(0 <= p.first_word and p.first_word + p.taken <= words[p.doc_id] and p.taken > 0 for p in pieces)
    per_slot = {}
    for p in pieces:
        per_slot[p.slot] = per_slot.get(p.slot, 0) + p.taken
    assert max(per_slot.values()) <= 64
    once = mixed_documents(docs, 64)
    again = mixed_documents(docs.repartition(7, F.rand(3)), 64)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)
    taken = {r.doc_id: (r.taken, r.size) for r in once.collect()}
    copies = {r["doc_id"]: r["count"] for r in mixed_copies(docs, 64).groupBy("doc_id").count().collect()}
    assert all(copies.get(d, 0) == (int(t / s + 0.5) if s else 0) for d, (t, s) in taken.items())


def test_clashing_columns(table, prose):
    docs = table([(i, " ".join(prose(20, i)), "en", "s") for i in range(20)])
    plain = sorted(r.doc_id for r in mixed_copies(docs, 64).collect())
    names = ("__id", "__times", "__copy", "given", "id", "times", "t", "s", "key", "part", "row", "col")
    found = mixed_copies(docs.withColumns({c: F.lit("x") for c in names}), 64)
    assert found.columns == [*docs.columns, *names] and sorted(r.doc_id for r in found.collect()) == plain
