import zlib

from pyspark.sql import functions as F

from tidemark.llm.language import DICTIONARY, SAMPLE_CHARS, Sizes, dictionaries, identified, language_predictions

GIVEN = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet")
    found = language_predictions(docs).join(docs.select("doc_id", "lang", F.length("text").alias("n")), "doc_id").collect()
    out = [r for r in found if r.held_out]
    assert {r.doc_id for r in out} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    right = [r for r in out if r.lang_pred == r.lang]
    assert len(right) > 0.98 * len(out), (len(right), len(out))
    sure = [r for r in out if r.accepted]
    assert len(sure) > 0.9 * len(out) and sum(r.lang_pred == r.lang for r in sure) > 0.98 * len(sure)
    assert all(0 <= r.score <= 1 for r in found) and {r.lang_pred for r in found} <= {"en", "fr", "de", "es", "und"}


def test_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    other = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    rows = lambda df: sorted(tuple(r) for r in language_predictions(df).collect())
    assert rows(docs) == rows(other)


def test_dictionaries_are_bounded_and_whole_texts_count(table, prose):
    rows = [(i, " ".join(prose(400, i)), f"l{i % 3}") for i in range(60)]
    known = dictionaries(table(rows))
    assert sorted(known) == ["l0", "l1", "l2"] and all(0 < len(d) <= DICTIONARY for d in known.values())
    assert all(len(d) <= 20 * (SAMPLE_CHARS * 4 + 1) for d in known.values())
    tail = "zebra xylophone " * 50
    sizes = Sizes({"a": (tail * 3).encode(), "b": " ".join(prose(500, 1)).encode()})
    assert sizes.predicted(" ".join(prose(3, 99)) + " " + tail)[0] == "a"


def test_words_count_wherever_they_begin(table, prose):
    """Texts that begin with signs are learned from like others."""
    german = ["der Hund läuft über die Straße und bellt laut", "wir gehen heute nicht mehr aus dem Haus", "das Wetter bleibt schön und warm"]
    english = ["the dog runs over the street and barks", "we will not leave the house any more today", "the weather stays fine and warm"]
    rows = [(i, "." * 400 + " ".join(german[(i + k) % 3] for k in range(6)), "de") for i in range(300)]
    rows += [(1000 + i, " ".join(english[(i + k) % 3] for k in range(6)), "en") for i in range(300)]
    found = language_predictions(table(rows)).collect()
    assert all(r.lang_pred == ("de" if r.doc_id < 1000 else "en") for r in found)


def test_many_languages(table, prose):
    rows = [(5 * i + k, " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{w}" for w in prose(40, 1)[k:]), f"l{i}") for i in range(600) for k in range(5)]
    known = dictionaries(table(rows))
    assert len(known) == 600 and sum(map(len, known.values())) <= 1 << 22
    found = language_predictions(table(rows)).collect()
    assert sum(r.lang_pred == f"l{r.doc_id // 5}" for r in found) > 0.95 * len(found)


def test_against_zstandard_itself(table, prose):
    """Dictionaries and sizes by loops over all rows; the sample's bounds are not reached here."""
    import re

    import zstandard
    from xxhash import xxh64

    rows = [(i, " ".join(prose(60, i)) if i % 3 else " ".join(w + "en" for w in prose(60, i)), ("x", "y")[i % 3 > 0]) for i in range(40)]
    docs = table(rows)
    marks = {r.doc_id: r.m for r in docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("m")).collect()}
    assert marks[1] == int.from_bytes(xxh64(b"1", 42).digest(), "big", signed=True)
    taught = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    plain = lambda t: re.sub(r"[\W\d_]+", " ", t.lower())
    held = {}
    for d, text, lang in sorted(taught, key=lambda r: -marks[r[0]]):
        held.setdefault(lang, []).append(plain(text[:400]))
    order = sorted(held, key=lambda x: (-len(held[x]), x))
    sizes = {}
    for lang in order:
        content = zstandard.ZstdCompressionDict(" ".join(held[lang]).encode()[-65536:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        tool = zstandard.ZstdCompressor(level=7, dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False)
        for d, text, _ in rows:
            data = plain(text).encode()
            sizes[d, lang] = sum(len(tool.compress(data[i : i + 512])) for i in range(0, len(data), 512))
    right = 0
    for r in language_predictions(docs).collect():
        a, b = sorted((sizes[r.doc_id, lang], order.index(lang)) for lang in order)
        right += r.lang_pred == order[a[1]] and abs(r.score - (1 - a[0] / b[0])) < 0.02
    assert right == len(rows)


def test_edges(table, edge_rows):
    docs = table([*edge_rows, (70, "123² ... !", "en"), (71, "é", "de")]).withColumns({c: F.lit(0) for c in ("lang_pred", "score", "mark", "rank")})
    found = identified(docs, {"a": b"some words in one tongue", "b": b"etwas ganz anderes hier"})
    got = sorted(((str(r.doc_id), r.lang_pred) for r in found.collect()))
    assert len(got) == len(edge_rows) + 2
    assert [p for d, p in got if d in ("1", "2", "3", "70")] == ["und"] * 4 and ("71", "a") in got
    assert {r.lang_pred for r in identified(docs, {}).collect()} == {"und"}
    assert [r.held_out for r in language_predictions(docs).where("doc_id is null").collect()] == [False]
    assert language_predictions(table([])).count() == 0
