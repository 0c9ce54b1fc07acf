"""Quality rules whose limits come from the data: quantile sketches per language and source, then a filter.

A sketch is a histogram of integers with buckets of 7 significant bits, so its quantiles are low by less than
one part in 64. Two sketches merge by adding counts; that is how tasks, sources and languages are
put together, and why a rerun gives the same limits. A source with few documents in a language takes the
language's merged sketch, a language with few the sketch of all.

A document fails a rule if a measure lies beyond the quartile by more than FENCE times the spread of the
middle half (or a least spread, so that a measure that is the same everywhere gives no tight limit).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import bind, saved, words

LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
#: Measure -> (least spread, whether too little is a fault too).
RULES = {"symbols": (20, False), "length": (50, True), "lines": (150, False), "repeats": (100, False)}
FENCE, OWN_SKETCH = 3, 200
#: Parts into which the documents of one language and source are dealt where limits are joined by a shuffle.
PARTS = 32


def features(text: Column) -> Column:
    """Counts of one text as a struct; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counted(w: Column, x: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.when(F.size(w) < 4, F.lit(0)).otherwise(bind(_windows(w), _covered)).cast("long").alias("n_repeat_words"),
        )

    return bind(words(text), lambda w: bind(lines, lambda x: counted(w, x)))


def _windows(w: Column) -> Column:
    """Every three consecutive words as one string."""
    return F.transform(F.slice(w, F.lit(1), F.size(w) - 2), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)))


def _covered(windows: Column) -> Column:
    """Number of words in windows that occur more than once."""

    def again(s: Column) -> Column:
        at = F.filter(
            F.transform(s, lambda x, k: F.when((x["g"] == F.get(s, k - 1)["g"]) | (x["g"] == F.get(s, k + 1)["g"]), x["i"])),
            lambda i: i.isNotNull(),
        )
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

    placed = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(bind(placed, again))


def _failed(f: Column) -> Column:
    return (f["n_words"] < LEAST_WORDS) | (100 * f["n_repeat_words"] > MOST_REPEATED * f["n_words"])


def _measures(f: Column) -> dict[str, Column]:
    """Whole numbers; asked only of documents that have words."""
    div = lambda a, b: F.call_function("div", a, b)
    return {
        "symbols": div(1000 * f["n_symbols"], f["word_chars"]),
        "length": div(100 * f["word_chars"], f["n_words"]),
        "lines": div(1000 * f["n_dup_lines"], f["n_lines"]),
        "repeats": div(1000 * f["n_repeat_words"], f["n_words"]),
    }


def _bucket(v: Column) -> Column:
    """The value cut to its 7 highest bits."""
    shift = F.greatest(F.length(F.bin(v)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)


def _name(value: Column) -> Column:
    """A text for each value, null's own."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def _fences(sketch: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Limits from sketches merged over all but `keys`: (keys, measure, {name} struct(docs, lo, hi))."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("docs").alias("docs"))
    by = Window.partitionBy(*keys, "measure")
    running = merged.withColumn("upto", F.sum("docs").over(by.orderBy("bucket"))).withColumn("all", F.sum("docs").over(by))
    spread = reduce(lambda out, rule: F.when(F.col("measure") == rule, RULES[rule][0]).otherwise(out), RULES, F.lit(0))
    quarters = running.groupBy(*keys, "measure").agg(
        F.max("all").alias("docs"),
        F.min(F.when(4 * F.col("upto") >= F.col("all"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("all"), F.col("bucket"))).alias("q3"),
    )
    wide = FENCE * F.greatest(F.col("q3") - F.col("q1"), spread)
    return quarters.select(*keys, "measure", F.struct("docs", (F.col("q1") - wide).alias("lo"), (F.col("q3") + wide).alias("hi")).alias(name))


def limits(docs: DataFrame) -> DataFrame:
    """(lang_key, source_key, level, one struct(docs, lo, hi) per measure): a row for each language and source.

    level is 0 where the group has sketches of its own, 1 for its language's, 2 for those of all documents.
    """
    f = F.col("f")
    values = F.array(*[F.struct(F.lit(name).alias("measure"), _bucket(v).alias("bucket")) for name, v in _measures(f).items()])
    held = docs.select(_name(F.col("lang")).alias("lang_key"), _name(F.col("source")).alias("source_key"), features(F.col("text")).alias("f"))
    rows = held.select("lang_key", "source_key", F.explode(F.when(~_failed(f), values)).alias("v"))
    sketch = saved(
        rows.groupBy("lang_key", "source_key", F.col("v.measure").alias("measure"), F.col("v.bucket").alias("bucket")).agg(F.count("*").alias("docs")),
        "sketch",
    )
    own = _fences(sketch, ["lang_key", "source_key"], "own")
    lang = _fences(sketch, ["lang_key"], "lang")
    every = _fences(sketch, [], "every")
    of = F.when(F.col("own.docs") >= OWN_SKETCH, F.struct(F.lit(0).alias("level"), "own.*"))
    of = of.when(F.col("lang.docs") >= OWN_SKETCH, F.struct(F.lit(1).alias("level"), "lang.*")).otherwise(F.struct(F.lit(2).alias("level"), "every.*"))
    chosen = own.join(lang, ["lang_key", "measure"]).join(every, "measure").select("lang_key", "source_key", "measure", of.alias("of"))
    return saved(
        chosen.groupBy("lang_key", "source_key").agg(
            F.max("of.level").alias("level"), *[F.max(F.when(F.col("measure") == name, F.col("of"))).alias(name) for name in RULES]
        ),
        "limits",
    )


def judged(docs: DataFrame) -> DataFrame:
    """All rows and columns of docs and a struct column `__quality`: the counts, base_failed, kept and level.

    Null, empty and blank texts have no words and fail. Null languages and sources are groups of their own.
    Equal rows are judged alike; measures exactly at a limit pass. Whatever other columns there
    are passes unchanged, but a column `__quality` is replaced. An empty table gives an empty table. No column but
    text, lang and source (and doc_id, to deal rows out) is looked at.
    """
    given = docs.drop("__quality")
    return _verdicts(given).select("given.*", F.col("verdict").alias("__quality"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that pass, with all their columns, whatever their names; edge cases as in judged()."""
    return _verdicts(docs).where("verdict.kept").select("given.*")


def _verdicts(docs: DataFrame) -> DataFrame:
    """(given, verdict): every row as one column, so that no name can clash, and what is said of it."""
    bounds = limits(docs)
    f = F.col("f")
    measured = docs.select(
        F.struct("*").alias("given"),
        features(F.col("text")).alias("f"),
        _name(F.col("lang")).alias("lang_key"),
        _name(F.col("source")).alias("source_key"),
        F.pmod(F.xxhash64(F.col("doc_id")), F.lit(PARTS)).alias("part"),
    )
    salted = bounds.select("lang_key", "source_key", F.struct("*").alias("b"), F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    b = F.col("b")
    met = measured.join(salted, ["lang_key", "source_key", "part"], "left")
    passes = reduce(
        lambda x, y: x & y,
        [(v <= b[name]["hi"]) & ((v >= b[name]["lo"]) if RULES[name][1] else F.lit(True)) for name, v in _measures(f).items()],
    )
    verdict = F.struct(
        "f.*",
        _failed(f).alias("base_failed"),
        F.when(_failed(f), F.lit(False)).otherwise(passes).alias("kept"),
        b["level"].alias("level"),
    )
    return met.select("given", verdict.alias("verdict"))
