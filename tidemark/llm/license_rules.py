"""Licences named in texts: ordered signature rules, gated by keywords, overlaps resolved by containment.

A rule is a pattern over a text's words with a label, a priority and a keyword that every match holds. Only rules
whose keyword is among a text's words are tried. A detection yields to one of higher order whose words
contain its own: first the higher priority counts, then the longer match, then the earlier rule.

Words are lower-cased (A-Z) and joined by one space, with one at either end, so patterns are written
in words and spaces; what separates words (all ASCII but letters and digits) does not matter.
"""

from __future__ import annotations

import re
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import bind

#: Phrases that always count, with their labels (fixed values of the task).
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Label -> (keyword, how texts name it, its short identifier in words). What follows a blank or -long only tells
#: names of one label apart.
FAMILIES = {
    "mit": ("mit", "mit(?: expat)?", "mit"),
    "apache-1": ("apache", "apache(?: software)?(?: license)?(?: version| ver| v)? v?1(?: [01])?", "apache 1 [01]"),
    "apache-2": ("apache", "apache(?: software)?(?: license)?(?: version| ver| v)? v?2(?: 0)?", "apache 2 0"),
    "gpl-1": ("gpl", "(?:gnu )?gpl(?: version| ver| v)? v?1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    "gpl-2": ("gpl", "(?:gnu )?gpl(?: version| ver| v)? v?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    "gpl-3": ("gpl", "(?:gnu )?gpl(?: version| ver| v)? v?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    "gpl-2-long": ("gnu", "gnu general public license(?: gpl)?(?: version| ver| v)? v?2(?: 0)?", "gnu gpl 2 0"),
    "gpl-3-long": ("gnu", "gnu general public license(?: gpl)?(?: version| ver| v)? v?3(?: 0)?", "gnu gpl 3 0"),
    "lgpl-2": ("lgpl", "(?:gnu )?lgpl(?: version| ver| v)? v?2(?: [01])?", "lgpl 2 [01](?: only| or later)?"),
    "lgpl-3": ("lgpl", "(?:gnu )?lgpl(?: version| ver| v)? v?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    "lgpl-2-long": ("lesser", "(?:gnu )?lesser general public license(?: lgpl)?(?: version| ver| v)? v?2(?: [01])?", "gnu lgpl 2 [01]"),
    "lgpl-3-long": ("lesser", "(?:gnu )?lesser general public license(?: lgpl)?(?: version| ver| v)? v?3(?: 0)?", "gnu lgpl 3 0"),
    "lgpl": ("lesser", "(?:gnu )?lesser general public license", "gnu lesser gpl"),
    "lgpl library": ("library", "gnu library general public license(?: version| ver| v)?(?: v?2(?: 0)?)?", "gnu library gpl"),
    "agpl-3": ("agpl", "(?:gnu )?agpl(?: version| ver| v)? v?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    "agpl-3-long": ("affero", "(?:gnu )?affero general public license(?: agpl)?(?: version| ver| v)? v?3(?: 0)?", "gnu agpl 3 0"),
    "agpl": ("affero", "(?:gnu )?affero general public license", "gnu affero gpl"),
    "mpl-1": ("mozilla", "mozilla public license(?: version| ver| v)? v?1(?: [01])?", "mozilla 1 [01]"),
    "mpl-2": ("mozilla", "mozilla public license(?: version| ver| v)? v?2(?: 0)?", "mozilla 2 0"),
    "mpl-1 short": ("mpl", "mpl(?: version| ver| v)? v?1(?: [01])?", "mpl 1 [01]"),
    "mpl-2 short": ("mpl", "mpl(?: version| ver| v)? v?2(?: 0)?", "mpl 2 0"),
    "mpl": ("mpl", "mpl", "mpl"),
    "bsd-2": ("bsd", "(?:bsd(?: 2| two) clause|(?:simplified|freebsd) bsd)", "bsd 2 clause"),
    "bsd-3": ("bsd", "(?:bsd(?: 3| three) clause|(?:new|revised|modified) bsd)", "bsd 3 clause"),
    "bsd-3-clear": ("bsd", "bsd(?: 3| three) clause clear", "bsd 3 clause clear"),
    "bsd-4": ("bsd", "(?:bsd(?: 4| four) clause|original bsd)", "bsd 4 clause"),
    "isc": ("isc", "isc", "isc"),
    "zlib": ("zlib", "zlib(?: libpng)?", "zlib"),
    "cc0": ("cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    "cc-by": ("cc", "cc by(?: [1234] [05])?", "cc by [1234] [05]"),
    "cc-by-sa": ("cc", "cc by sa(?: [1234] [05])?", "cc by sa [1234] [05]"),
    "cc-by-nc": ("cc", "cc by nc(?: [1234] [05])?", "cc by nc [1234] [05]"),
    "cc-by-nd": ("cc", "cc by nd(?: [1234] [05])?", "cc by nd [1234] [05]"),
    "cc-by-nc-sa": ("cc", "cc by nc sa(?: [1234] [05])?", "cc by nc sa [1234] [05]"),
    "cc-by-nc-nd": ("cc", "cc by nc nd(?: [1234] [05])?", "cc by nc nd [1234] [05]"),
    "cc-by-long": ("commons", "creative commons attribution(?: [1234] [05])?(?: international| unported| generic)?", ""),
    "cc-by-sa-long": ("commons", "creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)?", ""),
    "cc-by-nd-long": ("commons", "creative commons attribution no ?deriv(?:ative)?s(?: [1234] [05])?(?: international| unported| generic)?", ""),
    "cc-by-nc-long": ("commons", "creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported| generic)?", ""),
    "cc-by-nc-sa-long": ("commons", "creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported| generic)?", ""),
    "cc-by-nc-nd-long": ("commons", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234] [05])?(?: international| unported| generic)?", ""),
    "creative-commons": ("commons", "creative commons", "creative commons"),
    "unlicense": ("unlicense", "unlicense", "unlicense"),
    "wtfpl": ("wtfpl", "wtfpl(?: version| ver| v)?(?: v?2)?", "wtfpl"),
    "epl-1": ("eclipse", "eclipse public license(?: version| ver| v)? v?1(?: 0)?", "eclipse 1 0"),
    "epl-2": ("eclipse", "eclipse public license(?: version| ver| v)? v?2(?: 0)?", "eclipse 2 0"),
    "epl-1 short": ("epl", "epl(?: version| ver| v)? v?1(?: 0)?", "epl 1 0"),
    "epl-2 short": ("epl", "epl(?: version| ver| v)? v?2(?: 0)?", "epl 2 0"),
    "cddl": ("cddl", "cddl(?: version| ver| v)?(?: v?1 [01])?", "cddl 1 [01]"),
    "eupl": ("eupl", "eupl(?: version| ver| v)?(?: v?1 [0-2])?", "eupl 1 [0-2]"),
    "artistic": ("artistic", "artistic(?: license)?(?: version| ver| v)?(?: v?[12](?: 0)?)?", "artistic [12] 0"),
    "boost": ("boost", "boost software(?: license)?(?: version| ver| v)?(?: v?1(?: 0)?)?", "boost 1 0"),
    "ofl": ("font", "(?:sil )?open font(?: license)?(?: version| ver| v)?(?: v?1 [01])?", "open font 1 [01]"),
    "python": ("psf", "psf(?: license)?(?: version| ver| v)?(?: v?2(?: 0)?)?", "psf 2 0"),
    "php": ("php", "php(?: license)?(?: version| ver| v)? v?3(?: 0[01])?", "php 3 0[01]"),
    "postgresql": ("postgresql", "postgresql", "postgresql"),
    "ncsa": ("ncsa", "(?:university of illinois )?ncsa(?: open source)?", "ncsa"),
    "ms-pl": ("microsoft", "microsoft (?:public|reciprocal)", "microsoft public"),
    "odbl": ("odbl", "odbl(?: 1 0)?", "odbl 1 0"),
    "public-domain": ("domain", "public domain(?: dedication)?", "public domain"),
}

#: Abbreviations written in one word with a version: gplv3, gpl3.
FAMILIES |= {
    f"{label} {stem}{v}{number}": (f"{stem}{v}{number}", f"(?:gnu )?{stem}{v}{number}{rest}", f"{stem}{v}{number}{rest}(?: only| or later)?")
    for label, stem, number, rest in (
        ("gpl-1", "gpl", 1, "(?: 0)?"), ("gpl-2", "gpl", 2, "(?: 0)?"), ("gpl-3", "gpl", 3, "(?: 0)?"),
        ("lgpl-2", "lgpl", 2, "(?: [01])?"), ("lgpl-3", "lgpl", 3, "(?: 0)?"), ("agpl-3", "agpl", 3, "(?: 0)?"),
        ("mpl-1", "mpl", 1, "(?: [01])?"), ("mpl-2", "mpl", 2, "(?: 0)?"), ("epl-1", "epl", 1, "(?: 0)?"), ("epl-2", "epl", 2, "(?: 0)?"),
    )
    for v in ("v", "")
}

#: The same without a version or clause count: of lower order than any rule that knows it.
UNVERSIONED = {
    "gpl": ("gpl", "(?:gnu )?gpl", "gpl"),
    "gpl-long": ("gnu", "gnu general public license(?: gpl)?", "gnu gpl"),
    "lgpl short": ("lgpl", "(?:gnu )?lgpl", "lgpl"),
    "agpl short": ("agpl", "(?:gnu )?agpl", "agpl"),
    "apache": ("apache", "apache(?: software)?", "apache"),
    "bsd": ("bsd", "bsd(?: style)?", "bsd"),
    "mpl-long": ("mozilla", "mozilla public license", "mozilla"),
    "epl": ("eclipse", "eclipse public license", "eclipse"),
}

#: Families whose name alone, without a word like "license" or "under" beside it, says that it is a licence.
ALONE = ("gpl", "lgpl", "agpl", "mpl-1", "mpl-2", "mpl-long", "epl", "bsd-2", "bsd-3", "bsd-4", "cc-by", "unlicense")
NOT_ALONE = ("apache", "bsd", "mpl")

#: Priority and pattern of the ways to name a licence; {name} and {short} are a family's.
WAYS = (
    (100, "spdx license identifier {short}"),
    (90, "(?:dual )?licensed under (?:the )?(?:terms of (?:the )?)?{name}(?: license)?"),
    (85, "(?:released|distributed|available|provided|published|covered) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{name}(?: license)?"),
    (80, "under (?:the )?(?:terms of (?:the )?)?{name} license(?: version [1-4])?"),
    (70, "(?:the )?{name} license(?: version [1-4](?: [0-9])?)?"),
    (60, "license (?:is )?(?:the )?{name}"),
)
BY_NAME = (55, "{name}")

#: A further licence of a list that such a way, or an identifier, begins: "MIT OR Apache-2.0", "under GPL and MIT".
FURTHER = (88, "(?:or|and) (?:the )?{either}(?: license)?(?<= (?:licensed under|spdx license identifier) [a-z0-9 ]{1,64})")

#: Rules of their own: keyword, label, priority, pattern.
OTHERS = (
    ("apache", "apache-2", 75, "apache license version 2(?: 0)?(?: january 2004)?"),
    ("apache", "apache-2", 72, "apache(?: software)? license(?: version| ver| v)? v?2(?: 0)?"),
    ("apache", "apache-1", 72, "apache(?: software)? license(?: version| ver| v)? v?1(?: [01])?"),
    ("foundation", "gpl-2", 75, "gnu general public license as published by the free software foundation (?:either )?version 2"),
    ("foundation", "gpl-3", 75, "gnu general public license as published by the free software foundation (?:either )?version 3"),
    ("foundation", "lgpl-2", 75, "gnu lesser general public license as published by the free software foundation (?:either )?version 2(?: 1)?"),
    ("foundation", "lgpl-3", 75, "gnu lesser general public license as published by the free software foundation (?:either )?version 3"),
    ("foundation", "agpl-3", 75, "gnu affero general public license as published by the free software foundation (?:either )?version 3"),
    ("apache", "apache-2", 55, "apache 2 0(?! [0-9])"),
    ("cc", "cc-by-nc", 75, "cc by nc"),
    ("cc", "cc-by", 40, "cc by"),
    ("merchantability", "warranty-disclaimer", 50, "without (?:any )?warranty (?:of )?(?:merchantability|fitness)"),
    ("warranty", "warranty-disclaimer", 45, "without warranty of any kind"),
    ("rights", "proprietary", 50, "all rights reserved"),
    ("confidential", "proprietary", 65, "(?:proprietary and confidential|confidential and proprietary)"),
    ("redistribution", "bsd", 55, "redistribution and use in source and binary forms"),
    ("permission", "mit", 55, "permission is hereby granted free of charge to any person"),
    ("copyleft", "copyleft", 30, "copyleft"),
)

#: Words of the longest match of any rule.
LONGEST = 20
UPPER, LOWER = ascii_uppercase, ascii_lowercase
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Rule(NamedTuple):
    order: int
    priority: int
    label: str
    keyword: str
    pattern: str


def rules() -> list[Rule]:
    """All rules: every way for every family, then the others."""
    out = []
    for families, halved in ((FAMILIES, 1), (UNVERSIONED, 2)):
        for key, (keyword, name, short) in families.items():
            label = key.removesuffix("-long").split(" ")[0]
            alone = key.startswith(ALONE) and key not in NOT_ALONE
            either = f"(?:{name}|{short})" if re.search(rf"\b{keyword}\b", short) else name
            for priority, way in (*WAYS, FURTHER, BY_NAME) if alone else (*WAYS, FURTHER):
                if "{short}" in way and not short:
                    continue
                # Not by format(): patterns have braces of their own.
                pattern = way.replace("{name}", name).replace("{short}", short).replace("{either}", either)
                out.append((priority // halved, label, "spdx" if "{short}" in way else keyword, pattern))
    out += [(priority, label, keyword, pattern) for keyword, label, priority, pattern in OTHERS]
    return [Rule(i, p, label, keyword, f"(?<= )(?:{pattern})(?= )") for i, (p, label, keyword, pattern) in enumerate(out)]


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _places(text: Column, rule: Column) -> Column:
    """A rule's matches in a padded text: structs of order, priority, label and the words [start, end)."""

    def placed(found: Column) -> Column:
        between = F.split(text, rule["pattern"])

        def step(state: Column, m: Column) -> Column:
            start = state["at"] + _spaces(m["before"])
            end = start + _spaces(m["match"]) + 1
            hit = F.struct(rule["order"].alias("order"), rule["priority"].alias("priority"), rule["label"].alias("label"), start.alias("start"), end.alias("end"))
            return F.struct((end - 1).alias("at"), F.concat(state["hits"], F.array(hit)).alias("hits"))

        kind = "array<struct<order:int,priority:int,label:string,start:int,end:int>>"
        start = F.struct(F.lit(-1).alias("at"), F.array().cast(kind).alias("hits"))
        pairs = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)), lambda m, b: F.struct(b.alias("before"), m.alias("match")))
        return F.aggregate(pairs, start, step)["hits"]

    empty = F.array().cast("array<struct<order:int,priority:int,label:string,start:int,end:int>>")
    return bind(F.regexp_extract_all(text, rule["pattern"], F.lit(0)), lambda found: F.when(F.size(found) == 0, empty).otherwise(placed(found)))


def _resolved(hits: Column, reach: Column) -> Column:
    """The detections that none of higher order contains; what can contain one is within `reach` of it."""

    def above(e: Column, d: Column) -> Column:
        longer = (e["end"] - e["start"]) - (d["end"] - d["start"])
        higher = (e["priority"] > d["priority"]) | (
            (e["priority"] == d["priority"]) & ((longer > 0) | ((longer == 0) & (e["order"] < d["order"])))
        )
        return higher & (e["start"] <= d["start"]) & (e["end"] >= d["end"])

    # Structs sort by their first field; what contains a match starts at most LONGEST words before it.
    by_start = F.array_sort(F.transform(hits, lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"), h["order"].alias("order"), h["priority"].alias("priority"), h["label"].alias("label"))))

    def kept(s: Column) -> Column:
        return F.filter(
            s,
            lambda d, k: ~F.exists(F.slice(s, F.greatest(k + 1 - reach, F.lit(1)), 2 * reach), lambda e: above(e, d)),
        )

    return bind(by_start, kept)


def _phrase(words: Column, phrase: str, label: str) -> Column:
    """Places where a phrase's words stand one after the other: structs of start and label."""
    first, *rest = phrase.split(" ")

    def stands(x: Column, i: Column) -> Column:
        here = x == first
        for k, w in enumerate(rest, 1):
            here = here & (F.get(words, i + k) == w)
        return F.when(here, i)

    places = F.filter(F.transform(words, stands), lambda i: i.isNotNull())
    return F.transform(places, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))


def _base(words: Column) -> Column:
    """All places of the base phrases among lower-case words, by start."""
    return F.array_sort(F.concat(*[_phrase(words, phrase, label) for phrase, label in BASE.items()]))


def license_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, base, detections) of every row of docs.

    base holds the places (start, label) of the base phrases, detections the rules' resolved matches (start, end,
    order, priority, label), positions in words from 0. Null and empty texts have no words and no
    detections. Rules of equal standing at the same words: the earlier one stays. Repeated rows stay. Texts are
    scanned whole. Other columns are not looked at. An empty table gives an empty table.
    """
    known = rules()
    table = F.array(*[F.struct(F.lit(r.order).alias("order"), F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern")) for r in known])
    keywords = sorted({r.keyword for r in known} | {p.split(" ")[0] for p in BASE})
    joined = F.regexp_replace(F.concat(F.lit(" "), F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(" ")), SEPARATORS, " ")
    normal = docs.select(F.col("doc_id").cast("long").alias("doc_id"), joined.alias("words"))
    normal = normal.select(
        "doc_id",
        F.when(F.col("words") == " ", F.lit(0)).otherwise(_spaces(F.col("words")) - 1).cast("long").alias("n_words"),
        F.when(F.col("words").rlike("(?i) (?:" + "|".join(keywords) + ") "), F.translate("words", UPPER, LOWER)).alias("gated"),
    )

    def detected(t: Column) -> Column:
        tried = F.filter(table, lambda r: F.contains(t, F.concat(F.lit(" "), r["keyword"], F.lit(" "))))
        # A rule matches at most once from each word, so what contains a match is not further away in their order.
        return bind(tried, lambda rs: _resolved(F.flatten(F.transform(rs, lambda r: _places(t, r))), F.size(rs) * LONGEST))

    base_kind, hit_kind = "array<struct<start:int,label:string>>", "array<struct<start:int,end:int,order:int,priority:int,label:string>>"
    gated = F.col("gated").isNotNull()
    return normal.select(
        "doc_id",
        "n_words",
        F.when(gated, bind(F.split(F.substring("gated", F.lit(2), F.length("gated")), " "), _base)).otherwise(F.array().cast(base_kind)).cast(base_kind).alias("base"),
        F.when(gated, bind(F.col("gated"), detected)).otherwise(F.array().cast(hit_kind)).cast(hit_kind).alias("detections"),
    )


def license_summary(scanned: DataFrame) -> DataFrame:
    """One row of counts and labels per row of license_scan(); score is the highest priority among detections."""

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base, hits = F.col("base"), F.col("detections")
    of_base = F.transform(base, lambda x: x["label"])
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.get(base, F.lit(0))["start"].cast("long").alias("first_word"),
        F.get(base, F.size(base) - 1)["start"].cast("long").alias("last_word"),
        listed(of_base).alias("base_labels"),
        listed(F.concat(of_base, F.transform(hits, lambda x: x["label"]))).alias("labels"),
        (F.coalesce(F.array_max(F.transform(hits, lambda x: x["priority"])), F.lit(0)) / 100).cast("double").alias("score"),
    )
