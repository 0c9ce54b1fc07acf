import pytest
import regex as re  # unlike re it looks behind over any length, as the engine does up to a bound
from pyspark.sql import functions as F

from tidemark.llm.license_rules import BASE, LONGEST, license_scan, license_summary, rules

TEXTS = [
    "This is free: under the MIT License. And Apache License, Version 2.0, cc-by-nc 4.0!",
    "cc by nc cc by nc CC-BY_NC",
    "licensed under the apache license version 2.0 and the BSD 3-clause license; SPDX-License-Identifier: GPL-2.0-or-later",
    "released under the terms of the GNU General Public License version 3, all rights reserved",
    "underthe mit license under the mit\nlicense é under the mitlicense",
    "permit under the ÉMIT license apache license version 22",
    "cc by", "license: ISC", "Kelvin K under the MIT license İ", "dual licensed under mit license version 2",
]

COMPILED = [(r, re.compile(r.pattern)) for r in rules()]


def brute(text):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w]
    base = sorted((i, label) for phrase, label in BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
    joined, hits = " " + " ".join(words) + " ", []
    for r, pattern in COMPILED:
        for m in pattern.finditer(joined):
            start = joined[: m.start()].count(" ") - 1
            end = start + m.group().count(" ") + 1
            assert end - start <= LONGEST and r.keyword in m.group().split(), r
            hits.append((r.priority, end - start, -r.order, start, end, r.label))
    kept = [d for d in hits if not any(e[:3] > d[:3] and e[3] <= d[3] and e[4] >= d[4] for e in hits)]
    labels = {x for _, x in base}
    return (
        len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted(labels)),
        ",".join(sorted(labels | {d[5] for d in kept})), max([0, *(d[0] for d in kept)]) / 100,
    )


def test_hundreds_of_rules_each_with_its_keyword():
    known = rules()
    assert len(known) > 250 and len({r.pattern for r in known}) == len(known)


def test_same_as_brute_force(table, edge_rows, prose):
    rows = [r[:2] for r in edge_rows] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    rows += [(200 + i, " ".join(prose(50, i)) + ", " + a + "; " + " ".join(prose(9, -i)) + " " + b) for i, (a, b) in enumerate(zip(TEXTS, TEXTS[3:]))]
    names = [m.removeprefix("(?<= )").removesuffix("(?= )") for m in (r.pattern for r in rules())]
    plain = [re.sub(r"\(\?:([^()|]*)(\|[^()]*)?\)\??", r"\1", re.sub(r"\(\?:([^()|]*)(\|[^()]*)?\)\??", r"\1", n)) for n in names]
    rows += [(1000 + i, re.sub(r"\[(.)[^\]]*\]", r"\1", re.sub(r"[()?]|\|.*", "", t))) for i, t in enumerate(plain)]
    docs = table(rows).withColumns({c: F.lit(3) for c in ("words", "gated", "base", "detections", "n_words", "label")})
    found = license_summary(license_scan(docs)).collect()
    have = sorted(((str(r.doc_id), *(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))) for r in found), key=str)
    assert have == sorted(((str(d), *brute(t)) for d, t in rows), key=str)


def test_contained_matches_yield(table):
    found = license_scan(table([(1, "licensed under the apache license version 2.0 here")])).first().detections
    assert [(d.start, d.end, d.label) for d in found] == [(0, 8, "apache-2")]


@pytest.mark.parametrize("times", [4000])
def test_many_matches_in_one_text(table, times):
    found = license_summary(license_scan(table([(1, "cc by nc " * times)]))).first()
    assert (found.n_base, found.first_word, found.last_word, found.labels) == (times, 0, 3 * times - 3, "cc-by-nc")


def test_empty_table(table):
    assert license_summary(license_scan(table([]))).count() == 0


#: Mentions as projects write them, not derived from the patterns.
MENTIONS = {
    "GPL v3": "gpl-3", "GPLv2": "gpl-2", "GPLv3+": "gpl-3", "AGPLv3": "agpl-3", "LGPL v2.1": "lgpl-2", "LGPLv3": "lgpl-3",
    "GNU General Public License v3.0": "gpl-3", "GNU GPL v2": "gpl-2", "GNU GPL version 3 or later": "gpl-3",
    "GNU General Public License (GPL) version 2": "gpl-2", "GPL-2.0-or-later": "gpl-2", "GPL3": "gpl-3",
    "Apache License v2.0": "apache-2", "Apache License, Version 2.0": "apache-2", "Licensed under Apache v2": "apache-2",
    "GNU Lesser General Public License v2.1": "lgpl-2", "the GNU Lesser General Public License": "lgpl",
    "GNU Affero General Public License v3": "agpl-3", "BSD 3-Clause": "bsd-3", "2-clause, released under the BSD-2-Clause license": "bsd-2",
    "This program is free software under the GNU General Public License.": "gpl", "It is licensed under the GPL.": "gpl",
    "is distributed under the Apache License": "apache", "BSD license": "bsd", "BSD-style license": "bsd", "under the LGPL": "lgpl",
    "Mozilla Public License v2.0": "mpl-2", "MPLv2": "mpl-2", "Eclipse Public License v1.0": "epl-1", "Mozilla Public License": "mpl",
    "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3 of the License": "gpl-3",
    "The MIT License": "mit", "SPDX-License-Identifier: Apache-2.0": "apache-2",
    "CC BY-SA 4.0": "cc-by-sa", "CC BY-ND 4.0": "cc-by-nd", "CC BY 4.0": "cc-by", "CC-BY-SA": "cc-by-sa", "CC BY 3.0": "cc-by",
    "CC BY-NC-SA-4.0": "cc-by-nc,cc-by-nc-sa", "CC BY-NC-ND 4.0": "cc-by-nc,cc-by-nc-nd", "CC BY-NC 2.0": "cc-by-nc",
    "Photo: J. Doe, CC-BY-SA-3.0": "cc-by-sa", "Text is available under CC BY-SA 3.0;": "cc-by-sa",
    "Creative Commons Attribution-ShareAlike 4.0 International": "cc-by-sa", "Creative Commons Attribution 4.0": "cc-by",
    "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
    "licensed under the Creative Commons Attribution-ShareAlike 3.0 License": "cc-by-sa",
    "under the Creative Commons Attribution License": "cc-by", "a Creative Commons license": "creative-commons",
    "Creative Commons Attribution-NoDerivs 2.5 Generic": "cc-by-nd", "Creative Commons Attribution-NonCommercial-ShareAlike": "cc-by-nc-sa",
    "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License": "cc-by-nc-nd",
    "Apache-2.0": "apache-2", "License: Apache-2.0": "apache-2", "EPL-2.0": "epl-2", "EPL-1.0": "epl-1", "EPL v1.0": "epl-1",
    "The Unlicense": "unlicense", "released under the Unlicense": "unlicense", "MPL-2.0": "mpl-2", "MPL 1.1": "mpl-1",
    "SPDX-License-Identifier: MIT OR Apache-2.0": "apache-2,mit", "SPDX-License-Identifier: (MIT OR Apache-2.0)": "apache-2,mit",
    "SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note": "gpl-2", "SPDX-License-Identifier: BSD-3-Clause": "bsd-3",
    "SPDX-License-Identifier: GPL-2.0-or-later AND BSD-2-Clause": "bsd-2,gpl-2", "SPDX-License-Identifier: ISC": "isc",
    "SPDX-License-Identifier: LGPL-2.1-or-later OR MPL-2.0": "lgpl-2,mpl-2", "SPDX-License-Identifier: EPL-2.0": "epl-2",
    "SPDX-License-Identifier: MPL-2.0": "mpl-2", "SPDX-License-Identifier: CC0-1.0": "cc0", "SPDX-License-Identifier: Zlib": "zlib",
    "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by-sa", "SPDX-License-Identifier: AGPL-3.0-only": "agpl-3",
    "dual licensed under GPL and MIT": "gpl,mit", "dual licensed under the MIT license and the Apache License": "apache,mit",
    "Licensed under MIT or Apache-2.0": "apache-2,mit", "licensed under the GPLv2 or the LGPLv3": "gpl-2,lgpl-3",
    "licensed under the GPL, the LGPL or the MPL": "gpl,lgpl,mpl", "BSD-3-Clause-Clear": "bsd-3-clear",
    "released under the BSD 3-Clause Clear License": "bsd-3-clear", "the ISC License": "isc", "License: MIT": "mit",
    "under the zlib license": "zlib", "the Boost Software License 1.0": "boost", "SIL Open Font License 1.1 applies: the SIL Open Font License": "ofl",
    "the Artistic License 2.0": "artistic", "the WTFPL license": "wtfpl", "the PostgreSQL License": "postgresql",
    "Released under the GNU LGPL version 3.": "lgpl-3", "GNU AGPL v3": "agpl-3", "the New BSD License": "bsd-3",
    "the simplified BSD license": "bsd-2", "Modified BSD license": "bsd-3", "MPL": "", "LGPL-2.1": "lgpl-2", "AGPL-3.0": "agpl-3",
    "This work is in the public domain; license: public domain": "public-domain", "Copyleft, all wrongs reserved": "copyleft",
    "Copyright 2020 Foo. All rights reserved.": "proprietary", "Released under the MIT/Expat license": "mit",
}
NOT_LICENCES = ["Apache 2.0.63 was released", "the commons", "er geht mit Anna or mit Paul", "Apache 2 web server", "the bsd kernel", "er kommt mit gplatt", "apache helicopters", "FreeBSD 3", "gnu make", "a general public"]


def test_mentions_of_real_texts(table):
    rows = list(enumerate(["so " + m + " here" for m in MENTIONS])) + [(1000 + i, t) for i, t in enumerate(NOT_LICENCES)]
    found = {r.doc_id: r.labels for r in license_summary(license_scan(table(rows))).collect()}
    assert {m: found[i] for i, m in enumerate(MENTIONS)} == MENTIONS
    assert {found[1000 + i] for i in range(len(NOT_LICENCES))} == {""}
