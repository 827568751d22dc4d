import duckdb
from pyspark.sql import functions as F

from fleetpulse.llm.licenses import MARKS, RULES, known_sentences, licenses, licenses_sql, sentence_pattern
from fleetpulse.llm.licenses import SENTENCES as TABLE

SENTENCES = {name: s for name, s in reversed(TABLE)}

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""


def wrapped(text: str, prefix: str = "", end: str = "\n") -> str:
    words, lines = text.split(), [""]
    for word in words:
        lines = [*lines, word] if len(lines[-1]) + len(word) > 70 else [*lines[:-1], (lines[-1] + " " + word).strip()]
    return end.join(prefix + line for line in lines)


def test_wrapped_texts_and_standard_headers(spark, documents):
    mit = [SENTENCES[k].capitalize() + "." for k in ("mit-grant", "mit-condition", "as-is")]
    gpl = [SENTENCES[k].capitalize() + "." for k in ("gpl3-redistribute", "gpl-warranty")]
    bsd = [SENTENCES[k].capitalize() + "." for k in ("bsd-grant", "bsd-source", "bsd-binary")]
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 X\n\n" + "\n\n".join(map(wrapped, mit))),
        (2, "MIT License\n" + "\r\n \r\n".join(wrapped(s, end="\r\n") for s in mit)),
        (3, "\n#\n".join(wrapped(s, "# ") for s in gpl)),
        (4, "/*\n" + "\n".join(f" * {n}. " + wrapped(s, " * ")[3:] for n, s in enumerate(bsd, 1)) + "\n */"),
        (5, wrapped(APACHE.replace("\n", " "))), (6, APACHE), (7, APACHE.replace("\n", "\n// ")),
        (8, wrapped(mit[0]).replace("\n", "\n\n", 1) + "\n" + mit[1] + "\n" + mit[2]),
        (9, "Read this: all rights reserved\nor not"), (10, "x\nAll rights\nreserved"),
    ]
    got = {r["doc_id"]: r["licenses"] for r in licenses(documents(rows)).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "GPL-3.0-or-later", 4: "BSD-2-Clause", 5: "Apache-2.0", 6: "Apache-2.0", 7: "Apache-2.0", 8: "", 9: "", 10: "All-Rights-Reserved"}


def full(*names: str) -> str:
    return "\n".join(f" {k}. " + wrapped(SENTENCES[n].capitalize() + ".", "    ")[4:] for k, n in enumerate(names, 1))


TEXTS = {
    "BSD-3-Clause": full("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"),
    "BSD-2-Clause": full("bsd-grant", "bsd-source", "bsd-binary"),
    "BSD-4-Clause": full("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertise", "bsd-endorse"),
    "BSD-2-Clause,BSD-3-Clause": full("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse") + "\n\n" + full("bsd-grant", "bsd-source", "bsd-binary"),
    "GPL-2.0-or-later": full("gpl2-redistribute", "gpl-warranty"),
    "LGPL-2.1-or-later": full("lgpl21-redistribute", "lgpl-warranty"),
    "AGPL-3.0-or-later": full("agpl3-redistribute", "gpl-warranty"),
    "GPL-2.0": "Licensed under the GNU General Public License, version 2.",
    "ISC": full("isc-grant"),
    "MIT": "// SPDX-License-Identifier: MIT\nimport os",
    "LGPL-3.0-only": "# SPDX-License-Identifier: LGPL-3.0-only",
    "CC-BY-SA-4.0": "Text.\nThis work is licensed under a Creative\nCommons Attribution-ShareAlike 4.0\nInternational License.",
    "MPL-2.0": "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed */",
}


def test_licences_of_every_kind_against_sql(spark, documents):
    rows = list(enumerate(TEXTS.values())) + [
        (50, "The MIT License (MIT)\n\nCopyright (c) X"), (51, "The project is not\nlicensed under the mit license."), (52, "A\x01B Licensed under the MIT License"),
        (53, "Mine. " + "word " * 100_000 + ". Licensed under the MIT License."), (54, "Licensed under the MIT License. All rights reserved. All rights reserved."),
        (55, SENTENCES["mit-notice"]), (55, SENTENCES["mit-notice"]), (None, ""), (56, None), (57, "It's licensed. It isn't"),
    ]
    docs = documents(rows, sentences=1, licenses=2)
    got = licenses(docs).collect()
    by = {r["doc_id"]: r["licenses"] for r in got}
    assert [by[k] for k in range(len(TEXTS))] == list(TEXTS)
    assert [by[k] for k in (50, 51, 52, 53, 54, 55, 56)] == ["MIT", "", "", "MIT", "MIT,All-Rights-Reserved", "MIT", ""]
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    assert sorted(map(str, con.execute(licenses_sql()).fetchall())) == sorted(str(tuple(r)) for r in got)


def test_the_table_is_sound(spark):
    assert all(any(m in s for m in MARKS) for s in known_sentences()) and len(TABLE) < 200
    assert {i for _, ids in RULES for i in ids} <= set(known_sentences().values())
    assert all(s == " ".join(s.split()) == s.lower() for s in known_sentences())
    assert spark.range(1).select(F.regexp_count(F.lit("\x01all rights\n\nreserved\n"), F.lit(sentence_pattern()))).head()[0] == 1
