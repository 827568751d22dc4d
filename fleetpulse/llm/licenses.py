"""Licence recognition by sentences: known sentences, then rules over their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import lower_ascii

_GPL = "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"
_LGPL = "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"
_AGPL = "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"
_LATER = "of the license or at your option any later version"
_BSD = "may be used to endorse or promote products derived from this software without specific prior written permission"
_CC = "this work is licensed under a creative commons"
# Sentences of licences and notices, normalised, with identifiers; several forms may share one.
SENTENCES = [
    ("apache2-notice", "licensed under the apache license version 2 0"),
    ("apache2-notice", "licensed under the apache license version 2 0 the license"),
    ("apache2-notice", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache2-comply", "you may not use this file except in compliance with the license"),
    ("apache2-obtain", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache2-obtain", "you may obtain a copy of the license at https www apache org licenses license 2 0"),
    ("mit-notice", "released under the mit license"),
    ("mit-notice2", "licensed under the mit license"),
    ("mit-notice2", "this project is licensed under the mit license"),
    ("mit-notice2", "this software is licensed under the mit license"),
    ("mit-title", "the mit license"),
    ("mit-title", "the mit license mit"),
    ("mit-title", "mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-condition", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("as-is", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl3-notice", "this work is licensed under the gnu general public license v3"),
    ("gpl3-notice", "licensed under the gnu general public license v3"),
    ("gpl3-notice", "licensed under the gnu general public license version 3"),
    ("gpl2-notice", "this work is licensed under the gnu general public license v2"),
    ("gpl2-notice", "licensed under the gnu general public license v2"),
    ("gpl2-notice", "licensed under the gnu general public license version 2"),
    ("gpl3-redistribute", f"{_GPL} either version 3 {_LATER}"),
    ("gpl2-redistribute", f"{_GPL} either version 2 {_LATER}"),
    ("gpl3-only", f"{_GPL} version 3 of the license"),
    ("gpl2-only", f"{_GPL} version 2 of the license"),
    ("lgpl3-redistribute", f"{_LGPL} either version 3 {_LATER}"),
    ("lgpl21-redistribute", f"{_LGPL} either version 2 1 {_LATER}"),
    ("agpl3-redistribute", f"{_AGPL} either version 3 {_LATER}"),
    ("gpl-warranty", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("lgpl-warranty", "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("mpl2-notice", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl2-notice", "this source code form is subject to the terms of the mozilla public license v"),  # "v. 2.0" parts there
    ("epl2-notice", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("boost-notice", "distributed under the boost software license version 1 0"),
    ("unlicense-notice", "this is free and unencumbered software released into the public domain"),
    ("cc0-notice", "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
    ("cc0-notice", "licensed under cc0 1 0"),
    ("ccby4-notice", f"{_CC} attribution 4 0 international license"),
    ("ccby4-notice", "licensed under cc by 4 0"),
    ("ccbysa4-notice", f"{_CC} attribution sharealike 4 0 international license"),
    ("ccbysa4-notice", "licensed under cc by sa 4 0"),
    ("ccbync4-notice", f"{_CC} attribution noncommercial 4 0 international license"),
    ("ccbync4-notice", "licensed under cc by nc 4 0"),
    ("ccbynd4-notice", f"{_CC} attribution noderivatives 4 0 international license"),
    ("ccbynd4-notice", "licensed under cc by nd 4 0"),
    ("ccbyncsa4-notice", f"{_CC} attribution noncommercial sharealike 4 0 international license"),
    ("ccbyncsa4-notice", "licensed under cc by nc sa 4 0"),
    ("ccbyncnd4-notice", f"{_CC} attribution noncommercial noderivatives 4 0 international license"),
    ("ccbyncnd4-notice", "licensed under cc by nc nd 4 0"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-advertise", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd-endorse", f"neither the name of the copyright holder nor the names of its contributors {_BSD}"),
    ("bsd-endorse", f"neither the name of copyright holder nor the names of its contributors {_BSD}"),
    ("bsd-endorse", f"neither the name of the university nor the names of its contributors {_BSD}"),
    ("bsd-endorse", f"neither the name of the organization nor the names of its contributors {_BSD}"),
    ("bsd-endorse", f"neither the name of the author nor the names of its contributors {_BSD}"),
    ("bsd-endorse", "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("reserved", "all rights reserved"),
]
# Short identifiers of licences, as a line "SPDX-License-Identifier: ..." names them.
SPDX = [
    "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "ISC", "0BSD", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "BSL-1.0",
    "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0",
]
# A rule holds where its identifiers follow each other among the known sentences of a text.
RULES = [
    ("Apache-2.0", ["apache2-notice"]),
    ("Apache-2.0", ["apache2-comply", "apache2-obtain"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-notice2"]),
    ("MIT", ["mit-title"]),
    ("MIT", ["mit-grant", "mit-condition", "as-is"]),
    ("ISC", ["isc-grant"]),
    ("0BSD", ["0bsd-grant"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-2.0", ["gpl2-notice"]),
    ("GPL-3.0-or-later", ["gpl3-redistribute", "gpl-warranty"]),
    ("GPL-2.0-or-later", ["gpl2-redistribute", "gpl-warranty"]),
    ("GPL-3.0-only", ["gpl3-only", "gpl-warranty"]),
    ("GPL-2.0-only", ["gpl2-only", "gpl-warranty"]),
    ("LGPL-3.0-or-later", ["lgpl3-redistribute", "lgpl-warranty"]),
    ("LGPL-2.1-or-later", ["lgpl21-redistribute", "lgpl-warranty"]),
    ("AGPL-3.0-or-later", ["agpl3-redistribute", "gpl-warranty"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("EPL-2.0", ["epl2-notice"]),
    ("BSL-1.0", ["boost-notice"]),
    ("Unlicense", ["unlicense-notice"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("CC-BY-NC-4.0", ["ccbync4-notice"]),
    ("CC-BY-4.0", ["ccby4-notice"]),
    ("CC-BY-SA-4.0", ["ccbysa4-notice"]),
    ("CC-BY-ND-4.0", ["ccbynd4-notice"]),
    ("CC-BY-NC-SA-4.0", ["ccbyncsa4-notice"]),
    ("CC-BY-NC-ND-4.0", ["ccbyncnd4-notice"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertise", "bsd-endorse"]),
    ("All-Rights-Reserved", ["reserved"]),
    *((name, [f"spdx-{name.lower()}"]) for name in SPDX),
]
# Every known sentence has one of these; texts without any are not searched.
MARKS = ("licens", "permission", "copyright", "warranty", "redistribut", "reserved", "public domain", "advertising")


def known_sentences() -> dict[str, str]:
    """Sentence -> identifier, the lines with short identifiers among them."""
    plain = lambda s: " ".join("".join(c if c.isalnum() else " " for c in s.lower()).split())
    return {s: name for name, s in SENTENCES} | {f"spdx license identifier {plain(n)}": f"spdx-{n.lower()}" for n in SPDX}


# What parts sentences: \x01 surely (terminators, blank lines, the text's ends), \x02 a line that
# begins with a capital, \n another line. A sentence begins after the first two and ends before any;
# inside it line ends are blanks. Each mark is doubled, so that one can end a sentence and the
# other begin the next. (pattern, what stands for it), before and after A-Z become small.
CUTS = [
    ("\\r\\n?", "\n"),
    ("[.!?]+[\\x20\\x09-\\x0D]+", "\x01"),
    ("\\n[^A-Za-z0-9\\n\\x01]*\\n", "\x01"),
    ("\\n([^A-Za-z0-9\\n\\x01]*[A-Z])", "\x02$1"),
]
FOLDS = [
    ("[^a-z0-9\\n\\x01\\x02]+", " "),
    ("[ \\n\\x02]*\\x01[ \\n\\x01\\x02]*", "\x01\x01"),
    ("[ \\n]*\\x02[ \\n\\x02]*", "\x02\x02"),
    (" *\\n[ \\n]*", "\n\n"),
]
BLANK = "(?: |\\n\\n|\\x02\\x02)"


def sentence_pattern() -> str:
    """Regular expression of all known sentences in their places, longer ones first."""
    found = sorted(known_sentences(), key=lambda s: (-len(s), s))
    return f"[\\x01\\x02]({'|'.join(s.replace(' ', BLANK) for s in found)})[\\n\\x01\\x02]"


def within(ids: list[str]) -> list[list[str]]:
    """The rules' longer sequences that hold this one: what they match is no match of it."""
    has = lambda long: any(long[k : k + len(ids)] == ids for k in range(len(long) - len(ids) + 1))
    return [long for _, long in RULES if len(long) > len(ids) and has(long)]


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    lowered = lower_ascii(text)
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | lowered.contains(mark)
    lines = F.translate(text, "\x01\x02", "  ")
    for pattern, by in CUTS:
        lines = F.regexp_replace(lines, pattern, by)
    lines = lower_ascii(F.concat(F.lit("\x01"), lines, F.lit("\x01")))
    for pattern, by in FOLDS:
        lines = F.regexp_replace(lines, pattern, by)
    found = F.regexp_extract_all(lines, F.lit(sentence_pattern()), F.lit(1))
    known = F.create_map(*(F.lit(x) for pair in known_sentences().items() for x in pair))
    plain = lambda s: F.regexp_replace(s, "[\\n\\x02]+", " ")
    return F.when(marked, F.transform(found, lambda s: F.element_at(known, plain(s)))).otherwise(F.array().cast("array<string>"))


def licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, sentences, licenses, n_sentences) for every row of ``docs`` (doc_id, text).

    ``sentences`` are the identifiers found, in order and parted by a blank; ``licenses``
    the names of the rules that hold, in the order of the rule table and parted by a comma. A
    sequence that is part of a longer rule's counts for that one alone.

    A known sentence must stand as a sentence: after a terminator, a blank line or at a line
    that begins with a capital, and up to the next terminator or line end; it may be wrapped,
    and comment signs are blanks. Of known sentences that begin alike the longest that
    fits is taken; what it covers is not searched again.

    Plain projections over the whole text, however long, without a shuffle. Null and empty
    texts have neither; null ids and repeated rows stay; an empty table gives no rows; extra
    columns are not read, so names cannot clash.
    """
    rows = docs.select("doc_id", F.array_join(sentence_ids(F.coalesce("text", F.lit(""))), " ").alias("sentences"))
    # One explode keeps the rules below from repeating the search in the text.
    rows = rows.select("doc_id", F.explode(F.array("sentences")).alias("sentences"))
    # Blanks are doubled so that sequences that touch are both counted.
    padded = F.concat(F.lit(" "), F.replace("sentences", F.lit(" "), F.lit("  ")), F.lit(" "))

    def times(ids: list[str]) -> Column:
        sequence = f" {'  '.join(ids)} "
        return (F.length(padded) - F.length(F.replace(padded, F.lit(sequence), F.lit("")))) / F.lit(len(sequence))

    names = list(dict.fromkeys(name for name, _ in RULES))
    holds = {n: F.lit(False) for n in names}
    for name, ids in RULES:
        longer = [times(x) for x in within(ids)]
        holds[name] = holds[name] | (times(ids) > sum(longer, F.lit(0.0)) if longer else padded.contains(f" {'  '.join(ids)} "))
    found = F.array_join(F.array_compact(F.array(*(F.when(holds[n], F.lit(n)) for n in names))), ",")
    count = F.when(F.col("sentences") == "", 0).otherwise(F.size(F.split("sentences", " "))).cast("long")
    return rows.select("doc_id", "sentences", F.when(F.col("sentences") == "", "").otherwise(found).alias("licenses"), count.alias("n_sentences"))


def licenses_sql() -> str:
    """The same for DuckDB, over the table ``documents``."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    # Control characters are spelled out, and a group is named the other way.
    by = lambda s: " || ".join(f"chr({ord(c)})" if c < " " else quoted(c) for c in s.replace("$1", "\\")).replace(quoted("\\"), "'\\1'")

    def replaced(value: str, steps: list[tuple[str, str]]) -> str:
        for pattern, to in steps:
            value = f"regexp_replace({value}, {quoted(pattern)}, {by(to)}, 'g')"
        return value

    cut = replaced("translate(coalesce(text, ''), chr(1) || chr(2), '  ')", CUTS)
    lowered = lambda v: f"translate({v}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    lines = replaced(lowered(f"chr(1) || {cut} || chr(1)"), FOLDS)
    marked = " OR ".join(f"contains({lowered('text')}, '{m}')" for m in MARKS)
    known = " ".join(f"WHEN '{s}' THEN '{name}'" for s, name in known_sentences().items())
    times = lambda ids: f"(length(padded) - length(replace(padded, ' {'  '.join(ids)} ', ''))) // {len('  '.join(ids)) + 2}"
    rule = lambda n: " OR ".join(f"{times(ids)} > {' + '.join(map(times, within(ids))) or '0'}" for name, ids in RULES if name == n)
    names = list(dict.fromkeys(name for name, _ in RULES))
    found = ", ".join(f"CASE WHEN {rule(n)} THEN '{n}' END" for n in names)
    return f"""
        WITH lines AS (SELECT doc_id, CASE WHEN {marked} THEN {lines} ELSE '' END AS lines FROM documents),
        found AS (
          SELECT doc_id, list_transform(regexp_extract_all(lines, {quoted(sentence_pattern())}, 1),
            lambda s: CASE regexp_replace(s, '[\\n\\x02]+', ' ', 'g') {known} END) AS ids FROM lines),
        padded AS (SELECT doc_id, ids, ' ' || array_to_string(ids, '  ') || ' ' AS padded FROM found)
        SELECT doc_id, array_to_string(ids, ' ') AS sentences,
               array_to_string(list_filter([{found}], lambda x: x IS NOT NULL), ',') AS licenses,
               CAST(len(ids) AS BIGINT) AS n_sentences
        FROM padded"""
