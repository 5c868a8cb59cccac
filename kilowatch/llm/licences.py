"""Licence scan by sentence rules.

A text is cut into sentences, which are normalised and looked up in a table of known licence
sentences; what remains is a sequence of sentence identifiers. A sentence may be wrapped over lines,
with comment marks before each, and a line may be a sentence of its own. Ordered rules, most telling first, name
the licence whose identifiers stand one after the other in that sequence (other sentences between
them do not matter). All of it is string and array functions inside the row: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifier and sentence as the licences print it. Compared in normalised form.
SENTENCES: list[tuple[str, str]] = [
    ("mit-short", "Released under the MIT License."),
    ("mit-licensed", "Licensed under the MIT License."),
    ("mit-title", "MIT License"),
    ("mit-title-the", "The MIT License (MIT)"),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit-warranty", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("apache-2.0-short", "Licensed under the Apache License, Version 2.0."),
    ("apache-1.1-short", "Licensed under the Apache License, Version 1.1."),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("apache-2.0-use", "you may not use this file except in compliance with the License."),
    ("apache-2.0-copy", "You may obtain a copy of the License at"),
    ("gpl-2.0-short", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0-short", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-title", "GNU GENERAL PUBLIC LICENSE"),
    ("lgpl-title", "GNU LESSER GENERAL PUBLIC LICENSE"),
    ("agpl-title", "GNU AFFERO GENERAL PUBLIC LICENSE"),
    ("gpl-version-2", "Version 2, June 1991"),
    ("gpl-version-3", "Version 3, 29 June 2007"),
    ("agpl-version-3", "Version 3, 19 November 2007"),
    ("gpl-warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("gpl-details", "See the GNU General Public License for more details."),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-endorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("mpl-2.0-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0-1.0", "Licensed under CC0 1.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nc-nd-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("cc-by-3.0", "Licensed under CC BY 3.0."),
    ("cc-by-nc-3.0", "Licensed under CC BY-NC 3.0."),
    ("cc-by-4.0-long", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("reserved", "All rights reserved."),
]

# Rules in order of precedence. Licence and the identifiers that follow one another.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-title-the",)),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache-2.0-header", "apache-2.0-use")),
    ("Apache-2.0", ("apache-2.0-header",)),
    ("Apache-2.0", ("apache-2.0-short",)),
    ("Apache-1.1", ("apache-1.1-short",)),
    ("AGPL-3.0", ("agpl-title", "agpl-version-3")),
    ("LGPL-3.0", ("lgpl-title", "gpl-version-3")),
    ("GPL-3.0", ("gpl-title", "gpl-version-3")),
    ("GPL-2.0", ("gpl-title", "gpl-version-2")),
    ("GPL-3.0", ("gpl-3.0-short",)),
    ("GPL-2.0", ("gpl-2.0-short",)),
    ("GPL", ("gpl-warranty", "gpl-details")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MPL-2.0", ("mpl-2.0-header",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0-1.0",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4.0",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4.0",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4.0",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0",)),
    ("CC-BY-4.0", ("cc-by-4.0",)),
    ("CC-BY-4.0", ("cc-by-4.0-long",)),
    ("CC-BY-NC-3.0", ("cc-by-nc-3.0",)),
    ("CC-BY-3.0", ("cc-by-3.0",)),
    ("All-Rights-Reserved", ("reserved",)),
]

# A sentence ends at a line end, or at . ! ? ; : before white space.
BREAKS = r"[\n\r]+|[.!?;:]+[ \t]+"
OTHER = r"[^a-z0-9\n]+"


def normal_form(sentence: str) -> str:
    """ASCII letters (lower case) and digits; all else is one space."""
    import re

    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


def known_sentences(sentences: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Identifier and normal form of every sentence of the table, cut where texts are cut."""
    import re

    out = []
    for name, sentence in sentences:
        parts = [normal_form(p) for p in re.split(BREAKS, sentence)]
        parts = [p for p in parts if p]
        out += [(name if i == len(parts) - 1 else f"{name}/{i}", p) for i, p in enumerate(parts)]
    return out


def whole_sentences(sentences: Sequence[tuple[str, str]]) -> list[tuple[tuple[str, ...], str]]:
    """Per sentence of the table: normal forms of the parts it is cut into, and their identifiers, joined by commas."""
    known = [known_sentences([sentence]) for sentence in sentences]
    return [(tuple(p for _, p in parts), ",".join(n for n, _ in parts)) for parts in known if parts]


def sentence_ids(text: Column, sentences: Sequence[tuple[str, str]]) -> Column:
    """Identifiers of the known sentences of a text, in order.

    A sentence begins and ends at a line end, or at . ! ? ; : before white space. A single line end
    inside it counts as a space, a blank line does not; all but letters and digits, also comment marks
    that begin a line, counts as nothing. Where several fit, the longest counts.
    """
    known = whole_sentences(sentences)
    text = F.replace(F.replace(F.lower(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    text = F.regexp_replace(F.regexp_replace(text, r"[.!?;:][ \t\n]", "\n\n"), OTHER, " ")
    lines = F.trim(F.regexp_replace(text, " ?\n ?", "\n"))
    longest_first = sorted((parts for parts, _ in known), key=lambda parts: -sum(map(len, parts)))
    either = "|".join("\n+".join(p.replace(" ", "[ \n]") for p in parts) for parts in longest_first)
    found = F.regexp_extract_all(lines, F.lit(f"(?m)^(?:{either})$"), F.lit(0))
    forms, names = F.array(*[F.lit(" ".join(p)) for p, _ in known]), F.array(*[F.lit(n) for _, n in known])
    return F.transform(found, lambda s: F.element_at(names, F.array_position(forms, F.regexp_replace(s, "\n+", " ")).cast("int")))


def licences_of(ids: Column, rules: Sequence[tuple[str, tuple[str, ...]]]) -> Column:
    """Licences whose identifiers follow one another in ``ids``, in order of the rules."""
    line = F.concat(F.lit(","), F.array_join(ids, ","), F.lit(","))
    found = [F.when(line.contains("," + ",".join(rule) + ","), F.lit(name)) for name, rule in rules]
    return F.array_distinct(F.array_compact(F.array(*found)))


def license_scan(docs: DataFrame, sentences: Sequence[tuple[str, str]] = SENTENCES, rules=RULES) -> DataFrame:
    """Licence of every document: doc_id, licence (first rule that fits, or null), licences, sentences.

    ``licences`` and ``sentences`` (identifiers in text order) are joined by commas; both are empty
    where nothing is known, also for null and empty texts. Other columns are not read. The scan takes
    the whole text; repeated rows are scanned each.
    """
    ids = docs.select("doc_id", sentence_ids(F.coalesce("text", F.lit("")), sentences).alias("ids"))
    named = ids.select("doc_id", "ids", licences_of(F.col("ids"), rules).alias("found"))
    return named.select(
        "doc_id", F.get("found", F.lit(0)).alias("licence"), F.array_join("found", ",").alias("licences"),
        F.array_join("ids", ",").alias("sentences"),
    )


def oracle() -> str:
    """The same in SQL of another engine; text functions and array functions are its own."""

    def quoted(values) -> str:
        return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"

    known = known_sentences(SENTENCES)
    names = [r for r, _ in RULES]
    lines = [",".join(ids) for _, ids in RULES]
    return f"""
WITH s AS (
  SELECT doc_id, list_transform(string_split(regexp_replace(regexp_replace(lower(coalesce(text, '')),
    '[\\n\\r]+|[.!?;:]+[ \\t]+', chr(10), 'g'), '[^a-z0-9\\n]+', ' ', 'g'), chr(10)), lambda x: trim(x)) AS parts
  FROM documents
), i AS (
  SELECT doc_id, list_transform(list_filter(parts, lambda x: list_contains({quoted(p for _, p in known)}, x)),
    lambda x: list_extract({quoted(n for n, _ in known)}, list_position({quoted(p for _, p in known)}, x))) AS ids
  FROM s
), j AS (SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentences FROM i), f AS (
  SELECT doc_id, sentences, list_transform(list_filter(range(1, {len(names) + 1}),
    lambda k: contains(',' || sentences || ',', ',' || list_extract({quoted(lines)}, k) || ',')),
    lambda k: list_extract({quoted(names)}, k)) AS hits FROM j
), d AS (
  SELECT doc_id, sentences, list_filter(hits, lambda x, k: list_position(hits, x) = k) AS found FROM f
)
SELECT doc_id, list_extract(found, 1) AS licence, coalesce(array_to_string(found, ','), '') AS licences, sentences FROM d"""
