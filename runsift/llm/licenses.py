"""License scan by sentence rules.

A text is cut into sentences, each is normalised (lower case, letters and digits only) and looked up among the known
licence sentences. The identifiers of a document, in order, with runs of unknown sentences as one `<?>`, form a
sequence. The rules, in their order, take what they match out of the sequence, so a longer licence stated before is not
also found as its parts. Rules and sentences are small tables of constants held in the plan, not data that grows.

Defined cases: a null or empty text has no sentence and no licence; a licence found several times is listed once;
repeated rows stay repeated and come out alike; other columns are not read; empty tables give no row. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.llm.common import ascii_lower, text_or_empty

BREAK = "\x01"
# Sentence identifiers and the sentences (as the breaks below cut them) of licences and their usual notices. Fixed values.
SENTENCES: list[tuple[str, str]] = [
    ("apache2-short", "Licensed under the Apache License, Version 2.0."),
    ("apache2-short", "Licensed under the Apache License 2.0."),
    ("apache2-short", "Released under the Apache License, Version 2.0."),
    ("apache2-head", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("apache2-comply", "you may not use this file except in compliance with the License."),
    ("apache2-copy", "You may obtain a copy of the License at"),
    ("apache2-asis", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("apache2-limits", "See the License for the specific language governing permissions and limitations under the License."),
    ("mit-short", "Released under the MIT License."),
    ("mit-short", "Licensed under the MIT License."),
    ("mit-short", "This project is licensed under the MIT License."),
    ("mit-grant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("mit-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit-asis", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'),
    ("mit-liability", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-endorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("gpl3-short", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl3-short", "Licensed under the GNU General Public License, version 3."),
    ("gpl3-short", "Licensed under the GNU General Public License v3.0."),
    ("gpl2-short", "Licensed under the GNU General Public License, version 2."),
    ("gpl-free", "This program is free software:"),
    ("gpl3-later", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-redistribute", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;"),
    ("gpl2-later", "either version 2 of the License, or (at your option) any later version."),
    ("gpl-hope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"),
    ("gpl-implied", "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("gpl-see", "See the GNU General Public License for more details."),
    ("mpl2-head", "This Source Code Form is subject to the terms of the Mozilla Public License, v."),
    ("cc-by-nc4-short", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc4-short", "This work is licensed under CC BY-NC 4.0."),
    ("cc-by4-short", "Licensed under CC BY 4.0."),
    ("cc-by-sa4-short", "Licensed under CC BY-SA 4.0."),
    ("cc0-short", "Released under CC0 1.0."),
]
# Rules in the order they are tried: the identifiers that must follow one another, and the licence they state.
RULES: list[tuple[tuple[str, ...], str]] = [
    (("apache2-head", "apache2-comply"), "Apache-2.0"),
    (("mit-grant", "mit-notice", "mit-asis"), "MIT"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("gpl-free", "gpl3-later"), "GPL-3.0-or-later"),
    (("gpl-free", "gpl-redistribute", "gpl2-later"), "GPL-2.0-or-later"),
    (("isc-grant",), "ISC"),
    (("mpl2-head",), "MPL-2.0"),
    (("apache2-short",), "Apache-2.0"),
    (("mit-short",), "MIT"),
    (("gpl3-short",), "GPL-3.0-only"),
    (("gpl2-short",), "GPL-2.0-only"),
    (("cc-by-nc4-short",), "CC-BY-NC-4.0"),
    (("cc-by-sa4-short",), "CC-BY-SA-4.0"),
    (("cc-by4-short",), "CC-BY-4.0"),
    (("cc0-short",), "CC0-1.0"),
]
# Where sentences end: (pattern, replacement), applied in order. A line break ends a sentence unless the next line goes
# on with a small letter, a digit, a mark or a word in capitals, as wrapped licence texts do.
BREAKS = [
    (r"([.!?;:][\"')]?)[ \t\r\n\f]+", r"$1" + BREAK),
    (r"\n[ \t\r\f]*\n", BREAK),
    (r"\n([ \t/*#;-]*[A-Z][a-z ])", BREAK + "$1"),
]


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(sentence), r"[^a-z0-9]+", " "))


def _plain(sentence: str) -> str:
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower()).split())


def known_sentences(sentences: list[tuple[str, str]]) -> dict[str, str]:
    """Normalised sentence to identifier."""
    return {_plain(text): name for name, text in sentences}


def scan(
    docs: DataFrame,
    sentences: list[tuple[str, str]] = SENTENCES,
    rules: list[tuple[tuple[str, ...], str]] = RULES,
) -> DataFrame:
    """(doc_id, sentence_ids, licenses): the identifier sequence and the licences stated, in the order of the text."""
    known = known_sentences(sentences)
    marked = text_or_empty("text")
    for pattern, replacement in BREAKS:
        marked = F.regexp_replace(marked, pattern, replacement)
    lookup = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])

    def identifier(sentence: Column) -> Column:
        found = F.when(sentence.isin(*known), F.try_element_at(lookup, sentence)).otherwise("?")
        return F.concat(F.lit("<"), found, F.lit(">"))

    # What is left of list numbers such as "1." is no sentence.
    cut = F.filter(F.transform(F.split(marked, BREAK), normalised), lambda s: F.length(s) > 2)
    ids = F.regexp_replace(F.array_join(F.transform(cut, identifier), ""), r"(<\?>)+", "<?>")
    rows = docs.select("doc_id", ids.alias("sentence_ids"))
    found = F.col("sentence_ids")
    for steps, license_id in rules:
        found = F.replace(found, F.lit("".join(f"<{s}>" for s in steps)), F.lit("{" + license_id + "}"))
    names = F.array_distinct(F.regexp_extract_all(found, F.lit(r"\{([^}]*)\}"), F.lit(1)))
    return rows.select("doc_id", "sentence_ids", F.array_join(names, ",").alias("licenses"))
