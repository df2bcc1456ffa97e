"""Licence scans: whole texts and whole lines are brought to a canonical form and looked up by digest."""

from __future__ import annotations

from functools import reduce
from operator import or_
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that mean the same, replaced in this order as whole words of a canonical text.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("noncommercial", "non commercial"), ("merchantibility", "merchantability"), ("acknowledgement", "acknowledgment"),
    ("favour", "favor"), ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
    ("per cent", "percent"), ("http", "https"),
)

#: Public licence texts and notices by SPDX name; a notice counts where it is a whole line or text.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("proprietary", "All rights reserved."),
    ("MIT", """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """ISC License

Copyright (c) <year> <copyright holders>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""),
)

#: Whole licences that are files, by SPDX name. BSD texts also come with a line on rights.
FILES = ("Apache-2.0", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense")
WHOLE = {name: (Path(__file__).parent / "texts" / f"{name}.txt").read_text() for name in FILES}
NOTICES += tuple(WHOLE.items()) + tuple(
    (name, f"All rights reserved.\n{body}") for name, body in [*NOTICES, *WHOLE.items()] if name.startswith("BSD-") and len(body) > 999
)

#: Words that follow "copyright" in prose, and words that no name after a bare (c) holds.
PROSE = (
    "a|about|agreements?|an|and|any|are|applies|as|at|be|because|but|can|claims?|disclaimers?|doctrines?|does|exceptions?|for|from|grants?|has|have|"
    "holders?|if|in|infringements?|interests?|is|issues?|it|its|laws?|legislation|licen[cs]es?|lines?|may|must|nor|not|notices?|of|on|or|"
    "owners?|ownership|patents?|permissions?|protection|protects|rights?|rules|shall|should|statements?|status|such|terms?|than|that|"
    "the(?=[ \\t]*$)|the[ \\t]+(?:software|works?|program|library|document|materials?|code)|this|to|trademarks?|treat(?:y|ies)|under|was|were|which|who|"
    "will|with|without|you|your"
)
FUNCTION = "a|all|an|any|are|as|at|be|do|does|each|every|for|from|has|have|if|in|is|it|its|may|must|no|not|of|on|or|shall|such|that|the|their|this|to|under|use|was|when|where|which|will|with|you|your"
#: A lower-cased line that is a copyright notice: the word or a sign before a year or a placeholder, both or © before
#: anything, the word before a name, or a bare (c) before a short name that ends the line.
MARKS = r"(?:copyright|©|\(c\))"
NOTICE_LINE = (
    r"(?m)^[^\p{L}\p{N}\n]*(?:"
    rf"(?:{MARKS}[ \t:,-]*){{1,4}}(?:by[ \t]+)?(?:\d{{4}}(?!\d)|[<\[{{$%]|(?:year|yyyy)\b)"
    r"|(?:copyright[ \t:]*(?:©|\(c\))|\(c\)[ \t]*copyright\b|©)[ \t:,-]*[\p{L}\p{N}]"
    rf"|copyright[ \t:]+(?:by[ \t]+)?(?!(?:{PROSE})\b)[\p{{L}}\p{{N}}]"
    rf"|\(c\)[ \t]+(?:(?!(?:{FUNCTION})\b)[^\s,;]++[ \t,;]*+){{1,6}}+(?:all rights reserved[^\n]*)?$"
    r")[^\n]*$"
)


def canonical(text: Column) -> Column:
    """Lower case; copyright notices (whole lines, not prose on copyright) gone; everything but letters and digits one space; equivalent spellings replaced."""
    text = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOTICE_LINE, " ")
    text = F.concat(F.lit(" "), F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for one, other in SPELLINGS:
        text = F.replace(text, F.lit(f" {one} "), F.lit(f" {other} "))
    return F.trim(F.regexp_replace(text, " +", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known(spark: SparkSession, notices=NOTICES) -> DataFrame:
    """(digest, license): one row per distinct canonical text; of two licences with one text the first by name."""
    rows = spark.createDataFrame(list(notices), "name string, body string")
    return rows.select(digest(F.col("body")).alias("known_digest"), "name").groupBy("known_digest").agg(F.min("name").alias("license"))


def origins(word: str) -> frozenset[str]:
    """Of every spelling that ``word`` of a canonical text may come from, a word that the lower-cased text then holds."""
    found = {word}
    for one, other in reversed(SPELLINGS):
        if found & set(other.split()):
            found.add(max(one.split(), key=len))
    return frozenset(found)


def hints(texts: list[str]) -> list[str] | None:
    """Parts of which every lower-cased line with one of these canonical texts holds one; none if a text has no word."""
    found: set[str] = set()
    left = [{origins(w) for w in text.split()} for text in texts]
    while left:
        left = [words for words in left if not any(all(any(h in o for h in found) for o in w) for w in words)]
        if not all(left):
            return None
        if left:
            seen = [w for words in left for w in words]
            found |= max(set(seen), key=lambda w: (min(map(len, w)) >= 6, sum(any(w <= x for x in words) for words in left), min(map(len, w)), sorted(w)))
    return sorted(found)


def scan(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices=NOTICES) -> DataFrame:
    """One row per document: id, ``text_digest``, ``license`` of the entire text, and ``line_licenses``.

    The digest is that of the canonical text; ``license`` is null where it is not known. ``line_licenses`` names, sorted
    and distinct, the licences whose entire text is one line of the document (comma-joined, empty if there is none). Null
    and empty texts have the digest of the empty text and no licence; repeated rows are scanned each; an empty table
    gives no rows.

    The known texts are a parameter with a size fixed in the code, so they are sent to all tasks. Only lines that hold a
    part of which every known text holds one are digested, which spares the others nothing but work.
    """
    spark = frame.sparkSession
    table = known(spark, notices)
    text = F.col(f"`{text_col}`")
    pairs = [(r["known_digest"], r["license"]) for r in table.collect()]
    names = F.create_map(*[F.lit(x) for pair in sorted(pairs) for x in pair])
    lines = F.split(F.lower(F.coalesce(text, F.lit(""))), "\n")
    if not pairs:
        names = F.create_map(F.lit(""), F.lit(None).cast("string"))
    parts = hints([r["body"] for r in spark.createDataFrame(list(notices), "name string, body string").select(
        canonical(F.col("body")).alias("body")).distinct().collect()])
    if parts:
        lines = F.filter(lines, lambda line: reduce(or_, [F.contains(line, F.lit(h)) for h in parts]))
    found = F.filter(F.transform(lines, lambda line: F.element_at(names, digest(line))), lambda name: name.isNotNull())
    rows = frame.select(
        F.col(f"`{id_col}`").alias(id_col), digest(text).alias("text_digest"),
        F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("line_licenses"),
    )
    return rows.join(F.broadcast(table), F.col("text_digest") == F.col("known_digest"), "left").select(
        id_col, "text_digest", "license", "line_licenses"
    )
