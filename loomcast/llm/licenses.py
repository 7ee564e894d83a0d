"""Licence scans by canonical digests, with DataFrame functions only.

A text is brought to a canonical form: copyright lines go, letters become lower case,
everything between words becomes one space, and equivalent spellings become one. Its
digest is then looked up among those of known licences, with one hash join of entire
texts. The same form of every single line is looked up among known one-line notices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.llm.common import keep

# Spellings that count as the same word in licence texts.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze",
    "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized",
    "calibre": "caliber", "cancelled": "canceled", "catalogue": "catalog",
    "categorise": "categorize", "centre": "center", "emphasised": "emphasized",
    "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "honour": "honor", "initialise": "initialize",
    "judgement": "judgment", "labelling": "labeling", "labour": "labor",
    "licence": "license", "licences": "licenses", "licenced": "licensed",
    "maximise": "maximize", "modelled": "modeled", "modelling": "modeling",
    "offence": "offense", "optimise": "optimize", "organisation": "organization",
    "organise": "organize", "practise": "practice", "programme": "program",
    "realise": "realize", "recognise": "recognize", "signalling": "signaling",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}

# Texts of short public licences, without their copyright lines.
LICENSES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event
will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software.
3. This notice may not be removed or altered from any source distribution.""",
}

# One-line notices.
NOTICES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the MIT License.": "MIT",
    "This project is licensed under the MIT License.": "MIT",
    "SPDX-License-Identifier: MIT": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "SPDX-License-Identifier: GPL-3.0-only": "GPL-3.0",
    "SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause",
    "SPDX-License-Identifier: ISC": "ISC",
}
TITLES = {"MIT": "MIT License", "ISC": "ISC License", "0BSD": "BSD Zero Clause License", "Zlib": "zlib License"}

COPYRIGHT_LINE = r"(?i)^[^\p{L}\p{N}©]*(copyright|\(c\)|©|all rights reserved)"
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"


def bare(text: Column) -> Column:
    """Without copyright lines, in lower case, with one space between words."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: ~F.rlike(line, F.lit(COPYRIGHT_LINE)))
    return F.btrim(F.regexp_replace(F.lower(F.array_join(lines, "\n")), BETWEEN_WORDS, " "))


def spelled(words: Column) -> Column:
    """A bare text with equivalent spellings as one."""
    table = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    return F.array_join(F.transform(F.split(words, " "), lambda w: F.coalesce(F.try_element_at(table, w), w)), " ")


def digest(text: Column) -> Column:
    return F.sha2(spelled(bare(text)), 256)


def known_digests(spark: SparkSession, texts: dict[str, list[str]]) -> tuple[DataFrame, int]:
    """(name, digest) of the given texts, and the longest bare form, in characters."""
    rows = [(name, text) for name, own in texts.items() for text in own]
    table = spark.createDataFrame(rows, "name string, text string")
    longest = table.agg(F.max(F.length(bare(F.col("text"))))).first()[0]
    return table.select("name", digest(F.col("text")).alias("digest")).distinct(), longest or 0


def scan_licenses(
    docs: DataFrame,
    licenses: dict[str, list[str]] | None = None,
    notices: dict[str, list[str]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, license, notices.

    ``license`` names the known licence whose entire canonical text the document is, or is
    null; ``notices`` lists the known one-line notices among its lines (distinct, sorted,
    joined by commas; empty without one). Both tables of known texts are parameters: name
    -> texts. A form longer than any known one cannot match and is not looked up. Null
    text counts as empty and matches nothing. Repeated rows and null ids each get their
    row. Other columns are ignored, whatever their names. An empty table gives an empty
    result.
    """
    if licenses is None:
        licenses = {name: [text, f"{TITLES[name]}\n\n{text}"] for name, text in LICENSES.items()}
    if notices is None:
        notices = {}
        for text, name in NOTICES.items():
            notices.setdefault(name, []).append(text)
    spark = docs.sparkSession
    whole, longest = known_digests(spark, licenses)
    lines, longest_line = known_digests(spark, notices)
    # a spelling changes a word by a few letters: twice the length leaves room for all
    shorter = lambda words, most: F.when((words != "") & (F.length(words) <= 2 * most), F.sha2(spelled(words), 256))
    own = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
    line_forms = F.transform(F.split(F.coalesce("_t", F.lit("")), "\n"), lambda t: shorter(bare(t), longest_line))
    forms = own.select(
        "_row", "doc_id", shorter(bare(F.col("_t")), longest).alias("_whole"), F.array_distinct(F.array_compact(line_forms)).alias("_lines")
    )
    # both tables of digests are as long as the lists given, not as the data
    named = keep(forms.join(F.broadcast(whole.toDF("license", "_whole")), "_whole", "left"), "licenses")
    hits = (
        named.select("_row", F.explode("_lines").alias("_line"))
        .join(F.broadcast(lines.toDF("notice", "_line")), "_line")
        .groupBy("_row")
        .agg(F.array_join(F.array_sort(F.collect_set("notice")), ",").alias("notices"))
    )
    return named.join(hits, "_row", "left").select("doc_id", "license", F.coalesce("notices", F.lit("")).alias("notices"))
