"""License scans by canonical digest lookup.

Known licence texts and notices are normalised (case, punctuation, copyright lines and
equivalent spellings) and digested. A document's whole text, its paragraphs and its lines
are joined on the digest, each in full, and so are runs of paragraphs as long as the known texts: a unit is a licence
when all of it is, not when it mentions one. A text is normalised once and its units are cut from the result.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from glyphline.llm.common import query, table, whole

# Published one-line notices, by SPDX identifier.
LINES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0-or-later", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
]
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so"""
_MIT_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_WITHOUT_WARRANTY = """is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""


def _gnu_notice(what: str, version: str, program: str = "This program") -> str:
    """The file notice that the GNU licences recommend."""
    return f"""{program} is free software: you can redistribute it and/or modify it under the terms of the GNU {what} as published by
the Free Software Foundation, either version {version} of the License, or (at your option) any later version.

{program} {_WITHOUT_WARRANTY} See the GNU {what} for more details.

You should have received a copy of the GNU {what} along with {program[0].lower() + program[1:]}. If not, see
<https://www.gnu.org/licenses/>."""


# Whole licence texts, and the file notices of licences too long to stand in a file. Title (None where there is none) and text.
TEXTS = [
    ("MIT", "MIT License", f"""{_MIT_GRANT}, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

{_MIT_DISCLAIMER}"""),
    ("MIT", "The MIT License (MIT)", f"""{_MIT_GRANT}, subject to the following conditions:

The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or
substantial portions of the Software.

{_MIT_DISCLAIMER}"""),
    ("MIT-0", "MIT No Attribution", f"{_MIT_GRANT}.\n\n{_MIT_DISCLAIMER}"),
    ("ISC", "ISC License", f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

{_ISC_DISCLAIMER}"""),
    ("0BSD", "BSD Zero Clause License", f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

{_ISC_DISCLAIMER}"""),
    ("BSD-2-Clause", "BSD 2-Clause License", f"{_BSD_GRANT}\n\n{_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", "BSD 3-Clause License", f"""{_BSD_GRANT}

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

{_BSD_DISCLAIMER}"""),
    ("Zlib", "zlib License", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software
is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works
of the Software, unless such copies or derivative works are solely in the form of machine-executable object code
generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Unlicense", None, """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nVersion 2, December 2004", """Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is
allowed as long as the name is changed.

DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION

0. You just DO WHAT THE FUCK YOU WANT TO."""),
    ("Apache-2.0", None, """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
    ("MPL-2.0", None, """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("GPL-3.0-or-later", None, _gnu_notice("General Public License", "3")),
    ("GPL-2.0-or-later", None, _gnu_notice("General Public License", "2")),
    ("AGPL-3.0-or-later", None, _gnu_notice("Affero General Public License", "3")),
    ("LGPL-3.0-or-later", None, _gnu_notice("Lesser General Public License", "3", "This library")),
    ("LGPL-2.1-or-later", None, _gnu_notice("Lesser General Public License", "2.1", "This library")),
]
#: Every text is known with its title and without.
NOTICES = LINES + [
    (name, text) for name, title, body in TEXTS for text in ([body] if title is None else [body, f"{title}\n\n{body}"])
]
BEGINNING = 4
#: Spellings that licence texts use for one word, as (pattern on normalised text, word).
SPELLINGS = [
    (r"\blicen[cs]e?d\b", "licensed"),
    (r"\blicence", "license"),
    (r"\bsub license", "sublicense"),
    (r"\bnon infringement\b", "noninfringement"),
    (r"\b(v|ver|version) ?([0-9])", "version $2"),
    (r"\bcopyright (owner|holder)\b", "copyright holder"),
]
#: A line that names a holder, by sign, year or capitals, or reserves all rights: it goes with its line break,
#: also from behind the marks of a comment.
COPYRIGHT_LINE = (
    r"(?m)^[ \t#*;%>/!-]*(((?i:copyright)[ \t:]*(\([cC]\)|©|[0-9]{4})|\([cC]\)|©|(Copyright|COPYRIGHT)[ \t:]+([Bb]y[ \t]+)?"
    r"[A-Z][a-z]+[ \t]+[A-Z])[^\n]*|(?i:all rights reserved)\.?[ \t]*)(\n|$)"
)


def _when_mentioned(text: Column, words: tuple[str, ...], changed: Column) -> Column:
    """Rewrite only texts with one of the words: a search for words costs far less than a pattern."""
    mentioned = reduce(lambda a, w: a | F.contains(text, F.lit(w)), words[1:], F.contains(text, F.lit(words[0])))
    return F.when(mentioned, changed).otherwise(text)


def with_plain_lines(texts: DataFrame, text_col: str) -> DataFrame:
    """The texts in lower case and without copyright lines, with one space between words and
    digits of a line, and line breaks as they are."""
    text = F.col(text_col)
    signs = ("opyright", "OPYRIGHT", "(c)", "(C)", "©", "ights reserved", "IGHTS RESERVED", "ights Reserved")
    stages = [
        _when_mentioned(text, signs, F.regexp_replace(text, COPYRIGHT_LINE, "")),
        F.lower(text),
        F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " "),
        F.replace(F.replace(text, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n")),
    ]
    return reduce(lambda rows, stage: rows.withColumn(text_col, stage), stages, texts)


def digest(units: DataFrame, body: str) -> DataFrame:
    """The units with ``digest`` for ``body``: its lines as one, one spelling where it speaks of a licence."""
    text = F.col(body)
    spelled = reduce(lambda t, s: F.regexp_replace(t, *s), SPELLINGS, text)
    joined = units.withColumn(body, F.trim(F.regexp_replace(text, "\n+", " ")))
    found = F.sha2(_when_mentioned(text, ("licen", "copyright"), spelled), 256)
    # never null, so a join on it adds no null test that would compute all of this twice
    return joined.withColumn("digest", F.coalesce(found, F.lit(""))).drop(body)


def known_digests(spark: SparkSession, notices=NOTICES) -> DataFrame:
    """license, digest of every known text; as many rows as texts are given."""
    rows = spark.createDataFrame(list(notices), "license string, text string")
    return digest(with_plain_lines(rows, "text"), "text").withColumnRenamed("digest", "known").distinct()


def _beginnings(notices) -> list[str]:
    """The first letters of known texts: a section that begins otherwise is none of them. Spellings differ further on."""
    plain = ("".join(c if c.isalnum() else " " for c in text.lower()).split() for _, text in notices)
    return sorted({" ".join(words)[:BEGINNING] for words in plain})


def scan(
    docs: DataFrame, notices=NOTICES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, license, unit (text, section, paragraph or line) and n, how many such units carry it.

    All units of every text are digested. A one-line unit counts as a line, and as a text
    when it is all the text; a paragraph is two or more lines between blank lines; a section is two or more
    consecutive pieces between blank lines, up to as many as a known text has, but not the whole text. Null and
    empty texts, and an empty table, give no rows; rows that repeat an id add up. The known
    digests are a fixed list given by the caller, broadcast for that reason.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    rows = with_plain_lines(rows, "text")
    unit = lambda name, body: F.struct(F.lit(name).alias("unit"), body.alias("body"))
    lines = F.transform(F.split("text", "\n"), lambda x: unit("line", x))
    parts = F.filter(F.split("text", "\n\n+"), lambda x: F.contains(F.trim(x, F.lit("\n ")), F.lit("\n")))
    none = F.array().cast("array<struct<unit:string,body:string>>")
    blank = F.contains("text", F.lit("\n\n"))
    paragraphs = F.when(blank, F.transform(parts, lambda x: unit("paragraph", x))).otherwise(none)
    entire = F.array(unit("text", F.col("text")))
    longest = max(len(re.split(r"\n\n+", text)) for _, text in notices)
    # a column of its own: lambdas read it for every section
    rows = rows.withColumn("pieces", F.filter(F.split("text", "\n\n+"), lambda x: F.trim(x, F.lit("\n ")) != ""))
    begins = lambda x: F.left(F.trim(x, F.lit("\n ")), F.lit(BEGINNING)).isin(_beginnings(notices))
    sections = F.flatten(F.transform(
        "pieces",
        lambda x, i: F.when(
            begins(x),
            F.transform(
                F.filter(F.sequence(F.lit(2), F.lit(longest)), lambda k: (i + k <= F.size("pieces")) & (k < F.size("pieces"))),
                lambda k: unit("section", F.array_join(F.slice("pieces", i + 1, k), "\n")),
            ),
        ).otherwise(none),
    ))
    units = rows.select("doc_id", F.explode(F.concat(entire, paragraphs, sections, lines)).alias("u")).select("doc_id", "u.*")
    digests = digest(units, "body")
    known = known_digests(docs.sparkSession, notices)
    hits = digests.join(F.broadcast(known), F.col("digest") == F.col("known"))
    return hits.groupBy("doc_id", "license", "unit").agg(F.count("*").alias("n"))


def _sql() -> str:
    """The scan in SQL, with the normalisation written out once as a macro of nested expressions."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"

    def plain(text: str) -> str:
        kept = f"lower(regexp_replace({text}, {quoted(COPYRIGHT_LINE)}, '', 'g'))"
        spaced = f"regexp_replace({kept}, {quoted(r'[^\p{L}\p{N}\n]+')}, ' ', 'g')"
        return f"replace(replace({spaced}, ' ' || chr(10), chr(10)), chr(10) || ' ', chr(10))"

    def digest_of(body: str) -> str:
        joined = f"trim(regexp_replace({body}, {quoted(r'\n+')}, ' ', 'g'))"
        spelled = joined
        for pattern, word in SPELLINGS:
            spelled = f"regexp_replace({spelled}, {quoted(pattern)}, {quoted(word.replace('$', chr(92)))}, 'g')"
        return f"sha256(CASE WHEN contains({joined}, 'licen') OR contains({joined}, 'copyright') THEN {spelled} ELSE {joined} END)"

    known = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in NOTICES)
    longest = max(len(re.split(r"\n\n+", text)) for _, text in NOTICES)
    return f"""
    WITH k AS (SELECT DISTINCT license, {digest_of("plain")} AS digest
      FROM (SELECT license, {plain("text")} AS plain FROM (VALUES {known}) AS t(license, text))),
    p AS (SELECT doc_id, {plain("coalesce(text, '')")} AS plain FROM documents),
    u AS (
      SELECT doc_id, 'text' AS unit, plain AS body FROM p
      UNION ALL SELECT doc_id, 'line', unnest(string_split(plain, chr(10))) FROM p
      UNION ALL SELECT doc_id, 'paragraph', body FROM (
        SELECT doc_id, unnest(string_split_regex(plain, {quoted(r'\n\n+')})) AS body FROM p WHERE contains(plain, chr(10) || chr(10)))
        WHERE contains(trim(body, chr(10) || ' '), chr(10))
      UNION ALL SELECT doc_id, 'section', array_to_string(pieces[i:i + k - 1], chr(10)) FROM (
        SELECT doc_id, pieces, unnest(range(1, len(pieces))) AS i FROM (
          SELECT doc_id, list_filter(string_split_regex(plain, {quoted(r'\n\n+')}), lambda x: trim(x, chr(10) || ' ') <> '') AS pieces
          FROM p WHERE contains(plain, chr(10) || chr(10)))), (SELECT unnest(range(2, {longest} + 1)) AS k)
        WHERE i + k - 1 <= len(pieces) AND k < len(pieces))
    SELECT doc_id, license, unit, count(*)::BIGINT AS n
    FROM (SELECT doc_id, unit, {digest_of("body")} AS digest FROM u) JOIN k USING (digest) GROUP BY ALL
    """


@query(_sql())
def op5_license_scan(spark, sf):
    return scan(table(spark, sf, "documents"))
