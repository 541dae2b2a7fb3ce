"""License scan by canonical digests: whole texts against known licence texts.

A text is brought to a canonical form (lower case, copyright lines dropped, equivalent
spellings made one, punctuation and white space to single spaces); its SHA-256 is joined
to the digests of the known texts.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words after "Copyright" that make it a part of a sentence or heading of the terms; its
#: first letter is then made small, so that the line stays.
TERMS = r"(?m)^([ \t*#/;-]*)Copyright([ \t]+(?:Licen[cs]e|Notice|Holder|Owner|Law|Act|Treat|Statement|Right|Protect|And |Or |Is ))"
#: Lines that are no part of a licence's terms: a copyright line of any holder (the word with
#: a capital, then a name, year, sign or placeholder; or, in any case of letters, a year,
#: sign or "by"), and the reservation of rights.
IGNORED_LINES = (
    r"(?m)^[ \t*#/;-]*Copyright[ \t:]+[\p{Lu}\p{N}(©<\[{][^\n]*$",
    r"(?mi)^[ \t*#/;-]*(copyright[ \t:]+(\(c\)|©|[0-9]{4}|by[ \t])|\(c\)[ \t]|©)[^\n]*$",
    r"(?mi)^[ \t*#/;-]*all rights reserved\.?[ \t\r]*$")
#: Spellings that count as equal in licence texts, after public matching guidelines.
EQUIVALENT = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil ", "fulfill "),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("signalling", "signaling"), ("sub-license", "sublicense"), ("sub license", "sublicense"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"), ("non-infringement", "noninfringement"),
    ("non infringement", "noninfringement"), ("per cent", "percent"), ("copyright holder", "copyright owner"), ("http://", "https://"),
)

#: Public licence texts and notices, by SPDX name.
MIT_TERMS = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
BSD_SOURCE = """1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer."""
BSD_BINARY = """2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:"""
BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY,
OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
BSD_FORMS = {
    "BSD-2-Clause": ("BSD 2-Clause License", (BSD_GRANT, BSD_SOURCE, BSD_BINARY, BSD_WARRANTY)),
    "BSD-3-Clause": ("BSD 3-Clause License", (BSD_GRANT, BSD_SOURCE, BSD_BINARY, BSD_NAMES, BSD_WARRANTY)),
}
KNOWN = (
    *((name, head + "\n\n".join(parts)) for name, (title, parts) in BSD_FORMS.items() for head in ("", f"{title}\n\n", f"The {title}\n\n")),
    ("Unlicense", UNLICENSE),
    ("Unlicense", "The Unlicense\n\n" + UNLICENSE),
    ("MIT", "MIT License\n\n" + MIT_TERMS),
    ("MIT", "The MIT License (MIT)\n\n" + MIT_TERMS),
    ("MIT", MIT_TERMS),
    ("ISC", "ISC License\n\n" + ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n" + ISC_WARRANTY),
    ("ISC", ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n" + ISC_WARRANTY),
    ("0BSD", "BSD Zero Clause License\n\n" + ISC_GRANT + ".\n\n" + ISC_WARRANTY),
    ("0BSD", ISC_GRANT + ".\n\n" + ISC_WARRANTY),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""),
    ("Apache-2.0 notice", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
    ("Apache-2.0 notice", "Licensed under the Apache License, Version 2.0."),
    ("MIT notice", "Released under the MIT License."),
    ("GPL-3.0 notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0 notice", "Licensed under CC BY-NC 4.0."),
)

#: Whole texts of longer public licences, as they are published, by SPDX name.
FOLDER = Path(__file__).parent / "licence_texts"


def known_rows() -> list[tuple[str, str]]:
    """(license_id, text): the fixed texts above and the whole texts of ``FOLDER``."""
    return [*KNOWN, *((f.stem, f.read_text("utf-8")) for f in sorted(FOLDER.glob("*.txt")))]


def canonical(text: Column) -> Column:
    """The canonical form of a text; null: the empty text."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), TERMS, "$1copyright$2")
    for line in IGNORED_LINES:
        out = F.regexp_replace(out, line, "")
    out = F.regexp_replace(F.lower(out), r"\s+", " ")
    for one, other in EQUIVALENT:
        out = F.replace(out, F.lit(one), F.lit(other))
    return F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, license_id) of known texts (license_id, text): one row a digest. Texts that
    are equal in canonical form take the smallest name; null names and empty forms are left out."""
    rows = known.select("license_id", canonical(F.col("text")).alias("form")).where("license_id IS NOT NULL AND form <> ''")
    return rows.groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_rows(), "license_id string, text string")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, digest, license_id), one row per row of ``docs``: the digest of the whole
    text's canonical form and the licence it is the text of, else null.

    Only digests travel to the join. The known side has one row a digest, so the join adds
    no rows; it is small, so the planner sends it to the tasks, and beyond that size
    adaptive execution splits the digests that copies make frequent. Null, empty and wordless texts share one digest and match nothing; null
    and repeated ids keep their rows; other columns are not read; empty tables are allowed.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(canonical(F.col("text").cast("string")), 256).alias("digest")).join(
        known_digests(known), "digest", "left").select("doc_id", "digest", "license_id")


def _sql_form(column: str) -> str:
    out = rf"regexp_replace(coalesce({column}, ''), '{TERMS}', '\1copyright\2', 'g')"
    for line in IGNORED_LINES:
        out = f"regexp_replace({out}, '{line}', '', 'g')"
    out = rf"regexp_replace(lower({out}), '\s+', ' ', 'g')"
    for one, other in EQUIVALENT:
        out = f"replace({out}, '{one}', '{other}')"
    return rf"trim(regexp_replace({out}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


#: The same in SQL.
SQL = f"""
WITH known(license_id, text) AS (VALUES {', '.join(f'({_quoted(a)}, {_quoted(b)})' for a, b in known_rows())}),
k AS (SELECT sha256({_sql_form('text')}) AS digest, min(license_id) AS license_id FROM known GROUP BY 1),
d AS (SELECT doc_id, sha256({_sql_form('text')}) AS digest FROM documents)
SELECT doc_id, digest, license_id FROM d LEFT JOIN k USING (digest)
"""
