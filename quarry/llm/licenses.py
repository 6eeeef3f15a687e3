"""License scans by canonical digests, in DataFrame operations alone.

A text is put into a canonical form: lower case, without copyright lines, with
one spelling of words that have several, and without punctuation. The digests
of whole texts and of their lines are joined with those of known licences.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import license_texts
from quarry.llm.common import row_key

BROADCAST_ROWS = 100_000
"""Known texts (each a digest and an id) up to which their table is broadcast."""

# Spellings that count as equal, after lower-casing, as words.
EQUIVALENT = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licencing", "licensing"),
    ("sublicence", "sublicense"), ("sub license", "sublicense"), ("sub licence", "sublicense"),
    ("organisation", "organization"), ("organisations", "organizations"), ("authorised", "authorized"),
    ("favour", "favor"), ("behaviour", "behavior"), ("programme", "program"), ("acknowledgement", "acknowledgment"),
    ("non commercial", "noncommercial"), ("non infringement", "noninfringement"), ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"), ("https", "http"), ("per cent", "percent"), ("whilst", "while"),
]
# A line of copyright, from its start; the rest goes with it.
COPYRIGHT = r"(^|\n)[^\p{L}\p{N}\n]*(copyright[^\n]*(\(c\)|©|[0-9]{4})|\(c\)|©|all rights reserved)[^\n]*"
PUNCTUATION = r"[^\p{L}\p{N}\n]+"

# Texts of well-known licences and the notices that stand for them.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
]

# Titles that licence files put above texts that have none of their own.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "0BSD", "0BSD License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"],
    "BSD-2-Clause": [
        "BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "FreeBSD License",
        "BSD License", "The BSD License",
    ],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License",
        "Modified BSD License", "Revised BSD License", "BSD License", "The BSD License",
    ],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
THIRD_CLAUSE = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission.
THIS SOFTWARE IS"""
# Full texts with the lines of their titles, and what editions of them have in another wording.
FULL = [
    ("Apache-2.0", license_texts.APACHE_2, 3, [("Copyright [yyyy] [name of copyright owner]", "")]),
    ("GPL-2.0", license_texts.GPL_2, 2, []),
    ("GPL-3.0", license_texts.GPL_3, 2, [("licenses/why-not-lgpl", "philosophy/why-not-lgpl")]),
    ("LGPL-2.1", license_texts.LGPL_21, 2, []),
    ("LGPL-3.0", license_texts.LGPL_3, 2, []),
    ("MPL-2.0", license_texts.MPL_2, 2, []),
]
ADDRESS = r"51 Franklin (Street|St), Fifth Floor, Boston, MA +02110-1301,? +USA"
OLD_ADDRESS = "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA"


def _full_texts() -> list[tuple[str, str]]:
    """The full licences as files have them: with and without title, appendix and the other wordings."""
    texts = {}
    for name, text, n_title, wordings in FULL:
        forms = [text, *(text.replace(a, b) for a, b in wordings), re.sub(ADDRESS, OLD_ADDRESS, text)]
        forms += [f.replace("Ty Coon", "Moe Ghoul") for f in forms]
        forms += [re.split(r"(?<=END OF TERMS AND CONDITIONS)\n", f)[0] for f in forms]
        for form in forms:
            texts[name, form] = None
            texts[name, form.strip("\n").split("\n", n_title)[n_title]] = None
    plain = [(name, text) for name, text in KNOWN if "\n" in text]
    plain += [("BSD-3-Clause", t.replace("\nTHIS SOFTWARE IS", THIRD_CLAUSE, 1)) for name, t in plain if name == "BSD-2-Clause"]
    plain += [("BSD-3-Clause", license_texts.BSD_3_REGENTS), ("Unlicense", license_texts.UNLICENSE)]
    plain += [(name, re.sub(r"(?m)^\d\. ", "* ", t)) for name, t in plain if name.startswith("BSD-")]
    plain += [(name, t.replace("and/or distribute", "and distribute")) for name, t in plain if name == "ISC"]
    for name, text in plain:
        texts |= dict.fromkeys((name, f"{title}\n{text}") for title in ["", *TITLES[name]])
    return [x for x in texts if x not in KNOWN]


KNOWN += _full_texts()


def canonical_lines(text: Column) -> Column:
    """Canonical lines of a text, empty ones left out; words are single-spaced."""
    t = F.regexp_replace(F.lower(text), COPYRIGHT, "$1")
    # Every word gets a space of its own on both sides, so that replacements of neighbours do not overlap.
    t = F.concat(F.lit(" "), F.replace(F.regexp_replace(t, PUNCTUATION, "  "), F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for ours, theirs in EQUIVALENT:
        t = F.replace(t, F.lit(f" {ours.replace(' ', '  ')} "), F.lit(f" {theirs.replace(' ', '  ')} "))
    t = F.regexp_replace(F.regexp_replace(t, " +", " "), " ?\n ?", "\n")
    return F.array_remove(F.split(F.trim(t), "\n"), "")


def digests(lines: Column) -> Column:
    """Digest of the whole text first, then of each line."""
    return F.concat(F.array(F.sha2(F.concat_ws(" ", lines), 256)), F.transform(lines, lambda x: F.sha2(x, 256)))


def known_licenses(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``license_id, text`` of the given pairs, or of the built-in ones."""
    return spark.createDataFrame(known or KNOWN, "license_id string, text string")


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences whose canonical text is a document's whole text or one of its lines.

    ``known`` has ``license_id, text``. One row per row of ``docs``: ``doc_id,
    whole_license`` (null if the whole text is none; the first by name of
    several)``, line_licenses`` (sorted, joined by commas)``, n_license_lines``.
    A canonically empty text, null among them, matches nothing. Rows repeated
    with id and text get the same result. Other columns are not read.
    """
    keys = known.where(F.col("license_id").isNotNull()).select("license_id", canonical_lines(F.col("text")).alias("l"))
    keys = keys.where(F.size("l") > 0).select("license_id", F.get(digests(F.col("l")), F.lit(0)).alias("digest")).distinct()
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        *(c.alias(n) for c, n in zip(row_key(id_col, text_col), ("k1", "k2"), strict=True)),
    )
    lines = keyed.select("k1", "k2", canonical_lines(F.col("text")).alias("l"))
    units = lines.select("k1", "k2", F.posexplode_outer(digests(F.col("l"))).alias("at", "digest"))
    hits = units.join(keys, "digest").distinct()
    per_doc = hits.groupBy("k1", "k2").agg(
        F.min(F.when(F.col("at") == 0, F.col("license_id"))).alias("whole_license"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("at") > 0, F.col("license_id")))), ",").alias("line_licenses"),
        F.count_distinct(F.when(F.col("at") > 0, F.col("at"))).alias("n_license_lines"),
    )
    out = keyed.select("doc_id", "k1", "k2").join(per_doc, ["k1", "k2"], "left")
    return out.select(
        "doc_id", "whole_license", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
        F.coalesce("n_license_lines", F.lit(0)).cast("long").alias("n_license_lines"),
    )


def oracle_sql(known: list[tuple[str, str]] | None = None) -> str:
    """DuckDB SQL for ``scan_licenses`` over the table documents."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    canon = f"regexp_replace(lower(text), {quoted(COPYRIGHT)}, '\\1', 'g')"
    canon = f"' ' || replace(regexp_replace({canon}, {quoted(PUNCTUATION)}, '  ', 'g'), chr(10), ' ' || chr(10) || ' ') || ' '"
    for ours, theirs in EQUIVALENT:
        canon = f"replace({canon}, {quoted(' ' + ours.replace(' ', '  ') + ' ')}, {quoted(' ' + theirs.replace(' ', '  ') + ' ')})"
    canon = f"regexp_replace(regexp_replace({canon}, ' +', ' ', 'g'), ' ?\\n ?', chr(10), 'g')"
    lines = f"list_filter(string_split(trim({canon}, ' '), chr(10)), lambda x: x <> '')"
    rows = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in known or KNOWN)
    return f"""
        WITH known AS (
            SELECT DISTINCT license_id, sha256(array_to_string(l, ' ')) AS digest
            FROM (SELECT license_id, {lines} AS l FROM (VALUES {rows}) AS k(license_id, text)) WHERE len(l) > 0),
        texts AS (SELECT doc_id, {lines} AS l FROM documents),
        units AS (
            SELECT doc_id, 0 AS place, sha256(array_to_string(l, ' ')) AS digest FROM texts
            UNION ALL
            SELECT doc_id, unnest(range(1, len(l) + 1)) AS place, sha256(unnest(l)) AS digest FROM texts),
        hits AS (SELECT doc_id, place, license_id FROM units JOIN known USING (digest))
        SELECT doc_id, min(license_id) FILTER (WHERE place = 0) AS whole_license,
               coalesce(string_agg(DISTINCT license_id, ',' ORDER BY license_id) FILTER (WHERE place > 0), '') AS line_licenses,
               count(DISTINCT place) FILTER (WHERE place > 0) AS n_license_lines
        FROM documents LEFT JOIN hits USING (doc_id) GROUP BY doc_id
    """
