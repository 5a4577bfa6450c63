"""Licence scans by canonical digests, with DataFrame functions only.

A text is brought to a canonical form: letters in lower case, copyright lines left out,
punctuation and white space one blank, equivalent spellings made equal. The SHA-256 of the
whole canonical text is hash-joined to the digests of known licence texts and notices. Lines
are digested and joined in the same way, which finds notices inside longer documents.

A line can only equal a known text if it holds that text's words. So a few words are chosen
that together occur in every known text, and lines without any of them, in any spelling, are
not digested: no result changes by that, whatever texts are known. The words are chosen on the driver
from canonical forms of at most ``WORDS_BYTES`` in total; if more is known, all lines are digested.

The known texts are a table (licence, text); the default is a small fixed one.

Defined cases: a null text, and one that is empty in canonical form, has no digest and no
licence; of known texts with equal digests the smallest name counts; repeated rows give equal
results, one each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import LOWER, UPPER, table

# Known licence texts and notices.
_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software. "
)
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
    "the above copyright notice and this permission notice appear in all copies. "
)
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_ENDORSEMENT = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. "
)
_HOLDERS_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
KNOWN = (
    ("MIT", "MIT License " + _GRANT + _AS_IS),
    ("MIT", _GRANT + _AS_IS),
    ("ISC", "ISC License " + _ISC + _ISC_AS_IS),
    ("ISC", _ISC + _ISC_AS_IS),
    ("BSD-2-Clause", "BSD 2-Clause License " + _REDISTRIBUTION + _HOLDERS_AS_IS),
    ("BSD-2-Clause", _REDISTRIBUTION + _HOLDERS_AS_IS),
    ("BSD-3-Clause", "BSD 3-Clause License " + _REDISTRIBUTION + _ENDORSEMENT + _HOLDERS_AS_IS),
    ("BSD-3-Clause", _REDISTRIBUTION + _ENDORSEMENT + _HOLDERS_AS_IS),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)
# Spellings that count as equal, each with the form kept.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("sub license", "sublicense"),
    ("organisation", "organization"), ("favour", "favor"), ("acknowledgement", "acknowledgment"), ("judgement", "judgment"),
    ("non infringement", "noninfringement"), ("merchantibility", "merchantability"), ("copyright owner", "copyright holder"),
    ("http", "https"),
)
_COPYRIGHT = r"(^|\n)[^a-z0-9\n]*(copyright [0-9(]|copyright \x{A9}|\(c\)|\x{A9}|all rights reserved)[^\n]*"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F\x{A0}\x{AB}\x{BB}\x{2010}-\x{201F}\x{2022}\x{2026}\x{3000}]+"
WORDS_BYTES = 64 << 20
_LONG = 7


def canonical(text: Column) -> Column:
    """The canonical form: words in lower case with one blank between them."""
    plain = F.regexp_replace(F.translate(text, UPPER, LOWER), _COPYRIGHT, "$1")
    # Two blanks between words let neighbours be respelled independently.
    spaced = F.concat(F.lit(" "), F.regexp_replace(plain, _GAP, "  "), F.lit(" "))
    for other, kept in SPELLINGS:
        spaced = F.replace(spaced, F.lit(f" {other.replace(' ', '  ')} "), F.lit(f" {kept.replace(' ', '  ')} "))
    return F.trim(F.replace(spaced, F.lit("  "), F.lit(" ")))


def digest(text: Column) -> Column:
    form = canonical(text)
    return F.when(F.length(form) > 0, F.sha2(form, 256))


def known_digests(known: DataFrame) -> DataFrame:
    """(known_digest, licence) with one row per digest."""
    return known.select(digest(F.col("text")).alias("known_digest"), "licence").filter("known_digest IS NOT NULL").groupBy("known_digest").agg(F.min("licence").alias("licence"))


def _raw_forms(word: str) -> set[str]:
    """Strings of which any lower-case text holds one, if its canonical form holds ``word``."""
    forms, before = {word}, set()
    while forms != before:
        before = set(forms)
        for other, kept in SPELLINGS:
            if any(form in part for form in before for part in kept.split()):
                forms.add(max(other.split(), key=len))
    return {form for form in forms if not any(other != form and other in form for other in forms)}


def telling_words(known: DataFrame) -> list[str] | None:
    """Lower-case strings such that every text equal to a known one holds one of them; None if too much is known to choose."""
    forms = known.select(canonical(F.col("text")).alias("form")).filter("form <> ''").distinct()
    if (forms.agg(F.sum(F.octet_length("form"))).first()[0] or 0) > WORDS_BYTES:
        return None
    left, chosen = [row.form for row in forms.collect()], set()
    words = {word for form in left for word in form.split(" ")}
    while left:
        # Of words long enough to be rare in other lines, the one most texts have.
        best = max(words, key=lambda w: (min(len(w), _LONG), sum(w in form for form in left), len(w), w))
        chosen |= _raw_forms(best)
        left = [form for form in left if best not in form]
        words = {word for form in left for word in form.split(" ")}
    return sorted(chosen)


def _may_match(line: Column, words: list[str] | None) -> Column:
    if words is None:
        return F.lit(True)
    found = F.lit(False)
    for word in words:
        found = found | F.contains(line, F.lit(word))
    return found


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, canonical_sha256, licence of the whole text, and the number and names of the notices in its lines."""
    names = known_digests(known)
    words = telling_words(known)
    lines = F.filter(F.split(F.translate(F.col("text"), UPPER, LOWER), "\n"), lambda line: _may_match(line, words))
    speaking = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(lines).alias("at", "line"))
    notices = (
        speaking.withColumn("digest", digest(F.col("line"))).join(names, F.col("digest") == F.col("known_digest"))
        .groupBy(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"))
        .agg(F.countDistinct("at").alias("n"), F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("names"))
    )
    whole = docs.select("doc_id", F.xxhash64("text").alias("text_key"), digest(F.col("text")).alias("canonical_sha256"))
    whole = whole.join(names, F.col("canonical_sha256") == F.col("known_digest"), "left")
    own = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key"))
    return whole.join(notices, own, "left").select(
        "doc_id", "canonical_sha256", "licence", F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"), F.coalesce("names", F.lit("")).alias("notices")
    )


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), spark.createDataFrame(list(KNOWN), "licence string, text string"))


def _canonical_sql(text: str) -> str:
    form = f"regexp_replace(translate({text}, '{UPPER}', '{LOWER}'), '{_COPYRIGHT}', '\\1', 'g')"
    form = f"(' ' || regexp_replace({form}, '{_GAP}', '  ', 'g') || ' ')"
    for other, kept in SPELLINGS:
        form = f"replace({form}, ' {other.replace(' ', '  ')} ', ' {kept.replace(' ', '  ')} ')"
    return f"trim(replace({form}, '  ', ' '), ' ')"


_VALUES = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in KNOWN)
OP9_SQL = f"""
WITH known(licence, text) AS (VALUES {_VALUES}),
k AS (SELECT sha256({_canonical_sql("text")}) AS digest, min(licence) AS licence FROM known GROUP BY 1),
w AS (SELECT doc_id, {_canonical_sql("text")} AS form, text FROM documents),
l AS (SELECT doc_id, text, line, row_number() OVER () AS at
      FROM (SELECT doc_id, text, unnest(string_split(translate(text, '{UPPER}', '{LOWER}'), chr(10))) AS line FROM documents)),
n AS (SELECT l.doc_id, count(*) AS n_notices, string_agg(DISTINCT k.licence, ',' ORDER BY k.licence) AS notices
      FROM l JOIN k ON sha256({_canonical_sql("l.line")}) = k.digest GROUP BY l.doc_id)
SELECT w.doc_id, CASE WHEN length(form) > 0 THEN sha256(form) END AS canonical_sha256, k.licence,
       coalesce(n.n_notices, 0)::BIGINT AS n_notices, coalesce(n.notices, '') AS notices
FROM w LEFT JOIN k ON length(form) > 0 AND sha256(form) = k.digest LEFT JOIN n ON n.doc_id = w.doc_id
"""
