"""Licence scans by canonical digests, in DataFrame expressions only.

A text's canonical form drops copyright lines, lower-cases A-Z, turns punctuation and white space into single blanks and
writes equivalent spellings one way. The digest of the whole form is joined to the digests of known licences, a table of
fixed size; the lines of a text are looked up the same way, since documents often carry a one-line notice.

The oracle (``oracle_sql``) states the same rules on its own, line by line and with plain replacements, and shares only the
fixed tables.

Cases: null or empty text, or one of punctuation only, has an empty form and no licence; texts count whole; equal rows get
equal results; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Equivalent spellings (after punctuation has gone): every left side is written as the right side. Fixed values.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sub license", "sublicense"), ("sub licensing", "sublicensing"), ("non infringement", "noninfringement"), ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"), ("authorisation", "authorization"), ("authorised", "authorized"), ("behaviour", "behavior"), ("favour", "favor"), ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"), ("http", "https"), ("whilst", "while"), ("per cent", "percent"), ("v 2 0", "version 2 0"), ("v2 0", "version 2 0"), ("v3", "version 3"),
)
_GRANT_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_BODY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
    "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
_BSD_ONE = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
_BSD_TWO = "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
_BSD_THREE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Licences and how notices name them. Fixed values.
NAMES = (
    ("MIT", "the MIT License"), ("Apache-2.0", "the Apache License, Version 2.0"), ("Apache-2.0", "the Apache License 2.0"), ("ISC", "the ISC License"), ("BSD-2-Clause", "the BSD 2-Clause License"),
    ("BSD-3-Clause", "the BSD 3-Clause License"), ("GPL-2.0", "the GNU General Public License, version 2"), ("GPL-3.0", "the GNU General Public License, version 3"),
    ("GPL-2.0", "the GNU General Public License v2.0"), ("GPL-3.0", "the GNU General Public License v3.0"), ("LGPL-2.1", "the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "the GNU Lesser General Public License, version 3"), ("AGPL-3.0", "the GNU Affero General Public License, version 3"), ("MPL-2.0", "the Mozilla Public License, version 2.0"),
    ("MPL-2.0", "the Mozilla Public License 2.0"), ("Unlicense", "the Unlicense"), ("BSL-1.0", "the Boost Software License, Version 1.0"), ("CC0-1.0", "CC0 1.0"),
    *((f"CC-{k}-4.0", name) for k, long in (("BY", ""), ("BY-SA", "-ShareAlike"), ("BY-NC", "-NonCommercial"), ("BY-ND", "-NoDerivatives"), ("BY-NC-SA", "-NonCommercial-ShareAlike"), ("BY-NC-ND", "-NonCommercial-NoDerivatives"))
      for name in (f"CC {k} 4.0", f"a Creative Commons Attribution{long} 4.0 International License", f"the Creative Commons Attribution{long} 4.0 International License")),
)
OPENINGS = ("Licensed under", "Released under", "This work is licensed under", "This project is licensed under", "This software is licensed under")
_GNU = ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
SPDX = (*dict.fromkeys(k for k, _ in NAMES if k not in _GNU), "0BSD", *(k + end for k in _GNU for end in ("", "-only", "-or-later")))


def _public_texts() -> list[tuple[str, str]]:
    """The whole texts of licence_texts: as they are, without the appendix, and without the line that a copyright notice fills."""
    out = []
    for path in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):
        text, end = path.read_text("utf-8"), "END OF TERMS AND CONDITIONS"
        forms = [text, text[: text.index(end) + len(end)]] if end in text else [text]
        forms += [text.replace("   Copyright [yyyy] [name of copyright owner]\n", "")]
        out += [(path.stem, t) for t in dict.fromkeys(forms)]
    return out


#: Known texts. Public licence texts and their usual one-line notices.
KNOWN = (
    ("MIT", _GRANT_MIT), ("MIT", "MIT License\n" + _GRANT_MIT), ("MIT", "The MIT License (MIT)\n" + _GRANT_MIT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_BODY),
    ("ISC", "ISC License\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_BODY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _ISC_BODY),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_ONE + _BSD_TWO + _BSD_TAIL), ("BSD-3-Clause", _BSD_HEAD + _BSD_ONE + _BSD_TWO + _BSD_THREE + _BSD_TAIL),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "This project is licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"), ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"), ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."), ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    *((k, f"{opening} {name}.") for k, name in NAMES for opening in OPENINGS), *((k, f"SPDX-License-Identifier: {k}") for k in SPDX), *_public_texts(),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: What a copyright line begins with, after the word; the other words follow it in the prose of licences. Fixed values.
MARKS = r"(?:\(c\)|©|[0-9]{4}|:)"
PROSE = "notice|notices|holder|holders|owner|owners|license|licence|licenses|law|laws|and|or|in|of|is|on|to|for|by|this|that|if|with|which|interest|protection|treaty|statement|disclaimer|claim|status|permission|rights?|act"
#: Punctuation beyond ASCII that counts as blanks.
MARKED = "‘’“”–—•"


def canonical_sql(text: str) -> str:
    """The canonical form of a Spark SQL string expression."""
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def sub(x: str, pattern: str, to: str) -> str:
        return f"regexp_replace({x}, {quote(pattern)}, {quote(to)})"

    x = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    owner = rf"copyright[ \t]+(?!(?:{PROSE})(?![a-z0-9]))[a-z][^\n]{{0,80}}(?=\n|$)"
    x = sub(x, rf"(^|\n)[^a-z0-9\n(©]*(?:copyright[ \t]*{MARKS}[^\n]*|\(c\)[ \t]*[0-9]{{4}}[^\n]*|©[^\n]*|all rights reserved[^\n]*|{owner})", "$1")
    # two blanks between words and one at either end, so that each word has its own
    x = sub(x, rf"[{MARKED}\x00-\x2f\x3a-\x60\x7b-\x7f]+", "  ")
    spaced = lambda words: quote(f" {words.replace(' ', '  ')} ")
    # the spellings are rows that a loop takes, not nested calls: the JIT compiler inlines a nest into one huge method
    rows = ", ".join(f"struct({spaced(word)} AS word, {spaced(to)} AS other)" for word, to in SPELLINGS)
    x = f"aggregate(array({rows}), concat(' ', trim({x}), ' '), (form, s) -> replace(form, s.word, s.other))"
    return f"trim(replace({x}, '  ', ' '))"


def scan(df: DataFrame) -> DataFrame:
    """doc_id, digest, licence (of the whole text, or null), n_notices and notices of every row of ``df``.

    n_notices counts lines that are a known text as a whole; notices lists their licences, ascending, each once.
    """
    spark = df.sparkSession
    rows = ", ".join("('{}', '{}')".format(name, text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")) for name, text in KNOWN)
    digested = f"SELECT sha2({canonical_sql('t')}, 256) AS known_digest, l FROM VALUES {rows} AS v(l, t)"
    known = spark.sql(f"SELECT known_digest, min(l) AS licence FROM ({digested}) GROUP BY known_digest")
    digests = {r["known_digest"]: r["licence"] for r in known.collect()}  # one row per known text at most
    table = "map(" + ", ".join(f"'{d}', '{name}'" for d, name in sorted(digests.items())) + ")"
    text = "CAST(text AS STRING)"
    # a known line holds one of these words; others need no digest
    lines = f"filter(split(coalesce({text}, ''), '\\n'), l -> l RLIKE '(?i)licen[sc]e')"
    found = f"filter(transform({lines}, l -> element_at({table}, sha2({canonical_sql('l')}, 256))), x -> x IS NOT NULL)"
    out = df.selectExpr("doc_id", f"sha2({canonical_sql(text)}, 256) AS digest", f"{found} AS _found")
    out = out.join(F.broadcast(known), F.col("digest") == F.col("known_digest"), "left")
    return out.selectExpr("doc_id", "digest", "licence", "CAST(size(_found) AS BIGINT) AS n_notices", "array_join(array_sort(array_distinct(_found)), ',') AS notices")


def oracle_sql() -> str:
    """The same result in DuckDB's SQL over the view ``documents``: lines that are copyright lines go, and words stand apart
    with two blanks between them, so that plain replacements see each with its own."""
    rows = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN)
    plain = f"translate(l, '{UPPER}', '{LOWER}')"
    lead = r"^[^a-z0-9(©]*"
    drop = " OR ".join([
        rf"regexp_matches(l, '{lead}copyright[ \t]*{MARKS}')", rf"regexp_matches(l, '{lead}\(c\)[ \t]*[0-9]{{4}}')", f"regexp_matches(l, '{lead}©')", f"regexp_matches(l, '{lead}all rights reserved')",
        rf"(regexp_matches(l, '{lead}copyright[ \t]+[a-z].{{0,80}}$') AND NOT regexp_matches(l, '{lead}copyright[ \t]+(?:{PROSE})(?:[^a-z0-9]|$)'))",
    ])
    joined = f"array_to_string(list_filter(list_transform(string_split(t, chr(10)), lambda l: {plain}), lambda l: NOT ({drop})), ' ')"
    words = f"list_filter(regexp_split_to_array({joined}, '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+|[{MARKED}]'), lambda w: w <> '')"
    form = f"concat(' ', array_to_string({words}, '  '), ' ')"
    for word, to in SPELLINGS:
        form = f"replace({form}, ' {word.replace(' ', '  ')} ', ' {to.replace(' ', '  ')} ')"
    return f"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS t FROM documents),
asked AS (SELECT 1 AS kind, doc_id, NULL AS name, coalesce(text, '') AS t FROM documents UNION ALL SELECT 2, doc_id, NULL, t FROM lines WHERE regexp_matches(t, '(?i)licen[sc]e')
  UNION ALL SELECT 3, NULL, * FROM (VALUES {rows}) AS v(name, t)),
formed AS (SELECT kind, doc_id, name, sha256(trim(replace({form}, '  ', ' '))) AS digest FROM asked),
known AS (SELECT digest AS d, min(name) AS licence FROM formed WHERE kind = 3 GROUP BY 1),
notices AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS s FROM formed JOIN known ON digest = d WHERE kind = 2 GROUP BY doc_id)
SELECT doc_id, digest, licence, coalesce(n, 0) AS n_notices, coalesce(s, '') AS notices FROM formed LEFT JOIN known ON digest = d LEFT JOIN notices USING (doc_id) WHERE kind = 1"""
