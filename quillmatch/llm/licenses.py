"""License scans by sentence-rule recognition.

A text is cut into sentences, each sentence is normalised and mapped to the
identifier of a known licence sentence, and the sequence of identifiers is
matched against ordered rules.

Sentences: comment signs at the start of a line go; a line feed between a
character that ends no sentence and a lower-case letter is a wrapped line and
becomes a space, so does one between a capital, comma or quote and two capitals,
and one before a name that licence sentences hold; then a text is cut at line feeds and after . ; : ! ? before
white space.  A sentence is normalised to lower-case ASCII letters and digits
in words joined by single spaces.

A rule holds if its identifiers follow one another in the text's sequence of
known identifiers; unknown sentences may stand between them.  All rules that
hold are reported, with the positions of their first and last sentence.

Null and empty texts, and texts without a known sentence, have empty results.
Rows with a null id and repeated rows are scanned each.  Texts of any length are
scanned whole.  Where several rules hold at one place all are reported, in the
order of the rules.  Columns whose names clash with the results', in any case,
are replaced.  An empty table gives an empty one.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import append_columns, as_bytes, texts

# Sentences of public licences, normalised, by identifier.
SENTENCES: dict[str, str] = {
    "apache-short": "licensed under the apache license version 2 0",
    "apache-the": "licensed under the apache license version 2 0 the license",
    "apache-may-not": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-short": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liable": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl2-work": "this work is licensed under the gnu general public license version 2",
    "lgpl3-work": "this work is licensed under the gnu lesser general public license version 3",
    "agpl3-work": "this work is licensed under the gnu affero general public license version 3",
    "gpl-free": "this program is free software",
    "gpl2-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl-either3": "either version 3 of the license or at your option any later version",
    "gpl-either2": "either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "mpl2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "public-domain": "this work is in the public domain",
    "boost": "distributed under the boost software license version 1 0",
    "all-rights": "all rights reserved",
    "apache-title": "apache license",
    "apache-version": "version 2 0 january 2004",
    "apache-terms": "terms and conditions for use reproduction and distribution",
    "apache-copyright-grant": "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative works in source or object form",
    "apache-redistribution": "you may reproduce and distribute copies of the work or derivative works thereof in any medium with or without modifications and in source or object form provided that you meet the following conditions",
    "apache-recipients": "you must give any other recipients of the work or derivative works a copy of this license",
    "apache-notices": "you must cause any modified files to carry prominent notices stating that you changed the files",
    "apache-trademarks": "this license does not grant permission to use the trade names trademarks service marks or product names of the licensor except as required for reasonable and customary use in describing the origin of the work and reproducing the content of the notice file",
    "apache-end": "end of terms and conditions",
    "mit-title": "the mit license",
    "mit-title-short": "mit license",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-liable": "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services",
    "bsd-loss": "loss of use data or profits",
    "bsd-caused": "or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "bsd-advertising": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "isc-liable": "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-liable": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "zlib-origin": "the origin of this software must not be misrepresented",
    "zlib-claim": "you must not claim that you wrote the original software",
    "zlib-acknowledge": "if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required",
    "zlib-altered": "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
    "zlib-notice": "this notice may not be removed or altered from any source distribution",
    "boost-see": "see accompanying file license 1 0 txt or copy at http www boost org license 1 0 txt",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "gpl-title": "gnu general public license",
    "gpl-version3": "version 3 29 june 2007",
    "gpl-version2": "version 2 june 1991",
    "gpl-verbatim": "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed",
    "gpl-preamble": "the gnu general public license is a free copyleft license for software and other kinds of works",
    "gpl-received": "you should have received a copy of the gnu general public license along with this program",
    "gpl-only3": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 3",
    "gpl-only2": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 2",
    "lgpl-title": "gnu lesser general public license",
    "lgpl-free": "this library is free software",
    "lgpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "lgpl-either21": "either version 2 1 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty",
    "lgpl-see": "see the gnu lesser general public license for more details",
    "lgpl-received": "you should have received a copy of the gnu lesser general public license along with this library",
    "agpl-title": "gnu affero general public license",
    "agpl-version": "version 3 19 november 2007",
    "agpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "agpl-see": "see the gnu affero general public license for more details",
    "agpl-received": "you should have received a copy of the gnu affero general public license along with this program",
    "mpl2-title": "mozilla public license version 2 0",
    "mpl2-secondary": "this source code form is incompatible with secondary licenses as defined by the mozilla public license v 2 0",
    "epl2": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "epl2-spdx": "spdx license identifier epl 2 0",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "unlicense-dedicate": "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain",
    "cc0-title": "cc0 1 0 universal",
    "wtfpl-title": "do what the fuck you want to public license",
    "wtfpl-do": "you just do what the fuck you want to",
    "postgresql-grant": "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies",
    "ofl-title": "sil open font license version 1 1 26 february 2007",
    "ofl": "this font software is licensed under the sil open font license version 1 1",
}
# The licence of each ordered rule.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache-short",)),
    ("Apache-2.0", ("apache-the", "apache-may-not")),
    ("Apache-2.0", ("apache-the", "apache-may-not", "apache-copy", "apache-as-is", "apache-see")),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liable")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("ISC", ("isc-grant",)),
    ("GPL-3.0", ("gpl3-work",)),
    ("GPL-2.0", ("gpl2-work",)),
    ("LGPL-3.0", ("lgpl3-work",)),
    ("AGPL-3.0", ("agpl3-work",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl2-redistribute", "gpl-either3")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-redistribute", "gpl-either2")),
    ("MPL-2.0", ("mpl2",)),
    ("CC0-1.0", ("cc0",)),
    ("Unlicense", ("unlicense",)),
    ("Public-Domain", ("public-domain",)),
    ("BSL-1.0", ("boost",)),
    ("All-Rights-Reserved", ("all-rights",)),
    ("Apache-2.0", ("apache-title", "apache-version", "apache-terms")),
    ("Apache-2.0", ("apache-copyright-grant", "apache-redistribution", "apache-recipients", "apache-notices", "apache-trademarks")),
    ("Apache-2.0", ("apache-recipients", "apache-notices")),
    ("Apache-2.0", ("apache-end", "apache-the", "apache-may-not")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-as-is", "mit-liable")),
    ("MIT", ("mit-title-short", "mit-grant", "mit-notice", "mit-as-is", "mit-liable")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-liable", "bsd-loss", "bsd-caused")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "bsd-liable", "bsd-loss", "bsd-caused")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-endorse")),
    ("0BSD", ("0bsd-grant", "isc-as-is", "isc-liable")),
    ("ISC", ("isc-grant", "isc-as-is", "isc-liable")),
    ("Zlib", ("zlib-as-is", "zlib-liable", "zlib-grant")),
    ("Zlib", ("zlib-as-is", "zlib-liable", "zlib-grant", "zlib-origin", "zlib-claim", "zlib-acknowledge", "zlib-altered", "zlib-notice")),
    ("BSL-1.0", ("boost", "boost-see")),
    ("BSL-1.0", ("boost-grant",)),
    ("GPL-3.0", ("gpl-title", "gpl-version3", "gpl-verbatim")),
    ("GPL-3.0", ("gpl-title", "gpl-version3", "gpl-verbatim", "gpl-preamble")),
    ("GPL-2.0", ("gpl-title", "gpl-version2", "gpl-verbatim")),
    ("GPL-3.0-only", ("gpl-free", "gpl-only3", "gpl-hope", "gpl-implied", "gpl-see")),
    ("GPL-2.0-only", ("gpl-free", "gpl-only2", "gpl-hope", "gpl-implied", "gpl-see")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl2-redistribute", "gpl-either3", "gpl-hope", "gpl-implied", "gpl-see", "gpl-received")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-redistribute", "gpl-either2", "gpl-hope", "gpl-implied", "gpl-see", "gpl-received")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl-redistribute", "lgpl-either21")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl-redistribute", "lgpl-either21", "lgpl-hope", "gpl-implied", "lgpl-see", "lgpl-received")),
    ("LGPL-3.0", ("lgpl-title", "gpl-version3", "gpl-verbatim")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl-redistribute", "gpl-either3")),
    ("AGPL-3.0", ("agpl-title", "agpl-version", "gpl-verbatim")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl-redistribute", "gpl-either3")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl-redistribute", "gpl-either3", "gpl-hope", "gpl-implied", "agpl-see", "agpl-received")),
    ("MPL-2.0", ("mpl2", "mpl2-copy")),
    ("MPL-2.0", ("mpl2-title",)),
    ("MPL-2.0-no-copyleft-exception", ("mpl2", "mpl2-copy", "mpl2-secondary")),
    ("EPL-2.0", ("epl2",)),
    ("EPL-2.0", ("epl2", "epl2-spdx")),
    ("Unlicense", ("unlicense", "unlicense-anyone", "unlicense-dedicate")),
    ("CC0-1.0", ("cc0-title",)),
    ("WTFPL", ("wtfpl-title", "wtfpl-do")),
    ("PostgreSQL", ("postgresql-grant",)),
    ("OFL-1.1", ("ofl",)),
    ("OFL-1.1", ("ofl", "ofl-title")),
]
for _variant in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
    for _version in ("3.0", "4.0"):
        _id = f"cc-{_variant.lower()}-{_version}"
        SENTENCES[_id] = f"licensed under cc {_variant} {_version}".lower().replace("-", " ").replace(".", " ")
        RULES.append((f"CC-{_variant}-{_version}", (_id,)))

#: Every known sentence holds one of these parts of words, so a text without them has none.
MARKS = ("licen", "copyright", "permi", "warrant", "redistribut", "liab", "domain", "reserved", "software", "mpl", "apache", "terms", "work", "notices", "version", "loss of", "business", "acknowledg", "altered", "cc0", "you just do", "epl")

COMMENT = r"(^|\n)[ \t]*(?:#+|//+|\*+|;+|--+|/\*+)[ \t]?"
WRAP = r"([^.;:!?\n])[ \t]*\n[ \t]*([a-z])"
CAPITAL_WRAP = r"([A-Z,\"])[ \t]*\n[ \t]*([A-Z][A-Z])"
#: Names in licence sentences that a wrapped line may begin with.
NAME_WRAP = r"([a-zA-Z,])[ \t]*\n[ \t]*(License|Lesser|General Public|Public License|Affero|Foundation|Free Software|MERCHANTABILITY|FITNESS|WITHOUT|WARRANTY|GNU |Mozilla Public)"
CUT = r"\n+|[.;:!?]+[ \t\n]+"
_COMMENT, _WRAP, _CAPITAL_WRAP, _NAME_WRAP, _CUT, _OTHER = (re.compile(x, re.A) for x in (COMMENT, WRAP, CAPITAL_WRAP, NAME_WRAP, CUT, "[^a-z0-9]+"))
_BY_TEXT = {text: name for name, text in SENTENCES.items()}


def sentences(text: str) -> list[str]:
    """Normalised sentences, empty ones included, so that positions count all."""
    text = _WRAP.sub(r"\1 \2", _COMMENT.sub(r"\1", text.replace("\r\n", "\n")))
    text = _NAME_WRAP.sub(r"\1 \2", _CAPITAL_WRAP.sub(r"\1 \2", text))
    lower = text.translate(_LOWER)
    return [_OTHER.sub(" ", s).strip(" ") for s in _CUT.split(lower)]


_LOWER = {c: c + 32 for c in range(65, 91)}


def scan(text: str) -> list[tuple[str, int, int, int]]:
    """(licence, rule, first sentence, last sentence) of every place where a rule holds, in order."""
    lower = text.lower()
    if not any(m in lower for m in MARKS):
        return []
    known = [(i, _BY_TEXT[s]) for i, s in enumerate(sentences(text)) if s in _BY_TEXT]
    names = tuple(n for _, n in known)
    found = []
    for number, (licence, rule) in enumerate(RULES):
        for i in range(len(names) - len(rule) + 1):
            if names[i : i + len(rule)] == rule:
                found.append((licence, number, known[i][0], known[i + len(rule) - 1][0]))
    return sorted(found, key=lambda f: (f[2], f[1]))


def recognise(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Appends ``licenses`` (distinct, sorted) and ``matches`` (licence, rule, first and last sentence); such columns are replaced."""
    match = pa.struct([("license", pa.string()), ("rule", pa.int64()), ("first_sentence", pa.int64()), ("last_sentence", pa.int64())])

    def kernel():
        def work(batch: pa.RecordBatch) -> list:
            found = [scan(x.decode("utf-8", "replace")) for x in texts(batch.column(0))]
            rows = [[dict(zip(("license", "rule", "first_sentence", "last_sentence"), f, strict=True)) for f in x] for x in found]
            return [pa.array([sorted({f[0] for f in x}) for x in found], pa.list_(pa.string())), pa.array(rows, pa.list_(match))]

        return work

    ddl = "licenses array<string>, matches array<struct<license: string, rule: long, first_sentence: long, last_sentence: long>>"
    return append_columns(docs, kernel, [as_bytes(text_col)], ddl, docs.columns if keep is None else keep)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle() -> str:
    """DuckDB SQL of doc_id, licenses, n_matches and first_sentence over documents."""
    known = ", ".join(f"({_text(n)}, {_text(t)})" for n, t in SENTENCES.items())
    rules = ", ".join(f"({_text(lic)}, {_text('|' + '|'.join(ids) + '|')}, {len(ids)})" for lic, ids in RULES)
    cut = "regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), " + _text(COMMENT) + ", '\\1', 'g'), " + _text(WRAP) + ", '\\1 \\2', 'g'), " + _text(CAPITAL_WRAP) + ", '\\1 \\2', 'g'), " + _text(NAME_WRAP) + ", '\\1 \\2', 'g'), " + _text(CUT) + ")"
    return f"""
WITH known(name, sentence) AS (VALUES {known}), rules(license, pattern, size) AS (VALUES {rules}),
cut AS (SELECT doc_id, {cut} AS s FROM documents),
rows AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos FROM cut),
named AS (
  SELECT r.doc_id, r.pos, k.name FROM rows r JOIN known k
  ON trim(regexp_replace(translate(r.sentence, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'), ' ') = k.sentence
), seq AS (SELECT doc_id, list(name ORDER BY pos) AS names, list(pos ORDER BY pos) AS places FROM named GROUP BY doc_id),
tried AS (SELECT doc_id, names, places, unnest(range(1, len(names) + 1)) AS i FROM seq),
found AS (
  SELECT t.doc_id, r.license, t.places[t.i] AS first_sentence FROM tried t JOIN rules r
  ON '|' || array_to_string(t.names[t.i:t.i + r.size - 1], '|') || '|' = r.pattern
), summed AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(*) AS n_matches, min(first_sentence) AS first_sentence FROM found GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.licenses, '') AS licenses, coalesce(s.n_matches, 0)::BIGINT AS n_matches, coalesce(s.first_sentence, -1)::BIGINT AS first_sentence
FROM documents d LEFT JOIN summed s ON d.doc_id = s.doc_id
"""
