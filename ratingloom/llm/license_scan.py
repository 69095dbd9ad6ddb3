"""Licence scan: known sentences become identifiers, their sequence is read by ordered rules.

Comment signs and list labels at the beginnings of lines are taken off. A text is cut into
sentences after ``.``, ``!`` or ``?`` and white space; an empty line, a line that begins with a
capital letter and the end of a line after ``:`` may cut as well. A known sentence is recognised where it begins and ends at cuts and
crosses at most cuts of the second kind, so it is found however a notice is wrapped or commented.
Before comparing, runs of anything but ASCII letters and digits become one space, lower case.
``*`` in a known sentence stands for one to twelve words (a holder, a program). An
``SPDX-License-Identifier`` is a sentence of its own wherever it stands; its licences are those
of its expression, as written, so identifiers need not be known.

A rule names sentences that follow each other in the
sequence of those recognised; rules are tried in their order, and what one has matched is
no longer there for later ones, so a full notice is not also reported by its parts.

All of it happens within the row, with built-in functions only: there is no shuffle, and a
long text is one row of work. Null and empty texts have no sentences, no licences. Equal
rows get equal results; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.llm.common import id_and_text

# Sentences of public licence notices, normalised.
SENTENCES: dict[str, str] = {
    "mit_released": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit_liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "apache_licensed": "licensed under the apache license version 2 0",
    "apache_comply": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache_obtain": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache_as_is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl3_work": "this work is licensed under the gnu general public license version 3",
    "gpl3_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl_see": "see the gnu general public license for more details",
    "cc_by_nc_4": "licensed under cc by nc 4 0",
    "cc_by_4": "licensed under cc by 4 0",
    "cc_by_sa_4": "licensed under cc by sa 4 0",
    "cc_by_4_work": "this work is licensed under a creative commons attribution 4 0 international license",
    "bsd_conditions": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "spdx_mit": "spdx license identifier mit",
    "spdx_apache": "spdx license identifier apache 2 0",
    "spdx_gpl3": "spdx license identifier gpl 3 0 or later",
    "all_rights": "all rights reserved",
}

# Licence, then the sentences that declare it one after the other; whole
# notices come before their parts.
RULES: list[tuple[str, str, list[str]]] = [
    ("mit_text", "MIT", ["mit_grant", "mit_warranty", "mit_liability"]),
    ("apache_header", "Apache-2.0", ["apache_comply", "apache_obtain", "apache_as_is", "apache_see"]),
    ("gpl3_notice", "GPL-3.0-or-later", ["gpl3_free", "gpl_hope", "gpl_see"]),
    ("gpl2_notice", "GPL-2.0-or-later", ["gpl2_free", "gpl_hope", "gpl_see"]),
    ("mit_spdx", "MIT", ["spdx_mit"]),
    ("apache_spdx", "Apache-2.0", ["spdx_apache"]),
    ("gpl3_spdx", "GPL-3.0-or-later", ["spdx_gpl3"]),
    ("apache_short", "Apache-2.0", ["apache_comply"]),
    ("apache_line", "Apache-2.0", ["apache_licensed"]),
    ("mit_line", "MIT", ["mit_released"]),
    ("mit_line_2", "MIT", ["mit_licensed"]),
    ("mit_grant_only", "MIT", ["mit_grant"]),
    ("gpl3_line", "GPL-3.0-only", ["gpl3_work"]),
    ("gpl3_short", "GPL-3.0-or-later", ["gpl3_free"]),
    ("gpl2_short", "GPL-2.0-or-later", ["gpl2_free"]),
    ("cc_by_nc_line", "CC-BY-NC-4.0", ["cc_by_nc_4"]),
    ("cc_by_sa_line", "CC-BY-SA-4.0", ["cc_by_sa_4"]),
    ("cc_by_line", "CC-BY-4.0", ["cc_by_4"]),
    ("cc_by_work", "CC-BY-4.0", ["cc_by_4_work"]),
    ("bsd_text", "BSD", ["bsd_conditions"]),
]

_TERMS = "you can redistribute it and or modify it under the terms of the gnu"
_LATER = "of the license or at your option any later version"
_HOPE = "is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"

# Further sentences, and further wordings of those above, which the SQL does not know.
WORDINGS: dict[str, list[str]] = {
    "mit_licensed": ["* licensed under the mit license", "* licensed under the terms of the mit license", "* distributed under the mit license", "use of this source code is governed by an mit style license that can be found in the license file"],
    "mit_released": ["* is released under the mit license"],
    "apache_licensed": ["* is licensed under the apache license version 2 0", "licensed under the apache license 2 0", "licensed under the apache 2 0 license"],
    "apache_obtain": ["you may obtain a copy of the license at https www apache org licenses license 2 0"],
    "apache_title": ["apache license version 2 0 january 2004", "apache license version 2 0 january 2004 http www apache org licenses", "apache license version 2 0 january 2004 https www apache org licenses"],
    "gpl3_free": [f"* is free software {_TERMS} general public license as published by the free software foundation either version 3 {_LATER}"],
    "gpl2_free": [f"* is free software {_TERMS} general public license as published by the free software foundation either version 2 {_LATER}"],
    "gpl2_only": [f"* is free software {_TERMS} general public license version 2 as published by the free software foundation"],
    "gpl3_only": [f"* is free software {_TERMS} general public license version 3 as published by the free software foundation"],
    "gpl3_title": ["gnu general public license version 3 29 june 2007"],
    "gpl2_title": ["gnu general public license version 2 june 1991"],
    "lgpl21_free": [f"* is free software {_TERMS} lesser general public license as published by the free software foundation either version 2 1 {_LATER}"],
    "lgpl3_free": [f"* is free software {_TERMS} lesser general public license as published by the free software foundation either version 3 {_LATER}"],
    "agpl3_free": [f"* is free software {_TERMS} affero general public license as published by the free software foundation either version 3 {_LATER}"],
    "gpl_hope": [f"* {_HOPE}"],
    "lgpl_see": ["see the gnu lesser general public license for more details"],
    "agpl_see": ["see the gnu affero general public license for more details"],
    "bsd_source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd_binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd_names": ["neither the name of * may be used to endorse or promote products derived from this software without specific prior written permission", "the name of * may not be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd_ads": ["all advertising materials mentioning features or use of this software must display the following acknowledgement *"],
    "bsd_as_is": ["this software is provided by * as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"],
    "bsd_liability": ["in no event shall * be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"],
    "bsd_governed": ["use of this source code is governed by a bsd style license that can be found in the license file"],
    "isc_grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "zero_bsd_grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "mpl2_form": ["this source code form is subject to the terms of the mozilla public license v"],  # "v. 2.0." is cut
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "boost_line": ["distributed under the boost software license version 1 0"],
    "cc0_waived": ["to the extent possible under law * has waived all copyright and related or neighboring rights to *"],
    "cc_by_sa_4_work": ["this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc_by_nc_4_work": ["this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
}

# As RULES; the first are tried before those, the others after.
FIRST_RULES: list[tuple[str, str, list[str]]] = [
    ("bsd4_text", "BSD-4-Clause", ["bsd_conditions", "bsd_source", "bsd_binary", "bsd_ads", "bsd_names"]),
    ("bsd3_text", "BSD-3-Clause", ["bsd_conditions", "bsd_source", "bsd_binary", "bsd_names", "bsd_as_is", "bsd_liability"]),
    ("bsd3_conditions", "BSD-3-Clause", ["bsd_conditions", "bsd_source", "bsd_binary", "bsd_names"]),
    ("bsd2_text", "BSD-2-Clause", ["bsd_conditions", "bsd_source", "bsd_binary", "bsd_as_is", "bsd_liability"]),
    ("isc_text", "ISC", ["isc_grant"]),
    ("zero_bsd_text", "0BSD", ["zero_bsd_grant"]),
    ("lgpl21_notice", "LGPL-2.1-or-later", ["lgpl21_free", "gpl_hope", "lgpl_see"]),
    ("lgpl3_notice", "LGPL-3.0-or-later", ["lgpl3_free", "gpl_hope", "lgpl_see"]),
    ("agpl3_notice", "AGPL-3.0-or-later", ["agpl3_free", "gpl_hope", "agpl_see"]),
    ("gpl2_only_notice", "GPL-2.0-only", ["gpl2_only", "gpl_hope", "gpl_see"]),
    ("gpl3_only_notice", "GPL-3.0-only", ["gpl3_only", "gpl_hope", "gpl_see"]),
]
LAST_RULES: list[tuple[str, str, list[str]]] = [
    ("apache_text", "Apache-2.0", ["apache_title"]),
    ("gpl3_text", "GPL-3.0-only", ["gpl3_title"]),
    ("gpl2_text", "GPL-2.0-only", ["gpl2_title"]),
    ("gpl2_only_short", "GPL-2.0-only", ["gpl2_only"]),
    ("gpl3_only_short", "GPL-3.0-only", ["gpl3_only"]),
    ("lgpl21_short", "LGPL-2.1-or-later", ["lgpl21_free"]),
    ("lgpl3_short", "LGPL-3.0-or-later", ["lgpl3_free"]),
    ("agpl3_short", "AGPL-3.0-or-later", ["agpl3_free"]),
    ("bsd_line", "BSD", ["bsd_governed"]),
    ("mpl2_header", "MPL-2.0", ["mpl2_form"]),
    ("unlicense_text", "Unlicense", ["unlicense"]),
    ("boost_header", "BSL-1.0", ["boost_line"]),
    ("cc0_notice", "CC0-1.0", ["cc0_waived"]),
    ("cc_by_sa_work", "CC-BY-SA-4.0", ["cc_by_sa_4_work"]),
    ("cc_by_nc_work", "CC-BY-NC-4.0", ["cc_by_nc_4_work"]),
]
SPDX = "spdx_expression"  # sentence and rule of identifiers without a sentence of their own

BREAK, WRAP = "\x1e", "\x1f"  # a cut that no sentence crosses, one that a known sentence may cross
# What the SQL cuts at.
SENTENCE_END = r"([.!?])[ \t\r\n]+|\n[ \t\r]*\n|\n[ \t]*([A-Z])"


COMMENT = r"(?md)^[ \t]*(?:(?:#+|//+!?|/\*+!?|\*+/?|--+|;+|%+|<!--|>+|\"\"\"|'''|(?i:rem|dnl)(?=[ \t]))[ \t]*)?(?:\(?[0-9]{1,2}[.)][ \t]+|[*-][ \t]+)?"
EXPRESSION = r"(?i)SPDX-License-Identifier[ \t]*:[ \t]*(\(*[ \t]*[a-z0-9][a-z0-9.+:-]*\)*(?:[ \t]+(?-i:AND|OR|WITH)[ \t]+\(*[ \t]*[a-z0-9][a-z0-9.+:-]*[ \t]*\)*)*)"


def _pattern(sentence: str) -> str:
    """A known sentence in a cut text: its words, and cuts of the second kind between them."""
    gap, word = rf"[ {WRAP}]+", "[a-z0-9]+"
    return gap.join(rf"{word}(?:{gap}{word}){{0,11}}?" if w == "*" else w for w in sentence.split())


def recognised(text: Column, known: dict[str, list[str]]) -> Column:
    """Ids of the known sentences of a text, in order."""
    lines = F.regexp_replace(F.coalesce(text, F.lit("")), COMMENT, "")
    spdx = F.regexp_replace(lines, EXPRESSION, f"{BREAK}$0{BREAK}")
    cut = F.regexp_replace(F.regexp_replace(spdx, r"([.!?])[ \t\r\n]+", f"$1{BREAK}"), r"\n[ \t\r]*\n|(?<=:)[ \t\r]*\n|\n[ \t]*(?=[A-Z])", WRAP)
    plain = F.lower(F.regexp_replace(cut, rf"[^A-Za-z0-9{BREAK}{WRAP}]+", " "))
    pairs = [(w, name) for name, wordings in known.items() for w in wordings]
    pairs.sort(key=lambda p: ("*" in p[0], -len(p[0])))  # a longer one before its beginning, exact ones before patterns
    ids = F.create_map(*[F.lit(x) for w, name in pairs if "*" not in w for x in (w, name)])
    spdx_line = "spdx license identifier"
    any_of = "|".join([*(_pattern(w) for w, _ in pairs), _pattern(spdx_line) + rf" [^{BREAK}{WRAP}]*[a-z0-9]"])
    found = F.regexp_extract_all(F.concat(F.lit(BREAK), plain, F.lit(BREAK)), F.lit(rf"[{BREAK}{WRAP}] ?({any_of})(?= ?[{BREAK}{WRAP}])"), F.lit(1))

    def named(s: Column) -> Column:
        s = F.regexp_replace(s, rf"[ {WRAP}]+", " ")
        kinds = F.when(s.startswith(spdx_line), F.lit(SPDX))
        for w, name in pairs:
            if "*" in w:
                kinds = kinds.when(s.rlike(rf"\A(?:{_pattern(w)})\z"), F.lit(name))
        return F.coalesce(ids[s], kinds)

    return F.transform(found, named)


def expressions(text: Column, known: dict[str, list[str]]) -> Column:
    """Licences of the SPDX lines that are not known sentences, as written; an exception stays with its licence."""
    sentence = [w for wordings in known.values() for w in wordings if w.startswith("spdx ")]
    plain = lambda e: F.concat(F.lit("spdx license identifier "), F.trim(F.lower(F.regexp_replace(e, "[^A-Za-z0-9]+", " "))))
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(EXPRESSION), F.lit(1))
    if sentence:
        found = F.filter(found, lambda e: ~plain(e).isin(sentence))
    each = F.flatten(F.transform(found, lambda e: F.split(F.regexp_replace(e, "[()]", " "), r"[ \t]+(?:AND|OR)[ \t]+")))
    return F.transform(each, lambda e: F.trim(F.regexp_replace(e, r"[ \t]+", " ")))


def scan(docs: DataFrame, known: dict[str, str] | None = None, rules: list[tuple[str, str, list[str]]] | None = None) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): the recognised sentence ids in order, the
    rules that matched and their licences in the order of the rules, then those of SPDX
    expressions, and how many recognised sentences no rule has taken."""
    wordings = {name: [w] for name, w in (known or SENTENCES).items()}
    if known is None:
        wordings |= {name: [*wordings.get(name, []), *more] for name, more in WORDINGS.items()}
    rules = [*(rules or [*FIRST_RULES, *RULES, *LAST_RULES]), (SPDX, "", [SPDX])]
    found = id_and_text(docs).select(
        "doc_id", recognised(F.col("text"), wordings).alias("sentence_ids"), expressions(F.col("text"), wordings).alias("spdx")
    )
    # <a><b>: a rule is a substring; what it matched leaves a bar, so its sides do not become neighbours
    frame = found.withColumn("left", F.array_join(F.transform("sentence_ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), ""))
    hits, names = [], []
    for rule, licence, parts in rules:
        sequence = "".join(f"<{p}>" for p in parts)
        frame = frame.withColumn(f"hit_{rule}", F.col("left").contains(sequence))
        frame = frame.withColumn("left", F.when(F.col(f"hit_{rule}"), F.replace("left", F.lit(sequence), F.lit("|"))).otherwise(F.col("left")))
        hits.append(F.when(F.col(f"hit_{rule}"), F.lit(rule)))
        if licence:
            names.append(F.when(F.col(f"hit_{rule}"), F.lit(licence)))
    return frame.select(
        "doc_id",
        "sentence_ids",
        F.array_compact(F.array(*hits)).alias("rules"),
        F.array_distinct(F.concat(F.array_compact(F.array(*names)), "spdx")).alias("licenses"),
        (F.length("left") - F.length(F.replace("left", F.lit("<"), F.lit("")))).cast("bigint").alias("n_unruled"),
    )


def report(docs: DataFrame) -> DataFrame:
    """The scan with its lists written as text."""
    joined = {c: F.array_join(c, ",") for c in ("sentence_ids", "rules", "licenses")}
    return scan(docs).withColumn("n_sentences", F.size("sentence_ids").cast("bigint")).withColumns(joined)


def sql() -> str:
    """The report as SQL, from SENTENCES and RULES alone: it equals the scan where notices are not wrapped or commented."""
    known = ", ".join(f"('{text}', '{name}')" for name, text in SENTENCES.items())
    steps, last, columns = [], "found", ""
    for rule, _, parts in RULES:
        sequence = "".join(f"<{p}>" for p in parts)
        steps.append(f"step_{rule} AS (SELECT * REPLACE (replace(rest, '{sequence}', '|') AS rest), contains(rest, '{sequence}') AS hit_{rule} FROM {last})")
        last = f"step_{rule}"
    hits = ", ".join(f"CASE WHEN hit_{r} THEN '{r}' END" for r, _, _ in RULES)
    licences = list(dict.fromkeys(name for _, name, _ in RULES))
    any_of = {n: " OR ".join(f"hit_{r}" for r, m, _ in RULES if m == n) for n in licences}
    columns = ", ".join(f"CASE WHEN {any_of[n]} THEN '{n}' END" for n in licences)
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
cut AS (
  SELECT doc_id, row_number() OVER () AS row_id,
    string_split(lower(regexp_replace(regexp_replace(coalesce(text, ''), '{SENTENCE_END}', '\\1' || chr(30) || '\\2', 'g'), '[^A-Za-z0-9\\x1e]+', ' ', 'g')), chr(30)) AS parts
  FROM documents),
each AS (SELECT doc_id, row_id, unnest(range(len(parts))) AS nth, trim(unnest(parts)) AS sentence FROM cut),
hits AS (SELECT row_id, string_agg('<' || id || '>', '' ORDER BY nth) AS rest, string_agg(id, ',' ORDER BY nth) AS ids, count(*) AS n
  FROM each JOIN known USING (sentence) GROUP BY row_id),
found AS (SELECT doc_id, coalesce(rest, '') AS rest, coalesce(ids, '') AS ids, coalesce(n, 0) AS n FROM cut LEFT JOIN hits USING (row_id)),
{", ".join(steps)}
SELECT doc_id, ids AS sentence_ids, concat_ws(',', {hits}) AS rules, concat_ws(',', {columns}) AS licenses,
  cast(length(rest) - length(replace(rest, '<', '')) AS bigint) AS n_unruled, cast(n AS bigint) AS n_sentences
FROM {last}"""
