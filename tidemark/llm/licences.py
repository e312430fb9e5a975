"""Licence scans by sentence rules.

Texts fall into sentences: comment marks at the start of lines go, single line breaks are
white space, and a sentence ends at . ! ? ; : before white space, at a blank line and before
an item of a list.  Each is normalised (lower case, runs of other than letters and digits to
one space), and known licence sentences become their identifiers; so do sentences that say
that something is `licensed under` a licence by one of its names, and the identifiers of
SPDX lines.  A licence rule is an ordered list of identifiers; it holds where the document's
identifiers contain that list in a row.  As headings and notices often end without a mark,
single lines are looked up in the same way.  All steps are SQL expressions on the row;
nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Passages of public licence texts that tell them from others, as published.
_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal {} the Software '
    "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
    "to whom the Software is furnished to do so"
)
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_NEITHER = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_AUTHOR = "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission."
_ADVERTISING = "All advertising materials mentioning features or use of this software must display the following acknowledgement: "
_GNU = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
_GNU_ONLY = "you can redistribute it and/or modify it under the terms of the GNU {} version {} as published by the Free Software Foundation."
PASSAGES = (
    ("MIT", _GRANT.format("in") + ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT-0", _GRANT.format("in") + "."),
    ("NCSA", _GRANT.format("with") + ", subject to the following conditions:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", f"{_BSD}3. {_NEITHER}"),
    ("BSD-3-Clause", f"{_BSD}3. {_AUTHOR}"),
    ("BSD-4-Clause", f"{_BSD}3. {_ADVERTISING}"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("Apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    *((f"{code}-{version}-or-later", _GNU.format(name, mark, version.removesuffix(".0"))) for code, name, versions in (
        ("GPL", "General Public License", ("2.0", "3.0")), ("LGPL", "Lesser General Public License", ("2.1", "3.0")), ("AGPL", "Affero General Public License", ("3.0",)),
    ) for version in versions for mark in (",", ";")),
    *((f"{code}-{version}-only", _GNU_ONLY.format(name, version.removesuffix(".0"))) for code, name, version in (
        ("GPL", "General Public License", "2.0"), ("GPL", "General Public License", "3.0"), ("LGPL", "Lesser General Public License", "2.1"), ("LGPL", "Lesser General Public License", "3.0"), ("AGPL", "Affero General Public License", "3.0"),
    )),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("CDDL-1.0", 'The contents of this file are subject to the terms of the Common Development and Distribution License (the "License").'),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("BSL-1.0", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:'),
    ("WTFPL", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."),
    ("Artistic-2.0", "This license establishes the terms under which a given free software Package may be copied, modified, distributed, and/or redistributed."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("PostgreSQL", "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies."),
    ("MS-PL", "This license governs use of the accompanying software. If you use the software, you accept this license."),
    ("MulanPSL-2.0", "You can use this software according to the terms and conditions of the Mulan PSL v2."),
)
# Names of licences, in normal form, as notices give them; with and without ` license` at their end.
NAMES = {
    "MIT": ("mit", "expat"),
    "ISC": ("isc",),
    "0BSD": ("zero clause bsd", "bsd zero clause"),
    "BSD-2-Clause": ("bsd 2 clause", "2 clause bsd", "simplified bsd"),
    "BSD-3-Clause": ("bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd"),
    "Apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache 2 0", "apache license v2 0", "apache version 2 0"),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license 2 0", "mozilla public license v2 0", "mpl 2 0"),
    "EPL-2.0": ("eclipse public license 2 0", "eclipse public license v2 0", "eclipse public license version 2 0", "epl 2 0"),
    "BSL-1.0": ("boost software license version 1 0", "boost software license 1 0", "boost software license"),
    "EUPL-1.2": ("eupl version 1 2", "eupl 1 2", "european union public licence version 1 2"),
    "OFL-1.1": ("sil open font license version 1 1", "sil open font license 1 1"),
    "Zlib": ("zlib", "zlib libpng"),
    "Unlicense": ("unlicense",),
    "CC0-1.0": ("cc0 1 0", "cc0", "cc0 1 0 universal", "creative commons zero v1 0 universal"),
    "WTFPL": ("wtfpl", "do what the fuck you want to public"),
    "Artistic-2.0": ("artistic license 2 0", "artistic 2 0"),
    "PostgreSQL": ("postgresql",),
}
# The parts of Creative Commons names, and of the names of the GNU family.
_CREATIVE = {"by": ("attribution",), "nc": ("noncommercial", "non commercial"), "sa": ("sharealike", "share alike"), "nd": ("noderivatives", "no derivatives", "noderivs")}
_GNU_NAMES = {"GPL": "general public license", "LGPL": "lesser general public license", "AGPL": "affero general public license"}
_UNDER = r"(?:licensed|released|distributed|available|published|provided|redistributed)(?: to you)? under"
NOTICE = rf"^(?:.* )?{_UNDER} (?:(?:the|a) )?(?:terms(?: and conditions)? of )?(?:(?:the|a|version 2 0 of the) )?(.*?)(?: the license)?$"
DENIED = rf"(?:^| )not (?:be )?{_UNDER}"
#: Each unit that is looked up holds one of these, so that a text without any of them holds none.
ANCHORS = ("licen", "permission", "redistribut", "warranty", "mozilla", "public domain", "mulan")
#: The least number of words of a known sentence.
LEAST_WORDS = 4
SPDX = r"(?i:spdx-license-identifier):[ \t]*([^\r\n]*)"
SPDX_BREAK = r"[ \t]+(?:AND|OR|WITH)[ \t]+|[()]|[ \t]*(?:\*/|-->)"
# Replacements, in order, of the lower-cased text after a line break; then breaks of sentences and of lines.
STEPS = (
    ("\\r", ""),
    (r"\n[ \t]*(?:/\*+|\*+/|\*+|//+|#+|--+|;+|%+|<!--|>+|\|)[ \t]*", "\n"),
    (r"\n[ \t]*(?:\(?(?:[0-9]{1,2}|[a-z]|[ivx]{2,4})[.)]|-|•)[ \t]+", "\n\n"),
    (r"https?://(?:www\.)?", ""),
    # The name of a holder, dots in it included.
    (r"neither[ \t\n]+the[ \t\n]+names?[ \t\n]+of[^!?;:]{1,400}?[ \t\n]nor[ \t\n]+(?:the[ \t\n]+)?names?[ \t\n]+of[ \t\n]+(?:its|any|their|the)[ \t\n]+contributors", "neither the name of the copyright holder nor the names of its contributors"),
    (r"[.!?;:]+([ \t\n]|$)", "\n\n{1}"),
)
SENTENCE_BREAK, LINE_BREAK = r"\n[ \t]*\n[ \t\n]*", r"\n[ \t\n]*"
OTHER = "[^a-z0-9]+"


def plain_units(text: str, lines: bool = False) -> list[str]:
    """The normalised sentences (or lines) of a text, as sentence_ids makes them."""
    text = "\n" + text.lower()
    for pattern, by in STEPS:
        text = re.sub(pattern, by.replace("{1}", r"\1"), text)
    units = (re.sub(OTHER, " ", s).strip(" ") for s in re.split(LINE_BREAK if lines else SENTENCE_BREAK, text))
    return [u for u in units if u]


def _rules() -> tuple[dict[str, str], list[tuple[str, tuple[str, ...]]]]:
    """Identifiers by known sentence, and (licence, identifiers) in order."""
    known, rules = {}, []
    for licence, passage in PASSAGES:
        units = [u for u in plain_units(passage) if len(u.split()) >= LEAST_WORDS]
        for u in units:
            known.setdefault(u, f"{licence}#{sum(k.startswith(f'{licence}#') for k in known.values()) + 1}")
        rules.append((licence, tuple(known[u] for u in units)))
    return known, rules


SENTENCES, RULES = _rules()


def licence_names() -> dict[str, str]:
    """The licence by each of its names in notices, in normal form."""
    names = {n: licence for licence, all_ in NAMES.items() for n in all_}
    for code, name in _GNU_NAMES.items():
        for version in ("2.0", "2.1", "3.0"):
            v = version.removesuffix(".0").replace(".", " ")
            for shape in (f"gnu {name} version {v}", f"gnu {name} v{v}", f"gnu {name} v{v} 0", f"{code.lower()} v{v}", f"{code.lower()}v{v}", f"gnu {code.lower()} version {v}", f"{name} version {v}", f"{code.lower()} version {v}"):
                names.setdefault(shape, f"{code}-{version}-only")
                names.setdefault(f"{shape} or later", f"{code}-{version}-or-later")
                names.setdefault(f"{shape} or any later version", f"{code}-{version}-or-later")
    for parts in (("by",), ("by", "sa"), ("by", "nc"), ("by", "nd"), ("by", "nc", "sa"), ("by", "nc", "nd")):
        spelled = [""]
        for part in parts:
            spelled = [f"{s} {x}" for s in spelled for x in _CREATIVE[part]]
        for version in ("3.0", "4.0"):
            v, licence = version.replace(".", " "), f"CC-{'-'.join(parts).upper()}-{version}"
            names[f"cc {' '.join(parts)} {v}"] = licence
            for s in spelled:
                for tail in ("international", "unported", ""):
                    names[f"creative commons{s} {v} {tail}".strip()] = licence
    return names | {f"{n} {word}": licence for n, licence in names.items() for word in ("license", "licence")}


def spdx_identifiers() -> dict[str, str]:
    """The licence by its SPDX identifier in lower case, the GNU family's old ones included."""
    found = {x.lower(): x for x in {*(licence for licence, _ in RULES), *licence_names().values()}}
    for x in list(found.values()):
        if x.endswith("-only"):
            found[x.removesuffix("-only").lower()] = x
        if x.endswith("-or-later"):
            found[x.removesuffix("-or-later").lower() + "+"] = x
    return found


def _map(entries: dict[str, str]) -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, entries)), F.array(*map(F.lit, entries.values())))


def _units(text: Column) -> tuple[Column, Column]:
    """The normalised sentences and lines of a text."""
    text = F.concat(F.lit("\n"), F.lower(text))
    for pattern, by in STEPS:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(by.replace("{1}", "$1")))
    normal = lambda break_: F.filter(F.transform(F.split(text, break_), lambda s: F.trim(F.regexp_replace(s, OTHER, " "))), lambda s: s != "")
    return normal(SENTENCE_BREAK), normal(LINE_BREAK)


def _identified(units: Column) -> Column:
    """The identifiers of the units that have one, in order."""
    known, names = _map(SENTENCES), _map(licence_names())
    noticed = lambda u: F.when(F.contains(u, F.lit(" under ")) & ~F.rlike(u, F.lit(DENIED)), F.concat(F.element_at(names, F.regexp_extract(u, NOTICE, 1)), F.lit("#notice")))
    return F.array_compact(F.transform(units, lambda u: F.coalesce(F.element_at(known, u), noticed(u))))


def _spdx(text: Column) -> Column:
    """Identifiers for the licences of SPDX lines, in order."""
    parts = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(SPDX), F.lit(1)), lambda s: F.split(s, SPDX_BREAK)))
    return F.array_compact(F.transform(parts, lambda s: F.concat(F.element_at(_map(spdx_identifiers()), F.lower(F.trim(s))), F.lit("#spdx"))))


def sentence_ids(text: Column) -> Column:
    """A struct of identifiers in order: of sentences, of lines and of SPDX lines; empty for a null text."""
    none = F.array().cast("array<string>")
    lower = F.lower(text)
    hinted = F.lit(False)
    for anchor in ANCHORS:
        hinted = hinted | F.contains(lower, F.lit(anchor))
    found = [*map(_identified, _units(text)), _spdx(text)]
    return F.struct(*[F.coalesce(F.when(hinted, c), none).alias(n) for n, c in zip(("sentences", "lines", "spdx"), found, strict=True)])


def _longer(rule: tuple[str, ...]) -> list[tuple[str, ...]]:
    """The rules that contain a rule, in a row."""
    chain = lambda x: f";{';'.join(x)};"
    return [other for _, other in RULES if len(other) > len(rule) and chain(rule) in chain(other)]


def licence_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_sentences (known ones), sentence_ids and licences (both joined by `;`, licences sorted and once each).

    Identifiers are those of sentences in order, then those of lines and of SPDX lines that
    are not among them.  A rule that holds only as part of a longer one that holds too is
    not reported.  A null or empty text holds none.  Rows of null or repeated ids and repeated
    rows are rows like any other; other columns are not read.  Texts of any length are
    scanned whole.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), sentence_ids(F.col(text_column)).alias("_f"))
    found = F.concat(F.col("_f.sentences"), F.array_except(F.concat("_f.lines", "_f.spdx"), F.col("_f.sentences")))
    chain = lambda ids: F.concat(F.lit(";"), F.array_join(ids, ";"), F.lit(";"))
    rows = rows.select("doc_id", found.alias("_ids"), F.concat(chain(F.col("_f.sentences")), chain(F.col("_f.lines"))).alias("_chain"))
    holds = lambda rule: F.contains("_chain", F.lit(f";{';'.join(rule)};"))
    by_rule = []
    for licence, rule in RULES:
        held = holds(rule)
        for other in _longer(rule):
            held = held & ~holds(other)
        by_rule.append(F.when(held, F.lit(licence)))
    named = F.transform(F.filter("_ids", lambda x: F.endswith(x, F.lit("#notice")) | F.endswith(x, F.lit("#spdx"))), lambda x: F.split_part(x, F.lit("#"), F.lit(1)))
    licences = F.concat(F.array_compact(F.array(*by_rule)), named)
    return rows.select(
        "doc_id",
        F.size("_ids").cast("long").alias("n_sentences"),
        F.array_join("_ids", ";").alias("sentence_ids"),
        F.array_join(F.array_sort(F.array_distinct(licences)), ";").alias("licences"),
    )


def licence_sql() -> str:
    """licence_scan as SQL for DuckDB, with joins to tables of sentences and names in place of maps."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    values = lambda entries: ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in entries.items())
    text = "chr(10) || lower(text)"
    for pattern, by in STEPS:
        shown = by.replace("{1}", r"\1").replace("\n", "' || chr(10) || '")
        text = f"regexp_replace({text}, {quoted(pattern)}, '{shown}', 'g')"
    conditions = []
    for licence, rule in RULES:
        held = [f"contains(chain, {quoted(';' + ';'.join(rule) + ';')})"] + [f"NOT contains(chain, {quoted(';' + ';'.join(o) + ';')})" for o in _longer(rule)]
        conditions.append(f"CASE WHEN {' AND '.join(held)} THEN {quoted(licence)} END")
    return f"""
WITH known(unit, id) AS (VALUES {values(SENTENCES)}),
names(name, licence) AS (VALUES {values(licence_names())}),
spdx(code, licence) AS (VALUES {values(spdx_identifiers())}),
docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
steps AS (SELECT r, {text} AS s FROM docs WHERE text IS NOT NULL),
pieces AS (
  SELECT r, 'sentences' AS kind, unnest(range(len(p))) AS i, unnest(p) AS raw FROM (SELECT r, string_split_regex(s, {quoted(SENTENCE_BREAK)}) AS p FROM steps)
  UNION ALL SELECT r, 'lines', unnest(range(len(p))), unnest(p) FROM (SELECT r, string_split_regex(s, {quoted(LINE_BREAK)}) AS p FROM steps)
),
units AS (SELECT r, kind, i, trim(regexp_replace(raw, {quoted(OTHER)}, ' ', 'g')) AS unit FROM pieces),
found AS (
  SELECT r, kind, i, id FROM units JOIN known USING (unit)
  UNION ALL
  SELECT r, kind, i, licence || '#notice' FROM units JOIN names ON regexp_extract(unit, {quoted(NOTICE)}, 1) = name
  WHERE contains(unit, ' under ') AND NOT regexp_matches(unit, {quoted(DENIED)}) AND unit NOT IN (SELECT unit FROM known)
),
spdx_lines AS (SELECT r, unnest(regexp_extract_all(text, {quoted(SPDX)}, 1)) AS line FROM docs),
spdx_parts AS (SELECT r, unnest(string_split_regex(line, {quoted(SPDX_BREAK)})) AS part FROM spdx_lines),
spdx_found AS (SELECT r, list(licence || '#spdx') AS ids FROM spdx_parts JOIN spdx ON lower(trim(part)) = code GROUP BY r),
lists AS (
  SELECT r, coalesce(list(id ORDER BY i) FILTER (WHERE kind = 'sentences'), []) AS sentences, coalesce(list(id ORDER BY i) FILTER (WHERE kind = 'lines'), []) AS lines FROM found GROUP BY r
),
all_ AS (
  SELECT doc_id, coalesce(sentences, []) AS sentences, coalesce(lines, []) AS lines, coalesce(ids, []) AS more
  FROM docs LEFT JOIN lists USING (r) LEFT JOIN spdx_found USING (r)
),
rows_ AS (
  SELECT doc_id, list_concat(sentences, (SELECT coalesce(list(x ORDER BY k), []) FROM (
      SELECT x, min(k) AS k FROM (SELECT unnest(list_concat(lines, more)) AS x, unnest(range(len(lines) + len(more))) AS k) GROUP BY x HAVING NOT list_contains(sentences, x)))) AS ids,
    ';' || array_to_string(sentences, ';') || ';;' || array_to_string(lines, ';') || ';' AS chain
  FROM all_
)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, array_to_string(ids, ';') AS sentence_ids,
  array_to_string(list_sort(list_distinct(list_concat(list_filter([{', '.join(conditions)}], lambda x: x IS NOT NULL),
    list_transform(list_filter(ids, lambda x: ends_with(x, '#notice') OR ends_with(x, '#spdx')), lambda x: split_part(x, '#', 1))))), ';') AS licences
FROM rows_
"""
