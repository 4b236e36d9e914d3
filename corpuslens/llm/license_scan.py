"""Licence scanning: normalised text against templates by Dice's coefficient over bigrams.

A unit is normalised to lower-case words and taken as its set of word bigrams A; against a
template's set B its score is 2 |A and B| / (|A| + |B|). The units of a text are its lines,
the whole text, and runs: windows over all its words, across line ends, as long as a
template and placed so that one of the template's anchors in the text lies where it lies
in the template. So a notice is found when it is wrapped, in a comment, or inside a longer
paragraph. Two bounds prune, and neither loses a match at the threshold t:

* Size: a score of t needs t/(2-t) |B| <= |A| <= (2-t)/t |B|.
* Anchors: then A has at least t/(2-t) |B| bigrams of B, so it misses at most the others,
  and one of any |B| - ceil(t/(2-t) |B|) + 1 bigrams of B is in A. For each template a few
  words are chosen that so many of its bigrams hold; a unit with none of them can't match.

Near-equal licences match in the same place, so the runs are folded once in order of their
begin: of those that overlap the best one is left, of equal scores that of the longer
template. A line that is only part of a longer notice found in the text (BSD's first
sentence) gives no name of its own.

All of it is built-in expressions over one row; only rows with an anchor are normalised,
only lines with one get as far as bigrams, and runs are only where one is. No shuffle.
Long licences are known by a few of their paragraphs, openings and others.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: Notices, short licences and openings of long ones, as their publishers give
#: them. What is before a slash is the licence's name.
TEMPLATES = {
    "agpl-3.0/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-3.0/opening": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0/grant": "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    "apache-2.0/header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "apache-2.0/notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-2.0/opening": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. \"Licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.",
    "artistic-2.0/opening": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble This license establishes the terms under which a given free software Package may be copied, modified, distributed, and/or redistributed.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-3-clause/clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-3-clause/full": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsl-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-4.0/notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-4.0/opening": "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution 4.0 International Public License (\"Public License\").",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-4.0/notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-sa-4.0/notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law.",
    "gpl-2.0/ending": "This General Public License does not permit incorporating your program into proprietary programs. If your program is a subroutine library, you may consider it more useful to permit linking proprietary applications with the library. If this is what you want to do, use the GNU Lesser General Public License instead of this License.",
    "gpl-2.0/header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-2.0/opening": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble The licenses for most software are designed to take away your freedom to share and change it.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0/ending": "The GNU General Public License does not permit incorporating your program into proprietary programs. If your program is a subroutine library, you may consider it more useful to permit linking proprietary applications with the library. If this is what you want to do, use the GNU Lesser General Public License instead of this License. But first, please read",
    "gpl-3.0/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-3.0/opening": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "lgpl-2.1/header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-2.1/opening": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc. 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. This is the first released version of the Lesser GPL. It also counts as the successor of the GNU Library Public License, version 2, hence the version number 2.1. Preamble The licenses for most software are designed to take away your freedom to share and change it.",
    "lgpl-3.0/opening": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below.",
    "mit": "Released under the MIT License.",
    "mit/full": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit/permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "mpl-1.1/header": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-2.0/notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "mpl-2.0/opening": "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software. 1.2. \"Contributor Version\" means the combination of the Contributions of others (if any) used by a Contributor and that particular Contributor's Contribution.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}


def normal_words(text: str) -> list[str]:
    return "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in text).split()


def bigrams(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """The sizes of a set that can reach the threshold with one of ``size``."""
    return math.ceil(threshold / (2 - threshold) * size - 1e-9), math.floor((2 - threshold) / threshold * size + 1e-9)


def anchors(text: str, threshold: float) -> list[str]:
    """Words and bigrams such that a unit without any of them can't reach the threshold.

    Words of five letters or more first, the longest ones first, then the longest bigrams.
    """
    left = bigrams(normal_words(text))
    need = len(left) - size_bounds(len(left), threshold)[0] + 1
    chosen: list[str] = []
    words = sorted({w for b in left for w in b.split() if len(w) > 4}, key=lambda w: (-len(w), w))
    for anchor in [*words, *sorted(left, key=lambda b: (-len(b), b))]:
        held = [b for b in left if anchor in (b, *b.split())]
        if need > 0 and held:
            chosen.append(anchor)
            need -= len(held)
            left = [b for b in left if b not in held]
    return chosen


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def template_rows(templates: dict[str, str], threshold: float) -> list[tuple[str, list[str], int, int, list[str]]]:
    out = []
    for name, text in sorted(templates.items()):
        if pairs := bigrams(normal_words(text)):
            out.append((name, pairs, *size_bounds(len(pairs), threshold), anchors(text, threshold)))
    return out


def anchor_places(templates: dict[str, str], threshold: float) -> list[tuple[str, int, int]]:
    """(anchor, number of the template among ``template_rows``, its first place there in words)."""
    out = []
    for k, (name, *_, found) in enumerate(template_rows(templates, threshold)):
        words = normal_words(templates[name])
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
        out += [(a, k, pairs.index(a) if " " in a else words.index(a)) for a in found]
    return out


def parts_of(templates: dict[str, str]) -> list[tuple[str, str]]:
    """Pairs of a template and a longer one that has nine tenths of its bigrams, of different licences."""
    sets = {k: set(bigrams(normal_words(t))) for k, t in templates.items()}
    return [(a, b) for a in sorted(sets) for b in sorted(sets) if sets[a] and a.split("/")[0] != b.split("/")[0] and len(sets[b]) > len(sets[a]) and 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a])]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, license, score, n_units, licenses.

    The units of a text are its lines, the whole text if it has several, and the runs at
    anchors. A unit has its best template; runs at or above ``threshold`` are gone through
    by their begin (then name), and one that overlaps the last kept one takes its place if
    it is better. n_units counts the lines (and the whole text) that reach ``threshold``,
    licenses has the names of the licences of these and of the kept runs (sorted,
    comma-joined), without lines that are a part of a longer template among the kept runs;
    license and score are the best of all. Of equal scores the longer template is better,
    then the first by name. A text without a match, null and empty ones too, has a null license, score 0.0,
    no units and empty licenses. Repeated rows give repeated results; an empty table gives
    no rows; other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    rows = template_rows(templates, threshold)
    places = anchor_places(templates, threshold)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    found = {a for a, _, _ in places}
    words = sorted(w for w in found if not any(o != w and o in w for o in found))
    anchor = " or ".join(f"contains(u, {_sql(w)})" for w in words) or "false"
    pairs = "|".join(w.replace(" ", "[^a-z0-9]+") for w in words if " " in w)
    some_anchor = " or ".join([*(f"contains(v, {_sql(w)})" for w in words if " " not in w), *([f"v rlike '{pairs}'"] if pairs else [])]) or "false"
    low = "lower(regexp_replace(t, '[^A-Za-z0-9\n]+', ' '))"
    units = f"filter(if(instr(n, '\n') > 0, concat(split(n, '\n'), array(replace(n, '\n', ' '))), array(n)), u -> {anchor})"
    bigram_set = "if(size(w) < 2, cast(array() as array<string>), array_distinct(transform(sequence(1, size(w) - 1), i -> concat(w[i - 1], ' ', w[i]))))"
    sets = f"transform(x, u -> transform(array(filter(split(u, ' '), w -> w <> '')), w -> {bigram_set})[0])"
    entries = [f"named_struct('name', {_sql(n)}, 'b', array({', '.join(map(_sql, b))}), 'lo', {lo}, 'hi', {hi}, 'n', {len(normal_words(templates[n]))})" for n, b, lo, hi, _ in rows]
    table = f"array({', '.join(entries)})" if rows else "cast(array() as array<struct<name:string,b:array<string>,lo:int,hi:int,n:int>>)"
    dice = "2D * size(array_intersect(a, m.b)) / (size(a) + size(m.b))"
    scores = f"transform(filter({table}, m -> size(a) between m.lo and m.hi), m -> named_struct('score', {dice}, 'n', m.n, 'name', m.name))"
    better = lambda x, y: f"({y}.score > {x}.score or ({y}.score = {x}.score and ({y}.n > {x}.n or ({y}.n = {x}.n and {y}.name < {x}.name))))"
    none = "named_struct('score', 0D, 'n', 0, 'name', cast(null as string))"
    best = f"aggregate({scores}, {none}, (s, c) -> if({better('s', 'c')}, c, s))"
    marked = own.select("doc_id", "t", F.lower("t").alias("v")).select("doc_id", "t", F.expr(some_anchor).alias("some"))
    some = marked.select(
        "doc_id",
        F.expr(f"if(some, transform(array({low}), n -> {units})[0], cast(array() as array<string>))").alias("x"),
        F.expr(f"if(some, filter(split(replace({low}, '\n', ' '), ' '), y -> y <> ''), cast(array() as array<string>))").alias("words"),
    )
    singles, doubles = sorted(a for a in found if " " not in a), sorted(a for a in found if " " in a)
    is_anchor = " or ".join([*([f"h.w in ({', '.join(map(_sql, singles))})"] if singles else []), *([f"h.b in ({', '.join(map(_sql, doubles))})"] if doubles else [])]) or "false"
    hits = f"filter(transform(words, (y, i) -> named_struct('w', y, 'b', concat(y, ' ', get(words, i + 1)), 'i', i)), h -> {is_anchor})"
    at = f"array({', '.join(f"named_struct('a', {_sql(a)}, 't', {k}, 'o', {o})" for a, k, o in places)})" if places else "cast(array() as array<struct<a:string,t:int,o:int>>)"
    kinds = max(len(rows), 1)  # a window is one number, so that repeated ones are found by hash
    windows = f"array_distinct(flatten(transform({hits}, h -> transform(filter({at}, p -> p.a = h.w or p.a = h.b), p -> greatest(0, h.i - p.o) * {kinds}L + p.t))))"
    run = f"transform(array({table}[cast(p % {kinds} as int)]), m -> transform(array(transform(array(slice(words, cast(p div {kinds} as int) + 1, m.n)), w -> {bigram_set})[0]), a -> named_struct('s', cast(p div {kinds} as int), 'name', m.name, 'score', {dice}, 'n', m.n))[0])[0]"
    runs = f"array_sort(filter(transform({windows}, p -> {run}), r -> r.score >= {threshold}D))" if rows else "cast(array() as array<struct<s:int,name:string,score:double,n:int>>)"
    scored = some.select("doc_id", F.expr(f"filter(transform({sets}, a -> {best}), s -> s.score >= {threshold}D)").alias("hits"), F.expr(runs).alias("runs"))
    # the kept run so far, and the names of those before it: as many as there are templates at most
    empty = "named_struct('last', cast(null as struct<s:int,name:string,score:double,n:int>), 'names', cast(array() as array<string>))"
    done = "if(z.last is null, z.names, array_union(z.names, array(z.last.name)))"
    step = f"if(z.last is not null and r.s < z.last.s + z.last.n, if({better('z.last', 'r')}, named_struct('last', r, 'names', z.names), z), named_struct('last', r, 'names', {done}))"
    kept = f"aggregate(runs, {empty}, (z, r) -> {step}, z -> {done})"
    every = scored.select("doc_id", F.expr("size(hits)").cast("long").alias("n_units"), "hits", F.expr(kept).alias("kept"), F.expr("concat(hits, transform(runs, r -> named_struct('score', r.score, 'n', r.n, 'name', r.name)))").alias("every"))
    top = f"aggregate(every, {none}, (s, c) -> if({better('s', 'c')}, c, s))"
    hidden = " or ".join(f"(h.name = {_sql(x)} and array_contains(kept, {_sql(y)}))" for x, y in parts_of(templates)) or "false"
    names = f"array_join(array_sort(array_distinct(transform(concat(transform(filter(hits, h -> not ({hidden})), h -> h.name), kept), e -> split(e, '/')[0]))), ',')"
    out = every.select("doc_id", "n_units", F.expr(names).alias("licenses"), F.expr(top).alias("top"))
    return out.select("doc_id", F.expr("split(top.name, '/')[0]").alias("license"), F.col("top.score").alias("score"), "n_units", "licenses")


def oracle(threshold: float = THRESHOLD) -> str:
    """``scan_licenses`` with its defaults for DuckDB: every line, and every run at an anchor."""
    lit = lambda s: "'" + s.replace("'", "''") + "'"
    found = template_rows(TEMPLATES, threshold)
    rows = ", ".join(f"({k}, {lit(n)}, [{', '.join(map(lit, pairs))}], {len(normal_words(TEMPLATES[n]))})" for k, (n, pairs, *_) in enumerate(found))
    places = ", ".join(f"({lit(a)}, {k}, {o})" for a, k, o in anchor_places(TEMPLATES, threshold))
    hidden = ", ".join(f"({lit(x)}, {lit(y)})" for x, y in parts_of(TEMPLATES))
    pairs = "CASE WHEN len(w) < 2 THEN [] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END"
    return f"""
WITH RECURSIVE templates(t, name, b, n) AS (VALUES {rows}),
parts(x, y) AS (VALUES {hidden}),
anchors(a, t, o) AS (VALUES {places}),
norm AS (SELECT row_number() OVER () AS rid, doc_id, lower(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9\\n]+', ' ', 'g')) AS n FROM documents),
units AS (
  SELECT rid, unnest(string_split(n, chr(10))) AS u FROM norm
  UNION ALL SELECT rid, replace(n, chr(10), ' ') FROM norm WHERE contains(n, chr(10))
),
numbered AS (SELECT row_number() OVER () AS uid, rid, list_filter(string_split(u, ' '), lambda w: w <> '') AS w FROM units),
sets AS (SELECT uid, rid, {pairs} AS a FROM numbered),
scored AS (
  SELECT uid, rid, name, n, 2::DOUBLE * len(list_intersect(a, b)) / (len(a) + len(b)) AS score
  FROM sets, templates WHERE len(a) BETWEEN {threshold} / (2 - {threshold}) * len(b) - 1e-9 AND (2 - {threshold}) / {threshold} * len(b) + 1e-9
),
best AS (SELECT rid, name, score, n FROM scored WHERE score >= {threshold} QUALIFY row_number() OVER (PARTITION BY uid ORDER BY score DESC, n DESC, name) = 1),
spoken AS (SELECT rid, list_filter(string_split(replace(n, chr(10), ' '), ' '), lambda w: w <> '') AS w FROM norm),
placed AS (SELECT rid, i - 1 AS i, w[i] AS one, w[i] || ' ' || w[i + 1] AS two FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM spoken)),
windows AS (SELECT DISTINCT rid, greatest(0, i - o) AS s, t FROM placed JOIN anchors ON one = a UNION SELECT DISTINCT rid, greatest(0, i - o), t FROM placed JOIN anchors ON two = a),
cut AS (SELECT rid, s, n, name, b, list_slice(w, s + 1, s + n) AS w FROM windows JOIN spoken USING (rid) JOIN templates USING (t)),
runs AS (SELECT rid, s, n, name, 2::DOUBLE * len(list_intersect(a, b)) / (len(a) + len(b)) AS score FROM (SELECT rid, s, n, name, b, {pairs} AS a FROM cut)),
sorted AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY s, name) AS k FROM runs WHERE score >= {threshold}),
fold AS (
  SELECT rid, k, s, n, name, score, NULL::VARCHAR AS done FROM sorted WHERE k = 1
  UNION ALL
  SELECT f.rid, r.k, CASE WHEN takes THEN r.s ELSE f.s END, CASE WHEN takes THEN r.n ELSE f.n END, CASE WHEN takes THEN r.name ELSE f.name END, CASE WHEN takes THEN r.score ELSE f.score END, CASE WHEN r.s >= f.s + f.n THEN f.name END
  FROM fold f JOIN sorted r ON r.rid = f.rid AND r.k = f.k + 1, LATERAL (SELECT r.s >= f.s + f.n OR r.score > f.score OR (r.score = f.score AND (r.n > f.n OR (r.n = f.n AND r.name < f.name))) AS takes)
),
kept AS (SELECT rid, done AS name FROM fold WHERE done IS NOT NULL UNION SELECT rid, name FROM fold QUALIFY row_number() OVER (PARTITION BY rid ORDER BY k DESC) = 1),
named AS (SELECT rid, split_part(name, '/', 1) AS name FROM kept UNION SELECT rid, split_part(name, '/', 1) FROM best WHERE NOT EXISTS (SELECT 1 FROM parts JOIN kept ON kept.name = y AND kept.rid = best.rid WHERE x = best.name)),
every AS (SELECT rid, name, score, n, 1 AS unit FROM best UNION ALL SELECT rid, name, score, n, 0 FROM runs WHERE score >= {threshold}),
per AS (
  SELECT rid, sum(unit) AS n_units, max(score) AS score, split_part((list(name ORDER BY score DESC, n DESC, name))[1], '/', 1) AS license FROM every GROUP BY rid
)
SELECT doc_id, license, coalesce(score, 0)::DOUBLE AS score, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(licenses, '') AS licenses
FROM norm LEFT JOIN per USING (rid) LEFT JOIN (SELECT rid, string_agg(name, ',' ORDER BY name) AS licenses FROM named GROUP BY rid) USING (rid)
"""
