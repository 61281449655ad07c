"""Operator 10: licence scan by the Dice coefficient over word bigrams, in DataFrame functions.

A text, its paragraphs (between blank lines), runs of up to ``RUN`` neighbouring paragraphs, its
lines, sentences and clauses are normalised to lower-case words of letters and digits; the set of
word bigrams of each is compared with those of the licence templates: phrases, notices, the whole
short licences with and without their titles, and of the long ones the paragraphs that no other
licence has. Two bounds prune exactly. Size: with a and b bigrams the coefficient is at most
2 * min(a, b) / (a + b). Words: each template has a few telling words so placed that a
passage without any of them cannot share enough bigrams. No row is shuffled.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, functions as F

LIMIT = 0.8  # least coefficient of a match
RUN = 6      # neighbouring paragraphs that are compared together, at most
PARAGRAPH = "\\n[ \\t\\r]*\\n"
SENTENCE = "[.!?]+[ \\t\\r\\n]+"
PART = "[.!?]+[ \\t\\r\\n]+|[ \\t\\r\\n]+(?:and|but|or|which)[ \\t\\r\\n]+"
CLAUSE = PART + "|[,;:()]+"

# Names of licences, phrases that refer to them, and published notices.
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "Apache-2.0": ["Apache License, Version 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International License", "CC BY 4.0"],
    "CC-BY-NC-4.0": [
        "Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0"],
    "CC-BY-SA-4.0": [
        "Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0"],
    "CC0-1.0": ["CC0 1.0 Universal Public Domain Dedication"],
    "GPL-2.0": ["GNU General Public License, version 2"],
    "GPL-3.0": ["GNU General Public License, version 3"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0"],
    "Unlicense": ["The Unlicense"],
}
PHRASES = [
    "Released under {}.", "Licensed under {}.", "Distributed under {}.",
    "This work is licensed under {}.", "This project is licensed under {}.",
    "This software is licensed under {}.", "This file is licensed under {}.",
    "is released under {}.", "is licensed under {}.", "is distributed under {}.", "is available under {}.",
]
PLAIN_WORDS = set(
    "a an and any any as at be by code copies for free from if in is may must not notice of or"
    " permitted person provided subject that the this to under with without you your work file"
    " project use copy following".split())
NOTICES = {
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file'
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed"
        ' to in writing, software distributed under the License is distributed on an "AS IS" BASIS,'
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License"
        " for the specific language governing permissions and limitations under the License."],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: 1. Redistributions of source"
        " code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution."],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version."],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation; either"
        " version 2 of the License, or (at your option) any later version."],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies."],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        ' software and associated documentation files (the "Software"), to deal in the Software'
        " without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons"
        " to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the Software."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
        " copy of the MPL was not distributed with this file, You can obtain one at"
        " https://mozilla.org/MPL/2.0/."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to"
        " copy, modify, publish, use, compile, sell, or distribute this software, either in source"
        " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by"
        " any means."],
}


AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED'
    " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A"
    " PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR"
    " ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT"
    " LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS"
    " INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR"
    " TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF"
    " ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
REDISTRIBUTION = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
    " the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the"
    " following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the"
    " following disclaimer in the documentation and/or other materials provided with the distribution."]
#: The short licences as a whole: title and paragraphs.
WHOLE = {
    "BSD-2-Clause": ("BSD 2-Clause License", [*REDISTRIBUTION, AS_IS]),
    "BSD-3-Clause": ("BSD 3-Clause License", [
        *REDISTRIBUTION, "3. Neither the name of the copyright holder nor the names of its contributors may be used"
        " to endorse or promote products derived from this software without specific prior written permission.", AS_IS]),
    "ISC": ("ISC License", [
        NOTICES["ISC"][0],
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE'
        " INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR"
        " ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF"
        " USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF"
        " OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."]),
    "MIT": ("MIT License", [
        NOTICES["MIT"][0].partition(" The above copyright")[0],
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions"
        " of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED'
        " TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL"
        " THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF"
        " CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
        " DEALINGS IN THE SOFTWARE."]),
    "Unlicense": ("The Unlicense", [
        "This is free and unencumbered software released into the public domain.",
        NOTICES["Unlicense"][0].partition("public domain. ")[2],
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all"
        " copyright interest in the software to the public domain. We make this dedication for the benefit of the public"
        " at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of"
        " relinquishment in perpetuity of all present and future rights to this software under copyright law.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED'
        " TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL"
        " THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
        " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE"
        " SOFTWARE.",
        "For more information, please refer to <https://unlicense.org>"]),
}
#: Paragraphs of the long licences that stand in no other one.
OWN_PARAGRAPHS = {
    "AGPL-3.0": [
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works,"
        " specifically designed to ensure cooperation with the community in the case of network server software.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at"
        " your option) any later version."],
    "Apache-2.0": [
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE,"
        " REPRODUCTION, AND DISTRIBUTION",
        "2. Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby"
        " grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to"
        " reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work"
        " and such Derivative Works in Source or Object form."],
    "CC-BY-4.0": [
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions"
        ' of this Creative Commons Attribution 4.0 International Public License ("Public License").'],
    "CC-BY-NC-4.0": [
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions"
        ' of this Creative Commons Attribution-NonCommercial 4.0 International Public License ("Public License").'],
    "CC-BY-SA-4.0": [
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions"
        ' of this Creative Commons Attribution-ShareAlike 4.0 International Public License ("Public License").'],
    "CC0-1.0": [
        "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights"
        ' (defined below) upon the creator and subsequent owner(s) (each and all, an "owner") of an original work of'
        ' authorship and/or a database (each, a "Work").'],
    "GPL-2.0": [
        "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the"
        " GNU General Public License is intended to guarantee your freedom to share and change free software--to make"
        " sure the software is free for all its users."],
    "GPL-3.0": ["The GNU General Public License is a free, copyleft license for software and other kinds of works."],
    "LGPL-2.1": [
        "This license, the Lesser General Public License, applies to some specially designated software"
        " packages--typically libraries--of the Free Software Foundation and other authors who decide to use it.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at"
        " your option) any later version."],
    "LGPL-3.0": [
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the"
        " GNU General Public License, supplemented by the additional permissions listed below.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 3 of the License, or (at"
        " your option) any later version."],
    "MPL-2.0": [
        'This Source Code Form is "Incompatible With Secondary Licenses", as defined by the Mozilla Public License,'
        " v. 2.0."],
}


def words_of(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def bigrams_of(text: str) -> list[str]:
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def templates() -> list[tuple[str, list[str]]]:
    """(licence, its distinct bigrams), one per phrase, identifier line, notice, own paragraph and
    whole text."""
    out = []
    for licence, names in NAMES.items():
        named = [x for n in names for x in (n, f"the {n}")]
        texts = [p.format(n) for n in named for p in PHRASES] + [f"SPDX-License-Identifier: {licence}"]
        texts += NOTICES.get(licence, []) + OWN_PARAGRAPHS.get(licence, [])
        if licence in WHOLE:
            title, paragraphs = WHOLE[licence]
            texts += [" ".join(paragraphs), " ".join([title, *paragraphs])]
        out += [(licence, bigrams_of(t)) for t in texts]
    return out


def telling_words(bigrams: list[str], limit: float = LIMIT) -> set[str]:
    """Words one of which a passage must hold to reach ``limit`` against this template.

    A match shares at least limit * b / (2 - limit) of the b bigrams. Words are taken, plain
    ones last, the longest of those that cover most first, until fewer bigrams than that are
    free of them.
    """
    need, chosen, free = math.ceil(limit * len(bigrams) / (2 - limit) - 1e-9), set(), list(bigrams)
    while len(free) >= need:
        words = {w for b in free for w in b.split(" ")}
        best = max(sorted(words), key=lambda w: (
            w not in PLAIN_WORDS and len(w) > 1, sum(w in b.split(" ") for b in free) * min(len(w), 8)))
        chosen.add(best)
        free = [b for b in free if best not in b.split(" ")]
    return chosen


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def matches(text: Column, lowered: Column, limit: float = LIMIT) -> Column:
    """array<struct<passage int, licence string, n int, dice double>>: the templates, of n bigrams, that each passage
    of the text reaches; empty for a null or blank text. Passages are numbered: 0 the whole
    text, then paragraphs, lines, sentences, clauses and runs of paragraphs, without those whose
    words repeat an earlier one. ``lowered`` is
    the text in lower case, as a column that is computed once."""
    known = templates()
    asked = sorted(set().union(*(telling_words(b, limit) for _, b in known)))
    least = min(len(b) for _, b in known) * limit / (2 - limit)
    most = max(len(b) for _, b in known) * (2 - limit) / limit
    table = F.from_json(
        F.lit(json.dumps([{"licence": n, "n": len(b), "bigrams": b} for n, b in known])),
        "array<struct<licence string, n int, bigrams array<string>>>")
    some = F.lit(False)
    for word in asked:
        some = some | F.contains(lowered, F.lit(word))
    paragraphs = F.split(text, PARAGRAPH)
    runs = F.flatten(F.transform(F.array(*[F.lit(r) for r in range(2, RUN + 1)]), lambda r: F.transform(
        F.when(F.size(paragraphs) >= r, F.sequence(F.lit(1), F.size(paragraphs) - r + 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.array_join(F.slice(paragraphs, i, r), "\n\n"))))
    passages = F.array_distinct(F.transform(F.concat(
        F.array(text), paragraphs, F.split(text, "\\n"), F.split(text, SENTENCE), F.split(text, PART),
        F.split(text, CLAUSE), runs), normal))
    numbered = F.transform(passages, lambda p, i: F.struct(i.alias("i"), F.split(p, " ").alias("w")))
    likely = F.filter(numbered, lambda p: (F.size(p["w"]) >= math.floor(least) + 1)
                      & F.arrays_overlap(p["w"], F.array(*[F.lit(w) for w in asked])))
    sets = F.transform(likely, lambda p: F.struct(p["i"].alias("i"), F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(p["w"]) - 2, F.lit(0))),
        lambda k: F.concat_ws(" ", F.get(p["w"], k), F.get(p["w"], k + 1)))).alias("b")))
    sets = F.filter(sets, lambda p: F.size(p["b"]).between(math.ceil(least - 1e-9), math.floor(most + 1e-9)))

    def against(p):
        close = F.filter(table, lambda t: 2 * F.least(F.size(p["b"]), t["n"]) >= limit * (F.size(p["b"]) + t["n"]))
        found = F.transform(close, lambda t: F.struct(
            p["i"].alias("passage"), t["licence"].alias("licence"), t["n"].alias("n"),
            (2 * F.size(F.array_intersect(p["b"], t["bigrams"])) / (F.size(p["b"]) + t["n"])).alias("dice")))
        return F.filter(found, lambda f: f["dice"] >= limit)

    return F.when(some, F.flatten(F.transform(sets, against))).otherwise(
        F.array().cast("array<struct<passage int, licence string, n int, dice double>>"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, licence, dice, n_passages, licences: one row per row of ``docs``.

    ``licence`` is the best match (ties: the longer template, then the first by name), null if there is none; ``dice`` its
    coefficient, 0 if none; ``n_passages`` the passages with a match; ``licences`` all matched
    names, sorted and comma-joined. Null texts match nothing; other columns play no part.
    """
    found = docs.select("doc_id", "text", F.lower("text").alias("low")).select(
        "doc_id", matches(F.col("text"), F.col("low")).alias("m"))
    best = F.get(F.array_sort(F.transform("m", lambda f: F.struct(
        (-f["dice"]).alias("worse"), (-f["n"]).alias("size"), f["licence"].alias("licence")))), F.lit(0))
    return found.select(
        "doc_id", best["licence"].alias("licence"),
        F.coalesce(-best["worse"], F.lit(0.0)).alias("dice"),
        F.size(F.array_distinct(F.transform("m", lambda f: f["passage"]))).cast("long").alias("n_passages"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("m", lambda f: f["licence"]))), ",").alias("licences"))
