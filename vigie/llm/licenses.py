"""Licence scan by word bigrams.

Every line of a text, and the text as a whole, is normalised to lower-case words and compared with
licence templates by the Dice coefficient of their sets of word bigrams. Two sets can only be that
similar if their sizes are close, so sizes decide which templates a line is compared with at all.
Everything is column expressions on the row of the line.

Notices that are wrapped, or stand inside a longer line, are windows of consecutive words of the
whole text. A window is alike if twice its shared bigrams less ``alike`` times all its bigrams come
to ``alike`` times those of the template, so the windows with the largest surplus are found in one
pass over the places of a template's bigrams, and then compared by their sets.
"""

from __future__ import annotations

import functools
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie.llm import common

ALIKE = 0.8

#: Licence notices and the names of their licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
)

#: Whole clauses and the heads of licence files, which are looked for in windows only.
CLAUSES = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
    rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
    persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
    this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
    "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
    MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
    HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
    ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
    rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
    persons to whom the Software is furnished to do so, subject to the following conditions:"""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
    granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
    granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
    PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
    MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
    DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
    NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
    that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
    list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
    notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
    the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
    or promote products derived from this software without specific prior written permission."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
    compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
    required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
    BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
    language governing permissions and limitations under the License."""),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
    Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
    later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
    implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
    details. You should have received a copy of the GNU General Public License along with this program. If not, see
    https://www.gnu.org/licenses/."""),
    ("GPL-3.0", """GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is
    permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
    not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
)
#: Words of the templates that many texts have.
COMMON = frozenset("under by to the of and or in a an this is be with may you all for on at any as".split())


def bigrams_of(text: str) -> list[str]:
    """Bigrams of a template, by the same rule as :func:`bigrams`."""
    words = [w for w in re.split(r"[^0-9a-z]+", text.lower()) if w]
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def bigrams(words: Column) -> Column:
    """The set of bigrams of an array of words."""
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1))))


def _need(n: int, alike: float) -> int:
    """Bigrams of a template of ``n`` that any window alike to it shares."""
    return math.ceil(n * alike / (2 - alike) - 1e-9)


def key_words(templates, alike: float = ALIKE) -> list[str]:
    """Words of which a text must have one to hold a window alike to any of the templates.

    A window shares so many of a template's bigrams that it cannot miss all that have one of the
    template's key words; the longest words, which are rare, are taken first.
    """
    keys: list[str] = []
    for _, text in templates:
        own = [g.split(" ") for g in bigrams_of(text)]
        left = len(own) - _need(len(own), alike)
        for word in sorted({w for g in own for w in g}, key=lambda w: (w not in keys, w in COMMON, -len(w), w)):
            if sum(any(w in keys for w in g) for g in own) > left:
                break
            if word not in keys:
                keys.append(word)
    return keys


def has_key(lower: Column, templates, alike: float = ALIKE) -> Column:
    """Whether a lower-case text has one of the :func:`key_words`; without one, nothing in it is alike to a template."""
    keys = key_words(templates, alike)
    found = functools.reduce(lambda a, b: a | b, (F.contains(lower, F.lit(w)) for w in keys if len(w) > 3), F.lit(False))
    if short := [w for w in keys if len(w) <= 3]:
        found |= F.rlike(lower, F.lit(f"(?<![0-9a-z])({'|'.join(short)})(?![0-9a-z])"))
    return found


def _dice(grams: Column, own: Column) -> Column:
    return 2.0 * F.size(F.array_intersect(grams, own)) / (F.size(F.array_distinct(grams)) + F.size(own))


def _runs(hits: Column, t: Column, alike: float) -> Column:
    """``start, stop`` of the runs of a template's bigrams with the largest surplus.

    A run ends where its surplus is used up, where more foreign words follow than a window may
    hold, or where it is long enough and the bigrams it still lacks cannot make up for a gap.
    """
    n, own = F.size(t["own"]), F.transform(F.filter(hits, lambda h: F.array_contains(t["own"], h["gram"])), lambda h: F.struct(
        h["at"].alias("at"), F.array_position(t["own"], h["gram"]).alias("id")))
    gain, enough = 2 - alike, n * alike - 1e-9
    run = "struct<start:int,stop:int>"
    nothing = F.struct(
        F.array().cast("array<bigint>").alias("seen"), F.lit(-1.0).alias("total"), F.lit(-1).alias("start"), F.lit(-1).alias("last"),
        F.lit(-1.0).alias("best"), F.lit(-1).alias("stop"), F.array().cast(f"array<{run}>").alias("found"))

    def ended(s: Column) -> Column:
        return F.when(s["best"] >= enough, F.concat(s["found"], F.array(F.struct(s["start"], s["stop"]).cast(run)))).otherwise(s["found"])

    def step(s: Column, h: Column) -> Column:
        gap = h["at"] - s["last"] - 1
        left = s["total"] - alike * gap
        lacks = gain * (n - F.size(s["seen"]))
        ends = (left < 0) | (gap > n * (1 - alike) / alike * 2 + 1) | ((s["best"] >= enough) & (left + lacks < s["best"]))
        new = ~F.array_contains(s["seen"], h["id"])
        total = F.when(new, left + gain).otherwise(left)
        better = total > s["best"]
        return F.when(ends, F.struct(
            F.array(h["id"]).alias("seen"), F.lit(gain).alias("total"), h["at"].alias("start"), h["at"].alias("last"),
            F.lit(gain).alias("best"), h["at"].alias("stop"), ended(s).alias("found"),
        )).otherwise(F.struct(
            F.when(new, F.concat(s["seen"], F.array(h["id"]))).otherwise(s["seen"]).alias("seen"), total.alias("total"), s["start"].alias("start"),
            h["at"].alias("last"), F.greatest(total, s["best"]).alias("best"), F.when(better, h["at"]).otherwise(s["stop"]).alias("stop"),
            s["found"].alias("found")))

    return F.aggregate(own, nothing, step, ended)


def windows(documents: DataFrame, alike: float = ALIKE, templates=TEMPLATES, clauses=CLAUSES) -> DataFrame:
    """``doc_id, license, dice`` of notices in windows of words, without the lines and whole texts that match ``templates``.

    Of windows that overlap, the one that shares most bigrams with its template counts.
    """
    every = [(name, bigrams_of(text)) for name, text in (*templates, *clauses)]
    table = F.array(*(
        F.struct(F.lit(name).alias("license"), F.lit(-k).alias("place"), F.split(F.lit("|".join(own)), "[|]").alias("own"), F.lit(_need(len(own), alike)).alias("need"))
        for k, (name, own) in enumerate(every)))
    whole = F.slice(table, 1, len(templates))
    apart = max(len(own) for _, own in every) + 2
    union = sorted({g for _, own in every for g in own})

    def grams_of(words: Column) -> Column:
        return F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))).otherwise(F.array().cast("array<string>"))

    def matches(words: Column) -> Column:
        most = max(len(own) for _, own in every[:len(templates)]) * (2 - alike) / alike
        # An array of one is computed once, whatever its lambda mentions.
        grams = F.filter(F.array(F.when(F.size(words) > 1, bigrams(words))), lambda g: F.size(g) <= most)
        return F.exists(grams, lambda g: F.exists(whole, lambda t: _dice(g, t["own"]) >= alike))

    # A generator after each costly column keeps it from being written out, and computed, again.
    once = lambda df, name, column: df.withColumn(name, F.explode(F.array(column)))
    words_of = lambda part: F.filter(F.split(part, "[^0-9a-z]+"), lambda w: w != "")

    def placed(df: DataFrame) -> DataFrame:
        """Bigrams, those of templates with their places, and the templates that they suffice for."""
        df = once(df, "grams", grams_of(F.col("words")))
        df = once(df, "hits", F.filter(F.transform("grams", lambda g, i: F.struct(i.alias("at"), g.alias("gram"))), lambda h: h["gram"].isin(union)))
        held = F.filter(table, lambda t: F.size(F.array_intersect(F.col("hits.gram"), t["own"])) >= t["need"])
        return once(df, "t", held).where(F.size("t") > 0)

    keyed = common.where_made(documents.select("doc_id", F.lower("text").alias("lower")), has_key(F.col("lower"), (*templates, *clauses), alike))
    some = placed(once(keyed, "words", words_of(F.col("lower"))))
    # Lines that match are told by themselves; words that no template has stand in for them.
    lines = once(some.select("doc_id", "lower", "words"), "lines", F.transform(F.split("lower", "\n"), words_of))
    rest = F.when(matches(F.col("words")), F.array().cast("array<string>")).otherwise(F.flatten(F.transform(
        "lines", lambda w: F.when(matches(w), F.array_repeat(F.lit("-"), apart)).otherwise(w))))
    found = placed(once(lines, "rest", rest).select("doc_id", F.col("rest").alias("words")))

    def judged(t: Column) -> Column:
        def of_run(r: Column) -> Column:
            grams = F.slice("grams", r["start"] + 1, r["stop"] - r["start"] + 1)
            return F.struct(
                F.size(F.array_intersect(grams, t["own"])).alias("shared"), _dice(grams, t["own"]).alias("dice"), t["place"].alias("place"),
                t["license"].alias("license"), r["start"].alias("start"), r["stop"].alias("stop"))

        return F.filter(F.transform(_runs(F.col("hits"), t, alike), of_run), lambda m: m["dice"] >= alike)

    one = "struct<shared:int,dice:double,place:int,license:string,start:int,stop:int>"
    found = once(found, "all", F.sort_array(F.flatten(F.transform("t", judged)), asc=False)).select("doc_id", "all")
    picked = F.aggregate(F.col("all").cast(f"array<{one}>"), F.array().cast(f"array<{one}>"), lambda got, m: F.when(
        F.exists(got, lambda x: (x["start"] <= m["stop"]) & (m["start"] <= x["stop"])), got).otherwise(F.concat(got, F.array(m))))
    return found.select("doc_id", F.explode(picked).alias("m")).select("doc_id", "m.license", "m.dice")


def scan(documents: DataFrame, alike: float = ALIKE, templates=TEMPLATES) -> DataFrame:
    """``doc_id, license, notices, dice``: the licences that a document names, how many of its lines
    (or whole texts, or windows of words outside these) match, and the best coefficient.

    A line is taken for the licence of its best template, the first among equals. Null and empty
    texts and lines of one word match nothing; a text of a single line is compared once. Rows that
    repeat an id are reported together, those without one under null.
    """
    sets = [(name, bigrams_of(text)) for name, text in templates]
    low = [len(s) * alike / (2 - alike) for _, s in sets]
    high = [len(s) * (2 - alike) / alike for _, s in sets]
    lower = documents.select("doc_id", F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("lower"))
    # A part that is alike to a template shares a bigram with a key word, so only parts with one are cut into words.
    keyed = all(_need(len(own), alike) > 0 for _, own in sets)
    if keyed:
        lower = common.where_made(lower, has_key(F.col("lower"), templates, alike))
    lines = F.split("lower", "\n")
    parts = lower.select("doc_id", F.explode(F.when(F.size(lines) > 1, F.concat(lines, F.array("lower"))).otherwise(lines)).alias("part"))
    if keyed:
        parts = parts.where(has_key(F.col("part"), templates, alike))
    words = parts.select("doc_id", F.filter(F.split("part", "[^0-9a-z]+"), lambda w: w != "").alias("words"))
    grams = words.select("doc_id", F.when(F.size("words") - 1 >= min(low), bigrams(F.col("words"))).alias("grams"))
    sized = grams.select("doc_id", "grams", F.coalesce(F.size("grams"), F.lit(0)).alias("n"))
    scores = []
    for place, ((name, own), least, most) in enumerate(zip(sets, low, high)):
        shared = F.size(F.array_intersect("grams", F.array(*map(F.lit, own))))
        dice = F.when(F.col("n").between(least, most), 2.0 * shared / (F.col("n") + len(own))).otherwise(0.0)
        scores.append(F.struct(dice.alias("dice"), F.lit(-place).alias("place"), F.lit(name).alias("license")))
    best = sized.select("doc_id", F.array_max(F.array(*scores)).alias("best"))
    matched = common.where_made(best, F.col("best.dice") >= alike)
    matched = matched.select("doc_id", "best.license", "best.dice").union(windows(documents, alike, templates))
    return matched.groupBy("doc_id", "license").agg(F.count("*").alias("notices"), F.max("dice").alias("dice"))
