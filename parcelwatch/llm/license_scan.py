"""Licence notices in texts, by likeness to templates.

A text is cut into lines, paragraphs and itself as a whole; each such unit is normalised (lower case, runs of letters and
digits) and compared to licence templates by the Dice coefficient of their sets of word bigrams, 2 |A and B| / (|A| + |B|).

Two bounds save most of the work and lose nothing. A unit of a bigrams can reach ``LEAST`` only with templates of
a r to a / r bigrams, r = LEAST / (2 - LEAST). And it must hold more than the share r of the template's bigrams, so it
holds one of the template's anchors, words that lie in at least the rest of them; a text without any anchor is
done with.

Notices that are no such unit, in several paragraphs or within longer prose, are passages: runs of words of what is
left of the text when units that match are taken out. A run gains by every further bigram of the template at its
ends, so the best one begins and ends where streaks of such bigrams do, and only those are compared.

Everything is built-in functions inside one projection: no row is moved or multiplied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text

LEAST = 0.8
#: Names and the wording of notices.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("reserved", "All rights reserved."),
)


def _normal(text: str) -> list[str]:
    out = "".join(c if c.isalnum() else " " for c in text.lower())
    return out.split()


def _bigrams(words: list[str]) -> list[str]:
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def anchors(words: list[str], least: float) -> set[str]:
    """Words of a template, longest first, such that a unit without any of them stays below ``least``."""
    grams = _bigrams(words)
    part = round(1000 * least)
    picked: set[str] = set()
    for w in sorted(set(words), key=lambda w: (-len(w), w)):
        without = sum(not picked & set(g.split(" ")) for g in grams)
        if 2000 * without < part * (without + len(grams)):
            break
        picked.add(w)
    return picked


def _let(value: Column, f) -> Column:
    """``f(value)`` with the value bound to a lambda variable."""
    return F.transform(F.array(value), f)[0]


def _passages(words: Column, templates: Column, part: int) -> Column:
    """Of an array of words the runs that are most similar to a template, not overlapping, in order: (start, permille, license)."""

    def runs(grams: Column, t: Column) -> Column:
        need = F.ceil(t["size"] * part / (2000 - part)).cast("int")  # bigrams that the run must hold of the template
        most = 2 * t["size"]

        def best(at: Column) -> Column:
            ends = lambda p, n: F.filter(
                F.slice(F.transform(at, lambda e, m: F.struct(e.alias("e"), F.coalesce(F.get(at, m + 1) != e + 1, F.lit(True)).alias("last"))), n + need, most),
                lambda x: x["last"] & (x["e"] - p < most),
            )
            starts = F.filter(
                F.transform(at, lambda p, n: F.struct(p.alias("p"), n.alias("n"))),
                lambda s: (F.get(at, s["n"] + need - 1) - s["p"] < most) & F.coalesce(F.get(at, s["n"] - 1) != s["p"] - 1, F.lit(True)),
            )

            def scored(p: Column, e: Column) -> Column:
                return _let(
                    F.array_distinct(F.slice(grams, p + 1, e - p + 1)),
                    lambda g: F.struct(
                        F.floor(2000 * F.size(F.array_intersect(g, t["grams"])) / (F.size(g) + t["size"])).cast("int").alias("permille"),
                        t["size"].alias("size"),
                        t["order"].alias("order"),
                        (-p).alias("back"),
                        e.alias("end"),
                        t["license"].alias("license"),
                    ),
                )

            return F.flatten(F.transform(starts, lambda s: F.transform(ends(s["p"], s["n"]), lambda x: scored(s["p"], x["e"]))))

        places = F.transform(grams, lambda x, i: F.when(F.array_contains(t["grams"], x), i))
        return _let(F.filter(places, lambda i: i.isNotNull()), best)

    def chosen(every: Column) -> Column:
        ranked = F.reverse(F.array_sort(F.filter(every, lambda r: r["permille"] >= part)))
        none = F.filter(ranked, lambda r: F.lit(False))
        apart = lambda kept, r: ~F.exists(kept, lambda k: (-k["back"] <= r["end"]) & (-r["back"] <= k["end"]))
        kept = F.aggregate(ranked, none, lambda acc, r: F.when(apart(acc, r), F.concat(acc, F.array(r))).otherwise(acc))
        return F.array_sort(F.transform(kept, lambda r: F.struct((-r["back"]).alias("start"), r["permille"].alias("permille"), r["license"].alias("license"))))

    hopeful = F.filter(templates, lambda t: F.arrays_overlap(words, t["anchors"]))
    each = F.filter(F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b)), lambda x: x.isNotNull())
    return _let(each, lambda grams: chosen(F.flatten(F.transform(hopeful, lambda t: runs(grams, t)))))


def license_matches(docs: DataFrame, least: float = LEAST, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """All columns of ``docs`` but a ``matches`` it may have, and ``matches``: an array of (unit, nth, permille, license).

    unit is line, paragraph (where it has several lines) or text (where it has several paragraphs), nth its number among
    those, from 0; or passage, a run of words elsewhere, nth by order. license is that of the most similar template (of equally similar ones, the first), permille its
    coefficient, cut off. Null text counts as empty and has no matches. A unit of one word has no bigrams. Repeated rows are
    judged one by one, a table without rows gives none. Each unit is looked at once, so units cost in proportion to the text.
    """
    known = [(name, _bigrams(_normal(t)), sorted(anchors(_normal(t), least))) for name, t in templates]
    part = round(1000 * least)  # bounds are compared in whole numbers
    hints = F.array(*map(F.lit, sorted(set().union(*(anchors(_normal(t), least) for _, t in templates)))))
    table = F.array(
        *(
            F.struct(F.lit(-i).alias("order"), F.lit(n).alias("license"), F.array(*map(F.lit, g)).alias("grams"), F.lit(len(g)).alias("size"), F.array(*map(F.lit, a)).alias("anchors"))
            for i, (n, g, a) in enumerate(known)
        )
    )

    def words(body: Column) -> Column:
        return F.filter(F.split(F.translate(body, "\n", " "), " "), lambda w: w != "")

    def unit(kind: str, nth: Column, body: Column) -> Column:
        return F.struct(F.lit(kind).alias("unit"), nth.cast("int").alias("nth"), words(body).alias("words"))

    def bigrams(w: Column) -> Column:
        each = F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.array_distinct(F.filter(each, lambda x: x.isNotNull()))

    def best(u: dict[str, Column]) -> Column:
        near = F.filter(table, lambda t: (t["size"] * (2000 - part) >= F.size(u["grams"]) * part) & (t["size"] * part <= F.size(u["grams"]) * (2000 - part)))
        scored = F.transform(
            near,
            lambda t: F.struct(
                F.floor(2000 * F.size(F.array_intersect(u["grams"], t["grams"])) / (F.size(u["grams"]) + t["size"])).cast("int").alias("permille"),
                t["order"].alias("order"),
                t["license"].alias("license"),
            ),
        )
        return F.array_max(scored)

    names = [c for c in docs.columns if c != "matches"]
    text = F.regexp_replace(F.lower(whole_text(docs)), r"[^\p{L}\p{N}\n]+", " ")
    lines = F.split("_text", "\n", -1)
    breaks = "\n *\n[ \n]*"
    paragraphs = F.split("_text", breaks, -1)
    several = lambda x: F.when(F.trim(x).contains("\n"), x).otherwise("")

    def judged(units: Column) -> Column:
        """The units in their order; permille and license are null where no template is near."""
        one = lambda u: F.when(F.arrays_overlap(u["words"], hints), _let(bigrams(u["words"]), lambda g: best({"grams": g})))
        named = lambda u, m: F.struct(u["unit"].alias("unit"), u["nth"].alias("nth"), m["permille"].alias("permille"), m["license"].alias("license"))
        return F.transform(units, lambda u: _let(one(u), lambda m: named(u, m)))

    everything = F.struct(
        judged(F.transform(lines, lambda x, i: unit("line", i, x))).alias("lines"),
        judged(F.transform(paragraphs, lambda x, i: unit("paragraph", i, several(x)))).alias("paragraphs"),
        judged(F.array(unit("text", F.lit(0), F.when(F.size(paragraphs) > 1, F.col("_text")).otherwise("")))).alias("text"),
    )
    matches = lambda m: F.coalesce(m["permille"] >= part, F.lit(False))

    def left(every: Column) -> Column:
        """The words that are in no unit that matches; one ``|`` stands for such a unit. Units are found by their place, and a
        marked line is no blank one, so the paragraphs of the marked text are those of the text."""
        marked = F.array_join(F.transform(lines, lambda x, i: F.when(matches(F.get(every["lines"], i)), F.lit("|")).otherwise(x)), "\n")
        rest = F.transform(F.split(marked, breaks, -1), lambda x, i: F.when(matches(F.get(every["paragraphs"], i)), F.lit("|")).otherwise(x))
        return F.when(matches(F.get(every["text"], 0)), F.array().cast("array<string>")).otherwise(words(F.array_join(rest, " ")))

    def with_passages(every: Column) -> Column:
        more = _let(left(every), lambda w: F.when(F.arrays_overlap(w, hints), _passages(w, table, part)))
        more = F.coalesce(more, F.array().cast("array<struct<start:int,permille:int,license:string>>"))
        passages = F.transform(more, lambda m, i: F.struct(F.lit("passage").alias("unit"), i.alias("nth"), m["permille"].alias("permille"), m["license"].alias("license")))
        return F.concat(F.filter(F.concat(every["lines"], every["paragraphs"], every["text"]), matches), passages)

    found = _let(everything, with_passages)
    none = F.array().cast("array<struct<unit:string,nth:int,permille:int,license:string>>")
    read = docs.select(*names, text.alias("_text"))
    some = F.arrays_overlap(F.split(F.translate("_text", "\n", " "), " "), hints)
    return read.select(*names, F.when(some, found).otherwise(none).alias("matches"))


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_matches, licenses (the names found, sorted, comma-joined), best (largest permille or null), matches
    (unit:nth:license:permille, comma-joined) for every row of ``docs(doc_id, text, ..)``."""
    found = license_matches(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), "text"))
    return found.select(
        "doc_id",
        F.size("matches").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"),
        F.array_max(F.transform("matches", lambda m: m["permille"])).alias("best"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(":", m["unit"], m["nth"], m["license"], m["permille"])), ",").alias("matches"),
    )
