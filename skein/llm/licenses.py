"""Licence scans: Dice coefficient over word bigrams against licence templates.

A text is compared piece by piece: every line, every paragraph (lines between blank ones)
and the whole. Pieces are normalised (lower case, every run of other characters than a-z
and 0-9 a space) and become sets of word bigrams; a template scores
2 * common / (bigrams of the piece + bigrams of the template). Since the common bigrams are
at most the smaller set, a piece can reach ``threshold`` only if its size lies between
t/(2-t) and (2-t)/t times the template's: all other templates are pruned by size, and a
piece that fits no template is dropped before any bigram is compared.

A licence that is none of these pieces (a notice inside a line, a licence of several
paragraphs in a long document) is found in windows: the whole text is one sequence of
bigrams, in which the bigrams of a template form stretches. Making a window longer by bigrams
of the template never lowers its score, so only windows from the start of a stretch to the
end of the same or a later one are scored, with at most 2(1-t)/t times the template's size
of other bigrams between them (repeats counted). Windows are also compared with
``FULL_TEXTS``. Where no piece scores 1, the window with most bigrams in common decides if
its score is above the best piece's and its licence another; ``license_pieces`` counts pieces
only. Texts without the words that any match must have (``_telling``) are left out early.

Scale: one pass, no shuffle; the templates are a parameter and travel in the plan.

Defined cases: NULL and empty texts have no licence; pieces and templates of fewer than two
words never match; equal scores go to the name first in code-point order; rows are
independent, so repeated rows get equal results. Other columns are passed through.
"""

from __future__ import annotations

import functools
import math
import operator
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import aside, free

# Licence notices and short licence texts by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or "
        "(at your option) any later version.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

_AS_IS = (
    "{0} \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {1} OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
    "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
    "THE POSSIBILITY OF SUCH DAMAGE."
).format("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "HOLDER")

# Whole licences, compared with windows only.
FULL_TEXTS = {
    "MIT": [
        TEMPLATES["MIT"][2] + " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        TEMPLATES["ISC"][0] + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
        "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "BSD-2-Clause": [TEMPLATES["BSD-2-Clause"][0] + " " + _AS_IS],
    "BSD-3-Clause": [
        TEMPLATES["BSD-2-Clause"][0] + " 3. Neither the name of the copyright holder nor the names of its contributors "
        "may be used to endorse or promote products derived from this software without specific prior written "
        "permission. " + _AS_IS,
    ],
}


def words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def bigrams(text: str) -> list[str]:
    w = words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))


def _prepared(templates: dict) -> list[tuple[str, list[str]]]:
    listed = [(name, bigrams(t)) for name in sorted(templates) for t in templates[name]]
    return [(name, grams) for name, grams in listed if grams]


def _dice(grams: Column, templates: list, threshold: float) -> Column:
    """Array of (dice, name) of the templates whose size and score admit the bigram set."""
    n = F.size(grams)
    scored = []
    for name, t in templates:
        common = F.size(F.array_intersect(grams, F.array(*[F.lit(g) for g in t])))
        fits = (n * (2 - threshold) >= threshold * len(t)) & (n * threshold <= (2 - threshold) * len(t))
        scored.append(F.when(fits, F.struct((2.0 * common / (n + len(t))).alias("dice"), F.lit(name).alias("name"))))
    return F.filter(F.array(*scored), lambda s: s["dice"] >= threshold)


def pieces(text: Column) -> Column:
    """Lines, paragraphs of two or more lines, and the whole text if it has several."""
    lines = F.split(text, "\n")
    blocks = F.filter(F.split(text, "\n[ \t\r]*\n"), lambda p: F.instr(p, "\n") > 0)
    whole = F.when(F.instr(text, "\n") > 0, F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.concat(lines, blocks, whole)


_USUAL = frozenset("a and any as be by for in is of on or other such that the this to under use with without work you".split())


def _telling(listed: list, threshold: float) -> list[str]:
    """Words of which a text with a matching window has at least one: of every template they
    touch more bigrams than a match can lack. Long words are taken first, usual ones last."""
    out: list[str] = []
    for _, grams in listed:
        most = len(grams) - math.ceil(threshold / (2 - threshold) * len(grams) - 1e-9)
        left = [g.split() for g in grams if not set(g.split()) & set(out)]
        while len(grams) - len(left) <= most:
            every = [w for g in left for w in set(g)]
            word = max(sorted(set(every)), key=lambda w: (w not in _USUAL, len(w) > 4, every.count(w), len(w)))
            out.append(word)
            left = [g for g in left if word not in g]
    return out


def _windows(found: DataFrame, listed: list, threshold: float) -> DataFrame:
    """``found`` with ``_v``: (common, dice, name) of the best window of every template that
    reaches the threshold, from ``_w``, the text's bigrams in order."""
    least, slack = threshold / (2 - threshold), 2 * (1 - threshold) / threshold
    row = lambda name, t: F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, t)).alias("t"), F.lit(math.ceil(least * len(t) - 1e-9)).alias("least"), F.lit(int(slack * len(t) + 1e-9)).alias("slack"))
    listed_rows = F.array(*[row(name, t) for name, t in listed])
    every = F.array(*map(F.lit, dict.fromkeys(g for _, t in listed for g in t)))
    found = found.withColumn("_m", F.array_intersect("_w", every))
    near = F.filter(listed_rows, lambda t: F.size(F.array_intersect(F.col("_m"), t["t"])) >= t["least"])
    found = found.withColumn("_n", F.when(F.size("_m") >= min(math.ceil(least * len(t) - 1e-9) for _, t in listed), near))
    at = F.sequence(F.lit(0), F.size("_w") - 1)
    found = found.withColumn("_p", F.transform("_n", lambda t: F.struct(*[t[c].alias(c) for c in ("name", "t", "least", "slack")], F.filter(at, lambda i: F.array_contains(t["t"], F.get(F.col("_w"), i))).alias("p"))))

    def stretches(p):
        """(first, last, other bigrams before) of the runs of neighbouring positions."""
        starts = F.filter(F.transform(p, lambda x, k: F.struct(x.alias("s"), k.alias("k"))), lambda r: (r["k"] == 0) | (F.get(p, r["k"] - 1) != r["s"] - 1))
        ends = F.filter(p, lambda x, k: (k == F.size(p) - 1) | (F.get(p, k + 1) != x + 1))
        return F.zip_with(starts, ends, lambda s, e: F.struct(s["s"].alias("s"), e.alias("e"), (s["s"] - s["k"]).alias("d")))

    found = found.withColumn("_r", F.transform("_p", lambda h: F.struct(*[h[c].alias(c) for c in ("name", "t", "least", "slack")], stretches(h["p"]).alias("r"))))

    def part(first, last):
        return F.slice("_w", first["s"] + 1, last["e"] - first["s"] + 1)

    def score(h, first, last):
        common = F.size(F.array_intersect(part(first, last), h["t"]))
        dice = 2.0 * common / (F.size(F.array_distinct(part(first, last))) + F.size(h["t"]))
        return F.struct(dice.alias("dice"), common.alias("common"))

    def scores(h, r, i):
        ahead = F.filter(F.slice(h["r"], i + 1, h["slack"] + 1), lambda c: c["d"] - r["d"] <= h["slack"])
        enough = F.size(F.array_intersect(part(r, F.element_at(ahead, -1)), h["t"])) >= h["least"]
        return F.when(enough, F.array_max(F.transform(ahead, lambda c: score(h, r, c))))

    best = F.transform("_r", lambda h: F.struct(F.array_max(F.transform(h["r"], lambda r, i: scores(h, r, i))).alias("b"), h["name"].alias("name")))
    found = found.withColumn("_b", best)
    hits = F.transform(F.filter("_b", lambda b: b["b"]["dice"] >= threshold), lambda b: F.struct(b["b"]["common"].alias("common"), b["b"]["dice"].alias("dice"), b["name"].alias("name")))
    return found.withColumn("_v", hits).drop("_m", "_n", "_p", "_r", "_b")


_HELPERS = {"license", "dice", "license_pieces", *(f"_{c}" for c in "bghlmnoprtvw")}  # columns that ``scan`` makes


def scan(docs: DataFrame, text_col: str = "text", templates: dict | None = None, threshold: float = 0.8) -> DataFrame:
    """``docs`` with ``license`` (best name), ``dice`` and ``license_pieces`` (how many
    pieces reach the threshold, 0 if only a window does); NULL, NULL and 0 without a match.
    Underscores are appended to new names that ``docs`` has."""
    docs, names = aside(docs, _HELPERS)
    text_col = names[text_col]

    def passed(found):
        back = [F.col(now).alias(c) for c, now in names.items()]
        return found.select(*back, *[F.col(c).alias(free(names, c)) for c in ("license", "dice", "license_pieces")])

    listed = _prepared(TEMPLATES if templates is None else templates)
    wide = listed + (_prepared(FULL_TEXTS) if templates is None else [])
    if not listed:
        return passed(docs.withColumns({"license": F.lit(None).cast("string"), "dice": F.lit(None).cast("double"), "license_pieces": F.lit(0)}))
    sizes = [len(t) for _, t in listed]
    least, most = threshold / (2 - threshold) * min(sizes), (2 - threshold) / threshold * max(sizes)

    def normal(p):
        return F.filter(F.split(F.regexp_replace(F.lower(p), "[^a-z0-9]+", " "), " "), lambda w: w != "")

    def joined(w):
        n = F.size(w) - 1
        return F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))

    def pairs(w):
        return F.array_distinct(joined(w))

    # character bounds first: a bigram set of a size needs so many letters (cheap to tell)
    units = F.filter(F.transform(F.filter(pieces(F.col(text_col)), lambda p: F.length(p) > 2 * least), normal), lambda w: (F.size(w) > least) & (F.size(w) > 1))
    found = docs.withColumn("_g", F.filter(F.transform(units, pairs), lambda g: F.size(g) <= most))
    found = found.withColumn("_h", F.filter(F.transform("_g", lambda g: _dice(g, listed, threshold)), lambda h: F.size(h) > 0))
    best = F.array_max(F.transform(F.flatten("_h"), lambda h: F.struct(h["dice"].alias("dice"))))["dice"]
    found = found.withColumn("dice", best)
    name = F.array_min(F.transform(F.filter(F.flatten("_h"), lambda h: h["dice"] == F.col("dice")), lambda h: h["name"]))
    found = found.withColumns({"license": name, "license_pieces": F.coalesce(F.size("_h"), F.lit(0))}).drop("_g", "_h")
    found = found.withColumn("_l", F.lower(F.col(text_col)))
    told = functools.reduce(operator.or_, [F.contains(F.col("_l"), F.lit(w)) for w in _telling(wide, threshold)])
    found = found.withColumn("_w", F.when((F.coalesce("dice", F.lit(0.0)) < 1) & told, normal(F.col(text_col))))
    found = _windows(found.withColumn("_w", F.when(F.size("_w") > 1, joined(F.col("_w")))), wide, threshold)
    most = F.array_max(F.transform("_v", lambda v: v["common"]))
    found = found.withColumn("_v", F.filter("_v", lambda v: v["common"] == most))
    top = F.array_max(F.transform("_v", lambda v: v["dice"]))
    found = found.withColumn("_t", F.struct(top.alias("dice"), F.array_min(F.transform(F.filter("_v", lambda v: v["dice"] == top), lambda v: v["name"])).alias("name")))
    other = F.col("_t.dice").isNotNull() & (F.col("license").isNull() | ((F.col("_t.name") != F.col("license")) & (F.col("_t.dice") > F.col("dice"))))
    found = found.withColumn("_o", other)
    found = found.withColumns({"license": F.when(F.col("_o"), F.col("_t.name")).otherwise(F.col("license")), "dice": F.when(F.col("_o"), F.col("_t.dice")).otherwise(F.col("dice"))})
    return passed(found)
