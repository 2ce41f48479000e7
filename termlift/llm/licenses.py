"""License notices found by word-bigram Dice similarity with templates.

A document's units are its lines, its paragraphs (between blank lines) and the
whole text. Where none of them is similar as a whole, windows of a template's own
number of words find its notice inside longer lines, comment blocks and texts. A
window starts where one of the template's bigrams does; for templates of more
than STRIDES words it starts at every place of its first bigram and at every
n / STRIDES-th word, so the similarity seen is at most 1 / STRIDES too low. A
window inside a similar unit, or a similar window at least twice as long, is left
to that one. Text is lower-cased and cut at everything that is neither letter nor
digit. The similarity of a unit with `a` distinct bigrams and a template with `b`,
`c` of them shared, is 2c / (a + b). It can reach the threshold t only if
t * (a + b) <= 2 * min(a, b). As c <= a, c is at least t * b / (2 - t): only the
templates of which the whole text holds so many bigrams are compared with units.

Templates are few and given by the caller, so they are part of the plan. All
work happens inside the row, by SQL expressions: no shuffle, no Python on rows.

`l_units` counts units similar as a whole, not windows: a text in which only a
window is similar has a license and 0 units. `l_found` has all names found.

Defined results: null and empty texts, and texts without a match, have a null
license and a similarity of 0.0; a unit of one word has that word as its only
bigram; equal similarities go to the license first in name order; repeated rows
are scanned each; an empty table gives an empty result. Columns made here start
with `l_`, so those of the input do not clash.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whole license texts, one file each.
TEXTS = Path(__file__).with_name("license_texts")


def _gnu(name: str, version: str) -> str:
    """How the GNU licenses ask to be named in a source file."""
    return (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        f"GNU {name} as published by the Free Software Foundation, either version {version} of the License, or "
        "(at your option) any later version"
    )


def _gnu_warranty(program: str, name: str) -> str:
    return (
        f". {program} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        f"implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
        f" You should have received a copy of the GNU {name} along with this program. If not, see "
        "<https://www.gnu.org/licenses/>."
    )


_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
)
_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
_CC = "This work is licensed under a Creative Commons {} International License"

# Fixed values, several for a license: whole texts ("text"), public notices as the licenses ask to place them ("notice",
# and "header" with the paragraphs that follow it), and common one-line forms.
TEMPLATES = {
    "AGPL-3.0": f"This work is licensed under the GNU {_AGPL}, version 3",
    "AGPL-3.0 header": _gnu(_AGPL, "3") + _gnu_warranty("This program", _AGPL),
    "AGPL-3.0 notice": _gnu(_AGPL, "3"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": _APACHE + (
        " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."
    ),
    "Apache-2.0 notice": _APACHE,
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
    "CC-BY-4.0": _CC.format("Attribution 4.0"),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-NC-4.0 notice": _CC.format("Attribution-NonCommercial 4.0"),
    "CC-BY-NC-ND-4.0 notice": _CC.format("Attribution-NonCommercial-NoDerivatives 4.0"),
    "CC-BY-NC-SA-4.0 notice": _CC.format("Attribution-NonCommercial-ShareAlike 4.0"),
    "CC-BY-ND-4.0 notice": _CC.format("Attribution-NoDerivatives 4.0"),
    "CC-BY-SA-4.0 notice": _CC.format("Attribution-ShareAlike 4.0"),
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work",
    "GPL-2.0 header": _gnu(_GPL, "2") + _gnu_warranty("This program", _GPL),
    "GPL-2.0 notice": _gnu(_GPL, "2"),
    "GPL-3.0": f"This work is licensed under the GNU {_GPL}, version 3",
    "GPL-3.0 header": _gnu(_GPL, "3") + _gnu_warranty("This program", _GPL),
    "GPL-3.0 notice": _gnu(_GPL, "3"),
    "LGPL-2.1 header": _gnu(_LGPL, "2.1") + _gnu_warranty("This library", _LGPL),
    "LGPL-2.1 notice": _gnu(_LGPL, "2.1"),
    "LGPL-3.0 header": _gnu(_LGPL, "3") + _gnu_warranty("This library", _LGPL),
    "LGPL-3.0 notice": _gnu(_LGPL, "3"),
    "MIT": "Released under the MIT License",
    "MIT notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"
    ),
    "Proprietary": "All rights reserved",
    **{f"{path.stem} text": path.read_text(encoding="utf-8") for path in sorted(TEXTS.glob("*.txt"))},
}
TEMPLATES["MIT permission"] = TEMPLATES["MIT text"].split("\n\n")[0]
PERCENT = 80
STRIDES = 40
SEPARATOR = r"[^\p{L}\p{N}]+"
BLANK = r"\n[\x20\x09-\x0D]*\n"


def template_words(text: str) -> list[str]:
    """The template's words, cut as the documents' are."""
    return re.findall(r"[^\W_]+", text.lower())


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])}) or words


def _pairs(words: Column) -> Column:
    last = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, last), F.slice(words, 2, last), lambda a, b: F.concat_ws(" ", a, b))


def _bigrams(words: Column) -> Column:
    return F.when(F.size(words) > 1, F.array_distinct(_pairs(words))).otherwise(words)


def _known(words: str, grams: list[str]) -> str:
    """Distinct bigrams of a text that any template has; only pairs of two template words are put together."""
    listed = ", ".join(f"'{gram}'" for gram in grams)
    each = ", ".join(f"'{word}'" for word in sorted({word for gram in grams for word in gram.split(" ")}))
    pairs = (
        f"zip_with(slice({words}, 1, greatest(size({words}) - 1, 0)), slice({words}, 2, greatest(size({words}) - 1, 0)), "
        f"(a, b) -> CASE WHEN a IN ({each}) AND b IN ({each}) THEN concat_ws(' ', a, b) END)"
    )
    # A unit of one word can only be similar to a template of one word.
    looked_up = f"concat({pairs}, {words})" if any(" " not in gram for gram in grams) else pairs
    return f"array_distinct(filter({looked_up}, gram -> gram IN ({listed})))"


def _near(known: Column, table: Column, percent: int) -> Column:
    """Templates of which the whole text holds as many bigrams as any similar part of it must."""
    enough = F.filter(table, lambda t: (200 - percent) * F.size(known) >= percent * t["b"])
    return F.filter(
        enough, lambda t: (200 - percent) * F.size(F.array_intersect(known, t["grams"])) >= percent * t["b"]
    )


def _placed(parts: Column) -> Column:
    """Each part of a text with the place of its first word: words, at."""
    ends = F.aggregate(parts, F.array(F.lit(1)), lambda done, part: F.concat(done, F.array(F.element_at(done, -1) + F.size(part))))
    return F.zip_with(parts, F.slice(ends, 1, F.size(parts)), lambda part, at: F.struct(part.alias("words"), at.alias("at")))


def _windows(near: Column, words: Column, pairs: Column, percent: int) -> Column:
    """Similar windows of every template in `near`: name, c, both, at, n."""

    def similar(t: Column) -> Column:
        line = F.when(t["n"] == 1, words).otherwise(pairs)
        step = F.greatest(F.ceil(t["n"] / STRIDES).cast("int"), F.lit(1))
        marked = F.transform(line, lambda gram, i: F.struct(gram.alias("gram"), (i + 1).alias("at")))
        starts = F.filter(
            marked,
            lambda place: (place["gram"] == t["first"])
            | F.when(step > 1, (place["at"] - 1) % step == 0).otherwise(F.array_contains(t["grams"], place["gram"])),
        )
        compared = F.transform(
            starts,
            lambda place: _window(F.array_distinct(F.slice(line, place["at"], F.greatest(t["n"] - 1, F.lit(1)))), place["at"], t, F.size(words)),
        )
        return F.filter(compared, lambda hit: 200 * hit["c"] >= percent * hit["both"])

    return F.flatten(F.transform(near, similar))


def _window(grams: Column, at: Column, t: Column, n_words: Column) -> Column:
    return F.struct(
        t["name"].alias("name"),
        F.size(F.array_intersect(grams, t["grams"])).alias("c"),
        (F.size(grams) + t["b"]).alias("both"),
        at.alias("at"),
        F.least(t["n"], n_words + 1 - at).alias("n"),
    )


def _inside(hit: Column, other: Column) -> Column:
    return (hit["at"] >= other["at"]) & (hit["at"] + hit["n"] <= other["at"] + other["n"])


def _alone(windows: Column, units: Column) -> Column:
    """Windows that lie neither in a similar unit nor in a window at least twice as long."""
    outside = F.filter(windows, lambda hit: ~F.exists(units, lambda unit: _inside(hit, unit)))
    return F.filter(
        outside, lambda hit: ~F.exists(windows, lambda other: (other["n"] >= 2 * hit["n"]) & _inside(hit, other))
    )


def _hits(grams: Column, table: Column, percent: int) -> Column:
    """Templates similar enough to a unit's bigrams; the size bound comes before the comparison."""
    a = F.size(grams)
    possible = F.filter(table, lambda t: 200 * F.least(a, t["b"]) >= percent * (a + t["b"]))
    compared = F.transform(
        possible,
        lambda t: F.struct(
            t["name"].alias("name"), F.size(F.array_intersect(grams, t["grams"])).alias("c"), (a + t["b"]).alias("both")
        ),
    )
    return F.filter(compared, lambda hit: 200 * hit["c"] >= percent * hit["both"])


def _best(hits: Column) -> Column:
    """The hit of the largest similarity, the first name among equals."""
    return F.aggregate(
        hits,
        F.struct(F.lit(0.0).alias("dice"), F.lit(None).cast("string").alias("name")),
        lambda seen, hit: F.when(
            (2.0 * hit["c"] / hit["both"] > seen["dice"])
            | ((2.0 * hit["c"] / hit["both"] == seen["dice"]) & (hit["name"] < seen["name"])),
            F.struct((2.0 * hit["c"] / hit["both"]).alias("dice"), hit["name"].alias("name")),
        ).otherwise(seen),
    )


def scan(docs: DataFrame, text: str = "text", templates: Mapping[str, str] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """Append `l_license`, `l_dice` (of the most similar pair), `l_units` (units similar to any template) and `l_found`."""
    grams = {name: template_bigrams(body) for name, body in sorted(templates.items())}
    sizes = [len(made) for made in grams.values()]
    # The size bound for any template, on words: a unit of n words, d of them distinct, has d - 1 to n bigrams.
    least = min(-(-percent * size // (200 - percent)) for size in sizes)
    most = max((200 - percent) * size // percent for size in sizes)
    # One string literal a template, cut when the plan is optimised: thousands of literals would take seconds to pass.
    rows = [
        F.struct(
            F.lit(name).alias("name"), F.split(F.lit("\n".join(made)), "\n").alias("grams"), F.lit(len(made)).alias("b"),
            F.lit(len(template_words(templates[name]))).alias("n"), F.lit(" ".join(template_words(templates[name])[:2])).alias("first"),
        )
        for name, made in grams.items()
    ]
    table = F.array(*rows)
    known = sorted(set().union(*grams.values()))

    def cut(line: Column) -> Column:
        return F.filter(F.split(F.lower(line), SEPARATOR), lambda word: word != "")

    body = F.coalesce(F.col(text), F.lit(""))
    paragraphs = F.transform(F.split(body, BLANK), lambda part: F.transform(F.split(part, "\n"), cut))
    lines = _placed(F.flatten("l_cut"))
    longer = F.filter(
        F.zip_with(
            F.col("l_cut"),
            _placed(F.transform("l_cut", F.flatten)),
            lambda part, placed: F.when(F.size(part) > 1, placed),
        ),
        lambda placed: placed.isNotNull(),
    )
    text_at = F.struct(F.col("l_words").alias("words"), F.lit(1).alias("at"))
    whole = F.filter(F.array(text_at), lambda _: F.size("l_cut") > 1)
    none = F.array().cast("array<struct<words:array<string>,at:int>>")
    units = F.when(F.size("l_near") > 0, F.concat(lines, longer, whole)).otherwise(none)
    sized = F.filter(
        units,
        lambda unit: (F.size(unit["words"]) >= least)
        & ((F.size(unit["words"]) <= most) | (F.size(F.array_distinct(unit["words"])) - 1 <= most)),
    )
    hits = F.transform(
        sized,
        lambda unit: F.struct(
            _hits(_bigrams(unit["words"]), F.col("l_near"), percent).alias("hits"), unit["at"].alias("at"), F.size(unit["words"]).alias("n")
        ),
    )
    by_unit = F.flatten(F.transform("l_hits", lambda unit: unit["hits"]))
    by_window = F.transform(
        _alone(F.col("l_windows"), F.col("l_hits")),
        lambda hit: F.struct(hit["name"].alias("name"), hit["c"].alias("c"), hit["both"].alias("both")),
    )
    return (
        docs.withColumn("l_cut", paragraphs)
        .withColumn("l_words", F.flatten(F.flatten("l_cut")))
        .withColumn("l_known", F.expr(_known("l_words", known)))
        .withColumn("l_near", _near(F.col("l_known"), table, percent))
        .withColumn("l_pairs", F.when(F.size("l_near") > 0, _pairs(F.col("l_words"))).otherwise(F.array().cast("array<string>")))
        .withColumn("l_hits", F.filter(hits, lambda unit: F.size(unit["hits"]) > 0))
        .withColumn("l_units", F.size("l_hits").cast("long"))
        .withColumn("l_windows", _windows(F.col("l_near"), F.col("l_words"), F.col("l_pairs"), percent))
        .withColumn("l_both", F.concat(by_unit, by_window))
        .withColumn("l_best", _best(F.col("l_both")))
        .select(
            *(F.col(f"`{name}`") for name in docs.columns),
            F.col("l_best.name").alias("l_license"),
            F.col("l_best.dice").alias("l_dice"),
            "l_units",
            F.array_sort(F.array_distinct(F.transform("l_both", lambda hit: hit["name"]))).alias("l_found"),
        )
    )
