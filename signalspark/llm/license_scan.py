"""Operator 2: licence notices, by Dice coefficient over word bigrams against templates, in DataFrame functions only.

A unit is normalised: A-Z in lower case, runs of other characters than a-z and 0-9 become one space.  Its distinct word bigrams are compared with
those of a template; with sizes n and m, a Dice coefficient of 0.8 needs 2 m / 3 <= n <= 3 m / 2, so only templates of such a size are looked at,
and only texts that contain one of the words that the templates can't do without.  Units are

* the whole text (number 0) and each of its lines (from 1);
* windows of the whole text's words (number -1) that are as long as a template, so notices wrapped over lines, behind comment signs or beside other text in
  a line are found.  Each template has anchors, so many of its bigrams that a window which reaches the coefficient can't lack them all; wherever
  an anchor stands in the text, the window is looked at that puts the anchor where the template has it.  Of windows of one template that overlap,
  in order of their places, one that is worse than the one before or after (or equal to the one before) is left out: those are the same notice, shifted.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import read_table

#: Licence notices as their licences give them.
TEMPLATES = {
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
        "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
        "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "bsd-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."
    ),
    "mit": "Released under the MIT License.",
    "mit-text": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "mit-warranty": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "proprietary": "All rights reserved. No part of this work may be reproduced without permission.",
    "public-domain": "This is free and unencumbered software released into the public domain.",
}
#: Least Dice coefficient, in tenths.
TENTHS = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sequence(text: str) -> list[str]:
    """A text's bigrams in order, with repeats."""
    words = re.sub("[^a-z0-9]+", " ", text.translate(str.maketrans(UPPER, LOWER))).split()
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def bigrams(text: str) -> list[str]:
    return sorted(set(sequence(text)))


def bounds(m: int, tenths: int) -> tuple[int, int]:
    """Least and largest number of bigrams that can reach the coefficient with a template of m."""
    return -(-tenths * m // (20 - tenths)), (20 - tenths) * m // tenths


def telling_words(known: dict[str, list[str]], tenths: int) -> list[str]:
    """Words of which a text must contain one to hold a unit that reaches the coefficient.

    A unit lacks at most so many of a template's bigrams; words that stand in one more of them than that can't all be missing.
    """
    out: set[str] = set()
    for grams in known.values():
        m = len(grams)
        least, _ = bounds(m, tenths)
        left, hit = [set(g.split()) for g in grams], 0
        while hit <= m - -(-tenths * (least + m) // 20):
            # Long words first: short ones are in any text.
            word = min({w for g in left for w in g}, key=lambda w: (len(w) < 5, -sum(w in g for g in left), -len(w), w))
            hit += sum(word in g for g in left)
            left = [g for g in left if word not in g]
            out.add(word)
    return sorted(w for w in out if not any(v != w and v in w for v in out))


def least_common(m: int, tenths: int) -> int:
    """Least number of a template's m bigrams in a unit that reaches the coefficient."""
    return -(-tenths * (bounds(m, tenths)[0] + m) // 20)


def anchors(grams: list[str], tenths: int) -> list[str]:
    """Distinct bigrams of a template that a unit which reaches the coefficient can't all lack, of long words first: short ones are in any text."""
    return sorted(sorted(grams, key=lambda g: (-min(map(len, g.split())), -len(g), g))[: len(grams) - least_common(len(grams), tenths) + 1])


def _template_and_start(packed: Column) -> Column:
    return F.struct(F.shiftright(packed, 40).cast("int").alias("k"), (packed.bitwiseAND((1 << 40) - 1) - (1 << 20)).cast("int").alias("start"))


def _literal(values: Iterable[str]) -> Column:
    """An array of constants in SQL: one call where ``lit`` would be one for each (bigrams hold letters, digits and a space only)."""
    return F.expr(f"array({', '.join(values)})")


def _windows(seq: Column, templates: dict[str, str], tenths: int) -> Column:
    """Structs (license_id, n_common, n_unit, n_template, first_word) of the windows of a text's bigrams that count as notices."""
    orders = [sequence(t) for t in templates.values()]
    anchored = [set(anchors(sorted(set(o)), tenths)) for o in orders]
    places = _literal(f"named_struct('gram', {g!r}, 'k', {k}, 'p', {p})" for k, o in enumerate(orders) for p, g in enumerate(o) if g in anchored[k])
    names, lengths = F.array(*map(F.lit, templates)), _literal(str(len(o)) for o in orders)
    sizes, grams = _literal(str(len(set(o))) for o in orders), _literal(f"array({', '.join(map(repr, sorted(set(o))))})" for o in orders)

    def scored(c: Column, seq: Column) -> Column:
        first = F.greatest(c["start"], F.lit(0))
        window = F.array_distinct(F.slice(seq, first + 1, c["start"] + F.get(lengths, c["k"]) - first))
        return F.transform(
            F.array(window),
            lambda w: F.struct(c["k"].alias("k"), c["start"].alias("start"), F.size(F.array_intersect(w, F.get(grams, c["k"]))).alias("n_common"), F.size(w).alias("n_unit"), F.get(sizes, c["k"]).alias("n_template")),
        )[0]

    def overlap(x: Column, y: Column) -> Column:
        return (x["k"] == y["k"]) & (y["start"] - x["start"] < F.get(lengths, x["k"]))

    def kept(found: Column) -> Column:
        at = lambda i: F.get(found, i)
        value = lambda x, y: x["n_common"] * (y["n_unit"] + y["n_template"])  # noqa: E731  - Dice of x against that of y, without a division
        shifted = lambda x, i: (overlap(at(i - 1), x) & (value(at(i - 1), x) >= value(x, at(i - 1)))) | (overlap(x, at(i + 1)) & (value(at(i + 1), x) > value(x, at(i + 1))))
        return F.filter(found, lambda x, i: ~F.coalesce(shifted(x, i), F.lit(False)))

    def of(seq: Column) -> Column:
        hits = F.filter(F.transform(seq, lambda g, i: F.struct(g.alias("gram"), i.alias("i"))), lambda h: h["gram"].isin(*sorted(set().union(*anchored))))
        starts = F.flatten(F.transform(hits, lambda h: F.transform(F.filter(places, lambda a: a["gram"] == h["gram"]), lambda a: a["k"] * F.lit(1 << 40) + (h["i"] - a["p"] + (1 << 20)))))
        # Template and start in one number: equal structs are told apart pair by pair.
        each = F.transform(F.array_sort(F.array_distinct(starts)), lambda c: F.transform(F.array(_template_and_start(c)), lambda x: scored(x, seq))[0])
        reached = F.filter(each, lambda x: x["n_common"] * 20 >= (x["n_unit"] + x["n_template"]) * tenths)
        return F.transform(
            F.transform(F.array(reached), kept)[0],
            lambda x: F.struct(F.get(names, x["k"]).alias("license_id"), x["n_common"].alias("n_common"), x["n_unit"].alias("n_unit"), x["n_template"].alias("n_template"), F.greatest(x["start"], F.lit(0)).alias("first_word")),
        )

    # Bound to a lambda's variable, the array is made once for all windows.
    return F.transform(F.array(F.transform(seq, lambda g: g)), of)[0]


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, tenths: int = TENTHS) -> DataFrame:
    """``doc_id, unit_no, first_word, license_id, n_common, n_unit, n_template, dice`` of each unit and template that reach ``tenths`` / 10.

    ``first_word`` is where a window starts in the words of the whole text, from 0, and null for other units; a notice alone on a line has a row for the
    line and one for its window.
    ``docs (doc_id, text)``; other columns are ignored.  Null and empty texts have no bigram and match nothing.  Rows that repeat an
    id (or have none) are scanned each.  A unit that reaches several templates, by a tie too, has a row for each.
    """
    known = {k: b for k, t in sorted(templates.items()) if (b := bigrams(t))}
    limits = {k: bounds(len(b), tenths) for k, b in known.items()}
    least, largest = min((lo for lo, _ in limits.values()), default=1), max((hi for _, hi in limits.values()), default=0)
    words_of = telling_words(known, tenths)

    def told(text: str) -> Column:
        return reduce(lambda a, b: a | b, (F.contains(F.col(text), F.lit(w)) for w in words_of), F.lit(False))

    # Values that a filter looks at are made by a generator: else the filter goes below and they are made twice.
    docs = docs.select("doc_id", F.explode(F.array(F.translate("text", UPPER, LOWER))).alias("low")).where(told("low"))
    units = docs.select("doc_id", F.posexplode(F.concat(F.array("low"), F.split("low", "\n", -1))).alias("unit_no", "unit")).where(told("unit"))
    plain = F.trim(F.regexp_replace("unit", "[^a-z0-9]+", " "))
    # Too few words for the smallest template: most lines of most texts stay out of what follows.
    words = units.select("doc_id", "unit_no", F.explode(F.array(F.split(plain, " "))).alias("w")).where(F.size("w") > least)
    pairs = F.zip_with(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1), lambda a, b: F.concat_ws(" ", a, b))
    grams = words.select("doc_id", "unit_no", F.explode(F.array(pairs)).alias("seq")).select("doc_id", "unit_no", "seq", F.explode(F.array(F.array_distinct("seq"))).alias("grams"))
    # Templates as structs in one array; there are a fixed few.
    all_of = F.array(
        *(F.struct(F.lit(k).alias("license_id"), F.lit(len(b)).alias("n_template"), F.lit(limits[k][0]).alias("lo"), F.lit(limits[k][1]).alias("hi"), _literal(map(repr, b)).alias("template")) for k, b in known.items())
    )
    fit = F.filter(all_of, lambda t: F.size("grams").between(t["lo"], t["hi"]))
    whole = F.transform(
        fit,
        lambda t: F.struct(t["license_id"].alias("license_id"), F.size(F.array_intersect("grams", t["template"])).alias("n_common"), F.size("grams").alias("n_unit"), t["n_template"].alias("n_template"), F.lit(None).cast("int").alias("first_word")),
    )
    none = F.expr("cast(array() as array<struct<license_id:string,n_common:int,n_unit:int,n_template:int,first_word:int>>)")
    whole = F.when(F.size("grams").between(least, largest), F.filter(whole, lambda x: x["n_common"] * 20 >= (x["n_unit"] + x["n_template"]) * tenths)).otherwise(none)
    windows = F.when(F.col("unit_no") == 0, _windows(F.col("seq"), {k: templates[k] for k in known}, tenths)).otherwise(none)
    found = grams.select("doc_id", "unit_no", F.explode(F.concat(whole, windows)).alias("f"))
    return found.select(
        "doc_id",
        F.when(F.col("f.first_word").isNull(), F.col("unit_no")).otherwise(-1).alias("unit_no"),
        F.col("f.first_word"),
        F.col("f.license_id"),
        F.col("f.n_common"),
        F.col("f.n_unit"),
        F.col("f.n_template"),
        (F.col("f.n_common") * 2.0 / (F.col("f.n_unit") + F.col("f.n_template"))).alias("dice"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def _duckdb(templates: dict[str, str] = TEMPLATES, tenths: int = TENTHS) -> str:
    known = {k: t for k, t in sorted(templates.items()) if bigrams(t)}
    rows = ", ".join(f"('{k}', {len(bigrams(t))}, {len(sequence(t))}, [{', '.join(map(repr, bigrams(t)))}])" for k, t in known.items())
    anchor_rows = ", ".join(f"('{k}', {p}, '{g}')" for k, t in known.items() for chosen in [anchors(bigrams(t), tenths)] for p, g in enumerate(sequence(t)) if g in chosen)
    return f"""WITH t(license_id, n_template, n_words, template) AS (VALUES {rows}),
anchor(license_id, p, gram) AS (VALUES {anchor_rows}),
lines AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
units AS (SELECT r, doc_id, 0 AS unit_no, text AS unit FROM lines UNION ALL SELECT r, doc_id, unnest(range(1, len(ls) + 1)), unnest(ls) FROM lines),
words AS (SELECT r, doc_id, unit_no, string_split(trim(regexp_replace(translate(unit, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM units),
seqs AS (SELECT r, doc_id, unit_no, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS seq FROM words WHERE len(w) > 1),
pairs AS (SELECT doc_id, unit_no, NULL::BIGINT AS first_word, license_id, len(list_intersect(grams, template)) AS n_common, len(grams) AS n_unit, n_template
  FROM (SELECT *, list_distinct(seq) AS grams FROM seqs) JOIN t ON len(grams) * {20 - tenths} >= n_template * {tenths} AND len(grams) * {tenths} <= n_template * {20 - tenths}
  WHERE len(list_intersect(grams, template)) * 20 >= (len(grams) + n_template) * {tenths}),
grams AS (SELECT r, unnest(seq) AS gram, unnest(range(0, len(seq))) AS i FROM seqs WHERE unit_no = 0),
starts AS (SELECT DISTINCT r, license_id, i - p AS start FROM grams JOIN anchor USING (gram)),
windows AS (SELECT r, doc_id, license_id, start, n_words, n_template, template, list_distinct(seq[greatest(start, 0) + 1 : start + n_words]) AS held
  FROM starts JOIN t USING (license_id) JOIN (SELECT r, doc_id, seq FROM seqs WHERE unit_no = 0) USING (r)),
reached AS (SELECT r, doc_id, license_id, start, n_words, n_template, len(held) AS n_unit, len(list_intersect(held, template)) AS n_common FROM windows
  WHERE len(list_intersect(held, template)) * 20 >= (len(held) + n_template) * {tenths}),
beside AS (SELECT *, n_unit + n_template AS size, lag(start) OVER o AS start_a, lag(n_common) OVER o AS common_a, lag(n_unit) OVER o + n_template AS size_a,
  lead(start) OVER o AS start_z, lead(n_common) OVER o AS common_z, lead(n_unit) OVER o + n_template AS size_z FROM reached WINDOW o AS (PARTITION BY r, license_id ORDER BY start)),
every AS (SELECT * FROM pairs UNION ALL SELECT doc_id, -1, greatest(start, 0), license_id, n_common, n_unit, n_template FROM beside
  WHERE NOT coalesce(start - start_a < n_words AND common_a * size >= n_common * size_a, false) AND NOT coalesce(start_z - start < n_words AND common_z * size > n_common * size_z, false))
SELECT doc_id, CAST(unit_no AS INTEGER) AS unit_no, CAST(first_word AS INTEGER) AS first_word, license_id, CAST(n_common AS INTEGER) AS n_common, CAST(n_unit AS INTEGER) AS n_unit,
  CAST(n_template AS INTEGER) AS n_template, CAST(n_common * 2 AS DOUBLE) / (n_unit + n_template) AS dice FROM every"""


ORACLE = _duckdb()
