"""Licence scans: units of a text against licence templates by Dice over word bigrams.

Words are runs of ASCII letters and digits, lowered. A unit is the whole text, a paragraph, a
line or a sentence; it is compared by the set of its word bigrams. For a threshold t only a
unit of t/(2-t) to (2-t)/t times a template's bigrams can reach it, which prunes templates by
size before any comparison.

The same bound tells which texts need not be cut into units at all: a unit that reaches t
shares at least t/(2-t) of the template's bigrams, so it holds one of any
`bigrams - that + 1` of them. Those with the longest words are taken as marks; a text without
any mark has no licence. Only DataFrame functions are used, the templates are literals.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenurelens.llm.rules import let
from tenurelens.llm.scratch import cut

_MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and
associated documentation files the software to deal in the software without restriction including without limitation
the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and
this permission notice shall be included in all copies or substantial portions of the software the software is
provided as is without warranty of any kind express or implied including but not limited to the warranties of
merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright
holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising
from out of or in connection with the software or the use or other dealings in the software"""

_BSD_HEAD = """redistribution and use in source and binary forms with or without modification are permitted provided
that the following conditions are met 1 redistributions of source code must retain the above copyright notice this
list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright
notice this list of conditions and the following disclaimer in the documentation and or other materials provided with
the distribution"""

_BSD_TAIL = """this software is provided by the copyright holders and contributors as is and any express or implied
warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose
are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental
special exemplary or consequential damages including but not limited to procurement of substitute goods or services
loss of use data or profits or business interruption however caused and on any theory of liability whether in contract
strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if
advised of the possibility of such damage"""

#: (licence, text): full texts, usual notices and one-line statements
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", _MIT),
    ("MIT", "released under the mit license"),
    ("MIT", "licensed under the mit license"),
    ("BSD-2-Clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    ("BSD-3-Clause", f"""{_BSD_HEAD} 3 neither the name of the copyright holder nor the names of its contributors may
    be used to endorse or promote products derived from this software without specific prior written permission
    {_BSD_TAIL}"""),
    ("BSD", "use of this source code is governed by a bsd style license that can be found in the license file"),
    ("ISC", """permission to use copy modify and or distribute this software for any purpose with or without fee is
    hereby granted provided that the above copyright notice and this permission notice appear in all copies the
    software is provided as is and the author disclaims all warranties with regard to this software including all
    implied warranties of merchantability and fitness in no event shall the author be liable for any special direct
    indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in
    an action of contract negligence or other tortious action arising out of or in connection with the use or
    performance of this software"""),
    ("Apache-2.0", """licensed under the apache license version 2 0 the license you may not use this file except in
    compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0
    unless required by applicable law or agreed to in writing software distributed under the license is distributed
    on an as is basis without warranties or conditions of any kind either express or implied see the license for the
    specific language governing permissions and limitations under the license"""),
    ("Apache-2.0", "licensed under the apache license version 2 0"),
    ("GPL-3.0", "this work is licensed under the gnu general public license version 3"),
    ("GPL-2.0", "this work is licensed under the gnu general public license version 2"),
    ("GPL-3.0-or-later", """this program is free software you can redistribute it and or modify it under the terms of
    the gnu general public license as published by the free software foundation either version 3 of the license or at
    your option any later version this program is distributed in the hope that it will be useful but without any
    warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu
    general public license for more details"""),
    ("GPL-2.0-or-later", """this program is free software you can redistribute it and or modify it under the terms of
    the gnu general public license as published by the free software foundation either version 2 of the license or at
    your option any later version this program is distributed in the hope that it will be useful but without any
    warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu
    general public license for more details"""),
    ("LGPL-3.0", "this work is licensed under the gnu lesser general public license version 3"),
    ("AGPL-3.0", "this work is licensed under the gnu affero general public license version 3"),
    ("MPL-2.0", """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the
    mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"""),
    ("CC-BY-4.0", "licensed under cc by 4 0"),
    ("CC-BY-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("CC-BY-SA-4.0", "licensed under cc by sa 4 0"),
    ("CC-BY-SA-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("CC-BY-NC-4.0", "licensed under cc by nc 4 0"),
    ("CC-BY-NC-4.0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("CC-BY-ND-4.0", "licensed under cc by nd 4 0"),
    ("CC0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("Unlicense", """this is free and unencumbered software released into the public domain anyone is free to copy
    modify publish use compile sell or distribute this software either in source code form or as a compiled binary for
    any purpose commercial or non commercial and by any means"""),
    ("BSL-1.0", "distributed under the boost software license version 1 0"),
)


#: what separates paragraphs, and the least number of words in a run of them
PARAGRAPHS = r"\n[\x20\x09-\x0D]*\n"
SHORTEST_RUN = 40


def bigrams(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def marks(threshold: float, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> list[str]:
    """Bigrams of which every unit that reaches the threshold holds at least one."""
    out: set[str] = set()
    for _, text in templates:
        grams = bigrams(text)
        need = math.ceil(threshold / (2 - threshold) * len(grams) - 1e-9)
        rare = sorted(grams, key=lambda g: (-min(map(len, g.split())), -len(g), g))
        out.update(rare[: len(grams) - need + 1])
    return sorted(out)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[^A-Za-z0-9]+"), lambda w: w != "")


def _pairs(w: Column) -> Column:
    """Distinct bigrams of an array of words."""
    n = F.size(w)
    joined = F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.lower(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1))))
    return F.when(n >= 2, F.array_distinct(joined)).otherwise(F.array().cast("array<string>"))


def units(text: Column) -> Column:
    """The text, its paragraphs, lines and sentences."""
    sentences = F.split(F.regexp_replace(text, r"([.!?])[\x20\x09-\x0D]+", "$1\u0001"), "\u0001")
    return F.array_distinct(
        F.concat(
            F.array(text),
            F.split(text, PARAGRAPHS),
            F.split(text, "\n"),
            sentences,
        )
    )


def longest_run(threshold: float, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> int:
    """Words that a run of paragraphs may have: the upper size bound of the largest template."""
    return math.ceil((2 - threshold) / threshold * max(len(bigrams(text)) for _, text in templates)) + 1


def runs(hits: DataFrame, longest: int, is_marked) -> DataFrame:
    """doc_id, unit: every run of two and more neighbouring paragraphs of SHORTEST_RUN to `longest` words.

    Paragraphs without words do not count. Runs without a mark are left out early; a mark may also
    lie across two paragraphs. A paragraph begins at most as many runs as `longest` has words.
    """
    order = Window.partitionBy("row").orderBy("pos")
    paragraphs = hits.select("row", "doc_id", F.posexplode(F.split(F.col("text"), PARAGRAPHS)).alias("pos", "para"))
    counted = paragraphs.withColumn("w", _words(F.col("para"))).withColumn("n", F.size("w")).where(F.col("n") > 0)
    placed = counted.select(
        "row", "doc_id", "para", "n",
        (F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("begin"),
        let(F.concat("w", F.coalesce(F.slice(F.lead("w").over(order), 1, 1), F.array().cast("array<string>"))), is_marked).alias("marked"),
    )
    ahead = Window.partitionBy("row").orderBy("begin").rangeBetween(0, longest)
    listed = placed.select("doc_id", F.collect_list(F.struct("para", "n", "begin", "marked")).over(ahead).alias("run"))
    longer = listed.where((F.size("run") > 1) & F.exists("run", lambda p: p["marked"]))
    each = longer.select("doc_id", "run", F.explode(F.sequence(F.lit(2), F.size("run"))).alias("k"))
    last, first = F.get("run", F.col("k") - 1), F.get("run", F.lit(0))
    size = last["begin"] + last["n"] - first["begin"]
    part = each.where(size.between(SHORTEST_RUN, longest)).select("doc_id", F.slice("run", F.lit(1), F.col("k")).alias("run"))
    return part.where(F.exists("run", lambda p: p["marked"])).select(
        "doc_id", F.array_join(F.transform("run", lambda p: p["para"]), "\n\n").alias("unit")
    )


def scan(
    docs: DataFrame, threshold: float = 0.8, templates: tuple[tuple[str, str], ...] = TEMPLATES
) -> DataFrame:
    """doc_id, license, dice, n_units: the licences of docs (doc_id, text) with their best match.

    Units are the text, its paragraphs, lines and sentences, and runs of neighbouring paragraphs
    whose words lie between SHORTEST_RUN and the largest template's size bound, as licences are
    published in several paragraphs. Every unit counts for the template it is nearest to (of equals, the first licence by name),
    if Dice reaches the threshold. n_units are the units of a document found for a licence.
    Null and empty texts and texts without a licence have no row; rows that share a doc_id are
    reported together, null ids as well. An empty table gives an empty result; other columns
    are ignored.
    """
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    known = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    wanted = marks(threshold, templates)

    def is_mark(w: Column):
        return lambda i: F.lower(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1))).isin(wanted)

    def is_marked(w: Column):
        return (F.size(w) >= 2) & F.exists(F.sequence(F.lit(0), F.greatest(F.size(w) - 2, F.lit(0))), is_mark(w))

    # words are bound once: a filter would else split the text anew for each of them
    hits = known.where(let(_words(F.col("text")), is_marked))
    single = hits.select("doc_id", F.explode(units(F.col("text"))).alias("unit"))
    # the number of a row is fixed where it is written
    several = cut(hits.where(F.col("text").rlike(PARAGRAPHS)).withColumn("row", F.monotonically_increasing_id()))
    cut_up = single.unionAll(runs(several, longest_run(threshold, templates), is_marked))
    sizes = [len(bigrams(text)) for _, text in templates]
    of_size = F.filter(
        F.array(let(_words(F.col("unit")), _pairs)),
        lambda g: F.size(g).between(math.floor(low * min(sizes)), math.ceil(high * max(sizes))),
    )
    spoken = cut(cut_up.select("doc_id", F.explode(of_size).alias("grams")))
    scores = []
    for name, text in templates:
        grams = bigrams(text)
        size = F.size("grams")
        fits = (size >= low * len(grams) - 1e-9) & (size <= high * len(grams) + 1e-9)
        shared = F.size(F.array_intersect("grams", F.array(*map(F.lit, grams))))
        dice = F.when(fits, 2.0 * shared / (size + len(grams)))
        scores.append(F.struct((-F.coalesce(dice, F.lit(0.0))).alias("d"), F.lit(name).alias("license")))
    best = F.filter(F.array(F.array_min(F.array(*scores))), lambda b: -b["d"] >= threshold)
    found = spoken.where(F.size("grams") > 0).select("doc_id", F.explode(best).alias("b"))
    return found.groupBy("doc_id", F.col("b.license").alias("license")).agg(
        F.max(-F.col("b.d")).alias("dice"), F.count(F.lit(1)).alias("n_units")
    )


def oracle(threshold: float = 0.8, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> str:
    """The scan as DuckDB SQL: every unit against every template, without size bounds or marks."""
    lines = ", ".join(f"({i}, '{name}', '{' '.join(text.split())}')" for i, (name, text) in enumerate(templates))
    longest = longest_run(threshold, templates)
    return rf"""
WITH t AS (SELECT * FROM (VALUES {lines}) v(k, license, body)),
tw AS (SELECT k, license, string_split(body, ' ') AS w FROM t),
tg AS (SELECT k, license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM tw),
para AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(string_split(regexp_replace(text, '\n[\x20\x09-\x0D]*\n', chr(1), 'g'), chr(1)),
    lambda p: regexp_matches(p, '[A-Za-z0-9]')) AS p FROM documents
), sized AS (
  SELECT doc_id, r, p, list_transform(p, lambda x: len(list_filter(regexp_split_to_array(x, '[^A-Za-z0-9]+'), lambda w: w <> ''))) AS n FROM para
), run AS (
  SELECT doc_id, array_to_string(p[i:j], chr(10) || chr(10)) AS unit
  FROM (SELECT *, unnest(range(i + 1, least(len(p), i + {longest}) + 1)) AS j FROM (SELECT *, unnest(range(1, len(p))) AS i FROM sized))
  WHERE list_sum(n[i:j]) BETWEEN {SHORTEST_RUN} AND {longest}
), u AS (
  SELECT doc_id, unnest(list_distinct(list_concat([text], list_concat(
    string_split(regexp_replace(text, '\n[\x20\x09-\x0D]*\n', chr(1), 'g'), chr(1)), list_concat(string_split(text, chr(10)),
    string_split(regexp_replace(text, '([.!?])[\x20\x09-\x0D]+', '\1' || chr(1), 'g'), chr(1))))))) AS unit
  FROM documents
  UNION ALL SELECT doc_id, unit FROM run
), uw AS (
  SELECT doc_id, row_number() OVER () AS id, list_filter(regexp_split_to_array(
    translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM u
), ug AS (
  SELECT doc_id, id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM uw WHERE len(w) > 1
), flat AS (SELECT doc_id, id, len(g) AS n, unnest(g) AS x FROM ug),
tflat AS (SELECT k, license, len(g) AS m, unnest(g) AS x FROM tg),
d AS (
  SELECT doc_id, id, k, license, 2.0::DOUBLE * count(*) / (any_value(n) + any_value(m)) AS dice
  FROM flat JOIN tflat USING (x) GROUP BY doc_id, id, k, license
), b AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY dice DESC, license) AS r FROM d
)
SELECT doc_id, license, max(dice) AS dice, count(*) AS n_units FROM b WHERE r = 1 AND dice >= {threshold} GROUP BY 1, 2
"""
