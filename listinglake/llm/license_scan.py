"""License scans: passages compared with licence templates by Dice over word bigrams.

A document's passages are its lines, its paragraphs, the whole text, and windows of words
anywhere in it.  Passage and template are normalised to lower-case words; their distinct
pairs of neighbouring words are compared by Dice, 2 * common / (size + size), and a passage
matches from THRESHOLD on.

Windows find licences that fill no line or paragraph: in comment blocks, inside a longer
line, or followed by code or prose.  A pair at a window's end that the template lacks only
lowers Dice, and a further pair of the template never does, so the best window begins and
ends with a whole run of template pairs.  At most (2/t - 2) * n pairs between its runs may
be foreign to a template of n pairs; here a foreign pair counts as often as it stands there.
All windows that keep to this are compared.  Of a template's windows that overlap the best
one counts, and none counts whose words stand in a line, paragraph or text that matches at
least as well, or in a window that matches better.  The passage of a window is its words
with spaces between.

Two bounds keep the comparisons of lines, paragraphs and texts few, and neither can lose a
match:

* A passage with many words that no template has cannot match.  Each such word but one
  spoils a bigram, and at most (2/t - 2) * common bigrams may be spoiled.
* Sizes: 2 * min >= t * (a + b), so a passage is compared only with templates whose size is
  within a factor (2 - t) / t.  Templates are listed under every size they can match, and
  passages meet them in an equi-join on their size.

Only DataFrame functions are used.  The templates are a parameter of at most
MAX_TEMPLATES, which bounds what is broadcast.

Results for odd input: null, empty and one-word texts match nothing (license null, dice 0);
of equally good templates the one with more common bigrams wins, then the name that
sorts first, then the passage that sorts first; rows that repeat are judged each; rows
without id are kept.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.common import table
from listinglake.llm.decontaminate import words

THRESHOLD = 0.8
MAX_TEMPLATES = 1000


class Template(NamedTuple):
    license: str
    text: str


# ---- fixed values: wording of public licences and of the notices that name them ----
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
    "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
    "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    'software and associated documentation files (the "Software"), to deal in the Software '
    "without restriction, including without limitation the rights to use, copy, modify, "
    "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions:"
)
_MIT_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies "
    "or substantial portions of the Software."
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms "
    "of the GNU {kind}General Public License as published by the Free Software Foundation, "
    "either version {version} of the License, or (at your option) any later version."
)

TEMPLATES = [
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Template(
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
        "agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
        "implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    Template("MIT", "Released under the MIT License."),
    Template("MIT", "Licensed under the MIT License."),
    Template("MIT", _MIT_GRANT),
    Template("MIT", f"{_MIT_GRANT} {_MIT_NOTICE} {_WARRANTY}"),
    Template(
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    Template(
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ),
    Template("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    Template("GPL-3.0", _GNU.format(kind="", version="3")),
    Template("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    Template("GPL-2.0", _GNU.format(kind="", version="2")),
    Template("LGPL-3.0", _GNU.format(kind="Lesser ", version="3")),
    Template("AGPL-3.0", _GNU.format(kind="Affero ", version="3")),
    Template(
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    Template(
        "Unlicense",
        "This is free and unencumbered software released into the public domain.",
    ),
    Template("CC-BY-4.0", "Licensed under CC BY 4.0."),
    Template("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    Template("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    Template("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    Template(
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    Template(
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License.",
    ),
    Template(
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
]
# ---- end of fixed values ----


def passages(text: Column) -> Column:
    """Lines, paragraphs and the whole of a text, each once."""
    text = F.coalesce(text, F.lit(""))
    return F.array_distinct(
        F.concat(F.split(text, "\n"), F.split(text, "\n[ \t\r\n]*\n"), F.array(text))
    )


def pairs(word_list: Column) -> Column:
    """Pairs of neighbours, written with a space between."""
    return F.zip_with(
        F.slice(word_list, 1, F.greatest(F.size(word_list) - 1, F.lit(0))),
        F.slice(word_list, 2, F.greatest(F.size(word_list) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def bigrams(word_list: Column) -> Column:
    return F.array_distinct(pairs(word_list))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with ``value`` computed once a row also if lambdas refer to it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


WINDOW = "struct<dice:double,common:int,start:int,stop:int>"


def _runs(hits: Column) -> Column:
    """Runs of hits side by side: foreign pairs before the run, first and last hit."""

    def cut(foreign: Column) -> Column:
        first = F.filter(
            F.transform(
                foreign, lambda g, k: F.when((k == 0) | (F.get(foreign, k - 1) != g), k)
            ),
            lambda k: k.isNotNull(),
        )
        return let(
            first,
            lambda starts: F.transform(
                starts,
                lambda k, r: F.struct(
                    F.get(foreign, k).alias("foreign"),
                    k.alias("first"),
                    (F.coalesce(F.get(starts, r + 1), F.size(foreign)) - 1).alias("last"),
                ),
            ),
        )

    return let(F.transform(hits, lambda h, k: h["place"] - k), cut)


def _windows_of(hits: Column, every: Column, threshold: float) -> Column:
    """Matching windows of the row's template (theirs, n, least, spare), as array of WINDOW.

    hits: (place, pair) of the template's pairs among ``every`` pair of the text.
    """

    def from_run(a: Column, r: Column, runs: Column, pair: Column) -> Column:
        def common(b: Column) -> Column:
            part = F.slice(pair, a["first"] + 1, b["last"] - a["first"] + 1)
            return F.size(F.array_distinct(part))

        def measure(b: Column) -> Column:
            start, stop = a["foreign"] + a["first"], b["foreign"] + b["last"]
            ours = F.size(F.array_distinct(F.slice(every, start + 1, stop - start + 1)))
            return F.struct(
                (F.lit(2.0) * common(b) / (ours + F.col("n"))).alias("dice"),
                common(b).alias("common"),
                start.alias("start"),
                stop.alias("stop"),
            )

        near = F.filter(
            F.slice(runs, r + 1, F.col("spare") + 1),
            lambda b: b["foreign"] - a["foreign"] <= F.col("spare"),
        )
        return let(
            near,
            lambda ends: F.when(
                common(F.element_at(ends, -1)) >= F.col("least"),
                F.array_max(F.transform(ends, measure)),
            ),
        )

    def add(kept: Column, w: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        return (
            F.when(last.isNull() | (w["start"] > last["stop"]), F.concat(kept, F.array(w)))
            .when(
                w["dice"] > last["dice"],
                F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(w)),
            )
            .otherwise(kept)
        )

    found = let(
        F.transform(hits, lambda h: h["pair"]),
        lambda pair: let(
            _runs(hits),
            lambda runs: F.transform(runs, lambda a, r: from_run(a, r, runs, pair)),
        ),
    )
    return F.aggregate(
        F.filter(found, lambda w: w["dice"] >= threshold),
        F.expr(f"cast(array() as array<{WINDOW}>)"),
        add,
    )


def windows(docs: DataFrame, templates: DataFrame, threshold: float) -> DataFrame:
    """Matching windows of ``docs`` (id, print, text): (id, print, license, dice, common, text)."""
    known = templates.select(
        "license",
        "theirs",
        "n",
        F.expr(f"cast(ceil({threshold} * n / {2 - threshold} - 1e-9) as int)").alias("least"),
        F.expr(f"cast(floor({2 / threshold - 2} * n + 1e-9) as int)").alias("spare"),
    )
    # The pairs of the given templates: as bounded as the parameter is.
    some = sorted({b for r in templates.select("theirs").collect() for b in r["theirs"]})
    firsts = sorted({b.split(" ")[0] for b in some})
    seconds = sorted({b.split(" ")[1] for b in some})

    def known_pairs(w: Column) -> Column:
        """Places and pairs; a pair is only written out where both its words are known."""
        places = F.filter(
            F.sequence(F.lit(0), F.size(w) - 2),
            lambda p: F.get(w, p).isin(firsts) & F.get(w, p + 1).isin(seconds),
        )
        made = F.transform(
            F.when(F.size(w) > 1, places),
            lambda p: F.struct(
                p.alias("place"), F.concat(F.get(w, p), F.lit(" "), F.get(w, p + 1)).alias("pair")
            ),
        )
        return F.filter(made, lambda h: h["pair"].isin(some))

    hits = let(words(F.col("text")), known_pairs)
    # A document meets a template only if it holds as many of its pairs as a match needs.
    held = docs.select("id", "print", "text", hits.alias("hits")).where(F.size("hits") > 0)
    held = held.withColumn("ours", F.array_distinct("hits.pair"))
    met = held.join(
        F.broadcast(known), F.size(F.array_intersect("ours", "theirs")) >= F.col("least")
    )
    own = F.filter("hits", lambda h: F.array_contains("theirs", h["pair"]))
    found = let(
        words(F.col("text")),
        lambda w: let(
            pairs(w),
            lambda every: let(
                own,
                lambda h: F.transform(
                    _windows_of(h, every, threshold),
                    lambda x: F.struct(
                        x["dice"].alias("dice"),
                        x["common"].alias("common"),
                        F.array_join(
                            F.slice(w, x["start"] + 1, x["stop"] - x["start"] + 2), " "
                        ).alias("text"),
                    ),
                ),
            ),
        ),
    )
    # Like the other passages, each once.
    return met.select(
        "id", "print", "license", F.explode(F.array_distinct(found)).alias("w")
    ).select("id", "print", "license", "w.dice", "w.common", "w.text")


def scan(
    docs: DataFrame,
    templates: list[Template] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, license, dice, n_matches, passage): a row for every row of ``docs``.

    The best match; ``n_matches`` counts the pairs of passage and template that match.
    """
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates")
    spark = docs.sparkSession
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    made = spark.createDataFrame([tuple(t) for t in templates], "license string, text string")
    made = made.select("license", words(F.col("text")).alias("words"))
    # The words of the given templates: as bounded as the parameter is.
    vocabulary = sorted({w for r in made.select("words").collect() for w in r["words"]})
    sizes = F.expr(
        f"sequence(cast(ceil({threshold} * n / {2 - threshold} - 1e-9) as int), "
        f"cast(floor({2 - threshold} * n / {threshold} + 1e-9) as int))"
    )
    made = (
        made.select("license", bigrams(F.col("words")).alias("theirs"))
        .withColumn("n", F.size("theirs"))
        .where("n > 0")
    )
    known = made.select("license", "theirs", F.explode(sizes).alias("size"))

    def may_match(word_list: Column) -> Column:
        known_words = F.filter(word_list, lambda w: w.isin(vocabulary))
        strange = F.filter(word_list, lambda w: ~w.isin(vocabulary))
        spoiled = F.size(F.array_distinct(strange)) - 1
        return (F.size(known_words) > 0) & (
            spoiled <= F.lit(2 / threshold - 2) * F.size(known_words) + 1e-9
        )

    units = F.transform(passages(F.col(text_col)), lambda u: F.struct(u.alias("text"), words(u).alias("words")))
    chosen = F.filter(units, lambda u: may_match(u["words"]))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("print"),
        F.transform(
            chosen,
            lambda u: F.struct(u["text"].alias("text"), bigrams(u["words"]).alias("ours")),
        ).alias("units"),
    )
    # One entry without bigrams stands for the document itself.
    none = F.expr(
        "array(named_struct('text', cast(null as string), 'ours', cast(array() as array<string>)))"
    )
    each = rows.select("id", "print", F.explode(F.concat(none, "units")).alias("u")).select(
        "id", "print", "u.text", "u.ours", F.size("u.ours").alias("size")
    )
    compared = (
        each.join(F.broadcast(known), "size", "left")
        .withColumn("common", F.size(F.array_intersect("ours", "theirs")))
        .withColumn(
            "dice",
            F.when(
                F.col("common") > 0,
                F.lit(2.0) * F.col("common") / (F.size("ours") + F.size("theirs")),
            ),
        )
        .withColumn("match", F.coalesce(F.col("dice") >= threshold, F.lit(False)))
        .where("match or text is null")
    )
    printed = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("print"), F.col(text_col).alias("text")
    )
    compared = compared.withColumn("window", F.lit(False)).unionByName(
        windows(printed, made, threshold).withColumns(
            {"match": F.lit(True), "window": F.lit(True)}
        ),
        allowMissingColumns=True,
    )
    best = F.struct(
        (-F.col("dice")).alias("dice"), (-F.col("common")).alias("common"), "license", "text"
    )
    # A window counts if its words stand in no passage that matches as well, or better for
    # another window.
    held = F.struct(
        "dice",
        "window",
        F.concat(F.lit(" "), F.array_join(words(F.col("text")), " "), F.lit(" ")).alias("words"),
    )

    def counts(w: Column) -> Column:
        return ~F.exists(
            "held",
            lambda o: F.when(o["window"], o["dice"] > w["dice"]).otherwise(o["dice"] >= w["dice"])
            & F.contains(o["words"], w["words"]),
        )

    return (
        compared.groupBy("id", "print")
        .agg(
            F.count_if(F.col("text").isNull()).alias("times"),
            F.collect_list(F.when(F.col("match"), held)).alias("held"),
            F.min(F.when(F.col("match"), best)).alias("best"),
        )
        .withColumn(
            "n_matches",
            F.size(F.filter("held", lambda w: ~w["window"] | counts(w))).cast("long"),
        )
        .select(
            F.explode(F.expr("array_repeat(struct(id), cast(times as int))")).alias("row"),
            "n_matches", "best",
        )
        .select(
            "row.id",
            "best.license",
            F.coalesce(-F.col("best.dice"), F.lit(0.0)).alias("dice"),
            "n_matches",
            F.col("best.text").alias("passage"),
        )
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs).withColumnRenamed("id", "doc_id")


def _sql_words(column: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        "'abcdefghijklmnopqrstuvwxyz'), "
        r"'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w != '')"
    ).replace("\\\\", "\\")


def _sql_bigrams(column: str) -> str:
    return (
        f"list_distinct(list_transform(range(1, len({column})), "
        f"lambda i: {column}[i] || ' ' || {column}[i + 1]))"
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP10_SQL = f"""
WITH templates AS (
    SELECT license, {_sql_words('text')} AS w
    FROM (VALUES {', '.join(f'({_quoted(t.license)}, {_quoted(t.text)})' for t in TEMPLATES)})
         AS t(license, text)
),
known AS (SELECT license, {_sql_bigrams('w')} AS theirs FROM templates),
units AS (
    SELECT doc_id, unnest(list_distinct(list_concat(list_concat(
        string_split(text, chr(10)), regexp_split_to_array(text, '\\n[ \\t\\r\\n]*\\n')), [text])))
        AS unit
    FROM documents WHERE text IS NOT NULL
),
split AS (SELECT doc_id, unit, {_sql_words('unit')} AS w FROM units),
pairs AS (SELECT doc_id, unit, {_sql_bigrams('w')} AS ours FROM split WHERE len(w) > 1),
scored AS (
    SELECT doc_id, unit, license, len(list_intersect(ours, theirs)) AS common,
           2.0::DOUBLE * len(list_intersect(ours, theirs)) / (len(ours) + len(theirs)) AS dice
    FROM pairs JOIN known ON len(ours) <= 2 * len(theirs) AND len(theirs) <= 2 * len(ours)
),
ranked AS (
    SELECT doc_id, unit, license, dice, count(*) OVER (PARTITION BY doc_id) AS n,
           row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, common DESC, license, unit)
               AS rank
    FROM scored WHERE dice >= {THRESHOLD}
)
SELECT d.doc_id, license, coalesce(dice, 0.0::DOUBLE) AS dice, coalesce(n, 0)::BIGINT AS n_matches,
       unit AS passage
FROM documents d LEFT JOIN ranked r ON d.doc_id = r.doc_id AND rank = 1
"""
