"""Licence scans, with DataFrame functions only.

1. The passages of a text are its sentences, its lines, its blocks between blank lines, and the whole text.
   Headers, statements and whole licence files are all passages.
2. Licence templates and passages are sparse TF-IDF vectors over words; document frequencies of the
   template words are counted over all texts, any other word weighs as the median of those that occur, so a line with a name or
   a year scores alike in small and large tables. A passage is scored by its cosine to each template.
3. Prefix filter: of each template the most frequent words are left out while their norm is under the
   threshold. A passage with none of the others, the anchors, can't reach the threshold, so only texts and
   passages with one go on; nothing that would match is lost.
4. A file's own licence is that of its best passage. Licence files (by name, or by a text that as a
   whole is a licence) give theirs to their directory; a file without its own inherits from
   the nearest ancestor directory that has one, by joins on paths.

Templates are fixed texts, so everything that is broadcast or held as a literal is bounded by them.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.shared import materialize, table

#: Cosine from which a passage is a licence statement.
THRESHOLD = 0.6
#: Cosine from which a whole text is a licence file.
WHOLE = 0.9

# Customary statements and texts of licences, by SPDX id.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Apache License Version 2.0, January 2004 TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    "ISC": ("Licensed under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "ISC License. Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal Public Domain Dedication"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
#: Base names of licence files.
LICENCE_FILES = r"(?i)^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"

#: What separates words.
_BETWEEN = r"[^a-z0-9.]+"
_BLANK_LINE = r"\n[ \t\r]*\n"
_SENTENCE = r"[.!?][ \t\r\n]+"
#: Dropped at both ends of a passage.
_ENDS = " \t\r\n.!?"
#: Rows up to which a table of directories is broadcast, and the salts by which a larger one is joined.
BROADCAST_ROWS, SALTS = 200_000, 16


def template_words(text: str) -> list[str]:
    return [w for w in (x.strip(".") for x in re.split(_BETWEEN, text.lower())) if w]


def words_of(text: Column) -> Column:
    """The words of a passage: lower case, dots at their ends dropped."""
    return F.filter(F.transform(F.split(F.lower(text), _BETWEEN), lambda w: F.btrim(w, F.lit("."))), lambda w: w != "")


def templates() -> list[tuple[int, str, Counter]]:
    return [(i, spdx, Counter(template_words(t))) for i, (spdx, t) in enumerate((s, t) for s, texts in TEMPLATES.items() for t in texts)]


def vocabulary() -> list[str]:
    return sorted({w for _, _, c in templates() for w in c})


def inverse_frequency(df: DataFrame) -> tuple[dict[str, float], float]:
    """The weight of each template word, counted over all texts, and that of any other word."""
    literal = F.lit(vocabulary())
    held = df.select(F.explode(F.array_intersect(words_of(F.coalesce("text", F.lit(""))), literal)).alias("word"))
    counts = held.groupBy("word").agg(F.count("*").alias("n"))  # as many rows as there are template words
    total = df.select(F.lit("").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    found = {r.word: r.n for r in counts.unionByName(total).collect()}
    n = found.pop("", 0)
    weight = lambda k: math.log((n + 1) / (k + 1)) + 1
    known = sorted(weight(k) for k in found.values())
    return {w: weight(found.get(w, 0)) for w in vocabulary()}, known[(len(known) - 1) // 2] if known else weight(0)


def unit_templates(idf: dict[str, float]) -> list[tuple[int, str, dict[str, float]]]:
    """Each template's words with their weights, as a vector of norm 1."""
    out = []
    for i, spdx, counts in templates():
        w = {x: n * idf[x] for x, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out.append((i, spdx, {x: v / norm for x, v in w.items()}))
    return out


def anchors(vectors: list[tuple[int, str, dict[str, float]]], idf: dict[str, float], threshold: float) -> list[str]:
    """Words of which a passage holds one if its cosine to any template reaches the threshold.

    A template's most frequent words are left out, then the lightest, as long as the norm of all left out is under the
    threshold: a passage that shares those alone can't reach it. So 'the' and 'of' are no anchors, however often a template has them.
    """
    found = set()
    for _, _, v in vectors:
        room = (threshold * 0.999) ** 2
        for word, x in sorted(v.items(), key=lambda p: (idf[p[0]], p[1], p[0])):
            if x * x < room:
                room -= x * x
            else:
                found.add(word)
    return sorted(found)


def any_of(words: list[str]) -> str:
    """A pattern of the words, branched by their first characters, so that a text's word is compared with few of them."""
    by: dict[str, list[str]] = {}
    for w in words:
        by.setdefault(w[0], []).append(re.escape(w[1:]))
    return "|".join(f"{re.escape(first)}(?:{'|'.join(rest)})" for first, rest in sorted(by.items()))


def passages(df: DataFrame, words: list[str]) -> DataFrame:
    """row, passage of every passage with an anchor. df: row, text."""
    held = rf"(?<![a-z0-9])(?:{any_of(words)})(?![a-z0-9])"
    low = df.where(F.col("text").isNotNull()).select("row", F.lower("text").alias("low")).where(F.col("low").rlike(held))
    parts = F.concat(F.split("low", "\n"), F.split("low", _BLANK_LINE), F.split("low", _SENTENCE), F.array("low"))
    return low.select("row", F.explode(F.array_distinct(F.transform(parts, lambda x: F.btrim(x, F.lit(_ENDS))))).alias("passage")).where(F.col("passage").rlike(held))


def scores(texts: DataFrame, vectors: list[tuple[int, str, dict[str, float]]], idf: dict[str, float], other: float, threshold: float) -> DataFrame:
    """id, spdx, score of the best template of each distinct passage in texts(id, passage)."""
    spark = texts.sparkSession
    weights = F.broadcast(spark.createDataFrame(sorted(idf.items()), "word string, idf double"))
    units = F.broadcast(spark.createDataFrame([(i, s, w, x) for i, s, v in vectors for w, x in sorted(v.items())], "template int, spdx string, word string, unit double"))
    words = texts.select("id", F.explode(words_of(F.col("passage"))).alias("word")).groupBy("id", "word").agg(F.count("*").alias("tf"))
    weighted = words.join(weights, "word", "left").select("id", "word", (F.col("tf") * F.coalesce("idf", F.lit(other))).alias("w"))
    # The norm needs all words, the products those of the templates only.
    norms = weighted.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    products = weighted.join(units, "word").groupBy("id", "template", "spdx").agg(F.sum(F.col("w") * F.col("unit")).alias("dot"))
    cosine = products.join(norms, "id").select("id", "spdx", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= threshold)
    best = cosine.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("less"), "spdx")).alias("best"))
    return best.select("id", F.col("best.spdx").alias("spdx"), (-F.col("best.less")).alias("score"))


def directory(path: Column) -> Column:
    """All before the last slash; '' is the root."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(path: Column) -> Column:
    """A directory and those above it, as (depth, ancestor) structs; '' is the root."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("ancestor")))
    return F.filter(above, lambda x: x["ancestor"].isNotNull())


def own_licences(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """row, spdx, score, n_statements, all_spdx, ids (of its passages that are nearly a template) of every row with one. rows: row, text."""
    idf, other = inverse_frequency(rows)
    vectors = unit_templates(idf)
    # Repeated texts have one key, and repeated passages are scored once.
    found = passages(rows, anchors(vectors, idf, threshold)).groupBy("row", F.md5("passage").alias("id")).agg(F.first("passage").alias("passage"))
    found = materialize(found, "licence_passages")
    scored = scores(found.groupBy("id").agg(F.first("passage").alias("passage")), vectors, idf, other, threshold)
    hits = found.select("row", "id").join(scored, "id")
    return hits.groupBy("row").agg(F.min(F.struct((-F.col("score")).alias("less"), "spdx")).alias("best"), F.count("*").alias("n_statements"), F.array_sort(F.collect_set("spdx")).alias("all_spdx"), F.collect_set(F.when(F.col("score") >= WHOLE, F.col("id"))).alias("ids")).select(
        "row", F.col("best.spdx").alias("spdx"), (-F.col("best.less")).alias("score"), "n_statements", "all_spdx", "ids"
    )


def salted_join(left: DataFrame, right: DataFrame, key: str, by: Column) -> DataFrame:
    """left's rows with those of right (one a key), a frequent key's rows dealt to SALTS tasks by ``by``; right is small beside left.

    It is a merge join whatever right's size: right grows with the table, so it must not be broadcast.
    """
    each = right.withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(each.hint("merge"), [key, "_salt"], "left").drop("_salt")


def scan(df: DataFrame, path: Column, threshold: float = THRESHOLD) -> DataFrame:
    """df's rows with path, spdx, how ('own', 'inherited' or null), licence_dir, score, n_statements and all_spdx.

    df needs the column ``text``; ``path`` is each row's file path. Null and empty texts have no licence of their own; rows
    with a null path inherit none. Equal rows get equal results; of equally near templates the first SPDX id
    counts. An empty table gives none. Columns of df with the new columns' names, or those of ``inner``, in any case, are left out.
    """
    new = ("path", "spdx", "how", "licence_dir", "score", "n_statements", "all_spdx")
    inner = {"row", "ids", "whole", "dir", "from_dir", "from_spdx", "from_score", "text", "_salt"}
    kept = [c for c in df.columns if c.lower() not in inner and c.lower() not in new]
    keyed = df.select(*[F.col(f"`{c}`") for c in kept], path.alias("path"), "text", F.md5(F.coalesce("text", F.lit(""))).alias("row"))
    own = materialize(own_licences(keyed.select("row", "text"), threshold), "own_licences")
    bare = keyed.select(*[F.col(f"`{c}`") for c in kept], "path", "row", F.md5(F.btrim(F.lower("text"), F.lit(_ENDS))).alias("whole"))
    files = materialize(salted_join(bare, own, "row", F.col("path")).withColumn("whole", F.coalesce(F.array_contains("ids", F.col("whole")), F.lit(False))), "licence_files")
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    licence_files = files.where(F.col("spdx").isNotNull() & F.col("path").isNotNull() & (name.rlike(LICENCE_FILES) | F.col("whole")))
    given = licence_files.groupBy(F.array_join(F.filter(F.split(directory(F.col("path")), "/"), lambda x: x != ""), "/").alias("ancestor")).agg(F.min(F.struct((-F.col("score")).alias("less"), "spdx")).alias("best"))
    need = files.where("spdx is null and path is not null").select(directory(F.col("path")).alias("dir")).distinct()
    above = need.select("dir", F.explode(ancestors(F.col("dir"))).alias("a")).select("dir", "a.depth", "a.ancestor")
    nearest = above.join(given, "ancestor").groupBy("dir").agg(F.max(F.struct("depth", "ancestor", "best")).alias("near"))
    nearest = nearest.select("dir", F.col("near.ancestor").alias("from_dir"), F.col("near.best.spdx").alias("from_spdx"), (-F.col("near.best.less")).alias("from_score"))
    nearest = materialize(nearest, "nearest_licences")
    # Only rows that can inherit are joined.
    heirs = files.where("spdx is null and path is not null").withColumn("dir", directory(F.col("path")))
    heirs = heirs.join(F.broadcast(nearest), "dir", "left") if nearest.count() <= BROADCAST_ROWS else salted_join(heirs, nearest, "dir", F.col("path"))
    joined = heirs.drop("dir").unionByName(files.where("spdx is not null or path is null"), allowMissingColumns=True)
    how = F.when(F.col("spdx").isNotNull(), F.lit("own")).when(F.col("from_spdx").isNotNull(), F.lit("inherited"))
    return joined.select(
        *[F.col(f"`{c}`") for c in kept],
        "path",
        F.coalesce("spdx", "from_spdx").alias("spdx"),
        how.alias("how"),
        F.when(how == "inherited", F.col("from_dir")).alias("licence_dir"),
        F.coalesce("score", "from_score").alias("score"),
        F.coalesce("n_statements", F.lit(0)).cast("long").alias("n_statements"),
        F.coalesce("all_spdx", F.array().cast("array<string>")).alias("all_spdx"),
    )


def document_path() -> Column:
    """The documents have no paths; their source and language are the directories."""
    return F.concat_ws("/", F.col("source"), F.col("lang"), F.col("doc_id").cast("string"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"), document_path())
    return found.select("doc_id", "path", "spdx", "how", "licence_dir", "score", "n_statements", F.array_join("all_spdx", ",").alias("all_spdx"))


def _oracle() -> str:
    """The same by brute force: every passage against every template, without anchors."""
    rows = ", ".join(f"({i}, '{spdx}', '{w}', {n})" for i, spdx, c in templates() for w, n in sorted(c.items()))
    words = lambda x: f"list_filter(list_transform(string_split_regex({x}, '[^a-z0-9.]+'), lambda w: trim(w, '.')), lambda w: w <> '')"
    return rf"""
with t(template, spdx, word, n) as (values {rows}),
d as (select doc_id, concat_ws('/', source, lang, cast(doc_id as varchar)) as path, concat_ws('/', source, lang) as dir, lower(coalesce(text, '')) as low from documents),
size as (select count(*) as n from d),
df as (select word, count(*) as n from (select distinct doc_id, unnest({words("low")}) as word from d) where word in (select word from t) group by word),
idf as (select v.word, ln((size.n + 1) / (coalesce(df.n, 0) + 1)) + 1 as idf from (select distinct word from t) v left join df on v.word = df.word cross join size),
other as (select coalesce((select quantile_disc(ln((size.n + 1) / (df.n + 1)) + 1, 0.5) from df), ln((size.n + 1) / 1) + 1) as idf from size),
tw as (select template, spdx, t.word, t.n * idf as w from t join idf on t.word = idf.word),
tn as (select template, sqrt(sum(w * w)) as norm from tw group by template),
tu as (select tw.template, spdx, word, w / norm as u from tw join tn on tw.template = tn.template),
p as (
    select distinct doc_id, passage, passage = trim(low, chr(32) || chr(9) || chr(13) || chr(10) || '.!?') as whole from (
        select doc_id, low, trim(unnest(list_concat(string_split(low, chr(10)), string_split_regex(low, '
[ 	
]*
'), string_split_regex(low, '[.!?][ 	
]+'), [low])), chr(32) || chr(9) || chr(13) || chr(10) || '.!?') as passage from d)
),
pw as (select passage, word, count(*) as tf from (select passage, unnest({words("passage")}) as word from (select distinct passage from p)) group by passage, word),
ww as (select passage, pw.word, tf * coalesce(idf.idf, other.idf) as w from pw left join idf on pw.word = idf.word cross join other),
pn as (select passage, sqrt(sum(w * w)) as norm from ww group by passage),
dots as (select passage, template, spdx, sum(w * u) as dot from ww join tu on ww.word = tu.word group by passage, template, spdx),
c as (select dots.passage, spdx, round(dot / norm, 6) as score from dots join pn on dots.passage = pn.passage where round(dot / norm, 6) >= {THRESHOLD}),
best as (select passage, spdx, score from c qualify row_number() over (partition by passage order by score desc, spdx) = 1),
hits as (select doc_id, spdx, score, whole and score >= {WHOLE} as whole from p join best on p.passage = best.passage),
own as (
    select doc_id, count(*) as n_statements, string_agg(distinct spdx, ',' order by spdx) as all_spdx, bool_or(whole) as whole,
        arg_min(spdx, (-score, spdx)) as spdx, max(score) as score
    from hits group by doc_id
),
given as (
    select dir, arg_min(spdx, (-score, spdx)) as spdx, max(score) as score
    from d join own on d.doc_id = own.doc_id where whole or regexp_matches(cast(d.doc_id as varchar), '{LICENCE_FILES}') group by dir
),
near as (
    select dirs.dir, given.dir as from_dir, spdx, score from (select distinct dir from d) dirs
    join given on given.dir = '' or dirs.dir = given.dir or starts_with(dirs.dir, given.dir || '/')
    qualify row_number() over (partition by dirs.dir order by length(given.dir) desc) = 1
)
select d.doc_id, d.path, coalesce(own.spdx, near.spdx) as spdx,
    case when own.spdx is not null then 'own' when near.spdx is not null then 'inherited' end as how,
    case when own.spdx is null then near.from_dir end as licence_dir,
    coalesce(own.score, near.score) as score, coalesce(n_statements, 0) as n_statements, coalesce(all_spdx, '') as all_spdx
from d left join own on d.doc_id = own.doc_id left join near on d.dir = near.dir
"""


ORACLE = _oracle()
