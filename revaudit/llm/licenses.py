"""Licence scans: cosine of header lines and licence files to templates, then directories.

Every line of every whole text that has a licence word is a header candidate. Candidates, and whole
files with candidates, are compared with template texts by TF-IDF cosine. Weights come from counts over
the templates, so a text's verdict doesn't depend on the other files; a word that no template uses counts
as a distinct word of the highest weight. A
file whose whole text is close to a template is a licence file and stands for its directory. A file
without a header of its own takes the licence of its nearest ancestor directory.

Equal lines are compared once, however often they occur, and directories are resolved once each, so
neither a line nor a directory that many files share makes a large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revaudit.operators.scratch import settle

#: Fixed texts: customary licence lines with the identifiers of their licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

# Fixed texts: whole licences, without their copyright lines.
TEMPLATES += [
    ("MIT", "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
]

# Short identifier lines, one for each licence; the GNU licences have two more forms.
_NAMES = sorted({name for name, _ in TEMPLATES})
TEMPLATES += [
    (name, f"SPDX-License-Identifier: {name}{form}")
    for name in _NAMES
    for form in (("", "-only", "-or-later") if "GPL" in name else ("",))
]

#: A candidate line has one of these fixed words; no template is without.
MARKS = r"(?i)licen[sc]|copyright|permission|redistribut|public domain|free software|mozilla"
LINE_THRESHOLD = 0.8
FILE_THRESHOLD = 0.6


def terms(line: Column) -> Column:
    """Lower-case runs of letters, and numbers with their inner dots (`2.0`)."""
    return F.regexp_extract_all(F.lower(line), F.lit(r"([0-9]+(?:\.[0-9]+)*|\p{L}+)"), 1)


def template_table(spark: SparkSession) -> DataFrame:
    """template, licence, term, tf: one row for each distinct word of each fixed template."""
    quoted = ", ".join(
        f"named_struct('template', {i}, 'licence', '{name}', 'text', '{text}')" for i, (name, text) in enumerate(TEMPLATES)
    )
    rows = spark.sql(f"SELECT inline(array({quoted}))")
    return (
        rows.select("template", "licence", F.explode(terms(F.col("text"))).alias("term"))
        .groupBy("template", "licence", "term")
        .agg(F.count("*").cast("double").alias("tf"))
    )


def candidates(files: DataFrame) -> DataFrame:
    """doc_id, path, line: one row for each candidate line."""
    return (
        files.where(F.col("text").rlike(MARKS))
        .select("doc_id", "path", F.explode(F.split("text", "\n")).alias("line"))
        .where(F.col("line").rlike(MARKS))
    )


def file_words(files: DataFrame) -> DataFrame:
    """doc_id, term, tf, words: every word of each whole text that has a candidate line."""
    marked = files.where(F.col("text").rlike(MARKS)).select("doc_id", F.explode(terms(F.col("text"))).alias("term"))
    counted = marked.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
    return counted.withColumn("words", F.sum("tf").over(Window.partitionBy("doc_id")))


def weighted_templates(spark: SparkSession) -> DataFrame:
    """term, idf, rest (idf of unknown words) and the (template, licence, share) that use the term.

    share is the term's part of the template's unit vector. The table has a row for each word of the fixed
    templates, over which the words are counted.
    """
    templates = template_table(spark)
    total = F.lit(float(len(TEMPLATES)))
    idf = templates.groupBy("term").agg(
        (F.log((1 + total) / (1 + F.count("*"))) + 1).alias("idf"), (F.log(1 + total) + 1).alias("rest")
    )
    weight = F.col("tf") * F.col("idf")
    whole = Window.partitionBy("template")
    return (
        templates.join(idf, "term")
        .withColumn("share", weight / F.sqrt(F.sum(weight * weight).over(whole)))
        .groupBy("term", "idf", "rest")
        .agg(F.collect_list(F.struct("template", "licence", "share")).alias("uses"))
    )


def _closest(counted: DataFrame, weighted: DataFrame, key: str) -> DataFrame:
    """key, cosine, licence: the closest template of each key; ties go to the lowest licence name.

    `counted` has key, term, tf and words, the number of words of the key.
    """
    known = counted.join(F.broadcast(weighted), "term")
    norms = known.groupBy(key).agg(
        F.sum((F.col("tf") * F.col("idf")) ** 2).alias("square"),
        (F.max("words") - F.sum("tf")).alias("unknown"),
        F.max("rest").alias("rest"),
    )
    dots = (
        known.select(key, "tf", "idf", F.explode("uses").alias("use"))
        .groupBy(key, F.col("use.template").alias("template"), F.col("use.licence").alias("licence"))
        .agg(F.sum(F.col("tf") * F.col("idf") * F.col("use.share")).alias("dot"))
    )
    norm = F.sqrt(F.col("square") + F.col("unknown") * F.col("rest") * F.col("rest"))
    scored = dots.join(norms, key).select(key, "licence", F.round(F.col("dot") / norm, 6).alias("cosine"))
    return _best(scored, key)


def _best(scored: DataFrame, key: str) -> DataFrame:
    """key, licence, cosine: the highest cosine of each key, then the lowest name."""
    best = F.min(F.struct((-F.col("cosine")).alias("far"), F.col("licence").alias("licence"))).alias("best")
    return scored.groupBy(key).agg(best).select(key, "best.licence", (-F.col("best.far")).alias("cosine"))


def ancestors(directory: Column) -> Column:
    """A directory and all above it, the root being the empty name; the deepest first."""
    parts = F.split(directory, "/")
    return F.when(directory == "", F.array(F.lit(""))).otherwise(
        F.concat(
            F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")),
            F.array(F.lit("")),
        )
    )


def directory_of(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"^(.*)/", 1), "^/+", "")


def scan(files: DataFrame) -> DataFrame:
    """doc_id, path, header_licence, header_cosine, file_licence, file_cosine, licence, found_in.

    `files` has doc_id, path and text; other columns are not read. Paths are `/`-separated; a null
    path has no directory. One row comes out for each row; rows of one doc_id count as one file and
    rows without doc_id are not scanned. found_in is `file`, `header`, `directory` or null, when there is
    no licence. A null or empty text has no lines. Of several licences the closest counts, then the
    lowest name. An empty table gives an empty one. A file is judged by all words of its whole text.
    """
    files = files.select("doc_id", "path", "text")
    found = settle(candidates(files.where("doc_id is not null")), "licence-lines")
    lines = settle(found.select("line").distinct(), "licence-distinct-lines")
    weighted = settle(weighted_templates(files.sparkSession), "licence-weights")

    by_line = lines.select("line", terms(F.col("line")).alias("all")).select(
        "line", F.size("all").cast("long").alias("words"), F.explode("all").alias("term")
    )
    by_line = by_line.groupBy("line", "term").agg(F.count("*").alias("tf"), F.max("words").alias("words"))
    close = _closest(by_line, weighted, "line").where(F.col("cosine") >= LINE_THRESHOLD)
    headers = _best(found.select("doc_id", "line").join(close, "line"), "doc_id")

    by_file = file_words(files.where("doc_id is not null"))
    whole = _closest(by_file, weighted, "doc_id").where(F.col("cosine") >= FILE_THRESHOLD)
    whole = settle(whole, "licence-files")

    placed = files.select("doc_id", "path", directory_of(F.col("path")).alias("_directory"))
    holders = found.select("doc_id", directory_of(F.col("path")).alias("_holder")).where("_holder is not null").distinct()
    granted = _best(holders.join(whole, "doc_id"), "_holder").select("_holder", F.col("licence").alias("granted"))
    nearest = (
        placed.select("_directory").where("_directory is not null").distinct()
        .select(F.col("_directory").alias("_at"), F.posexplode(ancestors(F.col("_directory"))).alias("above", "_holder"))
        .join(granted, "_holder")
        .groupBy("_at").agg(F.min(F.struct("above", "granted")).alias("best"))
        .select("_at", F.col("best.granted").alias("granted"))
    )
    named = headers.select("doc_id", F.col("licence").alias("header_licence"), F.col("cosine").alias("header_cosine"))
    filed = whole.select("doc_id", F.col("licence").alias("file_licence"), F.col("cosine").alias("file_cosine"))
    return (
        placed.join(named, "doc_id", "left")
        .join(filed, "doc_id", "left")
        .join(nearest, F.col("_directory") == F.col("_at"), "left")
        .select(
            "doc_id", "path", "header_licence", "header_cosine", "file_licence", "file_cosine",
            F.coalesce("file_licence", "header_licence", "granted").alias("licence"),
            F.when(F.col("file_licence").isNotNull(), "file")
            .when(F.col("header_licence").isNotNull(), "header")
            .when(F.col("granted").isNotNull(), "directory").alias("found_in"),
        )
    )


def document_files(documents: DataFrame) -> DataFrame:
    """The documents as files: `source/n/m/doc_id.txt` with n and m the id divided by 4096 and 64."""
    unit = [F.floor(F.col("doc_id") / n).cast("string") for n in (4096, 64)]
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    return documents.select(
        "doc_id", F.concat_ws("/", F.coalesce("source", F.lit("none")), *unit, name).alias("path"), "text"
    )
