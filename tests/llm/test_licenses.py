from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from helpers import odd_documents
from revaudit.llm import licenses, queries
from revaudit.llm.common import table

MIT = "Released under the MIT License."
SCHEMA = "doc_id long, path string, text string"
GPL = "This work is licensed under the GNU General Public License, version 3."


def terms(line: str) -> list[str]:
    return re.findall(r"[0-9]+(?:\.[0-9]+)*|[^\W\d_]+", line.lower())


def brute(files: dict[int, tuple[str, str]]) -> dict[int, tuple]:
    """licence and found_in of each file."""
    marked = re.compile(licenses.MARKS)
    lines = {i: [x for x in (t or "").split("\n") if marked.search(x)] for i, (_, t) in files.items()}
    n_templates = len(licenses.TEMPLATES)
    df = Counter(w for _, t in licenses.TEMPLATES for w in set(terms(t)))
    vocabulary = set(df)
    idf = {w: math.log((1 + n_templates) / (1 + n)) + 1 for w, n in df.items()}
    rest = math.log(1 + n_templates) + 1

    def closest(own: list[str], total: int, least: float):
        tf = Counter(w for w in own if w in vocabulary)
        norm = math.sqrt(sum((n * idf[w]) ** 2 for w, n in tf.items()) + (total - sum(tf.values())) * rest**2)
        best = None
        for name, text in licenses.TEMPLATES:
            other = Counter(terms(text))
            size = math.sqrt(sum((n * idf[w]) ** 2 for w, n in other.items()))
            cosine = round(sum(n * idf[w] * other[w] * idf[w] for w, n in tf.items()) / size / norm, 6) if tf else 0
            if cosine >= least and (best is None or (-cosine, name) < best):
                best = (-cosine, name)
        return best

    header, whole, granted = {}, {}, {}
    for i, (path, text) in files.items():
        found = [b for x in lines[i] if (b := closest(terms(x), len(terms(x)), licenses.LINE_THRESHOLD))]
        header[i] = min(found, default=None)
        own = terms(text) if lines[i] else []
        whole[i] = closest(own, len(terms(text or "")), licenses.FILE_THRESHOLD) if own else None
        if whole[i]:
            directory = path.rpartition("/")[0]
            granted[directory] = min(granted.get(directory, whole[i]), whole[i])
    out = {}
    for i, (path, _) in files.items():
        if whole[i]:
            out[i] = (whole[i][1], "file")
        elif header[i]:
            out[i] = (header[i][1], "header")
        else:
            at = path
            while at:
                at = at.rpartition("/")[0]
                if at in granted:
                    break
            out[i] = (granted[at][1], "directory") if at in granted else (None, None)
    return out


FILES = {
    1: ("a/LICENSE", MIT),
    2: ("a/x/one.txt", "nothing here\nat all"),
    3: ("a/x/y/two.txt", "some text\n" + GPL + "\nmore of the same text that goes on and on for a while"),
    4: ("b/three.txt", "no licence is named in this text, but the word is"),
    5: ("a/x/COPYING", GPL),
    6: ("a/x/y/z/four.txt", ""),
    7: ("five.txt", "plain"),
    8: ("a/six.txt", "plain text"),
    9: ("c/LICENSE", "Licensed under CC BY-NC 4.0."),
    10: ("c/d/seven.txt", "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY 4.0.\n" + "word " * 200),
}


def test_equals_brute_force(spark):
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in FILES.items()], "doc_id long, path string, text string")
    rows = licenses.scan(df).collect()
    assert {r["doc_id"]: (r["licence"], r["found_in"]) for r in rows} == brute(FILES)
    got = {r["doc_id"]: (r["licence"], r["found_in"]) for r in rows}
    assert got[1] == ("MIT", "file") and got[2] == ("GPL-3.0", "directory") and got[3] == ("GPL-3.0", "header")
    assert got[6] == ("GPL-3.0", "directory") and got[8] == ("MIT", "directory") and got[7] == (None, None)
    assert got[4] == (None, None) and got[10][1] == "header"


@pytest.mark.parametrize("name, line", licenses.TEMPLATES)
def test_every_template_finds_itself(spark, name, line):
    assert re.search(licenses.MARKS, line)
    assert terms(line) and brute({1: ("x/y", line)})[1] == (name, "file")


def test_ancestors(spark):
    rows = spark.createDataFrame([("a/b/c",), ("",), ("a",)], "d string")
    assert [r[0] for r in rows.select(licenses.ancestors(rows["d"])).collect()] == [["a/b/c", "a/b", "a", ""], [""], ["a", ""]]


def test_odd_rows(spark):
    odd = odd_documents(spark).withColumnRenamed("lang", "path").withColumnRenamed("source", "licence")
    rows = licenses.scan(odd).collect()
    assert len(rows) == 10 and all(r["licence"] is None for r in rows)
    extra = spark.createDataFrame([(1, None, MIT), (2, None, None), (None, "q/r", MIT), (3, "q/s", "x"), (3, "q/s", "x")], "doc_id long, path string, text string")
    got = [(r["doc_id"], r["licence"], r["found_in"]) for r in licenses.scan(extra).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "MIT", "file"), (2, None, None), (None, None, None), (3, None, None), (3, None, None)], key=str
    )


def test_empty_table(spark):
    assert licenses.scan(licenses.document_files(odd_documents(spark).limit(0))).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    docs = licenses.document_files(table(spark, sf_dir, "documents"))
    files = {r["doc_id"]: (r["path"], r["text"]) for r in docs.collect()}
    rows = queries.op10_license_scan(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["licence"], r["found_in"]) for r in rows} == brute(files)
    assert any(r["licence"] for r in rows)


def test_query_equals_sql(spark, sf_dir):
    sql = queries.oracle_sql()["op10_license_scan"]
    found = differences(queries.op10_license_scan(spark, sf_dir), connect(sf_dir), sql)
    assert not found, "\n".join(found)


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0"""


@pytest.mark.parametrize("text", [APACHE, MIT, GPL + " Acme", MIT + " Acme"])
def test_verdict_does_not_depend_on_copies(spark, text):
    def verdict(copies: int):
        files = spark.range(copies).selectExpr("id AS doc_id", "concat('d/', id, '/LICENSE') AS path")
        return licenses.scan(files.withColumn("text", F.lit(text))).drop("doc_id", "path").distinct().collect()

    one = verdict(1)
    assert one[0]["found_in"] == "file" and verdict(100_000) == one


def whole_text(name):
    """The longest template of a licence, in lines of eight words."""
    words = max((text for n, text in licenses.TEMPLATES if n == name), key=len).split()
    return "\n".join(" ".join(words[i : i + 8]) for i in range(0, len(words), 8))


def test_whole_licence_files_and_identifier_lines(spark):
    files = [
        (1, "a/LICENSE", "Copyright (c) 2021 Some Person\n\n" + whole_text("MIT")),
        (2, "a/src/x.c", "int main;"),
        (3, "b/LICENSE", "Copyright (c) 2020, Some Owner\nAll rights reserved.\n" + whole_text("BSD-3-Clause")),
        (4, "c/x.py", "# SPDX-License-Identifier: MIT\nimport os"),
        (5, "c/y.py", "// SPDX-License-Identifier: GPL-3.0-or-later\nint x"),
        (6, "e/z.py", "# SPDX-License-Identifier: Zlib\nint z"),
        (7, "d/essay.txt", "The permission to enter was given to the person who asked for it, without limitation of time."),
    ]
    rows = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(files, SCHEMA)).collect()}
    assert (rows[1]["file_licence"], rows[1]["found_in"]) == ("MIT", "file")
    assert (rows[2]["licence"], rows[2]["found_in"]) == ("MIT", "directory")
    assert rows[3]["file_licence"] == "BSD-3-Clause"
    assert [rows[i]["header_licence"] for i in (4, 5, 6, 7)] == ["MIT", "GPL-3.0", None, None]
    assert rows[6]["licence"] is None and rows[7]["licence"] is None


def test_a_verdict_does_not_depend_on_the_neighbours(spark):
    one = [(1, "a/LICENSE", "Copyright (c) 2021 Some Person\n" + whole_text("MIT"))]
    alone = licenses.scan(spark.createDataFrame(one, SCHEMA)).first()
    copies = spark.range(2, 20_002).selectExpr("id AS doc_id", "concat('z/', id) AS path").withColumn("text", F.lit(one[0][2]))
    among = licenses.scan(spark.createDataFrame(one, SCHEMA).unionByName(copies)).where("doc_id = 1").first()
    assert alone["file_cosine"] == among["file_cosine"] >= licenses.FILE_THRESHOLD
    assert alone["licence"] == among["licence"] == "MIT"
