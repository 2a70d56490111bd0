"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revaudit.llm import (
    alignment, bpe, licenses, linedup, merging, mixing, neardup, prefixtrie, quality, rules, sketches, tokenfiles, toxicity,
)
from revaudit.llm.common import table
from revaudit.operators.scratch import new_path

#: The id behind each document in the token files.
END_ID = 2


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    learned = rules.train(documents, table(spark, sf_dir, "labels"))
    return rules.judge(documents, learned)


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.compare_with_edit(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), path, decoded=True))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    size = mixing.word_count(F.col("text"))
    return mixed.select(
        "doc_id", size.alias("size"), "source_size", "target", (F.col("size") * F.size("places")).alias("taken")
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.score(documents, quality.train(documents, table(spark, sf_dir, "labels")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.document_files(table(spark, sf_dir, "documents")))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.digests(table(spark, sf_dir, "documents"), *paths)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    path = new_path(spark, "token-files")
    tokenfiles.write_documents(documents, public_tokenizers.path("word_bpe_49k.json"), END_ID, path)
    return tokenfiles.checksums(tokenfiles.read(spark, path))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_line_dedup, op2_quality_rules, op3_minhash_near_dedup, op4_document_fingerprints,
            op5_token_counts, op6_bpe_round_trip, op7_source_mixing, op8_quality_classifier,
            op9_toxicity, op10_license_scan, op11_token_alignment, op12_token_files, op13_prefix_trie, pipeline,
        )
    }


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1 = rf"""
WITH w AS (
  SELECT doc_id, text, {_WORDS} AS words,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+') AS pieces
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50)
), later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS at FROM later
), kept AS (
  SELECT p.doc_id, string_agg(p.piece, '' ORDER BY p.at) FILTER (g.at IS NULL) AS body, count(g.at) AS n_removed
  FROM (SELECT doc_id, unnest(pieces) AS piece, unnest(range(1, len(pieces) + 1)) AS at FROM w) p
  LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.at = g.at GROUP BY p.doc_id
)
SELECT w.doc_id,
       CASE WHEN w.text IS NOT NULL
            THEN coalesce(k.body, '') || regexp_extract(w.text, '[\x20\x09-\x0D]*$') END AS text,
       CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

_OP3 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
n AS (SELECT doc_id, array_to_string(words, ' ') AS whole, words FROM w),
copies AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY whole) AS entry, words FROM n),
e AS (SELECT doc_id AS entry, words FROM copies WHERE doc_id = entry AND len(words) > 0),
s AS (
  SELECT entry, shingle, count(*) AS weight FROM (
    SELECT entry, array_to_string(words[i:i + 4], ' ') AS shingle
    FROM (SELECT entry, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM e)
  ) GROUP BY entry, shingle
),
t AS (SELECT entry, sum(weight) AS total FROM s GROUP BY entry),
common AS (
  SELECT a.entry AS a, b.entry AS b, sum(least(a.weight, b.weight)) AS both
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.entry <> b.entry GROUP BY a.entry, b.entry
),
links AS (
  SELECT c.a, c.b FROM common c JOIN t x ON c.a = x.entry JOIN t y ON c.b = y.entry
  WHERE c.both / (x.total + y.total - c.both) >= 0.8
),
reach AS (
  SELECT entry AS node, entry AS seen FROM (SELECT DISTINCT entry FROM copies)
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a
),
label AS (SELECT node, min(seen) AS class_id FROM reach GROUP BY node)
SELECT c.doc_id, l.class_id, CAST(count(*) OVER (PARTITION BY l.class_id) AS BIGINT) AS class_size
FROM copies c JOIN label l ON c.entry = l.node
"""

_OP7 = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
         CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS draw
  FROM documents
), per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
  FROM sized GROUP BY source
), ranked AS (
  SELECT *, source_size * 3 AS most, CAST(source_size * 3 AS DOUBLE) / weight AS ratio FROM per_source
), levels AS (
  SELECT *, CAST(sum(source_size) OVER () - (sum(most) OVER up - most) AS DOUBLE) / (sum(weight) OVER down) AS level
  FROM ranked
  WINDOW up AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         down AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), targets AS (
  SELECT source, source_size,
         least(CAST(most AS DOUBLE), max(level) OVER () * weight) AS target
  FROM levels
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM targets
), ranked_docs AS (
  SELECT source, draw, CAST(sum(size) AS BIGINT) AS size, row_number() OVER (PARTITION BY source ORDER BY draw) AS r
  FROM sized GROUP BY source, draw
), walk AS (
  SELECT source, CAST(0 AS BIGINT) AS r, CAST(-1 AS BIGINT) AS draw, target - passes * source_size AS open, 0 AS more FROM plan
  UNION ALL
  SELECT w.source, d.r, d.draw,
         w.open - CASE WHEN d.size BETWEEN 1 AND w.open THEN d.size ELSE 0 END,
         CASE WHEN d.size BETWEEN 1 AND w.open THEN 1 ELSE 0 END
  FROM walk w JOIN ranked_docs d ON d.source IS NOT DISTINCT FROM w.source AND d.r = w.r + 1
)
SELECT s.doc_id, s.size, p.source_size, p.target, CAST(s.size * (p.passes + w.more) AS BIGINT) AS taken
FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
JOIN walk w ON s.source IS NOT DISTINCT FROM w.source AND s.draw = w.draw
"""


_TERMS = r"regexp_extract_all(lower({}), '[0-9]+(?:\.[0-9]+)*|\p{{L}}+')"


def _license_sql() -> str:
    bodies = ",\n".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(licenses.TEMPLATES))
    marked = f"regexp_matches(line, '{licenses.MARKS}')"
    return f"""
WITH files AS (
  SELECT doc_id, coalesce(text, '') AS text,
    concat_ws('/', coalesce(source, 'none'), CAST(floor(doc_id / 4096) AS BIGINT),
              CAST(floor(doc_id / 64) AS BIGINT)) AS folder,
    concat(doc_id, '.txt') AS name
  FROM documents
), tf AS (
  SELECT template, licence, term, CAST(count(*) AS DOUBLE) AS tf
  FROM (SELECT template, licence, unnest({_TERMS.format('body')}) AS term
        FROM (VALUES {bodies}) AS v(template, licence, body)) GROUP BY ALL
), found AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM files) WHERE {marked}
), idf AS (
  SELECT term, ln((1 + max(n)) / (1 + count(*))) + 1 AS idf, ln(1 + max(n)) + 1 AS rest
  FROM tf, (SELECT count(DISTINCT template) AS n FROM tf) GROUP BY term
), shares AS (
  SELECT template, licence, tf.term,
         tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS share
  FROM tf JOIN idf ON tf.term = idf.term
), counted AS (
  SELECT 'L' || line AS key, term, count(*) AS tf, max(words) AS words
  FROM (SELECT line, len({_TERMS.format('line')}) AS words, unnest({_TERMS.format('line')}) AS term
        FROM (SELECT DISTINCT line FROM found)) GROUP BY line, term
  UNION ALL
  SELECT 'F' || doc_id, term, count(*), max(words)
  FROM (SELECT doc_id, len({_TERMS.format('text')}) AS words, unnest({_TERMS.format('text')}) AS term
        FROM files WHERE regexp_matches(text, '{licenses.MARKS}')) GROUP BY doc_id, term
), known AS (
  SELECT c.key, c.term, c.tf, c.words, idf, rest FROM counted c JOIN idf ON c.term = idf.term
), norms AS (
  SELECT key, sqrt(sum((tf * idf) * (tf * idf)) + (max(words) - sum(tf)) * max(rest) * max(rest)) AS norm
  FROM known GROUP BY key
), dots AS (
  SELECT key, template, licence, sum(k.tf * k.idf * s.share) AS dot
  FROM known k JOIN shares s ON k.term = s.term GROUP BY ALL
), closest AS (
  SELECT key, licence, round(dot / norm, 6) AS cosine FROM dots JOIN norms USING (key)
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY round(dot / norm, 6) DESC, licence) = 1
), headers AS (
  SELECT doc_id, licence, cosine FROM found JOIN closest ON key = 'L' || line WHERE cosine >= {licenses.LINE_THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, licence) = 1
), whole AS (
  SELECT CAST(substr(key, 2) AS BIGINT) AS doc_id, licence, cosine FROM closest
  WHERE starts_with(key, 'F') AND cosine >= {licenses.FILE_THRESHOLD}
), granted AS (
  SELECT folder, licence FROM whole JOIN files USING (doc_id)
  QUALIFY row_number() OVER (PARTITION BY folder ORDER BY cosine DESC, licence) = 1
), nearest AS (
  SELECT f.folder, g.licence FROM (SELECT DISTINCT folder FROM files) f
  JOIN granted g ON f.folder = g.folder OR starts_with(f.folder, g.folder || '/')
  QUALIFY row_number() OVER (PARTITION BY f.folder ORDER BY length(g.folder) DESC) = 1
)
SELECT f.doc_id, f.folder || '/' || f.name AS path,
  h.licence AS header_licence, h.cosine AS header_cosine, w.licence AS file_licence, w.cosine AS file_cosine,
  coalesce(w.licence, h.licence, n.licence) AS licence,
  CASE WHEN w.licence IS NOT NULL THEN 'file' WHEN h.licence IS NOT NULL THEN 'header'
       WHEN n.licence IS NOT NULL THEN 'directory' END AS found_in
FROM files f LEFT JOIN headers h ON f.doc_id = h.doc_id LEFT JOIN whole w ON f.doc_id = w.doc_id
LEFT JOIN nearest n ON f.folder = n.folder
"""


_OP13 = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, n, base, head, least(head, coalesce(b.base_n, 0)) AS taken FROM (
    SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base,
      xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
            lambda c: CAST(ascii(c) AS BIGINT))),
          lambda s, c: list_reduce(list_prepend(xor(s, c), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
            lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 6 AS head
    FROM t GROUP BY conv_id
  ) LEFT JOIN (SELECT conv_id AS base, count(*) AS base_n FROM t GROUP BY conv_id) b USING (base)
), rebuilt AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN t ON t.conv_id = c.base AND t.pos <= c.taken
  UNION ALL
  SELECT c.conv_id, t.pos - c.head + c.taken, t.role, t.text FROM convs c JOIN t USING (conv_id) WHERE t.pos > c.head
), turns AS (
  SELECT conv_id, pos, length(text) AS chars, md5(length(role) || ':' || role || text) AS turn FROM rebuilt
), seqs AS (
  SELECT conv_id, coalesce(s, []) AS s FROM convs
  LEFT JOIN (SELECT conv_id, list(turn ORDER BY pos) AS s FROM turns GROUP BY conv_id) USING (conv_id)
), paths AS (
  SELECT conv_id, depth, md5(array_to_string(s[1:depth], ',')) AS prefix, depth = len(s) AS ends
  FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS depth FROM seqs)
), nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM paths GROUP BY depth, prefix
), linked AS (
  SELECT n.*, up.prefix AS above, pn.conv_id AS parent_conv_id, coalesce((n.n_convs - 1) * turns.chars, 0) AS own
  FROM nodes n LEFT JOIN paths up ON up.conv_id = n.conv_id AND up.depth = n.depth - 1
  LEFT JOIN nodes pn ON pn.depth = n.depth - 1 AND pn.prefix = up.prefix
  LEFT JOIN turns ON turns.conv_id = n.conv_id AND turns.pos = n.depth
), counted AS (
  SELECT l.*, coalesce(c.k, 0) AS n_children FROM linked l
  LEFT JOIN (SELECT depth - 1 AS depth, above AS prefix, count(*) AS k FROM linked GROUP BY ALL) c USING (depth, prefix)
), sums AS (
  SELECT p.depth, p.prefix, sum(CASE WHEN c.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(c.own) AS saved_tokens
  FROM counted c JOIN paths p ON p.conv_id = c.conv_id AND p.depth <= c.depth GROUP BY p.depth, p.prefix
)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, CAST(n_convs AS BIGINT) AS n_convs,
  CAST(n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM counted JOIN sums USING (depth, prefix)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": _OP1,
        "op3_minhash_near_dedup": _OP3,
        "op7_source_mixing": _OP7,
        "op10_license_scan": _license_sql(),
        "op13_prefix_trie": _OP13,
    }
