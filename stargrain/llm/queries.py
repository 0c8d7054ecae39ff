"""One registered query per operator, over the whole given tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.llm import (
    collocations,
    decontamination,
    exact_dedup,
    line_dedup,
    max_score,
    near_dedup,
    packing,
    paragraph_dedup,
    pieces,
    quality_model,
    spelling,
    suffix_dedup,
    url_filter,
)
from stargrain.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op2_max_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_score.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op2_max_score"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 10
"""


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.paragraph_dedup(table(spark, sf_dir, "documents"))


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.train(docs, table(spark, sf_dir, "labels")))


@query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), words=4)


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


ORACLES["op8_line_dedup"] = r"""
WITH split AS (SELECT DISTINCT coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
flat AS (
  SELECT text, pos, trim(regexp_replace(lines[pos], '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS body,
         CASE WHEN pos > 1 THEN lines[pos - 1] END AS before, lines[pos + 1] AS after
  FROM (SELECT text, lines, unnest(range(1, len(lines) + 1)) AS pos FROM split)),
short AS (
  SELECT text, pos, before, after, len(string_split(body, ' ')) AS n,
         regexp_replace(body, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS body
  FROM flat WHERE len(string_split(body, ' ')) BETWEEN 3 AND 24),
bodies AS (
  SELECT body, n, list_slice(string_split(body, ' '), 1, 2) AS lead, count(*) AS contexts
  FROM (SELECT DISTINCT body, n, context FROM (SELECT body, n, arg_min({'b': before, 'a': after}, pos) AS context FROM short GROUP BY body, n, text))
  GROUP BY body, n),
seeds AS (
  SELECT n, lead, first(body ORDER BY contexts DESC, body) AS seed FROM bodies GROUP BY n, lead),
joined AS (
  SELECT b.body, b.contexts, CASE WHEN len(list_filter(range(1, b.n + 1),
    lambda i: string_split(b.body, ' ')[i] = string_split(s.seed, ' ')[i])) / b.n >= 0.7 THEN s.seed ELSE b.body END AS template
  FROM bodies b JOIN seeds s ON b.n = s.n AND b.lead = s.lead),
gone AS (
  SELECT body FROM joined WHERE template IN (SELECT template FROM joined GROUP BY template HAVING sum(contexts) >= 5)),
drops AS (
  SELECT text, list(DISTINCT pos) AS drop FROM short WHERE body IN (SELECT body FROM gone) GROUP BY text)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(s.lines) END AS n_lines, coalesce(len(x.drop), 0) AS n_dropped,
       sha256(CASE WHEN x.drop IS NULL THEN s.text ELSE coalesce(array_to_string(list_transform(
         list_filter(range(1, len(s.lines) + 1), lambda i: NOT list_contains(x.drop, i)), lambda i: s.lines[i]), chr(10)), '') END) AS kept_sha256
FROM documents d JOIN split s ON coalesce(d.text, '') = s.text LEFT JOIN drops x ON x.text = s.text
"""


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op10_exact_dedup"] = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
wins AS (
  SELECT DISTINCT item, len(w) AS m, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT id, i, n, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM d), (SELECT DISTINCT n FROM wins) WHERE i + n - 1 <= len(w)),
found AS (SELECT id, i, p.n, item FROM places p JOIN wins USING (win)),
hit AS (SELECT id, count(DISTINCT k) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS k FROM found) GROUP BY id),
items AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT id, item FROM found) GROUP BY id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (id) LEFT JOIN items USING (id)
"""


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


ORACLES["op13_spelling_variants"] = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(range(1, strlen(key) + 1), lambda i: CAST('0x' || substring(hex(key), 2 * i - 1, 2) AS BIGINT))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS h
  FROM (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key FROM runs), crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-m, encode(near))) AS near, max(m) AS m FROM pairs GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN near END AS form, CASE WHEN m >= 10 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
way AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT w.word, f.form FROM way w JOIN formed f ON w.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n
FROM formed f JOIN (SELECT word, root FROM way WHERE root IN (SELECT word FROM formed WHERE form IS NULL)) r ON f.word = r.word
"""


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, k, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces), (SELECT unnest(range(1, 5)) AS k) WHERE i + k - 1 <= len(w)
  GROUP BY ALL),
often AS (SELECT lang, phrase, k, string_split(phrase, ' ') AS w, f FROM grams WHERE f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, c.pos, h.f AS l, t.f AS r, (CAST(2000000 AS HUGEINT) * c.f) // (h.f + t.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS pos FROM often WHERE k > 1) c
  JOIN often h ON h.lang = c.lang AND h.phrase = array_to_string(list_slice(c.w, 1, c.pos), ' ')
  JOIN often t ON t.lang = c.lang AND t.phrase = array_to_string(list_slice(c.w, c.pos + 1, c.k), ' ')),
lowest AS (SELECT lang, phrase, k, a, arg_min({'l': l, 'r': r, 's': score}, (score, pos)) AS x FROM cuts GROUP BY ALL),
longer AS (
  SELECT lang, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, max(f) AS b
  FROM (SELECT *, unnest(range(1, k + 1)) AS i FROM often WHERE k > 2), (SELECT unnest([2, 3]) AS m) WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
ranked AS (
  SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY x.s DESC, a DESC, encode(o.phrase)) AS rank, o.phrase, a, x.l AS l, x.r AS r, x.s AS score
  FROM lowest o LEFT JOIN longer g ON o.lang = g.lang AND o.phrase = g.phrase WHERE b IS NULL OR 100 * b < 80 * a)
SELECT r.lang, rank, phrase, a, l, r.r AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked r JOIN (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang) t ON r.lang = t.lang WHERE rank <= 2000
"""
