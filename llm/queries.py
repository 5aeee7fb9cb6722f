"""The registered queries of the operators: opN_<name>(spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from llm import collocations, decontaminate, fertility, nearjoin, pii, quality, rlz, secrets, simhash, suffix, tokenize, variants, wrappers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
FERTILITY_VOCABULARIES = [public_tokenizers.path(f) for f in ("piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken")]


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.op8(table(spark, sf_dir, "documents"), BPE_RANKS)


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op4(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op5(table(spark, sf_dir, "documents"))


@query
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearjoin.op2(table(spark, sf_dir, "documents"))


#: Words are split at white space; the lower-casing is of A-Z alone; a link joins sets with
#: 100 * intersection >= 75 * union. Pairs come from an inverted list of all shingles.
ORACLE["op2_minhash_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
reach AS (SELECT a AS node, a AS seen FROM links UNION SELECT node, b FROM reach JOIN links ON a = seen),
comp AS (SELECT node, least(node, min(seen)) AS c FROM reach GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c, d.doc_id) AS component_id, coalesce(c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON node = d.doc_id
"""


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SPLIT = r"list_filter(string_split_regex(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
ORACLE["op10_decontamination"] = rf"""
WITH d AS (SELECT doc_id, {_SPLIT.format("text")} AS ws FROM documents),
parts AS (
  SELECT item_id, unnest([
    {{'part': 'whole', 't': text}},
    {{'part': 'question', 't': regexp_extract(text, '^([\s\S]*)\n[^\n]*$', 1)}},
    {{'part': 'answer', 't': CASE WHEN regexp_extract(text, '^([\s\S]*)\n[^\n]*$', 1) <> '' THEN regexp_extract(text, '\n([^\n]*)$', 1) ELSE '' END}}
  ], recursive := true) FROM benchmark
), i AS (SELECT item_id, part, {_SPLIT.format("t")} AS ws FROM parts),
t AS (
  SELECT DISTINCT item_id, part, least(5, len(ws)) AS n, unnest(list_transform(range(1, greatest(len(ws) - 3, 2)), lambda j: array_to_string(ws[j:j + 4], ' '))) AS g FROM i WHERE len(ws) > 0
), g AS (
  SELECT DISTINCT doc_id, n, unnest(list_transform(range(1, greatest(len(ws) - n + 2, 1)), lambda j: array_to_string(ws[j:j + n - 1], ' '))) AS g
  FROM d, (SELECT DISTINCT n FROM t)
), both_ AS (
  SELECT doc_id, item_id, part, count(*) AS m FROM t JOIN g USING (n, g) GROUP BY ALL
), size AS (SELECT item_id, part, count(*) AS n FROM t GROUP BY ALL)
SELECT w.doc_id, w.item_id, s.n AS n_terms, w.m AS n_matched, w.m / s.n AS overlap,
  CASE WHEN q.n IS NOT NULL THEN coalesce(qm.m, 0) / q.n END AS question_overlap,
  CASE WHEN a.n IS NOT NULL THEN coalesce(am.m, 0) / a.n END AS answer_overlap
FROM both_ w JOIN size s ON s.item_id = w.item_id AND s.part = 'whole'
LEFT JOIN size q ON q.item_id = w.item_id AND q.part = 'question'
LEFT JOIN size a ON a.item_id = w.item_id AND a.part = 'answer'
LEFT JOIN both_ qm ON qm.doc_id = w.doc_id AND qm.item_id = w.item_id AND qm.part = 'question'
LEFT JOIN both_ am ON am.doc_id = w.doc_id AND am.item_id = w.item_id AND am.part = 'answer'
WHERE w.part = 'whole' AND 100 * w.m >= 75 * s.n
"""


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op7(table(spark, sf_dir, "documents"))


@query
def op1_rlz_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.op1(table(spark, sf_dir, "documents"))


ORACLE["op1_rlz_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, greatest(len(ws) - 11, 1))) AS i, unnest(list_transform(range(1, greatest(len(ws) - 11, 1)), lambda i: md5(array_to_string(ws[i:i + 12], ' ')))) AS h FROM d
), f AS (SELECT h, min(doc_id) AS first_id FROM g GROUP BY h),
gone AS (SELECT DISTINCT doc_id, i + j AS k FROM g JOIN f USING (h), range(0, 13) r(j) WHERE first_id < doc_id),
lost AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(ws, lambda x, k: ks IS NULL OR NOT list_contains(ks, k)), ' ')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id)
"""


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.op6(table(spark, sf_dir, "documents"))


@query
def op9_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.op9(table(spark, sf_dir, "pages"), between="\n\n")


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op11_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.op11(table(spark, sf_dir, "documents"), FERTILITY_VOCABULARIES)


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.op12(table(spark, sf_dir, "documents"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.op13(table(spark, sf_dir, "documents"))


#: Pieces and words of every text; phrases of two and three words; counts in 128 bits.
ORACLE["op13_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p
), f AS (
  SELECT lang, k, g, CAST(count(*) AS HUGEINT) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, greatest(len(ws) - k + 2, 1)), lambda i: ws[i:i + k - 1])) AS g FROM w, range(1, 4) r(k)
  ) GROUP BY ALL
), n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
longer AS (
  SELECT lang, g, max(f) AS f FROM (SELECT lang, g[1:2] AS g, f FROM c WHERE k = 3 UNION ALL SELECT lang, g[2:3], f FROM c WHERE k = 3) GROUP BY ALL
), kept AS (
  SELECT c.* FROM c LEFT JOIN longer ON longer.lang = c.lang AND longer.g = c.g AND c.k = 2 WHERE longer.f IS NULL OR 100 * longer.f < 50 * c.f
), cut AS (
  SELECT k.lang, k.g, k.f AS a, j, l.f AS l, r.f AS r, (1000000 * k.f * k.f) // (l.f * r.f) AS score
  FROM kept k JOIN range(1, 3) x(j) ON j < k.k
  JOIN f l ON l.lang = k.lang AND l.g = k.g[1:j] JOIN f r ON r.lang = k.lang AND r.g = k.g[j + 1:k.k]
), scored AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank FROM scored
)
SELECT lang, rank, array_to_string(g, ' ') AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

#: The crc32 goes byte by byte over the list of bytes; two words are near if taking a letter out of one
#: gives the other, or out of both at one place gives the same.
ORACLE["op12_spelling_variants"] = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), run AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w FROM documents
), own AS (
  SELECT doc_id, w, count(*) AS n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, unicode(c) - 64] END)) AS bytes
  FROM run GROUP BY doc_id, w
), hashed AS (
  SELECT w, n, xor(list_reduce(list_concat([4294967295], bytes), lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS BIGINT) + 1])), 4294967295) AS h FROM own, crc
), typed AS (
  SELECT CASE WHEN h % 199 = 0 THEN w[1:h % len(w)] || w[h % len(w) + 2:] ELSE w END AS word, n FROM hashed
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), d AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS k FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM v)),
near AS (
  SELECT DISTINCT x.word, x.n, y.word AS other, y.n AS other_n FROM d x JOIN d y ON x.i = y.i AND x.k = y.k AND x.word <> y.word
  UNION SELECT d.word, d.n, v.word, v.n FROM d JOIN v ON v.word = d.k
  UNION SELECT v.word, v.n, d.word, d.n FROM d JOIN v ON v.word = d.k
), best AS (
  SELECT word, n, count(*) OVER (PARTITION BY word) AS n_near, other, other_n FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) = 1
), form AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form, CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n FROM v LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root FROM form
  UNION ALL SELECT c.word, f.form FROM chain c JOIN form f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM form f JOIN chain c USING (word) JOIN form r ON r.word = c.root WHERE r.form IS NULL
"""
