"""One query per operator over its whole table, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm import (
    curriculum, decontam, embedding_join, jaccard_join, lexical_scan, line_align, quality, sharding, spelling, token_counts, toxicity,
    url_trust, warc,
)
from trendlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every url: rules first, then trust spread over host links."""
    return url_trust.judge_urls(table(spark, sf_dir, "pages"))


# the supplied pages hold no absolute link, so trust and distrust are what the host's own pages give
ORACLE["op1_url_trust"] = r"""
WITH cut AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM cut),
given AS (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS v FROM ruled),
hosts AS (
  SELECT host, (count(*) FILTER (WHERE v = 'allow'))::DOUBLE / count(*) AS trust, (count(*) FILTER (WHERE v = 'block'))::DOUBLE / count(*) AS distrust
  FROM given WHERE host <> '' GROUP BY host)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN distrust >= 0.5 AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(trust, 0.0)::DOUBLE AS trust, coalesce(distrust, 0.0)::DOUBLE AS distrust
FROM given LEFT JOIN hosts USING (host)
"""


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole document from its attention-weighted passages."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with every benchmark item that a passage of it copies."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC, normalised to a member per record, and read back."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


ORACLE["op4_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
       CASE WHEN first <> page_id OR (page_id IS NULL AND first IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id OR (page_id IS NULL AND first IS NOT NULL) THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND n >= 100
"""


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole document after noisy-channel decoding."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of equal label at cosine 0.93."""
    return embedding_join.embedding_components(table(spark, sf_dir, "embeddings"))


ORACLE["op6_embedding_join"] = """
WITH RECURSIVE ok AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, least(a, min(b)) AS m FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS c FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.c, 0)::BIGINT AS n_links, coalesce(l.m, e.vec_id) AS component_id, coalesce(l.m, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN least l ON l.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""


@query
def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with what the mix takes of them, in training order."""
    planned = curriculum.plan_mix(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", "taken",
                          F.round(F.get("uses", F.lit(0))["position"], 6).alias("first_position")).orderBy("first_position", "doc_id")  # unused documents, without a position, spread by id


ORACLE["op7_curriculum_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, chr(2)) || chr(1) || coalesce(text, chr(2))) AS digest
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
dealt AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS k FROM per),
wished AS (
  SELECT source, source_size, [3.0, 1.0, 2.0][k + 1]::DOUBLE AS weight,
         [1.5, 1.0, 0.5][k + 1]::DOUBLE AS a, [0.5, 1.0, 1.5][k + 1]::DOUBLE AS b,
         (source_size * 2)::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5 AS budget
  FROM dealt),
-- the level at which the shares meet the budget: the least over all cuts of the order by cap / weight
cuts AS (
  SELECT x.source, max(x.budget - y.capped) / max(y.free_weight) AS level
  FROM wished x JOIN (
    SELECT p.source, coalesce(sum(q.cap) FILTER (WHERE q.cap / q.weight < p.cap / p.weight), 0) AS capped,
           sum(q.weight) FILTER (WHERE q.cap / q.weight >= p.cap / p.weight) AS free_weight
    FROM wished p, wished q GROUP BY p.source) y ON x.source IS NOT DISTINCT FROM y.source
  GROUP BY x.source),
fit AS (
  SELECT c.level FROM cuts c JOIN wished w ON c.source IS NOT DISTINCT FROM w.source
  WHERE c.level * w.weight <= w.cap ORDER BY w.cap / w.weight LIMIT 1),
targets AS (SELECT source, source_size, a, b, least(cap, coalesce((SELECT level FROM fit) * weight, cap)) AS target FROM wished),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.a, t.b,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.digest, s.doc_id ROWS UNBOUNDED PRECEDING) - s.size / 2 AS middle
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
needs AS (
  SELECT *, middle / nullif(target, 0) * (a + b) / 2 AS need FROM placed)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE size * ((middle < target)::INT + (middle + source_size < target)::INT) END::BIGINT AS taken,
       CASE WHEN size > 0 AND middle < target THEN round(2 * need / (a + sqrt(a * a + 2 * (b - a) * need)), 6) END AS first_position
FROM needs
"""


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose 5-word shingle sets are similar at 0.75."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE["op8_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh
    FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM pair JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) m ON m.a = d.doc_id
"""


@query
def op9_line_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages that earlier ones hold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_align.dedup_lines(docs)


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts of every whole document for the 50k byte-level vocabulary."""
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its form and root among the words one edit away."""
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


# crc32 byte by byte, from the table that its polynomial generates; near words share what is
# left when one letter is deleted at the same place, or one is the other without a letter
ORACLE["op11_spelling_groups"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(256) r(i))),
run AS (
  SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-z\x{C0}-\x{FF}]+')) AS w
    FROM documents)
  GROUP BY ALL),
octets AS (
  SELECT doc_id, w, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''),
    lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [192 + unicode(ch) // 64, 128 + unicode(ch) % 64] END)) AS b
  FROM run),
summed AS (
  SELECT w, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) AS h
  FROM octets, crc_table),
result AS (
  SELECT CASE WHEN h % 199 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS w, n FROM summed),
words AS (SELECT w, sum(n)::BIGINT AS n FROM result WHERE length(w) >= 6 GROUP BY w HAVING sum(n) >= 5),
less AS (SELECT w, i, w[:i] || w[i + 2:] AS d FROM (SELECT w, unnest(range(length(w))) AS i FROM words)),
near AS (
  SELECT x.w AS a, y.w AS b FROM less x JOIN less y ON x.i = y.i AND x.d = y.d AND x.w <> y.w
  UNION SELECT l.w, o.w FROM less l JOIN words o ON l.d = o.w
  UNION SELECT o.w, l.w FROM less l JOIN words o ON l.d = o.w),
ranked AS (
  SELECT a, b, v.n AS n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY v.n DESC, encode(b)) AS k
  FROM near JOIN words v ON v.w = b),
formed AS (
  SELECT w, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN r.n >= 5 * words.n THEN b END AS form, CASE WHEN r.n >= 5 * words.n THEN r.n END AS form_n
  FROM words LEFT JOIN ranked r ON a = w AND k = 1),
way AS (
  SELECT w, w AS here, 0 AS step FROM formed
  UNION ALL SELECT way.w, f.form, step + 1 FROM way JOIN formed f ON f.w = way.here WHERE f.form IS NOT NULL)
SELECT f.w AS word, form, arg_max(here, step) AS root, n, n_near::BIGINT AS n_near, form_n
FROM formed f JOIN way ON way.w = f.w GROUP BY f.w, form, n, n_near, form_n
"""


@query
def op12_lexical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item, all documents scanned."""
    return lexical_scan.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op12_lexical_scan"] = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(t) AS t FROM doc) GROUP BY ALL),
total AS (SELECT count(*) AS N, sum(len(t))::BIGINT AS L FROM doc WHERE len(t) > 0),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
weight AS (SELECT t, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, total),
long AS (SELECT r, doc_id, 100 - 50 + ((50 * len(t) * N) // L) AS m FROM doc, total WHERE len(t) > 0),
item AS (
  SELECT DISTINCT i, item_id, t FROM (
    SELECT row_number() OVER () AS i, item_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM benchmark)),
scored AS (
  SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM item JOIN tf USING (t) JOIN weight USING (t) JOIN long USING (r) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""


@query
def op13_shard_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled uniformly into 40 shards of equal numbers of rows."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))
