"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.llm import ann, centroids, decontam, idfiles, langid, linededup, mixing, pii, simhash, substring, toxicity, trie, urlfilter

#: Key of the registered surrogates; a real run passes its own secret.
PII_KEY = b"registered query"

#: Fixed values of the registered URL filter.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, winning rule and verdict."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judge(read(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT p.*, r.*, row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS n
  FROM parts p LEFT JOIN rules r ON (p.host = rule_host OR p.host LIKE '%.' || rule_host) AND starts_with(p.path, rule_path)
)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict FROM fits WHERE n = 1
"""


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every twentieth embedding among all others."""
    return ann.search(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, words removed as repeats of 13 words, and the digest of what is kept."""
    out = substring.remove_repeats(read(spark, sf_dir, "documents"), size=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates, and the entities that were replaced."""
    out = pii.pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return out.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), "entities")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's 3-word SimHash and the component of fingerprints within 3 bits."""
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, distance=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language under byte context trees learnt from the documents that are not held out."""
    out = langid.identify(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, lines removed as within one edit of an earlier line, and the digest of what is kept.

    Lines of under 20 characters (linededup.MIN_CHARS) are neither removed nor compared, as the SQL says too.
    """
    out = linededup.dedupe_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents
), own AS (
  SELECT *, length(line) AS n, row_number() OVER (ORDER BY doc_id, pos) AS r FROM lines
), part AS (SELECT * FROM own WHERE n >= 20),
gone AS (
  SELECT DISTINCT a.r FROM part a JOIN part b ON b.r < a.r AND b.n BETWEEN a.n - 1 AND a.n + 1
  WHERE CASE WHEN left(a.line, least(a.n, b.n) // 2) = left(b.line, least(a.n, b.n) // 2) OR right(a.line, least(a.n, b.n) // 2) = right(b.line, least(a.n, b.n) // 2)
             THEN levenshtein(a.line, b.line) <= 1 ELSE false END
)
SELECT doc_id, count(*) AS n_lines, count(gone.r) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (gone.r IS NULL), '')) AS kept_sha256
FROM own LEFT JOIN gone ON own.r = gone.r GROUP BY doc_id
"""


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability of being marked toxic."""
    out = toxicity.toxicity(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's topic, tokens, raked weight, probability and whether it is sampled."""
    out = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return out.select("doc_id", "source", "lang", "topic", "tokens", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "sampled")


OP9_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, source, lang, coalesce(source, 'unknown') AS s, coalesce(lang, 'unknown') AS l,
         CASE WHEN contains(text, 'icense') THEN 'licence' WHEN contains(text, '@') THEN 'contact' WHEN contains(text, ' | ') THEN 'tabular'
              WHEN contains(text, 'http') THEN 'reference' ELSE 'general' END AS topic,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS tokens
  FROM documents
), cells AS (
  SELECT s, l, topic, sum(tokens)::DOUBLE AS w FROM docs WHERE tokens > 0 GROUP BY ALL
), ts AS (SELECT s, pow(sum(w), 0.5) AS p FROM cells GROUP BY s),
tl AS (SELECT l, pow(sum(w), 0.5) AS p FROM cells GROUP BY l),
tt AS (SELECT topic, pow(sum(w), 0.7) AS p FROM cells GROUP BY topic),
start AS (
  SELECT c.*, (SELECT sum(w) FROM cells) AS n, ts.p / (SELECT sum(p) FROM ts) AS gs, tl.p / (SELECT sum(p) FROM tl) AS gl, tt.p / (SELECT sum(p) FROM tt) AS gt
  FROM cells c JOIN ts USING (s) JOIN tl USING (l) JOIN tt USING (topic)
), ipf AS (
  SELECT 0 AS i, *, 1.0::DOUBLE AS f FROM start
  UNION ALL
  SELECT i + 1, s, l, topic, w, n, gs, gl, gt, f * gt * n / sum(w * f) OVER (PARTITION BY topic) FROM (
    SELECT * REPLACE (f * gl * n / sum(w * f) OVER (PARTITION BY l) AS f) FROM (
      SELECT * REPLACE (f * gs * n / sum(w * f) OVER (PARTITION BY s) AS f) FROM ipf WHERE i < 80))
), fit AS (SELECT * FROM ipf WHERE i = 80),
rates AS (
  SELECT 0 AS k, 0.5::DOUBLE AS rate
  UNION ALL
  SELECT k + 1, ((SELECT 0.5 * sum(w) FROM fit) - (SELECT coalesce(sum(w), 0) FROM fit WHERE rate * f >= 1)) / (SELECT sum(w * f) FROM fit WHERE rate * f < 1) FROM rates WHERE k < 40
), p AS (SELECT s, l, topic, f, least(1.0, (SELECT rate FROM rates WHERE k = 40) * f) AS p FROM fit)
SELECT doc_id, source, lang, topic, tokens, round(coalesce(f, 0.0), 6) AS weight, round(coalesce(p, 0.0), 6) AS probability,
       tokens > 0 AND ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < coalesce(p, 0.0) AS sampled
FROM docs LEFT JOIN p USING (s, l, topic)
"""


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, hit words and the benchmark items whose windows it holds."""
    out = decontam.scan(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    c = F.col("contamination")
    return out.select(
        "doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"), F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", c["items"]).cast("binary"), 256).alias("items_sha256"),
        ((c["n_hit"] > 0) & (20 * c["n_hit"] >= c["n_words"])).alias("contaminated"),
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 64-component embedding's cluster after five rounds from 40 drawn vectors, with exact integer distances."""
    found = centroids.cluster(read(spark, sf_dir, "embeddings"), size=64, scale=256, k=40, rounds=5, seed=2)
    return centroids.with_inertia(found)


def _op11_sql() -> str:
    nearest = """{name} AS (
  SELECT vec_id, v, r, cluster, distance FROM (
    SELECT q.vec_id, q.v, q.r, c.n AS cluster, list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance,
           row_number() OVER (PARTITION BY q.r ORDER BY list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.n) AS i
    FROM q, {centroids} c) WHERE i = 1
)"""
    moved = """c{k} AS (
  SELECT n, coalesce(m.v, c.v) AS v FROM c{before} c LEFT JOIN (
    SELECT cluster, list(((s - ((s % w + w) % w)) // w)::BIGINT ORDER BY place) AS v FROM (
      SELECT cluster, place, sum(x) AS s, count(*) AS w FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS place FROM a{before}) GROUP BY cluster, place) GROUP BY cluster
  ) m ON m.cluster = c.n
)"""
    steps = ["""WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v, row_number() OVER (ORDER BY vec_id) AS r FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x) AND abs(256 * x::DOUBLE) < 134217728)) = 64
)""", """c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), vec_id) - 1 AS n, v FROM q QUALIFY n < 40
)"""]  # fmt: skip
    for k in range(6):
        steps.append(nearest.format(name=f"a{k}", centroids=f"c{k}"))
        if k < 5:
            steps.append(moved.format(k=k + 1, before=k))
    return ",\n".join(steps) + """
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c5.v, ',')) AS centroid_sha256
FROM a5 JOIN c5 ON c5.n = cluster
"""


def op12_token_ids(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Every document's place, size and checksum in Simple-8b files of its byte-level ids, read back from the files."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return idfiles.read_counts(idfiles.write_ids(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer, end_id=2))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with what its subtree holds and saves."""
    return trie.conversation_trie(read(spark, sf_dir, "conversations"), every=20, most=4)


OP13_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS seq FROM turns GROUP BY conv_id
), crc AS (
  SELECT conv_id, seq, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
         lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x // 2, 3988292384 * (x % 2))))) % 4 AS h
  FROM own
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.seq, 1, c.h), []), list_slice(c.seq, c.h + 1, len(c.seq))) AS seq
  FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
), members AS (
  SELECT conv_id, len(seq) AS n, seq, d, list_slice(seq, 1, d) AS prefix FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT d, prefix, min(conv_id) AS conv, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '') AS ends,
         len(list_filter(regexp_split_to_array(coalesce(prefix[d].text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words
  FROM members GROUP BY d, prefix
), path AS (
  SELECT m.conv_id, m.d, n.conv FROM members m JOIN nodes n ON n.d = m.d AND n.prefix = m.prefix
), tree AS (
  SELECT n.*, p.conv AS parent FROM nodes n LEFT JOIN path p ON p.conv_id = n.conv AND p.d = n.d - 1
), kids AS (
  SELECT d - 1 AS d, parent AS conv, count(*) AS n FROM tree WHERE d > 0 GROUP BY ALL
), sums AS (
  SELECT a.d, a.conv, sum((t.n_convs - 1) * t.words) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM tree t JOIN path a ON a.conv_id = t.conv AND a.d <= t.d LEFT JOIN kids k ON k.d = t.d AND k.conv = t.conv GROUP BY a.d, a.conv
)
SELECT t.conv AS conv_id, t.d::BIGINT AS depth, t.parent AS parent_conv_id, t.n_convs, coalesce(k.n, 0) AS n_children, s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(t.ends) AS ends_sha256
FROM tree t JOIN sums s ON s.d = t.d AND s.conv = t.conv LEFT JOIN kids k ON k.d = t.d AND k.conv = t.conv
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_url_filters": op1_url_filters, "op2_nearest_neighbours": op2_nearest_neighbours, "op3_substring_dedup": op3_substring_dedup, "op4_pii_surrogates": op4_pii_surrogates, "op5_simhash": op5_simhash, "op6_language_id": op6_language_id, "op7_line_dedup": op7_line_dedup, "op8_toxicity": op8_toxicity, "op9_mixing": op9_mixing, "op10_decontamination": op10_decontamination, "op11_centroid_clustering": op11_centroid_clustering, "op12_token_ids": op12_token_ids, "op13_conversation_trie": op13_conversation_trie}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": OP1_SQL, "op7_line_dedup": OP7_SQL, "op9_mixing": OP9_SQL, "op11_centroid_clustering": _op11_sql(), "op13_conversation_trie": OP13_SQL}
