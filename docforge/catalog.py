"""The registered queries of the document operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docforge.functions import rules, similarity, text, vision
from docforge.functions.adapters import apply_model, mock_ocr_lines
from docforge.operators import evidence, merge, qa, rows, sequence, validate
from docforge.sources import ingest, sinks

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL that gives the same rows."""

    def put(f: Query) -> Query:
        REGISTERED[f.__name__] = (f, sql)
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt over all cores, for work that costs far more than a shuffle: a small table may be one row group."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


LICENCE = r"(?i)licen[cs]e"


@query("SELECT doc_id, sha256(text) AS sha, substr(sha256(text), 1, 16) AS short_id, sha256('chars=' || n_chars || '|hash=' || sha256(text)) AS cache_key FROM documents")
def doc_hash_ids(spark, d):
    sha = F.sha2(F.col("text").cast("binary"), 256)
    return table(spark, d, "documents").select("doc_id", sha.alias("sha"), F.substring(sha, 1, 16).alias("short_id"), text.cache_key(hash=sha, chars=F.col("n_chars")).alias("cache_key"))


@query("SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def doc_dedup_keep_first(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", F.sha2(F.col("text").cast("binary"), 256).alias("h"))
    return sequence.keep_first(docs, ["h"], ["doc_id"]).select("doc_id", "lang", "source")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) WHERE n = 1")
def doc_skip_processed(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("file_id")).join(table(spark, d, "labels"), "doc_id", "left_anti")
    return ingest.not_processed(docs, docs.select("file_id").limit(0), order="doc_id").select("doc_id")


@query("SELECT doc_id, source FROM (SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 50) ORDER BY doc_id LIMIT 20")
def doc_limit_chain(spark, d):
    return ingest.limited(table(spark, d, "documents").select("doc_id", "source"), "doc_id", 50, 20)


@query("SELECT doc_id FROM documents ORDER BY sha256(doc_id || ':42'), doc_id LIMIT 25")
def doc_hash_sample(spark, d):
    return ingest.hash_sample(table(spark, d, "documents").select("doc_id"), F.col("doc_id"), 25)


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), ' '), '^\n+', ''), '\n{3,}', chr(10) || chr(10), 'g'), '- *\n', '-', 'g'), ' ') AS clean FROM documents""")
def doc_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", F.trim(F.regexp_replace(text.collapse_lines(text.plain_lines(F.col("text"))), "- *\n", "-")).alias("clean"))


@query(r"""WITH f AS (
  SELECT doc_id, list_reduce(list_transform(string_split(text, chr(10)), lambda x: [x]), lambda a, x:
    CASE WHEN x[1] <> '' AND a[-1] <> '' AND NOT regexp_matches(a[-1], '[:;.?!]$') AND NOT regexp_matches(x[1], '^[0-9]+[.)][ \t]+') AND regexp_matches(x[1], '^\p{Ll}')
         THEN list_concat(a[1:len(a) - 1], [a[-1] || ' ' || x[1]]) ELSE list_concat(a, x) END) AS lines FROM documents)
SELECT doc_id, len(lines) AS n_lines, sha256(array_to_string(lines, chr(10))) AS folded_sha FROM f""")
def doc_soft_wrap_fold(spark, d):
    docs = text.once(table(spark, d, "documents").select("doc_id", "text"), folded=text.fold_lines(F.col("text")))
    return docs.select("doc_id", F.size(F.split("folded", "\n", -1)).cast("long").alias("n_lines"), F.sha2(F.col("folded").cast("binary"), 256).alias("folded_sha"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)
SELECT doc_id, pos, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_at, length(line) AS n FROM l""")
def doc_line_offsets(spark, d):
    spans = table(spark, d, "documents").select("doc_id", F.posexplode(similarity.line_spans(F.col("text"))).alias("pos", "s"))
    return spans.select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("s.start").cast("long").alias("start_at"), F.char_length("s.line").cast("long").alias("n"))


@query("SELECT doc_id, sha256(trim(regexp_replace(translate(upper(strip_accents(replace(text, 'ß', 'ss'))), '01', 'OI'), '[^A-Z0-9]+', ' ', 'g'))) AS key_sha FROM documents")
def doc_match_key(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(text.match_key(F.col("text")).cast("binary"), 256).alias("key_sha"))


@query(r"SELECT doc_id, sha256(trim(regexp_replace(strip_accents(lower(text)), '[^\p{L}\p{N}_]+', ' ', 'g'))) AS compare_sha FROM documents")
def doc_compare_key(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(text.compare_key(F.col("text")).cast("binary"), 256).alias("compare_sha"))


@query(r"SELECT source, count(*) AS n, min(trim(regexp_replace(upper(strip_accents(lower(source))), '[^A-Z0-9]+', '_', 'g'), '_')) AS header FROM documents GROUP BY source")
def doc_ascii_key(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.min(text.safe_header(F.col("source"))).alias("header"))


@query("""WITH m AS (SELECT doc_id, text, strpos(lower(text), 'licen') AS place FROM documents)
SELECT doc_id, place > 0 AS found, CASE WHEN place > 0 THEN trim(substr(text, 1, place - 1), ' ' || chr(10) || chr(9)) ELSE text END AS before_text,
       CASE WHEN place > 0 THEN length(text) - place - 4 ELSE 0 END AS after_chars FROM m""")
def marker_exact_split(spark, d):
    at = F.instr(F.lower("text"), "licen")
    docs = text.once(table(spark, d, "documents").select("doc_id", "text"), m=F.struct((at > 0).alias("found"), (at - 1).alias("start"), (at + 4).alias("end")))
    before, _ = similarity.split_before(F.col("text"), F.col("m"))
    return docs.select("doc_id", "m.found", before.alias("before_text"), F.when(F.col("m.found"), F.char_length("text") - F.col("m.end")).otherwise(0).cast("long").alias("after_chars"))


FUZZY = "GNU General Public License"


@query(f"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, i * 3 + k AS rank, trim(array_to_string(ls[i:i + k - 1], ' '), ' ' || chr(9)) AS raw FROM l, unnest(range(1, len(ls) + 1)) AS a(i), unnest([1, 2, 3]) AS b(k)),
c AS (SELECT *, trim(regexp_replace(translate(upper(strip_accents(replace(raw, 'ß', 'ss'))), '01', 'OI'), '[^A-Z0-9]+', ' ', 'g')) AS key, '{FUZZY.upper()}' AS goal FROM w WHERE raw <> ''),
n AS (SELECT * FROM c WHERE 200 * least(length(key), length(goal)) >= 50 * (length(key) + length(goal))),
s AS (SELECT *, 200.0::DOUBLE * list_reduce(list_transform(string_split(key, ''), lambda x: [[0]] || [[ascii(x)]]),
        lambda acc, x: [list_reduce(list_transform(range(1, length(goal) + 1), lambda j: [j]), lambda r, j: r || [CASE WHEN ascii(substr(goal, j[1], 1)) = x[2][1] THEN acc[1][j[1]] + 1 ELSE greatest(r[-1], acc[1][j[1] + 1]) END], [0])],
        [list_transform(range(0, length(goal) + 1), lambda j: 0)])[1][-1] / (length(key) + length(goal)) AS score FROM n)
SELECT doc_id, arg_max(raw, (score, -rank)) AS best_text, round(max(score), 6) AS score, coalesce(max(score) >= 82, false) AS found FROM documents LEFT JOIN s USING (doc_id) GROUP BY doc_id""")
def marker_fuzzy_window(spark, d):
    docs = text.once(table(spark, d, "documents").select("doc_id", "text"), best=similarity.best_window(F.col("text"), FUZZY, 50.0))
    return docs.select("doc_id", F.col("best.text").alias("best_text"), F.round("best.score", 6).alias("score"), F.coalesce(F.col("best.score") >= 82, F.lit(False)).alias("found"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos, strpos(lower(text), 'licen') AS place FROM documents),
o AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM l),
k AS (SELECT doc_id, pos, CASE WHEN s + length(line) <= place - 1 THEN line ELSE trim(substr(line, 1, (place - 1 - s)::BIGINT), ' ' || chr(9)) END AS kept FROM o WHERE place > 0 AND s < place - 1)
SELECT doc_id, count(*) AS n_kept, sha256(string_agg(kept, chr(10) ORDER BY pos)) AS kept_sha FROM k WHERE kept <> '' GROUP BY doc_id""")
def marker_trim_lines(spark, d):
    at = F.instr(F.lower("text"), "licen")
    docs = text.once(table(spark, d, "documents").where(at > 0).select("doc_id", "text"), kept=sequence.trim_lines(similarity.line_spans(F.col("text")), at - 1))
    return docs.where(F.size("kept") > 0).select("doc_id", F.size("kept").cast("long").alias("n_kept"), F.sha2(F.array_join("kept", "\n").cast("binary"), 256).alias("kept_sha"))


EARLY_SQL = """WITH p AS (SELECT {key} AS k, {page} AS p, {hit} AS h FROM {table}), c AS (SELECT k, count(*) AS page_count, min(p) FILTER (h AND p <= 7) AS f FROM p GROUP BY k)
SELECT k AS {key}, coalesce(f, least(7, page_count))::BIGINT AS pages_ocr, f::BIGINT AS marker_page,
       CASE WHEN f IS NOT NULL THEN 'content_marker_found' WHEN page_count <= 7 THEN 'end_of_pdf_without_marker' ELSE 'max_pages_before_content_marker_reached' END AS stop_reason, page_count FROM c"""


@query(EARLY_SQL.format(key="conv_id", page="turn + 1", hit="length(text) > 200", table="conversations"))
def early_stop_turns(spark, d):
    return sequence.early_stop(table(spark, d, "conversations").withColumn("page", F.col("turn") + 1), "conv_id", "page", F.char_length("text") > 200)


@query(EARLY_SQL.format(key="l_orderkey", page="l_linenumber", hit="l_returnflag = 'R'", table="lineitem"))
def early_stop_lineitems(spark, d):
    return sequence.early_stop(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber", F.col("l_returnflag") == "R")


@query("SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn, text) AS text FROM conversations WHERE trim(text) <> '' GROUP BY conv_id")
def page_concat(spark, d):
    return sequence.page_text(table(spark, d, "conversations"), "conv_id", "turn", "text")


@query(r"""WITH t AS (SELECT conv_id, turn, regexp_extract_all(text, '(?i)\b(user|assistant|the)\b') AS labels FROM conversations)
SELECT conv_id, turn, len(labels) AS n_labels, lower(labels[1]) AS first_label FROM t WHERE len(labels) > 0""")
def role_segments(spark, d):
    labels = F.regexp_extract_all("text", F.lit(r"(?i)\b(user|assistant|the)\b"), F.lit(1))
    turns = text.once(table(spark, d, "conversations").select("conv_id", "turn", "text"), labels=labels)
    return turns.where(F.size("labels") > 0).select("conv_id", "turn", F.size("labels").cast("long").alias("n_labels"), F.lower(F.get("labels", F.lit(0))).alias("first_label"))


@query(r"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?i)</(?:p|div|li|tr|br)\s*>', chr(10), 'g'), '<[^>]+>', ' ', 'g') AS t FROM pages),
b AS (SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS t FROM a)
SELECT page_id, sha256(trim(regexp_replace(regexp_replace(t, '[ \t]+', ' ', 'g'), '\n[ \t]+', chr(10), 'g'), ' ' || chr(10) || chr(9))) AS text_sha FROM b""")
def html_to_text(spark, d):
    return table(spark, d, "pages").select("page_id", F.sha2(text.html_text(F.col("html")).cast("binary"), 256).alias("text_sha"))


@query(r"""WITH m AS (SELECT doc_id, regexp_extract(text, '([0-9]{16})', 1) AS card, regexp_extract(text, '(\([0-9]{3}\) [0-9]{3}-[0-9]{4})', 1) AS phone FROM documents)
SELECT doc_id, nullif(card, '') AS card, nullif(regexp_replace(phone, '[^0-9]', '', 'g'), '') AS phone, CASE WHEN card <> '' THEN 'card' WHEN phone <> '' THEN 'phone' ELSE 'none' END AS kind FROM m""")
def ident_extract(spark, d):
    card, phone = F.regexp_extract("text", "([0-9]{16})", 1), F.regexp_replace(F.regexp_extract("text", r"(\([0-9]{3}\) [0-9]{3}-[0-9]{4})", 1), "[^0-9]", "")
    docs = table(spark, d, "documents").select("doc_id", rules.none_if_empty(card).alias("card"), rules.none_if_empty(phone).alias("phone"))
    return docs.withColumn("kind", F.when(F.col("card").isNotNull(), "card").when(F.col("phone").isNotNull(), "phone").otherwise("none"))


CONTACTS = [r"([A-Za-z0-9._]+@[A-Za-z0-9.]+)", r"([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})", r"(AKIA[A-Z0-9]{16})"]


@query("SELECT doc_id, coalesce(" + ", ".join(f"nullif(regexp_extract(text, '{p}', 1), '')" for p in CONTACTS) + ") AS contact FROM documents")
def contact_extract(spark, d):
    return table(spark, d, "documents").select("doc_id", rules.first_match(F.col("text"), CONTACTS).alias("contact"))


@query("""SELECT CASE WHEN regexp_matches(text, '(?i)licen[cs]e') THEN 'licence' WHEN contains(text, '@') THEN 'contact' WHEN contains(text, ' | ') THEN 'table' ELSE 'prose' END AS kind,
       lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY ALL""")
def doc_type_classify(spark, d):
    kind = F.when(F.rlike("text", F.lit(LICENCE)), "licence").when(F.contains("text", F.lit("@")), "contact").when(F.contains("text", F.lit(" | ")), "table").otherwise("prose")
    return table(spark, d, "documents").groupBy(kind.alias("kind"), "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS written, '31/02/' || year(o_orderdate) AS odd, true AS written_valid, false AS odd_valid FROM orders""")
def date_parse_format(spark, d):
    day = lambda f: F.date_format("o_orderdate", f)
    orders = table(spark, d, "orders").select("o_orderkey", rules.parse_date(F.concat(F.lit("Ngày "), day("d"), F.lit(" tháng "), day("M"), F.lit(" năm "), day("yyyy"))).alias("written"), rules.parse_date(F.concat(F.lit("31-2-"), day("yyyy"))).alias("odd"))
    return orders.select("*", rules.valid_date(F.col("written")).alias("written_valid"), rules.valid_date(F.col("odd")).alias("odd_valid"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, least(1.0, greatest(0.0, coalesce(try_cast(json_extract_string(props, '$.k') AS DOUBLE) / 100, 0.0)))::DOUBLE AS confidence, json_type(props) = 'OBJECT' AS ok FROM events")
def json_props(spark, d):
    k = F.get_json_object("props", "$.k")
    return table(spark, d, "events").select("event_id", k.alias("k"), text.clamp(k.try_cast("double") / 100).alias("confidence"), F.coalesce(F.startswith(F.schema_of_variant(F.try_parse_json("props")), F.lit("OBJECT")), F.lit(False)).alias("ok"))


@query("SELECT event_id, coalesce(json_extract_string(props, '$.key'), json_extract_string(props, '$.k'), 'none') AS value FROM events")
def field_alias_lookup(spark, d):
    return table(spark, d, "events").select("event_id", F.coalesce(F.get_json_object("props", "$.key"), F.get_json_object("props", "$.k"), F.lit("none")).alias("value"))


@query("""WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS i FROM conversations),
u AS (SELECT * FROM t WHERE role = 'user'), a AS (SELECT * FROM t WHERE role = 'assistant')
SELECT coalesce(u.conv_id, a.conv_id) AS conv_id, coalesce(u.i, a.i) AS i, length(u.text) AS user_chars, length(a.text) AS assistant_chars FROM u FULL JOIN a ON u.conv_id = a.conv_id AND u.i = a.i""")
def positional_merge(spark, d):
    turns = table(spark, d, "conversations").withColumn("i", (F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn")) - 1).cast("long"))
    side = lambda role, out: turns.where(F.col("role") == role).select("conv_id", "i", F.char_length("text").cast("long").alias(out))
    return side("user", "user_chars").join(side("assistant", "assistant_chars"), ["conv_id", "i"], "full")


def scorers(spark: SparkSession, d: str) -> DataFrame:
    """Two extractors of a quality label: the gold labels, and one that goes by length."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    side = lambda value, confidence, method: F.struct(value.cast("string").alias("value"), confidence.alias("confidence"), F.lit(method).alias("source_method"))
    short = F.when(F.col("n_chars") < 50, None).otherwise((F.col("n_chars") > 500).cast("int"))
    return docs.select("doc_id", side(F.col("quality"), F.when(F.col("toxic") == 1, 0.4).otherwise(0.8), "labels").alias("p"), side(short, F.when(F.col("n_chars") > 2000, 0.9).otherwise(0.6), "length").alias("s"))


@query("""WITH b AS (SELECT doc_id, quality::VARCHAR AS p, CASE WHEN toxic = 1 THEN 0.4 ELSE 0.8 END AS pc, CASE WHEN n_chars < 50 THEN NULL ELSE (n_chars > 500)::INT::VARCHAR END AS s, CASE WHEN n_chars > 2000 THEN 0.9 ELSE 0.6 END AS sc FROM documents JOIN labels USING (doc_id)),
c AS (SELECT *, s IS NOT NULL AND p <> s AS clash, s IS NOT NULL AND p <> s AND sc > pc AS other FROM b)
SELECT doc_id, CASE WHEN other THEN s ELSE p END AS value, (CASE WHEN other THEN sc ELSE pc END)::DOUBLE AS confidence,
       CASE WHEN clash THEN 'Conflict giữa extractor ở field quality; chọn ' || CASE WHEN other THEN 'length' ELSE 'labels' END || ' theo confidence.' END AS warning FROM c""")
def conflict_resolution(spark, d):
    chosen = merge.select_field(F.col("p"), F.col("s"))
    return scorers(spark, d).select("doc_id", chosen["value"].alias("value"), chosen["confidence"].alias("confidence"), merge.conflict_note(F.col("p"), F.col("s"), F.lit("quality")).alias("warning"))


@query("""WITH w AS (SELECT doc_id, [CASE WHEN n_chars < 200 THEN 'short' END, CASE WHEN lang <> 'en' THEN 'foreign' END, '', CASE WHEN n_chars < 500 THEN 'short' ELSE 'long' END, source] AS a FROM documents)
SELECT doc_id, array_to_string(list_filter(a, lambda x, i: x IS NOT NULL AND x <> '' AND list_position(a, x) = i), '; ') AS warnings FROM w""")
def ordered_distinct_warnings(spark, d):
    n = F.col("n_chars")
    groups = F.array(F.when(n < 200, "short"), F.when(F.col("lang") != "en", "foreign"), F.lit("")), F.array(F.when(n < 500, "short").otherwise("long"), F.col("source"))
    return table(spark, d, "documents").select("doc_id", F.array_join(merge.ordered_distinct(*groups), "; ").alias("warnings"))


@query("""WITH d AS (SELECT doc_id, documents.lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
m AS (SELECT *, array_to_string(list_filter([CASE WHEN lang = 'en' THEN NULL ELSE 'ENGLISH' END, CASE WHEN quality IS NULL THEN 'QUALITY' END, CASE WHEN n_chars >= 100 THEN NULL ELSE 'LENGTH' END], lambda x: x IS NOT NULL), ', ') AS missing FROM d)
SELECT doc_id, nullif(missing, '') AS missing, missing <> '' OR coalesce(toxic = 1, false) AS review_required FROM m""")
def validate_docs(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    fields = {"ENGLISH": F.when(F.col("lang") == "en", "y"), "QUALITY": F.col("quality").cast("string"), "LENGTH": F.when(F.col("n_chars") >= 100, "y")}
    docs = docs.withColumn("missing", validate.missing(fields))
    return docs.select("doc_id", "missing", (F.col("missing").isNotNull() | F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("review_required"))


@query(r"""WITH k AS (SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM documents),
b AS (SELECT item_id, trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS e FROM benchmark)
SELECT item_id, count(*) AS n_docs, min(doc_id) AS first_doc FROM k JOIN b ON e <> '' AND (contains(t, e) OR contains(replace(t, ' ', ''), replace(e, ' ', ''))) GROUP BY item_id""")
def evidence_contains(spark, d):
    found = evidence.holds(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


@query("SELECT label, count(*) AS n, count(*) FILTER (list_bool_or(list_transform(embedding, lambda x: x < -0.4))) AS low FROM embeddings GROUP BY label")
def low_confidence_exists(spark, d):
    return table(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.exists("embedding", lambda x: x < -0.4)).alias("low"))


@query("""WITH d AS (SELECT doc_id, CASE WHEN n_chars > 1000 THEN [source, lang] WHEN n_chars > 300 THEN [lang] ELSE [] END AS items, CASE WHEN lang = 'en' THEN '' ELSE 'foreign' END AS common FROM documents),
x AS (SELECT doc_id, unnest(items) AS item, unnest(range(len(items))) AS i, common FROM d UNION ALL SELECT doc_id, NULL, NULL, common FROM d WHERE len(items) = 0)
SELECT doc_id, coalesce(i, 0)::BIGINT AS i, item, nullif(array_to_string(list_filter([coalesce(item, 'nothing found'), common], lambda y: y <> ''), '; '), '') AS note FROM x""")
def rows_with_default(spark, d):
    n = F.col("n_chars")
    items = F.when(n > 1000, F.array("source", "lang")).when(n > 300, F.array("lang")).otherwise(F.array().cast("array<string>"))
    docs = table(spark, d, "documents").select("doc_id", items.alias("items"), F.when(F.col("lang") == "en", "").otherwise("foreign").alias("common"))
    out = rows.explode_with_default(docs, "items", "item", "nothing found", F.col("common"))
    return out.select("doc_id", F.coalesce("item_index", F.lit(0)).cast("long").alias("i"), "item", "note")


@query(r"""SELECT doc_id, NULL::VARCHAR AS text, true AS sensitive_text_redacted, CASE WHEN length(s) > 240 THEN substr(s, 1, 240) || '... [truncated]' ELSE s END AS preview
FROM (SELECT doc_id, trim(regexp_replace(source || ' ' || lang || ' ' || repeat(source || '  ', (doc_id % 60)::INT), '\s+', ' ', 'g')) AS s FROM documents)""")
def redact_rows(spark, d):
    docs = table(spark, d, "documents").withColumn("preview", text.log_safe(F.concat("source", F.lit(" "), "lang", F.lit(" "), F.expr("repeat(source || '  ', cast(doc_id % 60 as int))"))))
    return rows.redact(docs.select("doc_id", "text", "preview"), ["text"])


@query("""WITH d AS (SELECT lang, documents.source AS source, quality::VARCHAR AS quality, toxic::VARCHAR AS toxic FROM documents LEFT JOIN labels USING (doc_id)),
u AS (SELECT lang, unnest(['source', 'quality', 'toxic']) AS field, unnest([source, quality, toxic]) AS v FROM d)
SELECT lang, field, count(*) AS total, count(*) FILTER (v IS NOT NULL AND trim(v) <> '') AS non_empty, count(*) FILTER (v IS NULL OR trim(v) = '') AS empty FROM u GROUP BY ALL""")
def fill_rate(spark, d):
    return qa.fill_rates(table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left"), ["source", "quality", "toxic"], ["lang"])


@query("SELECT coalesce(source, 'unknown') AS extractor, count(*) AS n FROM documents GROUP BY ALL")
def extractor_histogram(spark, d):
    return qa.histogram(table(spark, d, "documents"), F.col("source"), "extractor")


WARNINGS = ["Cần review: không tìm thấy marker", "Thiếu thông tin chung: x", "Thiếu: y", "Local LLM off", "sonst"]


@query("SELECT CASE doc_id % 5 WHEN 0 THEN 'missing_marker' WHEN 1 THEN 'missing_case_fields' WHEN 2 THEN 'missing_participant_fields' WHEN 3 THEN 'local_llm' ELSE 'other' END AS category, count(*) AS n FROM documents GROUP BY ALL")
def warning_histogram(spark, d):
    said = F.get(F.array(*(F.lit(w) for w in WARNINGS)), (F.col("doc_id") % 5).cast("int"))
    return qa.histogram(table(spark, d, "documents"), qa.warning_group(said), "category")


@query("""SELECT 'batch' AS section, unnest(['turns', 'conversations']) AS key, unnest([count(*), count(DISTINCT conv_id)]) AS n FROM conversations
UNION ALL SELECT 'roles', role, count(*) FROM conversations GROUP BY role
UNION ALL SELECT 'labels', unnest(['toxic', 'good']), unnest([count(*) FILTER (toxic = 1), count(*) FILTER (quality = 1)]) FROM labels""")
def qa_report(spark, d):
    turns, labels = table(spark, d, "conversations"), table(spark, d, "labels")
    return qa.sections({
        "batch": turns.agg(F.count("*").alias("turns"), F.countDistinct("conv_id").alias("conversations")), "roles": qa.histogram(turns, F.col("role"), "key"),
        "labels": labels.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("quality") == 1).alias("good")),
    })


@query("""WITH j AS (SELECT quality::VARCHAR AS gq, toxic::VARCHAR AS gt, (n_chars > 500)::INT::VARCHAR AS pq, contains(text, 'idiot')::INT::VARCHAR AS pt FROM labels LEFT JOIN documents USING (doc_id))
SELECT unnest(['quality', 'toxic']) AS field, unnest([count(*) FILTER (gq = coalesce(pq, '')), count(*) FILTER (gt = coalesce(pt, ''))]) AS correct, count(*) AS total,
       unnest([count(*) FILTER (gq = coalesce(pq, '')), count(*) FILTER (gt = coalesce(pt, ''))]) / count(*)::DOUBLE AS accuracy FROM j""")
def field_accuracy(spark, d):
    gold = table(spark, d, "labels").select(F.col("doc_id").alias("source_file"), F.lit("0").alias("row_index"), F.col("quality").cast("string"), F.col("toxic").cast("string"))
    docs = table(spark, d, "documents")
    predicted = docs.select(F.col("doc_id").alias("source_file"), F.lit(0).alias("row_index"), (F.col("n_chars") > 500).cast("int").cast("string").alias("quality"), F.contains("text", F.lit("idiot")).cast("int").cast("string").alias("toxic"))
    return qa.field_accuracy(gold, predicted, ["quality", "toxic"])


@query("""WITH c AS (SELECT doc_id, min(CASE WHEN doc_id % 3 = 0 THEN '0' ELSE '1' END || sha256(text)) AS best FROM documents WHERE doc_id % 2 = 0 GROUP BY doc_id)
SELECT doc_id::VARCHAR AS stem, sha256(text) AS ocr_raw, coalesce(substr(best, 2), '') AS ocr_corrected FROM documents LEFT JOIN c USING (doc_id)""")
def correction_dataset(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("stem"), F.sha2(F.col("text").cast("binary"), 256).alias("text"), "doc_id")
    suffix = F.when(F.col("doc_id") % 3 == 0, "_corrected").otherwise("_normalized")
    corrected = docs.where("doc_id % 2 = 0").select(F.concat("stem", suffix).alias("stem"), "text")
    return ingest.corrected_texts(docs.select("stem", "text"), corrected)


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)
SELECT doc_id, count(*) AS n_boxes, min(40.0 + 34 * i)::DOUBLE AS top, max(68.0 + 34 * i)::DOUBLE AS bottom FROM l WHERE trim(line) <> '' GROUP BY doc_id""")
def bbox_synth(spark, d):
    docs = text.once(table(spark, d, "documents").select("doc_id", "text"), boxes=mock_ocr_lines(F.col("text"))).where(F.size("boxes") > 0)
    edge = lambda k, f: f(F.transform("boxes", lambda b: F.get(b["bbox"], F.lit(k))))
    return docs.select("doc_id", F.size("boxes").cast("long").alias("n_boxes"), edge(1, F.array_min).alias("top"), edge(3, F.array_max).alias("bottom"))


@query("SELECT vec_id, round(list_stddev_pop(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS spread, list_stddev_pop(list_transform(embedding, lambda x: x::DOUBLE)) < 0.12 AS low_contrast FROM embeddings")
def image_stats(spark, d):
    spread = vision.population_std(F.col("embedding"))
    return table(spark, d, "embeddings").select("vec_id", F.round(spread, 6).alias("spread"), (spread < 0.12).alias("low_contrast"))


@query("""WITH f AS (SELECT doc_id, n_chars, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS n FROM documents)
SELECT count(*) AS total, count(*) FILTER (n = 1 AND n_chars >= 100) AS success, count(*) FILTER (n = 1 AND n_chars < 100) AS failed, count(*) FILTER (n > 1) AS skipped FROM f""")
def batch_summary(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars", F.sha2(F.col("text").cast("binary"), 256).alias("h"))
    processed = sequence.keep_first(docs, ["h"], ["doc_id"]).withColumn("error", F.when(F.col("n_chars") < 100, "too short"))
    return sinks.batch_summary(docs, processed)


@query("""SELECT event_id, CASE WHEN length(e) > 220 THEN substr(e, 1, 217) || '...' ELSE e END AS error FROM (SELECT event_id, trim(repeat(event_type || ' ', (event_id % 60)::INT + 1)) AS e FROM events WHERE value > 50) ORDER BY event_id LIMIT 10""")
def first_failures(spark, d):
    events = table(spark, d, "events").withColumn("error", F.when(F.col("value") > 50, F.expr("repeat(event_type || ' \n', cast(event_id % 60 as int) + 1)")))
    return sinks.first_failures(events.select("event_id", "error"), "event_id")


def load_stub() -> Callable[[str | None], str]:
    """A stand-in for a model: it fails on texts without a full stop."""

    def model(value: str | None) -> str:
        if "." not in (value or ""):
            raise ValueError("no sentence")
        return value.split(".", 1)[0].strip().lower()

    return model


@query("""SELECT doc_id, contains(text, '.') AS ok, CASE WHEN contains(text, '.') THEN sha256(lower(trim(string_split(text, '.')[1], ' ' || chr(10) || chr(9)))) END AS answer_sha FROM documents""")
def stub_extractor_udf(spark, d):
    out = apply_model(table(spark, d, "documents").select("doc_id", "text"), "text", load_stub, "string", retries=0)
    return out.select("doc_id", F.col("model.ok").alias("ok"), F.sha2(F.col("model.value").cast("binary"), 256).alias("answer_sha"))


@query(None)
def extract_documents(spark, d):
    """The whole extraction plan over documents; rules for Vietnamese judgments find little in them."""
    from docforge.plans.extract import extract

    return rows.flat_rows(extract(spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id"), source="doc_id"))


@query("""WITH f AS (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS n FROM documents),
c AS (SELECT lang, unnest(['email', 'phone', 'card', 'ip']) AS field, unnest([regexp_matches(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+'), regexp_matches(text, '\\([0-9]{3}\\) [0-9]{3}-[0-9]{4}'), regexp_matches(text, '[0-9]{16}'), regexp_matches(text, '[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}')]) AS hit FROM f WHERE n = 1)
SELECT lang, field, count(*) AS total, count(*) FILTER (hit) AS non_empty, count(*) FILTER (NOT hit) AS empty FROM c GROUP BY ALL""")
def contact_fill_rates(spark, d):
    return flagship(spark, d)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, the first of equal texts each, normalised; how many hold which contact, by language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text", F.sha2(F.col("text").cast("binary"), 256).alias("h"))
    first = sequence.keep_first(docs, ["h"], ["doc_id"])
    hit = lambda p: F.when(F.rlike("t", F.lit(p)), "y")
    t = first.select("lang", text.plain_lines(F.col("text")).alias("t"))
    return qa.fill_rates(t.select("lang", hit("[A-Za-z0-9._]+@[A-Za-z0-9.]+").alias("email"), hit(r"\([0-9]{3}\) [0-9]{3}-[0-9]{4}").alias("phone"), hit("[0-9]{16}").alias("card"), hit(r"[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}").alias("ip")), ["email", "phone", "card", "ip"], ["lang"])


def queries() -> dict[str, Query]:
    from docforge import catalog_files, catalog_rules, catalog_runs  # noqa: F401  they register their queries

    return {name: f for name, (f, _) in REGISTERED.items()}


def oracle_sql() -> dict[str, str]:
    queries()
    return {name: sql for name, (_, sql) in REGISTERED.items() if sql}
