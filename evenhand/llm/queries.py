"""The operators bound to the driver tables: one query each over whole tables and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand.llm import decontamination, fill_in_middle, fingerprints, html_extraction, language_id, periodic_runs, quality, quotations, sentencepiece_sampling, simhash, suffix_dedup, toxicity, url_filters
from evenhand.llm.common import remainder, table

#: The model file whose pieces are sampled, a public vocabulary.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: The rules of the contract of query 11.
RULES = [url_filters.Rule.of(line) for line in ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extraction.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    teaching = remainder("doc_id", 3) != 1
    positives = table(spark, sf_dir, "labels").filter(teaching & (F.col("quality") == 1))
    model = quality.fit(documents.filter(teaching), positives)
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return quality.classify(documents, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    teaching = remainder("doc_id", 3) != 1
    model = toxicity.fit(documents.filter(teaching), table(spark, sf_dir, "labels").filter(teaching))
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return toxicity.grade(documents, model).select("doc_id", held_out.alias("held_out"), "severity", "grade", "toxic_chance", "toxic")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.with_removed(documents, "x").select("doc_id", "x.n_bytes", "x.n_removed", "x.n_spans", "x.kept_sha256")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edits(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.linked(table(spark, sf_dir, "conversations"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    contents = language_id.train(documents.filter(remainder("doc_id", 4) != 2))
    found = language_id.identify(documents, contents)
    return found.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = sentencepiece_sampling.Vocabulary.load(PIECES)
    pieces = sentencepiece_sampling.tokenized(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    text = sentencepiece_sampling.decoded(spark, F.col("pieces"), vocabulary)
    return pieces.select(
        "doc_id", F.size("pieces").cast("long").alias("n_pieces"), F.xxhash64("pieces").alias("pieces_hash"),
        text.eqNullSafe(F.col("text")).alias("lossless"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filters.judged(table(spark, sf_dir, "pages").select("page_id", "url"), rules=RULES, out="x")
    return found.select("page_id", "x.host", "x.path", "x.rule", "x.verdict", "x.template", F.col("x.labelled").cast("long").alias("labelled"), F.col("x.bad").cast("long").alias("bad"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transformed(table(spark, sf_dir, "documents").select("doc_id", "text"), out="x")
    text = fill_in_middle.restored(F.col("x.form"), F.col("x.output"))
    return made.select(
        "doc_id", "x.n", "x.form", F.col("x.prefix_units").alias("prefix_chars"), F.col("x.middle_units").alias("middle_chars"),
        F.sha2("x.output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


def with_period(documents: DataFrame) -> DataFrame:
    """Texts of a tenth of the documents made periodic from a place on, as the query's contract says; the rest as they are."""
    chosen = documents.withColumns({"h": F.crc32(F.col("doc_id").cast("string").cast("binary")), "words": F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")})
    g, n = F.floor(F.col("h") / 10), F.size("words")
    chosen = chosen.withColumn("a", F.when((F.col("h") % 10 == 0) & (n > 0), g % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    at = F.transform("words", lambda w, i: F.when(i >= F.col("a"), F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))).otherwise(w))
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(at, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.with_runs(with_period(table(spark, sf_dir, "documents").select("doc_id", "text")), out="x")
    found = found.withColumn("best", periodic_runs.longest(F.col("x")))
    return found.select(
        "doc_id", F.size("x.starts").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(periodic_runs.listed(F.col("x")), 256).alias("runs_sha256"), F.sha2("x.collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_quality_classifier, op3_suffix_dedup, op4_toxicity, op5_fingerprints, op6_benchmark_decontamination, op7_simhash_near_dedup, op8_chat_formatting, op9_language_id, op10_sentencepiece, op11_url_filters, op12_fill_in_middle, op13_periodic_runs)}

def _level_sql(k: int) -> str:
    """Level k of the template tree: its children, branches, merged names and the leaves behind it."""
    return f"""
c{k} AS (SELECT host, array_to_string(t[1:{k - 1}], '/') AS parent, t[{k}] AS segment, sum(n) AS n, sum(good) AS good, sum(bad) AS bad FROM l{k - 1} WHERE len(t) >= {k} GROUP BY ALL),
m{k} AS (SELECT c.*, CASE WHEN fan > 20 AND n < 0.05e0 * total THEN '#*' ELSE segment END AS name
  FROM c{k} c JOIN (SELECT host, parent, sum(n) AS total, count(*) AS fan FROM c{k} GROUP BY ALL) USING (host, parent)),
b{k} AS (SELECT host, parent, name, sum(good)::HUGEINT AS good, sum(bad)::HUGEINT AS bad FROM m{k} GROUP BY ALL HAVING sum(good + bad) >= 3),
o{k} AS (SELECT *, good + bad AS n, lag(good + bad) OVER s AS m, lag(bad) OVER s AS bad_before, lag(good) OVER s AS good_before
  FROM b{k} WINDOW s AS (PARTITION BY host, parent ORDER BY bad::DOUBLE / (good + bad), name)),
g{k} AS (SELECT *, sum(CASE WHEN (bad * m - bad_before * n)::DOUBLE * (bad * m - bad_before * n) * (n + m) > 3.84e0 * (bad + bad_before) * (good + good_before) * n * m THEN 1 ELSE 0 END)
  OVER (PARTITION BY host, parent ORDER BY bad::DOUBLE / (good + bad), name) AS cluster FROM o{k}),
i{k} AS (SELECT host, parent, unnest(names) AS name, CASE WHEN len(names) > 1 THEN '#{{' || array_to_string(names, '|') || '}}' ELSE names[1] END AS into_name
  FROM (SELECT host, parent, list_sort(list(name)) AS names FROM g{k} GROUP BY host, parent, cluster)),
l{k} AS (SELECT l.host, l.shape, l.n, l.good, l.bad, CASE WHEN len(t) >= {k} THEN t[1:{k - 1}] || [coalesce(into_name, m.name)] || t[{k + 1}:] ELSE t END AS t
  FROM l{k - 1} l LEFT JOIN m{k} m ON l.host = m.host AND array_to_string(l.t[1:{k - 1}], '/') = m.parent AND l.t[{k}] = m.segment AND len(l.t) >= {k}
  LEFT JOIN i{k} i ON m.host = i.host AND m.parent = i.parent AND m.name = i.name)"""


# crc32 of a decimal number, bit by bit.
CRC32 = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({0}, ''), lambda x: unicode(x)::BIGINT),
    lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295)"""

SQL = {
    "op11_url_filters": r"""
WITH p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(rule, h, start, verdict) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'), ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
q AS (SELECT *, regexp_replace(path, '[0-9a-fA-F]{16,}|[0-9]+', '#', 'g') AS shape,
  (SELECT max_by(rules, length(rule)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, start)) AS fit FROM p),
l0 AS (SELECT host, shape, count(*) AS n, count(*) FILTER (fit.verdict = 'allow') AS good, count(*) FILTER (fit.verdict = 'block') AS bad, string_split(shape, '/')[2:] AS t FROM q GROUP BY ALL),"""
    + ",".join(_level_sql(k) for k in range(1, url_filters.Settings.levels + 1))
    + f""",
sums AS (SELECT host, '/' || array_to_string(t, '/') AS template, sum(good + bad)::BIGINT AS labelled, sum(bad)::BIGINT AS bad FROM l{url_filters.Settings.levels} GROUP BY ALL),
leaf AS (SELECT l.host, l.shape, s.template, s.labelled, s.bad FROM l{url_filters.Settings.levels} l JOIN sums s ON l.host = s.host AND '/' || array_to_string(l.t, '/') = s.template)
SELECT page_id, q.host, path, fit.rule AS rule, coalesce(fit.verdict, CASE WHEN (bad + 1)::DOUBLE / (labelled + 2) >= 0.8e0 THEN 'block' ELSE 'allow' END) AS verdict, template, labelled, bad
FROM q JOIN leaf ON q.host = leaf.host AND q.shape = leaf.shape""",
    "op12_fill_in_middle": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (SELECT *, [('0x' || h[8 * k + 1:8 * k + 8])::BIGINT for k in range(4)] AS d FROM t),
cut AS (SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d[3] % 100 >= 90 THEN 'plain'
       WHEN d[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, substring(text, 1, a) AS pre, substring(text, a + 1, b - a) AS mid, substring(text, b + 1) AS suf FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM parts""",
    "op13_periodic_runs": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
  {CRC32.format("doc_id::VARCHAR")} AS h FROM documents),
e AS (SELECT *, h // 10 % len(w) AS a, 1 + (len(w) - h // 10 % len(w)) // (3 + h // 10 % 8) AS p FROM d),
f AS (SELECT r, doc_id, CASE WHEN h % 10 = 0 AND len(w) > 0
  THEN list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE w END AS w FROM e),
grams AS (SELECT r, i, array_to_string(w[i + 1:i + 6], ' ') AS gram FROM (SELECT r, w, unnest(range(len(w) - 5)) AS i FROM f WHERE len(w) > 5)),
equal AS (SELECT y.r, y.i - x.i AS lag, y.i FROM grams x JOIN grams y ON x.r = y.r AND x.gram = y.gram AND x.i < y.i),
diagonal AS (SELECT r, lag, min(i) - lag AS start, count(*) + 5 + lag AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, lag ORDER BY i) AS island FROM equal) GROUP BY r, lag, island),
long AS (SELECT * FROM diagonal WHERE length >= greatest(12, 2 * lag)),
runs AS (SELECT * FROM long x WHERE NOT EXISTS (SELECT 1 FROM long y WHERE x.r = y.r AND x.start = y.start AND x.length = y.length AND y.lag < x.lag AND x.lag % y.lag = 0)),
listed AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || lag || chr(10), '' ORDER BY start, lag) AS lines,
  min({{'minus': -length, 'start': start, 'period': lag}}) AS best FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + lag, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS rest FROM (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM f) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start AS start, (-best.minus)::BIGINT AS length, best.period AS period,
  (1000 * -best.minus // best.period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM f LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)""",
    "op6_benchmark_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
       FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, dw.i, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
spots AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
