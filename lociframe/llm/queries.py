"""The registered queries of the training-data operators: each a digest of its operator's output over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm import best_fit, bpe, decontaminate, filter_audit, html_text, importance, language_id, license_scan, line_dedup, near_dedup, secret_scan, vector_search, warc
from lociframe.llm.common import keep, table

#: The byte-level BPE file.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: The BPE file with word ends.
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("findings", lambda f: f.depth == 0)
    count = lambda kind: F.size(F.filter(base, lambda f: f.kind == kind)).cast("long")
    written = lambda fs: F.transform(fs, lambda f: F.concat_ws(":", f.kind, f.start, f.end))
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(F.array_join(written(base), ","), 256).alias("base_sha256"), F.array_join(written("findings"), ",").alias("spans"),
    )


def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vector_search.nearest(rows, rows.where("vec_id % 20 = 0"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.learn(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.encode_decode(spark, table(spark, sf_dir, "documents"), bpe.read_vocabulary(VOCABULARY))
    return tokens.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.find_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = best_fit.pieces(spark, table(spark, sf_dir, "documents"), bpe.read_vocabulary(WORD_VOCABULARY))
    return best_fit.place(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))  # the ids themselves need not be shuffled for their digest


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.flags(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_language_id": op2_language_id,
    "op3_vector_search": op3_vector_search,
    "op4_warc": op4_warc,
    "op5_line_dedup": op5_line_dedup,
    "op6_near_dedup": op6_near_dedup,
    "op7_html_text": op7_html_text,
    "op8_decontaminate": op8_decontaminate,
    "op9_bpe": op9_bpe,
    "op10_license_scan": op10_license_scan,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_filter_audit": op12_filter_audit,
    "op13_importance_resampling": op13_importance_resampling,
}


def _license_sql() -> str:
    values = lambda rows: ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
    rules = [(i, name, " " + " ".join(seq) + " ") for i, (name, seq) in enumerate(license_scan.RULES)]
    return f"""
WITH known(sentence, ident) AS (VALUES {values(license_scan.SENTENCES.items())}),
rules(rule, name, seq) AS (VALUES {values(rules)}),
docs AS (SELECT doc_id, string_split_regex(text, '{license_scan.BREAK}') AS parts FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM docs),
hits AS (SELECT doc_id, pos, ident FROM lines JOIN known ON trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) = sentence),
seqs AS (SELECT doc_id, string_agg(ident, ',' ORDER BY pos) AS sentence_ids FROM hits GROUP BY doc_id),
named AS (SELECT DISTINCT doc_id, name FROM seqs JOIN rules ON contains(' ' || replace(sentence_ids, ',', ' ') || ' ', seq)),
lists AS (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS licenses FROM named GROUP BY doc_id)
SELECT seqs.doc_id, sentence_ids, coalesce(licenses, '') AS licenses FROM seqs LEFT JOIN lists ON seqs.doc_id = lists.doc_id
"""


ORACLE_SQL = {
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS first FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT page_id, strlen(p.html) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html
""",
    "op6_near_dedup": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM words),
n AS (SELECT doc_id, len(s) AS n FROM sets),
e AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT u, v FROM common JOIN n p ON p.doc_id = u JOIN n q ON q.doc_id = v WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON l.u = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT n.doc_id, n AS n_shingles, component_id, n.doc_id = component_id AS kept FROM n JOIN least ON n.doc_id = least.doc_id
""",
    "op10_license_scan": _license_sql(),
    "op13_importance_resampling": r"""
WITH b AS (SELECT true AS own, doc_id, text FROM documents UNION ALL SELECT false, NULL, text FROM benchmark),
w AS (SELECT own, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM b),
f AS (SELECT own, doc_id, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))], [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])) AS f FROM w),
crcs AS (SELECT list(list_reduce(list_prepend(n::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY n) AS t FROM range(256) r(n)),
h AS (SELECT f, xor(list_reduce(list_prepend(4294967295, [('0x' || x)::BIGINT FOR x IN regexp_extract_all(hex(encode(f)), '..')]), lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 10000 AS bucket FROM (SELECT DISTINCT f FROM f), crcs),
g AS (SELECT own, doc_id, bucket FROM f JOIN h ON f.f = h.f),
s AS (SELECT count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM g),
gain AS (SELECT bucket, floor(1000 * ln((count(*) FILTER (NOT own) + 1.0::DOUBLE) * (any_value(s.s) + 10000.0::DOUBLE) / ((count(*) FILTER (own) + 1.0::DOUBLE) * (any_value(s.t) + 10000.0::DOUBLE)))) AS gain FROM g, s GROUP BY bucket),
docs AS (SELECT doc_id, len(w) AS n_words FROM w WHERE own),
sums AS (SELECT doc_id, count(*) AS n, sum(gain) AS weight FROM g JOIN gain ON g.bucket = gain.bucket WHERE own GROUP BY doc_id),
scored AS (SELECT d.doc_id, n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || d.doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))))::BIGINT AS score FROM docs d LEFT JOIN sums ON d.doc_id = sums.doc_id),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= 20 QUALIFY rank <= 5 * count(*) OVER () // 100)
SELECT scored.doc_id, n_features, weight, score, rank FROM scored LEFT JOIN ranked ON scored.doc_id = ranked.doc_id
""",
    "op12_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             CASE WHEN len(words) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
             || CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * len(text) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN first < w.doc_id THEN 'E' ELSE '' END AS fails
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
x(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
r AS (SELECT f.*, filter_order, step, filter_order[step] AS own, list_min([strpos(filter_order, y) FOR y IN string_split(fails, '') IF y <> '']) AS hit
      FROM f, o, range(1, 6) s(step)),
s AS (SELECT part, filter_order, step, own, count(*) FILTER (hit IS NULL OR hit > step) AS kept, count(*) FILTER (hit = step) AS removed,
             count(*) FILTER (hit < step AND contains(fails, own)) AS redundant, count(*) FILTER (fails = own) AS unique_fails,
             count(*) FILTER (hit = step AND good) AS good_lost, count(*) FILTER (hit = step AND toxic) AS toxic_lost
      FROM r GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM s
""",
}
