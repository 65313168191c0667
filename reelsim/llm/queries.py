"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsim.llm import alignment, jaccard, langid, mixing, packing, periodic, pivots, quality, sketch, splitters, superkmer, url_lists, warc
from reelsim.llm.common import scratch_path, table

JACCARD_WORDS, JACCARD_PERCENT = 4, 85
SHARDS = 40


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.predictions(quality.score(docs, quality.fit(docs, labels)))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, done = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), raw)
    warc.normalise(spark, raw, done)
    return warc.read_records(spark, done).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = splitters.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), "law", "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op4_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sketch.compare_with_edits(table(spark, sf_dir, "documents"))
    return s.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                    sketch.fingerprint("sketch").alias("fingerprint"), sketch.fingerprint("edited_sketch").alias("edited_fingerprint"),
                    sketch.jaccard("sketch", "edited_sketch").alias("near_edited"),
                    sketch.jaccard("sketch", "next_sketch").alias("near_next"),
                    sketch.containment("sketch", "edited_sketch").alias("held_by_edited"))


def op5_superkmer(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = superkmer.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages, fetched on a day (1 to 365) that follows from
    the id.  The list is derived from them: each host, or every third one's
    parent domain, is added on a day that follows from its first page, and
    most are removed, and some added again, later."""
    captures = table(spark, sf_dir, "pages").select("page_id", "url", (F.pmod(F.col("page_id") * 7919, F.lit(365)) + 1).alias("fetch_day"))
    hosts = (captures.withColumn("host", url_lists.host_of()).filter("host is not null and page_id is not null")
                     .groupBy("host").agg(F.min("page_id").alias("p")))
    parent = F.regexp_replace("host", "^[^.]+[.]", "")
    domain = F.when((F.col("p") % 3 == 0) & parent.contains("."), parent).otherwise(F.col("host"))
    day = F.col("p") * 31 % 200 + 1
    entries = hosts.filter("p % 4 != 1").select(domain.alias("domain"), F.explode(F.array(
        F.struct(day.alias("day"), F.lit("add").alias("action")),
        F.struct((day + 60).alias("day"), F.when(F.col("p") % 5 != 0, "remove").otherwise("add").alias("action")),
        F.struct((day + 120).alias("day"), F.when(F.col("p") % 2 == 0, "add").otherwise("remove").alias("action")))).alias("e"))
    return url_lists.evaluate(captures, entries.select("domain", "e.*"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = mixing.store(mixing.measure(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text"), "measured")
    return mixing.permute(mixing.realise(measured, mixing.mixture(measured)))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents"), JACCARD_WORDS, JACCARD_PERCENT, 100)


def op11_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(langid.fold() == 0, F.lit(False))
    return langid.predict(docs, langid.fit(docs)).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def aligned_tokenizers() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), *aligned_tokenizers())


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.find_runs(table(spark, sf_dir, "documents"), plant=True)


QUERIES = {f.__name__: f for f in (op1_quality, op2_warc, op3_splitters, op4_sketch, op5_superkmer, op6_url_lists, op7_mixing,
                                   op8_packing, op9_pivots, op10_jaccard, op11_langid, op12_alignment, op13_periodic)}

WORD = "[^\\x20\\x09-\\x0D]+"



def crc32_sql(text: str) -> str:
    """The unsigned crc32 of an ASCII text, a bit at a time."""
    bits = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [CAST(ascii(substr({text}, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), {step}), 4294967295)"


def periodic_sql(levels: int = 14) -> str:
    """Runs by places whose next copy of a gram of 2 ** level words lies at
    one lag, without any splitting; texts of less than 3 * 2 ** levels words."""
    grams = [f"""h{x} AS (SELECT doc_id, i, hash(h, lead(h, {2 ** (x - 1)}) OVER w) AS h, i + {2 ** x} <= n AS whole, n
  FROM h{x - 1} WINDOW w AS (PARTITION BY doc_id ORDER BY i))""" for x in range(1, levels + 1)]
    lags = [f"""l{x} AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id, h ORDER BY i) - i AS q, {2 ** x} AS g
  FROM h{x} WHERE whole QUALIFY q >= {2 ** (x - 1)} AND q < {2 ** x})""" for x in range(1, levels + 1)]
    every = " UNION ALL ".join(f"SELECT * FROM l{x}" for x in range(1, levels + 1))
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws, {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
p AS (SELECT *, len(ws) AS n, h // 10 AS g, h % 10 = 0 AND len(ws) > 0 AS hit FROM w),
a AS (SELECT *, CASE WHEN hit THEN g % n ELSE n END AS a, CASE WHEN hit THEN 1 + (n - g % n) // (3 + g % 8) ELSE 1 END AS p FROM p),
x AS (SELECT doc_id, n, ws, a, p, unnest(range(n)) AS i FROM a),
t AS (SELECT doc_id, n, i, ws[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1] AS word FROM x),
h0 AS (SELECT doc_id, i, hash(word) AS h, TRUE AS whole, n FROM t),
{", ".join(grams + lags)},
l AS ({every}),
k AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q, g ORDER BY i) AS stretch FROM l),
r AS (SELECT doc_id, min(i) AS s, max(i) - min(i) + q + g AS m, q FROM k GROUP BY doc_id, q, g, stretch
      HAVING max(i) - min(i) + q + g >= greatest(24, 3 * q)),
d AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + m)) AS i FROM r),
c AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.i) AS kept FROM t ANTI JOIN d USING (doc_id, i) GROUP BY t.doc_id),
f AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q) AS runs,
             first({{'s': s, 'm': m, 'q': q}} ORDER BY m / q DESC, s, q) AS b FROM r GROUP BY doc_id)
SELECT p.doc_id, coalesce(f.n_runs, 0) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.m AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period,
       CAST(1000 * b.m // b.q AS BIGINT) AS exponent_milli, sha256(coalesce(f.runs, '')) AS runs_sha256, sha256(coalesce(c.kept, '')) AS collapsed_sha256
FROM p LEFT JOIN f ON f.doc_id = p.doc_id LEFT JOIN c ON c.doc_id = p.doc_id"""


ORACLE_SQL = {
    "op2_warc": """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS leader FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> leader THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> leader THEN leader END AS refers_to
FROM p LEFT JOIN f USING (d)""",
    "op5_superkmer": f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35),
k AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM p),
r AS (SELECT h FROM k GROUP BY h HAVING count(*) > 1),
s AS (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM k JOIN r USING (h)),
g AS (SELECT doc_id, list(DISTINCT j) AS js FROM s GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_transform(list_filter(range(1, len(ws) + 1), lambda x: js IS NULL OR NOT list_contains(js, x)),
                                             lambda x: ws[x]), ' ')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)""",
    "op6_url_lists": """
WITH c AS (SELECT page_id, url, (page_id * 7919) % 365 + 1 AS fetch_day,
                  nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '[.]+$', ''), '') AS host
           FROM pages),
h AS (SELECT host, min(page_id) AS p, regexp_replace(host, '^[^.]+[.]', '') AS up FROM c WHERE host IS NOT NULL GROUP BY host),
e0 AS (SELECT CASE WHEN p % 3 = 0 AND contains(up, '.') THEN up ELSE host END AS domain, p, p * 31 % 200 + 1 AS d FROM h WHERE p % 4 <> 1),
e1 AS (SELECT domain, d AS day, 'add' AS action FROM e0
       UNION ALL SELECT domain, d + 60, CASE WHEN p % 5 <> 0 THEN 'remove' ELSE 'add' END FROM e0
       UNION ALL SELECT domain, d + 120, CASE WHEN p % 2 = 0 THEN 'add' ELSE 'remove' END FROM e0),
e2 AS (SELECT domain, day, max(action) AS action FROM e1 GROUP BY ALL),
e3 AS (SELECT *, lag(action) OVER (PARTITION BY domain ORDER BY day) AS was FROM e2),
e4 AS (SELECT domain, day, action, lead(day) OVER (PARTITION BY domain ORDER BY day) AS till FROM e3 WHERE was IS NULL OR was <> action),
v AS (SELECT domain, day AS valid_from, till AS valid_to FROM e4 WHERE action = 'add'),
b AS (SELECT c.page_id, v.*, row_number() OVER (PARTITION BY c.page_id ORDER BY length(v.domain) DESC) AS k
      FROM c JOIN v ON (c.host = v.domain OR ends_with(c.host, '.' || v.domain)) AND v.valid_from <= c.fetch_day
                   AND (v.valid_to IS NULL OR v.valid_to > c.fetch_day))
SELECT c.page_id, c.url, c.host, c.fetch_day, b.domain IS NOT NULL AS blocked, b.domain AS rule, b.valid_from, b.valid_to
FROM c LEFT JOIN (SELECT * FROM b WHERE k = 1) b USING (page_id)""",
    "op9_pivots": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
                     WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y <> 0)) > 0
                       AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
r AS (SELECT vec_id AS n, vec_id AS t FROM embeddings UNION SELECT l.b, r.t FROM r JOIN l ON l.a = r.n),
m AS (SELECT n, min(t) AS c FROM r GROUP BY n),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links, m.c AS component_id, e.vec_id = m.c AS kept
FROM embeddings e JOIN m ON m.n = e.vec_id LEFT JOIN k ON k.a = e.vec_id""",
    "op10_jaccard": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws
                     FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT o.a, o.b FROM o JOIN z x ON x.doc_id = o.a JOIN z y ON y.doc_id = o.b WHERE 100 * o.o >= 85 * (x.n + y.n - o.o)),
r AS (SELECT doc_id AS n, doc_id AS t FROM documents UNION SELECT l.b, r.t FROM r JOIN l ON l.a = r.n),
m AS (SELECT n, min(t) AS c FROM r GROUP BY n)
SELECT d.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id
FROM documents d JOIN m ON m.n = d.doc_id LEFT JOIN z ON z.doc_id = d.doc_id""",
    "op13_periodic": periodic_sql(),
}
