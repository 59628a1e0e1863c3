"""Registered queries of these operators and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.llm import ann, brown, contain, counts, crf, jaccard, lpf, merkle, packing, phrases, substring, topk, warc
from furlong.llm.ship import ship_package

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return f
    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_topk", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""")
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), topk.scaled("embedding").alias("vector"))
    return topk.exact_topk(vectors.filter(F.col("id") % 100 == 0), vectors, k=10)


@query("op11_collocations", r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
g AS (
  SELECT lang, m, array_to_string(w[i:i+m-1], ' ') AS phrase FROM (
    SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
inner_ AS (
  SELECT DISTINCT lang, array_to_string(w[i:i+k-1], ' ') AS phrase, a AS longer FROM (
    SELECT *, unnest(range(1, m - k + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS k FROM c))),
kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * longer >= 100 * a)),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k+1:m], ' ') AS y
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)),
s AS (
  SELECT cut.lang, cut.phrase, a, k, l.f AS l, r.f AS r, n.n,
         CAST((1000::HUGEINT * a * n.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cut JOIN n USING (lang) JOIN f l ON l.lang = cut.lang AND l.phrase = x JOIN f r ON r.lang = cut.lang AND r.phrase = y),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS no FROM s),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b WHERE no = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM o WHERE rank <= 2000""")
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir)).drop("cut")


RECORD = ("doc_id", "source", "lang", "n_chars", "text")


def _record_sql(**changed: str) -> str:
    """The digest of a record; ``changed`` columns are taken from the given expressions."""
    values = [f"CAST({changed.get(c, c)} AS VARCHAR)" for c in RECORD]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def _crc32_sql(text: str) -> str:
    """CRC-32 of a short text: bit by bit over its bytes, polynomial 0xEDB88320."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    bits = f"list_reduce(range(0, 8), lambda c, x: {step}, xor(c, b))"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: {bits}, 4294967295), 4294967295)"


@query("op12_manifest", f"""
WITH RECURSIVE l AS (
  SELECT row_number() OVER () AS rid, doc_id, source, {_record_sql()} AS leaf,
         CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_record_sql(text="replace(text, chr(10), '')")}
              ELSE {_record_sql()} END AS seen
  FROM documents),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM l)),
p AS (
  SELECT rid, doc_id, leaf, seen, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY tree) AS size
  FROM l JOIN s ON l.source IS NOT DISTINCT FROM s.source),
t AS (
  SELECT tree, 0 AS level, idx, size, leaf AS h FROM p
  UNION ALL
  SELECT tree, level + 1, idx // 3, (size + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM t WHERE size > 1
  GROUP BY tree, level, idx // 3, size),
subroots AS (SELECT tree, h, level FROM t WHERE size = 1),
u AS (
  SELECT 0 AS level, tree AS idx, count(*) OVER () AS size, h FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, (size + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM u WHERE size > 1
  GROUP BY level, idx // 3, size),
own AS (
  SELECT rid, level AS step, t.tree, t.level, t.idx FROM p JOIN t ON t.tree = p.tree AND t.idx = p.idx // CAST(pow(3, t.level) AS BIGINT)
  WHERE t.size > 1),
own_up AS (
  SELECT rid, r.level + u.level AS step, u.level, u.idx FROM p JOIN subroots r USING (tree)
  JOIN u ON u.idx = p.tree // CAST(pow(3, u.level) AS BIGINT) WHERE u.size > 1),
sib AS (
  SELECT rid, step, coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (t.idx < own.idx), '') AS a,
         coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (t.idx > own.idx), '') AS z
  FROM own JOIN t ON t.tree = own.tree AND t.level = own.level AND t.idx // 3 = own.idx // 3 GROUP BY rid, step
  UNION ALL
  SELECT rid, step, coalesce(string_agg(u.h, '' ORDER BY u.idx) FILTER (u.idx < own_up.idx), ''),
         coalesce(string_agg(u.h, '' ORDER BY u.idx) FILTER (u.idx > own_up.idx), '')
  FROM own_up JOIN u ON u.level = own_up.level AND u.idx // 3 = own_up.idx // 3 GROUP BY rid, step),
f AS (
  SELECT rid, 0 AS step, seen AS h FROM p
  UNION ALL
  SELECT rid, f.step + 1, sha256(a || h || z) FROM f JOIN sib USING (rid, step)),
proofs AS (SELECT rid, string_agg(a || z, '' ORDER BY step) AS text, count(*) AS steps FROM sib GROUP BY rid),
root AS (SELECT h AS root FROM u WHERE size = 1)
SELECT p.doc_id, p.leaf, r.h AS subroot, root, sha256(coalesce(q.text, '')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM p JOIN subroots r USING (tree) CROSS JOIN root LEFT JOIN proofs q USING (rid)
JOIN f ON f.rid = p.rid AND f.step = coalesce(q.steps, 0)""")
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    leaf = merkle.digest(*[merkle.field(c) for c in RECORD])
    without_lines = merkle.digest(*[merkle.field(F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else c) for c in RECORD])
    tampered = F.coalesce(bucket_of("doc_id", 2) == 0, F.lit(False))
    rows = docs.select("doc_id", "source", leaf.alias("leaf"), F.when(tampered, without_lines).otherwise(leaf).alias("seen"))
    found = merkle.manifest(rows, carry=["seen"])
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest("proof").alias("proof_sha256"),
                        merkle.folded("carried.seen", "proof").alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


@query("op13_nearest")
def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return ann.nearest(vectors.filter(F.col("id") % 20 == 0), vectors, k=20)


@query("op6_section_tokens")
def op6_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.section_tokens(documents(spark, sf_dir), TOKENIZER)


def _shingles_sql(table: str, key: str) -> str:
    """``(row, key, shingle)`` of all distinct shingles of five words, A-Z lower-cased."""
    return f"""
  SELECT DISTINCT row, {key}, array_to_string(w[i:i+4], ' ') AS s FROM (
    SELECT row, {key}, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM (
      SELECT row_number() OVER () AS row, {key}, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM {table}))"""


@query("op8_contained_items", f"""
WITH d AS ({_shingles_sql('documents', 'doc_id')}),
b AS (SELECT row AS item, item_id, s, count(*) OVER (PARTITION BY row) AS n_shingles FROM ({_shingles_sql('benchmark', 'item_id')}))
SELECT doc_id, item_id, count(*) AS n_shared, n_shingles, count(*)::DOUBLE / n_shingles AS containment
FROM d JOIN b USING (s) GROUP BY d.row, doc_id, item, item_id, n_shingles HAVING count(*) >= 0.8::DOUBLE * n_shingles""")
def op8_contained_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contain.contained_items(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bucket_of(key: str, n: int):
    return F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % n


@query("op9_language")
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = crf.fit(crf.training_sample(docs, bucket_of("doc_id", 5) != 0))
    held = F.coalesce(bucket_of("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    labelled = crf.with_language(docs.select("doc_id", "text", held), model)
    return labelled.select("doc_id", "held_out", "lang_pred", "score")


@query("op4_packed")
def op4_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), TOKENIZER)


@query("op7_archived_pages", """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper
  FROM pages)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         (CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31
         AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM p""")
def op7_archived_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op10_near_duplicates")
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir))


@query("op2_without_repeats", r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
n AS (SELECT rid, w, unnest(range(1, greatest(len(w) - 33, 1))) AS i FROM d),
win AS (SELECT rid, i, md5(array_to_string(w[i:i+34], ' ')) AS s FROM n),
hit AS (SELECT rid, i FROM win WHERE s IN (SELECT s FROM win GROUP BY s HAVING count(*) > 1)),
gone AS (SELECT DISTINCT rid, i + j AS pos FROM hit, (SELECT unnest(range(0, 35)) AS j)),
p AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
k AS (
  SELECT rid, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n_kept
  FROM p ANTI JOIN gone USING (rid, pos) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (rid)""")
def op2_without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.without_repeats(documents(spark, sf_dir))


@query("op5_without_later_copies", """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
b AS (SELECT rid, doc_id, h, unnest(range(0, greatest(n - 49, 0))) AS i FROM d),
win AS (SELECT rid, doc_id, i, hash(substr(h, 2 * i + 1, 100)) AS s FROM b),
hit AS (SELECT rid, i FROM win JOIN (SELECT s, min(doc_id) AS least FROM win GROUP BY s) USING (s) WHERE doc_id > least),
run AS (
  SELECT rid, min(i) AS a, max(i) + 50 AS z FROM (
    SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS g FROM (
      SELECT rid, i, CASE WHEN i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh FROM hit))
  GROUP BY rid, g),
cut AS (
  SELECT rid, count(*) AS n_spans, sum(z - a) AS n_removed, list(a ORDER BY a) AS starts, list(z ORDER BY a) AS ends FROM run GROUP BY rid)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN starts IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(starts) + 1), lambda x:
         substr(h, CASE WHEN x = 0 THEN 1 ELSE 2 * ends[x] + 1 END,
                2 * ((CASE WHEN x = len(starts) THEN n ELSE starts[x + 1] END) - (CASE WHEN x = 0 THEN 0 ELSE ends[x] END)))), '') END
       )) AS kept_sha256
FROM d LEFT JOIN cut USING (rid)""")
def op5_without_later_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lpf.without_later_copies(documents(spark, sf_dir))


@query("op3_scored")
def op3_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", (bucket_of("doc_id", 10) != 0).alias("learn"))
    out = brown.scored(docs, "learn")
    return out.withColumn("held_out", ~F.col("learn") & F.col("doc_id").isNotNull()).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
