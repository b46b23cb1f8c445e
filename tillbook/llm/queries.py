"""The queries of the operators, with oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm import chosenpath, decontaminate, extract, hmm, infill, mixing, phrases, quality, repeats, secrets, sharding, simhash, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ITEM_WORDS = r"""regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


DOMAINS = ", ".join(f"('{d}')" for d in urls.BLOCKED_DOMAINS)


@query(
    "op1_url_filters",
    rf"""
WITH r(kind, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
b(domain) AS (VALUES {DOMAINS}),
x AS (SELECT row_number() OVER () AS n, page_id, CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '(?s)\A([^?#]*)', 1) ELSE '' END AS rest FROM pages),
p AS (SELECT n, page_id, translate(regexp_extract(rest, '\A([^/]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '(?s)\A[^/]*(.*)\z', 1) AS path FROM x),
f AS (SELECT n, rh || rp AS rule, kind, row_number() OVER (PARTITION BY n ORDER BY length(rh || rp) DESC) AS k
  FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(kind, CASE WHEN EXISTS (SELECT 1 FROM b WHERE host = domain OR ends_with(host, '.' || domain)) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN f ON p.n = f.n AND f.k = 1""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = spark.createDataFrame([(d,) for d in urls.BLOCKED_DOMAINS], "domain string")
    return urls.filter_urls(table(spark, sf_dir, "pages"), domains)


@query("op2_secret_scans")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("n_markov")


@query(
    "op3_benchmark_decontamination",
    rf"""
WITH items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {ITEM_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
wins AS (SELECT DISTINCT item, unnest([array_to_string(w[i:i + least(13, len(w)) - 1], ' ') FOR i IN range(1, len(w) - least(13, len(w)) + 2)]) AS win,
  least(13, len(w)) AS n FROM items WHERE len(w) > 0),
docs AS (SELECT row_number() OVER () AS r, doc_id, {ITEM_WORDS.format("coalesce(text, '')")} AS w FROM documents),
places AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM docs, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n),
found AS (SELECT p.r, p.i, p.n, x.item FROM places p JOIN wins x ON x.n = p.n AND x.win = array_to_string(p.w[p.i:p.i + p.n - 1], ' ')),
hits AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM found) GROUP BY r),
who AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(o.n_items, 0) AS n_items,
  sha256(coalesce(o.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hits h USING (r) LEFT JOIN who o USING (r)""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_suffix_array_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op6_html_extraction")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(table(spark, sf_dir, "pages"))


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


@query(
    "op8_source_mixing",
    r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS spread FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3] AS weight, 2.0 * source_size AS cap FROM s),
l AS (SELECT *, (CAST(1.5 AS DOUBLE) * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, encode(source)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT *, least(cap, coalesce(max(CASE WHEN level * weight <= cap THEN level END) OVER () * weight, cap)) AS target,
  CAST(CAST('0x' || substr(md5('mix-1' || coalesce('=' || source, ':null')), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0 AS off FROM l),
k AS (SELECT d.*, t.source_size, t.target, t.off, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS each,
  row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.spread, d.doc_id) AS rank FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target, size * CAST(floor(rank * each + off) - floor((rank - 1) * each + off) AS BIGINT) AS taken FROM k""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mixed(docs).select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query(
    "op9_sharding",
    r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size, coalesce(text, '') AS body,
  CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS h, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS t FROM documents),
u AS (SELECT h, t, CAST(sum(size) AS BIGINT) AS held FROM d GROUP BY h, t),
o AS (SELECT *, sum(held) OVER (ORDER BY h, t ROWS UNBOUNDED PRECEDING) - held AS below FROM u),
g AS (SELECT h, min(below) AS below, CAST(sum(held) AS BIGINT) AS held FROM o GROUP BY h),
m AS (SELECT k, (SELECT sum(size) FROM d) * k / 16.0 AS mark, 0.01 * (SELECT sum(size) FROM d) / 16 AS slack FROM range(1, 16) x(k)),
c AS (SELECT m.k, CASE WHEN least(mark - g.below, g.below + g.held - mark) > slack THEN g.h
      WHEN mark - g.below <= g.below + g.held - mark THEN g.h ELSE g.h + 1 END AS ch,
    CASE WHEN least(mark - g.below, g.below + g.held - mark) > slack THEN CASE WHEN mark - o.below <= o.below + o.held - mark THEN o.t ELSE o.t + 1 END ELSE 0 END AS ct
  FROM m JOIN g ON g.below <= mark AND mark < g.below + g.held JOIN o ON o.below <= mark AND mark < o.below + o.held),
p AS (SELECT d.r, d.doc_id, d.size, d.h, d.t, d.body, count(c.k) AS shard FROM d LEFT JOIN c ON d.h > c.ch OR (d.h = c.ch AND d.t >= c.ct) GROUP BY ALL),
tab AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) x(i))),
y AS (SELECT p.*, tab, hex(encode(body)) AS x FROM p, tab),
z AS (SELECT *, [CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT) FOR i IN range(len(x) // 2)] AS bytes FROM y)
SELECT doc_id, size, CAST(shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY shard ORDER BY h, t) - 1 AS slot, 'bytes' AS law, CAST(NULL AS INTEGER) AS grown_shard,
  xor(list_reduce(list_prepend(4294967295, bytes), lambda c, v: xor(c >> 8, tab[(xor(c, v) & 255) + 1])), 4294967295) AS text_crc32 FROM z""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assignment(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op10_lm_scoring")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


@query(
    "op13_fill_in_middle",
    r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS h2,
  CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4, body = '' OR strpos(body, '<P>') > 0 OR strpos(body, '<S>') > 0 OR strpos(body, '<M>') > 0 AS is_plain FROM d),
p AS (SELECT *, array_to_string(u[1:least(h1, h2)], '') AS prefix, array_to_string(u[least(h1, h2) + 1:greatest(h1, h2)], '') AS middle, array_to_string(u[greatest(h1, h2) + 1:], '') AS suffix FROM x),
f AS (SELECT *, CASE WHEN is_plain THEN 'plain' WHEN h4 < 50 THEN 'spm' ELSE 'psm' END AS form FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN body WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN body ELSE prefix || middle || suffix END) AS restored_sha256 FROM f""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(table(spark, sf_dir, "documents"))


@query(
    "op11_phrase_collocations",
    r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
c1 AS (SELECT lang, phrase, CAST(count(*) AS HUGEINT) AS f FROM (SELECT lang, unnest(w) AS phrase FROM w) GROUP BY ALL),
c2 AS (SELECT lang, x, y, x || ' ' || y AS phrase, CAST(count(*) AS HUGEINT) AS f FROM (SELECT lang, v.x AS x, v.y AS y FROM (SELECT lang, unnest([{'x': w[i], 'y': w[i + 1]} FOR i IN range(1, len(w))]) AS v FROM w)) GROUP BY ALL),
c3 AS (SELECT lang, x, y, z, x || ' ' || y || ' ' || z AS phrase, CAST(count(*) AS HUGEINT) AS f
  FROM (SELECT lang, v.x AS x, v.y AS y, v.z AS z FROM (SELECT lang, unnest([{'x': w[i], 'y': w[i + 1], 'z': w[i + 2]} FOR i IN range(1, len(w) - 1)]) AS v FROM w)) GROUP BY ALL),
s3 AS (SELECT c3.lang, c3.phrase, c3.x, c3.y, c3.z, c3.f AS a, p.f AS fx, q.f AS fyz, r.f AS fxy, s.f AS fz, 1000000 * c3.f * c3.f // (p.f * q.f) AS one, 1000000 * c3.f * c3.f // (r.f * s.f) AS two
  FROM c3 JOIN c1 p ON p.lang = c3.lang AND p.phrase = c3.x JOIN c2 q ON q.lang = c3.lang AND q.x = c3.y AND q.y = c3.z
  JOIN c2 r ON r.lang = c3.lang AND r.x = c3.x AND r.y = c3.y JOIN c1 s ON s.lang = c3.lang AND s.phrase = c3.z WHERE c3.f >= 10),
held AS (SELECT lang, x, y, max(a) AS most FROM (SELECT lang, x, y, a FROM s3 UNION ALL SELECT lang, y, z, a FROM s3) GROUP BY lang, x, y),
s2 AS (SELECT c2.lang, c2.phrase, c2.f AS a, p.f AS l, q.f AS r, 1000000 * c2.f * c2.f // (p.f * q.f) AS score
  FROM c2 JOIN c1 p ON p.lang = c2.lang AND p.phrase = c2.x JOIN c1 q ON q.lang = c2.lang AND q.phrase = c2.y LEFT JOIN held h ON h.lang = c2.lang AND h.x = c2.x AND h.y = c2.y
  WHERE c2.f >= 10 AND (h.most IS NULL OR 100 * h.most < 50 * c2.f)),
every AS (SELECT * FROM s2 UNION ALL SELECT lang, phrase, a, CASE WHEN one <= two THEN fx ELSE fxy END, CASE WHEN one <= two THEN fyz ELSE fz END, least(one, two) FROM s3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM every),
n AS (SELECT lang, sum(f) AS n FROM c1 GROUP BY lang)
SELECT k.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked k JOIN n ON n.lang = k.lang WHERE rank <= 2000""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op12_minhash_near_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosenpath.near_duplicates(table(spark, sf_dir, "documents"))
