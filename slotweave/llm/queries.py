"""The operators' queries over the given tables, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotweave.llm import centroids, decontaminate, fill_middle, html_text, langid, line_dedup, mixing, near_dup, quality, sharding, tokens, topk, warc
from workload.common import Registry, table

registry = Registry()


def _documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", *more)


@registry.add("""
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), letters AS (
    SELECT page_id, payload_bytes,
        array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda s:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 1 + 5 * g, 5))::BIGINT >> s::INT) & 31)::INT + 1, 1)), '')), '')
        AS payload_digest
    FROM payloads
), ranked AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM letters
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> last THEN last END AS refers_to
FROM ranked
""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, written into Zstandard archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


@registry.add()
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url", "html")
    told = html_text.extracted(pages)
    return told.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


@registry.add()
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards over fixed virtual slots, bytes nearly equal."""
    return sharding.sharded(_documents(spark, sf_dir), 8).withColumnRenamed("id", "doc_id")


@registry.add("""
WITH q AS (
    SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (
    SELECT vec_id, d, count(*) OVER (PARTITION BY vec_id) AS dims, floor(1024 * x::DOUBLE)::BIGINT AS x FROM q
), s AS (
    SELECT a.vec_id AS query_id, b.vec_id, sum(a.x * b.x)::BIGINT AS score
    FROM v a JOIN v b ON a.d = b.d AND a.dims = b.dims AND a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0 GROUP BY ALL
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""")
def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products for every hundredth vector, against all vectors."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return topk.top_k(vectors, F.col("id") % 100 == 0, k=10)


def held_out() -> F.Column:
    return F.crc32(F.col("id").cast("string")) % 4 == 2


@registry.add()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from labelled documents that are not held out."""
    docs = _documents(spark, sf_dir, "lang")
    model = langid.train(docs.where(~held_out()))
    told = langid.identified(docs, model)
    return told.select(F.col("id").alias("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


@registry.add("""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), owned AS (
    SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS gone FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM owned GROUP BY doc_id
""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines of all documents dropped but in the smallest document."""
    kept = line_dedup.without_repeated_lines(_documents(spark, sf_dir))
    return kept.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@registry.add()
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in every document, within the edit budget."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return decontaminate.contaminated(_documents(spark, sf_dir), items).withColumnRenamed("id", "doc_id")


@registry.add()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under piece_bpe_32k.model."""
    return tokens.counted(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@registry.add(r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
        range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s
    FROM words
), rows AS (SELECT doc_id, md5(unnest(s)) AS g FROM sets),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM rows a JOIN rows b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT p.a, p.b FROM pairs p JOIN sets x ON x.doc_id = p.a JOIN sets y ON y.doc_id = p.b
    WHERE 100 * p.n >= 85 * (len(x.s) + len(y.s) - p.n)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, low) AS (
    SELECT doc_id, doc_id FROM sets
    UNION
    SELECT e.b, r.low FROM reach r JOIN both_ways e ON e.a = r.id
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.low) AS component_id, s.doc_id = min(r.low) AS kept
FROM sets s JOIN reach r ON r.id = s.doc_id GROUP BY s.doc_id, s.s
""")
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents: shared 5-word shingles at least 85 % of all."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@registry.add()
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words, sources weighing 3, 1, 2 in turn."""
    mix = mixing.mixed(_documents(spark, sf_dir, "source"))
    return mix.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


@registry.add(r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS (
    SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM parts
), windows AS (
    SELECT doc_id, i, list(word) OVER ahead AS g, count(*) OVER ahead AS n FROM words
    WINDOW ahead AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
), twice AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM windows WHERE n = 8
), covered AS (
    SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM twice, range(8) r(k) WHERE times > 1 GROUP BY doc_id
), counted AS (
    SELECT doc_id, text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
        len(list_filter(w, lambda s: NOT regexp_matches(s, '\p{L}'))) AS n_letterless,
        len(list_filter(lines, lambda s: regexp_matches(s, '^[\x20\t]*[-*•]'))) AS n_bullets,
        len(list_filter(lines, lambda s: regexp_matches(s, '(\.\.\.|…)[\x20\t\r]*$'))) AS n_ellipses
    FROM parts LEFT JOIN covered USING (doc_id)
), based AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words
        OR 2 * n_dup_lines > n_lines OR 10 * n_letterless > 3 * n_words OR 10 * n_bullets > 9 * n_lines
        OR 10 * n_ellipses > 3 * n_lines) AS kept
FROM based
""")
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the verdict of the rules, run as a cascade."""
    return quality.judged(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@registry.add(r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
    FROM documents
), drawn AS (
    SELECT *, len(u) AS n, list_transform(range(4), lambda g: ('0x' || substr(h, 1 + 8 * g, 8))::BIGINT) AS r FROM cut
), placed AS (
    SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 50
            THEN 'plain' WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT *, array_to_string(u[1 : a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 : n], '') AS s FROM placed
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
""")
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for filling in the middle, and restored from its output."""
    told = fill_middle.transformed(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_middle.restored(), 256).alias("restored_sha256")
    return told.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def _lloyd_sql(rounds: int = 5, clusters: int = 40) -> str:
    """Lloyd's rounds written out, one after the other."""
    nearest = """
a{k} AS MATERIALIZED (
    SELECT vec_id, arg_min(cluster, (s, cluster)) AS cluster, min(s) AS distance FROM (
        SELECT v.vec_id, c.cluster, list_sum(list_transform(range(1, 65), lambda d: (v.q[d] - c.q[d]) * (v.q[d] - c.q[d])))::BIGINT AS s
        FROM v CROSS JOIN c{k} c
    ) GROUP BY vec_id
)"""
    means = """
c{n} AS MATERIALIZED (
    SELECT c.cluster, CASE WHEN m.q IS NULL THEN c.q ELSE m.q END AS q FROM c{k} c LEFT JOIN (
        SELECT cluster, list((s - (s % n + n) % n) // n ORDER BY d) AS q FROM (
            SELECT cluster, d, sum(x)::BIGINT AS s, count(*) AS n FROM a{k} JOIN parts USING (vec_id) GROUP BY cluster, d
        ) GROUP BY cluster
    ) m USING (cluster)
)"""
    steps = [nearest.format(k=k) + (("," + means.format(k=k, n=k + 1)) if k < rounds else "") for k in range(rounds + 1)]
    return f"""
WITH v AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (SELECT vec_id, unnest(q) AS x, generate_subscripts(q, 1) AS d FROM v),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster, q FROM v ORDER BY sha256('2:' || vec_id) LIMIT {clusters}
),{",".join(steps)}
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(q, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
"""


@registry.add(_lloyd_sql())
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in 40 clusters after five exact rounds."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return centroids.clustered(vectors).withColumnRenamed("id", "vec_id")
