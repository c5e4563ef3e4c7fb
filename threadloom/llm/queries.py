"""Thin queries over the operators of this subpackage, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import inner_product, langid, lexical, toxicity
from .common import table, training_fold
from .decontam import leaks
from .exact_dedup import exact_groups
from .filter_audit import audit
from .huffman import read_ids, write_ids
from .line_dedup import deduplicate_lines
from .packing import pack
from .sharding import uniform_shards
from .simhash import near_duplicates
from .substring_dedup import kept_texts, repeated_spans, whole_digests


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    best = F.get("matches", F.lit(0))
    return leaks(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", (F.size("matches") > 0).alias("contaminated"), F.size("matches").cast("long").alias("n_items"),
        best["item_id"].alias("item_id"), best["start"].alias("start_word"), best["n_words"].alias("n_words"), best["similarity"].alias("similarity"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(training_fold("doc_id"))
    model = toxicity.train(docs.filter(training_fold("doc_id")), labels)
    return toxicity.score(docs, model).select("doc_id", (~training_fold("doc_id")).alias("held_out"), "score", "predicted")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = kept_texts(docs, repeated_spans(docs))
    lost = kept.select("doc_id", "row", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    return whole_digests(docs).join(lost, ["doc_id", "row"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256")
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return read_ids(*write_ids(docs)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return deduplicate_lines(docs).select("doc_id", "n_lines", "n_removed", kept)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    return uniform_shards(docs, 24).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(langid.training_spans(docs.filter(training_fold("doc_id")), "text", "lang", "doc_id"))
    return langid.identify(docs, model).select("doc_id", (~training_fold("doc_id")).alias("held_out"), "lang_pred", "score", "n_switches")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit(docs, table(spark, sf_dir, "labels"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"), 50)


def op13_inner_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return inner_product.search(inner_product.build_index(vectors), vectors.filter("vec_id % 50 = 0"), 5)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_substring_dedup, op3_packing, op4_huffman, op5_line_dedup, op6_sharding, op7_language, op8_simhash, op9_decontamination, op10_exact_dedup, op11_filter_audit, op12_lexical_search, op13_inner_product)}

ORACLE_SQL = {
    "op2_substring_dedup": r"""
        WITH d AS MATERIALIZED (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        n AS MATERIALIZED (SELECT doc_id, w, len(w) AS n FROM d),
        win AS MATERIALIZED (SELECT doc_id, s, md5_number(array_to_string(w[s : s + 49], ' ')) AS h
                FROM (SELECT doc_id, w, unnest(range(1, n - 48)) AS s FROM n WHERE n >= 50)),
        first AS (SELECT h, min(doc_id) AS low FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
        hit AS (SELECT win.doc_id, s FROM win JOIN first ON win.h = first.h WHERE first.low < win.doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM hit),
        lost AS (SELECT doc_id, list(p) AS ps, count(*) AS n_removed FROM gone GROUP BY doc_id),
        stay AS (SELECT n.doc_id, string_agg(w[p], ' ' ORDER BY p) AS kept
                 FROM (SELECT n.doc_id, w, unnest(range(1, n + 1)) AS p FROM n) n LEFT JOIN gone USING (doc_id, p) WHERE gone.p IS NULL GROUP BY n.doc_id)
        SELECT n.doc_id, n.n AS n_words, coalesce(lost.n_removed, 0) AS n_removed, sha256(coalesce(stay.kept, '')) AS kept_sha256
        FROM n LEFT JOIN lost USING (doc_id) LEFT JOIN stay USING (doc_id)
    """,
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        m AS (SELECT doc_id, part, CASE WHEN len(w) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
                || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
                || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM d),
        l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        h AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, fails),
        f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
        o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
              WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f),
        s AS (SELECT filter_order, step, filter_order[step] AS f, filter_order[1 : step - 1] AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
        x AS (SELECT h.*, s.*, contains(fails, f) AS hit, before <> '' AND regexp_matches(fails, '[' || before || '_]') AS gone FROM h, s),
        r AS (SELECT part, filter_order, step, f, sum(n) FILTER (WHERE NOT hit AND NOT gone) AS kept, sum(n) FILTER (WHERE hit AND NOT gone) AS removed,
                sum(n) FILTER (WHERE hit AND gone) AS redundant, sum(n) FILTER (WHERE fails = f) AS unique_fails,
                sum(good) FILTER (WHERE hit AND NOT gone) AS good_lost, sum(toxic) FILTER (WHERE hit AND NOT gone) AS toxic_lost FROM x GROUP BY ALL)
        SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
            coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
            coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley FROM r
    """,
    "op12_lexical_search": r"""
        WITH t AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        q AS MATERIALIZED (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        g AS (SELECT count(*) AS nn, sum(len(w))::BIGINT AS ll FROM t WHERE len(w) > 0),
        p AS MATERIALIZED (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM t) GROUP BY ALL HAVING term IN (SELECT term FROM q)),
        df AS (SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM p, g GROUP BY term, nn),
        s AS (SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll))))::BIGINT AS score
              FROM q JOIN p USING (term) JOIN df USING (term), g GROUP BY item_id, doc_id)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 50
    """,
    "op13_inner_product": """
        WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
                WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
              FROM v q JOIN v c ON c.vec_id IS DISTINCT FROM q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s QUALIFY rank <= 5
    """,
}
