"""The driver's tables as records of the curation model, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """A scan of fewer splits than the session has tasks (few row groups), dealt to all of them; any other scan as it is."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks) if 2 * rows.rdd.getNumPartitions() <= tasks else rows


def parts(rows: DataFrame, per_part: int = 1 << 19) -> int:
    """How many partitions hold about ``per_part`` rows each; no fewer than the session has. Counts a scanned table from its footers."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // per_part))


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").filter("turn = 0").selectExpr(
        "concat('c', conv_id) AS id", "substr(text, 1, 40) AS title", "text AS selftext", "conv_id % 3 <> 0 AS is_self", "concat('u_', role) AS author", "conv_id % 7 AS score",
        "1700000000 + conv_id * 100 AS created_utc", "CAST(NULL AS STRING) AS link_flair_text", "conv_id % 11 = 0 AS _removed", "conv_id AS _pos",
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").filter("turn >= 1 AND NOT (turn = 2 AND conv_id % 7 = 0)").selectExpr(
        "concat('c', conv_id) AS thread_id", "concat('c', conv_id, 't', turn) AS id", "concat('t3_c', conv_id) AS link_id",
        "CASE WHEN turn <= 2 THEN concat('t3_c', conv_id) ELSE concat('t1_c', conv_id, 't', (turn - 1) div 2) END AS parent_id",
        "text AS body", "concat('u_', role) AS author", "turn AS score", "role = 'user' AS is_submitter", "CASE WHEN turn % 4 = 3 THEN 'moderator' END AS distinguished",
        "turn % 3 AS created_utc", "false AS _removed", "turn AS _pos",
    )


THREADS_SQL = r"""
    sub AS (SELECT 'c' || conv_id AS id, conv_id, substr(text, 1, 40) AS title, text AS selftext, conv_id % 3 <> 0 AS is_self, 'u_' || role AS author, conv_id % 7 AS score,
                   1700000000 + conv_id * 100 AS created_utc, conv_id % 11 = 0 AS removed FROM conversations WHERE turn = 0),
    com AS (SELECT conv_id, turn, CASE WHEN turn <= 2 THEN 0 ELSE (turn - 1) // 2 END AS above, text AS body, 'u_' || role AS author, role = 'user' AS is_submitter,
                   CASE WHEN turn % 4 = 3 THEN 'moderator' END AS distinguished, turn % 3 AS created FROM conversations WHERE turn >= 1 AND NOT (turn = 2 AND conv_id % 7 = 0)),
    tree AS (SELECT c.conv_id, c.turn, 1 AS depth, [struct_pack(o := CASE WHEN c.above = 0 THEN 0 ELSE 1 END, k := CASE WHEN c.above = 0 THEN c.created ELSE 0 END, t := c.turn)] AS path
             FROM com c LEFT JOIN com p ON p.conv_id = c.conv_id AND p.turn = c.above WHERE p.turn IS NULL
             UNION ALL SELECT c.conv_id, c.turn, t.depth + 1, list_append(t.path, struct_pack(o := 0, k := c.created, t := c.turn))
             FROM com c JOIN tree t ON c.conv_id = t.conv_id AND c.above = t.turn),
    placed AS (SELECT conv_id, turn, depth, row_number() OVER (PARTITION BY conv_id ORDER BY path) - 1 AS place FROM tree),
    seg AS (
        SELECT id AS thread_id, 0 AS seg_no, id, 'title' AS type, author, 0 AS depth, score, created_utc, false AS is_removed, true AS is_submitter, CAST(NULL AS VARCHAR) AS distinguished,
               trim(regexp_replace(title, '\s+', ' ', 'g')) AS text FROM sub
        UNION ALL SELECT id, 1, id, 'body', author, 0, score, created_utc, removed, true, CAST(NULL AS VARCHAR), trim(regexp_replace(selftext, '\s+', ' ', 'g')) FROM sub WHERE is_self
        UNION ALL SELECT s.id, p.place + CASE WHEN s.is_self THEN 2 ELSE 1 END, s.id || 't' || c.turn, 'comment', c.author, p.depth, c.turn, c.created, false, c.is_submitter, c.distinguished,
               trim(regexp_replace(c.body, '\s+', ' ', 'g')) FROM placed p JOIN com c USING (conv_id, turn) JOIN sub s USING (conv_id))
"""


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved mentions: an order is a thread, a part is a work. A line number may repeat in an order: ``_row`` is the row's place in its file."""
    return (
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_discount", "_metadata.row_index")
        .join(table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey"), "l_partkey")
        .selectExpr(
            "l_orderkey AS thread_id", "p_name AS text", "p_name AS canonical_title", "CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE p_brand END AS author_name",
            "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE concat('/works/', l_partkey) END AS ol_key", "round(l_discount * 10, 1) AS confidence", "l_linenumber % 3 = 0 AS ambiguous",
            "CASE WHEN l_partkey % 13 = 0 THEN 'failed' ELSE 'exact' END AS method", "l_orderkey * 10 + l_linenumber AS _pos", "row_index AS _row",
        )
    )


LINKS_SQL = """
    links AS (SELECT l_orderkey AS thread_id, p_name AS text, p_name AS canonical_title, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS author_name,
                     CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE '/works/' || p_partkey END AS ol_key, round(l_discount * 10, 1) AS confidence, l_linenumber % 3 = 0 AS ambiguous,
                     CASE WHEN p_partkey % 13 = 0 THEN 'failed' ELSE 'exact' END AS method, l_orderkey * 10 + l_linenumber AS _pos FROM lineitem JOIN part ON l_partkey = p_partkey)
"""


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("concat('/works/', p_partkey) AS ol_key", "p_name AS title", "p_brand AS author_name", "p_partkey % 2 = 0 AS has_subjects", "p_partkey AS _pos")


WORKS_SQL = "works AS (SELECT '/works/' || p_partkey AS ol_key, p_name AS title, p_brand AS author_name, p_partkey % 2 = 0 AS has_subjects, p_partkey AS _pos FROM part)"


def surfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles as people write them: every fifth as it is, others in capitals, with punctuation, or cut."""
    return table(spark, sf_dir, "part").selectExpr(
        "CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN concat(p_name, '!') WHEN 3 THEN concat('  ', p_name) ELSE concat(p_name, ' nowhere') END AS surface"
    ).distinct()


SURFACES_SQL = """
    surfaces AS (SELECT DISTINCT CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN p_name || '!' WHEN 3 THEN '  ' || p_name ELSE p_name || ' nowhere' END AS surface FROM part)
"""

NORM_SQL = r"trim(regexp_replace(regexp_replace(lower(strip_accents({0})), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
