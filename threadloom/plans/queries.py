"""The query catalogue over the driver's tables, with DuckDB counterparts where SQL has them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as tx
from ..operators import catalog, dictionary, fulltext, labels, resolve, selection, spans, stats, threads, trees
from ..sources.stored import stored
from ..streaming.incremental import unprocessed
from ..streaming.incremental import windowed_counts as event_counts
from . import adapters as ad

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def norm(x: str) -> str:
    return ad.NORM_SQL.format(x)


# Threads


def _segments(spark: SparkSession, d: str) -> DataFrame:
    return threads.segments(ad.submissions(spark, d), ad.comments(spark, d))


@query(f"WITH RECURSIVE {ad.THREADS_SQL} SELECT thread_id, seg_no, id, type, author, depth, is_removed, is_submitter, distinguished, text FROM seg")
def thread_segments(spark, d):
    return _segments(spark, d).drop("score", "created_utc")


@query(f"WITH RECURSIVE {ad.THREADS_SQL} SELECT 'c' || conv_id AS thread_id, 'c' || conv_id || 't' || turn AS id, depth, place FROM placed")
def comment_tree_recursive(spark, d):
    return threads.comment_order_sql(ad.comments(spark, d))


@query(f"WITH RECURSIVE {ad.THREADS_SQL} SELECT 'c' || conv_id AS thread_id, 'c' || conv_id || 't' || turn AS id, depth, place FROM placed")
def comment_tree_ranked(spark, d):
    """The order that threads of any size take: Euler tours ranked by joins."""
    return trees.ranked_order(ad.comments(spark, d))


@query(f"""WITH RECURSIVE {ad.THREADS_SQL}, f AS (SELECT thread_id, count(*) AS n, max(depth) AS deep, max(created_utc) AS last FROM seg WHERE type = 'comment' GROUP BY thread_id)
    SELECT sub.id AS thread_id, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title, author, score, strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d') AS date,
           coalesce(n, 0) AS num_comments_found, coalesce(deep, 0) AS depth_max, strftime(make_timestamp(last * 1000000), '%Y-%m-%d') AS date_last_comment
    FROM sub LEFT JOIN f ON f.thread_id = sub.id""")
def thread_metadata(spark, d):
    return threads.thread_metadata(ad.submissions(spark, d), _segments(spark, d)).drop("link_flair_text")


@query(f"""WITH RECURSIVE {ad.THREADS_SQL}, f AS (SELECT thread_id, count(*) AS n, max(created_utc) AS last FROM seg WHERE type = 'comment' GROUP BY thread_id),
    piece AS (SELECT thread_id, seg_no, CASE WHEN type = 'body' THEN text || chr(10) || chr(10) || repeat('─', 60) ELSE
        repeat(' ', 2 * least(depth, 8)) || '[u/' || author || CASE WHEN is_submitter THEN ' [OP]' ELSE '' END || CASE WHEN distinguished = 'moderator' THEN ' [MOD]' ELSE '' END ||
        CASE WHEN score <> 0 THEN ' +' || score ELSE '' END || ']' || chr(10) || repeat(' ', 2 * least(depth, 8)) || text || chr(10) END AS p FROM seg WHERE text <> '' AND type <> 'title'),
    mid AS (SELECT thread_id, string_agg(p, chr(10) ORDER BY seg_no) AS m FROM piece GROUP BY thread_id)
    SELECT sub.id AS thread_id, '[THREAD] ' || trim(regexp_replace(title, '\\s+', ' ', 'g')) || chr(10) || '[DATE] ' || strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d') || '  [AUTHOR] u/' || author ||
        '  [SCORE] ' || score || chr(10) || chr(10) || coalesce(m || chr(10), '') || repeat('─', 60) || chr(10) || '[THREAD END] ' || sub.id || ' | ' || coalesce(n, 0) || ' comments | ' ||
        strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d') || ': ' || coalesce(strftime(make_timestamp(last * 1000000), '%Y-%m-%d'), '?') AS document
    FROM sub LEFT JOIN mid ON mid.thread_id = sub.id LEFT JOIN f ON f.thread_id = sub.id""")
def thread_render(spark, d):
    segs = _segments(spark, d)
    return threads.render(segs, threads.thread_metadata(ad.submissions(spark, d), segs))


@query(f"""WITH RECURSIVE {ad.THREADS_SQL} SELECT thread_id, string_agg(repeat('→ ', greatest(0, depth - 1)) || CASE type WHEN 'title' THEN '[TITLE]' WHEN 'body' THEN '[POST by u/' || author || ']'
    ELSE '[' || repeat('→ ', greatest(0, depth - 1)) || 'u/' || author || ']' END || ' ' || text, chr(10) || chr(10) ORDER BY seg_no) AS document FROM seg WHERE text <> '' GROUP BY thread_id""")
def task_render(spark, d):
    return threads.render_task(_segments(spark, d))


@query(f"WITH RECURSIVE {ad.THREADS_SQL} SELECT thread_id, seg_no, id, type, author, depth, text FROM seg WHERE text <> '' AND NOT is_removed")
def segment_tasks(spark, d):
    return threads.segment_tasks(_segments(spark, d))


@query("""SELECT 'c' || conv_id AS id, count(*) FILTER (turn >= 1 AND NOT (turn = 2 AND conv_id % 7 = 0)) AS n_comments FROM conversations GROUP BY conv_id
    HAVING conv_id % 11 <> 0 AND count(*) FILTER (turn >= 1 AND NOT (turn = 2 AND conv_id % 7 = 0)) >= 3""")
def min_comments_filter(spark, d):
    return threads.enough_comments(ad.submissions(spark, d), ad.comments(spark, d), 3).select("id", "n_comments")


@query("SELECT conv_id, turn, text IN ('[deleted]', '[removed]') AS _removed FROM (SELECT conv_id, turn, CASE WHEN conv_id % 5 = 0 THEN '[deleted]' WHEN conv_id % 7 = 0 THEN ' [removed] ' ELSE text END AS text FROM conversations)")
def prune_removed_flag(spark, d):
    rows = ad.table(spark, d, "conversations").withColumn("text", F.expr("CASE WHEN conv_id % 5 = 0 THEN '[deleted]' WHEN conv_id % 7 = 0 THEN ' [removed] ' ELSE text END"))
    return rows.select("conv_id", "turn", tx.is_removed(F.col("text")).alias("_removed"))


@query("SELECT role, count(*) AS total, count(*) FILTER (conv_id % 5 = 0) AS removed, round_even(CAST(100.0 * count(*) FILTER (conv_id % 5 = 0) / count(*) AS DOUBLE), 2) AS removed_pct FROM conversations GROUP BY role")
def prune_counts(spark, d):
    rows = ad.table(spark, d, "conversations").select("role", tx.is_removed(F.expr("CASE WHEN conv_id % 5 = 0 THEN '[deleted]' ELSE text END")).alias("_removed"))
    return threads.prune_totals(rows, "role").select("role", "total", "removed", "removed_pct")


@query("""SELECT event_id, CASE WHEN event_type NOT IN ('purchase', 'view') THEN 'rejected' WHEN event_id % 10 = 0 THEN 'bad' WHEN event_type = 'view' THEN 'rejected' ELSE 'accepted' END AS status FROM events""")
def fast_reject_accept(spark, d):
    rows = ad.table(spark, d, "events").selectExpr(
        "event_id", "concat('{\"subreddit\":\"', event_type, '\",\"body\":\"', CASE WHEN event_type = 'view' THEN 'Purchase' ELSE '' END, '\",\"created_utc\":', CASE WHEN event_id % 10 = 0 THEN 'null' ELSE '\"1700000000\"' END, '}') AS value"
    )
    return threads.fast_accept(rows, ["Purchase"]).select("event_id", "status")


# Text functions


@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean FROM documents")
def clean_text(spark, d):
    return ad.table(spark, d, "documents").select("doc_id", tx.clean_text(F.col("text")).alias("clean"))


@query(f"SELECT doc_id, {norm('text')} AS norm FROM documents")
def norm_title(spark, d):
    return ad.table(spark, d, "documents").select("doc_id", tx.norm_title("text").alias("norm"))


@query(f"SELECT doc_id, {norm('text')} AS norm FROM documents")
def norm_title_native(spark, d):
    return ad.table(spark, d, "documents").select("doc_id", tx.norm_title_sql(F.col("text")).alias("norm"))


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')), '^(the|a|an)\s+', ''), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')) AS norm FROM documents""")
def stats_norm_title(spark, d):
    return ad.table(spark, d, "documents").select("doc_id", tx.norm_stats("text").alias("norm"))


@query("""SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1])), '') AS initials,
    array_to_string(list_transform(list_filter(string_split(p_name, ' '), lambda x: lower(x) NOT IN ('a','an','the','of','in','on','at','and','or','but','for','with','to','by')), lambda x: upper(x[1])), '') AS acronym,
    string_split(p_name, ' ')[-1] AS last FROM part""")
def initials_acronym(spark, d):
    name = F.col("p_name")
    return ad.table(spark, d, "part").select("p_partkey", tx.initials(name).alias("initials"), tx.title_acronym(name).alias("acronym"), tx.last_word(name).alias("last"))


@query("""WITH t AS (SELECT DISTINCT lower(p_name) AS a FROM part), n AS (SELECT lower(n_name) || ' ' || lower(r_name) AS b FROM nation JOIN region ON n_regionkey = r_regionkey),
    g AS (SELECT a, b, list_distinct(list_transform(range(1, length(a)), lambda i: substr(a, i, 2))) AS x, list_distinct(list_transform(range(1, length(b)), lambda i: substr(b, i, 2))) AS y FROM t JOIN n ON a[1] = b[1])
    SELECT a, b, round_even(CAST(2.0 * len(list_intersect(x, y)) / (len(x) + len(y)) AS DOUBLE), 6) AS dice FROM g""")
def dice_similarity(spark, d):
    a = ad.table(spark, d, "part").select(F.lower("p_name").alias("a")).distinct()
    nation, region = ad.table(spark, d, "nation"), ad.table(spark, d, "region")
    b = nation.join(region, nation.n_regionkey == region.r_regionkey).select(F.concat_ws(" ", F.lower("n_name"), F.lower("r_name")).alias("b"))
    pairs = a.join(b, F.substring("a", 1, 1) == F.substring("b", 1, 1))
    return pairs.select("a", "b", stats.round_even(sim.dice(F.col("a"), F.col("b")), 6).alias("dice"))


@query()
def indel_similarities(spark, d):
    a = ad.table(spark, d, "part").select(F.lower("p_name").alias("a")).distinct()
    pairs = a.join(a.select(F.col("a").alias("b")), F.substring("a", 1, 2) == F.substring("b", 1, 2))
    return pairs.select("a", "b", *(F.bround(f("a", "b"), 6).alias(n) for n, f in (("ratio", sim.indel_ratio), ("sort", sim.sort_ratio), ("partial", sim.part_ratio), ("token_set", sim.set_ratio))))


@query("""SELECT doc_id, regexp_matches(s, '^(\\d\\s+)?[A-Z][a-z]+\\s+\\d+:\\d+') OR regexp_extract(lower(s), '^[^ ,.]+') IN ('mark', 'john', 'genesis') AS scripture
    FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Mark, ' || lang WHEN 1 THEN '1 Kings ' || doc_id || ':' || (doc_id % 30) WHEN 2 THEN 'John' ELSE lang || ' 3:16' END AS s FROM documents)""")
def scripture_flag(spark, d):
    rows = ad.table(spark, d, "documents").selectExpr("doc_id", "CASE doc_id % 4 WHEN 0 THEN concat('Mark, ', lang) WHEN 1 THEN concat('1 Kings ', doc_id, ':', doc_id % 30) WHEN 2 THEN 'John' ELSE concat(lang, ' 3:16') END AS s")
    return rows.select("doc_id", tx.is_scripture(F.col("s")).alias("scripture"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'one hundred years of ' || lower(p_name) WHEN 1 THEN 'volume two saint ' || lower(p_name) ELSE '1000000 number nine' END AS spelled FROM part")
def number_normalize(spark, d):
    rows = ad.table(spark, d, "part").selectExpr("p_partkey", "CASE p_partkey % 3 WHEN 0 THEN concat('100 yrs of ', p_name) WHEN 1 THEN concat('Vol 2 ST ', p_name) ELSE '1,000000 no 9' END AS s")
    return rows.select("p_partkey", F.regexp_replace(tx.spell_numbers(F.col("s")), "one million", "1000000").alias("spelled"))


@query("SELECT l_orderkey, string_agg(DISTINCT p_name, '|' ORDER BY p_name) AS piped, count(DISTINCT p_name) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey")
def pipe_roundtrip(spark, d):
    rows = ad.links(spark, d).groupBy(F.col("thread_id").alias("l_orderkey")).agg(F.array_join(F.sort_array(F.collect_set("text")), "|").alias("piped"))
    return rows.select("l_orderkey", F.array_join(tx.pipe_split(F.concat("piped", F.lit("| "))), "|").alias("piped"), F.size(tx.pipe_split(F.col("piped"))).cast("long").alias("n"))


@query("SELECT page_id, 'OL' || page_id || 'W|OL' || (page_id % 7) || 'M' AS keys FROM pages")
def url_key_extract(spark, d):
    rows = ad.table(spark, d, "pages").select("page_id", F.expr("concat(url, '/OL', page_id, 'W x /OL', page_id % 7, 'M /OL', page_id, 'W')").alias("u"))
    return rows.select("page_id", F.array_join(tx.catalog_keys(F.col("u")), "|").alias("keys"))


# Labels


@query("SELECT source, count(*) AS n FROM (SELECT CASE WHEN quality = 1 THEN 'annotation' WHEN d.doc_id % 2 = 0 THEN 'prediction' ELSE 'none' END AS source FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY source")
def result_source_choice(spark, d):
    rows = ad.table(spark, d, "documents").select("doc_id").join(ad.table(spark, d, "labels"), "doc_id", "left")
    span = "array(named_struct('text', 'x'))"
    rows = rows.withColumn("annotations", F.expr(f"array(named_struct('was_cancelled', true, 'result', {span}), named_struct('was_cancelled', coalesce(quality, 0) = 0, 'result', {span}))"))
    rows = rows.withColumn("predictions", F.expr(f"CASE WHEN doc_id % 2 = 0 THEN array(named_struct('score', 0.8, 'result', {span})) ELSE array() END"))
    return rows.select(labels.chosen_result(F.col("annotations"), F.col("predictions"))[0].alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def _event_mentions(spark: SparkSession, d: str) -> DataFrame:
    return ad.table(spark, d, "events").selectExpr("event_id DIV 4 AS task_id", "user_id AS thread_id", "CASE WHEN user_id % 2 = 0 THEN 'BOOK' ELSE 'WRITER' END AS label", "event_type AS text")


_MENTIONS_SQL = "m AS (SELECT event_id // 4 AS task_id, user_id AS thread_id, CASE WHEN user_id % 2 = 0 THEN 'BOOK' ELSE 'WRITER' END AS label, event_type AS text FROM events)"
_SETS_SQL = "SELECT label, text, thread_id, count(*) AS n FROM {0} GROUP BY GROUPING SETS ((text), (label, text), (label, text, thread_id))"


@query(f"WITH {_MENTIONS_SQL} {_SETS_SQL.format('m')}")
def label_stats(spark, d):
    return labels.mention_counts(_event_mentions(spark, d)).select("label", "text", "thread_id", "n")


@query(f"WITH {_MENTIONS_SQL} SELECT label, text, count(*) AS n FROM (SELECT DISTINCT task_id, label, text FROM m) GROUP BY label, text")
def label_stats_unique(spark, d):
    return labels.mention_counts(_event_mentions(spark, d), True).filter(F.col("label").isNotNull() & (F.col("level") == 1)).select("label", "text", "n")


@query(f"WITH {_MENTIONS_SQL}, c AS (SELECT thread_id, count(*) AS n FROM m GROUP BY thread_id), t AS (SELECT * FROM c ORDER BY n DESC, thread_id LIMIT 20) SELECT * FROM t WHERE n >= 5")
def label_top(spark, d):
    return labels.top_then_frequent(_event_mentions(spark, d).groupBy("thread_id").agg(F.count(F.lit(1)).alias("n")), 20, 5, "thread_id")


@query("SELECT doc_id, n, n_chars, round_even(CAST(n AS DOUBLE) / nullif(n_chars, 0), 9) AS density FROM (SELECT doc_id, n_chars, (length(text) - length(replace(text, 'the', ''))) // 3 AS n FROM documents) WHERE n > 5 ORDER BY density DESC, doc_id LIMIT 50")
def density_rank(spark, d):
    rows = ad.table(spark, d, "documents").selectExpr("doc_id", "n_chars", "(length(text) - length(replace(text, 'the', ''))) DIV 3 AS n").filter("n > 5")
    return stats.density(rows, "n", "n_chars").withColumn("density", stats.round_even(F.col("density"), 9)).orderBy(F.desc("density"), "doc_id").limit(50)


@query("SELECT source, CAST(sum(CASE WHEN contains(lower(text), 'idiot') THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), 'scum') THEN 1 ELSE 0 END) AS BIGINT) AS n FROM documents GROUP BY source HAVING n > 0")
def bad_term_threads(spark, d):
    low = F.lower("text")
    hits = F.contains(low, F.lit("idiot")).cast("int") + F.contains(low, F.lit("scum")).cast("int")
    return ad.table(spark, d, "documents").groupBy("source").agg(F.sum(hits).alias("n")).filter("n > 0")


@query("SELECT DISTINCT source FROM documents WHERE lang = 'en' EXCEPT SELECT DISTINCT source FROM documents WHERE lang = 'de' AND n_chars > 9000")
def set_difference(spark, d):
    docs = ad.table(spark, d, "documents")
    return docs.filter("lang = 'en'").select("source").subtract(docs.filter("lang = 'de' AND n_chars > 9000").select("source"))


@query("WITH t AS (SELECT doc_id, source FROM documents), f AS (SELECT DISTINCT 'src' || (n_nationkey % 4) AS term FROM nation) SELECT t.doc_id AS task_id, string_agg(DISTINCT term, '|' ORDER BY term) AS flags FROM t JOIN f ON source = term GROUP BY t.doc_id")
def flag_tasks(spark, d):
    rows = ad.table(spark, d, "documents").select(F.col("doc_id").alias("task_id"), F.upper("source").alias("text"))
    terms = ad.table(spark, d, "nation").selectExpr("concat('src', n_nationkey % 4) AS term").distinct()
    return labels.flag_tasks(rows, terms, True).select("task_id", F.array_join(labels.add_flags(F.lit(None), F.col("flags")), "|").alias("flags"))


# Spans


def _doc_items(spark: SparkSession, d: str) -> DataFrame:
    docs = ad.table(spark, d, "documents").select("doc_id", "text")
    return docs.withColumn("entity", F.substring_index(F.col("text"), " ", 1)).filter("length(entity) > 1")


@query("""WITH RECURSIVE e AS (SELECT doc_id, text, string_split(text, ' ')[1] AS entity FROM documents),
    r AS (SELECT doc_id, text, entity, instr(text, entity) - 1 AS start FROM e WHERE length(entity) > 1
          UNION ALL SELECT doc_id, text, entity, start + length(entity) + instr(substr(text, start + length(entity) + 1), entity) - 1 FROM r WHERE instr(substr(text, start + length(entity) + 1), entity) > 0)
    SELECT doc_id, entity, start FROM r""")
def verbatim_spans(spark, d):
    return _doc_items(spark, d).select("doc_id", "entity", F.explode(spans.verbatim_spans(F.col("entity"), F.col("text"))).alias("start"))


@query()
def find_spans_cascade(spark, d):
    rows = _doc_items(spark, d).withColumn("entity", F.expr("CASE doc_id % 3 WHEN 0 THEN entity WHEN 1 THEN upper(entity) ELSE concat(substring_index(text, ' ', 2), ' nowhere') END"))
    return rows.select("doc_id", "entity", F.explode(spans.entity_spans("entity", "text")).alias("s")).select("doc_id", "entity", "s.start", "s.end", "s.pass")


def _line_spans(spark: SparkSession, d: str) -> DataFrame:
    rows = ad.table(spark, d, "lineitem").selectExpr("l_orderkey", "CAST(l_partkey % 60 AS INT) AS start", "CAST(l_partkey % 60 + 1 + l_suppkey % 25 AS INT) AS end")
    return rows.distinct().groupBy("l_orderkey").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


_SPANS_SQL = """sp AS (SELECT DISTINCT l_orderkey, l_partkey % 60 AS s, l_partkey % 60 + 1 + l_suppkey % 25 AS e FROM lineitem),
    o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {0}) AS k FROM sp),
    r AS (SELECT l_orderkey, k, [struct_pack(s := s, e := e)] AS kept FROM o WHERE k = 1
          UNION ALL SELECT o.l_orderkey, o.k, CASE WHEN len(list_filter(r.kept, lambda x: o.s < x.e AND x.s < o.e)) > 0 THEN r.kept ELSE list_append(r.kept, struct_pack(s := o.s, e := o.e)) END
          FROM r JOIN o ON o.l_orderkey = r.l_orderkey AND o.k = r.k + 1),
    f AS (SELECT l_orderkey, unnest(arg_max(kept, k)) AS x FROM r GROUP BY l_orderkey)
    SELECT l_orderkey, x.s AS start, x.e AS "end" FROM f"""


@query("WITH RECURSIVE " + _SPANS_SQL.format("e - s DESC, s"))
def overlap_longest(spark, d):
    return _line_spans(spark, d).select("l_orderkey", F.explode(selection.longest_first(F.col("spans"))).alias("s")).select("l_orderkey", "s.start", "s.end")


@query("WITH RECURSIVE " + _SPANS_SQL.format("s, e DESC"))
def leftmost_longest(spark, d):
    return _line_spans(spark, d).select("l_orderkey", F.explode(selection.leftmost_longest(F.col("spans"))).alias("s")).select("l_orderkey", "s.start", "s.end")


_LABELLED_SQL = """sp AS (SELECT l_suppkey AS k, l_returnflag AS label, l_partkey % 900 AS s, l_partkey % 900 + l_quantity::BIGINT % 25 AS e, min((l_orderkey, l_linenumber)) AS seen FROM lineitem GROUP BY ALL),
    o AS (SELECT *, row_number() OVER (PARTITION BY k, label ORDER BY e - s DESC, seen) AS n FROM sp),
    r AS (SELECT k, label, n, [struct_pack(s := s, e := e)] AS kept FROM o WHERE n = 1
          UNION ALL SELECT o.k, o.label, o.n, CASE WHEN len(list_filter(r.kept, lambda x: o.s < x.e AND x.s < o.e)) > 0 THEN r.kept ELSE list_append(r.kept, struct_pack(s := o.s, e := o.e)) END
          FROM r JOIN o ON o.k = r.k AND o.label = r.label AND o.n = r.n + 1),
    f AS (SELECT k, label, unnest(arg_max(kept, n)) AS x FROM r GROUP BY k, label)"""


@query(f'WITH RECURSIVE {_LABELLED_SQL} SELECT k AS l_suppkey, label, x.s AS start, x.e AS "end" FROM f')
def overlap_by_label(spark, d):
    """Suppliers as texts with all their items as spans of three labels, empty ones too; ties go to what comes first in the array."""
    rows = ad.table(spark, d, "lineitem").selectExpr("l_suppkey", "l_returnflag AS label", "CAST(l_partkey % 900 AS INT) AS start", "CAST(l_partkey % 900 + CAST(l_quantity AS BIGINT) % 25 AS INT) AS end", "struct(l_orderkey, l_linenumber) AS seen")
    rows = rows.groupBy("l_suppkey", "label", "start", "end").agg(F.min("seen").alias("seen"))
    rows = rows.groupBy("l_suppkey").agg(F.array_sort(F.collect_list(F.struct("seen", "start", "end", "label"))).alias("spans"))
    return rows.select("l_suppkey", F.explode(selection.longest_first_by_label(F.col("spans"))).alias("s")).select("l_suppkey", "s.label", "s.start", "s.end")


@query("""WITH sp AS (SELECT DISTINCT l_orderkey, l_partkey % 60 AS s, l_partkey % 60 + 1 + l_suppkey % 25 AS e FROM lineitem), hit AS (SELECT l_orderkey, min(s) + 5 AS hs, min(s) + 15 AS he FROM sp GROUP BY l_orderkey)
    SELECT l_orderkey, hs AS start, he AS "end" FROM hit h WHERE NOT EXISTS (SELECT 1 FROM sp WHERE sp.l_orderkey = h.l_orderkey AND greatest(0, least(he, e) - greatest(hs, s)) / CAST(he - hs AS DOUBLE) >= 0.5)""")
def novelty_filter(spark, d):
    rows = _line_spans(spark, d).withColumn("hit", F.expr("named_struct('start', array_min(spans).start + 5, 'end', array_min(spans).start + 15)"))
    return rows.filter(spans.novel(F.col("hit"), F.col("spans"))).select("l_orderkey", "hit.start", "hit.end")


@query("""WITH sp AS (SELECT DISTINCT l_orderkey, l_partkey % 60 AS s, l_partkey % 60 + 1 + l_suppkey % 25 AS e, CASE WHEN l_partkey % 2 = 0 THEN 'BOOK' ELSE 'WRITER' END AS label FROM lineitem),
    new AS (SELECT l_orderkey, 10 + l_orderkey % 20 AS s, 20 + l_orderkey % 20 AS e, 'BOOK' AS label FROM sp GROUP BY l_orderkey)
    SELECT l_orderkey, s AS start, e AS "end", label FROM sp WHERE NOT (label = 'BOOK' AND EXISTS (SELECT 1 FROM new n WHERE n.l_orderkey = sp.l_orderkey AND least(n.e, sp.e) > greatest(n.s, sp.s)))
    UNION ALL SELECT l_orderkey, s, e, label FROM new""")
def merge_spans(spark, d):
    rows = ad.table(spark, d, "lineitem").selectExpr("l_orderkey", "named_struct('start', CAST(l_partkey % 60 AS INT), 'end', CAST(l_partkey % 60 + 1 + l_suppkey % 25 AS INT), 'labels', array(CASE WHEN l_partkey % 2 = 0 THEN 'BOOK' ELSE 'WRITER' END)) AS s").distinct()
    rows = rows.groupBy("l_orderkey").agg(F.collect_list("s").alias("old"))
    new = F.expr("array(named_struct('start', CAST(10 + l_orderkey % 20 AS INT), 'end', CAST(20 + l_orderkey % 20 AS INT), 'labels', array('BOOK')))")
    return rows.select("l_orderkey", F.explode(spans.merge_accepted(F.col("old"), new)).alias("s")).select("l_orderkey", "s.start", "s.end", F.get("s.labels", F.lit(0)).alias("label"))


@query()
def noise_remap(spark, d):
    rows = ad.table(spark, d, "documents").select("doc_id", F.expr("concat('[u/', source, '] . ', text, ' [→ u/x] [u/b]', lang)").alias("t"))
    cut = rows.withColumn("r", spans.remove_noise("t", F.expr("transform(sequence(0, length(t) - 2, 25), x -> named_struct('start', x, 'end', x + 2)) || array(named_struct('start', length(t) - 2, 'end', length(t)))")))
    return cut.select("doc_id", "r.text", F.element_at("r.spans", -1)["start"].alias("start"))


@query("""SELECT doc_id, CASE WHEN low > 0 THEN '…' ELSE '' END || substr(text, low + 1, high - low) || CASE WHEN high < length(text) THEN '…' ELSE '' END AS snippet
    FROM (SELECT doc_id, text, greatest(doc_id % 90 - 40, 0) AS low, least(doc_id % 90 + 50, length(text)) AS high FROM documents WHERE length(text) > 100)""")
def snippet(spark, d):
    rows = ad.table(spark, d, "documents").filter("length(text) > 100")
    at = (F.col("doc_id") % 90).cast("int")
    return rows.select("doc_id", spans.snippet(F.col("text"), at, at + 10).alias("snippet"))


def _titles(spark: SparkSession, d: str) -> DataFrame:
    return ad.table(spark, d, "benchmark").selectExpr("concat('b', item_id) AS ol_key", r"array_join(slice(split(text, '[^\\p{L}]+'), 1, 3), ' ') AS title").filter("length(title) > 5")


_DICT_SQL = r"""WITH RECURSIVE t AS (SELECT lower(title) AS t, min(ol_key) AS ol_key FROM (SELECT 'b' || item_id AS ol_key, array_to_string(regexp_split_to_array(text, '[^\p{L}]+')[1:3], ' ') AS title FROM benchmark) WHERE length(title) > 5 GROUP BY 1),
    d AS (SELECT doc_id, lower(text) AS low FROM documents),
    r AS (SELECT doc_id, ol_key, t, low, instr(low, t) AS pos FROM d JOIN t ON contains(low, t)
          UNION ALL SELECT doc_id, ol_key, t, low, pos + instr(substr(low, pos + 1), t) FROM r WHERE instr(substr(low, pos + 1), t) > 0)
    SELECT doc_id AS task_id, ol_key, t AS title, (pos - 1)::INTEGER AS start, (pos - 1 + length(t))::INTEGER AS "end" FROM r
    WHERE (pos = 1 OR NOT regexp_matches(substr(low, pos - 1, 1), '[\p{L}\p{N}_]')) AND NOT regexp_matches(substr(low, pos + length(t), 1), '[\p{L}\p{N}_]')"""


@query(_DICT_SQL)
def dictionary_match(spark, d):
    return dictionary.matches(ad.table(spark, d, "documents").select(F.col("doc_id").alias("task_id"), "text"), _titles(spark, d))


@query(_DICT_SQL)
def dictionary_match_automaton(spark, d):
    """The same with so small shards that the dictionary has many."""
    return dictionary.matches(ad.spread(ad.table(spark, d, "documents").select(F.col("doc_id").alias("task_id"), "text")), _titles(spark, d), shard_chars=200)


@query("SELECT CASE WHEN n < 6 THEN '0-5' WHEN n <= 10 THEN '6-10' WHEN n <= 20 THEN '11-20' WHEN n <= 30 THEN '21-30' WHEN n <= 50 THEN '31-50' WHEN n <= 100 THEN '51-100' ELSE '101+' END AS bucket, count(*) AS n FROM (SELECT length(text) AS n FROM conversations) GROUP BY 1")
def length_histogram(spark, d):
    return ad.table(spark, d, "conversations").groupBy(spans.length_buckets(F.length("text")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_type AS ol_key, p_name AS text, length, _pos FROM (SELECT p_type, p_name, length(p_name) AS length, p_partkey AS _pos, row_number() OVER (PARTITION BY p_type ORDER BY length(p_name) DESC, p_partkey) AS k FROM part) WHERE k = 1")
def dedup_longest_by_key(spark, d):
    rows = ad.table(spark, d, "part").selectExpr("p_type AS ol_key", "p_name AS text", "length(p_name) AS length", "p_partkey AS _pos")
    return labels.best_by(rows, ["ol_key"], F.desc("length"), F.col("_pos"))


@query("SELECT p_partkey, count(*) OVER (PARTITION BY lower(trim(p_name))) - 1 AS n_others FROM part")
def cascade_count(spark, d):
    return labels.repeats(ad.table(spark, d, "part").select("p_partkey", "p_name"), "p_name").select("p_partkey", "n_others")


@query("""WITH b AS (SELECT p_type || p_size AS ol_key, p_name AS text, p_size, row_number() OVER (PARTITION BY p_type, p_size ORDER BY length(p_name) DESC, p_partkey) AS k FROM part)
    SELECT ol_key, text FROM b WHERE k = 1 AND length(text) >= 8 AND p_size <= 45 AND lower(trim(text)) NOT IN (SELECT lower(trim(p_name)) FROM part WHERE p_partkey % 200 = 0)""")
def review_queue(spark, d):
    part = ad.table(spark, d, "part")
    rows = part.selectExpr("concat(p_type, p_size) AS ol_key", "p_name AS text", "length(p_name) AS length", "p_partkey AS _pos")
    reviewed, rejected = part.filter("p_size > 45").selectExpr("concat(p_type, p_size) AS ol_key"), part.filter("p_partkey % 200 = 0").selectExpr("upper(p_name) AS text")
    return labels.review_queue(rows, reviewed, rejected, 8).select("ol_key", "text")


# Catalog


@query("SELECT s_suppkey, p_name AS title, p_partkey FROM (SELECT s_suppkey, p_name, p_partkey, row_number() OVER (PARTITION BY s_suppkey ORDER BY p_partkey) AS k FROM (SELECT DISTINCT l_suppkey AS s_suppkey, l_partkey AS p_partkey FROM lineitem) JOIN part USING (p_partkey)) WHERE k <= 50")
def works_for_author(spark, d):
    junction = ad.table(spark, d, "lineitem").selectExpr("l_partkey AS work_key", "l_suppkey AS author_key").distinct()
    works, names = ad.table(spark, d, "part").selectExpr("p_partkey AS ol_key", "p_name AS title"), ad.table(spark, d, "supplier").selectExpr("s_suppkey AS ol_key")
    return catalog.works_of_author(works, junction, names).selectExpr("author_key AS s_suppkey", "title", "work_key AS p_partkey")


@query(f"WITH {ad.WORKS_SQL}, {ad.SURFACES_SQL} SELECT surface, ol_key, title FROM surfaces JOIN works ON surface = title")
def exact_lookup(spark, d):
    return catalog.exact_lookup(ad.surfaces(spark, d), ad.works(spark, d)).select("surface", "ol_key", "title")


@query(f"WITH {ad.WORKS_SQL}, {ad.SURFACES_SQL} SELECT surface, ol_key, title FROM surfaces JOIN works ON {norm('surface')} = {norm('title')}")
def normalized_lookup(spark, d):
    left, right = ad.surfaces(spark, d).withColumn("norm", tx.norm_title("surface")), ad.works(spark, d).withColumn("norm_title", tx.norm_title("title"))
    return catalog.normalised_lookup(left, right).select("surface", "ol_key", "title")


@query(r"""WITH d AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda x: x <> '') AS tok FROM documents),
    p AS (SELECT doc_id, len(tok) AS len, unnest(tok) AS token FROM d), tf AS (SELECT doc_id, len, token, count(*) AS tf FROM p GROUP BY ALL),
    st AS (SELECT count(*) AS n, avg(len(tok)) AS mean FROM d WHERE len(tok) > 0), q AS (SELECT unnest(['the and', 'der die', 'the idiot']) AS query), qt AS (SELECT query, unnest(string_split(query, ' ')) AS token FROM q),
    df AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
    s AS (SELECT query, doc_id, round_even(sum(ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 6) AS score FROM qt JOIN df USING (token) JOIN tf USING (token), st GROUP BY query, doc_id HAVING count(*) = 2)
    SELECT query, doc_id, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS k FROM s) WHERE k <= 20""")
def fts_search(spark, d):
    tokens = F.filter(F.split(tx.search_terms(F.lower("text")), " "), lambda w: w != "")
    queries = spark.createDataFrame([(q, q.split()) for q in ("the and", "der die", "the idiot")], "query string, terms array<string>")
    index = fulltext.build(ad.spread(ad.table(spark, d, "documents").select("doc_id", "text")), "doc_id", tokens)
    return fulltext.search(index, queries, 20).select("query", "doc_id", F.round("score", 4).alias("score"))


@query("""WITH a AS (SELECT p_partkey, p_name, array_to_string(list_transform(list_filter(string_split(p_name, ' '), lambda x: lower(x) NOT IN ('a','an','the','of','in','on','at','and','or','but','for','with','to','by')), lambda x: upper(x[1])), '') AS acronym FROM part),
    r AS (SELECT *, row_number() OVER (PARTITION BY acronym ORDER BY '/works/' || p_partkey) AS k FROM a) SELECT acronym, '/works/' || p_partkey AS ol_key FROM r WHERE k <= 10""")
def acronym_lookup(spark, d):
    works = ad.works(spark, d)
    return catalog.acronym_matches(works.select(tx.title_acronym(F.col("title")).alias("acronym")).distinct(), works).select("acronym", "ol_key")


@query(f"""WITH {ad.WORKS_SQL}, {ad.SURFACES_SQL}, w AS (SELECT ol_key, unnest(list_distinct(list_filter(string_split({norm('title')}, ' '), lambda x: length(x) >= 4))) AS token FROM works),
    i AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY ol_key) AS k FROM w) WHERE k <= 300), s AS (SELECT surface, unnest(list_distinct(string_split({norm('surface')}, ' '))) AS token FROM surfaces)
    SELECT DISTINCT surface, ol_key FROM s JOIN i USING (token)""")
def token_candidates(spark, d):
    index = catalog.token_index(ad.works(spark, d).withColumn("norm_title", tx.norm_title("title")))
    return catalog.token_candidates(ad.surfaces(spark, d).withColumn("norm", tx.norm_title("surface")), index)


def _dump(spark: SparkSession, d: str) -> DataFrame:
    """Work records as a catalog dump has them: several revisions of a key, two shapes of description."""
    return ad.table(spark, d, "part").selectExpr(
        "concat('/works/OL', p_partkey % 500, 'W') AS key", "p_partkey AS _pos",
        "concat('{\"title\":\"', p_name, '\",\"authors\":[{\"author\":{\"key\":\"', p_brand, '\"}},{\"author\":\"x\"}],\"description\":', CASE WHEN p_partkey % 2 = 0 THEN '{\"value\":\"long\"}' ELSE '\"short\"' END, '}') AS payload",
    )


@query("""SELECT '/works/OL' || (p_partkey % 500) || 'W' AS ol_key, arg_max(p_name, p_partkey) AS title, arg_max(p_brand, p_partkey) AS author,
    CASE WHEN max(p_partkey) % 2 = 0 THEN 'long' ELSE 'short' END AS description FROM part GROUP BY p_partkey % 500""")
def catalog_import(spark, d):
    works = catalog.works_table(_dump(spark, d))
    return works.select("ol_key", "title", F.array_join("author_keys", "|").alias("author"), "description")


@query("SELECT DISTINCT '/works/OL' || (p_partkey % 500) || 'W' AS work_key, p_brand AS author_key FROM part")
def catalog_junction(spark, d):
    return catalog.work_authors(_dump(spark, d))


@query("SELECT lower(p_name) AS title_lower, '/works/' || min(p_partkey) AS ol_key FROM part WHERE length(p_name) >= 10 AND contains(trim(p_name), ' ') GROUP BY lower(p_name)")
def title_dictionary(spark, d):
    return catalog.title_dictionary(ad.works(spark, d), 10).select("title_lower", "ol_key")


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'submission' WHEN 1 THEN 'comment' WHEN 2 THEN 'submission' END AS kind FROM events")
def record_kinds(spark, d):
    keys = "CASE event_id % 4 WHEN 0 THEN '{\"title\":null}' WHEN 1 THEN '{\"body\":\"title\"}' WHEN 2 THEN '{\"body\":1,\"title\":2}' ELSE '{\"id\":\"title\"}' END"
    return ad.table(spark, d, "events").select("event_id", threads.record_kind(F.expr(keys)).alias("kind"))


@query("SELECT event_id, event_id % 5 < 3 AS flag, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS DOUBLE) / 100 END AS score FROM events")
def flag_and_number_parsing(spark, d):
    rows = ad.table(spark, d, "events").selectExpr("event_id", "CASE event_id % 5 WHEN 0 THEN ' True ' WHEN 1 THEN '1' WHEN 2 THEN 'YES' WHEN 3 THEN 'no' ELSE '' END AS f", "CASE WHEN event_id % 2 = 0 THEN concat(' ', event_id) ELSE 'n/a' END AS n")
    return rows.select("event_id", tx.as_flag(F.col("f")).alias("flag"), (tx.as_number(F.col("n")) / 100).alias("score"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n FROM orders WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '1995-03' AND '1996-02' GROUP BY ym")
def month_selection(spark, d):
    from ..sources.files import months

    rows = ad.table(spark, d, "orders").select(months(F.concat(F.lit("/dumps/RC_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".zst"))).alias("ym"))
    return rows.filter(F.col("ym").between("1995-03", "1996-02")).groupBy("ym").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, p_brand AS text FROM part WHERE p_size % 3 = 0")
def reply_entities(spark, d):
    reply = F.expr("concat('```json\n[{\"text\":\" ', p_brand, ' \",\"label\":\"', CASE WHEN p_size % 3 = 0 THEN 'book' ELSE 'film' END, '\"}]\n```')")
    return ad.table(spark, d, "part").select("p_partkey", F.explode(tx.reply_entities(reply)).alias("e")).select("p_partkey", "e.text")


# Resolution


def _task_mentions(spark: SparkSession, d: str) -> DataFrame:
    rows = ad.links(spark, d)
    books = rows.selectExpr("thread_id AS task_id", "'BOOK' AS label", "text")
    return books.unionByName(rows.filter("author_name IS NOT NULL").selectExpr("thread_id AS task_id", "'WRITER' AS label", "author_name AS text"))


@query(f"""WITH {ad.LINKS_SQL}, b AS (SELECT DISTINCT thread_id, text AS surface FROM links), w AS (SELECT DISTINCT thread_id, {norm('author_name')} AS writer FROM links WHERE author_name IS NOT NULL)
    SELECT surface, string_agg(DISTINCT writer, '|' ORDER BY writer) AS writers FROM b JOIN w USING (thread_id) GROUP BY surface""")
def context_writers(spark, d):
    return resolve.context_writers(_task_mentions(spark, d), None, ad.parts(ad.table(spark, d, "lineitem"))).select("surface", F.array_join("writers", "|").alias("writers"))


def _candidates(pairs: DataFrame, context: DataFrame) -> DataFrame:
    rows = pairs.join(context, "surface", "left").withColumn("in_context", resolve.author_in_context(F.col("author_norm"), F.col("writers")))
    return rows.select("surface", "norm", "ol_key", "title", "norm_title", "author_name", "in_context", "has_subjects")


def _cascade(spark: SparkSession, d: str) -> DataFrame:
    works = ad.works(spark, d).withColumn("norm_title", tx.norm_title("title")).withColumn("author_norm", tx.norm_title("author_name"))
    surfaces = ad.surfaces(spark, d).withColumn("norm", tx.norm_title("surface"))
    context = stored(resolve.context_writers(_task_mentions(spark, d), None, ad.parts(ad.table(spark, d, "lineitem"))), "context")
    exact = resolve.build_resolutions(_candidates(catalog.exact_lookup(surfaces, works), context), "exact")
    return resolve.cascade(surfaces, [exact, resolve.build_resolutions(_candidates(catalog.normalised_lookup(surfaces, works), context), "normalized")])


_CASCADE_SQL = f"""{ad.WORKS_SQL}, {ad.SURFACES_SQL}, {ad.LINKS_SQL}, b AS (SELECT DISTINCT thread_id, text AS surface FROM links),
    w AS (SELECT DISTINCT thread_id, {norm('author_name')} AS writer FROM links WHERE author_name IS NOT NULL), ctx AS (SELECT DISTINCT surface, writer FROM b JOIN w USING (thread_id)),
    cand AS (SELECT surface, ol_key, title, author_name, has_subjects, 1 AS stage FROM surfaces JOIN works ON surface = title
             UNION ALL SELECT surface, ol_key, title, author_name, has_subjects, 2 FROM surfaces JOIN works ON {norm('surface')} = {norm('title')}),
    sc AS (SELECT *, 0.5 * in_ctx::INT + 0.35 + 0.15 * has_subjects::INT AS score FROM (SELECT c.*, EXISTS (SELECT 1 FROM ctx WHERE ctx.surface = c.surface AND writer IN ({norm('author_name')}, string_split({norm('author_name')}, ' ')[-1])) AS in_ctx FROM cand c)),
    rk AS (SELECT *, row_number() OVER g AS k, count(*) OVER (PARTITION BY surface, stage) AS n, lead(score, 1, 0) OVER g AS second FROM sc WINDOW g AS (PARTITION BY surface, stage ORDER BY score DESC, ol_key)),
    best AS (SELECT * FROM rk WHERE k = 1 QUALIFY stage = min(stage) OVER (PARTITION BY surface)),
    res AS (SELECT s.surface, CASE stage WHEN 1 THEN 'exact' WHEN 2 THEN 'normalized' ELSE 'failed' END AS method, ol_key, title AS canonical_title, author_name,
        CAST(CASE WHEN stage IS NULL THEN 0 WHEN n = 1 THEN CASE WHEN in_ctx THEN 1.0 ELSE 0.8 END ELSE round_even(CAST(score AS DOUBLE), 3) END AS DOUBLE) AS confidence,
        coalesce(n > 1 AND score - second < 0.2 AND score < 0.8, false) AS ambiguous FROM surfaces s LEFT JOIN best USING (surface))"""


@query(f"WITH {_CASCADE_SQL} SELECT * FROM res")
def cascade_resolution(spark, d):
    return _cascade(spark, d).drop("notes")


@query(f"WITH {_CASCADE_SQL} SELECT thread_id, text, res.method, res.ol_key, count(*) AS n FROM links LEFT JOIN res ON text = surface GROUP BY ALL")
def entity_links(spark, d):
    rows = resolve.entity_links(ad.links(spark, d).select("thread_id", "text"), _cascade(spark, d))
    return rows.repartition(ad.parts(ad.table(spark, d, "lineitem")), "thread_id", "text").groupBy("thread_id", "text", "method", "ol_key").agg(F.count(F.lit(1)).alias("n"))


def _fuzzy_candidates(spark: SparkSession, d: str) -> DataFrame:
    works = ad.works(spark, d).withColumn("norm_title", tx.norm_title("title"))
    surfaces = ad.surfaces(spark, d).withColumn("norm", tx.norm_title("surface"))
    pairs = catalog.token_candidates(surfaces, catalog.token_index(works))
    return pairs.join(surfaces, "surface").join(works, "ol_key").select("surface", "norm", "ol_key", "title", "norm_title")


@query()
def fuzzy_resolution(spark, d):
    works, surfaces = ad.works(spark, d).withColumn("norm_title", tx.norm_title("title")), ad.surfaces(spark, d).withColumn("norm", tx.norm_title("surface"))
    return resolve.fuzzy_stage(surfaces, resolve.fuzzy_candidates(surfaces, works), resolve.alias_table(spark), works)


@query("""SELECT 'l' || l_orderkey || '-' || l_linenumber AS surface, CASE WHEN score >= 85 THEN 'fuzzy' ELSE 'failed' END AS method, CASE WHEN score >= 85 THEN 'k' || l_partkey END AS ol_key,
    CASE WHEN score >= 85 THEN 't' || l_suppkey END AS canonical_title, round_even(score, 1) AS fuzzy_score, score >= 85 AND score - second < 5 AND score < 90 AS ambiguous,
    CASE WHEN score >= 85 THEN 'score=' || printf('%.1f', score) || ';n_cands=' || l_linenumber ELSE 'below_threshold(85.0)' END AS notes
    FROM (SELECT *, (80 + l_partkey % 20 + l_suppkey % 2 * 0.25)::DOUBLE AS score, (78 + l_partkey % 20 - l_suppkey % 7)::DOUBLE AS second FROM lineitem)""")
def fuzzy_decision(spark, d):
    """What the fuzzy stage decides over given scores."""
    rows = ad.table(spark, d, "lineitem").selectExpr(
        "concat('l', l_orderkey, '-', l_linenumber) AS surface", "concat('k', l_partkey) AS ol_key", "concat('t', l_suppkey) AS title", "CAST(80 + l_partkey % 20 + l_suppkey % 2 * 0.25 AS DOUBLE) AS score",
        "CAST(78 + l_partkey % 20 - l_suppkey % 7 AS DOUBLE) AS second", "l_linenumber AS n",
    )
    return resolve.fuzzy_decision(rows)


@query()
def fuzzy_resolution_fulltext(spark, d):
    """The same with candidates from the stored full-text index."""
    works, surfaces = ad.works(spark, d).withColumn("norm_title", tx.norm_title("title")), ad.surfaces(spark, d).withColumn("norm", tx.norm_title("surface"))
    candidates = resolve.fulltext_candidates(surfaces, catalog.title_index(works), works)
    return resolve.fuzzy_stage(surfaces, candidates, resolve.alias_table(spark), works)


@query()
def canonical_resolution(spark, d):
    works, surfaces = ad.works(spark, d).withColumn("norm_title", tx.norm_title("title")), ad.surfaces(spark, d).withColumn("norm", tx.norm_title("surface"))
    return resolve.canonical_stage(surfaces, _fuzzy_candidates(spark, d), catalog.title_index(works), works)


@query("""WITH a AS (SELECT p_name AS surface, p_brand AS title, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE '/works/' || p_partkey END AS ol_key, (p_partkey % 17) / 20.0 AS score, p_partkey % 3 AS prio, p_partkey AS pos FROM part),
    r AS (SELECT *, row_number() OVER (PARTITION BY surface ORDER BY ol_key IS NULL, score DESC, prio, pos) AS k FROM a) SELECT surface, ol_key, CAST(score AS DOUBLE) AS score, 'source' || prio AS source FROM r WHERE k = 1""")
def priority_merge(spark, d):
    part = ad.table(spark, d, "part")
    columns = ["p_name AS surface", "CAST(NULL AS STRING) AS canonical_title", "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE concat('/works/', p_partkey) END AS ol_key", "CAST((p_partkey % 17) / 20.0 AS DOUBLE) AS score", "p_partkey AS _pos"]
    sources = [part.filter(f"p_partkey % 3 = {i}").selectExpr(*columns, f"'source{i}' AS source") for i in range(3)]
    return resolve.priority_merge(*sources).select("surface", "ol_key", "score", "source")


@query("""WITH r AS (SELECT l_orderkey, l_partkey, min(l_linenumber) AS pos FROM lineitem GROUP BY ALL) SELECT CAST(l_orderkey AS VARCHAR) AS surface, string_agg('/works/' || l_partkey, '|' ORDER BY pos, l_partkey) AS work_keys,
    '{' || string_agg('"/works/' || l_partkey || '":"' || CASE WHEN l_partkey % 9 = 0 THEN '[NOT FOUND]' ELSE p_name END || '"', ',' ORDER BY pos, l_partkey) || '}' AS work_titles FROM r JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""")
def enrich_surfaces(spark, d):
    rows = ad.table(spark, d, "lineitem").selectExpr("CAST(l_orderkey AS STRING) AS surface", "concat('/books/', l_suppkey) AS edition_key", "concat('/works/', l_partkey) AS work_key", "named_struct('a', l_linenumber, 'b', l_partkey) AS _pos")
    titles = ad.table(spark, d, "part").filter("p_partkey % 9 <> 0").selectExpr("concat('/works/', p_partkey) AS work_key", "p_name AS title")
    return resolve.enrich(rows, titles).select("surface", "work_keys", "work_titles")


@query("SELECT '/books/OL' || o_orderkey || 'M' AS edition_key, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '/works/OL' || o_custkey || 'W' END AS work_key_primary FROM orders WHERE o_orderkey % 5 = 0")
def edition_work_map(spark, d):
    from ..sources.files import dump

    raw = ad.table(spark, d, "orders").selectExpr(
        "concat('/type/', CASE WHEN o_orderkey % 4 = 0 THEN 'work' ELSE 'edition' END, '\t/books/OL', o_orderkey, 'M\t1\t2020\t{\"works\":[{\"key\":\"/works/OL', o_custkey, 'W\"}]}') AS value", "o_orderkey AS _pos"
    )
    wanted = ad.table(spark, d, "orders").filter("o_orderkey % 5 = 0").selectExpr("concat('OL', o_orderkey, 'M') AS k").select(tx.with_prefix(F.col("k"), "/books/").alias("edition_key"))
    return catalog.edition_works(dump(raw), wanted).select("edition_key", F.coalesce("work_key_primary", F.lit("")).alias("work_key_primary"))


# Statistics

_RESOLVED_SQL = f"{ad.LINKS_SQL}, ok AS (SELECT * FROM links WHERE method <> 'failed' AND (ol_key IS NOT NULL OR canonical_title IS NOT NULL))"
_BY_KEY_SQL = f"{_RESOLVED_SQL}, c AS (SELECT ol_key, canonical_title, author_name, count(text) AS mentions, count(DISTINCT thread_id) AS threads FROM ok WHERE ol_key IS NOT NULL AND author_name IS NOT NULL GROUP BY ALL)"


def _by_key(spark: SparkSession, d: str) -> DataFrame:
    return stats.by_key(stats.resolved_only(ad.links(spark, d)))


@query(f"""WITH {_RESOLVED_SQL} SELECT canonical_title, author_name, count(text) AS mentions, count(DISTINCT thread_id) AS threads, round_even(avg(confidence), 9) AS avg_confidence,
    arg_min(ol_key, _pos) FILTER (ol_key IS NOT NULL) AS ol_key, round_even(100 * avg(ambiguous::INT), 1) AS ambiguous_pct FROM ok GROUP BY ALL""")
def group_titles(spark, d):
    return stats.by_title(stats.resolved_only(ad.links(spark, d)), "_row")


@query(f"WITH {_BY_KEY_SQL} SELECT *, row_number() OVER (ORDER BY mentions DESC, ol_key, canonical_title, author_name) AS rank FROM c ORDER BY rank LIMIT 100")
def top_raw(spark, d):
    return stats.ranked(_by_key(spark, d), "mentions", 100, "ol_key", "canonical_title", "author_name")


@query(f"""WITH {_BY_KEY_SQL}, a AS (SELECT *, row_number() OVER (ORDER BY mentions DESC, ol_key, canonical_title, author_name) AS rr, row_number() OVER (ORDER BY threads DESC, ol_key, canonical_title, author_name) AS rt FROM c)
    SELECT ol_key, canonical_title, author_name, CASE WHEN rr <= 100 AND rt <= 100 THEN rr - rt END AS shift, CASE WHEN rr <= 100 THEN CAST(rr AS VARCHAR) ELSE '>100' END AS rank_raw, CASE WHEN rt <= 100 THEN CAST(rt AS VARCHAR) ELSE '>100' END AS rank_threads
    FROM a WHERE rr <= 100 OR rt <= 100""")
def rank_shift(spark, d):
    return stats.rank_shift(_by_key(spark, d))


@query(f"WITH {_BY_KEY_SQL} SELECT *, round_even(mentions / CAST(threads AS DOUBLE), 2) AS ratio FROM c WHERE threads >= 5")
def hubness(spark, d):
    return stats.hubness(_by_key(spark, d))


@query(f"""WITH {_BY_KEY_SQL}, n AS (SELECT *, lower(canonical_title) AS norm FROM c), t AS (SELECT norm, canonical_title, sum(threads) AS threads, sum(mentions) AS mentions FROM n GROUP BY ALL),
    au AS (SELECT norm, author_name, sum(mentions) AS k FROM n GROUP BY ALL) SELECT norm, (SELECT canonical_title FROM t x WHERE x.norm = t.norm ORDER BY threads DESC, canonical_title LIMIT 1) AS title,
    CAST(sum(threads) AS BIGINT) AS threads, CAST(sum(mentions) AS BIGINT) AS mentions, (SELECT author_name FROM au WHERE au.norm = t.norm ORDER BY k DESC, author_name LIMIT 1) AS author FROM t GROUP BY norm""")
def group_exact_titles(spark, d):
    return stats.exact_titles(_by_key(spark, d).withColumn("norm", F.lower("canonical_title")))


@query(f"WITH {ad.LINKS_SQL} SELECT method, count(*) AS n, round_even(CAST(100.0 * count(*) / sum(count(*)) OVER () AS DOUBLE), 1) AS pct FROM links GROUP BY method")
def method_shares(spark, d):
    return stats.shares(ad.links(spark, d), "method")


@query("SELECT p_partkey, CASE WHEN p_brand = 'Brand#11' THEN 'Brand#one' WHEN p_brand = 'Brand#12' THEN 'Brand#two' ELSE p_brand END AS p_brand FROM part")
def value_replacement(spark, d):
    return stats.replace_values(ad.table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", spark.createDataFrame([("Brand#11", "Brand#one"), ("Brand#12", "Brand#two")], "old string, new string"))


# Restriction, upserts, incremental


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_resume(spark, d):
    return unprocessed(ad.table(spark, d, "documents").select("doc_id", "lang"), ad.table(spark, d, "labels"), "doc_id")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def semi_restrict(spark, d):
    wanted = ad.table(spark, d, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return ad.table(spark, d, "orders").select("o_orderkey", "o_custkey").join(wanted, "o_orderkey", "left_semi")


@query("SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k = 1")
def last_wins_upsert(spark, d):
    return labels.last_wins(ad.table(spark, d, "events").select("user_id", "event_id", "event_type", "value"), ["user_id"], "event_id").drop("event_id")


@query("SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) WHERE k = 1")
def first_wins_ignore(spark, d):
    return labels.first_wins(ad.table(spark, d, "events").select("user_id", "event_id", "event_type", "value"), ["user_id"], "event_id").drop("event_id")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_counts(spark, d):
    """Beyond the resolution model: event-time windows, as the incremental mode counts them."""
    rows = ad.table(spark, d, "events").select("ts", "event_type")
    return event_counts(rows, "1 hour", "1 day", "event_type").select(F.col("window.start").alias("start"), "event_type", "n")
