"""Thread reconstruction: pruning, comment trees, segments, metadata, rendering."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SETTINGS
from ..functions.text import bare_id, clean_text, epoch_date, is_removed
from ..sources.stored import stored
from .stats import round_even
from .trees import ranked_order

#: A thread of more comments is no single task.
GROUP_COMMENTS = 1 << 20
#: The fields that pruning keeps.
SUBMISSION_FIELDS = (
    "id", "name", "permalink", "url", "title", "selftext", "is_self", "domain", "author", "distinguished", "stickied",
    "removed_by_category", "score", "upvote_ratio", "num_comments", "created_utc", "link_flair_text",
)
COMMENT_FIELDS = (
    "id", "name", "link_id", "parent_id", "permalink", "body", "author", "is_submitter", "distinguished", "stickied",
    "score", "controversiality", "created_utc", "edited",
)
RULE = "─" * 60


def record_kind(json: Column) -> Column:
    """submission, comment or null, by the keys that a record has."""
    keys = F.json_object_keys(json)
    return F.when(F.array_contains(keys, "title"), "submission").when(F.array_contains(keys, "body"), "comment")


def prune(rows: DataFrame, fields: tuple[str, ...], text: str) -> DataFrame:
    """The fields of a kind of record, with a flag for removed text."""
    return rows.select(*(c for c in fields if c in rows.columns), is_removed(F.col(text)).alias("_removed"))


def prune_totals(rows: DataFrame, *by: str) -> DataFrame:
    """Totals of pruned rows: all, kept, removed (and their percentage) and bad ones, whose flag is null."""
    gone, bad, n = F.count_if("_removed"), F.count_if(F.col("_removed").isNull()), F.count(F.lit(1))
    return rows.groupBy(*by).agg(n.alias("total"), (n - gone - bad).alias("kept"), gone.alias("removed"), round_even(F.try_divide(100.0 * gone, n), 2).alias("removed_pct"), bad.alias("bad"))


def fast_accept(lines: DataFrame, communities: list[str], value: str = "value") -> DataFrame:
    """Raw lines with status accepted, rejected or bad, and their month.

    Lines that hold no community's name anywhere are rejected before they are parsed.
    """
    low = F.lower(F.col(value))
    probe = F.lit(False)
    for name in communities:
        probe = probe | F.contains(low, F.lit(name.lower()))
    parsed = F.from_json(value, "subreddit string, created_utc string")
    stamp = parsed["created_utc"].try_cast("bigint")
    status = (
        F.when(~probe, "rejected").when(parsed.isNull() | stamp.isNull() | parsed["subreddit"].isNull(), "bad")
        .when(F.lower(parsed["subreddit"]).isin(*(c.lower() for c in communities)), "accepted").otherwise("rejected")
    )
    return lines.withColumn("status", status).withColumn("ym", F.date_format(F.timestamp_seconds(stamp), "yyyy-MM"))


def comment_order(comments: DataFrame) -> DataFrame:
    """Depth and depth-first place of every reachable comment of its thread.

    ``comments`` has thread_id, id, parent_id, created_utc and _pos. Replies follow their parent
    by (created_utc, _pos); orphans come after all rooted trees, at depth 1, with their replies;
    cycles are not reachable and go. A thread is one group, walked without recursion, unless it has more
    than ``GROUP_COMMENTS``: those are ranked by joins, whatever their size.
    """
    large = comments.groupBy("thread_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP_COMMENTS).select("thread_id")
    if large.isEmpty():
        return _walked(comments)
    large = stored(large, "large-threads")  # at most one for each GROUP_COMMENTS rows
    return _walked(comments.join(large, "thread_id", "left_anti")).unionByName(ranked_order(comments.join(large, "thread_id", "left_semi")))


def _walked(comments: DataFrame) -> DataFrame:

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["created_utc", "_pos"], kind="stable", na_position="first")
        ids, thread = set(pdf["id"]), pdf["thread_id"].iloc[0]
        parent = pdf["parent_id"].str.replace(r"^[^_]*_", "", regex=True)
        children: dict[str, list[int]] = {}
        for row, (own, above) in enumerate(zip(pdf["id"], parent)):
            children.setdefault(above, []).append(row)
        orphans = [r for above, rows in children.items() if above != thread and above not in ids for r in rows]
        stack = [(r, 1) for r in sorted(orphans, key=lambda r: pdf["_pos"].iloc[r], reverse=True)]
        stack += [(r, 1) for r in reversed(children.get(thread, []))]
        id_of, order, depth, seen = pdf["id"].tolist(), [], [], set()
        while stack:
            row, level = stack.pop()
            if row in seen:
                continue
            seen.add(row)
            order.append(row)
            depth.append(level)
            stack += [(r, level + 1) for r in reversed(children.get(id_of[row], []))]
        return pd.DataFrame({"thread_id": thread, "id": [id_of[r] for r in order], "depth": pd.array(depth, "int32"), "place": pd.array(range(len(order)), "int32")})

    narrow = comments.select("thread_id", "id", "parent_id", "created_utc", "_pos")
    return narrow.groupBy("thread_id").applyInPandas(walk, "thread_id string, id string, depth int, place int")


def comment_order_sql(comments: DataFrame, levels: int = 1000) -> DataFrame:
    """The same by a recursive query; a cross-check for threads of bounded depth."""
    spark = comments.sparkSession
    comments.select("thread_id", "id", bare_id(F.col("parent_id")).alias("above"), "created_utc", "_pos").createOrReplaceTempView("_comment_links")
    return spark.sql(f"""
        WITH RECURSIVE tree(thread_id, id, depth, path) MAX RECURSION LEVEL {levels} AS (
            SELECT c.thread_id, c.id, 1, array(named_struct('o', CASE WHEN c.above = c.thread_id THEN 0 ELSE 1 END, 'k', CASE WHEN c.above = c.thread_id THEN c.created_utc ELSE 0 END, 't', c._pos))
            FROM _comment_links c LEFT ANTI JOIN _comment_links p ON p.thread_id = c.thread_id AND p.id = c.above
            UNION ALL
            SELECT c.thread_id, c.id, t.depth + 1, concat(t.path, array(named_struct('o', 0, 'k', c.created_utc, 't', c._pos)))
            FROM tree t JOIN _comment_links c ON c.thread_id = t.thread_id AND c.above = t.id
        )
        SELECT thread_id, id, depth, CAST(row_number() OVER (PARTITION BY thread_id ORDER BY path) - 1 AS INT) AS place FROM tree
    """)


def segments(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """Title, body and comments of every thread in reading order.

    ``submissions`` has id, title, selftext, is_self, author, score, created_utc, _removed;
    ``comments`` the columns of ``comment_order`` and body, author, score, is_submitter, distinguished, _removed.
    """
    head = submissions.select(F.col("id").alias("thread_id"), F.coalesce("is_self", F.lit(False)).alias("is_self"), "title", "selftext", "author", "score", "created_utc", "_removed")
    common = ["thread_id", "seg_no", "id", "type", "author", "depth", "score", "created_utc", "is_removed", "is_submitter", "distinguished", "text"]
    none = F.lit(None).cast("string")
    title = head.select(
        "thread_id", F.lit(0).alias("seg_no"), F.col("thread_id").alias("id"), F.lit("title").alias("type"), "author", F.lit(0).alias("depth"), "score", "created_utc",
        F.lit(False).alias("is_removed"), F.lit(True).alias("is_submitter"), none.alias("distinguished"), clean_text(F.col("title")).alias("text"),
    )
    body = head.filter("is_self").select(
        "thread_id", F.lit(1).alias("seg_no"), F.col("thread_id").alias("id"), F.lit("body").alias("type"), "author", F.lit(0).alias("depth"), "score", "created_utc",
        F.col("_removed").alias("is_removed"), F.lit(True).alias("is_submitter"), none.alias("distinguished"), clean_text(F.col("selftext")).alias("text"),
    )
    placed = comments.join(comment_order(comments), ["thread_id", "id"]).join(head.select("thread_id", "is_self"), "thread_id")
    rest = placed.select(
        "thread_id", (F.col("place") + F.when(F.col("is_self"), 2).otherwise(1)).cast("int").alias("seg_no"), "id", F.lit("comment").alias("type"), "author", "depth", "score", "created_utc",
        F.col("_removed").alias("is_removed"), "is_submitter", "distinguished", clean_text(F.col("body")).alias("text"),
    )
    return title.select(common).unionByName(body.select(common)).unionByName(rest.select(common))


def thread_metadata(submissions: DataFrame, segs: DataFrame) -> DataFrame:
    """One row per submission: its fields and what its segments add up to."""
    found = segs.filter("type = 'comment'").groupBy("thread_id").agg(
        F.count(F.lit(1)).alias("num_comments_found"), F.max("depth").alias("depth_max"), F.max("created_utc").alias("last"),
    )
    return submissions.withColumnRenamed("id", "thread_id").join(found, "thread_id", "left").select(
        "thread_id", clean_text(F.col("title")).alias("title"), "author", "score", epoch_date(F.col("created_utc")).alias("date"), "link_flair_text",
        F.coalesce("num_comments_found", F.lit(0)).alias("num_comments_found"), F.coalesce("depth_max", F.lit(0)).alias("depth_max"), epoch_date(F.col("last")).alias("date_last_comment"),
    )


def _field(rows: DataFrame, name: str, kind: str, default=None) -> Column:
    """A field of the rows as a type, with a default for null and for rows that lack the column."""
    found = F.col(name).cast(kind) if name in rows.columns else F.lit(None).cast(kind)
    return found if default is None else F.coalesce(found, F.lit(default))


#: The fields of a thread document's segments and metadata, with their types and defaults.
SEGMENT = (
    ("id", "string", None), ("type", "string", None), ("author", "string", ""), ("depth", "int", None), ("score", "bigint", None), ("created_utc", "bigint", None), ("edited", "string", "false"),
    ("is_removed", "boolean", False), ("is_submitter", "boolean", False), ("distinguished", "string", None), ("stickied", "boolean", False), ("parent_id", "string", None), ("text", "string", ""),
)
METADATA = (
    ("title", "string", ""), ("author", "string", ""), ("date", "string", None), ("created_utc", "bigint", None), ("edited", "string", "false"), ("score", "bigint", None), ("upvote_ratio", "double", None),
    ("flair", "string", None), ("url", "string", ""), ("permalink", "string", ""), ("domain", "string", ""), ("is_self", "boolean", False), ("distinguished", "string", None), ("stickied", "boolean", False),
    ("removed_by_category", "string", None), ("is_removed", "boolean", False), ("num_comments_reported", "bigint", 0), ("num_comments_found", "bigint", 0), ("depth_max", "int", 0), ("date_last_comment", "string", None),
)


def document_segments(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """thread_id, seg_no and the thirteen fields of each segment: title, body of text posts, comments in reading order.

    Inputs as for ``segments``; edited, stickied and a submission's distinguished may be absent. ``edited`` is "false" or
    when it was, as text. A title and a body have ids of their own and share the submission's flags.
    """
    post = submissions.withColumnsRenamed({"id": "thread_id", "_removed": "is_removed"}).withColumns({"is_submitter": F.lit(True), "depth": F.lit(0), "parent_id": F.lit(None).cast("string")})
    own = F.col("thread_id")
    title = post.withColumns({"seg_no": F.lit(0), "id": F.concat(own, F.lit("_title")), "type": F.lit("title"), "text": clean_text(F.col("title"))})
    body = post.filter("is_self").withColumns({"seg_no": F.lit(1), "id": F.concat(own, F.lit("_body")), "type": F.lit("body"), "text": clean_text(F.col("selftext"))})
    heads = submissions.select(F.col("id").alias("thread_id"), F.when(F.coalesce("is_self", F.lit(False)), 2).otherwise(1).alias("_first"))
    placed = comments.join(comment_order(comments), ["thread_id", "id"]).join(heads, "thread_id").withColumnRenamed("_removed", "is_removed")
    rest = placed.withColumns({"seg_no": F.col("place") + F.col("_first"), "type": F.lit("comment"), "text": clean_text(F.col("body"))})
    parts = [p.select("thread_id", F.col("seg_no").cast("int").alias("seg_no"), *(_field(p, *f).alias(f[0]) for f in SEGMENT)) for p in (title, body, rest)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def document_metadata(submissions: DataFrame, segs: DataFrame) -> DataFrame:
    """thread_id and the twenty fields of a thread document: the submission's own, and what its segments add up to.

    The title is as posted. A comment without a time, or of time 0, does not count for the last comment's date.
    """
    found = segs.filter("type = 'comment'").groupBy("thread_id").agg(
        F.count(F.lit(1)).alias("num_comments_found"), F.max("depth").alias("depth_max"), F.max(F.when(F.col("created_utc") != 0, F.col("created_utc"))).alias("_last"),
    )
    named = submissions.withColumnsRenamed({"id": "thread_id", "_removed": "is_removed", "link_flair_text": "flair", "num_comments": "num_comments_reported"})
    named = named.drop("num_comments_found", "depth_max", "date", "date_last_comment").join(found, "thread_id", "left")
    named = named.withColumns({"date": epoch_date(F.col("created_utc")), "date_last_comment": epoch_date(F.col("_last"))})
    return named.select("thread_id", *(_field(named, *f).alias(f[0]) for f in METADATA))


def render(segs: DataFrame, meta: DataFrame, indent: int = 2, max_depth: int = SETTINGS.render_depth) -> DataFrame:
    """Readable threads: header, body, indented comments, footer."""
    pad = F.repeat(F.lit(" "), F.least("depth", F.lit(max_depth)) * indent)
    tags = F.concat(F.when(F.col("is_submitter"), " [OP]").otherwise(""), F.when(F.col("distinguished") == "moderator", " [MOD]").otherwise(""), F.when(F.coalesce("score", F.lit(0)) != 0, F.concat(F.lit(" +"), F.col("score"))).otherwise(""))
    comment = F.concat(pad, F.lit("[u/"), "author", tags, F.lit("]\n"), pad, "text", F.lit("\n"))
    piece = F.when(F.col("type") == "body", F.concat("text", F.lit("\n\n" + RULE))).otherwise(comment)
    shown = segs.filter("text <> '' AND type <> 'title'").withColumn("piece", piece)
    body = shown.groupBy("thread_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_no", "piece"))), lambda s: s["piece"]), "\n").alias("middle"))
    flair = F.when(F.coalesce("link_flair_text", F.lit("")) != "", F.concat(F.lit("  [flair: "), "link_flair_text", F.lit("]"))).otherwise("")
    head = F.concat(F.lit("[THREAD] "), "title", flair, F.lit("\n[DATE] "), F.coalesce("date", F.lit("")), F.lit("  [AUTHOR] u/"), "author", F.lit("  [SCORE] "), F.col("score").cast("string"), F.lit("\n"))
    foot = F.concat(F.lit(RULE + "\n[THREAD END] "), "thread_id", F.lit(" | "), F.col("num_comments_found").cast("string"), F.lit(" comments | "), F.coalesce("date", F.lit("")), F.lit(": "), F.coalesce("date_last_comment", F.lit("?")))
    return meta.join(body, "thread_id", "left").select("thread_id", F.concat_ws("\n", head, "middle", foot).alias("document"))


def render_task(segs: DataFrame, indent: str = "→ ", max_depth: int | None = None) -> DataFrame:
    """Threads as one text to annotate, a blank line between segments."""
    level = F.greatest(F.col("depth") - 1, F.lit(0))
    who = F.coalesce(F.when(F.col("author") != "", F.col("author")), F.lit("unknown"))
    prefix = F.when(F.col("type") == "title", "[TITLE]").when(F.col("type") == "body", F.concat(F.lit("[POST by u/"), who, F.lit("]"))).otherwise(F.concat(F.lit("["), F.repeat(F.lit("→ "), level), F.lit("u/"), who, F.lit("]")))
    shown = segs.filter("text <> ''")
    shown = shown if max_depth is None else shown.filter(F.col("depth") <= max_depth)
    line = F.concat(F.repeat(F.lit(indent), level), prefix, F.lit(" "), F.col("text"))
    return shown.withColumn("line", line).groupBy("thread_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_no", "line"))), lambda s: s["line"]), "\n\n").alias("document"))


def segment_tasks(segs: DataFrame) -> DataFrame:
    """Segments worth annotating, one task each."""
    return segs.filter("text <> '' AND NOT is_removed").select("thread_id", "seg_no", "id", "type", "author", "depth", "text")


def enough_comments(submissions: DataFrame, comments: DataFrame, least: int) -> DataFrame:
    """Submissions not removed with at least ``least`` comments of any link prefix."""
    counts = comments.groupBy(bare_id(F.col("link_id")).alias("id")).agg(F.count(F.lit(1)).alias("n_comments"))
    return submissions.filter("NOT _removed").join(counts, "id", "left").withColumn("n_comments", F.coalesce("n_comments", F.lit(0))).filter(F.col("n_comments") >= least)
