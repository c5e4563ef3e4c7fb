"""Reading order of comment trees of any size: Euler tours, ranked by pointer doubling.

A walk through a tree enters and leaves every comment once; what comes after each of these
steps follows from first replies and next siblings alone. Doubling the reach of every step's pointer
again and again sums up how many comments are still to be entered, and so gives every place and
depth in as many joins as the walk's length has binary digits. No task holds a thread, a parent's
replies, or a path; every pointer has a target of its own, so no key of these joins is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import bare_id
from ..sources.stored import discard, stored
from .ranking import placed


def _siblings(comments: DataFrame) -> DataFrame:
    """(no, thread_id, id, parent_no, first, next_no): numbered comments with their parent, whether they are its first reply, and the reply after them.

    Numbers run through each parent's replies in their order; a null parent is the thread itself, whose orphans come last.
    """
    rows = comments.select("thread_id", "id", bare_id(F.col("parent_id")).alias("above"), "created_utc", "_pos")
    ids = rows.select("thread_id", F.col("id").alias("above"), F.lit(True).alias("known")).distinct()
    top = F.col("above") == F.col("thread_id")
    under = rows.filter(F.coalesce(~top, F.lit(True))).join(ids, ["thread_id", "above"], "left")
    orphan = F.col("known").isNull()
    under = under.select("thread_id", F.when(~orphan, F.col("above")).alias("parent"), orphan.alias("orphan"), F.when(~orphan, F.col("created_utc")).alias("created"), "_pos", "id")
    tops = rows.filter(top).select("thread_id", F.lit(None).cast("string").alias("parent"), F.lit(False).alias("orphan"), F.col("created_utc").alias("created"), "_pos", "id")
    order = ["thread_id", F.asc_nulls_first("parent"), "orphan", F.asc_nulls_first("created"), "_pos", "id"]
    numbered = stored(placed(tops.unionByName(under), *order, distinct=True, place="no").select("no", "thread_id", "id", "parent"), "siblings")
    group = F.struct("thread_id", "parent")
    behind = numbered.select((F.col("no") - 1).alias("no"), group.alias("next_group"))
    ahead = numbered.select((F.col("no") + 1).alias("no"), group.alias("last_group"))
    linked = numbered.join(behind, "no", "left").join(ahead, "no", "left").select(
        "no", "thread_id", "id", "parent", (~group.eqNullSafe(F.col("last_group"))).alias("first"), F.when(group.eqNullSafe(F.col("next_group")), F.col("no") + 1).alias("next_no")
    )
    parents = numbered.select("thread_id", F.col("id").alias("parent"), F.col("no").alias("parent_no"))
    return linked.join(parents, ["thread_id", "parent"], "left")


def _ranked(steps: DataFrame) -> DataFrame:
    """(e, places, depths): sums from each step to its list's end; steps of lists without an end (cycles) are left out."""
    current, done = stored(steps, "steps"), -1
    while True:
        found = current.filter("next IS NULL").count()
        if found == done or current.filter("next IS NOT NULL").isEmpty():
            return current.filter("next IS NULL")
        done = found
        target = current.select(F.col("e").alias("next"), F.col("next").alias("then"), F.col("places").alias("p"), F.col("depths").alias("d"))
        doubled = current.filter("next IS NOT NULL").join(target, "next").select("e", F.col("then").alias("next"), (F.col("places") + F.col("p")).alias("places"), (F.col("depths") + F.col("d")).alias("depths"))
        former, current = current, stored(current.filter("next IS NULL").unionByName(doubled), "steps")
        discard(former)


def ranked_order(comments: DataFrame) -> DataFrame:
    """(thread_id, id, depth, place) of every reachable comment, as ``threads.comment_order`` defines them, for threads of any size.

    Ids are unique within a thread. An empty table stays empty; comments in a cycle, and those under it, go.
    """
    nodes = stored(_siblings(comments), "nodes")
    firsts = nodes.filter("first AND parent_no IS NOT NULL").select(F.col("parent_no").alias("no"), F.col("no").alias("first_no"))
    # step 2n enters comment n, step 2n + 1 leaves it
    enter = nodes.join(firsts, "no", "left").select((F.col("no") * 2).alias("e"), F.coalesce(F.col("first_no") * 2, F.col("no") * 2 + 1).alias("next"), F.lit(1).cast("long").alias("places"), F.lit(1).cast("long").alias("depths"))
    leave = nodes.select((F.col("no") * 2 + 1).alias("e"), F.coalesce(F.col("next_no") * 2, F.col("parent_no") * 2 + 1).alias("next"), F.lit(0).cast("long").alias("places"), F.lit(-1).cast("long").alias("depths"))
    ranked = _ranked(enter.unionByName(leave)).filter("e % 2 = 0").select(F.shiftright("e", 1).alias("no"), "places", "depths")
    reached = nodes.select("no", "thread_id", "id").join(ranked, "no")
    totals = reached.groupBy("thread_id").agg(F.max("places").alias("total"))
    return reached.join(totals, "thread_id").select("thread_id", "id", (1 - F.col("depths")).cast("int").alias("depth"), (F.col("total") - F.col("places")).cast("int").alias("place"))
