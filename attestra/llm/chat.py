"""Chat formatting of reply trees (operator 5), DataFrame functions only.

Iterative self-joins with doubling steps walk the trees: after k rounds every node knows its ancestor 2^k steps up, the score of the way
there and its length, so the deepest tree takes log2(depth) joins. The best leaves of every tree are kept, and the same jump tables, read
from the longest to the shortest, list the nodes of each kept path without carrying texts through the rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestra.llm.common import query, stored, table

OPEN, CLOSE = "<turn ", "</turn>\n"


def escape(text: Column) -> Column:
    r"""Backslash becomes ``\b`` and the bracket of a control string ``\l``: no control string is left inside a text."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\b")), r"<(?=/?turn)", r"\\l")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role stands on one line and ends at the bracket."""
    return F.replace(F.replace(escape(role), F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\g"), F.lit(">")))


def best_paths(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """Root-to-leaf paths of every tree, ranked by mean score; the best ``per_tree`` of each.

    nodes: tree, node, parent, score (unique by tree and node). A parent that is no row makes its child a root; nodes on a cycle or
    below one hang from no root and are on no path. Null scores count 0; ties go to the smaller leaf. Returns tree, leaf, rank, node, place (0 at the root).
    """
    ids = nodes.select("tree", "node").alias("p")
    linked = nodes.alias("c").join(ids, (F.col("c.tree") == F.col("p.tree")) & (F.col("c.parent") == F.col("p.node")), "left").select(
        "c.tree", "c.node", F.col("p.node").alias("up"), F.coalesce("c.score", F.lit(0.0)).cast("double").alias("score"), F.lit(1).cast("long").alias("length"))
    full, hops = stored(linked, "chat-jump"), []
    n = full.count()
    while True:
        active = full.filter("up is not null")  # nodes deep enough for another step; the others have reached their root
        if (1 << len(hops)) > 2 * max(n, 1) or not active.limit(1).count():  # beyond 2n steps only cycles are left
            break
        hops.append(active.select("tree", "node", "up"))
        moved = active.alias("a").join(full.alias("b"), (F.col("a.tree") == F.col("b.tree")) & (F.col("a.up") == F.col("b.node"))).select(
            "a.tree", "a.node", F.col("b.up").alias("up"), (F.col("a.score") + F.col("b.score")).alias("score"), (F.col("a.length") + F.col("b.length")).alias("length"))
        full = stored(full.filter("up is null").unionByName(moved), "chat-jump")
    parents = linked.filter("up is not null").select("tree", F.col("up").alias("node")).distinct()
    leaves = full.filter("up is null").join(parents, ["tree", "node"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy((F.col("score") / F.col("length")).desc(), "node"))
    chosen = leaves.withColumn("rank", rank).filter(F.col("rank") <= per_tree)
    paths = chosen.select("tree", F.col("node").alias("leaf"), "rank", "node", (F.col("length") - 1).alias("place"))
    for k in range(len(hops) - 1, -1, -1):  # every listed node adds the one 2^k steps up, so a path of n nodes takes log2(n) joins
        added = paths.join(hops[k], ["tree", "node"]).select("tree", "leaf", "rank", F.col("up").alias("node"), (F.col("place") - (1 << k)).alias("place"))
        paths = stored(paths.unionByName(added), "chat-path")
    return paths


def format_trees(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """Each chosen path as one conversation: tree, leaf, rank, formatted, loss (array of start and length in code points, assistant texts).

    nodes: tree, node, parent, role, text, score; other columns are not read. Null text and role count as empty; a repeated node keeps its
    least row. The whole text of a path stands in one row, as a conversation must. An empty table gives none.
    """
    nodes = nodes.select("tree", "node", "parent", "score", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    nodes = nodes.groupBy("tree", "node").agg(F.min(F.struct("parent", "role", "text", "score")).alias("x")).select("tree", "node", "x.*")
    nodes = stored(nodes, "chat-nodes")
    paths = best_paths(nodes.select("tree", "node", "parent", "score"), per_tree)
    head, body = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(">\n")), escape(F.col("text"))
    turns = paths.join(nodes, ["tree", "node"]).select("tree", "leaf", "rank", "place", F.concat(head, body, F.lit(CLOSE)).alias("piece"),
                                                       F.length(head).alias("lead"), F.length(body).alias("size"), (F.col("role") == "assistant").alias("learned"))
    before = Window.partitionBy("tree", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.col("lead"))
    whole = turns.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(F.struct("place", "piece", "start", "size", "learned"))).alias("t"))
    return whole.select("tree", "leaf", "rank", F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
                        F.transform(F.filter("t", lambda x: x["learned"]), lambda x: F.struct(x["start"].alias("start"), x["size"].cast("long").alias("length"))).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns and the learned texts as they stand in the output: adds turns (array of role and text) and loss_text."""
    pieces = F.slice(F.split("formatted", CLOSE, -1), 1, F.greatest(F.size(F.split("formatted", CLOSE, -1)) - 1, F.lit(0)))
    turn = lambda p: F.struct(unescape_role(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), ">\n", 1)).alias("role"),
                              unescape(F.substr(p, F.instr(p, F.lit(">\n")) + 2)).alias("text"))
    said = F.array_join(F.transform("loss", lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return formatted.withColumn("turns", F.transform(pieces, turn)).withColumn("loss_text", said)


def chains(conversations: DataFrame) -> DataFrame:
    """Conversations as reply trees: every row answers the row before it by turn; repeated turns are rows of their own, null ids one conversation."""
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return conversations.select("conv_id", "turn", "role", "text").withColumn("node", number).select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("tree"), "node", (F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


#: A user's and an assistant's text that hold a foreign header, a closing mark and a backslash.
PLANTED = "\\### Assistant: </turn> ok"


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn >') + length(role) + 1 + length(replace(text, '\', '\b')) + len(regexp_extract_all(text, '</?turn')) + length('</turn>') + 1)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""


@query("op5_reply_trees", ORACLE)
def op5_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.sql("select * from values (-7L, 0L, 'user', :t), (-7L, 1L, 'assistant', :t) as v(conv_id, turn, role, text)", args={"t": PLANTED})
    done = read_back(format_trees(chains(rows.unionByName(extra))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(F.when(F.col("tree") != "null", F.col("tree")).cast("long").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(turns, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
