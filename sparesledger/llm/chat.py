"""Chat formatting of reply trees, in DataFrame functions only.

Messages of a tree point at the message they answer. Self-joins by pointer doubling give every
message the sum of scores up to its root (round k looks 2**k replies up), so the number of joins
follows the logarithm of the longest thread; only ids and scores take part. Leaves are ranked by
that score, the chosen ones walk the stored rounds back to list their path, and the texts meet
the paths once.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n`` a turn. In texts and roles every ``<|``,
also one that has backslashes inside (``<\\|``), gets one more backslash, so no text holds a
control string and reading takes the backslash off again; in roles, line breaks and backslashes
are escaped as well, as a role ends at its line's end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.regexp_replace(F.regexp_replace(role, r"\\", r"\\\\"), "\n", r"\\n"))


def unescape_role(role: Column) -> Column:
    """Backslash pairs become one, a backslash and ``n`` a line break; pairs are taken from the left."""
    parts = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.regexp_replace(p, r"\\n", "\n")), "\\")


def replies(rows: DataFrame, tree_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Linear conversations as reply trees: each turn answers the one before it.

    Null turns come first; rows that share a turn are one message of several texts.
    """
    tree = Window.partitionBy("tree").orderBy("turn")
    rows = rows.select(F.col(f"`{tree_col}`").alias("tree"), F.col(f"`{turn_col}`").alias("turn"),
                       F.col(f"`{role_col}`").alias("role"), F.col(f"`{text_col}`").alias("text"))
    at = F.dense_rank().over(tree).cast("long")
    return rows.select(F.col("tree").alias(tree_col), at.alias("id"), F.when(at > 1, at - 1).alias("parent"), "role", "text",
                       F.lit(0.0).alias("score"))


def _node(tree: str, name: str) -> Column:
    """A message's name that is never null and tells a null tree from any other."""
    return F.struct(F.col(tree).isNull().alias("no"), F.coalesce(F.col(tree).cast("string"), F.lit("")).alias("tree"),
                    F.col(name).cast("string").alias("id"))


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Round k: every node with the node 2**k replies above it (``up``, null beyond the root),
    and the ``total`` of scores on the way, its own included."""
    nodes = stored(nodes, "reply-rounds")
    most = max(1, nodes.count()).bit_length()  # more doublings than any thread without a ring needs
    rounds = [nodes]
    for _ in range(most):
        if rounds[-1].filter("up IS NOT NULL").isEmpty():
            break
        below, above = rounds[-1].filter("up IS NOT NULL").alias("c"), rounds[-1].alias("p")
        doubled = below.join(above, F.col("c.up") == F.col("p.node")).select(
            "c.node", "p.up", (F.col("c.total") + F.col("p.total")).alias("total"))
        rounds.append(stored(doubled.unionByName(rounds[-1].filter("up IS NULL")), "reply-rounds"))
    return rounds


def paths(messages: DataFrame, tree_col: str, best: int | None = 1) -> DataFrame:
    """Root-to-leaf paths: (tree, leaf, rank, score, node, above), one row per message of a path,
    ``above`` counting the messages below it down to the leaf.

    A path's score is the sum of its messages' scores (null counts 0); the ``best`` highest of a
    tree are kept (None: all), ties by the leaf's id. A message whose parent is not in its tree
    is a root. Rows that repeat an id are one message (smallest parent, largest score).
    Messages whose parents form a ring have no root and lie on no path.
    """
    seen = messages.select(_node(tree_col, "id").alias("node"), F.when(F.col("parent").isNotNull(), _node(tree_col, "parent")).alias("up"),
                           "score", F.col(tree_col).alias("tree"))
    nodes = seen.groupBy("node").agg(F.min("up").alias("up"), F.coalesce(F.max("score").cast("double"), F.lit(0.0)).alias("total"),
                                     F.first("tree").alias("tree"))
    nodes = stored(nodes, "reply-nodes")
    known = nodes.select(F.col("node").alias("up"), F.lit(True).alias("there"))
    linked = nodes.filter("up IS NOT NULL").join(known, "up", "left")
    first = linked.select("node", F.when(F.col("there"), F.col("up")).alias("up"), "total")
    first = first.unionByName(nodes.filter("up IS NULL").select("node", "up", "total"))
    rounds = _rounds(first)
    inner = rounds[0].filter("up IS NOT NULL").select(F.col("up").alias("node")).distinct()
    ends = rounds[-1].filter("up IS NULL").join(inner, "node", "left_anti").join(nodes.select("node", "tree"), "node")
    ends = ends.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "node")))
    if best is not None:
        ends = ends.filter(F.col("rank") <= best)
    walk = stored(ends.select("tree", F.col("node").alias("leaf"), "rank", F.col("total").alias("score"), "node", F.lit(0).cast("long").alias("above")),
                  "reply-paths")
    for k, table in enumerate(rounds[:-1]):
        jump = table.filter("up IS NOT NULL").select("node", "up")
        further = walk.join(jump, "node").select("tree", "leaf", "rank", "score", F.col("up").alias("node"), (F.col("above") + (1 << k)).alias("above"))
        walk = stored(walk.unionByName(further), "reply-paths")
    return walk


def format_paths(messages: DataFrame, tree_col: str, best: int | None = 1) -> DataFrame:
    """One row per chosen path (see ``paths``): tree, leaf, rank, score, formatted, loss_spans.

    ``messages`` has the tree's column, id, parent, role, text and score. ``loss_spans`` are the
    (start, length) in UTF-8 bytes of ``formatted`` that are learned: the escaped texts of
    assistant turns. Null roles and texts count as empty. Texts that share an id follow each
    other by role, then text. A null tree is a tree like any other. An empty table gives an
    empty result.
    """
    messages = stored(messages.select(tree_col, "id", "parent", "role", "text", "score"), "messages")
    walk = paths(messages, tree_col, best)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = messages.select(_node(tree_col, "id").alias("node"), role.alias("role"), text.alias("text"),
                           F.concat(F.lit(START), escape_role(role), F.lit("\n")).alias("head"), escape(text).alias("body"))
    turns = walk.join(said, "node")
    path = Window.partitionBy("leaf").orderBy(F.desc("above"), "role", "text")
    size = (F.octet_length("head") + F.octet_length("body") + len(END)).cast("long")
    before = F.coalesce(F.sum(size).over(path.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turns = turns.select("tree", "leaf", "rank", "score", F.row_number().over(path).alias("at"),
                         F.concat("head", "body", F.lit(END)).alias("turn"),
                         F.when(F.col("role") == LEARNED, F.struct((before + F.octet_length("head")).alias("start"),
                                                                   F.octet_length("body").cast("long").alias("length"))).alias("span"))
    whole = turns.groupBy("leaf").agg(F.first("tree").alias("tree"), F.first("rank").alias("rank"), F.first("score").alias("score"),
                                      F.sort_array(F.collect_list(F.struct("at", "turn", "span"))).alias("turns"))
    return whole.select(F.col("tree").alias(tree_col), F.col("leaf.id").alias("leaf"), "rank", "score",
                        F.array_join("turns.turn", "").alias("formatted"), F.array_compact("turns.span").alias("loss_spans"))


def read_turns(formatted: str) -> Column:
    """The (role, text) turns of a formatted conversation, as they were before it."""
    parts = F.split(F.col(formatted), r"<\|im_end\|>\n")

    def turn(part: Column) -> Column:
        line = F.instr(part, "\n")
        role = F.substring(part, len(START) + 1, 2**31 - 1)
        return F.struct(unescape_role(F.substring_index(role, "\n", 1)).alias("role"),
                        unescape(part.substr(line + 1, F.length(part))).alias("text"))

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def read_loss(formatted: str, spans: str) -> Column:
    """All text under the mask, unescaped, nothing between."""
    raw = F.col(formatted).cast("binary")
    return F.array_join(F.transform(F.col(spans), lambda s: unescape(raw.substr((s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"))), "")
