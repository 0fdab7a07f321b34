"""Chat formatting of reply trees, in DataFrame operations alone.

A message has a tree, an id, the id of the message it answers, a score, a role
and a text. Self-joins that double their step (parents, parents of parents, and
so on) give tables of ancestors 1, 2, 4, ... levels up; taken from the widest
step down they list every message of every root-to-leaf path once, in a number
of joins that grows with the logarithm of the depth. Only ids and scores go
through them. Branches are ranked by mean score, the best are kept, and each
becomes one conversation.

Template: ``<s>role``, a line break, the text, ``</s>``. Control strings inside
roles and texts (see ``CONTROL``) are broken by a backslash behind their first
character, one more if backslashes are there already, so they can be put back.
The loss mask is a list of spans (code points) of assistant texts in the output.

Null roles and texts are empty. A message whose parent is missing is a root.
Messages on or under a cycle are on no path and are left out, as are messages
without an id. Of rows that repeat an id in a tree, one stays: the least by parent,
score, role and text, nulls first. Rows without a tree id form one tree. Ties between branches go to the
smaller leaf id. An empty table gives no conversations; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import keep

# The strings that a reader of the format acts on.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_TAILS = r"(/?s>|</?SYS>>|/?INST\])"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(<|\[)(\\*)" + _TAILS, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(<|\[)\\(\\*)" + _TAILS, r"$1$2$3")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def chained(rows: DataFrame, tree: str, turn: str, role: str = "role", text: str = "text") -> DataFrame:
    """Plain conversations as trees: each row answers the one before it (equal turns by role and text)."""
    order = Window.partitionBy(tree).orderBy(turn, role, text)
    numbered = rows.select(
        tree, F.row_number().over(order).cast("bigint").alias("node"), F.lit(0.0).alias("score"), role, text
    )
    return numbered.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def root_paths(messages: DataFrame) -> DataFrame:
    """``tree, leaf, node, up`` of every message on each root-to-leaf path; ``up`` is 0 at the leaf."""
    nodes = keep(messages.select("tree", "node", "parent"))
    known = nodes.select("tree", F.col("node").alias("up"))
    step = nodes.select("tree", "node", F.col("parent").alias("up")).join(known, ["tree", "up"], "left_semi")
    limit, steps = nodes.count(), []
    while True:
        step = keep(step)
        if not step.take(1):
            lost = None
            break
        steps.append(step)
        if 1 << (len(steps) - 1) > limit:  # an ancestor that far up is on a cycle
            lost = step.select("tree", "node")
            break
        above = step.select("tree", F.col("node").alias("up"), F.col("up").alias("top"))
        step = step.join(above, ["tree", "up"]).select("tree", "node", F.col("top").alias("up"))
    answered = steps[0].select("tree", F.col("up").alias("node")) if steps else None
    leaves = nodes.join(answered, ["tree", "node"], "left_anti") if steps else nodes
    leaves = leaves.join(lost, ["tree", "node"], "left_anti") if lost is not None else leaves
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("up"))
    for k in reversed(range(len(steps))):
        further = steps[k].select("tree", "node", F.col("up").alias("top"))
        above = paths.join(further, ["tree", "node"])
        paths = keep(paths.unionAll(above.select("tree", "leaf", F.col("top").alias("node"), F.col("up") + (1 << k))))
    return paths


def one_of_each(rows: DataFrame) -> DataFrame:
    """One row of each tree and node, the least; rows without a node go. Copies are combined before the shuffle.

    A tree's name follows from its key, so it is the same in all copies.
    """
    least = F.min(F.struct("parent", "score", "role", "text", "name")).alias("least")
    found = rows.filter(F.col("node").isNotNull()).groupBy("tree", "node").agg(least)
    return found.select("tree", "least.name", "node", "least.parent", "least.score", "least.role", "least.text")


def format_trees(
    messages: DataFrame, tree: str, branches: int | None = None, unique: bool = False
) -> DataFrame:
    """One row per chosen path: the tree id, ``leaf, branch`` (rank), ``formatted`` and ``loss_spans``.

    ``messages`` has ``node, parent, score, role, text`` beside the tree id;
    ``branches`` is the number of paths kept of each tree, all if not given. ``unique``
    says that no id repeats in its tree, as in ``chained`` rows, which saves a shuffle.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("")).alias("tree")
    rows = messages.select(
        key,
        F.col(tree).alias("name"),
        "node",
        "parent",
        "score",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    if not unique:
        rows = one_of_each(rows)
    paths = root_paths(rows).join(rows.select("tree", "node", "score"), ["tree", "node"])
    leaves = paths.groupBy("tree", "leaf").agg(F.avg("score").alias("mean"))
    best = Window.partitionBy("tree").orderBy(F.col("mean").desc_nulls_last(), "leaf")
    ranked = leaves.withColumn("branch", F.row_number().over(best))
    chosen = ranked.filter(F.col("branch") <= branches) if branches is not None else ranked
    head = F.concat(F.lit("<s>"), escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    learned = F.col("role") == ASSISTANT
    turns = rows.select("tree", "name", "node", learned.alias("learned"), head.alias("head"), body.alias("body"))
    chosen = chosen.select("tree", "leaf", "branch")
    placed = paths.drop("score").join(chosen, ["tree", "leaf"]).join(turns, ["tree", "node"])
    size = F.length("head") + F.length("body") + 4
    before = Window.partitionBy("tree", "leaf").orderBy(F.col("up").desc()).rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head")
    span = F.struct(at.alias("start"), F.length("body").cast("bigint").alias("length"))
    parts = placed.select(
        "tree", "name", "leaf", "branch",
        F.struct(
            (-F.col("up")).alias("place"),
            F.concat("head", "body", F.lit("</s>")).alias("turn"),
            F.when(F.col("learned"), span).alias("span"),
        ).alias("part"),
    )
    ordered = F.sort_array(F.collect_list("part"))
    whole = parts.groupBy("tree", "leaf", "branch").agg(F.first("name").alias(tree), ordered.alias("parts"))
    return whole.select(
        tree,
        "leaf",
        "branch",
        F.array_join(F.col("parts.turn"), "").alias("formatted"),
        F.filter("parts.span", lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """Roles and texts of a formatted conversation, in order."""
    turns = F.split(formatted, "</s>")
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)
    return F.transform(
        turns,
        lambda t: F.struct(
            unescaped_role(F.substring_index(F.substr(t, F.lit(4)), "\n", 1)).alias("role"),
            unescaped(F.substr(t, F.locate("\n", t) + 1)).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""

    def learned(span: Column) -> Column:
        return unescaped(F.substr(formatted, (span["start"] + 1).cast("int"), span["length"].cast("int")))

    return F.array_join(F.transform(spans, learned), "")
