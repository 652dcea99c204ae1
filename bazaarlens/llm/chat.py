"""Chat formatting of reply trees, with Spark's own functions only.

A message points to the one it answers. Self-joins double every message's pointer
towards the root, adding up depth and score on the way, so the number of joins is the
logarithm of the longest path. Branches are ranked by score per tree; for the chosen
leaves the same pointers, taken from near to far, list all messages of the path. Each
path is formatted as one conversation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import table
from bazaarlens.operators.scratch import stored

# The marks of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
# Escapes, in the order in which they are applied: afterwards neither a mark nor, in
# a role, a line end is left, and undoing them in reverse order gives the text back.
_ESCAPES = [("%", "%25"), ("<|", "%3C|")]
_ROLE_ESCAPES = [*_ESCAPES, ("\n", "%0A")]


def escaped(text: Column, role: bool = False) -> Column:
    for plain, coded in _ROLE_ESCAPES if role else _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescaped(text: Column, role: bool = False) -> Column:
    for plain, coded in reversed(_ROLE_ESCAPES if role else _ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _pointers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Per power of two the ancestors so far above, and each message's way to its root.

    Messages on a cycle, or hanging below one, have no root and are left out.
    """
    ids = nodes.select(F.col("node").alias("parent"))
    known = nodes.select("node", "parent", F.coalesce("score", F.lit(0.0)).alias("total"))
    # a parent that is not there makes a root
    state = stored(
        known.join(ids.withColumn("there", F.lit(True)), "parent", "left").select(
            "node",
            F.when(F.col("there"), F.col("parent")).alias("up"),
            F.lit(1).cast("long").alias("depth"),
            "total",
        )
    )
    levels = []
    # messages that have reached their root take no further part
    ended, open_ = [state.where("up IS NULL")], state.where("up IS NOT NULL")
    before = None
    while True:
        still = open_.count()
        # what no longer becomes less, after more steps than there are messages left,
        # runs in circles
        if still == 0 or (still == before and 2 ** len(levels) > still):
            ways = reduce(DataFrame.unionByName, ended)
            return levels, ways.select("node", "depth", "total")
        before = still
        levels.append(open_.select("node", "up"))
        above = reduce(DataFrame.unionByName, [*ended, open_]).select(
            F.col("node").alias("up"),
            F.col("up").alias("up_up"),
            F.col("depth").alias("depth_up"),
            F.col("total").alias("total_up"),
        )
        state = stored(
            open_.join(above, "up").select(
                "node",
                F.col("up_up").alias("up"),
                (F.col("depth") + F.col("depth_up")).alias("depth"),
                (F.col("total") + F.col("total_up")).alias("total"),
            )
        )
        ended.append(state.where("up IS NULL"))
        open_ = state.where("up IS NOT NULL")


def best_paths(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """The messages of each tree's ``keep`` best root-to-leaf paths.

    ``nodes``: tree, node (unique), parent, score. Returns tree, leaf, node, place
    (1 at the root). Paths are ranked by the sum of their scores, then by length,
    then by leaf; a null score counts 0, an unknown parent makes a root.
    """
    levels, ways = _pointers(nodes)
    parents = nodes.where("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct()
    leaves = ways.join(parents, "node", "left_anti").join(nodes.select("node", "tree"), "node")
    order = Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("depth"), "node")
    chosen = stored(
        leaves.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= keep)
        .select("tree", F.col("node").alias("leaf"), "depth")
    )
    parts = [chosen.select("tree", "leaf", F.col("leaf").alias("node"), F.col("depth").alias("place"))]
    for k, level in enumerate(levels):
        so_far = reduce(DataFrame.unionByName, parts)
        farther = so_far.join(level, "node").select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("place") - 2**k).alias("place")
        )
        parts.append(stored(farther))
    return reduce(DataFrame.unionByName, parts)


def format_trees(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """Each chosen path as one conversation: tree, leaf, turns, formatted, loss_spans.

    ``nodes``: tree, node (unique, not null), parent, role, text, score; more columns
    are ignored. ``loss_spans`` are the places, in code points, of the assistant's
    texts in ``formatted``. Null roles and texts are empty; a null tree is one tree;
    no nodes give no rows.
    """
    said = nodes.select(
        "node",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    paths = best_paths(nodes, keep).join(said, "node")
    turns = F.transform(
        F.array_sort(F.collect_list(F.struct("place", "role", "text"))),
        lambda t: F.struct(
            escaped(t["role"], role=True).alias("role"), escaped(t["text"]).alias("text")
        ),
    )
    gathered = paths.groupBy("tree", "leaf").agg(turns.alias("coded"))

    def place(so_far: Column, t: Column) -> Column:
        begin = so_far["at"] + F.length(t["role"]) + (len(START) + 1)
        end = begin + F.length(t["text"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        out = F.when(t["role"] == ASSISTANT, F.concat(so_far["out"], span)).otherwise(so_far["out"])
        return F.struct((end + len(END)).alias("at"), out.alias("out"))

    nothing = F.array().cast("array<struct<start:int,end:int>>")
    return gathered.select(
        "tree",
        "leaf",
        F.array_join(
            F.transform(
                "coded",
                lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END)),
            ),
            "",
        ).alias("formatted"),
        F.aggregate(
            "coded",
            F.struct(F.lit(0).alias("at"), nothing.alias("out")),
            place,
            lambda x: x["out"],
        ).alias("loss_spans"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted conversation."""

    def read(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        text = F.substring(
            block, F.length(role) + 2, F.length(block) - F.length(role) - (1 + len(END))
        )
        return F.struct(unescaped(role, role=True).alias("role"), unescaped(text).alias("text"))

    blocks = F.split(formatted, r"<\|im_start\|>", -1)
    return F.transform(F.slice(blocks, 2, F.greatest(F.size(blocks) - 1, F.lit(0))), read)


def chains(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as trees without branches, by turn.

    Equal turns follow each other by role and text, null turns come first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select(
        F.col("conv_id").alias("tree"), "role", "text", F.row_number().over(order).alias("n")
    )
    name = F.coalesce(F.col("tree").cast("string"), F.lit("null"))
    return numbered.select(
        "tree",
        F.concat_ws(":", name, F.col("n").cast("string")).alias("node"),
        F.when(F.col("n") > 1, F.concat_ws(":", name, (F.col("n") - 1).cast("string"))).alias("parent"),
        "role",
        "text",
        F.lit(1.0).alias("score"),
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted form."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # The conversation whose texts hold the template's own marks.
    marks = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame(
        [(-1, 0, "user", marks), (-1, 1, ASSISTANT, marks)],
        "conv_id long, turn long, role string, text string",
    )
    nodes = stored(chains(given.unionByName(extra)))
    done = stored(format_trees(nodes))
    loss = F.array_join(
        F.transform(
            "loss_spans",
            lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])),
        ),
        "",
    )
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return done.select(
        F.col("tree").alias("conv_id"),
        turns_of(F.col("formatted")).alias("turns"),
        loss.alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
