"""Chat formatting: reply trees to conversations, DataFrame functions only.

A tree is a set of rows (conversation, node, parent). Root-to-leaf paths are
found by iterative self-joins that double the distance climbed in every round
(a chain of n turns takes about log2 n joins): a node first knows its parent,
then its ancestor 2, 4, 8 .. levels up, with the score summed on the way.
Leaves are ranked by the score of their path; the nodes of each chosen path
are then marked by the same jump tables, and the path is formatted.

Template: every turn is ``<s>[INST]role[/INST]text</s>``. Control strings that
stand in a role or text get a backslash after their first character and
backslashes are doubled, so formatted conversations read back to the same
turns. The loss mask lists the stretches of assistant text.

Defined cases: null role or text counts as empty; rows whose parent is null
or does not exist start a path; a null conversation id is a conversation of
its own; equal scores rank by the smaller leaf; rows that repeat a (conversation,
node) are one node (the least role and text). Nodes on a cycle have no root
and are left out. An empty table gives an empty table; only the named columns
are read, so extra columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import materialize

OPEN, MID, CLOSE = "<s>[INST]", "[/INST]", "</s>"
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]"]


def escape(c: Column) -> Column:
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        c = F.replace(c, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
    return c


def unescape(c: Column) -> Column:
    for s in CONTROL:
        c = F.replace(c, F.lit(s[0] + "\\" + s[1:]), F.lit(s))
    return F.replace(c, F.lit("\\\\"), F.lit("\\"))


def chain(rows: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role",
          text: str = "text", score: str | None = None) -> DataFrame:
    """Rows of plain conversations as trees of one branch: the rows of a
    conversation by ``order`` (ties by role and text), each the reply to the
    one before. A window per conversation: its rows end up in one formatted
    text anyway."""
    w = Window.partitionBy("conv").orderBy(F.col("o").asc_nulls_first(), F.col("role").asc_nulls_first(),
                                           F.col("text").asc_nulls_first())
    return (rows.select(F.col(conv).alias("conv"), F.col(order).alias("o"), F.col(role).alias("role"),
                        F.col(text).alias("text"),
                        (F.col(score).cast("double") if score else F.lit(0.0)).alias("score"))
            .withColumn("node", F.row_number().over(w).cast("long"))
            .select("conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                    "role", "text", "score"))


def _climb(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(path score and depth of every node that has a root, jump tables).

    Jump table k has (conv, node, up): ``up`` is 2**k levels above ``node``."""
    base = nodes.select("conv", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = base.select(F.col("conv").alias("pc"), F.col("node").alias("pn"))
    state = (base.join(known, F.col("conv").eqNullSafe(F.col("pc")) & (F.col("parent") == F.col("pn")), "left")
             .select("conv", "node", F.col("pn").alias("up"), F.col("score").alias("total"),
                     F.lit(1).cast("long").alias("depth")))
    state = materialize(state, "climb", "parquet")
    done = state.filter(F.col("up").isNull())
    jumps = []
    n_nodes = base.count()
    while 1 << len(jumps) <= n_nodes:  # no path is longer than that; what still climbs then is a cycle
        going = state.filter(F.col("up").isNotNull())
        if going.isEmpty():
            break
        jumps.append(going.select("conv", "node", "up"))
        above = state.select(F.col("conv").alias("c2"), F.col("node").alias("n2"), F.col("up").alias("up2"),
                             F.col("total").alias("t2"), F.col("depth").alias("d2"))
        if len(jumps) > 1:  # what stands above may have come to its root in an earlier round
            above = above.unionByName(rooted.select(
                F.col("conv").alias("c2"), F.col("node").alias("n2"), F.col("up").alias("up2"),
                F.col("total").alias("t2"), F.col("depth").alias("d2")))
        rooted = done
        state = materialize(
            going.join(above, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("up") == F.col("n2")))
            .select("conv", "node", F.col("up2").alias("up"), (F.col("total") + F.col("t2")).alias("total"),
                    (F.col("depth") + F.col("d2")).alias("depth")), "climb", "parquet")
        done = done.unionByName(state.filter(F.col("up").isNull()))
    return done.select("conv", "node", "total", "depth"), jumps


def best_paths(trees: DataFrame, branches: int | None = 1) -> DataFrame:
    """(conv, leaf, rank, pos, role, text): the nodes of the ``branches`` best
    paths of every conversation (None: of all), pos 1 at the root.

    ``trees`` has conv, node (long), parent (long or null), role, text, score."""
    nodes = materialize(
        trees.groupBy("conv", "node").agg(
            F.min(F.struct("parent", "score", "role", "text")).alias("v")).select("conv", "node", "v.*"),
        "nodes", "parquet")
    rooted, jumps = _climb(nodes)
    parents = nodes.select(F.col("conv").alias("pc"), F.col("parent").alias("pn")).distinct()
    leaves = rooted.join(parents, F.col("conv").eqNullSafe(F.col("pc")) & (F.col("node") == F.col("pn")), "left_anti")
    if branches == 1:  # an aggregate combines before the shuffle
        chosen = (leaves.groupBy("conv").agg(F.max(F.struct("total", (-F.col("node")).alias("node"))).alias("v"))
                  .select("conv", (-F.col("v.node")).alias("leaf"), F.lit(1).alias("rank")))
    else:
        w = Window.partitionBy("conv").orderBy(F.desc("total"), "node")
        chosen = leaves.select("conv", F.col("node").alias("leaf"), F.row_number().over(w).alias("rank"))
        if branches is not None:
            chosen = chosen.filter(F.col("rank") <= branches)
    on_path = chosen.select("conv", "leaf", "rank", F.col("leaf").alias("node"))
    for j in jumps:
        up = j.select(F.col("conv").alias("c2"), F.col("node").alias("n2"), "up")
        on_path = materialize(on_path.unionByName(
            on_path.join(up, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("node") == F.col("n2")))
            .select("conv", "leaf", "rank", F.col("up").alias("node"))), "paths", "parquet")
    full = nodes.select(F.col("conv").alias("c3"), F.col("node").alias("n3"), "role", "text")
    depth = rooted.select(F.col("conv").alias("c4"), F.col("node").alias("n4"), F.col("depth").alias("pos"))
    return (on_path.join(full, F.col("conv").eqNullSafe(F.col("c3")) & (F.col("node") == F.col("n3")))
            .join(depth, F.col("conv").eqNullSafe(F.col("c4")) & (F.col("node") == F.col("n4")))
            .select("conv", "leaf", "rank", "pos", "role", "text"))


def format_paths(paths: DataFrame) -> DataFrame:
    """(conv, leaf, rank, formatted, loss_mask): one row per path.

    ``loss_mask`` lists the assistant texts in order as (turn, at, start,
    length): ``start`` counts code points from the front of ``formatted``,
    ``at`` from the front of the turn; ``turn`` is 0 for the first."""
    w = Window.partitionBy("conv", "leaf", "rank").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    parts = (paths.select("conv", "leaf", "rank", "pos", (F.coalesce("role", F.lit("")) == "assistant").alias("loss"),
                          escape(F.col("role")).alias("r"), escape(F.col("text")).alias("t"))
             .withColumn("head", F.concat(F.lit(OPEN), "r", F.lit(MID)))
             .withColumn("turn_text", F.concat("head", "t", F.lit(CLOSE)))
             .withColumn("before", F.coalesce(F.sum(F.length("turn_text")).over(w), F.lit(0))))
    turn = F.struct("pos", "turn_text", "loss", (F.col("pos") - 1).cast("int").alias("turn"),
                    F.length("head").alias("at"), (F.col("before") + F.length("head")).alias("start"),
                    F.length("t").alias("length"))
    return (parts.groupBy("conv", "leaf", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
            .select("conv", "leaf", "rank",
                    F.array_join(F.transform("turns", lambda x: x["turn_text"]), "").alias("formatted"),
                    F.transform(F.filter("turns", lambda x: x["loss"]),
                                lambda x: F.struct(x["turn"].alias("turn"), x["at"].alias("at"),
                                                   x["start"].alias("start"), x["length"].alias("length"))
                                ).alias("loss_mask")))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as (role, text), unescaped."""
    whole = F.split(formatted, "</s>")
    return F.transform(
        F.slice(whole, F.lit(1), F.size(whole) - 1),
        lambda x: F.struct(
            unescape(F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), MID, 1)).alias("role"),
            unescape(F.substr(x, F.length(F.substring_index(x, MID, 1)) + len(MID) + 1)).alias("text")))


def read_loss(formatted: Column, loss_mask: Column) -> Column:
    """The texts under the loss mask, unescaped and in order."""
    whole = F.split(formatted, "</s>")
    return F.transform(loss_mask, lambda m: unescape(F.substr(F.get(whole, m["turn"]), m["at"] + 1, m["length"])))
