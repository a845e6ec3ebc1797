"""Reply trees to conversations: paths by iterated self-joins, ranked, and formatted; DataFrame functions only.

A turn is ``### role: text</turn>`` and a line end. A backslash in a role or text is doubled, and one is put
into each ``###`` and ``</turn>`` (and after the colon of ``: `` in a role), so control strings stand only
where the template writes them; leaving out each first backslash gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxloom.llm.common import stored

HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
LEARNT_ROLE = "assistant"
_MAX_ROUNDS = 48


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.regexp_replace(out, "#(?=##)", r"#\\")
    out = F.replace(out, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(out, F.lit(": "), F.lit(":\\ ")) if role else out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _at(one: DataFrame, other: DataFrame, node: str) -> Column:
    return one["conv"].eqNullSafe(other["conv"]) & (one[node] == other["node"])


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """(conv, node, up, total) for steps of 1, 2, 4, ...: the ancestor so far up, and the scores from the node to below it.

    Each round joins the table with itself, so chains of any length take as many rounds as their length has bits.
    """
    parents = nodes.select(F.col("conv").alias("p_conv"), F.col("node").alias("p_node"))
    found = (F.col("conv").eqNullSafe(F.col("p_conv"))) & (F.col("parent") == F.col("p_node"))
    steps = [stored(nodes.join(parents, found, "left").select("conv", "node", F.col("p_node").alias("up"), F.col("score").alias("total")), "jumps")]
    while steps[-1].filter("up is not null").limit(1).count():
        if len(steps) > _MAX_ROUNDS:
            raise ValueError("replies go round in a circle")
        low = steps[-1]
        high = low.select(F.col("conv").alias("h_conv"), F.col("node").alias("h_node"), F.col("up").alias("h_up"), F.col("total").alias("h_total"))
        # Only nodes that are still below their root go on.
        active = low.filter("up is not null")
        met = active["conv"].eqNullSafe(high["h_conv"]) & (active["up"] == high["h_node"])
        total = (F.col("total") + F.coalesce("h_total", F.lit(0.0))).alias("total")
        further = active.join(high, met, "left").select("conv", "node", F.col("h_up").alias("up"), total)
        steps.append(stored(further.unionByName(low.filter("up is null")), "jumps"))
    return steps


def branch_paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """(conv, leaf, rank, total, node, dist): all nodes from the leaf (dist 0) to the root of each tree's best branches.

    ``nodes`` has (conv, node, parent, score). A leaf has no replies; a branch's score is the sum of its
    nodes', ties go to the smaller leaf. A parent that is null or not there makes a root. A null conv is a
    tree like any other. Circles of replies are an error.
    """
    nodes = nodes.select("conv", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    steps = _jumps(nodes)
    replied = nodes.filter("parent is not null").select(F.col("conv").alias("r_conv"), F.col("parent").alias("r_node")).distinct()
    totals = steps[-1]
    leaves = totals.join(replied, totals["conv"].eqNullSafe(replied["r_conv"]) & (totals["node"] == replied["r_node"]), "left_anti")
    ranked = leaves.withColumn("rank", F.expr("row_number() over (partition by conv order by total desc, node)"))
    paths = ranked.filter(F.col("rank") <= best).select("conv", F.col("node").alias("leaf"), "rank", "total", "node", F.lit(0).cast("bigint").alias("dist"))
    for k in range(len(steps) - 2, -1, -1):
        step = steps[k].filter("up is not null").select(F.col("conv").alias("s_conv"), F.col("node").alias("s_node"), "up")
        met = paths["conv"].eqNullSafe(step["s_conv"]) & (paths["node"] == step["s_node"])
        here, there = F.struct("node", "dist"), F.struct(F.col("up").alias("node"), (F.col("dist") + (1 << k)).alias("dist"))
        both = F.explode(F.array_compact(F.array(here, F.when(F.col("up").isNotNull(), there)))).alias("x")
        paths = paths.join(step, met, "left").select("conv", "leaf", "rank", "total", both).select("conv", "leaf", "rank", "total", "x.node", "x.dist")
    return paths


def format_branches(nodes: DataFrame, best: int = 1, learnt: str = LEARNT_ROLE) -> DataFrame:
    """(conv, leaf, rank, total, n_turns, formatted, loss): one conversation per chosen branch, from the root on.

    ``nodes`` has (conv, node, parent, score, role, text); null roles and texts count as empty. ``loss`` marks
    the texts of role ``learnt``: the turn's number, where the text starts in the turn's own string, where it
    starts in ``formatted``, and its length, in characters. No rows give no rows; other columns are not
    looked at.
    """
    paths = branch_paths(nodes, best)
    texts = nodes.select(
        F.col("conv").alias("t_conv"), F.col("node").alias("t_node"), (F.coalesce("role", F.lit("")) == learnt).alias("own"),
        F.concat(F.lit(HEAD), escape(F.coalesce("role", F.lit("")), True), F.lit(MIDDLE)).alias("head"),
        escape(F.coalesce("text", F.lit(""))).alias("body"),
    )
    met = paths["conv"].eqNullSafe(texts["t_conv"]) & (paths["node"] == texts["t_node"])
    turns = paths.join(texts, met).select("conv", "leaf", "rank", "total", "dist", "own", F.char_length("head").alias("at"), F.char_length("body").alias("length"), F.concat("head", "body", F.lit(END)).alias("piece"))
    window = "over (partition by conv, leaf order by dist desc rows between unbounded preceding and 1 preceding)"
    turns = turns.withColumn("begin", F.expr(f"coalesce(sum(char_length(piece)) {window}, 0)")).withColumn("no", F.expr(f"count(1) {window}"))
    mark = F.struct(F.col("no").alias("turn"), "at", (F.col("begin") + F.col("at")).alias("start"), "length")
    grouped = turns.groupBy("conv", "leaf").agg(
        F.first("rank").alias("rank"), F.first("total").alias("total"), F.count(F.lit(1)).alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("no", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(F.when(F.col("own"), mark))).alias("loss"),
    )
    return grouped.select("conv", "leaf", "rank", "total", "n_turns", F.array_join("pieces.piece", "").alias("formatted"), "loss")


def read_back(formatted: DataFrame) -> DataFrame:
    """Add ``turns`` (role, text) and ``loss_text``, both read from ``formatted`` and ``loss`` alone."""
    cut = formatted.withColumn("_pieces", F.split("formatted", r"\Q</turn>\E\n", -1))
    cut = cut.withColumn("_pieces", F.slice("_pieces", 1, F.size("_pieces") - 1))

    def turn(piece: Column) -> Column:
        own = F.substring(piece, len(HEAD) + 1, 2147483647)
        role = F.substring_index(own, MIDDLE, 1)
        text = F.substring(own, F.char_length(role) + len(MIDDLE) + 1, F.lit(2147483647))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    loss = F.transform("loss", lambda s: unescape(F.substring(F.col("_pieces")[s["turn"].cast("int")], s["at"] + 1, s["length"])))
    return cut.withColumn("turns", F.transform("_pieces", turn)).withColumn("loss_text", F.array_join(loss, "")).drop("_pieces")


def chain_of_turns(conversations: DataFrame) -> DataFrame:
    """(conv, node, parent, score, role, text): rows of (conv_id, turn, role, text) as trees in which each turn answers the one before.

    Turns go by number, then role and text; repeated rows are turns of their own; null numbers come first.
    """
    numbered = conversations.select(
        F.col("conv_id").alias("conv"), F.expr("row_number() over (partition by conv_id order by turn, role, text)").cast("bigint").alias("node"), "role", "text"
    )
    return numbered.select("conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(1.0).alias("score"), "role", "text")
