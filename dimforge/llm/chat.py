"""Chat formatting of reply trees.

Messages form trees: every message names its parent.  Iterative self-joins
with doubling steps (ancestors 1, 2, 4, ... above) enumerate the messages of
every root-to-leaf path in ``log2(depth)`` rounds, each written to the shared
folder; only ids take part, the texts are joined once at the end.  Branches
are ranked by score (mean message score, then the smaller leaf id) and the
chosen paths are formatted, each as one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  Inside roles
and texts ``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|`` (and a line feed
in a role ``&#10;``), so no text can contain a mark and the escape is
reversible.  The loss mask is the list of character spans (start, length) of
the escaped assistant texts.

Defined results: NULL text or role is empty; a parent that does not exist
makes its child a root; messages on a parent cycle belong to no root and are
dropped by definition of a root-to-leaf path; repeated rows are separate
turns; an empty table gives an empty result.  A path must fit one row, as it
becomes one formatted text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.storage import materialize

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"


def escape(s):
    return F.replace(F.replace(s, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(s):
    return F.replace(F.replace(s, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(s):
    return F.replace(escape(s), F.lit("\n"), F.lit("&#10;"))


def unescape_role(s):
    return unescape(F.replace(s, F.lit("&#10;"), F.lit("\n")))


def chains(rows: DataFrame, *, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Flat conversations as reply trees: each row's parent is the row before
    it (by turn, then role and text, so ties have a defined order)."""
    w = Window.partitionBy(conv).orderBy(F.col(turn).asc_nulls_first(), F.col(role).asc_nulls_first(),
                                         F.col(text).asc_nulls_first())
    n = F.row_number().over(w).cast("long")
    return rows.select(F.col(conv).alias("conv_id"), n.alias("node"),
                       F.when(n > 1, n - 1).alias("parent"), F.col(role).alias("role"), F.col(text).alias("text"),
                       F.lit(0.0).alias("score"))


def paths(messages: DataFrame) -> DataFrame:
    """Root-to-leaf paths of ``(conv_id, node, parent, score)`` rows:
    ``conv_id, leaf, node, up`` (distance above the leaf), one row per message
    on the path."""
    m = messages.select("conv_id", "node", "parent")
    ids = m.select(F.col("conv_id").alias("pc"), F.col("node").alias("pn"))
    # a parent that is not there counts as none
    up = materialize(m.join(ids, m["conv_id"].eqNullSafe(ids["pc"]) & (m["parent"] == ids["pn"]), "left")
                      .select("conv_id", "node", F.col("pn").alias("above")), "chat-up")
    parents = up.where("above is not null").select(F.col("conv_id").alias("pc"), F.col("above").alias("pn")).distinct()
    leaves = up.join(parents, up["conv_id"].eqNullSafe(parents["pc"]) & (up["node"] == parents["pn"]), "left_anti")
    reach = leaves.select("conv_id", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    hop = 1
    while True:
        a = up.where("above is not null").select(F.col("conv_id").alias("ac"), F.col("node").alias("an"), "above")
        more = (reach.join(a, reach["conv_id"].eqNullSafe(a["ac"]) & (reach["node"] == a["an"]))
                     .select("conv_id", "leaf", F.col("above").alias("node"), (F.col("up") + hop).alias("up")))
        reach = materialize(reach.unionByName(more), "chat-reach")
        b = a.select(F.col("ac").alias("bc"), F.col("an").alias("bn"), F.col("above").alias("top"))
        up = materialize(a.join(b, a["ac"].eqNullSafe(b["bc"]) & (a["above"] == b["bn"]))
                          .select(F.col("ac").alias("conv_id"), F.col("an").alias("node"), F.col("top").alias("above")),
                         "chat-up")
        hop *= 2
        # leaves reach no cycle, so the doubling of their paths ends
        a = up.select(F.col("conv_id").alias("ac"), F.col("node").alias("an"))
        if reach.join(a, reach["conv_id"].eqNullSafe(a["ac"]) & (reach["node"] == a["an"]), "left_semi").isEmpty():
            return reach


def format_trees(messages: DataFrame, *, best: int | None = None) -> DataFrame:
    """One row per chosen path: ``conv_id, leaf, rank, n_turns, formatted,
    loss_spans``.  ``best`` keeps that many branches of each conversation
    (None: all)."""
    reach = paths(messages)
    keyed = messages.select(F.col("conv_id").alias("kc"), F.col("node").alias("kn"), "role", "text", "score")
    here = F.col("conv_id").eqNullSafe(F.col("kc")) & (F.col("node") == F.col("kn"))
    # branches are ranked on ids and scores; texts are joined to the chosen ones only
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("path_score").desc_nulls_last(), "leaf"))
    chosen = (reach.join(keyed.select("kc", "kn", "score"), here).groupBy("conv_id", "leaf").agg(F.avg("score").alias("path_score"))
                   .select(F.col("conv_id").alias("bc"), F.col("leaf").alias("bl"), rank.cast("long").alias("rank")))
    if best is not None:
        chosen = chosen.where(F.col("rank") <= best)
    full = (reach.join(chosen, F.col("conv_id").eqNullSafe(F.col("bc")) & (F.col("leaf") == F.col("bl")))
                 .select("conv_id", "leaf", "node", "up", "rank").join(keyed.drop("score"), here))
    role = escape_role(F.coalesce("role", F.lit("")))
    text = escape(F.coalesce("text", F.lit("")))
    turn = F.struct((-F.col("up")).alias("at"), F.concat(F.lit(START), role, F.lit("\n")).alias("head"),
                    text.alias("body"), (F.col("role") == LEARNED).alias("learn"))
    per = full.groupBy("conv_id", "leaf", "rank").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    tail = f"{END}\n"
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(tail))), "")
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,len:bigint>>)").alias("spans"))

    def add(acc, t):
        start = acc["at"] + F.length(t["head"])
        span = F.struct(start.cast("long").alias("start"), F.length(t["body"]).cast("long").alias("len"))
        return F.struct((start + F.length(t["body"]) + len(tail)).cast("long").alias("at"),
                        F.when(t["learn"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return per.select("conv_id", "leaf", "rank", F.size("turns").cast("long").alias("n_turns"),
                      body.alias("formatted"), F.aggregate("turns", zero, add)["spans"].alias("loss_spans"))


def parse(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: ``turns`` (array of role, text,
    unescaped) and ``learned`` (the unescaped texts under the loss mask)."""
    parts = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda s: F.length(s) > 0)

    turns = F.transform(parts, lambda s: F.struct(
        unescape_role(F.substring_index(s, "\n", 1)).alias("role"),
        unescape(F.regexp_replace(F.regexp_replace(s, r"^[^\n]*\n", ""), r"<\|im_end\|>\n\z", "")).alias("text")))
    learned = F.transform("loss_spans", lambda x: unescape(F.substring(
        F.col("formatted"), x["start"] + 1, x["len"])))
    return formatted.select("*", turns.alias("turns"), learned.alias("learned"))
