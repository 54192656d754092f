"""Chat formatting of reply trees, in DataFrame operations only.

Messages form trees by parent.  Iterative self-joins double the reach of
every message's ancestor pointer, so paths of length n take log2(n) joins;
on the way each message gets the number of messages and the score sum of its
root path.  Leaves are ranked per tree by path score; the chosen paths are
listed from the doubled pointers (every ancestor exactly once) and each
becomes one formatted conversation with its loss mask.

Template, per turn: ``<turn:ROLE>\\nTEXT</turn>\\n``.  Inside a text, ``<turn``
and ``</turn`` get a backslash after ``<`` (one more if some are there
already); in a role ``% < > \\n`` are percent-encoded.  Both are undone by
``parse``.  The mask is a list of character spans of the formatted string
that hold the (escaped) assistant texts.

Defined cases: a null text or role is empty; a message whose parent is null,
unknown or itself is a root; messages that reach no root (a cycle) are on no
path; equal path scores rank by leaf id; a null tree id is a tree like any other.
Message ids are unique within a tree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage

ASSISTANT = "assistant"
ESCAPE = (r"<(\\*)(/?turn)", r"<$1\\$2")
UNESCAPE = (r"<(\\*)\\(/?turn)", r"<$1$2")
ROLE_CODES = (("%", "%25"), ("<", "%3C"), (">", "%3E"), ("\n", "%0A"))


def escape_text(c):
    return F.regexp_replace(c, F.lit(ESCAPE[0]), F.lit(ESCAPE[1]))


def unescape_text(c):
    return F.regexp_replace(c, F.lit(UNESCAPE[0]), F.lit(UNESCAPE[1]))


def escape_role(c):
    for plain, code in ROLE_CODES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape_role(c):
    for plain, code in reversed(ROLE_CODES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def turns_as_tree(turns: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """Rows by turn as messages: each turn replies to the one before it (in the
    order of turn, role, text; every row scores 1)."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = turns.select(F.col(f"`{tree}`").alias("tree"), F.col(f"`{turn}`").alias("turn"),
                        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("msg", F.row_number().over(order).cast("long"))
    return rows.select("tree", "msg", F.when(F.col("msg") > 1, F.col("msg") - 1).alias("parent"), "role", "text",
                       F.lit(1.0).alias("score"))


def _on(tree: str, node: str, left: DataFrame, right: DataFrame):
    return left["tree"].eqNullSafe(right[tree]) & (left[node] == right["at"])


def root_paths(messages: DataFrame):
    """State of every message (pointer, messages and score on its root path), and the
    pointer tables of 1, 2, 4 ... steps up.  A tree of at most 2^k messages is
    complete after k joins and takes no part in the later ones."""
    ids = messages.select(F.col("tree").alias("t"), F.col("msg").alias("at"))
    sizes = messages.groupBy(F.col("tree").alias("s")).agg(F.count(F.lit(1)).alias("size"))
    known = messages.join(ids, messages["tree"].eqNullSafe(ids["t"]) & (messages["parent"] == ids["at"]), "left")
    known = known.join(sizes, messages["tree"].eqNullSafe(sizes["s"]))
    state = cut_lineage(known.select(
        "tree", "msg", F.when(F.col("at") != F.col("msg"), F.col("at")).alias("up"), F.lit(1).cast("long").alias("depth"),
        F.coalesce("score", F.lit(0.0)).alias("total"), "size"))
    largest = state.agg(F.max("size")).first()[0] or 1
    steps, complete = [], []
    for k in range(int(largest - 1).bit_length()):
        complete.append(state.filter(F.col("size") <= 1 << k))
        state = state.filter(F.col("size") > 1 << k)
        steps.append(state.filter("up is not null").select("tree", "msg", "up"))
        above = state.select(F.col("tree").alias("t"), F.col("msg").alias("at"), F.col("up").alias("up2"),
                             F.col("depth").alias("d2"), F.col("total").alias("s2"))
        state = cut_lineage(state.join(above, state["tree"].eqNullSafe(above["t"]) & (state["up"] == above["at"]), "left")
                            .select("tree", "msg", F.col("up2").alias("up"),
                                    (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"),
                                    (F.col("total") + F.coalesce("s2", F.lit(0.0))).alias("total"), "size"))
    return reduce(DataFrame.unionByName, complete, state), steps


def chosen_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """(tree, leaf, rank, msg, up): the ``best`` root-to-leaf paths of each tree by
    score, a row for each message, ``up`` steps above the leaf."""
    messages = cut_lineage(messages)
    state, steps = root_paths(messages)
    parents = messages.filter("parent is not null and parent <> msg").select(
        F.col("tree").alias("t"), F.col("parent").alias("at")).distinct()
    leaves = state.filter("up is null").join(
        parents, state["tree"].eqNullSafe(parents["t"]) & (state["msg"] == parents["at"]), "left_anti")
    # two steps, so that a tree with very many leaves is ranked by many tasks first
    salt = F.pmod(F.xxhash64("msg"), F.lit(64))
    order = [F.desc("total"), F.asc("msg")]
    first = Window.partitionBy("tree", "salt").orderBy(*order)
    ranked = leaves.withColumn("salt", salt).withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= best)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(*order))).filter(
        F.col("rank") <= best)
    ends = cut_lineage(ranked.select("tree", F.col("msg").alias("leaf"), "rank", "msg", F.lit(0).cast("long").alias("up"),
                                     "depth"))
    path = ends.filter(F.col("depth") > 1 << len(steps)).drop("depth")          # none: no path is that long
    for k in reversed(range(len(steps))):
        # paths of more than 2^k messages have one that far up; shorter ones come in later
        path = path.unionByName(ends.filter(F.col("depth").between((1 << k) + 1, 2 << k)).drop("depth"))
        step = steps[k].select(F.col("tree").alias("t"), F.col("msg").alias("at"), F.col("up").alias("above"))
        both = path.join(step, path["tree"].eqNullSafe(step["t"]) & (path["msg"] == step["at"]), "left")
        places = F.array(F.struct("msg", "up"),
                         F.struct(F.col("above").alias("msg"), (F.col("up") + (1 << k)).alias("up")))
        path = both.select("tree", "leaf", "rank", F.explode(places).alias("p")).select(
            "tree", "leaf", "rank", "p.*").filter("msg is not null")
    return path.unionByName(ends.filter(F.col("depth") <= 1).drop("depth"))


def format_paths(messages: DataFrame, best: int = 1, loss_role: str = ASSISTANT) -> DataFrame:
    """(tree, leaf, rank, formatted, loss_spans): each chosen path as one
    conversation, spans [start, end) in characters."""
    messages = cut_lineage(messages)
    path = chosen_paths(messages, best)
    texts = messages.select(F.col("tree").alias("t"), F.col("msg").alias("at"),
                            *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    head = F.concat(F.lit("<turn:"), escape_role(F.col("role")), F.lit(">\n"))
    body = escape_text(F.col("text"))
    rows = path.join(texts, path["tree"].eqNullSafe(texts["t"]) & (path["msg"] == texts["at"])).select(
        "tree", "leaf", "rank", "up", F.concat(head, body, F.lit("</turn>\n")).alias("turn"),
        F.length(head).alias("head"), F.length(body).alias("body"), (F.col("role") == loss_role).alias("loss"))
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("begin", F.coalesce(F.sum(F.length("turn").cast("long")).over(before), F.lit(0))
                           + F.col("head"))
    turn = F.struct(F.negative("up").alias("nth"), "turn", "loss", F.col("begin").alias("start"),
                    (F.col("begin") + F.col("body")).alias("end"))
    whole = rows.groupBy("tree", "leaf").agg(F.first("rank").alias("rank"), F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = F.transform(F.filter("turns", lambda x: x["loss"]),
                        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return whole.select("tree", "leaf", "rank", F.array_join(F.transform("turns", lambda x: x["turn"]), "").alias("formatted"),
                        spans.alias("loss_spans"))


def parse(formatted: DataFrame) -> DataFrame:
    """Adds what the formatted string says: ``turns`` (role, text) and
    ``loss_texts``, both unescaped."""
    raw = F.filter(F.split("formatted", "</turn>\n", -1), lambda x: x != "")

    def turn(x):
        # the header ends at the first '>', which a role can't hold
        end = F.instr(x, ">")
        return F.struct(unescape_role(F.substr(x, F.lit(7), end - 7)).alias("role"),
                        unescape_text(F.substr(x, end + 2)).alias("text"))

    loss = F.transform("loss_spans", lambda s: unescape_text(F.substr(
        F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.withColumn("turns", F.transform(raw, turn)).withColumn("loss_texts", loss)
