"""Chat formatting of reply trees: every chosen root-to-leaf path is one conversation.

Messages form trees by their parents. Iterative self-joins double the reach of
each message's ancestor link, round by round, until all reach their root; on the
way they add up scores and depths, so the branches of a tree (its leaves) are
ranked by score. The same links, taken from the longest to the shortest,
enumerate the messages of each chosen path. A turn is escaped and marked before
the path's turns are put together. DataFrame functions only.

Every join is on a message number: a long conversation spreads over all tasks
until its turns are put together, since the formatted conversation is one value.

Null text and null role count as empty. A parent that is null, missing or the
message itself makes a root. Rows that repeat an id are messages of their own;
replies hang below the first of them in the order of role and text. Null scores
count as 0; equal scores rank by the leaf's number. A cycle of parents has no
root and raises ValueError. Empty input gives no rows. Only the named columns
are read, so others may have any names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terroir.llm.common import written
from terroir.llm.order import numbered


@dataclass(frozen=True)
class Template:
    """Marks of a turn: `turn` role `body` text `end_body` `end`."""

    turn: str = "<s>"
    body: str = "[INST]"
    end_body: str = "[/INST]"
    end: str = "</s>"
    answers: str = "assistant"  # the role whose text the loss covers

    def __post_init__(self):
        firsts = {m[0] for m in self.marks}
        if any(len(m) < 2 or "\\" in m or firsts & set(m[1:]) for m in self.marks) or len(set(self.marks)) < 4:
            raise ValueError("marks must differ, hold no backslash and none of the marks' first characters after the first")

    @property
    def marks(self) -> tuple[str, ...]:
        return self.turn, self.body, self.end_body, self.end

    def _broken(self) -> str:
        """A mark's first character and backslashes, before the rest of that mark."""
        return "|".join(rf"{re.escape(m[0])}\\*(?={re.escape(m[1:])})" for m in self.marks)

    def escape(self, text: Column) -> Column:
        """One backslash more after the first character of whatever reads as a
        mark, also of one escaped before: no mark is left, nothing is lost."""
        return F.regexp_replace(text, f"({self._broken()})", r"$1\\")

    def unescape(self, text: Column) -> Column:
        taken = "|".join(rf"{re.escape(m[0])}\\*(?=\\{re.escape(m[1:])})" for m in self.marks)
        return F.regexp_replace(text, rf"({taken})\\", "$1")

    def format_turn(self, role: Column, text: Column) -> Column:
        """(piece, skip, take, tail): the turn, and its characters before, under and after the loss mask."""
        role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
        head, body = F.concat(F.lit(self.turn), self.escape(role), F.lit(self.body)), self.escape(text)
        piece = F.concat(head, body, F.lit(self.end_body + self.end))
        n, answer = F.char_length(piece), role == self.answers
        skip, take = F.when(answer, F.char_length(head)).otherwise(n), F.when(answer, F.char_length(body)).otherwise(0)
        return F.struct(piece.alias("piece"), skip.alias("skip"), take.alias("take"), (n - skip - take).alias("tail"))


def _reach(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """`nodes` (id, up, score) to the links (id, up) over 1, 2, 4, ... steps,
    and (id, root, score, depth) summed from the root to each message."""
    now = written(nodes.select("id", "up", F.col("id").alias("root"), F.coalesce("score", F.lit(0.0)).alias("score"),
                               F.lit(1).cast("long").alias("depth")), "reach")
    total, steps, links = now.count(), 1, []
    while True:
        links.append(now.filter("up is not null").select("id", "up"))
        if links[-1].isEmpty():
            return links[:-1], now.drop("up")
        if steps > total:
            raise ValueError("parents form a cycle")
        a, b = now.alias("a"), now.alias("b")
        far = a.filter("a.up is not null").join(b, F.expr("a.up = b.id")).selectExpr(
            "a.id", "b.up", "b.root", "a.score + b.score AS score", "a.depth + b.depth AS depth")
        now = written(now.filter("up is null").unionByName(far), "reach")
        steps *= 2


def chosen_paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """`nodes` (id long and unique, up, score) to (leaf, rank, score, id, back):
    the messages of each tree's best branches, `back` steps above the leaf."""
    links, sums = _reach(nodes)
    leaves = sums.join(nodes.select(F.col("up").alias("id")).filter("id is not null").distinct(), "id", "left_anti")
    best = Window.partitionBy("root").orderBy(F.desc("score"), "id")
    ranked = leaves.withColumn("rank", F.row_number().over(best))
    if branches is not None:
        ranked = ranked.filter(F.col("rank") <= branches)
    out = written(ranked.select(F.col("id").alias("leaf"), "rank", "score", "id", F.lit(0).cast("long").alias("back")), "paths")
    for k in reversed(range(len(links))):
        above = out.join(links[k], "id").select("leaf", "rank", "score", F.col("up").alias("id"),
                                                (F.col("back") + (1 << k)).alias("back"))
        out = written(out.unionByName(above), "paths")
    return out


def _formatted(messages: DataFrame, branches: int | None, template: Template) -> DataFrame:
    """`messages` (id, up, score, conv_id, role, text) to the formatted paths."""
    paths = chosen_paths(messages.select("id", "up", "score"), branches)
    turns = messages.select("id", "conv_id", template.format_turn(F.col("role"), F.col("text")).alias("turn"))
    return (paths.join(turns, "id")
            .groupBy("leaf", "rank", "score").agg(F.sort_array(F.collect_list(F.struct(
                (-F.col("back")).alias("at"), "conv_id", "turn.*"))).alias("turns"))
            .select(F.col("turns")[0]["conv_id"].alias("conv_id"), "leaf", "rank", "score",
                    F.array_join(F.col("turns")["piece"], "").alias("formatted"),
                    F.transform("turns", lambda t: F.struct(t["skip"].alias("skip"), t["take"].alias("take"),
                                                            t["tail"].alias("tail"))).alias("mask")))


def format_trees(messages: DataFrame, id_col: str = "id", parent_col: str = "parent", role_col: str = "role",
                 text_col: str = "text", score_col: str | None = None, name_col: str | None = None,
                 branches: int | None = 1, template: Template = Template()) -> DataFrame:
    """Formats the `branches` best branches of each reply tree (None: all).

    Returns conv_id (`name_col` of the root, by default its id), leaf (a number),
    rank, score, formatted, mask: for each turn the characters before, under and
    after the loss mask."""
    rows = messages.select(F.col(id_col).alias("key"), F.col(parent_col).alias("parent"), F.col(role_col).alias("role"),
                           F.col(text_col).alias("text"), F.col(name_col or id_col).alias("conv_id"),
                           (F.col(score_col).cast("double") if score_col else F.lit(0.0)).alias("score"))
    rows = numbered(rows, [F.asc_nulls_first("key"), F.asc_nulls_first("role"), F.asc_nulls_first("text")], "id")
    first = rows.filter("key is not null").groupBy("key").agg(F.min("id").alias("up"))
    linked = rows.join(first.withColumnRenamed("key", "parent"), "parent", "left").withColumn(
        "up", F.when(F.col("parent").eqNullSafe(F.col("key")), None).otherwise(F.col("up")))
    return _formatted(written(linked, "messages"), branches, template)


def format_conversations(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Formats whole conversations (conv_id, turn, role, text): trees in which
    each row answers the one before, by turn (nulls first), then role and text.
    Rows without conv_id are one conversation. Columns as of `format_trees`."""
    rows = conversations.select("conv_id", "turn", "role", "text", F.lit(0.0).alias("score"))
    rows = numbered(rows, [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")], "id")
    after = rows.select((F.col("id") + 1).alias("id"), F.col("id").alias("up"), F.col("conv_id").alias("conv_up"))
    linked = rows.join(after, "id", "left").withColumn(
        "up", F.when(F.col("conv_up").eqNullSafe(F.col("conv_id")), F.col("up")))
    return _formatted(written(linked.drop("conv_up"), "messages"), 1, template)


def read_turns(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """`formatted` with turns (role, text) and answers (the texts under the
    mask), read from the formatted string and the mask alone. A mask that does
    not cover the string exactly fails."""
    pieces = F.slice(F.split("formatted", re.escape(template.end), -1), 1, F.size("mask"))
    between = lambda p, a, b: F.substring_index(F.substring_index(p, a, -1), b, 1)
    turns = F.transform(pieces, lambda p: F.struct(
        template.unescape(between(p, template.turn, template.body)).alias("role"),
        template.unescape(between(p, template.body, template.end_body)).alias("text")))
    spans = F.zip_with(pieces, F.col("mask"), lambda p, m: F.struct(
        (F.char_length(p) + len(template.end)).alias("n"), m.alias("m"), p.substr(m["skip"] + 1, m["take"]).alias("loss")))
    fits = F.forall("spans", lambda s: s["n"].eqNullSafe(s["m"]["skip"] + s["m"]["take"] + s["m"]["tail"]))
    answers = F.transform(F.filter("spans", lambda s: s["m"]["tail"] > 0), lambda s: template.unescape(s["loss"]))
    return formatted.withColumn("turns", turns).withColumn("spans", spans).withColumn(
        "answers", F.when(fits, answers).otherwise(F.raise_error(F.lit("the mask does not fit the text")))).drop("spans")


def digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("answers", "")
    return read_turns(formatted, template).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
