"""Chat formatting: one training text a conversation, with a loss mask, by Spark expressions.

Turns are collected as structs and sorted; adjacent turns of one role are merged into a block
by array functions (where a block starts, and the slice up to the next start); the pieces of
all blocks are concatenated once. Every step is linear in the length of a conversation: no
string or array is built up by appending, but for running totals in chunks.

A block is `start role role_end text turn text … end`, so merged turns can be told apart
again. A control string inside a role or text gets one backslash more after its first
character than it had, and loses it when read back, so escaping is reversible and the marks
are the only control strings of the output. Control strings of other templates are escaped,
too. The loss mask is a list of byte ranges of the UTF-8 output, one for each text of the
loss role; marks are outside of them.

Defined results: null role or text counts as empty; a null turn comes first; rows with equal
turn are ordered by role and text, and repeated rows are turns of their own. Rows without
conv_id are one conversation without id. An empty table gives no rows. Other columns are not
read. A conversation is one row of the result, so it has to fit into a row (2 GB); its turns
meet in one task, which no form of this result avoids.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from predial.llm.arrays import indices, let, totals_before


@dataclass(frozen=True)
class Template:
    """Marks of the blocks, the role that is learnt, and further strings to be escaped."""

    start: str = "<|im_start|>"
    role_end: str = "<|im_role|>"
    turn: str = "<|im_turn|>"
    end: str = "<|im_end|>"
    loss_role: str = "assistant"
    foreign: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")

    def __post_init__(self):
        firsts = {c[0] for c in self.controls}
        rests = [c[1:] for c in self.controls]
        marks = {self.start, self.role_end, self.turn, self.end}
        # No control string may start inside another one, or with a part of it.
        if len(marks) < 4 or "" in rests or any("\\" in c for c in self.controls):
            raise ValueError("marks must differ, have two characters or more, and no backslash")
        if any(f in rest for f in firsts for rest in rests):
            raise ValueError("the first character of a control string stands inside another")
        if any(a != b and b.startswith(a) for a in rests for b in rests):
            raise ValueError("a control string is the beginning of another")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.role_end, self.turn, self.end, *self.foreign)

    @property
    def firsts(self) -> tuple[str, ...]:
        return tuple(sorted({c[0] for c in self.controls}))

    def pattern(self, escaped: bool) -> str:
        """First character, backslashes (one at least if `escaped`, outside the group), rest."""
        firsts = "".join(re.escape(f) for f in self.firsts)
        rests = "|".join(dict.fromkeys(re.escape(c[1:]) for c in self.controls))
        return rf"([{firsts}]){chr(92) * 2 if escaped else ''}(\\*)({rests})"


CHATML = Template()


def _replaced(text: Column, template: Template, escaped: bool, by: str) -> Column:
    """The pattern replaced, in texts that hold a character with which it may begin."""
    some = [F.contains(text, F.lit(first)) for first in template.firsts]
    return F.when(
        reduce(or_, some), F.regexp_replace(text, template.pattern(escaped), by)
    ).otherwise(text)


def escape(text: Column, template: Template = CHATML) -> Column:
    return _replaced(text, template, False, r"$1\\$2$3")


def unescape(text: Column, template: Template = CHATML) -> Column:
    return _replaced(text, template, True, "$1$2$3")


def merged(turns: Column) -> Column:
    """Blocks (role, texts) of adjacent turns with one role; linear in the turns."""

    def starts(t: Column) -> Column:
        opens = lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"])
        return F.filter(indices(t), opens)

    def blocks(t: Column, at: Column) -> Column:
        def block(s: Column, k: Column) -> Column:
            after = F.coalesce(F.get(at, k + 1), F.size(t))
            texts = F.transform(F.slice(t, s + 1, after - s), lambda x: x["text"])
            return F.struct(F.get(t, s)["role"].alias("role"), texts.alias("texts"))

        return F.transform(at, block)

    return let(turns, lambda t: let(starts(t), lambda at: blocks(t, at)))


def _pieces(blocks: Column, template: Template) -> Column:
    """The output in order: (text, learn)."""

    def piece(text: Column, learn: Column) -> Column:
        return F.struct(text.alias("text"), learn.alias("learn"))

    off = F.lit(False)

    def of_block(block: Column) -> Column:
        head = F.concat(F.lit(template.start), escape(block["role"], template), F.lit(template.role_end))
        learn = block["role"] == template.loss_role

        def of_turn(text: Column, i: Column) -> Column:
            own = piece(escape(text, template), learn)
            return F.when(i == 0, F.array(own)).otherwise(
                F.array(piece(F.lit(template.turn), off), own)
            )

        turns = F.flatten(F.transform(block["texts"], of_turn))
        return F.concat(F.array(piece(head, off)), turns, F.array(piece(F.lit(template.end), off)))

    return F.flatten(F.transform(blocks, of_block))


def _rendered(pieces: Column) -> Column:
    """The text, and the byte ranges under the loss mask."""

    def spans(p: Column, lengths: Column, before: Column) -> Column:
        learnt = F.filter(indices(p), lambda i: F.get(p, i)["learn"])
        return F.transform(
            learnt,
            lambda i: F.struct(
                F.get(before, i).alias("start"),
                (F.get(before, i) + F.get(lengths, i)).alias("end"),
            ),
        )

    def whole(p: Column, lengths: Column) -> Column:
        found = let(totals_before(lengths), lambda before: spans(p, lengths, before))
        text = F.array_join(F.transform(p, lambda x: x["text"]), "")
        return F.struct(text.alias("formatted"), found.alias("loss_spans"))

    def measured(p: Column) -> Column:
        lengths = F.transform(p, lambda x: F.octet_length(x["text"]).cast("bigint"))
        return let(lengths, lambda n: whole(p, n))

    return let(pieces, measured)


def format_chats(
    df: DataFrame,
    template: Template = CHATML,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start, end; bytes)."""
    blank = F.lit("")
    rows = df.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), blank).alias("role"),
            F.coalesce(F.col(text).cast("string"), blank).alias("text"),
        ).alias("row"),
    )
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    rendered = let(_pieces(merged(F.col("turns")), template), lambda p: _rendered(p))
    return turns.select("conv_id", rendered.alias("out")).select("conv_id", "out.*")


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """The turns (role, text) that a formatted text holds, unescaped."""

    def of_block(block: Column) -> Column:
        parts = F.split(block, re.escape(template.role_end), 2)

        def turns(p: Column) -> Column:
            role = F.substring(F.get(p, F.lit(0)), len(template.start) + 1, 1 << 30)
            texts = F.split(F.get(p, F.lit(1)), re.escape(template.turn))
            return F.transform(
                texts,
                lambda t: F.struct(
                    unescape(role, template).alias("role"), unescape(t, template).alias("text")
                ),
            )

        return let(parts, turns)

    def of_blocks(blocks: Column) -> Column:  # after the last end there is nothing
        whole = F.slice(blocks, F.lit(1), F.size(blocks) - 1)
        return F.flatten(F.transform(whole, of_block))

    return let(F.split(formatted, re.escape(template.end)), of_blocks)


def read_loss(formatted: Column, spans: Column, template: Template = CHATML) -> Column:
    """All text under the loss mask, unescaped, nothing between."""

    def cut(raw: Column) -> Column:
        texts = F.transform(
            spans,
            lambda s: F.decode(
                raw.substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")),
                "UTF-8",
            ),
        )
        return F.array_join(F.transform(texts, lambda t: unescape(t, template)), "")

    return let(formatted.cast("binary"), cut)


def digests(chats: DataFrame, template: Template = CHATML) -> DataFrame:
    """What can be read back from `format_chats`, in counts and digests."""
    read = chats.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted"), template).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_spans"), template).alias("loss"),
    )
    newline = F.lit("\n")
    lines = F.transform("turns", lambda t: F.concat(t["role"], newline, t["text"], newline))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
