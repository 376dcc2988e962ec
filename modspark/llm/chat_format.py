"""Chat formatting: a declarative template and a finite-state machine over roles.

The template says how a turn is written, which strings are control strings, whose text is learned
from, and which role may follow which.  Control strings inside texts are escaped so that the
formatted text can be read back exactly.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.llm.common import compute_once


@dataclass(frozen=True)
class ChatTemplate:
    """A turn is ``before`` + role + ``between`` + text + ``after``.

    ``escapes`` maps control strings to the letter that replaces them behind a backslash; no control
    string holds a backslash, and every ``before`` and ``after`` starts with one of them.
    """

    before: str = "### "
    between: str = "\n"
    after: str = "</turn>\n"
    escapes: Mapping[str, str] = field(default_factory=lambda: {"###": "h", "</turn>": "e"})
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    transitions: Mapping[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user",
    })
    accepted: tuple[str, ...] = ("assistant",)


DEFAULT = ChatTemplate()


def escape(text: Column, template: ChatTemplate = DEFAULT, role: bool = False) -> Column:
    """Backslashes doubled, control strings replaced; in a role line breaks as well."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control, letter in template.escapes.items():
        out = F.replace(out, F.lit(control), F.lit(f"\\{letter}"))
    return F.replace(out, F.lit(template.between), F.lit("\\n")) if role else out


def unescape(text: Column, template: ChatTemplate = DEFAULT, role: bool = False) -> Column:
    """The inverse of ``escape``.  Doubled backslashes are cut out first, from the left; a backslash
    that is left in a piece starts an escape."""
    letters = {**template.escapes, **({template.between: "n"} if role else {})}

    def piece(p: Column) -> Column:
        for control, letter in letters.items():
            p = F.replace(p, F.lit(f"\\{letter}"), F.lit(control))
        return p

    return F.array_join(F.transform(F.split(text, r"\\\\"), piece), "\\")


def format_chats(
    turns: DataFrame, template: ChatTemplate = DEFAULT, conv: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per conversation: ``segments`` (text, loss), ``formatted``, ``valid``, ``bad_turn``.

    ``segments`` joined give ``formatted``; a segment with ``loss`` is a text of one of the template's
    loss roles.  ``valid`` tells whether the machine accepts the roles; ``bad_turn`` is the 0-based
    place of the first role that it refuses, or the number of turns if it only ends too early.
    Invalid conversations are formatted like others and never dropped.

    Turns are ordered by (turn, role, text), missing values first, so ties and repeated rows have a
    defined order.  A missing text or role is empty.  Rows without conversation id form one
    conversation.  One conversation is one value of the result and is brought together in one row,
    as the result needs it to be; nothing else is gathered.
    """
    rows = turns.select(
        F.col(conv).alias("_conv"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("_turn"),
    )
    gathered = compute_once(
        rows.groupBy("_conv").agg(F.collect_list("_turn").alias("_list")), _turns=F.sort_array("_list")
    )
    head = F.lit(template.before)

    def segments(t: Column) -> Column:
        def segment(value: Column, loss: Column) -> Column:
            return F.struct(value.alias("text"), loss.alias("loss"))

        loss = t["role"].isin(*template.loss_roles)
        opening = F.concat(head, escape(t["role"], template, role=True), F.lit(template.between))
        return F.array(
            segment(opening, F.lit(False)), segment(escape(t["text"], template), loss),
            segment(F.lit(template.after), F.lit(False)),
        )

    moves = F.create_map(*[F.lit(x) for (state, r), to in template.transitions.items() for x in (f"{state}\n{r}", to)])

    def step(at: Column, t: Column) -> Column:
        # The empty state is the one that no role leaves.
        to = F.coalesce(F.try_element_at(moves, F.concat(at["state"], F.lit("\n"), t["role"])), F.lit(""))
        return F.struct(to.alias("state"), (at["n"] + F.when(to == "", 0).otherwise(1)).alias("n"))

    walk = F.aggregate(
        "_turns", F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("n")), step
    )
    built = compute_once(
        gathered, segments=F.flatten(F.transform("_turns", segments)), _walk=walk
    )
    valid = F.col("_walk")["state"].isin(*template.accepted)
    return built.select(
        F.col("_conv").alias(conv), "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        valid.alias("valid"), F.when(~valid, F.col("_walk")["n"]).alias("bad_turn"),
    )


def read_chat(formatted: Column, template: ChatTemplate = DEFAULT) -> Column:
    """The turns (role, text) of a formatted conversation, as they were before escaping."""
    after = r"\Q" + template.after + r"\E"
    pieces = F.split(formatted, after)
    turns = F.slice(pieces, 1, F.size(pieces) - 1)  # what follows the last turn is empty

    def turn(p: Column) -> Column:
        body = F.substring(p, F.lit(len(template.before) + 1), F.length(p))
        cut = F.instr(body, template.between)
        return F.struct(
            unescape(F.substring(body, F.lit(1), cut - 1), template, role=True).alias("role"),
            unescape(F.substring(body, cut + len(template.between), F.length(body)), template).alias("text"),
        )

    return F.transform(turns, turn)


def chat_digests(formatted: DataFrame, template: ChatTemplate = DEFAULT, conv: str = "conv_id") -> DataFrame:
    """Counts and digests of what ``format_chats`` wrote, read back from its output."""
    read = compute_once(formatted, _read=read_chat(F.col("formatted"), template))
    said = F.array_join(F.transform("_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template)), ""
    )
    both = compute_once(read, _said=said, _learned=learned)
    return both.select(
        conv, F.size("_read").cast("long").alias("n_turns"), F.sha2("_said", 256).alias("turns_sha256"),
        F.length("_learned").cast("long").alias("loss_chars"), F.sha2("_learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )
