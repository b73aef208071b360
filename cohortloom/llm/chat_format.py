"""Chat formatting: turn order checked by a finite-state machine, text laid out by a template.

A template gives every role a control string before and after its text and says whether the text
counts for the loss. The order of roles is a table of transitions. Both are plain values, turned
into SQL expressions over the array of turns of one conversation.

Defined cases: a null text or role is empty; a conversation's turns are ordered by (turn, role,
text), so repeated rows stay and ties are settled; a null conv_id is a conversation of its own; a
role the template does not know is written with its name and leaves the machine in its error
state; columns beyond the four used are ignored. One conversation must fit in one row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import sha256_hex

START, ERROR = "", "!"


@dataclass(frozen=True)
class Part:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Control strings by role, those of any other role, and the allowed successions of roles.

    Control strings begin with ``<`` or ``[``, hold neither afterwards, and none begins another:
    so an escape put after the first sign of one inside a text can be taken out again.
    """

    parts: dict[str, Part]
    named: tuple[str, str, str] = ("[TURN]", "[TEXT]", "[/TURN]")
    follows: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self):
        marks = self.controls()
        for mark in marks:
            if not re.fullmatch(r"[<\[][^<\[\\]+", mark):
                raise ValueError(f"not a control string: {mark}")
            if any(other != mark and other.startswith(mark) for other in marks):
                raise ValueError(f"{mark} begins another control string")
        if len(set(marks)) < len(marks):
            raise ValueError("control strings repeat")

    def controls(self) -> list[str]:
        own = [mark for part in self.parts.values() for mark in (part.before, part.after)]
        return [*own, *self.named]

    def pattern(self, escapes: str) -> str:
        """Matches a control string with so many escapes after its first sign."""
        inner = "|".join(f"{re.escape(c[0])}{escapes}{_plain(c[1:])}" for c in self.controls())
        return rf"(?:{inner})"


def _plain(text: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() else c for c in text)


TEMPLATE = Template(
    parts={
        "system": Part("[SYS]", "[/SYS]"),
        "user": Part("[INST]", "[/INST]"),
        "assistant": Part("<s>", "</s>", loss=True),
        "tool": Part("[TOOL]", "[/TOOL]"),
    },
    follows={
        START: ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user", "tool"),
        "tool": ("assistant",),
    },
)


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    """One backslash more after the first sign of every control string in the text."""
    lead, rest = _lead_rest(template)
    return F.regexp_replace(text, rf"{lead}(\\*{rest})", r"$1\\$2")


def unescape(text: Column, template: Template = TEMPLATE) -> Column:
    lead, rest = _lead_rest(template)
    return F.regexp_replace(text, rf"{lead}\\(\\*{rest})", "$1$2")


def _lead_rest(template: Template) -> tuple[str, str]:
    by_lead = {c: [m[1:] for m in template.controls() if m[0] == c] for c in "<["}
    ahead = "|".join(
        rf"{_plain(c)}(?=\\*(?:{'|'.join(map(_plain, rests))}))"
        for c, rests in by_lead.items()
        if rests
    )
    every = "|".join(_plain(m[1:]) for m in template.controls())
    return f"({ahead})", f"(?:{every})"


def format_chats(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Per conversation: ``segments`` (text, loss), ``formatted``, ``valid``, ``first_bad_turn``.

    ``first_bad_turn`` is the number, from 1, of the first turn whose role may not follow; null
    where the order is right.
    """
    row = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    chats = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    return chats.select(
        "conv_id",
        F.flatten(F.transform("turns", lambda t: _segments(t, template))).alias("segments"),
        _first_bad("turns", template).alias("first_bad_turn"),
    ).select(
        "conv_id",
        "segments",
        F.array_join(F.col("segments.text"), "").alias("formatted"),
        F.col("first_bad_turn").isNull().alias("valid"),
        "first_bad_turn",
    )


def _segment(text: Column, loss: bool) -> Column:
    return F.struct(text.alias("text"), F.lit(loss).alias("loss"))


def _segments(turn: Column, template: Template) -> Column:
    body = escape(turn["text"], template)
    open_, name, close = template.named
    head = F.concat(F.lit(open_), escape(turn["role"], template), F.lit(name))
    out = F.array(_segment(head, False), _segment(body, False), _segment(F.lit(close), False))
    for role, part in template.parts.items():
        own = F.array(
            _segment(F.lit(part.before), False),
            _segment(body, part.loss),
            _segment(F.lit(part.after), False),
        )
        out = F.when(turn["role"] == role, own).otherwise(out)
    return out


def _first_bad(turns: str, template: Template) -> Column:
    """The machine's run over the roles: the state is the last role, or the error state."""
    allowed = F.array(*[F.lit(f"{a}>{b}") for a, bs in template.follows.items() for b in bs])

    def step(state: Column, turn: Column) -> Column:
        good = F.array_contains(allowed, F.concat(state["role"], F.lit(">"), turn["role"]))
        at = state["at"] + 1
        failed = state["bad"].isNotNull() | ~good
        return F.struct(
            F.when(failed, F.lit(ERROR)).otherwise(turn["role"]).alias("role"),
            at.alias("at"),
            F.coalesce(state["bad"], F.when(~good, at)).alias("bad"),
        )

    first = F.struct(
        F.lit(START).alias("role"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad")
    )
    return F.aggregate(turns, first, step, lambda state: state["bad"])


def read_back(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Roles and texts read from ``formatted``, and the unescaped text under the loss mask."""
    open_, name, close = template.named
    bounds = [(p.before, p.after) for p in template.parts.values()] + [(open_, close)]
    turn = "|".join(rf"{_plain(a)}(?s:.*?){_plain(b)}" for a, b in bounds)

    def parse(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(open_) + 1), F.length(piece) - len(open_ + close))
        out = F.struct(
            unescape(F.substring_index(inner, name, 1), template).alias("role"),
            unescape(
                F.substring(inner, F.instr(inner, name) + len(name), F.length(inner)), template
            ).alias("text"),
        )
        for role, part in template.parts.items():
            size = F.length(piece) - len(part.before + part.after)
            text = F.substring(piece, F.lit(len(part.before) + 1), size)
            known = F.struct(F.lit(role).alias("role"), unescape(text, template).alias("text"))
            out = F.when(F.startswith(piece, F.lit(part.before)), known).otherwise(out)
        return out

    losses = F.filter("segments", lambda s: s["loss"])
    return formatted.select(
        "*",
        F.transform(F.regexp_extract_all("formatted", F.lit(turn), F.lit(0)), parse).alias("turns"),
        F.array_join(F.transform(losses, lambda s: unescape(s["text"], template)), "").alias(
            "loss_text"
        ),
    )


def digests(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Counts and digests of what is read back from the formatted conversations."""
    lines = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    return read_back(formatted, template).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha256_hex(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        sha256_hex(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
