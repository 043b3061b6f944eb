"""Chat formatting: a declarative template, a role state machine, and segments with loss flags.

Built-in functions only. Escaping is reversible: the escape character and every control string of the
template become a two-character code, so no control string is left inside a text. Control strings hold no
white space and template pieces end or begin with it next to a text, so none can arise at a border either.

Defined results: a null text or role is an empty one; a null turn number comes first; rows equal in
conversation and turn are ordered by role, then text, and all kept; a null conversation id is a
conversation of its own; roles outside the template are written by name and break the turn order;
an empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Turn:
    """How turns of one role are written, and whether their text is trained on."""

    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    """Roles and the states of the machine: `moves` maps a state to the roles it accepts.

    A state is named after the role just read; `START` is the first one. `final` are the states a whole
    conversation may end in. `other` writes unknown roles: opening, end of the name, closing.
    """

    turns: dict[str, Turn]
    moves: dict[str, tuple[str, ...]]
    final: tuple[str, ...]
    other: tuple[str, str, str] = ("[ROLE] ", " [TEXT] ", " [/ROLE]\n")

    START = "start"

    def controls(self) -> list[str]:
        pieces = [p for t in self.turns.values() for p in (t.opening, t.closing)] + list(self.other)
        return sorted({p.strip() for p in pieces})


INSTRUCT = ChatTemplate(
    turns={
        "system": Turn("[SYS] ", " [/SYS]\n"),
        "user": Turn("[INST] ", " [/INST]\n"),
        "assistant": Turn("<s> ", " </s>\n", loss=True),
    },
    moves={"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    final=("assistant",),
)


def escape(text: Column, template: ChatTemplate) -> Column:
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0"))
    codes = enumerate(template.controls())
    return reduce(lambda t, c: F.replace(t, F.lit(c[1]), F.lit(ESCAPE + chr(ord("a") + c[0]))), codes, text)


def unescape(text: Column, template: ChatTemplate) -> Column:
    codes = enumerate(template.controls())
    text = reduce(lambda t, c: F.replace(t, F.lit(ESCAPE + chr(ord("a") + c[0])), F.lit(c[1])), codes, text)
    return F.replace(text, F.lit(ESCAPE + "0"), F.lit(ESCAPE))


def _by_role(role: Column, template: ChatTemplate, known, other: Column) -> Column:
    cases = [F.when(role == name, known(turn)) for name, turn in template.turns.items()]
    return F.coalesce(*cases, other)


def format_conversations(rows: DataFrame, template: ChatTemplate = INSTRUCT) -> DataFrame:
    """(conv_id, segments array<struct<text, loss>>, n_turns, valid, first_bad_turn).

    `segments` joined give the formatted conversation; flagged ones hold exactly the text to train on.
    `first_bad_turn` is the 0-based place where the machine found no move (the number of turns, if the
    conversation only ended too early), null for a valid one.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    text = escape(F.coalesce(F.col("text"), F.lit("")), template)
    opening = _by_role(role, template, lambda t: F.lit(t.opening), F.concat(
        F.lit(template.other[0]), escape(role, template), F.lit(template.other[1])))
    closing = _by_role(role, template, lambda t: F.lit(t.closing), F.lit(template.other[2]))
    loss = _by_role(role, template, lambda t: F.lit(t.loss), F.lit(False))
    # Rows are written before they are gathered, so a conversation only joins finished pieces.
    turns = rows.select("conv_id", F.struct(
        F.col("turn").alias("turn"), role.alias("role"), F.coalesce("text", F.lit("")).alias("raw"),
        opening.alias("opening"), text.alias("text"), closing.alias("closing"), loss.alias("loss")).alias("t"))
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    accepted = F.array(*[F.lit(f"{state}>{r}") for state, roles in template.moves.items() for r in roles])

    def move(at: Column, turn: Column) -> Column:
        ok = F.array_contains(accepted, F.concat(at["state"], F.lit(">"), turn["role"]))
        bad = F.when(at["bad"].isNull() & ~ok, at["n"]).otherwise(at["bad"])
        return F.struct(turn["role"].alias("state"), (at["n"] + 1).alias("n"), bad.alias("bad"))

    start = F.struct(F.lit(template.START).alias("state"), F.lit(0).alias("n"),
                     F.lit(None).cast("int").alias("bad"))
    ran = gathered.select("conv_id", "turns", F.aggregate("turns", start, move).alias("ran"))
    bad = F.coalesce("ran.bad", F.when(~F.col("ran.state").isin(*template.final), F.col("ran.n")))

    def piece(value: Column, flag: Column) -> Column:
        return F.struct(value.alias("text"), flag.alias("loss"))

    no = F.lit(False)
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        piece(t["opening"], no), piece(t["text"], t["loss"]), piece(t["closing"], no))))
    return ran.select("conv_id", segments.alias("segments"), F.col("ran.n").cast("long").alias("n_turns"),
                      bad.isNull().alias("valid"), bad.alias("first_bad_turn"))


def formatted_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def trained_texts(segments: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """Texts under the loss mask, in order, unescaped."""
    return F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template))


def parse_formatted(formatted: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    openings = {t.opening: name for name, t in template.turns.items()}
    closings = [t.closing for t in template.turns.values()] + [template.other[2]]

    def any_of(strings: list[str]) -> str:
        return "(" + "|".join(re.escape(s) for s in strings) + ")"

    pattern = F.lit("(?s)" + any_of([*openings, template.other[0]]) + "(.*?)" + any_of(closings))
    opening, body = (F.regexp_extract_all(formatted, pattern, F.lit(i)) for i in (1, 2))

    def turn(mark: Column, inside: Column) -> Column:
        named = F.split_part(inside, F.lit(template.other[1]), F.lit(1))
        role = F.coalesce(*[F.when(mark == o, F.lit(r)) for o, r in openings.items()], unescape(named, template))
        text = F.when(mark == template.other[0], F.split_part(inside, F.lit(template.other[1]), F.lit(2)))
        return F.struct(role.alias("role"), unescape(F.coalesce(text, inside), template).alias("text"))

    return F.zip_with(opening, body, turn)
