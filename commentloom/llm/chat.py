"""Chat formatting by a finite-state machine over roles; DataFrame and SQL functions only.

A ``Template`` is data: for each role the control strings around its text, whether the text counts towards the
loss, the roles allowed after each state, and the states a conversation may end in.  The machine's states are the roles
and ``start``.  A turn whose role may not follow counts as a violation, after which the machine goes on from that
turn's role; a role that the template lacks is a violation and leaves the state as it is.  Nothing is dropped: such turns are
formatted by the template's ``other`` part, which writes the role out.

Rows meet in parts of ``PART_TURNS`` consecutive turn numbers, so a conversation of any length is formatted by many tasks.
For each part the machine runs from every state at once, which gives its move from entry to exit state; a
conversation's parts are then composed in order, one short row each.  Only a digest of a whole conversation needs its
text in one row, as SHA-256 is defined.

In texts a backslash is doubled and every control string gets one behind its first character, so none appears whole;
dropping each backslash that is not itself escaped restores the text.

Turns are ordered by turn number (null first), then role, then text; rows that repeat are turns of their own.  Null
texts and roles count as empty.  Null ids form one conversation.  An empty table gives an empty result; columns
besides the four are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_TURNS = 128
ROLE = "{role}"  # where ``other`` writes the role


@dataclass(frozen=True)
class Part:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    parts: dict[str, Part]
    other: Part
    follows: dict[str, tuple[str, ...]]  # by state, ``start`` included
    ends: tuple[str, ...]
    control: tuple[str, ...] = field(default=())

    @property
    def states(self) -> list[str]:
        return ["start", *self.parts]

    def check(self) -> None:
        """Raises unless texts can be escaped and turns read back."""
        if any("\\" in c or len(c) < 2 or re.search(r"\s", c) for c in self.control):
            raise ValueError("control strings need two characters and neither backslash nor white space")
        if any(a != b and a in b[1:] for a in self.control for b in self.control):
            raise ValueError("a control string lies within another one")
        for part in [*self.parts.values(), self.other]:
            # White space parts text and control strings, so that none arises where they meet.
            first, last = part.open.split(" ")[0], part.close.strip().split(" ")[-1]
            if first not in self.control or last not in self.control or part.open[-1] != " " or part.close[0] != " ":
                raise ValueError(f"{part} must begin and end with a control string and set its text off by spaces")
        if len({p.open.split(" ")[0] for p in [*self.parts.values(), self.other]}) <= len(self.parts):
            raise ValueError("each part must open with a control string of its own")


INSTRUCT = Template(
    parts={
        "system": Part("<<SYS>> ", " <</SYS>>\n"),
        "user": Part("[INST] ", " [/INST]\n"),
        "assistant": Part("[OUT] ", " </s>\n", loss=True),
    },
    other=Part("[ROLE] {role} [/ROLE] ", " [END]\n"),
    follows={"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant",),
    control=("<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[OUT]", "[ROLE]", "[/ROLE]", "[END]"),
)


def escape(text: Column, template: Template) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in template.control:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


def _segments(turn: Column, template: Template) -> Column:
    """The turn's three segments (text, loss): what opens it, its text, what closes it."""

    def three(part: Part) -> Column:
        before, _, after = part.open.partition(ROLE)
        opens = F.concat(F.lit(before), escape(turn["role"], template), F.lit(after)) if ROLE in part.open else F.lit(part.open)
        pieces = [(opens, False), (escape(turn["text"], template), part.loss), (F.lit(part.close), False)]
        return F.array(*[F.struct(x.alias("text"), F.lit(loss).alias("loss")) for x, loss in pieces])

    out = three(template.other)
    for role, part in template.parts.items():
        out = F.when(turn["role"] == role, three(part)).otherwise(out)
    return out


def _moves(turns: Column, template: Template) -> Column:
    """For each state of entry (state, bad): the state after the turns, and how many of them violate the order."""
    states = template.states
    number = {s: i for i, s in enumerate(states)}
    begin = F.array(*[F.struct(F.lit(i).alias("state"), F.lit(0).cast("bigint").alias("bad")) for i in number.values()])

    def step(acc: Column, turn: Column) -> Column:
        at, allowed = F.lit(None).cast("int"), F.array().cast("array<int>")
        for role in template.parts:
            before = [F.lit(number[s]) for s in states if role in template.follows[s]]
            at = F.when(turn["role"] == role, F.lit(number[role])).otherwise(at)
            allowed = F.when(turn["role"] == role, F.array(*before).cast("array<int>")).otherwise(allowed)
        return F.transform(
            acc,
            lambda s: F.struct(
                F.coalesce(at, s["state"]).alias("state"),
                (s["bad"] + F.when(F.array_contains(allowed, s["state"]), 0).otherwise(1)).alias("bad"),
            ),
        )

    return F.aggregate(turns, begin, step)


def format_parts(
    rows: DataFrame,
    template: Template = INSTRUCT,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(_conv, _part, segments, moves): every conversation in parts, in order of ``_part`` (null first).

    ``segments`` is an array of (text, loss) in order; ``moves`` is what the machine does over the part.
    """
    template.check()
    blank = lambda c: F.coalesce(rows[c].cast("string"), F.lit("")).alias(c)
    turn = F.struct(rows[turn_col].alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text"))
    part = F.floor(rows[turn_col] / PART_TURNS)
    turns = rows.select(rows[id_col].alias("_conv"), part.alias("_part"), turn.alias("_turn"))
    turns = turns.groupBy("_conv", "_part").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    return turns.select(
        "_conv",
        "_part",
        F.flatten(F.transform("_turns", lambda t: _segments(t, template))).alias("segments"),
        _moves(F.col("_turns"), template).alias("moves"),
    )


def joined(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns (role, text) that ``formatted`` text holds, unescaped."""
    named = {role: (p.open, p.close) for role, p in template.parts.items()}
    shapes = [f"{re.escape(a)}.*?{re.escape(b)}" for a, b in named.values()]
    shapes.append(f"{'.*?'.join(map(re.escape, template.other.open.split(ROLE)))}.*?{re.escape(template.other.close)}")
    found = F.regexp_extract_all(formatted, F.lit(f"(?s){'|'.join(shapes)}"), F.lit(0))

    def turn(x: Column) -> Column:
        def between(a: Column, b: str) -> Column:
            return unescape(F.substring(x, a + 1, F.length(x) - a - len(b)))

        before, _, after = template.other.open.partition(ROLE)
        stop = F.locate(after, x)  # an escaped role never holds it
        role = unescape(F.substring(x, F.lit(len(before) + 1), stop - 1 - len(before)))
        out = F.struct(role.alias("role"), between(stop - 1 + len(after), template.other.close).alias("text"))
        for name, (a, b) in named.items():
            mine = F.struct(F.lit(name).alias("role"), between(F.lit(len(a)), b).alias("text"))
            out = F.when(F.startswith(x, F.lit(a)), mine).otherwise(out)
        return out

    return F.transform(found, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def read_back(parts: DataFrame, template: Template = INSTRUCT, id_col: str = "conv_id") -> DataFrame:
    """(id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_violations, complete) of ``format_parts``' output.

    Turns are parsed from each part's joined text, the loss from its flags.  ``complete``: the machine stops in one of the
    template's end states.  Parts meet as three strings each.
    """
    states = template.states
    whole = parts.select("_conv", "_part", joined(F.col("segments")).alias("_all"), loss_text(F.col("segments")).alias("_loss"), "moves")
    turns = whole.withColumn("_turns", read_turns(F.col("_all"), template))
    listed = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    short = turns.select(
        "_conv",
        F.struct(
            F.col("_part").alias("part"),
            F.size("_turns").cast("bigint").alias("n"),
            F.array_join(listed, "").alias("turns"),
            F.col("_loss").alias("loss"),
            F.length("_all").cast("bigint").alias("chars"),
            "moves",
        ).alias("x"),
    )
    convs = short.groupBy("_conv").agg(
        F.sort_array(F.collect_list("x")).alias("x"), F.sum("x.n").alias("n_turns"), F.sum("x.chars").alias("formatted_chars")
    )
    begin = F.struct(F.lit(0).alias("state"), F.lit(0).cast("bigint").alias("bad"))

    def compose(acc: Column, x: Column) -> Column:
        move = F.get(x["moves"], acc["state"])
        return F.struct(move["state"].alias("state"), (acc["bad"] + move["bad"]).alias("bad"))

    text = lambda name: F.array_join(F.transform("x", lambda x: x[name]), "")
    convs = convs.select(
        "_conv", "n_turns", text("turns").alias("turns"), text("loss").alias("loss"), "formatted_chars",
        F.aggregate("x", begin, compose).alias("end"),
    )
    return convs.select(
        F.col("_conv").alias(id_col),
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        F.col("end.bad").alias("n_violations"),
        F.col("end.state").isin([i for i, s in enumerate(states) if s in template.ends]).alias("complete"),
    )
