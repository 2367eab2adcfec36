"""Chat formatting: a finite-state machine over roles and a declarative template.

A :class:`Template` names the text before and after a turn, the roles whose words count for the
loss, and the machine's transitions. Each conversation becomes a list of text segments with a loss
flag each; the segments joined together are the formatted text. :func:`parse` reads a formatted
text back into its turns.

Control strings inside roles and texts are escaped reversibly: a backslash is doubled, and a
backslash goes between ``<`` and ``|``. No control string survives that, since every one starts
with ``<|``; a backslash followed by any character stands for that character. In roles a line feed
gets a backslash too, because it ends the role.

Only DataFrame functions are used. One conversation is one text, so its turns meet in one row;
conversations are spread over tasks by conv_id.

Defined results: role or text null: empty; turns in order of (turn, role, text), a null turn last;
repeated rows are turns like any other; conv_id null: a conversation of its own; turn order not
allowed by the machine: formatted all the same, with ``valid`` false and ``bad_turn`` the place
(from 0) of the first turn that does not fit, or the number of turns if the end does not; empty
table: no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import pick


@dataclass(frozen=True)
class Template:
    """``transitions`` are (state, role, next state); ``final`` are the states to end in."""

    before: str = "<|im_start|>"
    between: str = "\n"
    after: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "begin"
    transitions: tuple[tuple[str, str, str], ...] = (
        ("begin", "system", "asked"),
        ("asked", "user", "said"),
        ("begin", "user", "said"),
        ("said", "assistant", "answered"),
        ("answered", "user", "said"),
    )
    final: tuple[str, ...] = ("answered",)

    def __post_init__(self) -> None:
        if not (self.before.startswith("<|") and self.after.startswith("<|") and self.between == "\n"):
            raise ValueError("before and after must start with <| and between must be a line feed")


CHATML = Template()


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _run_machine(roles: Column, t: Template) -> Column:
    """struct(state, bad): the state after all roles, and the place of the first bad turn or -1."""
    table = F.create_map(*(F.lit(x) for s, role, to in t.transitions for x in (s + "\x00" + role, to)))

    def step(acc: Column, role: Column) -> Column:
        to = F.try_element_at(table, F.concat(acc["state"], F.lit("\x00"), role))
        stuck = (acc["bad"] >= 0) | to.isNull()
        return F.struct(
            F.when(stuck, acc["state"]).otherwise(to).alias("state"),
            F.when(stuck & (acc["bad"] < 0), acc["at"]).otherwise(acc["bad"]).alias("bad"),
            (acc["at"] + 1).alias("at"),
        )

    first = F.struct(F.lit(t.start).alias("state"), F.lit(-1).alias("bad"), F.lit(0).alias("at"))
    return F.aggregate(roles, first, step)


def format_chats(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): conv_id, valid, bad_turn,
    segments array<struct<text, loss>>, formatted."""
    t = template
    rows = pick(turns, conv_id="long", turn="long", role="string", text="string").select(
        "conv_id",
        F.struct(F.col("turn").isNull().alias("late"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                 F.coalesce("text", F.lit("")).alias("text")).alias("said"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    loss = lambda said: said["role"].isin(*t.loss_roles)
    piece = lambda text, flag: F.struct(text.alias("text"), flag.alias("loss"))
    segments = F.flatten(F.transform("said", lambda said: F.array(
        piece(F.concat(F.lit(t.before), escape_role(said["role"]), F.lit(t.between)), F.lit(False)),
        piece(escape(said["text"]), loss(said)),
        piece(F.lit(t.after), F.lit(False)),
    )))
    ran = _run_machine(F.transform("said", lambda said: said["role"]), t)
    return (
        chats.select("conv_id", segments.alias("segments"), ran.alias("ran"))
        .withColumn("bad_turn", F.when(F.col("ran.bad") >= 0, F.col("ran.bad"))
                    .when(~F.col("ran.state").isin(*t.final), F.col("ran.at")))
        .select("conv_id", F.col("bad_turn").isNull().alias("valid"), "bad_turn", "segments",
                F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))
    )


def parse(formatted: Column, template: Template = CHATML) -> Column:
    """The turns of a formatted text: array<struct<role, text>>, unescaped."""
    role = r"([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n"  # possessive: no stack grows with the role
    quote = lambda s: r"\Q" + s + r"\E"
    pieces = F.slice(F.split(formatted, quote(template.before)), 2, 2**31 - 2)
    body = lambda p: F.regexp_replace(p, r"(?s)\A" + role, "")
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.regexp_extract(p, r"(?s)\A" + role, 1)).alias("role"),
        unescape(F.regexp_replace(body(p), r"(?s)" + quote(template.after) + r"\z", "")).alias("text"),
    ))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
