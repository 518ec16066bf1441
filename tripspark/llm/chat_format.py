"""Chat formatting: a finite-state machine over roles, a declarative template, and per-segment loss flags.

A conversation is a set of rows (conversation, turn, role, text). `formatted` gives one row per conversation: the verdict
of the state machine, the text segments with their loss flags, and the whole formatted text. `parsed` reads a formatted
text back into turns. Everything is column expressions; the one shuffle gathers the turns of a conversation.

Cases: a null role or text counts as empty; turns go by turn, then role, then text, null first, so ties and repeated rows
keep all their rows in a defined order. A null conversation is a conversation of its own. Role order that the machine
rejects is reported (`valid`, `bad_turn`), not dropped. An empty table gives no rows; other columns are not read. All
turns of one conversation meet in one row, as its text does in the result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm.frames import named


@dataclass(frozen=True)
class Template:
    """Marks around a turn, which roles train, and the role order as (state, role) -> state."""

    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>\n"
    control: str = "<|"  # what every control string begins with
    escaped: str = "<\\|"  # what stands for it inside a text; a backslash itself is doubled
    loss_roles: tuple[str, ...] = ("assistant",)
    first: str = "begin"
    accepting: tuple[str, ...] = ("answered",)
    steps: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("begin", "system"): "briefed",
            ("begin", "user"): "asked",
            ("briefed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )


CHATML = Template()


def escape(text: Column, t: Template = CHATML) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(t.control), F.lit(t.escaped))


def unescape(text: Column, t: Template = CHATML) -> Column:
    """Every backslash of `escape` stands in a pair, except in the escaped control; so the two steps cannot mix up."""
    return F.replace(F.replace(text, F.lit(t.escaped), F.lit(t.control)), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column, t: Template = CHATML) -> Column:
    """A role ends at the first `after_role`, so a line end inside it is written with a backslash too."""
    return F.replace(escape(role, t), F.lit(t.after_role), F.lit("\\n"))


def unescape_role(role: Column, t: Template = CHATML) -> Column:
    """An escaped role has no control string, so two made from it can hold the places of what was read already."""
    pair, control = F.lit(t.control + "0"), F.lit(t.control + "1")
    held = F.replace(role, F.lit("\\\\"), pair)
    held = F.replace(F.replace(held, F.lit("\\n"), F.lit(t.after_role)), F.lit(t.escaped), control)
    return F.replace(F.replace(held, pair, F.lit("\\")), control, F.lit(t.control))


def formatted(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: Template = CHATML,
) -> DataFrame:
    """Columns conv_id, valid, bad_turn (place of the first rejected turn, from 0), segments, formatted."""
    t = template
    turns = df.select(
        named(conversation).alias("conv_id"),
        F.struct(
            named(turn).alias("turn"),
            F.coalesce(named(role), F.lit("")).alias("role"),
            F.coalesce(named(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    steps = F.create_map(*[F.lit(v) for (state, r), to in t.steps.items() for v in (f"{state}\n{r}", to)])
    walk = F.aggregate(
        "turns",
        F.struct(F.lit(t.first).alias("state"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("bad")),
        lambda a, e: F.struct(
            F.coalesce(F.element_at(steps, F.concat(a["state"], F.lit("\n"), e["role"])), F.lit("rejected")).alias(
                "state"
            ),
            (a["n"] + 1).alias("n"),
            F.coalesce(
                a["bad"],
                F.when(F.element_at(steps, F.concat(a["state"], F.lit("\n"), e["role"])).isNull(), a["n"]),
            ).alias("bad"),
        ),
    )

    def segments(e: Column) -> Column:
        head = F.concat(F.lit(t.start), escape_role(e["role"], t), F.lit(t.after_role))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(e["text"], t).alias("text"), e["role"].isin(*t.loss_roles).alias("loss")),
            F.struct(F.lit(t.end).alias("text"), F.lit(False).alias("loss")),
        )

    made = gathered.select(
        "conv_id", walk.alias("walk"), F.flatten(F.transform("turns", segments)).alias("segments")
    )
    return made.select(
        "conv_id",
        (F.col("walk.bad").isNull() & F.col("walk.state").isin(*t.accepting)).alias("valid"),
        F.col("walk.bad").alias("bad_turn"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def parsed(formatted_text: Column, template: Template = CHATML) -> Column:
    """The turns of a formatted text, as an array of (role, text): the inverse of `formatted`."""
    t = template
    parts = F.filter(F.split(formatted_text, _quoted(t.start), -1), lambda p: p != "")

    def turn(part: Column) -> Column:
        body = F.left(part, F.length(part) - len(t.end))
        cut = F.locate(t.after_role, body)
        return F.struct(
            unescape_role(F.left(body, cut - 1), t).alias("role"),
            unescape(F.substr(body, cut + len(t.after_role)), t).alias("text"),
        )

    return F.transform(parts, turn)


def loss_text(segments: Column, template: Template = CHATML) -> Column:
    """All text under the loss mask, unescaped, in order."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescape(s["text"], template)), "")


def _quoted(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != "_" else c for c in text)
