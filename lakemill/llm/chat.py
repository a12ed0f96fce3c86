"""Chat formatting: a finite-state machine checks the order of turns, a template writes them with loss flags.

All of it is SQL over one row for each conversation. A conversation is one output text, so its turns are gathered in
one row by design; it is the unit that a model trains on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How a turn is written: start role mid text end; the loss is taken on the text of the loss roles.

    moves: the machine, by state the next state for each role; a role without a move breaks the order. final: states
    in which a conversation may end.
    """

    start: str = "<|im_start|>"
    mid: str = "\n"
    end: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "begin": {"system": "told", "user": "asked"},
            "told": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )
    final: tuple[str, ...] = ("answered",)


def escape(text: Column) -> Column:
    r"""Control strings made harmless: `\` becomes `\\`, and `<|` becomes `<\|`; runs of `\` are even but for the latter."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    r"""As escape(), and a line end, which would end the role, becomes `<\,`."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\,"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\,"), F.lit("\n")))


def valid_order(roles: Column, template: Template) -> Column:
    """Whether the machine accepts the roles in order."""
    table = F.create_map(*[F.lit(x) for s, m in template.moves.items() for r, t in m.items() for x in (f"{s}\n{r}", t)])
    return F.aggregate(roles, F.lit("begin"), lambda s, r: F.coalesce(F.element_at(table, F.concat(s, F.lit("\n"), r)), F.lit("broken"))).isin(*template.final)


def formatted(turns: DataFrame, template: Template | None = None, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, valid, formatted, segments): one row for each conversation.

    segments is array<struct<text, loss>>; joined, their texts are formatted. Each turn gives its head, its text and
    its end, and only the text of a loss role carries the loss. A null text counts as empty, a null role as the empty
    role, which breaks the order. Turns go by number, null first; rows with the same number go by role and text, and
    repeated rows are turns of their own. Rows with a null conversation id are one conversation. Conversations whose
    order the machine rejects are formatted too and marked by valid; the caller decides. Other columns are not read.
    """
    t = template or Template()
    rows = turns.select(
        F.col(id_col).alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text")).alias("t"),
    )
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda x: F.array(
                part(F.concat(F.lit(t.start), escape_role(x["role"]), F.lit(t.mid)), F.lit(False)),
                part(escape(x["text"]), x["role"].isin(*t.loss_roles)),
                part(F.lit(t.end), F.lit(False)),
            ),
        )
    )
    convs = convs.select("conv_id", F.size("turns").cast("long").alias("n_turns"), valid_order(F.transform("turns", lambda x: x["role"]), t).alias("valid"), segments.alias("segments"))
    return convs.select("conv_id", "n_turns", "valid", F.array_join(F.transform("segments", lambda x: x["text"]), "").alias("formatted"), "segments")


def read_back(formatted_col: str | Column, template: Template | None = None) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>, unescaped."""
    t = template or Template()
    col = F.col(formatted_col) if isinstance(formatted_col, str) else formatted_col
    quoted = lambda x: rf"\Q{x}\E"
    pieces = F.slice(F.split(col, quoted(t.start)), F.lit(2), F.greatest(F.lit(0), F.size(F.split(col, quoted(t.start))) - 1))

    def turn(x: Column) -> Column:
        at = F.position(F.lit(t.mid), x)
        body = F.substring(x, at + len(t.mid), F.length(x) - at - len(t.mid) + 1 - len(t.end))
        return F.struct(unescape_role(F.substring(x, F.lit(1), at - 1)).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)
