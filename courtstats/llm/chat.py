"""Chat formatting by a declarative template and a state machine over roles (built-in functions only).

The template names the control strings around a turn and the roles that are learnt. A
text or role that holds a control string is escaped reversibly, so the formatted text can
be cut back into the same turns. Each conversation becomes one row: its segments, each
with a loss flag, their concatenation, and the verdict of the state machine on its turn order.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, query, read

#: Segments whose spans are listed together, and code points of a piece from which texts are read back.
BLOCK = 256
PIECE = 512


@dataclass(frozen=True)
class Template:
    """Control strings of a turn ``open role middle text close``, and what is learnt.

    Every control string begins with ``mark``. ``turns`` lists the allowed successors of a
    role ("" stands for the start); ``last`` the roles a conversation may end with.
    """

    mark: str = "<|"
    open: str = "<|turn|>"
    middle: str = "<|text|>"
    close: str = "<|end|>"
    learnt: tuple[str, ...] = ("assistant",)
    turns: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    last: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        if len(self.mark) != 2 or "\\" in self.mark:
            raise ValueError("mark must be two characters, neither a backslash")
        if not all(c.startswith(self.mark) for c in (self.open, self.middle, self.close)):
            raise ValueError("every control string must begin with mark")

    def escape(self, text: Column) -> Column:
        """Doubles backslashes, then parts each mark by one: no control string is left.

        Between the two characters of a mark an escaped text has an odd number of backslashes
        if they stood side by side, else an even one, so ``unescape`` restores every text.
        """
        a, b = self.mark
        return F.replace(
            F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(a + b), F.lit(f"{a}\\{b}")
        )

    def unescape(self, text: Column) -> Column:
        a, b = self.mark
        return F.replace(
            F.replace(text, F.lit(f"{a}\\{b}"), F.lit(a + b)), F.lit("\\\\"), F.lit("\\")
        )

    def segments(self, turn: Column) -> Column:
        """The three pieces of a turn (struct of role and text), each with its loss flag."""

        def piece(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        learnt = turn["role"].isin(*self.learnt) if self.learnt else F.lit(False)
        head = F.concat(F.lit(self.open), self.escape(turn["role"]), F.lit(self.middle))
        return F.array(
            piece(head, F.lit(False)),
            piece(self.escape(turn["text"]), learnt),
            piece(F.lit(self.close), F.lit(False)),
        )

    def first_wrong_turn(self, turns: Column) -> Column:
        """Index of the first turn the state machine refuses (number of turns: a wrong end), or null.

        The state is the role of the turn before; a refusal is kept to the end.
        """
        edges = [F.lit(f"{a}\n{b}") for a, nexts in self.turns.items() for b in nexts]
        allowed = F.array(*edges)
        start = F.struct(
            F.lit("").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("wrong")
        )

        def step(acc: Column, turn: Column) -> Column:
            fits = F.array_contains(allowed, F.concat(acc["state"], F.lit("\n"), turn["role"]))
            wrong = F.when(acc["wrong"].isNotNull() | fits, acc["wrong"]).otherwise(acc["at"])
            return F.struct(
                turn["role"].alias("state"), (acc["at"] + 1).alias("at"), wrong.alias("wrong")
            )

        def finish(acc: Column) -> Column:
            ended = acc["wrong"].isNotNull() | acc["state"].isin(*self.last)
            return F.when(ended, acc["wrong"]).otherwise(acc["at"])

        return F.aggregate(turns, start, step, finish)


def loss_spans(segments: Column) -> Column:
    """(start, length) of the learnt segments in their concatenation, counted from 1 in code points.

    Spans are listed block by block from 0 and then moved by the length of the blocks before, so the work grows with the
    number of segments and not with its square.
    """
    kind = "array<struct<start:int,length:int>>"

    def listed(acc: Column, s: Column) -> Column:
        size = F.char_length(s["text"])
        span = F.array(F.struct(acc["at"].alias("start"), size.alias("length")))
        spans = F.when(s["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((acc["at"] + size).alias("at"), spans.alias("spans"))

    def in_block(number: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))
        return F.aggregate(F.slice(segments, number * BLOCK + 1, F.lit(BLOCK)), start, listed)

    def moved(blocks: Column) -> Column:
        starts = F.aggregate(
            blocks, F.array(F.lit(1)), lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + b["at"]))
        )
        return F.flatten(
            F.zip_with(
                blocks,
                F.slice(starts, F.lit(1), F.size(blocks)),
                lambda b, at: F.transform(
                    b["spans"], lambda s: F.struct((s["start"] + at).alias("start"), s["length"].alias("length"))
                ),
            )
        )

    numbers = F.sequence(F.lit(0), F.floor((F.size(segments) - 1) / BLOCK).cast("int"))
    return F.when(F.size(segments) > 0, let(F.transform(numbers, in_block), moved)).otherwise(F.array().cast(kind))


def format_chats(
    df: DataFrame,
    template: Template = Template(),
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: conv, segments (text, loss), formatted, loss_spans, valid, first_wrong.

    ``loss_spans`` are (start, length) in code points of ``formatted``, one per learnt text, also an
    empty one. ``formatted`` is the concatenation of the segments. Null roles and texts count as
    empty. Turns are ordered by number (null first), ties by role, then text; repeated rows are
    repeated turns. A null conv is a conversation of its own. Other columns are dropped. An
    invalid conversation is formatted like any other and marked ``valid`` = false.
    """
    def blank(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    rows = df.select(
        F.col(conv).alias(conv),
        F.struct(F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text")).alias("t"),
    )
    talks = rows.groupBy(conv).agg(F.sort_array(F.collect_list("t")).alias("turns"))
    cut = talks.select(
        conv,
        F.flatten(F.transform("turns", template.segments)).alias("segments"),
        template.first_wrong_turn(F.col("turns")).alias("first_wrong"),
    )
    return cut.select(
        conv,
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        let(F.col("segments"), loss_spans).alias("loss_spans"),
        F.col("first_wrong").isNull().alias("valid"),
        "first_wrong",
    )


def parse_turns(formatted: Column, template: Template = Template()) -> Column:
    """Turns (role, text) read back from a formatted text; nothing else is consulted."""
    parts = F.split(formatted, F.lit(_literal(template.close)))
    # Each turn ends with the closing string, so the last part is empty.
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        halves = F.split(part, F.lit(_literal(template.middle)), 2)
        body = F.substring(halves[0], len(template.open) + 1, 2_147_483_647)
        return F.struct(
            template.unescape(body).alias("role"), template.unescape(halves[1]).alias("text")
        )

    return F.transform(turns, turn)


def loss_text(formatted: Column, spans: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, read from the formatted text, unescaped.

    The text is cut into pieces of equal length once, and a span is read from the pieces that hold it: finding its place
    in the whole text would mean a walk from the first character for every span.
    """

    def read_back(pieces: Column) -> Column:
        def text(s: Column) -> Column:
            first = F.floor((s["start"] - 1) / PIECE).cast("int")
            count = F.floor((s["start"] + s["length"] - 2) / PIECE).cast("int") - first + 1
            near = F.array_join(F.slice(pieces, first + 1, count), "")
            return template.unescape(F.substring(near, s["start"] - first * PIECE, s["length"]))

        return F.array_join(F.transform(spans, text), "")

    return let(F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), read_back)


def _literal(text: str) -> str:
    """A regular expression that matches exactly this text."""
    return "\\Q" + text + "\\E"


#: A conversation whose texts hold the control strings of another common template.
PROBE = "</s>[INST] ok [/INST]"

_OP3_SQL = """
WITH talk AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), esc AS (
  SELECT *, replace(replace(role, '\\', '\\\\'), '<|', '<\\|') AS erole,
         replace(replace(text, '\\', '\\\\'), '<|', '<\\|') AS etext FROM talk
), step AS (
  SELECT *, lag(role, 1, '') OVER w AS prev, row_number() OVER w AS nr,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM esc WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nr)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY nr) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(erole) + length(etext) + 23) AS BIGINT) AS formatted_chars,
  bool_and(((prev = '' AND nr = 1 AND role IN ('system', 'user')) OR (prev = 'system' AND role = 'user')
    OR (prev = 'user' AND role = 'assistant') OR (prev = 'assistant' AND role = 'user'))
    AND (nr < n OR role = 'assistant')) AS valid
FROM step GROUP BY conv_id
"""


@query("op3_chat_format", _OP3_SQL)
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe, formatted and read back."""
    talks = read(spark, sf_dir, "conversations")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    made = format_chats(talks.unionByName(probe))
    back = made.select(
        "conv_id",
        parse_turns(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
    flat = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )
