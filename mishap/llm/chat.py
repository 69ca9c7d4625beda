"""Chat transcripts from event logs, with a loss mask.

An event belongs to a turn of a conversation and has a place in the conversation's sequence:

- ``message`` opens the turn (anew) with a role and text,
- ``delta`` appends streamed text to it,
- ``edit`` puts its text in place of all the turn has,
- ``regenerate`` opens the turn anew, with its text, and discards all later turns opened before.

A turn that was never opened, or discarded and not opened since, has no message; edits and deltas
don't open turns. Everything is column expressions. Logs are dealt by conversation once; folding per
turn, dropping discarded turns and joining the transcript all work on that partitioning. A transcript
is one row with one digest, so the events of one conversation meet in one task in any plan; they are
sorted there with spilling, and what the fold adds to the transcript itself is what it supersedes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mishap.llm.common import quoted

PART = 4096


@dataclass(frozen=True)
class Template:
    """Marks around role and text, and the strings that texts must not be able to imitate.

    Inside roles and texts a backslash is doubled, and one goes after the first character of every
    occurrence of a control string, which takes it apart; removing the backslash of each pair
    restores the text, whatever it holds.
    """

    begin: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    others: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        marks = (self.begin, self.middle, self.end)
        for c in self.controls:
            if len(c) < 2 or "\\" in c:
                raise ValueError(f"a control string has two characters or more and no backslash: {c!r}")
            for m in marks:
                # No control string may arise where a text meets a mark.
                tails = any(m.startswith(c[k:]) or c[k:].startswith(m) for k in range(1, len(c)))
                heads = any(m.endswith(c[:k]) or c[:k].endswith(m) for k in range(1, len(c)))
                if tails or heads:
                    raise ValueError(f"{c!r} can arise at an edge of {m!r}")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.begin, self.middle, self.end, *self.others)

    def escaped(self, text: Column) -> Column:
        rests: dict[str, list[str]] = {}
        for c in self.controls:
            rests.setdefault(c[0], []).append(_literal(c[1:]))
        starts = "|".join(f"{_literal(c)}(?={'|'.join(rest)})" for c, rest in rests.items())
        doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        return F.regexp_replace(doubled, f"({starts})", "$1\\\\")

    def unescaped(self, text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def is_learned(self, role: Column) -> Column:
        return role.isin(*self.learned)


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text)


def log_of_rows(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", part: int = PART,
) -> DataFrame:
    """Rows of a conversation table as events: a message with the first part, then streamed deltas.

    Every row is a turn. Rows that share a turn number, and rows without one (which come first),
    are ordered by role, then by the md5 of the text; repeated rows are repeated turns, told apart by
    their place in the table. Null roles and texts are empty.
    """
    named = rows.select(
        F.col(quoted(conversation)).alias("conversation"),
        F.col(quoted(turn)).alias("number"),
        F.coalesce(F.col(quoted(role)), F.lit("")).alias("role"),
        F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"),
    )
    named = named.withColumn("copy", F.struct("role", F.md5("text"), F.monotonically_increasing_id()))
    parts = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{part}}}"), F.lit(0))
    streamed = named.select("conversation", "number", "copy", "role", F.posexplode_outer(parts))
    place = F.coalesce("pos", F.lit(0))
    return streamed.select(
        "conversation",
        F.struct("number", "copy", place.alias("part")).alias("seq"),
        F.struct("number", "copy").alias("turn"),
        F.when(place == 0, "message").otherwise("delta").alias("kind"),
        F.when(place == 0, F.col("role")).alias("role"),
        F.coalesce("col", F.lit("")).alias("text"),
    )


def messages(events: DataFrame) -> DataFrame:
    """Fold (conversation, seq, turn, kind, role, text) into (conversation, turn, role, text).

    ``seq`` and ``turn`` may have any type that sorts. Events of one conversation that share a
    ``seq`` apply in the order of kind (message, regenerate, edit, delta), then text. A message takes
    the role of the event that opened it, or of the opening before where that has none. Events
    without a sequence come first; null texts are empty; events of other kinds count for nothing.
    """
    rank = F.element_at(
        F.create_map(*[F.lit(x) for pair in zip(("message", "regenerate", "edit", "delta"), range(4)) for x in pair]),
        F.col("kind"),
    )
    known = events.where(F.col("kind").isin("message", "regenerate", "edit", "delta")).select(
        "conversation", "turn", "kind", "role",
        F.struct(F.col("seq"), rank.alias("rank"), F.coalesce("text", F.lit("")).alias("text")).alias("at"),
    )
    opens = F.col("kind").isin("message", "regenerate")
    turns = known.repartition("conversation").groupBy("conversation", "turn").agg(
        F.max(F.when(opens, F.col("at"))).alias("opened"),
        F.max(F.when(F.col("kind") != "delta", F.col("at"))).alias("reset"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("at"))).alias("again"),
        F.max_by("role", F.when(opens & F.col("role").isNotNull(), F.col("at"))).alias("role"),
        F.collect_list("at").alias("parts"),
    )
    earlier = W.partitionBy("conversation").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    kept = turns.withColumn("dropped", F.max("again").over(earlier)).where(
        F.col("opened").isNotNull() & (F.col("dropped").isNull() | (F.col("opened") > F.col("dropped")))
    )
    live = F.array_sort(F.filter("parts", lambda p: p >= F.col("reset")))
    text = F.array_join(F.transform(live, lambda p: p["text"]), "")
    return kept.select("conversation", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


def render(final: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: its transcript and a layout with the loss mask.

    ``layout`` has per turn, in order, the offset of the turn and of its text in ``formatted`` and
    the number of code points under the loss: those of the text for roles that are learned, else 0.
    """
    whole = W.partitionBy("conversation").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    head = F.concat(F.lit(template.begin), template.escaped(F.col("role")), F.lit(template.middle))
    body = template.escaped(F.col("text"))
    pieces = final.select("conversation", "turn", "role", head.alias("head"), body.alias("body"))
    chars = F.length("head") + F.length("body") + F.lit(len(template.end))
    start = F.coalesce(F.sum(chars.cast("long")).over(whole), F.lit(0).cast("long"))
    placed = pieces.withColumn("start", start)
    loss = F.when(template.is_learned(F.col("role")), F.length("body")).otherwise(0).cast("long")
    row = F.struct(
        "turn",
        F.concat("head", "body", F.lit(template.end)).alias("piece"),
        F.struct("start", (F.col("start") + F.length("head")).alias("text"), loss.alias("loss")).alias("span"),
    )
    together = placed.groupBy("conversation").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return together.select(
        "conversation",
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        F.transform("rows", lambda r: r["span"]).alias("layout"),
    )


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Add ``turns`` (role, text), parsed from the transcript, and ``learned``, the texts under the mask."""
    pieces = F.split("formatted", _literal(template.end))
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        halves = F.split(F.substring(piece, len(template.begin) + 1, 2**31 - 1), _literal(template.middle), 2)
        return F.struct(
            template.unescaped(halves[0]).alias("role"), template.unescaped(halves[1]).alias("text")
        )

    def masked(pair: Column) -> Column:
        span = pair["span"]
        cut = F.substring(pair["piece"], (span["text"] - span["start"] + 1).cast("int"), span["loss"].cast("int"))
        return template.unescaped(cut)

    cut = formatted.withColumn("_pieces", pieces)
    pairs = F.arrays_zip(F.col("_pieces").alias("piece"), F.col("layout").alias("span"))
    under = F.filter(pairs, lambda p: p["span"]["loss"] > 0)
    return cut.withColumns(
        {"turns": F.transform("_pieces", turn), "learned": F.transform(under, masked)}
    ).drop("_pieces")


def digests(back: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Counts and digests of what ``read_back`` found."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return back.select(
        F.col("conversation").alias(conversation),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
