"""Chat formatting by event-sourced reconstruction.

Method. The input is a log of events. The log is partitioned by conversation and message, sorted by
sequence number and folded: ``open`` begins a message with its role, ``delta`` appends streamed text,
``edit`` replaces the text so far, ``regenerate`` discards it (the deltas that follow build it anew),
``retract`` withdraws the message. Final messages are rendered one by one with escaped control strings
and then put in order within their conversation.

Template. Each turn is marked by its role: ``[SYS] .. [/SYS]``, ``[INST] .. [/INST]`` (user), ``<s> .. </s>``
(assistant), ``[ROLE] role [SAYS] .. [/ROLE]`` (any other; null counts as empty). Inside texts and roles a
backslash goes after the first character of every control string, also of one that has backslashes
there already, so that reading removes exactly one. The loss mask covers assistant texts, without marks.

Results. A conversation is as many rows as it has messages (position, formatted piece, masked part of
it), so that no row or task holds a whole conversation; its formatted text is their concatenation.
Null texts count as empty. Events with equal sequence numbers go by kind, then text; repeated ``open``
events of a message count once. A message without ``open`` has an empty role; events without a
conversation form the conversation null. A text cut off by neither end is kept whole, whatever its
length. An empty log gives no rows; extra columns are not read. The digests of a conversation are
sequential by nature: they stream over its sorted rows with constant memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyqa.llm.storage import ship

MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
OTHER = ("[ROLE] ", " [SAYS] ", " [/ROLE]")
NAMES = r"(?:/?(?:SYS|INST|ROLE)\]|SAYS\]|/?s>)"
ESCAPE = re.compile(rf"([\[<])(\\*)(?={NAMES})")
UNESCAPE = re.compile(rf"([\[<])\\(\\*)(?={NAMES})")
TURN = re.compile(
    r"\[SYS\] (?P<system>.*?) \[/SYS\]|\[INST\] (?P<user>.*?) \[/INST\]|<s> (?P<assistant>.*?) </s>"
    r"|\[ROLE\] (?P<role>.*?) \[SAYS\] (?P<other>.*?) \[/ROLE\]", re.DOTALL,
)
#: Order of events with the same sequence number.
KINDS = ("open", "delta", "edit", "regenerate", "retract")
#: Code points in a streamed delta of a conversation table.
CHUNK = 400


def escape(text: str) -> str:
    return ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and start and length of its part under the loss mask."""
    shown = escape(text)
    if role in MARKS:
        before, after = MARKS[role]
        return before + shown + after, *((len(before), len(shown)) if role == "assistant" else (0, 0))
    return OTHER[0] + escape(role) + OTHER[1] + shown + OTHER[2], 0, 0


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """Turns of a formatted text."""
    at = 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        at = found.end()
        kind = found.lastgroup
        yield (unescape(found["role"]), unescape(found["other"])) if kind == "other" else (kind, unescape(found[kind]))


def messages(log: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log (conv_id, message, seq, kind, role, text)."""
    rank = F.create_map(*[x for k, name in enumerate(KINDS) for x in (F.lit(name), F.lit(k))])[F.col("kind")]
    events = log.select("conv_id", "message", "seq", rank.alias("rank"), "role", F.coalesce("text", F.lit("")).alias("text"))
    upto = Window.partitionBy("conv_id", "message").orderBy("seq", "rank", "text").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = F.struct("seq", "rank", "text")
    events = events.withColumns({
        "restart": F.max(F.when(F.col("rank").isin(2, 3), at)).over(upto), "gone": F.max(F.when(F.col("rank") == 4, at)).over(upto),
        "role": F.min(F.when(F.col("rank") == 0, F.coalesce("role", F.lit("")))).over(upto),
    })
    speaks = F.col("rank").isin(1, 2) & (F.col("restart").isNull() | (at >= F.col("restart")))
    parts = F.array_sort(F.collect_list(F.when(speaks, at)))
    return events.filter("gone IS NULL").groupBy("conv_id", "message").agg(
        F.coalesce(F.min("role"), F.lit("")).alias("role"), F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text")
    )


def formatted(log: DataFrame) -> DataFrame:
    """Formatted pieces (conv_id, position, piece, loss_start, loss_length) of every message of a log."""
    ship(log.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [render(r, t) for r, t in zip(batch["role"].to_pylist(), batch["text"].to_pylist())]
            piece, start, length = zip(*done) if done else ((), (), ())
            columns = [batch["conv_id"], batch["message"], pa.array(piece, pa.string()), pa.array(start, pa.int64()), pa.array(length, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "position", "piece", "loss_start", "loss_length"])

    return messages(log).mapInArrow(run, "conv_id long, position long, piece string, loss_start long, loss_length long")


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of every conversation, read from its formatted text and loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        now, rows, state = ..., [], None

        def ended() -> None:
            if state:
                rows.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for conv, piece, start, length in zip(*(batch[c].to_pylist() for c in ("conv_id", "piece", "loss_start", "loss_length"))):
                if conv != now:
                    ended()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                masked = unescape(piece[start : start + length])
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(piece)
            if len(rows) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                rows.clear()
        ended()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "position").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def conversation_log(turns: DataFrame) -> DataFrame:
    """A turn table (conv_id, turn, role, text) as the log of its making.

    Rows go by turn; rows of one turn by role, then text, each a message. Assistant texts are streamed in
    deltas of ``CHUNK`` code points after a discarded draft; other texts are a draft, then an edit.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.row_number().over(order).cast("long").alias("message"), "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    none = "cast(NULL AS string)"
    event = lambda seq, kind, text: f"named_struct('seq', cast({seq} AS long), 'kind', '{kind}', 'text', {text})"
    streamed = f"transform(sequence(0, (length(text) + {CHUNK - 1}) div {CHUNK}), k -> {event('k + 3', 'delta', f'substring(text, cast(k * {CHUNK} + 1 AS int), {CHUNK})')})"
    events = F.expr(f"""
        if(role = 'assistant',
            concat(array({event(0, 'open', none)}, {event(1, 'delta', "'draft'")}, {event(2, 'regenerate', none)}), {streamed}),
            array({event(0, 'open', none)}, {event(1, 'delta', "'draft'")}, {event(2, 'edit', 'text')}))
    """)
    return rows.select("conv_id", "message", "role", F.explode(events).alias("e")).select("conv_id", "message", "role", "e.*")
