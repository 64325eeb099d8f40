"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its context and
only that reply is under the loss mask.  ``turns`` writes each turn in the template, with its
place in the conversation; ``render`` expands them to the examples, each with its whole
context, one at a time; ``read_back`` reads conversations and replies from those texts alone.
``examples`` lists the examples by reference, without their texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# Characters of rendered texts that leave a task together.
RENDERED = 1 << 22
_HEAD = re.compile(r"<\|im_start\|>([^\n]*)\n")


def escape(text: Column) -> Column:
    """One more backslash inside ``<|``, ``<\\|``, ...: no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _unescape_role(role: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: ``(conv_id, ordinal, offset, piece, example, loss_begin, loss_end)``.

    Turns are ordered by ``turn``, equal ones by role and text; NULL roles and texts are
    empty.  ``piece`` is the formatted turn, ``offset`` its first character in the formatted
    conversation.  For an assistant turn ``example`` numbers the example of the conversation
    and ``loss_begin`` and ``loss_end`` bound the escaped reply in the formatted conversation;
    the text of the example is that conversation up to the end of this piece.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    rows = conversations.select(
        F.col("conv_id"), F.col("turn"), role.alias("role"), text.alias("text"),
        F.concat(F.lit(START), escape(named), F.lit("\n")).alias("head"), escape(text).alias("body"),
    )
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    ordered = rows.select(
        "conv_id",
        (F.row_number().over(order) - 1).cast("long").alias("ordinal"),
        (F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("piece")).alias("offset"),
        "piece",
        F.length("head").alias("skip"),
        F.length("body").alias("size"),
        F.when(F.col("role") == "assistant", F.count(F.when(F.col("role") == "assistant", 1)).over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1).alias("example"),
    )
    target = F.col("example").isNotNull()
    return ordered.select(
        "conv_id", "ordinal", "offset", "piece", "example",
        F.when(target, F.col("offset") + F.col("skip")).alias("loss_begin"),
        F.when(target, F.col("offset") + F.col("skip") + F.col("size")).alias("loss_end"),
    )


def examples(formatted: DataFrame) -> DataFrame:
    """``(conv_id, example, target, context_chars, loss_begin, loss_end, chars)`` by reference to ``turns``."""
    return formatted.filter(F.col("example").isNotNull()).select(
        "conv_id", "example", F.col("ordinal").alias("target"), F.col("offset").alias("context_chars"),
        "loss_begin", "loss_end", (F.col("offset") + F.length("piece")).alias("chars"),
    )


def _in_order(formatted: DataFrame) -> DataFrame:
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "ordinal")


def render(formatted: DataFrame, *, rest: bool = False) -> DataFrame:
    """``(conv_id, example, text, loss_begin, loss_end)`` with whole texts, one example at a time.

    Examples of a conversation come in order.  With ``rest`` a conversation that does not end
    with a reply gets one more row, its whole text with NULL ``example`` and no loss.
    """
    types = pa.schema([("conv_id", pa.int64()), ("example", pa.int64()), ("text", pa.string()), ("loss_begin", pa.int64()), ("loss_end", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, prefix, open_, rows, size = object(), [], False, [], 0

        def left() -> list[dict]:
            return [{"conv_id": at, "example": None, "text": "".join(prefix), "loss_begin": None, "loss_end": None}] if rest and open_ else []

        for part in parts:
            for r in part.to_pylist():
                if r["conv_id"] != at:
                    rows += left()
                    at, prefix = r["conv_id"], []
                prefix.append(r["piece"])
                open_ = r["example"] is None
                if not open_:
                    prefix = ["".join(prefix)]
                    rows.append({"conv_id": at, "example": r["example"], "text": prefix[0], "loss_begin": r["loss_begin"], "loss_end": r["loss_end"]})
                    size += len(prefix[0])
                if size > RENDERED or len(rows) >= 1_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=types)
                    rows, size = [], 0
        rows += left()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=types)

    return _in_order(formatted).mapInArrow(run, "conv_id long, example long, text string, loss_begin long, loss_end long")


def _turn(text: str, at: int) -> tuple[str, str, int]:
    """Role and text of the formatted turn that begins at ``at``, and where it ends."""
    head = _HEAD.match(text, at)
    end = text.index(END, head.end())
    return _unescape_role(head[1]), unescape(text[head.end() : end]), end + len(END) + 1


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` from the expanded examples.

    Each example must repeat the one before it as its context; the turns that follow are split
    at the template's marks and unescaped, and the reply is what lies under its loss mask.
    ``formatted_chars`` counts the characters of all examples of a conversation.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    types = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, before, started = None, None, "", False

        def done() -> dict:
            return {"conv_id": at, "n_turns": state[0], "turns_sha256": state[1].hexdigest(), "loss_chars": state[2], "loss_sha256": state[3].hexdigest(), "formatted_chars": state[4]}

        for part in parts:
            out = []
            for r in (r for i in range(part.num_rows) for r in part.slice(i, 1).to_pylist()):
                if not started or r["conv_id"] != at:
                    if started:
                        out.append(done())
                    at, state, before, started = r["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0], "", True
                text = r["text"]
                if not text.startswith(before):
                    raise ValueError(f"example {r['example']} of conversation {at} has another context than the one before it")
                place = len(before)
                while place < len(text):
                    role, said, place = _turn(text, place)
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                before = text
                if r["example"] is not None:
                    loss = unescape(text[r["loss_begin"] : r["loss_end"]])
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                    state[4] += len(text)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=types)
        if started:
            yield pa.RecordBatch.from_pylist([done()], schema=types)

    # The rows stay where the expansion made them, conversation by conversation.
    return render(formatted, rest=True).mapInArrow(run, schema)
