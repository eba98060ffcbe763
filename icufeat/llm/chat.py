"""Chat formatting: one training example per assistant turn, with all turns before it as context.

A turn is written as

    <turn ROLE>
    TEXT
    </turn>

Inside a text every `<turn` and `</turn` gets one more backslash in front than it had
(`\\*<turn` -> `\\\\*<turn`), so a control string of the template never occurs in a text, and
taking one backslash away gives the text back. A role has its own escapes, since it
must stay on its line.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CONTROL = re.compile(r"(\\*</?turn)")
_ESCAPED = re.compile(r"\\(\\*</?turn)")
_TURN = re.compile(r"<turn ([^>\n]*)>\n(.*?)\n</turn>\n", re.S)
_ROLE_OUT = {"\\": "\\\\", "\n": "\\n", ">": "\\g", "<": "\\l"}
_ROLE_IN = {v: k for k, v in _ROLE_OUT.items()}

#: Characters of finished examples that a task holds before it hands them on.
BATCH_CHARS = 4_000_000


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    return re.sub(r"[\\\n<>]", lambda m: _ROLE_OUT[m[0]], role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\.", lambda m: _ROLE_IN.get(m[0], m[0]), role)


def opening(role: str) -> str:
    return f"<turn {escape_role(role)}>\n"


CLOSING = "\n</turn>\n"


def render(role: str, text: str) -> str:
    return opening(role) + escape(text) + CLOSING


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted text, as they were before."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(formatted)]


EXAMPLE = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("example", T.IntegerType(), False),
    T.StructField("text", T.StringType(), False),
    T.StructField("loss_start", T.IntegerType()),
    T.StructField("loss_end", T.IntegerType()),
])


def expand(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end): the formatted examples of every conversation.

    Example n ends with the n-th assistant turn; only that turn's text, code points
    loss_start to loss_end of `text`, is trainable. A last example without a mask (both
    null) holds the whole conversation, so that what follows the last reply is in the
    output too. Turns go by turn, role, text, nulls first; null role and text count as
    empty; rows with a null conv_id make one conversation; repeated rows are turns each.
    An empty table gives no examples.

    A task reads its conversations turn by turn and keeps the formatted text so far, which
    the last example has to hold anyway, and hands examples on as they fill a batch.
    """
    turns = (
        conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        current: object = run  # no conversation yet
        so_far, chars, replies = [], 0, 0

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32()), strict=True)], EXAMPLE.names
            )
            out.clear()
            return batch

        def close() -> None:
            out.append((current, replies, "".join(so_far), None, None))

        for b in batches:
            for conv, role, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if conv != current:
                    if current is not run:
                        close()
                        size += chars
                    current, so_far, chars, replies = conv, [], 0, 0
                start, body = opening(role), escape(text)
                so_far.append(start + body + CLOSING)
                if role == "assistant":
                    full = "".join(so_far)
                    so_far = [full]
                    at = chars + len(start)
                    out.append((conv, replies, full, at, at + len(body)))
                    replies += 1
                    size += len(full)
                chars += len(start) + len(body) + len(CLOSING)
                if out and size >= BATCH_CHARS:
                    yield flush()
                    size = 0
        if current is not run:
            close()
        if out:
            yield flush()

    return turns.mapInArrow(run, EXAMPLE)


def read_back(examples: DataFrame) -> DataFrame:
    """What the formatted examples say of each conversation, one row per conv_id.

    n_turns and turns_sha256 (role, newline, text, newline of every turn) come from the
    last example; loss_chars and loss_sha256 from the masked spans in order, unescaped;
    formatted_chars counts all examples.
    """
    schema = T.StructType([
        T.StructField("conv_id", T.LongType()),
        T.StructField("example", T.IntegerType()),
        T.StructField("chars", T.LongType()),
        T.StructField("loss", T.StringType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                conv, example, text, start, end = (c[i].as_py() for c in b.columns)
                if start is None:
                    turns = parse(text)
                    digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                    rows.append((conv, example, len(text), None, len(turns), digest))
                else:
                    rows.append((conv, example, len(text), unescape(text[start:end]), None, None))
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], schema.names)

    said = F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))), lambda x: x["loss"]))
    return (
        examples.select(*EXAMPLE.names)
        .mapInArrow(run, schema)
        .groupBy("conv_id")
        .agg(F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), said.alias("said"), F.sum("chars").alias("formatted_chars"))
        .select(
            "conv_id", "n_turns", "turns_sha256", F.length("said").cast("long").alias("loss_chars"), F.sha2("said", 256).alias("loss_sha256"), "formatted_chars"
        )
    )
