"""Operator 4: chat formatting by columnar byte assembly.

A turn becomes ``### role: text</turn>`` and a line end. Inside texts and roles a
backslash is doubled and the control strings are broken by one (``##`` to ``#\\#``,
``</turn>`` to ``<\\/turn>``, in roles also ``:`` to ``\\:``), so that removing each
backslash before a character gives the text back.

A batch of turns is assembled at once: segment lengths, running offsets and scatter
indices are computed in numpy, and headers and contents are copied into one Arrow
buffer allocated beforehand.

Turns are dealt by ranges of (conversation, turn), so a conversation with a third of
all rows is formatted by many tasks. It then comes as several parts, numbered in order;
put together they are the conversation. Reading back streams the parts of a
conversation through one task, as digests need, and holds a batch of them at a time.

Edge cases: a NULL text or role is empty. Rows of one turn number follow each other by
role, hash of the text, then text; a NULL turn comes first. A NULL conversation id is a
conversation. Rows that repeat are turns of their own. An empty table gives an empty
table. Other columns are not read. The loss mask covers the texts of assistants.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlake.llm.scratch import text_slices

START, AFTER_ROLE, END = "### ", ": ", "</turn>\n"
LEARNED_ROLE = "assistant"
#: Bytes of text formatted by one task.
TASK_BYTES = 16_000_000
#: Tasks at most, so that their number does not outgrow the driver.
MOST_TASKS = 100_000

HEADER = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)

PARTS = "conv_id long, part long, n_turns int, formatted string, loss_starts array<int>, loss_ends array<int>"


def escape(texts: pa.Array) -> pa.Array:
    for plain, broken in (("\\", "\\\\"), ("##", "#\\#"), ("</turn>", "<\\/turn>")):
        texts = pc.replace_substring(texts, plain, broken)
    return texts


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


def _scatter(out: np.ndarray, at: np.ndarray, pieces: pa.Array) -> None:
    """Copy the pieces to their places in ``out``."""
    bounds = np.frombuffer(pieces.buffers()[1], np.int32, len(pieces) + 1, pieces.offset * 4).astype(np.int64)
    source = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
    lengths = np.diff(bounds)
    out[np.repeat(at - (bounds[:-1] - bounds[0]), lengths) + np.arange(len(source))] = source


def assemble(conv_ids: pa.Array, roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, ...]:
    """Runs of turns of one conversation as formatted texts with their loss spans.

    Returns (conv_id, n_turns, formatted, loss_starts, loss_ends) of each run; spans
    are in code points.
    """
    n = len(texts)
    coded = roles.dictionary_encode()
    names = pc.replace_substring(escape(coded.dictionary), ":", "\\:")
    headers = pc.binary_join_element_wise(START, names, AFTER_ROLE, "").take(coded.indices)
    bodies = escape(texts)
    head, body = (pc.binary_length(a).to_numpy().astype(np.int64) for a in (headers, bodies))
    ends = np.cumsum(head + body + len(END))
    begins = ends - head - body - len(END)
    out = np.empty(int(ends[-1]), np.uint8)
    _scatter(out, begins, headers)
    _scatter(out, begins + head, bodies)
    out[(ends - len(END))[:, None] + np.arange(len(END))] = np.frombuffer(END.encode(), np.uint8)

    valid, values = pc.is_valid(conv_ids).to_numpy(zero_copy_only=False), pc.fill_null(conv_ids, 0).to_numpy()
    opens = np.ones(n, bool)
    opens[1:] = (values[1:] != values[:-1]) | (valid[1:] != valid[:-1])
    first = np.flatnonzero(opens)
    offsets = np.append(begins[first], ends[-1]).astype(np.int32)
    formatted = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(out))

    head_chars, body_chars = (pc.utf8_length(a).to_numpy().astype(np.int64) for a in (headers, bodies))
    after = np.cumsum(head_chars + body_chars + len(END))
    run = np.cumsum(opens) - 1
    start = after - len(END) - body_chars - (after - head_chars - body_chars - len(END))[first][run]
    learned = pc.equal(roles, LEARNED_ROLE).to_numpy(zero_copy_only=False)
    bounds = pa.array(np.concatenate(([0], np.cumsum(np.bincount(run[learned], minlength=len(first))))).astype(np.int32))
    spans = [pa.ListArray.from_arrays(bounds, pa.array(side[learned].astype(np.int32))) for side in (start, start + body_chars)]
    return conv_ids.take(pa.array(first)), pa.array(np.bincount(run, minlength=len(first)).astype(np.int32)), formatted, *spans


def format_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", task_bytes: int = TASK_BYTES) -> DataFrame:
    """Parts of formatted conversations with their loss spans, see ``PARTS``."""
    rows = df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = ["conv_id", "turn", "role", F.xxhash64("text")]
    tasks = min(MOST_TASKS, max(1, -(-size // task_bytes)))
    dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32  # partitions follow the order of conversations
        for batch in text_slices(batches, "text"):
            conv_ids, n_turns, *made = assemble(*(batch.column(c) for c in ("conv_id", "role", "text")))
            parts = pa.array(np.arange(part, part + len(conv_ids)))
            part += len(conv_ids)
            yield pa.RecordBatch.from_arrays([conv_ids, parts, n_turns, *made], ["conv_id", "part", "n_turns", "formatted", "loss_starts", "loss_ends"])

    return dealt.mapInArrow(run, PARTS)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted part."""
    turns, at = [], 0
    while header := HEADER.match(formatted, at):
        end = formatted.index(END, header.end())
        turns.append((unescape(header[1]), unescape(formatted[header.end():end])))
        at = end + len(END)
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return turns


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of each conversation from its formatted parts and loss spans alone.

    Returns (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        done: list[tuple] = []
        conv, state = None, None

        def close() -> None:
            if state:
                turns, all_turns, loss_chars, loss, chars = state
                done.append((conv, turns, all_turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) or [[]] * len(names)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != conv:
                    close()
                    conv, state = row["conv_id"], [0, sha256(), 0, sha256(), 0]
                turns = parse_turns(row["formatted"])
                state[0] += len(turns)
                state[1].update("".join(f"{role}\n{text}\n" for role, text in turns).encode())
                learned = [unescape(row["formatted"][a:b]) for a, b in zip(row["loss_starts"], row["loss_ends"])]
                state[2] += sum(map(len, learned))
                state[3].update("".join(learned).encode())
                state[4] += len(row["formatted"])
            yield flush()
        close()
        yield flush()

    streamed = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return streamed.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
