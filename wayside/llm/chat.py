"""Conversations in a chat template, assembled as bytes in one buffer per batch.

A turn is ``<s>role[INST]text[/INST]</s>``. Control strings inside roles and texts are
escaped by a backslash after their first character, a backslash by doubling, so no text
can forge a turn and every text can be read back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm.spans import slices, utf8

OPEN, MIDDLE, CLOSE = "<s>", "[INST]", "[/INST]</s>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
LEARNT_ROLE = "assistant"
#: Text of one part of a formatted conversation; a longer turn stays whole.
PART_BYTES = 8 << 20

_TEXTS = (OPEN, None, MIDDLE, None, CLOSE)
_CONST = [np.frombuffer(t.encode(), np.uint8) if t else None for t in _TEXTS]


def escape(texts: pa.Array) -> pa.Array:
    texts = pc.replace_substring(texts, "\\", "\\\\")
    for c in CONTROL:
        texts = pc.replace_substring(texts, c, c[0] + "\\" + c[1:])
    return texts


def unescape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"(?s)\\(.)", r"\1")


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray]:
    """One buffer of all turns, the offsets of the turns, and where their texts begin.

    Lengths of the five segments of every turn give cumulative offsets; constant segments
    are written by broadcasting, roles and texts by scatter indices.
    """
    n = len(texts)
    sources = {1: utf8(roles), 3: utf8(texts)}
    lengths = np.zeros((n, 5), np.int64)
    for k, const in enumerate(_CONST):
        lengths[:, k] = len(const) if const is not None else np.diff(sources[k][1])
    ends = np.cumsum(lengths.ravel()).reshape(n, 5)
    begins = ends - lengths
    buffer = pa.allocate_buffer(int(ends[-1, -1]) if n else 0)
    out = np.frombuffer(buffer, np.uint8)
    for k, const in enumerate(_CONST):
        if const is not None:
            out[begins[:, k, None] + np.arange(len(const))] = const
        else:
            data, off = sources[k]
            out[np.repeat(begins[:, k] - off[:-1], np.diff(off)) + np.arange(len(data))] = data
    return buffer, np.concatenate([[0], ends[:, 4]]), begins[:, 3]


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, part, formatted, n_turns, loss): conversations in parts of bounded size.

    ``loss`` lists (start, length) in UTF-8 bytes of ``formatted``: the escaped texts of
    assistant turns and nothing between. Most conversations have one part; a longer one
    has several, in order, cut between turns, so no task holds more than a part. Turns go
    by number, then role and text, so repeated rows and ties have one order. A null role
    or text is empty, a null turn comes first, and rows with a null conversation are one
    conversation. An empty table gives an empty one, other columns are ignored.
    """
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    conv_type = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = object(), 0
        for batch in batches:
            for i, j in slices(batch.column("text"), PART_BYTES):
                conv, role, text = (batch.column(c).slice(i, j - i) for c in ("conv", "role", "text"))
                buffer, at, begin = assemble(escape(role), text := escape(text))
                keys = conv.to_pylist()
                new = np.array([k == 0 or keys[k] != keys[k - 1] for k in range(len(keys))])
                first = np.flatnonzero(new)
                bounds = np.append(first, len(keys))
                size = np.diff(utf8(text)[1])
                learnt = np.array([r == LEARNT_ROLE for r in role.to_pylist()])
                of = np.cumsum(new) - 1
                span = pa.StructArray.from_arrays(
                    [pa.array((begin - at[first][of])[learnt], pa.int64()), pa.array(size[learnt], pa.int64())],
                    names=["start", "length"],
                )
                spans = np.concatenate([[0], np.cumsum(learnt)])[bounds]
                numbers = np.zeros(len(first), np.int32)
                part = part + 1 if keys[0] == last else 0
                numbers[0] = part
                if len(first) > 1:
                    part = 0
                last = keys[-1]
                formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(at[bounds].astype(np.int64)), buffer)
                yield pa.RecordBatch.from_arrays(
                    [
                        conv.take(pa.array(first)),
                        pa.array(numbers),
                        formatted.cast(pa.string()),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(spans, pa.int32()), span),
                    ],
                    names=["conv", "part", "formatted", "n_turns", "loss"],
                )

    return (
        rows.repartition("conv")
        .sortWithinPartitions("conv", "turn", "role", "text")
        .mapInArrow(
            run, f"conv {conv_type}, part int, formatted string, n_turns long, loss array<struct<start:long,length:long>>"
        )
        .withColumnRenamed("conv", conv_col)
    )


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    turns = formatted.split("</s>")[:-1]
    parts = [t[len(OPEN) : -len("[/INST]")].split(MIDDLE, 1) for t in turns]
    flat = unescape(pa.array([x for p in parts for x in p], pa.string())).to_pylist()
    return list(zip(flat[::2], flat[1::2], strict=True))


def digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """A row for each conversation, read back from its formatted parts.

    (conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). The parts of
    a conversation must follow each other in a partition, as they are made.
    """
    names = ("conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    rows = formatted.withColumnRenamed(conv_col, "conv")
    conv_type = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if state is None or row["part"] == 0:
                    if state is not None:
                        done.append(state)
                    state = [row["conv"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = row["formatted"]
                for role, said in read_turns(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                raw = text.encode()
                spans = [raw[s["start"] : s["start"] + s["length"]].decode() for s in row["loss"]]
                for said in unescape(pa.array(spans, pa.string())).to_pylist():
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
            if done:
                yield _digest_rows(done, names, batch.schema.field("conv").type)
        if state is not None:
            yield _digest_rows([state], names, batch.schema.field("conv").type)

    return rows.mapInArrow(
        run,
        f"conv {conv_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    ).withColumnRenamed("conv", conv_col)


def _digest_rows(states: list[list], names: tuple[str, ...], conv_type: pa.DataType) -> pa.RecordBatch:
    types = (conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    columns = [[s[k].hexdigest() if k in (2, 4) else s[k] for s in states] for k in range(6)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names))
