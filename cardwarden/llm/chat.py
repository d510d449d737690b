"""Chat formatting: conversations as text for training, with the spans that the loss covers.

Each turn becomes ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line feed. Control strings inside roles and texts
get a backslash after their first character, and backslashes are doubled, so that reading back
gives the same turns. A batch of sorted turns is put together at once: numpy turns the lengths
of headers and contents into offsets, and copies all bytes into one buffer that becomes the
Arrow column.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.words import buffers, filled, slices

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: Strings that a tokenizer may read as control marks. None begins with a character that another has inside.
CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]")
#: The role whose text the loss covers.
TRAINED = "assistant"
#: A conversation is cut into parts, at turns, once a part has so many bytes.
PART_BYTES = 1 << 20
PARTS = "conv_id bigint, part bigint, n_turns bigint, formatted string, loss_starts array<bigint>, loss_lengths array<bigint>"


def escape(column: pa.Array) -> pa.Array:
    """The texts without any control string."""
    column = pc.replace_substring(column, "\\", "\\\\")
    for control in CONTROLS:
        column = pc.replace_substring(column, control, f"{control[0]}\\{control[1:]}")
    return column


def unescape(text: str) -> str:
    """What ``escape`` was given. A backslash stands for the character after it."""
    if "\\" not in text:
        return text
    pieces = text.split("\\\\")
    return "\\".join(p.replace("\\", "") for p in pieces)


def assemble(roles: pa.Array, texts: pa.Array, ends: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Formatted parts, and for each turn where its text starts in its part and how many bytes it has.

    ``ends`` holds the number of the first turn after each part. Turn i is made of five
    segments; their lengths give the offset of each one, and one scatter copies the bytes of
    all roles and one those of all texts.
    """
    role_bytes, role_at = buffers(escape(roles))
    text_bytes, text_at = buffers(escape(texts))
    fixed = [np.frombuffer(x.encode(), np.uint8) for x in (START, MIDDLE, END)]
    n = len(roles)
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = (len(x) for x in fixed)
    lengths[:, 1], lengths[:, 3] = np.diff(role_at), np.diff(text_at)
    offsets = np.concatenate([[0], np.cumsum(lengths.ravel())])
    at = offsets[:-1].reshape(n, 5)
    out = np.empty(offsets[-1], np.uint8)
    for column, mark in zip((0, 2, 4), fixed, strict=True):
        out[(at[:, column, None] + np.arange(len(mark))).ravel()] = np.tile(mark, n)
    for column, data, start in ((1, role_bytes, role_at), (3, text_bytes, text_at)):
        target = np.arange(len(data)) + np.repeat(at[:, column] - start[:-1], lengths[:, column])
        out[target] = data
    turn_at = offsets[::5]
    part_at = turn_at[np.concatenate([[0], ends])]
    made = pa.Array.from_buffers(pa.large_string(), len(ends), [None, pa.py_buffer(part_at), pa.py_buffer(out)])
    begins = np.repeat(part_at[:-1], np.diff(np.concatenate([[0], ends])))
    return made, at[:, 3] - begins, lengths[:, 3]


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the conversations, for turns sorted by conversation. A conversation that goes on gets another part."""
    last: tuple = ()
    part = 0
    for batch in slices(batches, "text", 8 * PART_BYTES):
        ids = batch.column("conv_id").to_pylist()
        roles, texts = filled(batch.column("role")), filled(batch.column("text"))
        turn_bytes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        ends, numbers, names, inside = [], [], [], 0
        for i, conv in enumerate(ids):
            if last != (conv,):
                last, part, inside = (conv,), 0, 0
            elif i == 0 or inside >= PART_BYTES:
                part, inside = part + 1, 0
            inside += int(turn_bytes[i])
            if not numbers or (conv, part) != (names[-1], numbers[-1]):
                if numbers:
                    ends.append(i)
                names.append(conv)
                numbers.append(part)
        ends.append(len(ids))
        ends = np.array(ends, np.int64)
        made, starts, lengths = assemble(roles, texts, ends)
        trained = pc.equal(roles, TRAINED).to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(trained)])[np.concatenate([[0], ends])].astype(np.int32)
        yield pa.record_batch(
            {
                "conv_id": pa.array(names, pa.int64()),
                "part": pa.array(numbers, pa.int64()),
                "n_turns": pa.array(np.diff(np.concatenate([[0], ends]))),
                "formatted": made.cast(pa.string()),
                "loss_starts": pa.ListArray.from_arrays(before, pa.array(starts[trained])),
                "loss_lengths": pa.ListArray.from_arrays(before, pa.array(lengths[trained])),
            }
        )


def format_conversations(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, part, n_turns, formatted, loss_starts, loss_lengths) for rows (conv_id, turn, role, text).

    A conversation of ordinary length is one row; longer ones go on in parts 1, 2 and so on,
    each whole turns, whose concatenation is the conversation. Spans count the bytes of their
    part and hold the escaped text of each assistant turn. Turns are in order of ``turn``, nulls first; equal
    ones, and repeated rows, in order of role and text. A null role or text is empty; rows with
    a null conv_id are one conversation. Other columns are ignored. An empty table gives none.

    Turns are dealt by conversation, and each task reads its sorted turns as a stream, so that
    memory doesn't grow with the longest conversation.
    """
    tidy = turns.select(F.col("conv_id").cast("bigint"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return tidy.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_format, PARTS)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of a formatted part."""
    for turn in formatted.split(START)[1:]:
        role, _, text = turn.removesuffix(END).partition(MIDDLE)
        yield unescape(role), unescape(text)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    now: tuple = ()
    turns = loss = sha256()
    counts = [0, 0, 0]
    for batch in batches:
        for conv, n, text, starts, lengths in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "n_turns", "formatted", "loss_starts", "loss_lengths")), strict=True):
            if now != (conv,):
                if now:
                    rows.append((*now, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))
                now, turns, loss, counts = (conv,), sha256(), sha256(), [0, 0, 0]
            data = text.encode()
            read = list(read_turns(text))
            if len(read) != n:
                raise ValueError(f"conversation {conv}: {n} turns were written, {len(read)} read")
            turns.update("".join(f"{role}\n{said}\n" for role, said in read).encode())
            covered = [unescape(data[a : a + k].decode()) for a, k in zip(starts, lengths, strict=True)]
            loss.update("".join(covered).encode())
            counts = [counts[0] + n, counts[1] + sum(map(len, covered)), counts[2] + len(text)]
        yield _digests(rows)
        rows = []
    if now:
        yield _digests([(*now, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2])])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64()}
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def conversation_digests(parts: DataFrame) -> DataFrame:
    """What reading the parts back gives, one row per conversation.

    Parts must come from ``format_conversations`` as they are, since a conversation's parts
    are read as a stream.
    """
    kinds = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return parts.mapInArrow(_digest, kinds)
