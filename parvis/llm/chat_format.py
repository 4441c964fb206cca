"""Conversations as token ids with a loss mask, assembled from segments.

A turn is ``[INST] role [/INST] text </s>`` (without the blanks), where the three marks are
reserved ids beyond the vocabulary. Roles and texts are encoded on their own, so no mark can
come out of a text; the ids are spliced between the marks, and running sums of segment lengths
give their places and the mask, which covers the texts of one role and nothing else.

Control strings inside roles and texts are escaped, so that the decoded form can be read again
too: one more backslash after the first character of a control string, whether that has some
already or not; reading takes one away.

Turns are sorted over ranges of (conv_id, turn, digest), so one conversation may have any
number of turns. A row of the result holds whole turns of one conversation, up to about
``ROW_IDS`` ids; ``complete`` tells that it is the whole conversation.

A null turn comes first, ties of ``turn`` are ordered by the MD5 of role and text, null roles
and texts are empty, rows without ``conv_id`` form one conversation, repeated rows are turns of
their own. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, ordered_turns, per_row

OPEN, ROLE_END, TURN_END = "[INST]", "[/INST]", "</s>"
MARKS = (OPEN, ROLE_END, TURN_END)
CONTROLS = (*MARKS, "<s>", "<|endoftext|>", "<|im_start|>", "<|im_end|>")
"""Strings that a text must not show unescaped. Each starts with a character that none holds further on."""
ROW_IDS = 1 << 16
ROWS_AT_ONCE = 256


def _pattern(extra: str) -> str:
    """A first character of a control string with ``extra`` after it, before backslashes and the rest."""
    kinds: dict[str, list[str]] = {}
    for control in CONTROLS:
        kinds.setdefault(control[0], []).append(re.escape(control[1:]))
    return "|".join(rf"{re.escape(first)}{extra}(?=\\*(?:{'|'.join(rest)}))" for first, rest in kinds.items())


ESCAPE, UNESCAPE = re.compile(_pattern("")), re.compile(_pattern(r"\\"))


def escape(text: str) -> str:
    return ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(lambda m: m[0][0], text)


def default_vocabulary() -> tuple[str, str]:
    """Path of the ranks and the pattern that cuts texts."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encoding(vocabulary: tuple[str, str]):
    """One encoder per process."""
    import tiktoken

    held = sys.modules.setdefault("parvis_llm_encodings", types.ModuleType("parvis_llm_encodings")).__dict__
    if vocabulary not in held:
        with open(vocabulary[0], "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        held[vocabulary] = tiktoken.Encoding("own", pat_str=vocabulary[1], mergeable_ranks=ranks, special_tokens={})
    return held[vocabulary]


def assemble(encoded: list[tuple[list[int], list[int]]], trained: list[bool], first_mark: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, mask, end of each turn) of turns given as ids of role and text."""
    lengths = np.ones((len(encoded), 5), np.int64)
    lengths[:, 1] = [len(role) for role, _ in encoded]
    lengths[:, 3] = [len(text) for _, text in encoded]
    ends = np.cumsum(lengths).reshape(-1, 5)
    ids = np.empty(int(ends[-1, -1]), np.int32)
    marked = np.zeros(len(ids), bool)
    for column, mark in ((0, 0), (2, 1), (4, 2)):
        ids[ends[:, column] - 1] = first_mark + mark
        marked[ends[:, column] - 1] = True
    ids[~marked] = np.fromiter((i for turn in encoded for part in turn for i in part), np.int32, int((~marked).sum()))
    steps = np.zeros(len(ids) + 1, np.int64)
    chosen = np.array(trained, bool)
    np.add.at(steps, ends[chosen, 2], 1)
    np.add.at(steps, ends[chosen, 3], -1)
    return ids, np.cumsum(steps)[:-1] > 0, ends[:, -1]


def format_conversations(
    conversations: DataFrame, trained_role: str = "assistant", vocabulary: tuple[str, str] | None = None
) -> DataFrame:
    """(conv_id, part, nth, complete, ids, mask): rows of whole turns, in order by part and nth."""
    chosen = vocabulary or default_vocabulary()
    turns = ordered_turns(conversations, F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    names = ["conv_id", "part", "nth", "complete", "ids", "mask"]

    def run(batches: Batches) -> Batches:
        encoder, part = encoding(chosen), TaskContext.get().partitionId()
        id_type, held, rows = None, [], []
        who, size, nth, first, starts_here = None, 0, 0, True, False

        def row(ended: bool) -> None:
            """Close the row at hand; ``ended`` tells that its conversation ends here for certain."""
            nonlocal held, size, nth
            ids, mask = [np.concatenate([h[i] for h in held]) for i in (0, 1)]
            rows.append((who, part, nth, starts_here and ended, ids, mask))
            held, size, nth = [], 0, nth + 1

        def out() -> pa.RecordBatch:
            nonlocal rows
            convs, parts, numbers, complete, ids, masks = zip(*rows)
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            made = [
                pa.array(convs, id_type),
                pa.array(parts, pa.int64()),
                pa.array(numbers, pa.int64()),
                pa.array(complete),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids))),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(masks))),
            ]
            rows = []
            return pa.RecordBatch.from_arrays(made, names)

        for whole in batches:
            id_type = whole.schema.field("conv_id").type
            for low in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(low, ROWS_AT_ONCE)
                convs, roles, texts = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]
                encoded = [
                    (encoder.encode_ordinary(escape(r)), encoder.encode_ordinary(escape(t))) for r, t in zip(roles, texts)
                ]
                ids, mask, ends = assemble(encoded, [r == trained_role for r in roles], encoder.n_vocab)
                before = 0
                for conv, end in zip(convs, ends.tolist()):
                    if first or conv != who:
                        if held:
                            row(True)
                        # The first conversation of a task may have begun in another one.
                        who, starts_here, first = conv, not first, False
                    elif size > ROW_IDS:
                        row(False)
                        starts_here = False
                    held.append((ids[before:end], mask[before:end]))
                    size += end - before
                    before = end
                if rows:
                    yield out()
        if held:
            row(False)
        if rows:
            yield out()

    conv = conversations.schema["conv_id"].dataType.simpleString()
    return turns.mapInArrow(run, f"conv_id {conv}, part long, nth long, complete boolean, ids array<int>, mask array<boolean>")


def _spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return steps[::2], steps[1::2]


def read_back(formatted: DataFrame, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from ids and masks alone.

    Rows are decoded where they are. What is complete is hashed there too; of the others the
    decoded bytes go on, to one task per conversation that hashes them in order, row by row.
    """
    chosen = vocabulary or default_vocabulary()
    kept = ["conv_id", "part", "nth", "complete"]
    made = ["n_turns", "turns", "loss_chars", "loss", "formatted_chars"]

    def decode():
        encoder = encoding(chosen)
        first_mark = encoder.n_vocab

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            complete = batch.column("complete").to_pylist()
            for i in range(batch.num_rows):
                ids = np.asarray(batch.column("ids")[i].values)
                mask = np.asarray(batch.column("mask")[i].values.to_numpy(zero_copy_only=False))

                def segment(low, high):
                    return encoder.decode_bytes(ids[low:high].tolist()).decode("utf-8")

                places = [np.flatnonzero(ids == first_mark + mark) for mark in range(3)]
                turns, shown = [], sum(map(len, MARKS)) * len(places[0])
                for opened, role_end, turn_end in zip(*[p.tolist() for p in places]):
                    for low, high in ((opened + 1, role_end), (role_end + 1, turn_end)):
                        part = segment(low, high)
                        shown += len(part)
                        turns.append(unescape(part) + "\n")
                loss = "".join(unescape(segment(low, high)) for low, high in zip(*[x.tolist() for x in _spans(mask)]))
                content = ["".join(turns).encode(), loss.encode()]
                if complete[i]:
                    content = [hashlib.sha256(c).hexdigest().encode() for c in content]
                rows.append((len(places[0]), content[0], len(loss), content[1], shown))
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *columns], [*kept, *made])

        return work

    conv = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {conv}, part long, nth long, complete boolean, n_turns long, turns binary, loss_chars long, loss binary, formatted_chars long"
    parts = per_row(formatted, schema, decode).repartition("conv_id").sortWithinPartitions("conv_id", "part", "nth")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Batches) -> Batches:
        at, id_type = None, None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        def summary() -> tuple:
            who, n, turns, chars, loss, shown = at
            return who, n, turns.hexdigest(), chars, loss.hexdigest(), shown

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            done = []
            for conv, complete, n, turns, chars, loss, shown in zip(
                *[batch.column(c).to_pylist() for c in ("conv_id", "complete", *made)]
            ):
                if complete:
                    done.append((conv, n, turns.decode(), chars, loss.decode(), shown))
                elif at is not None and at[0] == conv:
                    at = (conv, at[1] + n, at[2], at[3] + chars, at[4], at[5] + shown)
                    at[2].update(turns)
                    at[4].update(loss)
                else:
                    if at is not None:
                        done.append(summary())
                    at = (conv, n, hashlib.sha256(turns), chars, hashlib.sha256(loss), shown)
            if done:
                yield out(done)
        if at is not None:
            yield out([summary()])

    return parts.mapInArrow(run, f"conv_id {conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
