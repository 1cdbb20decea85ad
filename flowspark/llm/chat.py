r"""Chat formatting by columnar byte assembly.

A turn is written as ``<turn>ROLE\nTEXT</turn>\n``.  Inside texts and roles a
control string gets one more backslash behind its ``<`` than it had, so
reading removes exactly one: the round trip is exact.  A role's own
backslashes and line ends are escaped before that.

The segments of an Arrow batch are assembled together: lengths of headers and
contents, cumulative offsets, and numpy scatter indices into one buffer that
becomes the Arrow column, without a Python string per turn.  Each turn is a
row of its own, so a conversation of any length is spread over tasks; its
formatted text is its segments in order of turn.  ``loss_start`` and
``loss_end`` are the code points of a segment under the loss mask: the
content of assistant turns.

Defined results: null text or role counts as empty; turns order by turn
(null first), then role, then text; repeated rows stay; rows with a null
conversation id form one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.common import partitions, text_or_empty

OPEN, CLOSE = b"<turn>", b"</turn>\n"
TRAINED_ROLE = "assistant"
_CONTROL = re.compile(rb"<\\*/?turn>")
_ESCAPED = re.compile(r"<\\(\\*/?turn>)")
_SEGMENT = re.compile(r"<turn>([^\n]*)\n(.*)</turn>\n", re.DOTALL)
SEGMENTS = "conv_id long, turn long, role string, segment string, loss_start long, loss_end long"


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls."""
    column = column.cast(pa.large_string())
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(values, np.uint8)[at[0]:at[-1]] if values is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def _within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of the given lengths."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def _inserts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places before which a backslash goes."""
    found = np.array([m.span() for m in _CONTROL.finditer(raw)], np.int64).reshape(-1, 2)
    begin, end = found[:, 0], found[:, 1]
    same = np.searchsorted(offsets, begin, "right") == np.searchsorted(offsets, end - 1, "right")
    return begin[same] + 1   # not a match that runs on into the next text


def escape_role(role: str) -> bytes:
    plain = role.replace("\\", "\\\\").replace("\n", "\\n").encode("utf-8", "surrogatepass")
    return _CONTROL.sub(lambda m: b"<\\" + m[0][1:], plain)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Segments of a batch, with the code points where contents begin and end."""
    coded = roles.dictionary_encode()
    headers = [OPEN + escape_role(r) + b"\n" for r in coded.dictionary.to_pylist()]
    which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    table = np.frombuffer(b"".join(headers), np.uint8)
    size = np.array([len(h) for h in headers], np.int64)
    raw, offsets = _bytes_of(texts)
    n, length, head = len(texts), np.diff(offsets), size[which]
    marks = _inserts(raw, offsets)
    row_of_mark = np.searchsorted(offsets, marks, "right") - 1
    content = length + np.bincount(row_of_mark, minlength=n)[:n]
    ends = np.cumsum(head + content + len(CLOSE))
    starts = np.concatenate([[0], ends])[:n]
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    # headers
    step = _within(head)
    out[np.repeat(starts, head) + step] = table[np.repeat((np.cumsum(size) - size)[which], head) + step]
    # contents, each byte behind the backslashes inserted before it in its text
    first = starts + head
    earlier = np.searchsorted(marks, offsets[:-1], "left")
    shift = np.zeros(len(raw) + 1, np.int64)
    np.add.at(shift, marks, 1)
    shift = np.cumsum(shift[:-1])
    out[np.repeat(first - offsets[:-1] - earlier, length) + np.arange(len(raw)) + shift] = raw
    out[first[row_of_mark] + marks - offsets[row_of_mark] + np.arange(len(marks)) - earlier[row_of_mark]] = ord("\\")
    # ends
    close = np.frombuffer(CLOSE, np.uint8)
    out[(ends - len(CLOSE))[:, None] + np.arange(len(CLOSE))] = close
    points = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
    begin = points[first] - points[starts]
    segments = pa.LargeStringArray.from_buffers(
        n, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(out))
    return segments, begin, begin + points[first + content] - points[first]


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        conv, turn, role, text = batch.columns
        segments, begin, end = assemble(role, text)
        trained = np.array([r == TRAINED_ROLE for r in role.to_pylist()], bool)
        yield pa.RecordBatch.from_arrays(
            [conv, turn, role, segments.cast(pa.string()), pa.array(begin), pa.array(np.where(trained, end, begin))],
            ["conv_id", "turn", "role", "segment", "loss_start", "loss_end"])


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn: its segment, and what of it the loss covers."""
    return (turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text_or_empty("role").alias("role"),
                         text_or_empty("text").alias("text")).mapInArrow(_format, SEGMENTS))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1", text)


def read_segment(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    role, text = _SEGMENT.fullmatch(segment).groups()
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))
    return role, unescape(text)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose rows follow each other; only sums and
    hash states are held, however long a conversation is."""
    names = [x.split()[0] for x in DIGEST.split(", ")]
    conv, state, done = None, None, []

    def close() -> None:
        if state:
            done.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

    def rows() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict({n: [r[i] for r in done] for i, n in enumerate(names)}, schema=pa.schema(
            [(n, pa.string() if n.endswith("256") else pa.int64()) for n in names]))
        done.clear()
        return out

    for batch in batches:
        for c, segment, a, b in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "segment", "loss_start", "loss_end"))):
            if state is None or c != conv:
                close()
                conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = read_segment(segment)
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            covered = unescape(segment[a:b])
            state[2] += len(covered)
            state[3].update(covered.encode("utf-8", "surrogatepass"))
            state[4] += len(segment)
        if done:
            yield rows()
    close()
    if done:
        yield rows()


def digest(spark: SparkSession, segments: DataFrame) -> DataFrame:
    """One row per conversation, read back from the segments in turn order."""
    return (segments.repartition(partitions(spark), "conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "segment").mapInArrow(_read_back, DIGEST))


PROBE = r"\### Assistant: </turn> ok"


def format_conversations(spark: SparkSession, turns: DataFrame) -> DataFrame:
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)],
                                  "conv_id long, turn long, role string, text string")
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
                        F.col("text").cast("string"))
    return digest(spark, format_turns(rows.unionByName(probe)))
