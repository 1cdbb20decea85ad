"""Best-fit packing of tokenised documents into sequences of a fixed length.

A document's ids end with an end mark; one longer than a sequence is cut into
pieces of full length, of which the first may be shorter.  Packing is
bulk-synchronous best fit: pieces and gaps are sorted by size, every piece
looks for the smallest gap that holds it (its successor among the gaps), and
when several want one gap the larger piece, then the lower rank, gets it;
matched gaps shrink, and the next superstep begins.  Pieces that find no gap
open sequences of their own.

Sizes are integers from 1 to the sequence length, so all pieces of one size
(and all gaps of one size) form a run, and a superstep moves whole ranges of
ranks: the sweep works on at most ``max_len`` runs of each kind, however many
documents there are.  The documents themselves are ranked within their size
by distributed counts and never leave the tables.

Defined results: null or empty text is the end mark alone.  Rows with a null
id or repeated rows are packed like any other.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowspark.llm.common import by_bytes, byte_letters, slices, staged, text_or_empty

MAX_LEN = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
LONG = 1 << 20      # bytes of a text from which it is encoded by slices
_JOINT = re.compile(r"(?<=\S) (?=\S)")     # a single space: no token reaches across its left side
BUCKETS = 64        # shares in which the pieces of one size are ranked

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


class Encoder:
    """Ids of texts, by the vocabulary of a byte-level BPE tokenizer file.

    The vocabulary's splitter never joins a character before a single space
    with what follows it, so texts are encoded space by space, each distinct
    chunk of a batch once.  A text with other white space next to a space is
    encoded whole.  A text is cut at the file's added tokens first: each
    stands for its own id."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.added_at = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or "(?!)")
        ranks = {_token_bytes(t): i for t, i in vocabulary.items() if t not in self.added}
        self.encode = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.bytes_of[i] = len(token)

    def texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order; a long one is encoded by slices."""
        plain = np.ones(len(texts), bool)
        for token in self.added:
            plain &= pc.invert(pc.match_substring(texts, token)).to_numpy(zero_copy_only=False)
        plain &= pc.less(pc.binary_length(texts), LONG).to_numpy(zero_copy_only=False)
        ids = self.batch(texts.filter(pa.array(plain)))
        for k, easy in enumerate(plain.tolist()):
            yield next(ids) if easy else self.one(texts[k].as_py())

    def one(self, text: str) -> np.ndarray:
        """The ids of one text, by slices between added tokens."""
        out, at = [np.empty(0, np.uint32)], 0
        for m in [*self.added_at.finditer(text), None]:
            part = text[at:m.start()] if m else text[at:]
            for some in slices(part, _JOINT) if part else ():
                out += self.batch(pa.array([some], pa.string()))
            if m:
                out.append(np.array([self.added[m.group()]], np.uint32))
                at = m.end()
        return np.concatenate(out)

    def batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        pieces = pc.split_pattern(texts.cast(pa.large_string()), " ")
        at = pieces.offsets.to_numpy()
        coded = pieces.flatten().dictionary_encode()
        which, chunks = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        own = pc.and_(pc.equal(pc.utf8_trim_whitespace(chunks), chunks),
                      pc.greater(pc.binary_length(chunks), 0)).to_numpy(zero_copy_only=False)
        # all distinct chunks in one text; where each ends follows from the bytes of its ids
        alone = chunks.filter(pa.array(own))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(alone)], pa.int32()), alone),
                                pa.scalar(" ", pa.large_string()))[0].as_py()
        flat = np.array(self.encode(" " + joined) if len(alone) else [], np.uint32)
        length = pc.binary_length(alone).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ends = np.searchsorted(np.cumsum(self.bytes_of[flat]), np.cumsum(length)) + 1
        size, start = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        size[own] = np.diff(ends, prepend=0)
        start[own] = ends - size[own]
        for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            w = which[a + 1:b]   # the first chunk has no space before it
            first = chunks[which[a]].as_py()
            if first[-1:].isspace() or not own[w].all():
                yield np.array(self.encode(texts[k].as_py()), np.uint32)
                continue
            n = size[w]
            ends = np.cumsum(n)
            body = flat[np.repeat(start[w] - (ends - n), n) + np.arange(ends[-1])] if len(w) else flat[:0]
            yield np.concatenate([np.array(self.encode(first), np.uint32), body])


_BYTES = {letter: byte for byte, letter in enumerate(byte_letters())}


def _token_bytes(token: str) -> bytes:
    return bytes(_BYTES[c] for c in token)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One a worker process."""
    return Encoder(path)


def _cut(path: str, max_len: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(path)
        for batch in batches:
            for some in by_bytes(batch, 1):
                cols: list[list] = [[], [], [], [], [], []]
                for doc, ids in zip(some.column(0).to_pylist(), of.texts(some.column(1))):
                    ids = np.append(ids, end_id).astype("<u4")
                    n = len(ids)
                    starts = [0, *range(n % max_len or max_len, n, max_len)]
                    parts = [memoryview(ids[a:b]).cast("B") for a, b in zip(starts, [*starts[1:], n])]
                    cols[0] += [doc] * len(parts)
                    cols[1] += range(len(parts))
                    cols[2] += starts
                    cols[3] += [len(p) // 4 for p in parts]
                    cols[4] += map(zlib.crc32, parts)
                    cols[5] += [bytes(p) if keep_ids else None for p in parts]
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
    return run


def pieces(docs: DataFrame, tokenizer: str | None = None, max_len: int = MAX_LEN, end_id: int = END_ID,
           doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """The pieces of every document, with their ids if asked."""
    out = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
           .mapInArrow(_cut(tokenizer or default_tokenizer(), max_len, end_id, keep_ids), PIECES))
    return out if keep_ids else out.drop("ids")


def sweep(sizes: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, int, int, int, int]]:
    """Supersteps over runs of pieces (size -> how many) and of gaps.  Returns
    moves (length, first rank, how many, first sequence, offset): so many
    pieces of one size go to as many sequences in a row, at one offset."""
    left = {n: c for n, c in sizes.items() if c > 0 and 0 < n <= max_len}
    rank = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}   # gap size -> ranges of sequences (first, how many)
    moves, opened = [], 0

    def place(size: int, first: int, n: int, offset: int) -> None:
        moves.append((size, rank[size], n, first, offset))
        rank[size] += n
        left[size] -= n
        if offset + size < max_len:
            made.setdefault(max_len - offset - size, []).append((first, n))

    for size in sorted(left, reverse=True):     # larger pieces first
        while left[size]:
            made: dict[int, list[tuple[int, int]]] = {}
            order = sorted(gaps)
            at = bisect.bisect_left(order, size)   # the successor of the size among the gaps
            if at == len(order):
                # as many new sequences as the pieces of this size fill
                place(size, opened, n := -(-left[size] // (max_len // size)), 0)
                opened += n
            else:
                gap = order[at]
                runs = gaps.pop(gap)
                while runs and left[size]:         # lower ranks first
                    first, n = runs.pop(0)
                    take = min(n, left[size])
                    place(size, first, take, max_len - gap)
                    if take < n:
                        runs.insert(0, (first + take, n - take))
                if runs:
                    gaps[gap] = runs
            for g, runs in made.items():
                gaps.setdefault(g, []).extend(runs)
    return moves


def ranked(table: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """``table`` with ``rank``, its place among the pieces of its length, and
    how many there are of each length.  Ranks count within shares of a
    length first, so a length that many pieces have is spread over tasks."""
    share = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BUCKETS)).cast("int")
    table = table.withColumn("_share", share)
    counts = table.groupBy("length", "_share").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.toPandas().sort_values(["length", "_share"])   # at most max_len * BUCKETS
    rows["before"] = rows.groupby("length")["n"].cumsum() - rows["n"]
    spark = table.sparkSession
    offsets = spark.createDataFrame(
        pd.DataFrame({"length": rows["length"].astype("int64"), "_share": rows["_share"].astype("int32"),
                      "_before": rows["before"].astype("int64")}), "length long, _share int, _before long")
    w = W.partitionBy("length", "_share").orderBy("doc_id", "piece", "start", "ids_crc32")
    out = (table.withColumn("_r", F.row_number().over(w)).join(F.broadcast(offsets), ["length", "_share"])
           .withColumn("rank", F.col("_before") + F.col("_r") - 1).drop("_before", "_r", "_share"))
    return out, {int(k): int(v) for k, v in rows.groupby("length")["n"].sum().items()}


def pack(spark: SparkSession, table: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    rows, sizes = ranked(staged(spark, table, "pieces"))
    moves = pd.DataFrame(sweep(sizes, max_len), columns=["length", "_first", "_n", "_seq", "offset"], dtype="int64")
    plan = spark.createDataFrame(moves, "length long, _first long, _n long, _seq long, offset long")
    # a piece of a length has one move: the last that begins at or before its rank
    plan = plan.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("_first", "_n", "_seq", "offset"))).alias("_moves"))
    move = F.filter("_moves", lambda m: (m["_first"] <= F.col("rank")) & (F.col("rank") < m["_first"] + m["_n"]))[0]
    return (rows.join(F.broadcast(plan), "length").withColumn("_m", move)
            .withColumn("sequence_id", F.col("_m._seq") + F.col("rank") - F.col("_m._first"))
            .withColumn("offset", F.col("_m.offset")).drop("_m", "_moves", "rank"))


def pack_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Ids are recomputed where wanted: the digest keeps their crc32."""
    packed = pack(spark, pieces(docs))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
