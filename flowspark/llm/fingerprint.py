"""Document fingerprints from improbable features.

Every window of ``WINDOW`` bytes has a rarity: the information, in the
entropy sense, of its bytes, each given the one before, under byte-pair
counts over all documents.  Windows are ranked by rarity, and a window is
selected where no other within ``REACH`` bytes is rarer; the choice hangs on
the content only, so the same passage gives the same features wherever it
stands.  A feature sets ``HASHES`` bits of a Bloom filter of ``BITS`` bits;
after ``PER_FILTER`` features the next filter of the chain begins.  Two
chains are compared by bit overlap: for each filter of the shorter chain the
best of the other, less what chance gives two filters of so many bits,
normalised by the most that is possible.

Defined results: null text counts as empty; an empty text has an empty
fingerprint, alike (1) to another empty one and unlike (0) to all else; a
text shorter than a window is one feature.  Equal texts have equal
fingerprints.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.common import partitions, text_or_empty

WINDOW = 64
REACH = 32
BITS, HASHES, PER_FILTER = 2048, 5, 160
_AT_ONCE = 1 << 20  # characters that a task fingerprints together
_SCALE = 1024       # rarity in 1/1024 bit, so that sums are exact
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_BASE, i, 1 << 64) for i in range(WINDOW)], np.uint64)


def _pairs(raw: np.ndarray) -> np.ndarray:
    return raw[:-1].astype(np.int32) * 256 + raw[1:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(65_536, np.int64)
    for batch in batches:
        for text in batch.column(0):
            raw = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid and len(text.as_buffer()) else np.empty(0, np.uint8)
            if len(raw) > 1:
                total += np.bincount(_pairs(raw), minlength=65_536)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["pair", "n"])


def rarity_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Information of each byte given the one before: 65,536 numbers."""
    rows = (docs.select(F.col(text).cast("string").alias("text")).mapInArrow(_count, "pair int, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")).toPandas())
    n = np.ones(65_536)
    n[rows["pair"].to_numpy(np.int64)] += rows["n"].to_numpy(float)
    n = n.reshape(256, 256)
    return np.round(-np.log2(n / n.sum(1, keepdims=True)) * _SCALE).astype(np.int64).ravel()


def _sliding_max(x: np.ndarray, width: int) -> np.ndarray:
    """Largest of x[i:i + width] for every i."""
    n = len(x) - width + 1
    block = np.full(-(-len(x) // width) * width, np.iinfo(np.int64).min)
    block[:len(x)] = x
    block = block.reshape(-1, width)
    ahead = np.maximum.accumulate(block, axis=1).ravel()
    back = np.maximum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.maximum(back[:n], ahead[width - 1:width - 1 + n])


def _selected(raw: np.ndarray, ends: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Places of the selected windows of texts that stand in a row.  Windows
    over the end of a text do not count; as a window is longer than REACH,
    none is compared to a window of another text."""
    least = np.iinfo(np.int64).min
    sums = np.concatenate([[0], np.cumsum(rarity[_pairs(raw)])])
    rank = sums[WINDOW - 1:] - sums[:len(sums) - WINDOW + 1]
    over = np.zeros(len(raw) + 1, np.int64)
    np.add.at(over, np.maximum(np.concatenate([[0], ends[:-1]]), ends - WINDOW + 1), 1)
    np.add.at(over, ends, -1)
    rank = np.where(np.cumsum(over)[:len(rank)] > 0, least, rank)
    low = np.full(REACH, least)
    top = _sliding_max(np.concatenate([low, rank, low]), 2 * REACH + 1)
    before = _sliding_max(np.concatenate([low, rank]), REACH)[:len(rank)]
    return np.flatnonzero((rank == top) & (rank > before))   # the first of equals


def chains(texts: list[bytes], rarity: np.ndarray) -> list[np.ndarray]:
    """The Bloom filters of each text, one packed row each."""
    size = np.array([len(t) for t in texts], np.int64)
    raw, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size)
    at = _selected(raw, ends, rarity) if len(raw) >= WINDOW else np.empty(0, np.int64)
    short = np.flatnonzero((size > 0) & (size < WINDOW))
    windows = np.zeros((len(at) + len(short), WINDOW), np.uint64)
    windows[:len(at)] = raw[at[:, None] + np.arange(WINDOW)].astype(np.uint64) + np.uint64(1)
    for k, i in enumerate(short, len(at)):
        windows[k, :size[i]] = np.frombuffer(texts[i], np.uint8).astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        h = (windows * _POWERS).sum(1, dtype=np.uint64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        h ^= h >> np.uint64(31)
    text = np.concatenate([np.searchsorted(ends, at, "right"), short])
    n = np.bincount(text, minlength=len(texts))
    order = np.argsort(text, kind="stable")
    h, text = h[order], text[order]
    filters = -(-n // PER_FILTER)
    first = np.cumsum(filters) - filters
    row = first[text] + (np.arange(len(h)) - (np.cumsum(n) - n)[text]) // PER_FILTER
    bits = np.zeros((int(filters.sum()), BITS), bool)
    for k in range(HASHES):
        bits[row, (h >> np.uint64(11 * k)).astype(np.int64) % BITS] = True
    packed = np.packbits(bits, axis=1)
    return [packed[a:a + c] for a, c in zip(first.tolist(), filters.tolist())]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Normalised bit overlap of two chains, 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    wide, other = a.view(np.uint64), b.view(np.uint64)
    na, nb = (np.bitwise_count(x).sum(1, dtype=np.int64).astype(float) for x in (wide, other))
    total = 0.0
    for row, n in zip(wide, na):
        shared = np.bitwise_count(other & row).sum(1, dtype=np.int64)
        chance, most = n * nb / BITS, np.minimum(n, nb)
        total += float(np.max(np.where(most > chance, (shared - chance) / np.maximum(most - chance, 1e-9), shared == most)))
    return min(max(total / len(a), 0.0), 1.0)


def as_text(filters: np.ndarray) -> str:
    return base64.b64encode(filters.tobytes()).decode()


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the next."""
    n = len(text) // 2
    return text[:len(text) - n] + following[:n]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _walk(rarity: np.ndarray):
    schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[t])
                        for n, t in (x.split() for x in RESULT.split(", "))])

    def coded(text: str) -> bytes:
        return text.encode("utf-8", "surrogatepass")

    def rows_of(rows: list[tuple], known: np.ndarray | None) -> tuple[list[tuple], np.ndarray]:
        """Results of all rows but the last, and the last one's chain."""
        follows = [a[0] == b[0] and not a[1] for a, b in zip(rows, rows[1:])]
        new = [edited(a[3], b[3]) if f else "" for f, a, b in zip(follows, rows, rows[1:])]
        texts = [coded(r[3]) for r in rows[known is not None:]] + [coded(t) for t in new]
        made = chains(texts, rarity)
        own = ([known] if known is not None else []) + made
        own, changed = own[:len(rows)], made[len(made) - len(new):]
        out = [(a[2], len(a[3]), hashlib.sha256(coded(t)).hexdigest(), as_text(p), as_text(c), likeness(p, c), likeness(p, q))
               for f, a, t, p, c, q in zip(follows, rows, new, own, changed, own[1:]) if f]
        return out, own[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = [], None    # rows not yet done; the chain of the first, if known
        ended = None              # share whose head has been seen
        for batch in batches:
            out, size = [], 0
            for row in zip(*(batch.column(c).to_pylist() for c in ("share", "head", "doc_id", "text"))):
                if row[1] and (ended == row[0] or not held or held[-1][0] != row[0]):
                    continue      # a further row with the id of the head
                if row[1]:
                    ended = row[0]
                held.append(row)
                size += len(row[3])
                if size > _AT_ONCE and len(held) > 1:
                    done, known = rows_of(held, known)
                    out += done
                    held, size = held[-1:], 0
            if len(held) > 1:
                done, known = rows_of(held, known)
                out += done
                held = held[-1:]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return run


def in_order(spark: SparkSession, docs: DataFrame, shares: int | None = None, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(share, head, key, doc_id, text): documents dealt by descending id
    into shares, each followed by the first document of the next share (of
    the first, after the last).  Ids without value come last."""
    shares = shares or 4 * partitions(spark)
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(key.alias("key"), F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    cuts = rows.agg(F.percentile_approx("key", [i / shares for i in range(1, shares)], 10_000)).first()[0] or []
    above = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<bigint>")
    rows = rows.withColumn("share", F.size(F.filter(above, lambda c: c > F.col("key"))))
    # at most one row a share: its first id, and the share before it
    first = [(r["share"], r["key"]) for r in rows.groupBy("share").agg(F.max("key").alias("key")).orderBy("share").collect()]
    heads = spark.createDataFrame([(k, first[i - 1][0]) for i, (_, k) in enumerate(first)], "key long, to int")
    head_rows = (rows.join(F.broadcast(heads), "key").groupBy("key", "doc_id", "to").agg(F.min("text").alias("text"))
                 .select(F.col("to").alias("share"), F.lit(True).alias("head"), "key", "doc_id", "text"))
    return rows.select("share", F.lit(False).alias("head"), "key", "doc_id", "text").unionByName(head_rows)


def fingerprint_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Each document with its own and its edited text's fingerprint, compared
    to each other and to the next document by descending id (ties by text)."""
    rarity = rarity_table(docs)
    return (in_order(spark, docs).repartition(partitions(spark), "share")
            .sortWithinPartitions("share", "head", F.col("key").desc(), "text")
            .select("share", "head", "doc_id", "text").mapInArrow(_walk(rarity), RESULT))
