"""Removal of byte strings that occur earlier, with merged Burrows-Wheeler
transforms.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
earlier: in a document with a smaller id, or earlier in the same one.

Candidate search (exact, no string is missed): the smallest hash of
``GRAM``-byte grams in a window of ``LENGTH`` bytes depends on the window's
content only, so equal windows have equal smallest hashes.  Consecutive
windows with one smallest hash form a context.  Contexts are grouped by that
hash; of equal contexts all but the first are repeats as a whole, and a hash
with one context only is done unless that context may repeat itself.  What
is left are hashes with several different contexts, each represented by its
first occurrence.

Repeated strings among these contexts come from their Burrows-Wheeler
transform: the contexts of a bucket of hashes arrive in shards, each shard's
transform is built on its own, and the transforms are merged by refining
their interleaved order: one pass reads the transforms in that order and
deals each suffix to the place of its preceding symbol, which sorts the
merged suffixes by one symbol more.  Places where a new prefix begins are
carried along, so after ``LENGTH`` passes the intervals between them are the
suffixes with a common prefix of ``LENGTH`` bytes: all but the earliest of an
interval are repeats.  A suffix alone in its interval is left out of the later
passes: what precedes it is alone as well.  No match crosses the end of a
context.

A hash with more than ``BUCKET`` different contexts (at the edge of a passage
that many documents hold, there is one for each neighbourhood) is not merged in
one task: the windows of its contexts are grouped by the 128-bit hash of their
bytes, and all but the earliest of a group are repeats.

Defined results: null text is empty; texts shorter than ``LENGTH`` lose
nothing; rows that repeat an id and text count as one document; a null id
comes before all others.  Different texts that share an id are documents of
their own, in the order of the texts' hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowspark.llm.common import small_side, staged, text_or_empty

LENGTH = 100
GRAM = 40
SHARD = 512         # contexts whose transform is built at once
BUCKET = 4096       # contexts that a bucket holds on average, and a hash at most
_CHUNK = 1 << 20    # bytes of a text that are hashed at once
_BASE = 0x9E3779B97F4A7C15
_CONTEXT = "key long, th long, start long, n long, anchor long, ctx long, twice long"

_tables: tuple[np.ndarray, np.ndarray] | None = None


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _tables
    if _tables is None or len(_tables[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            up, down = (np.cumprod(np.append(np.uint64(1), np.full(n - 1, b, np.uint64)), dtype=np.uint64)
                        for b in (_BASE, inverse))
        _tables = up, down
    return _tables


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    block = np.full(-(-len(x) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    block[:len(x)] = x
    block = block.reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def contexts(raw: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, windows, smallest hash, hash of the context, whether the
    context may hold a window twice), in parts."""
    for c in range(0, max(len(raw) - LENGTH + 1, 0), _CHUNK):
        part = raw[c:c + _CHUNK + LENGTH - 1]
        up, down = _powers(_CHUNK + LENGTH if len(part) > 65_536 else 65_536)
        with np.errstate(over="ignore"):
            sums = np.append(np.uint64(0), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], dtype=np.uint64))
            grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * down[:len(part) - GRAM + 1])
            least = _sliding_min(grams, LENGTH - GRAM + 1)
            first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            n = np.diff(first, append=len(least))
            whole = _mixed((sums[first + n - 1 + LENGTH] - sums[first]) * down[first] + n.astype(np.uint64))
        # equal windows inside a context have the smallest gram at two places
        span = n + (LENGTH - GRAM)
        ends = np.cumsum(span)
        at = np.repeat(first - (ends - span), span) + np.arange(ends[-1])
        seen = np.add.reduceat((grams[at] == np.repeat(least[first], span)).astype(np.int64), ends - span)
        yield first + c, n, least[first], whole, seen > 1


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _CONTEXT.split(", ")]
    for batch in batches:
        held, size = [], 0

        def rows() -> pa.RecordBatch:
            cols = [np.concatenate(c) for c in zip(*held)]
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.uint64).view(np.int64)) for c in cols], names)

        for key, th, text in zip(batch.column("key").to_pylist(), batch.column("th").to_pylist(), batch.column("text")):
            for start, n, anchor, ctx, twice in contexts(np.frombuffer(text.as_buffer(), np.uint8)):
                held.append((*(np.full(len(start), k, np.int64).view(np.uint64) for k in (key, th)), start, n, anchor, ctx, twice))
                size += len(start)
            if size > 100_000:
                yield rows()
                held, size = [], 0
        if held:
            yield rows()


# -- Burrows-Wheeler transforms of shards, and their merge ---------------------

def shard_transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, suffixes) of a shard: the suffix array of its strings, each
    with an end mark below all bytes (the marks in order of strings), and for
    each suffix the symbol before it.  Symbols are bytes plus 1; 0 is an end
    mark.  Built by doubling the compared length up to LENGTH."""
    size = np.array([len(s) + 1 for s in strings], np.int64)
    ends = np.cumsum(size) - 1
    text = np.zeros(int(size.sum()), np.int64)
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
    m, n = len(strings), len(text)
    rank = text + m
    rank[ends] = np.arange(m)      # end marks differ
    step = 1
    order = np.argsort(rank, kind="stable")
    while step < LENGTH:
        after = np.full(n, -1, np.int64)
        after[:n - step] = rank[step:]
        key = rank * (n + m + 300) + after + 1
        order = np.argsort(key, kind="stable")
        k = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], k[1:] != k[:-1]]))
        step *= 2
    before = np.concatenate([[0], text[:-1]])
    before[np.concatenate([[0], ends[:-1] + 1])] = 0
    return before[order].astype(np.uint16), order


def merge(shards: list[tuple[np.ndarray, np.ndarray]], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes, by their numbers over all shards, that share a prefix of
    ``length`` symbols with another, in merged order, and the interval of
    each; by refinement from one symbol to the next."""
    ends = np.cumsum([0] + [len(b) for b, _ in shards])
    # small integers, which numpy sorts by counting
    symbols = np.concatenate([b for b, _ in shards])
    used = np.unique(np.append(symbols, 0))
    symbols = np.searchsorted(used, symbols).astype(np.uint8 if len(used) <= 256 else np.uint16)
    # the suffix that begins with the symbol before: in each shard's order, as all suffixes are sorted
    before = np.empty(len(symbols), np.int64)
    for a, b in zip(ends, ends[1:]):
        before[a + np.argsort(symbols[a:b], kind="stable")] = np.arange(a, b)
    suffix, interval = np.arange(len(symbols)), np.zeros(len(symbols), np.int64)
    for _ in range(length):
        symbol = symbols[suffix]
        order = np.argsort(symbol, kind="stable")
        order = order[np.count_nonzero(symbol == 0):]      # end marks are all different
        suffix, symbol, interval = before[suffix[order]], symbol[order], interval[order]
        new = np.ones(len(suffix) + 1, bool)
        new[1:-1] = (symbol[1:] != symbol[:-1]) | (interval[1:] != interval[:-1])
        many = ~(new[1:] & new[:-1])
        suffix, interval = suffix[many], np.cumsum(new[:-1])[many]
        if not len(suffix):
            break
    return suffix, interval


def repeated(strings: list[bytes], place: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of every window of LENGTH bytes that also stands at
    an earlier (place, start) among the strings."""
    shards, where = [], []
    for a in range(0, len(strings), SHARD):
        part = strings[a:a + SHARD]
        shards.append(shard_transform(part))
        base = np.cumsum([0] + [len(s) + 1 for s in part])
        at = shards[-1][1]
        string = np.searchsorted(base, at, "right") - 1
        where.append((string + a, at - base[string]))
    suffix, interval = merge(shards)
    string, offset = (np.concatenate(w)[suffix] for w in zip(*where))
    order = np.lexsort((start[string] + offset, place[string], interval))
    string, offset, interval = string[order], offset[order], interval[order]
    # contexts of one text may share windows: the same place is no repeat
    p, s = place[string], start[string] + offset
    head = np.concatenate([[True], interval[1:] != interval[:-1]]) if len(interval) else np.empty(0, bool)
    at = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0)) if len(head) else np.empty(0, np.int64)
    later = (p != p[at]) | (s != s[at])
    return string[later], offset[later]


def _bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    strings = pdf["piece"].tolist()
    start = pdf["start"].to_numpy(np.int64)
    texts, place = np.unique(pdf[["key", "th"]].to_numpy(np.int64), axis=0, return_inverse=True)
    place = place.reshape(-1)
    string, offset = repeated(strings, place, start)
    out = pd.DataFrame({"place": place[string], "a": start[string] + offset}).drop_duplicates().sort_values(["place", "a"])
    # windows in a row as one range
    k, a = out["place"].to_numpy(), out["a"].to_numpy()
    first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (a[1:] != a[:-1] + 1)])) if len(k) else np.empty(0, np.int64)
    last = np.append(first[1:], len(k)) - 1 if len(k) else first
    return pd.DataFrame({"key": texts[k[first], 0], "th": texts[k[first], 1], "a": a[first], "b": a[last] + LENGTH})


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for key, th, text, wanted in zip(batch.column("key").to_pylist(), batch.column("th").to_pylist(), batch.column("text"), batch.column("wanted").to_pylist()):
            raw = text.as_buffer().to_pybytes()
            out += [(w["anchor"], key, th, w["start"], raw[w["start"]:w["start"] + w["n"] + LENGTH - 1]) for w in wanted]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                             ["anchor", "key", "th", "start", "piece"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, key, th, a): each window of LENGTH bytes of the pieces."""
    for batch in _cut_out(batches):
        key, th, start = (batch.column(c).to_numpy() for c in ("key", "th", "start"))
        pieces = [p.as_py() for p in batch.column("piece")]
        for lo in range(0, len(pieces), 1000):
            part = pieces[lo:lo + 1000]
            size = np.array([len(p) - LENGTH + 1 for p in part], np.int64)
            at = np.repeat(np.arange(lo, lo + len(part)), size)
            a = start[at] + np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
            window = [xxhash.xxh3_128_digest(p[i:i + LENGTH]) for p, n in zip(part, size.tolist()) for i in range(n)]
            yield pa.RecordBatch.from_arrays([pa.array(window, pa.binary()), pa.array(key[at]), pa.array(th[at]), pa.array(a)],
                                             ["window", "key", "th", "a"])


def _later_windows(spark: SparkSession, windows: DataFrame) -> DataFrame:
    """(key, th, a, b) of every window that also stands earlier."""
    windows = staged(spark, windows.distinct(), "windows")
    place = F.struct("key", "th", "a")
    first = staged(spark, windows.groupBy("window").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
                   .where("_n > 1").drop("_n"), "firsts")
    return (windows.join(small_side(first), "window").where(place != F.col("_first"))
            .select("key", "th", "a", (F.col("a") + LENGTH).alias("b")))


def _identity(doc_id: str, text: str) -> list[Column]:
    """Key and hash of a document's text: together they name it."""
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("key"), F.xxhash64(text_or_empty(text)).alias("th")]


def repeats(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, th, a, b): byte ranges of strings that occur earlier; they may
    overlap.  ``key`` is the document's id, ``th`` the hash of its text."""
    texts = docs.select(*_identity(doc_id, text), text_or_empty(text).alias("text"))
    found = texts.mapInArrow(_contexts, _CONTEXT)
    group = W.partitionBy("anchor")
    found = (found.withColumn("_least", F.min("ctx").over(group)).withColumn("_most", F.max("ctx").over(group))
             .withColumn("first", F.rank().over(W.partitionBy("anchor", "ctx").orderBy("key", "th", "start")) == 1)
             .where(~F.col("first") | (F.col("_least") != F.col("_most")) | (F.col("twice") > 0)))
    found = staged(spark, found.select("key", "th", "start", "n", "anchor", "first"), "contexts")
    whole = found.where("NOT first").select("key", "th", F.col("start").alias("a"), (F.col("start") + F.col("n") + (LENGTH - 1)).alias("b"))
    several = found.where("first").select("key", "th", "start", "n", "anchor").distinct()
    hot = staged(spark, several.groupBy("anchor").count().where(F.col("count") > BUCKET).select("anchor", F.lit(True).alias("hot")), "hot")
    several = several.join(small_side(hot), "anchor", "left")
    wanted = staged(spark, several.groupBy("key", "th", F.col("hot").isNotNull().alias("hot"))
                    .agg(F.collect_list(F.struct("anchor", "start", "n")).alias("wanted")), "wanted")
    sums = {h: n for h, n in wanted.groupBy("hot").agg(F.sum(F.size("wanted"))).collect()}
    out = whole
    for split, n in sums.items():
        side = wanted.where("hot" if split else "NOT hot").drop("hot")
        held = texts.join(small_side(side) if n <= 2_000_000 else side, ["key", "th"]).select("key", "th", "text", "wanted")
        if split:
            inside = _later_windows(spark, held.mapInArrow(_windows, "window binary, key long, th long, a long"))
        else:
            pieces = held.mapInArrow(_cut_out, "anchor long, key long, th long, start long, piece binary")
            inside = (pieces.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-n // BUCKET)))))
                      .groupBy("bucket").applyInPandas(_bucket, "key long, th long, a long, b long"))
        out = out.unionByName(inside)
    return out


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RESULT.split(", ")]
    types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
    for batch in batches:
        out = []
        for doc, text, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("spans").to_pylist()):
            raw = np.frombuffer(text.as_buffer(), np.uint8)
            change = np.zeros(len(raw) + 1, np.int64)
            if spans:
                np.add.at(change, np.minimum([s["a"] for s in spans], len(raw)), 1)
                np.add.at(change, np.minimum([s["b"] for s in spans], len(raw)), -1)
            gone = np.cumsum(change[:-1]) > 0
            kept = raw[~gone].tobytes()
            runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            out.append((doc, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def remove_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: what is left of its bytes, and counts."""
    spans = staged(spark, repeats(spark, docs).distinct().groupBy("key", "th").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "spans")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_identity("doc_id", "text"), text_or_empty("text").alias("text"))
    return rows.join(spans, ["key", "th"], "left").select("doc_id", "text", "spans").mapInArrow(_remove, RESULT)


def dedup_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return remove_repeats(spark, docs).drop("kept")
