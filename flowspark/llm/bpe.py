"""Byte-pair encoding and decoding by dynamic programming over prefixes.

A word's encoding is found without replaying merges.  For every prefix of a
word there is exactly one token that can end it: an automaton over the
vocabulary yields all tokens that are suffixes of the prefix, and a token is
the last one if it is compatible with the last token of the prefix before it.
Two tokens are compatible if undoing their merges at the boundary, later
merges first, never meets a merge across the boundary that would have come
before the one undone.  Back-pointers (a token's length) lead from the whole
word to its ids.

The vocabulary file (a ``tokenizers`` JSON of a BPE model over byte letters,
with an end-of-word mark) is a parameter and read once a worker process.  Its
normalisation (NFC, lower case, white space parts words), its split pattern
and its added tokens are honoured; added tokens are found in the raw text.

Work is by slices of a text, cut at white space, so the memory of a task does
not grow with a text that has white space; a word's tokens take four bytes a
character.  Defined results: null text counts as empty and has no ids; rows
with a null id and repeated rows are encoded like any other, one row each;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import normalizers

from flowspark.llm.common import byte_letters, slices, text_or_empty

TOKENIZER = "word_bpe_49k.json"
WORDS_KEPT = 500_000        # encoded words a worker remembers
LONG_WORD = 64              # longer ones are not remembered
NEVER = 1 << 60             # rank of the merge that a finished token never meets
END = ""              # the end-of-word mark as one letter; no byte letter is in this range
GAP = regex.compile(r"\s")
BEYOND_LATIN = regex.compile("[\u0300-\U0010ffff]")     # letters that a normal form may change


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


class Words(dict):
    """Encodings of the words met so far; a missing one is found and, if it
    is short, kept."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        got = self.encode(word)
        if len(word) <= LONG_WORD:
            if len(self) > WORDS_KEPT:
                self.clear()
            self[word] = got
        return got


class Vocabulary:
    """Tokens, merges and the automaton of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.mark = model.get("end_of_word_suffix") or ""
        ids: dict[str, int] = model["vocab"]
        self.token_of = {i: t for t, i in ids.items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_of.update({i: t for t, i in self.added.items()})
        self.added_at = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.letters = byte_letters()
        self.normal_form = normalizers.NFC()    # of the Unicode version that the file's library has
        # rank of the merge of a pair; of a token, the pair it came from and its rank
        self.merge: dict[tuple[int, int], int] = {}
        self.left, self.right, self.rank = {}, {}, {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            whole = ids[a + b]
            self.merge.setdefault((ids[a], ids[b]), rank)
            if whole not in self.rank:
                self.left[whole], self.right[whole], self.rank[whole] = ids[a], ids[b], rank
        self.pairs: dict[tuple[int, int], bool] = {}
        # a token that its own letters do not merge to never ends a prefix
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            if i not in self.rank or self._compatible(self.left[i], self.right[i], self.rank[i]):
                key = self._key(token)
                self.automaton.add_word(key, (i, len(key)))
        self.automaton.make_automaton()
        self.end = END if self.mark else ""
        self.known = Words(self.encode_word)

    def _key(self, token: str) -> str:
        return token[:-len(self.mark)] + END if self.mark and token.endswith(self.mark) else token

    def _compatible(self, a: int, b: int, until: int = NEVER) -> bool:
        """Whether ``a`` and ``b`` stand side by side until the merge of rank
        ``until``: no two parts of theirs that met at the boundary merged.
        Of equal merges the one further left comes first."""
        left_end = right_end = until        # ranks at which the parts in hand are merged away
        while True:
            met = self.merge.get((a, b), NEVER)
            if met < left_end and met <= right_end and met != until:
                return False
            rank_a, rank_b = self.rank.get(a, -1), self.rank.get(b, -1)
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:             # undo the later merge
                left_end, a = rank_a, self.right[a]
            else:
                right_end, b = rank_b, self.left[b]

    def compatible(self, pair: tuple[int, int]) -> bool:
        if len(self.pairs) > 2 * WORDS_KEPT:
            self.pairs.clear()
        found = self.pairs[pair] = self._compatible(*pair)
        return found

    def encode_word(self, word: str) -> bytes:
        """Ids of one word, as little-endian unsigned 32-bit integers."""
        if word.isascii() and word.isprintable():      # such bytes are their own letters
            spelled = word + self.end
        else:
            spelled = "".join(map(self.letters.__getitem__, word.encode("utf-8"))) + self.end
        n = len(spelled)
        # small integers for a long word
        last, size = ([-1] * (n + 1), [0] * (n + 1)) if n <= LONG_WORD else (array("i", [-1]) * (n + 1), array("i", [0]) * (n + 1))
        tested, compatible = self.pairs, self.compatible
        for end, (token, length) in self.automaton.iter(spelled):
            at = end + 1
            if last[at] >= 0:
                continue
            before = at - length
            if before:
                a = last[before]
                if a < 0:
                    continue
                fits = tested.get((a, token))
                if not (compatible((a, token)) if fits is None else fits):
                    continue
            last[at], size[at] = token, length
        if last[n] < 0:
            raise ValueError("the vocabulary does not cover all bytes")
        ids, at = [], n
        while at > 0:
            ids.append(last[at])
            at -= size[at]
        return struct.pack(f"<{len(ids)}I", *reversed(ids))

    def _plain(self, text: str) -> Iterator[bytes]:
        for part in slices(text, GAP):
            # lower case letter by letter: no final form of sigma
            if BEYOND_LATIN.search(part):
                part = self.normal_form.normalize_str(part).replace("Σ", "σ")
            part = part.lower()
            words = (m.group() for m in self.split.finditer(part)) if len(part) > 1 << 22 else iter(self.split.findall(part))
            while some := list(islice(words, 200_000)):
                yield b"".join(map(self.known.__getitem__, some))

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids of a text, slice by slice."""
        at = 0
        for m in self.added_at.finditer(text) if self.added_at else ():
            if m.start() > at:
                yield from self._plain(text[at:m.start()])
            yield self.added[m.group()].to_bytes(4, "little")
            at = m.end()
        if at < len(text):
            yield from self._plain(text[at:] if at else text)

    def decode(self, ids: bytes) -> str:
        """The tokens of ids, with a space between: the file names no decoder."""
        return " ".join(map(self.token_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _rows(batch: pa.RecordBatch) -> Iterable[tuple]:
    """The rows of (id, text) in small steps, so that few texts are Python
    strings at once."""
    for at in range(0, batch.num_rows, 64):
        some = batch.slice(at, 64)
        yield from zip(some.column(0).to_pylist(), some.column(1).to_pylist())


def encode_documents(docs: DataFrame, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text"
                     ) -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for d, t in _rows(batch):
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.int64()), pa.array([b"".join(v.encode(t))], pa.binary())],
                                                 ["doc_id", "ids"])
    return _input(docs, doc_id, text).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, decoded) of (doc_id, ids)."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for d, ids in _rows(batch):
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.int64()), pa.array([v.decode(ids or b"")], pa.string())],
                                                 ["doc_id", "decoded"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digest_documents(docs: DataFrame, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text"
                     ) -> DataFrame:
    """Every text encoded and its ids decoded again, as digests: nothing of a
    text's length is kept."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            rows = []
            for d, t in _rows(batch):
                n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
                for ids in v.encode(t):
                    if ids:
                        text_hash.update((" " if n else "").encode() + v.decode(ids).encode("utf-8"))
                        ids_hash.update(ids)
                        n += len(ids) // 4
                rows.append((d, n, ids_hash.hexdigest(), text_hash.hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.string(), pa.string()])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _input(docs, doc_id, text).mapInArrow(run, DIGEST)


def _input(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
