"""Tokens, spelling variants and the divergence of sources: against the
``tokenizers`` library, brute force and SQL."""

from __future__ import annotations

import hashlib
import random
import unicodedata

import duckdb
import numpy as np
import pytest

from flowspark.llm import bpe, divergence, spelling

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, term string, n long, word string, ids binary"


def docs_of(spark, rows):
    """Rows of (doc_id, text, lang, source) with columns that clash."""
    return spark.createDataFrame([(*r, 0, "x", 1, "x", b"") for r in rows], DOCS)


def in_sql(df, sql):
    """Rows of the operator's SQL over ``df`` as documents."""
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    return con.sql(sql)


def same(df, relation):
    names = sorted(df.columns)
    return sorted(map(repr, (tuple(r) for r in df.select(*names).collect()))) == sorted(
        map(repr, relation.select(*[duckdb.ColumnExpression(c) for c in names]).fetchall()))


# -- op11 --------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.default_tokenizer())


def test_encoding_equals_the_library(library):
    v, rng = bpe.vocabulary(bpe.default_tokenizer()), random.Random(5)
    tokens = list(v.token_of.values())
    letters = [chr(c) for c in range(0x3000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    odd = ["'s", "'S", "<|endoftext|>", "<|startoftext|>", "<|", "aaa", "a", " ", "ΣΑΣ", "é", "İ", " ́", "123", "!!!"]
    for k in range(6000):
        pick = [lambda: rng.choice(tokens).replace("</w>", rng.choice(["", " "])), lambda: rng.choice(letters),
                lambda: rng.choice(odd), lambda: rng.choice("aab"), lambda: rng.choice("abcdefghinorstu")][k % 5]
        text = "".join(pick() for _ in range(rng.randint(0, 25)))
        want = library.encode(text, add_special_tokens=False).ids
        got = b"".join(v.encode(text))
        assert np.frombuffer(got, "<u4").tolist() == want, text
        assert v.decode(got) == library.decode(want, skip_special_tokens=False)


def test_slices_do_not_change_ids(library, monkeypatch):
    """A long text, with and without white space, by small slices."""
    v, cut = bpe.vocabulary(bpe.default_tokenizer()), bpe.slices
    monkeypatch.setattr(bpe, "slices", lambda text, gap: cut(text, gap, 50))
    for text in ("café <|endoftext|> 12 don't  ́x " * 400, "abcdefghij" * 20000, "7" * 5000, ""):
        parts = list(v.encode(text))
        assert np.frombuffer(b"".join(parts), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert " " not in text or len(parts) > 10


def test_bpe_documents(spark, library):
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "The cat's  Été 1999", "en", "s"), (3, "The cat's  Été 1999", "en", "s"),
            (None, "x", None, None)]
    docs = docs_of(spark, rows)
    got = sorted(map(repr, (tuple(r) for r in bpe.digest_documents(docs).collect())))
    want = []
    for d, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(map(repr, want))
    encoded = bpe.encode_documents(docs)
    decoded = {r.doc_id: r.decoded for r in bpe.decode_documents(encoded).collect()}
    assert decoded[3].startswith("the</w> cat</w> 's</w>") and decoded[1] == decoded[2] == ""
    assert bpe.digest_documents(docs_of(spark, [])).count() == 0


def test_unreachable_tokens_never_end_a_prefix(tmp_path):
    """A vocabulary whose merges hide a token: "abc" needs (a, bc), but (a, b)
    comes first."""
    import json
    path = tmp_path / "v.json"
    vocabulary = {t: i for i, t in enumerate(["a", "b", "c", "ab", "bc", "abc"])}
    path.write_text(json.dumps({"model": {"vocab": vocabulary, "merges": [["a", "b"], ["b", "c"], ["a", "bc"]]},
                                "pre_tokenizer": {"pretokenizers": [{"pattern": {"Regex": r"\S+"}}]}}))
    v = bpe.Vocabulary(str(path))
    assert [v.token_of[i] for i in np.frombuffer(v.encode_word("abcbcab"), "<u4")] == ["ab", "c", "bc", "ab"]


# -- op12 --------------------------------------------------------------------

def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def test_composition_accepts_one_edit():
    rng = random.Random(3)
    machine = spelling.Acceptor()
    for _ in range(150):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) for _ in range(60)})
        got = [tuple(sorted(p)) for p in machine.near(machine.add(words))]
        assert len(got) == len(set(got))
        assert set(got) == {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if near(words[i], words[j])}
    # minimised: equal endings are one state
    before = len(machine.states)
    machine.add(["xing", "ying", "zing"])
    assert len(machine.states) - before <= 5


@pytest.mark.parametrize("group", [2000, 8])
def test_near_pairs(spark, group):
    """Also where initial states are refined down to one open code point."""
    rng = random.Random(4)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(6, 9))): rng.randint(5, 200) for _ in range(250)}
    words |= {"x" * 2500 + c: 9 for c in "abc"}
    got = spelling.near_pairs(spark, spark.createDataFrame(list(words.items()), "word string, n long"), group).collect()
    assert sorted(tuple(r) for r in got) == sorted((a, words[a], b, words[b]) for a in words for b in words if near(a, b))


def test_forms_and_roots(spark):
    words = {"recieve": 5, "receive": 9000, "receives": 40, "receivess": 7, "recezve": 1800, "station": 50, "stations": 50,
             "stationz": 10, "aaaaaa": 5, "aaaaab": 25, "aaaaac": 25}
    out = {r.word: r for r in spelling.group_words(spark, spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert out["receives"].form == "receive" and out["receivess"].form == "receives" and out["receivess"].root == "receive"
    assert out["recieve"].form is None and out["recieve"].n_near == 0     # two edits apart
    assert out["stationz"].form == "station" and out["station"].form is None and out["station"].n_near == 2
    assert out["aaaaaa"].form == "aaaaab" and out["aaaaaa"].form_n == 25     # the first of equal counts
    assert out["receive"].root == "receive" and out["receive"].form_n is None


def test_spelling_documents(spark):
    long = "Wonderful wonderfuls Étonnant étonnants " * 30
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, long, "en", "s"), (3, long, "en", "s"), (None, long, None, None),
            *[(k, "wonderful wondorful " * 3 + "abcdefgh,ABCDEFGH " + "q" * 3000, "en", "s") for k in range(10, 400)]]
    docs = docs_of(spark, rows)
    out = spelling.group_documents(spark, docs)
    assert out.where("word = 'wonderful'").count() == 1
    assert same(out, in_sql(docs.select("text", docs.doc_id.cast("string").alias("doc_id")), spelling.SPELLING_SQL))
    assert spelling.group_documents(spark, docs_of(spark, [])).count() == 0


def test_spelling_slices(spark, monkeypatch):
    """Runs are not cut: a text in slices has the same words."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted(spelling.vocabulary(docs).collect())
    batches = docs.select("doc_id", "text").toArrow().to_batches()
    cut = spelling.slices
    monkeypatch.setattr(spelling, "slices", lambda text, gap: cut(text, gap, 100))
    monkeypatch.setattr(spelling, "HELD", 50)
    got: dict[str, int] = {}
    for b in spelling._count(iter(batches)):
        for word, n in zip(*[c.to_pylist() for c in b.columns]):
            got[word] = got.get(word, 0) + n
    assert sorted((w, n) for w, n in got.items() if n >= spelling.LEAST_COUNT) == [tuple(r) for r in want]


# -- op13 --------------------------------------------------------------------

def test_audit_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "a b c a A", "en", "s"), (3, "a b c a A", "en", "s"), (4, "b a d", "en", "t"),
            (5, "É zé b b b", "en", None), (6, "rare words only", "de", "u"), (7, "", "de", "v"), (None, "a b", "en", "t")]
    docs = docs_of(spark, rows)
    out = divergence.audit(spark, docs)
    assert same(out, in_sql(docs, divergence.AUDIT_SQL))
    values = {(r.lang, r.source, r.item): r.value for r in out.where("part = 'pair'").collect()}
    assert values["de", "u", "v"] == 0 and len([k for k in values if k[0] == "en"]) == 6
    assert divergence.audit(spark, docs_of(spark, [])).count() == 0


def test_blocks_add_up(spark, monkeypatch):
    """Small blocks and slices, and counts beyond 64 bits on the way."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang <> 'en'")
    terms = divergence.term_counts(docs).select("lang", "cells").toArrow()
    totals = {lang: {s: 10 ** 17 + k for k, s in enumerate(["src0", "src1", "src2", "none"])} for lang in ("de", "fr", "es")}
    table = sorted([r for r in terms.to_pylist() if r["lang"] in totals], key=lambda r: (r["lang"], [tuple(c.values()) for c in r["cells"]]))
    import pyarrow as pa
    for r in table:
        r["cells"] = [c | {"n": c["n"] * 10 ** 12} for c in r["cells"] if c["source"] in ("src0", "src1", "src2")]
        r["length"] = 2
    table = [{"lang": r["lang"], "cells": r["cells"], "length": 2} for r in table]
    kind = pa.schema([("lang", pa.string()), ("cells", pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))),
                      ("length", pa.int64())])
    sums: dict[int, dict] = {}
    for block in (3, 10 ** 6):
        monkeypatch.setattr(divergence, "BLOCK_CELLS", block)
        for b in divergence._compare(totals)(iter(pa.Table.from_pylist(table, kind).to_batches(3000))):
            for lang, a, item, value in zip(*[c.to_pylist() for c in b.columns]):
                key = lang, a, item
                sums.setdefault(block, {})[key] = sums.get(block, {}).get(key, 0) + value
    assert sums[3] == sums[10 ** 6]
    p = lambda row, s, t: 1 + 10 ** 9 * (sum(c["n"] for c in row["cells"] if c["source"] == s) + 1) // t
    for (lang, a, b), value in sums[3].items():
        want = 0
        for row in table:
            if row["lang"] == lang:
                x, y = p(row, a, totals[lang][a]), p(row, b, totals[lang][b])
                want += 2 * ((x - y) ** 2 // y)
        assert value == want


def test_runs_are_shorter_than_the_vocabulary(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'")
    rows = divergence.term_counts(docs).groupBy("cells").count().orderBy("cells").toArrow()
    columns = divergence.run_lengths(rows.column("cells").combine_chunks(), ["src0", "src1", "none"])
    v = sum(rows.column("count").to_pylist())
    assert all(len(c.counts) < v / 2 for c in columns.values())
    assert columns["none"].counts.tolist() == [0] and columns["src0"].run[-1] == len(columns["src0"].counts) - 1
    want = [dict((c["source"], c["n"]) for c in r).get("src0", 0) for r in rows.column("cells").to_pylist()]
    assert columns["src0"].counts[columns["src0"].run].tolist() == want


def test_exact_shares(spark):
    from pyspark.sql import functions as F
    n, total, v = 9 * 10 ** 15 + 7, 10 ** 16 + 3, 10 ** 8
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(v))).first()[0]
    assert got == 1 + 10 ** 9 * (n + 1) // (total + v)
