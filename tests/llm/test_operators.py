"""Each operator against brute force, a round trip or held-out labels, and
its defined results for nulls, empty and repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowspark.llm import (chat, decontam, fingerprint, langid, license, packing, secretscan, simhash, suffixdup,
                           toxicity)
from flowspark.llm.components import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, long, tied and repeated rows."""
    long = "token = \"abcdef123\" all rights reserved " + "lorem ipsum dolor " * 4000
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, long, "en", "s", len(long)), (4, long, "en", "s", len(long)),
            (4, long, "en", "s", len(long)), (None, "the cat", "en", None, 7), (None, None, None, None, None), (5, "... !!", "de", "s", 6)]
    return spark.createDataFrame(rows, DOCS)


def clash(df):
    return df.select("*", *[F.lit("x").alias(c) for c in ("score", "spans", "base", "places", "fp", "_c", "h", "sequence_id")])


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    talks = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for out in (langid.predict_documents(spark, none), secretscan.scan_documents(spark, none), simhash.group_documents(spark, none),
                license.scan_documents(spark, none), suffixdup.dedup_documents(spark, none), packing.pack_documents(spark, none),
                decontam.contained_items(spark, none, items), fingerprint.fingerprint_documents(spark, none),
                toxicity.score_documents(spark, none, labels)):
        assert out.count() == 0
    assert chat.format_conversations(spark, talks).count() == 1


def test_odd_rows(spark, odd):
    docs, n = clash(odd), odd.count()
    labels = spark.createDataFrame([(3, 1, 1), (3, 1, 0), (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found = langid.predict_documents(spark, docs).select("doc_id", "lang_pred", "score").collect()
    assert len(found) == n and {r.lang_pred for r in found if r.doc_id in (1, 2, 5)} == {"und"}
    hits = secretscan.scan_documents(spark, docs).collect()
    assert len(hits) == n and {r.n_assign for r in hits if r.doc_id in (3, 4)} == {1}
    groups = {r.doc_id: r for r in simhash.group_documents(spark, docs).collect()}
    assert groups[4].component_id == 3 and groups[2].component_id == 1 and groups[2].fingerprint == "0" * 16
    assert groups[None].component_id is None
    signs = license.scan_documents(spark, docs).collect()
    assert len(signs) == n and {r.base_labels for r in signs if r.doc_id in (3, 4)} == {"reserved"}
    cut = {r.doc_id: r for r in suffixdup.dedup_documents(spark, docs).collect()}
    assert cut[4].n_removed == cut[4].n_bytes and cut[1].n_bytes == 0 and 0 < cut[3].n_removed < cut[3].n_bytes
    packed = packing.pack_documents(spark, docs).toPandas()
    assert packed[packed.piece == 0].shape[0] == n
    prints = fingerprint.fingerprint_documents(spark, docs).collect()
    assert len(prints) == n and len({r.fingerprint for r in prints if r.doc_id in (3, 4)}) == 1
    scored = toxicity.score_documents(spark, docs, labels).collect()
    assert len(scored) == n and all(0 <= r.score <= 1 for r in scored)
    kept = simhash.keep_first(spark, docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "5", "None", "None"]
    assert langid.keep_identified(spark, docs).columns == docs.columns
    assert secretscan.redact_documents(spark, docs).columns == docs.columns


def test_language_held_out(spark, documents):
    r = langid.predict_documents(spark, documents).withColumn("held", langid.held_out()).toPandas()
    assert (r.held == [zlib.crc32(str(i).encode()) % 5 == 0 for i in r.doc_id]).all()
    assert (r[r.held].lang == r[r.held].lang_pred).mean() > 0.95


def test_out_of_place_distance():
    import pandas as pd
    a, b = (langid.top_codes(t, 50) for t in ("the cat and the hat", "der hund und die katze"))
    rows = pd.concat([pd.DataFrame({"lang": k, "gram": g.view(np.int64), "rank": range(len(g))}) for k, g in (("a", a), ("b", b))])
    model = langid.Profiles(rows, 50)
    own = langid.top_codes("the hat", 50)
    far = {k: sum(abs(i - list(g).index(c)) if c in g else 50 for i, c in enumerate(own)) for k, g in (("a", a), ("b", b))}
    best = min(far, key=far.get)
    assert model.nearest("the hat") == (best, 1 - far[best] / (50 * len(own)))


def test_secret_spans(spark, documents):
    rules = {"assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.I | re.A),
             "access": (r"AKIA[A-Z0-9]+", 0, 20, 0), "hex": ("[0-9a-f]+", 0, 24, 0)}

    def brute(t):
        out = [(m.start(), i, k, m.end()) for i, (k, (p, g, n, f)) in enumerate(rules.items())
               for m in re.finditer(p, t, f) if len(m[g]) >= n]
        return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))

    rnd = random.Random(1)


    def random_string(n):
        return "".join(rnd.choice(secretscan.ALPHABET[:62]) for _ in range(n))

    # labelled samples of random strings stand in assignments
    planted = [(10_000 + k, f"é the key is {random_string(40)} and theotherthingwithletters password = '{random_string(40)}'"
                " secret=token:abcdefgh AKIA" + "ABCD1234" * 2 + " " + "0a" * 13) for k in range(20)]
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame(planted, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = secretscan.scan_documents(spark, docs).collect()
    for r in found:
        assert r.base_sha256 == hashlib.sha256(brute(texts[r.doc_id]).encode()).hexdigest()
    more = {r.doc_id: [s for s in r.spans.split(",") if s.startswith("markov")] for r in found}
    assert sum(bool(more[k]) for k, _ in planted) >= 18
    assert not any(more[r.doc_id] for r in documents.select("doc_id").collect())
    clean = {r.doc_id: r.text for r in secretscan.redact_documents(spark, docs).collect()}
    for k, t in clean.items():
        assert brute(t) == "" and (t == texts[k] or secretscan.REDACTED in t)


def test_secrets_recall_and_many_matches(spark, documents):
    """Held-out random strings that stand in no assignment, trained on the
    given documents; and a text with thousands of secrets."""
    rnd = random.Random(7)
    planted = ["".join(rnd.choice(secretscan.ALPHABET[:62]) for _ in range(40)) for _ in range(100)]
    model = secretscan.train(secretscan.labelled_samples(documents.select("doc_id", "text")))
    docs = spark.createDataFrame([(k, f"see {t} there") for k, t in enumerate(planted)], "doc_id long, text string")
    found = secretscan.find(docs, model).select("doc_id", "spans").collect()
    assert sum(len(r.spans) == 1 and r.spans[0].start == 4 and r.spans[0].end == 44 for r in found) >= 90
    many = " ".join(f"é{k} password = '{planted[k % 100]}' x {planted[(k + 1) % 100]} hello" for k in range(4000))
    row = spark.createDataFrame([(1, many)], "doc_id long, text string")
    row = secretscan.find(row, model).select("text", "spans", "base", secretscan.redact(secretscan.find(row, model)).alias("new"))
    started = time.time()
    r = row.first()
    assert time.time() - started < 60      # by the square of the matches it took many minutes
    assert len(r.base) == 4000 and len(r.spans) >= 7000
    want, at = [], 0
    for s in r.spans:
        assert many[s.start:s.end].endswith(s.value) or s.kind == 0
        if s.start >= at:
            want += [many[at:s.start], secretscan.REDACTED]
        at = max(at, s.end)
    assert r.new == "".join([*want, many[at:]])


def test_trie_walk_and_components(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 30, dtype=np.uint64)
    flips = [base ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) for _ in range(5)]
    x = np.unique(np.concatenate([base, *flips, base ^ np.uint64(7)]))
    near = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if bin(int(x[i] ^ x[j])).count("1") <= 2}
    assert {(int(i), int(j)) for a, b in simhash.linked_pairs(x, None, 0, 0, 2) for i, j in zip(a, b)} == near
    nodes = spark.createDataFrame([(int(v), k) for k, v in enumerate(x.view(np.int64))], "fp long, node long")
    found = {r.node: r.component for r in components(spark, simhash.links(spark, nodes)).collect()}
    parent = list(range(len(x)))
    for _ in range(len(x)):
        for i, j in near:
            parent[i] = parent[j] = min(parent[i], parent[j])
    assert all(found.get(k, k) == parent[k] for k in range(len(x)))
    chain = spark.createDataFrame([(k, k + 1) for k in range(200)], "u long, v long")
    assert {r.component for r in components(spark, chain).collect()} == {0}


def test_fingerprints_by_definition(spark, documents):
    import xxhash
    for r in simhash.with_fingerprints(documents).limit(40).collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
        h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(len(w) - 2, 1))] if w else []
        assert r.fp % (1 << 64) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_license_words_lower_ascii_alone(spark):
    df = spark.createDataFrame([("GPL \u00c0B 1\u212a\u0130x",)], "text string")
    assert df.select(license.words("text").alias("w")).first().w == ["gpl", "\u00c0b", "1\u212a\u0130x"]


def test_license_places(spark, documents):
    phrases = {label: p.split() for label, p in (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))}
    extra = spark.createDataFrame([(-1, "CC-BY x cc by;All rights reserved"), (-2, "Licensed under the Apache Licence, apache license Version")],
                                  "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(extra)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in license.scan_documents(spark, docs).collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id]))
        hits = [(i, label) for label, p in phrases.items() for i in range(len(w)) if w[i:i + len(p)] == p]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(hits), ",".join(sorted({x for _, x in hits})))
        assert (r.first_word, r.last_word) == ((min(hits)[0], max(hits)[0]) if hits else (None, None))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def _cut(docs):
    seen, out = set(), {}
    for i, t in sorted(docs):
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = True
            seen.add(b[p:p + 100])
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[i] = len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()
    return out


def test_merged_transforms_keep_shared_suffixes_alone():
    """Suffixes whose prefix no other one has are left out; the intervals of
    the others are their equal prefixes, in order."""
    rng = np.random.default_rng(8)
    strings = [bytes(rng.integers(97, 99, int(n), dtype=np.uint8)) for n in rng.integers(30, 60, 30)] + [b"\xff" * 60, b"\x00" * 50, b""]
    for length in (1, 4, 9):
        shards, names, at = [], [], 0
        for a in range(0, len(strings), 5):
            part = strings[a:a + 5]
            shards.append(suffixdup.shard_transform(part))
            base = np.cumsum([0] + [len(x) + 1 for x in part])
            for p in shards[-1][1].tolist():
                k = int(np.searchsorted(base, p, "right")) - 1
                names.append((a + k, p - int(base[k])))
        suffix, interval = suffixdup.merge(shards, length)
        got = {}
        for n, i in zip(suffix.tolist(), interval.tolist()):
            k, o = names[n]
            got.setdefault(i, []).append(strings[k][o:o + length])
        prefixes = [x[o:o + length] for x in strings for o in range(len(x) - length + 1)]
        want = sorted(p for p in set(prefixes) if prefixes.count(p) > 1)
        assert [set(v) for _, v in sorted(got.items())] == [{p} for p in want]
        assert sum(map(len, got.values())) == sum(prefixes.count(p) for p in want)


def test_repeats(spark, documents, monkeypatch):
    docs = [(r.doc_id, r.text) for r in documents.collect()] + [(1000, "xy" * 70), (1001, "z" * 300), (1002, "a" * 99)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdup.dedup_documents(spark, rows).collect()}
    assert got == _cut(docs)
    monkeypatch.setattr(suffixdup, "SHARD", 3)
    rnd = random.Random(5)
    base = "".join(rnd.choice("ab \n") for _ in range(600))
    strings = [base[a:a + rnd.randint(90, 200)].encode() for a in (rnd.randint(0, 400) for _ in range(20))]
    string, offset = suffixdup.repeated(strings, np.arange(20), np.zeros(20, np.int64))
    seen, expected = set(), set()
    for i, s in enumerate(strings):
        for p in range(len(s) - 99):
            (expected.add((i, p)) if s[p:p + 100] in seen else seen.add(s[p:p + 100]))
    assert set(zip(string.tolist(), offset.tolist())) == expected


def test_suffixes_of_texts_with_one_id(spark):
    rnd = random.Random(9)
    one, two, three, four = ("".join(rnd.choice("abcdefgh ") for _ in range(400)) for _ in range(4))
    # the repeated 200 characters stand at the end of one text, the other text of its id is cut nowhere
    rows = [(1, one), (2, two + one[:200]), (2, three + three[:50]), (None, four), (None, two[:150] + three[:120]), (3, four)]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffixdup.dedup_documents(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted([(1, 400, 0, 0), (2, 600, 350, 2), (2, 450, 120, 1), (None, 400, 0, 0), (None, 270, 0, 0), (3, 400, 400, 1)], key=str)


def test_suffixes_split_a_hot_hash(spark, monkeypatch):
    """No task gets more contexts of one hash than BUCKET, and the result stays that of brute force."""
    rnd = random.Random(11)

    def noise():
        return "".join(rnd.choice("abcdefghij ") for _ in range(150))

    passage = noise()
    docs = [(i, noise() + passage + noise()) for i in range(12)] + [(20, noise() + passage[:120])]
    bucket = suffixdup._bucket

    def bounded(pdf):
        assert pdf.groupby("anchor").size().max() <= 3
        return bucket(pdf)

    monkeypatch.setattr(suffixdup, "BUCKET", 3)
    monkeypatch.setattr(suffixdup, "_bucket", bounded)
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdup.dedup_documents(spark, rows).collect()}
    assert got == _cut(docs)


def test_packing(spark, documents, monkeypatch):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.default_tokenizer())
    r = packing.pack_documents(spark, documents).toPandas().sort_values(["sequence_id", "offset"])
    groups = r.groupby("sequence_id").length
    assert (groups.cumsum() - r.length == r.offset).all() and groups.sum().max() <= 1024
    assert r.sequence_id.nunique() <= -(-r.length.sum() // 1024) * 1.02 + 1
    for doc in documents.collect():
        ids = np.array(t.encode(doc.text, add_special_tokens=False).ids + [2], "<u4")
        own = r[r.doc_id == doc.doc_id].sort_values("piece")
        assert own.length.sum() == len(ids) and (own.length.iloc[1:] == 1024).all()
        assert [zlib.crc32(ids[a:a + n].tobytes()) for a, n in zip(own.start, own.length)] == own.ids_crc32.tolist()
    odd = ["", " ", "  a b", "a  b", "\na b\n c", "a  b", "it's 1,000 naïve　x ", "<|endoftext|> a", "a \n\n b\t c"]
    rng = random.Random(2)
    odd += ["".join(rng.choice([" ", "  ", "\n", "a", "the", "'s", "<|endoftext|>", "<|", "é", "12", "　", "!"]) for _ in range(12))
            for _ in range(2000)]
    want = [e.ids for e in t.encode_batch(odd, add_special_tokens=False)]
    of = packing.encoder(packing.default_tokenizer())
    assert [x.tolist() for x in of.texts(pa.array(odd))] == want
    # long texts by slices
    monkeypatch.setattr(packing, "LONG", 10)
    cut = packing.slices
    monkeypatch.setattr(packing, "slices", lambda text, gap: cut(text, gap, 8))
    assert [x.tolist() for x in of.texts(pa.array(odd))] == want


def test_long_texts_by_slices(spark, monkeypatch):
    """Slices of a text change neither its n-grams nor its fingerprint."""
    text = "The ΣΑΣ cat, and   12 hats!\n\tÉté — l'an " * 40
    grams, print_ = langid.top_codes(text, 300), [simhash.fingerprint(t) for t in (text, "a b", "", "a b c")]
    for module in (langid, simhash):
        monkeypatch.setattr(module, "slices", lambda t, gap, cut=module.slices: cut(t, gap, 7))
    assert len(list(langid.gram_codes(text))) > 50
    assert (langid.top_codes(text, 300) == grams).all()
    monkeypatch.setattr(langid, "_GATHER", 100)
    assert (langid.top_codes(text, 300) == grams).all()
    assert [simhash.fingerprint(t) for t in (text, "a b", "", "a b c")] == print_
    assert not list(langid.gram_codes(" 12, !"))


def test_chat_round_trip(spark):
    rnd = random.Random(3)
    parts = ["<turn>", "</turn>", "<", "\\", "turn>", "/", "a", "é", "\n", "<\\turn>", "日"]
    for _ in range(200):
        texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 8))) for _ in range(rnd.randint(0, 6))]
        roles = [rnd.choice(["user", "assistant", "sys\ntem", "<turn>", "a\\n", ""]) for _ in texts]
        segments, begin, end = chat.assemble(pa.array(roles, pa.string()), pa.array(texts, pa.string()))
        segments = segments.to_pylist()
        assert [chat.read_segment(s) for s in segments] == list(zip(roles, texts))
        assert [chat.unescape(s[a:b]) for s, a, b in zip(segments, begin, end)] == texts
        assert re.findall(r"<turn>[^\n]*\n.*?</turn>\n", "".join(segments), re.S) == segments
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b </turn>"), (1, None, None, None), (None, 0, "assistant", "c")]
    got = {r.conv_id: r for r in chat.format_conversations(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1].turns_sha256 == hashlib.sha256(b"\n\nuser\na\nassistant\nb </turn>\n").hexdigest()
    assert got[1].loss_chars == 9 and got[None].n_turns == 1 and got[-7].loss_chars == 26


def test_decontamination(spark):
    rnd = random.Random(2)
    words = [f"w{k}" for k in range(500)]
    items = [(k, " ".join(rnd.choice(words) for _ in range(rnd.randint(5, 60)))) for k in range(30)] + [(99, "two words"), (None, "x"), (98, None)]
    docs = []
    for k in range(60):
        own = items[k % 30][1].split()
        cut = own[:max(5, int(len(own) * rnd.choice([0.7, 0.85, 0.9, 1.0])))]
        docs.append((k, " ".join([rnd.choice(words) for _ in range(100)] + cut).upper() + " ... " + " ".join(rnd.choice(words) for _ in range(50))))
    docs.append((200, "Two, words!"))

    def shingles(t):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    expected = {(d, i) for d, t in docs for i, x in items if i is not None and shingles(x)
                and len(shingles(x) & shingles(t)) >= 0.8 * len(shingles(x)) - 1e-9}
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.contained_items(spark, a, b).collect()} == expected
    assert {r.doc_id for r in decontam.drop_contaminated(spark, a, b).collect()} == {d for d, _ in docs} - {d for d, _ in expected}


def test_document_fingerprints(spark, documents):
    r = {x.doc_id: x for x in fingerprint.fingerprint_documents(spark, documents).collect()}
    rows = sorted(((d.doc_id, d.text) for d in documents.collect()), reverse=True)
    for k, (i, t) in enumerate(rows):
        new = fingerprint.edited(t, rows[(k + 1) % len(rows)][1])
        assert (r[i].n_chars, r[i].edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
    rarity = fingerprint.rarity_table(documents)
    together = fingerprint.chains([t.encode() for _, t in rows], rarity)
    for (i, t), chain in zip(rows[:30], together):
        assert fingerprint.as_text(chain) == fingerprint.as_text(fingerprint.chains([t.encode()], rarity)[0]) == r[i].fingerprint
        assert fingerprint.likeness(chain, chain) == 1.0
    assert np.mean([x.near_edited for x in r.values()]) > 0.3 > np.mean([x.near_next for x in r.values()])


def test_toxicity_held_out(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    r = toxicity.score_documents(spark, d, lab).toPandas().merge(lab.toPandas(), on="doc_id")
    held = r[r.held_out]
    rank, n = held.score.rank(), held.toxic.sum()
    assert (rank[held.toxic == 1].sum() - n * (n + 1) / 2) / (n * (len(held) - n)) > 0.85
    assert held[held.predicted == 1].toxic.mean() > 0.9


def test_toxicity_rare_words_in_large_input(spark):
    """A context in six of 80,000 toxic training documents counts as in a small input."""
    n_toxic, n_ordinary = 120_000, 41_000
    fold = [zlib.crc32(str(i).encode()) % 3 for i in range(200)]
    planted = [[i for i in range(200) if fold[i] == k][:3] for k in (0, 2)]
    rare = F.col("doc_id").isin(sum(planted, []))
    docs = spark.range(n_toxic + n_ordinary).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") >= n_toxic + 1_000, "zebra common").otherwise("common").alias("text"))
    docs = docs.withColumn("text", F.when(rare, "zebrx common").otherwise(F.col("text")))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") < n_toxic).cast("int").alias("toxic"))
    new = spark.createDataFrame([(-1, "zebrx common"), (-2, "common"), (-2, "common"), (-3, "zebra common"), (None, None)], "doc_id long, text string")
    scored = toxicity.score_documents(spark, docs.unionByName(new), labels).where("doc_id < 0 OR doc_id IS NULL").collect()
    r = {x.doc_id: x.score for x in scored}
    assert len(scored) == 5 and r[-1] > r[-2] + 0.01 and r[-2] == r[-3] == r[None]


def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(spark, stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns and docs.count() <= n
        n = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert sorted(packed[packed.piece == 0].doc_id) == sorted(r.doc_id for r in docs.select("doc_id").collect())
