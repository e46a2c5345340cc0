"""The contracts' results against plain re-computation on small tables, and the cases that no table has."""

import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from costquarry.llm import bpe_counts, chat, components, decontaminate, language, lines, matroska, mixing, queries, repair, runtime, simhash, toxicity

ODD = [None, "", " ", "a", "A b\tc\nd", "word " * 3000, "x" * 70_000, "é ñ ß 가나 \U0001f600", "<|endoftext|> </s>[INST]", "a\x1cb　c", "same",
    "same", "\n\n", "don't   they'll  "]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, and columns whose names clash with inner ones."""
    rows = [(None if i == 1 else i // 2, t, None if i % 5 == 0 else f"s{i % 2}", None if i % 4 == 0 else "en", "clash", 1, 2.0) for i, t in enumerate(ODD)]
    rows.append(rows[3])
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, _t string, key int, score double").repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# 4: token counts


@pytest.fixture(scope="module")
def byte_tokenizer():
    from public_tokenizers import path
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path("byte_bpe_50k.json"))


def test_token_counts(spark, sf_dir, byte_tokenizer):
    want = texts(spark, sf_dir)
    for r in queries.op4_token_counts(spark, sf_dir).collect():
        n = len(byte_tokenizer.encode(want[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(want[r.doc_id].encode()), n, n > 512)


def test_token_counts_of_any_text(byte_tokenizer):
    count, rng = bpe_counts.counter("byte_bpe_50k.json").count, random.Random(3)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "'s", "é", "1", "$$", "\x1c", "　", "The", ". ", "<|endoftext|>", "\U0001f600", "́"]
    for _ in range(3000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12)))
        assert count(s) == len(byte_tokenizer.encode(s, add_special_tokens=False).ids), s


def test_token_counts_odd(odd, none, byte_tokenizer):
    got = bpe_counts.token_counts(odd).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(byte_tokenizer.encode(t or "", add_special_tokens=False).ids) for t in [*ODD, ODD[3]])
    assert bpe_counts.token_counts(none).count() == 0


# 5: SimHash


def brute_fingerprint(text, n=4):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(prints):
    ids = list(prints)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("most", [1, 7, 250_000])
def test_components_of_thinned_edges(spark, monkeypatch, most):
    """Whatever part of the edges is thinned at once, the roots are those of plain union."""
    monkeypatch.setattr(components, "EDGES_A_TASK", most)
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(500, k) for k in range(501, 700)] + [(k, k + 1) for k in range(800, 860)] * 3 + [(900, 900), (None, 901)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((top(a), top(b)))
            root[high] = low
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    assert got == {x: top(x) for x in root}


def test_simhash(spark, sf_dir):
    prints = {i: brute_fingerprint(t) for i, t in texts(spark, sf_dir).items()}
    classes = brute_components(prints)
    for r in queries.op5_simhash(spark, sf_dir).collect():
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", classes[r.doc_id])


@pytest.mark.parametrize("large", [8, 4096])
def test_links_of_dense_fingerprints(spark, monkeypatch, large):
    """Chains and one dense cluster: no link is lost, also when a key is dealt out in chunks."""
    monkeypatch.setattr(simhash, "LARGE", large)
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(150)] + [rng.getrandbits(64) for _ in range(50)]
    chain = rng.getrandbits(64)
    for k in range(20):
        chain ^= 0b1111 << (3 * k)
        prints.append(chain)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(simhash.signed(p),) for p in prints], "f0 long")
    edges = simhash.link(df, 4, simhash.masks_pigeonhole(4, 7))
    roots = {r.node: r.root for r in components.connected_components(edges.select(F.col("a0").alias("a"), F.col("b0").alias("b"))).collect()}
    want = brute_components(dict(enumerate(prints)))
    groups, got = {}, {}
    for i, p in enumerate(prints):
        groups.setdefault(want[i], set()).add(p)
        got.setdefault(roots.get(simhash.signed(p), simhash.signed(p)), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}


def test_simhash_odd(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD) + 1
    by = {}
    for r in got:
        by.setdefault(r.fingerprint, set()).add(r.component_id)
    assert all(len(v) == 1 for v in by.values()) and "0" * 16 in by
    assert simhash.near_duplicates(none).count() == 0


def test_wide_fingerprints_find_similar_texts(spark):
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
    near = list(base)
    for i in (40, 160, 250):
        near[i] = "changed"
    other = [f"v{rng.randint(0, 10**6)}" for _ in range(300)]
    df = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(other))], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df, words=5, lanes=4, distance=44, exact=False).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


# 2: mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def check_mix(rows):
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        assert 0 <= r.taken <= 3 * r.size
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6


def test_mixing(spark, sf_dir):
    want = texts(spark, sf_dir)
    rows = queries.op2_mixing(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.size) for r in rows) == sorted((i, len(words(t))) for i, t in want.items())
    check_mix(rows)
    assert {r.doc_id: r.taken for r in queries.op2_mixing(spark, sf_dir).collect()} == {r.doc_id: r.taken for r in rows}


def test_mixing_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 8)
    rows = [(i, "w " * (i % 37), None if i % 3 == 0 else "a" if i % 7 else "b") for i in range(600)]
    check_mix(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())


def test_mixing_odd(odd, none):
    check_mix(mixing.mix(odd).collect())
    assert mixing.mix(none).count() == 0


def test_pivot_is_fair():
    rng, total = np.random.default_rng(4), np.zeros(6)
    size, share = np.array([9.0, 7, 5, 4, 2, 1]), np.array([0.3, 0.5, 0.8, 0.1, 0.6, 0.4])
    for _ in range(4000):
        s = share.copy()
        left = mixing.pivot(s, size, rng.random(6))
        assert math.isclose(s @ size, share @ size) and sum(0 < x < 1 for x in s) == (left >= 0)
        total += s
    assert np.abs(total / 4000 - share).max() < 0.04


# 3: chat


def test_chat(spark, sf_dir):
    turns = {}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    turns[-7] = [("user", queries.CONTROL_TEXT), ("assistant", queries.CONTROL_TEXT)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = queries.op3_chat(spark, sf_dir).collect()
    assert len(got) == len(turns)
    for r in got:
        loss = "".join(t for role, t in turns[r.conv_id] if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns[r.conv_id]), sha("".join(f"{a}\n{b}\n" for a, b in turns[r.conv_id])))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss)) and r.formatted_chars > len(loss)


def test_escapes_come_back():
    rng = random.Random(6)
    pieces = ["\\", "<", "|", "[", "]", "INST", "/INST", "s>", "/s>", "<<SYS>>", "<|turn|>", "<|image 0|>", "x", "\n", "</s>[INST] ok [/INST]"]
    for _ in range(20_000):
        s = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))
        e = chat.escape(s)
        assert chat.unescape(e) == s and not re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", e)


def test_typed_parts(spark):
    part = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    rows = [
        (1, 0, "user", [("text", "look <|end|>", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None), None,
            ("audio", None, "b.wav", None, None, 1.01, None)]),
        (1, 1, "assistant", [("text", "fine", None, None, None, None, None), ("document", None, "c.pdf", None, None, None, 2),
            ("odd kind", None, None, None, None, None, None)]),
        (2, None, None, None), (2, None, None, None),
    ]
    df = spark.createDataFrame(rows, f"conv_id int, turn int, role string, parts array<{part}>")
    got = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert [(a.place, a.type, a.ref, a.tokens) for a in got[1].attachments] == [(0, "image", "a.png", 3), (1, "audio", "b.wav", 26),
        (2, "document", "c.pdf", 512), (3, "odd kind", None, 1)]
    assert got[1].attachment_tokens == 542
    assert chat.read_back(got[1].formatted) == [("user", "look <|end|>"), ("assistant", "fine")]
    assert [got[1].formatted[s.begin : s.end] for s in got[1].loss_spans] == ["fine"]
    assert chat.read_back(got[2].formatted) == [("", ""), ("", "")]
    assert chat.format_chats(df.limit(0)).count() == 0


# 6: language


def test_language(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op6_language(spark, sf_dir).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.9 * len(held)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the larger tables")
def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = language.predict(docs, language.fit(docs), keep=("lang",)).where("held_out and lang_pred <> 'und'").select("lang", "lang_pred").collect()
    assert len(got) > 2000 and sum(r.lang == r.lang_pred for r in got) >= 0.99 * len(got)


def by_loops(net, text):
    """The shares of a text, place by place."""
    raw, total = text.encode(), np.zeros(len(net.labels))
    for begin in range(0, len(raw), language.WINDOW):
        w = raw[begin : begin + language.WINDOW]
        x, h = w.ljust(language.WINDOW, b"\0"), []
        for width, table in net.tables.items():
            for f in range(table.shape[2]):
                h.append(max(sum(float(table[j, x[i + j], f]) for j in range(width)) for i in range(len(x) - width + 1)))
        z = np.maximum(np.array(h) + net.bias, 0) @ net.weight + net.offset
        e = np.exp(z - z.max())
        total += e / e.sum() * len(w)
    pairs = [net.seen[a << 8 | b] for a, b in zip(raw, raw[1:])] or [1]
    return total / len(raw), sum(pairs) / len(pairs)


def test_language_equals_plain_loops(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(12)
    strange = spark.createDataFrame([(900, "가나다라마바사 아자차카"), (901, "x"), (902, "é" * 300), (903, "12 ab"), (904, "12 34"), (905, None)],
        "doc_id long, text string")
    net = language.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    df = docs.select("doc_id", "text").union(strange)
    got = {r.doc_id: r for r in language.predict(df, net, keep=("text",)).collect()}
    for r in got.values():
        if not r.text or not re.search(r"[^\W\d_]", r.text):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        shares, known = by_loops(net, r.text[:700] if len(r.text) > 3000 else r.text)
        if len(r.text) <= 3000:
            assert r.lang_pred == net.labels[int(shares.argmax())] and abs(r.score - shares.max() * known) < 1e-4
    assert got[900].score < 0.1 and got[900].lang_pred in net.labels


def test_language_odd(odd, none):
    got = language.predict(odd, language.fit(odd)).collect()
    assert len(got) == len(ODD) + 1
    empty = language.predict(odd, None).collect()
    assert {r.lang_pred for r in empty} == {"und"}
    assert language.fit(none) is None and language.predict(none, None).count() == 0


def test_pooled_tables_are_the_convolution():
    rng = np.random.default_rng(0)
    net = language.Net(["a"], {w: rng.normal(size=(w, 256, 4)).astype(np.float32) for w in language.WIDTHS}, np.zeros(12, np.float32),
        np.zeros((12, 1)), np.zeros(1), np.ones(65536, bool))
    x = rng.integers(0, 256, (3, 20)).astype(np.uint8)
    want = [max(sum(net.tables[w][j][x[i, p + j],
        f] for j in range(w)) for p in range(20 - w + 1)) for i in range(3) for w in language.WIDTHS for f in range(4)]
    assert np.allclose(language.Pools(net)(x).ravel(), np.maximum(want, 0), atol=1e-4)


def test_language_of_one_id_on_all_rows(spark, sf_dir):
    """Rows are chosen by id and text: one id on more rows than are learned from teaches as many ids would."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang")
    many = docs.crossJoin(spark.range(30).withColumnRenamed("id", "k")).select(F.concat_ws(" ", "text", "k").alias("text"), "lang")
    for i in (1, 8, 12):
        df = many.withColumn("doc_id", F.lit(i).cast("long"))
        assert df.count() > language.SAMPLE_ROWS
        net = language.fit(df)
        assert net is not None and len(net.labels) == 4
        kept = language.predict(df, net, keep=("lang",)).where("lang is not null").select((F.col("lang") == F.col("lang_pred")).alias("right")).collect()
        assert np.mean([r.right for r in kept]) > 0.97
    same = docs.where("lang is not null").limit(1).crossJoin(spark.range(5000)).select(F.lit(1).cast("long").alias("doc_id"), "text", "lang")
    assert language.fit(same).labels == [same.first().lang]


def test_sample_near_its_bound(spark):
    """Just more keys than are asked for: all go, as a tenth more is taken."""
    df = spark.range(2100)
    assert runtime.smallest_hashes(df, F.col("id"), 2000).count() == 2100
    assert 2000 <= runtime.smallest_hashes(spark.range(50_000), F.col("id"), 2000).count() <= 2600


# 7: token ids


def test_token_ids(spark, sf_dir):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tok, at = Tokenizer.from_file(path("word_bpe_49k.json")), 0
    got = {r.doc_id: r for r in queries.op7_token_ids(spark, sf_dir).collect()}
    for i, t in sorted(texts(spark, sf_dir).items()):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 1]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


@pytest.mark.parametrize("ids", [[], [1], [1, 1], [7] * 1000, list(range(300)) * 20, np.random.default_rng(1).integers(0, 40, 20_000).tolist()])
def test_grammar_round_trip(ids):
    ids = np.array(ids, np.uint32)
    cut = sorted({0, len(ids) // 3, len(ids) // 2, len(ids)})
    counts = np.diff(cut).tolist() or [0]
    shard = repair.Shard(repair.pack([None, *range(1, len(counts))], counts, ids, 50_000))
    assert (shard.ids(0, len(ids)) == ids).all()
    for i, (a, b) in enumerate(zip(cut, cut[1:])):
        assert (shard.doc(i) == ids[a:b]).all()
    if len(ids) >= 1000:
        assert len(shard.seq) < len(ids) / 1.5


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    path, rnd = public_tokenizers.path(name), random.Random(5)
    bits = [*"abzAZéÀÞß×÷ÿĀİσΣ́µª 0 9  \t\n\x0b\x1c\x1f  .,'-<|>_@ſẞ한中😀٣\x00\x85", "<|endoftext|>", "'s", "'LL", "</w>", " <|startoftext|>", "É"]
    some = ["".join(rnd.choices(bits, k=rnd.randint(0, 30))) for _ in range(5000)]
    enc, want = repair.Encoder(path), Tokenizer.from_file(path).encode_batch_fast(some, add_special_tokens=False)
    for cut in (0, 1, 2500):
        got = enc.encode(pa.array([None, *some, ""])[cut:], 1)
        assert [g.tolist() for g in got] == [[1], *(w.ids + [1] for w in want), [1]][cut:]
    assert [g.tolist() for g in enc.encode(pa.array([None, ""], pa.string()), 7)] == [[7], [7]]


@pytest.mark.parametrize("ids", [np.tile(np.arange(300), 400), [7] * 5000, np.random.default_rng(3).zipf(1.3, 30_000) % 500])
def test_grammar_runs_to_the_end(ids):
    ids = np.array(ids, np.uint32)
    rules, seq = repair.compress(ids, 50_000)
    _, count = np.unique(seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:], return_counts=True)
    assert not (count >= repair.LEAST_COUNT).any() and len(set(map(tuple, rules.tolist()))) == len(rules)
    assert sum(map(len, repair.expansions(rules, 50_000))) == sum(repair.lengths(rules, 50_000))
    shard = repair.Shard(repair.pack([1], [len(ids)], ids, 50_000))
    assert (shard.doc(0) == ids).all()


def test_damaged_shard():
    data = bytearray(repair.pack([1], [4], np.array([1, 2, 3, 4]), 100))
    data[-1] ^= 1
    with pytest.raises(ValueError):
        repair.Shard(bytes(data))


def test_token_ids_odd(odd, none, monkeypatch):
    monkeypatch.setattr(repair, "SHARD_IDS", 500)
    got = sorted(repair.read_shards(repair.write_shards(odd)).collect(), key=lambda r: r.start)
    assert len(got) == len(ODD) + 1
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and got[0].start == 0
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda i: (i is not None, i or 0))
    assert repair.read_shards(repair.write_shards(none)).count() == 0


# 9: Matroska


def test_media(spark, sf_dir):
    want = texts(spark, sf_dir)
    for r in queries.op9_matroska(spark, sf_dir).collect():
        raw = want[r.doc_id].encode()
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(),
            zlib.crc32(payload[-32:]))


@pytest.mark.parametrize("lacing", [matroska.NO_LACING, matroska.XIPH, matroska.FIXED, matroska.EBML_LACING])
def test_lacing(lacing):
    payload = np.random.default_rng(lacing).integers(0, 256, 576 * 150).astype(np.uint8).tobytes()
    media = matroska.mux(payload, lacing=lacing)
    got = matroska.parse(media)
    assert got.intact and b"".join(media[p.offset : p.offset + p.size] for p in got.packets) == payload
    assert [p.time_ms for p in got.packets] == [72.0 * i for i in range(150)] and len(got.cues) == 3
    assert all(media[at : at + 4] == b"\x1f\x43\xb6\x75" for _, _, at in got.cues)


@pytest.mark.parametrize("lacing", [matroska.XIPH, matroska.EBML_LACING])
def test_frames_of_any_size(lacing):
    frames = [bytes([i]) * n for i, n in enumerate((3, 700, 0, 255, 510, 64, 8000))]
    data = matroska.lace(frames, lacing)
    assert [data[a : a + n] for a, n in matroska._frames(data, 0, len(data), lacing)] == frames


def test_broken_media():
    media = matroska.mux(b"x" * 576 * 20)
    assert not matroska.parse(None).intact and not matroska.parse(b"").intact and not matroska.parse(b"RIFF....").packets
    for n in range(0, len(media), 97):
        assert not matroska.parse(media[:n]).intact
    unknown = media.replace(b"\x18\x53\x80\x67" + matroska.vint(len(media) - media.index(b"\x18\x53\x80\x67") - 4 - 3), b"\x18\x53\x80\x67\xff")
    assert len(matroska.parse(unknown).packets) == 20


def test_blocks_that_refer_are_no_keys():
    m = matroska
    block = lambda *rest: m.element(m.BLOCK_GROUP, b"".join(rest))
    data = lambda t: m.element(m.BLOCK, b"\x81" + t.to_bytes(2, "big") + b"\0abc")
    refers = m.element(m.REFERENCE, b"\x01")
    cluster = m.element(m.CLUSTER, m.number(m.CLUSTER_TIME, 0) + block(data(0)) + block(data(1), refers) + block(refers, data(2)) + block(data(3)))
    point = m.element(m.CUE_POINT, m.element(m.CUE_POSITIONS, m.number(m.CUE_CLUSTER, 5) + m.number(m.CUE_TRACK,
        2)) + m.element(m.CUE_POSITIONS, m.number(m.CUE_TRACK, 3) + m.number(m.CUE_CLUSTER, 6)) + m.number(m.CUE_TIME, 7))
    cues = m.element(m.CUES, point + m.element(m.CUE_POINT, m.element(m.CUE_POSITIONS, m.number(m.CUE_CLUSTER, 9))))
    head = m.element(m.EBML, m.element(m.DOC_TYPE, b"matroska"))
    body = cluster + cues
    got = m.parse(head + m.element(m.SEGMENT, body))
    at = len(head) + len(m.element(m.SEGMENT, body)) - len(body)
    assert got.intact and [p.key for p in got.packets] == [True, False, False, True]
    assert got.cues == [(7, 2, at + 5), (7, 3, at + 6), (0, 0, at + 9)]


def test_media_odd(odd, none):
    got = matroska.text_media(odd).collect()
    assert len(got) == len(ODD) + 1 and min(r.payload_bytes for r in got) == 576
    assert len({r.media_sha256 for r in got}) == len({t or "" for t in ODD})
    assert matroska.text_media(none).count() == 0
    rows = matroska.packet_table(odd.select("doc_id", F.lit(matroska.mux(b"y" * 1152)).alias("m")).limit(1), "doc_id", "m").collect()
    assert [(r.offset > 0, r.size) for r in rows] == [(True, 576)] * 2


# 10: toxicity


def test_toxicity(spark, sf_dir):
    got = queries.op10_toxicity(spark, sf_dir).collect()
    assert len(got) == len(texts(spark, sf_dir)) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert {r.doc_id for r in got if r.held_out} == {i for i in texts(spark, sf_dir) if zlib.crc32(str(i).encode()) % 4 == 2} and toxic


LARGE_SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(LARGE_SF), reason="needs the larger tables")
def test_toxicity_held_out(spark):
    """On held-out rows no worse than the sum of the weights of words, and better than that at the threshold."""
    docs, labels = (spark.read.parquet(f"{LARGE_SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").where("held_out and toxic is not null").collect()
    memo = toxicity.Memo(model.lexicon)
    bag = np.array([sum(m[1] for w in toxicity.WORD.findall((r.text or "").lower()) if (m := memo[w]) and m[0] == toxicity.INSULT) for r in rows])
    y, score, predicted = (np.array([r[c] for r in rows]) for c in ("toxic", "score", "predicted"))

    def auc(x):
        up, down = x[y == 1][:, None], x[y == 0]
        return (up > down).mean() + (up == down).mean() / 2

    assert len(rows) > 900 and auc(score) >= auc(bag) and auc(score) > 0.96
    assert predicted[y == 1].mean() >= 0.9 and predicted[y == 0].mean() <= 0.006 < (bag[y == 0] > 0).mean()


def scorer(**weights):
    return toxicity.Scorer(toxicity.Lexicon({w: (c, 1.0) for c, ws in toxicity.CLASSES.items() for w in ws.split()}, {"zork": 2.0}),
        toxicity.CONTEXTS | weights)


def test_clauses():
    s = scorer()
    score = lambda t: sum(w * f for _, w, f in s.matched(t)[0])
    plain = score("an idiot here")
    assert score("you idiot") > plain > score("not an idiot") > 0 and score("an idiot are you") == score("you idiot")
    assert score("He said: an idiot") == score("an idiot, he said") == score('the word "idiot" is old') < plain and score("zorkling") == 2.0
    assert score("i will kill her") == score("kill her i will") > 0 == score("i will go") and score("kill") == 0
    assert score("ich werde dich töten") > score("ich werde dich nicht töten") > 0 and score("ein Idiot ist das nicht") < score("ein Idiot ist das hier")
    assert score("stupid idiot") > score("stupid. idiot")
    assert s.features(None) == s.features("") == s.features("nothing here") == (0, 0)
    assert s.features("fine. you idiot.")[0] == s.features("you idiot")[0] > 0 and s.features("fine. you idiot.")[1] < s.features("you idiot")[1]


def contexts_by_rule(reads):
    """What each hit of a clause is, by places instead of machines."""
    near = lambda i, marks, before, after: any(r in marks and (0 < i - k <= before or 0 < k - i <= after) for k, r in enumerate(reads))
    t, out = toxicity, {}
    for i, r in enumerate(reads):
        if r == t.INSULT or r == t.ACT and near(i, {t.MODAL}, 4, 4):
            found = {t.HEAPED: r == t.INSULT and near(i, {t.INSULT}, 2, 0), t.AIMED: near(i, {t.TARGET}, 4, 4),
                t.NEGATED: near(i, {t.LATE}, 3, 4) or near(i, {t.NEGATION}, 3, 0)}
            found[t.REPORTED] = t.REPORT in reads or reads[:i].count(t.QUOTE) % 2 == 1
            out[i] = t.symbol(t.INSULT if r == t.INSULT else t.THREAT, [c for c, yes in found.items() if yes])
    return out


def test_grammar_paths():
    """Of all paths through the composed machine one is accepted: the one that is searched, whose hits are those of the rules."""
    t, rnd = toxicity, random.Random(9)
    machine = t.grammar()
    classes = [t.OTHER, t.OTHER, t.INSULT, t.INSULT, t.ACT, t.MODAL, t.TARGET, t.NEGATION, t.LATE, t.REPORT, t.QUOTE]

    def every(state, reads):
        if not reads:
            return [[]] if machine.final(state) else []
        return [[(out, w), *rest] for to, out, w in machine.arcs(state, reads[0]) for rest in every(to, reads[1:])]

    for _ in range(1500):
        reads = rnd.choices(classes, k=rnd.randint(0, 9))
        paths = every(machine.start, reads)
        assert len(paths) == 1 and t.path(machine, reads) == paths[0]
        hits = {i: (out, w) for i, (out, w) in enumerate(paths[0]) if out.split("+")[0] in (t.INSULT, t.THREAT)}
        assert {i: out for i, (out, _) in hits.items()} == contexts_by_rule(reads)
        assert all(math.isclose(w, math.prod(t.CONTEXTS[c] for c in out.split("+")[1:])) for out, w in hits.values())


def test_context_weights_are_learned():
    """Labels that call all reported insults harmless and heaped ones toxic move those weights, and no others."""
    rows = [([("insult", 3.0)], 4), ([("insult+reported", 3.0)], 4), ([("insult+heaped", 3.0)], 4), ([], 1)] * 40
    weights, w = toxicity.learn_weights(rows, np.array([1.0, 0.0, 1.0, 0.0] * 40))
    assert weights["reported"] < 0.5 and weights["heaped"] >= 1.25 and weights["aimed"] == 1.5 and weights["negated"] == 0.5
    assert toxicity.learn_weights([([], 1)] * 4, np.array([0.0, 1.0, 0.0, 0.0]))[0] == toxicity.CONTEXTS


def test_toxicity_odd(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(none, toxicity.fit(none, labels.limit(0))).count() == 0


# 1 and 8 against their oracles


@pytest.mark.parametrize("name", ["op1_line_dedup", "op8_decontamination"])
def test_native_oracles(spark, sf_dir, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got, want = queries.queries()[name](spark, sf_dir).toPandas(), c.sql(queries.oracle_sql()[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols and len(want)
    assert sorted(map(str, got[cols].itertuples(index=False, name=None))) == sorted(map(str, want[cols].itertuples(index=False, name=None)))


def test_line_spread_near_the_threshold(spark):
    rows = [(i, f"own {i}\n  line {k} \n\n", f"site{i}") for k in range(60) for i in range(k + 1)]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_sites=20).collect()
    for r in got:
        k = int(re.search(r"line (\d+)", r.text)[1]) if "line" in r.text else None
        assert (r.n_removed >= 1) == (k is None or "own" not in r.text)
        assert k is None or k + 1 < 20


def test_lines_odd(odd, none):
    got = lines.dedup_lines(odd, min_sites=2).collect()
    assert len(got) == len(ODD) + 1 and sum(r.text is None for r in got) == 1
    assert lines.dedup_lines(none).count() == 0


def test_decontamination_tolerates_substitutions(spark):
    item = [f"b{i}" for i in range(30)]
    swapped = [w if i % 6 else "other" for i, w in enumerate(item)]
    docs = [(1, "x y " + " ".join(item) + " z"), (2, " ".join(swapped)), (3, "X Y, ".join(item[:8])), (4, None), (5, ""),
        (None, "pre " + " ".join(item).upper()), (6, "some clean text " * 50)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(10, " ".join(item)), (11, None), (12, "short item")], "item_id long, text string")
    for most in (decontaminate.BROADCAST_TOKENS, 0):
        got = {r.doc_id: (r.item_id, r.matched_tokens, r.start) for r in decontaminate.contaminated(df, bench, broadcast_tokens=most).collect()}
        assert got == {1: (10, 30, 2), 2: (10, 25, 0), None: (10, 30, 1)}


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_TOKENS, 0])
def test_decontamination_lays_whole_items(spark, most):
    """Items of over 300 tokens against the oracle: copies whole, of a part, beyond either end, and with few equal tokens far apart."""
    import duckdb
    import pandas as pd

    rng = random.Random(8)
    items = [[f"i{k}x{j}" for j in range(n)] for k, n in enumerate((1000, 256, 257, 700, 513, 60, 20))]
    phrase = [f"p{i}" for i in range(9)]
    items += [[f"q{j}" for j in range(400)], ["two", "plus", "two", "is", "five"],
        [*phrase, *(f"a{i}" for i in range(12)), *phrase, *(f"b{i}" for i in range(12))]]
    spread = [w if j < 9 or j % 300 == 0 else "other" for j, w in enumerate(items[0])]
    docs = [
        items[0], ["pre", "fix", *items[0], "end"], spread, items[0][400:], items[0][:601], ["x"] * 300 + items[0][300:900] + ["y"] * 200,
        [w if rng.random() < 0.8 else "other" for w in items[3]], items[1] + items[2], items[4] + items[4][100:400], items[5] + items[6],
        items[4][:100] + items[3] + items[4][100:], ["x"] * 2000, items[0][500:507], [],
        ["z"] * 70 + items[7] + ["z"], [w if j % 7 else "other" for j, w in enumerate(items[7])], items[8], ["x", *items[8], "x", *items[8]], items[8][:4],
        ["x", "y", *phrase, *(w if i % 4 == 3 or i > 9 else f"o{i}" for i, w in enumerate(items[9][30:]))], phrase * 3,
    ]
    rows, bench = list(enumerate(map(" ".join, docs))), list(enumerate(map(" ".join, items)))
    documents, benchmark = pd.DataFrame(rows, columns=["doc_id", "text"]), pd.DataFrame(bench, columns=["item_id", "text"])  # noqa: F841
    want = sorted(duckdb.sql(decontaminate.ORACLE).fetchall())
    twice = spark.createDataFrame([*rows, *rows], "doc_id long, text string").repartition(3)
    got = decontaminate.contaminated(twice, spark.createDataFrame(bench, "item_id long, text string"), broadcast_tokens=most)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert {(0, 0, 1000, 1000, 0, 1.0), (1, 0, 1000, 1000, 2, 1.0), (2, 0, 1000, 12, 0, 0.012)} <= set(want)
    assert {(14, 7, 400, 400, 70, 1.0), (16, 8, 5, 5, 0, 1.0), (17, 8, 5, 5, 1, 1.0),
        (19, 9, 42, 13, -19, 0.309524)} <= set(want) and not any(r[0] == 18 for r in want)


def test_decontamination_by_a_repeated_phrase(spark):
    """Only the second place of a phrase leads to the offset at which the item lies."""
    phrase = [f"p{i}" for i in range(9)]
    item = [*phrase, *(f"a{i}" for i in range(12)), *phrase, *(f"b{i}" for i in range(12))]
    doc = ["x", "y", *phrase, *(w if i % 4 == 3 or i > 9 else f"o{i}" for i, w in enumerate(item[30:]))]
    df = spark.createDataFrame([(1, " ".join(doc)), (2, "word " * 3000)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "word " * 200)], "item_id long, text string")
    for most in (decontaminate.BROADCAST_TOKENS, 0):
        got = {tuple(r)[:5] for r in decontaminate.contaminated(df, bench, broadcast_tokens=most).collect()}
        assert got == {(1, 1, 42, 13, -19), (2, 2, 200, 200, 0)}


def test_decontamination_by_short_items(spark):
    docs = [(1, "he said: Two plus two, is five"), (2, "two plus is two"), (3, "five"), (4, "plus two is"), (None, "2 is five")]
    bench = [(1, "two plus two is"), (2, "five"), (3, "two plus two is five or six"), (4, "is five"), (5, "")]
    df, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    for most in (decontaminate.BROADCAST_TOKENS, 0):
        got = {tuple(r) for r in decontaminate.contaminated(df, items, broadcast_tokens=most).collect()}
        assert got == {(1, 1, 4, 4, 2, 1.0), (1, 2, 1, 1, 6, 1.0), (1, 4, 2, 2, 5, 1.0), (3, 2, 1, 1, 0, 1.0), (None, 2, 1, 1, 2, 1.0), (None, 4, 2, 2, 1, 1.0)}


def test_decontamination_odd(odd, none, spark):
    bench = spark.createDataFrame([(1, "word " * 20), (2, None)], "item_id long, text string")
    got = decontaminate.contaminated(odd, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(2, 1)}
    assert decontaminate.contaminated(none, bench).count() == 0 == decontaminate.contaminated(odd, bench.limit(0)).count()
