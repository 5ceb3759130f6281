"""Target resampling, the conversation trie and BPE chunk reuse against brute
force, with nulls, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bowline.llm import bpe_chunks, conv_trie, target_resample
from bowline.llm.common import Scratch

_UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- op11 -----------------------------------------------------------------------

def features(text, ngram):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_UP))
    return w, [" ".join(w[i:i + n]) for n in range(1, ngram + 1) for i in range(len(w) - n + 1)]


def brute_resample(docs, target, ngram, buckets, min_words, percent, seed=2024):
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for f in features(text, ngram)[1]:
                counts[zlib.crc32(f.encode()) % buckets] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets))))
            for b in range(buckets)]
    out, order = [], []
    for k, (doc_id, text) in enumerate(docs):
        words, fs = features(text, ngram)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in fs)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(fs), weight, score, None])
        if len(words) >= min_words:
            order.append((-score, doc_id is None, doc_id or 0, k))
    for rank, (*_, k) in enumerate(sorted(order)[:percent * len(order) // 100], 1):
        out[k][4] = rank
    return out


def key(row):
    return tuple((v is not None, v or 0) for v in row)


@pytest.mark.parametrize("ngram,segment_rows,samples", [(1, 500_000, 100_000), (2, 7, 12)])
def test_resampling_equals_brute_force(spark, ngram, segment_rows, samples):
    rng = random.Random(8)
    words = ["alpha", "Beta", "gamma9", "dé", "漢字", "x", "ONE", "two"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40))) + rng.choice([".", "", "\n?"])) for i in range(700)]
    docs += [(None, "alpha " * 30)] * 40 + [(7, "alpha beta " * 15)] * 30 + [(800, None), (801, ""), (802, "... !")]
    target = ["alpha one", None, "beta beta", ""]
    df = spark.createDataFrame([(*d, 0, "x") for d in docs], "doc_id long, text string, score int, bucket string")
    tf = spark.createDataFrame([(t,) for t in target], "text string")
    for parts in (1, 9):
        got = target_resample.resample(spark, df.repartition(parts), tf, ngram=ngram, buckets=50, min_words=20, percent=30,
                                       segment_rows=segment_rows, samples=samples)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        want = brute_resample(docs, target, ngram, 50, 20, 30)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want), key=key)


def test_resampling_empty(spark, docs):
    none = spark.createDataFrame([], "text string")
    got = target_resample.resample(spark, docs, none, percent=100).collect()
    assert len(got) == docs.count() and sorted(r.rank for r in got if r.rank) == [1, 2, 3, 4, 5, 6]
    assert target_resample.resample(spark, docs.limit(0), none).count() == 0
    assert target_resample.resample(spark, docs, none, min_words=10**9).where("rank IS NOT NULL").count() == 0


def test_splitters_bound_the_segments(spark):
    """Equal scores and one repeated id do not make one long segment, and few
    samples come to the driver however they are nested."""
    rows = spark.range(20_000).select((F.col("id") % 3).alias("score"), F.lit(5).cast("long").alias("doc_id"))
    scratch = Scratch(spark, "t")
    runs = scratch.write(rows.repartition(6).withColumn("down", -F.col("score")).withColumn("place", F.col("doc_id"))
                         .sortWithinPartitions("down", "place")
                         .withColumn("run_row", F.monotonically_increasing_id()), "runs")
    keys = np.array([tuple(r) for r in runs.select("down", "place", "run_row").collect()])
    keys = keys[np.lexsort(keys.T[::-1])]
    place = {tuple(k): i for i, k in enumerate(keys.tolist())}
    for samples in (100_000, 60):
        cuts = target_resample.regular_splitters(runs, 20_000, 1000, samples, scratch)
        at = [place[tuple(c)] for c in cuts.tolist()]
        assert at == sorted(at) and len(at) >= 10
        assert max(np.diff([0, *at, 20_000])) <= 3000


# --- op12 -----------------------------------------------------------------------

def tid(role, text):
    raw = f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()
    return hashlib.md5(raw).digest()[:12] + len((text or "").encode()).to_bytes(4, "big")


def brute_trie(rows, base_every=5, most_shared=8):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), tid(role, text), (role or "", text or "")))
    own = {c: [t for *_, t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most_shared + 1)
        full[c] = tuple(own.get(c - c % base_every, [])[:h] + turns[h:])
    members = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def below(p):
        parts = [below(q) for q in kids.get(p, [])]
        mine = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        return (sum(a for a, _ in parts) or 1, sum(b for _, b in parts) + mine)

    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(full[c]) == len(p))
        leaves, saved = below(p)
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids.get(p, [])), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(["a", "bb", "é"]) if rng.random() < .9 else "z" * c))
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(60) for t in range(11)]
    rows += [(2000, None, None, None), (2000, 1, "", ""), (2000, 1, "", ""), (2001, None, "user", "x"),
             (None, 1, "user", "lost"), (2002, 0, "us", "era"), (2003, 0, "user", "a"), (2004, 3, "user", None)]
    return rows


@pytest.mark.parametrize("block,id_range", [(8, 4096), (2, 7)])
def test_trie_equals_brute_force(spark, block, id_range):
    rows = conversations(block, 120, 14) + [(3000, t, "user", f"t{t % 5}") for t in range(70)] \
        + [(3001, t, "user", f"t{t % 5}") for t in range(69)]
    rows = [r for r in rows if r[0] != 2000] + [(2000, None, None, None), (2000, 1, "", "")]
    df = spark.createDataFrame([(*r, 1, "y") for r in rows],
                               "conv_id long, turn long, role string, text string, depth int, n string")
    got = conv_trie.shared_prefixes(spark, df.repartition(5), block=block, id_range=id_range)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_trie(rows), key=key)


def test_trie_without_shared_turns_and_empty(spark):
    rows = conversations(3, 25, 4)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = conv_trie.shared_prefixes(spark, df, most_shared=0).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_trie(rows, most_shared=0), key=key)
    assert conv_trie.shared_prefixes(spark, df.limit(0)).count() == 0
    assert conv_trie.shared_prefixes(spark, df.where("conv_id IS NULL")).count() == 0


def test_trie_turnless_conversations_hang_on_the_root(spark):
    """Conversations whose own turns all give way and whose base is absent."""
    cs = [c for c in range(100, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:4]
    rows = [(c, t, "user", f"{t}") for c in cs for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [tuple(r) for r in conv_trie.shared_prefixes(spark, df).collect()]
    assert got == brute_trie(rows) and len(got) == 1 and got[0][3] == 4


# --- op13 -----------------------------------------------------------------------

ODD = ["", " ", "\n\t", "a", "<|endoftext|> a<|startoftext|>b 'S DON'T It's 12ab", "<|ENDOFTEXT|> <|EndOfText|>",
       "ﬁ ÀÉ ß × ÷ ª µ é x́ İ Σς\tΣ\n\n 漢字 \x85 \xa0a", "a'll'd ?!.. .' '. «a». b.c", "ǰ J̌ İ K", "q" * 9000, "é" * 3000,
       "ab " * 9000, "\x1c\x1d a\x00b", "😀" * 50 + " " + "😀é " * 40]


def test_chunk_codec_equals_the_library():
    small = bpe_chunks.ChunkCodec(bpe_chunks.default_tokenizer(), mask_bits=3, least=1, most=40,
                                  chunk_store=20_000, run_store=20_000)
    usual = bpe_chunks.codec(bpe_chunks.default_tokenizer())
    assert small.stable and small.joined
    rng = random.Random(1)
    letters = ["a", "E", " ", " ", "\n", "́", "J", "̌", "'", "'s", ".", "<|endoftext|>", "<|", "5", "é", "漢", "the ", "«", "\x85"]
    texts = ODD + ["".join(rng.choices(letters, k=rng.randint(0, 150))) for _ in range(400)]
    for c in (small, usual):
        for text, ids in zip(texts, c.encode(texts)):
            want = c.tok.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, text[:40]
            assert c.decode(ids) == c.tok.decode(want, skip_special_tokens=False)
    assert small.repaired > 1000 and small.runs.used <= 10_000


def test_shared_chunks_are_encoded_once():
    c = bpe_chunks.ChunkCodec(bpe_chunks.default_tokenizer())
    rng = random.Random(2)
    passage = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(8000))
    c.encode([passage])
    before = c.encoded_chunks
    assert before > 10
    for lead in ("Another start. ", "x", "é ü " * 30):
        c.encode([lead + passage])
    assert c.encoded_chunks - before <= 9       # only chunks at the new starts


def test_cuts_follow_content():
    raw = ("".join(random.Random(4).choices("abcdé ", k=40_000))).encode()
    cuts = bpe_chunks.cut_points(raw)
    assert cuts[-1] == len(raw) and cuts == sorted(set(cuts))
    assert all(raw[c] & 0xC0 != 0x80 for c in cuts[:-1])
    moved = bpe_chunks.cut_points(b"some other start " + raw)
    assert len({c - 17 for c in moved} & set(cuts)) >= len(cuts) - 2
    assert max(np.diff([0, *bpe_chunks.cut_points(b"a" * 300_000)])) <= bpe_chunks.MOST
    assert bpe_chunks.cut_points(b"") == []


def test_other_tokenizers_encode_whole_texts(tmp_path):
    import public_tokenizers

    c = bpe_chunks.ChunkCodec(public_tokenizers.path("byte_bpe_50k.json"))
    assert not c.stable
    for text, ids in zip(ODD, c.encode(ODD)):
        want = c.tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert c.decode(ids) == c.tok.decode(want, skip_special_tokens=False)


def test_bpe_over_a_table(spark, docs):
    c = bpe_chunks.codec(bpe_chunks.default_tokenizer())
    rows = bpe_chunks.encode_documents(spark, docs).collect()
    want = [(d.doc_id, c.tok.encode(d.text or "", add_special_tokens=False).ids) for d in docs.select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows), key=lambda x: (x[0] or 0, len(x[1]))) \
        == sorted(want, key=lambda x: (x[0] or 0, len(x[1])))
    assert all(r.n_tokens * 4 == len(r.ids) and r.decoded == c.decode(bytes(r.ids)) for r in rows)
    assert bpe_chunks.encode_documents(spark, docs.limit(0)).count() == 0
