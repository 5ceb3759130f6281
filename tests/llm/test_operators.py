"""Each operator against brute force, an exact round trip or held-out accuracy,
and on nulls, empty and very long texts, repeated rows, ties, empty tables and
clashing extra columns."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bowline.llm import (bytecnn_lang, decontam, gam_quality, html_wrapper, interleave, minhash_tensor, packing,
                         token_resync, voronoi_knn, warc_revisit)
from bowline.llm.common import Scratch, components

SF = "/root/testdata/sf0.001"
_UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=2):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_UP))
    width = min(width, len(w))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if w else set()


def brute_components(texts, width=2, percent=80):
    sets = {i: shingles(t, width) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, k) for k in range(900, 990)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"),
                                                Scratch(spark, "t")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    assert got == {i: find(i) for a, b in edges if a != b for i in (a, b)}


def test_minhash_edge_cases(spark, docs):
    got = minhash_tensor.near_duplicates(spark, docs, width=2).collect()
    by = {(r.doc_id, r.n_shingles): r for r in got}
    assert len(got) == docs.count()
    assert by[(2, 60)].component_id == 1 and not by[(2, 60)].kept
    assert by[(3, 0)].kept and by[(4, 0)].kept                       # wordless: linked with nothing
    assert by[(8, 1)].component_id == 5                              # equal after lower-casing
    assert by[(None, 59)].component_id is None and by[(None, 59)].kept
    kept = minhash_tensor.drop_near_duplicates(spark, docs, width=2)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 9]
    assert kept.where("doc_id IS NULL").count() == 1
    spark.conf.set("bowline.broadcastLimitBytes", "1")
    try:
        past = minhash_tensor.drop_near_duplicates(spark, docs, width=2)
        assert past.exceptAll(kept).count() == 0 and kept.exceptAll(past).count() == 0
    finally:
        spark.conf.unset("bowline.broadcastLimitBytes")


def test_minhash_family_near_the_threshold(spark):
    """A family whose pairs lie on both sides of the threshold: stars alone miss
    links there, the blocks have to find them."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(160):
        w = list(base)
        for _ in range(rng.randrange(0, 16)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_tensor.near_duplicates(spark, df, 2).collect()}
    assert got == brute_components(texts)


def test_minhash_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_tensor.near_duplicates(spark, df, 2).collect()}
    assert got == brute_components(texts)


def test_minhash_empty(spark, docs):
    assert minhash_tensor.near_duplicates(spark, docs.limit(0)).count() == 0


def brute_hits(text, items):
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(_UP))
    words, hit, found = norm(text), set(), set()
    for item, t in items:
        w = norm(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            win = w[k:k + 10]
            for i in range(len(words) - len(win) + 1):
                if words[i:i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    found.add(str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


@pytest.mark.parametrize("part_bytes", [decontam.PART_BYTES, 40])
def test_decontamination_brute_force(spark, part_bytes):
    long = " ".join(f"q{i}" for i in range(14))
    items = [(10, long), (9, "Short  Item!"), (2, None), (3, ""), (9, "Short  Item!"), (4, "été über")]
    texts = [f"x {long} y", f"{long.upper()}, {long}", "a short-item, short item b", "", None, "Éte ÉTÉ été-über z",
             " ".join(f"q{i}" for i in range(9)), f"pre {' '.join(f'q{i}' for i in range(4, 14))}", "w " * 20000 + "short item"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, hits string")
    rows = decontam.benchmark_hits(spark, df, bench, "h", part_bytes=part_bytes).collect()
    for r in rows:
        assert (r.h.n_words, r.h.n_hit, r.h.n_items, r.h.items_sha256) == brute_hits(r.text, items), r.text
    first = next(r for r in rows if r.doc_id == 0)
    lo, hi = first.h.spans
    assert first.text[lo:hi] == long                                 # offsets in the original
    kept = decontam.decontaminate(spark, df, bench)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {3, 4, 6}
    assert decontam.benchmark_hits(spark, df, bench.limit(0), "h").where("h.n_hit > 0").count() == 0


def test_token_counts_equal_whole_texts():
    c = token_resync.Counter(token_resync.default_model(), chunk=256, overlap=16)
    assert c.stable
    rng = random.Random(1)
    texts = ["x" * 3000 + " y  z" * 300, "漢字" * 900 + " a" * 900, "  " * 900 + "ab " * 400, "a\n" * 1500,
             "  lead" + " 😀 é" * 800, "q" * 5000, "▁ mark" * 400, "<s> </s> <unk> " * 200,
             "".join(rng.choice("ab  é.\n▁") for _ in range(6000)), "".join(rng.choice("abc  ,.") for _ in range(9000))]
    for t in texts:
        assert c.count(t) == len(c.sp.encode(t)), t[:20]


def test_token_counts_edge_cases(spark, docs):
    sp = token_resync.counter(token_resync.default_model()).sp
    out = token_resync.count_tokens(docs)
    assert out.columns == docs.columns + ["n_bytes", "over_limit"]
    for r in out.collect():
        assert (r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), len(sp.encode(r.text or "")))
        assert r.over_limit == (r.n_tokens > 4096)


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    odd = ["<|endoftext|> a<|startoftext|>b 'S DON'T It's 12ab", "ﬁ ÀÉ ß × ÷ ª µ é x́ İ Σς\tΣ\n\n 漢字 \x85 \xa0a", "a'll'd ?!.."]
    df = docs.unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"),
                          allowMissingColumns=True)
    rows = packing.pack_documents(spark, df, seq_len=64, group=40).collect()
    want = []
    for d in df.select("doc_id", "text").collect():
        ids = tok.encode(d.text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at:at + 64]
            want.append((d.doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda t: tuple(-1 if v is None else v for v in t)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    check_sequences(rows, 64)
    assert packing.pack_documents(spark, docs.limit(0)).count() == 0


def check_sequences(rows, seq_len):
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in seqs.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= seq_len
    return len(seqs)


def test_packing_is_tight_over_many_groups(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(i, "a " * int(min(90, rng.expovariate(1 / 30)))) for i in range(3000)],
                               "doc_id long, text string")
    rows = packing.pack_documents(spark, df, seq_len=100, group=100).collect()
    assert check_sequences(rows, 100) <= 1.02 * -(-sum(r.length for r in rows) // 100) + 1


def test_packing_carries_few_items_on(spark):
    """Sequences that nothing can join stay out of later rounds: those go on that
    are at most half full, and as many others, the emptiest."""
    seqs = spark.createDataFrame([(k, 60 + k % 30) for k in range(900)] + [(1000 + k, 40) for k in range(6)]
                                 + [(2000, 99)], "seq long, fill long")
    rows = packing.joinable(seqs, 100, 97).collect()
    assert sorted(r.seq for r in rows if r.fill <= 50) == list(range(1000, 1006))
    assert {r.fill for r in rows if r.fill > 50} <= {60} and len(rows) <= 6 + 30
    assert packing.joinable(seqs.where("fill > 50"), 100, 97).count() == 0
    # two of three pieces are over half full: each small one meets at most one of them
    df = spark.createDataFrame([(i, "a " * (62 if i % 3 else 35)) for i in range(2000)], "doc_id long, text string")
    rows = packing.pack_documents(spark, df, seq_len=100, group=50).collect()
    assert len(rows) == 2000 and check_sequences(rows, 100) == sum(r.length > 50 for r in rows)


def test_gam_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = gam_quality.classify_quality(spark, docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam_quality.fit(x, y)
    assert np.mean((model.score(x) > 0.5) == y) > 0.9 and (1, 0) in [(i, j) for i, j, _ in model.pairs]


def test_gam_edge_cases(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = gam_quality.classify_quality(spark, docs, none).collect()
    assert len(rows) == docs.count() and {r.score for r in rows} == {0.5}
    kept = gam_quality.keep_quality(spark, docs, none)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert gam_quality.classify_quality(spark, docs.limit(0), none).count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = bytecnn_lang.identify_languages(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.95


def test_language_edge_cases(spark, docs):
    rows = bytecnn_lang.identify_languages(spark, docs).collect()
    assert len(rows) == docs.count()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {3, 4, 6} and all(r.score == 0 for r in rows if r.lang_pred == "und")
    kept = bytecnn_lang.keep_known(spark, docs, min_score=0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    blank = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in bytecnn_lang.identify_languages(spark, blank).collect()} == {"und"}
    assert bytecnn_lang.identify_languages(spark, docs.limit(0)).count() == 0


def test_folded_tables_equal_the_network():
    raws = [b"the cat sat on the mat " * 9, b"le chat est sur le tapis " * 9] * 20
    net = bytecnn_lang.fit(raws, ["en", "fr"] * 20)
    x = bytecnn_lang.windows_of(raws[0] + raws[1])
    e, pooled = net.embed[x.astype(int)], []
    for w, f, k in zip(bytecnn_lang.WIDTHS, net.filters, range(3)):
        c = np.concatenate([e[:, i:x.shape[1] - w + 1 + i] for i in range(w)], axis=2)
        n = bytecnn_lang.FILTERS
        # the folded form starts every filter where the widest one can start
        pooled.append((c @ f + net.bias[k * n:(k + 1) * n])[:, :x.shape[1] - 3].max(axis=1))
    h = np.maximum(np.concatenate(pooled, axis=1), 0)
    want = bytecnn_lang._softmax(h @ net.out[:-1] + net.out[-1])
    assert np.allclose(net.folded().probabilities(x), want, atol=1e-4)


@pytest.mark.parametrize("range_rows", [50_000, 40])
def test_interleaved_shards(spark, range_rows):
    rows = [(i, "t" * (i % 7), f"s{(i * i) % 11 if i % 3 else 0}") for i in range(1003)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = interleave.shard_rows(spark, df, range_rows=range_rows).collect()
    assert sorted(r.doc_id for r in got) == list(range(1003))
    per = {s: sorted(r.slot for r in got if r.shard == s) for s in range(8)}
    assert all(v == list(range(len(v))) for v in per.values())
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1
    source = {r[0]: r[2] for r in rows}
    for s in set(source.values()):
        total = sum(v == s for v in source.values())
        for shard in range(8):
            n = sum(r.shard == shard and source[r.doc_id] == s for r in got)
            assert abs(n - total / 8) <= 3
    assert all(r.text_crc32 == zlib.crc32(rows[r.doc_id][1].encode()) and r.size == len(rows[r.doc_id][1]) + 1 for r in got)


def test_interleave_edge_cases(spark, docs):
    got = interleave.shard_rows(spark, docs).collect()
    assert len(got) == docs.count() and sorted({r.shard for r in got}) == list(range(8))
    assert interleave.shard_rows(spark, docs.limit(3)).select("shard").distinct().count() == 3
    assert interleave.shard_rows(spark, docs.limit(0)).count() == 0


def test_voronoi_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(voronoi_knn, "BLOCK_ROWS", 37)
    monkeypatch.setattr(voronoi_knn, "BLOCK_QUERIES", 5)
    rng = np.random.default_rng(4)
    vecs = [(i, (rng.normal(0, 1, 6) + 3 * rng.integers(0, 3)).round(2).tolist()) for i in range(600)]
    vecs += [(1000 + i, vecs[7][1]) for i in range(200)] + [(2000, [1.0, 2.0])]
    bad = [(50000, None), (50050, [1.0, None]), (50100, [float("nan")]), (50150, [float("inf")]), (None, [1.0])]
    df = spark.createDataFrame([(*v, 0) for v in vecs + bad], "vec_id long, embedding array<double>, score int")
    ints = {i: np.pad(np.floor(256 * np.array(v)).astype(int), (0, 6 - len(v))) for i, v in vecs}
    want = [(q, k + 1, i, s) for q in ints if q % 50 == 0 for k, (s, i) in enumerate(
        sorted(((int(ints[q] @ ints[i]), i) for i in ints if i != q), key=lambda t: (-t[0], t[1]))[:5])]
    got = [tuple(r) for r in voronoi_knn.top_k(spark, df).collect()]
    assert sorted(got) == sorted(want)
    assert voronoi_knn.top_k(spark, df.limit(0)).count() == 0
    assert voronoi_knn.top_k(spark, df.where("vec_id IN (0, 1)")).count() == 1


def test_revisits(spark):
    h = "map<string,string>"
    rec = spark.createDataFrame([
        (1, "response", "http://a.x/p?b=2&a=1", 10, 200, "d1", {"etag": "e1", "content-length": "9", "date": "10"}, 0),
        (2, "revisit", "https://www.A.x:443/p/?a=1&b=2&utm_source=z#f", 20, 304, None,
         {"etag": "W/e1", "date": "20", "content-length": "0"}, 0),
        (3, "response", "http://a.x/p?a=1&b=2", 30, 200, "d2", {"etag": "e2"}, 0),
        (4, "revisit", "http://a.x/p?a=1&b=2", 40, 304, None, {"etag": "e1"}, 0),
        (5, "revisit", "http://a.x/p?a=1&b=2", 5, 304, None, None, 0),
        (6, "response", "http://a.x/p?a=1&b=2", 50, 500, "d3", None, 0),
        (7, "revisit", "http://a.x/p?a=1&b=2", 60, 304, "d2", None, 0),
        (8, "revisit", None, 60, 304, None, None, 0), (9, "revisit", "http://a.x/p?a=1&b=2", None, 304, None, None, 0),
    ], f"record_id long, kind string, url string, ts long, status int, digest string, headers {h}, outcome int")
    for ranges in (2, 64):
        got = {r.record_id: r for r in warc_revisit.resolve_revisits(spark, rec, ranges).collect()}
        assert {k: (r.outcome, r.source_id) for k, r in got.items()} == {
            2: ("resolved", 1), 4: ("validator_mismatch", None), 5: ("no_response", None), 7: ("resolved", 3),
            8: ("no_response", None), 9: ("no_response", None)}
        assert got[2].headers == {"etag": "W/e1", "date": "20", "content-length": "9"}
    assert warc_revisit.resolve_revisits(spark, rec.limit(0)).count() == 0


def page(i, body, extra=""):
    return (f"<html><head><title>t</title></head><body><nav><ul><li>Menu<li>More</ul></nav>{extra}{body}"
            f"<footer>&copy; site</footer></body></html>")


def test_html_induction_drops_repeated_slots(spark):
    # no landmark: only the repetition over the host's pages tells template from content
    pages = [(i, f"http://h.x/{i}", page(i, f"<section><h2>Story {i}</h2><p>Body {i} &amp; a\n  b<br>c</p><p>Two {i}</p></section>",
                                         "<section><b>Welcome to the site</b></section>"
                                         "<dl><dd>Trending now</dl>"), 0) for i in range(30)]
    pages += [(100, "http://one.y/", "<p>Lone &lt;page&gt;<p>second<div class='comments'><p>reply</div>", 0),
              (101, None, None, 0), (102, "", "", 0), (103, "http://h.x/1", pages[1][2], 0),
              (104, "http://z.z/", "<div>" * 3000 + "deep" + "<p>x" * 5, 0),
              (105, "http://m.m/", "<body><main><header><h1>T</h1></header><p>a</main><p>outside<aside>s", 0)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text int")
    got = {r.page_id: r for r in html_wrapper.extract_main_text(spark, df).collect()}
    assert len(got) == len(pages)
    assert got[3].text == "Story 3\nBody 3 & a b c\nTwo 3" or got[3].text.endswith("Story 3\nBody 3 & a b c\nTwo 3")
    assert "Trending" not in got[3].text and "Menu" not in got[3].text
    assert got[100].text == "Lone <page>\nsecond" and got[101].text == "" and got[102].n_chars == 0
    assert got[104].text.startswith("deep") and got[105].text == "T\na"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_wrapper.extract_main_text(spark, df.limit(0)).count() == 0


def test_simple_tree_matching_is_largest():
    a = "0:body 1:nav 1:div 3:p 1:section 5:h2 5:p"
    b = "0:body 1:div 2:p 1:section 4:p 1:footer"
    got = html_wrapper.align(a, b)
    assert got == {0: 0, 1: 1, 3: 2, 4: 3, 5: 4, 7: 5}


def test_article_of_every_page(spark):
    """The text between an article's tags, cut into blocks by hand."""
    import html as h

    df = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html_wrapper.extract_main_text(spark, df).join(df.select("page_id", "html"), "page_id").collect():
        art = r.html.split("<article>")[1].split("</article>")[0]
        parts = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>", "", art).replace("<br>", " "))
        want = [t for t in (" ".join(h.unescape(p).split()) for p in parts) if t]
        assert r.text.split("\n") == want


def html_texts(spark, pages):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_wrapper.extract_main_text(spark, df).collect()}


def test_html_copies_and_repeated_values_are_not_template(spark):
    twice = [(f"http://d.x/{i}", f"<div><h2>Story {i // 2}</h2><p>Body {i // 2}</div>") for i in range(12)]
    # 27 copies of one page, and 2 others, on one host
    copies = [(f"http://c.x/{i}", f"<article><h1>Title {max(0, i - 26)}</h1><p>Text {max(0, i - 26)}</article>")
              for i in range(29)]
    cells = [("http://t.x/", "<table><tr>" + "<td>yes</td>" * 6 + "</tr></table><p>end")]
    got = html_texts(spark, twice + copies + cells)
    assert [got[i] for i in range(12)] == [f"Story {i // 2}\nBody {i // 2}" for i in range(12)]
    assert [got[12 + i] for i in range(29)] == [f"Title {max(0, i - 26)}\nText {max(0, i - 26)}" for i in range(29)]
    assert got[41] == "\n".join(["yes"] * 6 + ["end"])


def test_html_slots_decide_beside_landmarks(spark):
    beside = [(f"http://b.x/{i}", f"<body><div>Site name</div><section><h1>Head {i}</h1><p>Lead {i}</section>"
                                  f"<article><p>Body {i}</article>") for i in range(8)]
    cards = [(f"http://k.x/{i}", f"<body><section><p>Whole body {i}</section><ul><li><article><p>Teaser {i}</article></ul>")
             for i in range(8)]
    got = html_texts(spark, beside + cards + [("http://s.x/", beside[0][1])])
    assert [got[i] for i in range(8)] == [f"Head {i}\nLead {i}\nBody {i}" for i in range(8)]
    assert [got[8 + i] for i in range(8)] == [f"Whole body {i}\nTeaser {i}" for i in range(8)]
    assert got[16] == "Body 0"     # one page tells nothing: landmarks are the prior


def test_html_attribute_names_are_not_looked_for_in_values():
    for attr in ('style="overflow: hidden"', "title='The hidden truth'", 'title="a class=ad id=b"', "data-x=/hidden/ y",
                 'alt = " role=search "', 'data-a="x"data-b=" hidden "'):
        assert html_wrapper.main_text(f"<div {attr}><article><p>text</article></div>", None) == "text", attr
        assert not html_wrapper._attributes(" " + attr)
    for attr in ("hidden", "x='1' HIDDEN", 'style="a"hidden', "hidden=''", "data-x=/a/ hidden", 'aria-hidden = "true"',
                 "Role=search"):
        assert html_wrapper.main_text(f"<p>text<div {attr}><p>gone</div>", None) == "text", attr
    assert html_wrapper._attributes(' class="a b" id=c class=d title="The hidden') == {"class": "a b", "id": "c"}


def test_html_names_of_template_are_whole_and_can_be_overridden(spark):
    for around in ("container no-sidebar", "layout has-sidebar", "layout sidebar"):
        assert html_wrapper.main_text(f"<div class='{around}'><main><p>text</main></div>", None) == "text", around
    for name in ("search-history", "social-policy", "related-work"):
        assert html_wrapper.main_text(f"<article><section class='{name}'><p>text</section></article>", None) == "text"
    assert html_wrapper.main_text("<article><p>a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b</article>", None) == "a x=2 b"
    assert html_wrapper.main_text("<p>text<div class='x Comments'><article class=comment><p>reply</div>", None) == "text"
    pages = [(f"http://n.x/{i}", f"<article><p>Body {i}<div class=notice><p>Found {i}</div><div class=share><p>Share"
                                 f"</div></article><div class=ad><p>Buy {i}</div>") for i in range(8)]
    plain = [(f"http://p.x/{i}", f"<div class=notice><p>Found {i}</div><div class=social><p>Follow us</div>")
             for i in range(8)]
    got = html_texts(spark, pages + plain + pages[:1] + [("http://q.x/", plain[0][1])])
    assert [got[i] for i in range(8)] == [f"Body {i}\nFound {i}" for i in range(8)]
    assert [got[8 + i] for i in range(8)] == [f"Found {i}" for i in range(8)]
    assert got[16] == got[0] and got[17] == ""


def test_html_deeply_nested_template_is_aligned(spark):
    assert len(html_wrapper.align(*[html_wrapper.Page("<div>" * 5000 + "x").skeleton()] * 2)) == 5001
    pages = [(f"http://e.x/{i}", "<div>" * 400 + f"<p>Body {i}</p><dl><dd>Trending now</dl>") for i in range(6)]
    assert html_texts(spark, pages) == {i: f"Body {i}" for i in range(6)}


@pytest.mark.parametrize("n", [1, 8, 30])
def test_html_comments_adverts_and_related_boxes_go_in_any_layout(spark, n):
    """They vary from page to page as articles do, and are template all the same."""
    def texts(make):
        return html_texts(spark, [(f"http://v.x/{i}", make(i)) for i in range(n)])

    body = "<h1>Title {0}</h1><p>First paragraph {0}</p><p>Second paragraph {0}</p>"
    want = {i: f"Title {i}\nFirst paragraph {i}\nSecond paragraph {i}" for i in range(n)}
    after = texts(lambda i: f"<main><article>{body.format(i)}</article><section class=comments><h2>Comments</h2>"
                            f"<article><p>Reader {i} says so</p></article></section></main>")
    bare = texts(lambda i: f"<div>{body.format(i)}</div><div class=ad><p>Buy {i}</p></div><div id=comments><p>Reader {i}"
                           f"</p></div><div class=related><p>More on {i}</p></div>")
    inside = texts(lambda i: f"<article>{body.format(i)}<div class=related><a href=/{i}>Teaser {i}</a></div>"
                             f"<div class='x comments'><p>Reader {i}</p></div></article>")
    assert after == want and bare == want and inside == want


def test_html_constant_headings_stay_and_constant_lines_go(spark):
    made = "<article><h1>Paper {0}</h1><h2>Abstract</h2><p>About {0}</p><h2>Conclusion</h2><p>So {0}</p>" \
           "<p>All rights reserved</p><table><tr><td>yes</td></tr></table><h2>Share this</h2><p class=x>Mail</p></article>"
    got = html_texts(spark, [(f"http://w.x/{i}", made.format(i)) for i in range(30)])
    assert got == {i: f"Paper {i}\nAbstract\nAbout {i}\nConclusion\nSo {i}\nyes" for i in range(30)} \
        or got == {i: f"Paper {i}\nAbstract\nAbout {i}\nConclusion\nSo {i}" for i in range(30)}


def test_html_slots_of_links_are_template(spark):
    """A menu without a telling name, whose entries differ from page to page."""
    made = "<body><div><div><a href=/{0}>Near {0}</a> <a href=/x{0}>Far {0}</a></div></div><section><p>Text {0}, " \
           "with <a href=/>a link</a> in it</p></section>"
    got = html_texts(spark, [(f"http://l.x/{i}", made.format(i)) for i in range(9)])
    assert got == {i: f"Text {i}, with a link in it" for i in range(9)}


def test_html_wrapper_decides_where_no_list_does(spark, monkeypatch):
    """With every list of names and roles emptied, the slots alone still find the
    article of the pages of larger hosts."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = pages.select("page_id", html_wrapper._host(F.col("url")).alias("host"), "html").collect()
    big = {h for h in {r.host for r in rows} if sum(r.host == h for r in rows) >= 9}
    listed = {r.page_id: r.text for r in html_wrapper.extract_main_text(spark, pages).collect()}
    packed = {r.host: r.packed for r in html_wrapper.induce(spark, pages).select(
        "host", F.to_json(F.struct("wrapper", "pages", "slots", "fixed")).alias("packed")).collect()}
    for name in ("ROLE_WORDS", "ALWAYS", "ROLES", "BOILERPLATE"):
        monkeypatch.setattr(html_wrapper, name, frozenset())
    mine = [r for r in rows if r.host in big]
    menu = [r for r in mine if r.html.split("<a href")[1].split(">")[1].split("<")[0]
            in html_wrapper.main_text(r.html, packed[r.host]).split("\n")]
    assert len(mine) > 50 and len(menu) <= 0.1 * len(mine)
    assert all(set(listed[r.page_id].split("\n")) <= set(html_wrapper.main_text(r.html, packed[r.host]).split("\n")) for r in mine)


def test_minhash_repeated_ids_with_different_texts(spark):
    text = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abc"}
    rows = [(1, text["a"], "x"), (1, text["b"], "x"), (2, text["a"] + " tail", "x"), (3, text["b"], "x"),
            (4, text["c"], "z"), (4, text["c"], "y"), (5, "", "x"), (5, None, "x"), (None, text["a"], "x")]
    want = {(1, text["a"], "x"), (1, text["b"], "x"), (4, text["c"], "y"), (None, text["a"], "x")}
    for order in (rows, rows[::-1]):
        got = [tuple(r) for r in minhash_tensor.drop_near_duplicates(
            spark, spark.createDataFrame(order, "doc_id long, text string, node string").repartition(3)).collect()]
        assert {r for r in got if r[1]} | {r for r in got if r[0] == 5} == set(got)
        assert {r for r in got if r[0] != 5} == want and len(got) == 5


def _near_misses(n, between, seed=5):
    """Texts of one template that share tables and mostly don't link (0.78), with
    a few whose own words differ in one place only, and ``between`` short ones that
    link all others."""
    rng = random.Random(seed)
    template = [f"t{i}" for i in range(181)]
    texts = {}
    for i in range(n):
        own = [f"o{i}x{k}" for k in range(25)]
        if i % 10 == 9:
            own = texts[i - 1].split()[181:-1] + [f"z{i}"]
        texts[i] = " ".join(template + own)
    for i in range(n, n + between):
        texts[i] = " ".join(template[:170] + [f"r{rng.random()}" for _ in range(3)])
    return texts


@pytest.mark.parametrize("n,between", [(150, 5), (600, 0)])
def test_minhash_near_misses_meet_in_proportion(spark, monkeypatch, n, between):
    """A template of near misses is one cluster; what is compared grows with the
    documents, not with their pairs, and the classes are those of brute force."""
    seen, whole = [], minhash_tensor.cross_candidates

    def counted(*args):
        out = whole(*args)
        seen.append(out.count())
        return out

    monkeypatch.setattr(minhash_tensor, "cross_candidates", counted)
    texts = _near_misses(n, between)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_tensor.near_duplicates(spark, df, width=2).collect()}
    assert got == brute_components(texts)
    # short texts in the middle settle all; without them the prefix filter decides
    assert len(seen) == (0 if between else 1) and sum(seen) <= 2 * n


def test_a_worker_keeps_the_caches_of_one_operator():
    from bowline.llm import common

    common.at_work("none")
    freed = []
    common.at_work("a", lambda: freed.append("a"))
    common.at_work("a", lambda: freed.append("a"))
    assert not freed
    common.at_work("b")
    assert freed == ["a"] and not common._HELD
