"""The corpus operators against brute force and on small hand-made cases: nulls,
empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from propensia.llm import byte_bpe, chat_format, common, exact_dedup, fertility, html_wrapper, ngram_join, packing, quality_model, queries, token_counts, url_rules

from ..conftest import SF001
from ..test_oracle import TABLES, _canon

DOC = "doc_id bigint, text string, kept string, _uid string, component_id int"
LONG = " ".join(f"word{i}" for i in range(30_000))


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", "y", 7) for i, t in zip(ids, texts)], DOC)


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, [None, "", " \n", "one two", "a b c d e f", LONG, "A B  C d\ne f", "a b c d e f", "tail"], [5, 4, 3, 2, 1, 0, 9, 8, None])


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    got, want = queries.QUERIES[key](spark, SF001).toPandas(), con.execute(queries.ORACLE[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _canon(got) == _canon(want)


# 1
def test_chat_collapse(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yes"), (3, 1, "assistant", "yes"),
            (4, None, "user", None), (4, 5, "assistant", "<|im_end|>"), (5, 0, None, ""), (None, 0, "user", "lost"), (6, 0, "user", "")]
    rows += [(7, i, "user", str(i)) for i in range(600)] + [(8, i + 10, "user", str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("pos", F.lit("clash"))
    out = {(r.conv_id, r.part): r for r in chat_format.format_chats(df).collect()}
    assert sorted(out) == [(1, 0), (4, 0), (5, 0), (6, 0), (7, 0), (7, 1), (7, 2)]   # 2 and 8 are prefixes, 3 is a copy of 1
    assert out[1, 0].n_copies == 2 and out[1, 0].text == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyes<|im_end|>\n"
    assert [out[1, 0].text[s.start:s.end] for s in out[1, 0].spans] == ["yes"]
    assert "<im_end>" in out[4, 0].text and out[4, 0].text.count("<|im_end|>") == 2
    assert chat_format.format_chats(df.limit(0)).count() == 0


# 2
PAGE = """<html><head><title>T</title><script>var a="</p><p>no</p>";</script></head><body><header>Site</header><nav><ul><li><a href=x>Menu</a></ul></nav>
<div class="sidebar">Side</div><div class="cookie-notice">Cookies</div><article class="has-sidebar"><header><h1>Title {n}</h1></header><p>One &amp; <b>two</b>
 three {n}<p>Four&nbsp;five<br>six<div class="ad">Buy</div><form><input>Mail</form><section id=comments><p>Reader {n}</section></article><footer>&copy; me</footer></body></html>"""


def test_html(spark):
    rows = [(i, f"http://a.example.org/{i}", PAGE.format(n=i)) for i in range(6)]
    rows += [(10 + i, f"http://b.example.org/{i}", f"<div>Home</div><div>Story {i} of this page</div><div>Imprint</div>") for i in range(4)]
    rows += [(20, None, "<p>alone"), (21, "http://a.example.org/x", None), (22, "nourl", ""), (23, "http://a.example.org/0", PAGE.format(n=0)), (None, "http://c", "<main>x<!-- no -->y</main>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit(1)).withColumn("pages", F.lit(2))
    out = {r.page_id: r for r in html_wrapper.extract_text(df).collect()}
    assert len(out) == len(rows)
    assert out[3].text == "Title 3\nOne & two three 3\nFour five six" and out[3].n_chars == len(out[3].text)
    assert out[0].text == out[23].text and out[12].text == "Story 2 of this page"
    assert out[20].text == "alone" and out[21].text == "" and out[22].text == "" and out[None].text == "xy"
    assert html_wrapper.extract_text(df.limit(0)).count() == 0


def test_html_words_in_names(spark):
    """A word of a class or id drops no article text that it doesn't name as boilerplate."""
    article = """<nav>Menu</nav><article><h1 id="social">Title {n}</h1><h2 id="related-work">Related work</h2><p>One {n}</p><section id="discussion"><p>Two {n}</p></section>
<div class="legal-analysis"><p>Three {n}</p></div><section id="social-history"><p>Four <math><mi>x</mi><mo>=</mo><mn>{n}</mn><annotation>tex</annotation></math></p></section>
<p class="notice">Five</p><div class="share-buttons">Share</div><div class="comments-section"><p>Reader {n}</p></div></article><footer>me</footer>"""
    layout = """<div class="site-nav"><a href=x>Menu</a></div><div class="content with-sidebar"><div class="text"><p>The story number {n} of this host, told at some length.</p></div>
<div class="left-sidebar">About {n}</div></div><div class="comments"><p>Reader {n} says what readers say</p></div><div class="legal">Imprint</div>"""
    rows = [(10 * k + n, f"http://{host}.example.org/{n}", page.format(n=n)) for k, (host, page) in enumerate((("a", article), ("b", layout))) for n in range(4)]
    out = {r.page_id: r.text for r in html_wrapper.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert out[3] == "Title 3\nRelated work\nOne 3\nTwo 3\nThree 3\nFour x=3\nFive"
    assert out[12] == "The story number 2 of this host, told at some length."


@pytest.mark.parametrize("depth", [60, 5000])
def test_html_deep_pages(spark, depth):
    page = "<div>" * depth + "<nav><a href=x>Menu</a> of it</nav><article><h1>Title {n}</h1><p>Story {n}</article><footer>me</footer>"
    rows = [(n, f"http://a.example.org/{n}", page.format(n=n) + "</div>" * (depth * (n % 2))) for n in range(4)]
    out = {r.page_id: r.text for r in html_wrapper.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert out == {n: f"Title {n}\nStory {n}" for n in range(4)}


def test_html_wrapper_groups():
    trees = [html_wrapper.page_tree(html_wrapper.page_blocks(h))[0] for h in ("<ul><li>a<li>b</ul><p>x", "<ul><li>a</ul><h2>t</h2><p>x", "<p>x<ul><li>c</ul><p>y")]
    two = html_wrapper.merge(trees[0], trees[1])
    assert html_wrapper.expression(two) == "<ul> (<li> #text </li>)+ </ul> (<h2> #constant </h2>)? <p> #constant </p>"
    assert html_wrapper.merge(two, trees[2])["m"]
    deep = "<div>" * 3000 + "deep" + "</div>" * 10
    assert [t for _, t, _ in html_wrapper.page_blocks(deep)] == ["deep"]


# 3
def test_exact_dedup(spark, odd):
    out = {r.doc_id: r for r in exact_dedup.exact_duplicates(odd).collect()}
    assert {i: r.keep_id for i, r in out.items()} == {5: 3, 4: 3, 3: 3, 2: 2, 1: 1, 0: 0, 9: 9, 8: 1, None: None}
    assert out[1].group_size == 2 and out[1].keep_id == 1 and out[9].group_size == 1 and out[8].keep_id == 1 and not out[8].kept
    assert out[3].group_size == 3 and out[3].kept and out[0].text_sha256 == hashlib.sha256("".join(LONG.split()).encode()).hexdigest()
    assert exact_dedup.exact_duplicates(odd.limit(0)).count() == 0
    twice = odd.union(odd)
    kept = exact_dedup.drop_exact_duplicates(twice)
    assert kept.columns == odd.columns and kept.count() == 6


def test_radix_digits(spark):
    random.seed(1)
    base = "".join(random.choice("ab") for _ in range(3000))
    texts = [base[:n] for n in (0, 3, 4, 5, 63, 64, 65, 1024, 3000, 64, 3000)] + [base[:2999] + "c"]
    rows = common.with_row_ids(docs(spark, texts).selectExpr("doc_id as _id", "cast(length(text) as int) as _cp", "cast(text as binary) as _norm"), "t")
    for digit in (1, 4, 64):
        got = {r._2: r._1 for r in exact_dedup.duplicate_groups(rows, digit).join(rows.select("_uid", "_id"), "_uid").selectExpr("keep_id as _1", "_id as _2").collect()}
        assert got == {5: 5, 9: 5, 8: 8, 10: 8}


# 4
def brute_join(texts):
    sets = []
    for t in texts:
        w = [x for x in (t or "").encode().lower().split()]
        sets.append({tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set()))
    link = [[j for j, b in enumerate(sets) if j != i and a and 100 * len(a & b) >= 85 * len(a | b)] for i, a in enumerate(sets)]
    comp = list(range(len(texts)))
    for _ in texts:
        comp = [min([comp[i], *(comp[j] for j in link[i])]) for i in range(len(texts))]
    return {i: (len(sets[i]), comp[i], len(link[i])) for i in range(len(texts))}


def near_texts(seed, groups, copies):
    rng = random.Random(seed)
    common = " ".join(f"c{i}" for i in range(60))
    texts = []
    for g in range(groups):
        words = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice((5, 8, 20, 90, 200)))]
        for _ in range(copies):
            own = list(words)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(9)}"
            texts.append(" ".join(own) + (" " + common if rng.random() < 0.5 else ""))
    return texts


@pytest.mark.parametrize("rare,block", [(64, 1024), (3, 4)])
def test_ngram_join(spark, monkeypatch, rare, block):
    texts = near_texts(rare, 12, 25) + [None, "", "a b", "A  b", "a b c", "a b c d"]
    monkeypatch.setattr(ngram_join, "RARE", rare)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    out = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.near_duplicates(docs(spark, texts)).collect()}
    assert out == brute_join(texts)
    alone = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs(spark, texts), n_links=False).collect()}
    assert alone == {i: r[:2] for i, r in out.items()}


def test_one_large_near_group_is_not_compared_block_by_block(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(w if i != k else f"x{k}" for i, w in enumerate(words)) for k in rng.sample(range(200), 120)] + ["a b c d e"]
    monkeypatch.setattr(ngram_join, "RARE", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    compared, verify = [], ngram_join._verify_blocks
    monkeypatch.setattr(ngram_join, "_verify_blocks", lambda pairs, *rest: compared.append(pairs.count()) or verify(pairs, *rest))
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs(spark, texts), n_links=False).collect()}
    assert got == {i: r[1] for i, r in brute_join(texts).items()}
    ngram_join.near_duplicates(docs(spark, texts)).count()
    assert compared[1] == 0 and 3 * compared[0] < compared[2]


def test_common_passage_beside_own_text_makes_no_blocks(spark, monkeypatch):
    """A passage in all documents, a quarter of each: no block of unlike documents is compared; near copies of one are."""
    rng = random.Random(6)
    common = " ".join(f"c{i}" for i in range(25))
    texts = [common + " " + " ".join(f"d{i}w{rng.randrange(900)}" for _ in range(75)) for i in range(40)]
    texts += [t.replace(t.split()[60], "other", 1) for t in texts[:20]] + texts[:5]
    monkeypatch.setattr(ngram_join, "RARE", 3)
    compared, verify = [], ngram_join._verify_blocks
    monkeypatch.setattr(ngram_join, "_verify_blocks", lambda pairs, *rest: compared.append(pairs.count()) or verify(pairs, *rest))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.near_duplicates(docs(spark, texts)).collect()}
    assert got == brute_join(texts) and len({r[1] for r in got.values()}) == 40
    assert sum(compared) == 0


def test_ngram_join_in_rounds(spark, monkeypatch):
    """Rounds of some sizes give what one gives, and none sends more than it may, on average."""
    texts = [t for t in near_texts(4, 3, 14) if len(t) > 60]
    sent, rounds = [], ngram_join._rounds
    monkeypatch.setattr(ngram_join, "RARE", 6)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "_rounds", lambda df, by, tokens, most: sent.append(len(out := rounds(df, by, 4, 2 if tokens else 9))) or out)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.near_duplicates(docs(spark, texts)).collect()}
    assert got == brute_join(texts) and sent.count(3) >= 3
    df = docs(spark, texts)
    for tokens, most, n in ((0, 9, 1), (8, 9, 1), (9, 9, 2), (100, 9, 12), (None, 9, 1)):
        parts = rounds(df, ["doc_id"], tokens, most)
        assert len(parts) == n and sorted(r.doc_id for part in parts for r in part.collect()) == sorted(r.doc_id for r in df.collect())


@pytest.mark.parametrize("n", [5, 6, 13, 40, 400])
def test_index_keys_of_sets_with_few_frequent_tokens(n):
    """Sets with fewer frequent tokens than linked sets share are indexed by their rare ones alone, the others by pairs too."""
    low = int(ngram_join.shared(ngram_join.smallest_partner(n)))
    size = int(ngram_join.misses(n) + ngram_join.shared(n))
    tokens = np.sort(np.random.default_rng(n).integers(0, 1 << 62, size).astype(np.uint64))
    for often in range(size + 1):
        keys, rare = ngram_join.index_keys(tokens, np.arange(size) < often, n)
        assert rare.sum() == size - often and (len(keys) > rare.sum()) == (often >= low)


def test_ngram_join_odd(spark, odd):
    got = ngram_join.near_duplicates(odd.union(odd.where("doc_id = 8")))
    assert got.count() == 10 and got.where("doc_id = 9 and component_id = 1 and n_links = 3").count() == 1
    assert ngram_join.near_duplicates(odd.limit(0)).count() == 0
    kept = ngram_join.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 0), (False, 1), (False, 2), (False, 3), (False, 4), (False, 5), (True, 0)]


# 5
def test_url_rules(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.example.net", "/en/x", "block"), ("org", "/f", "allow"), ("org", "/fr/", "block"), ("", "", "block")]
    hosts = ["net", "example.net", "a.example.net", "b.a.example.net", "xnet", "NET", "org", "q.org", "example.network"]
    urls = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/en/", "/en/xy", "/fr/1?q", "/fo#x", "?/en/")] + [None, "no url", "x://", "http://net/en/\n"]
    urls = urls * 3
    pages = spark.createDataFrame([(i if i else None, u) for i, u in enumerate(urls)], "page_id bigint, url string").withColumn("verdict", F.lit(1))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else None
        host = path = ""
        if rest is not None:
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p) and (h or not host)]
        best = max(fit, default=(0, 0, None, "allow"))
        assert got[i or None] == (host, path, best[2], best[3]), u
    assert url_rules.judge_urls(pages.limit(0), url_rules.default_rules(spark)).count() == 0


# 6
def test_byte_bpe(spark, odd):
    import base64

    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.BYTE_RANKS, "rb"))}
    want = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [None, "", "née 日本🎉  x\n\n y's aaaaaa <|endoftext|>\x1c z", " lead", "trail ", LONG]
    rows = byte_bpe.decode_ids(byte_bpe.encode_texts(docs(spark, texts), queries.BYTE_RANKS, P.PATTERN), queries.BYTE_RANKS, P.PATTERN).collect()
    for r in rows:
        t = texts[r.doc_id] or ""
        assert r.ids == want.encode_ordinary(t) and bytes(r.data).decode() == t
    encoded = byte_bpe.encode_texts(docs(spark, texts), queries.BYTE_RANKS, P.PATTERN)
    for size in (1, 3, 4096):   # pieces of one id split every character of several tokens
        for r in byte_bpe.decode_texts(encoded, queries.BYTE_RANKS, P.PATTERN, size).collect():
            assert r.text == (texts[r.doc_id] or "") and list(r.ids) == want.encode_ordinary(r.text)
            assert (r.ends[-1] if r.ends else 0) == len(r.text) and len(r.starts) == len(r.ids)
    torn = spark.createDataFrame([(1, bpe_ids := want.encode_ordinary("🎉")[:-1]), (2, None)], "doc_id long, ids array<int>")
    assert bpe_ids and {r.doc_id: r.text for r in byte_bpe.decode_texts(torn, queries.BYTE_RANKS, P.PATTERN, 1).collect()} == \
        {1: want.decode_bytes(bpe_ids).decode("utf-8", "replace"), 2: ""}
    assert byte_bpe.encode_texts(odd.limit(0), queries.BYTE_RANKS, P.PATTERN).count() == 0
    bpe = byte_bpe.byte_bpe(queries.BYTE_RANKS, P.PATTERN)
    t = "né日🎉x"
    ids = bpe.encode([t])[0]
    starts, ends = bpe.offsets(t, ids)
    assert starts[0] == 0 and ends[-1] == len(t) and all(a < b for a, b in zip(starts, ends))
    for cut in range(len(ids)):
        assert "".join(bpe.decode_stream([ids[:cut], ids[cut:]])) == t


# 7
def test_ordinal_model_held_out():
    rng = random.Random(2)
    def text(g):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, 400))]
        if g == 0:
            words = [w + rng.choice(("***", "###")) for w in words]
        if g == 1:
            words[rng.randrange(len(words))] = "idiot"
            words[0] = rng.choice(("Moron", "clown,"))
        return " ".join(words)
    grades = np.array([rng.choice((0, 1, 2, 2)) for _ in range(1200)])
    found = quality_model.text_features([text(g) for g in grades])
    model = quality_model.fit_ordinal(found[:800], grades[:800])
    tails = model.tails(found[800:])
    assert np.all(np.diff(model.thresholds) >= 0) and np.all(tails[:, 0] >= tails[:, 1])
    assert ((tails > 0.5).sum(1) == grades[800:]).mean() > 0.95


def test_ordinal_model_stems_and_held_out_tail():
    """Toxic words that hardly ever come twice in one form are known by their stem."""
    rng = random.Random(5)
    def text(g):
        words = ["".join(rng.choices(("ka", "lo", "mi", "ne", "ru", "so", "ti", "ve"), k=3)) for _ in range(rng.randrange(30, 120))]
        if g == 1:
            for _ in range(3):
                words[rng.randrange(len(words))] = "bomente" + "".join(rng.choices("abcdefghij", k=4))
        return " ".join(words)
    grades = np.array([rng.choice((1, 2, 2, 2)) for _ in range(4600)])
    found = quality_model.text_features([text(g) for g in grades])
    least = quality_model.held_out_tail(found[:3600], grades[:3600])
    tails = quality_model.fit_ordinal(found[:3600], grades[:3600]).tails(found[3600:])[:, -1]
    assert (tails >= least)[grades[3600:] == 2].mean() > 0.99 and (tails >= least)[grades[3600:] == 1].mean() < 0.05
    few = quality_model.held_out_tail(found[:100], grades[:100])   # the same rule for few documents
    assert 0 < few < 1 and few != quality_model.MIN_TAIL
    assert quality_model.held_out_tail(found[:9], np.zeros(9, np.int64)) == quality_model.MIN_TAIL   # no clean one


def test_quality_model_odd(spark, odd):
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (None, 1, 0), (4, None, None), (1, 1, 1)], "doc_id bigint, quality int, toxic int")
    rows = quality_model.labelled_features(odd, labels)
    assert [g for g, _ in rows] == [0, 1]
    assert len(quality_model.labelled_features(odd, labels, max_labels=1)) == 1
    none = quality_model.fit_model(odd, labels.limit(0))
    assert quality_model.drop_low_grades(odd, none).columns == odd.columns and quality_model.drop_low_grades(odd, none).count() == 9
    assert quality_model.score_texts(odd.limit(0), none, ["doc_id"]).count() == 0


def test_quality_model_repeated_documents(spark):
    """One row per rated document is collected, however often it comes, and no rating is lost."""
    df = docs(spark, [f"same id {i % 3}" for i in range(40)] + ["last one"], [1] * 40 + [2])
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    for frame in (df, df.repartition(5)):
        rows = quality_model.labelled_features(frame, labels, max_labels=2)
        assert [g for g, _ in rows] == [0, 2] and all(np.array_equal(a, b) for (_, x), (_, y) in zip(rows, quality_model.labelled_features(df, labels)) for a, b in zip(x, y))


# 8
@pytest.mark.parametrize("seed", range(4))
def test_pack_plan(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 101, 400) if seed else np.array([60] * 7 + [100] * 3)
    plan = packing.pack_plan(np.bincount(lengths, minlength=101), 100)
    used = np.sort(np.concatenate([np.repeat(items, times) for items, times in plan]))
    assert np.array_equal(used, np.sort(lengths)) and all(sum(items) <= 100 for items, _ in plan)
    gaps = []   # plain first-fit decreasing
    for n in sorted(lengths, reverse=True):
        at = next((i for i, g in enumerate(gaps) if g >= n), None)
        if at is None:
            gaps.append(100 - n)
        else:
            gaps[at] -= n
    assert sum(times for _, times in plan) <= len(gaps)


def test_pair_sums_follow_the_counts():
    rng = np.random.default_rng(8)
    counts = rng.integers(0, 3, 41)
    counts[0] = 0
    on_hand = packing._Lengths(counts)
    for _ in range(200):
        n = int(rng.integers(1, 41))
        on_hand.change(n, -int(rng.integers(0, on_hand.left[n] + 1)) if rng.random() < 0.6 else int(rng.integers(0, 3)))
        want = np.zeros(82, np.int64)
        for a in range(1, 41):
            for b in range(1, a + 1):
                want[a + b] += bool(on_hand.left[a] and on_hand.left[b] > (a == b))
        assert np.array_equal(on_hand.pairs, want)
        gap = int(rng.integers(1, 41))
        pieces = [int(n) for n in np.repeat(np.arange(41), on_hand.left)]
        found = on_hand.complement(gap)
        sums = {sum(c) for k in (1, 2, 3) for c in itertools.combinations(pieces, k)} if len(pieces) < 60 else None
        assert sum(found) in (0, gap) and (sums is None or bool(found) == (gap in sums))


def test_pack_documents(spark, odd):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.WORD_JSON)
    rows = packing.pack_documents(odd.union(odd), queries.WORD_JSON).collect()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, text in texts.items():
        ids = t.encode(text, add_special_tokens=False).ids + [1]
        want = [(k, at, len(ids[at:at + 4096]), zlib.crc32(np.array(ids[at:at + 4096], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]) == sorted(want * 2)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    assert packing.pack_documents(odd.limit(0), queries.WORD_JSON).count() == 0


# 9
def test_quality_measures(spark, odd):
    texts = [None, "", "a b", "x y z q r " * 4, "One line here.\nOne line here.\n\n \nother | # line with more words in it", "é\u00a0é " + LONG, "日本語のテキスト " * 12]
    out = {r.doc_id: r for r in fertility.quality_measures(docs(spark, texts), queries.PIECE_MODEL).collect()}
    for i, t in enumerate(texts):
        words = (t or "").encode().split()
        windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
        again = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(5)} if len(words) < 1000 else set()
        lines = [x for x in (t or "").split("\n") if x.encode().strip()]
        want = (len(words), sum(len(w.decode()) for w in words), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again))
        assert (out[i].n_words, out[i].word_chars, out[i].n_symbols, out[i].n_dup_lines, out[i].n_repeat_words) == want
        assert out[i].base_failed == (len(words) < 10 or 100 * len(again) > 20 * len(words)) and not (out[i].base_failed and out[i].kept)
    assert out[6].script == "cjk" and out[5].reasons == ["entropy"]   # one word and digits, again and again
    prose = "The river rose slowly through the spring, and by the time the orchards were in bloom nobody could remember when it had last been quiet."
    kept = fertility.drop_rejected(odd.union(docs(spark, [prose], [77])), queries.PIECE_MODEL)
    assert kept.columns == odd.columns and [r.doc_id for r in kept.collect()] == [77]
    assert fertility.quality_measures(odd.limit(0), queries.PIECE_MODEL).count() == 0


def test_quality_bands_of_the_corpus(spark):
    """One noisy document per measure passes the base rules and its script's fixed band, and falls by its language's own."""
    rng = random.Random(9)
    words = "the river rose slowly through spring and by time orchards were in bloom nobody could remember when it had last been quiet there".split()
    syllables = ["ban", "del", "mor", "ti", "ster", "vo", "land", "er", "ing"]
    words += ["".join(rng.choices(syllables, k=2)) for _ in range(300)]
    clean = [" ".join(rng.choices(words, k=150)) for _ in range(150)]
    noisy = {"chars_per_token": " ".join("".join(rng.choices("qxzjkvwpbg", k=6)) for _ in range(90)),
             "byte_share": " ".join(w + "\U0001F9FF" * (i % 30 == 9) for i, w in enumerate(rng.choices(words, k=90))),
             "entropy": " ".join(rng.choices(words[23:36], k=150))}
    rows = [(i, t, lang) for lang in ("xx", None) for i, t in enumerate([*clean, *noisy.values()])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    judged = fertility.quality_measures(df, queries.PIECE_MODEL, keep=["doc_id", "lang"]).collect()
    for lang in ("xx", None):
        out = {r.doc_id: r for r in judged if r.lang == lang}
        assert all(out[i].kept for i in range(150))
        for i, measure in enumerate(noisy, 150):
            assert not out[i].base_failed and measure in out[i].reasons and not out[i].kept, (measure, out[i])
            band = fertility.BANDS[out[i].script]
            assert band.min_chars_per_token <= out[i].chars_per_token and out[i].byte_share <= band.max_byte_share and out[i].entropy_share >= band.min_entropy_share
    kept = fertility.drop_rejected(df, queries.PIECE_MODEL)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted([*range(150)] * 2)


# 10
def test_separator_scan(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(3)
    want, blocks = {}, []
    monkeypatch.setattr(token_counts, "GROUP_SHIFT", 1)
    for shard in range(5):
        ids = np.where(rng.random(97 + shard) < (0, 0.1, 0.5, 1, 0.02)[shard], 9, 1).astype("<u2")
        cuts = [-1, *np.flatnonzero(ids == 9)]
        rows = [(a + 1, b - a - 1, True) for a, b in zip(cuts, cuts[1:])]
        if cuts[-1] < len(ids) - 1:
            rows.append((cuts[-1] + 1, len(ids) - cuts[-1] - 1, False))
        want |= {(shard, i): tuple(map(int, r[:2])) + (r[2],) for i, r in enumerate(rows)}
        blocks += [(shard, k, bytearray(ids[k * 7:k * 7 + 7].tobytes())) for k in range(-(-len(ids) // 7))]
        (tmp_path / f"s{shard}.bin").write_bytes(ids.tobytes())
    (tmp_path / "empty.bin").write_bytes(b"")
    df = spark.createDataFrame(blocks, "shard int, block bigint, data binary")
    got = {(r.shard, r.doc_no): (r.start, r.n_tokens, r.terminated) for r in token_counts.count_documents(token_counts.find_separators(df, 9)).collect()}
    assert got == want
    files = token_counts.read_token_files(spark, str(tmp_path), block_bytes=14)
    again = token_counts.count_documents(token_counts.find_separators(files, 9)).collect()
    assert sorted((r.start, r.n_tokens, r.terminated) for r in again) == sorted(want.values())


def test_document_token_counts(spark, odd):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.BYTE_JSON)
    want = {r.doc_id: len(t.encode(r.text or "", add_special_tokens=False).ids) for r in odd.collect()}
    assert {r.doc_id: r.n_tokens for r in token_counts.document_token_counts(odd, queries.BYTE_JSON, queries.BYTE_JSON_EOD).collect()} == want
    assert token_counts.document_token_counts(odd.limit(0), queries.BYTE_JSON, queries.BYTE_JSON_EOD).count() == 0


# pipeline
def test_pipeline(spark):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, SF001).toPandas()
    source = common.read(spark, SF001, "documents")
    frame = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, frame, SF001)
        assert after.columns == source.columns and 0 < after.count() <= frame.count()
        frame = common.stage(after, "test")
    assert set(out.doc_id) == {r.doc_id for r in frame.select("doc_id").collect()}
    texts = [r.text for r in frame.select("text").collect()]
    found = brute_join(texts)
    assert all(links == 0 for _, _, links in found.values()) and len({"".join(t.split()) for t in texts}) == len(texts)
