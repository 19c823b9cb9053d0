"""Page text: stories that a tag or a teaser hid, classes made for each page, and templates whose story is known."""

from __future__ import annotations

import random
import time

import pytest

from propensia.llm import html_wrapper as hw

NAV = "<nav><a href=x>Home</a> <a href=y>News</a></nav>"
FOOT = "<footer><p>All rights reserved by the makers of this page</p></footer>"


def story(i: int, words: int = 40) -> str:
    return " ".join(f"w{i}x{j}" for j in range(words))


def letters(n: int) -> str:
    return "".join(chr(97 + int(c)) for c in str(n))


def read_all(pages: list[str]) -> tuple[list[str], hw.Node]:
    trees = [hw.page_tree(hw.page_blocks(p))[0] for p in pages]
    wrapper = trees[0]
    for t in trees[1:]:
        wrapper = hw.merge(wrapper, t)
    slots = hw.main_slots(wrapper, len(pages))
    return ["\n".join(hw.main_blocks(wrapper, slots, p)) for p in pages], wrapper


@pytest.mark.parametrize("page", [
    "<body><form id='aspnetForm'>{nav}<article><h1>T{i}</h1><p>{s}</p></article></form></body>",
    "<body>{nav}<form id='page'><div class='text'><h1>T{i}</h1><p>{s}</p></div></form>{foot}</body>",
    "<body>{nav}<main><h1>T{i}</h1><p>{s}</p><article class='teaser'><p>other {i}</p></article></main></body>",
    "<body>{nav}<div class='content'><h1>T{i}</h1><p>{s}</p></div><article class='card'><p>other {i}</p></article>{foot}</body>",
    "<body>{nav}<article><h1>T{i}</h1><p>{s}</p></article><div class='byline'>By nobody {i}</div>{foot}</body>",
])
def test_stories_come_out(page):
    out, _ = read_all([page.format(nav=NAV, foot=FOOT, i=i, s=story(i)) for i in range(4)])
    assert out == [f"T{i}\n{story(i)}" for i in range(4)]


def test_pages_of_two_templates_keep_their_own_story():
    """Many pages without an article don't take it from those that have one."""
    a = "<body>{nav}<article><h1>T{i}</h1><p>{s}</p></article><div class='when'>day {i}</div></body>"
    b = "<body>{nav}<div class='content'><h1>T{i}</h1><p>{s}</p></div></body>"
    out, _ = read_all([(a if i % 9 == 0 else b).format(nav=NAV, i=i, s=story(i)) for i in range(27)])
    assert out == [f"T{i}\n{story(i)}" for i in range(27)]


def test_wrapper_does_not_grow_with_classes_of_each_page():
    page = "<body class='id-{c}'>{nav}<article class='post category-{c} tag-{d}'><h1>T{i}</h1><p class='lead-{c}'>{s}</p></article><div class='related-{c}'><p>also {i}</p></div>{foot}</body>"
    sizes, seconds = [], []
    for n in (500, 2000):
        pages = [page.format(nav=NAV, foot=FOOT, c=letters(i), d=letters(7 * i), i=i, s=story(i)) for i in range(n)]
        start = time.process_time()
        out, wrapper = read_all(pages)
        seconds.append(time.process_time() - start)
        sizes.append(len(hw.write_tree(wrapper)))
        assert out == [f"T{i}\n{story(i)}" for i in range(n)]
    assert sizes[1] < 1.1 * sizes[0] < 5000 and seconds[1] < 8 * seconds[0] + 0.5


def test_order_of_merging_does_not_matter_for_the_text():
    """Wrappers of parts, merged in any order, read the pages as the wrapper of all in turn does."""
    page = "<body>{nav}<article class='post tag-{c}'><h1>T{i}</h1>{ps}</article>{foot}</body>"
    rng = random.Random(1)
    pages = [page.format(nav=NAV, foot=FOOT, c=letters(i), i=i, ps="".join(f"<p>{story(100 * i + j)}</p>" for j in range(rng.randint(1, 4)))) for i in range(120)]
    want, _ = read_all(pages)
    for _ in range(3):
        parts = [hw.page_tree(hw.page_blocks(p))[0] for p in pages]
        while len(parts) > 1:
            rng.shuffle(parts)
            parts.append(hw.read_tree(hw.write_tree(hw.merge(parts.pop(), parts.pop()))))
        slots = hw.main_slots(parts[0], len(pages))
        assert ["\n".join(hw.main_blocks(parts[0], slots, p)) for p in pages] == want


def test_random_templates_give_the_known_story(spark):
    """Pages made from random templates of a host, whose story is known block by block: the query's text is that story."""
    rng, rows, want = random.Random(7), [], {}
    for host in range(6):
        box = rng.choice(["article", "main", "div class='story-text'"])
        before = rng.sample([NAV, "<header><p>The daily page</p></header>", "<div class='cookie-notice'><p>We use cookies here</p></div>"], 2)
        after = rng.sample([FOOT, "<aside><p>Read this as well</p></aside>", "<section class='comments'><p>{c}</p></section>", "<form><label>Your mail</label></form>"], 2)
        for n in range(400 if host == 0 else 12):   # one host has most of the pages
            i = len(rows)
            blocks = [f"Title {letters(i)}"] + [f"{story(1000 * i + j, rng.randint(15, 60))} &amp; more" for j in range(rng.randint(2, 6))]
            body = "".join(f"<{t}>{b}</{t}>" for t, b in zip(["h1"] + ["p"] * 9, blocks))
            rows.append((i, f"https://h{host}.example/{i}", "<html><body>" + "".join(before) + f"<{box}>{body}</{box.split()[0]}>"
                         + "".join(after).replace("{c}", f"I think {letters(i)}") + "<script>var a = 1;</script></body></html>"))
            want[i] = "\n".join(blocks).replace("&amp;", "&")
    long = " ".join(["word"] * 300_000)
    rows.append((len(rows), "https://long.example/", f"<body>{NAV}<article><p>{long}</p></article></body>"))
    want[len(rows) - 1] = long
    got = hw.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(7)).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)
