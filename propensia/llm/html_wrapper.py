"""Main text of web pages by wrapper inference (union-free regular expressions).

The pages of a host come from few templates. Each page's token stream is read as
a tree of its block elements; the trees of a host are aligned one after the
other into one wrapper. Elements that match are merged; a mismatch becomes an
optional element if one side lacks it, a repeated element if the sides have it
in different numbers, and a repeated group of optional elements if the order
differs too. Every element keeps what is known about its text slot: on how many
pages it has text, how much of it, how much of that in links, and whether it was
ever different. Wrappers are merged per task first, then by salted host, then by
host, so no task holds a host's pages.

The finished wrapper says which slots are the article: slots under menus,
headers, footers, sidebars, notices, adverts, forms or comments are not (inside an
article only containers whose whole class names one, outside it any element that
doesn't hold most of the host's varying text); if the
template has an article (else a main) element, only slots inside it are; else a slot
whose text is the same on all of the host's pages is template text, and so are
slots that are mostly links (this also goes for single pages without the article element).
If the host's articles hold less text than stands beside them, they may be teasers: a page
then gives the story beside its articles if that is longer. Pages are then read again along their host's wrapper.

A wrapper doesn't grow with the pages: where elements of one name have more than
``KINDS`` keys in one element (classes made for each page, as blogs write them), they
become one repeated group under the name and the words that mark boilerplate.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Generator, Iterable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, slices, stage
from .url_rules import url_host

# Element names of the HTML standard by what they do to text.
SWALLOW = frozenset("script style textarea title noscript template".split())   # without an end tag they take the rest of the page
RAW = SWALLOW | frozenset("iframe object svg canvas audio video select datalist button annotation annotation-xml".split())   # math is text, but for its unseen annotations
BLOCKS = frozenset("""html body article main section nav header footer aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr
    td th caption blockquote pre figure figcaption form fieldset legend details summary dialog address hr center menu hgroup search""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of the first kind ends an open element of the second in the same container.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
HOLDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",), "tfoot": ("table",)}

BOILER_TAGS = frozenset("nav footer aside form dialog menu search".split())
#: Different keys that elements of one name may have in one element of a wrapper.
KINDS = 24
BOILER_WORDS = frozenset("""nav navbar navigation menu menubar topbar header masthead footer foot sidebar side aside widget widgets ad ads advert adverts
    advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay
    comment comments reply replies disqus discussion respond share sharing social related recommended breadcrumb breadcrumbs pagination pager
    newsletter subscribe signup login toolbar skip copyright legal disclaimer tags tagcloud""".split())
#: Of these, words that name what stands beside an article even if articles are in it.
BESIDE_WORDS = frozenset("""comment comments reply replies disqus discussion respond related recommended promo promotion sponsor sponsored ad ads
    advert adverts advertisement newsletter""".split())

#: Words that may stand with these in a class's name for boilerplate inside an article ("comments-section"); with any other it names something else.
PLAIN_WORDS = frozenset("""box block container wrapper wrap area section list item items link links post posts article articles story stories button buttons bar
    inner outer unit slot site page global top bottom left right primary secondary""".split())
#: Whole ids that name boilerplate inside an article; other ids there are anchors made from a heading.
ID_WORDS = frozenset("""comment comments disqus respond replies sidebar navbar menubar topbar masthead adsense breadcrumb breadcrumbs pagination newsletter
    subscribe toolbar tagcloud""".split())
CONTAINERS = frozenset("div section aside nav header footer form ul ol dl menu table center details fieldset hgroup search dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|$)", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
Node = dict   # key, kids (list of runs [key, repeated, [nodes]]), mixed, optional, slot [pages, chars, links, hash, varies]


def _words(value: str) -> list[str]:
    return re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())


def _names_boilerplate(token: str, is_id: bool) -> bool:
    if is_id:
        return token.lower() in ID_WORDS
    words = set(_words(token)) - {"header"}
    return bool(words & BOILER_WORDS) and words <= BOILER_WORDS | PLAIN_WORDS


def _element(name: str, tag: str) -> tuple[str, bool]:
    """The element's key and whether it is hidden. The key is the name, the words
    of class, role and id (a heading's id says what its text says), and "!" if a
    container's whole class, role or id names boilerplate."""
    words, hidden, named = [], False, False
    if len(tag) > len(name) + 2:
        for attribute, value in _ATTRIBUTE.findall(tag[len(name) + 1:].rstrip("/>")):
            attribute, value = attribute.lower(), value.strip("\"'")
            if attribute == "hidden":
                hidden = True
            elif attribute == "style":
                hidden |= bool(_HIDDEN.search(value))
            elif name not in ("html", "body") and (attribute != "id" or name not in HEADINGS):   # a page has one of these, whatever its class
                words += _words(value)
                named |= any(_names_boilerplate(token, attribute == "id") for token in value.split())
    return " ".join([name, *["!"] * (named and name in CONTAINERS), *sorted(set(words))]), hidden


def page_blocks(page: str) -> Iterator[tuple[tuple | None, str, int]]:
    """The page's runs of text in order: innermost element (its key, its number in
    the page, the element around it; none at the root), text (white space runs as one space, references
    decoded), and how many of its characters are in links."""
    path: list[tuple] = []
    names: list[str] = []
    hidden, links, serial, at, raw = 0, 0, 0, 0, ""
    text: list[str] = []
    linked = 0
    depth_hidden: list[bool] = []

    def flush():
        nonlocal linked
        said, in_links = " ".join("".join(text).split()), linked
        text.clear()
        linked = 0
        return (path[-1] if path else None, said, min(in_links, len(said))) if said and not hidden else None

    for m in _TOKEN.finditer(page + " "):
        if m.start() < at:
            continue
        if m.start() > at:
            piece = html.unescape(page[at:m.start()])
            text.append(piece)
            linked += len(" ".join(piece.split())) if links else 0
        at = m.end()
        tag = m.group()
        found = _NAME.match(tag)
        if not found:
            continue
        name, closing = found.group(1).lower(), tag[1] == "/"
        if not closing and name in RAW and not tag.endswith("/>"):   # its contents are no markup of the page
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page) if name in SWALLOW else at
            text.append(" ")
            continue
        if name == "a":
            links = 0 if closing else 1
            continue
        if name == "br":
            text.append(" ")
        if name not in BLOCKS:
            continue
        if out := flush():
            yield out
        links = 0
        if closing:
            if name in names:
                while names.pop() != name:
                    path.pop()
                    hidden -= depth_hidden.pop()
                path.pop()
                hidden -= depth_hidden.pop()
            continue
        while names and names[-1] == "p":   # no block stands in a paragraph
            names.pop(), path.pop()
            hidden -= depth_hidden.pop()
        if name in CLOSES:
            stop = max([len(names) - 1 - names[::-1].index(h) for h in HOLDS.get(name, ()) if h in names], default=-1)
            open_ = [i for i in range(stop + 1, len(names)) if names[i] in CLOSES[name]]
            if open_:
                for _ in range(len(names) - open_[0]):
                    names.pop(), path.pop()
                    hidden -= depth_hidden.pop()
        if name in VOID:
            continue
        key, unseen = _element(name, tag)
        serial += 1
        names.append(name)
        path.append((key, serial, path[-1] if path else None))
        depth_hidden.append(unseen)
        hidden += unseen
    if at < len(page) and (rest := page[at:]):
        text.append(html.unescape(rest))
    if out := flush():
        yield out


def _node(key: str) -> Node:
    return {"k": key, "r": [], "m": False, "o": False, "s": [0, 0, 0, None, False]}


def page_tree(blocks: Iterable[tuple]) -> tuple[Node, list[tuple[Node, str]]]:
    """The page as a wrapper of itself, and its texts with their elements."""
    root, made, texts = _node(""), {}, []
    for step, text, links in blocks:
        new = []
        while step and step[1] not in made:
            new.append(step)
            step = step[2]
        at = made[step[1]] if step else root
        for key, serial, _ in reversed(new):
            made[serial] = kid = _node(key)
            if at["r"] and at["r"][-1][0] == key:
                at["r"][-1][2].append(kid)
            else:
                at["r"].append([key, False, [kid]])
            at = kid
        texts.append((at, text))
        s = at["s"]
        s[0], s[1], s[2] = 1, s[1] + len(text), s[2] + links
        s[3] = xxhash.xxh64_intdigest(text, seed=s[3] or 0)
    return root, texts


def _merge_slots(a: list, b: list) -> list:
    return [a[0] + b[0], a[1] + b[1], a[2] + b[2], b[3] if a[3] is None else a[3],
            a[4] or b[4] or (a[3] is not None and b[3] is not None and a[3] != b[3])]


def merge(a: Node, b: Node) -> Node:
    """One element that stands for both. Elements inside are merged on a stack of
    its own, so that no depth is too great."""
    stack, done = [_merge(a, b)], None
    while stack:
        try:
            pair = stack[-1].send(done)
        except StopIteration as end:
            stack.pop()
            done = end.value
        else:
            stack.append(_merge(*pair))
            done = None
    return done


Merging = Generator[tuple[Node, Node], Node, object]   # asks for two elements to be merged, gets the one that stands for them


def _general(key: str) -> str:
    """The key of all elements of its name that are alike in the words that mark boilerplate."""
    name, *words = key.split(" ")
    return " ".join([name, "*", *(w for w in words if w == "!" or w in BOILER_WORDS)])


def _crowded(keys: Iterable[str]) -> set[str]:
    """The names with more than KINDS keys, or with a general key already."""
    kinds: dict[str, int] = {}
    for name, *words in map(str.split, filter(None, keys)):
        kinds[name] = kinds.get(name, 0) + (KINDS + 1 if words[:1] == ["*"] else 1)
    return {name for name, n in kinds.items() if n > KINDS}


def _merge(a: Node, b: Node) -> Merging:
    out = {"k": a["k"], "m": a["m"] or b["m"], "o": a["o"] or b["o"], "s": _merge_slots(a["s"], b["s"]), "r": []}
    if crowded := _crowded({r[0] for r in a["r"]} | {r[0] for r in b["r"]}):
        out["m"] = True
        a, b = ({**n, "r": [[_general(r[0]) if r[0].split(" ")[0] in crowded else r[0], *r[1:]] for r in n["r"]]} for n in (a, b))
    keys_a, keys_b = [r[0] for r in a["r"]], [r[0] for r in b["r"]]
    if not out["m"] and keys_a == keys_b:
        for x, y in zip(a["r"], b["r"]):
            out["r"].append((yield from _merge_runs(x, y)))
        return out
    if not out["m"] and len(set(keys_a)) == len(keys_a) and len(set(keys_b)) == len(keys_b):
        runs = yield from _align(a["r"], b["r"], keys_a, keys_b)
        if len({r[0] for r in runs}) == len(runs):
            out["r"] = runs
            return out
    out["m"] = True   # a repeated group of optional elements, one of each key
    by_key: dict[str, list] = {}
    for key, _, nodes in [*a["r"], *b["r"]]:
        by_key.setdefault(key, []).extend(nodes)
    for key, nodes in by_key.items():
        out["r"].append([key, True, [{**(yield from _fold(nodes)), "k": key}]])
    return out


def _fold(nodes: list[Node]) -> Merging:
    out = nodes[0]
    for n in nodes[1:]:
        out = yield out, n
    return {**out, "o": True}


def _merge_runs(x: list, y: list) -> Merging:
    if not x[1] and not y[1] and len(x[2]) == len(y[2]):
        merged = []
        for n, m in zip(x[2], y[2]):
            merged.append((yield n, m))
        return [x[0], False, merged]
    folded = yield from _fold([*x[2], *y[2]])
    return [x[0], True, [{**folded, "o": x[2][0]["o"] or y[2][0]["o"]}]]


def _align(a: list, b: list, keys_a: list[str], keys_b: list[str]) -> Merging:
    optional = lambda run: [run[0], run[1], [{**n, "o": True} for n in run[2]]]
    out = []
    for kind, i, j, x, y in SequenceMatcher(None, keys_a, keys_b, autojunk=False).get_opcodes():
        if kind == "equal":
            for p, q in zip(a[i:j], b[x:y]):
                out.append((yield from _merge_runs(p, q)))
        else:
            out += [optional(r) for r in [*a[i:j], *b[x:y]]]
    return out


def _walk(root: Node) -> Iterator[tuple[Node, int, int, bool]]:
    """The elements in order, each with its depth, the number of its run in the element around it, and whether that is repeated."""
    todo = [(root, 0, 0, False)]
    while todo:
        node, depth, _, _ = found = todo.pop()
        yield found
        todo += [(n, depth + 1, i, run[1]) for i, run in reversed([*enumerate(node["r"])]) for n in reversed(run[2])]


def write_tree(root: Node) -> str:
    return json.dumps([[depth, i, repeated, n["k"], n["m"], n["o"], n["s"]] for n, depth, i, repeated in _walk(root)], separators=(",", ":"))


def read_tree(text: str) -> Node:
    path: list[Node] = []
    for depth, i, repeated, key, mixed, optional, slot in json.loads(text):
        node = {"k": key, "r": [], "m": mixed, "o": optional, "s": slot}
        del path[depth:]
        if path:
            runs = path[-1]["r"]
            if i == len(runs):
                runs.append([key, repeated, []])
            runs[i][2].append(node)
        path.append(node)
    return path[0]


def expression(node: Node) -> str:
    """The wrapper as a union-free regular expression, for people."""
    def one(run: list) -> str:
        body = " ".join(expression(n) for n in run[2])
        return f"({body})+" if run[1] else body
    inside = " ".join(([f"#{'text' if node['s'][4] else 'constant'}"] if node["s"][0] else []) + [one(r) for r in node["r"]])
    inside = f"({inside})+" if node["m"] else inside
    text = f"<{node['k']}> {inside} </{node['k'].split()[0]}>" if node["k"] else inside
    return f"({text})?" if node["o"] else text


def match(wrapper: Node, page: Node) -> Iterator[tuple[Node, Node]]:
    """Each element of the page with the wrapper's element that stands for it."""
    todo = [(wrapper, page)]
    while todo:
        wrapper, page = pair = todo.pop()
        yield pair
        same = not wrapper["m"] and [r[0] for r in wrapper["r"]] == [r[0] for r in page["r"]]
        by_key = {r[0]: r for r in wrapper["r"]}
        for i, (key, _, nodes) in enumerate(page["r"]):
            run = wrapper["r"][i] if same else by_key.get(key) or by_key.get(_general(key))
            if run is not None:
                todo += [(run[2][j] if not run[1] and j < len(run[2]) else run[2][0], node) for j, node in enumerate(nodes)]


def _evidence(wrapper: Node, pages: int) -> dict[int, tuple[bool, int]]:
    """By id() of an element: whether it has an article or main inside, and its
    characters of text in slots that vary and are mostly no links."""
    out: dict[int, tuple[bool, int]] = {}
    for node, *_ in reversed([*_walk(wrapper)]):   # inner ones first
        s, kids = node["s"], [n for _, _, nodes in node["r"] for n in nodes]
        story = s[1] if s[0] and 2 * s[2] <= s[1] and (s[4] or pages == 1) else 0
        out[id(node)] = (any(out[id(n)][0] or n["k"].split(" ")[0] in ("article", "main") for n in kids), story + sum(out[id(n)][1] for n in kids))
    return out


def _boiler(node: Node, inside: bool, has_article: bool, most: bool, all_: bool) -> bool:
    """Whether an element (inside: of an article) is no article text; most: it has
    most of the wrapper's varying text, all_: over nine tenths of what varies over several pages."""
    name, *words = node["k"].split(" ")
    if name in ("html", "body", "main") or name == "article" and not inside:
        return False
    if name in BOILER_TAGS or name == "header" and not inside:
        # the element alone says nothing where it holds the story: a form may be around the whole page
        return not (all_ or name == "form" and (has_article or most))
    if inside:
        return "!" in words
    said = BOILER_WORDS.intersection(words)
    if said & BESIDE_WORDS:
        return True
    # a layout element may be called by what it has beside the article ("content-with-sidebar"): it holds an article, or most of the varying text
    return bool(said) and not has_article and not most


Slots = tuple[set[int], set[int], set[int]]


def main_slots(wrapper: Node, pages: int) -> Slots:
    """id() of the wrapper's elements whose text is article text; of those that are
    for pages that have none of them; and, if the articles hold less than stands
    beside them, of those that take their place on pages where they hold more."""
    slots: list[tuple[Node, str, int]] = []   # element, innermost kind of container, link share in percent

    evidence = _evidence(wrapper, pages)
    story = evidence[id(wrapper)][1]
    todo = [(wrapper, "")]
    while todo:
        node, inside = todo.pop()
        has_article, own = evidence[id(node)]
        if _boiler(node, bool(inside), has_article, 2 * own > story, pages > 1 and 10 * own > 9 * story):
            continue
        name = node["k"].split(" ")[0]
        inside = "article" if name == "article" else inside or name * (name == "main")
        if node["s"][0]:
            slots.append((node, inside, 100 * node["s"][2] // max(node["s"][1], 1)))
        todo += [(n, inside) for _, _, nodes in node["r"] for n in nodes]

    plain = [n for n, _, share in slots if share <= 50]
    varied = {id(n) for n in plain if n["s"][4] or pages == 1} or {id(n) for n in plain}
    by_kind = {kind: {id(n) for n, inside, _ in slots if inside == kind} for kind in ("article", "main")}
    if not by_kind["article"]:
        return by_kind["main"] or varied, varied if by_kind["main"] else set(), set()
    articles = [n for n in plain if id(n) in by_kind["article"]]
    with_one = max((n["s"][0] for n in articles), default=pages)   # pages with an article, by its commonest slot
    beside = varied - by_kind["article"]
    held, around = sum(n["s"][1] for n in articles), sum(n["s"][1] for n in plain if id(n) in beside)
    if held * pages >= around * min(with_one, pages):   # by page
        return by_kind["article"], varied, set()
    return by_kind["article"], varied, by_kind["main"] if beside & by_kind["main"] else beside


def main_blocks(tree: Node, slots: Slots, page: str) -> list[str]:
    """The page's blocks of article text, read along its host's wrapper and that one's slots."""
    own, blocks = page_tree(page_blocks(page))
    pairs = list(match(tree, own))
    first, other, beside = ({id(p) for w, p in pairs if id(w) in ids} for ids in slots)
    plain = lambda ids: sum(p["s"][1] for _, p in pairs if id(p) in ids and 2 * p["s"][2] <= p["s"][1])
    chosen = beside if beside and plain(beside) > plain(first) else first
    if not any(p["s"][0] for _, p in pairs if id(p) in chosen):
        chosen = other
    return [t for node, t in blocks if id(node) in chosen]


def _merge_all(rows: Iterable[tuple[str, int, str]]) -> Iterator[tuple[str, int, Node]]:
    """Sorted (host, pages, wrapper): the wrappers of a host merged, one host at a time."""
    host, pages, tree = None, 0, None
    for h, n, w in rows:
        w = read_tree(w)
        if h == host:
            pages, tree = pages + n, merge(tree, w)
            continue
        if host is not None:
            yield host, pages, tree
        host, pages, tree = h, n, w
    if host is not None:
        yield host, pages, tree


def _wrapper_rows(found: Iterable[tuple[str, int, Node]]) -> pa.RecordBatch:
    rows = [(h, n, write_tree(t)) for h, n, t in found]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                       pa.array([r[2] for r in rows], pa.string())], names=["host", "pages", "wrapper"])


_SCHEMA = "host string, pages bigint, wrapper string"
TASK_HOSTS = 2000   # partial wrappers that a task holds before it passes them on


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """pages: host, html. One wrapper per host, from all its pages."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in slices(batches):
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                tree, texts = page_tree(page_blocks(page or ""))
                if texts:
                    old = held.get(host)
                    held[host] = [1, tree] if old is None else [old[0] + 1, merge(old[1], tree)]
            if len(held) > TASK_HOSTS:
                yield _wrapper_rows((h, n, t) for h, (n, t) in held.items())
                held = {}
        yield _wrapper_rows((h, n, t) for h, (n, t) in held.items())

    def more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("host", "pages", "wrapper"))))
        for found in _merge_all(rows):
            yield _wrapper_rows([found])

    n = partitions(pages.sparkSession)
    partial = pages.select("host", "html").mapInArrow(first, _SCHEMA).withColumn("_salt", F.pmod(F.xxhash64("wrapper"), F.lit(n)))
    partial = partial.repartition(n, "host", "_salt").sortWithinPartitions("host", "wrapper").select("host", "pages", "wrapper").mapInArrow(more, _SCHEMA)
    return partial.repartition(n, "host").sortWithinPartitions("host", "wrapper").mapInArrow(more, _SCHEMA)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row of pages.

    The host is the url's (none: empty, one group like any host). A null or empty
    page, or one without article text, has an empty text. Repeated pages come out
    repeated; no rows give none; other columns of pages play no part."""
    rows = pages.select("page_id", "url", "html", url_host("url").alias("host"))
    # Written, so that the join below knows its size: Spark broadcasts it only if that is small.
    wrappers = stage(infer_wrappers(rows), "wrappers").select("host", "pages", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[Node, Slots]] = {}
        for batch in slices(batches):
            texts = []
            for host, n, wrapper, page in zip(*(batch.column(c).to_pylist() for c in ("host", "pages", "wrapper", "html"))):
                if wrapper is None:
                    texts.append("")
                    continue
                if host not in known:
                    if len(known) >= TASK_HOSTS:
                        known.clear()
                    tree = read_tree(wrapper)
                    known[host] = (tree, main_slots(tree, n))
                tree, slots = known[host]
                texts.append("\n".join(main_blocks(tree, slots, page or "")))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    out = rows.join(wrappers, "host", "left").select("page_id", "url", "host", "pages", "wrapper", "html") \
        .mapInArrow(run, f"page_id {kind}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
