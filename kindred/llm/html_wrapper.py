"""HTML extraction with wrappers inferred per host and layout.

A page is a tree of structural tags and texts.  All pages of one layout of a host
(the set of containers that hold text) are generalised to one wrapper, a
union-free regular expression: neighbouring equal blocks fold into a repeated
group, differing texts become slots and tags that only one side has become
optional groups.  The smallest container that holds all slots of a layout outside
boilerplate is its main container, and every page gives the text of the container
of its layout, less the boilerplate inside.
"""

from __future__ import annotations

import difflib
import functools
import hashlib
import html as entities
import itertools
import pickle
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import broadcast_if_small, materialise
from kindred.llm.url_filter import host_and_path

#: Differing pages that must agree at a path before its text counts as constant.
DIFFERENT = 3
#: Neighbouring nodes that may repeat together.
PERIOD = 4
#: Neighbouring nodes of a wrapper beyond which they go in any order; bounds a wrapper, no text is lost by it.
SIBLINGS = 200
#: Nested elements of a wrapper, the rest of a path below them counts as one; bounds recursion.
DEEP = 60
#: Letters of a text that a wrapper shows; longer texts are told apart by their hash.
SHOWN = 40
#: Buckets in which the shapes of a layout are aligned first.
BUCKETS = 256
#: Shapes that a task holds before it writes them.
HELD = 1000
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_ATTR = re.compile(r"([a-zA-Z_:-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_RAW = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
                    "strike strong sub sup time tt u var wbr img".split())
_BOILER_TAGS = frozenset("head title nav header footer aside form script style noscript template iframe svg button select "
                         "option textarea input label menu dialog object canvas audio video map fieldset".split())
#: Words in a class, id or role that mark menus, adverts, notices, comments and the like.
_BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "sidebar aside widget widgets related recommended recommendations trending share sharing social breadcrumb breadcrumbs "
    "menu nav navbar navigation footer header masthead toolbar topbar comment comments commentlist disqus reply replies "
    "respond responses discussion login search searchbox searchform pagination pager copyright legal disclaimer skip "
    "hidden contentinfo complementary tracking paywall".split())
_KEPT = frozenset(("html", "body", "main"))
#: Elements of running text, which are no containers of their own.
_CONTENT = frozenset("p ul ol li dl dt dd table caption thead tbody tfoot tr td th h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption "
                     "address details summary".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CLOSES = {"p": frozenset("p address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav "
                          "ol pre section table ul".split()), "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")),
           "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")),
           "th": frozenset(("td", "th", "tr")), "option": frozenset(("option",))}


def attributes(text: str) -> dict[str, str]:
    return {m.group(1).lower(): (m.group(2) or "").strip("\"'") for m in _ATTR.finditer(text)} if text.strip(" /") else {}


def is_boilerplate(name: str, attrs: dict[str, str]) -> bool:
    if name in _BOILER_TAGS:
        return True
    if name in _KEPT or not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    words = {w.lower() for key in ("class", "id", "role") for w in _WORD.findall(attrs.get(key, ""))}
    return bool(words & _BOILER_WORDS)


def label(name: str, attrs: dict[str, str]) -> str:
    """Tag with its classes: what makes two structural tags equal."""
    own = ".".join(sorted(attrs.get("class", "").split())) or attrs.get("id", "")
    return f"{name}.{own}" if own else name


def parse(page: str):
    """Yield ("open", label, boilerplate), ("close", name), ("text", raw) and
    ("break",) events; inline tags give no event, implied end tags are added."""
    at, stack = 0, []
    size = len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            yield ("text", page[at:])
            break
        if m.start() > at:
            yield ("text", page[at:m.start()])
        at = max(m.end(), m.start() + 1)
        if m.group(2) is None:
            continue
        name = m.group(2).lower()
        if m.group(1):
            if name in stack:
                while stack:
                    top = stack.pop()
                    yield ("close", top)
                    if top == name:
                        break
            elif name == "p" or name == "br":
                yield ("break",)
            continue
        if name in _RAW:
            end = _RAW[name].search(page, at)
            at = end.end() if end else size
            yield ("break",)
            continue
        if name in _INLINE and not (m.group(3) and is_boilerplate(name, attributes(m.group(3)))):
            continue
        if name in _VOID:
            yield ("break",)
            continue
        while stack and name in _CLOSES.get(stack[-1], ()):
            yield ("close", stack.pop())
        attrs = attributes(m.group(3) or "")
        if not (m.group(3) or "").rstrip().endswith("/") or name not in _INLINE:
            stack.append(name)
            yield ("open", label(name, attrs), is_boilerplate(name, attrs))
    while stack:
        yield ("close", stack.pop())


def texts(events):
    """(path of labels, inside boilerplate, block text) of every block of a parsed page, in order."""
    path, boiler, parts = [], [], []

    def block():
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        return [(tuple(path), any(boiler), text)] if text else []

    for event in events:
        if event[0] == "text":
            parts.append(event[1])
            continue
        yield from block()
        if event[0] == "open":
            path.append(event[1])
            boiler.append(event[2])
        elif event[0] == "close" and path:
            path.pop()
            boiler.pop()
    yield from block()


# --- wrapper inference -------------------------------------------------------
# A wrapper is a list of nodes, a node a tuple (label, boilerplate, nodes, value, varied, seen, times).
# The label is that of an element, TEXT, GROUP (neighbours that repeat together) or MIXED (neighbours
# in any order).  A text has a value (what one page says there, None once pages differ), whether
# more than one text was met, and one bit of the hash of each page that has it.  ``times`` is
# "" for once, "?" for optional, "+" for repeated and "*" for both.
TEXT, GROUP, MIXED = "#", "(", "(?"


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def tree(events, bit: int = 0) -> list:
    """Elements of a parsed page that hold text and their texts, unfolded.  What is
    open below DEEP elements goes by the rest of its path, as one element."""
    root: list = []
    open_: list[tuple[str, bool, list]] = [("", False, root)]
    parts: list[str] = []

    def block():
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            value = text if len(text) <= SHOWN else f"{text[:SHOWN]} {_hash(text)}"
            node = (TEXT, False, [], value, False, 1 << bit, "")
            if rest := open_[DEEP + 1:]:
                node = ("/".join(n for n, _, _ in rest), any(b for _, b, _ in rest), [node], None, False, 0, "")
            open_[min(DEEP, len(open_) - 1)][2].append(node)

    def close():
        name, boiler, nodes = open_.pop()
        if nodes:
            open_[-1][2].append((name, boiler, nodes, None, False, 0, ""))

    for event in events:
        if event[0] == "text":
            parts.append(event[1])
            continue
        block()
        if event[0] == "open":
            open_.append((event[1].replace("/", "|"), event[2], []))
        elif event[0] == "close" and len(open_) > 1:
            close()
    block()
    while len(open_) > 1:
        close()
    return root


def key(node):
    """What alignment compares: the element, whatever it holds; texts are equal whatever they say."""
    return (GROUP, *map(key, node[2])) if node[0] == GROUP else node[0]


def _times(a: str, b: str) -> str:
    optional, repeated = a in ("?", "*") or b in ("?", "*"), a in ("+", "*") or b in ("+", "*")
    return "*" if optional and repeated else "?" if optional else "+" if repeated else ""


def joined(x: str | None, y: str | None) -> str | None:
    """Value of a text that one page says twice."""
    return None if x is None or y is None else str(_hash(f"{x}\n{y}"))


def same(x: str | None, y: str | None) -> str | None:
    """Value of a text of two pages."""
    return x if x == y else None


def unify(x: tuple, y: tuple, value) -> tuple:
    """The node that fits both of two nodes of one key."""
    return (x[0], x[1] or y[1], align(x[2], y[2], value), value(x[3], y[3]) if x[0] == TEXT else None,
            x[4] or y[4] or x[3] != y[3], x[5] | y[5], _times(x[6], y[6]))


def fold(nodes: list) -> list:
    """Fold neighbours that repeat, alone or up to PERIOD together, into repeated
    groups, inside out."""
    nodes = [(*n[:2], fold(n[2]), *n[3:]) if n[2] else n for n in nodes]
    for k in range(1, PERIOD + 1):
        if len(nodes) <= k:
            break
        out: list = []
        keys: list = []
        for n in nodes:
            out.append(n)
            keys.append(key(n))
            if k == 1:
                if len(out) > 1 and keys[-1] == keys[-2]:
                    one = unify(out[-2], out[-1], joined)
                    out[-2:], keys[-2:] = [(*one[:6], _times(one[6], "+"))], keys[-1:]
            elif len(out) > k and keys[-k - 1] == (GROUP, *keys[-k:]):
                group = out[-k - 1]
                out[-k - 1:], keys[-k - 1:] = [(*group[:2], align(group[2], out[-k:], joined), *group[3:])], keys[-k - 1:-k]
            elif len(out) >= 2 * k and keys[-2 * k:-k] == keys[-k:]:
                one = align(out[-2 * k:-k], out[-k:], joined)
                out[-2 * k:], keys[-2 * k:] = [(GROUP, False, one, None, False, 0, "+")], [(GROUP, *keys[-k:])]
        nodes = out
    return mixed(nodes, joined) if len(nodes) > SIBLINGS else nodes


def mixed(nodes: list, value) -> list:
    """Many different neighbours as one repeated group of optional nodes, one for each
    key; if there are too many keys, elements of running text go by their tag."""
    flat = []
    for n in nodes:
        flat += n[2] if n[0] in (GROUP, MIXED) else [n]
    if len({key(n) for n in flat}) > SIBLINGS:
        flat = [(n[0].split(".")[0] if n[0].split(".")[0] in _CONTENT else n[0], *n[1:]) for n in flat]
    held: dict = {}
    for n in flat:
        k = key(n)
        held[k] = unify(held[k], n, value) if k in held else n
    return [(MIXED, False, [(*held[k][:6], _times(held[k][6], "?")) for k in sorted(held, key=str)], None, False, 0, "+")]


def align(wrapper: list, page: list, value=same) -> list:
    """The nodes that fit both lists: matches are unified, the rest is optional."""
    a, b = [key(n) for n in wrapper], [key(n) for n in page]
    if a == b:
        return [unify(x, y, value) for x, y in zip(wrapper, page)]
    if MIXED in a or MIXED in b:
        return mixed(wrapper + page, value)
    out = []
    for op, i, j, k, m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if op == "equal":
            out += [unify(x, y, value) for x, y in zip(wrapper[i:j], page[k:m])]
        else:
            out += [(*n[:6], _times(n[6], "?")) for n in wrapper[i:j] + page[k:m]]
    return mixed(out, value) if len(out) > SIBLINGS else out


def infer(pages: list[str]) -> list:
    """Wrapper of a few pages."""
    return functools.reduce(align, [page_wrapper(page)[1] for page in pages]) if pages else []


def expression(wrapper: list) -> str:
    """The wrapper as text: #slot for variable text, (...)+, (...)? and (...)*."""
    parts = []
    for name, _, nodes, value, varied, _, times in wrapper:
        if name == TEXT:
            own = "#slot" if varied or value is None else value[:SHOWN]
        else:
            own = expression(nodes) if name in (GROUP, MIXED) else f"<{name}> {expression(nodes)} </{name}>"
        parts.append(f"({own}){times}" if times else own)
    return " ".join(parts)


def shape(wrapper: list) -> str:
    """All of a wrapper but its texts; wrappers of one shape unify in any order."""
    return "".join(f"{n[0]}{n[6]}<{shape(n[2])}>" for n in wrapper)


def leaves(wrapper: list, path: tuple = ()):
    """(path of labels, value, pages seen) of every text outside boilerplate."""
    for n in wrapper:
        if n[0] == TEXT:
            yield path, n[3], n[5]
        elif not n[1]:
            yield from leaves(n[2], path if n[0] in (GROUP, MIXED) else (*path, *n[0].split("/")))


def common_container(paths: list[tuple]) -> tuple:
    """The deepest container that holds all of some paths."""
    lo, hi = min(paths, default=()), max(paths, default=())
    n = next((i for i, (x, y) in enumerate(zip(lo, hi)) if x != y), min(len(lo), len(hi)))
    while n and lo[n - 1].split(".")[0] in _CONTENT:
        n -= 1
    return lo[:n]


def main_container(wrapper: list) -> str:
    """Path (joined by /) of the deepest container with all variable text of one
    wrapper outside boilerplate."""
    found = [*leaves(wrapper)]
    return "/".join(common_container([p for p, value, _ in found if value is None] or [p for p, _, _ in found]))


def page_blocks(events) -> tuple[int, list[tuple[str, str]]]:
    """Layout of a parsed page and its texts outside boilerplate: (path joined by /, text
    of neighbouring blocks of that path).  The layout is the set of containers
    that hold text, down to the first element of running text."""
    out: list[list] = []
    frames = set()
    for path, boiler, text in texts(events):
        if boiler:
            continue
        path = [x.replace("/", "|") for x in path]
        frames.add("/".join(itertools.takewhile(lambda x: x.split(".")[0] not in _CONTENT, path)))
        key = "/".join(path)
        if out and out[-1][0] == key:
            out[-1][1].append(text)
        else:
            out.append([key, [text]])
    return _hash("\n".join(sorted(frames))), [(k, " ".join(v)) for k, v in out]


def page_wrapper(page: str) -> tuple[int, list]:
    """Layout of a page and the page as a wrapper."""
    events = [*parse(page)]
    layout, blocks = page_blocks(events)
    return layout, fold(tree(events, _hash("\n".join(t for _, t in blocks)) & 63))


def _page_wrappers(batches):
    """(host, layout, bucket, shape, wrapper) of pages; pages of one shape are unified first."""
    def rows():
        out = pd.DataFrame([(h, y, s % BUCKETS, s, pickle.dumps(w)) for (h, y, s), w in held.items()],
                           columns=["host", "layout", "bucket", "shape", "wrapper"])
        held.clear()
        return out.astype({"layout": "int64", "bucket": "int64", "shape": "int64"})

    held: dict[tuple, list] = {}
    for pdf in batches:
        for host, page in zip(pdf["host"], pdf["html"]):
            layout, own = page_wrapper(page)
            at = (host, layout, _hash(shape(own)))
            held[at] = align(held[at], own) if at in held else own
            if len(held) >= HELD:
                yield rows()
    yield rows()


def _unified(pdf: pd.DataFrame) -> list:
    """One wrapper for all of a group: equal shapes first, then in the order of the
    shapes, so that the result is the same however pages were dealt to tasks."""
    by_shape: dict[int, list] = {}
    for s, w in zip(pdf["shape"], map(pickle.loads, pdf["wrapper"])):
        by_shape[s] = align(by_shape[s], w) if s in by_shape else w
    return functools.reduce(align, (by_shape[s] for s in sorted(by_shape)))


def _align_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    own = _unified(pdf)
    return pdf.iloc[:1][["host", "layout"]].assign(shape=_hash(shape(own)), wrapper=[pickle.dumps(own)])


def _layout_paths(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per path of a layout's wrapper: hash of its values, null if one is a slot, and pages seen."""
    own: dict[str, list] = {}
    for path, value, seen in leaves(_unified(pdf)):
        held = own.setdefault("/".join(path), [[], 0])
        held[0].append(value)
        held[1] |= seen
    rows = [(k, None if None in v else str(_hash("\n".join(v))), n - (1 << 64) if n >> 63 else n) for k, (v, n) in own.items()]
    out = pd.DataFrame(rows, columns=["path", "value", "seen"]).astype({"path": object, "value": object, "seen": "int64"})
    return out.assign(host=pdf["host"].iloc[0], layout=pdf["layout"].iloc[0])[["host", "layout", "path", "value", "seen"]]


def _layout_container(pdf: pd.DataFrame) -> pd.DataFrame:
    slots = pdf.loc[~pdf["constant"], "path"]
    paths = [tuple(p.split("/")) if p else () for p in (slots if len(slots) else pdf["path"])]
    return pdf.iloc[:1][["host", "layout"]].assign(container="/".join(common_container(paths)))


def layout_paths(pages: DataFrame) -> DataFrame:
    """(host, layout, path, value, seen) of the wrapper of every layout of every host.

    Tasks unify the pages of one shape as they read them; the shapes of a layout are
    aligned in buckets by their hash, then the buckets' wrappers with each other."""
    host, _ = host_and_path(F.col("url"))
    own = pages.filter("html is not null").select(host.alias("host"), "html").mapInPandas(
        _page_wrappers, "host string, layout long, bucket long, shape long, wrapper binary")
    parts = own.groupBy("host", "layout", "bucket").applyInPandas(_align_bucket, "host string, layout long, shape long, wrapper binary")
    return parts.groupBy("host", "layout").applyInPandas(_layout_paths, "host string, layout long, path string, value string, seen long")


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, layout, container) over all pages of every host.

    A path is constant where the wrappers of all layouts of the host that have it say
    the same there, and at least DIFFERENT of the pages differ elsewhere; all other
    paths are slots.  The container of a layout is the longest common prefix of its
    slots (of all its paths, if it has no slot), so no slot lies outside."""
    paths = materialise(layout_paths(pages), "paths")
    fixed = materialise(paths.groupBy("host", "path").agg(
        F.count("value").alias("said"), F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.bit_or("seen").alias("seen"))
        .filter((F.col("said") == F.col("n")) & (F.col("lo") == F.col("hi")) & (F.bit_count("seen") >= DIFFERENT))
        .select(F.col("host").alias("_h"), F.col("path").alias("_p")), "fixed")
    here = F.col("host").eqNullSafe(F.col("_h")) & (F.col("path") == F.col("_p"))
    known = paths.join(broadcast_if_small(fixed, fixed.count()), here, "left").select(
        "host", "layout", "path", F.col("_p").isNotNull().alias("constant"))
    return materialise(known.groupBy("host", "layout").applyInPandas(
        _layout_container, "host string, layout long, container string"), "wrappers")


def extract_pages(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` -> one row each: page_id, url, text, n_chars,
    container.

    A null or empty html gives an empty text; a page with no text inside its
    layout's container gives all that is no boilerplate; pages without a host
    count as one host; repeated rows give the same text; malformed markup is read as
    browsers do where that is simple (implied end tags, stray ``<`` as text); an
    empty table gives no rows; other columns are not read."""

    @F.pandas_udf("layout long, blocks array<struct<path:string,text:string>>")
    def split_page(html: pd.Series) -> pd.DataFrame:
        found = [page_blocks(parse(h or "")) for h in html]
        return pd.DataFrame({"layout": [x for x, _ in found], "blocks": [[{"path": k, "text": t} for k, t in b] for _, b in found]})

    found = wrappers(pages).withColumnsRenamed({"host": "_h", "layout": "_l"})
    side = broadcast_if_small(found, found.count())
    host, _ = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), split_page("html").alias("p")).select("page_id", "url", "host", "p.*")
    rows = rows.join(side, F.col("host").eqNullSafe(F.col("_h")) & (F.col("layout") == F.col("_l")), "left")
    under = F.concat("container", F.lit("/"))
    inside = F.filter("blocks", lambda b: (F.col("container") == "") | F.startswith(F.concat(b["path"], F.lit("/")), under))
    kept = F.when(F.size(inside) > 0, inside).otherwise(F.col("blocks"))
    out = rows.select("page_id", "url", F.array_join(F.transform(kept, lambda b: b["text"]), " ").alias("text"), "container")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "container")
