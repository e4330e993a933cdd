"""Main text of HTML pages through wrappers inferred per host.

A page is a stream of block tags and text slots.  The streams of all pages of a
host are folded (a run of equal units becomes a repeated group), made distinct
and aligned one after the other; what only some pages have becomes an optional
group.  The result is a union-free regular expression, the wrapper.  All pages
are then read through it, and what each of its slots held decides, with the
elements around it, which slots are main text: text that stays the same from
page to page belongs to the template, text made of links to a menu.  Names of
classes only settle what this leaves open.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import stage

#: Longest unit of a repeated group; cells of an alignment done in full (longer
#: stretches are first cut at what occurs once in both).
UNIT, TABLE = 12, 250_000
#: Parts in which a host's streams are aligned before their wrappers are.
SALTS = 8
#: Share of pages with the same text from which a slot is fixed, pages that it
#: takes to say so, characters of a slot that make prose.
FIXED, PAGES, PROSE = 0.9, 3, 40

# HTML element names by their role.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
OPTIONAL_END = frozenset("p li dt dd tr td th thead tbody tfoot option".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "select", "title")
BOILERPLATE = frozenset("head nav header footer aside form button menu dialog fieldset object video audio canvas".split())
MAIN = frozenset("article main".split())
PAGE = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class, id and role that name what isn't main text; those of
# the second list also occur in names of main text, and don't count against prose.
NOISE = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored nav navbar navigation "
                  "menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr privacy subscribe "
                  "subscription newsletter signup paywall popup modal overlay comment comments disqus reply replies respond "
                  "social recommended recommendations pagination pager widget toolbar login disclaimer".split())
DOUBTFUL = frozenset("header banner promo promotion notice share sharing related search alert".split())

_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
                    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*\Z|[^<]+|<", re.S | re.I)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def tokens(html: str) -> tuple[list[str], list[str], list[int]]:
    """(keys, texts, linked): block tags as ``<name words>`` or ``</name>``
    with empty text, and stretches of text as ``T`` with the number of their
    characters inside links.  Inline tags vanish, ``br`` is a space; scripts,
    styles, comments and the like are gone; end tags that HTML lets an author
    omit are left out, so that pages with and without them look alike."""
    keys: list[str] = []
    texts: list[str] = []
    linked: list[int] = []
    open_text: list[str] = []
    in_link, of_links = False, 0

    def flush() -> None:
        nonlocal of_links
        if open_text:
            text = " ".join("".join(open_text).split())
            open_text.clear()
            if text:
                keys.append("T")
                texts.append(text)
                linked.append(min(of_links, len(text)))
        of_links = 0

    for m in _PIECE.finditer(html):
        name = m[3]
        if name is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                open_text.append(unescape(piece))
                of_links += in_link and len(" ".join(open_text[-1].split()))
            continue
        name = name.lower()
        if name in INLINE:
            if name == "br":
                open_text.append(" ")
            elif name == "a":
                in_link = not m[2]
            continue
        if m[2]:
            if name in OPTIONAL_END or name in VOID:
                flush()
                continue
            key = f"</{name}>"
        else:
            words = sorted({w.lower() for a in _NAMED.finditer(m[4]) for w in _WORD.findall(a[2] or a[3] or a[4] or "")}) if m[4] else []
            if m[4] and _HIDDEN.search(m[4]):
                words.insert(0, "-hidden")
            key = "<" + " ".join([name, *words]) + ">"
        flush()
        keys.append(key)
        texts.append("")
        linked.append(0)
    flush()
    return keys, texts, linked


# A wrapper is a list of nodes: a key, or ["+", nodes], or ["?", nodes].

def _even(unit: list) -> bool:
    """Whether a unit closes just the elements that it opens."""
    depth = 0
    for key in _flat(unit):
        if key[:2] == "</":
            depth -= 1
            if depth < 0:
                return False
        elif key[:1] == "<" and key[1:-1].split(" ")[0] not in VOID | OPTIONAL_END:
            depth += 1
    return depth == 0


def fold(nodes: list) -> list:
    """Runs of equal units become repeated groups, shortest units first."""
    for size in range(1, UNIT + 1):
        out, i = [], 0
        while i < len(nodes):
            unit = nodes[i:i + size]
            n = 1
            while len(unit) == size and nodes[i + n * size:i + (n + 1) * size] == unit:
                n += 1
            if n > 1 and not _even(unit):
                out.append(nodes[i])
                i += 1
            elif n > 1 and not (size == 1 and isinstance(unit[0], list)):
                out.append(["+", unit])
                i += n * size
            elif n > 1:
                out.append(unit[0])
                i += n
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def _units(nodes: list) -> list[list]:
    """Units of the repeated groups, at any depth."""
    found = []
    for x in nodes:
        if isinstance(x, list):
            found += _units(x[1]) + ([x[1]] if x[0] == "+" else [])
    return found


def _as_groups(nodes: list, units: list[list]) -> list:
    """Single occurrences of units that repeat elsewhere become groups, too."""
    for unit in units:
        out, i = [], 0
        while i < len(nodes):
            if nodes[i] == unit[0] and nodes[i:i + len(unit)] == unit:
                out.append(["+", unit])
                i += len(unit)
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return fold(nodes)


def _bare(node):
    return node[1][0] if isinstance(node, list) and node[0] == "?" and len(node[1]) == 1 else node


def _name(node) -> str:
    """What makes nodes equal, whether they are optional or not."""
    bare = _bare(node)
    return bare if isinstance(bare, str) else json.dumps(bare)


def _common(a: list[str], b: list[str], i: int = 0, j: int = 0) -> list[tuple[int, int]]:
    """Places of a common subsequence, the longest one for short lists; long
    ones are cut at the names that occur once in both, and where there are
    none nothing is common but their beginnings and ends."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    head = [(i + k, j + k) for k in range(start)]
    tail = [(i + len(a) - k, j + len(b) - k) for k in range(end, 0, -1)]
    a, b, i, j = a[start:len(a) - end], b[start:len(b) - end], i + start, j + start
    n, m = len(a), len(b)
    middle: list[tuple[int, int]] = []
    if n * m <= TABLE:
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for x in range(n - 1, -1, -1):
            row, below = best[x], best[x + 1]
            for y in range(m - 1, -1, -1):
                row[y] = 1 + below[y + 1] if a[x] == b[y] else max(below[y], row[y + 1])
        x = y = 0
        while x < n and y < m:
            if a[x] == b[y]:
                middle.append((i + x, j + y))
                x, y = x + 1, y + 1
            elif best[x + 1][y] >= best[x][y + 1]:
                x += 1
            else:
                y += 1
    elif anchors := _anchors(a, b):
        x = y = 0
        for u, v in [*anchors, (n, m)]:
            middle += _common(a[x:u], b[y:v], i + x, j + y)
            if u < n:
                middle.append((i + u, j + v))
            x, y = u + 1, v + 1
    return head + middle + tail


def _anchors(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of names that occur once in both, as many as keep their order."""
    once = [{x: k for k, x in enumerate(side)} for side in (a, b)]
    twice = [{x for k, x in enumerate(side) if at[x] != k} for side, at in zip((a, b), once)]
    both = [(k, once[1][x]) for k, x in enumerate(a) if x in once[1] and x not in twice[0] and x not in twice[1]]
    tops: list[int] = []      # longest rising run by patience: smallest end of each length, and links back
    piles: list[int] = []
    back = []
    for k, (_, v) in enumerate(both):
        at = bisect_left(tops, v)
        back.append(piles[at - 1] if at else -1)
        tops[at:at + 1] = [v]
        piles[at:at + 1] = [k]
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(both[k])
        k = back[k]
    return out[::-1]


def align(a: list, b: list) -> list:
    """The wrapper of what ``a`` or ``b`` matches: a common subsequence, with
    the stretches in between as optional groups."""
    a, b = _as_groups(a, _units(b)), _as_groups(b, _units(a))
    if a == b:
        return a
    out, i, j = [], 0, 0
    for u, v in [*_common(list(map(_name, a)), list(map(_name, b))), (len(a), len(b))]:
        out += [x if isinstance(x, list) and x[0] == "?" else ["?", [x]] for x in (*a[i:u], *b[j:v])]
        if u < len(a):
            out.append(a[u] if a[u] != _bare(a[u]) else b[v])
        i, j = u + 1, v + 1
    return out


def match(nodes: list, keys: list[str], at: int, slots: list[int], counter: list[int], taken: list[tuple[int, int]]) -> int:
    """Match greedily from ``at``; where the match ends, or -1.  ``taken`` gets
    (token, slot) for each text; slots count the wrapper's texts in order."""
    for node in nodes:
        if isinstance(node, str):
            if at >= len(keys) or keys[at] != node:
                return -1
            if node == "T":
                taken.append((at, counter[0]))
                counter[0] += 1
            at += 1
            continue
        first, width, rounds = counter[0], _slots(node[1]), 0
        while True:
            held, counter[0] = len(taken), first
            end = match(node[1], keys, at, slots, counter, taken)
            if end < 0 or end == at:
                del taken[held:]
                break
            at, rounds = end, rounds + 1
            if node[0] == "?":
                break
        counter[0] = first + width
        if not rounds and node[0] == "+":
            return -1
    return at


def _slots(nodes: list) -> int:
    return sum(x == "T" if isinstance(x, str) else _slots(x[1]) for x in nodes)


def _whole(nodes: list, keys: list[str]) -> list[tuple[int, int]] | None:
    taken: list[tuple[int, int]] = []
    return taken if match(nodes, keys, 0, [], [0], taken) == len(keys) else None


def _flat(nodes: list) -> Iterator[str]:
    for x in nodes:
        if isinstance(x, str):
            yield x
        else:
            yield from _flat(x[1])


def unfold(nodes: list) -> list[str]:
    """Keys that a wrapper of the folded stream ``nodes`` must match: each of
    its repeated groups twice."""
    out: list[str] = []
    for x in nodes:
        if isinstance(x, str):
            out.append(x)
        else:
            out += unfold(x[1]) * (2 if x[0] == "+" else 1)
    return out


def extend(wrapper: list | None, stream: list) -> list:
    """The wrapper that also covers a folded stream (or another wrapper)."""
    if wrapper is None:
        return stream
    return wrapper if _whole(wrapper, unfold(stream)) is not None else align(wrapper, stream)


def place(wrapper: list, keys: list[str]) -> tuple[list[tuple[int, int | None]], list, bool]:
    """((token, slot) of each text, the page's own wrapper, whether the wrapper
    matched).  The slots of a page that the wrapper doesn't match are found by
    aligning the two; a text that has no place in the wrapper has none (None)."""
    taken = _whole(wrapper, keys)
    if taken is not None:
        return taken, [], True
    for own in (_as_groups(fold(list(keys)), _units(wrapper)), fold(list(keys)), list(keys)):
        mine = _whole(own, keys)
        if mine is not None:
            break
    slot_of: dict[int, int] = {}
    firsts = []
    for nodes in (wrapper, own):
        at, first = 0, []
        for x in nodes:
            first.append(at)
            at += _slots([x])
        firsts.append(first)
    for u, v in _common(list(map(_name, wrapper)), list(map(_name, own))):
        for k in range(_slots([own[v]])):
            slot_of[firsts[1][v] + k] = firsts[0][u] + k
    return [(at, slot_of.get(slot)) for at, slot in mine], own, False


#: What a slot held: pages (unlike ones), pages with its commonest text, characters, characters in links.
Seen = tuple[int, int, int, int]


def judge(nodes: list, seen: dict[int, Seen]) -> list[bool]:
    """Which slots are main text.

    Main text lies in an article or main element, if the wrapper has one, and
    never in the elements made for something else (a heading in an article's
    header stays) or in hidden ones.  Without such an element, a slot that
    held the same text on nearly all of several unlike pages, or mostly
    links, is part of the template.  Names of classes, ids and roles decide
    the rest, but not those of ``html``, ``body``, ``main`` and ``article``
    themselves; names that are used for main text, too, don't count against
    prose inside an article, or against prose that changes from page to page.
    """
    has_main = any(k[:1] == "<" and k[1:-1].split(" ")[0] in MAIN for k in _flat(nodes))
    out: list[bool] = []
    stack: list[tuple[str, bool, bool, bool]] = []        # name, in main, in boilerplate, in something doubtful
    heading = False
    for key in _flat(nodes):
        if key == "T":
            _, main, noise, doubt = stack[-1] if stack else ("", False, False, False)
            if noise and heading:
                noise = stack[-1][0] != "header" or any(x[0] in BOILERPLATE - {"header"} for x in stack)
            pages, top, chars, links = seen.get(len(out), (0, 0, 0, 0))
            prose = chars >= PROSE * max(pages, 1) and 2 * links < chars
            fixed = pages >= PAGES and top >= FIXED * pages
            if doubt and not heading:
                noise |= not (prose and (main or pages >= PAGES and not fixed))
            if not has_main:
                noise |= fixed or chars > 0 and 5 * links > 4 * chars and not heading
            out.append((main or not has_main) and not noise)
            continue
        if key[1] == "/":
            name = key[2:-1]
            heading &= name not in HEADINGS
            places = [i for i, x in enumerate(stack) if x[0] == name]
            if places:
                del stack[places[-1]:]
            continue
        name, *words = key[1:-1].split(" ")
        heading = name in HEADINGS
        held = frozenset() if name in PAGE else frozenset(words)
        bad, doubtful = bool(NOISE & held) or "-hidden" in words and name not in ("html", "body"), bool(DOUBTFUL & held)
        _, main, noise, doubt = stack[-1] if stack else ("", False, False, False)
        if name in VOID or name in OPTIONAL_END or name in HEADINGS:
            if bad or doubtful:
                stack.append((name, main, noise or bad, doubt or doubtful))
            continue
        stack.append((name, main or name in MAIN, noise or bad or name in BOILERPLATE, doubt or doubtful))
    return out


def main_text(html: str, wrapper: list, keep: list[bool]) -> tuple[str, bool]:
    """(main text, whether the wrapper matched).  Texts that have no place in
    the wrapper are judged by the page alone."""
    keys, texts, linked = tokens(html)
    taken, own, matched = place(wrapper, keys)
    if matched:
        return "\n\n".join(texts[at] for at, slot in taken if keep[slot]), True
    mine = _whole(own, keys)
    seen: dict[int, list[int]] = {}
    for at, slot in mine:
        held = seen.setdefault(slot, [1, 1, 0, 0])
        held[2] += len(texts[at])
        held[3] += linked[at]
    alone = judge(own, {k: tuple(v) for k, v in seen.items()})
    return "\n\n".join(texts[at] for (at, slot), (_, part) in zip(taken, mine) if (keep[slot] if slot is not None else alone[part])), False


def infer(pages: list[str]) -> tuple[list, list[bool]]:
    """Wrapper of some pages, and which of its slots are main text."""
    wrapper: list | None = None
    for html in dict.fromkeys(pages):
        wrapper = extend(wrapper, fold(tokens(html)[0]))
    counts: dict[int, dict[str, int]] = {}
    sums: dict[int, list[int]] = {}
    for html in dict.fromkeys(pages):
        for slot, text, chars, links in slot_texts(html, wrapper or []):
            own = counts.setdefault(slot, {})
            own[text] = own.get(text, 0) + 1
            held = sums.setdefault(slot, [0, 0])
            held[0] += chars
            held[1] += links
    return wrapper or [], judge(wrapper or [], {k: (sum(c.values()), max(c.values()), *sums[k]) for k, c in counts.items()})


def slot_texts(html: str, wrapper: list) -> list[tuple[int, str, int, int]]:
    """(slot, its text on the page, characters, of them in links)."""
    keys, texts, linked = tokens(html)
    held: dict[int, list] = {}
    for at, slot in place(wrapper, keys)[0]:
        if slot is not None:
            own = held.setdefault(slot, [[], 0, 0])
            own[0].append(texts[at])
            own[1] += len(texts[at])
            own[2] += linked[at]
    return [(slot, "\n".join(t), c, k) for slot, (t, c, k) in held.items()]


def hosts(pages: DataFrame, url_col: str = "url"):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, wrapper): the wrapper of the streams of each group, from rows
    (keys, stream) dealt and sorted so that a task holds one wrapper at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, wrapper = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([v], t) for v, t in zip(now, kinds)), pa.array([json.dumps(wrapper)])], [*keys, "stream"])

        for batch in batches:
            kinds = [batch.schema.field(i).type for i in range(len(keys))]
            for row in zip(*(batch.column(i).to_pylist() for i in range(len(keys) + 1))):
                if now is not None and row[:-1] != now:
                    yield done()
                    wrapper = None
                now, wrapper = row[:-1], extend(wrapper, json.loads(row[-1]))
        if now is not None:
            yield done()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keys, "stream").schema.fields)
    return rows.select(*keys, "stream").repartition(*keys).sortWithinPartitions(*keys, "stream").mapInArrow(run, schema)


def _streams(pages: DataFrame) -> DataFrame:
    """(host, salt, stream): the distinct folded streams of each host; each
    task gives a stream out once as long as it remembers it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple] = set()
        for batch in batches:
            out = []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                stream = json.dumps(fold(tokens(html.as_py())[0]))
                mark = host, xxhash.xxh64_intdigest(stream)
                if mark not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known.add(mark)
                    out.append((host, mark[1] % SALTS, stream))
            h, s, x = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.string()), pa.array(s, pa.int32()), pa.array(x, pa.string())], ["host", "salt", "stream"])

    return pages.select("host", "html").mapInArrow(run, "host string, salt int, stream string").distinct()


def _read(pages: DataFrame, fitted: DataFrame, take, schema: str) -> DataFrame:
    """``take(rows)`` for each batch of pages with the JSON of their wrapper."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, tuple] = {}

        def wrapper_of(text: str | None) -> tuple:
            if text not in known:
                if len(known) > 1000:
                    known.clear()
                known[text] = tuple(json.loads(text)) if text else ([], [])
            return known[text]

        for batch in batches:
            yield take(batch, wrapper_of)

    # Few hosts are broadcast under the session's threshold (the fitted table
    # is written, so its true size is known) and the pages stay where they
    # are; many are joined by a shuffle in which a hot host can be split.
    return pages.join(fitted, "host", "left").mapInArrow(run, schema)


def fit_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper): JSON of each host's wrapper and slot judgements, from
    all its pages.

    The distinct streams of a host are aligned in ``SALTS`` parts, in the order
    of their text, then the parts' wrappers; a task keeps one wrapper.  Every
    page is then read through its host's wrapper, and what the slots held is
    counted over unlike pages (copies count once).
    """
    own = pages.filter(F.col(html_col).isNotNull()).select(hosts(pages, url_col).alias("host"), F.col(html_col).alias("html"))
    parts = stage(_merged(_streams(own), ["host", "salt"]), "wrapper-parts")
    wrappers = stage(_merged(parts, ["host"]).select("host", F.concat(F.lit("["), "stream", F.lit(", []]")).alias("wrapper")), "wrapper-hosts")

    def slots(batch: pa.RecordBatch, wrapper_of) -> pa.RecordBatch:
        rows: dict[tuple, tuple] = {}
        for host, html, text in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            html = html.as_py()
            page = _signed(html)
            for slot, held, chars, links in slot_texts(html, wrapper_of(text.as_py())[0]):
                rows[host, page, slot] = _signed(held), chars, links
        flat = [(*k, *v) for k, v in rows.items()]
        columns = zip(*flat) if flat else [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                          ["host", "page", "slot", "held", "chars", "links"])

    rows = _read(own, wrappers, slots, "host string, page long, slot int, held long, chars long, links long").distinct()
    seen = (rows.groupBy("host", "slot", "held").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
            .groupBy("host", "slot").agg(F.sum("n").alias("pages"), F.max("n").alias("top"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
            .groupBy("host").agg(F.collect_list(F.struct("slot", "pages", "top", "chars", "links")).alias("seen")))  # no longer than the wrapper

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, held in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                wrapper = json.loads(text)[0]
                out.append(json.dumps([wrapper, judge(wrapper, {x["slot"]: (x["pages"], x["top"], x["chars"], x["links"]) for x in held or ()})]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["host", "wrapper"])

    return wrappers.join(seen, "host", "left").select("host", "wrapper", "seen").mapInArrow(decide, "host string, wrapper string")


def _signed(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url, text, n_chars, matched) for every row of ``pages``.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined by an empty line in page order.  A null or empty
    html gives an empty text; a null or odd url counts as the host ''; null
    ids and repeated rows are kept; an empty table gives no rows.  ``matched``:
    the host's wrapper matched the page as it is; otherwise the two were
    aligned.
    """
    fitted = stage(fit_wrappers(pages, url_col, html_col), "wrappers")
    rows = pages.select(hosts(pages, url_col).alias("host"), F.col(id_col), F.col(url_col), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def texts(batch: pa.RecordBatch, wrapper_of) -> pa.RecordBatch:
        got = [main_text(html.as_py(), *wrapper_of(text.as_py())) for html, text in zip(batch.column("html"), batch.column("wrapper"))]
        return pa.RecordBatch.from_arrays(
            [batch.column(1), batch.column(2), pa.array([t for t, _ in got], pa.string()), pa.array([len(t) for t, _ in got], pa.int64()),
             pa.array([m for _, m in got], pa.bool_())], [id_col, url_col, "text", "n_chars", "matched"])

    kind = pages.schema[id_col].dataType.simpleString()
    return _read(rows, fitted, texts, f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars long, matched boolean")
