"""HTML extraction by union-free regular-expression inference (wrappers per host).

Method: a page becomes a stream of block tags and text slots (``#``); neighbouring equal pieces are folded into
repeated groups ``( ... )+``. The different streams of a host are aligned (longest common subsequence, exact at any length): tokens on both sides stay,
a mismatch becomes an optional piece ``?``, and a group that is single on one side stays a group. The result, one union-free
expression per host, is its wrapper; aligning a page with it gives every text of the page its slot.

A text token carries what its page says about it (``CODES``): article or main region, a region that is not article (menus, page
headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles) by its tag, or in doubt, by a class name only. So a
slot never mixes texts that the tags tell apart, and the main text of a page is chosen by slots: article slots are kept and slots
outside are not, whatever they hold, since nothing else is to be dropped. The rest is decided by counts over the host's pages
(``slot_facts``). A slot whose texts repeat (one text on more than half of its places, twice at least) or are mostly links is worn.
A slot is named *strongly* if a class or id is, as a whole, the name of a region that is not article (``share``, ``cookie-notice``); then it goes
unless its texts vary over the pages (``FREE_PAGES`` at least). It is named *weakly* if only a word of a class hints at one (``promo-box``,
``has-sidebar``); then it stays unless it is worn, as does what lies in main beside an article: a page that is alone on its host keeps it. Outside any
region, texts with either name go unless they vary. Where a page has no region at all, text that is the same on half of the
host's pages (three at least) or is mostly links is template, and the container with the most other text is the article.

Streams are collapsed to different ones per host before any shuffle, so a host with a third of all pages costs as many rows as it has
page layouts; they are aligned as a tree, about ``FAN`` at a time in each task, until one wrapper is left. Pages are never shuffled
unless the wrappers are larger than ``BROADCAST_BYTES``; else workers get each wrapper once.

Defined cases: null or empty html: empty text; null url: the host is empty; markup that is never closed or cut off: read
as far as it goes; ``br`` is white space; repeated rows: one result row each; very long pages are read whole, and alignment
takes time, not memory, in the product of two streams; containers with equally much text: the first in the wrapper; a text on
exactly half of its places is no template; empty table: no rows; other columns are ignored.
"""

from __future__ import annotations

import html as htmllib
import json
import re
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, written

FAN = 16                    # streams that one task aligns to one
TABLE_BITS = 1 << 28        # of an alignment kept in memory (32 MB); longer streams are halved, with the same result
BROADCAST_BYTES = 32 << 20
CONSTANT_PAGES = 3          # places before equal text counts as template where a page has no region
FREE_PAGES = 3              # pages whose texts must differ before a strong name is overruled

# fixed values: how markup is read
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = frozenset("script style textarea title xmp iframe noscript noembed noframes template svg select button head annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr br "
    "math semantics mrow mi mn mo ms mtext mspace mstyle mpadded mphantom menclose merror mfrac msqrt mroot msub msup msubsup munder mover "
    "munderover mmultiscripts mprescripts mtable mtr mtd".split())
NAMED = INLINE | frozenset("h1 h2 h3 h4 h5 h6 p li dt dd".split())      # their ids are slugs of their own text
VOID = frozenset("br img input hr meta link base area col embed param source track wbr".split())
OUTSIDE = frozenset("nav footer aside form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
# names of regions that are not article, as whole class names or ids: a core with words around it that say nothing else
_BEFORE = r"(?:(?:reader|user|post|article|page|site|main|top|side|bottom|left|right|in|inline|sticky|mobile|desktop|google|native|cookie|global|local|primary|secondary)[-_]?)*"
_AFTER = (r"(?:[-_]?(?:list|lists|section|area|form|box|thread|threads|wrap|wrapper|container|block|inner|outer|content|posts?|articles?|links?|items?|"
          r"stories|bar|field|button|buttons|icons|widget|unit|slot|banner|space|label|row|top|bottom|left|right|feed|count|panel|region|group|text|message|nav|menu|\d+))*")
ADVERT = re.compile(_BEFORE + r"(?:ads?|advert(?:s|ising|isements?)?|adsense|adbox|adslot|sponsor(?:s|ed)?)" + _AFTER)
# these differ from page to page by their nature; the strong names can be checked against the host
VARYING = re.compile(_BEFORE + r"(?:search|comments?|repl(?:y|ies)|respond|disqus|related|recommended)" + _AFTER)
STRONG = re.compile(_BEFORE + r"(?:nav|navbar|navigation|menu|sidebar|footer|masthead|cookies?|consent|notices?|alerts?|popup|modal|newsletter|subscribe|signup|login|"
                    r"share|sharing|social|breadcrumbs?|pagination|pager|copyright|gdpr|topbar)" + _AFTER)
WEAK = frozenset(
    "ad ads nav navbar navigation menu sidebar footer masthead promo cookie cookies consent notice notices alert popup modal newsletter subscribe "
    "signup login share social breadcrumb breadcrumbs pagination pager widget toolbar skip copyright banner disclaimer gdpr overlay topbar".split())
WEAK_STARTS = ("cookie", "newsletter", "breadcrumb", "sidebar", "navigat", "footer")
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p "
    "pre section table ul".split())


def _kind(name: str, attrs: str, inside: bool) -> tuple[str, str, str]:
    """(mark, region, the words of a weak name) of an element. mark: 'out' for a region that is not article by its tag, role or style, 'words' for
    one by a name that varies by nature, 'strong' and 'weak' for names in doubt, else ''. region: 'article', 'main' or ''."""
    if name in ("html", "body"):
        return "", "", ""
    names, words, role, hidden = set(), set(), "", False
    for key, *values in ATTRIBUTE.findall(attrs) if attrs.strip(" /") else ():
        key, value = key.lower(), "".join(values).lower()
        if key == "class":
            value = re.sub(r"side[-_]bar", "sidebar", value)
            names.update(value.split())
            words.update(re.split(r"[^a-z]+", value))
        elif key == "id" and name not in NAMED:
            names.add(re.sub(r"side[-_]bar", "sidebar", value.strip()))
        elif key == "role":
            role = value
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
            hidden = True
    if name in INLINE:                          # inside a sentence only what is certain
        return ("out" if role in ROLES or hidden else "words" if any(ADVERT.fullmatch(n) for n in names) else ""), "", ""
    region = "article" if name == "article" else "main" if name == "main" or role == "main" else ""
    if name in OUTSIDE or (name == "header" and not inside) or role in ROLES or hidden:
        return "out", region, ""
    if any(ADVERT.fullmatch(n) or VARYING.fullmatch(n) for n in names):
        return "words", region, ""
    weak = words & WEAK | {start for start in WEAK_STARTS for w in words if w.startswith(start)} | (words & {"header"} if not inside else set())
    return "strong" if any(STRONG.fullmatch(n) for n in names) else "weak" if weak else "", region, " ".join(sorted(weak))


# how a text token ends; a text in doubt keeps the code of the region around it behind the mark
CODES = {"article": "a", "main": "m", "": "", "out": "!", "words": "!", "strong": "~", "weak": "?"}
MARKS, REGIONS = ("", "weak", "strong", "words", "out"), ("", "main", "article")
DOUBT = ("~", "?")


def _inner(outer: tuple[str, str], own: tuple[str, str]) -> tuple[str, str]:
    return max(outer[0], own[0], key=MARKS.index), max(outer[1], own[1], key=REGIONS.index)


def _reopened(outer: tuple[str, str], own: tuple[str, str]) -> tuple[str, str]:
    """As ``_inner``, but the first article region inside elements named like something else is one."""
    if own[1] and "out" not in (outer[0], own[0]) and (not outer[1] or (own[1] == "article" != outer[1] and outer[0] in ("", "weak", "strong"))):
        return "", own[1]
    return _inner(outer, own)


def read(page: str):
    """(tokens, blocks) of a page.

    tokens: block tags and texts (``#`` and a code, see ``CODES``) in page order. blocks: (place in tokens, text, text under links,
    kind, container), where kind is 'out', 'article', 'main' or '' and container the place of the innermost open tag that is not
    a paragraph.
    """
    tokens, blocks, stack = [], [], []       # stack: (name, (mark, region) for what is inside, place, the same reopened)
    marks = []                                # per block: (mark, region), the same reopened
    buf, linked, in_link = [], 0, False
    hidden, depth = None, 0                   # inside an inline element that is not article (an advert, say)
    pos, end = 0, len(page)

    def state():
        return (stack[-1][1], stack[-1][3]) if stack else (("", ""), ("", ""))

    def close_block():
        nonlocal buf, linked
        if buf:
            text = " ".join(htmllib.unescape("".join(buf)).split())
            if text:
                inner = next((s[2] for s in reversed(stack) if s[0] not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "blockquote")), -1)
                if not tokens or tokens[-1] != "#":
                    tokens.append("#")
                blocks.append((len(tokens) - 1, text, min(linked, len(text)), inner))
                marks.append(state())
            buf, linked = [], 0

    while pos < end:
        m = TOKEN.match(page, pos)
        pos = m.end()
        name = m.group(2)
        if name is None:
            part = m.group(0)
            if (part[0] != "<" or part == "<") and hidden is None:
                buf.append(part)
                if in_link:
                    linked += len(part)
            continue
        name, closing = name.lower(), bool(m.group(1))
        if name in INLINE:
            if hidden is not None:
                depth += (name == hidden) * (-1 if closing else 1)
                hidden = hidden if depth else None
                continue
            if not closing and name not in VOID and m.group(3) and _kind(name, m.group(3), bool(state()[0][1]))[0]:
                hidden, depth = name, 1
                continue
            if name == "a":
                in_link = not closing
            elif name == "br":
                buf.append(" ")
            continue
        if not name.startswith("annotation"):       # of a formula, inside its text
            close_block()
            hidden = None
        if name in RAW:
            if not closing and name != "head" and not m.group(3).endswith("/"):
                stop = re.compile(rf"</{name}(?=[\s>/])", re.I).search(page, pos)
                close = page.find(">", stop.end()) if stop else -1
                pos = close + 1 if close >= 0 else end
            continue
        if closing:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None:
                del stack[at:]
                tokens.append("/" + name)
            continue
        if name in CLOSES_P and stack and stack[-1][0] == "p":
            stack.pop()
            tokens.append("/p")
        if name in ("li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == name:
            stack.pop()
            tokens.append("/" + name)
        outer, reopened = state()
        *own, listed = _kind(name, m.group(3), bool(outer[1]))
        tokens.append(name + ("!" + listed if own[0] else "*" if own[1] else ""))
        if name not in VOID and not m.group(3).endswith("/"):
            stack.append((name, _inner(outer, own), len(tokens) - 1, _reopened(reopened, own)))
    close_block()
    if not any(region and not mark for (mark, region), _ in marks):
        marks = [(again, again) for _, again in marks]      # no article region but in elements named like something else
    for (at, *_), ((mark, region), _) in zip(blocks, marks):
        tokens[at] = "#" + CODES[mark] + (CODES[region] if mark in ("", "weak", "strong") else "")
    return tokens, [(at, text, linked, "out" if mark else region, inner) for (at, text, linked, inner), ((mark, region), _) in zip(blocks, marks)]


def _repeats(ids: np.ndarray, size: int) -> bool:
    """Does a piece of ``size`` items stand twice in a row anywhere?"""
    breaks = np.flatnonzero(ids[size:] != ids[:-size])
    return int(np.diff(np.concatenate(([-1], breaks, [len(ids) - size]))).max()) > size


def fold(tokens: list[str]) -> tuple[list[str], list[int]]:
    """Fold neighbouring equal pieces, short ones first, into ``( ... )+``; also the folded place of every token."""
    items = [([t], [[i]]) for i, t in enumerate(tokens)]      # (folded tokens, per folded token the places it came from)
    number: dict = {}
    ids = np.array([number.setdefault((t,), len(number)) for t in tokens], np.int64)
    size = 1
    while size <= len(items) // 2:
        if not _repeats(ids, size):
            size += 1
            continue
        out, at, same = [], 0, ids.tolist()
        while at < len(items):
            n = 1
            while at + (n + 1) * size <= len(items) and same[at + n * size:at + (n + 1) * size] == same[at:at + size]:
                n += 1
            if n > 1:
                flat = [t for x in items[at:at + size] for t in x[0]]
                sources = [[] for _ in flat]
                for k in range(n):
                    each = [s for x in items[at + k * size:at + (k + 1) * size] for s in x[1]]
                    for i, s in enumerate(each):
                        sources[i] += s
                if not (size == 1 and flat[0] == "("):
                    flat, sources = ["(", *flat, ")+"], [[], *sources, []]
                out.append((flat, sources))
                at += n * size
            else:
                out.append(items[at])
                at += 1
        items = out
        ids = np.array([number.setdefault(tuple(x[0]), len(number)) for x in items], np.int64)
        size = 1 if size > 1 else 2
    folded, place = [], [0] * len(tokens)
    for flat, sources in items:
        for t, s in zip(flat, sources):
            for i in s:
                place[i] = len(folded)
            folded.append(t)
    return folded, place


def _rows(a: list[str], b: list[str]):
    """Bit rows of the common-subsequence table: after j tokens of b, bit i is 0 where a[:i + 1] shares one more than a[:i]."""
    at: dict = defaultdict(int)
    for i, t in enumerate(a):
        at[t] |= 1 << i
    full = (1 << len(a)) - 1
    row = full
    for t in b:
        both = row & at.get(t, 0)
        row = ((row + both) | (row - both)) & full
        yield row


def _shared(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of b and a[:i], for every i."""
    row = (1 << len(a)) - 1
    for row in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(a)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence in a and b; time len(a) * len(b) / 64, memory bounded by halving b."""
    pairs, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        x, y = a[a0:a1], b[b0:b1]
        if not x or not y:
            continue
        if len(x) * len(y) > TABLE_BITS and len(y) > 1:
            mid = len(y) // 2
            cut = int(np.argmax(_shared(x, y[:mid]) + _shared(x[::-1], y[mid:][::-1])[::-1]))
            todo += [(a0, a0 + cut, b0, b0 + mid), (a0 + cut, a1, b0 + mid, b1)]
            continue
        table, i, j = list(_rows(x, y)), len(x), len(y)
        while i and j:
            if table[j - 1] >> (i - 1) & 1:
                i -= 1
                continue
            j -= 1
            if not j or table[j - 1] >> (i - 1) & 1:
                i -= 1
                pairs.append((a0 + i, b0 + j))
    return sorted(pairs)


def _steps(a: list[str], b: list[str]):
    """Equal and differing stretches of two streams: equal ends first, the middle by a longest common subsequence."""
    lo, end = 0, min(len(a), len(b))
    while lo < end and a[lo] == b[lo]:
        lo += 1
    tail = 0
    while tail < end - lo and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    steps, i, j = [("equal", 0, lo, 0, lo)], lo, lo
    for m, n in _common(a[lo:len(a) - tail], b[lo:len(b) - tail]):
        m, n = m + lo, n + lo
        if m > i or n > j:
            steps.append(("replace", i, m, j, n))
        steps.append(("equal", m, m + 1, n, n + 1))
        i, j = m + 1, n + 1
    return [*steps, ("replace", i, len(a) - tail, j, len(b) - tail), ("equal", len(a) - tail, len(a), len(b) - tail, len(b))]


def align(wrapper: list, stream: list) -> tuple[list, list[int]]:
    """Merge a stream of (token, optional) into a wrapper; also the place of every token of the stream in the merged wrapper.

    The merged wrapper holds both sides in order, so every stream of a host can be read back without a gap.
    """
    out, place = [], [0] * len(stream)
    a, b = [t for t, _ in wrapper], [t for t, _ in stream]
    for op, a0, a1, b0, b1 in _steps(a, b):
        if op == "equal":
            for i, j in zip(range(a0, a1), range(b0, b1)):
                place[j] = len(out)
                out.append((wrapper[i][0], wrapper[i][1] or stream[j][1]))
            continue
        for source, lo, hi, keep in ((wrapper, a0, a1, False), (stream, b0, b1, True)):
            for i in range(lo, hi):
                if keep:
                    place[i] = len(out)
                out.append((source[i][0], source[i][0] not in ("(", ")+")))     # a group also stands for one piece
    return out, place


def places(wrapper: list[str], stream: list[str]) -> list[int]:
    """Place in the wrapper of every token of a stream, -1 for a token without one."""
    place = [-1] * len(stream)
    for op, a0, _, b0, b1 in _steps(wrapper, stream):
        if op == "equal":
            place[b0:b1] = range(a0, a0 + b1 - b0)
    return place


def expression(wrapper: list) -> str:
    """The wrapper as a readable union-free expression."""
    return " ".join(t + ("?" if optional else "") for t, optional in wrapper)


def host_of(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", url or "")
    return m.group(1).rpartition("@")[2].lower() if m else ""


def _stream(page: str | None):
    tokens, blocks = read(page or "")
    folded, place = fold(tokens)
    return folded, place, blocks


def _asked(tokens) -> set[str]:
    """The text tokens of a page that the host's counts decide: those in doubt, main beside an article, all without a region."""
    texts = {t for t in tokens if t[0] == "#"}
    doubt = {t for t in texts if t[1:2] in DOUBT}
    if "#a" in texts:
        return doubt | (texts & {"#m"})
    return doubt if "#m" in texts else doubt | {"#"}


def layouts(pages: DataFrame) -> DataFrame:
    """Different streams per host: host, stream (JSON), whether its pages need the host's counts, pages."""

    def work(batches):
        for b in batches:
            count: Counter = Counter()
            for url, page in zip(b.column("url").to_pylist(), b.column("html").to_pylist()):
                folded, _, _ = _stream(page)
                count[host_of(url), json.dumps(folded), bool(_asked(folded))] += 1
            if count:
                hosts, streams, bare = zip(*count)
                yield pa.RecordBatch.from_arrays([pa.array(hosts), pa.array(streams), pa.array(bare), pa.array(list(count.values()), pa.int64())],
                                                 names=["host", "stream", "bare", "pages"])

    return (pages.select("url", "html").mapInArrow(work, "host string, stream string, bare boolean, pages long")
            .groupBy("host", "stream").agg(F.max("bare").alias("bare"), F.sum("pages").alias("pages")))


def _merge(streams: DataFrame) -> DataFrame:
    """Align the streams of each host and salt, one after the other; memory holds one wrapper at a time."""
    kinds = "host string, salt long, stream string, bare boolean, pages long"

    def work(batches):
        key, wrapper, bare, pages = None, [], False, 0

        def row():
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([json.dumps(wrapper)]), pa.array([bare]),
                                               pa.array([pages], pa.int64())], names=["host", "salt", "stream", "bare", "pages"])

        for b in batches:
            for r in b.to_pylist():
                now = r["host"], r["salt"]
                if now != key:
                    if key is not None:
                        yield row()
                    key, wrapper, bare, pages = now, None, False, 0
                stream = [tuple(x) if isinstance(x, list) else (x, False) for x in json.loads(r["stream"])]
                wrapper = stream if wrapper is None else align(wrapper, stream)[0]
                bare, pages = bare or r["bare"], pages + r["pages"]
        if key is not None:
            yield row()

    return (streams.select("host", "salt", "stream", "bare", "pages").repartition("host", "salt")
            .sortWithinPartitions("host", "salt", F.desc("pages"), "stream").mapInArrow(work, kinds))


def infer(pages: DataFrame, fan: int = FAN) -> DataFrame:
    """host, wrapper (JSON list of (token, optional)), bare (some page needs the host's counts), pages."""
    importable(pages.sparkSession)
    parts = written(layouts(pages).withColumn("salt", F.pmod(F.xxhash64("stream"), F.lit(1 << 40))))
    salts = parts.groupBy("host").count().agg(F.max("count")).first()[0] or 1
    while True:
        salts = -(-salts // fan)
        parts = _merge(parts.withColumn("salt", F.pmod("salt", F.lit(salts))))
        if salts == 1:
            return parts.select("host", F.col("stream").alias("wrapper"), "bare", "pages")
        parts = written(parts)


@lru_cache(maxsize=64)
def _wrapper(wrapper: str) -> list[str]:
    return [t for t, _ in json.loads(wrapper)]


@lru_cache(maxsize=4096)
def _slots(wrapper: str, folded: str) -> list[int]:
    return places(_wrapper(wrapper), json.loads(folded))


def slotted(page: str | None, wrapper: str):
    """Blocks of a page: slot in the wrapper (-1: none), text, characters under links, text token, container's slot."""
    folded, place, blocks = _stream(page)
    to = _slots(wrapper, json.dumps(folded))
    return [(to[place[at]], text, linked, folded[place[at]], to[place[inner]] if inner >= 0 else -1) for at, text, linked, _, inner in blocks]


FACTS = ("inner", "drop", "free", "worn")


def _held(table: dict | None, batch, name: str):
    """Per row of a batch what is known of its host: from the shared table, or from the row's own columns."""
    if table is not None:
        return [table.get(h) for h in batch.column("host").to_pylist()]
    return list(zip(*(batch.column(c).to_pylist() for c in (("wrapper", *FACTS) if name == "text" else ("wrapper",)))))


def slot_facts(pages: DataFrame, table=None) -> DataFrame:
    """(host, html, and wrapper unless ``table`` holds it) -> per host the container with the most text that is not template (``inner``), the
    template slots of pages without an article region (``drop``), and of the slots in doubt or beside the article those whose
    texts vary over the pages (``free``) and those that are worn (``worn``).

    Summed up per host, slot and text before every shuffle; texts travel as hashes.
    """

    def work(batches):
        known = table.value if table is not None else None
        for b in batches:
            rows: dict = defaultdict(lambda: [0, 0, 0, 0])
            for host, page, of in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), _held(known, b, "facts")):
                if of is None:
                    continue
                blocks, seen = slotted(page, of[0]), set()
                asked = _asked(x[3] for x in blocks)
                for slot, text, linked, token, inner in blocks:
                    if token in asked and slot >= 0:
                        doubt = token != "#"
                        r = rows[host, slot, -1 if doubt else inner, doubt, xxhash.xxh64_intdigest(text.encode()) >> 1]
                        r[0] += 1
                        r[1] += len(text)
                        r[2] += linked
                        r[3] += slot not in seen
                        seen.add(slot)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c) for c in zip(*rows)], *[pa.array(c, pa.int64()) for c in zip(*rows.values())]],
                    names=["host", "slot", "inner", "doubt", "h", "n", "chars", "linked", "pages"])

    rows = pages.mapInArrow(work, "host string, slot long, inner long, doubt boolean, h long, n long, chars long, linked long, pages long")
    sums = ("n", "chars", "linked", "pages")
    texts = rows.groupBy("host", "slot", "inner", "doubt", "h").agg(*[F.sum(c).alias(c) for c in sums])
    slots = texts.groupBy("host", "slot", "inner", "doubt").agg(
        F.sum("n").alias("all"), F.max("n").alias("most"), F.count(F.lit(1)).alias("kinds"),
        *[F.sum(c).alias(c) for c in sums[1:]])
    links = F.col("linked") * 2 > F.col("chars")
    repeats = (F.col("most") >= 2) & (F.col("most") * 2 > F.col("all"))
    flags = {"template": ((F.col("all") >= CONSTANT_PAGES) & repeats) | links, "worn": F.col("doubt") & (repeats | links),
             "free": F.col("doubt") & (F.col("pages") >= FREE_PAGES) & (F.col("kinds") * 2 > F.col("all")) & ~links}
    return (slots.withColumns(flags).groupBy("host", "inner", "doubt")
            .agg(F.sum(F.when(F.col("template"), 0).otherwise(F.col("chars"))).alias("chars"),
                 F.collect_set(F.when(F.col("template") & ~F.col("doubt"), F.col("slot"))).alias("drop"),
                 *[F.collect_set(F.when(F.col(x), F.col("slot"))).alias(x) for x in ("free", "worn")])
            .groupBy("host").agg(F.max(F.when(~F.col("doubt"), F.struct("chars", (-F.col("inner")).alias("inner")))).alias("best"),
                                 *[F.flatten(F.collect_list(x)).alias(x) for x in ("drop", "free", "worn")])
            .select("host", (-F.col("best.inner")).alias("inner"), "drop", "free", "worn"))


def _main_text(page: str | None, wrapper: str, inner, drop, free=None, worn=None) -> str:
    """The texts in the slots that are article for this host; without an article region, the texts of the host's main
    container that are not template."""
    if not page:
        return ""
    dropped, varied, used, blocks = set(drop or ()), set(free or ()), set(worn or ()), []
    for slot, text, _, token, container in slotted(page, wrapper):
        if token[1:2] in DOUBT:
            strong, region = token[1] == "~", token[2:]
            token = "#" + region if (slot in varied if strong or not region else slot not in used) else "#!"
        if token != "#!":
            blocks.append((slot, text, token, container))
    regions = {t for _, _, t, _ in blocks}
    if "#a" in regions:
        return "\n".join(t for s, t, k, _ in blocks if k == "#a" or (k == "#m" and s not in used))
    if "#m" in regions:
        return "\n".join(t for _, t, k, _ in blocks if k == "#m")
    main = []
    if inner is not None:
        main = [t for s, t, _, c in blocks if c == inner and s not in dropped] or [t for s, t, _, _ in blocks if s not in dropped]
    return "\n".join(main or [t for _, t, _, _ in blocks])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    importable(pages.sparkSession)
    context = pages.sparkSession.sparkContext
    hosts = written(infer(pages))
    keyed = pages.select("page_id", "url", "html", _host_column().alias("host"))
    # few enough bytes: every worker gets the wrappers once; else rows meet their host's wrapper in a join
    small = (hosts.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0) <= BROADCAST_BYTES
    bare = hosts.where("bare").select("host", "wrapper")
    if bare.isEmpty():
        facts = hosts.select("host", F.lit(None).cast("long").alias("inner"), *[F.lit(None).cast("array<bigint>").alias(c) for c in FACTS[1:]]).limit(0)
    elif small:
        facts = written(slot_facts(keyed.select("host", "html"), context.broadcast({r.host: (r.wrapper,) for r in bare.collect()})))
    else:
        facts = written(slot_facts(keyed.join(bare, "host").select("host", "html", "wrapper")))
    known = hosts.select("host", "wrapper").join(facts, "host", "left").select("host", "wrapper", *FACTS)
    if small:
        table, joined = context.broadcast({r[0]: tuple(r[1:]) for r in known.collect()}), keyed
    else:
        table, joined = None, keyed.join(known, "host")

    def work(batches):
        held = table.value if table is not None else None
        for b in batches:
            texts = [_main_text(page, *of) for page, of in zip(b.column("html").to_pylist(), _held(held, b, "text"))]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return joined.mapInArrow(work, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def _host_column():
    found = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?([^/?#@]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))
