"""Extract the main text of web pages with wrappers inferred per host.

A page is a stream of tags and texts.  Repeated neighbours in the stream are
folded into repeated groups.  A wrapper is a union-free regular expression:
tags, fixed texts, text slots, repeated groups and optional parts.  The pages
of a host are aligned with its wrapper one after another by the longest common
subsequence: texts that differ become slots, parts that only one side has
become optional, and a group that repeats on either side is repeated in both.
Where a wrapper outgrows its longest page twice, the optional parts that the
fewest pages have become gaps that stand for anything.
Tasks align their own pages first, and only wrappers are shuffled: they merge
by host and salt and then by host, so that a host may hold any share of the
pages.  The finished wrapper says which texts are the same on all of its pages,
also inside repeated groups: they are its template, whatever the element around
them, and what is left are slots.  It says where most of the slot text stands,
also in the variants that only some pages have, and goes back to the pages.  A
page takes its ``article``, else its ``main``, else the element that the wrapper
names; of several articles the one in the main element, or with most text of
its own, is the page's.  One that has none of them with text in it is taken
whole, without noise.

Defined cases.  A NULL page is empty and has no text.  A NULL url, or one
without a host, has the empty host.  Pages without markup are one block.  Tags
that are never closed, stray ends and cut-off pages are read as far as they
go.  Repeated rows are extracted alike; empty tables give empty results.
Pages are read whole; memory grows with the wrappers of a task (see ``HELD`` and
``HELD_ITEMS``) and the one longest page.
"""

from __future__ import annotations

import functools
import html
import itertools
import json
import operator
import re
from collections.abc import Iterable, Iterator


import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.common import each_salt, raw_text, salt_of
from rowloom.llm.url_filter import url_host
from rowloom.session import materialize

#: Hosts whose wrappers a task holds before it sends them on.
HELD = 2_000
#: Items of those wrappers and of their remembered forms, beyond which a task sends them on.
HELD_ITEMS = 400_000
#: Tags of the longest group that is looked for at every place when folding, and forms of pages remembered per wrapper.
FOLD, FORMS = 12, 500
#: Bits of the table by which two lists are aligned, and items that a wrapper may have beyond twice its longest page.
TABLE, SPARE = 1 << 27, 200
BASE, PRIME = 0x1B873593CC9E2D51 % (2**61 - 1), 2**61 - 1
#: Pages that must agree on a text which others of the host have no place for, before it counts as template.
TEMPLATE_PAGES = 5
#: Bits by which pages are told apart, of the 60 there are for them.
MARKS = 3

OPEN = re.compile(rb"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
# A quote counts after an equals sign only.
QUOTE = re.compile(rb"""=\s*(["'])|>""")
UNSEEN = re.compile(rb"""(?:^|\s)hidden(?=[\s=/>]|$)""", re.I)
NO_DISPLAY = re.compile(rb"""\sstyle\s*=\s*(?:"[^"]*|'[^']*)display\s*:\s*none""", re.I)
QUOTED = re.compile(rb"""=\s*(?:"[^"]*"|'[^']*')""")
NAMED = re.compile(rb"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# Names of elements and of their classes.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "s",
          "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
PARAGRAPHS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "th", "dd", "dt", "figcaption"}
NOISE = {"nav", "footer", "aside", "form", "button", "select", "head", "menu", "dialog", "svg", "object", "label", *RAW}
NOISE_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
               "cookie", "cookies", "disqus", "footer", "masthead", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup",
               "promo", "promoted", "recommended", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "social", "sponsor",
               "sponsored", "subscribe", "toolbar", "widget", "complementary", "contentinfo", "search", "overlay", "modal"}
# Words that may stand beside those names in a longer name of the same meaning.
FILLERS = {"area", "article", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "entry", "form", "global", "icons",
           "inner", "item", "items", "left", "link", "links", "list", "main", "outer", "page", "post", "posts", "primary", "right", "secondary",
           "section", "site", "top", "wrap", "wrapper"}
MAIN_NAMES = {"article", "content", "entry", "main", "post", "story", "body", "text"}


def tag_end(page: bytes, at: int) -> int:
    """Where the tag ends whose name ends at ``at``: after a ``>`` outside of quotes, or -1."""
    plain = page.find(b">", at) + 1
    while plain:
        found = QUOTE.search(page, at)
        if found and found[1] is None:
            return found.end()
        close = page.find(found[1], found.end()) if found else -1
        if close < 0:
            return plain
        at = close + 1
    return -1


#: The mark of an element that is not shown.
HIDDEN = "!hidden"


def hides(told: bytes) -> bool:
    """Whether the attributes of a tag keep its element from being shown."""
    if b"hidden" in told.lower() and UNSEEN.search(QUOTED.sub(b"=q", told)):
        return True
    return b"none" in told and bool(NO_DISPLAY.search(told))


def stream(page: bytes) -> Iterator[tuple[str, str]]:
    """Tags as (``<name`` with the words of its class, id and role, or ``</name``, "") and texts as ("#", text) in the order of the page."""
    at, size = 0, len(page)
    while at < size:
        found = OPEN.search(page, at)
        end = -1
        if found and found[1]:
            end = page.find(b"-->", found.end()) + 3
            end = size if end < 3 else end
        elif found:
            end = page.find(b">", found.end()) + 1 if found[2] else tag_end(page, found.end())
        if not found or end <= 0:
            yield "#", page[at:].decode("utf-8", "replace")
            return
        if found.start() > at:
            yield "#", page[at : found.start()].decode("utf-8", "replace")
        at = end
        if found[4] is None:
            continue
        name = found[4].decode("ascii", "replace").lower()
        if found[3]:
            yield "</" + name, ""
            continue
        told = NAMED.finditer(page[found.end() : end])
        marks = sorted({w for m in told for w in (m[2] or m[3] or m[4] or b"").decode("utf-8", "replace").lower().split()})
        if hides(page[found.end() : end]):
            marks.append(HIDDEN)
        yield "<" + ".".join([name, *marks]), ""
        if name in RAW:
            close = re.compile(rb"</" + found[4] + rb"[\s/>]", re.I).search(page, at)
            at = close.start() if close else size


def name_of(tag: str) -> str:
    return tag.lstrip("</").partition(".")[0]


def named_so(marks: str, names: set[str]) -> bool:
    """Whether all words of one class, id or role are among ``names`` or beside one of them."""
    found = [{w for w in re.split(r"[^a-z]+", mark) if w} for mark in marks.split(".")]
    return any(words & names and words <= names | FILLERS for words in found)


@functools.lru_cache(100_000)
def noise_kind(tag: str) -> str:
    """How an element can be none of the main text: by "element", as a "header", by "name", that is class, id or role, or not ("")."""
    name, _, marks = tag[1:].partition(".")
    if name in NOISE or marks.endswith(HIDDEN):
        return "element"
    if name in ("html", "body", "main"):
        return ""
    if name == "article":
        return "name" if named_so(marks, {"comment", "comments", "reply", "replies"}) else ""
    if named_so(marks, NOISE_NAMES):
        return "name"
    return "header" if name == "header" or named_so(marks, {"header"}) else ""


class Walk:
    """The open elements along a stream; ends close the nearest element of their name.

    ``noise`` and ``inside`` are the depths of the outermost element that is
    none of the main text, and of the outermost main element, 0 outside.
    ``mains`` are the places of the tags that start main elements, ``free``
    those of the main elements and what is around them, which are no noise.
    Without ``names`` classes, ids and roles say nothing.
    """

    def __init__(self, mains: Iterable[int] = (), free: Iterable[int] = (), names: bool = True):
        self.open: list[str] = []
        self.starts: list[int] = []
        self.noise = self.inside = 0
        self.mains, self.free, self.names = mains, free, names

    def enter(self, tag: str, at: int = -1) -> None:
        name = name_of(tag)
        if tag.startswith("</"):
            for i in range(len(self.open) - 1, -1, -1):
                if name_of(self.open[i]) == name:
                    self.close(i)
                    return
            return
        if name in VOID:
            return
        if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and self.open and name_of(self.open[-1]) == name:
            self.close(len(self.open) - 1)
        if not self.noise and at not in self.free and self.drops(tag):
            self.noise = len(self.open) + 1
        if not self.inside and at in self.mains:
            self.inside = len(self.open) + 1
        self.open.append(tag)
        self.starts.append(at)

    def drops(self, tag: str) -> bool:
        kind = noise_kind(tag)
        if kind == "header":
            # A header inside a main element is its own, other ones are the site's.
            return not self.inside and not any(name_of(t) in ("article", "main") for t in self.open)
        if kind == "name":
            return self.names and not (self.inside and name_of(tag) in PARAGRAPHS)
        return bool(kind)

    def close(self, depth: int) -> None:
        del self.open[depth:]
        del self.starts[depth:]
        self.noise = 0 if self.noise > depth else self.noise
        self.inside = 0 if self.inside > depth else self.inside


# A wrapper is a list of items [key, optional, texts, [chars, pages, marks]]: texts are those that half of its pages
# have (hash: [length, pages]), none in slots, and None for tags; pages had the item, and marks are those of the
# pages; a key is a tag, "#" for a text, or the keys of a repeated group between brackets.


def long_groups(keys: list[str]) -> dict[int, list[int]]:
    """The lengths over FOLD of groups that follow themselves at once, by the place of their first tag.

    A group starts again at one of the next elements with its first tag and the
    same parent; rolling hashes compare the keys between those places.
    """
    if len(keys) <= 2 * FOLD:
        return {}
    sums, numbers = [0], {}
    for key in keys:
        sums.append((sums[-1] * BASE + numbers.setdefault(key, len(numbers) + 1)) % PRIME)
    follows, inside = {}, [("", {})]
    for i, key in enumerate(keys):
        if key.startswith("</"):
            d = next((d for d in range(len(inside) - 1, 0, -1) if inside[d][0] == name_of(key)), 0)
            del inside[d or len(inside) :]
        elif key.startswith("<"):
            last = inside[-1][1]
            follows[last.get(key, -1)] = i
            last[key] = i
            if name_of(key) not in VOID:
                inside.append((name_of(key), {}))
    found: dict[int, list[int]] = {}
    for i in follows:
        at = i
        for _ in range(FOLD):
            at = follows.get(at, -1)
            k = at - i
            if at < 0 or at + k > len(keys):
                break
            power = pow(BASE, k, PRIME)
            if k > FOLD and (sums[at] - sums[i] * power - sums[at + k] + sums[at] * power) % PRIME == 0:
                found[i] = [k]
                break
    return found


def group_texts(part: list[list]) -> dict[str, list[int]]:
    """The texts among some items that become a group."""
    found: dict[str, list[int]] = {}
    for _, _, texts, _ in part:
        for h, (n, count) in (texts or {}).items():
            found[h] = [n, max(count, found[h][1] if h in found else 0)]
    return found


def shared_texts(x: list, y: list) -> dict[str, list[int]] | None:
    """The texts that half of the pages have of two items of one key."""
    if x[2] is None or y[2] is None:
        return None
    both = {h: [n, count + y[2].get(h, (0, 0))[1]] for h, (n, count) in x[2].items()}
    both |= {h: told for h, told in y[2].items() if h not in both}
    return {h: told for h, told in both.items() if 2 * told[1] >= x[3][1] + y[3][1]}


def fold(items: list[list], bodies: set[str]) -> list[list]:
    """Replace repeated neighbours, and single ones that are known to repeat, by groups."""
    keys = [item[0] for item in items]
    long, known = long_groups(keys), {}
    for body in bodies:
        if body.count("|") >= FOLD:
            known.setdefault(body.partition("|")[0], set()).add(body.count("|") + 1)
    folded, i = [], 0
    while i < len(items):
        for k in (*range(1, min(FOLD, len(items) - i) + 1), *sorted({*known.get(keys[i], ()), *long.get(i, ())})):
            body = keys[i : i + k]
            repeats = 1
            while keys[i + repeats * k : i + (repeats + 1) * k] == body:
                repeats += 1
            if k + repeats > 2 and len(body) == k and not body[0].startswith("</") and (repeats > 1 or "|".join(body) in bodies):
                name = "(" + "|".join(body) + ")+"
                part = items[i : i + repeats * k]
                salts = functools.reduce(operator.or_, (x[3][2] for x in part))
                folded.append([name, all(x[1] for x in part), group_texts(part), [sum(x[3][0] for x in part), max(x[3][1] for x in part), salts]])
                i += repeats * k
                break
        else:
            folded.append(items[i])
            i += 1
    return folded


def mark_of(page: bytes) -> int:
    """Three bits of 60 that stand for a page: equal pages have the same, two others hardly ever."""
    number, bits = xxhash.xxh3_64_intdigest(page), 0
    while bits.bit_count() < MARKS:
        number, bit = divmod(number or (1 << 64) - 59, 60)
        bits |= 1 << bit
    return bits


def text_id(around: str, plain: str) -> str:
    """A text and the last tag of a block before it, as a hash."""
    return xxhash.xxh3_64_hexdigest(f"{around} {plain}")


def page_items(page: bytes, salts: int = 0) -> list[list]:
    items, around = [], ""
    for key, text in stream(page):
        if key != "#":
            items.append([key, False, None, [0, 1, salts]])
            around = around if name_of(key) in INLINE else key
        elif plain := " ".join(text.split()):
            items.append(["#", False, {text_id(around, plain): [len(plain), 1]}, [len(plain), 1, salts]])
    return items


def _rows(a: list[str], b: list[str]) -> Iterator[int]:
    """The table of longest common subsequences of ``a`` with growing ends of ``b``: bit i is 0 where a[-1 - i] makes one longer."""
    full, at = (1 << len(a)) - 1, {}
    for i, key in enumerate(reversed(a)):
        at[key] = at.get(key, 0) | 1 << i
    row = full
    for key in reversed(b):
        same = row & at.get(key, 0)
        row = ((row + same) | (row - same)) & full
        yield row


def _gains(a: list[str], b: list[str]) -> list[int]:
    """The lengths of the longest common subsequences of ``b`` with the last 0, 1, ... keys of ``a``."""
    row = (1 << len(a)) - 1
    for row in _rows(a, b):  # noqa: B007
        pass
    return [0, *itertools.accumulate(1 - int(bit) for bit in reversed(f"{row:0{len(a)}b}"))] if a else [0]


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """The places of a longest common subsequence.

    The table is a row of bits for each key of ``b``; one over TABLE bits is
    halved (Hirschberg), so that memory grows with the lists and not their product.
    """
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, n, j, m = todo.pop()
        if i == n or j == m:
            continue
        if (n - i) * (m - j) > TABLE and m - j > 1:
            half = (j + m) // 2
            ends = _gains(a[i:n], b[half:m])
            starts = _gains(a[i:n][::-1], b[j:half][::-1])
            cut = i + max(range(n - i + 1), key=lambda k: starts[k] + ends[n - i - k])
            todo += [(cut, n, half, m), (i, cut, j, half)]
            continue
        rows = list(_rows(a[i:n], b[j:m]))
        while i < n and j < m:
            if a[i] == b[j]:
                found.append((i, j))
                i, j = i + 1, j + 1
            elif rows[m - 1 - j] >> (n - 1 - i) & 1:
                i += 1
            else:
                j += 1
    return found


def added(x: list[int], y: list[int]) -> list[int]:
    return [x[0] + y[0], x[1] + y[1], x[2] | y[2]]


def align(left: list[list], right: list[list]) -> tuple[list[list], list[int]]:
    """The wrapper that covers both, common items once, the others optional, and where the items of ``right`` stand in it."""
    a, b = [x[0] for x in left], [x[0] for x in right]
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    n, m = len(a) - first - last, len(b) - first - last
    joined, places, i, j = [], list(range(first)), 0, 0
    both = lambda x, y: [x[0], x[1] or y[1], shared_texts(x, y), added(x[3], y[3])]
    joined.extend(both(x, y) for x, y in zip(left[:first], right[:first], strict=True))
    for x, y in [*common(a[first : first + n], b[first : first + m]), (n, m)]:
        joined.extend([left[first + k][0], True, *left[first + k][2:]] for k in range(i, x))
        places.extend(range(len(joined), len(joined) + y - j + (x < n)))
        joined.extend([right[first + k][0], True, *right[first + k][2:]] for k in range(j, y))
        if x < n:
            joined.append(both(left[first + x], right[first + y]))
        i, j = x + 1, y + 1
    tail = len(a) - last
    places.extend(range(len(joined), len(joined) + last))
    joined.extend(both(x, y) for x, y in zip(left[tail:], right[len(b) - last :], strict=True))
    return joined, places


def generalised(items: list[list], size: int) -> list[list]:
    """Items of which the optional parts that the fewest pages have are one gap "*" each, about ``size`` of them."""
    partner, open_at = {}, []
    for i, (key, *_) in enumerate(items):
        if key.startswith("</"):
            d = next((d for d in range(len(open_at) - 1, -1, -1) if name_of(items[open_at[d]][0]) == name_of(key)), -1)
            if d >= 0:
                partner[i], partner[open_at[d]] = open_at[d], i
                del open_at[d:]
        elif key.startswith("<") and name_of(key) not in VOID:
            open_at.append(i)
    counts = sorted(x[3][1] for x in items if x[1] and x[0] != "*")
    left, whole = len(counts), items
    while left and len(whole) > size:
        left //= 2
        most = counts[len(counts) - 1 - left]
        rare = [x[0] == "*" or x[1] and x[3][1] <= most for x in items]
        whole = []
        for i, x in enumerate(items):
            if not (rare[i] and rare[partner.get(i, i)]):
                whole.append(x)
            elif whole and whole[-1][0] == "*":
                whole[-1] = ["*", True, None, added(whole[-1][3], x[3])]
            else:
                whole.append(["*", True, None, x[3]])
    return whole


def bodies_of(items: Iterable[list]) -> set[str]:
    return {key[1:-2] for key, *_ in items if key.startswith("(")}


class Wrapper:
    """A union-free expression for the pages of a host, and how many it was made from."""

    def __init__(self, items: list[list] | None = None, pages: int = 0, salts: int = 0):
        self.items, self.pages, self.salts = items or [], pages, salts
        self.longest = self.places = 0
        self.forms: dict[str, list[int]] = {}

    def size(self) -> int:
        return len(self.items) + self.places

    def add(self, items: list[list], pages: int = 1, salts: int = 0, longest: int = 0) -> None:
        self.salts |= salts
        if not self.pages:
            self.items, self.pages = fold(items, set()), pages
            self.longest = longest or len(self.items)
            return
        self.pages += pages
        folded = fold(items, bodies_of(self.items))
        self.longest = max(self.longest, longest or len(folded))
        form = xxhash.xxh3_128_hexdigest("\n".join(x[0] for x in folded))
        if form in self.forms:  # aligned before: only texts can differ
            for place, x in zip(self.forms[form], folded, strict=True):
                mine = self.items[place]
                mine[1], mine[2], mine[3] = mine[1] or x[1], shared_texts(mine, x), added(mine[3], x[3])
            return
        more = bodies_of(folded) - bodies_of(self.items)
        if more:
            self.items, self.forms, self.places = fold(self.items, more), {}, 0
        size = len(self.items)
        self.items, places = align(self.items, folded)
        if len(self.items) != size or len(self.forms) >= FORMS or self.places > HELD_ITEMS // 4:
            self.forms, self.places = {}, 0
        if len(self.items) > 2 * self.longest + SPARE:
            self.items = generalised(self.items, 3 * self.longest // 2 + SPARE)
            self.forms, self.places = {}, 0
            return
        self.forms[form] = places
        self.places += len(places)

    def dump(self) -> str:
        return json.dumps([self.items, self.pages, self.longest])


def merged(wrappers: Iterable[tuple[str, int]]) -> Wrapper:
    """One wrapper for those of several tasks, in the order of their texts."""
    whole = Wrapper()
    for text, salts in sorted(wrappers):
        items, pages, longest = json.loads(text)
        whole.add(items, pages, salts, longest)
    return whole


def agreed(optional: bool, pages: int, marks: int) -> bool:
    """Whether pages that differ agree on a text: two where all pages have it, else ``TEMPLATE_PAGES``, of which two may be alike."""
    different = marks.bit_count() - MARKS
    return different > 0 and (not optional or pages >= TEMPLATE_PAGES and different >= TEMPLATE_PAGES)


def rule(wrapper: Wrapper) -> dict:
    """What a wrapper says: the main elements of all its pages and of their variants, best first, and the texts of the template.

    Elements are weighed by slot text; by all text where the pages have no other.
    """
    walk, having, template = Walk(), {}, set()
    slots, fixed = {}, {}
    for key, optional, texts, (chars, pages, marks) in wrapper.items:
        group = key.startswith("(")
        # Texts of nearly all pages; one of nine in ten is found however pages are dealt to tasks.
        lasting = {h: told for h, told in (texts or {}).items() if 10 * told[1] >= 7 * pages} if agreed(optional, pages, marks) else {}
        constant = min(chars, sum(n * count for n, count in lasting.values()))
        for part in key[1:-2].split("|") if group else [key]:
            if part == "*":
                continue
            if part != "#":
                walk.enter(part)
                if not part.startswith("</"):
                    having[part] = max(having.get(part, 0), pages)
                continue
            if walk.noise:
                continue
            template.update(lasting)
            if any(name_of(t) == "a" for t in walk.open):
                continue
            parts = max(key.count("#"), 1)
            for where in [(-1, ""), *enumerate(walk.open)]:
                slots[where] = slots.get(where, 0) + (chars - constant) / parts
                fixed[where] = fixed.get(where, 0) + constant / parts
    mass = slots if slots.get((-1, "")) else {where: slots[where] + fixed[where] for where in slots}
    total = mass.pop((-1, ""), 0)
    # The innermost element that holds most of the text, one with a telling name before others;
    # in variants it holds as much of a mean page, as often as it is there.
    mains, variants = [], []
    for (depth, tag), m in mass.items():
        if name_of(tag) not in PARAGRAPHS | INLINE | {"html", "body"}:
            rank = (bool(set(re.split(r"[^a-z]+", tag)) & MAIN_NAMES), depth, tag)
            if m >= 0.6 * total:
                mains.append(rank)
            elif m >= 0.6 * total * having[tag] / max(wrapper.pages, 1):
                variants.append(rank)
    mains.sort(reverse=True)
    # Two pages with more text in common than of their own are copies rather than a template.
    place = mains[0][1:] if mains else (-1, "")
    if wrapper.pages == 2 and fixed.get(place, 0) > slots.get(place, 0):
        template = set()
    return {"main": [tag for *_, tag in mains], "variants": [tag for *_, tag in sorted(variants, reverse=True)], "template": sorted(template)}


def is_main(tag: str) -> bool:
    name, *marks = tag[1:].split(".")
    return name == "main" or "main" in marks and name not in PARAGRAPHS | INLINE


def main_elements(events: list[tuple[str, str]], said: dict) -> tuple[list, list]:
    """The page's main elements, the best kind first: (starts, starts with all elements around, whether they must hold half of the text).

    Articles in a main element go before others.  The second list has the
    elements inside those that have the name of noise.
    """
    ranks = {tag: 2 + i for i, tag in enumerate(dict.fromkeys([*said["main"], *said["variants"]]))}
    weak, found, walk = 2 + len(said["main"]), {}, Walk()
    for at, (key, _) in enumerate(events):
        if key == "#":
            continue
        walk.enter(key, at)
        if key.startswith("</"):
            continue
        rank = 0 if name_of(key) == "article" else 1 if is_main(key) else ranks.get(key)
        if rank is None or noise_kind(key) or not walk.starts or walk.starts[-1] != at:
            continue
        around = [(name_of(t), noise_kind(t)) for t in walk.open] if walk.noise else []
        if all(kind != "element" or name == "form" for name, kind in around):
            if rank == 0:
                outer = walk.open[:-1]
                rank = -2 if any(map(is_main, outer)) else -1 if any(t in ranks for t in outer) else 0
            starts, free = found.setdefault((any(kind not in ("", "element") for _, kind in around), rank), (set(), set()))
            starts.add(at)
            free.update(walk.starts)
    kinds = [[(*found[key], key[1] >= weak) for key in sorted(found) if key[0] == hidden] for hidden in (False, True)]
    return kinds[0], kinds[1]


def blocks_of(events: list[tuple[str, str]], mains: set[int] | None, free: Iterable[int], template: Iterable[str], names: bool) -> str:
    """The blocks of the elements that start at ``mains``, or of the whole page, without noise and template.

    A block is template when all of its texts are, so words in common stay in a block of other words.
    """
    walk, blocks, open_block, own, around = Walk(mains or (), free, names), [], [], False, ""

    def end() -> None:
        nonlocal own
        plain = " ".join(html.unescape("".join(open_block)).split())
        if plain and own:
            blocks.append(plain)
        open_block.clear()
        own = False

    for at, (key, text) in enumerate(events):
        if key == "#":
            if not walk.noise and (walk.inside or mains is None):
                open_block.append(text)
                said = " ".join(text.split())
                own |= bool(said) and (not template or text_id(around, said) not in template)
            continue
        if name_of(key) not in INLINE:
            end()
            around = key
        walk.enter(key, at)
    end()
    return "\n".join(blocks)


def own_text(events: list[tuple[str, str]], kind: tuple, template: Iterable[str]) -> str:
    """The text of a kind of main elements, without names where these would empty it; of several articles the longest."""
    mains, free, _ = kind
    for names in (True, False):
        whole = blocks_of(events, mains, free, template, names)
        if whole and len(mains) > 1 and all(name_of(events[at][0]) == "article" for at in mains):
            return max((blocks_of(events, {at}, free, template, names) for at in sorted(mains)), key=len)
        if whole:
            return whole
    return ""


def main_text(page: bytes, said: dict) -> str:
    """The blocks of the first main element that the page has with text in it, else of the whole page, one to a line.

    An element whose text is all template is left for the next one; only a page
    of nothing else is taken with its template.  A main element inside noise by
    name counts where it holds more than the rest.
    """
    events = list(stream(page))
    clear, hidden = main_elements(events, said)
    for template in (said["template"], ()) if said["template"] else ((),):
        whole = None
        for kind in clear:
            text = own_text(events, kind, template)
            if kind[2] and text and whole is None:
                whole = blocks_of(events, None, (), template, True)
            if text and not (kind[2] and 2 * len(text) < len(whole)):
                return text
        if whole is None:
            whole = blocks_of(events, None, (), template, True)
        for kind in hidden:
            text = own_text(events, kind, template)
            if len(text) > len(whole):
                return text
        whole = whole or blocks_of(events, None, (), template, False)
        if whole:
            return whole
    return ""


def _wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Align the pages of a task with the wrappers of their hosts."""
    held: dict[str, Wrapper] = {}
    items = 0

    def sent() -> pa.RecordBatch:
        rows = sorted(held.items())
        columns = [pa.array([h for h, _ in rows], pa.string()), pa.array([w.dump() for _, w in rows], pa.string()), pa.array([w.salts for _, w in rows], pa.int64())]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, names=["host", "wrapper", "salts"])

    for batch in batches:
        for host, salt, page in zip(*(batch.column(c).to_pylist() for c in ("host", "salt", "page")), strict=True):
            wrapper = held.setdefault(host, Wrapper())
            items -= wrapper.size()
            wrapper.add(page_items(page, mark_of(page)), 1, 1 << salt)
            items += wrapper.size()
            if len(held) >= HELD or items >= HELD_ITEMS:
                yield sent()
                items = 0
    if held:
        yield sent()


def _merge(final: bool):
    kinds = pa.schema([("host", pa.string()), ("wrapper", pa.string()), ("salts", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        whole = merged(zip(table.column("wrapper").to_pylist(), table.column("salts").to_pylist(), strict=True))
        text = json.dumps(rule(whole)) if final else whole.dump()
        return pa.table({"host": [table.column("host")[0].as_py()], "wrapper": [text], "salts": [whole.salts]}, kinds)

    return run


def infer_rules(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, rule (what its wrapper says) and the mask of salts of its pages, one row per host."""
    kind = "host string, wrapper string, salts long"
    rows = pages.select(url_host(F.col(url_col)).alias("host"), salt_of(raw_text(html_col)).alias("salt"), raw_text(html_col).alias("page"))
    parts = rows.mapInArrow(_wrappers, kind).withColumn("lot", salt_of(F.col("wrapper")))
    salted = parts.groupBy("host", "lot").applyInArrow(_merge(False), kind)
    return salted.groupBy("host").applyInArrow(_merge(True), kind).withColumnRenamed("wrapper", "rule")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Return page_id, url and text, the main text of each page, one row per page."""
    rules = materialize(infer_rules(pages, url_col, html_col), "wrappers").select("host", "rule", each_salt("salts").alias("salt"))
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), url_host(F.col(url_col)).alias("host"), salt_of(raw_text(html_col)).alias("salt"), raw_text(html_col).alias("page")
    )
    joined = rows.join(rules, ["host", "salt"], "left").select("page_id", "url", "rule", "page")
    schema = T.StructType([joined.schema["page_id"], joined.schema["url"], T.StructField("text", T.StringType())])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in batches:
            found = []
            for told, page in zip(batch.column("rule").to_pylist(), batch.column("page").to_pylist(), strict=True):
                if told not in known:
                    said = json.loads(told) if told else {"main": [], "variants": [], "template": []}
                    known = {**known, told: said | {"template": set(said["template"])}} if len(known) < HELD else {told: said | {"template": set(said["template"])}}
                found.append(main_text(page, known[told]))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())], names=["page_id", "url", "text"])

    return joined.mapInArrow(texts, schema)
