"""HTML extraction by wrappers: union-free regular expressions inferred from the pages of a host.

A page is read as a stream of tags and texts. Inline markup belongs to the
text around it; a block is named by its tag and class words. Repeats inside a
page are folded: a block that comes again joins the one before it, and what
lies between them becomes a repeated group. The folded pages of a host are
aligned one after the other into the host's wrapper, a tree of blocks in which

* a block that some pages lack is optional, one that comes again is repeated;
* blocks whose order differs between pages become one repeated group of optional members;
* a text that differs between pages (or repeats) is a slot, one that is the same on all is part of the template.

Aligning is associative up to the order inside groups, so every page counts:
each task aligns what it reads by host, and partial wrappers are aligned in
salted rounds of bounded size until a host has one. A wrapper grows with the
template, not with the pages.

A label stands once in the sequence of its parent (what comes again is folded, what
crosses becomes a group), so a page is matched against the expression of its host by path: a text
belongs to the slot of its path, in optional and repeated blocks too.

A wrapper decides once per host which of its slots are the main text. Those that
vary on the host and hold running text, not links, carry the decision:

* tags and attributes that say so (menus, footers, asides, forms, hidden blocks) are outside; class words, roles and ids
  that hint at it (adverts, comments, notices) count where the wrapper confirms them, see ``_inside``;
* main blocks (``article``, ``main``, or a block named so) that stand side by side are a region; of several
  regions the one whose slots hold the most such text is the main text, template texts and links inside it too;
* where unnamed slots hold more such text than that region, they are main text with it. So are they on a host without main blocks.

On a host of one page nothing varies against another page, so all slots count as varying and names decide.
The rules of a host are a short list of paths; pages of all hosts
are then read again and the texts of their slots are put out.

Defined results: a null or empty page has an empty text; a null url (or one
without a host) is a host of its own name, the empty one; unclosed blocks end where
HTML says or at the end of the page; blocks nested deeper than ``DEPTH`` belong to the block at that depth, with their texts; a page that fits no rule has an empty text; repeated rows are extracted each; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.shared import cut, settled

FAN_IN = 64  # partial wrappers aligned in one group, on average
HOSTS = 512  # hosts whose wrappers a task holds before it puts them out

DEPTH = 256  # blocks nested deeper belong to the path of the block at that depth

# What a "<" may begin: a tag (its name), a comment or a declaration.
_START = re.compile(r"<(?:(/?)([a-zA-Z][^\s/><]*+)|(!--)|[!?])")
# A whole tag, if its values are quoted and hold no "<" or ">"; others are read step by step.
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>=\"']++|=\"[^\"<>]*+\"|='[^'<>]*+')*+)>")
_EVENT, _QUOTE = re.compile(r"[>=]"), re.compile(r"\s*([\"'])")
_COMMENT_END = re.compile(r"--!?>")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[a-z]+")
# Elements whose content isn't markup: it ends at their own closing tag, whatever stands before.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
_CLOSING = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in RAW}
# Elements whose content is markup but no text of the page; they may hold each other and themselves.
SKIPPED = {"template", "svg", "math", "object", "canvas"}
_SKIPPED_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in SKIPPED}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q",
          "ruby", "rb", "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
# A start tag of the key ends open elements of the value.
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"}}
# What an element that ends another can't reach beyond.
SCOPE = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "html", "nav", "aside", "header", "footer", "form", "blockquote", "select"}
OUTSIDE = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "fieldset", "label", "input"}
OUTSIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar",
                 "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "widget", "related", "recommended", "recommendations", "cookie", "cookies",
                 "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
                 "login", "share", "sharing", "social", "comment", "comments", "disqus", "respond", "replies", "reply", "footer", "header", "masthead", "toolbar",
                 "pagination", "pager", "search", "contentinfo", "complementary", "dialog", "copyright", "disclaimer"}
# Words that may stand beside one of these in a name: "sidebar-left" is a sidebar, "social-impact" and "search-results" are not hints.
BESIDE = {"area", "bar", "block", "bottom", "box", "button", "buttons", "column", "container", "form", "inner", "item", "items", "large", "left", "links", "list", "main", "outer",
          "post", "posts", "primary", "right", "secondary", "section", "site", "slot", "small", "thread", "top", "unit", "wrap", "wrapper"}
MAIN = ("article", "main")
# Blocks that keep their articles outside, unless they were left open before them.
APART = OUTSIDE - {"form", "fieldset", "label", "input", "head", "button"}
MAIN_WORDS = {"article", "articlebody", "story", "post", "entry", "content", "main", "body", "text"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def _attributes(text: str) -> dict[str, str]:
    """The attributes of a tag by name; the first of a name counts."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return out


class _Tokens:
    """The tags and texts of a page from ``at`` on, in linear time: (closing slash, tag or None, attributes, text, start, end).

    Where a tag ends depends only on the next ">" or "=" outside quotes, so each of those is looked at once in a page,
    however many "<" come before it.
    """

    def __init__(self, page: str):
        self.page, self.at = page, 0
        self.ends: dict[int, int] = {}              # by place of a ">" or "=" outside quotes: the end of the tag it is in, -1 if none
        self.last = {mark: page.rfind(mark) for mark in ">\"'"}
        self.quiet = (0, -1)                        # a stretch without ">" and "=", and the place after it
        self.closings: dict[str, int] = {}          # the last closing tag of an element

    def _tag_end(self, at: int) -> int:
        """The place of the ">" that ends a tag whose attributes begin at ``at``, -1 if there is none; quotes count after "=" only."""
        page, seen, end = self.page, [], -1
        if not self.quiet[0] <= at <= self.quiet[1]:
            m = _EVENT.search(page, at)
            self.quiet = (at, m.start() if m else len(page))
        at = self.quiet[1]
        while (m := _EVENT.search(page, at)) is not None:
            place = m.start()
            if place in self.ends:
                end = self.ends[place]
                break
            seen.append(place)
            if page[place] == ">":
                end = place
                break
            at = place + 1
            if (quoted := _QUOTE.match(page, at)) is not None:
                if self.last[quoted[1]] >= quoted.end():
                    at = page.index(quoted[1], quoted.end()) + 1
        self.ends.update(dict.fromkeys(seen, end))
        return end

    def closes(self, tag: str, at: int) -> bool:
        """Whether a closing tag of ``tag`` comes at or after ``at``."""
        if tag not in self.closings:
            self.closings[tag] = max((m.start() for m in _SKIPPED_END[tag].finditer(self.page)), default=-1)
        return self.closings[tag] >= at

    def __iter__(self) -> Iterator[tuple[str, str | None, str, str, int, int]]:
        page = self.page
        while self.at < len(page):
            start = page.find("<", self.at)
            start = len(page) if start < 0 else start
            if start > self.at:
                at, self.at = self.at, start
                yield "", None, "", page[at:start], at, start
                continue
            if (m := _PLAIN_TAG.match(page, start)) is not None:
                self.at = m.end()
                yield m[1], m[2], m[3], "", start, self.at
                continue
            m = _START.match(page, start)
            if m is None:
                end = -1
            elif m[3]:
                empty = next((x for x in (">", "->") if page.startswith(x, m.end())), None)
                close = None if empty else _COMMENT_END.search(page, m.end())
                end = m.end() + len(empty) if empty else close.end() if close else len(page)
            else:
                end = self._tag_end(m.end()) if m[2] else page.find(">", m.end()) if m.end() <= self.last[">"] else -1
                end = end + 1 or -1
            if end < 0:             # no tag: the "<" is text
                self.at = start + 1
                yield "", None, "", "<", start, start + 1
            else:
                self.at = end
                yield m[1] or "", m[2], page[m.end():end - 1] if m[2] else "", "", start, end


def _hints(value: str) -> bool:
    """Whether a name of a class, role or id says that a block lies outside a main text."""
    for name in value.lower().split():
        parts = [p for p in _NAME.findall(name) if len(p) > 1]
        if any(p in OUTSIDE_WORDS for p in parts) and all(p in OUTSIDE_WORDS or p in BESIDE for p in parts):
            return True
    return False


def _label(tag: str, attributes: str, within: bool) -> tuple[str, int]:
    """The name of a block (tag and class words), and whether it lies outside a main text: 1 says its tag or that it is hidden, -1 hint its names.

    An id counts only with what it says: a main block, or a hint; not on headings, nor on sections ``within`` a main block.
    """
    names, outside = set(), int(tag in OUTSIDE)
    if attributes and not attributes.isspace():
        have = _attributes(attributes)
        if "hidden" in have or have.get("aria-hidden", "").strip().lower() == "true":
            names.add("hidden")
            outside = 1
        said = [have[a] for a in ("class", "role", "itemprop") if a in have]
        for name in " ".join(said).lower().split():
            parts = _NAME.findall(name)
            if parts and parts[0] in ("has", "with", "no", "without"):
                continue
            names.update(p for p in parts if len(p) < 24)
        called = have.get("id", "").lower()
        if called and tag not in HEADINGS and not (within and tag == "section"):
            parts = set(_NAME.findall(called))
            if _hints(called) or parts and parts <= MAIN_WORDS:
                names |= parts
                said.append(called)
        if not outside and tag not in ("html", "body", *MAIN) or (tag == "article" and names & {"comment", "comments", "reply"}):
            outside = outside or (-1 if any(map(_hints, said)) else 0)
    return (tag + "".join("." + n for n in sorted(names)) if names else tag), outside


def _main(label: str) -> int | None:
    """The kind of a block that may be a main one: 0 article, 1 main, 2 named so."""
    tag, *names = label.split(".")
    if tag in MAIN:
        return MAIN.index(tag)
    return 2 if tag in ("div", "section", "td") and set(names) & MAIN_WORDS else None


def read(page: str | None) -> list[tuple[str, int, str, int]]:
    """The blocks of a page in order: (path, outside, text, characters in links).

    ``outside`` is 0 inside, -1 outside, or how much of the path names the outermost block that only its names put outside: the wrapper decides on it.
    """
    out: list[tuple[str, int, str, int]] = []
    stack: list[tuple[str, str, int, bool, int]] = [("", "", 0, False, 0)]  # tag, path, outside, within a main block, outside by itself
    known: dict[tuple[str, str, bool], tuple[str, int]] = {}
    held: list[str] = []
    links = link_chars = 0
    skipped, depth = "", 0
    page = page or ""
    closed: dict[int, bool] = {}  # by depth of an open block: whether the rest of the page closes it

    def flush():
        nonlocal link_chars
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                out.append((stack[-1][1], stack[-1][2], text, link_chars))
            held.clear()
        link_chars = 0

    def apart(k: int, at: int) -> bool:
        """Whether an open block that lies outside takes an article that starts at ``at`` with it."""
        tag = stack[k][0]
        if tag in OUTSIDE and tag not in APART:
            return False
        if k not in closed:
            ends, starts = (sum(1 for _ in re.finditer(rf"<{e}{tag}(?=[\s/>])", page[at:], re.I)) for e in ("/", ""))
            closed[k] = ends > starts + sum(block[0] == tag for block in stack[k + 1:])
        return closed[k]

    def close(k: int):
        for block in stack[k:]:
            opened[block[0]] -= 1
        del stack[k:]

    opened: Counter[str] = Counter()  # the tags of the open blocks
    tokens = _Tokens(page)
    for slash, tag, attributes, piece, start, end in tokens:
        if tag is None and not skipped:
            if piece:
                held.append(piece)
                if links:
                    link_chars += len(piece)
            continue
        tag = tag.lower() if tag else ""
        if tag in RAW:
            if not slash:
                flush()
                closing = _CLOSING[tag].search(page, end)
                tokens.at = closing.end() if closing else len(page)
            continue
        if skipped:
            if tag == skipped and not (tag in ("svg", "math") and attributes.endswith("/")):
                depth += -1 if slash else 1
                skipped = skipped if depth else ""
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if slash else 1
            elif tag == "br":
                held.append(" ")
            continue
        if tag in SKIPPED:  # one that is never closed holds nothing
            flush()
            if not slash and not (tag in ("svg", "math") and attributes.endswith("/")) and tokens.closes(tag, end):
                skipped, depth = tag, 1
            continue
        flush()
        if slash:
            if opened[tag]:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag))
            continue
        if tag in VOID:
            continue
        if tag in MAIN and stack[-1][2]:  # an article starts outside what was left open before it, and outside forms
            first = next(k for k, block in enumerate(stack) if block[2])
            if not any(apart(k, start) for k in range(first, len(stack)) if stack[k][4]):
                close(first)
        closes = ENDS.get(tag, {"p"}) | (HEADINGS if tag in HEADINGS else set())
        if any(opened[t] for t in closes):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in closes:
                    close(k)
                elif stack[k][0] in SCOPE:
                    break
        _, path, above, within, _ = stack[-1]
        key = (tag, attributes, within)
        if key not in known:
            known[key] = _label(tag, attributes, within)
        label, own = known[key]
        if tag == "header" and within and "hidden" not in label:
            own = 0  # its headings are the article's; see rules()
        if len(stack) <= DEPTH:
            path = f"{path}>{label}"
        outside = -1 if above == -1 or own == 1 else above or (len(path) if own else 0)
        closed.pop(len(stack), None)
        opened[tag] += 1
        stack.append((tag, path, outside, within or _main(label) is not None, own))
    flush()
    return out


# --- wrappers: {"n": pages, "p": {path: slot}, "s": sequences} --------------------------
# A slot: [pages that have it, most occurrences in a page, the constant text or None, characters, characters in links, outside].
# "s": the order of the children of each path, a list of groups; a group of several members is repeated.


def fold(blocks: list[tuple[str, int, str, int]]) -> dict:
    """The wrapper of one page: repeats are folded, a repeated text is a slot."""
    slots: dict[str, list] = {}
    order: dict[str, list[list[str]]] = {}
    for path, outside, text, links in blocks:
        slot = slots.get(path)
        if slot is None:
            slots[path] = [1, 1, text, len(text), links, outside]
        else:
            slot[1] += 1
            slot[2] = slot[2] if slot[2] == text else None
            slot[3] += len(text)
            slot[4] += links
        # the chain of blocks down to this one takes its place in the sequence of each parent
        at = 0
        while (to := path.find(">", at + 1)) >= 0 or at < len(path):
            to = to if to >= 0 else len(path)
            _place(order.setdefault(path[:at], []), path[at + 1:to])
            at = to
    return {"n": 1, "p": slots, "s": order}


def _place(groups: list[list[str]], label: str) -> None:
    """The next block of a sequence: a new group, or all groups from the one that holds it on become one."""
    for k, members in enumerate(groups):
        if label in members:
            if k < len(groups) - 1:
                groups[k:] = [sorted(set().union(*groups[k:]))]
            return
    groups.append([label])


def _align_order(a: list[list[str]], b: list[list[str]]) -> list[list[str]]:
    """Two sequences as one: blocks of only one side go between their neighbours, crossing ones become a group."""
    out = [list(g) for g in a]
    last = -1
    for members in b:
        at = [k for k, g in enumerate(out) if set(g) & set(members)]
        if not at:
            out.insert(last + 1, list(members))
            last += 1
            continue
        lo, hi = min(*at, max(last, 0)) if min(at) < last else min(at), max(*at, last)
        if lo < hi or len(members) > 1:
            out[lo:hi + 1] = [sorted(set().union(members, *out[lo:hi + 1]))]
        last = lo
    return out


def align(a: dict, b: dict) -> dict:
    """Two wrappers of a host as one."""
    for path, y in b["p"].items():
        x = a["p"].get(path)
        a["p"][path] = y if x is None else [x[0] + y[0], max(x[1], y[1]), x[2] if x[2] == y[2] else None, x[3] + y[3], x[4] + y[4], x[5]]
    for path, groups in b["s"].items():
        mine = a["s"].get(path)
        if mine != groups:
            a["s"][path] = groups if mine is None else _align_order(mine, groups)
    a["n"] += b["n"]
    return a


def expression(wrapper: dict) -> str:
    """The wrapper as a union-free regular expression: ``#`` is a text slot, ``?`` optional, ``+`` repeated."""
    def write(path: str) -> str:
        out = []
        slot = wrapper["p"].get(path)
        if slot:
            text = "#" if slot[2] is None else entities.escape(slot[2], quote=False)
            out.append(text if slot[0] == pages.get(path, 0) else f"({text})?")
        for group in wrapper["s"].get(path, []):
            inner = []
            for label in group:
                child = f"{path}>{label}"
                one = f"<{label}>{write(child)}</{label}>"
                again = len(group) == 1 and (s := wrapper["p"].get(child)) is not None and s[1] > 1
                few = len(group) > 1 or pages.get(child, 0) < pages.get(path, wrapper["n"])
                inner.append(f"({one})" + ("*" if again and few else "+" if again else "?") if again or few else one)
            out.append("(" + "".join(inner) + ")+" if len(group) > 1 else inner[0])
        return "".join(out)

    pages: dict[str, int] = {"": wrapper["n"]}
    for path, slot in wrapper["p"].items():
        at = path
        while at:
            pages[at] = max(pages.get(at, 0), slot[0])
            at = at.rpartition(">")[0]
    return write("")


def _regions(wrapper: dict) -> list[dict[str, int]]:
    """The main blocks (path: 0 for one that holds others of a better kind, else 1) by the block they stand in."""
    every = {path[:i] for path in wrapper["p"] for i in [*[m.start() for m in re.finditer(">", path)][1:], len(path)]}
    kinds = {path: kind for path in every if (kind := _main(path.rpartition(">")[2])) is not None}
    wide = {path for path, kind in kinds.items() if any(kinds[p] < kind for p in _below(kinds, path))}
    out: dict[str, dict[str, int]] = {}
    for path in sorted(kinds):
        above = [path[:m.start()] for m in re.finditer(">", path)]
        if path in wide or all(p not in kinds or p in wide for p in above):
            top = next((p for p in above if p in kinds), path)  # the outermost main block it lies in
            out.setdefault(top.rpartition(">")[0], {})[path] = int(path not in wide)
    return list(out.values())


def _below(paths, block: str) -> list[str]:
    return [p for p in paths if p == block or p.startswith(block + ">")]


def _inside(wrapper: dict) -> dict[str, list]:
    """The slots that lie inside: a name that hints at the outside counts where the wrapper confirms it.

    It does if the block holds template or links only, or if most pages that have it hold running text besides,
    in the same main block if it lies in one. A block that is itself named a main one must also hold less than that.
    """
    slots = {path: s for path, s in wrapper["p"].items() if s[5] != -1}
    plain = [p for p, s in slots.items() if s[5] == 0]

    def running(p):
        return slots[p][3] >= 2 * slots[p][4] and p.rpartition(">")[2].split(".")[0] not in HEADINGS

    out = {p: slots[p] for p in plain}
    for block in sorted({path[:s[5]] for path, s in slots.items() if s[5]}):
        held = _below((p for p, s in slots.items() if s[5] == len(block)), block)
        at = [i for i, c in enumerate(block) if c == ">"] + [len(block)]
        scope = next((block[:b] for a, b in zip(at, at[1:-1]) if _main(block[a + 1:b]) is not None), None)
        rest = [p for p in (plain if scope is None else _below(plain, scope)) if running(p)]
        own = [p for p in held if running(p) and not (slots[p][2] is not None and slots[p][0] > 1)]
        besides = max((slots[p][0] for p in rest), default=0) * 2 >= max((slots[p][0] for p in own), default=0)
        more = sum(slots[p][3] for p in rest) > sum(slots[p][3] for p in own)
        if own and not (besides and (more or _main(block.rpartition(">")[2]) is None)):
            out |= {p: slots[p] for p in held}
        elif scope and "header" in block.rpartition(">")[2].split("."):  # its headings are the article's
            out |= {p: slots[p] for p in held if p.rpartition(">")[2].split(".")[0] in HEADINGS}
    return out


def rules(wrapper: dict) -> list[list[str]]:
    """The slots of the main text: lists of paths, to be tried in order on a page.

    A region is all main blocks side by side. Regions are tried by the running text of their slots
    that vary on the host. Of a block that holds others of a better kind, besides those, only such slots are taken.
    Where more of that text stands in no region than in the best one, all such slots and the best region come first.
    """
    inside = _inside(wrapper)
    # running text: mostly not links, and not the same on all pages (a host of one text has no template)
    varied = any(s[2] is None for s in inside.values()) and wrapper["n"] > 1
    running = {p: s[3] - s[4] for p, s in inside.items() if 2 * s[4] <= s[3] and not (varied and s[2] is not None and s[0] > 1)}
    out = []
    for blocks in _regions(wrapper):
        own = set()
        for region, whole in blocks.items():
            held = _below(inside if whole else running, region)
            own.update(p for p in held if ">header" not in p[len(region):] or p.rpartition(">")[2].split(".")[0] in HEADINGS)
        if own:
            out.append((-sum(running.get(p, 0) for p in own), sorted(own)))
    out.sort()
    rest = sorted(running)
    named = {p for _, own in out for p in own}
    if out and varied and sum(n for p, n in running.items() if p not in named) > -out[0][0]:
        out.insert(0, (0, sorted({*out[0][1], *(p for p in running if p not in named)})))
    return [*[own for _, own in out], *([rest] if rest else [])]


def extract(page: str | None, tried: list[list[str]]) -> str:
    """The main text of a page by the rules of its host."""
    blocks = [(path, text) for path, outside, text, _ in read(page) if outside != -1]
    for paths in tried:
        allowed = set(paths)
        found = [text for path, text in blocks if path in allowed]
        if found:
            return "\n".join(found)
    return ""


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def infer(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper as JSON): one wrapper per host, aligned from all its pages."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: dict[str, dict] = {}
        for pdf in batches:
            for name, page in zip(pdf["host"], pdf["html"]):
                one = fold(read(page))
                made[name] = align(made[name], one) if name in made else one
                if len(made) >= HOSTS:
                    yield put(made)
                    made = {}
        if made:
            yield put(made)

    def put(made):
        return pd.DataFrame({"host": list(made), "wrapper": [json.dumps(w) for w in made.values()]})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for text in pdf["wrapper"]:
            whole = align(whole, json.loads(text)) if whole else json.loads(text)
        return pd.DataFrame({"host": pdf["host"].iloc[:1], "wrapper": [json.dumps(whole)]})

    rows = pages.select(host(pages[url_col]).alias("host"), pages[html_col].alias("html"))
    parts = cut(rows.mapInPandas(partial, "host string, wrapper string"), "wrappers")
    while (most := parts.groupBy("host").count().agg(F.max("count")).first()[0] or 1) > 1:
        salts = -(-most // FAN_IN)
        salt = F.pmod(F.xxhash64("wrapper"), F.lit(salts))
        parts = cut(parts.withColumn("salt", salt).groupBy("host", "salt").applyInPandas(merge, "host string, wrapper string"), "wrappers")
    return parts


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: (id_col, url, text, n_chars).

    The rules of a host are joined to its pages by host; Spark broadcasts
    them while they are below its threshold and otherwise sorts and merges, splitting hosts with very many pages.
    """
    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"name": pdf["host"], "rules": [json.dumps(rules(json.loads(w))) for w in pdf["wrapper"]]})

    @F.pandas_udf("string")
    def apply(htmls: pd.Series, tried: pd.Series) -> pd.Series:
        known: dict[str, list] = {}
        out = []
        for page, text in zip(htmls, tried):
            if text not in known:
                known[text] = json.loads(text)
            out.append(extract(page, known[text]))
        return pd.Series(out, dtype=object)

    decided = settled(pages.sparkSession, lambda: infer(pages, url_col, html_col).mapInPandas(decide, "name string, rules string"), "rules")
    rows = pages.select(pages[id_col].alias("id"), pages[url_col].alias("u"), pages[html_col].alias("html"), host(pages[url_col]).alias("host"))
    rows = rows.join(decided, F.col("host") == F.col("name")).withColumn("text", apply("html", "rules"))
    return rows.select(F.col("id").alias(id_col), F.col("u").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
