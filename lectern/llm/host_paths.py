"""Main text of web pages by the paths on which a host's pages agree.

1. Each page is parsed; the text of a block counts for the container it stands in, and half
   for the next one out; text in links counts against both. The best container of a page,
   widened to the article around it, votes, by its score, for its generalised path: the tags
   and classes from the root, digits as #.
2. Votes are added up per (host, path) in Spark; a host's winners are the path with most votes
   and all others with a SHARE of them, so hosts with several templates have a path for each.
3. Each page of the host is parsed again. The first winner whose elements hold a container that
   scores at least a CLEARLY-th of the page's best gives the text; if none does, or the host has no
   votes, the page's own best container does.

Of several elements on a path without a class those are left out that differ from the best one: few
words or none in paragraphs, many links, a copyright line.

Widening: the nearest article or main element around the best container if there is one, then
further out while what is added is text like an article's: a headline or paragraphs beside
the container, or sections beside it that hold paragraphs, and few links. A cell beside other
cells of a row that holds a headline or several paragraphs is layout: it is a container, and
widening ends there.

What is left out everywhere: scripts, styles and other parts without text, menus, headers,
footers, sidebars, notices, adverts, forms and reader comments, known by tag, role or
class. A form, class or id does not make noise of what holds the main element, the only visible
article or most of the page's text: many servers put a whole page into one form. Character references are decoded, white space within a block becomes one space,
blocks are joined by one space.

Parsing goes through a page once and never back: tags are matched without backtracking, and
how many elements of a tag are open is known, so its time and memory are in proportion to
the page however broken or deep it is.

Votes are combined per task before they are shuffled, so a host with a third of all pages
sends a row per task and path. The winners, a row per host with at most 1 / SHARE paths, are written
and measured: up to BROADCAST_HOSTS of them, with BROADCAST_BYTES of paths, are broadcast and no page
is shuffled; beyond, pages meet them in an equi-join, for which pages without a host and the pages of a host are salted.

Edge cases: null or empty html has empty text; a null url has no host. A page without any
markup is its own text. Unclosed and crossing tags are closed where the next block or the
parent's end comes; a tag or comment that the page's end cuts off is left out. A quote opens a
value only behind =, and only if it is closed. Repeated pages each get their row. Other
columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ._shared import materialise

#: Most hosts whose winners are broadcast, and most characters of their paths.
BROADCAST_HOSTS, BROADCAST_BYTES = 100_000, 16 << 20

#: Paths with this share of a host's votes are winners.
SHARE = 0.05

#: A container that scores more than so many times as much as a winner's is clearly better.
CLEARLY = 4

#: Salts over which the pages of a host are spread if they meet the winners in a join.
SALTS = 32

#: Attributes of a tag. Nothing is tried twice: a part once matched is not given up again.
_ATTRIBUTES = r"""(?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))?+|=)*+"""
_START = re.compile(rf"<([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})>")
_END = re.compile(r"</([a-zA-Z][^\s/>]*+)[^>]*+>")
_ATTRIBUTE = re.compile(r"""(=?[^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+)))?+""")
_UNQUOTED_END = re.compile(r"""=\s*+[^\s"'][^\s]*+$""")

#: Elements whose content is no markup; it is skipped up to their end tag.
RAW = frozenset("script style textarea title noscript iframe".split())
#: Elements that hold no readable text. One that is never closed hides nothing, but for options.
SKIPPED = frozenset("template select option object svg math canvas audio video head".split())
#: Elements left out with all they contain.
NOISE_TAGS = frozenset("nav header footer aside form button dialog menu".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: Words that mark an element as noise when a class or its id is one, ends in one ("left-sidebar"), or is one before a word of PARTS
#: ("sidebar-left"), unless it says how a page is laid out ("has-sidebar").
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget related recommended "
    "footer header masthead comment comments commentlist disqus reply replies notice alert cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social toolbar pagination pager form search skip".split()
)
PARTS = frozenset(
    "area bar block body bottom box button buttons column container content count field form group header heading icons inner input item items left link links list main meta panel posts "
    "primary region right secondary section slot title top unit widget wrap wrapper".split()
)
STATES = frozenset("has have with without no is not show hide".split())
#: Readers' words are noise however long they are.
REPLIES = frozenset("comment comments commentlist disqus reply replies".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not end a line.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var wbr img object svg math canvas audio video select".split())
#: Blocks whose text counts for the element around them.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th tr tbody thead table ul ol dl figure figcaption caption address summary".split())
#: A start tag of a block ends an open one of these.
_CLOSES = frozenset("p li dt dd tr td th option".split())
#: These end each other as well.
_PAIRS = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I) for name in RAW}
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
_SPLIT = re.compile(r"[^a-z]+")
_HEADING = re.compile("h[1-6]")
_LEGAL = re.compile(r"\s*(?:©|&copy;|\(c\)\s|copyright\b|all rights reserved)", re.I)
#: Why an element is noise.
NONE, NAMED, REPLY, SURE = 0, 1, 2, 3
_traits: dict[tuple[str, str], tuple[str, int, bool]] = {}


def _noise_word(name: str) -> str:
    """The word for which a class or id is noise, or nothing."""
    words = [w for w in _SPLIT.split(re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if w]
    if not words or words[0] in STATES:
        return ""
    if words[-1] in NOISE_WORDS:
        return words[-1]
    return words[0] if words[0] in NOISE_WORDS and all(w in PARTS or w in NOISE_WORDS for w in words[1:]) else ""


def _trait(tag: str, attributes: str) -> tuple[str, int, bool]:
    """(step of the path, why it is noise, whether the tag closes itself) of an element; remembered, as pages repeat them."""
    got = _traits.get((tag, attributes))
    if got is None:
        found: dict[str, str] = {}
        for m in _ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
        classes = found.get("class", "").lower().split()
        names = found.get("class", "").split()
        if "id" in found and not (tag == "section" or _HEADING.fullmatch(tag)):  # the ids of these are made of their headings
            names.append(found["id"])
        words = set(map(_noise_word, names)) - {""}
        hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        if tag in NOISE_TAGS and tag != "form" or tag in SKIPPED or hidden or found.get("role", "").lower() in NOISE_ROLES:
            noise = SURE
        elif tag in ("html", "body", "main", "article"):
            noise = REPLY if "comment" in words else NONE
        else:
            noise = REPLY if words & REPLIES else NAMED if words or tag == "form" else NONE
        step = ".".join([tag, *sorted({re.sub(r"\d+", "#", c) for c in classes})])
        if len(_traits) > 50_000:
            _traits.clear()
        got = step, noise, attributes.endswith("/") and not _UNQUOTED_END.search(attributes)
        if len(attributes) <= 1000:
            _traits[tag, attributes] = got
    return got


class Page:
    """The elements and text blocks of a page.

    Element 0 is the page itself. parent, tag, path, box and noise are lists by element: path
    is a number that elements with equal paths share (steps tells, for each, the one above and
    the last step), box the container that text directly in the element counts for; texts
    has (innermost element, container, text, whether a new line starts before it, in a link).
    """

    def __init__(self, html: str):
        self.parent, self.tag, self.path, self.box, self.noise = [0], [""], [0], [0], [False]
        self.steps: list[tuple[int, str]] = [(0, "")]
        self.numbers: dict[tuple[int, str], int] = {}
        self.texts: list[tuple[int, int, str, bool, bool]] = []
        parent, tags, path, box, texts = self.parent, self.tag, self.path, self.box, self.texts
        why, closed, depth_of = [NONE], [True], [0]
        stack, blocks, opened = [0], [0], {}  # open elements, those of them that are no inline ones, and how many by tag
        links, new_line = 0, True
        ended: set[str] = set()  # raw elements of which no end tag is left

        def pop_to(depth: int) -> None:
            nonlocal links, new_line
            for e in stack[depth:]:
                opened[tags[e]] -= 1
                links -= tags[e] == "a"
            del stack[depth:]
            while depth_of[blocks[-1]] >= depth:
                blocks.pop()
                new_line = True

        def text(start: int, stop: int) -> None:
            nonlocal new_line
            if stop > start:
                texts.append((stack[-1], box[blocks[-1]], html[start:stop], new_line, links > 0))
                new_line = False

        at, done, n = 0, 0, len(html)  # done: the text before it is stored
        while at < n:
            at = html.find("<", at)
            if at < 0 or at + 1 == n:
                break
            c = html[at + 1]
            if c in "!?":
                text(done, at)
                if html.startswith("<!--", at):
                    stop = html.find("-->", at + 2)  # <!--> is a whole comment
                    done = at = stop + 3 if stop >= 0 else n
                else:
                    stop = html.find(">", at)
                    done = at = stop + 1 if stop >= 0 else n
                continue
            if c == "/":
                m = _END.match(html, at)
                if not m:
                    stop = html.find(">", at)
                    if stop < 0 and not re.match("[A-Za-z]", html[at + 2 : at + 3]):
                        break  # no tag, nor is one behind it
                    text(done, at)
                    done = at = stop + 1 if stop >= 0 else n
                    continue
                text(done, at)
                done = at = m.end()
                name = m[1].lower()
                if opened.get(name):
                    depth = len(stack) - 1
                    while tags[stack[depth]] != name:
                        depth -= 1
                    closed[stack[depth]] = True
                    pop_to(depth)
                else:
                    new_line = new_line or name not in INLINE
                continue
            if not (c.isascii() and c.isalpha()):
                at += 1
                continue
            m = _START.match(html, at)
            text(done, at)
            if not m:
                done = at = n  # cut off
                continue
            done = at = m.end()
            name = m[1].lower()
            if name in RAW:
                if name not in ended:
                    end = _RAW_END[name].search(html, at)
                    if end:
                        done = at = end.end()
                    else:
                        ended.add(name)
                        done = at = n if name in ("script", "style") else at
                continue
            if name in VOID:
                new_line = new_line or name not in INLINE
                continue
            if name == "body" and opened.get("head"):
                pop_to(depth_of[next(e for e in blocks if tags[e] == "head")])
            if name in _ENDS_P and opened.get("p") or opened.get(name) and name in _CLOSES or name in _PAIRS:
                k = len(blocks) - 1
                while k > 0:
                    above = tags[blocks[k]]
                    if above == "p" and name in _ENDS_P or above == name and name in _CLOSES or above in _PAIRS.get(name, ()):
                        closed[blocks[k]] = True
                        pop_to(depth_of[blocks[k]])
                        break
                    if above != "p":
                        break
                    k -= 1
            step, noise, alone = _trait(name, m[2])
            up, e = stack[-1], len(parent)
            parent.append(up)
            tags.append(name)
            why.append(noise)
            if name in INLINE:
                path.append(path[up])
                box.append(box[blocks[-1]])
            else:
                key = path[up], step
                number = self.numbers.get(key)
                if number is None:
                    number = self.numbers[key] = len(self.steps)
                    self.steps.append(key)
                path.append(number)
                box.append(box[up] if name in LEAVES else e)
                new_line = True
            depth_of.append(len(stack))
            closed.append(alone)
            if not alone:
                stack.append(e)
                opened[name] = opened.get(name, 0) + 1
                links += name == "a"
                if name not in INLINE:
                    blocks.append(e)
        text(done, n)
        for e in range(1, len(why)):
            if why[e] == SURE and tags[e] in SKIPPED and tags[e] != "option" and not closed[e]:
                why[e] = NONE
        self._cells()
        self._mark(why)

    def _cells(self) -> None:
        """Makes containers of the cells that lay out the page."""
        parent, tags, box, n = self.parent, self.tag, self.box, len(self.parent)
        self.layout: set[int] = set()
        if "td" not in tags:
            return
        cell, cells, heads, paragraphs = [0] * n, [0] * n, [0] * n, [0] * n
        for e in range(1, n):
            cell[e] = e if tags[e] == "td" else cell[parent[e]]
            cells[parent[e]] += tags[e] == "td"
            heads[cell[e]] += tags[e] in ("h1", "h2")
            paragraphs[cell[e]] += tags[e] == "p"
        self.layout = {e for e in range(1, n) if tags[e] == "td" and cells[parent[e]] > 1 and (heads[e] or paragraphs[e] > 1)}
        if self.layout:
            for e in range(1, n):
                if e in self.layout:
                    box[e] = e
                elif tags[e] in LEAVES or tags[e] in INLINE:
                    box[e] = box[parent[e]]
            self.texts = [(inner, box[inner], *rest) for inner, _, *rest in self.texts]

    def spelled(self, element: int) -> str:
        """The path of an element, its steps joined by >."""
        out, number = [], self.path[element]
        while number:
            number, step = self.steps[number]
            out.append(step)
        return ">".join(reversed(out))

    def on_path(self, path: str) -> set[int]:
        """The elements with this path."""
        number = 0
        for step in path.split(">"):
            number = self.numbers.get((number, step), -1)
        return {e for e, x in enumerate(self.path) if x == number and self.tag[e] not in INLINE} if number > 0 else set()

    def _mark(self, why: list[int]) -> None:
        """Sets noise. A name makes no noise of what holds most of the page's text, or its main element or only visible article."""
        parent, tags, n = self.parent, self.tag, len(self.parent)
        if NAMED in why or REPLY in why:
            sure = [False] * n
            for e in range(1, n):
                sure[e] = why[e] == SURE or sure[parent[e]]
            size = [0] * n
            for inner, _, text, _, link in self.texts:
                if not link and not sure[inner]:
                    size[inner] += len(text.strip())
            for e in range(n - 1, 0, -1):
                size[parent[e]] += size[e]
            hosts = [tags[e] in ("main", "article") and not sure[e] and why[e] == NONE and size[e] > 0 for e in range(n)]
            holds, inside = hosts[:], hosts[:]
            for e in range(n - 1, 0, -1):
                holds[parent[e]] |= holds[e]
            for e in range(1, n):
                inside[e] |= inside[parent[e]]
                if why[e] == NAMED and 2 * size[e] > size[0] and (inside[e] or holds[e] or not holds[0]):  # a long advert beside a short article stays one
                    why[e] = NONE
            named = [False] * n
            for e in range(1, n):
                named[e] = why[e] in (NAMED, REPLY) or named[parent[e]]
            anchors = [e for e in range(1, n) if tags[e] == "main" and not sure[e]]
            articles = [e for e in range(1, n) if tags[e] == "article" and not sure[e] and why[e] == NONE]
            if not anchors and articles and all(named[e] for e in articles):
                anchors = [max(articles, key=size.__getitem__)]
            seen = [False] * n
            for e in anchors:
                while e and not seen[e]:
                    seen[e] = True
                    why[e], e = (why[e] if why[e] == SURE else NONE), parent[e]
        self.noise = [False] * n
        for e in range(1, n):
            self.noise[e] = why[e] > NONE or self.noise[parent[e]]

    def scores(self) -> dict[int, int]:
        """By container, twice the characters of its blocks and once those of the next level, less text in links."""
        out: dict[int, int] = {}
        for inner, box, text, _, link in self.texts:
            if self.noise[inner]:
                continue
            n = len(text.strip())
            if not n:
                continue
            n = -n if link else n
            out[box] = out.get(box, 0) + 2 * n
            if box:
                out[self.parent[box]] = out.get(self.parent[box], 0) + n
        return out

    def best(self) -> tuple[int, int]:
        """(container, score); of equal ones the innermost. The container is widened to the article around it."""
        score, box = max(((s, e) for e, s in self.scores().items()), default=(0, 0))
        return (self._widened(box) if box else box), score

    def _widened(self, box: int) -> int:
        parent, tags, n = self.parent, self.tag, len(self.parent)
        own, size, links, prose = [0] * n, [0] * n, [0] * n, [False] * n  # characters: in the container itself, in all of it, of them in links; holds paragraphs
        head, headed = [False] * n, [False] * n  # within a headline; a container with a headline of its own
        for e in range(1, n):
            head[e] = tags[e] in ("h1", "h2") or tags[e] in INLINE and head[parent[e]]
        for inner, b, text, _, link in self.texts:
            if not self.noise[inner] and (k := len(text.strip())):
                size[b] += k
                links[b] += k * link
                own[b] += k * (not link)
                prose[b] = prose[b] or not link and inner != b
                headed[b] = headed[b] or head[inner]
        for e in range(n - 1, 0, -1):
            size[parent[e]] += size[e]
            links[parent[e]] += links[e]
            prose[parent[e]] |= prose[e]
        beside: dict[int, list[int]] = {0: []}
        up, e = box, box
        while e:
            beside[e] = []
            if tags[e] in ("article", "main") and (tags[up] not in ("article", "main")):
                up = e
            e = parent[e]
        for e in range(1, n):
            if parent[e] in beside and size[e]:
                beside[parent[e]].append(e)
        e = up
        while e and tags[parent[e]] != "html" and not self.noise[parent[e]]:
            p = parent[e]
            if e in self.layout:
                break
            more, linked = size[p] - size[e], links[p] - links[e]
            others = [x for x in beside[p] if x != e and tags[x] not in LEAVES and tags[x] not in INLINE]
            like = bool(others) and tags[p] not in ("", "body", "main") and all(prose[x] and 3 * links[x] <= size[x] for x in others)
            if more and (3 * linked > more or not (headed[p] if tags[p] in ("", "body") else own[p] or like)):
                break
            if more:
                up = p
            e = p
        return up

    def peaks(self) -> list[int]:
        """For each element the highest score of a container in it, itself included."""
        out = [0] * len(self.parent)
        for e, score in self.scores().items():
            out[e] = max(score, 0)
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] = max(out[self.parent[e]], out[e])
        return out

    def alike(self, boxes: set[int], peaks: list[int]) -> set[int]:
        """Those of the elements on one path that are like the best of them; all, if their class or tag says that they are."""
        first = min(boxes)
        if len(boxes) == 1 or "." in self.steps[self.path[first]][1] or self.tag[first] in ("article", "main"):
            return boxes
        n = len(self.parent)
        size, links, prose, legal, begun = [0] * n, [0] * n, [False] * n, [False] * n, [False] * n
        within, leaf = [0] * n, [False] * n  # the innermost of them around an element; whether a paragraph or the like stands between
        for e in range(1, n):
            within[e] = e if e in boxes else within[self.parent[e]]
            leaf[e] = e not in boxes and (self.tag[e] in LEAVES or leaf[self.parent[e]])
        for inner, _, text, _, link in self.texts:
            if not self.noise[inner] and (k := len(text.strip())) and (e := within[inner]):
                size[e] += k
                links[e] += k * link
                prose[e] |= not link and leaf[inner]
                legal[e] |= not begun[e] and bool(_LEGAL.match(text))
                begun[e] = True
        top = max(boxes, key=lambda e: (peaks[e], -e))
        return {e for e in boxes if e == top or size[e] and 3 * links[e] <= size[e] and not legal[e] and (prose[e] or 4 * size[e] >= size[top])}

    def text_of(self, boxes: set[int]) -> str:
        """The text of what stands in any of these elements."""
        inside = [0 in boxes] * len(self.parent)
        for e in range(1, len(inside)):
            inside[e] = e in boxes or inside[self.parent[e]]
        parts = []
        for inner, _, text, new_line, _ in self.texts:
            if new_line:
                parts.append(" ")  # also after what is left out
            if inside[inner] and not self.noise[inner]:
                parts.append(entities.unescape(text) if "&" in text else text)
        return " ".join("".join(parts).split())


def extract(html: str | None, winners: Sequence[str]) -> str:
    """The main text of a page, given its host's paths, that with most votes first."""
    if not html:
        return ""
    page = Page(html)
    if winners:
        peaks = page.peaks()
        for path in winners:
            boxes = page.on_path(path)
            if boxes and peaks[0] <= CLEARLY * max(peaks[e] for e in boxes) and (text := page.text_of(page.alike(boxes, peaks))):
                return text
    box = page.best()[0]
    return page.text_of(page.on_path(page.spelled(box)) if page.tag[box] == "article" else {box})  # as with a host, all articles alike


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, or null."""
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(host, F.lit(""))


def vote(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, paths): the path with most votes of each host and all others with a SHARE of them, most votes first; of ties the one that sorts last."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: dict[tuple[str, str], int] = {}
            for host, html in zip(batch["host"], batch["html"]):
                page = Page(html)
                box, score = page.best()
                if score > 0:
                    path = page.spelled(box)
                    rows[host, path] = rows.get((host, path), 0) + score
            yield pd.DataFrame([(*k, v) for k, v in rows.items()], columns=["host", "path", "votes"])

    known = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).where("host IS NOT NULL AND html IS NOT NULL AND html <> ''")
    votes = materialise(known.mapInPandas(run, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes")), "votes")
    hosts = materialise(votes.groupBy("host").agg(F.sum("votes").alias("all"), F.max(F.struct("votes", "path"))["path"].alias("top")), "hosts")
    few = F.broadcast(hosts) if hosts.count() <= BROADCAST_HOSTS and _characters(hosts, "top") <= BROADCAST_BYTES else hosts
    won = votes.join(few, "host").where((F.col("votes") >= F.lit(SHARE) * F.col("all")) | (F.col("path") == F.col("top")))
    return won.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("votes", "path")), asc=False)["path"].alias("paths"))  # 1 / SHARE + 1 at most


def _characters(rows: DataFrame, paths: str) -> int:
    return rows.agg(F.sum(F.length(paths))).first()[0] or 0


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars of each page."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = [extract(h, () if p is None else tuple(p)) for h, p in zip(batch["html"], batch["paths"])]
            yield pd.DataFrame({id_col: batch["key"].values, url_col: batch["url"].values, "text": text, "n_chars": [len(t) for t in text]})

    rows = pages.select(F.col(id_col).cast("string").alias("key"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    winners = materialise(vote(pages, url_col, html_col), "winners")
    if winners.count() <= BROADCAST_HOSTS and _characters(winners.select(F.array_join("paths", "").alias("p")), "p") <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(winners), "host", "left")
    else:  # pages without a host and those of a large one are spread over the salts
        salted = rows.withColumn("salt", F.when(F.col("host").isNull(), None).otherwise(F.pmod(F.xxhash64("key"), F.lit(SALTS))).cast("int"))
        spread = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.where("host IS NOT NULL").join(spread, ["host", "salt"], "left").unionByName(salted.where("host IS NULL").withColumn("paths", F.lit(None).cast("array<string>")))
    joined = joined.select("key", "url", "html", "paths")
    return joined.mapInPandas(run, f"`{id_col}` string, `{url_col}` string, text string, n_chars long").withColumn(id_col, F.col(f"`{id_col}`").cast(kind))
