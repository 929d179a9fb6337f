"""Main text of web pages by scoring the element tree."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.llm.common import ddl, map_frames
from goldseam.llm.pieces import batches_of
from goldseam.llm.registry import query
from goldseam.workloads.registry import table

# Comments and raw elements, tags with quoted attributes, any other mark-up, a cut-off tag.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|title)\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>=]|=(?!\s*[\"']))*+)>"
    r"|<[a-z/!?][^>]*+(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTR = re.compile(r"""(?<![a-z-])([a-z-]++)\s*+=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle mpadded mphantom mover munder munderover "
    "msub msup msubsup mmultiscripts mprescripts semantics annotation annotation-xml".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag ends these open elements, up to the nearest of their containers.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
PARAGRAPHS = {"p", "pre", "td", "blockquote", "li", "dd"}
PROSE = {"p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6"}
DROPPED = set(
    "nav footer aside button select option input dialog menu head script style noscript template "
    "iframe svg datalist audio video canvas map annotation annotation-xml".split()
)
#: Often small, but some pages stand in one as a whole.
FORMS = {"form", "fieldset"}
#: Words in class, id or role that mark menus, notices, adverts, reader comments and the like.
SIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar "
    "nav navbar navigation menu breadcrumb breadcrumbs footer header masthead comment comments reply "
    "replies respond disqus cookie cookies consent gdpr notice alert popup modal overlay share sharing "
    "social related recommended newsletter subscribe subscription signup login search form widget "
    "toolbar pager pagination skip hidden outbrain taboola copyright contentinfo complementary".split()
)
#: Side words that also name the layout of a page in the class of its wrapper.
LAYOUT_WORDS = set(
    "banner sidebar nav navbar navigation menu header footer masthead notice alert modal overlay share "
    "sharing social login search form widget toolbar skip copyright".split()
)
#: Before a side word: the wrapper has or lacks such a part.
STATES = {"has", "have", "no", "with", "without"}
MAIN_WORDS = set("article content main body post entry story text".split())
WHOLE = {"article", "main"}
#: A marked element stays if it holds at least half of the text around it and the rest, outside all
#: marked elements, is less than this share: for layout words and forms, for other words.
REST_BESIDE_LAYOUT, REST_BESIDE_OTHER = 0.2, 0.02
#: Text beside the best element belongs to it while less than this share of it is linked.
LINKED_MOST = 0.3
#: From the third element above a paragraph on, each passes on this share of the points.
PASSED_ON = 2 / 3
_ZEROS, _HUGE = re.compile(r"&#0++(?=\d)"), re.compile(r"&#[1-9]\d{7,}+;?")


def unescape(text: str) -> str:
    """Character references decoded; a number beyond all code points, of any length, is U+FFFD."""
    if "&#" in text:
        text = _HUGE.sub("\ufffd", _ZEROS.sub("&#", text))
    return html.unescape(text)


class OpenElements:
    """The open elements in order, with the places of each tag, so that no end tag walks the stack."""

    def __init__(self) -> None:
        self.nodes, self.names = [0], ["root"]
        self.places: dict[str, list[int]] = {}
        self.blocks = [0]

    def push(self, node: int, tag: str) -> None:
        self.places.setdefault(tag, []).append(len(self.nodes))
        if tag not in INLINE:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)
        self.names.append(tag)

    def cut(self, place: int) -> None:
        """Close the element at a place and all within it."""
        for tag in self.names[place:]:
            self.places[tag].pop()
        while self.blocks[-1] >= place:
            self.blocks.pop()
        del self.nodes[place:], self.names[place:]

    def last(self, tag: str) -> int:
        """Place of the innermost open element of a tag, 0 for none."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def close(self, tag: str) -> None:
        place = self.last(tag)
        # An inline end tag never closes a block.
        if place and (tag not in INLINE or place > self.blocks[-1]):
            self.cut(place)

    def make_room(self, tag: str) -> None:
        """Close what an opening block ends: a paragraph, an item of the same list and so on."""
        if tag not in ENDS:
            if self.names[self.blocks[-1]] == "p":
                self.cut(self.blocks[-1])
            return
        ended, borders = ENDS[tag]
        border = max(map(self.last, borders))
        place = max(map(self.last, ended))
        if place < border or not place:
            inner = self.places.get("p", [])
            first = bisect_right(inner, border)
            place = inner[first] if first < len(inner) else 0
        if place:
            self.cut(place)


class Page:
    """Elements as parallel lists (a parent stands before its children), and texts in page order."""

    def __init__(self, source: str):
        self.tags, self.parents, self.side = ["root"], [-1], [False]
        self.link, self.named, self.inside = [False], [False], [False]
        #: Elements that may be side matter, by their marks: the share that may lie beside them.
        self.marked: dict[int, float] = {}
        self.events: list[tuple[int, str | None]] = []
        self._read(source)
        if self.marked:
            self._settle()

    def _open(self, tag: str, attrs: str, parent: int) -> int:
        side, named, rest = self.side[parent], False, None
        if not side:
            side = tag in DROPPED or (tag == "header" and not self.inside[parent])
            if tag in FORMS:
                rest = REST_BESIDE_LAYOUT
            if attrs and tag not in ("html", "body"):
                words, named, hidden = self._words(attrs)
                side = side or hidden
                if words and not named and tag not in WHOLE:
                    rest = REST_BESIDE_LAYOUT if words <= LAYOUT_WORDS else REST_BESIDE_OTHER
        self.tags.append(tag)
        self.parents.append(parent)
        self.side.append(side)
        self.link.append(self.link[parent] or tag == "a")
        self.named.append(named)
        self.inside.append(self.inside[parent] or tag in WHOLE)
        if rest is not None and not side:
            self.marked[len(self.tags) - 1] = rest
        return len(self.tags) - 1

    @staticmethod
    def _words(attrs: str) -> tuple[set[str], bool, bool]:
        """Side words, whether a name ends in a main word, and whether the element is hidden.

        In each name the last known word decides: ``post-comments`` are comments.
        """
        sides: set[str] = set()
        named = False
        hidden = bool(re.search(r"(?:^|\s)hidden(?=[\s/]|$)", attrs, re.IGNORECASE))
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id", "role"):
                for part in value.split():
                    last, before = None, ""
                    for word in map(str.lower, _WORD.findall(part)):
                        if word in MAIN_WORDS or (word in SIDE_WORDS and before not in STATES):
                            last = word
                        before = word
                    if last in MAIN_WORDS:
                        named = True
                    elif last:
                        sides.add(last)
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
                hidden = True
            elif name == "aria-hidden" and value.lower() == "true":
                hidden = True
        return sides, named, hidden

    def _settle(self) -> None:
        """Decide which marked elements are side matter, outer ones first.

        One stays if it wraps the page's main element, or, by its layout words, the only articles,
        or nearly all unlinked text around it; all others are dropped as a whole.
        """
        n = len(self.tags)
        text, around, mark, whole, main, direct = ([0] * n for _ in range(6))
        for node, piece in self.events:
            if piece and not self.side[node] and not self.link[node]:
                text[node] += len(piece.strip())
        # The nearest marked element or article, and the nearest marked element, with the own one.
        for node in range(1, n):
            up, held = self.parents[node], node in self.marked
            around[node] = node if held or self.tags[node] in WHOLE else around[up]
            mark[node] = node if held else mark[up]
            if self.tags[node] in WHOLE and not self.side[node]:
                direct[mark[node]] += 1
        for node in range(n - 1, 0, -1):
            up = self.parents[node]
            if not self.side[node]:
                whole[node] += self.tags[node] in WHOLE
                main[node] += self.tags[node] == "main"
            # Articles in the elements of other words, such as comments, are no evidence.
            if self.marked.get(node) != REST_BESIDE_OTHER:
                whole[up] += whole[node]
            main[up] += main[node]
            text[up] += text[node]
        beside = text[:]
        for node in self.marked:
            beside[around[self.parents[node]]] -= text[node]
        # Whether an article lies free, or in a marked element that stays.
        free = {0: direct[0] > 0}
        for node in range(1, n):
            up = self.parents[node]
            self.side[node] |= self.side[up]
            rest = self.marked.get(node)
            if rest is None or self.side[node]:
                continue
            known, space = free[mark[up]], around[up]
            wraps = not known and (main[node] or (whole[node] and rest == REST_BESIDE_LAYOUT))
            most = 2 * text[node] >= text[space] and beside[space] < rest * text[space]
            self.side[node] = not (wraps or most)
            free[node] = known or direct[node] > 0

    def _read(self, source: str) -> None:
        stack, at, events = OpenElements(), 0, self.events
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                events.append((stack.nodes[-1], source[at : m.start()]))
            at = m.end()
            tag = m["tag"]
            if not tag:
                if m["raw"]:
                    events.append((stack.nodes[-1], None))
                continue
            tag = tag.lower()
            inline = tag in INLINE
            if not inline:
                events.append((stack.nodes[-1], None))
            if m["close"]:
                stack.close(tag)
                continue
            if tag in VOID:
                continue
            if not inline:
                stack.make_room(tag)
            node = self._open(tag, m["attrs"], stack.nodes[-1])
            if not m["attrs"].endswith("/") or tag in ("a", "p", "div", "span"):
                stack.push(node, tag)
        if at < len(source):
            events.append((stack.nodes[-1], source[at:]))

    def blocks(self, chosen: set[int]) -> list[str]:
        """Texts of the blocks below the chosen elements, without side matter."""
        inside = [False] * len(self.tags)
        for node in range(len(self.tags)):
            inside[node] = node in chosen or (node > 0 and inside[self.parents[node]])
        out, run = [], []
        for node, text in [*self.events, (0, None)]:
            if text is None:
                if run:
                    out.append(" ".join(unescape("".join(run)).split()))
                    run = []
            elif inside[node] and not self.side[node]:
                run.append(text)
        return [b for b in out if b]

    def main(self) -> set[int]:
        """The element with the best score and those of its siblings that belong to the text.

        Each paragraph gives a point, one for each comma and one for each 100 characters (three at
        most), to its parent, half to the next element and a shrinking share to those above. An
        element's points are reduced by the share of its text that lies in links.
        """
        n = len(self.tags)
        length, linked = [0] * n, [0] * n
        # Points from paragraphs that the element holds, from the next level, and from further down.
        own, next_down, far = [0.0] * n, [0.0] * n, [0.0] * n
        held_by = list(range(n))
        for node in range(1, n):
            if self.tags[node] in INLINE and self.parents[node] > 0:
                held_by[node] = held_by[self.parents[node]]
        paragraphs: dict[int, list] = {}
        for node, text in self.events:
            if text is None or self.side[node] or not text.strip():
                continue
            size = len(text.strip())
            length[node] += size
            if self.link[node]:
                linked[node] += size
            entry = paragraphs.setdefault(held_by[node], [0, 0])
            entry[0] += size
            entry[1] += text.count(",")
        for node in range(n - 1, 0, -1):
            length[self.parents[node]] += length[node]
            linked[self.parents[node]] += linked[node]
        for block, (size, commas) in paragraphs.items():
            given = (1 + commas + min(size / 100, 3)) * (1 - linked[block] / max(1, length[block]))
            up = self.parents[block] if self.tags[block] in PARAGRAPHS or self.tags[block][:1] == "h" else block
            own[up] += given
        for node in range(n - 1, 0, -1):
            up = self.parents[node]
            far[up] += next_down[node] / 6 + far[node] * PASSED_ON
            next_down[up] += own[node]
        points = [a + b / 2 + c for a, b, c in zip(own, next_down, far)]
        score = [
            p * (1 - k / s) * (1.5 if t in WHOLE else 1.25 if m else 1) if s else 0.0
            for p, k, s, t, m in zip(points, linked, length, self.tags, self.named)
        ]
        best = max(range(n), key=lambda i: (score[i], i), default=0)
        if score[best] <= 0:
            return {0}
        above, whole = best, False
        while above > 0:
            if self.tags[above] in WHOLE:
                best, whole = above, True
                break
            above = self.parents[above]
        chosen = {best}
        children: dict[int, list[int]] = {}
        for node in range(1, n):
            if length[node]:
                children.setdefault(self.parents[node], []).append(node)
        for node in children.get(self.parents[best], ()):
            dense = linked[node] / length[node]
            tag = self.tags[node]
            if whole:
                plain = tag == "p" and dense < 0.25 and (length[node] > 80 or dense == 0)
                if score[node] >= max(10, 0.2 * score[best]) or plain or tag in ("h1", "h2"):
                    chosen.add(node)
            elif dense < LINKED_MOST or tag in ("h1", "h2"):
                chosen.add(node)
        if whole:
            return chosen
        # Other parts of the text may lie further up: all of little linked text that
        # hold a paragraph, a heading or a long block.
        long = [False] * n
        for block, (size, _) in paragraphs.items():
            long[block] = size >= 80 or self.tags[block] in PROSE
        for node in range(n - 1, 0, -1):
            long[self.parents[node]] |= long[node]
        above = self.parents[best]
        while above > 0:
            for node in children.get(self.parents[above], ()):
                if long[node] and node != above and linked[node] < LINKED_MOST * length[node]:
                    chosen.add(node)
            above = self.parents[above]
        return chosen


def main_text(source: str | None) -> str:
    """The main text of a page: blocks in page order, joined by one space."""
    if not source:
        return ""
    page = Page(source)
    return " ".join(page.blocks(page.main()))


def extract_main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns and ``_text``, the main text of each page.

    Null or empty pages, and pages without text, give an empty text; the time for a page grows in
    proportion to its length, however deep its elements are nested; repeated rows are kept; an empty
    table gives no rows; an existing column ``_text`` is replaced. One pass, no shuffle.
    """
    pages = pages.drop("_text")

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, html_col):
            yield frame.assign(_text=[main_text(x) for x in frame[html_col]])

    schema = ddl(pages)
    return map_frames(pages, extract, f"{schema}, _text string")


@query("op2_main_text")
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extract_main_text(table(spark, sf_dir, "pages"))
    text = F.col("_text")
    return found.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
