"""Main text of web pages by tree scoring.

Elements that are never part of an article are left out while the page is read. Those whose kind or
name alone speaks against them, such as forms, asides and what is hidden, are read, and left out after that unless they
hold the article or most of the text; if little is left, the names are not asked. Each block of
text that is left gives points for its length and its commas to its container, half of them to
the next one above and less further up; a container's points are discounted by the share of its
text that is in links. The best container, or the article element around it, is kept together
with those of its siblings that are like it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.registry import query, table
from pageloom.llm.words import slices

#: Kinds of elements of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle "
    "msub msubsup msup mtable mtd mtext mtr munder munderover semantics annotation annotation-xml".split())
CLOSES = {
    "li": ("li", frozenset(("ul", "ol", "menu"))), "dt": ("dd dt", frozenset(("dl",))), "dd": ("dd dt", frozenset(("dl",))),
    "tr": ("tr td th", frozenset(("table",))), "td": ("td th", frozenset(("tr", "table"))), "th": ("td th", frozenset(("tr", "table"))),
    "option": ("option", frozenset(("select",))),
}
CLOSES = {tag: (frozenset(ends.split()), stops) for tag, (ends, stops) in CLOSES.items()}
#: Elements and roles that hold no article text.
LEFT_OUT = frozenset(
    "head title script style noscript template iframe svg canvas object audio video map nav footer button select textarea input "
    "menu applet annotation annotation-xml".split())
ROLES = frozenset("navigation contentinfo search alert menu menubar toolbar".split())
#: Elements and roles that seldom hold article text but may stand around all of it, and those of which that is usual.
AROUND_ALL = frozenset("form fieldset aside dialog header".split())
ROLES_AROUND = frozenset("banner complementary dialog alertdialog form".split())
USUAL = frozenset(("form", "fieldset"))
#: Words in class and id names that tell what a container is for.
UNLIKELY = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|adv|advert|adverts|advertisement|advertising|adbox|adslot|banner|breadcrumb|breadcrumbs|combx|comment|comments|commentlist|"
    r"community|consent|cookie|cookies|disclaimer|disqus|discuss|footer|gdpr|login|masthead|menu|menus|modal|nav|navbar|navigation|newsletter|notice|"
    r"notices|notification|overlay|pager|pagination|popup|promo|promotion|recommended|related|replies|respond|share|sharing|shoutbox|sidebar|sidebars|"
    r"signup|skyscraper|social|sponsor|sponsored|subscribe|supplemental|tagcloud|toolbar|widget|widgets)(?:$|[^a-z])")
LIKELY = re.compile(r"(?:^|[^a-z])(?:article|body|content|entry|hentry|main|page|post|story|text|blog)(?:$|[^a-z])")
#: What a name says of what stands beside or around something, and words at the end of a name of something that holds others.
STATE = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without|hide|hides)-[^\s]*")
AROUND = re.compile(r"(?:wrap|wrapper|wrapping|container|layout|area|inner|outer|row|grid|holder)$")
_UNENDED = re.compile("<[a-zA-Z/!?]")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: The least length of a block that gives points, and the points of a whole element by kind of name.
LEAST, NAMED = 25, 25.0
#: A sibling is kept from this share of the best container's score on.
SIBLING = 0.2
#: Fewer characters are little, if this many times as many in long blocks were left out for a name.
LITTLE, TIMES = 250, 4


def _likely(named: str) -> bool:
    """Whether a name that speaks against an element speaks for it, too: a part of it does so alone, or it is that of something around."""
    for part in named.split():
        if LIKELY.search(part):
            against = UNLIKELY.search(part)
            if not against or (AROUND.search(part) and against.start() > 0):
                return True
    return False


class _Page(HTMLParser):
    """Reads a page into blocks of text, each with the element that holds it."""

    def __init__(self, by_name: bool = True):
        super().__init__(convert_charrefs=True)
        self.by_name = by_name
        self.against: dict[int, bool] = {}  # elements whose kind or name speaks against them, and whether it leaves room
        self.mains: list[int] = []  # main and article elements
        self.only: set[int] = set()  # main elements
        self.tags, self.parent, self.first, self.last, self.bonus = ["#page"], [-1], [0], [0], [0.0]
        self.stack, self.open = [0], Counter()
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.pieces: list[str] = []
        self.linked = 0
        self.in_link = 0
        self.skip = ""  # the element that is being left out
        self.inside: Counter = Counter()  # what is open inside it

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                holder = self.stack[-1]
                while self.tags[holder] in INLINE:
                    holder = self.parent[holder]
                self.blocks.append((holder, text, min(self.linked, len(text))))
            self.pieces = []
            self.linked = 0

    def _pop(self) -> None:
        node = self.stack.pop()
        tag = self.tags[node]
        self.open[tag] -= 1
        self.in_link -= tag == "a"
        if tag not in INLINE:
            self.flush_into(node)
        self.last[node] = len(self.blocks)

    def flush_into(self, node: int) -> None:
        """End a block whose holder is the element that is being closed."""
        self.stack.append(node)
        self.flush()
        self.stack.pop()

    def _close_implied(self, tag: str) -> None:
        if tag not in INLINE and self.open["p"]:
            for k in range(len(self.stack) - 1, 0, -1):
                name = self.tags[self.stack[k]]
                if name == "p":
                    while len(self.stack) > k:
                        self._pop()
                    break
                if name not in INLINE:
                    break
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            if any(self.open[e] for e in ends):
                for k in range(len(self.stack) - 1, 0, -1):
                    name = self.tags[self.stack[k]]
                    if name in stops:
                        break
                    if name in ends:
                        while len(self.stack) > k:
                            self._pop()
                        break

    def _hidden(self, attrs: dict[str, str | None]) -> bool:
        if "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True
        return "none" in (style := (attrs.get("style") or "").lower()) and re.search(r"display\s*:\s*none", style) is not None

    def _left_out(self, tag: str, attrs: dict[str, str | None]) -> bool:
        if tag in LEFT_OUT:
            return True
        if not attrs or tag in ("html", "body"):
            return False
        if (attrs.get("role") or "").strip().lower() in ROLES:
            return True
        if tag in INLINE or tag in ("article", "main", "h1"):
            return self._hidden(attrs) or self._against(tag, attrs) is not None
        return False

    def _against(self, tag: str, attrs: dict[str, str | None]) -> bool | None:
        """None, or whether a kind or name that speaks against the element leaves room for it to hold the article without saying so."""
        if tag in AROUND_ALL and not (tag == "header" and self.open["article"]):
            return tag in USUAL
        if not attrs or tag in ("html", "body", "article", "main", "h1"):
            return None
        role = (attrs.get("role") or "").strip().lower()
        if role in ROLES_AROUND:
            return role in USUAL
        if self._hidden(attrs):
            return False
        if not self.by_name:
            return None
        named = STATE.sub("", _CAMEL.sub("-", f"{attrs.get('class') or ''} {attrs.get('id') or ''}").lower())
        return _likely(named) if UNLIKELY.search(named) else None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.skip:
            self.inside[tag] += tag not in VOID
            return
        if tag in VOID:
            if tag == "br":
                self.pieces.append(" ")
            elif tag == "hr":
                self._close_implied(tag)
                self.flush()
            return
        self._close_implied(tag)
        found = dict(attrs)
        if self._left_out(tag, found):
            if tag not in INLINE:
                self.flush()
            self.skip = tag
            self.inside.clear()
            return
        if tag not in INLINE:
            self.flush()
        node = len(self.tags)
        if (against := self._against(tag, found)) is not None:
            self.against[node] = against
        if tag in ("article", "main") or found.get("role") in ("main", "article"):
            self.mains.append(node)
            if tag == "main" or found.get("role") == "main":
                self.only.add(node)
        named = f"{found.get('class') or ''} {found.get('id') or ''}".lower() if found else ""
        self.tags.append(tag)
        self.parent.append(self.stack[-1])
        self.first.append(len(self.blocks))
        self.last.append(len(self.blocks))
        self.bonus.append(NAMED * ((tag in ("article", "main") or found.get("role") in ("main", "article")) + bool(named.strip() and LIKELY.search(named))))
        self.stack.append(node)
        self.open[tag] += 1
        self.in_link += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash means nothing but on void elements

    def handle_endtag(self, tag: str) -> None:
        if self.skip:
            if self.inside[tag]:
                self.inside[tag] -= 1
                return
            if tag != self.skip and (tag in INLINE or not self.open[tag]):
                return
            closed, self.skip = self.skip, ""
            if tag == closed:
                return
            # an element around it ends, so it was never closed itself
        if not self.open[tag]:
            if tag == "br":
                self.pieces.append(" ")
            elif tag not in INLINE:
                self.flush()
            return
        for k in range(len(self.stack) - 1, 0, -1):
            name = self.tags[self.stack[k]]
            if name == tag:
                while len(self.stack) > k:
                    self._pop()
                return
            if tag in INLINE and name not in INLINE:
                return  # an inline end does not close the block it stands in

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.pieces.append(data)
            if self.in_link:
                self.linked += len(data.strip())

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)  # marked sections mean nothing in this markup

    def finish(self) -> None:
        if _UNENDED.match(self.rawdata):
            self.rawdata = ""  # a tag or comment that the page breaks off in
        self.close()
        self.skip = ""
        while len(self.stack) > 1:
            self._pop()
        self.flush()
        self.last[0] = len(self.blocks)


    def leave_out(self) -> int:
        """Leave out the elements that kinds and names speak against; returns the characters in long blocks that go.

        While no main or article element is left, one stays if it holds the main element, or most of the text and
        either a single article element or a kind or name that leaves room for that. Text under such a name is not counted for it.
        """
        if not self.against:
            return 0
        owner = [-1] * len(self.tags)  # the next element around whose name is against it
        for node in range(1, len(self.tags)):
            owner[node] = node if node in self.against else owner[self.parent[node]]
        chars: Counter = Counter()
        for holder, text, in_links in self.blocks:
            if len(text) >= LEAST and in_links * 2 <= len(text):
                chars[owner[holder]] += len(text)
        articles: dict[int, list[int]] = {}
        for node in self.mains:
            if self.last[node] > self.first[node]:
                articles.setdefault(owner[node], []).append(node)
        inside = {node: set() for node in self.against}  # owners of articles in each of them
        for at in articles:
            around = at
            while around >= 0:
                inside[around].add(at)
                around = owner[self.parent[around]]
        left = {-1}
        found = -1 in articles
        for node in sorted(self.against):
            if owner[self.parent[node]] in left and not found:
                held = [n for at in inside[node] for n in articles[at]]
                most = sum(chars[n] for n in inside[node] | {node}) - sum(chars[n] for n in left)
                if any(n in self.only for n in held) or (most > 0 and self.against[node]) or (most >= 0 and len(held) == 1):
                    left.add(node)
                    found = node in articles
        kept, at = [], [0]
        for block in self.blocks:
            if owner[block[0]] in left:
                kept.append(block)
            at.append(len(kept))
        self.first, self.last, self.blocks = [at[k] for k in self.first], [at[k] for k in self.last], kept
        return sum(n for node, n in chars.items() if node not in left)


def main_text(html: str) -> str:
    """The article of a page: its blocks in page order, parted by an empty line."""
    page = _Page()
    page.feed(html)
    page.finish()
    gone = page.leave_out()
    text = _best(page)
    if len(text) < LITTLE and len(text) * TIMES < gone and not any(page.last[n] > page.first[n] for n in page.mains):
        page = _Page(by_name=False)
        page.feed(html)
        page.finish()
        text = max(text, _best(page), key=len)
    return text


def _best(page: _Page) -> str:
    blocks = page.blocks
    if not blocks:
        return ""
    total, linked = [0], [0]
    for _, text, in_links in blocks:
        total.append(total[-1] + len(text))
        linked.append(linked[-1] + in_links)
    points: dict[int, float] = {}
    for holder, text, in_links in blocks:
        if len(text) < LEAST or in_links * 2 > len(text):
            continue
        worth = 1.0 + text.count(",") + min(len(text) // 100, 3)
        node, level = (page.parent[holder] if holder else holder), 0
        while node >= 0 and level < 5:
            points[node] = points.get(node, 0.0) + worth / (1 if level == 0 else 2 if level == 1 else level * 3)
            node, level = page.parent[node], level + 1

    def density(node: int) -> float:
        low, high = page.first[node], page.last[node]
        return (linked[high] - linked[low]) / max(1, total[high] - total[low])

    score = {n: (p + page.bonus[n]) * (1.0 - density(n)) for n, p in points.items() if page.tags[n] not in ("#page", "html")}
    if not score:
        # nothing but short blocks: the article element if there is one, else what is not in links
        chosen = [n for n, t in enumerate(page.tags) if t in ("article", "main") and page.last[n] > page.first[n]]
        best = max(chosen, key=lambda n: (total[page.last[n]] - total[page.first[n]], -n), default=None)
        if best is None:
            return "\n\n".join(t for _, t, k in blocks if k * 2 <= len(t))
    else:
        best = max(score, key=lambda n: (score[n], -n))
        node = best
        while node > 0:
            if page.tags[node] == "article" or (page.tags[node] == "main" and page.tags[best] != "article"):
                best = node
            node = page.parent[node]
    kept = {best}
    if page.tags[best] not in ("article", "main", "body") and score:
        bar = max(10.0, SIBLING * score.get(best, 0.0))
        kept |= {n for n, p in enumerate(page.parent) if p == page.parent[best] and score.get(n, 0.0) >= bar}
    out = []
    for node in sorted(kept, key=lambda n: page.first[n]):
        for k in range(page.first[node], page.last[node]):
            _, text, in_links = blocks[k]
            if in_links * 5 <= len(text) * 4 or page.tags[best] == "article":
                out.append(text)
    return "\n\n".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            texts = [main_text(h) if h else "" for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], [*part.schema.names[:-1], "text"])


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of each row of ``pages``, and ``text``, its main text.

    A null or empty page, and one without article text, gives an empty text. Repeated rows
    stay; other columns, whatever their names, are left out. Markup may be broken anywhere.
    """
    rows = pages.select(*[F.col(c).alias(f"k{k}") for k, c in enumerate(keep)], F.col(html_col).alias("html"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("text", T.StringType())])
    return rows.mapInArrow(_extract, schema).toDF(*keep, "text")


@query("op6_main_text")
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
