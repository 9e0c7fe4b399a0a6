"""Listing cards: a table function builds a page's tree and gives the facts of each card; columns make adverts of them.

A page comes to a lateral join as a row and gives a row for each link to an advert. The card of a link is the farthest of
its nearest enclosing blocks, five steps up at most. The function only says what stands in a card (its first heading, its
first picture's text, its lines); what is title, company, place, date, policy and employment is told by columns.

Null, empty and broken pages give what can be read of them, none if nothing. A link that a page repeats counts once. Time
and memory grow in proportion to the page: nodes hold ranges of the page's texts instead of texts.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import text as X

#: Which links are adverts, in order of preference (parts of the link, enclosing tag, part of its class), and the pattern tried last.
LISTING_LINKS = ((("jobs--", "-inline.html"), "", ""), (("/jobs--",), "article", "job"), (("/jobs--",), "div", "listing"))
LAST_LINK = r"/jobs--.*--\d+-inline\.html"
#: Fixed values of the heuristics for the lines of a card.
NOT_A_COMPANY, POSTED = ("more", "ago", "new", "easy apply"), ("ago", "hour", "day", "week", "month")
POLICIES = (("remote", ("fully remote", "work from home")), ("hybrid", ("partially remote", "hybrid")))
EMPLOYMENTS = (("fulltime", ("full time", "full-time")), ("parttime", ("part time", "part-time")), ("contract", ("contract",)), ("contract", ("fixed term",)), ("permanent", ("permanent",)))
_BLOCKS, _STEPS, _HEADINGS = ("article", "div", "li", "section"), 5, ("h2", "h3", "h4")
_UNSEEN = ("script", "style", "template")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FACTS = "place int, link string, heading string, picture string, lines array<string>"


class Tree(HTMLParser):
    """Elements in the order in which they begin: tag, attributes, parent, and the ranges of elements and texts within."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.attributes, self.parents = ["[page]"], [{}], [0]
        self.texts: list[str] = []
        self.first_text, self.last_text, self.last_node = [0], [0], [0]
        self.by_tag: dict[str, list[int]] = {}
        self.open, self.unseen = [0], 0
        self.feed(html)
        self.close()
        while self.open:
            self._shut()

    def _shut(self) -> None:
        node = self.open.pop()
        self.last_text[node], self.last_node[node] = len(self.texts), len(self.tags)
        if node:
            self.by_tag[self.tags[node]].pop()
            self.unseen -= self.tags[node] in _UNSEEN

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = len(self.tags)
        self.tags.append(tag)
        self.attributes.append({k: v or "" for k, v in reversed(attrs)})
        self.parents.append(self.open[-1])
        for ends in (self.first_text, self.last_text):
            ends.append(len(self.texts))
        self.last_node.append(node + 1)
        if tag not in _VOID:
            self.open.append(node)
            self.by_tag.setdefault(tag, []).append(node)
            self.unseen += tag in _UNSEEN

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        """Closes the innermost open element of the tag with all within; one that is not open is ignored."""
        if self.by_tag.get(tag):
            node = self.by_tag[tag][-1]
            while self.open[-1] != node:
                self._shut()
            self._shut()

    def handle_data(self, data: str) -> None:
        if not self.unseen and data.strip():
            self.texts.append(data.strip())

    def within(self, node: int) -> list[str]:
        return self.texts[self.first_text[node] : self.last_text[node]]

    def enclosed(self, node: int, tag: str, part: str) -> bool:
        while node:
            node = self.parents[node]
            if self.tags[node] == tag and part in self.attributes[node].get("class", ""):
                return True
        return False


def _advert_links(tree: Tree, links: tuple, last: str) -> list[int]:
    anchors = [(n, tree.attributes[n].get("href", "")) for n, tag in enumerate(tree.tags) if tag == "a"]
    for parts, tag, klass in links:
        found = [n for n, href in anchors if href and all(p in href for p in parts) and (not tag or tree.enclosed(n, tag, klass))]
        if found:
            return found
    return [n for n, href in anchors if last and re.search(last, href)]


def facts_of(html: str | None, links: tuple = LISTING_LINKS, last: str = LAST_LINK) -> Iterator[tuple]:
    """(place, link, first heading, text of the first picture, lines) of each card of a page."""
    tree = Tree(html or "")
    headings = [n for n, tag in enumerate(tree.tags) if tag in _HEADINGS]
    pictures = [n for n, tag in enumerate(tree.tags) if tag == "img" and "alt" in tree.attributes[n]]
    first = lambda nodes, card: next((n for n in nodes[bisect_left(nodes, card) :][:1] if n < tree.last_node[card]), None)
    seen: set[str] = set()
    for node in _advert_links(tree, links, last):
        href = tree.attributes[node]["href"]
        if href in seen:
            continue
        seen.add(href)
        card = node
        for _ in range(_STEPS):
            if tree.tags[tree.parents[card]] not in _BLOCKS:
                break
            card = tree.parents[card]
        heading, picture = first(headings, card), first(pictures, card)
        lines = [line.strip() for text in tree.within(card) for line in text.split("\n") if line.strip()]
        yield len(seen) - 1, href, "" if heading is None else "".join(tree.within(heading)), "" if picture is None else tree.attributes[picture]["alt"].strip(), lines


def _table_function(links: tuple, last: str):
    class Cards:
        def eval(self, html: str | None) -> Iterator[tuple]:
            yield from facts_of(html, links, last)

    return F.udtf(Cards, returnType=FACTS)


def card_facts(pages: DataFrame, links: tuple = LISTING_LINKS, last: str = LAST_LINK) -> DataFrame:
    """The columns of ``pages`` but html, and the facts of each card, by a lateral join."""
    kept = [c for c in pages.columns if c != "html"]
    return pages.lateralJoin(_table_function(links, last)(F.col("html").outer())).select(*kept, "place", "link", "heading", "picture", "lines")


def _says(line: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.lower(line).contains(w))


def _first_label(joined: Column, rules: tuple) -> Column:
    return F.coalesce(*(F.when(_says(joined, words), F.lit(label)) for label, words in rules), F.lit(""))


def cards(facts: DataFrame, today: Column, base: str = "") -> DataFrame:
    """Adverts of cards; those without any text have no title and go. Links that begin with / get ``base`` before them."""
    line = lambda lines, test: F.coalesce(F.get(F.filter(lines, test), F.lit(0)), F.lit(""))
    nth = lambda i: F.coalesce(F.get("lines", F.lit(i)), F.lit(""))
    cities = tuple(c.lower() for c in X.CITIES)
    location, joined = line("lines", lambda x: _says(x, cities)), F.array_join("lines", "\n")
    named = line(F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(0))), lambda x: (F.length(x) < 60) & ~_says(x, NOT_A_COMPANY))
    posted = line("lines", lambda x: _says(x, POSTED))
    policy = _first_label(joined, POLICIES)
    kept = [c for c in facts.columns if c not in ("link", "heading", "picture", "lines")]
    out = facts.select(
        *kept, F.lit("html").alias("source"), X.clean_text(F.coalesce(F.nullif("heading", F.lit("")), nth(0))).alias("title"),
        F.coalesce(F.nullif("picture", F.lit("")), named).alias("company"), location.alias("location"), X.known_city(location).alias("city"),
        X.clean_text(F.substring(line("lines", lambda x: F.length(x) > 80), 1, 500), 500).alias("description_snippet"), X.relative_date(posted, today).alias("date_posted"),
        policy.alias("workplace_policy"), (policy == "remote").alias("is_remote"), _first_label(joined, EMPLOYMENTS).alias("employment_type"),
        F.when(F.col("link").startswith("/"), F.concat(F.lit(base), "link")).otherwise(F.col("link")).alias("job_url"),
    )
    return out.where("title != ''")
