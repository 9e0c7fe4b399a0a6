"""Detail pages of HTML feeds, parsed with the standard library in Arrow batches. Listing cards: ``cards``."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


DETAIL = "job_url string, company string, logo string, location string, description string, industry string, size string, about string, policy string, employment string"
_POLICIES, _EMPLOYMENTS = ("remote", "hybrid", "on-site"), ("full time", "part time", "contract", "permanent", "internship", "temporary")


class _Blocks(HTMLParser):
    """Text by block, with each element's classes and links in reading order."""

    HIDDEN, BLOCK = {"script", "style", "template", "noscript"}, {"article", "div", "section", "li", "p", "h1", "h2", "h3", "h4", "td", "tr", "br", "ul", "dt", "dd", "main", "footer", "nav", "header", "title"}
    VOID = {"br", "hr", "img", "input", "link", "meta", "source", "wbr", "area", "base", "col", "embed"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str]] = []
        self.out: list[dict] = []
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        mark = " ".join(filter(None, (a.get("class"), a.get("id"), a.get("data-at"))))
        if tag not in self.VOID:
            self.open.append((tag, mark))
            self.hidden += tag in self.HIDDEN
        if tag == "img" and a.get("src"):
            self.out.append({"kind": "image", "text": a["src"], "mark": mark})
        elif tag == "a" and a.get("href"):
            self.out.append({"kind": "link", "text": a["href"], "mark": mark})
        elif tag in self.BLOCK:
            self.out.append({"kind": "break", "text": "", "mark": mark})

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.hidden -= sum(t in self.HIDDEN for t, _ in self.open[i:])
                del self.open[i:]
                break
        if tag in self.BLOCK:
            self.out.append({"kind": "break", "text": "", "mark": ""})

    def handle_data(self, data: str) -> None:
        if not self.hidden and data.strip():
            self.out.append({"kind": "text", "text": " ".join(data.split()), "mark": " ".join(m for _, m in self.open if m)})


def _parsed(html: str | None) -> list[dict]:
    p = _Blocks()
    p.feed(html or "")
    p.close()
    return p.out


def _one_of(lines: list[str], words: tuple[str, ...]) -> str:
    return next((w for line in lines for w in words if re.search(rf"\b{w.replace(' ', '[ -]?').replace('-', '[ -]?')}\b", line, re.I)), "")


def detail_of(html: str | None) -> tuple:
    blocks = _parsed(html)
    marked = lambda *names: " ".join(b["text"] for b in blocks if b["kind"] == "text" and any(n in b["mark"] for n in names))
    lines = [b["text"] for b in blocks if b["kind"] == "text"]
    logo = next((b["text"] for b in blocks if b["kind"] == "image" and "logo" in b["mark"] + b["text"]), "")
    after = lambda label: next((lines[i + 1] for i in range(len(lines) - 1) if lines[i].strip(" :").lower() == label), "")
    return marked("company-name", "metadata-company-name"), logo, marked("job-location", "metadata-location"), marked("job-description", "textblock"), after("industry"), after("company size"), marked("company-about"), _one_of(lines, _POLICIES), _one_of(lines, _EMPLOYMENTS)


def parse_details(pages: DataFrame) -> DataFrame:
    """Fields of landed detail pages (job_url, html); '' where a page does not say."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([(u, *detail_of(h)) for u, h in zip(f["job_url"], f["html"])], columns=[c.split()[0] for c in DETAIL.split(", ")])

    return pages.select("job_url", "html").mapInPandas(run, DETAIL)


def with_details(ads: DataFrame, details: DataFrame) -> DataFrame:
    """What a detail page says takes the place of what the card said."""
    over = {"company": "company", "company_logo": "logo", "location": "location", "description_snippet": "description", "company_industry": "industry", "company_size": "size", "company_description": "about", "workplace_policy": "policy", "employment_type": "employment"}
    d = details.select("job_url", *(F.nullif(F.col(v), F.lit("")).alias(f"_d_{v}") for v in over.values()))
    joined = ads.join(d, "job_url", "left")
    return joined.withColumns({k: F.coalesce(F.col(f"_d_{v}"), F.col(k) if k in ads.columns else F.lit("")) for k, v in over.items()}).drop(*(f"_d_{v}" for v in over.values()))
