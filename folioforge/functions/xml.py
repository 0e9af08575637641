"""Article XML read with the standard library, a document at a time: text, tables and metadata as plain values.

XPath functions of the engine take fixed paths only, so lists of nested elements are read here, in Arrow batches.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(xml: str | bytes | None) -> ElementTree.Element | None:
    """The root, with namespaces dropped from names; None for what can't be parsed."""
    try:
        root = ElementTree.fromstring(xml)
    except (ElementTree.ParseError, TypeError, ValueError):
        return None
    for e in root.iter():
        if isinstance(e.tag, str) and "}" in e.tag:
            e.tag = e.tag.rpartition("}")[2]
    return root


def text_of(e: ElementTree.Element | None) -> str | None:
    """All text below an element, white space runs as one space; None if there is none."""
    return None if e is None else " ".join("".join(e.itertext()).split()) or None


def _first(root: ElementTree.Element, *paths: str) -> str | None:
    return next((t for t in (text_of(root.find(p)) for p in paths) if t), None)


def _year(e: ElementTree.Element | None) -> int | None:
    if e is None:
        return None
    lead = (_first(e, "Year") or "")[:4].strip()
    if lead.isdecimal():
        return int(lead)
    loose = re.search(r"(?:19|20)\d{2}", _first(e, "MedlineDate") or "")
    return int(loose[0]) if loose else None


def pubmed_articles(xml: str | None) -> list[dict]:
    """pmid and metadata fields of each article of an article set."""
    root = parse(xml)
    out = []
    for node in [] if root is None else root.iter("PubmedArticle"):
        citation = node.find("MedlineCitation")
        article = None if citation is None else citation.find("Article")
        if article is None:
            continue
        authors = []
        for a in article.iterfind("AuthorList/Author"):
            name = _first(a, "CollectiveName") or " ".join(filter(None, (_first(a, "ForeName", "Initials"), _first(a, "LastName"))))
            if name:
                authors.append({"name": name, "affiliation": _first(a, "AffiliationInfo/Affiliation")})
        sections = []
        for s in article.iterfind("Abstract/AbstractText"):
            if text := text_of(s):
                sections.append(f"{s.get('Label')}: {text}" if s.get("Label") else text)
        dates = (article.find("Journal/JournalIssue/PubDate"), article.find("ArticleDate"), citation.find("DateCompleted"))
        out.append({
            "pmid": _first(citation, "PMID"),
            "title": _first(article, "ArticleTitle") or "",
            "authors": authors,
            "abstract": "\n\n".join(sections) or None,
            "journal": _first(article, "Journal/Title"),
            "publication_year": next((y for y in map(_year, dates) if y), None),
            "keywords": list(dict.fromkeys(filter(None, map(text_of, citation.iterfind("KeywordList/Keyword"))))),
            "source": "pubmed",
            "raw_metadata": {"pubmed": ElementTree.tostring(node, encoding="unicode")},
        })
    return out


def jats_article(xml: str | None) -> dict | None:
    """Metadata fields of an article file; None without a title."""
    root = parse(xml)
    title = None if root is None else _first(root, ".//article-title")
    if not title:
        return None
    authors = []
    for who in root.iter("contrib"):
        if (who.get("contrib-type") or "author").strip() not in ("author", ""):
            continue
        last, group = _first(who, ".//surname"), _first(who, ".//collab")
        if last or group:
            authors.append({"name": " ".join(filter(None, (_first(who, ".//given-names"), last))) if last else group})
    dates = root.findall(".//pub-date")
    date = next((d for d in dates if d.get("pub-type") == "epub"), dates[0] if dates else None)
    year = "" if date is None else _first(date, "year") or ""
    return {"title": title, "authors": authors, "abstract": _first(root, ".//abstract"), "journal": _first(root, ".//journal-title"), "publication_year": int(year) if year.isdecimal() else None, "source": "pubget_fallback"}


def as_json(read: Callable, *texts: Column) -> Column:
    """read(text, ...) of each row as JSON text, in Arrow batches; null where it gives None."""

    @F.pandas_udf("string")
    def run(*columns: pd.Series) -> pd.Series:
        got = [read(*(None if isinstance(v, float) else v for v in row)) for row in zip(*columns, strict=True)]
        return pd.Series([None if g is None else json.dumps(g) for g in got], dtype=object)

    return run(*texts)
