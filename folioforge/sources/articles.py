"""Article files to extracted content: text, tables and coordinates of three sources.

read_folder() gathers an article's files into one row; extract() turns rows (slug, source, identifier, files) into
rows of model.CONTENT, in Arrow batches, an article at a time. An article that can't be read gives a failure row with
its reason, and a table that can't be read is named in the message while the others go on.

Coordinates. Columns headed x, y and z are a triplet, any number of times; a table without such headers offers
the first three adjacent columns that are numeric in most rows. Unicode minus signs and thousands' commas are read;
a row counts if its three values are numbers of at most MOST_MM. The space of an article is the one of MNI and
Talairach that its text names more often.
"""

from __future__ import annotations

import csv
import io
import json
import re
from html.parser import HTMLParser
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import cols, model, xml

#: The largest absolute coordinate, in millimetres.
MOST_MM = 150.0
FILES = "map<string,string>"
_MINUS = str.maketrans("−–‐‑", "----")


def read_folder(spark: SparkSession, root: str) -> DataFrame:
    """(dir, files) of folders that hold an article: file names below the folder to their texts, bad bytes replaced."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    named = files.select(F.regexp_replace("path", r"/(?:tables/)?[^/]+$", "").alias("dir"), F.regexp_extract("path", r"((?:tables/)?[^/]+)$", 1).alias("name"), F.expr("make_valid_utf8(CAST(content AS STRING))").alias("text"))
    return named.groupBy("dir").agg(F.map_from_entries(F.collect_list(F.struct("name", "text"))).alias("files"))  # one article's files


def table_text(content: Column) -> Column:
    """Raw table bytes as text, bad bytes replaced."""
    return F.make_valid_utf8(content.cast("string"))


def number(cell: str | None) -> float | None:
    text = (cell or "").translate(_MINUS).replace(",", "").strip()
    return float(text) if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)", text) else None


def guess_space(text: str | None) -> str | None:
    """MNI or TAL, whichever a text names more often; MNI on ties; None if neither."""
    low = (text or "").lower()
    mni, tal = low.count("mni") + low.count("montreal neurological"), low.count("talairach")
    return None if not mni + tal else "MNI" if mni >= tal else "TAL"


def triplets(header: list[str], rows: list[list[str]]) -> list[int]:
    """First columns of the x, y, z triplets of a table."""
    last = [re.sub(r"[^a-z]+", " ", (h or "").lower()).split()[-1:] for h in header]
    named = [i for i in range(len(last) - 2) if last[i : i + 3] == [["x"], ["y"], ["z"]]]
    if named:
        return named
    for i in range(max(map(len, rows), default=0) - 2):
        good = sum(all(number(c) is not None for c in row[i : i + 3]) and len(row) >= i + 3 for row in rows)
        if 2 * good > len(rows):
            return [i]
    return []


def coordinates(header: list[str], rows: list[list[str]], space: str) -> list[dict]:
    out = []
    for i in triplets(header, rows):
        for row in rows:
            xyz = [number(c) for c in row[i : i + 3]]
            if len(xyz) == 3 and all(v is not None and abs(v) <= MOST_MM for v in xyz):
                out.append(dict(zip("xyz", xyz, strict=True)) | {"space": space})
    return out


def read_csv(text: str, header_rows: int) -> tuple[list[str], list[list[str]]]:
    """The header, its rows joined by a space, and the other rows."""
    rows = [r for r in csv.reader(io.StringIO(text)) if r]
    n = max(0, header_rows)
    width = max(map(len, rows), default=0)
    header = [" ".join(r[i] for r in rows[:n] if i < len(r) and not r[i].startswith("Unnamed:")) for i in range(width)]
    return header, rows[n:]


def grid(table: ElementTree.Element) -> tuple[list[str], list[list[str]]]:
    """Header and rows of a marked-up table; a cell that spans columns is repeated."""
    head, body = [], []
    for row in table.iter():
        if row.tag not in ("tr", "row"):
            continue
        cells, heads = [], 0
        for c in row:
            if c.tag not in ("td", "th", "entry"):
                continue
            first, last = c.get("namest") or "", c.get("nameend") or ""
            edges = [re.search(r"\d+$", v) for v in (first, last)]
            span = int(edges[1][0]) - int(edges[0][0]) + 1 if all(edges) else int(c.get("colspan") or 1) if (c.get("colspan") or "1").isdecimal() else 1
            cells += [xml.text_of(c) or ""] * max(1, min(span, 1000))
            heads += c.tag == "th"
        (head if not body and heads == len(list(row)) and cells else body).append(cells)
    for part in table.iter("thead"):  # an explicit head
        n = sum(r.tag in ("tr", "row") for r in part)
        head, body = [*head, *body][:n], [*head, *body][n:]
        break
    width = max(map(len, [*head, *body]), default=0)
    return [" ".join(r[i] for r in head if i < len(r)) for i in range(width)], body


def _stem(label: str | None, index: int, *names: str | None) -> str:
    """A table's id from its id, else its label, else its place."""
    for name in names:
        clean = re.sub("[^A-Za-z0-9_-]+", "-", name or "").strip("-").lower()
        if clean:
            return clean
    return f"table-{index + 1:03d}"


def _number_in(label: str | None) -> int | None:
    found = re.search(r"\d+", label or "")
    return int(found[0]) if found else None


def _table(index: int, table_id: str | None, label: str | None, caption: str | None, footer: str | None, raw: str, found: list[dict], space: str, more: dict[str, str | None]) -> dict:
    meta = {"table_id": table_id, "table_label": label, "raw": raw, **more}
    return {"table_id": _stem(label, index, table_id, label), "table_number": _number_in(label), "caption": caption or "", "footer": footer or "", "metadata": {k: v for k, v in meta.items() if v}, "coordinates": found, "space": space}


def _outcome(name: str, text: str, tables: list[dict], reasons: list[str]) -> dict:
    if not tables:
        return {"full_text": text, "tables": [], "error_message": " ".join([f"{name} failed to extract any tables.", *(["Reasons: " + " | ".join(reasons)] if reasons else [])])}
    return {"full_text": text, "tables": tables, "error_message": f"{name} skipped tables: " + " | ".join(reasons) if reasons else None}


def extract_pubget(files: dict[str, str]) -> dict:
    """article.xml, tables/tables.xml, and table information files with the CSV files that they name."""
    root, listing = xml.parse(files.get("article.xml")), xml.parse(files.get("tables/tables.xml") or files.get("tables.xml"))
    if root is None:
        raise ValueError("article.xml is missing or unreadable")
    if listing is None:
        raise ValueError("tables.xml is missing or unreadable")
    body = root.find(".//body")
    words = "; ".join(filter(None, map(xml.text_of, root.iter("kwd"))))
    text = "\n\n".join(filter(None, (xml.text_of(root.find(".//article-title")), words, xml.text_of(root.find(".//abstract")), xml.text_of(body))))
    space = guess_space(xml.text_of(root)) or "OTHER"
    by_id, by_label = {}, {}
    for e in listing.iter("extracted-table"):
        by_id.setdefault(xml.text_of(e.find("table-id")), e)
        by_label.setdefault(xml.text_of(e.find("table-label")), e)
    names = sorted(n for n in files if re.search(r"(^|/)table_\d+_info\.json$", n))
    if not names:
        return {"full_text": text, "tables": [], "error_message": "no table information files"}
    tables, reasons = [], []
    for i, name in enumerate(names):
        try:
            info = json.loads(files[name])
            data_name = info.get("table_data_file")
            if not data_name:
                raise ValueError("table_data_file is missing")
            header, rows = read_csv(files[name.rpartition("/")[0] + "/" * ("/" in name) + data_name], int(info.get("n_header_rows") or 0))
        except KeyError as e:
            reasons.append(f"{name}: no file {e.args[0]}")
            continue
        except (ValueError, TypeError, AttributeError) as e:
            reasons.append(f"{name}: {e}")
            continue
        table_id, label = info.get("table_id"), info.get("table_label")
        e = by_id.get(table_id) if table_id else None
        e = e if e is not None else by_label.get(label) if label else None
        if e is None:
            reasons.append(f"no table XML for {table_id or name}")
            continue
        original = e.find("original-table")
        if original is None:
            reasons.append(f"no original table for {table_id or name}")
            continue
        raw = ElementTree.tostring(original, encoding="unicode")
        tables.append(_table(i, table_id, label, info.get("table_caption"), info.get("table_foot"), raw, coordinates(header, rows, space), space, {"data_path": data_name}))
    return _outcome("pubget", text, tables, reasons)


def extract_elsevier(files: dict[str, str]) -> dict:
    """content.xml and metadata.json."""
    name = next((n for n in sorted(files) if re.search(r"(^|/)content\.xml$", n)), None)
    if name is None:
        raise ValueError("content.xml is missing: other formats are not read")
    if "metadata.json" not in files:
        raise ValueError("metadata.json is missing")
    json.loads(files["metadata.json"])
    root = xml.parse(files[name])
    if root is None:
        return {"full_text": "", "tables": [], "error_message": "table extraction failed: the article can't be parsed"}
    text = xml.text_of(root) or ""
    space = guess_space(text) or "OTHER"
    tables, reasons = [], []
    for i, node in enumerate(e for e in root.iter() if e.tag in ("table", "table-wrap") and (e.find("label") is not None or e.get("id") or e.find("tgroup") is not None)):
        label, caption = xml.text_of(node.find("label")), xml.text_of(node.find("caption"))
        foot = " ".join(filter(None, (xml.text_of(e) for e in node.iter() if e.tag in ("legend", "table-footnote", "table-wrap-foot"))))
        header, rows = grid(node)
        raw = ElementTree.tostring(node, encoding="unicode")
        tables.append(_table(i, node.get("id"), label, caption, foot, raw, coordinates(header, rows, space), space, {}))
    return _outcome("elsevier", text, tables, reasons) if tables else {"full_text": text, "tables": [], "error_message": "the article has no tables"}


class _Page(HTMLParser):
    """Text, title and tables of a saved page; scripts and styles are skipped, open cells end where others start."""

    def __init__(self) -> None:
        super().__init__()
        self.text: list[str] = []
        self.tables: list[dict] = []
        self.open: list[dict] = []
        self.skip = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.skip += tag in ("script", "style")
        now = self.open[-1] if self.open else None
        if tag == "table":
            self.open.append({"rows": [], "heads": 0, "caption": [], "in": None, "id": dict(attrs).get("id"), "raw": []})
        elif now is not None and tag == "tr":
            now["rows"].append([])
            now["in"] = None
        elif now is not None and tag in ("td", "th") and now["rows"]:
            span = dict(attrs).get("colspan") or "1"
            now["rows"][-1].append([[], int(span) if span.isdecimal() else 1, tag])
            now["in"] = now["rows"][-1][-1][0]
        elif now is not None and tag == "caption":
            now["in"] = now["caption"]

    def handle_endtag(self, tag: str) -> None:
        self.skip -= tag in ("script", "style") and self.skip > 0
        if self.open and tag == "table":
            self.tables.append(self.open.pop())
        elif self.open and tag in ("td", "th", "caption"):
            self.open[-1]["in"] = None

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        if self.open:
            if self.open[-1]["in"] is not None:
                self.open[-1]["in"].append(data)
        else:
            self.text.append(data)


def extract_ace(files: dict[str, str]) -> dict:
    """The first HTML file."""
    name = next((n for n in sorted(files) if n.lower().endswith((".html", ".htm"))), None)
    if name is None:
        raise ValueError("there is no HTML file")
    page = _Page()
    page.feed(files[name])
    page.close()
    text = " ".join(" ".join(page.text).split())
    whole = guess_space(text)
    tables = []
    for i, t in enumerate(page.tables):
        rows = [[" ".join("".join(c[0]).split()) for c in r for _ in range(min(c[1], 1000))] for r in t["rows"]]
        kinds = [{c[2] for c in r} for r in t["rows"]]
        n = next((k for k, kind in enumerate(kinds) if kind != {"th"}), len(rows))
        width = max(map(len, rows), default=0)
        header = [" ".join(r[k] for r in rows[:n] if k < len(r)) for k in range(width)]
        caption = " ".join("".join(t["caption"]).split())
        space = guess_space(caption) or whole or "OTHER"
        number_ = _number_in(caption)
        tables.append(_table(i, str(number_) if number_ else t["id"], caption, caption, "", "", coordinates(header, rows[n:], space), space, {}))
    return {"full_text": text, "tables": tables, "error_message": None}


READERS = {"pubget": extract_pubget, "elsevier": extract_elsevier, "ace": extract_ace}


def _read(source: str, files_json: str | None) -> dict:
    try:
        if source not in READERS:
            raise ValueError(f"no reader for source {source}")
        out = READERS[source](json.loads(files_json or "{}"))
    except ValueError as e:  # a failure row
        out = {"full_text": None, "tables": [], "error_message": str(e)}
    return out | {"has_coordinates": any(t["coordinates"] for t in out["tables"])}


def extract(articles: DataFrame) -> DataFrame:
    """Rows of model.CONTENT from articles (slug, source, identifier, files); an unknown source is a failure row."""
    got = xml.as_json(_read, F.col("source"), F.to_json("files"))
    rows = articles.select("slug", "source", "identifier", F.from_json(got, model.CONTENT).alias("c"))
    return rows.select("slug", "source", "identifier", "c.full_text", "c.tables", "c.has_coordinates", "c.error_message")


def failures(requests: DataFrame, source: str, message: str) -> DataFrame:
    """Failure rows of model.CONTENT for requests (slug, identifier)."""
    empty = F.array().cast(f"array<{model.TABLE}>")
    return requests.select("slug", F.lit(source).alias("source"), "identifier", F.lit(None).cast("string").alias("full_text"), empty.alias("tables"), F.lit(False).alias("has_coordinates"), F.lit(message).alias("error_message"))


def activation(x: Column, y: Column, z: Column, statistic: Column, size: Column, space: Column) -> Column:
    """A coordinate from an activation's texts; null unless x, y and z are numbers."""
    point = F.struct(cols.number(x).alias("x"), cols.number(y).alias("y"), cols.number(z).alias("z"), space.alias("space"), cols.number(statistic).alias("statistic_value"), F.lit(None).cast("string").alias("statistic_type"), cols.number(size).cast("int").alias("cluster_size"), F.lit(None).cast("string").alias("cluster_measure"), F.lit(False).alias("is_subpeak"), F.lit(False).alias("is_deactivation"), F.lit(False).alias("is_seed"))
    return F.when(cols.number(x).isNotNull() & cols.number(y).isNotNull() & cols.number(z).isNotNull(), point)


def audit(articles: DataFrame) -> DataFrame:
    """(slug, success, missing, error_message): which files of a pubget article that must be there are not."""
    files = F.col("files")
    has = lambda n: F.coalesce(F.map_contains_key(files, n), F.lit(False))
    infos = F.array_sort(F.filter(F.map_keys(files), lambda n: n.rlike(r"^tables/table_\d+_info\.json$")))
    data = lambda n: F.get_json_object(files[n], "$.table_data_file")
    state = lambda n: (
        F.when(F.try_parse_json(files[n]).isNull(), F.concat(F.lit("Invalid JSON: "), n))
        .when(cols.missing(data(n)).isNull(), F.concat(F.lit("no table_data_file in "), n))
        .when(~F.map_contains_key(files, F.concat(F.lit("tables/"), data(n))), F.concat(F.lit("tables/"), data(n)))
    )
    must = F.array(*(F.when(~has(n), F.lit(n)) for n in ("article.xml", "tables/tables.xml")))
    gone = F.filter(F.concat(must, F.transform(infos, state)), lambda m: m.isNotNull())
    return articles.select("slug", (F.size(gone) == 0).alias("success"), gone.alias("missing"), F.when(F.size(gone) > 0, F.concat(F.lit("missing: "), F.array_join(gone, ", "))).alias("error_message"))


def download_outcome(replied: Column, success: Column, message: Column, exception: Column, files: Column) -> Column:
    """(success, error_message) of a download: no reply, a reported failure, an exception, metadata only, or a payload."""
    payload = F.exists(F.coalesce(files, F.array().cast(f"array<{model.FILE}>")), lambda f: f["file_type"] != "json")
    reason = (
        F.when(~F.coalesce(replied, F.lit(False)), "no payload was returned")
        .when(~F.coalesce(success, F.lit(True)), F.concat(F.lit("failure: "), F.coalesce(cols.missing(message), F.lit("unknown"))))
        .when(exception.isNotNull(), F.concat(F.lit("exception: "), exception))
        .when(~payload, "metadata without a content payload")
    )
    return F.struct(reason.isNull().alias("success"), reason.alias("error_message"))


def explode_points(contents: DataFrame) -> DataFrame:
    """(slug, source, table_id, place, x, y, z, space): the coordinates of all tables."""
    tables = contents.select("slug", "source", F.explode("tables").alias("t"))
    points = tables.select("slug", "source", "t.table_id", F.posexplode("t.coordinates").alias("place", "c"))
    return points.select("slug", "source", "table_id", "place", "c.x", "c.y", "c.z", "c.space")
