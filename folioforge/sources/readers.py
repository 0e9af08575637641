"""Sources: manifests, saved pages and files, analyses documents, replayed service responses."""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from folioforge.functions import cols
from folioforge.operators import relational as rel

#: The field names of the manifest format.
IDENTIFIER = "neurostore string, pmid string, doi string, pmcid string, other_ids map<string,string>"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def load_identifiers(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-lines manifest with its line order as pos; a missing file is an empty collection.

    Blank lines are skipped. A line that isn't an object, or has another key than the format's, stops the query.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], IDENTIFIER + ", pos long")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    lines = rel.number_rows(lines.filter(F.trim("value") != ""), "f", "b", "i")
    keys = F.json_object_keys("value")
    known = F.array(*(F.lit(c.split()[0]) for c in IDENTIFIER.split(", ")))
    error = F.when(keys.isNull() | F.try_parse_json("value").isNull(), "not an object: ").when(F.size(F.array_except(keys, known)) > 0, "unknown keys: ")
    checked = F.when(error.isNotNull(), F.raise_error(F.concat(error, F.col("value"))).cast("string")).otherwise(F.col("value"))
    return lines.select(F.from_json(checked, IDENTIFIER).alias("r"), "pos").select("r.*", "pos")


def load_manifest(spark: SparkSession, path: str, data_root: str | None = None, missing: str = "empty") -> DataFrame | None:
    """A .jsonl manifest, below data_root if its path is relative. A missing one is empty, None or an error, as said."""
    if not path.endswith(".jsonl"):
        raise ValueError(f"a manifest is a .jsonl file: {path}")
    if data_root and "://" not in path and not path.startswith("/"):
        path = f"{data_root.rstrip('/')}/{path}"
    if missing != "empty" and not _exists(spark, path):
        if missing == "error":
            raise FileNotFoundError(path)
        return None
    return load_identifiers(spark, path)


def index_json(spark: SparkSession, path: str) -> DataFrame:
    """(neurostore, pmid, doi, pmcid) of an index: each id to a list of the three others, or to an object of them."""
    v = F.col("v")
    listed = F.from_json("v", "array<string>")
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("neurostore", "v"))
    short = v.startswith("[") & (F.size(listed) < 3)
    checked = whole.withColumn("v", F.when(short, F.raise_error(F.concat(F.lit("too short: "), F.col("neurostore"))).cast("string")).otherwise(v))
    pick = lambda i, name: cols.missing(F.when(v.startswith("["), F.get(listed, F.lit(i))).otherwise(F.get_json_object("v", f"$.{name}"))).alias(name)
    return checked.select("neurostore", pick(0, "pmid"), pick(1, "doi"), pick(2, "pmcid"))


def with_ids(manifest: DataFrame, *names: str) -> DataFrame:
    """Rows with any of the named identifiers."""
    return manifest.filter(F.coalesce(*(cols.missing(F.col(n)) for n in names)).isNotNull())


def bundles_json(spark: SparkSession, path: str) -> DataFrame:
    """(pos, bundle) of bundle documents: a list, an object with a list `bundles`, or an object of bundles."""
    v = F.col("value")
    whole = spark.read.text(path, wholetext=True)
    inner = F.get_json_object(v, "$.bundles")
    items = F.when(F.ltrim(v).startswith("["), F.from_json(v, "array<string>")).when(inner.isNotNull(), F.from_json(inner, "array<string>")).otherwise(F.map_values(F.from_json(v, "map<string,string>")))
    return whole.select(F.posexplode(items).alias("pos", "bundle"))


def saved_pages(spark: SparkSession, root: str, glob: str = "*.html") -> DataFrame:
    """(path, stem, content) of files below root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return files.select("path", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("stem"), "content", "length")


def article_folders(spark: SparkSession, root: str) -> DataFrame:
    """(dir, pmcid, files) of folders below root that hold an article.xml; only the article itself is read, for its id."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.regexp_extract("path", "^(.*?)(?:/tables)?/[^/]+$", 1).alias("dir"), F.regexp_extract("path", "([^/]+)$", 1).alias("name"))
    grouped = files.groupBy("dir").agg(F.array_sort(F.collect_list("path")).alias("files"), F.min(F.when(F.lower("name") == "article.xml", F.col("path"))).alias("article")).filter("article IS NOT NULL")  # one article's paths
    texts = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "{article.xml,ARTICLE.XML,Article.xml}").load(root).select(F.col("path").alias("article"), F.make_valid_utf8(F.col("content").cast("string")).alias("xml"))
    read = grouped.join(texts, "article", "left")
    return read.select("dir", cols.pmcid_of(F.col("dir"), F.col("xml")).alias("pmcid"), "files").filter("pmcid IS NOT NULL")


def analyses_json(spark: SparkSession, path: str) -> DataFrame:
    """slug -> table -> collection documents, a row each: (slug, table_id, collection as JSON text)."""
    outer = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("slug", "v"))
    return outer.select("slug", F.explode(F.from_json("v", "map<string,string>")).alias("table_id", "collection"))


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.parts: list[str] = []
        self.title: list[str] = []
        self.skip, self.in_title = 0, False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.skip += tag in ("script", "style")
        self.in_title |= tag == "title"

    def handle_endtag(self, tag: str) -> None:
        self.skip -= tag in ("script", "style") and self.skip > 0
        self.in_title &= tag != "title"

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title.append(data)
        elif not self.skip:
            self.parts.append(data)


def html_text(pages: DataFrame) -> DataFrame:
    """(page_id, title, text) of saved pages; null html gives nulls."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            titles, texts = [], []
            for html in frame["html"]:
                if html is None:
                    titles.append(None)
                    texts.append(None)
                    continue
                parser = _Text()
                parser.feed(html)
                parser.close()
                titles.append(" ".join("".join(parser.title).split()))
                texts.append(" ".join(" ".join(parser.parts).split()))
            yield pd.DataFrame({"page_id": frame["page_id"], "title": titles, "text": texts})

    return pages.mapInPandas(run, "page_id long, title string, text string")


class _Part(InputPartition):
    def __init__(self, path: str, query: str, year: int | None):
        super().__init__((path, query, year))
        self.path, self.query, self.year = path, query, year


class ReplaySearch(DataSource):
    """A search replayed from a JSON-lines file of recorded pages: {query, year, page, count, ids}, a line each.

    Options: path, query, start_year, end_year. Below CAP hits the plain pages are one partition, in order; from CAP
    on every year is a partition of its own, and ids that stand in several years come from the first of them.
    """

    @classmethod
    def name(cls) -> str:
        return "replay_search"

    def schema(self) -> str:
        return "pmid string, year int, page int, place int"

    def reader(self, schema) -> DataSourceReader:
        return _ReplayReader(self.options)


class _ReplayReader(DataSourceReader):
    CAP = 10_000

    def __init__(self, options):
        self.query, self.path = (options.get("query") or "").strip(), options.get("path") or ""
        self.first, self.last = int(options.get("start_year", 1990)), int(options.get("end_year", 2100))

    def _pages(self, query: str) -> Iterator[dict]:
        with open(self.path.removeprefix("file://"), encoding="utf-8") as file:
            for line in file:
                page = json.loads(line) if line.strip() else {}
                if page and page.get("query") == query:
                    yield page

    def partitions(self):
        if not self.query:
            return [_Part(self.path, "", None)]
        plain, years = [0], set()
        for page in self._pages(self.query):
            if page.get("year") is None:
                plain.append(int(page.get("count") or 0))
            elif self.first <= page["year"] <= self.last:
                years.add(page["year"])
        return [_Part(self.path, self.query, y) for y in sorted(years)] if max(plain) >= self.CAP else [_Part(self.path, self.query, None)]

    def read(self, partition):
        if not partition.query:
            return
        pages = sorted((p for p in self._pages(partition.query) if p.get("year") == partition.year), key=lambda p: p.get("page") or 0)
        for page in pages:
            for place, pmid in enumerate(page.get("ids") or []):
                yield (str(pmid), partition.year, int(page.get("page") or 0), place)
