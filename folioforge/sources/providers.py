"""Provider responses, replayed from tables: searches, identifier lookups, metadata and table parses.

Every provider is a table of recorded responses with the payload as text; parsing, matching and filling are
DataFrame steps, so a live client only has to write the same table. A response that can't be read is skipped, as
a failed batch is, and the others go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import cols, model, xml
from folioforge.operators import relational as rel
from folioforge.plans import stages

#: Ids in a request.
BATCH = {"pubmed": 200, "semantic_scholar": 500, "openalex": 100}
#: Ids in a page of a search, and the number of hits from which it is asked year by year.
PAGE, CAP = 1000, 10_000
METADATA_FIELDS = ["title", "authors", "abstract", "journal", "publication_year", "keywords", "license", "source", "open_access", "raw_metadata"]

_CONVERTED = "struct<records:array<struct<`requested-id`:string,pmid:string,pmcid:string,doi:string,status:string,error:string,mid:string,aiid:string,version:string,`release-date`:string>>>"
_SCHOLAR = "array<struct<paperId:string,error:string,externalIds:map<string,string>>>"
_WORKS = "struct<results:array<struct<ids:struct<openalex:string,doi:string,pmid:string,mag:string>>>>"
_PAPERS = "array<struct<title:string,venue:string,abstract:string,year:int,isOpenAccess:boolean,error:string,authors:array<struct<name:string>>>>"
_HITS = "struct<esearchresult:struct<count:string,idlist:array<string>>>"


def search(pages: DataFrame, query: str, start_year: int = 1990, end_year: int = 2100) -> DataFrame:
    """(pmid, pos) of a query from recorded pages (query, year, page, payload); a null year is the plain search.

    Below CAP hits the pages' order stays, repeats too. From CAP on the yearly searches count: distinct, by text.
    """
    query = query.strip()
    rows = pages.filter((F.trim("query") == query) & F.lit(bool(query))).withColumn("r", F.from_json("payload", _HITS)["esearchresult"])
    hits = rows.select("year", "page", F.coalesce(F.col("r.count").try_cast("long"), F.lit(0)).alias("count"), F.posexplode("r.idlist").alias("place", "pmid"))
    total = rows.filter("year IS NULL").agg(F.max(F.coalesce(F.col("r.count").try_cast("long"), F.lit(0)))).first()[0] or 0
    if total < CAP:
        order = Window.orderBy("page", "place")  # CAP rows at most
        return hits.filter("year IS NULL").select("pmid", F.row_number().over(order).cast("long").alias("pos"))
    years = hits.filter(F.col("year").between(start_year, end_year)).select("pmid").distinct()
    return rel.number_rows(years, "pmid")


def requests(ids: DataFrame, provider: str, id_type: str, pos: str = "pos") -> DataFrame:
    """(batch, place, value): the ids that a provider is asked for, in order, in batches of its size."""
    asked = ids.filter(cols.missing(F.col(id_type)).isNotNull()).select(F.col(pos).alias("__pos"), cols.strip(F.col(id_type)).alias("value"))
    numbered = rel.number_rows(asked, "__pos", "value").withColumn("n", F.col("pos") - 1)
    size = BATCH[provider]
    return numbered.select(F.floor(F.col("n") / size).cast("long").alias("batch"), (F.col("n") % size).cast("long").alias("place"), "value")


def _fill(ids: DataFrame, found: DataFrame, key: str, fields: tuple[str, ...] = ("pmid", "pmcid", "doi")) -> DataFrame:
    """ids with null fields filled and other_ids added where absent, from found (key, fields, extra)."""
    incoming = found.select(F.col(key).alias("__k"), *(F.col(c).alias(f"__{c}") for c in fields), F.col("extra").alias("__extra"))
    out = ids.join(incoming, F.col(key) == F.col("__k"), "left")
    empty = F.create_map().cast("map<string,string>")
    merged = F.map_zip_with(F.coalesce("other_ids", empty), F.coalesce("__extra", empty), lambda _, a, b: F.coalesce(a, b))
    kept = F.map_filter(merged, lambda _, v: v.isNotNull())
    own = {c: F.coalesce(cols.missing(F.col(c)), cols.missing(F.col(f"__{c}"))).alias(c) for c in fields}
    return out.select(*(own.get(c, F.when(F.size(kept) > 0, kept).alias(c) if c == "other_ids" else F.col(c)) for c in ids.columns))


def convert_ids(ids: DataFrame, responses: DataFrame, id_type: str) -> DataFrame:
    """ids (pos, pmid, doi, pmcid, other_ids, ...) filled from id converter responses (payload)."""
    records = responses.select(F.explode(F.from_json("payload", _CONVERTED)["records"]).alias("r"), F.monotonically_increasing_id().alias("n")).select("r.*", "n")
    extra = F.map_filter(F.create_map(*(x for c in ("mid", "aiid", "version", "release-date") for x in (F.lit(c), F.col(f"`{c}`")))), lambda _, v: cols.missing(v).isNotNull())
    asked = F.col("`requested-id`")
    key = F.when(~F.upper(asked).startswith("PMC"), F.concat(F.lit("PMC"), asked)).otherwise(asked) if id_type == "pmcid" else asked
    good = records.filter((F.coalesce(F.col("status"), F.lit("")) != "error") & cols.missing(F.col("error")).isNull() & cols.missing(asked).isNotNull())
    # Earlier records fill first; a later one only adds what is still missing.
    first = lambda c: F.min_by(c, F.when(cols.missing(F.col(c)).isNotNull(), F.col("n"))).alias(c)
    fields = [c for c in ("pmid", "pmcid", "doi") if c != id_type]
    found = good.withColumn("key", key).withColumn("extra", extra).groupBy("key").agg(*map(first, fields), F.min_by("extra", "n").alias("extra"))
    return _fill(ids, found.withColumnRenamed("key", id_type), id_type, tuple(fields))


def _zip(asked: DataFrame, responses: DataFrame, schema: str) -> DataFrame:
    """(value, r): the n-th record of each batch's response (batch, payload) beside the n-th value asked for."""
    records = responses.select("batch", F.posexplode(F.from_json("payload", schema)).alias("place", "r"))
    return asked.join(records, (asked["batch"] == records["batch"]) & (asked["place"] == records["place"])).select("value", "r")


def scholar_ids(ids: DataFrame, responses: DataFrame, id_type: str) -> DataFrame:
    """ids filled from positional responses (batch, payload); all external ids go to other_ids, renormalised."""
    found = _zip(requests(ids, "semantic_scholar", id_type), responses, _SCHOLAR).filter("r IS NOT NULL AND r.error IS NULL")
    ext = F.col("r.externalIds")
    named = F.create_map(*(x for n, c in {"semantic_scholar_paper_id": F.col("r.paperId"), "semantic_scholar_corpus_id": ext["CorpusId"], "mag_id": ext["MAG"], "arxiv_id": ext["ArXiv"]}.items() for x in (F.lit(n), c.cast("string"))))
    rest = F.transform_keys(F.coalesce(ext, F.create_map().cast("map<string,string>")), lambda k, _: F.lower(k))
    extra = F.map_filter(F.map_zip_with(named, rest, lambda _, a, b: F.coalesce(a, b)), lambda _, v: v.isNotNull())
    rows = found.select(F.col("value").alias(id_type), ext["DOI"].alias("__doi"), ext["PubMed"].alias("__pmid"), ext["PubMedCentral"].alias("pmcid"), extra.alias("extra"))
    other = "pmid" if id_type == "doi" else "doi"
    rows = rows.select(id_type, F.col(f"__{other}").alias(other), "pmcid", "extra").groupBy(id_type).agg(F.first(other).alias(other), F.first("pmcid").alias("pmcid"), F.first("extra").alias("extra"))
    return stages.normalize(_fill(ids, rows, id_type, (other, "pmcid")))


def openalex_ids(ids: DataFrame, responses: DataFrame, id_type: str) -> DataFrame:
    """ids with other_ids.openalex, matched on the normalised doi or pmid of the works found."""
    works = responses.select(F.explode(F.from_json("payload", _WORKS)["results"]["ids"]).alias("w")).filter(cols.missing(F.col(f"w.{id_type}")).isNotNull())
    norm = cols.normalize_doi if id_type == "doi" else cols.normalize_pmid
    found = works.select(norm(F.col(f"w.{id_type}")).alias("__k"), F.col("w.openalex").alias("__o")).filter("__o IS NOT NULL").groupBy("__k").agg(F.max("__o").alias("__o"))
    out = ids.join(found, F.col(id_type) == F.col("__k"), "left")
    empty = F.create_map().cast("map<string,string>")
    others = F.map_filter(F.coalesce("other_ids", empty), lambda k, _: F.col("__o").isNull() | (k != "openalex"))
    merged = F.when(F.col("__o").isNull(), F.col("other_ids")).otherwise(F.map_concat(others, F.create_map(F.lit("openalex"), F.col("__o"))))
    return out.withColumn("other_ids", merged).drop("__k", "__o")


def _metadata(**fields: Column) -> Column:
    """A metadata struct of some fields; the others are null or empty."""
    empty = {"authors": F.array().cast(f"array<{model.AUTHOR}>"), "keywords": F.array().cast("array<string>"), "raw_metadata": F.create_map().cast("map<string,string>")}
    return F.struct(*(F.coalesce(fields.get(n, F.lit(None)), empty[n]).alias(n) if n in empty else fields.get(n, F.lit(None)).alias(n) for n in METADATA_FIELDS)).cast(model.METADATA)


def _authors(names: Column) -> Column:
    return F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(None).cast("string").alias("affiliation"), F.lit(None).cast("string").alias("orcid")))


def scholar_metadata(ids: DataFrame, responses: DataFrame) -> DataFrame:
    """(slug, metadata): the doi is asked for, else the pmid; responses (batch, payload) are positional."""
    key = F.coalesce(F.concat(F.lit("DOI:"), cols.missing(F.col("doi"))), F.concat(F.lit("PMID:"), cols.missing(F.col("pmid"))))
    asked = ids.withColumn("key", key).filter("key IS NOT NULL")
    found = _zip(requests(asked, "semantic_scholar", "key"), responses, _PAPERS).filter("r IS NOT NULL AND r.error IS NULL")
    m = _metadata(title=F.coalesce("r.title", F.lit("")), authors=_authors(F.filter(F.col("r.authors.name"), lambda n: n.isNotNull())), abstract=F.col("r.abstract"), journal=F.col("r.venue"), publication_year=F.col("r.year"), source=F.lit("semantic_scholar"), open_access=F.col("r.isOpenAccess"))
    return asked.select("slug", "key").join(found.select(F.col("value").alias("key"), m.alias("metadata")).dropDuplicates(["key"]), "key").drop("key")


def pubmed_metadata(ids: DataFrame, responses: DataFrame) -> DataFrame:
    """(slug, metadata) from article sets (payload, XML), matched by pmid; of repeated articles the last counts."""
    sets = responses.select(xml.as_json(xml.pubmed_articles, F.col("payload")).alias("j"), F.monotonically_increasing_id().alias("n"))
    rows = sets.select("n", F.posexplode(F.from_json("j", f"array<struct<pmid:string,{model.columns(model.METADATA)}>>")).alias("i", "m")).filter("m.pmid IS NOT NULL")
    last = rows.groupBy("m.pmid").agg(F.max_by("m", F.struct("n", "i")).alias("m"))
    return ids.select("slug", "pmid").join(last, "pmid").select("slug", _whole(F.col("m")).alias("metadata"))


def _whole(m: Column) -> Column:
    """A metadata struct whose absent lists and maps are empty."""
    return _metadata(**{n: m[n] for n in METADATA_FIELDS})


def jats_metadata(articles: DataFrame) -> DataFrame:
    """(slug, metadata) of article files (slug, xml): a fallback where providers give nothing; no title, no row."""
    read = articles.select("slug", F.from_json(xml.as_json(xml.jats_article, F.col("xml")), model.METADATA).alias("m"))
    return read.filter("m.title IS NOT NULL").select("slug", _whole(F.col("m")).alias("metadata"))


def elsevier_metadata(articles: DataFrame) -> DataFrame:
    """(slug, metadata) of stored metadata documents (slug, json): fields with their alternatives; no title, no row."""
    pick = lambda *names: cols.first_text(F.col("json"), *names)
    people = F.from_json(cols.first_text(F.col("json"), "authors", "creators"), "array<struct<`given-name`:string,given_name:string,surname:string,family_name:string,name:string>>")
    name = lambda a: F.coalesce(cols.missing(F.concat_ws(" ", F.coalesce(a["given-name"], a["given_name"]), F.coalesce(a["surname"], a["family_name"]))), a["name"])
    m = _metadata(title=pick("title", "dc:title"), authors=_authors(F.filter(F.transform(people, name), lambda n: n.isNotNull())), abstract=pick("abstract", "dc:description"), journal=pick("publicationName", "prism:publicationName"), publication_year=cols.year_before_dash(pick("coverDate", "prism:coverDate")), source=F.lit("elsevier_fallback"))
    return articles.select("slug", m.alias("metadata")).filter("metadata.title IS NOT NULL")


def cached_metadata(requests_: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(slug, metadata) hits of a cache (slug, payload) and the requests without a readable entry."""
    read = cache.select("slug", model.decode(F.col("payload"), model.METADATA).alias("metadata"), F.try_parse_json("payload").isNotNull().alias("ok")).filter("ok AND metadata.title IS NOT NULL").drop("ok").dropDuplicates(["slug"])
    return requests_.select("slug").join(read, "slug"), requests_.join(read, "slug", "left_anti")


_POINT = "struct<coordinates:array<double>,space:string,`values`:string,cluster_size:string,cluster_measure:string,is_subpeak:boolean,is_deactivation:boolean,is_seed:boolean>"
_PARSED = "struct<analyses:array<string>>"
_ANALYSIS = "struct<name:string,description:string,points:array<string>>"


def parse_analyses(replies: DataFrame) -> DataFrame:
    """(key, place, name, description, points): parsed tables from replies (key, arguments); null arguments raise.

    A point needs exactly three numbers. Its values: objects with a known kind and a number; a bare number or numeric text is
    of kind T. An unreadable reply, or one whose analyses aren't a list, has no analyses.
    """
    checked = replies.withColumn("arguments", F.coalesce("arguments", F.raise_error(F.lit("the reply has no function call")).cast("string")))
    texts = F.coalesce(F.from_json("arguments", _PARSED)["analyses"], F.array().cast("array<string>"))
    rows = checked.select("key", F.posexplode(texts).alias("place", "a")).filter(F.col("a").startswith("{"))
    one = rows.select("key", "place", F.from_json("a", _ANALYSIS).alias("a"))
    number = lambda c: cols.number(c)
    numeric = lambda p: F.try_variant_get(F.try_parse_json(p), "$.coordinates", "array<variant>")
    plain = lambda v: F.schema_of_variant(v).isin("BIGINT", "DOUBLE") | F.schema_of_variant(v).startswith("DECIMAL")
    good = F.filter(F.coalesce("a.points", F.array().cast("array<string>")), lambda p: p.startswith("{") & F.coalesce((F.size(numeric(p)) == 3) & F.forall(numeric(p), plain), F.lit(False)))

    def values(raw: Column) -> Column:
        items = F.from_json(raw, "array<string>")
        entry = lambda s: F.from_json(s, "struct<value:string,kind:string>")
        typed = lambda s: F.when(s.startswith("{"), F.struct(number(entry(s)["value"]).alias("value"), cols.statistic_kind(entry(s)["kind"]).alias("kind"))).otherwise(F.struct(number(s).alias("value"), F.lit("T").alias("kind")))
        return F.filter(F.transform(items, typed), lambda v: v["value"].isNotNull() & v["kind"].isNotNull())

    def point(text: Column) -> Column:
        p = F.from_json(text, _POINT)
        first = F.get(values(p["values"]), F.lit(0))
        no = lambda c: F.coalesce(c, F.lit(False))
        return F.struct(p["coordinates"][0].alias("x"), p["coordinates"][1].alias("y"), p["coordinates"][2].alias("z"), p["space"].alias("space"), first["value"].alias("statistic_value"), first["kind"].alias("statistic_type"), cols.cluster_size(p["cluster_size"]).alias("cluster_size"), cols.cluster_measure(p["cluster_measure"]).alias("cluster_measure"), no(p["is_subpeak"]).alias("is_subpeak"), no(p["is_deactivation"]).alias("is_deactivation"), no(p["is_seed"]).alias("is_seed"))

    return one.select("key", "place", "a.name", "a.description", F.transform(good, point).cast(f"array<{model.COORDINATE}>").alias("points"))


def with_space(points: Column, default: Column) -> Column:
    """Points with their own space where it is known, else the table's."""
    own = lambda p: F.coalesce(F.nullif(cols.coordinate_space(p["space"]), F.lit("OTHER")), default)
    return F.transform(points, lambda p: p.withField("space", own(p)))
