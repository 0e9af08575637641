"""Scalar functions over identifier, table, statistic and date columns, as Column -> Column.

An empty string counts as missing wherever a value is looked for. White space is trimmed by pattern: the
built-in trim takes only spaces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGES = r"^[\s ]+|[\s ]+$"
#: Fixed values.
PUBMED_PREFIX = "https://pubmed.ncbi.nlm.nih.gov/"
DOI_URL = r"(?i)https?://[^/\s]+/(10\.\d{4,9}/[^\s\"'<>()]+)"
FILE_TYPES = {".pdf": "application/pdf", ".xml": "application/xml", ".html": "text/html", ".htm": "text/html", ".txt": "text/plain", ".csv": "text/csv", ".json": "application/json", ".zip": "application/zip"}
DEFAULT_FILE_TYPE = "application/octet-stream"


def missing(c: Column) -> Column:
    """null for an empty string."""
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGES, "")


def normalize_identifier(c: Column) -> Column:
    return missing(strip(c))


def normalize_pmid(c: Column) -> Column:
    v = normalize_identifier(c)
    return missing(F.when(v.startswith(PUBMED_PREFIX), F.regexp_replace(F.substring(v, len(PUBMED_PREFIX) + 1, 1 << 30), "/+$", "")).otherwise(v))


def normalize_pmcid(c: Column) -> Column:
    v = normalize_identifier(c)
    return F.when(F.upper(v).startswith("PMC"), v).otherwise(F.concat(F.lit("PMC"), v))


def normalize_doi(c: Column) -> Column:
    """The DOI of a resolver address that starts with http, or the value, without a doi: prefix; case is kept."""
    v = normalize_identifier(c)
    bare = F.when(v.startswith("http"), F.regexp_replace(v, DOI_URL, "$1")).otherwise(v)
    return F.regexp_replace(bare, "^(?i)doi:", "")


def normalize_other_ids(c: Column) -> Column:
    kept = F.map_filter(F.transform_values(c, lambda _, v: normalize_identifier(v)), lambda _, v: v.isNotNull())
    return F.when(F.size(kept) > 0, kept)


def slugify(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def identifier_slug(pmid: Column, doi: Column, pmcid: Column) -> Column:
    return slugify(F.concat_ws("-", pmid, doi, pmcid))


def _clean(c: Column, keep: str, edge: str = "-") -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"[^{keep}]+", "-"), f"^[{edge}]+|[{edge}]+$", "")


def sanitize_table_id(table_id: Column, index: Column) -> Column:
    return F.coalesce(missing(F.lower(_clean(table_id, "A-Za-z0-9_-"))), F.concat(F.lit("table-"), (index + 1).cast("string")))


def sanitize_table_label(table_id: Column, label: Column, index: Column) -> Column:
    """From the id, else the label, else table-NNN."""
    made = F.concat(F.lit("table-"), F.lpad((index + 1).cast("string"), 3, "0"))
    source = F.coalesce(missing(table_id), missing(label), made)
    return F.coalesce(missing(F.lower(_clean(source, "A-Za-z0-9_-"))), made)


def slug_table_id(candidate: Column, index: Column) -> Column:
    return F.coalesce(missing(slugify(candidate)), F.concat(F.lit("table-"), index.cast("string")))


def manifest_filename(c: Column) -> Column:
    return F.coalesce(missing(_clean(c, "A-Za-z0-9._-")), F.lit("analysis"))


def hash_stem(slug: Column) -> Column:
    return F.coalesce(missing(F.lower(_clean(slug, "A-Za-z0-9_-", "-_"))), F.substring(F.sha2(slug, 256), 1, 16))


def cache_digest(slug: Column, index: Column) -> Column:
    return F.substring(F.sha2(F.coalesce(missing(slug), F.concat(F.lit("identifier-"), index.cast("string"))), 256), 1, 32)


def compose_cache_key(slug: Column, table: Column) -> Column:
    return F.concat_ws("::", slug, table)


def record_slug(doi: Column, pmid: Column, pmcid: Column, index: Column) -> Column:
    return slugify(F.coalesce(missing(doi), missing(pmid), missing(pmcid), F.concat(F.lit("record-"), index.cast("string"))))


def table_number(label: Column) -> Column:
    return missing(F.regexp_extract(label, r"(\d+)", 1)).try_cast("int")


def coordinate_space(guess: Column) -> Column:
    g = F.upper(strip(guess))
    return F.when(g == "MNI", "MNI").when(g.isin("TAL", "TALAIRACH"), "TAL").otherwise("OTHER")


def statistic_kind(kind: Column) -> Column:
    """Exact names first, then parts of the name in this order; null stays null."""
    k = F.lower(strip(kind))
    exact = F.upper(k)
    return (
        F.when(missing(k).isNull(), F.lit(None))
        .when(exact.isin("Z", "T", "F", "R", "P", "B", "OTHER"), exact)
        .when(k.contains("z"), "Z")
        .when(k.contains("t"), "T")
        .when(k.contains("f"), "F")
        .when(k.contains("r"), "R")
        .when(k.startswith("p"), "P")
        .otherwise("OTHER")
    )


def cluster_size(c: Column) -> Column:
    return F.abs(c.try_cast("int"))


def cluster_measure(c: Column) -> Column:
    m = F.lower(strip(c))
    return F.when(m == "voxels", "voxels").when(m.isin("mm^3", "mm3"), "mm^3")


def file_type(path: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in FILE_TYPES.items() for x in pair))
    return F.coalesce(F.element_at(table, F.lower(F.regexp_extract(path, r"(\.[A-Za-z0-9]+)$", 1))), F.lit(DEFAULT_FILE_TYPE))


def file_extension(fmt: Column, content_type: Column) -> Column:
    kind = F.lower(strip(F.split_part(content_type, F.lit(";"), F.lit(1))))
    known = F.when(kind.isin("text/xml", "application/xml"), "xml").when(kind == "application/json", "json").when(kind == "text/html", "html").when(kind == "application/pdf", "pdf").when(kind == "text/plain", "txt")
    return F.coalesce(missing(F.lower(fmt)), known, F.lit("bin"))


def strip_nul(c: Column) -> Column:
    return F.replace(c, F.lit("\x00"), F.lit(""))


def year_of(value: Column) -> Column:
    """The leading year of a date, else the first 19xx or 20xx in it."""
    lead = F.when(F.substring(value, 1, 4).rlike(r"^\d{4}$"), F.substring(value, 1, 4).try_cast("int"))
    return F.coalesce(lead, missing(F.regexp_extract(value, r"((?:19|20)\d{2})", 1)).try_cast("int"))


def year_before_dash(value: Column) -> Column:
    head = F.split_part(value, F.lit("-"), F.lit(1))
    return F.when(head.rlike(r"^\d{1,9}$"), head.try_cast("int"))


def pmcid_from_path(path: Column) -> Column:
    """PMCnnn of the last part of a path that names one."""
    found = missing(F.regexp_extract(path, r"(?i).*(?:^|/)pmc(?:id_)?(\d+)(?:\.[^/]*)?(?:/|$)", 1))
    return F.when(found.isNotNull(), F.concat(F.lit("PMC"), found))


def pmcid_digits(c: Column) -> Column:
    bare = F.regexp_replace(F.upper(strip(c)), "PMC", "")
    return F.when(bare.rlike(r"^\d{1,18}$"), bare.try_cast("bigint").cast("string"))


def placeholder_title(doi: Column, pmid: Column, pmcid: Column, slug: Column) -> Column:
    return F.coalesce(missing(doi), missing(pmid), missing(pmcid), slug)


def analysis_base_name(name: Column, label: Column, title: Column, table_id: Column) -> Column:
    own = F.when(F.upper(strip(name)) != "UNKNOWN", missing(name))
    return F.coalesce(own, missing(label), missing(title), missing(table_id), F.lit("analysis"))


def lookup_key(doi: Column, pmid: Column) -> Column:
    return F.struct(missing(F.lower(strip(doi))).alias("doi"), missing(strip(pmid)).alias("pmid"))


def number(c: Column) -> Column:
    """A double where the text is a plain number; else null."""
    return F.when(strip(c).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), strip(c).try_cast("double"))


def abstract_text(sections: Column) -> Column:
    """array<struct<label, text>> to sections `Label: text`, a blank line between them; null if nothing is left."""
    lines = F.transform(sections, lambda s: F.when(missing(s["label"]).isNotNull(), F.concat(s["label"], F.lit(": "), s["text"])).otherwise(s["text"]))
    return missing(F.array_join(F.filter(lines, lambda x: missing(x).isNotNull()), "\n\n"))


def author_names(authors: Column) -> Column:
    """array<struct<collective, fore, initials, last>> to names; the nameless go."""
    name = lambda a: F.coalesce(missing(a["collective"]), missing(F.concat_ws(" ", F.coalesce(missing(a["fore"]), missing(a["initials"])), missing(a["last"]))))
    return F.filter(F.transform(authors, name), lambda x: x.isNotNull())


def html_verdict(html: Column) -> Column:
    """Why a saved page can't be used, the first of these reasons; null if it can."""
    low = F.lower(html)
    return (
        F.when(missing(strip(html)).isNull(), "empty")
        .when(~low.contains("<html"), "no html tag")
        .when(low.contains("opens in new tab") | low.contains("rate limit") | low.contains("captcha") | low.contains("access denied"), "blocked")
        .when(F.length(strip(html)) < 500, "too short")
    )


def get_item(fields: dict[str, Column], other: Column, key: str) -> Column:
    """Case-insensitive access to fixed identifier columns, else the overflow map."""
    name = key.strip().lower()
    return fields[name] if name in fields else F.element_at(other, F.lit(name))


def as_list(c: Column) -> Column:
    """JSON text to a list of JSON texts: an array's items, nothing for null, else the value alone."""
    v = F.try_parse_json(c)
    kind = F.schema_of_variant(v)
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.to_json(x))
    return F.when(c.isNull() | (kind == "VOID"), F.array().cast("array<string>")).when(kind.startswith("ARRAY"), items).otherwise(F.array(c))


def node_text(c: Column) -> Column:
    """The text of a JSON value made from XML: a string itself, the #text of an object, else its texts joined."""
    v = F.try_parse_json(c)
    kind = F.schema_of_variant(v)
    own = F.try_variant_get(v, "$['#text']", "string")
    parts = F.map_values(F.from_json(c, "map<string,string>"))
    joined = F.array_join(F.filter(parts, lambda x: missing(x).isNotNull()), " ")
    return F.when(c.isNull() | (kind == "VOID"), "").when(kind == "STRING", F.try_variant_get(v, "$", "string")).when(kind.startswith("OBJECT"), F.coalesce(own, joined)).otherwise(F.coalesce(F.try_variant_get(v, "$", "string"), c))


def identifier_payload(neurostore: Column, pmid: Column, doi: Column, pmcid: Column, other_ids: Column) -> Column:
    """Identifier JSON without nulls and the text 'null'; other_ids is always there."""
    present = lambda c, name: F.when(c != "null", c).alias(name)
    other = F.coalesce(other_ids, F.create_map().cast("map<string,string>"))
    return F.to_json(F.struct(present(neurostore, "neurostore"), present(pmid, "pmid"), present(doi, "doi"), present(pmcid, "pmcid"), other.alias("other_ids")))


def identifier_key(neurostore: Column, doi: Column, pmid: Column, pmcid: Column, record: Column) -> Column:
    """(field, value) of the first present identifier, else the whole record's JSON."""
    pair = lambda name, c: F.when(missing(c).isNotNull(), F.struct(F.lit(name).alias("field"), c.alias("value")))
    return F.coalesce(pair("neurostore", neurostore), pair("doi", doi), pair("pmid", pmid), pair("pmcid", pmcid), F.struct(F.lit("json").alias("field"), F.to_json(record).alias("value")))


def first_text(json: Column, *names: str, default: Column | None = None) -> Column:
    """The first present field of a JSON object, as text."""
    found = [missing(F.get_json_object(json, f"$['{n}']")) for n in names]
    return F.coalesce(*found, default if default is not None else F.lit(None).cast("string"))


def pub_year(year: Column, medline_date: Column) -> Column:
    """The year of a publication date: the first four characters of its year, else a year in its free date."""
    return F.coalesce(F.when(F.substring(year, 1, 4).rlike(r"^\s*\d+\s*$"), F.substring(year, 1, 4).try_cast("int")), missing(F.regexp_extract(medline_date, r"((?:19|20)\d{2})", 1)).try_cast("int"))


def pmcid_of(path: Column, article_xml: Column) -> Column:
    """PMCnnn of a path that names one, else of the article's own id."""
    own = missing(strip(F.xpath_string(article_xml, F.lit("//article-id[@pub-id-type='pmcid']/text()"))))
    up = F.upper(own)
    return F.coalesce(pmcid_from_path(path), F.when(up.startswith("PMC"), up).otherwise(F.concat(F.lit("PMC"), up)))


def table_prompt(instructions: Column, title: Column, abstract: Column, table_id: Column, number: Column, caption: Column, footer: Column, metadata: Column, content: Column) -> Column:
    """The request text of one table: instructions, then the article's and the table's fields, metadata by sorted key."""
    pairs = F.map_from_entries(F.array_sort(F.map_entries(F.coalesce(metadata, F.create_map().cast("map<string,string>")))))
    line = lambda name, c: F.concat(F.lit(f"{name}: "), F.coalesce(c.cast("string"), F.lit("")))
    fields = [line("Title", title), line("Abstract", abstract), line("Table", table_id), line("Number", number), line("Caption", caption), line("Footer", footer), line("Metadata", F.to_json(pairs))]
    return strip(F.concat_ws("\n", instructions, F.lit(""), *fields, F.lit(""), F.lit("Content:"), F.coalesce(content, F.lit(""))))
