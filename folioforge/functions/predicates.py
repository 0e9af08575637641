"""Filters of the pipeline as boolean columns; a null row or field counts as missing, and no predicate is null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import cols

#: The kinds of a statistic.
KINDS = ("Z", "T", "F", "R", "P", "B", "OTHER")
#: Identifiers that each download source can use.
SUPPORTS = {"pubget": ("pmcid",), "elsevier": ("pmid", "doi"), "ace": ("pmid",)}
#: Identifiers that each lookup provider takes.
LOOKUPS = {"pubmed": ("pmid", "pmcid", "doi"), "semantic_scholar": ("doi", "pmid"), "openalex": ("doi", "pmid")}


def text(c: Column) -> Column:
    """Whether a text is there, blanks aside."""
    return cols.missing(cols.strip(c)).isNotNull()


def some(c: Column) -> Column:
    """Whether an array or map holds anything."""
    return F.coalesce(F.size(c) > 0, F.lit(False))


def _fields(m: Column, trimmed: bool) -> dict[str, Column]:
    there = text if trimmed else (lambda c: cols.missing(c).isNotNull())
    return {
        "title": text(m["title"]),
        "authors": some(m["authors"]),
        "abstract": there(m["abstract"]),
        "journal": there(m["journal"]),
        "publication_year": m["publication_year"].isNotNull(),
        "keywords": some(m["keywords"]),
        "license": there(m["license"]),
        "source": there(m["source"]) if trimmed else m["source"].isNotNull(),
        "open_access": m["open_access"].isNotNull(),
    }


def _any(parts: Sequence[Column]) -> Column:
    return F.coalesce(F.exists(F.array(*parts), lambda x: x), F.lit(False))


def useful_metadata(m: Column) -> Column:
    """Any of the nine fields of a metadata struct."""
    return _any(list(_fields(m, trimmed=False).values()))


def substantive_metadata(m: Column) -> Column:
    """More than a title: any other field, or raw metadata."""
    parts = _fields(m, trimmed=True)
    del parts["title"]
    return _any([*parts.values(), some(m["raw_metadata"])])


def complete_metadata(m: Column) -> Column:
    return F.coalesce(F.forall(F.array(*_fields(m, trimmed=True).values()), lambda x: x), F.lit(False))


def needs_more_metadata(m: Column) -> Column:
    return m.isNull() | ~complete_metadata(m)


def complete_ids(pmid: Column, doi: Column, pmcid: Column) -> Column:
    return F.coalesce(*(cols.missing(c) for c in (pmid, doi, pmcid))).isNotNull() & _all(pmid, doi, pmcid)


def _all(*ids: Column) -> Column:
    return F.forall(F.array(*(cols.missing(c).isNotNull() for c in ids)), lambda x: x)


def supported(source: str, fields: dict[str, Column]) -> Column:
    """Whether an identifier has a field that the source can use."""
    return _any([cols.missing(fields[n]).isNotNull() for n in SUPPORTS[source]])


def payload_present(source: Column, files: Column) -> Column:
    """Whether a download's files hold what its source's extractor reads."""
    base = lambda f: F.regexp_extract(f["file_path"], "([^/]*)$", 1)
    has = lambda kind, ok: F.exists(files, lambda f: (f["file_type"] == kind) & ok(base(f)))
    found = (
        F.when(source == "ace", has("html", lambda n: F.lit(True)))
        .when(source == "pubget", has("xml", lambda n: n == "article.xml") & has("xml", lambda n: n == "tables.xml"))
        .when(source == "elsevier", has("xml", lambda n: n.startswith("content.")) & has("json", lambda n: n == "metadata.json"))
    )
    return F.coalesce(found, F.lit(False))


def successful_downloads(downloads: DataFrame, paths: DataFrame) -> DataFrame:
    """Downloads (key, success, files, ...) that succeeded, have files, and whose files all stand in paths (path)."""
    good = downloads.filter("success AND size(files) > 0").withColumn("__n", F.monotonically_increasing_id())
    wanted = good.select("__n", F.explode("files.file_path").alias("path"))
    gone = wanted.join(paths.select("path"), "path", "left_anti").select("__n").distinct()
    return good.join(gone, "__n", "left_anti").drop("__n")


def existing_extractions(contents: DataFrame, paths: DataFrame) -> DataFrame:
    """Contents (slug, full_text_path, tables, ...) whose text and tables all stand in paths (path)."""
    rows = contents.withColumn("__n", F.monotonically_increasing_id())
    raw = F.transform(F.coalesce(F.col("tables"), F.array()), lambda t: t["raw_content_path"])
    wanted = rows.select("__n", F.explode(F.concat(F.array("full_text_path"), raw)).alias("path")).filter("path IS NOT NULL")
    gone = wanted.join(paths.select("path"), "path", "left_anti").select("__n").distinct()
    return rows.join(gone, "__n", "left_anti").drop("__n")


def with_coordinates(coordinates: Column) -> Column:
    """Whether a table bears coordinates: by its list, not by any flag."""
    return some(coordinates)


def valid_point(coordinates: Column) -> Column:
    """Exactly three numbers."""
    return F.coalesce((F.size(coordinates) == 3) & F.forall(coordinates, lambda c: c.isNotNull()), F.lit(False))


def valid_row(x: Column, y: Column, z: Column) -> Column:
    """Three texts that are plain numbers."""
    return _any([_numbers(x, y, z)])


def _numbers(*parts: Column) -> Column:
    return F.forall(F.array(*(cols.number(p) for p in parts)), lambda c: c.isNotNull() & ~F.isnan(c))


def known_kind(kind: Column) -> Column:
    return kind.isNull() | kind.isin(*KINDS)


def require(condition: Column, message: str) -> Column:
    """True, or an error that stops the query, where a row breaks a contract."""
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)))


def require_lookup_key(df: DataFrame, provider: str, id_type: str) -> DataFrame:
    """df, if the provider takes this kind of identifier and every row has one; else an error."""
    if id_type not in LOOKUPS[provider]:
        raise ValueError(f"{provider} doesn't take {id_type}")
    if not df.filter(cols.missing(F.col(id_type)).isNull()).isEmpty():
        raise ValueError(f"every row needs a {id_type}")
    return df


def can_run(provider: str, settings: dict[str, str | None]) -> bool:
    """Whether a provider has what it needs: a key for semantic_scholar, an address for the others."""
    return bool(settings.get("semantic_scholar_key" if provider == "semantic_scholar" else "email"))


def successful_outcomes(outcomes: DataFrame, aliases: DataFrame) -> DataFrame:
    """Outcomes that succeeded with a base study, of slugs among the aliases (alias)."""
    return outcomes.filter("success AND base_study_id IS NOT NULL").join(aliases.select(F.col("alias").alias("slug")).distinct(), "slug", "left_semi")
