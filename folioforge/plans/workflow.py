"""The stages after gathering, as DataFrame steps: extraction, analyses, upload and sync over cached and new rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import cols, model, predicates
from folioforge.operators import relational as rel
from folioforge.operators import store as st
from folioforge.plans import stages
from folioforge.sources import articles, providers


def hydrate(settings: stages.Settings, state: stages.State, manifest: Callable[[], DataFrame | None], cached: dict[str, Callable[[], DataFrame]]) -> list[str]:
    """Fills state with the inputs of stages that don't run; returns what could not be had.

    Identifiers come from the manifest, which must exist where gathering doesn't run; downloads, bundles and
    analyses from the cache, if cached inputs may be used.
    """
    wanted = stages.normalize_stages(settings.stages)
    missing = []
    if "gather" not in wanted and "gather" not in state.frames:
        found = manifest()
        if found is None:
            raise FileNotFoundError("a manifest is needed where gathering doesn't run")
        state.frames["gather"] = stages.normalize(found)
    for stage in ("download", "extract", "create_analyses"):
        if stage in wanted or stage in state.frames or stage not in cached:
            continue
        if settings.use_cached_inputs and stage not in settings.ignore_cache:
            state.frames[stage] = cached[stage]()
        else:
            missing.append(stage)
    return missing


def restore_order(requests: DataFrame, results: DataFrame, hole: Callable[[DataFrame], DataFrame], key: str = "slug") -> DataFrame:
    """results in the order of requests (pos, key), each request once; a request without a result is what hole gives."""
    one = results.dropDuplicates([key])
    holes = hole(requests.join(one.select(key), key, "left_anti"))
    return one.unionByName(holes.select(*one.columns)).join(requests.select(key, "pos"), key)


def run_extraction(downloads: DataFrame, cached: DataFrame, paths: DataFrame | None = None, extract: Callable[[DataFrame], DataFrame] = articles.extract) -> tuple[DataFrame, DataFrame]:
    """(contents with pos, new contents) of downloads (pos, slug, source, identifier, files).

    Cached contents count while their files stand in paths; the rest is extracted. A download without a result
    gives a failure row.
    """
    valid = cached if paths is None else predicates.existing_extractions(cached, paths)
    hits = valid.join(downloads.select("slug", "source"), ["slug", "source"], "left_semi")
    misses = downloads.join(hits.select("slug", "source"), ["slug", "source"], "left_anti")
    fresh = extract(misses.drop("pos"))
    columns = fresh.columns
    both = hits.select(*columns).unionByName(fresh)
    lost = lambda left: articles.failures(left, "none", "no result").withColumn("source", F.lit(None).cast("string"))
    return restore_order(downloads.dropDuplicates(["slug"]), both, lost), fresh


def bundles(contents: DataFrame, metadata: DataFrame) -> DataFrame:
    """(slug, content, metadata): each content with its metadata, or with a title made from its identifier."""
    i = F.col("identifier")
    title = F.coalesce(cols.missing(i["doi"]), cols.missing(i["pmid"]), cols.missing(i["pmcid"]), F.col("slug"))
    rows = contents.join(metadata.select("slug", "metadata"), "slug", "left")
    names = [f.split(":")[0] for f in ("slug", "source", "identifier", "full_text", "tables", "has_coordinates", "error_message")]
    return rows.select("slug", F.struct(*names).alias("content"), F.coalesce("metadata", providers._metadata(title=title)).alias("metadata"))


def pending_tables(bundles_: DataFrame, instructions: str) -> DataFrame:
    """(article_slug, pos, table_key, sanitized, key, prompt, table, identifier): tables that bear coordinates."""
    t = F.col("table")
    rows = bundles_.select(F.col("slug").alias("article_slug"), "content.identifier", "metadata", F.posexplode("content.tables").alias("pos", "table")).filter(predicates.with_coordinates(t["coordinates"]))
    stem = cols.sanitize_table_id(t["table_id"], F.col("pos"))
    text = cols.table_prompt(F.lit(instructions), F.col("metadata.title"), F.col("metadata.abstract"), F.coalesce(cols.missing(t["table_id"]), stem), t["table_number"], t["caption"], t["footer"], t["metadata"], t["metadata"]["raw"])
    return rows.select("article_slug", "pos", F.coalesce(cols.missing(t["table_id"]), stem).alias("table_key"), stem.alias("sanitized"), cols.compose_cache_key(F.col("article_slug"), stem).alias("key"), text.alias("prompt"), "table", "identifier")


def build_collections(pending: DataFrame, replies: DataFrame) -> DataFrame:
    """model.RESULT rows with pos from pending tables and replies (key, arguments); a table without a reply, and a reply
    without a table, are left out. An analysis without a name is `<table> analysis <n>`."""
    parsed = providers.parse_analyses(replies)
    per = parsed.groupBy("key").agg(rel.in_order(F.collect_list(F.struct("place", "name", "description", "points")), "place").alias("as"))
    rows = pending.join(replies.select("key").distinct(), "key").join(per, "key", "left")
    t = F.col("table")
    space = F.coalesce(t["space"], F.lit("OTHER"))

    def analysis(a: Column, i: Column) -> Column:
        name = F.coalesce(cols.missing(a["name"]), F.concat(F.col("table_key"), F.lit(" analysis "), (i + 1).cast("string")))
        meta = F.map_concat(F.map_filter(F.coalesce(t["metadata"], F.create_map().cast("map<string,string>")), lambda k, _: k != "sanitized_table_id"), F.create_map(F.lit("sanitized_table_id"), F.col("sanitized")))
        return F.struct(name.alias("name"), a["description"].alias("description"), providers.with_space(a["points"], space).alias("coordinates"), F.col("table_key").alias("table_id"), t["table_number"].alias("table_number"), F.coalesce(t["caption"], F.lit("")).alias("table_caption"), F.coalesce(t["footer"], F.lit("")).alias("table_footer"), meta.alias("metadata"))

    analyses = F.coalesce(F.transform("as", analysis), F.array()).cast(f"array<{model.ANALYSIS}>")
    collection = F.struct(F.col("key").alias("slug"), space.alias("coordinate_space"), F.col("identifier"), analyses.alias("analyses")).cast(model.COLLECTION)
    return rows.select(F.col("key").alias("slug"), "article_slug", F.col("table_key").alias("table_id"), F.col("sanitized").alias("sanitized_table_id"), collection.alias("collection"), F.lit(None).cast("string").alias("error_message"), F.col("pos").cast("long").alias("pos"))


def run_create_analyses(bundles_: DataFrame, replies: DataFrame, cached: DataFrame, instructions: str = "") -> tuple[DataFrame, DataFrame]:
    """(results, new results): cached results of the tables that are asked for, and those of the replies for the rest."""
    pending = pending_tables(bundles_, instructions)
    hits = cached.join(pending.select(F.col("key").alias("slug")), "slug", "left_semi")
    fresh = build_collections(pending.join(hits.select(F.col("slug").alias("key")), "key", "left_anti"), replies)
    return hits.select(*fresh.columns).unionByName(fresh), fresh


def collections_by_article(results: DataFrame) -> DataFrame:
    """(article_slug, tables): each article's tables to their collections; the last of a table counts."""
    last = rel.keep_last(results.filter("collection IS NOT NULL"), ["article_slug", "table_id"])
    pairs = rel.in_order(F.collect_list(F.struct("pos", "table_id", "collection")))
    return last.groupBy("article_slug").agg(F.map_from_entries(F.transform(pairs, lambda s: F.struct(s["table_id"], s["collection"]))).alias("tables"))


def first_present(priority: list[DataFrame], key: str = "slug") -> DataFrame:
    """Rows of the first table, and of each later one those whose key no table before it has."""
    out = priority[0]
    for more in priority[1:]:
        out = out.unionByName(more.join(out.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)
    return out


def resolve(targets: DataFrame, rows: DataFrame) -> DataFrame:
    """rows (slug, ...) that any name of a target identifier row names, with the target's slug as target."""
    names = rel.explode_aliases(targets).withColumnRenamed("slug", "target")
    return rows.join(names, rows["slug"] == names["alias"]).drop("alias").distinct()


def failure_reasons(results: DataFrame) -> DataFrame:
    """(slug, reason): the reasons of rows (slug, pos, error_message) that failed, in order."""
    bad = results.filter(cols.missing(F.col("error_message")).isNotNull())
    ordered = F.array_sort(F.collect_list(F.struct("pos", "error_message")))
    return bad.groupBy("slug").agg(F.array_join(F.transform(ordered, lambda s: s["error_message"]), " | ").alias("reason"))


def run_upload(results: DataFrame, metadata: DataFrame, store: dict[str, DataFrame], targets: DataFrame | None = None, **how) -> tuple[dict[str, DataFrame], DataFrame]:
    """store.upload of the results' articles, only those that the target identifiers name if any are given."""
    rows = results.filter("collection IS NOT NULL")
    if targets is not None:
        rows = rows.join(rel.explode_aliases(targets).select(F.col("alias").alias("article_slug")).distinct(), "article_slug", "left_semi")
    return st.upload(st.work_items(rows, metadata), store, **how)


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) of some tables."""
    return reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("rows")).withColumn("table", F.lit(name)) for name, df in tables.items()))
