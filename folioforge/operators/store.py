"""The relational store: base studies, studies, tables, analyses, points and point values as DataFrames.

upload() takes work items and the store's tables and returns the tables after it and an outcome an item. Keys are
digests of what they stand for, so a repeated run gives the same keys. Items that break a contract are routed to
failed outcomes before anything is written, which stands for a savepoint an item; save() writes all tables to a
staging folder and renames it, which stands for the transaction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import cols, model
from folioforge.operators import relational as rel

#: The store's tables and columns.
STUDY_FIELDS = ["name", "description", "publication", "doi", "pmid", "pmcid", "authors", "year"]
_STUDY = "name string, description string, publication string, doi string, pmid string, pmcid string, authors string, year string, metadata map<string,string>"
TABLES = {
    "base_studies": f"id string, {_STUDY}, is_oa boolean, level string, public boolean, has_coordinates boolean, created_at timestamp",
    "studies": f"id string, base_study_id string, {_STUDY}, source string, level string, source_updated_at timestamp",
    "tables": "id string, study_id string, t_id string, name string, label string, caption string, footer string, metadata map<string,string>",
    "analyses": "id string, study_id string, table_id string, name string, description string, metadata map<string,string>, `order` int",
    "points": "id string, analysis_id string, x double, y double, z double, space string, cluster_size int, subpeak boolean, deactivation boolean, `order` int",
    "point_values": "id string, point_id string, kind string, value double",
}
#: A work item: an article's identifier, metadata and flattened analyses in order.
PREPARED = f"array<struct<table_id:string,label:string,title:string,caption:string,footer:string,table_metadata:map<string,string>,space:string,analysis:{model.ANALYSIS}>>"
ITEM = f"slug string, identifier {model.IDENTIFIER}, study struct<name:string,description:string,publication:string,doi:string,pmid:string,pmcid:string,authors:string,year:string,is_oa:boolean,metadata:map<string,string>>, analyses {PREPARED}, pos long"
OUTCOME = "slug string, base_study_id string, study_id string, analysis_ids array<string>, success boolean, error string"


def empty(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}


def load(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in TABLES.items()}


def save(store: dict[str, DataFrame], path: str) -> None:
    """All tables or none: written beside path, then renamed. path must not exist."""
    spark = store["studies"].sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = where(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(where(path)):
        raise ValueError(f"{path} exists")
    staging = f"{path}.staging"
    for name, df in store.items():
        df.write.mode("overwrite").parquet(f"{staging}/{name}")
    if not fs.rename(where(staging), where(path)):
        raise RuntimeError(f"could not rename {staging}")


def _clean(c: Column) -> Column:
    return cols.strip_nul(c)


def study_fields(identifier: Column, metadata: Column, slug: Column) -> Column:
    """A study's fields from an identifier and a metadata struct, either of which may be null."""
    names = F.filter(F.transform(metadata["authors"], lambda a: a["name"]), lambda n: cols.missing(n).isNotNull())
    stash = F.map_filter(
        F.create_map(F.lit("keywords"), F.when(F.size(metadata["keywords"]) > 0, F.to_json(metadata["keywords"])), F.lit("license"), metadata["license"], F.lit("source"), metadata["source"], F.lit("slug"), slug),
        lambda _, v: cols.missing(v).isNotNull(),
    )
    fields = {"name": metadata["title"], "description": metadata["abstract"], "publication": metadata["journal"], "doi": identifier["doi"], "pmid": identifier["pmid"], "pmcid": identifier["pmcid"], "authors": cols.missing(F.array_join(names, "; ")), "year": metadata["publication_year"].cast("string")}
    return F.struct(*(_clean(v).alias(k) for k, v in fields.items()), metadata["open_access"].alias("is_oa"), stash.alias("metadata"))


def work_items(collections: DataFrame, metadata: DataFrame) -> DataFrame:
    """ITEM rows from collections (article_slug, pos, collection) and metadata (slug, metadata); articles without a
    collection are absent. The identifier is the first one that an article's collections have."""
    c = F.col("collection")
    ordered = rel.in_order(F.collect_list(F.struct("pos", "collection")))
    rows = collections.groupBy(F.col("article_slug").alias("slug")).agg(F.min_by(c["identifier"], F.when(c["identifier"].isNotNull(), F.col("pos"))).alias("identifier"), ordered.alias("cs"), F.min("pos").alias("pos"))

    def prepared(s: Column) -> Column:
        def one(a: Column, i: Column) -> Column:
            stem = a["metadata"]["sanitized_table_id"]
            table_id = F.coalesce(cols.missing(_clean(F.coalesce(cols.missing(a["table_id"]), cols.missing(stem)))), F.concat(F.lit("table-"), (i + 1).cast("string")))
            caption = F.coalesce(_clean(a["table_caption"]), F.lit(""))
            meta = F.map_filter(F.create_map(F.lit("table_number"), a["table_number"].cast("string"), F.lit("original_table_id"), a["table_id"]), lambda _, v: v.isNotNull())
            return F.struct(table_id.alias("table_id"), _clean(F.coalesce(cols.missing(stem), a["table_id"])).alias("label"), F.coalesce(cols.missing(caption), table_id).alias("title"), caption.alias("caption"), F.coalesce(_clean(a["table_footer"]), F.lit("")).alias("footer"), meta.alias("table_metadata"), s["collection"]["coordinate_space"].alias("space"), a.withField("name", _clean(a["name"])).withField("description", _clean(a["description"])).alias("analysis"))

        return F.transform(F.coalesce(s["collection"]["analyses"], F.array().cast(f"array<{model.ANALYSIS}>")), one)

    joined = rows.join(metadata.select("slug", "metadata"), "slug", "left")
    return joined.select("slug", "identifier", study_fields(F.col("identifier"), F.col("metadata"), F.col("slug")).alias("study"), F.flatten(F.transform("cs", prepared)).cast(PREPARED).alias("analyses"), "pos")


def _key(*parts: Column | str) -> Column:
    return F.substring(F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.lit(p) if isinstance(p, str) else p.cast("string"), F.lit("\x00")) for p in parts)), 256), 1, 24)


def match_base(items: DataFrame, bases: DataFrame) -> DataFrame:
    """items with base_study_id: the oldest base study of the doi, else of the pmid; null if there is none."""
    keyed = items.withColumn("doi", F.col("study.doi")).withColumn("pmid", F.col("study.pmid"))
    right = bases.select(F.col("id").alias("base_study_id"), "doi", "pmid", F.struct("created_at", "id").alias("pos"))
    found = rel.cascade_lookup(keyed, right, ["doi", "pmid"], ["base_study_id"])
    return found.select(*items.columns, F.col("hit_base_study_id").alias("base_study_id"))


def _merged(old: DataFrame, new: DataFrame, key: str, mode: str, extra: list[str]) -> DataFrame:
    """Rows of old with fields of new (key, study, ...) merged in by mode; rows of new without an old one are made."""
    incoming = new.select(F.col(key).alias("id"), F.col("study").alias("__s"), *(F.col(c).alias(f"__{c}") for c in extra))
    both = old.join(incoming, "id", "full")
    fields = {f: rel.merge_fields(F.col(f), F.col(f"__s.{f}"), mode).alias(f) for f in STUDY_FIELDS}
    blob = F.when(F.col("__s").isNull(), F.col("metadata")).otherwise(rel.merge_blob(F.col("metadata"), F.col("__s.metadata"), mode)).alias("metadata")
    return both.withColumn("__new", F.col("__s").isNotNull()).select("*", *(c.alias(f"__m_{n}") for n, c in fields.items()), blob.alias("__m_metadata"))


def upload(items: DataFrame, store: dict[str, DataFrame], behavior: str = "UPDATE", mode: str = "FILL", metadata_only: bool = False, source: str = "llm", run: str = "") -> tuple[dict[str, DataFrame], DataFrame]:
    """(store, outcomes) after work items.

    behavior UPDATE replaces a study's tables, analyses and points, INSERT_NEW makes another study (run keeps its key
    apart). mode FILL keeps present fields, OVERWRITE takes present new ones. metadata_only writes no analyses.
    Items that name the same doi or pmid share a base study: that of the first of them.
    """
    bad = F.exists("analyses", lambda p: F.exists(p["analysis"]["coordinates"], lambda c: c["x"].isNull() | c["y"].isNull() | c["z"].isNull()))
    broken = items.filter(F.coalesce(bad, F.lit(False)) | cols.missing(F.col("slug")).isNull())
    good = rel.keep_last(items.filter(~F.coalesce(bad, F.lit(False)) & cols.missing(F.col("slug")).isNotNull()), ["slug"])

    matched = match_base(good, store["base_studies"])
    # A new base study is named by its doi, else its pmid, else its slug.
    made = _key("base", F.coalesce(cols.missing(F.col("study.doi")), cols.missing(F.col("study.pmid")), F.col("slug")))
    matched = matched.withColumn("base_study_id", F.coalesce("base_study_id", made))
    study_id = _key("study", F.col("base_study_id"), source, *([F.col("slug"), run] if behavior == "INSERT_NEW" else []))
    old_study = store["studies"].filter(F.col("source") == source).groupBy(F.col("base_study_id").alias("__b")).agg(F.min_by("id", F.struct("source_updated_at", "id")).alias("__study"))
    if behavior == "INSERT_NEW":
        matched = matched.withColumn("study_id", study_id)
    else:
        matched = matched.join(old_study, F.col("base_study_id") == F.col("__b"), "left").withColumn("study_id", F.coalesce("__study", study_id)).drop("__b", "__study")
    # Several items of one study: the last one's fields and content, as if one came after another.
    last = rel.keep_last(matched, ["base_study_id"])
    has = F.size("analyses") > 0
    now = F.current_timestamp()

    base = _merged(store["base_studies"], last.withColumn("has", has), "base_study_id", mode, ["has"])
    oa = F.col("__s.is_oa")
    is_oa = F.coalesce(oa, F.col("is_oa")) if mode == "OVERWRITE" else F.coalesce("is_oa", oa)
    flag = F.when(F.col("__has") & F.lit(not metadata_only), F.lit(True)).otherwise(F.col("has_coordinates"))
    bases = base.select("id", *(F.col(f"__m_{f}").alias(f) for f in [*STUDY_FIELDS, "metadata"]), is_oa.alias("is_oa"), F.when(F.col("__new"), "group").otherwise(F.col("level")).alias("level"), F.coalesce("public", F.lit(True)).alias("public"), flag.alias("has_coordinates"), F.coalesce("created_at", now).alias("created_at"))
    study = _merged(store["studies"], last, "study_id", mode, ["base_study_id"])
    studies = study.select("id", F.coalesce("base_study_id", "__base_study_id").alias("base_study_id"), *(F.col(f"__m_{f}").alias(f) for f in [*STUDY_FIELDS, "metadata"]), F.coalesce("source", F.lit(source)).alias("source"), F.when(F.col("__new"), "group").otherwise(F.col("level")).alias("level"), F.when(F.col("__new"), now).otherwise(F.col("source_updated_at")).alias("source_updated_at"))

    flat = last.select("study_id", "base_study_id", F.posexplode("analyses").alias("i", "p")).select("study_id", "i", "p.*")
    tables = upsert_tables(store["tables"], flat, mode, replace=behavior == "UPDATE" and not metadata_only)
    out = {"base_studies": bases, "studies": studies, "tables": tables}
    ids = flat.select("study_id", "i", _key("analysis", F.col("study_id"), F.col("i")).alias("id"))
    if metadata_only:
        out |= {n: store[n] for n in ("analyses", "points", "point_values")}
        listed = matched.select("slug", "base_study_id", "study_id", F.array().cast("array<string>").alias("analysis_ids"))
    else:
        kept = clear_content(store, last.select("study_id").distinct()) if behavior == "UPDATE" else store
        fresh = content(flat)
        out |= {n: kept[n].unionByName(fresh[n]) for n in ("analyses", "points", "point_values")}
        per = ids.groupBy("study_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "id"))), lambda s: s["id"]).alias("analysis_ids"))
        listed = matched.join(per, "study_id", "left").select("slug", "base_study_id", "study_id", F.coalesce("analysis_ids", F.array().cast("array<string>")).alias("analysis_ids"))
    done = listed.withColumns({"success": F.lit(True), "error": F.lit(None).cast("string")})
    failed = broken.select("slug", *(F.lit(None).cast("string").alias(c) for c in ("base_study_id", "study_id")), F.array().cast("array<string>").alias("analysis_ids"), F.lit(False).alias("success"), F.lit("a coordinate or the slug is missing").alias("error"))
    return {n: out[n].select(*store[n].columns) for n in TABLES}, done.unionByName(failed)


def clear_content(store: dict[str, DataFrame], studies: DataFrame) -> dict[str, DataFrame]:
    """The store without the analyses, points and point values of some studies (study_id)."""
    gone = store["analyses"].join(studies, "study_id", "left_semi").select(F.col("id").alias("analysis_id"))
    points = store["points"].join(gone, "analysis_id", "left_semi").select(F.col("id").alias("point_id"))
    return store | {
        "analyses": store["analyses"].join(studies, "study_id", "left_anti"),
        "points": store["points"].join(gone, "analysis_id", "left_anti"),
        "point_values": store["point_values"].join(points, "point_id", "left_anti"),
    }


def upsert_tables(old: DataFrame, flat: DataFrame, mode: str, replace: bool) -> DataFrame:
    """Tables after prepared analyses (study_id, i, table_id, ...): key (study_id, t_id); the first analysis names it."""
    first = rel.keep_first(flat, ["study_id", "table_id"], "i").select(_key("table", F.col("study_id"), F.col("table_id")).alias("__id"), F.col("study_id").alias("__study"), F.col("table_id").alias("__t"), *(F.col(c).alias(f"__{c}") for c in ("title", "label", "caption", "footer", "table_metadata")))
    kept = old.join(flat.select("study_id").distinct(), "study_id", "left_anti") if replace else old
    both = kept.join(first, (kept["study_id"] == F.col("__study")) & (kept["t_id"] == F.col("__t")), "full")
    merge = lambda a, b: rel.merge_fields(F.col(a), F.col(b), mode).alias(a)
    blob = F.when(F.col("__t").isNull(), F.col("metadata")).otherwise(rel.merge_blob(F.col("metadata"), F.col("__table_metadata"), mode))
    return both.select(F.coalesce("id", "__id").alias("id"), F.coalesce("study_id", "__study").alias("study_id"), F.coalesce("t_id", "__t").alias("t_id"), merge("name", "__title"), merge("label", "__label"), merge("caption", "__caption"), merge("footer", "__footer"), blob.alias("metadata"))


def content(flat: DataFrame) -> dict[str, DataFrame]:
    """Analyses, points and point values of prepared analyses (study_id, i, table_id, ..., analysis)."""
    a = F.col("analysis")
    base = cols.analysis_base_name(a["name"], F.col("label"), F.col("title"), F.col("table_id"))
    named = rel.name_with_suffix(flat.withColumn("base", base), "study_id", "base", "i")
    keyed = named.withColumn("id", _key("analysis", F.col("study_id"), F.col("i")))
    analyses = keyed.select("id", "study_id", _key("table", F.col("study_id"), F.col("table_id")).alias("table_id"), "name", F.coalesce(cols.missing(a["description"]), F.col("caption"), F.lit("")).alias("description"), F.map_concat(F.map_filter(F.coalesce(a["metadata"], F.create_map().cast("map<string,string>")), lambda k, _: k != "table"), F.create_map(F.lit("table"), F.to_json("table_metadata"))).alias("metadata"), (F.col("i") + 1).cast("int").alias("order"))
    exploded = keyed.select(F.col("id").alias("analysis_id"), F.col("space").alias("__space"), F.posexplode("analysis.coordinates").alias("k", "c")).withColumn("id", _key("point", F.col("analysis_id"), F.col("k")))
    points = exploded.select("id", "analysis_id", "c.x", "c.y", "c.z", F.coalesce("c.space", "__space").alias("space"), "c.cluster_size", F.col("c.is_subpeak").alias("subpeak"), F.col("c.is_deactivation").alias("deactivation"), (F.col("k") + 1).cast("int").alias("order"))
    values = exploded.filter(cols.missing(F.col("c.statistic_type")).isNotNull() | F.col("c.statistic_value").isNotNull())
    return {"analyses": analyses, "points": points, "point_values": values.select(_key("value", F.col("id")).alias("id"), F.col("id").alias("point_id"), F.col("c.statistic_type").alias("kind"), F.col("c.statistic_value").alias("value"))}


def violations(store: dict[str, DataFrame]) -> DataFrame:
    """(rule, key) of rows that break a key or a reference; empty in a sound store."""
    def twice(name: str, *keys: str) -> DataFrame:
        return store[name].groupBy(*keys).count().filter("count > 1").select(F.lit(f"{name} {'+'.join(keys)} repeats").alias("rule"), F.concat_ws("/", *(F.col(k).cast("string") for k in keys)).alias("key"))

    def dangling(name: str, key: str, target: str) -> DataFrame:
        rows = store[name].filter(F.col(key).isNotNull())
        return rows.join(store[target].select(F.col("id").alias(key)), key, "left_anti").select(F.lit(f"{name}.{key} dangles").alias("rule"), F.col(key).alias("key"))

    checks = [*(twice(n, "id") for n in TABLES), twice("tables", "study_id", "t_id"), dangling("studies", "base_study_id", "base_studies"), dangling("tables", "study_id", "studies"), dangling("analyses", "study_id", "studies"), dangling("analyses", "table_id", "tables"), dangling("points", "analysis_id", "analyses"), dangling("point_values", "point_id", "points")]
    return reduce(DataFrame.unionByName, checks)
