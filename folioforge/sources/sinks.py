"""Sinks: JSON-lines manifests, per-article export trees, coordinate tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import cols, model
from folioforge.operators import relational as rel

#: The columns of a coordinates table, in order.
COORDINATE_COLUMNS = ["table_id", "table_label", "table_caption", "table_number", "x", "y", "z", "p_value", "region", "size", "statistic", "groups"]


def save_identifiers(df: DataFrame, path: str) -> None:
    """Overwrites path with JSON lines, nulls included."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_bundles(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """Rows (slug, source, ...) below path/slug=/source=; rows without a slug are skipped.

    With overwrite a bundle's folder is replaced; without it bundles that are there stay, and new ones are added.
    """
    _write_parts(df.filter("slug IS NOT NULL AND slug <> ''"), path, ["slug", "source"], overwrite, "json")


def _write_parts(df: DataFrame, path: str, parts: list[str], overwrite: bool, kind: str) -> None:
    if not overwrite:
        there = existing_parts(df.sparkSession, path, parts)
        if there is not None:
            on = [F.col(p).cast("string") == F.col(f"__{p}") for p in parts]
            df = df.join(there.toDF(*(f"__{p}" for p in parts)), on, "left_anti")
    writer = df.repartition(*parts).write.partitionBy(*parts)
    mode = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite") if overwrite else writer.mode("append")
    mode.option("ignoreNullFields", False).format(kind).save(path)


def existing_parts(spark: SparkSession, path: str, parts: list[str]) -> DataFrame | None:
    """The distinct part values below path, as text; None if there is nothing. Only file names are read."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    names = [_unescaped(F.regexp_extract("path", f"/{p}=([^/]*)/", 1)).alias(p) for p in parts]
    return files.select(*names).distinct()


def _unescaped(part: Column) -> Column:
    return F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))


def write_leaves(leaves: DataFrame, root: str, overwrite: bool = True) -> None:
    """Text leaves (slug, leaf, value) of article trees below root/slug=/leaf=; a leaf without a value is skipped."""
    _write_parts(leaves.filter("slug IS NOT NULL AND slug <> '' AND value IS NOT NULL").select("slug", "leaf", "value"), root, ["slug", "leaf"], overwrite, "text")


def read_leaves(spark: SparkSession, root: str) -> DataFrame:
    """(slug, leaf, value): what write_leaves wrote, a leaf's lines joined again."""
    files = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    part = lambda p: _unescaped(_unescaped(F.regexp_extract("path", f"/{p}=([^/]*)/", 1))).alias(p)  # noqa: E731  a path is escaped as well
    return files.select(part("slug"), part("leaf"), F.regexp_replace("value", "\n$", "").alias("value"))


def article_leaves(bundles: DataFrame, collections: DataFrame) -> DataFrame:
    """Leaves of article trees from bundles (slug, content, metadata) and collections (article_slug, table_id, pos, collection).

    identifiers.json, metadata.json, article.txt, tables.jsonl, a raw table and its coordinates as CSV for each
    table, table_sources.json and analyses.jsonl. A bundle without an identifier stops the query.
    """
    c, m = F.col("content"), F.col("metadata")
    checked = bundles.withColumn("slug", F.when(c["identifier"].isNull(), F.raise_error(F.concat(F.lit("no identifier: "), F.col("slug"))).cast("string")).otherwise(F.col("slug")))
    leaf = lambda name, value: F.struct(F.lit(name).alias("leaf"), value.alias("value"))
    tables = F.coalesce(c["tables"], F.array().cast(f"array<{model.TABLE}>"))
    lines = F.array_join(F.transform(tables, model.encode), "\n")
    sources = F.map_from_entries(F.array_sort(F.transform(tables, lambda t: F.struct(t["table_id"], F.to_json(t["metadata"])))))
    raw = F.transform(tables, lambda t: F.struct(F.concat(F.lit("tables/"), t["table_id"], F.lit(".xml")).alias("leaf"), F.coalesce(t["metadata"]["raw"], F.lit("<table/>")).alias("value")))
    point = lambda p: F.concat_ws(",", p["x"].cast("string"), p["y"].cast("string"), p["z"].cast("string"))
    rows = F.transform(tables, lambda t: F.struct(F.concat(F.lit("tables/"), t["table_id"], F.lit("_coordinates.csv")).alias("leaf"), F.array_join(F.concat(F.array(F.lit("x,y,z")), F.transform(t["coordinates"], point)), "\n").alias("value")))
    fixed = F.array(leaf("identifiers.json", model.encode(c["identifier"])), leaf("metadata.json", model.encode(m)), leaf("article.txt", c["full_text"]), leaf("tables.jsonl", lines), leaf("table_sources.json", F.to_json(sources)))
    own = checked.select("slug", F.explode(F.concat(fixed, raw, rows)).alias("l")).select("slug", "l.leaf", "l.value")
    analyses = collections.groupBy(F.col("article_slug").alias("slug")).agg(rel.in_order(F.collect_list(F.struct("pos", "table_id", "collection"))).alias("cs"))
    text = F.array_join(F.flatten(F.transform("cs", lambda s: analysis_lines(s["table_id"], s["collection"]))), "\n")
    return own.unionByName(analyses.select("slug", F.lit("analyses.jsonl").alias("leaf"), text.alias("value")))


def analysis_lines(table_id: Column, collection: Column) -> Column:
    """JSON lines of a collection's analyses: the table is the analysis's own, else the given one; the space is added."""
    line = lambda a: model.encode(F.struct(F.coalesce(cols.missing(a["table_id"]), table_id).alias("table_id"), a["name"].alias("name"), a["description"].alias("description"), collection["coordinate_space"].alias("coordinate_space"), a["coordinates"].alias("coordinates")))
    return F.transform(F.coalesce(collection["analyses"], F.array().cast(f"array<{model.ANALYSIS}>")), line)


def article_export(bundles: DataFrame, collections: DataFrame, analyses_path: Column | None = None) -> DataFrame:
    """(slug, identifiers, processed, source, analyses): export manifests as JSON; analyses inline only without a path."""
    per = collections.groupBy(F.col("article_slug").alias("slug")).agg(rel.in_order(F.collect_list(F.struct("pos", "collection"))).alias("cs"))
    c = F.col("content")
    path = analyses_path if analyses_path is not None else F.lit(None).cast("string")
    inline = F.when(path.isNull(), F.transform("cs", lambda s: s["collection"]))
    joined = bundles.filter("content.identifier IS NOT NULL").join(per, "slug", "left").withColumn("__path", path)
    return joined.select("slug", model.encode(c["identifier"]).alias("identifiers"), model.encode(F.struct(c["full_text"].alias("full_text"), c["tables"].alias("tables"), F.col("metadata"))).alias("processed"), model.encode(F.struct(c["source"].alias("source"), c["error_message"].alias("error_message"))).alias("source"), F.coalesce(F.to_json(F.struct(F.col("__path").alias("path"))), F.lit("")).alias("analyses_path"), model.encode(inline).alias("analyses"))


def analyses_document(collections: DataFrame) -> str:
    """One JSON text of slug, table and collection, keys sorted: a report for one run's articles, on the driver."""
    rows = collections.select("article_slug", "table_id", model.encode(F.col("collection")).alias("c")).collect()
    out: dict[str, dict] = {}
    for r in sorted(rows, key=lambda r: (r["article_slug"], r["table_id"])):
        out.setdefault(r["article_slug"], {})[r["table_id"]] = json.loads(r["c"])
    return json.dumps(out, indent=2, sort_keys=True)


def coordinates_table(memory: DataFrame, external: DataFrame) -> DataFrame:
    """External rows of a table replace the ones in memory; missing columns are added and nulls become ''."""
    kept = memory.join(external.select("slug", "table_id").distinct(), ["slug", "table_id"], "left_anti")
    out = kept.unionByName(external, allowMissingColumns=True)
    for c in COORDINATE_COLUMNS:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    extra = [c for c in out.columns if c not in COORDINATE_COLUMNS and c != "slug"]
    return out.select("slug", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in [*COORDINATE_COLUMNS, *extra]))


def save_coordinates(df: DataFrame, path: str) -> None:
    df.repartition("slug").write.partitionBy("slug").mode("overwrite").option("header", True).csv(path)


def article_metadata_json(title: Column, authors: Column, journal: Column, keywords: Column, abstract: Column, year: Column, space: Column, license_: Column, has_text: Column) -> Column:
    names = F.array_join(F.transform(authors, lambda a: a["name"]), "; ")
    words = F.when(F.size(keywords) > 0, keywords)
    return F.to_json(F.struct(title.alias("title"), names.alias("authors"), journal.alias("journal"), words.alias("keywords"), abstract.alias("abstract"), year.alias("year"), space.alias("coordinate_space"), license_.alias("license"), has_text.alias("text")), {"ignoreNullFields": "false"})
