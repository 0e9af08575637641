"""Command line: python -m folioforge.cli COMMAND. Responses are replayed from files; nothing goes to a network."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import model
from folioforge.operators import cache as caches
from folioforge.operators import relational as rel
from folioforge.operators import store as st
from folioforge.plans import stages, workflow
from folioforge.sources import articles, providers, readers, sinks


def settings_of(path: str | None, overrides: dict) -> stages.Settings:
    """Defaults, then FOLIOFORGE_ variables, then a file of `name: value` lines, then what the command says."""
    return stages.Settings().merged(stages.from_environment(os.environ), stages.from_file(path) if path else {}, overrides)


def manifest_of(spark: SparkSession, path: str) -> DataFrame:
    return stages.normalize(readers.load_manifest(spark, path, missing="error"))


def search(spark: SparkSession, a: argparse.Namespace) -> None:
    found = providers.search(spark.read.schema("query string, year int, page int, payload string").json(a.replay), a.query, a.start_year)
    null = F.lit(None).cast("string")
    sinks.save_identifiers(found.select(null.alias("neurostore"), "pmid", null.alias("doi"), null.alias("pmcid"), F.lit(None).cast("map<string,string>").alias("other_ids")), a.output)


def extract(spark: SparkSession, a: argparse.Namespace) -> None:
    folders = articles.read_folder(spark, a.input).withColumn("pmcid", F.regexp_extract("dir", r"(?i)pmc(?:id_)?(\d+)$", 1))
    ids = manifest_of(spark, a.manifest).filter("pmcid IS NOT NULL")
    rows = ids.join(folders.withColumn("pmcid", F.concat(F.lit("PMC"), "pmcid")), "pmcid")
    identifier = F.struct("neurostore", "pmid", "doi", "pmcid", "other_ids")
    articles.extract(rows.select("slug", F.lit(a.source).alias("source"), identifier.alias("identifier"), "files")).write.mode("overwrite").parquet(a.output)


def create_analyses(spark: SparkSession, a: argparse.Namespace) -> None:
    metadata = spark.createDataFrame([], f"slug string, metadata {model.METADATA}")
    bundles = workflow.bundles(spark.read.parquet(a.input), metadata)
    replies = spark.read.schema("key string, arguments string").json(a.replay)
    cache = caches.Cache(spark, a.cache, "create_analyses")
    old = cache.load()
    cached = old.select(model.decode(F.col("payload"), model.RESULT).alias("r")).select("r.*").withColumn("pos", F.lit(0).cast("long"))
    results, fresh = workflow.run_create_analyses(bundles, replies, cached)
    results.write.mode("overwrite").parquet(a.output)
    caches.cache_results(cache, fresh)
    if a.document:
        print(sinks.analyses_document(spark.read.parquet(a.output)))


def upload(spark: SparkSession, a: argparse.Namespace) -> None:
    old = st.load(spark, a.store) if a.store else st.empty(spark)
    targets = manifest_of(spark, a.manifest) if a.manifest else None
    metadata = spark.createDataFrame([], f"slug string, metadata {model.METADATA}")
    new, outcomes = workflow.run_upload(spark.read.parquet(a.input), metadata, old, targets, behavior=a.behavior, mode=a.mode, metadata_only=a.metadata_only)
    outcomes.write.mode("overwrite").parquet(a.output + ".outcomes")
    st.save(new, a.output)


def sync(spark: SparkSession, a: argparse.Namespace) -> None:
    metadata = spark.createDataFrame([], f"slug string, metadata {model.METADATA}")
    bundles = workflow.bundles(spark.read.parquet(a.input), metadata)
    results = spark.read.parquet(a.analyses)
    sinks.write_leaves(sinks.article_leaves(bundles, results), a.output, a.overwrite)


def index_legacy(spark: SparkSession, a: argparse.Namespace) -> None:
    found = readers.article_folders(spark, a.input) if a.source == "pubget" else readers.saved_pages(spark, a.input).select(F.col("stem").alias("pmid"), F.array("path").alias("files"))
    null = F.lit(None).cast("string")
    rows = found.select(*(F.col(c) if c in found.columns else null.alias(c) for c in ("pmid", "doi", "pmcid")), "files")
    file = lambda p: F.struct(p.alias("file_path"), null.alias("file_type"), null.alias("content_type"), F.lit(a.source).alias("source"), F.lit(None).cast("timestamp_ntz").alias("downloaded_at"), null.alias("md5"))
    rows = rel.number_rows(stages.normalize(rows), "slug").withColumn("files", F.transform("files", file).cast(f"array<{model.FILE}>"))
    cache = caches.Cache(spark, a.cache, "download", a.source)
    old = cache.load()
    index = old if "files" in old.columns else old.withColumn("files", F.lit(None).cast(f"array<{model.FILE}>"))
    out, added, updated = caches.index_legacy(index.withColumn("pos", F.lit(0).cast("long")), rows, a.update)
    cache.replace(out.drop("pos"))
    print(f"added {added}, updated {updated}")


def sample(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = readers.index_json(spark, a.input).withColumn("other_ids", F.lit(None).cast("map<string,string>"))
    sinks.save_identifiers(rel.seeded_sample(rows, "neurostore", a.n, a.seed), a.output)


def prune(spark: SparkSession, a: argparse.Namespace) -> None:
    cache = caches.Cache(spark, a.cache, "create_analyses")
    names = rel.explode_aliases(manifest_of(spark, a.manifest)).select(F.col("alias").alias("article_slug")).distinct()
    gone = cache.load().join(names, "article_slug", "left_semi").select("slug")
    print(f"{gone.count()} entries" + ("" if a.apply else ", kept: pass --apply"))
    if a.apply:
        cache.remove(gone)


def dump_tables(spark: SparkSession, a: argparse.Namespace) -> None:
    """Each table's coordinates as CSV and its fields as JSON, a leaf each."""
    tables = spark.read.parquet(a.input).select("slug", F.explode("tables").alias("t"))
    point = lambda c: F.concat_ws(",", *(c[k].cast("string") for k in "xyz"))
    rows = F.array_join(F.concat(F.array(F.lit("x,y,z")), F.transform("t.coordinates", point)), "\n")
    leaves = F.array(F.struct(F.concat("t.table_id", F.lit(".csv")).alias("leaf"), rows.alias("value")), F.struct(F.concat("t.table_id", F.lit(".json")).alias("leaf"), model.encode(F.col("t")).alias("value")))
    sinks.write_leaves(tables.select("slug", F.explode(leaves).alias("l")).select("slug", "l.*"), a.output)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="folioforge")
    commands = out.add_subparsers(dest="command", required=True)

    def command(run, *arguments: str, **more) -> argparse.ArgumentParser:
        p = commands.add_parser(run.__name__.replace("_", "-"), help=run.__doc__)
        for name in arguments:
            p.add_argument(f"--{name}", required=True)
        for name, default in more.items():
            if default is False:
                p.add_argument(f"--{name.replace('_', '-')}", action="store_true")
            else:
                p.add_argument(f"--{name.replace('_', '-')}", default=default, type=type(default) if default is not None else str)
        p.set_defaults(run=run)
        return p

    command(search, "query", "replay", "output", start_year=1990)
    command(extract, "input", "manifest", "output", source="pubget")
    command(create_analyses, "input", "replay", "cache", "output", document=False)
    command(upload, "input", "output", store=None, manifest=None, behavior="UPDATE", mode="FILL", metadata_only=False)
    command(sync, "input", "analyses", "output", overwrite=False)
    command(index_legacy, "input", "cache", source="ace", update=False)
    command(sample, "input", "output", n=50, seed="42")
    command(prune, "cache", "manifest", apply=False)
    command(dump_tables, "input", "output")
    return out


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(arguments)
    a.run(spark or SparkSession.builder.appName("folioforge").getOrCreate(), a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
