"""A keyed cache as versioned Parquet tables, one for each namespace and source, and what reads through it.

A write makes a new version beside the old one; readers take the last version that Spark committed, so an
interrupted write changes nothing. One writer at a time holds a lease file. A cache row is (slug, payload,
cached_at, pmid, pmcid, doi, ...); columns may be added later and are null in older rows.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import cols, model
from folioforge.operators import relational as rel

SCHEMA = "slug string, payload string, cached_at timestamp, pmid string, pmcid string, doi string"
#: The order in which identifiers are looked up.
KEYS = ["slug", "pmid", "doi", "pmcid"]
#: Versions that stay for readers that began before.
KEPT = 2


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which driver and executors share. Only a local master may go without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='folioforge-')}"
    return f"{root.rstrip('/')}/folioforge/{label}-{uuid.uuid4().hex}"


class Cache:
    """The table of one namespace and source below root."""

    def __init__(self, spark: SparkSession, root: str, namespace: str, source: str = "all"):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/ns={namespace}/src={source}"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Committed versions, the last one last."""
        if not self._fs.exists(self._path(self.path)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.path))]
        found = sorted(int(n[2:]) for n in names if n.startswith("v-") and n[2:].isdecimal())
        return [v for v in found if self._fs.exists(self._path(f"{self.path}/v-{v}/_SUCCESS"))]

    def load(self) -> DataFrame:
        """All entries; a cache that was never written is empty."""
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.parquet(f"{self.path}/v-{known[-1]}")

    entries = load

    def count(self) -> int:
        return self.load().count()

    def has(self, slug: str) -> bool:
        return not self.load().filter(F.col("slug") == slug).isEmpty()

    def get(self, slug: str):
        """The entry of a slug, or None."""
        return self.load().filter(F.col("slug") == slug).first()

    def identifier_sets(self) -> dict[str, DataFrame]:
        """The distinct present values of each identifier column."""
        rows = self.load()
        return {k: rows.select(k).filter(cols.missing(F.col(k)).isNotNull()).distinct() for k in KEYS}

    def lookup(self, requests: DataFrame, payload: list[str] | None = None) -> DataFrame:
        """requests with the payload of the first identifier that hits."""
        rows = self.load().withColumn("pos", F.col("cached_at"))
        return rel.cascade_lookup(requests, rows, KEYS, payload or ["payload"])

    @contextlib.contextmanager
    def lease(self) -> Iterator[None]:
        """One writer at a time; a second one fails at once."""
        lock = self._path(f"{self.path}/_lease")
        if not self._fs.createNewFile(lock):
            raise RuntimeError(f"another writer holds {self.path}")
        try:
            yield
        finally:
            self._fs.delete(lock, False)

    def replace(self, rows: DataFrame) -> None:
        """rows as the next version."""
        with self.lease():
            known = self.versions()
            rows.write.mode("overwrite").parquet(f"{self.path}/v-{known[-1] + 1 if known else 0}")
            for v in known[: 1 - KEPT]:
                self._fs.delete(self._path(f"{self.path}/v-{v}"), True)

    def add(self, rows: DataFrame, pos: str = "pos") -> None:
        """Upserts rows (slug, payload, identifiers, ..., pos): the last of a slug counts; new columns are added."""
        new = rel.keep_last(rows.filter(cols.missing(F.col("slug")).isNotNull()), ["slug"], pos).drop(pos)
        if "cached_at" not in new.columns:
            new = new.withColumn("cached_at", F.current_timestamp())
        old = self.load().join(new.select("slug"), "slug", "left_anti")
        self.replace(evolve(old, new))

    def remove(self, slugs: DataFrame) -> None:
        self.replace(rel.delete_keys(self.load(), slugs, ["slug"]))


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables, with the columns of either; what a table lacks is null in its rows."""
    return old.unionByName(new, allowMissingColumns=True)


def cache_metadata(cache: Cache, rows: DataFrame, substantive: Callable[[Column], Column]) -> None:
    """Stores rows (slug, metadata, pos) whose metadata says more than a title."""
    kept = rows.filter(substantive(F.col("metadata")))
    cache.add(kept.select("slug", model.encode(F.col("metadata")).alias("payload"), "pos"))


def cache_results(cache: Cache, results: DataFrame) -> None:
    """Stores analysis results (slug, article_slug, table_id, sanitized_table_id, collection, error_message, pos)."""
    key = cols.compose_cache_key(F.col("article_slug"), F.col("sanitized_table_id"))
    cache.add(results.select(key.alias("slug"), "article_slug", "table_id", "sanitized_table_id", model.encode(F.struct(*results.drop("pos").columns)).alias("payload"), "pos"))


def merge_files(old: Column, new: Column) -> Column:
    """The old files, then the new ones whose path is new."""
    return F.concat(old, added_files(old, new))


def added_files(old: Column, new: Column) -> Column:
    return F.filter(new, lambda f: ~F.exists(old, lambda o: o["file_path"] == f["file_path"]))


def index_legacy(index: DataFrame, found: DataFrame, update_existing: bool = False) -> tuple[DataFrame, int, int]:
    """(index, added, updated) after found rows (pos, slug, pmid, pmcid, doi, files) came to an index of such rows.

    Without update, rows none of whose identifiers is known, or stands in an accepted row before, are appended.
    With it, the files of known rows that are new to their entry are appended to it, and nothing is added.
    """
    if update_existing:
        hits = rel.cascade_lookup(found, index, KEYS, ["slug"]).filter("hit_key IS NOT NULL")
        more = hits.groupBy(F.col("hit_slug").alias("slug")).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "files"))), lambda s: s["files"])).alias("new"))
        empty = F.array().cast(f"array<{model.FILE}>")
        joined = index.join(more, "slug", "left").withColumn("__add", added_files(F.coalesce("files", empty), F.coalesce("new", empty)))
        updated = joined.filter(F.size("__add") > 0).count()
        out = joined.withColumn("files", F.concat(F.coalesce("files", empty), _distinct_paths(F.col("__add")))).drop("new", "__add")
        return out.select(index.columns), 0, updated
    fresh = found
    for key in KEYS:
        known = index.select(key).filter(cols.missing(F.col(key)).isNotNull()).distinct()
        fresh = fresh.join(known, key, "left_anti")
    fresh = rel.any_key_dedup_all(fresh.select(found.columns), KEYS)
    return evolve(index, fresh), fresh.count(), 0


def _distinct_paths(files: Column) -> Column:
    paths = F.transform(files, lambda f: f["file_path"])
    return F.filter(files, lambda f, i: F.array_position(paths, f["file_path"]) == i + 1)


def read_through(ids: DataFrame, cache: Cache, lookups: dict[str, Callable[[DataFrame], DataFrame]]) -> tuple[DataFrame, list[str]]:
    """(ids filled, failed lookups): complete rows pass, cached ones are merged, the rest are looked up by id type.

    lookups maps an id type to a function from rows to filled rows, in order; one that raises is named and the others
    go on. Every looked-up row is cached, found or not, under the slug that it has then.
    """
    full = F.forall(F.array(*(cols.missing(F.col(c)).isNotNull() for c in ("pmid", "doi", "pmcid"))), lambda x: x)
    hit = cache.lookup(ids.filter(~full))
    known = F.from_json("hit_payload", "struct<pmid:string,doi:string,pmcid:string>")
    merged = hit.select(*(F.coalesce(cols.missing(F.col(c)), known[c]).alias(c) if c in ("pmid", "doi", "pmcid") else F.col(c) for c in ids.columns), "hit_key")
    pending = merged.filter("hit_key IS NULL").drop("hit_key")
    failed = []
    for kind, look in lookups.items():
        ready = cols.missing(F.col(kind)).isNotNull() & ~full
        try:
            looked = look(pending.filter(ready)).select(ids.columns)
            looked.isEmpty()
        except Exception:  # noqa: BLE001  one provider's failure doesn't stop the others
            failed.append(kind)
            continue
        pending = pending.filter(~ready | ready.isNull()).unionByName(looked)
    slug = cols.identifier_slug(F.col("pmid"), F.col("doi"), F.col("pmcid"))
    pending = pending.withColumn("slug", slug)
    stamp = uuid.uuid4().hex
    cache.add(pending.select("slug", "pmid", "doi", "pmcid", F.to_json(F.struct("pmid", "doi", "pmcid")).alias("payload"), F.lit(stamp).alias("run"), "pos"))
    return ids.filter(full).unionByName(merged.filter("hit_key IS NOT NULL").drop("hit_key")).unionByName(pending), failed
