"""Relational helpers: keep-first, cascaded lookups, cache splits, upserts and field merges.

Order is data: every input has a position column, and whatever is first or last is so by it. Lookups are
equi-joins only; the sides are never assumed small, so that the plan picks a broadcast by size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import cols


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[Column], drop_null_keys: bool) -> DataFrame:
    if drop_null_keys:
        for k in keys:
            df = df.filter(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    n = "__row"
    return df.withColumn(n, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(n) == 1).drop(n)


def keep_first(df: DataFrame, keys: Sequence[str], pos: str = "pos", tie: Sequence[str] = (), drop_null_keys: bool = False) -> DataFrame:
    """One row a key: the first by position. The limit is pushed below the shuffle, so a hot key costs a row a task."""
    return _keep(df, keys, [F.col(pos).asc(), *map(F.col, tie)], drop_null_keys)


def keep_last(df: DataFrame, keys: Sequence[str], pos: str = "pos", tie: Sequence[str] = (), drop_null_keys: bool = False) -> DataFrame:
    return _keep(df, keys, [F.col(pos).desc(), *map(F.col, tie)], drop_null_keys)


def cascade_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], payload: Sequence[str], right_pos: str = "pos", extra: Sequence[str] = ()) -> DataFrame:
    """left with the payload of the first key that hits, and hit_key; extra columns must match besides each key."""
    out = left
    for i, key in enumerate(keys):
        one = keep_first(right, [key, *extra], right_pos, drop_null_keys=True)
        one = one.select(F.col(key).alias(f"__k{i}"), *(F.col(e).alias(f"__e{i}_{e}") for e in extra), F.struct(*payload).alias(f"__p{i}"))
        on = F.col(key) == F.col(f"__k{i}")
        for e in extra:
            on = on & (F.col(e) == F.col(f"__e{i}_{e}"))
        out = out.join(one, on, "left").drop(f"__k{i}", *(f"__e{i}_{e}" for e in extra))
    hit = F.coalesce(*(F.col(f"__p{i}") for i in range(len(keys))))
    name = F.coalesce(*(F.when(F.col(f"__p{i}").isNotNull(), F.lit(k)) for i, k in enumerate(keys)))
    return out.select(*(F.col(c) for c in left.columns), name.alias("hit_key"), *(hit[p].alias(f"hit_{p}") for p in payload))


def partition_cached(requests: DataFrame, cache: DataFrame, keys: Sequence[str], payload: Sequence[str], valid: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(hits, misses): disjoint, together all requests; a hit has the request's identifier and the cached payload."""
    found = cascade_lookup(requests, cache if valid is None else cache.filter(valid), keys, payload)
    hits = found.filter(F.col("hit_key").isNotNull())
    return hits, found.filter(F.col("hit_key").isNull()).select(*requests.columns)


def source_cascade(requests: DataFrame, sources: Sequence[tuple[str, Column, Callable[[DataFrame], DataFrame]]], key: str = "slug") -> tuple[list[DataFrame], DataFrame]:
    """Results of each source in turn, and what is left: unsupported and failed requests go to the next source."""
    results, rest = [], requests
    for name, supports, fetch in sources:
        done = fetch(rest.filter(F.coalesce(supports, F.lit(False)))).withColumn("source", F.lit(name))
        results.append(done)
        rest = rest.join(done.filter("success").select(key).distinct(), key, "left_anti")
    return results, rest


def explode_aliases(df: DataFrame) -> DataFrame:
    """(slug, alias), distinct: all names of an identifier row."""
    other = F.map_values("other_ids") if "other_ids" in df.columns else F.array().cast("array<string>")
    own = F.array(*(F.col(c).cast("string") for c in ("slug", "pmid", "doi", "pmcid", "neurostore") if c in df.columns))
    names = F.concat(own, F.coalesce(other, F.array().cast("array<string>")))
    return df.select("slug", F.explode(F.filter(names, lambda x: x.isNotNull() & (x != ""))).alias("alias")).distinct()


def merge_upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], pos: str = "pos") -> DataFrame:
    """The last new row of each key replaces the old row; columns are united."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(keep_last(new, keys, pos), allowMissingColumns=True)


def delete_keys(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def merge_fields(current: Column, incoming: Column, mode: str) -> Column:
    """FILL keeps a present value, OVERWRITE takes a present new one; null and '' are missing."""
    cur, inc = cols.missing(current), cols.missing(incoming)
    return F.coalesce(cur, inc) if mode == "FILL" else F.coalesce(inc, cur)


def merge_blob(current: Column, incoming: Column, mode: str) -> Column:
    """merge_fields for each key of two string maps; a new missing value never replaces."""
    empty = F.create_map().cast("map<string,string>")
    merged = F.map_zip_with(F.coalesce(current, empty), F.coalesce(incoming, empty), lambda _, a, b: merge_fields(a, b, mode))
    return F.map_filter(merged, lambda _, v: v.isNotNull())


def metadata_fold(rows: DataFrame, key: str, prio: str) -> DataFrame:
    """A left fold of metadata rows in priority order.

    Scalars: the first present. Authors and abstract: the longest, the earlier on ties. Keywords: ordered
    distinct union. open_access: the first that isn't null.
    """
    first = lambda c, v: F.min_by(c, F.when(v.isNotNull(), F.col(prio))).alias(c)
    longest = lambda c, n: F.max_by(c, F.struct(n.alias("n"), (-F.col(prio)).alias("p"))).alias(c)
    words = F.array_sort(F.collect_list(F.struct(F.col(prio).alias("p"), F.col("keywords").alias("k"))))
    return rows.groupBy(key).agg(
        *(first(c, cols.missing(F.col(c).cast("string"))) for c in ("title", "journal", "license")),
        first("open_access", F.col("open_access")),
        longest("authors", F.coalesce(F.size("authors"), F.lit(0))),
        longest("abstract", F.coalesce(F.length("abstract"), F.lit(0))),
        F.array_distinct(F.flatten(F.filter(F.transform(words, lambda w: w["k"]), lambda k: k.isNotNull()))).alias("keywords"),
    )


def any_key_dedup(batch: DataFrame, keys: Sequence[str], group: str, pos: str = "pos") -> DataFrame:
    """Rows in order, kept if none of their keys was seen in a kept row of the same group (an import batch)."""
    names = list(keys)

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        seen: set[tuple[str, str]] = set()
        keep = []
        for values in rows.sort_values(pos).to_dict("records"):
            mine = {(k, values[k]) for k in names if isinstance(values[k], str) and values[k]}
            if not mine & seen:
                keep.append(values[pos])
                seen |= mine
        return rows[rows[pos].isin(keep)]

    return batch.groupBy(group).applyInPandas(fold, batch.schema)


def _settled(df: DataFrame) -> DataFrame:
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.localCheckpoint()


def any_key_dedup_all(df: DataFrame, keys: Sequence[str], pos: str = "pos") -> DataFrame:
    """any_key_dedup over all rows as one sequence; pos is unique. No task holds a key's rows or the seen keys.

    In each round a row that is the first undecided one of all its keys is kept, and undecided rows that share a
    key with it go. The first undecided row always is, so rounds end; they grow with the longest chain of rows
    in which each row's fate hangs on the one before.
    """
    names = F.array(*(F.when(F.col(k) != "", F.struct(F.lit(k).alias("name"), F.col(k).alias("value"))) for k in keys))
    left = _settled(df.select(F.col(pos).alias("p"), F.explode(F.filter(names, lambda x: x.isNotNull())).alias("key")))
    gone = None
    while not left.isEmpty():
        first = left.groupBy("key").agg(F.min("p").alias("first"))
        marked = left.join(first, "key")
        kept = marked.groupBy("p").agg(F.bool_and(F.col("p") == F.col("first")).alias("keep")).filter("keep").select("p")
        seen = left.join(kept, "p", "left_semi").select("key")  # once each: a key has one first row
        lost = _settled(left.join(seen, "key", "left_semi").select("p").distinct().join(kept, "p", "left_anti"))
        gone = lost if gone is None else gone.union(lost)
        # Both the kept rows and the lost ones hold a seen key.
        left = _settled(left.join(left.join(seen, "key", "left_semi").select("p").distinct(), "p", "left_anti"))
    return df if gone is None else df.join(gone.select(F.col("p").alias(pos)), pos, "left_anti").select(df.columns)


def number_rows(df: DataFrame, *by: str | Column) -> DataFrame:
    """df with pos, from 1, in order; ranges are numbered apart and the counts of the ranges before added."""
    ranged = df.repartitionByRange(*by).withColumn("__p", F.spark_partition_id())
    inside = ranged.withColumn("__i", F.row_number().over(Window.partitionBy("__p").orderBy(*by)))
    counts = inside.groupBy("__p").agg(F.count("*").alias("__n"))
    before = counts.withColumn("__b", F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)))  # a row a partition
    return inside.join(F.broadcast(before), "__p").withColumn("pos", (F.col("__i") + F.coalesce("__b", F.lit(0))).cast("long")).drop("__p", "__i", "__n", "__b")


def unique_stems(df: DataFrame, scope: str, base: str, index: str) -> DataFrame:
    """df with stem: the base name, if no row before it in its scope took it, else base-index, lengthened until it is free.

    Rows go by index; a scope is one article's tables, in one task.
    """

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(index)
        used: set[str] = set()
        stems = []
        for name, i in zip(rows[base], rows[index], strict=True):
            stem = name if name not in used else f"{name}-{i}"
            while stem in used:
                stem = f"{stem}-{i + 1}"
            used.add(stem)
            stems.append(stem)
        return rows.assign(stem=stems)

    return df.groupBy(scope).applyInPandas(fold, df.withColumn("stem", F.lit("")).schema)


def in_order(items: Column, pos: str = "pos") -> Column:
    """An array of structs sorted by one field; the others need no order."""
    return F.array_sort(items, lambda a, b: F.when(a[pos] < b[pos], -1).when(a[pos] > b[pos], 1).otherwise(0))


def batches(df: DataFrame, size: int, group: str, pos: str = "pos") -> DataFrame:
    """Numbers of fixed-size batches inside each group."""
    n = F.row_number().over(Window.partitionBy(group).orderBy(pos))
    return df.withColumn("batch", F.floor((n - 1) / size).cast("long")).withColumn("place", ((n - 1) % size).cast("long"))


def name_with_suffix(df: DataFrame, scope: str, base: str, *pos: str) -> DataFrame:
    """The n-th use of a name in its scope, by the position columns, gets -n."""
    n = F.row_number().over(Window.partitionBy(scope, base).orderBy(*(pos or ("pos",))))
    return df.withColumn("name", F.when(n > 1, F.concat_ws("-", F.col(base), n.cast("string"))).otherwise(F.col(base)))


def seeded_sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """n rows in the order of a hash of key and seed; n of 0 or less gives all."""
    return df if n <= 0 else df.orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))), key).limit(n)
