"""The cache and the relational store."""

import pytest
from pyspark.sql import functions as F

from folioforge.functions import model, predicates
from folioforge.operators import cache as c
from folioforge.operators import store as st

IDS = "pos long, slug string, pmid string, doi string, pmcid string"


def test_cache_table(spark, tmp_path):
    cache = c.Cache(spark, f"file://{tmp_path}", "downloads", "ace")
    assert cache.count() == 0 and cache.get("a") is None and not cache.has("a")
    cache.add(spark.createDataFrame([(0, "a", "1", None, "10.1/a", "p0"), (1, "a", "1", None, "10.1/a", "p1"), (2, "b", None, "PMC2", "", "q"), (3, None, "9", None, None, "z")], "pos long, slug string, pmid string, pmcid string, doi string, payload string"))
    assert cache.count() == 2 and cache.get("a").payload == "p1" and cache.has("b")
    assert {k: sorted(r[0] for r in df.collect()) for k, df in cache.identifier_sets().items()} == {"slug": ["a", "b"], "pmid": ["1"], "doi": ["10.1/a"], "pmcid": ["PMC2"]}
    cache.add(spark.createDataFrame([(0, "b", "new", "x")], "pos long, slug string, payload string, more string"))
    assert cache.get("b").payload == "new" and cache.get("b").more == "x" and cache.get("a").more is None and cache.get("b").pmcid is None
    asks = spark.createDataFrame([(0, "zz", "1", None, None), (1, "b", None, None, None), (2, "q", "", "", None)], IDS)
    assert {r.slug: (r.hit_key, r.hit_payload) for r in cache.lookup(asks).collect()} == {"zz": ("pmid", "p1"), "b": ("slug", "new"), "q": (None, None)}
    with cache.lease(), pytest.raises(RuntimeError):
        cache.remove(asks.select("slug"))
    cache.remove(asks.select("slug"))
    assert cache.count() == 1 and len(cache.versions()) == 2


def test_cached_metadata_and_results(spark, tmp_path):
    empty = [None] * 9
    rows = spark.createDataFrame([("a", ("T", *empty), 0), ("b", ("T", None, "text", *[None] * 7), 1)], f"slug string, metadata {model.METADATA}, pos long")
    cache = c.Cache(spark, f"file://{tmp_path}", "metadata")
    c.cache_metadata(cache, rows, predicates.substantive_metadata)
    assert [r.slug for r in cache.load().collect()] == ["b"]
    results = spark.createDataFrame([("s", "art", "T 1", "t-1", None, "none", 0)], f"slug string, article_slug string, table_id string, sanitized_table_id string, collection {model.COLLECTION}, error_message string, pos long")
    done = c.Cache(spark, f"file://{tmp_path}", "analyses")
    c.cache_results(done, results)
    got = done.load().select("slug", model.decode(F.col("payload"), model.RESULT).alias("r")).first()
    assert got.slug == "art::t-1" and got.r.table_id == "T 1" and got.r.error_message == "none"


def files(*paths):
    return [(p, "html", None, None, None, None) for p in paths]


def test_legacy_index(spark):
    schema = f"pos long, slug string, pmid string, pmcid string, doi string, files array<{model.FILE}>"
    index = spark.createDataFrame([(0, "a", "1", None, None, files("x"))], schema)
    found = spark.createDataFrame([(1, "n1", "1", None, None, files("x", "y", "y")), (2, "n2", "2", None, "d", files("z")), (3, "n3", "3", None, "d", files("z")), (4, "n4", None, "P", None, files("w"))], schema)
    out, added, updated = c.index_legacy(index, found)
    assert (added, updated) == (2, 0) and sorted(r.slug for r in out.collect()) == ["a", "n2", "n4"]
    out, added, updated = c.index_legacy(index, found, update_existing=True)
    assert (added, updated) == (0, 1) and [f.file_path for f in out.first().files] == ["x", "y"]


def test_read_through(spark, tmp_path):
    cache = c.Cache(spark, f"file://{tmp_path}", "ids")
    cache.add(spark.createDataFrame([(0, "b", "2", None, '{"pmid":"2","doi":"10.1/b","pmcid":"PMC2"}')], "pos long, slug string, pmid string, doi string, payload string"))
    ids = spark.createDataFrame([(0, "full", "1", "10.1/f", "PMC1"), (1, "x", "2", None, None), (2, "y", "3", None, None), (3, "z", "4", None, None), (4, "w", None, "10.1/w", None)], IDS)

    def broken(df):
        raise RuntimeError("down")

    fill = lambda df: df.withColumn("pmcid", F.when(F.col("pmid") == "3", "PMC3").otherwise(F.col("pmcid")))
    got, failed = c.read_through(ids, cache, {"doi": broken, "pmid": fill})
    rows = {r.pos: (r.pmid, r.doi, r.pmcid) for r in got.collect()}
    assert failed == ["doi"] and rows == {0: ("1", "10.1/f", "PMC1"), 1: ("2", "10.1/b", "PMC2"), 2: ("3", None, "PMC3"), 3: ("4", None, None), 4: (None, "10.1/w", None)}
    assert sorted(r.slug for r in cache.load().collect()) == ["10-1-w", "3-pmc3", "4", "b"]  # unresolved ones too


def point(x, kind=None, value=None, space=None):
    return (x, 2.0, 3.0, space, value, kind, 5, None, False, True, False)


def analysis(name, *points, table="T1", stem="t1"):
    return (name, None, list(points), table, 1, "cap\x00", "foot", {"sanitized_table_id": stem})


def items(spark, *rows, metadata=()):
    ident = lambda pmid, doi: (None, pmid, doi, None, None)
    collections = [(slug, i, (f"{slug}::t", "MNI", ident(*ids) if ids else None, list(analyses))) for i, (slug, ids, analyses) in enumerate(rows)]
    df = spark.createDataFrame(collections, f"article_slug string, pos long, collection {model.COLLECTION}")
    meta = spark.createDataFrame(list(metadata), f"slug string, metadata {model.METADATA}")
    return st.work_items(df, meta)


def meta(title, authors=(), oa=None):
    return (title, [(a, None, None) for a in authors], "abs", None, 2001, ["k"], None, "pubmed", oa, None)


def upload(spark, tmp_path, *args, **more):
    """upload(), written and read again."""
    store, outcomes = st.upload(*args, **more)
    path = f"file://{tmp_path}/{len(list(tmp_path.iterdir()))}"
    listed = outcomes.collect()
    st.save(store, path)
    return st.load(spark, path), listed


def test_upload_and_replace(spark, tmp_path):
    work = items(spark, ("a", None, [analysis("UNKNOWN", point(1.0, "t", 2.5), point(2.0))]), ("a", ("7", "10.1/a"), [analysis("A", point(3.0, space="TAL")), analysis("A")]), ("b", ("8", None), [analysis("bad", (None, *point(1.0)[1:]))]), metadata=[("a", meta("Title", ["X", "Y"], True))])
    store, outcomes = upload(spark, tmp_path, work, st.empty(spark))
    got = {r.slug: r for r in outcomes}
    assert got["a"].success and len(got["a"].analysis_ids) == 3 and not got["b"].success and got["b"].error
    counts = {n: df.count() for n, df in store.items()}
    assert counts == {"base_studies": 1, "studies": 1, "tables": 1, "analyses": 3, "points": 3, "point_values": 1}
    assert [r.name for r in store["analyses"].orderBy("order").collect()] == ["t1", "A", "A-2"]
    assert sorted((r.x, r.space, r.deactivation) for r in store["points"].collect()) == [(1.0, "MNI", True), (2.0, "MNI", True), (3.0, "TAL", True)]
    assert store["point_values"].first().kind == "t" and store["tables"].first().caption == "cap"
    base = store["base_studies"].first()
    assert (base.name, base.authors, base.pmid, base.doi, base.is_oa, base.has_coordinates, base.level, base.year) == ("Title", "X; Y", "7", "10.1/a", True, True, "group", "2001")
    assert base.metadata["slug"] == "a" and st.violations(store).count() == 0
    again, _ = upload(spark, tmp_path, items(spark, ("c", ("7", None), [analysis("B", point(9.0))])), store)
    assert {n: df.count() for n, df in again.items()} == {"base_studies": 1, "studies": 1, "tables": 1, "analyses": 1, "points": 1, "point_values": 0}
    more, _ = upload(spark, tmp_path, items(spark, ("c", ("7", None), [analysis("B", point(9.0))])), store, behavior="INSERT_NEW", run="2")
    assert {n: df.count() for n, df in more.items()} == {"base_studies": 1, "studies": 2, "tables": 2, "analyses": 4, "points": 4, "point_values": 1}
    assert st.violations(more).count() == 0


def test_fill_overwrite_and_metadata_only(spark, tmp_path):
    old, _ = upload(spark, tmp_path, items(spark, ("a", ("7", None), [analysis("A", point(1.0))]), metadata=[("a", meta("OLD"))]), st.empty(spark))
    new = items(spark, ("a", ("7", None), [analysis("B", point(2.0), point(3.0))]), metadata=[("a", meta("NEW", ["N"], False))])
    filled, outcomes = upload(spark, tmp_path, new, old, mode="FILL", metadata_only=True)
    base = filled["base_studies"].first()
    assert (base.name, base.authors, base.is_oa) == ("OLD", "N", False) and outcomes[0].analysis_ids == []
    assert filled["points"].count() == 1 and filled["analyses"].first().name == "A"
    over, _ = upload(spark, tmp_path, new, old, mode="OVERWRITE")
    assert over["base_studies"].first().name == "NEW" and over["points"].count() == 2


def test_store_is_written_whole(spark, tmp_path):
    store, outcomes = upload(spark, tmp_path, items(spark), st.empty(spark))
    assert not outcomes and all(df.count() == 0 for df in store.values())
    with pytest.raises(ValueError):
        st.save(store, f"file://{tmp_path}/0")
