"""Readers, export trees, stages and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from folioforge import cli
from folioforge.functions import model
from folioforge.operators import cache as caches
from folioforge.operators import relational as rel
from folioforge.operators import store as st
from folioforge.plans import stages, workflow
from folioforge.sources import articles, readers, sinks
from tests.test_articles import LISTING, PUBGET, XML, rows


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return f"file://{path}"


def test_manifests(spark, tmp_path):
    path = write(tmp_path / "m.jsonl", '{"pmid":"2","other_ids":{"a":"b"}}\n\n  \n{"doi":"10.1/x"}\n{"pmid":"1"}\n')
    got = readers.load_identifiers(spark, path).orderBy("pos").collect()
    assert [(r.pos, r.pmid, r.doi) for r in got] == [(1, "2", None), (2, None, "10.1/x"), (3, "1", None)] and got[0].other_ids == {"a": "b"}
    assert readers.load_manifest(spark, "m.jsonl", f"file://{tmp_path}").count() == 3
    assert readers.load_manifest(spark, f"file://{tmp_path}/no.jsonl").count() == 0 and readers.load_manifest(spark, f"file://{tmp_path}/no.jsonl", missing="none") is None
    with pytest.raises(FileNotFoundError):
        readers.load_manifest(spark, f"file://{tmp_path}/no.jsonl", missing="error")
    with pytest.raises(ValueError):
        readers.load_manifest(spark, "m.json")
    for bad in ('{"pmid":"1"}\n{"pmid":', '{"pmid":"1","title":"x"}\n', "[1]\n"):
        with pytest.raises(Exception, match="not an object|unknown keys"):
            readers.load_identifiers(spark, write(tmp_path / "bad.jsonl", bad)).collect()
    assert [r.pmid for r in readers.with_ids(readers.load_identifiers(spark, path), "doi", "pmcid").collect()] == [None]


def test_documents(spark, tmp_path):
    index = write(tmp_path / "index.json", json.dumps({"n1": ["1", "10.1/a", None], "n2": {"pmid": "2", "pmcid": "PMC2"}}))
    assert sorted(map(tuple, readers.index_json(spark, index).collect()), key=str) == [("n1", "1", "10.1/a", None), ("n2", "2", None, "PMC2")]
    with pytest.raises(Exception, match="too short"):
        readers.index_json(spark, write(tmp_path / "short.json", '{"n1": ["1"]}')).collect()
    for text in ('[{"a":1},{"a":2}]', '{"bundles":[{"a":1},{"a":2}]}', '{"x":{"a":1},"y":{"a":2}}'):
        got = readers.bundles_json(spark, write(tmp_path / "b.json", text)).orderBy("pos").collect()
        assert [json.loads(r.bundle)["a"] for r in got] == [1, 2]
    got = readers.analyses_json(spark, write(tmp_path / "a.json", '{"s":{"t1":{"slug":"x"},"t2":{}}}')).collect()
    assert {(r.slug, r.table_id) for r in got} == {("s", "t1"), ("s", "t2")}


def test_folders_and_pages(spark, tmp_path):
    write(tmp_path / "pub/pmcid_7/article.xml", XML)
    write(tmp_path / "pub/pmcid_7/tables/tables.xml", LISTING)
    write(tmp_path / "pub/x/article.xml", "<article><article-id pub-id-type='pmcid'> 99 </article-id></article>")
    write(tmp_path / "pub/y/article.xml", "<article/>")
    got = {r.pmcid: len(r.files) for r in readers.article_folders(spark, f"file://{tmp_path}/pub").collect()}
    assert got == {"PMC7": 2, "PMC99": 1}
    write(tmp_path / "ace/j/12.html", "<html>")
    assert [r.stem for r in readers.saved_pages(spark, f"file://{tmp_path}/ace").collect()] == ["12"]


def test_replayed_search(spark, tmp_path):
    spark.dataSource.register(readers.ReplaySearch)
    pages = [{"query": "q", "page": p, "count": 5, "ids": ids} for p, ids in ((1, ["3", "1"]), (0, ["9", "2", "2"]))]
    pages += [{"query": "big", "page": 0, "count": 12000, "ids": ["1"]}] + [{"query": "big", "year": y, "page": 0, "count": 2, "ids": [str(y), "7"]} for y in (1989, 1990, 1991)]
    path = write(tmp_path / "r.jsonl", "\n".join(map(json.dumps, pages)) + "\n")
    read = lambda **o: spark.read.format("replay_search").options(path=path, **o).load()
    assert [r.pmid for r in read(query=" q ").orderBy("page", "place").collect()] == ["9", "2", "2", "3", "1"]
    assert sorted(r.pmid for r in read(query="big", start_year=1990).select("pmid").distinct().collect()) == ["1990", "1991", "7"]
    assert read(query="").count() == 0 and read(query="none").count() == 0


def content(spark):
    return articles.extract(rows(spark, ("s", "pubget", PUBGET), ("t", "pubget", {"article.xml": XML, "tables/tables.xml": LISTING})))


def no_metadata(spark):
    return spark.createDataFrame([], f"slug string, metadata {model.METADATA}")


REPLY = json.dumps({"analyses": [{"name": "A", "points": [{"coordinates": [1, 2, 3], "values": [{"value": 2, "kind": "z"}]}]}, {"points": []}]})


def test_analyses_stage(spark):
    bundles = workflow.bundles(content(spark), no_metadata(spark))
    assert {r.slug: r.metadata.title for r in bundles.collect()} == {"s": "1", "t": "1"}
    pending = workflow.pending_tables(bundles, "Read.").orderBy("pos").collect()
    assert [r.key for r in pending] == ["s::t1", "s::t2"] and "Caption: cap 1" in pending[0].prompt
    replies = spark.createDataFrame([("s::t1", REPLY), ("other", REPLY)], "key string, arguments string")
    empty = workflow.build_collections(workflow.pending_tables(bundles, ""), replies).limit(0)
    results, fresh = workflow.run_create_analyses(bundles, replies, empty)
    got = results.collect()
    assert [r.slug for r in got] == ["s::t1"] and got[0].collection.coordinate_space == "MNI"
    a, b = got[0].collection.analyses
    assert (a.name, b.name, a.table_caption, a.metadata["sanitized_table_id"]) == ("A", "t1 analysis 2", "cap 1", "t1") and a.coordinates[0].space == "MNI"
    again, new = workflow.run_create_analyses(bundles, replies, results)
    assert again.count() == 1 and new.count() == 0
    per = workflow.collections_by_article(results.unionByName(results.withColumn("pos", F.col("pos") + 1))).first()
    assert list(per.tables) == ["t1"]
    store, outcomes = workflow.run_upload(results, no_metadata(spark), st.empty(spark))
    assert outcomes.first().success and store["points"].count() == 1
    nobody = spark.createDataFrame([("q", "5", None, None)], "slug string, pmid string, doi string, pmcid string")
    assert workflow.run_upload(results, no_metadata(spark), st.empty(spark), nobody)[1].count() == 0


def test_extraction_stage(spark):
    downloads = rows(spark, ("s", "pubget", PUBGET), ("u", "pubget", {}), ("t", "pubget", PUBGET)).withColumn("pos", F.when(F.col("slug") == "s", 2).when(F.col("slug") == "t", 1).otherwise(0))
    cached = content(spark).filter("slug = 's'").withColumn("full_text_path", F.lit("here"))
    paths = spark.createDataFrame([("here",)], "path string")
    got, fresh = workflow.run_extraction(downloads, cached, None)
    got = got.orderBy("pos").collect()
    assert [r.slug for r in got] == ["u", "t", "s"] and got[0].error_message and fresh.count() == 2
    got, fresh = workflow.run_extraction(downloads, cached, paths.filter("path = 'gone'"))
    assert fresh.count() == 3 and got.count() == 3
    lost, _ = workflow.run_extraction(downloads, cached, None, extract=lambda d: articles.extract(d).filter("slug <> 't'"))
    assert {r.slug: r.error_message for r in lost.collect()}["t"] == "no result"


def test_hydration(spark):
    state = stages.State()
    one = spark.createDataFrame([(0, " 1 ", None, None)], "pos long, pmid string, doi string, pmcid string")
    missing = workflow.hydrate(stages.Settings(stages=("upload",)), state, lambda: one, {"download": lambda: one, "extract": lambda: one})
    assert missing == [] and state.frames["gather"].first().slug == "1" and "extract" in state.frames
    assert workflow.hydrate(stages.Settings(stages=("upload",), use_cached_inputs=False), stages.State(), lambda: one, {"download": lambda: one}) == ["download"]
    with pytest.raises(FileNotFoundError):
        workflow.hydrate(stages.Settings(stages=("upload",)), stages.State(), lambda: None, {})


def test_resolution_and_reasons(spark):
    targets = spark.createDataFrame([("a", "1", "10.1/a", None), ("b", "2", None, None)], "slug string, pmid string, doi string, pmcid string")
    found = spark.createDataFrame([("a", 1), ("10.1/a", 2), ("zz", 3), ("2", 4)], "slug string, n int")
    assert sorted((r.target, r.n) for r in workflow.resolve(targets, found).collect()) == [("a", 1), ("a", 2), ("b", 4)]
    both = workflow.first_present([found.filter("n = 1"), found.withColumn("n", F.col("n") * 10)])
    assert sorted((r.slug, r.n) for r in both.collect()) == [("10.1/a", 20), ("2", 40), ("a", 1), ("zz", 30)]
    bad = spark.createDataFrame([("s", 2, "late"), ("s", 1, "early"), ("s", 3, None), ("t", 1, "")], "slug string, pos int, error_message string")
    assert [tuple(r) for r in workflow.failure_reasons(bad).collect()] == [("s", "early | late")]
    stems = spark.createDataFrame([("a", "x", 0), ("a", "x", 1), ("a", "x-1", 2), ("a", "x-1", 3), ("b", "x", 0)], "scope string, base string, i int")
    assert sorted((r.scope, r.i, r.stem) for r in rel.unique_stems(stems, "scope", "base", "i").collect()) == [("a", 0, "x"), ("a", 1, "x-1"), ("a", 2, "x-1-2"), ("a", 3, "x-1-3"), ("b", 0, "x")]


def test_export_trees(spark, tmp_path):
    bundles = workflow.bundles(content(spark), no_metadata(spark))
    replies = spark.createDataFrame([("s::t1", REPLY)], "key string, arguments string")
    results = workflow.build_collections(workflow.pending_tables(bundles, ""), replies)
    root = f"file://{tmp_path}/tree"
    sinks.write_leaves(sinks.article_leaves(bundles, results), root)
    got = {(r.slug, r.leaf): r.value for r in sinks.read_leaves(spark, root).collect()}
    assert {leaf for slug, leaf in got if slug == "s"} == {"identifiers.json", "metadata.json", "article.txt", "tables.jsonl", "table_sources.json", "analyses.jsonl", "tables/t1.xml", "tables/t1_coordinates.csv", "tables/t2.xml", "tables/t2_coordinates.csv"}
    assert got["s", "tables/t1_coordinates.csv"] == "x,y,z\n-12.0,3.5,4.0" and json.loads(got["s", "identifiers.json"])["pmid"] == "1"
    lines = [json.loads(x) for x in got["s", "analyses.jsonl"].splitlines()]
    assert [(x["table_id"], x["coordinate_space"]) for x in lines] == [("t1", "MNI")] * 2
    leaves = spark.createDataFrame([("s", "article.txt", "changed"), ("new", "article.txt", "n"), ("", "x", "y"), ("n2", "z", None)], "slug string, leaf string, value string")
    sinks.write_leaves(leaves, root, overwrite=False)
    got = {(r.slug, r.leaf): r.value for r in sinks.read_leaves(spark, root).collect()}
    assert got["s", "article.txt"].startswith("A study") and got["new", "article.txt"] == "n" and ("n2", "z") not in got
    sinks.write_leaves(leaves, root)
    got = {(r.slug, r.leaf): r.value for r in sinks.read_leaves(spark, root).collect()}
    assert got["s", "article.txt"] == "changed" and ("s", "metadata.json") in got
    export = sinks.article_export(bundles, results).filter("slug = 's'").first()
    assert json.loads(export.analyses)[0]["slug"] == "s::t1" and len(json.loads(export.processed)["tables"]) == 2
    assert sinks.article_export(bundles, results, F.lit("p")).filter("slug = 's'").first().analyses is None
    assert list(json.loads(sinks.analyses_document(results))) == ["s"]


def test_bundles_are_kept_or_replaced(spark, tmp_path):
    root = f"file://{tmp_path}/b"
    frame = lambda *r: spark.createDataFrame(list(r), "slug string, source string, v string")
    read = lambda: sorted((r.slug, r.v) for r in spark.read.json(root).collect())
    sinks.export_bundles(frame(("a", "x", "1"), (None, "x", "0")), root)
    sinks.export_bundles(frame(("a", "x", "2"), ("b", "x", "3")), root, overwrite=False)
    assert read() == [("a", "1"), ("b", "3")]
    sinks.export_bundles(frame(("a", "x", "4")), root)
    assert read() == [("a", "4"), ("b", "3")]


def test_settings_layers(tmp_path):
    path = tmp_path / "s.yaml"
    path.write_text("# a comment\nstages: [upload, sync]\nuse_cached_inputs: false\nupload_mode: OVERWRITE\n")
    got = stages.Settings().merged(stages.from_environment({"FOLIOFORGE_UPLOAD_MODE": "FILL", "FOLIOFORGE_DATA_ROOT": "d", "HOME": "h"}), stages.from_file(str(path)), {"dry_run": True})
    assert (got.stages, got.use_cached_inputs, got.upload_mode, got.data_root, got.dry_run) == (("upload", "sync"), False, "OVERWRITE", "d", True)
    with pytest.raises(ValueError):
        stages.from_environment({"FOLIOFORGE_NO_SUCH": "1"})


def test_command_line(spark, tmp_path):
    root = f"file://{tmp_path}"
    for name, text in PUBGET.items():
        write(tmp_path / "in/pmcid_7" / name, text)
    manifest = write(tmp_path / "m.jsonl", '{"pmid":"1","pmcid":"PMC7"}\n')
    page = json.dumps({"esearchresult": {"count": "2", "idlist": ["5", "6"]}})
    replay = write(tmp_path / "pages.jsonl", json.dumps({"query": "q", "year": None, "page": 0, "payload": page}) + "\n")
    run = lambda *a: cli.main(list(a), spark)
    run("search", "--query", "q", "--replay", replay, "--output", f"{root}/found.jsonl")
    assert readers.load_identifiers(spark, f"{root}/found.jsonl").count() == 2
    run("extract", "--input", f"{root}/in", "--manifest", manifest, "--output", f"{root}/contents")
    replies = write(tmp_path / "replies.jsonl", json.dumps({"key": "1-pmc7::t1", "arguments": REPLY}) + "\n")
    run("create-analyses", "--input", f"{root}/contents", "--replay", replies, "--cache", f"{root}/cache", "--output", f"{root}/results")
    assert spark.read.parquet(f"{root}/results").first().slug == "1-pmc7::t1" and caches.Cache(spark, f"{root}/cache", "create_analyses").count() == 1
    run("upload", "--input", f"{root}/results", "--manifest", manifest, "--output", f"{root}/store")
    assert st.load(spark, f"{root}/store")["points"].count() == 1
    run("sync", "--input", f"{root}/contents", "--analyses", f"{root}/results", "--output", f"{root}/tree")
    assert sinks.read_leaves(spark, f"{root}/tree").filter("leaf = 'analyses.jsonl'").count() == 1
    run("dump-tables", "--input", f"{root}/contents", "--output", f"{root}/dump")
    assert sinks.read_leaves(spark, f"{root}/dump").count() == 4
    run("index-legacy", "--input", f"{root}/in", "--source", "pubget", "--cache", f"{root}/cache")
    assert caches.Cache(spark, f"{root}/cache", "download", "pubget").load().first().slug == "pmc7"
    run("sample", "--input", write(tmp_path / "i.json", '{"n":["1",null,null],"m":["2",null,null]}'), "--output", f"{root}/sample.jsonl", "--n", "1")
    assert readers.load_identifiers(spark, f"{root}/sample.jsonl").count() == 1
    run("prune", "--cache", f"{root}/cache", "--manifest", manifest, "--apply")
    assert caches.Cache(spark, f"{root}/cache", "create_analyses").count() == 0
