"""Replayed provider responses."""

import json

import pytest
from pyspark.sql import functions as F

from folioforge.functions import cols, model, predicates
from folioforge.sources import providers

IDS = "pos long, slug string, pmid string, doi string, pmcid string, other_ids map<string,string>"


def pages(spark, query, counts):
    rows, at = [], 0
    for year, n, total in counts:
        for page in range(-(-n // providers.PAGE) or 1):
            ids = [str(at + i) for i in range(min(providers.PAGE, n - page * providers.PAGE))]
            at += len(ids)
            rows.append((query, year, page, json.dumps({"esearchresult": {"count": str(total), "idlist": ids}})))
    return spark.createDataFrame(rows, "query string, year int, page int, payload string")


def test_search_pages_and_years(spark):
    plain = pages(spark, "q", [(None, 2500, 2500)])
    got = providers.search(plain, " q ").orderBy("pos").collect()
    assert [r.pmid for r in got] == [str(i) for i in range(2500)]
    assert providers.search(plain, "  ").count() == 0
    capped = pages(spark, "q", [(None, 1000, 12000), (1990, 2, 2), (1991, 2, 2), (1992, 2, 2), (1989, 5, 5)])
    got = [r.pmid for r in providers.search(capped, "q", 1990, 1992).orderBy("pos").collect()]
    assert got == sorted(got) and len(got) == 6


def test_id_converter(spark):
    ids = spark.createDataFrame([(0, "a", "1", None, None, {"mid": "own"}), (1, "b", None, None, "PMC7", None), (2, "c", "3", "10.1/x", None, None)], IDS)
    records = [{"requested-id": "1", "pmid": 1, "doi": "10.1/one", "pmcid": "PMC1", "mid": "new", "aiid": "9"}, {"requested-id": "3", "doi": "10.1/other"}, {"requested-id": "4", "status": "error", "pmid": 4}, {"pmid": 8}]
    responses = spark.createDataFrame([(json.dumps({"records": records}),), ("broken",)], "payload string")
    got = {r.slug: r for r in providers.convert_ids(ids, responses, "pmid").collect()}
    assert got["a"].doi == "10.1/one" and got["a"].pmcid == "PMC1" and got["a"].other_ids == {"mid": "own", "aiid": "9"}
    assert got["c"].doi == "10.1/x" and got["b"].doi is None and got["b"].other_ids is None
    by = spark.createDataFrame([(json.dumps({"records": [{"requested-id": "7", "pmid": 70}]}),)], "payload string")
    assert {r.slug: r.pmid for r in providers.convert_ids(ids, by, "pmcid").collect()} == {"a": "1", "b": "70", "c": "3"}


def test_scholar_is_positional(spark):
    ids = spark.createDataFrame([(i, f"s{i}", None, f"10.1/{i}", None, None) for i in range(502)], IDS)
    records = [{"paperId": f"p{i}", "externalIds": {"PubMed": f" {i}", "MAG": f"m{i}", "DBLP": "d"}} for i in range(500)]
    records[1], records[2] = None, {"error": "none"}
    responses = spark.createDataFrame([(0, json.dumps(records)), (1, json.dumps([{"paperId": "p500", "externalIds": {"CorpusId": 5}}]))], "batch long, payload string")
    rows = {r.doi: r for r in providers.scholar_ids(ids, responses, "doi").collect()}
    assert rows["10.1/0"].pmid == "0" and rows["10.1/0"].other_ids == {"semantic_scholar_paper_id": "p0", "mag_id": "m0", "mag": "m0", "dblp": "d", "pubmed": " 0"}
    assert rows["10.1/1"].pmid is None and rows["10.1/2"].pmid is None and rows["10.1/3"].pmid == "3"
    assert rows["10.1/500"].other_ids == {"semantic_scholar_paper_id": "p500", "semantic_scholar_corpus_id": "5", "corpusid": "5"} and rows["10.1/501"].other_ids is None


def test_openalex(spark):
    ids = spark.createDataFrame([(0, "a", "12", None, None, {"openalex": "old", "x": "y"}), (1, "b", "13", None, None, None)], IDS)
    payload = {"results": [{"ids": {"openalex": "W1", "pmid": "https://pubmed.ncbi.nlm.nih.gov/12"}}, {"ids": {"openalex": "W2", "doi": "d"}}]}
    got = {r.slug: r.other_ids for r in providers.openalex_ids(ids, spark.createDataFrame([(json.dumps(payload),)], "payload string"), "pmid").collect()}
    assert got == {"a": {"openalex": "W1", "x": "y"}, "b": None}


def test_lookup_keys_are_required(spark):
    ids = spark.createDataFrame([(0, "a", "12", None, None, None)], IDS)
    assert predicates.require_lookup_key(ids, "pubmed", "pmid") is ids
    with pytest.raises(ValueError):
        predicates.require_lookup_key(ids, "openalex", "pmcid")
    with pytest.raises(ValueError):
        predicates.require_lookup_key(ids, "pubmed", "doi")


ARTICLE = """<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID Version="1">77</PMID>
<DateCompleted><Year>2001</Year></DateCompleted>
<Article><Journal><JournalIssue><PubDate><MedlineDate>1998 Dec-1999 Jan</MedlineDate></PubDate></JournalIssue><Title>J</Title></Journal>
<ArticleTitle>On <i>x</i> and y</ArticleTitle><Abstract><AbstractText Label="AIM">First.</AbstractText><AbstractText>Second.</AbstractText></Abstract>
<AuthorList><Author><LastName>Roe</LastName><Initials>R</Initials></Author><Author><CollectiveName>Group</CollectiveName></Author><Author><LastName>Doe</LastName><ForeName>Jo</ForeName><AffiliationInfo><Affiliation>Uni</Affiliation></AffiliationInfo></Author><Author/></AuthorList></Article>
<KeywordList><Keyword>b</Keyword><Keyword>a</Keyword><Keyword>b</Keyword></KeywordList></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>78</PMID><Article><ArticleTitle>Bare</ArticleTitle></Article></MedlineCitation></PubmedArticle></PubmedArticleSet>"""


def test_article_sets(spark):
    ids = spark.createDataFrame([(0, "a", "77", None, None, None), (1, "b", "78", None, None, None), (2, "c", "79", None, None, None)], IDS)
    got = {r.slug: r.metadata for r in providers.pubmed_metadata(ids, spark.createDataFrame([(ARTICLE,), ("<broken",)], "payload string")).collect()}
    m = got["a"]
    assert set(got) == {"a", "b"} and m.title == "On x and y" and m.journal == "J" and m.publication_year == 1998 and m.keywords == ["b", "a"]
    assert [(a.name, a.affiliation) for a in m.authors] == [("R Roe", None), ("Group", None), ("Jo Doe", "Uni")]
    assert m.abstract == "AIM: First.\n\nSecond." and got["b"].authors == [] and got["b"].abstract is None and got["b"].publication_year is None


def test_fallback_metadata(spark):
    xml = "<article><front><journal-meta><journal-title>J</journal-title></journal-meta><article-meta><article-title>A  <b>t</b></article-title><contrib contrib-type='author'><name><surname>Roe</surname><given-names>R</given-names></name></contrib><contrib contrib-type='editor'><surname>No</surname></contrib><contrib><collab>Team</collab></contrib><pub-date><year>2001</year></pub-date><pub-date pub-type='epub'><year>2002</year></pub-date></article-meta></front></article>"
    got = providers.jats_metadata(spark.createDataFrame([("a", xml), ("b", "<article/>")], "slug string, xml string")).collect()
    assert len(got) == 1 and got[0].metadata.title == "A t" and [a.name for a in got[0].metadata.authors] == ["R Roe", "Team"] and got[0].metadata.publication_year == 2002
    doc = json.dumps({"title": "T", "authors": [{"given-name": "A", "surname": "B"}, {"name": "C"}], "publicationName": "P", "coverDate": "2011-03-01"})
    got = providers.elsevier_metadata(spark.createDataFrame([("a", doc), ("b", "{}")], "slug string, json string")).collect()
    assert len(got) == 1 and [a.name for a in got[0].metadata.authors] == ["A B", "C"] and got[0].metadata.publication_year == 2011 and got[0].metadata.journal == "P"


def test_scholar_metadata_and_cache(spark):
    ids = spark.createDataFrame([(0, "a", "77", "10.1/a", None, None), (1, "b", "78", None, None, None), (2, "c", None, None, "PMC1", None)], IDS)
    reply = [{"title": "A", "authors": [{"name": "N"}], "year": 2000, "isOpenAccess": True, "venue": "V"}, {"title": "B"}]
    found = providers.scholar_metadata(ids, spark.createDataFrame([(0, json.dumps(reply))], "batch long, payload string"))
    got = {r.slug: r.metadata for r in found.collect()}
    assert got["a"].open_access is True and got["a"].journal == "V" and got["b"].title == "B" and set(got) == {"a", "b"}
    cache = found.select("slug", model.encode(F.col("metadata")).alias("payload")).unionByName(spark.createDataFrame([("c", "{broken")], "slug string, payload string"))
    hits, rest = providers.cached_metadata(ids, cache)
    assert {r.slug: r.metadata for r in hits.collect()} == got and [r.slug for r in rest.collect()] == ["c"]


def test_parsed_tables(spark):
    reply = {"analyses": [{"name": "A", "points": [{"coordinates": [1, 2.5, -3], "space": "tal", "values": [{"value": "4", "kind": None}, {"value": 2, "kind": "z-score"}, 9], "cluster_size": "-12", "cluster_measure": "mm3", "is_seed": True}, {"coordinates": [1, 2]}, {"coordinates": ["1", 2, 3]}, "x", {"coordinates": [4, 5, 6], "values": ["7.5", "n/a"]}]}, "junk", {"name": None, "points": []}]}
    rows = [("k", json.dumps(reply)), ("l", json.dumps({"analyses": 3})), ("m", "{broken")]
    got = providers.parse_analyses(spark.createDataFrame(rows, "key string, arguments string")).orderBy("key", "place").collect()
    assert [(r.key, r.place, r.name) for r in got] == [("k", 0, "A"), ("k", 2, None)]
    p, q = got[0].points
    assert (p.x, p.y, p.z, p.statistic_value, p.statistic_type, p.cluster_size, p.cluster_measure, p.is_seed, p.is_subpeak) == (1.0, 2.5, -3.0, 2.0, "Z", 12, "mm^3", True, False)
    assert (q.statistic_value, q.statistic_type) == (7.5, "T")
    spaced = providers.parse_analyses(spark.createDataFrame(rows, "key string, arguments string")).select(providers.with_space(F.col("points"), F.lit("MNI")).alias("p")).collect()
    assert [x.space for x in spaced[0].p] == ["TAL", "MNI"]
    with pytest.raises(Exception, match="no function call"):
        providers.parse_analyses(spark.createDataFrame([("k", None)], "key string, arguments string")).collect()


def test_node_text_lists_payloads_and_keys(spark):
    df = spark.createDataFrame([('"a"',), ('{"#text":"b","@x":"y"}',), ('{"i":"c","j":"d"}',), (None,), ("[1,2]",), ("null",)], "j string")
    assert [r[0] for r in df.select(cols.node_text(F.col("j"))).collect()][:4] == ["a", "b", "c d", ""]
    assert [r[0] for r in df.select(cols.as_list(F.col("j"))).collect()] == [['"a"'], ['{"#text":"b","@x":"y"}'], ['{"i":"c","j":"d"}'], [], ["1", "2"], []]
    ids = spark.createDataFrame([(None, "1", "null", None, None), ("n", None, "10.1/x", None, {"a": "b"})], "neurostore string, pmid string, doi string, pmcid string, other_ids map<string,string>")
    c = [F.col(x) for x in ("neurostore", "pmid", "doi", "pmcid", "other_ids")]
    assert [json.loads(r[0]) for r in ids.select(cols.identifier_payload(*c)).collect()] == [{"pmid": "1", "other_ids": {}}, {"neurostore": "n", "doi": "10.1/x", "other_ids": {"a": "b"}}]
    key = cols.identifier_key(F.col("neurostore"), F.col("doi"), F.col("pmid"), F.col("pmcid"), F.struct("pmid"))
    assert [tuple(r[0]) for r in ids.select(key).collect()] == [("doi", "null"), ("neurostore", "n")]


def test_codecs_are_inverse(spark):
    import datetime

    file = ("p", "xml", "text/xml", "pubget", datetime.datetime(2020, 1, 2, 3, 4, 5, 60), None)
    df = spark.createDataFrame([((("n", "1", None, None, {"a": "b"}), "pubget", True, [file], None),)], f"d {model.DOWNLOAD}")
    back = df.select(model.decode(model.encode(F.col("d")), model.DOWNLOAD).alias("d"))
    assert back.collect() == df.collect()
    times = spark.sql("SELECT TIMESTAMP_NTZ'2020-01-02 03:04:05' AS t UNION ALL SELECT TIMESTAMP_NTZ'2020-01-02 03:04:05.5'")
    assert sorted(r[0] for r in times.select(model.iso_time(F.col("t"))).collect()) == ["2020-01-02T03:04:05", "2020-01-02T03:04:05.500000"]
    assert times.select(model.parse_iso(model.iso_time(F.col("t"))) == F.col("t")).distinct().collect()[0][0] is True


def test_metadata_predicates(spark):
    rows = [(("T", None, None, None, None, None, None, None, None, None),), ((" ", None, " ", None, None, None, None, None, None, None),), ((None, None, None, None, None, None, None, None, False, None),), (None,), (("T", [("A", None, None)], "a", "j", 2000, ["k"], "l", "s", True, {}),)]
    df = spark.createDataFrame(rows, f"m {model.METADATA}")
    m = F.col("m")
    got = df.select(predicates.useful_metadata(m), predicates.substantive_metadata(m), predicates.complete_metadata(m), predicates.needs_more_metadata(m)).collect()
    assert [tuple(r) for r in got] == [(True, False, False, True), (True, False, False, True), (True, True, False, True), (False, False, False, True), (True, True, True, False)]


def test_prompt(spark):
    df = spark.range(1).select(cols.table_prompt(F.lit("Do."), F.lit("T"), F.lit(None).cast("string"), F.lit("t1"), F.lit(3), F.lit("c"), F.lit(None).cast("string"), F.expr("map('b', '1', 'a', '2')"), F.lit("<table/>")))
    assert df.first()[0] == 'Do.\n\nTitle: T\nAbstract: \nTable: t1\nNumber: 3\nCaption: c\nFooter: \nMetadata: {"a":"2","b":"1"}\n\nContent:\n<table/>'
