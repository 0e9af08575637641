"""Named queries of article files, provider responses, the cache and the store, each with its SQL twin.

Documents and responses are made from the driver's tables by fixed rules, so that an SQL engine knows what must come out
without reading them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import cols, model, predicates
from folioforge.operators import cache as caches
from folioforge.operators import relational as rel
from folioforge.operators import store as st
from folioforge.plans import workflow
from folioforge.plans.queries import IDS, _n, ids, query, table
from folioforge.sources import articles, providers, sinks


def _null(kind: str = "string"):
    return F.lit(None).cast(kind)


def _identifier(**fields):
    return F.struct(*((fields[n] if n in fields else _null()).alias(n) for n in ("neurostore", "pmid", "doi", "pmcid")), _null("map<string,string>").alias("other_ids"))


def _text(c):
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _part_articles(spark: SparkSession, sf: str, source: str, files) -> DataFrame:
    return table(spark, sf, "part").select(_text("p_partkey").alias("slug"), F.lit(source).alias("source"), _identifier(pmid=_text("p_partkey")).alias("identifier"), files.alias("files"))


_SPACE = "CASE WHEN p_size % 2 = 0 THEN 'MNI' ELSE 'TAL' END"


def _space_word():
    return F.when(F.col("p_size") % 2 == 0, "MNI").otherwise("Talairach")


def pubget_articles(spark: SparkSession, sf: str) -> DataFrame:
    size = _text("p_size")
    xml = F.concat(F.lit("<article><front><article-title>"), F.col("p_name"), F.lit("</article-title><kwd>"), F.col("p_type"), F.lit("</kwd></front><body><p>in "), _space_word(), F.lit(" space</p></body></article>"))
    listing = F.concat(F.lit("<s><extracted-table><table-id>"), F.col("p_brand"), F.lit("</table-id><table-label>Table "), size, F.lit("</table-label><original-table><t/></original-table></extracted-table></s>"))
    info = F.to_json(F.struct(F.when(F.col("p_partkey") % 3 == 0, F.lit("other")).otherwise(F.col("p_brand")).alias("table_id"), F.concat(F.lit("Table "), size).alias("table_label"), F.lit(1).alias("n_header_rows"), F.lit("table_000.csv").alias("table_data_file")))
    csv = F.concat(F.lit("Region,k,x,y,z\nGroup,,,,\na,\"1,000\","), size, F.lit(",−"), size, F.lit(",0.5\nb,2,900,1,1\nc,3,"), size, F.lit(",n/a,1\n"))
    files = F.create_map(F.lit("article.xml"), xml, F.lit("tables/tables.xml"), listing, F.lit("tables/table_000_info.json"), info, F.lit("tables/table_000.csv"), csv)
    return _part_articles(spark, sf, "pubget", files)


@query(f"""SELECT '' || p_partkey AS slug, CASE WHEN p_partkey % 3 = 0 THEN 'other' ELSE regexp_replace(lower(p_brand), '[^a-z0-9_-]+', '-', 'g') END AS table_id,
 p_size::DOUBLE AS x, -p_size::DOUBLE AS y, 0.5::DOUBLE AS z, {_SPACE} AS space FROM part""")
def pubget_points(spark, sf):
    return articles.explode_points(articles.extract(pubget_articles(spark, sf))).select("slug", "table_id", "x", "y", "z", "space")


@query(f"SELECT '' || p_partkey AS slug, md5(p_name || chr(10) || chr(10) || p_type || chr(10) || chr(10) || 'in ' || CASE WHEN p_size % 2 = 0 THEN 'MNI' ELSE 'Talairach' END || ' space') AS text, p_size::BIGINT AS table_number, true AS has_coordinates FROM part")
def pubget_texts(spark, sf):
    out = articles.extract(pubget_articles(spark, sf))
    return out.select("slug", F.md5("full_text").alias("text"), _n(F.col("tables")[0]["table_number"]).alias("table_number"), "has_coordinates")


@query(f"SELECT '' || p_partkey AS slug, 'tb' || p_size AS table_id, p_size::DOUBLE AS x, -1.5::DOUBLE AS y, (p_size + 1)::DOUBLE AS z, {_SPACE} AS space, p_name AS caption FROM part")
def elsevier_points(spark, sf):
    size = _text("p_size")
    xml = F.concat(F.lit("<d><para>"), _space_word(), F.lit('</para><table id="tb'), size, F.lit('"><label>Table '), size, F.lit("</label><caption>"), F.col("p_name"), F.lit('</caption><tgroup><thead><row><entry>r</entry><entry>x</entry><entry>y</entry><entry>z</entry></row></thead><tbody><row><entry namest="c1" nameend="c4">head</entry></row><row><entry>a</entry><entry>'), size, F.lit("</entry><entry>−1.5</entry><entry>"), _text(F.col("p_size") + 1), F.lit("</entry></row></tbody></tgroup></table></d>"))
    out = articles.extract(_part_articles(spark, sf, "elsevier", F.create_map(F.lit("content.xml"), xml, F.lit("metadata.json"), F.lit("{}"))))
    points = articles.explode_points(out).select("slug", "table_id", "x", "y", "z", "space")
    return points.join(out.select("slug", F.col("tables")[0]["caption"].alias("caption")), "slug")


@query("SELECT '' || p_partkey AS slug, '' || p_size AS table_id, p_size::DOUBLE AS x, 2::DOUBLE AS y, 3::DOUBLE AS z, 'TAL' AS space FROM part UNION ALL SELECT '' || p_partkey, 'table-002', 7, 8, 9, CASE WHEN p_size % 2 = 0 THEN 'MNI' ELSE 'TAL' END FROM part")
def saved_page_points(spark, sf):
    size = _text("p_size")
    html = F.concat(F.lit("<html><script>MNI MNI</script><p>"), _space_word(), F.lit("</p><table><caption>Table "), size, F.lit(" (Talairach)</caption><tr><th>n<th>x<th>y<th>z<tr><td>a<td>"), size, F.lit("<td>2<td>3</tr><tr><td colspan=4>end</table><table><tr><td>7</td><td>8</td><td>9</td></tr></table></html>"))
    out = articles.extract(_part_articles(spark, sf, "ace", F.create_map(F.lit("page.html"), html)))
    return articles.explode_points(out).select("slug", "table_id", "x", "y", "z", "space")


@query("""SELECT '' || p_partkey AS slug, p_partkey % 4 = 0 AS success, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'missing: tables/tables.xml' WHEN 2 THEN 'missing: tables/a.csv' ELSE 'missing: Invalid JSON: tables/table_000_info.json' END AS error_message FROM part""")
def download_audit(spark, sf):
    k = F.col("p_partkey")
    info = F.when(k % 4 == 3, "{broken").otherwise('{"table_data_file":"a.csv"}')
    files = F.map_filter(F.create_map(F.lit("article.xml"), F.lit("x"), F.lit("tables/tables.xml"), F.when(k % 4 != 1, "y"), F.lit("tables/table_000_info.json"), info, F.lit("tables/a.csv"), F.when(k % 4 != 2, "z")), lambda _, v: v.isNotNull())
    out = articles.audit(_part_articles(spark, sf, "pubget", files))
    return out.select("slug", "success", "error_message")


@query("""SELECT p_partkey, p_partkey % 5 = 4 AS success, CASE p_partkey % 5 WHEN 0 THEN 'no payload was returned' WHEN 1 THEN 'failure: ' || p_name WHEN 2 THEN 'exception: ' || p_brand WHEN 3 THEN 'metadata without a content payload' END AS error_message FROM part""")
def download_outcomes(spark, sf):
    k = F.col("p_partkey")
    file = F.struct(F.lit("p").alias("file_path"), F.when(k % 5 == 4, "xml").otherwise("json").alias("file_type"), *(_null(t).alias(n) for n, t in (("content_type", "string"), ("source", "string"), ("downloaded_at", "timestamp_ntz"), ("md5", "string"))))
    outcome = articles.download_outcome(k % 5 != 0, k % 5 != 1, F.col("p_name"), F.when(k % 5 == 2, F.col("p_brand")), F.array(file))
    return table(spark, sf, "part").select("p_partkey", outcome.alias("o")).select("p_partkey", "o.*")


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_partkey % 2 = 0 WHEN 1 THEN p_size > 10 ELSE p_size > 20 END AS present FROM part")
def payload_checks(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size")
    source = F.when(k % 3 == 0, "ace").when(k % 3 == 1, "pubget").otherwise("elsevier")
    file = lambda path, kind: F.struct(path.alias("file_path"), F.lit(kind).alias("file_type"))
    files = F.array(file(F.lit("d/article.xml"), "xml"), file(F.when(size > 10, "d/tables.xml").otherwise("d/other.xml"), "xml"), file(F.lit("d/content.xml"), "xml"), file(F.when(size > 20, "metadata.json").otherwise("m.json"), "json"))
    files = F.when((k % 3 == 0) & (k % 2 == 0), F.concat(files, F.array(file(F.lit("p.html"), "html")))).otherwise(files)
    return table(spark, sf, "part").select("p_partkey", predicates.payload_present(source, files).alias("present"))


@query("""SELECT '' || c_custkey AS slug, 'On ' || c_name AS title, (1950 + c_nationkey)::BIGINT AS publication_year, 'R. ' || c_nationkey || '; Team' AS authors,
 'AIM: ' || c_mktsegment || chr(10) || chr(10) || 'End.' AS abstract, c_mktsegment || '|x' AS keywords FROM customer""")
def pubmed_metadata(spark, sf):
    c = table(spark, sf, "customer")
    key, nation = _text("c_custkey"), _text("c_nationkey")
    date = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("<Year>"), _text(F.col("c_nationkey") + 1950), F.lit("</Year>"))).otherwise(F.concat(F.lit("<MedlineDate>Winter "), _text(F.col("c_nationkey") + 1950), F.lit("</MedlineDate>")))
    xml = F.concat(F.lit("<PubmedArticle><MedlineCitation><PMID>"), key, F.lit("</PMID><Article><Journal><JournalIssue><PubDate>"), date, F.lit("</PubDate></JournalIssue></Journal><ArticleTitle>On <i>"), F.col("c_name"), F.lit('</i></ArticleTitle><Abstract><AbstractText Label="AIM">'), F.col("c_mktsegment"), F.lit("</AbstractText><AbstractText>End.</AbstractText></Abstract><AuthorList><Author><LastName>"), nation, F.lit("</LastName><Initials>R.</Initials></Author><Author/><Author><CollectiveName>Team</CollectiveName></Author></AuthorList></Article><KeywordList><Keyword>"), F.col("c_mktsegment"), F.lit("</Keyword><Keyword>x</Keyword><Keyword>x</Keyword></KeywordList></MedlineCitation></PubmedArticle>"))
    batches = c.select(F.floor(F.col("c_custkey") / providers.BATCH["pubmed"]).alias("b"), xml.alias("x")).groupBy("b").agg(F.concat(F.lit("<PubmedArticleSet>"), F.array_join(F.collect_list("x"), ""), F.lit("</PubmedArticleSet>")).alias("payload"))  # one request's articles
    found = providers.pubmed_metadata(c.select(key.alias("slug"), key.alias("pmid")), batches)
    names = F.array_join(F.transform("metadata.authors", lambda a: a["name"]), "; ")
    return found.select("slug", "metadata.title", _n("metadata.publication_year").alias("publication_year"), names.alias("authors"), "metadata.abstract", F.array_join("metadata.keywords", "|").alias("keywords"))


@query(f"""WITH {IDS} SELECT pos, pmid, CASE WHEN pmid IS NOT NULL AND doi IS NULL THEN '10.9/c' || pos ELSE doi END AS doi, CASE WHEN pmid IS NOT NULL AND pmcid IS NULL THEN 'PMC9' || pos ELSE pmcid END AS pmcid,
 CASE WHEN pmid IS NOT NULL THEN 'v' || pos END AS version FROM ids""")
def id_converter_fill(spark, sf):
    rows = ids(spark, sf).withColumn("other_ids", _null("map<string,string>"))
    record = F.struct(F.col("pmid").alias("requested-id"), F.concat(F.lit("10.9/c"), _text("pos")).alias("doi"), F.concat(F.lit("PMC9"), _text("pos")).alias("pmcid"), F.concat(F.lit("v"), _text("pos")).alias("version"))
    responses = rows.filter("pmid IS NOT NULL").groupBy(F.floor(F.col("pos") / 200).alias("b")).agg(F.to_json(F.struct(F.collect_list(record).alias("records"))).alias("payload"))
    out = providers.convert_ids(rows, responses, "pmid")
    return out.select("pos", "pmid", "doi", "pmcid", F.col("other_ids")["version"].alias("version"))


@query(f"""WITH {IDS}, asked AS (SELECT pos, row_number() OVER (ORDER BY pos) - 1 AS n FROM ids WHERE pmid IS NOT NULL)
SELECT i.pos, CASE WHEN a.pos IS NOT NULL AND n % 500 % 7 <> 0 AND i.doi IS NULL THEN '10.7/' || (n // 500) || '-' || (n % 500) ELSE i.doi END AS doi,
 CASE WHEN a.pos IS NOT NULL AND n % 500 % 7 <> 0 THEN 'p' || (n // 500) || '-' || (n % 500) END AS paper FROM ids i LEFT JOIN asked a ON i.pos = a.pos""")
def scholar_positions(spark, sf):
    rows = ids(spark, sf).withColumn("other_ids", _null("map<string,string>"))
    asked = providers.requests(rows, "semantic_scholar", "pmid")
    responses = _scholar_payloads(asked)
    out = providers.scholar_ids(rows, responses, "pmid")
    return out.select("pos", "doi", F.col("other_ids")["semantic_scholar_paper_id"].alias("paper"))


def _scholar_payloads(asked: DataFrame) -> DataFrame:
    """A response a batch: a record for each place, null for every seventh."""
    name = F.concat(_text("batch"), F.lit("-"), _text("place"))
    record = F.when(F.col("place") % 7 == 0, "null").otherwise(F.to_json(F.struct(F.concat(F.lit("p"), name).alias("paperId"), F.create_map(F.lit("DOI"), F.concat(F.lit("10.7/"), name)).alias("externalIds"))))
    lists = asked.select("batch", "place", record.alias("r")).groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("place", "r"))).alias("rs"))
    return lists.select("batch", F.concat(F.lit("["), F.array_join(F.transform("rs", lambda s: s["r"]), ","), F.lit("]")).alias("payload"))


@query(f"WITH {IDS} SELECT pos, CASE WHEN pmid IS NOT NULL AND pos % 2 = 0 THEN 'W' || pos END AS openalex FROM ids")
def openalex_fill(spark, sf):
    rows = ids(spark, sf).withColumn("other_ids", _null("map<string,string>"))
    work = F.struct(F.struct(F.concat(F.lit("W"), _text("pos")).alias("openalex"), F.concat(F.lit(cols.PUBMED_PREFIX), F.col("pmid")).alias("pmid")).alias("ids"))
    responses = rows.filter("pmid IS NOT NULL AND pos % 2 = 0").groupBy(F.floor(F.col("pos") / 100).alias("b")).agg(F.to_json(F.struct(F.collect_list(work).alias("results"))).alias("payload"))
    return providers.openalex_ids(rows, responses, "pmid").select("pos", F.col("other_ids")["openalex"].alias("openalex"))


def _pages(spark: SparkSession, sf: str, year, total: int) -> DataFrame:
    c = table(spark, sf, "customer").select(year.cast("int").alias("year"), F.floor(F.col("c_custkey") / providers.PAGE).cast("int").alias("page"), "c_custkey")
    lists = c.groupBy("year", "page").agg(F.array_sort(F.collect_list("c_custkey")).alias("k"))
    body = F.to_json(F.struct(F.struct(F.lit(str(total)).alias("count"), F.transform("k", lambda k: k.cast("string")).alias("idlist")).alias("esearchresult")))
    return lists.select(F.lit("q").alias("query"), "year", "page", body.alias("payload"))


@query("SELECT '' || c_custkey AS pmid, row_number() OVER (ORDER BY c_custkey) AS pos FROM customer")
def search_pages(spark, sf):
    return providers.search(_pages(spark, sf, _null("int"), providers.CAP - 1), " q ")


@query("SELECT '' || c_custkey AS pmid, row_number() OVER (ORDER BY '' || c_custkey) AS pos FROM customer WHERE 1980 + c_nationkey >= 1990")
def search_years(spark, sf):
    years = _pages(spark, sf, 1980 + F.col("c_nationkey"), 5)
    again = years.withColumn("year", F.lit(1999))  # ids of several years count once
    plain = _pages(spark, sf, _null("int"), providers.CAP)
    return providers.search(plain.unionByName(years).unionByName(again.filter("page < 0")), "q", 1990, 2100)


@query("""SELECT '' || p_partkey AS key, p_name AS name, p_size::DOUBLE AS x, CASE WHEN p_partkey % 2 = 0 THEN p_retailprice ELSE 7.5 END AS statistic_value, CASE WHEN p_partkey % 2 = 0 THEN 'Z' ELSE 'T' END AS statistic_type,
 p_size::BIGINT AS cluster_size, 'mm^3' AS cluster_measure, CASE WHEN p_size % 3 = 0 THEN 'TAL' ELSE 'MNI' END AS space FROM part""")
def parsed_tables(spark, sf):
    size = F.col("p_size")
    values = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit('[{"value":1,"kind":null},{"kind":"z-score","value":'), _text("p_retailprice"), F.lit("}]"))).otherwise('["n/a","7.5",{"kind":"p"}]')
    point = F.concat(F.lit('{"coordinates":['), _text(size), F.lit(',2,3],"space":"'), F.when(size % 3 == 0, "talairach").otherwise("?"), F.lit('","cluster_size":-'), _text(size), F.lit(',"cluster_measure":" MM3 ","values":'), values, F.lit("}"))
    reply = F.concat(F.lit('{"analyses":["junk",{"name":"'), F.col("p_name"), F.lit('","points":[7,{"coordinates":[1,2]},{"coordinates":["1",2,3]},'), point, F.lit("]}]}"))
    parsed = providers.parse_analyses(table(spark, sf, "part").select(_text("p_partkey").alias("key"), reply.alias("arguments")))
    spaced = parsed.select("key", "name", F.explode(providers.with_space(F.col("points"), F.lit("MNI"))).alias("p"))
    return spaced.select("key", "name", "p.x", "p.statistic_value", "p.statistic_type", _n("p.cluster_size").alias("cluster_size"), "p.cluster_measure", "p.space")


def _collections(spark: SparkSession, sf: str) -> DataFrame:
    """A collection for each part: two analyses of one name, points of the part's size and number."""
    point = lambda x, kind: F.struct(x.cast("double").alias("x"), F.lit(2.0).alias("y"), F.lit(3.0).alias("z"), _null().alias("space"), F.when(F.lit(bool(kind)), F.col("p_retailprice")).alias("statistic_value"), F.lit(kind).cast("string").alias("statistic_type"), F.col("p_size").alias("cluster_size"), _null().alias("cluster_measure"), F.lit(False).alias("is_subpeak"), F.lit(False).alias("is_deactivation"), F.lit(False).alias("is_seed"))
    analysis = lambda *points: F.struct(F.when(F.col("p_partkey") % 2 == 0, "unknown").otherwise(F.col("p_name")).alias("name"), _null().alias("description"), F.array(*points).alias("coordinates"), F.col("p_brand").alias("table_id"), F.lit(1).alias("table_number"), F.col("p_type").alias("table_caption"), _null().alias("table_footer"), F.create_map(F.lit("sanitized_table_id"), F.lower("p_brand")).alias("metadata"))
    both = F.array(analysis(point(F.col("p_size"), "T"), point(F.lit(1.0), None)), analysis(point(F.col("p_partkey"), None)))
    collection = F.struct(F.concat(_text("p_partkey"), F.lit("::t")).alias("slug"), F.lit("MNI").alias("coordinate_space"), _identifier(pmid=_text("p_partkey")).alias("identifier"), both.alias("analyses")).cast(model.COLLECTION)
    return table(spark, sf, "part").select(_text("p_partkey").alias("article_slug"), F.lit(0).cast("long").alias("pos"), collection.alias("collection"))


def _part_metadata(spark: SparkSession, sf: str) -> DataFrame:
    m = providers._metadata(title=F.col("p_name"), journal=F.col("p_type"), publication_year=F.col("p_size") + 1990, authors=providers._authors(F.array("p_brand", "p_type")))
    return table(spark, sf, "part").select(_text("p_partkey").alias("slug"), m.alias("metadata"))


@query("""WITH a AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN lower(p_brand) ELSE p_name END AS base, p_size, p_name, p_type, p_brand FROM part)
SELECT '' || p_partkey AS pmid, p_name AS study, p_brand || '; ' || p_type AS authors, base AS analysis, 1::BIGINT AS place, 2::BIGINT AS n_points, (p_size + 1)::DOUBLE AS sum_x, 1::BIGINT AS n_values FROM a
UNION ALL SELECT '' || p_partkey, p_name, p_brand || '; ' || p_type, base || '-2', 2, 1, p_partkey::DOUBLE, 0 FROM a""")
def store_upload(spark, sf):
    items = st.work_items(_collections(spark, sf), _part_metadata(spark, sf))
    store, _ = st.upload(items, st.empty(spark))
    points = store["points"].join(store["point_values"].select(F.col("point_id").alias("id"), F.lit(1).alias("v")), "id", "left").groupBy(F.col("analysis_id").alias("id")).agg(F.count("*").alias("n_points"), F.sum("x").alias("sum_x"), F.count("v").alias("n_values"))
    analyses = store["analyses"].select("id", "study_id", F.col("name").alias("analysis"), _n("order").alias("place")).join(points, "id")
    studies = store["studies"].select(F.col("id").alias("study_id"), "pmid", F.col("name").alias("study"), "authors")
    return analyses.join(studies, "study_id").select("pmid", "study", "authors", "analysis", "place", "n_points", "sum_x", "n_values")


@query("SELECT '' || p_partkey AS slug, true AS success, 2::BIGINT AS n_analyses FROM part WHERE p_size % 5 <> 0 UNION ALL SELECT '' || p_partkey, false, 0 FROM part WHERE p_size % 5 = 0")
def store_outcomes(spark, sf):
    lost = F.transform("collection.analyses", lambda a: a.withField("coordinates", F.transform(a["coordinates"], lambda c: c.withField("x", F.when(F.col("collection.analyses")[0]["coordinates"][0]["x"] % 5 != 0, c["x"])))))
    broken = _collections(spark, sf).withColumn("collection", F.col("collection").withField("analyses", lost))
    _, outcomes = st.upload(st.work_items(broken, _part_metadata(spark, sf)), st.empty(spark))
    return outcomes.select("slug", "success", _n(F.size("analysis_ids")).alias("n_analyses"))


@query("""SELECT '' || p_partkey AS pmid, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type END AS study, 1::BIGINT AS n_studies FROM part""")
def store_base_studies(spark, sf):
    old = table(spark, sf, "part").select(F.concat(F.lit("b"), _text("p_partkey")).alias("id"), F.when(F.col("p_partkey") % 2 == 1, F.col("p_type")).alias("name"), *(_null().alias(c) for c in ("description", "publication", "doi")), _text("p_partkey").alias("pmid"), *(_null().alias(c) for c in ("pmcid", "authors", "year")), _null("map<string,string>").alias("metadata"), _null("boolean").alias("is_oa"), F.lit("group").alias("level"), F.lit(True).alias("public"), _null("boolean").alias("has_coordinates"), F.lit("2020-01-01 00:00:00").cast("timestamp").alias("created_at"))
    store, _ = st.upload(st.work_items(_collections(spark, sf), _part_metadata(spark, sf)), st.empty(spark) | {"base_studies": old}, mode="FILL", metadata_only=True)
    n = store["studies"].groupBy(F.col("base_study_id").alias("id")).agg(F.count("*").alias("n_studies"))
    return store["base_studies"].join(n, "id").select("pmid", F.col("name").alias("study"), "n_studies")


@query("SELECT '' || p_partkey AS article, lower(p_brand) AS first_table, 2::BIGINT AS n_analyses, p_brand AS line_table, 'MNI' AS space FROM part")
def analysis_export(spark, sf):
    results = _collections(spark, sf).withColumn("table_id", F.lower(F.col("collection.analyses")[0]["table_id"]))
    twice = results.unionByName(results.withColumn("pos", F.lit(-1).cast("long")).withColumn("collection", _null(model.COLLECTION)))
    per = workflow.collections_by_article(twice).select("article_slug", F.explode("tables").alias("table_id", "collection"))
    line = sinks.analysis_lines(F.col("table_id"), F.col("collection"))
    read = F.get_json_object(line[0], "$.table_id").alias("line_table"), F.get_json_object(line[1], "$.coordinate_space").alias("space")
    return per.select(F.col("article_slug").alias("article"), F.col("table_id").alias("first_table"), _n(F.size(line)).alias("n_analyses"), *read)


@query(f"""WITH {IDS} SELECT pos, CASE WHEN doi IS NOT NULL AND doi <> '' THEN 'doi' WHEN pmid IS NOT NULL THEN 'pmid' WHEN pmcid IS NOT NULL THEN 'pmcid' ELSE 'json' END AS field,
 CASE WHEN doi IS NOT NULL AND doi <> '' THEN doi WHEN pmid IS NOT NULL THEN pmid WHEN pmcid IS NOT NULL THEN pmcid ELSE '{{"pos":' || pos || '}}' END AS value FROM ids""")
def identifier_keys(spark, sf):
    key = cols.identifier_key(_null(), F.col("doi"), F.col("pmid"), F.col("pmcid"), F.struct("pos"))
    return ids(spark, sf).select("pos", key.alias("k")).select("pos", "k.field", "k.value")


@query(f"WITH {IDS} SELECT pos, pmid, pmcid, '{{}}' AS other_ids, (pmid IS NOT NULL)::BIGINT + (pmcid IS NOT NULL)::BIGINT + 1 AS n_keys FROM ids")
def identifier_payloads(spark, sf):
    payload = cols.identifier_payload(_null(), F.col("pmid"), F.lit("null"), F.col("pmcid"), _null("map<string,string>"))
    get = lambda n: F.get_json_object("j", f"$.{n}").alias(n)
    return ids(spark, sf).select("pos", payload.alias("j")).select("pos", get("pmid"), get("pmcid"), get("other_ids"), _n(F.size(F.json_object_keys("j"))).alias("n_keys"))


@query("""SELECT p_partkey, md5('Read.' || chr(10) || chr(10) || 'Title: ' || p_name || chr(10) || 'Abstract: ' || chr(10) || 'Table: ' || p_brand || chr(10) || 'Number: ' || p_size || chr(10) || 'Caption: ' || p_type || chr(10) || 'Footer: '
 || chr(10) || 'Metadata: {"a":"' || p_size || '","b":"x"}' || chr(10) || chr(10) || 'Content:' || chr(10) || '<t/>') AS prompt FROM part""")
def table_prompts(spark, sf):
    meta = F.create_map(F.lit("b"), F.lit("x"), F.lit("a"), _text("p_size"))
    text = cols.table_prompt(F.lit("Read."), F.col("p_name"), _null(), F.col("p_brand"), F.col("p_size"), F.col("p_type"), _null(), meta, F.lit("<t/>"))
    return table(spark, sf, "part").select("p_partkey", F.md5(text).alias("prompt"))


@query("SELECT event_id, CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso, true AS same FROM events")
def iso_times(spark, sf):
    iso = model.iso_time(F.col("ts"))
    return table(spark, sf, "events").select("event_id", iso.alias("iso"), (model.parse_iso(iso) == F.col("ts")).alias("same"))


@query("SELECT event_id, event_type AS text, CASE event_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END::BIGINT AS n FROM events")
def node_texts(spark, sf):
    k, t = F.col("event_id"), F.col("event_type")
    node = F.when(k % 3 == 0, F.concat(F.lit('"'), t, F.lit('"'))).when(k % 3 == 1, F.concat(F.lit('{"#text":"'), t, F.lit('","@a":"b"}'))).otherwise(F.concat(F.lit('{"i":"'), t, F.lit('"}')))
    many = F.when(k % 3 == 0, F.lit('[{"a":1},2]')).when(k % 3 == 1, F.lit('{"a":1}'))
    return table(spark, sf, "events").select("event_id", cols.node_text(node).alias("text"), _n(F.size(cols.as_list(many))).alias("n"))


@query("""SELECT p_partkey, p_size % 2 = 0 OR p_partkey % 3 = 0 OR p_partkey % 5 = 0 AS useful, p_partkey % 3 = 0 OR p_partkey % 5 = 0 AS substantive, false AS complete, p_partkey % 7 <> 0 AS whole, p_partkey % 7 = 0 AS needs_more FROM part""")
def metadata_fields(spark, sf):
    k = F.col("p_partkey")
    some = providers._metadata(title=F.when(F.col("p_size") % 2 == 0, "t").otherwise(" "), abstract=F.when(k % 3 == 0, "a").otherwise(""), open_access=F.when(k % 5 == 0, False))
    full = providers._metadata(title=F.lit("t"), authors=providers._authors(F.array(F.lit("a"))), abstract=F.lit("a"), journal=F.lit("j"), publication_year=F.lit(2000), keywords=F.array(F.lit("k")), license=F.when(k % 7 != 0, "l"), source=F.lit("s"), open_access=F.lit(False))
    return table(spark, sf, "part").select("p_partkey", predicates.useful_metadata(some).alias("useful"), predicates.substantive_metadata(some).alias("substantive"), predicates.complete_metadata(some).alias("complete"), predicates.complete_metadata(full).alias("whole"), predicates.needs_more_metadata(full).alias("needs_more"))


@query("""SELECT p_partkey, p_size % 3 <> 0 AS point, p_partkey % 2 = 0 AS row_ok, p_partkey % 4 <> 0 AS kind_ok, p_size % 2 = 1 AS bears, p_partkey % 2 = 0 OR p_size > 10 AS pubget_ok, p_partkey % 2 = 0 AND p_size > 10 AS ids_complete FROM part""")
def content_predicates(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size")
    point = predicates.valid_point(F.when(size % 3 == 0, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.array(F.lit(1.0), F.lit(2.0), size.cast("double"))))
    row = predicates.valid_row(F.when(k % 2 == 0, " 1.5 ").otherwise("nan"), F.lit("2"), F.lit("-3e1"))
    kind = predicates.known_kind(F.when(k % 4 == 0, "Q").when(k % 4 == 1, "Z"))
    bears = predicates.with_coordinates(F.when(size % 2 == 1, F.array(F.lit(1))))
    some = F.when(k % 2 == 0, "1").otherwise(F.when(size > 10, "2").otherwise(""))
    full = predicates.complete_ids(F.when(k % 2 == 0, "1"), F.lit("d"), F.when(size > 10, "p").otherwise(""))
    return table(spark, sf, "part").select("p_partkey", point.alias("point"), row.alias("row_ok"), kind.alias("kind_ok"), bears.alias("bears"), predicates.supported("pubget", {"pmcid": some}).alias("pubget_ok"), full.alias("ids_complete"))


@query("SELECT o_custkey AS slug, string_agg(o_orderpriority, ' | ' ORDER BY o_orderkey) AS reason FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def failure_reasons(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("slug"), F.col("o_orderkey").alias("pos"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("error_message"))
    return workflow.failure_reasons(rows)


@query("""SELECT c_custkey AS slug, CASE WHEN c_nationkey % 2 = 0 THEN 'memory' WHEN c_nationkey % 3 = 0 THEN 'cache' ELSE 'file' END AS origin, CASE WHEN c_nationkey % 2 <> 0 AND c_nationkey % 3 = 0 THEN c_mktsegment END AS extra FROM customer""")
def first_present(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("slug"), "c_nationkey", "c_mktsegment")
    memory = c.filter("c_nationkey % 2 = 0").select("slug", F.lit("memory").alias("origin"))
    cached = c.filter("c_nationkey % 3 = 0").select("slug", F.lit("cache").alias("origin"), F.col("c_mktsegment").alias("extra"))
    return workflow.first_present([memory, cached, c.select("slug", F.lit("file").alias("origin"))])


@query(f"""WITH {IDS}, t AS (SELECT slug AS target, unnest([slug, pmid, doi, pmcid]) AS alias FROM ids)
SELECT DISTINCT target, c_custkey FROM t JOIN (SELECT c_custkey, '10.1234/j.' || c_custkey AS slug FROM customer) c ON alias = c.slug WHERE alias <> ''""")
def resolve_aliases(spark, sf):
    rows = table(spark, sf, "customer").select(F.concat(F.lit("10.1234/j."), _text("c_custkey")).alias("slug"), "c_custkey")
    return workflow.resolve(ids(spark, sf).select("slug", "pmid", "doi", "pmcid"), rows).select("target", "c_custkey")


@query("""SELECT 'order' AS kind, 'o' || o_orderkey AS slug, CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END::BIGINT AS n_files, CASE WHEN o_orderkey % 7 = 0 THEN 'new' ELSE 'old' END AS last_file FROM orders""")
def legacy_update(spark, sf):
    o, null = table(spark, sf, "orders"), _null()
    file = lambda path: F.struct(path.alias("file_path"), *(_null(t).alias(n) for n, t in (("file_type", "string"), ("content_type", "string"), ("source", "string"), ("downloaded_at", "timestamp_ntz"), ("md5", "string"))))
    row = lambda files: [F.col("o_orderkey").alias("pos"), F.concat(F.lit("o"), _text("o_orderkey")).alias("slug"), _text("o_orderkey").alias("pmid"), null.alias("pmcid"), null.alias("doi"), files.alias("files")]
    found = o.filter("o_orderkey % 7 = 0").select(*row(F.array(file(F.lit("old")), file(F.lit("new")), file(F.lit("new")))))
    out, _, _ = caches.index_legacy(o.select(*row(F.array(file(F.lit("old"))))), found, update_existing=True)
    return out.select(F.lit("order").alias("kind"), "slug", _n(F.size("files")).alias("n_files"), F.element_at("files", -1)["file_path"].alias("last_file"))


@query(f"""WITH {IDS}, one AS (SELECT * FROM ids QUALIFY row_number() OVER (PARTITION BY slug ORDER BY pos DESC) = 1)
SELECT slug, pos AS payload, pmid, CASE WHEN pos % 2 = 0 THEN 'y' END AS extra FROM one WHERE slug <> ''""")
def cache_versions(spark, sf):
    cache = caches.Cache(spark, caches.scratch(spark, "cache"), "ids")
    rows = ids(spark, sf).select("pos", "slug", "pmid", "pmcid", "doi", _text("pos").alias("payload"))
    last = rel.keep_last(rows, ["slug"])
    cache.add(rows.withColumn("payload", F.lit("stale")))
    cache.add(last.filter("pos % 2 = 1"))
    cache.add(last.filter("pos % 2 = 0").withColumn("extra", F.lit("y")))  # a column that older rows lack
    return cache.load().select("slug", F.col("payload").cast("long").alias("payload"), "pmid", "extra")


@query(f"""WITH {IDS}, one AS (SELECT * FROM ids QUALIFY row_number() OVER (PARTITION BY slug ORDER BY pos DESC) = 1)
SELECT (SELECT count(DISTINCT slug) FROM one WHERE slug <> '')::BIGINT AS slug, (SELECT count(DISTINCT pmid) FROM one WHERE slug <> '' AND pmid <> '')::BIGINT AS pmid, (SELECT count(DISTINCT doi) FROM one WHERE slug <> '' AND doi <> '')::BIGINT AS doi, (SELECT count(DISTINCT pmcid) FROM one WHERE slug <> '' AND pmcid <> '')::BIGINT AS pmcid""")
def cache_identifier_sets(spark, sf):
    cache = caches.Cache(spark, caches.scratch(spark, "cache"), "sets")
    cache.add(ids(spark, sf).select("pos", "slug", "pmid", "pmcid", "doi"))
    counts = [df.agg(F.count("*").alias(k)) for k, df in cache.identifier_sets().items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.join(more, F.lit(True))  # one row each
    return out


@query("SELECT c_custkey AS pos, '' || c_custkey AS pmid, CASE WHEN c_custkey % 3 = 0 THEN 'cached' WHEN c_custkey % 3 = 1 THEN 'looked up' END AS doi FROM customer")
def read_through_lookup(spark, sf):
    cache = caches.Cache(spark, caches.scratch(spark, "cache"), "lookups")
    key = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(key.alias("pos"), _text(key).alias("slug"), _text(key).alias("pmid"), _null().alias("doi"), F.lit("PMC1").alias("pmcid"))
    known = rows.filter("pos % 3 = 0").select("pos", "slug", "pmid", F.to_json(F.struct(F.lit("cached").alias("doi"))).alias("payload"))
    cache.add(known)
    fill = lambda df: df.withColumn("doi", F.when(F.col("pos") % 3 == 1, "looked up").otherwise(F.col("doi")))
    out, _ = caches.read_through(rows.withColumn("pmcid", _null()), cache, {"pmid": fill})
    return out.select("pos", "pmid", "doi")
