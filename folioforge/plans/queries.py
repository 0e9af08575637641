"""Named queries over the driver's tables, each with its SQL twin.

Identifier rows are derived from orders: pos is the key, ids are dirtied by fixed rules. Counts and ranks are
longs, lists are joined to text, so that both engines return equal values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import cols
from folioforge.operators import relational as rel

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

# SQL of the scalar functions, for DuckDB.
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_NORM = f"nullif({_STRIP}, '')"


def sql_pmid(c: str) -> str:
    v = _NORM.format(c)
    return f"nullif(CASE WHEN starts_with({v}, '{cols.PUBMED_PREFIX}') THEN rtrim(substr({v}, {len(cols.PUBMED_PREFIX) + 1}), '/') ELSE {v} END, '')"


def sql_pmcid(c: str) -> str:
    v = _NORM.format(c)
    return f"CASE WHEN {v} IS NULL THEN NULL WHEN starts_with(upper({v}), 'PMC') THEN {v} ELSE 'PMC' || {v} END"


def sql_doi(c: str) -> str:
    v = _NORM.format(c)
    pattern = cols.DOI_URL.replace("'", "''")
    return f"regexp_replace(CASE WHEN starts_with({v}, 'http') THEN regexp_replace({v}, '{pattern}', '\\1', 'g') ELSE {v} END, '^(?i)doi:', '')"


def sql_slug(c: str) -> str:
    return f"regexp_replace(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


RAW = """raw AS (SELECT o_orderkey AS pos, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate,
  CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' ' || o_orderkey || ' ' WHEN 2 THEN 'https://pubmed.ncbi.nlm.nih.gov/' || o_orderkey || '/' ELSE '' || o_orderkey END AS pmid,
  CASE o_orderkey % 4 WHEN 0 THEN 'https://doi.org/10.1234/J.' || o_custkey WHEN 1 THEN 'doi:10.1234/j.' || o_custkey WHEN 2 THEN '' ELSE '10.1234/j.' || o_custkey END AS doi,
  CASE o_orderkey % 3 WHEN 0 THEN '' || o_orderkey WHEN 1 THEN 'PMC' || o_orderkey ELSE NULL END AS pmcid FROM orders)"""
IDS = f"""{RAW}, norm AS (SELECT pos, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate, {sql_pmid("pmid")} AS pmid, {sql_doi("doi")} AS doi, {sql_pmcid("pmcid")} AS pmcid FROM raw),
ids AS (SELECT *, {sql_slug("concat_ws('-', pmid, doi, pmcid)")} AS slug FROM norm)"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def raw_ids(spark: SparkSession, sf: str) -> DataFrame:
    k, key, cust = F.col("o_orderkey"), F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    pmid = F.when(k % 5 == 1, F.concat(F.lit(" "), key, F.lit(" "))).when(k % 5 == 2, F.concat(F.lit(cols.PUBMED_PREFIX), key, F.lit("/"))).when(k % 5 > 2, key)
    doi = F.when(k % 4 == 0, F.concat(F.lit("https://doi.org/10.1234/J."), cust)).when(k % 4 == 1, F.concat(F.lit("doi:10.1234/j."), cust)).when(k % 4 == 2, F.lit("")).otherwise(F.concat(F.lit("10.1234/j."), cust))
    pmcid = F.when(k % 3 == 0, key).when(k % 3 == 1, F.concat(F.lit("PMC"), key))
    return table(spark, sf, "orders").select(k.alias("pos"), "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate", pmid.alias("pmid"), doi.alias("doi"), pmcid.alias("pmcid"))


def ids(spark: SparkSession, sf: str) -> DataFrame:
    out = raw_ids(spark, sf).withColumn("pmid", cols.normalize_pmid(F.col("pmid"))).withColumn("doi", cols.normalize_doi(F.col("doi"))).withColumn("pmcid", cols.normalize_pmcid(F.col("pmcid")))
    return out.withColumn("slug", cols.identifier_slug(F.col("pmid"), F.col("doi"), F.col("pmcid")))


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def _n(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


@query(f"WITH {IDS} SELECT pos, pmid, doi, pmcid FROM ids")
def normalize_identifiers(spark, sf):
    return ids(spark, sf).select("pos", "pmid", "doi", "pmcid")


@query(f"WITH {IDS} SELECT pos, slug FROM ids")
def identifier_slug(spark, sf):
    return ids(spark, sf).select("pos", "slug")


@query(f"WITH {IDS} SELECT slug, min(pos) AS pos FROM ids GROUP BY slug")
def dedup_keep_first(spark, sf):
    return rel.keep_first(ids(spark, sf), ["slug"]).select("slug", "pos")


@query(f"WITH {IDS} SELECT doi, max(pos) AS pos FROM ids WHERE doi IS NOT NULL GROUP BY doi")
def dedup_keep_last(spark, sf):
    return rel.keep_last(ids(spark, sf), ["doi"], drop_null_keys=True).select("doi", "pos")


@query(f"""WITH {IDS}, one AS (SELECT * FROM ids QUALIFY row_number() OVER (PARTITION BY slug ORDER BY pos) = 1)
SELECT pmid IS NOT NULL AS has_pmid, doi IS NOT NULL AS has_doi, pmcid IS NOT NULL AS has_pmcid, count(*)::BIGINT AS n, min(slug) AS first_slug,
 count(*) FILTER (WHERE pmid IS NOT NULL AND doi IS NOT NULL AND pmcid IS NOT NULL)::BIGINT AS n_complete FROM one GROUP BY 1, 2, 3""")
def id_completeness_profile(spark, sf):
    one = rel.keep_first(ids(spark, sf), ["slug"])
    has = [F.col(c).isNotNull().alias(f"has_{c}") for c in ("pmid", "doi", "pmcid")]
    full = F.col("pmid").isNotNull() & F.col("doi").isNotNull() & F.col("pmcid").isNotNull()
    return one.groupBy(*has).agg(F.count("*").alias("n"), F.min("slug").alias("first_slug"), F.count_if(full).alias("n_complete"))


_CLEAN = r"regexp_replace(regexp_replace({0}, '[^{1}]+', '-', 'g'), '^[{2}]+|[{2}]+$', '', 'g')"


@query(f"""SELECT p_partkey, coalesce(nullif(lower({_CLEAN.format("n", "A-Za-z0-9_-", "-")}), ''), 'table-' || (p_partkey + 1)) AS plain,
 coalesce(nullif(lower({_CLEAN.format("coalesce(nullif(n, ''), nullif(p_type, ''))", "A-Za-z0-9_-", "-")}), ''), 'table-' || lpad('' || (p_partkey + 1), 3, '0')) AS labelled,
 coalesce(nullif({sql_slug("n")}, ''), 'table-' || p_partkey) AS slugged
FROM (SELECT *, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '--!' ELSE p_name || '_' || p_brand END AS n FROM part)""")
def sanitize_table_ids(spark, sf):
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").withColumn("n", F.when(k % 4 == 0, "").when(k % 4 == 1, "--!").otherwise(F.concat_ws("_", "p_name", "p_brand")))
    n = F.col("n")
    return rows.select("p_partkey", cols.sanitize_table_id(n, k).alias("plain"), cols.sanitize_table_label(n, F.col("p_type"), k).alias("labelled"), cols.slug_table_id(n, k).alias("slugged"))


@query(f"""SELECT p_partkey, coalesce(nullif({_CLEAN.format("key", "A-Za-z0-9._-", "-")}, ''), 'analysis') AS filename, key,
 coalesce(nullif(lower({_CLEAN.format("stem", "A-Za-z0-9_-", "-_")}), ''), sha256(stem)[1:16]) AS stem,
 sha256(coalesce(nullif(stem, ''), 'identifier-' || p_partkey))[1:32] AS digest
FROM (SELECT p_partkey, p_name || '::' || p_brand AS key, CASE WHEN p_partkey % 3 = 0 THEN '__' WHEN p_partkey % 3 = 1 THEN p_name ELSE '' END AS stem FROM part)""")
def manifest_filenames(spark, sf):
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select("p_partkey", cols.compose_cache_key(F.col("p_name"), F.col("p_brand")).alias("key"), F.when(k % 3 == 0, "__").when(k % 3 == 1, F.col("p_name")).otherwise("").alias("stem"))
    return rows.select("p_partkey", "key", cols.manifest_filename(F.col("key")).alias("filename"), cols.hash_stem(F.col("stem")).alias("stem"), cols.cache_digest(F.col("stem"), k).alias("digest"))


@query("""SELECT c_custkey AS k, try_cast(nullif(regexp_extract(c_name, '(\\d+)', 1), '') AS INTEGER)::BIGINT AS number FROM customer
UNION ALL SELECT p_partkey, try_cast(nullif(regexp_extract(p_type, '(\\d+)', 1), '') AS INTEGER)::BIGINT FROM part""")
def table_number(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("l"))
    b = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_type").alias("l"))
    return a.union(b).select("k", _n(cols.table_number(F.col("l"))).alias("number"))


_STAT = """CASE WHEN k IS NULL OR k = '' THEN NULL WHEN upper(k) IN ('Z','T','F','R','P','B','OTHER') THEN upper(k) WHEN contains(k,'z') THEN 'Z' WHEN contains(k,'t') THEN 'T'
 WHEN contains(k,'f') THEN 'F' WHEN contains(k,'r') THEN 'R' WHEN starts_with(k,'p') THEN 'P' ELSE 'OTHER' END"""


@query(f"""SELECT name, {_STAT} AS kind, n FROM (SELECT name, lower({_STRIP.format("name")}) AS k, n FROM (SELECT p_type AS name, count(*)::BIGINT AS n FROM part GROUP BY 1
UNION ALL SELECT event_type, count(*)::BIGINT FROM events GROUP BY 1 UNION ALL SELECT unnest(['b', ' Z ', 'beta', 'pval', 'quux', '']), 0::BIGINT))""")
def statistic_kind(spark, sf):
    a = table(spark, sf, "part").groupBy(F.col("p_type").alias("name")).agg(F.count("*").alias("n"))
    b = table(spark, sf, "events").groupBy(F.col("event_type").alias("name")).agg(F.count("*").alias("n"))
    c = spark.createDataFrame([(x, 0) for x in ("b", " Z ", "beta", "pval", "quux", "")], "name string, n long")
    return a.union(b).union(c).select("name", cols.statistic_kind(F.col("name")).alias("kind"), "n")


@query("""SELECT o_orderkey, CASE WHEN g = 'MNI' THEN 'MNI' WHEN g IN ('TAL','TALAIRACH') THEN 'TAL' ELSE 'OTHER' END AS space
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'MNI' WHEN 'F' THEN 'TALAIRACH' ELSE 'X' END AS g FROM orders)""")
def coordinate_space(spark, sf):
    g = F.when(F.col("o_orderstatus") == "O", " mni ").when(F.col("o_orderstatus") == "F", "Talairach").otherwise("x")
    return table(spark, sf, "orders").select("o_orderkey", cols.coordinate_space(g).alias("space"))


@query("""SELECT p_partkey, abs(p_size)::BIGINT AS size, CASE p_partkey % 4 WHEN 0 THEN 'voxels' WHEN 1 THEN 'mm^3' WHEN 2 THEN 'mm^3' ELSE NULL END AS measure FROM part""")
def cluster_measure(spark, sf):
    k = F.col("p_partkey")
    m = F.when(k % 4 == 0, "Voxels").when(k % 4 == 1, " mm3").when(k % 4 == 2, "mm^3").otherwise("cm")
    return table(spark, sf, "part").select("p_partkey", _n(cols.cluster_size((-F.col("p_size")).cast("string"))).alias("size"), cols.cluster_measure(m).alias("measure"))


_TYPES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in cols.FILE_TYPES.items())


@query(f"SELECT page_id, CASE lower(regexp_extract(p, '(\\.[A-Za-z0-9]+)$', 1)) {_TYPES} ELSE '{cols.DEFAULT_FILE_TYPE}' END AS type, CASE page_id % 3 WHEN 0 THEN 'xml' WHEN 1 THEN 'json' ELSE 'bin' END AS ext FROM (SELECT page_id, url || CASE page_id % 3 WHEN 0 THEN '.XML' WHEN 1 THEN '.pdf' ELSE '/x' END AS p FROM pages)")
def file_type_guess(spark, sf):
    k = F.col("page_id")
    path = F.concat("url", F.when(k % 3 == 0, ".XML").when(k % 3 == 1, ".pdf").otherwise("/x"))
    kind = F.when(k % 3 == 0, "text/xml; charset=utf-8").when(k % 3 == 1, "application/json").otherwise("odd/type")
    return table(spark, sf, "pages").select("page_id", cols.file_type(path).alias("type"), cols.file_extension(F.lit(None).cast("string"), kind).alias("ext"))


@query("SELECT page_id, md5(html) AS md5, sha256(url)[1:32] AS sha_prefix FROM pages")
def content_md5(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5("html").alias("md5"), F.substring(F.sha2("url", 256), 1, 32).alias("sha_prefix"))


@query("SELECT page_id, md5(replace(CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN chr(0) || url || chr(0) ELSE replace(url, '/', chr(0)) END, chr(0), '')) AS digest FROM pages")
def strip_nul(spark, sf):
    k, url, nul = F.col("page_id"), F.col("url"), F.lit("\x00")
    dirty = F.when(k % 3 == 0, url).when(k % 3 == 1, F.concat(nul, url, nul)).otherwise(F.replace(url, F.lit("/"), nul))
    return table(spark, sf, "pages").select("page_id", F.md5(cols.strip_nul(dirty)).alias("digest"))


_DATES = "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN 'Winter ' || year(o_orderdate) WHEN 2 THEN '' || year(o_orderdate) WHEN 3 THEN 'n.d.' WHEN 4 THEN '12-' || year(o_orderdate) ELSE '' END AS d FROM orders"


@query(f"""WITH t AS ({_DATES}) SELECT o_orderkey, coalesce(CASE WHEN regexp_full_match(d[1:4], '[0-9]{{4}}') THEN d[1:4]::BIGINT END, nullif(regexp_extract(d, '((19|20)[0-9]{{2}})', 1), '')::BIGINT) AS year_any,
 CASE WHEN regexp_full_match(split_part(d, '-', 1), '[0-9]+') THEN split_part(d, '-', 1)::BIGINT END AS year_dash, CASE WHEN o_orderkey % 6 IN (0, 2) THEN d[1:4]::BIGINT ELSE nullif(regexp_extract('Spring 1987-88', '((19|20)[0-9]{{2}})', 1), '')::BIGINT END AS year_pub FROM t""")
def year_extract(spark, sf):
    k, y = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy")
    d = F.when(k % 6 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k % 6 == 1, F.concat(F.lit("Winter "), y)).when(k % 6 == 2, y).when(k % 6 == 3, "n.d.").when(k % 6 == 4, F.concat(F.lit("12-"), y)).otherwise("")
    published = cols.pub_year(F.when(k % 6 != 4, d), F.lit("Spring 1987-88"))
    return table(spark, sf, "orders").select("o_orderkey", _n(cols.year_of(d)).alias("year_any"), _n(cols.year_before_dash(d)).alias("year_dash"), _n(published).alias("year_pub"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN NULL ELSE 'PMC' || o_orderkey END AS from_path, CASE o_orderkey % 3 WHEN 2 THEN NULL ELSE '' || o_orderkey END AS digits FROM orders")
def pmcid_forms(spark, sf):
    k = F.col("o_orderkey")
    key = k.cast("string")
    path = F.concat(F.lit("a/b/"), F.when(k % 3 == 0, F.concat(F.lit("pmcid_"), key)).when(k % 3 == 1, F.concat(F.lit("PMC"), key)).otherwise("none"), F.lit("/article.xml"))
    raw = F.when(k % 3 == 0, F.concat(F.lit(" pmc00"), key)).when(k % 3 == 1, key).otherwise("PMCx")
    return table(spark, sf, "orders").select("o_orderkey", cols.pmcid_from_path(path).alias("from_path"), cols.pmcid_digits(raw).alias("digits"))


_SUPPORT = {"pubget": "pmcid IS NOT NULL", "elsevier": "pmid IS NOT NULL OR doi IS NOT NULL", "ace": "pmid IS NOT NULL"}


@query(f"WITH {IDS} " + " UNION ALL ".join(f"SELECT '{s}' AS source, coalesce({p}, false) AS supported, count(*)::BIGINT AS n, min(pos) AS first_pos FROM ids GROUP BY 2" for s, p in _SUPPORT.items()))
def supported_split(spark, sf):
    out = None
    for name, p in _SUPPORT.items():
        part = ids(spark, sf).groupBy(F.lit(name).alias("source"), F.coalesce(F.expr(p), F.lit(False)).alias("supported")).agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))
        out = part if out is None else out.union(part)
    return out


@query(f"""SELECT page_id, CASE WHEN nullif({_STRIP.format("h")}, '') IS NULL THEN 'empty' WHEN NOT contains(lower(h), '<html') THEN 'no html tag'
 WHEN contains(lower(h), 'opens in new tab') OR contains(lower(h), 'rate limit') OR contains(lower(h), 'captcha') OR contains(lower(h), 'access denied') THEN 'blocked' WHEN length({_STRIP.format("h")}) < 500 THEN 'too short' END AS reason
FROM (SELECT page_id, CASE page_id % 6 WHEN 1 THEN substr(html, 1, 400) WHEN 2 THEN '  ' WHEN 3 THEN replace(html, '<html', '<h') WHEN 4 THEN html || 'CAPTCHA' ELSE html END AS h FROM pages)""")
def html_validation(spark, sf):
    k, h = F.col("page_id"), F.col("html")
    bad = F.when(k % 6 == 1, F.substring(h, 1, 400)).when(k % 6 == 2, "  ").when(k % 6 == 3, F.replace(h, F.lit("<html"), F.lit("<h"))).when(k % 6 == 4, F.concat(h, F.lit("CAPTCHA"))).otherwise(h)
    return table(spark, sf, "pages").select("page_id", cols.html_verdict(bad).alias("reason"))


_NUM = r"CASE WHEN regexp_matches({0}, '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$') THEN try_cast({0} AS DOUBLE) END"


@query(f"""SELECT event_id, {_NUM.format("v")} AS x, {_NUM.format("v")} IS NOT NULL AS valid, trunc({_NUM.format("v")})::BIGINT AS size
FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'n/a' WHEN 1 THEN '1_0' WHEN 2 THEN '12.75' ELSE '-3e1' END AS v FROM events)""")
def point_validity(spark, sf):
    k = F.col("event_id")
    v = F.when(k % 4 == 0, "n/a").when(k % 4 == 1, "1_0").when(k % 4 == 2, "12.75").otherwise("-3e1")
    x = cols.number(v)
    return table(spark, sf, "events").select("event_id", x.alias("x"), x.isNotNull().alias("valid"), x.cast("long").alias("size"))


def _lookup_sql(keys: list[str]) -> str:
    ones = ", ".join(f"k_{k} AS (SELECT {k}, min(pos) AS p FROM cache WHERE {k} IS NOT NULL AND {k} <> '' GROUP BY {k})" for k in keys)
    joins = " ".join(f"LEFT JOIN k_{k} ON r.{k} = k_{k}.{k}" for k in keys)
    return f"""cache AS (SELECT * FROM ids WHERE pos % 7 = 0), {ones},
 found AS (SELECT r.pos, coalesce({", ".join(f"k_{k}.p" for k in keys)}) AS hit_pos, CASE {" ".join(f"WHEN k_{k}.p IS NOT NULL THEN '{k}'" for k in keys)} END AS hit_key FROM ids r {joins})"""


def _lookup(spark, sf, keys):
    all_ids = ids(spark, sf)
    cache = all_ids.filter("pos % 7 = 0").withColumn("cache_pos", F.col("pos"))
    return rel.cascade_lookup(all_ids, cache, keys, ["cache_pos"]).select("pos", F.col("hit_cache_pos").alias("hit_pos"), "hit_key")


_MAIN, _LEGACY = ["slug", "pmid", "doi", "pmcid"], ["slug", "pmid", "pmcid", "doi"]


@query(f"WITH {IDS}, {_lookup_sql(_MAIN)} SELECT * FROM found")
def cascade_lookup(spark, sf):
    return _lookup(spark, sf, _MAIN)


@query(f"WITH {IDS}, {_lookup_sql(_LEGACY)} SELECT * FROM found")
def cascade_lookup_legacy(spark, sf):
    return _lookup(spark, sf, _LEGACY)


@query("""WITH t AS (SELECT l_orderkey AS pos, l_linenumber AS tab, l_partkey % 50 AS a, l_suppkey AS b FROM lineitem), c AS (SELECT * FROM t WHERE pos % 7 = 0),
ka AS (SELECT a, tab, min(pos) AS p FROM c GROUP BY ALL), kb AS (SELECT b, tab, min(pos) AS p FROM c GROUP BY ALL)
SELECT t.pos, t.tab::BIGINT AS tab, coalesce(ka.p, kb.p) AS hit_pos, CASE WHEN ka.p IS NOT NULL THEN 'a' WHEN kb.p IS NOT NULL THEN 'b' END AS hit_key FROM t LEFT JOIN ka USING (a, tab) LEFT JOIN kb USING (b, tab)""")
def cascade_lookup_table_filter(spark, sf):
    t = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("pos"), _n("l_linenumber").alias("tab"), (F.col("l_partkey") % 50).alias("a"), F.col("l_suppkey").alias("b"))
    cache = t.filter("pos % 7 = 0").withColumn("p", F.col("pos"))
    return rel.cascade_lookup(t, cache, ["a", "b"], ["p"], extra=["tab"]).select("pos", "tab", F.col("hit_p").alias("hit_pos"), "hit_key")


@query(f"WITH {IDS}, {_lookup_sql(_MAIN)} SELECT pos, hit_pos FROM found WHERE hit_key IS NOT NULL")
def partition_cached_hits(spark, sf):
    all_ids = ids(spark, sf)
    return rel.partition_cached(all_ids, all_ids.filter("pos % 7 = 0").withColumn("p", F.col("pos")), _MAIN, ["p"])[0].select("pos", F.col("hit_p").alias("hit_pos"))


@query(f"WITH {IDS}, {_lookup_sql(_MAIN)} SELECT pos FROM found WHERE hit_key IS NULL")
def partition_cached_misses(spark, sf):
    all_ids = ids(spark, sf)
    return rel.partition_cached(all_ids, all_ids.filter("pos % 7 = 0").withColumn("p", F.col("pos")), _MAIN, ["p"])[1].select("pos")


@query(f"WITH {IDS} SELECT i.pos, coalesce(i.doi, nullif(c.c_name, '')) AS doi, coalesce(i.pmid, c.c_mktsegment) AS pmid FROM ids i LEFT JOIN customer c ON i.o_custkey = c.c_custkey AND c.c_custkey % 2 = 0")
def record_apply_fill(spark, sf):
    c = table(spark, sf, "customer").filter("c_custkey % 2 = 0")
    both = ids(spark, sf).join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    return both.select("pos", rel.merge_fields(F.col("doi"), F.col("c_name"), "FILL").alias("doi"), rel.merge_fields(F.col("pmid"), F.col("c_mktsegment"), "FILL").alias("pmid"))


@query("""WITH n AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)
SELECT event_id, ((rn - 1) // 200)::BIGINT AS batch, ((rn - 1) % 200)::BIGINT AS place FROM n""")
def positional_zip(spark, sf):
    return rel.batches(table(spark, sf, "events"), 200, "event_type", "event_id").select("event_id", "batch", "place")


@query(f"WITH {IDS} SELECT i.pos, c.c_custkey FROM ids i JOIN (SELECT c_custkey, '10.1234/j.' || c_custkey AS d FROM customer) c ON i.doi = c.d")
def url_normalized_join(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", cols.normalize_doi(F.concat(F.lit("https://doi.org/10.1234/j."), F.col("c_custkey").cast("string"))).alias("d"))
    return ids(spark, sf).join(c, F.col("doi") == F.col("d")).select("pos", "c_custkey")


@query("""WITH a AS (SELECT l_orderkey, l_partkey % 100 AS k, row_number() OVER (PARTITION BY l_partkey % 100 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem),
b AS (SELECT o_orderkey, o_custkey % 100 AS k, row_number() OVER (PARTITION BY o_custkey % 100 ORDER BY o_orderkey) AS rn FROM orders) SELECT a.l_orderkey, b.o_orderkey FROM a JOIN b USING (k, rn)""")
def fifo_match(spark, sf):
    a = table(spark, sf, "lineitem").withColumn("k", F.col("l_partkey") % 100)
    a = a.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")))
    b = table(spark, sf, "orders").withColumn("k", F.col("o_custkey") % 100)
    b = b.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o_orderkey")))
    return a.join(b, ["k", "rn"]).select("l_orderkey", "o_orderkey")


@query("SELECT l.l_orderkey, l.l_linenumber::BIGINT AS line, coalesce(p.p_name, 'missing') AS name FROM lineitem l LEFT JOIN (SELECT * FROM part WHERE p_partkey % 3 > 0) p ON l.l_partkey = p.p_partkey")
def fanout_lookup(spark, sf):
    p = table(spark, sf, "part").filter("p_partkey % 3 > 0")
    return table(spark, sf, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey"), "left").select("l_orderkey", _n("l_linenumber").alias("line"), F.coalesce("p_name", F.lit("missing")).alias("name"))


@query("""WITH s AS (SELECT s_suppkey, s_nationkey FROM supplier), n AS (SELECT s_nationkey, min(s_suppkey) AS k FROM s GROUP BY 1)
SELECT p_partkey, coalesce(s.s_suppkey, n.k) AS hit FROM part LEFT JOIN s ON p_partkey = s.s_suppkey LEFT JOIN n ON p_size = n.s_nationkey""")
def id_then_label_lookup(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("p_partkey"), F.col("s_nationkey").alias("p_size"), F.col("s_suppkey").alias("k"))
    return rel.cascade_lookup(table(spark, sf, "part").select("p_partkey", "p_size"), s, ["p_partkey", "p_size"], ["k"], right_pos="k").select("p_partkey", F.col("hit_k").alias("hit"))


@query("SELECT d.doc_id, coalesce('quality ' || l.quality, nullif(d.source, ''), 'doc-' || d.doc_id) AS title FROM documents d LEFT JOIN labels l USING (doc_id)")
def metadata_attach_placeholder(spark, sf):
    both = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    own = F.concat(F.lit("quality "), F.col("quality").cast("string"))
    nothing = F.lit(None).cast("string")
    return both.select("doc_id", F.coalesce(own, cols.placeholder_title(F.col("source"), nothing, nothing, F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))).alias("title"))


@query(f"""WITH {IDS}, al AS (SELECT pos, unnest([slug, pmid, doi, pmcid]) AS a FROM ids), want AS (SELECT DISTINCT a FROM al WHERE pos % 50 = 0 AND a <> '')
SELECT DISTINCT pos FROM al WHERE a IN (SELECT a FROM want)""")
def alias_semi_join(spark, sf):
    all_ids = ids(spark, sf)
    names = F.explode(F.filter(F.array("slug", "pmid", "doi", "pmcid"), lambda x: x.isNotNull() & (x != "")))
    want = rel.explode_aliases(all_ids.filter("pos % 50 = 0")).select("alias").distinct()
    return all_ids.select("pos", names.alias("alias")).join(want, "alias", "left_semi").select("pos").distinct()


@query("SELECT o_custkey, o_orderkey, c > 1 AS several FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r, count(*) OVER (PARTITION BY o_custkey) AS c FROM orders) WHERE r = 1")
def order_limit_pick(spark, sf):
    first = F.struct("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.min_by("o_orderkey", first).alias("o_orderkey"), (F.count("*") > 1).alias("several"))


@query("SELECT l_orderkey, l_linenumber::BIGINT AS line FROM (SELECT *, max((l_returnflag = 'R')::INT) OVER (PARTITION BY l_orderkey) AS m FROM lineitem) WHERE m = 0 OR l_returnflag = 'R'")
def preferred_source(spark, sf):
    m = F.max(F.col("l_returnflag") == "R").over(Window.partitionBy("l_orderkey"))
    return table(spark, sf, "lineitem").withColumn("m", m).filter("NOT m OR l_returnflag = 'R'").select("l_orderkey", _n("l_linenumber").alias("line"))


@query(f"WITH {IDS}, w AS (SELECT pmid, doi, pmcid FROM ids WHERE pos % 40 = 0) SELECT DISTINCT i.pos FROM ids i WHERE i.doi IN (SELECT doi FROM w) OR i.pmid IN (SELECT pmid FROM w) OR i.pmcid IN (SELECT pmcid FROM w)")
def or_key_match(spark, sf):
    all_ids = ids(spark, sf)
    want, out = all_ids.filter("pos % 40 = 0"), None
    for key in ("doi", "pmid", "pmcid"):
        part = all_ids.join(want.select(key).distinct(), key, "left_semi").select("pos")
        out = part if out is None else out.union(part)
    return out.distinct()


@query()
def any_key_batch_dedup(spark, sf):
    rows = ids(spark, sf).select("pos", "slug", "pmid", "doi", "pmcid")
    return rel.any_key_dedup_all(rows, ["slug", "pmid", "doi", "pmcid"]).select("pos", "slug")


@query("""WITH r AS (SELECT conv_id, turn, nullif(role, '') AS role, text FROM conversations), w AS (SELECT conv_id, role, min(turn) AS t FROM r WHERE turn % 2 = 0 GROUP BY 1, 2)
SELECT r.conv_id, arg_min(role, turn) AS title, arg_max(text, (length(text), -turn)) AS abstract, arg_min(CASE WHEN turn % 3 = 1 THEN text END, turn) FILTER (WHERE turn % 3 = 1 AND text <> '') AS journal,
 arg_min(CASE WHEN turn >= 1 THEN 'l' || turn END, turn) FILTER (WHERE turn >= 1) AS license, arg_min(turn % 2 = 0, turn) FILTER (WHERE turn >= 2) AS open_access,
 arg_max(repeat(role || ',', (turn % 3 + 1)::INT), (turn % 3 + 1, -turn)) AS authors, (SELECT string_agg(w.role, ',' ORDER BY w.t) FROM w WHERE w.conv_id = r.conv_id) AS keywords FROM r GROUP BY 1""")
def metadata_merge(spark, sf):
    t, role, text = F.col("turn"), F.col("role"), F.col("text")
    fields = {
        "title": role, "abstract": text, "journal": F.when(t % 3 == 1, text).otherwise(""), "license": F.when(t >= 1, F.concat(F.lit("l"), t.cast("string"))), "open_access": F.when(t >= 2, t % 2 == 0),
        "authors": F.array_repeat(role, (t % 3 + 1).cast("int")), "keywords": F.when(t % 2 == 0, F.array(role, role)),
    }
    rows = table(spark, sf, "conversations").select("conv_id", "turn", *(c.alias(n) for n, c in fields.items()))
    lists = {"authors": F.concat(F.array_join("authors", ","), F.lit(",")), "keywords": cols.missing(F.array_join("keywords", ","))}
    return rel.metadata_fold(rows, "conv_id", "turn").withColumns(lists)


@query("SELECT doc_id, CASE WHEN l.quality IS NOT NULL THEN 'labels' WHEN b.item_id IS NOT NULL THEN 'benchmark' ELSE 'fallback' END AS source FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN benchmark b ON d.doc_id = b.item_id")
def enrich_cascade(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    first = d.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    need, have = first.filter("quality IS NULL").select("doc_id"), first.filter("quality IS NOT NULL")
    second = need.join(table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.lit(True).alias("b")), "doc_id", "left")
    return have.select("doc_id", F.lit("labels").alias("source")).union(second.select("doc_id", F.when(F.col("b"), "benchmark").otherwise("fallback").alias("source")))


@query("SELECT o_orderpriority, count(*)::BIGINT AS produced, count(*) FILTER (WHERE o_orderkey % 7 = 0)::BIGINT AS cache_hits, count(*) FILTER (WHERE o_orderstatus = 'P')::BIGINT AS skipped, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END)::BIGINT AS succeeded FROM orders GROUP BY 1")
def stage_metrics(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("produced"), F.count_if(F.col("o_orderkey") % 7 == 0).alias("cache_hits"), F.count_if(F.col("o_orderstatus") == "P").alias("skipped"), F.count_distinct(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))).alias("succeeded"))


@query("SELECT l_orderkey, l_linenumber::BIGINT AS line FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_returnflag = 'R')::INT DESC, l_linenumber) = 1")
def bundle_choice(spark, sf):
    best = F.struct((F.col("l_returnflag") != "R").alias("worse"), F.col("l_linenumber").alias("n"))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(_n(F.min(best)["n"]).alias("line"))


_LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS line, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place,
 CASE WHEN n > 1 THEN l_returnflag || '-' || n ELSE l_returnflag END AS name FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n FROM lineitem)""")
def ordinals_name_suffix(spark, sf):
    named = rel.name_with_suffix(table(spark, sf, "lineitem"), "l_orderkey", "l_returnflag", *_LINE)
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_LINE))
    return named.select("l_orderkey", _n("l_linenumber").alias("line"), _n(place).alias("place"), "name")


@query("SELECT c_custkey FROM customer ORDER BY md5('s|' || c_custkey), c_custkey LIMIT 100")
def seeded_sample(spark, sf):
    return rel.seeded_sample(table(spark, sf, "customer").select("c_custkey"), "c_custkey", 100, "s")


@query(f"WITH {IDS}, u AS (SELECT slug, pos FROM ids WHERE pos % 2 = 0 UNION ALL SELECT slug, pos + 1000000 FROM ids WHERE pos % 3 = 0) SELECT slug, min(pos) AS pos FROM u GROUP BY slug")
def union_manifest(spark, sf):
    all_ids = ids(spark, sf).select("slug", "pos")
    both = all_ids.filter("pos % 2 = 0").unionByName(all_ids.filter("pos % 3 = 0").withColumn("pos", F.col("pos") + 1000000))
    return rel.keep_first(both, ["slug"])


@query(f"WITH {IDS} SELECT pos FROM ids WHERE slug NOT IN (SELECT slug FROM ids WHERE pos % 3 = 0)")
def manifest_difference(spark, sf):
    all_ids = ids(spark, sf)
    return rel.delete_keys(all_ids, all_ids.filter("pos % 3 = 0"), ["slug"]).select("pos")


@query("SELECT s_suppkey AS id, s_name AS name, coalesce(NULL, '') AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def dynamic_union(spark, sf):
    a = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    b = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(b, allowMissingColumns=True).na.fill("")


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN json_extract_string(props, '$.k') WHEN 1 THEN event_type ELSE 'none' END AS found FROM events""")
def json_props(spark, sf):
    k, t = F.col("event_id"), F.col("event_type")
    doc = F.when(k % 3 == 0, F.col("props")).when(k % 3 == 1, F.concat(F.lit('{"k":"","dc:k":"'), t, F.lit('"}'))).otherwise("{broken")
    return table(spark, sf, "events").select("event_id", cols.first_text(doc, "k", "dc:k", default=F.lit("none")).alias("found"))


@query("SELECT o_orderkey AS article, l_linenumber::BIGINT AS tab, l_quantity AS x, l_discount AS y, l_tax AS z FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'")
def points_fact(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    return o.join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_orderkey").alias("article"), _n("l_linenumber").alias("tab"), F.col("l_quantity").alias("x"), F.col("l_discount").alias("y"), F.col("l_tax").alias("z"))


@query("SELECT l_orderkey, string_agg(l_linenumber || ':' || l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS collection FROM lineitem GROUP BY 1")
def build_collections_nested(spark, sf):
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag")))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r["l_linenumber"].cast("string"), r["l_returnflag"])), ",").alias("collection"))


@query(f"WITH {IDS} SELECT slug, max(CASE WHEN pos % 4 = 0 THEN pos END) AS new_pos, coalesce(max(CASE WHEN pos % 4 = 0 THEN pos END), max(CASE WHEN pos % 3 = 0 THEN pos END)) AS pos FROM ids WHERE pos % 4 = 0 OR pos % 3 = 0 GROUP BY slug")
def upsert(spark, sf):
    all_ids = ids(spark, sf).select("slug", "pos")
    old = rel.keep_last(all_ids.filter("pos % 3 = 0"), ["slug"])
    return rel.merge_upsert(old, all_ids.filter("pos % 4 = 0").withColumn("new_pos", F.col("pos")), ["slug"])


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)")
def delete_keys(spark, sf):
    gone = table(spark, sf, "customer").filter("c_nationkey = 3").select(F.col("c_custkey").alias("o_custkey"))
    return rel.delete_keys(table(spark, sf, "orders"), gone, ["o_custkey"]).select("o_orderkey")


@query("""SELECT c_custkey, coalesce(nullif(cur, ''), nullif(inc, '')) AS filled, coalesce(nullif(inc, ''), nullif(cur, '')) AS overwritten
FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_name END AS cur, CASE c_custkey % 2 WHEN 0 THEN c_mktsegment ELSE '' END AS inc FROM customer)""")
def fill_and_overwrite_fields(spark, sf):
    k = F.col("c_custkey")
    cur, inc = F.when(k % 3 == 0, "").when(k % 3 == 2, F.col("c_name")), F.when(k % 2 == 0, F.col("c_mktsegment")).otherwise("")
    return table(spark, sf, "customer").select("c_custkey", rel.merge_fields(cur, inc, "FILL").alias("filled"), rel.merge_fields(cur, inc, "OVERWRITE").alias("overwritten"))


@query("SELECT event_id, event_type AS a_filled, CASE WHEN event_id % 2 = 0 THEN 'new' ELSE event_type END AS a_overwritten, CASE WHEN event_id % 2 = 0 THEN 'b' END AS b FROM events")
def blob_merge(spark, sf):
    k = F.col("event_id")
    cur = F.create_map(F.lit("a"), F.col("event_type"))
    inc = F.create_map(F.lit("a"), F.when(k % 2 == 0, "new").otherwise(""), F.lit("b"), F.when(k % 2 == 0, "b"))
    fill, over = rel.merge_blob(cur, inc, "FILL"), rel.merge_blob(cur, inc, "OVERWRITE")
    return table(spark, sf, "events").select("event_id", fill["a"].alias("a_filled"), over["a"].alias("a_overwritten"), fill["b"].alias("b"))


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS line, l_quantity AS value FROM lineitem WHERE l_orderkey % 5 > 0
UNION ALL SELECT l_orderkey, l_linenumber::BIGINT, l_quantity + 1 FROM lineitem WHERE l_orderkey % 5 = 0 AND l_linenumber = 1""")
def replace_children(spark, sf):
    old = table(spark, sf, "lineitem").select("l_orderkey", _n("l_linenumber").alias("line"), F.col("l_quantity").alias("value"))
    new = old.filter("l_orderkey % 5 = 0 AND line = 1").withColumn("value", F.col("value") + 1)
    return rel.delete_keys(old, old.filter("l_orderkey % 5 = 0"), ["l_orderkey"]).unionByName(new)


@query()
def html_text_extract(spark, sf):
    from folioforge.sources.readers import html_text

    return html_text(table(spark, sf, "pages").select("page_id", "html"))
