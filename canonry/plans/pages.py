"""Queries over landed pages: text, links and assets in the markup (HTM, FIL-05, FIL-09)."""

from __future__ import annotations

from pyspark.sql import functions as F

from canonry.functions import text as T
from canonry.functions.html import html_clean, html_fragment, html_listing, html_page
from canonry.session import table


def _pages(spark, d):
    return table(spark, d, "source_record").select("capture_id", F.col("content.html").alias("html")).where("html is not null").distinct()


def html_text(spark, d):
    """The text of each page, as its length and hash."""
    return _pages(spark, d).select("capture_id", html_page(F.col("html"))["text"].alias("text")).select("capture_id", F.length("text").alias("n"), F.sha2("text", 256).alias("text_hash"))


def html_links(spark, d):
    """FIL-05: links of the pages with how many pages have them."""
    href = F.explode(F.array_distinct(F.transform(html_page(F.col("html"))["links"], lambda x: x["href"])))
    return _pages(spark, d).select("capture_id", href.alias("href")).groupBy("href").agg(F.count(F.lit(1)).alias("pages"))


def html_paragraphs(spark, d):
    """HTM-03: blocks and list items of the Markdown of each page."""
    md = _pages(spark, d).select("capture_id", html_fragment(F.col("html")).alias("x")).select("capture_id", F.split("x.markdown", "\n\n").alias("b"), F.size("x.tables").alias("tables"))
    return md.select("capture_id", F.size(F.filter("b", lambda x: ~x.startswith("- ") & (x != ""))).alias("blocks"), F.size(F.filter("b", lambda x: x.startswith("- "))).alias("items"), "tables")


def html_listing_items(spark, d):
    """HTM-05: items of the lists of the pages that hold one link, with how many pages have them."""
    i = _pages(spark, d).select("capture_id", F.explode(html_listing(F.col("html"))["items"]).alias("x"))
    return i.groupBy(F.col("x.href").alias("href"), F.col("x.title").alias("title")).agg(F.count(F.lit(1)).alias("n"))


def html_cleaned(spark, d):
    """HTM-06: pages without what acts; here none does, so only the notation of breaks changes."""
    return _pages(spark, d).select("capture_id", F.sha2(html_clean(F.col("html"))["html"], 256).alias("html_hash"))


def official_hosts(spark, d):
    """FIL-09: captures by whether their page is on a host, or below one, that several records of a mapped system are on."""
    host = lambda c: F.lower(F.regexp_extract(c, "^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))
    s = table(spark, d, "source_record").select("capture_id", T.canonical_system(F.col("source_system")).alias("source_system"), F.col("source_record_id").alias("record_id"), host(F.col("source.page_url")).alias("host")).distinct()
    m = table(spark, d, "source_map").select("source_system", "record_id").distinct()
    official = s.where("host <> ''").join(m, ["source_system", "record_id"], "left_semi").groupBy("host").agg(F.count_distinct("record_id").alias("n")).where("n > 1").select("host")
    at = s.select("capture_id", "host", F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("host", "[.]"))), lambda i: F.array_join(F.slice(F.split("host", "[.]"), i, F.lit(99)), "."))).alias("above"))
    hit = at.join(official.withColumnRenamed("host", "above"), "above", "left_semi").select("capture_id").distinct().withColumn("official", F.lit(True))
    return s.select("capture_id", "host").distinct().join(hit, "capture_id", "left").select("capture_id", "host", F.coalesce("official", F.lit(False)).alias("official"))


_P = "p AS MATERIALIZED (SELECT DISTINCT capture_id, struct_extract(content, 'html') AS html FROM source_record)"
QUERIES = {"html_text": html_text, "html_links": html_links, "html_paragraphs": html_paragraphs, "html_listing": html_listing_items, "html_cleaned": html_cleaned, "official_hosts": official_hosts}
SQL = {
    "html_links": f"WITH {_P}, l AS (SELECT capture_id, unnest(list_distinct(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1))) AS href FROM p WHERE html IS NOT NULL) SELECT href, count(*) AS pages FROM l GROUP BY 1",
    "html_text": f"WITH {_P}, t AS (SELECT capture_id, regexp_replace(regexp_replace(html, '</?(p|div|li|ul|br|td|article|html|body)/?( [^>]*)?>', chr(10), 'g'), '</?(a|html|body)( [^>]*)?>', '', 'g') AS t FROM p WHERE html IS NOT NULL), l AS (SELECT capture_id, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(regexp_replace(x, '[ \\t\\r\\x{{A0}}\\x{{3000}}]+', ' ', 'g'))), lambda x: x <> '') AS f FROM t), j AS (SELECT capture_id, coalesce(array_to_string(f, chr(10)), '') AS text FROM l) SELECT capture_id, length(text) AS n, sha256(text) AS text_hash FROM j",
    "html_paragraphs": f"WITH {_P}, t AS (SELECT capture_id, regexp_replace(regexp_replace(regexp_replace(html, '</?(a|html|body)( [^>]*)?>', '', 'g'), '<li( [^>]*)?>', chr(10) || chr(1), 'g'), '</?(p|div|li|ul|br|td|article)/?( [^>]*)?>', chr(10), 'g') AS t FROM p WHERE html IS NOT NULL), l AS (SELECT capture_id, list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '[\\s\\x{{3000}}\\x{{A0}}\\x{{1}}]+', '', 'g') <> '') AS f FROM t) SELECT capture_id, CAST(len(list_filter(f, lambda x: x[1] <> chr(1))) AS INTEGER) AS blocks, CAST(len(list_filter(f, lambda x: x[1] = chr(1))) AS INTEGER) AS items, 0 AS tables FROM l",
    "html_listing": f"WITH {_P}, l AS (SELECT unnest(regexp_extract_all(html, '<li[^>]*>(.*?)</li>', 1)) AS li FROM p WHERE html IS NOT NULL), x AS (SELECT regexp_extract(li, '<a href=\"([^\"]*)\"', 1) AS href, regexp_replace(li, '<[^>]*>', '', 'g') AS title FROM l WHERE len(regexp_extract_all(li, '<a ')) = 1) SELECT href, title, count(*) AS n FROM x GROUP BY ALL",
    "html_cleaned": f"WITH {_P} SELECT capture_id, sha256(replace(html, '<br/>', '<br>')) AS html_hash FROM p WHERE html IS NOT NULL",
    "official_hosts": "WITH s AS MATERIALIZED (SELECT DISTINCT capture_id, replace(lower(trim(source_system)), '-', '_') AS source_system, source_record_id AS record_id, lower(regexp_extract(struct_extract(source, 'page_url'), '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)) AS host FROM source_record), o AS (SELECT host FROM s SEMI JOIN source_map m USING (source_system, record_id) WHERE host <> '' GROUP BY 1 HAVING count(DISTINCT record_id) > 1) SELECT capture_id, host, bool_or(EXISTS (SELECT 1 FROM o WHERE s.host = o.host OR ends_with(s.host, '.' || o.host))) AS official FROM s GROUP BY ALL",
}
