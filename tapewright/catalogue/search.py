"""Search in a whole store by an index, rules as a table, and summaries kept up to date."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewright.catalogue import query, standins
from tapewright.catalogue.standins import sql
from tapewright.operators import search, summary
from tapewright.session import shared_folder
from tapewright.sources.tables import parquet

NEEDLE = "De La "


@query("search_news_indexed", f"""
SELECT doc_id, md5(text) AS digest, lang FROM documents WHERE contains(lower(text), '{NEEDLE.lower()}')""")
def search_news_indexed(spark, sf):
    """Whole texts searched through an index that two loads have built."""
    docs = parquet(spark, sf, "documents").select("doc_id", "text", "lang")
    path = shared_folder(spark, "index")
    for part in (0, 1):
        search.add(docs.filter(F.col("doc_id") % 2 == part), "doc_id", "text", path)
    found = search.search(spark, NEEDLE, "doc_id", "text", path)
    return found.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), "lang")


# Five thousand words of the texts, in an order that says nothing.
@query("tag_rules_table", """
WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS term FROM documents),
r AS (SELECT term, 't' || (length(term) % 5) AS tag, row_number() OVER (ORDER BY md5(term), term) AS ordinal FROM w QUALIFY ordinal <= 5000),
t AS (SELECT doc_id, lower(text) AS t FROM documents)
SELECT doc_id, coalesce(arg_min(tag, ordinal), 'general') AS category FROM t LEFT JOIN r ON contains(t, term) GROUP BY doc_id""")
def tag_rules_table(spark, sf):
    """A dictionary of 5,000 terms; the first of them that is anywhere in a text decides."""
    docs = parquet(spark, sf, "documents").select("doc_id", "text")
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{6,})"))).alias("term")).distinct()
    order = F.md5(F.col("term").cast("binary"))
    first = words.orderBy(order, "term").limit(5000)
    listed = first.agg(F.sort_array(F.collect_list(F.struct(order.alias("o"), "term"))).alias("r")).select(F.posexplode("r").alias("ordinal", "r"))
    rules = listed.select(F.col("r.term").alias("term"), F.concat(F.lit("t"), (F.length("r.term") % 5).cast("string")).alias("tag"), "ordinal")
    return search.tag_by_table(docs, rules, "doc_id", "text", "general").select("doc_id", "category")


@query("volume_summary_merged", sql("""
SELECT 'filings' AS source, COUNT(*) AS rows, epoch_us(MAX(fetched_at)) AS newest_us, 0::BIGINT AS chars, true AS distinct_is_near FROM filings
UNION ALL SELECT 'news', COUNT(*), epoch_us(MAX(published_at)), 0, true FROM news
UNION ALL SELECT 'documents', COUNT(*), NULL, SUM(length(text))::BIGINT, true FROM documents""", "filings", "news"))
def volume_summary_merged(spark, sf):
    """The summary after three loads of each source, one of them run twice; its distinct counts held against exact ones."""
    path = shared_folder(spark, "states")
    filings, news = standins.filing_facts(spark, sf), standins.news(spark, sf)
    docs = parquet(spark, sf, "documents")
    sources = [
        ("filings", filings, dict(time="fetched_at", distinct="ticker"), "accession_number"),
        ("news", news, dict(time="published_at", distinct="url"), "url"), ("documents", docs, dict(text="text", distinct="doc_id"), "doc_id")]
    exact = None
    for name, rows, what, key in sources:
        third = F.pmod(F.xxhash64(key), F.lit(3))
        for load in (0, 1, 2, 1):
            summary.keep_state(summary.load_state(rows.filter(third == load), name, str(load), **what), path)
        one = rows.agg(F.count_distinct(what["distinct"]).alias("_exact")).select(F.lit(name).alias("source"), "_exact")
        exact = one if exact is None else exact.union(one)
    near = F.abs(F.col("distinct") - F.col("_exact")) <= 3 * summary.SKETCH_ERROR * F.col("_exact")
    return summary.merged(spark, path).join(exact, "source").select(
        "source", "rows", F.unix_micros("newest").alias("newest_us"), "chars", near.alias("distinct_is_near"))
