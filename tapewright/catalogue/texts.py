"""Tags, sentiment and the news feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewright.catalogue import query
from tapewright.functions.text import tag_by_rules, with_sentiment
from tapewright.plans import reports
from tapewright.sources.tables import parquet

# Rules and lexicons made for the invented texts of the supplied tables.
RULES = [("warm", ["hot", "red"]), ("cool", ["cold", "blue"]), ("size", ["small", "large"])]
POSITIVE = ["the", "and", "le", "der", "la", "un"]
NEGATIVE = ["of", "to", "on", "et", "und", "en"]

SPACE = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _hits(words: list[str], column: str = "words") -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"CAST(len(list_intersect({column}, [{listed}])) AS INTEGER)"


SCORED = f"""
WITH w AS (SELECT *, string_split(trim(regexp_replace(lower(text), '{SPACE}', ' ', 'g')), ' ') AS words FROM documents),
h AS (SELECT *, {_hits(POSITIVE)} AS positive_hits, {_hits(NEGATIVE)} AS negative_hits FROM w),
s AS (SELECT *, CASE WHEN positive_hits > negative_hits THEN 'positive'
                     WHEN negative_hits > positive_hits THEN 'negative' ELSE 'neutral' END AS sentiment FROM h)
"""


def _documents(spark, sf):
    return parquet(spark, sf, "documents")


def _scored(spark, sf):
    return with_sentiment(_documents(spark, sf), "text", positive=POSITIVE, negative=NEGATIVE)


@query("tag_rules", """
SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%hot%' OR lower(p_name) LIKE '%red%' THEN 'warm'
  WHEN lower(p_name) LIKE '%cold%' OR lower(p_name) LIKE '%blue%' THEN 'cool'
  WHEN lower(p_name) LIKE '%small%' OR lower(p_name) LIKE '%large%' THEN 'size' ELSE 'general' END AS category
FROM part""")
def tag_rules(spark, sf):
    return parquet(spark, sf, "part").select("p_partkey", tag_by_rules(F.col("p_name"), RULES).alias("category"))


@query("tag_rules_words", r"""
SELECT doc_id, CASE WHEN regexp_matches(lower(text), '(?:^|[^\p{L}\p{N}_])(?:the|and)(?:$|[^\p{L}\p{N}_])') THEN 'english'
  WHEN regexp_matches(lower(text), '(?:^|[^\p{L}\p{N}_])(?:le|la)(?:$|[^\p{L}\p{N}_])') THEN 'french' ELSE 'other' END AS category
FROM documents""")
def tag_rules_words(spark, sf):
    """Whole words only, over whole texts."""
    rules = [("english", ["the", "and"]), ("french", ["le", "la"])]
    return _documents(spark, sf).select(
        "doc_id", tag_by_rules(F.col("text"), rules, "other", "word").alias("category")
    )


@query("tag_rules_feed", """
SELECT doc_id, CASE
  WHEN regexp_matches(t, 'earn|revenue|profit|eps|quarterly') THEN 'earnings'
  WHEN regexp_matches(t, 'acqui|merger|takeover|deal|ipo') THEN 'm&a'
  WHEN regexp_matches(t, 'fed|rate|inflation|cpi|gdp|treasury') THEN 'macro'
  WHEN regexp_matches(t, 'sec|filing|disclosure|lawsuit') THEN 'regulatory' ELSE 'general' END AS category
FROM (SELECT doc_id, lower(text) AS t FROM documents)""")
def tag_rules_feed(spark, sf):
    """The feed's own rule set over whole texts."""
    return _documents(spark, sf).select("doc_id", tag_by_rules(F.col("text")).alias("category"))


@query("lexicon_sentiment", SCORED + "SELECT doc_id, positive_hits, negative_hits, sentiment FROM s")
def lexicon_sentiment(spark, sf):
    return _scored(spark, sf).select("doc_id", "positive_hits", "negative_hits", "sentiment")


@query("lexicon_sentiment_no_punct", f"""
WITH w AS (SELECT doc_id, string_split(trim(regexp_replace(regexp_replace(lower(text),
    '[[:punct:]]', ' ', 'g'), '{SPACE}', ' ', 'g')), ' ') AS words FROM documents)
SELECT doc_id, {_hits(POSITIVE)} AS positive_hits, {_hits(NEGATIVE)} AS negative_hits FROM w""")
def lexicon_sentiment_no_punct(spark, sf):
    scored = with_sentiment(
        _documents(spark, sf), "text", positive=POSITIVE, negative=NEGATIVE, strip_punct=True
    )
    return scored.select("doc_id", "positive_hits", "negative_hits")


@query("sentiment_counts", SCORED + """
SELECT COUNT(*) FILTER (WHERE sentiment = 'positive') AS positive,
       COUNT(*) FILTER (WHERE sentiment = 'neutral') AS neutral,
       COUNT(*) FILTER (WHERE sentiment = 'negative') AS negative FROM s""")
def sentiment_counts(spark, sf):
    return reports.sentiment_counts(_scored(spark, sf))


def _articles(spark, sf):
    """Documents as articles: the first line is the title."""
    return _documents(spark, sf).select(
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("source").alias("source_name"),
        F.col("doc_id").alias("published_at"),
        F.col("text").alias("description"),
        F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("lang").alias("category"),
    )


@query("news_feed", SCORED + """
, newest AS (SELECT * FROM s WHERE lang = 'en' ORDER BY doc_id DESC LIMIT 100)
SELECT lang AS category, substring(split_part(text, chr(10), 1), 1, 100) AS title, source AS source_name,
       CASE WHEN length(text) >= 130 THEN substring(text, 1, 130) || '...' ELSE text END AS description,
       CAST(doc_id AS VARCHAR) AS published, 'https://news.example/' || doc_id AS url, sentiment
FROM newest WHERE contains(lower(source), 'src1') OR contains(lower(split_part(text, chr(10), 1)), 'src1')""")
def news_feed(spark, sf):
    """The newest 100 of a category, searched within those, as cards."""
    feed = reports.news_feed(
        _articles(spark, sf), 100, "en", "SRC1", positive=POSITIVE, negative=NEGATIVE
    )
    return reports.cards(feed)


@query("news_search_first", SCORED + """
SELECT doc_id AS published_at, positive_hits, negative_hits, sentiment FROM s
WHERE contains(lower(source), 'src1') OR contains(lower(split_part(text, chr(10), 1)), 'src1')
ORDER BY doc_id DESC LIMIT 30""")
def news_search_first(spark, sf):
    feed = reports.news_feed(
        _articles(spark, sf), 30, search="src1", search_first=True, positive=POSITIVE, negative=NEGATIVE
    )
    return feed.select("published_at", "positive_hits", "negative_hits", "sentiment")
