"""Rule tags, lexicon sentiment and page text as column expressions (no Python worker)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from tapewright.dims import NEGATIVE_WORDS, POSITIVE_WORDS, TAG_DEFAULT, TAG_RULES_V2
from tapewright.functions import strings


def has_any(text: Column, terms: Sequence[str], mode: str = "substring") -> Column:
    """True when one of the lower-case terms occurs in the (lower-case) text."""
    if mode == "substring":
        return reduce(or_, [text.contains(t) for t in terms])
    if mode == "word":
        # Spelled out: what \b takes for a letter depends on the Java version.
        other = r"[^\p{L}\p{N}_]"
        return text.rlike(f"(?:^|{other})(?:{'|'.join(map(re.escape, terms))})(?:$|{other})")
    raise ValueError(f"unknown mode {mode!r}")


def tag_by_rules(
    text: Column,
    rules: Sequence[tuple[str, Sequence[str]]] = TAG_RULES_V2,
    default: str = TAG_DEFAULT,
    mode: str = "substring",
) -> Column:
    """Category of the first rule with a term in the text."""
    low = F.lower(strings.or_default(text, ""))
    tag = F
    for category, terms in rules:
        tag = tag.when(has_any(low, terms, mode), F.lit(category))
    return tag.otherwise(F.lit(default))


def lexicon_hits(words: Column, lexicon: Sequence[str]) -> Column:
    """How many different words of the lexicon are among the words."""
    return F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in lexicon])))


def sentiment_label(positive: Column, negative: Column) -> Column:
    return (
        F.when(positive > negative, "positive")
        .when(negative > positive, "negative")
        .otherwise("neutral")
    )


def with_sentiment(
    df,
    *texts: str,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
    strip_punct: bool = False,
):
    """Add ``positive_hits``, ``negative_hits`` and ``sentiment`` of the joined texts."""
    joined = F.concat_ws(" ", *[strings.or_default(F.col(t), "") for t in texts])
    return (
        df.withColumn("_words", strings.words(joined, strip_punct))
        .withColumns({
            "positive_hits": lexicon_hits(F.col("_words"), positive),
            "negative_hits": lexicon_hits(F.col("_words"), negative),
        })
        .withColumn("sentiment", sentiment_label(F.col("positive_hits"), F.col("negative_hits")))
        .drop("_words")
    )


def page_text(html: Column, max_chars: int | None = None) -> Column:
    """Text of a page: tags become blanks, white space is squashed and stripped.

    Whole by default; ``dims.FILING_TEXT_CHARS`` is the usual cap for filings.
    """
    text = F.trim(strings.squash(F.regexp_replace(html, r"<[^>]+>", " ")))
    return strings.clip(text, max_chars)
