"""Quality rules as a short-circuit cascade, cheapest rejections first.  SQL functions only."""

from __future__ import annotations

import dataclasses
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tapewright.llm.common import SPACES, boxed, let, sample_of, unboxed, written

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Documents on which the rules are timed and counted.
SAMPLE = 2000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def repeat_words(words: Column, size: int = 3) -> Column:
    """Words within a window of ``size`` words that the text has twice or more.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes: sorted
    with their places, equal ones are neighbours.
    """

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, 1, F.greatest(F.size(hashes) - (size - 1), F.lit(0))),
            lambda h, i: F.struct(F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, size)]).alias("h"), i.alias("i")),
        )

    def repeated(ordered: Column) -> Column:
        def same(w: Column, i: Column) -> Column:
            return F.coalesce(F.get(ordered, i - 1)["h"] == w["h"], F.lit(False)) | F.coalesce(
                F.get(ordered, i + 1)["h"] == w["h"], F.lit(False))

        places = F.transform(F.filter(ordered, same), lambda w: F.array(*[w["i"] + k for k in range(size)]))
        return F.size(F.array_distinct(F.flatten(places)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashes, lambda h: let(F.sort_array(windows(h)), repeated))


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def base_counts(text: Column) -> dict[str, Column]:
    """The five counts of a whole text (NULL: none)."""
    string = F.coalesce(text, F.lit(""))
    words = words_of(text)
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": (F.length(string) - F.length(F.regexp_replace(string, r"[#*$%&|<>]", ""))).cast("bigint"),
        "n_dup_lines": dup_lines(text).cast("bigint"),
        "n_repeat_words": repeat_words(words).cast("bigint"),
    }


@dataclasses.dataclass(frozen=True)
class Rule:
    """A rule over the text column; ``rejects`` must not be NULL."""

    name: str
    rejects: Column


def default_rules(text: str = "text") -> list[Rule]:
    """Limits far outside of ordinary prose; each rule reads the whole text."""
    string, words = F.coalesce(F.col(text), F.lit("")), words_of(F.col(text))
    letters = F.length(F.regexp_replace(string, r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace(string, r"[^\p{Lu}]+", ""))
    return [
        Rule("few_words", F.size(words) < 50),
        Rule("repeats", let(words, lambda w: 100 * repeat_words(w) > 50 * F.size(w))),
        # A tenth as many symbols as words, or more.
        Rule("symbols", 10 * (F.length(string) - F.length(F.regexp_replace(string, r"[#*$%&|<>]", "")))
             > F.size(words)),
        # More than half of the letters are capitals.
        Rule("capitals", 2 * capitals > letters),
        # Words of a mean length outside 2 to 20 characters.
        Rule("word_length", let(words, lambda w: ~F.length(F.array_join(w, "")).between(2 * F.size(w), 20 * F.size(w)))),
        # More than half of the lines are copies of earlier ones.
        Rule("lines", let(dup_lines(F.col(text)), lambda n: 2 * n > F.size(F.split(string, "\n")))),
        # Fewer letters than half of all that is no white space.
        Rule("letters", 2 * letters < F.length(F.regexp_replace(string, SPACES, ""))),
    ]


def rules_on_base() -> list[Rule]:
    """The same limits where the base counts are at hand as columns."""
    c = F.col
    others = [r for r in default_rules() if r.name in ("capitals", "lines", "letters")]
    return [
        Rule("symbols", 10 * c("n_symbols") > c("n_words")),
        Rule("word_length", ~c("word_chars").between(2 * c("n_words"), 20 * c("n_words"))),
        *others,
    ]


def ordered(sample: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """The rules by rejections per second on a sample, best first.

    Each rule is run alone over the sample, a small table of its own.  The
    order decides what a run costs, never which documents it keeps.
    """
    sample = written(sample, "rule-sample")
    rates = {}
    for rule in rules:
        start = time.perf_counter()
        rejected = sample.agg(F.count_if(rule.rejects)).first()[0]
        rates[rule.name] = rejected / (time.perf_counter() - start)
    return sorted(rules, key=lambda r: -rates[r.name])


def verdict(rules: Sequence[Rule]) -> Column:
    """False at the first rule that rejects; later rules are then not computed."""
    kept = F.lit(True)
    for rule in reversed(rules):
        kept = F.when(rule.rejects, F.lit(False)).otherwise(kept)
    return kept


def filtered(docs: DataFrame, text: str = "text", rules: Sequence[Rule] | None = None, rows: int = SAMPLE) -> DataFrame:
    """The documents no rule rejects, all columns as they were.

    A NULL or empty text has no words and is rejected.  Copies and repeated
    rows share one verdict; an empty table stays empty.
    """
    rules = default_rules(text) if rules is None else rules
    return docs.filter(verdict(ordered(sample_of(docs.select(text), rows), rules)))


def judged(docs: DataFrame, text: str = "text", rows: int = SAMPLE) -> DataFrame:
    """Every row with the five base counts, ``base_failed`` and ``kept``.

    The base counts are part of the result, so they are computed for every
    row; the cascade stops at the first rejection.  Columns of the input with
    these names give way.
    """
    counts = boxed(docs, text=F.col(text)).withColumns(base_counts(F.col("text")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    sample = sample_of(docs.select(F.col(text).alias("text")), rows).withColumns(base_counts(F.col("text")))
    rules = ordered(sample, rules_on_base())
    result = counts.withColumns({"base_failed": failed, "kept": F.when(failed, F.lit(False)).otherwise(verdict(rules))})
    return unboxed(result, [*BASE, "base_failed", "kept"])
