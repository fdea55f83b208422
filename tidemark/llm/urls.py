"""URL filter: host and path rules, then a weighted vocabulary searched with Aho-Corasick (operator 3).

One pass over the table without a shuffle; rules are column expressions and the automaton is built once per task from a
vocabulary of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract: verdict and rule; the text before the first slash is the host.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: One hit of a strict term rejects.
STRICT = ("casino", "porn", "xxx", "viagra", "phishing", "warez", "malware", "escort")
#: Distinct soft terms count by weight; a sum of SOFT_LIMIT rejects.
SOFT = {
    "blog": 1, "top": 1, "ref": 1, "page": 1, "free": 1, "win": 1, "bonus": 2, "click": 1, "cheap": 1, "promo": 1,
    "download": 1, "bet": 2, "pills": 2, "adult": 2, "loan": 1,
}
SOFT_LIMIT = 3

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Vocabulary:
    strict: tuple[str, ...] = STRICT
    soft: tuple[tuple[str, int], ...] = tuple(SOFT.items())
    soft_limit: int = SOFT_LIMIT


def lower_ascii(column: Column) -> Column:
    return F.translate(column, ASCII_UPPER, ASCII_LOWER)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule, as a struct of verdict and rule, whose host is the URL's or a parent and whose path is a prefix."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):  # a longer one overrides
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def hits(urls: list[str], vocabulary: Vocabulary) -> Iterator[tuple[int, int]]:
    """For each URL the strict hits, repeats counted, and the weight of distinct soft terms.

    A term counts where no ASCII letter or digit stands beside it.
    """
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for term in vocabulary.strict:
        automaton.add_word(term, (term, None))
    for term, weight in vocabulary.soft:
        automaton.add_word(term, (term, weight))
    automaton.make_automaton()
    within = frozenset(ASCII_LOWER + "0123456789")
    lower = str.maketrans(ASCII_UPPER, ASCII_LOWER)
    for url in urls:
        text = (url or "").translate(lower)
        strict, soft = 0, {}
        for last, (term, weight) in automaton.iter(text):
            first = last - len(term) + 1
            if (first and text[first - 1] in within) or (last + 1 < len(text) and text[last + 1] in within):
                continue
            if weight is None:
                strict += 1
            else:
                soft[term] = weight
        yield strict, sum(soft.values())


def judge(pages: DataFrame, rules=RULES, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """``page_id, host, path, rule, verdict, strict_hits, soft_weight`` for every row; needs ``page_id`` and ``url``.

    A null URL has empty host and path, no hits, and is allowed. Rows are judged one by one, so repeats get equal
    verdicts and an empty table gives an empty result. Long URLs are searched whole.
    """

    @F.pandas_udf("strict_hits int, soft_weight int")
    def searched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            yield pd.DataFrame(list(hits(urls.tolist(), vocabulary)), columns=["strict_hits", "soft_weight"])

    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), searched("url").alias("hit"))
    rows = rows.withColumn("by", longest_rule(F.col("host"), F.col("path"), rules))
    rejected = (F.col("hit.strict_hits") > 0) | (F.col("hit.soft_weight") >= vocabulary.soft_limit)
    verdict = F.coalesce(F.col("by.verdict"), F.when(rejected, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", F.col("by.rule").alias("rule"), verdict.alias("verdict"), "hit.strict_hits", "hit.soft_weight")
