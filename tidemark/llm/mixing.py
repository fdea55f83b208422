"""Mixing sources to target weights by hash thresholds (operator 9).

Every document has a 60-bit hash of its id. Words are summed by source and leading hash bits; the bucket in which a
source's budget ends is found from the running sums, and only that bucket is summed again by its next bits. After five
rounds the budget ends at one hash value. Documents below the threshold are taken: a filter, no sort of documents.
Thresholds are nested, so a larger budget takes a superset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import WORD, stored, text_or_empty

WEIGHTS = (1, 2, 3)
MOST = 3
HASH_BITS, STEP_BITS = 60, 12


def hash60() -> F.Column:
    """The first 15 hex digits of the MD5 of the id as text, as a number."""
    digits = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    words = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")
    return docs.select("doc_id", "source", words.alias("size"), hash60().alias("h"))


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: its size and its target, by water filling over the sources in order of cap by weight."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    per = rows.groupBy("source").agg(F.sum("size").alias("s")).withColumn("w", weight.cast("long"))
    whole = F.lit(1)
    fill = Window.orderBy(F.col("s") * 1.0 / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(whole)
    per = per.select(
        "source", "s", "w",
        (F.sum("s").over(everything) - F.coalesce(F.sum(most * F.col("s")).over(fill), F.lit(0))).alias("left_s"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(fill), F.lit(0))).alias("left_w"),
    )
    wide = lambda name: F.col(name).cast("decimal(38,0)")
    per = per.withColumn("full", wide("left_s") * wide("w") > wide("s") * most * wide("left_w"))
    free = [F.max(F.when(~F.col("full"), F.col(n))).over(everything) for n in ("left_s", "left_w")]
    shared = (F.col("w") * free[0]).cast("double") / free[1].cast("double")
    return per.select("source", "s", F.when(F.col("full"), (most * F.col("s")).cast("double")).otherwise(shared).alias("target"))


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source with words: whole copies of everything, and the hash below which one more copy is taken."""
    whole = F.floor(F.col("target") / F.col("s"))
    state = targets.filter("s > 0").select(
        F.col("source").alias("of"), "target", F.col("s"), whole.alias("copies"),
        (F.col("target") - whole * F.col("s")).alias("budget"), F.lit(0).cast("long").alias("prefix"),
    )
    state = stored(state, "mix-budgets")
    size = rows.filter("size > 0")
    for used in range(STEP_BITS, HASH_BITS + 1, STEP_BITS):
        inside = F.shiftright("h", HASH_BITS - used + STEP_BITS) == F.col("prefix")
        mine = F.col("source").eqNullSafe(F.col("of"))
        sums = (
            size.join(state.select("of", "prefix"), mine & inside)
            .groupBy("of", F.shiftright("h", HASH_BITS - used).alias("bucket"))
            .agg(F.sum("size").alias("words"))
        )
        running = F.sum("words").over(Window.partitionBy("of").orderBy("bucket"))
        sums = sums.withColumn("upto", running).withColumnsRenamed({"of": "at"})
        end = F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"), "words")
        found = (
            state.drop("words").join(sums, F.col("of").eqNullSafe(F.col("at")))
            .filter(F.col("upto") > F.col("budget"))
            .groupBy("of", "target", "s", "copies", "budget")
            .agg(F.min(end).alias("end"))
        )
        state = stored(
            found.select(
                "of", "target", "s", "copies", (F.col("budget") - F.col("end.before")).alias("budget"),
                F.col("end.bucket").alias("prefix"), F.col("end.words").alias("words"),
            ),
            "mix-budgets",
        )
    nearer = F.when(2 * F.col("budget") >= F.col("words"), 1).otherwise(0)
    return state.select("of", "copies", (F.col("prefix") + nearer).alias("below"))


def _decided(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    targets = stored(source_targets(rows), "mix-targets")
    return targets, thresholds(rows, targets)


def times() -> F.Column:
    return F.coalesce(F.col("copies") + F.when(F.col("h") < F.col("below"), 1).otherwise(0), F.lit(0)).cast("long")


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: how many of its words the mix takes.

    Needs ``doc_id``, ``source`` and ``text``. Returns ``doc_id, size, source_size, target, taken``. A null source is
    a source of its own, last in order; null or empty texts have size 0 and are taken 0 times. Rows repeating a
    ``doc_id`` share its hash and are taken together. A source's taken words differ from its target by at most half of
    the words at the boundary hash, normally half a document. An empty table gives an empty result.
    """
    rows = stored(sized(docs), "sizes")
    targets, cuts = _decided(rows)
    plan = targets.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").select(
        F.col("source").alias("of_source"), F.col("s").alias("source_size"), "target", "copies", "below"
    )
    return rows.join(plan, F.col("source").eqNullSafe(F.col("of_source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times()).alias("taken")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken. Thresholds are looked up by source; texts stay in place
    where Spark finds the small threshold table fit to broadcast, and else its skew handling splits a hot source."""
    rows = stored(sized(docs), "sizes")
    _, cuts = _decided(rows)
    again = cuts["copies"] + F.when(hash60() < cuts["below"], 1).otherwise(0)
    has_words = F.regexp_like(text_or_empty(), F.lit(WORD))
    joined = docs.join(cuts, docs["source"].eqNullSafe(cuts["of"]))
    row = F.struct(*(docs[c] for c in docs.columns))
    return joined.select(F.explode(F.array_repeat(row, F.when(has_words, again).otherwise(0).cast("int"))).alias("row")).select("row.*")
