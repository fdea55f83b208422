"""Importance resampling towards a target distribution (operator 13).

Words fall into hashed buckets. A bucket's gain says how much more frequent it is in the target texts than in the
documents; a document's weight is the mean gain of its features, to which noise made from its id is added, so that the
highest scores are a draw without replacement. The gains are one array, by which every document is scored where it lies.
The cutoff comes from exact counting jobs over the stored scores (:func:`numbering.first_rows`); only the rows drawn are
ordered, by a range partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_or_empty
from tidemark.llm.numbering import first_rows, numbered

#: Fixed values of the contract: the signs of a word after lower-casing A-Z, and the parameters of the draw.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS, RUN, SEED, LEAST_WORDS, PERCENT = 10_000, 1, 2024, 20, 10
#: How a document is placed: best score, then smallest id (null last), then fewest features, then the row as stored.
ORDER = ("_less", "_unknown", "_id", "n_features", "_row")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), 0)


def features(found: Column, run: int) -> Column:
    """All runs of 1 to ``run`` consecutive words, joined by one space."""
    if run == 1:
        return found

    def runs(w: Column) -> Column:
        def of(n: int) -> Column:
            places = F.filter(F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0))), lambda i: i + n <= F.size(w))
            return F.transform(places, lambda i: F.concat_ws(" ", *(F.get(w, i + k) for k in range(n))))

        return F.concat(*(of(n) for n in range(1, run + 1)))

    return F.get(F.transform(F.array(found), runs), F.lit(0))  # the words are found once, not once a run


def bucket(feature: Column, buckets: int) -> Column:
    return F.crc32(feature) % buckets


def counted(texts: DataFrame, buckets: int, run: int) -> DataFrame:
    """``bucket, n``: features a bucket over all rows, summed before they are shuffled."""
    feature = F.explode(features(words(text_or_empty()), run))
    return texts.select(feature.alias("feature")).groupBy(bucket(F.col("feature"), buckets).alias("bucket")).agg(F.count("*").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, run: int = RUN) -> DataFrame:
    """``gain``: one row with the array of all buckets' gains, over all documents and all target texts."""
    sides = counted(docs, buckets, run).select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).unionByName(
        counted(target, buckets, run).select("bucket", F.lit(0).alias("s"), F.col("n").alias("t"))
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).alias("s"), F.lit(0).alias("t"))
    by_bucket = sides.unionByName(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    # One array of all buckets: as many entries as the parameter says, whatever the tables hold.
    whole = by_bucket.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "s", "t"))).alias("all"), F.sum("s").alias("docs"), F.sum("t").alias("target")
    )

    def gain(b: Column) -> Column:
        more = (b["t"] + 1.0) * (F.col("docs") + float(buckets))
        less = (b["s"] + 1.0) * (F.col("target") + float(buckets))
        return F.floor(1000 * F.ln(more / less))

    return whole.select(F.transform("all", gain).alias("gain"))


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the digest of seed and id; a null id counts as an empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((digits + 0.5) / 4294967296)))


def scores(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, run: int = RUN, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    table = stored(gains(docs, target, buckets, run), "gains").scalar()
    found = words(text_or_empty())
    rows = docs.select("doc_id", F.size(found).cast("long").alias("n_words"), features(found, run).alias("f"))
    rows = rows.select("doc_id", "n_words", F.transform("f", lambda f: bucket(f, buckets).cast("int")).alias("b"), table.alias("gain"))
    total = F.aggregate("b", F.lit(0).cast("long"), lambda t, b: t + F.col("gain")[b])
    rows = rows.select("doc_id", "n_words", F.size("b").cast("long").alias("n_features"), total.alias("total"))
    n = F.col("n_features")
    mean = F.when(n == 0, F.lit(0)).otherwise(F.expr("(total - pmod(total, n_features)) div nullif(n_features, 0)"))
    weighed = rows.select("doc_id", "n_words", "n_features", mean.cast("long").alias("weight"))
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    run: int = RUN,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document with its weight, its score and its rank in the draw.

    Needs ``doc_id`` and ``text`` of ``docs`` and ``text`` of ``target``; other columns are not read. Returns ``doc_id,
    n_features, weight, score, rank``, all long; ``rank`` counts from 1 and is null where a document is not drawn.
    Of the N rows with at least ``least_words`` words ``floor(percent * N / 100)`` are drawn: highest score first, then
    smallest ``doc_id`` (null last), then fewest features; rows equal in all of these are interchangeable, but only as many
    as asked for are drawn. Null and empty texts have no features and weight 0; they count as documents. Rows that repeat
    a ``doc_id`` share its noise. Without target texts all gains still follow the formula; empty tables give no row.
    """
    placed = scores(docs, target, buckets, run, seed).select(
        "*",
        (-F.col("score")).alias("_less"),
        F.when(F.col("doc_id").isNull(), 1).otherwise(0).alias("_unknown"),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("_id"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = stored(placed, "scores")
    eligible = rows.where(F.col("n_words") >= least_words)
    wanted = eligible.count() * percent // 100
    drawn = (F.col("n_words") >= least_words) & first_rows(eligible, ORDER, wanted)
    best = rows.where(drawn).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    ranked = numbered(best, "_at", "drawn").withColumn("rank", F.col("_at") + 1)
    result = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(result).unionByName(rows.where(~drawn).withColumn("rank", F.lit(None).cast("long")).select(result))
