"""As-of join: the dimension version valid at a fact's time.

Validity is half-open ``[effective_from, effective_to)``, an open end means for ever, and a fact without a
version gets the unknown member. Versions of one key must not overlap, as in :mod:`history`.

Facts and starts of versions form one stream in the order of key and time, cut into ranges; one pass carries the last
version forward, and each range is told the last version before it. Work grows with facts + versions, never
with their product. Neither a hot key nor a time that many facts share puts facts into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ranges import RANGE, Ranges, in_order, in_ranges

UNKNOWN = "-1"  # fixed value: surrogate key of the unknown member
#: A dimension is looked up as one array of versions a key where no key has more of them.
FEW = 64
ORDER = ["_key", "_at", "_asks", "_salt"]


def as_of_join(fact: DataFrame, dim: DataFrame, key: str, at: str, surrogate: str, ranges: int | None = None) -> DataFrame:
    """Add ``surrogate`` of the version of ``key`` valid at ``at``; a fact without key or time has none."""
    asked = fact.select(
        F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_asks"), _salt(fact).alias("_salt"), F.struct("*").alias("_fact")
    )
    version = F.struct(F.col(surrogate).alias("found"), F.col("effective_to").alias("until"))
    starts = dim.where(F.col(key).isNotNull() & F.col("effective_from").isNotNull()).select(
        F.col(key).alias("_key"),
        F.col("effective_from").alias("_at"),
        F.lit(0).alias("_asks"),
        F.xxhash64(surrogate).alias("_salt"),
        version.alias("_version"),
    )
    # A version that starts at the moment itself sorts before it, hence applies.
    stream = in_ranges(asked.unionByName(starts, allowMissingColumns=True), ORDER, "as-of", ranges)
    so_far = Window.partitionBy(RANGE, "_key").orderBy(*ORDER[1:]).rowsBetween(Window.unboundedPreceding, 0)
    swept = stream.dealt().withColumn("_last", F.last("_version", ignorenulls=True).over(so_far)).where("_asks = 1")
    told = swept.join(F.broadcast(_versions_before(stream)), RANGE)  # one row a range
    last = F.coalesce("_last", F.when(F.col("_before.key") == F.col("_key"), F.col("_before.version")))
    valid = F.col("_last.until").isNull() | (F.col("_at") < F.col("_last.until"))
    found = F.coalesce(F.when(valid, F.col("_last.found")), F.lit(UNKNOWN))
    return told.withColumn("_last", last).select("_fact.*", found.alias(surrogate))


def as_of_lookup(fact: DataFrame, dim: DataFrame, key: str, at: str, surrogate: str, few: int = FEW) -> DataFrame:
    """The same for a dimension whose keys have few versions: facts move once, to the versions of their key.

    The versions of a key are one array, in order; a fact takes the last one that starts at its time or before. Arrays are
    bounded by ``few``: where the dimension holds a key with more versions, the ranges of :func:`as_of_join` do the work. The
    join is on raw keys, so Spark can split a hot key's facts.
    """
    known = dim.where(F.col(key).isNotNull() & F.col("effective_from").isNotNull())
    most = known.groupBy(key).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0]  # one row
    if (most or 0) > few:
        return as_of_join(fact, dim, key, at, surrogate)
    version = F.struct(F.col("effective_from").alias("since"), F.xxhash64(surrogate).alias("salt"), F.col("effective_to").alias("until"), F.col(surrogate).alias("found"))
    spread = F.pmod(F.hash(key), F.lit(1))  # see combine.distinct_keys
    chains = known.groupBy(F.col(key).alias("_key"), spread.alias("_spread")).agg(F.array_sort(F.collect_list(version)).alias("_chain")).drop("_spread")
    started = F.filter("_chain", lambda v: v["since"] <= F.col(at))
    told = fact.join(chains, F.col(key) == F.col("_key"), "left").withColumn("_last", F.try_element_at(started, F.lit(-1)))
    valid = F.col("_last.until").isNull() | (F.col(at) < F.col("_last.until"))
    found = F.coalesce(F.when(valid, F.col("_last.found")), F.lit(UNKNOWN))
    return told.select(*fact.columns, found.alias(surrogate))


def _salt(fact: DataFrame) -> Column:
    """Tells facts of one key and time apart, the same for a row however often its task runs."""
    hashable = [f.name for f in fact.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*hashable)


def _versions_before(stream: Ranges) -> DataFrame:
    """For each range, the last version before it with its key."""
    started = F.when(F.col("_version").isNotNull(), F.struct("_key", "_at", "_salt"))
    last = F.max_by(F.struct(F.col("_key").alias("key"), F.col("_version").alias("version")), started)
    ends = stream.rows.groupBy(RANGE).agg(last.alias("_last"))
    earlier = in_order().rowsBetween(Window.unboundedPreceding, -1)
    return ends.select(RANGE, F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
