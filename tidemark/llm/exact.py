"""Exact dedup with a heavy-hitter split (operator 10).

Texts are reduced to a digest once; only digests, lengths and ids move afterwards. A frequent-items sketch of the
Misra-Gries family names the digests that may be frequent. Their groups are counted exactly and reduced with map-side
aggregation, and the at most ``heads`` winners are broadcast, so rows of a frequent text never meet in one task. All
other digests are rare by the guarantee of the sketch and go through one ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import SPACE, stored, text_or_empty

#: Candidates broadcast at most, and counters a sketch holds: a text with more than rows / TRACKED copies is found.
HEADS, TRACKED = 1000, 8192


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``digest`` (SHA-256 of the text without white space) and ``points`` (code points of the text)."""
    text = text_or_empty()
    return docs.select(
        "doc_id",
        F.unhex(F.sha2(F.regexp_replace(text, SPACE + "+", ""), 256)).alias("digest"),
        F.char_length(text).alias("points"),
    )


def exact_groups(docs: DataFrame, heads: int = HEADS, tracked: int = TRACKED) -> DataFrame:
    """One row per document with the row that stays for its text.

    Needs the columns ``doc_id`` and ``text``; others are not read. Returns ``doc_id, keep_id, group_size, kept,
    text_sha256``. Null text counts as empty text, so all empty, blank and null texts are one group. Of a group the
    row with the most code points stays, then the smallest ``doc_id``; null ids come last. Rows that repeat a
    ``doc_id`` stand for the same document and share its decision. An empty table gives an empty result.
    """
    rows = stored(digests(docs), "digests")
    frequent = rows.select(F.expr(f"explode(approx_top_k(hex(digest), {heads}, {tracked}))").alias("head")).select(
        F.unhex("head.item").alias("head")
    )
    best = F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"))
    winners = (
        rows.join(F.broadcast(frequent), F.col("digest") == F.col("head"))
        .groupBy("head")
        .agg(F.min(best).alias("best"), F.count("*").alias("size"))
    )
    split = rows.join(F.broadcast(winners), F.col("digest") == F.col("head"), "left")
    rare = Window.partitionBy("digest")
    found = split.filter(F.col("head").isNotNull()).select("doc_id", "digest", "best", "size")
    rest = (
        split.filter(F.col("head").isNull())
        .select("doc_id", "digest", "points")
        .select("doc_id", "digest", F.min(best).over(rare).alias("best"), F.count("*").over(rare).alias("size"))
    )
    return found.unionByName(rest).select(
        "doc_id",
        F.col("best.id").alias("keep_id"),
        F.col("size").cast(T.LongType()).alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("best.id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay; dropped ids are joined away, so only ids and never texts are grouped."""
    dropped = exact_groups(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("dropped_id"))
    return docs.join(dropped, docs["doc_id"] == dropped["dropped_id"], "left_anti")
