"""Personal data by fixed forms and by bootstrapped contexts (operator 8); SQL functions only.

One pass over the texts finds the four fixed kinds and all tokens that look like identifiers, with the words around them.
From there on only these hits move. All hits of fixed kinds that hold are the seeds, whatever signs they are made of. A
*pattern* is the pair of words before the word that a seed or token begins in; without two such words there is none.
Patterns and tokens form a graph that is scored in rounds: a pattern is worth the mean worth of the distinct tokens it
occurs with, a token the worth of its best trusted pattern. Tokens after trusted patterns are reported as kind ``id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored, text_or_empty

#: The forms of the contract, made possessive where that changes no match, so long runs cost linear time. Cards of fewer
#: than 14 digits are dropped by the contract and not looked for.
FORMS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", r"[0-9](?:[\x20-]?+[0-9]){13,}+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
FOUND = "id"
KINDS = tuple(k for k, _ in FORMS) + (FOUND,)
#: A token of six characters or more with a digit.
TOKEN = r"(?<![^\x20\x09-\x0D])(?=[^0-9\x20\x09-\x0D]*+[0-9])[^\x20\x09-\x0D]{6,}+"
CONTEXT = r"([^\x20\x09-\x0D]++)[\x20\x09-\x0D]++([^\x20\x09-\x0D]++)[\x20\x09-\x0D]++[^\x20\x09-\x0D]*+$"
#: Characters before a seed or token in which its two words are looked for, and so many earlier hits that hold them: each
#: has four characters at least.
CONTEXT_POINTS, EARLIER = 80, 20
#: Distinct seeds a pattern needs, the worth from which it is trusted, and rounds of scoring.
SUPPORT, TRUST, ROUNDS = 3, 0.7, 3


def _hits(text: Column, kind: int, form: str, present: Column) -> Column:
    """All matches in order, each with the length of the gap before it and the last characters of the gap."""
    gaps = F.split(text, form, -1)
    values = F.regexp_extract_all(text, F.lit(form), F.lit(0))

    def hit(value: Column, gap: Column) -> Column:
        before = F.substring(gap, -CONTEXT_POINTS, CONTEXT_POINTS)
        return F.struct(F.lit(kind).alias("kind"), F.char_length(gap).alias("gap"), value.alias("value"), before.alias("before"))

    found = F.filter(F.zip_with(values, gaps, hit), lambda x: x["value"].isNotNull())
    return F.when(present, F.transform(found, lambda x, i: x.withField("place", i))).otherwise(F.lit(None))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, x: Column) -> Column:
        return total + x

    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise((x.cast("int") * 2) % 10 + (x.cast("int") * 2 / 10).cast("int")),
    )
    return F.aggregate(F.filter(doubled, lambda x: x.isNotNull()), F.lit(0), add) % 10 == 0


def _holds() -> Column:
    """Whether a hit passes the further conditions of its kind."""
    digits = _digits(F.col("value"))
    parts = F.transform(F.split("value", r"\."), lambda x: F.ltrim(x, F.lit("0")))
    small = F.forall(parts, lambda x: (F.char_length(x) <= 3) & (F.coalesce(x.try_cast("int"), F.lit(0)) <= 255))
    n = F.char_length(digits)
    return (
        F.when(F.col("kind") == 1, small)
        .when(F.col("kind") == 2, n.between(14, 19) & F.when(n <= 19, _luhn(digits)).otherwise(False))
        .when(F.col("kind") == 3, n.between(10, 15))
        .otherwise(True)
    )


def hits(docs: DataFrame) -> DataFrame:
    """``row, doc_id, hits`` of every document; ``hits`` is null without any."""
    text = F.col("_text")
    forms = [form for _, form in FORMS]
    present = [text.contains("@"), F.regexp_like(text, F.lit(forms[1])), F.regexp_like(text, F.lit(forms[2])), text.contains("+")]
    found = [_hits(text, k, form, p) for k, (form, p) in enumerate(zip(forms, present, strict=True))]
    found.append(_hits(text, len(FORMS), TOKEN, F.regexp_like(text, F.lit("[0-9]"))))
    none = F.array().cast(_HITS)
    rows = docs.select("doc_id", text_or_empty().alias("_text")).select("doc_id", *(h.alias(f"h{k}") for k, h in enumerate(found)))
    all_hits = F.concat(*(F.coalesce(F.col(f"h{k}").cast(_HITS), none) for k in range(len(found))))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.when(F.size(all_hits) > 0, all_hits).alias("hits"))


_HITS = "array<struct<kind:int,gap:int,value:string,before:string,place:int>>"


def spans(rows: DataFrame) -> DataFrame:
    """``row, kind, start, end, value, before`` of all hits that hold, in code points, and ``seed``: whether they are
    or overlap a hit of a fixed kind. ``before`` are the two words before, or empty."""
    each = rows.filter("hits is not null").select("row", F.explode("hits").alias("h")).select("row", "h.*")
    length = F.char_length("value")
    upto = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + length).over(upto)
    earlier = F.collect_list(F.concat("before", F.substring("value", -CONTEXT_POINTS, CONTEXT_POINTS)))
    earlier = earlier.over(Window.partitionBy("row", "kind").orderBy("place").rowsBetween(-EARLIER, -1))
    near = F.substring(F.concat(F.array_join(earlier, ""), F.col("before")), -CONTEXT_POINTS, CONTEXT_POINTS)
    each = each.withColumn("near", near).withColumn("end", end).withColumn("start", F.col("end") - length).filter(_holds())
    fixed = F.col("kind") < len(FORMS)
    order = Window.partitionBy("row").orderBy("start", F.desc("kind"))
    behind = F.max(F.when(fixed, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(fixed, F.col("start"))).over(order.rowsBetween(0, Window.unboundedFollowing))
    meets = F.coalesce(behind > F.col("start"), F.lit(False)) | F.coalesce(ahead < F.col("end"), F.lit(False))
    words = [F.regexp_extract("near", CONTEXT, k) for k in (1, 2)]
    before = F.when(words[0] != "", F.lower(F.concat_ws(" ", *words))).otherwise("")
    return each.select("row", "kind", "start", "end", "value", before.alias("before"), (fixed | meets).alias("seed"))


def trusted_patterns(tokens: DataFrame, support: int = SUPPORT, trust: float = TRUST, rounds: int = ROUNDS) -> DataFrame:
    """``pattern, worth`` from tokens (``value, before, seed``): the mutual scoring of patterns and tokens.

    A pattern's worth is the mean worth of its distinct tokens; it is trusted with ``support`` worth of tokens and a mean
    of ``trust``. Seeds are worth one; other tokens as much as their best trusted pattern, so a token found after one
    pattern speaks for others in the next round.
    """
    edges = tokens.filter("before <> ''").groupBy(F.col("before").alias("pattern"), F.lower("value").alias("token"))
    edges = stored(edges.agg(F.max(F.col("seed").cast("double")).alias("seed")), "pattern-edges")
    seeds = edges.groupBy("token").agg(F.max("seed").alias("worth"))
    worth = stored(seeds.filter("worth > 0").select(F.col("token").alias("_token"), "worth"), "token-worth")
    trusted = None
    for _ in range(rounds):
        joined = edges.join(worth, F.col("token") == F.col("_token"), "left").select("pattern", F.coalesce("worth", F.lit(0.0)).alias("worth"))
        scored = joined.groupBy("pattern").agg(F.sum("worth").alias("total"), F.avg("worth").alias("worth"))
        trusted = stored(scored.filter((F.col("total") >= support) & (F.col("worth") >= trust)).select(F.col("pattern").alias("_pattern"), F.col("worth").alias("_worth")), "patterns")
        best = edges.join(trusted, F.col("pattern") == F.col("_pattern")).groupBy("token").agg(F.max(F.greatest("seed", "_worth")).alias("worth"))
        known = worth.select(F.col("_token").alias("token"), "worth").unionByName(best).groupBy(F.col("token").alias("_token")).agg(F.max("worth").alias("worth"))
        worth = stored(known, "token-worth")
    return trusted.select(F.col("_pattern").alias("pattern"), F.col("_worth").alias("worth"))


def find(docs: DataFrame, support: int = SUPPORT, trust: float = TRUST, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    Needs ``doc_id`` and ``text``. The counts and the digest are those of the fixed kinds; ``spans`` adds kind ``id``,
    which overlaps none of them. Null and empty texts have no spans. Rows are told apart, so repeated rows give repeated
    results. An empty table gives an empty result. Whole texts are searched; a context is at most 80 characters.
    """
    rows = stored(hits(docs), "hits")
    marked = stored(spans(rows), "spans")
    tokens = marked.filter((F.col("kind") == len(FORMS)) & ~F.col("seed"))
    instances = marked.filter(F.col("kind") < len(FORMS)).unionByName(tokens)
    patterns = trusted_patterns(instances.select("value", "before", "seed"), support, trust, rounds).select(F.col("pattern").alias("_trusted"))
    found = tokens.join(patterns, F.col("before") == F.col("_trusted"), "left_semi")
    spot = F.struct("start", "kind", "end")
    every = marked.filter(F.col("kind") < len(FORMS)).unionByName(found)
    per_row = every.groupBy(F.col("row").alias("_row")).agg(F.sort_array(F.collect_list(spot)).alias("spots"))
    joined = rows.select("row", "doc_id").join(per_row, F.col("row") == F.col("_row"), "left")
    spots = F.coalesce("spots", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    joined = joined.select("doc_id", spots.alias("spots"))
    names = F.array(*map(F.lit, KINDS))

    def written(of: Column) -> Column:
        return F.array_join(F.transform(of, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("spots", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    base = F.filter("spots", lambda x: x["kind"] < len(FORMS))
    return joined.select("doc_id", *(count(k) for k in range(len(FORMS))), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spots")).alias("spans"))
