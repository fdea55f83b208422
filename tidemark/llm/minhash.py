"""MinHash near-dedup with an LSH forest (operator 5).

1. Texts become sets of five-word shingles; a set becomes 256 minima. Documents with the same set are one class, of
   which one goes on, so exact copies never meet as pairs.
2. A region is all classes that share the ``SHARED`` leading minima of a tree. Regions are counted by their hash first; a
   class goes on only in the trees where its region holds another class, so most rows never enter an order. Before every
   join on classes or regions, rows are marked by a broadcast table of bits, so signatures and sets that cannot match stay.
3. Sixteen signature orders: each tree sorts its rows by eight minima of its own. Neighbours within ``WINDOW`` places
   that share their region are first candidates. A sketch discards those far below the threshold; of the others each
   range offers a spanning forest, whose links are confirmed on the full sets. This only saves work: what a window or a
   range border leaves out is found by the next step.
4. In every region with more than one component so far, all pairs between different components are compared by sketch,
   in regions of up to ``SMALL`` rows inside the sorted order, in larger ones block by block. What the sketch leaves is
   confirmed on the full sets, which only rows with a candidate receive. Then the graph of the components alone is solved.

A pair at similarity 0.75 shares two leading minima in a tree with probability 0.56, so all sixteen miss it once in about
500,000. The sketch floor is the same in regions of every size and lies 7 standard errors below the threshold. The number
of partitions and the size of a crowd change no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_small_batches, marked, stored
from tidemark.llm.components import components
from tidemark.llm.words import U64, _random, mixed, shingle_sets

TREES, LEVELS, SHARED, WINDOW = 16, 8, 2, 32
MINIMA = 256
#: Links have 100 * intersection >= 75 * union. A sketch estimate below FLOOR is 3.5 standard errors under that.
PERCENT, FLOOR = 75, 0.65
#: A region of more rows is compared in blocks. The sketch floor in all regions is 7 standard errors below the threshold.
SMALL, LOW_FLOOR = 128, 0.55
#: Rows and shingles of a block, and rows of a range at least.
BLOCK, BLOCK_SHINGLES, RANGE = 1024, 1 << 21, 4096
BYTES = 8 << 20

_MULTIPLY = _random(11, MINIMA, np.uint32) | np.uint32(1)
_ADD = _random(12, MINIMA, np.uint32)
_BLOCK_COLUMNS = ["tree", "region", "class", "root", "own", "block", "with_top", "i", "j"]
_BLOCK_TYPES = "tree int, region binary, class binary, root binary, own boolean, block int, with_top boolean, i int, j int"
_EQUAL_HALVES = np.array([(x & 15 == 0) + (x >> 4 == 0) for x in range(256)], np.uint8)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in runs of about ``size`` bytes of text, one row at least."""
    for batch in batches:
        texts = batch.column(column)
        lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()))
        upto, first = np.cumsum(lengths), 0
        while first < len(lengths):
            done = int(upto[first - 1]) if first else 0
            end = max(first + 1, int(np.searchsorted(upto, done + size, "right")))
            yield batch.slice(first, end - first)
            first = end


def minima(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> U64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        return np.minimum.reduce([(x[k : k + 256, None] * _MULTIPLY + _ADD).min(axis=0) for k in range(0, len(x), 256)])


def class_key(shingles: np.ndarray) -> bytes:
    """128 bits of the whole set."""
    with np.errstate(over="ignore"):
        return np.array([mixed(shingles).sum(dtype=U64), mixed(shingles ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64)], ">u8").tobytes()


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, class, n_shingles, orders, sketch`` of every document; the last two are empty without shingles."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys, counts, orders, sketches = [], [], [], []
            for shingles in shingle_sets(batch.column("text")):
                counts.append(len(shingles))
                keys.append(class_key(shingles))
                if not len(shingles):
                    orders.append(b"")
                    sketches.append(b"")
                    continue
                low = minima(shingles)
                orders.append(low[: TREES * LEVELS].astype(">u2").tobytes())
                half = (low & np.uint32(15)).astype(np.uint8)
                sketches.append((half[::2] << 4 | half[1::2]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(orders, pa.binary()), pa.array(sketches, pa.binary())],
                names=["doc_id", "class", "n_shingles", "orders", "sketch"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_small_batches(docs).select("doc_id", "text").mapInArrow(sign, f"doc_id {kind}, class binary, n_shingles bigint, orders binary, sketch binary")


def _fixed(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    """The equally long values of a binary column as rows of numbers."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype).reshape(len(column), width)


class _Order:
    """A window over the rows of one sorted partition."""

    def __init__(self, window: int, floor: float):
        self.rows, self.window, self.floor = None, window, floor

    def candidates(self, batch: pa.RecordBatch):
        """Columns of the rows in view and the candidate pairs (i, j, estimate) whose later row is new."""
        new = {
            "tree": np.asarray(batch.column("tree")).astype(np.int64)[:, None],
            "levels": _fixed(batch.column("levels"), ">u2", LEVELS),
            "class": _fixed(batch.column("class"), "V16", 1),
            "n": np.asarray(batch.column("n_shingles")).astype(np.int64)[:, None],
            "sketch": _fixed(batch.column("sketch"), np.uint8, MINIMA // 2),
            "root": _fixed(batch.column("root"), "V16", 1),
        }
        old = 0 if self.rows is None else len(self.rows["tree"])
        rows = new if not old else {k: np.concatenate([self.rows[k], v]) for k, v in new.items()}
        self.rows = {k: v[-self.window :] for k, v in rows.items()}
        same = (rows["levels"][1:] == rows["levels"][:-1]) & (rows["tree"][1:] == rows["tree"][:-1])
        common = np.cumprod(same, axis=1).sum(axis=1)
        first, later, close = [], [], []
        reach = common
        for d in range(1, self.window + 1):
            if d > 1:
                reach = np.minimum(reach[:-1], common[d - 1 :])
            i = np.flatnonzero(reach >= SHARED)
            if not len(i):
                break
            i = i[i + d >= old]
            n, m = rows["n"][i, 0], rows["n"][i + d, 0]
            i = i[100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)]
            equal = _EQUAL_HALVES[rows["sketch"][i] ^ rows["sketch"][i + d]].sum(axis=1, dtype=np.int64) / MINIMA
            estimate = (equal - 1 / 16) * 16 / 15
            keep = estimate >= self.floor
            first.append(i[keep])
            later.append(i[keep] + d)
            close.append(estimate[keep])
        empty = [np.zeros(0, np.int64)]
        return rows, np.concatenate(first or empty), np.concatenate(later or empty), np.concatenate(close or [np.zeros(0)])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the candidates in view, closest first, those that join rows which no closer ones have joined."""
    order = _Order(WINDOW, FLOOR)
    for batch in batches:
        if not batch.num_rows:
            continue
        rows, i, j, close = order.candidates(batch)
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := above.setdefault(x, x)) != x:  # noqa: B023
                above[x] = x = above[up]  # noqa: B023
            return x

        a, b = [], []
        for k in np.argsort(-close, kind="stable").tolist():
            x, y = top(int(i[k])), top(int(j[k]))
            if x != y:
                above[x] = y
                ends = sorted((rows["class"][i[k], 0].tobytes(), rows["class"][j[k], 0].tobytes()))
                a.append(ends[0])
                b.append(ends[1])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All candidates between different components in whole regions of up to ``SMALL`` rows, as a list of partners per row."""
    order = _Order(SMALL, LOW_FLOOR)
    for batch in batches:
        if not batch.num_rows:
            continue
        rows, i, j, _ = order.candidates(batch)
        cross = np.flatnonzero(rows["root"][i, 0] != rows["root"][j, 0])
        partners: dict[bytes, list[bytes]] = {}
        for k in cross.tolist():
            a, b = sorted((rows["class"][i[k], 0].tobytes(), rows["class"][j[k], 0].tobytes()))
            partners.setdefault(a, []).append(b)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(partners), pa.binary()), pa.array(list(partners.values()), pa.list_(pa.binary()))], names=["a", "others"]
        )


def _classes(rows: DataFrame, lowest: DataFrame) -> DataFrame:
    """One signed row of each class that has shingles, with ``root``, the class itself. Only rows of classes with copies move."""
    repeated = stored(lowest.filter("copies > 1").select("class"), "repeated-classes")
    rows = marked(rows.filter("n_shingles > 0"), "class", repeated)
    one = rows.where("_marked").drop("_marked").dropDuplicates(["class"])
    return rows.where("NOT _marked").drop("_marked").unionByName(one).withColumn("root", F.col("class"))


def _crowded(classes: DataFrame) -> DataFrame:
    """The classes whose region holds another class in some tree, and ``trees``, the bits of those trees.

    Regions are told apart by a hash of 64 bits; two that share one only cost work. Single regions end here: of their rows
    only hashes are counted. Rows meet the shared regions, and classes their trees, after they were marked by bits, so few others move.
    """
    spot = [F.xxhash64(F.lit(t), F.substring("orders", 2 * LEVELS * t + 1, 2 * SHARED)) for t in range(TREES)]
    spots = classes.select("class", F.posexplode(F.array(*spot)).alias("tree", "spot"))
    shared = stored(spots.groupBy("spot").agg(F.count("*").alias("n")).filter("n > 1").select("spot"), "shared-regions")
    likely = marked(spots, "spot", shared).where("_marked").drop("_marked")
    masks = likely.join(shared, "spot", "left_semi").groupBy(F.col("class").alias("_class"))
    masks = stored(masks.agg(F.expr("bit_or(shiftleft(1, tree))").alias("trees")), "shared-trees")
    likely = marked(classes, "class", masks.select("_class")).where("_marked").drop("_marked")
    return likely.join(masks, F.col("class") == F.col("_class")).drop("_class")


def _regions(classes: DataFrame) -> DataFrame:
    """Every class in its shared trees with its minima and its region there; needs ``root`` beside the signature."""
    shared = F.expr(f"filter(sequence(0, {TREES - 1}), t -> getbit(trees, t) = 1)")
    trees = classes.select(F.explode(shared).alias("tree"), "orders", "class", "n_shingles", "sketch", "root")
    levels = F.substring("orders", F.col("tree") * (2 * LEVELS) + 1, F.lit(2 * LEVELS))
    rows = trees.select("tree", levels.alias("levels"), "class", "n_shingles", "sketch", "root")
    return rows.withColumn("region", F.substring("levels", 1, 2 * SHARED))


def _orders(classes: DataFrame) -> DataFrame:
    """Every class in its shared trees, sorted within ranges of the tree's order."""
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = classes.agg(F.sum(F.bit_count("trees"))).first()[0] or 0
    parts = max(1, min(parts, rows // RANGE))
    return _regions(classes).drop("region").repartitionByRange(parts, "tree", "levels", "class").sortWithinPartitions("tree", "levels", "class")


def _open_regions(classes: DataFrame) -> DataFrame:
    """Regions with more than one component: their rows, the component ``top`` with most rows, and the blocks it and the
    other rows are cut into."""
    per_root = _regions(classes).groupBy("tree", "region", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("words"))
    most = F.max(F.struct("n", "words", "root")).alias("most")
    found = per_root.groupBy(F.col("tree").alias("_tree"), F.col("region").alias("_region")).agg(
        F.sum("n").alias("n"), F.sum("words").alias("words"), F.count("*").alias("roots"), most
    )

    def blocks(n: F.Column, words: F.Column) -> F.Column:
        return F.greatest(F.ceil(n / BLOCK), F.ceil(words / BLOCK_SHINGLES)).cast("int")

    return found.filter("roots > 1").select(
        "_tree", "_region", F.col("n").alias("rows"), F.col("most.root").alias("top"),
        blocks(F.col("most.n"), F.col("most.words")).alias("top_blocks"),
        blocks(F.col("n") - F.col("most.n"), F.col("words") - F.col("most.words")).alias("blocks"),
    )


def _inside(classes: DataFrame, regions: DataFrame) -> DataFrame:
    """The rows of the given regions; rows of others are left where they are but for those their bits cannot tell."""
    rows = _regions(classes).withColumn("_spot", F.xxhash64("tree", "region"))
    likely = marked(rows, "_spot", regions.select(F.xxhash64("_tree", "_region"))).where("_marked").drop("_marked", "_spot")
    return likely.join(regions, (F.col("tree") == F.col("_tree")) & (F.col("region") == F.col("_region")))


def _blocks(classes: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows of large regions, once for each pair of blocks they are compared in. Blocks of the largest component are
    compared with the others only."""
    own = F.col("root") == F.col("top")
    block = F.pmod(F.xxhash64("class"), F.when(own, F.col("top_blocks")).otherwise(F.col("blocks"))).cast("int")
    kept = ["tree", "region", "class", "root", "n_shingles", "sketch"]
    rows = _inside(classes, regions).select(*kept, own.alias("own"), block.alias("block"), "top_blocks", "blocks")

    def pair(top: bool, i: F.Column, j: F.Column) -> F.Column:
        return F.struct(F.lit(top).alias("with_top"), i.alias("i"), j.alias("j"))

    mine = F.col("block")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.when(F.col("own"), pair(True, k, mine)).otherwise(pair(False, F.least(k, mine), F.greatest(k, mine))),
    )
    tops = F.transform(F.sequence(F.lit(0), F.col("top_blocks") - 1), lambda k: pair(True, mine, k))
    pairs = F.when(F.col("own"), others).otherwise(F.concat(others, tops))
    return rows.select(*kept, "own", "block", F.explode(pairs).alias("pair")).select(*kept, "own", "block", "pair.*")


def _sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The places of the rows of both blocks of a pair."""
    own, block = np.asarray(rows.column("own")), np.asarray(rows.column("block"))
    with_top, i, j = (rows.column(c)[0].as_py() for c in ("with_top", "i", "j"))
    return np.flatnonzero(~own & (block == i)), np.flatnonzero(own if with_top else block == j)


def _component_numbers(rows: pa.Table) -> np.ndarray:
    roots = rows.column("root").to_pylist()
    number = {r: k for k, r in enumerate(dict.fromkeys(roots))}
    return np.array([number[r] for r in roots])


def _sketched(rows: pa.Table) -> pa.Table:
    """Of the rows of two blocks, those with a candidate of another component on the other side."""
    rows = rows.combine_chunks()
    left, right = _sides(rows)
    keep = np.zeros(len(rows), bool)
    if len(left) and len(right):
        root, n = _component_numbers(rows), np.asarray(rows.column("n_shingles")).astype(np.int64)
        sketch = _fixed(rows.column("sketch"), np.uint8, MINIMA // 2)
        halves = np.concatenate([sketch >> 4, sketch & 15], axis=1)

        def marks(some: np.ndarray) -> np.ndarray:
            found = np.zeros((len(some), MINIMA, 16), np.float32)
            np.put_along_axis(found, halves[some][:, :, None].astype(np.int64), 1, axis=2)
            return found.reshape(len(some), -1)

        for k in range(0, len(left), BLOCK):
            for m in range(0, len(right), BLOCK):
                one, two = left[k : k + BLOCK], right[m : m + BLOCK]
                estimate = (marks(one) @ marks(two).T / MINIMA - 1 / 16) * 16 / 15
                near = (estimate >= LOW_FLOOR) & (root[one][:, None] != root[two][None])
                near &= 100 * np.minimum(n[one][:, None], n[two][None]) >= PERCENT * np.maximum(n[one][:, None], n[two][None])
                keep[one[near.any(axis=1)]] = True
                keep[two[near.any(axis=0)]] = True
    return rows.select(_BLOCK_COLUMNS).filter(pa.array(keep))


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The size of each set's intersection with each of the others. Shingles of few pairs are counted pair by pair, the
    others by products of 0-1 matrices."""
    counts = np.zeros((len(left), len(right)), np.int64)
    one, two = np.concatenate(left), np.concatenate(right)
    words = np.intersect1d(one, two)
    if not len(words):
        return counts

    def placed(all_: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(words, all_), len(words) - 1)
        held = np.flatnonzero(words[at] == all_)
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[held]
        order = np.argsort(at[held], kind="stable")
        at = at[held][order]
        return at, row[order], np.searchsorted(at, np.arange(len(words) + 1))

    (at, row, first), (at2, row2, first2) = placed(one, left), placed(two, right)
    n, n2 = np.diff(first), np.diff(first2)
    few = n * n2 <= 16
    rare = np.flatnonzero(few[at])
    times = n2[at[rare]]
    step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    pairs = np.repeat(row[rare], times) * len(right) + row2[np.repeat(first2[at[rare]], times) + step]
    counts += np.bincount(pairs, minlength=counts.size).reshape(counts.shape)
    many = np.flatnonzero(~few)
    for k in range(0, len(many), 2048):
        some = many[k : k + 2048]
        where = np.full(len(words), -1)
        where[some] = np.arange(len(some))
        sides = []
        for a, r, m in ((at, row, len(left)), (at2, row2, len(right))):
            side = np.zeros((m, len(some)), np.float32)
            in_side = where[a] >= 0
            side[r[in_side], where[a[in_side]]] = 1
            sides.append(side)
        counts += (sides[0] @ sides[1].T).astype(np.int64)  # at most 2,048, exact
    return counts


def _linked(rows: pa.Table) -> pa.Table:
    """Of the links between two blocks, those that join components not joined yet."""
    rows = rows.combine_chunks()
    left, right = _sides(rows)
    a, b = [], []
    if len(left) and len(right):
        keys, root = rows.column("class").to_pylist(), _component_numbers(rows)
        sets = [np.frombuffer(x.as_buffer(), U64) for x in rows.column("shingles")]
        sizes = np.array([len(x) for x in sets], np.int64)
        shared = shared_counts([sets[k] for k in left], [sets[k] for k in right])
        holds = 100 * shared >= PERCENT * (sizes[left][:, None] + sizes[right][None] - shared)
        holds &= root[left][:, None] != root[right][None]
        above = list(range(root.max() + 1))

        def top(x: int) -> int:
            while above[x] != x:
                above[x] = x = above[above[x]]
            return x

        for x, y in np.argwhere(holds).tolist():
            x, y = int(left[x]), int(right[y])
            p, q = top(int(root[x])), top(int(root[y]))
            if p != q:
                above[p] = q
                ends = sorted((keys[x], keys[y]))
                a.append(ends[0])
                b.append(ends[1])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _sets_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``class`` and its whole shingle set for the given classes, from the text of the document that stands for each.

    The wanted ids are written alone. Texts are marked by their bits before they meet the ids themselves, so few others move.
    """
    wanted = stored(classes.select(F.col("doc_id").alias("_stands"), F.col("class").alias("_class")), "wanted")
    likely = marked(docs.select("doc_id", "text"), "doc_id", wanted.select("_stands")).where("_marked").drop("_marked")
    texts = likely.join(wanted, F.col("doc_id").eqNullSafe(F.col("_stands"))).select("_class", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys, sets = [], []
            for key, shingles in zip(batch.column("_class").to_pylist(), shingle_sets(batch.column("text")), strict=True):
                if class_key(shingles) == key:  # a repeated id may carry another text
                    keys.append(key)
                    sets.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], names=["class", "shingles"])

    return texts.mapInArrow(build, "class binary, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that hold on their full sets."""
    one = sets.select(F.col("class").alias("_a"), F.col("shingles").alias("left"))
    two = sets.select(F.col("class").alias("_b"), F.col("shingles").alias("right"))
    joined = pairs.join(one, F.col("a") == F.col("_a")).join(two, F.col("b") == F.col("_b")).select("a", "b", "left", "right")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            holds = []
            for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = np.concatenate([x, y])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                holds.append(100 * shared >= PERCENT * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(holds, pa.bool_()))

    return joined.mapInArrow(check, "a binary, b binary")


def _joined(labelled: DataFrame, found: DataFrame) -> DataFrame:
    """``node, root`` of every class after links between components (``found``, written): only the components' graph is solved."""
    nodes = labelled.select(F.col("class").alias("node"), "root")
    if found.isEmpty():
        return nodes
    ends = found
    for end in ("a", "b"):
        tops = nodes.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        ends = ends.join(tops, F.col(end) == F.col("_node")).withColumn(end, F.col("_root")).drop("_node", "_root")
    tops = stored(components(ends).select(F.col("node").alias("_node"), F.col("root").alias("_root")), "labels")
    return nodes.join(tops, F.col("root") == F.col("_node"), "left").select("node", F.coalesce("_root", "root").alias("root"))


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Needs ``doc_id`` and ``text``. Texts without words, empty and null ones have no shingles, are linked with nothing and
    stay. A component's id is its smallest ``doc_id``; rows with a null id take part in links but never give the id,
    and a component of such rows alone has a null id and stays. Rows that repeat a ``doc_id`` are equal texts or count
    as copies of that document. An empty table gives an empty result. No text is cut and no partner list is capped.
    """
    rows = stored(signed(docs), "signatures")
    lowest = stored(rows.groupBy("class").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies")), "lowest")
    classes = stored(_classes(rows, lowest), "classes")
    classes = stored(_crowded(classes), "crowded-classes")
    pairs = stored(_orders(classes).mapInArrow(_forest, "a binary, b binary").distinct(), "candidates")
    ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("end")).distinct(), "candidate-ends")
    sets = stored(_sets_of(docs, classes.join(ends, F.col("class") == F.col("end"), "left_semi")), "sets")
    links = stored(_confirmed(pairs, sets), "links")
    labels = stored(components(links), "labels")
    marks = marked(classes, "class", labels.select("node"))
    linked = marks.where("_marked").drop("root", "_marked").join(labels, F.col("class") == F.col("node"), "left").drop("node")
    linked = linked.withColumn("root", F.coalesce("root", "class"))
    labelled = stored(marks.where("NOT _marked").drop("_marked").unionByName(linked), "labelled-classes")
    regions = stored(_open_regions(labelled), "regions")
    small = _inside(labelled, regions.filter(F.col("rows") <= SMALL)).select("tree", "levels", "class", "n_shingles", "sketch", "root", "region")
    more = (
        small.repartition("tree", "region")
        .sortWithinPartitions("tree", "levels", "class")
        .drop("region")
        .mapInArrow(_crossing, "a binary, others array<binary>")
        .groupBy("a")
        .agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
        .select("a", F.explode("others").alias("b"))
        .join(pairs, ["a", "b"], "left_anti")
    )
    more = stored(more, "candidates")
    pair_of_blocks = ["tree", "region", "with_top", "i", "j"]
    blocks = _blocks(labelled, regions.filter(F.col("rows") > SMALL)).groupBy(*pair_of_blocks).applyInArrow(_sketched, _BLOCK_TYPES)
    blocks = stored(blocks, "blocks")
    in_pairs = stored(more.select(F.explode(F.array("a", "b")).alias("end")).distinct(), "candidate-ends")
    in_blocks = stored(blocks.select(F.col("class").alias("end")).distinct(), "candidate-ends")
    known = sets.select(F.col("class").alias("_known"))
    ends = stored(in_pairs.union(in_blocks).distinct().join(known, F.col("end") == F.col("_known"), "left_anti"), "candidate-ends")
    if not ends.isEmpty():
        added = _sets_of(docs, classes.join(ends, F.col("class") == F.col("end"), "left_semi"))
        sets = sets.unionByName(stored(added, "sets"))
    found = _confirmed(more, marked(sets, "class", in_pairs).where("_marked"))
    wanted = marked(sets, "class", in_blocks).where("_marked").select(F.col("class").alias("_class"), "shingles")
    compared = blocks.join(wanted, F.col("class") == F.col("_class")).drop("_class")
    compared = compared.groupBy(*pair_of_blocks).applyInArrow(_linked, "a binary, b binary")
    found = stored(found.unionByName(compared.distinct()), "links")
    labels = stored(_joined(labelled, found), "labels")
    labelled = lowest.join(labels, F.col("class") == F.col("node")).select("class", "root", "low")
    joint = labelled.groupBy(F.col("root").alias("of")).agg(F.min("low").alias("joint"))
    joint = labelled.join(joint, F.col("root") == F.col("of")).select(F.col("class").alias("_class"), "joint")
    known = stored(
        lowest.join(joint, F.col("class") == F.col("_class"), "left").select(F.col("class").alias("_class"), F.coalesce("joint", "low").alias("component_id")),
        "component-ids",
    )
    joined = rows.select("doc_id", "class", "n_shingles").join(known, F.col("class") == F.col("_class"), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each component stays; dropped ids are joined away. Only rows marked by their bits meet the ids themselves."""
    dropped = near_groups(docs).filter(~F.col("kept") & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("dropped_id"))
    dropped = stored(dropped, "dropped")
    rows = marked(docs, "doc_id", dropped)
    likely = rows.where("_marked").drop("_marked")
    stay = likely.join(dropped, likely["doc_id"] == dropped["dropped_id"], "left_anti")
    return rows.where("NOT _marked").drop("_marked").unionByName(stay)
