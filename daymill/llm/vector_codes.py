"""Vector codes: parts of vectors replaced by the nearest entry of a codebook, learned by dual-tree Lloyd.

Vectors lie in blocks. In a block, the parts of each position are put in the
order of a tree of halves, with box, sum and count of every node kept beside
them; this is done once. A round walks such a tree together with a small tree
of the codebook's entries. Bounds on the distance between the boxes of two
nodes prune what cannot be nearest, a node with one entry left adds its kept
sum as a whole, and the vectors of leaves with several entries left are
compared in whole numbers. Only sums leave the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.llm.shared import written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK_ROWS, LEAF_ROWS = 4096, 16
# Whole-number components within this keep every distance within 64 bits, up to 128 components.
LARGEST, MOST_COMPONENTS = 1 << 27, 128


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(values.astype(np.float64) * scale).astype(np.int64)


# Trees


@dataclass
class PartTree:
    """The parts of one position, in tree order.

    Level ``l`` has 2**l nodes; node ``i`` holds the rows from ``bounds[l][i]``
    to ``bounds[l][i + 1]``. ``low``, ``high`` and ``sums`` are by level.
    """

    rows: np.ndarray
    bounds: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]
    sums: list[np.ndarray]


def _levels(n: int, leaf: int = LEAF_ROWS) -> list[np.ndarray]:
    """Bounds of the nodes of each level: halves, until none has more than ``leaf`` rows."""
    bounds = [np.array([0, n])]
    while np.diff(bounds[-1]).max() > leaf:
        last = bounds[-1]
        bounds.append(np.r_[np.c_[last[:-1], (last[:-1] + last[1:]) // 2].ravel(), n])
    return bounds


def tree_order(rows: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    """The order that halves every node along its widest component."""
    order = np.arange(len(rows))
    for level in bounds[:-1]:
        now = rows[order]
        wide = (np.maximum.reduceat(now, level[:-1]) - np.minimum.reduceat(now, level[:-1])).argmax(axis=1)
        node = np.repeat(np.arange(len(level) - 1), np.diff(level))
        order = order[np.lexsort((now[np.arange(len(now)), wide[node]], node))]
    return order


def caches(rows: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    """``low``, ``high`` and ``sums`` of all nodes, one level after the other."""
    kinds = [[f.reduceat(rows, level[:-1]) for level in bounds] for f in (np.minimum, np.maximum, np.add)]
    return np.stack([np.concatenate(k) for k in kinds])


def part_tree(rows: np.ndarray, bounds: list[np.ndarray], kept: np.ndarray) -> PartTree:
    cuts = np.cumsum([len(level) - 1 for level in bounds])[:-1]
    return PartTree(rows, bounds, *(np.split(k, cuts) for k in kept))


@dataclass
class EntryTree:
    """A tree over entries: the first nodes are the entries themselves, the last is the root."""

    entries: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: np.ndarray


def entry_tree(entries: np.ndarray) -> EntryTree:
    low, high, children = [*entries], [*entries], [(-1, -1)] * len(entries)

    def build(some: np.ndarray) -> int:
        if len(some) == 1:
            return int(some[0])
        points = entries[some]
        wide = (points.max(axis=0) - points.min(axis=0)).argmax()
        some = some[points[:, wide].argsort(kind="stable")]
        pair = build(some[: len(some) // 2]), build(some[len(some) // 2 :])
        low.append(points.min(axis=0))
        high.append(points.max(axis=0))
        children.append(pair)
        return len(children) - 1

    build(np.arange(len(entries)))
    return EntryTree(entries, np.array(low), np.array(high), np.array(children))


# The walk of two trees


@dataclass
class Assigned:
    """Whole nodes, as (level, nodes, their entries), and single rows with theirs."""

    nodes: list[tuple[int, np.ndarray, np.ndarray]]
    rows: np.ndarray
    entries: np.ndarray


def _nearest_possible(tree: PartTree, level: int, nodes: np.ndarray, of: EntryTree, asked: np.ndarray) -> np.ndarray:
    """Which pairs of nodes may hold a row and its nearest entry; equals are never pruned."""
    low, high = tree.low[level][nodes], tree.high[level][nodes]
    apart = np.maximum(0, np.maximum(of.low[asked] - high, low - of.high[asked]))
    farthest = np.maximum(of.high[asked] - low, high - of.low[asked])
    least, most = (apart * apart).sum(axis=1), (farthest * farthest).sum(axis=1)
    reach = np.full(len(tree.low[level]), np.iinfo(np.int64).max)
    np.minimum.at(reach, nodes, most)
    return least <= reach[nodes]


def _not_beaten(tree: PartTree, level: int, nodes: np.ndarray, of: EntryTree, asked: np.ndarray) -> np.ndarray:
    """Of pairs of a node and an entry, those not farther than the entry nearest to the box's centre, anywhere in the box."""
    low, high = tree.low[level][nodes], tree.high[level][nodes]
    entry = of.entries[asked]
    away = low + high - 2 * entry
    order = np.lexsort(((away * away).sum(axis=1), nodes))
    first = order[np.r_[True, np.diff(nodes[order]) > 0]]
    rival = np.zeros(len(tree.low[level]), np.int64)
    rival[nodes[first]] = asked[first]
    best = of.entries[rival[nodes]]
    slope = 2 * (entry - best)
    # The greatest of (distance to best) - (distance to entry) over the box.
    most = (best * best - entry * entry + np.where(slope > 0, slope * high, slope * low)).sum(axis=1)
    return (most >= 0) | (asked == rival[nodes])


def assign(tree: PartTree, of: EntryTree) -> Assigned:
    """The nearest entry of every row, of equals the first."""
    n_entries, last = len(of.entries), len(tree.bounds) - 1
    nodes, asked = np.zeros(1, np.int64), np.array([len(of.children) - 1])
    whole = []
    for level in range(last + 1):
        if not len(nodes):
            break
        while True:
            keep = _nearest_possible(tree, level, nodes, of, asked)
            nodes, asked = nodes[keep], asked[keep]
            inner = asked >= n_entries
            if not inner.any():
                break
            nodes = np.r_[nodes[~inner], np.repeat(nodes[inner], 2)]
            asked = np.r_[asked[~inner], of.children[asked[inner]].ravel()]
            if level < last:  # one step down in both trees at a time
                keep = _nearest_possible(tree, level, nodes, of, asked)
                nodes, asked = nodes[keep], asked[keep]
                break
        if not (asked >= n_entries).any():
            keep = _not_beaten(tree, level, nodes, of, asked)
            nodes, asked = nodes[keep], asked[keep]
        left = np.bincount(nodes, minlength=len(tree.low[level]))
        sure = (left[nodes] == 1) & (asked < n_entries)
        if sure.any():
            whole.append((level, nodes[sure], asked[sure]))
            nodes, asked = nodes[~sure], asked[~sure]
        if level < last:
            nodes, asked = np.r_[2 * nodes, 2 * nodes + 1], np.r_[asked, asked]
    if not len(nodes):
        return Assigned(whole, np.empty(0, np.int64), np.empty(0, np.int64))
    possible = np.zeros((len(tree.low[last]), n_entries), bool)
    possible[nodes, asked] = True
    node = np.repeat(np.arange(len(tree.low[last])), np.diff(tree.bounds[last]))
    rows = np.flatnonzero(possible.any(axis=1)[node])
    apart = np.full((len(rows), n_entries), np.iinfo(np.int64).max)
    points, open_ = tree.rows[rows], possible[node[rows]]
    for entry in range(n_entries):
        some = open_[:, entry]
        difference = points[some] - of.entries[entry]
        apart[some, entry] = (difference * difference).sum(axis=1)
    return Assigned(whole, rows, apart.argmin(axis=1))


def totals(tree: PartTree, found: Assigned, n_entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and sums by entry; whole nodes add the sums kept for them."""
    counts, sums = np.zeros(n_entries, np.int64), np.zeros((n_entries, tree.rows.shape[1]), np.int64)
    for level, nodes, entries in found.nodes:
        np.add.at(counts, entries, np.diff(tree.bounds[level])[nodes])
        np.add.at(sums, entries, tree.sums[level][nodes])
    np.add.at(counts, found.entries, 1)
    np.add.at(sums, found.entries, tree.rows[found.rows])
    return counts, sums


def entry_of_rows(tree: PartTree, found: Assigned) -> np.ndarray:
    """The entry of each row, in tree order."""
    entries = np.zeros(len(tree.rows), np.int64)
    for level, nodes, chosen in found.nodes:
        start, stop = tree.bounds[level][nodes], tree.bounds[level][nodes + 1]
        lengths = stop - start
        at = np.repeat(start - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())
        entries[at] = np.repeat(chosen, lengths)
    entries[found.rows] = found.entries
    return entries


# Blocks


def usable(vectors: DataFrame, parts: int, scale: int) -> DataFrame:
    """Rows whose vector takes part: of the commonest usable length, without null or non-finite components."""
    limit = LARGEST / scale
    fits = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < limit))  # NaN is beyond any number
    kept = vectors.filter(F.col("vector").isNotNull() & fits)
    size = F.size("vector")
    lengths = kept.groupBy(size.alias("length")).count().filter(
        (F.col("length") > 0) & (F.col("length") <= MOST_COMPONENTS) & (F.col("length") % parts == 0)
    )
    commonest = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return kept.filter(size == (commonest.length if commonest else -1))


def _blocks(vectors: DataFrame, parts: int, scale: int) -> DataFrame:
    """Vectors in rows of ``BLOCK_ROWS``, each position in tree order with its caches."""
    label = vectors.schema["label"].dataType.simpleString()
    schema = f"vec_ids array<bigint>, labels array<{label}>, orders binary, rows binary, kept binary"

    def block(table: pa.Table) -> dict:
        values = table["vector"].combine_chunks()
        points = whole_numbers(values.flatten().to_numpy(zero_copy_only=False), scale).reshape(len(table), parts, -1)
        bounds = _levels(len(table))
        orders, rows, kept = [], [], []
        for position in range(parts):
            own = points[:, position]
            order = tree_order(own, bounds)
            orders.append(order.astype(np.int32))
            rows.append(own[order].astype(np.int32))
            kept.append(caches(own[order], bounds))
        return {
            "vec_ids": table["vec_id"].to_pylist(), "labels": table["label"].to_pylist(),
            "orders": np.stack(orders).tobytes(), "rows": np.stack(rows).tobytes(), "kept": np.stack(kept).tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kind = None, None

        def batch_of(table: pa.Table) -> pa.RecordBatch:
            types = [pa.list_(pa.int64()), pa.list_(kind), pa.binary(), pa.binary(), pa.binary()]
            found = block(table)
            return pa.RecordBatch.from_arrays(
                [pa.array([found[k]], t) for k, t in zip(found, types)], names=list(found)
            )

        for batch in batches:
            new = pa.Table.from_batches([batch])
            kind = new["label"].type
            held = new if held is None else pa.concat_tables([held, new])
            while len(held) >= BLOCK_ROWS:
                yield batch_of(held.slice(0, BLOCK_ROWS))
                held = held.slice(BLOCK_ROWS)
        if held is not None and len(held):
            yield batch_of(held)

    return vectors.select("vec_id", "label", "vector").mapInArrow(run, schema)


def _trees(batch: pa.RecordBatch, row: int, parts: int) -> Iterator[tuple[np.ndarray, PartTree]]:
    """Order and tree of each position of a block."""
    n = len(batch["vec_ids"][row])
    bounds = _levels(n)
    orders = np.frombuffer(batch["orders"][row].as_py(), np.int32).reshape(parts, n)
    rows = np.frombuffer(batch["rows"][row].as_py(), np.int32).reshape(parts, n, -1)
    nodes = sum(len(level) - 1 for level in bounds)
    kept = np.frombuffer(batch["kept"][row].as_py(), np.int64).reshape(parts, 3, nodes, rows.shape[2])
    for position in range(parts):
        yield orders[position], part_tree(rows[position].astype(np.int64), bounds, kept[position])


def _round(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Codebooks after one round: the mean of each entry's parts, rounded down; unused entries stay."""
    parts, n_entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [entry_tree(book) for book in codebooks]
        sums = np.zeros((parts, n_entries, width + 1), object)  # of any size
        for batch in batches:
            for row in range(len(batch)):
                for position, (_, tree) in enumerate(_trees(batch, row, parts)):
                    counts, added = totals(tree, assign(tree, trees[position]), n_entries)
                    sums[position] += np.c_[counts, added].astype(object)
        place = np.indices(sums.shape).reshape(3, -1)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(p, pa.int32()) for p in place), pa.array([str(x) for x in sums.ravel()], pa.string())],
            names=["part", "entry", "place", "total"],
        )

    shape = "part int, entry int, place int, total string"
    added = blocks.select("vec_ids", "orders", "rows", "kept").mapInArrow(run, shape)
    added = added.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    sums = np.zeros((parts, n_entries, width + 1), object)
    for r in added.collect():  # a number for each component of each entry
        sums[r.part, r.entry, r.place] = int(r.total)
    after = codebooks.copy()
    for part, entry in np.argwhere(sums[:, :, 0] > 0):
        count, *of = sums[part, entry]
        after[part, entry] = [s // count for s in of]
    return after


def train(blocks: DataFrame, first: np.ndarray, rounds: int) -> np.ndarray:
    """Codebooks ``part x entry x component`` after ``rounds`` rounds from ``first``."""
    for _ in range(rounds):
        first = _round(blocks, first)
    return first


def _codes(blocks: DataFrame, codebooks: np.ndarray, label: str) -> DataFrame:
    parts = len(codebooks)

    if not codebooks.size:
        nothing = F.lit(None)
        return blocks.select(F.explode(F.arrays_zip("vec_ids", "labels")).alias("x")).select(
            F.col("x.vec_ids").alias("vec_id"), F.col("x.labels").alias("label"),
            nothing.cast("string").alias("code"), nothing.cast("bigint").alias("error"),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [entry_tree(book) for book in codebooks]
        for batch in batches:
            for row in range(len(batch)):
                n = len(batch["vec_ids"][row])
                codes, error = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
                for position, (order, tree) in enumerate(_trees(batch, row, parts)):
                    entries = entry_of_rows(tree, assign(tree, trees[position]))
                    codes[order, position] = entries
                    away = tree.rows - codebooks[position][entries]
                    error[order] += (away * away).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["vec_ids"][row].values, batch["labels"][row].values,
                        pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error, pa.int64()),
                    ],
                    names=["vec_id", "label", "code", "error"],
                )

    schema = f"vec_id bigint, label {label}, code string, error bigint"
    return blocks.mapInArrow(run, schema)


def compress(
    vectors: DataFrame,
    *,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``label``, ``code`` and ``error`` of every vector, and the codebooks.

    Components become whole numbers ``floor(scale * x)``. Each of the ``parts``
    consecutive parts gets the number of its nearest codebook entry, two
    hexadecimal digits in ``code``; ``error`` is the sum of squared distances.
    Codebooks start as the parts of the vectors of smallest id (of equal ids,
    the smallest vectors), and have fewer entries if there are fewer vectors.

    Vectors that are null, empty or hold null or non-finite components take no
    part, nor do those of another length than the commonest that ``parts``
    divides, nor those with components of 2**27 or more as whole numbers, whose
    errors might not fit 64 bits. Rows without an id are coded but start no
    entry; if no row has an id, codes and errors are null. Null labels are kept; repeated
    rows are coded alike. A table without
    vectors gives no rows and codebooks without entries. Other columns are not
    looked at. This call runs a job for each round; what comes to the driver is
    the codebooks.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries are numbered with two hexadecimal digits")
    named = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector")
    )
    kept = usable(named, parts, scale)
    blocks = written(_blocks(kept, parts, scale), "vector-blocks")
    seeds = kept.filter("vec_id IS NOT NULL").orderBy("vec_id", "vector").limit(entries).select("vector").collect()
    codebooks = np.zeros((parts, 0, 0), np.int64)
    if seeds:
        points = whole_numbers(np.array([r.vector for r in seeds]), scale)
        codebooks = points.reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()
        codebooks = train(blocks, codebooks, rounds)
    return _codes(blocks, codebooks, vectors.schema[label].dataType.simpleString()), codebooks


def checksum(codebooks: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``, the errors added up over equal labels, nulls together.

    Sums are made where the rows lie, and one row for each label is joined. A
    sum beyond 64 bits is null.
    """
    codes = written(codes, "vector-codes")
    sums = codes.groupBy(F.col("label").alias("of_label")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error")
    )
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")


def decoded(codes: DataFrame, codebooks: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``codes`` with ``vector``, the entries that a code names, as numbers before scaling."""
    books = F.array(*(F.array(*(F.array(*(F.lit(x / scale) for x in entry.tolist())) for entry in book)) for book in codebooks))
    digits = F.transform(F.sequence(F.lit(0), F.lit(len(codebooks) - 1)), lambda p: F.conv(F.substring("code", 2 * p + 1, F.lit(2)), 16, 10).cast("int"))
    parts = F.zip_with(books, digits, lambda book, at: F.element_at(book, at + 1))
    return codes.withColumn("vector", F.flatten(parts))
