"""Approximate nearest neighbours by multiprobe p-stable hashing."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daymill.llm.shared import written

# Index rows a task holds at once, about, and rows of a bucket that stay together.
ROWS_A_PART, ROWS_A_PIECE = 25_000, 3_000
# Queries of the sample that an index is tried on, the share of them that may be left to be compared
# with all rows, and the hashes that a table keeps all the same.
TRIED, MOST_LEFT, LEAST_HASHES = 40, 0.05, 3
# Where queries meet all rows: the most rows and queries of a block, about, the fewest blocks of
# rows, and the distances held at once.
ROWS_A_BLOCK, QUERIES_A_BLOCK, LEAST_BLOCKS, BLOCK_CELLS = 50_000, 5_000, 24, 4_000_000


@dataclass(frozen=True)
class Index:
    """Random directions and offsets of all tables, and where neighbours are expected.

    A neighbour of q is expected about ``middle + pull * (q - middle)``, off by
    ``reach``; ``hits`` is the chance to aim for, ``most_probes`` the buckets
    tried per table.
    """

    directions: np.ndarray  # tables x hashes x dimensions
    offsets: np.ndarray  # tables x hashes
    width: float
    middle: np.ndarray
    pull: float
    reach: float
    hits: float
    most_probes: int

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """Projections in units of the width: vectors x tables x hashes."""
        tables, hashes, size = self.directions.shape
        flat = vectors @ self.directions.reshape(-1, size).T
        return (flat.reshape(len(vectors), tables, hashes) + self.offsets) / self.width

    def expected(self, vectors: np.ndarray) -> np.ndarray:
        """The places around which neighbours of these vectors are expected."""
        return self.places(self.middle + self.pull * (vectors - self.middle))


@dataclass(frozen=True)
class Parts:
    """How buckets are dealt to so many parts: crowded ones in pieces, by the ids of their rows."""

    count: int
    crowded: np.ndarray  # buckets in order
    pieces: np.ndarray  # of each of them

    def pieces_of(self, buckets: np.ndarray) -> np.ndarray:
        if not len(self.crowded):
            return np.ones(len(buckets), np.int64)
        at = np.minimum(np.searchsorted(self.crowded, buckets), len(self.crowded) - 1)
        return np.where(self.crowded[at] == buckets, self.pieces[at], 1)

    def of_rows(self, buckets: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return self._of(buckets, bucket_keys(ids[:, None]) % self.pieces_of(buckets))

    def of_visits(self, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The parts that hold these buckets, and the bucket of each."""
        pieces = self.pieces_of(buckets)
        visits = np.repeat(buckets, pieces)
        piece = np.arange(len(visits)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        return self._of(visits, piece), visits

    def _of(self, buckets: np.ndarray, piece: np.ndarray) -> np.ndarray:
        return (bucket_keys(np.stack([buckets, piece], axis=1)) % self.count).astype(np.int32)


def _normal(x: np.ndarray) -> np.ndarray:
    """The normal distribution function, to about 1e-7."""
    z = np.abs(x) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1 - poly * np.exp(-z * z)
    return 0.5 * (1 + np.sign(x) * erf)


def bucket_keys(cells: np.ndarray) -> np.ndarray:
    """A 64-bit key for each row of cells (... x hashes); the last axis is folded."""
    keys = np.zeros(cells.shape[:-1], np.uint64)
    with np.errstate(over="ignore"):
        for k in range(cells.shape[-1]):
            keys = (keys ^ cells[..., k].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def probes(place: np.ndarray, width: float, reach: float, most: int) -> Iterator[tuple[np.ndarray, float]]:
    """Buckets of one table by falling chance to hold a neighbour, with that chance.

    A neighbour's projection differs from the expected one by a normal error of
    ``reach``. Moves by up to three cells in each hash are sorted by their
    chance, and combinations of them are taken from a heap, best first.
    """
    cell = np.floor(place)
    moves = np.arange(-3, 4)
    low = (cell[:, None] + moves - place[:, None]) * width / reach
    chance = np.maximum(_normal(low + width / reach) - _normal(low), 1e-12)
    order = np.argsort(-chance, axis=1, kind="stable")
    logs = np.log(np.take_along_axis(chance, order, axis=1))
    moved = np.take_along_axis(np.broadcast_to(moves, chance.shape), order, axis=1)
    hashes = len(place)
    start = (0,) * hashes
    heap = [(-float(logs[:, 0].sum()), start, 0)]
    for _ in range(most):
        if not heap:
            return
        cost, ranks, last = heapq.heappop(heap)
        at = np.array(ranks, dtype=int)
        yield (cell + moved[np.arange(hashes), at]).astype(np.int64), math.exp(-cost)
        # Every combination is reached once: only the last moved hash and later ones move on.
        for k in range(last, hashes):
            if ranks[k] < 6:
                step = logs[k, ranks[k]] - logs[k, ranks[k] + 1]
                heapq.heappush(heap, (cost + float(step), ranks[:k] + (ranks[k] + 1,) + ranks[k + 1 :], k))


def fit(
    vectors: np.ndarray,
    n_rows: int,
    *,
    tables: int,
    bucket_rows: int,
    hits: float,
    most_probes: int,
    k: int,
    seed: int = 5,
) -> Index:
    """An index for ``n_rows`` vectors like the sample ``vectors``.

    The width follows the spread of projections; the number of hashes follows
    the rows so that a bucket holds about ``bucket_rows``; fewer rows than that
    are one bucket, and all of them are compared. Where neighbours are
    expected is taken from the nearest that the sample shows, their rank
    brought from the size of the whole to that of the sample. Where that many
    hashes need more probes than allowed for some queries of the sample, there
    are fewer hashes, and so larger buckets, until ``MOST_LEFT`` of them or less
    are left to be compared with all rows, whatever the number of rows.
    """
    size = vectors.shape[1] if len(vectors) else 1
    rng = np.random.default_rng(seed)
    middle = vectors.mean(axis=0) if len(vectors) else np.zeros(size)
    off = vectors - middle
    spread = (float(np.sqrt((off**2).sum(axis=1).mean())) if len(vectors) else 0.0) or 1.0
    hashes = round(math.log2(max(1.0, n_rows / bucket_rows)) / 1.25)
    width = 1.5 * spread
    pull, reach = 1.0, 0.5 * spread
    if len(vectors) > 2:
        asked = off[:: max(1, len(off) // 400)]
        squares = (asked**2).sum(1)[:, None] + (off**2).sum(1)[None] - 2 * asked @ off.T
        at = min(len(off) - 1, max(1, round(k * len(off) / max(n_rows, 1))))
        near = off[np.argsort(squares, axis=1, kind="stable")[:, at]]
        pull = float((near * asked).sum() / max((asked**2).sum(), 1e-12))
        reach = float(np.sqrt(((near - pull * asked) ** 2).sum(axis=1).mean())) or 1e-6 * spread
    index = Index(
        rng.standard_normal((tables, hashes, size)), rng.uniform(0, width, (tables, hashes)),
        width, middle, pull, reach, hits, most_probes,
    )
    tried = vectors[:: max(1, len(vectors) // TRIED)]

    def with_hashes(n: int) -> Index:
        return replace(index, directions=index.directions[:, :n], offsets=index.offsets[:, :n])

    def too_many(n: int) -> bool:
        left = sum(b is None for b in _probed_buckets(with_hashes(n), tried))
        return left > MOST_LEFT * len(tried)

    if hashes <= LEAST_HASHES or not too_many(hashes):
        return index
    fewest, most = LEAST_HASHES, hashes  # the answer is below ``most``
    while most - fewest > 1:
        middle_one = (fewest + most) // 2
        fewest, most = (fewest, middle_one) if too_many(middle_one) else (middle_one, most)
    return with_hashes(fewest)


def _usable(vector: Column) -> Column:
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, real) & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    queries: Column,
    *,
    k: int = 10,
    tables: int = 6,
    bucket_rows: int = 120,
    hits: float = 0.95,
    most_probes: int = 400,
    sample_rows: int = 4_000,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, the Euclidean distance.

    Queries are the rows for which ``queries`` holds; each gets its ``k``
    nearest of those found among all rows with another id, ties to the smaller
    id. Every row is hashed into every table. For a query the buckets of all
    tables are visited in the order of their estimated chance to hold a
    neighbour, until the chance to have missed one falls below ``1 - hits``.
    What they hold is compared exactly, in double precision. A query for which
    ``most_probes`` a table do not get there, or whose buckets hold fewer than
    ``k`` rows, is compared with all rows instead, in blocks of both. A bucket
    with many rows is cut into pieces, which lie in different parts.

    Null vectors and ids, zero vectors, and vectors with null or non-finite
    components take no part, nor do those of another length than most. Of rows
    with equal id the one with the least vector counts. Of rows with equal vectors only the ``k`` + 1
    smallest ids can be an answer, so the others are left out of the index
    before anything is hashed; that loses no answer and keeps a common vector
    from filling a bucket. The directions and the reach are fitted on
    ``sample_rows`` rows; every row is indexed. An empty table gives no rows.
    This call runs the jobs that fit the index.
    """
    sized = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    ).filter(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    single = sized.groupBy("vec_id").agg(
        F.min("vector").alias("vector"), F.max("asks").alias("asks")
    )
    rows = written(single.withColumn("size", F.size("vector")), "vectors")
    lengths = rows.groupBy("size").count().orderBy(F.desc("count"), "size").limit(1).collect()
    if not lengths:
        return _answers(rows.select(
            F.col("vec_id").alias("query_id"), "vec_id", F.lit(0.0).alias("score")
        ), k)
    size, n_rows = lengths[0]
    rows = rows.filter(F.col("size") == size).drop("size")
    same = Window.partitionBy("vector").orderBy("vec_id")
    stored = rows.withColumn("place", F.row_number().over(same)).filter(
        F.col("place") <= k + 1
    ).select("vec_id", "vector")
    sampled = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows)
    sample = np.array([r[0] for r in sampled.select("vector").collect()], dtype=np.float64)
    index = fit(
        sample, n_rows, tables=tables, bucket_rows=bucket_rows, hits=hits,
        most_probes=most_probes, k=k,
    )
    parts = _parts(stored, index, max(1, math.ceil(n_rows * tables / ROWS_A_PART)))
    asked = rows.filter("asks").select("vec_id", "vector")

    schema = "part int, bucket bigint, vec_id bigint, vector array<double>"

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                points = np.array(batch["vector"].tolist(), dtype=np.float64)
                yield _index_rows(index, parts, batch["vec_id"].to_numpy(), points, batch["vector"])

    def probed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                some = batch.iloc[at : at + 200]
                points = np.array(some["vector"].tolist(), dtype=np.float64)
                buckets = _probed_buckets(index, points)
                yield some[["vec_id", "vector"]].assign(reached=[b is not None for b in buckets], buckets=buckets)

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                yield _dealt_rows(parts, batch.iloc[at : at + 200])

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, kept = None, []
        for batch in batches:
            for number, rows in batch.groupby("part"):
                if number != part:
                    part, kept = number, []
                asks = rows["asks"] == 1
                if not asks.all():
                    kept.append(rows[~asks])
                if asks.any() and kept:
                    kept = [pd.concat(kept)]
                    yield _best_of_part(rows[asks], kept[0], k)

    tried = written(asked.mapInPandas(
        probed, "vec_id bigint, vector array<double>, reached boolean, buckets array<bigint>"
    ), "probes")
    reached = tried.filter("reached")
    if reached.isEmpty():
        return _answers(_compared_with_all(asked, stored, k, n_rows), k)
    visits = reached.select("vec_id", "vector", "buckets").mapInPandas(
        dealt, "part int, vec_id bigint, vector array<double>, buckets array<bigint>"
    ).withColumns({"bucket": F.lit(0).cast("bigint"), "asks": F.lit(1)})
    held = stored.mapInPandas(hashed, schema).withColumns(
        {"buckets": F.lit(None).cast("array<bigint>"), "asks": F.lit(0)}
    )
    # Rows of a part come first and are kept, queries pass by in batches, however many they are.
    meeting = held.unionByName(visits).repartition("part").sortWithinPartitions("part", "asks")
    found = written(_answers(meeting.mapInPandas(
        compared, "query_id bigint, vec_id bigint, score double"
    ), k), "found")
    # Counted over the answers themselves: a query without any has no row here.
    full = found.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = written(asked.join(full, "vec_id", "left_anti"), "short")
    if short.isEmpty():
        return found
    rest = _answers(_compared_with_all(short, stored, k, n_rows), k)
    whole = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti")
    return whole.select(rest.columns).unionByName(rest)


def _answers(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _table_keys(cells: np.ndarray) -> np.ndarray:
    """Keys of cells (vectors x tables x hashes) that also tell the tables apart."""
    tables = np.broadcast_to(np.arange(cells.shape[1])[None, :, None], (*cells.shape[:2], 1))
    return bucket_keys(np.concatenate([tables, cells], axis=2))


def _row_keys(index: Index, points: np.ndarray) -> np.ndarray:
    return _table_keys(np.floor(index.places(points)).astype(np.int64))


def _parts(stored: DataFrame, index: Index, count: int) -> Parts:
    """Parts for these rows; this counts the rows of each bucket."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                points = np.array(batch["vector"].tolist(), dtype=np.float64)
                yield pd.DataFrame({"bucket": _row_keys(index, points).reshape(-1)})

    sizes = stored.select("vector").mapInPandas(keyed, "bucket bigint").groupBy("bucket").count()
    crowded = sorted(sizes.filter(F.col("count") > ROWS_A_PIECE).collect())
    return Parts(
        count, np.array([b for b, _ in crowded], np.int64),
        np.array([math.ceil(n / ROWS_A_PIECE) for _, n in crowded], np.int64),
    )


def _index_rows(index: Index, parts: Parts, ids, points, vectors) -> pd.DataFrame:
    keys = _row_keys(index, points)
    tables = keys.shape[1]
    flat, owners = keys.reshape(-1), np.repeat(ids, tables)
    return pd.DataFrame({
        "part": parts.of_rows(flat, owners), "bucket": flat,
        "vec_id": owners, "vector": vectors.repeat(tables).array,
    })


def _probed_buckets(index: Index, points) -> list[np.ndarray | None]:
    """The buckets each query has to visit, or None if there are too few to reach ``hits``."""
    places = index.expected(points)
    found_of = []
    for i in range(len(points)):
        waiting, buckets, reached = [], [], False
        for t in range(places.shape[1]):
            found = probes(places[i, t], index.width, index.reach, index.most_probes)
            first = next(found, None)
            if first is not None:
                waiting.append((-first[1], t, first[0], found))
        heapq.heapify(waiting)
        # Chances add up within a table; tables miss independently of each other.
        inside = np.zeros(places.shape[1])
        while waiting and not reached:
            chance, t, cells, found = heapq.heappop(waiting)
            buckets.append(np.concatenate([[t], cells]))
            inside[t] -= chance
            reached = bool(np.prod(1 - np.minimum(inside, 1)) < 1 - index.hits)
            following = None if reached else next(found, None)
            if following is not None:
                heapq.heappush(waiting, (-following[1], t, following[0], found))
        found_of.append(bucket_keys(np.array(buckets)) if reached else None)
    return found_of


def _dealt_rows(parts: Parts, tried: pd.DataFrame) -> pd.DataFrame:
    """A row for each query and part that holds some of its buckets."""
    rows = []
    for vec_id, vector, buckets in zip(tried["vec_id"], tried["vector"], tried["buckets"]):
        to, visits = parts.of_visits(np.unique(buckets))
        rows += [(part, vec_id, vector, np.unique(visits[to == part])) for part in np.unique(to)]
    return pd.DataFrame(rows, columns=["part", "vec_id", "vector", "buckets"])


def _best_of_part(probe: pd.DataFrame, held: pd.DataFrame, k: int) -> pd.DataFrame:
    """The nearest that a part's buckets hold of each query that visits them."""
    empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    if not len(probe) or not len(held):
        return empty
    held = held.sort_values("bucket", kind="stable")
    keys, ids = held["bucket"].to_numpy(), held["vec_id"].to_numpy()
    points = np.array(held["vector"].tolist(), dtype=np.float64)
    out = []
    for query, vector, buckets in zip(probe["vec_id"], probe["vector"], probe["buckets"]):
        vector = np.array(vector, dtype=np.float64)
        starts, ends = np.searchsorted(keys, buckets), np.searchsorted(keys, buckets, "right")
        at = np.concatenate([np.arange(s, e) for s, e in zip(starts, ends)])
        at = at[ids[at] != query]
        if len(at):
            near, first = np.unique(ids[at], return_index=True)  # once, whatever the table
            scores = np.sqrt(((points[at[first]] - vector) ** 2).sum(axis=1))
            best = np.lexsort((near, scores))[:k]
            out.append(pd.DataFrame({"query_id": query, "vec_id": near[best], "score": scores[best]}))
    return pd.concat(out) if out else empty


def _compared_with_all(asked: DataFrame, stored: DataFrame, k: int, n_rows: int) -> DataFrame:
    """The ``k`` nearest of each query in each block of rows, every row compared.

    A block of queries and a block of rows meet in a task, whatever the rows
    hold: both are dealt by their ids.
    """
    blocks = max(LEAST_BLOCKS, math.ceil(n_rows / ROWS_A_BLOCK))
    chunks = max(1, math.ceil(asked.count() / QUERIES_A_BLOCK))
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("vec_id", "vector", upto(blocks).alias("block"), place(chunks).alias("chunk"))
    right = stored.select("vec_id", "vector", place(blocks).alias("block"), upto(chunks).alias("chunk"))

    def compared(queries: pa.Table, held: pa.Table) -> pa.Table:
        return _best_of_block(queries, held, k)

    return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(
        compared, "query_id bigint, vec_id bigint, score double"
    )


def _points(vectors: pa.ChunkedArray, rows: int) -> np.ndarray:
    return pc.list_flatten(vectors).to_numpy().reshape(rows, -1)


def _best_of_block(asked: pa.Table, held: pa.Table, k: int) -> pa.Table:
    """The nearest rows of a block for each query; a product of matrices tells which to measure.

    The product's error is far below the slack, so no row among the nearest is passed over.
    """
    out = []
    if len(asked) and len(held):
        ids, points = held["vec_id"].to_numpy(), _points(held["vector"], len(held))
        queries, vectors = asked["vec_id"].to_numpy(), _points(asked["vector"], len(asked))
        squares = (points**2).sum(axis=1)
        last = min(k, len(ids)) - 1
        step = max(1, BLOCK_CELLS // len(ids))
        for at in range(0, len(queries), step):
            some = vectors[at : at + step]
            own = (some**2).sum(axis=1)
            rough = own[:, None] + squares[None] - 2 * some @ points.T
            rough[queries[at : at + step, None] == ids[None]] = np.inf
            slack = 1e-9 * (own + squares.max())
            bound = np.partition(rough, last, axis=1)[:, last] + slack
            # What overflows is measured too.
            measured = (rough <= bound[:, None]) | ~np.isfinite(rough)
            for i, query in enumerate(queries[at : at + step]):
                rows = np.flatnonzero(measured[i] & (ids != query))
                scores = np.sqrt(((points[rows] - some[i]) ** 2).sum(axis=1))
                best = np.lexsort((ids[rows], scores))[:k]
                out.append((np.full(len(best), query), ids[rows[best]], scores[best]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]
    types = (pa.int64(), pa.int64(), pa.float64())
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, types)})
