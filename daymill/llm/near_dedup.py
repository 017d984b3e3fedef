"""Near duplicates by MinHash: candidates from banded buckets, links checked on whole sets.

A text's set is that of its runs of words, each run a 64-bit hash. One hash of
each run gives all minima: the hashes are dealt out to bins, a bin keeps its
smallest, and an empty bin borrows from the bin that a hash of its own number
leads to first (optimal densification). Bands of bins make bucket keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daymill.llm.shared import only_holder, whole_text, written

# At a similarity of 0.8 no band agrees in one of 10^7 pairs.
BANDS, BAND_BINS = 50, 6
# Rows without an id are numbered from here on.
NAMELESS = 1 << 62
# Words that a worker keeps hashes of, and the bytes of the longest.
MOST_WORDS, LONGEST_WORD = 250_000, 64
# Shingles of a block of documents, and numbers in a matrix of blocks, at about the most.
BLOCK_SHINGLES, BLOCK_CELLS = 150_000, 20_000_000


class _WordHashes(dict):
    """64-bit hashes of words, emptied when full; long words are not kept."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONGEST_WORD:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = value
        return value


_hashes = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; of all words if they are fewer.

    A-Z is lower-cased, and words end at the six white-space characters of
    ASCII, as ``bytes.lower`` and ``bytes.split`` have it.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    runs = max(1, len(found) - words + 1)
    value = np.full(runs, min(words, len(found)), np.uint64)
    for k in range(min(words, len(found))):
        value = _mix(value * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + runs])
    return np.unique(value)


@lru_cache(maxsize=4)
def _preferences(bins: int) -> np.ndarray:
    """For each bin, the place of every bin in its own random order; alike for all texts."""
    at = np.arange(bins, dtype=np.uint64)
    keys = _mix(at[:, None] * np.uint64(1 << 20) + at[None, :] + np.uint64(1))
    return keys.argsort(axis=1).argsort(axis=1).astype(np.int16)


def signature(found: np.ndarray, bins: int) -> np.ndarray:
    """The smallest hash of each bin, empty bins densified. ``found`` is not empty."""
    spread = np.sort(_mix(found * np.uint64(0xD6E8FEB86659FD93) + np.uint64(7)))
    at = ((spread >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    filled = at[first]
    minima = np.zeros(bins, np.uint64)
    minima[filled] = spread[first]
    if len(filled) < bins:
        empty = np.ones(bins, bool)
        empty[filled] = False
        chosen = _preferences(bins)[empty][:, filled].argmin(axis=1)
        minima[empty] = minima[filled[chosen]]
    return minima


def band_keys(minima: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band that also tells bands apart."""
    rows = minima.reshape(bands, -1)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows.shape[1]):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return keys.view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the sets share ``percent`` of their union, in whole numbers."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


SKETCH = "doc_id bigint, text_key bigint, n_shingles bigint, set_key binary, keys array<bigint>"


def sketch(docs: DataFrame, words: int, bands: int, band_bins: int) -> DataFrame:
    """A row per document: the size and a 128-bit key of its set, and its bucket keys."""
    bins = bands * band_bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_holder("near_dedup", _hashes.clear)
        for batch in batches:
            sizes, sets, keys = [], [], []
            for text in batch.column(2):
                found = shingles(text.as_py(), words)
                sizes.append(len(found))
                sets.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(band_keys(signature(found, bins), bands) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                    pa.array(sets, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_key", "n_shingles", "set_key", "keys"],
            )

    return docs.mapInArrow(run, SKETCH)


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Of pairs ``a``, ``b`` of ids in ``texts``, those whose whole sets are similar."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_holder("near_dedup", _hashes.clear)
        key, first = None, np.empty(0, np.uint64)
        for batch in batches:
            keep = []
            for a, text_a, text_b in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if a != key:
                    key, first = a, shingles(text_a.as_py(), words)
                keep.append(similar(first, shingles(text_b.as_py(), words), percent))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    return both.mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, of every node with a link.

    Each round, a node takes the smallest label among its own and its
    neighbours', and then the label of that label, so long paths shorten
    quickly. Rounds are written to the shared folder.
    """
    there, back = [F.col("a").alias("u"), F.col("b").alias("v")], [F.col("b"), F.col("a")]
    edges = written(
        links.filter("a != b").select(*there).union(links.filter("a != b").select(*back)).distinct(),
        "edges",
    )
    labels = written(
        edges.groupBy("u").agg(F.min("v").alias("least")).select(
            F.col("u").alias("node"), F.least("u", "least").alias("component")
        ), "labels",
    )
    while True:
        seen = labels.select(F.col("node").alias("v"), F.col("component").alias("seen"))
        near = edges.join(seen, "v").groupBy("u").agg(F.min("seen").alias("near"))
        best = labels.join(near, labels.node == near.u).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("to")
        )
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("jumped"))
        moved = written(
            best.join(jump, "to", "left").select(
                "node", "old", F.least("to", F.coalesce("jumped", "to")).alias("component")
            ), "labels",
        )
        labels = moved.select("node", "component")
        if moved.filter("old != component").isEmpty():
            return labels


def _linked(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components after more links."""
    if labels is not None:
        known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        links = links.select("a", "b").unionByName(known)
    return components(links)


def _across(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Pairs whose ends are not in one component yet."""
    if labels is None:
        return pairs
    for end in ("a", "b"):
        of = labels.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = pairs.join(of, end, "left")
    return pairs.filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))


def _with_component(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return buckets.withColumn("component", F.col("doc_id"))
    return buckets.join(labels, buckets.doc_id == labels.node, "left").select(
        *buckets.columns, F.coalesce("component", "doc_id").alias("component")
    )


def link_stars(
    buckets: DataFrame, texts: DataFrame, words: int, percent: int, labels: DataFrame | None
) -> DataFrame | None:
    """``labels`` with the links that the smallest id of each bucket has to its members.

    A bucket of n members is n - 1 pairs. Each member is first compared with
    the centre it shares most buckets with, then with its other centres, unless
    they are in one component by then.
    """
    centres = buckets.groupBy("bucket").agg(
        F.min(F.struct(F.col("doc_id").alias("a"), F.col("n").alias("n_a"))).alias("centre")
    ).select("bucket", "centre.*")
    fits = (F.least("n", "n_a") * 100 >= F.greatest("n", "n_a") * percent) & (
        F.col("a") != F.col("doc_id")
    )
    pairs = written(
        buckets.join(centres, "bucket").filter(fits).groupBy("a", F.col("doc_id").alias("b")).agg(
            F.count(F.lit(1)).alias("shared")
        ), "pairs",
    )
    likeliest = F.max(F.struct("shared", (-F.col("a")).alias("a"))).alias("best")
    first = pairs.groupBy("b").agg(likeliest).select((-F.col("best.a")).alias("a"), "b")
    for part in (first, pairs.join(first, ["a", "b"], "left_anti")):
        part = written(_across(part, labels).select("a", "b"), "compared")
        if not part.isEmpty():
            links = written(confirmed(part, texts, words, percent), "links")
            labels = labels if links.isEmpty() else _linked(labels, links)
    return labels


def _block_links(minors: list, members: list, percent: int) -> list[tuple[int, int]]:
    """Links between two lists of (id, component, set), one for each id and component linked."""
    known = np.unique(np.concatenate([m[2] for m in minors]))
    # Neither a slice of a side nor what two of them share has more cells than this.
    step = max(1, min(BLOCK_CELLS // max(1, len(known)), math.isqrt(BLOCK_CELLS)))
    links = {}
    for at in range(0, len(members), step):
        others = members[at : at + step]
        table, sizes = _table(others, known), np.array([len(m[2]) for m in others])
        for start in range(0, len(minors), step):
            some = minors[start : start + step]
            both = _table(some, known) @ table.T  # whole numbers far below 2^24, so exact
            own = np.array([len(m[2]) for m in some])[:, None]
            alike = 100 * both >= percent * (own + sizes[None, :] - both)
            for row, column in zip(*np.nonzero(alike)):
                (a, mine), (b, other) = some[row][:2], others[column][:2]
                if mine != other:
                    links[a, other] = (a, b)
    return list(links.values())


def _table(docs: list, known: np.ndarray) -> np.ndarray:
    """A row for each set: 1 for each of the known shingles that it has."""
    table = np.zeros((len(docs), len(known)), np.float32)
    for row, (_, _, found) in enumerate(docs):
        at = np.searchsorted(known, found)
        at[at == len(known)] = 0
        table[row, at[known[at] == found]] = 1
    return table


def link_rest(
    buckets: DataFrame, texts: DataFrame, words: int, percent: int, labels: DataFrame | None
) -> DataFrame | None:
    """``labels`` with all links between members of a bucket that stars left in two components.

    Of the members of such a bucket, those outside its largest component are
    its minors. Buckets that share components form a family, so members that are
    in one component count once when families are found. Each minor is compared with every member of its family, in blocks of
    bounded size: a block of minors and a block of members meet in a task as
    two matrices, whose product is the sizes of all intersections. A document
    travels once for each opposite block, never once for each pair, and of the
    links found one is returned for each minor and component.
    """
    rows = _with_component(buckets, labels)
    shares = rows.groupBy("bucket", "component").count().groupBy("bucket").agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("count", "component")).alias("main")
    ).filter("parts > 1").select("bucket", F.col("main.component").alias("main"))
    mixed = written(rows.join(shares, "bucket"), "mixed")
    if mixed.isEmpty():
        return labels
    parts = mixed.select("bucket", "component").distinct()
    centres = parts.groupBy("bucket").agg(F.min("component").alias("a"))
    stars = parts.join(centres, "bucket").select("a", F.col("component").alias("b"))
    families = components(stars).select(F.col("node").alias("component"), F.col("component").alias("family"))
    docs = mixed.groupBy("doc_id").agg(
        F.max("n").alias("n"), F.max("component").alias("component"),
        F.max(F.col("component") != F.col("main")).alias("minor"),
    )
    docs = written(docs.join(families, "component"), "families")
    minor = F.when(F.col("minor"), F.col("n"))
    blocks = docs.groupBy("family").agg(
        F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("bigint").alias("blocks"),
        F.ceil(F.sum(minor) / BLOCK_SHINGLES).cast("bigint").alias("chunks"),
    )
    placed = docs.join(blocks, "family").withColumns({
        "block": F.pmod(F.xxhash64("doc_id"), "blocks"),
        "chunk": F.pmod(F.xxhash64("doc_id"), "chunks"),
    })
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    one = ["family", "doc_id", "component"]
    meetings = placed.select(
        *one, F.lit(False).alias("asks"), "block", upto("chunks").alias("chunk")
    ).unionByName(placed.filter("minor").select(
        *one, F.lit(True).alias("asks"), upto("blocks").alias("block"), "chunk"
    ))

    def compare(table: pa.Table) -> pa.Table:
        only_holder("near_dedup", _hashes.clear)
        sides: tuple[list, list] = ([], [])
        columns = (table[c].to_pylist() for c in ("doc_id", "component", "asks", "text"))
        for doc, component, asks, text in zip(*columns):
            sides[0 if asks else 1].append((doc, component, shingles(text, words)))
        links = _block_links(*sides, percent) if all(sides) else []
        a, b = ([x[i] for x in links] for i in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    joined = meetings.join(texts, "doc_id")
    found = joined.groupBy("family", "block", "chunk").applyInArrow(compare, "a bigint, b bigint")
    links = written(found, "links")
    return labels if links.isEmpty() else _linked(labels, links)


def near_duplicates(
    docs: DataFrame,
    *,
    words: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    band_bins: int = BAND_BINS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles``, ``component_id``, ``kept``; a row per document.

    Documents are linked if their sets of runs of ``words`` words, compared
    whole, share ``percent`` of their union. ``component_id`` is the smallest id
    reachable over links, and the document that bears it is kept.

    Null and empty texts and those without words have an empty set and are
    linked with nothing. Equal sets are one from the start, so copies are not
    compared. Rows that repeat an id are one document with several texts: it is
    linked as each of them is. Rows without an id are documents too, equal texts
    being one: they are compared as all others, and where a group has no id
    (below 2**62), its ``component_id`` is null and one text of it is kept. An
    empty table gives no rows. Other columns are not looked at. ``text_key`` is
    a hash of the text. This call runs the jobs that find the links.
    """
    text_key = F.xxhash64(whole_text(text))
    rows = docs.select(
        named(F.col(doc_id), text_key).alias("doc_id"), text_key.alias("text_key"), F.col(text).alias("text")
    )
    seen = written(sketch(rows, words, bands, band_bins), "sketches")
    narrow = seen.select("doc_id", "text_key", "n_shingles", "set_key")
    sets = narrow.filter("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("doc_id").alias("of_set")
    )
    sets = written(sets, "sets")
    labels = _repeated_ids(narrow, sets)
    heads = sets.select("set_key", F.col("of_set").alias("doc_id"))
    members = written(
        seen.join(heads, ["set_key", "doc_id"]).dropDuplicates(["set_key", "doc_id"]).select(
            "doc_id", F.col("n_shingles").alias("n"), "keys"
        ), "members",
    ).select("doc_id", "n", F.explode("keys").alias("bucket"))
    several = members.groupBy("bucket").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    ).filter("low != high").select("bucket")
    buckets = written(members.join(several, "bucket"), "buckets")
    if not buckets.isEmpty():
        asked = buckets.select("doc_id").distinct()
        texts = rows.join(asked, "doc_id").dropDuplicates(["doc_id", "text_key"])
        texts = written(texts.select("doc_id", "text"), "texts")
        labels = link_stars(buckets, texts, words, percent, labels)
        labels = link_rest(buckets, texts, words, percent, labels)
    if labels is not None:
        linked = labels.select(F.col("node").alias("of_set"), F.col("component").alias("linked"))
        sets = sets.join(linked, "of_set", "left").withColumn(
            "of_set", F.coalesce("linked", "of_set")
        )
    answer = ["doc_id", "text_key", "n_shingles"]
    empty = narrow.filter("set_key IS NULL").select(*answer, F.col("doc_id").alias("component_id"))
    filled = narrow.join(sets, "set_key").select(*answer, F.col("of_set").alias("component_id"))
    own = F.col("doc_id") == F.col("component_id")
    nameless = F.col("doc_id") == named(F.lit(None), F.col("text_key"))
    return filled.unionByName(empty).select(
        F.when(~nameless, F.col("doc_id")).alias("doc_id"), "text_key", "n_shingles",
        F.when(F.col("component_id") < NAMELESS, F.col("component_id"))
        .when(own & ~nameless, F.col("component_id")).alias("component_id"),
        own.alias("kept"),
    )


def named(doc_id: Column, text_key: Column) -> Column:
    """The id, or for a row without one a number from its text, above usual ids."""
    from_text = F.lit(NAMELESS) + text_key.bitwiseAND(F.lit(NAMELESS - 1))
    return F.coalesce(doc_id.cast("bigint"), from_text)


def _repeated_ids(narrow: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Links of ids that stand for several sets; None if there are none."""
    repeated = narrow.filter("doc_id IS NOT NULL AND set_key IS NOT NULL").groupBy("doc_id").agg(
        F.min("set_key").alias("low"), F.max("set_key").alias("high")
    ).filter("low != high").select("doc_id")
    own = written(narrow.join(repeated, "doc_id").join(sets, "set_key").select(
        F.col("doc_id").alias("a"), F.col("of_set").alias("b")
    ).filter("a != b"), "repeated")
    return None if own.isEmpty() else components(own)


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, in all its columns.

    Of equal rows of the document that stays, one is left.
    """
    kept = near_duplicates(docs, doc_id=doc_id, text=text, **options).filter("kept")
    keys = kept.select(named(F.col("doc_id"), F.col("text_key")).alias("__id"), F.col("text_key").alias("__key"))
    text_key = F.xxhash64(whole_text(text))
    keyed = docs.withColumns({"__id": named(F.col(doc_id), text_key), "__key": text_key})
    # Texts travel once, to where both the join and the choice of one row are made.
    one = keyed.join(keys.distinct(), ["__id", "__key"], "left_semi").dropDuplicates(["__id", "__key"])
    return one.drop("__id", "__key")
