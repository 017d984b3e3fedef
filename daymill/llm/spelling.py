"""Spelling variants: words one edit apart, found by composing automata.

The vocabulary is an acceptor, an edit a transducer with two states (before and
after the edit), and near words are what acceptor o edit o acceptor accepts.
The composed machine is cut by its initial states. A pair of which the shorter
word has s code points is alike up to the place of its edit and after it, so
the pairs whose edit lies in ``[low, high)`` start from one state for each
common beginning (``low`` code points) and common end (``s - high``). Words
meet in a task by these; what lies between is made into a minimised acceptor
there and walked. Each pair belongs to one s and one place, so it is found
once. A start that too many words share is cut again by halving its places,
down to one place, where no more words than letters are left.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.llm.shared import written

# What a run of letters is, how often a code point is lost, and the shortest word.
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
LOSS = 31
SHORTEST, LEAST = 7, 2
RATIO = 10

# Words counted before they are passed on, in number and characters.
MOST_COUNTED, MOST_COUNTED_CHARS = 300_000, 8_000_000
LONG_TEXT = 4_000_000
# Words that may share an initial state, and code points between a beginning and an end.
MOST_SHARING, MOST_BETWEEN = 1_000, 256
# Suffixes of state pairs that a walk keeps.
MOST_KEPT = 500_000


def ascii_lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_of(doc_id: int | None, text: str | None, shortest: int, loss: int) -> Counter:
    """Words of a text with the code points that a checksum of id and run takes away."""
    if not text:
        return Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    lower = ascii_lower(text)
    found = LETTERS.findall(lower) if len(lower) <= LONG_TEXT else (m[0] for m in LETTERS.finditer(lower))
    words: Counter = Counter()
    for run, n in Counter(r for r in found if len(r) >= shortest).items():
        check = zlib.crc32(run.encode(), start)
        if check % loss == 0:
            at = check % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < shortest:
                continue
        words[run] += n
    return words


def vocabulary(docs: DataFrame, *, shortest: int = SHORTEST, least: int = LEAST, loss: int = LOSS) -> DataFrame:
    """``word`` and ``n`` of the words with ``shortest`` code points and ``least`` occurrences or more.

    A word is a maximal run of letters with A-Z lower-cased; where ``loss``
    divides the CRC-32 of ``<doc_id>:<run>``, it lacks the code point that the
    checksum leads to. A null id reads as nothing before the colon.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(words: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())],
                names=["word", "n"],
            )

        total, chars = Counter(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in words_of(doc_id, text.as_py(), shortest, loss).items():
                    if word not in total:
                        chars += len(word)
                    total[word] += n
                if len(total) >= MOST_COUNTED or chars >= MOST_COUNTED_CHARS:
                    yield batch_of(total)
                    total, chars = Counter(), 0
        yield batch_of(total)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counted = rows.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


class Acceptors:
    """Minimised acceptors of sets of words of one length each; equal right languages are one state."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = [{}]  # state 0 accepts the empty word
        self.register: dict[tuple, int] = {}
        self.languages: dict[int, list[str]] = {0: [""]}
        self.shared: dict[tuple[int, int], list[str]] = {}
        self.kept = 0

    def add(self, words: list[str]) -> int | None:
        """The initial state of sorted, distinct words of one length; None without words."""
        return self._state(words, 0, len(words), 0, len(words[0])) if words else None

    def _state(self, words: list[str], low: int, high: int, at: int, size: int) -> int:
        if at == size:
            return 0
        arcs = []
        while low < high:
            letter, end = words[low][at], low + 1
            while end < high and words[end][at] == letter:
                end += 1
            arcs.append((letter, self._state(words, low, end, at + 1, size)))
            low = end
        key = tuple(arcs)
        state = self.register.get(key)
        if state is None:
            state = self.register[key] = len(self.arcs)
            self.arcs.append(dict(arcs))
        return state

    def _keep(self, found: list[str]) -> None:
        self.kept += len(found) + 1
        if self.kept > MOST_KEPT:
            self.languages, self.shared, self.kept = {0: [""]}, {}, 0

    def language(self, state: int) -> list[str]:
        found = self.languages.get(state)
        if found is None:
            found = [x + rest for x, to in self.arcs[state].items() for rest in self.language(to)]
            self._keep(found)
            self.languages[state] = found
        return found

    def common(self, p: int, q: int) -> list[str]:
        """What both states accept: the walk of the composed machine after its edit."""
        if p == q:
            return self.language(p)
        if p > q:
            p, q = q, p
        found = self.shared.get((p, q))
        if found is None:
            others = self.arcs[q]
            found = [
                x + rest for x, to in self.arcs[p].items() if x in others
                for rest in self.common(to, others[x])
            ]
            self._keep(found)
            self.shared[p, q] = found
        return found


def near_pairs(short: Iterable[str], long: Iterable[str], places: int | None) -> Iterator[tuple[str, str]]:
    """Pairs within ``short``, and of ``short`` and ``long``, that one edit tells apart.

    Words of ``short`` have one length, those of ``long`` one more. The edit is
    a replaced code point or one that only the longer word has, at the first
    place where the two differ, and only pairs with that place below ``places``
    count.
    """
    machine = Acceptors()
    arcs = machine.arcs
    todo = [("", machine.add(sorted(short)), machine.add(sorted(long)))]
    if todo[0][1] is None:
        return
    while todo:
        read, p, q = todo.pop()
        if places is not None and len(read) >= places:
            continue
        ways = list(arcs[p].items())
        for i, (x, to) in enumerate(ways):
            for y, other in ways[:i]:
                for rest in machine.common(to, other):
                    yield read + x + rest, read + y + rest
        more = arcs[q] if q is not None else {}
        for y, other in more.items():
            for rest in machine.common(p, other):
                if not rest.startswith(y):
                    yield read + rest, read + y + rest
        todo.extend((read + x, to, more.get(x)) for x, to in ways)


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with ``key``, a hash of the initial state: its places, and what words there share."""
    end = F.greatest(F.lit(0), F.col("size") - F.col("high"))
    return rows.withColumn("key", F.xxhash64(
        "size", "low", "high", F.substring("word", F.lit(1), F.col("low")),
        F.substring("word", F.length("word") - end + 1, end),
    ))


def _cut(rows: DataFrame, middle: Column) -> DataFrame:
    """Each row twice, for the places before and from ``middle``."""
    halves = F.array(
        F.struct(F.col("low").alias("low"), middle.alias("high")),
        F.struct(middle.alias("low"), F.col("high").alias("high")),
    )
    return rows.withColumn("half", F.explode(halves)).select("word", "n", "size", "half.*")


def initial_states(words: DataFrame, most_sharing: int = MOST_SHARING, shortest: int = SHORTEST) -> Iterator[DataFrame]:
    """Rows ``key, word, n, size, low, high``, in parts: a row for each initial state of a word.

    Within a part, no key has more than ``most_sharing`` words, or its words
    differ at one place only. A word is met as the shorter and as the longer of
    a pair, and with its edit in either half of its places.
    """
    length = F.length("word")
    sizes = F.explode(F.array(length, length - 1))
    rows = words.select("word", "n", sizes.alias("size")).filter(F.col("size") >= shortest)
    rows = rows.withColumns({"low": F.lit(0), "high": F.col("size") + 1})
    rows = _cut(rows, F.floor(F.col("size") / 2).cast("int"))
    while True:
        keyed = written(_keyed(rows), "spelling-states")
        sharing = keyed.groupBy("key").agg(
            F.count(F.lit(1)).alias("sharing"), F.max(F.col("high") - F.col("low")).alias("between")
        )
        crowded = (F.col("sharing") > most_sharing) | (F.col("between") > MOST_BETWEEN)
        heavy = written(sharing.filter((F.col("sharing") > 1) & (F.col("between") > 1) & crowded).select("key"), "spelling-heavy")
        if heavy.isEmpty():
            yield keyed
            return
        yield keyed.join(heavy, "key", "left_anti")
        rows = _cut(keyed.join(heavy, "key", "left_semi"), F.floor((F.col("low") + F.col("high")) / 2).cast("int"))


NEAR = "word string, n_near bigint, near_n bigint, near_word string"


def _near_in(words: list[str], counts: list[int], size: int, low: int, high: int) -> Iterator[tuple]:
    """``NEAR`` rows of the words that meet at a key."""
    end = max(0, size - high)
    places = None if high > size else high - low
    contexts: dict[tuple[str, str], list[tuple[str, str, int]]] = {}
    for word, n in zip(words, counts):
        stop = len(word) - end
        contexts.setdefault((word[:low], word[stop:]), []).append((word[low:stop], word, n))
    for members in contexts.values():
        middles = {middle: (word, n) for middle, word, n in members}
        short = [m for m, (w, _) in middles.items() if len(w) == size]
        if not short or len(middles) < 2:
            continue
        found: dict[str, list] = {}
        for x, y in near_pairs(short, [m for m, (w, _) in middles.items() if len(w) > size], places):
            for mine, other in ((x, y), (y, x)):
                word, n = middles[other]
                best = found.get(mine)
                if best is None:
                    found[mine] = [1, n, word]
                else:
                    best[0] += 1
                    if n > best[1] or (n == best[1] and word < best[2]):
                        best[1:] = n, word
        for middle, (count, n, word) in found.items():
            yield middles[middle][0], count, n, word


def near_words(part: DataFrame) -> DataFrame:
    """For each word and initial state: the number of near words, and the one of largest n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answers(table: pa.Table) -> Iterator[tuple]:
            keys = table["key"].to_numpy()
            ends = np.flatnonzero(np.diff(keys)) + 1
            starts, stops = np.r_[0, ends], np.r_[ends, len(keys)]
            several = stops - starts > 1
            columns = [table[c].to_pylist() for c in ("word", "n")] if several.any() else []
            places = [table[c].to_numpy() for c in ("size", "low", "high")]
            for start, stop in zip(starts[several], stops[several]):
                yield from _near_in(*(c[start:stop] for c in columns), *(int(p[start]) for p in places))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * 4
            types = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["word", "n_near", "near_n", "near_word"],
            )

        held: list[pa.RecordBatch] = []  # of the last key, which may go on
        for batch in batches:
            table = pa.Table.from_batches([*held, batch])
            keys = table["key"].to_numpy()
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            yield batch_of(list(answers(table.slice(0, last))) if last else [])
            held = table.slice(last).to_batches()
        if held:
            yield batch_of(list(answers(pa.Table.from_batches(held))))

    columns = part.select("key", "word", "n", "size", "low", "high")
    return columns.repartition("key").sortWithinPartitions("key").mapInArrow(run, NEAR)


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of every word with a form: each round doubles the way that is known."""
    known = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(known.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        known = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return known


def variants(
    docs: DataFrame,
    *,
    shortest: int = SHORTEST,
    least: int = LEAST,
    loss: int = LOSS,
    ratio: int = RATIO,
    most_sharing: int = MOST_SHARING,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``; a row for each word.

    Words are those of ``vocabulary``. Two are near if one inserted, deleted or
    replaced code point tells them apart. The form of a word is its near word
    of largest ``n``, of equals the smallest in code-point order, if that is
    ``ratio`` times its own ``n`` or more; ``root`` is where forms lead to.

    Null and empty texts and those without letters have no words; texts of any
    length are read whole, and repeated rows count again. A table without words
    gives no rows. Columns other than ``doc_id`` and ``text`` are not looked
    at. This call runs the jobs that find near words.
    """
    words = written(vocabulary(docs, shortest=shortest, least=least, loss=loss), "spelling-words")
    near = None
    for part in initial_states(words, most_sharing, shortest):
        found = written(near_words(part), "spelling-near")
        near = found if near is None else near.unionByName(found)
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near_word").alias("word")))
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    takes = -F.col("best.n") >= ratio * F.col("n")
    judged = written(words.join(near, "word", "left").select(
        "word", F.when(takes, F.col("best.word")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(takes, -F.col("best.n")).alias("form_n"),
    ), "spelling-forms")
    roots = _roots(judged.filter("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
