"""Language identification: words first, and shorter and shorter runs of characters for the rest.

A word that is known adds its log frequency in each language. Another word is
read as runs of characters: at each place the longest known run of four to one
characters, with a blank at both ends of the word, and the mean of their log
frequencies counts as one word. Counts are taken over all documents to learn
from. A word or run is known if its share of some language's words, or runs of
its length, is at least a threshold, which bounds how many there can be.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.llm.shared import written

WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
RUNS = (4, 3, 2, 1)
UNDETERMINED = "und"

# Known words, and known runs of each length, at most; and numbers in a table of either.
MOST_KNOWN, MOST_CELLS = 100_000, 2_000_000
SMOOTHING = 0.5

# Counts are passed on when so many differ, or after so many characters of text.
MOST_COUNTED, MOST_COUNTED_CHARS = 300_000, 50_000_000
# Unknown words that a task remembers, and their characters; words that are looked up together.
MOST_REMEMBERED, MOST_REMEMBERED_CHARS = 400_000, 16_000_000
GROUP_WORDS = 100_000
# Texts beyond this many characters are read word by word.
LONG_TEXT = 1_000_000


def words_in(text: str) -> Iterable[str]:
    """Runs of letters with the marks on them, composed and lower-cased."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    text = text.lower()
    if len(text) <= LONG_TEXT:
        return WORDS.findall(text)
    return (m[0] for m in WORDS.finditer(text))


def runs_in(word: str, length: int) -> list[str]:
    """The runs of a word between blanks; blanks alone are none."""
    if length == 1:
        return list(word)
    padded = f" {word} "
    return [padded[i : i + length] for i in range(len(padded) - length + 1)]


def _handed_out(counts: dict[str, Counter], sized: bool) -> pa.RecordBatch:
    """Counts by language and item, which are emptied."""
    langs, items, numbers = [], [], []
    for lang, of in counts.items():
        langs += [lang] * len(of)
        items += of.keys()
        numbers += of.values()
    counts.clear()
    columns = {"lang": pa.array(langs, pa.string()), "item": pa.array(items, pa.string()), "n": pa.array(numbers, pa.int64())}
    if sized:
        columns["size"] = pa.array(map(len, items), pa.int32())
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _full(counts: dict[str, Counter]) -> bool:
    return sum(map(len, counts.values())) >= MOST_COUNTED


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, chars = defaultdict(Counter), 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            counts[lang].update(words_in(text))
            chars += len(text)
            if chars >= MOST_COUNTED_CHARS or _full(counts):
                yield _handed_out(counts, False)
                chars = 0
    yield _handed_out(counts, False)


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = defaultdict(Counter)
    for batch in batches:
        for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            of = counts[lang]
            for size in RUNS:
                for run in runs_in(word, size):
                    of[run] += n
            if len(of) >= MOST_COUNTED:
                yield _handed_out(counts, True)
        if _full(counts):
            yield _handed_out(counts, True)
    yield _handed_out(counts, True)


@dataclass
class Model:
    """Languages in code-point order, their prior, and log frequencies by word and by run.

    ``words`` and ``runs`` lead to rows of ``word_rows`` and ``run_rows``, which
    have a column for each language.
    """

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int] = field(default_factory=dict)
    runs: dict[str, int] = field(default_factory=dict)
    word_rows: np.ndarray | None = None
    run_rows: np.ndarray | None = None

    def runs_of(self, word: str) -> list[int]:
        """Rows of the longest known run at each place of a word."""
        padded, rows, find = f" {word} ", [], self.runs.get
        for i in range(len(padded)):
            for end in range(min(i + RUNS[0], len(padded)), i, -1):
                row = find(padded[i:end])
                if row is not None:
                    rows.append(row)
                    break
        return rows

    def of_unknown(self, words: list[str]) -> np.ndarray:
        """For each word, the mean row of the longest known runs at its places; zeros without any."""
        rows = [self.runs_of(w) for w in words]
        lengths = np.array([len(r) for r in rows])
        means = np.zeros((len(words), len(self.languages)), np.float32)
        some = lengths > 0
        if some.any():
            flat = np.fromiter(chain.from_iterable(rows), np.int64, lengths.sum())
            starts = np.r_[0, np.cumsum(lengths[some])[:-1]]
            sums = np.add.reduceat(self.run_rows[flat].astype(np.float64), starts, axis=0)
            means[some] = sums / lengths[some][:, None]
        return means


def _known(counts: DataFrame, totals: dict, group: list[str], item: str, languages: int) -> DataFrame:
    """Rows of the items whose share in some language reaches the threshold.

    Shares of a language add up to one, so no more than ``MOST_KNOWN`` items
    reach it, and there are at most ``MOST_CELLS`` rows of them for each length.
    """
    least = languages / max(1, min(MOST_KNOWN, MOST_CELLS // languages))
    # One row for each language and length, as part of the plan.
    limits = counts.sparkSession.createDataFrame(
        [(*key, max(1.0, least * total)) for key, total in totals.items()],
        ", ".join(f"{g} {'int' if g == 'size' else 'string'}" for g in group) + ", at_least double",
    )
    keys = [g for g in group if g != "lang"] + [item]
    frequent = counts.join(F.broadcast(limits), group).filter("n >= at_least").select(*keys).distinct()
    return counts.join(frequent, keys, "left_semi")


def _rows(found: pa.Table, item: str, totals: dict, languages: list[str]) -> tuple[dict, np.ndarray]:
    """Places of items, and a row of smoothed log frequencies for each. ``totals`` is by language."""
    names = sorted(set(found[item].to_pylist()))
    place, column = {x: i for i, x in enumerate(names)}, {x: i for i, x in enumerate(languages)}
    counts = np.zeros((len(names), len(languages)))
    at = [place[x] for x in found[item].to_pylist()], [column[x] for x in found["lang"].to_pylist()]
    counts[at] = found["n"].to_numpy()
    sums = np.array([totals.get(x, 0) for x in languages]) + SMOOTHING * max(1, len(names))
    return place, np.log((counts + SMOOTHING) / sums).astype(np.float32)


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> Model:
    """Learn from every document whose language is given.

    Null texts and those without letters add to the prior of their language
    only. Repeated rows count as often as they come. Without any language the
    model has none. The languages' list is collected, and the known words and
    runs, whose number is bounded; all counts are taken over the whole table.
    """
    known = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    shares = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(shares)
    model = Model(languages, np.log(np.array([shares[x] for x in languages], float) / max(1, sum(shares.values()))))
    if not languages:
        return model
    words = written(
        known.filter("text IS NOT NULL").mapInArrow(_count_words, "lang string, item string, n bigint")
        .groupBy("lang", F.col("item").alias("word")).agg(F.sum("n").alias("n")),
        "language-words",
    )
    runs = written(
        words.mapInArrow(_count_runs, "lang string, item string, n bigint, size int")
        .groupBy("lang", "size", F.col("item").alias("run")).agg(F.sum("n").alias("n")),
        "language-runs",
    )
    totals = {(r.lang,): r.n for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if totals:
        found = _known(words, totals, ["lang"], "word", len(languages)).select("lang", "word", "n").toArrow()
        model.words, model.word_rows = _rows(found, "word", {k: n for (k,), n in totals.items()}, languages)
        totals = {(r.lang, r["size"]): r.n for r in runs.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()}
        found = _known(runs, totals, ["lang", "size"], "run", len(languages)).select("lang", "size", "run", "n").toArrow()
        rows = []
        for size in RUNS:
            of = {k: n for (k, s), n in totals.items() if s == size}
            part = found.filter(pa.compute.equal(found["size"], size))
            places, table = _rows(part, "run", of, languages)
            start = sum(map(len, rows))
            model.runs.update((run, start + at) for run, at in places.items())
            rows.append(table)
        model.run_rows = np.concatenate(rows)
    return model


class _Evidence:
    """Sums of rows by text; rows of unknown words are kept until they are many."""

    def __init__(self, model: Model):
        self.model = model
        known = len(model.words)
        self.table = np.zeros((known + MOST_REMEMBERED, len(model.languages)), np.float32)
        if known:
            self.table[:known] = model.word_rows
        self.place: dict[str, int] = dict(model.words)
        self.chars = 0

    def _make_room(self, words: int) -> None:
        if len(self.place) + words > len(self.table) or self.chars > MOST_REMEMBERED_CHARS:
            self.place, self.chars = dict(self.model.words), 0

    def sums(self, texts: list[list[str]]) -> np.ndarray:
        """A row for each list of words, none of them empty; up to ``MOST_REMEMBERED`` words in all."""
        place = self.place
        new = list({w for words in texts for w in words if w not in place})
        if new:
            self._make_room(len(new))
            if self.place is not place:
                place = self.place
                new = list({w for words in texts for w in words if w not in place})
            self.table[len(place) : len(place) + len(new)] = self.model.of_unknown(new)
            place.update(zip(new, range(len(place), len(place) + len(new))))
            self.chars += sum(map(len, new))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        rows = np.fromiter(map(place.__getitem__, chain.from_iterable(texts)), np.int64, lengths.sum())
        return np.add.reduceat(self.table[rows].astype(np.float64), np.r_[0, np.cumsum(lengths)[:-1]], axis=0)


def _judged(evidence: _Evidence, texts: Iterable[str | None]) -> Iterator[tuple[str, float]]:
    """Language and score of each text; those of usual length are looked up in groups."""
    model, group, words = evidence.model, [], 0

    def judged(sums: np.ndarray) -> tuple[str, float]:
        total = model.prior + sums
        best = int(total.argmax())  # the first of equals
        return model.languages[best], float(1 / np.exp(total - total[best]).sum())

    def answers() -> Iterator[tuple[str, float]]:
        some = [found for found in group if found]
        sums = iter(evidence.sums(some)) if some else iter(())
        for found in group:
            yield judged(next(sums)) if found else (UNDETERMINED, 0.0)

    for text in texts:
        found = words_in(text or "") if model.languages else []
        if not isinstance(found, list):  # a very long text, in pieces
            yield from answers()
            group, words = [], 0
            pieces = iter(lambda found=found: list(islice(found, GROUP_WORDS)), [])
            sums = [evidence.sums([piece])[0] for piece in pieces]
            yield judged(sum(sums)) if sums else (UNDETERMINED, 0.0)
            continue
        group.append(found)
        words += len(found)
        if words >= GROUP_WORDS:
            yield from answers()
            group, words = [], 0
    yield from answers()


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the probability of that language.

    A null text, one without a letter, and any text if no language was learned
    is ``und`` with score 0. Texts are read whole, whatever their length. Equal
    scores go to the first language in code-point order. The text stays; columns
    named like the answers are replaced by them. Rows are judged one by one, so
    repeated rows get equal answers, and an empty table gives none. The model
    is sent to executors once; its size is bounded, see ``train``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*kept, F.col(text).alias("__text"))
    schema = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = _Evidence(sent.value)
        for batch in batches:
            texts = (t.as_py() for t in batch.column(batch.num_columns - 1))
            judged = list(_judged(evidence, texts))
            langs, scores = zip(*judged) if judged else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score"],
            )

    return rows.mapInArrow(run, schema)


def held_out(doc_id: Column, of: int = 5) -> Column:
    """Whether a document is kept from learning; one without an id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % of == 0, F.lit(False))
