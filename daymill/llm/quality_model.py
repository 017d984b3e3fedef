"""Quality of documents by gated attention over their passages.

Every passage of a text is encoded as numbers: how its characters and words are
made, and a hashed bag of its words. A passage's hidden vector and its gated
attention weight are learned together from labels of whole documents; the score
is that of the weighted mean of hidden vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PASSAGE_WORDS, BAG, HIDDEN = 64, 64, 24
# At most so many labelled documents of each class are used to fit the model.
SAMPLE_OF_CLASS = 1_500
TEXTS_AT_ONCE = 400

_BLANKS = b" \t\n\v\f\r"
_GROUPS = (
    _BLANKS, bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)),
    b"#*$%&|<>", b"!", b"?", b".,;:", b"\"'()[]{}-_/\\+=~^`@", bytes(range(128, 256)),
)


def _group_of_bytes() -> np.ndarray:
    table = np.full(256, len(_GROUPS), np.uint8)
    for number, group in enumerate(_GROUPS):
        table[list(group)] = number
    return table


GROUP = _group_of_bytes()
N_GROUPS = len(_GROUPS) + 1
N_FEATURES = N_GROUPS + 6 + BAG


def _word_hashes(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from its bytes and their places in it."""
    at = np.repeat(starts, lengths)
    inside = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = (raw[at + inside].astype(np.uint64) + np.uint64(1)) * _POWERS[np.minimum(inside, 63)]
    sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    sums = (sums ^ (sums >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return sums ^ (sums >> np.uint64(29))


_POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64))


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of all texts, and the text each belongs to.

    A passage is ``PASSAGE_WORDS`` words; the last may have fewer. A text
    without words has one passage without any.
    """
    parts = [(t or "").encode("utf-8", "surrogatepass") + b" " for t in texts]
    raw = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    groups = GROUP[raw]
    filled = groups != 0
    before = np.concatenate([[False], filled[:-1]])
    starts = np.flatnonzero(filled & ~before)
    lengths = np.flatnonzero(~filled & before) - starts
    words_of = np.searchsorted(ends, starts, "right")  # the text of each word
    counts = np.bincount(words_of, minlength=len(texts))
    passages = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first = np.cumsum(passages) - passages
    place = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
    passage = first[words_of] + place // PASSAGE_WORDS
    total = int(passages.sum())
    features = np.zeros((total, N_FEATURES), np.float32)
    owner = np.repeat(np.arange(len(texts)), passages)
    if len(starts):
        sizes = np.bincount(passage, lengths, total)
        words = np.bincount(passage, minlength=total)
        of_byte = np.repeat(passage, lengths)
        shown = groups[filled]
        table = np.bincount(of_byte * N_GROUPS + shown, minlength=total * N_GROUPS)
        features[:, :N_GROUPS] = table.reshape(total, N_GROUPS) / np.maximum(sizes, 1)[:, None]
        hashes = _word_hashes(raw, starts, lengths)
        keys = hashes ^ (passage.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        distinct = np.bincount(passage[np.unique(keys, return_index=True)[1]], minlength=total)
        again = np.zeros(len(starts), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
        alone = groups[starts] == 4  # words that begin with a symbol
        own = N_GROUPS + 6
        whole = np.maximum(words, 1)
        features[:, N_GROUPS] = words / PASSAGE_WORDS
        features[:, N_GROUPS + 1] = np.minimum(sizes / whole, 40) / 10
        features[:, N_GROUPS + 2] = distinct / whole
        features[:, N_GROUPS + 3] = np.bincount(passage, again, total) / whole
        features[:, N_GROUPS + 4] = np.bincount(passage, alone, total) / whole
        features[:, N_GROUPS + 5] = np.bincount(passage, lengths > 20, total) / whole
        bag = (hashes >> np.uint64(40)).astype(np.int64) % BAG
        table = np.bincount(passage * BAG + bag, minlength=total * BAG).reshape(total, BAG)
        features[:, own:] = np.sqrt(table / whole[:, None])
    return features, owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """Weights by name, and the mean and spread of features."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    spread: np.ndarray

    def _forward(self, features: np.ndarray, owner: np.ndarray, n: int) -> dict[str, np.ndarray]:
        w = self.weights
        x = (features - self.mean) / self.spread
        hidden = np.tanh(x @ w["in"] + w["in0"])
        view = np.tanh(hidden @ w["view"])
        gate = _sigmoid(hidden @ w["gate"])
        energy = (view * gate) @ w["attend"]
        top = np.full(n, -np.inf)
        np.maximum.at(top, owner, energy)
        raised = np.exp(energy - top[owner])
        share = raised / np.bincount(owner, raised, n)[owner]
        pooled = np.zeros((n, hidden.shape[1]))
        np.add.at(pooled, owner, share[:, None] * hidden)
        score = _sigmoid(pooled @ w["out"] + w["out0"][0])
        return locals()

    def scores(self, texts: list[str]) -> np.ndarray:
        """The score of each text, between 0 and 1."""
        if not texts:
            return np.empty(0)
        features, owner = encode(texts)
        return self._forward(features, owner, len(texts))["score"]


def _gradients(model: Model, features, owner, labels) -> dict[str, np.ndarray]:
    w, n = model.weights, len(labels)
    s = model._forward(features, owner, n)
    x, hidden, view, gate, share = s["x"], s["hidden"], s["view"], s["gate"], s["share"]
    off = (s["score"] - labels) / n
    d_pooled = off[:, None] * w["out"][None, :]
    d_share = (d_pooled[owner] * hidden).sum(axis=1)
    inner = np.bincount(owner, share * d_share, n)
    d_energy = share * (d_share - inner[owner])
    d_mixed = d_energy[:, None] * w["attend"][None, :]
    d_view = d_mixed * gate * (1 - view**2)
    d_gate = d_mixed * view * gate * (1 - gate)
    d_hidden = share[:, None] * d_pooled[owner] + d_view @ w["view"].T + d_gate @ w["gate"].T
    d_in = d_hidden * (1 - hidden**2)
    return {
        "in": x.T @ d_in, "in0": d_in.sum(axis=0), "view": hidden.T @ d_view,
        "gate": hidden.T @ d_gate, "attend": (view * gate).T @ d_energy,
        "out": s["pooled"].T @ off, "out0": np.array([off.sum()]),
    }


def fit(texts: list[str], labels: list[int], *, rounds: int = 20, batch: int = 128, seed: int = 3) -> Model:
    """A model of labelled texts; classes weigh the same by drawing them alike often."""
    rng = np.random.default_rng(seed)
    coded = [encode(texts[i : i + TEXTS_AT_ONCE]) for i in range(0, len(texts), TEXTS_AT_ONCE)]
    features = np.concatenate([c[0] for c in coded])
    owner = np.concatenate([c[1] + i * TEXTS_AT_ONCE for i, c in enumerate(coded)])
    truth = np.array(labels, dtype=np.float64)
    mean, spread = features.mean(axis=0), features.std(axis=0) + 1e-3

    def start(*shape: int) -> np.ndarray:
        return rng.standard_normal(shape) / np.sqrt(shape[0])

    weights = {
        "in": start(N_FEATURES, HIDDEN), "in0": np.zeros(HIDDEN), "view": start(HIDDEN, HIDDEN),
        "gate": start(HIDDEN, HIDDEN), "attend": start(HIDDEN), "out": start(HIDDEN),
        "out0": np.zeros(1),
    }
    model = Model(weights, mean.astype(np.float32), spread.astype(np.float32))
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    classes = [np.flatnonzero(truth == c) for c in (0, 1)]
    classes = [c for c in classes if len(c)]
    moving = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    steps = max(1, rounds * len(texts) // batch)
    for step in range(1, steps + 1):
        drawn = np.concatenate([rng.choice(c, batch // len(classes)) for c in classes])
        rows = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in drawn])
        part = np.repeat(np.arange(len(drawn)), bounds[drawn + 1] - bounds[drawn])
        found = _gradients(model, features[rows], part, truth[drawn])
        rate = 0.01 * (1 - step / (steps + 1))
        for name, slope in found.items():
            slope = slope + 1e-4 * weights[name]
            first, second = moving[name]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            fixed = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            weights[name] -= rate * fixed
    return model


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    sample_of_class: int = SAMPLE_OF_CLASS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Model:
    """A model of ``docs`` by ``labels`` (``doc_id`` and ``label``, 0 or 1).

    At most ``sample_of_class`` documents of each label, the first by a hash of
    their id, are brought to the driver and fitted there: that is the bound of
    what it holds. Null ids and labels are left out, an id with both labels
    counts as 0, and an id with several texts has one of them. Without any
    labelled document every score is that of an unfitted model.
    """
    known = labels.filter("doc_id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    # Each task passes on its first rows of a class, so none holds a class as a whole.
    first = [
        known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_of_class)
        for label in (0, 1)
    ]
    chosen = first[0].unionByName(first[1])
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # The sample is bounded by its parameter, so it may be broadcast.
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.min("label").alias("label")
    ).collect()
    found = sorted(found, key=lambda r: r["doc_id"])
    return fit([r["text"] or "" for r in found] or [""], [r["label"] for r in found] or [1])


def score(docs: DataFrame, model: Model, *, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``score``, 0 to 1, higher where label 1 is likelier.

    A column so named is replaced. Every passage of a whole text counts,
    however long the text. Null and empty texts are one empty passage and have
    a score too. Rows are scored one by one, so repeated rows have equal
    scores, and an empty table gives none.
    """
    kept = [c for c in docs.columns if c != "score" and (keep_text or c != text)]
    fields = docs.select(*kept).schema.fields
    schema = T.StructType(fields + [T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
                columns.append(pa.array(model.scores(texts), pa.float64()))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "score"])

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)
