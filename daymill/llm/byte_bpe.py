"""Byte-level BPE as a finite-state transducer, and decoding as a stream."""

from __future__ import annotations

import base64
import codecs
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from daymill.llm.pieces import ChunkCache
from daymill.llm.shared import only_holder, seldom_collected

# What is kept before starting over, texts encoded at once, and ids decoded at once.
MOST_STATES, MOST_PAIRS, MOST_BYTES = 220_000, 800_000, 120_000_000
TEXTS_AT_ONCE, IDS_AT_ONCE = 500, 1 << 16
NEVER = 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, from lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Maps bytes to tokens, left to right, as merging by rank would in the end.

    Merging splits a text into tokens of which each neighbouring pair, merged
    by itself, stays as it is; no other split has that property. So the last
    token of a beginning of the text is the one that fits the last token of the
    beginning before it. A state holds, for every place where a token may yet
    begin, how far that token has been read, the token before it, and the
    tokens not given out so far. Tokens all places agree on are given out:
    what comes later cannot change them. No place is older than the longest
    token, which bounds the lookahead. States and steps are made when first
    met and kept.
    """

    def __init__(self, ranks: dict[bytes, int], most_states: int = MOST_STATES):
        self.ranks, self.most_states = ranks, most_states
        self.bytes_of = {i: t for t, i in ranks.items()}
        self._next: dict[int, int] = {}
        self._token: list[int] = [-1]
        self._inner: list[bool] = [False]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                self._inner[node] = True
                if key not in self._next:
                    self._next[key] = len(self._token)
                    self._token.append(-1)
                    self._inner.append(False)
                node = self._next[key]
            self._token[node] = rank
        self._fits: dict[int, bool] = {}
        self._edge: dict[int, tuple[list, list] | None] = {}
        self._forget()

    def _forget(self) -> None:
        start = ((0, -1, ()),)
        self._states, self._numbers = [start], {start: 0}
        self._ends: list[tuple[int, ...]] = [()]
        self._steps: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _start_over(self, state: int) -> int:
        """Forget all states but one, which gets a new number, also within a piece."""
        places, ends = self._states[state], self._ends[state]
        self._forget()
        self._fits.clear()
        if places in self._numbers:
            return self._numbers[places]
        self._numbers[places] = 1
        self._states.append(places)
        self._ends.append(ends)
        return 1

    def merged(self, text: bytes, stop: int = 1) -> list[int]:
        """The text merged by rank, pair by pair, until ``stop`` parts are left."""
        ranks, parts = self.ranks, [text[i : i + 1] for i in range(len(text))]
        while len(parts) > stop:
            best, at = min(
                (ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
            )
            if best == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _edges(self, token: int) -> tuple[list, list] | None:
        """What stands at the left and right edge of a token while it is merged, and since when.

        None if the token is never made, or not by ever higher ranks.
        """
        if token in self._edge:
            return self._edge[token]
        text, found = self.bytes_of[token], None
        if len(text) == 1:
            found = ([(text, -1)], [(text, -1)])
        elif len(parts := self.merged(text, 2)) == 2 and b"".join(map(self.bytes_of.get, parts)) == text:
            left, right = map(self._edges, parts)
            if left and right and max(left[0][-1][1], right[1][-1][1]) < token:
                found = ([*left[0], (text, token)], [*right[1], (text, token)])
        self._edge[token] = found
        return found

    def _fit(self, before: int, token: int) -> bool:
        """Whether the two tokens, merged as one text, stay two.

        Both are merged in the order of ranks, so at any rank it is known what
        stands on either side of the border. They stay two unless some such
        pair would be merged before either side moves on; of equal ranks the
        left one goes first.
        """
        key = before << 32 | token
        known = self._fits.get(key)
        if known is None:
            right = self._edges(token)
            left = self._edges(before) if before >= 0 else right
            if left is None or right is None:
                pair = [before, token] if before >= 0 else [token]
                known = self.merged(b"".join(map(self.bytes_of.get, pair))) == pair
            else:
                known = before < 0 or self._stay_apart(left[1], right[0])
            self._fits[key] = known
        return known

    def _stay_apart(self, left: list, right: list) -> bool:
        i = j = 0
        while True:
            until_left = left[i + 1][1] if i + 1 < len(left) else NEVER
            until_right = right[j + 1][1] if j + 1 < len(right) else NEVER
            rank = self.ranks.get(left[i][0] + right[j][0], NEVER)
            if rank < until_left and rank <= until_right and rank != NEVER:
                return False
            if until_left == until_right == NEVER:
                return True
            if until_left <= until_right:
                i += 1
            else:
                j += 1

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        places, reached = [], None
        for node, before, path in self._states[state]:
            node = self._next.get(node << 8 | byte)
            if node is None:
                continue
            if self._inner[node]:
                places.append((node, before, path))
            token = self._token[node]
            if reached is None and token >= 0 and self._fit(before, token):
                reached = (0, token, path + (token,))
        if reached is None:
            raise ValueError(f"no token covers byte {byte}")
        places.append(reached)
        shared = min(len(path) for _, _, path in places)
        out = reached[2][:shared]
        while any(path[: len(out)] != out for _, _, path in places):
            out = out[:-1]
        new = tuple((node, before, path[len(out) :]) for node, before, path in places)
        number = self._numbers.get(new)
        if number is None:
            number = self._numbers[new] = len(self._states)
            self._states.append(new)
            self._ends.append(new[-1][2])
        self._steps[state << 8 | byte] = step = (number, out)
        return step

    def encode(self, piece: bytes) -> list[int]:
        steps, state, ids = self._steps, 0, []
        for byte in piece:
            step = steps.get(state << 8 | byte)
            if step is None:
                if len(self._states) > self.most_states or len(self._fits) > MOST_PAIRS:
                    state = self._start_over(state)
                    steps = self._steps
                step = self._step(state, byte)
            state = step[0]
            if step[1]:
                ids += step[1]
        ids += self._ends[state]
        return ids


class Encoder:
    """Whole texts to ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]):
        self.transducer = Transducer(ranks)
        self._split = regex.compile(PATTERN)
        self._cache = ChunkCache(self._encode, MOST_BYTES)

    def _encode(self, chunks: Iterable[str]) -> Iterator[bytes]:
        encode, split = self.transducer.encode, self._split.findall
        for chunk in chunks:
            ids = array("I")
            for piece in split(chunk):
                ids.extend(encode(piece.encode("utf-8")))
            yield ids.tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        return self._cache.encoded(texts)


@lru_cache(maxsize=1)
def encoder_of(ranks_path: str) -> Encoder:
    """The encoder of a worker, which outlives its tasks."""
    return Encoder(read_ranks(ranks_path))


class StreamDecoder:
    """Ids to text as they come.

    Bytes pass through an incremental UTF-8 state machine, so a character whose
    bytes are spread over tokens comes out whole with its last byte.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self._token = {i: t for t, i in ranks.items()}.__getitem__
        self._machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self._machine.decode(b"".join(map(self._token, ids)))

    def end(self) -> str:
        """What is left: bytes that no character was made of are marked as unreadable."""
        left = self._machine.decode(b"", True)
        self._machine.reset()
        return left


ADDED = {"n_tokens": "bigint", "ids": "binary"}


def encode_documents(
    docs: DataFrame, ranks_path: str, *, text: str = "text", keep_text: bool = False
) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers).

    Columns so named are replaced. Null and empty texts have no ids. Every row
    is encoded on its own and whole, however long; repeated rows have equal
    ids, and an empty table gives none. ``ranks_path`` is a file on every
    executor.
    """
    kept = [c for c in docs.columns if c not in ADDED and (keep_text or c != text)]
    fields = docs.select(*kept).schema.fields
    schema = T.StructType(
        fields + [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_holder("byte_bpe", encoder_of.cache_clear)
        seldom_collected()
        encoder = encoder_of(ranks_path)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                ids = encoder.encode([t or "" for t in texts])
                columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
                columns.append(pa.array([len(x) // 4 for x in ids], pa.int64()))
                columns.append(pa.array(ids, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *ADDED])

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks_path: str, *, text: str = "text") -> DataFrame:
    """``docs`` without their text, with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    Ids are made and decoded again where they are made; only digests travel.
    Null and empty texts have no ids, and digests of nothing.
    """
    added = ("n_tokens", "ids_sha256", "decoded_sha256")
    kept = [c for c in docs.columns if c not in (*added, text)]
    types = (T.LongType(), T.StringType(), T.StringType())
    new = [T.StructField(a, t) for a, t in zip(added, types)]
    schema = T.StructType(docs.select(*kept).schema.fields + new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_holder("byte_bpe", encoder_of.cache_clear)
        seldom_collected()
        encoder = encoder_of(ranks_path)
        decoder = StreamDecoder(encoder.transducer.ranks)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                ids = encoder.encode([t or "" for t in texts])
                columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
                columns += [
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([_sha256(_decoded_parts(decoder, x)) for x in ids], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``; null ids give null."""
    kept = [c for c in encoded.columns if c != "decoded"]
    fields = encoded.select(*kept).schema.fields
    schema = T.StructType(fields + [T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = StreamDecoder(read_ranks(ranks_path))
        for batch in batches:
            raw = (x.as_py() for x in batch.column(batch.schema.get_field_index("ids")))
            texts = [x if x is None else "".join(_decoded_parts(decoder, x)) for x in raw]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "decoded"])

    return encoded.mapInArrow(run, schema)


def _decoded_parts(decoder: StreamDecoder, ids: bytes) -> Iterator[str]:
    numbers = array("I")
    numbers.frombytes(ids)
    for at in range(0, len(numbers), IDS_AT_ONCE):
        yield decoder.feed(numbers[at : at + IDS_AT_ONCE])
    yield decoder.end()


def _sha256(parts: Iterable[str]) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part.encode("utf-8"))
    return digest.hexdigest()
