"""Cutting a text into chunks that byte-level BPE encodes on their own.

The split pattern of byte-level BPE lets no piece cross these chunks, and finds
the same pieces in a chunk alone as in the whole text. A chunk is a run without
white space, with the one blank before it or the one line break before it, or
white space by itself. Words repeat, so chunks can be encoded once and kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

# White space in Unicode's sense, which the split patterns use.
WHITE = "\t-\r \x85\xa0  -     　"
CHUNKS = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")
# Beside single blanks and single line breaks; texts without these are cut by plain splits.
UNUSUAL = re.compile(f"[{WHITE.replace(' ', '').replace(chr(9) + '-' + chr(13), chr(9) + chr(11) + '-' + chr(13))}]|  |\n\n|\n | \n| $")


def split_at_blanks(text: str) -> tuple[str, list[str]] | None:
    """The first chunk, and the others without the blank they begin with; None for unusual texts.

    A chunk that begins with a line break keeps it, and has no blank.
    """
    if UNUSUAL.search(text):
        return None
    first, *rest = text.replace("\n", " \n").split(" ")
    return first, rest


def whole_chunk(chunk: str) -> str:
    """A chunk as ``split_at_blanks`` gives it, with its blank."""
    return chunk if chunk[0] == "\n" else " " + chunk


def chunks_of(text: str) -> list[str]:
    parts = split_at_blanks(text)
    if parts is None:
        return CHUNKS.findall(text)
    first, rest = parts
    chunks = [whole_chunk(c) for c in rest]
    return [first, *chunks] if first else chunks


# Marks that a split pattern keeps apart from a letter before them.
MARKS = ".,!?;:*$%&#|"


def letters_and_marks(chunk: str) -> tuple[str, ...]:
    """The chunk, or its two halves if it ends with marks after a letter: they are encoded apart."""
    letters = chunk.rstrip(MARKS)
    if len(letters) == len(chunk) or not letters or not letters[-1].isalpha():
        return (chunk,)
    return letters, chunk[len(letters) :]


# Bytes that an entry of a cache takes beside its key and value, about.
ENTRY_BYTES = 200


class ChunkCache:
    """Encodings by chunk, emptied when they take too many bytes, so that memory is bounded.

    Chunks are kept by the text between blanks, as splitting gives it; those
    that do not follow a blank or line break have a table of their own.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], most_bytes: int):
        self.encode, self.most_bytes = encode, most_bytes
        self.clear()

    def clear(self) -> None:
        self.blanked: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {"": b""}
        self.bytes = 0

    def _learn(self, blanked: set[str], bare: set[str]) -> None:
        """Encode chunks together. A chunk with halves is put together from those, which are kept too."""
        halved = []
        for table, unseen in ((self.blanked, blanked), (self.bare, bare)):
            cut = [(key, key.rstrip(MARKS)) for key in unseen]
            pairs = [(table, k, letters) for k, letters in cut if letters and letters != k and letters[-1].isalpha()]
            unseen.difference_update([k for _, k, _ in pairs])
            unseen.update([letters for _, _, letters in pairs if letters not in table])
            halved += pairs
        bare.update({k[len(letters) :] for _, k, letters in halved} - self.bare.keys())
        keys, bare_keys = list(blanked), list(bare)
        ids = list(self.encode([k if k[0] == "\n" else " " + k for k in keys] + bare_keys))
        self.blanked.update(zip(keys, ids))
        self.bare.update(zip(bare_keys, ids[len(keys) :]))
        for table, key, letters in halved:
            table[key] = whole = table[letters] + self.bare[key[len(letters) :]]
            ids.append(whole)
        keys += bare_keys + [key for _, key, _ in halved]
        self.bytes += sum(map(len, keys)) + sum(map(len, ids)) + ENTRY_BYTES * len(keys)

    def encoded(self, texts: list[str]) -> list[bytes]:
        """The encoding of each text; chunks not seen before are encoded together."""
        if self.bytes > self.most_bytes:
            self.clear()
        blanked, bare, rows, holes = set(), set(), [], []
        for text in texts:
            parts = split_at_blanks(text)
            if parts is None:
                table, keys, unseen = self.bare, CHUNKS.findall(text), bare
                row = list(map(table.get, keys))
            else:
                (first, keys), table, unseen = parts, self.blanked, blanked
                row = [self.bare.get(first)]  # of an empty chunk nothing
                row += map(table.get, keys)
                keys.insert(0, first)
                if row[0] is None:
                    bare.add(first)
                    holes.append((row, 0, self.bare, first))
            at = -1 if parts is None else 0
            try:
                while True:
                    at = row.index(None, at + 1)
                    key = keys[at]
                    unseen.add(key)
                    holes.append((row, at, table, key))
            except ValueError:
                rows.append(row)
        if blanked or bare:
            self._learn(blanked, bare)
        for row, at, table, key in holes:
            row[at] = table[key]
        return [b"".join(row) for row in rows]
