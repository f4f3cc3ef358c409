"""Harmonic packing of tokenized documents into fixed-length sequences.

Lengths are partitioned into classes by reciprocals of the capacity: class k
holds lengths over ``capacity / (k + 1)``, up to ``capacity / k``, and each of
its bins takes k documents, which always fit. Of a document longer than a
sequence, full sequences are cut off first; what remains goes to its class.

A bin that has its k documents has a gap left, and the next document of the
task begins there: it is cut only where the gap ends. Gaps of fewer than
``LEAST_PIECE`` tokens stay as padding, and of fewer than twice as many if
the next document would be cut into smaller pieces. Smaller pieces come only
from what full sequences leave, and from the end of a task. Bins are filled
by each task on its own, so there is no shuffle. What open bins hold at the
end of a task is joined, longest first, and cut into full sequences; the last
of it into sequences whose lengths are powers of two, which need no padding.

Ties: documents of one class go to its bins in the order in which they are
read, so where a document is packed depends on how the input is divided.

Defined results: a null or empty text is the end id alone; a very long text is
encoded whole and cut like others; repeated rows are packed once each; rows
with a null id are packed like others; an empty table gives no rows. Other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import slices

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long"
)
#: Pieces a task hands on at once, in bytes of token ids.
BATCH_BYTES = 4 << 20
#: Tokens of a piece at least, where a document is cut to fill a gap.
LEAST_PIECE = 16
#: Sequences of one task are numbered from its partition's number shifted by this.
TASK_BITS = 36
# The pattern of this byte-level vocabulary.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """An encoder that gives the ids of the tokenizer in the file at ``path``.

    The vocabulary of a byte-level BPE is in merge order, so ids serve as ranks.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    letters = byte_letters()
    ranks = {
        bytes(letters[c] for c in token): number
        for token, number in spec["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding(
        path, pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=special
    ), tuple(special)


def encode(text: str, path: str) -> list[int]:
    """The token ids of a text, as ``tokenizers`` gives them without special tokens added."""
    coder, special = encoder(path)
    if any(mark in text for mark in special):
        return coder.encode(text, allowed_special="all")
    return coder.encode_ordinary(text)


class Bins:
    """The open bins of one task: one of each class, and one whose gap is being filled."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next = capacity, first_sequence
        self.least = min(LEAST_PIECE, capacity)
        self.open: dict[int, list[tuple]] = {}
        self.gap: list[tuple] = []

    def add(self, doc: int | None, ids: np.ndarray) -> list[tuple]:
        """Put a document in bins; the rows of those that are full now."""
        rows, start, total = [], 0, len(ids)

        def cut(length: int) -> tuple:
            nonlocal start
            piece = (doc, start, length, ids[start : start + length].tobytes(), total)
            start += length
            return piece

        if self.gap:
            if part := self.fill(total):
                self.gap.append(cut(part))
            rows += self.full_gap(giving_up=not part)
        while total - start >= self.capacity:
            rows += self.closed([cut(self.capacity)])
        if total > start:
            kind = self.capacity // (total - start)
            held = self.open.setdefault(kind, [])
            held.append(cut(total - start))
            if len(held) == kind:
                self.gap = self.open.pop(kind)  # the one before is full: the document is not used up
                rows += self.full_gap()
        return rows

    def fill(self, total: int) -> int:
        """How much of a document of so many tokens goes into the gap; 0 if that would shred it."""
        room = self.capacity - held_in(self.gap)
        if total <= room:
            return total
        part = min(room, total - self.least)
        return part if part >= self.least else 0

    def full_gap(self, giving_up: bool = False) -> list[tuple]:
        """The rows of the bin with the gap, if too little is left of it."""
        if self.capacity - held_in(self.gap) >= self.least and not giving_up:
            return []
        held, self.gap = self.gap, []
        return self.closed(held)

    def closed(self, held: list[tuple]) -> list[tuple]:
        number, self.next = self.next, self.next + 1
        size, rows, offset = held_in(held), [], 0
        for piece in held:
            rows.append((*piece, number, offset, size))
            offset += piece[2]
        return rows

    def rest(self) -> list[tuple]:
        """What open bins hold, in full sequences and a few whose lengths are powers of two."""
        left = [*self.gap, *(piece for held in self.open.values() for piece in held)]
        left.sort(key=lambda piece: -piece[2])
        self.gap, self.open = [], {}
        rows, held, remaining = [], [], held_in(left)
        room = power_within(remaining, self.capacity)
        for doc, start, length, ids, total in left:
            while length:
                part = min(length, room)
                held.append((doc, start, part, ids[: 4 * part], total))
                start, length, ids = start + part, length - part, ids[4 * part :]
                room, remaining = room - part, remaining - part
                if not room:
                    rows += self.closed(held)
                    held, room = [], power_within(remaining, self.capacity)
        return rows


def held_in(pieces: list[tuple]) -> int:
    return sum(piece[2] for piece in pieces)


def power_within(tokens: int, capacity: int) -> int:
    """The largest power of two that is neither over ``tokens`` nor over ``capacity``."""
    return min(capacity, 1 << (tokens.bit_length() - 1)) if tokens else 0


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of documents with their place in sequences of ``capacity`` tokens.

    ``ids`` holds a piece's token ids as little-endian unsigned 32-bit numbers,
    ``sequence_length`` the tokens of its sequence: a power of two, or fewer
    than twice ``LEAST_PIECE`` below ``capacity``, which is the padding it needs. ``tokenizer`` is the path of a byte-level vocabulary file
    that is there on every worker; ``capacity`` must be a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(capacity, TaskContext.get().partitionId() << TASK_BITS)
        rows, held = [], 0
        for batch in slices(batches, "text", 1 << 22):
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = encode(content.as_py() or "", tokenizer)
                ids = np.array([*tokens, end_id], dtype="<u4")
                full = bins.add(doc, ids)
                rows += full
                held += 4 * held_in(full)
                if held > BATCH_BYTES:
                    yield as_batch(rows)
                    rows, held = [], 0
        yield as_batch(rows + bins.rest())

    chosen = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return chosen.mapInArrow(run, PIECES)


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"ids": pa.binary()}
    names = [field.split()[0] for field in PIECES.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, columns)], names
    )

