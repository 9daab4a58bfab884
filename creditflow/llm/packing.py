"""Harmonic packing of token sequences into training sequences of a fixed capacity.

Lengths fall into reciprocal classes: class k holds pieces longer than capacity / (k + 1) and at most capacity / k, and
a sequence of class k takes exactly k pieces, so no search over open sequences is needed. Every task packs the rows
it reads by itself, without a shuffle. Documents longer than the capacity are cut into full sequences; a rest that
would leave much room in its class is cut at the next class's exact length. The pieces left at a task's end fill
mixed sequences, cut where one is full, so each task pads one sequence beside what its classes round off.

Null and empty texts are one end id. Repeated rows are packed separately. An empty table gives an empty result.
Task input must be repeatable (files are), for sequence ids come from the task's number.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import common

CAPACITY = 2048
END_ID = 1
# A piece is cut at the next class's length if it would leave more tokens than this of its share of a sequence.
SPARE_TOKENS = 12
SEQUENCES_PER_TASK = 1 << 33

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Piece(NamedTuple):
    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int


@cache
def tokenizer(path: str):
    """A byte-level BPE from its ranks file (``.tiktoken``), or any tokenizer file of the tokenizers library (``.json``)."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        return lambda text: np.array(loaded.encode(text, add_special_tokens=False).ids, dtype="<u4")
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})
    return lambda text: np.array(encoding.encode(text, allowed_special="all"), dtype="<u4")


def class_of(length: int, capacity: int) -> int:
    """Pieces of this length that a sequence takes."""
    return capacity // length


def cut(length: int, capacity: int, spare: int = SPARE_TOKENS) -> list[int]:
    """Lengths of the pieces of a document, in order; they sum up to ``length``."""
    lengths = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = class_of(rest, capacity)
        head = capacity // (k + 1)
        if capacity // k - rest <= spare or not head:
            head = rest
        lengths.append(head)
        rest -= head
    return lengths


class Packer:
    """Open sequences of one task: per class the pieces that wait for their sequence to fill."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next_sequence = capacity, first_sequence
        self.open: dict[int, list[Piece]] = defaultdict(list)
        self.rows: list[tuple] = []

    def close(self, pieces: list[Piece]) -> None:
        offset = 0
        for p in pieces:
            self.rows.append((p.doc_id, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.doc_tokens, self.next_sequence, offset))
            offset += len(p.ids)
        self.next_sequence += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start = 0
        for length in cut(len(ids), self.capacity):
            k = class_of(length, self.capacity)
            self.open[k].append(Piece(doc_id, start, ids[start : start + length], len(ids)))
            start += length
            if len(self.open[k]) == k:
                self.close(self.open.pop(k))

    def finish(self) -> None:
        """Mixed sequences of what is left: under one sequence's worth for each class."""
        filling, room = [], self.capacity
        for p in (p for k in sorted(self.open) for p in self.open[k]):
            while len(p.ids) > room:
                self.close([*filling, p._replace(ids=p.ids[:room])])
                p = p._replace(start=p.start + room, ids=p.ids[room:])
                filling, room = [], self.capacity
            filling.append(p)
            room -= len(p.ids)
            if not room:
                self.close(filling)
                filling, room = [], self.capacity
        if filling:
            self.close(filling)
        self.open.clear()

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece, see ``PIECES``; ``start`` counts the document's ids before it, ``offset`` the sequence's."""

    def run(batches: common.Batches) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_path)
        packer = Packer(capacity, TaskContext.get().partitionId() * SEQUENCES_PER_TASK)
        names = [f.strip().split()[0] for f in PIECES.split(",")]
        schema = pa.schema([(n, pa.int64()) for n in names])

        def out() -> pa.RecordBatch:
            rows = packer.take()
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                packer.add(doc_id.as_py(), np.append(encode(text.as_py() or ""), np.uint32(END_ID)).astype("<u4"))
            yield out()
        packer.finish()
        yield out()

    return docs.select(F.col(id_column).cast("long"), text_column).mapInArrow(run, PIECES)
