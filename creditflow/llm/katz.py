"""A Katz backoff language model over the corpus, and the log10 probability of every text under it.

``P(w | h)`` of a seen n-gram is its Good-Turing discounted share of the context's count; of an unseen one it is the
context's backoff weight times ``P(w | shorter h)``, and so on down to single words. What the discounts take off is
exactly what the backoff weight hands out: ``weight = taken / (1 - sum of P(w | shorter h) over the seen w)``, so the
probabilities of all known words and of one unknown word add up to 1 after every context. A context that was never
seen hands on to the shorter one unchanged.

How it runs. Texts become blocks: the tokens of some documents as numbers into the block's own list of words. For
each order the blocks send their distinct n-grams, with how often they occur in training texts, to buckets by the
hash of the context. A bucket adds up the counts of all blocks; that is the partition of the n-gram table for its
contexts. It returns the count and number of each n-gram, and per context what its weight depends on. With the answers
of order n the blocks know the probabilities that order n + 1 backs off to, and its contexts by their numbers. Contexts
with very many occurrences are split over several buckets by the next word, and their sums are joined back. Only totals
and counts of counts reach the driver.

Texts are taken whole; a block holds at least one document however long. Null texts are empty and consist of their end
token. Documents with a null id do not train and are not held out. Rows that repeat an id are scored and counted row by
row. Without training texts every token is unknown and has probability 1. Where Good-Turing has no valid estimate (small
corpora), half a count is taken off counts up to ``LIMIT``; where a context has no such counts, its total counts one
more. Words are told apart by 64-bit hashes, n-grams by numbers of up to 41 bits. An empty table gives an empty result. Other columns are not
looked at and may have any names.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow.llm import common
from creditflow.session import stage

# Longest n-grams. Counts up to the limit are discounted.
ORDER = 2
LIMIT = 5
# Tokens of a block, n-grams that a bucket is meant for, occurrences of a context over which it is split.
BLOCK_TOKENS = 1 << 20
BUCKET_NGRAMS = 1 << 21
HOT = 1 << 21
# Bits of an n-gram's number, of a bucket's.
NUMBER_BITS, BUCKET_BITS = 41, 23

# Fixed value: A-Z become a-z.
TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# No word holds a blank.
END = b" end"

MIX_2, MIX_3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB))

# Rows between blocks and buckets. Payloads have a bucket; the negative numbers are other kinds of rows.
ROW = "block long, level int, bucket int, payload binary, ctx long, c long, low double, m array<long>"
ROW_SCHEMA = pa.schema(
    [
        ("block", pa.int64()), ("level", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary()),
        ("ctx", pa.int64()), ("c", pa.int64()), ("low", pa.float64()), ("m", pa.list_(pa.int64())),
    ]
)
TOTALS, HOT_PART, HOT_WANTED = -1, -2, -3
SCORES = pa.schema(
    [
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("base_score", pa.float64()), ("score", pa.float64()),
    ]
)


def hash_of(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * MIX_2
    x = (x ^ (x >> np.uint64(27))) * MIX_3
    return x ^ (x >> np.uint64(31))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes: whole numbers in as few bytes as they need, byte by byte of equal rank."""
    out = [len(arrays).to_bytes(2, "little")]
    for a in arrays:
        if a.dtype.kind in "iub" and len(a) and a.min() >= 0:
            a = a.astype(np.min_scalar_type(a.max()))
        kind = a.dtype.str[1:].encode()
        out += [kind, len(a).to_bytes(8, "little"), np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(packed: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    at, arrays = 2, []
    for _ in range(int.from_bytes(raw[:2], "little")):
        kind, n = np.dtype(raw[at : at + 2].decode()), int.from_bytes(raw[at + 2 : at + 10], "little")
        at += 10
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        arrays.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind) if n else np.zeros(0, kind))
        at += n * kind.itemsize
    return arrays


def steps(ascending: np.ndarray) -> np.ndarray:
    """Differences, which pack better."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


# --- blocks ---------------------------------------------------------------------


@dataclass
class Block:
    """Documents in order: their tokens, one after the other, as ranks of the block's words by frequency.

    ``by_hash`` lists these ranks in the order of the words' scrambled hashes, in which the counts of words come back.
    """

    doc_ids: np.ndarray
    has_id: np.ndarray
    trains: np.ndarray
    held_out: np.ndarray
    lengths: np.ndarray
    tokens: np.ndarray
    by_hash: np.ndarray

    def packed(self) -> bytes:
        return pack(self.doc_ids.view(np.uint64), self.has_id, self.trains, self.held_out, self.lengths, self.tokens, self.by_hash)

    @classmethod
    def of(cls, packed: bytes) -> Block:
        ids, has_id, trains, held_out, lengths, tokens, by_hash = unpack(packed)
        return cls(ids.astype(np.uint64).view(np.int64), has_id.astype(bool), trains.astype(bool), held_out.astype(bool), lengths.astype(np.int64), tokens, by_hash)


def blocks_of(docs: DataFrame, trains: Column, held_out: Column, id_column: str, text_column: str) -> DataFrame:
    """One row per block, ``n_docs``, ``n_tokens``, ``n_words`` and ``payload``; ``words`` has the hashes and counts of its words."""
    schema = pa.schema([("block", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_words", pa.int64()), ("payload", pa.binary()), ("words", pa.binary())])

    def run(batches: common.Batches) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 32)
        words: defaultdict[bytes, int] = defaultdict(count().__next__)
        docs, tokens, held = [], [], 0

        def flush() -> pa.RecordBatch:
            ids, train, out = zip(*docs, strict=True)
            lengths, found = np.array([len(t) for t in tokens], dtype=np.int64), np.concatenate(tokens)
            hashes = mix(np.fromiter(map(hash_of, words), np.uint64, len(words)))
            n_all = np.bincount(found, minlength=len(words))
            n_train = np.bincount(found, weights=np.repeat(np.array(train), lengths), minlength=len(words)).astype(np.int64)
            rank = np.empty(len(words), dtype=np.uint32)
            rank[np.argsort(-n_all, kind="stable")] = np.arange(len(words), dtype=np.uint32)
            order = np.argsort(hashes, kind="stable")
            block = Block(np.array([i or 0 for i in ids], dtype=np.int64), np.array([i is not None for i in ids]), np.array(train), np.array(out), lengths, rank[found], rank[order])
            row = (next(number), len(docs), held, len(words), block.packed(), pack(hashes[order], n_train[order], n_all[order]))
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_id, train, out, text in zip(*batch.columns, strict=True):
                found = (text.as_py() or b"").translate(TO_LOWER).split()
                found.append(END)
                tokens.append(np.fromiter(map(words.__getitem__, found), np.uint32, len(found)))
                docs.append((doc_id.as_py(), train.as_py(), out.as_py()))
                held += len(found)
                if held >= BLOCK_TOKENS:
                    yield flush()
                    words, docs, tokens, held = defaultdict(count().__next__), [], [], 0
        if docs:
            yield flush()

    text = F.encode(F.col(text_column), "utf-8").alias("text")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), trains.alias("trains"), held_out.alias("held_out"), text)
    return rows.mapInArrow(run, "block long, n_docs long, n_tokens long, n_words long, payload binary, words binary")


# --- the model -------------------------------------------------------------------


@dataclass(frozen=True)
class Level:
    """What is known of an order as a whole: tokens, different n-grams, those of count 1, 2, ... and the factors of counts 0 to ``LIMIT``."""

    total: int
    types: int
    ones: tuple[int, ...]
    discounts: tuple[float, ...]

    def kept(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return counts * np.array([*self.discounts, 1.0])[np.minimum(counts, LIMIT + 1).astype(np.int64)]

    def spread(self, c: np.ndarray, m: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Divisors of contexts with total ``c`` and ``m[j - 1]`` n-grams of count j, and the share taken off."""
        taken = sum(n * (j * (1.0 - self.discounts[j])) for j, n in enumerate(m, 1))
        none = taken <= 0
        divisor = c + none
        return divisor, np.where(none, 1.0, taken) / divisor


def good_turing(counts: Sequence[int]) -> tuple[float, ...]:
    """Factors of counts 0 to ``LIMIT``, from the numbers of n-grams with counts 1 to ``LIMIT + 1``.

    The limit is lowered until all factors are valid; if none are, half a count is taken off.
    """
    for k in range(LIMIT, 0, -1):
        n = [0, *counts[: k + 1]]
        if min(n[1:]) <= 0:
            continue
        common_part = (k + 1) * n[k + 1] / n[1]
        if common_part >= 1:
            continue
        factors = [((j + 1) * n[j + 1] / (j * n[j]) - common_part) / (1 - common_part) for j in range(1, k + 1)]
        if all(0 < d < 1 for d in factors):
            return (0.0, *factors, *[1.0] * (LIMIT - k))
    return (0.0, *[(j - 0.5) / j for j in range(1, LIMIT + 1)])


@dataclass
class Tokens:
    """Per token of a block: how often its n-gram occurs in training and in all texts, its number, and its probability.

    The number is 0 for n-grams that were not seen; ``rank`` orders the tokens by the numbers of their words.
    """

    count: np.ndarray
    all: np.ndarray
    number: np.ndarray
    probability: np.ndarray
    rank: np.ndarray | None = None


@dataclass
class Ngrams:
    """A block's distinct n-grams of an order, sorted by bucket, context and word; ``of[i]`` is that of the i-th used token."""

    used: np.ndarray
    of: np.ndarray
    bucket: np.ndarray
    context: np.ndarray
    word: np.ndarray
    lower: np.ndarray
    n_train: np.ndarray
    n_all: np.ndarray
    is_split: np.ndarray

    def starts(self) -> np.ndarray:
        """Where a new context begins, or its part in another bucket."""
        return starts_of(self.bucket, self.context)


def ngrams_of(block: Block, words: Tokens, before: Tokens, n_docs: int, buckets: int) -> Ngrams:
    """All n-grams whose context was seen in training; ``before`` is what the order below gave. Unknown words are one word."""
    first = np.cumsum(block.lengths) - block.lengths
    seen, often, context = np.roll(before.count, 1), np.roll(before.all, 1), np.roll(before.number, 1)
    # start marks alone have the number 0; a token follows them in every document
    seen[first], often[first], context[first] = 1, n_docs, 0
    used = np.flatnonzero(seen > 0)
    context, word = context[used], words.number[used]
    parts = (1 + often[used] // HOT).astype(np.uint64)
    place = bucket_of(mix(context.astype(np.uint64) + mix(word.astype(np.uint64)) % parts * MIX_3), buckets) << np.uint64(NUMBER_BITS)
    places, at = np.unique(place | context.astype(np.uint64), return_inverse=True)
    keys, of = np.unique(at << 32 | words.rank[used], return_inverse=True)
    place, n = places[keys >> 32], len(keys)
    lower, number, is_split = np.empty(n), np.empty(n, dtype=np.int64), np.empty(n, dtype=bool)
    # the same for all tokens of an n-gram
    lower[of], number[of], is_split[of] = before.probability[used], word, parts > 1
    n_train = np.bincount(of, weights=np.repeat(block.trains, block.lengths)[used], minlength=n).astype(np.int64)
    ids = (place & np.uint64((1 << NUMBER_BITS) - 1)).astype(np.int64)
    return Ngrams(used, of, (place >> np.uint64(NUMBER_BITS)).astype(np.int64), ids, number, lower, n_train, np.bincount(of, minlength=n), is_split)


def starts_of(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new key begins."""
    n = len(sorted_keys[0])
    fresh = np.zeros(n, dtype=bool)
    fresh[:1] = True
    for key in sorted_keys:
        fresh[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(fresh)


def slices(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The buckets that occur in the ascending list, and where."""
    cuts = np.searchsorted(bucket, np.arange(buckets + 1)).tolist()
    for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if y > x:
            yield k, slice(x, y)


def word_questions(block_id: int, packed_words: bytes, buckets: int) -> list[dict]:
    hashes, n_train, n_all = unpack(packed_words)
    hashes = hashes.astype(np.uint64)
    return [
        {"block": block_id, "level": 1, "bucket": k, "payload": pack(hashes[at], n_train[at], n_all[at])}
        for k, at in slices(bucket_of(hashes, buckets).astype(np.int64), buckets)
    ]


def questions(block_id: int, level: int, found: Ngrams, buckets: int, is_last: bool) -> list[dict]:
    """A row per bucket with the block's n-grams there. After one word, the shorter probability depends on the next word alone."""
    rows = []
    for k, at in slices(found.bucket, buckets):
        starts = starts_of(found.context[at])
        words, first, word = np.unique(found.word[at], return_index=True, return_inverse=True)
        lowers, lower = np.unique(found.lower[at][first] if level == 2 else found.lower[at], return_inverse=True)
        n_all = np.zeros(0, dtype=np.int64) if is_last else found.n_all[at]
        lengths = np.diff(np.append(starts, len(word)))
        payload = pack(steps(found.context[at][starts]), lengths, found.is_split[at][starts], steps(words), word, lowers, lower, found.n_train[at], n_all)
        rows.append({"block": block_id, "level": level, "bucket": k, "payload": payload})
    return rows


def numbers(r: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """Numbers of the seen n-grams of a bucket that no other bucket gives, small for frequent ones; 0 for the unseen."""
    found = np.zeros(len(r), dtype=np.int64)
    order = np.argsort(-r, kind="stable")
    found[order] = np.arange(len(r)) * buckets + bucket + 1
    if len(r) * buckets >= 1 << NUMBER_BITS or buckets > 1 << BUCKET_BITS:
        raise ValueError(f"more than {1 << NUMBER_BITS} n-grams or {1 << BUCKET_BITS} buckets")
    return np.where(r > 0, found, 0)


def totals(level: int, r: np.ndarray) -> dict:
    return {"level": level, "bucket": TOTALS, "m": [int(r.sum()), int((r > 0).sum()), *[int((r == j).sum()) for j in range(1, LIMIT + 2)]]}


def groups_of(order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Number of the group of each row, where ``order`` sorts the rows and the groups begin at ``starts``."""
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    return group


def word_answers(bucket: int, buckets: int, asked: list[tuple[int, bytes]]) -> Iterator[dict]:
    """Counts and numbers of the words of a bucket, handed back to the blocks that asked."""
    parts = [unpack(p) for _, p in asked]
    word = np.concatenate([p[0].astype(np.uint64) for p in parts])
    order = np.argsort(word, kind="stable")
    starts = starts_of(word[order])
    r, a = (np.add.reduceat(np.concatenate([p[k].astype(np.int64) for p in parts])[order], starts) for k in (1, 2))
    number, group, at = numbers(r, bucket, buckets), groups_of(order, starts), 0
    for (block_id, _), p in zip(asked, parts, strict=True):
        mine = group[at : at + len(p[0])]
        at += len(p[0])
        yield {"block": block_id, "level": 1, "bucket": bucket, "payload": pack(r[mine], a[mine], number[mine])}
    yield totals(1, r)


def answers(level: int, bucket: int, buckets: int, asked: list[tuple[int, bytes]], is_last: bool) -> Iterator[dict]:
    """The part of the n-gram table in a bucket, handed back to the blocks that asked."""
    parts = [unpack(p) for _, p in asked]
    heads_of = [np.cumsum(p[0].astype(np.int64)) for p in parts]
    context = np.concatenate([np.repeat(h, p[1].astype(np.int64)) for h, p in zip(heads_of, parts, strict=True)])
    word = np.concatenate([np.cumsum(p[3].astype(np.int64))[p[4]] for p in parts])
    lower = np.concatenate([p[5][p[6]][p[4]] if level == 2 else p[5][p[6]] for p in parts])
    order = np.lexsort((word, context))
    starts = starts_of(context[order], word[order])
    r = np.add.reduceat(np.concatenate([p[7].astype(np.int64) for p in parts])[order], starts)
    group = groups_of(order, starts)
    # per context: total, probability of the seen words when backed off, n-grams of count 1, 2, ...
    own, lower = context[order][starts], lower[order][starts]
    heads = starts_of(own)
    keys = own[heads]
    c, low = np.add.reduceat(r, heads), np.add.reduceat(np.where(r > 0, lower, 0.0), heads)
    m = [np.add.reduceat((r == j).astype(np.int64), heads) for j in range(1, LIMIT + 1)]
    if is_last:
        a = number = np.zeros(len(r), dtype=np.int64)
    else:
        a, number = np.add.reduceat(np.concatenate([p[8].astype(np.int64) for p in parts])[order], starts), numbers(r, bucket, buckets)
    at, split_contexts = 0, {}
    for (block_id, _), h, p in zip(asked, heads_of, parts, strict=True):
        mine = group[at : at + len(p[7])]
        at += len(p[7])
        k = np.searchsorted(keys, h)
        # the sum is only needed where the block has a word that was not seen after the context
        backs_off = np.add.reduceat(r[mine] == 0, np.cumsum(p[1].astype(np.int64)) - p[1]) > 0
        payload = pack(r[mine], a[mine], number[mine], c[k], np.where(backs_off, low[k], 0.0), *[x[k] for x in m])
        yield {"block": block_id, "level": level, "bucket": bucket, "payload": payload}
        for where in k[p[2].astype(bool)].tolist():
            split_contexts[where] = int(keys[where])
            yield {"block": block_id, "level": level, "bucket": HOT_WANTED, "ctx": int(keys[where])}
    for where, ctx in split_contexts.items():
        yield {"level": level, "bucket": HOT_PART, "ctx": ctx, "c": int(c[where]), "low": float(low[where]), "m": [int(x[where]) for x in m]}
    yield totals(level, r)


def unpacked(answered: list[bytes], n: int) -> list[np.ndarray]:
    """The n arrays of all buckets, put together."""
    parts = [unpack(p) for p in answered]
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, dtype=np.int64) for k in range(n)]


def evaluate_words(block: Block, answered: list[bytes], model: Level) -> Tokens:
    found = [np.empty(len(block.by_hash), dtype=np.int64) for _ in range(3)]
    for a, values in zip(found, unpacked(answered, 3), strict=True):
        a[block.by_hash] = values
    r, a, number = found
    divisor, rest = model.spread(np.float64(model.total), [np.float64(n) for n in model.ones])
    p = np.where(r > 0, model.kept(r) / divisor, rest) if model.total else np.ones(len(r))
    rank = np.searchsorted(np.unique(number), number)
    return Tokens(*(x[block.tokens] for x in (r, a, number, p, rank)))


def evaluate(block: Block, found: Ngrams, before: Tokens, answered: list[bytes], hot: list[dict], model: Level) -> Tokens:
    """One step of the recursion: probabilities of an order from those of the order below."""
    r, a, number, c, low, *m = unpacked(answered, 5 + LIMIT)
    starts = found.starts()
    r, c, m = r.astype(np.int64), c.astype(np.float64), [x.astype(np.float64) for x in m]
    by_context = {h["ctx"]: h for h in hot}
    for k in np.flatnonzero(found.is_split[starts]).tolist():
        h = by_context[int(found.context[starts[k]])]
        c[k], low[k] = h["c"], h["low"]
        for x, n in zip(m, h["m"], strict=True):
            x[k] = n
    divisor, rest = model.spread(c, m)
    weight = rest / np.maximum(1.0 - low, 1e-12)
    lengths = np.diff(np.append(starts, len(r)))
    p = np.where(r > 0, model.kept(r) / np.repeat(divisor, lengths), np.repeat(weight, lengths) * found.lower)
    # before the first word of a corpus without training texts nothing was seen
    p = np.where(np.repeat(c, lengths) > 0, p, found.lower)
    out = Tokens(*(np.zeros(len(block.tokens), dtype=np.int64) for _ in range(3)), before.probability.copy())
    for whole, values in ((out.count, r), (out.all, a), (out.number, number), (out.probability, p)):
        whole[found.used] = values[found.of]
    return out


# --- the job ----------------------------------------------------------------------


def rows_table(rows: list[dict]) -> pa.Table:
    return pa.table({f.name: pa.array([r.get(f.name) for r in rows], f.type) for f in ROW_SCHEMA}, schema=ROW_SCHEMA)


def read_block(table: pa.Table, models: Sequence[Level], n_docs: int, buckets: Sequence[int]) -> tuple[int, Block, list[Tokens]]:
    """A block with all that came back to it, evaluated order by order up to the last of ``models``."""
    block, answered, hot = None, defaultdict(list), defaultdict(list)
    for r in table.to_pylist():
        if r["level"] == 0:
            block = Block.of(r["payload"])
        elif r["bucket"] >= 0:
            answered[r["level"]].append((r["bucket"], r["payload"]))
        else:
            hot[r["level"]].append(r)
    back = {level: [p for _, p in sorted(rows)] for level, rows in answered.items()}
    tokens = [evaluate_words(block, back[1], models[0])]
    for level, model in enumerate(models[1:], 2):
        found = ngrams_of(block, tokens[0], tokens[-1], n_docs, buckets[level - 1])
        tokens.append(evaluate(block, found, tokens[-1], back.get(level, []), hot[level], model))
    return table.column("block")[0].as_py(), block, tokens


def ask_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """Single words need nothing but the blocks."""

    def run(batches: common.Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block_id, words in zip(*batch.columns, strict=True):
                yield from rows_table(word_questions(block_id.as_py(), words.as_py(), buckets)).to_batches()

    return blocks.select("block", "words").mapInArrow(run, ROW)


def ask(gathered: DataFrame, models: Sequence[Level], n_docs: int, buckets: Sequence[int], is_last: bool) -> DataFrame:
    level = len(models) + 1

    def run(table: pa.Table) -> pa.Table:
        block_id, block, tokens = read_block(table, models, n_docs, buckets)
        return rows_table(questions(block_id, level, ngrams_of(block, tokens[0], tokens[-1], n_docs, buckets[-1]), buckets[-1], is_last))

    return gathered.groupBy("block").applyInArrow(run, ROW)


def answer(asked: DataFrame, level: int, buckets: int, is_last: bool) -> DataFrame:
    """Buckets come together one at a time."""

    def run(batches: common.Batches) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def finish() -> Iterator[pa.RecordBatch]:
            found = word_answers(current, buckets, held) if level == 1 else answers(level, current, buckets, held, is_last)
            yield from rows_table(list(found)).to_batches()

        for batch in batches:
            for bucket, block, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != current and held:
                    yield from finish()
                    held = []
                current = bucket
                held.append((block, payload))
        if held:
            yield from finish()

    return asked.select("bucket", "block", "payload").repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(run, ROW)


def split_contexts(answered: DataFrame) -> DataFrame:
    """The sums of contexts that are split over buckets, for the blocks that have them; Spark joins them by size."""
    hot = answered.where(F.col("bucket") == HOT_PART)
    sums = hot.groupBy("ctx").agg(
        F.sum("c").alias("c"),
        # added in order of size, so that reruns agree to the last bit; as many as the context has parts
        F.expr("aggregate(array_sort(collect_list(low)), 0D, (s, x) -> s + x)").alias("low"),
        F.array(*[F.sum(F.get("m", F.lit(j))) for j in range(LIMIT)]).alias("m"),
    )
    wanted = answered.where(F.col("bucket") == HOT_WANTED).select("block", "level", "ctx").distinct()
    return wanted.join(sums, "ctx").select("block", "level", F.lit(HOT_PART).alias("bucket"), F.lit(None).cast("binary").alias("payload"), "ctx", "c", "low", "m")


def model_of(answered: DataFrame) -> Level:
    """Totals of an order: a few numbers."""
    sums = answered.where(F.col("bucket") == TOTALS).agg(*[F.sum(F.get("m", F.lit(i))).alias(f"s{i}") for i in range(LIMIT + 3)]).first()
    total, types, *ones = (int(x or 0) for x in sums)
    return Level(total, types, tuple(ones[:LIMIT]), good_turing(ones))


def score_texts(
    docs: DataFrame, trains: Column, held_out: Column, order: int = ORDER, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``trains`` says whose texts the model learns from; ``base_score`` is that of single words with one added to each count.
    """
    blocks = stage(blocks_of(docs, F.coalesce(trains, F.lit(False)), F.coalesce(held_out, F.lit(False)), id_column, text_column), "token-blocks")
    n_docs, n_tokens, n_words = (int(x or 0) for x in blocks.agg(F.sum("n_docs"), F.sum("n_tokens"), F.sum("n_words")).first())
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("ctx", "long"), ("c", "long"), ("low", "double"), ("m", "array<long>"))]
    gathered = blocks.select("block", F.lit(0).alias("level"), F.lit(0).alias("bucket"), "payload", *nothing)
    models: list[Level] = []
    buckets: list[int] = []
    for level in range(1, order + 1):
        is_last = level == order
        buckets.append(max(1, math.ceil((n_words if level == 1 else n_tokens) / BUCKET_NGRAMS)))
        asked = ask_words(blocks, buckets[0]) if level == 1 else ask(gathered, models, n_docs, buckets, is_last)
        answered = stage(answer(asked, level, buckets[-1], is_last), "ngram-counts")
        models.append(model_of(answered))
        gathered = gathered.unionByName(answered.where("bucket >= 0")).unionByName(split_contexts(answered))
    words = models[0]

    def run(table: pa.Table) -> pa.Table:
        _, block, tokens = read_block(table, models, n_docs, buckets)
        single = tokens[0].count
        starts = np.cumsum(block.lengths) - block.lengths
        base = np.log10((single + 1) / (words.total + 1 * (words.types + 1)))
        columns = (
            pa.array(block.doc_ids, mask=~block.has_id), pa.array(block.held_out), pa.array(block.lengths), pa.array(np.add.reduceat((single > 0).astype(np.int64), starts)),
            pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(np.log10(tokens[-1].probability), starts)),
        )
        return pa.Table.from_arrays(list(columns), schema=SCORES)

    scored = gathered.groupBy("block").applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(words.total).cast("long").alias("train_tokens"), "base_score", "score")
