"""Operator 13: alignment of two tokenizers over a corpus, with counts of the id pairs they link.

Both token sequences of a text cover the same bytes. Offsets where a token of either ends cut the
text into stretches that lie in one token of each: the links. Offsets where both end are the ends of
groups. How often an id pair is linked in the whole corpus is counted without a table of pairs in
any one place:

1. Texts are encoded once, block by block, and stored as ids with the block's distinct pairs.
2. Pairs belong to slices by their second id, so all partners of an id are in one slice. A slice's
   distinct keys, merged in a tree over the tasks, get a minimal perfect hash: levels of bits of
   which a key takes the first that it has alone, so that a key's index is the rank of its bit.
3. Counts are dense vectors over that index, one for each slice and group of tasks, summed in a tree.
   The keys stored in index order verify every look-up.
4. Blocks ask the slices for their distinct pairs, salted by block, and the second pass aligns the
   stored ids again and looks the answers up.

Memory is bounded by a block, a task's distinct pairs and a slice's distinct pairs (at most its ids
times the other vocabulary). Nothing is broadcast, and nothing goes to the driver but two numbers.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from adlumen.llm import common as c
from adlumen.llm.tokens import Encoder, _only_single_spaces

BLOCK_BYTES = 1 << 20
CACHE = 300_000
CACHED_CHARS = 48
# Distinct pairs a task holds before it sends them.
HELD = 2_000_000
# Rows of one slice that a task of the tree takes in.
FAN = 64
_SHIFT = 32
# A cut before a space, with no white space on either side. No pre-token of the first vocabulary and
# no piece of the second goes over it.
_CUT = re.compile(r"(?<=\S)(?= \S)")


def segments(text: str) -> list[str]:
    """The text after a space, cut where tokens of either vocabulary have to end."""
    if text and _only_single_spaces(text):
        return [" " + word for word in text.split(" ")]
    return _CUT.split(" " + text)


def _per_text(values: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Sums of values up to each end from the one before."""
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return np.diff(np.append(0, total[to]))


class Both:
    """The two tokenizers: a byte-level one by its ranks, and one of pieces with byte fallback.

    Strings of special tokens in a text are plain text to both.
    """

    def __init__(self, left: str, right: str):
        self.left = Encoder(public_tokenizers.path(f"{left}.tiktoken"), public_tokenizers.PATTERN, {})
        self.right = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{right}.model"))
        pieces = [self.right.id_to_piece(k) for k in range(self.right.get_piece_size())]
        if any(re.search("[^▁]▁", x) for x in pieces):
            raise ValueError(f"{right} has pieces that go on after a word's end")
        self.left_bytes = [self.left.model.decode_single_token_bytes(k) for k in range(self.left.model.n_vocab)]
        self.right_bytes = [bytes([int(x[3:5], 16)]) if self.right.is_byte(k) else x.replace("▁", " ").encode() for k, x in enumerate(pieces)]
        self.left_size = np.array([len(x) for x in self.left_bytes], np.int64)
        self.right_size = np.array([len(x) for x in self.right_bytes], np.int64)
        self.forget()

    def forget(self) -> None:
        """Drop the remembered segments."""
        # Place of each segment; its ids by either stand one after another from its start on.
        self.seen: dict[str, int] = {}
        self.ids = [np.zeros(0, np.uint32), np.zeros(0, np.uint32)]
        self.starts = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.covered = np.zeros(0, bool)

    def _covers(self, raw: bytes, a: Iterable[int], b: Iterable[int]) -> bool:
        """Whether the tokens of either give the bytes of a space and the text."""
        return b"".join(map(self.left_bytes.__getitem__, a)) == raw and b"".join(map(self.right_bytes.__getitem__, b)) == raw

    def _learn(self, parts: list[str]) -> None:
        raw = [x.encode() for x in parts]
        found = [self.left.model.encode_ordinary(x) for x in parts], self.right.encode([x[1:] for x in parts], num_threads=1)
        whole = self._covers(b"".join(raw), chain.from_iterable(found[0]), chain.from_iterable(found[1]))
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        for k, size in enumerate((self.left_size, self.right_size)):
            counts = np.fromiter(map(len, found[k]), np.int64, len(parts))
            ids = np.fromiter(chain.from_iterable(found[k]), np.uint32, int(counts.sum()))
            whole = whole and np.array_equal(_per_text(size[ids], np.cumsum(counts)), lengths)
            self.starts[k] = np.append(self.starts[k], self.starts[k][-1] + np.cumsum(counts))
            self.ids[k] = np.append(self.ids[k], ids)
        self.covered = np.append(self.covered, np.full(len(parts), True) if whole else [self._covers(*x) for x in zip(raw, *found)])
        self.seen.update(zip(parts, range(len(self.seen), len(self.seen) + len(parts))))

    def _joined(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ids of the segments at these places, one after another."""
        starts = self.starts[k][at]
        counts = self.starts[k][at + 1] - starts
        ends = np.cumsum(counts)
        return self.ids[k][np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts by both as 32-bit numbers, and how many each text has of either; none
        for a text that either does not cover."""
        if len(self.seen) >= CACHE:
            self.forget()
        cut = [segments(x) if x else [] for x in texts]
        new = sorted({s for one in cut for s in one} - self.seen.keys(), key=lambda s: len(s) > CACHED_CHARS)
        for k in range(0, len(new), 10_000):
            self._learn(new[k : k + 10_000])
        to = np.append(0, np.cumsum([len(x) for x in cut], dtype=np.int64))
        at = np.fromiter(map(self.seen.__getitem__, chain.from_iterable(cut)), np.int64, int(to[-1]))
        covers = _per_text(~self.covered[at], to[1:]) == 0
        for k in np.flatnonzero(~covers).tolist():
            one = at[to[k] : to[k + 1]]
            covers[k] = self._covers(b" " + texts[k].encode(), self._joined(0, one).tolist(), self._joined(1, one).tolist())
        kept = np.repeat(covers, np.diff(to))
        sizes = [_per_text((starts[at + 1] - starts[at]) * kept, to[1:]) for starts in self.starts]
        a, b = (self._joined(k, at[kept]) for k in range(2))
        # Long segments are not remembered; they were learnt last.
        long = sum(len(s) > CACHED_CHARS for s in new)
        if long:
            for s in new[-long:]:
                del self.seen[s]
            self.covered = self.covered[:-long].copy()
            self.starts = [x[:-long].copy() for x in self.starts]
            self.ids = [x[: starts[-1]].copy() for x, starts in zip(self.ids, self.starts)]
        return a, b, np.stack(sizes, axis=1)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """The same as bytes of each text."""
        a, b, sizes = self.encode_all(texts)
        to = np.cumsum(sizes, axis=0)
        return [(a[x - n : x].tobytes(), b[y - m : y].tobytes()) for (x, y), (n, m) in zip(to.tolist(), sizes.tolist())]


_both: dict[tuple[str, str], Both] = {}


def both(left: str, right: str) -> Both:
    if (left, right) not in _both:
        _both[left, right] = Both(left, right)
    return _both[left, right]


def aligned(a_size: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of two sequences of token sizes over the same bytes: the token of either that each lies
    in, whether a group ends with it, and the offset where it ends."""
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    # Bit 0: a token of the first ends here, bit 1: one of the second.
    marks = np.zeros(int(a_end[-1]) + 1 if len(a_end) else 0, np.uint8)
    marks[a_end] = 1
    marks[b_end] += 2
    ends = np.flatnonzero(marks)
    marks = marks[ends]
    a, b = marks & 1, marks >> 1
    return np.cumsum(a, dtype=np.int64) - a, np.cumsum(b, dtype=np.int64) - b, marks == 3, ends


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, np.diff(keys) != 0))
    return keys[first], np.add.reduceat(counts, first)


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys, by levels of bits.

    At a level each key that is left hashes to one of as many bits as there are keys left. A bit
    that one key alone hashes to is that key's; the others go on to the next level. A key's index is
    the number of bits set before its own, over all levels. Absent keys get any index or -1, which
    is why look-ups compare the stored key.
    """

    LEVELS = 48

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, total = [], 0
        for bits in levels:
            self.ranks.append(total + np.cumsum(bits, dtype=np.int64) - bits)
            total += int(bits.sum())
        self.size = total

    @staticmethod
    def _place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        return (c.mix(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) % np.uint64(bits)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        for level in range(cls.LEVELS):
            if not len(left):
                break
            size = len(left) if len(left) > 1 else 1
            place = cls._place(left, level, size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[place]]
        if len(left):
            raise ValueError("keys that share all their bits; they were to be distinct")
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            if not len(left):
                break
            place = self._place(keys[left], level, len(bits))
            has = bits[place]
            out[left[has]] = rank[place[has]]
            left = left[~has]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], np.int64)
        return head.tobytes() + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        levels, at = [], 8 * (n + 1)
        for size in np.frombuffer(raw, np.int64, n, 8).tolist():
            width = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, width, at), count=size).astype(bool))
            at += width
        return cls(levels)


def _packed(values: np.ndarray) -> bytes:
    return c.compress(c.pack(values)) if len(values) else b""


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    return c.unpack(c.decompress(raw), kind) if raw else np.zeros(0, kind)


BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("known", pa.binary()), ("sizes", pa.binary()), ("a", pa.binary()), ("b", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary())])
BLOCKS_SQL = "block long, ids binary, known binary, sizes binary, a binary, b binary, keys binary, counts binary"


def blocks(texts: DataFrame, left: str, right: str) -> DataFrame:
    """Texts ``(id, text)`` as ids of both vocabularies, a row for each block, with its pairs."""

    def one_block(number: int, ids: pa.Array, texts: list[str | None], model: Both) -> dict:
        a, b, sizes = model.encode_all([x or "" for x in texts])
        at, bt, _, _ = aligned(model.left_size[a], model.right_size[b])
        keys, counts = summed((b[bt].astype(np.int64) << _SHIFT) | a[at], np.ones(len(at), np.int64))
        return {
            "block": number, "ids": _packed(ids.fill_null(0).to_numpy()), "known": _packed(ids.is_valid().to_numpy(zero_copy_only=False)), "sizes": _packed(sizes.reshape(-1)),
            "a": _packed(a), "b": _packed(b), "keys": _packed(keys), "counts": _packed(counts),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = both(left, right)
        number = TaskContext.get().partitionId() << 32
        for one in batches:
            offsets, _ = c.bytes_column(one.column("text"))
            for first, last in c.chunks(offsets, BLOCK_BYTES):
                row = one_block(number, one.column("id")[first:last], one.column("text")[first:last].to_pylist(), model)
                number += 1
                yield c.batch({k: [v] for k, v in row.items()}, BLOCKS)
        # The worker may live on for the second pass, which encodes nothing.
        model.forget()

    return texts.mapInArrow(run, BLOCKS_SQL)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, so that only one is held as Python objects."""
    for one in batches:
        columns = list(zip(one.schema.names, one.columns))
        for k in range(one.num_rows):
            yield {name: column[k].as_py() for name, column in columns}


def _by(frame: DataFrame, parts: int, keys: list[str], order: list[str], make: Callable[[tuple, Iterator[dict]], Iterator[dict]], schema: pa.Schema, sql: str) -> DataFrame:
    """``make`` over the rows of each key, which come one at a time and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in groupby(_rows(batches), key=lambda r: tuple(r[k] for k in keys)):
            for row in make(key, rows):
                yield c.batch({k: [v] for k, v in row.items()}, schema)

    return frame.repartition(parts, *keys).sortWithinPartitions(*keys, *order).mapInArrow(run, sql)


def _upto(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    return (c.mix((keys >> _SHIFT).astype(np.uint64) + np.uint64(1)) % np.uint64(slices)).astype(np.int32)


PAIRS = pa.schema([("slice", pa.int32()), ("part", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
PAIRS_SQL = "slice int, part long, keys binary, counts binary"


def task_pairs(made: DataFrame, slices: int) -> DataFrame:
    """Distinct pairs of all blocks of a task, a row for each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, size = [], 0

        def send() -> Iterator[pa.RecordBatch]:
            keys, counts = summed(*(np.concatenate(x) for x in zip(*held)))
            for number, at in c.by_part(slice_of(keys, slices)):
                yield c.batch({"slice": [number], "part": [part], "keys": [_packed(keys[at])], "counts": [_packed(counts[at])]}, PAIRS)

        for row in _rows(batches):
            held.append((_unpacked(row["keys"], np.int64), _unpacked(row["counts"], np.int64)))
            size += len(held[-1][0])
            if size > HELD:
                held = [summed(*(np.concatenate(x) for x in zip(*held)))]
                size = len(held[0][0])
                if size > HELD:
                    yield from send()
                    held, size = [], 0
        if held:
            yield from send()

    return made.select("keys", "counts").mapInArrow(run, PAIRS_SQL)


FUNCTIONS = pa.schema([("slice", pa.int32()), ("hash", pa.binary()), ("keys", pa.binary())])
FUNCTIONS_SQL = "slice int, hash binary, keys binary"
VECTORS = pa.schema([("slice", pa.int32()), ("part", pa.int64()), ("counts", pa.binary())])
VECTORS_SQL = "slice int, part long, counts binary"


def functions(pairs: DataFrame, parts: int, tasks: int) -> DataFrame:
    """A perfect hash of each slice's distinct keys, and the keys in the order of their index."""

    def merged(rows: Iterator[dict]) -> np.ndarray:
        keys = np.zeros(0, np.int64)
        for row in rows:
            keys = np.union1d(keys, _unpacked(row["keys"], np.int64))
        return keys

    def level(key: tuple, rows: Iterator[dict]) -> Iterator[dict]:
        yield {"slice": key[0], "part": key[1], "keys": _packed(merged(rows)), "counts": b""}

    def last(key: tuple, rows: Iterator[dict]) -> Iterator[dict]:
        keys = merged(rows)
        function = PerfectHash.build(keys)
        ordered = np.empty_like(keys)
        ordered[function.index(keys)] = keys
        yield {"slice": key[0], "hash": c.compress(function.to_bytes()), "keys": _packed(ordered)}

    keys = pairs.select("slice", "part", "keys")
    while tasks > FAN:
        tasks = -(-tasks // FAN)
        keys = _by(keys.withColumn("part", F.floor(F.col("part") / FAN)), parts, ["slice", "part"], [], level, PAIRS, PAIRS_SQL).select("slice", "part", "keys")
    return _by(keys, parts, ["slice"], [], last, FUNCTIONS, FUNCTIONS_SQL)


def vectors(pairs: DataFrame, made: DataFrame, parts: int, tasks: int) -> DataFrame:
    """Each slice's dense count vector, as a sum over a tree of dense vectors."""

    def first(key: tuple, rows: Iterator[dict]) -> Iterator[dict]:
        function = next(rows)  # the row without counts comes first
        hashed, keys = PerfectHash.from_bytes(c.decompress(function["hash"])), _unpacked(function["keys"], np.int64)
        total = np.zeros(hashed.size, np.int64)
        for row in rows:
            asked = _unpacked(row["keys"], np.int64)
            at = hashed.index(asked)
            if not np.array_equal(keys[at], asked):
                raise ValueError("a pair is not where its hash says")
            total[at] += _unpacked(row["counts"], np.int64)
        yield {"slice": key[0], "part": key[1], "counts": _packed(total)}

    def add(key: tuple, rows: Iterator[dict]) -> Iterator[dict]:
        total = _unpacked(next(rows)["counts"], np.int64).copy()
        for row in rows:
            total += _unpacked(row["counts"], np.int64)
        yield {"slice": key[0], "part": key[1], "counts": _packed(total)}

    groups = -(-tasks // FAN)
    copies = made.select("slice", F.explode(_upto(groups)).alias("part"), F.lit(0).alias("kind"), "hash", "keys", F.lit(None).cast("binary").alias("counts"))
    grouped = pairs.select("slice", F.floor(F.col("part") / FAN).alias("part"), F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("hash"), "keys", "counts")
    # A group of tasks may hold no pair of a slice; its vector is then all zero.
    out = _by(copies.unionByName(grouped), parts, ["slice", "part"], ["kind"], first, VECTORS, VECTORS_SQL)
    while groups > 1:
        groups = -(-groups // FAN)
        out = _by(out.withColumn("part", F.floor(F.col("part") / FAN)), parts, ["slice", "part"], [], add, VECTORS, VECTORS_SQL)
    return out


def highest(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether each pair's count is the highest among the pairs of its second id."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    owner = (keys >> _SHIFT)[order]
    first = np.flatnonzero(np.append(True, np.diff(owner) != 0))
    most = np.repeat(np.maximum.reduceat(counts[order], first), np.diff(np.append(first, len(keys))))
    out = np.empty(len(keys), bool)
    out[order] = counts[order] == most
    return out


COUNTED_SQL = "slice int, hash binary, keys binary, counts binary, best binary"
COUNTED = pa.schema([("slice", pa.int32()), ("hash", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())])
ANSWERS = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())])
ANSWERS_SQL = "block long, keys binary, counts binary, best binary"


def counted_slices(made: DataFrame, sums: DataFrame) -> DataFrame:
    """Functions and vectors of the slices together, with each pair's mark of being the highest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            best = highest(_unpacked(row["keys"], np.int64), _unpacked(row["counts"], np.int64))
            yield c.batch({k: [v] for k, v in {**row, "best": _packed(best)}.items()}, COUNTED)

    return made.join(sums, "slice").select("slice", "hash", "keys", "counts").mapInArrow(run, COUNTED_SQL)


def answers(made: DataFrame, counted: DataFrame, parts: int, slices: int, salts: int) -> DataFrame:
    """For each block and slice, the corpus counts of the block's pairs."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys = _unpacked(row["keys"], np.int64)
            for number, at in c.by_part(slice_of(keys, slices)):
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([row["block"]], pa.int64()), pa.array([_packed(keys[at])], pa.binary())], ["slice", "block", "keys"])

    def look_up(key: tuple, rows: Iterator[dict]) -> Iterator[dict]:
        head = next(rows)
        hashed, keys = PerfectHash.from_bytes(c.decompress(head["hash"])), _unpacked(head["keys"], np.int64)
        counts, best = _unpacked(head["counts"], np.int64), _unpacked(head["best"], bool)
        for row in rows:
            asked = _unpacked(row["keys"], np.int64)
            at = hashed.index(asked)
            if not np.array_equal(keys[at], asked):
                raise ValueError("a pair is not where its hash says")
            yield {"block": row["block"], "keys": row["keys"], "counts": _packed(counts[at]), "best": _packed(best[at])}

    none = F.lit(None).cast("binary")
    asked = made.select("block", "keys").mapInArrow(ask, "slice int, block long, keys binary").select(
        "slice", F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt"), F.lit(1).alias("kind"), "block", none.alias("hash"), "keys", none.alias("counts"), none.alias("best"))
    known = counted.select("slice", F.explode(_upto(salts)).alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("block"), "hash", "keys", "counts", "best")
    return _by(known.unionByName(asked), parts, ["slice", "salt"], ["kind"], look_up, ANSWERS, ANSWERS_SQL)


def _number_table(n: int) -> np.ndarray:
    """Decimal numbers below n, each with one of the three marks that may follow it."""
    width = len(str(n - 1)) + 1
    return np.array([f"{k}{mark}" for mark in ",|;" for k in range(n)], f"S{width}").reshape(3, n)


def group_texts(a: np.ndarray, b: np.ndarray, links: tuple, sizes: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
    at, bt, cut, _ = links
    # Group of each token: how many groups end before it.
    before = np.cumsum(cut) - cut
    a_group, b_group = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    a_group[at], b_group[bt] = before, before
    a_last, b_last = np.append(np.diff(a_group) != 0, True), np.append(np.diff(b_group) != 0, True)
    # A group's tokens of the first vocabulary come before those of the second.
    a_place = np.arange(len(a)) + np.searchsorted(b_group, a_group, "left")
    b_place = np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")
    width = max(t.dtype.itemsize for t in tables)
    out = np.empty(len(a) + len(b), f"S{width}")
    out[a_place] = tables[0][a_last.astype(np.int64), a]
    out[b_place] = tables[1][2 * b_last.astype(np.int64), b]
    to = np.cumsum(sizes[:, 0] + sizes[:, 1])
    return [out[x:y].tobytes().translate(None, b"\0")[:-1].decode() for x, y in zip(np.append(0, to[:-1]).tolist(), to.tolist())]


RESULT = pa.schema([("doc_id", pa.int64()), *((k, pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups", pa.string())])
RESULT_SQL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def looked_up(made: DataFrame, replies: DataFrame, parts: int, left: str, right: str) -> DataFrame:
    """The second pass: aligns each block's ids again and looks up the counts of its links."""

    def documents(row: dict, keys: np.ndarray, counts: np.ndarray, best: np.ndarray, model: Both, tables: tuple) -> pa.RecordBatch:
        ids, known, sizes = _unpacked(row["ids"], np.int64), _unpacked(row["known"], bool), _unpacked(row["sizes"], np.int64).reshape(-1, 2)
        a, b = _unpacked(row["a"], np.uint32), _unpacked(row["b"], np.uint32)
        a_size = model.left_size[a]
        at, bt, cut, ends = links = aligned(a_size, model.right_size[b])
        to = np.searchsorted(ends, np.append(0, np.cumsum(a_size))[np.cumsum(sizes[:, 0])], "right")
        place = np.searchsorted(keys, (b[bt].astype(np.int64) << _SHIFT) | a[at])
        return pa.RecordBatch.from_arrays([
            pa.array(ids, mask=~known), pa.array(sizes[:, 0]), pa.array(sizes[:, 1]), pa.array(_per_text(cut, to)), pa.array(np.diff(np.append(0, to)).astype(np.int64)),
            pa.array(_per_text(best[place], to)), pa.array(_per_text(counts[place], to)), pa.array(group_texts(a, b, links, sizes, tables), pa.string()),
        ], schema=RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = both(left, right)
        tables = _number_table(len(model.left_size)), _number_table(len(model.right_size))
        for _, rows in groupby(_rows(batches), key=lambda r: r["block"]):
            held = []
            for row in rows:
                if row["kind"] == 0:
                    held.append((_unpacked(row["keys"], np.int64), _unpacked(row["counts"], np.int64), _unpacked(row["best"], bool)))
                    continue
                keys, counts, best = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
                order = np.argsort(keys, kind="stable")
                yield documents(row, keys[order], counts[order], best[order], model, tables)

    none = F.lit(None).cast("binary")
    texts = made.select("block", F.lit(1).alias("kind"), none.alias("keys"), none.alias("counts"), none.alias("best"), "ids", "known", "sizes", "a", "b")
    known = replies.select("block", F.lit(0).alias("kind"), "keys", "counts", "best", *(none.alias(k) for k in ("ids", "known", "sizes", "a", "b")))
    return known.unionByName(texts).repartition(parts, "block").sortWithinPartitions("block", "kind").mapInArrow(run, RESULT_SQL)


def _counted(documents: DataFrame, doc_id: str, text: str, left: str, right: str, slices: int | None) -> tuple[DataFrame, DataFrame, int, int]:
    spark = documents.sparkSession
    c.bound_batches(spark)
    slices = slices or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    made = c.stored(blocks(documents.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")), left, right), "blocks")
    pairs = c.stored(task_pairs(made, slices), "pairs")
    tasks = 1 + (pairs.agg(F.max("part")).first()[0] or 0)
    hashed = c.stored(functions(pairs, slices, tasks), "functions")
    return made, c.stored(counted_slices(hashed, vectors(pairs, hashed, slices, tasks)), "slices"), slices, tasks


def pair_counts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", left: str = "byte_bpe_50k", right: str = "piece_bpe_32k", slices: int | None = None) -> DataFrame:
    """How many links of the corpus hold each id pair: a, b (int), links (long), best (boolean:
    no other partner of b has more). Empty for a table without texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys = _unpacked(row["keys"], np.int64)
            values = (keys & ((1 << _SHIFT) - 1)).astype(np.int32), (keys >> _SHIFT).astype(np.int32), _unpacked(row["counts"], np.int64), _unpacked(row["best"], bool)
            for k in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(v[k : k + 100_000]) for v in values], ["a", "b", "links", "best"])

    counted = _counted(documents, doc_id, text, left, right, slices)[1]
    return counted.select("keys", "counts", "best").mapInArrow(run, "a int, b int, links long, best boolean")


def align(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", left: str = "byte_bpe_50k", right: str = "piece_bpe_32k", slices: int | None = None) -> DataFrame:
    """Alignment of the tokens of two vocabularies over each document.

    ``left`` names a vocabulary of ranks, which encodes a space and the text; ``right`` one of
    pieces, which adds that space itself. Strings of special tokens are plain text. Returns one row
    for each input row: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair has
    the highest count of its second id in the corpus, ties included), count_sum (corpus counts over
    the links, all long), groups (string: ``a1,a2|b1;a3|b2,b3``).

    A null or empty text, and one whose tokens do not give its bytes back (a text that holds U+2581),
    has no tokens: zeros and an empty string. Rows that share an id, or have none, are aligned and
    counted each. An empty table gives an empty result; other columns are not read.
    """
    made, counted, slices, tasks = _counted(documents, doc_id, text, left, right, slices)
    # Requests of a slice are spread over more tasks as the corpus grows.
    replies = answers(made, counted, slices, slices, 1 + tasks // 256)
    return looked_up(made, replies, slices, left, right)
