"""Helpers shared by the text operators: Arrow columns as numpy arrays, words, rolling hashes.

A task sees a column of texts as one byte buffer with offsets, so words and n-grams of many texts
are hashed by a few array operations. Words are ``[^\\x20\\x09-\\x0D]+``, as ``bytes.split()``
takes them.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

import adlumen
from adlumen.session import scratch_dir

# Bytes of text that a task turns into arrays at once; arrays take some 60 times as much.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 5
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return _LOWER[data]


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * base ** i, one longer than values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=out[1:])
    return out


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; equal bytes have equal hashes wherever they stand."""
    total = _prefix(_LETTER[data])
    return mix((total[ends] - total[starts]) * powers(_UNBASE, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


def grams_hash(values: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of n neighbouring 64-bit values."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    total = _prefix(values)
    return mix((total[n:] - total[:-n]) * powers(_UNBASE, len(values) + 1)[: len(values) - n + 1])


def bytes_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of a string or binary column; null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return (at - at[0]).astype(np.int64), raw[at[0] : at[-1]]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges with at most ``limit`` bytes of text, or one row."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in the buffer, and the range of words of each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def pack(values: np.ndarray) -> bytes:
    """Array to bytes, equal byte places together, so that shuffle compression finds the zeros."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unpack(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


def compress(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def decompress(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part number that occurs, with the places where it stands."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for places in np.split(order, cuts):
        if len(places):
            yield int(part[places[0]]), places


def batch(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def parts_for(documents: DataFrame, text: str, part_bytes: int = 8 << 20) -> int:
    """How many parts hold about ``part_bytes`` of text each, and no fewer than shuffles use."""
    total = documents.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    return max(4 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // part_bytes))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back: lineage ends here, and a lost
    executor loses nothing."""
    spark: SparkSession = frame.sparkSession
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def bound_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Let Arrow batches end at about ``limit`` bytes as well: rows may hold blocks of texts, of which
    ten thousand would be one batch."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    if not (before and before.isdigit() and 0 < int(before) <= limit):
        spark.conf.set(name, limit)


# How many texts one id may name, and the bits that tell them apart.
_TEXTS_BITS = 20


def told_apart(texts: DataFrame) -> tuple[DataFrame, DataFrame | None, int]:
    """``texts (id, text, ...)`` with ids that name one text each, in the order of the ids.

    Where no id names several texts, as usual, that is ``texts`` itself. Else new ids take their
    place: returns also (key, id), to give them back by ``named``, and the bits that tell apart the
    texts of one id. Equal rows keep one id; rows without an id have none.
    """
    spark = texts.sparkSession
    keyed = texts.withColumn("_hash", F.xxhash64("text"))
    pairs = keyed.where("id is not null").select("id", "_hash")
    if pairs.groupBy("id").agg(F.min("_hash").alias("lo"), F.max("_hash").alias("hi")).where("lo <> hi").isEmpty():
        return texts, None, 0
    parts = min(512, int(spark.conf.get("spark.sql.shuffle.partitions")))
    in_order = pairs.distinct().repartitionByRange(parts, "id").sortWithinPartitions("id", "_hash")
    in_order = stored(in_order.withColumn("n", F.monotonically_increasing_id()), "ids")
    first = in_order.groupBy("id").agg(F.min("n").alias("first"), F.count("*").alias("texts"))
    if first.agg(F.max("texts")).first()[0] >= 1 << _TEXTS_BITS:
        raise ValueError(f"an id names more than {1 << _TEXTS_BITS} texts")
    names = stored(in_order.join(first, "id").select("id", "_hash", F.shiftleft("first", _TEXTS_BITS).bitwiseOR(F.col("n") - F.col("first")).alias("key")), "ids")
    others = [F.col(k) for k in texts.columns if k != "id"]
    return keyed.join(names, ["id", "_hash"], "left").select(F.col("key").alias("id"), *others), names.select("key", "id"), _TEXTS_BITS


def named(result: DataFrame, names: DataFrame | None) -> DataFrame:
    """A result by the ids of ``told_apart`` with the ids that were given, under ``doc_id``."""
    if names is None:
        return result
    columns = [F.col("_id").alias(k) if k == "doc_id" else F.col(k) for k in result.columns]
    return result.join(names.select("key", F.col("id").alias("_id")), F.col("doc_id") == F.col("key"), "left").select(*columns)


def bounded(one: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``limit`` bytes of one column, or one row."""
    offsets, _ = bytes_column(one.column(column))
    for first, last in chunks(offsets, limit):
        yield one.slice(first, last - first)


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_has_adlumen", False):
        return
    root = Path(adlumen.__file__).resolve().parent
    file = Path(tempfile.mkdtemp(prefix="adlumen-")) / "adlumen.zip"
    with zipfile.ZipFile(file, "w") as out:
        for module in sorted(root.rglob("*.py")):
            out.write(module, str(module.relative_to(root.parent)))
    context.addPyFile(str(file))
    context._has_adlumen = True


def forget(frame: DataFrame) -> None:
    """Delete the files of a table made by ``stored``."""
    spark = frame.sparkSession
    for path in {p.rsplit("/", 1)[0] for p in frame.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
