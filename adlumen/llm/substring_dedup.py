"""Operator 3: substring dedup with prefix-partitioned suffix trees over words.

A suffix starts at a word; only its first ``width`` words matter, since a repeat is a tree node at
depth ``width`` or more. Suffixes are split among parts by a prefix of variable length: the words up
to the end of the n-gram with the smallest hash among the first ``width`` words. Suffixes that agree
in ``width`` words agree in that prefix, so they meet; neighbouring suffixes whose prefix ends at the
same place travel as one stretch of text. A prefix that ends in a very frequent n-gram is lengthened
to all ``width`` words. Prefixes without a second occurrence have no inner node and never leave
their document. The number of parts follows the bytes of text, so a part fits in memory.

A part builds its subtree as sorted suffixes with the longest common prefix of neighbours: a run of
neighbours that share at least ``width`` words is the set of leaves below a deep inner node. The
smallest id among these leaves keeps its words; those of every other leaf are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adlumen.llm import common as c, repeats as r

WIDTH = 13
GRAM = 5
# Suffixes whose subtree is built at once.
SUFFIXES = 400_000


def subtree_leaves(texts: list[bytes], counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in tree order and, for each, the number of its deep inner node. Suffixes are
    numbered stretch by stretch; nodes are numbered in tree order."""
    numbers: dict[bytes, int] = {}
    flat = np.array([numbers.setdefault(w, len(numbers)) for w in b" ".join(texts).split()], np.int32)
    first = np.cumsum(counts + width - 1) - (counts + width - 1)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(counts.sum()) - (np.cumsum(counts) - counts)[owner] + first[owner]
    suffixes = np.lib.stride_tricks.sliding_window_view(flat, width)[place]
    order = np.lexsort(suffixes.T[::-1])
    suffixes = suffixes[order]
    common = np.cumprod(suffixes[1:] == suffixes[:-1], axis=1, dtype=np.int8).sum(axis=1)
    return order, np.concatenate([[0], np.cumsum(common < width)])


def later_windows(batches: Iterator[pa.RecordBatch], shape: r.Shape) -> Iterator[pa.RecordBatch]:
    some, _, settled = r.received(batches)
    yield from settled
    for portion, _ in r.portions(some, SUFFIXES):
        order, node = subtree_leaves(portion.texts, portion.counts, shape.width)
        owner = np.repeat(np.arange(len(portion)), portion.counts)
        start = np.arange(len(owner)) - (np.cumsum(portion.counts) - portion.counts)[owner] + portion.starts[owner]
        ids = portion.ids[owner]
        smallest = np.minimum.reduceat(ids[order], np.flatnonzero(np.concatenate([[True], np.diff(node) != 0])))
        hit = np.zeros(len(owner), bool)
        hit[order] = shape.later(ids[order], smallest[node])
        yield r.window_spans(portion.ids, owner[hit], start[hit])


def remove_repeats(documents: DataFrame, doc_id: str | Column = "doc_id", text: str | Column = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Documents without the words that a document with a smaller id has in a common passage.

    A word goes if one of the ``width``-word windows that cover it also starts in a document with a
    smaller id; windows are judged on the input. Returns one row for each input row: doc_id, n_words,
    n_removed (long), kept (string: the kept words joined by one space).

    Null and empty texts have no words: 0, 0 and ''. Texts with fewer than ``width`` words stay
    whole. Rows that share an id are judged each by its own text, and none of them has a smaller id
    than the others; repeated rows get the same result. Rows without an id are returned whole and take no part in the comparison. An empty table gives an
    empty result; other columns, whatever their names, are not read.
    """
    texts = documents.select((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("long").alias("id"), (F.col(text) if isinstance(text, str) else text).alias("text"))

    texts, names, bits = c.told_apart(texts)
    shape = r.Shape(True, width, gram, False, bits)

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            packed = [c.compress(b" ".join((x or "").encode().split())) for x in one.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([one.column("id"), pa.array(packed, pa.binary())], ["id", "packed"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            rows = []
            for row in one.to_pylist():
                parts = c.decompress(row["packed"]).split()
                gone = r.covered(len(parts), row["starts"], row["ns"], width)
                kept = b" ".join([w for w, g in zip(parts, gone.tolist()) if not g] if gone.any() else parts)
                rows.append((row["id"], len(parts), int(gone.sum()), kept.decode()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["doc_id", "n_words", "n_removed", "kept"]) if rows else pa.RecordBatch.from_pylist([], KEPT)

    parts = c.parts_for(texts, "text")
    found = r.search(texts, texts.mapInArrow(normal, "id long, packed binary"), shape, parts, lambda batches: later_windows(batches, shape))
    return c.named(found.mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept string"), names)


KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
