"""Operator 5: edit-aware token counts with segment trees over pre-tokens.

A document's text is cut at spaces that stand between two other characters, where no pre-token can
continue, into leaves of about ``LEAF`` characters. A tree over the leaves keeps sums of characters
and tokens. An edit finds its leaves by descending the character sums; only these leaves, and one
more on either side as boundary context, are cut and encoded again, and the sums above them are
updated. Everything else keeps its counts. The context leaves keep their outer two characters, so
their outer cuts stay cuts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adlumen.llm import common as c
from adlumen.llm.tokens import Encoder, encoder

LEAF = 256
# A cut before a space: both sides of it are no white space.
_CUT = re.compile(r"(?<=\S)(?= \S)")


def leaves_of(text: str, size: int = LEAF) -> list[str]:
    """The text in leaves of at least ``size`` characters that end at cuts, the last one excepted."""
    out, first = [], 0
    while first < len(text):
        cut = _CUT.search(text, first + size) if first + size < len(text) else None
        last = cut.start() if cut else len(text)
        out.append(text[first:last])
        first = last
    return out or [""]


class TokenTree:
    """Sums of characters and tokens over the leaves of one text."""

    def __init__(self, text: str, model: Encoder):
        self.model = model
        self.encoded = 0
        self.leaves = leaves_of(text)
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i in range(len(self.leaves)):
            self._measure(i)
        for node in range(self.width - 1, 0, -1):
            self._sum(node)
        self.encoded = 0

    def _measure(self, i: int) -> None:
        self.encoded += len(self.leaves[i])
        self.chars[self.width + i] = len(self.leaves[i])
        self.tokens[self.width + i] = len(self.model.encode(self.leaves[i])) // 4

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and the place of its first one; the last leaf for the
        end of the text."""
        node, begin = 1, 0
        if place >= self.chars[1]:
            return len(self.leaves) - 1, self.chars[1] - len(self.leaves[-1])
        while node < self.width:
            node *= 2
            if place - begin >= self.chars[node]:
                begin += self.chars[node]
                node += 1
        return node - self.width, begin

    def edit(self, start: int, length: int, replacement: str) -> None:
        """Replaces ``length`` characters from ``start``; both are cut to the text."""
        start = min(max(start, 0), self.chars[1])
        end = min(start + max(length, 0), self.chars[1])
        first, begin = self.find(start)
        last, _ = self.find(max(start, end - 1))
        # Context: leaves up to one that is not empty on either side.
        low, high = first, last
        while low > 0 and (low == first or len(self.leaves[low]) < 2):
            low -= 1
            begin -= len(self.leaves[low])
        while high < len(self.leaves) - 1 and (high == last or len(self.leaves[high]) < 2):
            high += 1
        old = "".join(self.leaves[low : high + 1])
        new = leaves_of(old[: start - begin] + replacement + old[end - begin :])
        # The tree keeps its shape: the region's leaves share its new text.
        slots = high - low + 1
        if len(new) > slots:
            new = new[: slots - 1] + ["".join(new[slots - 1 :])]
        for i, text in enumerate(new + [""] * (slots - len(new)), low):
            if text != self.leaves[i]:
                self.leaves[i] = text
                self._measure(i)
        changed = {(self.width + i) // 2 for i in range(low, high + 1)}
        while changed:
            for node in changed:
                if node:
                    self._sum(node)
            changed = {node // 2 for node in changed if node > 1}


COUNTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_tokens_edited", pa.int64()), ("n_chars_edited", pa.int64()), ("n_chars_encoded", pa.int64()), ("n_edits", pa.int64()), ("edited", pa.string())])


def count_tokens(documents: DataFrame, edits: str | Column | None = None, doc_id: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """Token counts of texts before and after edits.

    ``edits``: an array of (start int, length int, replacement string), in code points of the text as
    given, or null. Edits are applied from the last start to the first, those of one start in the
    order of length and replacement, so places stay valid; parts beyond the text are ignored, a null
    field makes an edit void. Returns one row for each input row: doc_id, n_tokens,
    n_tokens_edited, n_chars_edited, n_chars_encoded (code points encoded again for the edits),
    n_edits (long), edited (string).

    A null text is empty and has no tokens. Rows repeated or without an id are counted as they
    stand. An empty table gives an empty result; other columns are not read.
    """
    kind = "array<struct<start:int,length:int,replacement:string>>"
    column = F.lit(None) if edits is None else F.col(edits) if isinstance(edits, str) else edits
    rows = documents.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), column.cast(kind).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(vocabulary)
        for one in batches:
            out = []
            for row in one.to_pylist():
                tree = TokenTree(row["text"] or "", model)
                before = tree.tokens[1]
                todo = [(e["start"], e["length"], e["replacement"]) for e in row["edits"] or [] if e and None not in e.values()]
                for start, length, replacement in sorted(todo, key=lambda e: (-e[0], e[1], e[2])):
                    tree.edit(start, length, replacement)
                out.append((row["id"], before, tree.tokens[1], tree.chars[1], tree.encoded, len(todo), "".join(tree.leaves)))
            yield c.batch(dict(zip(COUNTS.names, map(list, zip(*out)))) if out else {k: [] for k in COUNTS.names}, COUNTS)

    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_tokens_edited long, n_chars_edited long, n_chars_encoded long, n_edits long, edited string")


def sample_edits(text: str = "text") -> Column:
    """Three edits of a text at places that follow its length: a copied phrase, a cut, a note."""
    n = F.char_length(text)
    at = lambda start, length, new: F.struct(start.cast("int").alias("start"), F.lit(length).alias("length"), new.alias("replacement"))
    return F.array(at(F.floor(n / 5), 12, F.substring(F.col(text), F.floor(n / 2).cast("int") + 1, F.lit(24))), at(F.floor(n / 2), 40, F.lit("")), at(F.floor(n * 4 / 5), 0, F.lit(" [edited] ")))
