"""Byte-level BPE ids of texts, as the tokenizer file defines them, with a cache of pieces.

The pre-token pattern never joins characters across a space that stands between two other
characters, so a text is cut at such spaces and each piece has its ids in a dictionary. The cache
has a fixed size; it changes the time, not the ids.

Added tokens of the tokenizer file are found in the text before anything else and have one id each.
They hold no white space, so no cut at a space goes through one.
"""

from __future__ import annotations

import base64
import json
import os
import re
from array import array

import public_tokenizers
import tiktoken

CACHE = 500_000
_RARE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def _only_single_spaces(text: str) -> bool:
    """Whether every space stands between two characters that are not white space."""
    return not (text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text or _RARE.search(text))


class Encoder:
    """Ids as little-endian 32-bit bytes. ``path``: a file of ranks, one a line. ``added``: ids of
    the added tokens."""

    def __init__(self, path: str, pattern: str, added: dict[str, int]):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.model = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.later: dict[str, bytes] = {}
        self.added = added
        # The longest of those that start at one place.
        self.split = re.compile(f"({'|'.join(map(re.escape, sorted(added, key=len, reverse=True)))})").split if added else lambda text: [text]

    def plain(self, text: str) -> bytes:
        ids = array("I")
        for k, part in enumerate(self.split(text)):
            if k % 2:
                ids.append(self.added[part])
            elif part:
                ids.extend(self.model.encode_ordinary(part))
        return ids.tobytes()

    def pieces(self, text: str) -> list[bytes]:
        """Ids of the pieces between the spaces of a text, the space with the piece after it."""
        if not text:
            return []
        if _only_single_spaces(text):
            head, *rest = text.split(" ")
        else:
            head, *rest = _CUT.split(text)
            rest = [x[1:] for x in rest]
        later = self.later
        out = [self.plain(head)]
        for piece in rest:
            ids = later.get(piece)
            if ids is None:
                ids = self.plain(" " + piece)
                if len(later) < CACHE and "\n" not in piece:
                    later[piece] = ids
            out.append(ids)
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(self.pieces(text))


def added_tokens(path: str) -> dict[str, int]:
    """Ids of the added tokens of a tokenizer file; none if a vocabulary has no such file."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    for token in found:
        if any(token[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) or re.search(r"\s", token["content"]):
            raise ValueError(f"added token {token['content']!r} is not taken as it stands")
    return {token["content"]: token["id"] for token in found}


_encoders: dict[str, Encoder] = {}


def encoder(name: str = "byte_bpe_50k") -> Encoder:
    """The encoder of a vocabulary of ``public_tokenizers``, one for each process; to be asked for
    at the start of a task, when a full cache is emptied."""
    if name not in _encoders:
        _encoders[name] = Encoder(public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN, added_tokens(public_tokenizers.path(f"{name}.json")))
    elif len(_encoders[name].later) >= CACHE:
        _encoders[name].later.clear()
    return _encoders[name]
