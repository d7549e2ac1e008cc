"""Token ids of whole texts from a public tokenizer's file, with equal pieces encoded once.

A text is cut where one space stands between two characters that are no white space. Both
kinds of pre-tokenizer used here start anew at such a space, so the ids of a text are those of its
pieces in a row. Many texts are cut together, and a task remembers pieces that it has met more than
once. A text that is not plain (see ``_ODD``) goes through the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelfmark.llm.common import held

#: Pieces, and parts of pieces, that a task remembers; it bounds memory and leaves the result as it is.
REMEMBERED = 200_000
#: Beyond Latin letters, other white space than space and newline, and spaces not alone between two words.
_ODD = "[^\n -~¡-ɏ]|^[ \n]|[ \n]$| [ \n]|\n "


def path(name: str) -> str:
    """Where the file of a public tokenizer is."""
    import public_tokenizers

    return public_tokenizers.path(name)


@held
def tokenizer(file: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(file)
    found.no_truncation()
    found.no_padding()
    return found


#: How byte-level tokenizers cut a text before merging: a fixed value of their format.
_BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@held
def _spec(file: str) -> dict:
    """The tokenizer's file but for its vocabulary and merges."""
    with open(file, encoding="utf-8") as source:
        spec = json.load(source)
    del spec["model"]["vocab"], spec["model"]["merges"]
    return spec


@held
def _ranked(file: str) -> Callable[[str], list[int]] | None:
    """A faster engine over the same vocabulary, where the file is plain byte-level BPE whose ids are in merge order; else none."""
    import tiktoken

    with open(file, encoding="utf-8") as source:
        spec = json.load(source)
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    if not plain or spec["normalizer"] or model["end_of_word_suffix"] or model["continuing_subword_prefix"]:
        return None
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merged = [model["vocab"][a + b] for a, b in merges]
    if any(a >= b for a, b in zip(merged, merged[1:], strict=False)):
        return None
    of, special = _byte_of(), {token["content"] for token in spec["added_tokens"]}
    ranks = {bytes(of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    return tiktoken.Encoding("ranked", pat_str=_BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


#: How lower-casing word tokenizers normalise and cut a text: fixed values of their format.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
_CUTS = [
    {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: The same cut of plain pieces, which have no other numbers than these and are composed already.
_WORD_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W0-9_²³¹¼½¾]+|[0-9²³¹¼½¾]|(?:[^\s\w]|_)+")


class Parts:
    """Ids of plain pieces where the file is a lower-casing word tokenizer: equal parts go through its model once."""

    def __init__(self, file: str) -> None:
        self.model, self.known = tokenizer(file).model, {}
        self.letters = {byte: letter for letter, byte in _byte_of().items()}

    @staticmethod
    def suits(file: str) -> bool:
        spec = _spec(file)
        steps = ((spec["normalizer"] or {}).get("normalizers"), (spec["pre_tokenizer"] or {}).get("pretokenizers"))
        return spec["model"]["type"] == "BPE" and not spec["model"]["dropout"] and steps == (_NORMALIZERS, _CUTS)

    def __call__(self, piece: str) -> list[int]:
        ids, known = [], self.known
        for part in _WORD_PARTS.findall(piece.lower()):
            found = known.get(part)
            if found is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                letters = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
                found = known[part] = [token.id for token in self.model.tokenize(letters)]
            ids += found
        return ids


class Encoder:
    """Ids of texts as little-endian numbers of ``dtype``; ``spaced``: a piece keeps the space before it."""

    def __init__(self, file: str, dtype: str = "<u4", spaced: bool = True) -> None:
        self.file, self.dtype, self.space = file, np.dtype(dtype), " " if spaced else ""
        self.engine = _ranked(file) or (Parts(file) if Parts.suits(file) else None)
        self.special = [token["content"] for token in _spec(file)["added_tokens"]]
        self.odd = re.compile("|".join([_ODD, *map(re.escape, self.special)]))
        self.known: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = tokenizer(self.file).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, self.dtype).tobytes() for one in found]

    def plain(self, pieces: list[str]) -> list[bytes]:
        """Ids of plain pieces, as they stand."""
        if self.engine is None:
            return self.whole(pieces)
        code, engine = self.dtype.char, self.engine
        return [array(code, engine(piece)).tobytes() for piece in pieces]

    def learn(self, pieces: list[str], often: list[bool]) -> list[bytes]:
        """Ids of distinct pieces after a space; those that occur ``often`` are remembered."""
        found = list(map(self.known.get, pieces))
        new = [i for i, ids in enumerate(found) if ids is None]
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        for i, ids in zip(new, self.plain([self.space + pieces[i] for i in new]), strict=True):
            found[i] = ids
            if often[i] and len(self.known) < REMEMBERED:
                self.known[pieces[i]] = ids
        return found

    def encode_all(self, texts: pa.Array | list[str]) -> Iterator[bytes]:
        """Ids of each of the texts, none of them null, in their order."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        odd = pc.match_substring_regex(texts, _ODD)
        for special in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        words = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        coded = words.flatten().dictionary_encode()
        places, ends = coded.indices.to_numpy(), np.cumsum(pc.list_value_length(words).to_numpy()).tolist()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = self.learn(pieces, (np.bincount(places, minlength=len(pieces)) > 1).tolist()) if pieces else []
        start = 0
        for i, (is_odd, end) in enumerate(zip(odd.to_pylist(), ends, strict=True)):
            if is_odd:
                yield self.whole([texts[i].as_py()])[0]
            else:
                at = places[start:end].tolist()
                first = self.plain([pieces[at.pop(0)]])[0] if self.space else b""
                yield first + b"".join(map(found.__getitem__, at))
            start = end

    def encode(self, text: str) -> bytes:
        """Ids of one text."""
        if not text:
            return b""
        if self.odd.search(text):
            return self.whole([text])[0]
        first, *pieces = text.split(" ") if self.space else ["", *text.split(" ")]
        return b"".join([*self.plain([first]), *self.learn(pieces, [True] * len(pieces))])
