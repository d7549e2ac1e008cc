"""BPE with content-defined chunk reuse: text that documents share is encoded once.

A rolling hash over the last bytes of a text cuts it where its low bits are zero, so equal
passages are cut alike wherever they stand. Chunks that more than one place has are encoded once
for the whole corpus; what stands between them is encoded where it stands. Joins are then
repaired: the two parts of the word that a cut went through, with the words on both sides, are encoded
again, wider and wider, until the ids on both sides agree with those of the chunks beside.

A document without a shared chunk is finished by the task that read it. Of the others, only the
ids of their own text and references to shared chunks travel, never the text. Which chunks are
shared is told by a bit set of fixed size; what it wrongly marks is encoded as a chunk of one place.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored, whole_text
from shelfmark.llm.encoding import Encoder, tokenizer
from shelfmark.llm.line_dedup import bit_hint

#: A cut where so many low bits of the rolling hash are zero: chunks of 1024 bytes on average.
CUT_BITS = 10
WINDOW = 32
HINT_BITS = 1 << 26
REMEMBERED = 1 << 17
#: White space that every Unicode table and both tokenizer engines agree on.
_SPACE = re.compile("[ \n]")
#: What the pieces of a chunk may hold; other texts are encoded whole.
_PLAIN = re.compile("[\n -~¡-ɏ]*")
_DTYPE = "<u2"


def _gear() -> np.ndarray:
    """A fixed random number for every byte, from a rule."""
    return np.array([xxhash.xxh64_intdigest(bytes([i]), 7) for i in range(256)], np.uint64)


def _rolled(mixed: np.ndarray, window: int) -> np.ndarray:
    """For every ``window`` numbers in a row their sum, each shifted by its distance from the last; halves make wholes."""
    if window == 1:
        return mixed
    half = window // 2
    halves = _rolled(mixed, half)
    pairs = (halves[:-half] << np.uint64(half)) + halves[half:]
    return pairs if window % 2 == 0 else (pairs[:-1] << np.uint64(1)) + mixed[window - 1 :]


def cuts(data: bytes, bits: int = CUT_BITS, window: int = WINDOW) -> list[int]:
    """Ends of the content-defined chunks of UTF-8 bytes, never within a character; the last is the end."""
    if len(data) <= window:
        return [len(data)] if data else []
    rolling = _rolled(_GEAR[np.frombuffer(data, np.uint8)], window)
    # The top bits depend on every byte of the window.
    hits = np.flatnonzero((rolling >> np.uint64(window)) & np.uint64((1 << bits) - 1) == 0) + window
    ends = []
    for end in hits.tolist():
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        if end < len(data) and (not ends or end > ends[-1]):
            ends.append(end)
    return [*ends, len(data)]


_GEAR = _gear()


def chunks_of(text: str) -> list[str]:
    data = text.encode("utf-8", "surrogatepass")
    parts, start = [], 0
    for end in cuts(data):
        parts.append(data[start:end].decode("utf-8", "surrogatepass"))
        start = end
    return parts


def chunk_hash(chunk: str) -> int:
    """A signed 64-bit hash."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(chunk.encode("utf-8", "surrogatepass"))).view(np.int64))


def edges(chunk: str) -> tuple[str, str, str]:
    """The part of a word before the first white space, the whole words, the part after the last white space."""
    first = _SPACE.search(chunk)
    if first is None:
        return chunk, "", ""
    last = max(chunk.rfind(" "), chunk.rfind("\n"))
    return chunk[: first.start()], chunk[first.start() : last + 1], chunk[last + 1 :]


class Joiner:
    """Ids of a text from the ids of its chunks."""

    def __init__(self, encoder: Encoder) -> None:
        self.encoder = encoder

    def bodies(self, all_words: list[str]) -> Iterator[bytes]:
        """Ids of each of many runs of whole words with white space around them."""
        return self.encoder.encode_all([words.strip(" \n") for words in all_words])

    def repaired(self, cut: str, before: list[str], after: list[str]) -> bytes:
        """Ids of the word ``cut`` from encoding it with neighbours, until theirs agree with their own ids."""
        encode = self.encoder.encode
        for width in range(1, len(before) + len(after) + 2):
            left, right = before[-width:], after[:width]
            own_left, own_right = (b"".join(map(encode, words)) for words in (left, right))
            ids = encode(" ".join([*left, *([cut] if cut else []), *right]))
            if ids.startswith(own_left) and ids.endswith(own_right) and len(ids) >= len(own_left) + len(own_right):
                return ids[len(own_left) : len(ids) - len(own_right)]
        raise ValueError(f"no agreement around {cut!r}")

    def joined(self, parts: list[tuple[str, str, str, bytes, str, str]]) -> bytes:
        """``head, first word, last word, ids, tail`` of the chunks in order, to the ids of the text."""
        out, pending, before = [], "", []
        for head, first, last, ids, tail, has_body in parts:
            pending += head
            if has_body:
                out.append(self.repaired(pending, before, [first] if first else []))
                out.append(ids)
                pending, before = tail, [last] if last else before
        out.append(self.repaired(pending, before, []))
        return b"".join(out)


def _part(chunk: str) -> tuple[str, str, str, str, bool]:
    """``head, first, last, tail, has_body`` of a chunk."""
    head, words, tail = edges(chunk)
    inner = words.split()
    return head, inner[0] if inner else "", inner[-1] if inner else "", tail, bool(words)


class Digester:
    """Counts and digests of ids, and of their decoding."""

    def __init__(self, tokenizer) -> None:
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        self.numbers = [str(i) for i in range(size)]
        self.tokens = [tokenizer.id_to_token(i) or "" for i in range(size)]
        # Without a decoder of its own the tokenizer joins tokens with one space.
        self.plain = tokenizer.decoder is None
        self.tokenizer = tokenizer

    def decoded(self, ids: list[int]) -> str:
        if self.plain:
            return " ".join(map(self.tokens.__getitem__, ids))
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def digest(self, data: bytes) -> tuple[int, str, str]:
        ids = np.frombuffer(data, _DTYPE).tolist()
        numbers = " ".join(map(self.numbers.__getitem__, ids))
        sha = lambda text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        return len(ids), sha(numbers), sha(self.decoded(ids))


def _hashes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        found = [chunk_hash(c) for text in frame["text"] if _PLAIN.fullmatch(text) for c in chunks_of(text)]
        yield pd.DataFrame({"h": np.array(found, np.int64)})


_PARTS = (
    "uid string, id string, seq int, n_tokens long, ids_sha256 string, decoded_sha256 string,"
    " h long, chunk string, head string, first string, last string, tail string, has_body boolean, ids binary"
)
_COLUMNS = [column.split()[0] for column in _PARTS.split(", ")]


def _local(file: str, hint, bits: int):
    """Finished documents, parts of the others, and the text of chunks that may be shared."""

    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        encoder = Encoder(file, _DTYPE, spaced=False)
        digester = Digester(tokenizer(file))
        task, count, sent = uuid.uuid4().hex, 0, set()

        def shared(h: int) -> bool:
            bit = h % bits
            return bool(int(hint.value[bit >> 6]) >> (bit & 63) & 1)

        for frame in frames:
            # What is encoded here waits for the frame's end: rows, and for each the text its ids are of.
            rows, waiting, to_encode = [], [], []
            for doc_id, text in zip(frame["id"], frame["text"], strict=True):
                plain = _PLAIN.fullmatch(text) is not None
                chunks = chunks_of(text) if plain else []
                hashes = [chunk_hash(chunk) for chunk in chunks]
                marked = [shared(h) for h in hashes]
                count += 1
                uid = f"{task}-{count}"
                if not any(marked):
                    waiting.append((uid, doc_id, None))
                    to_encode.append(text)
                    continue
                seq = 0
                for is_shared, group in groupby(zip(marked, hashes, chunks, strict=True), key=lambda x: x[0]):
                    if is_shared:
                        for _, h, chunk in group:
                            rows.append((uid, doc_id, seq, None, None, None, h, None, *_part(chunk), None))
                            seq += 1
                            if h not in sent:
                                if len(sent) >= REMEMBERED:
                                    sent.clear()
                                sent.add(h)
                                rows.append((None,) * 6 + (h, chunk) + (None,) * 6)
                    else:
                        own = "".join(chunk for _, _, chunk in group)
                        waiting.append((uid, doc_id, seq, None, None, None, None, None, *_part(own)))
                        to_encode.append(edges(own)[1].strip(" \n"))
                        seq += 1
            for row, ids in zip(waiting, encoder.encode_all(to_encode), strict=True):
                rows.append((*row, *digester.digest(ids)) + (None,) * 8 if len(row) == 3 else (*row, ids))
            yield pd.DataFrame(rows, columns=_COLUMNS)

    return mapped


def _encoded(file: str):
    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        joiner = Joiner(Encoder(file, _DTYPE, spaced=False))
        for frame in frames:
            yield pd.DataFrame({"h": frame["h"], "shared_ids": list(joiner.bodies([edges(chunk)[1] for chunk in frame["chunk"]]))})

    return mapped


def _assembled(file: str):
    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(file, _DTYPE, spaced=False)
        joiner, digester = Joiner(encoder), Digester(tokenizer(file))

        def rows():
            for frame in frames:
                yield from frame.itertuples(index=False)

        done = []
        for _, group in groupby(rows(), key=lambda row: row.uid):
            doc_id, parts = None, []
            for row in group:
                doc_id = row.id
                parts.append((row.head, row.first, row.last, bytes(row.ids), row.tail, row.has_body))
            done.append((doc_id, *digester.digest(joiner.joined(parts))))
            if len(done) >= 5000:
                yield pd.DataFrame(done, columns=_RESULT)
                done = []
        yield pd.DataFrame(done, columns=_RESULT)

    return mapped


_RESULT = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]


def encoded(docs: DataFrame, tokenizer_file: str, hint_bits: int = HINT_BITS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs`` (``doc_id, text``).

    A null text counts as empty: no ids and the digests of an empty text. Repeated rows each get their
    row, other columns are not read, and an empty table gives an empty result. The vocabulary must
    be below 65,536 ids.
    """
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), whole_text().alias("text"))
    hashes = texts.select("text").mapInPandas(_hashes, "h long")
    shared = hashes.groupBy("h").count().where("count > 1").select("h")
    hint = docs.sparkSession.sparkContext.broadcast(bit_hint(shared, hint_bits))
    local = stored(texts.mapInPandas(_local(tokenizer_file, hint, hint_bits), _PARTS), "encoded")
    finished = local.where("n_tokens IS NOT NULL").select(*_RESULT)
    # One text for each hash: the tasks that met it first send it, any one of them is encoded.
    owners = local.where("uid IS NULL").select("h", "chunk").dropDuplicates(["h"])
    once = stored(owners.mapInPandas(_encoded(tokenizer_file), "h long, shared_ids binary"), "chunks")
    parts = local.where("uid IS NOT NULL AND n_tokens IS NULL").select(
        "uid", "id", "seq", "h", "head", "first", "last", "tail", "has_body", "ids"
    )
    own = parts.where("h IS NULL").drop("h")
    taken = parts.where("h IS NOT NULL").drop("ids").join(once, "h").withColumnRenamed("shared_ids", "ids").select(*own.columns)
    joined = own.union(taken).repartition("uid").sortWithinPartitions("uid", "seq")
    kinds = "id string, n_tokens long, ids_sha256 string, decoded_sha256 string"
    whole = finished.union(joined.mapInPandas(_assembled(tokenizer_file), kinds))
    return whole.select(F.col("id").cast("long").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
