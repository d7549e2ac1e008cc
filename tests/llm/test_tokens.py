"""Encoding, chunk reuse and packing against the tokenizer itself."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from shelfmark.llm import chunk_reuse, common, packing
from shelfmark.llm.encoding import Encoder, path, tokenizer

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"
DOCS = "doc_id long, text string, ids string, n_tokens string, uid string, h string"


def texts():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdeéüñABC") for _ in range(rng.randrange(1, 10))) for _ in range(400)] + ["it's", "x<b>", "12,5", "\n", "a\nb", "…"]
    shared = [" ".join(rng.choice(words[:-1]) for _ in range(900)) for _ in range(3)]
    out = [" ".join(rng.choice(words[:-1]) for _ in range(rng.choice([3, 100, 700]))) for _ in range(25)]
    out += [out[i] + " " + rng.choice(shared) + " " + out[i + 1] for i in range(12)] + shared + shared
    odd = ["", " ", "\n", "a  b", " a", "a ", "a \n b", "x\ty", "a b", "Ünï — dash", "<|endoftext|>", "a<|endoftext|> b <|startoftext|>c", "İΣΟΣ ΑΣ", "é ẛ̣", "日本 語", "w" * 70_000, "\x1cq"]
    return [*enumerate(out + odd), (5, None), (None, "no id")]


@pytest.mark.parametrize(("name", "dtype", "spaced"), [(BYTE, "<u4", True), (WORD, "<u2", False)])
def test_encoder_is_the_tokenizer(name, dtype, spaced):
    encoder, plain = Encoder(path(name), dtype, spaced), tokenizer(path(name))
    for _, text in texts():
        assert np.frombuffer(encoder.encode(text or ""), dtype).tolist() == plain.encode(text or "", add_special_tokens=False).ids, repr(text)[:80]


@pytest.mark.parametrize(("name", "dtype", "spaced"), [(BYTE, "<u4", True), (WORD, "<u2", False)])
def test_many_texts_together_are_the_tokenizer(name, dtype, spaced):
    """With every plain character beside letters, digits, signs and line ends, and with a memory of a few pieces."""
    latin = [chr(c) for c in [*range(33, 127), *range(0xA1, 0x250)]]
    many = [t or "" for _, t in texts()] + [f"a{c}b {c} {c}{c}'s 1{c}2{c}! {c}\n{c}a {c.upper()}'RE" for c in latin]
    plain = [one.ids for one in tokenizer(path(name)).encode_batch(many, add_special_tokens=False)]
    encoder = Encoder(path(name), dtype, spaced)
    for _ in range(2):
        assert [np.frombuffer(ids, dtype).tolist() for ids in encoder.encode_all(many)] == plain
    assert [np.frombuffer(encoder.encode(text), dtype).tolist() for text in many] == plain
    assert list(encoder.encode_all([])) == []


def test_equal_words_are_encoded_once(monkeypatch):
    """A text's words reach the engine once, whatever the number of texts; a word tokenizer's model meets equal parts once."""
    for name, dtype, spaced in [(BYTE, "<u4", True), (WORD, "<u2", False)]:
        encoder, seen = Encoder(path(name), dtype, spaced), []
        engine = encoder.engine
        encoder.engine = lambda piece: seen.append(piece) or engine(piece)
        found = list(encoder.encode_all(["the house of the Seas", "the house of, the seas"] * 50))
        assert len(found) == 100 and len(set(found)) == 2
        assert len([piece for piece in seen if "house" in piece]) == 1
    assert {"house", "of", ",", "seas"} <= set(engine.known) and "Seas" not in engine.known


def test_workers_give_memory_back():
    """Freed blocks of many sizes go back to the system when a task ends; what it returns stays as it is."""

    def resident() -> int:
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096

    def mapped(batches):
        for batch in batches:
            blocks = [bytearray(600 + i % 50_000) for i in range(8000)]
            pinned.append(bytearray(100_000))  # above the freed blocks, so that they stay with the C library
            yield len(blocks) + batch

    pinned = []
    assert list(mapped([1, 2])) == [8001, 8002]
    held = resident()
    assert list(common.thrifty(mapped)([1, 2])) == [8001, 8002] and len(pinned) == 4
    assert resident() < held - (10 << 20)


def test_workers_drop_tokenizers_with_the_next_operator():
    """A tokenizer lasts for the tasks that use it; a task of another operator does not keep it beside its own work."""
    file = path("byte_bpe_50k.json")
    kept = tokenizer(file)
    list(common.thrifty(iter, keeps=True)([1]))
    assert tokenizer(file) is kept
    list(common.thrifty(iter)([1]))
    assert tokenizer.cache_info().currsize == 0 and tokenizer(file).get_vocab_size() == kept.get_vocab_size()


def test_rolling_hash_by_halves():
    rng = random.Random(4)
    numbers = np.array([rng.getrandbits(64) for _ in range(200)], np.uint64)
    for window in (1, 2, 3, 7, 32, 33):
        plain = np.zeros(201 - window, np.uint64)
        for i in range(window):
            plain += numbers[i : i + len(plain)] << np.uint64(window - 1 - i)
        assert chunk_reuse._rolled(numbers, window).tolist() == plain.tolist()


@pytest.mark.parametrize("bits", [26, 6])
def test_chunk_reuse_is_the_tokenizer(spark, bits):
    """With a hint of 64 bits every chunk counts as shared: all joins are repaired."""
    plain = tokenizer(path(WORD))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = []
    for i, text in texts():
        ids = plain.encode(text or "", add_special_tokens=False).ids
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(plain.decode(ids, skip_special_tokens=False))))
    docs = spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in texts()], DOCS)
    found = [tuple(r) for r in chunk_reuse.encoded(docs, path(WORD), 1 << bits).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert chunk_reuse.encoded(docs.limit(0), path(WORD)).count() == 0


def test_cuts_depend_on_content():
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    one, two = chunk_reuse.chunks_of("x" * 333 + passage), chunk_reuse.chunks_of("yé" * 2001 + passage)
    assert "".join(one) == "x" * 333 + passage and "".join(two) == "yé" * 2001 + passage
    assert len(set(one) & set(two)) >= len(one) - 3


def test_pieces():
    for size in (1, 1023, 1024, 1025, 2048, 5000):
        ids = np.arange(size, dtype="<u4")
        pieces = packing.pieces_of(ids)
        assert [p[2] for p in pieces][1:] == [1024] * (len(pieces) - 1) and sum(p[2] for p in pieces) == size
        assert pieces[0][2] == (size % 1024 or 1024)
        assert all(zlib.crc32(ids[a : a + n].tobytes()) == crc for _, a, n, crc in pieces)


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    packer = packing.BestFit(10, 2)
    assert packer.add("a", 6) == [] and packer.add("b", 7) == []
    assert packer.add("c", 3) == [["b", "c"]]  # 3 free is tighter than 4
    assert packer.add("d", 5) == []
    assert packer.add("e", 8) == [["a"]]  # none fits: the fullest closes
    assert packer.rest() == [["e"], ["d"]]


def test_packing(spark):
    docs = spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in texts()], DOCS)
    rows = packing.packed(docs.repartition(5), path(BYTE), open_bins=4, per_task=8).collect()
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
        assert spans[-1][0] + spans[-1][1] <= 1024
    plain = tokenizer(path(BYTE))
    expected = sorted((str(i), p) for i, t in texts() for p in packing.pieces_of(np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")))
    assert sorted((str(r.doc_id), (r.piece, r.start, r.length, r.ids_crc32)) for r in rows) == expected
    assert packing.packed(docs.limit(0), path(BYTE)).count() == 0


def test_packing_is_dense(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, "word " * int(rng.lognormvariate(5, 1)), "", "", "", "") for i in range(3000)], DOCS)
    rows = packing.packed(docs.repartition(6), path(BYTE)).groupBy("sequence_id").sum("length").collect()
    assert len(rows) <= 1.02 * -(-sum(r[1] for r in rows) // 1024)
