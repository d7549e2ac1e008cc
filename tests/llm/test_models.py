"""Partial matching beside plain folds, and I-Match fingerprints."""

import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from shelfmark.llm import imatch, ppm

DOCS = "doc_id long, text string, term string, bucket string, id string, hash string"


def texts():
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    out = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 30, 90]))) for _ in range(60)]
    return [*enumerate(out), (70, None), (71, ""), (72, "A b\x0bC\x00d"), (3, "again the same id"), (None, "no id"), (None, "no id"), (80, "x" * 70_000)]


def frame(spark, rows=None):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in (texts() if rows is None else rows)], DOCS)


def trained(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2


class PlainPPM:
    """Method D with exclusion over contexts of up to five bytes, one symbol at a time."""

    def __init__(self, rows):
        self.counts = {}
        for data in rows:
            data = b"\0" * 5 + data + b"\0"
            for at in range(5, len(data)):
                for order in range(6):
                    self.counts.setdefault(data[at - order : at], Counter())[data[at]] += 1

    def log10(self, context, symbol):
        excluded, log = set(), 0.0
        for order in range(5, -1, -1):
            seen = {s: n for s, n in self.counts.get(context[5 - order :], {}).items() if s not in excluded}
            if not seen:
                continue
            total, last = sum(seen.values()), len(seen) == 256 - len(excluded)
            if symbol in seen:
                return log + math.log10((seen[symbol] - (0 if last else 0.5)) / total)
            log += math.log10(len(seen) / (2 * total))
            excluded |= set(seen)
        return log - math.log10(256 - len(excluded))

    def score(self, data):
        data = b"\0" * 5 + data + b"\0"
        return sum(self.log10(data[at - 5 : at], data[at]) for at in range(5, len(data)))


def test_scores(spark):
    rows = texts()
    found = ppm.scored(frame(spark)).collect()
    model = PlainPPM([(t or "").encode() for i, t in rows if trained(i)])
    counts = Counter()
    for i, t in rows:
        if trained(i):
            counts.update([*(t or "").encode().lower().split(), b""])
    n, v = sum(counts.values()), len(counts)
    expected = []
    for i, t in rows:
        words = [*(t or "").encode().lower().split(), b""]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        expected.append((i, not trained(i), len(words), sum(counts[w] > 0 for w in words), n, base, model.score((t or "").encode())))
    order = lambda row: (str(row[0]), row[2], row[5])
    for got, want in zip(sorted(map(tuple, found), key=order), sorted(expected, key=order), strict=True):
        assert got[:5] == want[:5]
        assert got[5:] == pytest.approx(want[5:], rel=1e-4)


def test_scores_without_training_rows(spark):
    rows = [(i, "abc def") for i in range(60) if not trained(i)]
    for r in ppm.scored(frame(spark, rows)).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)
        assert r.score == pytest.approx(-8 * math.log10(256), rel=1e-5)
    assert ppm.scored(frame(spark, [])).count() == 0


def test_scores_use_every_context(spark):
    """More contexts of orders 3 and 4 than a table of 32,768 holds."""
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices("".join(map(chr, range(33, 97))), k=20_000))) for i in range(8)]
    rows += [(20 + i, rows[i % 8][1][500 * i : 500 * i + 3000]) for i in range(20)]
    model = PlainPPM([t.encode() for i, t in rows if trained(i)])
    assert sum(len(context) == 3 for context in model.counts) > 60_000
    found = {r.doc_id: r.score for r in ppm.scored(frame(spark, rows)).collect()}
    assert found == {i: pytest.approx(model.score(t.encode()), rel=1e-9) for i, t in rows}


def test_code_lengths_are_a_distribution():
    """After every context, met or not, the probabilities of all symbols add up to 1."""
    grams = Counter()
    for _, t in texts():
        data = b"\0" * 5 + (t or "").encode()[:500] + b"\0"
        grams.update(int.from_bytes(data[i : i + 6], "big") for i in range(len(data) - 5))
    codes = np.array(sorted(grams), np.int64)
    levels = [ppm.Level(codes, np.array([grams[c] for c in codes.tolist()], np.int64))]
    for order in range(4, -1, -1):
        levels.insert(0, levels[0].shorter(order))
    for gram in random.Random(1).sample(codes.tolist(), 200):
        lengths = ppm.code_lengths((gram & ~255) + np.arange(256, dtype=np.int64), levels)
        assert (10.0**lengths).sum() == pytest.approx(1, abs=1e-9)


def plain_edited(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    ordered = [r for _, group in _grouped(ordered) for r in sorted(group, key=lambda r: r[1] or "")]
    out = []
    for k, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    return sorted(out, key=str)


def _grouped(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return groups.items()


@pytest.mark.parametrize(("bits", "ordered"), [(10, 4096), (2, 4)])
def test_imatch(spark, monkeypatch, bits, ordered):
    """Small buckets and windows give the same chain of documents."""
    monkeypatch.setattr(imatch, "BUCKET_BITS", bits)
    monkeypatch.setattr(imatch, "ORDERED", ordered)
    rows = texts() + [(1 << 40, "far away"), (-5, "below zero"), (200, texts()[20][1]), (201, "a b c d e f g h"), (202, "a b c d e f g h")]
    found = imatch.fingerprinted(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=str) == plain_edited(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    prints = {}
    texts_of = {}
    for i, t in rows:
        texts_of.setdefault(i, set()).add(t or "")
    for r in found:
        if len(texts_of[r.doc_id]) == 1:
            prints.setdefault(next(iter(texts_of[r.doc_id])), set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert {r.near_next for r in found if r.doc_id == 202} == {1.0}
    assert len({len(r.fingerprint) for r in found}) == 1

def test_imatch_tells_apart_every_term(spark):
    """Two texts that differ in one word of the band differ in the lexicons that hold it."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(800)]
    rows, spare = [], [f"s{i}" for i in range(60)]
    for k, gone in enumerate(spare):
        words = rng.sample(vocabulary, 40)
        rows += [(2 * k, " ".join([*words, gone])), (2 * k + 1, " ".join([*words, spare[k - 1]]))]
    found = {r.doc_id: r.near_next for r in imatch.fingerprinted(frame(spark, rows)).collect()}
    assert all(found[2 * k + 1] < 1 for k in range(60))


@pytest.mark.parametrize("kept", [1, 2, 5, 7, 8])
def test_imatch_has_one_rule_for_any_number_of_terms(spark, kept):
    """Texts with the same terms in the band are alike, whatever rarer words are beside."""
    band = [f"b{i}" for i in range(9)]
    rows = [(i, " ".join([band[i % 9], band[(i + 1) % 9], f"only{i}"])) for i in range(200)]
    rows += [(300 + j, " ".join(band[:kept] + [f"rare{j}x{i}" for i in range(30)])) for j in range(2)]
    rows = [(i, t) for i, t in rows if i >= 300 or i < 90] + [(1000 + i, f"filler{i}") for i in range(300)]
    found = {r.doc_id: r.near_next for r in imatch.fingerprinted(frame(spark, rows)).collect()}
    assert found[301] == 1


def signed_hash(data, seed=42):
    value = xxhash.xxh64_intdigest(data, seed)
    return value - (1 << 64) if value >> 63 else value


def array_hash(values):
    seed = 42
    for value in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", value), seed)
    return 1 + (seed - (1 << 64) if seed >> 63 else seed) % 16777215


def plain_print(text, lexicon, common):
    """The hash of all terms of the lexicon, then that of the smallest subset of every part."""
    terms = {signed_hash(w) for w in bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()).split()}
    kept = {t for t in terms if t % imatch.BITS in lexicon} or {t for t in terms if t % imatch.BITS not in common} or terms
    if not kept:
        return [0] * (imatch.FIELDS + 1)
    out = [array_hash(sorted(kept))]
    span = (1 << 64) // imatch.FIELDS
    for part in range(imatch.FIELDS):
        low = -(1 << 63) + part * span
        own = sorted(t for t in kept if low <= t < low + span)
        if own:
            width = (own[0] - low).bit_length()
            level = (span.bit_length() - 1) - width
            out.append(level * (1 << 24) + array_hash([t for t in own if t - low < 1 << width]))
        else:
            out.append(0)
    return out


def plain_likeness(left, right):
    if left[0] == right[0]:
        return 1.0
    held = [(a, b) for a, b in zip(left[1:], right[1:], strict=True) if a or b]
    return min(sum(a == b for a, b in held) / len(held), len(held) / (len(held) + 1))


def test_imatch_as_plain(spark):
    rng = random.Random(15)
    words = [f"Word{i}" for i in range(300)] + ["é", "a\x00b"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.choice([0, 1, 4, 40, 200])))) for i in rng.sample(range(5000), 120)]
    rows += [(9000, "only here"), (9001, rows[0][1]), (9002, None), (-4, "Word0 word1"), (9003, "solo " * 9000)]
    df = Counter(t for _, text in rows for t in {signed_hash(w) for w in (text or "").lower().encode().split()})
    most = max(imatch.MIN_DOCS, imatch.MAX_SHARE * len(rows))
    least = max(imatch.MIN_DOCS, imatch.MIN_SHARE * len(rows))
    lexicon = {t % imatch.BITS for t, n in df.items() if least <= n <= most}
    common = {t % imatch.BITS for t, n in df.items() if n > most}
    ordered = sorted(rows, key=lambda row: -row[0])
    expected = {}
    for at, (i, text) in enumerate(ordered):
        text, following = text or "", ordered[(at + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, ahead = (plain_print(t, lexicon, common) for t in (text, edited, following))
        written = ["".join(f"{h:08x}" for h in hashes) for hashes in (own, changed)]
        expected[i] = (*written, plain_likeness(own, changed), plain_likeness(own, ahead))
    found = imatch.fingerprinted(frame(spark, rows)).collect()
    assert {r.doc_id: (r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in found} == expected
    assert {len(set(lexicon) & set(common)), bool(lexicon), bool(common)} == {0, True}


def test_imatch_of_nothing(spark):
    assert imatch.fingerprinted(frame(spark, [])).count() == 0


def test_imatch_keeps_the_next_lower_id(spark, monkeypatch):
    monkeypatch.setattr(imatch, "ORDERED", 16)
    rng = random.Random(2)
    ids = sorted({rng.getrandbits(63) * rng.choice([1, -1]) >> rng.choice([0, 20, 45]) for _ in range(300)})
    found = {r.id: r.lower for r in imatch.next_lower(spark.createDataFrame([(i,) for i in ids], "id long")).collect()}
    assert found == dict(zip(ids, [None, *ids[:-1]], strict=True))
