"""SimHash groups, union-find and line deduplication beside brute force."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfmark.llm import line_dedup, simhash
from shelfmark.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, h string, n string"


def union(nodes, links):
    parent = {node: node for node in nodes}

    def find(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def frame(spark, texts):
    rows = [(i, text, "en", "s", 0, "x", "y", "z") for i, text in texts]
    return spark.createDataFrame(rows, DOCS)


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 620)]
    links += [(1000, i) for i in range(1001, 1100)]
    expected = union({n for link in links for n in link}, links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {n: r for n, r in expected.items() if n in found} == found
    assert all(expected[n] == n for n in expected if n not in found)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_print(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def near_texts():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(150):
        base = [rng.choice(words) for _ in range(rng.choice([3, 60, 200]))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    return [*enumerate(texts), (900, None), (901, ""), (902, " \n "), (903, "A b"), (904, "a B"), (905, "É"), (906, "é")]


@pytest.mark.parametrize("tree_size", [512, 2])
def test_simhash_groups(spark, tree_size):
    texts = near_texts()
    prints = {i: plain_print(text) for i, text in texts}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    roots = union(ids, links)
    found = simhash.simhash_groups(frame(spark, texts), tree_size=tree_size).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {(i, f"{prints[i]:016x}", roots[i]) for i in ids}
    assert len(found) == len(ids)


def test_simhash_dense_shards(spark):
    """Many fingerprints around one value: shards are dealt again and cut into trees, no link is lost."""
    rng = random.Random(1)
    prints = {rng.getrandbits(64) for _ in range(50)} | {0xF0F0 ^ (1 << a) ^ (1 << b) ^ (1 << c) for a, b, c in (rng.sample(range(64), 3) for _ in range(600))}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    roots = union(signed, [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & simhash.MASK).bit_count() <= 3])
    links = simhash.near_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp long"), tree_size=16)
    found = union(signed, [(r.a, r.b) for r in links.collect()])
    assert found == roots


def test_bk_tree_follows_edges_within_the_radius():
    rng = random.Random(5)
    values = [rng.getrandbits(16) for _ in range(300)]
    tree = simhash.BKTree()
    for value in values:
        tree.add(value)
    for query in range(0, 65536, 999):
        assert sorted(tree.within(query, 3)) == sorted({v for v in values if (v ^ query).bit_count() <= 3})


def test_simhash_repeats_nulls_and_empty(spark):
    rows = frame(spark, [(1, "one two three four"), (1, "one two three four"), (None, "one two three four"), (None, "alone now here"), (5, "one two three four")])
    groups = simhash.simhash_groups(rows)
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in groups.collect()) == [(0, 0), (0, 1), (1, 1), (1, 1), (5, 1)]
    kept = simhash.keep_first(rows, groups)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "alone now here"), (0, "one two three four"), (1, "one two three four")]
    none = frame(spark, [])
    assert simhash.simhash_groups(none).count() == 0
    assert simhash.keep_first(none, simhash.simhash_groups(none)).count() == 0


def plain_lines(texts):
    """Every document's text after brute-force deduplication, all pairs compared."""
    order = sorted(texts, key=lambda row: row[0])
    lines = sorted({line_dedup.normalised(l) for _, t in order for l in (t or "").split("\n")} - {""})
    sets = {l: line_dedup.shingle_set(l) for l in lines}
    links = [(a, b) for a in lines for b in lines if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    roots, seen, out = union(lines, links), set(), []
    for i, text in order:
        kept = []
        for line in (text or "").split("\n"):
            short = line_dedup.normalised(line)
            if short:
                if roots[short] in seen:
                    continue
                seen.add(roots[short])
            kept.append(line)
        out.append((i, None if text is None else "\n".join(kept)))
    return out


def line_texts():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(200)]
    pool = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 12, 40]))) for _ in range(120)]
    texts = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 9)):
            line = rng.choice(pool)
            if rng.random() < 0.4:
                parts = line.split(" ")
                parts[rng.randrange(len(parts))] = rng.choice(words)
                line = " ".join(parts)
            lines.append(rng.choice([line, line.upper(), f"  {line} "]))
        texts.append((i, "\n".join(lines)))
    return [*texts, (100, None), (101, ""), (102, "\n\n"), (103, "é\nÉ\nok"), (104, "x" * 50_000), (105, "y\n" + "x" * 50_001)]


@pytest.mark.parametrize("tile", [128, 2])
def test_line_dedup(spark, tile):
    texts = line_texts()
    found = line_dedup.deduplicated(frame(spark, texts), tile=tile)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp", "h", "n", "n_lines", "n_kept"][:8] + ["n_lines", "n_kept"]
    assert sorted((r.doc_id, r.text) for r in found.collect()) == plain_lines(texts)


def test_line_dedup_of_repeats_and_nothing(spark):
    rows = frame(spark, [(2, "same line"), (2, "same line"), (None, "same line\nother"), (7, "same line")])
    found = sorted((r.doc_id or 0, r.text, r.n_lines, r.n_kept) for r in line_dedup.deduplicated(rows).collect())
    assert found == [(0, "other", 2, 1), (2, "same line", 1, 1), (2, "same line", 1, 1), (7, "", 1, 0)]
    assert line_dedup.deduplicated(frame(spark, [])).count() == 0


def test_band_recall():
    """Lines at a similarity of 0.8 and more meet in a band."""
    rng = random.Random(2)
    met = total = 0
    while total < 400:
        a = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300))
        b = list(a)
        for _ in range(4):
            b[rng.randrange(300)] = "#"
        b = "".join(b)
        x, y = line_dedup.shingle_set(a), line_dedup.shingle_set(b)
        if 0.8 <= len(x & y) / len(x | y) <= 0.85:
            total += 1
            keys = line_dedup.bands_of([a, b])
            met += bool((keys[0] == keys[1]).any())
    assert met / total >= 0.97


def test_signing_sends_lines_on_in_parts_without_losing_any(monkeypatch):
    texts = ["one line\ntwo line\none  line", " \n", None, "", "two line\nthree line\nfour line", "\t", "five\nfive\nsix"]
    frame = pd.DataFrame({"id": [str(i) for i in range(len(texts))], "text": texts})

    def rows():
        signed = pd.concat(line_dedup._signed(7, 12, 5)(iter([frame, frame.iloc[:0], frame])))
        bands = [None if b is None else tuple(b) for b in signed["bands"]]
        return list(zip(signed["id"], signed["line_no"], signed["h"], bands, signed["again"], strict=True))

    whole = rows()
    monkeypatch.setattr(line_dedup, "LINES_AT_ONCE", 1)
    assert rows() == whole
    assert [row[4] for row in whole[:7]] == [True, False, False, False, False, True, False]
    assert len(whole) == 14
    assert sum(row[3] is not None for row in whole) == 6


def test_lines_of_a_whole_text_are_those_of_its_lines():
    rng = random.Random(4)
    parts = ["Ab", "c", "ΑΣ", "ΣΑ", "İ", " ", "  ", "\n", "\n\n", "\t", "\r", "　", "\x85", "\x1c", "\x0b", ".", "ß"]
    plain = ["Ab", "c", " ", "\n", ".", "X"]
    for pool in (parts, plain):
        for _ in range(4000):
            text = "".join(rng.choice(pool) for _ in range(rng.randrange(12)))
            assert line_dedup.normalised_lines(text) == [line_dedup.normalised(line) for line in text.split("\n")], repr(text)


def banded_lines(rng):
    """Lines with 3 band keys each: many alone, some shared, one key of very many lines, lines that were signed twice."""
    keys = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(900)] + [-(1 << 63), (1 << 63) - 1, 0, -1]
    rows = [(h, [rng.choice(keys), rng.choice(keys), 77 if rng.random() < 0.5 else rng.choice(keys)]) for h in rng.sample(range(-(1 << 40), 1 << 40), 500)]
    alone = [(i, [1 << 61 | i, 1 << 60 | i, 1 << 59 | i]) for i in range(300)]
    return [(h, np.array(keys, np.int64).tobytes()) for h, keys in rows + rows[:200] + alone + alone]


def test_shared_band_keys_are_those_of_two_lines(spark):
    rows = banded_lines(random.Random(6))
    lines = {}
    for h, keys in rows:
        for key in np.frombuffer(keys, np.int64).tolist():
            lines.setdefault(key, set()).add(h)
    expected = sorted(key for key, found in lines.items() if len(found) > 1)
    banded = spark.createDataFrame(rows, "h long, bands binary")
    for part in (1 << 16, 50):
        shared = line_dedup._shared_buckets(banded, part)
        assert sorted(r.bucket for r in shared.collect()) == expected
    for bits in (1 << 20, 64):
        marked = {(r.h, r.bucket) for r in line_dedup._marked_buckets(banded, shared, bits).collect()}
        assert {(h, key) for key in expected for h in lines[key]} <= marked <= {(h, key) for key, found in lines.items() for h in found}
    assert line_dedup._shared_buckets(banded.limit(0)).count() == 0


def test_band_keys_are_dealt_in_ranges_and_a_frequent_one_by_its_ends(monkeypatch):
    rows = banded_lines(random.Random(8))
    batches = [pa.RecordBatch.from_pylist([{"h": h, "bands": keys} for h, keys in rows[i : i + 70]]) for i in range(0, len(rows), 70)]
    n = 3 * len(rows)
    whole = None
    for at_once in (1 << 18, 300, 1):
        monkeypatch.setattr(line_dedup, "BUCKETS_AT_ONCE", at_once)
        dealt = list(line_dedup._dealt_buckets(8)(iter(batches)))
        # A row for a range of keys and not for a key.
        assert sum(map(len, dealt)) <= 8 * len(dealt) and (at_once == 1 or len(dealt) <= 3 * n // at_once + 1)
        pairs = [np.frombuffer(pairs, np.int64).reshape(-1, 2) for batch in dealt for pairs in batch.column("pairs").to_pylist()]
        assert all((p[:, 0] == 77).sum() <= 2 for p in pairs)
        in_order = pa.Table.from_batches(dealt).sort_by("part").to_batches(5)
        met = sorted(bucket for batch in line_dedup._met_buckets(iter(in_order)) for bucket in batch.column("bucket").to_pylist())
        assert 77 in met
        whole = whole or sorted(set(met))
        assert sorted(set(met)) == whole


def test_a_bucket_of_like_lines_is_sent_once(spark):
    """20,000 like lines in one bucket: rows grow with the lines, and no second pass is needed."""
    n, tile = 20_000, 512
    rows = spark.range(n).selectExpr("0L low", "7L bucket", "id h", f"cast(pmod(id, {-(-n // tile)}) as int) slot", f"{-(-n // tile)} tiles")
    assert line_dedup._by_themselves(rows).count() == n + -(-n // tile) - 1
    one = spark.range(1, n).selectExpr("id node", "0L root")
    assert line_dedup._still_apart(rows, one, tile).count() == 0
    # Three lines stay apart: the others meet them once.
    most = one.where("node > 3")
    assert line_dedup._still_apart(rows, most, tile).count() == (n - 3) + 3 * (1 + -(-(n - 3) // tile))


def test_large_buckets_lose_no_link(spark):
    """Many families of like lines that share a bucket, in tiles of 4: groups are those of all pairs."""
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz "
    texts = []
    for family in range(6):
        base = "".join(rng.choice(letters) for _ in range(200))
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(200)] = rng.choice(letters)
            texts.append((len(texts), "".join(copy)))
    lines = sorted({line_dedup.normalised(text) for _, text in texts})
    found = [(line_dedup.line_hash(line), line, line_dedup.shingle_set(line)) for line in lines]
    expected = union([h for h, _, _ in found], [(a, b) for a, _, x in found for b, _, y in found if a < b and len(x & y) >= 0.8 * len(x | y)])
    members = spark.createDataFrame([(min(expected), 7, h, i % 38, 38) for i, (h, _, _) in enumerate(found)], "low long, bucket long, h long, slot int, tiles int")
    texts = spark.createDataFrame([(h, line) for h, line, _ in found], "h long, line string")
    roots = components(line_dedup._links(line_dedup._by_themselves(members), texts, 0.8, 7))
    more = line_dedup._links(line_dedup._still_apart(members, roots, 4), texts, 0.8, 7)
    roots = {r.node: r.root for r in components(roots.selectExpr("root a", "node b").union(more)).collect()}
    assert {h: roots.get(h, h) for h in expected} == expected
