"""The compression classifier and the robust quality rules."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import quality_classifier, quality_rules

TESTDATA = "/root/testdata/sf0.01"


def plain_stats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(marked)


def test_statistics():
    rng = random.Random(4)
    texts = [None, "", " \n\t", "a", "a b", "x y z x y z x y", "l\nl\n\nl ", "é ü\x0bß x # | <b>", "a\x1cb \x85c"]
    texts += [rng.choice(["", " ", "\n"]).join(rng.choice(["ab", "c", " ", "\n", "#", "é", "ab c ab"]) for _ in range(60)) for _ in range(200)]
    for text in texts:
        assert quality_rules.statistics_of(text)[:5] == plain_stats(text), repr(text)


def rows(spark, n=400):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(500)]
    out = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(int(rng.lognormvariate(5, 0.6)) + 50))
        out.append((i, text, rng.choice(["en", "de"]), rng.choice(["a", "a", "a", "b", None]), 1, "s", True))
    for i in range(n, n + 8):
        out.append((i, " ".join(rng.choice(words) + "###$$$&&&***" for _ in range(200)), "en", "a", 1, "s", False))
    out += [(900, None, "en", "a", 1, "s", None), (901, "few words", None, None, 1, "s", None), (901, "few words", None, None, 1, "s", None)]
    return spark.createDataFrame(out, "doc_id long, text string, lang string, source string, n_chars long, stats string, kept boolean")


def test_outliers_go_and_the_rest_stays(spark):
    docs = rows(spark)
    judged, stats, failed, kept = quality_rules.judged(docs)
    assert judged.columns[:7] == docs.columns and kept not in docs.columns and stats not in docs.columns
    found = judged.select("doc_id", F.col(failed).alias("f"), F.col(kept).alias("k")).collect()
    assert len(found) == 411
    normal = [r.k for r in found if r.doc_id < 400]
    assert sum(normal) >= 396 and not any(r.f for r in found if r.doc_id < 400)
    assert not any(r.k for r in found if 400 <= r.doc_id < 408)
    assert all(r.f and not r.k for r in found if r.doc_id >= 900)


def test_small_and_empty_tables_have_base_rules_only(spark):
    docs = rows(spark, 5).where("doc_id < 5")
    judged, _, failed, kept = quality_rules.judged(docs)
    assert all(r[kept] == (not r[failed]) for r in judged.collect())
    none, _, _, _ = quality_rules.judged(docs.limit(0))
    assert none.count() == 0


def test_mcd_ignores_a_third_of_outliers():
    """A step on binned rows against numpy's own estimate of the closest half."""
    rng = np.random.default_rng(3)
    assert abs(quality_rules.chi_square(0.975, 6) - 14.449) < 0.05
    assert abs(quality_rules.chi_square(0.5, 6) - 5.348) < 0.02
    import pandas as pd

    z = np.vstack([rng.normal(size=(700, quality_rules.P)), rng.normal(6, 0.3, size=(300, quality_rules.P))])
    params = {"m": np.zeros(quality_rules.P), "inv": np.eye(quality_rules.P)}
    for _ in range(6):
        d2 = np.einsum("ij,jk,ik->i", z - params["m"], params["inv"], z - params["m"])
        bins = np.minimum(quality_rules.BINS - 1, np.floor(24 * np.log1p(d2))).astype(int)
        frame = []
        for b in np.unique(bins):
            own = z[bins == b]
            row = {"key": "k", "start": 0, "bin": int(b), "n": len(own)} | {f"t{i}": own[:, i].sum() for i in range(quality_rules.P)}
            frame.append(row | {f"t{i}_{j}": (own[:, i] * own[:, j]).sum() for i, j in quality_rules.PAIRS})
        found = quality_rules._step(None)(pd.DataFrame(frame)).iloc[0]
        inverse = np.zeros((quality_rules.P, quality_rules.P))
        for i, j in quality_rules.PAIRS:
            inverse[i, j] = inverse[j, i] = found[f"a{i}_{j}"] / (1 if i == j else 2)
        params = {"m": np.array([found[f"c{i}"] for i in range(quality_rules.P)]), "inv": inverse}
    assert np.abs(params["m"]).max() < 0.3


def auc(scores, marks):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    good = marks == 1
    return (rank[good].mean() - (good.sum() - 1) / 2) / (~good).sum()


def test_classifier_ranks_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{TESTDATA}/documents.parquet"), spark.read.parquet(f"{TESTDATA}/labels.parquet")
    found = quality_classifier.classified(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert found["score"].between(0, 1).all()
    assert auc(found["score"].to_numpy(), found["quality"].to_numpy()) > 0.9
    good = found[found["quality"] == 1]
    assert good["predicted"].mean() > 0.95
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) for i in found["doc_id"])


def test_classifier_edges(spark):
    schema = "doc_id long, text string, score string"
    docs = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "", "x"), (3, "word " * 40_000, "x")], schema)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality_classifier.classified(docs, labels).collect()
    assert len(found) == 4 and {r.score for r in found} == {0.5} and {r.predicted for r in found} == {1}
    some = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (3, 1, 0), (4, None, 0), (None, 1, 0)], labels.schema)
    assert all(0 <= r.score <= 1 for r in quality_classifier.classified(docs, some).collect())
    assert quality_classifier.classified(docs.limit(0), some).count() == 0


def test_equal_texts_score_alike_whatever_else_they_have(spark):
    model = quality_classifier.CompressionModel(b"good text here " * 20, b"### $$$ &&& " * 20, 5.0, 0.1)
    docs = spark.createDataFrame([("good text",), ("good text",), ("### $$$",)], "text string")
    found = [r.s for r in docs.select("text", quality_classifier.score(F.col("text"), model).alias("s")).orderBy("text").collect()]
    assert found[1] == pytest.approx(found[2], abs=0) and found[0] < found[1]
