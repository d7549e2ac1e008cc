"""The pipeline, stage by stage, and the queries that SQL can express."""

import random
import re

import duckdb
import pytest
from compare import rows_of
from test_dedup import plain_lines, plain_print, union

import __spark_entry__ as contract
import corpus_pipeline
from shelfmark.llm import common, components, line_dedup, quality_classifier, quality_rules, simhash

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_entry_registers_everything():
    names = list(contract.queries())
    assert [n for n in range(1, 11) if not any(name.startswith(f"op{n}_") for name in names)] == []
    assert "pipeline" in names and {"op3_warc", "op5_url_filters"} <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", ["op3_warc", "op5_url_filters"])
def test_queries_match_their_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SMALL}/pages.parquet')")
    cursor = connection.execute(contract.oracle_sql()[name])
    frame = contract.queries()[name](spark, SMALL)
    assert rows_of(frame.columns, frame.collect()) == rows_of([c[0] for c in cursor.description], cursor.fetchall())


def test_stages_keep_columns_and_take_effect(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = stages["quality_classifier"](spark, docs, SMALL)
    assert good.columns == COLUMNS and 0 < good.count() < docs.count()
    ruled = stages["quality_rules"](spark, docs, SMALL)
    assert ruled.columns == COLUMNS
    texts = {r.doc_id: r.text for r in docs.collect()}
    left = {r.doc_id for r in ruled.collect()}
    failed = {i for i, t in texts.items() if (s := quality_rules.statistics_of(t))[0] < 50 or 100 * s[4] > 50 * s[0]}
    assert not left & failed and len(left) > 0.7 * (len(texts) - len(failed))


def small_documents(spark):
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    rows = [(i, "\n".join(" ".join(rng.choice(words) for _ in range(rng.randrange(3, 25))) for _ in range(3)), "en", "s", 0) for i in range(40)]
    rows += [(50 + i, rows[i][1], "en", "s", 0) for i in range(5)] + [(60, "", "en", "s", 0), (61, None, "en", "s", 0)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_lines_then_near_stage_match_brute_force(spark):
    rows, docs = small_documents(spark)
    stages = dict(corpus_pipeline.STAGES)
    lined = stages["line_dedup"](spark, docs, SMALL)
    assert lined.columns == COLUMNS
    expected = plain_lines([(r[0], r[1]) for r in rows])
    assert sorted((r.doc_id, r.text) for r in lined.collect()) == expected
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in lined.collect())
    near = stages["simhash_near_dedup"](spark, lined, SMALL)
    prints = {i: plain_print(t) for i, t in expected}
    roots = union(list(prints), [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    assert near.columns == COLUMNS
    assert {r.doc_id for r in near.collect()} == {i for i in prints if roots[i] == i}
    packed = stages["best_fit_packing"](spark, near, SMALL).collect()
    assert {r.doc_id for r in packed} == {i for i in prints if roots[i] == i}


def python_in_a_row(plan: str) -> int:
    """The most Python evaluations that rows of one Spark stage go through, each with a worker of its own."""
    above, most = [], 0
    for line in plan.splitlines():
        found = re.match(r"([ :+-]*)(?:\*\(\d+\) )?(\w+)", line)
        if found:
            depth, node = len(found[1]), found[2]
            while above and above[-1][0] >= depth:
                above.pop()
            n = 0 if "Exchange" in node else (above[-1][1] if above else 0) + bool(re.search("MapIn|EvalPython|InPandas|InArrow", node))
            above.append((depth, n))
            most = max(most, n)
    return most


def test_a_task_has_one_python_worker(spark, monkeypatch):
    """Workers outlive their tasks: a second one for each task would stay beside the executor for all later stages."""
    found, stored = {}, common.stored

    def noted(frame, name):
        found[name] = max(found.get(name, 0), python_in_a_row(frame._jdf.queryExecution().executedPlan().toString()))
        return stored(frame, name)

    for module in (components, line_dedup, quality_rules, simhash):
        monkeypatch.setattr(module, "stored", noted)
    _, docs = small_documents(spark)
    docs = stored(docs, "docs")
    for name in ("quality_rules", "line_dedup", "simhash_near_dedup"):
        noted(dict(corpus_pipeline.STAGES)[name](spark, docs, SMALL), name)
    assert {name: found[name] for name in ("vectors", "quality_rules", "lines", "links", "line_dedup", "fingerprints")} == dict.fromkeys(
        ("vectors", "quality_rules", "lines", "links", "line_dedup", "fingerprints"), 1
    )
    assert max(found.values()) == 1


def test_stages_take_empty_tables_and_further_columns(spark):
    _, docs = small_documents(spark)
    wide = docs.selectExpr("*", "1 score", "2 stats", "'x' kept", "3 n_kept", "4 fingerprint", "5 fp", "6 h", "7 key", "8 _gone_id")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SMALL)
        assert out.columns == wide.columns, name
        out.collect()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_run_packs_what_the_stages_keep(spark):
    docs = corpus_pipeline.table(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), "step")
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    found = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in found.select("doc_id").collect()} == kept


def test_quality_stage_is_the_classifier(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.fit(docs, labels)
    difference = model.measure()
    expected = {r.doc_id for r in docs.collect() if model.probability(difference((r.text or "").encode())) >= 0.3}
    found = dict(corpus_pipeline.STAGES)["quality_classifier"](spark, docs, SMALL)
    assert {r.doc_id for r in found.collect()} == expected
