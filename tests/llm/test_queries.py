"""The registered queries against SQL on whole tables, and the pipeline's stages against brute force."""

import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from sieveline.llm import quality_knn, registry, simhash
from sieveline.llm.common import read, shared_folder, stored
from tests.llm import small

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="benchmark tables are not here")


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = registry.queries()[name](spark, DATA)
    cursor = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    got = [tuple(r[c] for c in names) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(cursor.fetchall(), key=repr)


def test_native_query_runs_no_python(spark):
    plan = registry.queries()["op1_temperature_mixing"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_near_copies_of_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, DATA, "documents").collect()]
    got = registry.queries()["op4_tiled_simhash"](spark, DATA).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted((d, *c) for (d, _), c in zip(rows, small.components(rows)))


def test_stages_against_brute_force(spark):
    docs = read(spark, DATA, "documents")
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, DATA), name)
        results[name] = before, docs
        if name != "packing":
            assert docs.columns == before.columns
    before, after = results["quality"]
    scores = quality_knn.with_scores(before, quality_knn.fit(before, read(spark, DATA, "labels")), out="s")
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scores.collect() if r.s >= 0.3}
    before, after = results["line_dedup"]
    want = small.line_deduped([(r.doc_id, r.text) for r in before.collect()])
    assert sorted((r.doc_id, r.text, r.n_chars) for r in after.collect()) == sorted((d, t, len(t)) for d, t, _, _ in want)
    before, after = results["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for (d, _), (_, c) in zip(rows, small.components(rows)) if d == c)
    before, after = results["mixing"]
    times = Counter(r.doc_id for r in after.collect())
    assert set(times) == {r.doc_id for r in before.collect()} and max(times.values()) == 2
    tokens = {r.doc_id: (r.source, len(small.words(r.text))) for r in before.collect()}
    had, drawn = Counter(), Counter()
    for doc, (source, n) in tokens.items():
        had[source] += n
        drawn[source] += n * times[doc]
    largest = max(had, key=had.get)
    assert drawn[largest] == had[largest] and all(drawn[s] >= n for s, n in had.items())
    share = lambda counts, s: counts[s] / sum(counts.values())
    assert share(drawn, largest) < share(had, largest)
    before, after = results["packing"]
    assert Counter(r.doc_id for r in after.where("start = 0").collect()) == Counter(r.doc_id for r in before.collect())
    whole = corpus_pipeline.run(spark, DATA)
    assert sorted(map(tuple, whole.select("doc_id", "start", "ids_crc32").collect())) == sorted(map(tuple, after.select("doc_id", "start", "ids_crc32").collect()))


def test_stages_on_awkward_rows(spark, tmp_path):
    names = "doc_id bigint, text string, lang string, source string, n_chars int, quality_score int, lines_before string, mix_block int, `row` string, doc string, tokens int"
    texts = [None, "", " \n ", "one two three", "words " * 30_000, *[" ".join(f"w{k}{i}" for i in range(40)) for k in range(40)]]
    rows = [(None if k % 7 == 3 else k, t, "en", None if k % 5 == 1 else f"s{k % 3}", len(t or ""), 1, "a", 2, "b", "c", 3) for k, t in enumerate(texts)]
    rows += [rows[8], rows[8], rows[3]]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(40)] + [(None, 0, 0)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for found in (rows, []):
        docs = spark.createDataFrame(found, names).repartition(2)
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, stored(stage(spark, docs, str(tmp_path)), name)
            if name != "packing":
                assert docs.columns == before.columns
            if name == "near_dedup" and found:
                kept = [(r.doc_id, r.text) for r in docs.collect()]
                # The empty texts are one group, of which the named row and one without an id may stay.
                assert sum(not small.words(t) for _, t in kept) <= 2 and len(kept) >= 40 and len(set(kept)) == len(kept)
            if name == "mixing":
                assert {r.text for r in docs.collect()} == {r.text for r in before.collect()} and docs.count() >= before.count()
        assert (docs.count() > 0) == bool(found)


def test_shared_folder_is_the_session_s(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert simhash.read is read
