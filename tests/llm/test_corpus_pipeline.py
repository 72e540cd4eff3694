import re

import corpus_pipeline
from stratalake.llm import langid
from stratalake.llm.decontam import budget, pieces, plain
from test_decontam import passage_distance
from test_neardup import brute as groups
from test_packing import check as check_packing
from test_secrets import brute as findings

FOLDER = "/root/testdata/sf0.001"


def leaked(text, items):
    form = plain(text)
    return any(any(p in form for _, p in pieces(i)) and passage_distance(i, form) <= budget(i) for i in items)


def test_each_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("n_chars < 6000").selectExpr("*", "doc_id % 3 AS Hits", "'x' AS kept")
    items = [plain(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        before = rows
        if name == "packing":
            check_packing(out.collect(), {i: r.text for i, r in rows.items()})
            break
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        rows = {r.doc_id: r for r in out.collect()}
        if name == "language":
            languages, _, bits = langid.learn(docs).predict([r.text for r in before.values()])
            assert set(rows) == {i for i, x, b in zip(before, languages, bits) if x != "und" and b <= langid.MOST_BITS}
            assert len(rows) > 0.97 * len(before)
        elif name == "near_dedup":
            found = groups({i: r.text for i, r in before.items()}, 5, 80)
            assert set(rows) == {i for i, (n, c) in found.items() if not n or i == c} and len(rows) < len(before)
        elif name == "decontamination":
            assert set(rows) == {i for i, r in before.items() if not leaked(r.text, items)} and len(rows) < len(before)
        else:
            assert set(rows) == set(before)
            for i, r in rows.items():
                assert not findings(r.text) and r.n_chars == len(r.text)
                if not findings(before[i].text) and not re.search(r"\w{16,}", before[i].text):
                    assert r.text == before[i].text
            assert any("[SECRET]" in r.text for r in rows.values())
        if name != "secrets":
            assert all(rows[i] == before[i] for i in rows)
        docs = spark.createDataFrame(list(rows.values()), docs.schema)


def test_run_on_empty_and_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(None, None, None, None, None), (1, "", "en", None, 0), (2, "1 2 3", None, "s", 5), (3, "good old words here", "en", "s", None),
           (3, "good old words here", "en", "s", None), (4, "more of the good words", "en", None, 22)]
    for k, rows in enumerate(([], odd)):
        folder = f"{tmp_path}/{k}"
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        assert sorted(r.doc_id for r in out) == [3, 4][: len(rows)]
