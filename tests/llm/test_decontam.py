import numpy as np

from stratalake.llm import decontam
from stratalake.llm.decontam import Matcher, Myers, budget, clean_documents, find_items, op6_decontamination, pieces, plain


def passage_distance(item, text):
    """Least edit distance of an item to any passage of a text, by the plain table."""
    row = np.arange(len(item) + 1)
    best = row[-1]
    codes = np.array([ord(c) for c in item])
    steps = np.arange(len(item) + 1)
    for c in text:
        new = np.empty_like(row)
        new[0] = 0
        new[1:] = np.minimum(row[:-1] + (codes != ord(c)), row[1:] + 1)
        new = np.minimum.accumulate(new - steps) + steps
        row = new
        best = min(best, row[-1])
    return int(best)


def test_myers_equals_table():
    rng = np.random.default_rng(1)
    for _ in range(150):
        item = "".join(rng.choice(list("abc "), rng.integers(1, 90)))
        text = "".join(rng.choice(list("abc "), rng.integers(0, 120)))
        assert Myers(item).best(text)[0] == passage_distance(item, text)


def test_pieces_are_the_item():
    for n in (32, 47, 48, 100, 1000):
        item = "".join(chr(97 + k % 26) for k in range(n))
        parts = pieces(item)
        assert len(parts) == budget(item) + 1 and "".join(p for _, p in parts) == item
        assert all(item[at : at + len(p)] == p and len(p) >= 16 for at, p in parts)


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        k = rng.integers(0, len(out))
        kind = rng.integers(3)
        if kind == 0:
            out[k] = "q"
        elif kind == 1:
            del out[k]
        else:
            out.insert(k, "z")
    return "".join(out)


def test_edited_passages_are_found():
    rng = np.random.default_rng(8)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "river", "stone"]
    items = tuple((k, " ".join(rng.choice(words, 30))) for k in range(20))
    matcher = Matcher(items)
    for k, item in items:
        for edits in (0, budget(item) // 2, budget(item), budget(item) * 3):
            text = " ".join(rng.choice(words, 50)) + " " + edited(rng, item, edits) + " " + " ".join(rng.choice(words, 50))
            got = {h[0]: h[1] for h in matcher.find(text)}
            for other, form in items:
                true = passage_distance(form, plain(text))
                assert got.get(other) == (true if true <= budget(form) else None)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if len(r.text) < 3000}
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.distance for r in op6_decontamination(spark, folder).collect()}
    assert got
    for d, text in docs.items():
        for i, item in items.items():
            # A passage in the budget shares an untouched piece; without one the table need not be filled.
            if any(p in text for _, p in pieces(item)):
                true = passage_distance(item, text)
                assert got.get((d, i)) == (true if true <= budget(item) else None)
            else:
                assert (d, i) not in got


def test_edges(spark, monkeypatch):
    item = "What is the name of the longest river that flows through the town of stones?"
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, f"x {item.upper().replace(' ', '!! ')} y"), (5, "clean words " * 90_000 + item),
            (6, "a clean text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS Hits", "2 AS item_id")
    bench = spark.createDataFrame([(1, item), (2, item), (2, item), (3, None), (None, item), (4, "short"), (5, item[10:] + " and more to ask")],
                                  "item_id long, text string").selectExpr("*", "'x' AS doc_id")
    for size in (8_000_000, 100):
        monkeypatch.setattr(decontam, "BLOCK_BYTES", size)
        out = find_items(docs, bench)
        assert out.columns == ["doc_id", "text", "item_id", "hits"]
        got = [(r.doc_id, sorted((h.item_id, h.distance) for h in r.hits)) for r in out.collect()]
        both = [(1, 0), (2, 0)]
        assert sorted(got, key=str) == sorted([(1, []), (2, []), (3, both), (3, both), (None, both), (5, both), (6, [])], key=str)
        left = clean_documents(docs, bench)
        assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 6]
    assert find_items(docs, bench.limit(0)).where("size(hits) > 0").count() == 0
    assert find_items(docs.limit(0), bench).count() == 0


def test_short_items_match_as_whole_words():
    matcher = Matcher(((1, plain("Who wrote the Iliad, and when?")), (2, "iliad"), (None, "the"), (3, "x" * 32)))
    for text, expected in (("He asked: who wrote the ILIAD and when", [(None, 0), (1, 0), (2, 0)]), ("who wrote the iliads and when", [(None, 0)]),
                           ("xwho wrote the iliad and when", [(None, 0), (2, 0)]), ("who wrote the iliad and whence", [(None, 0), (2, 0)]),
                           ("iliad", [(2, 0)]), ("iliads other", []), ("a iliads, iliad", [(2, 0)]), ("bathe theme", [])):
        assert [h[:2] for h in matcher.find(text)] == expected, text
    form = plain("He asked: who wrote the Iliad and when")
    assert [form[h[2] : h[3]] for h in matcher.find(form)] == ["the", "who wrote the iliad and when", "iliad"]


def test_short_items_and_items_without_id_are_filtered(spark):
    long = "What is the name of the longest river that flows through the town of stones?"
    docs = spark.createDataFrame([(1, f"so {long} yes"), (2, "Q: Who wrote the Iliad, and when? A: Homer."), (3, "clean"), (4, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, long), (7, "Who wrote the Iliad and when?"), (8, "?!"), (9, None)], "item_id long, text string")
    assert sorted(r.doc_id for r in clean_documents(docs, bench).collect()) == [3, 4]
    got = find_items(docs, bench, unnamed=True).collect()
    assert {r.doc_id: [(h.item_id, h.distance) for h in r.hits] for r in got} == {1: [(None, 0)], 2: [(7, 0)], 3: [], 4: []}
