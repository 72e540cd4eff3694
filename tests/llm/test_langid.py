import math

import numpy as np

from stratalake.llm import langid
from stratalake.llm.langid import MOST_BITS, Model, compile_model, identify, learn, op9_language_id


def trees(texts):
    out = {}
    for lang, text in texts.items():
        raw, tree = text.encode(), {}
        for size in range(langid.ORDER + 1):
            for i in range(size, len(raw)):
                after = tree.setdefault(raw[i - size : i], {})
                after[raw[i]] = after.get(raw[i], 0) + 1
        out[lang] = tree
    return out


def brute(counts, model, lang, text):
    """The code length by walking the trees byte by byte."""
    tree = counts[lang]
    known = {c for t in counts.values() for c, a in t.items() if sum(a.values()) >= langid.LEAST_CONTEXT}
    known = {c[k:] for c in known for k in range(len(c) + 1)} | {b""}

    def chance(ctx, b):
        shorter = (lambda x: chance(ctx[1:], x)) if ctx else (lambda x: 1 / 256)
        after = tree.get(ctx, {})
        if not after or ctx and sum(after.values()) < langid.LEAST_CONTEXT:
            return shorter(b)
        whole = sum(after.values()) + len(after)
        if b in after:
            return after[b] / whole
        left = max(1e-9, 1 - sum(shorter(x) for x in after))
        return len(after) / whole * min(1, shorter(b) / left)

    bits = 0
    for i, b in enumerate(text):
        for size in range(min(langid.ORDER, i), -1, -1):
            if text[i - size : i] in known:
                break
        # the walk goes from short to long and stops at the first unknown context
        size = next((k for k in range(1, min(langid.ORDER, i) + 1) if text[i - k : i] not in known),
                    min(langid.ORDER, i) + 1) - 1
        bits += round(-math.log2(max(2.0**-40, chance(text[i - size : i], b))) * 1024)
    return bits


def test_code_lengths_equal_tree_walk(monkeypatch):
    counts = trees({"a": "the cat sat on the mat, the cat sat there", "b": "der hund und die katze und der hut"})
    model = compile_model(counts)
    texts = [b"the hut and the cat", b"", b"der", "über".encode(), b"x" * 50, b"the" * 40]
    for window in (1 << 19, 7):
        monkeypatch.setattr(langid, "_WINDOW", window)
        lengths = model.code_lengths(texts)
        for row, text in zip(lengths, texts):
            for column, lang in enumerate(model.languages):
                assert abs(row[column] - brute(counts, model, lang, text)) <= len(text)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = op9_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "n_chars"), "doc_id")
    rows = out.where("held_out").collect()
    good = [r.lang == r.lang_pred for r in rows]
    assert len(rows) > 250 and np.mean(good) > 0.97
    assert all(0 <= r.score <= 1 and r.bits_per_byte < MOST_BITS for r in rows)
    assert out.count() == docs.count()


def test_edges(spark):
    rows = [(1, "hello there my friend", "en"), (1, "hello there my friend", "en"), (2, None, "en"), (3, "", None),
            (4, "1234 !!", "de"), (None, "bonjour mon ami", "fr"), (6, "word " * 200_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS Score")
    model = learn(docs)
    out = identify(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score", "bits_per_byte"]
    got = {r.doc_id: r.lang_pred for r in out.collect()}
    assert out.count() == 7 and got[2] == got[3] == got[4] == "und" and got[1] == "en"
    nothing = learn(docs.limit(0))
    assert isinstance(nothing, Model) and {r.lang_pred for r in identify(docs, nothing).collect()} == {"und"}
    assert identify(docs.limit(0), model).count() == 0
