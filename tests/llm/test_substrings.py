import hashlib
import random
from collections import Counter

import pytest

from stratalake.llm.common import Scratch, table
from stratalake.llm.paths import compact, nonbranching
from stratalake.llm.substrings import op13_substring_dedup, remove_repeats, repeated_spans

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    out, word = [], ""
    for c in text or "":
        if c in SPACE:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out + [word] if word else out


def brute(texts, window):
    split = [words_of(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def found(spark, texts, window):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = remove_repeats(df, window).orderBy("doc_id").collect()
    return [(r["n_words"], r["n_removed"], r["kept_text"]) for r in rows]


def test_query_equals_brute_force(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    wanted = sorted((d["doc_id"], n, k, hashlib.sha256(t.encode()).hexdigest())
                    for d, (n, k, t) in zip(docs, brute([d["text"] for d in docs], 35)))
    got = op13_substring_dedup(spark, sf)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == wanted
    assert sum(w[2] for w in wanted) > 0


@pytest.mark.parametrize("window, seed", [(3, 1), (4, 2), (35, 3), (70, 4)])
def test_few_words(spark, window, seed):
    """Few different words, so windows overlap with themselves, form cycles and branch often."""
    rng = random.Random(seed)
    phrase = [f"w{rng.randrange(9)}" for _ in range(3 * window)]
    texts = []
    for k in range(25):
        a, b = sorted(rng.sample(range(len(phrase)), 2))
        texts.append(" ".join([f"x{k}"] + phrase[a:b] + [f"y{rng.randrange(3)}"] * rng.randrange(2 * window)))
    texts += [texts[3], texts[3], None, "", " \n", "a b", " ".join("abc" * window), "é b " * window]
    assert found(spark, texts, window) == brute(texts, window)


def test_edges(spark):
    long = " ".join(f"t{k}" for k in range(60_000))
    rows = [(None, long, 1), (None, long, 2), (7, "q " + long[: len(long) // 2], 3), (7, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_Words int").withColumnRenamed("N_Words", "_key")
    out = remove_repeats(df)
    assert out.columns == ["doc_id", "text", "_key", "n_words", "n_removed", "kept_text"]
    wanted = dict(zip([r[2] for r in rows], brute([r[1] for r in rows], 35)))
    assert {r["_key"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in out.collect()} == wanted
    assert remove_repeats(df.where("false")).collect() == []


def test_spans_follow_paths(spark):
    """A passage between own words is one span of one path in every text."""
    passage = " ".join(f"p{k}" for k in range(300))
    texts = [f"a{k} b{k} {passage} c{k}" for k in range(5)] + [passage.split(" p200 ")[0]]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    spans = repeated_spans(df).collect()
    assert sorted((s["start"], s["n_words"]) for s in spans if s["n_words"] > 250) == [(2, 300)] * 5
    assert len({s["path"] for s in spans if s["n_words"] > 250}) == 1


def test_paths(spark):
    """Chains, a cycle, a branch and a lone link against a walk."""
    chain = [(k, k + 1) for k in range(100)]
    ring = [(200 + k, 200 + (k + 1) % 7) for k in range(7)]
    branch = [(300, 301), (300, 302), (303, 304)]
    tips = [(400, 401, True, False), (401, 402, False, True), (400, 403, False, False), (404, 401, True, False),
            (405, 401, True, True)]
    rows = [(a, b, True, True) for a, b in chain + ring + branch] + tips
    follows = spark.createDataFrame(rows, "id long, next long, goes_on boolean, came_from boolean")
    links = nonbranching(follows).selectExpr("id", "next", "2L AS size")
    got = {r["id"]: (r["path"], r["offset"]) for r in compact(links, Scratch(spark), "t").collect()}
    assert {(r["id"], r["next"]) for r in links.where("id >= 400").collect()} == {(401, 402), (405, 401)}
    wanted = {405: (405, 0), 401: (405, 2), 402: (405, 4)} | {k: (0, 2 * k) for k in range(101)} | {200 + k: (200, 2 * k) for k in range(7)} | {303: (303, 0), 304: (303, 2)}
    assert got == wanted
