import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from stratalake.llm.common import table
from stratalake.llm.spelling import corpus_words, op11_spelling_variants, spelling_groups


def brute_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    """Whether exactly one insertion, deletion or replacement makes b of a, told from the common ends."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return any(a[k + x :] == b[k + y :] for x, y in ((1, 1), (1, 0), (0, 1)) if abs((len(a) - x) - (len(b) - y)) == 0)


def brute_groups(counts):
    cut = defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            cut[w[:k] + w[k + 1 :]].add(w)
        cut[w].add(w)
    near = defaultdict(set)
    for group in cut.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda b: (-counts[b], b), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, sf):
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    frame = op11_spelling_variants(spark, sf)
    assert dict(frame.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    got = sorted((tuple(r) for r in frame.collect()), key=str)
    assert got == brute_groups(brute_words(docs)) and any(r[1] for r in got)


@pytest.mark.parametrize("letters, longest, n, seed", [("ab", 7, 150, 1), ("abc", 6, 500, 2), ("a", 40, 40, 3), ("aéÿz", 9, 400, 4)])
def test_dense_words(spark, letters, longest, n, seed):
    """Few letters: words are prefixes of each other and have neighbours of every kind."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(n)}
    counts = {w: rng.choice([3, 4, 7, 9, 20, 50, 50, 200]) for w in words}
    got = spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_groups(counts)


def test_long_words(spark):
    """Words of thousands of letters with one common beginning take few levels."""
    long = "".join(random.Random(1).choice("acgt") for _ in range(5000))
    counts = {long: 9, long[:4000] + long[4001:]: 3, long[:2500] + "x" + long[2500:]: 4, long[:50] + "y" + long[51:]: 5, long + "z": 100, long[:4990]: 3}
    got = spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_groups(counts)


def test_words_of_odd_tables(spark):
    rows = [(None, "Hallo-hallo HALLO Étude×étude"), (None, "Hallo-hallo HALLO"), (3, None), (4, ""), (5, "words1words2words_words"),
            (6, "İstanbul ſtart " * 3)] + [(k, "spelling") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS N", "'x' AS label")
    got = {r["word"]: r["n"] for r in corpus_words(df).collect()}
    assert got == brute_words(rows) and len([w for w in got if w.startswith("s")]) >= 1
    assert spelling_groups(corpus_words(df.where("false"))).collect() == []
    assert op11_spelling_variants.__doc__
