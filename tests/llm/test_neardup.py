import re

import numpy as np

from stratalake.llm import neardup
from stratalake.llm.neardup import (match_threshold, near_duplicates, one_of_each, op1_near_duplicates, shingle_set,
                                    signature)


def sets(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(texts, size, percent):
    """Component of each document by comparing all pairs that share a shingle."""
    own = {i: sets(t, size) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists = {}
    for i, s in own.items():
        for x in s:
            lists.setdefault(x, []).append(i)
    for i, s in own.items():
        shared = {}
        for x in s:
            for j in lists[x]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(own[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(own[i]), root(i)) for i in texts}


def test_query_equals_brute_force(spark):
    for scale in ("sf0.001", "sf0.01"):
        folder = f"/root/testdata/{scale}"
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
        expected = brute(texts, 3, 85)
        rows = op1_near_duplicates(spark, folder).collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def copies(rng, n, words, changes, start=0):
    base = [f"w{k}" for k in rng.integers(0, 5000, words)]
    out = {}
    for i in range(n):
        mine = list(base)
        for k in rng.choice(words, changes, replace=False):
            mine[k] = f"x{rng.integers(10**9)}"
        out[start + i] = " ".join(mine)
    return out


def test_groups_chains_and_borders(spark):
    rng = np.random.default_rng(5)
    texts = copies(rng, 60, 300, 3) | copies(rng, 40, 200, 5, 100) | copies(rng, 30, 120, 3, 200) | copies(rng, 40, 400, 9, 300)
    chain = [f"c{k}" for k in range(200)]
    for i in range(12):
        texts[400 + i] = " ".join(chain[8 * i : 8 * i + 160])
    passage = " ".join(f"p{k}" for k in range(60))
    for i in range(80):
        texts[500 + i] = passage + " " + " ".join(f"q{rng.integers(10**6)}" for _ in range(30))
    for size, percent in ((3, 85), (5, 80)):
        df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, size, percent).collect()}
        assert got == brute(texts, size, percent)


def test_family_whose_members_differ_by_any_number_of_edits(spark):
    """No member need be the original, so pivots lack shingles that most others share."""
    rng = np.random.default_rng(11)
    base = [f"w{k}" for k in rng.integers(0, 5000, 148)]
    texts = {}
    for i in range(220):
        mine = list(base)
        for k in rng.choice(148, rng.integers(1, 12), replace=False):
            mine[k] = f"x{rng.integers(10**9)}"
        texts[i] = " ".join(mine + [f"tail{k} of its own" for k in range(rng.integers(0, 4))])
    for i in range(220, 260):  # a family within the family
        mine = texts[7].split()
        for k in rng.choice(140, rng.integers(0, 6), replace=False):
            mine[k] = f"y{rng.integers(10**9)}"
        texts[i] = " ".join(mine)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, 3, 85).collect()}
    expected = brute(texts, 3, 85)
    assert got == expected and len({c for _, c in expected.values()}) > 20


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (5, "one TWO"), (6, "one two three"),
            (None, "one two"), (None, "only null ids here"), (None, "only null ids here"), (9, long), (10, long + " x"),
            (11, "ÀB c d"), (12, "àB c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS Kept", "7 AS `group`")
    found = near_duplicates(docs, 3, 85).collect()
    assert len(found) == len(rows)
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found}
    assert {(1, 0, 1, True), (2, 0, 2, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (None, 1, 4, False),
            (None, 2, None, True), (10, 39999, 9, False), (12, 1, 12, True)} <= got
    left = one_of_each(docs, 3, 85)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(map(str, [1, 2, 3, 4, 6, None, 9, 11, 12]))
    assert near_duplicates(docs.limit(0)).count() == 0 and one_of_each(docs.limit(0)).count() == 0


def test_signature_estimates():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    errors = []
    for common in (500, 800, 950):
        for _ in range(30):
            x = rng.permutation(a)
            b = np.concatenate([x[:common], rng.integers(0, 2**63, 1000 - common, dtype=np.uint64)])
            errors.append((signature(a) == signature(b)).mean() - common / (2000 - common))
    assert abs(np.mean(errors)) < 0.03
    assert 30 < match_threshold(80) < match_threshold(85) < 45
    assert len(shingle_set(b"a b c d a b c d", 3)) == 4


def test_pairs_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    """Edited copies of one text, and texts that share a passage: few pairs are compared besides those with a pivot."""
    compared = {}
    confirm = neardup._Join.confirm

    def counted(self, pairs, label, with_rest=False):
        out = confirm(self, pairs, label, with_rest)
        compared[label] = out.count()
        return out

    monkeypatch.setattr(neardup._Join, "confirm", counted)
    for many in (200, 400):
        rng = np.random.default_rng(3)
        base = [f"w{k}" for k in rng.integers(0, 5000, 150)]
        texts = {}
        for i in range(many):
            mine = list(base)
            for k in rng.choice(150, rng.integers(1, 6), replace=False):
                mine[k] = f"x{rng.integers(10**9)}"
            texts[i] = " ".join(mine)
        passage = [f"p{k}" for k in range(60)]
        for i in range(1000, 1000 + many):
            own = [f"q{rng.integers(10**9)}" for _ in range(rng.integers(10, 60))]
            texts[i] = " ".join(own[:5] + passage + own[5:])
        docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, 5, 80).collect()}
        assert got == brute(texts, 5, 80)
        assert compared["more"] <= len(texts) // 2, compared


def test_bits_never_count_more_than_a_set_has():
    rng = np.random.default_rng(8)
    for n in (0, 1, 40, 5000):
        bits = neardup.lost_bits(rng.integers(0, 2**63, n, dtype=np.uint64))
        count = sum(int(b).bit_count() for b in bits.view(np.uint64))
        assert len(bits) == neardup.BITS // 64 and min(n, 1) <= count <= n
