import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratalake.llm import encoding
from stratalake.llm.encoding import Encoder, split_at_spaces
from stratalake.llm.packing import WINDOW, best_fit, op7_packing, pack, sequences, vocabulary

ALPHABET = "ab c'  \n\t\x0b\x1c  éΣß1½²!_.#İ가　\u0085😀́"


@pytest.mark.parametrize("name, keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_equals_tokenizer(monkeypatch, name, keeps):
    monkeypatch.setattr(encoding, "REMEMBERED", 50)
    monkeypatch.setattr(encoding, "GROUP_CHARS", 300)
    plain = Tokenizer.from_file(vocabulary(name))
    rng = random.Random(3)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += ["don't  'll  x's\n\n y ", "<|endoftext|> a <|startoftext|>", "", "word " * 500, " lead", "trail "]
    for token in ("<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"):
        texts += [f"hello {token} world", f"hello{token}world", f"a  {token}  b", f"{token}\n", f" {token}{token} ", f"'s{token}'s"]
    mine = Encoder(vocabulary(name), keeps)
    for low in range(0, len(texts), 97):
        part = texts[low : low + 97]
        expected = [e.ids for e in plain.encode_batch(part, add_special_tokens=False)]
        assert [x.tolist() for x in mine.encode(part)] == expected
    assert mine.encode([None, ""])[0].tolist() == []
    if keeps:
        assert mine.encode(["hello <|endoftext|> world"])[0].tolist() == [31373, 220, 50256, 995]


@pytest.mark.parametrize("name, keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_words_by_parts_equal_tokenizer(name, keeps):
    mine = Encoder(vocabulary(name), keeps)
    rng = random.Random(5)
    pieces = ["".join(rng.choices("abSÉßÿ×÷µªºΣ.,;:!?'\n)² ", k=rng.randint(1, 12))) for _ in range(4000)]
    pieces += [" Word.\nNext", "a.Σ", "ÀÉ,", " été!?\nd:", "x\ny\nz."]
    if not keeps:  # its pieces hold no spaces
        pieces = [p.replace(" ", "") or "x" for p in pieces]
    assert mine.cuts_words and mine._by_parts(pieces) == mine._by_tokenizer(pieces)


def test_words_are_encoded_once_whatever_marks_follow():
    words = ["Tea", "tea", "crème", "été", "ÿa"]
    ends = [".", ",", "...", "!?", "###", ").", ".\nTea", "\nété", ""]
    texts = [" ".join(w + e for w in words) for e in ends] + ["\n".join(words)]
    mine = Encoder(vocabulary("byte_bpe_50k.json"), True)
    encoded, by_model = [], mine._by_model
    mine._by_model = lambda words: encoded.extend(words) or by_model(words)
    plain = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    got = [x.tolist() for text in texts for x in mine.encode([text])]
    assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    # With and without the space before them.
    assert len(encoded) == len(set(encoded)) <= 2 * len(words)
    assert len(mine.numbers) <= 2 * len(words) + len(ends)


@given(st.lists(st.text(alphabet=ALPHABET + "É×ª$-\r\x00\u2003“", max_size=30), max_size=6))
@settings(max_examples=300, deadline=None)
def test_cuts_of_several_texts(texts):
    counts, pieces = encoding.at_spaces(texts)
    expected = [[p for p in split_at_spaces(t) if p] for t in texts]
    assert counts.tolist() == [len(e) for e in expected] and pieces.to_pylist() == sum(expected, [])
    counts, pieces = encoding.at_spaces(texts, at_marks=True)
    ends = np.cumsum(counts)
    assert ["".join(pieces.to_pylist()[e - n : e]) for n, e in zip(counts, ends)] == texts


@given(st.text(alphabet=ALPHABET, max_size=40))
@settings(max_examples=300, deadline=None)
def test_cuts_keep_the_text(text):
    assert "".join(split_at_spaces(text)) == text


def slow_best_fit(lengths, window):
    rooms, where = [], [None] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fits = [r for r in range(len(rooms)) if rooms[r] >= lengths[k]]
        if fits:
            best = min(rooms[r] for r in fits)
            r = next(r for r in fits if rooms[r] == best)
        else:
            rooms.append(window)
            r = len(rooms) - 1
        rooms[r] -= lengths[k]
        where[k] = r
    return sorted(rooms)


def test_best_fit_equals_plain_search():
    rng = np.random.default_rng(1)
    for n, window in ((0, 16), (1, 16), (200, 64), (500, 1024), (300, 7)):
        lengths = rng.integers(1, window, n) if n else np.empty(0, np.int64)
        sequence, offset = best_fit(lengths, window)
        used = np.zeros(sequence.max() + 1 if n else 0, np.int64)
        for s, o, length in sorted(zip(sequence, offset, lengths)):
            assert used[s] == o
            used[s] += length
        assert sorted(window - used) == slow_best_fit(lengths.tolist(), window)


def check(rows, texts):
    plain = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    ids = {i: e.ids + [0] for i, e in zip(texts, plain.encode_batch([t or "" for t in texts.values()], add_special_tokens=False))}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert r.length == len(piece) and r.ids_crc32 == zlib.crc32(piece.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert by_doc.keys() == texts.keys()
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[i])
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= WINDOW
        padding += 0 if at & (at - 1) == 0 else WINDOW - at
    return padding / sum(len(x) for x in ids.values())


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert check(op7_packing(spark, folder).collect(), texts) < 0.005


def test_edges(spark):
    texts = {1: None, 2: "", 3: "a", 4: "word " * 1024, 5: "x" * 40_000, 6: " \n ", 7: "hello <|endoftext|> world"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "1 AS uid", "2 AS Start")
    path = vocabulary("byte_bpe_50k.json")
    packed = pack(docs, path, keep_ids=True).cache()
    check(packed.drop("ids").collect(), texts)
    for r in sequences(packed).collect():
        assert len(r.ids) in (WINDOW, r.n_tokens) and (len(r.ids) == WINDOW or r.n_tokens & (r.n_tokens - 1) == 0)
    double = pack(docs.union(docs).selectExpr("if(doc_id = 3, null, doc_id) AS doc_id", "text"), path)
    assert double.count() == 2 * packed.count() and double.where("doc_id IS NULL").count() == 2
    assert pack(docs.limit(0), path).count() == 0
