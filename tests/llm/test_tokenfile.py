import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from stratalake.llm import encoding, tokenfile
from stratalake.llm.packing import vocabulary
from stratalake.llm.tokenfile import (CHECKPOINT, LANES, PRECISION, CorruptFile, Segment, frequencies, op8_token_files,
                                      read_tokens, write_segment, write_tokens)
from stratalake.session import scratch_path


def documents(rng, sizes, top=49407):
    return [np.minimum(rng.zipf(1.3, n), top).astype(np.uint32) for n in sizes]


def test_round_trip(monkeypatch):
    rng = np.random.default_rng(4)
    for sizes, top in (([], 9), ([1], 9), ([1, 1], 1), ([LANES], 49407), ([LANES + 1, 7], 9), ([1_200_000, 3, 65_536], 49407)):
        docs = documents(rng, sizes, top)
        segment = Segment(write_segment(docs))
        whole = np.concatenate(docs) if docs else np.empty(0)
        assert segment.lengths.tolist() == sizes and (segment.ids() == whole).all()
    for number in range(len(segment.places)):
        block = segment.block(number)
        assert (segment.block(number) == block).all()
        parts = -(-len(block) // (LANES * CHECKPOINT))
        pieces = [segment.block(number, k, k + 1) for k in range(parts)]
        assert (np.concatenate(pieces) == block).all()
    uniform = [np.arange(49_408, dtype=np.uint32)]
    assert (Segment(write_segment(uniform)).ids() == uniform[0]).all()


def test_frequencies_sum_up():
    rng = np.random.default_rng(1)
    for counts in (np.array([1]), np.array([10**9, 1, 1]), rng.integers(1, 5, 49_408), np.r_[10**6, np.ones(49_000, np.int64)]):
        freq = frequencies(counts)
        assert freq.sum() == 1 << PRECISION and freq.min() >= 1


def test_size_is_near_the_entropy():
    rng = np.random.default_rng(2)
    ids = rng.choice(1000, 1_000_000, p=np.r_[0.5, np.full(999, 0.5 / 999)]).astype(np.uint32)
    bits = 0.5 + 0.5 * np.log2(999 / 0.5)
    assert 8 * len(write_segment([ids])) < (bits * len(ids)) * 1.08


def test_damage_is_found():
    raw = bytearray(write_segment(documents(np.random.default_rng(3), [5000])))
    for at in (2, 40, len(raw) - 9):
        bad = bytearray(raw)
        bad[at] ^= 4
        with pytest.raises(CorruptFile):
            Segment(bytes(bad)).ids()
    with pytest.raises(CorruptFile):
        Segment(b"")


def expected(rows):
    plain = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    out, start = [], 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for (doc_id, text), e in zip(order, plain.encode_batch([t or "" for _, t in order], add_special_tokens=False)):
        ids = np.array(e.ids + [1], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_equals_tokenizer(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in op8_token_files(spark, folder).collect())
    assert got == expected(rows)


def test_edges(spark, monkeypatch):
    rows = [(5, None), (3, ""), (None, "null id"), (7, "x " * 300_000), (9, "Ünï <|endoftext|>\n"), (3, ""), (-4, "minus")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS Row", "2 AS file")
    for frame, data in ((docs, rows), (docs.limit(0), [])):
        folder = scratch_path(spark, "tokens-test")
        write_tokens(frame, vocabulary("word_bpe_49k.json"), folder)
        got = sorted((tuple(r) for r in read_tokens(spark, folder).collect()), key=lambda r: r[1])
        assert got == expected(data)
    assert tokenfile.SEGMENT > tokenfile.BLOCK


def test_pieces_are_looked_up_once_for_several_batches():
    class Counted(encoding._Numbers):
        asked = 0

        def __getitem__(self, piece):
            self.asked += 1
            return super().__getitem__(piece)

    plain = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    texts = ["Tea, tea\n tea", None, "", " \n", "é tea é\u00a0x Åå", "a\tb <|endoftext|> tea", "1.2 $$x\u0085y tea,\n"] * 40
    batches = [pa.record_batch([pa.array(range(7)), pa.array(texts[:7])], names=["doc_id", "text"])] * 40
    ((ids, together),) = tokenfile._together(batches)
    assert (ids, together) == (list(range(7)) * 40, texts) and not list(tokenfile._together([]))
    encoder = encoding.Encoder(vocabulary("word_bpe_49k.json"), False)
    encoder.numbers = Counted()
    got = [x.tolist() for x in encoder.encode(texts)]
    assert got == [e.ids for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert encoder.numbers.asked == len(encoder.numbers) < 20
