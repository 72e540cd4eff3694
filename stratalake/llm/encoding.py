"""Token ids of whole texts, with a memory of words.

The tokenizers of this package never look across a space that stands between a character and another that is
not white space, so a text is cut there, each distinct piece is encoded once by the tokenizer and the ids of the
text are put together from the pieces. ``at_spaces`` makes cuts that change nothing for byte-level
tokenizers, whose pieces take the space before them, and ``drop_space`` those for tokenizers that
drop white space. Added tokens, such as ``<|endoftext|>``, become their own id as in the file, which ends a piece on both sides;
a text that holds one is encoded whole.

The byte-level tokenizers never look across the place between a letter and a mark either, nor past a single line end between characters
that are not white space. ``at_spaces`` cuts there as well, where the tokenizer shows on probes that it is so, so that a
word is remembered and encoded once, not once with each mark behind it.

Most pieces are words of letters with marks or line ends behind them. The byte-level tokenizers of this package make one token run of each
part of such a piece, so its words go to the tokenizer's model at once, without its normalizer and its patterns. Whether a
tokenizer does so is tried on ``_PROBES`` when it is loaded; all other pieces go through the whole tokenizer.

A worker keeps its encoder for the tasks of one stage and drops it before tasks of any other kind.
"""

from __future__ import annotations

import os
import re
from functools import partial
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stratalake.llm.common import kept

#: Pieces a Python worker remembers (some 150 MB); others are encoded once for each group of texts.
REMEMBERED = 600_000
#: Characters of text put together at once.
GROUP_CHARS = 1 << 22

_UNSAFE = re.compile(r" (?=\s|\Z)")
_CUT = re.compile(r" (?=\S)")
_WORDS = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)[.,;:!?]*(?:\n[A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?]*)*")
_PARTS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+|[.,;:!?]+|\n")
#: Pieces on which a tokenizer shows whether its words can go to its model at once.
_PROBES = ["word", "Words,", "ÉTÉ", "Straße...\nöÿÞx?!", "iNTERNATIONALisation", "s", "ll", "D:\nd\nre"]


def _byte_letters() -> dict[int, int]:
    """The letters that byte-level tokenizers write bytes with; a line end stays, since words have none."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + k for k, b in enumerate(hidden) if b != 10}


_BYTE_LETTERS = _byte_letters()
_HIDDEN = re.compile("[\x80-\xa0\xad]")


def split_at_spaces(text: str) -> list[str]:
    """Pieces that concatenate to the text; all but the first begin with a space and no other white space."""
    parts = text.split(" ") if not _UNSAFE.search(text) else _CUT.split(text)
    return parts[:1] + [" " + p for p in parts[1:]]


def _white_codes() -> np.ndarray:
    """White space beyond ASCII, the first three bytes of each (the third is 0 after two) as one number."""
    wide = [chr(c).encode() for c in range(128, 0x3001) if chr(c).isspace()]
    return np.array([int.from_bytes(b.ljust(3, b"\0"), "big") for b in wide])


_WIDE_WHITE = _white_codes()
_BYTES = np.arange(256)
_IS_WHITE = np.array([chr(b).isspace() for b in range(128)] + [False] * 128)
_LEADS_WHITE = np.isin(_BYTES, _WIDE_WHITE >> 16)
_IS_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
_IS_SHOWN = (_BYTES > 32) & (_BYTES < 127)
_IS_MARK = _IS_SHOWN & ~_IS_LETTER & ~np.isin(_BYTES, list(b"0123456789"))
_MARKS = bytes(_BYTES[_IS_MARK].tolist()).decode()


def _space_cuts(data: np.ndarray) -> np.ndarray:
    """Places of spaces before a character that is not white space; three bytes more follow the texts."""
    at = np.flatnonzero(data[:-3] == 32)
    after = data[at + 1]
    at, after = at[~_IS_WHITE[after]], after[~_IS_WHITE[after]]
    wide = np.flatnonzero(_LEADS_WHITE[after])
    if len(wide):
        b = data[at[wide, None] + [1, 2, 3]].astype(np.int64)
        code = (b[:, 0] << 16) + (b[:, 1] << 8) + np.where(b[:, 0] < 0xE0, 0, b[:, 2])
        at = np.delete(at, wide[np.isin(code, _WIDE_WHITE)])
    return at


def _mark_cuts(data: np.ndarray) -> np.ndarray:
    """Places of ASCII marks after a letter, and both sides of a single line end between characters that are not white space."""
    letter = _IS_LETTER[data]
    # The second byte of a letter from U+00C0 to U+00FF.
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = letter[:-1] & _IS_MARK[data[1:]]
    ends = np.flatnonzero(data[1:-1] == 10) + 1
    ends = ends[_IS_SHOWN[data[ends - 1]] | letter[ends - 1]]
    cut[ends] = True
    after = data[ends + 1]
    cut[ends[_IS_SHOWN[after] | (after == 0xC3)] + 1] = True
    return np.flatnonzero(cut)


def at_spaces(texts: list[str], at_marks: bool = False) -> tuple[np.ndarray, pa.Array]:
    """The cuts of ``split_at_spaces`` in several texts: the number of pieces of each, and all pieces, none of them empty.

    With ``at_marks`` words of letters are also cut from the marks and the line end behind them. The pieces are views of
    the texts.
    """
    joined = pa.array(texts, pa.large_string())
    _, places, raw = joined.buffers()
    offsets = np.frombuffer(places, np.int64, len(texts) + 1) if len(texts) else np.zeros(1, np.int64)
    data = np.zeros(offsets[-1] + 3, dtype=np.uint8)
    if offsets[-1]:
        data[:-3] = np.frombuffer(raw, np.uint8, offsets[-1])
    edge = np.zeros(len(data), dtype=bool)
    edge[_space_cuts(data)] = True
    edge[offsets[1:] - 1] = False  # a space that ends a text
    if at_marks:
        edge[_mark_cuts(data)] = True
    edge[offsets] = True
    bounds = np.flatnonzero(edge[: offsets[-1] + 1])
    pieces = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data))
    return np.diff(np.searchsorted(bounds, offsets)), pieces


def drop_space(texts: list[str]) -> tuple[np.ndarray, pa.Array]:
    """Pieces of several texts between spaces and line ends: the number of each, and all pieces."""
    parts = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
    full = pc.binary_length(parts.values).to_numpy() > 0
    before = np.concatenate(([0], np.cumsum(full)))
    return np.diff(before[parts.offsets.to_numpy()]), parts.values.filter(pa.array(full))


class _Numbers(dict):
    """Numbers of pieces; a new piece gets the next one and is noted as fresh."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.fresh.append(piece)
        return number


class Encoder:
    """Encodes texts with one tokenizer file."""

    def __init__(self, path: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.cut = at_spaces if keeps_space else drop_space
        self.numbers = _Numbers()
        self.ids = np.empty(1 << 16, dtype=np.uint32)
        self.starts = np.zeros(1 << 16, dtype=np.int64)
        self.model = self.tokenizer.model
        normalizer = self.tokenizer.normalizer
        self.lowers = normalizer is not None and normalizer.normalize_str("ÉTÉ") == "été"
        probes = _PROBES + [" " + p for p in _PROBES] * keeps_space
        self.cuts_words = self._by_parts(probes) == self._by_tokenizer(probes)
        if keeps_space and self._cuts_at_marks():
            self.cut = partial(at_spaces, at_marks=True)

    def _cuts_at_marks(self) -> bool:
        """Whether the tokenizer never looks across the cuts at marks and line ends."""
        probes = [f"{p}{m}{q}" for m in _MARKS for p, q in (("a", ""), (" É", "b"), ("it", "s 1"), ("we", f"{m}ll.\nA"))]
        probes += _PROBES + ["1\n2", "a\n\nb", "a.\n É", "x,\n\n", "ÿ\nß"]
        counts, pieces = at_spaces(probes, at_marks=True)
        encoded = iter(self._by_tokenizer(pieces.to_pylist()))
        return [list(chain.from_iterable(islice(encoded, n))) for n in counts] == self._by_tokenizer(probes)

    def _by_tokenizer(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _by_model(self, words: list[str]) -> list[list[int]]:
        """The ids of words of letters."""
        joined = "\n".join(words)
        written = (joined.lower() if self.lowers else joined).encode().decode("latin-1")
        written = _HIDDEN.sub(lambda m: chr(_BYTE_LETTERS[ord(m[0])]), written).replace(" ", chr(_BYTE_LETTERS[32]))
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(word)] for word in written.split("\n")] if words else []

    def _by_parts(self, pieces: list[str]) -> list[list[int]]:
        """The ids of pieces, those of words with marks and line ends put together from their parts."""
        words, others, cut = {}, {}, {}
        for piece in pieces:
            if piece.isascii() and piece.isalpha():
                words[piece] = None
                continue
            match = _WORDS.fullmatch(piece)
            if match is None:
                others[piece] = None
            elif match.end(1) == len(piece):
                words[piece] = None
            else:
                cut[piece] = parts = _PARTS.findall(piece)
                for part in parts:
                    (others if part[0] in ".,;:!?\n" else words)[part] = None
        ids = dict(zip(words, self._by_model(list(words))))
        ids |= zip(others, self._by_tokenizer(list(others)))
        return [[i for part in cut[p] for i in ids[part]] if p in cut else ids[p] for p in pieces]

    def _add_fresh(self) -> None:
        """Encode the pieces that were met for the first time."""
        encoded = (self._by_parts if self.cuts_words else self._by_tokenizer)(self.numbers.fresh)
        lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        last = len(self.numbers)
        first = last - len(encoded)
        while last >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.starts[first + 1 : last + 1] = self.starts[first] + np.cumsum(lengths)
        while self.starts[last] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.starts[first] : self.starts[last]] = np.fromiter(
            chain.from_iterable(encoded), dtype=np.uint32, count=int(lengths.sum()))
        self.numbers.fresh = []

    def _forget(self) -> None:
        """Keep the first pieces met, most of which are the frequent ones."""
        while len(self.numbers) > REMEMBERED:
            self.numbers.popitem()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; none for a null or empty text."""
        out: list[np.ndarray] = []
        low = 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size < GROUP_CHARS):
                size += len(texts[high] or "")
                high += 1
            out += self._group(texts[low:high])
            low = high
        return out

    def _group(self, texts: list[str | None]) -> list[np.ndarray]:
        alone = {k for k, t in enumerate(texts) if t and self.added and self.added.search(t)}
        counts, cut = self.cut(["" if t is None or k in alone else t for k, t in enumerate(texts)])
        # Each distinct piece of the group is looked up once.
        distinct = cut.dictionary_encode()
        pieces = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.numbers.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        which = distinct.indices.to_numpy()
        if self.numbers.fresh:
            self._add_fresh()
        first = self.starts[numbers]
        starts, lengths = first[which], (self.starts[numbers + 1] - first)[which]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        whole = self.ids[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], lengths)]
        edges = ends[np.concatenate(([0], np.cumsum(counts)))]
        self._forget()
        return [self._whole(texts[k]) if k in alone else whole[edges[k] : edges[k + 1]] for k in range(len(texts))]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def encoder(path: str, keeps_space: bool) -> Encoder:
    """The encoder of this Python worker for a file, with what it remembers."""
    return kept((path, keeps_space), lambda: Encoder(path, keeps_space))
