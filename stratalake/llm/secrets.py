"""Secret scans: fixed patterns, and a character convolutional network over all other candidates.

Base findings are the matches of three patterns (see ``base_spans``); they always stay. A candidate
is a run of at least ``LEAST_RUN`` characters of ``[A-Za-z0-9+/_=-]`` with a letter and a digit that
no base finding touches. Of a run that base findings touch, the parts they leave are candidates if they
have a letter and a digit and at least ``LEAST_PART`` characters; if one is a secret, the whole run is a finding of the
network, beside the base ones, so that nothing of a longer key stays. Every candidate is cut into overlapping windows with the characters around
it; a convolution over character classes, a maximum over positions and a linear layer score each
window, and the best window counts, so long candidates are read as a whole.

The network is trained in numpy by the tasks of Spark on the labelled findings of all
documents: base findings are secrets; other runs, and word chains,
dates and versions made of words of the texts, are not. The windows are dealt into shards of about ``SHARD_ROWS`` rows; in each
of ``EPOCHS`` passes every shard trains from the same network, and the next network is their average. Other runs that look like keys (``key_like``)
have no label, since they may be secrets of another shape. Findings are also shown with the
surroundings of a plain word, as they are and redrawn from other letters, so that bare keys and other
alphabets are known as well. The labels of a fifth of the keys and plain runs are kept apart, with all
windows and variants of a key; the scores are calibrated on them, and the threshold is the highest that
still finds ``RECALL`` of the bare redrawn keys among them, the ones most like what no pattern finds.

Defined results: a null text is empty and has no findings; without labels of both kinds only base
findings are made; repeated rows are scanned row by row.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import Scratch, add_columns, free_name, map_batches, share, table

SHARD_ROWS = 50_000
EPOCHS = 12
#: Parts of a unit that margins are counted in.
STEPS = 1024
LEAST_RUN = 16
LEAST_PART = 8
RECALL = 0.98
KINDS = ("assign", "access", "hex", "model")

#: The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

# A run that can hold an access or hex finding, or be a candidate.
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_RUN)
_SHORT_RUN = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
_SWITCH = re.compile(r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])")
_MIXED = re.compile(r"(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])")
_KEY_CHARS = np.array(list("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_"))
_KEYWORDS = ("passw", "secret", "token", "api")

WINDOW, AROUND, STRIDE, WIDTH, FILTERS = 48, 24, 24, 5, 16
_SPAN = WINDOW + 2 * AROUND

Span = tuple[int, int, int]


def _class_table() -> np.ndarray:
    """Class of each ASCII character: letters by name and case, digits, marks by use."""
    out = np.full(129, 1, dtype=np.int16)  # 0: outside the text, 1: any other, last: beyond ASCII
    for k in range(26):
        out[97 + k] = 2 + k
        out[65 + k] = 28 + k
    out[48:58] = 54
    for k, marks in enumerate((" ", "\n\t\r", "=", ":", "\"'`", "_", "-", "/", "+", ".,;!?", "@", "()[]{}<>", "#*$%&|\\")):
        for mark in marks:
            out[ord(mark)] = 55 + k
    out[128] = 68
    return out


_CLASS = _class_table()
_CLASSES = 69
_INPUTS = 2 * _CLASSES  # each class outside and inside the candidate


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Base findings as (start, end, kind), and the long runs met on the way."""
    found: list[Span] = []
    lower = text.lower()
    if any(word in lower for word in _KEYWORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    runs = []
    for run in _RUN.finditer(text):
        start, end = run.span()
        runs.append((start, end))
        for kind, pattern, least in ((1, ACCESS, LEAST_ACCESS), (2, HEX, LEAST_HEX)):
            found += [(m.start(), m.end(), kind) for m in pattern.finditer(text, start, end)
                      if m.end() - m.start() >= least]
    found.sort(key=lambda s: (s[0], s[2]))
    return found, runs


def candidates(text: str, base: list[Span], runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Long mixed runs that no base finding touches."""
    out, k, reach = [], 0, 0
    for start, end in runs:
        while k < len(base) and base[k][0] < end:
            reach = max(reach, base[k][1])
            k += 1
        if reach <= start and _MIXED.match(text, start, end):
            out.append((start, end))
    return out


def remains(text: str, base: list[Span], runs: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """The mixed parts that base findings leave of long runs they touch, each with its run."""
    out, k = [], 0
    open_spans: list[tuple[int, int]] = []
    for start, end in runs:
        while k < len(base) and base[k][0] < end:
            open_spans.append(base[k][:2])
            k += 1
        open_spans = [span for span in open_spans if span[1] > start]
        at = start
        for low, high in [*open_spans, (end, end)] if open_spans else []:
            if low - at >= LEAST_PART and _MIXED.match(text, at, low):
                out.append((at, low, start, end))
            at = max(at, high)
    return out


def windows(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """Pieces of a text around a run that together cover it: text, place of the run, its length there."""
    out = []
    low = start
    while True:
        high = min(end, low + WINDOW)
        first = max(0, low - AROUND)
        out.append((text[first : high + AROUND], low - first, high - low))
        if high == end:
            return out
        low += STRIDE


def encode(pieces: list[tuple[str, int, int]]) -> np.ndarray:
    """Input classes of the windows, the run always at the same place."""
    out = np.zeros((len(pieces), _SPAN), dtype=np.int16)
    for row, (piece, at, size) in zip(out, pieces):
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        put = AROUND - at
        row[put : put + len(codes)] = _CLASS[np.minimum(codes, 128)]
        row[AROUND : AROUND + size] += _CLASSES
    return out


@dataclass
class Network:
    """Convolution over classes, maximum over places, linear layer, calibration, threshold."""

    kernel: np.ndarray  # width, inputs, filters
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0

    def features(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = _SPAN - WIDTH + 1
        total = np.tile(self.bias, (len(x), places, 1)).astype(np.float32)
        for k in range(WIDTH):
            total += self.kernel[k][x[:, k : k + places]]
        top = total.argmax(axis=1)
        return np.maximum(np.take_along_axis(total, top[:, None, :], axis=1)[:, 0], 0), top

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.features(x[k : k + 256])[0] @ self.out + self.out_bias
                               for k in range(0, len(x), 256)] or [np.empty(0)])

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -30, 30)))


def _begin(seed: int = 7) -> tuple[Network, list]:
    """The network that training starts from, and its moments."""
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.1, (WIDTH, _INPUTS, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
                  rng.normal(0, 0.3, FILTERS).astype(np.float32), 0.0)
    return net, [[np.zeros_like(p), np.zeros_like(p)] for p in (net.kernel, net.bias, net.out, np.zeros(1))]


def _pass(net: Network, moments: list, step: int, x: np.ndarray, y: np.ndarray, weight: np.ndarray,
          rng: np.random.Generator) -> int:
    """One pass over labelled windows in small batches, which changes the network and its moments; the number of steps so far."""
    order = rng.permutation(len(x))
    for low in range(0, len(order), 128):
        take = order[low : low + 128]
        xs = x[take]
        hidden, top = net.features(xs)
        chance = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias, -30, 30)))
        slope = (chance - y[take]) * weight[take] / len(take)
        into = (slope[:, None] * net.out) * (hidden > 0)
        kernel = np.zeros_like(net.kernel)
        rows, columns = np.arange(len(take))[:, None], np.arange(FILTERS)[None, :]
        for k in range(WIDTH):
            np.add.at(kernel[k], (xs[rows, top + k], np.broadcast_to(columns, top.shape)), into)
        gradients = (kernel + 1e-4 * net.kernel, into.sum(0), hidden.T @ slope, np.array([slope.sum()]))
        step += 1
        for place, gradient in enumerate(gradients):
            first, second = moments[place]
            first += 0.1 * (gradient - first)
            second += 0.001 * (gradient**2 - second)
            change = 0.01 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            if place == 0:
                net.kernel -= change
            elif place == 1:
                net.bias -= change
            elif place == 2:
                net.out -= change
            else:
                net.out_bias -= float(change[0])
    return step


def _packed(net: Network, moments: list) -> np.ndarray:
    parts = [net.kernel, net.bias, net.out, np.array([net.out_bias]), *[m for pair in moments for m in pair]]
    return np.concatenate([part.ravel().astype(np.float64) for part in parts])


def _unpacked(state: np.ndarray) -> tuple[Network, list]:
    net, moments = _begin()
    shapes = [net.kernel, net.bias, net.out, np.zeros(1), *[m for pair in moments for m in pair]]
    ends = np.cumsum([part.size for part in shapes])
    found = [own.reshape(part.shape).astype(part.dtype) for own, part in zip(np.split(state, ends[:-1]), shapes)]
    return Network(*found[:3], float(found[3][0])), [found[k : k + 2] for k in range(4, len(found), 2)]


def _windows_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int16).reshape(len(column), _SPAN)


def train(shards: DataFrame, positive: int, negative: int, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """A network for all labelled windows (shard, x, y) in stored files that no shard crosses.

    In each pass every shard trains from the same network, and the next one is the average by rows. The same shards give the same network.
    """
    spark = shards.sparkSession
    state, step = _packed(*_begin(seed)), 0
    share_of = [0.5 / max(1, negative) * (positive + negative), 0.5 / max(1, positive) * (positive + negative)]
    for epoch in range(epochs):
        shared = spark.sparkContext.broadcast((state, step))

        def one_pass(batches, shared=shared, epoch=epoch):
            own: dict[int, list] = {}
            for batch in batches:
                shard = batch.column(0).to_numpy()
                x, y = _windows_of(batch.column(1)), batch.column(2).to_numpy()
                for number in np.unique(shard):
                    own.setdefault(int(number), []).append((x[shard == number], y[shard == number]))
            begun, before = shared.value
            total, n, after = np.zeros_like(begun), 0, before
            for number in sorted(own):
                net, moments = _unpacked(begun)
                x, y = (np.concatenate(c) for c in zip(*own.pop(number)))
                rng = np.random.default_rng([seed, epoch, number])
                after = max(after, _pass(net, moments, before, x, y, np.where(y > 0, *share_of[::-1]), rng))
                total += _packed(net, moments) * len(x)
                n += len(x)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([after]), pa.array([total.tobytes()], pa.binary())],
                                                 names=["n", "step", "state"])

        # One row a task, of fixed size.
        made = map_batches(shards.select("shard", "x", "y"), one_pass, "n long, step long, state binary").collect()
        shared.destroy()
        rows = sorted(made, key=lambda r: bytes(r["state"]))
        state = sum(np.frombuffer(bytes(r["state"])) for r in rows) / sum(r["n"] for r in rows)
        step = max(r["step"] for r in rows)
    return _unpacked(state)[0]


def calibrate(net: Network, margin: np.ndarray, y: np.ndarray, bare: np.ndarray) -> None:
    """Fit the chance to the labels kept apart, then set the threshold by the recall asked for.

    As in a scan the best window of a key counts.
    """
    names, key = np.unique(bare[bare != 0], return_inverse=True)
    best = np.full(len(names), -np.inf)
    np.maximum.at(best, key, margin[bare != 0])
    calibrate_counted(net, margin, y, np.ones(len(margin)), np.sort(best), np.ones(len(best), dtype=np.int64))


def calibrate_counted(net: Network, margin: np.ndarray, y: np.ndarray, times: np.ndarray, best: np.ndarray,
                      best_times: np.ndarray) -> None:
    """``calibrate`` for margins that occur so many times, and for the ascending best margins of the bare keys."""
    positive, negative = times[y > 0].sum(), times[y == 0].sum()
    share = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    weights = np.where(y > 0, 0.5 / max(1, positive), 0.5 / max(1, negative)) * times
    slope, shift = 1.0, 0.0
    for _ in range(500):
        error = (1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30))) - share) * weights
        slope -= 0.5 * float((error * margin).sum())
        shift -= 0.5 * float(error.sum())
    net.slope, net.shift = max(slope, 1e-3), shift
    if not len(best):  # too few keys: all that is more likely a secret than not
        net.threshold = 0.5
        return
    upto = np.cumsum(best_times)
    lowest = best[np.searchsorted(upto, int((1 - RECALL) * upto[-1]), side="right")]
    net.threshold = float(1 / (1 + np.exp(-np.clip(net.slope * lowest + net.shift, -30, 30))))


def calibrate_on(net: Network, held: DataFrame) -> None:
    """``calibrate`` on all windows kept apart; margins are counted in steps of 1 / ``STEPS``, so few rows reach the driver."""
    shared = share(held.sparkSession, net)

    def margins(batches):
        for batch in batches:
            margin = np.clip(shared.value.margin(_windows_of(batch.column(0))), -64, 64)
            steps = np.floor(margin * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(steps), batch.column(1), batch.column(2)], names=["step", "y", "bare"])

    scored = map_batches(held.select("x", "y", "bare"), margins, "step long, y int, bare long")
    keys = scored.where("bare != 0").groupBy("bare").agg(F.max("step").alias("step"))
    found = scored.groupBy("y", "step").count().collect()
    best = sorted((r["step"], r["count"]) for r in keys.groupBy("step").count().collect())
    step, y, times = (np.array([r[c] for r in sorted(found)], dtype=np.float64) for c in ("step", "y", "count"))
    calibrate_counted(net, step / STEPS, y, times, np.array([s for s, _ in best], dtype=np.float64) / STEPS,
                      np.array([n for _, n in best], dtype=np.int64))


def redrawn(key: str) -> list[str]:
    """Keys of the same length, one from each alphabet, the same for the same key."""
    rng = np.random.default_rng(zlib.crc32(key.encode()))
    return ["".join(rng.choice(_KEY_CHARS[:size], len(key))) for size in (16, 36, 62, 64)]


def key_like(run: str) -> bool:
    """Whether digits, small and capital letters take turns in a run more often than in words, dates and versions."""
    return len(run) >= LEAST_RUN and len(_SWITCH.findall(run)) > len(run) // 8


def kept_apart(key: str) -> bool:
    """Whether the labels of a key, or of a plain run, are not trained on."""
    return zlib.crc32(key.encode("utf-8", "replace")) % 5 == 0


def label_windows(batches):
    """Labelled windows of a partition of the sample: input classes, label, kept apart, number of the bare redrawn key."""
    letters = re.compile(r"[A-Za-z]{3,}")
    for batch in batches:
        pieces, labels = [], []

        def add(own, label, key, bare=0):
            pieces.extend(own)
            labels.extend([(label, kept_apart(key), bare)] * len(own))

        for text in batch.column(0).to_pylist():
            base, _ = base_spans(text)
            plain = [m.span() for m in _SHORT_RUN.finditer(text)
                     if not any(s < m.end() and m.start() < e for s, e, _ in base)][:4]
            for start, end, kind in base:
                if kind == 0:
                    start = next(m.start(2) for m in [ASSIGN.match(text, start)])
                add(windows(text, start, end), 1, text[start:end])
                # The same key where a plain word stood, as it is and in other letters.
                for at, to in plain[:1]:
                    for variant, key in enumerate([text[start:end], *redrawn(text[start:end])]):
                        moved = text[max(0, at - AROUND) : at] + key + text[to : to + AROUND]
                        add(windows(moved, min(at, AROUND), min(at, AROUND) + len(key)), 1, text[start:end],
                            zlib.crc32(moved.encode("utf-8", "replace")) + 1 if variant else 0)
            for start, end in plain:
                if not key_like(text[start:end]):
                    add(windows(text, start, end), 0, text[start:end])
            words = letters.findall(text[:2000])
            if len(words) > 4 and len(words[2]) < AROUND:
                year = 1990 + len(text) % 40
                chain = (f"{words[0]}-{words[1]}-{words[2]}-{year}", f"{year}-01-02T10-20-30", f"{words[3]}_{words[4]}_v{len(words) % 10}",
                         f"/{words[0]}/{year}/{words[1]}")[len(text) % 4]
                add([(f"{words[2]} {chain} {words[1]}"[: _SPAN - AROUND], len(words[2]) + 1,
                      min(WINDOW, len(chain), _SPAN - AROUND - len(words[2]) - 1))], 0, chain)
        x = encode(pieces)
        yield pa.RecordBatch.from_arrays(
            [pa.array([row.tobytes() for row in x], pa.binary()), pa.array([k[0] for k in labels], pa.int32()),
             pa.array([k[1] for k in labels], pa.bool_()), pa.array([k[2] for k in labels], pa.int64())],
            names=["x", "y", "held", "bare"])


def learn(docs: DataFrame, train_docs: int | None = None) -> Network | None:
    """The network for a corpus, from the labelled findings of all its documents, or of about so many."""
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    if train_docs is not None:
        scale = 1 << 40
        chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(scale)) < int(min(1, train_docs / max(1, rows.count())) * scale)
        rows = rows.where(chosen)
    scratch = Scratch(docs.sparkSession)
    labels = scratch.write(
        map_batches(rows.select("text"), label_windows, "x binary, y int, held boolean, bare long").distinct(), "labels")
    n = {(r["held"], r["y"]): r["count"] for r in labels.groupBy("held", "y").count().collect()}
    positive, negative = n.get((False, 1), 0), n.get((False, 0), 0)
    if not positive or not negative:
        scratch.drop("labels")
        return None
    # Dealt by a hash and sorted, so that the network does not depend on how the rows lie.
    count = -(-(positive + negative) // SHARD_ROWS)
    dealt = labels.where("NOT held").select(F.pmod(F.xxhash64("x", "y", "bare"), F.lit(count)).cast("int").alias("shard"), "x", "y", "bare")
    shards = scratch.write(dealt.repartition(count, "shard").sortWithinPartitions("shard", "x", "y", "bare").drop("bare"), "shards")
    net = train(shards, positive, negative)
    calibrate_on(net, labels.where("held"))
    scratch.drop("labels", "shards")
    return net


FINDING = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                              ("chance", pa.float64())]))


def scan(texts: list[str | None], net: Network | None) -> list[list[dict]]:
    """Findings of each text by start, then kind; only those of the network have a chance."""
    all_found, pieces, owners = [], [], []
    for k, text in enumerate(texts):
        base, runs = base_spans(text or "")
        all_found.append([(s, e, kind, None) for s, e, kind in base])
        if net is not None and runs:
            parts = [(*run, *run) for run in candidates(text, base, runs)]
            for low, high, start, end in parts + (remains(text, base, runs) if base else []):
                own = windows(text, low, high)
                pieces += own
                owners += [(k, start, end)] * len(own)
    if pieces:
        best: dict[tuple[int, int, int], float] = {}
        for low in range(0, len(pieces), 4096):
            chances = net.chance(encode(pieces[low : low + 4096]))
            for owner, chance in zip(owners[low : low + 4096], chances):
                best[owner] = max(best.get(owner, 0.0), float(chance))
        for (k, start, end), chance in best.items():
            if chance >= net.threshold:
                all_found[k].append((start, end, 3, chance))
    return [[{"kind": KINDS[kind], "start": s, "end": e, "chance": chance}
             for s, e, kind, chance in sorted(found, key=lambda f: (f[0], f[2]))] for found in all_found]


def find_secrets(df: DataFrame, net: Network | None, text: str = "text", keep: list[str] | None = None,
                 name: str = "findings") -> DataFrame:
    """The frame (or its columns ``keep``) with an array of findings."""
    shared = share(df.sparkSession, net)
    return add_columns(df, text, {name: FINDING}, lambda texts: [scan(texts, shared.value)], keep)


def redact(df: DataFrame, net: Network | None, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The frame with every finding in ``text`` replaced by a mark; touching findings become one."""
    shared = share(df.sparkSession, net)

    def clean(texts):
        out = []
        for value, found in zip(texts, scan(texts, shared.value)):
            if not found:
                out.append(value)
                continue
            parts, done = [], 0
            for f in found:
                if f["end"] > done:
                    if f["start"] >= done:
                        parts += [value[done : f["start"]], mark]
                    done = f["end"]
            out.append("".join(parts) + value[done:])
        return [out]

    new = free_name(df, "_clean")
    with_clean = add_columns(df, text, {new: pa.string()}, clean)
    return with_clean.select(*[F.col(f"`{new}`").alias(c) if c == text else F.col(f"`{c}`") for c in df.columns])


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the findings in every document."""
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs.select("doc_id", "text"), learn(docs), keep=["doc_id"])
    f = F.col("findings")

    def count(kind):
        return F.size(F.filter(f, lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.filter(f, lambda x: x["kind"] != "model")).cast("binary"), 256).alias("base_sha256"),
        _joined(f).alias("spans"))


QUERIES = {"op4_secret_scan": op4_secret_scan}
