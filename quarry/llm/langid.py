"""Language identification by a bidirectional gated recurrent network over bytes.

The network (gates and candidate by softsign, which numpy evaluates many times
faster than tanh) reads a text's UTF-8 bytes in windows, forwards and backwards, and
labels every position; a document's probabilities are the mean over all positions
of all its windows, so whole texts count. It is trained in numpy by
backpropagation through time on a bounded sample of windows of labelled texts
(``SAMPLE_WINDOWS`` in all, the same number of documents for each language, chosen
by a hash of doc_id); its size is fixed, so it is sent to the tasks as is.

For a corpus that may hold other languages ``fit_judge`` trains the network with one more
class, of made-up text in other scripts and of random letters. What the sample gives is only where
the network starts: ``refine`` then trains it on all windows of all texts to learn from, in the tasks that
read them, and averages what these found. All labelled documents that it did not learn from tell, whole, when a
text is rejected: if that class, or no language clearly, takes it. A language whose words look like a learned one's is not told apart.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and
so is every text where nothing is labelled; rows with a null lang or doc_id are not
learned from; a null doc_id is not held out; repeated rows give repeated results;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import hold_memory, map_texts, row_slices, text_bytes

WINDOW, HIDDEN = 64, 8
#: The bound of the training sample, and of the windows that one document gives to it.
SAMPLE_WINDOWS, WINDOWS_PER_DOC = 12_000, 6
STEPS, BATCH, RATE = 260, 160, 0.02
#: Windows of a step of ``refine``, its rate, and how many rows the tasks' networks are added up to before they are collected.
LOCAL_BATCH, LOCAL_RATE, SUMS = 1024, 0.001, 16
#: The share of the calibration documents that may lie beyond a limit, and the bins of a share in which they are counted.
BEYOND, BINS = 0.001, 10_000
UNDETERMINED = "und"
#: The class of made-up text (no language has an empty name).
OTHER = ""
_LETTER = regex.compile(r"\p{L}")


# ------------------------------------------------------------------ the network


@dataclass
class Network:
    """Byte tables and recurrent weights of the two directions, and the output layer."""

    langs: list[str]
    tables: list[np.ndarray]  # two of 256 x 3H: update, reset, candidate
    loops: list[np.ndarray]  # two of H x 3H
    out: np.ndarray  # 2H x languages
    bias: np.ndarray

    @classmethod
    def fresh(cls, langs: list[str], hidden: int, seed: int) -> Network:
        g = np.random.default_rng(seed)
        s = 1 / np.sqrt(hidden)
        return cls(langs, [g.normal(0, 0.3, (256, 3 * hidden)) for _ in range(2)],
                   [g.uniform(-s, s, (hidden, 3 * hidden)) for _ in range(2)],
                   g.uniform(-s, s, (2 * hidden, len(langs))), np.zeros(len(langs)))

    def weights(self) -> list[np.ndarray]:
        return [*self.tables, *self.loops, self.out, self.bias]


def _softsign(x):
    """In place."""
    x /= 1 + np.abs(x)
    return x


def _read(table, loop, steps):
    """One direction over ``steps`` (time x batch bytes): all states, and what backpropagation needs.

    A step's numbers lie unit by unit, a whole batch in a row: numpy goes over rows of a few units many times slower."""
    hidden = len(loop)
    table, loop = np.ascontiguousarray(table.T), np.ascontiguousarray(loop.T)
    states, kept = np.zeros((len(steps) + 1, hidden, steps.shape[1]), loop.dtype), []
    for h, new, byte in zip(states, states[1:], steps):
        g, a = np.take(table, byte, axis=1), loop @ h
        zr = _softsign(g[: 2 * hidden] + a[: 2 * hidden])
        zr *= 0.5
        zr += 0.5
        z, r, q = zr[:hidden], zr[hidden:], a[2 * hidden :]
        n = _softsign(g[2 * hidden :] + r * q)
        kept.append((h, z, r, q, n))
        np.subtract(h, n, out=new)
        new *= z
        new += n
    return states[1:].transpose(0, 2, 1), kept


def _gate_slope(gate):
    """Slope of 0.5 + 0.5 softsign, from its value."""
    return 0.5 * (1 - np.abs(2 * gate - 1)) ** 2


def _unroll(loop, kept, steps, d_states):
    """Gradients of the byte table and the loop weights, back through time."""
    hidden = len(loop)
    d_in = np.empty((len(steps), 3 * hidden, steps.shape[1]), loop.dtype)
    back = np.empty(d_in.shape[1:], loop.dtype)
    d_loop, dh = np.zeros_like(loop), 0.0
    for t in range(len(steps) - 1, -1, -1):
        h, z, r, q, n = kept[t]
        dh = dh + d_states[t].T
        da = dh * (1 - z)
        da *= (1 - np.abs(n)) ** 2
        np.multiply(dh * (h - n), _gate_slope(z), out=back[:hidden])
        np.multiply(da * q, _gate_slope(r), out=back[hidden : 2 * hidden])
        np.multiply(da, r, out=back[2 * hidden :])
        d_in[t, : 2 * hidden], d_in[t, 2 * hidden :] = back[: 2 * hidden], da
        d_loop += h @ back.T
        dh *= z
        dh += loop @ back
    bytes_ = steps.reshape(-1).astype(np.intp)
    return np.stack([np.bincount(bytes_, d_in[:, k].reshape(-1), 256) for k in range(3 * hidden)], axis=1), d_loop


def _gradients(net: Network, x: np.ndarray, lengths: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> list[np.ndarray]:
    """Gradients of all weights for windows ``x`` (time x batch bytes) of the classes ``y``, a window counting ``weight`` times."""
    real = np.arange(len(x))[:, None] < lengths
    fwd, kept_f = _read(net.tables[0], net.loops[0], x)
    bwd, kept_b = _read(net.tables[1], net.loops[1], x[::-1])
    by_unit = lambda a: a.transpose(0, 2, 1)
    both = np.concatenate([by_unit(fwd), by_unit(bwd[::-1])], axis=1)
    d = net.out.T @ both
    d += net.bias[:, None]
    d -= d.max(axis=1, keepdims=True)
    np.exp(d, out=d)
    d /= d.sum(axis=1, keepdims=True)
    d[:, y, np.arange(len(y))] -= 1
    d *= (real * ((1 if weight is None else weight) / max(1, real.sum()))).astype(d.dtype)[:, None]
    d_both = net.out @ d
    h = net.loops[0].shape[0]
    t0, l0 = _unroll(net.loops[0], kept_f, x, by_unit(d_both[:, :h]))
    t1, l1 = _unroll(net.loops[1], kept_b, x[::-1], by_unit(d_both[::-1, h:]))
    return [t0, t1, l0, l1, (both @ by_unit(d)).sum(axis=0), d.sum(axis=(0, 2))]


def _adam(net: Network, moments: list, grads: list[np.ndarray], rate: float, step: int) -> None:
    for w, (m, v), dw in zip(net.weights(), moments, grads):
        m += 0.1 * (dw - m)
        v += 0.01 * (dw * dw - v)
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


def train(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, langs: list[str], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 9) -> Network:
    """Fit on ``windows`` (rows of bytes, of which ``lengths`` count) with Adam."""
    net, g = Network.fresh(langs, hidden, seed), np.random.default_rng(seed + 1)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    order = np.zeros(0, int)
    for step in range(1, steps + 1):
        while len(order) < BATCH:
            order = np.append(order, g.permutation(len(windows)))
        pick, order = order[:BATCH], order[BATCH:]
        grads = _gradients(net, windows[pick].T, lengths[pick], labels[pick])
        rate = RATE * (1 - step / (steps + 1))
        _adam(net, moments, grads, rate, step)
    return net


def _windows(offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the rows that ``offs`` cuts: their rows, first bytes and lengths."""
    size = np.diff(offs)
    count = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = offs[row] + nth * WINDOW
    return row, begin, np.minimum(WINDOW, offs[row + 1] - begin)


class Reader:
    """The trained network in single precision, for many windows at once."""

    def __init__(self, net: Network):
        h = net.loops[0].shape[0]
        self.hidden, self.langs = h, net.langs
        part = lambda w: [np.ascontiguousarray(w[:, k * h : (k + 1) * h], np.float32) for k in range(3)]
        self.tables, self.loops = [part(t) for t in net.tables], [part(u) for u in net.loops]
        self.out = [np.ascontiguousarray(net.out[k * h : (k + 1) * h].T, np.float32) for k in range(2)]
        self.bias = net.bias.astype(np.float32)[:, None]

    def _states(self, way: int, steps: np.ndarray):
        (tz, tr, tn), (uz, ur, un) = self.tables[way], self.loops[way]
        half, one = np.float32(0.5), np.float32(1)
        h = np.zeros((steps.shape[1], self.hidden), np.float32)
        z, r, n, a = (np.empty_like(h) for _ in range(4))

        def softsign(x):
            np.abs(x, out=a)
            np.add(a, one, out=a)
            np.divide(x, a, out=x)

        for byte in steps:
            np.take(tz, byte, axis=0, out=z, mode="clip")
            z += np.matmul(h, uz, out=a)
            softsign(z)
            z *= half
            z += half
            np.take(tr, byte, axis=0, out=r, mode="clip")
            r += np.matmul(h, ur, out=a)
            softsign(r)
            r *= half
            r += half
            r *= np.matmul(h, un, out=a)
            np.take(tn, byte, axis=0, out=n, mode="clip")
            n += r
            softsign(n)
            h -= n
            h *= z
            h += n
            yield h

    def sums(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each window the sum of its positions' probabilities (windows x languages)."""
        steps = np.ascontiguousarray(windows.T).astype(np.intp)
        n = len(windows)
        logits = np.empty((len(steps), len(self.langs), n), np.float32)
        for t, s in enumerate(self._states(0, steps)):
            np.matmul(self.out[0], s.T, out=logits[t])
        total = np.zeros((len(self.langs), n), np.float32)
        for t, s in zip(range(len(steps) - 1, -1, -1), self._states(1, steps[::-1])):
            p = logits[t]
            p += self.out[1] @ s.T
            p += self.bias
            p -= p.max(axis=0)
            np.exp(p, out=p)
            total += p * ((t < lengths) / p.sum(axis=0))
        return total.T

    def documents(self, data: np.ndarray, offs: np.ndarray, most: int = 2048) -> np.ndarray:
        """Mean probabilities of each row's positions (zeros for an empty row)."""
        size = np.diff(offs)
        total = np.zeros((len(size), len(self.langs)))
        row, begin, length = _windows(offs)
        for a in range(0, len(row), most):
            b = min(a + most, len(row))
            at = begin[a:b, None] + np.arange(WINDOW)
            real = np.arange(WINDOW) < length[a:b, None]
            windows = np.where(real, data[np.where(real, at, 0)], 0)
            np.add.at(total, row[a:b], self.sums(windows, length[a:b]))
        return total / np.maximum(size, 1)[:, None]


# ------------------------------------------------------------------ on tables


def _sample_windows(batches):
    """Windows at evenly spread places of each text: lang, place, bytes."""
    for batch in batches:
        data, offs = text_bytes(batch.column(2))
        lang, order, got = [], [], []
        for i, (l, d) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            a, b = int(offs[i]), int(offs[i + 1])
            n = min(WINDOWS_PER_DOC, -(-(b - a) // WINDOW))
            for k in range(n):
                at = a + (b - a - WINDOW) * k // max(1, n - 1) if b - a > WINDOW else a
                lang.append(l)
                order.append(d * WINDOWS_PER_DOC + k)
                got.append(data[at : min(at + WINDOW, b)].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(order, pa.int64()), pa.array(got, pa.binary())], names=["lang", "place", "bytes"])


def _learnable(docs: DataFrame) -> DataFrame:
    d = docs.filter("lang is not null and text is not null and doc_id is not null").select("lang", "doc_id", "text")
    return d.filter(F.col("text").rlike(r"\p{L}"))


def _sampled(d: DataFrame, windows: int) -> list:
    """Rows (lang, place, bytes) of about ``windows`` windows, of equally many documents of each language."""
    counts = {r[0]: r[1] for r in d.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return []
    per = max(1, windows // (WINDOWS_PER_DOC * len(counts)))
    # rows whose hash is in the lowest part that holds twice as many as wanted; then the exact number of these
    order = F.xxhash64(F.lit(9), "doc_id")
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, (2 * per + 20) / n))])
    d = d.withColumn("order", order).filter(F.shiftrightunsigned("order", 11) / float(1 << 53) <= F.element_at(share, F.col("lang")))
    first = Window.partitionBy("lang").orderBy("order", "doc_id", "text")
    d = d.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per)
    got = map_texts(d.select("lang", "n", "text"), _sample_windows, "lang string, place long, bytes binary").collect()
    return sorted(got, key=lambda r: (r.lang, r.place))


def _as_array(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    windows = np.zeros((len(texts), WINDOW), np.uint8)
    for i, t in enumerate(texts):
        windows[i, : len(t)] = np.frombuffer(t, np.uint8)
    return windows, np.array([len(t) for t in texts], np.int64)


def fit(docs: DataFrame, learn: F.Column) -> Network | None:
    """Train on a sample of the rows of ``docs`` for which ``learn`` holds."""
    got = _sampled(_learnable(docs.filter(learn)), SAMPLE_WINDOWS)
    if not got:
        return None
    langs = sorted({r.lang for r in got})
    return train(*_as_array([r.bytes for r in got]), np.array([langs.index(r.lang) for r in got]), langs)


# ------------------------------------------------------------------ rejecting

#: First and last letters of scripts (Greek, Cyrillic, Hebrew, Arabic, Devanagari, Thai, kana, ideographs, Hangul).
_SCRIPTS = [(0x3B1, 0x3C9), (0x430, 0x44F), (0x5D0, 0x5EA), (0x627, 0x64A), (0x905, 0x939), (0xE01, 0xE2E), (0x3041, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]


def made_up(n: int, seed: int = 19) -> list[bytes]:
    """``n`` windows of words in other scripts or of letters a to z in no language's order."""
    g, out = np.random.default_rng(seed), []
    while len(out) < n:
        a, b = _SCRIPTS[g.integers(len(_SCRIPTS))] if g.random() < 0.6 else (0x61, 0x7A)
        words = ["".join(map(chr, g.integers(a, b + 1, g.integers(2, 11)))) for _ in range(20)]
        out.append(" ".join(words).encode()[g.integers(0, 8) :][:WINDOW])
    return out


@dataclass
class Judge:
    """A network with the class of made-up text, and the limits beyond which a text is rejected."""

    net: Network
    least: float
    most_other: float

    def rejects(self) -> F.Column:
        return (F.col("lang_pred") == UNDETERMINED) | (F.col("other") > self.most_other) | (F.col("score") < self.least)


def fit_judge(docs: DataFrame, learn: F.Column) -> Judge | None:
    """Train on all rows of ``docs`` for which ``learn`` holds, calibrate on all others; None if nothing is labelled."""
    got = _sampled(_learnable(docs.filter(learn)), SAMPLE_WINDOWS)
    if not got:
        return None
    langs = sorted({r.lang for r in got})
    other = made_up(max(60, len(got) // len(langs)))
    labels = [langs.index(r.lang) for r in got] + [len(langs)] * len(other)
    net = train(*_as_array([r.bytes for r in got] + other), np.array(labels), [*langs, OTHER])
    net, _ = refine(net, _learnable(docs.filter(learn)), other)
    others = _learnable(docs.filter(~learn))
    right = predict(others, net, [F.col("lang")]).filter("lang_pred = lang")
    bins = F.inline(F.array(*[F.struct(F.lit(c).alias("what"), F.floor(F.col(c) * BINS).cast("int").alias("bin")) for c in ("score", "other")]))
    counted: dict[str, dict[int, int]] = {"score": {}, "other": {}}
    for r in right.select(bins).groupBy("what", "bin").agg(F.count(F.lit(1)).alias("n")).collect():  # one row per bin
        counted[r.what][r.bin] = r.n
    if not counted["score"]:
        return Judge(net, 0.0, 0.5)
    # clear cases only, however the calibration falls: nearly equal shares, or made-up text in the majority
    return Judge(net, min(0.3, _bin_at(counted["score"], BEYOND) / BINS), max(0.5, (_bin_at(counted["other"], 1 - BEYOND) + 1) / BINS))


def _bin_at(counts: dict[int, int], part: float) -> int:
    """The bin in which ``part`` of all that ``counts`` holds is reached."""
    up_to, total = 0, sum(counts.values())
    for b in sorted(counts):
        up_to += counts[b]
        if up_to >= part * total:
            return b
    return max(counts)


def refine(net: Network, d: DataFrame, other: list[bytes]) -> tuple[Network, int]:
    """``net`` trained on all windows of the texts of ``d`` (lang, text), each once, beside ``other`` of made-up text; and how many windows there were.

    Each task goes over the windows of its rows from ``net`` on; the mean of what the tasks found, by their windows, is
    the result. A language counts alike whatever its share. The same splits give the same network."""
    size = F.ceil(F.octet_length("text") / F.lit(WINDOW)).cast("long")
    counts = {r.lang: r.n for r in d.groupBy("lang").agg(F.sum(size).alias("n")).collect()}  # one row per language
    langs, total = net.langs[:-1], sum(counts.values())
    number = {lang: i for i, lang in enumerate(langs)}
    weight = np.array([total / (len(langs) * max(1, counts.get(lang, 0))) for lang in langs] + [1.0], np.float32)
    weight = np.minimum(weight, 100)  # one window of a rare language does not outweigh its batch
    begun, shapes = [w.astype(np.float32) for w in net.weights()], [w.shape for w in net.weights()]
    extra, extra_len = _as_array(other)

    def run(batches):
        hold_memory()
        part = TaskContext.get().partitionId()
        w = [x.copy() for x in begun]
        mine = Network(net.langs, w[:2], w[2:4], w[4], w[5])
        moments, g, step, seen = [(np.zeros_like(x), np.zeros_like(x)) for x in w], np.random.default_rng(part), 0, 0
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            lang = np.array([number.get(x, -1) for x in batch.column(0).to_pylist()], np.int64)
            for a, b in row_slices(offs):
                row, begin, length = _windows(offs[a : b + 1])
                order = g.permutation(np.flatnonzero(lang[a:b][row] >= 0))
                seen += len(order)
                for pick in (order[k : k + LOCAL_BATCH] for k in range(0, len(order), LOCAL_BATCH)):
                    at, real = begin[pick, None] + np.arange(WINDOW), np.arange(WINDOW) < length[pick, None]
                    more = g.integers(0, len(extra), max(1, len(pick) // len(langs)))
                    x = np.concatenate([np.where(real, data[np.where(real, at, 0)], 0), extra[more]])
                    y = np.append(lang[a:b][row[pick]], np.full(len(more), len(langs)))
                    step += 1
                    _adam(mine, moments, _gradients(mine, x.T, np.append(length[pick], extra_len[more]), y, weight[y]), LOCAL_RATE * len(pick) / LOCAL_BATCH, step)
        if seen:
            yield _sum_row(part % SUMS, part, seen, np.concatenate([x.reshape(-1) for x in w]).astype(np.float64) * seen)

    def add(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for group, n, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                value = np.frombuffer(raw.as_buffer(), np.float64)
                sums[group] = [n + sums[group][0], value + sums[group][1]] if group in sums else [n, value]
        for group, (n, value) in sums.items():
            yield _sum_row(group, 0, n, value)

    schema = "part int, task int, windows long, weights binary"
    found = map_texts(d.select("lang", "text"), run, schema).repartition(SUMS, "part").sortWithinPartitions("part", "task")
    rows = sorted(map_texts(found, add, schema).collect(), key=lambda r: r.part)  # SUMS networks at most
    windows = sum(r.windows for r in rows)
    if not windows:
        return net, 0
    flat = sum(np.frombuffer(r.weights, np.float64) for r in rows) / windows
    ends = np.cumsum([int(np.prod(x)) for x in shapes])
    w = [flat[e - int(np.prod(x)) : e].reshape(x) for e, x in zip(ends, shapes)]
    return Network(net.langs, w[:2], w[2:4], w[4], w[5]), windows


def _sum_row(part: int, task: int, windows: int, weights: np.ndarray):
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([task], pa.int32()), pa.array([windows], pa.int64()), pa.array([weights.tobytes()], pa.binary())],
                                      names=["part", "task", "windows", "weights"])


def predict(docs: DataFrame, net: Network | None, keep_columns: list[F.Column], kept_text: str | None = None) -> DataFrame:
    """``keep_columns`` with lang_pred and score, from the text alone; for a network with the
    class of made-up text also ``other``, its share (score is then the language's share of the rest).

    ``kept_text`` names the text if it is one of them, so that it is sent once."""
    rows = docs.select(*keep_columns) if kept_text else docs.select(*keep_columns, F.col("text").alias("_text"))
    names = rows.columns if kept_text else rows.columns[:-1]
    at = rows.columns.index(kept_text or "_text")
    if net is None:
        return rows.select(*names).withColumn("lang_pred", F.lit(UNDETERMINED)).withColumn("score", F.lit(0.0))
    sent = docs.sparkSession.sparkContext.broadcast(Reader(net))
    judged = net.langs[-1] == OTHER
    added = ["lang_pred", "score", *["other"] * judged]

    def run(batches):
        reader = sent.value
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                text = part.column(at)
                p = reader.documents(*text_bytes(text))
                if judged:
                    p, none = p[:, :-1], p[:, -1]
                    p = p / np.maximum(1 - none, 1e-9)[:, None]
                best = p.argmax(axis=1)
                known = [t is not None and _LETTER.search(t) is not None for t in text.to_pylist()]
                lang = [reader.langs[i] if k else UNDETERMINED for i, k in zip(best.tolist(), known)]
                score = np.where(known, np.clip(p[np.arange(len(best)), best], 0, 1), 0.0)
                new = [pa.array(lang, pa.string()), pa.array(score), *([pa.array(none)] if judged else [])]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], *new], names=[*names, *added])

    schema = T.StructType([*rows.schema[: len(names)], *[T.StructField(c, T.StringType() if c == "lang_pred" else T.DoubleType()) for c in added]])
    return map_texts(rows, run, schema)


def held_out(doc_id: F.Column, parts: int, part: int) -> F.Column:
    crc = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    return F.coalesce(crc % parts == part, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; a quarter of the documents is never learned from."""
    out = held_out(F.col("doc_id"), 4, 2)
    return predict(docs, fit(docs, ~out), [F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out")])
