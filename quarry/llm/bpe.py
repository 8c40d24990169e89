"""Byte-pair encoding and decoding with a pair occurrence index.

The tokenizer file (a parameter; it is read on the driver and sent to the
tasks, its size is fixed by the vocabulary) gives the vocabulary, the merges,
the word pattern's suffix rule and the special tokens. Each task takes the
distinct words of one batch of texts, lays their symbols out in one array and
keeps an index from each mergeable pair to all its positions. The active ranks
are applied in ascending order; every merge updates the lists of the pairs that
it makes. Words are independent, so one pass over the ranks encodes all of them
as encoding each by itself would.

Defined results: a null text is an empty text, with no tokens; special tokens
standing in a text become their ids, as the tokenizers library does by default;
texts are never cut, a long one is a batch by itself; other columns are kept out.
Repeated rows give repeated results, an empty table an empty one.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: The word pattern of this tokenizer family (text is lower-cased,
#: white space is dropped).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"

#: Characters of text that are encoded together (a longer text is alone).
BATCH_CHARS = 2_000_000

_SEPARATORS = regex.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class WordBpe:
    """A word-level BPE vocabulary: ``encode`` texts to ids, ``decode`` ids to text."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + self.suffix] for c in letters], np.int64)
        pairs = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])], np.int64).reshape(-1, 3)
        self.left, self.made = pairs[:, 0], pairs[:, 2]
        self.right = pairs[:, 1]
        key = (pairs[:, 0] << 32) | pairs[:, 1]
        # the first of equal pairs has the lower rank
        self.pair_keys, self.pair_rank = np.unique(key, return_index=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(PATTERN)

    @classmethod
    def from_file(cls, path: str) -> WordBpe:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    # -------------------------------------------------------------- words

    def normal(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        # lower-casing goes letter by letter: no final form of sigma
        return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)

    def pieces(self, text: str, index: dict[str, int], chunks: dict[str, list[int]]) -> list[int]:
        """Numbers of the text's words in ``index`` (which grows); special tokens as ``-1 - id``.

        No word crosses white space, so the words of each chunk between white
        space are found once and remembered in ``chunks``.
        """
        if self.split is None or "<|" not in text and not self.split.search(text):
            return self._plain(text, index, chunks)
        out = []
        for part in self.split.split(text):
            if part in self.special:
                out.append(-1 - self.special[part])
            else:
                out += self._plain(part, index, chunks)
        return out

    def _plain(self, text: str, index: dict[str, int], chunks: dict[str, list[int]]) -> list[int]:
        text = self.normal(text)
        if _SEPARATORS.search(text):  # str.split() takes these for white space, the pattern does not
            return [index.setdefault(w, len(index)) for w in self.words.findall(text)]
        out = []
        for chunk in text.split():
            numbers = chunks.get(chunk)
            if numbers is None:
                numbers = chunks[chunk] = [index.setdefault(w, len(index)) for w in self.words.findall(chunk)]
            out += numbers
        return out

    # -------------------------------------------------------------- merges

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        if not len(self.pair_keys):
            return np.full(len(a), -1)
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], -1)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all words one after another, and where each word's ids begin."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(raw), np.uint8)
        ids = self.inner[data]
        ids[ends - 1] = self.final[data[ends - 1]]
        n = len(ids)
        # one slot of -1 stands before and after all symbols; words end at a border
        after = np.arange(1, n + 1)
        after[ends - 1] = n
        before = np.arange(-1, n - 1)
        before[np.append(0, ends[:-1])] = n
        ids = np.append(ids, -1)

        at = np.flatnonzero(after < n)
        rank = self._ranks(ids[at], ids[after[at]])
        at, rank = at[rank >= 0], rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cut = np.append(np.flatnonzero(np.append(True, rank[1:] != rank[:-1])), len(rank)) if len(rank) else np.zeros(1, int)
        #: the index: rank of a pair -> its positions
        where: dict[int, list[np.ndarray]] = defaultdict(list)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            where[int(rank[a])].append(at[a:b])
        active = list(where)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            lists = where.pop(r)
            p = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            left, right, new = self.left[r], self.right[r], self.made[r]
            q = after[p]
            live = (ids[p] == left) & (ids[q] == right)  # others were merged meanwhile
            p, q = p[live], q[live]
            if left == right and len(p) > 1:  # in a run of equal symbols, every second pair
                p, q = _apart(p, q)
            if not len(p):
                continue
            nxt, prv = after[q], before[p]
            ids[p], ids[q] = new, -2
            after[p] = nxt
            inner = nxt < n
            before[nxt[inner]] = p[inner]
            had = prv < n
            prv = prv[had]
            pa_, pb = np.concatenate([ids[prv], ids[p[inner]]]), np.concatenate([ids[after[prv]], ids[nxt[inner]]])
            pos = np.concatenate([prv, p[inner]])
            rank = self._ranks(pa_, pb)
            ok = rank >= 0
            rank, pos = rank[ok], pos[ok]
            if not len(rank):
                continue
            order = np.argsort(rank, kind="stable")
            rank, pos = rank[order], pos[order]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for k, positions in zip(rank[np.append(0, cut)].tolist(), np.split(pos, cut) if len(cut) else [pos]):
                if k not in where:
                    heapq.heappush(active, k)
                where[k].append(positions)
        alive = ids[:n] >= 0
        word_of = np.repeat(np.arange(len(words)), sizes)[alive]
        return ids[:n][alive], np.searchsorted(word_of, np.arange(len(words) + 1))

    # -------------------------------------------------------------- texts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """ids of each text."""
        index: dict[str, int] = {}
        chunks: dict[str, list[int]] = {}
        rows = [np.array(self.pieces(t, index, chunks), np.int64) for t in texts]
        if index:
            flat, begin = self.encode_words(list(index))
        else:
            flat, begin = np.zeros(0, np.int64), np.zeros(1, np.int64)
        size = np.diff(begin)
        out = []
        for w in rows:
            if (w < 0).any():
                out.append(np.concatenate([flat[begin[x] : begin[x + 1]] if x >= 0 else np.array([-1 - x]) for x in w.tolist()]))
                continue
            k = size[w]
            stop = np.cumsum(k)
            out.append(flat[np.repeat(begin[w] - stop + k, k) + np.arange(stop[-1])] if len(w) else flat[:0])
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``: this family has no decoder of its own, tokens are joined by spaces."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def _apart(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose pairs do not overlap, leftmost first (``p`` ascending)."""
    joined = np.append(False, p[1:] == q[:-1])
    if not joined.any():
        return p, q
    run = np.flatnonzero(~joined)
    nth = np.arange(len(p)) - np.repeat(run, np.diff(np.append(run, len(p))))
    return p[nth % 2 == 0], q[nth % 2 == 0]


def _text_batches(batch: pa.RecordBatch, text: int):
    """Row ranges of about BATCH_CHARS characters."""
    size = np.asarray(pc.fill_null(pc.utf8_length(batch.column(text)), 0), dtype=np.int64)
    total = np.append(0, np.cumsum(size))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(total, total[a] + BATCH_CHARS, "right")) - 1)
        yield a, min(b, batch.num_rows)
        a = b


def encode(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """doc_id and ``ids``, the token ids of each whole text."""
    spec = docs.sparkSession.sparkContext.broadcast(WordBpe.from_file(tokenizer))

    def run(batches):
        bpe = spec.value
        for batch in batches:
            for a, b in _text_batches(batch, 1):
                rows = bpe.encode([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()])
                offsets = np.append(0, np.cumsum([len(r) for r in rows]))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(rows), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], names=["doc_id", "ids"])

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text)), run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids and ``decoded``, the text that the ids stand for."""
    spec = tokens.sparkSession.sparkContext.broadcast(WordBpe.from_file(tokenizer))

    def run(batches):
        bpe = spec.value
        for batch in batches:
            ids = batch.column(1)
            flat, offs = ids.flatten().to_numpy(), ids.offsets.to_numpy() - ids.offsets[0].as_py()
            for a in range(0, batch.num_rows, 500):
                b = min(a + 500, batch.num_rows)
                text = [bpe.decode(flat[x:y]) for x, y in zip(offs[a:b], offs[a + 1 : b + 1])]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string())], names=["doc_id", "ids", "decoded"])

    return map_texts(tokens.select("doc_id", "ids"), run, "doc_id long, ids array<int>, decoded string")


def tokens(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """doc_id, ``ids`` and ``decoded``: encodes and decodes in one pass."""
    spec = docs.sparkSession.sparkContext.broadcast(WordBpe.from_file(tokenizer))

    def run(batches):
        bpe = spec.value
        for batch in batches:
            for a, b in _text_batches(batch, 1):
                rows = bpe.encode([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()])
                for x in range(0, b - a, 500):
                    some = rows[x : x + 500]
                    offsets = np.append(0, np.cumsum([len(r) for r in some]))
                    ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(some), pa.int32()))
                    decoded = pa.array(list(map(bpe.decode, some)), pa.string())
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a + x, len(some)), ids, decoded], names=["doc_id", "ids", "decoded"])

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text)), run, "doc_id long, ids array<int>, decoded string")


def round_trip(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, decodes and digests in one pass."""
    spec = docs.sparkSession.sparkContext.broadcast(WordBpe.from_file(tokenizer))

    def run(batches):
        bpe = spec.value
        for batch in batches:
            for a, b in _text_batches(batch, 1):
                n, of_ids, of_text = [], [], []
                for ids in bpe.encode([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]):
                    n.append(len(ids))
                    of_ids.append(hashlib.sha256(ids.astype("<u4")).hexdigest())
                    of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text)),
                     run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
