"""BPE encoding and decoding with word ends, in batched numpy merge rounds.

Texts are split at ASCII white space into chunks; the ids of a chunk that a worker has met before
are looked up. The words of the new chunks of a batch lie in one flat array of symbols. In each
round the keys of all neighbouring pairs are found by binary search in the sorted pair keys of
the merge table; every word merges its pair of lowest rank, from left to right, and words without
a pair are taken out. Rounds over a very long word would each visit all of it, so words of more
than ``LONG`` symbols are linked lists in arrays: a round takes all pairs of the lowest rank left
and visits only those and their neighbours. Known chunks are kept in a table of bounded size.

The vocabulary is a ``tokenizers`` JSON file of the model BPE with an end-of-word suffix, byte
level symbols, NFC and lower case, and without a decoder: decoding joins tokens by one space.
Its merges must build on earlier ones, as training gives them. Its path is a parameter; all
executors must have the file.

Defined results: null and empty texts give no ids and decode to an empty text. Texts and words of
any length are encoded whole; a word of a million letters takes seconds. Other columns stay as
they are, one named like an added column is replaced; rows may repeat; an empty table gives an
empty result.
"""

from __future__ import annotations

import collections
import functools
import heapq
import itertools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, types as T

CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
PLAIN = re.compile(rf"{CONTRACTIONS}|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
WIDE = regex.compile(rf"{CONTRACTIONS}|[\p{{L}}]+|[\p{{N}}]|[^\s\p{{L}}\p{{N}}]+")
NONE = np.iinfo(np.int64).max
# Chunks kept by a worker and bytes of them; characters taken at a time from a long text.
KNOWN_CHUNKS, KNOWN_BYTES, STEP = 300_000, 16 << 20, 4 << 20
LONG = 400
# Bytes of text encoded at a time; a worker needs about 20 times as much.
BATCH = 4 << 20
SPACES = re.compile(r"[ \t-\r]+")
# White space to Python but not to the vocabulary's patterns.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = itertools.count(256)
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def merge_rounds(symbols: np.ndarray, words: np.ndarray, keys: np.ndarray, ranks: np.ndarray,
                 merged: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Apply merges to all words at once.

    ``symbols`` holds the symbols of all words in order, ``words`` the number of the word of
    each. ``keys`` (left * base + right, sorted), ``ranks`` and ``merged`` are the merge table.
    Returns the final symbols and their words, in order. ``symbols`` is overwritten.
    """
    done_symbols, done_words = [], []
    rank = np.full(len(symbols), NONE)
    result = np.zeros(len(symbols), np.int64)
    stale = np.arange(len(symbols))
    while len(symbols) > 1:
        # Only pairs that a merge has touched are looked up again.
        stale = stale[stale < len(symbols) - 1]
        pair = symbols[stale] * base + symbols[stale + 1]
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        found = (keys[at] == pair) & (words[stale] == words[stale + 1])
        rank[stale] = np.where(found, ranks[at], NONE)
        result[stale] = merged[at]
        rank[-1] = NONE
        starts = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
        lengths = np.diff(np.append(starts, len(words)))
        best = np.repeat(np.minimum.reduceat(rank, starts), lengths)
        over = best == NONE
        if over.any():
            done_symbols.append(symbols[over])
            done_words.append(words[over])
        # Of overlapping pairs (three equal symbols) every second one counts, from the left.
        place = np.flatnonzero((rank == best) & ~over)
        if len(place):
            first = np.append(True, np.diff(place) != 1)
            run = place[np.maximum.accumulate(np.where(first, np.arange(len(place)), 0))]
            place = place[(place - run) % 2 == 0]
            symbols[place] = result[place]
        touched = np.zeros(len(symbols), bool)
        touched[place], touched[place - 1] = True, True
        stays = ~over
        stays[place + 1] = False
        symbols, words, rank, result = symbols[stays], words[stays], rank[stays], result[stays]
        stale = np.flatnonzero(touched[stays])
    done_symbols.append(symbols)
    done_words.append(words)
    symbols, words = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(words, kind="stable")
    return symbols[order], words[order]


def merge_long(symbols: np.ndarray, keys: np.ndarray, ranks: np.ndarray, merged: np.ndarray,
               base: int) -> np.ndarray:
    """Apply merges to one word, lowest rank first, visiting only pairs that change."""
    n = len(symbols)
    symbol, follows, before = symbols.copy(), np.arange(1, n + 1), np.arange(-1, n - 1)
    rank, result = np.full(n, NONE), np.zeros(n, np.int64)
    stays = np.ones(n, bool)
    waiting: dict[int, list[np.ndarray]] = collections.defaultdict(list)
    order: list[int] = []

    def rate(at: np.ndarray) -> None:
        """Look up the pairs that begin at the places, and note them by rank."""
        rank[at] = NONE
        at = at[follows[at] < n]
        pair = symbol[at] * base + symbol[follows[at]]
        found = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        known = keys[found] == pair
        at, found = at[known], found[known]
        rank[at], result[at] = ranks[found], merged[found]
        by_rank = np.argsort(rank[at], kind="stable")
        at = at[by_rank]
        for part in np.split(at, np.flatnonzero(np.diff(rank[at])) + 1):
            if len(part):
                lowest = int(rank[part[0]])
                if lowest not in waiting:
                    heapq.heappush(order, lowest)
                waiting[lowest].append(part)

    rate(np.arange(n))
    while order:
        lowest = heapq.heappop(order)
        at = np.unique(np.concatenate(waiting.pop(lowest)))
        at = at[rank[at] == lowest]
        if not len(at):
            continue
        # Of overlapping pairs every second one counts, from the left.
        count = np.arange(len(at))
        first = np.append(True, follows[at[:-1]] != at[1:])
        at = at[(count - np.maximum.accumulate(np.where(first, count, 0))) % 2 == 0]
        right = follows[at]
        symbol[at], follows[at] = result[at], follows[right]
        stays[right], rank[right] = False, NONE
        inside = follows[at] < n
        before[follows[at][inside]] = at[inside]
        left = before[at]
        rate(np.unique(np.concatenate([at, left[left >= 0]])))
    return symbol[stays]


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.base = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made: dict[str, int] = {}
        for number, (a, b) in enumerate(pairs):
            if max(made.get(a, -1), made.get(b, -1)) >= number or a + b in made:
                raise ValueError(f"merge {number} does not build on earlier ones")
            made[a + b] = number
        key = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        shown = byte_symbols()
        self.inner = np.array([vocab[c] for c in shown], np.int64)
        self.last = np.array([vocab[c + suffix] for c in shown], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile(
            "(" + "|".join(map(re.escape, self.special)) + ")" if self.special else r"(?!)")
        names = {i: t for t, i in (vocab | self.special).items()}
        self.tokens = [names.get(i, "") for i in range(max(names) + 1)]
        self._forget()

    def _forget(self) -> None:
        """The table of known chunks and the ids of each."""
        self.known = pa.array([], pa.string())
        self.coded = pa.array([], pa.list_(pa.int32()))

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the words in order, and how many each word has."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(r) for r in raw])
        code = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[code]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[code[ends]]
        owner = np.repeat(np.arange(len(words)), lengths)
        table = (self.keys, self.ranks, self.merged, self.base)
        far = np.flatnonzero(lengths > LONG)
        if len(far):
            parts = [merge_long(symbols[ends[k] + 1 - lengths[k]:ends[k] + 1], *table) for k in far]
            near = lengths[owner] <= LONG
            ids, of = merge_rounds(symbols[near], owner[near], *table)
            ids = np.concatenate([ids, *parts])
            of = np.concatenate([of, np.repeat(far, [len(p) for p in parts])])
            by_word = np.argsort(of, kind="stable")
            ids, owner = ids[by_word], of[by_word]
        else:
            ids, owner = merge_rounds(symbols, owner, *table)
        return ids.astype(np.int32), np.bincount(owner, minlength=len(words))

    def _learn(self, chunks: list[str]) -> None:
        words: list[str] = []
        counts = []
        for chunk in chunks:
            if chunk.isalpha():
                words.append(chunk)
                counts.append(1)
            else:
                own = (PLAIN if chunk.isascii() else WIDE).findall(chunk)
                words += own
                counts.append(len(own))
        number = collections.defaultdict(itertools.count().__next__)
        at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        ids, size = self._merge(list(number)) if number else (np.empty(0, np.int32), np.empty(0, int))
        of_words = pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum(size)), pa.int32()), ids).take(pa.array(at))
        edges = np.asarray(of_words.offsets)[np.append(0, np.cumsum(counts))]
        self.coded = pa.concat_arrays([self.coded, pa.ListArray.from_arrays(
            pa.array(edges, pa.int32()), of_words.values)])

    def _encode_lists(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lists of chunks in order, and how many each list has."""
        chunks = lists.flatten()
        if len(self.known) > KNOWN_CHUNKS or self.known.nbytes > KNOWN_BYTES:
            self._forget()
        # The known chunks come first, so their codes are their places in the table.
        coded = pa.concat_arrays([self.known, chunks]).dictionary_encode()
        begun, self.known = len(self.known), coded.dictionary
        if len(self.known) > begun:
            self._learn(self.known.slice(begun).to_pylist())
        found = self.coded.take(coded.indices.slice(begun))
        edges = np.asarray(found.offsets) - found.offsets[0].as_py()
        rows = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        return np.asarray(found.flatten()), np.diff(edges[rows])

    def _encode_chunks(self, chunks: list[str]) -> np.ndarray:
        return self._encode_lists(pa.array([chunks], pa.list_(pa.string())))[0]

    @staticmethod
    def _lowered(text: str) -> str:
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _encode_stretches(self, text: str) -> np.ndarray:
        """A long or odd text: special tokens in it, and the rest in stretches."""
        parts = []
        for k, piece in enumerate(self.special_at.split(text)):
            if k % 2:
                parts.append(np.array([self.special[piece]], np.int32))
                continue
            piece, at = self._lowered(piece), 0
            while at < len(piece):
                cut = SPACES.search(piece, at + STEP)
                end = cut.start() if cut else len(piece)
                chunks = [c for c in SPACES.split(piece[at:end]) if c]
                if chunks:
                    parts.append(self._encode_chunks(chunks))
                at = end
        return np.concatenate(parts) if parts else np.empty(0, np.int32)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and where those of each begin and end."""
        odd = {k: self._encode_stretches(t) for k, t in enumerate(texts)
               if t and ("<|" in t or len(t) > STEP or any(c in t for c in SEPARATORS))}
        lowered = pa.array(["" if k in odd or not t else self._lowered(t)
                            for k, t in enumerate(texts)], pa.string())
        ids, sizes = self._encode_lists(pc.ascii_split_whitespace(lowered))
        if odd:
            edges = np.append(0, np.cumsum(sizes))
            parts = [odd.get(k, ids[edges[k]:edges[k + 1]]) for k in range(len(texts))]
            ids, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, np.append(0, np.cumsum(sizes)).astype(np.int64)

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        ids, edges = self.encode(texts)
        return [ids[a:b] for a, b in itertools.pairwise(edges.tolist())]

    def decode_batch(self, ids: list[np.ndarray]) -> list[str]:
        return [" ".join(map(self.tokens.__getitem__, x.tolist())) for x in ids]


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """One vocabulary for each worker process."""
    return WordBpe(path)


def slices(batch: pa.RecordBatch, text: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in stretches of about ``limit`` bytes of text."""
    sizes = np.array(pc.binary_length(batch.column(text)).fill_null(0))
    part = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for a, b in itertools.pairwise(edges):
        if b > a:
            yield batch.slice(a, b - a)


def text_batches(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Stretches of all batches to encode. What a batch has freed goes back to the system, as
    workers live on through later stages."""
    for whole in batches:
        yield from slices(whole, text, BATCH)
        pa.default_memory_pool().release_unused()


def code_texts(docs: DataFrame, path: str, text_col: str = "text",
               decode: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Adds ``ids`` (array of int) and, if asked for, ``decoded``, the ids read back as text.

    ``keep`` names the input columns to return (all, if not given).
    """
    added = ["ids"] + ["decoded"] * decode
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    columns = [*kept, text_col] if text_col not in kept else kept
    source, text = docs.select(*columns), columns.index(text_col)
    schema = T.StructType([docs.schema[c] for c in kept])
    schema = schema.add("ids", T.ArrayType(T.IntegerType(), False), False)
    if decode:
        schema = schema.add("decoded", T.StringType(), False)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in text_batches(batches, text):
            ids, edges = bpe.encode(batch.column(text).to_pylist())
            out = {c: batch.column(k) for k, c in enumerate(kept)}
            out["ids"] = pa.ListArray.from_arrays(
                pa.array(edges, pa.int32()), pa.array(ids, pa.int32()))
            if decode:
                each = [ids[a:b] for a, b in itertools.pairwise(edges.tolist())]
                out["decoded"] = pa.array(bpe.decode_batch(each), pa.string())
            yield pa.RecordBatch.from_pydict(out)

    return source.mapInArrow(code, schema)
