"""Byte-pair encoding of a whole corpus: greedy proposal, vectorised check of adjacent tokens, exact merging where it fails.

A sequence of tokens that are each what the merges make of their own bytes is the encoding of the joined bytes exactly if
every two neighbours are: whether a merge crosses a boundary depends only on the two tokens beside it. Merge ids grow with
the order of merging, so that the check undoes the merges of two neighbours from the last to the first and looks for a
merge across the boundary that would have come earlier.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the public pre-tokenisation pattern of the byte-level vocabularies.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_KEPT_WORDS = 400_000
_KEPT_BYTES = 64


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder of one vocabulary. ``source`` is the text of its JSON file."""

    def __init__(self, source: str):
        model = json.loads(source)["model"]
        letters = _byte_letters()
        raw = lambda s: bytes(letters[ch] for ch in s)
        vocab: dict[str, int] = model["vocab"]
        self.ids = {raw(s): i for s, i in vocab.items()}
        self.size = max(vocab.values()) + 1
        self.byte = [self.ids.get(bytes([b]), -1) for b in range(256)]
        #: the two parts of each token; a token of one byte is its own part
        self.left, self.right = np.arange(self.size), np.arange(self.size)
        keys, made = [], []
        for m in model["merges"]:
            x, y = m if isinstance(m, list) else m.split(" ")
            a, b, t = vocab[x], vocab[y], vocab[x + y]
            if t <= max(a, b) or (made and t <= made[-1]):
                raise ValueError("token ids must grow in the order of the merges")
            self.left[t], self.right[t] = a, b
            keys.append(a * self.size + b)
            made.append(t)
        order = np.argsort(keys)
        self.pair_keys, self.pair_made = np.array(keys)[order], np.array(made)[order]
        self.merge = dict(zip(keys, made))
        self.longest: dict[bytes, int] = {}
        for word in self.ids:
            start = word[:2]
            self.longest[start] = max(self.longest.get(start, 0), len(word))
        self.sound = np.zeros(self.size, dtype=np.int8)  # 0 unknown, 1 the merges make this token of its bytes, 2 they don't
        self.kept: dict[str, tuple[int, ...]] = {}
        self.exact_runs = self.proposals = 0

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest matches from the left."""
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        out, at, n, ids, longest = [], 0, len(word), self.ids, self.longest
        while at < n:
            for end in range(min(n, at + longest.get(word[at : at + 2], 1)), at, -1):
                found = ids.get(word[at:end])
                if found is not None:
                    out.append(found)
                    at = end
                    break
            else:
                raise ValueError(f"byte {word[at]} is not in the vocabulary")
        return out

    def made_from(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that merging a and b makes, or the vocabulary's size where there is none."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_made[at], self.size)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each two neighbours, whether no merge crosses their boundary."""
        good = np.ones(len(a), dtype=bool)
        a, b, open_ = a.copy(), b.copy(), np.arange(len(a))
        bound = np.full(len(a), self.size)  # a crossing merge counts only if it comes before this one, which was undone last
        while len(open_):
            crossing = self.made_from(a, b)
            bad = crossing < bound
            good[open_[bad]] = False
            # undo the later merge of the two; of equal tokens the right one is made last, as merging goes from the left
            undo_a = (a > b) & (self.left[a] != a)
            undo_b = ~undo_a & (self.left[b] != b)
            undo_a |= ~undo_a & ~undo_b & (self.left[a] != a)
            left_bound, right_bound = a, b + 1
            bound = np.where(undo_a, left_bound, right_bound)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_b, self.left[b], b)
            go = ~bad & (undo_a | undo_b)
            a, b, bound, open_ = a[go], b[go], bound[go], open_[go]
        return good

    def exact(self, word: bytes) -> list[int]:
        """The merges one by one, the first in order and the leftmost of equals first; a heap over a linked list."""
        parts = [self.byte[x] for x in word]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merge, size = self.merge, self.size
        heap = []
        for i in range(n - 1):
            t = merge.get(parts[i] * size + parts[i + 1])
            if t is not None:
                heap.append((t, i, parts[i], parts[i + 1]))
        heapq.heapify(heap)
        while heap:
            t, i, x, y = heapq.heappop(heap)
            j = after[i] if parts[i] == x else n
            if j >= n or parts[j] != y:
                continue
            parts[i], parts[j], after[i] = t, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q < n and (u := merge.get(parts[p] * size + parts[q])) is not None:
                    heapq.heappush(heap, (u, p, parts[p], parts[q]))
        return [p for p in parts if p >= 0]

    def _sound(self, tokens: np.ndarray, texts: dict[int, bytes]) -> None:
        for t in np.unique(tokens):
            if not self.sound[t]:
                self.sound[t] = 1 if self.exact(texts[int(t)]) == [int(t)] else 2

    def encode_words(self, words: list[str]) -> None:
        """Puts the encodings of the words into ``kept``."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        proposals = [self.propose(w) for w in raw]
        lengths = np.fromiter(map(len, proposals), dtype=np.int64, count=len(proposals))
        flat = np.fromiter((t for p in proposals for t in p), dtype=np.int64, count=int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        fresh = np.unique(flat[self.sound[flat] == 0])
        if len(fresh):
            texts = self.texts
            self._sound(fresh, texts)
        failing = np.zeros(len(words), dtype=bool)
        failing[owner[self.sound[flat] == 2]] = True
        beside = np.flatnonzero(owner[1:] == owner[:-1])
        if len(beside):
            pairs, back = np.unique(flat[beside] * self.size + flat[beside + 1], return_inverse=True)
            good = self.compatible(pairs // self.size, pairs % self.size)[back]
            failing[owner[beside[~good]]] = True
        self.proposals += len(words)
        for i, w in enumerate(words):
            if failing[i]:
                self.exact_runs += 1
                self.kept[w] = tuple(self.exact(raw[i]))
            else:
                self.kept[w] = tuple(proposals[i])

    @property
    def texts(self) -> dict[int, bytes]:
        if not hasattr(self, "_texts"):
            self._texts = {i: w for w, i in self.ids.items()}
        return self._texts

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of each text; null and empty texts give an empty list."""
        split = [WORDS.findall(t) if t else [] for t in texts]
        if len(self.kept) > _KEPT_WORDS:
            self.kept.clear()
        kept = self.kept
        new = list({w for words in split for w in words if w not in kept})
        if new:
            self.encode_words(new)
        out = []
        for words in split:
            ids: list[int] = []
            for w in words:
                ids.extend(kept[w])
            out.append(ids)
        for w in new:  # long words seldom come again and would fill the memory
            if len(w) > _KEPT_BYTES:
                kept.pop(w, None)
        return out


_CODECS: dict[str, Codec] = {}


def codec_of(source: str, digest: str | None = None) -> Codec:
    """The codec of a vocabulary, one per Python process."""
    digest = digest or hashlib.sha256(source.encode()).hexdigest()
    if digest not in _CODECS:
        _CODECS[digest] = Codec(source)
    return _CODECS[digest]


def encoder(spark: SparkSession, vocabulary: str = DEFAULT_VOCABULARY):
    """A function from a text column to its ids, ``array<int>``. The vocabulary file (1.5 MB, its size is fixed by the
    public tokenizer) is read on the driver and broadcast, so executors need no copy of it."""
    source = Path(vocabulary).read_text(encoding="utf-8")
    digest = hashlib.sha256(source.encode()).hexdigest()
    shared = spark.sparkContext.broadcast(source)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        codec = _CODECS.get(digest) or codec_of(shared.value, digest)
        return pd.Series(codec.encode_batch([t if isinstance(t, str) else None for t in texts]))

    return ids


def token_counter(spark: SparkSession, vocabulary: str = DEFAULT_VOCABULARY):
    """A function from a text column to the number of its tokens, ``bigint``; 0 for null and empty texts."""
    source = Path(vocabulary).read_text(encoding="utf-8")
    digest = hashlib.sha256(source.encode()).hexdigest()
    shared = spark.sparkContext.broadcast(source)

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        codec = _CODECS.get(digest) or codec_of(shared.value, digest)
        return pd.Series([len(x) for x in codec.encode_batch([t if isinstance(t, str) else None for t in texts])], dtype="int64")

    return count


def spread(df: DataFrame, needed: int | None = None) -> DataFrame:
    """Spreads rows over all cores where the table has fewer files than the session has cores (one small file is one task)."""
    spark = df.sparkSession
    cores = needed or spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def encode_documents(documents: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``doc_id, ids``: one row per row of the table. Null and empty texts give an empty list; repeated rows stay."""
    ids = encoder(documents.sparkSession, vocabulary)
    return spread(documents.select("doc_id", "text")).select("doc_id", ids(F.col("text")).alias("ids"))


def encoded(text: Column, spark: SparkSession, vocabulary: str = DEFAULT_VOCABULARY) -> Column:
    return encoder(spark, vocabulary)(text)
