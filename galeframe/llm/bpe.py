"""Byte-level BPE encoding by speculation and verification, and decoding.

For each new word, greedy longest match proposes tokens. A proposal is the encoding if every token is what its own
bytes merge to and no merge ever crosses a boundary between neighbours: that is tested for all adjacent pairs at once
with numpy. Only words that fail are merged exactly.

Why the test is right: beside a boundary stand, one after another, the tokens of the left token's right edge and of
the right token's left edge; each is there from its own merge until its parent's. A merge across the boundary happens
if its pair has a rank before both parents' (as merges go by rank, then from the left, a tie is won by a merge inside
the left token, and lost by one inside the right token). A merge has a higher rank than the merges that made its
parts, so the pair is then complete.

Edge cases: a null text is encoded as an empty one, and has no tokens. Strings of special tokens in a text are their
ids. Texts are encoded whole. Ids outside the vocabulary are an error. Other columns are ignored; repeated rows give
repeated results, empty tables empty ones.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: How a text parts into words; \s is Unicode's White_Space. A fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Words whose ids a worker remembers and the letters that such a word has at most, and rows that are encoded together.
REMEMBERED, LETTERS, TOGETHER = 300_000, 64, 64
NO_RANK = 1 << 40
NEVER = np.int64(NO_RANK)


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte: itself where it prints, else the next letter from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """The tables of a tokenizer file, of a size set by its vocabulary."""

    def __init__(self, text: str) -> None:
        model, letters = json.loads(text), byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        vocab = model["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.bytes: dict[int, bytes] = {i: raw(t) for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        size = max(self.bytes) + 1
        self.ids = {raw(t): i for t, i in vocab.items() if t not in self.special}
        self.byte_ids = [self.ids[bytes([b])] for b in range(256)]
        self.strings = [str(i) for i in range(size)]
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(pairs)}
        self.made = [c for _, _, c in pairs]
        #: the rank that makes each token (-1: a byte), and its parts
        self.born = np.full(size, -1, dtype=np.int64)
        self.parts = np.full((size, 2), -1, dtype=np.int64)
        for r, (a, b, c) in enumerate(pairs):
            if self.born[c] < 0:
                self.born[c], self.parts[c] = r, (a, b)
        self.size = size
        keys = np.array([a * size + b for a, b, _ in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_ranks = keys[order], order.astype(np.int64)
        self.edges = [self._edge(1), self._edge(0)]
        self.longest: dict[bytes, int] = {}
        for t in self.ids:
            self.longest[t[:2]] = max(self.longest.get(t[:2], 0), len(t))
        made = np.flatnonzero(self.born >= 0)
        self.sound = np.ones(size, dtype=bool)
        self.sound[made] = self.compatible(self.parts[made, 0], self.parts[made, 1], self.born[made])
        for c in made[np.argsort(self.born[made])]:
            self.sound[c] &= self.sound[self.parts[c, 0]] and self.sound[self.parts[c, 1]]
        self.pattern, self.specials = None, None
        self.known: dict[str, tuple[int, ...]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"pattern": None, "specials": None, "known": {}}

    def _edge(self, side: int) -> np.ndarray:
        """Row t: t, then its part on that side, and so on; -1 beyond a byte."""
        columns = [np.arange(self.size)]
        while (columns[-1] >= 0).any():
            last = columns[-1]
            columns.append(np.where(last >= 0, self.parts[np.maximum(last, 0), side], -1))
        return np.stack(columns[:-1], axis=1)

    def compatible(self, left: np.ndarray, right: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge before rank `until` (default: ever) crosses the boundary of each pair of tokens."""
        out = np.ones(len(left), dtype=bool)
        end = np.full(len(left), NEVER) if until is None else until
        for i in range(self.edges[0].shape[1]):
            x = self.edges[0][left, i]
            if (x < 0).all():
                break
            x_end = end if i == 0 else self.born[self.edges[0][left, i - 1]]
            for j in range(self.edges[1].shape[1]):
                y = self.edges[1][right, j]
                at = np.flatnonzero((x >= 0) & (y >= 0) & out)
                if not len(at):
                    if (y < 0).all():
                        break
                    continue
                key = x[at] * self.size + y[at]
                k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                rank = np.where(self.keys[k] == key, self.key_ranks[k], NEVER)
                y_end = end if j == 0 else self.born[self.edges[1][right, j - 1]]
                out[at[(rank < x_end[at]) & (rank < NEVER) & ((rank < y_end[at]) if j == 0 else (rank <= y_end[at]))]] = False
        return out

    def greedy(self, word: bytes) -> list[int] | None:
        out, at, n = [], 0, len(word)
        while at < n:
            for size in range(min(self.longest.get(word[at : at + 2], 1), n - at), 0, -1):
                token = self.ids.get(word[at : at + size])
                if token is not None:
                    break
            else:
                return None
            out.append(token)
            at += size
        return out

    def merged(self, word: bytes) -> list[int]:
        """The exact merges of a word: lowest rank first, then leftmost."""
        tokens = list(map(self.byte_ids.__getitem__, word))
        return self._merged_long(tokens) if len(tokens) > 64 else self._merged_short(tokens)

    def _merged_short(self, tokens: list[int]) -> list[int]:
        rank, made = self.rank.get, self.made
        ranks = [rank(p, NO_RANK) for p in zip(tokens, tokens[1:], strict=False)]
        while ranks and (r := min(ranks)) < NO_RANK:
            i = ranks.index(r)
            tokens[i] = made[r]
            del tokens[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank((tokens[i - 1], tokens[i]), NO_RANK)
            if i < len(ranks):
                ranks[i] = rank((tokens[i], tokens[i + 1]), NO_RANK)
        return tokens

    def _merged_long(self, tokens: list[int]) -> list[int]:
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, tokens[i], tokens[i + 1]) for i in range(n - 1) if (r := self.rank.get((tokens[i], tokens[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tokens[i] != a or j >= n or tokens[j] != b:
                continue
            tokens[i], tokens[j] = self.made[r], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (s := self.rank.get((tokens[k], tokens[after[k]]))) is not None:
                    heapq.heappush(heap, (s, k, tokens[k], tokens[after[k]]))
        return [t for t in tokens if t >= 0]

    def learn(self, words: list[str]) -> int:
        """Remember the ids of some words; how many had to be merged exactly."""
        raw = [w.encode() for w in words]
        guesses = [self.greedy(w) for w in raw]
        sizes = np.array([len(g or ()) for g in guesses])
        flat = np.fromiter(chain.from_iterable(g or () for g in guesses), dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        good = np.array([g is not None for g in guesses], dtype=bool)
        good[owner[~self.sound[flat]]] = False
        near = np.flatnonzero(owner[1:] == owner[:-1])
        if len(near):
            pairs, back = np.unique(flat[near] * self.size + flat[near + 1], return_inverse=True)
            fits = self.compatible(pairs // self.size, pairs % self.size)
            good[owner[near[~fits[back]]]] = False
        for word, data, guess, ok in zip(words, raw, guesses, good.tolist(), strict=True):
            self.known[word] = tuple(guess if ok else self.merged(data))
        return int((~good).sum())

    def split(self, text: str) -> list[list[str] | int]:
        """Lists of words, and ids of special tokens between them."""
        if self.pattern is None:
            self.pattern = regex.compile(PATTERN)
            self.specials = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        parts = self.specials.split(text) if self.specials else [text]
        return [self.special[p] if i % 2 else self.pattern.findall(p) for i, p in enumerate(parts) if p]

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        split = [self.split(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = set(chain.from_iterable(p for s in split for p in s if isinstance(p, list))).difference(self.known)
        if new:
            self.learn(sorted(new))
        for s in split:
            out: list[int] = []
            for p in s:
                if isinstance(p, list):
                    out.extend(chain.from_iterable(map(self.known.__getitem__, p)))
                else:
                    out.append(p)
            yield out
        for word in new:
            if len(word) > LETTERS:
                del self.known[word]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def load(path: str) -> Codec:
    with open(path, encoding="utf-8") as f:
        return Codec(f.read())


def _runs(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list]]:
    for at in range(0, batch.num_rows, TOGETHER):
        yield at, batch.column(column).slice(at, TOGETHER).to_pylist()


def _mapped(df: DataFrame, codec: Codec, column: str, schema: str, make: Callable[[Codec, list], list[pa.Array]]) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(codec)  # a size set by the vocabulary
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at, values in _runs(batch, column):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, TOGETHER), *make(own, values)], ["doc_id", *names])

    id_type = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", column).mapInArrow(run, f"doc_id {id_type}, {schema}")


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (an array of token ids) of each row of `docs`."""
    make = lambda codec, texts: [pa.array(list(codec.encode([t or "" for t in texts])), pa.list_(pa.int32()))]
    return _mapped(docs, load(path), "text", "ids array<int>", make)


def decode_documents(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and text of each row of `tokens` (doc_id, ids); null ids give an empty text."""
    make = lambda codec, ids: [pa.array([codec.decode(i or []) for i in ids], pa.string())]
    return _mapped(tokens, load(path), "ids", "text string", make)


def _digests(codec: Codec, texts: list) -> list[pa.Array]:
    rows = []
    for ids in codec.encode([t or "" for t in texts]):
        joined = ",".join(map(codec.strings.__getitem__, ids))
        rows.append((len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest()))
    n, a, b = zip(*rows, strict=True)
    return [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row of `docs`, encoded and decoded in one pass."""
    return _mapped(docs, load(path), "text", "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests)
