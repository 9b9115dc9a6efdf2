"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Every 3-word n-gram of a test item is a seed, and how often it stands in the training documents never decides what is
found: it only tells how a window goes on. A seed in a document marks a window that holds whatever an alignment through
the seed can reach and still be similar enough (the item's length and the gaps that its score can pay for, on both
sides); overlapping windows of one item are joined, and the item is aligned with the words of each. Match scores 2,
mismatch and gap -1; similarity is the best score by that of the whole item.

Rare seeds (in at most RARE_SHARE of the documents, or RARE_LEAST) go straight to alignment. A window of common seeds
alone is first held against a bound: in any alignment a document's word that the item hasn't costs 1 and every other
wins at most 2, so no score is above the best run of +2 and -1. What is below the threshold there can't be above it in
alignment, so nothing is lost. So a pair is reported if and only if an alignment that holds a seed reaches the threshold.

The items' n-grams are broadcast. Their size is checked: a larger benchmark is dealt by item into blocks of at most
BLOCK_WORDS words. Each is matched with all documents, its result written and its broadcast freed before the next is read, so driver
and workers hold one block. Items are never cut.

Edge cases: null or empty texts, and items of fewer than 3 words (they stand in clean texts by chance), match nothing;
items of up to 6 words need a whole copy (LEAST_SCORE). Words are runs of letters, digits and
non-ASCII signs, A-Z as a-z. Items with a null item_id are matched, and shown with a null. Repeated documents are
reported each, repeated items once. Other columns are ignored. An empty table of either kind gives no matches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from galeframe.llm import kernels
from galeframe.llm.staging import staged

SEED_WORDS, MATCH, OTHER, GAP = 3, 2, -1, -1
SIMILARITY, LEAST_SCORE = 0.4, 12
BLOCK_WORDS = 2_000_000
RARE_SHARE, RARE_LEAST = 1e-3, 10
#: Cells that are aligned together.
CELLS = 1 << 18


def _words(texts: pa.Array) -> Iterator[tuple[kernels.Chunk, kernels.Words, np.ndarray]]:
    for chunk in kernels.chunks(texts):
        w = kernels.words(chunk, kernels.ALNUM, lower=True)
        yield chunk, w, kernels.word_hashes(chunk, w, lower=True)


@dataclass
class Items:
    """A block of test items: the word hashes of each, one after another, and their n-grams, sorted."""

    words: np.ndarray
    starts: np.ndarray
    ids: list
    grams: np.ndarray
    owners: np.ndarray
    places: np.ndarray
    table: np.ndarray
    rare: np.ndarray | None = None

    @staticmethod
    def of(ids: list, texts: list) -> Items:
        hashes = [h[a:b] for _, w, h in _words(pa.array(texts, pa.string())) for a, b in zip(w.rows[:-1], w.rows[1:], strict=True)]
        sizes = np.array([len(h) for h in hashes], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        words = np.concatenate([np.empty(0, dtype=np.uint64), *hashes])
        grams = kernels.ngram_hashes(words, SEED_WORDS)
        owners = np.repeat(np.arange(len(ids)), sizes)[: len(grams)]
        places = np.arange(len(grams)) - starts[owners]
        inside = places + SEED_WORDS <= sizes[owners] if len(grams) else np.zeros(0, dtype=bool)
        return Items(words, starts, ids, *Items._sorted(grams[inside], owners[inside], places[inside]))

    @staticmethod
    def _sorted(grams: np.ndarray, owners: np.ndarray, places: np.ndarray) -> tuple:
        order = np.argsort(grams, kind="stable")
        table = np.zeros(1 << 16, dtype=bool)
        table[(grams & np.uint64(0xFFFF)).astype(np.int64)] = True
        return grams[order], owners[order], places[order], table

    def with_counts(self, counts: np.ndarray, documents: int) -> Items:
        """Knows which n-grams are rare. counts: in how many of the documents each stands."""
        return replace(self, rare=counts <= max(RARE_LEAST, RARE_SHARE * documents))

    def needed(self, item: int) -> float:
        """The least score of a leak of an item."""
        size = int(self.starts[item + 1] - self.starts[item])
        return max(SIMILARITY * MATCH * size, min(LEAST_SCORE, MATCH * size))

    def hits(self, w: kernels.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, word index in the chunk and n-gram index (the first of equals) of each n-gram that stands in a row."""
        grams = kernels.ngram_hashes(hashes, SEED_WORDS)
        at = np.flatnonzero(self.table[(grams & np.uint64(0xFFFF)).astype(np.int64)])
        if not len(at) or not len(self.grams):
            none = np.empty(0, dtype=np.int64)
            return none, none, none
        k = np.searchsorted(self.grams, grams[at])
        k = np.minimum(k, len(self.grams) - 1)
        row = np.searchsorted(w.rows, at, side="right") - 1
        ok = (self.grams[k] == grams[at]) & (at + SEED_WORDS <= w.rows[row + 1])
        return row[ok], at[ok], k[ok]


def align(item: np.ndarray, windows: list[np.ndarray]) -> np.ndarray:
    """The best local alignment score of one item with each window of word hashes."""
    most = max(len(w) for w in windows)
    text = np.zeros((len(windows), most), dtype=np.uint64)
    real = np.zeros((len(windows), most), dtype=bool)
    for i, w in enumerate(windows):
        text[i, : len(w)], real[i, : len(w)] = w, True
    slope = (-GAP * np.arange(most + 1, dtype=np.int32))[None, :]
    row, best = np.zeros((len(windows), most + 1), dtype=np.int32), np.zeros(len(windows), dtype=np.int32)
    for word in item:
        step = np.where((text == word) & real, MATCH, OTHER).astype(np.int32)
        now = np.maximum(row + GAP, 0)
        np.maximum(now[:, 1:], row[:, :-1] + step, out=now[:, 1:])
        row = np.maximum.accumulate(now + slope, axis=1) - slope
        np.maximum(best, row.max(axis=1), out=best)
    return best


def bounds(own: np.ndarray, windows: list[np.ndarray]) -> np.ndarray:
    """For each window of word hashes a score that no alignment with an item of the (sorted) words `own` exceeds."""
    most = max(len(w) for w in windows)
    worth = np.full((len(windows), most + 1), OTHER, dtype=np.int32)
    worth[:, 0] = 0
    flat = np.concatenate(windows)
    k = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    sizes = np.array([len(w) for w in windows])
    row = np.repeat(np.arange(len(windows)), sizes)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
    worth[row, column] = np.where(own[k] == flat, MATCH, OTHER)
    sums = np.cumsum(worth, axis=1)
    return (sums - np.minimum.accumulate(sums, axis=1)).max(axis=1)


def _windows(items: Items, w: kernels.Words, row: np.ndarray, at: np.ndarray, k: np.ndarray) -> dict[int, list[tuple[int, int, int, bool]]]:
    """By item: row, first and last word index of its windows, and whether a rare seed is there. Every item that has the n-gram gets one."""
    upto = np.searchsorted(items.grams, items.grams[k], side="right")
    times = upto - k
    entry = np.repeat(k, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    row, at = np.repeat(row, times), np.repeat(at, times)
    owner, place = items.owners[entry], items.places[entry]
    size = items.starts[owner + 1] - items.starts[owner]
    slack = np.ceil((1 - SIMILARITY) * MATCH * size / -GAP).astype(np.int64)  # the gaps that a similar alignment can pay for
    first = np.maximum(at - place - slack, w.rows[row])
    last = np.minimum(at - place + size + slack, w.rows[row + 1])
    rare = np.ones(len(entry), dtype=bool) if items.rare is None else items.rare[entry]
    order = np.lexsort((first, row, owner))
    owner, row, first, last, rare = owner[order], row[order], first[order], last[order], rare[order]
    # A window opens where its item or row differs from the one before, or where all before it have ended.
    group = np.cumsum(np.concatenate([[True], (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])]))
    shift = group * (int(last.max()) + 1)
    reach = np.maximum.accumulate(last + shift)
    opens = np.flatnonzero(np.concatenate([[True], first[1:] + shift[1:] > reach[:-1]]))
    out: dict[int, list[tuple[int, int, int, bool]]] = {}
    columns = (owner[opens], row[opens], first[opens], np.maximum.reduceat(last, opens), np.logical_or.reduceat(rare, opens))
    for o, *found in zip(*(c.tolist() for c in columns), strict=True):
        out.setdefault(o, []).append(tuple(found))
    return out


def _runs(found: list, size: Callable) -> Iterator[list]:
    """`found`, sorted by size, in runs that fill about CELLS once all are as wide as the widest."""
    begin = 0
    while begin < len(found):
        end = begin + 1
        while end < len(found) and (end + 1 - begin) * size(found[end]) <= CELLS:
            end += 1
        yield found[begin:end]
        begin = end


def leaks(items: Items, w: kernels.Words, hashes: np.ndarray) -> list[tuple[int, int, float, int, int]]:
    """Row, item, similarity, and first and last word (of the row) of the window of the best match of each leak in a chunk."""
    row, at, k = items.hits(w, hashes)
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    if not len(row):
        return []
    for o, found in _windows(items, w, row, at, k).items():
        item, needed = items.words[items.starts[o] : items.starts[o + 1]], items.needed(o)
        own, long = np.unique(item), lambda f: f[2] - f[1]
        found.sort(key=long)
        common, rare = [f for f in found if not f[3]], [f for f in found if f[3]]
        for run in _runs(common, long):
            rare += [f for f, b in zip(run, bounds(own, [hashes[f[1] : f[2]] for f in run]).tolist(), strict=True) if b >= needed]
        rare.sort(key=long)
        for run in _runs(rare, long):
            for (r, a, b, _), score in zip(run, align(item, [hashes[f[1] : f[2]] for f in run]).tolist(), strict=True):
                share = score / (MATCH * len(item))
                if score >= needed and share > best.get((r, o), (0,))[0]:
                    best[r, o] = (share, a - int(w.rows[r]), b - int(w.rows[r]) - 1)
    return [(r, o, *v) for (r, o), v in sorted(best.items())]


def _blocks(benchmark: DataFrame) -> Iterator[tuple[Items, int]]:
    """The distinct items, in blocks of a size that can be broadcast, each with the number of blocks."""
    rows = benchmark.select("item_id", "text").filter("text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + int(total) // (2 * BLOCK_WORDS)
    for i in range(n):
        got = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).orderBy("item_id", "text").toArrow() if n > 1 else rows.orderBy("item_id", "text").toArrow()
        if got.num_rows:
            yield Items.of(got["item_id"].to_pylist(), got["text"].to_pylist()), n


def _counted(docs: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """In how many documents each n-gram of the block stands, and how many documents there are."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        counts, rows = np.zeros(len(own.grams), dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, w, hashes in _words(batch.column("text")):
                row, _, k = own.hits(w, hashes)
                if len(row):
                    counts += np.bincount(np.unique(row * len(own.grams) + k) % len(own.grams), minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, len(counts))), pa.array(np.append(counts[at], rows))], ["gram", "n"])

    found = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    shared.destroy()
    counts = np.zeros(len(items.grams) + 1, dtype=np.int64)
    counts[found["gram"].to_numpy()] = found["n"].to_numpy()
    return counts[np.searchsorted(items.grams, items.grams)], int(counts[-1])


def _by_block(docs: DataFrame, benchmark: DataFrame, made: Callable[[Broadcast], DataFrame]) -> Iterator[DataFrame]:
    """What is made of each block of items. Of several blocks, each is done with before the next begins."""
    for items, n in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items.with_counts(*_counted(docs, items)))
        out = made(shared)
        if n == 1:
            yield out
        else:
            yield staged(out, "leaks")
            shared.destroy()


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, first_word and last_word of each item's best match in each row of `docs`."""
    id_type, item_type = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("item_id", item_type), T.StructField("similarity", T.DoubleType()), T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType())])
    item_kind = to_arrow_type(item_type)

    def of(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                item_ids = pa.array(own.ids, item_kind)
                for chunk, w, hashes in _words(batch.column("text")):
                    if found := leaks(own, w, hashes):
                        r, o, share, a, b = zip(*found, strict=True)
                        ids = batch.column("doc_id").take(pa.array([chunk.first + x for x in r]))
                        yield pa.RecordBatch.from_arrays([ids, item_ids.take(pa.array(o)), pa.array(share), pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema.names)

        return docs.select("doc_id", "text").mapInArrow(run, schema)

    return reduce(DataFrame.union, _by_block(docs, benchmark, of), docs.sparkSession.createDataFrame([], schema))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, in which no test item leaks."""
    rest = docs

    def of(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                for chunk, w, hashes in _words(batch.column("text")):
                    for r, *_ in leaks(own, w, hashes):
                        clean[chunk.first + r] = False
                yield batch.filter(pa.array(clean))

        return rest.mapInArrow(run, docs.schema)

    for left in _by_block(docs, benchmark, of):
        rest = left
    return rest
