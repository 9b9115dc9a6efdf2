"""Ranked lexical search: an inverted index in shards, merged document at a time.

The index needs no shuffle: each task cuts its own documents into shards of bounded size. A shard holds its documents
sorted by doc_id, with their lengths, and for each term a posting list sorted by doc_id, compressed block by block (gaps
and counts in as few bytes as the block's largest needs). Its rows are (shard, term, n, total, data); the row without a
term holds the documents. Rows of a shard are sorted by term, so a reader's term filter can skip row groups.

A search reads only the terms of its items. A shard is one task's group and bounded; it is merged for each item by a heap
of posting cursors keyed by the first doc_id of their next block. Documents below the heap's top are complete: they are
scored together and offered to a bounded heap keyed score, then doc_id. That heap lives through all shards of a task,
and a last rank over the tasks' rows merges them. Items are broadcast in blocks of at most BLOCK_TERMS terms; each
block's result is written before the next is read.

Edge cases: a null or empty text has no terms and is no document in N; an item without terms, or whose terms nobody
holds, has no rows. Each row of `docs` is a document of its own, also where doc_ids repeat; a null doc_id comes last in
ties. Rows of `items` that are equal count once; of one item_id with different texts each is ranked by itself. Texts are
read whole. Other columns are ignored. Empty tables give an empty result. doc_id must be an integer.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galeframe.llm import kernels
from galeframe.llm.staging import staged

#: A shard ends once it has this many documents or postings (one text is never cut).
SHARD_DOCS, SHARD_POSTINGS = 1 << 16, 2_000_000
BLOCK, BLOCK_TERMS = 512, 2_000_000
#: Postings that are decoded before documents are scored.
TOGETHER = 8192
TOP = 20
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
INDEX = "shard string, term string, n long, total long, data binary"
#: Stands for a null doc_id: after all others.
NO_ID = np.iinfo(np.int64).max


def _narrow(values: np.ndarray) -> bytes:
    """A byte that tells the width, then the values in that width."""
    top = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _wide(data: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    width = data[at]
    end = at + 1 + n * width
    return np.frombuffer(data, dtype=f"<u{width}", count=n, offset=at + 1).astype(np.int64), end


def pack_postings(docs: np.ndarray, counts: np.ndarray) -> bytes:
    """Blocks of ascending places of documents in a shard and how often each holds the term.

    A header tells the number of postings, and the first place and start of each block."""
    bodies, firsts = [], docs[::BLOCK]
    for i in range(0, len(docs), BLOCK):
        bodies.append(_narrow(np.diff(docs[i : i + BLOCK])) + _narrow(counts[i : i + BLOCK]))
    starts = np.cumsum([0, *(len(b) for b in bodies[:-1])]).astype("<u4")
    return np.array([len(docs)], dtype="<u4").tobytes() + firsts.astype("<u4").tobytes() + starts.tobytes() + b"".join(bodies)


def pack_all(sizes: np.ndarray, docs: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """`pack_postings` of lists that stand one after another; lists of one block, size and width are packed together."""
    if not len(sizes):
        return []
    starts = np.cumsum(sizes) - sizes
    gaps = np.diff(docs, prepend=0)
    gaps[starts] = 0
    width = lambda x: 1 << np.searchsorted([1 << 8, 1 << 16, 1 << 32], np.maximum.reduceat(x, starts), side="right")
    gap_width, count_width = width(gaps), width(counts)
    out: list[bytes] = [b""] * len(sizes)
    keys = np.where(sizes <= BLOCK, sizes * 256 + gap_width * 16 + count_width, 0)
    for key in np.unique(keys).tolist():
        at = np.flatnonzero(keys == key)
        if key == 0:
            for i in at.tolist():
                out[i] = pack_postings(docs[starts[i] : starts[i] + sizes[i]], counts[starts[i] : starts[i] + sizes[i]])
            continue
        n, g, c = key // 256, key // 16 % 16, key % 16
        cells = starts[at][:, None] + np.arange(n)
        head = np.stack([np.full(len(at), n), docs[starts[at]], np.zeros(len(at), dtype=np.int64)], axis=1).astype("<u4")
        flags = [np.full((len(at), 1), w, dtype=np.uint8) for w in (g, c)]
        body = [np.ascontiguousarray(x).view(np.uint8).reshape(len(at), -1) for x in (head, gaps[cells[:, 1:]].astype(f"<u{g}"), counts[cells].astype(f"<u{c}"))]
        raw = np.hstack([body[0], flags[0], body[1], flags[1], body[2]]).tobytes()
        long = len(raw) // len(at)
        for k, i in enumerate(at.tolist()):
            out[i] = raw[k * long : (k + 1) * long]
    return out


class Cursor:
    """A posting list read block by block."""

    def __init__(self, data: bytes, weight: int) -> None:
        self.data, self.weight = data, weight
        self.n = int(np.frombuffer(data, dtype="<u4", count=1)[0])
        blocks = -(-self.n // BLOCK)
        self.firsts = np.frombuffer(data, dtype="<u4", count=blocks, offset=4).tolist()
        self.starts = np.frombuffer(data, dtype="<u4", count=blocks, offset=4 + 4 * blocks).tolist()
        self.body, self.next = 4 + 8 * blocks, 0

    def block(self) -> tuple[np.ndarray, np.ndarray]:
        i = self.next
        size = min(BLOCK, self.n - i * BLOCK)
        gaps, end = _wide(self.data, self.body + self.starts[i], size - 1)
        counts, _ = _wide(self.data, end, size)
        docs = np.empty(size, dtype=np.int64)
        docs[0] = self.firsts[i]
        np.cumsum(gaps, out=docs[1:])
        docs[1:] += docs[0]
        self.next += 1
        return docs, counts


def complete_documents(cursors: list[Cursor], norms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of documents, ascending over all that is yielded, with their scores. norms: 12 times each document's m."""
    heap = [(c.firsts[0], i) for i, c in enumerate(cursors)]
    heapq.heapify(heap)
    docs, parts = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    while heap:
        new_docs, new_parts, pending = [docs], [parts], len(docs)
        while heap and (pending < TOGETHER or len(new_docs) == 1):
            cursor = cursors[heap[0][1]]
            d, count = cursor.block()
            new_docs.append(d)
            new_parts.append(cursor.weight * ((1_000_000_000 * count) // (1000 * count + norms[d])))
            pending += len(d)
            if cursor.next < len(cursor.firsts):
                heapq.heapreplace(heap, (cursor.firsts[cursor.next], heap[0][1]))
            else:
                heapq.heappop(heap)
        docs, parts = np.concatenate(new_docs), np.concatenate(new_parts)
        done = docs < heap[0][0] if heap else np.ones(len(docs), dtype=bool)
        ready, scores = docs[done], parts[done]
        docs, parts = docs[~done], parts[~done]
        if len(ready):
            order = np.argsort(ready, kind="stable")
            ready, scores = ready[order], scores[order]
            first = np.flatnonzero(np.concatenate([[True], ready[1:] != ready[:-1]]))
            yield ready[first], np.add.reduceat(scores, first)


def offer(heap: list[tuple[int, int]], ids: np.ndarray, scores: np.ndarray, most: int) -> None:
    """Put documents into a heap of at most `most` (score, -doc_id), the worst on top."""
    good = scores > 0
    if len(heap) == most:
        good &= scores >= heap[0][0]
    at = np.flatnonzero(good)
    if len(at) > most:
        at = at[np.lexsort((ids[at], -scores[at]))[:most]]
    for score, doc in zip(scores[at].tolist(), ids[at].tolist(), strict=True):
        if len(heap) < most:
            heapq.heappush(heap, (score, -doc))
        else:
            heapq.heappushpop(heap, (score, -doc))


class _Shard:
    """The documents of a shard while they are gathered."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.hashes, self.docs, self.counts, self.terms = [], [], [], {}
        self.postings = 0

    def add(self, ids: list, chunk: kernels.Chunk) -> None:
        w = kernels.words(chunk, kernels.ALNUM, lower=True)
        lengths = np.diff(w.rows)
        hashes, first, inverse = np.unique(kernels.word_hashes(chunk, w, lower=True), return_index=True, return_inverse=True)
        keys, counts = np.unique(inverse * len(lengths) + np.repeat(np.arange(len(lengths)), lengths), return_counts=True)
        self.hashes.append(hashes[keys // len(lengths)])
        self.docs.append(keys % len(lengths) + len(self.ids))
        self.counts.append(counts)
        for h, a, b in zip(hashes.tolist(), w.starts[first].tolist(), w.ends[first].tolist(), strict=True):
            if h not in self.terms:
                self.terms[h] = kernels.LOWER[chunk.data[a:b]].tobytes().decode()
        self.ids += ids
        self.lengths += lengths.tolist()
        self.postings += len(keys)

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.postings >= SHARD_POSTINGS

    def rows(self, name: str) -> Iterator[pa.RecordBatch]:
        ids, lengths = np.array([NO_ID if i is None else i for i in self.ids], dtype=np.int64), np.array(self.lengths, dtype=np.int64)
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        hashes, docs, counts = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (self.hashes, self.docs, self.counts))
        docs = place[docs]
        by = np.lexsort((docs, hashes))
        hashes, docs, counts = hashes[by], docs[by], counts[by]
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, dtype=np.int64)
        sizes = np.diff(first, append=len(hashes))
        totals = np.add.reduceat(counts, first) if len(first) else first
        head = ids[order].astype("<i8").tobytes() + lengths[order].astype("<i8").tobytes()
        words = map(self.terms.__getitem__, hashes[first].tolist())
        made = [(None, int((lengths > 0).sum()), int(lengths.sum()), head)]
        made += sorted(zip(words, sizes.tolist(), totals.tolist(), pack_all(sizes, docs, counts), strict=True))
        names = [f.split()[0] for f in INDEX.split(", ")]
        for i in range(0, len(made), 10_000):
            term, n, total, data = zip(*made[i : i + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(term)), pa.array(term, pa.string()), pa.array(n, pa.int64()), pa.array(total, pa.int64()), pa.array(data, pa.binary())], names)


def index_documents(docs: DataFrame) -> DataFrame:
    """The index of `docs` (doc_id, text): for each shard a row of documents and a row for each term. Write it to search it often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, shard = TaskContext.get().partitionId(), 0, _Shard()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for chunk in kernels.chunks(batch.column("text")):
                shard.add(ids[chunk.first : chunk.last], chunk)
                if shard.full():
                    yield from shard.rows(f"{task}-{made}")
                    made, shard = made + 1, _Shard()
        if shard.ids:
            yield from shard.rows(f"{task}-{made}")

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, INDEX)


@dataclass
class Items:
    """A block of items: the terms of each with how often it asks for them, and the weights of all terms."""

    terms: list[dict[str, int]]
    weights: dict[str, int]


def _merged(shards: DataFrame, items: Items, top: int) -> DataFrame:
    """item (its place in the block), doc_id and score of each task's best documents. `shards`: rows grouped by shard."""
    shared = shards.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        heaps: list[list[tuple[int, int]]] = [[] for _ in own.terms]

        def search(rows: dict[str | None, bytes], scale: tuple[int, int]) -> None:
            head = np.frombuffer(rows.pop(None), dtype="<i8")
            ids, lengths = head[: len(head) // 2], head[len(head) // 2 :]
            norms = 12 * (100 - 25 + (25 * lengths * scale[0]) // scale[1])
            for heap, terms in zip(heaps, own.terms, strict=True):
                cursors = [Cursor(rows[t], times * own.weights[t]) for t, times in terms.items() if t in rows and own.weights[t] > 0]
                for places, scores in complete_documents(cursors, norms):
                    offer(heap, ids[places], scores, top)

        name, rows, scale = None, {}, (0, 1)
        for batch in batches:
            for shard, term, data, n, total in zip(*(batch.column(c).to_pylist() for c in ("shard", "term", "data", "all_docs", "all_terms")), strict=True):
                if shard != name and rows:
                    search(rows, scale)
                    rows = {}
                name, rows[term], scale = shard, data, (n, total)
        if rows:
            search(rows, scale)
        found = [(i, None if -d == NO_ID else -d, s) for i, heap in enumerate(heaps) for s, d in heap]
        if found:
            at, doc, score = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    return shards.mapInArrow(run, "item long, doc_id long, score long")


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, text (the distinct rows) and terms: an array in the order of the text."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return items.select("item_id", "text").distinct().withColumn("terms", F.coalesce(F.regexp_extract_all(lower, F.lit(TERM), 0), F.array().cast("array<string>")))


def search_index(index: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of each item's `top` best documents of a written `index`; `items` has item_id and text."""
    spark = index.sparkSession
    id_type = items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item_id", id_type), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    out = []
    heads = index.filter(F.col("term").isNull())
    n_docs, n_terms = heads.agg(F.sum("n"), F.sum("total")).first()
    asked = staged(item_terms(items).filter(F.size("terms") > 0), "items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0]
    if not n_terms or not total:
        return spark.createDataFrame([], schema)
    blocks = 1 + total // BLOCK_TERMS
    for b in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        terms = block.select(F.explode("terms").alias("term")).distinct()
        # Terms of the items alone travel: a bounded set, joined by its measured size.
        postings = staged(index.join(terms, "term", "left_semi").select(index.columns), "postings")
        weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.sum("n") + 1)))
        weights = dict(postings.groupBy("term").agg(weight.alias("w")).collect())  # at most BLOCK_TERMS
        rows = block.orderBy("item_id", "text").collect()
        asked_for = [{t: r.terms.count(t) for t in dict.fromkeys(r.terms) if t in weights} for r in rows]
        # Doc rows only go where a posting is.
        whole = postings.unionByName(heads.join(postings.select("shard").distinct(), "shard", "left_semi").select(index.columns))
        dealt = whole.select("shard", "term", "data", F.lit(n_docs).cast("long").alias("all_docs"), F.lit(n_terms).cast("long").alias("all_terms"))
        best = _merged(dealt.repartition("shard").sortWithinPartitions("shard", "term"), Items(asked_for, weights), top)
        ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", id_type)]))
        ranks = best.selectExpr("*", "row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank").filter(F.col("rank") <= top)
        found = ranks.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        out.append(staged(found, "ranked") if blocks > 1 else found)
    return reduce(DataFrame.union, out).to(schema)


def search_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Index `docs` and search the index for all `items`."""
    return search_index(staged(index_documents(docs), "index"), items, top)
