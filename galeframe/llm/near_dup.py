"""Near-duplicate documents by circulant MinHash.

A document's set holds its distinct 5-word shingles, as 64-bit hashes. One permutation scatters the hashes over a
circle of 2**20 places; a second one, read at K successive shifts, gives all K signature coordinates. Bands of ROWS
coordinates put documents into buckets. Documents with equal sets are one node from the start, known by a hash of the set.

Candidates of a bucket are first compared with its smallest member only. What these links join is one component. In
buckets that still hold several components, members of different ones are compared in numpy, in blocks of about BLOCK
members however large the bucket is: a pair in the first bucket that it shares, by size, by signature (LEAST_SHARE of
the coordinates) and by sets of 32-bit hashes, which never count less in common than there is. Only what passes comes
out, so each two members of a bucket are compared or already joined, and no pairs of a group are listed. Every link is
confirmed on the full sets. At similarity 0.75 a pair misses all bands with probability 5e-6, and LEAST_SHARE with 5e-6.

Edge cases: a null or empty text, or one of white space, has an empty set and links with nothing. A row without doc_id
is kept, links with nothing and has a null component. Repeated rows are one node and share their fate; rows of one doc_id
with different texts are judged each by its text. Equal sets and ties resolve to the smallest doc_id. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galeframe.llm import kernels
from galeframe.llm.components import components
from galeframe.llm.staging import staged

SHINGLE, SIMILAR = 5, 75
PLACES, K, ROWS = 1 << 20, 128, 4
LEAST_SHARE, BLOCK = 0.58, 1024
STEP = 1 << 15
_SCATTER, _KEY = (np.uint64(x) for x in np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 2))
_circle: list[np.ndarray] = []


def circle() -> np.ndarray:
    """Row i: the second permutation at the K places from i on."""
    if not _circle:
        p = np.random.Generator(np.random.PCG64(11)).permutation(PLACES).astype(np.int32)
        _circle.append(np.lib.stride_tricks.sliding_window_view(np.concatenate([p, p[: K - 1]]), K))
    return _circle[0]


def shingles(chunk: kernels.Chunk) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a chunk."""
    w = kernels.words(chunk, kernels.NOT_SPACE, lower=True)
    hashes = kernels.word_hashes(chunk, w, lower=True)
    grams = kernels.ngram_hashes(hashes, SHINGLE)
    out = []
    for a, b in zip(w.rows[:-1].tolist(), w.rows[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(kernels.mix(kernels.ngram_hashes(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def signatures(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The K least values of each set; `starts`: where each (not empty) set begins in `flat`."""
    rows = circle()
    places = (kernels.mix(flat ^ _SCATTER) >> np.uint64(44)).astype(np.int64)
    out = np.full((len(starts), K), PLACES, dtype=np.int32)
    for a in range(0, len(flat), STEP):
        first = int(np.searchsorted(starts, a, side="right")) - 1
        last = int(np.searchsorted(starts, a + STEP, side="left"))
        cuts = np.maximum(starts[first:last] - a, 0)
        least = np.minimum.reduceat(rows[places[a : a + STEP]], cuts, axis=0)
        np.minimum(out[first:last], least, out=out[first:last])
    return out


def buckets(signature: np.ndarray) -> np.ndarray:
    bands = signature.reshape(len(signature), K // ROWS, ROWS).astype(np.uint64)
    sums = (bands * kernels.PLACE[:ROWS]).sum(axis=2, dtype=np.uint64)
    return kernels.mix(kernels.mix(sums) + np.arange(K // ROWS, dtype=np.uint64))


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(kernels.as_long(values)))


def _binary(values: np.ndarray) -> pa.Array:
    """Each row of a matrix as bytes."""
    data, size = np.ascontiguousarray(values), values.shape[1] * values.itemsize
    return pa.Array.from_buffers(pa.binary(size), len(data), [None, pa.py_buffer(data.tobytes())]).cast(pa.binary())


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in kernels.chunks(batch.column("text")):
            sets = shingles(chunk)
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            nodes, bands = np.zeros(len(sets), dtype=np.uint64), np.empty(0, dtype=np.uint64)
            signature = np.zeros((len(sets), K), dtype=np.int32)
            if len(full):
                flat = np.concatenate(sets)
                starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                nodes[full] = np.add.reduceat(kernels.mix(flat ^ _KEY), starts)
                signature[full] = signatures(flat, starts)
                bands = buckets(signature[full]).ravel()
            ids = (batch.column(c).slice(chunk.first, chunk.last - chunk.first) for c in ("doc_id", "text_hash"))
            columns = [*ids, pa.array(sizes, pa.int64()), pa.array(kernels.as_long(nodes)), _lists((sizes > 0) * (K // ROWS), bands), _binary(signature)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "node", "bands", "signature"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in kernels.chunks(batch.column("text")):
            sets = shingles(chunk)
            ids = batch.column("node").slice(chunk.first, chunk.last - chunk.first)
            short = [np.sort((s >> np.uint64(32)).astype(np.uint32)).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([ids, _lists(np.array([len(s) for s in sets]), np.concatenate(sets)), pa.array(short, pa.binary())], ["node", "shingles", "short"])


def _confirmed(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of `pairs` (a, b) whose full sets are similar enough."""
    one = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")).hint("merge"), "b")
    two = one.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")).hint("merge"), "a")
    sizes = two.select("a", "b", (F.size("sa") + F.size("sb")).alias("n"), F.size(F.array_intersect("sa", "sb")).alias("both"))
    return sizes.filter(100 * F.col("both") >= SIMILAR * (F.col("n") - F.col("both"))).select("a", "b")


def in_common(a: np.ndarray, b: np.ndarray) -> int:
    """At least how many values two sorted sets share (more if hashes collide)."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def linkable(band: int, nodes: np.ndarray, components: np.ndarray, sizes: np.ndarray, sides: np.ndarray, signature: np.ndarray, short: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of different components in a bucket of some band that may be linked; of two sides, only pairs across them."""
    out = []
    two = sides.min() != sides.max()
    for i in range(len(nodes) - 1):
        may = (components[i + 1 :] != components[i]) & (100 * np.minimum(sizes[i + 1 :], sizes[i]) >= SIMILAR * np.maximum(sizes[i + 1 :], sizes[i]))
        if two:
            may &= sides[i + 1 :] != sides[i]
        j = np.flatnonzero(may) + i + 1
        if not len(j):
            continue
        same = signature[j] == signature[i]
        fit = same.sum(axis=1) >= LEAST_SHARE * K
        if band:
            fit &= ~same[:, : band * ROWS].reshape(len(j), band, ROWS).all(axis=2).any(axis=1)
        for k in j[fit].tolist():
            both = in_common(short[i], short[k])
            if 100 * (both + 2) >= SIMILAR * (sizes[i] + sizes[k] - both - 2):  # 2: for hashes that fall together within a set
                out.append((int(min(nodes[i], nodes[k])), int(max(nodes[i], nodes[k]))))
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by bucket and pair of blocks: `linkable` of each group, which is of about two blocks at most."""
    rest: pa.Table | None = None

    def pairs(group: pa.Table) -> pa.RecordBatch:
        signature = np.frombuffer(b"".join(group["signature"].to_pylist()), dtype=np.int32).reshape(-1, K)
        short = [np.frombuffer(x, dtype=np.uint32) for x in group["short"].to_pylist()]
        found = linkable(group["band"][0].as_py(), *(group[c].to_numpy() for c in ("node", "component", "n_shingles", "side")), signature, short)
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        keys = np.stack([table[c].to_numpy() for c in ("bucket", "low", "high")])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield pairs(table.slice(a, b - a))
        rest = table.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield pairs(rest)


def _across(members: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of `members` (bucket, band, node, n_shingles, component) that may link two components."""
    mixed = members.groupBy("bucket").agg(F.count("*").alias("m"), F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most")
    found = members.join(mixed.select("bucket", F.ceil(F.col("m") / BLOCK).alias("blocks")).hint("merge"), "bucket")
    found = found.join(nodes.select("node", "signature").hint("merge"), "node").join(sets.select("node", "short").hint("merge"), "node")
    found = found.withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    found = found.select("bucket", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "band", "node", "component", "n_shingles", "signature", "short")
    dealt = found.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return dealt.mapInArrow(_compare, "a long, b long").distinct()


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def _judged(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component (a node) and component_id of each row; the last two are null for rows that link with nothing."""
    docs = _hashed(docs)
    rows = staged(docs.mapInArrow(_sign, "doc_id long, text_hash long, n_shingles long, node long, bands array<long>, signature binary"), "minhash-rows")
    usable = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = staged(usable.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")).select("node", "first.*"), "minhash-classes")
    nodes = usable.join(classes.hint("merge"), ["node", "doc_id", "text_hash"]).select("node", "n_shingles", "bands", "signature")
    nodes = staged(nodes.dropDuplicates(["node"]), "minhash-nodes")
    banded = nodes.select("node", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("lead"), F.max("node").alias("last")).filter("lead < last").drop("last")
    members = staged(banded.join(shared.hint("merge"), "bucket").distinct(), "minhash-members")
    needed = classes.join(members.select("node").distinct(), "node")
    texts = docs.join(needed.hint("shuffle_hash"), ["doc_id", "text_hash"]).select("node", "text")
    sets = staged(texts.mapInArrow(_sets, "node long, shingles array<long>, short binary"), "minhash-sets")

    stars = members.filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    links = staged(_confirmed(sets, stars), "minhash-links")
    joined = components(links)
    placed = members.join(joined, "node", "left").select("bucket", "band", "node", "n_shingles", F.coalesce("component", "node").alias("component"))
    again = staged(_across(staged(placed, "minhash-placed"), nodes, sets), "minhash-across")
    more = staged(_confirmed(sets, again), "minhash-links")
    if more.take(1):
        joined = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    placed = staged(classes.join(joined, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component")), "minhash-placed")
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = placed.join(least, "component").select("node", "component", "component_id")
    linked = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("node"))
    return rows.select("doc_id", "text_hash", "n_shingles", linked.alias("node")).join(by_node, "node", "left").drop("node")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of `docs`."""
    out = _judged(docs).select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each component of `docs`, of its least doc_id, with all columns, and all rows that link with nothing.

    Of rows with the same doc_id and text, one stays; rows of one doc_id with different texts go only as what they are. A row
    of null doc_id stays as it is.
    """
    judged = _judged(docs).filter("doc_id IS NOT NULL")
    first = judged.filter("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")).select("first.*")
    kept = staged(first.union(judged.filter("component IS NULL").select("doc_id", "text_hash")).distinct(), "minhash-kept")
    here = (F.col("doc_id").cast("long") == F.col("kept_id")) & (F.xxhash64("text") == F.col("kept_hash"))
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    out = docs.join(kept, here, "left_semi")
    if docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").limit(1).take(1):
        out = out.dropDuplicates(["doc_id", "text"])
    return out.union(docs.filter("doc_id IS NULL"))
