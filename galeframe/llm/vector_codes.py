"""Vector code compression: product quantisation whose nearest-entry searches run on kd-trees.

Vectors become integers (`floor(scale * x)`), cut into equal consecutive parts, each with a codebook of its own. A round
broadcasts one kd-tree for each codebook (their size is a parameter: parts x entries x part length), assigns every part
to its nearest entry, and adds up integer sums and counts in each task before one small shuffle; the new entries are
floors of integer quotients, so results don't depend on partitions or retries. The integer vectors are staged once, so
that every round reads the same rows and lost tasks reread a file.

Search: a node is visited if its box is no farther than the best entry so far. Equal bounds are visited too, so among
equally near entries the one of the lowest index always wins. Whole batches go down the tree at once.

Edge cases: rows whose vector is null, or holds a null or non-finite component, are dropped. Of the others, the vector
length is that of the smallest vec_id whose length is a positive multiple of `parts`; rows of other lengths can't be cut
and are dropped too. Rows of one vec_id are coded each, and ordered by their integers where a codebook begins; a null
vec_id comes last there. With fewer rows than entries, codebooks are shorter; unused and equal entries stay. Components
beyond +-LARGEST after scaling are an error, as their squares don't fit 64 bits. Other columns are ignored. An empty
table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galeframe.llm.staging import staged

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LEAF, LARGEST = 4, 1 << 26
#: Vectors that go down a tree together.
TOGETHER = 8192


@dataclass
class Node:
    """Entries `rows` of a codebook within a box; inner nodes have two children."""

    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray
    children: tuple[Node, Node] | None = None


class Tree:
    """A kd-tree of integer entries: split at the median of the widest side, by index within equals."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries.astype(np.int64)
        self.root = self._node(np.arange(len(entries)))

    def _node(self, rows: np.ndarray) -> Node:
        own = self.entries[rows]
        low, high = own.min(axis=0), own.max(axis=0)
        node = Node(low, high, rows)
        side = int((high - low).argmax())
        if len(rows) > LEAF and high[side] > low[side]:
            order = rows[np.argsort(own[:, side], kind="stable")]
            middle = len(order) // 2
            node.children = (self._node(np.sort(order[:middle])), self._node(np.sort(order[middle:])))
        return node

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each point; ties go to the lower index."""
        best = np.full(len(points), np.iinfo(np.int64).max)
        index = np.full(len(points), len(self.entries))
        self._visit(self.root, points, np.arange(len(points)), best, index)
        return index, best

    @staticmethod
    def _bound(node: Node, points: np.ndarray) -> np.ndarray:
        """The squared distance of each point from the node's box."""
        away = np.maximum(np.maximum(node.low - points, points - node.high), 0)
        return (away * away).sum(axis=1)

    def _visit(self, node: Node, points: np.ndarray, at: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        if not len(at):
            return
        if node.children is None:
            for row in node.rows.tolist():
                away = points[at] - self.entries[row]
                far = (away * away).sum(axis=1)
                won = (far < best[at]) | ((far == best[at]) & (row < index[at]))
                best[at[won]], index[at[won]] = far[won], row
            return
        bounds = [self._bound(child, points[at]) for child in node.children]
        right_first = bounds[1] < bounds[0]
        for first, second in ((0, 1), (1, 0)):
            mine = right_first if first else ~right_first
            self._visit(node.children[first], points, at[mine], best, index)
            rest = at[mine]
            self._visit(node.children[second], points, rest[bounds[second][mine] <= best[rest]], best, index)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def integer_vectors(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """vec_id, label and v (an array of long) of the rows that are kept."""
    v = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    fits = F.forall(vector, lambda x: F.abs(x.cast("double") * scale) <= LARGEST)
    rows = vectors.filter(F.col(vector).isNotNull() & finite & (F.size(vector) > 0) & (F.size(vector) % parts == 0))
    checked = F.when(fits, v).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST} / {scale}")).cast("array<bigint>"))
    return rows.select(F.col(id_column).alias("vec_id"), F.col(label).alias("label"), checked.alias("v"))


def _coded(rows: DataFrame, trees: list[Tree], sums: bool) -> DataFrame:
    """vec_id, label, code and error of each row; or, with `sums`, part, entry, n and total of each task."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)
    n, wide = len(trees), trees[0].entries.shape[1]

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(start, TOGETHER)
                points = _matrix(part.column("v")).reshape(part.num_rows, n, wide)
                found = [tree.nearest(points[:, p]) for p, tree in enumerate(shared.value)]
                yield part, points, np.stack([i for i, _ in found], axis=1), np.stack([e for _, e in found], axis=1)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, index, error in assigned(batches):
            code = ["".join(f"{i:02x}" for i in row) for row in index.tolist()]
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array(code, pa.string()), pa.array(error.sum(axis=1))], ["vec_id", "label", "code", "error"])

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(len(t.entries) for t in shared.value)
        count, total = np.zeros((n, most), dtype=np.int64), np.zeros((n, most, wide), dtype=np.int64)
        for _, points, index, _ in assigned(batches):
            for p in range(n):
                count[p] += np.bincount(index[:, p], minlength=most)
                np.add.at(total[p], index[:, p], points[:, p])
        p, e = np.nonzero(count)
        if len(p):
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(count[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])

    if sums:
        return rows.select("v").mapInArrow(totals, "part long, entry long, n long, total array<long>")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(codes, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def fit_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """One array of entries for each part, fitted on `rows` (vec_id, v: vectors of one length); [] without rows."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").toArrow()
    if not first.num_rows:
        return []
    books = list(np.moveaxis(_matrix(first["v"].combine_chunks()).reshape(first.num_rows, parts, -1), 1, 0))
    wide = books[0].shape[1]
    for _ in range(rounds):
        found = _coded(rows, [Tree(b) for b in books], sums=True).groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(wide)))
        books = [b.copy() for b in books]
        for r in found.collect():  # parts x entries rows
            books[r.part][r.entry] = [r[f"t{i}"] // r.n for i in range(wide)]
    return books


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for entry in b.tolist() for x in entry).encode()).hexdigest()


def decode_codes(codes: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """vec_id and embedding: the entries that each code names, joined and scaled back."""
    tables = [F.array(*(F.array(*(F.lit(float(x) / scale) for x in e)) for e in b.tolist())) for b in books]
    picked = [F.get(t, F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")) for p, t in enumerate(tables)]
    return codes.select("vec_id", F.concat(*picked).alias("embedding"))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code and error of each kept row of `vectors`, and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    rows = staged(integer_vectors(vectors, parts=parts, scale=scale), "vectors")
    least = rows.select("vec_id", F.size("v").alias("n"), "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").select("n").first()
    if least is None:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    rows = rows.filter(F.size("v") == least.n)
    books = fit_codebooks(rows, parts, entries, rounds)
    return _coded(rows, [Tree(b) for b in books], sums=False), books


def compression_report(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error (errors added up over equal labels) and codebooks_sha256 of each kept row."""
    coded, books = compress(vectors)
    coded = staged(coded, "codes")
    # Written first, so that its size is known when the join is planned: broadcast if small, else sorted and split where skewed.
    totals = staged(coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    joined = coded.join(totals, coded.label.eqNullSafe(totals.of_label))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
