"""Language identification in two steps: the family, then the language within it.

A text becomes the square roots of the shares of its 2- and 3-byte runs of letters, hashed to DIMENSIONS places. Linear
support vector machines, one for each pair of families, vote on the family; within it, one for each pair of its
languages votes on the language. Ties go to the larger sum of margins, then to the name. The score is a logistic of the
least margin of the winner in either step.

It learns from about MAX_ROWS documents, dealt evenly over all languages, and from LEAST_ROWS of each at least: those of
the smallest hashes of doc_id and text. A language outside FAMILIES is a family of its own; if there are more than GROUP of
them, they form families of up to GROUP, each of a language and those whose mean vectors are nearest to its own. So the
number of machines grows with (languages / GROUP) squared and with GROUP x languages. More than LOCAL machines are
trained in tasks, come back as their weights that aren't 0, and may have MODEL_BYTES in all (an error beyond, before
they are collected or sent to anyone).

Edge cases: a text that is null or has no letter is `und` with score 0. Rows without doc_id or lang aren't learnt from.
With one known language it is the prediction for all other texts, at score 1; with none, all are `und`. Texts are taken
whole. Other columns are ignored; repeated rows give repeated results, empty tables empty ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galeframe.llm import kernels
from galeframe.llm.staging import staged

DIMENSIONS, MAX_ROWS, LEAST_ROWS = 4096, 6000, 20
GROUP, LOCAL, MODEL_BYTES = 16, 64, 256 << 20
UNKNOWN = "und"
#: The family of each language.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "be", "bg", "pl", "cs", "sk", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
#: a-z and all non-ASCII bytes as they are, A-Z as a-z, everything else a space.
LETTERS = np.where(np.isin(kernels.LOWER, np.r_[97:123, 128:256]), kernels.LOWER, 32).astype(np.uint8)
ROWS_TOGETHER = 512


def vectors(chunk: kernels.Chunk) -> np.ndarray:
    """A row for each text: square roots of the shares of its runs (all 0 without letters)."""
    n = len(chunk.bounds) - 1
    out = np.zeros((n, DIMENSIONS), dtype=np.float32)
    x = LETTERS[chunk.data].astype(np.uint32)
    if len(x) < 3:
        return out
    two = x[:-1] * np.uint32(0x9E3779B1) + x[1:] * np.uint32(0x85EBCA6B)
    three = (two[:-1] ^ (x[2:] * np.uint32(0xC2B2AE35))) * np.uint32(0x27D4EB2F)
    places = [((g >> np.uint32(7)) ^ (g >> np.uint32(19))) & np.uint32(DIMENSIONS - 1) for g in (two * np.uint32(0x165667B1), three)]
    kept = [(x[:-1] != 32) | (x[1:] != 32), (x[1:-1] != 32)]
    for r, (a, b) in enumerate(zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist(), strict=True)):
        for size, (place, keep) in enumerate(zip(places, kept, strict=True), start=2):
            if b - a >= size:
                run = slice(a, b - size + 1)
                out[r] += np.bincount(place[run][keep[run]], minlength=DIMENSIONS)
    return np.sqrt(out / np.maximum(out.sum(axis=1, keepdims=True), 1))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def svm(x: np.ndarray, y: np.ndarray, steps: int = 120, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights of the squared hinge loss with an L2 penalty; y is 1 or -1, and both classes weigh alike."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], dtype=np.float32), 0.0
    u, c, t, rate = w, b, 1.0, np.float32(1.0 / (4.0 + penalty))
    for _ in range(steps):
        gap = np.maximum(0, 1 - y * (x @ u + np.float32(c))) * y * share * np.float32(2)
        nw, nb = u + rate * (gap @ x - np.float32(penalty) * u), c + float(rate) * float(gap.sum())
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = (t - 1) / nt
        u, c = nw + np.float32(ahead) * (nw - w), nb + ahead * (nb - b)
        w, b, t = nw, nb, nt
    return w, b


@dataclass
class Rows:
    """Training vectors, their places and values one after another."""

    starts: np.ndarray
    places: np.ndarray
    values: np.ndarray

    @staticmethod
    def of(places: list[np.ndarray], values: list[np.ndarray]) -> Rows:
        starts = np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int64)
        none = np.empty(0, dtype=np.int32)
        return Rows(starts, np.concatenate([none, *places]), np.concatenate([none.astype(np.float32), *values]))

    def dense(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), DIMENSIONS), dtype=np.float32)
        for i, r in enumerate(rows.tolist()):
            a, b = self.starts[r], self.starts[r + 1]
            out[i, self.places[a:b]] = self.values[a:b]
        return out


#: The rows of two classes, 1 and -1; and the weights and offset of the machine between them.
Job = tuple[np.ndarray, np.ndarray]
Machine = tuple[np.ndarray, float]


def trained_here(x: Rows, jobs: list[Job]) -> list[Machine]:
    return [svm(x.dense(rows), y) for rows, y in jobs]


def trained_in_tasks(spark: SparkSession, x: Rows, jobs: list[Job]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Places and values of the weights that aren't 0, and the offset, of each job's machine."""
    shared = spark.sparkContext.broadcast(x)  # a bounded number of rows for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, rows, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                w, b = svm(shared.value.dense(np.array(rows)), np.array(y, dtype=np.float32))
                at = np.flatnonzero(w).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"i": [i], "places": [at], "values": [w[at]], "offset": pa.array([b], pa.float64())})

    table = pa.table({"i": pa.array(range(len(jobs)), pa.int64()), "rows": pa.array([r for r, _ in jobs], pa.list_(pa.int64())), "y": pa.array([y for _, y in jobs], pa.list_(pa.float32()))})
    parts = max(spark.sparkContext.defaultParallelism, len(jobs) // 100)
    found = staged(spark.createDataFrame(table).repartition(parts).mapInArrow(run, "i long, places array<int>, values array<float>, offset double"), "language-machines")
    size = 8 * (found.agg(F.sum(F.size("places"))).first()[0] or 0)
    if size > MODEL_BYTES:
        raise ValueError(f"{len(jobs)} machines between languages have {size} bytes of weights, more than MODEL_BYTES")
    got = found.toArrow().sort_by("i")
    return [(p.values.to_numpy(), v.values.to_numpy(), o.as_py()) for p, v, o in zip(got["places"], got["values"], got["offset"], strict=True)]


@dataclass
class Duel:
    """Pairwise machines between some classes: a matrix of weights, or for many machines the weights that aren't 0."""

    names: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None
    offsets: np.ndarray | None = None
    sparse: list[tuple[np.ndarray, np.ndarray]] | None = None

    @staticmethod
    def of(names: list[str], pairs: list[tuple[int, int]], machines: list) -> Duel:
        if not pairs:
            return Duel(names)
        offsets = np.array([m[-1] for m in machines], dtype=np.float32)
        if len(machines[0]) == 2:
            return Duel(names, pairs, np.stack([w for w, _ in machines], axis=1), offsets)
        return Duel(names, pairs, None, offsets, [m[:2] for m in machines])

    def margins(self, x: np.ndarray) -> np.ndarray:
        if self.sparse is None:
            return x @ self.weights + self.offsets
        return np.stack([x[:, p] @ v for p, v in self.sparse], axis=1) + self.offsets

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The winner of each row, and its least margin."""
        if not self.pairs:
            return np.zeros(len(x), dtype=np.int64), np.full(len(x), np.inf)
        margins = self.margins(x)
        votes, sums = np.zeros((len(x), len(self.names))), np.zeros((len(x), len(self.names)))
        least = np.full((len(x), len(self.names)), np.inf)
        for k, (a, b) in enumerate(self.pairs):
            for side, m in ((a, margins[:, k]), (b, -margins[:, k])):
                votes[:, side] += m > 0
                sums[:, side] += np.tanh(m)
                least[:, side] = np.minimum(least[:, side], m)
        best = np.argmax(votes * (4.0 * len(self.names)) + sums, axis=1)
        return best, least[np.arange(len(x)), best]


def families_of(x: Rows, langs: np.ndarray) -> np.ndarray:
    """The family of each row's language."""
    odd = sorted({lang for lang in langs.tolist() if lang not in FAMILY_OF})
    of = FAMILY_OF | {lang: f"only {lang}" for lang in odd}
    if len(odd) > GROUP:
        means = np.zeros((len(odd), DIMENSIONS), dtype=np.float32)
        for k, lang in enumerate(odd):
            for r in np.flatnonzero(langs == lang).tolist():
                a, b = x.starts[r], x.starts[r + 1]
                means[k, x.places[a:b]] += x.values[a:b]
        means /= np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)
        left = list(range(len(odd)))
        while left:
            near = np.argsort(-(means[left] @ means[left[0]]), kind="stable")[: GROUP - 1].tolist()
            mine = {left[0], *(left[k] for k in near)}
            of |= {odd[k]: f"about {odd[left[0]]}" for k in mine}
            left = [k for k in left if k not in mine]
    return np.array([of[lang] for lang in langs.tolist()])


@dataclass
class LanguageModel:
    families: Duel | None
    within: dict[str, Duel]

    @staticmethod
    def fit(x: Rows, langs: np.ndarray, many: Callable[[Rows, list[Job]], list]) -> LanguageModel:
        """`many` trains more than LOCAL machines."""
        if not len(langs):
            return LanguageModel(None, {})
        family = families_of(x, langs)
        plans = [("", np.arange(len(langs)), family)] + [(f, own := np.flatnonzero(family == f), langs[own]) for f in sorted(set(family.tolist()))]
        jobs, classes = [], []
        for _, rows, labels in plans:
            names = sorted(set(labels.tolist()))
            pairs = list(combinations(range(len(names)), 2))
            for a, b in pairs:
                at = np.flatnonzero((labels == names[a]) | (labels == names[b]))
                jobs.append((rows[at], np.where(labels[at] == names[a], 1.0, -1.0).astype(np.float32)))
            classes.append((names, pairs))
        machines = iter(trained_here(x, jobs) if len(jobs) <= LOCAL else many(x, jobs))
        duels = [Duel.of(names, pairs, [next(machines) for _ in pairs]) for names, pairs in classes]
        return LanguageModel(duels[0], {f: d for (f, *_), d in zip(plans[1:], duels[1:], strict=True)})

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        if self.families is None:
            return [UNKNOWN] * len(x), np.zeros(len(x))
        winner, margin = self.families.decide(x)
        names, score = np.empty(len(x), dtype=object), np.empty(len(x))
        for f, family in enumerate(self.families.names):
            rows = np.flatnonzero(winner == f)
            if len(rows):
                own = self.within[family]
                best, inner = own.decide(x[rows])
                names[rows] = [own.names[b] for b in best.tolist()]
                score[rows] = 1 / (1 + np.exp(-4 * np.minimum(margin[rows], inner)))
        return names.tolist(), score


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, most: int = MAX_ROWS) -> DataFrame:
    """doc_id, text and lang of about `most` documents, evenly over the languages; equal rows count once."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    counts = known.groupBy("lang").count().orderBy("lang").collect()  # a row for each language
    each = max(LEAST_ROWS, most // max(1, len(counts)))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    shares = docs.sparkSession.createDataFrame([(r["lang"], int((1 << 40) * min(1.0, each / r["count"]))) for r in counts], "lang string, upto long")
    chosen = known.join(F.broadcast(shares), "lang").filter(place < F.col("upto"))
    return chosen.select("doc_id", "text", "lang").dropDuplicates()


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in kernels.chunks(batch.column("text"), rows=ROWS_TOGETHER):
            x = vectors(chunk)
            part = lambda c, k=chunk, b=batch: b.column(c).slice(k.first, k.last - k.first)
            rows = [np.flatnonzero(v) for v in x]
            columns = [pa.array(rows, pa.list_(pa.int32())), pa.array([v[r] for v, r in zip(x, rows, strict=True)], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays([part("doc_id"), part("lang"), *columns], ["doc_id", "lang", "places", "values"])


def fit_languages(docs: DataFrame, most: int = MAX_ROWS) -> LanguageModel:
    rows = training_rows(docs.select("doc_id", "text", "lang"), most)
    kind = docs.schema["doc_id"].dataType.simpleString()
    got = rows.mapInArrow(_vectors, f"doc_id {kind}, lang string, places array<int>, values array<float>").toArrow().sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    places, values = ([c.values.to_numpy() for c in got[n]] for n in ("places", "values"))
    some = np.array([len(p) > 0 for p in places], dtype=bool)
    langs = np.array(got["lang"].to_pylist(), dtype=object)[some]
    x = Rows.of([p for p, s in zip(places, some, strict=True) if s], [v for v, s in zip(values, some, strict=True) if s])
    return LanguageModel.fit(x, langs, lambda x, jobs: trained_in_tasks(docs.sparkSession, x, jobs))


def identify_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most LOCAL machines of DIMENSIONS weights, or MODEL_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for chunk in kernels.chunks(batch.column("text"), rows=ROWS_TOGETHER):
                n = chunk.last - chunk.first
                names, score = own.predict(vectors(chunk))
                plain = np.isin(chunk.data, np.r_[65:91, 97:123])
                sums = np.concatenate([[0], np.cumsum(plain)])
                ascii_letters = sums[chunk.bounds[1:]] - sums[chunk.bounds[:-1]]
                for r in np.flatnonzero(ascii_letters == 0).tolist():
                    if not has_letter(batch.column("text")[chunk.first + r].as_py()):
                        names[r], score[r] = UNKNOWN, 0.0
                part = lambda c, k=chunk, b=batch, n=n: b.column(c).slice(k.first, n)
                yield pa.RecordBatch.from_arrays([part("doc_id"), part("held_out"), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
