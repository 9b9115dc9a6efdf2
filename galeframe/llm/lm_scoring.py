"""Language-model scoring by cross-entropy difference.

A target model (documents labelled of good quality) and a background model (all other documents) are bigram models of
the same order, smoothing and vocabulary: every word and every bigram of the whole corpus, without a cut, so what is
counted grows with the corpus. Both models are matched: the background's counts are scaled to the target's number of
words, so smoothing weighs alike in both. A word's loss is the negative logarithm of

    (c(history, word) + HISTORY_WEIGHT * (c(word) + UNIFORM_WEIGHT / V) / (words + UNIFORM_WEIGHT)) / (c(history) + HISTORY_WEIGHT)

with V one more than the number of different words. A document's score is its mean loss a word under the target less
that under the background: the lower, the closer to the target.

Words, bigrams and documents (doc_id with text) stand as 64-bit hashes. Words and bigrams that make up at least
1 / share of all words (so at most `share` of each, MOST_SHARE at the utmost) are counted in tasks, sent to all tasks and
scored where the text is. Of every other bigram of a document an entry is dealt by its word, or by itself if its word is
frequent: the entries that meet there are all that the counts of the word and the bigram are made of, so one shuffle
counts and scores, and another brings the losses of a document together. Entries and losses travel as array columns, a
row for each part of the hashes; a part holds about PART entries, and no key more than 2 / share of all. Labels of up to BROADCAST_ROWS documents are sent to all tasks, more are joined by
a shuffle.

Edge cases: a null or empty text has 0 words and null losses and score. Without target or background documents that
model is uniform. A document with several labels is a target if their mean is a half or more; labels without doc_id or
quality don't count. Rows without doc_id are background. Other columns are ignored; repeated rows count each time and give
repeated results, empty tables empty ones. Texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galeframe.llm import kernels
from galeframe.llm.staging import staged

#: Weight of the unigram behind each history, and of the uniform law behind the unigram, in words.
HISTORY_WEIGHT, UNIFORM_WEIGHT = 50.0, 100.0
#: `share` is a word for so many bytes of text, within these bounds.
SHARE_BYTES, LEAST_SHARE, MOST_SHARE = 1 << 25, 1 << 16, 1 << 20
HELD, PART, BROADCAST_ROWS = 1 << 19, 1 << 21, 1_000_000
#: Rows that are cut into words together: two such runs are numbered by 16 bits.
ROWS_TOGETHER = 1 << 14


def _hashed(texts: pa.Array) -> Iterator[tuple[kernels.Chunk, kernels.Words, np.ndarray]]:
    for chunk in kernels.chunks(texts, rows=ROWS_TOGETHER):
        w = kernels.words(chunk, kernels.NOT_SPACE, lower=True)
        yield chunk, w, kernels.word_hashes(chunk, w, lower=True)


def _added(parts: tuple[np.ndarray, ...], counts: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate(parts), return_inverse=True)
    return keys, np.bincount(back, np.concatenate(counts), minlength=len(keys)).astype(np.int64)


def target_documents(labels: DataFrame) -> DataFrame:
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    return known.groupBy("doc_id").agg(F.avg("quality").alias("q")).filter("q >= 0.5").select("doc_id")


class Tokens(NamedTuple):
    """Each word's hash, that of its bigram, its row in the chunk, and whether it is its row's first or last."""

    words: np.ndarray
    bigrams: np.ndarray
    rows: np.ndarray
    first: np.ndarray
    last: np.ndarray


def tokens(w: kernels.Words, hashes: np.ndarray) -> Tokens:
    n = len(hashes)
    some = w.rows[1:] > w.rows[:-1]
    first, last = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    first[w.rows[:-1][some]] = True
    last[w.rows[1:][some] - 1] = True
    before = np.zeros(n, dtype=np.uint64)
    before[1:] = hashes[:-1]
    before[first] = 0
    bigrams = kernels.mix(before * kernels.PLACE[0] + hashes * kernels.PLACE[1])
    return Tokens(hashes, bigrams, np.repeat(np.arange(len(some)), np.diff(w.rows)), first, last)


def _places(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The index of each key, -1 for those that are not there."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    k = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[k] == keys, k, -1)


class Vocabulary(NamedTuple):
    """How many words there are, and different ones, and the sorted hashes of frequent words and bigrams."""

    total: int
    different: int
    words: np.ndarray
    bigrams: np.ndarray


def vocabulary(docs: DataFrame, share: int) -> Vocabulary:
    """Counts all words; a word is frequent with 1 / `share` of them, a bigram at the latest with 2 / `share`.

    Bigrams are counted in windows of a task's texts, and those with their share of a window go on. One with 2 / `share`
    of all words loses less than half of its count to windows in which it has less.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]
        most, size = (HELD, max(HELD, 4 * share)), 0

        def full(kind: int) -> bool:
            """Whether so many different keys are held; those of several chunks are added up now and then."""
            if sum(len(k) for k, _ in held[kind]) <= most[kind] + HELD:
                return False
            held[kind] = [_added(*zip(*held[kind], strict=True))]
            return len(held[kind][0][0]) > most[kind]

        def out(kind: int, least: int) -> Iterator[pa.RecordBatch]:
            if held[kind]:
                keys, counts = _added(*zip(*held[kind], strict=True))
                some = counts * share >= least
                held[kind] = []
                yield pa.RecordBatch.from_arrays([pa.array(np.full(some.sum(), kind)), pa.array(kernels.as_long(keys[some])), pa.array(counts[some])], ["kind", "key", "n"])

        for batch in batches:
            for _, w, hashes in _hashed(batch.column("text")):
                for kind, keys in enumerate((hashes, tokens(w, hashes).bigrams)):
                    held[kind].append(np.unique(keys, return_counts=True))
                size += len(hashes)
                if full(0):
                    yield from out(0, 0)
                if full(1):
                    yield from out(1, size)
                    size = 0
        yield from out(0, 0)
        yield from out(1, size)

    counts = docs.select("text").mapInArrow(run, "kind long, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    table = staged(counts, "lm-counts")
    different, total = table.filter("kind = 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    top = table.filter(F.col("n") * share >= total).select("kind", "key").toArrow()  # at most `share` of either kind
    kind, keys = top["kind"].to_numpy(), top["key"].to_numpy().view(np.uint64)
    return Vocabulary(total, different, np.sort(keys[kind == 0]), np.sort(keys[kind == 1]))


class Model(NamedTuple):
    """Counts (target, background) of all words and documents and of the frequent words, histories and bigrams."""

    different: int
    words: np.ndarray
    bigrams: np.ndarray
    total: np.ndarray
    starts: np.ndarray
    of_words: np.ndarray
    of_histories: np.ndarray
    of_bigrams: np.ndarray

    def scales(self) -> tuple[float, float]:
        t, b = self.total
        return 1.0, (t / b if t and b else 1.0)

    def joint(self, side: int, bigram: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The loss before a word's history is known to divide by."""
        scale = self.scales()[side]
        law = (word * scale + UNIFORM_WEIGHT / (1 + self.different)) / (self.total[side] * scale + UNIFORM_WEIGHT)
        return -np.log(bigram * scale + HISTORY_WEIGHT * law)

    def history(self, side: int, count: np.ndarray) -> np.ndarray:
        return np.log(count * self.scales()[side] + HISTORY_WEIGHT)


def fitted(marked: DataFrame, v: Vocabulary) -> Model:
    shared = marked.sparkSession.sparkContext.broadcast((v.words, v.bigrams))
    sizes = [1, 1, len(v.words), len(v.words), len(v.bigrams)]
    at = np.cumsum([0, *sizes])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pairs = shared.value
        counts = np.zeros((2, at[-1]), dtype=np.int64)
        for batch in batches:
            chosen = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
            for chunk, w, hashes in _hashed(batch.column("text")):
                x = tokens(w, hashes)
                mine = chosen[chunk.first : chunk.last][x.rows]
                word, pair = _places(known, x.words), _places(pairs, x.bigrams)
                for side, here in enumerate((mine, ~mine)):
                    counts[side, 0] += here.sum()
                    counts[side, 1] += (here & x.first).sum()
                    for i, ids in ((2, word[here]), (3, word[here & ~x.last]), (4, pair[here])):
                        counts[side, at[i] : at[i + 1]] += np.bincount(ids[ids >= 0], minlength=sizes[i])
        cells = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(cells), *map(pa.array, counts[:, cells])], ["cell", "t", "b"])

    found = marked.select("target", "text").mapInArrow(run, "cell long, t long, b long").groupBy("cell").agg(F.sum("t").alias("t"), F.sum("b").alias("b")).toArrow()
    out = np.zeros((2, at[-1]))
    out[:, found["cell"].to_numpy()] = found["t"].to_numpy(), found["b"].to_numpy()
    total, starts, *rest = (out[:, a:b] for a, b in zip(at[:-1], at[1:], strict=True))
    return Model(v.different, v.words, v.bigrams, total[:, 0], starts[:, 0], *rest)


class Entries(NamedTuple):
    """Bigrams of documents: the document, the word (the number of a frequent one, else -1, and the hash of a rare one, else
    0), the bigram, and in one number how often it occurs, whether the document ends with it, and whether it is a target."""

    doc: np.ndarray
    word: np.ndarray
    rare: np.ndarray
    pair: np.ndarray
    meta: np.ndarray

    @staticmethod
    def joined(parts: list[Entries]) -> Entries:
        return Entries(*(np.concatenate(v) for v in zip(*parts, strict=True)))


def _new(*columns: np.ndarray) -> np.ndarray:
    """Which rows differ from the row before."""
    out = np.ones(len(columns[0]), dtype=bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _lists(parts: np.ndarray, **columns: np.ndarray) -> dict[str, pa.Array]:
    """A row for each value of the sorted `parts`, with lists of the other columns."""
    here = np.unique(parts)
    ends = pa.array(np.append(np.searchsorted(parts, here), len(parts)).astype(np.int32))
    return {"part": pa.array(here.astype(np.int32)), **{k: pa.ListArray.from_arrays(ends, pa.array(v)) for k, v in columns.items()}}


def _blocks(e: Entries, parts: int) -> pa.RecordBatch:
    """A row for each part: its documents, and its entries, each once in a document, with the place of their document.

    Of hashes, the lower 48 bits go along; the part is told by the upper ones.
    """
    docs, own = np.unique(e.doc, return_inverse=True)
    group = _part(np.where(e.word < 0, e.rare, e.pair), parts)
    order = np.lexsort((own, e.pair, e.rare, e.word, group))
    own, group, e = own[order], group[order], Entries(*(v[order] for v in e))
    begin = np.flatnonzero(_new(own, e.pair, e.rare))
    meta = (np.add.reduceat(e.meta >> 2, begin) << 2) | (np.add.reduceat((e.meta >> 1) & 1, begin) << 1) | (e.meta[begin] & 1)
    own, group, e = own[begin], group[begin], Entries(*(v[begin] for v in e))
    some, at = np.unique(group * len(docs) + own, return_inverse=True)
    place = (at - np.searchsorted(some, group * len(docs))).astype(np.int16)
    low, high = (lambda h: h.astype(np.uint32).view(np.int32)), (lambda h: (h >> np.uint64(32)).astype(np.uint16).view(np.int16))
    out = _lists(some // len(docs), docs=docs[some % len(docs)])
    out |= _lists(group, place=place, word=e.word.astype(np.int32), meta=meta.astype(np.int32), rare_low=low(e.rare), rare_high=high(e.rare), pair_low=low(e.pair), pair_high=high(e.pair))
    return pa.RecordBatch.from_pydict(out)


BLOCK = "part int, docs array<long>, place array<short>, word array<int>, meta array<int>, rare_low array<int>, rare_high array<short>, pair_low array<int>, pair_high array<short>"
SHARES = "part int, docs array<long>, t array<double>, b array<double>"


def _flat(table: pa.Table, column: str) -> np.ndarray:
    return table[column].combine_chunks().flatten().to_numpy()


def _losses(table: pa.Table, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents with their losses (target, background) from the blocks of a part, which hold all entries of their keys."""
    word, meta = _flat(table, "word"), _flat(table, "meta").astype(np.int64)
    whole = lambda c: _flat(table, f"{c}_low").view(np.uint32).astype(np.int64) | (_flat(table, f"{c}_high").view(np.uint16).astype(np.int64) << 32)
    key, pair = np.where(word < 0, whole("rare") + (1 << 48), word), whole("pair")
    sizes = {c: table[c].combine_chunks().value_lengths().to_numpy() for c in ("docs", "place")}
    begin = np.cumsum([0, *sizes["docs"][:-1]])
    doc = _flat(table, "docs")[np.repeat(begin, sizes["place"]) + _flat(table, "place")]
    order = np.lexsort((pair, key))
    doc, word, key, pair, meta = (v[order] for v in (doc, word, key, pair, meta))
    n, last, target, rare = meta >> 2, (meta >> 1) & 1, meta & 1, word < 0
    of_key, of_pair = np.cumsum(_new(key)) - 1, np.cumsum(_new(key, pair)) - 1
    docs, own = np.unique(doc, return_inverse=True)
    out = []
    for side, mine in enumerate((target, 1 - target)):
        words = np.bincount(of_key, n * mine)[of_key]
        if len(m.words):
            words = np.where(rare, words, m.of_words[side, word])
        loss = n * m.joint(side, np.bincount(of_pair, n * mine)[of_pair], words)
        history = np.bincount(of_key, (n - last) * mine)[of_key]
        out.append(np.bincount(own, loss + np.where(rare, (n - last) * m.history(side, history), 0), minlength=len(docs)))
    return docs, *out


def _added_losses(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    docs, own = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    return docs, *(np.bincount(own, np.concatenate([f[i] for f in found]), minlength=len(docs)) for i in (1, 2))


def _shares(tables: Iterator[pa.Table], m: Model, parts: int) -> Iterator[pa.RecordBatch]:
    """The losses of all parts of a task, added up by document as far as memory goes, as SHARES by the part of the document."""

    def out() -> pa.RecordBatch:
        docs, t, b = _added_losses(found)
        by = docs.view(np.uint64)
        order = np.argsort(by, kind="stable")
        return pa.RecordBatch.from_pydict(_lists(_part(by[order], parts), docs=docs[order], t=t[order], b=b[order]))

    found: list[tuple[np.ndarray, ...]] = []
    for table in tables:
        found.append(_losses(table, m))
        if sum(len(f[0]) for f in found) > HELD:
            found = [_added_losses(found)]
            if len(found[0][0]) > HELD // 2:
                yield out()
                found = []
    if found:
        yield out()


def _sums(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
    for table in tables:
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in _added_losses([tuple(_flat(table, c) for c in ("docs", "t", "b"))])], ["doc", "more_t", "more_b"])


def _by_part(rows: DataFrame, run: Callable[[Iterator[pa.Table]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`run` of the tables of all rows of each part, of which a task holds one at a time."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            part = batch.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and b > a and held[0].column("part")[0].as_py() != part[a]:
                    yield pa.Table.from_batches(held)
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield pa.Table.from_batches(held)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionById(n, F.pmod("part", F.lit(n))).sortWithinPartitions("part").mapInArrow(lambda batches: run(tables(batches)), schema)


def _marked(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc (a hash of doc_id and text), doc_id, text and target of each row."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("doc"), "doc_id", "text")
    target = staged(target.select("doc_id", F.lit(True).alias("is_target")), "lm-target")
    few = target.count() <= BROADCAST_ROWS
    marked = rows.join(F.broadcast(target) if few else target.hint("shuffle_hash"), "doc_id", "left")
    marked = marked.select("doc", "doc_id", "text", F.coalesce("is_target", F.lit(False)).alias("target"))
    return marked if few else staged(marked, "lm-texts", compression="zstd")


def score_documents(docs: DataFrame, target: DataFrame, share: int | None = None) -> DataFrame:
    """doc_id, n_words, loss_target, loss_background and score of each row of `docs`."""
    spark = docs.sparkSession
    marked = _marked(docs, target)
    if share is None:
        size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        share = min(MOST_SHARE, max(LEAST_SHARE, size // SHARE_BYTES))
    v = vocabulary(docs, share)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = tasks * max(1, -(-v.total // (PART * tasks)))
    shared = spark.sparkContext.broadcast(fitted(marked, v))

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for chunk, w, hashes in _hashed(batch.column("text")):
                x, n = tokens(w, hashes), np.diff(w.rows)
                word, pair = _places(m.words, x.words), _places(m.bigrams, x.bigrams)
                both, follows = pair >= 0, (word >= 0) & ~x.last
                out = []
                for side in (0, 1):
                    loss = np.where(x.first, m.history(side, m.starts[side]), 0.0)
                    loss[both] += m.joint(side, m.of_bigrams[side, pair[both]], m.of_words[side, word[both]])
                    loss[follows] += m.history(side, m.of_histories[side, word[follows]])
                    out.append(pa.array(np.bincount(x.rows, loss, minlength=len(n))))
                mine = (batch.column(c).slice(chunk.first, len(n)) for c in ("doc", "doc_id"))
                yield pa.RecordBatch.from_arrays([*mine, pa.array(n), *out], ["doc", "doc_id", "n", "t", "b"])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, held, rows = shared.value, [], 0
        for batch in batches:
            chosen, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("target", "doc"))
            for chunk, w, hashes in _hashed(batch.column("text")):
                x = tokens(w, hashes)
                x = Tokens(*(c[_places(m.bigrams, x.bigrams) < 0] for c in x))
                if not len(x.words):
                    continue
                word, at = _places(m.words, x.words), chunk.first + x.rows
                held.append(Entries(ids[at], word, np.where(word < 0, x.words, np.uint64(0)), x.bigrams, 4 | (x.last.astype(np.int64) << 1) | chosen[at].astype(np.int64)))
                rows += chunk.last - chunk.first
                if rows >= ROWS_TOGETHER or sum(len(e.doc) for e in held) >= HELD:
                    yield _blocks(Entries.joined(held), parts)
                    held, rows = [], 0
        if held:
            yield _blocks(Entries.joined(held), parts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    here = marked.select("doc", "doc_id", "text").mapInArrow(frequent, f"doc long, doc_id {kind}, n long, t double, b double")
    there = marked.select("doc", "target", "text").mapInArrow(rare, BLOCK)
    there = _by_part(_by_part(there, lambda tables: _shares(tables, shared.value, parts), SHARES), _sums, "doc long, more_t double, more_b double")
    sums = [F.sum(c).alias(c) for c in ("t", "b")]
    both = here.groupBy("doc").agg(F.max("doc_id").alias("doc_id"), F.max("n").alias("n_words"), F.count("*").alias("copies"), *sums)
    both = both.join(there.hint("merge"), "doc", "left")
    both = both.select("doc_id", "n_words", "copies", *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0e0))).alias(c) for c in ("t", "b")))
    mean = lambda c: F.when(F.col("n_words") > 0, F.col(c) / F.col("copies") / F.col("n_words"))
    out = both.select("doc_id", "n_words", mean("t").alias("loss_target"), mean("b").alias("loss_background"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select("doc_id", "n_words", "loss_target", "loss_background", (F.col("loss_target") - F.col("loss_background")).alias("score"))
