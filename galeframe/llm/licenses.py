"""Licence scans with a generalised suffix automaton of the words of licence templates.

A file is streamed through the automaton: at each word it holds the longest run of words, ending there, that stands in
any template (the matching statistics). Right-maximal runs of MIN_MATCH words or more are chained, in order, into spans
of a template; a span that covers LEAST_COVERAGE of its template gives the template's label. Every MIN_MATCH words of a
run stand in a template, so only stretches of such MIN_MATCH-grams are streamed: that leaves out nothing. Templates are the
texts and notices of licences.txt.

Beside that, fixed phrases give labels wherever they stand. The score is the best coverage of a span, 1 for a phrase.

Edge cases: a null or empty text has no words, no labels (an empty string) and score 0. Other columns are ignored;
repeated rows give repeated results, empty tables empty ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from importlib import resources
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from galeframe.llm import kernels

#: Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
MIN_MATCH, MAX_GAP, LEAST_COVERAGE = 4, 8, 0.6


def templates() -> tuple[tuple[str, str], ...]:
    """Label and text of each template in licences.txt."""
    text = resources.files("galeframe.llm").joinpath("licences.txt").read_text(encoding="utf-8")
    parts = (part.split("\n", 1) for part in text.split("\n== ")[1:])
    return tuple((label.strip(), wording.strip()) for label, wording in parts)


TEMPLATES = templates()


def tokens(text: str) -> np.ndarray:
    """The word hashes of a text."""
    for chunk in kernels.chunks(pa.array([text], pa.string())):
        return kernels.word_hashes(chunk, kernels.words(chunk, kernels.ALNUM, lower=True), lower=True)
    return np.empty(0, dtype=np.uint64)


class Match(NamedTuple):
    template: int
    at: int  # in the template
    word: int  # in the file
    length: int


class Span(NamedTuple):
    label: str
    first: int
    last: int
    coverage: float


class Automaton:
    """A suffix automaton of several word sequences; ends[v]: where in which template the runs of state v end."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.sequences = sequences
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for t, sequence in enumerate(sequences):
            last = 0
            for i, word in enumerate(sequence):
                last = self._extended(last, word, ends)
                ends[last].add((t, i + 1))
        for v in sorted(range(1, len(self.next)), key=lambda v: -self.length[v]):
            if self.link[v] > 0:
                ends[self.link[v]] |= ends[v]
        self.ends = [sorted(e) for e in ends]

    def _new(self, length: int, moves: dict[int, int], link: int, ends: list) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        ends.append(set())
        return len(self.next) - 1

    def _clone(self, p: int, q: int, word: int, ends: list) -> int:
        c = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q], ends)
        self.link[q] = c
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = c
            p = self.link[p]
        return c

    def _extended(self, last: int, word: int, ends: list) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, word, ends)
        v, p = self._new(self.length[last] + 1, {}, 0, ends), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = v
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[v] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word, ends)
        return v

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """After each word: the state, and the length of the longest run ending there."""
        v = size = 0
        for word in words:
            while v and word not in self.next[v]:
                v = self.link[v]
                size = self.length[v]
            if word in self.next[v]:
                v, size = self.next[v][word], size + 1
            else:
                v = size = 0
            yield v, size

    def matches(self, words: list[int], offset: int) -> Iterator[Match]:
        """The longest runs of MIN_MATCH or more words in each template, where that template doesn't go on like the text."""
        for i, (v, size) in enumerate(self.statistics(words)):
            follows = words[i + 1 : i + 2]
            seen: set[int] = set()
            while v and size >= MIN_MATCH:
                fresh = [e for e in self.ends[v] if e[0] not in seen]
                for t, end in fresh:
                    if not follows or self.sequences[t][end : end + 1] != follows:
                        yield Match(t, end - size, offset + i + 1 - size, size)
                seen.update(t for t, _ in fresh)
                v = self.link[v]
                size = self.length[v]


def chained(matches: list[Match], sizes: list[int]) -> list[tuple[int, int, int, float]]:
    """Template, first and last word, and coverage of the best chain of each group of matches that stand close together.

    In a chain, matches follow one another in file and template. Between them in the file are at most MAX_GAP words, or an
    eighth of the template if that is more.
    """
    out = []
    by: dict[int, list[Match]] = {}
    for m in matches:
        by.setdefault(m.template, []).append(m)
    for t, own in by.items():
        own.sort(key=lambda m: (m.word + m.length, m.word, m.at))
        widest = max(MAX_GAP, sizes[t] // 8)
        best: list[tuple[int, int]] = []  # words covered by the best chain that ends here, and where it begins
        for i, m in enumerate(own):
            here = (m.length, m.word)
            for j in range(i - 1, -1, -1):
                o = own[j]
                if m.word - (o.word + o.length) > widest:
                    break
                lap = max(0, o.at + o.length - m.at, o.word + o.length - m.word)
                if o.word < m.word and o.at < m.at and lap < m.length and best[j][0] + m.length - lap > here[0]:
                    here = (best[j][0] + m.length - lap, best[j][1])
            best.append(here)
        end: dict[int, tuple[int, int]] = {}
        for m, (covered, first) in zip(own, best, strict=True):
            end[first] = max(end.get(first, (0, 0)), (covered, m.word + m.length - 1))
        out += [(t, first, last, min(1.0, covered / sizes[t])) for first, (covered, last) in end.items()]
    return sorted(out)


class Scanner:
    def __init__(self, wordings: tuple = TEMPLATES, phrases: dict[str, str] = PHRASES) -> None:
        self.labels = [label for label, _ in wordings]
        sequences = [tokens(text) for _, text in wordings]
        self.phrases = [(tokens(p), label) for p, label in sorted(phrases.items())]
        self.known = np.unique(np.concatenate([*sequences, *(p for p, _ in self.phrases)]))
        self.table = np.zeros(1 << 16, dtype=bool)
        self.table[(self.known & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.grams = np.unique(np.concatenate([kernels.ngram_hashes(s, MIN_MATCH)[: max(0, len(s) - MIN_MATCH + 1)] for s in sequences]))
        self.sizes = [len(s) for s in sequences]
        self.automaton = Automaton([self.numbers(s).tolist() for s in sequences])
        self.numbered = [(self.numbers(p), label) for p, label in self.phrases]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for one that no template or phrase has."""
        out = np.full(len(hashes), -1, dtype=np.int32)
        at = np.flatnonzero(self.table[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)
        out[at] = np.where(self.known[k] == hashes[at], k, -1)
        return out

    def scan(self, chunk: kernels.Chunk) -> list[tuple]:
        """Of each row: words, places of phrases, the first and last of them, phrase labels, labels, score, spans."""
        w = kernels.words(chunk, kernels.ALNUM, lower=True)
        hashes = kernels.word_hashes(chunk, w, lower=True)
        ids = self.numbers(hashes)
        places: dict[int, list[tuple[int, str]]] = {}
        for phrase, label in self.numbered:
            hit = np.ones(max(0, len(ids) - len(phrase) + 1), dtype=bool)
            for j, p in enumerate(phrase):
                hit &= ids[j : j + len(hit)] == p
            at = np.flatnonzero(hit)
            row = np.searchsorted(w.rows, at, side="right") - 1
            for r, a in zip(row.tolist(), at.tolist(), strict=True):
                if a + len(phrase) <= w.rows[r + 1]:
                    places.setdefault(r, []).append((a - int(w.rows[r]), label))
        matches: dict[int, list[Match]] = {}
        for r, a, b in self._stretches(hashes, ids, w.rows):
            matches.setdefault(r, []).extend(self.automaton.matches(ids[a:b].tolist(), a - int(w.rows[r])))
        out = []
        for r, n in enumerate(np.diff(w.rows).tolist()):
            base = places.get(r, ())
            spans = [Span(self.labels[t], a, b, c) for t, a, b, c in chained(matches[r], self.sizes)] if r in matches else []
            starts, names = [a for a, _ in base], {x for _, x in base}
            found = names | {s.label for s in spans if s.coverage >= LEAST_COVERAGE}
            score = 1.0 if base else max([0.0, *(s.coverage for s in spans)])
            out.append((n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(names)), ",".join(sorted(found)), score, [s for s in spans if s.coverage >= LEAST_COVERAGE]))
        return out

    def _stretches(self, hashes: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Row, begin and end of every stretch of words in a row of which each MIN_MATCH in succession stand in a template."""
        known = np.append(ids, -1) >= 0
        known = np.flatnonzero(np.logical_and.reduce([known[j : len(known) - MIN_MATCH + 1 + j] for j in range(MIN_MATCH)])) if len(ids) >= MIN_MATCH else np.empty(0, dtype=np.int64)
        row = np.searchsorted(rows, known, side="right") - 1
        inside = known + MIN_MATCH <= rows[row + 1]
        known, row = known[inside], row[inside]
        if not len(known):
            return
        grams = kernels.ngram_hashes(hashes, MIN_MATCH)[known]
        k = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        hit = self.grams[k] == grams
        at, row = known[hit], row[hit]
        if not len(at):
            return
        cuts = np.flatnonzero((np.diff(at) > 1) | (np.diff(row) > 0)) + 1
        first, last = np.append(0, cuts), np.append(cuts, len(at)) - 1
        yield from zip(row[first].tolist(), at[first].tolist(), (at[last] + MIN_MATCH).tolist(), strict=True)


@cache
def scanner() -> Scanner:
    """One for all tasks of a worker."""
    return Scanner()


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
SPANS = "spans array<struct<label:string,first:bigint,last:bigint,coverage:double>>"


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, COLUMNS and SPANS (words of the covered template spans) of each row of `docs`."""
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("coverage", pa.float64())]))]
    names = [c.split()[0] for c in [*COLUMNS.split(", "), "spans"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in kernels.chunks(batch.column("text")):
                rows = [(*r[:-1], [s._asdict() for s in r[-1]]) for r in scanner().scan(chunk)]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(chunk.first, len(rows)), *columns], ["doc_id", *names])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {COLUMNS}, {SPANS}")
