import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from galeframe.llm import decontaminate as D
from galeframe.llm import kernels as K
from galeframe.llm import lang_id as L
from galeframe.llm import licenses as X
from galeframe.llm import lm_scoring as M
from galeframe.llm import near_dup as N
from tests.llm.conftest import prose


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_word_hashes_are_those_of_the_words():
    texts = [None, "", "Ab ab aB", "é É", " x\ty\nz ", "long" * 400_000, "tail"]
    seen, got = {}, []
    for c in K.chunks(pa.array(texts), 1 << 10):
        w = K.words(c, K.NOT_SPACE, lower=True)
        h = K.word_hashes(c, w, lower=True).tolist()
        got += [h[a:b] for a, b in zip(w.rows[:-1], w.rows[1:], strict=True)]
    for t, hashes in zip(texts, got, strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        assert len(words) == len(hashes)
        for a, b in zip(words, hashes, strict=True):
            assert seen.setdefault(a, b) == b
    assert len(set(seen.values())) == len(seen)


def links(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join(w if r.random() >= share else f"edit{r.randint(0, 999)}" for w in text.split())


def test_near_duplicates_match_brute_force(make_docs):
    rows, i = [], 0
    for k in range(12):
        base = prose(k, 30 + 15 * k)
        for c in range(8):
            rows.append((i, edited(base, 0.01 * c, i)))
            i += 1
    passage = prose(77, 60)  # shared by texts that aren't copies of one another
    rows += [(1000 + j, passage + " " + prose(500 + j, 12 + j)) for j in range(60)]
    rows += [(2000, None), (2001, ""), (2002, " \n "), (2003, "Tiny Text"), (2004, "tiny text"), (2005, "tiny"), (2006, rows[0][1].upper())]
    got = N.near_duplicates(make_docs(rows)).collect()
    want = links(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_edge_rows(make_docs):
    assert N.near_duplicates(make_docs([])).count() == 0
    got = N.near_duplicates(make_docs([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "a b c d e f")])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (3, 3, True), (3, 3, True), (4, 3, False)]
    docs = make_docs([(1, "x y z"), (2, "x y z"), (3, None), (None, "x"), (1, "x y z")])
    kept = N.deduplicated(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3]


def test_deduplication_goes_by_text_not_by_id(make_docs):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    near = a.replace(a.split()[-1], "end")
    rows = [(1, a), (2, a), (2, b), (2, near), (3, b.upper()), (4, c), (4, c), (4, c + " "), (5, None), (5, ""), (None, a)]
    kept = sorted(((r.doc_id or 0, r.text or "") for r in N.deduplicated(make_docs(rows)).collect()))
    assert kept == sorted([(0, a), (1, a), (2, b), (4, kept[-3][1]), (5, ""), (5, "")]) and kept[-3][1].strip() == c
    got = {(r.doc_id, r.component_id, r.kept) for r in N.near_duplicates(make_docs(rows)).collect()}
    assert {(2, 1, False), (2, 2, True), (3, 2, False), (1, 1, True), (4, 4, True), (5, 5, True)} <= got


def test_blocks_of_a_large_bucket_find_what_one_block_finds():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 20, N.K).astype(np.int32)
    signature = np.where(r.random((40, N.K)) < 0.2, r.integers(0, 1 << 20, (40, N.K)), base).astype(np.int32)
    short = [np.sort(r.choice(400, 300, replace=False)).astype(np.uint32) for _ in range(40)]
    nodes, sizes = np.arange(40), np.full(40, 300)
    whole = set(N.linkable(0, nodes, nodes, sizes, np.zeros(40, int), signature, short))
    side = nodes % 3
    parts = set()
    for a in range(3):
        for b in range(a, 3):
            at = np.flatnonzero((side == a) | (side == b))
            parts |= set(N.linkable(0, nodes[at], nodes[at], sizes[at], side[at], signature[at], [short[k] for k in at]))
    assert whole == parts


def test_signature_is_the_minimum_over_shifts():
    values = K.mix(np.arange(1, 50, dtype=np.uint64))
    places = (K.mix(values ^ N._SCATTER) >> np.uint64(44)).astype(int)
    assert (N.signatures(values, np.array([0]))[0] == N.circle()[places].min(axis=0)).all()


def score(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            h[i + 1][j + 1] = max(0, h[i][j] + (2 if a[i] == b[j] else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
    return max(map(max, h))


def test_alignment_is_smith_waterman():
    r = np.random.default_rng(5)
    for _ in range(40):
        item, windows = r.integers(0, 6, r.integers(1, 15)).astype(np.uint64), [r.integers(0, 6, r.integers(1, 30)).astype(np.uint64) for _ in range(4)]
        assert D.align(item, windows).tolist() == [score(item.tolist(), w.tolist()) for w in windows]


def test_copies_and_edited_copies_leak(spark, make_docs):
    items = [prose(9000 + i, 40) for i in range(20)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(90, None), (91, "a"), (0, items[0]), (None, items[19] + " end")], "item_id int, text string")
    rows = [(i, prose(i, 200)) for i in range(50)]
    rows += [(100 + i, prose(i, 100) + "\n" + t.upper() + "!\n" + prose(i + 1, 100)) for i, t in enumerate(items)]
    rows += [(200 + i, prose(i, 90) + " " + edited(t, 0.2, i) + " " + prose(i + 2, 90)) for i, t in enumerate(items)]
    rows += [(300, None), (301, ""), (None, items[3]), (302, items[4]), (302, items[4])]
    docs = make_docs(rows)
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(docs, bench).collect()}
    assert {(100 + i, i) for i in range(20)} <= got and {(200 + i, i) for i in range(20)} <= got
    assert not any(d is not None and d < 50 for d, _ in got) and (None, 3) in got and (119, None) in got
    clean = D.decontaminated(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [*range(50), 300, 301]


def test_items_in_every_document_still_have_seeds(spark, make_docs):
    item = prose(1, 30)
    rows = [(i, prose(100 + i, 50) + " " + item) for i in range(30)]
    bench = spark.createDataFrame([(1, item)], "item_id int, text string")
    assert D.find_leaks(make_docs(rows), bench).count() == 30
    assert D.find_leaks(make_docs([]), bench).count() == 0
    assert D.find_leaks(make_docs(rows), bench.limit(0)).count() == 0 and D.decontaminated(make_docs(rows), bench.limit(0)).count() == 30


def brute_phrases(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    at = [(i, label) for p, label in X.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def test_licences(make_docs):
    mit, bsd = X.TEMPLATES[0][1], next(t for label, t in X.TEMPLATES if label == "bsd")
    texts = [None, "", "MIT  License, mit-license MIT. License", "the apache license\nGENERAL PUBLIC LICENSE", prose(1, 50), f"{prose(2, 30)} {bsd} {prose(3, 30)}", edited(mit, 0.08, 4), "été MIT é license", "the of the of the of the", mit * 50]
    docs = make_docs([*enumerate(texts), (0, texts[2])])
    got = X.scan_licenses(docs).collect()
    assert len(got) == len(texts) + 1
    for r in got[: len(texts)]:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_phrases(texts[r.doc_id]), texts[r.doc_id]
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    by = {r.doc_id: r for r in got[: len(texts)]}
    assert by[5].labels == "bsd" and by[6].labels == "mit" and by[4].labels == "" and by[4].score == 0 and by[8].labels == ""
    assert X.scan_licenses(make_docs([])).count() == 0


def test_matching_statistics_are_longest_substrings():
    r = random.Random(2)
    seqs = [[r.randint(0, 3) for _ in range(r.randint(1, 12))] for _ in range(5)]
    subs = {tuple(s[a:b]) for s in seqs for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    auto = X.Automaton(seqs)
    words = [r.randint(0, 4) for _ in range(300)]
    for i, (v, n) in enumerate(auto.statistics(words)):
        want = max([k for k in range(0, min(i + 1, 12) + 1) if k == 0 or tuple(words[i + 1 - k : i + 1]) in subs])
        assert n == want
        ends = {(t, e) for t, s in enumerate(seqs) for e in range(n, len(s) + 1) if n and s[e - n : e] == words[i + 1 - n : i + 1]}
        assert set(auto.ends[v]) == ends if n else True


VOWELS = {"en": "the of and with that ing", "de": "der und sch ein ung keit", "fr": "le et que eau tion aux", "es": "el que cion ado mente os"}


def tongue(lang, seed, n=60):
    r = random.Random(seed)
    parts = VOWELS[lang].split()
    return " ".join("".join(r.choices(parts, k=r.randint(1, 2))) for _ in range(n))


def test_languages(make_docs):
    rows = [(i, tongue(lang, i), lang, "s") for i, lang in enumerate(list(VOWELS) * 60)]
    extra = [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "12 | 34 !!", "en", "s"), (1003, "é", None, "s"), (None, tongue("fr", 1), "fr", "s"), (1, tongue("de", 1), "de", "s")]
    docs = make_docs(rows + extra)
    got = L.identify_languages(docs, L.fit_languages(docs)).collect()
    want = {i: lang for i, _, lang, _ in rows}
    held = [r for r in got if r.held_out and r.doc_id < 1000]
    assert held and sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.98 * len(held)
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (1000, 1001, 1002)} == dict.fromkeys((1000, 1001, 1002), "und")
    assert all(0 <= r.score <= 1 for r in got) and next(r for r in got if r.doc_id == 1003).lang_pred != "und"
    assert L.identify_languages(make_docs([]), L.LanguageModel(None, {})).count() == 0
    alone = make_docs([(i, tongue("en", i), "en", "s") for i in range(8)])
    assert {r.lang_pred for r in L.identify_languages(alone, L.fit_languages(alone)).collect()} == {"en"}
    assert {r.lang_pred for r in L.identify_languages(alone, L.fit_languages(make_docs([]))).collect()} == {"und"}


def test_runs_end_in_each_template_by_itself():
    a, b = [1, 2, 3, 4, 5, 6, 7, 8], [1, 2, 3, 4, 5, 6, 9, 7]
    found = set(X.Automaton([a, b]).matches(a, 0))
    assert found == {X.Match(0, 0, 0, 8), X.Match(1, 0, 0, 6)}
    spans = dict((s.label, s.coverage) for s in scanned("This work is licensed under a Creative Commons Attribution 4.0 International License"))
    assert spans["cc-by"] == 1.0 and spans["cc-by-nc"] >= 0.85


def scanned(text):
    for chunk in K.chunks(pa.array([text])):
        return X.Scanner().scan(chunk)[0][-1]


@pytest.mark.parametrize("share", [1, 20, 4096, None])
def test_lm_counts_every_word_and_bigram(spark, make_docs, share):
    stems = [f"{a}{b}{c}ing" for a in "bcdfghklmn" for b in "aeiou" for c in "rstvwxyz"]
    r = random.Random(5)
    rows = [(i, " ".join(["of the", *r.sample(stems, 40), stems[i % len(stems)], "of the"])) for i in range(400)]
    rows += [(i, " ".join(f"{i}w{k}" for k in range(20))) for i in range(400, 500)] + [(600, None), (None, rows[3][1]), (3, rows[3][1]), (601, "of of of of")]
    good = {i for i in range(0, 500, 3)}
    labels = spark.createDataFrame([(i, 1) for i in good], "doc_id bigint, quality int")
    got = M.score_documents(make_docs(rows).repartition(3), M.target_documents(labels), share).collect()
    assert M.score_documents(make_docs([]), M.target_documents(labels), share).count() == 0

    pairs, words, histories = ([Counter(), Counter()] for _ in range(3))
    for d, t in rows:
        seq = ["", *(t or "").split()]
        side = int(d not in good)
        pairs[side].update(zip(seq[:-1], seq[1:], strict=True))
        words[side].update(seq[1:])
        histories[side].update(seq[:-1])
    totals = [sum(w.values()) for w in words]
    size = 1 + len(set(words[0]) | set(words[1]))

    def loss(side, text):
        scale = totals[0] / totals[1] if side else 1.0
        seq, out = ["", *text.split()], 0.0
        for a, b in zip(seq[:-1], seq[1:], strict=True):
            law = (words[side][b] * scale + M.UNIFORM_WEIGHT / size) / (totals[side] * scale + M.UNIFORM_WEIGHT)
            out -= math.log((pairs[side][a, b] * scale + M.HISTORY_WEIGHT * law) / (histories[side][a] * scale + M.HISTORY_WEIGHT))
        return out / (len(seq) - 1)

    key = lambda x: (x[0] is None, x[0] or 0)
    want = sorted(((d, len((t or "").split()), *((loss(0, t), loss(1, t)) if t else (None, None))) for d, t in rows), key=key)
    for x, (d, n, a, b) in zip(sorted(got, key=key), want, strict=True):
        assert (x.doc_id, x.n_words) == (d, n)
        assert x.score is None if not n else math.isclose(x.loss_target, a, abs_tol=1e-5) and math.isclose(x.loss_background, b, abs_tol=1e-5)


def test_whole_licences_with_edits(make_docs):
    """Each template, alone among other words and with a word in twelve changed, is found under its label; prose isn't."""
    whole = [(label, text) for label, text in X.TEMPLATES if len(X.tokens(text)) >= 40]
    assert {label for label, _ in whole} >= {"mit", "apache", "gpl", "lgpl", "agpl", "bsd-2", "isc", "zlib", "unlicense"}
    texts = [f"{prose(i, 40)} {edited(text, 1 / 12, i)} {prose(i + 1, 40)}" for i, (_, text) in enumerate(whole)] + [prose(9, 400)]
    got = sorted(X.scan_licenses(make_docs(list(enumerate(texts)))).collect(), key=lambda r: r.doc_id)
    for (label, _), r in zip(whole, got, strict=False):
        assert label in r.labels.split(",") and r.score >= X.LEAST_COVERAGE
    assert got[-1].labels == "" and got[-1].score < X.LEAST_COVERAGE


def test_stretches_leave_out_no_match():
    """Runs of a text found through its stretches are those found over the whole text."""
    scanner = X.Scanner()
    rnd = random.Random(3)
    pool = [w for _, t in X.TEMPLATES for w in t.split()]
    for n in range(60):
        at = rnd.randrange(len(pool))
        text = " ".join([*rnd.choices(pool, k=30), *pool[at : at + rnd.randrange(3, 40)], "qqq", *rnd.choices(pool, k=n)])
        for chunk in K.chunks(pa.array([text, text[: n * 3]])):
            w = K.words(chunk, K.ALNUM, lower=True)
            hashes = K.word_hashes(chunk, w, lower=True)
            ids = scanner.numbers(hashes)
            through = {(r, m) for r, a, b in scanner._stretches(hashes, ids, w.rows) for m in scanner.automaton.matches(ids[a:b].tolist(), a)}
            whole = {(r, m) for r in range(2) for m in scanner.automaton.matches(ids[w.rows[r] : w.rows[r + 1]].tolist(), int(w.rows[r]))}
            assert through == whole


def test_blocks_of_a_benchmark_find_what_one_finds(spark, make_docs, monkeypatch):
    """Many small blocks, each finished before the next, give the leaks and the clean rows of a single one."""
    items = [(i, prose(100 + i, 30)) for i in range(12)] + [(99, None), (98, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [f"{prose(i, 60)} {items[i % 12][1] if i % 3 else ''} {prose(i + 50, 20)}" for i in range(24)] + [None, ""]
    docs = make_docs(list(enumerate(texts)))
    found = lambda: sorted(map(tuple, D.find_leaks(docs, bench).collect()))
    left = lambda: sorted(r.doc_id for r in D.decontaminated(docs, bench).collect())
    whole, clean = found(), left()
    assert {(d, i) for d, i, *_ in whole} >= {(i, i % 12) for i in range(24) if i % 3} and {24, 25} <= set(clean)
    monkeypatch.setattr(D, "BLOCK_WORDS", 300)
    assert next(iter(D._blocks(bench)))[1] > 3
    assert found() == whole and left() == clean


def seeded_score(item, words):
    """The best local alignment score among alignments with three matches in a row, cell by cell."""
    low_score = -(10**9)
    best, above = low_score, [(0, low_score, low_score, low_score)] * (len(words) + 1)
    for a in item:
        row = [(0, low_score, low_score, low_score)]
        for j, b in enumerate(words):
            left, up, cross = row[j], above[j + 1], above[j]
            gap = [max(max(left[:3]), max(up[:3])) - 1, max(left[3], up[3]) - 1]
            if a == b:
                cell = (max(0, gap[0]), cross[0] + 2, cross[1] + 2, max(cross[2] + 2, cross[3] + 2, gap[1]))
            else:
                cell = (max(0, gap[0], max(cross[:3]) - 1), low_score, low_score, max(gap[1], cross[3] - 1))
            best = max(best, cell[3])
            row.append(cell)
        above = row
    return best


def all_leaks(docs, items):
    out = set()
    for i, text in docs:
        for k, item in items:
            words, own = (re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t)) for t in (text, item))
            if len(own) >= 3 and (s := seeded_score(own, words)) >= max(0.4 * 2 * len(own), min(12, 2 * len(own))):
                out.add((i, k, round(s / (2 * len(own)), 9)))
    return out


def leak_rows(seed, copies, clean):
    """Items, and documents with whole, half, edited, stretched and shuffled copies of them among clean ones."""
    r = random.Random(seed)
    items = [(k, prose(900 + k, n)) for k, n in enumerate((3, 5, 7, 12, 20, 30))]
    items += [(10, items[5][1].rsplit(" ", 16)[0] + " " + prose(950, 16)), (11, "ra ne"), (12, None), (13, "")]  # 5 and 10 share their first half
    docs = [(i, prose(i, r.randint(5, 50))) for i in range(clean)]
    for k, item in items[:7]:
        words = item.split()
        for _ in range(copies):
            a = r.randint(0, len(words) // 2)
            kinds = [words, words[: len(words) // 2], words[a : a + len(words) // 2 + 1], edited(item, 0.2, r.random()).split(), [x for w in words for x in ([w, "zwischen"] if r.random() < 0.4 else [w])], r.sample(words, len(words))]
            around = prose(r.random(), r.randint(0, 8)), prose(r.random(), r.randint(0, 8))
            docs.append((10_000 + len(docs), " ".join([around[0], *r.choice(kinds), around[1]])))
    return items, docs + [(1, None), (2, ""), (3, items[4][1]), (3, items[4][1])]


@pytest.mark.parametrize("copies, clean", [(3, 40), (9, 40)])
def test_leaks_equal_all_alignments(spark, make_docs, copies, clean):
    items, docs = leak_rows(copies, copies, clean)
    got = D.find_leaks(make_docs(docs), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(x.doc_id, x.item_id, round(x.similarity, 9)) for x in got.collect()} == all_leaks(docs, items)


def test_no_leak_is_lost_to_its_copies(spark, make_docs):
    """The more often a half of an item leaked, and the larger the table, the same leaks are found."""
    item = prose(901, 30)
    half = " ".join(item.split()[:14])
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    for copies, clean in ((8, 0), (50, 0), (400, 0), (50, 3000)):
        docs = make_docs([(i, f"{prose(5000 + i, 5)} {half} {prose(7000 + i, 6)}") for i in range(copies)] + [(100_000 + i, prose(20_000 + i, 12)) for i in range(clean)])
        assert {r.doc_id for r in D.find_leaks(docs, benchmark).collect()} == set(range(copies))
        assert D.decontaminated(docs, benchmark).count() == clean


def test_bounds_are_never_below_scores():
    r = np.random.default_rng(3)
    for _ in range(50):
        item = r.integers(0, 12, 15).astype(np.uint64)
        windows = [r.integers(0, 30, n).astype(np.uint64) for n in r.integers(1, 60, 20)]
        assert (D.bounds(np.unique(item), windows) >= D.align(item, windows)).all()


def test_short_grants_give_labels(make_docs):
    texts = {
        "The library is licensed under LGPL terms": "lgpl", "licensed under the LGPL, see below": "lgpl", "The Eclipse Public License v2 applies": "epl", "is licensed under AGPL": "agpl",
        "Code: BSD 3-Clause License.": "bsd-3", "text under CC BY 4.0": "cc-by", "Figures: CC BY-SA 4.0": "cc-by-sa", "Licensed under CC BY-NC 4.0": "cc-by-nc", "See the Mozilla Public License": "mpl",
        "this is licensed under the sun": "", "the eclipse was public, a license to look up": "", "by a creative person under common terms 4.0": "",
    }
    got = {r.doc_id: r.labels for r in X.scan_licenses(make_docs(list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())
