"""Whole results of the fitted operators against plain Python, and very long texts through operators and the pipeline."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as P
from galeframe.llm import decontaminate as D
from galeframe.llm import kernels
from galeframe.llm import lang_id as L
from galeframe.llm import licenses as X
from galeframe.llm import quality_classifier as C
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"


def plain_features(text):
    """Every feature counted sign by sign and word by word."""
    norm = re.sub("[\t\n\x0b\x0c\r]", " ", text or "")
    words = [w for w in norm.split(" ") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    n, chars = max(1, len(words)), max(1, len(norm))
    of = lambda signs: sum(c in signs for c in norm)
    upper, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    return {
        "word_length": sum(map(len, words)) / n, "symbols": of("#*$%&|<>") / n, "dup_lines": (len(lines) - len(set(lines))) / max(1, len(lines)), "repeats": len(covered) / n,
        "upper": of(upper) / chars, "digits": of(digits) / chars, "bangs": of("!?") / n, "stops": of(".,;:") / n, "short": sum(len(w) <= 3 for w in words) / n,
        "distinct": len(set(words)) / n, "words": math.log1p(len(words)),
    }


def test_quality_scores_equal_the_rules_by_hand(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = C.fit_quality(docs, labels)
    assert model.weights
    texts = {r.doc_id: r.text for r in docs.collect()} | {-1: None, -2: "", -3: " \n\t ", -4: "É é\x0bÉ é É é!\n\nA1 <b>\nA1 <b>"}
    got = {r.doc_id: (r.score, r.predicted) for r in C.quality_scores(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), model).collect()}
    for i, text in texts.items():
        x = plain_features(text)
        total = model.intercept + sum(w for rule, w in model.weights if all((x[f] > t) == up for f, t, up in rule.conditions))
        want = 1 / (1 + math.exp(-total))
        assert got[i][0] == pytest.approx(want, rel=1e-9) and got[i][1] == int(want >= 0.3)


def test_languages_equal_duels_by_hand(spark):
    """Families first, then the languages of the winner, each by votes of its machines, then by margins."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit_languages(docs)
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify_languages(docs, model).collect()}

    def winner(duel, x):
        if not duel.pairs:
            return 0, math.inf
        votes, sums, least = ([0.0] * len(duel.names), [0.0] * len(duel.names), [math.inf] * len(duel.names))
        for k, (a, b) in enumerate(duel.pairs):
            m = float(x @ duel.weights[:, k] + duel.offsets[k])
            for side, own in ((a, m), (b, -m)):
                votes[side] += own > 0
                sums[side] += math.tanh(own)
                least[side] = min(least[side], own)
        best = max(range(len(votes)), key=lambda s: (votes[s], sums[s]))
        return best, least[best]

    for r in rows:
        if not r.text or not any(map(str.isalpha, r.text)):
            assert got[r.doc_id] == ("und", 0.0)
            continue
        x = L.vectors(next(kernels.chunks(pa.array([r.text]))))[0]
        f, margin = winner(model.families, x)
        inner = model.within[model.families.names[f]]
        b, own = winner(inner, x)
        assert got[r.doc_id][0] == inner.names[b]
        assert got[r.doc_id][1] == pytest.approx(1 / (1 + math.exp(-4 * min(margin, own))), abs=1e-4)


def test_very_long_texts(spark, make_docs):
    """A text of megabytes is read to its end by every operator."""
    long = prose(1, 400_000)
    item = prose(950, 25)
    docs = make_docs([(1, long + " licensed under the MIT license " + item), (2, long), (3, "x" * 3_000_000), (4, None)])
    bench = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    assert [(r.doc_id, r.similarity) for r in D.find_leaks(docs, bench).collect()] == [(1, 1.0)]
    found = {r.doc_id: (r.n_base, r.base_labels) for r in X.scan_licenses(docs).collect()}
    assert found[1] == (1, "mit") and found[2][0] == 0 and found[4][0] == 0
    known = spark.read.parquet(f"{SF}/documents.parquet")
    assert L.identify_languages(docs, L.fit_languages(known)).count() == 4
    model = C.fit_quality(known, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in C.quality_scores(docs, model).collect()}
    x = plain_features(long)
    total = model.intercept + sum(w for rule, w in model.weights if all((x[f] > t) == up for f, t, up in rule.conditions))
    assert scores[2] == pytest.approx(1 / (1 + math.exp(-total)), rel=1e-9)


def test_pipeline_with_long_empty_and_repeated_rows(spark, tmp_path):
    r = random.Random(1)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80)
    some = docs.select("text", "lang", "source").limit(40).collect()
    extra = [(100_000 + i, " ".join([t.text or ""] * 2), t.lang, t.source, 0) for i, t in enumerate(some)] + [(200_000, prose(5, 150_000), "en", "src1", 0), (200_001, None, None, None, None), (200_002, "", "en", None, 0), (None, some[0].text, "en", "src1", 0), (200_003, some[1].text, "en", "src1", 0)]
    r.shuffle(extra)
    docs.unionByName(spark.createDataFrame(extra, docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    out = P.run(spark, str(tmp_path))
    ids = [x.doc_id for x in out.collect()]
    assert len(ids) == len(set(ids)) and 200_001 not in ids and 200_002 not in ids and np.all([i is None or i >= 0 for i in ids])


def test_machines_trained_in_tasks_are_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    here = {r.doc_id: (r.lang_pred, round(r.score, 4)) for r in L.identify_languages(docs, L.fit_languages(docs)).collect()}
    monkeypatch.setattr(L, "LOCAL", 0)
    model = L.fit_languages(docs)
    assert model.families.sparse is not None
    assert {r.doc_id: (r.lang_pred, round(r.score, 4)) for r in L.identify_languages(docs, model).collect()} == here
    monkeypatch.setattr(L, "MODEL_BYTES", 100)
    with pytest.raises(ValueError, match="MODEL_BYTES"):
        L.fit_languages(docs)


def test_many_languages_form_families(make_docs):
    r = random.Random(6)
    own = {f"x{k:02}": ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(12)] for k in range(40)}
    text = lambda lang: " ".join("".join(r.choices(own[lang], k=2)) for _ in range(40))
    docs = make_docs([(100 * k + i, text(lang), lang, "s") for k, lang in enumerate(own) for i in range(16)])
    model = L.fit_languages(docs)
    assert len(model.families.names) == 3 and sum(len(d.pairs) for d in model.within.values()) <= 40 * L.GROUP
    got = [(r.lang_pred, int(r.doc_id) // 100) for r in L.identify_languages(docs, model).collect()]
    assert sum(p == f"x{k:02}" for p, k in got) > 0.95 * len(got)
