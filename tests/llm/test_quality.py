import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from galeframe.llm import quality_classifier as C
from galeframe.llm import quality_rules as Q
from galeframe.llm.quality_rules import quality_rules, rule_filtered
from galeframe.llm.statistics import COUNTS, statistics
from tests.llm.conftest import prose

TEXTS = [None, "", " \t\n ", "one", "a b c a b c a b c", "x\n\nx\n x\nx", "été #a* |b| <c>", "w\x0bw\x0cw\rw", "q " * 3000, "a b a b a b a", "A a A a b"]


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_statistics_match_brute_force(make_docs):
    rows = make_docs(list(enumerate([*TEXTS, *(prose(i, 40 * i) for i in range(6))])))
    for r in rows.select("text", statistics(F.col("text"), extra=True).alias("s")).collect():
        assert tuple(r.s[c] for c in COUNTS) == brute(r.text), r.text


def corpus(n=700):
    rows = [(i, prose(i, 60 + i % 90) + ".", ("en", "de", None)[i % 3], "src0" if i % 2 else None) for i in range(n)]
    junk = [(n + i, " ".join(w + "$$$" for w in prose(n + i, 80).split()), "en", "src0") for i in range(20)]
    return rows + junk + [(None, prose(1, 70), "en", "src0"), (9001, None, None, None), (9002, "", "en", "x"), (5, prose(5, 65), "en", "src0")]


def test_outliers_go_and_clean_rows_stay(make_docs):
    got = quality_rules(make_docs(corpus())).collect()
    assert len(got) == len(corpus())
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(by[i].kept for i in range(700))
    assert not any(by[i].kept for i in range(700, 720))
    assert by[9001].base_failed and not by[9001].kept and by[9001].n_words == 0


def test_filter_keeps_columns_and_agrees(make_docs):
    docs = make_docs(corpus())
    kept = rule_filtered(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in quality_rules(docs).collect())


def test_empty_and_tiny_tables(make_docs):
    assert quality_rules(make_docs([])).count() == 0
    assert [r.kept for r in quality_rules(make_docs([(1, prose(1, 60))])).collect()] == [True]


def test_classifier_separates_held_out_rows(spark, make_docs):
    rows = corpus(300) + [(2000 + i, " ".join(f"{w}!!" for w in prose(i, 60).upper().split()), "en", "s") for i in range(150)]
    docs = make_docs(rows)
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i, *_ in rows if i is not None] + [(3, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = C.fit_quality(docs, labels)
    got = C.quality_scores(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert held and all((r.predicted == 1) == (r.doc_id < 300) for r in held if r.doc_id < 300 or r.doc_id >= 2000)
    out = C.quality_filtered(docs, model)
    assert out.columns == docs.columns and out.count() == sum(r.predicted for r in got)


def test_rules_compile_to_what_they_say(spark):
    import numpy as np

    x = {"a": np.array([0.0, 1.0, 2.0]), "b": np.array([5.0, 5.0, 1.0])}
    rule = C.Rule((("a", 0.5, True), ("b", 3.0, False)))
    model = C.RuleEnsemble(-1.0, ((rule, 3.0),))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x["a"], x["b"], strict=True)], "a double, b double")
    got = [r.p for r in df.select(model.column({"a": F.col("a"), "b": F.col("b")}).alias("p")).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-(-1 + 3 * rule.rows(x)))))


def test_classifier_without_labels(spark, make_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    docs = make_docs([(1, "a"), (2, None)])
    assert {round(r.score, 6) for r in C.quality_scores(docs, C.fit_quality(docs, none)).collect()} == {0.5}
    assert C.quality_scores(make_docs([]), C.fit_quality(docs, none)).count() == 0


def test_training_leaves_texts_in_the_tasks(spark, make_docs):
    """The texts learnt from are larger together than all that the driver may collect."""
    from galeframe.llm.statistics import statistics

    rows = [(i, prose(i, 15_000 if i < 60 else i % 80)) for i in range(90)]
    rows += [rows[3], (4, "another text"), (4, None), (4, None), (4, ""), (None, "x")]
    docs = make_docs(rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id bigint, quality int")
    conf = spark.sparkContext._jsc.sc().conf()
    before = conf.get("spark.driver.maxResultSize", "1g")
    assert sum(len(t or "") for _, t in rows) > 3_000_000
    conf.set("spark.driver.maxResultSize", "1m")
    try:
        C.fit_quality(docs, labels)
        got = C.training_rows(docs, labels).collect()
    finally:
        conf.set("spark.driver.maxResultSize", before)
    once = docs.filter("doc_id IS NOT NULL").select("doc_id", "text", C.held_out(5, 0).alias("out")).filter("NOT out").distinct()
    want = once.select("doc_id", (F.col("doc_id") % 2).cast("double"), statistics(F.col("text"), extra=True).alias("s"))
    want = want.select(*want.columns[:2], *C.features(F.col("s")).values()).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def concentrated(x, floor):
    """The regularised minimum covariance determinant of the rows of `x`, from the starts that the operator names."""
    cov = lambda y: np.cov(y.T, bias=True).reshape(x.shape[1], -1)
    q = np.quantile(x, [0.25, 0.5, 0.75], axis=0, method="inverted_cdf")
    starts = [(q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2)), (x.mean(axis=0), cov(x)), (q[1], cov(x))]
    fits = []
    for m, c in starts:
        c = c + floor
        for _ in range(Q.STEPS):
            was = np.linalg.det(c)
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            near = x[d <= np.quantile(d, Q.SUPPORT, method="inverted_cdf")]
            m, c = near.mean(axis=0), Q.CONSISTENCY * cov(near) + floor
            if 1 - np.linalg.det(c) / was <= Q.FALLS:
                break
        fits.append((m, c))
    return min(fits, key=lambda f: np.linalg.det(f[1]))


def drawn(n, own, wider):
    w = n / (n + Q.PRIOR)
    gap = own[0] - wider[0]
    return w * own[0] + (1 - w) * wider[0], w * own[1] + (1 - w) * wider[1] + w * (1 - w) * np.outer(gap, gap)


@pytest.mark.parametrize("few", [True, False])
def test_distances_match_brute_force(make_docs, monkeypatch, few):
    if not few:
        monkeypatch.setattr(Q, "BROADCAST_GROUPS", 0)
    rows = [(r[0], r[1] and r[1] + "\n#" * (k % 5) + " Word!" * (k % 3), *r[2:]) for k, r in enumerate(corpus(200))]
    rows += [(5000 + i, prose(i, 90), "en", "tiny") for i in range(3)] + [(6000 + i, prose(i, 70), None, None) for i in range(60)] + [(7000, prose(1, 80), "fr", None)]
    docs = make_docs(rows)
    vectors = docs.select("lang", "source", Q._measured(F.col("text")).alias("m")).select("lang", "source", "m.base_failed", *(f"m.{v}" for v in Q.NAMES)).collect()
    floor = np.diag([s**2 for s in Q.DIMENSIONS.values()])
    x = np.array([[r[v] for v in Q.NAMES] for r in vectors])
    passed = np.array([not r.base_failed for r in vectors])
    of = lambda test: passed & np.array([test(r) for r in vectors])
    everything = concentrated(x[passed], floor)
    final = {}
    for lang, source in {(r.lang, r.source) for r, p in zip(vectors, passed, strict=True) if p}:
        mine, tongue = of(lambda r: (r.lang, r.source) == (lang, source)), of(lambda r: r.lang == lang)  # noqa: B023
        final[lang, source] = drawn(mine.sum(), concentrated(x[mine], floor), drawn(tongue.sum(), concentrated(x[tongue], floor), everything))
    got = quality_rules(docs).select("doc_id", "n_words", "distance2", "kept", "base_failed").collect()
    assert len(got) == len(vectors)
    want = [(r, v, final.get((r.lang, r.source))) for r, v in zip(vectors, x, strict=True)]
    distance = [None if f is None else (v - f[0]) @ np.linalg.inv(f[1]) @ (v - f[0]) for _, v, f in want]
    assert np.allclose(sorted((g.distance2 for g in got if g.distance2 is not None)), sorted(d for d in distance if d is not None), rtol=1e-6, atol=1e-9)
    assert sum(g.kept for g in got) == sum(not r.base_failed and (d is None or d <= Q.CUTOFF) for (r, *_), d in zip(want, distance, strict=True))


def test_a_group_does_not_depend_on_another(make_docs):
    """The verdicts of a language with its source are the same whatever steps other groups need (all rows weigh in `ALL` alike)."""
    rows = [(r[0], r[1] and r[1] + "\n#" * (k % 5), "en", "a") for k, r in enumerate(corpus(120))]
    other = lambda step: [(9000 + i, prose(i, 60 + step * (i % 7)), "de", "b") for i in range(80)]
    mine = lambda docs: {(v.grp, v.start): tuple(round(x, 9) if isinstance(x, float) else x for x in v) for v in steps(docs).collect() if "a" in v.grp}

    def steps(docs):
        vectors = docs.select(*Q._keys(), Q._measured(F.col("text")).alias("m")).select("by_source", "by_lang", "m.*").filter("NOT base_failed")
        inner = vectors.select(F.col("by_source").alias("grp"), *Q.NAMES)
        now = Q.staged(Q._start(inner), "t")
        while not now.filter(~Q._settled()).isEmpty():
            now = Q.staged(Q._concentrated(inner, now, True), "t")
        return now

    assert mine(make_docs(rows + other(0))) == mine(make_docs(rows + other(40))) == mine(make_docs(rows))


def test_no_group_is_merged_with_another(make_docs):
    import json

    keys = make_docs([(1, "a", "en", None), (2, "a", "en", "x"), (3, "a", None, "x"), (4, "a", None, None)]).select(*Q._keys()).collect()
    assert len({r.by_source for r in keys} | {r.by_lang for r in keys} | {Q.ALL}) == 7 and json.loads(keys[0].by_source) == ["en", None]
