"""Lexical search, vector codes and BPE in SQL against brute force and the tokenizer library."""

import base64
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from galeframe.llm import lexical_search as L
from galeframe.llm import sql_bpe as S
from galeframe.llm import vector_codes as V
from tests.llm.conftest import prose


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, top=20):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n, total, out = len(held), sum(len(t) for _, t in held), set()
    for item, text in set(items):
        scored = []
        for doc, own in held:
            m = 100 - 25 + 25 * len(own) * n // total
            score = 0
            for term in terms(text):
                df, tf = sum(term in t for _, t in held), own.count(term)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 12 * m)) if df else 0
            if score > 0:
                scored.append((-score, doc is None, doc))
        out |= {(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scored)[:top])}
    return out


@pytest.fixture()
def small_shards(monkeypatch):
    """Shards and blocks so small that every list has several of each."""
    monkeypatch.setattr(L, "SHARD_DOCS", 40)
    monkeypatch.setattr(L, "BLOCK", 4)
    monkeypatch.setattr(L, "TOGETHER", 8)


def test_search_equals_brute_force(make_docs, spark):
    r = random.Random(3)
    docs = [(i, " ".join(r.choices(["ra", "Né", "to", "LI", "mo", "ka", "x1", "--", "zz" + str(i % 7)], k=r.randint(1, 30)))) for i in range(150)]
    docs += [(500, None), (501, ""), (502, "!?"), (503, "ra " * 5000), (504, docs[3][1]), (505, docs[3][1]), (None, docs[3][1]), (3, docs[3][1])]
    items = [(1, "ra né ra zz3"), (2, "LI mo, zz1 unknown"), (3, ""), (4, None), (5, "unknown"), (None, "ka"), (1, "ra né ra zz3"), (6, docs[3][1])]
    got = L.search_documents(make_docs(docs), spark.createDataFrame([(*i, 0, "t") for i in items], "item_id bigint, text string, score int, term string")).collect()
    assert {tuple(x) for x in got} == ranked(docs, items)


def test_search_in_small_shards(make_docs, spark, small_shards):
    # Workers import the module anew, so shards are made here, in one process.
    r = random.Random(5)
    texts = [" ".join(r.choices("ra ne to li mo ka".split(), k=r.randint(0, 25))) for _ in range(100)]
    shard = L._Shard()
    for c in L.kernels.chunks(pa.array(texts)):
        shard.add([1000 - i for i in range(c.first, c.last)], c)
    rows = {t: d for b in shard.rows("s") for t, d in zip(b.column("term").to_pylist(), b.column("data").to_pylist(), strict=True)}
    head = np.frombuffer(rows.pop(None), dtype="<i8")
    ids, lengths = head[:100], head[100:]
    assert ids.tolist() == sorted(ids.tolist())
    cursors = [L.Cursor(rows[t], 7) for t in ("ra", "to", "ka")]
    got, last = {}, -1
    for places, scores in L.complete_documents(cursors, 12 * (75 + lengths)):
        assert places[0] > last
        last = places[-1]
        got |= dict(zip(ids[places].tolist(), scores.tolist(), strict=True))
    want = {1000 - i: sum(7 * (10**9 * tf // (1000 * tf + 12 * (75 + len(t.split())))) for w in ("ra", "to", "ka") if (tf := t.split().count(w))) for i, t in enumerate(texts)}
    assert got == {k: v for k, v in want.items() if v}


def test_packing_is_the_same_together_and_alone():
    r = np.random.default_rng(1)
    sizes = r.integers(1, 1400, 60)
    docs = np.concatenate([np.sort(r.choice(60_000 if i % 3 else 9_000_000, s, replace=False)) for i, s in enumerate(sizes)])
    counts = r.integers(1, 400, sizes.sum())
    starts = np.cumsum(sizes) - sizes
    packed = L.pack_all(sizes, docs, counts)
    assert packed == [L.pack_postings(docs[a : a + n], counts[a : a + n]) for a, n in zip(starts, sizes, strict=True)]
    for data, a, n in zip(packed, starts, sizes, strict=True):
        c = L.Cursor(data, 1)
        blocks = [c.block() for _ in c.firsts]
        assert np.concatenate([d for d, _ in blocks]).tolist() == docs[a : a + n].tolist()
        assert np.concatenate([k for _, k in blocks]).tolist() == counts[a : a + n].tolist()


def test_search_of_empty_tables(make_docs, spark):
    items = spark.createDataFrame([(1, "ra")], "item_id bigint, text string")
    assert L.search_documents(make_docs([]), items).count() == 0
    assert L.search_documents(make_docs([(1, None)]), items).count() == 0
    assert L.search_documents(make_docs([(1, "ra")]), items.limit(0)).count() == 0


def quantised(rows, parts, entries, rounds, scale):
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    wide = 8 // parts
    cut = lambda v, p: v[p * wide : (p + 1) * wide]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    nearest = lambda p, v: min(range(len(books[p])), key=lambda e: (far(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, v, _ in kept:
                own.setdefault(nearest(p, v), []).append(cut(v, p))
            books[p] = [[sum(x) // len(x) for x in zip(*own[e], strict=True)] if e in own else b for e, b in enumerate(books[p])]
    coded = [(i, "".join(f"{nearest(p, v):02x}" for p in range(parts)), sum(far(cut(v, p), books[p][nearest(p, v)]) for p in range(parts)), label) for i, v, label in kept]
    sums = {}
    for *_, e, label in coded:
        sums[label] = sums.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, sums[label], digest) for i, c, e, label in coded), key=repr)


def test_codes_equal_brute_force(spark):
    r = random.Random(2)
    rows = [(i, [r.choice([-1.0, -0.3, 0.0, 0.25, 0.5, 1.0]) for _ in range(8)], r.choice([0, 1, None])) for i in range(300)]
    rows += [(7, rows[3][1], 1), (None, rows[4][1], None), (301, None, 0), (302, [None] * 8, 0), (303, [math.nan] * 8, 0), (304, [math.inf] + [0.0] * 7, 0), (305, [0.5] * 9, 0), (306, [], 0), (-1, [0.1] * 8, 2), (-2, [0.1] * 8, 2)]
    table = spark.createDataFrame([(*x, "c") for x in rows], "vec_id bigint, embedding array<double>, label int, code string").repartition(3)
    got = sorted((tuple(x) for x in V.compression_report(table).collect()), key=repr)
    assert got == quantised(rows, 8, 16, 6, 4096)


def test_codes_of_few_and_no_rows(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    assert V.compression_report(spark.createDataFrame([(1, None, 0)], schema)).count() == 0
    few = [(i, [float(i)] * 8, None) for i in range(3)]
    got = sorted((tuple(x) for x in V.compression_report(spark.createDataFrame(few, schema)).collect()), key=repr)
    assert got == quantised(few, 8, 16, 6, 4096)
    coded, books = V.compress(spark.createDataFrame(few, schema))
    assert {r.vec_id: r.embedding for r in V.decode_codes(coded, books).collect()} == {i: v for i, v, _ in few}
    with pytest.raises(Exception, match="beyond"):
        V.compression_report(spark.createDataFrame([(1, [1e9] * 8, 0)], schema)).count()


def test_tree_keeps_the_lower_index_of_equals():
    r = np.random.default_rng(4)
    for n in (1, 3, 16, 70):
        entries = r.integers(-3, 4, (n, 3))
        points = r.integers(-4, 5, (500, 3))
        far = ((points[:, None] - entries) ** 2).sum(axis=2)
        index, best = V.Tree(entries).nearest(points)
        assert index.tolist() == far.argmin(axis=1).tolist() and best.tolist() == far.min(axis=1).tolist()


PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    None, "", " ", "a  b\n\n c  's x   y  ", "I'll we've 'll  'd", "naïve Ωmega 漢字かな 12²½ 😀😀 \x1c\x00é", "=" * 3000, "aaaa" * 700 + "b", "\U000f0000 mark  \U000f0000", "\r\n\t x",
    "".join(random.Random(1).choices("abcdefghij", k=2500)), prose(3, 400), "<|endoftext|> plain", "word " * 9000,
]


def test_tokens_equal_the_library(make_docs):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=S.read_ranks(PATH), special_tokens={})
    docs = make_docs([(i, t) for i, t in enumerate(TEXTS)] + [(None, "again"), (3, TEXTS[3])])
    ids = S.encode_documents(docs, PATH)
    got = {r.doc_id: r.ids for r in ids.filter("doc_id IS NOT NULL").collect()}
    assert got == {i: own.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}
    raw = {r.doc_id: bytes(r.raw) for r in S.decode_documents(ids, PATH).filter("doc_id IS NOT NULL").collect()}
    assert raw == {i: (t or "").encode() for i, t in enumerate(TEXTS)}
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in S.round_trip(docs, PATH).filter("doc_id IS NOT NULL").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert digests == {(i, len(got[i]), sha(" ".join(map(str, got[i])).encode()), sha((t or "").encode())) for i, t in enumerate(TEXTS)}
    assert S.round_trip(docs, PATH).count() == len(TEXTS) + 2
    assert S.round_trip(make_docs([]), PATH).count() == 0


def test_ids_outside_the_vocabulary_are_an_error(spark):
    with pytest.raises(Exception, match="outside the vocabulary"):
        S.decode_documents(spark.createDataFrame([(1, [70000])], "doc_id bigint, ids array<int>"), PATH).collect()


def test_unruly_vocabularies_equal_the_library(spark, make_docs, tmp_path):
    """Ranks in an order that no training gives: tokens of lower rank than their parts."""
    r = random.Random(8)
    for k in range(4):
        ranks = {bytes([b]): i for i, b in enumerate(range(256))}
        grown = {"".join(r.choices("abc", k=r.randint(2, 6))).encode() for _ in range(40)}
        order = sorted(grown)
        r.shuffle(order)
        ranks |= {t: 256 + i for i, t in enumerate(order)}
        path = tmp_path / f"v{k}.tiktoken"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for t, i in ranks.items()))
        own = tiktoken.Encoding(f"v{k}", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        texts = ["".join(r.choices("abc", k=n)) for n in (1, 5, 40, 64, 65, 90, 300, 300)]
        got = {x.doc_id: x.ids for x in S.encode_documents(make_docs(list(enumerate(texts))), str(path)).collect()}
        assert got == {i: own.encode_ordinary(t) for i, t in enumerate(texts)}
