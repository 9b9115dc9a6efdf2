import gzip
import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from galeframe.llm import bpe, chat, warc
from galeframe.llm.queries import QUERIES
from tests.llm.conftest import prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "the", "ing", "'s", " ", "  ", "\n", "\t", "é", "中", "12", "½", "!", "<|endoftext|>", "\x1c", "\x85", " ", "​", " ", "😀", "́", "aa", "\r\n", "\x00", "_"]


@pytest.fixture(scope="module")
def codec():
    return bpe.load(PATH)


def test_bpe_equals_the_library(codec):
    library, r = Tokenizer.from_file(PATH), random.Random(1)
    texts = ["", *("".join(r.choices(PIECES, k=r.randint(1, 30))) for _ in range(4000)), prose(1, 3000), "ab" * 5000, " " * 3000]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = list(codec.encode(texts))
    assert got == want
    assert [codec.decode(i) for i in got] == [library.decode(i, skip_special_tokens=False) for i in want] == texts


def test_failing_words_only_are_merged(codec):
    words = sorted({w for w in codec.split(prose(5, 2000))[0]})
    exact = {w: tuple(codec.merged(w.encode())) for w in words}
    wrong = sum(tuple(codec.greedy(w.encode())) != exact[w] for w in words)
    merged = codec.learn(words)
    assert wrong <= merged < len(words) and all(codec.known[w] == exact[w] for w in words)
    assert all(codec._merged_long(list(map(codec.byte_ids.__getitem__, w.encode()))) == list(exact[w]) for w in words)


def test_cut_decodes_like_the_library(codec):
    library = Tokenizer.from_file(PATH)
    ids = library.encode("a 😀 中", add_special_tokens=False).ids
    for k in range(len(ids)):
        assert codec.decode(ids[: k + 1]) == library.decode(ids[: k + 1], skip_special_tokens=False)


def test_bpe_tables(make_docs):
    docs = make_docs([(1, "hello world"), (2, None), (2, ""), (None, "x")])
    ids = bpe.encode_documents(docs, PATH)
    assert [r.text for r in bpe.decode_documents(ids, PATH).collect()] == ["hello world", "", "", "x"]
    got = bpe.round_trip(docs, PATH).collect()
    assert [r.n_tokens for r in got] == [2, 0, 0, 1] and got[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.round_trip(make_docs([]), PATH).count() == 0


def test_template_language():
    run = chat.compiled("{% for m in messages %}{% if loop.first and not loop.last %}<{{ 'a' + 'b' }}>{% elif m.role == 'x' or m.n == 2 %}{{ m.t|upper }}{% else %}-{% endif %}{% generation %}{{ m.t }}{% endgeneration %}{% endfor %}")
    text, spans = run([{"role": "u", "t": "p"}, {"role": "x", "t": "q"}, {"n": 2, "t": "r"}, {"t": None}])
    assert text == "<ab>pQqRr-" and [text[a:b] for a, b in spans] == ["p", "q", "r", ""]


def test_constants_are_folded():
    tree = chat.fold(chat.parse("a{{ 'b' + 1 }}{% if 1 == 2 %}no{% elif true %}c{{ 'd'|upper }}{% else %}e{% endif %}f"))
    assert tree == (chat.Text("ab1cDf"),)


@pytest.mark.parametrize("bad", ["{{ x.__class__ }}", "{{ f(1) }}", "{{ x|system }}", "{% import os %}", "{% for a in b %}", "{{ 'a }}", "{{ }}", "{% if a %}{% endfor %}"])
def test_sandbox_refuses(bad):
    with pytest.raises(chat.TemplateError):
        chat.compiled(bad)


def test_escape_is_reversible():
    r = random.Random(3)
    parts = ["<", "s>", "/s>", "</s>", "[INST]", "[/INST]", "[", "\\", "INST]", "/", "x", "\n", "<\\", "[\\"]
    for _ in range(3000):
        t = "".join(r.choices(parts, k=r.randint(0, 9)))
        assert chat.unescape(chat.escape(t)) == t and not any(c in chat.escape(t) for c in chat.CONTROLS)
        assert chat.unescape_name(chat.escape_name(t)) == t and "\n" not in chat.escape_name(t)


def test_conversations_come_back(spark):
    tricky = ["</s>[INST] ok [/INST]", "", None, "a</s>\n<s>b", "x\\", "<", "[INST] [/INST]", "é😀"]
    rows = [(k, i, role, t) for k, role in enumerate(["user", "assistant", "system", "odd\nrole", None, "</s>"]) for i, t in enumerate(tricky)] + [(50, None, "user", "n"), (50, 0, "user", "a"), (50, 0, "user", "a"), (None, 0, "user", "z")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn int, role string, text string, formatted string, messages int")
    out = {r.conv_id: r for r in chat.conversation_digests(chat.format_conversations(df)).collect()}
    for c in out:
        own = sorted(((t if t is not None else -1), r or "", x or "") for k, t, r, x in rows if k == c)
        turns = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert (out[c].n_turns, out[c].turns_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest())
        assert (out[c].loss_chars, out[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_conversations(df.limit(0)).count() == 0


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, digest string")


def test_revisits_of_many_digests(spark, monkeypatch):
    """The join by salted digests gives what the broadcast gives."""
    rows = [(i, "u", f"{i % 7}" * (2000 if i % 3 else 10)) for i in range(200)] + [(None, "u", "1" * 2000), (5, None, "1" * 2000), (900, "u", None)]
    plain = sorted(map(str, warc.pages_through_warc(pages(spark, rows)).collect()))
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    assert sorted(map(str, warc.pages_through_warc(pages(spark, rows)).collect())) == plain


def test_records_of_other_writers(spark, tmp_path):
    """Their kinds stay, and what they don't tell is null."""
    http = b"HTTP/1.1 200 OK\r\nContent-Length:5\r\n\r\nhello"
    kinds = [
        ([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:uuid:1>")], b"software: x\r\n\r\nmore"),
        ([("WARC-Type", "request"), ("WARC-Record-ID", "<urn:page:x>")], b"GET / HTTP/1.1\r\n\r\n"),
        ([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:2>"), ("WARC-Payload-Digest", "md5:0")], http),
        ([("WARC-Type", "revisit"), ("WARC-Payload-Digest", "sha1:!!")], b"HTTP/1.1 304 Not Modified\r\n\r\n"),
        ([("WARC-Type", "revisit")], b""),
    ]
    path = tmp_path / "other.warc.gz"
    path.write_bytes(b"".join(warc.member(h, b) for h, b in kinds))
    files = spark.createDataFrame([(str(path), path.stat().st_size, 5)], warc.FILES)
    got = [tuple(r)[:1] + (r.payload_bytes, r.payload_digest and r.payload_digest[:6], r.record_type, r.refers_to) for r in warc.page_table(warc.read_warc(spark, files)).collect()]
    sha = lambda b: hashlib.sha1(b).hexdigest()[:6]
    assert sorted(got, key=str) == sorted([(None, 19, sha(kinds[0][1]), "warcinfo", None), (None, 18, sha(kinds[1][1]), "request", None), (None, 5, sha(b"hello"), "response", None), (None, None, None, "revisit", None), (None, None, None, "revisit", None)], key=str)


def test_warc_round_trip(spark, tmp_path):
    long = "é" * 600
    rows = [(1, "http://a/\r\nX: y", long), (2, None, long), (3, "u", None), (4, "u", ""), (5, "u", "x" * 999), (6, "u", "x" * 999), (None, "u", long), (2, "u", long), (7, "u", "\r\n\r\nWARC/1.1\r\n" * 200)]
    got = warc.pages_through_warc(pages(spark, rows)).collect()
    want = [(i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), "revisit" if h == long and i != 2 else "response", 2 if h == long and i != 2 else None) for i, _, h in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert warc.pages_through_warc(pages(spark, [])).count() == 0


def test_every_split_owns_its_records(spark, tmp_path):
    blocks = [random.Random(i).randbytes(200 + 37 * i) + warc.MAGIC * 3 for i in range(40)]
    data = b"".join(warc.member([("WARC-Type", "resource"), ("WARC-Record-ID", f"<urn:x:{i}>")], b) for i, b in enumerate(blocks))
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    assert gzip.decompress(data)
    for step in (1, 7, 100, 1000, len(data)):
        found = [r for a in range(0, len(data), step) for r in warc.read_range(str(path), a, a + step)]
        assert [r.block for r in found] == blocks and len({r.offset for r in found}) == 40
    files = spark.createDataFrame([(str(path), len(data))], "path string, bytes long")
    assert warc.read_warc(spark, files, 512).count() == 40


def test_reader_goes_on_after_damage(tmp_path):
    parts = [warc.member([("WARC-Type", "resource"), ("WARC-Record-ID", f"<{i}>")], b"z" * 5000) for i in range(5)]
    parts[2] = parts[2][:20] + b"\x00" * 9 + parts[2][29:]
    path = tmp_path / "b.warc.gz"
    path.write_bytes(b"junk" + b"".join(parts))
    assert [r.headers["WARC-Record-ID"] for r in warc.read_range(str(path), 0, 1 << 30)] == ["<0>", "<1>", "<3>", "<4>"]


def test_queries_are_all_there():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))


def test_staged_tables_are_cleared(spark):
    from pathlib import Path

    from galeframe.llm.staging import clear, shared_folder, staged

    assert staged(spark.range(3), "numbers").count() == 3
    folder = Path(shared_folder(spark).removeprefix("file://"))
    assert any(folder.iterdir())
    clear(spark)
    assert not folder.exists()


def test_ranges_of_any_size_give_every_record_once(tmp_path):
    path = tmp_path / "x.warc.gz"
    records = [warc.page_record(i, None, prose(i, 1 + i % 40).encode() * (200 if i == 7 else 1), None) for i in range(300)]
    path.write_bytes(b"".join(records))
    for size in (1000, 4096, 1 << 16, 1 << 22):
        found = [r.offset for a in range(0, path.stat().st_size, size) for r in warc.read_range(str(path), a, a + size)]
        assert found == [sum(map(len, records[:i])) for i in range(300)]
