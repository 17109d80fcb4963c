"""Token ids, packing into sequences, token files: exact round trips and layouts."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskspark.llm import packing, token_files, tokens
from riskspark.llm.common import table
from riskspark.llm.queries import QUERIES
from tests.llm.helpers import messy_docs, some_texts

SF = "/root/testdata/sf0.001"
FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def plain(name, texts, end):
    tool = tokens.encoder(tokens.tokenizer_path(name)).library
    return [[*e.ids, end] for e in tool.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def same(name, texts):
    tool = tokens.encoder(tokens.tokenizer_path(name))
    got = [np.frombuffer(x, tool.dtype).tolist() for x in tool.encode(pa.array(texts, pa.string()))]
    assert got == [x[:-1] for x in plain(name, texts, 0)]


@pytest.mark.parametrize("name", FILES)
def test_ids_equal_the_librarys(spark, name):
    texts = [r.text for r in table(spark, SF, "documents").limit(60).collect()] + some_texts()
    same(name, [*texts, None, "", " ", "<|endoftext|> it's 'll", "\n x\n\ny ", "a\x1c b\x85 c  d  　e", "0 00 a0 0", "J̌ A̓ The THE", "x", "", "a  b\n\nc"])


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aBJ̌é0日's.,|!\n \t\r\x1c\x85\xa0 ́Σ", max_size=24), max_size=6))
def test_ids_of_any_text(name, texts):
    same(name, texts)


@pytest.mark.parametrize("name", FILES)
def test_words_that_go_to_the_model_itself(name):
    latin = [chr(c) for c in range(33, 0x300)]
    texts = [" ".join(latin), "".join(latin), *latin, *(f"x{c}y {c}" for c in latin), "Straße ÉCOLE İstanbul ǅ ﬁ ЖУК жук 漢字 ª º"]
    same(name, texts)
    tool = tokens.encoder(tokens.tokenizer_path(name))
    assert tool.by_word and tool._is_word("école") and not tool._is_word("жук") and not tool._is_word("e\u0301")
    assert tool._is_word("École") is (name == "byte_bpe_50k.json") is tool._is_word(" word")


@pytest.mark.parametrize("name", FILES)
def test_memory_starts_anew(monkeypatch, name):
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    for seed in range(3):
        same(name, some_texts(12, seed))


@pytest.mark.parametrize("name", FILES)
def test_a_run_asks_for_its_distinct_chunks_once(monkeypatch, name):
    tool, asked = tokens.Encoder(tokens.tokenizer_path(name)), []
    learn = tool._learn
    monkeypatch.setattr(tool, "_learn", lambda chunks: asked.extend(chunks) or learn(chunks))
    batch = pa.RecordBatch.from_pydict({"text": ["the cat, the dog\n", None, "the cat " * 50, "été"]})
    runs = list(tokens.runs([batch, batch, batch.slice(0, 0), batch]))
    assert [r.num_rows for r in runs] == [12] and list(tokens.runs([])) == []
    first, again = (tool.encode(runs[0]["text"]) for _ in range(2))
    assert first == again == first[:4] * 3 and len(asked) == len(set(asked)) == len(tool.chunks)
    monkeypatch.setattr(tokens, "RUN_BYTES", 30)
    assert sum(r.num_rows for r in tokens.runs([batch, batch])) == 8


@pytest.mark.parametrize("name", FILES)
def test_chunks_of_one_hash_are_told_apart(monkeypatch, name):
    monkeypatch.setattr(tokens, "span_hashes", lambda body, start, end: (end - start).astype(np.uint64))
    monkeypatch.setattr(tokens, "_ENCODERS", {})
    monkeypatch.setattr(tokens, "REMEMBERED", 300)
    for seed in (3, 4, 3):
        same(name, some_texts(12, seed))
        assert len(tokens.encoder(tokens.tokenizer_path(name)).chunks) <= 300


def test_words_known_by_their_bytes():
    for name in FILES:
        tool = tokens.Encoder(tokens.tokenizer_path(name))
        chunks = [f"{a}{chr(c)}{b}".encode() for c in range(33, 0x2100) for a in ("", " ", "x") for b in ("", "y")]
        sure = tool._sure(chunks)
        assert sure.sum() > 100 and all(tool._is_word(c.decode()) for c, w in zip(chunks, sure, strict=True) if w)


@pytest.mark.parametrize("name", FILES)
def test_strings_of_added_tokens_as_in_the_file(name):
    from tokenizers import Tokenizer

    path = tokens.tokenizer_path(name)
    fresh = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b", "it's", "x<|startoftext|>y", None, "<|EndOfText|>, a.", "<|endof", "text|> b", "<|endoftext|>", "<|STARTOFTEXT|>"]
    tool = tokens.Encoder(path)
    got = [np.frombuffer(x, tool.dtype).tolist() for x in tool.encode(pa.array(texts, pa.string()))]
    assert got == [e.ids for e in fresh.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert got[0] == {"byte_bpe_50k.json": [64, 220, 50256, 275], "word_bpe_49k.json": [320, 49407, 321]}[name]


def test_first_fit_decreasing_equals_the_plain_one():
    r = random.Random(2)
    for n in (0, 1, 2, 7, 200):
        sizes = np.array([r.randint(1, 100) for _ in range(n)], np.int64)
        into, fill = packing.first_fit_decreasing(sizes, 100)
        rooms, want = [], {}
        for i in sorted(range(n), key=lambda i: -sizes[i]):
            b = next((b for b, room in enumerate(rooms) if room >= sizes[i]), len(rooms))
            rooms += [100] * (b == len(rooms))
            rooms[b] -= sizes[i]
            want[i] = b
        assert [want[i] for i in range(n)] == into.tolist() and fill.tolist() == [100 - x for x in rooms]


def check_packing(rows, texts, length=2048):
    """Every id in one piece, sequences gapless, crc right; returns the padding's share."""
    ids = plain("word_bpe_49k.json", [t for _, t in texts], 1)
    pieces, fills = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        fills.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for (d, _), x in zip(texts, ids, strict=True):
        at = 0
        for p in sorted(pieces.pop(d), key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(x)
            assert p.ids_crc32 == zlib.crc32(np.array(x[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(x)
    assert not pieces
    padded = total = 0
    for held in fills.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= length
        total += at
        padded += 0 if at & (at - 1) == 0 else length - at
    return padded / max(1, total + padded)


@pytest.mark.parametrize("group_docs", [8192, 40])
def test_packing_the_whole_table(spark, monkeypatch, group_docs):
    monkeypatch.setattr(packing, "GROUP_DOCS", group_docs)
    texts = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert check_packing(QUERIES["op6_packing"](spark, SF).collect(), texts) < 0.05


def test_packing_awkward_rows(spark):
    docs = messy_docs(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = packing.pack(docs, with_ids=True).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    all_rows = packing.pack(messy_docs(spark))
    n = sum(len(x) for x in plain("word_bpe_49k.json", [r.text for r in messy_docs(spark).collect()], 1))
    assert sum(r.length for r in all_rows.collect()) == n
    assert packing.pack(docs.limit(0)).isEmpty()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 1, 2, 3, 7, 300, 49_999, 70_000]), max_size=60), max_size=6), st.integers(1, 50))
def test_file_round_trip(docs, block):
    ids = np.array([i for d in docs for i in d], "<u4")
    lengths = np.array([len(d) for d in docs], np.int64)
    doc_ids = [None if k == 1 else -k for k in range(len(docs))]
    got_docs, got_lengths, got = token_files.decode_file(token_files.encode_file(doc_ids, lengths, ids, block))
    assert got_docs == doc_ids and got_lengths.tolist() == lengths.tolist() and got.tolist() == ids.tolist()


def test_file_of_many_kinds_and_of_repetition():
    r = np.random.default_rng(1)
    for ids in (r.integers(0, 60_000, 30_000), np.tile(r.integers(0, 500, 90), 300), np.zeros(5000, int), r.zipf(1.3, 20_000) % 50_000):
        data = token_files.encode_file([0], np.array([len(ids)]), ids.astype("<u4"), 4096)
        assert (token_files.decode_file(data)[2] == ids).all()
    assert len(data) < 2 * len(ids)
    tiled = np.tile(r.integers(0, 500, 90), 300).astype("<u4")
    assert len(token_files.encode_file([0], np.array([len(tiled)]), tiled)) < len(tiled) / 2


def test_blocks_begin_with_the_files_frequencies():
    # blocks too short to learn from: before, each began with even frequencies of the classes (15,748 bytes)
    ids = (np.random.default_rng(5).zipf(1.6, 16_000) % 3000).astype("<u4")
    data = token_files.encode_file([0], np.array([len(ids)]), ids, 64)
    assert (token_files.decode_file(data)[2] == ids).all() and len(data) < 15_000


def test_carries_run_through_words():
    out = np.array([7, 0xFFFFFFFF, 0xFFFFFFFF, 5, 9], np.uint32)
    token_files._carry(out, np.array([2, 4]))
    assert out.tolist() == [8, 0, 0, 5, 10]


@pytest.mark.parametrize("lanes", [1, 3, 8192])
def test_rounds_of_blocks(monkeypatch, lanes):
    monkeypatch.setattr(token_files, "LANES", lanes)
    r = np.random.default_rng(lanes)
    for n in (1, 511, 512, 513, 5000):
        ids = r.choice([3, 3, 3, 60_000, 17], n).astype("<u2")
        data = token_files.encode_file([None], np.array([n]), ids)
        assert (token_files.decode_file(data)[2] == ids).all()


def test_damage_is_noticed():
    ids = np.random.default_rng(0).integers(0, 900, 5000).astype("<u4")
    data = bytearray(token_files.encode_file([1], np.array([5000]), ids, 1000))
    data[-700] ^= 4
    with pytest.raises(ValueError, match="damaged"):
        token_files.decode_file(bytes(data))
    with pytest.raises(ValueError, match="not a token file"):
        token_files.decode_file(b"something else")


def check_files(got, texts):
    """Rows in ascending order of id, gapless from 0, with the library's ids."""
    ids = dict(zip([d for d, _ in texts], plain("byte_bpe_50k.json", [t for _, t in texts], 2), strict=True))
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        x = ids[r.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        at += len(x)
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(ids)


@pytest.mark.parametrize("size", [32 << 20, 60_000])
def test_token_files_of_the_whole_table(spark, monkeypatch, size):
    monkeypatch.setattr(token_files, "FILE_BYTES", size)
    got = QUERIES["op9_token_files"](spark, SF).collect()
    check_files(got, [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()])


def test_token_files_of_awkward_rows(spark):
    docs = messy_docs(spark)
    got = token_files.round_trip(docs).orderBy("start").collect()
    assert len(got) == docs.count() and got[0].doc_id is None
    ends = [r.start + r.n_tokens for r in got]
    assert [r.start for r in got] == [0, *ends[:-1]]
    known = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_files(token_files.round_trip(known).collect(), [(r.doc_id, r.text) for r in known.collect()])
    assert token_files.round_trip(docs.limit(0)).isEmpty()
