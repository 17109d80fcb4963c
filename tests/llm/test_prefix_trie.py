"""The trie of conversation prefixes against a plain one, and against its SQL."""

import hashlib
import random
import re
import zlib

import pytest

from riskspark.llm import prefix_trie
from riskspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows):
    """rows of (conv_id, turn, role, text)"""
    told = {}
    for c, turn, role, text in rows:
        if c is not None:
            told.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in told.items()}
    members: dict = {}
    for c, own in turns.items():
        base = c - int(c / 20) * 20  # the remainder takes the sign of c, as in SQL
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(turns.get(c - base, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append((c, d == len(path)))
    out = []
    for node, who in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaves = sum(not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in members) for n in below)
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in sorted(c for c, ends in who if ends))
        out.append((
            min(who)[0], len(node), min(members[node[:-1]])[0] if node else None, len(who),
            sum(len(m) == len(node) + 1 and m[: len(node)] == node for m in members), leaves, saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: (r[0], r[1]))


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: (r[0], r[1]))


def test_query_equals_its_sql(spark, duck):
    got = rows_of(QUERIES["op11_prefix_trie"](spark, SF))
    want = duck.execute(ORACLES["op11_prefix_trie"]).fetchdf()[COLUMNS]
    want = want.astype(object).where(want.notna(), None)
    assert got == sorted(map(tuple, want.itertuples(index=False)), key=lambda r: (r[0], r[1]))


def some_conversations(seed):
    """Few words, so that prefixes and whole conversations coincide at every depth; nulls, ties and gaps among the ids."""
    r = random.Random(seed)
    rows = []
    for c in [*range(-25, 5), *range(40, 75), *range(101, 119)]:
        for k in range(r.choice([1, 2, 4, 5, 8, 9, 13])):
            role = r.choice(["user", "user", "user", None])
            text = r.choice(["a b", "a b", "a b", "a\x1cb  c", "", None]) if k < 5 else r.choice(["x y z", "x y z", "q"])
            rows.append((c, k, role, text))
    rows += [(300 + k, None, "user", "same") for k in range(9)] + [(300, None, "user", "same"), (301, 5, "user", "same"), (None, 1, "user", "lost")]
    rows += [(320 + k, t, "user", f"long {t}") for k in (0, 1, 2, 3) for t in range(11)] + [(322, 11, "user", "z")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [4, 3])
def test_prefixes_that_coincide(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = some_conversations(block)
    data = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, depth int, pos int").repartition(5)
    assert rows_of(prefix_trie.trie(data)) == plain_trie(rows)


def test_empty_and_turnless(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).isEmpty()
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 1)  # its base is absent, so nothing is left of one turn
    rows = [(c, 0, "user", "gone")]
    assert rows_of(prefix_trie.trie(spark.createDataFrame(rows, schema))) == plain_trie(rows) and plain_trie(rows)[0][1:6] == (0, None, 1, 0, 1)
