"""Alignment of two tokenizers against a plain version with the libraries' own calls."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskspark.llm import alignment
from riskspark.llm.common import table
from riskspark.llm.queries import QUERIES
from riskspark.llm.tokens import tokenizer_path
from tests.llm.helpers import messy_docs

SF = "/root/testdata/sf0.001"


def plain(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each text."""
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    alphabet = alignment._byte_alphabet()
    docs = []
    for text in texts:
        a = library.encode(" " + text, add_special_tokens=False) if text else None
        b = pieces.encode(text) if text else []
        told = (" " + (text or "")).encode()
        bytes_a = [bytes(alphabet[c] for c in t) for t in a.tokens] if text else []
        bytes_b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, pieces.id_to_piece(i)) for i in b)]
        if not text or b"".join(bytes_a) != told or b"".join(bytes_b) != told:
            docs.append(([], [], [], ""))
            continue
        spans = []
        for ids, parts in ((a.ids, bytes_a), (b, bytes_b)):
            at, out = 0, []
            for i, p in zip(ids, parts, strict=True):
                out.append((at, at + len(p), i))
                at += len(p)
            spans.append(out)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, links, at = [], [], [0, 0]
        for cut in cuts:
            sides = []
            for k, side in enumerate(spans):
                low = at[k]
                while at[k] < len(side) and side[at[k]][0] < cut:
                    at[k] += 1
                sides.append(side[low : at[k]])
            groups.append("|".join(",".join(str(s[2]) for s in side) for side in sides))
            links += [(x[2], y[2]) for x in sides[0] for y in sides[1] if x[0] < y[1] and y[0] < x[1]]
        docs.append((a.ids, b, links, ";".join(groups)))
    count = Counter(p for d in docs for p in set(d[2]))
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    return [
        (len(a), len(b), told.count(";") + 1 if told else 0, len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
         hashlib.sha256(told.encode()).hexdigest() if told else "")
        for a, b, links, told in docs
    ]


def checked(docs, got):
    told = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *p) for r, p in zip(told, plain([r.text for r in told]), strict=True)), key=str)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == want


def test_whole_table(spark):
    checked(table(spark, SF, "documents"), QUERIES["op13_alignment"](spark, SF))


@pytest.mark.parametrize("chunk", [8 << 20, 300])
def test_awkward_texts(spark, monkeypatch, chunk):
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    odd = [
        "<|endoftext|> plain <s> </s> <unk>", "▁ marked", " leading", "  two  three   spaces ", "tabs\tand\nbreaks\r\n\n", "ﬁ ligature ½", "日本語 漢字かな", "🙂🙃 a🙂",
        "\x00\x01", "naïve café", "  wide", "é combining", "x" * 3000, "ab " * 5000, "don't we'll I'M", "१२३ ٣٤", "�", "a",
    ]
    docs = messy_docs(spark).select("doc_id", "text", F.col("hash").alias("chunk"), F.col("size").alias("pairs"))
    docs = docs.unionByName(spark.createDataFrame([(500 + i, t, 1, 2) for i, t in enumerate(odd)], "doc_id long, text string, chunk int, pairs int"))
    checked(docs, alignment.align(docs.repartition(3)))
    assert alignment.align(docs.limit(0)).isEmpty()


def test_common_ends():
    got = alignment.common_ends([2, 5, 6, 9], [1, 5, 9])
    assert [x.tolist() for x in got] == [[2, 4], [2, 3]]
