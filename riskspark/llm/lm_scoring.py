"""Cross-entropy difference of two n-gram models.

A target and a background model of word pairs are counted over the whole corpus: the
background over all documents, the target over those labelled good and not toxic. Both
share one vocabulary and one smoothing, so that their losses on a word compare. A
document's score is the mean over its words of the target's loss less the background's, in
nats: the lower, the closer to the target.

    P(w) = (c(w) + ALPHA) / (N + ALPHA * V)
    P(w | v) = (c(v, w) + BETA * P(w)) / (c(v) + BETA)

V is the number of distinct words of the corpus, and LEAST_WORDS at least. Every word and
every pair has a count of its own, under its 64-bit hash; their number grows with the corpus.

No task holds a model. Documents are dealt to chunks of about CHUNK bytes of text, hashes
to ranges, each of which gets the distinct ones of about RANGE bytes. A chunk sends each
range its distinct hashes with their counts; the range adds up the counts of all chunks and
sends back, in the same order, what they come to, from which the chunk computes the losses
of its documents. A word in every document thus travels once per chunk.

Cases: a null or blank text has no words; its losses and score are null. A null doc_id is
counted and scored. Repeated rows are counted each time. With no target documents the
target is uniform. An empty table gives no rows. Only doc_id, text and the labels' doc_id,
quality and toxic are read.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import new_folder
from riskspark.llm.text import U64, Words, lower, mix, raw, slices

ALPHA, BETA = 0.5, 8.0
#: The vocabulary counts as this large at least; what a small corpus leaves is for words it has not met.
LEAST_WORDS = 1 << 18
#: Bytes of text per chunk, and per range of hashes.
CHUNK, RANGE = 8 << 20, 16 << 20


class Models(NamedTuple):
    """What the models are counted on: documents, and the ids of the target's."""

    docs: DataFrame
    good: DataFrame


def _places(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """(words, hash of each word, index of each pair's second word, hash of each pair)."""
    w = Words(*_lowered(texts))
    h = w.hashes()
    at = np.flatnonzero(w.doc[1:] == w.doc[:-1]) + 1
    return w, h, at, mix(h[at - 1] * U64(0xD1342543DE82EF95) + h[at])


def _lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    body, offsets = raw(texts)
    return lower(body), offsets


def fit(docs: DataFrame, labels: DataFrame) -> Models:
    """The models of all documents, and of those that all their labels call good and not toxic."""
    good = (
        labels.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))).alias("good"))
        .where("good")
        .select("doc_id")
    )
    return Models(docs.select("doc_id", "text"), good)


class _Chunk:
    """The words and pairs of a chunk: index of each among the distinct hashes, which ascend."""

    def __init__(self, table: pa.Table):
        sizes, words, ats, pairs, n = [np.zeros(0, np.int64)], [np.zeros(0, U64)], [np.zeros(0, np.int64)], [np.zeros(0, U64)], 0
        for batch in table.select(["text"]).to_batches():
            for part in slices(batch):
                w, word, at, pair = _places(part["text"])
                sizes.append(w.n_words)
                words.append(word)
                ats.append(at + n)
                pairs.append(pair)
                n += len(word)
        self.n_words, self.at = np.concatenate(sizes), np.concatenate(ats)
        self.words, self.word = np.unique(np.concatenate(words), return_inverse=True)
        self.pairs, self.pair = np.unique(np.concatenate(pairs), return_inverse=True)


def _pack(x: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, compressed."""
    return zlib.compress(x.astype(np.min_scalar_type(int(x.max(initial=0)))).tobytes(), 1)


def _unpack(data: bytes, n: int) -> np.ndarray:
    data = zlib.decompress(data)
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _pack_hashes(x: np.ndarray) -> bytes:
    """Ascending hashes as the gaps between them, byte by byte: the upper bytes are mostly zero."""
    tool = zlib.compressobj(1, strategy=zlib.Z_HUFFMAN_ONLY)
    return tool.compress(np.diff(x, prepend=U64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()) + tool.flush()


def _unpack_hashes(data: bytes) -> np.ndarray:
    gaps = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(gaps).view("<u8").ravel(), dtype=U64)


_KINDS = ("word", "pair")
_ASKED = T.StructType([T.StructField(c, T.LongType()) for c in ("chunk", "part")])
_TOLD = T.StructType([T.StructField(c, T.LongType()) for c in ("chunk", "part", "vocabulary", "n_background", "n_target")])
for _kind in _KINDS:
    _ASKED = _ASKED.add(f"{_kind}s", "binary").add(f"{_kind}_background", "binary").add(f"{_kind}_target", "binary")
    _TOLD = _TOLD.add(f"n_{_kind}s", "long").add(f"{_kind}_background", "binary").add(f"{_kind}_target", "binary")


def _table(rows: list[tuple], schema: T.StructType) -> pa.Table:
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table([pa.array(x, kinds[f.dataType.simpleString()]) for f, x in zip(schema, columns, strict=True)], schema.names)


def _ask(parts: int):
    """What a chunk sends to each range: its distinct hashes, how often it has them, and in target documents."""

    def run(key, docs: pa.Table, good: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _table([], _ASKED)
        chunk = _Chunk(docs)
        counted = docs["counted"].to_numpy()
        target = counted & pc.is_in(docs["doc_id"], good["good"].combine_chunks(), skip_nulls=True).to_numpy()
        columns = []
        for hashes, index, of in ((chunk.words, chunk.word, slice(None)), (chunk.pairs, chunk.pair, chunk.at)):
            lows = -(-(np.arange(1, parts) << 32) // parts)  # where each range but the first begins, by the upper half
            cut = np.searchsorted(hashes >> U64(32), lows.astype(U64)).tolist()
            counts = [np.bincount(index[np.repeat(x, chunk.n_words)[of]], minlength=len(hashes)) for x in (counted, target)]
            spans = list(zip([0, *cut], [*cut, len(hashes)], strict=True))
            columns += [[_pack_hashes(hashes[a:b]) for a, b in spans], *([_pack(x[a:b]) for a, b in spans] for x in counts)]
        return _table(list(zip([key[0].as_py()] * parts, range(parts), *columns, strict=True)), _ASKED)

    return run


def _tell(asked: pa.Table) -> pa.Table:
    """What a range sends back to each chunk: the counts of its hashes over all chunks, and the range's sums."""
    chunks, columns, sums = asked["chunk"].to_pylist(), [], []
    for kind in _KINDS:
        hashes = [_unpack_hashes(x.as_py()) for x in asked[f"{kind}s"]]
        ends = np.cumsum([0, *map(len, hashes)]).tolist()
        own, index = np.unique(np.concatenate(hashes), return_inverse=True)
        told = [[b - a for a, b in zip(ends, ends[1:])]]
        for c in ("background", "target"):
            counts = [_unpack(x.as_py(), len(h)) for x, h in zip(asked[f"{kind}_{c}"], hashes, strict=True)]
            total = np.zeros(len(own), np.int64)
            np.add.at(total, index, np.concatenate(counts))
            told.append([_pack(total[index[a:b]]) for a, b in zip(ends, ends[1:])])
            if kind == "word":
                sums += [int((total > 0).sum()), int(total.sum())] if c == "background" else [int(total.sum())]
        columns += told
    same = [[x] * len(chunks) for x in sums]
    return _table(list(zip(chunks, asked["part"].to_pylist(), *same, *columns, strict=True)), _TOLD)


def _losses(chunk: _Chunk, told: pa.Table, model: str) -> np.ndarray:
    """The loss of each word of a chunk; the first of a text has no word before it."""
    word, pair = (
        np.concatenate([_unpack(x.as_py(), n) for x, n in zip(told[f"{kind}_{model}"], told[f"n_{kind}s"].to_pylist(), strict=True)])
        for kind in _KINDS
    )
    if (len(word), len(pair)) != (len(chunk.words), len(chunk.pairs)):
        raise ValueError("the counts sent back are not those of the chunk's words and pairs")
    places = max(LEAST_WORDS, pc.sum(told["vocabulary"]).as_py())
    p = ((word + ALPHA) / (pc.sum(told[f"n_{model}"]).as_py() + ALPHA * places))[chunk.word]
    p[chunk.at] = (pair[chunk.pair] + BETA * p[chunk.at]) / (word[chunk.word[chunk.at - 1]] + BETA)
    return -np.log(p)


def score(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss and score of every document."""
    docs = docs.select("doc_id", "text")
    schema = T.StructType([docs.schema["doc_id"]]).add("n_words", "long")
    for c in ("target_loss", "background_loss", "score"):
        schema = schema.add(c, "double")
    marked = lambda frame, counted, scored: frame.select("*", F.lit(counted).alias("counted"), F.lit(scored).alias("scored"))
    both = marked(docs, True, True) if docs.sameSemantics(models.docs) else marked(docs, False, True).unionByName(marked(models.docs, True, False))
    # Written with its numbers, as a row must be in the same chunk whenever it is read.
    numbered, path = both.withColumn("row", F.monotonically_increasing_id()), new_folder(docs.sparkSession, "numbered")
    numbered.write.option("compression", "zstd").parquet(path)
    stored = docs.sparkSession.read.schema(numbered.schema).parquet(path)
    size = stored.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, parts = (max(1, -(-size // x)) for x in (CHUNK, RANGE))
    dealt = stored.select(F.pmod(F.xxhash64("row"), F.lit(chunks)).alias("chunk"), "doc_id", "text", "counted", "scored")
    ids = dealt.where("counted and doc_id is not null").select("chunk", "doc_id").distinct().join(models.good, "doc_id", "left_semi")
    good = ids.select(F.col("chunk").alias("of"), F.col("doc_id").alias("good"))
    asked = dealt.groupBy("chunk").cogroup(good.groupBy("of")).applyInArrow(_ask(parts), _ASKED)
    told = asked.groupBy("part").applyInArrow(_tell, _TOLD)

    def make(docs: pa.Table, told: pa.Table) -> pa.Table:
        chunk, told = _Chunk(docs), told.sort_by("part")
        some = chunk.n_words > 0
        first = (np.cumsum(chunk.n_words) - chunk.n_words)[some]
        means = []
        for model in ("target", "background"):
            mean = np.zeros(len(some))
            if some.any():
                mean[some] = np.add.reduceat(_losses(chunk, told, model), first) / chunk.n_words[some]
            means.append(mean)
        values = [pa.array(np.round(x, 9), mask=~some) for x in (*means, means[0] - means[1])]
        columns = [docs["doc_id"], pa.array(chunk.n_words, pa.int64()), *values]
        return pa.table(columns, schema.names).filter(docs["scored"])

    return dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(make, schema)
