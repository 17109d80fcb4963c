"""Token-id files coded by an adaptive context-mixing range coder, and their reader.

A file holds the ids of a run of documents, in blocks of ``BLOCK`` ids. Blocks are coded
independently: models start anew in each, and each has its own length and checksum. All
blocks of a file are coded side by side, one id of each per step, with numpy; so the coder
has a loop over the positions of a block, not over ids.

Three predictions are mixed for every id:

* order 2: the id that came last after the two ids before;
* order 1: the id that came last after the id before;
* order 0: adaptive frequencies of classes of ids. A class holds ids of similar rank in the
  file's frequency order (half an octave of ranks), the place in it is coded evenly. A block
  begins with the frequencies of the whole file and moves them on after every 16 ids.

Orders 2 and 1 keep, per context, how often they have been right lately; per such
confidence, and whether both agree, the block learns how far to trust them. The trust in
order 2 takes its share of the probability, order 1 takes its share of the rest, order 0
gets what is left. The mixture drives one 64-bit range coder per block, which gives out words
of 32 bits and carries into those given out.

File: magic, header (JSON: ids, blocks, documents, first frequencies), the ids by rank, the
documents (ids, whether null, and lengths), per block its length and crc32, then the coded words.
Everything is integer arithmetic (one quotient of small integers is taken in double precision,
where its floor is exact), so files are the same on every machine.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import filesystem, materialise, new_folder, uri, write_once
from riskspark.llm.packing import tokenised
from riskspark.llm.tokens import encoder, tokenizer_path

MAGIC = b"IDRC0002"
TOKENIZER, END_ID = "byte_bpe_50k.json", 2
BLOCK = 512
#: Blocks coded side by side at most; bounds the models' memory.
LANES = 8192
#: Text per file, on average.
FILE_BYTES = 8 << 20

_TABLE_BITS = 9  # a block has no more contexts than ids
_ONE = 1 << 16
_CDF_BITS = 14
_CLASSES = 40
_EVERY, _LEAST, _RATE = 16, 16, 3  # ids between moves of the frequencies, the least one, and how far they move
_MOST_TRUST = 48_900  # both orders together leave a sixteenth to order 0
_RANK_BITS = 17
_U = np.uint64


def _class_table(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each rank, first rank of each class, bits of the place in each class)."""
    if n >= 1 << _RANK_BITS:
        raise ValueError("a file holds fewer than 131,072 different ids")
    first, bits = [0, 1], [0, 0]
    octave = 1
    while first[-1] + (1 << bits[-1]) < n and len(first) < _CLASSES:
        for _ in range(2):
            first.append(first[-1] + (1 << bits[-1]))
            bits.append(octave - 1)
        octave += 1
    first, bits = np.array(first[:_CLASSES], np.int32), np.array(bits[:_CLASSES], np.int32)
    return (np.searchsorted(first, np.arange(max(n, 1)), side="right") - 1).astype(np.int32), first, bits


def _frequencies(times: np.ndarray) -> np.ndarray:
    """Cumulative frequencies of classes that come so many times, of 16,384."""
    steps = np.arange(len(times) + 1)
    free = (1 << _CDF_BITS) - _LEAST * len(times)
    return steps * _LEAST + np.append(0, np.cumsum(times)) * free // max(1, int(times.sum())) if times.any() else (steps << _CDF_BITS) // len(times)


class _Models:
    """The adaptive models of a number of blocks; encoder and decoder take the same steps.

    Row 0 of each pair of arrays belongs to order 2, row 1 to order 1.
    """

    def __init__(self, lanes: int, cdf: np.ndarray):
        size, classes = 2 << _TABLE_BITS, len(cdf) - 1
        self.rows = np.arange(lanes, dtype=np.int64)
        # per context: the rank + 1 that came last, and in the upper bits the confidence in it. The id
        # before chooses a line of 16 entries, 8 for each order, so that both lie in one line of the cache
        self.table = np.zeros(lanes * size + 16, np.int32)
        self.table = self.table[-self.table.ctypes.data // 4 % 16 :][: lanes * size]
        self.base = np.arange(lanes, dtype=np.int32) * np.int32(size)
        self.key = np.stack([self.base + np.int32(8), self.base]).astype(np.int64)
        self.trust = np.full(2 * lanes * 16, 1 << 13, np.int32)
        self.trust_base = (np.arange(2 * lanes, dtype=np.int32) * 16).reshape(2, lanes)
        self.lanes = lanes
        self.cdf = np.repeat(cdf.astype(np.int16)[:, None], lanes, axis=1)
        self.low, self.high = self.cdf.ravel(), self.cdf[1:].ravel()  # views: below and above each class
        self.least = (np.arange(1, classes + 1, dtype=np.int16) * np.int16(_LEAST))[:, None]
        self.share = np.int16(((1 << _CDF_BITS) - _LEAST * classes) // _EVERY)
        self.times, self.n_seen = np.zeros((classes, lanes), np.int16), 0
        self.before = np.zeros(lanes, np.int32)

    def predict(self) -> None:
        """Set the predicted ranks + 1 (0: none) and the shares of the mixture, of 65,536."""
        found = self.table.take(self.key)
        self.guess, self.conf = found & np.int32((1 << _RANK_BITS) - 1), found >> _RANK_BITS
        agree = (self.guess[0] == self.guess[1]).astype(np.int32)
        self.trust_key = (self.trust_base + (self.conf << 1) + agree).astype(np.int64)
        self.told = self.trust.take(self.trust_key)
        a2, a1 = self.told * np.minimum(self.guess, 1)
        share1 = ((_ONE - a2) * (a1 >> 1)) >> 15
        self.w2 = a2 + share1 * agree
        self.head = a2 + share1
        self.rest = _ONE - self.head

    def interval(self, at: np.ndarray, by2: np.ndarray, by1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each block's choice begins, and its share: the class in ``at``, or in blocks ``by2`` and ``by1`` that order."""
        start = self.head + (self.rest * self.low.take(at) >> _CDF_BITS)
        share = self.head + (self.rest * self.high.take(at) >> _CDF_BITS) - start
        start[by2], share[by2] = 0, self.w2[by2]
        start[by1], share[by1] = self.w2[by1], self.head[by1] - self.w2[by1]
        return start.astype(_U), share.astype(_U)

    def right(self, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """In which blocks order 2 foretold the ranks + 1, in which others order 1, and both orders' places."""
        hit = self.guess == r
        by2, by1 = np.flatnonzero(hit[0]), np.flatnonzero(hit[1])
        return by2, by1[~hit[0].take(by1)], np.concatenate([by2, by1 + self.lanes])

    def learn(self, r: np.ndarray, at: np.ndarray, right: np.ndarray) -> None:
        """Take in the ranks + 1 that came, the places of their classes and which orders were right."""
        # few orders are right, so these are set one by one after all others
        told = self.told + ((np.int32(300) - self.told) >> 4)
        was = self.told.ravel()[right]
        told.ravel()[right] = was + ((np.int32(_MOST_TRUST) - was) >> 4)
        self.trust[self.trust_key] = told
        conf = (self.conf >> 1).ravel()
        conf[right] = np.minimum(self.conf.ravel()[right] + 1, 7)
        entry = np.concatenate([r, r])
        stays = np.flatnonzero(conf > 0)
        entry[stays] = self.guess.ravel()[stays] | (conf[stays] << _RANK_BITS)
        self.table[self.key] = entry.reshape(2, -1)
        times = self.times.ravel()
        times[at] = times.take(at) + np.int16(1)
        self.n_seen += 1
        if self.n_seen == _EVERY:
            for lower, upper in zip(self.times, self.times[1:]):  # to sums, row by row
                upper += lower
            self.cdf[1:] += (self.times * self.share + self.least - self.cdf[1:]) >> _RATE
            self.times[:] = 0
            self.n_seen = 0
        spread = r * np.int32(40503)
        one = (spread >> 4) & np.int32((1 << _TABLE_BITS) - 1)
        line = self.base + ((one >> 3) << 4)
        two = ((spread + self.before * np.int32(30011)) >> 5) & np.int32(7)
        self.key[0], self.key[1] = line + two + np.int32(8), line + (one & np.int32(7))
        self.before = r


def _carry(out: np.ndarray, at: np.ndarray) -> None:
    """Add one to words given out, and to those before where that overflows."""
    while len(at):
        out[at] += np.uint32(1)
        at = at[out[at] == 0] - 1


def _encode_lanes(rank: np.ndarray, length: np.ndarray, tables: tuple, cdf: np.ndarray) -> list[bytes]:
    """Code blocks of ranks, a row per position and a column per block."""
    class_of, first, bits = tables
    steps, lanes = rank.shape
    m = _Models(lanes, cdf)
    # by rank: where its class begins among the frequencies, the bits of its place there, and the place
    base, bits_of = class_of * np.int64(lanes), bits[class_of].astype(_U)
    place_of = (np.arange(len(class_of)) - first[class_of]).astype(_U)
    low, width = np.zeros(lanes, _U), np.full(lanes, 2**64 - 1, _U)
    row = steps + 2  # at most a word per id, and the last
    out = np.zeros(lanes * row, "<u4")
    pos = m.rows * row
    ends = {int(n): np.flatnonzero(length == n) for n in np.unique(length)}
    done: list[bytes] = [b""] * lanes
    word = _U(32)
    for step in range(steps):
        r0 = rank[step].astype(np.int64)
        r = rank[step] + np.int32(1)
        m.predict()
        by2, by1, right = m.right(r)
        at = base.take(r0) + m.rows
        start, share = m.interval(at, by2, by1)
        b, place = bits_of.take(r0), place_of.take(r0)
        b[by2], b[by1], place[by2], place[by1] = 0, 0, 0, 0
        width >>= _U(16)
        more = start * width
        width *= share
        width >>= b
        more += place * width
        low += more
        over = np.flatnonzero(low < more)
        if len(over):
            _carry(out, pos[over] - 1)
        full = np.flatnonzero(width < _U(1 << 32))
        p, l = pos[full], low[full]
        out[p] = l >> word
        pos[full] = p + 1
        low[full] = l << word
        width[full] <<= word
        m.learn(r, at, right)
        if step + 1 in ends:  # blocks end: the least number of one word in what is left
            at = ends[step + 1]
            last = low[at] + _U((1 << 32) - 1)
            _carry(out, pos[at[last < low[at]]] - 1)
            out[pos[at]] = last >> word
            for i, end in zip(at.tolist(), (pos[at] + 1).tolist(), strict=True):
                done[i] = out[i * row : end].tobytes()
    return done


def _decode_lanes(words: list[bytes], steps: int, tables: tuple, cdf: np.ndarray) -> np.ndarray:
    """The ranks of blocks coded by ``_encode_lanes``, a row per position."""
    class_of, first, bits = tables
    lanes = len(words)
    m = _Models(lanes, cdf)
    row = max(steps + 2, max(len(w) for w in words) // 4)
    data = np.zeros((lanes, row), np.uint32)
    for i, w in enumerate(words):
        data[i, : len(w) // 4] = np.frombuffer(w, "<u4", len(w) // 4)
    data, pos = data.ravel(), m.rows * row + 2
    code = data[pos - 2].astype(_U) << _U(32) | data[pos - 1]
    width = np.full(lanes, 2**64 - 1, _U)
    rank = np.zeros((steps, lanes), np.int32)
    most = np.int32(len(class_of))
    base, bits_of, first_of = class_of * np.int64(lanes), bits.astype(_U), first + np.int32(1)
    for step in range(steps):
        m.predict()
        width >>= _U(16)
        value = np.minimum(code // width, _U(_ONE - 1)).astype(np.int32)
        hit2 = value < m.w2
        by2, by1 = np.flatnonzero(hit2), np.flatnonzero((value < m.head) > hit2)
        # the last class whose start, head + (rest * cdf >> bits), is not above the value
        upto = ((np.maximum(value - m.head, 0) + 1 << _CDF_BITS) - 1) / m.rest
        cls = (m.cdf[1:-1] <= upto.astype(np.int16)).view(np.int8).sum(axis=0, dtype=np.int8).astype(np.int64)
        start, share = m.interval(cls * lanes + m.rows, by2, by1)
        code -= start * width
        width *= share
        b = bits_of.take(cls)
        b[by2], b[by1] = 0, 0
        width >>= b
        place = np.minimum(code // width, (_U(1) << b) - _U(1))
        code -= place * width
        r = first_of.take(cls) + place.astype(np.int32)
        r[by2], r[by1] = m.guess[0][by2], m.guess[1][by1]
        r = np.minimum(r, most)  # only a block past its end can exceed it
        full = np.flatnonzero(width < _U(1 << 32))
        p = pos[full]
        code[full] = code[full] << _U(32) | data[p]
        pos[full] = p + 1
        width[full] <<= _U(32)
        rank[step] = r - 1
        m.learn(r, base.take(rank[step]) + m.rows, m.right(r)[2])
    return rank


def encode_file(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A file of the ids of consecutive documents."""
    count = np.bincount(ids, minlength=1)  # ids are below the vocabulary's size
    kinds = np.flatnonzero(count)
    by_rank = kinds[np.argsort(-count[kinds], kind="stable")].astype("<u4")
    rank_of = np.zeros(len(count), np.int32)
    rank_of[by_rank] = np.arange(len(kinds))
    tables = _class_table(len(kinds))
    cdf = _frequencies(np.bincount(tables[0], np.append(count[by_rank], np.zeros(len(tables[0]) - len(kinds))), len(tables[1])).astype(np.int64))
    n_blocks = -(-len(ids) // block)
    size = np.full(n_blocks, block)
    if n_blocks:
        size[-1] = len(ids) - block * (n_blocks - 1)
    words: list[bytes] = []
    ranks = np.zeros(n_blocks * block, np.int32)
    rank_of.take(ids, out=ranks[: len(ids)], mode="clip")
    ranks = ranks.reshape(-1, block)
    for at in range(0, n_blocks, LANES):
        part = size[at : at + LANES]
        words += _encode_lanes(np.ascontiguousarray(ranks[at : at + LANES, : int(part.max())].T), part, tables, cdf)
    wide = ids.astype("<u4")
    crc = [zlib.crc32(wide[k * block : k * block + n]) for k, n in enumerate(size.tolist())]
    docs = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + bytes(d is None for d in doc_ids) + lengths.astype("<i8").tobytes()
    docs = zlib.compress(docs)
    head = json.dumps({"ids": len(ids), "kinds": len(kinds), "block": block, "docs": len(doc_ids), "doc_bytes": len(docs), "cdf": cdf.tolist()}).encode()
    index = b"".join(struct.pack("<III", n, len(w), c) for n, w, c in zip(size, words, crc, strict=True))
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, by_rank.tobytes(), docs, index, *words])


def decode_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, lengths, ids) of a file; a damaged block raises ValueError."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    (n,) = struct.unpack_from("<I", data, 8)
    head, at = json.loads(data[12 : 12 + n]), 12 + n
    by_rank = np.frombuffer(data, "<u4", head["kinds"], at)
    at += 4 * head["kinds"]
    docs = zlib.decompress(data[at : at + head["doc_bytes"]])
    at += head["doc_bytes"]
    k = head["docs"]
    doc_ids = [None if null else int(d) for d, null in zip(np.frombuffer(docs, "<i8", k), docs[8 * k : 9 * k], strict=True)]
    lengths = np.frombuffer(docs, "<i8", k, 9 * k)
    n_blocks = -(-head["ids"] // head["block"])
    index = [struct.unpack_from("<III", data, at + 12 * i) for i in range(n_blocks)]
    at += 12 * n_blocks
    words = []
    for _, size, _ in index:
        words.append(data[at : at + size])
        at += size
    tables, out = _class_table(head["kinds"]), []
    for low in range(0, n_blocks, LANES):
        size = np.array([x[0] for x in index[low : low + LANES]])
        ranks = _decode_lanes(words[low : low + LANES], int(size.max()), tables, np.array(head["cdf"]))
        for row, (n, _, crc) in zip(by_rank.take(np.ascontiguousarray(ranks.T)), index[low : low + LANES], strict=True):
            block = row[:n]
            if zlib.crc32(block) != crc:
                raise ValueError(f"block {len(out)} is damaged")
            out.append(block)
    return doc_ids, lengths, np.concatenate(out) if out else np.zeros(0, "<u4")


def write(docs: DataFrame, folder: str, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """Write the ids of all documents, in ascending order of doc_id, one file per partition.

    Returns part, path, n_docs and n_ids of every file; the parts are in that order.
    Null ids come first; rows of one id follow their text's hash. Ranges are cut by both,
    so that a repeated id does not end up in one file.
    """
    spark = docs.sparkSession
    path, folder = tokenizer or tokenizer_path(TOKENIZER), uri(spark, folder)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("turn"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // FILE_BYTES))
    ranged = docs.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "turn")
    ranged = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "turn", "text")
    rows = ranged.select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(path).dtype
        doc_ids, lengths, ids, part = [], [], [], None
        for batch, found in tokenised(batches, path, end_id):
            if batch.num_rows:
                part = batch["part"][0].as_py()
                doc_ids += batch["doc_id"].to_pylist()
                lengths += [len(x) // dtype.itemsize for x in found]
                ids.append(np.frombuffer(b"".join(found), dtype))
        if part is None:
            return
        ids = np.concatenate(ids)
        files, at = filesystem(folder)
        files.create_dir(at, recursive=True)
        name = f"part-{part:06d}.ids"
        write_once(files, f"{at}/{name}", encode_file(doc_ids, np.array(lengths), ids))
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "path": f"{folder}/{name}", "n_docs": len(doc_ids), "n_ids": len(ids)}], schema=arrow
        )

    arrow = pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
    return materialise(rows.mapInArrow(run, "part int, path string, n_docs long, n_ids long"), "token-files")


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files, from the files alone."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    placed = files.select("part", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    n = max(1, files.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                source, at = filesystem(row["path"])
                with source.open_input_stream(at, compression=None) as f:
                    doc_ids, lengths, ids = decode_file(f.read())
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - k : e].tobytes()) for e, k in zip(ends, lengths, strict=True)]
                columns = [pa.array(doc_ids, pa.int64()), *(pa.array(c, pa.int64()) for c in (row["base"] + ends - lengths, lengths, crc))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    dealt = placed.repartition(n, "part") if n == 1 else placed.repartitionByRange(n, "part")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame) -> DataFrame:
    """Write the documents' ids to files in the shared folder and read them back."""
    return read(write(docs, new_folder(docs.sparkSession, "ids")))
