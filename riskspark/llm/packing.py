"""Packing documents into token sequences, first-fit decreasing.

Documents are dealt at random into groups of about ``GROUP_BYTES`` of text, and each group
is packed on its own. Every full run of ``length`` ids of a document is a sequence; the
rests go, longest first, each into the first open sequence with room for it. A tournament
tree over the rooms of the sequences finds that one in logarithmic time. In the end the
emptiest sequences of a group are dealt out, cut as needed, to fill the rooms of at least
``LEAST_PIECE`` ids that others still have; so padding is a few ids in some sequences and
one part-filled sequence per group.

Cases: a null or empty text is the end id alone. A null doc_id is packed as any other.
Repeated rows are packed once each; groups do not depend on ids or texts alone, so that
neither lands in one group. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import give_back, released
from riskspark.llm.tokens import encoder, runs, tokenizer_path

LENGTH = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Text per group, on average, and documents per group at most, on average.
GROUP_BYTES, GROUP_DOCS = 8 << 20, 4096
#: A room smaller than this is padded rather than filled with a cut.
LEAST_PIECE = 8


def tokenised(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of a partition's rows, and the ids of each row's text, end id included."""
    tool = encoder(path)
    end = np.array([end_id], tool.dtype).tobytes()
    for part in runs(batches):
        yield part, [x + end for x in tool.encode(part["text"])]


def tokenise(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """The rows with their text replaced by ids, end id included, as bytes in column ids."""
    rest = [f for f in docs.schema if f.name != "text"]
    schema = T.StructType([*rest, T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids in tokenised(batches, path, end_id):
            yield pa.RecordBatch.from_arrays([*(part[f.name] for f in rest), pa.array(ids, pa.binary())], schema.names)

    return docs.mapInArrow(released(run), schema)


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each item, fill of each bin). Sizes are at most ``room``.

    ``tree`` holds the largest room below each node; its leaves are the bins, in order of
    opening, and bins not opened yet are empty ones.
    """
    leaves = 1 << max(0, int(len(sizes) - 1).bit_length())
    tree = [room] * (2 * leaves)
    into = np.zeros(len(sizes), np.int64)
    for item in np.argsort(-sizes, kind="stable"):
        size, node = int(sizes[item]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        into[item] = node - leaves
        tree[node] -= size
        while node > 1:
            node //= 2
            largest = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == largest:
                break
            tree[node] = largest
    fill = room - np.array(tree[leaves:], np.int64)
    return into, fill[: int(into.max()) + 1 if len(into) else 0]


def layout(n_ids: np.ndarray, length: int, least: int = LEAST_PIECE) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a group of documents."""
    pieces = [(d, k * length, length, -1, 0) for d, n in enumerate(n_ids) for k in range(n // length)]
    pieces = [(d, start, n, s, 0) for s, (d, start, n, _, _) in enumerate(pieces)]
    base = len(pieces)
    owner = np.flatnonzero(n_ids % length)
    sizes = n_ids[owner] % length
    into, fill = first_fit_decreasing(sizes, length)
    held: list[list[tuple[int, int, int]]] = [[] for _ in fill]
    for d, size, b in zip(owner, sizes, into, strict=True):
        held[b].append((int(d), int(n_ids[d] - size), int(size)))
    by_fill = [int(b) for b in np.argsort(-fill, kind="stable")]
    room = [length - int(x) for x in fill]
    low, high = 0, len(by_fill) - 1
    while low < high:
        b, giver = by_fill[low], by_fill[high]
        if room[b] < least:
            low += 1
        elif not held[giver]:
            high -= 1
        else:
            d, start, size = held[giver].pop()
            take = min(size, room[b])
            held[b].append((d, start, take))
            room[b] -= take
            if take < size:
                held[giver].append((d, start + take, size - take))
    for seq, b in enumerate(b for b in by_fill if held[b]):
        offset = 0
        for d, start, size in held[b]:
            pieces.append((d, start, size, base + seq, offset))
            offset += size
    return pieces


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``with_ids`` adds the ids of the piece as little-endian unsigned 32-bit integers.
    ``tokenizer`` is the path of a tokenizer file.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)
    docs = docs.select("doc_id", "text")
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    groups = max(1, -(-size // GROUP_BYTES), -(-n // GROUP_DOCS))
    dealt = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(groups)).alias("group")
    rows = tokenise(docs.select("doc_id", "text", dealt), path, end_id)
    fields = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in fields]])
    if with_ids:
        schema = schema.add("ids", "binary")

    def run(key: tuple, group: pa.Table) -> pa.Table:
        dtype = encoder(path).dtype
        ids = [np.frombuffer(x, dtype) for x in group["ids"].to_pylist()]
        n_ids = np.array([len(x) for x in ids])
        out = layout(n_ids, length)
        raw = [ids[d][start : start + size].astype("<u4").tobytes() for d, start, size, _, _ in out]
        which, start, size, seq, offset = (np.array(x, np.int64) for x in zip(*out, strict=True))
        columns = [start, size, np.array([zlib.crc32(x) for x in raw]), n_ids[which], (key[0].as_py() << 32) + seq, offset]
        columns = [group["doc_id"].combine_chunks().take(pa.array(which)), *(pa.array(c, pa.int64()) for c in columns)]
        packed = pa.Table.from_arrays([*columns, *([pa.array(raw, pa.binary())] if with_ids else [])], schema.names)
        del ids, raw, out
        give_back()
        return packed

    return rows.groupBy("group").applyInArrow(run, schema)
