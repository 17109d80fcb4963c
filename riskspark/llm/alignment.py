"""Alignment of the tokens of two tokenizers over the same text.

A text is encoded by a byte-level vocabulary (A, over a space and the text) and by a piece
vocabulary (B, which adds the space itself). Both lists of ids lie over the same bytes.

1. Per document, the ends of the tokens, cumulated, are the keys of a dictionary from end to
   index, one per tokenizer. The intersection of the key sets, sorted, are the places where
   both end; consecutive ones slice both lists into groups. Inside a group the tokens that
   overlap are linked. Documents are aligned whole, in runs of about a megabyte.
2. Documents are gathered into chunks of bounded size. A chunk numbers its distinct id pairs
   and counts the documents that hold each; a document keeps the numbers of its pairs and how
   often it links them. One aggregate over the chunks' pairs gives the corpus-wide counts,
   and the highest of each A id.
3. The counts go back to the chunks, a row per pair and chunk and not per document, and each
   document adds up those of its own links.

No task holds more than a chunk and its pairs, whatever the size of the corpus; a pair that
occurs everywhere is a row per chunk, added up before it is shuffled.

Cases: a null or empty text has no tokens, and neither has one whose bytes do not come back
from both token lists (B may not know a character as it stands, such as U+2581): all counts
are 0 and the digest is the empty string. Strings of special tokens are plain text. Every row
is a document, also one with a null or a repeated doc_id. An empty table gives an empty
result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import materialise
from riskspark.llm.text import slices
from riskspark.llm.tokens import tokenizer_path

#: A chunk of documents ends with the document that fills it: bytes of text.
CHUNK = 8 << 20
#: Texts up to this character go to the faster of two encoders of vocabulary A.
LAST_PLAIN = "ɏ"
#: How vocabulary A splits a text: the published pattern of its kind (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words remembered per Python worker with their pieces; then it starts anew.
REMEMBERED = 300_000
_WORD = re.compile(r" +[^ ]*")
_KNOWN: dict[tuple[str, str], Aligner] = {}


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path_a)
        self.library.encode_special_tokens = True
        alphabet = _byte_alphabet()
        with open(path_a, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocabulary = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items()}
        if any(bytes([x]) not in vocabulary for x in range(256)):
            raise ValueError("vocabulary A lacks bytes")
        self.bytes_a = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            self.bytes_a[i] = token
        # Where merges come in the order of ids, ids are ranks, and an encoder of ranks gives the same ids.
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        by_rank = all(model["vocab"][m] == 256 + k for k, m in enumerate(merged)) and len(vocabulary) == 256 + len(merged)
        self.ranks = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=vocabulary, special_tokens={}) if by_rank else None
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.length_a, self.length_b = (np.array([len(x) for x in b], np.int64) for b in (self.bytes_a, self.bytes_b))
        # the ids as text with what follows them: within a side, or at its end
        self.told_a, self.told_b = (self._told(len(known), end) for known, end in ((self.bytes_a, b"|"), (self.bytes_b, b";")))
        # No piece holds a space after something else, so what lies between such places is encoded by itself.
        self.by_word = not any(" " in x.lstrip(" ") for x in (self.pieces.id_to_piece(i).replace("▁", " ") for i in range(len(self.bytes_b))))
        self.space = self.pieces.piece_to_id("▁")
        self.words: dict[str, list[int] | None] = {}

    @staticmethod
    def _told(n: int, end: bytes) -> np.ndarray:
        table = np.empty((2, n), object)
        table[0] = [b"%d," % i for i in range(n)]
        table[1] = [b"%d%s" % (i, end) for i in range(n)]
        return table

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def encode_a(self, text: str) -> list[int]:
        if self.ranks is not None and max(text) <= LAST_PLAIN:
            return self.ranks.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids

    def _same(self, ids: list[int], text: str) -> bool:
        return b"".join(map(self.bytes_b.__getitem__, ids)) == text.encode()

    def _learn(self, words: set[str]) -> None:
        new = words.difference(self.words)
        if len(self.words) + len(new) > REMEMBERED:
            self.words.clear()
            new = words
        told = [w for w in new if w != " "]
        for w, ids in zip(told, self.pieces.encode([w[1:] for w in told], num_threads=1), strict=True):
            self.words[w] = ids if self._same(ids, w) else None
        self.words[" "] = [self.space] if self._same([self.space], " ") else None

    def _encode_b(self, wholes: list[str]) -> list[list[int] | None]:
        """The ids of texts that begin with the space B adds; None where the bytes do not come back."""
        if not self.by_word:
            found = self.pieces.encode([w[1:] for w in wholes], num_threads=1)
            return [ids if self._same(ids, w) else None for w, ids in zip(wholes, found, strict=True)]
        cut = [_WORD.findall(w) for w in wholes]
        self._learn(set(chain.from_iterable(cut)))
        found = []
        for words in cut:
            ids = list(map(self.words.__getitem__, words))
            found.append(None if None in ids else list(chain.from_iterable(ids)))
        return found

    def tokens(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """The ids of each text by A and by B; none where the bytes do not come back."""
        wholes = [" " + t for t in texts if t]
        of_b = iter(self._encode_b(wholes))
        found = []
        for text in texts:
            b = next(of_b) if text else None
            a = self.encode_a(" " + text) if b is not None else None
            # vocabulary A has every byte, and joins bytes only
            found.append(([], []) if a is None else (a, b))
        return found


def aligner(paths: tuple[str, str]) -> Aligner:
    """The two tokenizers of this Python worker, loaded once."""
    if paths not in _KNOWN:
        _KNOWN[paths] = Aligner(*paths)
    return _KNOWN[paths]


def common_ends(end_a: list[int], end_b: list[int]) -> tuple[np.ndarray, ...]:
    """How many tokens of A, and of B, lie before each place where tokens of both end."""
    index_a, index_b = (dict(zip(ends, range(1, len(ends) + 1), strict=True)) for ends in (end_a, end_b))
    both = sorted(index_a.keys() & index_b.keys())
    return tuple(np.array([*map(index.__getitem__, both)], np.int64) for index in (index_a, index_b))


class Aligned:
    """One document: its groups' digest, and its links as pairs of ids."""

    def __init__(self, both: Aligner, a: list[int], b: list[int]):
        ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
        end_a, end_b = np.cumsum(both.length_a[ids_a]), np.cumsum(both.length_b[ids_b])
        cut_a, cut_b = common_ends(end_a.tolist(), end_b.tolist())
        self.n_groups = len(cut_a)
        self.digest = self._digest(both, ids_a, ids_b, cut_a, cut_b)
        # A token of A overlaps the tokens of B from the first that ends after its start to the first
        # that ends at or after its end; both lie in its own group, whose bounds are ends of both.
        first = np.searchsorted(end_b, end_a - both.length_a[ids_a], side="right")
        last = np.searchsorted(end_b, end_a, side="left")
        times = last - first + 1
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        self.links = (np.repeat(ids_a, times) << 32) | ids_b[np.repeat(first, times) + within]

    @staticmethod
    def _digest(both: Aligner, ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> str:
        if not len(cut_a):
            return ""
        told = np.empty(len(ids_a) + len(ids_b), object)
        # in a group the tokens of A come before those of B
        before = np.concatenate([[0], cut_b[:-1]]), cut_a
        for table, ids, cuts, others in ((both.told_a, ids_a, cut_a, before[0]), (both.told_b, ids_b, cut_b, before[1])):
            last = np.zeros(len(ids), np.int8)
            last[cuts - 1] = 1
            told[np.arange(len(ids)) + np.repeat(others, np.diff(cuts, prepend=0))] = table[last, ids]
        return hashlib.sha256(b"".join(told.tolist())[:-1]).hexdigest()


def _packed(number: np.ndarray, times: np.ndarray) -> bytes:
    """Rising pair numbers as steps, and how often each is linked; high bytes, mostly 0, lie together."""
    both = np.concatenate([np.diff(number, prepend=0), times]).astype("<u4")
    return both.view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


def _chunked(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Rows of two kinds, per chunk: its documents, and its distinct pairs with the documents that hold each."""
    of_doc = T.StructType([docs.schema["doc_id"]])
    for c in ("n_a", "n_b", "n_groups", "n_links"):
        of_doc.add(c, "long")
    of_doc.add("groups_sha256", "string").add("pairs", "binary")
    schema = T.StructType().add("chunk", "long").add("number", "integer").add("a", "integer").add("b", "integer").add("held", "integer")
    schema = T.StructType([*schema, *of_doc])
    numbered = ["chunk", "number", "a", "b", "held"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        both, n_chunks = aligner(paths), 0
        arrow = None
        ids: list[pa.Array] = []
        rows: list[tuple] = []
        links: list[np.ndarray] = []  # distinct pairs of each document, and
        times: list[np.ndarray] = []  # how often it links them
        size = 0

        def chunk() -> Iterator[pa.RecordBatch]:
            own = TaskContext.get().partitionId() << 32 | n_chunks
            pairs, place, held = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
            bounds = np.cumsum([0, *map(len, links)])
            packed = [_packed(place[x:y], t) for x, y, t in zip(bounds[:-1], bounds[1:], times, strict=True)]
            columns = {"chunk": np.full(len(pairs), own), "number": np.arange(len(pairs), dtype=np.int32), "a": (pairs >> 32).astype(np.int32),
                       "b": (pairs & 0xFFFFFFFF).astype(np.int32), "held": held.astype(np.int32)}
            yield filled({c: pa.array(v) for c, v in columns.items()}, len(pairs))
            found = {"chunk": pa.array(np.full(len(rows), own)), "doc_id": pa.concat_arrays(ids), "pairs": pa.array(packed, pa.binary())}
            found |= {c: pa.array([r[k] for r in rows], pa.int64()) for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
            yield filled(found | {"groups_sha256": pa.array([r[4] for r in rows], pa.string())}, len(rows))

        def filled(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow)

        for batch in batches:
            if arrow is None:
                kinds = {"number": pa.int32(), "a": pa.int32(), "b": pa.int32(), "held": pa.int32(), "doc_id": batch.schema.field("doc_id").type,
                         "groups_sha256": pa.string(), "pairs": pa.binary()}
                arrow = pa.schema([(f.name, kinds.get(f.name, pa.int64())) for f in schema])
            for part in slices(batch, most=1 << 19):
                texts = part["text"].to_pylist()
                ids.append(part["doc_id"])
                for a, b in both.tokens(texts):
                    doc = Aligned(both, a, b)
                    pairs, n = np.unique(doc.links, return_counts=True)
                    links.append(pairs)
                    times.append(n)
                    rows.append((len(a), len(b), doc.n_groups, len(doc.links), doc.digest))
                size += sum(len(t) for t in texts if t) + 64 * len(texts)
                if size >= CHUNK:
                    yield from chunk()
                    ids, rows, links, times, size, n_chunks = [], [], [], [], 0, n_chunks + 1
        if rows:
            yield from chunk()

    found = docs.select("doc_id", "text").mapInArrow(run, schema)
    return found.select(*numbered, *of_doc.names)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """a, b, count (documents that hold the pair linked) and best (whether no other b of a has more)."""
    counts = materialise(pairs.groupBy("a", "b").agg(F.sum("held").alias("count")), "pair_counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    paths = (path_a or tokenizer_path("byte_bpe_50k.json"), path_b or tokenizer_path("piece_bpe_32k.model"))
    chunked = materialise(_chunked(docs, paths), "aligned")
    pairs = chunked.where("number is not null").select("chunk", "number", "a", "b", "held")
    known = pairs.drop("held").join(pair_counts(pairs), ["a", "b"]).select(F.col("chunk").alias("of_chunk"), "number", "count", "best")
    told = ["n_a", "n_b", "n_groups", "n_links"]
    of_docs = chunked.where("number is null").select("chunk", "doc_id", *told, "groups_sha256", "pairs")
    result = T.StructType([docs.schema["doc_id"]])
    for c in (*told, "n_best", "count_sum"):
        result.add(c, "long")
    result.add("groups_sha256", "string")

    def add_up(rows: pa.Table, counts: pa.Table) -> pa.Table:
        count, best = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, np.int64)
        number = counts["number"].to_numpy()
        count[number], best[number] = counts["count"].to_numpy(), counts["best"].to_numpy()
        n_best, total = [], []
        for data in rows["pairs"].to_pylist():
            which, times = _unpacked(data)
            n_best.append(int(times @ best[which]))
            total.append(int(times @ count[which]))
        columns = [rows["doc_id"], *(rows[c] for c in told), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), rows["groups_sha256"]]
        return pa.Table.from_arrays(columns, result.names)

    return of_docs.groupBy("chunk").cogroup(known.groupBy("of_chunk")).applyInArrow(add_up, result)
