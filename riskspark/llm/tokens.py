"""Token ids of many texts through the tokenizers library, each distinct chunk encoded once.

Both vocabularies split a text by a pattern before they merge anything. No piece of that
pattern reaches over certain places: before white space that follows something else, after
a line break with something else on both sides, between a letter and a mark of punctuation. Cut
there, a text falls into chunks whose ids are simply put together, and most chunks have
been seen before. Arrow's dictionary encoding numbers the chunks of a run of texts, the distinct ones are found
among those remembered by their hashes and compared, and the ids of all are taken by number. A tokenizer with another way of splitting gets whole texts, and so does any
with a text that holds the string of an added token such as <|endoftext|>, in either case.

A chunk of Latin letters alone is one piece of the pattern, so it goes to the library's model
itself and not through its pattern and normaliser. All other chunks go through the whole library.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from riskspark.llm.text import raw, slices, span_hashes

#: Chunks remembered per Python worker; beyond so many, the half used last stays.
REMEMBERED = 800_000
#: New chunks are joined to texts of so many for the library.
JOINED = 500
#: Text whose chunks are numbered together, in bytes; a longer text comes alone.
RUN_BYTES = 1 << 20
#: Letters up to here are what both patterns and Python call letters, and no two of them compose.
LAST_LATIN = "\u024f"
_ENCODERS: dict[str, Encoder] = {}

_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The character that stands for each byte in a byte-level vocabulary.
_SHOWN = dict(zip([*_OWN, *(b for b in range(256) if b not in _OWN)], [*_OWN, *range(256, 512)], strict=False))

# What a byte can be, as bits.
_SPACE, _LETTER, _MARK, _BREAK, _ASCII, _END, _LEAD = (1 << k for k in range(7))


def _kinds() -> bytes:
    table = np.zeros(256, np.uint8)
    table[[32, *range(9, 14)]] |= _SPACE
    table[[*range(65, 91), *range(97, 123)]] |= _LETTER
    table[list(b",.!?;:%*$#&|")] |= _MARK
    table[10] |= _BREAK
    table[:128] |= _ASCII
    # white space beyond ASCII ends in these bytes, after one of those
    table[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] |= _END
    table[[0xC2, 0x80, 0x81, 0x9A]] |= _LEAD
    return table.tobytes()


_KINDS = _kinds()
# Bytes of letters that are surely one piece: ASCII, and U+00C0 to U+023F without the signs at U+00D7 and U+00F7.
_LATIN = np.zeros(256, bool)
_LATIN[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), *range(0xC3, 0xC9)]] = True


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, made once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Encoder:
    """``encode`` gives the ids of each text as little-endian bytes of type ``dtype``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        split = told["pre_tokenizer"] or {}
        kinds = [x["type"] for x in split.get("pretokenizers", [split])]
        rules = [x["type"] for x in (told["normalizer"] or {}).get("normalizers", [told["normalizer"]] if told["normalizer"] else [])]
        self.kind = "whole"
        if kinds == ["ByteLevel"] and split["use_regex"] and not split["add_prefix_space"] and not rules:
            self.kind = "spaced"  # a piece may begin with a space, but holds none further on
        elif kinds == ["Split", "ByteLevel"] and set(rules) <= {"NFC", "Replace", "Lowercase"} and split["pretokenizers"][0]["behavior"] == "Removed":
            self.kind = "unspaced"  # white space parts pieces and is dropped
        self.lowers = "Lowercase" in rules
        first = split["pretokenizers"][0]["pattern"].get("Regex", "") if self.kind == "unspaced" else ""
        ahead, letters, _ = first.partition(r"[\p{L}]+|")
        # nothing before the letters' own part of the pattern may begin with one
        self.by_word = self.kind == "spaced" or bool(letters) and all(x.startswith("'") for x in ahead.split("|")[:-1])
        self.added = [x["content"].encode().lower() for x in told.get("added_tokens") or []]
        # the chunks remembered, their ids, and the run that used each last; their hashes, sorted, and whose each is
        self.chunks = self.ids = pa.array([], pa.large_binary())
        self.used, self.runs = np.zeros(0, np.int64), 0
        self.hashes, self.owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        # what parts joined chunks, and its id: a line break is a piece of its own, and so is a digit
        self.part = "\n" if self.kind == "spaced" else " 0 "
        self.part_id = self.library.encode(self.part, add_special_tokens=False).ids[-1] if self.kind != "whole" else None

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _joins(self, chunk: str) -> bool:
        """Whether a chunk can be told apart again when joined with others."""
        rest = chunk[1:] if chunk[:1] == " " else chunk
        return rest != "" and rest.isprintable() and " " not in rest and "0" not in rest

    def _is_word(self, chunk: str) -> bool:
        """Whether a chunk is one piece that the normaliser leaves as it is."""
        rest = chunk[1:] if self.kind == "spaced" and chunk[:1] == " " else chunk
        return rest.isalpha() and (rest.isascii() or max(rest) <= LAST_LATIN) and not (self.lowers and rest != rest.lower())

    def _sure(self, chunks: list[bytes]) -> np.ndarray:
        """Which chunks are words by their bytes alone; others may be by ``_is_word``."""
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        body = np.frombuffer(b"".join(chunks), np.uint8)
        start = np.cumsum(size) - size
        odd = ~_LATIN[body]
        sign = (body[:-1] == 0xC3) & ((body[1:] == 0x97) | (body[1:] == 0xB7))
        odd[1:] |= sign
        if self.lowers:  # a-z, and U+00DF to U+00FF
            small = (body[1:] >= 0x9F) & (body[:-1] == 0xC3)
            odd |= (body >= 65) & (body <= 90) | (body > 0xC3)
            odd[1:] |= (body[1:] >= 0x80) & (body[1:] < 0xC0) & ~small
        if self.kind == "spaced":
            spaced = start[(body[start] == 32) & (size > 1)]
            odd[spaced] = False
        return ~np.logical_or.reduceat(odd, start)

    def _learn_words(self, words: list[bytes], memory: dict[bytes, bytes]) -> None:
        tokenize, ids, ends = self.library.model.tokenize, [], [0]
        for word in b"\xff".join(words).decode("latin-1").translate(_SHOWN).split("\xff"):
            ids += [x.id for x in tokenize(word)]
            ends.append(len(ids))
        data, width = np.array(ids, self.dtype).tobytes(), self.dtype.itemsize
        memory.update((c, data[a * width : b * width]) for c, a, b in zip(words, ends, ends[1:]))

    def _learn(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of distinct chunks, by the library."""
        memory: dict[bytes, bytes] = {}
        new = chunks
        if self.by_word:
            sure = self._sure(chunks).tolist()
            words = [c for c, w in zip(chunks, sure, strict=True) if w]
            rest = [c for c, w in zip(chunks, sure, strict=True) if not w]
            words += [c for c in rest if self._is_word(c.decode())]
            if words:
                self._learn_words(words, memory)
            new = [c for c in rest if c not in memory]
        new = [(c, c.decode()) for c in new]
        simple = [x for x in new if self._joins(x[1])]
        groups = [simple[k : k + JOINED] for k in range(0, len(simple), JOINED)]
        found = self.library.encode_batch_fast([self.part.join(t for _, t in g) for g in groups], add_special_tokens=False)
        width = self.dtype.itemsize
        for group, e in zip(groups, found, strict=True):
            ids = np.array(e.ids, self.dtype)
            cut = (np.flatnonzero(ids == self.part_id) * width).tolist()
            if len(cut) != len(group) - 1:
                raise ValueError("joined chunks do not come apart")
            data, low = ids.tobytes(), 0
            for (c, _), high in zip(group, [*cut, len(data)], strict=True):
                memory[c] = data[low:high]
                low = high + width
        other = [x for x in new if x[0] not in memory]
        memory.update(zip((c for c, _ in other), self._ids([t for _, t in other]), strict=True))
        return [memory[c] for c in chunks]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; null counts as empty."""
        if self.kind == "whole":
            return self._ids([t or "" for t in texts.to_pylist()])
        if not self._adds(raw(texts)[0].tobytes()):
            return self._chunked(texts)
        told = [t or "" for t in texts.to_pylist()]
        whole = [self._adds(t.encode()) for t in told]
        cut = self._chunked(pa.array(["" if w else t for t, w in zip(told, whole, strict=True)], pa.string()))
        rest = iter(self._ids([t for t, w in zip(told, whole, strict=True) if w]))
        return [next(rest) if w else x for x, w in zip(cut, whole, strict=True)]

    def _adds(self, text: bytes) -> bool:
        """Whether the string of an added token occurs."""
        text = text.lower()
        return any(x in text for x in self.added)

    def _chunked(self, texts: pa.Array) -> list[bytes]:
        body, offsets = raw(texts)
        if not len(body):
            return [b""] * (len(offsets) - 1)
        body, start, bounds = (self._spaced if self.kind == "spaced" else self._unspaced)(body, offsets)
        buffers = [None, pa.py_buffer(np.append(start, len(body))), pa.py_buffer(body)]
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), buffers)
        told = chunks.dictionary_encode()
        number, ids = self._numbers(told.dictionary)
        data, ends = raw(ids.take(pa.array(number[told.indices.to_numpy()])))
        data, ends = data.tobytes(), ends[bounds].tolist()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def _numbers(self, distinct: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Where the ids of distinct chunks lie in an array; new chunks are learned."""
        body, at = raw(distinct)
        own = span_hashes(body, at[:-1], at[1:])
        n = len(self.chunks)
        order = np.argsort(own)
        place = np.empty(len(own), np.int64)
        place[order] = np.searchsorted(self.hashes, own[order])  # in order, it stays in the cache
        held = np.append(self.hashes, np.uint64(0))[place] == own
        held &= place < len(self.hashes)
        number = np.append(self.owner, 0)[place]
        same = pc.equal(self.chunks.take(pa.array(number[held])), distinct.filter(pa.array(held)))
        clash = held.copy()  # equal hashes of different chunks: learned anew, not kept in order
        held[held] = same.to_numpy(zero_copy_only=False)
        new = np.flatnonzero(~held)
        number[new] = n + np.arange(len(new))
        self.runs += 1
        if len(new):
            chunks = distinct.take(pa.array(new))
            body, at = raw(chunks)
            found = self._learn(np.insert(body, at[1:-1], 0xFF).tobytes().split(b"\xff"))
            self.chunks, self.ids = pa.concat_arrays([self.chunks, chunks]), pa.concat_arrays([self.ids, pa.array(found, pa.large_binary())])
            self.used = np.append(self.used, np.zeros(len(new), np.int64))
            new = new[~clash[new]]
            new = new[np.argsort(own[new], kind="stable")]
            self.hashes, self.owner = np.insert(self.hashes, place[new], own[new]), np.insert(self.owner, place[new], number[new])
        self.used[number] = self.runs
        ids = self.ids
        if len(self.chunks) > REMEMBERED:
            last = np.sort(np.argsort(self.used, kind="stable")[-(REMEMBERED // 2) :])
            moved = np.full(len(self.chunks), -1)
            moved[last] = np.arange(len(last))
            stays = moved[self.owner] >= 0
            self.hashes, self.owner, self.used = self.hashes[stays], moved[self.owner[stays]], self.used[last]
            self.chunks, self.ids = self.chunks.take(pa.array(last)), self.ids.take(pa.array(last))
        return number, ids

    def _spaced(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes and where the chunks of all texts begin, white space at the head of what follows it; each text's first chunk."""
        kind = np.frombuffer(body.tobytes().translate(_KINDS), np.uint8)
        space = kind & _SPACE
        cut = np.zeros(len(body), bool)
        odd = (kind[1:-1] & _END).astype(bool) & (kind[:-2] & _LEAD).astype(bool)  # white space of another kind before
        cut[1:] = space[1:] > space[:-1]
        cut[2:] &= ~odd
        # a line break between other characters
        alone = (kind[1:-1] & _BREAK).astype(bool) & (kind[2:] & (_SPACE | _ASCII) == _ASCII) & (space[:-2] == 0)
        alone[1:] &= ~odd[:-1]
        cut[2:] |= alone
        cut[1:] |= (kind[:-1] & _LETTER).astype(bool) & (kind[1:] & _MARK).astype(bool)
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(cut)
        return body, start, np.searchsorted(start, offsets)

    def _unspaced(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for chunks without white space, in lower case where the tokenizer does that."""
        told = body.tobytes()
        kind = np.frombuffer(told.translate(_KINDS), np.uint8)
        if self.lowers:  # but not before a mark that might combine with the letter
            plain = np.ones(len(body), bool)
            plain[:-1] = kind[1:] & _ASCII
            body = np.where(plain, np.frombuffer(told.lower(), np.uint8), body)
        inside = kind & _SPACE == 0
        first = inside.copy()
        first[1:] &= ~inside[:-1] | (kind[:-1] & _LETTER).astype(bool) & (kind[1:] & _MARK).astype(bool)
        inner = offsets[1:-1]
        inner = inner[inner < len(body)]
        first[inner] = inside[inner]
        start = np.flatnonzero(first[inside])
        before = np.append(0, np.cumsum(inside))
        return body[inside], start, np.searchsorted(start, before[offsets])


def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a partition in record batches of about ``RUN_BYTES`` of text."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, most=RUN_BYTES):
            own = part["text"].nbytes
            if held and size + own > RUN_BYTES:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(part)
            size += own
    if held:
        yield pa.concat_batches(held)
