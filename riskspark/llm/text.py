"""Words, windows and statistics of many texts at once, in numpy over Arrow's own buffers.

A batch of texts lies in memory as one run of UTF-8 bytes with an offset per text. All
functions here work on such a run, so there is no loop over texts or words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))


def slices(batch: pa.RecordBatch, *columns: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text; a longer text comes alone."""
    size = np.zeros(batch.num_rows, np.int64)
    for c in columns or ("text",):
        size += pc.fill_null(pc.binary_length(batch[c]), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(size):
        if i > start and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    return body, offsets - offsets[0]


def lower(body: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return body + (((body >= 65) & (body <= 90)).astype(np.uint8) << 5)


def is_space(body: np.ndarray) -> np.ndarray:
    return (body == 32) | ((body >= 9) & (body <= 13))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64, a published constant set)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept up to 4 Mi of them."""
    have, back = _POWERS
    if len(have) < n:
        n = max(n, 1 << 20)
        with np.errstate(over="ignore"):
            have = np.cumprod(np.concatenate([[U64(1)], np.full(n, _BASE, U64)]), dtype=U64)
            back = np.cumprod(np.concatenate([[U64(1)], np.full(n, _INVERSE, U64)]), dtype=U64)
        if n <= 1 << 22:
            _POWERS[:] = have, back
    return have, back


def span_hashes(body: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal spans have equal hashes."""
    power, back = _powers(len(body) + 1)
    total = np.zeros(len(body) + 1, U64)
    np.cumsum((body.astype(U64) + U64(1)) * power[: len(body)], out=total[1:])
    return mix((total[end] - total[start]) * back[start] + (end - start).astype(U64))


class Words:
    """The words of a run of texts: where each begins and ends, and whose it is."""

    def __init__(self, body: np.ndarray, offsets: np.ndarray):
        self.body, self.offsets, self.n_docs = body, offsets, len(offsets) - 1
        self.space = is_space(body)
        inside = ~self.space
        first = inside.copy()
        first[1:] &= self.space[:-1]
        last = inside.copy()
        last[:-1] &= self.space[1:]
        at = offsets[1:-1]
        at = at[(at > 0) & (at < len(body))]
        first[at] |= inside[at]  # a text's end ends its last word
        last[at - 1] |= inside[at - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.start, offsets)  # of each text's words
        self.n_words = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(self.n_docs), self.n_words)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.body, self.start, self.end)

    def windows(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of n words that lies in one text."""
        if len(hashes) < n:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        h = np.zeros(len(hashes) - n + 1, U64)
        for k in range(n):
            h = mix(h * U64(0xD1342543DE82EF95) + hashes[k : len(hashes) - n + 1 + k])
        at = np.flatnonzero(self.doc[: len(h)] == self.doc[n - 1 :])
        return at, h[at]


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, size of each text's set): distinct n-word shingles of the lower-cased texts.

    Sorted by text, then hash. A text of fewer than n words, but some, has its whole
    sequence as its one shingle. The size of such a run is part of its hash.
    """
    body, offsets = raw(texts)
    w = Words(lower(body), offsets)
    hashes = w.hashes()
    at, value = w.windows(hashes, n)
    doc = w.doc[at]
    for size in range(1, n):
        first = w.bounds[:-1][w.n_words == size]
        if len(first):
            h = np.full(len(first), U64(size))
            for k in range(size):
                h = mix(h * U64(0xD1342543DE82EF95) + hashes[first + k])
            doc, value = np.concatenate([doc, w.doc[first]]), np.concatenate([value, h])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return doc, value, np.bincount(doc, minlength=w.n_docs)


def per_doc(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a mask or of whole numbers between consecutive offsets."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeats(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, is the first of its kind, size of its kind) with the rows sorted by text and value."""
    order = np.lexsort((value, doc))
    d, v = doc[order], value[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    kind = np.cumsum(new) - 1
    return order, new, np.bincount(kind, minlength=1)[kind] if len(d) else np.zeros(0, np.int64)


#: Characters that count as symbols, fixed by the contract.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True

#: The counts that base_statistics returns, in this order.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Further statistics, all between 0 and about 20, for the models.
RATIOS = (
    "log_words", "mean_word", "symbol_share", "bar_share", "mark_share", "upper_share", "digit_share", "punct_share",
    "non_ascii_share", "dup_line_share", "repeat_share", "distinct_share", "top_word_share", "log_lines",
    "log_words_per_line", "dup_pair_share", "long_word_share", "stop_share",
)


def statistics(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(the counts of BASE, a float matrix with the columns of RATIOS), a row per text."""
    body, offsets = raw(texts)
    w = Words(body, offsets)
    n = w.n_words
    lead = (body & 0xC0) != 0x80  # bytes that begin a code point
    chars = np.maximum(per_doc(lead, offsets), 1)
    word_chars = per_doc(lead & ~w.space, offsets)
    hashes = w.hashes()

    # lines: runs between \n or the text's ends
    brk = np.flatnonzero(body == 10)
    line_start = np.unique(np.concatenate([offsets[:-1], brk + 1]))
    line_start = line_start[line_start < len(body)]
    line_doc = np.searchsorted(offsets, line_start, side="right") - 1
    following = np.append(brk, len(body))[np.searchsorted(brk, line_start)]
    line_end = np.minimum(following, offsets[line_doc + 1])
    worded = np.searchsorted(w.start, line_end) > np.searchsorted(w.start, line_start)
    line_start, line_end, line_doc = line_start[worded], line_end[worded], line_doc[worded]
    _, new, _ = repeats(line_doc, span_hashes(body, line_start, line_end))
    n_lines = np.bincount(line_doc, minlength=w.n_docs)
    n_dup_lines = n_lines - np.bincount(np.sort(line_doc)[new], minlength=w.n_docs)

    # words in windows of three that come twice
    at, h3 = w.windows(hashes, 3)
    covered = np.zeros(len(hashes) + 2, bool)
    order, _, times = repeats(w.doc[at], h3)
    twice = at[order[times > 1]]
    for k in range(3):
        covered[twice + k] = True
    n_repeat = per_doc(covered[: len(hashes)], w.bounds)

    order, new, times = repeats(w.doc, hashes)
    distinct = np.bincount(w.doc[order[new]], minlength=w.n_docs)
    top = np.zeros(w.n_docs, np.int64)
    np.maximum.at(top, w.doc[order[new]], times[new])
    at2, h2 = w.windows(hashes, 2)
    order2, new2, _ = repeats(w.doc[at2], h2)
    pairs = np.bincount(w.doc[at2], minlength=w.n_docs)
    dup_pairs = pairs - np.bincount(w.doc[at2[order2[new2]]], minlength=w.n_docs)
    length = w.end - w.start

    base = dict(zip(BASE, (n, word_chars, per_doc(SYMBOLS[body], offsets), n_dup_lines, n_repeat), strict=True))
    some, lines = np.maximum(n, 1), np.maximum(n_lines, 1)
    upper = (body >= 65) & (body <= 90)
    digit = (body >= 48) & (body <= 57)
    punct = (body > 32) & (body < 127) & ~_LETTERS[body] & ~digit
    columns = (
        np.log1p(n), word_chars / some, base["n_symbols"] / chars, per_doc(body == 124, offsets) / some,
        per_doc(body == 33, offsets) / some, per_doc(upper, offsets) / chars, per_doc(digit, offsets) / chars,
        per_doc(punct, offsets) / chars, per_doc(body >= 0xC0, offsets) / chars, n_dup_lines / lines, n_repeat / some,
        distinct / some, top / some, np.log1p(n_lines), np.log1p(n / lines), dup_pairs / np.maximum(pairs, 1),
        per_doc(length > 15, w.bounds) / some, per_doc(length < 4, w.bounds) / some,
    )
    return base, np.column_stack(columns).astype(np.float32)
