"""Small inputs with the awkward cases, and plain versions of what the operators compute."""

from __future__ import annotations

import collections
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = [" ", "\n", "\t", "  ", "\r\n"]


def some_texts(n: int = 60, seed: int = 1) -> list[str]:
    """Prose, junk and repetition of many lengths."""
    r = random.Random(seed)
    syllables = "an ber co da é fi go ß in ka 日 mo".split()
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))
    out = []
    for i in range(n):
        words = [word() for _ in range(r.choice([0, 1, 2, 3, 8, 60, 200, 400]))]
        if i % 5 == 1:
            words = [w + r.choice(["***", "%%%", "|", "&&&"]) for w in words]
        if i % 5 == 2 and words:
            words = (words[:3] * 100)[: len(words) + 1]
        out.append("".join(w + r.choice(SPACES) for w in words))
    return out


def messy_docs(spark, extra: bool = True):
    """Documents with nulls, empty and long texts, copies, repeated rows, and clashing names."""
    texts = some_texts()
    long = " ".join(f"w{i % 7001}" for i in range(30_000))
    rows = [(i, t, "en", f"s{i % 4}") for i, t in enumerate(texts)]
    rows += [
        (100, None, "en", "s1"), (101, "", None, None), (102, " \n\t ", "en", None), (103, "A", "en", "s1"),
        (104, long, "en", "s2"), (105, long + " end", "en", "s2"), (106, long.upper(), "en", "s2"),
        (None, texts[5], "en", "s3"), (None, None, None, None), (107, texts[5], "en", "s3"), (5, texts[5], "en", "s1"), (5, texts[5], "en", "s1"),
        (108, "dup line\n" * 40, "en", "s0"), (109, "x\x00y \x1c z   w", "en", "s0"),
    ]
    names = "id hash copies size root group ids part score taken bucket sig kept path n_shingles component_id".split()
    if extra:
        rows = [(*r, *range(len(names))) for r in rows]
    schema = "doc_id long, text string, lang string, source string" + ("".join(f", {c} int" for c in names) if extra else "")
    return spark.createDataFrame(rows, schema)


def labels(spark):
    """Labels for the messy documents: repetition and marks are bad; some are unusable."""
    rows = [(i, 0 if i % 5 in (1, 2) else 1, 0) for i in range(60)] + [(3, 1, None), (None, 1, 0), (4, None, 0), (999, 0, 1), (9, 7, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def base_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    w = WORD.findall(text)
    times = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k + j for k in range(len(w) - 2) if times[tuple(w[k : k + 3])] > 1 for j in range(3)}
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(covered)


def shingles(text: str | None, n: int) -> frozenset:
    w = (text or "").encode().lower().split()
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def near_duplicates(rows: list[tuple], n: int, like: int = 80) -> dict:
    """doc_id -> (set size, smallest id reachable), all pairs compared."""
    sets = [(d, shingles(t, n)) for d, t in rows]
    above = list(range(len(sets)))

    def top(x: int) -> int:
        while above[x] != x:
            x = above[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            k = len(a & b)
            if a and b and 100 * k >= like * (len(a) + len(b) - k):
                above[top(i)] = top(j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(sets):
        least[top(i)] = min(least.get(top(i), d), d)
    return {d: (len(s), least[top(i)]) for i, (d, s) in enumerate(sets)}
