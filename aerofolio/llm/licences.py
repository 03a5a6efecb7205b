"""Licence scan: a generalised suffix automaton of notices gives matching statistics, long matches chain into spans.

While a text is streamed, the automaton's state stands for the longest run of words, ending here, that occurs in some notice.
Phrases end where their state lies on the state's chain of suffixes. A run that can't be extended and has
enough words is a match; matches of one notice, in order in both text and notice and not far apart, make a chain, and the
share of the notice that a chain covers decides on its label. Words outside the notices, and pairs of words that no
notice has, end every run; they are found for a whole batch at once, so the automaton walks through what is left.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .licence_texts import NOTICES, PHRASES
from .tokens import ALNUM_LOWER, Words, pieces


def _word_lists(texts: list[str]) -> list[list[bytes]]:
    (_, _, data, bounds), = pieces(pa.array(texts, pa.string()), 1 << 40)
    words = Words(data, bounds, ALNUM_LOWER)
    return [[words.text(i, i + 1) for i in range(a, b)] for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())]


class Automaton:
    """Generalised suffix automaton over lists of word numbers."""

    def __init__(self, texts: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]  # per state: text and end position of its words
        for t, text in enumerate(texts):
            last = 0
            for at, word in enumerate(text):
                last = self._extend(last, word)
                self.ends[last].append((t, at + 1))
        for s in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            self.ends[self.link[s]].extend(self.ends[s])
        self.ends[0] = []

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.length) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """The state for the words of ``p`` and ``word``, taken out of the longer state ``q``."""
        if self.length[q] == self.length[p] + 1:
            return q
        part = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = part
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = part
            p = self.link[p]
        return part

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, self.next[last][word], word)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][word], word)
        return new

    def find(self, text: list[int]) -> int:
        s = 0
        for word in text:
            s = self.next[s][word]
        return s


class Scan:
    """The automaton with the vocabulary, pairs and phrases of some notices; built in every worker from the plain texts."""

    def __init__(self, notices: dict[str, list[str]], phrases: dict[str, str], least: int, gap: int):
        self.least, self.gap = least, gap
        texts, self.labels = [t for x in notices.values() for t in x], [k for k, x in notices.items() for _ in x]
        lists = _word_lists([*texts, *phrases])
        vocabulary = sorted({w for x in lists for w in x})
        number = {w: i for i, w in enumerate(vocabulary)}
        data = b" ".join(vocabulary)
        h = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), ALNUM_LOWER).hashes()
        order = np.argsort(h)
        self.hashes, self.numbers = h[order], order
        coded = [[number[w] for w in x] for x in lists]
        self.automaton = Automaton(coded)
        self.sizes = [len(x) for x in coded[: len(texts)]]
        n = len(vocabulary)
        self.pairs = np.zeros((n + 1, n + 1), bool)  # the last number is for all other words
        for x in coded:
            self.pairs[x[:-1], x[1:]] = True
        self.single = np.zeros(n + 1, bool)
        self.phrase_at: list[list[tuple[int, str]]] = [[] for _ in self.automaton.length]
        of = dict[int, list[tuple[int, str]]]()
        for x, label in zip(coded[len(texts) :], phrases.values()):
            if x:
                of.setdefault(self.automaton.find(x), []).append((len(x), label))
                if len(x) == 1:
                    self.single[x[0]] = True
        for s in sorted(range(len(self.automaton.length)), key=self.automaton.length.__getitem__):
            self.phrase_at[s] = of.get(s, []) + (self.phrase_at[self.automaton.link[s]] if s else [])

    def stretches(self, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers, and the bounds of the stretches in which all neighbours are neighbours in some notice."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        code = np.where(self.hashes[at] == h, self.numbers[at], len(self.hashes))
        joined = self.pairs[code[:-1], code[1:]] & (row[:-1] == row[1:]) if len(code) else np.zeros(0, bool)
        edge = np.diff(joined.astype(np.int8), prepend=0, append=0)
        lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        alone = np.flatnonzero(self.single[code] & ~np.append(joined, False) & ~np.append(False, joined)) if len(code) else lo
        lo, hi = np.append(lo, alone), np.append(hi, alone + 1)
        order = np.argsort(lo)
        return code, lo[order], hi[order]

    def stream(self, words: list[int], begin: int) -> tuple[list[tuple[int, str]], list[tuple[int, int, int]]]:
        """Phrases as ``(first word, label)``; matches as ``(end word, length, state)``."""
        a, s, n = self.automaton, 0, 0
        phrases, matches = [], []
        for i, w in enumerate(words):
            if n and w not in a.next[s]:
                if n >= self.least:
                    matches.append((begin + i, n, s))
                while s and w not in a.next[s]:
                    s = a.link[s]
                    n = a.length[s]
            if w in a.next[s]:
                s, n = a.next[s][w], n + 1
                phrases += [(begin + i + 1 - k, label) for k, label in self.phrase_at[s] if k <= n]
        if n >= self.least:
            matches.append((begin + len(words), n, s))
        return phrases, matches

    def chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """``(label, first word, end word, covered share)`` of the best chain that ends in each notice's each match; only best ones."""
        by_text: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        for end, n, s in matches:
            for t, to in self.automaton.ends[s]:
                if t < len(self.sizes):
                    by_text[t].append((end - n, end, to - n, to))
        out = []
        for t, found in by_text.items():
            found.sort()
            best: list[tuple[int, int]] = []  # covered words of the notice, first word of the chain
            lo, spans = 0, []
            for i, (start, end, at, to) in enumerate(found):
                while found[lo][0] + self.sizes[t] + self.gap < start:
                    lo += 1
                covered, first = to - at, start
                for j in range(lo, i):
                    _, end_j, _, to_j = found[j]
                    new = to - max(at, to_j)
                    if end_j <= start + (to - at) - new and start - end_j <= self.gap and new > 0 and best[j][0] + new > covered:
                        covered, first = best[j][0] + new, best[j][1]
                best.append((covered, first))
                spans.append((self.labels[t], first, end, covered / self.sizes[t]))
            top: dict[int, tuple[str, int, int, float]] = {}
            for x in spans:
                if x[1] not in top or x[3] > top[x[1]][3]:
                    top[x[1]] = x
            out += top.values()
        return out


_scans: dict[tuple, Scan] = {}


def _run(notices, phrases, least: int, gap: int, cover: float):
    key = (repr(notices), repr(phrases), least, gap)
    kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("covered", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _scans:
            _scans[key] = Scan(notices, phrases, least, gap)
        scan = _scans[key]
        for b in batches:
            at = b.schema.get_field_index("text")
            n_words, rows = [], []
            for lo, hi, data, bounds in pieces(b.column(at)):
                words = Words(data, bounds, ALNUM_LOWER)
                row = np.repeat(np.arange(hi - lo), words.counts)
                code, start, end = scan.stretches(words.hashes(), row)
                found: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
                for s, e in zip(start.tolist(), end.tolist()):
                    phrase, match = scan.stream(code[s:e].tolist(), s)
                    if phrase or match:
                        mine = found[int(row[s])]
                        mine[0].extend(phrase)
                        mine[1].extend(match)
                n_words += words.counts.tolist()
                for i in range(hi - lo):
                    phrase, match = found.get(i, ((), ()))
                    base = int(words.first[i])
                    places = [p - base for p, _ in phrase]
                    spans = [x for x in scan.chains(match) if x[3] >= cover] if match else []
                    own = sorted({x for _, x in phrase})
                    share = max([*(x[3] for x in spans), *[1.0] * bool(own)], default=0.0)
                    rows.append((len(places), min(places, default=None), max(places, default=None), ",".join(own), ",".join(sorted({*own, *(x[0] for x in spans)})),
                                 min(share, 1.0), [{"label": x[0], "first": x[1] - base, "end": x[2] - base, "covered": x[3]} for x in sorted(spans, key=lambda x: (x[1], x[0], x[2]))]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), kind)
            cols = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 7, kinds)]
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(n_words, pa.int64()), *cols], names=[*b.schema.names[:at], *names])

    return run


def scan(docs: DataFrame, notices: dict[str, list[str]] = NOTICES, phrases: dict[str, str] = PHRASES, least: int = 4, gap: int = 12, cover: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (but the text) with ``n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    A-Z are lower-cased; words are runs of ASCII letters, digits and all characters outside ASCII. ``n_base`` counts all places of
    ``phrases``, overlapping ones too, ``first_word`` and ``last_word`` are their smallest and largest first word (null if none). A label
    of ``notices`` is added if a chain of matches of ``least`` words or more, at most ``gap`` words apart, covers the share ``cover`` of one of its
    texts; ``spans`` are such chains, ``score`` the largest share covered (1 if a phrase occurs, 0 if nothing does). Null and empty texts have
    no words. Rows don't depend on each other; columns of ``docs`` named as a result are replaced.
    """
    results = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    others = [c for c in docs.columns if c not in (*results, text_col)]
    span = T.StructType().add("label", "string").add("first", "long").add("end", "long").add("covered", "double")
    kinds = [*[T.LongType()] * 4, *[T.StringType()] * 2, T.DoubleType(), T.ArrayType(span)]
    schema = T.StructType([*(T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(others)), *map(T.StructField, results, kinds)])
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col(text_col).alias("text")).mapInArrow(_run(notices, phrases, least, gap, cover), schema)
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], *results)
