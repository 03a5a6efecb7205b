"""Token counts by compiled finite-state transducers; the tokenizer's own library only serves the tests.

Two machines read a text. The splitter goes over character classes and marks where pieces begin, as the tokenizer's pattern
does; it has twelve states, so a chunk of text is a map from any state to a state, maps compose by a parallel prefix scan, and
then every chunk knows the state it begins in. The merger goes over a piece's bytes. It is built from the merge list, as far as
texts need it: a state holds every start of a token that may still grow, with the token before it and the tokens up to it, so a
transition knows which token now ends the best split, and is marked with how many tokens it adds. A piece's count is the sum.

That one state is enough rests on how byte-pair encoding works: the tokens of a text's beginning don't depend on what follows
but for tokens that reach over the cut, and tokens stand as they are if every two neighbours do.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .tokens import pieces

# Classes of characters, as far as the splitting pattern tells them apart, and what ends a text.
SPACE, WHITE, LETTER, NUMBER, OTHER, APOSTROPHE, STMD, R, V, L, E, END = range(12)
CLASSES = 12
# The contractions that the pattern names, after the apostrophe.
SHORT, LONG = "stmd", {"r": "re", "v": "ve", "l": "ll"}

#: Symbols of a chunk, symbols split at once, bytes merged at once, longest piece that goes in step with others.
CHUNK, SPLIT, MERGE, STEPS = 256, 1 << 20, 1 << 20, 256
#: The merger forgets its states beyond so many; they are built again when needed.
STATES = 1 << 18


class Vocabulary:
    """A byte-level vocabulary as plain values, small enough to be sent to every executor: at most some hundred thousand tokens."""

    def __init__(self, tokens: list[bytes], merges: list[tuple[int, int, int]], special: list[tuple[bytes, int]], classes: np.ndarray):
        self.tokens, self.merges, self.special, self.classes = tokens, merges, special, classes
        self.name = uuid4().hex


def _alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes: printable Latin-1 characters for themselves, the rest from 256 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _classes(split) -> np.ndarray:
    """Class of every character, found by asking the splitter: a character is a letter if it stays with a letter before it, and so on.

    Runs of 256 characters that all stay together are settled by one question.
    """
    out = np.full(0x110000, WHITE, np.uint8)
    whole = {LETTER: "a", NUMBER: "1", OTHER: "!"}
    for at in range(0, 0x110000, 256):
        if 0xD800 <= at < 0xE000:
            continue
        block = [chr(c) for c in range(at, at + 256)]
        for kind, lead in whole.items():
            if len(split(lead + "".join(block))) == 1:
                out[at : at + 256] = kind
                break
        else:
            for kind, lead in whole.items():
                starts = {a for _, (a, _) in split("".join("\n" + lead + c for c in block))}
                for i in range(256):
                    if 3 * i + 2 not in starts:
                        out[at + i] = kind
    for c, kind in {" ": SPACE, "'": APOSTROPHE, "r": R, "v": V, "l": L, "e": E}.items() | {(c, STMD) for c in SHORT}:
        out[ord(c)] = kind
    return out


def load(path: str) -> Vocabulary:
    """Read a byte-level BPE file. Settings that would change counts and that this module doesn't have are refused."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
    if not plain or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or spec.get("normalizer"):
        raise ValueError("a byte-level BPE file with the common splitting pattern and no normaliser is needed")
    added = [t for t in spec.get("added_tokens", [])]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        raise ValueError("special tokens that strip or match whole words aren't known here")
    letter, names = _alphabet(), {t["content"] for t in added}

    def raw(name: str) -> bytes:
        return bytes(letter[c] for c in name)

    ids = {raw(name): i for name, i in model["vocab"].items() if name not in names}
    tokens = [b""] * (max(model["vocab"].values(), default=-1) + 1)
    for t, i in ids.items():
        tokens[i] = t
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = [(ids[raw(a)], ids[raw(b)], ids[raw(a) + raw(b)]) for a, b in pairs]
    if any(bytes([b]) not in ids for b in range(256)) or len({m[2] for m in merges}) != len(merges):
        raise ValueError("every byte must be a token, and every merge must make a token of its own")
    splitter = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    return Vocabulary(tokens, merges, [(t["content"].encode(), t["id"]) for t in added], _classes(splitter))


def _splitter() -> tuple[bytes, bytes, int]:
    """The splitting pattern as tables over ``state * CLASSES + class``: next state, and which pieces begin.

    A beginning is marked with bit 0 at this symbol and with bit 1 at the one before, as a run of white space leaves its last
    character to what follows, and an apostrophe waits for its contraction. State 0 begins a piece at whatever comes.
    """
    names = ["start", "space", "white", "spaces", "whites", "letters", "numbers", "others", "apostrophe", *LONG]
    at = {name: i for i, name in enumerate(names)}
    run = {LETTER: "letters", NUMBER: "numbers", OTHER: "others", APOSTROPHE: "others"} | dict.fromkeys((STMD, R, V, L, E), "letters")
    fresh = {c: run[c] for c in run} | {SPACE: "space", WHITE: "white", APOSTROPHE: "apostrophe"}
    kind = {"r": R, "v": V, "l": L, "e": E}
    after, marks = bytearray(len(names) * CLASSES), bytearray(len(names) * CLASSES)

    def rule(state: str, c: int, to: str, mark: int = 0) -> None:
        after[at[state] * CLASSES + c], marks[at[state] * CLASSES + c] = at[to], mark

    for state in names:
        rule(state, END, "start", 2 if state in LONG else 0)
        for c in fresh:
            white = c in (SPACE, WHITE)
            if state in ("space", "white", "spaces", "whites") and white:
                rule(state, c, "spaces" if c == SPACE else "whites")
            elif state == "space":
                rule(state, c, run[c])
            elif state == "spaces":
                rule(state, c, run[c], 2)
            elif state == "whites":
                rule(state, c, fresh[c], 3)
            elif state in run.values() and run.get(c) == state:
                rule(state, c, state)
            elif state == "apostrophe" and c == STMD:
                rule(state, c, "start")
            elif state == "apostrophe" and c in (R, V, L):
                rule(state, c, next(k for k, v in kind.items() if v == c))
            elif state == "apostrophe" and c in (OTHER, APOSTROPHE):
                rule(state, c, "others")
            elif state in LONG and c == kind[LONG[state][1]]:
                rule(state, c, "start")
            elif state in LONG and run.get(c) == "letters":
                rule(state, c, "letters", 2)
            elif state in LONG:
                rule(state, c, fresh[c], 3)
            else:
                rule(state, c, fresh[c], 1)
    pad = bytes(256 - len(after))
    return bytes(after) + pad, bytes(marks) + pad, len(names)


NEXT, MARKS, SPLITTER_STATES = _splitter()


def chunk_maps(symbols: np.ndarray) -> np.ndarray:
    """Of each chunk (a row of ``symbols``) the state it ends in, for every state it may begin in."""
    chunks = len(symbols)
    state = np.repeat(np.arange(SPLITTER_STATES, dtype=np.uint8)[:, None], chunks, 1)
    for column in np.ascontiguousarray(symbols.T):
        state = np.frombuffer((state * np.uint8(CLASSES) + column).tobytes().translate(NEXT), np.uint8).reshape(state.shape)
    return np.ascontiguousarray(state.T)


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Every map composed with all before it, in steps that double the reach."""
    reach = 1
    while reach < len(maps):
        composed = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
        maps = np.concatenate([maps[:reach], composed])
        reach *= 2
    return maps


def beginnings(symbols: np.ndarray) -> np.ndarray:
    """Where pieces begin in a stream of classes that starts a text and in which each text ends in ``END``."""
    chunks = -(-len(symbols) // CHUNK)
    padded = np.full(chunks * CHUNK, END, np.uint8)
    padded[: len(symbols)] = symbols
    table = padded.reshape(chunks, CHUNK)
    ends = prefix_scan(chunk_maps(table))[:, 0]
    state = np.concatenate([[0], ends[:-1]]).astype(np.uint8)
    marks = np.empty((CHUNK, chunks), np.uint8)
    for i, column in enumerate(np.ascontiguousarray(table.T)):
        step = (state * np.uint8(CLASSES) + column).tobytes()
        state = np.frombuffer(step.translate(NEXT), np.uint8)
        marks[i] = np.frombuffer(step.translate(MARKS), np.uint8)
    marks = marks.T.reshape(-1)[: len(symbols)]
    begins = (marks & 1).astype(bool)
    begins[:-1] |= marks[1:] > 1
    return begins


class Merger:
    """The transducer of byte-pair merges, compiled state by state; a state is the open starts of tokens at one place."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens = vocabulary.tokens
        self.single = [0] * 256
        self.child: dict[int, int] = {}
        self.token, self.grows = [-1], [True]
        for i, t in enumerate(self.tokens):
            if len(t) == 1:
                self.single[t[0]] = i
            node = 0
            for b in t:
                to = self.child.get(node << 8 | b)
                if to is None:
                    to = self.child[node << 8 | b] = len(self.token)
                    self.token.append(-1)
                    self.grows.append(False)
                    self.grows[node] = True
                node = to
            if t:
                self.token[node] = i
        self.rank = {(a, b): (k, to) for k, (a, b, to) in enumerate(vocabulary.merges)}
        self.stands: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        """No states but the first. A state is a row of open starts: node reached, token before (-1: none), tokens up to it less those up to here."""
        self.states: list[tuple] = [((0, -1, 0),)]
        self.number = {self.states[0]: 0}
        self.used, self.size = 0, 1 << 16
        self.keys, self.to, self.adds = np.full(self.size, -1, np.int64), np.zeros(self.size, np.int32), np.zeros(self.size, np.int16)

    def encoded(self, text: bytes) -> list[int]:
        """Merges one after another, as the merge list says; for the few bytes of two tokens."""
        out = [self.single[b] for b in text]
        while len(out) > 1:
            best = min((self.rank[p] for p in zip(out, out[1:]) if p in self.rank), default=None)
            if best is None:
                break
            merged, i = [], 0
            while i < len(out):
                two = self.rank.get((out[i], out[i + 1])) == best if i + 1 < len(out) else False
                merged.append(best[1] if two else out[i])
                i += 2 if two else 1
            out = merged
        return out

    def neighbours(self, before: int, token: int) -> bool:
        """Whether the merges leave the two tokens as they are (with -1: the one token)."""
        known = self.stands.get((before, token))
        if known is None:
            own = [token] if before < 0 else [before, token]
            known = self.stands[before, token] = self.encoded(b"".join(self.tokens[t] for t in own)) == own
            if len(self.stands) > 8 * STATES:
                self.stands = {}
        return known

    def step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """The state after one more byte, and the tokens that it adds."""
        open_, last, adds = [], -1, 0
        for node, before, count in state:
            to = self.child.get(node << 8 | byte)
            if to is None:
                continue
            token = self.token[to]
            if token >= 0 and last < 0 and self.neighbours(before, token):
                last, adds = token, count + 1
            if self.grows[to]:
                open_.append((to, before, count))
        return (*((to, before, count - adds) for to, before, count in open_), (0, last, 0)), adds

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (self.size - 1)

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each key, or the free one where it would stand, and which keys are there."""
        slot = self._slots(keys)
        got = self.keys[slot]
        wrong = np.flatnonzero((got != keys) & (got >= 0))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & (self.size - 1)
            got[wrong] = self.keys[slot[wrong]]
            wrong = wrong[(got[wrong] != keys[wrong]) & (got[wrong] >= 0)]
        return slot, got >= 0

    def _enter(self, keys: np.ndarray, to: np.ndarray, adds: np.ndarray) -> None:
        if 3 * (self.used + len(keys)) > self.size:
            had = np.flatnonzero(self.keys >= 0)
            keys, to, adds = np.concatenate([self.keys[had], keys]), np.concatenate([self.to[had], to]), np.concatenate([self.adds[had], adds])
            while 3 * len(keys) > self.size:
                self.size *= 4
            self.keys, self.to, self.adds, self.used = np.full(self.size, -1, np.int64), np.zeros(self.size, np.int32), np.zeros(self.size, np.int16), 0
        self.used += len(keys)
        while len(keys):
            slot, _ = self._place(keys)
            _, own = np.unique(slot, return_index=True)  # one key a slot; the others look further
            self.keys[slot[own]], self.to[slot[own]], self.adds[slot[own]] = keys[own], to[own], adds[own]
            rest = np.ones(len(keys), bool)
            rest[own] = False
            keys, to, adds = keys[rest], to[rest], adds[rest]

    def follow(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and added tokens of many states at once; transitions that are not there yet are compiled."""
        keys = states.astype(np.int64) << 8 | symbols
        slot, there = self._place(keys)
        if not there.all():
            new = np.unique(keys[~there])
            to, adds = np.empty(len(new), np.int32), np.empty(len(new), np.int16)
            for i, key in enumerate(new.tolist()):
                state, adds[i] = self.step(self.states[key >> 8], key & 255)
                number = self.number.get(state)
                if number is None:
                    number = self.number[state] = len(self.states)
                    self.states.append(state)
                to[i] = number
            self._enter(new, to, adds)
            slot, _ = self._place(keys)
        return self.to[slot], self.adds[slot]

    def count(self, piece: bytes) -> int:
        """Tokens of one long piece, byte by byte; states that repeat are looked up."""
        state, total, known = self.states[0], 0, {}
        for b in piece:
            had = known.get((state, b))
            if had is None:
                if len(known) > STATES:
                    known = {}
                had = known[state, b] = self.step(state, b)
            state = had[0]
            total += had[1]
        return total

    def counts(self, data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Tokens of the pieces ``data[lo:hi]``, all going in step, the longest first."""
        out = np.zeros(len(lo), np.int64)
        size = hi - lo
        far = np.flatnonzero(size > STEPS)
        for i in far.tolist():
            out[i] = self.count(data[lo[i] : hi[i]].tobytes())
        near = np.flatnonzero(size <= STEPS)
        ends = np.cumsum(size[near])
        at = 0
        while at < len(near):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MERGE, side="right")))
            if len(self.states) > STATES:
                self.forget()
            some = near[at:to]
            some = some[np.argsort(-size[some].astype(np.int16), kind="stable")]
            going, start = np.searchsorted(-size[some], -np.arange(int(size[some].max(initial=0))), side="left"), lo[some]
            state, total = np.zeros(len(some), np.int32), np.zeros(len(some), np.int64)
            for k, n in enumerate(going.tolist()):
                state[:n], adds = self.follow(state[:n], data[start[:n] + k])
                total[:n] += adds
            out[some] = total
            at = to
        return out


class Counter:
    """Tokens of whole texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.classes, self.merger = vocabulary.classes, Merger(vocabulary)
        self.special = sorted({t for t, _ in vocabulary.special}, key=lambda t: (-len(t), t))

    def _cuts(self, text: bytes) -> list[tuple[int, int]]:
        """Byte ranges of the special strings in a text, leftmost and then longest first."""
        out, at = [], 0
        while True:
            hits = [(text.find(t, at), -len(t)) for t in self.special]
            hits = [h for h in hits if h[0] >= 0]
            if not hits:
                return out
            first, size = min(hits)
            out.append((first, first - size))
            at = first - size

    def texts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Tokens of each text ``data[bounds[i]:bounds[i + 1]]``; special strings are a token each and end the text before them."""
        n = len(bounds) - 1
        out = np.zeros(n, np.int64)
        raw = data.tobytes()
        lo, hi, row = bounds[:-1], bounds[1:], np.arange(n)
        cuts = [(s, e) for s, e in self._cuts(raw)] if self.special else []
        owner = np.searchsorted(bounds, [s for s, _ in cuts], side="right") - 1 if cuts else []
        cuts = [(s, e, int(r)) for (s, e), r in zip(cuts, owner)]
        if any(e > bounds[r + 1] for _, e, r in cuts):  # a string over the end of a text is none: look text by text
            cuts = [(int(bounds[r]) + s, int(bounds[r]) + e, r) for r in range(n) for s, e in self._cuts(raw[bounds[r] : bounds[r + 1]])]
        if cuts:
            out += np.bincount([r for _, _, r in cuts], minlength=n)
            # beginnings and ends are in order by themselves; what is between two strings, or a string and an end of a text, stands alone
            owners = np.concatenate([row, [r for _, _, r in cuts]])
            first, last = np.concatenate([lo, [e for _, e, _ in cuts]]), np.concatenate([hi, [s for s, _, _ in cuts]])
            by, end = np.lexsort((first, owners)), np.lexsort((last, owners))
            lo, hi, row = first[by], last[end], owners[by]
        full = hi > lo
        lo, hi, row = lo[full], hi[full], row[full]
        at = 0
        while at < len(lo):
            to = max(at + 1, int(np.searchsorted(hi, lo[at] + SPLIT, side="right")))
            found, owner = self._segments(data, lo[at:to], hi[at:to])
            out += np.bincount(row[at:to][owner], weights=found, minlength=n).astype(np.int64)
            at = to
        return out

    def _segments(self, data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token count of every piece of some ranges of bytes, and which range it is of."""
        base, part = int(lo[0]), data[lo[0] : hi[-1]]
        inside = np.zeros(len(part) + 1, np.int8)
        inside[lo - base] += 1
        np.subtract.at(inside, hi - base, 1)
        inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
        place = np.flatnonzero(inside & ((part & 0xC0) != 0x80))
        lead = part[place].astype(np.int32)
        more = np.concatenate([part, np.zeros(3, np.uint8)])
        point = lead.copy()
        # of two, three and four bytes: the first lead byte, the lead's own bits, and the bytes that follow
        for least, below, bits, tail in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
            wide = np.flatnonzero((lead >= least) & (lead < below))
            value = lead[wide] & bits
            for k in range(1, tail + 1):
                value = value << 6 | (more[place[wide] + k] & 0x3F)
            point[wide] = value
        ends = np.searchsorted(place, hi - base)
        symbols = np.insert(self.classes[point], ends, END)
        places = np.insert(place, ends, hi - base)
        begin = beginnings(symbols)
        events = np.flatnonzero(begin | (symbols == END))
        real = symbols[events] != END
        start = places[events[real]]
        stop = places[events[np.flatnonzero(real) + 1]]
        owner = np.searchsorted(lo - base, start, side="right") - 1
        return self.merger.counts(part, start, stop), owner


_ready: dict[str, Counter] = {}


def _count(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        if vocabulary.name not in _ready:  # a worker keeps the machine of one vocabulary from task to task
            _ready.clear()
            _ready[vocabulary.name] = Counter(vocabulary)
        counter = _ready[vocabulary.name]
        for b in batches:
            n_bytes, n_tokens = [], []
            for _, _, data, bounds in pieces(b.column("text"), SPLIT):
                n_bytes.append(np.diff(bounds))
                n_tokens.append(counter.texts(data, bounds))
            found = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (n_bytes, n_tokens)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in found)], names=["id", "n_bytes", "n_tokens"])

    return run


def counted(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of every row ``n_bytes`` and ``n_tokens`` of its whole text, and whether these are more than ``limit``.

    Counts are those of the file's own library, without begin and end tokens, cuts or padding; special strings inside a text are
    one token each, as is its default. A null text is empty; an empty one has no tokens. Rows come back as often as they
    are there, null ids too; other columns are left alone. An empty table gives no rows. ``path`` is read on the driver alone.
    """
    sent = docs.sparkSession.sparkContext.broadcast(load(path))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = T.StructType([rows.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    found = rows.mapInArrow(_count(sent), kind)
    return found.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
