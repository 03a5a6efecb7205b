"""Filter audit, token counts and Merkle manifest against plain versions."""

import random
from hashlib import sha256
from itertools import permutations
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import spaced

from aerofolio.llm import filter_audit, merkle, queries, token_counts, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, part string, id int, key string, mask string"


def frame(spark, rows, seed=5):
    """Documents of ``(id, text)`` with sources, languages and columns whose names clash with those of the operators."""
    rng = random.Random(seed)
    full = [(i, t, rng.choice([None, "", "s1", "s2"]), rng.choice([None, "", "de", "en", "fr"]), rng.choice([None, 3]), "p", 1, "k", None) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA), full


# ---- filters


def plain_audit(rows, labels):
    def fails(text, ident):
        w = spaced(text)
        out = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text)}
        out["E"] = ident is not None and any(t == text and i is not None and i < ident for i, t in seen)
        return {f for f in out if out[f]}

    seen = {(r[0], r[1] or "") for r in rows}
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], fails(r[1] or "", r[0])) for r in rows if (r[2] or "") == part]
        worth = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone, kept = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                worth[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(kept), len(gone), sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), f]
                left = kept
        for k, v in out.items():
            if k[0] == part and len(v) == 7 and isinstance(v[-1], str):
                v[-1] = worth[v[-1]]
    return out


def test_audit_equals_brute_force(spark, texts):
    rng = random.Random(2)
    more = [(i, " ".join(rng.choice(["a", "Bee", "c#", "d", "e" + str(rng.randint(0, 99))]) for _ in range(rng.randint(45, 70)))) for i in range(200, 240)]
    docs, full = frame(spark, texts + more + [(300, more[0][1]), (301, more[0][1]), (None, more[0][1])])
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in [*range(1, 10), 200, 201, 202, 203, 300, 300, None]]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, labels).collect()
    want = plain_audit([(r[0], r[1], r[2]) for r in full], marks)
    assert len(got) == 600 * 3 and {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got} == want
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


def test_positional_counts():
    rng = np.random.default_rng(1)
    for n, groups in ((0, 3), (1, 1), (2, 2), (5000, 1), (7777, 40)):
        words, group = rng.integers(0, 1 << 32, n, dtype=np.uint32), rng.integers(0, groups, n)
        want = np.zeros((groups, 32), np.int64)
        for bit in range(32):
            np.add.at(want[:, bit], group, (words >> np.uint32(bit)) & np.uint32(1))
        assert (filter_audit.positional_counts(words, group, groups) == want).all()


def test_words_of_long_texts_are_counted_block_by_block(monkeypatch):
    monkeypatch.setattr(filter_audit, "BLOCK", 7)
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("ab \n\x0bé") for _ in range(rng.randint(0, 60)))
        assert filter_audit.word_counts(text.encode()) == (len(spaced(text)), len(set(spaced(text))))


# ---- tokens


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.load(PATH)


def library_counts(library, texts):
    return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def counted(counter, texts):
    return [int(n) for _, _, data, bounds in tokens.pieces(pa.array(texts, pa.string()), token_counts.SPLIT) for n in counter.texts(data, bounds)]


PARTS = ["a", "'s", "'", "s", "t", "re", "'re", "'r", "ve", "'v", "'ll", "l", " ", "  ", "\n", "\t", "\x0b", "\r\n", "1", "23", "!", "...", "é", "ß", "日本", "٣", " ", "　", " ",
         "😀", "<|endoftext|>", "<|endof", "text|>", "\x00", "-----", "\x85", "\x1c", "ſ", "²", "½", "_", "٠", "​", "﻿", "᠎", " the", " and", "ing"]


def test_tokens_equal_the_library(library, vocabulary):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(rng.randint(0, 50))) for _ in range(1000)]
    texts += ["a" * 1000, " " * 3000, "abc" * 2000, "\n" * 700 + "x", None, "", "x" * 257, "'" * 300 + "s", "<|endoftext|>" * 3, "<|endoftext|", "|>"]
    assert counted(token_counts.Counter(vocabulary), texts) == library_counts(library, texts)


def test_small_chunks_and_forgotten_states(library, vocabulary, monkeypatch):
    """Chunks of three symbols, a few bytes at a time, states dropped all the time, short pieces already byte by byte."""
    for name, value in (("CHUNK", 3), ("SPLIT", 50), ("MERGE", 40), ("STATES", 5), ("STEPS", 6)):
        monkeypatch.setattr(token_counts, name, value)
    rng = random.Random(8)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    assert counted(token_counts.Counter(vocabulary), texts) == library_counts(library, texts)


def test_maps_compose():
    rng = np.random.default_rng(0)
    symbols = rng.integers(0, token_counts.CLASSES, (9, 5)).astype(np.uint8)
    whole = token_counts.chunk_maps(symbols.reshape(1, -1))[0]
    assert (token_counts.prefix_scan(token_counts.chunk_maps(symbols))[-1] == whole).all()


def test_token_rows(spark, texts, library):
    docs, full = frame(spark, texts + [(11, "<|endoftext|> " * 700)])
    got = sorted((tuple(r) for r in token_counts.counted(docs, PATH).collect()), key=str)
    n = library_counts(library, [r[1] for r in full])
    assert got == sorted(((r[0], len((r[1] or "").encode()), k, k > 1024) for r, k in zip(full, n)), key=str)
    assert token_counts.counted(docs.limit(0), PATH).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        token_counts.load(public_tokenizers.path("word_bpe_49k.json"))


# ---- proofs


def h(text):
    return sha256(text.encode()).hexdigest()


def plain_manifest(full):
    def leaf(r, text):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[2], r[3], r[4], text)))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def way(levels, i):
        out = []
        for nodes in levels[:-1]:
            at = i // 8 * 8
            out.append(("".join(nodes[at:i]), "".join(nodes[i + 1 : at + 8])))
            i //= 8
        return out

    keys = sorted({r[3] for r in full}, key=lambda k: (k is not None, (k or "").encode()))
    rows = {k: sorted([((r[0] is not None, r[0] or 0), leaf(r, r[1]), i) for i, r in enumerate(full) if r[3] == k]) for k in keys}
    trees = {k: tree([x[1] for x in rows[k]]) for k in keys}
    top = tree([trees[k][-1][0] for k in keys])
    out = []
    for at, k in enumerate(keys):
        for i, (_, own, place) in enumerate(rows[k]):
            r, sides = full[place], way(trees[k], i) + way(top, at)
            now = own
            if r[0] is not None and crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                now = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]))
            for left, right in sides:
                now = h(left + now + right)
            out.append((r[0], own, trees[k][-1][0], top[-1][0], h("".join(a + b for a, b in sides)), now, now == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("tall", [1, 2, 4])
def test_manifest_equals_brute_force(spark, texts, tall, monkeypatch):
    monkeypatch.setattr(merkle, "ASKING", 2)  # runs in many copies
    rng = random.Random(6)
    rows = texts + [(i, rng.choice(["Ab", "c", None])) for i in range(1000, 1600)]
    docs, full = frame(spark, rows)
    assert sorted((tuple(r) for r in merkle.manifest(docs, tall=tall).collect()), key=str) == plain_manifest(full)


@pytest.mark.parametrize("n", [0, 1, 8, 9, 65])
def test_trees_of_one_key(spark, n):
    full = [(i, "A" if i % 2 else "b", "s", "en", 1) for i in range(n)]
    docs = spark.createDataFrame(full, "doc_id long, text string, source string, lang string, n_chars long")
    assert sorted((tuple(r) for r in merkle.manifest(docs, tall=1).collect()), key=str) == plain_manifest(full)


def test_many_keys(spark):
    full = [(i, "T", "s", f"k{i % 70}", 1) for i in range(150)]
    docs = spark.createDataFrame(full, "doc_id long, text string, source string, lang string, n_chars long")
    assert sorted((tuple(r) for r in merkle.manifest(docs, tall=1).collect()), key=str) == plain_manifest(full)


def test_manifest_sql_on_odd_rows(spark, texts):
    docs, full = frame(spark, [r for r in texts if r[0] is not None and len(r[1] or "") < 5000 and "\x00" not in (r[1] or "")])
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source", "lang", "n_chars").toArrow())
    assert sorted(con.execute(queries.merkle_sql(4)).fetchall(), key=str) == plain_manifest(full)
