"""Suffix-array dedup, tokenizer alignment and the prefix trie against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from querywright.llm import alignment, prefix_trie, suffix_dedup
from querywright.llm.bpe import byte_symbols
from querywright.llm.queries import PIECES, TOKENIZER

SCHEMA = "doc_id long, text string, row string, out string, bytes string, core long, block long, k1 string, n_a string"


def passage(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choices("abcdefghij", k=rnd.randint(1, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    shared, edge = passage(1, 120), "é" * 300
    texts = [None, "", " \n", "short", "x" * 900, "x" * 399, "ab " * 400, "日本語テキスト" * 60, edge + "tail", "head" + edge, shared,
             shared + passage(2, 50), passage(3, 20) + shared, passage(4, 40) + shared[7:] + passage(5, 40), shared[:399], shared[:400],
             "<|endoftext|> a<|endoftext|></s><s> <unk> ▁ ①  ½\t\x00\x1c", "y" * 70_000, passage(6, 8000)]
    texts += [passage(7, 30) + shared + passage(100 + i, 10) for i in range(12)]
    rows = list(enumerate(texts)) + [(3, "short"), (None, shared), (None, None), (50, passage(8, 200)), (50, passage(8, 200)), (51, passage(6, 8000)[9:])]
    return spark.createDataFrame([(i, t, "r", "o", "b", 1, 2, "k", "n") for i, t in rows], SCHEMA).repartition(3)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# 11 suffix-array dedup

def brute_repeats(rows, span=400):
    texts = [(i, (t or "").encode()) for i, t in rows]
    starts = Counter(t[p:p + span] for _, t in texts for p in range(len(t) - span + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for p in range(len(t) - span + 1):
            if starts[t[p:p + span]] > 1:
                gone[p + 1:p + 1 + span] = True
        kept = bytes(b for b, g in zip(t, gone[1:-1].tolist()) if not g)
        out.append((i, len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found_repeats(df, **rules):
    out = suffix_dedup.without_repeats(df, **rules).select("row.doc_id", "out.n_bytes", "out.n_removed", F.size("out.spans"), F.sha2("out.kept", 256))
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("limit", [suffix_dedup.LIMIT, 1])
def test_suffix_dedup_equals_brute_force(odd, tables, limit):
    assert found_repeats(odd, limit=limit) == brute_repeats(rows_of(odd))
    if limit > 1:
        assert found_repeats(tables.documents) == brute_repeats(rows_of(tables.documents))
        assert found_repeats(odd.filter("false")) == []


def test_suffix_dedup_keeps_other_columns(odd):
    row = suffix_dedup.without_repeats(odd).select("row.*").columns
    assert row == [c for c in odd.columns if c != "text"]


def test_multikey_order_sorts_groups():
    rng = np.random.default_rng(5)
    group = np.sort(rng.integers(0, 40, 3000))
    words = rng.integers(0, 3, (3000, 6)).astype(np.uint64)
    order = suffix_dedup.multikey_order(words, group)
    key = lambda i: (int(group[i]), *words[i].tolist())
    assert sorted(order.tolist()) == list(range(3000))
    assert [key(i) for i in order] == sorted(key(i) for i in range(3000))


def test_equal_windows_name_the_same_suffix():
    text = (passage(9, 60) + passage(10, 90) + passage(9, 60)).encode()
    for cut in (0, 5, 33):
        at, start, n = suffix_dedup.named_suffixes(np.frombuffer(text[cut:], np.uint8))
        name = {p + cut: a - p for a, s, c in zip(at, start, n) for p in range(s, s + c)}
        assert sorted(name) == list(range(cut, len(text) - 399))
        whole = name if not cut else whole
        assert all(whole[p] == name[p] for p in name)
        assert all(1 <= v < suffix_dedup.WINDOW for v in name.values())


# 12 alignment

def brute_alignment(rows):
    first, second = Tokenizer.from_file(TOKENIZER), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    first.encode_special_tokens = True
    byte_of = {c: b for b, c in enumerate(byte_symbols())}
    size_a = {i: len(t) for t, i in first.get_vocab().items()}
    of_a = {i: bytes(byte_of.get(c, 0) for c in t) for t, i in first.get_vocab().items()}
    piece = lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
    count, docs = Counter(), []
    for i, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        if not text or b"".join(map(piece, b)) != (" " + text).encode() or b"".join(map(of_a.get, a)) != (" " + text).encode():
            docs.append((i, 0, 0, [], ""))
            continue
        ends_a = dict(zip(np.cumsum([size_a[x] for x in a]).tolist(), range(len(a))))
        ends_b = dict(zip(np.cumsum([len(piece(x)) for x in b]).tolist(), range(len(b))))
        groups, links, x, y = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            groups.append(",".join(map(str, a[x:ends_a[end] + 1])) + "|" + ",".join(map(str, b[y:ends_b[end] + 1])))
            x, y = ends_a[end] + 1, ends_b[end] + 1
            links.append((a[x - 1], b[y - 1]))
        count.update(links)
        docs.append((i, len(a), len(b), links, ";".join(groups)))
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    return sorted([(i, n, m, len(links), len(links), sum(count[k] == most[k[1]] for k in links), sum(count[k] for k in links), text)
                   for i, n, m, links, text in docs], key=str), count


def found_alignment(df):
    out = alignment.align(df, TOKENIZER, PIECES)
    return sorted(map(tuple, out.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()), key=str)


def test_alignment_equals_brute_force(odd, tables):
    for df in (odd, tables.documents):
        assert found_alignment(df) == brute_alignment(rows_of(df))[0]
    assert found_alignment(odd.filter("false")) == []


def test_alignment_over_small_blocks_and_bitsets(odd, monkeypatch):
    monkeypatch.setattr(alignment, "ARRAY_DOCS", 3)
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 500)
    keys = np.sort(np.concatenate([np.arange(10) + (5 << 16), np.arange(2) + (6 << 16)]))
    rows = [(int(c), alignment.places_of(int(k), m.as_py()).tolist()) for code, n, bitmap in alignment.bitmaps(keys >> 16, keys & 65535)
            for c, k, m in zip(code, n, bitmap)]
    assert sorted(rows) == [(5, list(range(10))), (6, [0, 1])]


def test_pair_counts_are_popcounts(odd):
    made = alignment.index(odd, TOKENIZER, PIECES)
    pairs = alignment.pair_counts(made.filter("bitmap IS NOT NULL")).collect()
    assert {(r.a, r.b): r.n_links for r in pairs} == dict(brute_alignment(rows_of(odd))[1])
    assert all(0 < r.n_docs <= r.n_links for r in pairs)


# 13 prefix trie

def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [v[2:] for v in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(int(c - np.fmod(c, 20)), [])[:h] + turns[h:])
    members, children, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children.update(k[:-1] for k in members if k)
    for k, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * words
            leaves[k[:d]] += children[k] == 0
    return sorted([(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if built[c] == k).encode()).hexdigest()) for k, m in members.items()], key=str)


def test_prefix_trie_equals_brute_force(spark, tables):
    rnd = random.Random(1)
    rows = [(None, 1, "u", "x"), (-40, None, None, None)]
    rows += [(c, rnd.choice([None, 1, 2, 3, 4]), rnd.choice(["u", "a", None]), rnd.choice(["a b", "c", None, ""]))
             for c in [-21, -20, -1, 0, 1, 2, 3, 20, 21, 22, 41] for _ in range(rnd.randint(1, 6))]
    rows += [(40 + i, t, "u", f"w {t % 3}") for i in range(4) for t in range(60 + i * 7)]       # long: several blocks
    rows += [(1000 + i, t, "u", "same") for i in range(60) for t in range(3)] + [(5, 1, "u", "same")] * 9
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn int, role string, text string, conv string, block int").repartition(3)
    assert sorted(map(tuple, prefix_trie.prefix_trie(df).collect()), key=str) == brute_trie(rows)
    small = [tuple(r) for r in tables.conversations.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, prefix_trie.prefix_trie(tables.conversations).collect()), key=str) == brute_trie(small)
    assert prefix_trie.prefix_trie(df.filter("false")).count() == 0


def test_prefix_trie_in_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SUPER", 2)
    rows = [(100 * i, t, "u", f"t{min(t, 30)}") for i in range(5) for t in range(40 + i)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    assert sorted(map(tuple, prefix_trie.prefix_trie(df).collect()), key=str) == brute_trie(rows)
