"""Collocations, prefix tries and SimHash links against brute force; shards, levels and bounds don't move the result."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from llm_help import MEDIUM, documents, texts_by_id
from personalens.llm import collocations, ngram_join, prefix_trie, simhash


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def least_reachable(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# ------------------------------------------------------------------ collocations

def brute_phrases(rows):
    """{(lang, phrase): (a, l, r, n, score)} by counting words one by one, from the rules."""
    f, n = Counter(), Counter()
    for text, lang in ((t, "und" if x is None else x) for t, x in rows):
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered(text or "")):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= 10}
    out = {}
    for (lang, w), a in candidates.items():
        covered = any(other == lang and len(x) > len(w) and 100 * b >= 50 * a and any(x[i:i + len(w)] == w for i in range(len(x) - len(w) + 1))
                      for (other, x), b in candidates.items())
        cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        if not covered:
            out[lang, " ".join(w)] = (a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score)
    return out


@pytest.mark.parametrize("shard_words", [5, 60, 1 << 21])
def test_collocations_are_those_of_brute_force(spark, shard_words):
    rng = random.Random(5)
    signs = ["A", "b", "B", "c", "dd", "\u00e9", "x.", "y;", "\t", "\n", "\u00a0", "<tag>", "a\u200bz"]
    rows = [(" ".join(rng.choice(signs) for _ in range(rng.randint(0, 50))) if i % 9 else None, rng.choice(["en", None, "fr", ""])) for i in range(160)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(df, shard_words=shard_words).collect()}
    assert got == brute_phrases(rows) and len(got) > 50


def test_interval_extension_works_on_both_sides():
    words = "a b a b c 0 a b c a 0 b c".split()
    ids = {w: i for i, w in enumerate(["0", "a", "b", "c"])}
    seq = np.array([0, *(ids[w] for w in words), 0], np.int32)
    shard = collocations._shard("en", collocations._Ids({collocations.CUT: 0, b"a": 1, b"b": 2, b"c": 3}), [seq])
    index = collocations.Index(*(shard.column(c)[0].as_py() for c in ("words", "following", "preceding")))
    want = Counter(tuple(seq[i:i + 3].tolist()) for i in range(len(seq) - 2) if 0 not in seq[i:i + 3])
    *pairs, _ = index.extend("after", *index.single())
    for way in ("after", "before"):
        for first in ("after", "before"):
            *two, _ = index.extend(first, *index.single())
            phrases, _, _, count, _ = index.extend(way, *two)
            assert {tuple(p): n for p, n in zip(phrases.tolist(), count.tolist(), strict=True)} == want


def test_large_numbers_score_exactly(spark):
    df = spark.createDataFrame([(3_000_000_000_001, 3_000_000_000_007, 9_000_000_000_013)], "a long, l long, r long")
    assert df.select(collocations._score("l", "r")).first()[0] == 1000000 * 3_000_000_000_001 ** 2 // (3_000_000_000_007 * 9_000_000_000_013)


# ------------------------------------------------------------------ prefix trie

def brute_trie(rows):
    original = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            tie = hashlib.sha256((text or "").encode()).hexdigest()
            original[c].append(((turn is not None, turn or 0, role or "", tie), (role or "", text or "")))
    original = {c: [t for _, t in sorted(v)] for c, v in original.items()}
    paths = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - abs(c) % 5 * (1 if c >= 0 else -1)
        paths[c] = tuple(original.get(base, [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
            if d:
                children[p[:d - 1]].add(p[:d])
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_nodes", [1, 6, 90, prefix_trie.SHARD_NODES])
def test_trie_is_that_of_brute_force(spark, shard_nodes):
    rng = random.Random(11)
    rows = [(c, rng.choice([t, t, None, 1]), rng.choice(["u", "a", None]), rng.choice(["x", "yy", "\u00e9", None, "z" * 40]))
            for c in [*range(-7, 90), 10 ** 12] for t in range(rng.choice([0, 1, 2, 3, 5, 12]))]
    rows += [(500, t, "u", f"t{t % 3}") for t in range(200)] + [(c, 0, "u", "same") for c in range(1000, 1200)] + [(None, 0, "u", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    assert sorted((tuple(r) for r in prefix_trie.prefix_trie(df, shard_nodes).collect()), key=repr) == brute_trie(rows)


def test_find_close_matches_a_stack():
    rng = np.random.default_rng(2)
    for n in (1, 3, 500, 5000):
        signs, depth, left = [], 0, n
        while left or depth:
            go = left and (not depth or rng.random() < 0.52)
            signs.append(bool(go))
            depth, left = (depth + 1, left - 1) if go else (depth - 1, left)
        stack, want = [], {}
        for i, s in enumerate(signs):
            if s:
                stack.append(i)
            else:
                want[stack.pop()] = i
        at = np.flatnonzero(signs)
        assert prefix_trie.Parentheses(np.array(signs)).find_close(at).tolist() == [want[i] for i in at.tolist()]


# ------------------------------------------------------------------ SimHash

def brute_print(text):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", lowered(text)) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def test_simhash_is_that_of_brute_force(spark):
    texts = texts_by_id(spark, MEDIUM)
    ids = sorted(texts)
    prints = np.array([brute_print(texts[i]) for i in ids], np.uint64)
    root = least_reachable(len(ids), zip(*np.nonzero(np.bitwise_count(prints[:, None] ^ prints) <= 3), strict=True))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op13(spark, MEDIUM).collect()}
    assert got == {i: (f"{int(p):016x}", ids[r]) for i, p, r in zip(ids, prints, root, strict=True)}
    assert len(set(root)) < len(ids) == documents(spark, MEDIUM).count()


@pytest.mark.parametrize("most", [3, 200, simhash.BUCKET])
def test_no_link_is_lost_at_any_level(spark, most):
    rng = random.Random(9)
    prints = set()
    for _ in range(25):
        centre = rng.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints |= {0xFFFF << 48 | i for i in range(700)}  # one block in common, many near each other
    x = np.array(sorted(prints), np.uint64)
    want = least_reachable(len(x), zip(*np.nonzero(np.bitwise_count(x[:, None] ^ x) <= 3), strict=True))
    links = simhash.near_links(spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "cls long"), most).collect()
    place = {int(v): i for i, v in enumerate(x.view(np.int64))}
    pairs = [(place[r.a], place[r.b]) for r in links]
    joined = least_reachable(len(x), pairs)
    assert joined == want
    found = ngram_join.components(spark.createDataFrame(links)).collect()
    assert {place[r.cls] for r in found} == {i for p in pairs for i in p}
