"""Sharding, spelling variants and periodic runs against brute force, with their defined results."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from recspark.llm import runs, sharding, spelling
from recspark.llm.queries import QUERIES

from ..conftest import SF_SMALL
from .test_operators import ODD, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


def test_empty_tables(spark):
    none = table(spark, []).limit(0)
    for out in (sharding.digest(none), spelling.variants(none), runs.digest(none), runs.collapse_repeats(none)):
        assert out.collect() == []


# ------------------------------------------------------------------ sharding
def _loads(rows):
    by = collections.defaultdict(int)
    for r in rows:
        by[r.shard] += r.size
    return [by[s] for s in range(8)]


def _textbook(texts):
    sizes = collections.Counter()
    for t in texts:
        sizes[t or ""] += len((t or "").encode()) + 1
    heap = [(0, s) for s in range(8)]
    for size in sorted(sizes.values(), reverse=True):
        load, s = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, s))
    return [x for x, _ in heap]


def _check_shards(out, texts):
    assert sorted(r.text_crc32 for r in out) == sorted(zlib.crc32((t or "").encode()) for t in texts)
    home = collections.defaultdict(set)
    slots = collections.defaultdict(list)
    for r in out:
        home[r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
    assert all(len(s) == 1 for s in home.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_as_near_equal_as_the_textbook_heap(spark, docs):
    out = QUERIES["op11_sharding"](spark, SF_SMALL).collect()
    _check_shards(out, [t for _, t in docs])
    mine, best = _loads(out), _textbook([t for _, t in docs])
    assert max(mine) - min(mine) <= max(best) - min(best) + 0.001 * sum(best) / 8


def test_shards_of_hot_groups_long_texts_and_many_small_ones(spark):
    rnd = random.Random(2)
    texts = ["hot text " * 5] * 3000 + ["z" * 60_000, None, "", ""] + ["w" * rnd.randrange(400) + str(i) for i in range(6000)]
    rows = [(i if i % 50 else None, t, "en", "a") for i, t in enumerate(texts)]
    out = sharding.digest(table(spark, rows).repartition(5)).collect()
    _check_shards(out, texts)
    mine, best = sorted(_loads(out)), sorted(_textbook(texts))
    assert max(mine) - min(mine) <= max(best) - min(best) + 0.002 * sum(best) / 8
    again = sharding.digest(table(spark, rows).repartition(2)).collect()
    assert {(r.doc_id, r.text_crc32, r.shard) for r in out} == {(r.doc_id, r.text_crc32, r.shard) for r in again}


def test_one_group_larger_than_a_share_has_a_shard_to_itself(spark):
    rows = [(i, "big " * 200, "en", "a") for i in range(500)] + [(1000 + i, f"small {i}", "en", "a") for i in range(70)]
    out = sharding.digest(table(spark, rows)).collect()
    _check_shards(out, [r[1] for r in rows])
    loads = sorted(_loads(out))
    assert loads[-1] == 500 * 801 and max(loads[:-1]) - min(loads[:-1]) <= 10


def test_shards_of_odd_rows(odd):
    _check_shards(sharding.digest(odd).collect(), [r[1] for r in ODD])


# ------------------------------------------------------------------ spelling
def _words(rows):
    n = collections.Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(low)
            h = zlib.crc32(f"{d}:{w}".encode())
            if d is not None and h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _variants(rows):
    n = _words(rows)
    near = collections.defaultdict(list)
    names = sorted(n)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            if abs(len(a) - len(b)) <= 1 and _one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in names:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in names:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def _found(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("symbols", [1, 2, 10])
def test_variants_of_dense_words_match_brute_force(spark, symbols):
    """Words over two or three letters: every edit at every place, runs of equal letters, chains of forms."""
    rnd = random.Random(symbols)
    words = {"".join(rnd.choice("ab" if i % 2 else "aéB") for _ in range(rnd.choice([6, 7, 7, 8, 8, 9, 10]))) for i in range(260)}
    words |= {"aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababa", "bababab", "x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499}
    rows = [(i, " ".join(rnd.choice([w, w.upper()]) for w in rnd.sample(sorted(words), 120)) + "\n7-x", "en", "a") for i in range(20)]
    rows += [(100, "aaaaaaa " * 5000, "en", "a"), (101, ("aaaaaaaa " * 400), "en", "a"), (None, "aaaaaaab " * 40, "en", "a"), (102, None, "en", "a")]
    got = _found(spelling.variants(table(spark, rows).repartition(3), n_symbols=symbols))
    want = _variants([(r[0], r[1]) for r in rows])
    assert got == want
    assert sum(w[4] for w in want) > 200 and any(w[1] and w[2] != w[1] for w in want)


def test_variants_of_documents_match_brute_force(spark, docs):
    got = _found(QUERIES["op12_spelling"](spark, SF_SMALL))
    assert got == _variants(docs) and len(got) > 1000


def test_variants_of_odd_rows(odd):
    assert _found(spelling.variants(odd)) == _variants([(r[0], r[1]) for r in ODD])


# ------------------------------------------------------------------ periodic runs
def _runs(w):
    n, best = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(12, 2 * q):
                best.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def _runs_row(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = _runs(w)
    drop = {i for s, m, q in found for i in range(s + q, s + m)}
    kept = hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest()
    listed = hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
    if not found:
        return doc_id, 0, None, None, None, None, listed, kept
    s, m, q = min(found, key=lambda r: (-r[1], r[0], r[2]))
    return doc_id, len(found), s, m, q, 1000 * m // q, listed, kept


def test_cover_holds_every_difference():
    assert {(a - b) % runs.MODULUS for a in runs.COVER for b in runs.COVER} == set(range(runs.MODULUS))


@pytest.mark.parametrize("laid_out", [16, 4096])
def test_runs_of_words_match_brute_force(laid_out):
    old, runs.LAID_OUT = runs.LAID_OUT, laid_out
    runs._laid_out.cache_clear()
    rnd = random.Random(laid_out)
    try:
        for _ in range(250):
            n, k = rnd.choice([5, 12, 30, 80, 200, 400]), rnd.choice([1, 2, 3, 5, 50])
            w = [rnd.randrange(k) for _ in range(n)]
            for _ in range(rnd.randrange(4)):
                a = rnd.randrange(n)
                p, m = 1 + rnd.randrange(max(1, (n - a) // 2)), rnd.randrange(n - a)
                for i in range(a + p, min(n, a + m)):
                    w[i] = w[i - p]
            assert [tuple(x) for x in runs.find_runs(np.array(w)).tolist()] == _runs(w)
        a, b = [0], [0, 1]
        while len(b) < 2500:                      # Fibonacci words hold most runs
            a, b = b, b + a
        assert [tuple(x) for x in runs.find_runs(np.array(b)).tolist()] == _runs(b)
    finally:
        runs.LAID_OUT = old
        runs._laid_out.cache_clear()


def test_runs_of_documents_match_brute_force(spark, docs):
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_runs"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for d, t in docs:
        if len(t) < 12_000:
            assert got[d] == _runs_row(d, t)
    assert sum(r[1] > 0 for r in got.values()) > 15


def test_runs_of_odd_rows_and_very_long_texts(spark, odd):
    got = [tuple(r) for r in runs.digest(odd).collect()]
    assert collections.Counter(r for r in got if r[0] != 7) == collections.Counter(_runs_row(d, t) for d, t, *_ in ODD if d != 7)
    assert [r[1:6] for r in got if r[0] == 7] == [(1, 0, 30_000, 1, 30_000_000)]
    text = " ".join(f"w{i * i % 9973}" for i in range(400_000)) + " end" * 400_000      # about 4 MB
    row = runs.collapse_repeats(table(spark, [(3, text, "en", "a")])).first()
    assert row.n_runs >= 2 and row.text == _collapsed(WORD.findall(text))


def _collapsed(w):
    found = runs.find_runs(np.unique(w, return_inverse=True)[1])
    keep = np.ones(len(w), bool)
    for s, m, q in found:
        assert w[s + q:s + m] == w[s:s + m - q]
        keep[s + q:s + m] = False
    return " ".join(x for x, k in zip(w, keep) if k)
