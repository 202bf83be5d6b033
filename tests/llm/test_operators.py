"""The training-data operators against brute force, exact round trips and held-out accuracy,
and their defined results for nulls, empty texts, repeats, empty tables and clashing names."""

import collections
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from recspark.llm import fingerprints, language, lines, mixing, near_dup, packing, quality, suffix_dedup, token_counts, vectors
from recspark.llm.queries import QUERIES, SQL, vocabulary

from ..conftest import SF_MID, SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, bucket int, part int, size long, key string"


def table(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, len(r[1] or ""), 1, 2, 3, 4, "k") for r in rows], SCHEMA)


ODD = [(1, None, None, None), (2, "", "en", "a"), (3, "  \n\t ", "en", "a"), (4, "one", None, "a"), (5, "same words here for every copy of it", "en", None),
       (6, "same words here for every copy of it", "en", "b"), (7, "word " * 30_000, "en", "b"), (8, "日本語 é İ <|endoftext|> 'll it's\x1c", "xx", "a"),
       (9, "line one\nline two\nline one", "en", "a"), (None, "no id at all in this row of words", "en", "a"), (5, "same words here for every copy of it", "en", None)]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def test_every_operator_takes_empty_tables(spark):
    none = table(spark, []).limit(0)
    voc = vocabulary("word_bpe_49k.json")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for out in (mixing.mix(none), mixing.mixed_rows(none), packing.pack(none, voc), suffix_dedup.remove_repeats(none),
                language.predict(none, language.learn(none)), lines.drop_boilerplate(none, F.col("source")), fingerprints.digest(none),
                quality.classify(none, labels, F.col("source"), F.col("lang")), near_dup.classes(none), near_dup.drop_near(none),
                token_counts.digest(none, vocabulary("byte_bpe_50k.json")),
                vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))):
        assert out.count() == 0


def test_sql_agrees(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    for name, sql in SQL.items():
        got = QUERIES[name](spark, SF_SMALL).toPandas().sort_values("doc_id").reset_index(drop=True)
        want = con.execute(sql).df().sort_values("doc_id").reset_index(drop=True)[got.columns.tolist()]
        assert got.astype(str).equals(want.astype(str)), name


def test_registered_and_pipeline_rows(spark):
    names = E.queries()
    assert all(n in names for n in QUERIES) and "pipeline" in names
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame([tuple(r) for r in out.collect()], docs.schema)
    # all words of the mix lie in the pieces, once per row
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).toPandas()
    library = packing.WordIds(vocabulary("word_bpe_49k.json")).library
    want = sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert pieces["length"].sum() == want == corpus_pipeline.run(spark, SF_SMALL).agg(F.sum("length")).first()[0]


# ---- 1
def fill_levels(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in stopped]
        rest = total - sum(3 * sizes[s] for s in stopped)
        target = {s: 3 * sizes[s] if s in stopped else w[s] * rest / sum(w[x] for x in free) for s in names}
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            return target
        stopped |= over


def test_mix_targets_and_budgets(spark, odd):
    for d in (odd, table(spark, [(i, "w " * (1 + i % 7) * (40 if i % 9 == 0 else 1), "en", "s%d" % (i % 9)) for i in range(900)])):
        got = mixing.mix(d).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((r.doc_id is None, r.doc_id or 0) for r in d.collect())
        sizes = collections.Counter()
        for r in got:
            sizes[r.source] += r.size
        want = fill_levels(sizes)
        for s in sizes:
            mine = [r for r in got if r.source == s]
            assert mine[0].target == pytest.approx(want[s]) and mine[0].source_size == sizes[s]
            assert abs(sum(r.taken for r in mine) - want[s]) <= 1 + len(mine) * 0.01
            assert all(0 <= r.taken <= 3 * r.size for r in mine)
    assert sorted(map(str, mixing.mix(odd).collect())) == sorted(map(str, mixing.mix(odd.repartition(5)).collect()))


# ---- 2, 9
def check_pieces(pieces, texts, library, limit):
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts.items()}
    for i, mine in pieces.groupby("doc_id"):
        at = 0
        for p in mine.sort_values("start").itertuples():
            assert p.start == at and p.doc_tokens == len(ids[i])
            assert p.ids_crc32 == zlib.crc32(np.asarray(ids[i][at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids[i])
    assert set(pieces["doc_id"]) == set(ids)
    padding = 0
    for _, seq in pieces.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert (seq["offset"] == seq["length"].cumsum() - seq["length"]).all()
        n = int(seq["length"].sum())
        assert n <= limit
        padding += 0 if n & (n - 1) == 0 else limit - n
    assert padding <= 0.02 * pieces["length"].sum()


def test_packing_round_trip(docs, rows):
    voc = vocabulary("word_bpe_49k.json")
    library = packing.WordIds(voc).library
    check_pieces(packing.pack(docs, voc).toPandas(), dict(rows), library, 2048)
    got = packing.pack(docs, voc, max_tokens=256, max_segments=3, max_loss=100, loss=F.col("doc_id") % 2 == 0).toPandas()
    for _, seq in got.groupby("sequence_id"):
        assert len(seq) <= 3 and seq.loc[seq["doc_id"] % 2 == 0, "length"].sum() <= 100
    check_pieces(got, dict(rows), library, 256)


def test_packing_odd_rows(odd):
    got = packing.pack(odd.where("doc_id <> 5 or doc_id is null").withColumn("doc_id", F.coalesce("doc_id", F.lit(-1))), vocabulary("word_bpe_49k.json")).toPandas()
    want = {(-1 if r[0] is None else r[0]): r[1] for r in ODD if r[0] != 5}
    check_pieces(got, want, packing.WordIds(vocabulary("word_bpe_49k.json")).library, 2048)


ALPHABET = ["a", "B", "The", "ing", " ", "  ", "\n", "'s", "'re", "'", "!!", "é", "É", "é", "ß", "日本", "١", "12", "<|endoftext|>", "<|", "\x1c", "\xa0",
            "　", "😀", "İ", "Σ", "x'r", "\t", ".", "²", "ﬁ", "aaaa"]


def test_ids_and_prefix_counts_equal_the_library():
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 9))) for _ in range(1500)]
    words = packing.WordIds(vocabulary("word_bpe_49k.json"))
    for t, got in zip(texts, words.encode(texts)):
        assert got.tolist() == words.library.encode(t, add_special_tokens=False).ids, t
    counter = token_counts.PrefixCounter(vocabulary("byte_bpe_50k.json"))
    for t, p in zip(texts, counter.prefixes(texts)):
        n = [len(counter.library.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        assert [token_counts.tokens_at(p, i) for i in range(len(t) + 1)] == n, t
        assert token_counts.longest_prefix(p, 3) == max(i for i in range(len(t) + 1) if n[i] <= 3)


def test_token_counts(docs, rows, odd):
    library = token_counts.PrefixCounter(vocabulary("byte_bpe_50k.json")).library
    for d, want in ((docs, rows), (odd, [(r[0], r[1] or "") for r in ODD])):
        got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.digest(d, vocabulary("byte_bpe_50k.json")).collect())
        n = [len(library.encode(t, add_special_tokens=False).ids) for _, t in want]
        assert got == sorted((i or 0, len(t.encode()), k, k > 512) for (i, t), k in zip(want, n))


def test_merges_of_many_words_give_the_librarys_ids():
    words = packing.WordIds(vocabulary("word_bpe_49k.json"))
    rng = random.Random(5)
    some = sorted({"a", "aa", "the", "straße", "a" * 32, *("".join(rng.choice("abehinrstxäßğſ") for _ in range(rng.randint(1, 32))) for _ in range(4000))})
    ids, start = words.merges.of(some)
    got = np.split(ids, start[1:])
    assert all(g.tolist() == e.ids for g, e in zip(got, words.library.encode_batch_fast(some, add_special_tokens=False)))
    # no lower-case word of a usual text goes through the library one by one
    sent = []
    words._encode = lambda parts: sent.extend(parts) or [b"" for _ in parts]
    words._learn_cores = lambda parts: sent.extend(parts)
    words.encode([" ".join(some)])
    assert not sent and all(words.parts[w] == g.astype("<u4").tobytes() for w, g in zip(some, got))


# ---- 3
def removed(rows):
    first, out = {}, []
    rows = [(i, (t or "").encode()) for i, t in rows]
    for i, b in sorted((x for x in rows if x[0] is not None), key=lambda x: x[0]):
        for k in range(len(b) - 49):
            first.setdefault(b[k:k + 50], i)
    for i, b in rows:
        gone = bytearray(len(b))
        if i is not None:
            for k in range(len(b) - 49):
                if first[b[k:k + 50]] < i:
                    gone[k:k + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out.append((-1 if i is None else i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, y in zip(b, gone) if not y)).hexdigest()))
    return sorted(out)


def test_repeats_equal_brute_force(spark, docs, rows, odd, monkeypatch):
    rng = random.Random(3)
    base = "".join(rng.choice("ab ") for _ in range(3000))
    cut = [(i, "".join(base[(k := rng.randrange(2800)):k + rng.randrange(30, 200)] + rng.choice(["", "x", "yz"]) for _ in range(rng.randrange(1, 9))), "en", "a") for i in range(60)]
    for d, want in ((docs, rows), (odd, [(r[0], r[1]) for r in ODD if r[0] != 7] + [(7, ODD[6][1])]), (table(spark, cut), [(r[0], r[1]) for r in cut])):
        got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in suffix_dedup.remove_repeats(d).collect())
        assert got == removed(want)
    # a document in several overlapping parts
    import pyarrow as pa
    monkeypatch.setattr(suffix_dedup, "BLOCK", 100)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["x" * 1000]), pa.array([5])], ["a", "b", "c"])
    parts = [p for b in suffix_dedup._blocks([batch]) for p in b]
    assert sum(len(p[1]) - 49 for p in parts) == 951 and [p[2] for p in parts] == list(range(0, 951, 100))


# ---- 4
def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = language.predict(docs, language.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for h, i in zip(got["held_out"], got["doc_id"]))
    held = got[got["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.95 and got["score"].between(0, 1).all()


def test_language_code_length_is_that_of_the_tree():
    code = language._codes([b"abcabd", b"bca"])
    trees = language.Trees(["x"], np.zeros(len(code), int), code, np.ones(len(code), int))
    text, pad = b"abcd", b"\0\0\0"
    train = [pad + b"abcabd", pad + b"bca"]

    def cost(context, byte, k):
        if k < 0:
            return 1 / 256
        c = collections.Counter(t[j] for t in train for j in range(3, len(t)) if t[j - k:j] == context[3 - k:])
        n, kinds = sum(c.values()), len(c)
        if not n:
            return cost(context, byte, k - 1)
        return c[byte] / (n + kinds) if c[byte] else kinds / (n + kinds) * cost(context, byte, k - 1)

    want = -sum(math.log2(cost((pad + text)[j:j + 3], text[j], 3)) for j in range(len(text)))
    assert trees.code_lengths([text])[0, 0] == pytest.approx(want, rel=1e-5)


def test_language_odd_rows(odd):
    got = {(r.doc_id, r.lang_pred, r.score) for r in language.predict(odd, language.learn(odd)).collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)} <= got and len(got) >= 9


# ---- 5
def test_lines_by_host(spark):
    pages = table(spark, [(i, f"page {i}\nfoot  \n\nfoot" if i % 2 else f"page {i}", "en", "h" if i < 40 else None) for i in range(60)] + [(99, None, "en", "h")])
    got = {r.doc_id: r for r in lines.drop_boilerplate(pages, F.col("source"), ratio=0.45).collect()}
    assert got[1].text == "page 1\n" and got[1]._line_dropped == 2 and got[0].text == "page 0" and got[41].text == "page 41\n" and got[99].text is None
    assert all(r._line_dropped == 0 for r in lines.drop_boilerplate(pages, F.col("source"), ratio=0.6).collect())


# ---- 6
def sketch_of(text, k=128):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
    def run(xs):
        seed = 42
        for x in xs:
            seed = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), seed)
        return seed - (1 << 64) if seed >> 63 else seed
    s = {run(h[i:i + 5]) for i in range(max(1, len(h) - 4))} if h else set()
    return sorted(s)[:k]


def test_fingerprints(docs, rows):
    got = {r.doc_id: r for r in fingerprints.digest(docs).collect()}
    rows = sorted(rows)
    assert len(got) == len(rows)
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        a, b, c = sketch_of(t), sketch_of(edited), sketch_of(nxt)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == "".join(f"{x & (1 << 64) - 1:016X}" for x in a)
        for x, y in ((b, r.near_edited), (c, r.near_next)):
            u = sorted(set(a) | set(x))[:128]
            assert y == pytest.approx(len(set(a) & set(x) & set(u)) / len(u) if u else 1.0)


def test_fingerprints_merge_and_odd_rows(spark, odd):
    assert fingerprints.digest(odd).count() == len(ODD)
    parts = odd.select(F.lit("g").alias("g"), fingerprints.sketch(F.col("text"), 16).alias("s"))
    merged = fingerprints.merge_groups(parts, ["g"], "s", 16).first().s
    assert merged == sorted({h for r in parts.collect() for h in r.s})[:16]


# ---- 7
def test_quality_keeps_clean_rejects_junk(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels, F.col("source"), F.col("lang")).join(labels, "doc_id").toPandas()
    kept = got["_q_quality"] >= quality.CUT
    assert kept[got["quality"] == 1].mean() > 0.98 and kept[got["quality"] == 0].mean() < 0.1


def test_quality_scores_each_text_once(spark, docs):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    got = quality.reject(docs, labels, F.col("source"), F.col("lang"))
    assert got._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1      # each is a worker of its own in a task
    want = quality.classify(docs, labels, F.col("source"), F.col("lang")).where(F.col("_q_quality") >= quality.CUT)
    kept = sorted(r.doc_id for r in got.collect())
    assert kept == sorted(r.doc_id for r in want.collect()) and 0 < len(kept) < docs.count()


def test_quality_sites_shrink(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.reject(odd, none, F.col("source"), F.col("lang")).count() == len(ODD)
    scored = spark.createDataFrame([("a", "x", 0.9)] * 200 + [("a", "y", 0.1)] + [("b", "z", 0.1)] * 200 + [(None, None, 0.9)], "_q_host string, _q_path string, _q_p double")
    got = {r["_q_path"]: r for r in quality.site_posteriors(scored).collect()}
    y = got["y"]
    assert got["x"].prior > 0.8 > 0.3 > got["z"].prior and (y.y + y.k * y.prior) / (y.n + y.k) > 0.2


# ---- 8
def near_classes(rows):
    sets = {i: collections.Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) for i, t in rows if (w := (t or "").split())}
    df = collections.Counter(x for s in sets.values() for x in s)
    idf = {x: math.log((1 + len(sets)) / (1 + n)) + 1 for x, n in df.items()}
    holds, root = collections.defaultdict(list), {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        for x in s:
            holds[x].append(i)
    weight = {i: sum(n * idf[x] for x, n in s.items()) for i, s in sets.items()}
    for i, s in sets.items():
        for j in {j for x in s for j in holds[x] if j > i}:
            low = sum(min(n, sets[j][x]) * idf[x] for x, n in s.items())
            if low / (weight[i] + weight[j] - low) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in root}


def test_near_classes_equal_brute_force(spark, docs, rows):
    assert dict(map(tuple, near_dup.classes(docs).collect())) == near_classes(rows)
    rng = random.Random(9)
    base = [f"w{k}" for k in range(300)]
    made = []
    for i in range(400):     # one large group of near copies, half of them with many edits
        w = list(base)
        for _ in range(1 if i % 2 else 12):
            w[rng.randrange(300)] = f"e{rng.randrange(10 ** 6)}"
        made.append((i, " ".join(w)))
    made += [(400 + i, " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(40))) for i in range(50)]
    got = dict(map(tuple, near_dup.classes(table(spark, [(i, t, "en", "a") for i, t in made])).collect()))
    want = near_classes(made)
    assert sum(got[i] != want[i] for i in want) <= 2


@pytest.mark.parametrize("table_size", [1 << 20, 300])
def test_weights_equal_brute_force(spark, docs, rows, monkeypatch, table_size):
    monkeypatch.setattr(near_dup, "TABLE", table_size)
    sets = [got[0] for got in near_dup.shingled([t for _, t in rows]) if got]
    df = collections.Counter(x for s in sets for x in s.tolist())
    floor = max(1, -(-df.total() // table_size))
    weights = near_dup.inverse_frequencies(docs)
    assert weights.n == len(sets) and weights.floor == floor and len(weights.keys) == sum(n > floor for n in df.values()) <= table_size
    want = [math.log((1 + len(sets)) / (1 + max(floor, n))) + 1 for n in df.values()]
    assert np.allclose(weights.of(np.array(list(df), np.uint64)), want, rtol=1e-6)
    some = np.array(list(df)[:50], np.uint64)
    some.sort()
    again = near_dup.as_set(some, np.arange(1, 51))          # repeats weigh what the shingle weighs
    assert len(again) == 50 * 51 // 2 == len(np.unique(again))
    assert math.isclose(weights.of(again).sum(), (weights.of(some) * np.arange(1, 51)).sum(), rel_tol=1e-5)


def test_frequencies_below_the_table_count_too(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "TABLE", 64)
    rng = random.Random(13)
    common = [[f"c{p}x{k}" for k in range(20)] for p in range(2)]      # passages in 120 texts each
    own = [f"s{k}" for k in range(130)]
    made = [(i, " ".join(own + common[i])) for i in range(2)]
    made += [(2 + i, " ".join([f"u{rng.randrange(10 ** 7)}" for _ in range(30)] + common[i % 2])) for i in range(238)]
    made += [(240 + i, " ".join(f"v{rng.randrange(10 ** 7)}" for _ in range(30))) for i in range(80)]
    sets = [got[0] for got in near_dup.shingled([t for _, t in made])]
    assert -(-sum(map(len, sets)) // 64) > 120                         # all would weigh alike
    want = near_classes(made)
    assert want[1] == 0 and plain_classes(made)[1] == 1                # near by exact weights only
    docs = table(spark, [(i, t, "en", "a") for i, t in made])
    assert dict(map(tuple, near_dup.classes(docs).collect())) == want


def test_weights_of_a_block_equal_brute_force(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(near_dup, "_BLOCK", 1 << 16)
    sets = [got[0] for got in near_dup.shingled([t for _, t in rows]) if got]
    df = collections.Counter(x for s in sets for x in s.tolist())
    held = near_dup.blocks(near_dup._identified(docs, "doc_id", "text"))
    n, answers = near_dup.frequencies(held)
    assert n == len(sets) and held.select("block").distinct().count() > 3
    packed = {r.block: r.p for r in answers.groupBy("block").agg(F.collect_list("packed").alias("p")).collect()}
    for r in held.groupBy("block").agg(F.collect_list("text").alias("t")).collect():
        weights = near_dup.block_weights(n, packed.get(r.block, []))
        for got in filter(None, near_dup.shingled(r.t)):
            assert np.allclose(weights.of(got[0]), [math.log((1 + n) / (1 + df[x])) + 1 for x in got[0].tolist()], rtol=1e-6)


def test_packed_blocks_hold_every_row_and_go_again(spark, docs, odd, monkeypatch):
    monkeypatch.setattr(near_dup, "_BLOCK", 1 << 16)
    for d in (docs, odd):
        d = near_dup._identified(d, "doc_id", "text")
        held = near_dup.packed_blocks(d)
        got = held.collect()
        assert len(got) == len({r.block for r in got}) > 2
        opened = [x for r in got for part in near_dup._opened(pa.scalar(bytes(r.packed), pa.binary())) for x in part.to_pylist()]
        want = [{"doc_id": r.doc_id, "text": None if r.text is None else r.text.encode(), "raw": r.raw} for r in d.collect()]
        assert sorted(map(str, opened)) == sorted(map(str, want))
        assert sum(r.size for r in got) == sum(len(w["text"] or b"") for w in want)
        rows = near_dup.frequencies(near_dup.blocks(d)), near_dup.frequencies(held)
        assert rows[0][0] == rows[1][0] and sorted(map(str, rows[0][1].collect())) == sorted(map(str, rows[1][1].collect()))
    # texts, their frequencies and their shingles go as soon as the next table is written
    written, gone, keep = [], [], near_dup.materialize
    monkeypatch.setattr(near_dup, "materialize", lambda df, name: written.append(keep(df, name)) or written[-1])
    monkeypatch.setattr(near_dup, "discard", lambda df: gone.append(df.written_to.split("/recspark-")[1][:-33]))
    near_dup.classes(docs)
    assert sorted(gone) == ["near-answers", "near-buckets", "near-documents", "near-sets"]


def plain_classes(rows):
    sets = {i: collections.Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) for i, t in rows if (w := t.split())}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and (low := (sets[i] & sets[j]).total()) >= 0.8 * (sets[i].total() + sets[j].total() - low):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in root}


def test_near_copies_of_a_large_group_by_plain_jaccard(spark):
    rng = random.Random(11)
    base = [f"w{k}" for k in range(100)]
    made = []
    for i in range(450):     # a third are copies of one text, each with a changed word of its own
        w = list(base) if i % 3 == 0 else [f"u{rng.randrange(10 ** 7)}" for _ in range(100)]
        w[rng.randrange(100)] = f"e{i}"
        made.append((i, " ".join(w)))
    want = plain_classes(made)
    assert {want[i] for i in range(0, 450, 3)} == {0}
    assert near_classes(made) != want             # by weight alone most copies are too far apart
    assert dict(map(tuple, near_dup.classes(table(spark, [(i, t, "en", "a") for i, t in made])).collect())) == want


def test_plain_samples_agree_like_plain_jaccard():
    sampler, rng = near_dup.Sampler(100), np.random.default_rng(3)
    for n in (12, 60, 900):
        agree = []
        for _ in range(200):
            x = rng.integers(0, 2 ** 63, n * 10 // 8, dtype=np.uint64)
            a, b = np.sort(x[:n]), np.sort(x[-n:])
            agree.append((sampler.plain(a) == sampler.plain(b)).mean() - near_dup.plain_jaccard(a, b))
        assert abs(np.mean(agree)) < 0.02


def test_near_odd_rows(odd):
    got = {r.doc_id: r.class_id for r in near_dup.classes(odd).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, 9: 9}
    assert sorted(str(r.doc_id) for r in near_dup.drop_near(odd).collect()) == sorted(map(str, [1, 2, 3, 4, 5, 7, 8, 9, None]))


# ---- 10
def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 16))
    x = np.concatenate([x, x[:40] + rng.normal(size=(40, 16)) * 0.05, np.repeat(x[7:8], 100, 0), x[9] + rng.normal(size=(120, 16)) * 0.1])
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [1.0, None]), (1004, []), (1005, [float("inf")] * 16), (1006, [1.0])]
    got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(data + bad, "vec_id long, embedding array<double>")).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    found = sum(got[i].n_links for i in range(len(x)))
    assert 0.98 * (near.sum() - len(x)) <= found <= near.sum() - len(x)
    for i in range(len(x)):
        assert got[i].n_links <= near[i].sum() - 1 and got[i].kept == (got[i].component_id == i)
    assert all(got[i].n_links == 0 and got[i].kept and got[i].component_id == i for i, _ in bad)
    assert got[345].component_id == got[7].component_id == min(7, got[7].component_id)


@pytest.mark.parametrize("groups", [1394, 3])     # rare links, and many
def test_vectors_audit_sees_a_search_that_finds_only_itself(monkeypatch, groups):
    rng = np.random.default_rng(6)
    x = vectors._unit(rng.normal(size=(groups, 32))[np.roll(np.arange(1400) % groups, 10)] + rng.normal(size=(1400, 32)) * 0.05)
    at, twin = vectors.twins(x, 0.95)
    assert ((x[at] * twin).sum(axis=1) >= 0.95).all() and len(at) == 256
    graph, whole = vectors.Graph(np.concatenate([x, twin])), vectors.Graph.search
    assert vectors.audited_beam(graph, x, at, twin, 0.95) < 400

    def poor(self, q, beam, enough):
        if beam >= len(self.x):
            return whole(self, q, beam, enough)
        return [self.order[[k]] for k in (q.astype(np.float32) @ self.x.T).argmax(axis=1)]

    monkeypatch.setattr(vectors.Graph, "search", poor)
    assert vectors.audited_beam(graph, x, at, twin, 0.95) == len(x) + len(twin)
    got = vectors.linked(graph, x, x, 0.95, np.arange(len(x)), len(x) + len(twin))
    assert [len(g) for g in got] == ((x @ x.T >= 0.95).sum(axis=1) - 1).tolist()


def test_vectors_answered_by_graphs(spark, monkeypatch):
    """20,000 vectors in 8 shards with rare links and groups: the graphs answer, not brute force."""
    rng = np.random.default_rng(8)
    n = 20_000
    x = rng.normal(size=(n, 24))
    x[18_000:19_500] = x[:1500] + rng.normal(size=(1500, 24)) * 0.2          # pairs
    x[19_500:] = x[77] + rng.normal(size=(500, 24)) * 0.15                   # one group
    x = x[rng.permutation(n)]
    got = vectors.near_vectors(spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": list(x)})), shard_rows=2500).toPandas()
    got = got.sort_values("vec_id")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = np.concatenate([(u[k:k + 1000] @ u.T >= 0.95).sum(axis=1) - 1 for k in range(0, n, 1000)])
    assert (got["n_links"].to_numpy() <= want).all() and got["n_links"].sum() >= 0.98 * want.sum()
    rare = (want > 0) & (want < 5)
    assert rare.sum() > 1000 and got["n_links"].to_numpy()[rare].sum() >= 0.98 * want[rare].sum()
    part = vectors._unit(x[::8].copy())
    at, twin = vectors.twins(part, 0.95)
    graph = vectors.Graph(np.concatenate([part, twin]))
    assert vectors.audited_beam(graph, part, at, twin, 0.95) <= 384 and len(at) <= 0.02 * n


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(2)
    data = [(i, rng.normal(size=1 + i % 5).tolist()) for i in range(60)]
    got = vectors.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in data}
    want = {i: sum(j != i and len(v) == len(u) and u @ v >= 0.95 for j, v in unit.items()) for i, u in unit.items()}
    assert {r.vec_id: r.n_links for r in got} == want


# ---- rows that repeat an id with another text or vector, and columns named like the operators' own
def test_repeated_ids_with_other_texts_keep_every_text(spark):
    a, b, c = ("".join(chr(97 + (i * i * k) % 26) for i in range(900)) for k in (3, 7, 11))
    spaced = [" ".join(x[i:i + 6] for i in range(0, 900, 6)) for x in (a, b, c)]
    rows = [(1, spaced[0]), (1, spaced[1]), (2, spaced[0]), (3, spaced[1]), (4, spaced[2]), (4, spaced[2]), (None, spaced[2]), (None, None)]
    d = table(spark, [(i, t, "en", "s") for i, t in rows])
    kept = sorted((r.doc_id or 0, r.text or "") for r in near_dup.drop_near(d).collect())
    assert kept == sorted([(1, spaced[0]), (1, spaced[1]), (4, spaced[2]), (0, spaced[2]), (0, "")])
    assert sorted(map(tuple, near_dup.classes(d).collect())) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]
    z = "z" * 404
    more = rows + [(5, z), (5, z.replace("z", "y")), (6, spaced[1][:400] + "!" + z), (6, "short")]
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in suffix_dedup.remove_repeats(table(spark, [(i, t, "en", "s") for i, t in more])).collect())
    assert got == removed(more)


def test_repeated_ids_with_other_vectors(spark):
    e = np.eye(4)
    data = [(1, e[0]), (1, e[1]), (2, e[0]), (3, e[1]), (4, e[2]), (4, e[2]), (5, e[2] * 2)]
    got = vectors.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in data], "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 2, 4), (4, 2, 4), (5, 2, 4)]


def test_pipeline_rows_keep_columns_of_any_name(spark):
    names = ["_copies", "_epoch", "_mix", "_mix_source", "_nd_id", "_nd_row", "size", "key", "of", "cut", "row", "raw", "n", "keep", "copies", "s2"]
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(30)), f"s{i % 3}", *range(len(names))) for i in range(1, 40)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    for out in (mixing.mixed_rows(d), near_dup.drop_near(d)):
        got = out.collect()
        assert out.columns == d.columns and got and {tuple(r) for r in got} <= {tuple(r) for r in rows}


def test_documents_sampled_together_as_one_by_one(monkeypatch):
    """F op8 of round 3: the band keys of many documents come from a bounded number of array operations, not
    some a document, and are those of each document alone."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 300, n)) for n in rng.integers(1, 400, 60)] + ["a a a a a a a a a a", "x"]
    sets = [got for got in near_dup.shingled(texts) if got]
    keys = np.unique(np.concatenate([s >> near_dup._KEY for s, _ in sets]))
    idf = near_dup.Weights(100, 1, keys[::3], np.arange(len(keys[::3])) % 50 + 2)
    sampler, calls, mix = near_dup.Sampler(100), [], near_dup.mix
    one = np.concatenate([sampler.bands([x], idf, 20) for x in sets])
    monkeypatch.setattr(near_dup, "mix", lambda h: calls.append(len(h)) or mix(h))
    assert (sampler.bands(sets, idf, 20) == one).all() and one.shape == (len(sets), 40)
    assert len(calls) < 4 * len(sets)
    shingles, counts = sets[0]
    weights, seeds = counts * idf.of(shingles), sampler.seeds
    want = {}
    for seed in seeds[100:]:        # by the definition: a sample takes the smallest value of the first deal that reaches it
        to = (mix(shingles ^ seed) % np.uint64(100)).astype(int)
        value, t = sampler._draw(mix(shingles + seed), np.log(weights).astype(np.float32))
        now = {k: min((value[i], i) for i in np.flatnonzero(to == k))[1] for k in set(to.tolist()) - set(want)}
        want |= {k: sampler._codes(shingles[i:i + 1], t[i:i + 1])[0] for k, i in now.items()}
    got = sampler.sample(shingles, weights)
    assert len(want) > 50 and all(got[k] == code for k, code in want.items())
