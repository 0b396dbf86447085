"""Top-k inner products, ranked lexical search and spelling variants against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.oracle_check import duck_connection, duck_rows, spark_rows
from tidemill.llm import inner_products, lexical, queries, spelling

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_top_k(rows, k, scale=64):
    ints = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints.append((i, [max(-inner_products.LARGEST, min(inner_products.LARGEST, math.floor(scale * x))) for x in v]))
    out = Counter()
    for a, (i, q) in enumerate(ints):
        if i is None or i % 20:
            continue
        best = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(q, v)))), j is None, j or 0)
                      for b, (j, v) in enumerate(ints) if a != b)[:k]
        out.update((i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(best))
    return out


def found(df):
    return Counter(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("rows_a_stripe", [64, 16_384])
def test_top_k_of_odd_vectors(spark, monkeypatch, rows_a_stripe):
    """Nulls, short and empty vectors, repeated rows and ids, ties, a vector that a third of the rows hold."""
    monkeypatch.setattr(inner_products, "STRIPE_ROWS", rows_a_stripe)
    monkeypatch.setattr(inner_products, "QUERY_STEP", 8)
    monkeypatch.setattr(inner_products, "VECTOR_STEP", 50)
    rng = np.random.default_rng(1)
    hot = [0.5, -0.25, 1.0, 0.125]
    rows = [(i, (rng.normal(size=4) * rng.choice([0.1, 1, 5])).tolist()) for i in range(300)] + [(1000 + i, hot) for i in range(150)]
    rows += [(0, rows[0][1]), (20, hot), (None, hot), (None, [9.0, 9.0, 9.0, 9.0]), (40, None), (60, [1.0, None, 2.0, 3.0]),
             (80, [float("nan")] * 4), (100, [float("inf"), 0.0, 0.0, 0.0]), (120, [1.0]), (140, []), (160, [0.0] * 4),
             (180, [1.0, 1.0, 1.0, 1.0, 7.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, row string").repartition(5)
    assert found(inner_products.top_k(df, F.col("vec_id") % 20 == 0, 7)) == brute_top_k(rows, 7)


def test_top_k_of_large_integers_and_few_rows(spark):
    rows = [(20, [1e7, -1e7]), (1, [1e7, 1e7]), (2, [1e300, -1e300]), (3, [3.0, 4.0]), (40, [1e300, 1e300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    is_query = F.col("vec_id") % 20 == 0
    assert found(inner_products.top_k(df, is_query)) == brute_top_k(rows, 20)
    assert inner_products.top_k(df.where("false"), is_query).count() == 0
    assert inner_products.top_k(df.where("vec_id = 20"), is_query).count() == 0
    assert inner_products.top_k(df.where("vec_id < 20"), is_query).count() == 0


def test_bounds_leave_most_pairs_out():
    """With lengths and directions that differ, few pairs are multiplied in full, and the result is exact."""
    rng = np.random.default_rng(2)
    m = np.floor(rng.normal(size=(20_000, 32)) * 40 * 0.8 ** np.arange(32)).astype(np.int32)
    m = m[np.argsort(-(m.astype(float) ** 2).sum(axis=1))]
    energy, basis = np.linalg.eigh(m.T.astype(float) @ m)
    lead = int(np.searchsorted(np.cumsum(energy[::-1]), inner_products.LEADING * energy.sum())) + 1
    search = inner_products.Search(32, basis[:, ::-1].copy(), lead, 10, True)
    done = []
    search.pairs = lambda a, b: done.append(len(a)) or np.einsum("ij,ij->i", a.astype(np.int64), b)
    full = search.products
    search.products = lambda a, b: done.append(len(a) * len(b)) or full(a, b)
    q = m[5:400:5]
    low = np.full(len(q), np.iinfo(np.int64).min)
    r, c, s = search.best(np.arange(5, 400, 5), q, np.arange(len(m)), np.arange(len(m)), m, low, -low)
    want = q.astype(np.int64) @ m.T
    want[np.arange(len(q)), np.arange(5, 400, 5)] = low
    assert [s[r == k].tolist() for k in range(len(q))] == np.sort(want, axis=1)[:, ::-1][:, :10].tolist()
    assert sum(done) < len(q) * len(m) / 2


def brute_ranking(docs, items, k=20):
    terms = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    big_n, big_l = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    out = Counter()
    for item, text in items:
        scores = []
        for i, c in terms:
            m = 100 - 25 + 25 * sum(c.values()) * big_n // big_l
            s = sum(math.floor(1000 * math.log(float(2 * big_n + 2) / float(2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in TERM.findall((text or "").translate(LOWER)) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out.update((item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k]))
    return out


@pytest.mark.parametrize("coordinates", [4, 1024])
def test_lexical_search(spark, monkeypatch, coordinates):
    """Nulls, empty texts, one very long text, repeated rows, copies beyond k, counts beyond a sketch's cells."""
    monkeypatch.setattr(lexical, "COORDINATES", coordinates)
    monkeypatch.setattr(lexical, "_SHIFT", np.uint64(65 - coordinates.bit_length()))
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 50)
    monkeypatch.setattr(lexical, "BATCH_ROWS", 3)
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcÉé日Z9") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    text = lambda n: rng.choice([" ", "\n", "-", "_ "]).join(rng.choice(vocab) for _ in range(n))
    copy = text(30)
    docs = [(i, text(rng.randint(1, 60))) for i in range(200)] + [(1000 + i, copy) for i in range(90)]
    docs += [(5, copy), (5, copy), (None, copy), (None, text(9)), (7000, None), (7001, ""), (7002, " .,; "), (7003, (text(40) + " ") * 300),
             (7004, "abc " * 1000)]
    items = [(1, copy), (1, copy), (2, text(5)), (3, None), (4, ""), (5, "nowhere"), (None, text(3)), (6, text(12) * 3), (7, "abc ABC abc")]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, terms int").repartition(3)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    got = Counter(tuple(r) for r in lexical.search(lexical.index(d), q).collect())
    assert got == brute_ranking(docs, items)
    assert lexical.search(lexical.index(d.where("false")), q).count() == 0
    assert lexical.search(lexical.index(d), q.where("false")).count() == 0


def test_sketch_bounds_leave_most_documents_out(spark, monkeypatch):
    """On real documents the bounds stop the exact scoring early."""
    scored = []
    one = lexical.index(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    n = sum(int((np.frombuffer(b["lengths"], np.int64) > 0).sum()) for b in one)
    total = sum(int(np.frombuffer(b["lengths"], np.int64).sum()) for b in one)
    items = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    import pyarrow as pa
    hashes, begin = lexical._term_hashes(pa.array(items))
    asked = [np.unique(hashes[a:b]) for a, b in zip(begin[:-1], begin[1:])]
    df = Counter(t for b in one for t in np.frombuffer(b["terms"], np.uint64).tolist())
    batch = lexical.Batch(asked, [np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in a.tolist()]) for a in asked])
    best = lexical._Best(len(items), 20)
    for b in one:
        m = 75 + 25 * np.frombuffer(b["lengths"], np.int64) * n // total
        sketch = np.frombuffer(b["sketch"], np.uint8).reshape(-1, lexical.COORDINATES).astype(np.int64)
        bounds = lexical._impact(sketch, m[:, None]) @ batch.lookup
        scored.append(lexical._rescored(batch, best, np.array(b["doc_ids"]), m, np.frombuffer(b["offsets"], np.int64),
                                        np.frombuffer(b["terms"], np.uint64), np.frombuffer(b["counts"], np.uint32).astype(np.int64), bounds))
    assert sum(scored) < 0.5 * n * len(items)


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(docs):
    n = Counter()
    for i, t in docs:
        for run in RUN.findall(t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def brute_variants(words):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            if words[best] >= 5 * words[w]:
                form[w] = best
    out = set()
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return out


def variant_rows(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("alphabets, most", [((2, 5, None), 4), ((6, 24, None), 4096), ((None,), 1)])
def test_variants_in_every_alphabet(spark, alphabets, most):
    """Classes beyond the bound go on to finer alphabets; every pair is found once."""
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdeéÿZ") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    words = {}
    for w in base:
        words[w] = rng.choice([5, 30, 200, 1000])
        for _ in range(4):
            k = rng.randrange(len(w))
            v = rng.choice([w[:k] + w[k + 1:], w[:k] + "a" + w[k:], w[:k] + "b" + w[k + 1:]])
            words.setdefault(v, rng.choice([5, 6, 25, 150]))
    words.update({"aaaaaaa": 5, "aaaaaaaa": 25, "aaaaaaaaa": 125, "aaaaaaaaaa": 625, "q" * 3000: 9, "q" * 2999: 50, "r" + "q" * 2999: 9})
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert variant_rows(spelling.variants(df, 5, alphabets, most)) == brute_variants(words)


def test_vocabulary_and_grouping(spark, tmp_path):
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abéÉxZ") for _ in range(rng.randint(5, 8))) for _ in range(120)] + ["ÀÖ×÷øÿ", "g" * 90]
    text = lambda n: rng.choice([" ", "1", "日", "Ā", "¿"]).join(rng.choice(vocab) for _ in range(n))
    docs = [(i, text(50)) for i in range(400)] + [(None, text(50)), (None, None), (9, None), (10, ""), (11, "12 34"), (7, text(5000)), (7, text(50)), (7, text(50))]
    hit = next(i for i in range(10_000, 20_000) if zlib.crc32(f"{i}:{'g' * 90}".encode()) % 199 == 0)
    docs.append((hit, ("g" * 90 + " ") * 6))
    df = spark.createDataFrame([(i, t, "w") for i, t in docs], "doc_id long, text string, word string").repartition(3)
    words = brute_words(docs)
    assert {r["word"]: r["n"] for r in spelling.vocabulary(df).collect()} == words
    assert any(len(w) == 89 for w in words)                  # a run longer than the vector digest took a deletion
    assert variant_rows(spelling.grouped(df)) == brute_variants(words)
    assert spelling.grouped(df.where("false")).count() == 0


@pytest.mark.parametrize("key", ["op11_norm_sorted", "op12_max_sketches", "op13_reduced_alphabet"])
def test_registered_searches_match_sql(spark, key):
    got, want = spark_rows(queries.queries()[key](spark, SF_SMALL)), duck_rows(duck_connection(SF_SMALL), queries.oracle_sql()[key])
    assert got == want and got[1]
