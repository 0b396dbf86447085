"""Every operator against a brute-force version, and its defined cases."""

import base64
import hashlib
import json
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemill.llm import (bpe, bwt_repeats, common, fingerprints, ngram_join, packing, quality, queries, repeats, sharding,
                          url_lists, warc)
from tidemill.llm.pretokens import RunCache, kept
from tidemill.llm.tokenizers import PATTERN, RANK_FILE, TOKENIZER_FILE

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, codes string, block string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with names used inside."""
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base, passage = text(120), text(60)
    near = base.split()
    near[60] = "Changed"
    rows = [(1, base), (2, base.upper().lower()), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (7, "one"),
            (8, "one two three"), (9, text(9000)), (None, text(40)), (None, text(40)), (10, "x" * 30_000),
            (11, text(30) + " " + passage + " " + text(30)), (12, passage + "\n" + text(50)), (13, text(20) + "\r\n" + passage),
            (14, "日本語 テキスト \U0001f600 " * 30), (15, "*** !!! *** " * 40)]
    return spark.createDataFrame([(i, t, "c", "b") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return common.table(spark, SF_SMALL, "documents", "doc_id", "text")


def rows_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def test_quality_base_counts(spark, odd, none):
    got = Counter(tuple(r)[:7] for r in quality.rules(odd, quality.Model()).collect())
    want = Counter()
    for i, t in rows_of(odd):
        words = WORD.findall(t.encode())
        lines = [x for x in t.split("\n") if WORD.search(x.encode())]
        seen = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
        hit = {j for k in range(len(words) - 7) if seen[tuple(words[k:k + 8])] > 1 for j in range(k, k + 8)}
        want[(i, len(words), sum(len(w.decode()) for w in words), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
              len(hit), len(words) < 20 or 100 * len(hit) > 30 * len(words))] += 1
    assert got == want
    assert quality.rules(none, quality.Model()).count() == 0


def test_quality_model_separates_labelled_documents(spark, docs):
    labels = common.table(spark, "/root/testdata/sf0.01", "labels", "doc_id", "quality")
    held = common.table(spark, "/root/testdata/sf0.01", "documents", "doc_id", "text")
    train = labels.where("doc_id % 2 = 0")
    judged = quality.rules(held, quality.fit(held, train)).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed")
    right, n = judged.agg(F.sum((F.col("kept") == (F.col("quality") == 1)).cast("int")), F.count("*")).first()
    assert right >= 0.95 * n


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(5)
    for _ in range(30):
        model = quality.Model(step=rng.normal(size=(2, 2)))
        s = rng.normal(size=(6, 2))
        paths = [[(p >> k) & 1 for k in range(6)] for p in range(64)]
        score = lambda p: sum(s[k, x] for k, x in enumerate(p)) + sum(model.step[a, b] for a, b in zip(p, p[1:]))
        assert score(model.decode(s).tolist()) == pytest.approx(max(map(score, paths)))


def brute_components(rows, size, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall(t.encode().lower())
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    out = Counter()
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[k] and rows[j][0] is not None]
        out[(i, len(sets[k]), (min(ids) if ids else None) if sets[k] else i)] += 1
    return out


def test_ngram_join(spark, odd, none, docs, monkeypatch):
    for df in (odd, docs):
        got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(df, 4, 85).collect())
        assert got == brute_components(rows_of(df), 4, 85)
    assert ngram_join.join(none).count() == 0
    kept = {r["doc_id"] for r in ngram_join.one_of_each(odd).collect()}
    assert {1, 7, 9, 14} <= kept and not kept & {2, 3} and None in kept


def brute_links(rows, size, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall(t.encode().lower())
        sets.append(frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, pairs


@pytest.mark.parametrize("block", [ngram_join.LINK_BLOCK, 7])
def test_ngram_join_counts_every_link(spark, odd, none, monkeypatch, block):
    """Near copies in a dense group: links between two members that a hub connects are counted and given out."""
    monkeypatch.setattr(ngram_join, "LINK_BLOCK", block)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(40):
        words = list(base)
        words[rng.randrange(120)] = f"x{k}"
        rows += [(100 + k, " ".join(words))] * (1 + k % 3 // 2)
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    rows = rows_of(df)
    sets, pairs = brute_links(rows, 4, 85)
    n = Counter(x for pair in pairs for x in pair)
    assert Counter((r["doc_id"], r["n_links"]) for r in ngram_join.join(df, 4, 85).collect()) == Counter((i, n[k]) for k, (i, _) in enumerate(rows))
    least = {s: min((i for (i, _), x in zip(rows, sets) if x == s and i is not None), default=None) for s in sets}
    want = {(frozenset((least[sets[a]], least[sets[b]])), len(sets[a] & sets[b])) for a, b in pairs if sets[a] != sets[b]}
    got = ngram_join.links(df, 4, 85).collect()
    assert len(got) == len(want) > 300 and {(frozenset((r["doc_id_a"], r["doc_id_b"])), r["n_shared"]) for r in got} == want
    assert ngram_join.links(none).count() == 0


def test_links_come_from_the_trees(monkeypatch):
    """All links inside and between blocks; with the trees' pairs thrown away none is left."""
    rng = np.random.default_rng(9)
    base = [np.unique(rng.integers(0, 1 << 60, 200).astype(np.uint64)) for _ in range(12)]
    sets = [np.unique(np.concatenate((b[rng.random(b.size) > 0.06], rng.integers(0, 1 << 60, 4).astype(np.uint64)))) for b in base for _ in range(10)]
    want = [[100 * (k := np.intersect1d(a, b).size) >= 85 * (a.size + b.size - k) and i != j for j, b in enumerate(sets)] for i, a in enumerate(sets)]

    def linked(one, two):
        out = np.zeros((120, 120), bool)
        one, two, link, _ = ngram_join.tree_links(sets, one, two, 85)
        out[np.ix_(one, two)] = link
        return out

    every, half = np.arange(120), np.arange(50)
    assert (linked(every, every) == want).all() and np.sum(want) > 100
    assert (linked(half, every[50:])[:50, 50:] == np.array(want)[:50, 50:]).all()
    monkeypatch.setattr(ngram_join.CountTree, "join", lambda self, other, percent: (np.zeros(0, np.int64),) * 2)
    assert not linked(every, every).any()


def test_fine_bounds_lose_no_overlap():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 60, rng.integers(1, 3000)).astype(np.uint64))
        b = np.unique(np.concatenate((a[rng.random(a.size) < 0.8], rng.integers(0, 1 << 60, rng.integers(1, 1500)).astype(np.uint64))))
        assert np.intersect1d(a, b).size <= ngram_join.overlap_bound(ngram_join.fine_point(a), ngram_join.fine_point(b))
    one = (np.arange(400, dtype=np.uint64) << np.uint64(40))       # all tokens in one group: a full count bounds nothing
    assert ngram_join.overlap_bound(ngram_join.fine_point(one), ngram_join.fine_point(one)) >= 400
    far = [ngram_join.overlap_bound(*(ngram_join.fine_point(rng.integers(0, 1 << 60, 20_000).astype(np.uint64)) for _ in "ab")) for _ in range(5)]
    assert max(far) < 0.8 * 20_000                                 # unrelated large sets stay apart


def test_sets_of_repeated_rows_come_once(spark, docs):
    """Repeated rows, inside a task and across tasks, and every row a hit of the filter."""
    some = docs.limit(20).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(30)))).drop("k")
    some = common.staged(some.repartition(3), "repeated")
    classes = ngram_join._classes(some, 4, 85, np.ones(1 << ngram_join.SKETCH_BITS, np.int64))
    wanted = classes.select("c1", "c2", F.col("row_hash").alias("h"))
    got = ngram_join._sets(wanted.unionByName(wanted), some, 4)
    assert got.count() == classes.count() > 10
    assert {tuple(r["id"]): len(r["codes"]) for r in got.collect()} == {(r["c1"], r["c2"]): r["n"] for r in classes.collect()}


def test_shared_codes():
    rng = np.random.default_rng(4)
    one, two = ([np.unique(rng.integers(0, 4000, n).astype(np.uint64) ** 2 // 4000) for n in rng.integers(0, 300, m)] for m in (150, 130))
    want = [[np.intersect1d(a, b).size for b in two] for a in one]
    assert (ngram_join.shared_codes(one, two) == np.array(want)).all()


def test_one_of_each_judges_rows_of_one_id_apart(spark):
    """Of a repeated id the copy of a smaller one goes and the unrelated texts stay, repeated rows once."""
    text = lambda k: " ".join(f"{k}w{j}" for j in range(50))
    rows = [(1, text(k), k) for k in range(5)] + [(9, text(k), k) for k in range(20)] + [(4, text(30), 30)] * 7 + [(4, " ", 31), (4, "", 32), (None, text(0), 33)]
    got = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, k int").repartition(3)).collect()
    want = Counter([(1, k) for k in range(5)] + [(9, k) for k in range(5, 20)] + [(4, 30), (None, 33)])
    assert Counter((r["doc_id"], r["k"]) for r in got if r["k"] not in (31, 32)) == want
    assert sum(r["k"] in (31, 32) for r in got) == 1 and list(got[0].asDict()) == ["doc_id", "text", "k"]


def test_count_trees_lose_no_pair():
    rng = np.random.default_rng(1)
    points = rng.poisson(3, size=(300, 8))
    points[150:] = np.maximum(0, points[:150] + rng.integers(-1, 2, size=(150, 8)))
    sizes = points.sum(1)
    tree = ngram_join.CountTree(points, sizes)
    found = set(zip(*(x.tolist() for x in tree.join(tree, 80))))
    for a in range(300):
        most = np.minimum(points[a], points).sum(1)
        fits = (most * 180 >= 80 * (sizes[a] + sizes)) & (100 * np.minimum(sizes[a], sizes) >= 80 * np.maximum(sizes[a], sizes))
        assert {(a, b) for b in np.flatnonzero(fits).tolist()} <= found


def test_group_pairs_of_large_and_blocked_groups(spark):
    rng = np.random.default_rng(2)
    points = np.repeat(rng.poisson(4, size=(60, ngram_join.DIMENSIONS)), 40, axis=0)
    rows = [(5, k, k, int(p.sum()), [int(x) for x in p], len(points), [5, 9]) for k, p in enumerate(points)]
    rows += [(9, *r[1:]) for r in rows]
    df = spark.createDataFrame(rows, "key long, class long, comp long, n long, point array<smallint>, members long, keys array<long>")
    got = {tuple(r) for r in ngram_join._indexed(df, 95).collect()}
    assert ngram_join._indexed(df.where("key = 9"), 95).count() == 0       # they are given out by key 5
    assert {(a, b) for k in range(60) for a in range(40 * k, 40 * k + 40) for b in range(a + 1, 40 * k + 40)} <= got


def test_repeats(spark, odd, none):
    rows = [(i, WORD.findall(t.encode())) for i, t in rows_of(odd)]
    seen = Counter(tuple(w[k:k + 35]) for _, w in rows for k in range(len(w) - 34))
    want = Counter()
    for i, w in rows:
        gone = {j for k in range(len(w) - 34) if seen[tuple(w[k:k + 35])] > 1 for j in range(k, k + 35)}
        want[(i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest())] += 1
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeats.removed(odd).collect())
    assert got == want
    assert repeats.removed(none).count() == 0
    out = repeats.without_repeats(odd.withColumn("n_chars", F.length("text").cast("long")), 50)
    by_id = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == [*odd.columns, "n_chars"] and out.count() == odd.count() and by_id[4]["text"] is None
    assert by_id[10]["text"] == "x" * 30_000 and by_id[12]["text"].startswith("\n") and by_id[12]["n_chars"] == len(by_id[12]["text"])


def test_repeats_of_texts_that_part_late(spark, monkeypatch):
    """Thousands of texts with the same first 16 words, then different: groups stay near their size, results whole."""
    monkeypatch.setattr(repeats, "GROUP", 500)
    shared = " ".join(f"s{k}" for k in range(16))
    texts = [shared + " " + " ".join(f"t{k}w{j}" for j in range(30)) for k in range(3000)]
    texts += [texts[7], "front " + texts[8]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    table, groups, _ = repeats._plan(docs, 35)
    sizes = Counter()
    for r in repeats._send(table, groups, 35).collect():
        sizes[r["grp"]] += len(r["paths"]) // 8
    assert sum(sizes.values()) > 30_000 and max(sizes.values()) < 700
    assert groups.parts.max() >= 6
    got = {r["doc_id"]: r["n_removed"] for r in repeats.removed(docs).collect()}
    assert {i: n for i, n in got.items() if n} == {7: 46, 8: 46, 3000: 46, 3001: 46}


def bytes_removed(rows):
    """Counts of the rows that op8 gives, window by window."""
    rows = [(i, t.encode()) for i, t in rows]
    key = lambda i: float("inf") if i is None else i
    first = {}
    for i, b in rows:
        for k in range(len(b) - 49):
            first[b[k:k + 50]] = min(first.get(b[k:k + 50], float("inf")), key(i))
    want = Counter()
    for i, b in rows:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < key(i):
                gone[k:k + 50] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        want[(i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone[:-1]].tobytes()).hexdigest())] += 1
    return want


@pytest.mark.parametrize("hot", [bwt_repeats.HOT, 2])
def test_bwt_repeats(spark, odd, none, hot, monkeypatch):
    monkeypatch.setattr(bwt_repeats, "HOT", hot)
    assert Counter(tuple(r) for r in bwt_repeats.removed(odd).collect()) == bytes_removed(rows_of(odd))
    assert bwt_repeats.removed(none).count() == 0


@pytest.mark.parametrize("hot", [bwt_repeats.HOT, 2])
def test_bwt_repeats_send_one_holder_a_block(spark, hot, monkeypatch):
    """A passage in all documents, cut differently in some, over blocks whose smallest ids interleave."""
    monkeypatch.setattr(bwt_repeats, "HOT", hot)
    rng = random.Random(17)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = text(200)
    rows = [(i if i % 23 else None, text(30) + passage[i % 3 * 40:] + text(i % 60)) for i in rng.sample(range(240), 240)]
    rows += [(rows[5][0], rows[9][1]), (rows[5][0], rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    sent, send = [], bwt_repeats._send_runs

    def watched(*given):
        sent.append(send(*given))
        return sent[-1]

    monkeypatch.setattr(bwt_repeats, "_send_runs", watched)
    assert Counter(tuple(r) for r in bwt_repeats.removed(df).collect()) == bytes_removed(rows)
    for r in sent[0].collect():
        holders, strings = np.frombuffer(r["docs"], np.int64), list(zip(np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["codes"], np.uint64)))
        assert len(holders) == len(strings) == len(set(strings))


def test_merged_transforms_give_repeated_intervals():
    rng = random.Random(7)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(12, 40))) for _ in range(60)]
    sizes, least = np.array([len(s) for s in strings]), np.arange(60)
    got = bwt_repeats._smallest_holder(np.frombuffer(b"".join(strings), np.uint8), sizes, least, 10)
    windows = [s[k:k + 10] for s in strings for k in range(len(s) - 9)]
    want = [min(j for j, s in enumerate(strings) if w in s) for w in windows]
    assert got.tolist() == want


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a.example/x", "<p>WARC/1.1\r\n\r\nWARC-Type: response</p>"), (2, "http://b.example/?q=1#f", "é" * 5000), (3, None, None),
             (4, "http://b.example", "é" * 5000), (5, "u", ""), (None, "http://c.example", "é" * 5000), (7, "x", "only")]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, digest string")
    found = warc.captures_of(df, with_payload=True)
    assert all(len(r["requests"]) == 1 and len(r["metadata"]) == 1 for r in found.collect())
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.page_table(found).collect()}
    for i, _, html in pages:
        body = (html or "").encode()
        origin = {2: 2, 4: 2, None: 2, 3: 3, 5: 3}.get(i, i)
        assert got[i] == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                          "response" if origin == i else "revisit", None if origin == i else origin)
    payloads = {r["response"]["payload"] for r in found.collect() if r["record_type"] == "response"}
    assert bytearray(pages[0][2].encode()) in [bytearray(p) for p in payloads]
    assert warc.page_table(warc.captures_of(df.limit(0))).count() == 0


def test_fingerprints(spark, odd, none):
    got = fingerprints.fingerprints(odd).collect()
    assert len(got) == odd.count()
    by_text = {}
    for r, t in ((r, dict(rows_of(odd)).get(r["doc_id"])) for r in got if r["doc_id"] is not None):
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert r["n_chars"] == len(t) and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[5]["near_next"] == 1.0 and by_id[4]["fingerprint"] == "" and by_id[2]["near_next"] == 1.0
    text = dict(rows_of(odd))
    half = len(text[2]) // 2
    assert by_id[2]["edited_sha256"] == hashlib.sha256((text[2][:len(text[2]) - half] + text[1][:half]).encode()).hexdigest()
    assert fingerprints.fingerprints(none).count() == 0


def test_fingerprints_estimate_generalised_jaccard(spark, docs):
    bag = {i: Counter(WORD.findall(t.encode())) for i, t in rows_of(docs)}
    order = sorted(bag, reverse=True)
    error = []
    near = {r["doc_id"]: r["near_next"] for r in fingerprints.fingerprints(docs).collect()}
    for a, b in zip(order, order[1:] + order[:1]):
        keys = bag[a].keys() | bag[b].keys()
        error.append(near[a] - sum(min(bag[a][k], bag[b][k]) for k in keys) / max(1, sum(max(bag[a][k], bag[b][k]) for k in keys)))
    assert abs(np.mean(error)) < 0.02 and np.std(error) < 0.08


def test_fingerprints_error_on_near_copies(spark):
    """The standard error is sqrt(J (1 - J) / SAMPLES) at likeness J: near 0.07 at 0.8 and 0.09 at 0.5."""
    rows = []
    for k in range(600):
        own, other = (10, 80) if k % 2 else (30, 60)           # words of one text only, words of both
        both = [f"s{k}x{j}" for j in range(other)]
        rows += [(2 * k + side, " ".join(both + [f"u{k}x{side}x{j}" for j in range(own)])) for side in (0, 1)]
    near = {r["doc_id"]: r["near_next"] for r in fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for odd_, true in ((1, 0.8), (0, 0.5)):
        got = np.array([near[2 * k + 1] for k in range(600) if k % 2 == odd_])
        error = (true * (1 - true) / fingerprints.SAMPLES) ** 0.5
        assert abs(got.mean() - true) < 4 * error / got.size ** 0.5 and 0.85 * error < got.std() < 1.15 * error


def tiktoken_ids(texts):
    import tiktoken
    with open(RANK_FILE, "rb") as f:
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.ranks_of(f.read()), special_tokens={})
    return [np.array(enc.encode_ordinary(t), dtype="<u4") for t in texts]


SPACED = [" a  b ", "a\n b", "a \nb", " x y", "it's we'll 'tis", "a\x00b c", "  ", "x.y,z. w", "\x1c a\x1c b", "l'été d'août", "12 a1b2 3,4"]


def test_rank_queue_bpe(spark, odd, none):
    texts = [(k, t) for k, t in enumerate(SPACED)] + rows_of(odd) + [(99, "<|endoftext|> aaaa" + "ab" * 9000)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = bpe.encoded(df, RANK_FILE, PATTERN, with_ids=True)
    want = Counter((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
                   for (i, t), ids in zip(texts, tiktoken_ids([t for _, t in texts])))
    assert Counter(tuple(r)[:4] for r in got.collect()) == want
    back = Counter((r["doc_id"], bytes(r["content"])) for r in bpe.decoded(got, RANK_FILE).collect())
    assert back == Counter((i, t.encode()) for i, t in texts)
    assert bpe.encoded(none, RANK_FILE, PATTERN).count() == 0


def plain_merges(word, ranks):
    """The usual definition: the leftmost pair of the lowest rank merges first."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[k:k + 1] for k in range(len(word))]
    while True:
        found = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        k = min(found)[1]
        parts[k:k + 2] = [parts[k] + parts[k + 1]]


@pytest.mark.parametrize("few", [1, 96])
def test_rank_queue_merges_in_the_usual_order(monkeypatch, few):
    monkeypatch.setattr(bpe, "FEW", few)
    rng = np.random.default_rng(5)
    for table in range(30):                                     # ranks in any order: merges often give a smaller rank
        words = sorted({"".join(rng.choice(list("abc"), n)).encode() for n in rng.integers(2, 5, 12)})
        order = rng.permutation(len(words))
        ranks = {bytes([b]): b for b in range(256)} | {w: 256 + int(k) for w, k in zip(words, order)}
        texts = ["".join(rng.choice(list("abcd"), n)) for n in rng.integers(1, 30, 300)] + ["a" * 5000]
        got = bpe.Encoder(ranks).all(texts)
        assert [np.frombuffer(g, "<u4").tolist() for g in got[:-1]] == [plain_merges(t.encode(), ranks) for t in texts[:-1]]


def test_run_cache_turns_over_within_a_call():
    with open(RANK_FILE, "rb") as f:
        coder = bpe.Encoder(bpe.ranks_of(f.read()))
    cache = RunCache(PATTERN, coder.all, most=10)
    for call in range(4):
        texts = [" ".join(f"w{call * 15 + k}" for k in range(40)), "w1  w2 w70", ""]
        assert cache.encode(texts) == [ids.tobytes() for ids in tiktoken_ids(texts)]


def test_packing(spark, odd, none):
    texts = [(k + 100, t) for k, t in enumerate(SPACED)] + [(k, t) for k, (_, t) in enumerate(rows_of(odd))]
    ids = {i: np.append(x, 0).astype("<u4") for (i, _), x in zip(texts, tiktoken_ids([t for _, t in texts]))}
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), TOKENIZER_FILE, PATTERN, with_ids=True).collect()
    at = Counter()
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["start"] == at[r["doc_id"]] and r["length"] == len(part) == len(r["ids"]) and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(part.tobytes())
        at[r["doc_id"]] += r["length"]
    assert at == {i: len(x) for i, x in ids.items()}
    filled = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled[r["sequence_id"]]
        filled[r["sequence_id"]] += r["length"]
    assert all(n == 1024 or n & (n - 1) == 0 for n in filled.values())
    assert packing.pack(none, TOKENIZER_FILE, PATTERN).count() == 0


def test_ranks_give_the_tokenizers_ids():
    """Every token of the vocabulary, random bytes' text, and pieces on both sides of the length that changes the path."""
    from tokenizers import Tokenizer
    content = open(TOKENIZER_FILE, encoding="utf-8").read()
    tokenizer = Tokenizer.from_file(TOKENIZER_FILE)
    rng = random.Random(12)
    pieces = [t for raw in packing.byte_ranks(content) if (t := raw.decode("utf-8", "ignore")) and len(regex.findall(PATTERN, t)) == 1]
    pieces += ["".join(rng.choice("abeèö日") for _ in range(n)) for n in (1, 2, 9, 84, 85, 86, 256, 257, 3000) for _ in range(20)]
    want = [packing.packed(e.ids) for e in tokenizer.encode_batch(pieces, add_special_tokens=False)]
    assert packing.piece_encoder(content)(pieces) == want and len(pieces) > 40_000
    shuffled = json.loads(content)
    shuffled["model"]["merges"][:2] = shuffled["model"]["merges"][1::-1]
    assert packing.byte_ranks(json.dumps(shuffled)) is None


def test_texts_without_spaces_are_not_cached():
    """Long runs take the path by the pattern; the cache holds none of them; another pattern gives its own cuts."""
    encode = lambda pieces: [packing.packed(list(p.encode())) for p in pieces]
    texts = ["日本語" * 2000, "x" * 5000 + " short word.", "QUJD" * 900 + "==", "plain words only."]
    cache = RunCache(PATTERN, encode)
    assert cache.encode(texts) == encode(texts) == cache.encode(texts)
    assert max(map(len, cache._runs)) <= 128
    odd = RunCache(r"[aeiou]+|[^aeiou]+", lambda pieces: [packing.packed([len(p)]) for p in pieces])
    assert odd.encode(["ab cde. e"]) == [packing.packed([1, 4, 1, 2, 1])]


def test_sum_of_squares_rule():
    rng = random.Random(4)
    packer = packing.Packer(16)
    for k in range(300):
        size = rng.randint(1, 15)
        n = packer.count.tolist()
        cost = {}
        for level in [0] + [h for h in range(1, 17 - size) if n[h]]:
            after = n[:]
            after[level] -= level > 0
            after[level + size] += level + size < 16
            cost[level] = sum(x * x for x in after)
        assert cost[packer.level_for(size)] == min(cost.values())
        packer.place((k, 0, size))


def test_sharding(spark, odd, none, docs):
    for df, shards in ((docs, 40), (odd, 5), (odd.limit(1), 40), (spark.createDataFrame([(3, "same")] * 200, "doc_id long, text string"), 8)):
        got = sharding.shard(df, shards).collect()
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
            (i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in rows_of(df))
        slots, size = {}, Counter()
        for r in got:
            slots.setdefault(r["shard"], []).append(r["slot"])
            size[r["shard"]] += r["size"]
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
        largest = max(r["size"] for r in got)
        assert all(abs(size[k] - sum(size.values()) / shards) <= largest + 1 for k in range(shards))
    assert sharding.shard(none).count() == 0


def test_splitters_meet_the_tolerance_in_a_wide_range(spark):
    """Ids at both ends of the range and one id with most rows: many rounds, few boundaries held."""
    rows = [(-(1 << 62), "a")] + [(k, "b" * (k % 9)) for k in range(600)] + [(7, "c")] * 1500 + [((1 << 62) + k, "d") for k in range(300)]
    measured = sharding.measured(spark.createDataFrame(rows, "doc_id long, text string"))
    h = sharding.Histogram(measured)
    cut = sharding.splitters(h, 8, tolerance=0.0)
    largest = max(r["size"] for r in measured.collect())
    assert all(abs(h.below[c][0] - h.total * k / 8) <= largest for k, c in enumerate(cut, 1))
    assert len(h.below) <= 3 * 8 * (sharding.CELLS_PER_SHARD + 1)


def test_temporal_lists(spark):
    entries = [("host", "a.x.org", 10, "block", 0), ("host", "a.x.org", 20, "remove", 0), ("host", "a.x.org", 20, "allow", 1),
               ("domain", "x.org", 5, "block", 0), ("prefix", "a.x.org/p/", 15, "block", 0), ("host", None, 1, "block", 0),
               ("host", "b.x.org", 5_000_000, "allow", 0)]
    captures = [(1, "http://a.x.org/p/1", 12), (2, "http://a.x.org/p/1", 15), (3, "http://A.x.org/q", 20), (4, "http://a.x.org/", 9),
                (5, "http://c.x.org", 4), (6, None, 12), (7, "nonsense", 12), (8, "http://b.x.org/", 5_000_000), (9, "http://b.x.org/", 4_999_999),
                (1, "http://a.x.org/p/1", 12), (10, "http://a.x.org/q", None)]
    e = spark.createDataFrame(entries, "kind string, pattern string, effective long, action string, seq long")
    c = spark.createDataFrame([(*x, "k") for x in captures], "page_id long, url string, fetch_time long, kind string")
    got = Counter((r["page_id"], r["verdict"], r["rule_kind"]) for r in url_lists.judge(c, e).collect())
    assert got == Counter([(1, "block", "host"), (1, "block", "host"), (2, "block", "prefix"), (3, "allow", "host"), (4, "block", "domain"),
                           (5, "unlisted", None), (6, "unlisted", None), (7, "unlisted", None), (8, "allow", "host"), (9, "block", "domain"),
                           (10, "unlisted", None)])
    assert url_lists.judge(c, e.limit(0)).where("verdict <> 'unlisted'").count() == 0
    assert url_lists.judge(c.limit(0), e).count() == 0


def test_temporal_lists_oracle(spark):
    from tests.oracle_check import _norm, duck_connection
    sf = "/root/testdata/sf0.01"
    con = duck_connection(sf)
    con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    want = con.execute(queries.OP10_SQL)
    names = [d[0] for d in want.description]
    got = queries.op10_temporal_lists(spark, sf).select(names).collect()
    assert Counter(tuple(map(_norm, r)) for r in got) == Counter(tuple(map(_norm, r)) for r in want.fetchall())


class Taken:
    """Gives the function that a table would run in its tasks."""

    schema = None

    def select(self, *_):
        return self

    def mapInArrow(self, task, _):
        return task


@pytest.mark.parametrize("take, most_mb", [(lambda d: quality.filtered(d, quality.Model()), 40),
                                           (lambda d: ngram_join._first_pass(d, 5), 80)])
def test_tasks_hold_few_arrays_whatever_the_batch(monkeypatch, take, most_mb):
    """A batch of 12 MB of text is worked off in small slices, in memory that does not follow the batch."""
    monkeypatch.setattr(ngram_join, "_row_hash", lambda: None)
    rng = random.Random(5)
    texts = ["\n".join(" ".join(f"w{rng.randrange(5000)}" for _ in range(12)) for _ in range(30)) for _ in range(6000)]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, pa.array(texts), ids], names=["doc_id", "text", "row_hash"])
    task = take(Taken())
    tracemalloc.start()
    try:
        assert sum(out.num_rows for out in task(iter([batch]))) >= len(texts)      # none of them fails the rules
        assert tracemalloc.get_traced_memory()[1] < most_mb << 20
    finally:
        tracemalloc.stop()


def test_kept_objects_go_when_another_operator_runs():
    """A worker's tokenizer and cache stay for tasks that use them, not beside another operator's arrays."""
    batch = pa.RecordBatch.from_arrays([pa.array(["a b"])], names=["text"])
    made = kept(("test",), object)
    assert list(common.slices(iter([batch]), keeping=True)) and kept(("test",), object) is made
    assert list(common.slices(iter([batch]))) and kept(("test",), object) is not made


def test_span_hashes_do_not_depend_on_the_span(monkeypatch):
    raw = np.frombuffer(random.Random(2).randbytes(4000), np.uint8)
    want = common.words(raw, np.array([0, 900, 900, 4000])).hashes
    monkeypatch.setattr(common, "_SPAN", 64)
    assert (common.words(raw, np.array([0, 900, 900, 4000])).hashes == want).all()


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.staged(stage(spark, docs, SF_SMALL), "test-stage")
        assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars"}, name
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] == counts[3] > 0
    pieces = corpus_pipeline.packed(spark, docs, SF_SMALL)
    assert pieces.select("doc_id").distinct().count() == counts[3]


def test_pipeline_stages_take_odd_and_empty_tables(spark, odd, none):
    import corpus_pipeline

    for df in (odd, none):
        docs = df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns and out.count() <= docs.count()
        corpus_pipeline.packed(spark, docs, SF_SMALL).count()


def test_temporal_lists_of_deep_prefixes_and_user_names(spark):
    """A prefix of any depth decides, the longest first; the host is what follows the user name."""
    pages = ["http://h.example/a/b/c/x", "http://h.example/a/b/c/d/e/x", "http://h.example/a/b/x", "http://bob@h.example/a/b/c/x",
             "http://bob:p@ss@h.example:80/", "http://bob@/x", "http://h.example?q=me@other.example"]
    captures = spark.createDataFrame([(k, u, 10) for k, u in enumerate(pages)], "page_id long, url string, fetch_time long")
    entries = spark.createDataFrame([("prefix", "h.example/a/b/c/", 0, "block", 0), ("prefix", "h.example/a/b/c/d/e/", 0, "allow", 0),
                                     ("host", "h.example", 0, "allow", 0), ("host", "bob", 0, "block", 0)],
                                    "kind string, pattern string, effective long, action string, seq long")
    got = {r["page_id"]: (r["host"], r["verdict"], r["rule_pattern"]) for r in url_lists.judge(captures, entries).collect()}
    deep, host = ("h.example", "block", "h.example/a/b/c/"), ("h.example", "allow", "h.example")
    assert got == {0: deep, 1: ("h.example", "allow", "h.example/a/b/c/d/e/"), 2: host, 3: deep, 4: host, 5: ("", "unlisted", None), 6: host}
    none = url_lists.judge(captures, entries.where("kind = 'host'")).collect()
    assert {r["verdict"] for r in none if r["host"]} == {"allow"}


def test_temporal_lists_spell_patterns_alike(spark):
    """A prefix without a path or without its last slash, and upper case in hosts; the path keeps its case."""
    pages = ["http://Example.com", "http://example.com/a/x", "http://example.com/A/x", "http://two.example/a", "http://three.org/x", "http://www.THREE.org/"]
    captures = spark.createDataFrame([(k, u, 10) for k, u in enumerate(pages)], "page_id long, url string, fetch_time long")
    entries = spark.createDataFrame([("prefix", "EXAMPLE.com/", 0, "block", 0), ("prefix", "example.COM/a", 0, "allow", 0), ("prefix", "two.example", 0, "block", 0),
                                     ("domain", "Three.Org", 0, "block", 0), ("host", None, 0, "block", 0), ("prefix", None, 0, "block", 0)],
                                    "kind string, pattern string, effective long, action string, seq long")
    got = {r["page_id"]: (r["verdict"], r["rule_pattern"]) for r in url_lists.judge(captures, entries).collect()}
    whole, below = ("block", "example.com/"), ("allow", "example.com/a/")
    assert got == {0: whole, 1: below, 2: whole, 3: ("block", "two.example/"), 4: ("block", "three.org"), 5: ("block", "three.org")}


def test_pipeline_stages_against_brute_force(spark):
    """Kept ids of the join, texts of the substring dedup and packed ids, each stage on the rows of the one before."""
    import corpus_pipeline

    def stage(k, df):
        return common.staged(corpus_pipeline.STAGES[k][1](spark, df, SF_SMALL), f"brute-{k}")

    first = stage(0, spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    second = stage(1, first)
    rows = rows_of(first)
    components = brute_components(rows, corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)
    keep = {i for i, _, c in components if i == c}
    assert len(dict(rows)) == len(rows) and Counter(rows_of(second)) == Counter((i, t) for i, t in rows if i in keep)
    third, size = stage(2, second), corpus_pipeline.WINDOW
    words = {i: WORD.findall(t.encode()) for i, t in rows_of(second)}
    seen = Counter(tuple(w[k:k + size]) for w in words.values() for k in range(len(w) - size + 1))
    left = {}
    for i, w in words.items():
        gone = {j for k in range(len(w) - size + 1) if seen[tuple(w[k:k + size])] > 1 for j in range(k, k + size)}
        left[i] = [x for k, x in enumerate(w) if k not in gone]
    texts = rows_of(third)
    assert len(texts) == len(left) and {i: WORD.findall(t.encode()) for i, t in texts} == left
    ids = {i: np.append(x, 0).astype("<u4").tolist() for (i, _), x in zip(texts, tiktoken_ids([t for _, t in texts]))}
    got = {}
    for r in stage(3, third).orderBy("doc_id", "start").collect():
        assert r["start"] == len(got.setdefault(r["doc_id"], []))
        got[r["doc_id"]] += list(r["ids"])
    assert got == ids
