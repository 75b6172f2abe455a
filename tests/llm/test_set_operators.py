"""Near-duplicate classes, contamination, sharding and search against plain Python."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_text_operators import plain_words

from ratewell.llm import jaccard
from ratewell.llm.components import components
from ratewell.llm.contamination import drop_contaminated, find_items
from ratewell.llm.jaccard import keep_one_of_each, link_sets
from ratewell.llm.sharding import kd_shards
from ratewell.llm.topk import scaled, top_k


def shingle_set(text, size=5):
    w = plain_words(text, True)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def plain_classes(rows):
    """(doc_id, set size, class name) of every row by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[find(b)] = find(a)
    name = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            name[find(k)] = min(name.get(find(k), i), i)
    return sorted(((i, len(sets[k]), name.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def test_classes_against_all_pairs(docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = link_sets(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain_classes(rows)
    assert link_sets(no_docs).count() == 0


def near_copies(n, base_words=120, seed=3):
    """Chains and groups of near copies around the threshold, with one passage that all of them share."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = [f"c{i}" for i in range(30)]
    out = []
    for group in range(n):
        base = [str(x) for x in rng.choice(vocabulary, base_words)]
        for copy in range(6):
            words = list(base)
            for at in rng.integers(0, base_words, rng.integers(0, 6)):
                words[at] = f"g{group}c{copy}e{at}"
            out.append(" ".join([*words, *common]))
    return list(enumerate(out))


@pytest.mark.parametrize("heavy", [1, 64])
def test_near_copies_with_a_common_passage(spark, monkeypatch, heavy):
    monkeypatch.setattr(jaccard, "HEAVY_COUNT", heavy)
    monkeypatch.setattr(jaccard, "HEAVY_LOCAL", heavy)
    monkeypatch.setattr(jaccard, "SKIP_ROWS", 4)
    rows = near_copies(20)
    got = link_sets(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == plain_classes(rows)


def test_blocks_skip_only_impossible_pairs():
    rng = np.random.default_rng(5)
    n = np.sort(rng.integers(5, 60, 300))
    pos = (n * rng.random(300) * 0.2).astype(np.int64)
    label = rng.integers(0, 200, 300)
    got = {(int(i), int(j)) for a, b in jaccard._meeting(label, n, pos, 80) for i, j in zip(a, b)}
    wanted = set()
    for i, j in itertools.combinations(range(300), 2):
        share = 1 + min(pos[i], pos[j]) + min(n[i] - pos[i], n[j] - pos[j]) - 1
        if label[i] != label[j] and share >= -(-80 * (n[i] + n[j]) // 180) and 100 * min(n[i], n[j]) >= 80 * max(n[i], n[j]):
            wanted.add((i, j))
    assert wanted <= got and all(label[i] != label[j] for i, j in got)


def test_linked_sets_meet_early_often_enough():
    """Every linked pair of random sets has the asked number of meetings early in both sets."""
    rng = random.Random(11)
    linked = 0
    for _ in range(4000):
        x = set(rng.sample(range(1000), rng.randrange(1, 90)))
        gone = rng.sample(sorted(x), rng.randrange(0, len(x) // 8 + 1))
        y = x - set(gone) | set(rng.sample(range(1000, 2000), rng.randrange(0, len(x) // 8 + 1)))
        if not y or 100 * len(x & y) < 80 * len(x | y):
            continue
        linked += 1
        order = {t: k for k, t in enumerate(rng.sample(sorted(x | y), len(x | y)))}
        a, b = sorted(x, key=order.get), sorted(y, key=order.get)
        na, nb = np.array(len(a)), np.array(len(b))
        longest = [int(jaccard.prefix_size(n, 80)) for n in (na, nb)]
        met = [t for t in x & y if a.index(t) < longest[0] and b.index(t) < longest[1]]
        soon = [t for t in met if jaccard.early(na, nb, np.array(a.index(t)), np.array(b.index(t)), 80)]
        assert len(soon) >= jaccard.meetings(na, nb, 80) >= 1
    assert linked > 2000


def test_texts_around_one_passage(spark, monkeypatch):
    """Texts that share a long passage but are not alike stay apart from each other, not from their copies."""
    monkeypatch.setattr(jaccard, "HEAVY_LOCAL", 2)
    monkeypatch.setattr(jaccard, "HEAVY_COUNT", 8)
    passage = [f"p{k}" for k in range(104)]
    rows = [(i, " ".join([*(f"t{i}w{k}" for k in range(24)), *passage])) for i in range(60)]
    rows += [(100 + i, " ".join([*(f"t{i}w{k}" for k in range(24)), *passage, f"end{i}"])) for i in range(0, 60, 7)]
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = link_sets(table).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain_classes(rows)


def test_one_of_each_class_stays(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    named = [c for c in plain_classes(rows) if c[1]]
    empty = [r for r in rows if not plain_words(r[1])]
    classes = len({(c[2], c[1] < 5 and c[1]) for c in named})
    assert kept.where(F.col("text").rlike("\\S")).count() >= classes - 1
    assert kept.count() - kept.where(F.col("text").rlike("\\S")).count() == len(empty)
    ids = [r.doc_id for r in kept.collect()]
    assert 3 in ids and 4 not in ids and 5 not in ids and 8 in ids and 9 not in ids


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}}


def test_contamination_against_plain_sets(spark, docs, no_docs, sample):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    odd = [(900, None), (901, ""), (902, "one TWO three"), (902, "one TWO three"), (None, "one two three"), (903, " ".join(f"shared{i}" for i in range(18)))]
    items = bench.select("item_id", "text").unionByName(spark.createDataFrame(odd, "item_id long, text string"))
    both = docs.select("doc_id", "text").unionByName(sample.select("doc_id", "text"))
    rows, wanted = [(r.doc_id, r.text) for r in both.collect()], []
    sets = [(i, shingle_set(t)) for i, t in rows]
    for r in items.collect():
        s = shingle_set(r.text)
        wanted += [(i, r.item_id, len(s & d), len(s)) for i, d in sets if s and r.item_id is not None and 100 * len(s & d) >= 80 * len(s)]
    for block_bytes in (32 << 20, 1000):
        got = find_items(both, items, block_bytes=block_bytes).select("doc_id", "item_id", "n_shared", "n_item").collect()
        assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)
    clean = drop_contaminated(docs, items)
    assert clean.columns == docs.columns
    hit = {i for i, *_ in wanted}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, t in [(r.doc_id, r.text) for r in docs.collect()] if not (i in hit and any(shingle_set(t) >= set() and 100 * len(shingle_set(x.text) & shingle_set(t)) >= 80 * max(1, len(shingle_set(x.text))) for x in items.collect() if x.item_id is not None and shingle_set(x.text))))
    assert find_items(no_docs, items).count() == 0
    assert find_items(docs, items.limit(0)).count() == 0


def test_shards_are_gapless_and_even(spark, docs, no_docs):
    texts = [("a" * (i * 37 % 500), f"s{i % 3}", "en") for i in range(3000)] + [("copy " * 20, "s0", "en")] * 1500
    frame = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string")
    got = kd_shards(frame, shards=7).toPandas()
    assert len(got) == len(texts)
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 7 and sizes.max() - sizes.min() < 0.03 * sizes.mean()
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    for r in got.head(20).itertuples():
        text = texts[r.doc_id][0].encode()
        assert (r.size, r.text_crc32) == (len(text) + 16, zlib.crc32(text))
    few = kd_shards(docs, shards=40).toPandas()
    assert len(few) == docs.count() and few["shard"].between(0, 39).all()
    assert kd_shards(docs, target_bytes=10_000).toPandas()["shard"].nunique() > 1
    assert kd_shards(no_docs, shards=3).count() == 0


def test_small_equal_texts_stay_together(spark):
    texts = [f"text {i % 700}" for i in range(2100)]
    frame = spark.createDataFrame([(i, t, "s", "l") for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string")
    got = kd_shards(frame, shards=5).toPandas()
    got["text"] = [texts[i] for i in got["doc_id"]]
    assert (got.groupby("text")["shard"].nunique() == 1).all()


@pytest.mark.parametrize("shard_rows", [40, 100_000])
def test_search_against_all_products(spark, shard_rows):
    rng = np.random.default_rng(2)
    vectors = [(int(i), [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    vectors += [(1000 + i, [0.5, 0.25, -0.5, 1.0, 0.0, 0.125]) for i in range(200)]  # ties
    vectors += [(40, [1.0] * 6), (1, None), (2, [None] * 6), (3, [float("nan")] * 6), (5, [float("inf")] * 6), (60, [1.0, 2.0]), (61, [2.0, 2.0]), (80, [])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").select("vec_id", scaled().alias("vector"))
    got = sorted(map(tuple, top_k(frame, F.col("vec_id") % 20 == 0, k=5, shard_rows=shard_rows).collect()))
    plain = [(i, np.floor(64 * np.array(v))) for i, v in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    wanted = []
    for a, (i, v) in enumerate(plain):
        if i % 20 == 0:
            hits = sorted((-int(v @ w), j) for b, (j, w) in enumerate(plain) if b != a and len(w) == len(v))[:5]
            wanted += [(i, rank, j, -s) for rank, (s, j) in enumerate(hits, 1)]
    assert got == sorted(wanted)
    assert top_k(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_stored_matches_hold_no_index(spark, docs):
    items = spark.createDataFrame([(i, "one two three") for i in range(40)], "item_id long, text string")
    wanted = sorted(map(tuple, find_items(docs, items).collect()), key=str)
    got = find_items(docs, items, block_bytes=100)  # copies of an item are dealt over the blocks too
    plan = got._jdf.queryExecution().logical().toString()
    assert "Union" in plan and "MapInArrow" not in plan  # each closure would keep its index on the driver
    assert sorted(map(tuple, got.collect()), key=str) == wanted and wanted


def test_groups_of_near_copies_and_texts_just_beside_them(spark):
    """Copies of two bases, chains between them and texts on both sides of the limit, against all pairs."""
    rng = random.Random(17)
    texts = []
    for base in range(3):
        words = [f"w{base}x{k}" for k in range(120)]
        if base == 2:  # shares most of the first base, a little too little
            words = [f"w0x{k}" for k in range(107)] + words[107:]
        for changes in [0, 0, *[1] * 12, *[2] * 8, *[3] * 4, *[4] * 4, *[5] * 4]:
            copy = list(words)
            for at in rng.sample(range(120), changes):
                copy[at] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
        for cut in range(92, 120, 2):
            texts.append(" ".join(words[:cut]))
            texts.append(" ".join(words[120 - cut :] + [f"tail{base}{cut}{k}" for k in range(4)]))
    rng.shuffle(texts)
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in link_sets(docs).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in range(len(texts))}
    assert 1 < len(set(map(find, root))) < len(texts)


def test_search_with_scores_past_a_long(spark):
    """Components of 1e10 and more: exact up to the ends of a long, held there beyond."""
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=6) * 10.0 ** rng.choice([1, 8, 10])).tolist()) for i in range(120)] + [(200, [1e300] * 6), (201, [-1e300] * 6)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("vec_id", scaled().alias("vector")).cache()
    exact = {r["vec_id"]: [int(x) for x in r["vector"]] for r in vectors.collect()}
    got = {}
    for r in top_k(vectors, F.col("vec_id") % 20 == 0, 5, shard_rows=40).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    low, high = -(2**63), 2**63 - 1
    for q in (i for i in exact if i % 20 == 0):
        scores = [(-min(max(sum(a * b for a, b in zip(exact[q], v)), low), high), i) for i, v in exact.items() if i != q]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:5])]
