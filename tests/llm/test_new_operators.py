"""Merkle manifests, periodic runs and fingerprints against plain Python on made cases."""

import random
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from oreflow.llm import merkle, periodic, simhash
from oreflow.llm.common import Workspace, salted_lookup
from tests.llm import brute


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_trees_of_any_arity(spark, arity):
    """One tree with most rows, one with a single leaf, one without a name; ids that repeat and null ids."""
    rows = [(i % 97 if i % 7 else None, ["big", "big", "big", "some", None][i % 5], f"text {i % 50}") for i in range(400)]
    rows.append((1, "lone", "x"))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(7)
    got = merkle.manifest(docs, Workspace(spark, "t"), merkle.leaf(F.col("doc_id"), F.col("text")), arity=arity)
    got = got.withColumns({"proof": merkle.proof(F.col("path")), "now": merkle.folded(F.col("leaf"), F.col("path"))}).collect()
    trees = {}
    for doc, lang, text in rows:
        trees.setdefault(lang, []).append((doc is not None, doc or 0, brute.leaf_digest(doc, text), doc))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    tops = [brute.merkle_root([x[2] for x in sorted(trees[t])], arity=arity)[0] for t in order]
    want = []
    for k, t in enumerate(order):
        leaves = [x[2] for x in sorted(trees[t])]
        for i, (_, _, leaf, doc) in enumerate(sorted(trees[t])):
            _, low, _ = brute.merkle_root(leaves, i, leaf, arity)
            root, high, _ = brute.merkle_root(tops, k, tops[k], arity)
            want.append((doc, t, leaf, tops[k], root, brute.joined_digest(low + high)))
    assert Counter((r.doc_id, r.lang, r.leaf, r.subroot, r.root, r.proof) for r in got) == Counter(want)
    assert all(r.now == r.root for r in got)


def test_any_change_shows(spark):
    rows = [(i, "a", f"text {i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    root = lambda df: merkle.manifest(df, Workspace(spark, "t"), merkle.leaf(F.col("doc_id"), F.col("text"))).first().root
    first = root(docs)
    assert first == root(docs.repartition(5))
    assert first != root(docs.withColumn("text", F.when(F.col("doc_id") == 17, "").otherwise(F.col("text"))))
    assert first != root(docs.where("doc_id <> 29")) != root(docs.union(docs.where("doc_id = 3")))


word = st.sampled_from("abc")
piece = st.tuples(st.lists(word, min_size=1, max_size=5), st.integers(1, 25)).map(lambda x: (x[0] * x[1])[: x[1] + 3])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(piece, max_size=5).map(lambda xs: [w for x in xs for w in x]), min_size=1, max_size=4))
def test_runs_of_many_texts_at_once(texts):
    got = periodic.found_in([" ".join(t).encode() for t in texts], periodic.Numbers())
    assert [r for _, r in got] == [brute.runs(t) for t in texts]


def test_runs_of_few_periods():
    rng = random.Random(4)
    for _ in range(200):
        words = [rng.randrange(2) for _ in range(rng.randrange(0, 40))]
        got = periodic.runs_of(np.array(words, np.int64), np.zeros(len(words), np.int64), 2, 2)
        n, want = len(words), {}
        for p in range(1, n // 2 + 1):
            for i in range(n - p):
                if i and words[i - 1] == words[i + p - 1]:
                    continue
                j = i
                while j < n - p and words[j] == words[j + p]:
                    j += 1
                if j - i + p >= max(2, 2 * p):
                    want.setdefault((i, j - i + p), p)
        assert got == sorted(((s, length, p) for (s, length), p in want.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("kind", ["one word", "period", "passage again", "two words"])
def test_long_texts_take_near_linear_time(kind):
    rng = random.Random(8)
    n = 200_000
    words = {
        "one word": ["na"] * n,
        "period": [f"w{i % 777}" for i in range(n)],
        "passage again": [f"w{rng.randrange(5000)}" for _ in range(n // 2)] * 2,
        "two words": [rng.choice("ab") for _ in range(n)],
    }[kind]
    began = time.time()
    runs = periodic.found_in([" ".join(words).encode()], periodic.Numbers())[0][1]
    assert time.time() - began < 30
    if kind in ("one word", "period"):
        assert runs == [(0, n, 1 if kind == "one word" else 777)]
    if kind == "passage again":
        assert runs == []


def test_collapsed_text_and_real_spans(spark):
    rows = [(1, "x y " + "very " * 9 + "good"), (2, None), (2, ""), (None, "a b " * 5), (3, "one two three")]
    got = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    told = Counter((r.doc_id, tuple(map(tuple, r.runs)), r.start, r.length, r.period, bytes(r.collapsed).decode()) for r in got)
    assert told == Counter(
        [
            (1, ((2, 9, 1),), 2, 9, 1, "x y very good"),
            (2, (), None, None, None, ""),
            (2, (), None, None, None, ""),
            (None, ((0, 10, 2),), 0, 10, 2, "a b"),
            (3, (), None, None, None, "one two three"),
        ]
    )


def test_links_of_prints_in_small_blocks(spark):
    """Tight groups, chains and scattered prints, in blocks so small that a tile has many."""
    rng = random.Random(6)
    prints = {0, 2**64 - 1, 2**63}
    for _ in range(40):
        at = rng.getrandbits(64)
        for _ in range(25):
            prints.add(at)
            for _ in range(rng.choice([1, 2, 3, 4])):
                at ^= 1 << rng.randrange(64)
    center = rng.getrandbits(64)
    prints |= {center ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(a)}
    prints = sorted(prints)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    points = spark.createDataFrame([(p, i) for i, p in enumerate(signed)], "print long, node long")
    links = simhash.print_links(points, Workspace(spark, "t"), block=16).collect()
    parent = list(range(len(prints)))

    def root(of, x):
        while of[x] != x:
            x = of[x]
        return x

    for a, b in links:
        x, y = root(parent, a), root(parent, b)
        parent[max(x, y)] = min(x, y)
    want = list(range(len(prints)))
    for i, p in enumerate(prints):
        for j, q in enumerate(prints[:i]):
            if (p ^ q).bit_count() <= 3:
                x, y = root(want, i), root(want, j)
                want[max(x, y)] = min(x, y)
    assert [root(parent, i) for i in range(len(prints))] == [root(want, i) for i in range(len(prints))]


def test_no_pair_of_near_prints_lies_in_tiles_that_are_skipped():
    rng = random.Random(2)
    near = set(simhash.near_tiles(3))
    tile = lambda p: tuple((p >> 16 * i & 0xFFFF).bit_count() for i in range(4))
    for _ in range(5000):
        p = q = rng.getrandbits(64)
        for _ in range(rng.randrange(4)):
            q ^= 1 << rng.randrange(64)
        apart = tuple(a - b for a, b in zip(tile(p), tile(q), strict=True))
        assert apart in near or tuple(-x for x in apart) in near


def test_hash_is_the_given_one():
    assert simhash.shingle_hashes(b"A b\tC d") == [
        brute.xxhash.xxh64_intdigest(b"a b c", 42),
        brute.xxhash.xxh64_intdigest(b"b c d", 42),
    ]
    assert simhash.shingle_hashes(b" one ") == [brute.xxhash.xxh64_intdigest(b"one", 42)]
    assert simhash.shingle_hashes(None) == [] and simhash.fingerprints([[], [2**64 - 1]]).tolist() == [0, 2**64 - 1]


def test_lookup_divides_a_busy_key(spark):
    """A third of all rows under one key, and a third without a key: no task of the join gets them all."""
    rows = spark.range(0, 90_000, 1, 6).selectExpr("id", "CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN id + 1000 END AS k")
    work = Workspace(spark, "t")
    rows = work.keep(rows, "rows")
    facts = work.keep(rows.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top")), "facts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = salted_lookup(rows, facts, "k", "left").withColumn("task", F.spark_partition_id())
        sizes = sorted(r["count"] for r in out.groupBy("task").count().collect())
        assert sum(sizes) == 90_000 and sizes[-1] < 2 * sizes[len(sizes) // 2]
        tops = dict(facts.select("k", "top").collect())
        assert all(r.top == tops.get(r.k) for r in out.collect())
    finally:
        for key in ("autoBroadcastJoinThreshold", "adaptive.enabled"):
            spark.conf.unset(f"spark.sql.{key}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
