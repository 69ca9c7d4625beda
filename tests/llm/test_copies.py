import collections
import hashlib
import pathlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from mishap.llm import embeddings, graphs, ngrams, rolling, substrings
from mishap.llm.common import staged


def _groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    random.seed(1)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(180)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    found = graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.component for r in found} == _groups(nodes, edges)


def test_rolling():
    h = rolling.DIGESTS.array([b"a", b"b", b"a", b"b", b"a"])
    assert rolling.runs(h, 3)[0] == rolling.runs(h, 3)[2] != rolling.runs(h, 3)[1]
    assert len(rolling.runs(h, 6)) == 0
    values = np.array([3, 1, 2, 1, 5], np.uint64)
    assert rolling.least_places(values, 3).tolist() == [1, 3, 3]


PASSAGE = " ".join(f"w{i}" for i in range(70))


@pytest.fixture(scope="module")
def passages(spark, docs):
    rows = [
        (2002, "a " * 300),
        (2003, "b a " * 200),
        (2004, "a " * 49),
        (2005, PASSAGE),
        (2006, "x " + PASSAGE + "\ny"),
        (2007, PASSAGE + " " + PASSAGE),
        (2008, PASSAGE),
        (2008, "q " + PASSAGE),
        (2009, " ".join(f"w{i}" for i in range(50))),
        (2010, " ".join(f"w{i}" for i in range(49))),
        (2011, "a " * 120),
    ]
    return docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.mark.parametrize("heavy", [substrings.HEAVY, 1])
def test_repeated_passages(passages, monkeypatch, heavy):
    monkeypatch.setattr(substrings, "HEAVY", heavy)
    rows = [(r.doc_id, (r.text or "").encode().split()) for r in passages.collect()]
    least = {}
    for i, words in rows:
        for a in range(len(words) - 49):
            key = tuple(words[a : a + 50])
            least[key] = min(i, least.get(key, i))
    want = []
    for i, words in rows:
        gone = [False] * len(words)
        for a in range(len(words) - 49):
            if least[tuple(words[a : a + 50])] < i:
                gone[a : a + 50] = [True] * 50
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        want.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    found = substrings.digest(substrings.remove_repeats(passages)).collect()
    assert sorted(map(tuple, found)) == sorted(want)


def test_repeated_passages_of_odd_tables(odd, none):
    kept = substrings.remove_repeats(odd)
    assert set(odd.columns) <= set(kept.columns) and kept.count() == odd.count()
    assert substrings.remove_repeats(none).count() == 0


def _shingles(text, n=3):
    words = text.encode().lower().split()
    if not words:
        return set()
    return {tuple(words)} if len(words) < n else set(zip(*(words[i:] for i in range(n))))


def _near(spark, docs):
    random.seed(3)
    base = [f"v{i}" for i in range(400)]
    rows = [(3900, "one"), (3901, "ONE"), (3902, "one two"), (3903, "One  Two")]
    for k in range(40):
        words = list(base)
        for _ in range(random.randint(0, 9)):
            words[random.randrange(400)] = f"e{random.randrange(10**6)}"
        rows.append((3000 + k, " ".join(words[: random.randint(355, 400)] if k % 3 else words)))
    # Texts of their own around one passage, and around one passage with small changes.
    for k in range(60):
        own = " ".join(f"o{k}_{i}" for i in range(30 + k))
        rows.append((5000 + k, f"{own} {PASSAGE}"))
        rows.append((5100 + k, f"{PASSAGE} x{k}" if k % 2 else f"{PASSAGE} {own[:40]}"))
    for m in (8, 9, 10, 11, 19, 20, 21, 31):
        head = " ".join(f"q{m}_{i}" for i in range(m + 2))
        rows += [(4000 + 10 * m, head), (4001 + 10 * m, head + " z"), (4002 + 10 * m, head + " z z y")]
    return docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.mark.parametrize("n, percent, tile", [(3, 90, ngrams.TILE_ROWS), (3, 90, 8), (5, 80, ngrams.TILE_ROWS), (5, 80, 8)])
def test_jaccard_join(spark, docs, monkeypatch, n, percent, tile):
    """Larger blocks are connected anew by their members' first n-grams; no link is lost."""
    monkeypatch.setattr(ngrams, "TILE_ROWS", tile)
    monkeypatch.setattr(ngrams, "CLOSE_ROWS", min(tile, ngrams.CLOSE_ROWS))
    monkeypatch.setattr(ngrams, "SAMPLED", 2)
    table = _near(spark, docs)
    sets = {r.doc_id: _shingles(r.text or "", n) for r in table.collect()}
    shared = collections.Counter()
    places = collections.defaultdict(list)
    for i, grams in sets.items():
        for gram in grams:
            places[gram].append(i)
    for ids in places.values():
        shared.update((a, b) for a in ids for b in ids if a < b)
    links = [
        (a, b)
        for (a, b), both in shared.items()
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both)
    ]
    group = _groups(sets, links)
    found = ngrams.jaccard_components(table, n, percent).collect()
    assert len(found) == table.count()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found} == {
        (i, len(s), group[i]) for i, s in sets.items()
    }


def test_jaccard_join_of_odd_tables(odd, none):
    found = {r.doc_id: r for r in ngrams.jaccard_components(odd).collect()}
    assert found[1015].component_id == 1014 and found[1000].component_id == 1000
    assert ngrams.jaccard_components(none).count() == 0


@pytest.mark.parametrize("percent", [90, 80])
def test_unrelated_short_sets_share_no_signature(percent):
    """Empty ranges, which unrelated sets have in common, make no signature."""
    rng = np.random.default_rng(5)
    classes: dict = {}
    seen = collections.Counter()
    for _ in range(20_000):
        grams = np.unique(rng.integers(0, 1 << 63, rng.integers(5, 25)).astype(np.uint64))
        seen.update(set(ngrams.signatures(grams, percent, classes).tolist()))
    assert sum(n for n in seen.values() if n > 1) <= 2


@pytest.mark.parametrize("percent", [90, 80])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(6)
    classes: dict = {}
    for size in [*range(5, 60), 100, 333, 1200]:
        for _ in range(60 if size < 60 else 20):
            grams = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            # As far apart as links go: some n-grams exchanged, then some left out.
            apart = len(grams) * (100 - percent) // 100
            out = int(rng.integers(0, apart + 1))
            other = grams[out:]
            while True:
                swap = int(rng.integers(0, apart - out + 1))
                fresh = rng.integers(0, 1 << 63, swap).astype(np.uint64)
                near = np.unique(np.concatenate([other[swap:], fresh]))
                both = len(np.intersect1d(grams, near))
                if 100 * both >= percent * (len(grams) + len(near) - both):
                    break
            if np.array_equal(near, grams):
                continue
            mine, theirs = (set(ngrams.signatures(g, percent, classes).tolist()) for g in (grams, near))
            assert mine & theirs, (size, out, swap)


@pytest.mark.parametrize("percent", [90, 80])
def test_first_grams_of_linked_sets_meet(percent):
    rng = np.random.default_rng(7)
    for _ in range(400):
        size = int(rng.integers(1, 60))
        grams = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        out = int(rng.integers(0, len(grams) * (100 - percent) // 100 + 1))
        other = np.sort(rng.permutation(grams)[out:])
        if 100 * len(other) < percent * len(grams):
            continue
        frequent = rng.permutation(grams)[: len(grams) // 2]
        counts = rng.integers(2, 9, len(frequent))
        mine, theirs = (ngrams.first_grams(g, frequent, counts, percent) for g in (grams, other))
        assert len(mine) == len(grams) - -(-len(grams) * percent // 100) + 1
        assert set(mine.tolist()) & set(theirs.tolist())
    assert ngrams.first_grams(np.array([5, 6], np.uint64), np.array([5], np.uint64), np.array([9]), 90).tolist() == [6]


def test_size_classes_meet():
    for low in range(1, 400):
        for high in range(low, low * 100 // 90 + 1):
            a, b = (ngrams.size_class(x, 90)[0] for x in (low, high))
            assert b - a in (0, 1)


@pytest.mark.parametrize("values", [embeddings.TILE_VALUES, 64 * 40])
def test_vectors(spark, sf, monkeypatch, values):
    monkeypatch.setattr(embeddings, "TILE_VALUES", values)
    given = spark.read.parquet(f"{sf}/embeddings.parquet")
    odd = [
        (9001, None, 1), (9002, [0.0] * 64, 1), (9003, [float("nan")] * 64, 1),
        (9004, [1.0] * 64, None), (9005, [1.0] * 3, 1), (9006, [2.0] * 3, 1), (9007, [], 1),
        (9008, [1.0, None], 1), (9009, [1.0, 1.0, 1.1], 1), (9010, [float("inf"), 1.0, 1.0], 1),
    ]
    table = given.unionByName(
        spark.createDataFrame(odd, "vec_id long, embedding array<float>, label int")
    ).unionByName(given.where("vec_id < 30").withColumn("vec_id", F.col("vec_id") + 5000))
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    good = [
        (i, np.array(v, float), g)
        for i, v, g in rows
        if g is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = [
        (i, j)
        for n, (i, v, g) in enumerate(good)
        for j, w, h in good[:n]
        if g == h and len(v) == len(w)
        and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.98
    ]
    count = collections.Counter(i for pair in links for i in pair)
    group = _groups([i for i, _, _ in rows], links)
    found = embeddings.near_duplicates(table.withColumn("node", F.lit("clash")), 0.98).collect()
    assert sorted(map(tuple, found)) == sorted(
        (i, count[i], group[i], group[i] == i) for i, _, _ in rows
    )
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def test_quantisation_bound():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, scale, error = embeddings.quantise(x)
    rebuilt = q * scale[:, None]
    bound = error[:, None] + (1 + error[:, None]) * error
    assert (np.abs(x @ x.T - rebuilt @ rebuilt.T) <= bound + 1e-12).all()


def test_members_that_share_passages_alone_meet_nobody(spark):
    """A passage of two or three members is no signature of theirs, however many passages a block has."""
    rows = []
    for i in range(60):
        own = [1_000 * i + j for j in range(30)]
        passage = [10_000_000 + 1_000 * (i // 3) + j for j in range(10)]
        other = [20_000_000 + 1_000 * ((i + 1) // 2 % 30) + j for j in range(10)]
        rows.append((7, i, own + passage + other))
    copy = list(rows[0][2])
    copy[0] = 99
    rows.append((7, 60, copy))
    members = spark.createDataFrame(rows, "block long, node long, grams array<long>")
    found = ngrams.close_neighbours(members, 80).groupBy("signature").agg(F.collect_set("node").alias("nodes"))
    assert {tuple(sorted(row.nodes)) for row in found.collect()} == {(0, 60)}


def test_staged_rows_leave_no_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if "shuffle_" in files.apply(i).getName()}

    before = shuffled()
    rows = spark.range(1000).repartition(5, "id")
    table = staged(rows.groupBy((F.col("id") % 7).alias("k")).count())
    end = time.time() + 30
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before
    assert table.count() == 7


def test_few_rows_are_written_to_few_files(spark):
    """However many partitions a shuffle has, rounds over few edges write a file each, not one per partition."""
    edges = staged(spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long"))
    folder = pathlib.Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    written = set(folder.rglob("part-*"))
    names = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        found = graphs.components(edges)
        rows = {r.node: r.component for r in found.collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert rows == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert 0 < len(set(folder.rglob("part-*")) - written) < 50
