import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import connect, normal, oracle
from mishap.llm import queries
from mishap.llm.common import staged


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, name):
    got = queries.QUERIES[name](spark, sf).toPandas()
    assert len(got) > 0
    if name in queries.ORACLES:
        want = oracle(connect(sf), queries.ORACLES[name])
        assert sorted(got.columns) == sorted(want.columns)
        assert normal(got) == normal(want)


def test_pipeline(spark, sf):
    """Each stage keeps what it should, judged on what the one before has left."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = [docs]
    for _, stage in corpus_pipeline.STAGES:
        left.append(staged(stage(spark, left[-1], sf)))
    raw, mild, single, cut, masked, pieces = left
    assert all(table.columns == docs.columns for table in left[:5])
    assert 0.8 * raw.count() < mild.count() <= raw.count()
    assert mild.exceptAll(raw).isEmpty() and single.exceptAll(mild).isEmpty()

    words = [(r.doc_id, r.text.encode().lower().split()) for r in mild.orderBy("doc_id").collect()]
    sets = {i: set(zip(*(w[k:] for k in range(5)))) if len(w) > 4 else {tuple(w)} for i, w in words if w}
    group = {i: i for i, _ in words}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if 0.8 <= len(sets[a]) / len(sets[b]) <= 1 / 0.8:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    group[max(x, y)] = min(x, y)
    assert {r.doc_id for r in single.collect()} == {i for i in group if find(i) == i}

    seen: set = set()
    for row in cut.orderBy("doc_id").collect():
        now = row.text.encode().split()
        assert row.n_chars == len(row.text)
        seen.update(tuple(now[a : a + 50]) for a in range(len(now) - 49))
    before = {r.doc_id: r.text.encode().split() for r in single.collect()}
    starts: dict = {}
    for i in sorted(before):
        gone = [False] * len(before[i])
        mine = [tuple(before[i][a : a + 50]) for a in range(len(before[i]) - 49)]
        for a, window in enumerate(mine):
            if starts.setdefault(window, i) < i:
                gone[a : a + 50] = [True] * 50
        before[i] = [w for w, g in zip(before[i], gone) if not g]
    assert {r.doc_id: r.text.encode().split() for r in cut.collect()} == before

    assert cut.count() == masked.count()
    assert masked.where("text rlike '[a-z0-9.]+@mail[0-9][.]example[.]com'").isEmpty()
    changed = cut.alias("a").join(masked.alias("b"), "doc_id").where("a.text <> b.text")
    assert changed.where("b.text not rlike '\\\\[(EMAIL|IP|CARD|PHONE)\\\\]'").isEmpty()
    assert pieces.select("doc_id").distinct().count() == masked.count()


def test_near_copies_with_repeated_and_missing_ids(spark, sf):
    """No text goes that isn't linked with one that stays."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        (7, "alpha beta gamma delta epsilon zeta"),
        (7, "something else entirely in here now"),
        (7, "something else entirely in here now"),
        (8, "alpha beta gamma delta epsilon zeta"),
        (9, long),
        (9, long + " x"),
        (None, long + " y z"),
        (None, "a text without any id at all"),
        (None, None),
        (3, ""),
        (4, None),
        (5, " "),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("clash"))
    kept = corpus_pipeline.drop_near_copies(spark, docs, sf)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    least = min([long, long + " x"], key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert found == sorted([*rows[:2], (9, least), *rows[7:]], key=str)
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), sf).collect() == []


def test_pipeline_runs_with_odd_rows(spark, sf, odd):
    rows = odd.withColumn("n_chars", odd.doc_id)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = staged(stage(spark, rows, sf))
        assert "clash" == rows.first()["node"] and "n_removed" in rows.columns, name
