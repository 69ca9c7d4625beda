import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from mishap.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, place int, path string"
ODD = [
    (1, "s", "en", 3, "abc"),
    (1, "s", "en", 3, "abc"),
    (1, "s", "en", 4, "abcd"),
    (2, None, "en", None, None),
    (None, "s", "en", 1, "x"),
    (None, "s", "en", 1, "x"),
    (7, "s", None, 0, ""),
    (8, "s", None, 2, "é中"),
    (9, "", "", 1, "-"),
    (10, "s", "é", 70000, "long " * 14000),
    (11, "s", "Z", 1, "y"),
    *[(100 + i, "s", "de", i, str(i)) for i in range(13)],
]


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, more=0):
    doc_id, source, lang, n, text = row
    fields = [doc_id, source, lang, None if n is None else n + more, text]
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def _tree(leaves, arity):
    """The root, and per leaf its path: (digests to the left, digests to the right) per level."""
    level, paths, at = leaves, [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(at):
            first = i - i % arity
            paths[k].append((level[first:i], level[i + 1 : first + arity]))
            at[k] = i // arity
        level = [_h(*level[i : i + arity]) for i in range(0, len(level), arity)]
    return level[0], paths


def _audit(rows, arity):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[name] = _tree([_leaf(r) for r in groups[name]], arity)
    root, heads = _tree([trees[n][0] for n in names], arity)
    found = []
    for name, head in zip(names, heads):
        subroot, paths = trees[name]
        for row, path in zip(groups[name], paths):
            picked = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            own = _leaf(row, 1 if picked else 0)
            proof = "".join("".join(a + b) for a, b in path + head)
            for a, b in path + head:
                own = _h(*a, own, *b)
            found.append((row[0], _leaf(row), subroot, root, _h(proof), own, own == root))
    return sorted(found, key=repr)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(*r, "clash", 1, None) for r in ODD], SCHEMA).repartition(3)


@pytest.mark.parametrize("arity", [2, 3])
def test_audit_against_brute_force(rows, arity):
    found = [tuple(r) for r in merkle.audit(rows, arity=arity).collect()]
    assert sorted(found, key=repr) == _audit(ODD, arity)
    assert any(not r[-1] for r in found) and any(r[-1] for r in found)


def test_audit_of_few_rows(spark, rows):
    assert merkle.audit(rows.limit(0)).collect() == []
    one = merkle.audit(spark.createDataFrame([(*ODD[0], "", 1, "")], SCHEMA)).collect()
    assert [tuple(r) for r in one] == _audit(ODD[:1], 2)
    assert one[0].root == one[0].leaf == one[0].subroot


def test_every_single_change_is_seen(rows):
    """A path only leads to the root from its own leaf."""
    found = merkle.manifest(rows, merkle.FIELDS).rows
    back = found.select(
        (merkle.folded(F.col("leaf"), F.col("path")) == merkle.hexed(F.col("root"))).alias("right"),
        (merkle.folded(F.sha2("leaf", 256).cast("binary"), F.col("path")) == merkle.hexed(F.col("root"))).alias("wrong"),
    )
    assert {tuple(r) for r in back.collect()} == {(True, False)}


def test_numbers_without_a_single_sorter(spark):
    """Equal keys spread over tasks and still get each number once, in order."""
    rows = spark.range(4000).select((F.col("id") % 7 == 0).cast("int").alias("k"), F.lit(None).cast("int").alias("z"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        found = merkle.numbered(rows, ["z", "k"], "at")
        assert found.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set(coalesce, before)
    numbers = [(r.at, r.k) for r in found.collect()]
    assert [n for n, _ in sorted(numbers)] == list(range(4000))
    assert [k for _, k in sorted(numbers)] == sorted(k for _, k in numbers)


def test_arity():
    with pytest.raises(ValueError):
        merkle.manifest(None, [], arity=1)
