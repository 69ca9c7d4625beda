import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from mishap.llm import fingerprints, pii, sharding, toxicity


def test_fingerprints(docs, texts, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_BUCKET", 40)
    table = docs.dropDuplicates(["doc_id"])
    found = {r.doc_id: r for r in fingerprints.compare_with_edits(table).collect()}
    rows = sorted(dict(texts).items(), reverse=True)
    assert len(found) == len(rows)
    by_text = collections.defaultdict(set)
    for n, (i, text) in enumerate(rows):
        after, half = rows[(n + 1) % len(rows)][1], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = found[i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        by_text[text].add(row.fingerprint)
        if edited == text:
            assert row.near_edited == 1 and row.fingerprint == row.edited_fingerprint
    assert all(len(f) == 1 for f in by_text.values())
    assert len({min(f) for f in by_text.values()}) == len(by_text)
    mean = [sum(r[c] for r in found.values()) / len(found) for c in ("near_edited", "near_next")]
    assert mean[0] > 0.35 and mean[1] < 0.2


def test_fingerprints_form_a_group(spark):
    texts = spark.createDataFrame([("b\na. c", "a. c", "a. c\nb", "b")], "t string, u string, v string, w string")
    prints = texts.select(
        *[
            fingerprints.fingerprint(fingerprints.hashes(fingerprints.paragraphs(F.col(c)))).alias(c)
            for c in "tuvw"
        ]
    )
    row = prints.select(
        (F.col("t") == F.col("v")).alias("order"),
        (fingerprints.add(F.col("u"), F.col("w")) == F.col("t")).alias("sum"),
        (fingerprints.subtract(F.col("t"), F.col("w")) == F.col("u")).alias("rest"),
    ).first()
    assert all(row)


def test_fingerprints_of_odd_tables(odd, none, spark):
    assert fingerprints.compare_with_edits(odd).count() == odd.count()
    assert fingerprints.compare_with_edits(none).count() == 0
    one = spark.createDataFrame([(None, "x")], "doc_id long, text string")
    assert fingerprints.compare_with_edits(one).first().near_next == 1


@pytest.mark.parametrize("per_bucket, spread", [(sharding.GROUPS_PER_BUCKET, 64), (50, 5_000)])
def test_shards(docs, texts, monkeypatch, per_bucket, spread):
    monkeypatch.setattr(sharding, "GROUPS_PER_BUCKET", per_bucket)
    found = sharding.shard(docs).collect()
    want = sorted((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in found) == want
    loads, slots, of_text = collections.Counter(), collections.defaultdict(list), {}
    for row in found:
        loads[row.shard] += row["size"]
        slots[row.shard].append(row.slot)
        assert of_text.setdefault((row["size"], row.text_crc32), row.shard) == row.shard
    assert set(loads) == set(range(8)) and max(loads.values()) - min(loads.values()) <= spread
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_rounds_of_differencing(spark):
    """Partial partitions are combined in rounds; a group keeps to one bin and loads come out even."""
    random.seed(4)
    groups = [(i, -i, random.randrange(1, 5000), i % 60, 0) for i in range(3000)]
    by_bucket = collections.defaultdict(list)
    for g in groups:
        by_bucket[g[3]].append(g)
    placed = []
    for rows in by_bucket.values():
        rows.sort(key=lambda g: -g[2])
        bins = sharding.difference([[0] * 7 + [g[2]] for g in rows])
        placed += [(*g[:4], chosen[-1]) for g, chosen in zip(rows, bins)]
    table = spark.createDataFrame(placed, "k1 long, k2 long, total long, bucket int, bin int")
    for per_bucket in (1000, 7, 2):
        found = {r.k1: r.shard for r in sharding.assign(table, 60, 8, per_bucket).collect()}
        assert len(found) == 3000
        loads = collections.Counter()
        for i, _, total, _, _ in groups:
            loads[found[i]] += total
        assert set(loads) == set(range(8)) and max(loads.values()) - min(loads.values()) < 100
        # What one bucket put together stays together.
        assert len({(b, c, found[i]) for i, _, _, b, c in placed}) == 60 * 8


def test_rows_that_repeat_an_id_spread(spark):
    rows = spark.range(0, 5000, 1, 6).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    found = sharding.shard(rows).collect()
    assert len({r.shard for r in found}) == 1 and sorted(r.slot for r in found) == list(range(5000))


def test_differencing():
    bins = sharding.difference([[0, 0, x] for x in (8, 7, 6, 5, 4, 3, 2, 1)])
    loads = [0] * 3
    for x, chosen in zip((8, 7, 6, 5, 4, 3, 2, 1), bins):
        assert sorted(chosen) == [0, 1, 2]
        loads[chosen[-1]] += x
    assert loads == [12, 12, 12]
    assert sharding.difference([]) == []


def test_shards_of_odd_tables(odd, none):
    assert sharding.shard(odd).count() == odd.count()
    assert sharding.shard(none).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(number):
    total = 0
    for n, digit in enumerate(reversed(number)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _valid(kind, match):
    number = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 16 <= len(number) <= 19 and _luhn(number)
    return kind == "email" or 8 <= len(number) <= 15


PERSONAL = [
    (2002, "a@b.c_x@d.e a@b a.b@c-d.e.f. x@y..z \U0001f600 é q@r.st"),
    (2003, "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.1.1 1.2.3 11.22.33.44x99999999999999999999.1.1.1"),
    (2004, "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 5  67 1 2 3 41111111 11111111"),
    (2005, "4532015112830366 é4532-0151-1283-0366"),
    (2006, "+1 (555) 555-1234 +12 +1 23 45 67 8  +49 (0) 30 . . . +999999999999999999 ++1 2345678"),
    (2007, "1.1.1.1 " * 100),
]


def test_personal_data(spark, docs):
    table = docs.unionByName(spark.createDataFrame(PERSONAL, "doc_id long, text string"))
    model = pii.fit(table, params=pii.Params(least_accepted=5))
    rows = {r.doc_id: r.text or "" for r in table.collect()}
    found = pii.report(pii.detect(table, model)).collect()
    assert len(found) == table.count()
    for row in found:
        base = {
            kind: [m.span() for m in re.finditer(p, rows[row.doc_id]) if _valid(kind, m[0])]
            for kind, p in PATTERNS.items()
        }
        joined = ",".join(f"{k}:{a}:{b}" for k in base for a, b in base[k])
        assert [row[f"n_{k}"] for k in base] == [len(s) for s in base.values()]
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = row.spans.split(",") if row.spans else []
        assert set(joined.split(",") if joined else []) <= set(spans)
        order = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)


def test_long_runs_of_digits(spark):
    long = "9" * 20_000 + " " + "1 " * 5_000 + "a@" * 3_000 + "x" * 50_000 + "@y.z"
    table = spark.createDataFrame([(1, long)], "doc_id long, text string")
    row = pii.report(pii.detect(table, pii.Model())).first()
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 0, 0, 0)


def test_redaction(spark):
    table = spark.createDataFrame([("mail a@b.cd, +1 555 123 4567!",), (None,)], "text string")
    found = pii.detect(table, pii.Model())
    texts = [r[0] for r in found.select(pii.redacted(F.col("text"), F.col("pii"))).collect()]
    assert texts == ["mail [EMAIL], [PHONE]!", None]


def test_personal_data_of_odd_tables(odd, none):
    assert pii.report(pii.detect(odd, pii.fit(odd))).count() == odd.count()
    assert pii.report(pii.detect(none, pii.fit(none))).count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    assert scored.where("score not between 0 and 1 or predicted <> int(score >= 0.5)").isEmpty()
    counts = scored.where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count()
    n = {(r.toxic, r.predicted): r["count"] for r in counts.collect()}
    assert n[1, 1] / (n[1, 1] + n[1, 0]) > 0.8
    assert n[0, 0] / (n[0, 0] + n[0, 1]) > 0.95


def test_calibration_follows_the_labels_not_the_draw(spark, sf):
    """A bound on the rows that teach leaves the class shares of the calibration as they are."""
    docs = spark.range(1200).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("plain words number "), F.col("id") % 17, F.when(F.col("id") % 6 == 0, " vile rotten filth").otherwise(" good day")).alias("text"),
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 6 == 0).cast("int").alias("toxic"))
    for per_class in (4000, 80):
        model = toxicity.fit(docs, labels, params=toxicity.Params(documents_per_class=per_class))
        scored = toxicity.score(docs, model).join(labels, "doc_id")
        assert scored.where("predicted <> toxic").isEmpty()
        # The lowest score is the toxic share among the texts without gain: none of some hundred.
        assert scored.agg(F.min("score")).first()[0] < 0.003


def test_odd_texts_meet_a_fitted_model(spark, odd):
    given = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(given, labels)
    assert len(model.steps) > 1
    extra = spark.createDataFrame([(1, "word " * 400_000), (2, "idiot"), (2, "idiot"), (3, "x" * 3_000_000)], "doc_id long, text string")
    rows = odd.select("doc_id", "text").unionByName(extra)
    found = toxicity.score(rows, model).collect()
    assert len(found) == rows.count() and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.score for r in found}
    assert by_id[1000] == by_id[1001] == min(by_id.values()) and by_id[1] < 0.5 and by_id[3] < 0.5
    assert by_id[2] > 0.5 and [r.predicted for r in found if r.doc_id == 2] == [1, 1]


def test_toxicity_without_labels(spark, odd, none):
    labels = spark.createDataFrame([(1014, None), (1015, 0)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    assert {r.score for r in toxicity.score(odd, model).collect()} == {0.0}
    assert toxicity.score(none, model).count() == 0


def test_steps_do_not_fall():
    steps, shares = toxicity._fit_steps({0: (5, 100), 1: (1, 100), 5: (9, 10), 7: (8, 10)})
    assert list(shares) == sorted(shares) and len(steps) == len(shares)
