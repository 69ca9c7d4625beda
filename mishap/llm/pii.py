"""Personal data: fixed patterns with checks, and boosted trees over further candidates.

Everything is DataFrame expressions. Strict patterns find the base spans. Looser patterns propose
overlapping candidates; gradient-boosted trees, taught by the base spans and by candidates that fail
a check, judge the others by form and context, and those above a calibrated threshold are added. The fitted trees become expressions
themselves, so texts are scored where they are read, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mishap.llm.common import held, quoted

KINDS = ("email", "ip", "card", "phone")
# Each pattern starts where the last match ended or at the start of a run of its characters; inside
# a run it could only fail again. Possessive loops keep the matcher's stack flat on long runs.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
        r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++"
    ),
    "ip": r"(?:\G|(?<![0-9]))[0-9]{1,3}+(?:\x20?\.\x20?[0-9]{1,3}+){3}+",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20./-]{0,2}[0-9]){11,19}+",
    "phone": r"(?:\G|(?<![0-9]))(?:\+|00)?\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}+",
}
# What a text must hold for a search to be worth it.
NEEDS = {
    "email": r"@|\(at\)|\[at\]",
    "ip": r"[0-9]\x20?\.\x20?[0-9]",
    "card": r"[0-9]",
    "phone": r"[0-9]",
}
CUES = {
    "email": r"(?i)mail|contact|write",
    "ip": r"(?i)\bip\b|addr|host|server",
    "card": r"(?i)card|visa|pay|credit|iban",
    "phone": r"(?i)phone|tel|call|fax|mobile",
}
CONTEXT = 24
SPAN = "array<struct<start:int,end:int,match:string>>"


@dataclass(frozen=True)
class Params:
    """Bounds of the fit: sampled texts, trees, their depth, and the precision the threshold keeps.

    ``least_accepted`` is a number of calibrating candidates that a caller may ask for; there is none
    by default, so that tables of every size are treated alike.
    """

    texts: int = 4_000
    trees: int = 8
    depth: int = 3
    precision: float = 0.98
    least_accepted: int = 0


@dataclass(frozen=True)
class Model:
    """Trees as nested (feature, threshold, left, right) or leaf values, their weights, the threshold."""

    trees: tuple = ()
    weights: tuple = ()
    threshold: float = float("inf")


def matches(text: Column, pattern: str, needs: str) -> Column:
    """Leftmost non-overlapping matches with code point positions, end exclusive."""
    step = rf"(?s)\G(.*?)({pattern})"
    gaps = F.regexp_extract_all(text, F.lit(step), F.lit(1))
    found = F.regexp_extract_all(text, F.lit(step), F.lit(2))
    pairs = F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m")))

    def extend(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["g"]
        end = start + F.length(pair["m"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["m"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))
    spans = F.aggregate(pairs, zero, extend, lambda state: state["spans"])
    return F.when(text.rlike(needs), spans).otherwise(F.array().cast(SPAN))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Checksum of a string of digits: every second one from the right counts double."""
    places = F.transform(
        F.split(F.reverse(number), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int") + 1)
        ),
    )
    return F.aggregate(places, F.lit(0), lambda a, b: a + b) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    """The check that a match of a base pattern must pass."""
    if kind == "ip":
        parts = F.split(match, r"\.")
        plain = F.transform(parts, lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(plain, lambda p: (F.length(p) <= 3) & (p.cast("bigint") <= 255))
    if kind == "card":
        number = digits(match)
        return F.length(number).between(16, 19) & luhn(number)
    if kind == "phone":
        return F.length(digits(match)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    found = matches(text, BASE[kind], NEEDS[kind])
    return F.filter(found, lambda s: passes(kind, s["match"]))


def normal(kind: str, match: Column) -> Column:
    """A match of a loose pattern in the form that the checks read."""
    if kind == "email":
        at = F.regexp_replace(match, r"\x20?(?:@|\(at\)|\[at\])\x20?", "@")
        return F.regexp_replace(at, r"\x20?(?:\.|\(dot\)|\[dot\])\x20?", ".")
    if kind == "ip":
        return F.regexp_replace(match, " ", "")
    return digits(match)


def _context(span: Column, text: Column) -> tuple[Column, Column]:
    before = F.substring(text, F.greatest(span["start"] - CONTEXT, F.lit(0)) + 1,
                         F.least(span["start"], F.lit(CONTEXT)))
    return before, F.substring(text, span["end"] + 1, F.lit(CONTEXT))


def _overlaps(spans: Column, c: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))


# A plain dot with a blank on one side ends a sentence; a date is no number to call.
SENTENCE = r"(?<!\x20)\.\x20|\x20\.(?!\x20)"
ADDRESS = r"^[^@]{1,64}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,63}$"
DATE = r"^(?:19|20)[0-9]{2}([./-])[0-9]{1,2}\1[0-9]{1,2}|^[0-9]{1,2}([./-])[0-9]{1,2}\2(?:19|20)[0-9]{2}"


def plausible(kind: str, span: Column, text: Column, others: Column) -> Column:
    """The check of a candidate: on its normal form, on its neighbours, against the other kinds."""
    match, form = span["match"], normal(kind, span["match"])
    if kind == "email":
        return form.rlike(ADDRESS) & ~match.rlike(SENTENCE)
    before, after = _context(span, text)
    alone = ~before.rlike(r"[\p{L}0-9]$") & ~after.rlike(r"^[\p{L}0-9]")
    good = passes(kind, form) & alone & ~_overlaps(others, span)
    return good & ~match.rlike(DATE) if kind == "phone" else good


FEATURES = (
    "kind", "length", "digits", "letters", "groups", "first_run", "last_run", "check",
    "before_letter", "after_letter", "cue_before", "cue_after",
)


def features(kind: str, span: Column, text: Column) -> Column:
    """Form and context of a candidate as an array of doubles in the order of ``FEATURES``.

    Counts are those of the normal form: signs that make a base span one are not among them.
    """
    match, form = span["match"], normal(kind, span["match"])
    before, after = _context(span, text)

    def count(pattern: str) -> Column:
        return F.length(form) - F.length(F.regexp_replace(form, pattern, ""))

    values = (
        F.lit(KINDS.index(kind)),
        F.length(form),
        count("[0-9]"),
        count("[A-Za-z]"),
        F.size(F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0))),
        F.length(F.regexp_extract(match, "[0-9]+", 0)),
        F.length(F.regexp_extract(match, "[0-9]*$", 0)),
        passes(kind, form).cast("int"),
        before.rlike(r"[\p{L}0-9]$").cast("int"),
        after.rlike(r"^[\p{L}0-9]").cast("int"),
        before.rlike(CUES[kind]).cast("int"),
        after.rlike(CUES[kind]).cast("int"),
    )
    return F.array(*[F.coalesce(v.cast("double"), F.lit(0.0)) for v in values])


def candidates(text: Column, kind: str, others: Column) -> Column:
    """Spans of the loose pattern with their features, and whether they pass the check."""
    return F.transform(
        matches(text, LOOSE[kind], NEEDS[kind]),
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), features(kind, s, text).alias("x"),
            plausible(kind, s, text, others).alias("ok"),
        ),
    )


def _spans(docs: DataFrame, text: str) -> DataFrame:
    """Add base spans and candidates of every kind as _base_* and _more_* columns."""
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    docs = docs.withColumn("_body", body)
    docs = docs.withColumns({f"_base_{k}": base_spans(F.col("_body"), k) for k in KINDS})
    others = {k: F.concat(*[F.col(f"_base_{o}") for o in KINDS if o != k]) for k in KINDS}
    return docs.withColumns({f"_more_{k}": candidates(F.col("_body"), k, others[k]) for k in KINDS})


def _tree(node) -> tuple | float:
    """A fitted tree as nested tuples."""
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    return (
        int(split.featureIndex()),
        float(split.threshold()),
        _tree(node.leftChild()),
        _tree(node.rightChild()),
    )


def _evaluate(tree: tuple | float, x: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, threshold, left, right = tree
    return F.when(x[feature] <= threshold, _evaluate(left, x)).otherwise(_evaluate(right, x))


def margin(model: Model, x: Column) -> Column:
    """Weighted sum of the trees; its sign is the class."""
    total = F.lit(0.0)
    for tree, weight in zip(model.trees, model.weights):
        total = total + F.lit(weight) * _evaluate(tree, x)
    return total


def fit(
    docs: DataFrame, row_id: str = "doc_id", text: str = "text", params: Params = Params()
) -> Model:
    """Teach the trees from at most ``params.texts`` texts that hold a digit or an at sign.

    A quarter of the table, by hash of id and content, never teaches; of the others the first in
    hash order do. A candidate is positive if a base span of its kind covers exactly it, and negative
    if it fails its check; those that pass it without being base spans have no label. All texts that
    do not teach calibrate, in one aggregation: the threshold is the lowest margin at which the
    accepted labelled candidates keep the wanted precision. Without candidates of both classes
    nothing is added to the base spans.
    """
    rows = docs.select(
        F.xxhash64(F.col(quoted(row_id)).cast("string"), F.col(quoted(text))).alias("h"),
        F.col(quoted(text)).alias("text"),
    ).where(F.col("text").rlike(r"[0-9]|@|\(at\)|\[at\]"))
    may_teach = F.pmod("h", F.lit(4)) != 0
    hashes = rows.where(may_teach).select("h").distinct()
    last = hashes.orderBy("h").limit(params.texts).agg(F.max("h")).first()[0]
    if last is None:
        return Model()
    teaches = may_teach & (F.col("h") <= last)
    teach = held(_candidates(rows.where(teaches).dropDuplicates(["h"])))
    if teach.select("y").distinct().count() < 2:
        return Model()
    # Equal candidates become one with a weight, in a fixed order: the fit doesn't vary.
    weighted = teach.groupBy("x", "y").agg(F.count(F.lit(1)).alias("weight")).orderBy("x", "y")
    names = [f"x{i}" for i in range(len(FEATURES))]
    flat = weighted.coalesce(1).select(
        F.col("y").cast("double").alias("label"),
        F.col("weight").cast("double").alias("weight"),
        *[F.col("x")[i].alias(name) for i, name in enumerate(names)],
    )
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(flat)
    boosted = GBTClassifier(
        maxIter=params.trees, maxDepth=params.depth, seed=42, weightCol="weight"
    ).fit(vectors.select("features", "label", "weight"))
    trees = tuple(_tree(t._java_obj.rootNode()) for t in boosted.trees)
    model = Model(trees, tuple(float(w) for w in boosted.treeWeights))
    judge = _candidates(rows.where(~teaches))
    scores = judge.groupBy(F.round(margin(model, F.col("x")), 3).alias("m")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("t")
    )
    accepted = true = 0
    threshold = float("inf")
    for m, n, t in sorted((tuple(r) for r in scores.collect()), reverse=True):
        accepted, true = accepted + n, true + t
        if accepted >= params.least_accepted and true >= params.precision * accepted:
            threshold = m
    return Model(model.trees, model.weights, threshold)


def _candidates(rows: DataFrame) -> DataFrame:
    """The labelled candidates of all kinds as (h, x, y)."""
    labelled = [_labelled(kind) for kind in KINDS]
    long = _spans(rows, "text").select("h", F.explode(F.concat(*labelled)).alias("c"))
    return long.select("h", F.col("c.x").alias("x"), F.col("c.y").alias("y"))


def _labelled(kind: str) -> Column:
    """Positive: a base span. Negative: apart from base spans and failing the check. Others have no label."""
    base = F.col(f"_base_{kind}")

    def label(c: Column) -> Column:
        same = F.exists(base, lambda b: (b["start"] == c["start"]) & (b["end"] == c["end"]))
        y = F.when(same, 1).when(~c["ok"] & ~_overlaps(base, c), 0)
        return F.struct(c["x"].alias("x"), y.alias("y"))

    return F.filter(F.transform(F.col(f"_more_{kind}"), label), lambda c: c["y"].isNotNull())


def detect(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``pii``: per kind, in the order of KINDS, the sorted base spans and added spans.

    The column is an array of (kind, start, end, base), positions in code points, end exclusive.
    Every base span stays; a candidate is added if it passes its check, its margin reaches the
    threshold and it overlaps no base span of its kind. Spans of different kinds may overlap. A null or empty text has none.
    """
    found = _spans(docs, text)
    lists = []
    for kind in KINDS:
        base, more = F.col(f"_base_{kind}"), F.col(f"_more_{kind}")
        lists.append(_merged(kind, base, more, model))
    names = [c for c in docs.columns if c != "pii"]
    return found.select(*map(quoted, names), F.concat(*lists).alias("pii"))


def _merged(kind: str, base: Column, more: Column, model: Model) -> Column:
    def tagged(flag: bool):
        return lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"),
            F.lit(flag).alias("base"),
        )

    spans = F.transform(base, tagged(True))
    if model.trees and model.threshold != float("inf"):

        def new(c: Column) -> Column:
            return c["ok"] & ~_overlaps(base, c) & (F.round(margin(model, c["x"]), 3) >= model.threshold)

        spans = F.concat(spans, F.transform(F.filter(more, new), tagged(False)))
    return F.array_sort(spans)


def report(found: DataFrame, row_id: str = "doc_id") -> DataFrame:
    """Per row: id, base spans per kind, SHA-256 of the base spans, and all spans as text."""

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    base = F.filter("pii", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    return found.select(
        F.col(quoted(row_id)).alias(row_id),
        *[number(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    empty = F.array().cast("array<struct<start:int,end:int,kind:string>>")

    def join(state: Column, s: Column) -> Column:
        last = F.element_at(state, -1)
        span = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        wider = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
            last["kind"].alias("kind"),
        )
        overlaps = (F.size(state) > 0) & (s["start"] < last["end"])
        return F.when(
            overlaps, F.concat(F.slice(state, 1, F.size(state) - 1), F.array(wider))
        ).otherwise(F.concat(state, F.array(span)))

    whole = F.aggregate(F.array_sort(spans), empty, join)
    pieces = F.transform(
        whole,
        lambda s, i: F.concat(
            F.substring(
                text,
                F.when(i > 0, F.get(whole, i - 1)["end"]).otherwise(0) + 1,
                s["start"] - F.when(i > 0, F.get(whole, i - 1)["end"]).otherwise(0),
            ),
            F.lit("["),
            F.upper(s["kind"]),
            F.lit("]"),
        ),
    )
    rest = F.substring(text, F.element_at(whole, -1)["end"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(text)
