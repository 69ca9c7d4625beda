import collections
import random
import re

import pytest

from mishap.llm import divergence

SCHEMA = "text string, lang string, source string, n long, v long, zero string, term string, count int"


def _expected(rows, least, top):
    used, seen, groups = {}, {}, set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", folded)
        groups.add((lang, source))
        used.setdefault((lang, source), collections.Counter()).update(terms)
        seen.setdefault(lang, collections.Counter()).update(set(terms))
    found = []
    for lang, source in groups:
        kept = [t for t, n in seen[lang].items() if n >= least]
        mine = [s for la, s in groups if la == lang]

        def shares(names):
            counts = {t: sum(used[lang, s][t] for s in names) for t in kept}
            total = sum(counts.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (n + 5) // total for t, n in counts.items()}

        p, q = shares([source]), shares(mine)
        pairs = []
        for other in mine:
            if other != source:
                r = shares([other])
                pairs.append((-sum(abs(p[t] - r[t]) for t in kept), other.encode()))
        words = [(q[t] - p[t], t.encode()) for t in kept if used[lang, source][t] and p[t] > q[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(words)[:top])):
            found += [(lang, source, part, i.decode(), -v, k) for k, (v, i) in enumerate(items, 1)]
    return sorted(found)


def _rows(n, seed=2):
    random.seed(seed)
    words = ["The", "the", "of", "été", "中文", "a'b", "x1y", "Ünd", "ÜND", "z"] + [f"{a}{b}" for a in "abcdefgh" for b in "ABCDEF"]
    rows = [(None, "en", "s1"), ("", None, None), ("only here", "xx", "s1"), ("x" * 70000, "en", "s2"), ("9 [] {}", "en", "empty")]
    for _ in range(n):
        lang = random.choice(["en", "en", "de", "", None])
        source = random.choice(["s0", "s0", "s0", "s1", "s2", "é", "", None])
        weights = [1 + (len(source or "") * i) % 7 for i in range(len(words))]
        rows.append((" ".join(random.choices(words, weights, k=random.randrange(40))), lang, source))
    return rows + rows[7:12] * 3


def _table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "clash", "clash", 3) for r in rows], SCHEMA).repartition(6)


def test_against_brute_force(spark):
    rows = _rows(250)
    found = divergence.divergence(_table(spark, rows), 10, 5).collect()
    assert sorted(map(tuple, found)) == _expected(rows, 10, 5)


def test_small_blocks_chunks_and_tiles(spark):
    """Many runs, chunks, tiles and blocks of terms give the same result."""
    limits = divergence.Limits(postings=150, terms=20, chunk=2, tile=2, block=7)
    rows = _rows(120, 4)
    block = divergence._Block(limits)
    block.add(b"en", b"s", collections.Counter(dict.fromkeys((b"%d" % i for i in range(20)), 1)))
    assert block.full
    found = divergence.divergence(_table(spark, rows), 6, 5, limits=limits).collect()
    assert sorted(map(tuple, found)) == _expected(rows, 6, 5)


def test_no_kept_terms_and_empty_tables(spark):
    rows = [("a b", "en", "x"), ("c", "en", "y"), (None, "en", None), ("d", "de", "x")]
    found = divergence.divergence(_table(spark, rows), 30, 50).collect()
    assert sorted(map(tuple, found)) == _expected(rows, 30, 50) and len(found) == 6
    assert divergence.divergence(_table(spark, rows).limit(0)).collect() == []


def test_runs_are_sorted_and_merge_in_order():
    random.seed(1)
    chunks, want = [], collections.defaultdict(collections.Counter)
    names = divergence._CHUNK_SCHEMA.split(", ")
    for _ in range(5):
        block = divergence._Block(divergence.Limits(chunk=50))
        for _ in range(20):
            counts = collections.Counter(random.choices([b"%03d" % i for i in range(900)], k=60))
            source = random.choice([b"p", b"q"])
            block.add(b"en", source, counts)
            for term, n in counts.items():
                want[term][source] += n
        run = [dict(zip([n.split()[0] for n in names], row)) for row in block.run(1)]
        terms = [t for c in run for t in c["terms"].split(b" ")]
        assert terms == sorted(set(terms)) and len(run) > 1
        chunks += run
    chunks.sort(key=lambda c: c["first"])
    open_at_once = 0
    got = {}
    for term, places in divergence.merged(iter(chunks)):
        open_at_once = max(open_at_once, len({id(c) for c, _ in places}))
        assert term not in got
        got[term] = collections.Counter()
        for cursor, i in places:
            for source, n in cursor.postings(i):
                got[term][source] += n
    assert list(got) == sorted(want) and got == dict(want) and open_at_once <= 5


def test_terms_of_long_texts(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 50)
    text = ("The café, x9y Ω " * 200).encode()
    assert divergence.term_counts(text) == collections.Counter(
        {b"the": 200, "café".encode(): 200, b"x": 200, b"y": 200, "Ω".encode(): 200}
    )
    assert divergence.term_counts(b"a" * 1000) == {b"a" * 1000: 1}


@pytest.mark.parametrize("count, total, terms", [(0, 0, 1), (10**15, 10**15, 1), (7 * 10**14, 10**16 + 1, 10**6), (1, 3, 2)])
def test_shares_are_exact(spark, count, total, terms):
    df = spark.createDataFrame([(count, total, terms)], "c long, n long, v long")
    found = df.select(divergence.share(df.c, df.n, df.v).alias("p")).first().p
    assert found == 1 + 10**9 * (count + 5) // (total + 5 * terms)
