import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from regiocast.llm import periodic
from regiocast.llm.queries import op12_periodic_runs

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """Every maximal stretch of each period, the smallest period of each stretch."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q) and not any(q % r == 0 and s <= i and s + m >= i + length for (s, m), r in found.items()):
                found[i, length] = min(q, found.get((i, length), q))
            i = j + 1
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs))


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 9)), max_size=8))
def test_runs_against_brute_force(parts):
    words = [w for unit, times in parts for w in unit * times]
    texts = [[str(w) for w in words], ["0"] * 7, [str(w) for w in reversed(words)]]
    got = periodic._block_runs(texts, 6, 4)  # texts side by side keep their own runs
    assert got == [brute(t) for t in texts]
    assert [periodic._collapsed(t, r) for t, r in zip(texts, got, strict=True)] == [collapse(t, r) for t, r in zip(texts, got, strict=True)]


def test_long_periods_and_very_long_texts():
    rng = np.random.default_rng(0)
    unit = [str(x) for x in rng.integers(0, 50, 5000)]
    words = ["x"] + unit * 4 + unit[:1234] + ["y"]
    assert periodic._block_runs([words], 6, 4) == [[(1, 21234, 5000)]]
    assert periodic._block_runs([["a"] * 300_000], 6, 4) == [[(0, 300_000, 1)]]
    fib = ["a", "ab"]
    while len(fib[-1]) < 3000:
        fib.append(fib[-1] + fib[-2])
    assert periodic._block_runs([list(fib[-1])], 6, 4) == [brute(list(fib[-1]))]


def test_operator_cases(spark):
    texts = [None, "", "  \t ", "a " * 6, "a b " * 4, "a b " * 4, "a b c d", "ü x 汉 ü x 汉 ü x 汉 ü x 汉 end"]
    df = spark.createDataFrame([(i // 2 or None, t, "old", 5) for i, t in enumerate(texts)], "doc_id long, text string, runs string, extra int")
    out = periodic.find_runs(df)
    assert out.columns == ["doc_id", "text", "extra", "runs", "collapsed"]
    got = sorted((r.text or "", [tuple(x) for x in r.runs], r.collapsed, r.extra) for r in out.collect())
    want = sorted((t or "", brute(WORD.findall(t or "")), collapse(WORD.findall(t or ""), brute(WORD.findall(t or ""))), 5) for t in texts)
    assert got == want
    assert periodic.find_runs(df.limit(0)).collect() == []


def _digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = planted(doc_id, text) if doc_id is not None else WORD.findall(text or "")
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *best, milli, _digest(lines), _digest(collapse(words, runs)))


def test_query_against_brute_force(spark, scratch):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    docs = [d for d in docs if len(d[1] or "") < 12_000]
    docs += [(None, "a a a a a a a"), (7, None), (7, None), (11, "w x " * 9 + "y y y y y y"), (20, "only four words here")]
    docs += [(i, "one two three four five six seven eight nine ten") for i in range(3000, 3200)]  # some are planted
    schema = "doc_id long, text string"
    spark.createDataFrame(docs, schema).write.parquet(f"{scratch}/documents.parquet")
    got = [tuple(r) for r in op12_periodic_runs(spark, scratch).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(map(repr, got)) == sorted(map(repr, (expected(*d) for d in docs)))
    assert sum(r[1] > 0 for r in sorted(got, key=key)) > 10


def test_query_covers_the_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert op12_periodic_runs(spark, SMALL).count() == docs.count()
