import random
import re

import xxhash

from regiocast.llm import simhash
from regiocast.llm.queries import op3_simhash_components

SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    grams = [" ".join(w)] if len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, d):
    """rows: (doc_id, fingerprint); every pair compared."""
    root = {f: f for _, f in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = list(root)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= d:
                root[find(a)] = find(b)
    best = {}
    for i, f in rows:
        if i is not None:
            best[find(f)] = min(i, best.get(find(f), i))
    return [(i, f"{f:016x}", best.get(find(f))) for i, f in rows]


def test_fingerprint():
    rng = random.Random(1)
    for t in ["", " \n", "One", "one two", "A b c", "Ä ß\x0bc \x85 d", " ".join(rng.choice("abcdé") for _ in range(70_000))]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_links_of_clustered_fingerprints(spark):
    rng, fps = random.Random(2), set()
    for _ in range(30):
        f = rng.getrandbits(64)
        for _ in range(12):  # walks, so components are chains
            fps.add(f)
            for _ in range(rng.randint(1, 4)):
                f ^= 1 << rng.randrange(64)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for d in (0, 1, 2, 3):
        got = {(r.src & (2**64 - 1), r.dst & (2**64 - 1)) for r in simhash.links(df, d).collect()}
        want = {frozenset((a, b)) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= d}
        assert {frozenset(x) for x in got} == want


def test_components_of_a_long_chain(spark):
    rng = random.Random(4)
    names = rng.sample(range(1000), 60)
    pairs = [(min(a, b), max(a, b)) for a, b in zip(names, names[1:])]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    assert got == {n: min(names) for n in names}


def test_cases(spark):
    rows = [(5, None, 1), (4, "", 1), (None, " ", 1), (None, "lone words here now", 2), (7, "x y z", 3), (7, "x y z", 3), (9, "X Y  z", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = simhash.near_duplicates(df).collect()
    want = plain_components([(i, plain_fingerprint(t or "")) for i, t, _ in rows], 2)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=key) == sorted(want, key=key)
    assert {r.doc_id for r in got if r.keep} == {4, None, 7}
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_query(spark):
    docs = [(r.doc_id, plain_fingerprint(r.text or "")) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = op3_simhash_components(spark, SMALL).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(plain_components(docs, 2))
