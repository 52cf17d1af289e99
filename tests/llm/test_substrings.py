import random

import duckdb
import pytest

from regiocast.llm import substrings as sub
from regiocast.llm.queries import ORACLE_SQL, op8_substring_dedup

SMALL = "/root/testdata/sf0.001"


def plain(rows, k):
    """Removed words by a table of all windows."""
    order = lambda i: (i is not None, i or 0)
    first = {}
    for i, t in rows:
        w = sub.words_of(t or "")
        for at in range(len(w) - k + 1):
            key, place = tuple(w[at : at + k]), (order(i), at)
            first[key] = min(first.get(key, place), place)
    out = []
    for i, t in rows:
        w = sub.words_of(t or "")
        gone = {j for at in range(len(w) - k + 1) if first[tuple(w[at : at + k])] != (order(i), at) for j in range(at, at + k)}
        out.append((i, b" ".join(x for j, x in enumerate(w) if j not in gone).decode(), len(w), len(gone)))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, n_words int, string string, start int")


def rows(seed=1):
    rng = random.Random(seed)
    passage = [rng.choice("abcdefgé") * rng.randint(1, 3) for _ in range(90)]
    out = [(None, None), (None, " ".join(passage[:40])), (3, ""), (3, " ".join(passage)), (3, " ".join(passage)), (2, "same " * 200)]
    for d in range(25):
        head = [rng.choice("ab") for _ in range(rng.randint(0, 60))]
        a = rng.randrange(90)
        out.append((d - 5, " ".join(head) + "\n" + "\t".join(passage[a : a + rng.randint(0, 90)]) + "\x0b " + " ".join(head[::-1])))
    return out


def test_equal_words_have_equal_hashes():
    text = "é\t b  é\x0bb\n" + "x" * 10_000 + " bb " + "w " * 70_000
    hashes, words = sub.word_hashes(text.encode()).tolist(), sub.words_of(text)
    assert len(hashes) == len(words) and len(set(zip(hashes, words))) == len(set(hashes)) == len(set(words))


def test_super_kmers_cover_every_window_once():
    rng = random.Random(3)
    for n in (0, 5, 6, 7, 50, 400):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(n)]
        _, first, last, strings = sub.super_kmers(b' '.join(words), 6, 3)
        assert len(strings) == len(first)
        covered = [w for a, b in zip(first, last) for w in range(a, b + 1)]
        assert covered == list(range(max(0, n - 5))) and all(b - a < 4 for a, b in zip(first, last))


def test_texts_together_are_cut_as_each_alone():
    rng = random.Random(5)
    texts = [" \t".join(rng.choice("abcd") + rng.choice("é ") for _ in range(n)) for n in (0, 3, 40, 0, 6, 5, 200, 1, 70)]
    found = sub.SuperKmers.of(texts, 6, 3)
    for d, text in enumerate(texts):
        own = found.doc == d
        key, first, last, string = sub.super_kmers(text.encode(), 6, 3)
        assert found.key[own].tolist() == key.tolist() and found.string[own].tolist() == string.tolist()
        assert (found.first[own] - found.before[d]).tolist() == first.tolist() and (found.last[own] - found.before[d]).tolist() == last.tolist()
        words = sub.words_of(text)
        assert list(found.words(found.first[own], 6)) == [b" ".join(words[a : a + 6]) for a in first]


@pytest.mark.parametrize(("k", "m", "bits"), [(20, 8, 1 << 20), (6, 3, 1 << 20), (5, 5, 64), (4, 1, 1 << 12)])
def test_against_brute_force(spark, k, m, bits):
    got = sub.remove_repeats(table(spark, rows()), k=k, m=m, filter_bits=bits)
    assert sorted(((r.doc_id, r.kept_text, r.n_words, r.n_removed) for r in got.collect()), key=str) == plain(rows(), k)
    assert {"string", "start"} <= set(got.columns)


def test_empty_table(spark):
    assert sub.remove_repeats(table(spark, rows()).limit(0)).collect() == []


def test_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    res = con.execute(ORACLE_SQL["op8_substring_dedup"])
    names = [d[0] for d in res.description]
    got = op8_substring_dedup(spark, SMALL)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(res.fetchall())


@pytest.mark.parametrize("hot_bits", [1, 40, 65])
def test_a_phrase_with_many_neighbours_takes_single_windows(spark, hot_bits):
    """All, some or no minimisers are split: the same words go."""
    rng = random.Random(6)
    phrase = "over and over the very same five words".split()
    data = [(d, " ".join([f"x{rng.randrange(9)}" for _ in range(12)] + phrase + [f"y{rng.randrange(9)}" for _ in range(12)])) for d in range(300)]
    data += [(1000 + d, data[d][1]) for d in range(0, 300, 7)]
    got = sub.remove_repeats(spark.createDataFrame(data, "doc_id long, text string"), k=6, m=3, hot_sample=1, hot_bits=hot_bits)
    assert sorted(((r.doc_id, r.kept_text, r.n_words, r.n_removed) for r in got.collect()), key=str) == plain(data, 6)


def test_windows_of_a_hot_minimiser_spread_over_buckets():
    """What a third of the documents share under other neighbours does not meet in one bucket."""
    rng = random.Random(8)
    texts = [" ".join([f"a{rng.random()}" for _ in range(20)] + ["the", "one", "phrase", "of", "all"] + [f"b{rng.random()}" for _ in range(20)]).encode() for _ in range(5000)]
    keys, sketch = {}, {}
    for raw in texts:
        for key, _, _, string in zip(*(x.tolist() for x in sub.super_kmers(raw, 20, 5)), strict=True):
            keys[key] = keys.get(key, 0) + 1
            if string % sub.HOT_SAMPLE == 0:
                sketch[key] = sketch.get(key, 0) | 1 << (string // sub.HOT_SAMPLE % 64)
    often = max(keys, key=keys.get)
    if keys[often] > 2800:  # the phrase is the minimiser of its windows
        assert bin(sketch[often]).count("1") >= sub.HOT_BITS
    assert all(bin(v).count("1") < sub.HOT_BITS for k, v in sketch.items() if keys[k] < 500)
