import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from regiocast.llm import token_counts
from regiocast.llm.queries import op6_token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"


def test_counts_misses_and_hits(spark, scratch):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [None, "", " ", "a b", "a b", "<s> x </s>", "汉字🙂", "w " * 30000]
    df = spark.createDataFrame([(i // 2, t, -1, b"x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, digest binary")
    cache = f"{scratch}/cache"
    got = token_counts.count_tokens(df, MODEL, cache).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted((i // 2, len(sp.encode(t or "")) if t else 0) for i, t in enumerate(texts))
    assert all(r.digest == b"x" for r in got)
    assert spark.read.parquet(cache).count() == 6  # different texts, NULL counted as empty
    # a second run over more texts appends the new one alone, and trusts the stored counts
    more = df.unionByName(spark.createDataFrame([(99, "brand new", 0, b"y")], df.schema))
    again = token_counts.count_tokens(more, MODEL, cache).collect()
    assert spark.read.parquet(cache).count() == 7
    assert sorted(r.n_tokens for r in again if r.doc_id != 99) == sorted(r.n_tokens for r in got)


def test_another_tokenizer_is_another_version(spark, scratch):
    cache = f"{scratch}/cache"
    df = spark.createDataFrame([(1, "Hello there")], "doc_id long, text string")
    token_counts.count_tokens(df, MODEL, cache).collect()
    other = public_tokenizers.path("word_bpe_49k.json")
    got = token_counts.count_tokens(df, other, cache, normalise=F.lower).collect()
    assert got[0].n_tokens == token_counts.counter(other)("Hello there")
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


@pytest.mark.parametrize("bits", [64, 1 << 26])
def test_full_bitmaps_change_nothing(spark, scratch, bits):
    """Hits, copies and lone texts in any mix, also where every slot is shared by chance; each text is stored once."""
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    first = [(i, f"text number {i % 70}") for i in range(100)] + [(None, None), (None, "")]
    more = [(1000 + i, f"text number {50 + i % 90}") for i in range(150)] + first[:20] + [(i, "hot " * 50) for i in range(60)]
    cache, stored = f"{scratch}/cache", set()
    for rows in (first, more):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = token_counts.count_tokens(df, MODEL, cache, bits=bits).collect()
        assert sorted((str(r.doc_id), r.text or "", r.n_tokens) for r in got) == sorted((str(i), t or "", len(sp.encode(t or ""))) for i, t in rows)
        stored |= {t or "" for _, t in rows}
        assert spark.read.parquet(cache).count() == len(stored)
    assert token_counts.count_tokens(df, MODEL, cache, bits=bits).count() == len(more)
    assert spark.read.parquet(cache).count() == len(stored)  # a third run appends nothing


def test_empty_table(spark, scratch):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(df, MODEL, f"{scratch}/c").collect() == []


def test_query(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = op6_token_counts(spark, SMALL).collect()
    want = {i: (len(t.encode()), len(sp.encode(t)), len(sp.encode(t)) > 4096) for i, t in docs.items()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == want
