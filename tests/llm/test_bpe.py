import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from regiocast.llm import bpe
from regiocast.llm.queries import op2_bpe_codec

PATH = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"


def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(3)
    words = ["the", "don't", "we'll", "x1", "12,345.6", "naïve", "—dash—", "<|endoftext|>", "a<|endoftext|>b", "ñandú", "''re", "...", "  ", "\n\n", "\t"]
    passage = " ".join(rng.choice(words) for _ in range(400))
    out = [None, "", " ", "\n", "'", "word", "汉字 mixed 🙂 text", passage, passage, "x" * 5000, ("y" * 3000) + passage]
    for k in range(12):
        out.append(" ".join(rng.choice(words) for _ in range(rng.randint(1, 300))) + "'" + passage[k * 7 :] + "re " + rng.choice(words))
    # other scripts take chunk reuse too: with blanks, without, and beside Latin text
    other = ["Привет", "мир,", "ﬁ", "\u0301e", "汉字测试", "🙂🙂", "शब्द", "עברית", "ⅷ", "\u3000", "\u2028", "word"]
    mixed, han = " ".join(rng.choice(other) for _ in range(600)), "".join(rng.choice("水火木金土日月山川田") for _ in range(1500))
    out += [mixed, mixed, han + passage, "x " + han, passage + " 🙂 " + mixed[200:], mixed[:900] + passage[300:] + han[:700]]
    return out


def test_chunks_join_to_the_text_and_follow_the_content():
    for t in texts():
        assert "".join(bpe.cut(t or "")) == (t or "")
    body = texts()[-1]
    assert set(bpe.cut("some new head " * 30 + body)) & set(bpe.cut(body))


def test_stitch_agrees_with_the_library_for_any_known_chunks():
    codec, lib, rng = bpe.Codec.of(PATH), library(), random.Random(5)
    for t in (x for x in texts() if x):
        for share in (0.0, 0.5, 1.0):
            known = {bpe._digest(c): codec.encode(c) for c in bpe.cut(t) if rng.random() <= share}
            assert bpe.stitch(t, known, codec).tolist() == lib.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_encode_and_decode_a_table(spark, bits):
    rows = [(i // 2, t, "clash", b"old") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, ids binary")
    got = bpe.decode(bpe.encode(df, PATH, filter_bits=bits), PATH).collect()
    lib = library()
    want = sorted((i, lib.encode(t or "", add_special_tokens=False).ids) for i, t, _, _ in rows)
    assert sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    assert all(r.decoded == (r.text or "") and r.key == "clash" for r in got)


def test_unusual_characters_do_not_keep_a_text_from_chunk_reuse(spark):
    """One emoji in each of many copies: their chunks are still encoded once."""
    passage = texts()[7] * 3
    df = spark.createDataFrame([(k, f"🙂 {k} " + passage) for k in range(20)], "doc_id long, text string")
    seen = bpe.RepeatFilter(np.full((1 << 16) // 64, np.uint64(2**64 - 1)), 1 << 16)
    assert all(bpe._shared(r.text, seen) for r in df.collect())
    lib = library()
    got = bpe.encode(df, PATH, decoded_col="decoded").collect()
    assert all(np.frombuffer(r.ids, "<u4").tolist() == lib.encode(r.text, add_special_tokens=False).ids and r.decoded == r.text for r in got)


def test_very_long_text(spark):
    rng = random.Random(9)
    long = " ".join(rng.choice(["alpha", "béta", "γάμμα", "delta's", "42", "\n"]) for _ in range(200_000))
    df = spark.createDataFrame([(1, long), (2, long[500_000:])], "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.encode(df, PATH, decoded_col="decoded").collect()}
    assert got[1].decoded == long and got[2].decoded == long[500_000:]
    assert np.frombuffer(got[1].ids, "<u4").tolist() == library().encode(long, add_special_tokens=False).ids


def test_one_worker_a_task(spark):
    plan = op2_bpe_codec(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("Exchange"):  # what runs as one task
        assert part.count("EvalPython") + part.count("MapInArrow") <= 2  # the branches of the union, one after the other


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(df, PATH), PATH).collect() == []


def test_query_matches_the_library(spark):
    lib = library()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for r in docs:
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(lib.decode(ids, skip_special_tokens=False).encode()))
    got = op2_bpe_codec(spark, SMALL).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert len(got) == len(docs)
