import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from regiocast.llm import decontamination as dc
from regiocast.llm import pii, quality
from regiocast.llm.queries import PSEUDONYM_KEY

from test_quality import base, plain_score, plain_weights
from test_simhash import plain_components, plain_fingerprint

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    out.append(docs.collect())
    for _, stage in cp.STAGES:
        rows = stage(spark, docs, SMALL).collect()
        out.append(rows)
        if stage is not cp.STAGES[-1][1]:
            docs = spark.createDataFrame(rows, docs.schema)
    return out


def test_stages_return_the_columns_of_documents(stages):
    for rows in stages[:-1]:
        assert rows and list(rows[0].asDict()) == COLUMNS
        assert all(r.n_chars == len(r.text) for r in rows)


def test_quality_stage(spark, stages):
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = [(r.doc_id, r.text, r.lang) for r in stages[0]]
    weights, judged = plain_weights(rows, {i for i, x in labels.items() if x == (1, 0)}, quality.BUCKETS, quality.PRIOR)
    want = set()
    for i, t, g in rows:
        score = plain_score(t, g, weights, judged, quality.BUCKETS)
        if not base(t)[-1] and (score is None or score >= quality.THRESHOLD):
            want.add(i)
    assert {r.doc_id for r in stages[1]} == want and len(want) < len(rows)


def test_near_duplicate_stage(stages):
    found = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in stages[1]], 2)
    assert sorted(r.doc_id for r in stages[2]) == sorted({c for _, _, c in found})
    assert len(stages[2]) < len(stages[1])


def test_decontamination_stage(spark, stages):
    items = [dc.words_of(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    patterns = [(dc.Pattern(w), int(0.2 * len(w))) for w in items]
    dirty = {r.doc_id for r in stages[2] if any(p.distance(dc.words_of(r.text)) <= k for p, k in patterns)}
    assert {r.doc_id for r in stages[2]} - {r.doc_id for r in stages[3]} == dirty and dirty


def test_pseudonym_stage(stages):
    feistel = pii.Feistel(PSEUDONYM_KEY)
    want = {r.doc_id: pii.pseudonymise(r.text, feistel)[0] for r in stages[3]}
    assert {r.doc_id: r.text for r in stages[4]} == want
    assert any(r.text != want[r.doc_id] for r in stages[3])


def test_encoding_stage(stages):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in stages[4]}
    assert len(stages[5]) == len(texts) and all(r.decodes for r in stages[5])
    for r in stages[5]:
        assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids) // 4


def test_run_is_the_stages_in_turn(spark, stages):
    got = cp.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted((r.doc_id, r.n_tokens) for r in stages[5])


def test_every_stage_takes_nulls_repeats_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    good = " ".join(f"w{k % 37} x{k}" for k in range(60))
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, good, "en", "s", 1), (2, good, "en", "s", 1), (None, good + " more", None, "s", 1)]
    for name, stage in cp.STAGES:
        df = spark.createDataFrame(rows, schema)
        out = stage(spark, df, SMALL).collect()
        assert stage(spark, df.limit(0), SMALL).collect() == []
        if name == "near_duplicates":
            assert sum(r.text == good for r in out) == 1
        if name in ("decontamination", "pii", "bpe"):
            assert len(out) == len(rows)


def test_every_stage_takes_long_texts_and_extra_columns(spark):
    """A text of 400,000 words, and columns named like those that stages add."""
    extra = "n_words long, kept boolean, score double, ids binary, decoded string, pii int, key int, fp int, __x string"
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    long = " ".join(f"w{k % 9973} x{k % 7919}" for k in range(200_000)) + " mail me.now@mail1.example.com"
    fill = (7, False, 0.5, b"x", "old", 3, 4, 5, "kept")
    rows = [(1, long, "en", "s", len(long), *fill), (2, " ".join(f"q{k}" for k in range(80)), "xx", "s", 1, *fill)]
    for name, stage in cp.STAGES:
        out = stage(spark, spark.createDataFrame(rows, schema), SMALL).collect()
        assert sorted(r.doc_id for r in out) == [1, 2], name
        if name == "bpe":
            assert all(r.decodes for r in out)
        else:
            assert all(tuple(r)[5:] == fill for r in out), name
            assert (next(r.text for r in out if r.doc_id == 1) == long) == (name != "pii")
