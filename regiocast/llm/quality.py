"""Quality rules: base counts of each text, then a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into a fixed number of buckets.  The ratio of
the trusted target's multinomial to the raw corpus' multinomial gives each
bucket a weight, a text's score is the mean weight of its n-grams (so length
does not matter), and a fixed threshold decides every document alike, without
sampling.  The raw counts cover the whole corpus; the target is estimated on
at most ``TRUSTED_MAX`` trusted documents, those with the smallest hash of
their id, which is what makes its broadcast bounded.

Within each group (language) the target's counts are scaled to the group's raw
mass, so a group of which little is trusted does not look unlike the target;
a group without any trusted document has no ratio, and only the base rules
judge it.  The occurrence that is being scored is left out of the raw count of
its bucket, so a text does not lose for its own rare words.  The pseudo-count
is one of occurrences: what sampling can do to a bucket depends on how many
there are in it, at any size of the table.

Everything is a DataFrame expression: one aggregate by bucket (a shuffle of at
most buckets x groups x tasks rows) and one pass without any shuffle.

Cases: NULL and empty texts have no words and fail the base rules; a text
without n-grams scores 0; a text of a group that is not judged has a NULL score;
a NULL group is a group like any other; rows that repeat are judged alike, and
count as often in the corpus; other columns pass through, one named like an
output column is replaced; with an empty corpus or an empty target no group is
judged.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiocast.llm.common import split_words

BUCKETS = 1 << 16
#: Bound of the trusted sample (documents).
TRUSTED_MAX = 50_000
#: Pseudo-count of each bucket, in occurrences: buckets that few words share weigh little.
PRIOR = 30.0
#: Mean log ratio below which a text is rejected.
THRESHOLD = -0.08
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

OUTPUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _positions(first: int, count: Column) -> Column:
    """first, first + 1, ... (count of them, maybe none)."""
    return F.when(count > 0, F.sequence(F.lit(first), count + F.lit(first - 1))).otherwise(F.array().cast("array<int>"))


def window_keys(hashes: Column, bits: Column) -> Column:
    """Sorted longs, one per three-word window: its hash above, its place in the lowest ``bits``."""
    firsts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0)))
    return F.sort_array(
        F.transform(firsts, lambda a, i: _high(F.xxhash64(a, F.get(hashes, i + 1), F.get(hashes, i + 2)), bits).bitwiseOR(i.cast("long")))
    )


def repeated_words(words: Column, keys: Column, bits: Column) -> Column:
    """Words that lie in a three-word window found twice or more; equal keys are compared word by word."""
    place = lambda key: (key - _high(key, bits)).cast("int")
    window = lambda key: F.slice(words, place(key) + 1, F.lit(3))

    def like_previous(key: Column, k: Column) -> Column:
        before = F.get(keys, k - 1)  # NULL at the start
        return (F.call_function("shiftright", key.bitwiseXOR(before), bits) == 0) & (window(key) == window(before))

    def covered(at: Column) -> Column:
        """Words under the windows at the sorted places ``at``."""
        grow = F.aggregate(_positions(1, F.size(at) - 1), F.lit(3), lambda c, k: c + F.least(F.lit(3), F.get(at, k) - F.get(at, k - 1)))
        return F.when(F.size(at) > 0, grow).otherwise(F.lit(0))

    at = F.filter(F.transform(keys, lambda key, k: F.when(like_previous(key, k), k)), lambda k: k.isNotNull())
    both = F.flatten(F.transform(at, lambda k: F.array(place(F.get(keys, k - 1)), place(F.get(keys, k)))))
    return let(F.sort_array(F.array_distinct(both)), covered)


def _high(key: Column, bits: Column) -> Column:
    """The key without its lowest ``bits``."""
    return F.call_function("shiftleft", F.call_function("shiftright", key, bits), bits)


def word_bucket(word_hash: Column, buckets: int) -> Column:
    """One of a power of two of buckets."""
    return word_hash.bitwiseAND(F.lit(buckets - 1))


def pair_bucket(first: Column, second: Column, buckets: int) -> Column:
    """Of the hashes of two neighbouring words: other bits of the first than its own bucket has."""
    return F.shiftrightunsigned(first, 24).bitwiseXOR(second).bitwiseAND(F.lit(buckets - 1))


def trusted_sample(labels: DataFrame, id_col: str = "doc_id", bound: int = TRUSTED_MAX) -> DataFrame:
    """At most ``bound`` ids of documents labelled good and not toxic, chosen by hash."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col(id_col).isNotNull())
    return good.select(id_col).distinct().orderBy(F.xxhash64(id_col), id_col).limit(bound)


class Model(NamedTuple):
    """Weight of each bucket, and the groups that are judged."""

    weights: list[float]
    groups: list[str]


def _group(group_col: str | None) -> Column:
    return F.coalesce(F.col(group_col).cast("string"), F.lit("")) if group_col else F.lit("")


def fit(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_col: str | None = None,
    buckets: int = BUCKETS,
    prior: float = PRIOR,
) -> Model:
    """Log of target over raw probability per bucket.  ``trusted`` holds a bounded number of ids."""
    if buckets & (buckets - 1):
        raise ValueError("the number of buckets is a power of two")
    ids = trusted.select(F.col(id_col).alias("__trusted")).distinct()
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), _group(group_col).alias("g"))
    flagged = plain.join(F.broadcast(ids), F.col("id") == F.col("__trusted"), "left").select(
        F.col("__trusted").isNotNull().cast("long").alias("good"), "g", split_words(F.col("t")).alias("w")
    )
    placed = flagged.select("good", "g", "w", F.explode(_positions(0, F.size("w"))).alias("i"))
    following = F.get("w", F.col("i") + 1)
    hashed = placed.select("good", "g", F.xxhash64(F.get("w", F.col("i"))).alias("h"), F.when(following.isNotNull(), F.xxhash64(following)).alias("h2"))
    each = F.array(word_bucket(F.col("h"), buckets), F.when(F.col("h2").isNotNull(), pair_bucket(F.col("h"), F.col("h2"), buckets)))
    grams = hashed.select("good", "g", F.explode(each).alias("bucket")).where("bucket IS NOT NULL")
    counts = grams.groupBy("g", "bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("good"))
    # at most ``buckets`` rows a group from here on
    own = Window.partitionBy("g")
    scaled = counts.select("g", "bucket", "raw", "good", F.sum("raw").over(own).alias("all_raw"), F.sum("good").over(own).alias("all_good"))
    judged = scaled.where("all_good > 0")
    # a group among those judged has trusted documents, whose number is bounded
    sums = judged.groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum(F.col("good") * (F.col("all_raw") / F.col("all_good"))).alias("target"), F.collect_set("g").alias("groups")
    )
    weights, groups = [0.0] * buckets, set()
    weight = F.log((F.col("target") + prior) / (F.col("raw") - 1 + prior))
    for bucket, w, seen in sums.select("bucket", weight, "groups").collect():
        weights[bucket] = w
        groups.update(seen)
    return Model(weights, sorted(groups))


def judge(docs: DataFrame, model: Model, text_col: str = "text", group_col: str | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus the base counts, ``base_failed``, ``score`` and ``kept``."""
    text, words, hashes, bits = F.coalesce(F.col(text_col), F.lit("")), F.col("__llm_words"), F.col("__llm_hashes"), F.col("__llm_bits")
    buckets = len(model.weights)
    table = F.split(F.lit(",".join(map(repr, model.weights))), ",").cast("array<double>")  # folded to a literal
    alone = lambda h: F.get(table, word_bucket(h, buckets))
    pair = lambda a, b: F.get(table, pair_bucket(a, b, buckets))
    # each word with its successor; the last one has none
    grams = F.zip_with(hashes, F.slice(hashes, F.lit(2), F.size(hashes)), lambda a, b: alone(a) + F.when(b.isNull(), F.lit(0.0)).otherwise(pair(a, b)))
    total = F.aggregate(grams, F.lit(0.0), lambda s, x: s + x)

    score = F.when(F.size(words) > 0, total / (2 * F.size(words) - 1)).otherwise(F.lit(0.0))
    score = F.when(_group(group_col).isin(model.groups), score)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counts = [
        F.size(words),
        F.length(F.array_join(words, "")),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        repeated_words(words, F.col("__llm_keys"), bits),
    ]
    values = [c.cast("long").alias(name) for name, c in zip(OUTPUT, counts, strict=False)] + [score.alias("score")]
    # always true, but nothing is pushed below it: a filter on the verdict would otherwise
    # be evaluated on the text itself, with words and keys computed anew for each element
    once = F.when(F.rand(0) < F.size(words) + 1, F.struct(*values))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        docs.drop(*OUTPUT)
        .withColumn("__llm_words", split_words(F.col(text_col)))
        .withColumn("__llm_bits", F.length(F.bin(F.size(words))))
        .withColumn("__llm_hashes", F.transform("__llm_words", lambda w: F.xxhash64(w)))
        .withColumn("__llm_keys", window_keys(hashes, bits))
        .withColumn("__llm_base", once)
        .withColumns({name: F.col(f"__llm_base.{name}") for name in OUTPUT[:5] + ["score"]})
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score").isNull() | (F.col("score") >= threshold)))
        .drop("__llm_words", "__llm_hashes", "__llm_bits", "__llm_keys", "__llm_base")
    )
