"""URL filter by mined association rules.

Labelled URLs become baskets of tokens (host and path pieces, query keys,
scheme, with digits folded), Spark's FP-growth finds the token combinations
that are frequent together with a label, and those that imply it become rules.
Rules are pruned by support and confidence, and one goes if a part of its
tokens implies the same label at least as surely.  Rules are matched by an
inverted index: each stands under its rarest token, URLs meet it there, and
the other tokens are checked; the surest rule decides.  A list of explicit
rules (host, path) comes first and may provide the labels.

FP-growth is fitted on at most ``mined_max`` labelled URLs, those of the
smallest hashes; support and confidence are then counted over all of them.
Tokens of the same URLs of that fit count as one (the smallest name stays), so
long constant parts do not multiply combinations.

Cases: a NULL URL, or one without ``://``, has an empty host and path, no
tokens and no rule; rows that repeat get one output row each; without enough
labels no rule is mined and everything else is allowed; an empty table gives
an empty one; other columns pass through, those named like an output column
are replaced.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocast.llm.common import cut_lineage

#: Most labelled URLs that FP-growth is fitted on.
MINED_MAX = 200_000
#: Share and number of labelled URLs that a rule's tokens and label need.
MIN_SUPPORT, MIN_COUNT = 0.01, 10
MIN_CONFIDENCE = 0.95
#: Tokens of a rule at most.
MAX_TOKENS = 4
_SLOTS = 1 << 16
RULES = "tokens array<string>, verdict string, confidence double, support long, anchor string"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return _lower(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: ``s:`` scheme, ``h:`` host and ``p:`` path pieces, ``q:`` query keys, ``f:`` a fragment."""
    folded = F.regexp_replace(_lower(F.coalesce(url, F.lit(""))), "[0-9]+", "0")
    rest = _rest(folded)
    asked = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)

    def pieces(kind: str, text: Column, cut: str) -> Column:
        return F.transform(F.filter(F.split(text, cut), lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))

    parts = F.concat(
        pieces("s:", F.regexp_extract(folded, r"^([^:/?#]*)://", 1), "://"),
        pieces("h:", host(folded), r"[.\-_:@]"),
        pieces("p:", path(folded), r"[/.\-_~+%=&;,]"),
        F.transform(pieces("q:", asked, "&"), lambda x: F.substring_index(x, "=", 1)),
        F.when(rest.contains("#"), F.array(F.lit("f:#"))).otherwise(F.array().cast("array<string>")),
    )
    return F.array_distinct(parts)


def by_list(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) of the different URLs that a rule (host, path, verdict) fits; the longest wins.

    A rule fits its host and all subdomains where the URL's path starts with
    its own; URLs meet it by equal host endings.
    """
    places = urls.select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    endings = F.transform(labels, lambda _, k: F.array_join(F.slice(labels, k + 1, F.size(labels)), "."))
    met = places.withColumn("ending", F.explode(endings)).join(
        rules.select(F.col("host").alias("ending"), F.col("path").alias("__path"), F.col("verdict")), "ending"
    )
    fits = met.where(F.startswith("path", "__path"))
    rule = F.concat("ending", "__path")
    best = F.max_by(F.struct(rule.alias("rule"), "verdict"), F.struct(F.length("ending"), F.length("__path"), "verdict"))
    return fits.groupBy("url").agg(best.alias("best")).select("url", "best.rule", "best.verdict")


def _sample(labelled: DataFrame, most: int) -> tuple[DataFrame, int]:
    """The labelled URLs of the smallest hash slots, ``most`` at most, and their number."""
    slot = F.pmod(F.xxhash64("url", "verdict"), F.lit(_SLOTS))
    counts = {r.slot: r.n for r in labelled.groupBy(slot.alias("slot")).agg(F.count("*").alias("n")).collect()}  # _SLOTS rows at most
    taken, end = 0, 0
    while end < _SLOTS and taken + counts.get(end, 0) <= most:
        taken, end = taken + counts.get(end, 0), end + 1
    return labelled.where(slot < end), taken


def _distinct_tokens(baskets: DataFrame) -> DataFrame:
    """Baskets with one token for all that occur in the same URLs."""
    single = baskets.select("url", "verdict", F.explode("tokens").alias("token"))
    key = F.xxhash64("url", "verdict")
    where = single.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(key).alias("x"), F.sum(F.shiftrightunsigned(key, 24)).alias("s"))
    names = where.groupBy("n", "x", "s").agg(F.min("token").alias("token")).select("token")
    return single.join(names, "token").groupBy("url", "verdict").agg(F.collect_list("token").alias("tokens"))


def _proper_parts(items: Column) -> Column:
    """Every proper part of an array of at most ``MAX_TOKENS`` tokens, the empty one too."""
    chosen = (c for k in range(MAX_TOKENS) for c in combinations(range(MAX_TOKENS), k))
    parts = F.array(*(F.array_compact(F.array(*(F.get(items, F.lit(i)) for i in c)).cast("array<string>")) for c in chosen))
    return F.array_distinct(F.filter(parts, lambda x: F.size(x) < F.size(items)))


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_count: int = MIN_COUNT,
    min_confidence: float = MIN_CONFIDENCE,
    mined_max: int = MINED_MAX,
) -> DataFrame:
    """Rules (``RULES``) from labelled URLs (url, verdict).

    ``confidence`` and ``support`` (rows with the tokens and the verdict) cover
    all different labelled rows; ``anchor`` is the rule's rarest token.
    """
    spark = labelled.sparkSession
    labelled = cut_lineage(labelled.where("url IS NOT NULL AND verdict IS NOT NULL").select("url", "verdict").distinct())
    sample, n = _sample(labelled, mined_max)
    if n < min_count:
        return spark.createDataFrame([], RULES)
    baskets = _distinct_tokens(sample.withColumn("tokens", tokens(F.col("url"))))
    least = max(min_support, min_count / n)
    items = F.concat("tokens", F.array(F.concat(F.lit("="), "verdict")))
    frequent = FPGrowth(itemsCol="items", minSupport=least).fit(baskets.select(items.alias("items"))).freqItemsets
    label = F.get(F.filter("items", lambda x: F.startswith(x, F.lit("="))), F.lit(0))
    sets = frequent.select(F.substr(label, F.lit(2)).alias("verdict"), F.array_sort(F.array_compact(F.array_remove("items", F.coalesce(label, F.lit("="))))).alias("tokens"), "freq")
    sets = cut_lineage(sets.where(F.size("tokens") <= MAX_TOKENS))  # FP-growth would run again for each use
    alone = sets.where("verdict IS NULL").select("tokens", F.col("freq").alias("n"))
    implied = sets.where("verdict IS NOT NULL AND size(tokens) > 0").join(alone, "tokens").withColumn("sure", F.col("freq") / F.col("n"))
    base = sets.where("verdict IS NOT NULL AND size(tokens) = 0").select("tokens", "verdict", (F.col("freq") / n).alias("part_sure"))
    parts = implied.select("tokens", "verdict", "sure", F.explode(_proper_parts(F.col("tokens"))).alias("part"))
    known = implied.select(F.col("tokens").alias("part"), "verdict", F.col("sure").alias("part_sure")).unionByName(base.withColumnRenamed("tokens", "part"))
    idle = parts.join(known, ["part", "verdict"]).where("part_sure >= sure").select("tokens", "verdict").distinct()
    rules = implied.where(F.col("sure") >= min_confidence).join(idle, ["tokens", "verdict"], "left_anti").select("tokens", "verdict")
    rules = cut_lineage(_anchored(rules, alone))
    return _recounted(labelled, rules, min_support, min_count, min_confidence)


def _anchored(rules: DataFrame, alone: DataFrame) -> DataFrame:
    """Each rule with its rarest token (ties: the first), under which the index holds it."""
    seen = alone.where("size(tokens) = 1").select(F.col("tokens")[0].alias("token"), "n")
    single = rules.select("tokens", "verdict", F.explode("tokens").alias("token")).join(seen, "token")
    return single.groupBy("tokens", "verdict").agg(F.min_by("token", F.struct("n", "token")).alias("anchor"))


def _hits(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (with ``__tokens``) beside each rule all of whose tokens they have, found under its anchor."""
    met = urls.withColumn("anchor", F.explode("__tokens")).join(rules, "anchor")
    return met.where(F.size(F.array_except("tokens", "__tokens")) == 0)


def _recounted(labelled: DataFrame, rules: DataFrame, min_support: float, min_count: int, min_confidence: float) -> DataFrame:
    urls = labelled.select(F.col("verdict").alias("is"), tokens(F.col("url")).alias("__tokens"))
    total = labelled.count()
    counted = (
        _hits(urls, rules)
        .groupBy("tokens", "verdict")  # not by the anchor too: a hot one's join stays free to be split
        .agg(F.count("*").alias("n"), F.count_if(F.col("is") == F.col("verdict")).alias("support"), F.first("anchor").alias("anchor"))
        .withColumn("confidence", F.col("support") / F.col("n"))
    )
    enough = (F.col("support") >= max(min_support * total, min_count)) & (F.col("confidence") >= min_confidence)
    return cut_lineage(counted.where(enough).select("tokens", "verdict", "confidence", "support", "anchor"))


def by_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined, verdict) of the different URLs that a mined rule fits; the surest, then most supported one decides."""
    hits = _hits(urls.select("url", tokens(F.col("url")).alias("__tokens")), rules)
    rank = F.struct("confidence", "support", F.size("tokens"), F.concat_ws(" ", "tokens"))
    best = F.max_by(F.struct(F.concat_ws(" ", "tokens").alias("mined"), "verdict"), rank)
    return hits.groupBy("url").agg(best.alias("best")).select("url", "best.mined", "best.verdict")


def judge(df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", **limits) -> DataFrame:
    """``df`` plus ``host``, ``path``, ``rule``, ``mined`` and ``verdict``.

    The explicit ``rules`` (host, path, verdict) decide where one fits; what
    they decide is the labelled set, and the mined rules judge the others.
    """
    urls = cut_lineage(df.select(F.coalesce(url_col, F.lit("")).alias("url")).distinct())
    listed = cut_lineage(by_list(urls, rules))
    mined = mine(listed.select("url", "verdict"), **limits)
    open_ = urls.join(listed, "url", "left_anti")
    decided = listed.select("url", "rule", F.lit(None).cast("string").alias("mined"), "verdict").unionByName(
        by_rules(open_, mined).select("url", F.lit(None).cast("string").alias("rule"), "mined", "verdict")
    )
    keyed = df.drop("host", "path", "rule", "mined", "verdict").withColumn("__llm_url", F.coalesce(url_col, F.lit("")))
    out = keyed.join(decided.withColumnRenamed("url", "__llm_url"), "__llm_url", "left")
    return out.withColumns(
        {"host": host(F.col("__llm_url")), "path": path(F.col("__llm_url")), "verdict": F.coalesce("verdict", F.lit(default))}
    ).drop("__llm_url")
