"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every rule is a ratio that rejects a document above a cutoff. The labelled
documents are the holdout. For each stratum (language), rule and candidate
cutoff we count good documents that the cutoff would reject and ask for an exact
binomial bound: with k of n good documents rejected, the cutoff is certified
when P(Binomial(n, risk) <= k) <= delta / tests, so that the true rate of false
rejection is below risk with confidence 1 - delta over all tests at once
(Bonferroni over strata x rules x cutoffs). risk is the stratum's total divided
by the number of rules, hence the union of the rules stays below the total.
Of the certified cutoffs that reject most bad documents the loosest is used;
without a certified cutoff the rule rejects nothing in that stratum.

Defined cases: null or empty text has no words and fails the base rules; a null
language is a stratum of its own, and a table without a column lang is one
stratum; of repeated labels of one document the best counts; null labels and
labels of absent documents are ignored; a null doc_id has no label; repeated
documents are separate rows; texts may be of any length; without labels only the
base rules act; an empty table gives no rows; columns of any other names pass
through keep_good as they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rule -> candidate cutoffs, strictest first.
RULES = {
    "symbol_ratio": (0.01, 0.02, 0.05, 0.1, 0.2, 0.4),
    "dup_line_ratio": (0.1, 0.2, 0.3, 0.5, 0.7),
    "repeat_ratio": (0.05, 0.1, 0.15, 0.2, 0.25),
    "exclaim_ratio": (0.02, 0.05, 0.1, 0.2, 0.5),
}
RISK, DELTA = 0.05, 0.05


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row: a lambda's variable isn't expanded by the optimizer."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the text."""

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, e, k: (F.get(s, k)["h"] == e["h"])
        places = let(
            pairs,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(s, lambda e, k: F.coalesce(same(s, e, k - 1), F.lit(False)) | F.coalesce(same(s, e, k + 1), F.lit(False))),
                    lambda e: e["i"],
                )
            ),
        )
        return let(
            places,
            lambda p: F.aggregate(
                p,
                F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
                lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n")),
                lambda a: a["n"],
            ),
        )

    def doubled(hashes: Column, k: int) -> Column:
        """Hashes of runs of 2k words from those of runs of k words."""
        return let(
            hashes,
            lambda h: F.zip_with(F.slice(h, 1, F.size(h) - k), F.slice(h, k + 1, F.size(h)), lambda a, b: F.xxhash64(a, b)),
        )

    windows = doubled(doubled(doubled(F.transform(words, lambda w: F.xxhash64(w)), 1), 2), 4)
    return F.when(
        F.size(words) >= WINDOW,
        let(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0))),
    ).otherwise(F.lit(0))


def features(docs: DataFrame, text: str = "text") -> list[Column]:
    """The base counts and the rules' further counts, as columns over docs."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, SPACE), lambda w: w != "")
    of_words = let(
        words,
        lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("c"), _repeat_words(w).alias("r")),
    )
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0)
    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    less = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    return [
        of_words.alias("_w"),
        less(SYMBOLS).cast("long").alias("n_symbols"),
        of_lines.alias("_l"),
        (F.size(F.split(t, "!")) - 1).alias("n_exclaim"),
    ]


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """keep, stratum, the base counts, base_failed and the rules' ratios of each document."""
    stratum = F.coalesce(F.col("lang"), F.lit("")) if "lang" in docs.columns else F.lit("")
    f = docs.select(*keep, stratum.alias("_stratum"), *features(docs))
    f = f.select(
        *keep,
        "_stratum",
        F.col("_w.n").cast("long").alias("n_words"),
        F.col("_w.c").cast("long").alias("word_chars"),
        "n_symbols",
        (F.col("_l.n") - F.col("_l.d")).cast("long").alias("n_dup_lines"),
        F.col("_w.r").cast("long").alias("n_repeat_words"),
        F.col("_l.n").alias("_lines"),
        "n_exclaim",
    )
    per = lambda n, of: F.col(n) / F.greatest(F.col(of), F.lit(1))
    return f.select(
        *keep,
        "_stratum",
        *COUNTS,
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        per("n_symbols", "word_chars").alias("symbol_ratio"),
        per("n_dup_lines", "_lines").alias("dup_line_ratio"),
        per("n_repeat_words", "n_words").alias("repeat_ratio"),
        per("n_exclaim", "n_words").alias("exclaim_ratio"),
    )


def _log_gamma(x: Column) -> Column:
    """Stirling's series at x + 8, brought back to x (x >= 1)."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y)
    shift = F.log(x)
    for i in range(1, 8):
        shift = shift + F.log(x + i)
    return series - shift


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) for k <= n p; 1 above. Terms are summed downward from k until they vanish (12 deviations)."""
    n, k = n.cast("double"), k.cast("double")
    top = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    steps = F.least(k, F.ceil(12 * F.sqrt(n * p * (1 - p))) + 60).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(0), steps),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, d: F.struct(
            (a["term"] * (k - d) * (1 - p) / ((n - k + d + 1) * p)).alias("term"), (a["sum"] + a["term"]).alias("sum")
        ),
        lambda a: a["sum"],
    )
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * total))


def cutoffs(features_: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """_stratum and a column cut_<rule> of the certified cutoff, null where there is none."""
    best = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("_q"))
    known = features_.where(~F.col("base_failed")).select("doc_id", "_stratum", *RULES).join(best, "doc_id")
    tried = [(r, i, c) for r, cs in RULES.items() for i, c in enumerate(cs)]
    n_if = lambda c: F.sum(F.when(c, 1).otherwise(0))
    good = F.col("_q") > 0
    counts = known.groupBy("_stratum").agg(
        n_if(good).alias("n"),
        *[n_if(good & (F.col(r) > c)).alias(f"g_{r}_{i}") for r, i, c in tried],
        *[n_if(~good & (F.col(r) > c)).alias(f"b_{r}_{i}") for r, i, c in tried],
    )
    # one row for each stratum, so that this list is as long as there are strata
    strata = counts.agg(F.collect_list(F.struct("*")).alias("s")).select(F.size("s").alias("m"), F.explode("s").alias("s")).select("m", "s.*")
    per_rule = risk / len(RULES)
    each = F.array(
        *[
            F.struct(F.lit(r).alias("rule"), F.lit(c).alias("c"), F.col(f"g_{r}_{i}").alias("g"), F.col(f"b_{r}_{i}").alias("b"))
            for r, i, c in tried
        ]
    )
    rows = strata.select("_stratum", "m", "n", F.inline(each))
    certified = rows.where(binomial_cdf(F.col("g"), F.col("n"), per_rule) <= delta / (len(tried) * F.col("m")))
    # most bad documents first, then the loosest cutoff
    return certified.groupBy("_stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.struct("b", "c")))["c"].alias(f"cut_{r}") for r in RULES]
    )


def verdicts(features_: DataFrame, cuts: DataFrame) -> DataFrame:
    """features_ with kept; the cutoffs (a row for each stratum) are joined, and Spark broadcasts them where their size allows."""
    rejects = F.lit(False)
    for r in RULES:
        rejects = rejects | F.coalesce(F.col(r) > F.col(f"cut_{r}"), F.lit(False))
    joined = features_.join(cuts, "_stratum", "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejects)


def quality(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """doc_id, the base counts, base_failed, the ratios and kept of each row of docs.

    The counts (a few numbers a document) are saved once, so that texts are read once.
    """
    f = saved(with_features(docs, ["doc_id"]), "quality")
    out = verdicts(f, cutoffs(f, labels, risk, delta))
    return out.select("doc_id", *COUNTS, "base_failed", "kept", *RULES)


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of docs, with their columns, that the rules keep. Rows are saved once with their counts, so that texts are read once."""
    lang = ["lang"] if "lang" in docs.columns else []
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text", *lang)
    f = saved(with_features(row, ["_row", "doc_id"]), "quality-rows")
    cuts = saved(cutoffs(f.drop("_row"), labels, risk, delta), "cutoffs")
    return verdicts(f, cuts).where("kept").select("_row.*")
