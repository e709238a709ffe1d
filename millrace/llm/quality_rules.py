"""Quality rules whose cutoffs are certified on labelled documents.

Every rule is a share in thousandths that is high for bad text.  A document is rejected by a rule when its share
reaches the rule's cutoff.  In each stratum a cutoff may be used only if the exact binomial test rejects "more than
``risk`` of the good documents of this stratum reach it": with ``n`` good holdout documents of which ``k`` reach the
cutoff, ``P(Bin(n, risk) <= k) <= delta / (rules * strata)``.  Cutoffs of one rule are tested from the loosest to the
strictest and testing ends with the first that fails (fixed sequence), so they need no further correction; rules and
strata are corrected by Bonferroni.  The union over the rules loses at most ``rules * risk`` of the good documents of a
stratum, for all strata at once, with probability ``1 - delta``.  Among its certified cutoffs a rule takes the one that
separates good from bad best, the loosest of equals; a rule without a gain, or a stratum with too few labels, rejects
nothing.

All of it is DataFrame operations: no Python runs on the executors.

Defined cases: a null text has no words; a null stratum is a stratum of its own; documents without words fail the base
rules; repeated rows are repeated in the result, but a document counts once among the labelled; repeated labels are one
label and an id whose labels disagree has none; without labels only the base rules decide; a stratum without labels has no cutoffs and only the base rules decide; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_within
from ..session import materialise
from .common import kept_rows, text_key, text_of, words_of

#: name -> (numerator, denominator), both columns of ``measure``.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
    "exclamations": ("n_exclamations", "n_words"),
}
CUTOFFS = (900, 700, 500, 400, 300, 200, 150, 100, 70, 50, 30, 20)
_POS = (1 << 30) - 1


@dataclass(frozen=True)
class Risk:
    """False rejections allowed per rule, and the probability that any bound of the run is wrong."""

    risk: float = 0.01
    delta: float = 0.05


def _window(words: Column, i: Column) -> list[Column]:
    return [F.get(words, i + k) for k in range(3)]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with counts of the whole text.

    Repeated windows are found in three steps inside the row: windows sorted by 34 bits of their hash with the
    position below, neighbours of equal hash bits kept, and these few sorted by their words.  Hash bits only save
    work: two windows are equal when their words are.
    """
    keep = [c for c in docs.columns if c != text]
    body = text_of(text)
    a = docs.select(*keep, body.alias("_t"), words_of(body).alias("_w"))
    words = F.col("_w")
    lines = F.filter(F.split("_t", "\n", -1), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    a = a.select(
        *keep,
        "_t",
        "_w",
        F.size("_w").cast("long").alias("n_words"),
        lines.alias("_l"),
        F.sort_array(
            F.when(
                F.size("_w") >= 3,
                F.transform(
                    F.sequence(F.lit(0), F.greatest(F.size("_w") - 3, F.lit(0))),
                    lambda i: F.shiftleft(F.shiftright(F.xxhash64(*_window(words, i)), 30), 30).bitwiseOR(i.cast("long")),
                ),
            ).otherwise(F.array().cast("array<bigint>"))
        ).alias("_p"),
    )
    packed = F.col("_p")
    near = F.transform(
        F.filter(
            packed,
            lambda p, k: F.coalesce(F.shiftright(F.get(packed, k - 1), 30) == F.shiftright(p, 30), F.lit(False))
            | F.coalesce(F.shiftright(F.get(packed, k + 1), 30) == F.shiftright(p, 30), F.lit(False)),
        ),
        lambda p: p.bitwiseAND(F.lit(_POS)).cast("int"),
    )
    a = a.select(
        *keep,
        "n_words",
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("_t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").cast("long").alias("n_lines"),
        F.char_length(F.regexp_replace("_t", r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
        F.char_length(F.regexp_replace("_t", r"[^!]+", "")).cast("long").alias("n_exclamations"),
        F.sort_array(
            F.transform(near, lambda i: F.struct(F.concat_ws(" ", *_window(words, i)).alias("g"), i.alias("i")))
        ).alias("_e"),
    )
    exact = F.col("_e")
    found = F.filter(
        exact,
        lambda e, k: F.coalesce(F.get(exact, k - 1)["g"] == e["g"], F.lit(False))
        | F.coalesce(F.get(exact, k + 1)["g"] == e["g"], F.lit(False)),
    )
    a = a.withColumn("_s", F.sort_array(F.transform(found, lambda e: e["i"]))).drop("_e")
    starts = F.col("_s")
    covered = F.transform(starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3))))
    repeats = F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)
    return a.withColumn("n_repeat_words", repeats).drop("_s")


def base_failed(min_words: int = 50, max_repeats: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeats * F.col("n_words"))


def share(rule: str) -> Column:
    """Thousandths, rounded down; 0 without a denominator."""
    over, under = RULES[rule]
    return F.when(F.col(under) > 0, F.floor(1000 * F.col(over) / F.col(under))).otherwise(0).cast("long")


def allowed(n: Column, risk: float, log_level: Column) -> Column:
    """The most rejections among ``n`` good documents that certify a risk; -1 when not even none does.

    Walks the terms of the binomial distribution upwards, in logarithms, and counts those whose sum stays below the
    level.  Only the first ``risk * n`` terms can.
    """
    import math

    odds = math.log(risk) - math.log1p(-risk)
    none = n * F.lit(math.log1p(-risk))
    start = F.struct(none.alias("term"), none.alias("total"), F.lit(-1).alias("k"))

    def step(s: Column, j: Column) -> Column:
        term = F.when(j == 0, s["term"]).otherwise(s["term"] + F.log((n - j + 1) / j) + F.lit(odds))
        high, low = F.greatest(s["total"], term), F.least(s["total"], term)
        total = F.when(j == 0, term).otherwise(high + F.log1p(F.exp(low - high)))
        return F.struct(term.alias("term"), total.alias("total"), F.when(total <= log_level, j).otherwise(s["k"]).alias("k"))

    return F.aggregate(F.sequence(F.lit(0), F.floor(n * F.lit(risk)).cast("int")), start, step, lambda s: s["k"])


def certify(holdout: DataFrame, stratum: str, good: str, control: Risk = Risk()) -> DataFrame:
    """Cutoffs per stratum and rule, from measured and labelled documents: stratum, rule, cutoff."""
    import math

    cells = []
    for rule in RULES:
        for cutoff in CUTOFFS:
            cells.append(F.sum((F.col(rule) >= cutoff).cast("long")).alias(f"{rule}_{cutoff}"))
    shares = holdout.select(stratum, good, *[share(r).alias(r) for r in RULES])
    counts = shares.groupBy(stratum, good).agg(F.count(F.lit(1)).alias("n"), *cells)
    rows = counts.select(
        stratum,
        good,
        "n",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"{r}_{c}").alias("k"))
                    for r in RULES
                    for c in CUTOFFS
                ]
            )
        ).alias("x"),
    ).select(stratum, good, "n", "x.*")
    is_good = F.col(good) == 1
    pairs = rows.groupBy(stratum, "rule", "cutoff").agg(
        F.coalesce(F.sum(F.when(is_good, F.col("n"))), F.lit(0)).alias("n_good"),
        F.coalesce(F.sum(F.when(is_good, F.col("k"))), F.lit(0)).alias("k_good"),
        F.coalesce(F.sum(F.when(~is_good, F.col("n"))), F.lit(0)).alias("n_bad"),
        F.coalesce(F.sum(F.when(~is_good, F.col("k"))), F.lit(0)).alias("k_bad"),
    )
    strata = counts.select(stratum).distinct().agg(F.count(F.lit(1)).alias("strata"))
    tests = pairs.crossJoin(F.broadcast(strata))  # one row
    level = F.log(F.lit(control.delta) / (F.lit(len(RULES)) * F.col("strata")))
    sizes = tests.groupBy(stratum, "rule").agg(F.max("n_good").alias("n"), F.max("strata").alias("strata"))
    limits = sizes.select(
        stratum, "rule", F.when(F.col("n") > 0, allowed(F.col("n"), control.risk, level)).otherwise(-1).alias("most")
    )
    gain = F.col("k_bad") * F.col("n_good") - F.col("k_good") * F.col("n_bad")
    usable = tests.join(limits, [stratum, "rule"]).where((F.col("k_good") <= F.col("most")) & (F.col("n_bad") > 0) & (gain > 0))
    best = usable.groupBy(stratum, "rule").agg(F.max(F.struct(gain.cast("double"), "cutoff")).alias("b"))
    return best.select(stratum, "rule", F.col("b.cutoff").alias("cutoff"))


def verdict(measured: DataFrame, cutoffs: DataFrame, stratum: str) -> tuple[DataFrame, Column]:
    """``measured`` with its strata's cutoffs, one column per rule, and what is true where no certified rule rejects."""
    cells = [F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_cut_{r}") for r in RULES]
    wide = materialise(cutoffs.groupBy(stratum).agg(*cells), label="cutoffs")
    kept = F.lit(True)
    for r in RULES:
        kept = kept & ~F.coalesce(share(r) >= F.col(f"_cut_{r}"), F.lit(False))
    return measured.join(broadcast_within(wide), stratum, "left"), kept


def apply_rules(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    quality: str = "quality",
    control: Risk = Risk(),
) -> DataFrame:
    """One row per document: id, a key of the text, the counts, ``base_failed`` and ``kept``."""
    narrow = docs.select(
        F.col(id).alias("doc_id"),
        F.col(text).alias("_body"),
        F.concat(F.lit("="), F.coalesce(F.col(stratum).cast("string"), F.lit("\x00"))).alias("_stratum"),
        text_key(text).alias("text_key"),
    )
    measured = materialise(measure(narrow, "_body"), label="measured")
    known = labels.select(F.col(id).alias("doc_id"), F.col(quality).alias("_good")).where(F.col("_good").isNotNull())
    # The binomial bound needs independent documents: an id speaks once, and not at all where its labels disagree.
    agreed = known.groupBy("doc_id").agg(F.min("_good").alias("_good"), F.max("_good").alias("_high"))
    agreed = agreed.where(F.col("_good") == F.col("_high")).drop("_high")
    holdout = measured.where(~base_failed()).join(agreed, "doc_id").dropDuplicates(["doc_id", "text_key", "_stratum"])
    cutoffs = certify(holdout, "_stratum", "_good", control)
    judged, fine = verdict(measured, cutoffs, "_stratum")
    return judged.select(
        "doc_id",
        "text_key",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & fine).alias("kept"),
        "n_lines",
        "n_capitals",
        "n_exclamations",
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass, with all their columns; documents with a null id are judged as well."""
    verdicts = apply_rules(docs, labels, **options).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    return kept_rows(docs, verdicts, options.get("id", "doc_id"), options.get("text", "text"))
