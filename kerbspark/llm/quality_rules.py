"""Quality rules whose cutoffs carry a risk guarantee.

Each rule is a number of a document and the direction in which it is bad. A
labelled holdout gives, for each stratum, rule and cutoff of a fixed grid, how
many good documents the cutoff would reject. A cutoff may be used if the exact
binomial test shows that it rejects less than its share of ``risk`` of the
stratum's good documents. The tests of a stratum and rule run in a fixed
sequence, and their level is divided by the number of strata and rules
(Bonferroni), so all cutoffs in use hold at once with probability 1 -
``delta``. Everything is DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: The inside of regular-expression classes.
SPACE = "\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"
#: What :func:`features` adds.
FEATURES = ["n_words", "word_chars", "n_symbols", "n_marks", "n_upper", "n_distinct_words", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed"]
#: Strata whose cutoffs go to every task, at most: some 10 MB.
BROADCAST_STRATA = 65_536


@dataclass(frozen=True)
class Rule:
    """``value`` names a feature; documents with a value above the cutoff are rejected."""

    name: str
    value: Column
    cutoffs: Sequence[float]


def _per(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def default_rules() -> list[Rule]:
    """Shares that junk drives up; the grids are fixed before any label is seen."""
    shares = [i / 50 for i in range(1, 50)]
    return [
        Rule("symbols_per_word", _per(F.col("n_symbols"), F.col("n_words")), [i / 20 for i in range(1, 60)]),
        Rule("marks_per_word", _per(F.col("n_marks"), F.col("n_words")), [i / 20 for i in range(1, 60)]),
        Rule("repeated_words", _per(F.col("n_repeat_words"), F.col("n_words")), shares),
        Rule("repeated_lines", _per(F.col("n_dup_lines"), F.col("n_lines")), shares),
        Rule("capital_letters", _per(F.col("n_upper"), F.col("word_chars")), shares),
        Rule("same_words", 1 - _per(F.col("n_distinct_words"), F.col("n_words")), shares),
    ]


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules use, in one pass without a shuffle.

    Windows of three words are compared by their 64-bit hashes. A null text
    counts as an empty one, which has no words, lines or characters. Columns
    named like an added one are replaced, and others may have any name.
    """
    only = lambda kept: F.char_length(F.regexp_replace("t", f"[^{kept}]+", "")).cast("long")
    # the row is one column, so that its columns may have any names
    df = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    df = df.withColumn("w", F.array_remove(F.split("t", f"[{SPACE}]+"), ""))
    run = lambda start: F.slice("w", start, F.size("w") - 2)
    df = df.withColumns(
        {
            "n_words": F.size("w").cast("long"),
            "word_chars": F.char_length(F.array_join("w", "")).cast("long"),
            "n_symbols": only(SYMBOLS),
            "n_marks": only("!?"),
            "n_upper": only("\\p{Lu}"),
            "n_distinct_words": F.size(F.array_distinct("w")).cast("long"),
            "lines": F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{SPACE}]")),
            "h": F.when(F.size("w") >= 3, F.transform(F.arrays_zip(run(1), run(2), run(3)), lambda w: F.xxhash64(w))).otherwise(F.array().cast("array<bigint>")),
        }
    )
    df = df.withColumns(
        {
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "s": F.when(
                F.size("h") > F.size(F.array_distinct("h")),
                F.sort_array(F.arrays_zip(F.col("h").alias("h"), F.sequence(F.lit(0), F.size("h") - 1).alias("p"))),
            ),
        }
    )
    # neighbours in the sorted list with one hash are the windows found more than once
    pairs = F.zip_with(F.slice("s", 1, F.size("s") - 1), F.slice("s", 2, F.size("s") - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])))
    df = df.withColumn("p", F.when(F.col("s").isNotNull(), F.flatten(F.array_compact(pairs))))
    covered = F.array_distinct(F.concat("p", F.transform("p", lambda p: p + 1), F.transform("p", lambda p: p + 2)))
    df = df.withColumn("n_repeat_words", F.when(F.col("p").isNotNull(), F.size(covered)).otherwise(0).cast("long"))
    df = df.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return df.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in FEATURES], *FEATURES)


def most_rejected(n: Column, risk: float, level: float) -> Column:
    """The largest k with P(Binomial(n, risk) <= k) <= level, or -1: the exact one-sided test of a rate below ``risk``.

    The terms are summed in logarithms, as (1 - risk)^n underflows for large n.
    """
    log_odds, none = math.log(risk) - math.log1p(-risk), F.lit(-1.0e308)
    start = F.struct((n * math.log1p(-risk)).cast("double").alias("term"), none.alias("total"), F.lit(-1).cast("long").alias("k"))

    def step(s: Column, i: Column) -> Column:
        top, low = F.greatest(s["term"], s["total"]), F.least(s["term"], s["total"])
        total = top + F.log1p(F.exp(low - top))
        term = s["term"] + F.log((n - i).cast("double")) - F.log((i + 1).cast("double")) + log_odds
        fine = (total <= math.log(level)) & (s["k"] == i - 1)
        return F.struct(F.when(i < n, term).otherwise(none).alias("term"), total.alias("total"), F.when(fine, i).otherwise(s["k"]).alias("k"))

    steps = F.sequence(F.lit(0).cast("long"), F.floor(n * risk).cast("long"))
    return F.aggregate(steps, start, step, lambda s: s["k"])


def _named(stratum: str) -> Column:
    """"=" and the value, or "" for a null one."""
    return F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit(""))


def fit_cutoffs(scored: DataFrame, labels: DataFrame, rules: Sequence[Rule], *, key: str = "doc_id", stratum: str = "lang", risk: float = 0.03, delta: float = 0.05, price: int = 50) -> DataFrame:
    """The cutoffs in use: (stratum, rule, cutoff, n_good, n_rejected, n_allowed), at most a row for each stratum and rule.

    Every stratum with good labelled rows is tested for cutoffs of its own and
    named "=" and its value; rows with a null stratum are one, named "". "*" is
    fitted on all labelled rows for comparison; no document is judged by it.
    Cutoffs of a rule are tested from the mildest to the strictest
    up to the first that fails, which needs no correction among them; the level
    is ``delta`` over the number of strata and rules. Of the cutoffs that pass,
    the one that rejects most bad labelled rows is used, a good one counting as
    ``price`` bad ones, and of equals the mildest. ``labels`` has (key,
    quality): 1 is good, 0 bad, others play no part; a document with several
    labels counts once, as good if any is. Strata with too few good rows for
    any cutoff are left out, so no fitted rule rejects their documents.
    """
    marked = labels.where(F.col(key).isNotNull() & F.col("quality").isin(0, 1)).groupBy(F.col(key).alias("__key")).agg((F.max("quality") == 1).alias("good"))

    def above(rule: Rule) -> Column:
        return F.size(F.filter(F.array(*[F.lit(float(c)) for c in rule.cutoffs]), lambda c: c < rule.value))

    passed = F.array(*map(above, rules))
    held = scored.select(F.col(key).alias("__key"), _named(stratum).alias("stratum"), passed.alias("__passed"))
    held = held.join(marked, "__key")
    both = held.select("good", F.explode(F.array("stratum", F.lit("*"))).alias("stratum"), "__passed")
    both = both.select("good", "stratum", F.posexplode("__passed").alias("rule_no", "above"))
    counted = both.groupBy("stratum", "rule_no", "above").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    per = counted.groupBy("stratum", "rule_no").agg(F.sum("good").alias("n_good"), F.collect_list(F.struct("above", "good", "bad")).alias("hist"))
    per = cut(per.where("n_good > 0"))
    strata = per.where("stratum != '*' AND rule_no = 0").count()
    level = delta / (max(strata, 1) * len(rules))
    per = per.withColumn("n_allowed", most_rejected(F.col("n_good"), risk / len(rules), level)).where(F.col("n_allowed") >= 0)
    grid = F.array(*[F.struct(F.lit(i).alias("rule_no"), F.lit(j).alias("cutoff_no"), F.lit(r.name).alias("rule"), F.lit(float(c)).alias("cutoff")) for i, r in enumerate(rules) for j, c in enumerate(r.cutoffs)])
    per = per.select("stratum", "n_good", "n_allowed", "hist", F.explode(F.filter(grid, lambda g: g["rule_no"] == F.col("rule_no"))).alias("g"))

    def beyond(what: str) -> Column:
        return F.aggregate("hist", F.lit(0).cast("long"), lambda acc, x: acc + F.when(x["above"] > F.col("g.cutoff_no"), x[what]).otherwise(0))

    per = per.select("stratum", "g.rule", F.col("g.cutoff").alias("cutoff"), "n_good", beyond("good").alias("n_rejected"), beyond("bad").alias("n_bad"), "n_allowed")
    gain = F.col("n_bad") - price * F.col("n_rejected")
    best = F.max(F.when((F.col("n_rejected") <= F.col("n_allowed")) & (gain > 0), F.struct(gain.alias("gain"), "cutoff", "n_rejected")))
    return per.groupBy("stratum", "rule", "n_good", "n_allowed").agg(best.alias("best")).select("stratum", "rule", "best.cutoff", "n_good", "best.n_rejected", "n_allowed")


def verdict(scored: DataFrame, cutoffs: DataFrame, rules: Sequence[Rule], *, stratum: str = "lang") -> DataFrame:
    """``scored`` with ``failed_rules`` and ``kept``; each row takes its own stratum's cutoffs, one row of them for each stratum.

    These are sent to every task up to BROADCAST_STRATA strata, and joined by stratum beyond.
    """
    found = F.map_from_entries(F.collect_list(F.when(F.col("cutoff").isNotNull(), F.struct("rule", "cutoff"))))
    own = cut(cutoffs.where("stratum != '*'").groupBy("stratum").agg(found.alias("cutoffs")))
    few = own.count() <= BROADCAST_STRATA
    # the row is one column, so that its columns may have any names
    rows = scored.select(F.struct(*scored.columns).alias("row"), _named(stratum).alias("stratum"), F.array(*[r.value.cast("double") for r in rules]).alias("values"))
    judged = rows.join(F.broadcast(own) if few else own, "stratum", "left")
    over = [F.when(F.col("values")[i] > F.col("cutoffs")[r.name], F.lit(r.name)) for i, r in enumerate(rules)]
    judged = judged.select("row", F.array_compact(F.array(*over)).alias("failed_rules"))
    kept = ~F.col("row")["base_failed"] & (F.size("failed_rules") == 0)
    return judged.select(*[F.col("row")[c].alias(c) for c in scored.columns if c not in ("failed_rules", "kept")], "failed_rules", kept.alias("kept"))


def judge(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", stratum: str = "lang", risk: float = 0.03, delta: float = 0.05, keep_text: bool = False) -> DataFrame:
    """``docs`` with the counts of :func:`features`, ``failed_rules`` and ``kept``.

    With probability 1 - ``delta`` over the labels, less than ``risk`` of the
    good documents of any stratum are rejected by the fitted rules together;
    each rule has an equal share of that. Base failures are rejected besides.
    The counts go to reliable storage for the fit. Without ``keep_text`` the
    verdict uses them too; with it they are made again beside the texts, so
    that texts are neither shuffled nor stored.

    Cases: a null or empty text has no words and fails the base rule; rows
    with a null stratum are a stratum; where a stratum has not enough labels,
    or none, no cutoff is allowed in it, whatever the others have, and the
    base rule alone decides; rows may repeat, each is judged alone; a
    null key is judged but takes no part in the fit; input columns named like a
    computed one are replaced; an empty table gives an empty table.
    """
    rules = default_rules()
    scored = cut(features(docs, text).drop(text))
    cutoffs = fit_cutoffs(scored, labels, rules, key=key, stratum=stratum, risk=risk, delta=delta)
    return verdict(features(docs, text) if keep_text else scored, cutoffs, rules, stratum=stratum)


def keep(judged: DataFrame) -> DataFrame:
    """The kept rows. The number of a row is part of the condition, so the optimizer leaves the filter above the
    columns it reads, which are then made once for each row and not once for each mention."""
    return judged.withColumn("__row", F.monotonically_increasing_id()).where(F.col("kept") & (F.col("__row") >= 0)).drop("__row")
