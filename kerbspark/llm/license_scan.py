"""License notices by diagonal voting.

All rolling word k-grams of a document are joined to the k-grams of license
templates. A match at document word d and template word t votes for the
diagonal d - t; neighbouring diagonals of one template are merged, as a word
more or less in the copy moves the rest by one. A vote counts only if its words
are the template's words, and a span is reported when the words so matched
cover enough of the template, unless most of it lies in a span that matches
more words. Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .license_texts import TEMPLATES

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: Phrases whose every place counts, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def words_of(text: Column) -> Column:
    """Words of letters, digits and all characters beyond ASCII, in lower case.

    Lowering what lies beyond ASCII too moves no word's edge, and makes no word of a phrase.
    """
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def runs_of(words: Column, k: int) -> Column:
    """All runs of ``k`` words, structs of words; empty for fewer words."""
    n = F.greatest(F.size(words) - (k - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(words, i + 1, n).alias(f"w{i}") for i in range(k)])


def phrase_places(words: Column, phrase: str) -> Column:
    """Word numbers, from 0, at which the words of ``phrase`` stand one after another."""
    parts = phrase.split(" ")
    at = lambda i: [F.get(words, i + j) == p for j, p in enumerate(parts)]

    def fits(i: Column) -> Column:
        out = at(i)[0]
        for x in at(i)[1:]:
            out = out & x
        return F.coalesce(out, F.lit(False))

    return F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), fits)


def template_grams(spark: SparkSession, templates: Mapping[str, Mapping[str, str]], k: int) -> DataFrame:
    """(label, template, size, t, run, gram): the runs of ``k`` words of each template of ``size`` words, and their hashes.

    The templates are a parameter and their words bound its size.
    """
    rows = [(label, name, text) for label, named in templates.items() for name, text in named.items()]
    df = spark.createDataFrame(rows, "label string, template string, text string").withColumn("w", words_of(F.col("text")))
    df = df.select("label", "template", F.size("w").alias("size"), F.posexplode(runs_of(F.col("w"), k)).alias("t", "run"))
    return df.withColumn("gram", F.xxhash64("run"))


def scan(docs: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), templates: Mapping[str, Mapping[str, str]] = TEMPLATES, k: int = 3, drift: int = 4, cover: float = 0.8) -> DataFrame:
    """One row for each row of ``docs``: the ``keep`` columns and what its whole text holds.

    ``n_words``; of PHRASES: ``n_base``, ``first_word``, ``last_word`` (null
    without one), ``base_labels``; ``spans``: (label, template, first word, last
    word, score) of the templates found, where score is the share of the
    template's words that the span matches in runs of ``k``, at least ``cover``;
    ``labels``: both kinds; ``score``: the best span's, or the share that
    PHRASES alone earn, 1/2; else 0. Lists of labels are distinct, sorted and
    comma-joined.

    Diagonals at most ``drift`` apart belong to one span. Votes, not texts,
    are shuffled, and a document's votes are summed for each diagonal before.

    Cases: a null or empty text has no words and no labels; repeated rows are
    each scanned; an empty table gives an empty table; texts shorter than ``k``
    words have only base labels; ``keep`` columns may have any names, but not
    those of the results.
    """
    spark = docs.sparkSession
    grams = template_grams(spark, templates, k)

    def labelled(phrase: str, label: str) -> Column:
        return F.transform(phrase_places(F.col("w"), phrase), lambda i: F.struct(i.alias("i"), F.lit(label).alias("label")))

    df = docs.select(F.struct(*keep).alias("row"), F.monotonically_increasing_id().alias("rid"), words_of(F.col(text)).alias("w"))
    some = F.array_contains("w", "license")  # the last word of every phrase
    places = F.when(some, F.array_sort(F.concat(*[labelled(p, name) for p, name in PHRASES.items()])))
    df = df.withColumn("places", places).withColumn("g", runs_of(F.col("w"), k))
    base = F.struct(
        "row",
        F.size("w").cast("long").alias("n_words"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_base"),
        F.when(F.size("places") > 0, F.get("places", F.lit(0))["i"]).cast("long").alias("first_word"),
        F.when(F.size("places") > 0, F.element_at("places", -1)["i"]).cast("long").alias("last_word"),
        F.coalesce(F.array_sort(F.array_distinct(F.transform("places", lambda x: x["label"]))), F.array().cast("array<string>")).alias("base_labels"),
    )
    # the null in front stands for the document itself
    itself = F.array(F.lit(None).cast(grams.schema["run"].dataType))
    rolled = df.select("rid", base.alias("base"), "g").select("rid", "base", F.posexplode(F.concat(itself, "g")).alias("d", "words"))
    rolled = rolled.select("rid", F.when(F.col("d") == 0, F.col("base")).alias("base"), (F.col("d") - 1).alias("d"), "words", F.xxhash64("words").alias("gram"))
    same = rolled["gram"] == grams["gram"]
    for i in range(k):
        same = same & (F.col("words")[f"w{i}"] == F.col("run")[f"w{i}"])
    votes = rolled.join(F.broadcast(grams), same, "left").where(F.col("base").isNotNull() | F.col("template").isNotNull())
    per = votes.groupBy("rid", "label", "template", "size", (F.col("d") - F.col("t")).alias("diagonal")).agg(F.first("base", ignorenulls=True).alias("base"), F.collect_set("t").alias("ts"), F.min("d").alias("first"), F.max("d").alias("last"))
    near = Window.partitionBy("rid", "template").orderBy("diagonal")
    # a new span begins where the diagonal jumps
    per = per.withColumn("begins", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(near) > drift).cast("int"), F.lit(0)))
    per = per.withColumn("span", F.sum("begins").over(near))
    spans = per.groupBy("rid", "label", "template", "size", "span").agg(F.first("base", ignorenulls=True).alias("base"), F.array_distinct(F.flatten(F.collect_list("ts"))).alias("ts"), F.min("first").alias("first"), F.max("last").alias("last"))
    # verify: the words matched must be enough of the template, and the span not stretched over much else
    matched = F.array_distinct(F.flatten(F.transform("ts", lambda t: F.sequence(t, t + (k - 1)))))
    score = F.size(matched) / F.col("size")
    good = (score >= cover) & (F.col("last") + k - F.col("first") <= 2 * F.col("size") + drift)
    one = F.when(good, F.struct("label", "template", F.col("first").cast("long").alias("first_word"), (F.col("last") + k - 1).cast("long").alias("last_word"), score.alias("score"), F.size(matched).alias("matched")))
    out = spans.groupBy("rid").agg(F.first("base", ignorenulls=True).alias("base"), F.sort_array(F.collect_list(one)).alias("all"))

    def better(o: Column, s: Column) -> Column:
        common = F.least(o["last_word"], s["last_word"]) - F.greatest(o["first_word"], s["first_word"]) + 1
        return (o["matched"] > s["matched"]) & (2 * common > s["last_word"] - s["first_word"] + 1)

    best_of = F.filter("all", lambda s: ~F.exists("all", lambda o: better(o, s)))
    out = out.withColumn("spans", F.transform(best_of, lambda s: s.dropFields("matched")))
    labels = F.array_sort(F.array_distinct(F.concat("base.base_labels", F.transform("spans", lambda s: s["label"]))))
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.when(F.col("base.n_base") > 0, F.lit(0.5)).otherwise(F.lit(0.0)))
    return out.select("base.row.*", "base.n_words", "base.n_base", "base.first_word", "base.last_word", F.array_join("base.base_labels", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), F.least(best, F.lit(1.0)).alias("score"), "spans")
