"""Classification by rules that are rows of a table, many thousands of them.

A rule has words, any of which the lower-cased name must contain. Each word is filed under its
rarest gram: the three letters in a row (or the whole word, if it is shorter) that fewest of the
given names have. A name's grams fetch the words that it may contain, only those are tested, and
the rule of highest order wins. Rules without words are filed under their level instead.

Names are reduced to distinct ones first, so a name that makes up a third of all rows is looked up
once. Joins carry no hints: Spark broadcasts the rules only if their measured size is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.config.classes import ClassRule
from shelfwatch.session import stored

GRAM = 3
RULE = "ordinal int, label string, words array<string>, without array<string>, taxo2 string, taxo3 array<string>, taxo3_not string"
KEY = ("_name", "_taxo2", "_taxo3")


def rule_table(spark: SparkSession, rules: Sequence[ClassRule]) -> DataFrame:
    """Rules of the configuration as rows; later ones have a higher ordinal."""
    rows = [(i, r.label, list(r.words), list(r.without), r.taxo2, list(r.taxo3), r.taxo3_not) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, RULE)


def grams(text: Column, sizes: Sequence[int]) -> Column:
    """Distinct runs of letters of these lengths."""

    def runs(n: int) -> Column:
        found = F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substr(text, i, F.lit(n)))
        return F.when(F.length(text) >= n, found).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*map(runs, sizes)))


def classify_by_table(
    df: DataFrame, rules: DataFrame, name: str = "name", taxo2: str = "taxo2", taxo3: str = "taxo3", out: str = "label"
) -> DataFrame:
    """``df`` with the label of the rule of highest ordinal that holds, '' if none does.

    ``rules`` has the columns of ``RULE``. All conditions of a rule must hold: one of ``words`` in
    the lower-cased name, none of ``without`` (both compared in lower case), ``taxo2`` equal, ``taxo3``
    one of the list, ``taxo3_not`` different (or null in the row). Null or empty conditions hold
    always, a null name or level meets none but ``taxo3_not``. Equal ordinals go by label.
    """
    keyed = df.withColumns({"_name": F.lower(F.col(name)), "_taxo2": F.col(taxo2), "_taxo3": F.col(taxo3)})
    texts = stored(keyed.select(*KEY).distinct().withColumn("_row", F.xxhash64(*KEY)), "names")
    words = rules.withColumn("_word", F.explode(F.array_distinct(F.transform("words", F.lower)))).where("_word <> ''")
    found = texts.select("_name").where("_name is not null").distinct()
    spread = found.select("_name", F.explode(grams(F.col("_name"), range(1, GRAM + 1))).alias("_gram"))
    # how many names have each gram that a word could be filed under
    wanted = words.select("_word").distinct().select(
        "_word", F.explode(F.when(F.length("_word") < GRAM, F.array("_word")).otherwise(grams(F.col("_word"), [GRAM]))).alias("_gram")
    )
    used = spread.join(wanted.select("_gram").distinct(), "_gram", "left_semi")
    counts = used.groupBy("_gram").agg(F.count(F.lit(1)).alias("_names"))
    filed = (
        wanted.join(counts, "_gram", "left")
        .groupBy("_word")
        .agg(F.min(F.struct(F.coalesce("_names", F.lit(0)).alias("names"), F.col("_gram").alias("gram"))).alias("_least"))
        .select("_word", F.col("_least.gram").alias("_gram"))
    )
    hits = spread.join(filed, "_gram").where(F.contains("_name", F.col("_word"))).select("_name", "_word")
    conditions = words.select("_word", *[c for c in rules.columns if c != "words"])
    by_word = texts.join(hits, "_name").join(conditions, "_word")
    # rules without words: by the level they name, or for all rows if they name none
    bare = rules.where(F.size(F.coalesce("words", F.array().cast("array<string>"))) == 0).drop("words")
    by_level2 = texts.join(bare.where("taxo2 is not null"), F.col("_taxo2") == F.col("taxo2"))
    listed = bare.where("taxo2 is null and size(coalesce(taxo3, array())) > 0").withColumn("_level", F.explode("taxo3"))
    by_level3 = texts.join(listed, F.col("_taxo3") == F.col("_level")).drop("_level")
    columns = ["_row", *KEY, *bare.columns]
    candidates = by_word.select(*columns).unionByName(by_level2.select(*columns)).unionByName(by_level3.select(*columns))
    holds = (
        "not exists(coalesce(without, array()), w -> contains(coalesce(_name, ''), lower(w)))"
        " and (taxo2 is null or taxo2 <=> _taxo2) and (size(coalesce(taxo3, array())) = 0 or array_contains(taxo3, coalesce(_taxo3, '')) and _taxo3 is not null)"
        " and (taxo3_not is null or not taxo3_not <=> _taxo3)"
    )
    best = candidates.where(holds).groupBy("_row", *KEY).agg(F.max(F.struct("ordinal", "label")).alias("_best"))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"b.{c}")) for c in KEY]
    joined = keyed.alias("d").join(best.alias("b"), same, "left")
    return joined.select(*[F.col(f"d.{c}").alias(c) for c in df.columns], F.coalesce("b._best.label", F.lit("")).alias(out))
