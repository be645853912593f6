"""Quality rules: fixed base rules, then robust multivariate outliers.

A document's counts become five statistics (``VECTOR``). For each language and source the minimum covariance determinant
estimates where most documents lie: concentration steps keep the documents nearest to the last estimate and
estimate again, from two starts, of which the one with the smaller determinant counts. Documents far from
their group's estimate by Mahalanobis distance are rejected. Everything is column expressions; estimates
are tables of one row per group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterqa.llm.base import SPACE, written

#: Words that a document needs, and percent of words in repeated windows that it may have.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Documents that a group needs for an estimate of its own; smaller groups of a language are pooled, then all.
LEAST_GROUP = 200
#: Share of a group's documents that a concentration step keeps.
CORE = 0.75
#: The level of the estimate from all documents that pass the base rules.
EVERY = 3
STEPS = 3
VECTOR = ("_x0", "_x1", "_x2", "_x3", "_x4")
D = len(VECTOR)
#: Standard deviation added to each statistic's own; keeps estimates regular where most documents agree. Far enough below
#: 1 / sqrt(CUT) that each of the two share statistics can reject a document alone.
FLOORS = (0.1, 0.05, 0.05, 0.1, 0.1)
# Chi-squared quantiles with five degrees of freedom.
CHI2_HALF, CHI2_975, CHI2_9999 = 4.3515, 12.8325, 25.7448
#: Squared distance from which a document is rejected.
CUT = CHI2_9999


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )

    def twice(pairs: Column) -> Column:
        def at(pair: Column, i: Column) -> Column:
            same = [F.coalesce(F.get(pairs, i + step)["h"] == pair["h"], F.lit(False)) for step in (-1, 1)]
            return F.when(same[0] | same[1], pair["i"])

        return F.array_sort(F.array_compact(F.transform(pairs, at)))

    def covered(places: Column) -> Column:
        fresh = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(p - F.get(places, i - 1), F.lit(3))))
        return F.aggregate(fresh, F.lit(0), lambda total, n: total + n)

    def count(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        several = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(several, _let(_let(pairs, twice), covered)).otherwise(0)

    return F.when(F.size(words) < 4, 0).otherwise(_let(windows, count))


def text_counts(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (lines with a word)."""
    text = F.coalesce(text, F.lit(""))
    full_lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))

    def counts(words: Column) -> Column:
        return _let(
            full_lines,
            lambda lines: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
                F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                _repeated_words(words).cast("long").alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
            ),
        )

    return _let(F.array_remove(F.split(text, f"[{SPACE}]+"), ""), counts)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with the counts, base_failed and the statistics, all named with a leading underscore."""
    c = F.col("_counts")
    words, chars = F.greatest(c["n_words"], F.lit(1)), F.greatest(c["word_chars"], F.lit(1))
    failed = (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])
    vector = (
        F.log1p(c["n_words"].cast("double")),
        F.log(chars / words),
        F.sqrt(c["n_symbols"] / chars),
        F.sqrt(c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1))),
        F.sqrt(c["n_repeat_words"] / words),
    )
    counted = docs.withColumn("_counts", text_counts(F.col(text_col)))
    return counted.select(
        *docs.columns,
        F.col(lang_col).cast("string").alias("_lang"),
        F.col(source_col).cast("string").alias("_source"),
        *[c[n].alias(f"_{n}") for n in COUNTS],
        failed.alias("_failed"),
        *[x.alias(n) for x, n in zip(vector, VECTOR, strict=True)],
    )


def group_keys(rows: DataFrame, least: int = LEAST_GROUP) -> DataFrame:
    """(_key, _group): the estimate that serves each language and source; that of all documents where too few are left.

    Keys and groups are structs, in which nulls equal nulls.
    """
    sizes = rows.groupBy("_lang", "_source").agg(F.count_if(~F.col("_failed")).alias("n"))
    small = sizes.withColumn("s", F.when(F.col("n") < least, F.col("n")).otherwise(0))
    pooled = small.withColumn("in_lang", F.sum("s").over(W.partitionBy("_lang")))
    langs = pooled.groupBy("_lang").agg(F.first("in_lang").alias("n"))
    rest = langs.agg(F.coalesce(F.sum(F.when(F.col("n") < least, F.col("n"))), F.lit(0)).alias("rest"))
    level = (
        F.when(F.col("n") >= least, 0).when(F.col("in_lang") >= least, 1).when(F.col("rest") >= least, 2).otherwise(EVERY)
    )
    group = F.struct(
        level.alias("level"),
        F.when(level <= 1, F.col("_lang")).alias("lang"),
        F.when(level == 0, F.col("_source")).alias("source"),
    )
    # ``rest`` is a single row.
    return pooled.join(F.broadcast(rest)).select(
        F.struct("_lang", "_source").alias("_key"), group.alias("_group")
    )


def _estimates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Mean, covariance with floors, and what distances need, of the rows of each key.

    ``m``: mean; ``k``: inverse of the Cholesky factor, rows of the lower triangle; ``det``: determinant.
    """
    pairs = [(i, j) for i in range(D) for j in range(i + 1)]
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        *[F.avg(x).alias(f"_m{i}") for i, x in enumerate(VECTOR)],
        *[F.covar_pop(VECTOR[i], VECTOR[j]).alias(f"_c{i}{j}") for i, j in pairs],
    )
    return _factored(sums, keys, lambda i, j: F.col(f"_c{i}{j}") + (FLOORS[i] ** 2 if i == j else 0.0))


def _factored(df: DataFrame, keys: list[str], cov: Callable[[int, int], Column]) -> DataFrame:
    """Cholesky factor l and its inverse k, one column of the matrix after another."""
    kept = [*keys, "_n", *[f"_m{i}" for i in range(D)]]
    pairs = [(i, j) for i in range(D) for j in range(i + 1)]
    df = df.select(*kept, *[cov(i, j).alias(f"_v{i}{j}") for i, j in pairs])
    for j in range(D):
        inner = sum((F.col(f"_l{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        df = df.withColumn(f"_l{j}{j}", F.sqrt(F.greatest(F.col(f"_v{j}{j}") - inner, F.lit(1e-12))))
        below = {
            f"_l{i}{j}": (
                F.col(f"_v{i}{j}") - sum((F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}") for k in range(j)), F.lit(0.0))
            )
            / F.col(f"_l{j}{j}")
            for i in range(j + 1, D)
        }
        if below:
            df = df.withColumns(below)
    for i in range(D):
        df = df.withColumn(f"_k{i}{i}", 1 / F.col(f"_l{i}{i}"))
        row = {
            f"_k{i}{j}": -sum((F.col(f"_l{i}{k}") * F.col(f"_k{k}{j}") for k in range(j, i)), F.lit(0.0))
            / F.col(f"_l{i}{i}")
            for j in range(i)
        }
        if row:
            df = df.withColumns(row)
    logs = sum((2 * F.log(F.col(f"_l{i}{i}")) for i in range(D)), F.lit(0.0))
    return df.select(
        *keys,
        "_n",
        F.array(*[F.col(f"_m{i}") for i in range(D)]).alias("m"),
        F.array(*[F.col(f"_k{i}{j}") for i, j in pairs]).alias("k"),
        logs.alias("log_det"),
    )


def _distance() -> Column:
    """Squared Mahalanobis distance of a row's statistics from the estimate joined to it."""
    total, at = F.lit(0.0), 0
    for i in range(D):
        z = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.get("k", F.lit(at)) * (F.col(VECTOR[j]) - F.get("m", F.lit(j)))
            at += 1
        total = total + z * z
    return total


def estimates(rows: DataFrame) -> DataFrame:
    """(_group, m, k): the reweighted minimum covariance determinant estimate of each group of ``rows``."""
    rows = rows.select("_group", *VECTOR)
    spread = [F.greatest(F.expr(f"percentile_approx(abs({x} - _med[{i}]), 0.5, 10000)") * 1.4826, F.lit(FLOORS[i])) for i, x in enumerate(VECTOR)]
    medians = rows.groupBy("_group").agg(
        F.array(*[F.percentile_approx(x, 0.5, 10000) for x in VECTOR]).alias("_med")
    )
    robust = (
        rows.join(medians, "_group")
        .groupBy("_group")
        .agg(
            F.count("*").alias("_n"),
            *[F.first(F.get("_med", F.lit(i))).alias(f"_m{i}") for i in range(D)],
            *[s.alias(f"_s{i}") for i, s in enumerate(spread)],
        )
    )
    diagonal = _factored(robust, ["_group"], lambda i, j: F.col(f"_s{i}") ** 2 if i == j else F.lit(0.0))
    plain = _estimates(rows, ["_group"])
    now = written(
        diagonal.withColumn("_start", F.lit(0)).unionByName(plain.withColumn("_start", F.lit(1)))
    )
    keys = ["_group", "_start"]
    for _ in range(STEPS):
        far = rows.join(now.select(*keys, "m", "k"), "_group").select(*keys, *VECTOR, _distance().alias("_d"))
        edge = far.groupBy(*keys).agg(F.percentile_approx("_d", CORE, 10000).alias("_edge"))
        core = far.join(edge.select(F.struct(*keys).alias("_k"), "_edge"), F.struct(*keys) == F.col("_k"))
        now = written(_estimates(core.filter(F.col("_d") <= F.col("_edge")), keys))
    best = now.groupBy("_group").agg(F.min_by(F.struct("m", "k"), F.struct("log_det", "_start")).alias("e"))
    best = best.select("_group", "e.m", "e.k")
    far = rows.join(best, "_group").select("_group", *VECTOR, _distance().alias("_d"))
    scale = far.groupBy("_group").agg((F.percentile_approx("_d", 0.5, 10000) / CHI2_HALF).alias("_scale"))
    near = far.join(scale, "_group").filter(F.col("_d") <= CHI2_975 * F.greatest("_scale", F.lit(1e-9)))
    return written(_estimates(near, ["_group"]).select("_group", "m", "k"))


def judged(docs: DataFrame, stats: DataFrame, least: int = LEAST_GROUP) -> DataFrame:
    """``docs`` (rows of ``statistics``) with _distance2 and _kept, by estimates from the ``stats`` of all documents."""
    keys = written(group_keys(stats, least))
    usable = stats.filter(~F.col("_failed"))
    grouped = usable.withColumn("_key", F.struct("_lang", "_source")).join(keys.filter(F.col("_group.level") < EVERY), "_key")
    # One row, if any group falls back on all documents.
    every = keys.select("_group").filter(F.col("_group.level") == EVERY).distinct().withColumn("_level", F.lit(EVERY))
    everywhere = usable.withColumn("_level", F.lit(EVERY)).join(F.broadcast(every), "_level")
    found = estimates(grouped.select("_group", *VECTOR).unionByName(everywhere.select("_group", *VECTOR)))
    verdicts = written(keys.join(found, "_group", "left").select("_key", "m", "k"))
    met = docs.withColumn("_key", F.struct("_lang", "_source")).join(verdicts, "_key", "left")
    distance = F.when(F.col("m").isNotNull(), _distance())
    return met.withColumn("_distance2", distance).withColumn(
        "_kept", ~F.col("_failed") & (F.coalesce(F.col("_distance2"), F.lit(0.0)) <= CUT)
    )


def quality_verdicts(docs: DataFrame, least: int = LEAST_GROUP) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, kept, distance2.

    A null text has no words and fails the base rules. Null languages and sources are groups like others. Where a group, pooled
    as far as possible, has fewer than ``least`` documents that pass the base rules, it is judged by the estimate from all
    such documents of the table, however few; the floors keep that regular. distance2 is null where none passes. Repeated rows are separate documents. An empty table
    gives an empty result.
    """
    stats = written(statistics(docs.select("doc_id", "text", "lang", "source")).drop("text", "lang", "source"))
    return judged(stats, stats, least).select(
        "doc_id",
        *[F.col(f"_{n}").alias(n) for n in COUNTS],
        F.col("_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
        F.col("_distance2").alias("distance2"),
    )


def passing(docs: DataFrame, least: int = LEAST_GROUP) -> DataFrame:
    """The documents that pass, in their own columns; texts are not shuffled unless the estimates are many."""
    slim = docs.select(F.col("text").alias("_text"), F.col("lang").alias("_l"), F.col("source").alias("_s"))
    stats = written(statistics(slim, "_l", "_s", "_text").drop("_text", "_l", "_s"))
    packed = docs.select(
        F.struct(*docs.columns).alias("_row"),
        F.col("text").alias("_text"),
        F.col("lang").alias("_l"),
        F.col("source").alias("_s"),
    )
    full = judged(statistics(packed, "_l", "_s", "_text"), stats, least).filter("_kept")
    return full.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
