"""Benchmark passages in training texts, by a positional inverted index.

The index holds the postings (term, row, place) of all training tokens whose term some benchmark item has; lists of other terms
are never asked for. It is written once, with one more posting per row that carries its id and number of words. A window of
item words is sought from its two rarest terms, by their counts in the index: the lists are adjusted by the terms' offsets and
intersected, by joins on row and place, so a frequent term's list is spread over all tasks. What is left, alignments of an item
with a row, is intersected with the lists of the item's other terms. All steps are joins and aggregates that grow with the lists
read; no list is gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterqa.llm.base import written

WINDOW = 10
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text in order, A-Z as a-z; null has none."""
    text = F.coalesce(text, F.lit(""))
    # Only A-Z change; in a text of one-byte characters that is what lower() does.
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, _SEPARATORS), "")


def item_terms(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, id, term, offset, length): the words of the items; a row without words has none, and equal texts of an id are one item."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), words(F.col(text_col)).alias("words"))
    items = items.filter(F.size("words") > 0).distinct()
    named = items.select(F.sha2(F.concat_ws(" ", F.size("words").cast("string"), "words", "id"), 256).alias("item"), "id", "words")
    return named.select("item", "id", F.size("words").alias("length"), F.posexplode("words").alias("offset", "term"))


def index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (row, place, term) of the training texts, places from 1, for the ``terms`` given; to be written.

    Place 0 of each row holds no term but the row's id and its number of words.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), words(F.col(text_col)).alias("words")
    )
    counted = F.size("words").cast("string")
    tokens = rows.select("row", "id", F.posexplode(F.concat(F.array(counted), "words")).alias("place", "token"))
    wanted = terms.select("term").distinct().select("term", F.col("term").alias("token"))
    met = tokens.join(wanted, (tokens["token"] == wanted["token"]) & (F.col("place") > 0), "left").drop(wanted["token"])
    head = F.col("place") == 0
    return met.filter(head | F.col("term").isNotNull()).select(
        "row",
        "place",
        "term",
        F.when(head, F.col("id")).alias("id"),
        F.when(head, F.col("token")).cast("long").alias("n_words"),
    )


def seeds(terms: DataFrame, postings: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, term, offset, second, ahead): a window's rarest term, and its second rarest so many words ahead or, below 0, behind.

    Windows that share both come once; a window with a term that the index lacks is left out, one of a single word has no second.
    """
    counts = postings.filter("place > 0").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counted = terms.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    first = F.greatest(F.lit(0), F.col("offset") - (window - 1))
    last = F.greatest(F.lit(0), F.least(F.col("offset"), F.col("length") - window))
    spread = counted.withColumn("start", F.explode(F.sequence(first, last)))
    ranked = spread.groupBy("item", "start").agg(F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("by"))
    one, two = F.col("by")[0], F.get("by", F.lit(1))
    return (
        ranked.filter(one["n"] > 0)
        .select(
            "item",
            one["term"].alias("term"),
            one["offset"].alias("offset"),
            two["term"].alias("second"),
            (two["offset"] - one["offset"]).alias("ahead"),
        )
        .distinct()
    )


def _near(slack: int) -> Column:
    return F.explode(F.array(*[F.lit(d) for d in range(-slack, slack + 1)]))


def alignments(postings: DataFrame, found: DataFrame, slack: int = 0) -> DataFrame:
    """(item, row, shift, offset) where a seed's rarest term lies at place shift + offset and its second within ``slack`` of its place."""
    lists = postings.filter("place > 0").select("row", "place", "term")
    starts = lists.join(found, "term").select(
        "item", "row", (F.col("place") - F.col("offset")).alias("shift"), "offset", "second", (F.col("place") + F.col("ahead")).alias("at")
    )
    alone = starts.filter("second is null").select("item", "row", "shift", "offset")
    seconds = lists.join(found.select(F.col("second").alias("term")).distinct(), "term", "left_semi")
    wide = starts.filter("second is not null").withColumn("off", _near(slack)).withColumnRenamed("second", "term")
    both = wide.withColumn("place", F.col("at") + F.col("off")).join(seconds, ["row", "place", "term"]).select("item", "row", "shift", "offset")
    return alone.union(both).distinct()


def matches(postings: DataFrame, terms: DataFrame, window: int = WINDOW, slack: int = 0) -> DataFrame:
    """(item, id, row, shift, first, last, exact): item words ``first`` to ``last`` found in a row, the word i at place shift + i.

    Runs are as long as can be and at least ``window`` words, or a shorter item whole. With ``slack`` 0 they are exact phrases. Else
    a word may lie up to ``slack`` places off, but a rarest term of the run's windows lies exactly in its place; ``exact`` tells
    the phrases among these.
    """
    found = written(alignments(postings, written(seeds(terms, postings, window)), slack))
    rows = found.select("row").distinct()
    lists = postings.filter("place > 0").join(rows, "row", "left_semi").select("row", "place", "term")
    pairs = found.select("item", "row", "shift").distinct().join(terms, "item")
    wanted = pairs.withColumn("off", _near(slack)).withColumn("place", F.col("shift") + F.col("offset") + F.col("off"))
    met = wanted.join(lists, ["row", "place", "term"])
    key = ["item", "row", "shift"]
    if slack:
        met = met.groupBy(*key, "id", "length", "offset").agg(F.min(F.abs("off")).alias("off"))
    run = F.col("offset") - F.row_number().over(W.partitionBy(*key).orderBy("offset"))
    runs = (
        met.withColumn("run", run)
        .groupBy(*key, "id", "length", "run")
        .agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.max(F.abs("off")).alias("far"))
        .filter(F.col("last") - F.col("first") + 1 >= F.least(F.lit(window), "length"))
        .select(*key, "id", "first", "last", (F.col("far") == 0).alias("exact"))
    )
    if not slack:
        return runs
    seeded = runs.join(found, key).filter(F.col("offset").between(F.col("first"), F.col("last")))
    return seeded.drop("offset").distinct()


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """Per document: ``id_col``, n_words, n_hit, n_items, items_sha256, contaminated.

    Words of items and texts are compared with A-Z as a-z. A null text, and a text or an item without words, matches nothing.
    Documents are rows: rows that repeat an id are judged each for itself. Items of one id count once, a null id as the
    empty one. An empty benchmark leaves all documents clean; an empty table gives an empty result; extra columns are not read.
    """
    terms = written(item_terms(benchmark, item_col, "text"))
    postings = written(index(docs, terms, id_col, text_col))
    begin, end = F.col("shift") + F.col("first"), F.col("shift") + F.col("last")
    hits = written(matches(postings, terms, window).select("row", "id", begin.alias("begin"), end.alias("end")).distinct())
    order = W.partitionBy("row").orderBy("begin", "end")
    before = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest(F.coalesce(before, F.col("begin") - 1), F.col("begin") - 1))
    spans = hits.select("row", "begin", "end").distinct().withColumn("fresh", fresh)
    n_hit = spans.groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    ids = hits.select("row", "id").distinct().groupBy("row").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    heads = postings.filter("place = 0").select("row", F.col("id").alias(id_col), "n_words")
    none = F.lit(0).cast("long")
    return (
        heads.join(n_hit, "row", "left")
        .join(ids, "row", "left")
        .select(
            id_col,
            "n_words",
            F.coalesce("n_hit", none).cast("long").alias("n_hit"),
            F.when(F.col("ids").isNull(), none).otherwise(F.size("ids")).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", F.coalesce("ids", F.array().cast("array<string>"))), 256).alias("items_sha256"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )
