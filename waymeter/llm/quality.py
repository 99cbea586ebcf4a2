"""Quality rules whose thresholds follow from mergeable quantile sketches per language and source.

A sketch counts a measure's values by bucket: whole numbers below 64 have a bucket each, above it a bucket spans
1/32 of its value or less. Sketches merge by adding counts, so tasks sketch what they read, sources merge into
languages and languages into one, and nothing depends on the order. A document is kept if each of its measures
lies within the fences of its group, the quartiles moved out by REACH times their distance. Only built-in column
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymeter.llm.shared import written

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
REACH = 3
#: A group of fewer documents takes its language's sketch, and a language of fewer the sketch of all.
MIN_DOCS = 200
#: Measures in thousandths, each with the least distance of the quartiles that a fence reckons with.
MEASURES = {"mean_word": 500, "symbols": 50, "dup_lines": 200, "repeats": 150}
NO_GROUP = "\u0000"

WHITE = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def _plus(a: Column, b: Column) -> Column:
    return a + b


def counted(docs: DataFrame, carried: list[str]) -> DataFrame:
    """row (the `carried` columns of `docs`), lang, source and the counts of each text; a null text counts as none.

    Repeats are found within the row: windows of three words by their hashes, sorted with their places, so that
    equal ones are neighbours; the places of those give the words that they cover.
    """
    step = docs.select(
        F.struct(*carried).alias("row"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_GROUP)).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit(NO_GROUP)).alias("source"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"),
    )
    step = step.select(
        "row", "lang", "source",
        F.array_remove(F.split("body", "[ \\t-\\r]+"), "").alias("words"),
        F.filter(F.split("body", "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("lines"),
        _without(F.col("body"), WHITE).cast("long").alias("word_chars"),
        (F.char_length("body") - _without(F.col("body"), SYMBOLS)).cast("long").alias("n_symbols"),
    )
    word = lambda k: F.get("words", k)
    step = step.select(
        "row", "lang", "source", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") > 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda k: F.xxhash64(word(k), word(k + 1), word(k + 2)))).alias("windows"),
    )
    step = step.withColumn("sorted", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda x, k: F.struct(x.alias("hash"), k.alias("at")))),
    )).drop("windows")
    entry = lambda k: F.get("sorted", k)
    step = step.withColumn("places", F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("sorted") - 1), lambda k: entry(k)["hash"].eqNullSafe(entry(k - 1)["hash"]) | entry(k)["hash"].eqNullSafe(entry(k + 1)["hash"])),
        lambda k: entry(k)["at"],
    ))).drop("sorted")
    covered = F.transform("places", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("places", k + 1) - x, F.lit(3))).cast("long"))
    return step.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), _plus), F.lit(0))).drop("places")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEATED) * F.col("n_words"))


def _per_mille(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.lit(1000) * F.col(part), F.col(whole)), F.lit(0)).cast("long")


def measured(counts: DataFrame) -> DataFrame:
    return counts.withColumns({
        "mean_word": _per_mille("word_chars", "n_words"),
        "symbols": _per_mille("n_symbols", "n_words"),
        "dup_lines": _per_mille("n_dup_lines", "n_lines"),
        "repeats": _per_mille("n_repeat_words", "n_words"),
    })


def bucket(value: Column) -> Column:
    """The least value of the bucket of a non-negative whole number."""
    drop = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.expr("0L") + F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(measures: DataFrame) -> DataFrame:
    """level, lang, source, measure, bucket, n: the sketches of sources (2), languages (1) and all (0)."""
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in MEASURES)))
    fine = measures.where(~base_failed()).select("lang", "source", pairs.alias("p")).groupBy(
        "lang", "source", F.col("p.measure").alias("measure"), F.col("p.bucket").alias("bucket")).agg(F.count("*").alias("n"))
    # One grouping after the other, so that the documents are read once and merging meets sketches only.
    fine = written(fine, "sketches")
    middle = fine.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n")).withColumn("source", F.lit(NO_GROUP))
    coarse = fine.groupBy("measure", "bucket").agg(F.sum("n").alias("n")).withColumns({"lang": F.lit(NO_GROUP), "source": F.lit(NO_GROUP)})
    return fine.withColumn("level", F.lit(2)).unionByName(middle.withColumn("level", F.lit(1))).unionByName(coarse.withColumn("level", F.lit(0)))


def fences(sketch: DataFrame) -> DataFrame:
    """level, lang, source, docs and for each measure its low and high fence, by the quartiles of a sketch."""
    group = Window.partitionBy("level", "lang", "source", "measure")
    ranked = sketch.withColumn("upto", F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("total", F.sum("n").over(group))
    quartiles = ranked.groupBy("level", "lang", "source", "measure").agg(
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("q3"),
        F.max("total").alias("docs"),
    )
    made = []
    for name, least in MEASURES.items():
        here = F.col("measure") == name
        reach = F.greatest(F.col("q3") - F.col("q1"), F.lit(least)) * REACH
        made += [F.max(F.when(here, F.col("q1") - reach)).alias(f"{name}_low"), F.max(F.when(here, F.col("q3") + reach)).alias(f"{name}_high")]
    return quartiles.groupBy("level", "lang", "source").agg(F.max("docs").alias("docs"), *made)


def thresholds(measures: DataFrame) -> DataFrame:
    """lang, source and the fences that hold for that group: its own, its language's or those of all."""
    every = written(fences(sketches(measures)), "fences")
    names = [f"{m}_{side}" for m in MEASURES for side in ("low", "high")]

    def level(k: int, *keys: str) -> DataFrame:
        return every.where(f"level = {k}").select(*keys, F.struct("docs", *names).alias(f"f{k}"))

    one = F.lit(1).alias("one")
    groups = level(2, "lang", "source").join(level(1, "lang"), "lang").select("*", one).join(
        F.broadcast(level(0).select("*", one)), "one")  # a single row
    enough = lambda k: F.col(f"f{k}.docs") >= MIN_DOCS
    chosen = F.when(enough(2), F.col("f2")).when(enough(1), F.col("f1")).otherwise(F.col("f0"))
    # Read back from a table of known size: Spark broadcasts it below its limit only.
    return written(groups.select("lang", "source", chosen.alias("f")).select("lang", "source", *(F.col(f"f.{n}").alias(n) for n in names)), "thresholds")


def judged(docs: DataFrame, carried: list[str]) -> DataFrame:
    """row, the counts, base_failed and kept of every row; `row` holds the `carried` columns, so none clashes.

    The base rules reject texts of fewer than MIN_WORDS words or with more than MAX_REPEATED per cent of words in
    repeated windows, so null and empty texts go. Groups without a document that passes them have no fences
    and nothing to judge. Null lang and null source are groups of their own; repeated rows are judged alike and
    each counts; an empty table gives no rows.
    """
    measures = written(measured(counted(docs, carried)), "quality")
    joined = measures.join(thresholds(measures), ["lang", "source"], "left")
    inside = F.lit(True)
    for name in MEASURES:
        inside = inside & F.col(name).between(F.col(f"{name}_low"), F.col(f"{name}_high"))
    return joined.select("row", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & F.coalesce(inside, F.lit(False))).alias("kept"))


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept; see `judged`. Other columns than doc_id, text, lang, source are not read."""
    return judged(docs, ["doc_id"]).select(F.col("row.doc_id").alias("doc_id"), *COUNTS, "base_failed", "kept")


def kept(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns."""
    return judged(docs, docs.columns).where("kept").select("row.*")
