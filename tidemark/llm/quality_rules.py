"""Quality rules whose thresholds come from mergeable quantile sketches.

Counts of each whole text are array expressions on its own row. The ratios of
the documents that pass the base rule (the others are rejected anyhow) are
summarised by one KLL sketch per language and source (partial sketches
merge before the shuffle, so a source with a third of all rows is no hot
key); merging those gives the sketches of a language and of everything. A
document is judged by the thresholds of its language and source, or of its
language, or of everything: the first that was seen ``least`` times.

A threshold lies ``reach`` spreads beyond an upper (or lower) quantile, a
spread being the distance of that quantile from the median. The quantile is
the metric's ``level``: 0.99 where ordinary documents are seldom above 0, 0.9
where the outliers themselves may be some hundredths of the documents. A
spread is never less than ``tie``, which decides only where the quantile and
the median (nearly) coincide.

Everything is DataFrame expressions. Defined results: a null text has no
words; a text without words has no ratios and fails the base rule; null
languages and sources are groups like others; two windows of words are equal
if their 64-bit hashes are; repeated rows are judged each for itself; a value
that equals its threshold is kept; texts of any length are read whole; an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import let
from .common import materialize

WINDOW = 3
SPACE = r"[ \t-\r]+"                     # \x20 and \x09 to \x0D


@dataclass(frozen=True)
class Metric:
    name: str
    value: Column
    level: float                         # the upper quantile
    reach: float                         # spreads beyond it
    tie: float                           # least spread, for quantiles that coincide
    low: bool = False                    # also judged from below


def metrics() -> tuple[Metric, ...]:
    words = F.when(F.col("n_words") > 0, F.col("n_words").cast("double"))
    return (
        Metric("symbols", F.col("n_symbols") / words, 0.9, 3.0, 0.01),
        Metric("dup_lines", F.col("n_dup_lines") / F.when(F.col("n_lines") > 0, F.col("n_lines").cast("double")), 0.99, 1.0, 0.01),
        Metric("repeats", F.col("n_repeat_words") / words, 0.99, 1.0, 0.01),
        Metric("word_length", F.col("word_chars") / words, 0.9, 3.0, 0.01, low=True),
        Metric("capitals", F.col("n_capitals") / F.when(F.col("word_chars") > 0, F.col("word_chars").cast("double")), 0.9, 3.0, 0.001),
    )


def _covered(words: Column) -> Column:
    """Words inside windows that occur twice or more."""
    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
                           lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(WINDOW)]))

    def repeated(keys: Column) -> Column:
        placed = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        starts = let(placed, lambda s: F.filter(s, lambda x, j: (
            F.coalesce(F.get(s, j - 1)["k"] == x["k"], F.lit(False))
            | F.coalesce(F.get(s, j + 1)["k"] == x["k"], F.lit(False)))))
        ordered = F.sort_array(F.transform(starts, lambda x: x["i"]))
        count = F.aggregate(ordered, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
                            lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(count["n"])

    return F.when(F.size(words) >= WINDOW, let(windows(words), repeated)).otherwise(F.lit(0))


def text_counts(text: Column) -> Column:
    """Struct of the counts of one text; each array is built once."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    long = lambda c, name: c.cast("long").alias(name)

    def body(t: Column) -> Column:
        return let(F.array_remove(F.split(t, SPACE, -1), ""), lambda w: let(
            F.filter(F.split(t, "\n", -1), lambda line: F.rlike(line, F.lit(r"[^ \t-\r]"))), lambda lines: F.struct(
                long(F.size(w), "n_words"), long(F.length(F.array_join(w, "")), "word_chars"),
                long(F.regexp_count(t, F.lit(r"[#*$%&|<>]")), "n_symbols"),
                long(F.size(lines) - F.size(F.array_distinct(lines)), "n_dup_lines"),
                long(_covered(w), "n_repeat_words"), long(F.size(lines), "n_lines"),
                long(F.length(F.regexp_replace(t, F.lit("[^A-Z]+"), F.lit(""))), "n_capitals"))))

    return let(text, body)


def document_counts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), text_counts(F.col("text")).alias("c")
                       ).select("doc_id", "lang", "source", "c.*")


def base_rule_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def sketches(counts: DataFrame, k: int = 800) -> DataFrame:
    """One row per language and source: number of documents that pass the
    base rule, a sketch per metric of them."""
    passed = ~base_rule_failed()
    return counts.groupBy("lang", "source").agg(
        F.count_if(passed).alias("docs"),
        *[F.kll_sketch_agg_double(F.when(passed, m.value), k).alias(m.name) for m in metrics()])


def thresholds(found: DataFrame, least: int) -> DataFrame:
    """(lang, source, <metric>_lo, <metric>_hi) of every language and source."""
    def merged(keys: list[str], tag: str) -> DataFrame:
        by = found.groupBy(*keys) if keys else found.groupBy()
        return by.agg(F.sum("docs").alias(f"docs{tag}"),
                      *[F.kll_merge_agg_double(m.name).alias(f"{m.name}{tag}") for m in metrics()])

    by_lang, of_all = merged(["lang"], "_l"), merged([], "_a")
    own = found.alias("f").join(by_lang.withColumnRenamed("lang", "_lang"), F.col("f.lang").eqNullSafe(F.col("_lang")), "left")
    one = own.join(of_all, F.lit(True), "left")          # a single row
    out = []
    for m in metrics():
        sketch = (F.when(F.col("docs") >= least, F.col(m.name))
                  .when(F.col("docs_l") >= least, F.col(f"{m.name}_l")).otherwise(F.col(f"{m.name}_a")))
        # a sketch that has seen no value has no quantiles
        q = F.when(F.kll_sketch_get_n_double(sketch) > 0,
                   F.kll_sketch_get_quantile_double(sketch, F.array(F.lit(1 - m.level), F.lit(0.5), F.lit(m.level))))
        spread = lambda a, b: F.greatest(q[b] - q[a], F.lit(m.tie)) * m.reach  # noqa: E731,B023
        out.append((q[2] + spread(1, 2)).alias(f"{m.name}_hi"))
        if m.low:
            out.append((q[0] - spread(0, 1)).alias(f"{m.name}_lo"))
    return one.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *out)


def judge(docs: DataFrame, least: int = 100) -> DataFrame:
    """Per document its counts, base_failed, kept, and the rules it broke."""
    counts = materialize(document_counts(docs), "quality-counts")
    limits = thresholds(materialize(sketches(counts), "quality-sketches"), least)
    joined = counts.join(limits, counts["lang"].eqNullSafe(limits["_lang"]) & counts["source"].eqNullSafe(limits["_source"]), "left")
    broken = []
    for m in metrics():
        broken.append(F.when(m.value > F.col(f"{m.name}_hi"), F.lit(f"{m.name}_high")))
        if m.low:
            broken.append(F.when(m.value < F.col(f"{m.name}_lo"), F.lit(f"{m.name}_low")))
    judged = joined.withColumn("base_failed", base_rule_failed()).withColumn("broken", F.array_compact(F.array(*broken)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "broken")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: counts and verdict of every document."""
    from .common import table

    return judge(table(spark, sf_dir, "documents")).withColumn("broken", F.array_join("broken", ","))
