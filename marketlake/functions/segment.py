"""Dictionary segmentation of text without separators: forward maximum matching over a dictionary table.

A run of letters and digits is read from its start: where dictionary words begin, the longest is taken; characters
that no word covers stay together as one word.  The dictionary is a DataFrame, so it may be a table that users
keep.  All substrings up to the longest dictionary word are candidates of a distinct run; a join with the
dictionary keeps those that are words, an aggregate keeps the longest per position (at most one per character), and
a fold inside the row walks them.  Runs are segmented once, however often they occur; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import words


def _walk(run: Column, longest: Column) -> Column:
    """Words of a run from the longest match per position (a map position -> length, from 1)."""
    empty = F.array().cast("array<string>")

    def step(s: Column, p: Column) -> Column:
        n = F.element_at(longest, p)
        unknown = F.when(s["from"] < p, F.array(F.substring(run, s["from"], p - s["from"]))).otherwise(empty)
        taken = F.struct((p + n).alias("next"), (p + n).alias("from"),
                         F.concat(s["out"], unknown, F.array(F.substring(run, p, n))).alias("out"))
        return F.when((p < s["next"]) | n.isNull(), s).otherwise(taken)

    start = F.struct(F.lit(1).alias("next"), F.lit(1).alias("from"), empty.alias("out"))
    end = F.char_length(run)
    return F.aggregate(F.sequence(F.lit(1), end), start, step, lambda s: F.concat(
        s["out"], F.when(s["from"] <= end, F.array(F.substring(run, s["from"], end - s["from"] + 1))).otherwise(empty)))


def segment_runs(runs: DataFrame, dictionary: DataFrame, word: str = "word") -> DataFrame:
    """``run, words`` of every distinct run (column ``run``)."""
    known = dictionary.select(F.lower(word).alias("w")).where("w <> ''").distinct()
    most = known.agg(F.coalesce(F.max(F.char_length("w")), F.lit(0)).alias("m")).scalar()
    runs = runs.select("run").where("run <> ''").distinct()
    end = F.char_length("run")
    spans = runs.withColumn("_m", most).select("run", "_m", F.explode(F.sequence(F.lit(1), end)).alias("p"))
    spans = spans.where("_m > 0").select("run", "p", F.explode(F.sequence(F.lit(1), F.least(F.col("_m"), F.char_length("run") - F.col("p") + 1))).alias("n"))
    found = spans.withColumn("w", F.substring("run", F.col("p"), F.col("n"))).join(known, "w", "left_semi")
    longest = found.groupBy("run", "p").agg(F.max("n").alias("n")).groupBy("run").agg(
        F.map_from_entries(F.collect_list(F.struct("p", "n"))).alias("longest"))
    none = F.create_map().cast("map<int,int>")
    return runs.join(longest, "run", "left").select("run", _walk(F.col("run"), F.coalesce("longest", none)).alias("words"))


def segmented(texts: DataFrame, dictionary: DataFrame, text: str = "text", word: str = "word") -> DataFrame:
    """Every word of every text, one row each: the rows of ``texts`` (without ``text``) and ``keyword``."""
    rest = [c for c in texts.columns if c != text]
    runs = texts.select(*rest, F.explode(words(F.col(text))).alias("run"))
    cut = segment_runs(runs, dictionary, word)
    return runs.join(cut, "run").select(*rest, F.explode("words").alias("keyword"))
