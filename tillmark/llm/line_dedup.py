"""Repeated line runs by a suffix array over line ids, native: DataFrame functions only.

A document is the sequence of its lines that hold a word; blank lines are passed over and stay. A
line's id is a digest of its text. The suffixes of all sequences are sorted into classes by prefix
doubling: round k names every suffix by its first 2^k lines, and two names of round k, 2^k lines
apart, make the name of round k + 1. A name is the first place (document, then line) where those
lines stand, so that a class is an interval of the suffix array whose members share a prefix of at
least 2^k lines, and its name tells whether a member is a later copy. Suffixes alone in their class
have no longer repeat and leave; rounds go on until none is left, so their number is the logarithm
of the longest repeated run.

A run of lines counts if it has ``min_words`` words. Every line that lies in a counting run whose
lines also start at an earlier place is deleted. The deepest class in which a place is not the first
gives 2^k lines that also start earlier, and those of all places of a maximal repeated run cover that
run: the first and the last of its stretches of 2^k lines overlap. So the stretches that count decide
by their reach, for runs of any length. What is left are runs that count though a stretch in them
does not, as their lines are of a word or two. Those hold a shortest counting run (one that no longer
counts without its last or its first line) of m lines, m not a power of two and at most
``min_words``: 2^k < m < 2^(k+1), named by two names of round k that overlap.

Defined results: a null or empty text has no lines. A null ``doc_id`` comes before all others. Rows
with the same ``doc_id`` and text count as one document and all get its result; with the same
``doc_id`` and other texts they are ordered by the texts' digests. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm.common import digest16, kept_table

MIN_WORDS = 5


_WORD = r"[^\x20\x09-\x0D]+"
_NO_ID = -(2 ** 63)


def _key_columns(doc_id: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NO_ID)).alias("doc"),
            digest16(F.coalesce(F.col(text), F.lit(""))).alias("txt")]


def _all_lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """A row per line with a word: place, id, and the lengths of the shortest counting runs that
    start (``ahead``) and end (``back``) there; null where none does."""
    worded = docs.select(
        *_key_columns("doc_id", "text"),
        F.filter(_all_lines("text"), lambda x: x.rlike(_WORD)).alias("lines"),
    ).select("*", F.transform("lines", lambda x: F.regexp_count(x, F.lit(_WORD))).alias("words"))
    many = F.sequence(F.lit(1), F.lit(min_words))
    size = F.size("words")

    def words_of(start: Column, m: Column) -> Column:
        return F.aggregate(F.slice(F.col("words"), start + 1, m), F.lit(0), lambda a, w: a + w)

    def ahead(i):
        fits = F.filter(many, lambda m: (i + m <= size) & (words_of(i, m) >= min_words))
        return F.get(fits, F.lit(0))

    def back(i):
        fits = F.filter(many, lambda m: F.when(i + 1 >= m, words_of(i + 1 - m, m) >= min_words)
                        .otherwise(False))
        return F.get(fits, F.lit(0))

    facts = F.transform("lines", lambda x, i: F.struct(
        digest16(x).alias("id"), ahead(i).alias("ahead"), back(i).alias("back")))
    return worded.select("doc", "txt", F.posexplode(facts).alias("pos", "line")).select(
        F.struct("doc", "txt", "pos").alias("place"), "line.*")


def _named(suffixes: DataFrame, key: list[str], keep: list[str], level: int) -> DataFrame:
    """Names suffixes with equal ``key`` by their first place; those alone in their class leave."""
    classes = kept_table(
        suffixes.groupBy(*key).agg(F.min("place").alias("name"), F.max("place").alias("last"),
                                   F.count(F.lit(1)).alias("n"))
        .where("name <> last").drop("last", "n"), f"classes{level}")
    named = suffixes.join(classes, key).select("place", "name", *keep)
    # Repeated rows are dropped once; places that are single make single pairs.
    return kept_table(named if level else named.distinct(), f"names{level}")


def _two_to(k: str | Column) -> Column:
    return F.pow(F.lit(2), k).cast("int")


def _stacked(levels: list[DataFrame], first: int = 0) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.select("place", "name", F.lit(k).alias("k")) for k, df in enumerate(levels, first)])


def _moved(place: str, by: Column | int) -> Column:
    return F.struct(F.col(f"{place}.doc").alias("doc"), F.col(f"{place}.txt").alias("txt"),
                    (F.col(f"{place}.pos") + by).alias("pos"))


def suffix_names(docs: DataFrame, min_words: int = MIN_WORDS) -> list[DataFrame]:
    """Per round k: ``place`` and ``name`` of all suffixes whose first 2^k lines are repeated.

    Round 0 also has ``ahead`` and ``back``. The last round is the last with any row.
    """
    lines = kept_table(_lines(docs, min_words), "lines")
    levels = [_named(lines, ["id"], ["ahead", "back"], 0)]
    while not levels[-1].isEmpty():
        length = 2 ** (len(levels) - 1)
        here = levels[-1].select("place", F.col("name").alias("head"))
        there = levels[-1].select(_moved("place", -length).alias("place"),
                                  F.col("name").alias("tail"))
        pairs = kept_table(here.join(there, "place"), f"pairs{len(levels)}")
        levels.append(_named(pairs, ["head", "tail"], [], len(levels)))
    return levels[:-1]


def _later_windows(levels: list[DataFrame], min_words: int) -> DataFrame:
    """``place`` and ``m`` of the shortest counting runs that also start at an earlier place, where m
    is no power of two: names of a single round tell of all others."""
    odd = "m & (m - 1) <> 0"
    windows = levels[0].select("place", F.col("ahead").alias("m")).where(odd).unionByName(
        levels[0].where("back is not null")
        .select(_moved("place", F.lit(1) - F.col("back")).alias("place"), F.col("back").alias("m"))
        .where(odd))
    k = F.floor(F.log2(F.col("m"))).cast("int")
    windows = windows.distinct().withColumn("k", k).withColumn(
        "second", _moved("place", F.col("m") - _two_to("k")))
    # A run of min_words lines has min_words words at least: deeper rounds are not asked for.
    names = _stacked(levels[1: min_words.bit_length()], 1)
    named = (
        windows.join(names.withColumnRenamed("name", "head"), ["place", "k"])
        .join(names.select(F.col("place").alias("second"), "k", F.col("name").alias("tail")),
              ["second", "k"])
        .select("place", "m", "head", "tail")
    )
    named = kept_table(named, "windows")
    first = kept_table(named.groupBy("m", "head", "tail").agg(F.min("place").alias("first"),
                                                             F.max("place").alias("last"))
                       .where("first <> last").drop("last"), "window-classes")
    return named.join(first, ["m", "head", "tail"]).where("place <> first").select("place", "m")


def _decided(levels: list[DataFrame], min_words: int) -> DataFrame:
    """Per document with a line that also stands earlier: ``gone``, the numbers of the lines to delete,
    ascending, and ``copied``, the lines of the deepest class."""
    later = _stacked(levels).where("place <> name").select("place", "k", F.lit(None).cast("int").alias("ahead"))
    # What a line's shortest counting run is, round 0 knows.
    needs = levels[0].where("place <> name").select("place", F.lit(0).alias("k"), "ahead")
    # Dealt by document once, for the deepest class of a place and for the reach within the document.
    dealt = later.where("k > 0").unionByName(needs).select("place.*", "k", "ahead").repartition("doc", "txt")
    deepest = dealt.groupBy("doc", "txt", "pos").agg(F.max("k").alias("k"), F.max("ahead").alias("ahead"))
    lines = _two_to("k")
    reach = deepest.select(
        "doc", "txt", "pos", "k", F.when(F.col("ahead") <= lines, F.col("pos") + lines).alias("end"))
    if len(levels) > 1 and min_words > 2:
        thin = _later_windows(levels, min_words)
        reach = reach.unionByName(thin.select(
            "place.*", F.lit(None).cast("int").alias("k"), (F.col("place.pos") + F.col("m")).alias("end")))
    # Rows of a document are at most its lines and their thin runs. A deleted line has a row: it
    # stands earlier itself.
    so_far = Window.partitionBy("doc", "txt").orderBy("pos")
    covered = reach.withColumn("covered", F.max("end").over(so_far) > F.col("pos")).where("k IS NOT NULL")
    return covered.groupBy("doc", "txt").agg(
        F.sort_array(F.collect_list(F.when(F.col("covered"), F.col("pos")))).alias("gone"),
        _two_to(F.max("k")).alias("copied"))


def repeated_runs(levels: list[DataFrame]) -> DataFrame:
    """The copied runs: ``doc_id``, ``first_line``, ``n_lines``, ``source_id``, ``source_line``.

    Every suffix takes the source of its deepest class; neighbours whose sources are neighbours
    too make one run, which is maximal for that source. Lines count from 0, without blank ones.
    """
    found = _stacked(levels).where("place <> name")
    deepest = found.groupBy("place").agg(F.max(F.struct("k", "name")).alias("best"))
    steps = deepest.select(
        F.col("place.doc").alias("doc"), F.col("place.txt").alias("txt"),
        F.col("best.name.doc").alias("source"), F.col("best.name.txt").alias("source_txt"),
        (F.col("best.name.pos") - F.col("place.pos")).alias("shift"),
        F.col("place.pos").alias("a"),
        (F.col("place.pos") + _two_to("best.k")).alias("b"))
    # A document's steps are no more than its lines.
    chain = Window.partitionBy("doc", "txt", "source", "source_txt", "shift").orderBy("a")
    reached = F.max("b").over(chain.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached.isNull() | (F.col("a") > reached), 1).otherwise(0)
    runs = steps.withColumn("opens", opens).withColumn("run", F.sum("opens").over(chain))
    return runs.groupBy("doc", "txt", "source", "source_txt", "shift", "run").agg(
        F.min("a").alias("first_line"), F.max("b").alias("end")).select(
        F.col("doc").alias("doc_id"), "first_line",
        (F.col("end") - F.col("first_line")).alias("n_lines"),
        F.col("source").alias("source_id"),
        (F.col("first_line") + F.col("shift")).alias("source_line"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of ``docs``: ``row`` (all its columns), ``kept_text`` (null where ``text`` is),
    ``n_lines``, ``n_removed``, ``n_runs`` (stretches of neighbouring lines removed) and
    ``copied_lines``, the largest power of two of lines that also start at an earlier place. Lines are
    counted without blank ones."""
    levels = suffix_names(docs, min_words)
    keyed = docs.select(F.struct("*").alias("row")).select(
        "row", *_key_columns("row.doc_id", "row.text"))
    if levels:
        decided = kept_table(_decided(levels, min_words), "line-decisions")
        keyed = keyed.join(decided, ["doc", "txt"], "left")
    else:
        keyed = keyed.select("*", F.lit(None).cast("array<int>").alias("gone"),
                             F.lit(0).alias("copied"))
    lines = keyed.withColumn("lines", _all_lines("row.text"))
    has_word = F.transform("lines", lambda x, i: F.when(x.rlike(_WORD), i))
    placed = lines.withColumn("at", F.filter(has_word, lambda i: i.isNotNull()))
    opens = F.filter("gone", lambda p, i: (i == 0) | (F.get(F.col("gone"), i - 1) < p - 1))
    dropped = F.transform("gone", lambda p: F.get(F.col("at"), p))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), dropped)
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n")
    return placed.select(
        "row",
        F.when(F.coalesce(F.size("gone"), F.lit(0)) == 0, F.col("row.text")).otherwise(kept).alias("kept_text"),
        F.size("at").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.size(opens), F.lit(0)).cast("bigint").alias("n_runs"),
        F.coalesce("copied", F.lit(0)).cast("bigint").alias("copied_lines"),
    )
