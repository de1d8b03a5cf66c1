"""Spelling variants by permuterm rotations (operator 13).

Every word is marked with a terminator and turned: ``y $ x`` for every cut into
``x`` and ``y``. In this form an edit at the cut stands at the end of the
rotation, so the words near each other are neighbours under one prefix:

* a replacement: ``y $ x c`` and ``y $ x d`` share the prefix that skips the last
  character;
* an insertion or deletion: ``y $ x c`` has, without its last character, the whole
  rotation ``y $ x`` of the shorter word.

All rotations, each under its prefix (and whole), are sorted together by one shuffle on
the prefix. A group holds one word for each character at the cut and at most one
shorter word, so it is no larger than the alphabet, however common the words
are. Two words that differ by one replacement meet in exactly one group; a
deletion in a run of equal characters counts at the run's first character only, so
these, too, meet once. A group is scanned in order of count and gives every member
its number of near words there and the best of them; no pairs are made. Sums and bests per
word follow in one aggregation.

Roots follow the forms by pointer jumping: a round replaces every word's root by its
root's root. Counts grow by ``FACTOR`` along a chain, so rounds are few.

Defined cases: null and empty texts have no words; equal words are one word;
words are compared by code points; ties in count go to the word that is smaller in
code-point order; an empty vocabulary gives no rows. Words that hold the terminator
(U+0000) are refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellfold.llm.words import lower_ascii, text_of
from cellfold.session import Stages

RUN = r"[a-zÀ-ÿ]+"
END = "\0"
FACTOR = 5  # a word's form occurs at least this many times as often


def word_runs(text: Column) -> Column:
    """Maximal runs of letters of a text, A to Z in lower case."""
    return F.regexp_extract_all(lower_ascii(text_of(text)), F.lit(RUN), F.lit(0))


def without(word: Column, at: Column) -> Column:
    """``word`` without its code point at ``at`` (from 0)."""
    return F.concat(F.substring(word, F.lit(1), at), F.substr(word, at + 2))


def counted(words: DataFrame, *, least_length: int, least_count: int) -> DataFrame:
    """``word``, ``n`` of the words of enough length and count."""
    return (words.where(F.length("word") >= least_length).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))


def _rotations(words: DataFrame) -> DataFrame:
    """(prefix, n, word, whole, first): every rotation as itself, and without its
    last character; ``first``: that character opens its run."""
    word = F.when(F.contains("word", F.lit(END)), F.raise_error(F.lit("a word holds U+0000"))).otherwise(F.col("word"))
    cut = words.select(word.alias("word"), "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))
    before, after = F.substring("word", F.lit(1), F.col("i")), F.substr("word", F.col("i") + 1)
    turned = cut.select("word", "n", "i", F.concat(after, F.lit(END), before).alias("turned"))
    last, one_before = F.substring("word", F.col("i"), F.lit(1)), F.substring("word", F.col("i") - 1, F.lit(1))
    whole = F.struct(F.col("turned").alias("prefix"), F.lit(True).alias("whole"), F.lit(False).alias("first"))
    skipped = F.struct(F.substring("turned", F.lit(1), F.length("word")).alias("prefix"), F.lit(False).alias("whole"),
                       ((F.col("i") == 1) | (last != one_before)).alias("first"))
    both = F.when(F.col("i") > 0, F.array(whole, skipped)).otherwise(F.array(whole))
    return turned.select("word", "n", F.explode(both).alias("r")).select(
        "r.prefix", "word", "n", "r.whole", "r.first")


def _near(group: Column, own: Column) -> Column:
    """The members of a group that are near one of them, in the group's order."""
    return F.filter(group, lambda x: F.when(own["whole"], ~x["whole"] & x["first"]).when(
        x["whole"], own["first"]).otherwise(x["word"] != own["word"]))


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and ``best`` (struct of down = minus the count, and
    word) of the words of (word, n) that have a near word."""
    groups = _rotations(words).groupBy("prefix").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("n")).alias("down"), "word", "whole", "first"))).alias("group")).where(F.size("group") > 1)
    found = groups.select("group", F.explode("group").alias("own")).select(
        F.col("own.word").alias("word"), _near(F.col("group"), F.col("own")).alias("near")).where(F.size("near") > 0)
    best = F.struct(F.col("near")[0]["down"].alias("down"), F.col("near")[0]["word"].alias("word"))
    return found.groupBy("word").agg(F.sum(F.size("near")).alias("n_near"), F.min(best).alias("best"))


def _roots(forms: DataFrame, stages: Stages) -> DataFrame:
    """(word, root): the last of the forms that follow from (word, form)."""
    now = stages.save(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not now.where("moved").isEmpty():
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stages.save(now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
    return now.select("word", "root")


def variants(words: DataFrame, stages: Stages) -> DataFrame:
    """Per word of (word, n): ``form``, its near word of largest count if that is
    ``FACTOR`` times its own; ``root``, the last word on the way of forms, itself
    without one; ``n``, ``n_near``, and ``form_n``, the form's count."""
    words = stages.save(words.select("word", "n"), "spelling-words")
    near = words.join(near_words(words), "word", "left")
    form_n = -F.col("best.down")
    is_form = form_n >= FACTOR * F.col("n")
    formed = stages.save(near.select(
        "word", F.when(is_form, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, form_n).alias("form_n")), "spelling-forms")
    roots = _roots(formed.where("form is not null"), stages)
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
