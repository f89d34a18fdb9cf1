"""Spelling variants of words by permuterm rotations.

Method: every word is marked with a terminator and all its rotations are sorted.
A word that differs from another by one code point shares with it the rotation
that starts after the edited place, up to that code point: the rotation without
its last character is a prefix range which skips the edited character.  The
rotations with one prefix are a group; replacements of a place share a prefix,
and a word from which one code point is missing is the prefix itself, its whole
rotation.  So a group holds the words that have any one character at one place
and at most one word without it: as many rows as the alphabet has letters, at
any size of the corpus.

No pairs are made: each row of a group is told how many others there are and
which is the most frequent (the first, or for the first the second, in the
group's order), and these are summed by word.  A code point inside a run of equal
ones can be deleted at each of them with the same result; only the first place
of the run counts as that deletion.

A word's form is its most frequent near word (ties: the smallest) if that is
``ratio`` times as frequent.  Forms are followed to the root by doubling: every
step replaces the form by the form's form, so chains, along which the counts grow
``ratio``-fold, end after a few steps.

Words of more than ``LONG`` code points are rotated only if another long word
starts or ends alike (one edit leaves one of the two ends as it is), as the
rotations of a word are as long as its square.

Defined cases: null or empty texts have no words; a null id counts as an empty
id when letters are dropped; rows that share an id or repeat are counted each;
very long texts and very frequent words are only counts (added up before they
are shuffled); ties of n go to the word that is smaller in code-point order; an
empty table gives an empty table; extra columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.common import ascii_lower
from churnspark.session import materialize

#: A letter, and the mark at the end of a word (none of the letters).
LETTER = "A-Za-z\\u00C0-\\u00FF"
END = "$"
#: Code points from which a word is rotated only if another one may be near,
#: and the part at either end that then must be equal.
LONG, PART = 64, 24


def counted_words(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_length: int = 7, min_count: int = 2,
                  drop_every: int = 31) -> DataFrame:
    """(word, n): lower-cased runs of letters, one code point dropped where
    ``drop_every`` divides the hash of id and run; ``drop_every`` 0 drops none."""
    runs = docs.select(F.col(id_col).cast("string").alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"([{LETTER}]{{{min_length},}})"), F.lit(1))).alias("run"))
    word: Column = F.col("run")
    low = runs.select("id", ascii_lower(word).alias("run"))
    if drop_every:
        low = low.withColumn("h", F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), word)))
        at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
        word = F.when(F.col("h") % drop_every == 0, F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + 2))).otherwise(word)
    return (low.select(word.alias("word")).where(F.char_length("word") >= min_length).groupBy("word")
            .agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def _may_be_near(words: DataFrame) -> DataFrame:
    """Without the long words that can't have a near word."""
    long_ = words.where(F.char_length("word") >= LONG).select(
        "word", F.substring("word", 1, PART).alias("head"), F.reverse(F.substring(F.reverse("word"), 1, PART)).alias("tail"))
    more = lambda c: long_.groupBy(c).count().where("count > 1").select(c)
    near = long_.join(more("head"), "head", "left_semi").select("word").unionByName(
        long_.join(more("tail"), "tail", "left_semi").select("word")).distinct()
    return words.where(F.char_length("word") < LONG).unionByName(
        words.where(F.char_length("word") >= LONG).join(near, "word", "left_semi"))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, word, n, edited, first): a row for each place of a word, with the
    rotation that skips its code point, and rows with ``edited`` null for its
    whole rotations; ``first`` unless the code point repeats the one before."""
    length, k = F.char_length("word"), F.col("k")
    place = words.select("word", "n", F.explode(F.sequence(F.lit(1), length + 1)).alias("k"))
    head, tail = F.substr("word", F.lit(1), k - 1), F.substr("word", k)
    at = F.substr("word", k, F.lit(1))
    skipped = place.where(k <= length).select(
        F.concat(F.substr("word", k + 1), F.lit(END), head).alias("prefix"), "word", "n", at.alias("edited"),
        ((k == 1) | (at != F.substr("word", F.greatest(k - 1, F.lit(1)), F.lit(1)))).alias("first"))
    whole = place.select(F.concat(tail, F.lit(END), head).alias("prefix"), "word", "n",
                         F.lit(None).cast("string").alias("edited"), F.lit(True).alias("first"))
    return skipped.unionByName(whole)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best): words with a near word, the number of these and
    the most frequent one as (less = -n, word)."""
    table = rotations(_may_be_near(words))
    is_edit, entry = F.col("edited").isNotNull(), F.struct((-F.col("n")).alias("less"), "word")
    # edits first, the most frequent first
    order = Window.partitionBy("prefix").orderBy(F.col("edited").isNull(), F.desc("n"), "word")
    group = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = table.select(
        "word", "n", "edited", "first", entry.alias("entry"), F.count("*").over(group).alias("size"), F.count("edited").over(group).alias("edits"),
        F.first(entry).over(group).alias("top"), F.nth_value(entry, 2).over(group).alias("second"),
        F.count_if(is_edit & F.col("first")).over(group).alias("inserts"),
        F.min(F.when(is_edit & F.col("first"), entry)).over(group).alias("top_insert"),
        F.max(F.when(~is_edit, entry)).over(group).alias("shorter")).where("size > 1")
    edit, meets = F.col("edited").isNotNull(), F.col("shorter").isNotNull() & F.col("first")
    replaced = F.when(F.col("edits") > 1, F.when(F.col("top.word") == F.col("word"), F.col("second")).otherwise(F.col("top")))
    found = seen.select(
        "word", "n",
        F.when(edit, F.col("edits") - 1 + meets.cast("int")).otherwise(F.col("inserts")).alias("near"),
        F.when(edit, F.least(replaced, F.when(meets, F.col("shorter")))).otherwise(F.col("top_insert")).alias("best"))
    return (found.where("near > 0").groupBy("word", "n")
            .agg(F.sum("near").alias("n_near"), F.min("best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form, from (word, form)."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(at.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = moved.select("word", "root")
        if not moved.where("moved").take(1):
            return at


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of (word, n)."""
    words = materialize(words, "words")
    near = materialize(near_words(words), "near_words")
    form_n = -F.col("best.less")
    good = form_n >= ratio * F.col("n")
    judged = near.select("word", "n_near", F.when(good, F.col("best.word")).alias("form"), F.when(good, form_n).alias("form_n"))
    root = roots(judged.where("form IS NOT NULL"))
    return (words.join(judged, "word", "left").join(root, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
