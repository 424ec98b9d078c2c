"""Repair of words whose ligatures were lost, against a dictionary of words by commonness."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.operators.rounds import cut

# Letter pairs and triples that a font may draw as one glyph, and the sign of a lost one.
LIGATURES = ("ti", "tti", "ft", "tt", "fi", "fl", "ff", "ffi", "ffl", "tf", "th")
LOST = "\ufffd"
MAX_SLOTS = 3
COMMON = 60  # the highest tier of a common word
FEW = 1024  # repairs of words that lost a t that tasks know without a join
# What may be added to a common word of at least so many letters.
SUFFIXES = ("ly", "ful", "ness", "less")
LEAST_STEM = 4


def lowest_tier(words: DataFrame) -> DataFrame:
    """``(word, tier)`` with repeats -> each word's lowest tier."""
    return words.groupBy("word").agg(F.min("tier").alias("tier"))


def tier_of(words: DataFrame, dictionary: DataFrame, word: str = "word") -> DataFrame:
    """Adds ``tier``: of the lower-case word, else of it without a final s, else null.

    The dictionary's words are listed with and without a final s instead, so the words are joined once.
    """
    form = F.explode(F.array(F.struct(F.col("word").alias("form"), F.lit(1).alias("nth")), F.struct(F.concat("word", F.lit("s")).alias("form"), F.lit(2).alias("nth")))).alias("f")
    forms = dictionary.select("tier", form).groupBy("f.form").agg(F.min_by("tier", F.struct("f.nth", "tier")).alias("tier"))
    return words.join(forms, F.lower(F.col(word)) == F.col("form"), "left").drop("form")


def candidates(word: Column) -> Column:
    """Every filling of a word's lost places, in the ligatures' order; empty for more than three places."""
    gaps = F.length(word) - F.length(F.replace(word, F.lit(LOST), F.lit("")))
    first = lambda w: F.transform(F.array(*[F.lit(x) for x in LIGATURES]), lambda x: F.concat(F.substring_index(w, LOST, 1), x, F.expr("''"), F.substr(w, F.instr(w, LOST) + 1)))
    fill = lambda ws: F.flatten(F.transform(ws, lambda w: F.when(F.instr(w, LOST) > 0, first(w)).otherwise(F.array(w))))
    return F.when(gaps.between(1, MAX_SLOTS), fill(fill(fill(F.array(word))))).otherwise(F.array().cast("array<string>"))


def best_candidates(marked: DataFrame, dictionary: DataFrame, word: str = "word") -> DataFrame:
    """Distinct damaged words -> ``word, fixed``: the candidate of lowest tier, the first of equal ones.

    Candidates are exploded and joined to the dictionary; words without a listed one are left out.
    """
    each = marked.select(word).distinct().select(F.col(word).alias("damaged"), F.posexplode(candidates(F.col(word))).alias("pos", "word"))
    rated = tier_of(each, dictionary).where("tier is not null")
    return rated.groupBy("damaged").agg(F.min_by("word", F.struct("tier", "pos")).alias("fixed")).withColumnRenamed("damaged", word)


def with_doubled_t(word: Column) -> Column:
    """Every way of writing one of a word's t twice, in order."""
    at = F.filter(F.sequence(F.lit(1), F.length(word)), lambda i: F.substr(word, i, F.lit(1)) == "t")
    return F.when(F.length(word) > 0, F.transform(at, lambda i: F.concat(F.substr(word, F.lit(1), i), F.substr(word, i)))).otherwise(F.array().cast("array<string>"))


def compounds(each: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Of ``each(damaged, pos, word)`` the rows whose word is two common words or a common one and a suffix."""
    w = F.col("word")
    none = F.array().cast("array<struct<one:string,two:string>>")
    split = lambda i: F.struct(F.substr(w, F.lit(1), i).alias("one"), F.substr(w, i + 1).alias("two"))
    splits = F.when(F.length(w) >= 6, F.transform(F.sequence(F.lit(3), F.length(w) - 3), split)).otherwise(none)
    stem = F.coalesce(*[F.when(F.lower(w).endswith(e) & (F.length(w) >= LEAST_STEM + len(e)), F.left(w, F.length(w) - len(e))) for e in SUFFIXES])
    derived = F.when(stem.isNotNull(), F.array(F.struct(stem.alias("one"), F.lit(None).cast("string").alias("two")))).otherwise(none)
    parts = each.select("damaged", "pos", "word", F.explode(F.concat(derived, splits)).alias("p")).select("damaged", "pos", "word", "p.*")
    seen = parts.select(F.col("one").alias("part")).union(parts.where("two is not null").select("two")).distinct()
    common = tier_of(seen, dictionary, "part").where(F.col("tier") <= COMMON).select("part")
    first = parts.join(common.withColumnRenamed("part", "one"), "one", "left_semi")
    both = first.where("two is not null").join(common.withColumnRenamed("part", "two"), "two", "left_semi")
    return first.where("two is null").select("damaged", "pos", "word").unionByName(both.select("damaged", "pos", "word"))


def marked_repairs(marked: DataFrame, dictionary: DataFrame, word: str = "word") -> DataFrame:
    """Distinct damaged words -> ``word, fixed``, by the first of three steps that has an answer.

    The listed candidate of lowest tier; else that of the candidates with one t doubled; else the
    first candidate that is a compound. Each step sees only the words that the steps before it left.
    """
    # A word becomes up to 1,331 candidates, so even few words are dealt to many tasks.
    damaged = marked.select(F.col(word).alias("word")).distinct().repartition(4 * marked.sparkSession.sparkContext.defaultParallelism, "word")
    listed = cut(best_candidates(damaged, dictionary))  # read twice, and most candidates are made for it
    each = damaged.join(listed, "word", "left_anti").select(F.col("word").alias("damaged"), F.posexplode(candidates(F.col("word"))).alias("pos", "word"))
    doubled = each.select("damaged", "pos", F.posexplode(with_doubled_t(F.col("word"))).alias("nth", "word"))
    twice = tier_of(doubled, dictionary).where("tier is not null").groupBy("damaged").agg(F.min_by("word", F.struct("tier", "pos", "nth")).alias("fixed"))
    joined = compounds(each.join(twice, "damaged", "left_anti"), dictionary).groupBy("damaged").agg(F.min_by("word", "pos").alias("fixed"))
    return listed.unionByName(twice.unionByName(joined).withColumnRenamed("damaged", "word")).withColumnRenamed("word", word)


def _may_lack_t(word: Column) -> Column:
    return word.rlike("^[A-Za-z]{5,}$") & word.contains("t")


def dropped_tt(plain: DataFrame, dictionary: DataFrame, word: str = "word") -> DataFrame:
    """Distinct unlisted words of more than four Latin letters -> ``word, fixed``: the most common word with a t doubled."""
    may = plain.select(F.col(word).alias("word")).where(_may_lack_t(F.col("word"))).distinct()
    unknown = tier_of(may, dictionary).where("tier is null").select(F.col("word").alias("damaged"), F.posexplode(with_doubled_t(F.col("word"))).alias("pos", "word"))
    rated = tier_of(unknown, dictionary).where(F.col("tier") <= COMMON)
    return rated.groupBy("damaged").agg(F.min_by("word", F.struct("tier", "pos")).alias("fixed")).withColumnRenamed("damaged", word)


def rewritten(words: pa.Array, gaps: pa.Array, fixes: pa.Array) -> pa.Array:
    """Texts put together again from their words and the gaps around them, null where there are none.

    A word has one answer in all texts, so those of a batch are looked up at once.
    """
    n = len(words)
    length = lambda x: pc.fill_null(x.value_lengths(), 0).to_numpy(zero_copy_only=False)
    word, gap, (damaged, answer) = words.flatten(), gaps.flatten(), fixes.flatten().flatten()
    codes = damaged.dictionary_encode()
    at = pc.index_in(word, value_set=codes.dictionary)
    new = pc.coalesce(answer.take(pa.array(np.unique(codes.indices, return_index=True)[1])).take(at), word)
    hit, sign = at.is_valid().to_numpy(zero_copy_only=False), pc.match_substring(word, LOST).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(length(words) + length(gaps))])
    piece = np.empty(ends[-1], np.int64)  # gap, word, gap, ..., gap
    of = np.repeat(np.arange(n), length(words))
    for first, one, begin in ((0, gaps, 0), (len(gap), words, 1)):
        many = length(one)
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        piece[np.repeat(ends[:-1], many) + 2 * nth + begin] = first + np.arange(many.sum())
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays([gap, new]).take(pa.array(piece))), "")
    count = lambda which: pa.array(np.bincount(of[which], minlength=n))
    return pa.StructArray.from_arrays([text, count(hit & sign), count(hit & ~sign)], ["text", "marked", "doubled"], mask=words.is_null())


def repaired(texts: DataFrame, dictionary: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts with every damaged word that has an answer repaired; adds ``marked`` and ``doubled``, how many were.

    ``marked`` words hold the sign; ``doubled`` ones lost a t silently, which is only tried in texts
    with the sign. Only such texts are split into words, and only distinct words are looked up.
    """
    letters = rf"[\p{{L}}{LOST}]+"
    split = lambda c: F.regexp_extract_all(c, F.lit(letters), F.lit(0))
    sign = lambda w: w.contains(LOST)
    # Of each text only its distinct words that may change are shuffled, and then the text once.
    hurt = texts.where(F.col(text_col).contains(LOST)).select(F.col(id_col).alias("id"), split(F.col(text_col)).alias("words"))
    may = hurt.select("id", F.explode(F.array_distinct(F.filter("words", lambda w: (sign(w) & w.rlike(r"\p{L}")) | _may_lack_t(w)))).alias("word"))
    dictionary, seen = cut(dictionary), cut(may.select("word").distinct())
    fixes = cut(marked_repairs(seen.where(sign(F.col("word"))), dictionary).unionByName(dropped_tt(seen.where(~sign(F.col("word"))), dictionary)))
    # Words that lost a t are few among those that may have: as long as they are, the others stay where they are.
    few = [r.word for r in fixes.where(~sign(F.col("word"))).select("word").limit(FEW + 1).collect()]
    if len(few) <= FEW:
        may = may.where(sign(F.col("word")) | F.col("word").isin(few))
    fixed = may.join(fixes, "word").groupBy(F.col("id").alias(id_col)).agg(F.collect_set(F.struct("word", "fixed")).alias("_fixes"))
    d = texts.join(fixed, id_col, "left")
    touched = F.col("_fixes").isNotNull() & F.col(text_col).contains(LOST)
    put = F.arrow_udf(rewritten, "struct<text:string,marked:bigint,doubled:bigint>")
    d = d.withColumn("_new", put(F.when(touched, split(F.col(text_col))), F.when(touched, F.split(text_col, letters, -1)), "_fixes"))
    count = lambda n: F.coalesce(f"_new.{n}", F.lit(0).cast("long"))
    return d.withColumns({"marked": count("marked"), "doubled": count("doubled"), text_col: F.coalesce("_new.text", text_col)}).drop("_fixes", "_new")


def first_cell(items: DataFrame, cells: DataFrame, page: str, snap: float) -> DataFrame:
    """Each item's first cell (by ``cell``) that strictly holds its point (x, y), on the same page.

    A range join made equal: cells are listed under every grid square of ``snap`` that they touch,
    items under their own, so pairs are made within a square only.
    """
    square = lambda c: F.floor(c / snap).cast("long")
    spread = cells.withColumn("gx", F.explode(F.sequence(square(F.col("x0")), square(F.col("x1"))))).withColumn("gy", F.explode(F.sequence(square(F.col("y0")), square(F.col("y1")))))
    placed = items.withColumn("gx", square(F.col("x"))).withColumn("gy", square(F.col("y")))
    inside = placed.join(spread, [page, "gx", "gy"]).where("x > x0 and x < x1 and y > y0 and y < y1")
    return inside.groupBy(page, "item").agg(F.min("cell").alias("cell"))
