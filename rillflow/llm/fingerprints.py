"""Order MinHash fingerprints of documents, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, pick, table

BINS_LOG2 = 5  # components of a fingerprint
TAKEN = 2  # k-mers of a component
PLACE = 28  # low bits of a sort key that hold a k-mer's place; the others hold its hash
BUCKET_ROWS = 2000
MAX_BUCKETS = 4096  # a bound of the plan's size; beyond it ranges hold more rows and are sorted with spill


def fingerprints(df: DataFrame, **texts: str) -> DataFrame:
    """Adds an Order MinHash fingerprint (array of longs) of each text column, as ``new=text``.

    K-mers are pairs of neighbouring words. Equal k-mers are numbered by occurrence, so each
    (k-mer, number) is unique; its hash (the k-mer's own for the first) picks one of
    ``2**BINS_LOG2`` components and ranks it there. Of each component the ``TAKEN`` minimal ones are
    put back in text order and their tuple hashed, so a component survives an edit only with its
    k-mers and their order. Sort keys are single longs, hash above and place below, which sort
    without a comparator; only k-mers that occur again are numbered one by one. A text of one word
    has it as its k-mer; an empty one has an empty fingerprint.
    """
    low = (1 << PLACE) - 1
    rest = (1 << (64 - BINS_LOG2)) - 1
    other = df.columns
    part = lambda x: F.shiftrightunsigned(x, 64 - BINS_LOG2)
    kmer = lambda x: F.shiftrightunsigned(x, PLACE)
    same = lambda x, y: kmer(x.bitwiseXOR(y)) == 0
    none = F.array().cast("array<bigint>")

    # Each step is a column of its own: an expression inside a lambda would be made anew for each element.
    def keyed(words: Column) -> Column:
        key = lambda w, i: F.xxhash64(w, F.get(words, i + 1)).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long").bitwiseAND(F.lit(low)))
        keys = F.transform(words, key)  # of the last word alone too, which counts only if there is no other
        return F.sort_array(F.slice(keys, 1, F.greatest(F.size(words) - 1, F.least(F.size(words), F.lit(1)))))

    def least(v: Column) -> Column:
        return F.filter(v, lambda x, i: F.when(i < TAKEN, F.lit(True)).otherwise(part(F.get(v, i - TAKEN).bitwiseXOR(x)) != 0))

    def first(s: Column) -> Column:
        return F.filter(s, lambda x, i: F.when(i == 0, F.lit(True)).otherwise(~same(F.get(s, i - 1), x)))

    def again(s: Column) -> Column:
        return F.filter(s, lambda x, i: F.when(i == 0, F.lit(False)).otherwise(same(F.get(s, i - 1), x)))

    def numbered(r: Column) -> Column:
        """Of k-mers that occur again, sorted: each with its number, 1 and up, in its hash."""
        at = F.filter(F.sequence(F.lit(0), F.size(r) - 1), lambda i: F.when(i == 0, F.lit(True)).otherwise(~same(F.get(r, i - 1), F.get(r, i))))
        value = lambda x, nth: F.xxhash64(kmer(x), nth).bitwiseAND(F.lit(~low)).bitwiseOR(x.bitwiseAND(F.lit(low)))
        runs = lambda a: F.zip_with(a, F.concat(F.slice(a, 2, F.size(a)), F.array(F.size(r))), lambda x, y: F.transform(F.sequence(x, y - 1), lambda i: value(F.get(r, i), i - x + 1)))
        return F.when(F.size(r) > 0, F.sort_array(F.flatten(F.aggregate(F.array(at), F.array().cast("array<array<bigint>>"), lambda _, a: runs(a))))).otherwise(none)

    def paired(v: Column) -> Column:
        after = F.zip_with(v, F.concat(F.slice(v, 2, F.greatest(F.size(v), F.lit(1))), F.array(F.lit(None).cast("bigint"))), lambda x, y: F.struct(x.alias("x"), F.when(part(x) == part(y), y).alias("y")))
        return F.filter(after, lambda p: p["x"].isNotNull())

    def tuples(pairs: Column) -> Column:
        heads = F.filter(pairs, lambda p, i: F.when(i == 0, F.lit(True)).otherwise(F.get(pairs, i - 1)["y"].isNull()))
        in_order = lambda p: F.when(p["y"].isNotNull() & (p["y"].bitwiseAND(F.lit(low)) < p["x"].bitwiseAND(F.lit(low))), F.xxhash64(kmer(p["y"]), kmer(p["x"]))).otherwise(F.xxhash64(kmer(p["x"]), kmer(p["y"])))
        return F.transform(heads, lambda p: p["x"].bitwiseAND(F.lit(~rest)).bitwiseOR(in_order(p).bitwiseAND(F.lit(rest))))

    def step(df: DataFrame, keep: list[str], **new: dict[str, Column]) -> DataFrame:
        return df.select(*other, *[F.col(f"__{k}_{n}") for k in keep for n in texts], *[c.alias(f"__{k}_{n}") for k, by in new.items() for n, c in by.items()])

    of = lambda f, k: {n: f(F.col(f"__{k}_{n}")) for n in texts}
    df = step(df, [], w={n: F.regexp_extract_all(F.coalesce(F.col(t), F.lit("")), F.lit(WORD), F.lit(0)) for n, t in texts.items()})
    df = step(df, [], s=of(keyed, "w"))
    df = step(df, [], f=of(first, "s"), r=of(again, "s"))
    df = step(df, ["r"], f=of(least, "f"))
    df = step(df, ["f"], r=of(numbered, "r"))
    df = step(df, ["f"], r=of(least, "r"))
    df = step(df, [], v={n: F.sort_array(F.concat(f"__f_{n}", f"__r_{n}")) for n in texts})
    df = step(df, [], v=of(least, "v"))
    df = step(df, [], p=of(paired, "v"))
    return df.select(*other, *[tuples(F.col(f"__p_{n}")).alias(n) for n in texts])


def likeness(a: Column, b: Column) -> Column:
    """The share of components present in either fingerprint that agree; 1 for two empty ones."""
    part = lambda x: F.shiftrightunsigned(x, 64 - BINS_LOG2)
    either = F.size(F.array_union(F.transform(a, part), F.transform(b, part)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def hexed(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def neighbours(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, fp, next_text, next_fp``: each text with the next one by descending id.

    Ids fall into ranges of about ``BUCKET_ROWS`` rows by approximate percentiles; each range is
    ordered by itself, and only the first row of each is handed to the range before it.
    """
    d = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.coalesce("text", F.lit("")))
    n = d.count()
    buckets = max(1, min(MAX_BUCKETS, n // BUCKET_ROWS))
    cuts = d.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)] or [0.5], 10_000)).first()[0] or []
    bounds = F.lit(sorted(set(cuts))).cast("array<bigint>")
    d = d.withColumn("bucket", F.coalesce(F.when(F.col("doc_id").isNotNull(), F.size(F.filter(bounds, lambda b: b < F.col("doc_id")))), F.lit(-1)))
    first_ids = d.groupBy("bucket").agg(F.max("doc_id").alias("first_id"))
    firsts = d.alias("d").join(F.broadcast(first_ids.alias("f")), (F.col("d.bucket") == F.col("f.bucket")) & F.col("doc_id").eqNullSafe(F.col("first_id")))  # at most MAX_BUCKETS + 1 rows
    firsts = firsts.groupBy("d.bucket").agg(F.min("text").alias("first_text"))
    down = Window.partitionBy().orderBy(F.desc("bucket"))
    firsts = firsts.withColumn("edge_text", F.coalesce(F.lead("first_text").over(down), F.first("first_text").over(down))).select(F.col("bucket").alias("b"), "edge_text")
    firsts = cut(fingerprints(firsts, edge_fp="edge_text"))
    order = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), "text")
    d = fingerprints(d, fp="text").withColumns({"next_text": F.lead("text").over(order), "next_fp": F.lead("fp").over(order)})
    d = d.join(firsts, d["bucket"] == firsts["b"])
    return d.select("doc_id", "text", "fp", F.coalesce("next_text", "edge_text").alias("next_text"), F.coalesce("next_fp", "edge_fp").alias("next_fp"))


def edited_likeness(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tail: int = 3) -> DataFrame:
    """Fingerprints of every text and of its edit, and how alike they are.

    The edit replaces the last ``floor(n_chars / tail)`` code points by the first as many (or all)
    of the next text by descending id; after the last comes the first. Returns a row per input row:
    id, ``text``, ``edited``, ``fp``, ``edited_fp``, ``next_fp``, ``near_edited``, ``near_next``.
    Null texts are empty and have empty fingerprints; ids are integers, null ones come last; rows
    with equal ids follow by text; a single row is its own next; an empty table gives an empty
    result; other columns are ignored.
    """
    d = neighbours(docs, id_col=id_col, text_col=text_col)
    n = F.length("text")
    cut_at = F.floor(n / tail).cast("int")
    d = d.withColumn("edited", F.concat(F.substr("text", F.lit(1), n - cut_at), F.substr("next_text", F.lit(1), cut_at))).drop("next_text")
    d = fingerprints(d, edited_fp="edited")
    return d.withColumns({"near_edited": likeness(F.col("fp"), F.col("edited_fp")), "near_next": likeness(F.col("fp"), F.col("next_fp"))})


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and their edits."""
    d = edited_likeness(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), hexed(F.col("fp")).alias("fingerprint"), hexed(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next")
