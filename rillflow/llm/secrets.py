"""Secret scans with corpus-wide ownership frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, joined_by_few, pick, table

# The kinds of the base scan, their patterns and least lengths.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the same matches as AKIA[A-Z0-9]+ of 20+ characters
HEX = r"[0-9a-f]{24,}"  # likewise of [0-9a-f]+
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "opaque")

#: Candidates of the added kind: long opaque runs that hold a letter and a digit.
OPAQUE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
SPAN = "struct<start:int,kind:int,end:int,value:string>"


def spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as spans in code points; ``value`` is the group's text.

    The text between matches (``split``) and the matches give every position as a running sum.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("hit"), value.alias("value"))
    steps = F.filter(steps, lambda s: s["hit"].isNotNull())
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        start = a["at"] + F.length(s["gap"])
        end = start + F.length(s["hit"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), s["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(F.length(s["value"]) >= least, F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

    found = F.aggregate(steps, empty, step, lambda a: a["out"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def outside(found: Column, base: Column) -> Column:
    """Of ``found`` (disjoint, by start) the spans that overlap none of ``base`` (by start): one sweep over both."""
    both = F.array_sort(F.concat(base, found))
    none = F.array().cast(f"array<{SPAN}>")
    empty = F.struct(F.lit(0).alias("base_end"), none.alias("open"), none.alias("out"))

    def step(a: Column, s: Column) -> Column:
        whole = F.filter(a["open"], lambda o: o["end"] <= s["start"])  # the span before, unless this one starts inside it
        out = F.when(F.size(whole) > 0, F.concat(a["out"], whole)).otherwise(a["out"])
        opened = F.when((s["kind"] == 3) & (a["base_end"] <= s["start"]), F.array(s)).otherwise(none)
        return F.struct(F.when(s["kind"] == 3, a["base_end"]).otherwise(F.greatest(a["base_end"], s["end"])).alias("base_end"), opened.alias("open"), out.alias("out"))

    return F.aggregate(both, empty, step, lambda a: F.concat(a["out"], a["open"]))


def listed(found: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang"), max_owners: int = 2, max_repos: int = 2) -> DataFrame:
    """Finds secrets in whole texts and tells owner-specific ones from widely copied examples.

    Base kinds are found in each text alone. Every candidate value (base or opaque run) is
    hashed, and the corpus says how many distinct owners (``owner_col``) and repositories
    (``repo_cols`` together) hold it: at most ``max_owners`` owners and ``max_repos`` repositories
    make it ``live``, more of either make it an ``example`` (a repository counts once, also
    if several owners share it). Opaque runs outside base spans become spans only when live; base spans always
    stay. Values travel as SHA-256 digests, pre-aggregated by (digest, owner, repository).

    Returns a row per input row: id, ``text_hash`` (xxhash64), ``base`` and ``found`` (arrays of start, kind, end, digest, in
    code points), ``n_live``, ``n_example``, ``most_owners`` and ``most_repos`` (of any of its values). A null text is empty and has no spans; null owners
    count as one owner; equal rows get equal results; ties of start go by kind; an empty table gives
    an empty result; other columns are ignored.
    """
    repo = {f"repo{i}": c for i, c in enumerate(repo_cols)}
    d = pick(docs, doc_id=id_col, text=text_col, owner=owner_col, **repo)
    text = F.coalesce("text", F.lit(""))
    base = F.array_sort(F.concat(spans(text, ASSIGN, 0, 1, ASSIGN_LEAST), spans(text, ACCESS, 1), spans(text, HEX, 2)))
    digest = lambda a: F.transform(a, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("digest")))
    d = (
        d.select("doc_id", F.coalesce(F.col("owner").cast("string"), F.lit("\x00")).alias("owner"), F.concat_ws("\x00", *[F.coalesce(F.col(r).cast("string"), F.lit("\x01")) for r in repo]).alias("repo"), F.col("text"), F.xxhash64("text").alias("text_hash"), base.alias("base"))
        .withColumn("opaque", spans(text, OPAQUE, 3))
        .withColumn("opaque", outside(F.col("opaque"), F.col("base")))
        .select("doc_id", "text_hash", "owner", "repo", digest(F.col("base")).alias("base"), digest(F.col("opaque")).alias("opaque"))
    )
    d = cut(d.withColumn("all", F.concat("base", "opaque")))  # the texts are scanned once
    with_any = d.where(F.size("all") > 0)
    held = with_any.select("owner", "repo", F.explode(F.array_distinct(F.transform("all", lambda s: s["digest"]))).alias("digest"))
    held = held.groupBy("digest", "owner", "repo").agg(F.count("*").alias("rows"))
    freq = cut(held.groupBy("digest").agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repo").alias("repos"), F.sum("rows").alias("rows")))
    # Equal (id, spans) rows get equal answers, so one of each asks and all of them are answered.
    key = F.xxhash64("doc_id", "all")
    asked = with_any.select(key.alias("key"), "all").dropDuplicates(["key"]).select("key", F.explode("all").alias("s"))
    live = (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
    answered = (  # a value that a large share of rows hold is answered where they are
        joined_by_few(asked.withColumn("digest", F.col("s.digest")), freq, "digest", "rows")
        .groupBy("key")
        .agg(
            F.array_sort(F.collect_list(F.when((F.col("s.kind") < 3) | live, F.col("s")))).alias("found"),
            F.sum(live.cast("long")).alias("n_live"),
            F.sum((~live).cast("long")).alias("n_example"),
            F.max("owners").alias("most_owners"),
            F.max("repos").alias("most_repos"),
        )
    )
    zero = F.lit(0).cast("long")
    some = with_any.withColumn("key", key).join(cut(answered), "key").select("doc_id", "text_hash", "base", "found", "n_live", "n_example", "most_owners", "most_repos")
    none = d.where(F.size("all") == 0).select("doc_id", "text_hash", "base", F.col("base").alias("found"), zero.alias("n_live"), zero.alias("n_example"), zero.alias("most_owners"), zero.alias("most_repos"))
    return some.unionByName(none)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all ``documents``: counts per base kind, digest of base spans, all spans."""
    s = scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return s.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"), "n_live", "n_example", "most_owners", "most_repos")
