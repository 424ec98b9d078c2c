"""N-gram Jaccard join by signature trees.

Texts with equal shingle sets form a class. Star links to the largest class of each MinHash group,
verified exactly, gather near copies into components; these are the inner nodes of the signature
trees, below them stand the bands of sets of about one size, the classes are the leaves. Nodes hold
OR- (and AND-) combined token bitmaps and size ranges. Trees meet where they share prefix tokens: two
sets that link must share one among their first ``n - ceil(t * n) + 1`` tokens in any one global order,
here rare tokens first, and the more the closer their sizes are. The dual traversal counts the tokens
that roots share, drops pairs of nodes whose maximum possible overlap is too small, opens the others
and goes on level by level; leaf pairs that remain are compared set by set. Pairs inside one component
need no visit, so a group of near copies costs a row each, not pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap, cut, in_bitmap, joined_by_few, pick, table
from .graph import components
from .words import mix, shingle_sets

STARS = 4  # MinHash groups that each class joins
LANES = 8  # longs of a token bitmap
FREQUENT = 48  # prefix tokens in more rows than this come last in the token order,
MOST_FREQUENT = 1 << 20  # or in more of twice as many, and so on, until no more tokens than this do
SEEN = 100_000  # classes that a task remembers to have sent
_SIG = [f"s{i}" for i in range(LANES)]


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64), pa.int64())


def _class_of(tokens: np.ndarray) -> np.uint64:
    return mix(np.array([mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))], dtype=np.uint64))[0]


def _bits(tokens: np.ndarray) -> bytes:
    """A leaf's own bitmap: the set's size, then a bit for each token among one to two times as many."""
    n = len(tokens)
    width = max(64, 1 << int(n - 1).bit_length())
    held = np.zeros(width, np.uint8)
    held[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return n.to_bytes(8, "little") + np.packbits(held).tobytes()


def _may_overlap(num: int, den: int) -> Callable[[Column, Column], Column]:
    """A column function: whether two leaves' maximum possible overlap is enough to link.

    Of bitmaps of different widths the wider is folded. A bit that only one has stands for at least
    one token that only it has.
    """

    def unpacked(raw: bytes) -> tuple[int, np.ndarray]:
        return int.from_bytes(raw[:8], "little"), np.unpackbits(np.frombuffer(raw, np.uint8, offset=8))

    @F.arrow_udf("boolean")
    def may(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a, b):
            (n, u), (m, v) = unpacked(x.as_py()), unpacked(y.as_py())
            width = min(len(u), len(v))
            u, v = u.reshape(-1, width).max(axis=0), v.reshape(-1, width).max(axis=0)
            most = min(n - int((u > v).sum()), m - int((v > u).sum()))
            out.append(most * (num + den) >= (n + m) * num)
        return pa.array(out, pa.bool_())

    return may


def _profile(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows -> n, class, MinHashes and bitmap of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(batch.num_rows, dtype=np.int64)
            out = np.zeros((1 + STARS + LANES, batch.num_rows), dtype=np.uint64)
            leaf: list[bytes | None] = [None] * batch.num_rows
            for i, tokens in enumerate(shingle_sets(batch.column("text"), size)):
                n[i] = len(tokens)
                if len(tokens):
                    out[0, i] = _class_of(tokens)
                    leaf[i] = _bits(tokens)
                    for k in range(STARS):
                        out[1 + k, i] = mix(tokens ^ np.uint64(0x5851F42D4C957F2D * (k + 1) & (1 << 64) - 1)).min()
                    np.bitwise_or.at(out[1 + STARS :, i], (tokens >> np.uint64(58)).astype(np.int64) % LANES, np.uint64(1) << (tokens >> np.uint64(40) & np.uint64(63)))
            cols = [batch.column("doc_id"), pa.array(n), *(_long(x) for x in out), pa.array(leaf, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "cls", *(f"m{k}" for k in range(STARS)), *_SIG, "leaf"])

    return run


def _prefixes(size: int, num: int, den: int, frequent: np.ndarray | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows -> the prefix tokens of each text: frequent ones last, else by value.

    A task sends a class's tokens once, so copies aren't shuffled (it remembers the last ``SEEN``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            toks, classes, counts = [], [], []

            def packed() -> pa.RecordBatch:
                tok = np.concatenate(toks) if toks else np.zeros(0, np.uint64)
                cls = np.repeat(np.array(classes, dtype=np.uint64), counts)
                return pa.RecordBatch.from_arrays([_long(tok), _long(cls)], ["tok", "cls"])

            for tokens in shingle_sets(batch.column("text"), size):
                n = len(tokens)
                p = n - -(-num * n // den) + 1
                if n < 2 or p < 2 and num * (n + 1) > den * n:
                    continue  # no set but an equal one can link
                cls = int(_class_of(tokens))
                if cls in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(cls)
                if frequent is not None:
                    late = in_bitmap(frequent, tokens)
                    keep = np.concatenate([tokens[~late][:p], tokens[late][: max(0, p - int((~late).sum()))]])
                else:
                    keep = tokens[:p]
                toks.append(keep)
                classes.append(cls)
                counts.append(len(keep))
                if len(counts) % 1000 == 0:
                    yield packed()
                    toks, classes, counts = [], [], []
            yield packed()

    return run


def _sets(size: int, wanted: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (hk, text) whose hk may be wanted -> their class and whole token set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("hk").to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.flatnonzero(in_bitmap(wanted, keys))
            texts = batch.column("text").filter(pa.array(in_bitmap(wanted, keys)))
            for lo in range(0, len(texts), 500):
                sets = list(shingle_sets(texts.slice(lo, 500), size))
                cls = np.array([_class_of(s) for s in sets], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([_long(keys[at[lo : lo + 500]]), _long(cls), pa.array([s.tobytes() for s in sets], pa.binary())], ["hk", "cls", "tokens"])

    return run


def _linked(num: int, den: int) -> Callable[[Column, Column], Column]:
    """A column function: whether two packed token sets link."""

    @F.arrow_udf("boolean")
    def linked(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a, b):
            u, v = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            both = len(np.intersect1d(u, v, assume_unique=True))
            out.append(den * both >= num * (len(u) + len(v) - both))
        return pa.array(out, pa.bool_())

    return linked


def _may_link(num: int, den: int) -> Column:
    """Whether nodes x and y may hold sets that link: sizes, then the maximum possible overlap.

    A bit that all sets of x have and none of y has stands for a token of each set of x that is in
    no set of y, so the overlap is at most x's largest size less such bits; likewise for y.
    """
    miss = lambda p, q: sum(F.bit_count(F.col(f"{p}.a{i}").bitwiseAND(F.bitwise_not(F.col(f"{q}.s{i}")))) for i in range(LANES))
    most = F.least(F.col("x.hi") - miss("x", "y"), F.col("y.hi") - miss("y", "x"))
    return _sizes_allow(num, den) & (most * (num + den) >= (F.col("x.lo") + F.col("y.lo")) * num)


def _sizes_allow(num: int, den: int) -> Column:
    return (F.col("x.hi") * den >= F.col("y.lo") * num) & (F.col("y.hi") * den >= F.col("x.lo") * num)


def _shared_least(num: int, den: int) -> Column:
    """The least number of prefix tokens that x and y share if they hold sets that link.

    Common tokens beyond the prefix that ends first are tokens of that set after its prefix, which
    are at most ``ceil(t * n) - 1``; the others are in both prefixes. The bound is lowest where the
    sizes differ most, so a node's range counts by its ends.
    """
    after = lambda n: F.ceil(n * num / den) - 1

    def least(n: Column, m: Column) -> Column:
        return F.ceil((n + m) * num / (num + den)) - F.greatest(after(n), after(m))

    return F.least(least(F.col("x.lo"), F.col("y.hi")), least(F.col("x.hi"), F.col("y.lo")))


def jaccard_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Links every two texts whose shingle sets have ``intersection * den >= union * num``.

    Returns a row per input row: id, ``n_shingles`` (set size), ``component_id`` (smallest id that
    links reach, itself included) and ``links`` (links found from the row's class: to the largest
    class of its MinHash groups, or across components; equal sets and pairs inside a component are
    not expanded). Null texts and texts without words have size 0 and link with nothing; repeated
    rows have equal sets and link; ids are compared as they are (null ids sort last); an empty
    table gives an empty result; other columns are ignored. Hashes are 64 bits wide.
    """
    d = pick(docs, doc_id=id_col, text=text_col)
    kind = dict(d.dtypes)["doc_id"]
    longs = ", ".join(f"{c} long" for c in ("n", "cls", *(f"m{k}" for k in range(STARS)), *_SIG))
    rows = cut(d.mapInArrow(_profile(size), f"doc_id {kind}, {longs}, leaf binary"))
    stats = [F.first(c).alias(c) for c in (*(f"m{k}" for k in range(STARS)), *_SIG)]
    classes = cut(rows.where("n > 0").groupBy("cls", "n").agg(F.min("doc_id").alias("head"), F.count("*").alias("copies"), *stats))

    def node(df: DataFrame, name: str) -> DataFrame:
        return df.select("cls", F.col("n").alias("lo"), F.col("n").alias("hi"), *_SIG, *(F.col(s).alias(f"a{i}") for i, s in enumerate(_SIG))).alias(name)

    def verified(pairs: DataFrame) -> DataFrame:
        """Of pairs(a, b) of classes those that link: first by their leaves' bitmaps, then by their whole sets."""
        ends = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
        heads = ends.join(classes.select("cls", F.xxhash64("head").alias("hk")), "cls")  # one row of a class, so a common class isn't gathered
        leaf_of = cut(rows.select("cls", F.xxhash64("doc_id").alias("hk"), "leaf").join(heads, ["cls", "hk"], "left_semi").dropDuplicates(["cls"]).select("cls", "leaf"))
        near = pairs.join(leaf_of.select(F.col("cls").alias("a"), F.col("leaf").alias("la")), "a").join(leaf_of.select(F.col("cls").alias("b"), F.col("leaf").alias("lb")), "b")
        pairs = cut(near.where(_may_overlap(num, den)(F.col("la"), F.col("lb"))).select("a", "b"))
        ends = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
        ends = cut(ends.join(classes.select("cls", F.xxhash64("head").alias("hk")), "cls"))
        wanted = bitmap(ends, F.col("hk"))
        sets = d.select(F.xxhash64("doc_id").alias("hk"), "text").mapInArrow(_sets(size, wanted), "hk long, cls long, tokens binary").repartition("cls")  # one exchange for both ends
        sets = sets.join(ends.withColumnRenamed("hk", "head"), "cls").where("hk = head").select("cls", "tokens").dropDuplicates(["cls"])  # rows may repeat with their id
        one = pairs.join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta")), "a")
        two = one.join(sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb")), "b")
        return cut(two.where(_linked(num, den)(F.col("ta"), F.col("tb"))).select("a", "b").distinct())

    # Stars: each class against the class with most copies in each of its MinHash groups.
    grouped = classes.select("cls", "n", "copies", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"m{k}").alias("m")) for k in range(STARS)])).alias("g")).select("cls", "n", "copies", "g.*")
    pivots = cut(grouped.groupBy("k", "m").agg(F.max_by("cls", F.struct("copies", "n", "cls")).alias("pivot"), F.count("*").alias("size")).where("size > 1").select("k", "m", "pivot"))
    star = grouped.join(pivots, ["k", "m"]).where("cls <> pivot").select(F.col("cls").alias("a"), F.col("pivot").alias("b")).distinct()
    star = star.join(node(classes, "x"), F.col("a") == F.col("x.cls")).join(node(classes, "y"), F.col("b") == F.col("y.cls")).where(_may_link(num, den)).select("a", "b")
    links = verified(cut(star))
    inner = cut(components(links).select(F.col("v").alias("cls"), "root"))
    band = F.floor(F.log(F.col("n")) / np.log(den / num)).cast("long")  # sets of one band differ by less than links allow
    leaves = cut(classes.select("cls", "n", *_SIG).join(inner, "cls", "left").withColumn("root", F.coalesce("root", "cls")).withColumn("band", F.xxhash64("root", band)))
    combine = [F.expr(f"bit_or(s{i})").alias(f"s{i}") for i in range(LANES)] + [F.expr(f"bit_and(s{i})").alias(f"a{i}") for i in range(LANES)]
    sizes = [F.min("n").alias("lo"), F.max("n").alias("hi")]
    roots = cut(leaves.groupBy(F.col("root").alias("node")).agg(*sizes, *combine))
    bands = cut(leaves.groupBy(F.col("band").alias("node")).agg(F.min("root").alias("above"), *sizes, *combine))
    leaf = leaves.select(F.col("cls").alias("node"), F.col("band").alias("above"), F.col("n").alias("lo"), F.col("n").alias("hi"), *_SIG, *(F.col(s).alias(f"a{i}") for i, s in enumerate(_SIG)))

    # Where trees meet: prefix tokens, rare ones first, that at least two components hold.
    text = d.select("text")
    often = cut(text.mapInArrow(_prefixes(size, num, den, None), "tok long, cls long").groupBy("tok").count().where(F.col("count") > FREQUENT))
    by_size = {r.k: r.n for r in often.groupBy(F.floor(F.log2(F.col("count") / FREQUENT)).alias("k")).agg(F.count("*").alias("n")).collect()}  # a row for each doubling
    least = next(k for k in range(64) if sum(n for j, n in by_size.items() if j >= k) <= MOST_FREQUENT)
    frequent = bitmap(often.where(F.col("count") >= FREQUENT << least), F.col("tok"))
    held = text.mapInArrow(_prefixes(size, num, den, frequent), "tok long, cls long").repartition("tok")  # one exchange for both uses
    shared = held.groupBy("tok").agg(F.min("cls").alias("least"), F.max("cls").alias("most")).where("least <> most").select("tok")
    placed = leaves.select("cls", "root").join(roots.withColumnRenamed("node", "root"), "root")
    meets = cut(held.join(shared, "tok")).join(placed, "cls").drop("cls").repartition("tok").dropDuplicates(["tok", "root"])  # one exchange for both sides

    # Dual traversal: pairs of roots that may link and share enough tokens, opened to bands and to leaves, compared as sets.
    x, y = meets.alias("x"), meets.alias("y")
    met = (F.col("x.tok") == F.col("y.tok")) & (F.col("x.root") < F.col("y.root"))
    met_often = x.join(y, met & _may_link(num, den)).select(F.col("x.root").alias("a"), F.col("y.root").alias("b"), _shared_least(num, den).alias("least"))
    pairs = cut(met_often.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("least").alias("least")).where("n >= least").select("a", "b"))

    def opened(pairs: DataFrame, above: DataFrame, below: DataFrame) -> DataFrame:
        """Pairs (a, b) of nodes -> the pairs of nodes below them that may link: a's against b itself, then against b's."""
        against = pairs.join(above.alias("y"), F.col("b") == F.col("y.node"))
        one = cut(against.join(below.alias("x"), (F.col("a") == F.col("x.above")) & _may_link(num, den)).select(F.col("x.node").alias("a"), "b"))
        one = one.join(below.alias("x"), F.col("a") == F.col("x.node"))
        return cut(one.join(below.alias("y"), (F.col("b") == F.col("y.above")) & _may_link(num, den)).select("a", F.col("y.node").alias("b")))

    pairs = opened(pairs, roots, bands)
    pairs = opened(pairs, bands, leaf)
    links = cut(links.unionByName(verified(pairs)))

    final = components(links).select(F.col("v").alias("cls"), "root")
    count = links.select(F.col("a").alias("cls")).union(links.select(F.col("b").alias("cls"))).groupBy("cls").agg(F.count("*").alias("links"))
    smallest = classes.select("cls", "head").join(final, "cls").groupBy("root").agg(F.min("head").alias("component_id"))
    named = classes.select("cls", "head", "copies").join(final, "cls", "left").join(smallest, "root", "left").join(count, "cls", "left")
    named = cut(named.select("cls", "copies", F.coalesce("component_id", "head").alias("component_id"), F.coalesce("links", F.lit(0).cast("long")).alias("links")))
    some = joined_by_few(rows.where("n > 0"), named, "cls", "copies").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "links")
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("links"))
    return some.unionByName(none)


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all ``documents`` under 3-word shingles and Jaccard similarity of at least 0.9."""
    return jaccard_classes(table(spark, sf_dir, "documents"), size=3, num=9, den=10).select("doc_id", "n_shingles", "component_id")


OP2_SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') END AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS s FROM words),
sizes AS (SELECT words.doc_id, count(s) AS n FROM words LEFT JOIN shingles ON words.doc_id = shingles.doc_id GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS v, doc_id AS r FROM documents UNION SELECT v, y FROM reach JOIN edges ON r = x)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id FROM sizes JOIN (SELECT v, min(r) AS component_id FROM reach GROUP BY v) ON doc_id = v
"""
