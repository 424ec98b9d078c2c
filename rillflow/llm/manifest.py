"""A Merkle manifest of a dataset: leaves of rows, a tree per source, a tree over sources, a proof per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, pick, table

ARITY = 16
_PATH = "array<struct<left:string,right:string>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(*values: Column) -> Column:
    """The digest of a row: each value as its UTF-8 byte count, a colon and itself; ``-`` for null."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def placed(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0, by ``order``) in their ``group`` and its size ``n``.

    One sort by range: a group may span any number of ranges, so no task holds a whole one. Only
    a row per range and group is counted up. Equal rows take neighbouring places.
    """
    d = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    d = cut(d.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    spans = d.groupBy("part", group).agg(F.min("nth").alias("first"), F.count("*").alias("held"))
    every = Window.partitionBy(group)
    spans = spans.select("part", group, "first", (F.sum("held").over(every.orderBy("part")) - F.col("held")).alias("before"), F.sum("held").over(every).alias("n"))
    return d.join(spans, ["part", group]).withColumn("pos", F.col("nth") - F.col("first") + F.col("before")).drop("part", "nth", "first", "before")


def siblings(nodes: DataFrame) -> DataFrame:
    """A level's ``nodes`` (``grp, pos, n, node``) with ``up`` (the parent's place), ``left`` and ``right``: the run's others, as text.

    Lag and lead columns of each offset, masked by the slot and the run's length. The window is
    the run itself, and what joins parents by (grp, up) afterwards needs no other shuffle.
    """
    d = nodes.withColumn("up", F.floor(F.col("pos") / ARITY).cast("long"))
    w = Window.partitionBy("grp", "up").orderBy("pos")
    slot = F.col("pos") - F.col("up") * ARITY
    run = F.least(F.lit(ARITY), F.col("n") - F.col("up") * ARITY)
    before = [F.when(slot >= k, F.lag("node", k).over(w)) for k in range(ARITY - 1, 0, -1)]
    after = [F.when(slot + k < run, F.lead("node", k).over(w)) for k in range(1, ARITY)]
    return d.withColumns({"left": F.concat_ws("", *before), "right": F.concat_ws("", *after)})


def built(nodes: DataFrame) -> list[DataFrame]:
    """The levels of each group's tree above its written leaves ``nodes`` (``grp, pos, n, node``); a group ends where ``n`` is 1."""
    most = nodes.agg(F.max("n")).scalar()
    n, levels = nodes.sparkSession.range(1).select(most.alias("n")).first()["n"] or 0, [nodes]
    while n > 1:
        n = -(-n // ARITY)
        first = siblings(levels[-1].where("n > 1")).where(F.col("pos") == F.col("up") * ARITY)  # a run's first child makes the parent
        parents = first.select("grp", F.col("up").alias("pos"), F.ceil(F.col("n") / ARITY).alias("n"), F.sha2(F.concat("node", "right"), 256).alias("node"))
        levels.append(cut(parents))
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """``grp, node``: each group's root."""
    out = levels[0].where("n = 1").select("grp", "node")
    for level in levels[1:]:
        out = out.unionByName(level.where("n = 1").select("grp", "node"))
    return out


def paths(levels: list[DataFrame], over: DataFrame) -> DataFrame:
    """The leaves with ``path``, their siblings from the bottom up, and ``top``, their group's root.

    ``over`` (``grp, path, top``) says what stands over each group's root. Paths go down a level at
    a time, each node's to its 16 children at most, so a large group is no large key.
    """
    down = None
    for level in reversed(levels):
        here = level.where("n = 1").drop("path").join(over, "grp")
        if down is not None:
            parents = down.select("grp", F.col("pos").alias("up"), F.col("path").alias("above"), "top")
            inner = siblings(level.where("n > 1")).join(parents, ["grp", "up"])
            step = F.array(F.struct("left", "right")).cast(_PATH)
            inner = inner.withColumn("path", F.concat(step, "above")).drop("left", "right", "up", "above")
            here = here.unionByName(inner)
        down = cut(here) if level is not levels[0] else here
    return down


def proofs(leaves: DataFrame, *, group: str = "source", order: str = "doc_id") -> DataFrame:
    """``leaves`` (``leaf``, ``now``: the leaf as it is found, ``group``, ``order``) with their proofs.

    Adds ``subroot``, ``root``, ``path`` (array of the siblings on the left and on the right, from
    the leaf's run up to the root's) and ``folded_root``, recomputed from ``now``. Groups go by the
    bytes of their names, a null one first and apart from an empty name; leaves by ``order``, nulls
    first, and by digest where it repeats, so equal rows are neighbours and any order of them gives
    the same tree. A lone leaf is its group's root, a lone group's root is the root. No row, no root.
    """
    key = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    rows = cut(leaves.withColumn("grp", key))
    nodes = cut(placed(rows, "grp", order, "leaf", "now").withColumn("node", F.col("leaf")))
    levels = built(nodes)
    subroots = cut(tops(levels).select(F.lit("").alias("all"), "grp", "node"))
    second = cut(placed(subroots, "all", "grp").select(F.col("all").alias("grp"), "pos", "n", "node", F.col("grp").alias("of")))
    above = built(second)
    root = cut(tops(above))
    none = F.array().cast(_PATH)
    over = paths(above, root.select("grp", none.alias("path"), F.col("node").alias("top")))
    tree = paths(levels, cut(over.select(F.col("of").alias("grp"), "path", F.col("node").alias("top"))))
    the_root = root.select("node").agg(F.max("node")).scalar()
    folded = F.aggregate("path", F.col("now"), lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]), 256))
    return tree.withColumns({"folded_root": folded, "root": the_root}).withColumnRenamed("top", "subroot").drop("grp", "pos", "n", "node")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, subroots, root and proofs of all ``documents``, checked against rows of which every fifth (by CRC) is lower-cased.

    Nulls are values of their own, empty texts have the count 0, texts of any length are digested
    whole, a null id is never tampered with, and other columns are not looked at.
    """
    d = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", source="source", lang="lang", n_chars="n_chars", text="text")
    said = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    small = F.translate("text", _UPPER, _LOWER)
    changed = hit & F.col("text").rlike("[A-Z]")
    d = d.select("doc_id", "source", leaf(*said, F.col("text")).alias("leaf"), F.when(changed, leaf(*said, small)).alias("now"))
    p = proofs(d.withColumn("now", F.coalesce("now", "leaf")))
    others = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    return p.select("doc_id", "leaf", "subroot", "root", F.sha2(others, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql(depth: int = 5, above: int = 3) -> str:
    """DuckDB SQL of the query for sources of at most 16**depth rows, and 16**above sources."""
    crc = "xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)), 4294967295)"
    value = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    row = lambda text: "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    out = [
        f"d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS g, {row('text')} AS leaf, CASE WHEN coalesce((SELECT {crc} FROM (SELECT CAST(doc_id AS VARCHAR) AS s)) % 5 = 0, false) THEN {row(f'''translate(text, '{_UPPER}', '{_LOWER}')''')} ELSE {row('text')} END AS now FROM documents)",
        "a0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, now) - 1 AS i, leaf AS h FROM d)",
    ]

    def climb(name: str, levels: int) -> None:
        for k in range(levels):
            out.append(f"{name}r{k} AS (SELECT g, i // 16 AS i, list(h ORDER BY i) AS run, max(sum(1)) OVER (PARTITION BY g) AS most, sum(count(*)) OVER (PARTITION BY g) AS n FROM {name}{k} GROUP BY g, i // 16)")
            out.append(f"{name}{k + 1} AS (SELECT g, i, CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS h FROM {name}r{k})")

    climb("a", depth)
    out.append(f"b0 AS (SELECT '' AS g, g AS source, h, row_number() OVER (ORDER BY g) - 1 AS i FROM a{depth})")
    climb("b", above)
    step = lambda f, i, k, r: f"CASE WHEN {r}.n = 1 THEN {f} ELSE sha256(array_to_string({r}.run[:{i} // {16**k} % 16], '') || {f} || array_to_string({r}.run[{i} // {16**k} % 16 + 2:], '')) END"
    proof = lambda i, k, r: f"CASE WHEN {r}.n = 1 THEN '' ELSE array_to_string({r}.run[:{i} // {16**k} % 16], '') || array_to_string({r}.run[{i} // {16**k} % 16 + 2:], '') END"
    out.append("p0 AS (SELECT doc_id, leaf, now AS f, '' AS proof, a0.i, a0.g, b0.h AS subroot, b0.i AS j FROM a0 JOIN b0 ON b0.source = a0.g)")
    k = 0
    for name, levels, i, g in (("a", depth, "i", "p.g"), ("b", above, "j", "''")):
        for at in range(levels):
            out.append(f"p{k + 1} AS (SELECT doc_id, leaf, subroot, p.i, j, p.g, {step('f', f'p.{i}', at, 'r')} AS f, proof || {proof(f'p.{i}', at, 'r')} AS proof FROM p{k} p JOIN {name}r{at} r ON r.g = {g} AND r.i = p.{i} // {16 ** (at + 1)})")
            k += 1
    return f"WITH {', '.join(out)} SELECT doc_id, leaf, subroot, (SELECT h FROM b{above}) AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = (SELECT h FROM b{above}) AS verified FROM p{k}"


OP11_SQL = _sql()
