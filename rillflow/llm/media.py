"""Media columns: local image descriptors that find cropped or edited copies.

Images are grey, square and small (``SIDE`` pixels). Corners are found at several scales, each gets
an orientation and 128 binary intensity tests turned by it. Descriptors are kept in ``TABLES``
Hamming tables, each keyed by ``KEY`` of the 128 bits; queries look up every key at most ``PROBED``
bits from their own. Descriptors at most ``TABLES * (PROBED + 1) - 1`` = ``NEAR`` bits apart differ in
at most ``PROBED`` bits of some key, so none is missed. A bitmap of fixed size tells which keys the index
holds, so only those are looked up; the whole 128 bits decide, and a match of images needs several
corners that agree on one turn, scale and shift.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap, cut, in_bitmap, joined_by_few, pick, table
from .graph import components
from .words import mix

SIDE = 96
SCALES = (1.0, 1.5)
CORNERS = 24  # of each scale, the strongest
REACH = 12  # pixels from a corner to its farthest test
TURNS = 12
NEAR = 14  # bits that matching descriptors may differ in
TABLES = 5
KEY = 25  # bits of a table's key
PROBED = 2  # bits of a key that a look-up may flip; TABLES * (PROBED + 1) > NEAR
CONSENSUS = 4  # corners that must agree
_RNG = np.random.default_rng(7)
_TESTS = np.clip(_RNG.normal(0, REACH / 2.2, (2, 128, 2)), -REACH + 1, REACH - 1)
_ANGLES = np.arange(TURNS) * 2 * np.pi / TURNS
_TURN = np.stack([np.stack([np.cos(_ANGLES), -np.sin(_ANGLES)], -1), np.stack([np.sin(_ANGLES), np.cos(_ANGLES)], -1)], -2)
_PATTERN = np.rint(np.einsum("tij,pkj->tpki", _TURN, _TESTS)).astype(np.int64)  # turn, end, test, (x, y)
_DISC = np.array([(x, y) for x in range(-7, 8) for y in range(-7, 8) if x * x + y * y <= 49])
_FLIPS = np.array([0, *(sum(1 << i for i in c) for n in range(1, PROBED + 1) for c in combinations(range(KEY), n))], np.int64)


@lru_cache(maxsize=4)
def _basis(dim: int) -> np.ndarray:
    """A smooth random pattern of ``SIDE`` x ``SIDE`` pixels for each component, of unit deviation."""
    out = np.random.default_rng(11).normal(size=(dim, SIDE, SIDE))
    for k in range(dim):
        for _ in range(2):
            out[k : k + 1] = _box(out[k : k + 1], 1 + k % 3)
    out -= out.mean(axis=(1, 2), keepdims=True)
    return (out / out.std(axis=(1, 2), keepdims=True)).reshape(dim, -1).astype(np.float32)


def rendered(vectors: np.ndarray) -> np.ndarray:
    """Vectors -> images: their components weigh smooth patterns, so near vectors look alike and others don't.

    A vector without any spread is a flat image.
    """
    v = np.nan_to_num(vectors.astype(np.float64), posinf=0, neginf=0)
    v = v - v.mean(axis=1, keepdims=True) if v.shape[1] else np.zeros((len(v), 1))
    spread = np.sqrt((v * v).sum(axis=1, keepdims=True))
    v = np.where(spread > 1e-9, v / np.maximum(spread, 1e-9), 0)
    shade = 128 + 45 * (v.astype(np.float32) @ _basis(v.shape[1]))
    return np.clip(np.rint(shade), 0, 255).astype(np.uint8).reshape(-1, SIDE, SIDE)


def edited(images: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Cropped, dimmed and overlaid copies; the id says where."""
    out = np.full_like(images, 90)
    for k, i in enumerate(ids):
        dx, dy, quarter = int(i // 100 % 13), int(i // 700 % 13), int(i // 300 % 4)
        part = images[k, dy:, dx:]
        out[k, : part.shape[0], : part.shape[1]] = part * 0.85 + 12
        out[k, 70:84, 8:30] = 128
        out[k] = np.rot90(out[k], quarter)
    return out


def _moved(x: np.ndarray, r: int, axis: int, put: np.ufunc) -> np.ndarray:
    """``put`` over the ``2 * r + 1`` neighbours along an axis, edges repeated."""
    pad = [(0, 0)] * 3
    pad[axis] = (r, r)
    wide, n = np.pad(x, pad, mode="edge"), x.shape[axis]
    part = lambda k: wide[:, k : k + n] if axis == 1 else wide[:, :, k : k + n]
    out = part(0).copy()
    for k in range(1, 2 * r + 1):
        put(out, part(k), out=out)
    return out


def _box(x: np.ndarray, r: int, put: np.ufunc = np.add) -> np.ndarray:
    """Sums (or what ``put`` makes) over squares of ``2 * r + 1`` pixels."""
    return _moved(_moved(x, r, 1, put), r, 2, put)


def described(images: np.ndarray) -> dict[str, np.ndarray]:
    """Images -> their corners: ``image`` (row), ``x``, ``y`` (in full-size pixels), ``scale``, ``turn``, ``bits`` (n x 4 uint32)."""
    parts: list[tuple[np.ndarray, ...]] = []
    for level, scale in enumerate(SCALES):
        side = int(SIDE / scale)
        at = np.minimum((np.arange(side) * scale).astype(int), SIDE - 1)
        whole = images.astype(np.int32)
        im, unit = (_box(whole, 1)[:, at][:, :, at], 9) if scale > 1 else (whole, 1)
        gx, gy = np.zeros_like(im), np.zeros_like(im)
        gx[:, :, 1:-1], gy[:, 1:-1] = im[:, :, 2:] - im[:, :, :-2], im[:, 2:] - im[:, :-2]
        gx, gy = gx.astype(np.float64) / unit, gy.astype(np.float64) / unit
        xx, yy, xy = _box(gx * gx, 2), _box(gy * gy, 2), _box(gx * gy, 2)
        r = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
        peak = _box(r, 2, np.maximum)
        edge = REACH + 2
        inner = np.zeros(r.shape[1:], bool)
        inner[edge:-edge, edge:-edge] = True
        which, y, x = np.nonzero((r == peak) & (r > 1e4) & inner)
        order = np.lexsort((y * side + x, -r[which, y, x], which))
        which, y, x = which[order], y[order], x[order]
        nth = np.arange(len(which)) - np.searchsorted(which, which)
        which, y, x = (c[nth < CORNERS] for c in (which, y, x))
        disc = im[which[:, None], y[:, None] + _DISC[:, 1], x[:, None] + _DISC[:, 0]]
        angle = np.arctan2((disc * _DISC[:, 1]).sum(1), (disc * _DISC[:, 0]).sum(1))
        turn = np.rint(angle / (2 * np.pi / TURNS)).astype(int) % TURNS
        smooth = _box(im, 1)
        p = _PATTERN[turn]
        ends = [smooth[which[:, None], y[:, None] + p[:, e, :, 1], x[:, None] + p[:, e, :, 0]] for e in (0, 1)]
        bits = np.packbits(ends[0] < ends[1], axis=1).view(np.uint32)
        parts.append((which, x * scale, y * scale, np.full(len(x), level), turn, bits.reshape(-1, 4)))
    names = ("image", "x", "y", "scale", "turn", "bits")
    return dict(zip(names, (np.concatenate(c) for c in zip(*parts))))


_CORNER = "id long, x float, y float, scale int, turn int, lo long, hi long"


def places(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Descriptors -> their place in each table: n x TABLES, the table's number above its key."""
    mask, out = np.uint64((1 << KEY) - 1), np.zeros((len(lo), TABLES), np.int64)
    for t in range(TABLES):
        at = t * KEY
        key = lo >> np.uint64(at) if at < 64 else hi >> np.uint64(at - 64)
        if at < 64 < at + KEY:
            key = key | hi << np.uint64(64 - at)
        out[:, t] = (key & mask).astype(np.int64) | t << KEY
    return out


def _batch(cols: list[np.ndarray], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], [c.split()[0] for c in schema.split(", ")])


def _corners(edit: bool):
    """Rows (id, embedding) -> the corners of their images, or of the edited ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            vectors = batch.column("embedding").to_pylist()
            size = max((len(v) for v in vectors if v), default=1)
            for lo in range(0, len(ids), 32):
                part = [np.array([np.nan if e is None else e for e in v or []], float) for v in vectors[lo : lo + 32]]
                images = rendered(np.stack([np.pad(np.nan_to_num(x), (0, size - len(x))) for x in part]))
                d = described(edited(images, ids[lo : lo + 32]) if edit else images)
                words = np.ascontiguousarray(d["bits"]).view(np.uint64)
                yield _batch([ids[lo + d["image"]], d["x"].astype(np.float32), d["y"].astype(np.float32), d["scale"].astype(np.int32), d["turn"].astype(np.int32), *(np.ascontiguousarray(words[:, k]).view(np.int64) for k in (0, 1))], _CORNER)

    return run


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corners -> (place, corner) for each table."""
    for b in batches:
        at = places(*(b.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("lo", "hi")))
        yield _batch([at.T.ravel(), *(np.tile(b.column(c.split()[0]).to_numpy(zero_copy_only=False), TABLES) for c in _CORNER.split(", "))], f"place long, {_CORNER}")


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield _batch([mix(b.column("place").to_numpy(zero_copy_only=False).view(np.uint64)).view(np.int64)], "key long")


def _probes(held: np.ndarray):
    """Corners -> (place, corner) for each place within ``PROBED`` bits of one of their keys that the bitmap holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(c.split()[0]).to_numpy(zero_copy_only=False) for c in _CORNER.split(", ")]
            for a in range(0, b.num_rows, 2000):
                some = [np.ascontiguousarray(c[a : a + 2000]) for c in cols]
                at = (places(some[-2].view(np.uint64), some[-1].view(np.uint64))[:, :, None] ^ _FLIPS).reshape(len(some[0]), -1)
                corner, probe = np.nonzero(in_bitmap(held, mix(at.astype(np.uint64))))
                yield _batch([at[corner, probe], *(c[corner] for c in some)], f"place long, {_CORNER}")

    return run


def _apart(table: int | None = None) -> Column:
    """Bits in which the corners of q and i differ, of the whole descriptors or of a table's key."""
    key = (1 << 128) - 1 if table is None else ((1 << KEY) - 1) << table * KEY
    part = lambda bits: F.lit(bits - (1 << 64) if bits >> 63 else bits)  # noqa: E731  a signed long
    return sum(F.bit_count(F.col(f"q.{k}").bitwiseXOR(F.col(f"i.{k}")).bitwiseAND(part(key >> at & (1 << 64) - 1))) for k, at in (("lo", 0), ("hi", 64)))


def matches(queries: DataFrame, index: DataFrame) -> DataFrame:
    """Corners at their places, of queries and of the index -> ``query_id, match_id, inliers`` of images in consensus.

    Two corners that meet in several tables are paired by the first of those only.
    """
    q, i = queries.alias("q"), index.alias("i")
    table = F.shiftright("q.place", KEY)
    first = [(table <= t) | (_apart(t) > PROBED) for t in range(TABLES - 1)]
    near = q.join(i.hint("merge"), reduce(Column.__and__, first, (F.col("q.place") == F.col("i.place")) & (_apart() <= NEAR)))
    turn = F.pmod(F.col("q.turn") - F.col("i.turn"), F.lit(TURNS))
    a = turn * (2 * np.pi / TURNS)
    factor = F.pow(F.lit(1.5), F.col("i.scale") - F.col("q.scale"))
    tx = F.col("q.x") - factor * (F.cos(a) * F.col("i.x") - F.sin(a) * F.col("i.y"))
    ty = F.col("q.y") - factor * (F.sin(a) * F.col("i.x") + F.cos(a) * F.col("i.y"))
    vote = F.struct(tx.alias("tx"), ty.alias("ty"), F.struct("q.x", "q.y", "q.scale").alias("corner")).alias("vote")
    votes = near.select(F.col("q.id").alias("query_id"), F.col("i.id").alias("match_id"), turn.alias("turn"), (F.col("i.scale") - F.col("q.scale")).alias("zoom"), vote)
    # The votes of two images on one turn and zoom are at most as many as pairs of their few corners.
    agreed = votes.groupBy("query_id", "match_id", "turn", "zoom").agg(F.collect_set("vote").alias("votes")).where(F.size("votes") >= CONSENSUS)
    cell = lambda ox, oy: lambda v: F.struct(F.floor((v.tx + ox) / 12).alias("gx"), F.floor((v.ty + oy) / 12).alias("gy"), v.corner.alias("corner"))
    grids = {f"g{ox}{oy}": F.array_distinct(F.transform("votes", cell(ox, oy))) for ox in (0, 6) for oy in (0, 6)}
    fullest = lambda g: F.array_max(F.transform(g, lambda c: F.size(F.filter(g, lambda d: (d.gx == c.gx) & (d.gy == c.gy)))))
    counted = agreed.select("query_id", "match_id", *(g.alias(n) for n, g in grids.items())).select("query_id", "match_id", F.greatest(*map(fullest, grids)).alias("inliers"))
    return counted.groupBy("query_id", "match_id").agg(F.max("inliers").cast("long").alias("inliers")).where(F.col("inliers") >= CONSENSUS)


def classes(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, class_id``: images with equal pixels' sources share the smallest id. Null vectors are one class.

    A vector that a third of the rows hold isn't gathered in one task.
    """
    v = pick(vectors, id=id_col, embedding=vector_col).select("id", F.xxhash64("embedding").alias("same"))
    groups = cut(v.groupBy("same").agg(F.min("id").alias("class_id"), F.count("*").alias("n")))
    return joined_by_few(v, groups, "same", "n").select("id", "class_id")


def find_copies(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100) -> DataFrame:
    """Edited copies of every row whose id ``every`` divides, searched among all rows.

    The images are rendered from the vectors. Rows with equal vectors are one image and stand for
    each other (``classes`` lists them), so a vector that a third of the rows hold is indexed once.
    Returns ``query_id, match_id`` (a class id), ``inliers`` and ``own`` (whether the match is the
    query's own original). Images without corners, as of null, empty or constant vectors, match
    nothing; null components count as 0; repeated rows ask once; ids are integers, null ones are
    ignored; an empty table gives an empty result; other columns are ignored.
    """
    return _searched(vectors, id_col, vector_col, every)[1]


def _searched(vectors: DataFrame, id_col: str, vector_col: str, every: int) -> tuple[DataFrame, DataFrame]:
    """The ``classes`` of the ids, and what ``find_copies`` finds."""
    v = pick(vectors, id=id_col, embedding=vector_col).where("id is not null").withColumn("id", F.col("id").cast("long"))
    named = cut(classes(v, id_col="id").dropDuplicates(["id"]))
    reps = named.where("id = class_id").select("id")
    asked = cut(v.where(F.col("id") % every == 0).dropDuplicates(["id"]).mapInArrow(_corners(True), _CORNER))
    originals = v.join(reps, "id", "left_semi").dropDuplicates(["id"])
    originals = originals.repartition(int(v.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")  # small rows, but much to compute
    index = cut(originals.mapInArrow(_corners(False), _CORNER)).mapInArrow(_placed, f"place long, {_CORNER}")
    held = bitmap(index.mapInArrow(_mixed, "key long"), F.col("key"), 26)
    found = matches(asked.mapInArrow(_probes(held), f"place long, {_CORNER}"), index)
    return named, found.join(named.select(F.col("id").alias("query_id"), "class_id"), "query_id").select("query_id", "match_id", "inliers", (F.col("match_id") == F.col("class_id")).alias("own"))


def linked_images(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100) -> DataFrame:
    """``id, class_id, n_links, own`` of every image, after the search of ``find_copies``.

    A query links its image with every image that it matches; ``class_id`` is the smallest id that
    links and equal vectors reach, ``n_links`` the number of queries that match the row's image and
    ``own`` whether the row's own edited copy found it (null: the row wasn't asked). So a group of
    near images costs a row each, not a row for each of its queries and images; ``find_copies`` has the pairs.
    """
    named, found = _searched(vectors, id_col, vector_col, every)
    found = cut(found)
    asked = named.select(F.col("id").alias("query_id"), F.col("class_id").alias("a"))
    roots = components(found.join(asked, "query_id").select("a", F.col("match_id").alias("b"))).select(F.col("v").alias("class_id"), "root")
    links = found.groupBy(F.col("match_id").alias("class_id")).agg(F.count("*").alias("n_links"))
    images = cut(named.groupBy("class_id").agg(F.count("*").alias("n")).join(roots, "class_id", "left").join(links, "class_id", "left"))
    each = joined_by_few(named, images, "class_id", "n").join(found.where("own").select(F.col("query_id").alias("id"), "own"), "id", "left")
    own = F.when(F.col("id") % every == 0, F.coalesce("own", F.lit(False)))
    return each.select("id", F.coalesce("root", "class_id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), own.alias("own"))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every image of ``embeddings``: its class under the links that edited copies of every hundredth find among all, how many find it, and whether its own does."""
    return linked_images(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
