import numpy as np

from rillflow.llm.media import described, edited, find_copies, linked_images, rendered

SCHEMA = "vec_id long, embedding array<float>, VEC_IDS long"


def rows(n, dim=64, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(size=dim).astype(np.float32).tolist(), i) for i in range(n)]


def brute(images, query):
    """Every image against the query: corners whose bits differ in 14 places at most, agreeing on a turn and shift."""
    q = described(query[None])
    best = {}
    for k in range(len(images)):
        d = described(images[k][None])
        if not len(d["x"]):
            continue
        apart = np.unpackbits((q["bits"][:, None, :] ^ d["bits"][None, :, :]).view(np.uint8), axis=2).sum(2)
        votes = {}
        for a, b in zip(*np.nonzero(apart <= 14)):
            turn = (q["turn"][a] - d["turn"][b]) % 12
            t = turn * np.pi / 6
            f = 1.5 ** (d["scale"][b] - q["scale"][a])
            tx = q["x"][a] - f * (np.cos(t) * d["x"][b] - np.sin(t) * d["y"][b])
            ty = q["y"][a] - f * (np.sin(t) * d["x"][b] + np.cos(t) * d["y"][b])
            for ox in (0, 6):
                for oy in (0, 6):
                    votes.setdefault((turn, f, (tx + ox) // 12, (ty + oy) // 12, ox, oy), set()).add(a)
        if votes and (n := max(map(len, votes.values()))) >= 4:
            best[k] = n
    return best


def test_recall_against_brute_force(spark):
    r = rows(400)
    for k in (37, 38, 39, 40):
        r[k] = (k, r[200][1], k)  # the same image
    got = {(x.query_id, x.match_id): x for x in find_copies(spark.createDataFrame(r, SCHEMA), every=20).collect()}
    images = rendered(np.array([x[1] for x in r]))
    want = set()
    for i in range(0, 400, 20):
        query = edited(images[i][None], np.array([i]))[0]
        want |= {(i, min(k for k in range(400) if r[k][1] == r[m][1])) for m in brute(images, query)}
    assert len(want) >= 20 and len(want & got.keys()) >= 0.9 * len(want)
    own = {i for (i, m), x in got.items() if x.own}
    assert len(own) >= 18 and got[(200, 37)].own


def test_edges(spark):
    flat = [(100, None, 0), (200, [1.0] * 64, 0), (300, [], 0), (None, [0.5] * 64, 0), (400, [float("nan")] * 64, 0)]
    df = spark.createDataFrame(flat + rows(3), SCHEMA)
    assert find_copies(df.unionAll(df)).where("query_id > 0 and match_id < 100").count() == 0
    assert find_copies(df.limit(0)).count() == 0


def test_a_group_of_near_images_costs_a_row_each(spark):
    r = rows(60)
    rng = np.random.default_rng(5)
    for k in range(20, 40):  # near images, four queries among them
        r[k] = (k, (np.array(r[20][1]) + rng.normal(0, 1e-3, 64)).astype(np.float32).tolist(), k)
    r[50] = (50, r[45][1], 50)  # the same image as a query's
    df = spark.createDataFrame(r, SCHEMA)
    pairs = [(x.query_id, x.match_id, x.own) for x in find_copies(df, every=5).collect()]
    assert len(pairs) >= 4 * 18
    root = {k: k for k in range(60)} | {50: 45}
    for _ in range(60):
        for q, m, _own in pairs:
            root[q] = root[m] = min(root[q], root[m])
    root[50] = root[45]
    got = {x.id: x for x in linked_images(df, every=5).collect()}
    assert len(got) == 60 and all(got[k].class_id == root[k] for k in range(60))
    assert all(got[k].n_links == sum(m == (45 if k == 50 else k) for _, m, _own in pairs) for k in range(60))
    assert {k: x.own for k, x in got.items() if x.own is not None} == {k: any(o for q, _, o in pairs if q == k) for k in range(0, 60, 5)}
    assert all(got[k].class_id == 20 for k in range(20, 40))
    doubled = linked_images(df.unionAll(df), every=5).collect()
    assert sorted(doubled) == sorted(got.values()) and linked_images(df.limit(0)).count() == 0
