"""Code compression, whitening and embedding near-duplicates against brute force, and their edge cases."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from retail_pulse.llm import pqcodes, rabitq, whiten
from retail_pulse.llm.queries import ORACLES

BAD = [(901, None), (902, [1.0, None] + [0.0] * 6), (903, [float("nan")] * 8), (904, [float("inf")] * 8), (905, [])]


def frame(spark, rows, parts=3):
    """(id, vector) or (id, vector, label) rows with columns that clash with the operators' own names."""
    rows = [(*r, r[0] % 3 if r[0] is not None else None)[:3] for r in rows]
    return (spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
            .withColumn("id", F.lit("clash")).withColumn("V", F.lit("clash")).withColumn("item", F.lit("clash")).repartition(parts))


def cloud(n, dim, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.standard_normal(dim) * spread).tolist()) for i in range(n)]


# ---- code compression ----

def simple_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    dim = max((len(v) for _, v, _ in kept), default=0)
    kept = [r for r in kept if len(r[1]) == dim]
    w = dim // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))[:entries]
    books = [[cut[r][p] for r in first] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, c, strict=True)), i) for i, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [near(c[p], books[p])[1] for c in cut]
            for i in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, own, strict=True) if o == i]
                if mine:
                    books[p][i] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out = []
    for (i, _, lab), c in zip(kept, cut, strict=True):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), lab))
    sums = {}
    for _, _, e, lab in out:
        sums[lab] = sums.get(lab, 0) + e
    return sorted(((i, code, e, sums[lab], digest) for i, code, e, lab in out), key=repr)


@pytest.mark.parametrize("n, entries, spread", [(300, 16, 0.2), (40, 256, 1.0), (200, 256, 0.02), (60, 8, 3e5)])
def test_codes_against_brute_force(spark, n, entries, spread):
    rows = [(i, v, (i * i) % 5 or None) for i, v in cloud(n, 8, n, spread)]
    rows += [(i, v, 1) for i, v in BAD] + [(None, [0.1] * 8, None), (7, rows[7][1], 2), (7, rows[9][1], 2), (800, [1.0, 2.0], 3), (801, [-0.0] * 8, None)]
    rows += [(1000 + i, rows[0][1], 4) for i in range(30)]  # a group of copies
    got = pqcodes.compress(frame(spark, rows), entries=entries)
    assert sorted(map(tuple, got.collect()), key=repr) == simple_codes(rows, entries=entries)


def test_slices_hold_every_entry_within_the_radius():
    rng = np.random.default_rng(5)
    book, x = rng.integers(-50, 50, (100, 3)), rng.integers(-60, 60, (500, 3))
    s = pqcodes.Slices(book)
    squared = s.radius(x)
    bits = np.unpackbits(s.candidates(x, squared).view(np.uint8).reshape(500, -1), axis=1, bitorder="little")[:, :100]
    dist = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (dist.min(axis=1) <= squared).all() and (bits[dist <= squared[:, None]] == 1).all()
    assert bits.mean() < 0.35  # in few dimensions the slices leave little to measure
    index, best = s.nearest(x)
    assert (index == dist.argmin(axis=1)).all() and (best == dist.min(axis=1)).all()


def test_codes_of_empty_and_unusable_tables(spark):
    columns = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    for rows in ([], BAD):
        got = pqcodes.compress(spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int"))
        assert got.columns == columns and got.count() == 0
    with pytest.raises(ValueError, match="cut into 4"):
        pqcodes.compress(frame(spark, [(1, [1.0] * 6)]))


# ---- whitening ----

def simple_whitening(rows, k=4, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    dim = max(len(v) for _, v in kept)
    kept = [r for r in kept if len(r[1]) == dim]
    fit = sorted({tuple(v) for _, v in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    c = np.array([[x - s / n for x, s in zip(v, sums, strict=True)] for v in fit])
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    real = e > 1e-12 * np.trace(cov)
    return kept, n, sums, e[real], u[:, real], np.trace(cov)


def check_whitening(got, rows):
    kept, n, sums, e, u, trace = simple_whitening(rows)
    table = {}
    for r in got:
        table.setdefault((r.vec_id, r.deviation, r.component), []).append(r)
        assert r.n == n and 0 <= r.identity_error <= 1e-9 and r.explained == pytest.approx(e[r.component - 1] / trace, rel=1e-9)
    assert len(got) == len(kept) * len(e)
    for c in range(len(e)):
        want = [(i, sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)), float((np.array(v) - np.array(sums) / n) @ u[:, c] / math.sqrt(e[c]))) for i, v in kept]
        have = sorted(((r.vec_id is None, r.vec_id, r.deviation, r.whitened) for r in got if r.component == c + 1), key=lambda r: (r[0], r[1] or 0, r[2], abs(r[3])))
        want = sorted(((i is None, i, d, w) for i, d, w in want), key=lambda r: (r[0], r[1] or 0, r[2], abs(r[3])))
        assert [r[:3] for r in have] == [r[:3] for r in want]
        a, b = np.array([r[3] for r in have]), np.array([r[3] for r in want])
        sign = np.sign(a @ b)
        assert np.abs(a * sign - b).max() < 1e-8


@pytest.mark.parametrize("n, dim", [(400, 8), (150, 64), (30, 40)])
def test_whitening_against_a_dense_solver(spark, n, dim):
    rng = np.random.default_rng(dim)
    scales = np.linspace(1, 3, dim)
    rows = [(i, (rng.standard_normal(dim) * scales + 5).tolist()) for i in range(n)]
    rows += [(500 + i, rows[0][1]) for i in range(100)] + [(None, rows[3][1]), (7, rows[8][1])]  # copies count once
    rows += [(i, v) for i, v in BAD] + [(906, [1.0, 2.0])]
    check_whitening(whiten.whiten(frame(spark, rows)).collect(), rows)


def test_whitening_with_fewer_dimensions_than_components(spark):
    rows = cloud(50, 2, 1)
    check_whitening(whiten.whiten(frame(spark, rows)).collect(), rows)
    flat = [(i, [float(i), 2.0 * i, 1.0]) for i in range(20)]  # rank one
    got = whiten.whiten(frame(spark, flat)).collect()
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1.0)
    for rows in ([], BAD, [(1, [1.0] * 8)] * 3):
        assert whiten.whiten(frame(spark, rows or [(1, None)])).count() == 0


def test_jacobi_davidson_reaches_double_precision():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((200, 200)))[0]
    values = np.linspace(1, 2, 200)
    values[-4:] = [2.0001, 2.0002, 2.5, 9.0]  # close pairs
    a = (q * values) @ q.T
    calls = []
    found = whiten.jacobi_davidson(lambda block: (calls.append(block.shape), a @ block)[1], 200, 4)
    assert np.abs(found.values - values[::-1][:4]).max() < 1e-12 and found.residuals.max() <= 64 * 2.3e-16
    assert np.abs(np.abs((found.vectors * q[:, ::-1][:, :4]).sum(axis=0)) - 1).max() < 1e-10
    assert found.products == len(calls) and max(w for _, w in calls) <= 12  # matrix-free: thin blocks only


def test_deviation_of_large_components_is_exact(spark):
    rows = [(0, [3e7, 1.0]), (1, [-3e7, 2.0]), (2, [1e6, 3.0])]
    got = {r.vec_id: r.deviation for r in whiten.whiten(frame(spark, rows)).where("component = 1").collect()}
    kept, n, sums, *_ = simple_whitening(rows)
    assert got == {i: min(2**63 - 1, sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))) for i, v in kept}


# ---- embedding near-duplicates ----

def simple_links(rows, threshold=0.9):
    good = [r for r, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    unit = {r: np.array(rows[r][1]) / np.linalg.norm(rows[r][1]) for r in good}
    links = [0] * len(rows)
    for x, a in enumerate(good):
        for b in good[x + 1:]:
            if len(unit[a]) == len(unit[b]) and (rows[a][1] == rows[b][1] or float(unit[a] @ unit[b]) >= threshold):
                links[a], links[b] = links[a] + 1, links[b] + 1
                parent[find(a)] = find(b)
    least = {}
    for r, (i, _) in enumerate(rows):
        if i is not None:
            least[find(r)] = min(i, least.get(find(r), i))
    return sorted(((i, links[r], least.get(find(r)), i == least.get(find(r))) for r, (i, _) in enumerate(rows)), key=repr)


def turned(v, degrees, rng):
    """A vector at the given angle of ``v``."""
    u = np.array(v) / np.linalg.norm(v)
    w = rng.standard_normal(len(u))
    w -= (w @ u) * u
    t = math.radians(degrees)
    return (math.cos(t) * u + math.sin(t) * w / np.linalg.norm(w)).tolist()


def planted(seed=0, dim=32):
    rng = np.random.default_rng(seed)
    rows = cloud(300, dim, seed)
    at = 1000
    for base, n, degrees in ((0, 250, 6), (1, 60, 11), (2, 40, 17), (3, 20, 24), (4, 1, 25.7), (5, 1, 26.0), (6, 30, 0)):
        for _ in range(n):
            rows.append((at, turned(rows[base][1], degrees, rng)))
            at += 1
    for degrees in (15, 20, 25, 30, 35):  # near the edge of a large ball
        rows.append((at, turned(rows[0][1], degrees, rng)))
        at += 1
    rows += [(at + i, [3.0 * x for x in rows[7][1]]) for i in range(3)]
    return rows


@pytest.mark.parametrize("block", [2048, 64])
def test_links_and_classes_against_all_pairs(spark, block):
    rows = planted()
    rows += [(i, v) for i, v in BAD] + [(906, [0.0] * 32), (907, [1.0, 2.0]), (908, [2.0, 4.1]), (None, rows[9][1]), (None, None), (9, rows[9][1]), (9, rows[10][1])]
    got = sorted(map(tuple, rabitq.near_duplicates(frame(spark, rows), block=block, recall=0.9999).collect()), key=repr)
    assert got == simple_links(rows)


def test_recall_with_production_parameters(spark):
    rows = planted(1) + [(5000 + i, turned(v, 25.5, np.random.default_rng(i))) for i, v in cloud(300, 32, 1)[50:]]
    want = {r[0]: r[1] for r in simple_links(rows)}
    got = {r.vec_id: r.n_links for r in rabitq.near_duplicates(frame(spark, rows), block=64).collect()}
    assert all(got[i] <= n for i, n in want.items())  # never a link below the threshold
    assert sum(got.values()) >= 0.97 * sum(want.values())
    hard = [i for i in want if i >= 5000 and want[i]]
    assert sum(got[i] > 0 for i in hard) >= 0.9 * len(hard)  # pairs right at the threshold


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((400, 128))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = a * 0.8 + 0.6 * rng.standard_normal(a.shape) / np.sqrt(128)
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    s, _, _, _, f = rabitq.encode(a, 1)
    _, levels, low, step, _ = rabitq.encode(b, 2)
    error = rabitq.estimates(s, f, levels, low, step, 128) - a @ b.T
    assert abs(error.mean()) < 0.002 and abs(np.diag(error).mean()) < 0.01
    assert (np.abs(error) <= rabitq.error_bound(f, step, 128, 3.0)).mean() > 0.995


def test_a_group_of_copies_makes_no_pairs(spark):
    rng = np.random.default_rng(4)
    rows = [(i, turned([1.0] * 16, 5, rng)) for i in range(1500)] + cloud(100, 16, 9)[:0]
    df = frame(spark, rows)
    got = rabitq.near_duplicates(df, block=128)
    assert {(r.n_links, r.component_id) for r in got.collect()} == {(1499, 0)}
    items = df.select(F.col("vec_id").alias("item"), F.col("embedding").alias("v"), F.lit(1).cast("long").alias("weight"))
    balls, home, n = rabitq.gather_balls(rabitq._unit(items), math.acos(0.9) / 2, block=128)
    assert n < 40 and home.count() == 1500  # a third of all rows or more may be one group
    assert rabitq.candidates(balls, n, 0.9, 0.99, 3.0, 128).count() <= n * n / 2


def test_near_duplicates_of_empty_tables(spark):
    for rows in ([], BAD):
        got = rabitq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
        assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert sorted(map(tuple, got.collect())) == [(i, 0, i, True) for i, _ in rows]


def test_sql_of_links_and_codes_on_planted_rows(spark, tmp_dir):
    """The registered SQL finds planted links and codes as the operators do."""
    rows = planted(3)
    random.Random(1).shuffle(rows)
    frame(spark, rows).select("vec_id", "embedding", "label").coalesce(1).write.parquet(f"{tmp_dir}/e")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_dir}/e/*.parquet')")
    df = spark.read.parquet(f"{tmp_dir}/e")
    assert sorted(con.sql(ORACLES["op13_rabitq"]).fetchall()) == sorted(map(tuple, rabitq.near_duplicates(df, recall=0.9999).collect()))
    assert sorted(con.sql(ORACLES["op11_pqcodes"]).fetchall()) == sorted(map(tuple, pqcodes.compress(df).collect()))
