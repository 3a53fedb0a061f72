import numpy as np
import pytest

from orderlens.llm.embeddings import near_duplicates, passes_for

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, threshold=0.95):
    usable = [
        (i, np.array(v, np.float32).astype(float)) for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = {i: set() for i, _ in usable}
    for i, x in usable:
        for j, y in usable:
            if i != j and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[i].add(j)
    out = {}
    for i, _ in usable:
        seen, todo = {i}, [i]
        while todo:
            todo += (new := links[todo.pop()] - seen)
            seen |= new
        out[i] = (len(links[i]), min(seen))
    return out


@pytest.mark.parametrize("window,block", [(512, 1024), (8, 16)])
def test_equals_brute_force(spark, window, block):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(16).tolist()) for k in range(150)]
    center = rng.standard_normal(16)
    # A group larger than the small window, exact copies, and copies of other lengths.
    rows += [(200 + k, (center + 0.12 * rng.standard_normal(16)).tolist()) for k in range(60)]
    rows += [(300 + k, rows[5][1]) for k in range(20)] + [(400, [2 * x for x in rows[5][1]])]
    odd = [(500, None), (501, []), (502, [0.0] * 16), (503, [1.0, None] * 8),
           (504, [float("nan")] * 16), (505, [float("inf")] + [1.0] * 15)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + odd], SCHEMA)
    got = {r["vec_id"]: r for r in near_duplicates(df, window=window, block=block).collect()}
    want = brute_force(rows)
    assert len(got) == len(rows) + len(odd)
    for i, r in got.items():
        assert (r["n_links"], r["component_id"]) == want.get(i, (0, i)), i
        assert r["kept"] == (r["component_id"] == i)


def test_empty_null_ids_and_repeated_rows(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    v, w = [1.0, 0.0], [0.0, 1.0]
    df = spark.createDataFrame([(2, v, 0), (2, v, 0), (1, v, 0), (None, v, 0), (7, w, 0)], SCHEMA)
    got = sorted((r["vec_id"] or 0, r["n_links"], r["kept"]) for r in near_duplicates(df).collect())
    assert got == [(0, 0, True), (1, 2, True), (2, 2, False), (2, 2, False), (7, 0, True)]


def test_number_of_passes_grows_with_the_logarithm():
    assert passes_for(1) <= passes_for(10**5) < passes_for(10**9) < 200


def around(rng, center, cosine, rows):
    """Unit vectors of about ``cosine`` with each other."""
    noise = rng.standard_normal((rows, len(center)))
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    return cosine**0.5 * center / np.linalg.norm(center) + (1 - cosine) ** 0.5 * noise


# Most unlinked rows around one direction, and rows around many directions.
@pytest.mark.parametrize("cones,size,cosine,block", [(1, 1000, 0.9, 64), (30, 40, 0.85, 8)])
def test_pairs_among_crowded_rows_are_found(spark, cones, size, cosine, block):
    rng = np.random.default_rng(11)
    x = np.concatenate(
        [rng.standard_normal((1200, 64))]
        + [around(rng, rng.standard_normal(64), cosine, size) for _ in range(cones)]
    )
    planted = x[-600::2].copy()
    away = rng.standard_normal(planted.shape)
    away -= planted * ((away * planted).sum(axis=1) / (planted**2).sum(axis=1))[:, None]
    away *= (np.linalg.norm(planted, axis=1) / np.linalg.norm(away, axis=1))[:, None]
    planted = 0.951 * planted + (1 - 0.951**2) ** 0.5 * away
    x = np.concatenate([x, planted]).astype(np.float32)
    unit = x.astype(float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    want = linked.sum(axis=1) - 1
    assert want[-300:].min() >= 1
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], SCHEMA)
    got = near_duplicates(df, window=8, block=block).select("vec_id", "n_links").collect()
    assert dict(got) == dict(enumerate(want.tolist()))
