"""Links and components of embeddings against all products."""

import numpy as np
import pytest

from flowtables.llm import embedding_dedup as ed


def brute(rows, threshold=0.9):
    n = len(rows)
    unit = [None] * n
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float) / max(abs(x) for x in v)
            unit[i] = x / np.linalg.norm(x)
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    links = [0] * n
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                up[top(i)] = top(j)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [v for j, (v, _) in enumerate(rows) if top(j) == top(i) and v is not None]
        least = min(ids) if ids else None
        out.append((vec_id, links[i], least, vec_id == least))
    return sorted(out, key=str)


def made(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, "n") for i, v in rows], "vec_id long, embedding array<double>, nid long, label int, key string").repartition(3)


def got(spark, rows, **more):
    return sorted((tuple(r) for r in ed.near_embeddings(made(spark, rows), **more).collect()), key=str)


def family(rng, n, noise, size=16):
    base = rng.standard_normal(size)
    base /= np.linalg.norm(base)
    return [(base + noise * rng.standard_normal(size) / np.sqrt(size)).tolist() for _ in range(n)]


def odd():
    return [(900, None), (901, []), (902, [0.0] * 16), (903, [1.0, None] * 8), (904, [float("nan")] * 16), (905, [float("inf")] * 16), (906, [1e-300] * 16), (907, [2e300] * 16), (908, [1.0] * 15), (None, [1.0] * 16), (None, [1.0, -1.0] * 8), (906, [3.0] * 16)]


@pytest.mark.parametrize("block, window", [(2000, 512), (8, 4)])
def test_links_and_components_match_brute_force(spark, monkeypatch, block, window):
    """Also with components larger than a block, some of whose members are far from the centroid."""
    monkeypatch.setattr(ed, "BLOCK", block)
    rng = np.random.default_rng(5)
    vectors = family(rng, 40, 0.2) + family(rng, 30, 0.42) + family(rng, 3, 0.1) + rng.standard_normal((40, 16)).tolist()
    vectors += [vectors[0]] * 5 + [(3 * np.array(vectors[1])).tolist()]
    # A chain of which only neighbours are linked.
    a, b = np.eye(16)[0], np.eye(16)[1]
    vectors += [(np.cos(k / 3) * a + np.sin(k / 3) * b).tolist() for k in range(9)]
    rows = [(i, v) for i, v in enumerate(vectors)] + odd()
    order = np.random.default_rng(6).permutation(len(rows))
    assert got(spark, [rows[i] for i in order], window=window, passes=16) == brute(rows)


def test_empty_and_unusable(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None), (1, None)]) == [(1, 0, 1, True), (1, 0, 1, True)]


def test_pairs_at_the_threshold_are_found(spark):
    """Recall at a cosine just above the threshold among rows many windows apart; closer pairs do better."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((3000, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    z = rng.standard_normal((500, 64))
    z -= (z * base[:500]).sum(1)[:, None] * base[:500]
    z /= np.linalg.norm(z, axis=1)[:, None]
    near = 0.901 * base[:500] + np.sqrt(1 - 0.901**2) * z
    rows = [(i, v) for i, v in enumerate(np.concatenate([base, near]).tolist())]
    found = {r[0]: r for r in got(spark, rows, window=64)}
    assert sum(found[3000 + i][2] == i for i in range(500)) >= 0.95 * 500
    assert sum(r[1] for r in found.values()) >= 0.95 * 1000


def test_bytes_bound_the_cosine():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    scale = np.abs(x).max(1) / 127
    small = np.rint(x / scale[:, None]).astype(np.int8)
    lost = np.sqrt(((x - small * scale[:, None]) ** 2).sum(1))
    rows = ed._Rows(np.arange(200), [a.tobytes() + b.tobytes() for a, b in zip(small, np.stack([scale, lost + 2e-7], 1).astype("<f4"))])
    bound = rows.lost[:, None] + rows.lost[None, :] + rows.lost[:, None] * rows.lost[None, :] + 1e-5
    assert (np.abs(rows.x @ rows.x.T - x @ x.T) <= bound).all()


def test_more_rows_need_more_passes():
    few, many = (ed.passes_for(n, 64, 0.9) for n in (100_000, 10**9))
    assert 2 <= few < many < 100 and ed.passes_for(100, 64, 0.9) == 1
