import numpy as np
import pytest
from quarry.llm import ann, pq

SCHEMA = "vec_id long, embedding array<float>, component_id int, score int"


def clouds(seed=1):
    """Random vectors, tight groups, a loose group around the threshold, copies, a chain."""
    g = np.random.default_rng(seed)
    x = [*g.normal(size=(400, 24))]
    for spread in (0.02, 0.2, 0.3, 0.34):
        c = g.normal(size=24)
        x += [*(c + spread * g.normal(size=(60, 24)))]
    c = g.normal(size=24)
    for _ in range(12):
        c = c / np.linalg.norm(c) + 0.085 * g.normal(size=24)
        x.append(c)
    x += [x[0] * 3, x[1], x[1], x[1], x[7]]
    x = np.array(x, np.float32)[g.permutation(len(x))]
    return [(i * 3, v.tolist(), 0, 0) for i, v in enumerate(x)]


ODD = [(5001, None, 0, 0), (5002, [0.0] * 24, 0, 0), (5003, [float("nan")] + [1.0] * 23, 0, 0), (5004, [None] + [1.0] * 23, 0, 0),
       (5005, [float("inf")] + [1.0] * 23, 0, 0), (5006, [1.0, 2.0], 0, 0), (5007, [], 0, 0), (5008, [1e-30] * 24, 0, 0), (5009, [1e-30] * 24, 0, 0), (None, [1.0] * 24, 0, 0)]


def usable(rows):
    return [r for r in rows if r[0] is not None and r[1] and len(r[1]) == 24 and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]


def brute_links(rows):
    good = usable(rows)
    x, ids = np.array([r[1] for r in good], np.float64), [r[0] for r in good]
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    link = x @ x.T >= 0.9
    np.fill_diagonal(link, False)
    least = np.array(ids)
    while True:
        new = np.minimum(least, np.where(link, least, 1 << 60).min(axis=1))
        if (new == least).all():
            break
        least = new
    out = {i: (int(n), int(c)) for i, n, c in zip(ids, link.sum(axis=1), least)}
    return sorted(((r[0], *out.get(r[0], (0, r[0])), out.get(r[0], (0, r[0]))[1] == r[0]) for r in rows), key=str)


@pytest.mark.parametrize("shelf", [8192, 50])
def test_links_and_components_match_brute_force(spark, monkeypatch, shelf):
    monkeypatch.setattr(pq, "SHELF", shelf)  # 50: lists are cut, most pairs meet as visits
    rows = clouds() + ODD
    got = pq.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect()), key=str) == brute_links(rows)


def test_nothing_usable_and_nothing_at_all(spark):
    df = spark.createDataFrame(ODD[:5], SCHEMA)
    assert {tuple(r)[1:] for r in pq.near_duplicates(df).collect()} == {(0, i, True) for i in range(5001, 5006)}
    assert pq.near_duplicates(df.limit(0)).count() == 0
    assert ann.search(df, df.vec_id > 0).count() == 0 and ann.search(df.limit(0), df.vec_id > 0).count() == 0


def test_adc_bound_never_loses_a_pair():
    g = np.random.default_rng(0)
    x = pq.unit(g.normal(size=(3000, 24)))
    q = pq.Quantiser.fit(x)
    near, codes = q.encode(x)
    point = q.coded(near, codes)
    error = np.sqrt(((x - point) ** 2).sum(axis=1))
    y = pq.unit(x + 0.05 * g.normal(size=x.shape))
    linked = (x * y).sum(axis=1) >= 0.9
    assert linked.all() and (np.sqrt(((y - point) ** 2).sum(axis=1)) <= pq._RADIUS + error).all()
    probes = q.probes(y)
    assert probes[np.arange(len(x)), near][linked].all()


def brute_search(rows, every, k):
    good = usable(rows)
    x, ids = np.array([r[1] for r in good], np.float64), np.array([r[0] for r in good])
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = (x * x[i]).sum(axis=1)
        best = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in best]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_search_with_all_leaves_is_exact_with_ties_by_id(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 40)
    monkeypatch.setattr(ann, "calibrate", lambda *a: 64)
    rows = clouds() + ODD
    df = spark.createDataFrame(rows, SCHEMA)
    got, want = found(ann.search(df, df.vec_id % 20 == 0, 7)), brute_search(rows, 20, 7)
    assert {q: [v for v, _ in x] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in want.items()}
    for q, x in got.items():
        assert [s for _, s in x] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_fewer_candidates_than_wanted(spark):
    rows = clouds()[:10]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {q: [v for v, _ in x] for q, x in found(ann.search(df, df.vec_id % 3 == 0, 20)).items()} == {
        q: [v for v, _ in x] for q, x in brute_search(rows, 3, 20).items()}


def test_calibrated_recall(spark, small_dir):
    df = spark.read.parquet(f"{small_dir}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    x, ids = np.array([r[1] for r in rows], np.float64), np.array([r[0] for r in rows])
    hit = total = 0
    for q, got in found(ann.search(df, df.vec_id % 20 == 0, 20)).items():
        i = int(np.flatnonzero(ids == q)[0])
        s = x @ x[i]
        want = {int(v) for v in ids[np.argsort(-np.where(ids == q, -np.inf, s))[:20]]}
        hit += len(want & {v for v, _ in got})
        total += 20
    assert hit >= 0.93 * total


def two_lengths():
    """Two thirds of the vectors have 24 components, one third 8."""
    long, g = clouds(), np.random.default_rng(5)
    c = g.normal(size=(20, 8))
    x = np.array([*g.normal(size=(150, 8)), *np.repeat(c, 5, axis=0) + 0.1 * g.normal(size=(100, 8))], np.float32)
    x = np.array([*x, x[0], x[0], x[1]])
    short = [(10_000 + 2 * i, v.tolist(), 0, 0) for i, v in enumerate(x)]
    return long, short


def test_vectors_of_each_length_are_linked(spark):
    long, short = two_lengths()
    pad = [(i, v + [0.0] * 16, a, b) for i, v, a, b in short]
    got = sorted(map(tuple, pq.near_duplicates(spark.createDataFrame(long + short + ODD, SCHEMA)).collect()), key=str)
    want = sorted(brute_links(long + ODD) + brute_links(pad), key=str)
    assert got == want and sum(r[1] > 0 for r in want if r[0] and r[0] >= 10_000) > 100


def test_one_name_for_vectors_of_two_lengths(spark):
    rows = [(7, [1.0, 2.0], 0, 0), (3, [1.0, 2.0], 0, 0), (7, [1.0, 2.0, 3.0], 0, 0), (5, [1.0, 2.1, 3.0], 0, 0), (9, [1.0], 0, 0)]
    got = sorted(map(tuple, pq.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got[0][1:] == (1, 3, True) and got[-1] == (9, 0, 9, True) and [r[1] for r in got[1:-1]] == [1, 1, 1] and len(got) == 5


def test_queries_of_each_length_are_answered(spark, monkeypatch):
    monkeypatch.setattr(ann, "calibrate", lambda *a: 64)
    long, short = two_lengths()
    df = spark.createDataFrame(long + short + ODD, SCHEMA)
    want = brute_search(long, 20, 7) | brute_search([(i, v + [0.0] * 16, a, b) for i, v, a, b in short], 20, 7)
    got = found(ann.search(df, df.vec_id % 20 == 0, 7))
    assert {q: [v for v, _ in x] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in want.items()}
    assert sum(q >= 10_000 for q in got) >= 20
