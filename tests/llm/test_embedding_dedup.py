import numpy as np

from tidemark.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, row string, node long, key string"


def vectors():
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(25):
            base = rng.standard_normal(16)
            for k in range(int(rng.integers(1, 6))):
                noise = rng.standard_normal(16) * rng.choice([0, 0.03, 0.1, 0.2])
                rows.append((n * 37 % 1009, ((base + noise) * (1 + k)).astype(np.float32).tolist(), label, "r", 1, "k"))
                n += 1
    chain = rng.standard_normal(16)
    side = rng.standard_normal(16)
    for k in range(40):  # a chain whose ends don't link
        rows.append((2000 + k, (chain + 0.1 * k * side).astype(np.float32).tolist(), 5, "r", 1, "k"))
    rows += [(3000 + k, [1.0] * 16, 6, "r", 1, "k") for k in range(30)]  # copies
    rows += [(4000, None, 1, "r", 1, "k"), (4001, [0.0] * 16, 1, "r", 1, "k"), (4002, [float("nan")] * 16, 1, "r", 1, "k"),
             (4003, [float("inf"), *[1.0] * 15], 1, "r", 1, "k"), (4004, [], 1, "r", 1, "k"), (4005, [None, *[1.0] * 15], 1, "r", 1, "k"),
             (4006, [1.0, 1.0], 6, "r", 1, "k"), (4007, [1e-30] * 16, 6, "r", 1, "k"), (4008, [1e30] * 16, 6, "r", 1, "k"),
             (None, [1.0] * 16, 7, "r", 1, "k"), rows[0]]
    return rows


def brute_force(rows, threshold=0.98):
    def sound(r):
        return r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    def near(a, b):
        if not (sound(a) and sound(b)) or a[2] != b[2] or len(a[1]) != len(b[1]):
            return False
        x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
        x, y = x / np.abs(x).max(), y / np.abs(y).max()
        return x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold

    linked = [[j for j in range(len(rows)) if j != i and near(rows[i], rows[j])] for i in range(len(rows))]
    label = list(range(len(rows)))
    while True:
        new = [min([label[i], *[label[j] for j in linked[i]]]) for i in range(len(rows))]
        if new == label:
            break
        label = new
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        yield str(r[0]), len(linked[i]), str(min(ids) if ids else None)


def test_matches_brute_force(spark, monkeypatch):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(brute_force(rows))
    assert sum(w[1] for w in want) > 1000
    for tile in (ed.TILE, 8):  # 8: large keys are cut into chunks
        monkeypatch.setattr(ed, "TILE", tile)
        got = ed.embedding_components(df, carry=df.columns).collect()
        assert sorted((str(g.id), g.n_links, str(g.component_id)) for g in got) == want
        assert got[0].row.asDict().keys() == set(df.columns)


def test_empty_table(spark):
    assert ed.embedding_components(spark.createDataFrame([], SCHEMA)).collect() == []


def test_tables_reach_the_recall_asked_for():
    rng = np.random.default_rng(0)
    for classes in (100, 10**6):
        width, tables = ed.table_plan(classes, 0.98, 0.99)
        met = 0
        for _ in range(300):
            x = rng.standard_normal(32)
            x /= np.linalg.norm(x)
            z = rng.standard_normal(32)
            z -= z @ x * x
            y = 0.98 * x + np.sqrt(1 - 0.98**2) * z / np.linalg.norm(z)
            d, o = rng.standard_normal((32, width * tables)), rng.uniform(0, 1, width * tables)
            same = (np.floor(x @ d + o) == np.floor(y @ d + o)).reshape(width, tables).all(axis=0)
            met += same.any()
        assert met >= 0.96 * 300
