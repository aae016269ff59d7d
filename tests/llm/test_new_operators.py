"""Whitening, conversation repair and the Jaccard join against brute force, on small and odd tables."""

import collections
import hashlib
import random

import duckdb
import numpy as np
import pytest

from connscore.llm import common as C
from connscore.llm import conversation_repair as repair
from connscore.llm import jaccard_join as join
from connscore.llm import near_dedup, whitening
from connscore.llm.components import components, thinned
from connscore.llm.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"
CLASH = "n_words long, result string, __n string, kept string, node string, label string, `a b.c` string"
CLASHING = (1, "x", "y", "z", "n", "l", "d")


def oracle(key, name, df):
    con = duckdb.connect()
    con.register(name, df.toArrow())
    out = con.sql(ORACLE_SQL[key])
    return sorted(map(str, map(tuple, out.select(*sorted(out.columns)).fetchall())))


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


# op11

def whole(vectors):
    return [[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for v in vectors]


def test_whitening_against_eigh(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 20)) * np.linspace(0.2, 3, 20)
    good = [(i, base[i % 40].tolist()) for i in range(55)] + [(None, base[1].tolist())]
    bad = [(90, None), (91, [None] + [1.0] * 19), (92, [float("nan")] * 20), (93, [float("inf")] * 20)]
    df = spark.createDataFrame([(i, v, *CLASHING) for i, v in good + bad],
                               "vec_id long, embedding array<double>, " + CLASH)
    got = collections.defaultdict(list)
    for r in whitening.whiten(df).collect():
        got[r.vec_id].append(r)
    x = np.array(whole([v for _, v in good]), float)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1][:16], q[:, ::-1][:, :16]
    want = (x - s / n) @ q / np.sqrt(e)
    signs = None
    assert set(got) == {i for i, _ in good}
    for (i, _), w, row in zip(good, want, x, strict=True):
        mine = sorted((r for r in got[i]), key=lambda r: r.component)
        # equal vectors give equal rows, so any copy stands for the others
        mine = [r for k, r in enumerate(mine) if not k or r.component != mine[k - 1].component]
        assert [r.component for r in mine] == list(range(1, 17))
        value = np.array([r.whitened for r in mine])
        signs = np.sign(value * w) if signs is None else signs
        assert np.allclose(value, w * signs, atol=1e-8)
        assert {(r.n, r.deviation) for r in mine} == {(n, sum(int(n * a - b) ** 2 for a, b in zip(row, s, strict=True)))}
        assert np.allclose([r.explained for r in mine], e / np.trace(centred.T @ centred / n), rtol=1e-9)
        assert all(r.identity_error < 1e-9 for r in mine)


def test_whitening_lengths_constants_large_values_and_nothing(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(i, [float(i), float(i * i)]) for i in range(6)] + [(10 + i, [float(i % 3), 1.0, 2.0]) for i in range(6)]
    out = whitening.whiten(spark.createDataFrame([*rows, (30, []), (31, [7.0])], schema)).collect()
    assert {(r.vec_id < 10, r.component) for r in out} == {(True, 1), (True, 2), (False, 1)}
    assert {r.n for r in out} == {6, 3} and all(r.identity_error < 1e-9 for r in out)
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    huge = whitening.whiten(spark.createDataFrame([(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [0.0, 3.0])], schema)).collect()
    assert {r.vec_id for r in huge} == {0, 1, 2} and all(r.deviation is None for r in huge if r.vec_id < 2)
    ints = spark.createDataFrame([(i, [i, -i * i]) for i in range(5)], "vec_id long, embedding array<int>")
    assert whitening.whiten(ints).count() == 10


def test_whitening_sums_do_not_follow_the_partitioning(spark):
    df = C.table(spark, SF, "embeddings")
    exact, near = ["vec_id", "component", "n", "deviation", "explained"], ["whitened"]
    one, many = (whitening.whiten(d).orderBy("vec_id", "component").toPandas() for d in (df.coalesce(1), df.repartition(7)))
    assert one[exact].equals(many[exact])
    assert np.allclose(one[near], many[near], rtol=0, atol=1e-12)


@pytest.mark.parametrize("d", [1, 2, 5, 33, 120])
def test_components_by_divide_and_conquer(d):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((d, d)) * np.exp(2 * rng.standard_normal(d))
    v = a.T @ a / d
    e, q = whitening.leading_components(v, 16)
    want = np.linalg.eigvalsh(v)[::-1][:16]
    assert np.allclose(e, want, rtol=0, atol=1e-13 * want[0])
    assert np.allclose(q.T @ q, np.eye(len(e)), atol=1e-13)
    assert np.abs(v @ q - q * e).max() < 1e-13 * want[0]
    sign = whitening.polar_factor(v - np.median(np.linalg.eigvalsh(v) + 1e-3) * np.eye(d))
    assert np.allclose(sign @ sign, np.eye(d), atol=1e-10)


def test_equal_eigenvalues():
    for v in (np.eye(5), np.diag([3.0, 3, 1, 1, 0]), np.ones((6, 6)), np.zeros((3, 3))):
        e, q = whitening.leading_components(v, 16)
        assert np.allclose(e, np.linalg.eigvalsh(v)[::-1], atol=1e-12)
        assert np.allclose(q.T @ q, np.eye(len(v)), atol=1e-12)


def test_wide_sums():
    rng = np.random.default_rng(0)
    parts = [rng.integers(-(1 << 62), 1 << 62, (3, 4)) for _ in range(50)]
    total = whitening.Wide()
    for p in parts:
        total = total.plus(p)
    assert (total.whole() == sum(p.astype(object) for p in parts)).all()
    y = rng.integers(-(1 << 40), 1 << 40, (20, 3))
    assert (whitening._gram(y).astype(object) == y.astype(object).T @ y.astype(object)).all()


# op12

def conversations(spark, seed, many=120):
    random.seed(seed)
    texts = ["Yes.", "no", "", "  \t", "a b!", "cut off", "Why? ", None, "é中."]
    rows = []
    for c in range(many):
        for t in range(random.randrange(9)):
            rows.append((c if c else None, random.choice([t, t, t, t + 1, None]),
                         random.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
                         random.choice(texts), *CLASHING))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, " + CLASH)


@pytest.mark.parametrize("seed", range(3))
def test_repair_equals_sql_on_odd_rows(spark, seed):
    df = conversations(spark, seed)
    got = repair.repair(repair.damaged(df), "gone")
    assert rows_of(got) == oracle("op12_conversation_repair", "conversations", df.select("conv_id", "turn", "role", "text"))


def test_repair_equals_sql_on_whole_table_and_on_none(spark):
    df = C.table(spark, SF, "conversations")
    assert rows_of(repair.repair(repair.damaged(df), "gone")) == oracle("op12_conversation_repair", "conversations", df)
    assert repair.repair(repair.damaged(df.limit(0)), "gone").count() == 0


def cheapest(rows):
    """Every audit in order of (cost, audit) over plain strings of letters, by a search over whole sequences."""
    import heapq
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, letters, lines = heapq.heappop(heap)
        state = letters if len(letters) < 2 or letters[-1:] != "a" else "a"
        state = "".join(dict.fromkeys(letters[:1])) + letters[-1:] + str(len(letters) > 1)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and (not letters or letters[-1] == "a"):
            return cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()
        last = letters[-1:]
        fits = {"u": last in ("", "s", "a"), "a": last == "u", "s": last == ""}
        for t, name in (("u", "user"), ("a", "assistant")):
            if fits[t]:
                heapq.heappush(heap, (cost + 3, audit + "I", i, letters + t, (*lines, f"{name}:")))
        if i == len(rows):
            continue
        role, text, must, cut = rows[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, letters, lines))
        if must:
            continue
        extra = 3 if cut else 0
        if fits.get(role[:1]):
            heapq.heappush(heap, (cost + extra, audit + "K", i + 1, letters + role[0], (*lines, f"{role}:{text}")))
        for t, name in (("u", "user"), ("a", "assistant")):
            if fits[t]:
                heapq.heappush(heap, (cost + extra + 3, audit + "R", i + 1, letters + t, (*lines, f"{name}:{text}")))


def parsed(rows):
    p = repair.Parse(repair.Table())
    for r in rows:
        p.read(*r)
    return p.best()


def test_parse_against_a_search_over_sequences():
    random.seed(5)
    for _ in range(400):
        rows = [(random.choice(["user", "assistant", "system", "tool"]), f"t{i}", random.random() < 0.2,
                 random.random() < 0.3) for i in range(random.randrange(7))]
        assert parsed(rows) == cheapest(rows)


def test_long_conversations_keep_running_hashes(monkeypatch):
    random.seed(6)
    for roles in (["user"], ["assistant", "user"], ["user", "assistant", "system", "tool"]):
        rows = [(random.choice(roles), f"t{i}", random.random() < 0.1, random.random() < 0.2) for i in range(700)]
        results = []
        for flush in (3, 64, 10 ** 9):
            monkeypatch.setattr(repair, "FLUSH", flush)
            results.append(parsed(rows))
        assert results[0] == results[1] == results[2]


def test_parse_holds_few_stacks():
    p = repair.Parse(repair.Table())
    for i in range(1000):
        p.read(random.choice(["user", "assistant", "system"]), "x", False, False)
        assert len(p.tops) <= 12


# op13

def brute_components(rows):
    low = {c: c + 32 for c in range(65, 91)}
    sets = []
    for _, t in rows:
        w = (t or "").translate(low).encode().split()
        sets.append(frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset())
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    least = {}
    for (d, _), r in zip(rows, root, strict=True):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return collections.Counter((d, len(s), least.get(r)) for (d, _), s, r in zip(rows, sets, root, strict=True))


def near_copies(seed, groups=6, copies=15, edits=5):
    random.seed(seed)
    rows, k = [], 0
    for g in range(groups):
        n = random.choice([3, 4, 9, 40, 120, 300])
        base = [f"w{g}x{random.randrange(200)}" for _ in range(n)]
        for _ in range(copies):
            w = list(base)
            for _ in range(random.randrange(edits)):
                w[random.randrange(len(w))] = random.choice(["New", "word", f"u{k}"])
            if random.random() < 0.3:
                w += [f"tail{k}"] * random.randrange(20)
            rows.append((k, " ".join(w)))
            k += 1
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_join_equals_all_pairs(spark, seed):
    rows = near_copies(seed) + [(None, "A b C d"), (900, "a B c D"), (901, None), (902, " "), (903, "one"), (904, "ONE"),
                                (905, " ".join(f"l{i}" for i in range(30_000))), (905, "one")]
    df = spark.createDataFrame([(i, t, *CLASHING) for i, t in rows], "doc_id long, text string, " + CLASH)
    got = collections.Counter(map(tuple, join.jaccard_components(df).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == brute_components(rows)
    assert join.jaccard_components(df.limit(0)).count() == 0


def test_join_with_dealt_trees_and_only_trees(spark, monkeypatch):
    rows = near_copies(9, groups=3, copies=60, edits=9)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole, want = join.tree_pairs, brute_components(rows)
    monkeypatch.setattr(join, "tree_pairs", lambda members, bitmaps: whole(members, bitmaps, 7))
    assert collections.Counter(map(tuple, join.jaccard_components(df).collect())) == want
    # without the first comparisons the trees alone must find every link
    monkeypatch.setattr(join, "_first_pairs", lambda rows: rows.select("node", "node").toDF("a", "b").limit(0))
    assert collections.Counter(map(tuple, join.jaccard_components(df).collect())) == want


def test_traversal_leaves_every_linking_pair():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 150).astype(np.uint64)
    sets = []
    for _ in range(90):
        keep = rng.random(150) > rng.choice([0.02, 0.1, 0.5])
        sets.append(np.unique(np.concatenate([base[keep], rng.integers(0, 1 << 62, rng.integers(0, 20)).astype(np.uint64)])))
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    bits, packed = join._bitmaps(np.concatenate(sets), owner, size)
    edge = np.concatenate(([0], np.cumsum(bits // 8)))
    maps = [packed[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
    label = np.arange(len(sets))
    label[:20] = 0
    trees = join._trees(maps, size, label, size, np.arange(len(sets)))
    found = {tuple(sorted(p)) for v in trees for w in trees if v == w or 2 * v == w
             for a, b in join.dual_traversal(trees[v], trees[w]) for p in zip(a.tolist(), b.tolist(), strict=True)}
    want = {(i, j) for j in range(len(sets)) for i in range(j)
            if join.linked(sets[i], sets[j]) and label[i] != label[j]}
    assert want <= found
    assert not any(label[i] == label[j] for i, j in found)
    assert len(found) < 0.5 * len(sets) ** 2 / 2


def test_thinned_links_keep_components(spark):
    random.seed(1)
    links = [(random.randrange(40), 40 + random.randrange(200)) for _ in range(600)] + [(500, 501), (7, 8)]
    df = spark.createDataFrame(links, "a long, b long")
    whole, thin = (sorted(map(tuple, components(x).collect())) for x in (df, thinned(df)))
    assert whole == thin
    assert thinned(df).count() < df.distinct().count()


# op7 at scale

def test_near_dedup_work_grows_with_the_group(spark):
    """Members linked to the head go nowhere else; those left over meet the group in blocks."""
    def members(n, rest):
        return spark.createDataFrame([("g", i, i >= rest) for i in range(n)], "label string, node long, main boolean")
    assert near_dedup.group_places(members(4000, 0)).count() == 0
    for n, rest in ((2000, 10), (4000, 10), (8000, 10)):
        assert near_dedup.group_places(members(n, rest)).count() == n + rest * -(-n // 500)
    whole = near_dedup.group_places(members(1300, 700)).collect()
    tasks = collections.Counter((r.part, r.block) for r in whole)
    assert len(tasks) == 2 * 3 and max(tasks.values()) <= 1000
    small = near_dedup.group_places(members(30, 2)).collect()
    assert {(r.part, r.block, r.role) for r in small} == {(0, 0, 0)} and len(small) == 30
