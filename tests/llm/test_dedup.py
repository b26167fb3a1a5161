"""Exact, near and repeated-passage dedup, and vectors, against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from farfield.llm import embedding_dedup, minhash_dedup, suffix_dedup
from farfield.llm import exact_dedup as exact_module
from farfield.llm.components import components
from farfield.llm.exact_dedup import directory, drop_copies, exact_dedup


def rows_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def test_exact(awkward):
    got = exact_dedup(awkward).collect()
    groups = defaultdict(list)
    for i, t in rows_of(awkward):
        groups[hashlib.sha256(t.encode()).hexdigest()].append(i)
    assert len(got) == awkward.count()
    for sha, ids in groups.items():
        own = [r for r in got if r["text_sha256"] == sha]
        best = max((i for i in ids if i is not None), default=None)
        assert Counter(r["doc_id"] for r in own) == Counter(ids)
        assert all(r["keep_id"] == best and r["group_size"] == len(ids) for r in own)
        assert [r["doc_id"] for r in own if r["kept"]] == [best]


def test_exact_drops_all_but_one(awkward):
    kept = drop_copies(awkward)
    texts = [t for _, t in rows_of(kept)]
    assert kept.columns == awkward.columns and len(texts) == len(set(texts)) and set(texts) == {t for _, t in rows_of(awkward)}


def test_exact_of_nothing(nothing):
    assert exact_dedup(nothing).count() == 0 and drop_copies(nothing).count() == 0


def test_exact_by_small_buckets(spark, awkward, monkeypatch):
    """Many buckets, and hashes that collide, give the same; rows are found by the directory alone."""
    want = sorted(map(tuple, exact_dedup(awkward).collect()), key=str)
    assert sorted(map(tuple, exact_dedup(awkward, bucket_rows=2).collect()), key=str) == want
    index = exact_module.Index(awkward, bucket_rows=2)
    buckets = index.buckets.collect()
    assert len({r["bucket"] for r in buckets}) > 10 and max(Counter(r["bucket"] for r in buckets).values()) <= 2
    assert all((r["h"] % 2**64) >> (64 - r["depth"]) << (index.depth - r["depth"]) == r["bucket"] for r in buckets if r["depth"])
    whole = exact_module.F.xxhash64
    monkeypatch.setattr(exact_module.F, "xxhash64", lambda t: exact_module.F.pmod(whole(t), exact_module.F.lit(3)))
    assert sorted(map(tuple, exact_dedup(awkward, bucket_rows=2).collect()), key=str) == want
    monkeypatch.setattr(exact_module, "directory", lambda entries, *a: directory(entries, *a).where("bucket < 0"))
    assert exact_dedup(awkward).count() == 0


def test_exact_keeps_the_same_row_of_twins(spark):
    rows = [(1, "same", "b", "y"), (1, "same", "a", "x"), (1, "same", None, "z"), (0, "same", "a", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = [tuple(drop_copies(docs.repartition(n)).collect()[0]) for n in (1, 2, 3)]
    assert len(set(kept)) == 1 and kept[0][0] == 1


def test_directory_splits_only_full_buckets(spark):
    index = spark.range(4000).selectExpr("xxhash64(id) AS h")
    slots = directory(index, bucket_rows=100, max_depth=10).collect()
    held = index.selectExpr("shiftrightunsigned(h, 54) AS slot").groupBy("slot").count().collect()
    counts = {r["slot"]: r["count"] for r in held}
    for r in slots:
        width = 1 << (10 - r["depth"])
        inside = sum(n for s, n in counts.items() if r["bucket"] <= s < r["bucket"] + width)
        assert r["bucket"] <= r["slot"] < r["bucket"] + width and inside <= 100
        if r["depth"]:
            parent = r["bucket"] // (2 * width) * 2 * width
            assert sum(n for s, n in counts.items() if parent <= s < parent + 2 * width) > 100


def brute_repeats(rows):
    rows = [(i, t.encode()) for i, t in rows]
    first = {}
    for i, t in rows:
        o = -1 if i is None else i
        for s in range(len(t) - 49):
            first[t[s : s + 50]] = min(o, first.get(t[s : s + 50], o))
    out = []
    for i, t in rows:
        o, gone = -1 if i is None else i, [False] * len(t)
        for s in range(len(t) - 49):
            if first[t[s : s + 50]] < o:
                gone[s : s + 50] = [True] * 50
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block, bucket", [(4_000_000, 6_000_000), (300, 500)])
def test_repeats(spark, monkeypatch, block, bucket):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket)
    rng = random.Random(5)
    passages = ["".join(rng.choice("ab ") for _ in range(rng.randint(40, 130))) for _ in range(6)]
    rows = [(i if i != 7 else None, "".join(rng.choice([rng.choice(passages)[rng.randint(0, 30) :], "".join(rng.choice("xyz") for _ in range(rng.randint(0, 40)))]) for _ in range(rng.randint(0, 5)))) for i in range(60)]
    rows += [(100, None), (101, ""), (3, rows[3][1]), (102, "é" * 80), (103, "zé" * 10 + "é" * 80), (104, "a" * 500), (105, "a" * 300)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == brute_repeats([(i, t or "") for i, t in rows])


def test_repeats_of_awkward_rows(awkward, nothing):
    assert sorted(map(tuple, suffix_dedup.remove_repeats(awkward).collect()), key=str) == brute_repeats(rows_of(awkward))
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_multikey_groups():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    text[1000:1200] = text[:200]
    starts = np.arange(2900)
    order, group = suffix_dedup.multikey_groups(suffix_dedup.words_at(np.concatenate([text, np.zeros(8, np.uint8)])), starts)
    strings = [text[s : s + 50].tobytes() for s in starts[order]]
    assert strings == sorted(strings)
    assert all((a == b) == (x == y) for a, b, x, y in zip(strings, strings[1:], group, group[1:], strict=False))


def brute_classes(rows, similar=0.8):
    sets, df = [], Counter()
    for _, t in rows:
        w = t.encode().lower().split()
        s = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()
        sets.append(s)
        df.update(s.keys())
    n, root = len(rows), list(range(len(rows)))
    weigh = lambda k: 1 + minhash_dedup.IDF_SHARE * math.log((1 + n) / (1 + df[k])) / math.log(2 + n)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            low = sum(min(c, sets[j][k]) * weigh(k) for k, c in sets[i].items())
            whole = sum(max(sets[i][k], sets[j][k]) * weigh(k) for k in sets[i].keys() | sets[j].keys())
            if whole and low / whole >= similar:
                root[top(i)] = top(j)
    return [top(i) for i in range(n)]


def test_near_classes(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(60, 200))]
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    rows += [(900, None), (901, ""), (902, "two words"), (903, "Two  WORDS"), (904, rows[0][1])]
    got = {r["doc_id"]: r for r in minhash_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_classes([(i, t or "") for i, t in rows])
    members = defaultdict(set)
    for (i, _), k in zip(rows, want, strict=True):
        members[k].add(i)
    assert len(members) < len(rows)
    for ids in members.values():
        assert {got[i]["class_id"] for i in ids} == {min(ids)} and {got[i]["class_size"] for i in ids} == {len(ids)}
        assert [i for i in ids if got[i]["kept"]] == [min(ids)]


def test_near_classes_of_awkward_rows(awkward, nothing):
    got = minhash_dedup.near_classes(awkward).collect()
    assert len(got) == awkward.count() and sum(r["kept"] for r in got) == len({(r["class_id"], r["class_size"]) for r in got if r["class_size"] > 1}) + sum(r["class_size"] == 1 for r in got)
    assert minhash_dedup.near_classes(nothing).count() == 0


def test_bands_meet_at_the_similarity():
    """Of pairs at a similarity of 0.8 or more nearly all share a band; a sample agrees about as often as the similarity."""
    rng = np.random.default_rng(3)
    agree = []
    for _ in range(150):
        pool = rng.integers(0, 2**63, 220).astype(np.uint64)
        x, y = np.sort(pool[:200]), np.sort(np.concatenate([pool[:178], pool[200:]]))
        w = lambda h: 1 + (h % np.uint64(97)).astype(float) / 97
        agree.append((minhash_dedup.bands(x, w(x)) == minhash_dedup.bands(y, w(y))).sum())
    assert np.mean(np.array(agree) > 0) > 0.98 and 0.25 < np.mean(agree) / minhash_dedup.BANDS < 0.6


def brute_vectors(rows):
    """Links and component of each row (by place), for rows of (id, vector, label)."""
    unit = [None] * len(rows)
    for k, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v):
            x = np.array(v) / np.abs(v).max()
            unit[k] = x / np.linalg.norm(x)
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for k in range(len(rows)):
        for m in range(k):
            if unit[k] is not None and unit[m] is not None and rows[k][2] == rows[m][2] and len(unit[k]) == len(unit[m]) and unit[k] @ unit[m] >= 0.93:
                links[k], links[m] = links[k] + 1, links[m] + 1
                root[top(k)] = top(m)
    least = {}
    for k, r in enumerate(rows):
        least[top(k)] = min(least.get(top(k), math.inf), math.inf if r[0] is None else r[0])
    return [(r[0], links[k], None if r[0] is None else least[top(k)]) for k, r in enumerate(rows)]


def clustered(seed, n, width, spread):
    """Groups of near vectors of many widths, and vectors by themselves."""
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(n // 8, width))
    return heads[rng.integers(0, len(heads), n)] + spread * rng.exponential(size=(n, 1)) * rng.normal(size=(n, width))


@pytest.mark.parametrize("width", [2, 3, 8, 64])
def test_cover_trees_find_exactly_the_links(width):
    a, b = clustered(width, 500, width, 0.15), clustered(width, 300, width, 0.2)
    a[10:40] = a[0] + 0.02 * np.random.default_rng(1).normal(size=(30, width))
    b[5] = a[0]
    for other in (None, b):
        got = embedding_dedup.linked_pairs(a, other)
        every = a if other is None else np.concatenate([a, other])
        unit = every / np.linalg.norm(every, axis=1)[:, None]
        near = unit @ unit.T >= 0.93
        np.fill_diagonal(near, False)
        if other is not None:
            near[:500, :500] = near[500:, 500:] = False
        assert got.links.tolist() == near.sum(1).tolist()
        i, j = np.nonzero(near)
        assert got.roots.tolist() == embedding_dedup.joined(len(every), i, j).tolist()


def test_levels_are_nested_covers():
    unit = embedding_dedup.unit_rows(clustered(4, 400, 6, 0.3))
    tree = embedding_dedup.CoverTree(unit, embedding_dedup.reach_of(0.93))
    assert sorted(tree.order.tolist()) == list(range(400)) and (tree.unit == unit[tree.order]).all()
    for k in range(len(tree.firsts)):
        scale, begins, below = 2.0 / 2**k, tree.begins[k], tree.begins[k + 1]
        for i, (s, e) in enumerate(zip(begins, begins[1:], strict=False)):
            far = np.linalg.norm(tree.unit[s:e] - tree.unit[s], axis=1).max()
            assert far <= scale + 1e-12 and abs(far - tree.radii[k][i]) < 1e-7
            kids = below[tree.firsts[k][i] : tree.firsts[k][i + 1]]
            assert kids[0] == s and (kids < e).all()
            heads = tree.unit[kids]
            apart = np.linalg.norm(heads[:, None] - heads[None], axis=2)[np.triu_indices(len(heads), 1)]
            assert k + 2 == len(tree.begins) or (apart > scale / 2).all()


def test_trees_compare_few_pairs_of_clustered_vectors():
    """Of 4,000 vectors in 500 groups, the trees look at under a tenth of all pairs."""
    got = embedding_dedup.linked_pairs(clustered(9, 4000, 5, 0.05))
    assert got.links.sum() > 0 and got.compared <= got.looked < 4000 * 3999 / 2 / 10
    one = embedding_dedup.linked_pairs(1 + 0.01 * np.random.default_rng(1).normal(size=(3000, 64)))
    assert one.compared == 0 and (one.links == 2999).all() and not one.roots.any()  # a group is linked as a whole


def vectors_match(got, rows):
    got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in got]
    order = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(got, key=order) == sorted(brute_vectors(rows), key=order)


@pytest.mark.parametrize(("block", "fan"), [(2000, 32), (40, 4), (8, 2)])
def test_split_cells_lose_no_link(spark, monkeypatch, block, fan):
    monkeypatch.setattr(embedding_dedup, "FAN", fan)
    monkeypatch.setattr(embedding_dedup, "CHUNK_ROWS", 60)
    v = clustered(5, 300, 3, 0.2)
    rows = [(k, v[k].tolist(), 1 if k % 3 else 2) for k in range(300)]
    got = embedding_dedup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), block_rows=block)
    vectors_match(got.collect(), rows)


def test_repeated_ids_tiny_and_huge_vectors(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.01], 0), (3, [0.01, 1.0], 0), (4, [0.99, 0.02], 0)]
    rows += [(5, [1e-170, 0.0], 7), (6, [1e-300, 1e-302], 7), (7, [1e300, 1e298], 7), (None, [1.0, 0.0], 0), (8, [0.0, -0.0], 0), (9, [], 0), (10, [3.0], 0), (11, [5.0], 0), (12, [float("inf"), 1.0], 0)]
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "vec_id long, embedding array<double>, label int, uid int, cell int, h int, id int")
    vectors_match(embedding_dedup.link_vectors(frame).collect(), rows)
    assert embedding_dedup.link_vectors(frame.limit(0)).collect() == []


def test_long_vectors_and_many_copies(spark):
    long = [float(k % 7) for k in range(5000)]
    rows = [(k, long, 3) for k in range(60)] + [(100, [x + 0.01 for x in long], 3), (101, [-x for x in long], 3)]
    vectors_match(embedding_dedup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect(), rows)


def test_vectors(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(30, 8))
    rows = [(i, (base[i % 30] + 0.05 * rng.normal(size=8)).tolist(), i % 3 if i % 11 else None) for i in range(90)]
    rows += [(200, rows[1][1], 1), (201, rows[1][1], 1), (202, [0.0] * 8, 1), (203, None, 1), (204, [float("nan")] * 8, 1), (205, [1.0] * 3, 1), (206, [None] + [1.0] * 7, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in embedding_dedup.link_vectors(frame, block_rows=10).collect()}
    links, root = Counter(), {r[0]: r[0] for r in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, u, a in rows:
        for j, v, b in rows:
            if i < j and a is not None and a == b and u and v and len(u) == len(v) and None not in u + v and np.isfinite(u + v).all() and any(u) and any(v):
                if np.dot(u, v) / np.linalg.norm(u) / np.linalg.norm(v) >= 0.93:
                    links.update((i, j))
                    root[max(top(i), top(j))] = min(top(i), top(j))
    assert sum(links.values()) > 0
    for i, _, _ in rows:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (links[i], top(i), top(i) == i)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(edges).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[101] == 100
