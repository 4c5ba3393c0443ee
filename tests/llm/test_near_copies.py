"""The pipeline's near copies against all pairs in plain Python."""

import random

from leafmill.llm import near_copies, simhash


def jaccard(a, b):
    g = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split())]
    return len(g[0] & g[1]) / len(g[0] | g[1])


def test_copies_of_similarity_08_go_whatever_their_fingerprints(spark):
    rng = random.Random(5)
    docs, far = [], 0
    for i in range(60):
        w = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(60, 200))]
        docs.append(" ".join(w))
        for part in (0.015, 0.022, 0.04):
            v = list(w)
            for j in rng.sample(range(len(v)), max(1, round(part * len(v)))):
                v[j] = f"x{rng.randrange(10**6)}"
            docs.append(" ".join(v))
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if jaccard(docs[i], docs[j]) >= 0.8:
                far += (simhash.fingerprint(docs[i]) ^ simhash.fingerprint(docs[j])).bit_count() > simhash.RADIUS
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    want = {root(i) for i in range(len(docs))}
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(5)
    assert far > 20 and len(want) < len(docs)
    assert {r["doc_id"] for r in simhash.deduplicate(frame).collect()} == want


def test_sets():
    assert len(near_copies.shingles([])) == 0 and len(near_copies.shingles([b"a"] * 50)) == 1
    assert len(near_copies.shingles(near_copies.words_of("a b c d e f"))) == 2


def test_bands_are_searched_by_tree(monkeypatch):
    import pyarrow as pa

    rng, calls = random.Random(3), []
    take = simhash.BKTree.take
    monkeypatch.setattr(simhash.BKTree, "take", lambda self, *a: calls.append(a) or take(self, *a))
    for n in (2, 3, 40, 300):
        seeds = [rng.getrandbits(64) for _ in range(max(1, n // 20))]
        fps = [rng.choice(seeds) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 18))) for _ in range(n)]
        signed = [simhash.signed(x) for x in fps]
        cut = n // 3
        held = [pa.record_batch({"key": [7] * len(x), "node": x, "fp": pa.array([signed[i] for i in x], pa.int64())}) for x in ([*range(cut)], [*range(cut, n)]) if x]
        edges = list(near_copies.near_in_band(held))
        assert calls and all((fps[u] ^ fps[v]).bit_count() <= near_copies.RADIUS for u, v in edges)

        def groups(pairs):
            at = list(range(n))
            for u, v in pairs:
                a, b = at[u], at[v]
                at = [a if x == b else x for x in at]
            return {tuple(i for i in range(n) if at[i] == r) for r in set(at)}

        found = groups(edges)
        assert found == groups((u, v) for u in range(n) for v in range(u) if (fps[u] ^ fps[v]).bit_count() <= near_copies.RADIUS)
        assert len(edges) == n - len(found)
