"""The Jaccard join and the cover-tree search against plain versions."""

import random

import numpy as np
import pytest

from tallyward.llm import cover_tree as Ct
from tallyward.llm import jaccard_join as Jj
from tallyward.llm.components import components

DOCS = "doc_id long, text string, H1 string"


def sets_of(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_join(texts):
    sets = [(i, sets_of(t)) for i, t in texts if i is not None]
    root = {i: i for i, _ in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    links = {}
    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1 :]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                links[i], links[j] = links.get(i, 0) + 1, links.get(j, 0) + 1
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), top(i), links.get(i, 0)) for i, s in sets)


def corpus(rng, families=6, size=40, words=60):
    """Families of near copies around a base, from close to too far, besides unrelated texts."""
    vocabulary = [f"w{i}" for i in range(400)]
    out, n = [], 0
    for _ in range(families):
        base = rng.choices(vocabulary, k=words)
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(words)] = rng.choice(vocabulary)
            out.append((n, " ".join(copy)))
            n += 1
    for _ in range(60):
        out.append((n, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40)))))
        n += 1
    passage = rng.choices(vocabulary, k=30)  # a passage that many texts share
    for _ in range(40):
        out.append((n, " ".join(rng.choices(vocabulary, k=rng.randrange(3, 20)) + passage)))
        n += 1
    return out


@pytest.mark.parametrize("small", [16, 2])
def test_join_equals_plain(spark, monkeypatch, small):
    """With ``SMALL`` = 2 nearly all goes through blocks, which are small here so that they meet each other."""
    monkeypatch.setattr(Jj, "SMALL", small)
    monkeypatch.setattr(Jj, "BLOCK", 8 if small == 2 else 256)
    rng = random.Random(small)
    texts = corpus(rng)
    n = len(texts)
    texts += [(n, ""), (n + 1, " \t\n"), (n + 2, None), (n + 3, "one"), (n + 4, "ONE "), (n + 5, texts[3][1].upper()), (n + 6, "é È")]
    df = spark.createDataFrame([(i, t, "x") for i, t in texts] + [(None, texts[0][1], "x")], DOCS)
    rows = Jj.jaccard_components(df).collect()
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in rows if r["doc_id"] is not None)
    assert got == plain_join(texts)
    alone = [r for r in rows if r["doc_id"] is None]
    assert len(alone) == 1 and alone[0]["component_id"] is None


def test_keep_one_and_repeated_ids(spark):
    a, b = "the quick brown fox jumps over the lazy dog again", "some other words that say nothing of the kind here"
    rows = [(5, a), (5, a), (6, a), (7, b), (7, a), (8, b), (9, "unique text of its own with many words")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS)
    kept = sorted((r["doc_id"], r["text"]) for r in Jj.keep_one(df).collect())
    assert kept == [(5, a), (9, "unique text of its own with many words")]
    assert Jj.keep_one(df.limit(0)).count() == 0 and Jj.keep_one(df).columns == df.columns


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {(r["node"], r["root"]) for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(100 + i, 100) for i in range(1, 30)}


VECS = "vec_id long, embedding array<float>, Label int"


def plain_top(rows, k=20):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable.setdefault(i, set()).add(tuple(int(np.floor(64 * float(np.float32(x)))) for x in v))
    flat = [(i, v) for i, vs in usable.items() for v in vs]
    out = []
    for q in sorted({i for i, _ in flat if i % 20 == 0}):
        scored = [(-sum(a * b for a, b in zip(x, v, strict=True)), i) for qi, x in flat if qi == q for i, v in flat if i != q and len(v) == len(x)]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return out


def test_search_equals_plain(spark, monkeypatch):
    monkeypatch.setattr(Ct, "BLOCK", 64)
    monkeypatch.setattr(Ct, "GROUP", 8)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8)) * 3
    rows = [(int(i), [float(x) for x in centres[i % 6] + rng.normal(size=8)]) for i in range(400)]
    same = [1.0, -0.5] * 4
    rows += [(1000 + i, same) for i in range(200)]  # one vector that many rows share: ties
    rows += [(2000, None), (2020, [1.0, None] * 4), (2040, [float("nan")] * 8), (2060, [float("inf")] * 8), (None, same)]
    rows += [(2080, []), (2081, []), (2100, [1.0, 2.0]), (2101, [3.0, 1.0]), rows[0]]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], VECS)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in Ct.top_k(df).collect())
    assert got == plain_top(rows)


def test_search_of_an_empty_table(spark):
    assert Ct.top_k(spark.createDataFrame([], VECS)).count() == 0


def test_cover_tree_covers_and_prunes():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(size=(200, 4)) + c for c in (0, 50, -50)])
    todo, leaves = [Ct.cover_tree(points)], []
    while todo:
        node = todo.pop()
        assert np.sqrt(((points[node.at] - node.centre) ** 2).sum(axis=1)).max() <= node.radius
        todo += node.children
        leaves += [] if node.children else [node.at]
    assert sorted(np.concatenate(leaves)) == list(range(600))


def test_scores_beyond_floats_are_exact():
    q, d = np.array([[2**40 + 1, 3]]), np.array([[2**20 + 1, 5], [7, 2**50]])
    assert Ct.products(q, d).tolist() == [[(2**40 + 1) * (2**20 + 1) + 15, 7 * (2**40 + 1) + 3 * 2**50]]
    with pytest.raises(OverflowError):
        Ct.products(np.array([[2**60]]), np.array([[2**60]]))


def test_sketches_tell_candidates_apart_and_lose_no_link(spark):
    """Texts that only share a passage are candidates, but their whole sets are not needed."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(5000)]
    passage = rng.choices(vocabulary, k=120)
    texts = [" ".join(rng.choices(vocabulary, k=280) + passage) for _ in range(30)]
    close = [t.split(" ") for t in texts[:10]]
    for words in close:
        words[rng.randrange(250)] = "other"
    texts += [" ".join(w) for w in close] + ["one two", "one two three", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    low = {r["id"]: np.frombuffer(r["set"], dtype="<u4") for r in Jj._sketches(df, 5).collect()}
    whole = {r["id"]: np.frombuffer(r["set"], dtype=np.uint64) for r in Jj._sets(df, 5).collect()}
    full = sorted(i for i, s in whole.items() if len(s))
    assert sorted(i for i, s in low.items() if len(s)) == full
    passed = {(i, j) for i in full for j in full if i < j and Jj._may_link(low[i], low[j], 80)}
    linked = {(i, j) for i in full for j in full if i < j and Jj._linked(whole[i], whole[j], 80)}
    assert linked == {(i, 30 + i) for i in range(10)} and linked <= passed
    assert len(passed) < 30  # of 780 pairs, all of which share the passage
    assert sum(s.nbytes for s in low.values()) < 0.16 * sum(s.nbytes for s in whole.values())


def test_a_visit_makes_few_products(monkeypatch):
    """Queries meet large leaves in one product each, with the results of comparing all."""
    rng = np.random.default_rng(3)
    q, d = rng.integers(-64, 64, (200, 64)), rng.integers(-64, 64, (2048, 64))
    d[500:700] = d[500]  # ties
    q[0], ids, who = d[500], np.arange(200), np.arange(2048)
    calls, plain = [], Ct.products
    monkeypatch.setattr(Ct, "products", lambda a, b: calls.append(1) or plain(a, b))
    best = Ct.Best(ids, 20, np.full(200, Ct.LOWEST))
    Ct.dual_search(q, Ct.cover_tree(q.astype(float), leaf=2 * Ct.GROUP), d, Ct.cover_tree(d.astype(float)), who, best)
    scores = q @ d.T
    scores[ids, ids] = Ct.LOWEST
    order = np.lexsort((np.broadcast_to(who, scores.shape), ~scores), axis=1)[:, :20]
    assert (best.who == order).all() and (best.score == np.take_along_axis(scores, order, axis=1)).all()
    assert len(calls) <= 64


def test_best_keeps_scores_at_the_ends_of_64_bits():
    best = Ct.Best(np.array([0, 1]), 2, np.full(2, Ct.LOWEST))
    top = 2**63 - 1
    best.offer(np.array([0, 1]), np.array([[top, 5, top - 1], [-top, top, -top]]), np.array([9, 8, 7]))
    best.offer(np.array([1]), np.array([[-top, 3]]), np.array([6, 1]))
    assert best.score.tolist() == [[top, top - 1], [top, -top]] and best.who.tolist() == [[9, 7], [8, 6]]
