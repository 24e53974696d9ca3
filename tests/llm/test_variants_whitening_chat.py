"""Spelling variants, whitening and chat formatting against plain versions, with odd inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyward.llm import chat_format as Cf
from tallyward.llm import spelling as Sp
from tallyward.llm import whitening as Wh


# ---------------------------------------------------------------- spelling variants


def plain_variants(rows):
    cnt = Counter()
    for d, tx in rows:
        for r in re.findall(r"[A-Za-zÀ-ÿ]+", tx or ""):
            r = re.sub("[A-Z]", lambda m: m[0].lower(), r)
            h = zlib.crc32(f"{'null' if d is None else d}:{r}".encode())
            if h % 97 == 0:
                k = h % len(r)
                r = r[:k] + r[k + 1 :]
            cnt[r] += 1
    words = {w: n for w, n in cnt.items() if len(w) >= 5 and n >= 3}

    def one_edit(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        s, t = (a, b) if len(a) < len(b) else (b, a)
        return any(t[:i] + t[i + 1 :] == s for i in range(len(t)))

    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v)) if near[w] else None
        form[w] = best if best and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words}


def got_variants(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants_equal_plain_on_random_words(spark):
    rnd = random.Random(5)
    base = ["colour", "neighbour", "theatre", "organise", "analyse", "travelling", "jewellery", "programme", "ab"]
    texts = []
    for i in range(120):
        ws = []
        for _ in range(rnd.randint(0, 30)):
            w = rnd.choice(base)
            if rnd.random() < 0.3 and len(w) > 2:
                k = rnd.randrange(len(w))
                w = rnd.choice([w[:k] + w[k + 1 :], w[:k] + "x" + w[k:], w[:k] + "e" + w[k + 1 :]])
            ws.append(w.upper() if rnd.random() < 0.1 else w)
        texts.append((i, " ".join(ws) if i % 17 else None))
    texts.append((None, "colour colour colour"))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert got_variants(Sp.spelling_variants(df)) == plain_variants(texts)


def test_variants_chains_ties_and_long_words(spark):
    long = "a" * 3000
    texts = [(1, "spelt " * 3 + "spell " * 8 + "smell " * 8 + "spela " * 20 + long + " " + long + " " + long)]
    texts += [(2, "Ça règle élève réglé"), (3, ""), (4, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert got_variants(Sp.spelling_variants(df)) == plain_variants(texts)


def test_variants_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, word string, n long")
    assert Sp.spelling_variants(empty).count() == 0
    df = spark.createDataFrame([(1, "abcde abcde abcde abcdf", "x", 9)], "doc_id long, text string, word string, n long")
    assert got_variants(Sp.spelling_variants(df)) == plain_variants([(1, "abcde abcde abcde abcdf")])


def test_affected_bound_holds_for_all_single_edits(spark):
    words = ["organisation", "organisations", "organization", "xyzzyabcabc", "theatre", "theater"]
    df = spark.createDataFrame([(w, 3, len(w)) for w in words], "word string, n long, len int")
    grams = Sp.decompose(df).collect()
    nag = {r.word: (r.nag, r.size) for r in Sp.affected(Sp.decompose(df)).collect()}
    vg = {}
    for r in grams:
        vg.setdefault(r.word, Counter())[r.g] += 1
    # Every pair one edit apart shares at least |VG| - NAG grams of each.
    for a in words:
        for b in words:
            if a != b and (abs(len(a) - len(b)) <= 1):
                from itertools import zip_longest  # noqa: F401
                shared = sum((vg[a] & vg[b]).values())
                ed1 = len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1
                if ed1:
                    assert shared >= nag[a][1] - nag[a][0]


def test_words_one_edit_apart_share_a_list_and_lists_are_short():
    """A list is cut by all grams that an edit leaves, so a gram that every word holds does not bring all words together."""
    rnd = random.Random(8)
    words = set()
    while len(words) < 1500:
        w = [rnd.choice("abcdefghij") for _ in range(11)]
        at = rnd.randrange(2, 8)
        w[at : at + 2] = "qz"
        words.add("".join(w))
    for w in rnd.sample(sorted(words), 150):
        p = rnd.randrange(len(w))
        words |= {w[:p] + w[p + 1 :], w[:p] + "k" + w[p:], w[:p] + "k" + w[p + 1 :], w + "q"}
    words = sorted(words)
    often = {g for g in ("qz", "aqz", "zab", "ab", "qza", "abc")}
    lists, bound = {}, {}
    for w in words:
        grams = Sp._grams(w, often)
        hits = [sum(i - 2 <= p <= i + l for i, l in grams) for p in range(len(w) + 1)]
        bound[w] = len(grams) - max(hits)
        if bound[w] > 0:
            changed, grown = Sp.surviving(grams, len(w), len(w) - 1, 3), Sp.surviving(grams, len(w), len(w), 2)
            assert (0, len(w)) not in changed | grown  # some gram survives every edit
            for kind, m, cuts in (("=", len(w), changed), ("+", len(w), grown), ("-", len(w) - 1, changed)):
                for e, s in cuts:
                    lists.setdefault((kind, m, w[:e], w[s:]), set()).add(w)
    met, sides = set(), 0
    for (kind, m, e, s), ws in lists.items():
        others = ws if kind == "=" else lists.get(("-", m, e, s), set()) if kind == "+" else set()
        sides += len(ws) * len(others)
        met |= {(a, b) for a in ws for b in others}
    near = 0
    for a in words:
        for b in words:
            if len(a) <= len(b) <= len(a) + 1 and a != b and bound[a] > 0 and bound[b] > 0:
                p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
                if a[p + (len(a) == len(b)) :] == b[p + 1 :]:
                    near += 1
                    assert (a, b) in met
    assert near > 300
    assert sides < 0.02 * len(words) ** 2


def test_near_pairs_equal_plain_on_many_similar_words(spark):
    rnd = random.Random(12)
    words = {"".join(rnd.choice("ab\u00e9c") for _ in range(rnd.randrange(5, 10))) for _ in range(700)} | {"a" * n for n in range(5, 40)}
    df = spark.createDataFrame([(w, 3, len(w)) for w in sorted(words)], "word string, n long, len int")
    letters = "ab\u00e9c"
    plain = set()
    for w in words:
        for p in range(len(w) + 1):
            for v in [w[:p] + w[p + 1 :]] + [w[:p] + c + w[p + k :] for c in letters for k in (0, 1)]:
                if v in words and v != w:
                    plain.add((min(v, w), max(v, w)))
    got = [(r.a, r.b) for r in Sp.near_pairs(df).collect()]
    assert sorted(got) == sorted(plain)


# ---------------------------------------------------------------- whitening


def plain_whiten(rows, weighted=True):
    ok = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in ok)
    ok = [(i, v) for i, v in ok if len(v) == width]
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in ok], dtype=np.int64)
    if not weighted:
        x_fit = np.unique(x, axis=0)
    else:
        x_fit = x
    n = len(x_fit)
    s = [int(t) for t in x_fit.astype(object).sum(axis=0)]
    c = x_fit - np.array(s, dtype=float) / n
    cov = c.T @ c / n
    e, q = np.linalg.eigh(cov)
    o = np.argsort(-e)
    e, q = e[o], q[:, o]
    dev = [sum((n * int(a) - b) ** 2 for a, b in zip(row, s)) for row in x.astype(object)]
    return ok, x, n, s, e, q, dev, cov


@pytest.mark.parametrize("weighted", [True, False])
def test_whitening_equals_dense(spark, weighted):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 6)) * [3, 2, 1, 0.5, 0.3, 0.2]
    rows = [(i, [float(c) for c in base[i % 40]]) for i in range(200)]  # five copies of each vector
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [1.0, 2.0]), (904, [])]
    rows += [(905, [float("inf")] + [0.0] * 5), (906, [float(c) for c in base[1]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = Wh.whiten(df, weighted=weighted).toPandas()
    f32 = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    ok, x, n, s, e, q, dev, cov = plain_whiten(f32, weighted)
    assert set(out.vec_id) == {i for i, _ in ok} and (out.n == n).all()
    assert len(out) == len(ok) * 6 and out.component.max() == 6
    by = out.groupby(["component"])
    for k in range(6):
        part = out[out.component == k + 1]
        assert np.allclose(part.explained, e[k] / np.trace(cov), rtol=1e-9)
    # Whitened of each row equals the dense projection, up to one sign per component.
    first = {}
    for (i, _), xr, d in zip(ok, x, dev):
        z = (xr - np.array(s, float) / n) @ q / np.sqrt(e)
        got = out[(out.vec_id == i)].sort_values("component")
        for k in range(6):
            vals = got[got.component == k + 1].whitened.to_numpy()
            sign = first.setdefault(k, np.sign(vals[0] * z[k]) or 1.0)
            assert np.allclose(vals, sign * z[k], atol=1e-8)
        assert (got.deviation == d).all()
    assert out.identity_error.max() < 1e-6
    assert by.ngroups == 6


def test_whitening_empty_and_all_bad(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert Wh.whiten(empty).count() == 0
    bad = spark.createDataFrame([(1, None), (2, [float("nan")])], "vec_id long, embedding array<double>")
    assert Wh.whiten(bad).count() == 0


def test_whitening_rank_deficient_and_clashing_columns(spark):
    rows = [(i, [float(i % 3), float(i % 3), 1.0], "n") for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string")
    out = Wh.whiten(df).toPandas()
    # One direction only varies; the constant and the copied one are not components.
    assert out.component.max() == 1 and len(out) == 30


# ---------------------------------------------------------------- chat formatting


def plain_chat(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((-(2**62) if t is None else t, r or "", x or ""))
    out = {}
    for c, ts in convs.items():
        ts.sort()
        turns = "".join(f"{r}\n{x}\n" for _, r, x in ts)
        loss = "".join(x for _, r, x in ts if r == "assistant")
        out[c] = (
            len(ts), hashlib.sha256(turns.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), len(Cf.chatml([(r, x) for _, r, x in ts])),
        )
    return out


def got_chat(df):
    return {
        r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in df.collect()
    }


CONV = "conv_id long, turn long, role string, text string"


def test_chat_equals_plain_with_odd_texts(spark):
    rows = [
        (1, 0, "system", "be brief"), (1, 1, "user", "hi <|im_end|> there \\ x"), (1, 2, "assistant", "ok\\|<|"),
        (1, 3, "user", None), (1, 4, "assistant", ""), (2, 5, "assistant", "a" * 20000), (2, 5, "assistant", "a" * 20000),
        (None, 1, "user", "no id"), (3, None, None, "no turn"), (3, 2, "assistant", "<<|im_start|>|>"),
    ]
    rows += [(4, t, "user" if t % 2 == 0 else "assistant", f"turn {t} <|") for t in range(0, 200, 1)]
    df = spark.createDataFrame(rows, CONV)
    got = got_chat(Cf.digests(Cf.format_conversations(df)))
    assert got == plain_chat(rows)


def test_chat_probe_and_round_trip(spark):
    rows = [(-1, 0, "user", Cf.PROBE), (-1, 1, "assistant", Cf.PROBE)]
    pieces = Cf.format_conversations(spark.createDataFrame(rows, CONV)).collect()
    text = "".join(p.piece for p in sorted(pieces, key=lambda p: (p.chunk, p.seq)))
    assert text.count(Cf.START) == 2 and text.count(Cf.END) == 2
    assert got_chat(Cf.digests(spark.createDataFrame(pieces))) == plain_chat(rows)


def test_chat_flags_templates_that_rewrite_history(spark):
    def last_marked(msgs):
        return "".join(f"[{'LAST ' if i == len(msgs) - 1 else ''}{r}]{t}\n" for i, (r, t) in enumerate(msgs))

    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "c")]
    pieces = Cf.format_conversations(spark.createDataFrame(rows, CONV), template=last_marked, esc=lambda s: s)
    flags = {(p.conv_id, p.seq): p.rewrites for p in pieces.collect()}
    assert flags == {(1, 0): False, (1, 1): True, (2, 0): False}


def test_chat_empty_and_clashing_columns(spark):
    assert Cf.format_conversations(spark.createDataFrame([], CONV)).count() == 0
    df = spark.createDataFrame([(1, 0, "user", "x", "p")], CONV + ", piece string")
    assert got_chat(Cf.digests(Cf.format_conversations(df))) == plain_chat([(1, 0, "user", "x")])
