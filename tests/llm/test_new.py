"""Divergence audit, perplexity rules and vector codes against plain versions, and on odd inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from webcat.llm import codes, divergence, perplexity

SF = "/root/testdata/sf0.001"


# --- 11: divergence ------------------------------------------------------------------------------

def plain_audit(rows, top=200):
    kept, out = {}, []
    found = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    for lang in {x[0] for x in found}:
        docs = Counter(t for x in found if x[0] == lang for t in set(x[2]))
        kept = {t for t, d in docs.items() if d >= 3}
        count = {s: Counter() for s in {x[1] for x in found if x[0] == lang}}
        for own, s, words in found:
            if own == lang:
                count[s].update(w for w in words if w in kept)
        whole = sum(count.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        for s in count:
            parts = {"pair": [(t, sum((p[s][k] - p[t][k]) ** 2 // p[t][k] for k in kept)) for t in count if t != s],
                     "term": [(k, (p[s][k] - q[k]) ** 2 // q[k]) for k in kept if count[s][k] and p[s][k] > q[k]]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, n + 1) for n, (i, v) in enumerate(items if part == "pair" else items[:top])]
    return sorted(out)


def test_divergence_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK", 3)
    monkeypatch.setattr(divergence, "UNIT", 20)
    monkeypatch.setattr(divergence, "HELD", 200)
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("abÀéÉz世"), 3)) for _ in range(120)]
    rows = [(str(rng.choice(["en", "de"])), f"s{rng.integers(0, 9)}", " ".join(rng.choice(vocabulary, 12)).title() + " X1y_z-Q") for _ in range(150)]
    rows += [(None, None, None), (None, "", "a B a"), ("en", "new", ""), ("xx", "a", "once"), ("xx", "b", None), rows[0], rows[0], ("en", None, "A a b" * 3000)]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "lang string, source string, text string, count long, part string")
    got = [tuple(r) for r in divergence.audit(df, top=7).collect()]
    assert sorted(got) == plain_audit(rows, top=7)
    assert divergence.audit(df.limit(0)).count() == 0


def test_divergence_runs():
    a, b = (np.array([0, 2, 5]), np.array([7, 9, 4])), (np.array([0, 3]), np.array([5, 8]))
    x, y = [7, 7, 9, 9, 9, 4, 4, 4], [5, 5, 5, 8, 8, 8, 8, 8]
    assert divergence.distances(a, b, 8) == (sum((p - q) ** 2 // q for p, q in zip(x, y)), sum((p - q) ** 2 // p for p, q in zip(x, y)))
    assert divergence.shares(np.array([10 ** 12]), 10 ** 13, 5)[0] == 1 + 10 ** 9 * (10 ** 12 + 1) // (10 ** 13 + 5)


# --- 12: perplexity ------------------------------------------------------------------------------

def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    often, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside.update(range(i, i + 5))
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside), n < 10 or 100 * len(inside) > 20 * n)


def plain_entropies(rows, order=5):
    """Cross entropy of each (lang, text) by a model that is built and looked up in dictionaries."""
    out = [None] * len(rows)
    for lang in {r[0] or "" for r in rows}:
        mine = [i for i, r in enumerate(rows) if (r[0] or "") == lang]
        texts = {i: "\0" * (order - 1) + " ".join(re.findall(r"[^\x20\x09-\x0D]+", rows[i][1] or "")) for i in mine}
        count, holders = Counter(), defaultdict(set)
        for i, t in texts.items():
            for k in range(len(t) - order + 1):
                count[t[k: k + order]] += 1
                holders[t[k: k + order]].add(i)
        levels = {order: (count, {g for g in count if len(holders[g]) > 1})}
        for n in range(order - 1, 0, -1):
            above, known = levels[n + 1]
            c = Counter(g[1:] for g in above)
            levels[n] = (c, {g for g in c if c[g] >= 2 or n == 1} | {g[1:] for g in known})
        p, over = {}, {}
        for n in range(1, order + 1):
            c, known = levels[n]
            m = [sum(v == k for v in c.values()) for k in range(5)]
            y = m[1] / (m[1] + 2 * m[2]) if m[1] else 0.5
            d = [max(0.1, min(k - (k + 1) * y * m[k + 1] / m[k] if m[k] and m[k + 1] else 0.5 * k, k - 0.1)) if k < 4 else 0 for k in range(1, 4)
                 ] if len(m) > 4 else []
            total, given, kinds = Counter(), Counter(), Counter()
            for g, v in c.items():
                total[g[:-1]] += v
                kinds[g[:-1]] += 1
                if g in known:
                    given[g[:-1]] += v - d[min(v, 3) - 1]
            for x in total:
                if n == 1 or given[x] > 0:
                    over[x if n > 1 else "", n] = 1 - given[x] / total[x]
            for g in known:
                less = p[g[1:]] if n > 1 else 1 / (kinds[""] + 1)
                p[g] = (c[g] - d[min(c[g], 3) - 1]) / total[g[:-1]] + over[g[:-1] if n > 1 else "", n] * less
        for i, t in texts.items():
            logs = 0.0
            for k in range(order - 1, len(t)):
                for n in range(order, 0, -1):
                    g = t[k - n + 1: k + 1]
                    if g in p:
                        logs += math.log(p[g])
                        break
                    logs += math.log(over.get((g[:-1], n), 1.0))
            if len(t) >= order:
                out[i] = -logs / (len(t) - order + 1)
    return out


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(2)
    vocabulary = ["".join(rng.choice(list("abcdefghi"), rng.integers(2, 6))) for _ in range(60)]
    rows = [(str(rng.choice(["en", "de"])), "\n".join(" ".join(rng.choice(vocabulary, rng.integers(1, 9))) for _ in range(rng.integers(1, 9)))) for _ in range(120)]
    rows += [("en", None), ("en", ""), (None, " \t\n"), (None, "a b"), ("en", "a b c d e f " * 9), ("en", "x # y\n\nx # y\n x # y\n\x0b\n" + "é世\U0001F600 " * 3),
             rows[0], ("de", " ".join(f"Q{i}Z%%&" for i in range(3000))), ("en", " ".join(rng.choice(vocabulary, 4000)))]
    return rows, spark.createDataFrame([(i, *r, 0, "z") for i, r in enumerate(rows)], "doc_id long, lang string, text string, n long, gram string")


@pytest.mark.parametrize("shard", [perplexity.SHARD, 9000])
def test_perplexity_against_a_plain_model(texts, monkeypatch, shard):
    monkeypatch.setattr(perplexity, "SHARD", shard)
    monkeypatch.setattr(perplexity, "HELD", 500)
    rows, df = texts
    got = {r["doc_id"]: r for r in perplexity.judge(df).collect()}
    assert len(got) == len(rows)
    for i, (r, want) in enumerate(zip(rows, plain_entropies(rows))):
        assert tuple(got[i][b] for b in [*perplexity.BASE, "base_failed"]) == plain_base(r[1])
        assert got[i]["entropy"] == (None if want is None else pytest.approx(want, abs=1e-4))
        inside = want is not None and got[i]["low"] is not None and got[i]["low"] <= got[i]["entropy"] <= got[i]["high"]
        assert got[i]["kept"] == (not got[i]["base_failed"] and inside)
    assert got[0]["entropy"] == got[126]["entropy"]
    # a text that is unlike all others is refused, ordinary ones stay
    assert not got[127]["base_failed"] and not got[127]["kept"]
    assert all(got[i]["kept"] for i in range(120) if not got[i]["base_failed"]) and got[128]["kept"]


def test_perplexity_bands_and_odd_tables(spark, texts):
    rows, df = texts
    values = spark.createDataFrame([("a", i / 1000) for i in range(1000)] + [(None, 2.0)], "lang string, entropy double")
    found = {r["lang"]: r for r in perplexity.bands(values).collect()}
    assert found["a"]["middle"] == pytest.approx(0.5, abs=0.002) and found["a"]["below"] == pytest.approx(0.25 / 0.6745, abs=0.004)
    assert found[None]["middle"] == pytest.approx(2.0, abs=0.002)
    assert perplexity.judge(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        perplexity.judge(df.withColumnRenamed("n", "KEPT"))


def test_grouping_with_many_kinds_of_characters():
    rng = np.random.default_rng(3)
    for kinds in (3, 70_000):
        chars = rng.integers(0, kinds, 30_000).astype(np.uint32)
        ends = np.arange(4, len(chars))
        rows, starts = perplexity.grouped(chars, ends, 5)
        groups = [tuple(chars[ends[rows[s]] - 4: ends[rows[s]] + 1]) for s in starts]
        sizes = np.diff(np.append(starts, len(rows)))
        assert Counter({g: int(n) for g, n in zip(groups, sizes)}) == Counter(tuple(chars[i - 4: i + 1]) for i in ends)


# --- 13: vector codes ----------------------------------------------------------------------------

def plain_codes(rows, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max(len(v) for _, v, _ in kept) // 8) * 8
    kept = [(i, v + [0] * (width - len(v)), lab) for i, v, lab in kept]
    step = width // 8
    first = sorted((i, v) for i, v, _ in kept if i is not None)[:16]
    out, books, errors = [""] * len(kept), [], [0] * len(kept)
    for p in range(8):
        cut = [v[p * step: (p + 1) * step] for _, v, _ in kept]
        book = [v[p * step: (p + 1) * step] for _, v in first]
        for r in range(rounds + 1):
            near = [min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book)) for x in cut]
            if r < rounds:
                for k in range(len(book)):
                    mine = [x for x, (_, e) in zip(cut, near) if e == k]
                    if mine:
                        book[k] = [sum(c) // len(mine) for c in zip(*mine)]
        books.append(book)
        out = [o + f"{e:02x}" for o, (_, e) in zip(out, near)]
        errors = [t + d for t, (d, _) in zip(errors, near)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    total = Counter()
    for (_, _, lab), e in zip(kept, errors):
        total[lab] += e
    return sorted(((i, lab, c, e, total[lab]) for (i, _, lab), c, e in zip(kept, out, errors)), key=repr), digest


def test_codes_against_plain_rounds(spark, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", 64)
    monkeypatch.setattr(codes, "FREQUENT", 4)
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=16) * (1 if i % 3 else 0.1)], int(rng.integers(0, 40)) if i % 3 else None) for i in rng.permutation(400)]
    rows += [(None, [0.5] * 16, 3), (5, None, 1), (6, [0.1, None] * 8, 1), (7, [float("nan")] * 16, 1), (8, [float("inf")] * 16, 1), rows[0], rows[0],
             (900, [1.0, -2.0, 0.25], 9), (901, [], None), (-3, [1e7] * 16, 9)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<double>, label int, code string, error int")
    got = codes.encode(df).collect()
    want, digest = plain_codes(rows)
    assert sorted(((r["id"], r["label"], r["code"], r["error"], r["label_error"]) for r in got), key=repr) == want
    assert {r["codebooks_sha256"] for r in got} == {digest}
    for few in (df.filter("vec_id IN (1, 2, 3)"), df.filter("vec_id IN (900, 901)"), df.filter("vec_id = 901")):
        some = [r for r in rows if r[0] in {x["vec_id"] for x in few.collect()}]
        got = codes.encode(few).collect()
        want, digest = plain_codes(some)
        assert sorted(((r["id"], r["label"], r["code"], r["error"], r["label_error"]) for r in got), key=repr) == want
        assert {r["codebooks_sha256"] for r in got} == {digest}
    assert codes.encode(df.limit(0)).count() == codes.encode(df.filter("embedding IS NULL")).count() == 0
    assert codes.encode(df.filter("vec_id IS NULL")).first()["code"] == "00" * 8


def test_bounds_save_work_and_are_tighter_than_drifts(spark):
    trained = codes.train(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"))
    assert trained.scanned[0] == 8 * 2000 and trained.scanned[-1] < 0.6 * trained.scanned[0]
    books = trained.history[:, 0]
    own, others = codes.ways(books, 6)
    drift = sum(np.sqrt(((books[t + 1] - books[t]) ** 2).sum(axis=1)) for t in range(6))
    assert (own[0] <= drift + 1e-9).all() and own[0].sum() < 0.95 * drift.sum()
    assert all(others[0][k] == max(np.delete(own[0], k)) for k in range(16))
