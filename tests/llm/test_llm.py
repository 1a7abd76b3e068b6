"""The training-data operators against brute force, round trips and held-out accuracy, and on odd inputs."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
import oracle
from webcat.llm import components, langid, lines, mixing, order_minhash, pieces, quality, queries, simhash, topk, toxicity, warc

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "a b c d e f"), (5, "a b c d e f"), (6, "A B C D E F"), (None, "no id here"),
       (7, "x" * 5000 + " é世\U0001F600"), (8, "▁lit ▁▁ mark  two ")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names operators use themselves."""
    rows = [(i, t, "en", None, 0, "x", 1.5) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, h string, score double")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (99, 0, 1), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_check_sql(spark, name):
    assert oracle.compare(spark, name, SF) == []


def union(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in list(parent)}


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(50)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = union(p for p in pairs if p[0] != p[1])
    assert got.keys() == want.keys()
    assert len({(got[n], want[n]) for n in got}) == len(set(want.values()))
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 4: SimHash ----------------------------------------------------------------------------------

def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_masks_cover_every_pair_within_the_radius():
    from itertools import combinations

    for level in range(simhash.LEVELS):
        masks = simhash.masks(level)
        assert all(any(not m & (1 << a | 1 << b | 1 << c) for m in masks) for a, b, c in combinations(range(64), 3))


def test_simhash_groups(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    fp = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = union((a, b) for a in fp for b in fp if a <= b and (fp[a] ^ fp[b]).bit_count() <= 3)
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in queries.op4_simhash(spark, SF).collect()}
    assert got == {(i, f"{fp[i]:016x}", want[i]) for i in fp}


def test_simhash_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 8)
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 62))
    values = {centre}
    for value in rng.choice(64, (400, 4)):  # within four bits of the centre: linked through one another or not at all
        values.add(simhash._signed((centre ^ sum({1 << int(b) for b in value})) % (1 << 64)))
    edges = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"))
    got = union((r["a"], r["b"]) for r in edges.collect())
    want = union((a, b) for a in values for b in values if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 3)
    assert {frozenset(k for k in got if got[k] == r) for r in set(got.values())} == {frozenset(k for k in want if want[k] == r) for r in set(want.values())}


def test_simhash_odd_rows(odd, empty):
    got = [(r["id"], r["component"]) for r in simhash.near_groups(odd).collect()]
    assert len(got) == len(ODD)
    assert {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5), (None, None)} <= set(got)
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "5", "5", "7", "8", "None"]
    assert simhash.near_groups(empty).count() == 0 and simhash.deduplicate(empty).count() == 0


# --- 6: lines ------------------------------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def near_pairs(texts, similarity=0.8):
    """All pairs of different normalised lines by edit similarity alone."""
    norm = {re.sub(r"[\W_]+", " ", x.lower()).strip() for t in texts for x in (t or "").split("\n")} - {""}
    rows = pd.DataFrame({"line": sorted(norm)})  # noqa: F841
    found = duckdb.sql(
        f"SELECT a.line, b.line FROM rows a JOIN rows b ON a.line < b.line AND levenshtein(a.line, b.line) <= "
        f"round({1 - similarity} * greatest(length(a.line), length(b.line)), 6)")
    return norm, found.fetchall()


def test_line_dedup_against_brute_force(spark):
    base = "the committee will publish its seventeenth quarterly statement about regional water supplies tomorrow morning "
    texts = [f"{base * 2}number {w}\nunique opening words of document {w * 3}\n\n--" for w in ("alpha", "alphb", "alphc", "omega")]
    texts += ["short line\nShort, LINE!\nshort line", texts[0], "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root = union(near_pairs(texts)[1])
    keep = {}
    places = [(i, n, re.sub(r"[\W_]+", " ", x.lower()).strip()) for i, t in enumerate(texts) for n, x in enumerate((t or "").split("\n"))]
    for i, n, line in places:
        if line:
            keep.setdefault(root.get(line, line), (i, n))
    want = [None if t is None else "\n".join(
        x for (j, n, line), x in zip([q for q in places if q[0] == i], t.split("\n"))
        if not line or keep[root.get(line, line)] == (j, n)) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["text"] for r in lines.deduplicate_lines(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert len(keep) < 8


def edited(rng, words):
    """One to three words changed by a letter, replaced, left out or put in, more of them in longer lines."""
    words = list(words)
    for _ in range(int(rng.integers(1, 2 + len(words) // 15))):
        at, kind = int(rng.integers(len(words))), rng.integers(4)
        other = "".join(rng.choice(list("abcdefghijklmnop"), 6))
        if kind == 0:
            words[at] = words[at][:-1] + "q"
        elif kind == 1:
            words[at] = other
        elif kind == 2 and len(words) > 5:
            del words[at]
        else:
            words.insert(at, other)
    return words


def test_line_candidates_find_edited_lines(spark):
    rng = np.random.default_rng(11)
    made = []
    for k in range(150):
        words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(rng.integers(5, 45))]
        made += [" ".join(words), " ".join(edited(rng, words))]
    norm, truth = near_pairs(made)
    assert len(truth) > 100
    keys = {r["line"]: set(r["k"]) for r in spark.createDataFrame([(x,) for x in norm], "line string").select(
        "line", lines.line_keys(F.col("line")).alias("k")).collect()}
    found = sum(bool(keys[a] & keys[b]) for a, b in truth)
    assert found >= 0.9 * len(truth)
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.deduplicate_lines(docs).collect()}
    linked = {x for pair in truth for x in pair}
    assert all(made[i] in linked or made.index(made[i]) < i for i in got if not got[i])
    assert sum(not t for t in got.values()) >= 0.9 * len(truth)


def test_line_keys_of_odd_lines(spark):
    odd_lines = ["a", "abcd", "word " * 50_000 + "end", " ".join(f"word{i}" for i in range(60_000)), "\u4e2d\u6587" * 40, "x" * 100_000]
    rows = spark.createDataFrame([(x,) for x in odd_lines], "line string").select(F.size(lines.line_keys(F.col("line"))).alias("n")).collect()
    sizes = [r["n"] for r in rows]
    assert sizes[0] == 0 and all(n > 0 for n in sizes[1:])
    assert sizes[3] > 10_000 and sizes[2] < 10


def test_line_dedup_compares_open_pairs_without_making_them(spark, tmp_path, monkeypatch):
    """Many unlike lines of one key: pairs are tried in the join, none is written, and the near ones are found all the same."""
    rng = np.random.default_rng(5)
    made = ["".join(rng.choice(list("abcdefghij"), 24)) for _ in range(60)]
    near = [x[:11] + "zz" + x[13:] for x in made[:5]]
    rows = [(i, x) for i, x in enumerate([*made, *near])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(lines, "line_keys", lambda line: F.array(F.lit(7).cast("long")))  # every line shares the key
    monkeypatch.setattr(lines, "SIDE", 16)
    written = {}
    real = lines.saved

    def saved(df, name):
        out = real(df, name)
        written[name] = max(written.get(name, 0), out.count())
        return out

    monkeypatch.setattr(lines, "saved", saved)
    got = {r["doc_id"]: r["text"] for r in lines.deduplicate_lines(docs).collect()}
    assert got == dict(enumerate(made)) | {60 + i: "" for i in range(5)}
    assert max(written.values()) <= len(rows)


def test_line_dedup_letters_rule_out_no_near_pair(spark):
    """What lengths and letters leave holds every pair of the edit similarity."""
    rng = np.random.default_rng(6)
    texts = []
    for n in (4, 9, 30, 100, 900):
        for _ in range(12):
            x = rng.choice(list("aaaabcdeeexyz 019\u00e9\u4e2d"), n)
            y = x.copy()
            for j in rng.choice(n, max(1, int(n * rng.choice([0.05, 0.19, 0.25]))), replace=False):
                y[j] = rng.choice(list("eq1 \u00e9"))
            texts += ["".join(x).strip(), "".join(np.delete(y, rng.integers(n))).strip()]
    table = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "h long, line string").select(
        "h", "line", *lines._counted(F.col("line")))
    pairs = table.select(F.col("h").alias("a")).crossJoin(table.select(F.col("h").alias("b"))).filter("a < b")
    both = lines._paired(pairs, table).select(
        lines._possible(lines._side).alias("possible"), lines._alike(lines._side).alias("alike")).groupBy("possible", "alike").count()
    found = {(r["possible"], r["alike"]): r["count"] for r in both.collect()}
    assert found[True, True] > 20 and found[False, False] > 100 and (False, True) not in found


def test_line_dedup_odd_rows_and_plan(odd, empty):
    got = lines.deduplicate_lines(odd)
    assert got.columns == odd.columns
    rows = {r["doc_id"]: r["text"] for r in got.collect()}
    assert rows[1] is None and rows[2] == "" and rows[6] == "" and rows[5] == "a b c d e f" and rows[3] == " \n\t"
    assert lines.deduplicate_lines(empty).count() == 0
    assert not re.search("Python|Arrow|Pandas", got._jdf.queryExecution().toString())


def test_long_candidates_link_by_their_distance_alone(spark):
    """A letter of every word is changed: the lines share no word, and 0.875 of their letters."""
    one = " ".join("abcdefg" + chr(ord("h") + i) for i in range(18))
    two = " ".join("xbcdefg" + chr(ord("h") + i) for i in range(18))
    far = " ".join("xyzdefg" + chr(ord("h") + i) for i in range(18))
    docs = spark.createDataFrame([(1, one), (2, two), (3, far)], "doc_id long, text string")
    seen = lines.occurrences(docs, "doc_id", "text")
    firsts = seen.groupBy("h").agg(F.min(F.struct("id", "tk", "line_no")).alias("first"))
    a, b = (seen.select(F.col("id").alias(f"id_{c}"), F.col("h").alias(c)) for c in "ab")
    pairs = a.join(b, F.col("id_a") < F.col("id_b"))
    links = lines._verified(docs, firsts, pairs.select("a", "b"), "doc_id", "text")
    assert {(r["id_a"], r["id_b"]) for r in pairs.join(links, ["a", "b"]).collect()} == {(1, 2)}


# --- 2: mixing -----------------------------------------------------------------------------------

def test_mixing_means_and_determinism(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.lit("12345").alias("text"))
    mixed = mixing.mix(docs, weights={"a": 3.0, "b": 1.0}, epochs=2.0)
    n = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(n["a"] - 9000) < 400 and abs(n["b"] - 3000) < 250
    again = mixing.mix(docs, weights={"a": 3.0, "b": 1.0}, epochs=2.0)
    assert mixed.exceptAll(again).count() == again.exceptAll(mixed).count() == 0
    many = mixing.mix(docs.limit(200), weights={"a": 1.0, "b": 1.0}, epochs=600.0)  # drawn in parts
    assert abs(many.count() / 120000 - 1) < 0.05


def test_mixing_odd_rows(odd, empty):
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.mix(odd, weights={}).count() == 0
    assert mixing.mix(empty).count() == 0


# --- 3: SentencePiece ----------------------------------------------------------------------------

def test_pieces_match_the_library(spark, odd, empty):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL_FILE)
    docs = odd.select("doc_id", "text").union(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    for r in pieces.encode(docs, queries.MODEL_FILE).collect():
        ids = model.encode(r["text"] or "") + [model.eos_id()]
        assert r["ids"] == ids and r["decoded"] == model.decode(ids)
    assert pieces.encode(empty, queries.MODEL_FILE).columns == [*empty.columns, "ids", "decoded"]
    assert pieces.encode(empty, queries.MODEL_FILE).count() == 0
    assert pieces.encode(odd.withColumnRenamed("h", "IDS"), queries.MODEL_FILE).columns[-3:] == ["score", "ids", "decoded"]


# --- 7: WARC -------------------------------------------------------------------------------------

def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "é word " * 400
    pages = [(1, "http://a/\r\nX: y", big), (9, "http://b/", big), (4, None, big), (2, "http://c/", "small"), (3, "http://d/", "small"),
             (5, "http://e/", None), (9, "http://b/", big), (None, "http://f/", big)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, payload string")
    found = []
    for n in "12":
        out = f"file://{tmp_path}/{n}"
        manifest = warc.write_archives(df, out, shard_bytes=4000, roll_bytes=1500)
        found.append(sorted((r["file"], r["sha1"], r["records"]) for r in manifest.collect()))
        (tmp_path / n / "archive" / "part-99999-00000.warc.gz").write_bytes(b"left over")  # not in the manifest
        rows = warc.read_archives(spark, out).collect()
        want = sorted((str(i), len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(),
                       "revisit" if h == big and i != 9 else "response", 9 if h == big and i != 9 else None) for i, _, h in pages)
        assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows) == want
        assert all(r["payload"] == (dict((p[0], p[2]) for p in pages)[r["page_id"]] or "") for r in rows if r["record_type"] == "response")
    assert found[0] == found[1] and len(found[0]) > 3
    out = f"file://{tmp_path}/none"
    assert warc.write_archives(df.limit(0), out).count() == 0 and warc.read_archives(spark, out).count() == 0


# --- 8: order MinHash ----------------------------------------------------------------------------

def test_order_minhash(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    source = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = {r["id"]: r for r in order_minhash.fingerprint_with_next(docs).collect()}
    assert len(got) == len(source)
    for k, (i, text) in enumerate(source):
        other = source[(k + 1) % len(source)][1]
        n = len(text) // 4
        assert got[i]["edited"] == text[: len(text) - n] + other[:n] and got[i]["n_chars"] == len(text)
        assert got[i]["fingerprint"] == order_minhash.as_hex(order_minhash.signature(text))
    long = [r for r in got.values() if r["n_chars"] > 500]
    assert all(r["near_edited"] > r["near_next"] for r in long)
    rows = order_minhash.fingerprint_with_next(odd).collect()
    assert len(rows) == len(ODD) and len({r["fingerprint"] for r in rows if r["id"] == 5}) == 1
    assert order_minhash.fingerprint_with_next(empty).count() == 0
    one = order_minhash.fingerprint_with_next(odd.filter("doc_id = 4")).collect()
    assert one[0]["near_next"] == 1.0
    words = [f"w{i}" for i in range(300)]
    swapped = words[150:] + words[:150]
    sketch = [order_minhash.signature(" ".join(w)) for w in (words, swapped)]
    assert order_minhash.likeness(*sketch) < 0.8  # the same words in another order are less alike


# --- 9: top-k ------------------------------------------------------------------------------------

def test_topk_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 50)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in (rng.normal(size=6) if i % 3 else np.ones(6) / 2)], 0) for i in range(330)]
    rows += [(700, None, 0), (720, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (740, [float("nan")] * 6, 0), (None, [1.0] * 6, 0), (760, [1.0, 2.0], 0), rows[20], (780, [float("inf")] * 6, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = [(r["query"], r["rank"], r["vec"], r["score"]) for r in topk.top_k(df).collect()]
    value = {i: np.floor(64 * np.array(v)).astype(int) for i, v, _ in rows[:330]}
    want = []
    for q in range(0, 330, 20):
        best = sorted((-int(value[q] @ value[c]), c) for c in value if c != q)[:20]
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    assert sorted(got) == sorted(want)
    few = topk.top_k(df.filter("vec_id < 5")).collect()
    assert len(few) == 4 and topk.top_k(df.limit(0)).count() == 0


# --- 1, 10, 5: classifiers -----------------------------------------------------------------------

def test_toxicity_learns_and_holds_out(spark):
    rng = np.random.default_rng(0)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    rows = []
    for i in range(900):
        words = list(rng.choice(vocabulary, rng.integers(5, 80)))
        toxic = i % 4 == 0
        if toxic:
            words.insert(int(rng.integers(0, len(words))), "zzbad" + str(rng.choice(["er", "ly", "ish"])))
        rows.append((i, " ".join(words), "en", int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    scored = {r["id"]: r for r in toxicity.classify(docs.drop("toxic"), docs.select("doc_id", "toxic"), ~held).collect()}
    out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert np.mean([(scored[r[0]]["score"] >= 0.5) == bool(r[3]) for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in scored.values())


def test_toxicity_thresholds_of_thin_languages_and_long_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "calibrate", lambda counts, own=toxicity.calibrate: seen.append((counts, own(counts))) or seen[0][1])
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    rows = []
    for i in range(500):
        # fr: 9 toxic rows in all; de: only texts too long for the training sample
        lang, toxic = ("fr", i % 50 < 3) if i % 10 < 3 else ("de", i % 20 == 3) if i % 10 == 3 else ("en", i % 3 == 0)
        words = list(rng.choice(vocabulary, 1000 if lang == "de" else 30)) + ["zzbader"] * toxic
        rows.append((i, " ".join(words), lang, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    scored = toxicity.classify(docs.drop("toxic"), docs.select("doc_id", "toxic"), F.lit(True)).collect()
    (counts, (_, thresholds)), = seen
    assert sum(n for lang, label, _, n in counts if (lang, label) == ("de", 1)) == sum(r[3] for r in rows if r[2] == "de") > 0
    assert set(thresholds) == {"en", "fr", "de"}
    assert np.mean([r["flagged"] == bool(rows[r["id"]][3]) for r in scored]) > 0.95


def test_toxicity_calibrates_every_language():
    # all languages cut between steps 1000 and 2000; "thin" has three toxic rows, lower ones; "bulk" many
    counts = [("en", 0, 1000, 500), ("en", 1, 2000, 500), ("thin", 0, 600, 40), ("thin", 1, 900, 3), ("bulk", 0, 600, 400), ("bulk", 1, 900, 300)]
    shift, thresholds = toxicity.calibrate(counts)
    assert set(thresholds) == {"en", "thin", "bulk"}
    assert thresholds["bulk"] <= thresholds["thin"] and thresholds["bulk"] < thresholds["en"]
    assert thresholds["bulk"] < 1 / (1 + np.exp(shift - (900 / toxicity.STEPS - toxicity.LIMIT)))
    alone = toxicity.calibrate([(None, 0, 1000, 5), (None, 1, 2000, 5)])
    assert alone[1] == {} and 1000 < (alone[0] + toxicity.LIMIT) * toxicity.STEPS < 2001


def test_classifiers_on_odd_rows(odd, empty, labels):
    got = toxicity.classify(odd, labels, F.lit(True)).collect()
    assert len(got) == len(ODD) and {r["score"] for r in got} == {0.0}
    both = labels.union(labels.sparkSession.createDataFrame([(5, 0, 1), (7, 1, 0), (8, 0, 1)], labels.schema))
    got = toxicity.classify(odd, both, F.lit(True)).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.classify(empty, labels, F.lit(True)).count() == 0
    assert quality.accepted(odd, labels).count() == len(ODD) and quality.accepted(odd, labels).columns == odd.columns
    assert quality.accepted(odd, both).columns == odd.columns
    assert quality.score(empty, labels).count() == 0


def test_quality_rejects_junk_and_keeps_the_rest(spark):
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]
    rows = []
    for i in range(600):
        words = list(rng.choice(vocabulary, rng.integers(20, 80)))
        bad = i % 5 == 0
        rows.append((i, " ".join(w + ("!!###" if bad else "") for w in words), "en", "s", int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, q int")
    labels = docs.filter("doc_id % 2 = 0").select("doc_id", F.col("q").alias("quality"))
    got = {r["doc_id"]: r["accepted"] for r in quality.score(docs.drop("q"), labels, keep=["doc_id"]).collect()}
    assert np.mean([got[r[0]] == bool(r[4]) for r in rows]) > 0.98


def test_language_id(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs, "doc_id", "text", "lang")
    nothing = F.lit(None).cast("string")
    known = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = langid.identify(docs, model, "doc_id", "text", host=F.col("source"), address=nothing, declared=nothing, markup=False).collect()
    assert np.mean([known[r["id"]] == r["language"] for r in got]) > 0.97
    pages = spark.createDataFrame([
        (1, "http://a.example.fr/x", '<html lang="de"><body></body>'), (2, "http://a.example.com/es/x", None), (3, None, ""),
        (4, "http://b.example.de/", '<html lang="de-AT"><p>der die und'),
    ], "page_id long, url string, html string")
    rows = {r["id"]: r for r in langid.identify(pages, model, "page_id", "html", markup=True, **langid.page_evidence()).collect()}
    assert (rows[1]["declared"], rows[1]["addressed"]) == ("de", "fr") and rows[2]["addressed"] == "es" and rows[2]["language"] == "es"
    assert rows[3]["language"] is not None and rows[4]["language"] == "de"
    assert langid.identify(odd, None, "doc_id", "text", host=F.col("source"), address=nothing, declared=nothing, markup=False).count() == len(ODD)
    assert langid.identify(empty, model, "doc_id", "text", host=F.col("source"), address=nothing, declared=nothing, markup=False).count() == 0


def test_language_id_knows_every_language(spark):
    def word(k, j):
        return "".join(chr(97 + (k * 7919 + j * 104729) // 26 ** p % 26) for p in range(5))

    rows = [(k * 3 + c, " ".join(word(k, j + c) for j in range(20)), f"l{k:03d}") for k in range(120) for c in range(2 if k < 100 else 1)]
    rows += [(900, "zuvor qwert " * 600, "zz")]  # only a long text
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, "doc_id", "text", "lang")
    assert model.languages == sorted({r[2] for r in rows})
    nothing = F.lit(None).cast("string")
    got = langid.identify(docs, model, "doc_id", "text", host=F.lit("h"), address=nothing, declared=F.lit("zz"), markup=False).collect()
    assert np.mean([r["text_language"] == dict((x[0], x[2]) for x in rows)[r["id"]] for r in got]) > 0.95
    assert {r["declared"] for r in got} == {"zz"}


# --- the pipeline --------------------------------------------------------------------------------

def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, SF), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert 0 < len(out) < 1.5 * n and all(r["decodes"] and r["n_tokens"] == len(r["ids"]) for r in out)
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


# --- extra columns -------------------------------------------------------------------------------

CLASHING = ["row", "id", "tk", "fp", "gid", "gtk", "gone", "_gone", "_gid", "shorter", "ident", "_ident", "copy", "copies", "_copies", "order",
            "_order", "cdf", "_cdf", "parts", "rated", "_source", "_text", "_lang", "_quality", "score", "accepted", "ids", "decoded", "a.b", "lid", "cid"]


@pytest.mark.parametrize("apply", [
    lambda d, labels: mixing.mix(d, weights={"s": 1.0}, epochs=1.0), lambda d, labels: lines.deduplicate_lines(d), lambda d, labels: simhash.deduplicate(d),
    lambda d, labels: quality.accepted(d, labels),
])
def test_columns_of_any_name_pass_through(spark, apply):
    rows = [(i, f"word{i} other{i * 7} third{i * 13} more{i} last{i}", "en", "s") for i in range(60)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    wide = plain.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in CLASHING])
    labels = plain.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    got, want = apply(wide, labels), apply(plain, labels)
    assert got.columns == wide.columns
    found = [r.asDict() for r in got.collect()]
    assert sorted(r["doc_id"] for r in found) == sorted(r["doc_id"] for r in want.collect()) != []
    assert all(r[c] == f"{c}{r['doc_id']}" for r in found for c in CLASHING)


def test_pieces_replaces_columns_of_its_names(spark):
    docs = spark.createDataFrame([(1, "some words", "x", "y")], "doc_id long, text string, `a.b` string, ids string")
    got = pieces.encode(docs, queries.MODEL_FILE)
    assert got.columns == ["doc_id", "text", "a.b", "ids", "decoded"]
    row = got.first()
    assert (row["a.b"], row["decoded"]) == ("x", "some words") and len(row["ids"]) > 1


def test_near_dedup_keeps_a_text_without_copies_beside_one_with(spark):
    x, y = "alpha beta gamma delta epsilon zeta eta theta", "one quite different text about ships and harbours in winter"
    docs = spark.createDataFrame([(1, x), (2, x), (2, y), (3, None), (4, "")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"]) for r in simhash.deduplicate(docs).collect())
    assert got == [(1, x), (2, y), (3, None)]


def test_quality_with_text_ids_and_clashing_labels(spark):
    docs = spark.createDataFrame([(f"k{i}", "plain words here " * 5 if i % 2 else "!!## ??", "en", "s") for i in range(80)],
                                 "doc_id string, text string, lang string, source string")
    labels = docs.select("doc_id", F.when(F.col("text") == "!!## ??", 0).otherwise(1).alias("quality"))
    labels = labels.union(spark.createDataFrame([("k0", 1), (None, 1)], labels.schema))
    got = {r["doc_id"]: r["accepted"] for r in quality.score(docs, labels, keep=["doc_id"]).collect()}
    assert len(got) == 80 and all(got[f"k{i}"] for i in range(1, 80, 2))


def test_pieces_of_a_long_text_score_as_the_whole(monkeypatch):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(60)]
    texts = [" ".join(rng.choice(words, n)) for n in (0, 1, 6, 7, 8, 9, 13, 14, 15, 200)]
    model = toxicity.train([" ".join(rng.choice(words, 20)) for _ in range(40)], [i % 2 for i in range(40)])
    whole = toxicity.Scorer(model).logits(texts)
    monkeypatch.setattr(toxicity, "PIECE", 7)
    assert np.allclose(toxicity.Scorer(model).logits(texts), whole, atol=1e-5)
