"""Operators of the training-data pipeline on small fixtures: brute force, edge
cases (nulls, empty tables, repeated rows, clashing column names) and bounds."""

import collections
import hashlib
import html
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kindred.llm import common, decontaminate, embedding_dedup, html_wrapper, language_id, line_dedup, mixing, probminhash, secrets, toxicity, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, pos string, line string, size string, host string"


def docs_of(spark, rows):
    """(doc_id, text, lang, source) rows with further columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, l, s, None, "x", "y", "z", "h") for i, t, l, s in rows], DOCS)


def sentences(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta"]) + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture(scope="module")
def base(spark):
    rows = [(None, None, None, None), (1, None, "en", None), (2, "", "en", "a"), (3, "   \n\n ", "en", "a"), (4, "one two", None, "b"),
            (5, sentences(1, 60), "en", "b"), (5, sentences(1, 60), "en", "b"), (6, sentences(1, 60) + " tail", "en", "c"),
            (7, "x" * 200_000 + " " + sentences(2, 3000), "de", "c"), (8, "ñandú \U0001F600 é", "es", "c")]
    return docs_of(spark, rows)


def empty(df):
    return df.limit(0)


def test_empty_word_constant(spark):
    assert np.uint64(xxhash.xxh64(b"", seed=42).intdigest()) == common.EMPTY_WORD
    assert spark.range(1).select(F.xxhash64(F.lit(""))).first()[0] == np.int64(common.EMPTY_WORD.view(np.int64))


def test_shingles_match_python(spark):
    texts = ["", "a", "a b c d", "a b c d e", "a b c d e f", "--a b--", None]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(common.word_hashes().alias("w")).collect()
    words = [np.array(r.w, dtype=np.int64).view(np.uint64) for r in rows]
    flat, off = np.concatenate(words), np.concatenate(([0], np.cumsum([len(w) for w in words])))
    sh, out = common.shingles(flat, off)
    assert np.diff(out).tolist() == [0, 1, 1, 1, 2, 1, 0]
    assert sh[out[4]] == sh[out[3]]


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in common.components(e).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


# --- 3 line dedup
def lines_brute(rows, min_docs):
    strip = " \t\n\x0b\x0c\r"
    key = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip(strip))
    where = collections.defaultdict(set)
    for i, t in rows:
        for s in (t or "").split("\n"):
            where[key(s)].add(i)
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [s for s in own if not key(s) or len(where[key(s)]) < min_docs]
        out.append((i, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def test_line_dedup_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        own = [rng.choice(["Hot Line", " hot line\t", "HOT LINE", f"own {i}", "", f"shared {rng.randrange(30)}", "é É"]) for _ in range(rng.randrange(1, 12))]
        rows.append((i, "\n".join(own)))
    rows += [(300, None), (301, ""), (302, "\n\n"), (303, "Hot line\n" * 50)]
    df = docs_of(spark, [(i, t, None, None) for i, t in rows])
    for parts in (1, 40):  # a run cut by many borders, too
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = line_dedup.dedup_digest(df.repartition(7), 10, 1).collect()
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        assert sorted(tuple(r) for r in got) == lines_brute(rows, 10)


def test_stream_runs_borders():
    import pyarrow as pa
    rows = [(1, 1, d, d, 0) for d in range(4)] + [(2, 2, d, d, 0) for d in range(12)] + [(3, 3, d, d, 0) for d in range(3)]
    out = collections.Counter()
    cut = [rows[:2], rows[2:9], rows[9:]]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[c] for r in part]) for c in range(5)], names=list("abcde")) for part in cut]
    for b in line_dedup.stream_runs(10)(iter(batches)):
        for h, s in zip(b.column(0).to_pylist(), b.column(5).to_pylist()):
            out[h, s] += 1
    assert out == {(2, line_dedup.DROP): 12, (1, line_dedup.PENDING): 4, (3, line_dedup.PENDING): 3}


def test_line_dedup_edges(spark, base):
    assert line_dedup.dedup_digest(base).count() == base.count()
    kept = line_dedup.dedup_lines(base)
    assert kept.columns == base.columns and kept.count() == base.count()
    assert line_dedup.dedup_digest(empty(base)).count() == 0


def test_bitmap_round_trip():
    keep = line_dedup.unpack(line_dedup.pack([0, 9, 100_000]), 100_003)
    assert np.flatnonzero(~keep).tolist() == [0, 9, 100_000]


# --- 2 mixing
def targets_brute(sizes, weights=(5, 2, 1), cap=3.0):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    t, left, rest = {}, float(sum(sizes.values())), set(names)
    while rest:
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] > cap * sizes[s]}
        if not over:
            return t | share
        for s in over:
            t[s] = cap * sizes[s]
        left = sum(sizes.values()) - sum(t.values())
        rest -= over
    return t


def test_mixing_targets_and_totals(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 400)), None, s) for i in range(3000)
            for s in [rng.choice(["a", "b", "c", "c", "c", "c", "c", "d", None])]]
    rows.append((9999, "tiny text", None, "A"))
    df = docs_of(spark, rows)
    got = mixing.mix_sources(df, block=200).toPandas()
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t))
    want = targets_brute(dict(sizes))
    got["s"] = got["source"].where(got["source"].notna(), None)
    for s, g in got.groupby("s", dropna=False):
        s = None if s is None or s != s else s
        assert g.source_size.iloc[0] == sizes[s]
        assert math.isclose(g.target.iloc[0], want[s], rel_tol=1e-9)
        assert abs(g.taken.sum() - want[s]) <= max(2, 0.01 * want[s])
    assert (got.taken <= 3 * got["size"]).all() and len(got) == len(rows)
    again = mixing.mix_sources(df.repartition(5), block=200).toPandas()
    key = ["doc_id", "taken"]
    assert got.sort_values(key)[key].values.tolist() == again.sort_values(key)[key].values.tolist()


def test_flight_keeps_sums():
    rng = random.Random(2)
    x = [float(rng.randrange(1, 100)) for _ in range(500)]
    p = [0.3] * 500
    q = mixing.flight(x, p, [rng.random() for _ in range(1000)])
    assert sum(1 for v in q if 1e-9 < v < 1 - 1e-9) <= 2
    assert math.isclose(sum(q), 150, abs_tol=1e-6) and math.isclose(sum(a * b for a, b in zip(x, q)), 0.3 * sum(x), rel_tol=1e-9)


def test_mixing_edges(spark, base):
    assert mixing.mix_sources(base).count() == base.count()
    assert mixing.mix_sources(empty(base)).count() == 0
    assert set(mixing.mixed_documents(base).columns) == set(base.columns) | {"copies"}


# --- 5 and 10: shingles in Python
def shingle_set(t):
    w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_decontamination_brute_force(spark):
    rng = random.Random(3)
    items = [(i, sentences(1000 + i, rng.choice([3, 5, 12, 40, 70]))) for i in range(40)] + [(90, None), (91, "")]
    rows = []
    for i in range(150):
        t = sentences(i, rng.choice([4, 30, 400, 3000])).split()
        if i % 3 == 0:
            own = items[rng.randrange(40)][1].upper().split()
            if i % 2:
                own[len(own) // 2] = "changed"
            at = rng.randrange(len(t))
            t[at:at] = own
        rows.append((i, ", ".join(t), None, None))
    rows.append((500, items[0][1], None, None))
    rows.append((501, None, None, None))
    got = {(r.did, r.item_id) for r in decontaminate.contamination(
        docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for i, t, _, _ in rows:
        own = shingle_set(t)
        want |= {(i, k) for k, q in items if shingle_set(q) and len(own & shingle_set(q)) >= 0.8 * len(shingle_set(q))}
    assert got == want and len(want) > 20


def test_decontamination_short_and_scattered_items(spark):
    items = [(i, sentences(2000 + i, 5 if i < 160 else 6 + i % 3)) for i in range(200)] + [(900, sentences(2900, 24))]
    rows = [(i, q + " " + sentences(i, 600) if i % 4 else sentences(i, 300) + " " + q + " " + sentences(i + 1, 300), None, None) for i, q in items[:200]]
    far = items[-1][1].split()
    rows.append((900, " ".join(far[:14]) + " " + sentences(7, 2000) + " " + " ".join(far[10:]), None, None))
    got = {(r.did, r.item_id) for r in decontaminate.contamination(
        docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(i, i) for i, _ in items}


def test_decontamination_edges(spark, base):
    items = spark.createDataFrame([(1, sentences(1, 60))], "item_id long, text string")
    assert {r.did for r in decontaminate.contamination(base, items).collect()} == {5, 6}
    assert decontaminate.clean_documents(base, items).columns == base.columns
    assert decontaminate.contamination(empty(base), items).count() == 0
    assert decontaminate.contamination(base, items.limit(0)).count() == 0


def test_near_duplicates_brute_force(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for g in range(60):
        text = sentences(g, rng.choice([6, 50, 200])).split()
        for _ in range(rng.choice([1, 1, 2, 5, 30 if g < 3 else 2])):
            t = list(text)
            for _ in range(rng.randrange(0, 3 if len(t) < 100 else 6)):
                t[rng.randrange(len(t))] = f"new{rng.randrange(10**6)}"
            rows.append((n, " ".join(t), None, None))
            n += 1
    got = {r.did: r.component_id for r in probminhash.near_duplicates(docs_of(spark, rows)).collect()}
    sets = [shingle_set(t) for _, t, _, _ in rows]
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a in range(n):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in range(n)}


def test_prefix_pairs_find_every_similar_pair(spark):
    rng = random.Random(6)
    core = [rng.getrandbits(40) for _ in range(80)]
    sets = [sorted(set(core[rng.randrange(12):]) | {rng.getrandbits(40) for _ in range(rng.randrange(12))}) for _ in range(80)]
    frame = spark.createDataFrame(list(enumerate(sets)), "id long, keys array<long>")
    nodes = frame.select("id", F.col("id").alias("comp"))
    found = {(r.a, r.b) for r in probminhash.prefix_pairs(nodes, frame, 0.8).collect()}
    similar = {(a, b) for a in range(80) for b in range(a) if len(set(sets[a]) & set(sets[b])) >= 0.8 * len(set(sets[a]) | set(sets[b]))}
    assert similar and similar <= found


def test_probminhash_estimates_probability_jaccard():
    key = np.arange(1, 301, dtype=np.uint64) * np.uint64(7919)
    row = np.concatenate((np.zeros(200, dtype=np.int64), np.ones(200, dtype=np.int64)))
    both = np.concatenate((key[:200], key[100:300]))
    sig = probminhash.signatures(row, both, np.ones(400), 2)
    assert abs((sig[0] == sig[1]).mean() - 1 / 3) < 0.12


def test_near_duplicates_edges(spark, base):
    got = probminhash.near_duplicates(base).collect()
    assert len(got) == base.count()
    by = collections.defaultdict(set)
    for r in got:
        by[r.did].add(r.component_id)
    assert by[5] == by[6] == {5} and by[4] == {4}
    kept = probminhash.keep_one(base)
    assert kept.columns == base.columns and kept.filter("doc_id in (5, 6)").count() == 1
    assert probminhash.near_duplicates(empty(base)).count() == 0


def test_near_duplicates_with_repeated_passages(spark):
    rows = []
    for i in range(60):
        t = sentences(5000 + i, 200)
        passage = " ".join(t.split()[:60])
        rows += [(2 * i, t, None, None), (2 * i + 1, " ".join([passage] * 150) + " " + t, None, None)]
    sets = {i: shingle_set(t) for i, t, _, _ in rows}
    assert all(len(sets[2 * i] & sets[2 * i + 1]) >= 0.9 * len(sets[2 * i] | sets[2 * i + 1]) for i in range(60))
    got = {r.did: r.component_id for r in probminhash.near_duplicates(docs_of(spark, rows)).collect()}
    assert got == {i: i - i % 2 for i in sets}


# --- 4 embeddings
def test_embeddings_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 16))
    x[300:500] = x[:200] + rng.normal(size=(200, 16)) * 0.3
    x[500:560] = x[0]
    rows = [(int(i), [float(v) for v in r], 1) for i, r in enumerate(x)]
    rows += [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [None] + [1.0] * 15, 1), (1004, [1.0, 2.0], 1), (1005, [2.0, 4.0], 1), (1006, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, tile int")
    old, embedding_dedup.CELL = embedding_dedup.CELL, 64
    got = {r.vec_id: r for r in embedding_dedup.near_duplicate_vectors(df).collect()}
    embedding_dedup.CELL = old
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = u @ u.T >= 0.9
    np.fill_diagonal(links, False)
    n = links.sum(axis=1)
    assert sum(got[i].n_links for i in range(600)) >= 0.98 * n.sum()
    assert all(got[i].n_links <= n[i] for i in range(600))
    assert got[500].component_id == 0 and not got[500].kept and got[0].kept
    assert [got[i].n_links for i in (1000, 1001, 1002, 1003, 1004, 1005, 1006)] == [0, 0, 0, 0, 1, 1, 0]
    assert got[1005].component_id == 1004 and len(got) == len(rows)
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("filled", [6, 8, 64])
def test_embeddings_that_fill_few_dimensions(spark, filled, monkeypatch):
    """Links across cell borders are found whatever the effective dimension is."""
    rng = np.random.default_rng(filled)
    base = rng.normal(size=(1500, filled))
    x = np.concatenate([base, base + rng.normal(size=base.shape) * rng.uniform(0.25, 0.45, size=(len(base), 1))]) @ rng.normal(size=(filled, 64))
    monkeypatch.setattr(embedding_dedup, "CELL", 100)  # thirty cells
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicate_vectors(df).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    n = (u @ u.T >= 0.9).sum(axis=1) - 1
    assert all(got[i] <= n[i] for i in got) and sum(got.values()) >= 0.995 * n.sum() > 0


def test_embeddings_with_repeated_ids(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (7, [2.0, 0.0]), (7, [1.0, 0.01]), (8, [1.0, 1.0]), (8, None), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_duplicate_vectors(df).collect()), key=str)
    assert got == sorted([(5, 2, 5), (5, 0, 5), (7, 2, 5), (7, 2, 5), (8, 0, 8), (8, 0, 8), (None, 0, None)], key=str)


# --- 1 urls
def test_url_templates_reach_every_depth(spark):
    """Branches that differ only far below the root are told apart by their labels."""
    rows = [(i, f"http://h.org/a/b/c/d/{'spam' if i % 2 else 'good'}/x{i}/page") for i in range(60)] + [(99, "http://h.org/" + "s/" * 40 + "end")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2 == 1) for i in range(40)], "page_id long, blocked boolean")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, rules=(), labels=labels).collect()}
    assert got == {i: "block" if i % 2 and i < 60 else "allow" for i, _ in rows}


def test_url_filter_rules_and_templates(spark):
    rows = [(1, "https://A.Example.com/en/5?x"), (2, "http://www.example.com/en/x"), (3, "x://com/"), (4, "http://notexample.com/en/1"),
            (5, "http://b.net/es/1"), (6, "http://b.net/de/1"), (7, None), (8, "no scheme"), (9, "http://example.com"), (10, "http://EXAMPLE.com#/en/"), (11, "a://b://c/d")]
    got = {r.page_id: r for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert [(got[i].rule, got[i].verdict) for i in (1, 2, 3, 4, 5)] == [
        ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("com/", "allow"), ("com/", "allow"), ("net/es/", "block")]
    assert got[6].rule is None and (got[7].host, got[7].path, got[8].host) == ("", "", "") and got[9].rule is None
    assert (got[11].host, got[11].path) == ("b:", "//c/d") and got[7].verdict == "allow"


def test_url_filter_rejects_labelled_template(spark):
    rows = [(i, f"http://h.org/{'shop' if i % 2 else 'blog'}/{i}/page") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, bool(i % 2)) for i in range(200)], "page_id long, blocked boolean")
    got = url_filter.filter_urls(pages, rules=(), labels=labels).collect()
    assert all(r.verdict == ("block" if r.page_id % 2 else "allow") for r in got)
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


# --- 6 secrets
def test_secrets_base_and_model(spark):
    rng = random.Random(8)
    token = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    texts = [None, "", "secret=token:abcdef", "é Token = \"abcdef\" AKIA" + "A1" * 8, "0123456789abcdef01234567 0123456789abcdef",
             "xAPIKEY: 'q' password:longenough", "before " + token(40) + " after", "plainordinarylongwordsgohere internationalization"]
    texts += [f"the ordinary words number {i} are written here configuration_parameter internationalization" for i in range(60)]
    texts += [f"token = \"{token(32)}\"" for _ in range(60)]
    df = docs_of(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in secrets.scan_secrets(df).collect()}
    rx = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    for i, t in enumerate(texts):
        t = t or ""
        spans = [(m.start(), 0, "assign", m.end()) for m in rx.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        want = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), t
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(s[1] == r for s in spans) for r in range(3))
    assert got[6].spans == "random:7:47" and got[7].spans == "" and got[0].spans == ""
    assert secrets.scan_secrets(empty(df)).count() == 0
    plan = secrets.scan_secrets(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- 7 language
def test_language_id_held_out(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    got = language_id.identify(df).join(df.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 10 and (held.lang == held.lang_pred).mean() >= 0.95
    assert got.score.between(0, 1).all() and got.rejected.mean() < 0.02


def test_language_id_edges(spark, base):
    got = language_id.identify(base).collect()
    assert len(got) == base.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 3))
    assert language_id.keep_identified(base).columns == base.columns
    assert language_id.identify(empty(base)).count() == 0
    assert {r.lang_pred for r in language_id.identify(base.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_kneser_ney_sums_to_one():
    import pandas as pd
    text = "the cat sat on the mat and the dog ran"
    g, c = np.unique(language_id.grams(text), return_counts=True)
    model = language_id.Model(pd.DataFrame({"lang": "en", "gram": g.view(np.int64), "n": c}))
    letters = model.orders[0]["keys"]
    context = language_id.grams("the")[1] & ~np.uint64(0xFFFF)
    p = np.exp(model.log_p(context | letters))[:, 0].sum()
    assert p <= 1 + 1e-9 and p > 0.9


def test_language_pieces_keep_every_gram(spark):
    rng = random.Random(11)
    words = {l: ["".join(rng.choice(c) for _ in range(6)) for _ in range(400)] for l, c in (("hot", "abcdefghij"), ("rare", "klmnopqrst"))}
    rows = [(i, " ".join(rng.choice(words[l]) for _ in range(60)), l, "s") for i in range(200) for l in ["rare" if i % 40 < 2 else "hot"]]
    df = docs_of(spark, rows)
    whole = {r.doc_id: r for r in language_id.identify(df).collect()}
    old, language_id.MAX_CELLS = language_id.MAX_CELLS, 4000
    try:
        pieces = {r.doc_id: r for r in language_id.identify(df).collect()}
    finally:
        language_id.MAX_CELLS = old
    assert whole.keys() == pieces.keys() and all(whole[i].lang_pred == pieces[i].lang_pred == l for i, _, l, _ in rows)
    assert all(math.isclose(whole[i].entropy, pieces[i].entropy, rel_tol=1e-5) and whole[i].rejected == pieces[i].rejected for i in whole)


# --- 8 html
def page(body, menu=("Home", "About"), note="Accept cookies"):
    return (f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul>{''.join(f'<li><a href=/>{m}</a></li>' for m in menu)}</ul></nav>"
            f"<div class='cookie-notice'>{note}</div><div id=content>{body}</div><div class='comments'><p>nice!</p></div><footer>f</footer></body></html>")


def test_html_extraction(spark):
    rows = [(i, f"http://h{i % 2}.org/{i}", page(f"<h1>Title {i}</h1><p>Text &amp; more {i} <b>bo</b>ld" + "<p>again" * (i % 4))) for i in range(12)]
    rows += [(100, None, None), (101, "http://h0.org/x", ""), (102, "http://h0.org/y", "plain < 5 text"), (103, "http://z.org", "<div><p>a\n b<script>x</p>")]
    got = {r.page_id: r for r in html_wrapper.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(12):
        assert got[i].text == " ".join([f"Title {i} Text & more {i} bold"] + ["again"] * (i % 4))
    assert (got[100].text, got[101].text, got[102].text, got[103].text) == ("", "", "plain < 5 text", "a b")
    assert got[0].n_chars == len(got[0].text) and len(got) == len(rows)


def test_wrapper_groups_and_slots():
    w = html_wrapper.infer([page("<p>one</p>"), page("<p>two</p><p>three</p><hr>", menu=("Home", "About", "Shop"))])
    text = html_wrapper.expression(w)
    assert "(<li> #slot </li>)+" in text and "#slot" in text and "Accept cookies" in text
    assert html_wrapper.main_container(w).endswith("div.content")


def test_html_every_layout_of_a_host_is_whole(spark):
    wrap = "<html><body><div class=top>Menu A B</div>{}</body></html>".format
    rows = [(i, f"http://h.org/{i}", wrap(f"<div class=post><h1>Head {i}</h1><div class=body><p>Long text of post {i}, {'word ' * 40}{i}</p></div></div>")) for i in range(60)]
    rows += [(i, f"http://h.org/{i}", wrap(f"<div class=post><p>Teaser {i}</p></div><div class=story><p>Story {i}</p><p>goes on {i}</p></div>")) for i in range(100, 106)]
    rows += [(i, f"http://h.org/{i}", wrap(f"<section><article class=a><p>First {i}</p></article><article class=b><p>Second {i}</p></article></section>")) for i in range(200, 206)]
    rows += [(300, "http://h.org/300", wrap("<div class='w-1/2'><p>Alone</p></div>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_wrapper.extract_pages(df).collect()}
    assert all(got[i].startswith(f"Head {i} Long text of post {i}") for i in range(60))
    assert all(f"Teaser {i} Story {i} goes on {i}" in got[i] for i in range(100, 106))
    assert all(got[i] == f"First {i} Second {i}" for i in range(200, 206)) and got[300] == "Alone"


def test_html_slots_come_from_the_aligned_wrapper(spark):
    # the constant imprint that only some pages have shares its path with the constant menu
    def wrap(i):
        tail = "<div class=x>Imprint C</div>" if i % 3 == 0 else ""
        return f"<html><body><div class=x>Menu A B</div><div class=post><h2>Head {i}</h2>{f'<p>Text {i}</p>' * (1 + i % 2)}</div>{tail}</body></html>"

    df = spark.createDataFrame([(i, f"http://h.org/{i}", wrap(i)) for i in range(24)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_wrapper.extract_pages(df).collect()}
    assert got == {i: " ".join([f"Head {i}"] + [f"Text {i}"] * (1 + i % 2)) for i in range(24)}
    w = html_wrapper.infer([wrap(i) for i in range(24)])
    assert html_wrapper.expression(w) == ("<html> <body> <div.x> Menu A B </div.x> <div.post> <h2> #slot </h2> (<p> #slot </p>)+ </div.post> "
                                          "(<div.x> Imprint C </div.x>)? </body> </html>")
    paths = [sorted(map(str, html_wrapper.layout_paths(d).collect())) for d in (df.coalesce(1), df.repartition(7))]
    assert paths[0] == paths[1] and len(paths[0]) == 3 and sum("value=None" in p for p in paths[0]) == 2


def test_wrapper_is_bounded():
    groups = html_wrapper.infer([f"<body>{'<h2>a</h2><p>b</p><p>c</p>' * n}</body>" for n in (2, 5)])
    assert html_wrapper.expression(groups) == "<body> (<h2> #slot </h2> (<p> #slot </p>)+)+ </body>"
    pages = ["<body>" + "".join(f"<p class=c{(i * 37 + j) % 500}>t{j}</p>" for j in range(150)) + "</body>" for i in range(20)]
    wide = html_wrapper.infer(pages)
    assert len(wide[0][2][0][2]) <= html_wrapper.SIBLINGS and html_wrapper.main_container(wide) == "body"
    deep = html_wrapper.infer([f"{'<div>' * 3000}text {i}" for i in range(2)])
    assert [p for p, _, _ in html_wrapper.leaves(deep)] == [("div",) * 3000]


# --- 9 toxicity
def test_kernel_matches_definition():
    def brute(a, b, n, d):
        from itertools import combinations
        feats = collections.defaultdict(float), collections.defaultdict(float)
        for f, s in zip(feats, (a, b)):
            for c in combinations(range(len(s)), n):
                f["".join(s[i] for i in c)] += d ** (c[-1] - c[0] + 1)
        return sum(v * feats[1].get(k, 0) for k, v in feats[0].items())
    pairs = [("idiot", "idxiot"), ("scum", "scum"), ("abc", "xyz"), ("pathetic", "path"), ("aaaa", "aaa")]
    got = toxicity.ssk([a for a, _ in pairs], [b for _, b in pairs])
    assert np.allclose(got, [brute(a, b, toxicity.LENGTH, toxicity.DECAY) for a, b in pairs])


def test_toxicity_learns_words(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        t = sentences(i, 40).split()
        if i % 4 == 0:
            t[rng.randrange(40)] = rng.choice(["blockhead", "nincompoop"])
        rows.append((i, " ".join(t) + ".", None, None))
        labels.append((i, int(i % 4 == 0), 1))
    rows += [(1000, None, None, None), (1001, "", None, None), (1002, "you b l o c k h e a d there", None, None), (1003, "such a nincxompoop", None, None), (None, "alpha", None, None)]
    got = toxicity.score_toxicity(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")).toPandas()
    own = got.merge(__import__("pandas").DataFrame(labels, columns=["doc_id", "toxic", "q"]), on="doc_id")
    held = own[own.held_out]
    assert len(held) > 20 and (held.predicted == held.toxic).mean() > 0.95
    by = got.set_index("doc_id")
    assert by.loc[1002].predicted == 1 and by.loc[1003].predicted == 1 and by.loc[1000].predicted == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_toxicity(docs_of(spark, rows), none).agg(F.max("score")).first()[0] == 0


# --- pipeline
def test_pipeline_stages(spark, sf):
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.materialise(stage(spark, docs, sf), name)
        assert after.columns == names and after.count() <= docs.count()
        docs = after
    rows = {r.doc_id: r.text for r in docs.collect()}
    items = [shingle_set(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    sets = {i: shingle_set(t) for i, t in rows.items()}
    assert not any(q and len(q & s) >= 0.8 * len(q) for s in sets.values() for q in items)
    ids = sorted(sets)
    assert not any(sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a in ids for b in ids if a < b)
    mixed = corpus_pipeline.source_mix(spark, docs, sf)
    assert mixed.columns == names + ["copies"] and {r.copies for r in mixed.select("copies").distinct().collect()} <= {1, 2, 3}


def test_letters_beyond_the_bmp():
    assert len(language_id.grams("\U0001F600\U0001F3FD 12 \U0001F600")) == 0
    assert len(language_id.grams("\U00010400\U00010428")) > 0        # Deseret letters
    assert not len(language_id.grams("\ud83d"))                       # half a pair


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {ckpt!r})
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
from kindred.llm.language_id import identify
from kindred.llm.toxicity import score_toxicity
rows = [(i, ("der die das und nicht " if i % 2 else "the and not with that ") * 5 + ("schwachkopf " if i % 4 == 0 else "") + str(i), "de" if i % 2 else "en")
        for i in range(120)]
docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)], "doc_id long, toxic int")
print("RIGHT", sum((r.lang_pred == "de") == (r.doc_id % 2 == 1) for r in identify(docs).collect()))
print("SCORED", score_toxicity(docs, labels).count())
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    """The session starts outside the repository, so Python workers cannot import it."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, ckpt=str(tmp_path / "ckpt"))], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "RIGHT 120" in out.stdout and "SCORED 120" in out.stdout, out.stderr[-2000:]


def test_line_dedup_keeps_texts_out_of_python_workers(spark):
    """Texts went through a pandas UDF: lines beyond the 64th, blank, and dropped in long texts."""
    long = "\n".join(f"own {i}" if i % 3 else " Shared \t" for i in range(300))
    rows = [(i, long.replace("own", f"own{i}")) for i in range(12)] + [(50, None), (51, ""), (None, "shared\nx")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    digest = line_dedup.dedup_digest(df)
    plan = digest._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan and "ArrowEvalPython" not in line_dedup.dedup_lines(df)._jdf.queryExecution().toString()
    got = {r.doc_id: r for r in digest.collect()}
    kept = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    for i, text in rows[:12]:
        want = "\n".join(x for x in text.split("\n") if x != " Shared \t")
        assert kept[i] == want
        assert (got[i].n_lines, got[i].n_dropped, got[i].kept_sha256) == (300, 100, hashlib.sha256(want.encode()).hexdigest())
    assert kept[50] is None and kept[51] == "" and kept[None] == "x"
    assert (got[50].n_lines, got[50].n_dropped) == (1, 0)


def test_language_calibration_reads_every_training_row(spark):
    """Temperature and limits came from the 2,000 training rows of smallest hash; the odd
    text is the row of largest hash."""
    ids = spark.range(2700).filter("crc32(cast(id as string)) % 5 <> 0")
    assert ids.count() > 2000
    last = ids.orderBy(F.xxhash64("id").desc()).first().id
    plain = F.repeat(F.concat(F.lit("the house of "), F.col("id").cast("string"), F.lit(" and the river ")), 4)
    odd = F.lit("zxqj wvkk qzzx jjxq kvvw " * 5)
    df = ids.select(F.col("id").alias("doc_id"), F.when(F.col("id") == last, odd).otherwise(plain).alias("text"),
                    F.lit("en").alias("lang"))
    judge, scored = language_id.fit(df, ["doc_id"])
    entropy = {r.doc_id: judge.entropies(r._parts)[0][0] for r in scored.collect()}
    assert len(entropy) == ids.count() and max(entropy, key=entropy.get) == last
    assert judge.limit == {0: entropy[last]}
    assert {r.doc_id: r.entropy for r in language_id.identify(df).collect()} == pytest.approx(entropy)
