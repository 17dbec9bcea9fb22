"""Cases that each operator's text defines: repeated ids, nulls, long texts, hot groups, and searches against brute force."""

import collections
import itertools
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartospark.llm import compression_classifier as cc
from cartospark.llm import decontamination, exprs, kernels, license_scan, mixing, ngram_join, outliers, shared, substring_dedup, url_trust
from tests.llm.test_operators import frame, lower, shingles, words


def test_no_text_is_given_up_for_a_null_or_a_blank(spark):
    rows = [(1, None), (1, "a real text"), (2, " \n "), (2, "b"), (3, "x"), (3, "x"), (None, "p"), (None, "q"), (4, None), (4, "")]
    got = shared.one_row_per_id(frame(spark, rows))
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted([(1, "a real text"), (2, "b"), (3, "x"), (4, ""), (None, "p"), (None, "q")], key=repr)
    assert got.columns == frame(spark, rows).columns
    found = {r["doc_id"]: r["n_shingles"] for r in ngram_join.ngram_join(frame(spark, rows[:8])).collect() if r["doc_id"]}
    assert found == {1: 1, 2: 1, 3: 1}
    assert {r["doc_id"]: r["kept"] for r in substring_dedup.substring_dedup(frame(spark, rows[:8])).collect()}[1] == "a real text"


def test_folders_of_one_machine_are_refused_on_a_cluster():
    class Context:
        master = "spark://x:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(RuntimeError, match="shares"):
        shared.folder(Session())


@pytest.mark.parametrize("limit", [1, 7, 64])
def test_words_do_not_depend_on_pieces(limit, monkeypatch):
    r = random.Random(limit)
    texts = ["".join(r.choice("ab \n\tXé") for _ in range(r.randrange(200))) for _ in range(30)] + ["y" * 300, " " * 200, ""]
    raw = [t.encode() for t in texts]
    buf, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    whole = kernels.words(buf, offsets, lower=True)
    monkeypatch.setattr(kernels, "SLICE_BYTES", limit)
    for a, b in zip(whole, kernels.words(buf, offsets, lower=True), strict=True):
        assert a.tolist() == b.tolist()
    assert whole[1].tolist() == [len(words(t)) for t in texts]


def test_a_long_text_needs_little_memory():
    import tracemalloc

    text = np.frombuffer((b"lorem ipsum dolor " * 1_200_000)[:20_000_000], np.uint8)
    tracemalloc.start()
    hashed = kernels.words(text, np.array([0, len(text)]))[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(hashed) > 3_000_000 and peak < 16 * len(text)


def test_a_frequent_ngram_of_many_components_is_split(spark, monkeypatch):
    """All documents share a passage that is rare enough for their prefixes; pairs link or not by their own words."""
    monkeypatch.setattr(ngram_join, "SHARE", 5)
    monkeypatch.setattr(ngram_join, "TASK_ENTRIES", 300)  # more tasks than shuffle partitions
    monkeypatch.setattr(ngram_join, "MOST_FREQUENT", 0)
    r = random.Random(8)
    vocab = [f"w{k}" for k in range(40)]
    passage = " ".join(r.choice(vocab) for _ in range(26))
    rows = [(k, f"{passage} " + " ".join(r.choice(vocab[:3]) for _ in range(r.randrange(9)))) for k in range(70)]
    sets = {d: shingles(t) for d, t in rows}
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    for a, b in itertools.combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            up[max(root(a), root(b))] = min(root(a), root(b))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_join(frame(spark, rows)).collect()}
    assert got == {d: root(d) for d in sets}


def test_passages_over_more_tasks_than_partitions(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "TASK_BYTES", 2000)
    r = random.Random(4)
    passage = " ".join(f"p{r.randrange(99)}" for _ in range(60))
    rows = [(k, f"{' '.join(f'a{r.randrange(999)}' for _ in range(r.randrange(80)))} {passage if k % 3 else ''} z{k}") for k in range(40)]
    got = {x["doc_id"]: (x["n_words"], x["n_removed"]) for x in substring_dedup.substring_dedup(frame(spark, rows)).collect()}
    assert got == {k: (len(words(t)), 60 if k % 3 and k > 1 else 0) for k, t in rows}


def test_one_of_each_group_with_and_without_broadcast(spark, monkeypatch):
    text = " ".join(f"q{k}" for k in range(40))
    rows = [(3, text), (1, text + " more"), (2, text), (9, "else"), (None, text), (7, None)]
    expect = [(1, text + " more"), (9, "else"), (None, text), (7, None)]
    for most in (10, 0):
        monkeypatch.setattr(ngram_join, "MOST_IDS", most)
        kept = ngram_join.one_of_each_group(frame(spark, rows))
        assert kept.columns == frame(spark, rows).columns
        assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(expect, key=repr)


@pytest.mark.parametrize("hops", [100])
def test_trust_on_a_chain_is_that_of_a_dense_solve(spark, hops):
    rows = [(k, f"http://h{k}.aa/x", f'<a href="http://h{k + 1}.aa/">n</a>' if k < hops else "") for k in range(hops + 1)] + [(900, "http://h0.aa/good", "")]
    got = {r["host"]: r["trust"] for r in url_trust.judged(spark.createDataFrame(rows, "page_id long, url string, html string"), [("allow", "h0.aa/good")]).collect()}
    n, d = hops + 1, 0.85
    seed, move = np.eye(n)[0], np.zeros((n, n))
    for k in range(hops):
        move[k + 1, k] = 1
    visits = np.linalg.solve(np.eye(n) - d * move, seed)
    for k in range(n):
        assert got[f"h{k}.aa"] == pytest.approx(visits[k] / visits.sum(), abs=1e-8)
    assert got[f"h{hops}.aa"] > 0


def best_determinant(x):
    """The smallest determinant over all subsets of three quarters of the rows, with the operator's floors."""
    h, floor = math.ceil(outliers.SHARE * len(x)), np.diag(np.square(outliers.FLOOR))
    return min(np.linalg.slogdet(np.cov(x[list(s)].T, bias=True) + floor)[1] for s in itertools.combinations(range(len(x)), h))


def test_estimates_reach_the_least_determinant(spark, monkeypatch):
    """Small groups with and without outliers, against all subsets."""
    monkeypatch.setattr(outliers, "MIN_GROUP", 5)
    rows, groups = [], {}
    for g in range(10):
        r = np.random.default_rng(g)
        n = 12 + g % 3
        x = r.normal(size=(n, 5)) @ np.diag([0.6, 0.3, 0.2, 0.4, 0.4]) + r.normal(size=5)
        x[: g % 4] += [0, 2.5, 1.0, 1.5, -2]
        groups[f"g{g}"] = x
        rows += [("en" if g else None, f"g{g}", *map(float, v)) for v in x]
    table = spark.createDataFrame(rows, "lang string, grp string, x0 double, x1 double, x2 double, x3 double, x4 double")
    got = {r["grp"]: r for r in outliers.estimates(table).collect()}
    apart = {g: got[g]["det"] - best_determinant(x) for g, x in groups.items()}
    # steps from a few starts end in a local minimum, which is the least in most groups with outliers and close to it in others
    assert all(-1e-6 < d < 0.8 for d in apart.values()) and all(apart[f"g{g}"] < 0.05 for g in (1, 2, 3, 5, 6, 7)), apart
    x = groups["g3"]
    assert np.allclose([got["g3"][f"m{i}"] for i in range(5)], x[3:].mean(axis=0), atol=0.4)
    assert {r["grp"] for r in outliers.estimates(table.repartition(9)).collect()} == groups.keys()
    monkeypatch.setattr(outliers, "MOST_GROUPS", 0)  # the salted join gives the same
    again = {r["grp"]: r["det"] for r in outliers.estimates(table).collect()}
    assert all(again[g] == pytest.approx(got[g]["det"]) for g in groups)


def test_short_notices_next_to_long_ones_are_found(spark):
    """60 documents, each a notice of 5 words followed by its own notice of 31 words."""
    templates = {f"s{k}": " ".join(f"s{k}x{j}" for j in range(5)) for k in range(60)} | {f"l{k}": " ".join(f"l{k}x{j}" for j in range(31)) for k in range(60)}
    rows = [(k, f"some words before {templates[f's{k}']} {templates[f'l{k}']} and after") for k in range(60)]
    got = {(x["doc_id"], x["template"]) for x in license_scan.scan(frame(spark, [*rows, rows[0]]), templates).collect()}
    assert got == {(k, f"{c}{k}") for k in range(60) for c in "sl"}
    assert sum(x["doc_id"] == 0 for x in license_scan.scan(frame(spark, [rows[0], rows[0]]), templates).collect()) == 4  # row by row


def test_license_parts_against_all_windows(spark):
    """Templates of 5 to 80 words with changed words, against the containment of every part in every window."""
    r = random.Random(21)
    vocab = [f"v{k}" for k in range(60)]
    make = lambda n: [r.choice(vocab) for _ in range(n)]
    given = {f"t{k}": make(r.choice([5, 6, 9, 14, 22, 31, 32, 50, 80])) for k in range(14)}
    rows = []
    for k in range(60):
        parts = [make(r.randrange(70))]
        for name in r.sample(sorted(given), 2):
            w = list(given[name])
            for _ in range(r.randrange(3)):
                w[r.randrange(len(w))] = "changed"
            parts += [w, make(r.randrange(40))]
        rows.append((k, " ".join(itertools.chain(*parts))))
    templates = {name: " ".join(w) for name, w in given.items()}
    half, size = license_scan.WINDOW // 2, 5
    grams = lambda w: {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    expect = collections.Counter()
    for d, t in rows:
        w = t.split()
        windows = [grams(w[at : at + license_scan.WINDOW]) for at in range(0, max(len(w), 1), half)]
        for name, own in given.items():
            last = max(0, len(own) - half)
            for part, at in enumerate([*range(0, last, half - size + 1), last]):
                known = grams(own[at : at + half])
                if max(len(known & x) / len(known) for x in windows) >= 0.75:
                    expect[d, name, part] += 1
    got = collections.Counter((x["doc_id"], x["template"], x["part"]) for x in license_scan.scan(frame(spark, rows), templates).collect())
    assert got == expect and len(expect) > 80
    with pytest.raises(ValueError, match="fit one scan"):
        license_scan.MOST_SHINGLES, before = 3, license_scan.MOST_SHINGLES
        try:
            license_scan.scan(frame(spark, rows), templates)
        finally:
            license_scan.MOST_SHINGLES = before


def test_items_with_repeated_lines_are_found(spark):
    """One shingle many times over: fingerprints are far apart although the bags are similar."""
    r = random.Random(2)
    vocab = [f"u{k}" for k in range(500)]
    items, rows = [], []
    for k in range(12):
        body = [r.choice(vocab) for _ in range(40)]
        items.append((k, " ".join([*body, *["la"] * 14])))
        rows.append((k, " ".join([*body, *["lo"] * 14])))  # 36 + 4 shingles are common or not
        rows.append((100 + k, " ".join([*[r.choice(vocab) for _ in range(9)], *body, *["la"] * 14])))
    rows += [(100, rows[1][1]), (None, rows[1][1])]
    bench = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    bag = lambda w: collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    expect = collections.Counter()
    for d, t in rows:
        w = lower(t)
        for i, text in [*items, items[0]]:
            own, n = bag(lower(text)), len(lower(text))
            best = max((sum((own & bag(w[s : s + n])).values()) for s in range(max(1, len(w) - n + 1))), default=0)
            total = sum(own.values()) + sum(bag(w[:n]).values())
            expect[d, i] += 4 * best >= 3 * (total - best)
    got = collections.Counter((x["doc_id"], x["item_id"]) for x in decontamination.benchmark_matches(frame(spark, rows), bench, Fraction(3, 4)).collect())
    assert got == +expect and expect[100, 0] == 4


def test_classifier_with_repeated_ids_and_conflicting_labels(spark):
    r = random.Random(6)
    text = lambda k: " ".join(r.choice(["the river goes down to the sea", "hills rise over the town"] if k % 2 else ["BUY NOW!!! $$$", "CLICK ||| FREE"]) for _ in range(30))
    rows = [(k, text(k)) for k in range(80)] + [(1, "BUY NOW!!! $$$"), (1, None), (1, "BUY NOW!!! $$$")]
    labels = spark.createDataFrame([(k, k % 2) for k in range(80)] + [(3, 0), (3, 1), (5, 1)], "doc_id long, quality int")
    first, again = (cc.fit(frame(spark, x), labels) for x in (rows, rows[::-1]))
    assert first == again
    assert len(cc.scored(frame(spark, rows), first).collect()) == len(rows)


def test_mixing_takes_rows_of_one_id_alike(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "d e f g"), (2, None), (None, "x y"), (3, "z " * 40)]
    docs = frame(spark, rows).withColumn("_mix0", F.lit(1))
    got = mixing.mixed_documents(docs).collect()
    assert set(docs.columns) == set(got[0].__fields__) and all(r["text"] for r in got)
    count = collections.Counter((r["doc_id"], r["text"]) for r in got)
    assert count[1, "a b c"] % 2 == 0 and max(count.values()) <= 6


def test_pieces_of_the_word_expression(spark):
    texts = [None, "", " \n", "a", " a\x0bb\tc  d "]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(exprs.words(F.col("t")).alias("w")).collect()
    assert [r["w"] for r in got] == [[], [], [], ["a"], ["a", "b", "c", "d"]]
