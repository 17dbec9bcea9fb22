"""Each operator against brute force, and the cases that its text defines."""

import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from cartospark.llm import compression_classifier as cc
from cartospark.llm import decontamination, feistel, kernels, license_scan, mixing, ngram_join, outliers, pitman_yor, substring_dedup, url_trust
from cartospark.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, size int, part int, kind string"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return [w.encode().lower() for w in words(text)]


def corpus(seed=1, n=60):
    """Texts with exact and near copies, shared passages, and the odd cases."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(r.randint(1, 6))) for _ in range(400)]
    make = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    base, passage = make(120), make(70)
    texts = [make(r.randint(1, 150)) for _ in range(n)]
    texts += [base, base, base.upper(), base + " tail", base.replace(" ", "\n", 3), f"{make(40)} {passage} {make(30)}", f"{passage} {make(60)}", f"{make(5)} {passage}"]
    for k in range(8):
        w = base.split()
        for _ in range(1 + k // 2):
            w[r.randrange(len(w))] = f"new{k}"
        texts.append(" ".join(w))
    texts += ["", "   \n\t", None, "one", "one", "two words", "a b c d", "x " * 5000, "é ü ñ é\x85ü \x1c x"]
    return [(k, t) for k, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "en", f"s{(k or 0) % 3}", 0, 7, 7, 7, "x") for k, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs():
    return corpus()


def shingles(text, size=5):
    w = lower(text)
    return frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def test_kernels_split_words_as_the_pattern_does(docs):
    texts = [t for _, t in docs]
    for _, _, buf, offsets in kernels.text_slices(pa.array(texts), 1 << 30):
        _, counts, first, end = kernels.words(buf, offsets)
        found = [bytes(buf[a:b]).decode() for a, b in zip(first, end, strict=True)]
    assert counts.tolist() == [len(words(t)) for t in texts]
    assert found == [w for t in texts for w in words(t)]


def test_kernels_pack_round_trip():
    r = np.random.default_rng(0)
    a, b = np.sort(r.integers(0, 1 << 63, 500).astype(np.uint64)), r.integers(0, 9, 500).astype(np.uint64)
    x, y = kernels.unpack(kernels.pack(a, b, delta=1), 2, delta=1)
    assert (x == a).all() and (y == b).all()
    assert all(len(c) == 0 for c in kernels.unpack(kernels.pack(a[:0], b[:0], delta=1), 2, delta=1))
    ids = np.array([0, -1, 1, -(2**63), 2**63 - 1])
    assert (kernels.unzigzag(kernels.zigzag(ids)) == ids).all()


def test_window_hashes_are_equal_only_for_equal_windows():
    text = b"a b c a b c a b d"
    buf = np.frombuffer(text, np.uint8)
    word, counts, _, _ = kernels.words(buf, np.array([0, len(text)]))
    _, start, hashed = kernels.windows(word, counts, 3)
    plain = text.split()
    groups = collections.defaultdict(set)
    for s, h in zip(start.tolist(), hashed.tolist(), strict=True):
        groups[h].add(tuple(plain[s : s + 3]))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({tuple(plain[k : k + 3]) for k in range(len(plain) - 2)})


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 2), (5, 4), (9, 9), (10, 11), (11, 12), (12, 13), (13, 14), (7, None), (100, 1)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert dict((r[0], r[1]) for r in found) == {1: 1, 2: 1, 3: 1, 100: 1, 4: 4, 5: 4, 10: 10, 11: 10, 12: 10, 13: 10, 14: 10}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_components(rows):
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            same = len(sets[a] & sets[b])
            if a < b and same and 100 * same >= 75 * (len(sets[a]) + len(sets[b]) - same):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def test_ngram_join_against_all_pairs(spark, docs):
    found = ngram_join.ngram_join(frame(spark, docs)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(docs)


def test_ngram_join_with_frequent_ngrams(spark, monkeypatch):
    """A large group of copies and near copies, so that frequent n-grams are broadcast and leaders are used."""
    r = random.Random(3)
    base = [f"w{r.randrange(50)}" for _ in range(60)]
    rows = []
    for k in range(150):
        w = list(base)
        for _ in range(k % 5):
            w[r.randrange(60)] = f"e{k}"
        rows.append((k, " ".join(w)))
    monkeypatch.setattr(ngram_join, "LOCAL_FREQUENT", 10)
    found = ngram_join.ngram_join(frame(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(rows)


def test_ngram_join_cases(spark):
    assert ngram_join.ngram_join(frame(spark, [])).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, None), (2, "a b c d e f"), (None, "a b c d e f"), (None, None), (3, ""), (4, ""), (-5, "A B C D E F")]
    found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_join(frame(spark, rows)).collect()), key=repr)
    # the rows of id 1 are one document, whose text is that of the rows that have one
    assert found == sorted([(1, 2, -5), (2, 2, -5), (None, 2, None), (None, 0, None), (3, 0, 3), (4, 0, 4), (-5, 2, -5)], key=repr)
    kept = ngram_join.one_of_each_group(frame(spark, [(1, "a b c d e"), (2, "a b c d e"), (3, None), (None, "a b c d e")]))
    assert kept.columns == SCHEMA.replace(",", "").split()[::2] and sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 3, None]


def brute_substrings(rows, size):
    seen, out = set(), {}
    for d, t in sorted(rows):
        w = words(t)
        mask, own = [False] * len(w), []
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            own.append(key)
            if key in seen:
                mask[k : k + size] = [True] * size
        seen.update(own)
        out[d] = (len(w), sum(mask), " ".join(x for x, m in zip(w, mask, strict=True) if not m))
    return out


def test_cover_is_one():
    assert {(a - b) % substring_dedup.PERIOD for a in substring_dedup.COVER for b in substring_dedup.COVER} == set(range(substring_dedup.PERIOD))


@pytest.mark.parametrize(("size", "period", "cover"), [(50, 31, substring_dedup.COVER), (12, 7, (0, 1, 3))])
def test_substring_dedup_against_all_windows(spark, docs, size, period, cover):
    found = substring_dedup.substring_dedup(frame(spark, docs), size, period, cover).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in found} == brute_substrings(docs, size)


def test_substring_dedup_cases(spark):
    run = lambda rows: sorted(((r["doc_id"], r["n_removed"], r["kept"]) for r in substring_dedup.substring_dedup(frame(spark, rows), 12, 7, (0, 1, 3)).collect()), key=repr)
    text = " ".join(f"w{k}" for k in range(12))
    assert run([]) == []
    assert run([(2, text), (-3, text), (None, text), (None, text), (7, None), (8, "")]) == sorted([(2, 12, ""), (-3, 0, text), (None, 0, text), (None, 0, text), (7, 0, ""), (8, 0, "")], key=repr)
    assert run([(4, text), (4, text)]) == [(4, 0, text)]  # one document


URLS = [
    (1, "http://a.example.com/en/7198?q#f", '<a href="//b.example.org/x">'),
    (2, "https://EXAMPLE.com/en/1", '<a href="http://bad.test/">'),
    (3, "https://x.example.net/de/81", None),
    (4, "https://bad.test/page", '<A HREF=\'http://a.example.com/\'><a href="/en/own">'),
    (5, None, ""),
    (6, "no scheme", "<a href='http://bad.test'>"),
    (7, "http://netx/de/", ""),
    (8, "http://far.org/es/1", '<a href="http://bad.test/">'),
    (9, "http://host.only", ""),
    (9, "http://host.only", ""),
    (10, "x://B.example.org?u=http://c/", '<a href="http://far.org/">'),
]
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def test_url_rules(spark):
    pages = spark.createDataFrame([(*u, "clash") for u in URLS], "page_id long, url string, html string, host string")
    rows = url_trust.judged(pages, RULES).collect()
    got = {r["page_id"]: r for r in rows}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("a.example.com", "/en/7198", "example.com/en/7", "allow")
    assert (got[2]["host"], got[2]["rule"], got[2]["verdict"]) == ("example.com", "com/en/", "block")
    assert (got[3]["rule"], got[3]["verdict"]) == ("example.net/de/8", "block")
    assert (got[5]["host"], got[5]["path"], got[5]["rule"]) == ("", "", None) and got[6]["host"] == ""
    assert got[7]["rule"] is None and (got[9]["host"], got[9]["path"]) == ("host.only", "")
    assert got[10]["host"] == "b.example.org" and got[10]["path"] == ""
    # who links to a blocked host is suspect: b.example.org links to far.org
    assert got[10]["distrust"] > 0 and url_trust.judged(pages.limit(0), RULES).count() == 0
    assert len(rows) == len(URLS)


def test_propagation_is_pagerank(spark):
    edges = [("t", "a", "b", 1), ("t", "a", "c", 3), ("t", "b", "c", 1), ("t", "c", "a", 1), ("t", "c", "d", 1)]
    got = url_trust.propagated(spark.createDataFrame(edges, "kind string, src string, dst string, n long"), spark.createDataFrame([("t", "a", 2.0)], "kind string, host string, weight double"), steps=60)
    names, index = "abcd", {c: k for k, c in enumerate("abcd")}
    out = collections.Counter()
    for _, s, _, n in edges:
        out[s] += n
    x = np.array([1.0, 0, 0, 0])
    for _ in range(200):
        y = np.zeros(4)
        for _, s, d, n in edges:
            y[index[d]] += 0.85 * x[index[s]] * n / out[s]
        y[0] += 1 - y.sum()
        x = y
    assert {r["host"]: pytest.approx(r["score"], abs=1e-7) for r in got.collect()} == dict(zip(names, x.tolist(), strict=True))


def test_distrust_reaches_along_a_long_chain(spark):
    chain = [(k, f"http://h{k}.test/", f'<a href="http://h{k + 1}.test/">') for k in range(30)]
    pages = spark.createDataFrame([*chain, (30, "http://h30.test/", "<a href='http://bad.test/'>"), (31, "http://bad.test/", ""), (32, "http://alone.test/", "")], "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_trust.judged(pages, [("block", "bad.test/")]).collect()}
    assert got == {k: "block" for k in range(32)} | {32: "allow"}


def test_propagation_fails_short_of_its_tolerance(spark):
    edges = spark.createDataFrame([("t", "a", "b", 1), ("t", "b", "a", 1)], "kind string, src string, dst string, n long")
    with pytest.raises(RuntimeError, match="still change"):
        url_trust.propagated(edges, spark.createDataFrame([("t", "a", 1.0)], "kind string, host string, weight double"), steps=20)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 16, 17, 1000])
def test_feistel_is_a_permutation(spark, n):
    from pyspark.sql import functions as F

    places = [r[0] for r in spark.range(n).select(feistel.permuted(F.col("id"), n, 7)).collect()]
    assert sorted(places) == list(range(n))
    if n == 1000:
        assert places != sorted(places) and places != [r[0] for r in spark.range(n).select(feistel.permuted(F.col("id"), n, 8)).collect()]


def test_sharding(spark, docs):
    rows = [*docs, (3, "again"), (3, "again"), (None, None), (None, "x")]
    run = lambda r: sorted(tuple(x) for x in feistel.sharded(frame(spark, r).repartition(5), 4, keep=["lang", "size"]).select("doc_id", "size", "text_crc32", "shard", "slot").na.fill(-1, ["doc_id"]).collect())
    got = run(rows)
    assert got == run(list(reversed(rows)))
    by = collections.defaultdict(list)
    for _, _, _, shard, slot in got:
        by[shard].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    raw = sorted((-1 if d is None else d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert [g[:3] for g in got] == raw and run([]) == []


def test_base_statistics(spark, docs):
    texts = [*docs, (900, "a b c a b c\nx\n\nx\n \n#|<"), (901, "p q p q p q p q")]
    got = {r["doc_id"]: r for r in outliers.judged(frame(spark, texts)).collect()}
    for d, t in texts:
        w = words(t)
        tri = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)), d
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and (not r["base_failed"] or not r["kept"])
    assert outliers.judged(frame(spark, [])).count() == 0


def test_outliers_are_rejected_and_clean_rows_kept(spark):
    r = random.Random(5)
    clean = lambda: "\n".join(" ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(12)) for _ in range(r.randint(6, 40)))
    rows = [(k, clean()) for k in range(200)]
    rows += [(1000 + k, re.sub(r"(\w+)", r"\1###", clean())) for k in range(30)]
    table = frame(spark, rows).withColumn("source", __import__("pyspark").sql.functions.lit(None).cast("string"))
    got = {x["doc_id"]: x["kept"] for x in outliers.judged(table).collect()}
    assert sum(got[k] for k in range(200)) >= 199 and not any(got[1000 + k] for k in range(30))


def test_moderate_outliers_are_rejected(spark):
    """Menus, a symbol after two of three words: between the stated quantile and a distance of 60."""
    assert pytest.approx(0.001, rel=1e-4) == math.exp(-outliers.CUTOFF / 2) * (1 + outliers.CUTOFF / 2)  # chi-square of 4 degrees
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9)))
    text = lambda gap: "\n".join(gap.join(f"{word()} {word()}" if k % 2 else word() for k in range(8)) for _ in range(r.randint(6, 40)))
    table = frame(spark, [(k, text(" ")) for k in range(400)] + [(1000 + k, text(" | ")) for k in range(20)])
    got = {x["doc_id"]: x for x in outliers.judged(table).collect()}
    menus = [got[1000 + k] for k in range(20)]
    assert any(x["distance"] < 60 for x in menus), [x["distance"] for x in menus]
    assert not any(x["kept"] for x in menus)
    assert sum(got[k]["kept"] for k in range(400)) >= 396


def test_license_scan(spark):
    rows = [
        (1, "x y z Licensed under the Apache License, Version 2.0. more"),
        (2, "RELEASED UNDER THE MIT LICENSE.\n" + "word " * 300),
        (3, "word " * 100 + "Released under the MIT License. " + "word " * 25 + "Licensed under CC BY-NC 4.0."),
        (4, "Released under the GPL"),
        (5, None),
        (6, ""),
        (None, "Released under the MIT License."),
        (7, "This work is licensed under the GNU General Public License, version 2."),
    ]
    got = sorted(((r["doc_id"], r["template"], r["first_word"]) for r in license_scan.scan(frame(spark, rows)).collect()), key=repr)
    # item 7 has 7 of 8 shingles: 0.875
    assert got == sorted([(1, "Apache-2.0", 3), (2, "MIT", 0), (3, "MIT", 100), (3, "CC-BY-NC-4.0", 130), (None, "MIT", 0), (7, "GPL-3.0", 0)], key=repr)
    assert license_scan.scan(frame(spark, [])).count() == 0
    with pytest.raises(ValueError, match="fewer"):
        license_scan.scan(frame(spark, []), {"short": "a b"})


def test_license_variants_and_texts(spark):
    text = license_scan._text
    comment = lambda t: "\n".join(f" * {line}" for line in t.splitlines())
    apache = text("Apache-2.0", "Licensed under the Apache License", "limitations under the License.")
    rows = [
        (1, 'Licensed under the Apache License, Version 2.0 (the "License");'),
        (2, comment(apache)),
        (3, "released under the MIT License, see below"),
        (4, "It is (Licensed under the MIT license)"),
        (5, "licensed under CC BY-NC 4.0"),
        (6, comment(text("MIT").replace("any\nperson", "any person"))),
        (7, text("BSD-3-Clause")),
        (8, text("MPL-2.0")),
        (9, text("Apache-2.0")),
        (10, "This work is licensed under the GNU General Public License version 3"),
        (11, "plain words about the weather that go on for a while, as is usual in a text without any notice"),
    ]
    found = license_scan.scan(frame(spark, rows)).collect()
    names = collections.defaultdict(set)
    for x in found:
        names[x["doc_id"]].add(x["template"])
    assert names == {1: {"Apache-2.0"}, 2: {"Apache-2.0"}, 3: {"MIT"}, 4: {"MIT"}, 5: {"CC-BY-NC-4.0"}, 6: {"MIT"}, 7: {"BSD-3-Clause"}, 8: {"MPL-2.0"}, 9: {"Apache-2.0"}, 10: {"GPL-3.0"}}
    # every word counts for first_word, the comment marks too
    assert min(x["first_word"] for x in found if x["doc_id"] == 2) == 1


def test_small_parts_in_full_windows_are_found(spark):
    """One-shingle templates within windows full of the shingles of another: too dissimilar for the bands."""
    filler = [f"w{k}" for k in range(320)]
    templates = {"long": " ".join(filler)} | {f"t{k}": f"a{k} b{k} c{k} d{k} e{k}" for k in range(9)}
    rows = []
    for k in range(9):
        at = 32 + 32 * k
        rows.append((k, " ".join(filler[:at]) + f" a{k} b{k} c{k} d{k} e{k} " + " ".join(filler[at:])))
    got = {(x["doc_id"], x["template"]) for x in license_scan.scan(frame(spark, rows), templates).collect()}
    assert {(k, f"t{k}") for k in range(9)} <= got
    # no part of a split template is short
    table = license_scan._template_table(spark, {"long": " ".join(filler[:62])}, 5).collect()
    assert [len(x["known"]) for x in table] == [28, 28, 28]


def test_targets_fill_and_reshare():
    got = {s: t for s, _, t in mixing.targets([("b", 100), ("a", 10), (None, 50)], (1, 2, 3))}
    # a (weight 1), b (2), null (3) of 160: 26.7, 53.3, 80; nothing above three times but a at 30 -> none
    assert got == {"a": pytest.approx(160 / 6), "b": pytest.approx(320 / 6), None: pytest.approx(80)}
    got = {s: t for s, _, t in mixing.targets([("a", 1), ("b", 1), ("c", 998)], (1, 2, 3))}
    assert got == {"a": 3.0, "b": 3.0, "c": pytest.approx(994)}
    assert mixing.targets([], (1, 2)) == [] and mixing.targets([("a", 0)]) == [("a", 0, 0.0)]


def test_mixing(spark):
    r = random.Random(2)
    rows = [(k, " ".join("w" for _ in range(r.randint(0, 20))), "en", r.choice(["s0", "s0", "s0", "s1", None])) for k in range(400)]
    table = spark.createDataFrame([*rows, (None, None, "en", "s1"), (5, "again", "en", "s1")], "doc_id long, text string, lang string, source string")
    got = mixing.mixed(table).collect()
    again = mixing.mixed(table.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == 402
    for source in ("s0", "s1", None):
        own = [x for x in got if x["source"] == source]
        assert abs(sum(x["taken"] for x in own) - own[0]["target"]) <= 21
    assert all(x["taken"] in (0, x["size"], 2 * x["size"], 3 * x["size"]) for x in got)
    copies = mixing.mixed_documents(table.filter("doc_id <> 5"))
    assert copies.columns == table.columns
    count = collections.Counter(x["doc_id"] for x in copies.collect())
    expect = {x["doc_id"]: x["copies"] for x in mixing.mixed(table.filter("doc_id <> 5")).collect() if x["copies"]}
    assert count == expect
    assert mixing.mixed(table.limit(0)).count() == 0


def test_decontamination_against_all_windows(spark):
    r = random.Random(4)
    vocab = [f"v{k}" for k in range(300)]
    make = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(k, make(r.choice([12, 20, 33]))) for k in range(12)] + [(90, make(3)), (91, [])]
    docs = [(k, make(r.randint(1, 120))) for k in range(40)]
    for k in range(12):
        w = list(items[k][1])
        for _ in range(k % 4):
            w[r.randrange(len(w))] = "changed"
        docs.append((100 + k, make(k) + w + make(7)))
    docs += [(200, items[0][1][:11]), (201, items[90 - 78][1])]
    rows = [(d, " ".join(w).upper() if d % 2 else " ".join(w)) for d, w in docs] + [(300, None), (301, ""), (None, " ".join(items[3][1]))]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(92, None)], "item_id long, text string")
    expect = {}
    for d, t in rows:
        w = [x.decode() for x in lower(t)]
        for i, item in items:
            if not item or not w:
                continue
            size = min(5, len(item))
            n = min(len(w), len(item))
            bag = collections.Counter(tuple(item[k : k + size]) for k in range(len(item) - size + 1))
            for s in range(len(w) - n + 1):
                own = collections.Counter(tuple(w[k : k + size]) for k in range(s, s + n - size + 1))
                both = sum((own & bag).values())
                if both and 4 * both >= 3 * (sum(own.values()) + sum(bag.values()) - both):
                    value = both / (sum(own.values()) + sum(bag.values()) - both)
                    if value > expect.get((d, i), (0, 0))[0]:
                        expect[d, i] = (value, s)
    got = {(x["doc_id"], x["item_id"]): (pytest.approx(x["similarity"]), x["start_word"]) for x in decontamination.benchmark_matches(frame(spark, rows), bench).collect()}
    assert got == expect and len(expect) > 5
    clean = decontamination.decontaminated(frame(spark, rows), bench)
    assert sorted((x["doc_id"] for x in clean.collect()), key=repr) == sorted((d for d, _ in rows if not any(e == d for e, _ in expect)), key=repr)
    assert decontamination.benchmark_matches(frame(spark, []), bench).count() == 0
    assert decontamination.benchmark_matches(frame(spark, rows), bench.limit(0)).count() == 0


def test_multi_index_finds_all_within_the_radius():
    r = np.random.default_rng(1)
    items = decontamination.Items(list(range(50)), [" ".join(f"w{r.integers(99)}" for _ in range(20)) for _ in range(50)], 5, Fraction(3, 4), 23)
    for _ in range(200):
        print_ = np.uint64(r.integers(0, 1 << 63)) if r.random() < 0.5 else items.prints[r.integers(50)] ^ np.uint64(r.integers(0, 1 << 20))
        assert items.near(print_).tolist() == np.flatnonzero(np.bitwise_count(items.prints ^ print_) <= 23).tolist()


def test_compression_classifier(spark):
    r = random.Random(6)
    good = lambda: " ".join(r.choice(["the", "river", "goes", "down", "to", "sea", "and", "hills", "rise", "over"]) for _ in range(150))
    bad = lambda: " ".join(r.choice(["BUY!!", "NOW$$$", "###", "win%%%", "FREE!!", "click|||"]) for _ in range(150))
    rows = [(k, good() if k % 3 else bad()) for k in range(300)] + [(900, ""), (901, None), (None, good())]
    labels = spark.createDataFrame([(k, 1 if k % 3 else 0, 0) for k in range(250)] + [(3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    table = frame(spark, rows)
    model = cc.fit(table, labels)
    got = {x["doc_id"]: x for x in cc.scored(table, model).collect()}
    held = [k for k in range(300) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k]["held_out"] == (k in held) for k in range(300)) and got[None]["held_out"] is None
    assert np.mean([(got[k]["score"] >= 0.3) == bool(k % 3) for k in held]) > 0.95
    assert all(0 <= x["score"] <= 1 for x in got.values()) and got[900]["score"] == got[901]["score"]
    kept = {x["doc_id"] for x in cc.accepted(table, model).collect()}
    assert kept == {d for d, x in got.items() if x["score"] >= 0.3}
    alone = cc.fit(table, labels.filter("quality = 1"))
    assert {x["score"] for x in cc.scored(table, alone).collect()} == {1.0}
    assert cc.fit(table, labels.limit(0)).scorer()("x") == 0.5 and cc.scored(table.limit(0), model).count() == 0


def test_a_text_over_the_byte_bound_uses_nothing_up(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(cc, "SAMPLE_BYTES", 20_000)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    fitted = labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    first = fitted.filter("quality = 0").orderBy(F.xxhash64("doc_id")).first()[0]
    rows = [(k, "good river sea hills " * 20 if k % 2 else "BUY NOW win FREE " * (9000 if k == first else 20)) for k in range(40)]
    model = cc.fit(frame(spark, rows), labels)
    assert model.good and model.bad


def test_language_model(spark, docs):
    rows = [(d, t) for d, t in docs if d < 80] + [(None, "one one"), (81, "one two"), (81, "one two")]
    got = pitman_yor.language_model_scores(frame(spark, rows)).collect()
    count, learnt = collections.Counter(), []
    for d, t in rows:
        if d is not None and zlib.crc32(str(d).encode()) % 7 != 2:
            learnt.append(d)
            count.update([*lower(t), None])
    n, v = sum(count.values()), len(count)
    assert len(got) == len(rows)
    tokens = {d: [*lower(t), None] for d, t in rows}
    for x in got:
        w = tokens[x["doc_id"]]
        assert (x["n_tokens"], x["n_known"], x["train_tokens"]) == (len(w), sum(count[y] > 0 for y in w), n)
        assert x["base_score"] == pytest.approx(sum(math.log10((count[y] + 1) / (n + v + 1)) for y in w))
        assert x["held_out"] == (None if x["doc_id"] is None else x["doc_id"] not in learnt)
        assert x["score"] <= 0
    assert sorted(map(repr, got)) == sorted(map(repr, pitman_yor.language_model_scores(frame(spark, rows)).collect()))
    assert pitman_yor.language_model_scores(frame(spark, [])).count() == 0
    assert pitman_yor.language_model_scores(frame(spark, [(None, "a b")])).first()["score"] == 0.0
