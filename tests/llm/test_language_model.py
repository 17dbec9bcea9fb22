"""The Pitman-Yor model against a plain sampler, the sampler against all seatings, and its independence of tasks."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest

from cartospark.llm import kernels, pitman_yor, seating
from tests.llm.test_operators import frame, lower

START, END = (int(x) for x in (pitman_yor._START, pitman_yor._END))


def coded(text):
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return [*kernels.words(raw, np.array([0, len(raw)]), lower=True)[0].tolist(), END]


class Plain:
    """The chain over dictionaries, in one process; probability(u, w) averages over the samples."""

    def __init__(self, texts, settings):
        s, chain = settings, pitman_yor.Chain(settings)
        count = collections.Counter(p for t in texts for p in itertools.pairwise([START, *coded(t)]))
        self.count, self.seen = count, collections.Counter()
        for (u, _), c in count.items():
            self.seen[u] += c
        tables = {p: 1 for p in count}
        words = sorted({w for _, w in count})
        vocabulary, self.samples = len(words), []
        hashes = np.array(words, dtype=np.uint64)

        def by(k):
            total = collections.Counter()
            for p, t in tables.items():
                total[p[k]] += t
            return total

        customers = np.array([by(1)[w] for w in words])
        theirs = np.ones_like(customers)
        for sweep in range(s.burn_in + s.samples + 1):
            if sweep:
                mass = chain.mass(sweep - 1, hashes, customers, theirs)
                whole = int(np.rint(mass.astype(float) * pitman_yor.MASS_UNIT).sum())
                base = dict(zip(words, chain.base(sweep - 1, mass, whole, vocabulary, int(theirs.sum())), strict=True))
                total = by(0)
                drawn = [p for p, c in count.items() if c > 1]
                u, w = (np.array([p[k] for p in drawn], dtype=np.uint64) for k in (0, 1))
                new = chain.pairs(sweep, u, w, np.array([count[p] for p in drawn]), np.array([total[p[0]] for p in drawn]), np.array([base[p[1]] for p in drawn]))
                tables |= dict(zip(drawn, new.tolist(), strict=True))
                customers = np.array([by(1)[w] for w in words])
                theirs = chain.words(sweep, hashes, customers, vocabulary, int(theirs.sum()))
            if sweep > s.burn_in:
                parent = dict(zip(words, chain.parent(customers, theirs, int(customers.sum()), int(theirs.sum()), vocabulary).tolist(), strict=True))
                rest = float(chain.parent(0, 0, int(customers.sum()), int(theirs.sum()), vocabulary))
                self.samples.append((dict(tables), by(0), parent, rest))
        self.chain, self.words = chain, words

    def probability(self, u, w):
        each = [self.chain.predictive(self.count[u, w], t.get((u, w), 0), self.seen[u], total[u], parent.get(w, rest)) for t, total, parent, rest in self.samples]
        return sum(each) / len(each)

    def score(self, text):
        return sum(math.log10(self.probability(u, w)) for u, w in itertools.pairwise([START, *coded(text)]))


def trained(rows):
    return [t for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 7 != 2]


def phrases(n=240):
    """A third of all rows are copies of one phrase, whose words also occur in random order."""
    r = random.Random(11)
    phrase = " ".join(f"p{k}" for k in range(30))
    rows = [(k, phrase if k % 3 == 0 else " ".join(f"v{min(r.randrange(90), r.randrange(90))}" for _ in range(r.randrange(40)))) for k in range(n)]
    return rows + [(1000 + k, " ".join(f"P{r.randrange(30)}" for _ in range(20))) for k in range(40)] + [(None, "v1 v2"), (7, None), (8, "new words")]


def test_scores_are_those_of_a_plain_sampler(spark):
    rows = phrases()
    plain = Plain(trained(rows), pitman_yor.Settings())
    got = pitman_yor.language_model_scores(frame(spark, rows)).select("doc_id", "n_tokens", "score").collect()
    expect = sorted((repr(d), len(lower(t)) + 1, plain.score(t)) for d, t in rows)
    for (d, n, s), x in zip(expect, sorted((repr(x[0]), x[1], x[2]) for x in got), strict=True):
        assert x[:2] == (d, n) and x[2] == pytest.approx(s, abs=n / pitman_yor.SCORE_UNIT)


def test_scores_do_not_depend_on_tasks_batches_or_order(spark, monkeypatch):
    rows = phrases()
    found = []
    for parts, flush, order in (("1", 2_000_000, 1), ("7", 900, -1), ("41", 200, 1)):
        monkeypatch.setattr(pitman_yor, "FLUSH", flush)
        monkeypatch.setattr(pitman_yor, "LEAST_TOKENS", 300)
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            found.append(sorted(map(repr, pitman_yor.language_model_scores(frame(spark, rows[::order])).collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]


def test_every_frequent_word_is_found(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "FREQUENT_SHARE", 0.01)
    rows = [(k, "aa " * 20 + " ".join(f"x{k}y{j}" for j in range(60))) for k in range(50)]
    hot, size, known = pitman_yor._survey(frame(spark, rows), lambda ids: np.ones(len(ids), bool))
    assert size == known == 50 * 81 and coded("aa")[0] in hot.tolist() and len(hot) == 2


def test_probabilities_add_up_to_one():
    plain = Plain(trained(phrases()), pitman_yor.Settings(samples=2))
    for u in [START, *plain.words[:20], 12345]:
        assert sum(plain.probability(u, w) for w in [*plain.words, 99]) == pytest.approx(1, abs=1e-9)


def test_the_chain_has_the_law_of_all_seatings():
    """Mean predictive probabilities of a tiny text under its exact posterior, by enumeration of table numbers."""
    s = pitman_yor.Settings(0.6, 0.7, 0.5, 1.3, burn_in=20, samples=4000)
    texts = ["a a b a b", "b a"]
    plain = Plain(texts, s)
    pairs, words = list(plain.count), plain.words
    v = len(words)
    table2, table1 = seating.stirling(s.discount2), seating.stirling(s.discount1)
    rising = lambda strength, discount, n: sum(math.log(strength + discount * k) for k in range(1, n))
    weight = collections.Counter()
    for t in itertools.product(*(range(1, plain.count[p] + 1) for p in pairs)):
        tables = dict(zip(pairs, t, strict=True))
        customers = [sum(n for p, n in tables.items() if p[1] == w) for w in words]
        log2 = sum(table2[plain.count[p], n] for p, n in tables.items())
        log2 += sum(rising(s.strength2, s.discount2, sum(n for p, n in tables.items() if p[0] == u)) for u in plain.seen)
        for t1 in itertools.product(*(range(1, n + 1) for n in customers)):
            log1 = sum(table1[n, m] - m * math.log(v + 1) for n, m in zip(customers, t1, strict=True)) + rising(s.strength1, s.discount1, sum(t1))
            log1 -= sum(math.log(s.strength1 + k) for k in range(1, sum(customers)))
            weight[t, tuple(customers), t1] = math.exp(log1 + log2)
    total = sum(weight.values())
    for p in [*pairs, (words[0], 99), (START, words[0])]:
        mean = 0.0
        for (t, customers, t1), x in weight.items():
            tables = dict(zip(pairs, t, strict=True))
            parent = dict(zip(words, plain.chain.parent(np.array(customers), np.array(t1), sum(customers), sum(t1), v), strict=True))
            rest = plain.chain.parent(0, 0, sum(customers), sum(t1), v)
            opened = sum(n for q, n in tables.items() if q[0] == p[0])
            mean += x / total * plain.chain.predictive(plain.count[p], tables.get(p, 0), plain.seen[p[0]], opened, parent.get(p[1], rest))
        assert plain.probability(*p) == pytest.approx(mean, rel=0.03)


@pytest.mark.parametrize("customers", [2, 40, 64, 65, 300])
@pytest.mark.parametrize("y", [0.05, 1.0, 20.0, 400.0])
def test_tables_have_the_law_of_their_weights(customers, y):
    d, row = 0.7, np.array([-np.inf, 0.0])
    for c in range(1, customers):
        old, t = np.append(row, -np.inf), np.arange(1, c + 2)
        with np.errstate(divide="ignore"):
            row = np.concatenate(([-np.inf], np.logaddexp(old[t - 1], np.log(np.maximum(c - d * t, 0)) + old[t])))
    t = np.arange(1, customers + 1)
    weight = np.exp(t * np.log(y) + row[1:] - (t * np.log(y) + row[1:]).max())
    mean = (weight * t).sum() / weight.sum()
    spread = math.sqrt((weight * t * t).sum() / weight.sum() - mean**2)
    drawn = seating.seat(np.full(5000, customers), np.full(5000, y), d, seating.stirling(d), seating.key(np.arange(5000), customers))
    assert drawn.min() >= 1 and drawn.max() <= customers
    assert drawn.mean() == pytest.approx(mean, abs=0.08 * spread + 0.04 * mean) and drawn.std() == pytest.approx(spread, rel=0.1, abs=0.05)


@pytest.mark.parametrize("shape", [0.2, 1.0, 7.5, 4000.0])
def test_gamma_variates(shape):
    x = seating.gamma(np.full(50_000, shape), seating.key(np.arange(50_000), 5))
    assert x.mean() == pytest.approx(shape, rel=0.03) and x.var() == pytest.approx(shape, rel=0.06)
