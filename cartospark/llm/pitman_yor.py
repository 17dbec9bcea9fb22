"""Language-model scoring: a hierarchical Pitman-Yor bigram model, trained and applied in one dataflow.

Model: each context word has a restaurant whose customers are the words that follow it; every table
of it is a customer of the one parent restaurant of single words, whose own parent is uniform over the
training vocabulary and one unknown word.  Discounts and strengths are parameters.

Seating is sampled by a blocked Gibbs sampler, in which no restaurant is seated in sequence.  Each sweep draws
(1) an auxiliary variable of each context from its number of tables, and given it and the parent's word
probabilities the tables of each of its dishes on their own (see ``seating``); (2) likewise the parent's tables
for the customers these make; (3) the parent's word probabilities from its seating: gamma variates of customers
less discounted tables, and one of the rest, which goes evenly to all words.  After burn-in every sweep is a
sample; the samples' predictive probabilities are averaged.  All random numbers are functions of the seed, the
sweep and the hashes of context and word, and what tasks exchange are integers or element by element, so scores
depend neither on the number of partitions nor on the order of rows.

Dataflow (all packed, one plan):  one pass counts tokens and finds very frequent words.  Map tasks number the
distinct pairs of a batch of whole texts and send them with training counts to the owners of the contexts, and the
texts as streams of word numbers to a home, which owners of contexts do not read.  Owners of contexts and of words
then exchange requests and answers (first counts, then for each sweep tables and probabilities), and owners answer
the homes, which add up each document's score.  A sweep speaks only of words that follow some context of the owner more than once:
the others have one table whatever happens.  A batch sends each pair once, so repeated text costs nothing extra; the pairs of
very frequent contexts are dealt over all owners, and exact totals of their counts and tables are
exchanged in each round.  There is an owner for each OWNER_TOKENS tokens, so the memory of a task does not grow with
the data.  Nothing is broadcast but a list of at most 1 / FREQUENT_SHARE words.  Messages are one for each pair of
owners that share a word, and one with totals for each pair of owners.

Defined cases: null, empty and white-space texts consist of the end token alone.  A document with a null
id is scored, not learnt from, and its held_out is null.  Repeated rows are scored and learnt one by one.
Other columns are ignored.  Empty training data leave the uniform distribution over the unknown word.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from . import seating
from .shared import dropped, partitions, written

#: Tokens that one map task numbers at once, and tokens for each owner of contexts; they bound a task's memory.
FLUSH, OWNER_TOKENS = 2_000_000, 4_000_000
#: Fewer tokens than this are not worth an owner of their own.
LEAST_TOKENS = 250_000
#: Cost of a token in units of 2**-12; the parent's gamma variates are summed in units of 2**-20.
SCORE_UNIT, MASS_UNIT = 4096, 1 << 20
#: Words over twice this share of all words are dealt over all owners as contexts.
FREQUENT_SHARE = 0.00025

_SCHEMA = "part int, kind int, src long, blob binary"
_NAMES = ["part", "kind", "src", "blob"]
_START, _END = K.mix(np.array([0x53544152, 0x454E44], dtype=np.uint64))
_CONTEXT, _DISH, _PARENT, _WORD, _MASS, _REST = range(6)  # streams of random numbers


@dataclass(frozen=True)
class Settings:
    """Discount and strength of the context restaurants (2) and their parent (1); sweeps before and at samples."""

    discount2: float = 0.75
    strength2: float = 1.0
    discount1: float = 0.8
    strength1: float = 1.0
    burn_in: int = 2
    samples: int = 3
    seed: int = 20_240_229


class Chain:
    """The steps of the sampler, element by element over arrays of contexts, pairs and words."""

    def __init__(self, s: Settings) -> None:
        self.s, self.table2, self.table1 = s, seating.stirling(s.discount2), seating.stirling(s.discount1)

    def pairs(self, sweep: int, u, w, count, total, base) -> np.ndarray:
        """Tables of pairs seen so often, with the tables of their contexts and the probabilities of their words."""
        s = self.s
        x = seating.gamma(s.strength2 / s.discount2 + total, seating.key(u, s.seed, sweep, _CONTEXT))
        return seating.seat(count, s.discount2 * x * base, s.discount2, self.table2, seating.key(u + seating.key(w, _WORD), s.seed, sweep, _DISH))

    def words(self, sweep: int, w, customers, vocabulary: int, tables: int) -> np.ndarray:
        """The parent's tables of words with so many customers; vocabulary and tables: totals before this step."""
        s = self.s
        x = seating.gamma(np.array([s.strength1 / s.discount1 + tables]), seating.key(np.zeros(1, K.U), s.seed, sweep, _PARENT))[0]
        return seating.seat(customers, np.full(len(customers), s.discount1 * x / (vocabulary + 1)), s.discount1, self.table1, seating.key(w, s.seed, sweep, _WORD))

    def mass(self, sweep: int, w, customers, tables) -> np.ndarray:
        """The parent's probabilities of words by its seating, up to a common factor."""
        out = np.zeros(len(w))
        some = customers > 0
        out[some] = seating.gamma(customers[some] - self.s.discount1 * tables[some], seating.key(w[some], self.s.seed, sweep, _MASS))
        return out.astype(np.float32)

    def base(self, sweep: int, mass, all_mass: int, vocabulary: int, tables: int) -> np.ndarray:
        """Probabilities of words from their mass, with the rest spread evenly; totals are those of the same step."""
        s = self.s
        rest = seating.gamma(np.array([s.strength1 + s.discount1 * tables]), seating.key(np.zeros(1, K.U), s.seed, sweep, _REST))[0]
        return (mass.astype(np.float64) + rest / (vocabulary + 1)) / (all_mass / MASS_UNIT + rest)

    def parent(self, customers, tables, all_customers: int, all_tables: int, vocabulary: int) -> np.ndarray:
        """Predictive probabilities of words in the parent restaurant."""
        s = self.s
        return (customers - s.discount1 * tables + (s.strength1 + s.discount1 * all_tables) / (vocabulary + 1)) / (s.strength1 + all_customers)

    def predictive(self, count, tables, seen, total, parent) -> np.ndarray:
        """Predictive probabilities of words in contexts with so many customers seen and tables in total."""
        s = self.s
        return (count - s.discount2 * tables + (s.strength2 + s.discount2 * total) * parent) / (s.strength2 + seen)


def _table(rows) -> pa.Table:
    part, kind, src, blob = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(src, pa.int64()), pa.array(blob, pa.binary())], names=_NAMES)


def _read(table: pa.Table, kind: int) -> list:
    """(sender, blob) of one kind of messages, in the order of senders."""
    found = zip(table["kind"], table["src"], table["blob"], strict=True)
    return sorted(((src.as_py(), blob.as_buffer()) for k, src, blob in found if k.as_py() == kind), key=lambda x: x[0])


def _bundle(*arrays: np.ndarray) -> bytes:
    """Columns of different lengths in one."""
    packed = [K.pack(a) for a in arrays]
    return b"".join([len(packed).to_bytes(4, "little"), *(len(x).to_bytes(4, "little") for x in packed), *packed])


def _unbundle(blob) -> list[np.ndarray]:
    blob = memoryview(blob)
    n = int.from_bytes(blob[:4], "little")
    at, out = 4 + 4 * n, []
    for k in range(n):
        size = int.from_bytes(blob[4 + 4 * k : 8 + 4 * k], "little")
        out.append(K.unpack(blob[at : at + size], 1)[0].astype(np.int64))
        at += size
    return out


def _write_pairs(words: np.ndarray, u: np.ndarray, w: np.ndarray, count: np.ndarray) -> bytes:
    """Pairs as indices into sorted word hashes, ordered by u."""
    at = K.runs(u)
    used, index = np.unique(w, return_inverse=True)
    head = [K.pack(words[u[at[:-1]]], np.diff(at), delta=1), K.pack(words[used], delta=1), K.pack(index, count)]
    return b"".join([*(len(h).to_bytes(4, "little") for h in head), *head])


def _read_pairs(blob) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct contexts, their numbers of pairs, and words and counts of the pairs."""
    blob = memoryview(blob)
    size = [int.from_bytes(blob[4 * k : 4 * k + 4], "little") for k in range(3)]
    at = np.cumsum([12, *size])
    u, runs = K.unpack(blob[at[0] : at[1]], 2, delta=1)
    (words,) = K.unpack(blob[at[1] : at[2]], 1, delta=1)
    index, count = K.unpack(blob[at[2] : at[3]], 2)
    return u, runs.astype(np.int64), words[index.astype(np.int64)], count


class _Owned:
    """The distinct pairs that one task owns, over all batches, sorted by context and word."""

    def __init__(self, table: pa.Table, hot: np.ndarray) -> None:
        us, ws, cs, self.chunks = [], [], [], []
        for src, blob in _read(table, 0):
            u, runs, w, c = _read_pairs(blob)
            self.chunks.append((src, len(w), np.cumsum(runs) - runs))
            us.append(np.repeat(u, runs))
            ws.append(w)
            cs.append(c)
        self.empty = not us
        if self.empty:
            return
        u, w, c = np.concatenate(us), np.concatenate(ws), np.concatenate(cs).astype(np.int64)
        order = np.lexsort((w, u))
        at = K.runs(u[order], w[order])
        self.place = np.empty(len(u), dtype=np.int64)
        self.place[order] = np.repeat(np.arange(len(at) - 1), np.diff(at))
        self.count = np.add.reduceat(c[order], at[:-1])
        u, w = u[order][at[:-1]], w[order][at[:-1]]
        self.u_at = K.runs(u)
        self.u = u[self.u_at[:-1]]
        self.u_of = np.repeat(np.arange(len(self.u)), np.diff(self.u_at))
        self.words, self.w_of = np.unique(w, return_inverse=True)
        self.hot = np.flatnonzero(np.isin(self.u, hot))
        # pairs whose tables are drawn, and the words that these are about
        self.drawn = np.flatnonzero(self.count > 1)
        self.asked = np.zeros(len(self.words), dtype=bool)
        self.asked[self.w_of[self.drawn]] = True

    def per_context(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.u_at[:-1])

    def per_word(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.w_of, weights=x, minlength=len(self.words)).astype(np.int64)

    def opened(self, drawn: np.ndarray) -> np.ndarray:
        """Tables of all pairs from those of the drawn ones."""
        tables = np.minimum(self.count, 1)
        tables[self.drawn] = drawn
        return tables

    def over_all(self, mine: np.ndarray, dealt: dict, j: int) -> np.ndarray:
        """Sums by context; for those dealt over all owners the totals, column j of dealt."""
        mine = mine.copy()
        if len(self.hot):
            mine[self.hot] = [dealt[x][j] for x in self.u[self.hot].tolist()]
        return mine


class _Words:
    """The words that one owner of words is asked about: who asks, and customers that never change."""

    def __init__(self, table: pa.Table) -> None:
        got = [(src, K.unpack(blob, 3, delta=1)) for src, blob in _read(table, 1)]
        self.src = [src for src, _ in got]
        self.sizes = [len(x[0]) for _, x in got]
        every = [np.concatenate([x[j] for _, x in got]) if got else np.zeros(0, K.U) for j in range(3)]
        self.words, self.place = np.unique(every[0], return_inverse=True)
        self.pairs, self.asked = every[1].astype(np.int64), every[2] > 0

    def total(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.place, weights=x, minlength=len(self.words)).astype(np.int64)

    def customers(self, told: pa.Table) -> np.ndarray:
        """Tables of all contexts by word, from messages about the words that were asked for."""
        x = self.pairs.copy()
        got = [K.unpack(blob, 1)[0] for _, blob in _read(told, 3)]
        if got:
            x[self.asked] = np.concatenate(got).astype(np.int64)
        return self.total(x)

    def answers(self, part: int, parts: int, head: list[int], columns: list, asked: bool) -> list:
        """To every owner of contexts the totals, and the columns of its words, or of those it asked for."""
        head, at, rows, told = K.pack(*[np.array([h]) for h in head]), 0, [], set()
        head = len(head).to_bytes(4, "little") + head
        for src, n in zip(self.src, self.sizes, strict=True):
            some = self.place[at : at + n]
            some = some[self.asked[at : at + n]] if asked else some
            at += n
            told.add(src)
            rows.append((src, 2, part, head + K.pack(*(c[some] for c in columns))))
        return rows + [(p, 2, part, head) for p in range(parts) if p not in told]


def _heard(table: pa.Table, heads: int, columns: int) -> tuple[list[int], list[np.ndarray]]:
    """Sums of the totals of all owners of words, and the columns in the order of the words."""
    total, got = [0] * heads, []
    for _, blob in _read(table, 2):
        blob = memoryview(blob)
        n = int.from_bytes(blob[:4], "little")
        total = [a + int(x[0]) for a, x in zip(total, K.unpack(blob[4 : 4 + n], heads), strict=True)]
        if len(blob) > 4 + n:
            got.append(K.unpack(blob[4 + n :], columns))
    return total, [np.concatenate([g[j] for g in got]) if got else np.zeros(0, K.U) for j in range(columns)]


def _numbered(counts: np.ndarray, index: np.ndarray, start: int, end: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs u * m + w of texts with an end token each, which pair each token is, and tokens before each text."""
    tokens = counts + 1
    last = np.cumsum(tokens)
    w = np.empty(int(last[-1]), dtype=np.int64)
    is_end = np.zeros(len(w), dtype=bool)
    is_end[last - 1] = True
    w[is_end] = end
    w[~is_end] = index
    u = np.empty_like(w)
    u[1:] = w[:-1]
    u[last - tokens] = start
    pair, place = np.unique(u * m + w, return_inverse=True)
    return pair, place, last - tokens


def _survey(docs: DataFrame, learnt) -> tuple[np.ndarray, int, int]:
    """Contexts to deal over all owners, and numbers of all tokens and of training tokens.

    A task reports its words over the share of its own; those whose reports add up to the share of all words are
    taken, and every word over twice the share is among them.  The choice has no effect on results.
    """

    def scan(batches):
        h, n, size, trained = np.zeros(0, K.U), np.zeros(0), 0, 0
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, buf, offsets in K.text_slices(batch.column(1)):
                word, counts, _, _ = K.words(buf, offsets, lower=True)
                size += len(word) + hi - lo
                trained += int((counts + 1)[learnt(ids.slice(lo, hi - lo))].sum())
                new, count = np.unique(word, return_counts=True)
                h, place = np.unique(np.concatenate((h, new)), return_inverse=True)
                n = np.bincount(place, weights=np.concatenate((n, count)), minlength=len(h))
        often = n > FREQUENT_SHARE * size
        kind = np.r_[np.full(often.sum(), 2), 0, 1]
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(K.signed(np.r_[h[often], np.zeros(2, K.U)])), pa.array(np.r_[n[often], size, trained].astype(np.int64))], names=["kind", "h", "n"])

    found = written(docs.mapInArrow(scan, "kind long, h long, n long").groupBy("kind", "h").agg(F.sum("n").alias("n")), "survey")
    totals = {r["kind"]: r["n"] for r in found.filter("kind < 2").collect()}
    rows = found.filter((F.col("kind") == 2) & (F.col("n") > FREQUENT_SHARE * totals.get(0, 0))).collect()
    dropped(found)
    hot = np.array([r["h"] for r in rows], dtype=np.int64).view(np.uint64)
    return np.unique(np.r_[hot, _START]), totals.get(0, 0), totals.get(1, 0)


def language_model_scores(docs: DataFrame, modulus: int = 7, held: int = 2, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); see the module's text.

    Documents whose crc32 of the id as text is ``held`` modulo ``modulus`` are scored but not learnt from.
    """
    chain = Chain(settings or Settings())
    s = chain.s
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def learnt(ids) -> np.ndarray:
        return np.array([d is not None and zlib.crc32(str(d).encode()) % modulus != held for d in ids.to_pylist()], dtype=bool)

    hot, size, trained = _survey(docs, learnt)
    parts = max(min(partitions(docs.sparkSession), -(-size // LEAST_TOKENS)), -(-size // OWNER_TOKENS), 1)

    def owner_of(h):
        return (K.mix(h ^ K.U(0x1F83D9ABFB41BD6B)) % K.U(parts)).astype(np.int64)

    def home_of(src):
        return -1 - int(K.mix(np.array([src], dtype=np.uint64))[0] % K.U(parts))

    def deal(batches):
        task, serial, held_back, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal serial
            number, known, learn, counts, word = (np.concatenate(x) for x in zip(*held_back, strict=True))
            source = (task << 24) | serial
            serial += 1
            all_words, index = np.unique(np.concatenate((word, [_START, _END])), return_inverse=True)
            m = len(all_words)
            pair, place, _ = _numbered(counts, index[:-2], int(index[-2]), int(index[-1]), m)
            count = np.bincount(place, weights=np.repeat(learn, counts + 1), minlength=len(pair)).astype(np.int64)
            pu, pw = pair // m, pair % m
            owner = (np.searchsorted(K.partition_edges(all_words, parts), np.arange(m), "right") - 1)[pu]
            spread = np.isin(all_words, hot)[pu]
            owner[spread] = owner_of(all_words[pu[spread]] + K.mix(all_words[pw[spread]]))
            order = np.argsort(owner, kind="stable")
            at = K.runs(owner[order])
            rows = []
            for a, b in zip(at[:-1], at[1:], strict=True):
                some = order[a:b]
                rows.append((int(owner[some[0]]), 0, source, _write_pairs(all_words, pu[some], pw[some], count[some])))
            flags = known.astype(np.uint64) | (learn.astype(np.uint64) << K.U(1))
            stream = _bundle(K.zigzag(number), flags, counts, index[:-2], np.array([*index[-2:], m]), owner)
            return _table([*rows, (home_of(source), 9, source, stream)]).to_batches()

        for batch in batches:
            ids = batch.column(0)
            for lo, hi, buf, offsets in K.text_slices(batch.column(1)):
                word, counts, _, _ = K.words(buf, offsets, lower=True)
                mine = ids.slice(lo, hi - lo)
                held_back.append((mine.fill_null(0).to_numpy(zero_copy_only=False), ~np.asarray(mine.is_null()), learnt(mine), counts, word))
                size += len(word) + hi - lo
                if size >= FLUSH:
                    yield from flush()
                    held_back, size = [], 0
        if held_back:
            yield from flush()

    # Owners of contexts ask owners of words, always about the same sorted words.
    def by_word(own, part, kind, *columns):
        edges = K.partition_edges(own.words, parts)
        return [(q, kind, part, K.pack(*(c[a:b] for c in columns), delta=int(kind == 1))) for q, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]

    def ask(key, table):
        part = key[0].as_py()
        own = _Owned(table, hot)
        if own.empty:
            return _table([])
        tables = np.minimum(own.count, 1)
        return _table(by_word(own, part, 1, own.words, own.per_word(tables), own.asked) + seats(own, part, tables))

    def seats(own, part, tables):
        """Customers and tables of the contexts that are dealt over all owners, to whoever adds them up."""
        if not len(own.hot):
            return []
        u, to = own.u[own.hot], owner_of(own.u[own.hot])
        mine = [own.per_context(x)[own.hot] for x in (own.count, tables)]
        return [(int(q), 4, part, K.pack(u[to == q], *(x[to == q] for x in mine))) for q in np.unique(to)]

    def sums_of_seats(table, part):
        got = [(src, K.unpack(blob, 3)) for src, blob in _read(table, 4)]
        if not got:
            return []
        u, place = np.unique(np.concatenate([x[0] for _, x in got]), return_inverse=True)
        sums = [np.bincount(place, weights=np.concatenate([x[j] for _, x in got])).astype(np.int64) for j in (1, 2)]
        return [(src, 6, part, K.pack(x[0], *(y[np.searchsorted(u, x[0])] for y in sums))) for src, x in got]

    def told_seats(table) -> dict:
        """(customers, tables) over all owners of each context that is dealt over them."""
        found = {}
        for _, blob in _read(table, 6):
            u, n, t = K.unpack(blob, 3)
            found |= dict(zip(u.tolist(), zip(n.tolist(), t.tolist(), strict=True), strict=True))
        return found

    # What an owner of words tells after each sweep: masses of the words asked for; at last, customers and tables of all
    # words in each sample.  Rows of kind 11 are the samples so far, which come back to it.
    def seated(sweep, part, words, customers, vocabulary, tables, past):
        t = chain.words(sweep, words.words, customers, vocabulary, tables) if sweep else np.minimum(customers, 1)
        past = [*past, customers, t] if sweep > s.burn_in else past
        if sweep == s.burn_in + s.samples:
            head = [int((words.total(words.pairs) > 0).sum()), *(int(x.sum()) for x in past)]
            return words.answers(part, parts, head, past, False)
        mass = chain.mass(sweep, words.words, customers, t)
        head = [int((customers > 0).sum()), int(t.sum()), int(np.rint(mass.astype(np.float64) * MASS_UNIT).sum())]
        rows = words.answers(part, parts, head, [mass.view(np.uint32)], True)
        return [*rows, (part, 11, part, _bundle(*past))] if past else rows

    def count(key, table):
        part = key[0].as_py()
        words = _Words(table)
        return _table(seated(0, part, words, words.total(words.pairs), 0, 0, []) + sums_of_seats(table, part))

    # Rows of kind 10 are the seatings of an owner of contexts, which come back to it: tables of the drawn pairs in the
    # present sweep; and of each sample before, those and the tables of contexts dealt over all owners.
    def state(own, answers):
        kept = [_unbundle(blob) for _, blob in _read(answers, 10)]
        return kept[0] if kept else [np.ones(len(own.drawn), np.int64)]

    def sampler(sweep):
        def sample(key, table, answers):
            part = key[0].as_py()
            if part < 0:
                return _table([])
            own = _Owned(table, hot)
            (v, all_t, all_mass), (mass,) = _heard(answers, 3, 1)
            rows = [(part, 12, part, K.pack(np.array([v]), np.array([all_t])))] + [(part, 11, part, bytes(b)) for _, b in _read(answers, 11)]
            if own.empty:
                return _table(rows)
            now, *past = state(own, answers)
            before = own.opened(now)
            total = own.over_all(own.per_context(before), told_seats(answers), 1)
            if sweep - 1 > s.burn_in:
                past += [now, total[own.hot]]
            base = np.zeros(len(own.words))
            base[own.asked] = chain.base(sweep - 1, mass.astype(np.uint32).view(np.float32), all_mass, v, all_t)
            u, w, some = own.u_of[own.drawn], own.w_of[own.drawn], own.drawn
            drawn = chain.pairs(sweep, own.u[u], own.words[w], own.count[some], total[u], base[w])
            tables = own.opened(drawn)
            edges = K.partition_edges(own.words[own.asked], parts)
            x = own.per_word(tables)[own.asked]
            rows += [(q, 3, part, K.pack(x[a:b])) for q, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
            return _table(rows + seats(own, part, tables) + [(part, 10, part, _bundle(drawn, *past))])

        return sample

    def seater(sweep):
        def parents(key, asked, told):
            part = key[0].as_py()
            words = _Words(asked)
            v, all_t = (int(x[0]) for x in K.unpack(_read(told, 12)[0][1], 2))
            past = [x for _, blob in _read(told, 11) for x in _unbundle(blob)]
            rows = seated(sweep, part, words, words.customers(told), v, all_t, past)
            rows += [(part, 10, part, bytes(b)) for _, b in _read(told, 10)]
            return _table(rows + sums_of_seats(told, part))

        return parents

    def score(key, table, answers):
        part = key[0].as_py()
        own = None if part < 0 else _Owned(table, hot)
        if own is None or own.empty:
            return _table([])
        (v, *totals), columns = _heard(answers, 1 + 2 * s.samples, 2 * s.samples)
        told = told_seats(answers)
        now, *past = state(own, answers)
        past += [now, own.over_all(own.per_context(own.opened(now)), told, 1)[own.hot]]
        seen = own.over_all(own.per_context(own.count), told, 0)
        p = np.zeros(len(own.count))
        for j in range(0, 2 * s.samples, 2):
            tables = own.opened(past[j])
            total = own.per_context(tables)
            total[own.hot] = past[j + 1]
            parent = chain.parent(columns[j].astype(np.int64), columns[j + 1].astype(np.int64), *totals[j : j + 2], v)
            p += chain.predictive(own.count, tables, seen[own.u_of], total[own.u_of], parent[own.w_of])
        cost = np.rint(-np.log10(np.minimum(p / s.samples, 1)) * SCORE_UNIT).astype(np.int64)
        rows, at = [], 0
        for src, size, starts in own.chunks:
            some = own.place[at : at + size]
            at += size
            rows.append((home_of(src), 7, src, _bundle(np.array([part, v]), cost[some], seen[own.u_of[some[starts]]])))
        return _table(rows)

    out_names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    out_schema = pa.schema(list(zip(out_names, [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()], strict=True)))

    def home(key, streams, answers):
        by_source: dict[int, list] = {}
        for src, blob in _read(answers, 7):
            by_source.setdefault(src, []).append(_unbundle(blob))
        tables = []
        for src, blob in _read(streams, 9):
            number, flags, counts, index, (start, end, m), owner = _unbundle(blob)
            pair, place, first = _numbered(counts, index, int(start), int(end), int(m))
            order = np.argsort(owner, kind="stable")
            cost, seen = np.empty(len(pair), np.int64), np.zeros(m, np.int64)
            answer = sorted(by_source.pop(src), key=lambda x: int(x[0][0]))
            cost[order] = np.concatenate([x[1] for x in answer])
            context = (pair // m)[order]
            seen[context[K.runs(owner[order], context)[:-1]]] = np.concatenate([x[2] for x in answer])
            # a word is seen as often as its context is, the end as often as the start
            seen[end] = seen[start]
            seen, v = seen[(pair % m)[place]], int(answer[0][0][1])
            tokens, unknown = counts + 1, (flags & 1) == 0
            tables.append(
                pa.table(
                    [
                        pa.array(K.unzigzag(number), mask=unknown),
                        pa.array((flags & 2) == 0, mask=unknown),
                        pa.array(tokens),
                        pa.array(np.add.reduceat((seen > 0).astype(np.int64), first)),
                        pa.array(np.full(len(tokens), trained)),
                        pa.array(np.add.reduceat(np.log10(seen + 1.0), first) - tokens * np.log10(trained + v + 1.0)),
                        pa.array(np.add.reduceat(cost[place], first) / -float(SCORE_UNIT)),
                    ],
                    schema=out_schema,
                )
            )
        return pa.concat_tables(tables) if tables else out_schema.empty_table()

    by = lambda df: df.groupBy("part")
    # what is observed stays below the filters: one shuffle, of which each step reads its rows
    dealt = docs.mapInArrow(deal, _SCHEMA).repartition("part").observe("dealt", F.count(F.lit(1)).alias("rows"))
    pairs, streams = dealt.filter("part >= 0"), dealt.filter("part < 0")
    asked = by(pairs).applyInArrow(ask, _SCHEMA)
    told = by(asked).applyInArrow(count, _SCHEMA)
    for sweep in range(1, s.burn_in + s.samples + 1):
        drawn = by(pairs).cogroup(by(told)).applyInArrow(sampler(sweep), _SCHEMA)
        told = by(asked).cogroup(by(drawn)).applyInArrow(seater(sweep), _SCHEMA)
    scored = by(pairs).cogroup(by(told)).applyInArrow(score, _SCHEMA)
    return by(streams).cogroup(by(scored)).applyInArrow(home, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
