"""Benchmark decontamination: windows of documents that resemble a benchmark item.

Method: every window as long as an item (in words) has a 64-bit SimHash over its word shingles.  A
multi-index over four 16-bit blocks of the items' fingerprints retrieves all items within the Hamming
radius: if two fingerprints differ in at most r bits, one of the four blocks differs in at most r // 4.
Each retrieved (window, item) is verified by the exact weighted Jaccard similarity of the two bags of
shingles, weight being how often a shingle occurs.

Windows are not fingerprinted one by one over the whole corpus: a similarity of t needs
``t / (1 + t)`` of both bags together in common, so a window with fewer positions that carry a shingle of
any item of its length cannot qualify, and running counts of such positions leave that out without loss.
A repeated shingle can move a fingerprint beyond the radius, so a window with one, and an item with one, are verified without
the index if they share a shingle.

The items are a query set: they are read to the driver and processed in blocks of bounded size against
all rows; a larger benchmark means more blocks, never a larger broadcast.

Defined cases: empty and null texts match nothing; items without words match nothing; an item with fewer
words than a shingle is one shingle of all its words; a document shorter than an item is one window; of
several windows that match an item the most similar, then first, is reported.  Rows with a null id are
reported with a null id; repeated rows are each reported; repeated items each match.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K

#: Items and words of items in one block of the query set: what a task holds.
BLOCK_ITEMS, BLOCK_WORDS = 20_000, 2_000_000
#: At similarity 0.75 two fingerprints are 11 bits apart, with a standard deviation of 3.
RADIUS = 23
#: Blocks of windows whose neighbours are kept in memory, for each of the four.
MOST_CLOSE = 512
_FILTER_BITS = 20


def _fingerprints(hashed: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """SimHash of hashed[begin:end] for each pair, each occurrence counting once."""
    bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1
    total = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)))
    return np.packbits(total[end] - total[begin] > 0, axis=1, bitorder="little").view(np.uint64).reshape(-1)


class Items:
    """One block of benchmark items, their shingles and the multi-index over their fingerprints."""

    def __init__(self, ids: list, texts: list, size: int, threshold: Fraction, radius: int) -> None:
        self.size, self.threshold, self.radius = size, threshold, radius
        bags, lengths, kept = [], [], []
        for item, text in zip(ids, texts, strict=True):
            raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
            word, counts, _, _ = K.words(raw, np.array([0, len(raw)]), lower=True)
            if counts[0]:
                bags.append(K.window_hashes(word, min(size, int(counts[0]))))
                lengths.append(int(counts[0]))
                kept.append(item)
        self.ids, self.lengths = kept, np.array(lengths, dtype=np.int64)
        self.bags = [np.unique(b, return_counts=True) for b in bags]
        if not kept:
            return
        end = np.cumsum([len(b) for b in bags])
        self.prints = _fingerprints(np.concatenate(bags), np.concatenate(([0], end[:-1])), end)
        self.blocks = []
        for k in range(4):
            value = (self.prints >> K.U(16 * k)) & K.U(0xFFFF)
            keys, where = np.unique(value, return_inverse=True)
            order = np.argsort(where, kind="stable")
            self.blocks.append((keys, order, np.searchsorted(where[order], np.arange(len(keys) + 1))))
        # shingles of the items of each length, and which items have them
        self.classes, self.having = {}, {}
        for n in np.unique(self.lengths):
            same = np.flatnonzero(self.lengths == n)
            pairs = np.concatenate([self.bags[i][0] for i in same]), np.repeat(same, [len(self.bags[i][0]) for i in same])
            order = np.argsort(pairs[0], kind="stable")
            self.having[int(n)] = (pairs[0][order], pairs[1][order])
            self.classes[int(n)] = np.unique(pairs[0])
        # a repeated shingle weighs so much in a fingerprint that the radius promises nothing
        self.repeats = np.array([c.max() > 1 for _, c in self.bags])
        self.repeating = set(self.lengths[self.repeats].tolist())
        self.close: list[dict[int, np.ndarray]] = [{} for _ in range(4)]
        every = np.unique(np.concatenate(list(self.classes.values())))
        self.maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.maybe[(every >> K.U(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.every = every

    def near(self, fingerprint: np.uint64) -> np.ndarray:
        """Items whose fingerprint is within the radius, through the multi-index; a block's neighbours are looked for once."""
        found = []
        for k, (keys, order, at) in enumerate(self.blocks):
            own = int(fingerprint >> K.U(16 * k)) & 0xFFFF
            if own not in self.close[k]:
                close = np.flatnonzero(np.bitwise_count(keys ^ K.U(own)) <= self.radius // 4)
                self.close[k][own] = np.concatenate([order[at[c] : at[c + 1]] for c in close]) if len(close) else np.zeros(0, np.int64)
            found.append(self.close[k][own])
            if len(self.close[k]) > MOST_CLOSE:
                self.close[k].clear()
        some = np.unique(np.concatenate(found))
        return some[np.bitwise_count(self.prints[some] ^ fingerprint) <= self.radius]

    def sharing(self, have: np.ndarray, n: int) -> np.ndarray:
        """Items of n words that share a shingle with these."""
        shingles, items = self.having[n]
        lo, hi = np.searchsorted(shingles, have), np.searchsorted(shingles, have, "right")
        return np.unique(np.concatenate([items[a:b] for a, b in zip(lo, hi, strict=True)]))

    def matches(self, buf: np.ndarray, offsets: np.ndarray) -> list[tuple[int, object, int, float]]:
        """(text, item, first word, similarity) for one slice of texts."""
        if not self.ids:
            return []
        word, counts, _, _ = K.words(buf, offsets, lower=True)
        base = np.concatenate(([0], np.cumsum(counts)))
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for size in sorted({min(self.size, n) for n in self.classes}):
            hashed = K.window_hashes(word, size)
            hit = np.flatnonzero(self.maybe[(hashed >> K.U(64 - _FILTER_BITS)).astype(np.int64)])
            hit = hit[np.isin(hashed[hit], self.every)]
            owner = np.searchsorted(base, hit, "right") - 1
            hit, owner = hit[hit + size <= base[owner + 1]], owner[hit + size <= base[owner + 1]]
            at = K.runs(owner)
            for a, b in zip(at[:-1], at[1:], strict=True) if len(owner) else ():
                text = int(owner[a])
                own = hashed[base[text] : base[text + 1] - size + 1]
                places = hit[a:b] - base[text]
                for n, shingles in self.classes.items():
                    if min(self.size, n) == size:
                        self._text(text, own, places[np.isin(own[places], shingles)], n, size, best)
        return [(text, self.ids[i], start, similarity) for (text, i), (similarity, start) in sorted(best.items())]

    def _text(self, text: int, own: np.ndarray, places: np.ndarray, n: int, size: int, best: dict) -> None:
        """Windows of n words of one text, given the places of shingles that items of n words have."""
        item_bag = n - size + 1
        bag = min(len(own), item_bag)
        num, den = self.threshold.numerator, self.threshold.denominator
        need = -(-num * (bag + item_bag) // (num + den))
        if len(places) < need:
            return
        step = np.zeros(len(own) + 1, dtype=np.int64)
        step[places + 1] = 1
        total = np.cumsum(step)
        starts = np.flatnonzero(total[bag:] - total[: len(total) - bag] >= need)
        if not len(starts):
            return
        lo, hi = int(starts[0]), int(starts[-1]) + bag
        prints = _fingerprints(own[lo:hi], starts - lo, starts - lo + bag)
        for start, fingerprint in zip(starts.tolist(), prints, strict=True):
            have, often = np.unique(own[start : start + bag], return_counts=True)
            # without the index only where shingles repeat, in the window or in an item that shares one
            if often.max() > 1:
                some = self.sharing(have, n)
            else:
                some = self.near(fingerprint)
                some = some[self.lengths[some] == n]
                if n in self.repeating:
                    other = self.sharing(have, n)
                    some = np.union1d(some, other[self.repeats[other]])
            for i in some.tolist():
                theirs, their_often = self.bags[i]
                _, x, y = np.intersect1d(have, theirs, assume_unique=True, return_indices=True)
                common = int(np.minimum(often[x], their_often[y]).sum())
                union = bag + item_bag - common
                if den * common >= num * union:
                    similarity = common / union
                    if (text, i) not in best or similarity > best[text, i][0]:
                        best[text, i] = similarity, start


def _blocks(benchmark: DataFrame, size: int, threshold: Fraction, radius: int):
    ids, texts, words = [], [], 0
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        words += len((row[1] or "").split())
        if len(ids) >= BLOCK_ITEMS or words >= BLOCK_WORDS:
            yield Items(ids, texts, size, threshold, radius)
            ids, texts, words = [], [], 0
    if ids:
        yield Items(ids, texts, size, threshold, radius)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, threshold: Fraction = Fraction(3, 4), size: int = 5, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, start_word, similarity) of every match; see the module's text for the cases."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id", "item_id", "start_word", "similarity"]

    def against(items: Items) -> DataFrame:
        def find(batches):
            for batch in batches:
                rows = []
                for lo, _, buf, offsets in K.text_slices(batch.column(1)):
                    rows += [(batch.column(0)[lo + text].as_py(), item, start, similarity) for text, item, start, similarity in items.matches(buf, offsets)]
                if rows:
                    d, i, s, x = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.int64()), pa.array(x, pa.float64())], names=names)

        return docs.mapInArrow(find, "doc_id long, item_id long, start_word long, similarity double")

    found = None
    for items in _blocks(benchmark, size, threshold, radius):
        found = against(items) if found is None else found.union(against(items))
    return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, start_word long, similarity double") if found is None else found


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: Fraction = Fraction(3, 4), size: int = 5, radius: int = RADIUS, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text matches no item; no shuffle."""
    for items in _blocks(benchmark, size, threshold, radius):

        def clean(batches, items=items):
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for lo, _, buf, offsets in K.text_slices(batch.column(batch.schema.get_field_index(text_col))):
                    for text, *_ in items.matches(buf, offsets):
                        keep[lo + text] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
