"""Substring deduplication: words covered by a long passage that a document with a smaller id also has.

Method: difference-cover anchors.  A difference cover D of period v has, for every two positions i and
j, a shift below v that takes both into D modulo v.  So any match of ``min_words`` words holds an aligned
pair of anchors: windows of ``min_words - v + 1`` words that start at cover positions.

1. Only windows at cover positions are hashed and shuffled; those found in two documents are anchors.
2. Anchors are extended: every run of ``min_words`` words that contains one is hashed (96 bits) and the
   smallest document of each run decides; runs are the only windows that can repeat.
3. Words covered by a run whose smallest document is another, smaller one are removed.

Both shuffles combine on the map side: within a batch, repeated windows are answered at once and one
document stands for all of them, so a passage that a third of all documents share costs one row per
batch.  The texts are shuffled once and that exchange is used twice.

Defined cases: null, empty and white-space texts have no words; repeats within one document do not count;
rows that share an id are one document (see ``one_row_per_id``); a document with a null id is not
compared and keeps all words.  Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import dealt, one_row_per_id, partitions

#: A perfect difference set, every residue modulo 31 is a difference of two of them.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)

#: Entries that one map task packs at once; bounds its memory.
FLUSH = 2_000_000
#: Bytes of all texts for each task that unpacks windows; bounds its memory at any size of the input.
TASK_BYTES = 32 << 20
_SCHEMA = "part int, kind int, blob binary"
_NAMES = ["part", "kind", "blob"]


def _rows(found):
    part, kind, blob = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())], names=_NAMES)


def _to_owner(doc: np.ndarray, pos: np.ndarray, parts: int):
    """Rows (kind 1) for the tasks that gather documents."""
    to = (K.mix(doc) % K.U(parts)).astype(np.int64)
    order = np.lexsort((pos, doc, to))
    to, doc, pos = to[order], doc[order], pos[order]
    at = K.runs(to)
    return [(int(to[a]), 1, K.pack(doc[a:b], pos[a:b], delta=1)) for a, b in zip(at[:-1], at[1:], strict=True)]


def _to_hash(hashed, *columns, parts):
    """Rows (kind 0) for the tasks that compare windows; hashed is sorted."""
    edges = K.partition_edges(hashed, parts)
    return [(p, 0, K.pack(hashed[a:b], *(c[a:b] for c in columns), delta=1)) for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]


def _several(at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each run: does it hold two documents?"""
    return np.maximum.reduceat(doc, at[:-1]) != np.minimum.reduceat(doc, at[:-1])


def _flushed(entries, answer):
    """Collect entries of arrays up to FLUSH, then answer them together."""
    held, pending = 0, []
    for entry in entries:
        pending.append(entry)
        held += len(entry[0])
        if held >= FLUSH:
            if out := answer(*(np.concatenate(x) for x in zip(*pending, strict=True))):
                yield _rows(out)
            held, pending = 0, []
    if pending and (out := answer(*(np.concatenate(x) for x in zip(*pending, strict=True)))):
        yield _rows(out)


def _reduced(batches, columns, answer):
    """Pass on rows of kind 1; answer all rows of kind 0 of this task together."""
    got = []
    for batch in batches:
        for part, kind, blob in zip(*(batch.column(k) for k in range(3)), strict=True):
            if kind.as_py():
                yield _rows([(part.as_py(), 1, blob.as_py())])
            else:
                got.append(K.unpack(blob.as_buffer(), columns, delta=1))
    if got and (out := answer(*(np.concatenate(x) for x in zip(*got, strict=True)))):
        yield _rows(out)


def _by_document(df: DataFrame, parts: int, make, schema: str, names: list[str]) -> DataFrame:
    """Gather packed (document, position) by document and make rows of them."""

    def gather(batches):
        got = [K.unpack(blob.as_buffer(), 2, delta=1) for batch in batches for blob in batch.column(2)]
        if not got:
            return
        doc, pos = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.lexsort((pos, doc))
        doc, pos = doc[order], pos[order].astype(np.int64)
        keep = np.zeros(len(doc), dtype=bool)
        keep[K.runs(doc, pos)[:-1]] = True
        doc, pos = doc[keep], pos[keep]
        begin, end = make(doc, pos)
        doc = doc[begin[0]]
        begin, end = begin[1], end[1]
        at = K.runs(doc)
        for lo in range(0, len(at) - 1, 5000):
            some = at[lo : lo + 5001]
            a, b = some[0], some[-1]
            offsets = (some - a).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(K.unzigzag(doc[some[:-1]])), pa.ListArray.from_arrays(offsets, pa.array(begin[a:b].astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(end[a:b].astype(np.int32)))],
                names=names,
            )

    return dealt(df, "part", parts).mapInArrow(gather, schema)


def _merged(length: int, back: int):
    """make() for intervals: positions p stand for [p - back, p + length); overlapping ones are joined."""

    def make(doc, pos):
        low, high = np.maximum(pos - back, 0), pos + length
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (low[1:] > high[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(doc)])) - 1
        return (first, low[first]), (first, high[last])

    return make


def removed_runs(docs: DataFrame, texts: DataFrame, min_words: int, period: int, cover: tuple[int, ...], parts: int) -> DataFrame:
    """(d, begins, ends): document ids and the word ranges to remove, for documents that have any."""
    length = min_words - period + 1
    at_cover = np.zeros(period, dtype=bool)
    at_cover[list(cover)] = True

    def numbers(ids):
        return K.zigzag(ids.fill_null(0).to_numpy(zero_copy_only=False)), ~np.asarray(ids.is_null())

    def anchors(batches):
        def entries():
            for batch in batches:
                number, known = numbers(batch.column(0))
                for lo, _, buf, offsets in K.text_slices(batch.column(1)):
                    word, counts, _, _ = K.words(buf, offsets)
                    # a text too short for a whole match has no use for anchors
                    owner, start, hashed = K.windows(word, counts, length)
                    use = at_cover[start % period] & (counts[owner] >= min_words) & known[lo + owner]
                    yield hashed[use], number[lo + owner[use]], start[use].astype(K.U)

        def answer(hashed, doc, pos):
            order = np.lexsort((doc, hashed))
            hashed, doc, pos = hashed[order], doc[order], pos[order]
            if not len(hashed):
                return []
            at = K.runs(hashed)
            twice = _several(at, doc)
            told = np.repeat(twice, np.diff(at))
            found = _to_owner(doc[told], pos[told], parts) if told.any() else []
            send = ~told
            send[at[:-1][twice]] = True
            return found + _to_hash(hashed[send], doc[send], (pos[send] << K.U(1)) | told[send].astype(K.U), parts=parts)

        yield from _flushed(entries(), answer)

    def compare(batches):
        def answer(hashed, doc, flagged):
            order = np.argsort(hashed, kind="stable")
            hashed, doc, flagged = hashed[order], doc[order], flagged[order]
            at = K.runs(hashed)
            twice = _several(at, doc) | (np.maximum.reduceat(flagged & K.U(1), at[:-1]) == 1)
            tell = np.repeat(twice, np.diff(at)) & ((flagged & K.U(1)) == 0)
            return _to_owner(doc[tell], flagged[tell] >> K.U(1), parts) if tell.any() else []

        yield from _reduced(batches, 3, answer)

    def extend(batches):
        def entries():
            for batch in batches:
                number, known = numbers(batch.column(0))
                begins, ends = batch.column(2), batch.column(3)
                for lo, hi, buf, offsets in K.text_slices(batch.column(1)):
                    word, counts, _, _ = K.words(buf, offsets)
                    base = np.concatenate(([0], np.cumsum(counts)))
                    step = np.zeros(len(word) + 1, dtype=np.int64)
                    for k in range(lo, hi):
                        own = base[k - lo]
                        last = counts[k - lo] - min_words + 1
                        b, e = (np.minimum(x.values.to_numpy(zero_copy_only=False), max(last, 0)) for x in (begins[k], ends[k]))
                        np.add.at(step, own + b, 1)
                        np.add.at(step, own + e, -1)
                    start = np.flatnonzero(np.cumsum(step[:-1]) > 0)
                    if not len(start):
                        continue
                    owner = np.searchsorted(base, start, "right") - 1
                    one = K.window_hashes(word, min_words)[start]
                    two = K.window_hashes(K.mix(word ^ K.U(0x6A09E667F3BCC909)), min_words)[start] >> K.U(32)
                    yield one, two, number[lo + owner], (start - base[owner]).astype(K.U)

        def answer(one, two, doc, pos):
            signed = K.unzigzag(doc)
            order = np.lexsort((signed, two, one))
            one, two, doc, pos, signed = one[order], two[order], doc[order], pos[order], signed[order]
            at = K.runs(one, two)
            first = np.repeat(signed[at[:-1]], np.diff(at))
            gone = signed != first
            found = _to_owner(doc[gone], pos[gone], parts) if gone.any() else []
            return found + _to_hash(one[~gone], two[~gone], doc[~gone], pos[~gone], parts=parts)

        yield from _flushed(entries(), answer)

    def smallest(batches):
        def answer(one, two, doc, pos):
            signed = K.unzigzag(doc)
            order = np.lexsort((signed, two, one))
            one, two, doc, pos, signed = one[order], two[order], doc[order], pos[order], signed[order]
            at = K.runs(one, two)
            gone = signed != np.repeat(signed[at[:-1]], np.diff(at))
            return _to_owner(doc[gone], pos[gone], parts) if gone.any() else []

        yield from _reduced(batches, 4, answer)

    # starts of whole runs that contain an anchor at p: p - (min_words - length) to p
    suspects = dealt(docs.mapInArrow(anchors, _SCHEMA), "part", parts).mapInArrow(compare, _SCHEMA)
    suspects = _by_document(suspects, parts, _merged(1, min_words - length), "d long, begins array<int>, ends array<int>", ["d", "begins", "ends"])
    around = texts.join(suspects.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("d"))).select("doc_id", "text", "begins", "ends")
    decided = dealt(around.mapInArrow(extend, _SCHEMA), "part", parts).mapInArrow(smallest, _SCHEMA)
    return _by_document(decided, parts, _merged(min_words, 0), "d long, begins array<int>, ends array<int>", ["d", "begins", "ends"])


def substring_dedup(docs: DataFrame, min_words: int = 50, period: int = PERIOD, cover: tuple[int, ...] = COVER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept words joined by one space; see the module's text for the cases."""
    assert min_words > period and {(a - b) % period for a in cover for b in cover} == set(range(period))
    docs = one_row_per_id(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    texts = docs.select("doc_id", "text")
    # packed rows go to as many tasks as bound what one unpacks at once
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(partitions(docs.sparkSession), -(-size // TASK_BYTES))
    gone = removed_runs(docs, texts, min_words, period, cover, parts)

    def cut(batches):
        for batch in batches:
            counts, taken, kept = [], [], []
            for text, begins, ends in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                word = (text.as_py() or "").encode().split()
                n, left = len(word), word
                if begins.is_valid:
                    left, at = [], 0
                    for b, e in zip(begins.as_py(), ends.as_py(), strict=True):
                        left += word[at:b]
                        at = e
                    left += word[at:]
                counts.append(n)
                taken.append(n - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(taken, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    # null-safe like the join with the anchors: the same exchange of the texts serves both
    ranged = texts.join(gone.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("d")), "left").select("doc_id", "text", "begins", "ends")
    return ranged.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")
