"""N-gram Jaccard join: documents whose sets of word n-grams have a Jaccard similarity of at least t.

Method: prefix filtering with rarest n-grams first.  Two sets with similarity >= t share an n-gram
within their first ``n - ceil(t * n) + 1`` ones under any common order.  The order is: document
frequency, then hash; the most frequent n-grams of all (a list of bounded length) come last.

1. One pass hashes every text: set size, set digest, locally frequent n-grams.
2. A packed shuffle by n-gram finds exact document frequencies.  N-grams of one document alone cannot
   match and are only counted.  A packed shuffle by document returns the repeated ones, in order.
3. Documents with equal sets form one class; only its smallest id goes on.
4. Prefix n-grams are joined.  Length filter, positional filter and suffix
   filter (Hamming distance over hash blocks, a bound for whole sets and so for their suffixes) prune pairs; each remaining pair is verified
   once by intersecting the full lists of repeated n-grams, which is exact since others are unshared.
   To avoid all pairs within a group of copies, each n-gram first links its documents to one leader;
   later joins only pair documents that are not yet in one component.
5. Components of the verified links.

Defined cases: a text that is null, empty or all white space has an empty set and no links.  A text
with fewer than n words has one n-gram, all its words.  Rows that share an id are one document
(see ``one_row_per_id``).  A null id takes no part in links and has a null component.  Other columns of the input are ignored.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .components import components
from .shared import dealt, dropped, one_row_per_id, partitions, released, written

#: Entries that one map task packs at once; bounds its memory.
FLUSH = 2_000_000
#: Entries of all documents for each task that unpacks them; bounds its memory at any size of the input.
TASK_ENTRIES = 4_000_000
#: An n-gram in this many documents of one packed batch is reported as frequent.
LOCAL_FREQUENT = 48
#: At most so many frequent n-grams are broadcast (8 bytes each).
MOST_FREQUENT = 1 << 16
#: Documents of a frequent n-gram that one share of its pairs compares with all.
SHARE = 512
#: Ids (8 bytes each) that are broadcast to drop their rows; more are shuffled.
MOST_IDS = 2_000_000
#: Blocks of the hash space that the suffix filter counts.
BLOCKS = 32
_HOT = np.uint64(1 << 62)


def _distinct_entries(batches, size: int):
    """(row documents ids, set sizes, owners, hashes) of each slice of the batches."""
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, buf, offsets in K.text_slices(batch.column(1)):
            word, counts, _, _ = K.words(buf, offsets, lower=True)
            owner, hashed = K.shingle_sets(word, counts, size)
            yield ids.slice(lo, hi - lo), hi - lo, owner, hashed


def profile(docs: DataFrame, size: int) -> DataFrame:
    """Per document (kind 0): set size and digest.  Per batch (kind 1): frequent n-grams and counts."""

    def scan(batches):
        held, pending = 0, []

        def frequent():
            if not pending:
                return None
            h, c = np.unique(np.concatenate(pending), return_counts=True)
            h, c = h[c >= LOCAL_FREQUENT], c[c >= LOCAL_FREQUENT]
            m = len(h)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(m, np.int32)), pa.array(np.full(m, None), pa.int64()), pa.array(c.astype(np.int64)), pa.array(K.signed(h)), pa.array(np.zeros(m, np.int64))],
                names=["kind", "doc_id", "n", "d1", "d2"],
            )

        for ids, texts, owner, hashed in _distinct_entries(batches, size):
            n = np.bincount(owner, minlength=texts)
            at = np.concatenate(([0], np.cumsum(n)))
            one = np.concatenate((np.zeros(1, K.U), np.cumsum(K.mix(hashed + K.U(1)))))
            two = np.concatenate((np.zeros(1, K.U), np.cumsum(K.mix(hashed ^ K.U(0xA5A5A5A5A5A5A5A5)))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(texts, np.int32)), ids, pa.array(n.astype(np.int64)), pa.array(K.signed(one[at[1:]] - one[at[:-1]])), pa.array(K.signed(two[at[1:]] - two[at[:-1]]))],
                names=["kind", "doc_id", "n", "d1", "d2"],
            )
            pending.append(hashed)
            held += len(hashed)
            if held >= FLUSH:
                yield frequent()
                held, pending = 0, []
        if (last := frequent()) is not None:
            yield last

    return docs.mapInArrow(scan, "kind int, doc_id long, n long, d1 long, d2 long")


def _frequent(prof: DataFrame) -> np.ndarray:
    """The most frequent n-grams, rarer first; at most MOST_FREQUENT."""
    rows = prof.filter("kind = 1").groupBy("d1").agg(F.sum("n").alias("c")).orderBy(F.desc("c"), "d1").limit(MOST_FREQUENT).select("d1").toPandas()
    return rows["d1"].to_numpy(dtype=np.int64)[::-1].copy()


def repeated(docs: DataFrame, size: int, threshold: Fraction, frequent: np.ndarray, parts: int) -> DataFrame:
    """Documents whose prefix has a repeated n-gram: (doc_id, n, u, pre, toks, blocks).

    n: set size; u: n-grams of this document alone; pre: repeated ones in the prefix; toks: all
    repeated ones in the common order, as numbers that stand for n-grams; blocks: how many of them
    fall in each block of the hash space.
    """
    names = ["part", "kind", "blob"]
    schema = "part int, kind int, blob binary"
    hot = frequent.view(K.U)
    hot_rank = np.argsort(hot).astype(K.U)
    hot_sorted = hot[hot_rank.astype(np.int64)]

    def owners(ids: np.ndarray) -> np.ndarray:
        return (K.mix(ids) % K.U(parts)).astype(np.int64)

    def rows(found):
        part, kind, blob = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())], names=names)

    def by_owner(kind, ids, *columns, order=()):
        """Rows for the tasks that own the documents, sorted by document there."""
        to = owners(ids)
        sort = np.lexsort((*order, ids, to))
        to, ids, columns = to[sort], ids[sort], [c[sort] for c in columns]
        at = K.runs(to)
        return [(int(to[a]), kind, K.pack(ids[a:b], *(c[a:b] for c in columns), delta=1)) for a, b in zip(at[:-1], at[1:], strict=True)]

    def deal(batches):
        held, pending, meta = 0, [], []

        def flush():
            hashed, ids = (np.concatenate(x) for x in zip(*pending, strict=True))
            found = []
            m_ids, m_n = (np.concatenate(x) for x in zip(*meta, strict=True))
            if len(m_ids):
                found += by_owner(1, m_ids, m_n)
            if len(hot_sorted):
                at = np.minimum(np.searchsorted(hot_sorted, hashed), len(hot_sorted) - 1)
                is_hot = hot_sorted[at] == hashed
                if is_hot.any():
                    rank = hot_rank[at[is_hot]]
                    found += by_owner(2, ids[is_hot], rank, order=(rank,))
                hashed, ids = hashed[~is_hot], ids[~is_hot]
            order = np.argsort(hashed, kind="stable")
            hashed, ids = hashed[order], ids[order]
            edges = K.partition_edges(hashed, parts)
            found += [(p, 0, K.pack(hashed[a:b], ids[a:b], delta=1)) for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
            return rows(found) if found else None

        for ids, texts, owner, hashed in _distinct_entries(batches, size):
            known = ~np.asarray(ids.is_null())
            number = K.zigzag(ids.fill_null(0).to_numpy(zero_copy_only=False))
            n = np.bincount(owner, minlength=texts)
            use = known[owner]
            pending.append((hashed[use], number[owner[use]]))
            meta.append((number[known & (n > 0)], n[known & (n > 0)].astype(K.U)))
            held += len(hashed)
            if held >= FLUSH:
                if (out := flush()) is not None:
                    yield out
                held, pending, meta = 0, [], []
        if pending and (out := flush()) is not None:
            yield out

    def count(batches):
        hashed, ids, mine = [], [], None
        for batch in batches:
            for part, kind, blob in zip(*(batch.column(k) for k in range(3)), strict=True):
                if kind.as_py():
                    yield rows([(part.as_py(), kind.as_py(), blob.as_py())])
                    continue
                mine = part.as_py()
                h, d = K.unpack(blob.as_buffer(), 2, delta=1)
                hashed.append(h)
                ids.append(d)
        if not hashed:
            return
        hashed, ids = np.concatenate(hashed), np.concatenate(ids)
        order = np.argsort(hashed, kind="stable")
        hashed, ids = hashed[order], ids[order]
        at = K.runs(hashed)
        df = np.diff(at)
        token = np.repeat(np.cumsum(df > 1) - 1, df)
        often = np.repeat(df, df)
        keep = often > 1
        if keep.any():
            number = (K.U(mine) << K.U(32)) | token[keep].astype(K.U)
            yield rows(by_owner(3, ids[keep], number, often[keep].astype(K.U)))

    def gather(batches):
        doc, tok, often, m_ids, m_n = [], [], [], [], []
        for batch in batches:
            for kind, blob in zip(batch.column(1), batch.column(2), strict=True):
                kind = kind.as_py()
                got = K.unpack(blob.as_buffer(), 3 if kind == 3 else 2, delta=1)
                if kind == 1:
                    m_ids.append(got[0])
                    m_n.append(got[1])
                else:
                    doc.append(got[0])
                    tok.append(got[1] if kind == 3 else got[1] | _HOT)
                    often.append(got[2] if kind == 3 else np.full(len(got[0]), _HOT, K.U))
        if not doc:
            return
        m_ids, m_n = np.concatenate(m_ids), np.concatenate(m_n)
        order = np.argsort(m_ids, kind="stable")
        m_ids, m_n = m_ids[order], m_n[order]
        doc, tok, often = np.concatenate(doc), np.concatenate(tok), np.concatenate(often)
        order = np.lexsort((tok, often, doc))
        doc, tok = doc[order], tok[order]
        at = K.runs(doc)
        first, listed = at[:-1], np.diff(at)
        place = np.searchsorted(m_ids, doc[first])
        n = m_n[place].astype(np.int64)
        unique = n - listed
        need = n - -(-(threshold.numerator * n) // threshold.denominator) + 1
        prefix = np.minimum(need - unique, listed)
        use = np.flatnonzero(prefix > 0)
        for lo in range(0, len(use), 2000):
            some = use[lo : lo + 2000]
            lists = [tok[first[k] : first[k] + listed[k]] for k in some]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(K.unzigzag(doc[first[some]])),
                    pa.array(n[some]),
                    pa.array(unique[some]),
                    pa.array(prefix[some]),
                    pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32), pa.array(K.signed(np.concatenate(lists)))),
                    pa.ListArray.from_arrays(
                        (np.arange(len(some) + 1) * BLOCKS).astype(np.int32),
                        pa.array(np.concatenate([np.bincount((K.mix(x) % K.U(BLOCKS)).astype(np.int64), minlength=BLOCKS) for x in lists]).astype(np.int32)),
                    ),
                ],
                names=["doc_id", "n", "u", "pre", "toks", "blocks"],
            )

    packed = dealt(docs.mapInArrow(deal, schema), "part", parts)
    counted = dealt(packed.mapInArrow(count, schema), "part", parts)
    return counted.mapInArrow(gather, "doc_id long, n long, u long, pre long, toks array<long>, blocks array<int>")


def _links(cand: DataFrame, pairs: DataFrame, threshold: Fraction) -> DataFrame:
    """Verified pairs among (a, b): suffix filter, then each pair once by intersecting the whole lists."""
    num, den = threshold.numerator, threshold.denominator
    some = lambda c, *more: cand.select(F.col("doc_id").alias(c), *(F.col(m).alias(m + c) for m in more))
    pairs = pairs.select("a", "b").join(some("a", "n", "u", "blocks"), "a").join(some("b", "n", "u", "blocks"), "b")
    # the Hamming distance |A| + |B| - 2 * overlap is bounded from below by unshared n-grams and blocks
    apart = F.col("ua") + F.col("ub") + F.aggregate(F.zip_with("blocksa", "blocksb", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    pairs = pairs.filter((num + den) * (F.col("na") + F.col("nb") - apart) >= 2 * num * (F.col("na") + F.col("nb")))
    both = pairs.select("a", "na", "b", "nb").join(some("a", "toks"), "a").join(some("b", "toks"), "b")
    both = both.withColumn("same", F.size(F.array_intersect("toksa", "toksb")).cast("long"))
    return both.filter(den * F.col("same") >= num * (F.col("na") + F.col("nb") - F.col("same"))).select("a", "b")


def _possible(threshold: Fraction):
    """Length and positional filter of one common prefix n-gram: sizes na, nb and positions pa, pb.

    Similarity >= t means an overlap of at least t / (1 + t) * (na + nb), and the overlap from a common
    n-gram on is at most what is left of either set.  At a pair's first common n-gram this bounds its
    whole overlap; later ones only pass if the first does, so the filter may drop them one by one.
    """
    num, den = threshold.numerator, threshold.denominator
    fits = den * F.least("na", "nb") >= num * F.greatest("na", "nb")
    best = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return fits & ((num + den) * best >= num * (F.col("na") + F.col("nb")))


def _linked(cand: DataFrame, threshold: Fraction) -> DataFrame:
    """(id, component) of the candidates that have a link."""
    prefix = cand.select("doc_id", "n", "u", F.posexplode(F.slice("toks", F.lit(1), F.col("pre").cast("int"))).alias("k", "tok"))
    prefix = written(prefix.select("tok", "doc_id", "n", (F.col("u") + F.col("k")).alias("pos")), "prefix")
    # a leader for each n-gram: the document with the fewest n-grams of its own
    rank = F.struct((-F.col("pos")).alias("p"), F.col("n").alias("n"), (-F.col("doc_id")).alias("i"), F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
    led = prefix.groupBy("tok").agg(F.max(rank).alias("led"), F.count("*").alias("m")).filter("m > 1").select("tok", "led.b", "led.nb", "led.pb")
    star = prefix.select("tok", F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa")).join(led, "tok").filter("a != b")
    tried = written(star.filter(_possible(threshold)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "tried")
    links = written(_links(cand, tried, threshold), "links")
    found = written(components(links), "found")
    # all that is left: pairs within an n-gram whose documents are not in one component yet
    owned = prefix.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("comp", F.coalesce("component", "doc_id")).drop("component")
    mixed = owned.groupBy("tok").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m")).filter("lo < hi")
    # the documents of a frequent n-gram are split: one side by hash over its shares, the other copied to each
    shares = F.ceil(F.col("m") / SHARE).cast("int").alias("shares")
    owned = written(owned.join(mixed.select("tok", shares), "tok"), "owned")
    side = lambda c, share: owned.select("tok", share.alias("share"), F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("pos").alias(f"p{c}"), F.col("comp").alias(f"c{c}"))
    one, every = F.pmod(F.xxhash64("doc_id"), F.col("shares")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1))
    rest = side("a", one).join(side("b", every), ["tok", "share"]).filter((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _possible(threshold))
    rest = rest.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    more = written(links.union(_links(cand, rest, threshold)), "links")
    out = written(components(more), "found")
    dropped(prefix, tried, links, found, owned, more)
    return out


def ngram_join(docs: DataFrame, threshold: Fraction = Fraction(3, 4), size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document; see the module's text for the cases."""
    spark = docs.sparkSession
    docs = one_row_per_id(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    prof = written(profile(docs, size), "profile")
    # packed rows go to as many tasks as bound what one unpacks at once
    total = prof.filter("kind = 0").agg(F.sum("n")).first()[0] or 0
    parts = max(partitions(spark), -(-total // TASK_ENTRIES))
    cand = written(repeated(docs, size, threshold, _frequent(prof), parts), "repeated")
    released(spark)
    each = prof.filter("kind = 0").select("doc_id", "n", "d1", "d2")
    classes = each.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    reps = written(classes, "classes")
    alone = written(cand.join(reps.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"), "candidates")
    dropped(cand)
    found = _linked(alone, threshold)
    dropped(alone)
    merged = reps.join(found.withColumnRenamed("id", "rep"), "rep", "left").filter("copies > 1 OR component IS NOT NULL").select("n", "d1", "d2", F.coalesce("component", "rep").alias("component"))
    return each.join(merged, ["n", "d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    )


def one_of_each_group(docs: DataFrame, threshold: Fraction = Fraction(3, 4), size: int = 5) -> DataFrame:
    """The rows of docs, all columns, whose id is the smallest of its component; null ids stay."""
    docs = one_row_per_id(docs)
    gone = written(ngram_join(docs, threshold, size).filter("doc_id <> component_id").select("doc_id"), "copies")
    return docs.join(gone.hint("broadcast" if gone.count() <= MOST_IDS else "shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)
