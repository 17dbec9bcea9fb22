"""License scans: license notices in texts, by MinHash bands over overlapping windows, in DataFrame functions only.

Method: a text is cut into windows of WINDOW words that overlap by half, and so hold any notice of up to
half a window as a whole.  Words are compared in lower case and without PUNCTUATION at their ends; what is
punctuation alone, such as comment marks before each line, is no word.  The word shingles of a window that
occur in some template (others cannot count for containment) get a MinHash signature of BANDS rows, each a
band of its own: a window and a template whose sets have similarity s share a band with probability
1 - (1 - s) ** BANDS, above 0.9999 for s >= 0.25.  Bands are joined with those of the templates.  Parts so small
that a window can contain them at a lower similarity are found by their shingles themselves, exactly.  Each
(window, template) found is verified: the share of the template's shingles that the window contains, exactly,
must reach the threshold.

Templates are parameters, a bounded list: name and text, or several texts; those longer than half a window are
cut into parts of half a window, the last of which overlaps backwards, and parts are numbered on over the texts.
Those registered are one-line notices, standard headers, and the texts in ``licenses/``.

Defined cases: null and empty texts match nothing; a template with fewer words than a shingle is refused with
an error; repeated rows and null ids are reported row by row; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exprs
from .shared import written

WINDOW = 64
BANDS = 32
#: Similarity from which on the bands find a pair.
BANDED = 0.25
#: Distinct shingles of all templates that one scan takes; they are constants of its plan.
MOST_SHINGLES = 200_000
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\u2018\u2019\u201c\u201d\u00ab\u00bb\u2013\u2014\u2026\u00a9\u00b7\u2022"


def _text(name: str, first: str = "", last: str = "") -> str:
    """A text in licenses/, or its passage from ``first`` to ``last``."""
    text = (Path(__file__).parent / "licenses" / f"{name}.txt").read_text()
    start = text.rindex(first) if first else 0
    return text[start : text.index(last, start) + len(last)] if last else text[start:]


#: Notices as they are commonly written, standard headers, and whole texts; part 0 is the notice.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License 2.0",
        _text("Apache-2.0", "Licensed under the Apache License", "limitations under the License."),
        _text("Apache-2.0"),
    ),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License", "Distributed under the MIT License", "Available under the MIT License", _text("MIT")),
    "BSD-3-Clause": (_text("BSD-3-Clause"),),
    "MPL-2.0": (_text("MPL-2.0", "This Source Code Form is subject", "http://mozilla.org/MPL/2.0/."), _text("MPL-2.0")),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        _text("GPL-3.0", "This program is free software: you can redistribute", "along with this program."),
        _text("GPL-3.0"),
    ),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
}


def _bare(text: str) -> list[str]:
    """Words of a template, as those of texts are compared."""
    return [w for w in (w.strip(PUNCTUATION) for w in re.split(f"[{exprs.SPACES}]+", text.lower())) if w]


def _template_table(spark, templates: dict, size: int) -> DataFrame:
    parts, half = [], WINDOW // 2
    for name, texts in templates.items():
        count = 0
        for text in (texts,) if isinstance(texts, str) else texts:
            word = _bare(text)
            if len(word) < size:
                raise ValueError(f"template {name} has fewer than {size} words")
            last = max(0, len(word) - half)
            for at in [*range(0, last, half - size + 1), last]:
                parts.append((name, count, " ".join(word[at : at + half])))
                count += 1
    table = spark.createDataFrame(parts, "template string, part int, text string")
    return table.select("template", "part", F.array_distinct(exprs.window_hashes(exprs.words(F.col("text")), size)).alias("known"))


def _signature(hashes):
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda j: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, j))))


def scan(docs: DataFrame, templates: dict | None = None, threshold: float = 0.75, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, template, part, containment, first_word) of every match; first_word is its first word's place."""
    spark = docs.sparkSession
    table = written(_template_table(spark, templates or TEMPLATES, size), "templates")
    sets = [set(r["known"]) for r in table.collect()]
    # SQL text, as a column for each of the thousands of literals takes long to make
    every = set().union(*sets)
    if len(every) > MOST_SHINGLES:
        raise ValueError(f"the templates have {len(every)} shingles, {MOST_SHINGLES} fit one scan: scan for some of them at a time")
    known = ", ".join(f"{h}L" for h in sorted(every))
    text = F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    bare = F.filter(F.transform(exprs.words(text), lambda w, i: F.struct(i.alias("at"), F.btrim(w, F.lit(PUNCTUATION)).alias("w"))), lambda x: x["w"] != "")
    # i counts the words that are not punctuation, at counts all
    placed = docs.select(F.col(id_col).cast("long").alias("doc_id"), bare.alias("bare"))
    placed = placed.select("doc_id", F.col("bare.at").alias("at"), exprs.window_hashes(F.col("bare.w"), size).alias("hashes"))
    hits = placed.select("doc_id", F.expr(f"filter(transform(hashes, (h, i) -> if(h IN ({known}), struct(i AS i, get(at, i) AS at, h AS h), NULL)), x -> x IS NOT NULL)").alias("hits"))
    hits = written(hits.withColumn("row", F.monotonically_increasing_id()).filter(F.size("hits") > 0), "hits")
    half = WINDOW // 2
    cells = F.array_distinct(F.flatten(F.transform("hits", lambda x: F.array(F.floor(x["i"] / half), F.greatest(F.floor(x["i"] / half) - 1, F.lit(0))))))
    inside = F.filter("hits", lambda x: (x["i"] >= F.col("cell") * half) & (x["i"] <= F.col("cell") * half + WINDOW - size))
    windows = hits.withColumn("cell", F.explode(cells)).withColumn("inside", inside).filter(F.size("inside") > 0)
    windows = windows.withColumn("have", F.array_distinct(F.transform("inside", lambda x: x["h"])))
    # the least similarity of a part that a full window contains to the threshold, by its size
    least = lambda n: (c := math.ceil(threshold * n)) / (WINDOW - size + 1 + n - c)
    exact = max((n for n in range(WINDOW) if least(n) < BANDED), default=0)
    single = F.transform("have", lambda h: F.struct(F.lit(-1).alias("band"), h.alias("value")))
    signed = lambda c: F.transform(_signature(F.col(c)), lambda v, j: F.struct(j.alias("band"), v.alias("value")))
    banded = windows.select("doc_id", "row", "cell", "inside", "have", F.explode(F.concat(single, signed("have"))).alias("key"))
    keys = F.when(F.size("known") <= exact, F.transform("known", lambda h: F.struct(F.lit(-1).alias("band"), h.alias("value")))).otherwise(signed("known"))
    bands = table.select("template", "part", "known", F.explode(keys).alias("key"))
    pairs = banded.join(F.broadcast(bands), "key")
    share = F.size(F.array_intersect("have", "known")) / F.size("known")
    first = F.array_min(F.transform(F.filter("inside", lambda x: F.array_contains(F.col("known"), x["h"])), lambda x: x["at"]))
    found = pairs.select("doc_id", "row", "template", "part", share.alias("share"), first.alias("first")).filter(F.col("share") >= threshold)
    return found.groupBy("row", "template", "part").agg(F.first("doc_id").alias("doc_id"), F.max("share").alias("containment"), F.min("first").cast("long").alias("first_word")).select("doc_id", "template", "part", "containment", "first_word")
