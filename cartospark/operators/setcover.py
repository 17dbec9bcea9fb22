"""The cheapest set of overlapping extracts that covers all sample points.

Points in the same candidates are one class, counted in Spark; the choice itself runs on the driver over
the classes, whose number is that of distinct overlaps of extracts, not of points.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Overlap classes the driver takes; the planet has some ten thousand.
MOST_CLASSES = 2_000_000


def classes(candidates: DataFrame) -> DataFrame:
    """(members, n): sets of candidates that share points, with how many."""
    per_point = candidates.filter("id IS NOT NULL").groupBy("id").agg(F.array_sort(F.collect_set("shape_id")).alias("members"))
    return per_point.groupBy("members").agg(F.count("*").alias("n"))


@dataclass
class Cover:
    """Weighted set cover over classes of points: forced first, greedy, prune, swap, prune."""

    cost: dict[int, int]
    forced: set[int]
    classes: list[tuple[tuple[int, ...], int]]
    chosen: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.rank = {c: k for k, c in enumerate(sorted(self.cost))}
        self.of = {c: [] for c in self.cost}
        for k, (members, _) in enumerate(self.classes):
            for c in members:
                self.of[c].append(k)
        self.times = [0] * len(self.classes)

    def _add(self, c: int) -> None:
        self.chosen.append(c)
        for k in self.of[c]:
            self.times[k] += 1

    def _remove(self, c: int) -> None:
        self.chosen.remove(c)
        for k in self.of[c]:
            self.times[k] -= 1

    def _cheapest(self, open_: set[int], barred: set[int]) -> int | None:
        """The candidate with the fewest bytes for each point of the open classes; the first of equals."""
        gain: dict[int, int] = {}
        for k in open_:
            members, n = self.classes[k]
            for c in members:
                if c not in barred:
                    gain[c] = gain.get(c, 0) + n
        return min(gain, key=lambda c: (self.cost[c] / gain[c], self.rank[c]), default=None)

    def _greedy(self) -> None:
        """Add the cheapest candidate until nothing is gained.  Gains only fall, so one that is still worth its old price is the best."""
        price = lambda c: self.cost[c] / gain if (gain := sum(self.classes[k][1] for k in self.of[c] if not self.times[k])) else None
        heap = [(p, self.rank[c], c) for c in self.cost if c not in self.chosen and (p := price(c)) is not None]
        heapify(heap)
        while heap:
            old, rank, c = heappop(heap)
            new = price(c)
            if new == old:
                self._add(c)
            elif new is not None:
                heappush(heap, (new, rank, c))

    def _by_size(self) -> list[int]:
        return sorted(self.chosen, key=lambda c: -self.cost[c])

    def _prune(self) -> None:
        for c in self._by_size():
            if c not in self.forced and all(self.times[k] >= 2 for k in self.of[c]):
                self._remove(c)

    def _swap(self) -> None:
        for c in self._by_size():
            if c in self.forced or c not in self.chosen:
                continue
            left, picks, spent = {k for k in self.of[c] if self.times[k] == 1}, [], 0
            while left:
                other = self._cheapest(left, {c, *self.chosen, *picks})
                if other is None:
                    break
                spent += self.cost[other]
                if spent >= self.cost[c]:
                    break
                picks.append(other)
                left -= set(self.of[other])
            if not left and spent < self.cost[c]:
                self._remove(c)
                for other in picks:
                    self._add(other)

    def solve(self) -> list[int]:
        for c in sorted(self.forced, key=self.rank.get):
            self._add(c)
        self._greedy()
        self._prune()
        self._swap()
        self._prune()
        return self.chosen

    def only(self, c: int) -> list[int]:
        """Classes that c alone covers."""
        return [k for k in self.of[c] if self.times[k] == 1]


def solve(candidates: DataFrame, shapes: DataFrame) -> Cover:
    """candidates (shape_id, forced, id) and shapes (shape_id, bytes): the cover, solved."""
    candidates = candidates.persist()
    ids = candidates.groupBy("shape_id").agg(F.bool_or("forced").alias("forced")).join(shapes.select("shape_id", "bytes"), "shape_id").collect()
    found = [(tuple(r["members"]), r["n"]) for r in classes(candidates).limit(MOST_CLASSES + 1).collect()]
    candidates.unpersist()
    if len(found) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} overlaps of extracts: plan continent by continent")
    cover = Cover({r["shape_id"]: r["bytes"] for r in ids}, {r["shape_id"] for r in ids if r["forced"]}, sorted(found))
    cover.solve()
    return cover
