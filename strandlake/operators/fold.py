"""Folds of least free energy for batches of RNA, by dynamic programming over loops.

A fold is a set of nested pairs; its energy is the sum over its loops by a table that users bring: stacks of neighbouring
pairs, hairpins, bulges and inner loops by their unpaired bases, loops of many branches by their number. Inner loops are banded:
LONGEST unpaired bases at most. One pass fills all cells for a whole batch with numpy, energies in hundredths as
integers. Cells inside an end that all strings share (the scaffold) are filled once for all.

Defined results: an empty string folds to an empty structure of energy 0. Letters other than A, C, G, U pair with nothing. Of
folds of the same energy the one found first is given: fewer bases paired at the outside, inner loops by their left side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.operators.ontarget import SCAFFOLD, fold_eligible, fold_with, free_guide

PAIRS = ("AU", "CG", "GC", "GU", "UA", "UG")
LEAST_HAIRPIN, NEVER = 3, 1 << 28
#: Strings that are folded together.
BATCH = 256
#: Fixed values (Xia et al. 1998): stacks of Watson-Crick pairs, 5' to 3' over 3' to 5'.
STACKS = {"AA/UU": -0.93, "AU/UA": -1.10, "UA/AU": -1.33, "CU/GA": -2.08, "CA/GU": -2.11, "GU/CA": -2.24, "GA/CU": -2.35, "CG/GC": -2.36, "GG/CC": -3.26, "GC/CG": -3.42}


@dataclass(frozen=True)
class Energies:
    """kcal/mol. Loops by their number of unpaired bases from 1 on; longer ones than listed grow by `growth` times the logarithm of the ratio.

    A stack that is not listed counts `other_stack`; every end of a helix in AU or GU counts `weak_end`, in loops too, but not in hairpins of
    three and bulges of one."""

    stacks: dict[str, float] = field(default_factory=lambda: dict(STACKS))
    other_stack: float = -1.0
    hairpin: tuple[float, ...] = (math.inf, math.inf, 5.4, 5.6, 5.7, 5.4, 6.0, 5.5, 6.4)
    bulge: tuple[float, ...] = (3.8, 2.8, 3.2, 3.6, 4.0, 4.4)
    inner: tuple[float, ...] = (math.inf, 0.5, 1.6, 1.1, 2.0, 2.0)
    uneven: float = 0.6
    growth: float = 1.08
    weak_end: float = 0.45
    many_start: float = 3.4
    many_branch: float = 0.4
    longest: int = 12

    def of(self, table: Sequence[float], n: int) -> int:
        value = table[n - 1] if n <= len(table) else table[-1] + self.growth * math.log(n / len(table))
        return NEVER if math.isinf(value) else round(100 * value)

    @cached_property
    def stack_table(self) -> np.ndarray:
        """Energy of an outer and an inner pair, by their numbers in PAIRS; a row and a column more for none."""
        out = np.full((7, 7), NEVER, np.int32)
        for x, (a, b) in enumerate(PAIRS):
            for y, (c, d) in enumerate(PAIRS):
                value = self.stacks.get(f"{a}{c}/{b}{d}", self.stacks.get(f"{d}{b}/{c}{a}", self.other_stack))
                out[x, y] = round(100 * value)
        return out

    @cached_property
    def end_table(self) -> np.ndarray:
        return np.array([0 if p in ("CG", "GC") else round(100 * self.weak_end) for p in PAIRS] + [0], np.int32)


def kinds(letters: np.ndarray) -> np.ndarray:
    """[i, j, string]: number in PAIRS of bases i and j, 6 for none."""
    out = np.full((letters.shape[1], letters.shape[1], letters.shape[0]), 6, np.int8)
    for k, (x, y) in enumerate(PAIRS):
        out[((letters == ord(x)).T[:, None] & (letters == ord(y)).T[None, :])] = k
    return out


class Folder:
    def __init__(self, letters: np.ndarray, e: Energies, shared: Folder | None = None):
        """letters [string, base]. shared: the folder of the common end (one string)."""
        self.e, self.n, self.b = e, letters.shape[1], letters.shape[0]
        n, b = self.n, self.b
        self.kind = kinds(letters)
        self.inside = np.full((n + 1, n + 1, b), NEVER, np.int32)  # i and j paired
        self.many = np.full((n + 1, n + 1, b), NEVER, np.int32)  # one branch or more of a loop of many
        self.how, self.how_many = np.zeros((n, n, b), np.int32), np.zeros((n, n, b), np.int32)
        common = shared.n if shared else 0
        if shared:
            at = slice(n - common, n)
            for own, theirs in ((self.inside, shared.inside), (self.many, shared.many)):
                own[at, at] = theirs[:common, :common]
            for own, theirs, base in ((self.how, shared.how, n - common), (self.how_many, shared.how_many, n - common)):
                moved = theirs[:common, :common]
                own[at, at] = np.where(moved >= CUT, moved + base, moved)  # places of cuts move with the end
        sizes = [(x, y) for x in range(e.longest + 1) for y in range(e.longest + 1 - x)]
        self.left, self.right = np.array([x for x, _ in sizes]), np.array([y for _, y in sizes])
        self.loop = np.array([self.inner(x, y) for x, y in sizes], np.int32)
        self.stacked = self.left + self.right <= 1
        for j in range(n):
            for i in range(min(j - LEAST_HAIRPIN - 1, n - common - 1) if j >= n - common else j - LEAST_HAIRPIN - 1, -1, -1):
                self.cell(i, j)
        self.outside()

    def inner(self, x: int, y: int) -> int:
        e = self.e
        if x + y == 0:
            return 0
        if x == 0 or y == 0:
            return e.of(e.bulge, x + y)
        return min(NEVER, e.of(e.inner, x + y) + round(100 * e.uneven * abs(x - y)))

    def cell(self, i: int, j: int) -> None:
        e, kind = self.e, self.kind[i, j]
        ends = e.end_table[kind]
        if (kind < 6).any():
            size = j - i - 1
            best = e.of(e.hairpin, size) + (ends if size > 3 else 0)
            best = np.broadcast_to(best, (self.b,)).astype(np.int32)
            how = np.full(self.b, HAIRPIN, np.int32)
            fit = j - 1 - self.right - (i + 1 + self.left) > LEAST_HAIRPIN
            if fit.any():
                k, m = i + 1 + self.left[fit], j - 1 - self.right[fit]
                other = self.kind[k, m]
                cost = self.inside[k, m] + self.loop[fit][:, None]
                tight = self.stacked[fit][:, None]
                cost = cost + np.where(tight, e.stack_table[kind[None, :], other], e.end_table[other] + ends)
                at = cost.argmin(0)
                least = cost[at, np.arange(self.b)]
                how = np.where(least < best, at_code(self.left[fit], self.right[fit])[at], how)
                best = np.minimum(best, least)
            if size >= 2 * (LEAST_HAIRPIN + 2):
                cut = np.arange(i + 1 + LEAST_HAIRPIN + 1, j - 1 - LEAST_HAIRPIN - 1)
                if len(cut):
                    cost = self.many[i + 1, cut] + self.many[cut + 1, j - 1] + (round(100 * e.many_start) + round(100 * e.many_branch)) + ends
                    at = cost.argmin(0)
                    least = cost[at, np.arange(self.b)]
                    how = np.where(least < best, CUT + cut[at], how)
                    best = np.minimum(best, least)
            self.inside[i, j] = np.where(kind < 6, np.minimum(best, NEVER), NEVER)
            self.how[i, j] = how
        branch = self.inside[i, j] + ends + round(100 * e.many_branch)
        options, codes = [self.many[i + 1, j], self.many[i, j - 1], branch], [SKIP_LEFT, SKIP_RIGHT, BRANCH]
        cut = np.arange(i + LEAST_HAIRPIN + 1, j - LEAST_HAIRPIN - 1)
        cost = np.concatenate([np.stack(options), self.many[i, cut] + self.many[cut + 1, j]]) if len(cut) else np.stack(options)
        at = cost.argmin(0)
        self.many[i, j] = np.minimum(cost[at, np.arange(self.b)], NEVER)
        self.how_many[i, j] = np.concatenate([codes, CUT + cut])[at]

    def outside(self) -> None:
        n, b = self.n, self.b
        self.prefix = np.zeros((n + 1, b), np.int32)  # of the first bases
        self.how_prefix = np.full((n + 1, b), -1, np.int32)
        for j in range(n):
            i = np.arange(0, max(0, j - LEAST_HAIRPIN))
            best, how = self.prefix[j].copy(), np.full(b, -1, np.int32)
            if len(i):
                cost = self.prefix[i] + self.inside[i, j] + self.e.end_table[self.kind[i, j]]
                at = cost.argmin(0)
                least = cost[at, np.arange(b)]
                how, best = np.where(least < best, i[at], how), np.minimum(best, least)
            self.prefix[j + 1], self.how_prefix[j + 1] = best, how

    def structure(self, s: int) -> str:
        out, todo = ["."] * self.n, []
        j = self.n
        while j > 0:
            i = int(self.how_prefix[j, s])
            if i < 0:
                j -= 1
            else:
                todo.append((True, i, j - 1))
                j = i
        while todo:
            paired, i, j = todo.pop()
            how = int((self.how if paired else self.how_many)[i, j, s])
            if paired:
                out[i], out[j] = "(", ")"
                if how >= CUT:
                    todo += [(False, i + 1, how - CUT), (False, how - CUT + 1, j - 1)]
                elif how != HAIRPIN:
                    todo.append((True, i + 1 + how // 1000, j - 1 - how % 1000))
            elif how >= CUT:
                todo += [(False, i, how - CUT), (False, how - CUT + 1, j)]
            else:
                todo.append({SKIP_LEFT: (False, i + 1, j), SKIP_RIGHT: (False, i, j - 1), BRANCH: (True, i, j)}[how])
        return "".join(out)


#: How a cell came about: a hairpin, an inner loop (1000 times left + right), skipped bases, a branch, or from CUT on a cut at a place.
HAIRPIN, SKIP_LEFT, SKIP_RIGHT, BRANCH, CUT = -1, -2, -3, -4, 1 << 24


def at_code(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (1000 * left + right).astype(np.int32)


def fold(strings: Sequence[str], energies: Energies | None = None) -> list[tuple[str, float]]:
    """structure and energy of each string, in order; strings of one length are folded together."""
    e, out = energies or Energies(), [("", 0.0)] * len(strings)
    by_length: dict[int, list[int]] = {}
    for k, s in enumerate(strings):
        by_length.setdefault(len(s), []).append(k)
    for n, members in by_length.items():
        if not n:
            continue
        for at in range(0, len(members), BATCH):
            part = members[at : at + BATCH]
            letters = np.array([list(strings[k].encode("ascii", "replace")) for k in part], np.uint8)
            same = (letters == letters[0]).all(0)
            common = n if same.all() else int(np.argmin(same[::-1]))
            shared = Folder(letters[:1, n - common :], e) if 0 < common < n and len(part) > 1 else None
            done = Folder(letters, e, shared)
            for row, k in enumerate(part):
                out[k] = (done.structure(row), float(done.prefix[n, row]) / 100)
    return out


def folds(guides: DataFrame, energies: Energies | None = None, scaffold: str = SCAFFOLD) -> DataFrame:
    """sequence, structure, energy, shaped (the guide stays free) of every distinct guide that is worth folding; dealt over
    tasks, each distinct string folded once."""
    spark = guides.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    distinct = guides.select("sequence").where(fold_eligible(F.col("sequence"))).distinct().repartition(tasks)  # few bytes, much work: not for one task
    done = fold_with(distinct, lambda strings: fold([s.replace("T", "U") for s in strings], energies), scaffold)
    line = F.concat("structure", F.lit(" ("), F.format_number("energy", 2), F.lit(")"))
    return done.select("sequence", "structure", "energy", free_guide(line).alias("shaped"))
