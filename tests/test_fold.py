"""Folds of least energy against all structures of short strings."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from strandlake.operators import fold as f
from strandlake.operators import ontarget

TABLES = [
    f.Energies(),
    f.Energies(hairpin=(math.inf, math.inf, 0.4, 0.6), bulge=(0.3, 0.8), inner=(math.inf, 0.2, 0.4, 0.5), many_start=-1.5, many_branch=-0.3, weak_end=0.2, longest=6),
    f.Energies(stacks={}, other_stack=-0.5, hairpin=(math.inf, math.inf, 0.1), bulge=(0.1,), inner=(math.inf, 0.1), many_start=0.2, many_branch=0.0, weak_end=0.0, longest=3),
]


def structures(s, i=0):
    """All sets of nested pairs of s[i:], as lists of pairs."""

    def within(i, j):
        if j - i < 4:
            return [[]]
        out = list(within(i + 1, j))
        for k in range(i + 4, j):
            if s[i] + s[k] in f.PAIRS:
                out += [[(i, k), *a, *b] for a in within(i + 1, k) for b in within(k + 1, j)]
        return out

    return within(i, len(s))


def energy(s, pairs, e):
    """The sum over loops, written apart from the programme."""
    hundredths = lambda x: round(100 * x)
    weak = lambda p: 0 if s[p[0]] + s[p[1]] in ("CG", "GC") else hundredths(e.weak_end)
    total = 0
    for i, j in pairs:
        inner = [p for p in pairs if i < p[0] and p[1] < j]
        branches = [p for p in inner if not any(q[0] < p[0] and p[1] < q[1] for q in inner)]
        if not branches:
            n = j - i - 1
            if math.isinf((e.hairpin[n - 1] if n <= len(e.hairpin) else 0)):
                return None
            total += e.of(e.hairpin, n) + (weak((i, j)) if n > 3 else 0)
        elif len(branches) == 1:
            k, m = branches[0]
            left, right = k - i - 1, j - m - 1
            if left + right > e.longest:
                return None
            if left + right <= 1:
                key, back = f"{s[i]}{s[k]}/{s[j]}{s[m]}", f"{s[m]}{s[j]}/{s[k]}{s[i]}"
                total += hundredths(e.stacks.get(key, e.stacks.get(back, e.other_stack))) + (e.of(e.bulge, 1) if left + right else 0)
            else:
                total += weak((i, j)) + weak((k, m))
                total += e.of(e.bulge, left + right) if not left or not right else e.of(e.inner, left + right) + hundredths(e.uneven * abs(left - right))
        else:
            total += hundredths(e.many_start) + hundredths(e.many_branch) * (len(branches) + 1) + weak((i, j)) + sum(map(weak, branches))
    outer = [p for p in pairs if not any(q[0] < p[0] and p[1] < q[1] for q in pairs)]
    return total + sum(map(weak, outer))


def pairs_of(structure):
    stack, out = [], []
    for k, c in enumerate(structure):
        if c == "(":
            stack.append(k)
        elif c == ")":
            out.append((stack.pop(), k))
    assert not stack
    return out


@pytest.mark.parametrize("e", TABLES)
def test_least_energy_of_all_structures(e):
    r = random.Random(5)
    strings = ["".join(r.choice("GCGCAU") for _ in range(r.randint(0, 15))) for _ in range(60)] + ["GGAAACCGGAAACCA", "GGGAAACAGAAACCC", "GGGAAACGAAACCCC"[:16]]
    folded = 0
    for s, (structure, value) in zip(strings, f.fold(strings, e), strict=True):
        values = [x for p in structures(s) if (x := energy(s, p, e)) is not None]
        assert round(100 * value) == min(values), s
        assert energy(s, pairs_of(structure), e) == min(values), s
        folded += "(" in structure
    assert folded > 4


def test_loops_of_many_branches():
    e = TABLES[1]
    s = "GGGAAACGGAAACCC"
    assert round(100 * f.fold([s], e)[0][1]) == min(x for p in structures(s) if (x := energy(s, p, e)) is not None)
    long = "GG" + "A" + "GGCGAAAGCC" + "A" + "GGCGAAAGCC" + "A" + "CC"
    structure, value = f.fold([long], e)[0]
    assert energy(long, pairs_of(structure), e) == round(100 * value)
    assert structure == "((.(((....))).(((....))).))"


def test_batches_share_their_end():
    r = random.Random(6)
    strings = ["G" + "".join(r.choice("ACGU") for _ in range(19)) + ontarget.SCAFFOLD for _ in range(30)]
    together, alone = f.fold(strings), [f.fold([s])[0] for s in strings]
    assert together == alone
    for s, (structure, value) in zip(strings, together, strict=True):
        assert energy(s, pairs_of(structure), f.Energies()) == round(100 * value)
    assert f.fold(["", "NNNNNNNNNN", strings[0], "ACGU"]) == [("", 0.0), ("." * 10, 0.0), alone[0], ("....", 0.0)]
    assert f.fold([]) == []


def test_folds_of_guides(spark):
    r = random.Random(7)
    guides = ["".join(r.choice("ACGT") for _ in range(21)) + "GG" for _ in range(40)]
    rows = {x.sequence: x for x in f.folds(spark.createDataFrame([(g,) for g in guides * 2], "sequence string")).collect()}
    eligible = [g for g in guides if g[0] != "T"]
    assert set(rows) == set(eligible)
    want = f.fold([("G" + g[1:20]).replace("T", "U") + ontarget.SCAFFOLD for g in eligible])
    assert {g: w for g, w in zip(eligible, want, strict=True)} == {g: (x.structure, x.energy) for g, x in rows.items()}
    free = "." * 28 + "((((....))))...))))" + "." * 21 + "((((....))))(((((((...)))))))..."
    line = spark.createDataFrame([(free + " (-20.00)",)], "l string").select(ontarget.free_guide(F.col("l"))).first()[0]
    assert line
