"""Read preprocessing against plain versions on every kind of read."""
import random
from collections import Counter

import numpy as np
import pytest

from lociq.operators import readprep
from lociq.plans import queries

SCHEMA = "id long, seq string, quality string, other string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "kept") for r in rows], SCHEMA).repartition(3)


def drawn(seed, n=300, longest=60, letters="ACGTN"):
    rng = random.Random(seed)
    out = [(0, "", ""), (1, None, None), (2, "N", "!"), (3, "NNNN", "IIII")]
    for i in range(4, n):
        k = rng.randrange(longest)
        out.append((i, "".join(rng.choice(letters) for _ in range(k)), "".join(chr(33 + rng.choice([2, 10, 19, 20, 21, 30, 41])) for _ in range(k))))
    return out


def running_sum(q, front, tail):
    def cut(values, limit):
        total, best, at = 0, 0, 0
        for i, v in enumerate(values):
            total += limit - v
            if total < 0:
                break
            if total > best:
                best, at = total, i + 1
        return at

    start, stop = cut(q, front), len(q) - cut(q[::-1], tail)
    return (0, 0) if start >= stop else (start, stop)


@pytest.mark.parametrize("front", [0, 15])
def test_quality_cuts(spark, front):
    rows = drawn(1)
    got = {r.id: (r.seq, r.quality, r.other) for r in readprep.quality_trimmed(frame(spark, rows), 20, front).collect()}
    for i, s, q in rows:
        a, b = running_sum([ord(c) - 33 for c in q or ""], front, 20)
        assert got[i] == ((s or "")[a:b], (q or "")[a:b], "kept"), (i, s, q)
    with pytest.raises(Exception, match="more bases"):
        readprep.quality_trimmed(frame(spark, [(1, "ACG", "II")])).collect()


def test_n_and_length(spark):
    rows = drawn(2, letters="ANN")
    got = {r.id: (r.seq, r.quality) for r in readprep.n_trimmed(frame(spark, rows)).collect()}
    for i, s, q in rows:
        if s is not None:
            a = len(s) - len(s.lstrip("N"))
            b = max(a, len(s.rstrip("N")))
            assert got[i] == (s[a:b], q[a:b])
    assert {r.id for r in readprep.long_enough(frame(spark, rows), 10).collect()} == {i for i, s, _ in rows if len(s or "") >= 10}


def plain_adapter(s, a, rate, least):
    """Best (matches, edits, begin) by all cells of the edit matrix, each with its least (edits, -matches, begin)."""
    col = [(i, 0, 0) for i in range(len(a) + 1)]
    best = None
    for j in range(len(s) + 1):
        for i in range(1, len(a) + 1):
            edits, less, begin = col[i]
            if (i == len(a) or j == len(s) and i >= least) and less < 0 and edits <= int(rate * i + 1e-9):
                best = min(best or (1, 0, 0), (less, edits, begin))
        if j < len(s):
            now = [(0, 0, j + 1)]
            for i in range(1, len(a) + 1):
                d, u, w = col[i - 1], col[i], now[i - 1]
                same = s[j] == a[i - 1] and s[j] in "ACGT"
                now.append(min((d[0] + (not same), d[1] - same, d[2]), (u[0] + 1, u[1], u[2]), (w[0] + 1, w[1], w[2])))
            col = now
    return best


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.25])
def test_adapters(spark, rate):
    rng = random.Random(3)
    found = readprep.adapters("ACGTACGTTG, TTTTTTTTCA") + readprep.adapters("GGCATTAGAC", 5) + [readprep.Adapter("ACGT" * 16)]
    rows = drawn(4, 150, letters="ACGT")
    for i in range(150, 400):
        k = rng.randrange(5, 40)
        s, a = [rng.choice("ACGTN") for _ in range(k)], list(rng.choice(found).seq)
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(a))
            a[at : at + 1] = rng.choice([[], [rng.choice("ACGT")], [a[at], rng.choice("ACGT")]])
        at = rng.randrange(k)
        s = "".join(s[:at] + a + s[at:])[rng.choice([0, 0, 3, at + 4]) :][: rng.randrange(8, 60)]
        rows.append((i, s, "I" * len(s)))
    got = {r.id: r.seq for r in readprep.adapter_trimmed(frame(spark, rows), found, rate).collect()}
    changed = 0
    for i, s, _ in rows:
        s = s or ""
        ways = []
        for n, a in enumerate(found):
            x = plain_adapter(s if a.end == 3 else s[::-1], a.seq if a.end == 3 else a.seq[::-1], rate, 3)
            if x:
                ways.append((*x, n))
        want = s
        if ways:
            *_, begin, n = min(ways)
            want = s[:begin] if found[n].end == 3 else s[len(s) - begin :]
        changed += want != s
        assert got[i] == want, (s, ways)
    assert changed > 100


def plain_merge(s, p, t, q, overlap, rate):
    t, q = t[::-1].translate(str.maketrans("ACGT", "TGCA")), q[::-1]
    best = None
    for d in range(-len(t) + 1, len(s)):
        lo, hi = max(0, d), min(len(s), d + len(t))
        x, y = s[lo:hi], t[lo - d : hi - d]
        same = sum(a == b and a in "ACGT" for a, b in zip(x, y))
        wrong = sum(a != b and a in "ACGT" and b in "ACGT" for a, b in zip(x, y))
        if hi - lo >= overlap and (best is None or (same - wrong, hi - lo) > best[:2]):
            best = (same - wrong, hi - lo, d, wrong)
    if best is None or best[0] <= 0 or best[3] > rate * best[1]:
        return None
    _, n, d, _ = best
    lo, hi = max(0, d), min(len(s), d + len(t))
    out = []
    for i in range(lo, hi):
        a, b, u, v = s[i], t[i - d], ord(p[i]) - 33, ord(q[i - d]) - 33
        a, b = (c if c in "ACGT" else "N" for c in (a, b))
        if a == b:
            out.append((a, min(u + v, 41)))
        elif "N" in (a, b):
            out.append((b, v) if a == "N" else (a, u))
        else:
            out.append((a if u >= v else b, max(abs(u - v), 2)))
    core, qual = "".join(c for c, _ in out), "".join(chr(33 + v) for _, v in out)
    if d >= 0 and d + len(t) >= len(s):
        core, qual = s[:d] + core + t[len(s) - d :], p[:d] + qual + q[len(s) - d :]
    return core, qual, n


def test_pairs(spark):
    rng = random.Random(9)
    reads, mates, planted = [(-1, "", ""), (-2, None, None), (-3, "A" * 30, "I" * 30)], [(-1, "", ""), (-2, "ACGT", "IIII"), (-4, "A" * 30, "I" * 30)], {}
    for i in range(300):
        whole = "".join(rng.choice("ACGT") for _ in range(rng.randrange(15, 90)))
        a, b = whole[:40], whole[-40:]
        if len(whole) < 40:
            a, b = (whole + "ACGTTGCAAC" * 4)[:40], ("GGTTACCATG" * 4 + whole)[-40:]
        elif len(whole) <= 70:
            planted[i] = whole
        b = "".join(c if rng.random() > 0.03 else rng.choice("ACGTN") for c in b)
        qa, qb = ("".join(chr(33 + rng.choice([2, 15, 30, 40])) for _ in x) for x in (a, b))
        if rng.random() < 0.03:
            planted.pop(i, None)
            b = "".join(rng.choice("ACGT") for _ in b)
        reads.append((i, a, qa))
        mates.append((i, b[::-1].translate(str.maketrans("ACGT", "TGCA")), qb))
    got = {r.id: (r.seq, r.quality, r.overlap) for r in readprep.merged_pairs(frame(spark, reads), frame(spark, mates)).collect()}
    other = {i: (s, q) for i, s, q in mates}
    want = {}
    for i, s, q in reads:
        m = plain_merge(s or "", q or "", other[i][0] or "", other[i][1] or "", 10, 0.1) if i in other else None
        if m and len(m[0]) >= 10:
            want[i] = m
    assert got == want
    assert sum(len(got.get(i, ("",))[0]) == len(w) for i, w in planted.items()) > 0.95 * len(planted) > 80


def test_heavy_sequences_are_exact(spark):
    rng = random.Random(2)
    seqs = ["hot"] * 3000 + [f"warm{i % 3}" for i in range(90)] + [f"x{rng.randrange(4000)}" for _ in range(6000)] + [None] * 50
    rng.shuffle(seqs)
    frame_ = spark.createDataFrame([(s,) for s in seqs], "seq string").repartition(7)
    n, count = len(seqs), Counter(s or "" for s in seqs)
    for share in (0.2, 0.003, 0.001):
        assert {(r.seq, r.n) for r in readprep.heavy_sequences(frame_, share).collect()} == {(s, k) for s, k in count.items() if k > share * n}


def test_empty(spark):
    none = frame(spark, [])
    for f in (readprep.prepared, readprep.by_position, readprep.content, readprep.duplication, readprep.heavy_sequences, lambda x: readprep.quality_quantiles(readprep.by_position(x)), lambda x: readprep.merged_pairs(x, x), lambda x: readprep.adapter_trimmed(x, readprep.adapters("ACGT"))):
        assert f(none).collect() == []
    assert {r.level: (r.sequences, r.reads) for r in readprep.duplication(frame(spark, [(1, "A", "I"), (2, "A", "I"), (3, None, None)])).collect()} == {1: (1, 1), 2: (1, 2)}


def test_queries_without_sql(spark):
    """The registered queries against the plain versions, on all reads of the smallest tables' first documents by hash of id."""
    d = "/root/testdata/sf0.001"
    from lociq.plans import views

    reads = {r.id: r.seq for r in views.fastq(spark, d).collect()}
    got = queries.queries()["reads_without_adapters"](spark, d).collect()
    assert len(got) == len(reads)
    found = readprep.adapters("AGATCGGAAGAGC,ACGTATTACG") + readprep.adapters("GTTCAGAGTT", 5)
    for r in got[::29]:
        s = reads[r.id]
        ways = [(*x, n) for n, a in enumerate(found) if (x := plain_adapter(s if a.end == 3 else s[::-1], a.seq if a.end == 3 else a.seq[::-1], 0.1, 3))]
        want = s
        if ways:
            *_, begin, n = min(ways)
            want = s[:begin] if found[n].end == 3 else s[len(s) - begin :]
        assert r.seq == want
    merged = queries.queries()["pairs_merged"](spark, d)
    left, right = ({r.id: (r.seq, r.quality) for r in x.collect()} for x in views.pairs(spark, d))
    out = {r.id: (r.seq, r.quality, r.overlap) for r in merged.collect()}
    for i in sorted(left)[::23]:
        m = plain_merge(*left[i], *right[i], 10, 0.1)
        assert out.get(i) == (m if m and len(m[0]) >= 10 else None)


def test_merging_by_bits():
    """Reads of up to 64 bases are compared as numbers, longer ones as matrices: a column more mustn't change what is found."""
    rng = np.random.default_rng(6)
    a, b = rng.choice(np.frombuffer(b"\0ACGT", np.uint8), (300, 60)), rng.choice(np.frombuffer(b"\0ACGT", np.uint8), (300, 60))
    b[::2, :20], b[1::3, 30:] = a[::2, 40:], a[1::3, :30]
    na, nb = np.full(300, 60), rng.integers(30, 61, 300)
    b[np.arange(60) >= nb[:, None]] = 0
    q, more = np.zeros((300, 60)), np.zeros((300, 10), np.uint8)
    short = readprep._merged(a, q, na, b, q, nb, 10, 0.1)
    long = readprep._merged(np.hstack([a, more]), q, na, np.hstack([b, more]), q, nb, 10, 0.1)
    assert all(np.array_equal(x, y) for x, y in zip(short, long)) and short[2].sum() > 100
    assert len(readprep._bits(a)) == 5
