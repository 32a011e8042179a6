"""Embedding whitening from the exact characteristic polynomial of the integer scatter matrix.

1. Entries become whole numbers x = floor(256 c). The fit list is each distinct x vector once: n vectors with sums S.
2. Tasks sum x x^T exactly, in limbs of 16 bits whose products stay exact in doubles. M = n sum(x x^T) - S S^T is n^2 times the covariance.
3. Spark deals primes over tasks; each reduces M to Hessenberg form modulo its primes and reads off the characteristic polynomial. Chinese
   remaindering gives the integer coefficients: they are non-negative up to alternating signs, and bounded through the trace.
4. All roots are real, so the sign changes of the polynomial moved to a count its roots above a, exactly (Descartes). Halving isolates
   the largest roots to `PRECISION` bits.
5. Inverse iteration on M - root, in decimals of several hundred digits, spans the null space; equal roots get an orthonormal basis.
6. Tasks project all rows.

What goes through the driver is of the dimension's size (sums, coefficients, components), never of the rows'. Halving takes about 150 shifts of
a polynomial of the dimension's degree for a component: seconds at 64 dimensions, minutes at some hundreds.

Rows whose vector is null or holds null or non-finite entries are dropped. Vectors that are shorter than the longest are filled with zeros. Repeated
rows each get their result. Values beyond a long stop at its ends. A deviation beyond a long is null. Components with eigenvalue zero have no whitened values and are left out, so
an empty table, one distinct vector, or vectors without entries give no rows.
"""
from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, stored

#: The contract's parameters: what entries are multiplied by, and components.
SCALE, COMPONENTS = 256, 4
#: Bits of a root after its first, and digits that inverse iteration keeps (several times as many).
PRECISION, DIGITS = 160, 300
#: Bits of a limb, and rows whose products of limbs are summed at once: 2**(16 + 16 + 20) is exact in a double.
LIMB, ROWS = 16, 1 << 20
LONG = 2**63 - 1


def vectors(batch: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a list column: which rows are whole and finite, their lengths, and their entries in one array."""
    flat = pc.list_flatten(batch).cast(pa.float64())
    sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    good = pc.is_valid(flat).to_numpy(zero_copy_only=False) & np.isfinite(flat.to_numpy(zero_copy_only=False))
    ends = np.concatenate([[0], np.cumsum(~good)])
    at = np.concatenate([[0], np.cumsum(sizes)])
    keep = (ends[at[1:]] == ends[at[:-1]]) & pc.is_valid(batch).to_numpy(zero_copy_only=False)
    return keep, sizes[keep], flat.to_numpy(zero_copy_only=False)[np.repeat(keep, sizes)]


def whole(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * value) as longs; those beyond stop at a long's ends."""
    x = np.floor(values.astype(np.float64) * scale)
    return np.where(x >= 2.0**63, LONG, np.where(x <= -(2.0**63), -(2**63), np.clip(x, -(2.0**63), 2.0**63 - 1024).astype(np.int64)))


def integers(rows: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """vec_id, x (array of longs) of the rows that stay."""
    id_type = rows.select(id_col).schema[0].dataType.simpleString()
    rows = rows.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))

    def f(batch: pa.RecordBatch) -> Iterator[dict]:
        keep, sizes, flat = vectors(batch.column(1))
        x = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(whole(flat, scale)))
        yield {"vec_id": batch.column(0).filter(pa.array(keep)), "x": x}

    return map_arrow(rows, f, f"vec_id {id_type}, x array<long>")


def filled(x: pa.Array, d: int) -> np.ndarray:
    """The rows of a list column as a matrix of d columns."""
    sizes = pc.list_value_length(x).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), d), np.int64)
    out[np.arange(d) < sizes[:, None]] = pc.list_flatten(x).to_numpy(zero_copy_only=False)
    return out


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """x as sum of limb k times 2**(LIMB k), each of less than LIMB bits and a sign, as doubles."""
    out, half = [], 1 << (LIMB - 1)
    while x.any() or not out:
        low = (x & (2 * half - 1)).astype(np.int64)
        low = np.where(low >= half, low - 2 * half, low)
        out.append(low.astype(np.float64))
        x = (x >> LIMB) + (low < 0)  # as x - low may not fit
    return out


def moments(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """n, sums and sums of products of the fit list, exact."""
    names = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("bits", pa.int32()), ("total", pa.int64())])

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = filled(batch.column(0), d)
            for at in range(0, len(x), ROWS):
                parts = limbs(x[at : at + ROWS])
                for k, a in enumerate([*parts, None]):
                    for m, b in enumerate(parts):
                        # Row d holds the sums, and n in its last place.
                        bits, got = (LIMB * m, np.vstack([np.zeros((d, d)), b.sum(axis=0)])) if a is None else (LIMB * (k + m), np.vstack([a.T @ b, np.zeros(d)]))
                        sums[bits] = sums.get(bits, 0) + got.astype(np.int64)
        for bits, t in sums.items():
            i, j = np.nonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.full(len(i), bits), pa.int32()), pa.array(t[i, j])], schema=names)

    found = fit.select("x").mapInArrow(f, "i int, j int, bits int, total long")
    # A long's halves are summed apart, so that no number of tasks overflows.
    low, high = F.col("total").bitwiseAND(F.lit((1 << 31) - 1)), F.shiftright("total", 31)
    found = found.groupBy("i", "j", "bits").agg(F.sum(low).alias("low"), F.sum(high).alias("high"))
    sums, products = [0] * d, [[0] * d for _ in range(d)]
    for i, j, bits, lo, hi in found.collect():  # as many as the dimension's square
        value = (lo + (hi << 31)) << bits
        if i == d:
            sums[j] += value
        else:
            products[i][j] += value
    return fit.count(), sums, products


def primes(most: int) -> Iterator[int]:
    """Primes below 2**31, falling, whose product is over `most`."""
    p, product = (1 << 31) - 1, 1
    small = [q for q in range(3, 46341, 2) if all(q % r for r in range(3, math.isqrt(q) + 1, 2))]
    divisors = np.array(small)
    while product <= most:
        if (p % divisors).all():
            yield p
            product *= p
        p -= 2


def char_poly(m: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients of det(t - m) modulo each prime, from the highest, of matrices m[prime]: Hessenberg reduction, then its recurrence."""
    h, q, (k, d) = m.copy(), p[:, None], m.shape[:2]
    at = np.arange(k)

    def inverse(a: np.ndarray) -> np.ndarray:
        return np.array([pow(int(x), -1, int(y)) if x else 0 for x, y in zip(a, p)], np.int64)

    for c in range(d - 2):
        pivot = c + 1 + (h[:, c + 1 :, c] != 0).argmax(axis=1)  # a prime's first entry that isn't zero
        rows = h[at, pivot].copy()
        h[at, pivot], h[:, c + 1] = h[:, c + 1].copy(), rows
        columns = h[at, :, pivot].copy()
        h[at, :, pivot], h[:, :, c + 1] = h[:, :, c + 1].copy(), columns
        factor = h[:, c + 2 :, c] * inverse(h[:, c + 1, c])[:, None] % q
        h[:, c + 2 :] = (h[:, c + 2 :] - factor[:, :, None] * h[:, c + 1, None, :] % q[:, :, None]) % q[:, :, None]
        for r in range(d - c - 2):
            h[:, :, c + 1] = (h[:, :, c + 1] + h[:, :, c + 2 + r] * factor[:, r, None]) % q
    polys = [np.zeros((k, d + 1), np.int64)]
    polys[0][:, 0] = 1  # from the lowest
    for c in range(d):
        now = np.roll(polys[c], 1, axis=1)
        now = (now - h[:, c, c, None] * polys[c]) % q
        product = np.ones(k, np.int64)
        for r in range(c - 1, -1, -1):
            product = product * h[:, r + 1, r] % p
            now = (now - (product * h[:, r, c] % p)[:, None] * polys[r]) % q
        polys.append(now)
    return polys[d][:, ::-1]


def characteristic(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """The coefficients e_k of t^d - e_1 t^(d-1) + e_2 t^(d-2) - ..., of a positive semidefinite integer matrix."""
    d = len(m)
    most = (sum(m[i][i] for i in range(d)) // d + 2) ** d  # of (1 + mean root)**d, which bounds them
    chosen = list(primes(most))

    def f(batch: pa.RecordBatch) -> Iterator[dict]:
        p = batch.column(0).to_numpy()
        for at in range(0, len(p), 32):
            some = p[at : at + 32]
            held = np.array([[[x % int(y) for x in row] for row in m] for y in some], np.int64)
            yield {"p": some, "e": list(char_poly(held, some))}

    dealt = spark.createDataFrame([(x,) for x in chosen], "p long").repartition(max(1, min(len(chosen) // 16, spark.sparkContext.defaultParallelism)))
    found = [(r.p, r.e) for r in map_arrow(dealt, f, "p long, e array<long>").collect()]
    value, modulus = [0] * (d + 1), 1
    for p, e in found:
        again = pow(modulus, -1, p)
        for k in range(d + 1):
            value[k] += modulus * ((e[k] * (-1) ** k - value[k]) * again % p)
        modulus *= p
    return value


def above(e: list[int], a: int, bits: int) -> int:
    """Roots over a / 2**bits, with their multiplicity: sign changes of the polynomial moved there."""
    d = len(e) - 1
    c = [(-x if k % 2 else x) << (bits * k) for k, x in enumerate(e)]  # of the polynomial whose roots are 2**bits times these
    for i in range(d):
        for k in range(1, d + 1 - i):
            c[k] += c[k - 1] * a
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def roots(e: list[int], most: int) -> list[Fraction]:
    """The largest roots over zero, at most `most`, each repeated as often as it occurs, to PRECISION bits."""
    out: list[Fraction] = []
    top = e[1] + 1  # the sum of roots that are all at least zero
    least = above(e, 0, 0)
    while len(out) < min(most, least):
        k = len(out) + 1
        low, high, bits = 0, top, 0
        while high - low > 1:  # the k-th largest is over low, and not over high
            mid = (low + high) // 2
            low, high = (mid, high) if above(e, mid, 0) >= k else (low, mid)
        more = max(0, PRECISION - low.bit_length())
        while bits < more:
            step = min(8, more - bits)
            low, high, bits = low << step, high << step, bits + step
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if above(e, mid, bits) >= k else (low, mid)
        out += [Fraction(2 * low + 1, 2 << bits)] * (above(e, low, bits) - len(out))  # those over low that aren't out yet
    return out[:most]


def components(m: list[list[int]], found: list[Fraction]) -> list[list[decimal.Decimal]]:
    """Orthonormal vectors of the roots: inverse iteration with partial pivoting, in decimals."""
    D, d, out = decimal.Decimal, len(m), []
    with decimal.localcontext(decimal.Context(prec=DIGITS, Emin=-(10**9), Emax=10**9)):
        for k, root in enumerate(found):
            shift = D(root.numerator) / D(root.denominator)
            a = [[D(x) - (shift if i == j else 0) for j, x in enumerate(row)] for i, row in enumerate(m)]
            tiny, swaps, factors = shift * D(10) ** (20 - DIGITS), [], []
            for c in range(d):
                p = max(range(c, d), key=lambda r: abs(a[r][c]))
                a[c], a[p] = a[p], a[c]
                swaps.append(p)
                pivot = a[c][c] = a[c][c] if abs(a[c][c]) > tiny else tiny
                factors.append([a[r][c] / pivot for r in range(c + 1, d)])
                for r, f in zip(range(c + 1, d), factors[-1]):
                    if f:
                        a[r][c + 1 :] = [x - f * y for x, y in zip(a[r][c + 1 :], a[c][c + 1 :])]
            v = [D((k + 2) * 7919 * (i + 1) % 1009 + 1) for i in range(d)]
            for _ in range(3):
                for c in range(d):
                    v[c], v[swaps[c]] = v[swaps[c]], v[c]
                    for r, f in zip(range(c + 1, d), factors[c]):
                        v[r] -= f * v[c]
                for c in range(d - 1, -1, -1):
                    v[c] = (v[c] - sum(a[c][j] * v[j] for j in range(c + 1, d))) / a[c][c]
                for other in out:  # equal roots' vectors, and what is left of others
                    along = sum(x * y for x, y in zip(v, other))
                    v = [x - along * y for x, y in zip(v, other)]
                size = sum(x * x for x in v).sqrt()
                v = [x / size for x in v]
            out.append(v)
    return out


def whitened(rows: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of each row that stays and component."""
    spark = rows.sparkSession
    xs = stored(integers(rows, id_col, vec_col, scale))
    id_type = xs.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double"
    d = xs.agg(F.max(F.size("x"))).first()[0] or 0
    even = xs.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("x"))))
    fit = stored(even.select("x").distinct())
    n, sums, products = moments(fit, d)
    m = [[n * products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    trace = sum(m[i][i] for i in range(d))
    if not trace:
        return spark.createDataFrame([], schema + ", identity_error double")
    found = roots(characteristic(spark, m), most)
    q = np.array([[float(x) for x in v] for v in components(m, found)])
    roots_e = np.array([math.sqrt(e / (n * n)) for e in found])  # square roots of the eigenvalues
    explained = [float(e / trace) for e in found]
    s = np.array(sums, object)
    most_s = max(map(abs, sums), default=0)

    def centred(x: np.ndarray) -> np.ndarray:
        """n x - S, exact: as longs, or as Python's integers where longs may not hold it."""
        if len(x) and max(int(x.max()), -int(x.min())) * n + most_s < 2**62:
            return x * n - s.astype(np.int64)
        return x.astype(object) * n - s

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c = centred(x)
        return c, (c.astype(np.float64) @ q.T) / n / roots_e

    def squares(c: np.ndarray) -> list[int | None]:
        about = (c.astype(np.float64) ** 2).sum(axis=1)
        if not len(c) or about.max() < 2**62:
            return (c.astype(np.int64) ** 2).sum(axis=1).tolist()
        exact = [sum(int(y) ** 2 for y in row) for row in c]
        return [y if y <= LONG else None for y in exact]

    def f(batch: pa.RecordBatch) -> Iterator[dict]:
        k = len(found)
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            c, w = project(filled(part.column(1), d))
            many = pa.array(np.repeat(np.arange(len(c)), k))
            deviation = pa.array(squares(c), pa.int64()).take(many)
            yield {"vec_id": part.column(0).take(many), "component": np.tile(np.arange(1, k + 1), len(c)), "n": np.full(k * len(c), n), "deviation": deviation, "whitened": w.ravel(), "explained": explained * len(c)}

    def g(batch: pa.RecordBatch) -> Iterator[dict]:
        for at in range(0, batch.num_rows, 4096):
            yield {"w": list(project(filled(batch.column(0).slice(at, 4096), d))[1])}

    w = map_arrow(fit, g, "w array<double>")
    mean = w.agg(*(F.avg(F.col("w")[i]) for i in range(len(found)))).first()
    c = [F.col("w")[i] - F.lit(mean[i]) for i in range(len(found))]
    entries = [F.abs(F.avg(c[i] * c[j]) - F.lit(float(i == j))) for i in range(len(found)) for j in range(i + 1)]
    error = max(w.agg(*entries).first())
    return map_arrow(xs, f, schema).withColumn("identity_error", F.lit(error))
