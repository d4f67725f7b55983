"""Whitening along the principal components, from the exact characteristic polynomial of the integer scatter.

Entries become integers x = floor(scale * c) + shift, so the scatter M = n * sum(x x') - S S' (n times n times the
covariance, divisor n) is an integer matrix, known exactly from sums that Spark adds over all rows.

*Polynomial.* Modulo a prime below 2 ** 31 the matrix is reduced to Hessenberg form by similarity, and a recurrence over
its leading minors gives the characteristic polynomial; every prime is a row of a Spark job. M has no negative eigenvalue,
so coefficient k is, up to its known sign, between 0 and (1 + trace / d) ** d, and the residues of enough primes give it
exactly (Chinese remainders).

*Roots.* All roots are real, hence the sign changes of the coefficients of p(x + a) are exactly the number of roots above
a, multiple ones counted. Halving intervals isolates the largest roots; two that agree to ``BITS`` bits of the trace are
one multiple root. Each is then halved on to ``2 * BITS`` bits.

*Components.* Per root, a row of another Spark job: M - r I is eliminated in integers of fixed point (partial pivoting),
and inverse iteration from as many vectors as the root is multiple gives its null space, made orthonormal before it is
rounded to doubles.

*Rows.* (n * x - S) is exact; its squares' sum is the deviation, its projection over n and the root of the eigenvalue the
whitened value. All work per row is linear in d; what meets the driver is d * d numbers, never rows.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are dropped, and so are vectors of
other lengths than the most frequent one (of equally frequent ones the longest). Repeated rows and rows without vec_id
count as rows. Components without variance are not returned, so fewer than 32 where the data have fewer, and none for
one row, for equal rows or an empty table. A deviation beyond a long is null in ``deviation`` and exact in
``deviation_exact``. Entries of 2 ** 40 or more in magnitude raise ``ValueError``. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import written

#: Scale and shift of entries, components, bits of the trace to which roots are told apart, bits of a limb.
SCALE, SHIFT, COMPONENTS, BITS, LIMB = 64, 1_000_000, 32, 160, 20
#: Primes of one row batch; rows whose products are added at a time.
PRIME_ROWS, CHUNK = 8, 4096
MOST_ENTRY = 2.0 ** 40


def entries(batch: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * c) of a batch of vectors, without the shift (which no covariance sees)."""
    values = np.floor(scale * batch.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim))
    if not (np.abs(values) < scale * MOST_ENTRY).all():
        raise ValueError("an entry is too large to be whitened")
    return values.astype(np.int64)


def vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and vector (doubles) of the remaining rows, with their length ``dim``."""
    v = F.col("vector")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).filter("size(vector) > 0")
    return rows.filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))).withColumn("dim", F.size(v))


def exact_sums(values: np.ndarray) -> tuple[list[int], dict[tuple[int, int], int]]:
    """Column sums and the sums of products of columns i <= j, exactly: long columns are cut into limbs."""
    dim = values.shape[1]
    cut, rest = [], values
    while True:
        low = rest & ((1 << LIMB) - 1)
        rest = rest >> LIMB
        if not (rest.any() and (rest + 1).any() and not np.isin(rest, (0, -1)).all()):
            cut.append(low + (rest << LIMB))  # the last limb keeps the sign
            break
        cut.append(low)
    sums = [0] * dim
    products = np.zeros((dim, dim), object)
    for a, left in enumerate(cut):
        for i, s in enumerate(left.sum(0).tolist()):
            sums[i] += s << LIMB * a
        for b, right in enumerate(cut):
            # Limbs are below 2 ** 21 and a chunk has 2 ** 12 rows at most: below 2 ** 53 + 1, exact in doubles.
            products += (left.T.astype(float) @ right.astype(float)).astype(np.int64).astype(object) << LIMB * (a + b)
    return sums, {(i, j): int(products[i, j]) for i in range(dim) for j in range(i, dim)}


def scatter_sums(rows: DataFrame, dim: int, scale: int = SCALE) -> DataFrame:
    """(i, j, value): n at (-1, -1), column sums at (-1, j), sums of products at (i, j), added over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, [0] * dim, {}
        for batch in batches:
            values = entries(batch.column(0), dim, scale)
            n += len(values)
            for first in range(0, len(values), CHUNK):
                sums, part = exact_sums(values[first:first + CHUNK])
                total = [a + b for a, b in zip(total, sums)]
                products = {k: v + products.get(k, 0) for k, v in part.items()}
        if n:
            flat = [(-1, -1, n), *((-1, j, s) for j, s in enumerate(total)), *((i, j, v) for (i, j), v in products.items())]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.int32()), pa.array([f[1] for f in flat], pa.int32()),
                                              pa.array([Decimal(f[2]) for f in flat], pa.decimal128(38, 0))], names=["i", "j", "value"])

    return rows.select("vector").mapInArrow(run, "i int, j int, value decimal(38,0)").groupBy("i", "j").agg(F.sum("value").cast("decimal(38,0)").alias("value"))


# The polynomial

def primes(bits: int) -> list[int]:
    """The largest primes below 2 ** 31 whose product has more than so many bits."""
    def prime(p: int) -> bool:
        odd = (p - 1) // ((p - 1) & (1 - p))
        for base in (2, 3, 5, 7):  # these decide below 3.2e9
            x, power = pow(base, odd, p), odd
            while x not in (1, p - 1) and 2 * power < p - 1:
                x, power = x * x % p, 2 * power
            if x != p - 1 and not (x == 1 and power == odd):
                return False
        return True

    out, p = [], (1 << 31) - 1
    while 30 * len(out) <= bits:
        if prime(p):
            out.append(p)
        p -= 2
    return out


def hessenberg_polynomial(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x I - matrix) modulo p, the leading one first."""
    h, d = matrix.astype(np.int64) % p, len(matrix)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        at = m + int(below[0])
        if at != m:  # swapping rows and the same columns is a similarity
            h[[m, at]] = h[[at, m]]
            h[:, [m, at]] = h[:, [at, m]]
        factor = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - factor[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * factor % p).sum(1)) % p
    minors = np.zeros((d + 1, d + 1), np.int64)  # of leading blocks, the constant coefficient first
    minors[0, 0] = 1
    for k in range(1, d + 1):
        own = np.roll(minors[k - 1], 1) - h[k - 1, k - 1] * minors[k - 1] % p
        chain = 1
        for i in range(1, k):
            chain = chain * int(h[k - i, k - i - 1]) % p
            if not chain:
                break
            own -= int(h[k - i - 1, k - 1]) * chain % p * minors[k - i - 1] % p
        minors[k] = own % p
    return minors[d][::-1].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients of det(x I - matrix) for a positive semidefinite integer matrix, the leading one first."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    moduli = primes(d * (trace // d + 2).bit_length() + 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps = batch.column(0).to_pylist()
            found = [hessenberg_polynomial(np.array([[x % p for x in row] for row in matrix], np.int64), p) for p in ps]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["p", "residues"])

    tasks = -(-len(moduli) // PRIME_ROWS)
    job = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(tasks).mapInArrow(run, "p long, residues array<long>")
    product, out = 1, [0] * (d + 1)
    for p, residues in sorted((r["p"], r["residues"]) for r in job.collect()):  # d + 1 numbers a prime
        inverse = pow(product, -1, p)
        out = [x + product * ((r * (-1) ** k - x) * inverse % p) for k, (x, r) in enumerate(zip(out, residues))]
        product *= p
    return [x * (-1) ** k for k, x in enumerate(out)]


# Roots, as integers over 2 ** bits

def roots_above(polynomial: list[int], at: int, bits: int) -> int:
    """How many roots, multiple ones counted, lie above at / 2 ** bits; right as all roots are real."""
    shifted = [c << bits * k for k, c in enumerate(polynomial)]  # of x * 2 ** bits
    d = len(shifted) - 1
    for k in range(d):
        for i in range(1, d + 1 - k):
            shifted[i] += at * shifted[i - 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def isolated(polynomial: list[int], trace: int, wanted: int, bits: int = BITS) -> list[tuple[int, int, int, int]]:
    """(low, high, scale bits, multiplicity) of the largest positive roots, falling, until ``wanted`` are counted."""
    top = trace.bit_length() + 1
    todo, out, counted = [(0, 1, 0, roots_above(polynomial, 0, 0), 0)], [], 0  # k / 2 ** s of the range (0, 2 ** top]
    while todo and counted < wanted:
        low, high, s, above_low, above_high = todo.pop()
        n = above_low - above_high
        if n == 0:
            continue
        if n == 1 or s >= bits:
            out.append((low, high, s, n))
            counted += n
            continue
        middle = low + high
        above = _above(polynomial, middle, s + 1, top)
        todo.append((2 * low, middle, s + 1, above_low, above))
        todo.append((middle, 2 * high, s + 1, above, above_high))
    return out


def _above(polynomial: list[int], at: int, s: int, top: int) -> int:
    """Roots above at * 2 ** top / 2 ** s."""
    return roots_above(polynomial, at << top - s, 0) if s <= top else roots_above(polynomial, at, s - top)


def _sign(polynomial: list[int], at: int, s: int, top: int) -> int:
    """Sign of the polynomial at at * 2 ** top / 2 ** s."""
    bits = max(s - top, 0)
    at, value = at << max(top - s, 0), 0
    for k, c in enumerate(polynomial):
        value = value * at + (c << bits * k)
    return (value > 0) - (value < 0)


def refined(polynomial: list[int], trace: int, low: int, high: int, s: int, n: int, bits: int) -> tuple[int, int]:
    """The interval's root as (integer, fraction bits): halved until it has ``bits`` bits of the range."""
    top = trace.bit_length() + 1
    if n == 1:
        above = _sign(polynomial, high, s, top)
        if above == 0:
            return (high << top, s)
        while s < bits:
            middle, s = low + high, s + 1
            sign = _sign(polynomial, middle, s, top)
            if sign == 0:
                return (middle << top, s)
            low, high = (2 * low, middle) if sign == above else (middle, 2 * high)
    else:
        above_high = _above(polynomial, high, s, top)
        while s < bits:
            middle, s = low + high, s + 1
            low, high = (middle, 2 * high) if _above(polynomial, middle, s, top) > above_high else (2 * low, middle)
    return ((low + high) << top, s + 1)


# Components

def null_space(matrix: list[list[int]], root: int, fraction: int, n: int, bits: int) -> list[list[float]]:
    """``n`` orthonormal vectors that (matrix - root / 2 ** fraction) takes to zero, by inverse iteration in fixed point."""
    d, one = len(matrix), 1 << bits
    top = max(max(map(abs, row)) for row in matrix).bit_length()
    a = np.array([[(x << bits) >> top for x in row] for row in matrix], object)
    shift = (root << bits) >> (fraction + top)
    a[np.arange(d), np.arange(d)] -= shift
    order = []
    for k in range(d):  # elimination, factors kept below the diagonal
        at = k + int(np.argmax(np.abs(a[k:, k])))
        order.append(at)
        if at != k:
            a[[k, at]] = a[[at, k]]
        if a[k, k] == 0:
            a[k, k] = 1  # the smallest number there is: the shift was a root to all bits
        factor = (a[k + 1:, k] << bits) // a[k, k]
        a[k + 1:, k + 1:] -= (factor[:, None] * a[k, k + 1:]) >> bits
        a[k + 1:, k] = factor

    def unit(v: np.ndarray) -> np.ndarray:
        most = max(abs(int(x)) for x in v)
        v = np.array([(int(x) << bits) // most for x in v], object)
        length = isqrt(sum(int(x) * int(x) for x in v))
        return np.array([(int(x) << bits) // length for x in v], object)

    def solved(v: np.ndarray) -> np.ndarray:
        v = v.copy()
        for k in range(d):
            v[[k, order[k]]] = v[[order[k], k]]
            v[k + 1:] -= (a[k + 1:, k] * v[k]) >> bits
        for k in range(d - 1, -1, -1):
            v[k] = ((v[k] - ((a[k, k + 1:] * v[k + 1:]).sum() >> bits if k + 1 < d else 0)) << bits) // a[k, k]
        return v

    draw = np.random.default_rng(1)
    found = [np.array([int(x * 2 ** 50) << bits - 50 for x in draw.uniform(-1, 1, d)], object) for _ in range(n)]
    for _ in range(3):
        done = []
        for v in found:
            v = unit(solved(unit(v)))
            for u in done + done:  # twice, for the digits that the first pass loses
                v = v - ((u * ((u * v).sum() >> bits)) >> bits)
                v = unit(v)
            done.append(v)
        found = done
    return [[int(x) / one for x in v] for v in found]


def principal_components(spark: SparkSession, matrix: list[list[int]], wanted: int = COMPONENTS, bits: int = BITS) -> list[tuple[int, int, list[float]]]:
    """(eigenvalue as integer, its fraction bits, unit vector) of the largest eigenvalues, falling."""
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    if trace == 0:
        return []
    polynomial = characteristic_polynomial(spark, matrix)
    todo = [(k, str(low), str(high), s, n) for k, (low, high, s, n) in enumerate(isolated(polynomial, trace, wanted, bits))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                root, fraction = refined(polynomial, trace, int(r["low"]), int(r["high"]), r["s"], r["n"], 2 * bits)
                found = null_space(matrix, root, fraction, r["n"], 3 * bits)
                yield pa.RecordBatch.from_pydict({"k": pa.array([r["k"]] * len(found), pa.int32()), "j": pa.array(range(len(found)), pa.int32()), "root": [str(root)] * len(found),
                                                  "fraction": pa.array([fraction] * len(found), pa.int32()), "vector": pa.array(found, pa.list_(pa.float64()))})

    job = spark.createDataFrame(todo, "k int, low string, high string, s int, n int").repartition(len(todo))
    rows = sorted(job.mapInArrow(run, "k int, j int, root string, fraction int, vector array<double>").collect(), key=lambda r: (r["k"], r["j"]))  # a row per component
    return [(int(r["root"]), r["fraction"], r["vector"]) for r in rows[:wanted]]


def whitening(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, component, n, deviation, deviation_exact, whitened, explained and identity_error of every row and component."""
    spark = table.sparkSession
    rows = vectors(table, vector)
    schema = "vec_id long, deviation_exact decimal(38,0), whitened array<double>"
    common = rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    found, n, dim, sums = [], 0, 0, []
    if common:
        dim = common["dim"]
        rows = rows.filter(F.col("dim") == dim)
        sums_of = {(r["i"], r["j"]): int(r["value"]) for r in scatter_sums(rows, dim, scale).collect()}  # d * d numbers
        n, sums = sums_of[-1, -1], [sums_of[-1, j] for j in range(dim)]
        matrix = [[n * sums_of[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(dim)] for i in range(dim)]
        found = principal_components(spark, matrix, components)
    if not found:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, deviation_exact decimal(38,0), whitened double, explained double, identity_error double")
    trace = sum(matrix[i][i] for i in range(dim))
    with localcontext() as context:
        context.prec = 60
        eigenvalues = [Decimal(root) / (1 << fraction) for root, fraction, _ in found]
        # Over n for the mean, over sqrt(eigenvalue) / n for the unit variance: n goes.
        to_unit = np.array([float(1 / e.sqrt()) for e in eigenvalues])
        explained = [float(e / trace) for e in eigenvalues]
    axes = np.array([v for _, _, v in found]).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = entries(batch.column(1), dim, scale)
            small = n * (int(np.abs(values).max(initial=0)) + 1) + max(map(abs, sums)) < 1 << 62
            centred = n * values - np.array(sums) if small else n * values.astype(object) - np.array(sums, object)
            narrow = small and dim * int(np.abs(centred).max(initial=0)) ** 2 < 1 << 63
            deviation = ((centred if narrow else centred.astype(object)) ** 2).sum(1)
            white = (centred.astype(float) @ axes) * to_unit
            with localcontext() as wide:
                wide.prec = 40
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([Decimal(int(x)) for x in deviation], pa.decimal128(38, 0)), pa.array(list(white), pa.list_(pa.float64()))],
                                                 names=["vec_id", "deviation_exact", "whitened"])

    white = written(rows.select("vec_id", "vector").mapInArrow(run, schema), "whitened")
    error = identity_error(white, len(found))
    names = F.array(*[F.lit(x) for x in explained])
    out = white.select("vec_id", "deviation_exact", F.posexplode("whitened").alias("p", "whitened"))
    return out.select("vec_id", (F.col("p") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), F.expr("try_cast(deviation_exact as long)").alias("deviation"),
                      "deviation_exact", "whitened", names[F.col("p")].alias("explained"), F.lit(error).alias("identity_error"))


def identity_error(white: DataFrame, k: int) -> float:
    """Largest absolute entry of the whitened values' covariance minus the identity; their mean is taken off first."""
    means = white.agg(*[F.avg(F.col("whitened")[i]).alias(f"m{i}") for i in range(k)]).first()
    mean = np.array([means[f"m{i}"] for i in range(k)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((k, k))
        for batch in batches:
            own = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k) - mean
            n, total = n + len(own), total + own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.ravel()], pa.list_(pa.float64()))], names=["n", "total"])

    parts = white.select("whitened").mapInArrow(run, "n long, total array<double>")
    summed = parts.select("n", F.posexplode("total").alias("p", "x")).groupBy("p").agg((F.sum("x") / F.sum("n")).alias("x")).collect()  # k * k numbers
    covariance = np.zeros(k * k)
    for r in summed:
        covariance[r["p"]] = r["x"]
    return float(np.abs(covariance.reshape(k, k) - np.eye(k)).max())
