"""128-bit linear congruential generator, vectorised with numpy.

x' = a*x + c mod 2^128, state 0 at the start; record n uses the state after
n + 1 steps.  There is no 128-bit type in Spark, so the arithmetic lives here,
inside Arrow batches, as four 32-bit limbs held in uint64 arrays (least
significant limb first).  Every 64-bit partial product is split into 32-bit
halves before it is added, so no column sum can overflow uint64.

This module is a per-batch helper for the generator job; it never sees more
than one Arrow batch at a time.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# --- fixed values: generator coefficients -------------------------------------
LCG_A = 0x2360ED051FC65DA44385DF649FCCF645
LCG_C = 0x4A696D47726179524950202020202001
# -----------------------------------------------------------------------------

MASK128 = (1 << 128) - 1
_M32 = np.uint64(0xFFFFFFFF)
_S32 = np.uint64(32)


def compose(f, g):
    """Coefficients of f(g(x)) for affine maps given as (a, c) Python ints."""
    fa, fc = f
    ga, gc = g
    return (fa * ga) & MASK128, (fa * gc + fc) & MASK128


@lru_cache(maxsize=None)
def power_coefficients() -> tuple:
    """(a, c) of f^(2^i) for i = 0..127, by repeated squaring."""
    out = [(LCG_A, LCG_C)]
    for _ in range(127):
        out.append(compose(out[-1], out[-1]))
    return tuple(out)


def skip_ahead(steps: int) -> int:
    """State after ``steps`` steps from 0, as a Python int."""
    x = 0
    for i, (a, c) in enumerate(power_coefficients()):
        if steps >> i == 0:
            break
        if (steps >> i) & 1:
            x = (a * x + c) & MASK128
    return x


def state_for_row(n: int) -> int:
    """State used by record ``n``."""
    return skip_ahead(n + 1)


def to_limbs(x: int):
    """Python int -> four np.uint64 scalars holding 32-bit limbs."""
    return [np.uint64((x >> (32 * i)) & 0xFFFFFFFF) for i in range(4)]


def limbs_to_int(limbs, i: int) -> int:
    return sum(int(limbs[k][i]) << (32 * k) for k in range(4))


def mul_add(a, x, c):
    """a*x + c mod 2^128 on limb lists (each limb an array or a scalar)."""
    cols = [np.uint64(0)] * 4
    for i in range(4):
        for j in range(4 - i):
            p = a[i] * x[j]
            k = i + j
            cols[k] = cols[k] + (p & _M32)
            if k < 3:
                cols[k + 1] = cols[k + 1] + (p >> _S32)
    out = []
    carry = np.uint64(0)
    for k in range(4):
        t = cols[k] + c[k] + carry
        out.append(t & _M32)
        carry = t >> _S32
    return out


def states_for_rows(rows: np.ndarray):
    """States for arbitrary row numbers (vectorised skip-ahead, one pass per bit)."""
    steps = rows.astype(np.uint64) + np.uint64(1)
    n = len(steps)
    x = [np.zeros(n, dtype=np.uint64) for _ in range(4)]
    if n == 0:
        return x
    top = int(steps.max()).bit_length()
    coeffs = power_coefficients()
    for b in range(top):
        bit = ((steps >> np.uint64(b)) & np.uint64(1)).astype(bool)
        if not bit.any():
            continue
        a, c = coeffs[b]
        y = mul_add(to_limbs(a), x, to_limbs(c))
        for k in range(4):
            x[k] = np.where(bit, y[k], x[k])
    return x


@lru_cache(maxsize=8)
def _run_table(length: int):
    """Limb arrays (A_k, C_k) of f^k for k = 0..length-1, built by doubling."""
    a = [np.zeros(1, dtype=np.uint64) for _ in range(4)]
    c = [np.zeros(1, dtype=np.uint64) for _ in range(4)]
    a[0][0] = 1  # f^0 is the identity
    m = 1
    coeffs = power_coefficients()
    b = 0
    while m < length:
        fa, fc = coeffs[b]  # f^m with m = 2^b
        na = mul_add(to_limbs(fa), a, [np.uint64(0)] * 4)
        nc = mul_add(to_limbs(fa), c, to_limbs(fc))
        a = [np.concatenate([a[k], na[k]]) for k in range(4)]
        c = [np.concatenate([c[k], nc[k]]) for k in range(4)]
        m *= 2
        b += 1
    return [v[:length] for v in a], [v[:length] for v in c]


def states_for_run(first_row: int, length: int):
    """States for the consecutive rows first_row .. first_row+length-1.

    One scalar skip-ahead, then x[k] = A_k * x[0] + C_k from a cached table.
    """
    x0 = to_limbs(state_for_row(first_row))
    size = 1 << max(0, (length - 1).bit_length())
    ta, tc = _run_table(size)
    ta = [v[:length] for v in ta]
    tc = [v[:length] for v in tc]
    return mul_add(ta, x0, tc)


def states(rows: np.ndarray):
    """States for a batch of row numbers; fast path when they are consecutive."""
    n = len(rows)
    if n > 1 and int(rows[-1]) - int(rows[0]) == n - 1 and bool(np.all(np.diff(rows) == 1)):
        return states_for_run(int(rows[0]), n)
    return states_for_rows(rows)
