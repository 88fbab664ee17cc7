"""Exact exponentially weighted mean (pandas ``ewm(adjust=False)``,
``ignore_na=False``) as pure DataFrame window expressions — no Python UDF.

Recurrence over the rows of one series (nulls included):

    y_t = a_t * y_{t-1} + b_t * x_t

* null row:          a = 1, b = 0            (value carried, weight decays)
* first observation: a = 1, b = 1, y_{prev}=0 (seeded with x)
* later observation with g = distance in rows to the previous observation,
  d = (1-alpha)^g:   a = d / (d + alpha), b = alpha / (d + alpha)

Closed form inside a block of ``EWM_BLOCK`` rows with running products
A_t = prod a_j (computed as exp(sum ln a)):  y_t = A_t * (carry + S_t),
S_t = sum_i b_i x_i / A_i.  Blocks keep A away from underflow.  The carry
into block k folds the (A_end, B_end) pairs of all earlier blocks with the
higher-order ``aggregate`` function over a ``collect_list`` window — the list
has one entry per 256 rows, never the rows themselves.

All windows use the ordering (key, blk, rn), so they run on one sort.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwise.operators.windows import EWM_BLOCK

# d below this is weightless next to alpha in double precision; clamping it
# bounds -ln(a) so block products cannot underflow
_D_FLOOR = 1e-20


@dataclass(frozen=True)
class EwmSpec:
    """``dense_from`` names a column holding the first row index where ``x``
    is observed, for inputs that by construction have no NULL after it.
    Their block log-product then has a closed form and needs no window.
    ``prev`` names a column holding the row index of the last observation
    before each row, where the caller has it from a window of its own."""
    out: str
    x: str
    alpha: float
    dense_from: str | None = None
    prev: str | None = None


def span_alpha(span: float) -> float:
    return 2.0 / (span + 1.0)


def com_alpha(com: float) -> float:
    return 1.0 / (1.0 + com)


def ewm(df: DataFrame, specs: list[EwmSpec], key: str = "symbol", rn: str = "rn",
        blk: str = "blk", block: int = EWM_BLOCK) -> DataFrame:
    """Add one EWM column per spec.  ``df`` needs ``key``, a consecutive
    1-based ``rn`` per key and ``blk = (rn - 1) div block``."""
    if not specs:
        return df
    w_prev = Window.partitionBy(key).orderBy(blk, rn).rowsBetween(Window.unboundedPreceding, -1)
    w_blk = Window.partitionBy(key, blk).orderBy(rn).rowsBetween(Window.unboundedPreceding, 0)
    base_cols = df.columns
    tmp = []

    general = [i for i, s in enumerate(specs) if s.dense_from is None]

    # level 1: last observed row index before this row (general inputs only)
    prev_of = {specs[i].x: specs[i].prev for i in general if specs[i].prev}
    missing = {}
    for i in general:
        x = specs[i].x
        if x not in prev_of:
            p = f"__ewm_prev_{len(missing)}"
            prev_of[x] = missing[x] = p
            tmp.append(p)
    if missing:
        df = df.select("*", *[
            F.last(F.when(F.col(x).isNotNull(), F.col(rn)), ignorenulls=True).over(w_prev).alias(p)
            for x, p in missing.items()])

    # level 2 (plain projection): coefficients and log-coefficients
    proj = []
    for i, s in enumerate(specs):
        x = F.col(s.x).cast("double")
        if s.dense_from is not None:
            first = F.col(s.dense_from)
            # a = 1 up to the seed row, 1 - alpha after it: closed-form block log-product
            start = F.greatest(F.col(blk) * block + 1, first + 1)
            k = F.greatest(F.col(rn) - start + 1, F.lit(0)).cast("double")
            bx = (F.when(F.col(rn) < first, F.lit(0.0)).when(F.col(rn) == first, x)
                   .otherwise(F.lit(s.alpha) * x))
            proj += [k.alias(f"__ewm_k_{i}"), bx.alias(f"__ewm_bx_{i}")]
            tmp += [f"__ewm_k_{i}", f"__ewm_bx_{i}"]
            continue
        prev = F.col(prev_of[s.x])
        d = F.greatest(F.pow(F.lit(1.0 - s.alpha), (F.col(rn) - prev).cast("double")), F.lit(_D_FLOOR))
        obs_later = x.isNotNull() & prev.isNotNull()
        la = F.when(obs_later, F.log(d / (d + F.lit(s.alpha)))).otherwise(F.lit(0.0))
        bx = (F.when(obs_later, F.lit(s.alpha) / (d + F.lit(s.alpha)) * x)
               .when(x.isNotNull(), x).otherwise(F.lit(0.0)))
        proj += [la.alias(f"__ewm_la_{i}"), bx.alias(f"__ewm_bx_{i}")]
        tmp += [f"__ewm_la_{i}", f"__ewm_bx_{i}"]
    df = df.select("*", *proj)

    # level 3: running log-product inside the block (general inputs only)
    if general:
        df = df.select("*", *[F.sum(f"__ewm_la_{i}").over(w_blk).alias(f"__ewm_cum_{i}") for i in general])
        tmp += [f"__ewm_cum_{i}" for i in general]

    def prod(i, inverse=False):
        """Block product A_t (or 1/A_t).  Dense inputs: (1-alpha)^k by pow,
        ~1 ulp; general inputs: exp of the running log-product."""
        sp = specs[i]
        if sp.dense_from is not None:
            k = F.col(f"__ewm_k_{i}")
            return F.pow(F.lit(1.0 - sp.alpha), -k if inverse else k)
        c = F.col(f"__ewm_cum_{i}")
        return F.exp(-c if inverse else c)

    # level 4: running rebased sum inside the block
    df = df.select("*", *[F.sum(F.col(f"__ewm_bx_{i}") * prod(i, inverse=True))
                          .over(w_blk).alias(f"__ewm_sum_{i}") for i in range(len(specs))])
    tmp += [f"__ewm_sum_{i}" for i in range(len(specs))]

    # level 5: fold earlier block ends into a carry, then the value
    is_end = (F.col(rn) % block) == 0
    carries = []
    for i in range(len(specs)):
        A, S = prod(i), F.col(f"__ewm_sum_{i}")
        ends = F.collect_list(F.when(is_end, F.struct(A.alias("a"), (A * S).alias("b")))).over(w_prev)
        carries.append(F.aggregate(ends, F.lit(0.0), lambda acc, e: e["a"] * acc + e["b"])
                       .alias(f"__ewm_carry_{i}"))
    df = df.select("*", *carries)
    tmp += [f"__ewm_carry_{i}" for i in range(len(specs))]

    outs = []
    for i, s in enumerate(specs):
        A = prod(i)
        y = A * (F.col(f"__ewm_carry_{i}") + F.col(f"__ewm_sum_{i}"))
        if s.dense_from is not None:
            seen = F.col(rn) >= F.col(s.dense_from)
        else:
            seen = F.col(s.x).isNotNull() | F.col(prev_of[s.x]).isNotNull()
        outs.append(F.when(seen, y).alias(s.out))
    return df.select(*[c for c in base_cols if c not in {s.out for s in specs}], *outs)
