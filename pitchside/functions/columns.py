"""Column builders. Each returns a ``Column`` built from built-in expressions,
so every operator stays inside whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from ..schema import GROUP_PATTERNS, SCORE_SCALE


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def position_group(position="Position") -> Column:
    """DEF / MID / FWD from the last letter of a position code; NULL when none matches.

    Patterns are anchored at both ends: ``rlike`` searches, while the grouping
    rule matches the whole code.
    """
    p = col(position)
    expr = None
    for label, pattern in GROUP_PATTERNS:
        expr = F.when(p.rlike(pattern), F.lit(label)) if expr is None else expr.when(p.rlike(pattern), F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def total(terms: Sequence[Column]) -> Column:
    """Left-to-right sum, a fixed evaluation order for reproducible scores."""
    return reduce(lambda a, b: a + b, terms)


def weighted_sum(values: Sequence, weights: Sequence) -> Column:
    """sum(v_i * w_i), unrolled into one codegen'd arithmetic expression."""
    return total([col(v) * col(w) for v, w in zip(values, weights, strict=True)])


def reciprocal(c, on_zero: str = "error") -> Column:
    """1/x. ``on_zero="error"`` raises on a zero (ANSI division); ``"null"`` yields NULL."""
    c = col(c).cast("double")
    if on_zero == "error":
        return F.lit(1.0) / c
    if on_zero == "null":
        return F.try_divide(F.lit(1.0), c)
    raise ValueError(f"on_zero must be 'error' or 'null', not {on_zero!r}")


def rounded(c, scale: int = SCORE_SCALE) -> Column:
    return F.round(col(c), scale)


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def norm(values: Sequence) -> Column:
    return F.sqrt(total([col(v) * col(v) for v in values]))


def projection_similarity(candidate: Sequence, target: Sequence, target_norm: Column | None = None) -> Column:
    """|c| * cos(c, t) = dot(c, t) / |t|, the length of c projected on t.

    Evaluated as |c| * dot / (|c| |t|), so a zero candidate gives NULL (0/0)
    rather than 0, and a zero target gives NULL for every candidate.
    """
    dot = weighted_sum(candidate, target)
    c_norm = norm(candidate)
    t_norm = norm(target) if target_norm is None else target_norm
    return c_norm * F.try_divide(dot, c_norm * t_norm)


def improvement(candidate: Sequence, current: Sequence, weights: Sequence) -> Column:
    """sum((c_i - p_i) * w_i): how much a candidate beats the current player."""
    return total([(col(c) - col(p)) * col(w) for c, p, w in zip(candidate, current, weights, strict=True)])
