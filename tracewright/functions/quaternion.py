"""Quaternions (x, y, z, w) and two-arm vectors as arrays, without Python in the plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-8
#: Values of one arm: position, quaternion, jaw.
ARM = 8


def _at(q: Column, i: int) -> Column:
    return F.get(q, F.lit(i)).cast("double")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(q: Column) -> Column:
    return F.sqrt(dot(q, q))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalize(q: Column, eps: float = EPSILON) -> Column:
    """q / |q|, or the identity where |q| is below ``eps``."""
    identity = F.array(*[F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)])
    return let(q, lambda v: let(norm(v), lambda n: F.when(n < eps, identity).otherwise(F.transform(v, lambda x: x.cast("double") / n))))


def inverse(q: Column) -> Column:
    return let(normalize(q), lambda u: F.array(-_at(u, 0), -_at(u, 1), -_at(u, 2), _at(u, 3)))


def multiply(a: Column, b: Column) -> Column:
    """Hamilton product."""
    return let(a, lambda p: let(b, lambda q: _product(p, q)))


def _product(a: Column, b: Column) -> Column:
    (x1, y1, z1, w1), (x2, y2, z2, w2) = ([_at(q, i) for i in range(4)] for q in (a, b))
    return F.array(
        w1 * x2 + x1 * w2 + y1 * z2 - z1 * y2,
        w1 * y2 - x1 * z2 + y1 * w2 + z1 * x2,
        w1 * z2 + x1 * y2 - y1 * x2 + z1 * w2,
        w1 * w2 - x1 * x2 - y1 * y2 - z1 * z2,
    )


def continued(previous: Column, current: Column) -> Column:
    """``current``, negated where its dot product with ``previous`` is below zero."""
    return F.when(dot(previous, current) < 0, F.transform(current, lambda x: -x.cast("double"))).otherwise(F.transform(current, lambda x: x.cast("double")))


def position(v: Column, arm: int) -> Column:
    return F.slice(v, ARM * arm + 1, 3)


def orientation(v: Column, arm: int) -> Column:
    return F.slice(v, ARM * arm + 4, 4)


def jaw(v: Column, arm: int) -> Column:
    return _at(v, ARM * arm + 7)


def hybrid_relative(now: Column, later: Column) -> Column:
    """Per arm: change of position, rotation from now to later, and the jaw of now (absolute)."""
    parts = []
    for arm in (0, 1):
        parts.append(F.zip_with(position(later, arm), position(now, arm), lambda a, b: a.cast("double") - b.cast("double")))
        turn = lambda q, r: normalize(multiply(inverse(q), continued(q, r)))
        ends = F.array(normalize(orientation(now, arm)), normalize(orientation(later, arm)))
        parts.append(let(ends, lambda e: turn(F.get(e, F.lit(0)), F.get(e, F.lit(1)))))
        parts.append(F.array(jaw(now, arm)))
    return F.concat(*parts)
