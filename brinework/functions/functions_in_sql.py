"""Formulas as functions in SQL: density as an expression, points of a path as a table function."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from brinework.functions.physics import EOS80, RADIUS_SECTION


def _horner(coefficients: tuple[float, ...], x: str) -> str:
    out = f"{coefficients[-1]!r}D"
    for c in reversed(coefficients[:-1]):
        out = f"({out} * {x} + {c!r}D)"
    return out


def eos80_text() -> str:
    """The body of ``eos80(t, s, p)``: in-situ density from degC, PSU and dbar."""
    k = {name: _horner(c, "t") for name, c in EOS80.items()}
    surface = f"{k['rho_w']} + {k['b']} * s + {k['c']} * s * sqrt(s) + {k['d']} * s * s"
    bulk = (
        f"{k['kw']} + {k['f1']} * s + {k['f2']} * s * sqrt(s) + ({k['aw']} + {k['g1']} * s + {k['g2']} * s * sqrt(s)) * (p / 10)"
        f" + ({k['bw']} + {k['h1']} * s) * (p / 10) * (p / 10)"
    )
    return f"({surface}) / (1 - (p / 10) / ({bulk}))"


@udtf(returnType="point int, lon double, lat double")
class PathPoints:
    """Points of a great circle from one place towards another, ``spacing`` metres apart."""

    def eval(self, lon0: float, lat0: float, lon1: float, lat1: float, spacing: float, points: int):
        if None in (lon0, lat0, lon1, lat1, spacing, points):
            return
        a, b, o, d = *map(math.radians, (lat0, lat1, lon0)), math.radians(lon1 - lon0)
        heading = math.atan2(math.cos(b) * math.sin(d), math.cos(a) * math.sin(b) - math.sin(a) * math.cos(b) * math.cos(d))
        for point in range(points):
            s = point * spacing / RADIUS_SECTION
            y = math.asin(math.sin(a) * math.cos(s) + math.cos(a) * math.sin(s) * math.cos(heading))
            x = o + math.atan2(math.sin(heading) * math.sin(s) * math.cos(a), math.cos(s) - math.sin(a) * math.sin(y))
            yield point, math.degrees(x), math.degrees(y)


def register(spark: SparkSession) -> None:
    """Makes ``eos80(t, s, p)`` and ``path_points(lon0, lat0, lon1, lat1, spacing, points)`` known to the session's SQL."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION eos80(t DOUBLE, s DOUBLE, p DOUBLE) RETURNS DOUBLE RETURN {eos80_text()}")
    spark.udtf.register("path_points", PathPoints)
