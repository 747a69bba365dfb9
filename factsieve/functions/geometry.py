"""Boxes on pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap(a: Column, b: Column) -> Column:
    """Area two boxes (x0, y0, x1, y1) share."""
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def area(a: Column) -> Column:
    return F.greatest(a["x1"] - a["x0"], F.lit(0.0)) * F.greatest(a["y1"] - a["y0"], F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where the union is empty."""
    shared = overlap(a, b)
    return F.coalesce(F.try_divide(shared, area(a) + area(b) - shared), F.lit(0.0))


def to_points(box: Column, width: Column, height: Column, rotation: Column) -> Column:
    """Box in thousandths of the displayed page as points of the unrotated page."""
    x0, x1 = box["x0"] / 999, box["x1"] / 999
    y0, y1 = box["y0"] / 999, box["y1"] / 999
    put = lambda a, b, c, d: F.struct(a.alias("x0"), b.alias("y0"), c.alias("x1"), d.alias("y1"))
    turned = F.when(rotation == 90, put(y0 * width, (1 - x1) * height, y1 * width, (1 - x0) * height))
    turned = turned.when(rotation == 180, put((1 - x1) * width, (1 - y1) * height, (1 - x0) * width, (1 - y0) * height))
    turned = turned.when(rotation == 270, put((1 - y1) * width, x0 * height, (1 - y0) * width, x1 * height))
    return turned.otherwise(put(x0 * width, y0 * height, x1 * width, y1 * height))
