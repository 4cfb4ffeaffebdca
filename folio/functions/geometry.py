"""Bounding-box arithmetic as column expressions. Boxes are ``array<double>[4]``
(x1, y1, x2, y2) or four scalar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bbox_center(bbox) -> Column:
    """Midpoint ``struct(x, y)`` of a box array."""
    b = _col(bbox)
    return F.struct(((b[0] + b[2]) / 2).alias("x"), ((b[1] + b[3]) / 2).alias("y"))


def iou(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2) -> Column:
    """Intersection over union of two boxes given as scalar columns (0 when disjoint)."""
    iw = F.greatest(F.least(ax2, bx2) - F.greatest(ax1, bx1), F.lit(0.0))
    ih = F.greatest(F.least(ay2, by2) - F.greatest(ay1, by1), F.lit(0.0))
    inter = iw * ih
    union = (ax2 - ax1) * (ay2 - ay1) + (bx2 - bx1) * (by2 - by1) - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def reverse_transform_bbox(bbox, offset_x, offset_y, width: int = 1024, height: int = 1280) -> Column:
    """Undo padding by (offset_x, offset_y) pixels: ``int((v - off) / ((W - 2 off) / W))``
    per coordinate (truncating towards zero like Python ``int``)."""
    b = _col(bbox)
    ox = offset_x if isinstance(offset_x, Column) else F.lit(offset_x)
    oy = offset_y if isinstance(offset_y, Column) else F.lit(offset_y)
    sx = (F.lit(width) - 2 * ox) / F.lit(width)
    sy = (F.lit(height) - 2 * oy) / F.lit(height)
    return F.array(((b[0] - ox) / sx).cast("long"), ((b[1] - oy) / sy).cast("long"),
                   ((b[2] - ox) / sx).cast("long"), ((b[3] - oy) / sy).cast("long"))


def clip_bbox(bbox, img_w, img_h, min_w: float = 1, min_h: float = 1) -> Column:
    """Integer crop window: floor the start, ceil the end, clamp to the image; null when
    the clamped window is smaller than ``min_w`` x ``min_h``."""
    b = _col(bbox)
    w = img_w if isinstance(img_w, Column) else F.lit(img_w)
    h = img_h if isinstance(img_h, Column) else F.lit(img_h)
    x1 = F.greatest(F.floor(b[0]), F.lit(0))
    y1 = F.greatest(F.floor(b[1]), F.lit(0))
    x2 = F.least(F.ceil(b[2]), w.cast("long"))
    y2 = F.least(F.ceil(b[3]), h.cast("long"))
    ok = ((x2 - x1) >= F.lit(min_w)) & ((y2 - y1) >= F.lit(min_h))
    return F.when(ok, F.array(x1, y1, x2, y2))
