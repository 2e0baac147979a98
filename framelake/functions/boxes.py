"""Box geometry as column arithmetic; a box is a 4-tuple of columns."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "", names: tuple[str, ...] = ("x1", "y1", "x2", "y2")) -> Box:
    return tuple(F.col(prefix + n) for n in names)


def center_to_corner(b: Box) -> Box:
    cx, cy, w, h = b
    return cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2


def corner_to_center(b: Box) -> Box:
    x1, y1, x2, y2 = b
    return (x1 + x2) / 2, (y1 + y2) / 2, x2 - x1, y2 - y1


def box_to_z(b: Box) -> Box:
    """Corner box as centre, area and aspect ratio."""
    x1, y1, x2, y2 = b
    w, h = x2 - x1, y2 - y1
    return x1 + w / 2, y1 + h / 2, w * h, F.try_divide(w, h)


def z_to_box(z: Box) -> Box:
    """Centre, area and aspect ratio as a corner box."""
    x, y, s, r = z
    w = F.sqrt(s * r)
    return center_to_corner((x, y, w, F.try_divide(s, w)))


def iou(a: Box, b: Box, mode: str = "plain") -> Column:
    """Intersection over union.

    plain: null when both boxes are empty; pixel: corners are pixels, so one is added to each side;
    eps: the union is at least the machine epsilon.
    """
    edge = 1.0 if mode == "pixel" else 0.0

    def area(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
        return (x2 - x1 + edge) * (y2 - y1 + edge)

    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]) + edge, F.lit(0.0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]) + edge, F.lit(0.0))
    inter = w * h
    union = area(*a) + area(*b) - inter
    if mode == "pixel":
        return inter / (union + F.lit(1e-16))
    if mode == "eps":
        return inter / F.greatest(union, F.lit(sys.float_info.epsilon))
    if mode == "plain":
        return F.try_divide(inter, union)
    raise ValueError(f"unknown IoU mode {mode}")


def letterbox(width: Column, height: Column, size: int = 416) -> dict[str, Column]:
    """Resize ratio, resized sides and padding per side for a square model input."""
    ratio = F.least(F.lit(float(size)) / width, F.lit(float(size)) / height)
    w, h = F.bround(width * ratio, 0).cast("int"), F.bround(height * ratio, 0).cast("int")
    half = lambda d: F.greatest((d / 2).cast("int"), F.lit(0))
    return {"ratio": ratio, "resized_w": w, "resized_h": h, "pad_x": half(h - w), "pad_y": half(w - h)}


def unletterbox(b: Box, width: Column, height: Column, size: int = 416) -> dict[str, Column]:
    """Model-space corner box back to image pixels, as left, top, width and height."""
    x1, y1, x2, y2 = b
    scale = F.lit(float(size)) / F.greatest(width, height)
    pad_x = F.greatest(height - width, F.lit(0)) * scale
    pad_y = F.greatest(width - height, F.lit(0)) * scale
    unpad_w, unpad_h = F.lit(float(size)) - pad_x, F.lit(float(size)) - pad_y
    return {
        "px": ((x1 - F.floor(pad_x / 2)) / unpad_w * width).cast("int"),
        "py": ((y1 - F.floor(pad_y / 2)) / unpad_h * height).cast("int"),
        "pw": ((x2 - x1) / unpad_w * width).cast("int"),
        "ph": ((y2 - y1) / unpad_h * height).cast("int"),
    }


def pad_adjust_label(b: Box, width: Column, height: Column) -> dict[str, Column]:
    """Normalised centre box of an image as a normalised box of the image padded to a square."""
    cx, cy, w, h = b
    side = F.greatest(width, height)
    gap = F.abs(height - width)
    before = F.floor(gap / 2)
    left = F.when(height > width, before).otherwise(F.lit(0))
    top = F.when(width > height, before).otherwise(F.lit(0))
    return {"cx": (cx * width + left) / side, "cy": (cy * height + top) / side,
            "w": w * width / side, "h": h * height / side}
