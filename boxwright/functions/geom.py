"""Box geometry as column expressions over ARRAY<DOUBLE> of length 4.

pixel boxes are (xmin, ymin, xmax, ymax); norm1000 boxes are (ymin, xmin, ymax, xmax) in 0..1000. Every function gives null for a
box that is null, has another length, or has a null element. Sizes that aren't positive give null.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fixed value: the diagonal of the norm1000 plane, as truncated in the data's distances.
DIAGONAL = 1414.21356237


def is_box(b: Column) -> Column:
    return F.coalesce((F.size(b) == 4) & F.forall(b, lambda v: v.isNotNull()), F.lit(False))


def clamp(x: Column, lo, hi) -> Column:
    """NaN stays NaN, null stays null."""
    lo, hi = (v if isinstance(v, Column) else F.lit(float(v)) for v in (lo, hi))
    return F.when(x.isNull() | F.isnan(x), x).otherwise(F.least(F.greatest(x, lo), hi))


def _once(x: Column, f) -> Column:
    """f(x) with x computed once, however often f names it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _made(b: Column, *parts: Column) -> Column:
    return F.when(is_box(b), F.array(*parts))


def _four(b: Column) -> tuple[Column, Column, Column, Column]:
    return F.get(b, F.lit(0)), F.get(b, F.lit(1)), F.get(b, F.lit(2)), F.get(b, F.lit(3))


def fix_and_clip(b: Column, width: Column, height: Column) -> Column:
    """Corners in order, clipped to the image."""
    x1, y1, x2, y2 = _four(b)
    w, h = width.cast("double"), height.cast("double")
    return F.when((w > 0) & (h > 0), _made(b, clamp(F.least(x1, x2), 0, w), clamp(F.least(y1, y2), 0, h), clamp(F.greatest(x1, x2), 0, w), clamp(F.greatest(y1, y2), 0, h)))


def area(b: Column) -> Column:
    a, c, d, e = _four(b)
    return F.greatest(d - a, F.lit(0.0)) * F.greatest(e - c, F.lit(0.0))


def area_ratio(b: Column, width: Column, height: Column) -> Column:
    return area(fix_and_clip(b, width, height)) / F.nullif(width.cast("double") * height.cast("double"), F.lit(0.0))


def iou(p: Column, q: Column) -> Column:
    a1, b1, a2, b2 = _four(p)
    c1, d1, c2, d2 = _four(q)
    inter = F.greatest(F.least(a2, c2) - F.greatest(a1, c1), F.lit(0.0)) * F.greatest(F.least(b2, d2) - F.greatest(b1, d1), F.lit(0.0))
    union = area(p) + area(q) - inter
    return F.when(union > 0, inter / F.nullif(union, F.lit(0.0))).otherwise(F.lit(0.0))


def mean_pairwise_iou(boxes: Column) -> Column:
    """Mean over unordered pairs; null for fewer than two boxes."""
    n = F.size(boxes)
    sums = F.transform(boxes, lambda b, i: F.aggregate(F.slice(boxes, i + 2, F.greatest(n - i - 1, F.lit(0))), F.lit(0.0), lambda s, c: s + iou(b, c)))
    return F.when(n >= 2, F.aggregate(sums, F.lit(0.0), lambda s, x: s + x) / (n * (n - 1) / 2))


def pixel_to_norm1000(b: Column, width: Column, height: Column, digits: int = 2) -> Column:
    """Corners in order, clipped, scaled and rounded (ties up)."""
    to = lambda v, size: F.round(clamp(v * 1000.0 / F.nullif(size.cast("double"), F.lit(0.0)), 0, 1000) + 1e-12, digits)

    def scaled(c: Column) -> Column:
        x1, y1, x2, y2 = _four(c)
        return _made(c, to(y1, height), to(x1, width), to(y2, height), to(x2, width))

    return _once(fix_and_clip(b, width, height), scaled)


def norm1000_to_pixel(b: Column, width: Column, height: Column, whole: bool = False) -> Column:
    y1, x1, y2, x2 = _four(b)
    to = lambda v, size: (F.rint if whole else lambda z: z)(v / 1000.0 * size.cast("double"))
    return _made(b, to(x1, width), to(y1, height), to(x2, width), to(y2, height))


def ltwh_to_norm1000(left: Column, top: Column, width: Column, height: Column, digits: int = 2) -> Column:
    """Fractions of the page (left, top, width, height), clamped to 0..1, to norm1000."""
    to = lambda v: F.round(clamp(v, 0, 1) * 1000.0 + 1e-12, digits)
    b = F.array(to(top), to(left), to(top + height), to(left + width))
    return F.when(is_box(b), b)


def poly_to_box(p: Column) -> Column:
    """Eight numbers x1, y1 ... x4, y4 to the pixel box around them."""
    xs, ys = F.filter(p, lambda v, i: i % 2 == 0), F.filter(p, lambda v, i: i % 2 == 1)
    ok = (F.size(p) == 8) & F.forall(p, lambda v: v.isNotNull())
    return F.when(ok, F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)))


def reorder(b: Column) -> Column:
    """(y, x, y, x) to (x, y, x, y) and back."""
    a, c, d, e = _four(b)
    return _made(b, c, a, e, d)


def center_distance(p: Column, q: Column) -> Column:
    """Distance of the centres of two norm1000 boxes over the plane's diagonal."""
    a1, b1, a2, b2 = _four(p)
    c1, d1, c2, d2 = _four(q)
    return F.hypot((a1 + a2 - c1 - c2) / 2, (b1 + b2 - d1 - d2) / 2) / DIAGONAL


def union_box(boxes: Column) -> Column:
    side = lambda i, f: f(F.transform(boxes, lambda b: F.get(b, F.lit(i))))
    return F.when(F.size(boxes) > 0, F.array(side(0, F.array_min), side(1, F.array_min), side(2, F.array_max), side(3, F.array_max)))


def looks_normalised(boxes: Column, width: Column, height: Column) -> Column:
    """Boxes of a large image whose numbers all stay within 1000 are norm1000."""
    top = F.array_max(F.flatten(boxes))
    return F.coalesce(((width > 1200) | (height > 1200)) & (top <= 1000), F.lit(False))


def draw_box(b: Column, width: Column, height: Column) -> Column:
    """norm1000 box to whole pixels inside the image, corners in order."""
    y1, x1, y2, x2 = _four(b)
    x = lambda v: F.rint(clamp(v / 1000.0 * width, 0, width - 1.0))
    y = lambda v: F.rint(clamp(v / 1000.0 * height, 0, height - 1.0))
    return _made(b, x(F.least(x1, x2)), y(F.least(y1, y2)), x(F.greatest(x1, x2)), y(F.greatest(y1, y2)))


def draw_pixel_box(b: Column, width: Column, height: Column, drawn_width: Column | None = None, drawn_height: Column | None = None) -> Column:
    """Pixel box to whole pixels inside the image as it is drawn, rescaled where that has another size; null where nothing is left of it."""
    x1, y1, x2, y2 = _four(b)
    w, h = (width if drawn_width is None else drawn_width).cast("double"), (height if drawn_height is None else drawn_height).cast("double")
    x = lambda v: F.rint(clamp(v * w / width, 0, w - 1.0))
    y = lambda v: F.rint(clamp(v * h / height, 0, h - 1.0))
    made = _made(b, x(F.least(x1, x2)), y(F.least(y1, y2)), x(F.greatest(x1, x2)), y(F.greatest(y1, y2)))
    return _once(made, lambda m: F.when((F.get(m, F.lit(2)) > F.get(m, F.lit(0))) & (F.get(m, F.lit(3)) > F.get(m, F.lit(1))), m))


def norm1_to_pixel(b: Column, width: Column, height: Column) -> Column:
    """(x1, y1, x2, y2) in 0..1 to whole pixels; ties go to the even number."""
    x1, y1, x2, y2 = _four(b)
    w, h = width.cast("double"), height.cast("double")
    return _made(b, F.rint(x1 * w), F.rint(y1 * h), F.rint(x2 * w), F.rint(y2 * h))


def round_box(b: Column, digits: int = 2) -> Column:
    """Half-even on the decimal value of each number."""
    return F.when(is_box(b), F.transform(b, lambda v: F.bround(v, digits)))


def detected_format(b: Column, width: Column, height: Column) -> Column:
    """norm1000 or pixel, of one box."""
    large = F.coalesce((width > 1200) | (height > 1200), F.lit(False)) & width.isNotNull() & height.isNotNull()
    return F.when(large & (F.array_max(b) <= 1000), "norm1000").otherwise("pixel")


def norm1000_out(b: Column, width: Column, height: Column, whole: bool = True) -> Column:
    """norm1000 to a pixel box inside the image."""
    w, h = width.cast("double"), height.cast("double")
    y1, x1, y2, x2 = _four(b)
    to = lambda v, size: (F.rint if whole else lambda z: z)(clamp(v / 1000.0 * size, 0, size))
    return F.when((w > 0) & (h > 0), _made(b, to(x1, w), to(y1, h), to(x2, w), to(y2, h)))
