"""Column expressions for tile keys, affine maps and boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tilewright.model import TILE_SIZE_PX

COORD = r"(\d{4}-\d{4})"
YEAR = r"_(\d{4})_"


def coord_of(text: Column) -> Column:
    """The first tile coordinate in a name or URL, null if there is none."""
    return F.nullif(F.regexp_extract(text, COORD, 1), F.lit(""))


def year_of(text: Column) -> Column:
    """The year in an item's name, 0 if there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(text, YEAR, 1), F.lit("")).cast("int"), F.lit(0))


def x_km(coord: Column) -> Column:
    return F.substring(coord, 1, 4).cast("int")


def y_km(coord: Column) -> Column:
    return F.substring(coord, 6, 4).cast("int")


def coord_from(x: Column, y: Column) -> Column:
    return F.concat_ws("-", x.cast("string"), y.cast("string"))


def tile_id(coord: Column) -> Column:
    return F.translate(coord, "-", "_")


def patch_id(tile: Column, row: Column, col: Column) -> Column:
    return F.concat_ws("_", tile, row.cast("string"), col.cast("string"))


def to_map(cx: Column, cy: Column, w: Column, h: Column, a: Column, c: Column, e: Column, f: Column, size: int = TILE_SIZE_PX) -> list[Column]:
    """Map coordinates and ground size of a box that is given in shares of a
    patch; w and h in pixels."""
    return [
        (c + a * (cx * size)).alias("easting"),
        (f + e * (cy * size)).alias("northing"),
        F.abs(w * a).cast("float").alias("bbox_w_m"),
        F.abs(h * e).cast("float").alias("bbox_h_m"),
    ]


def box_around(x: Column, y: Column, w: Column, h: Column) -> list[Column]:
    """xmin, ymin, xmax, ymax; widths are widened to doubles before they are halved."""
    w, h = w.cast("double") / 2, h.cast("double") / 2
    return [(x - w).alias("xmin"), (y - h).alias("ymin"), (x + w).alias("xmax"), (y + h).alias("ymax")]


def overlaps(a: str, b: str) -> Column:
    """Whether the boxes of two aliased relations overlap; touching edges do not."""
    c = F.col
    return (c(f"{a}.xmax") > c(f"{b}.xmin")) & (c(f"{b}.xmax") > c(f"{a}.xmin")) & (c(f"{a}.ymax") > c(f"{b}.ymin")) & (c(f"{b}.ymax") > c(f"{a}.ymin"))


def iou(a: str, b: str) -> Column:
    """Intersection over union of the boxes of two aliased relations."""
    c = F.col
    zero = F.lit(0.0)
    w = F.greatest(zero, F.least(c(f"{a}.xmax"), c(f"{b}.xmax")) - F.greatest(c(f"{a}.xmin"), c(f"{b}.xmin")))
    h = F.greatest(zero, F.least(c(f"{a}.ymax"), c(f"{b}.ymax")) - F.greatest(c(f"{a}.ymin"), c(f"{b}.ymin")))
    area = sum((c(f"{t}.xmax") - c(f"{t}.xmin")) * (c(f"{t}.ymax") - c(f"{t}.ymin")) for t in (a, b))
    return F.try_divide(w * h, area - w * h)


def to_xywh(x1: Column, y1: Column, x2: Column, y2: Column, size: float) -> list[Column]:
    """Corner pixels to centre and extent in shares of the image."""
    return [((x1 + x2) / 2 / size).alias("cx"), ((y1 + y2) / 2 / size).alias("cy"), ((x2 - x1) / size).alias("w"), ((y2 - y1) / size).alias("h")]


def to_xyxy(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> list[Column]:
    return [((cx - w / 2) * width).alias("x1"), ((cy - h / 2) * height).alias("y1"), ((cx + w / 2) * width).alias("x2"), ((cy + h / 2) * height).alias("y2")]


def box_wkb(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """A closed rectangle as well-known binary (big-endian), counter-clockwise
    from the lower right corner."""

    def double(x: Column) -> Column:
        # 64 bits of a double are the 16 hex digits of its long form
        return F.lpad(F.hex(_bits(x)), 16, "0")

    ring = [(xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin), (xmax, ymin)]
    return F.unhex(F.concat(F.lit("00" + "00000003" + "00000001" + "00000005"), *[double(v) for p in ring for v in p]))


def _bits(x: Column) -> Column:
    """The IEEE bits of a finite double, from its exponent and mantissa."""
    size = F.abs(x)
    guess = F.floor(F.log2(size)).cast("int")
    exponent = F.when(size >= F.pow(F.lit(2.0), guess + 1), guess + 1).when(size < F.pow(F.lit(2.0), guess), guess - 1).otherwise(guess)
    mantissa = ((size / F.pow(F.lit(2.0), exponent) - 1) * F.lit(float(2**52))).cast("long")
    sign = F.when(x < 0, F.lit(-(2**63))).otherwise(F.lit(0))
    return F.when(x == 0, F.lit(0)).otherwise(sign.bitwiseOR(F.shiftleft((exponent + 1023).cast("long"), 52)).bitwiseOR(mantissa)).cast("long")
