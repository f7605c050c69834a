"""Colour spaces and value remaps on byte and unit channels."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RGB = tuple[Column, Column, Column]

# Weights of the luminance and chrominance channels of JPEG files.
Y_WEIGHTS = (0.299, 0.587, 0.114)
CB_WEIGHTS = (-0.168736, -0.331264, 0.5)
CR_WEIGHTS = (0.5, -0.418688, -0.081312)
BACK = (1.402, -0.344136, -0.714136, 1.772)


def grey(rgb: RGB, weights: tuple[float, float, float] = (1 / 3, 1 / 3, 1 / 3)) -> Column:
    """Weighted sum of the channels."""
    return sum((F.lit(w) * c for w, c in zip(weights, rgb, strict=True)), F.lit(0.0))


def rgb_to_hsv(rgb: RGB) -> RGB:
    """Hue in degrees, saturation and value in 0..1, from bytes; a grey has hue 0."""
    r, g, b = rgb
    high, low = F.greatest(*rgb), F.least(*rgb)
    d = (high - low).cast("double")
    safe = F.when(d == 0, 1.0).otherwise(d)
    hue = F.when(d == 0, 0.0).when(high == r, F.pmod((g - b) / safe, F.lit(6.0))).when(high == g, (b - r) / safe + 2).otherwise((r - g) / safe + 4)
    return hue * 60, F.when(high == 0, 0.0).otherwise(d / F.when(high == 0, 1).otherwise(high)), high / 255


def hsv_to_rgb(hsv: RGB) -> RGB:
    """Bytes, not rounded."""
    h, s, v = hsv

    def channel(n: int) -> Column:
        k = F.pmod(F.lit(float(n)) + h / 60, F.lit(6.0))
        return 255 * (v - v * s * F.greatest(F.lit(0.0), F.least(k, 4 - k, F.lit(1.0))))

    return channel(5), channel(3), channel(1)


def rgb_to_hsi(rgb: RGB) -> RGB:
    """Hue in degrees, saturation in 0..1 and intensity in bytes."""
    r, g, b = (c.cast("double") for c in rgb)
    total = r + g + b
    across = F.sqrt((r - g) * (r - g) + (r - b) * (g - b))
    angle = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ((r - g) + (r - b)) / 2 / F.when(across == 0, 1.0).otherwise(across)))))
    hue = F.when(across == 0, 0.0).when(b > g, 360 - angle).otherwise(angle)
    return hue, F.when(total == 0, 0.0).otherwise(1 - 3 * F.least(r, g, b) / F.when(total == 0, 1.0).otherwise(total)), total / 3


def hsi_to_rgb(hsi: RGB) -> RGB:
    """Bytes, not rounded: the least channel, the leading one of the hue's third, and what is left of the sum."""
    h, s, i = hsi
    third = F.least(F.lit(2), F.floor(h / 120)).cast("int")
    t = F.radians(h - third * 120)
    low = i * (1 - s)
    lead = i * (1 + s * F.cos(t) / F.cos(F.lit(math.pi / 3) - t))
    rest = 3 * i - low - lead
    at = lambda *order: F.when(third == 0, order[0]).when(third == 1, order[1]).otherwise(order[2])
    return at(lead, low, rest), at(rest, lead, low), at(low, rest, lead)


def rgb_to_ycbcr(rgb: RGB) -> RGB:
    return grey(rgb, Y_WEIGHTS), 128 + grey(rgb, CB_WEIGHTS), 128 + grey(rgb, CR_WEIGHTS)


def ycbcr_to_rgb(ycc: RGB) -> RGB:
    y, cb, cr = ycc[0], ycc[1] - 128, ycc[2] - 128
    return y + BACK[0] * cr, y + BACK[1] * cb + BACK[2] * cr, y + BACK[3] * cb


def gamma(value: Column, g: float, high: float = 255.0) -> Column:
    return F.lit(high) * F.pow(F.greatest(F.lit(0.0), value / F.lit(high)), F.lit(g))


def shifted(value: Column, low: float, high: float, to_low: float, to_high: float) -> Column:
    """From one range to another, linearly."""
    return F.lit(to_low) + (value - F.lit(low)) * F.lit((to_high - to_low) / (high - low))


def clipped(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def null_flipped(value: Column, null: float, least: float) -> Column:
    """A cell that holds the null value by chance takes the least valid one."""
    return F.when(value == null, F.lit(least)).otherwise(value)


def nearest_index(rgb: RGB, table: list[tuple[int, int, int]]) -> Column:
    """Place of the table's nearest colour, the first of equally near ones."""
    d = [sum(((c - w) * (c - w) for c, w in zip(rgb, entry, strict=True)), F.lit(0)) for entry in table]
    return F.array_min(F.array(*[F.struct(x.cast("long").alias("d"), F.lit(k).alias("k")) for k, x in enumerate(d)]))["k"]


def to_luminance(value: Column, gain: float, bias: float) -> Column:
    return value / F.lit(gain) + F.lit(bias)


def from_luminance(value: Column, gain: float, bias: float) -> Column:
    return (value - F.lit(bias)) * F.lit(gain)
