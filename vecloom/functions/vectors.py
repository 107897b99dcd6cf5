"""Vector expressions: normalization, INT8 quantization, packing, cosine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vecloom.functions.binding import let

# Fixed values of the quantizer and the normalizer.
CLIP = 2.5
LEVELS = 127
EPSILON = 1e-12
SMALLEST_MAX = 1e-7


def _nothing(vector: Column) -> Column:
    return vector.isNull() | (F.size(vector) == 0)


def l2_norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x))


def l2_normalize(vector: Column) -> Column:
    """v / max(norm, 1e-12); null and empty give an empty array."""
    scaled = let(
        F.greatest(l2_norm(vector), F.lit(EPSILON)),
        lambda norm: F.transform(vector, lambda x: (x / norm).cast("float")),
    )
    return F.when(_nothing(vector), F.array().cast("array<float>")).otherwise(scaled)


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda total, x: total + x)
    return dot / (F.greatest(l2_norm(a), F.lit(EPSILON)) * F.greatest(l2_norm(b), F.lit(EPSILON)))


def dynamic_scale(vector: Column, clip: float = CLIP) -> Column:
    """min(max(max|x|, 1e-7), clip) / 127 as a 32-bit float; no cap unless clip > 0."""
    largest = F.greatest(F.array_max(F.transform(vector, F.abs)).cast("double"), F.lit(SMALLEST_MAX))
    if clip > 0:
        largest = F.least(largest, F.lit(clip))
    return (largest / LEVELS).cast("float")


def fixed_scale(clip: float = CLIP) -> Column:
    return F.lit(clip / LEVELS)


def check_mode(mode: str) -> None:
    if mode not in ("dynamic", "fixed"):
        raise ValueError(f"unknown quantizer mode: {mode}")


def scale_factor(vector: Column, mode: str = "dynamic", clip: float = CLIP) -> Column:
    check_mode(mode)
    return dynamic_scale(vector, clip) if mode == "dynamic" else fixed_scale(clip)


def _code(x: Column, scale: Column, mode: str, clip: float) -> Column:
    if mode == "fixed":
        x = F.greatest(F.least(x.cast("double"), F.lit(clip)), F.lit(-clip))
    code = F.rint(x.cast("double") / scale.cast("double"))
    return F.greatest(F.least(code, F.lit(127.0)), F.lit(-128.0)).cast("int")


def quantize(vector: Column, mode: str = "dynamic", clip: float = CLIP) -> Column:
    """INT8 codes as ``array<int>``; ties round to even."""
    codes = let(
        scale_factor(vector, mode, clip),
        lambda scale: F.transform(vector, lambda x: _code(x, scale, mode, clip)),
    )
    return F.when(_nothing(vector), F.array().cast("array<int>")).otherwise(codes)


def _byte_hex(code: Column) -> Column:
    return F.substring(F.hex(code + 256), -2, 2)


def pack_int8(codes: Column) -> Column:
    """Two's complement bytes; null and empty give no bytes."""
    packed = F.unhex(F.array_join(F.transform(codes, _byte_hex), ""))
    return F.when(_nothing(codes), F.lit(b"")).otherwise(packed)


def unpack_int8(packed: Column) -> Column:
    def signed(digits: Column, at: Column) -> Column:
        return F.pmod(F.conv(F.substr(digits, 2 * at - 1, F.lit(2)), 16, 10).cast("int") + 128, F.lit(256)) - 128

    codes = let(F.hex(packed), lambda digits: F.transform(F.sequence(F.lit(1), F.length(packed)), lambda at: signed(digits, at)))
    return F.when(F.length(packed) == 0, F.array().cast("array<int>")).otherwise(codes)


def dequantize(codes: Column, scale: Column) -> Column:
    """q * scale in 32-bit floats (the zero point is always 0)."""
    return let(scale.cast("float"), lambda s: F.transform(codes, lambda q: q.cast("float") * s))
