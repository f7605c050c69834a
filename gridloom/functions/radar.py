"""Polarimetric matrices and decompositions, as arithmetic on complex columns (re, im)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Complex = tuple[Column, Column]


def times_conjugate(a: Complex, b: Complex) -> Complex:
    """a times the conjugate of b."""
    return a[0] * b[0] + a[1] * b[1], a[1] * b[0] - a[0] * b[1]


def hermitian(k: list[Complex]) -> dict[str, Column]:
    """The upper half of k k*: ``m11`` .. ``m33`` real, ``m12r``, ``m12i`` and so on."""
    out = {}
    for i in range(len(k)):
        for j in range(i, len(k)):
            re, im = times_conjugate(k[i], k[j])
            if i == j:
                out[f"m{i + 1}{i + 1}"] = re
            else:
                out[f"m{i + 1}{j + 1}r"], out[f"m{i + 1}{j + 1}i"] = re, im
    return out


def covariance(hh: Complex, hv: Complex, vv: Complex) -> dict[str, Column]:
    """Covariance matrix of a reciprocal scatterer, from the vector (hh, sqrt(2) hv, vv)."""
    root = F.lit(2.0**0.5)
    return hermitian([hh, (root * hv[0], root * hv[1]), vv])


def coherency(hh: Complex, hv: Complex, vv: Complex) -> dict[str, Column]:
    """Coherency matrix, from the vector (hh + vv, hh - vv, 2 hv) over the root of two."""
    half = F.lit(0.5**0.5)
    return hermitian([(half * (hh[0] + vv[0]), half * (hh[1] + vv[1])), (half * (hh[0] - vv[0]), half * (hh[1] - vv[1])), (half * 2 * hv[0], half * 2 * hv[1])])


def huynen(t: dict[str, Column]) -> dict[str, Column]:
    """The nine parameters of a coherency matrix."""
    return {"a0": t["m11"] / 2, "b0": (t["m22"] + t["m33"]) / 2, "b": (t["m22"] - t["m33"]) / 2, "c": t["m12r"], "d": -t["m12i"], "h": t["m13r"], "g": t["m13i"], "e": t["m23r"], "f": t["m23i"]}


def barnes(t: dict[str, Column]) -> list[Complex]:
    """First target vector of the Barnes decomposition: the first row of the coherency matrix over the root of its first element."""
    root = F.sqrt(F.when(t["m11"] > 0, t["m11"]))
    return [(root, F.lit(0.0)), (t["m12r"] / root, -t["m12i"] / root), (t["m13r"] / root, -t["m13i"] / root)]


def entropy_alpha_anisotropy(t: dict[str, Column]) -> Column:
    """Entropy, mean alpha angle in degrees and anisotropy of coherency matrices, from their eigenvalues; Arrow batches."""
    names = ("m11", "m22", "m33", "m12r", "m12i", "m13r", "m13i", "m23r", "m23i")

    @F.pandas_udf("struct<entropy: double, alpha: double, anisotropy: double>")
    def parts(frame: pd.DataFrame) -> pd.DataFrame:
        v = {n: frame[n].to_numpy(float) for n in names}
        m = np.zeros((len(frame), 3, 3), complex)
        for i in range(3):
            m[:, i, i] = v[f"m{i + 1}{i + 1}"]
            for j in range(i + 1, 3):
                m[:, i, j] = v[f"m{i + 1}{j + 1}r"] + 1j * v[f"m{i + 1}{j + 1}i"]
                m[:, j, i] = m[:, i, j].conj()
        values, vectors = np.linalg.eigh(m)
        values = np.maximum(values, 0)
        p = values / np.maximum(values.sum(1, keepdims=True), 1e-300)
        alpha = np.degrees(np.arccos(np.clip(np.abs(vectors[:, 0, :]), 0, 1)))
        low, mid = values[:, 0], values[:, 1]
        return pd.DataFrame({"entropy": -(p * np.log(np.maximum(p, 1e-300))).sum(1) / np.log(3), "alpha": (p * alpha).sum(1), "anisotropy": np.where(mid + low > 0, (mid - low) / np.maximum(mid + low, 1e-300), 0.0)})

    return parts(F.struct(*(t[n].cast("double").alias(n) for n in names)))
