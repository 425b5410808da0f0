"""Azimuthal equidistant projection on the WGS84 ellipsoid, by geodesics from the centre (numpy)."""

from __future__ import annotations

import numpy as np

# The WGS84 ellipsoid.
A, FLATTENING = 6378137.0, 1 / 298.257223563
B = A * (1 - FLATTENING)


def _series(cos2_alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u2 = cos2_alpha * (A * A - B * B) / (B * B)
    return 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2))), u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))


def _delta(b: np.ndarray, sin_s: np.ndarray, cos_s: np.ndarray, cos_2m: np.ndarray) -> np.ndarray:
    return b * sin_s * (cos_2m + b / 4 * (cos_s * (2 * cos_2m**2 - 1) - b / 6 * cos_2m * (4 * sin_s**2 - 3) * (4 * cos_2m**2 - 3)))


def forward(lat: np.ndarray, lon: np.ndarray, lat0: float, lon0: float, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Metres east and north of the centre, true in distance and direction from it (Vincenty's inverse formula)."""
    u1, u2 = np.arctan((1 - FLATTENING) * np.tan(np.radians(lat0))), np.arctan((1 - FLATTENING) * np.tan(np.radians(np.asarray(lat, float))))
    span = np.radians((np.asarray(lon, float) - lon0 + 540) % 360 - 180)
    lam = span.copy()
    for _ in range(rounds):
        sin_s = np.hypot(np.cos(u2) * np.sin(lam), np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * np.cos(lam))
        cos_s = np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * np.cos(lam)
        sigma = np.arctan2(sin_s, cos_s)
        sin_a = np.cos(u1) * np.cos(u2) * np.sin(lam) / np.where(sin_s == 0, 1, sin_s)
        cos2_a = 1 - sin_a**2
        cos_2m = np.where(cos2_a == 0, 0, cos_s - 2 * np.sin(u1) * np.sin(u2) / np.where(cos2_a == 0, 1, cos2_a))
        c = FLATTENING / 16 * cos2_a * (4 + FLATTENING * (4 - 3 * cos2_a))
        lam = span + (1 - c) * FLATTENING * sin_a * (sigma + c * sin_s * (cos_2m + c * cos_s * (2 * cos_2m**2 - 1)))
    a, b = _series(cos2_a)
    s = B * a * (sigma - _delta(b, sin_s, cos_s, cos_2m))
    azimuth = np.arctan2(np.cos(u2) * np.sin(lam), np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * np.cos(lam))
    return s * np.sin(azimuth), s * np.cos(azimuth)


def inverse(x: np.ndarray, y: np.ndarray, lat0: float, lon0: float, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """(latitude, longitude) of projected points (Vincenty's direct formula)."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    s, azimuth = np.hypot(x, y), np.arctan2(x, y)
    tan_u1 = (1 - FLATTENING) * np.tan(np.radians(lat0))
    cos_u1 = 1 / np.sqrt(1 + tan_u1**2)
    sin_u1 = tan_u1 * cos_u1
    sigma1 = np.arctan2(tan_u1, np.cos(azimuth))
    sin_a = cos_u1 * np.sin(azimuth)
    cos2_a = 1 - sin_a**2
    a, b = _series(cos2_a)
    sigma = s / (B * a)
    for _ in range(rounds):
        cos_2m = np.cos(2 * sigma1 + sigma)
        sigma = s / (B * a) + _delta(b, np.sin(sigma), np.cos(sigma), cos_2m)
    sin_s, cos_s, cos_2m = np.sin(sigma), np.cos(sigma), np.cos(2 * sigma1 + sigma)
    lat = np.arctan2(sin_u1 * cos_s + cos_u1 * sin_s * np.cos(azimuth), (1 - FLATTENING) * np.hypot(sin_a, sin_u1 * sin_s - cos_u1 * cos_s * np.cos(azimuth)))
    lam = np.arctan2(sin_s * np.sin(azimuth), cos_u1 * cos_s - sin_u1 * sin_s * np.cos(azimuth))
    c = FLATTENING / 16 * cos2_a * (4 + FLATTENING * (4 - 3 * cos2_a))
    span = lam - (1 - c) * FLATTENING * sin_a * (sigma + c * sin_s * (cos_2m + c * cos_s * (2 * cos_2m**2 - 1)))
    return np.degrees(lat), (lon0 + np.degrees(span) + 540) % 360 - 180
