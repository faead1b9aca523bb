"""Swiss coordinates (LV95) and WGS84, by the rigorous formulas, as column expressions.

The projection is a conformal cylinder, oblique on a sphere that the Bessel ellipsoid
is mapped to conformally. Back from there, the latitude on the ellipsoid follows from
an iteration with a fixed point; each step uses the last one once, so the expression
stays small. Between the ellipsoids lies a shift of the centre.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Bessel and WGS84 ellipsoids (metres, squared eccentricity), the
# projection's centre, its false origin, and the shift of the centre in metres.
BESSEL = 6377397.155, 0.006674372230614
WGS84 = 6378137.0, 0.006694379990141317
CENTRE = math.radians(46 + 57 / 60 + 8.66 / 3600), math.radians(7 + 26 / 60 + 22.5 / 3600)
ORIGIN = 2_600_000.0, 1_200_000.0
SHIFT = 674.374, 15.056, 405.346

#: Steps of the iteration; each gains more than two digits.
STEPS = 7

_a, _e2 = BESSEL
_e = math.sqrt(_e2)
_phi, _lam = CENTRE
#: Radius of the sphere, ratio of longitudes, latitude of the centre on the sphere, and the constant of the latitudes.
RADIUS = _a * math.sqrt(1 - _e2) / (1 - _e2 * math.sin(_phi) ** 2)
ALPHA = math.sqrt(1 + _e2 / (1 - _e2) * math.cos(_phi) ** 4)
B0 = math.asin(math.sin(_phi) / ALPHA)
K = math.log(math.tan(math.pi / 4 + B0 / 2)) - ALPHA * math.log(math.tan(math.pi / 4 + _phi / 2)) + ALPHA * _e / 2 * math.log((1 + _e * math.sin(_phi)) / (1 - _e * math.sin(_phi)))


def to_bessel(e: Column, n: Column) -> tuple[Column, Column]:
    """(latitude, longitude) on the Bessel ellipsoid in radians."""
    y, x = (e - ORIGIN[0]) / RADIUS, (n - ORIGIN[1]) / RADIUS
    turned = 2 * F.atan(F.exp(x)) - math.pi / 2
    b = F.asin(math.cos(B0) * F.sin(turned) + math.sin(B0) * F.cos(turned) * F.cos(y))
    longitude = _lam + F.atan(F.sin(y) / (math.cos(B0) * F.cos(y) - math.sin(B0) * F.tan(turned))) / ALPHA
    s = (F.log(F.tan(math.pi / 4 + b / 2)) - K) / ALPHA
    phi = b
    for _ in range(STEPS):
        phi = 2 * F.atan(F.exp(s + _e * F.log(F.tan(math.pi / 4 + F.asin(_e * F.sin(phi)) / 2)))) - math.pi / 2
    return phi, longitude


def to_wgs84(e: Column, n: Column, height: Column | float = 0.0, between: tuple[float, float] | None = None) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees of Swiss coordinates in metres. height: above the
    Bessel ellipsoid; a thousand metres change the place by a decimetre. between: degrees
    of latitude on that ellipsoid at which places beyond are held; None: everywhere."""
    phi, lam = to_bessel(e, n)
    if between:
        phi = F.greatest(F.lit(math.radians(between[0])), F.least(F.lit(math.radians(between[1])), phi))
    across = _a / F.sqrt(1 - _e2 * F.sin(phi) * F.sin(phi))
    h = height if isinstance(height, Column) else F.lit(float(height))
    x = (across + h) * F.cos(phi) * F.cos(lam) + SHIFT[0]
    y = (across + h) * F.cos(phi) * F.sin(lam) + SHIFT[1]
    z = (across * (1 - _e2) + h) * F.sin(phi) + SHIFT[2]
    a, e2 = WGS84
    b = a * math.sqrt(1 - e2)
    p = F.sqrt(x * x + y * y)
    # Bowring's latitude, good to far less than a millimetre on the ground
    t = F.atan2(z * a, p * b)
    latitude = F.atan2(z + (a * a - b * b) / b * F.pow(F.sin(t), F.lit(3)), p - e2 * a * F.pow(F.cos(t), F.lit(3)))
    return F.degrees(F.atan2(y, x)), F.degrees(latitude)
