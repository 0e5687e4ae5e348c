"""Scalar column functions. All are built-in expressions, so they stay inside code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in km used for distances and areas.
EARTH_RADIUS_KM = 6371.0088

# Forcing tier of each scenario code.
SCENARIO_TIER = {
    "rcp26": "low",
    "rcp45": "medium",
    "rcp60": "medium",
    "rcp85": "high",
    "ssp126": "low",
    "ssp245": "medium",
    "ssp370": "medium",
    "ssp585": "high",
}
TIER_ORDER = ["low", "medium", "high"]
NON_FORCING = ["observed"]

# Upper percentile bound of each risk band.
RISK_BANDS = [(20, "Very Low"), (40, "Low"), (60, "Medium"), (80, "High"), (100, "Very High")]

# Variables whose percentile direction is known by name prefix.
HIGHER_IS_BETTER = [
    "b10cm", "b30cm", "biom", "cleaf", "csoil", "cveg", "cwood", "gpp", "groundwstor", "npp", "ra", "rh",
    "soilmoist", "tcb", "yield",
]
HIGHER_IS_WORSE = ["an-tot-cold", "an-tot-heat", "burntarea", "ffire", "lec", "led", "leh", "ler", "lew", "potevap"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup(key: Column, table: Mapping[str, object]) -> Column:
    pairs = [F.lit(x) for k, v in table.items() for x in (k, v)]
    return F.create_map(*pairs)[key]


def normalize_lon(lon: Column | str) -> Column:
    """Longitude moved by at most one turn into [-180, 180]; anything farther is an error."""
    c = _col(lon)
    once = F.when(c < -180, c + 360).when(c > 180, c - 360).otherwise(c)
    failure = F.raise_error(F.concat(F.lit("longitude out of range: "), c.cast("string"))).cast("double")
    return F.when(once.between(-180, 180), once).when(c.isNotNull(), failure)


def wrap_lon(lon: Column | str) -> Column:
    """Longitude of any number of turns moved into [-180, 180)."""
    return F.pmod(_col(lon) + 180.0, F.lit(360.0)) - 180.0


def lon_gap(a: Column | str, b: Column | str) -> Column:
    """Absolute longitude difference, the short way round."""
    gap = F.abs(_col(a) - _col(b))
    return F.least(gap, 360.0 - gap)


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance, wrapping at the antimeridian and clipped against rounding."""
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    dl = F.radians(wrap_lon(_col(lon2) - _col(lon1)))
    half_lat, half_lon = F.sin((p2 - p1) / 2), F.sin(dl / 2)
    a = half_lat * half_lat + F.cos(p1) * F.cos(p2) * half_lon * half_lon
    return 2 * radius_km * F.asin(F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), a))))


def cell_area_km2(lat: Column | str, size: float = 0.5, mode: str = "spherical") -> Column:
    """Area of the cell centred at `lat`: exact spherical band, or the planar cosine form."""
    c = _col(lat)
    step = F.radians(F.lit(size))
    if mode == "planar":
        return (step * EARTH_RADIUS_KM) * (step * EARTH_RADIUS_KM * F.cos(F.radians(c)))
    band = F.sin(F.radians(c + size / 2)) - F.sin(F.radians(c - size / 2))
    return EARTH_RADIUS_KM**2 * step * band


def kinetic_energy_j(diameter_mm: Column | str) -> Column:
    """Energy of one hailstone; the power law changes at 22.1 mm."""
    cm = _col(diameter_mm) / 10.0
    return F.when(_col(diameter_mm) < 22.1, 0.0107 * F.pow(cm, F.lit(4.59))).otherwise(0.0243 * F.pow(cm, F.lit(3.5)))


def slopes_agree(ols: Column | str, sen: Column | str) -> Column:
    """Three-valued: NULL when a slope is missing or both are flat, else whether the signs match."""
    a, b = F.signum(_col(ols)), F.signum(_col(sen))
    return F.when((a != 0) | (b != 0), a == b)


def risk_band(percentile: Column | str) -> Column:
    p = _col(percentile)
    out = F.when(p <= RISK_BANDS[0][0], RISK_BANDS[0][1])
    for bound, label in RISK_BANDS[1:-1]:
        out = out.when(p <= bound, label)
    return out.when(p.isNotNull(), RISK_BANDS[-1][1])


def tier_of(scenario: Column | str) -> Column:
    """Forcing tier; NULL for a code that is not a forcing pathway."""
    return _lookup(F.lower(_col(scenario)), SCENARIO_TIER)


def is_forcing(scenario: Column | str) -> Column:
    return ~F.lower(_col(scenario)).isin(NON_FORCING)


def tier_rank(tier: Column | str) -> Column:
    return F.coalesce(_lookup(_col(tier), {t: i for i, t in enumerate(TIER_ORDER)}), F.lit(99))


def monthly_ratio(num, den, river=None, routed: bool = False) -> Column:
    """Demand over supply. The river rule comes first, then no demand = 0, then no supply = NULL."""
    n, d = _col(num), _col(den)
    valid = n.isNotNull() & d.isNotNull()
    if routed:
        valid = valid & F.coalesce(_col(river), F.lit(False))
    return F.when(~valid, None).when(n == 0, 0.0).when((n > 0) & (d > 0), n / F.nullif(d, F.lit(0.0)))


def piecewise_linear(x, knots: Sequence[tuple[float, float]], left: float | None = None, right: float | None = None) -> Column:
    """Linear interpolation over a short literal knot list."""
    c = _col(x)
    (x0, y0), (xn, yn) = knots[0], knots[-1]
    out = F.when(c < x0, y0 if left is None else left).when(c > xn, yn if right is None else right)
    for (a, ya), (b, yb) in zip(knots, knots[1:]):
        out = out.when(c <= b, ya + (yb - ya) * (c - a) / (b - a))
    return out


def parse_number(text: Column | str) -> Column:
    """Plain non-negative number with commas and blanks removed; NULL for any other text."""
    value = F.regexp_replace(_col(text), r"[,\s]", "").try_cast("double")
    return F.when((value >= 0) & ~F.isnan(value), value)


def slugify(text: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(_col(text))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def split_list(text: Column | str, sep: str = ";") -> Column:
    """Trimmed, non-empty items of a separated list."""
    items = F.transform(F.split(_col(text), sep), lambda s: F.trim(s))
    return F.filter(items, lambda s: s != "")


def join_list(items: Column | str, sep: str = ";") -> Column:
    return F.array_join(F.array_sort(F.array_distinct(_col(items))), sep)


def sigfig(x: Column | str, n: int = 4) -> Column:
    """Round to `n` significant figures; 0 stays 0."""
    c = _col(x)
    scale = F.pow(F.lit(10.0), n - 1 - F.floor(F.log10(F.abs(F.nullif(c, F.lit(0.0))))))
    return F.when(c == 0, 0.0).otherwise(F.rint(c * scale) / scale)


def percentile_direction(declared: Column | str, variable: Column | str) -> Column:
    """The declared direction, else that of the longest known prefix of the name's parts, else 'unknown'."""
    name = F.concat(_col(variable), F.lit("-"))
    known = F.lit(None).cast("string")
    directions = {**dict.fromkeys(HIGHER_IS_BETTER, "higher_is_better"), **dict.fromkeys(HIGHER_IS_WORSE, "higher_is_worse")}
    for prefix in sorted(directions, key=len):  # the longest is asked first
        known = F.when(name.startswith(prefix + "-"), directions[prefix]).otherwise(known)
    return F.coalesce(_col(declared), known, F.lit("unknown"))


def curve_number_infiltration(ppt, smax: float = 100.0, ia_ratio: float = 0.2) -> Column:
    """Rain minus runoff by the curve-number method."""
    p, ia = _col(ppt), ia_ratio * smax
    return p - F.when(p > ia, (p - ia) * (p - ia) / (p - ia + smax)).otherwise(0.0)


def conditional_class(score: Column | str) -> Column:
    s = _col(score)
    return F.when(s > 0.75, "High").when(s > 0.50, "Medium").otherwise("Low")


def geometric_mean(*cols: Column | str) -> Column:
    """Row-wise geometric mean of positive columns."""
    total = sum((F.ln(_col(c)) for c in cols[1:]), F.ln(_col(cols[0])))
    return F.exp(total / float(len(cols)))


def config_value(document: Column | str, path: str) -> Column:
    """One value of a JSON document column."""
    return F.get_json_object(_col(document), path)
