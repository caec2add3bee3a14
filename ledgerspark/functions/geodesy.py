"""Distance on the WGS-84 ellipsoid as native column expressions.

The inverse formula is T. Vincenty's (Survey Review XXIII, 1975), unrolled to a
fixed number of rounds.  The steps are SQL texts in which each one reads the
results of earlier ones; Spark turns such a list into a chain of projections, so
shared values are computed once and no tree grows large.  Successive guesses of
the longitude shrink their error by a constant factor, so before the last round
they are extrapolated to their limit (A. C. Aitken's process), which saves two
rounds.

The rounds converge slowly only when the points are close to opposite.  Those
rows take a second way: the azimuth at the first point is found by bisection (the
longitude difference grows with it once the pair is put in canonical order,
C. F. F. Karney, J. Geodesy 87, 2013, section 4).  It sits behind a condition, so
ordinary rows never run it.  No Python worker is involved.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The WGS-84 ellipsoid.
EQUATOR_RADIUS_KM = 6378.137
FLATTENING = 1 / 298.257223563
POLE_RADIUS_KM = EQUATOR_RADIUS_KM * (1 - FLATTENING)

ROUNDS = 4  # the last starts from an extrapolated guess; error below 2e-7 km
NEAR_OPPOSITE = 2.9  # radians of arc beyond which bisection takes over
BISECTIONS = 40
_P = "_geo_"  # prefix of working columns


def _n(x: float) -> str:
    """A double literal; a bare decimal number would be a DECIMAL in SQL."""
    return f"{float(x)!r}D" if math.isfinite(x) else f"double('{x}')"


def _over(top: str, bottom: str) -> str:
    """A quotient that is never NULL, so that no later step has to test for it."""
    return f"coalesce(({top}) / ({bottom}), 0D)"


def _bend_factor(q: str) -> str:
    f = FLATTENING
    return f"({q} * ({_n(f / 4)} + {_n(f * f / 16)} * (4D - 3D * {q})))"


def _bend(c: str, sin_a: str, arc: str, ss: str, cs: str, m: str) -> str:
    """How much the ellipsoid's longitude lags the auxiliary sphere's."""
    return (f"((1D - {c}) * {_n(FLATTENING)} * {sin_a} * ({arc} + {c} * {ss} * "
            f"({m} + {c} * {cs} * (2D * {m} * {m} - 1D))))")


def _length_factors(u: str) -> tuple[str, str]:
    big_a = f"(1D + {u} / 16384D * (4096D + {u} * ({u} * (320D - 175D * {u}) - 768D)))"
    big_b = f"({u} / 1024D * (256D + {u} * ({u} * (74D - 47D * {u}) - 128D)))"
    return f"coalesce({big_a}, 0D)", f"coalesce({big_b}, 0D)"


def _length(big_a: str, big_b: str, arc: str, ss: str, cs: str, m: str) -> str:
    """Length of an arc of the auxiliary sphere, measured on the ellipsoid."""
    return (f"{_n(POLE_RADIUS_KM)} * {big_a} * ({arc} - {big_b} * {ss} * ({m} + {big_b} * 0.25D * "
            f"({cs} * (2D * {m} * {m} - 1D) - {big_b} * {_n(1 / 6)} * {m} * "
            f"(4D * {ss} * {ss} - 3D) * (4D * {m} * {m} - 3D))))")


_U = _n((EQUATOR_RADIUS_KM / POLE_RADIUS_KM) ** 2 - 1)


def _bind(name: str, value: str, body: str) -> str:
    """``body`` with a name for a value, which is then computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _at_azimuth(azimuth: str, body: str) -> str:
    """``body`` over ``c``: the auxiliary-sphere arc that leaves point 1 of ``s``.

    Its fields are the arc, its sine and cosine, the longitude it turns, ``m`` (the
    cosine of twice the middle), the sine of the azimuth at the equator and ``q``.
    """
    level = "sqrt(greatest(a.c1 * a.c1 + (s.sb1 - s.sb2) * (s.sb1 + s.sb2), 0D))"
    ends = ("named_struct('from', atan2(s.sb1, a.c1), 'to', atan2(s.sb2, a.c2), "
            "'turn', atan2(a.sa * s.sb2, a.c2) - atan2(a.sa * s.sb1, a.c1))")
    arc = ("named_struct('arc', b.to - b.from, 'ss', sin(b.to - b.from), "
           "'cs', cos(b.to - b.from), 'm', cos(b.from + b.to), 'turn', b.turn, "
           "'sa', a.sa, 'q', 1D - a.sa * a.sa)")
    inner = _bind("b", ends, _bind("c", arc, body))
    with_level = _bind("a", f"named_struct('sa', a.sa, 'c1', a.c1, 'c2', {level})", inner)
    return _bind("a", f"named_struct('sa', sin({azimuth}) * s.cb1, 'c1', cos({azimuth}) * s.cb1)",
                 with_level)


def _opposite_km(s1: str, s2: str, dl: str) -> str:
    """Bisection on the starting azimuth, for pairs close to opposite.

    Takes the sines of the reduced latitudes and the longitude difference.  The
    canonical order puts the point farther from the equator first, in the south.
    """
    far = f"if(abs({s1}) < abs({s2}), {s2}, {s1})"
    near = f"if(abs({s1}) < abs({s2}), {s1}, {s2})"
    flip = f"if({far} > 0D, -1D, 1D)"
    base = (f"named_struct('sb1', least({far} * {flip}, -1e-150D), "
            f"'cb1', greatest(sqrt(1D - {far} * {far}), 1e-150D), "
            f"'sb2', {near} * {flip}, "
            f"'dl', abs({dl}), 'lo', 0D, 'hi', {_n(math.pi)})")
    bend = _bind("k", _bend_factor("c.q"), _bend("k", "c.sa", "c.arc", "c.ss", "c.cs", "c.m"))
    half = "((s.lo + s.hi) * 0.5D)"
    step = "(s, i) -> " + _at_azimuth(half, (
        "named_struct('sb1', s.sb1, 'cb1', s.cb1, 'sb2', s.sb2, 'dl', s.dl, "
        f"'lo', if(c.turn - {bend} < s.dl, {half}, s.lo), "
        f"'hi', if(c.turn - {bend} < s.dl, s.hi, {half}))"))
    big_a, big_b = _length_factors("u")
    length = _bind("u", f"c.q * {_U}", _bind(
        "k", f"named_struct('a', {big_a}, 'b', {big_b})",
        _length("k.a", "k.b", "c.arc", "c.ss", "c.cs", "c.m")))
    done = "s -> " + _at_azimuth(half, length)
    return f"aggregate(sequence(1, {BISECTIONS}), {base}, {step}, {done})"


def with_geodesic_km(df: DataFrame, lat1: str, lon1: str, lat2: str, lon2: str,
                     out: str) -> DataFrame:
    """Append the distance in km; 0.0 where any coordinate is unusable.

    Unusable means NULL, NaN, infinite, text that is no number, or a latitude
    beyond 90 degrees.  Longitudes may lie outside -180..180.
    """
    kept = [F.col(f"`{n}`") for n in df.columns if n != out]
    steps: list[str] = []

    def let(name: str, expression: str) -> str:
        steps.append(f"{expression} AS {_P}{name}")
        return _P + name

    # NaN stands for no number; Spark orders it above every number, so it fails
    # each of the comparisons.
    a1, o1, a2, o2 = (
        let(name, f"coalesce(try_cast(`{column}` AS DOUBLE), double('NaN'))")
        for name, column in (("a1", lat1), ("o1", lon1), ("a2", lat2), ("o2", lon2)))
    ok = let("ok", f"abs({a1}) <= 90D AND abs({a2}) <= 90D AND abs({o1}) < double('Infinity') "
                   f"AND abs({o2}) < double('Infinity')")
    t1, t2 = (let(f"t{i}", f"{_n(1 - FLATTENING)} * tan(radians(if({ok}, {a}, 0D)))")
              for i, a in ((1, a1), (2, a2)))
    turn = let("turn", f"if({ok}, {o2} - {o1}, 0D)")
    dl = let("dl", f"radians(if(abs({turn}) <= 180D, {turn}, "
                   f"{turn} - 360D * double(floor(({turn} + 180D) / 360D))))")
    c1, c2 = (let(f"c{i}", _over("1D", f"sqrt(1D + {t} * {t})")) for i, t in ((1, t1), (2, t2)))
    s1, s2 = let("s1", f"{t1} * {c1}"), let("s2", f"{t2} * {c2}")
    ss12, cc12 = let("ss12", f"{s1} * {s2}"), let("cc12", f"{c1} * {c2}")
    cs12, sc12 = let("cs12", f"{c1} * {s2}"), let("sc12", f"{s1} * {c2}")
    fixed = [ok, dl, c2, ss12, cc12, cs12, sc12]
    guesses = [dl]
    for k in range(ROUNDS):
        guess = guesses[-1]
        if k == ROUNDS - 1:  # extrapolate the three guesses behind
            first, second, third = guesses[-3:]
            step = let("step", f"{third} - {second}")
            prior = let("prior", f"{second} - {first} - 1e-300D")
            guess = let("limit", f"{third} - " + _over(f"{step} * {step}", f"{step} - {prior}"))
        sl, cl = let(f"sl{k}", f"sin({guess})"), let(f"cl{k}", f"cos({guess})")
        side, cross = let(f"si{k}", f"{c2} * {sl}"), let(f"cr{k}", f"{cs12} - {sc12} * {cl}")
        ss = let(f"ss{k}", f"sqrt({side} * {side} + {cross} * {cross})")
        cs = let(f"cs{k}", f"{ss12} + {cc12} * {cl}")
        arc = let(f"arc{k}", f"atan2({ss}, {cs})")
        sa = let(f"sa{k}", _over(f"{cc12} * {sl}", f"greatest({ss}, 1e-300D)"))
        q = let(f"q{k}", f"1D - {sa} * {sa}")
        m = let(f"m{k}", f"{cs} - " + _over(f"2D * {ss12}", f"greatest({q}, 1e-300D)"))
        if k == ROUNDS - 1:
            break
        c = let(f"c_{k}", _bend_factor(q))
        guesses.append(let(f"g{k}", f"{dl} + " + _bend(c, sa, arc, ss, cs, m)))
        if k == 1:
            # The arc is known well enough to tell which pairs need the other way.
            # Standing here, this also parts the chain into two compiled methods,
            # each short enough for the JVM to optimise.
            far = let("far", f"if({ok} AND {arc} > {_n(NEAR_OPPOSITE)}, "
                             f"{_opposite_km(s1, s2, dl)}, NULL)")
            df = df.select("*", *map(F.expr, steps)).select(
                *kept, *fixed, *guesses[1:], far)
            steps.clear()
    u = let("u", f"{q} * {_U}")
    big_a, big_b = (let(n, e) for n, e in zip(("ka", "kb"), _length_factors(u)))
    km = let("km", f"if({ok}, coalesce({far}, {_length(big_a, big_b, arc, ss, cs, m)}), 0D)")
    return df.select("*", *map(F.expr, steps)).select(*kept, F.col(km).alias(out))
