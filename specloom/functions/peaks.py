"""Column expressions over one spectrum's peak array.

All of them stay inside the row: no explode, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# m/z window of the binned representation.
MZ_MIN = 10.0
MZ_MAX = 1000.0
DEFAULT_BINS = 10_000

# Fixed value: prefix of a peak word.
WORD_PREFIX = "peak@"


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it in ``body``.

    A plain column used inside a lambda is evaluated again for every array
    element, which makes e.g. "divide by the array's maximum" quadratic.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse_peaks(peaks_json: Column) -> Column:
    """JSON text ``[[mz, intensity], ...]`` to peaks sorted by m/z; NULL if unusable."""
    pairs = F.from_json(peaks_json, "array<array<double>>")

    def usable(pair):
        return (F.size(pair) == 2) & F.get(pair, F.lit(0)).isNotNull() & F.get(pair, F.lit(1)).isNotNull()

    def as_peak(pair):
        return F.struct(
            F.get(pair, F.lit(0)).alias("mz"), F.get(pair, F.lit(1)).alias("intensity")
        )

    return let(
        pairs,
        lambda p: F.when(
            F.coalesce(F.forall(p, lambda x: F.coalesce(usable(x), F.lit(False))), F.lit(False)),
            F.sort_array(F.transform(p, as_peak)),
        ),
    )


def usable_peaks(peaks_json: Column) -> Column:
    """An array of the parsed peaks, empty if unusable; to be exploded.

    As a plain column the JSON would be parsed again in every later filter the
    column is pushed into; what a generator puts out is computed once.
    """
    return F.filter(F.array(parse_peaks(peaks_json)), lambda p: F.size(p) > 0)


def any_negative(peaks: Column) -> Column:
    return F.exists(peaks, lambda p: p["intensity"] < 0)


def any_positive(peaks: Column) -> Column:
    return F.exists(peaks, lambda p: p["intensity"] > 0)


def positive_count(peaks: Column) -> Column:
    return F.size(F.filter(peaks, lambda p: p["intensity"] > 0))


def scale_to_maximum(peaks: Column) -> Column:
    """Divide intensities by the largest one; all-zero spectra stay as they are."""

    def scaled(bound):
        return F.transform(
            bound["peaks"],
            lambda p: F.struct(
                p["mz"].alias("mz"),
                F.when(bound["top"] == 0, p["intensity"])
                .otherwise(F.try_divide(p["intensity"], bound["top"]))
                .alias("intensity"),
            ),
        )

    top = F.array_max(F.transform(peaks, lambda p: p["intensity"]))
    return let(F.struct(peaks.alias("peaks"), top.alias("top")), scaled)


def within_mz(peaks: Column, low: float, high: float) -> Column:
    """Peaks with ``low <= mz <= high``, both ends included."""
    return F.filter(peaks, lambda p: p["mz"].between(low, high))


def peak_words(peaks: Column, n_decimals: int) -> Column:
    """One word per peak: the m/z rounded to ``n_decimals``.

    Rounding is done on integers (half up), so that the text does not depend on
    how an engine prints a binary fraction.
    """
    scale = 10**n_decimals

    def word(k):
        whole = F.expr(f"{scale}L")
        text = F.floor(k / whole).cast("bigint").cast("string")
        if n_decimals == 0:
            return F.concat(F.lit(WORD_PREFIX), text)
        rest = F.lpad((k % whole).cast("string"), n_decimals, "0")
        return F.concat(F.lit(WORD_PREFIX), text, F.lit("."), rest)

    scaled = F.transform(peaks, lambda p: F.floor(p["mz"] * F.lit(float(scale)) + F.lit(0.5)).cast("bigint"))
    return F.transform(scaled, word)


def intensities(peaks: Column) -> Column:
    return F.transform(peaks, lambda p: p["intensity"])


def power(weights: Column, exponent: float) -> Column:
    return F.transform(weights, lambda w: F.pow(w, F.lit(float(exponent))))


def bin_width(n_bins: int) -> float:
    return (MZ_MAX - MZ_MIN) / n_bins


def binned(peaks: Column, n_bins: int = DEFAULT_BINS, exponent: float = 0.5) -> Column:
    """Fixed-width m/z bins over [10, 1000), largest powered intensity per bin.

    Sorting by (bin, value) puts each bin's largest value last, so it is enough
    to keep the elements whose right neighbour lies in another bin.
    """
    width = bin_width(n_bins)

    def hit(p):
        return F.struct(
            F.floor((p["mz"] - F.lit(MZ_MIN)) / F.lit(width)).cast("int").alias("bin"),
            F.pow(p["intensity"], F.lit(float(exponent))).alias("value"),
        )

    inside = F.filter(peaks, lambda p: (p["mz"] >= MZ_MIN) & (p["mz"] < MZ_MAX))
    return let(
        F.sort_array(F.transform(inside, hit)),
        lambda hits: F.filter(
            hits,
            lambda h, i: ~h["bin"].eqNullSafe(F.get(hits, i + F.lit(1))["bin"]),
        ),
    )
