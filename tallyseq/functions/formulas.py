"""Scalar formulas as column expressions; all stay inside generated code."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def sigmoid(value: Column, middle: float, steep: float) -> Column:
    """Logistic curve, exactly one or zero from 50 units away on."""
    x = F.lit(steep) * (value - F.lit(middle))
    return F.when(x >= 50, F.lit(1.0)).when(x <= -50, F.lit(0.0)).otherwise(1 / (1 + F.exp(-x)))


def log_transform(x: Column) -> Column:
    return F.log10(1 + x)


def depth_confidence(mean: Column, sd: Column, target: float = 30.0, most_sd: float = 20.0, scale: float = 1000.0) -> Column:
    """Gaussian of the scaled mean depth around target / scale, a tenth of that wide, and evenness of depth, averaged."""
    aim = target / scale
    near = F.exp(-F.pow(mean * scale - aim, 2) / (2 * (aim / 10) ** 2))
    return (near + F.greatest(F.lit(0.0), 1 - sd / most_sd)) / 2


def logarithmic_weight(breadth: Column, least: float = 1e-3) -> Column:
    """1 at the least breadth, 0 at full breadth: one minus the fourth power of the logarithm's share."""
    x = F.log(F.greatest(F.lit(least), F.least(breadth, F.lit(1.0))))
    return 1 - F.pow((x - math.log(least)) / -math.log(least), 4)


def leading_decimals(v: Column) -> Column:
    """A number with its first two non-zero decimals and the zeros before the first, as text.

    Ten decimals count; whole numbers stay as they are. The two digits follow each other even if zeros
    stood between them.
    """
    text = F.regexp_replace(F.format_string("%.10f", v.cast("double")), r"\.?0+$", "")
    whole, part = F.substring_index(text, ".", 1), F.substring_index(text, ".", -1)
    zeros = F.regexp_extract(part, r"^0*", 0)
    digits = F.substring(F.regexp_replace(part, "0", ""), 1, 2)
    return F.when(F.instr(text, ".") == 0, text).otherwise(F.concat(whole, F.lit("."), zeros, digits))


def position_bin(v: Column, width: int) -> Column:
    """The start of a value's bin; the value itself where the width isn't positive."""
    return F.floor(v / width) * width if width > 0 else v


def strand(is_reverse: Column) -> Column:
    return F.when(is_reverse, F.lit("-")).otherwise(F.lit("+"))


def before_parenthesis(name: Column) -> Column:
    return F.trim(F.regexp_extract(name, r"(?s)^(.*?)(\s*\(|$)", 1))


def binomial(name: Column) -> Column:
    """'Genus species' if a name starts so, else null."""
    two = F.regexp_extract(F.trim(name), r"^([A-Z][a-z]+)\s+([a-z][a-z0-9_-]+)", 0)
    return F.when(two != "", F.regexp_replace(two, r"\s+", " "))


def name_aliases(name: Column) -> Column:
    """Other spellings of a name, sorted: without what stands in parentheses, and the binomial."""
    found = F.array_compact(F.array(F.nullif(before_parenthesis(name), F.lit("")), binomial(name)))
    return F.array_sort(F.array_remove(F.array_distinct(found), F.trim(name)))


def mapq_keep(mapq: Column, n_secondary: Column, least: int) -> Column:
    """Good mapping quality, or zero for a read that also maps elsewhere."""
    return (mapq >= least) | ((mapq == 0) & (n_secondary > 0))


def mapq_probability(q: Column) -> Column:
    return 1 - F.pow(F.lit(10.0), -q / 10)


def position_dispersion(middle: Column, length: Column) -> Column:
    """Spread of positions against that of a uniform one (an aggregate)."""
    return F.sqrt(F.var_pop(middle) / (F.max(length) * F.max(length) / 12))


def ani_to_jaccard(ani: float, k: int) -> float:
    p = ani**k
    return p / (2 - p)


def containment_to_ani(c: Column, k: int) -> Column:
    return F.pow(c, F.lit(1.0 / k))


def strip_version(acc: Column) -> Column:
    return F.regexp_replace(acc, r"\.\d+$", "")


def scale_percent(v: Column) -> Column:
    """Fractions to percent with four decimals; larger values stay."""
    return F.when(v <= 1, F.round(v * 100, 4)).otherwise(v)


def truthy(v: Column) -> Column:
    return F.coalesce(F.upper(F.trim(v)).isin("TRUE", "1", "YES", "Y", "T"), F.lit(False))


def safe_ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(empty))


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution by the series of erf whose terms are all positive, exactly 0 or 1 beyond
    six deviations. The factors a / (2n + 1) are nested from the innermost of 64 on."""
    def half(v: Column) -> Column:
        nested = F.aggregate(F.sequence(F.lit(64), F.lit(1)), F.lit(1.0), lambda done, n: 1 + v * v / (2 * n + 1) * done)
        return F.abs(v) / math.sqrt(2 * math.pi) * F.exp(-v * v / 2) * nested

    return once(z, lambda v: F.when(v > 6, F.lit(1.0)).when(v < -6, F.lit(0.0)).otherwise(0.5 + F.signum(v) * half(v)))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often it occurs; null gives use(null)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371.0 * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


#: Words of a property and of a source that speak of resistance to drugs.
RESISTANCE_WORDS, RESISTANCE_SOURCES = ("resist", "amr", "antibiotic", "antimicrobial"), ("card", "ncbiamr", "resfinder", "argannot", "amrfinder")


def is_resistance(prop: Column, drug_class: Column, drugs: Column, source: Column) -> Column:
    """Whether an annotation is of resistance: by its property's words, by naming drugs or their class, or by
    its source. Nulls say nothing."""
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    any_of = lambda c, words: F.lit(False) if not words else low(c).rlike("|".join(words))
    return any_of(prop, RESISTANCE_WORDS) | (low(drug_class) != "") | (low(drugs) != "") | any_of(source, RESISTANCE_SOURCES)


def round_scaled(x: Column, digits: int) -> Column:
    """x in double precision, times 10^digits, to the nearest whole number and back, halves away from zero: what
    engines do that don't round the shortest decimal form, as Spark's own `round` does."""
    return F.round(x * 10.0**digits) / 10.0**digits
