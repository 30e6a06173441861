"""Column expressions used by the cleaning and feature operators.

All of them are built-in Catalyst expressions (CASE, regexp, try_cast, ...), so they
fuse into whole-stage codegen; no Python runs per row.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V

_NUMBER_RE = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The white space that a text strip removes at both ends.
STRIPPED = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2028\u2029"


def strip(c) -> Column:
    return F.trim(col(c), F.lit(STRIPPED))


def placeholder_to_null(c) -> Column:
    """Textual placeholders (after strip + lower) become NULL; other values are kept as is."""
    c = col(c)
    return F.when(F.lower(strip(c)).isin(V.PLACEHOLDERS), F.lit(None).cast("string")).otherwise(c)


def normalize_text(c) -> Column:
    """Strip + lower."""
    return F.lower(strip(c))


def dict_map(c, mapping: dict) -> Column:
    """Literal dictionary lookup; values not in the dictionary pass through."""
    c = col(c)
    if not mapping:
        return c
    items = list(mapping.items())
    expr = F.when(c == items[0][0], F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(c == k, F.lit(v))
    return expr.otherwise(c)


def canonical_gender(c) -> Column:
    return dict_map(normalize_text(c), V.GENDER_MAP)


def canonical_ethnicity(c) -> Column:
    return dict_map(normalize_text(c), V.ETHNICITY_MAP)


def canonical_drug(c) -> Column:
    return dict_map(F.regexp_replace(normalize_text(c), r"\s+", " "), V.DRUG_MAP)


def canonical_route(c) -> Column:
    return dict_map(normalize_text(c), V.ROUTE_MAP)


def canonical_diagnosis(c) -> Column:
    return dict_map(normalize_text(c), V.DIAGNOSIS_MAP)


def canonical_smoking(c) -> Column:
    return dict_map(normalize_text(c), V.SMOKING_MAP)


def to_number(c) -> Column:
    """Text -> DOUBLE, anything that is not a plain decimal number -> NULL.
    (The regex guard keeps 'NaN', 'inf' and '12d' out; try_cast alone accepts them.)"""
    c = col(c)
    return F.when(c.rlike(_NUMBER_RE), strip(c).try_cast("double"))


def extract_dosage(c) -> Column:
    """C17: '<number> mg' anywhere, else the whole stripped text if purely numeric, else NULL."""
    s = F.lower(col(c))
    mg = F.regexp_extract(s, V.DOSAGE_MG_PATTERN, 1)
    stripped = strip(s)
    return (F.when(mg != "", mg.cast("double"))
            .when(stripped.rlike(V.PLAIN_NUMBER_PATTERN), stripped.cast("double")))


def duration_days(c) -> Column:
    """Exact labels -> 365, then numeric parse."""
    c = col(c)
    expr = None
    for label, days in V.DURATION_LABELS.items():
        expr = (F.when(c == label, F.lit(float(days))) if expr is None
                else expr.when(c == label, F.lit(float(days))))
    return expr.otherwise(to_number(c))


def finite_or_null(c) -> Column:
    """+-inf and NaN -> NULL (NULL is the only missing value downstream)."""
    c = col(c)
    return F.when(F.isnan(c) | c.isin(float("inf"), float("-inf")), F.lit(None).cast("double")).otherwise(c)


def in_range_or_null(c, low, high) -> Column:
    """Outside the closed range -> NULL."""
    c = col(c)
    return F.when(c.between(low, high), c)


def feet_to_cm(c) -> Column:
    """C20: heights in 4..8 (inclusive) are feet."""
    c = col(c)
    lo, hi = V.FEET_RANGE
    return F.when(c.between(lo, hi), c * V.FEET_TO_CM).otherwise(c)


def recompute_bmi(bmi, weight, height, bounded: bool) -> Column:
    """Where BMI is missing or outside 5..100 and height > 0, weight / (height/100)^2.
    The bounded form accepts only finite recomputed values inside 5..100."""
    bmi, weight, height = col(bmi), col(weight), col(height)
    lo, hi = V.BMI_RANGE
    bad = bmi.isNull() | (bmi < lo) | (bmi > hi)
    recomputed = F.when(height > 0, weight / F.pow(height / 100.0, 2))
    if bounded:
        recomputed = F.when(~F.isnan(recomputed) & recomputed.between(lo, hi), recomputed)
        return F.when(bad & recomputed.isNotNull(), recomputed).otherwise(bmi)
    return F.when(bad & (height > 0), recomputed).otherwise(bmi)


def parse_mixed_date(c, formats=None) -> Column:
    """First format that parses wins; invalid -> NULL. A failed parse costs an exception, so a
    format is tried only on texts that hold its separators (they must stand there literally)."""
    c = col(c)
    fmts = formats or V.DATE_FORMATS

    def tried(f):
        parsed = F.try_to_timestamp(c, F.lit(f))
        marks = sorted(set(f) & set("-/,"))
        return F.when(any_of([~c.contains(m) for m in marks]), F.lit(None)).otherwise(parsed) if marks else parsed
    return F.to_date(F.coalesce(*[tried(f) for f in fmts]))


def binary_from_text(c) -> Column:
    """Strict label mapping."""
    s = F.lower(strip(c))
    return F.when(s.isin(V.BINARY_ZERO), F.lit(0)).when(s.isin(V.BINARY_ONE), F.lit(1)).cast("int")


def binary_from_any(c) -> Column:
    """Numeric first (exactly 0/1 accepted, any other number rejected), then labels."""
    c = col(c)
    num = to_number(c)
    s = F.lower(strip(c))
    return (F.when(num.isNotNull(), F.when(num.isin(0.0, 1.0), num.cast("int")))
            .when(s.isin(V.BINARY_ZERO), F.lit(0)).when(s.isin(V.BINARY_ONE), F.lit(1))).cast("int")


def keep_zero_one(c) -> Column:
    """Numeric value kept only when exactly 0 or 1."""
    c = col(c)
    return F.when(c.isin(0, 1), c.cast("int")).cast("int")


def snake_case(c) -> Column:
    """lower/strip, whitespace -> '_', drop other characters, collapse '_'."""
    s = F.lower(strip(c))
    s = F.regexp_replace(s, r"\s+", "_")
    s = F.regexp_replace(s, r"[^a-z0-9_]", "")
    return F.regexp_replace(s, r"_+", "_")


def any_of(conds) -> Column:
    return reduce(lambda a, b: a | b, conds)
