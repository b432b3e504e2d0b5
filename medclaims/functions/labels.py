"""Code-to-label expressions (E5, E6, E12-E14, X15), driven by fixed values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from medclaims import fixed_values as V


def label(code: str, labels: dict[int, str]) -> Column:
    """The label of a code; NULL and unlisted codes are unknown."""
    hits = [F.when(F.col(code) == key, F.lit(text)) for key, text in labels.items()]
    return F.coalesce(*hits, F.lit(V.UNKNOWN_LABEL))


def diagnosis_text(code: str) -> Column:
    """Text for a code prefix; V and E codes keep their whole code behind the text."""
    c = F.col(code)
    named = [F.when(c.startswith(prefix), F.lit(text)) for prefix, text in V.DIAGNOSIS_TEXT_BY_PREFIX]
    joined = [
        F.when(c.startswith(prefix), F.concat(F.lit(text), c))
        for prefix, text in V.DIAGNOSIS_TEXT_BEFORE_CODE
    ]
    return F.coalesce(*named, *joined, F.concat(F.lit(V.DIAGNOSIS_TEXT_OTHERWISE), c))


def diagnosis_category(code: str) -> Column:
    """Category by *string* range, so '4599' lies outside '390'..'459'."""
    c = F.col(code)
    ranges = [
        F.when(c.between(low, high), F.lit(name)) for low, high, name in V.DIAGNOSIS_CATEGORY_BY_RANGE
    ]
    prefixes = [
        F.when(c.startswith(prefix), F.lit(name)) for prefix, name in V.DIAGNOSIS_CATEGORY_BY_PREFIX
    ]
    return F.coalesce(*ranges, *prefixes, F.lit(V.DIAGNOSIS_CATEGORY_OTHERWISE))


def provider_type(inpatient_claims: str, outpatient_claims: str) -> Column:
    """Which kinds of claim a provider has billed."""
    has_inpatient = F.col(inpatient_claims) > 0
    has_outpatient = F.col(outpatient_claims) > 0
    return (
        F.when(has_inpatient & has_outpatient, V.PROVIDER_BOTH)
        .when(has_inpatient, V.PROVIDER_INPATIENT_ONLY)
        .otherwise(V.PROVIDER_OUTPATIENT_ONLY)
    )
