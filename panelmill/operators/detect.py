"""Row-level issue detectors.

Every detector is a SQL expression that yields one audit entry or NULL.  They are exploded
together, so a table is scanned once for all of them.  Each entry is unique by (record, column,
issue type), the key of the audit log.

Detectors and :func:`panelmill.functions.text.clean_numeric` differ on purpose: only unsigned
decimal commas are logged as a format fix although signed ones are read too, and the range check
looks at plain numbers only, so ``652.0%`` becomes NULL without an audit row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.functions.text import (
    beyond_sql,
    blank_sql,
    decimal_sql,
    fits_sql,
    matches_any_sql,
    matches_sql,
    number_sql,
    text_sql,
    trim_sql,
)

AUDIT = ["column_name", "issue_type", "original_value", "cleaned_value", "action_taken"]
NO_VALUE = "CAST(NULL AS STRING)"


def entry(column: str, issue: str, original: str, cleaned: str | None, action: str) -> str:
    """One audit entry; ``issue``, ``original`` and ``cleaned`` are SQL, the others names."""
    values = [text_sql(column), issue, original, cleaned or NO_VALUE, text_sql(action)]
    fields = ", ".join(f"{text_sql(name)}, {value}" for name, value in zip(AUDIT, values))
    return f"named_struct({fields})"


def when(*branches: tuple[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in branches) + " END"


def joined(parts: list[str]) -> str:
    return f"concat_ws({text_sql(fixed.PART_SEPARATOR)}, {', '.join(parts)})"


# --- scope and keys; these need the columns by_code and by_name of a resolved record ------------

OUTSIDE_SCOPE = "(by_code IS NULL AND by_name IS NULL)"


def year_outside(first: int, last: int) -> str:
    """Four-digit year outside the period, compared as text."""
    year = trim_sql("year")
    plain = matches_sql(year, fixed.YEAR_PLAIN)
    return f"coalesce({plain} AND {year} NOT BETWEEN '{first}' AND '{last}', FALSE)"


def is_quarantined(first: int, last: int) -> str:
    """Whether a resolved record gets a quarantining issue, without building its audit entries."""
    return f"{OUTSIDE_SCOPE} OR {year_outside(first, last)}"


def outside_scope_issue() -> str:
    """The record matches the dimension neither by code nor by name."""
    original = joined([trim_sql("country_code"), trim_sql("country_name")])
    issue = text_sql(fixed.OUTSIDE_SCOPE)
    return when((OUTSIDE_SCOPE, entry("row", issue, original, None, fixed.QUARANTINED)))


def year_range_issue(first: int, last: int) -> str:
    """The year lies outside the period."""
    issue = text_sql(fixed.YEAR_OUT_OF_RANGE)
    return when((year_outside(first, last), entry("year", issue, trim_sql("year"), None, fixed.QUARANTINED)))


def code_fix_issue() -> str:
    """The name is in the dimension but the trimmed code is another one."""
    expected = "by_name.country_code"
    wrong = f"by_name IS NOT NULL AND {trim_sql('country_code')} IS DISTINCT FROM {expected}"
    issue = text_sql(fixed.CODE_STANDARDIZED)
    return when((wrong, entry("country_code", issue, "country_code", expected, fixed.CORRECTED)))


def year_fix() -> str:
    """Year behind a fiscal prefix or a float suffix, else NULL."""
    year = trim_sql("year")
    return when(
        (matches_sql(year, fixed.YEAR_FISCAL), f"right({year}, 4)"),
        (matches_sql(year, fixed.YEAR_FLOAT), f"split_part({year}, '.', 1)"),
    )


def year_fix_issue() -> str:
    """The year can be read behind another format."""
    readable = matches_any_sql(trim_sql("year"), [fixed.YEAR_FISCAL, fixed.YEAR_FLOAT])
    issue = text_sql(fixed.YEAR_STANDARDIZED)
    return when((readable, entry("year", issue, "year", year_fix(), fixed.CORRECTED)))


def reference_fix_issue() -> str:
    """Attributes differ from a matched dimension row; the name match is reported if both do."""
    original = joined([blank_sql(a) for a in fixed.DIM_ATTRIBUTES])
    issue = text_sql(fixed.REFERENCE_STANDARDIZED)

    def against(match: str) -> tuple[str, str]:
        differs = " OR ".join(
            f"{blank_sql(a)} IS DISTINCT FROM {match}.{a}" for a in fixed.DIM_ATTRIBUTES
        )
        expected = joined([f"{match}.{a}" for a in fixed.DIM_ATTRIBUTES])
        return (
            f"{match} IS NOT NULL AND ({differs})",
            entry("reference_fields", issue, original, expected, fixed.CORRECTED),
        )

    return when(against("by_name"), against("by_code"))


# --- numbers -----------------------------------------------------------------------------------

# The one recoverable format of a column, and the characters that turn its text into a number.
FORMAT_FIXES = {
    "co2_emissions_per_capita": (fixed.NUMBER_COMMA, (",", ".")),
    "unemployment_rate": (fixed.NUMBER_PERCENT, ("%", "")),
    "gdp_usd": (fixed.NUMBER_CURRENCY, ("$,", "")),
}
OTHER_FORMATS = [fixed.NUMBER_COMMA, fixed.NUMBER_PERCENT, fixed.NUMBER_CURRENCY]


def _format_fix(c: str) -> tuple[str, str]:
    pattern, (signs, by) = FORMAT_FIXES[c]
    repaired = f"translate({trim_sql(c)}, {text_sql(signs)}, {text_sql(by)})"
    issue = text_sql(fixed.FORMAT_STANDARDIZED)
    return matches_sql(trim_sql(c), pattern), entry(c, issue, c, repaired, fixed.CORRECTED)


def _to_null(c: str, issue: str) -> str:
    return entry(c, text_sql(issue), c, None, fixed.SET_TO_NULL)


def whole_digits(kind: str) -> int:
    """Digits before the point that a type always holds."""
    if kind == "bigint":
        return 18
    precision, scale = kind.removeprefix("decimal(").removesuffix(")").split(",")
    return int(precision) - int(scale)


def _overflows(c: str, number: str) -> str:
    """Whether a number in bounds has more digits than the type of its column holds.

    Texts with few characters are settled by their length.
    """
    kind = fixed.CLEAN_TYPES[c]
    return f"CASE WHEN length({trim_sql(c)}) >= {whole_digits(kind)} THEN NOT ({fits_sql(number, kind)}) ELSE FALSE END"


def _plain_issues(c: str, lo, hi, overflow: bool) -> tuple[str, str]:
    """Plain numbers outside their bounds, or (in columns without an upper one) too long for their type."""
    text, number = trim_sql(c), decimal_sql(trim_sql(c))
    branches = [(beyond_sql(text, number, lo, hi), _to_null(c, fixed.OUT_OF_RANGE))]
    if overflow and hi is None:
        branches.append((_overflows(c, number), _to_null(c, fixed.OVERFLOW)))
    return matches_sql(text, fixed.NUMBER_PLAIN), when(*branches)


def format_fix_issues() -> list[str]:
    """Recoverable number formats, one pattern per column."""
    return [when(_format_fix(c)) for c in FORMAT_FIXES]


def set_null_issues(columns: list[str]) -> list[str]:
    """Values that become NULL because they are missing or fit none of the number formats."""
    return [
        when(
            (f"{blank_sql(c)} IS NULL", _to_null(c, fixed.MISSING_NUMERIC)),
            (
                f"NOT {matches_any_sql(trim_sql(c), [fixed.NUMBER_PLAIN, *OTHER_FORMATS])}",
                _to_null(c, fixed.INVALID_NUMERIC),
            ),
        )
        for c in columns
    ]


def out_of_range_issues(bounds: dict[str, tuple]) -> list[str]:
    """Plain numbers outside their bounds."""
    return [when(_plain_issues(c, lo, hi, False)) for c, (lo, hi) in bounds.items()]


def formatted_overflow_issues(bounds: dict[str, tuple]) -> list[str]:
    """Numbers behind a format that are too long for their type, in columns without an upper bound."""
    return [
        when((f"{matches_any_sql(trim_sql(c), OTHER_FORMATS)} AND {_overflows(c, number_sql(c))}", _to_null(c, fixed.OVERFLOW)))
        for c, (_, hi) in bounds.items()
        if hi is None
    ]


def numeric_issues(bounds: dict[str, tuple]) -> list[str]:
    """The detectors above as one test chain per column, with numbers too long for their type.

    The conditions of a chain exclude each other, and an ordinary number is settled by the first test
    and one range comparison.  Formatted numbers can be corrected and too long at once, so that
    these have chains of their own.
    """
    chains = [
        when(
            _plain_issues(c, lo, hi, True),
            (f"{blank_sql(c)} IS NULL", _to_null(c, fixed.MISSING_NUMERIC)),
            *([_format_fix(c)] if c in FORMAT_FIXES else []),
            (f"NOT {matches_any_sql(trim_sql(c), OTHER_FORMATS)}", _to_null(c, fixed.INVALID_NUMERIC)),
        )
        for c, (lo, hi) in bounds.items()
    ]
    return chains + formatted_overflow_issues(bounds)


def all_issues(first: int, last: int, bounds: dict[str, tuple]) -> list[str]:
    """Every detector of a resolved record."""
    return [
        outside_scope_issue(),
        year_range_issue(first, last),
        code_fix_issue(),
        year_fix_issue(),
        reference_fix_issue(),
        *numeric_issues(bounds),
    ]


def audit_rows(df: DataFrame, detectors: list[str], id_column: str = "raw_record_id") -> DataFrame:
    """Audit rows of several detectors from one pass over the records.

    Entries are computed by a projection, exploded, and NULL ones dropped after that: dropping
    them inside the array would need a lambda, and everything below a lambda is interpreted.  The
    arrays are never empty; ``explode_outer`` says the same as ``explode`` here, but a filter on
    the size of the array, for which all entries would be computed twice, is not inferred from it.
    """
    entries = df.select(id_column, F.expr(f"array({', '.join(detectors)})").alias("issues"))
    found = entries.select(id_column, F.explode_outer("issues").alias("issue")).where("issue IS NOT NULL")
    return found.select(id_column, "issue.*")
