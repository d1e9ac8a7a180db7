"""Text predicates and guarded casts.  Pure column expressions: inlined, no UDF."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill import fixed


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """Text without outer spaces (spaces only: tabs and no-break spaces stay)."""
    return F.btrim(col(c))


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, with blank text as NULL."""
    return F.nullif(trimmed(c), F.lit(""))


def distinct_from(a: Column | str, b: Column | str) -> Column:
    """NULL-safe inequality."""
    return ~col(a).eqNullSafe(col(b))


def matches(c: Column | str, pattern: str) -> Column:
    """Regex test; patterns are anchored with ``\\z`` so a trailing newline never matches."""
    return F.rlike(col(c), F.lit(pattern))


def guarded(
    c: Column | str,
    pattern: str,
    type_name: str,
    test: Callable[[Column], Column],
    otherwise: bool,
) -> Column:
    """``test`` on the cast value where the text has the right format, else a constant."""
    c = col(c)
    return F.when(matches(c, pattern), test(c.try_cast(type_name))).otherwise(F.lit(otherwise))


def within(c: Column | str, lo=None, hi=None) -> Column:
    """TRUE inside [lo, hi] with open ends; NULL stays NULL."""
    c = col(c)
    if lo is not None and hi is not None:
        return c.between(lo, hi)
    if lo is not None:
        return c >= lo
    return c <= hi if hi is not None else F.lit(True)


def out_of_range(c: Column | str, lo=None, hi=None) -> Column:
    """TRUE outside [lo, hi]; NULL values and open ends pass."""
    return F.coalesce(~within(c, lo, hi), F.lit(False))


def is_valid(c: Column | str, type_name: str) -> Column:
    """Whether text could be cast to ``integer``, ``numeric`` or ``timestamp``.  NULL stays NULL.

    The format is tested before the cast because engines differ in what a cast accepts (``2e3``
    as an integer, a bare year as a timestamp).  The words for NaN and infinity are valid numeric
    and (infinity) timestamp input; :func:`is_finite` rejects them.
    """
    c = col(c)
    word = F.lower(F.btrim(c))
    if type_name == "integer":
        return matches(c, fixed.INPUT_INTEGER) & F.btrim(c).try_cast("int").isNotNull()
    if type_name == "numeric":
        return matches(c, fixed.INPUT_NUMERIC) | word.isin(fixed.NOT_FINITE)
    if type_name == "timestamp":
        stamp = matches(c, fixed.INPUT_TIMESTAMP) & as_timestamp(c).isNotNull()
        return stamp | word.isin("infinity", "-infinity")
    raise ValueError(f"no input test for type {type_name}")


def is_finite(c: Column | str) -> Column:
    return ~F.lower(F.btrim(col(c))).isin(fixed.NOT_FINITE)


def as_decimal(c: Column | str, type_name: str = fixed.OFFICIAL_DECIMAL) -> Column:
    """Text to decimal, NULL where it does not fit."""
    return F.btrim(col(c)).try_cast(type_name)


def as_integer(c: Column | str) -> Column:
    """Text to integer only for integer text: ``2000.0`` gives NULL in every engine."""
    c = col(c)
    return F.when(matches(c, fixed.INPUT_INTEGER), F.btrim(c).try_cast("int"))


def as_timestamp(c: Column | str) -> Column:
    """Text to a timestamp without time zone, only for full date-time or date text.

    A zone behind it is valid and left out of account: the wall-clock time is what is read.
    """
    return F.regexp_extract(col(c), fixed.INPUT_TIMESTAMP, 1).try_cast("timestamp_ntz")


def as_utc(c: Column | str) -> Column:
    """Text read as UTC wall-clock time (sessions are pinned to UTC)."""
    return as_timestamp(c).cast("timestamp")


# --- the same tests as SQL text -----------------------------------------------------------------
# Composed expressions are put together as text and parsed once: building a large expression from
# Column objects takes one call into the JVM per node.


def text_sql(value: str) -> str:
    """A raw string literal, in which backslashes stand for themselves."""
    return f"r'{value}'"


def trim_sql(c: str) -> str:
    return f"btrim({c})"


def blank_sql(c: str) -> str:
    return f"nullif(btrim({c}), '')"


def matches_sql(c: str, pattern: str) -> str:
    return f"rlike({c}, {text_sql(pattern)})"


def matches_any_sql(c: str, patterns: list[str]) -> str:
    """Whether one of the anchored patterns matches, as a single regex test."""
    inner = "|".join(p.removeprefix("^").removesuffix(r"\z") for p in patterns)
    return matches_sql(c, rf"^(?:{inner})\z")


def within_sql(c: str, lo=None, hi=None) -> str:
    if lo is not None and hi is not None:
        return f"{c} BETWEEN {lo} AND {hi}"
    return f"{c} >= {lo}" if lo is not None else f"{c} <= {hi}"


def outside_sql(c: str, lo=None, hi=None) -> str:
    return f"coalesce(NOT ({within_sql(c, lo, hi)}), FALSE)"


# A plain number of up to so many characters fits the widest decimal with all its digits.
EXACT_LENGTH = 17


def number_text_sql(c: str) -> str:
    """Plain number text behind currency, percent or decimal-comma formatting of SQL text ``c``, else ''.

    One formatting is removed, tested in that order, so ``1,234`` reads as 1.234 and ``-7,5`` as
    -7.5, while ``+5`` is rejected.  Plain numbers, the usual case, cost one regex test.
    """
    text = trim_sql(c)
    bare = (
        f"CASE WHEN startswith({text}, '$') THEN translate({text}, '$,', '') "
        f"WHEN endswith({text}, '%') THEN translate({text}, '%', '') "
        f"ELSE regexp_replace({text}, {text_sql(fixed.NUMBER_COMMA_SIGNED)}, '$1.$2') END"
    )
    read = f"regexp_extract({bare}, {text_sql(fixed.NUMBER_PLAIN)}, 0)"
    return f"CASE WHEN {matches_sql(text, fixed.NUMBER_PLAIN)} THEN {text} ELSE {read} END"


def decimal_sql(text: str) -> str:
    """A plain number text as the widest decimal, NULL where it doesn't fit."""
    return f"TRY_CAST({text} AS {fixed.OFFICIAL_DECIMAL})"


def number_sql(c: str) -> str:
    """Number behind the formatting of SQL text ``c``, else NULL."""
    return decimal_sql(number_text_sql(c))


def size_key(whole: str, part: str) -> str:
    return f"{len(whole):010d}{whole}.{part}"


def size_sql(text: str) -> str:
    """The size of a plain number text of any length, without its sign, as text that sorts like it.

    The number of digits before the point goes first, then these digits, then those behind it.
    """
    digits = f"ltrim('0', split_part(ltrim('-', {text}), '.', 1))"
    return f"concat(lpad(CAST(length({digits}) AS STRING), 10, '0'), {digits}, '.', rtrim('0', split_part({text}, '.', 2)))"


def beyond_text_sql(text: str, bound, above: bool) -> str:
    """Whether a plain number text is above (or below) a bound, by its sign and digits alone."""
    bound = Decimal(str(bound))
    whole, _, part = f"{abs(bound):f}".partition(".")
    limit = size_key(whole.lstrip("0"), part.rstrip("0"))
    negative, size = f"startswith({text}, '-')", size_sql(text)
    if above:
        return f"(NOT {negative} AND {size} > '{limit}')" if bound >= 0 else f"(NOT {negative} OR {size} < '{limit}')"
    return f"({negative} AND {size} > '{limit}')" if bound <= 0 else f"({negative} OR {size} < '{limit}')"


def beyond_sql(text: str, number: str, lo=None, hi=None) -> str:
    """Whether a plain number text is outside its bounds, whatever its length; ``number`` is its decimal.

    Texts that the decimal may round, or that don't fit it, are compared digit by digit.
    """
    if lo is None and hi is None:
        return "FALSE"
    sides = [beyond_text_sql(text, lo, False)] if lo is not None else []
    sides += [beyond_text_sql(text, hi, True)] if hi is not None else []
    return f"CASE WHEN length({text}) > {EXACT_LENGTH} THEN {' OR '.join(sides)} ELSE {outside_sql(number, lo, hi)} END"


def fits_sql(number: str, kind: str) -> str:
    """Whether a number rounded to the scale of a type fits it; a number that is NULL doesn't."""
    rounded = f"round({number}, 0)" if kind == "bigint" else number
    return f"TRY_CAST({rounded} AS {kind}) IS NOT NULL"


def clean_numeric(c: str, lo=None, hi=None) -> Column:
    """The number of a column name or SQL text, NULL if there is none or it is out of range."""
    value = number_sql(c)
    if lo is None and hi is None:
        return F.expr(value)
    return F.expr(f"CASE WHEN NOT ({beyond_sql(number_text_sql(c), value, lo, hi)}) THEN {value} END")


def clean_numerics(df: DataFrame, specs: dict[str, tuple]) -> DataFrame:
    """Add cleaned number columns: name to (SQL text, lo, hi).

    Texts are read in one projection, cast in the next and compared in the last, so each is read once;
    inside one expression it would be read again for every mention.
    """
    read = df.withColumns({f"_text_{name}": F.expr(number_text_sql(c)) for name, (c, _, _) in specs.items()})
    read = read.withColumns({f"_number_{name}": F.expr(decimal_sql(f"_text_{name}")) for name in specs})

    def bounded(name: str, lo, hi) -> Column:
        number = f"_number_{name}"
        if lo is None and hi is None:
            return F.col(number)
        return F.expr(f"CASE WHEN NOT ({beyond_sql(f'_text_{name}', number, lo, hi)}) THEN {number} END")

    return read.withColumns({name: bounded(name, lo, hi) for name, (_, lo, hi) in specs.items()}).drop(
        *[f"_{kind}_{name}" for name in specs for kind in ("text", "number")]
    )


def pick(name: Column | str, columns: list[str]) -> Column:
    """Value of the column whose name is in ``name``."""
    name = col(name)
    chain = F.when(name == columns[0], F.col(columns[0]))
    for column in columns[1:]:
        chain = chain.when(name == column, F.col(column))
    return chain


def passed(condition: Column) -> Column:
    """Two-valued flag: unknown counts as not passed."""
    return F.coalesce(condition, F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def classify(rules: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """Label of the first condition that holds."""
    chain = F.when(rules[0][0], F.lit(rules[0][1]))
    for condition, label in rules[1:]:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))
