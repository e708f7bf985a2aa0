"""Identifier, date, whitespace and judge-title expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketry import constants as C

# Java's \s is ASCII only; this class has the members of unicode whitespace. Written out, those below 256
# are one table lookup, and the range in front of the others turns nearly all characters down at once.
WS = (
    r"[\t\n\x0B\f\r\x1C\x1D\x1E\x1F \x85\xA0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]]]"
)


def rx(pattern: str, flags: str = "") -> str:
    """Pattern with unicode whitespace; ``flags`` like ``i``, ``iu`` or ``ius``.

    ``u`` (case folding beyond ASCII) is slow and only needed by patterns with
    accented letters.
    """
    return (f"(?{flags})" if flags else "") + pattern.replace(r"\s", WS)


def any_of(patterns: list[str], flags: str = "") -> str:
    """One alternation for a set of patterns whose identity does not matter."""
    return rx("|".join(patterns), flags)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a costly value once for a body that uses it several times.

    Conditionals and lambdas are outside common-subexpression elimination, so a
    regex written twice there also runs twice.
    """
    # not F.get, which holds its argument twice: nested lets would double the plan at each level
    return F.transform(F.array(value), body)[0]


def present(value: Column, test: Callable[[Column], Column] | None = None) -> Column:
    """Generator that keeps the rows whose computed value passes (is not NULL).

    A filter on a computed column is pushed below its projection and computes
    the value once more; a generator computes it once.
    """
    return F.explode(F.filter(F.array(value), test or (lambda v: v.isNotNull())))


def non_empty(c: Column) -> Column:
    """'' becomes NULL."""
    return let(c, lambda v: F.when(v != "", v))


def first_group(c: Column, pattern: str, flags: str = "", group: int = 1) -> Column:
    """First match's group, NULL when the pattern does not match or is empty."""
    return non_empty(F.regexp_extract(c, rx(pattern, flags), group))


def strip(c: Column) -> Column:
    # looked for at the start of a run only, so long inner runs cost nothing extra
    return F.regexp_replace(c, f"^{WS}++|(?<!{WS}){WS}++$", "")


def clean_text(c: Column) -> Column:
    """Collapse every whitespace run to one space and trim; NULL becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(c, f"{WS}+", " ")), F.lit(""))


def digits(c: Column) -> Column:
    """Only the digits; NULL becomes ''. Serves case numbers and tax ids."""
    return F.coalesce(F.regexp_replace(c, r"(?U)\D", ""), F.lit(""))


npu_digits = digits
cnpj_digits = digits


def npu_hyphenated(c: Column) -> Column:
    """20 digits -> NNNNNNN-DD.AAAA.J.TR.OOOO; anything else is left as it is."""

    def shape(only: Column) -> Column:
        grouped = F.regexp_replace(
            only, r"(?U)^(\d{7})(\d{2})(\d{4})(\d)(\d{2})(\d{4})$", r"$1-$2.$3.$4.$5.$6"
        )
        return F.when(F.length(only) == C.NPU_DIGITS, grouped).otherwise(F.coalesce(c, F.lit("")))

    return let(digits(c), shape)


def br_date_to_iso(c: Column) -> Column:
    """``d/m/yyyy[ h:m]`` prefix -> ISO text; impossible calendar values -> NULL.

    Works on zone-free types, so a session zone with DST gaps cannot move a value.
    """

    def parse(s: Column) -> Column:
        stamp = F.regexp_replace(s, rx(C.DATE_TIME_PREFIX, "s") + ".*$", "$3-$2-$1 $4:$5:00")
        day = F.regexp_replace(s, rx(C.DATE_PREFIX, "s") + ".*$", "$3-$2-$1")
        return (
            F.when(s.rlike(r"^\d{1,2}/\d{1,2}/0000"), None)
            .when(
                s.rlike(rx(C.DATE_TIME_PREFIX)),
                F.replace(stamp.try_cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T")),
            )
            .when(s.rlike(C.DATE_PREFIX), day.try_cast("date").cast("string"))
        )

    return let(strip(c), parse)


def strip_judge_title(c: Column) -> Column:
    """Remove the titles in their fixed order, each once."""
    bare = reduce(
        lambda col, title: F.regexp_replace(col, rx(title, "i"), ""),
        C.JUDGE_TITLES,
        clean_text(c),
    )
    return clean_text(bare)


def js_round(c: Column) -> Column:
    """Half-up rounding towards +infinity, as report percentages use."""
    return F.floor(c + F.lit(0.5))


def content_hash(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))
