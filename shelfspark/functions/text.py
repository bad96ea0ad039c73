"""Column functions for the reference's scalar semantics.

All of these are plain Catalyst expressions: they stay in the JVM and inside
whole-stage codegen (higher-order lambdas are evaluated by the JVM too).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_flags(pattern: str, ignore_case: bool = False) -> str:
    """Make a warehouse (RE2) pattern behave the same under Java regex.

    ``d`` (UNIX_LINES) makes ``.`` stop only at ``\\n`` as in RE2; ``iu``
    gives Unicode case folding (``MIÉRCOLES`` ~ ``miércoles``).  ``U`` is never
    added: it would widen ``\\d``/``\\w``/``\\s`` beyond ASCII.
    """
    return ("(?iud)" if ignore_case else "(?d)") + pattern


# The characters str.strip() removes: by rule, every code point whose
# str.isspace() is true (none lies above U+3000).
STRIP_CHARS = "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())


def ustrip(c: ColumnOrName) -> Column:
    """TRIM()/str.strip(): remove leading/trailing Unicode whitespace.

    Spark's ``trim`` removes only ASCII spaces (trap #1); ``btrim`` with the
    explicit whitespace set is a plain character scan, no regex."""
    return F.btrim(_c(c), F.lit(STRIP_CHARS))


def nullif_empty(c: ColumnOrName) -> Column:
    """Warehouse REGEXP_EXTRACT/STRING_AGG give NULL where Spark gives ''."""
    return F.nullif(_c(c), F.lit(""))


def regexp_extract_or_null(c: ColumnOrName, pattern: str, group: int = 1) -> Column:
    return nullif_empty(F.regexp_extract(_c(c), java_flags(pattern), group))


def json_quote(c: ColumnOrName) -> Column:
    """JSON-encode a string as a JSON string literal (``to_json`` rejects
    bare strings, so encode a one-element array and drop the brackets)."""
    # the inner literal starts with '"' or 'n' and ends with '"' or 'l', so
    # stripping bracket characters removes exactly the array brackets
    return F.btrim(F.to_json(F.array(_c(c))), F.lit("[]"))


def python_json_quote(c: ColumnOrName) -> Column:
    """``json.dumps(s, ensure_ascii=False)``: as ``json_quote`` but U+2028 and
    U+2029 stay literal (Jackson escapes them, Python does not).  Only an
    escape preceded by an even run of backslashes is a real escape."""
    x = json_quote(c)
    for cp in ("2028", "2029"):
        x = F.regexp_replace(x, r"(?<!\\)((?:\\\\)*)\\u" + cp, "$1" + chr(int(cp, 16)))
    return x


def json_array_text(c: ColumnOrName, sep: str = ", ") -> Column:
    """JSON text of an array of strings with Python's default item separator
    (``json.dumps(list, ensure_ascii=False)`` writes ``["a", "b"]``)."""
    arr = _c(c)
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: python_json_quote(x)), sep, "null"),
                    F.lit("]"))


_DELIMS = re.escape(P.INITCAP_DELIMITERS)


def title_case(c: ColumnOrName) -> Column:
    """Warehouse INITCAP: lower-case, then upper-case the first character of
    every word; words are split at whitespace *and* punctuation delimiters
    (Spark's ``initcap`` splits at spaces only, trap #5)."""
    tokens = F.regexp_extract_all(F.lower(_c(c)), F.lit(rf"[^\s{_DELIMS}]+|[\s{_DELIMS}]"), 0)
    return F.array_join(
        F.transform(tokens, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30))),
        "")


def clean_product_name(c: ColumnOrName) -> Column:
    """trim(upper(regexp_replace(s, '[^\\w\\s]', ''))) with ASCII \\w."""
    return ustrip(F.upper(F.regexp_replace(_c(c), P.NON_WORD_RE, "")))


def last_path_segment(c: ColumnOrName) -> Column:
    """``url.split('/')[-1]``."""
    return F.element_at(F.split(_c(c), "/", -1), -1)


def time_of_day(c: ColumnOrName) -> Column:
    """F16 TIME(ts) rendered as text (TIME is not a Spark 4.1 column type)."""
    return F.date_format(_c(c), "HH:mm:ss.SSSSSS")


def key_timestamp(c: ColumnOrName) -> Column:
    """F23 ``strftime('%Y%m%d_%H%M%S')``."""
    return F.date_format(_c(c), "yyyyMMdd_HHmmss")


def current_datetime() -> Column:
    """F17 ``CURRENT_DATETIME()``: a zone-less 'now'.  Load times are job
    parameters in this library; this is only the default."""
    return F.localtimestamp()


def parse_iso_timestamp(c: ColumnOrName) -> Column:
    """ISO-8601 text (``datetime.isoformat()``, up to 6 fractional
    digits) -> TIMESTAMP."""
    return F.to_timestamp(_c(c))
