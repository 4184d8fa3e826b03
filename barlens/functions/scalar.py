"""Scalar expressions used by the bar, universe and signal operators.

Every function takes and returns ``Column`` objects, so they stay inside
whole-stage codegen. Text-to-number conversions use ``try_cast``: with ANSI
mode on, a plain cast of a bad value would fail the whole job, so bad values
become NULL here and are counted by the callers' quarantine outputs.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from barlens.schemas import PRICE

# Fixed values that must equal the reference's: market-cap bucket bounds and
# labels. First matching rule wins; both bounds of BETWEEN are inclusive.
LARGE_CAP_ABOVE = 2000000000000        # > 2e12            -> Large Cap
MID_CAP_RANGE = (500000000000, 2000000000000)   # [5e11, 2e12] -> Mid Cap
SMALL_CAP_RANGE = (50000000000, 500000000000)   # [5e10, 5e11] -> Small Cap
MICRO_CAP_BELOW = 50000000000          # < 5e10            -> Micro Cap
CAP_LABELS = ("Unknown", "Large Cap", "Mid Cap", "Small Cap", "Micro Cap", "Other")

# The named HTML entities, from Python's own table of them.
HTML_ENTITIES = {name.rstrip(";"): text for name, text in html5.items() if name.endswith(";")}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_price(text) -> Column:
    """Text price with `,` grouping -> DECIMAL(10,4); NULL when not a number."""
    return F.replace(F.trim(_c(text)), F.lit(","), F.lit("")).try_cast(PRICE)


def parse_count(text) -> Column:
    """Text count -> BIGINT via DECIMAL, so `'12.0'` (a float round-trip) is 12."""
    return (F.replace(F.trim(_c(text)), F.lit(","), F.lit(""))
            .try_cast("decimal(38,4)").try_cast("bigint"))


def after_first_colon(text) -> Column:
    """Everything after the first `:`; NULL when there is no colon."""
    t = _c(text)
    pos = F.instr(t, ":")
    return F.when(pos > 0, F.substr(t, pos + 1))


def normalize_code(text) -> Column:
    """Screen code normalisation: upper(trim(x))."""
    return F.upper(F.trim(_c(text)))


def decode_entities(text) -> Column:
    """Named, decimal and hexadecimal entities, each decoded once; unknown names stay.

    The text is cut before every ``&``; each piece then begins with at most one entity,
    so what an entity decodes to is never read as the beginning of another one.
    """
    named = F.from_json(F.lit(json.dumps(HTML_ENTITIES)), "map<string,string>")  # one folded literal

    def piece(x: Column) -> Column:
        name = F.regexp_extract(x, r"^&([A-Za-z][A-Za-z0-9]*);", 1)
        digits = F.regexp_extract(x, r"^&#([0-9]{1,7});", 1)
        hexed = F.regexp_extract(x, r"^&#[xX]([0-9A-Fa-f]{1,6});", 1)
        code = F.when(digits != "", digits.cast("int")).when(hexed != "", F.conv(hexed, 16, 10).cast("int"))
        sign = F.when(code.between(1, 0x10FFFF), _code_point(code)).when(name != "", F.try_element_at(named, name))
        rest = F.regexp_replace(x, r"^&#?[A-Za-z0-9]+;", "")
        return F.when(sign.isNotNull(), F.concat(sign, rest)).otherwise(x)

    t = _c(text)
    decoded = F.array_join(F.transform(F.split(t, "(?=&)"), piece), "")
    return F.when(F.instr(t, "&") > 0, decoded).otherwise(t)


def _code_point(code: Column) -> Column:
    """The character of a code point (its UTF-8 bytes, put together)."""
    def byte(x):
        return F.lpad(F.hex(x.cast("bigint")), 2, "0")

    tail = lambda shift: byte(F.shiftright(code, shift).bitwiseAND(F.lit(0x3F)) + 0x80)
    utf8 = (F.when(code < 0x80, byte(code))
            .when(code < 0x800, F.concat(byte(F.shiftright(code, 6) + 0xC0), tail(0)))
            .when(code < 0x10000, F.concat(byte(F.shiftright(code, 12) + 0xE0), tail(6), tail(0)))
            .otherwise(F.concat(byte(F.shiftright(code, 18) + 0xF0), tail(12), tail(6), tail(0))))
    return F.decode(F.unhex(utf8), "UTF-8")


def strip_space(text) -> Column:
    """Without white space of any kind (no-break spaces too) on both ends (SC-12)."""
    return F.regexp_replace(_c(text), r"(?U)^[\s\u00A0]+|[\s\u00A0]+$", "")


def cap_bucket(market_cap) -> Column:
    m = _c(market_cap)
    return (F.when(m.isNull(), "Unknown")
            .when(m > LARGE_CAP_ABOVE, "Large Cap")
            .when(m.between(*MID_CAP_RANGE), "Mid Cap")
            .when(m.between(*SMALL_CAP_RANGE), "Small Cap")
            .when(m < MICRO_CAP_BELOW, "Micro Cap")
            .otherwise("Other"))


def crossover(fast, slow, prev_fast, prev_slow, strict: bool = True) -> Column:
    """BUY when fast crosses above slow, SELL when it crosses below, else NULL.

    strict: the previous pair must be strictly on the other side; the loose
    form accepts a touch (`<=` / `>=`). NULL inputs give no signal.
    """
    f, s, pf, ps = map(_c, (fast, slow, prev_fast, prev_slow))
    if strict:
        up, down = pf < ps, pf > ps
    else:
        up, down = pf <= ps, pf >= ps
    return F.when((f > s) & up, "BUY").when((f < s) & down, "SELL")


def yyyymmdd(d) -> Column:
    return F.date_format(_c(d), "yyyyMMdd")


def year_text(d) -> Column:
    return F.date_format(_c(d), "yyyy")


def quarter_start(d) -> Column:
    return F.date_trunc("quarter", _c(d)).cast("date")


def wall_clock(value) -> Column:
    """A TIMESTAMP_NTZ literal for a naive datetime (or ISO text), built from
    text so that no session or process time zone shifts the wall clock."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")
