"""String helpers with the exact semantics the pipeline's messages need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def java_space_split(x) -> Column:
    """Split on a single space the way ``Pattern.compile(" ").split`` does.

    Leading and inner empty tokens are kept, trailing empty tokens are
    dropped, ``""`` gives ``[""]`` and a spaces-only string gives ``[]``.
    Only the space character is trimmed (tabs/newlines stay in tokens).
    """
    s = _c(x)
    right_trimmed = F.rtrim(s, F.lit(" "))
    return (F.when((s != F.lit("")) & (right_trimmed == F.lit("")),
                   F.array().cast("array<string>"))
            .otherwise(F.split(right_trimmed, " ", -1)))


def lines_of(x) -> Column:
    """Lines as a buffered line reader returns them: split on CR, LF or
    CRLF; a final line terminator does not start an extra empty line and an
    empty text has no lines."""
    s = _c(x)
    parts = F.split(s, "\r\n|\r|\n", -1)
    n = F.size(parts)
    return F.when(F.element_at(parts, -1) == F.lit(""),
                  F.slice(parts, 1, n - 1)).otherwise(parts)


def java_hash(x) -> Column:
    """``String.hashCode()`` as a signed 32-bit int.

    h = 31*h + c over UTF-16 code units. Characters outside the BMP count as
    two units (high then low surrogate), as in Java.
    """
    s = _c(x)
    chars = F.split(s, "", -1)
    mask = F.lit(4294967295)

    def step(acc, ch):
        cp = F.ascii(ch).cast("long")
        off = cp - F.lit(65536)
        hi = F.lit(55296) + F.shiftright(off, 10)
        lo = F.lit(56320) + off.bitwiseAND(F.lit(1023))
        bmp = (acc * 31 + cp).bitwiseAND(mask)
        pair = (((acc * 31 + hi).bitwiseAND(mask)) * 31 + lo).bitwiseAND(mask)
        return F.when(cp > 65535, pair).otherwise(bmp)

    unsigned = F.aggregate(chars, F.lit(0).cast("long"), step)
    signed = F.when(unsigned >= F.lit(2147483648), unsigned - F.lit(4294967296)).otherwise(unsigned)
    return F.when(s.isNull(), F.lit(None)).otherwise(signed.cast("int"))


def pmod_partition(key, n: int, null_spread: int = 255) -> Column:
    """Partition for a message key: ``hashCode mod n`` kept non-negative.

    A null key is spread uniformly (random bucket 0..254, then mod n), like
    the original producer; ``n <= 0`` maps everything to partition 0.
    """
    if n <= 0:
        return F.lit(0)
    k = _c(key)
    rnd = F.floor(F.rand() * null_spread).cast("int")
    return F.pmod(F.coalesce(java_hash(k), rnd), F.lit(n)).cast("int")


def java_concat(*parts) -> Column:
    """``a + b`` on Java strings: a null operand prints as ``"null"``."""
    return F.concat(*[F.coalesce(_c(p).cast("string"), F.lit("null")) for p in parts])


def blank_to_null(x) -> Column:
    """Empty string becomes null (the five optional time fields)."""
    s = _c(x)
    return F.when(s == F.lit(""), F.lit(None).cast("string")).otherwise(s)


def parse_int(x, strict: bool = False) -> Column:
    """Integer parse. ``strict`` raises on bad input like ``parseInt`` (ANSI
    cast); otherwise bad input becomes null so it can be dead-lettered."""
    s = _c(x)
    return s.cast("int") if strict else s.try_cast("int")


# The JSON layout of the outbound POST payload.
POST_TEMPLATE = ('{"id": "%d", "text": "%s", "pos": "%f", "neg": "%f", '
                 '"score": "%s" }')


def printf_json(id_col, text_col, pos_col, neg_col, score_col) -> Column:
    """The POST body byte-for-byte: printf into a JSON-looking template with
    no escaping; ``pos``/``neg`` are single-precision floats."""
    return F.format_string(POST_TEMPLATE, _c(id_col).cast("long"), _c(text_col),
                           _c(pos_col).cast("float"), _c(neg_col).cast("float"),
                           _c(score_col))


def xml_escape(x) -> Column:
    s = _c(x).cast("string")
    s = F.replace(s, F.lit("&"), F.lit("&amp;"))
    s = F.replace(s, F.lit("<"), F.lit("&lt;"))
    s = F.replace(s, F.lit(">"), F.lit("&gt;"))
    return F.replace(s, F.lit('"'), F.lit("&quot;"))
