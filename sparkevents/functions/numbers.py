"""Number text that parsing would change, kept through VARIANT values.

A VARIANT holds numbers by value, so ``1.10``, ``1e3`` or 44 digits would print otherwise than they came. Before a body is
parsed, such numbers become strings that begin with a mark; after it is printed, marked strings become numbers again.
Strings of the body that begin with the mark themselves get a second one on the way in and lose it on the way out.
The patterns read a body token by token from its start (``\\G``) with possessive loops, so text inside of strings is never
touched, time is linear, and a body that is no JSON stays none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "\ue000"

_REST_OF_STRING = r'[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][-+]?[0-9]++)?(?=[\s,}\]]|$)"
# an exponent, a last zero after the point, more digits than a 64-bit integer has, or a negative zero
_CHANGED = r"(?=-?[0-9]++(?:\.[0-9]++)?[eE]|-?[0-9]++\.[0-9]*0(?![0-9])|-?[0-9.]{19}|-0)" + _NUMBER
_OTHERS = rf'(?:[^"0-9-]++|"{_REST_OF_STRING}|(?!{_CHANGED})[-0-9][-+0-9.eE]*+)*+'
_KEPT = rf"(?s)\G({_OTHERS})({_CHANGED})"
#: Whether the pattern above is worth while: such a number behind what may stand before one. It may say yes because of a string.
_HINT = rf"(?:^|[\s\[,:]){_CHANGED}"

_MARKED = rf"(?:{MARK}|\\u[eE]000)"
_TWICE = rf'(?s)\G((?:[^"]++|"(?!{_MARKED}){_REST_OF_STRING})*+)"({_MARKED}{_REST_OF_STRING})'

_TOKENS = rf'(?s)"{_REST_OF_STRING}|[\[\]{{}},:]|[^\[\]{{}},:"]++'


def keep(body: Column) -> Column:
    """JSON text in which the numbers that parsing would change are marked strings."""
    marked = F.contains(body, F.lit(MARK)) | F.contains(body, F.lit("\\ue000")) | F.contains(body, F.lit("\\uE000"))
    safe = F.when(marked, F.regexp_replace(body, _TWICE, f'$1"{MARK}$2')).otherwise(body)
    return F.when(body.rlike(_HINT), F.regexp_replace(safe, _KEPT, f'$1"{MARK}$2"')).otherwise(safe)


def is_kept(v: Column) -> Column:
    """Whether a value is a number held as a marked string."""
    return F.coalesce(v.try_cast("string").rlike(rf"^{MARK}[-0-9]"), F.lit(False))


def unmarked(plain: Column) -> Column:
    """Text without the mark of a kept number."""
    return F.when(plain.startswith(MARK), F.substr(plain, F.lit(2))).otherwise(plain)


def unmarked_string(plain: Column) -> Column:
    """Text of a string without the second mark; NULL for a kept number."""
    string = F.when(~plain.rlike(f"^{MARK}[-0-9]"), F.substr(plain, F.lit(2)))
    return F.when(plain.startswith(MARK), string).otherwise(plain)


def text(v: Column) -> Column:
    """Text of a scalar value; a kept number prints as it came."""
    return unmarked(v.cast("string"))


def json(v: Column) -> Column:
    """JSON text of a value; kept numbers print as they came."""
    out = F.to_json(v)
    numbers = F.regexp_replace(out, rf'(?<=[:,\[])"{MARK}([-0-9][-+0-9.eE]*)"', "$1")
    back = F.regexp_replace(numbers, rf'(?<=[:,\[{{])"{MARK}{MARK}', f'"{MARK}')
    return F.when(F.contains(out, F.lit(MARK)), back).otherwise(out)


def spaced(v: Column) -> Column:
    """Text of a list or an object at any depth: ``[a b]`` and ``map[k:v]`` with keys in byte order, strings without quotes,
    ``<nil>`` for null. Each token of the JSON text stands for one piece of the result, so nothing is nested."""

    def piece(token: Column) -> Column:
        inner = F.substr(token, F.lit(2), F.length(token) - 2)
        plain = F.when(F.contains(token, F.lit("\\")), F.try_parse_json(token).cast("string")).otherwise(inner)
        return (
            F.when(token == ",", " ").when(token == "{", "map[").when(token == "}", "]").when(token == "null", "<nil>")
            .when(token.startswith('"'), F.when(plain.startswith(MARK), F.substr(plain, F.lit(2))).otherwise(plain))
            .otherwise(token)
        )

    return F.array_join(F.transform(F.regexp_extract_all(F.to_json(v), F.lit(_TOKENS), F.lit(0)), piece), "")
