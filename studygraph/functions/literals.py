"""Texts that a match of a pattern must hold, so that a pattern is only tried where it can match."""

from __future__ import annotations

from functools import cache
from re import _constants as C
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F


def _better(a: tuple[str, ...], b: tuple[str, ...]) -> tuple[str, ...]:
    """The alternatives whose shortest is longer, then the fewer ones."""
    worth = lambda x: (min(map(len, x)), -len(x)) if x else (0, 0)
    return b if worth(b) > worth(a) else a


def _required(parts) -> tuple[str, ...]:
    best: tuple[str, ...] = ()
    run = ""
    for op, arg in parts:
        if op is C.LITERAL:
            run += chr(arg)
            continue
        best, run = _better(best, (run,) if run else ()), ""
        if op is C.SUBPATTERN:
            best = _better(best, _required(arg[3]))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0] > 0:
            best = _better(best, _required(arg[2]))
        elif op is C.BRANCH:
            each = [_required(alternative) for alternative in arg[1]]
            if all(each):
                best = _better(best, tuple(dict.fromkeys(x for e in each for x in e)))
    return _better(best, (run,) if run else ())


@cache
def required(pattern: str) -> tuple[str, ...]:
    """Texts of which every match of a pattern holds one; none if no such text is known. Patterns are in lower case."""
    return _required(_parser.parse(pattern))


def can_match(low: Column, pattern: str) -> Column:
    """Whether a text in lower case holds one of the texts that a match needs; true where none is known."""
    out = F.lit(not required(pattern))
    for text in required(pattern):
        out = out | F.contains(low, F.lit(text))
    return out
