from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def rarely(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` outside of generated code, as the function of a one-item array.

    For long expressions that few rows need: written out, they would make the method of the whole projection too long to be
    compiled. Call it within ``when``, which passes it over for the other rows.
    """
    return F.get(F.transform(F.array(value), f), F.lit(0))
