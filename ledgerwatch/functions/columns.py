"""SQL texts shared by the operators.

Expressions are built as SQL text: one text is one call into the JVM, where the same
expression put together from column objects is dozens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Amounts are added up as decimals of 1/10,000 units with four more digits, as sums of decimals do
# not depend on the order of the rows. Twenty digits in front of the point are more than all
# money there is; sums have room for 10^14 of them.
UNITS = 10_000
TOTAL = "decimal(38,4)"


def to_units(amount: str = "amount") -> str:
    return f"cast(cast({amount} as decimal(28,8)) * {UNITS} as decimal(32,4))"


def from_units(units: str) -> str:
    return f"cast({units} as double) / {UNITS}D"


def exact_sum(units: str) -> str:
    """The sum of any number of amounts."""
    return f"sum(cast({units} as {TOTAL}))"


def micros(ts: str = "event_time") -> str:
    return f"unix_micros(cast({ts} as timestamp))"


def from_micros(us: str, like: DataFrame, column: str) -> str:
    """A timestamp of the same type as ``column`` of ``like``."""
    return f"cast(timestamp_micros({us}) as {like.schema[column].dataType.simpleString()})"


def floor_to(us: str, width: int | str) -> str:
    """The start of the bin of ``width`` that holds ``us``, also before 1970."""
    return f"({us} - pmod({us}, {width}))"


def rounded(value: str, places: int) -> str:
    """Half-up rounding of the decimal value, so ties do not depend on binary noise.

    Doubles too large for the decimal have no digits to round; they stay as they are, as does NaN.
    """
    return f"coalesce(cast(round(try_cast({value} as decimal(30,12)), {places}) as double), {value})"


def ratio(part: str, whole: str) -> str:
    """``part / whole`` with a divisor of at least one."""
    return f"cast({part} as double) / cast(greatest({whole}, 1) as double)"


def text(value: str) -> str:
    return "'" + value.replace("'", "\\'") + "'"


def text_list(values: list[str]) -> str:
    return ", ".join(text(v) for v in values)
