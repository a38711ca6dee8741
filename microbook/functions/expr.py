"""Column expressions: safe arithmetic, rolling frames, folds over column lists."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F


def div(a: Column, b: Column) -> Column:
    """Quotient, null where the divisor is zero (ANSI mode would raise)."""
    return a / F.nullif(b, F.lit(0).cast("double"))


def add_all(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def any_of(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns, F.lit(False))


def clip(value: Column, low: Column, high: Column) -> Column:
    """`value` held in [low, high]; null stays null (least/greatest alone would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def to_double(text: Column) -> Column:
    """Number from text; null when it is not one, never zero."""
    return text.try_cast("double")


def price_key(price: Column) -> Column:
    """Fixed-point price, eight decimals, truncated."""
    return (price * F.lit(1e8)).cast("bigint")


_ROLL = {"sum": F.sum, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
SHORT = 16  # frames up to this length are walked row by row


def _powers(n: int) -> list[int]:
    """The powers of two that add up to `n`, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _both(pick: str, a: str, b: str) -> str:
    """least or greatest of two values, null if one is."""
    return f"case when {a} is not null and {b} is not null then {pick}({a}, {b}) end"


def add_rolling(df: DataFrame, window: WindowSpec, specs: dict[str, tuple[str, Column, int]]) -> DataFrame:
    """Add aggregates (kind, value, n) of the last `n` rows; null until there are `n`, none of them null.

    Spark walks a sliding frame anew for every row. Longer frames are put together by doubling: the
    aggregate of 2k rows is that of the last k and of the k before them, one `lag` away, so a row
    costs log(n) instead of n. Nulls spread through the arithmetic and give the warm-up rule. Kinds
    are sum, mean, std (sample), min and max; deviations merge means and squared deviations.
    """
    values: dict[str, tuple[str, Column]] = {}
    for _, x, _ in specs.values():
        values.setdefault(str(x), (f"_x{len(values)}", x.cast("double")))
    df = df.withColumns(dict(values.values()))

    longest: dict[tuple[str, str], int] = {}  # (family, value) -> longest frame
    for kind, x, n in specs.values():
        family = "sum" if kind == "mean" else kind
        if n > SHORT:
            key = (family, values[str(x)][0])
            longest[key] = max(longest.get(key, 0), n)

    def part(family: str, name: str, rows: int) -> str:
        return name if rows == 1 and family != "std" else f"{name}_{family}_{rows}"

    added = [name for name, _ in values.values()]

    def lagged(d: DataFrame, wanted: dict[str, tuple[str, int]]) -> DataFrame:
        added.extend(wanted)
        return d.withColumns({out: F.lag(c, k).over(window) for out, (c, k) in wanted.items()}) if wanted else d

    def computed(d: DataFrame, new: dict[str, str]) -> DataFrame:
        return d.withColumns({out: F.expr(text) for out, text in new.items()}) if new else d

    start = {}
    for family, name in longest:
        if family == "std":
            start |= {part("std", name, 1): name, part("std", name, 1) + "q": f"{name} * 0"}
    df = computed(df, start)
    added += list(start)
    rows = 2
    while any(n >= rows for n in longest.values()):
        half, before, new = rows // 2, {}, {}
        for (family, name), n in longest.items():
            if n < rows:
                continue
            a, out = part(family, name, half), part(family, name, rows)
            b = out + "b"
            before[b] = (a, half)
            if family == "sum":
                new[out] = f"{a} + {b}"
            elif family == "std":
                before[b + "q"] = (a + "q", half)
                new[out] = f"({a} + {b}) / 2"
                new[out + "q"] = f"{a}q + {b}q + ({a} - {b}) * ({a} - {b}) * {half / 2}D"
            else:
                new[out] = _both("least" if family == "min" else "greatest", a, b)
        df = computed(lagged(df, before), new)
        added += list(new)
        rows *= 2

    results: dict[str, str | Column] = {}
    before = {}

    def at(column: str, offset: int) -> str:
        if not offset:
            return column
        before[f"{column}_{offset}"] = (column, offset)
        return f"{column}_{offset}"

    for out, (kind, x, n) in specs.items():
        name = values[str(x)][0]
        if n <= SHORT:
            frame = window.rowsBetween(-(n - 1), 0)
            results[out] = F.when(F.count(name).over(frame) == n, _ROLL[kind](name).over(frame))
            continue
        family = "sum" if kind == "mean" else kind
        if kind in ("min", "max"):
            top = _powers(n)[0]
            column = part(family, name, top)
            results[out] = column if top == n else _both("least" if kind == "min" else "greatest", column, at(column, n - top))
            continue
        pieces, offset = [], 0
        for rows in _powers(n):
            pieces.append((rows, part(family, name, rows), offset))
            offset += rows
        if kind == "std":
            mean = "(" + " + ".join(f"{at(c, o)} * {r}" for r, c, o in pieces) + f") / {n}D"
            squares = " + ".join(f"{at(c + 'q', o)} + pow({at(c, o)} - ({mean}), 2D) * {r}" for r, c, o in pieces)
            results[out] = f"sqrt(({squares}) / {n - 1}D)"
        else:
            total = " + ".join(at(c, o) for _, c, o in pieces)
            results[out] = f"({total}) / {n}D" if kind == "mean" else total
    df = lagged(df, before)
    df = df.withColumns({out: F.expr(r) if isinstance(r, str) else r for out, r in results.items()})
    return df.drop(*added)


def step(value: Column, window: WindowSpec, k: int = 1) -> Column:
    """Difference to the value `k` rows before."""
    return value - F.lag(value, k).over(window)


def snap(value: Column, digits: int = 6) -> Column:
    """Rounded down after adding just over half a unit: equal in engines that add in other orders."""
    scale = F.lit(float(10**digits))
    return F.floor(value * scale + F.lit(0.5003)).cast("double") / scale
