"""Date parts as SQL text, so that a DataFrame projection and a saved model stage share one definition."""

from __future__ import annotations

from tabforge.functions.columns import quote

PART_NAMES = (
    "year",
    "month",
    "day",
    "dayofweek",
    "quarter",
    "weekofyear",
    "dayofyear",
    "is_month_end",
    "is_weekend",
)
CYCLE_NAMES = ("month_sin", "month_cos", "dow_sin", "dow_cos")


def part_sql(ts: str) -> dict[str, str]:
    """Name -> SQL for a timestamp expression ``ts``. Monday is day 0; ISO weeks.

    A missing date gives NULL parts but 0 in the two flags.
    """
    return {
        "year": f"year({ts})",
        "month": f"month({ts})",
        "day": f"dayofmonth({ts})",
        "dayofweek": f"weekday({ts})",
        "quarter": f"quarter({ts})",
        "weekofyear": f"CAST(weekofyear({ts}) AS DOUBLE)",
        "dayofyear": f"dayofyear({ts})",
        "is_month_end": f"coalesce(CAST(CAST({ts} AS DATE) = last_day({ts}) AS INT), 0)",
        "is_weekend": f"coalesce(CAST(weekday({ts}) >= 5 AS INT), 0)",
    }


def cycle_sql(ts: str) -> dict[str, str]:
    """Month and weekday as points on a circle, so that December is next to January."""
    return {
        "month_sin": f"sin(2 * pi() * month({ts}) / 12)",
        "month_cos": f"cos(2 * pi() * month({ts}) / 12)",
        "dow_sin": f"sin(2 * pi() * weekday({ts}) / 7)",
        "dow_cos": f"cos(2 * pi() * weekday({ts}) / 7)",
    }


def parse_sql(name: str, formats: tuple[str, ...] = ()) -> str:
    """SQL for a lenient, zone-free timestamp of a column, for use inside a model stage."""
    text = f"CAST({quote(name)} AS STRING)"
    tries = [f"try_cast({text} AS TIMESTAMP_NTZ)"]
    tries += [f"CAST(try_to_timestamp({text}, '{p}') AS TIMESTAMP_NTZ)" for p in formats]
    return tries[0] if len(tries) == 1 else "coalesce(" + ", ".join(tries) + ")"
