"""Before / after effect of an action."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions.numbers import ratio, rnd

# Result labels.
IMPROVED, WORSE = "개선", "악화"


def action_effect(windows: DataFrame, higher_is_better: dict[str, bool]) -> DataFrame:
    """Delta, change in percent and a direction-aware label per metric of an event window join."""
    out = windows
    for m, up in higher_is_better.items():
        now, before = F.col(f"{m}_next"), F.col(f"{m}_prev")
        good = now >= before if up else now <= before
        out = out.withColumns(
            {
                f"{m}_delta": now - before,
                f"{m}_change_pct": rnd(ratio(now - before, F.abs(before)) * 100, 1),
                f"{m}_result": F.when(good, IMPROVED).when(~good, WORSE),
            }
        )
    return out
