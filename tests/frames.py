"""Small hand-made panels."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

START = datetime(2024, 1, 1)


def hours(values, start=START, step=1):
    return [(start + timedelta(hours=i * step), v) for i, v in enumerate(values)]


def series(spark, values, zone="a", start=START):
    rows = [(zone, at, v) for at, v in hours(values, start)]
    return spark.createDataFrame(rows, "zone string, datetime timestamp, y double")


def gappy_panel(spark, seed=7, days=60, hot_share=0.9):
    """One zone with most rows and two thin ones, a third of the hours missing, some values null."""
    rng = random.Random(seed)
    rows = []
    for zone, keep in (("hot", hot_share), ("thin", 0.3), ("rare", 0.02)):
        for i in range(days * 24):
            if rng.random() < keep:
                y = None if rng.random() < 0.1 else round(rng.uniform(-50, 200), 3)
                rows.append((zone, START + timedelta(hours=i), y, round(rng.uniform(-20, 30), 2)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "zone string, datetime timestamp, y double, t double")
