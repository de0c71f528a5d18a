"""Features by plain loops over sorted rows, to check the Spark ones against."""

from __future__ import annotations

import math

import numpy as np

NAMES = "lag1 lag2 lag3 MA5 MA10 MA20 rolling_mean rolling_std price_change pct_change target".split()


def usable(x):
    return x is not None and not math.isnan(x) and not math.isinf(x)


def features_of(rows, profile):
    """rows: dicts with ticker, event_time, seq, price, volume."""
    out = []
    groups = {}
    for row in rows:
        if row["ticker"] is not None and row["event_time"] is not None:
            groups.setdefault(row["ticker"], []).append(row)
    for group in groups.values():
        group.sort(key=lambda r: (r["event_time"], r["seq"]))
        prices = [r["price"] for r in group]
        for i, row in enumerate(group):
            made = one(prices, i, profile)
            values = [row["price"], row["volume"], *made.values()]
            if any(v is None or (isinstance(v, float) and math.isnan(v)) for v in values):
                continue
            out.append({**row, **made})
    return out


def one(prices, i, profile):
    def at(j):
        return prices[j] if 0 <= j < len(prices) else None

    def window(n):
        return prices[max(0, i - n + 1) : i + 1]

    def mean(n):
        w = window(n)
        if profile.full_windows:
            return float(np.mean(w)) if len(w) == n and all(map(usable, w)) else None
        w = [x for x in w if x is not None]
        return float(np.mean(w)) if w else None

    def std(n):
        w = window(n)
        if profile.full_windows:
            return float(np.std(w, ddof=1)) if len(w) == n and all(map(usable, w)) else None
        w = [x for x in w if x is not None]
        with np.errstate(all="ignore"):
            return float(np.std(w, ddof=1)) if len(w) > 1 else None

    price, before = prices[i], at(i - 1)
    change = None if price is None or before is None else price - before
    if change is None:
        relative = None
    elif before == 0:
        zero = math.nan if price == 0 or math.isnan(price) else math.copysign(math.inf, price)
        relative = None if profile.percent else zero
    elif profile.percent:
        relative = change / before * 100
    else:
        relative = price / before - 1
    return {
        "lag1": before,
        "lag2": at(i - 2),
        "lag3": at(i - 3),
        "MA5": mean(5),
        "MA10": mean(10),
        "MA20": mean(20),
        "rolling_mean": mean(profile.spread),
        "rolling_std": std(profile.spread),
        "price_change": change,
        "pct_change": relative,
        "target": at(i + profile.horizon),
    }


def close(got, want):
    """Same rows, doubles within 1e-9 (relative to their size)."""

    def key(row):
        return (row["ticker"], row["event_time"], row["seq"])

    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [key(r) for r in got] == [key(r) for r in want]
    for a, b in zip(got, want):
        for name in ["price", "volume", *NAMES]:
            same = a[name] == b[name] or math.isclose(a[name], b[name], rel_tol=1e-9, abs_tol=1e-7)
            assert same, (name, a, b)
