"""Small sequential models, written from the specification, to compare with."""

from __future__ import annotations

import random


def thin(positions, distance):
    kept, last = [], None
    for p in sorted(positions):
        if last is None or p - last >= distance:
            kept.append(p)
            last = p
    return kept


def percentile(values):
    """Of the last one among all, ties sharing the mean of their ranks, in percent."""
    newest = values[-1]
    less = sum(v < newest for v in values)
    same = sum(v == newest for v in values)
    return (less + (same + 1) / 2) / len(values) * 100


def run_trades(closes, signals, stop_pct=0.02, trail_pct=0.015, leverage=1.0, capital=100.0, decimals=None):
    """Walk the bars. ``signals``: idx -> (side, copies). Returns trades and (position, equity)."""
    trades, curve = [], [(0, capital)]
    held = None
    for i in range(1, len(closes)):
        price = closes[i]

        def leave(reason):
            nonlocal held, capital
            gain = held["sign"] * (held["size"] * price - held["size"] * held["price"])
            capital += gain
            trades.append(
                (held["sign"], held["idx"], i, held["stake"], held["size"], held["stop"], gain, reason)
            )
            held = None

        if held:
            sign = held["sign"]
            level = price * (1 - sign * trail_pct)
            if sign * level > sign * held["stop"]:
                held["stop"] = level
            if sign * price <= sign * held["stop"]:
                leave("stop")
        side, copies = signals.get(i, (0, 0))
        for _ in range(copies):
            if held is None:
                size = capital * leverage / price
                held = {
                    "sign": side, "idx": i, "price": price, "stake": capital,
                    "size": size if decimals is None else round(size, decimals),
                    "stop": price * (1 - side * stop_pct),
                }
            elif held["sign"] == -side:
                leave("opposite")
        if held:
            sign = held["sign"]
            curve.append((sign, capital + sign * (held["size"] * price - held["size"] * held["price"])))
        else:
            curve.append((0, capital))
    if held:
        price, i = closes[-1], len(closes) - 1
        gain = held["sign"] * (held["size"] * price - held["size"] * held["price"])
        trades.append(
            (held["sign"], held["idx"], i, held["stake"], held["size"], held["stop"], gain, "end")
        )
    return trades, curve


def random_series(seed, bars):
    """Closes that wander, stall and jump, and signals with copies on some bars."""
    r = random.Random(seed)
    step = r.choice([0.0, 0.001, 0.004, 0.012])
    price, closes = 100.0, []
    for _ in range(bars):
        if r.random() < 0.8:
            price *= 1 + r.gauss(0, step)
        closes.append(round(price, 4))
    often = r.choice([0.02, 0.1, 0.5])
    one_sided = r.random() < 0.3
    signals = {}
    for i in range(bars):
        if r.random() < often:
            side = 1 if one_sided else r.choice([1, -1])
            signals[i] = (side, r.choice([1, 1, 2, 3]))
    return closes, signals


def zones(bars, params):
    """Order blocks of one symbol, bar by bar. ``bars``: list of (open, high, low, close, volume)."""
    o, h, l, c, v = (list(x) for x in zip(*bars))
    n = len(bars)

    def mean(values, i, width):
        part = values[max(0, i - width + 1) : i + 1]
        return sum(part) / width if len(part) == width and None not in part else None

    change = [None if i < 4 else (o[i] - o[i - 4]) / o[i - 4] * 100 for i in range(n)]
    spread = [
        None if i == 0 else max(h[i] - l[i], abs(h[i] - c[i - 1]), abs(l[i] - c[i - 1]))
        for i in range(n)
    ]
    atr = [mean(spread, i, 14) for i in range(n)]
    found, last = [], None
    for t in range(5, n):
        before, now, s = change[t - 1], change[t], params.sensitivity
        if before is None:
            continue
        if before > -s >= now:
            side = "bear"
        elif before < s <= now:
            side = "bull"
        else:
            continue
        if last is not None and t - last < params.min_distance:
            continue
        if t < 49 or percentile(v[t - 49 : t + 1]) < params.min_volume_percentile:
            continue
        fast, slow = mean(c, t, params.trend_period), mean(c, t, 50)
        if abs(fast - slow) <= 1e-12 * slow or (fast > slow) != (side == "bull"):
            continue
        usual = mean(atr, t, 20)
        if usual is not None and atr[t] > 2 * usual * (1 + 1e-12):
            continue
        for back in range(t - 4, max(t - 16, -1), -1):
            if (c[back] > o[back]) if side == "bear" else (c[back] < o[back]):
                found.append((side, t, back, h[back], l[back]))
                last = t
                break
    return found
