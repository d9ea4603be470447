"""Recursions over instruments' series, in numpy over many instruments at once.

A matrix holds one series a row, NaN where a value is missing; a step goes along the bars and takes all series
together. What a recursion carries on may be given at its start, so a stored state continues a series.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bars of whole series that are computed together; a series itself is as long as the calendar.
TOGETHER = 1 << 17
#: Zones by their code in a matrix; none is -1.
ZONES = ("normal", "explosive", "low_volume")


def _start(given, n: int, default: float) -> np.ndarray:
    return np.full(n, default) if given is None else np.asarray(given, float).copy()


def ema(x: np.ndarray, period: int, n=None, total=None, prev=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponential mean: expanding mean over the first ``period`` values, then recursion; missing values carry on.

    Returns the mean and what continues it: the values and their sum so far.
    """
    n, total, prev = _start(n, len(x), 0.0), _start(total, len(x), 0.0), _start(prev, len(x), np.nan)
    out, ns, totals = np.empty_like(x), np.empty_like(x), np.empty_like(x)
    alpha = 2.0 / (period + 1)
    for t in range(x.shape[1]):
        v = x[:, t]
        ok = ~np.isnan(v)
        n, total = n + ok, np.where(ok, total + v, total)
        step = np.where(n <= period, total / np.maximum(n, 1), alpha * v + (1 - alpha) * prev)
        prev = np.where(ok, step, prev)
        out[:, t], ns[:, t], totals[:, t] = prev, n, total
    return out, ns, totals


def ewm(x: np.ndarray, there: np.ndarray, span: int, prev=None, old=None) -> tuple[np.ndarray, np.ndarray]:
    """Recursion from the first value on; a bar without value still lets the old weight decay. Returns the mean and that weight."""
    prev, old = _start(prev, len(x), np.nan), _start(old, len(x), 1.0)
    out, olds, alpha = np.empty_like(x), np.empty_like(x), 2.0 / (span + 1)
    for t in range(x.shape[1]):
        v = x[:, t]
        ok, begun = ~np.isnan(v), ~np.isnan(prev)
        less = old * (1 - alpha)
        mixed = (less * prev + alpha * v) / (less + alpha)
        old = np.where(ok, 1.0, np.where(there[:, t] & begun, less, old))
        prev = np.where(ok, np.where(begun, mixed, v), prev)
        out[:, t], olds[:, t] = prev, old
    return out, olds


def zone_codes(rank: np.ndarray, before=None, start=None) -> np.ndarray:
    """Zones with hysteresis from bar ``start`` on: one is entered and left only after several bars; ``before`` is the zone before."""
    state = np.zeros(len(rank), int) if before is None else np.maximum(before, 0).astype(int)
    start = np.zeros(len(rank), int) if start is None else np.asarray(start)
    tests = [lambda r: r > 90, lambda r: r < 10, lambda r: r < 75, lambda r: r > 25]
    runs, out = np.zeros((4, len(rank)), int), np.empty(rank.shape, int)
    for t in range(rank.shape[1]):
        x = rank[:, t]
        runs = np.stack([(run + 1) * test(x) for run, test in zip(runs, tests)])
        act = ~np.isnan(x) & (t >= start)
        entered = np.where(runs[0] >= 2, 1, np.where(runs[1] >= 5, 2, 0))
        now = np.where(state == 0, entered, state)
        left = (now == 1) & (runs[2] >= 2) | (now == 2) & (runs[3] >= 2)
        state = np.where(act, np.where(left, 0, now), state)
        out[:, t] = np.where(act, state, -1)
    return out


def spaced_flags(flags: np.ndarray, gap: int, known: np.ndarray | None = None) -> np.ndarray:
    """Flags without those within ``gap`` bars after one that counts; where ``known`` is not NaN it says whether they do."""
    out, last = np.empty(flags.shape, bool), np.full(len(flags), -gap - 1)
    for t in range(flags.shape[1]):
        now = (flags[:, t] > 0) & (t - last > gap)
        if known is not None:
            now = np.where(np.isnan(known[:, t]), now, known[:, t] > 0)
        out[:, t] = now
        last = np.where(now, t, last)
    return out


def _one(values) -> np.ndarray:
    return np.array([[np.nan if v is None else v for v in values]], float)


def _plain(row: np.ndarray) -> list:
    return [None if v != v else float(v) for v in row]


def ema_array(values, period: int, seed: float | None = None) -> list:
    """:func:`ema` of one series; with ``seed`` it is past its first ``period`` values."""
    seeded = {} if seed is None else {"n": [period], "prev": [seed]}
    return _plain(ema(_one(values), period, **seeded)[0][0])


def ewm_array(values, span: int) -> list:
    """:func:`ewm` of one series."""
    x = _one(values)
    return _plain(ewm(x, np.ones(x.shape, bool), span)[0][0])


def zones(rank: list, seed: str | None = None, start: int = 0) -> list:
    """:func:`zone_codes` of one series, by name."""
    before = None if seed is None else [ZONES.index(seed)]
    return [None if c < 0 else ZONES[c] for c in zone_codes(_one(rank), before, [start])[0]]


def over_series(rows: DataFrame, values: list[str], out: str, run: Callable, seeds: list[str] = (), keep: list[str] = (), last: int | None = None) -> DataFrame:
    """``(ts_code, trade_date)``, the columns ``keep`` as they are, and those of ``out`` (names with types) that ``run`` gives for every instrument's series,
    or for the ``last`` bars of every series only, where no others are needed.

    ``run(x, there, seed)`` gets the values as matrices, which places are bars, and of each seed column the value on
    the first bar, and returns matrices by name. Whole series come together in a partition, by a window that
    also counts them, so rows already dealt by instrument are not moved.
    """
    values, seeds, first = list(values), list(seeds), ["ts_code", "trade_date", *keep]
    names = [p.split()[0] for p in out.split(", ")]
    schema = ", ".join([*(f"{c} {rows.schema[c].dataType.simpleString()}" for c in first), out])

    def compute(batch: pa.Table) -> pa.Table:
        n = batch["_n"].to_numpy()
        heads = np.concatenate(([0], np.cumsum(n[_heads(n)])[:-1])).astype(int)
        sizes = n[heads]
        at = np.arange(len(n)) - np.repeat(heads, sizes)
        row = np.repeat(np.arange(len(heads)), sizes)
        there = np.arange(sizes.max()) < sizes[:, None]
        x = {}
        for c in values:
            x[c] = np.full(there.shape, np.nan)
            x[c][row, at] = batch[f"_v_{c}"].to_numpy()
        got = run(x, there, {c: batch[f"_v_{c}"].to_numpy()[heads] for c in seeds})
        columns = [pa.array(got[c][row, at], from_pandas=True) for c in names]
        table = pa.table([*(batch[c] for c in first), *columns], [*first, *names])
        return table if last is None else table.filter(pa.array(at >= np.repeat(sizes, sizes) - last))

    def over(batches):
        held, count = [], 0
        for b in batches:
            held.append(b)
            count += len(b)
            if count >= TOGETHER:
                table = pa.Table.from_batches(held)
                done = _whole(table["_n"].to_numpy())
                if done:
                    yield from compute(table.slice(0, done)).to_batches()
                held, count = table.slice(done).to_batches(), len(table) - done
        if count:
            yield from compute(pa.Table.from_batches(held)).to_batches()

    whole = Window.partitionBy("ts_code")
    doubles = [F.col(c).cast("double").alias(f"_v_{c}") for c in (*values, *seeds)]
    dealt = rows.select(*first, *doubles, F.count("*").over(whole).alias("_n"))
    return dealt.sortWithinPartitions("ts_code", "trade_date").mapInArrow(over, schema)


def _heads(n: np.ndarray) -> list[int]:
    """Where each series begins, from the series' length on every bar."""
    out, at = [], 0
    while at < len(n):
        out.append(at)
        at += int(n[at])
    return out


def _whole(n: np.ndarray) -> int:
    """Bars of the series that end within the first ``len(n)``."""
    heads = _heads(n)
    return heads[-1] if heads[-1] + n[heads[-1]] > len(n) else len(n)


#: What continues a MACD: bars, sums of closes and differences, the means and the weights of the second lines' means.
MACD_STATE = ("n", "total", "total_dif", "ema_12", "ema_26", "dea", "f10", "f20", "old10", "old20", "b_dea")


def macd_lines(x: dict, there: np.ndarray, seed: dict) -> dict:
    """The recursive part of MACD: EMA lines, and the (10, 20, 7) lines; ``raw_`` ones are what a state keeps of rounded lines."""
    close, s = x["close_qfq"], {c: seed.get(f"seed_{c}") for c in MACD_STATE}
    e12, n, total = ema(close, 12, s["n"], s["total"], s["ema_12"])
    e26 = ema(close, 26, s["n"], s["total"], s["ema_26"])[0]
    dea, _, total_dif = ema(e12 - e26, 9, s["n"], s["total_dif"], s["dea"])
    (f10, old10), (f20, old20) = ewm(close, there, 10, s["f10"], s["old10"]), ewm(close, there, 20, s["f20"], s["old20"])
    b_dea = ewm(f10 - f20, there, 7, s["b_dea"])[0]
    lines = {"ema_12": e12, "ema_26": e26, "dif": e12 - e26, "dea": dea, "macd_bar": 2 * (e12 - e26 - dea), "b_dif": f10 - f20, "b_dea": b_dea, "b_bar": 2 * (f10 - f20 - b_dea)}
    return lines | {"n": n, "total": total, "total_dif": total_dif, "f10": f10, "f20": f20, "old10": old10, "old20": old20, "raw_dea": dea, "raw_b_dea": b_dea}


def trend_lines(fast: int, slow: int, signal: int) -> Callable:
    """MACD lines of closes that start at the first value."""

    def run(x, there, seed):
        dif = ewm(x["close"], there, fast)[0] - ewm(x["close"], there, slow)[0]
        dea = ewm(dif, there, signal)[0]
        return {"b_dif": dif, "b_dea": dea, "b_bar": 2 * (dif - dea)}

    return run


def weekly_smooth(x: dict, there: np.ndarray, seed: dict) -> dict:
    return {"smooth": ewm(x["ddx"], there, 60)[0]}


def volume_zone(gap: int = 5) -> Callable:
    """Zone code, and whether a top or bottom counts: the same at most once in ``gap`` bars after one that does.

    With ``old`` bars given, stored zones and labels are those of their bars, and new ones go on from them.
    """

    def run(x, there, seed):
        if "old" not in x:
            return {"zone": zone_codes(x["pct_vol_rank"]), "top": spaced_flags(x["top"], gap), "bottom": spaced_flags(x["bottom"], gap)}
        was, at = x["old"] == 1, np.arange(there.shape[1])
        start = np.max(np.where(was, at + 1, 0), axis=1)
        zone = np.where((at < start[:, None]) & ~np.isnan(x["old_zone"]), x["old_zone"], -1)
        last = np.max(np.where(zone >= 0, at, -1), axis=1)
        before = np.where(last >= 0, zone[np.arange(len(zone)), last], 0)
        inside = at < start[:, None]
        low = np.where(inside, (x["old_label"] == 2).astype(float), np.nan)
        # A bottom hides a top of the same bar, so of such a bar only the flag says whether there was one.
        high = np.where(inside & (x["old_label"] != 2), (x["old_label"] == 1).astype(float), np.nan)
        return {"zone": zone_codes(x["pct_vol_rank"], before, start), "top": spaced_flags(x["top"], gap, high), "bottom": spaced_flags(x["bottom"], gap, low)}

    return run


#: What continues the flow lines: known flows, their sum, the mean, and the smoothed flow with its weight.
FLOW_STATE = ("k", "total", "mean", "smoothed", "old")


def flow_lines(x: dict, there: np.ndarray, seed: dict) -> dict:
    """``ddx2``, the mean of ``ddx`` where a series has five, the smoothed flow, and what continues both."""
    s = {c: seed.get(f"seed_{c}") for c in FLOW_STATE}
    mean, k, total = ema(x["ddx"], 5, s["k"], s["total"], s["mean"])
    smoothed, old = ewm(x["flow"], there, 60, s["smoothed"], s["old"])
    enough = k[:, -1:] >= 5
    return {"ddx": x["ddx"], "ddx2": np.where(enough, mean, np.nan), "k": k, "total": total, "mean": mean, "smoothed": smoothed, "old": old}
