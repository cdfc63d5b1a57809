"""Keyed stateful processors for ``transformWithState`` (Row API).

Each processor keeps per-key value or list state and event-time (or processing-time) timers, and mirrors
one batch operator of :mod:`tidemark.operators`. Rows of one key inside a micro-batch come in no
particular order, so every handler sorts them first (by arrival ``seq`` or by event time).

Spark calls the handler methods by keyword: the names and parameter names below are required.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators import blocking, patterns
from tidemark.operators.joins import MATCHED, UNMATCHED_PAYS, UNMATCHED_RECEIPTS, pair_waiting

ORDER_RESULT = T.StructType([T.StructField("order_id", T.LongType()),
                             T.StructField("result_state", T.StringType())])
CYCLE_RESULT = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("cycle_time", T.LongType()),
                             T.StructField("result_state", T.StringType())])
LOGIN_WARNING = T.StructType([T.StructField("user_id", T.LongType()),
                              T.StructField("first_fail_time", T.LongType()),
                              T.StructField("last_fail_time", T.LongType()),
                              T.StructField("warning_msg", T.StringType())])
TX_RESULT = T.StructType([T.StructField("tag", T.StringType()), T.StructField("order_id", T.LongType()),
                          T.StructField("tx_id", T.StringType()), T.StructField("pay_time", T.LongType()),
                          T.StructField("pay_channel", T.StringType()),
                          T.StructField("receipt_time", T.LongType())])

RUNNING_UV = T.StructType([T.StructField("url", T.StringType()), T.StructField("window_end", T.LongType()),
                           T.StructField("cnt", T.LongType()), T.StructField("user_id", T.LongType())])
DAY_S = 86400


def _by(*names):
    return lambda r: tuple((r[n] if r[n] is not None else 0) for n in names)


class InOrderProcessor(StatefulProcessor):
    """Rows of a key applied in event-time order, each once the watermark has passed it.

    Rows wait in a list state; a timer per row time wakes the key, and the first timer of a watermark applies all that
    it has passed. So results depend neither on where batches are cut nor on the order of rows in them. A subclass
    names what it keeps of a row (``ROW``, the time in seconds first; rows are ordered by all of it), applies rows
    (``apply``) and may ask to be woken at a later time by :meth:`wake`, without rows if none have come. A key with
    no rows waiting and no state of its subclass leaves nothing behind."""

    ROW = "timestamp long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", self.ROW)
        self.drained = handle.getValueState("drained", "watermark long")

    def row(self, r) -> tuple:
        raise NotImplementedError

    def apply(self, key, rows: list[tuple], watermark: int) -> list[Row]:
        raise NotImplementedError

    def wake(self, at_ms: int) -> None:
        self.handle.registerTimer(at_ms)

    def handleInputRows(self, key, rows, timerValues):
        new = [self.row(r) for r in rows if r["timestamp"] is not None]
        for t in sorted({n[0] for n in new}):
            self.wake(t * 1000)
        if new:
            self.buffer.appendList(new)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = timerValues.getCurrentWatermarkInMs()
        if self.drained.exists() and self.drained.get()[0] == watermark:
            return iter([])
        held = [tuple(b) for b in self.buffer.get()] if self.buffer.exists() else []
        ready = sorted(b for b in held if b[0] * 1000 <= watermark)
        rest = [b for b in held if b[0] * 1000 > watermark]
        out = self.apply(key, ready, watermark)
        if not rest:
            self.buffer.clear()
            self.drained.clear()
        else:
            if ready:
                self.buffer.put(rest)
            self.drained.update((watermark,))
        return iter(out)

    def close(self) -> None:
        pass


class OrderCycleProcessor(InOrderProcessor):
    """One result per cycle of an order id, by the rule of :func:`tidemark.operators.patterns.order_cycles`. State is
    what waits, a create or a pay, and since when; it goes when its wait is over."""

    ROW = "timestamp long, kind int, seq long"

    def __init__(self, timeout_s: int = 900, late_s: int = 900, early_s: int = 900):
        self.timeout_s, self.late_s, self.early_s = timeout_s, late_s, early_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getValueState("waiting", "kind int, since long")

    def row(self, r):
        return r["timestamp"], int(r["event_type"] == "pay"), r["seq"] if r["seq"] is not None else 0

    def _end(self, kind, since):
        """When (ms) nothing can meet what waits any more."""
        return (since + self.early_s) * 1000 + 1 if kind else (since + self.timeout_s + self.late_s) * 1000

    def apply(self, key, rows, watermark):
        kind, since = self.waiting.get() if self.waiting.exists() else (None, None)
        out = []

        def result(state):
            out.append(Row(order_id=key[0], cycle_time=since, result_state=state))

        for t, new, _ in rows:
            if kind is not None and kind != new and t * 1000 < self._end(kind, since):
                result(patterns.PAYED_LATE if new and t >= since + self.timeout_s else patterns.PAYED_OK)
                kind = None
                continue
            if kind == 1:
                result(patterns.NO_CREATE)
            elif kind == 0 and (new or t >= since + self.timeout_s):
                result(patterns.TIMED_OUT)
            kind, since = new, t
        if kind is not None and watermark >= self._end(kind, since):
            result(patterns.NO_CREATE if kind else patterns.TIMED_OUT)
            kind = None
        if kind is None:
            self.waiting.clear()
        else:
            self.waiting.update((kind, since))
            self.wake(self._end(kind, since))
        return out


class OrderStateProcessor(StatefulProcessor):
    """One result per order from its first create and first pay, by the rule of
    :func:`tidemark.operators.patterns.order_state`.

    State is what the rule needs, the two event times. With both known the result is out; with one known it
    has a deadline in event time, after which the rule decides with what there is: a lone create waits
    until create + ``timeout_s``, a lone pay until the watermark reaches it, as its create lies before it.
    Further rows of an order whose result came from both are passed over until ``timeout_s`` after them."""

    def __init__(self, timeout_s: int = 900):
        self.timeout_s = timeout_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getValueState("times", "create long, pay long, done boolean")

    def _result(self, order_id, create, pay):
        if pay is None:
            state = patterns.TIMED_OUT
        elif create is None:
            state = patterns.NO_CREATE
        else:
            state = patterns.PAYED_OK if pay < create + self.timeout_s else patterns.PAYED_LATE
        return Row(order_id=order_id, result_state=state)

    def _deadline(self, create, pay):
        return (pay if create is None else create + self.timeout_s) * 1000

    def handleInputRows(self, key, rows, timerValues):
        create, pay, done = self.times.get() if self.times.exists() else (None, None, False)
        if done:
            return iter([])
        if create is not None or pay is not None:
            self.handle.deleteTimer(self._deadline(create, pay))
        for r in rows:
            if r["event_type"] == "create":
                create = r["timestamp"] if create is None else min(create, r["timestamp"])
            elif r["event_type"] == "pay":
                pay = r["timestamp"] if pay is None else min(pay, r["timestamp"])
        if create is not None and pay is not None:
            self.times.update((create, pay, True))
            self.handle.registerTimer((max(create, pay) + self.timeout_s) * 1000)
            return iter([self._result(key[0], create, pay)])
        if create is not None or pay is not None:
            self.times.update((create, pay, False))
            self.handle.registerTimer(self._deadline(create, pay))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.times.exists():
            return iter([])
        create, pay, done = self.times.get()
        self.times.clear()
        return iter([] if done else [self._result(key[0], create, pay)])

    def close(self) -> None:
        pass


class ClickBlockerProcessor(StatefulProcessor):
    """The rule of :mod:`tidemark.operators.blocking` per (user, ad): by its position in arrival order and
    reset period a row passes (up to ``limit``, tag 'data'), warns (the next one, 'blacklist') or is dropped.

    State is the number of rows per period. With ``reset='calendar_day'`` a period is a day of event time and
    its number goes when the watermark passes the day's end; with ``rolling`` the number goes ``period_s`` after its first
    row by the clock, by a processing-time timer or by the next row, whichever comes first; without a reset the one number stays, for
    ``ttl_s`` if that is given. Only the rows that can still get out are held in memory."""

    def __init__(self, limit: int = 100, reset: str = "none", ttl_s: int | None = None, period_s: int = DAY_S):
        assert reset in ("none", "calendar_day", "rolling")
        self.limit, self.daily, self.ttl_s = limit, reset == "calendar_day", ttl_s
        self.rolling_ms = period_s * 1000 if reset == "rolling" else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        extra = {"ttlDurationMs": self.ttl_s * 1000} if self.ttl_s else {}
        self.seen = handle.getMapState("seen", "period long", "rows long", **extra)
        self.began = handle.getValueState("began", "at long") if self.rolling_ms else None

    def _over(self, timerValues) -> None:
        """The rolling period's state goes if the period is over by the clock."""
        if self.began.exists() and timerValues.getCurrentProcessingTimeInMs() >= self.began.get()[0] + self.rolling_ms:
            self.seen.clear()
            self.began.clear()

    def handleInputRows(self, key, rows, timerValues):
        heads, counts = {}, {}
        if self.rolling_ms:
            self._over(timerValues)
        for n, r in enumerate(rows):
            period = r["timestamp"] // DAY_S if self.daily else 0
            if period not in counts:
                counts[period] = [self.seen.getValue((period,))[0] if self.seen.containsKey((period,)) else 0, 0]
            counts[period][1] += 1
            room = self.limit + 1 - counts[period][0]
            if room > 0:  # keep the first rows by arrival, largest seq on top
                heap = heads.setdefault(period, [])
                item = (-(r["seq"] or 0), n, r)
                heapq.heappush(heap, item) if len(heap) < room else heapq.heappushpop(heap, item)
        out = []
        for period, (before, new) in counts.items():
            self.seen.updateValue((period,), (min(before + new, self.limit + 1),))
            if self.daily and not before:
                self.handle.registerTimer((period + 1) * DAY_S * 1000)
            if self.rolling_ms and not before:
                now = timerValues.getCurrentProcessingTimeInMs()
                self.began.update((now,))
                self.handle.registerTimer(now + self.rolling_ms)
            for pos, (_, _, r) in enumerate(sorted(heads.get(period, []), key=lambda i: (-i[0], i[1])), before + 1):
                passed = pos <= self.limit
                out.append(Row(**r.asDict(), tag="data" if passed else "blacklist",
                               warning_msg=None if passed else blocking.WARNING_MSG.format(limit=self.limit)))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.rolling_ms:
            self._over(timerValues)
            return iter([])
        period = expiredTimerInfo.getExpiryTimeInMs() // (DAY_S * 1000) - 1
        if self.seen.containsKey((period,)):
            self.seen.removeKey((period,))
        return iter([])

    def close(self) -> None:
        pass


class LoginFailPairProcessor(StatefulProcessor):
    """Per user, in arrival order: a fail right after ``fail_times - 1`` fails, first to last within
    ``limit_s``, warns; a success clears. ``ttl_s``: forget a user's fails after so long (processing time)."""

    def __init__(self, limit_s: int = 2, fail_times: int = 2, ttl_s: int | None = None):
        self.limit_s, self.k, self.ttl_s = limit_s, fail_times, ttl_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        extra = {"ttlDurationMs": self.ttl_s * 1000} if self.ttl_s else {}
        self.fails = handle.getListState("fails", "ts long", **extra)

    def handleInputRows(self, key, rows, timerValues):
        (user,) = key
        recent = [f[0] for f in self.fails.get()] if self.fails.exists() else []
        msg = patterns.PAIR_MSG.format(k=self.k, limit=self.limit_s)
        out = []
        for r in sorted(rows, key=_by("seq")):
            if r["login_state"] != "fail":
                recent = []
                continue
            recent = (recent + [r["timestamp"]])[-self.k:]
            if len(recent) == self.k and recent[-1] - recent[0] <= self.limit_s:
                out.append(Row(user_id=user, first_fail_time=recent[0], last_fail_time=recent[-1],
                               warning_msg=msg))
        self.fails.clear()
        if recent:
            self.fails.put([(t,) for t in recent])
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return iter([])

    def close(self) -> None:
        pass


class LoginFailTimerProcessor(InOrderProcessor):
    """Per user: the first fail opens a group that ends at first + limit (exclusive); a success before that cancels it;
    at its end, ``min_fails`` or more fails warn (:func:`tidemark.operators.patterns.login_fail_timed`)."""

    ROW = "timestamp long, seq long, fail boolean"

    def __init__(self, limit_s: int = 2, min_fails: int = 2):
        self.limit_s, self.n = limit_s, min_fails

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.group = handle.getValueState("group", "first long, last long, n long")

    def row(self, r):
        return r["timestamp"], r["seq"] if r["seq"] is not None else 0, r["login_state"] == "fail"

    def apply(self, key, rows, watermark):
        group = self.group.get() if self.group.exists() else None
        out = []

        def ended(at_s):
            """Close the group if its time is up at ``at_s``."""
            nonlocal group
            if group is not None and at_s >= group[0] + self.limit_s:
                if group[2] >= self.n:
                    out.append(Row(user_id=key[0], first_fail_time=group[0], last_fail_time=group[1],
                                   warning_msg=patterns.TIMED_MSG.format(limit=self.limit_s, n=group[2])))
                group = None

        for t, _, fail in rows:
            ended(t)
            if not fail:
                group = None
            else:
                group = (t, t, 1) if group is None else (group[0], t, group[2] + 1)
        ended(watermark / 1000)
        if group is None:
            self.group.clear()
        else:
            self.group.update(group)
            self.wake((group[0] + self.limit_s) * 1000)
        return out


class TxMatchProcessor(StatefulProcessor):
    """Pays (side 'pay') and receipts of a tx id, paired by the rule of
    :func:`tidemark.operators.joins.pair_waiting`.

    Rows are held until the watermark says that nothing can come before them any more; the rule is then
    applied to all held rows, and its leading decisions are out as far as they are final: a pair when the
    watermark has passed both rows, a single when it has passed the end of its wait. So results depend
    neither on where batches are cut nor on the order of rows in them. Each row has the one or two deadlines at
    which its own decision becomes final; the state is drained once per watermark."""

    def __init__(self, pay_wait_s: int = 5, receipt_wait_s: int = 3):
        self.waits = (pay_wait_s, receipt_wait_s)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "side int, t long, order_id long, channel string")
        self.drained = handle.getValueState("drained", "watermark long")

    def handleInputRows(self, key, rows, timerValues):
        new = []
        for r in rows:
            side = 0 if r["side"] == "pay" else 1
            new.append((side, r["timestamp"], r["order_id"], r["pay_channel"]))
            for t in (r["timestamp"], r["timestamp"] + self.waits[side]):
                self.handle.registerTimer(t * 1000 + 1)
        self.held.appendList(new)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = timerValues.getCurrentWatermarkInMs()
        if self.drained.exists() and self.drained.get()[0] == watermark:
            return iter([])
        held = [tuple(h) for h in self.held.get()] if self.held.exists() else []
        sides = [sorted(((t, o, c) for s, t, o, c in held if s == side), key=lambda x: (x[0], x[1] or 0, x[2] or ""))
                 for side in (0, 1)]
        out, n_out = [], 0
        decided = pair_waiting(*sides, *self.waits)
        final = lambda t: t * 1000 < watermark
        for p, r in decided:
            ready = (final(max(p[0], r[0])) if p and r else final(p[0] + self.waits[0]) if p
                     else final(r[0] + self.waits[1]))
            if not ready:
                break
            n_out += 1
            out.append(Row(tag=MATCHED if p and r else UNMATCHED_PAYS if p else UNMATCHED_RECEIPTS,
                           order_id=p and p[1], tx_id=key[0], pay_time=p and p[0], pay_channel=r and r[2],
                           receipt_time=r and r[0]))
        rest = [(0, *p) for p, _ in decided[n_out:] if p] + [(1, *r) for _, r in decided[n_out:] if r]
        if rest:
            if n_out:
                self.held.put(rest)
            self.drained.update((watermark,))
        else:
            self.held.clear()
            self.drained.clear()
        return iter(out)

    def close(self) -> None:
        pass


class RunningNumberProcessor(StatefulProcessor):
    """Numbers the rows of a window in arrival order, on over batches; the rows are the first of their ids
    already, so a window's state is one number, which goes when the watermark passes its end."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.n = handle.getValueState("n", "n long")

    def handleInputRows(self, key, rows, timerValues):
        n = self.n.get()[0] if self.n.exists() else 0
        if not n:
            self.handle.registerTimer(key[0])
        out = []
        for r in sorted(rows, key=_by("seq")):
            n += 1
            out.append(Row(url="uv", window_end=key[0], cnt=n, user_id=r["user_id"]))
        self.n.update((n,))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.n.clear()
        return iter([])

    def close(self) -> None:
        pass


class LoginFailStreakProcessor(InOrderProcessor):
    """k strictly consecutive fails per user in event-time order, last - first < within. The last fails, k - 1 at most,
    are kept as context, so matches may span batches and overlap; they go when nothing near enough can follow."""

    ROW = "timestamp long, seq long, fail boolean"

    def __init__(self, times: int = 3, within_s: int = 5):
        self.k, self.within_s = times, within_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.context = handle.getListState("context", "timestamp long")

    def row(self, r):
        return r["timestamp"], r["seq"] if r["seq"] is not None else 0, r["login_state"] == "fail"

    def apply(self, key, rows, watermark):
        fails = [c[0] for c in self.context.get()] if self.context.exists() else []
        out = []
        for t, _, fail in rows:
            fails = (fails + [t])[-self.k:] if fail else []
            if len(fails) == self.k and t - fails[0] < self.within_s:
                out.append(Row(user_id=key[0], first_fail_time=fails[0], last_fail_time=t,
                               warning_msg=patterns.STREAK_MSG.format(k=self.k)))
        fails = fails[1 - self.k:] if self.k > 1 else []
        if not fails or watermark >= (fails[-1] + self.within_s) * 1000:
            self.context.clear()
        else:
            self.context.put([(t,) for t in fails])
            self.wake((fails[-1] + self.within_s) * 1000)
        return out


class SlidingCountProcessor(StatefulProcessor):
    """Counts per sliding window of a key, emitted as runs of equal counts when the watermark has closed the windows.

    State is the ring of the key's pane counts, those that an open window still holds, and the last window that is out.
    A pane's count enters at the first window that ends after it and leaves after size / slide windows; between two
    such changes the count stays, so a run (``first_end`` to ``last_end``, ``cnt``) is one row however many windows it
    spans. The key wakes when its panes enter and leave, so a run may come as late as its end.

    A window is closed when its end - 1 + ``lateness_ms`` is at or below the query's own watermark. A row counts for the
    windows still open when it comes; one that finds none is emitted at once with tag 'late' and what ``row`` holds of
    it. Rows must reach the operator without a watermark column, which Spark would drop late ones by.

    ``whole_panes``: the rows are panes that an aggregation before this one has closed, each once. None of them is late, and
    a window is closed when the watermark has reached its end."""

    def __init__(self, size_ms: int, slide_ms: int, lateness_ms: int = 0, keys: tuple = (), payload: bool = False,
                 whole_panes: bool = False):
        self.n, self.slide, self.keys, self.payload = size_ms // slide_ms, slide_ms, keys, payload
        self.whole_panes, self.lateness = whole_panes, 1 if whole_panes else lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane long", "n long")
        self.done = handle.getValueState("done", "window long")

    def _closed(self, timerValues) -> int | None:
        """The last window (its end in slides) that the watermark has closed."""
        watermark = timerValues.getCurrentWatermarkInMs()
        return (watermark - self.lateness + 1) // self.slide if watermark else None

    def _row(self, key, **own):
        extra = {"late": own.pop("late", None)} if self.payload else {}
        return Row(**dict(zip(self.keys, key)), **{"tag": "count", "first_end": None, "last_end": None, "cnt": None, **own}, **extra)

    def _flush(self, key, closed: int | None) -> list[Row]:
        if closed is None or not self.done.exists():
            return []
        done = self.done.get()[0]
        steps: dict[int, int] = {}
        for (pane,), (n,) in list(self.panes.iterator()):
            enters, leaves = max(pane, done) + 1, pane + self.n + 1
            steps[enters] = steps.get(enters, 0) + n
            steps[leaves] = steps.get(leaves, 0) - n
            if leaves <= closed + 1:
                self.panes.removeKey((pane,))
        out, level, at = [], 0, None
        for end in sorted(steps):
            last = min(end - 1, closed)
            if level and last >= at:
                out.append(self._row(key, first_end=at * self.slide, last_end=last * self.slide, cnt=level))
            if end > closed:
                break
            level, at = level + steps[end], end
        self.done.update((max(done, closed),))
        return out

    def handleInputRows(self, key, rows, timerValues):
        closed = None if self.whole_panes else self._closed(timerValues)
        out = self._flush(key, closed)
        new: dict[int, int] = {}
        for r in rows:
            pane = r["_ms"] // self.slide
            if closed is not None and pane + self.n <= closed:
                out.append(self._row(key, tag="late", cnt=r["_n"], **({"late": r["_row"]} if self.payload else {})))
            else:
                new[pane] = new.get(pane, 0) + r["_n"]
        if new:
            # nothing that is closed is counted again, and what is open begins at the first pane
            first = min(new) if not self.done.exists() else self.done.get()[0] if self.whole_panes else min(min(new), self.done.get()[0])
            self.done.update((first if closed is None else max(first, closed),))
        for pane, n in new.items():
            n += self.panes.getValue((pane,))[0] if self.panes.containsKey((pane,)) else 0
            self.panes.updateValue((pane,), (n,))
            for end in (pane + 1, pane + self.n):
                if closed is None or end > closed:
                    self.handle.registerTimer(end * self.slide - 1 + self.lateness)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        out = self._flush(key, self._closed(timerValues))
        if not any(True for _ in self.panes.keys()):
            self.done.clear()
        return iter(out)

    def close(self) -> None:
        pass


class BitmapProcessor(StatefulProcessor):
    """Newly set positions of one block of a window's bitmap: state is the block, ``BLOCK_BITS`` / 8 bytes however many
    rows and visitors there are, and goes when the watermark passes the window's end."""

    BLOCK_BITS = 1 << 15

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.block = handle.getValueState("block", "bits binary")

    def handleInputRows(self, key, rows, timerValues):
        held = self.block.exists()
        bits = bytearray(self.block.get()[0]) if held else bytearray(self.BLOCK_BITS // 8)
        n, ts = 0, None
        for r in rows:
            byte, bit = r["_pos"] >> 3, 1 << (r["_pos"] & 7)
            n += not bits[byte] & bit
            bits[byte] |= bit
            ts = r["ts"] if ts is None else max(ts, r["ts"])
        if not held:
            self.handle.registerTimer(key[0])
        if not n:
            return iter([])
        self.block.update((bytes(bits),))
        return iter([Row(ts=ts, n=n)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.block.clear()
        return iter([])

    def close(self) -> None:
        pass
