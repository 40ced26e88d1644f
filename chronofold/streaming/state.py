"""Stateful processors: what a stream remembers of a key between micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chronofold.plans.timeline import DESTROYED, PURCHASED, SOLD, UNDO


class ItemReplay(StatefulProcessor):
    """Item counters of owners with what an UNDO can take back.

    Owners are grouped by a bucket, so that a call's fixed cost is shared by many; ``ev_key`` tells the owners of a bucket apart.  State per owner: ``open``, one record of
    the counts, the ``due`` time at which the owner is closed and the last remembered events (a purchase together with the items that were used up for it on its
    tick); ``past``, the remembered events before these in blocks of ``block``.  A batch reads and writes the records of the owners it has events of, and a block
    only where one fills up or is taken back (a record holds fewer than two), so its cost does not depend on how long an owner has been open.
    """

    def __init__(self, owner: list[str], idle: int | None = None, block: int = 32):
        self.owner, self.idle, self.block = owner, idle, block

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        events = "kinds array<string>, ticks array<long>, taken array<string>, used array<array<string>>"
        self.open = handle.getMapState("open", "owner string", f"blocks long, due long, timer long, items array<string>, counts array<long>, {events}")
        self.past = handle.getMapState("past", "owner string, block long", events)
        self.timers = handle.getMapState("timers", "at long", "owners array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        order = ["ev_key", "ev_has_t", "ev_t", "ev_type", "ev_has_ord", "ev_ord"]
        events = pd.concat(frames).sort_values(order, kind="stable", na_position="first").reset_index(drop=True)
        owners = events["ev_key"]
        starts = [*owners.index[owners != owners.shift()], len(events)]
        columns = [events[c].tolist() for c in ("ev_t", "ev_has_t", "ev_kind", "ev_item", "ev_ended", "ev_at")]
        out: list[tuple] = []
        waiting: dict[int, list[str]] = {}
        for low, high in zip(starts[:-1], starts[1:], strict=True):
            state = _Owner(self, owners[low])
            for n, (tick, timed, kind, item, ended, _) in enumerate(zip(*(c[low:high] for c in columns), strict=True), low):
                changes = state.take(kind, tick if timed else None, item)
                out += [(n, step, what, by, state.bump(what, by)) for step, (what, by) in enumerate(changes)]
                if ended:
                    state.clear()
            if self.idle is not None:
                state.postpone([int(at) for at in columns[-1][low:high] if not pd.isna(at)], self.idle, waiting)
            state.store()
        self._wait(waiting)
        places = [o[0] for o in out]
        found = events.iloc[places][[*self.owner, "ev_nulls", "ev_t", "ev_has_t", "ev_type", "ev_ord", "ev_has_ord"]].reset_index(drop=True)
        given = {name: [o[i] for o in out] for i, name in enumerate(("step", "ev_item", "change", "held"), 1)}
        yield found.assign(**{name: pd.Series(values, dtype=object if name == "ev_item" else "int64") for name, values in given.items()})

    def _wait(self, waiting: dict[int, list[str]]) -> None:
        """One timer of the bucket for all owners that wait for the same moment."""
        for at, names in waiting.items():
            known = self.timers.getValue((at,))
            self.timers.updateValue((at,), ([*(known[0] if known else []), *names],))
            self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Closes the owners that were idle; one with later events waits again, an owner that was closed and opened anew waits for a timer of its own."""
        at, mark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        known = self.timers.getValue((at,))
        self.timers.removeKey((at,))
        waiting: dict[int, list[str]] = {}
        for name in dict.fromkeys(known[0] if known else []):
            state = _Owner(self, name)
            if state.timer != at:
                continue
            if state.due <= max(at, mark - 1):
                state.clear()
            else:
                state.timer = state.due
                waiting.setdefault(state.due, []).append(name)
            state.store()
        self._wait(waiting)
        return iter(())

    def close(self) -> None:
        pass


class _Owner:
    """State of one owner while a batch is applied to it."""

    def __init__(self, replay: ItemReplay, name: str):
        self.replay, self.name = replay, name
        record = replay.open.getValue((name,))
        self.known = record is not None
        self.blocks, self.due, self.timer, items, counts, *events = record or (0, None, None, [], [], [], [], [], [])
        self.stored = self.blocks
        self.counts: dict[str | None, int] = dict(zip(items, counts, strict=True))
        self.top = list(zip(*events, strict=True))

    def last(self) -> tuple | None:
        """The event remembered last: kind, tick, item and the items used up for it."""
        if not self.top and self.blocks:
            self.blocks -= 1
            self.top = list(zip(*self.replay.past.getValue((self.name, self.blocks)), strict=True))
        return self.top[-1] if self.top else None

    def take(self, kind: str, tick: int | None, item: str | None) -> list[tuple[str | None, int]]:
        """Changes of counters by an event."""
        if kind == PURCHASED:
            used = []
            while (last := self.last()) and last[0] == DESTROYED and last[1] == tick:
                used.append(self.top.pop()[2])
            self.top.append((kind, tick, item, used))
            return [(item, 1)]
        if kind in (SOLD, DESTROYED):
            self.top.append((kind, tick, item, []))
            return [(item, -1)]
        if kind == UNDO and self.last():
            what, _, item, used = self.top.pop()
            if what == PURCHASED:
                return [(item, -1), *((i, 1) for i in reversed(used))]
            if what == SOLD:
                return [(item, 1)]
        return []

    def bump(self, item: str | None, by: int) -> int:
        held = self.counts[item] = max(0, self.counts.get(item, 0) + by)
        return held

    def postpone(self, moments: list[int], idle: int, waiting: dict[int, list[str]]) -> None:
        """The owner closes ``idle`` after its last event; it has one timer, which is set anew when it fires too early."""
        if moments:
            self.due = max(max(moments) + idle, self.due or 0)
        if self.due is not None and self.timer is None:
            self.timer = self.due
            waiting.setdefault(self.due, []).append(self.name)

    def clear(self) -> None:
        self.blocks, self.due, self.timer, self.counts, self.top = 0, None, None, {}, []

    def store(self) -> None:
        replay, size = self.replay, self.replay.block
        while len(self.top) >= 2 * size:
            replay.past.updateValue((self.name, self.blocks), tuple(map(list, zip(*self.top[:size], strict=True))))
            self.top = self.top[size:]
            self.blocks += 1
        for block in range(self.blocks, self.stored):
            replay.past.removeKey((self.name, block))
        held = {item: n for item, n in self.counts.items() if n}
        if self.blocks or self.top or held or self.due is not None:
            events = tuple(map(list, zip(*self.top, strict=True))) if self.top else ([], [], [], [])
            replay.open.updateValue((self.name,), (self.blocks, self.due, self.timer, [*held], [*held.values()], *events))
        elif self.known:
            replay.open.removeKey((self.name,))


class FirstWithin(StatefulProcessor):
    """First row of a key, and again the first one that comes more than ``lateness`` after the last one that counted.

    Rows are grouped by a bucket of their keys, so that a call's fixed cost is shared by many keys; ``ev_key`` tells the keys of a bucket apart.  Rows arrive with their
    event time ``ev_at`` in milliseconds and come out with ``late`` and ``first``; a repeat comes out as neither.  The query's own watermark runs ``slack`` behind the one
    meant here, so that Spark passes late rows on.  A key's state goes when no row in time can repeat it: as its bucket is next written, or by the bucket's timer.
    """

    def __init__(self, columns: list[str], order: list[str], lateness: int, slack: int):
        self.columns, self.order, self.lateness, self.slack = columns, order, lateness, slack

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until = handle.getListState("until", "key string, until long")
        self.due = handle.getValueState("due", "due long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        events = pd.concat(frames).sort_values(["ev_at", *self.order], kind="stable", na_position="first")
        mark = self._mark(timerValues)
        before = dict(self.until.get())
        until, late, first = dict(before), [], []
        for name, at in zip(events["ev_key"].tolist(), events["ev_at"].tolist(), strict=True):
            timed = not pd.isna(at)
            late.append(timed and at < mark)
            known = until.get(name)
            first.append(timed and not late[-1] and (known is None or at > known))
            if first[-1]:
                until[name] = int(at) + self.lateness
        if until != before:
            self._store({k: v for k, v in until.items() if v >= mark})
        yield events.assign(late=late, first=first)[[*self.columns, "late", "first"]]

    def _mark(self, timerValues) -> int:
        """The largest event time of the batches before, less the lateness."""
        mark = timerValues.getCurrentWatermarkInMs()
        return mark + self.slack if mark > 0 else -1

    def _store(self, until: dict[str, int]) -> None:
        """State of the bucket and a timer for the moment when none of it counts any more."""
        known = self.due.get()
        if not until:
            self.until.clear()
            self.due.clear()
        else:
            self.until.put(list(until.items()))
        due = max(max(until.values()) - self.slack + 1, 1) if until else None
        if known and known[0] != due:
            self.handle.deleteTimer(known[0])
        if due is not None and (not known or known[0] != due):
            self.due.update((due,))
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.due.get()
        if known and known[0] <= expiredTimerInfo.getExpiryTimeInMs():
            self.until.clear()
            self.due.clear()
        return iter(())

    def close(self) -> None:
        pass
