"""Per-key state machines replayed in event-time order (streaming D1-D4, C1, C2).

Each machine sees one key's rows sorted by (ts, seq) -- rows are dicts with
``ts`` (epoch µs), ``seq`` and the machine's payload fields -- and a
carry dict that persists between micro-batches.  ``step`` consumes one
row, ``advance(wm)`` is called once every row with ts < wm has been
stepped, and ``deadline`` names the next instant at which ``advance``
can decide something (a timer is set there).  Outputs are dicts.

The same rules as the batch operators in ``eventlens.operators``, so a
stream's closed results equal the batch result on the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class Runs:
    """Rows of several keys as Arrow columns, sorted by key, time and tiebreak: a run of rows per key, and its carry."""

    def __init__(self, carries: list[dict], starts: np.ndarray, cols: dict):
        self.carries, self.starts, self.cols = carries, starts, cols
        self.ts = cols["ts"].to_numpy()
        self.run = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(self.ts)))

    def flag(self, name: str) -> np.ndarray:
        return pc.fill_null(self.cols[name], False).to_numpy()

    def headed(self, runs: list[int], *cols) -> list[np.ndarray]:
        """Run numbers and columns, with rows set before those of ``runs``; a column is (values, values of the set rows)."""
        runs = np.array(runs, np.int64)
        at = self.starts[runs]
        return [np.insert(x, at, np.asarray(head, x.dtype)) for x, head in ((self.run, runs), *cols)]


def of_step(machine: Machine, name: str):
    """An attribute that tells about ``step``, unless a subclass has a ``step`` of its own."""
    owner = next(k for k in type(machine).__mro__ if name in vars(k))
    return getattr(machine, name) if type(machine).step is owner.step else None


class Machine:
    fields: tuple = ()          # payload fields read from each row
    out_fields: tuple = ()      # (name, ddl type) of each output value
    only: tuple = ()            # flags; ``step`` does nothing with a row that has none of them
    columns = None              # ``step`` on all rows of Runs: (run, {name: value}) of each result, carries brought up to date

    def init(self) -> dict:
        return {}

    def step(self, c: dict, r: dict) -> list:
        return []

    def advance(self, c: dict, wm: int) -> list:
        return []

    def deadline(self, c: dict):
        return None

    def idle(self, c: dict) -> bool:
        """True when the carry holds nothing worth keeping."""
        return not c


class Timers(Machine):
    """A keyed queue of named timers: ``register``, ``delete``, fired in order of time, then name.

    Subclass it with ``on_row(c, r)`` and ``on_timer(c, name, at)``; the carry's
    ``"t"`` holds the queue.  A timer fires after all rows up to its own instant
    and before later ones, whenever the watermark comes, so a stream and a
    batch replay agree.  A timer may register others, at its own time or later."""

    def init(self):
        return {"t": {}}

    def register(self, c, name: str, at: int) -> None:
        """Set a timer, or move it if the name has one."""
        c["t"][name] = at

    def delete(self, c, name: str) -> None:
        c["t"].pop(name, None)

    def on_row(self, c, r: dict) -> list:
        return []

    def on_timer(self, c, name: str, at: int) -> list:
        return []

    def _fire(self, c, before: int) -> list:
        out = []
        while c["t"]:
            at, name = min((at, name) for name, at in c["t"].items())
            if at >= before:
                break
            del c["t"][name]
            out += self.on_timer(c, name, at)
        return out

    def step(self, c, r):
        return self._fire(c, r["ts"]) + self.on_row(c, r)

    def advance(self, c, wm):
        return self._fire(c, wm)

    def deadline(self, c):
        return min(c["t"].values()) + 1 if c["t"] else None

    def idle(self, c):
        return not c["t"] and len(c) == 1


class Reminders(Timers):
    """Two timers a key: an open case is reminded of after ``remind`` and expires after ``expire``;
    a closing row deletes both, a new opening row moves both."""

    fields = ("opens", "closes")
    out_fields = (("what", "string"), ("open_ts", "long"), ("at_ts", "long"))

    def __init__(self, remind_us: int, expire_us: int):
        self.after = {"remind": remind_us, "expire": expire_us}

    def on_row(self, c, r):
        if r["closes"] or r["opens"]:
            for name in self.after:
                self.delete(c, name)
            c.pop("open", None)
        if r["opens"]:
            c["open"] = r["ts"]
            for name, us in self.after.items():
                self.register(c, name, r["ts"] + us)
        return []

    def on_timer(self, c, name, at):
        out = [{"what": name, "open_ts": c["open"], "at_ts": at}]
        if not c["t"]:
            del c["open"]
        return out


class Pairs(Machine):
    """Matching row directly followed by a matching row < within later."""
    fields = ("m",)
    out_fields = (("first_ts", "long"), ("last_ts", "long"))

    def __init__(self, within_us: int):
        self.within = within_us

    def step(self, c, r):
        out = []
        if r["m"] and c.get("m") and r["ts"] < c["ts"] + self.within:
            out.append({"first_ts": c["ts"], "last_ts": r["ts"]})
        c.clear()
        c.update(m=bool(r["m"]), ts=r["ts"])
        return out

    def columns(self, r: Runs):
        had = [i for i, c in enumerate(r.carries) if c]
        run, ts, m = r.headed(had, (r.ts, [r.carries[i]["ts"] for i in had]), (r.flag("m"), [r.carries[i]["m"] for i in had]))
        at = np.flatnonzero(m[1:] & m[:-1] & (run[1:] == run[:-1]) & (ts[1:] < ts[:-1] + self.within))
        last = np.flatnonzero(np.diff(run, append=-1))
        for c, m_last, ts_last in zip(r.carries, m[last].tolist(), ts[last].tolist()):
            c.clear()
            c.update(m=m_last, ts=ts_last)
        return run[at], {"first_ts": ts[at], "last_ts": ts[at + 1]}

    def advance(self, c, wm):
        # No later row can pair with the last one any more: forget it.
        if c and c["ts"] + self.within <= wm:
            c.clear()
        return []

    def deadline(self, c):
        return c["ts"] + self.within if c else None


class Bursts(Machine):
    """Run of fails; warn at t0 + span if >= n fails and no breaker by then."""
    fields = ("f",)
    out_fields = (("first_ts", "long"), ("last_ts", "long"), ("n_fails", "long"))

    def __init__(self, span_us: int, min_count: int):
        self.span, self.n = span_us, min_count

    def _decide(self, c):
        out = []
        if c.get("state") == "open":
            if c["n"] >= self.n:
                out.append({"first_ts": c["t0"], "last_ts": c["last"], "n_fails": c["n"]})
            c["state"] = "decided"
        return out

    def step(self, c, r):
        out = []
        if c.get("state") == "open" and r["ts"] > c["t0"] + self.span:
            out += self._decide(c)
        if r["f"]:
            if not c.get("state"):
                c.update(state="open", t0=r["ts"], last=r["ts"], n=1)
            elif c["state"] == "open":
                c["n"] += 1
                c["last"] = r["ts"]
        else:
            c.clear()
        return out

    def advance(self, c, wm):
        if c.get("state") == "open" and c["t0"] + self.span < wm:
            return self._decide(c)
        return []

    def deadline(self, c):
        return c["t0"] + self.span + 1 if c.get("state") == "open" else None

    def idle(self, c):
        return not c.get("state")


class FollowedBy(Machine):
    """Each first takes the first later then; gap < within -> matched."""
    fields = ("a", "b")
    only = ("a", "b")
    out_fields = (("first_ts", "long"), ("then_ts", "long"), ("outcome", "string"))

    def __init__(self, within_us: int):
        self.within = within_us

    def step(self, c, r):
        out = []
        opened = c.setdefault("open", [])
        if r["b"] and opened:
            for t in opened:
                ok = r["ts"] < t + self.within
                out.append({"first_ts": t, "then_ts": r["ts"] if ok else None,
                            "outcome": "matched" if ok else "timeout"})
            opened.clear()
        if r["a"]:
            opened.append(r["ts"])
        return out

    def columns(self, r: Runs):
        heads = [(i, t) for i, c in enumerate(r.carries) for t in c.get("open", ())]
        run, ts, a, b = r.headed([i for i, _ in heads], (r.ts, [t for _, t in heads]), (r.flag("a"), [True] * len(heads)),
                                 (r.flag("b"), [False] * len(heads)))
        firsts, thens = np.flatnonzero(a), np.flatnonzero(b)
        then = np.append(thens, -1)[np.searchsorted(thens, firsts, side="right")]  # -1: none
        closed = (then >= 0) & (run[then] == run[firsts])
        for c in r.carries:
            c["open"] = []
        for i, t in zip(run[firsts[~closed]].tolist(), ts[firsts[~closed]].tolist()):
            r.carries[i]["open"].append(t)
        firsts, then = firsts[closed], then[closed]
        ok = ts[then] < ts[firsts] + self.within
        return run[firsts], {"first_ts": ts[firsts], "then_ts": pa.array(ts[then], mask=~ok), "outcome": pa.array(np.where(ok, "matched", "timeout"))}

    def advance(self, c, wm):
        out, keep = [], []
        for t in c.get("open", []):
            if t + self.within <= wm:
                out.append({"first_ts": t, "then_ts": None, "outcome": "timeout"})
            else:
                keep.append(t)
        c["open"] = keep
        return out

    def deadline(self, c):
        return min(c["open"]) + self.within if c.get("open") else None

    def idle(self, c):
        return not c.get("open")


class MatchOutcomes(Machine):
    """create/pay machine (rows other than create/pay are filtered out)."""
    fields = ("cr",)
    out_fields = (("outcome", "string"), ("create_ts", "long"), ("pay_ts", "long"))

    def __init__(self, bound_us: int, grace_us):
        self.bound, self.grace = bound_us, grace_us

    def _limit(self, t):
        return None if self.grace is None else t + self.bound + self.grace

    def step(self, c, r):
        out, t = [], r["ts"]
        open_ts = c.get("open")
        if r["cr"]:
            if open_ts is not None:
                out.append({"outcome": "timeout", "create_ts": open_ts, "pay_ts": None})
            c["open"] = t
            return out
        if open_ts is None:
            return [{"outcome": "pay_without_create", "create_ts": None, "pay_ts": t}]
        gap, lim = t - open_ts, self._limit(open_ts)
        if gap < self.bound:
            out.append({"outcome": "paid", "create_ts": open_ts, "pay_ts": t})
        elif lim is None or t < lim:
            out.append({"outcome": "paid_late", "create_ts": open_ts, "pay_ts": t})
        else:
            out.append({"outcome": "timeout", "create_ts": open_ts, "pay_ts": None})
            out.append({"outcome": "pay_without_create", "create_ts": None, "pay_ts": t})
        c["open"] = None
        return out

    def columns(self, r: Runs):
        had = [i for i, c in enumerate(r.carries) if c.get("open") is not None]
        run, ts, cr = r.headed(had, (r.ts, [r.carries[i]["open"] for i in had]), (r.flag("cr"), [True] * len(had)))
        same = run[1:] == run[:-1]  # the next row is of the same key
        paid = np.flatnonzero(cr[:-1] & same & ~cr[1:])  # a create directly before a pay
        anew = np.flatnonzero(cr[:-1] & same & cr[1:])
        alone = np.flatnonzero(~cr & ~np.append(False, cr[:-1] & same))
        gap = ts[paid + 1] - ts[paid]
        over = (gap >= self.bound + self.grace) & (gap >= self.bound) if self.grace is not None else np.zeros(len(paid), bool)
        for c in r.carries:
            c["open"] = None
        last = np.flatnonzero(np.diff(run, append=-1))
        last = last[cr[last]]
        for i, t in zip(run[last].tolist(), ts[last].tolist()):
            r.carries[i]["open"] = t
        kept, out = paid[~over], paid[over]
        gone, unpaid = np.concatenate([anew, out]), np.concatenate([alone, out + 1])
        at = np.concatenate([kept, gone, unpaid])
        pay = np.concatenate([kept + 1, gone, unpaid])
        what = np.concatenate([np.where(gap[~over] < self.bound, "paid", "paid_late"), np.full(len(gone), "timeout"),
                               np.full(len(unpaid), "pay_without_create")])
        rank = np.repeat([0, 1, 2], [len(kept), len(gone), len(unpaid)])
        return run[at], {"outcome": pa.array(what), "create_ts": pa.array(ts[at], mask=rank == 2), "pay_ts": pa.array(ts[pay], mask=rank == 1)}

    def advance(self, c, wm):
        o = c.get("open")
        if o is not None and self.grace is not None and self._limit(o) <= wm:
            c["open"] = None
            return [{"outcome": "timeout", "create_ts": o, "pay_ts": None}]
        return []

    def deadline(self, c):
        o = c.get("open")
        return None if o is None or self.grace is None else self._limit(o)

    def idle(self, c):
        return c.get("open") is None


class Cap(Machine):
    """Per key and UTC day pass the first ``cap`` rows, warn on cap+1.

    Rows arrive in time order, so a new day simply restarts the count; once
    the watermark passes the day's end the state is dropped.
    """
    DAY = 86_400_000_000

    def __init__(self, cap: int, carry=()):
        self.cap = cap
        self.carry = tuple(carry)
        self.fields = ("day",) + self.carry
        # carried columns keep their input type (None = same as input)
        self.out_fields = (("tag", "string"), ("ts_out", "long"), ("seq_out", "long"),
                           ("day_out", "long")) + tuple((c, None) for c in self.carry)

    def step(self, c, r):
        if c.get("day") != r["day"]:
            c["day"], c["n"] = r["day"], 0
        c["n"] += 1
        n = c["n"]
        tag = "passed" if n <= self.cap else "warning" if n == self.cap + 1 else None
        if tag is None:
            return []
        return [{"tag": tag, "ts_out": r["ts"], "seq_out": r["seq"], "day_out": r["day"],
                 **{k: r[k] for k in self.carry}}]

    def columns(self, r: Runs):
        day = r.cols["day"].to_numpy()
        first = (np.diff(r.run, prepend=-1) != 0) | (np.diff(day, prepend=0) != 0)
        starts = np.flatnonzero(first)  # of the days of a key
        before = np.zeros(len(starts), np.int64)
        for c, at, d in zip(r.carries, np.searchsorted(starts, r.starts).tolist(), day[r.starts].tolist()):
            if c.get("day") == d:
                before[at] = c["n"]
        n = np.arange(1, len(day) + 1) + np.repeat(before - starts, np.diff(starts, append=len(day)))
        last = np.flatnonzero(np.diff(r.run, append=-1))
        for c, d, k in zip(r.carries, day[last].tolist(), n[last].tolist()):
            c["day"], c["n"] = d, k
        at = np.flatnonzero(n <= self.cap + 1)
        pick = pa.array(at)
        return r.run[at], {"tag": pa.array(np.where(n[at] <= self.cap, "passed", "warning")), "ts_out": r.ts[at], "seq_out": r.cols["seq"].take(pick),
                           "day_out": day[at], **{k: r.cols[k].take(pick) for k in self.carry}}

    def advance(self, c, wm):
        if c.get("day") is not None and c["day"] + self.DAY <= wm:
            c.clear()
        return []

    def deadline(self, c):
        return c["day"] + self.DAY if c.get("day") is not None else None
