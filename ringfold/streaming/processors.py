"""Keyed stateful processors. Each runs on a stream and, unchanged, on a batch DataFrame.

On a stream, state that nothing can need any more expires: `ttl_ms` after it was last written, in processing time, which is never
before its event time has passed. On a batch there is no clock and ttl_ms is None. State lives in the state store (RocksDB where the session names it); event times in microseconds are compared
explicitly, so a replay gives the same rows. Within a micro-batch a key's rows are put in order of (ts_us, id).
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import chain, groupby
from math import floor
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The column of a row's bucket, where groups are buckets of keys. No underscore comes first, as Spark hands on rows as named tuples.
BUCKET = "bucket_of_key"
DAY = 86_400_000_000
HOUR = 3_600_000_000


def round4(x: float) -> float:
    return floor(x * 10000 + 0.5) / 10000


def _ordered(rows: Iterator[pd.DataFrame], *by: str) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(list(by), kind="stable")


def _runs(keys: list) -> Iterator[tuple[Any, int, int]]:
    """(key, begin, end) for each run of equal keys."""
    begin = 0
    for k, g in groupby(keys):
        end = begin + sum(1 for _ in g)
        yield k, begin, end
        begin = end


class GapFilter(StatefulProcessor):
    """Emit a key's first row, drop rows within `gap` of the last emitted one, emit the next. An exact gap passes if inclusive.

    With `by` a group is a bucket of many keys, named by that column: what Spark and pandas cost for each group is then paid once
    for the bucket, and a key costs a read of its state, if the bucket has any, and a write. free: rows where this column is true are kept in any case and hold nothing back.
    packed: a key's kept rows of a micro-batch are one row, with arrays of their times and of `tie`, and of other columns the first value.
    """

    def __init__(self, gap: int, tie: str, inclusive: bool = True, ttl_ms: int | None = None, by: str | None = None, free: str | None = None, packed: bool = False) -> None:
        self.gap, self.tie, self.ttl_ms, self.by, self.free, self.packed = gap if inclusive else gap + 1, tie, ttl_ms, by, free, packed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "key string", "us long", self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        d = _ordered(rows, *([self.by] if self.by else []), "ts_us", self.tie)
        names = d[self.by].tolist() if self.by else [""] * len(d)
        times = d["ts_us"].tolist()
        frees = d[self.free].tolist() if self.free else None
        old, keep, firsts, ends = self.last.exists(), [], [], []
        for k, begin, end in _runs(names):
            had = self.last.getValue((k,)) if old and self.last.containsKey((k,)) else None
            last = had[0] if had else None
            before = len(keep)
            for i in range(begin, end):
                if frees and frees[i]:
                    keep.append(i)
                elif last is None or times[i] - last >= self.gap:
                    keep.append(i)
                    last = times[i]
            if last is not None and (not had or last != had[0] or self.ttl_ms):
                self.last.updateValue((k,), (last,))
            if len(keep) > before:
                firsts.append(keep[before])
                ends.append(len(keep))
        if not keep:
            return
        if not self.packed:
            yield d.iloc[keep].drop(columns=BUCKET, errors="ignore")
            return
        out, ids = d.iloc[firsts].drop(columns=BUCKET, errors="ignore"), d[self.tie].tolist()
        spans = list(zip([0, *ends[:-1]], ends, strict=True))
        out["ts_us"] = [[times[i] for i in keep[b:e]] for b, e in spans]
        out[self.tie] = [[ids[i] for i in keep[b:e]] for b, e in spans]
        yield out

    def close(self) -> None:
        pass


class Features(StatefulProcessor):
    """Features of an account's transactions from a history of 24 hours (and `late` microseconds) and running sums of all amounts.

    A row that comes late counts what lay in its past, and nothing after its own time. The windows move over the sorted
    history with two pointers, so a busy account costs its rows and not their square. A group is a bucket of accounts, or one
    account; an account's history is one entry of map state, so it costs two reads, if the bucket has state, and two writes.
    """

    def __init__(self, late: int = 10_000_000, ttl_ms: int | None = None) -> None:
        self.late, self.ttl_ms = late, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.history = handle.getMapState("history", "account string", "json string", self.ttl_ms)
        self.sums = handle.getMapState("sums", "account string", "n long, s string, q string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        d = _ordered(rows, "account_id", "ts_us", "transaction_id")
        text = lambda c: [v if isinstance(v, str) and v else None for v in d[c].tolist()]
        new = [
            (us, cents, device, ip, cents < 100, us // HOUR % 24 in NIGHT, (country or "US").upper() != "US")
            for us, cents, device, ip, country in zip(d["ts_us"].tolist(), d["amount_cents"].tolist(), text("device_id"), text("ip_address"), text("country_code"), strict=True)
        ]
        ids, out = d["transaction_id"].tolist(), []
        old, summed = self.history.exists(), self.sums.exists()
        for account, begin, end in _runs(d["account_id"].tolist()):
            had = (account,)
            past = [tuple(x) for x in json.loads(self.history.getValue(had)[0])] if old and self.history.containsKey(had) else []
            n, s, q = (int(v) for v in self.sums.getValue(had)) if summed and self.sums.containsKey(had) else (0, 0, 0)
            mine = new[begin:end]
            seen = sorted(past + mine, key=lambda h: h[0]) if past else mine
            day, near = _Window(seen, DAY), _Window(seen, HOUR)
            for i, (us, cents, *_) in enumerate(mine, begin):
                day.move(us)
                near.move(us)
                n, s, q = n + 1, s + cents, q + cents * cents
                spread = float(n * q - s * s) ** 0.5
                out.append((
                    ids[i], account, us, cents, near.size, day.size, round4(float(s) / n / 100), round4(spread / n / 100 if n > 1 else 0.0),
                    round4((float(cents) * n - float(s)) / spread if n > 1 and spread > 0 else 0.0), 0, len(near.devices), len(near.ips),
                    round4(day.flags[2] / max(day.size, 1)), round4(day.flags[1] / max(day.size, 1)), round4(near.flags[0] / max(near.size, 1)), 0.0,
                ))
            least = seen[-1][0] - DAY - self.late
            self.history.updateValue(had, (json.dumps([h for h in seen if h[0] >= least]),))
            self.sums.updateValue(had, (n, str(s), str(q)))
        yield pd.DataFrame(out, columns=FEATURE_COLUMNS)

    def close(self) -> None:
        pass


#: Hours of the night, UTC.
NIGHT = (23, 0, 1, 2, 3, 4)


class _Window:
    """The entries of a sorted history from `width` before a time up to it, for times that do not fall."""

    def __init__(self, seen: list[tuple], width: int) -> None:
        self.seen, self.width, self.lo, self.hi = seen, width, 0, 0
        self.devices, self.ips, self.flags = Counter(), Counter(), [0, 0, 0]

    @property
    def size(self) -> int:
        return self.hi - self.lo

    def move(self, us: int) -> None:
        while self.hi < len(self.seen) and self.seen[self.hi][0] <= us:
            self._count(self.seen[self.hi], 1)
            self.hi += 1
        while self.seen[self.lo][0] < us - self.width:
            self._count(self.seen[self.lo], -1)
            self.lo += 1

    def _count(self, h: tuple, by: int) -> None:
        for kinds, value in ((self.devices, h[2]), (self.ips, h[3])):
            if value:
                kinds[value] += by
                if not kinds[value]:
                    del kinds[value]
        for k in (0, 1, 2):
            self.flags[k] += by * h[4 + k]


FEATURE_COLUMNS = [
    "transaction_id", "account_id", "ts_us", "amount_cents", "txn_velocity_1h", "txn_velocity_24h", "amount_mean_30d", "amount_stddev_30d", "amount_zscore", "unique_merchants_30d",
    "unique_devices_30d", "unique_ips_30d", "cross_border_ratio", "night_txn_ratio", "card_testing_score", "mule_account_score",
]
FEATURE_SCHEMA = (
    "transaction_id string, account_id string, ts_us long, amount_cents long, txn_velocity_1h long, txn_velocity_24h long, amount_mean_30d double, amount_stddev_30d double, amount_zscore double, unique_merchants_30d long, "
    "unique_devices_30d long, unique_ips_30d long, cross_border_ratio double, night_txn_ratio double, card_testing_score double, mule_account_score double"
)


class _Part:
    """A component while its shard's micro-batch runs. run: the row of snapshots that were put out since its lists last changed."""

    __slots__ = ("size", "edges", "members", "txns", "first", "last", "run", "pass_")

    def __init__(self, size: int, edges: int, members: list[str], txns: list[str], first: int, last: int) -> None:
        self.size, self.edges, self.members, self.txns, self.first, self.last, self.run, self.pass_ = size, edges, members, txns, first, last, None, 0


class Resolver(StatefulProcessor):
    """Incremental components under one shard key: a snapshot whenever an edge merges two components.

    `absorbed` names the component that the merge ended. With heartbeat_ms, on a stream, the snapshots of all components
    of `least` nodes or more come again and again by a timer, with a null there. Parents and each root's record are
    map state; a find halves its path. A shard is sequential, as merging is; independent shards run side by side.

    In: a row an edge key, as a packed GapFilter puts out; names become numbers and transaction ids Arrow strings at
    once, so an edge takes some 40 bytes while its micro-batch is put in order of (ts_us, edge_key). Out: runs of snapshots
    of a component while its lists stay as they are, RUN at most; unrolled() makes them a row each. Most merges of a large
    component leave its smallest 500 as they were, so the one task does not write a thousand ids for each of them.
    """

    def __init__(self, most: int = 500, heartbeat_ms: int | None = None, least: int = 3) -> None:
        self.most, self.heartbeat_ms, self.least = most, heartbeat_ms, least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parent = handle.getMapState("parent", "node string", "parent string")
        self.record = handle.getMapState("record", "root string", "json string")

    def _read(self, rows: Iterator[pd.DataFrame]) -> None:
        """Keys, their ends as numbers, and a (key, time, id) for each of their edges."""
        self.names, self.up, self.stored, self.code = [], [], {}, {}
        known = self.parent.exists()

        def number(name: str) -> int:
            """Of a node, and of those above it in state."""
            x = self.code.get(name)
            if x is None:
                x = self.code[name] = len(self.names)
                self.names.append(name)
                self.up.append(x)
                if known and self.parent.containsKey((name,)):
                    self.stored[x] = self.up[x] = number(self.parent.getValue((name,))[0])
            return x

        keys, self.source, self.target, counts, times, ids = [], [], [], [], [], []
        for d in rows:
            keys += d["edge_key"].tolist()
            self.source += [number(v) for v in d["source_id"]]
            self.target += [number(v) for v in d["target_id"]]
            counts.append(d["ts_us"].map(len).to_numpy(np.int64))
            times.append(np.fromiter(chain.from_iterable(d["ts_us"]), np.int64))
            ids.append(pa.array(list(chain.from_iterable(d["transaction_id"])), pa.large_string()))
        rank = np.empty(len(keys), np.int32)
        rank[sorted(range(len(keys)), key=keys.__getitem__)] = np.arange(len(keys), dtype=np.int32)
        self.key, self.us, self.ids = np.repeat(np.arange(len(keys), dtype=np.int32), np.concatenate(counts)), np.concatenate(times), pa.concat_arrays(ids)
        self.order = np.lexsort((rank[self.key], self.us))

    def _edges(self) -> Iterator[tuple[int, int, str]]:
        for i in range(0, len(self.order), STEP):
            some = self.order[i : i + STEP]
            yield from zip(self.key[some].tolist(), self.us[some].tolist(), self.ids.take(pa.array(some)).to_pylist(), strict=True)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        self._read(rows)
        up, names, source, target, most = self.up, self.names, self.source, self.target, self.most
        parts: dict[int, _Part] = {}
        from_state: set[int] = set()
        recorded = self.record.exists()
        met = bytearray(len(source))
        runs, held, pass_ = [], 0, 1

        def find(x: int) -> int:
            while (p := up[x]) != x:
                up[x] = x = up[p]
            return x

        def part(x: int, us: int) -> _Part:
            p = parts.get(x)
            if p is None:
                name = (names[x],)
                if recorded and self.record.containsKey(name):
                    r = json.loads(self.record.getValue(name)[0])
                    p = _Part(r["size"], r["edges"], r["members"], r["txns"], r["first"], r["last"])
                    from_state.add(x)
                else:
                    p = _Part(1, 0, [names[x]], [], us, us)
                parts[x] = p
            return p

        for k, us, txn in self._edges():
            a, ended = find(source[k]), None
            r = part(a, us)
            if not met[k]:  # later edges of a key lie within its component
                met[k] = 1
                b = find(target[k])
                if a != b:
                    o = part(b, us)
                    if o.size > r.size:
                        a, b, r, o = b, a, o, r
                    up[b], ended = a, b
                    members, txns = _smallest(r.members, o.members, most), _smallest(r.txns, o.txns, most)
                    if members is not r.members or txns is not r.txns:
                        r.members, r.txns, r.run = members, txns, None
                    r.size, r.edges, r.first = r.size + o.size, r.edges + o.edges, min(r.first, o.first)
                    del parts[b]
                    if b in from_state:
                        self.record.removeKey((names[b],))
            r.edges += 1
            if us > r.last:
                r.last = us
            if len(r.txns) < most or txn < r.txns[-1]:
                txns = _smallest(r.txns, [txn], most)
                if txns is not r.txns:
                    r.txns, r.run = txns, None
            if ended is not None:
                if r.run is None or r.pass_ != pass_ or len(r.run[3]) >= RUN:
                    r.run, r.pass_ = (names[a], r.members, r.txns, [], [], [], [], []), pass_
                    runs.append(r.run)
                    held += len(r.members) + len(r.txns)
                for column, v in zip(r.run[3:], (r.size, r.edges, r.first, us, names[ended]), strict=True):
                    column.append(v)
                if held >= HELD:
                    yield pd.DataFrame(runs, columns=RUN_COLUMNS)
                    runs, held, pass_ = [], 0, pass_ + 1
        for x in range(len(up)):
            p = find(x)
            if p != x and self.stored.get(x) != p:
                self.parent.updateValue((names[x],), (names[p],))
        for x, r in parts.items():
            self.record.updateValue((names[x],), (json.dumps({"size": r.size, "edges": r.edges, "members": r.members, "txns": r.txns, "first": r.first, "last": r.last}),))
        del self.names, self.up, self.stored, self.code, self.source, self.target, self.key, self.us, self.ids, self.order
        if self.heartbeat_ms and not list(self.handle.listTimers()):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.heartbeat_ms)
        if runs:
            yield pd.DataFrame(runs, columns=RUN_COLUMNS)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.heartbeat_ms)
        out = []
        for (root,), (text,) in self.record.iterator():
            r = json.loads(text)
            if r["size"] >= self.least:
                out.append((root, r["members"], r["txns"], [r["size"]], [r["edges"]], [r["first"]], [r["last"]], [None]))
        if out:
            yield pd.DataFrame(out, columns=RUN_COLUMNS)

    def close(self) -> None:
        pass


def _smallest(mine: list[str], others: list[str], most: int) -> list[str]:
    """The `most` smallest distinct values of two sorted lists; the list `mine` itself if it is that."""
    if not others or (len(mine) >= most and others[0] >= mine[-1]):
        return mine
    if len(others) == 1:
        i = bisect_left(mine, others[0])
        if i < len(mine) and mine[i] == others[0]:
            return mine
        return [*mine[:i], others[0], *mine[i : most - 1]]
    return list(dict.fromkeys(sorted(mine + others)))[:most]


#: Edges that are taken from Arrow at a time, snapshots of a run, and ids in runs before they are put out.
STEP, RUN, HELD = 500_000, 1000, 2_000_000
SNAPSHOT_SCHEMA = "component_id string, size long, edge_count long, member_ids array<string>, transaction_ids array<string>, first_us long, last_us long, absorbed string"
SNAPSHOT_COLUMNS = [c.split(" ")[0] for c in SNAPSHOT_SCHEMA.split(", ")]
RUN_SCHEMA = "component_id string, member_ids array<string>, transaction_ids array<string>, size array<long>, edge_count array<long>, first_us array<long>, last_us array<long>, absorbed array<string>"
RUN_COLUMNS = [c.split(" ")[0] for c in RUN_SCHEMA.split(", ")]
