"""Stateful operators of streams: entries of feeds that are new, and the latest search before a call."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Ids that a feed remembers; entries that one fetch takes.
MOST_IDS, MOST_ENTRIES = 2000, 50
FEED = "feed string, fetched long, entry_id string, published long"
FEED_STATE = "ids array<string>, last long"
#: Turns that a search is remembered for.
TURNS = 3
FOUND = "session_id string, event_id long, turn_index long, query_turn long, query_id long"
#: Groups that sessions are dealt to, and what one holds: its sessions with their newest turns and when they had rows last
#: (ms), and searches with the places of their sessions.
BUCKETS = 1024
HELD = "sessions array<string>, latest array<long>, seen array<long>, owners array<long>, turns array<long>, ids array<long>"
Held = tuple[list[str | None], list[int], list[int], list[int], list[int], list[int]]


def take_new(rows: pd.DataFrame, ids: list[str], last: int | None, most_ids: int = MOST_IDS, most_entries: int = MOST_ENTRIES) -> tuple[pd.DataFrame, list[str], int | None]:
    """The entries of one feed that are new, fetch by fetch, and what the feed remembers then.

    An entry is new if its id isn't remembered and it wasn't published before or at the last fetch that took something
    (an unknown date passes). Of a fetch the newest `most_entries` in order of (published, id) are taken, an id once.
    The ids taken last are remembered: the oldest go first, and within a fetch those that were taken first.
    """
    taken, known = [], dict.fromkeys(ids)
    for fetched, group in rows.sort_values(["fetched", "published", "entry_id"], ascending=[True, False, True], na_position="first", kind="stable").groupby("fetched", sort=True):
        fresh = group[~group["entry_id"].isin(known)].drop_duplicates("entry_id")
        if last is not None:
            fresh = fresh[~(fresh["published"] <= last)]
        fresh = fresh.head(most_entries)
        if len(fresh):
            taken.append(fresh)
            known |= dict.fromkeys(fresh["entry_id"])
            if len(known) > most_ids:
                known = dict.fromkeys(list(known)[-most_ids:])
            last = int(fetched)
    return pd.concat(taken) if taken else rows.head(0), list(known), last


def new_entries(entries: DataFrame, most_ids: int = MOST_IDS, most_entries: int = MOST_ENTRIES, quiet_ms: int = 0) -> DataFrame:
    """The new entries of a stream of fetched ones (the columns of FEED; times in any unit, the same for both).

    Fetches of a feed come in order, a fetch within one micro-batch; state is at most most_ids ids a feed. With quiet_ms
    a feed that isn't fetched for that long is forgotten. Repeats that come late across fetches beyond that bound are for
    windows.dedupe(), which keeps ids by event time.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        ids, last = state.get if state.exists else ([], None)
        out, ids, last = take_new(pd.concat(list(batches)), list(ids), last, most_ids, most_entries)
        state.update((ids, last))
        if quiet_ms:
            state.setTimeoutDuration(quiet_ms)
        yield out[["feed", "fetched", "entry_id", "published"]]

    timeout = GroupStateTimeout.ProcessingTimeTimeout if quiet_ms else GroupStateTimeout.NoTimeout
    rows = entries.selectExpr(*[f"CAST({n} AS {t}) AS {n}" for n, t in (f.split() for f in FEED.split(", "))])
    return rows.groupBy("feed").applyInPandasWithState(step, FEED, FEED_STATE, "append", timeout)


def find_near(rows: pd.DataFrame, held: Held, turns: int = TURNS, late_turns: int = 0, now: int = 0, quiet_ms: int = 0) -> tuple[pd.DataFrame, Held]:
    """rows of many sessions, each with its nearest search, and what is held of the sessions then.

    rows: session_id, event_id, turn_index, is_search, has_id, has_turn (an id or turn that isn't there is any number: a
    null would turn the column into floats). One pass over arrays, whatever the number of sessions. Of a session are held
    its newest turn and the searches that calls up to late_turns behind it may find; with quiet_ms one without rows for
    that long goes.
    """
    names, latest, seen, owners, at, ids = held
    codes, known = pd.factorize(np.concatenate([np.array(names, dtype=object), rows["session_id"].to_numpy(object)]), use_na_sentinel=False)
    owner, (named, dated) = codes[len(names) :], rows[["has_id", "has_turn"]].to_numpy(bool).T
    own, own_id = rows["turn_index"].to_numpy(np.int64), rows["event_id"].to_numpy(np.int64)
    asked = rows["is_search"].to_numpy(bool) & named & dated
    # searches, held and new; one of nobody comes first, so that each row has one before it
    owners, at, ids = (np.concatenate([np.array([first, *old], dtype=np.int64), new[asked].astype(np.int64)]) for first, old, new in ((-1, owners, owner), (0, at, own), (0, ids, own_id)))
    n = len(at)
    # by session and turn; rows come before the searches of their own turn
    place = np.arange(n + len(rows))
    order = np.lexsort((np.concatenate([ids, own_id]), place < n, np.concatenate([at, own]), np.concatenate([owners, owner])))
    near = np.empty(len(order), dtype=np.int64)
    near[order] = order[np.maximum.accumulate(np.where(order < n, place, 0))]
    near = near[n:]
    found = dated & (owners[near] == owner) & (at[near] >= own - turns)
    numbers = {"event_id": (own_id, named), "turn_index": (own, dated), "query_turn": (at[near], found), "query_id": (ids[near], found)}
    out = rows[["session_id"]].assign(**{name: pd.arrays.IntegerArray(x, ~there, copy=True) for name, (x, there) in numbers.items()})
    newest = np.full(len(known), -1, dtype=np.int64)
    newest[: len(names)] = latest
    np.maximum.at(newest, owner[dated], own[dated])
    at_work = np.full(len(known), now, dtype=np.int64)
    at_work[: len(names)] = seen
    at_work[owner] = now
    left = (at_work > now - quiet_ms) if quiet_ms else np.ones(len(known), dtype=bool)
    stay = (at > newest[owners] - turns - late_turns) & left[owners] & (owners >= 0)
    names = [None if pd.isna(x) else x for x in known[left]]
    return out, (names, newest[left].tolist(), at_work[left].tolist(), (np.cumsum(left) - 1)[owners[stay]].tolist(), at[stay].tolist(), ids[stay].tolist())


def lookback(calls: DataFrame, turns: int = TURNS, late_turns: int = 0, quiet_ms: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """Each call of a stream (session_id, event_id, turn_index, is_search) with the nearest search of the `turns` before it.

    Of a session the searches of the last turns + late_turns turns are remembered: a call may come that much later
    than the session's newest one; one that is later still isn't joined. A search itself must come before, or in one
    micro-batch with, the calls it is found by; one without an id or a turn isn't found. With quiet_ms a silent session
    is forgotten.

    State is by bucket of sessions (a hash of the id), not by session: sessions are many and short, and a call into
    Python costs more than a session's rows. A bucket's rows of a micro-batch and its state are in memory together:
    take more buckets for more sessions. A checkpoint goes with its number of buckets.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = state.get if state.exists else ([], [], [], [], [], [])
        out, held = find_near(pd.concat(list(batches), ignore_index=True), held, turns, late_turns, state.getCurrentProcessingTimeMs() if quiet_ms else 0, quiet_ms)
        state.update(held)
        if quiet_ms:
            state.setTimeoutDuration(quiet_ms)
        yield out

    timeout = GroupStateTimeout.ProcessingTimeTimeout if quiet_ms else GroupStateTimeout.NoTimeout
    rows = calls.selectExpr("session_id", "coalesce(CAST(event_id AS LONG), 0) AS event_id", "coalesce(CAST(turn_index AS LONG), 0) AS turn_index", "coalesce(is_search, false) AS is_search", "CAST(event_id AS LONG) IS NOT NULL AS has_id", "CAST(turn_index AS LONG) IS NOT NULL AS has_turn", f"pmod(xxhash64(session_id), {int(buckets)}) AS bucket")
    return rows.groupBy("bucket").applyInPandasWithState(step, FOUND, HELD, "append", timeout)
