"""One call serves all keys of a bucket, and entries leave the state when their time is over."""

import pandas as pd

from tallyward.streaming import online as On


class State:
    def __init__(self):
        self.value, self.mark, self.hasTimedOut, self.expires = None, 0, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def getCurrentWatermarkMs(self):
        return self.mark

    def setTimeoutTimestamp(self, ms):
        self.expires = ms


def call(run, state, frame=None):
    state.hasTimedOut = frame is None
    return pd.concat([pd.DataFrame(), *run((1,), iter([] if frame is None else [frame]), state)])


def requests(*rows):
    return pd.DataFrame(rows, columns=["key", "window_start", "us", "id"])


def test_limit_of_many_keys_in_one_call():
    run, state = On._limit(2, 10), State()
    out = call(run, state, requests(("a", 0, 3, 1), ("b", 0, 1, 2), ("a", 0, 1, 3), ("a", 10, 11, 4), (None, 0, 2, 5), ("a", 0, 2, 6)))
    assert dict(zip(out["id"], out["allowed"])) == {2: True, 3: True, 5: True, 6: True, 1: False, 4: True}
    assert state.expires == 10_000
    state.mark = 9_000
    out = call(run, state, requests(("a", 0, 9, 7), ("b", 0, 9, 8), (None, 0, 9, 9), (None, 0, 9, 10)))
    assert dict(zip(out["id"], out["remaining"])) == {7: 0, 8: 0, 9: 0, 10: 0}
    assert dict(zip(out["id"], out["allowed"])) == {7: False, 8: True, 9: True, 10: False}
    state.mark = 10_000
    assert call(run, state).empty
    assert state.value == (["a"], [10], [1])
    state.mark = 20_000
    call(run, state)
    assert state.value is None


def test_repeats_of_many_keys_in_one_call():
    run, state = On._repeats(10_000_000), State()
    frame = lambda *rows: pd.DataFrame(rows, columns=["key", "us", "id"])
    out = call(run, state, frame(("a", 0, 1), ("b", 5_000_000, 2), ("a", 9_000_000, 3), ("a", 10_000_000, 4)))
    assert dict(zip(out["id"], out["computed"])) == {1: True, 2: True, 3: False, 4: True}
    out = call(run, state, frame(("b", 14_000_000, 5), ("a", 20_000_000, 6)))
    assert dict(zip(out["id"], out["computed"])) == {5: False, 6: True}
    state.mark = 15_001
    call(run, state)
    assert state.value == (["a"], [20_000_000])


def test_velocity_reads_one_state_and_drops_old_slices():
    hour = On.SLICE_US
    run, state = On._velocity([hour], 1), State()
    frame = lambda *rows: pd.DataFrame(rows, columns=["us", "amount", "id"])
    out = call(run, state, frame((0, 1.0, 1), (hour // 2, 2.0, 2), (hour, float("nan"), 3)))
    assert out["n0"].tolist() == [1, 2, 1] and out["s0"].tolist() == [1, 3, 2]
    state.mark = 3 * hour // 1000
    out = call(run, state, frame((5 * hour, 4.0, 4)))
    assert out["gap"].tolist() == [4 * 3600.0] and out["n0"].tolist() == [1]
    assert list(state.value[0]) == [5 * hour]
