"""How often acceptance calls its state: each call is a round trip from the Python worker."""

import pandas as pd

from folioscan.streaming.acceptance import Acceptance


class State:
    def __init__(self):
        self.rows, self.calls = {}, 0

    def _called(self, value):
        self.calls += 1
        return value

    def containsKey(self, key):
        return self._called(key in self.rows)

    def getValue(self, key):
        return self._called(self.rows.get(key))

    def updateValue(self, key, value):
        self._called(None)
        self.rows[key] = value

    def exists(self):
        return bool(self.rows)

    def get(self):
        return self.rows[()]

    def update(self, value):
        self.rows[()] = value


def test_one_call_for_a_claim():
    stream = Acceptance()
    stream.accepted, stream.number = State(), State()

    def send(*rows):
        before = stream.accepted.calls
        out = pd.concat(stream.handleInputRows(("w",), iter([pd.DataFrame(rows, columns=["seq", "claim", "digest"])]), None))
        return [tuple(x) for x in out[["claim", "digest", "claim_id", "status"]].itertuples(index=False)], stream.accepted.calls - before

    rows, calls = send((2, "b", "y"), (1, "a", "x"), (3, "a", "x"), (4, "a", "z"))
    assert rows == [("a", "x", "c-w-1", "accepted"), ("b", "y", "c-w-2", "accepted"), ("a", "x", "c-w-1", "unchanged"), ("a", "x", "c-w-1", "drift")]
    assert calls == 2
    rows, calls = send((5, "b", "y"), (6, "c", "q"), (7, "b", "n"), (8, "c", "q"))
    assert rows == [("b", "y", "c-w-2", "unchanged"), ("c", "q", "c-w-3", "accepted"), ("b", "y", "c-w-2", "drift"), ("c", "q", "c-w-3", "unchanged")]
    assert calls == 3
