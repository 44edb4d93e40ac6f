"""What the stateful processors ask of the state store, and what they give, on rows alone."""

from collections import Counter

import pytest
from pyspark.sql import Row

from ticketgrain.streaming import counters, review


class Store:
    """A state store of one ticket that counts what is asked of it."""

    def __init__(self):
        self.calls, self.values, self.lists, self.timers = Counter(), {}, {}, []

    def getValueState(self, name, schema):
        return _State(self, name, self.values)

    def getListState(self, name, schema):
        return _State(self, name, self.lists)

    def registerTimer(self, at):
        self.calls["timer"] += 1
        self.timers.append(at)


class _State:
    def __init__(self, store, name, held):
        self.store, self.name, self.held = store, name, held

    def _called(self, what):
        self.store.calls[f"{self.name}.{what}"] += 1

    def exists(self):
        self._called("exists")
        return self.name in self.held

    def get(self):
        self._called("get")
        return self.held.get(self.name)

    def update(self, value):
        self._called("update")
        self.held[self.name] = value

    def appendList(self, rows):
        self._called("append")
        self.held.setdefault(self.name, []).extend(rows)

    def clear(self):
        self._called("clear")
        self.held.pop(self.name, None)


class Clock:
    def getCurrentWatermarkInMs(self):
        return 5


def run(processor, store, rows):
    processor.init(store)
    store.calls.clear()
    return list(processor.handleInputRows((1,), iter(rows), Clock()))


def action(ts_us, number, kind, text=None):
    return Row(ts_us=ts_us, action_id=number, action=kind, text=text, reviewer=None)


def fact(ts_us, number, kind, high=False):
    return Row(ts_us=ts_us, action_id=number, kind=kind, high=high)


def test_a_ticket_costs_a_read_a_write_and_a_timer():
    store = Store()
    found = run(review._ReviewProcessor(1000), store, [action(9000, 2, "approve", "sent"), action(7000, 1, "modify", "new")])
    assert found == [Row(ticket_id=1, status="approved", edited_response="new", final_text="sent", reviewer=None)]
    assert store.calls == {"review.get": 1, "review.update": 1, "timer": 1} and store.timers == [1009]
    store = Store()
    found = run(counters._CounterProcessor(1000), store, [fact(9000, 2, "approve"), fact(7000, 0, "submitted", True)])
    assert found == [Row(total=1, approved=1, pending=0, high_priority=1)]
    assert store.calls == {"ticket.get": 1, "ticket.update": 1, "timer": 1} and store.timers == [1009]


def test_actions_without_a_time_come_last():
    store = Store()
    found = run(review._ReviewProcessor(1000), store, [action(None, 1, "reject"), action(None, 2, "modify", "late"), action(7000, 3, "approve")])
    assert [(r.status, r.edited_response) for r in found] == [("approved", None)] and store.timers == [1007]
    store = Store()
    assert run(counters._CounterProcessor(1000), store, [fact(None, 1, "reject")]) == [] and store.timers == [1005]


@pytest.mark.parametrize("closed_at", [None, 1500, 2500])
def test_many_edits_wait_in_the_state_store(closed_at):
    edits = [action(1000 + k, k, "modify", f"t{k}") for k in range(2 * review._HELD_EDITS + 3)]
    rows = edits + ([action(closed_at, 0, "approve")] if closed_at else [])
    store = Store()
    found = run(review._ReviewProcessor(), store, rows)
    last = len(edits) - 1 if closed_at is None else closed_at - 1001
    assert [r.edited_response for r in found] == [f"t{last}"]
    assert store.calls["edits.append"] == 2 and "edits" not in store.lists
