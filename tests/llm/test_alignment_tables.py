"""The alignment's tables: entries of the older one come back, and none are asked for twice."""

from __future__ import annotations

from factloom.llm.token_alignment import Table


class Asked(dict):
    def __init__(self, *a):
        super().__init__(*a)
        self.n = 0

    def __contains__(self, k):
        self.n += 1
        return super().__contains__(k)


def test_missing_asks_the_table_once_a_key():
    t = Table(2)
    t.update({"a": 1, "b": 2, "c": 3})
    t.turn()
    t["d"] = 4
    t.older = Asked(t.older)
    calls = []
    kind = type("Counted", (Table,), {"__contains__": lambda self, k: calls.append(k) or dict.__contains__(self, k)})
    t.__class__ = kind
    assert t.missing({"a", "d", "e"}) == {"e"}
    assert dict(t) == {"d": 4, "a": 1} and sorted(calls) == ["a", "d", "e"]
    assert t.missing(set()) == set()
