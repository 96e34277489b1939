import random

import pytest

from wattloom.operators import rules
from wattloom.plans import replay

KEY = ["id"]


def _rows(table):
    return [(i, t, "1", s, r, 1, "p", 1, "A", "", "x") for i, t, s, r in table]


def _sorted(df):
    return sorted((tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect()))


@pytest.mark.parametrize("seed", range(4))
def test_replay_equals_judging_all_events_anew(spark, seed):
    random.seed(seed)
    rule = lambda: (str(random.randrange(30)), random.choice("abc"), random.choice(["x", "y+", "z$", "^x", "[yz]w", "(", "never"]), random.choice(["", "N", None]))
    old = {rule() for _ in range(8)}
    new = {r for r in old if random.random() < 0.7} | {rule() for _ in range(4)}
    events = [(k if k % 40 else None, random.choice("abcd"), "".join(random.choices("xyzw ", k=4))) for k in range(150)]
    frame = spark.createDataFrame(events, "id int, event_type string, reason string")
    tables = [spark.createDataFrame(_rows(t), rules.RULES) for t in (old, new)]
    stored = replay.judge(frame, tables[0], key=KEY)
    got = replay.replay(stored.classified, stored.quarantine, *tables, key=KEY)
    want = replay.judge(frame, tables[1], key=KEY)
    assert _sorted(got.classified) == _sorted(want.classified) and _sorted(got.quarantine) == _sorted(want.quarantine)


def test_without_a_change_no_event_is_judged(spark, monkeypatch):
    frame = spark.createDataFrame([(1, "a", "x"), (2, "a", "q"), (3, "d", "x")], "id int, event_type string, reason string")
    table = spark.createDataFrame(_rows([("1", "a", "x", "N")]), rules.RULES)
    stored = replay.judge(frame, table, key=KEY)
    judged = []
    plain = rules.matched
    monkeypatch.setattr(rules, "matched", lambda events, *a, **kw: judged.append(events.count()) or plain(events, *a, **kw))
    got = replay.replay(stored.classified, stored.quarantine, table, table, key=KEY)
    assert _sorted(got.classified) == _sorted(stored.classified) and _sorted(got.quarantine) == _sorted(stored.quarantine)
    assert set(judged) == {0}
