import hashlib
import random
import re
import zlib

import pytest

from wattloom.llm import conversations, queries

ROLES = {"s": "system", "u": "user", "a": "assistant"}


def _damaged(rows):
    text = lambda x: " " if x is None else str(x)
    for c, t, role, said in rows:
        role, said = text(role), text(said)
        kind = zlib.crc32(f"{text(c)}:{text(t)}".encode()) % 20
        if kind == 0:
            continue
        said = "" if kind == 1 else re.sub(r"[.!?]", "", said) if kind == 2 else said
        for _ in range(2 if kind == 3 else 1):
            yield c, t, "user" if kind == 4 else role, said


def _cheapest(rows):
    """The least (cost, audit) and its output, by trying every edit at every row; rows: role, text, fault."""
    best = {}  # output's last two roles' initials and whether it has any -> (cost, audit, output)

    def goes(out, role):
        last = out[-1][0][:1] if out else ""
        return (last, role[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}

    def state(out):
        return out[-1][0][:1] if out else ""

    def put(table, cost, audit, out):
        k = state(out)
        if k not in table or (cost, audit) < table[k][:2]:
            table[k] = (cost, audit, out)
            for role in ("user", "assistant"):
                if goes(out, role):
                    put(table, cost + 2, audit + "I", [*out, (role, "")])

    put(best, 0, "", [])
    for role, text, fault in rows:
        new = {}
        for cost, audit, out in best.values():
            put(new, cost + 3, audit + "D", out)
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                if goes(out, role):
                    put(new, cost + more, audit + "K", [*out, (role, text)])
                for other in ("user", "assistant"):
                    if goes(out, other):
                        put(new, cost + 2 + more, audit + "R", [*out, (other, text)])
        best = new
    return min(best[k] for k in ("", "a") if k in best)


def _truth(rows):
    by: dict = {}
    for c, t, role, said in rows:
        by.setdefault(c, []).append((t, role, said))
    for c, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, told = set(), []
        for _, role, said in own:
            shown = re.findall(r"[^\x20\x09-\x0D]", said)
            told.append((role, said, "blank" if not shown else "duplicate" if (role, said) in seen else "truncated" if shown[-1] not in ".!?" else ""))
            seen.add((role, said))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [f for _, _, f in told]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:], strict=False))
        cost, audit, out = _cheapest(told)
        digest = hashlib.sha256("\n".join(f"{r}:{s}" for r, s in out).encode()).hexdigest()
        yield c, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest


def _conversations():
    random.seed(4)
    said = ["Yes.", "No", "Why?", " \n", "", "Fine!\t", "é ", None, "x" * 50_000]
    rows = []
    for c in range(120):
        turns = random.sample(range(30), k=random.randrange(1, 12))
        rows += [(c, t, random.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"]), random.choice(said[:8])) for t in turns]
    rows += [(500, t, "user" if t % 3 else "assistant", f"line {t % 40}.") for t in range(300)]
    rows += [(501, None, "user", f"t{k}.") for k in range(5)] + [(501, 3, "user", "b."), (501, 3, "user", "a."), (501, 3, "assistant", "a.")] * 2
    rows += [(None, 1, "user", "q."), (None, None, "assistant", "r."), (502, -4, "system", said[8]), (502, 9, "user", "x.")]
    return rows


@pytest.mark.parametrize("span", [1, 3, 512])
def test_repair_against_trying_every_edit(spark, span, monkeypatch):
    monkeypatch.setattr(conversations, "WAYS", 4 if span == 1 else 64)
    rows = _conversations()
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, `se.g` int, part int").repartition(3)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    found = conversations.repair(frame, span=span)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in conversations.digests(found.rows).collect()}
    got = [(*r, digests.get(r["conv_id"], hashlib.sha256().hexdigest())) for r in found.report.collect()]
    assert sorted(got, key=str) == sorted(_truth(plain), key=str)


def test_query_reports_every_conversation(spark, tmp_path):
    rows = _conversations() + [(c, 0, "user", "gone.") for c in range(1000, 1060)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op11_conversation_repair(spark, str(tmp_path)).collect()
    want = {w[0]: w for w in _truth(list(_damaged(rows)))}
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert any(c not in want for c, *_ in rows)
    assert sorted(map(tuple, got), key=str) == sorted((want.get(c, (c, *none)) for c in {r[0] for r in rows}), key=str)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found = conversations.repair(frame, every=frame)
    assert not found.report.count() and not found.rows.count() and not conversations.digests(found.rows).count()


def test_string_conversations(spark):
    frame = spark.createDataFrame([("a", 1, "user", "x."), ("a", 2, "user", "y.")], "conv_id string, turn long, role string, text string")
    found = conversations.repair(frame)
    assert [tuple(r) for r in found.report.select("conv_id", "cost", "audit").collect()] == [("a", 2, "KR")]
    assert [(r["role"], r["text"]) for r in found.rows.orderBy("place").collect()] == [("user", "x."), ("assistant", "y.")]
