import random
import re

import pytest

from wattloom.operators import rule_index, rules


@pytest.mark.parametrize(("pattern", "literal"), [
    ("meter .* failed: [0-9]+", " failed: "), ("abc?def", "def"), ("ab+cd", "ab"), ("a|b", ""), ("(x|y)long text", "long text"), (r"\{\"k\": 9", '{"k": 9'), (r"\d+abcd", "abcd"), ("ab{2,3}xyz", "xyz"), ("(?i)abcd", ""), (r"\x41bcd", ""), ("[]abc]wxyz", "wxyz"),
    ("a[b(]c(d[)]e)fgh", "fgh"), ("", ""), ("*a", ""), ("^start$", "start"), ("abc*?def", "def"), (r"\Qabc\E", ""), ("a.b.cd", "cd"), ("ab{", ""), ("x{1}abcd", "abcd"),
])
def test_required_literals(pattern, literal):
    assert rule_index.required_literal(pattern) == literal


def test_no_match_lacks_its_literal():
    random.seed(2)
    parts = ["a", "b", "c", "ab", "[ab]", "(a|b)", "(bc)", ".", "\\.", "a?", "b*", "c+", "a{0,2}", "\\d", "^", "$", "b+?"]
    texts = ["".join(random.choices("abc.1", k=random.randrange(12))) for _ in range(400)]
    for _ in range(400):
        pattern = "".join(random.choices(parts, k=random.randrange(1, 6)))
        literal = rule_index.required_literal(pattern)
        assert all(literal in m.group() for t in texts for m in re.finditer(pattern, t))


@pytest.mark.parametrize("most", [200_000, 0])
def test_indexed_rules_match_like_all_rules(spark, monkeypatch, most):
    monkeypatch.setattr(rule_index, "BROADCAST_INDEX", most)
    random.seed(11)
    word = lambda: "".join(random.choices("abcde", k=5))
    words = [word() for _ in range(60)]
    table = [(str(k), random.choice("xyz"), p, random.choice(["", "N"])) for k, p in enumerate([*words, "a.*b", "c+d", *(f"{a}.*{b}" for a, b in zip(words, words[7:], strict=False)), *(f"({a}|{b})" for a, b in zip(words, words[3:], strict=False))])]
    rows = [(k if k % 30 else None, random.choice("xyzq"), " ".join(random.choices(words, k=random.randrange(6)))) for k in range(300)] + [(1000, "x", None), (1001, None, words[0])]
    events = spark.createDataFrame(rows, "id int, event_type string, reason string")
    frame = spark.createDataFrame([(i, t, "1", s, r, 1, "p", 1, "A", "", "t") for i, t, s, r in table], rules.RULES)
    got, want = (sorted((str(tuple(r)) for r in m.matched(events, frame, key=["id"]).collect())) for m in (rule_index, rules))
    assert got == want and len(got) > 200
    found = rule_index.matched(events, frame, key=["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "__gram" in plan and "gram#" in plan


def test_fifty_thousand_rules(spark):
    table = spark.range(50_000).selectExpr("CAST(id AS STRING) AS regex_id", "'x' AS event_type", "concat('code ', lpad(id, 5, '0'), ' .*end') AS search", "'N' AS replacement")
    events = spark.range(2_000).selectExpr("id", "'x' AS event_type", "concat('code ', lpad(id * 25, 5, '0'), ' to the end') AS reason")
    found = rules.first_match(rule_index.matched(events, table, key=["id"])).collect()
    assert len(found) == 2_000 and all(r["regex_id"] == str(r["id"] * 25) and r["curated_reason"] == "N" for r in found)
