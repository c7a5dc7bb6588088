import json

from strataflow.sources import config

POLICY = {"version": "v1", "policy": {"mode": "whitelist_only", "whitelist_precedence": True}, "exact_journals": ["Reports", "Both"], "publisher_families": ["Family A", "Family B"]}


def test_rules_of_three_precedences(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text(json.dumps(POLICY))
    policy = config.load_policy(path)
    assert policy.whitelist_only and policy.whitelist_precedence and policy.families == ("Family A", "Family B")
    rows = [("REPORTS", "x"), ("Both", "Family A"), ("Good", "family a"), ("Other", "Family B"), ("Alone", None), ("Good", "Family B"), (None, "Family B"), (None, None), ("Family A", "y")]
    journals = spark.createDataFrame(rows, "title string, publisher string")
    listed = spark.createDataFrame([("GOOD",), ("both",), ("both",)], "title string")
    rules = config.policy_rules(spark, policy)

    def said(**more):
        return sorted(((r["title"] or "", r["publisher"] or "", r["action"], r["reason"]) for r in config.journal_actions(journals, rules, listed, **more).collect()))

    a, b = "publisher family Family A", "publisher family Family B"
    assert said() == sorted([
        ("REPORTS", "x", "exclude", "title is excluded"), ("Both", "Family A", "include", "whitelisted"), ("Good", "family a", "include", "whitelisted"), ("Other", "Family B", "exclude", b), ("Alone", "", "exclude", "not whitelisted"),
        ("Good", "Family B", "include", "whitelisted"), ("", "Family B", "exclude", b), ("", "", "exclude", "not whitelisted"), ("Family A", "y", "exclude", "not whitelisted"),
    ])
    late = said(whitelist_precedence=False, whitelist_only=False)
    assert ("Both", "Family A", "exclude", "title is excluded") in late and ("Good", "family a", "exclude", a) in late and ("Alone", "", "include", "no rule") in late
    assert config.journal_actions(journals.limit(0), rules, listed).count() == 0
