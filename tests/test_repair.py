"""Old shapes of model answers."""

import json

from pyspark.sql import functions as F

from kenning.operators import repair
from kenning.plans import record_queries


def read(spark, column, payloads):
    rows = spark.createDataFrame([(i, None if p is None else p if isinstance(p, str) else json.dumps(p, ensure_ascii=False)) for i, p in enumerate(payloads)], "i int, p string")
    return [r.x for r in rows.orderBy("i").select(column(F.col("p")).alias("x")).collect()]


def test_metacognitive(spark):
    old = {
        "meta_cognitive_insights": {
            "transferable_decision_rules": ["scan first", " ", "pivot early"],
            "reconnaissance_lessons": {"version_identification_success": " found it ", "deep": [{"a": "x \"y\": z"}, "scan first"]},
            "exploitation_lessons": {"persistent_failure_pattern": "", "defense_evasion_trigger": "waf", "n": 3},
            "methodology_improvements": {"attack_progression_rule": "go on", "environment_assumption_check": "check"},
        },
        "reasoning": "why",
    }
    new = {"decision_mistakes": [{"mistake": "m", "consequence": "c", "rule": "r"}], "key_lessons": ["l"], "optimal_decision_path": "one step", "failure_pattern": "f"}
    a, b, c, d = read(spark, repair.metacognitive, [old, new, {"meta_cognitive_insights": {"exploitation_lessons": "bare"}, "key_lessons": []}, None])
    assert [(m.mistake, m.rule) for m in a.decision_mistakes] == [(repair.NO_RULE, "scan first"), (repair.NO_RULE, "pivot early")]
    assert a.key_lessons == ["found it", 'x "y": z', "scan first", "waf", "go on", "check", "pivot early"] and a.optimal_decision_path == ["go on", "check"]
    assert (a.failure_pattern, a.success_factor, a.rag_effectiveness) == ("waf", "found it", "why")
    assert b.decision_mistakes[0].mistake == "m" and (b.key_lessons, b.optimal_decision_path, b.failure_pattern, b.success_factor) == (["l"], ["one step"], "f", "")
    assert c.key_lessons == ["bare"] and c.optimal_decision_path == ["bare"]
    assert (d.decision_mistakes, d.key_lessons, d.failure_pattern) == ([], [], "")


def test_conceptual(spark):
    old = {"conceptual_patterns": [{"pattern_name": "chain", "description": "a bypass of filters by encoding", "evidence": "seen CVE-2021-44228"}, {"pattern_name": "chain", "description": "d2", "reasoning": "because"}, {"description": "d3"}]}
    short = {"conceptual_patterns": [{"pattern_name": "n1", "description": "", "reasoning": "r1"}], "reasoning": "top", "applicable_conditions": {"positive": []}}
    new = {"core_insight": "c", "pattern_type": "p", "applicable_conditions": {"positive": ["x"], "negative": ["y"]}, "supporting_evidence": ["e"], "confidence_basis": "b", "conceptual_patterns": [{"description": "ignored"}]}
    a, b, c, d = read(spark, repair.conceptual, [old, short, new, "no json"])
    assert a.core_insight == "a bypass of filters by encoding；d2" and a.pattern_type == "defense_bypass" and a.supporting_evidence == ["seen CVE-2021-44228"] and a.confidence_basis == "because"
    assert a.applicable_conditions.positive == ["chain", "a bypass of filters by encoding", "d2", "d3"] and a.applicable_conditions.retrieval_triggers == ["chain", "CVE-2021-44228"]
    assert b.core_insight == "n1；r1" and b.applicable_conditions.positive == ["n1"] and b.confidence_basis == "top"
    assert (c.core_insight, c.pattern_type, c.applicable_conditions.positive, c.applicable_conditions.negative, c.supporting_evidence, c.confidence_basis) == ("c", "p", ["x"], ["y"], ["e"], "b")
    assert (d.core_insight, d.pattern_type, d.applicable_conditions, d.supporting_evidence) == ("", "", None, [])


def test_answers_whose_description_is_a_name(spark, tmp_path):
    """As in the SQL, the language stands beside a text that says the same."""
    spark.createDataFrame([(1, "ñ es", "es", "src0"), (2, "", None, "src1")], "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.core_insight, r.positive, r.confidence_basis) for r in record_queries.repaired_answers(spark, str(tmp_path)).collect()}
    assert got == {1: ("es；src0；es", "es|src0|es", "r 1"), 2: ("x；src1", "x|src1", "r 2")}
