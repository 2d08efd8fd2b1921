"""Model answers of older shapes in the shape that the rest takes, as column expressions over their JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kenning.functions import text as tx
from kenning.operators.distil import pattern_type

#: A key with its colon, or a string value (the group).
_STRING = r'"(?:[^"\\]|\\.)*+"\s*:|"((?:[^"\\]|\\.)*+)"'
# What is said where an old answer says nothing, and which of its parts give which field.
NO_RULE, NO_RULE_COST = "决策路径未显式固化为可执行规则", "导致重复试错与策略切换滞后"
NO_CONDITION, JOIN = "存在可复用的多阶段攻击路径", "；"
LESSON_PARTS = ["reconnaissance_lessons", "exploitation_lessons", "methodology_improvements"]
PATH_PARTS = ["attack_progression_rule", "failure_response_handling", "environment_assumption_check"]

MISTAKES = "array<struct<mistake:string,consequence:string,rule:string>>"
CONDITIONS = "struct<positive:array<string>,negative:array<string>,priority_over:array<string>,retrieval_triggers:array<string>>"
_NONE = "array<string>"


def _none() -> Column:
    return F.array().cast(_NONE)


def _said(value: Column) -> Column:
    """The trimmed text, null if nothing is left."""
    return F.nullif(tx.strip(value), F.lit(""))


def snippets(value: Column, most: int) -> Column:
    """All strings in a JSON value at any depth, in order, trimmed, cut and distinct; a bare text is one."""
    bare = F.trim(F.coalesce(value, F.lit("")))
    inside = F.filter(F.regexp_extract_all(bare, F.lit(_STRING), F.lit(1)), lambda x: x != "")
    read = F.coalesce(F.from_json(F.concat(F.lit('["'), F.array_join(inside, '","'), F.lit('"]')), _NONE), _none())
    every = F.when(bare == "", _none()).when(bare.rlike(r"^[\[{]"), read).otherwise(F.array(bare))
    return F.array_distinct(F.filter(F.transform(every, lambda x: F.substring(tx.strip(x), 1, most)), lambda x: x != ""))


def _list(payload: Column, path: str, most: int) -> Column:
    """A field as a list of texts: a list's items, or the one text."""
    got = F.get_json_object(payload, path)
    items = F.when(F.trim(got).startswith("["), F.from_json(got, _NONE)).when(got.isNotNull(), F.array(got)).otherwise(_none())
    return F.filter(F.transform(F.coalesce(items, _none()), lambda x: F.substring(tx.strip(F.coalesce(x, F.lit(""))), 1, most)), lambda x: x != "")


def _or(first: Column, second: Column) -> Column:
    return F.when(F.size(first) > 0, first).otherwise(second)


def metacognitive(payload: Column) -> Column:
    """struct(decision_mistakes, key_lessons, optimal_decision_path, failure_pattern, success_factor, rag_effectiveness).

    An answer with `meta_cognitive_insights` gives what it lacks from there: rules to carry over are mistakes without a
    rule, the texts of its parts lessons (8 at most), its steps of method the path, else the first lessons.
    """
    at = "$.meta_cognitive_insights"
    old = F.get_json_object(payload, at).startswith("{")
    rules = F.when(old, _list(payload, f"{at}.transferable_decision_rules", 240)).otherwise(_none())
    own = F.coalesce(F.from_json(F.get_json_object(payload, "$.decision_mistakes"), MISTAKES), F.array().cast(MISTAKES))
    made = F.transform(rules, lambda r: F.struct(F.lit(NO_RULE).alias("mistake"), F.lit(NO_RULE_COST).alias("consequence"), r.alias("rule")))
    parts = F.concat(*[snippets(F.get_json_object(payload, f"{at}.{k}"), 220) for k in LESSON_PARTS], rules)
    lessons = _or(_list(payload, "$.key_lessons", 1000), F.when(old, F.slice(F.array_distinct(parts), 1, 8)).otherwise(_none()))
    steps = F.array_compact(F.array(*[F.substring(_said(F.get_json_object(payload, f"{at}.methodology_improvements.{k}")), 1, 240) for k in PATH_PARTS]))
    path = F.when(old, F.slice(_or(steps, F.slice(F.transform(lessons, lambda x: F.substring(x, 1, 240)), 1, 4)), 1, 10)).otherwise(_none())
    one = lambda field, most, *ways: F.coalesce(_said(F.get_json_object(payload, f"$.{field}")), F.when(old, F.coalesce(*[F.substring(_said(F.get_json_object(payload, w)), 1, most) for w in ways])), F.lit(""))
    return F.struct(
        _or(own, made).alias("decision_mistakes"), lessons.alias("key_lessons"), _or(_list(payload, "$.optimal_decision_path", 240), path).alias("optimal_decision_path"),
        one("failure_pattern", 200, f"{at}.exploitation_lessons.persistent_failure_pattern", f"{at}.exploitation_lessons.defense_evasion_trigger").alias("failure_pattern"),
        one("success_factor", 200, f"{at}.reconnaissance_lessons.version_identification_success", f"{at}.exploitation_lessons.partial_success_analysis").alias("success_factor"),
        one("rag_effectiveness", 300, "$.reasoning").alias("rag_effectiveness"),
    )


def conceptual(payload: Column) -> Column:
    """struct(core_insight, pattern_type, applicable_conditions, supporting_evidence, confidence_basis).

    An answer with `conceptual_patterns` gives what it lacks from there: two descriptions (or names) are the insight,
    names and descriptions the conditions, names and CVEs what to look it up by.
    """
    listed = F.from_json(F.get_json_object(payload, "$.conceptual_patterns"), "array<struct<pattern_name:string,description:string,evidence:string,reasoning:string>>")
    old = F.coalesce(F.size(listed) > 0, F.lit(False))
    of = lambda field: F.coalesce(F.filter(F.transform(listed, lambda p: tx.strip(F.coalesce(p[field], F.lit("")))), lambda x: x != ""), _none())
    names, told, proofs, whys = of("pattern_name"), of("description"), of("evidence"), of("reasoning")
    reasoning = F.coalesce(tx.strip(F.get_json_object(payload, "$.reasoning")), F.lit(""))
    core = F.array_join(F.slice(_or(told, names), 1, 2), JOIN)
    wide = F.array_join(F.slice(F.array_distinct(F.transform(F.concat(names, told, whys), lambda x: F.substring(x, 1, 180))), 1, 3), JOIN)
    insight = F.coalesce(F.nullif(F.get_json_object(payload, "$.core_insight"), F.lit("")), F.when(old, F.substring(F.when(F.length(core) < 20, wide).otherwise(core), 1, 400)), F.lit(""))
    kind = F.coalesce(F.nullif(F.get_json_object(payload, "$.pattern_type"), F.lit("")), F.when(old, pattern_type(F.array_join(F.concat(names, told), " "))), F.lit(""))
    given = F.from_json(F.get_json_object(payload, "$.applicable_conditions"), CONDITIONS)
    positive = F.slice(F.array_distinct(F.concat(names, F.transform(told, lambda d: F.substring(d, 1, 120)))), 1, 5)
    cves = tx.cves(F.concat_ws(" ", F.array_join(F.concat(names, told, proofs), " "), reasoning))
    triggers = F.slice(F.array_distinct(F.concat(F.slice(names, 1, 5), F.slice(cves, 1, 5))), 1, 8)
    derived = F.struct(_or(positive, F.array(F.lit(NO_CONDITION))).alias("positive"), _none().alias("negative"), _none().alias("priority_over"), triggers.alias("retrieval_triggers"))
    conditions = F.when(F.coalesce(F.size(given["positive"]) > 0, F.lit(False)) | ~old, given).otherwise(derived)
    proof = _or(_list(payload, "$.supporting_evidence", 1000), F.when(old, F.slice(proofs, 1, 5)).otherwise(_none()))
    basis = F.coalesce(_said(F.get_json_object(payload, "$.confidence_basis")), F.when(old, F.substring(F.coalesce(F.nullif(reasoning, F.lit("")), F.get(whys, F.lit(0)), F.lit("")), 1, 200)), F.lit(""))
    return F.struct(insight.alias("core_insight"), kind.alias("pattern_type"), conditions.alias("applicable_conditions"), proof.alias("supporting_evidence"), basis.alias("confidence_basis"))
