"""Experience rows as what a retrieval store takes: a text per row, and a slim record per layer.

Rows have exp_id, layer, content (JSON text), service, version, cves, maturity, confidence, outcome and n_sessions. A
content that isn't JSON reads as empty; fields of another type than theirs read as missing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LISTS = ["cve_ids", "preconditions", "success_indicators", "key_lessons", "optimal_decision_path", "missed_opportunities", "supporting_evidence", "minimal_success_path", "replicability_conditions"]
_TEXTS = [
    "target_service", "target_version", "exploitation_status", "failure_dimension", "failure_sub_dimension", "evidence", "command_template", "original_command", "tool_name", "attack_phase",
    "context_condition", "expected_signal", "session_goal", "session_outcome", "failure_pattern", "success_factor", "critical_decision_point", "core_insight", "pattern_type",
]
_NESTED = [
    "discovered_facts array<struct<key:string,value:string,service:string,version:string>>",
    "cve_context struct<attempted:array<string>,exploitation_results:map<string,string>,unexplored:array<string>>",
    "applicable_constraints struct<known_ineffective_vectors:array<string>>",
    "decision_rule struct<`IF`:string,`THEN`:array<string>,`NOT`:array<string>,conclusion:string>",
    "key_lessons_structured array<struct<lesson:string,rule:string>>",
    "decision_mistakes array<struct<mistake:string,consequence:string,rule:string>>",
    "applicable_conditions struct<positive:array<string>,negative:array<string>,retrieval_triggers:array<string>>",
]
CONTENT = ", ".join([f"{n} string" for n in _TEXTS] + [f"{n} array<string>" for n in _LISTS] + _NESTED)

# Facts that don't outlive a session.
PASSING = ["http_status", "output_summary", "open_port_evidence"]


def parsed(rows: DataFrame) -> DataFrame:
    """rows with the content as a struct `c`: a generator's output, so no filter is pushed below it and each text is parsed once."""
    return rows.withColumn("c", F.explode(F.array(F.from_json("content", CONTENT))))


def text_of(value: Column) -> Column:
    """Trimmed; null if nothing, none or null."""
    t = F.trim(value)
    return F.when(~F.lower(t).isin("", "none", "null"), t)


def items_of(values: Column) -> Column:
    """Trimmed items that hold something; null if there are none."""
    kept = F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v != "")
    return F.when(F.size(kept) > 0, kept)


def _said(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"{label}: "), value)


def _listed(label: str, values: Column, most: int) -> Column:
    return _said(label, F.array_join(F.slice(items_of(values), 1, most), "; "))


def _joined(values: Column) -> Column:
    return F.coalesce(F.array_join(items_of(values), "; "), F.lit(""))


def _facts() -> Column:
    """Lines of facts that last: ports only with a service or a version."""
    keyed = F.filter("c.discovered_facts", lambda f: text_of(f["key"]).isNotNull() & ~F.trim(f["key"]).isin(PASSING))
    lasting = F.filter(keyed, lambda f: F.when(F.trim(f["key"]) == "open_port", F.coalesce(text_of(f["service"]), text_of(f["version"])).isNotNull()).otherwise(text_of(f["value"]).isNotNull()))
    parts = lambda f: F.concat_ws(" | ", text_of(f["value"]), F.concat(F.lit("service="), text_of(f["service"])), F.concat(F.lit("version="), text_of(f["version"])))
    shown = F.transform(lasting, lambda f: F.concat(F.trim(f["key"]), F.lit(": "), F.when(F.trim(f["key"]) == "open_port", parts(f)).otherwise(text_of(f["value"]))))
    return F.when(F.size(shown) > 0, F.array_join(shown, "\n"))


def _statuses() -> Column:
    """CVE: status for every attempted CVE, `attempted` where no status is known."""
    known = lambda v: F.coalesce(text_of(F.try_element_at("c.cve_context.exploitation_results", v)), text_of(F.try_element_at("c.cve_context.exploitation_results", F.upper(v))), F.lit("attempted"))
    return F.array_join(F.transform(items_of(F.col("c.cve_context.attempted")), lambda v: F.concat(F.upper(v), F.lit(": "), known(v))), "\n")


def _factual() -> Column:
    named = [_said(n, text_of(F.col(f"c.{n}"))) for n in ("target_service", "target_version", "exploitation_status")]
    return F.coalesce(_facts(), F.nullif(F.concat_ws("\n", *named, _statuses()), F.lit("")), F.lit("(no stable facts)"))


def _positive() -> Column:
    context = F.coalesce(text_of(F.col("c.context_condition")), F.array_join(items_of(F.col("c.preconditions")), "; "), text_of(F.col("c.attack_phase")), F.lit(""))
    expected = F.coalesce(text_of(F.col("c.expected_signal")), _joined(F.col("c.success_indicators")))
    return F.concat_ws("\n", _said("Context", context), _said("Command", F.coalesce(text_of(F.col("c.command_template")), F.lit(""))), _said("Expected", expected))


def _negative() -> Column:
    rule = F.col("c.decision_rule")
    return F.concat_ws("\n", F.concat(F.lit("IF "), F.coalesce(F.trim(rule["IF"]), F.lit(""))), F.concat(F.lit("THEN "), _joined(rule["THEN"])), F.concat(F.lit("NOT "), _joined(rule["NOT"])))


def _lessons() -> Column:
    written = F.coalesce(items_of(F.col("c.key_lessons")), F.array().cast("array<string>"))
    shaped = F.coalesce(F.transform("c.key_lessons_structured", lambda x: F.coalesce(text_of(x["lesson"]), text_of(x["rule"]))), F.array().cast("array<string>"))
    faults = F.transform(F.filter(F.slice("c.decision_mistakes", 1, 3), lambda m: text_of(m["mistake"]).isNotNull() & text_of(m["rule"]).isNotNull()), lambda m: F.concat(F.trim(m["mistake"]), F.lit(" => "), F.trim(m["rule"])))
    lines = [
        _said("Session goal", text_of(F.col("c.session_goal"))), _said("Outcome", text_of(F.col("c.session_outcome"))), _listed("Key lessons", F.array_distinct(F.array_compact(F.concat(written, shaped))), 5),
        _listed("Decision mistakes", faults, 3), _listed("Optimal path", F.col("c.optimal_decision_path"), 6), _listed("Missed opportunities", F.col("c.missed_opportunities"), 4),
        _said("Failure pattern", text_of(F.col("c.failure_pattern"))), _said("Success factor", text_of(F.col("c.success_factor"))),
    ]
    return F.coalesce(F.nullif(F.concat_ws("\n", *lines), F.lit("")), F.lit("(no metacognitive content)"))


def _concepts() -> Column:
    when = F.col("c.applicable_conditions")
    lines = [
        _said("Insight", text_of(F.col("c.core_insight"))), _said("Pattern", text_of(F.col("c.pattern_type"))), _listed("Applies when", when["positive"], 5), _listed("Not for", when["negative"], 3),
        _listed("Retrieval triggers", when["retrieval_triggers"], 8), _listed("Evidence", F.col("c.supporting_evidence"), 3),
    ]
    return F.coalesce(F.nullif(F.concat_ws("\n", *lines), F.lit("")), F.lit("(no conceptual content)"))


BODIES = {"FACTUAL": _factual, "PROCEDURAL_POS": _positive, "PROCEDURAL_NEG": _negative, "METACOGNITIVE": _lessons, "CONCEPTUAL": _concepts}


def _by_layer(ways: dict[str, Column], otherwise: Column) -> Column:
    return reduce(lambda rest, way: F.when(F.col("layer") == way[0], way[1]).otherwise(rest), reversed(ways.items()), otherwise)


def named_cves() -> Column:
    """CVEs of the row, else of its content, else those it tried; upper case."""
    found = F.coalesce(items_of(F.col("cves")), items_of(F.col("c.cve_ids")), items_of(F.col("c.cve_context.attempted")), F.array().cast("array<string>"))
    return F.transform(found, lambda v: F.upper(v))


def chunks(rows: DataFrame) -> DataFrame:
    """exp_id, layer, chunk: a header with maturity, sessions and probability, the layer's body, hints for queries."""
    service = F.coalesce(text_of(F.col("service")), text_of(F.col("c.target_service")), F.lit("unknown"))
    stars = F.when(F.col("maturity") == "consolidated", "★★★ consolidated").when(F.col("maturity") == "validated", "★★☆ validated").otherwise("★☆☆ raw")
    p, cves = F.coalesce("confidence", F.lit(0.0)), named_cves()
    head = [
        F.format_string("[%s | %d sessions | p=%.2f]", stars, F.coalesce("n_sessions", F.lit(1)), p), F.concat_ws(" | ", "layer", F.col("exp_id").cast("string")), _said("knowledge_layer", F.col("layer")),
        _said("target_service", service), F.format_string("confidence: %.4f", p), F.when(F.size(cves) > 0, _said("cve_ids", F.array_join(cves, ", "))),
    ]
    hints = F.concat(F.array(F.col("layer")), F.filter(F.array(service), lambda s: s != "unknown"), F.slice(cves, 1, 8))
    body = _by_layer({layer: way() for layer, way in BODIES.items()}, F.coalesce("content", F.lit("")))
    tail = F.concat(F.lit("QUERY_HINTS:\n"), F.array_join(F.transform(hints, lambda h: F.concat(F.lit("- "), h)), "\n"))
    return parsed(rows).select("exp_id", "layer", F.concat_ws("\n\n", F.concat_ws("\n", *head), body, tail).alias("chunk"))


# What goes into a record, by layer: output field -> content field.
KEPT = {
    "PROCEDURAL_POS": ["tool_name", "attack_phase", "preconditions", "success_indicators"],
    "PROCEDURAL_NEG": ["failure_dimension", "failure_sub_dimension", "decision_rule", "evidence"],
    "METACOGNITIVE": ["session_goal", "key_lessons", "optimal_decision_path", "missed_opportunities", "failure_pattern", "minimal_success_path", "replicability_conditions", "critical_decision_point"],
    "CONCEPTUAL": ["pattern_type", "core_insight", "supporting_evidence"],
}


def _record(fields: dict[str, Column]) -> Column:
    """JSON of the fields that hold something; null if none does."""
    made = F.to_json(F.struct(*[v.alias(n) for n, v in fields.items()]))
    return F.when(F.coalesce(*[v.cast("string") for v in fields.values()]).isNotNull(), made)


def _field(name: str) -> Column:
    value = F.col(f"c.{name}")
    return items_of(value) if name in _LISTS else value if name == "decision_rule" else text_of(value)


def records(rows: DataFrame) -> DataFrame:
    """exp_id, layer, content, filters: slim JSON for upload; rows without content for their layer go."""
    service, version, cves = F.coalesce(text_of(F.col("service")), text_of(F.col("c.target_service"))), F.coalesce(text_of(F.col("c.target_version")), text_of(F.col("version"))), items_of(named_cves())
    model = F.col("c.cve_context").isNotNull()
    status = F.when(model, F.coalesce(text_of(F.col("c.exploitation_status")), F.lit("unknown")))
    when = F.col("c.applicable_conditions")
    tried, facts = F.col("c.cve_context"), F.col("c.discovered_facts")
    results = F.when(F.size(tried["exploitation_results"]) > 0, tried["exploitation_results"])
    own = {layer: {n: _field(n) for n in names} for layer, names in KEPT.items()}
    contents = {
        "FACTUAL": {
            "target_service": service, "target_version": version, "exploitation_status": status, "cve_ids": F.when(~model, cves), "discovered_facts": F.when(~model & (F.size(facts) > 0), facts), "cve_attempted": items_of(tried["attempted"]),
            "cve_results": results, "cve_unexplored": items_of(tried["unexplored"]), "known_ineffective_vectors": F.when(model, items_of(F.col("c.applicable_constraints.known_ineffective_vectors"))),
        },
        "PROCEDURAL_POS": {"command_template": F.coalesce(_field("command_template"), _field("original_command"))} | own["PROCEDURAL_POS"] | {"cve_ids": cves, "target_service": service},
        "PROCEDURAL_NEG": own["PROCEDURAL_NEG"] | {"target_service": service},
        "METACOGNITIVE": own["METACOGNITIVE"],
        "CONCEPTUAL": own["CONCEPTUAL"] | {"positive_conditions": items_of(when["positive"]), "negative_conditions": items_of(when["negative"]), "retrieval_triggers": items_of(when["retrieval_triggers"])},
    }
    common = {"confidence": F.coalesce("confidence", F.lit(0.0)), "maturity": F.coalesce("maturity", F.lit("raw"))}
    outcome = {"session_outcome": F.coalesce("outcome", F.lit("unknown"))}
    filters = {
        "FACTUAL": {"factual_source": F.when(model, "llm").otherwise("rule"), "exploitation_status": status, "session_outcome": F.when(~model, outcome["session_outcome"]), "target_service": service},
        "PROCEDURAL_POS": outcome | {"attack_phase": _field("attack_phase"), "target_service": service, "cve_ids": F.slice(cves, 1, 5)},
        "PROCEDURAL_NEG": {"failure_dimension": _field("failure_dimension"), "failure_sub_dimension": _field("failure_sub_dimension"), "target_service": service},
        "METACOGNITIVE": outcome | {"target_service": service},
        "CONCEPTUAL": {"pattern_type": _field("pattern_type"), "retrieval_triggers": items_of(when["retrieval_triggers"])},
    }
    nothing = F.lit(None).cast("string")
    made = parsed(rows).select(
        "exp_id",
        "layer",
        _by_layer({layer: _record(f) for layer, f in contents.items()}, nothing).alias("content"),
        _by_layer({layer: _record(common | f) for layer, f in filters.items()}, nothing).alias("filters"),
    )
    return made.filter("content IS NOT NULL")
