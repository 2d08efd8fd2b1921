"""What a model's answer must hold before it becomes an experience, and checks of a whole batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kenning.operators.project import items_of, text_of

# Wording of the prompt's own examples, which isn't an answer.
TEMPLATE_WORDS = r"（如[：:]|例如|触发词\d+|关键词\d+|软件名[/／]CVE|条件\d+|证据\d+|触发检索|攻击规律|来自本次会话|【描述】|\d+（[^）]{5,}）"


def answer(text: Column) -> Column:
    """A model's answer without code fences, cut to the outermost braces."""
    plain = F.regexp_replace(text, r"(?m)^\s*```.*$", "")
    first, last = F.locate("{", plain), F.length(plain) - F.locate("}", F.reverse(plain)) + 1
    return F.when((first > 0) & plain.contains("}") & (last > first), F.substr(plain, first, last - first + 1)).otherwise(F.trim(plain))


def rule_fingerprint(rule: Column) -> Column:
    """Twelve hex digits that are the same for rules that differ in case, space and punctuation."""
    return F.substr(F.md5(F.substr(F.regexp_replace(F.lower(rule), r"[^\p{L}\p{N}_]", ""), F.lit(1), F.lit(80)).cast("binary")), F.lit(1), F.lit(12))


def mistakes(items: Column, most: int = 6) -> Column:
    """Of the first items (mistake, consequence, rule), those with a mistake and a rule, cut, with the rule's fingerprint."""
    cut = lambda v: F.substr(F.coalesce(v, F.lit("")), F.lit(1), F.lit(200))
    whole = F.filter(F.slice(items, 1, most), lambda m: (F.coalesce(m["mistake"], F.lit("")) != "") & (F.coalesce(m["rule"], F.lit("")) != ""))
    return F.transform(whole, lambda m: F.struct(cut(m["mistake"]).alias("mistake"), cut(m["consequence"]).alias("consequence"), cut(m["rule"]).alias("rule"), rule_fingerprint(cut(m["rule"])).alias("rule_fingerprint")))


def conditions(shaped: Column, plain: Column) -> Column:
    """Conditions from an answer that gave a struct of lists, or (older) one plain list, which is all positive."""
    none = F.array().cast("array<string>")
    most = lambda v, n: F.slice(F.coalesce(items_of(v), none), 1, n)
    triggers = F.filter(F.coalesce(items_of(shaped["retrieval_triggers"]), none), lambda t: ~t.rlike(TEMPLATE_WORDS))
    positive = F.when(shaped.isNotNull(), most(shaped["positive"], 5)).otherwise(most(plain, 5))
    return F.struct(positive.alias("positive"), most(shaped["negative"], 3).alias("negative"), most(shaped["priority_over"], 3).alias("priority_over"), F.slice(triggers, 1, 8).alias("retrieval_triggers"))


def factual_gate(service: Column, version: Column, attempted: Column) -> Column:
    """A service, and a CVE that was tried or a known version."""
    known = F.lower(F.coalesce(text_of(version), F.lit("unknown"))) != "unknown"
    return (F.coalesce(F.trim(service), F.lit("")) != "") & (items_of(attempted).isNotNull() | known)


def merged_status(attempted: Column, model: Column, inferred: Column) -> Column:
    """Map of every attempted CVE to the model's status, else the inferred one, else unknown."""
    names = F.array_distinct(F.transform(F.coalesce(items_of(attempted), F.array().cast("array<string>")), lambda v: F.upper(v)))
    status = lambda v: F.coalesce(F.lower(text_of(F.try_element_at(model, v))), F.try_element_at(inferred, v), F.lit("unknown"))
    return F.map_from_arrays(names, F.transform(names, status))


def annotation_gate(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """One row: n_sessions, n_calls, n_answered (model_called, model_answered of sessions), n_causes, n_fallback
    (cause_source of events), passed, reason. A batch fails without sessions, without any answer, or if every cause is a fallback."""
    n = lambda c, name: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(name)
    no, called = F.lit(False), F.col("model_called")
    s = sessions.select(F.lit(True).alias("session"), called.alias("call"), (called & F.col("model_answered")).alias("answer"), no.alias("cause"), no.alias("fallback"))
    e = events.select(no.alias("session"), no.alias("call"), no.alias("answer"), F.col("cause_source").isNotNull().alias("cause"), (F.col("cause_source") == "fallback").alias("fallback"))
    row = s.unionByName(e).agg(n(F.col("session"), "n_sessions"), n(F.col("call"), "n_calls"), n(F.col("answer"), "n_answered"), n(F.col("cause"), "n_causes"), n(F.col("fallback"), "n_fallback"))
    return _verdict(row, [("no_session", "n_sessions = 0"), ("all_calls_failed", "n_calls > 0 AND n_answered = 0"), ("only_fallback_causes", "n_causes > 0 AND n_causes = n_fallback")])


def extraction_gate(experiences: DataFrame) -> DataFrame:
    """One row: n_rows, n_model, n_negative, n_fallback, passed, reason, from extraction_source and rule_source. A batch
    fails without rows, without rows by a model, or if every negative's rule is a fallback."""
    negative = F.col("layer") == "PROCEDURAL_NEG"
    n = lambda c, name: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(name)
    row = experiences.agg(F.count(F.lit(1)).alias("n_rows"), n(F.col("extraction_source") == "llm", "n_model"), n(negative, "n_negative"), n(negative & (F.col("rule_source") == "fallback"), "n_fallback"))
    return _verdict(row, [("no_rows", "n_rows = 0"), ("no_model_rows", "n_model = 0"), ("only_fallback_rules", "n_negative > 0 AND n_negative = n_fallback")])


def _verdict(row: DataFrame, faults: list[tuple[str, str]]) -> DataFrame:
    reason = F.coalesce(*[F.when(F.expr(test), name) for name, test in faults])
    return row.withColumn("reason", reason).withColumn("passed", F.col("reason").isNull())
