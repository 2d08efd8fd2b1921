"""Personal data by patterns and bootstrapped contextual extraction, in DataFrame functions only.

Base kinds (email, ip, card, phone) are found by leftmost non-overlapping patterns, written so that no text can make
them backtrack. They and tokens of a machine's form (SECRET) are the seeds of the bootstrapping: the two tokens before
a seed, and the three, induce a lexical pattern each; identifier-like tokens (six characters or more with four digits
or more, outside the base spans) after the same tokens are its other instances. Patterns and instances form a bipartite
graph that is scored in rounds:

  confidence(pattern) = sum of the scores of what follows it / how often it occurs in all texts, followed by anything
  score(instance)     = 1 - product of (1 - confidence) over its patterns; seeds stay at 1

A pattern with enough different seeds and a high confidence discovers the tokens after it, as spans of kind `id`; a
token of a machine's form is no personal data by itself and is reported only after such a pattern. Dividing by all
occurrences keeps ordinary word pairs from ever becoming patterns. Texts are cut into tokens once, whole, for the
contexts of seeds and candidates and for the totals alike: every span begins and ends between two tokens.

Defined results: null text is empty; no spans give empty strings and the digest of the empty string; equal rows give
equal rows; overlapping spans of different kinds are all reported and redacted together; an empty table gives an empty
result; very long texts are read whole, in time that grows in proportion to their length and number of matches (times
the square root of the latter at most); extra columns are ignored by find() and kept by redact(), whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import checked_broadcast, columns, materialise, plain

KINDS = ["email", "ip", "card", "phone"]
_LOCAL = "[A-Za-z0-9._%+-]"
#: Possessive forms of the contract's patterns; a match starts at the start of a run or where the last match ended.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs of digits with single separators are maximal and disjoint, so those under 14 digits need no match.
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
CANDIDATE = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{6,}+"
#: Seeds beside the base kinds: tokens that only a machine writes, by form.
SECRET = r"(?i)^(?:[0-9a-f]{32,}|(?=[a-z_-]*[0-9])(?=[0-9_-]*[a-z])[a-z0-9_-]{40,})$"
#: Tokens: every span starts and ends between two of them, so contexts and totals are cut alike.
TOKEN = r"[A-Za-z]+|[0-9]+|[^\x00-\x7F]+|\S"
#: How many tokens before a place a pattern has.
SIZES = (2, 3)
#: Most patterns that are listed in a filter; more are joined.
LISTED = 500
#: Matches whose places are summed up at a time.
RUN = 128


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weigh(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), weigh) % 10 == 0


def _passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        d = _digits(match)
        return F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    return F.lit(True)


def _gate(kind: str, text: Column) -> Column:
    return {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, F.lit(True))


_EMPTY = "array<struct<start:int,end:int,before:int,text:string>>"


def _located(counted: bool) -> list[tuple[str, Column]]:
    """Columns, the last of them __places: array of (start, end, before, text) of the matches __m, from the texts __between them; before: how many tokens
    are before it (0 unless counted). Sums are kept per RUN matches and then within each, so that work stays small."""
    tokens = lambda x: F.regexp_count(x, F.lit(TOKEN)) if counted else F.lit(0)

    def measured(match: Column, i: Column) -> Column:
        gap = F.get(F.col("__between"), i)
        return F.struct(F.length(gap).alias("gap"), F.length(match).alias("size"), tokens(gap).alias("gap_tokens"), tokens(match).alias("tokens"), match.alias("text"))

    part = lambda i: F.slice("__sizes", i * RUN + 1, F.lit(RUN))
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"))
    total = lambda xs, start: F.aggregate(xs, start, lambda t, x: F.struct((t["at"] + x["gap"] + x["size"]).alias("at"), (t["n"] + x["gap_tokens"] + x["tokens"]).alias("n")))
    runs = F.sequence(F.lit(0), F.floor((F.size("__sizes") - 1) / RUN).cast("int"))
    starts = F.aggregate(runs, F.array(zero), lambda acc, i: F.concat(acc, F.array(total(part(i), F.element_at(acc, -1)))))

    def step(acc: Column, x: Column) -> Column:
        begin, before = acc["at"] + x["gap"], acc["n"] + x["gap_tokens"]
        one = F.struct(begin.alias("start"), (begin + x["size"]).alias("end"), before.alias("before"), x["text"].alias("text"))
        return F.struct((begin + x["size"]).alias("at"), (before + x["tokens"]).alias("n"), F.concat(acc["out"], F.array(one)).alias("out"))

    def places(i: Column) -> Column:
        base = F.get(F.col("__starts"), i)
        return F.aggregate(part(i), F.struct(base["at"].alias("at"), base["n"].alias("n"), F.array().cast(_EMPTY).alias("out")), step, lambda a: a["out"])

    some = F.size("__m") > 0
    return [("__sizes", F.when(some, F.transform("__m", measured))), ("__starts", F.when(some, starts)), ("__places", F.when(some, F.flatten(F.transform(runs, places))).otherwise(F.array().cast(_EMPTY)))]


def _with_places(df: DataFrame, pattern: str, out: str, gate: Column, counted: bool = False) -> DataFrame:
    """df (with __t) with the array `out` of (start, end, before, text) of the pattern's matches in __t."""
    df = df.withColumn("__m", F.when(gate, F.regexp_extract_all("__t", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("__between", F.when(F.size("__m") > 0, F.split("__t", pattern, -1)))
    for name, column in _located(counted):
        df = df.withColumn(name, column)
    return df.withColumn(out, F.col("__places")).drop("__m", "__between", "__sizes", "__starts", "__places")


def with_base(df: DataFrame, text_col: str = "text", counted: bool = False) -> DataFrame:
    """df with __t (the text, never null) and __base: array of (start, kind number, end, before, text), sorted."""
    df = df.withColumn("__t", F.coalesce(F.col(text_col).cast("string"), F.lit("")))

    def good(n: int, kind: str) -> Column:
        passed = F.filter(f"__{kind}", lambda m: _passes(kind, m["text"]))
        return F.transform(passed, lambda m: F.struct(m["start"].alias("start"), F.lit(n).alias("kind"), m["end"].alias("end"), m["before"].alias("before"), m["text"].alias("text")))

    for kind in KINDS:
        df = _with_places(df, PATTERNS[kind], f"__{kind}", _gate(kind, F.col("__t")), counted)
    parts = [good(n, kind) for n, kind in enumerate(KINDS)]
    return df.withColumn("__base", F.array_sort(F.concat(*parts))).drop(*[f"__{k}" for k in KINDS])


def _tokens(text: Column) -> Column:
    """The tokens of a text in lower case (A-Z, so that every token keeps its place)."""
    return F.regexp_extract_all(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(TOKEN), F.lit(0))


def _pattern(before: list[Column]) -> Column:
    """Hash of the tokens before a place; null if there are fewer."""
    return F.when(before[0].isNotNull(), F.xxhash64(F.lit(len(before)), *before))


def _instances(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, copy, base, seeds and candidates of each row, without the text."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("copy"), F.col(text_col).alias("__text"))
    found = _with_places(with_base(slim, "__text", True), CANDIDATE, "__like", F.lit(True), True)
    free = lambda m: (F.length(_digits(m["text"])) >= 4) & ~F.exists("__base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    found = found.withColumn("__free", F.filter("__like", free))
    found = found.withColumn("__tokens", F.when((F.size("__base") > 0) | (F.size("__free") > 0), _tokens(F.col("__t"))))
    at = lambda m, back: F.get(F.col("__tokens"), m["before"] - back)
    patterns = lambda m: F.array(*[_pattern([at(m, k) for k in range(n, 0, -1)]) for n in SIZES])
    fields = lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), patterns(m).alias("patterns"), at(m, 1).alias("last"), F.xxhash64(F.lower(m["text"])).alias("instance"), m["text"].rlike(SECRET).alias("secret"))
    return found.select(
        "doc_id",
        "copy",
        F.transform("__base", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end"))).alias("base"),
        F.transform("__base", fields).alias("seeds"),
        F.transform("__free", fields).alias("candidates"),
    )


def _occurrences(docs: DataFrame, text_col: str, patterns: DataFrame) -> DataFrame:
    """pattern, total: how often each of the patterns (pattern, last: its last token) occurs in all texts, followed by anything or nothing.

    Up to LISTED patterns are a list in a filter: places after other tokens than their last ones are skipped before
    anything is hashed. More are joined. Either way a place of a text gives a row for each size at most.
    """
    most, listed = max(SIZES), patterns.select("pattern", "last").limit(LISTED + 1).collect()
    few = len(listed) <= LISTED
    raw = docs.select(_tokens(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("raw"))
    shifted = [F.concat(F.array_repeat(F.lit(None).cast("string"), k), F.col("raw")).alias(f"t{k}") for k in range(most - 1, -1, -1)]
    each = raw.select(F.explode(F.arrays_zip(*shifted)).alias("w")).filter(F.col("w.t0").isin(sorted({r["last"] for r in listed})) if few else F.col("w.t0").isNotNull())
    hashed = each.select(F.explode(F.array(*[_pattern([F.col(f"w.t{k}") for k in range(n - 1, -1, -1)]) for n in SIZES])).alias("found"))
    if few:
        hits = hashed.filter(F.col("found").isin([r["pattern"] for r in listed])).withColumnRenamed("found", "pattern")
    else:
        hits = hashed.join(checked_broadcast(patterns), F.col("found") == F.col("pattern")).select("pattern")
    return hits.groupBy("pattern").agg(F.count(F.lit(1)).alias("total"))


def discover(docs: DataFrame, found: DataFrame, text_col: str = "text", rounds: int = 3, support: int = 5, confidence: float = 0.5) -> DataFrame:
    """doc_id, copy, extra: array of (start, end) of identifiers that bootstrapped patterns find. found: _instances()."""

    def rows(what: str, seed: Column) -> DataFrame:
        each = found.select(F.explode(what).alias("x")).select(F.explode("x.patterns").alias("pattern"), "x.instance", "x.last", seed.alias("seed"), F.lit(what == "candidates").alias("open"))
        return each.filter("pattern is not null")

    both = rows("seeds", F.lit(True)).union(rows("candidates", F.col("x.secret")))
    edges = materialise(both.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"), F.max("open").alias("open"), F.max("last").alias("last")), "edges")
    # A pattern matters only if it has seeds enough and something to discover.
    backed = edges.groupBy("pattern").agg(F.sum(F.col("seed").cast("int")).alias("s"), F.max("open").alias("open"), F.max("last").alias("last")).filter(f"s >= {int(support)} and open")
    patterns = materialise(backed.select("pattern", "last"), "patterns")
    none = found.sparkSession.createDataFrame([], f"doc_id {found.schema['doc_id'].dataType.simpleString()}, copy long, extra array<struct<start:int,end:int>>")
    if not patterns.limit(1).count():
        return none
    totals = materialise(_occurrences(docs, text_col, patterns), "totals")
    graph = materialise(edges.join(totals, "pattern"), "graph")
    scores = graph.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    trust = None
    for _ in range(rounds):
        trust = graph.join(scores, "instance").groupBy("pattern").agg(F.least(F.sum(F.col("score") * F.col("n")) / F.max("total"), F.lit(0.999)).alias("trust"))
        scores = graph.join(trust, "pattern").groupBy("instance").agg((1 - F.exp(F.sum(F.log1p(-F.col("trust"))))).alias("up"), F.max(F.col("seed").cast("double")).alias("fixed")).select("instance", F.greatest("up", "fixed").alias("score"))
    good = materialise(trust.filter(F.col("trust") >= confidence).select(F.col("pattern").alias("good")), "good")
    spans = found.select("doc_id", "copy", F.explode("candidates").alias("x")).select("doc_id", "copy", "x.start", "x.end", F.explode("x.patterns").alias("pattern"))
    hits = spans.join(checked_broadcast(good), F.col("pattern") == F.col("good"))
    return hits.groupBy("doc_id", "copy").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("extra"))


def _joined(spans: Column, names: list[str]) -> Column:
    name = lambda s: F.element_at(F.array(*[F.lit(x) for x in names]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _more(extra: Column) -> Column:
    """Discovered places as spans of the kind after the base kinds."""
    return F.transform(F.coalesce(extra, F.array().cast("array<struct<start:int,end:int>>")), lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["end"].alias("end")))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bootstrap) -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_discovered."""
    docs = columns(docs, doc_id=id_col, text=text_col)
    found = materialise(_instances(docs, "doc_id", "text"), "instances")
    extra = materialise(discover(docs, found, **bootstrap), "extra")
    known = extra.select(F.col("doc_id").alias("__id"), F.col("copy").alias("__copy"), "extra")
    rows = found.select("doc_id", "copy", "base").join(checked_broadcast(known), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("copy") == F.col("__copy")), "left")
    rows = rows.select("doc_id", "base", _more(F.col("extra")).alias("more"))

    def count(n: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long")

    counts = [count(n).alias(f"n_{k}") for n, k in enumerate(KINDS)]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("base"), KINDS).cast("binary"), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "more")), [*KINDS, "id"]).alias("spans"),
        F.size("more").cast("long").alias("n_discovered"),
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bootstrap) -> DataFrame:
    """docs with every span replaced by its kind in brackets; overlapping spans become one. n_chars follows the text."""
    rows, key, text, chars = plain(docs, id_col, text_col, "n_chars")
    names = rows.columns
    slim = rows.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    found = materialise(_instances(slim, "doc_id", "text"), "instances")
    extra = materialise(discover(slim, found, **bootstrap), "extra")
    known = extra.select(F.col("doc_id").alias("__id"), F.col("copy").alias("__copy"), F.col("extra").alias("__extra"))
    rows = with_base(rows, text).withColumn("__key", F.xxhash64("__t"))
    rows = rows.join(checked_broadcast(known), F.col(key).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__copy")), "left")
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in [*KINDS, "id"]])
    own = F.transform("__base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    rows = rows.withColumn("__spans", F.array_sort(F.concat(own, _more(F.col("__extra")))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        new = F.concat(acc["out"], F.substr("__t", acc["at"] + 1, s["start"] - acc["at"]), F.element_at(labels, s["kind"] + 1))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

    safe = F.aggregate("__spans", start, step, lambda a: F.concat(a["out"], F.substr("__t", a["at"] + 1, F.length("__t"))))
    rows = rows.withColumn("__safe", F.when(F.size("__spans") > 0, safe))
    changed = {text: F.coalesce("__safe", text)}
    if chars:
        changed[chars] = F.coalesce(F.length("__safe"), chars).cast(docs.schema.fields[names.index(chars)].dataType)
    return rows.withColumns(changed).select(*names).toDF(*docs.columns)
