"""Secret scans with a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression. The trigrams that any match must hold are
derived from it as an OR of ANDs (``trigrams.alternatives``). One pass over
the texts notes which of the rules' trigrams each holds (in lower case); the
postings (trigram, row) are intersected per AND, which gives each rule's
candidate rows; only those are searched with the expression. A rule without
mandatory trigrams (a run of hex digits) is searched in every text.

Positions come from the texts between the matches: ``split`` by the same
expression gives them, and a running sum of their and the matches' lengths
gives starts and ends in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.textcore import stored
from martflow.llm.trigrams import alternatives


@dataclass(frozen=True)
class Rule:
    """Matches of pattern whose group has at least ``least`` characters count;
    the others are dropped after matching, so they do hide what they cover."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# fixed values: the base rules
BASE_RULES = (
    Rule("assign", "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
                   "([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
)

# fixed values: publicly documented token formats
TOKEN_RULES = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[0-9A-Za-z_-]{35}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}"),
)

RULES = BASE_RULES + TOKEN_RULES
MARK = "[SECRET]"

KEY = ["id", "h"]  # a row by its id and its text's hash; equal rows have equal spans


def _search(rule: Rule) -> str:
    """The expression searched for. A run of one class that is dropped when
    too short holds no other match, so its least length can be part of it."""
    if rule.group == 0 and rule.pattern.endswith("]+") and rule.pattern.count("[") == 1:
        lead = rule.pattern.index("[")
        return rule.pattern[:-1] + f"{{{max(1, rule.least - lead)},}}"
    return rule.pattern


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _index(keyed: DataFrame, trigrams: list[str]) -> DataFrame:
    """(id, h, held): the rules' trigrams that each row holds."""
    lower = keyed.select("id", "h", F.lower("text").alias("lower"))
    held = [F.when(F.contains("lower", F.lit(t)), F.lit(t)) for t in trigrams]
    return lower.select("id", "h", F.array_compact(F.array(*held)).alias("held"))


def _candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(id, h, rules): rows that hold all trigrams of one AND of a rule."""
    wanted = [(t, kind, n, len(all_of)) for kind, sets in queries.items()
              for n, all_of in enumerate(sets) for t in sorted(all_of)]
    # as many rows as the rules have trigrams: a fixed size
    wanted = F.broadcast(index.sparkSession.createDataFrame(
        wanted, "trigram string, kind string, n int, least int"))
    postings = index.select(F.explode("held").alias("trigram"), "id", "h")
    return (postings.join(wanted, "trigram").groupBy(*KEY, "kind", "n")
            .agg(F.size(F.collect_set("trigram")).alias("met"), F.first("least").alias("least"))
            .where("met = least").groupBy(*KEY).agg(F.collect_set("kind").alias("rules")))


def _matches(rule: Rule) -> Column:
    """Lengths of (text before, match, value) of each match, in order."""
    search = F.lit(_search(rule))
    before = F.transform(F.split("text", _search(rule), -1), F.length)
    whole = F.transform(F.regexp_extract_all("text", search, F.lit(0)), F.length)
    value = F.transform(F.regexp_extract_all("text", search, F.lit(rule.group)), F.length)
    return F.when(F.regexp_like("text", search), F.arrays_zip(
        before.alias("before"), whole.alias("whole"), value.alias("value")))


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): (id, h) of every row of docs, and one row per span of
    each distinct (id, h): kind, place (the rule's number), start, end.

    Positions are code points, end exclusive; matches of one rule do not
    overlap, those of different rules may. Null and empty texts have no span.
    """
    keyed = _keyed(docs, id_col, text_col)
    queries = {r.kind: q for r in rules if (q := alternatives(r.pattern)) is not None}
    index = stored(_index(keyed, sorted({t for q in queries.values() for s in q for t in s})),
                   "trigrams")
    found = stored(_candidates(index, queries), "candidates")
    found = found.select(F.col("id").alias("id_c"), F.col("h").alias("h_c"), "rules")
    searched = keyed.join(found, keyed["id"].eqNullSafe(F.col("id_c")) & (F.col("h") == F.col("h_c")),
                          "left")
    per_rule = [F.struct(
        F.lit(i).alias("place"), F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"),
        (F.when(F.array_contains("rules", r.kind), _matches(r)) if r.kind in queries
         else _matches(r)).alias("found")) for i, r in enumerate(rules)]
    each = (searched.select(*KEY, F.inline(F.filter(
        F.array(*per_rule), lambda m: F.size(m["found"]) > 0))).dropDuplicates([*KEY, "place"])
        .select(*KEY, "place", "kind", "least", F.posexplode("found").alias("n", "m"))
        .where("m.whole is not null"))  # the text behind the last match
    up_to = F.sum(F.col("m.before") + F.col("m.whole")).over(
        Window.partitionBy(*KEY, "place").orderBy("n"))
    spans = (each.withColumn("end", up_to.cast("bigint"))
             .withColumn("start", F.col("end") - F.col("m.whole"))
             .where(F.col("m.value") >= F.col("least"))
             .select(*KEY, "place", "kind", "start", "end"))
    return index.select(*KEY), stored(spans, "spans")


def _rejoined(rows: DataFrame, per_row: DataFrame) -> DataFrame:
    """rows with per_row's columns, by (id, h), null-safe."""
    named = per_row.withColumnsRenamed({"id": "id_r", "h": "h_r"})
    return rows.join(named, rows["id"].eqNullSafe(named["id_r"]) & (rows["h"] == named["h_r"]),
                     "left").drop("id_r", "h_r")


def secret_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE_RULES),
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_<kind> of the first ``base`` rules, base_sha256 and spans
    (see the spans table); all spans as kind:start:end, by start, then rule."""
    rows, spans = secret_spans(docs, rules, id_col, text_col)
    listed = F.sort_array(F.collect_list(F.struct("start", "place", "kind", "end")))
    per_row = spans.groupBy(*KEY).agg(listed.alias("all"))

    def joined(some: Column) -> Column:
        return F.array_join(F.transform(some, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    out = _rejoined(rows, per_row).withColumn("all", F.coalesce("all", F.expr(
        "cast(array() as array<struct<start:bigint,place:int,kind:string,end:bigint>>)")))
    places = F.transform("all", lambda s: s["place"])
    counts = [(F.size(places) - F.size(F.array_remove(places, i))).cast("bigint")
              .alias(f"n_{rules[i].kind}") for i in range(base)]
    return out.select(
        F.col("id").alias(id_col), *counts,
        F.sha2(joined(F.filter("all", lambda s: s["place"] < base)).cast("binary"), 256)
        .alias("base_sha256"), joined(F.col("all")).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
           text_col: str = "text", mark: str = MARK, length_col: str | None = None) -> DataFrame:
    """docs, all columns, with each stretch of overlapping spans replaced by
    mark, and length_col, if named, set to the new length in code points.
    Rows without a span are unchanged."""
    _, spans = secret_spans(docs, rules, id_col, text_col)
    by_start = Window.partitionBy(*KEY).orderBy("start", "end", "place")
    earlier = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    stretch = F.sum(F.when(F.col("start") < F.col("earlier"), 0).otherwise(1)).over(by_start)
    cuts = (spans.withColumn("earlier", earlier).withColumn("stretch", stretch)
            .groupBy(*KEY, "stretch").agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts")))
    own = ["id", "h", "cuts"]
    while set(own) & set(docs.columns):
        own = [f"{c}_" for c in own]
    key, hashed, found = own
    cuts = cuts.toDF(*own)
    text = F.col(text_col).cast("string")
    joined = docs.join(cuts, F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text) == F.col(hashed)), "left")
    size = F.size(found)
    first = lambda i: F.when(i > 0, F.get(found, i - 1)["end"]).otherwise(0)
    last = lambda i: F.when(i < size, F.get(found, i)["start"]).otherwise(F.length(text))
    clean = F.array_join(F.transform(F.sequence(F.lit(0), size), lambda i: F.substr(
        text, (first(i) + 1).cast("int"), (last(i) - first(i)).cast("int"))), mark)
    out = joined.withColumn(text_col, F.when(size > 0, clean).otherwise(F.col(text_col)))
    if length_col is not None:
        out = out.withColumn(length_col, F.when(size > 0, F.length(text)).otherwise(F.col(length_col))
                             .cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)
