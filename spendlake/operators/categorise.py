"""Rule-based categorisation.

A transaction takes the category of the best matching rule, best meaning
highest priority, then lowest category key (NULLs last in both).  Rules of
type ``description`` / ``name`` match when the lower-cased pattern occurs in
the lower-cased text (``%`` and ``_`` in a pattern act as wildcards);
``transaction_type`` rules compare the lower-cased type for equality.  No
match -> ``CAT999`` / ``Uncategorized``; a best rule whose key is NULL is
also ``Uncategorized``.

Every plan is map-only and takes any number of rules:

* ``case`` (default up to ``CASE_LIMIT`` rules, what generated code holds
  comfortably): the rules, sorted once, are compiled into one CASE chain.
* ``automaton`` (default beyond): the patterns' literal texts form one
  Aho-Corasick automaton, so a text is read once however many rules there are;
  type rules are looked up by equality, wildcards are checked only where
  their longest literal occurs.  An Arrow UDF, since no built-in expression
  finds many patterns in one pass.
* ``array``: the rules travel as one literal ``array<struct>``; the first
  element of ``filter(rules, matches)`` wins.
* ``join``: all matches of each transaction (``rule_matches``: the array form's
  filter, beyond ``CASE_LIMIT`` rules the automaton) and the best one by an
  aggregate, joined back on the key.

The rule table is a seed that the driver holds anyway; beyond ``BLOCK_RULES``
rules the automaton is built in blocks, so a worker holds a bounded one.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake import fixed_values as FV
from spendlake.schemas import RULES

CASE_LIMIT = 200
BLOCK_RULES = 100_000

TEXT_COLUMN = {"description": "transaction_description", "name": "counterparty_name"}
PATTERN_TYPES = ("description", "name", "transaction_type")


def _collect_rules(rules: DataFrame) -> list[tuple]:
    return [tuple(r) for r in rules.select("pattern_type", "pattern_value", "category_key", "priority").collect()]


def rank_key(rule: tuple):
    """Sort key: priority desc, category key asc, NULLs last in both."""
    _, _, key, priority = rule
    return (priority is None, -(priority or 0), key is None, key or "")


def _usable(rule: tuple) -> bool:
    ptype, value = rule[0], rule[1]
    return ptype in PATTERN_TYPES and value is not None


def _like_pattern(value: str) -> str:
    # LIKE without escape: only % and _ are special.
    return "%" + value + "%"


def _escape(values: list[str]) -> Column:
    """A control character that no pattern holds: LIKE's escape, never used, so every character stands for itself."""
    held = set().union(*values) if values else set()
    return F.lit(next(chr(c) for c in range(1, 1 << 16) if chr(c) not in held and not chr(c).isprintable()))


def _text_match(text_lc: Column, value: str) -> Column:
    needle = F.lower(F.lit(value))
    if "%" in value or "_" in value:
        return F.like(text_lc, F.lower(F.lit(_like_pattern(value))), _escape([value]))
    return F.contains(text_lc, needle)


def _lowered(df: DataFrame) -> dict[str, Column]:
    return {
        "description": F.lower(F.col("transaction_description")),
        "name": F.lower(F.col("counterparty_name")),
        "transaction_type": F.lower(F.col("transaction_type")),
    }


def _condition(rule: tuple, lowered: dict[str, Column]) -> Column:
    ptype, value = rule[0], rule[1]
    if ptype == "transaction_type":
        return lowered[ptype] == F.lower(F.lit(value))
    return _text_match(lowered[ptype], value)


def _finish(df: DataFrame, best_key: Column, matched: Column) -> DataFrame:
    return df.withColumns({
        "category_key": F.coalesce(best_key, F.lit(FV.UNCATEGORISED_KEY)),
        "categorization_status": F.when(matched, F.lit("Matched")).otherwise(F.lit("Uncategorized")),
    })


def _with_lowered(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    tmp = {"description": "_desc_lc", "name": "_name_lc", "transaction_type": "_type_lc"}
    low = _lowered(df)
    df = df.withColumns({tmp[k]: v for k, v in low.items()})
    return df, {k: F.col(v) for k, v in tmp.items()}


def _drop_lowered(df: DataFrame) -> DataFrame:
    return df.drop("_desc_lc", "_name_lc", "_type_lc")


def categorise_case(staged: DataFrame, rules: list[tuple]) -> DataFrame:
    ordered = sorted([r for r in rules if _usable(r)], key=rank_key)
    df, low = _with_lowered(staged)
    if not ordered:
        return _finish(df, F.lit(None).cast("string"), F.lit(False)).transform(_drop_lowered)
    chain = None
    for rule in ordered:
        cond = _condition(rule, low)
        key = F.lit(rule[2]).cast("string")
        chain = F.when(cond, key) if chain is None else chain.when(cond, key)
    df = df.withColumn("_best_key", chain)
    return (_finish(df, F.col("_best_key"), F.col("_best_key").isNotNull())
            .drop("_best_key").transform(_drop_lowered))


def _rule_array(rules: list[tuple]) -> Column:
    ordered = sorted([r for r in rules if _usable(r)], key=rank_key)
    return F.array(*[
        F.struct(F.lit(r[0]).alias("pattern_type"), F.lower(F.lit(r[1])).alias("pattern_lc"),
                 F.lit(("%" in r[1]) or ("_" in r[1])).alias("wild"),
                 F.lit(r[2]).cast("string").alias("category_key"),
                 F.lit(r[3]).cast("int").alias("priority"))
        for r in ordered
    ]) if ordered else F.array().cast(
        "array<struct<pattern_type:string,pattern_lc:string,wild:boolean,category_key:string,priority:int>>")


def _array_match(rule: Column, low: dict[str, Column], escape: Column) -> Column:
    def text(lc: Column) -> Column:
        return F.when(rule["wild"], F.like(lc, F.concat(F.lit("%"), rule["pattern_lc"], F.lit("%")), escape)) \
                .otherwise(F.contains(lc, rule["pattern_lc"]))
    return (F.when(rule["pattern_type"] == "description", text(low["description"]))
             .when(rule["pattern_type"] == "name", text(low["name"]))
             .otherwise(low["transaction_type"] == rule["pattern_lc"]))


def matching_rules(df: DataFrame, rules: list[tuple], low: dict[str, Column]) -> Column:
    """All matching rules of a row, best first (``array<struct>``)."""
    escape = _escape([r[1] for r in rules if _usable(r)])
    return F.filter(_rule_array(rules), lambda r: F.coalesce(_array_match(r, low, escape), F.lit(False)))


def categorise_array(staged: DataFrame, rules: list[tuple]) -> DataFrame:
    df, low = _with_lowered(staged)
    df = df.withColumn("_matches", matching_rules(df, rules, low))
    best = F.get(F.col("_matches"), 0)
    return (_finish(df, best["category_key"], best["category_key"].isNotNull())
            .drop("_matches").transform(_drop_lowered))


class _Matcher:
    """One block of rules, best first; finds the rules that match a row."""

    def __init__(self, rules: list[tuple]):
        self.types: dict[str, list[int]] = {}
        self.finders = {t: ahocorasick.Automaton() for t in TEXT_COLUMN}
        self.patterns: list[re.Pattern | None] = [None] * len(rules)
        self.always: dict[str, list[int]] = {t: [] for t in TEXT_COLUMN}
        needles: dict[str, dict[str, list[int]]] = {t: {} for t in TEXT_COLUMN}
        for k, (kind, value) in enumerate(rules):
            if kind == "transaction_type":
                self.types.setdefault(value, []).append(k)
                continue
            literals = re.split("[%_]", value)
            if len(literals) > 1:
                body = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in value)
                self.patterns[k] = re.compile(body, re.S)
            needle = max(literals, key=len)
            if needle:
                needles[kind].setdefault(needle, []).append(k)
            else:
                self.always[kind].append(k)
        for kind, found in needles.items():
            for needle, rows in found.items():
                self.finders[kind].add_word(needle, rows)
            if found:
                self.finders[kind].make_automaton()

    def __call__(self, texts: dict[str, str | None], type_lc: str | None) -> set[int]:
        out = set(self.types.get(type_lc, ()))
        for kind, text in texts.items():
            if text is None:
                continue
            hits = set(self.always[kind])
            if len(self.finders[kind]):
                hits.update(k for _, rows in self.finders[kind].iter(text) for k in rows)
            out.update(k for k in hits if self.patterns[k] is None or self.patterns[k].search(text))
        return out


class _Block:
    """Up to BLOCK_RULES rules, best first; a worker builds their matcher once."""

    def __init__(self, rules: list[tuple]):
        self.rules = rules

    @functools.cached_property
    def matcher(self) -> _Matcher:
        return _Matcher([r[:2] for r in self.rules])

    def matches(self, description: pd.Series, name: pd.Series, kind: pd.Series) -> Iterator[list[tuple]]:
        """The matching rules of each row, best first."""
        for d, n, t in zip(description, name, kind, strict=True):
            yield [self.rules[k] for k in sorted(self.matcher({"description": d, "name": n}, t))]


def _blocks(staged: DataFrame, rules: DataFrame) -> list:
    """The usable rules, best first, in broadcast blocks."""
    usable = rules.filter(F.col("pattern_type").isin(*PATTERN_TYPES) & F.col("pattern_value").isNotNull())
    # lowered by the same function as the texts
    ordered = sorted(_collect_rules(usable.withColumn("pattern_value", F.lower("pattern_value"))), key=rank_key)
    context = staged.sparkSession.sparkContext
    return [context.broadcast(_Block(ordered[at:at + BLOCK_RULES])) for at in range(0, len(ordered), BLOCK_RULES)]


def _best_rule(shared):
    @F.pandas_udf("found boolean, key string")
    def best_rule(description: pd.Series, name: pd.Series, kind: pd.Series) -> pd.DataFrame:
        rows = list(shared.value.matches(description, name, kind))
        keys = pd.Series([m[0][2] if m else None for m in rows], dtype=object)
        return pd.DataFrame({"found": [bool(m) for m in rows], "key": keys})
    return best_rule


def _all_rules(shared):
    @F.pandas_udf("array<struct<pattern_type:string,category_key:string,priority:int>>")
    def all_rules(description: pd.Series, name: pd.Series, kind: pd.Series) -> pd.Series:
        return pd.Series([[{"pattern_type": t, "category_key": k, "priority": p} for t, _, k, p in m]
                          for m in shared.value.matches(description, name, kind)], dtype=object)
    return all_rules


def categorise_automaton(staged: DataFrame, rules: DataFrame) -> DataFrame:
    texts = _lowered(staged)
    df, best, columns = staged, F.lit(None).cast("struct<key:string>"), []
    for n, shared in enumerate(_blocks(staged, rules)):
        columns.append(f"_block{n}")
        df = df.withColumn(columns[-1], _best_rule(shared)(*texts.values()))
        # blocks come best first
        best = F.coalesce(best, F.when(F.col(f"{columns[-1]}.found"), F.struct(F.col(f"{columns[-1]}.key").alias("key"))))
    df = df.withColumn("_best", best)
    return _finish(df, F.col("_best.key"), F.col("_best.key").isNotNull()).drop("_best", *columns)


def rule_matches(staged: DataFrame, rules: DataFrame, pattern_type: str | None = None) -> DataFrame:
    """Every (transaction, rule) match: transaction_hash, pattern_type, category_key, priority."""
    if pattern_type is not None:
        rules = rules.filter(F.col("pattern_type") == pattern_type)
    few = _collect_rules(rules.limit(CASE_LIMIT + 1))
    if len(few) <= CASE_LIMIT:
        df, low = _with_lowered(staged)
        hits = df.select("transaction_hash", F.explode(matching_rules(df, few, low)).alias("_r"))
        return hits.select("transaction_hash", "_r.pattern_type", "_r.category_key", "_r.priority")
    schema = T.StructType([T.StructField("transaction_hash", T.StringType()), *RULES.fields[:1], *RULES.fields[2:]])
    out = staged.sparkSession.createDataFrame([], schema)
    texts = _lowered(staged)
    for shared in _blocks(staged, rules):
        hits = staged.select("transaction_hash", F.explode(_all_rules(shared)(*texts.values())).alias("_r"))
        out = out.union(hits.select("transaction_hash", "_r.*"))
    return out


def _rank_struct() -> Column:
    return F.struct(F.col("priority").isNull(), -F.col("priority"),
                    F.col("category_key").isNull(), F.col("category_key"))


def best_matches(matches: DataFrame) -> DataFrame:
    """Best rule per transaction: an aggregate (partial on the map side)."""
    return (matches.groupBy("transaction_hash")
            .agg(F.min_by(F.struct("category_key", "priority"), _rank_struct()).alias("_b"))
            .select("transaction_hash", F.col("_b.category_key").alias("category_key"),
                    F.col("_b.priority").alias("priority")))


def categorise_join(staged: DataFrame, rules: DataFrame) -> DataFrame:
    best = best_matches(rule_matches(staged, rules)).select(
        F.col("transaction_hash").alias("_bm_hash"), F.col("category_key").alias("_bm_key"),
        F.lit(True).alias("_bm_found"))
    df = staged.join(best, staged["transaction_hash"] == best["_bm_hash"], "left")
    df = _finish(df, F.col("_bm_key"), F.col("_bm_key").isNotNull())
    return df.drop("_bm_hash", "_bm_key", "_bm_found")


def categorise(staged: DataFrame, rules: DataFrame, method: str = "auto") -> DataFrame:
    """Add ``category_key`` and ``categorization_status``."""
    if method == "join":
        return categorise_join(staged, rules)
    if method == "automaton":
        return categorise_automaton(staged, rules)
    if method not in ("auto", "case", "array"):
        raise ValueError(f"unknown method {method!r}")
    if method == "auto" and len(rules.limit(CASE_LIMIT + 1).collect()) > CASE_LIMIT:
        return categorise_automaton(staged, rules)
    collected = _collect_rules(rules)
    return categorise_array(staged, collected) if method == "array" else categorise_case(staged, collected)
