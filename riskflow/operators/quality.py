"""Validation: an ordered list of rules gives each raw row its first failing category; a second ordered list gives the reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Categories, allowed values, ceiling.
PARSE, SCHEMA, NULLS, ENUM = "parse_error", "schema_violation", "null_check", "enum_violation"
CHANNELS, OPS, MUTATIONS, CEILING = ("fednow", "ach"), ("insert", "update", "delete"), ("update", "delete"), 10_000_000
KEYS = ("transaction_id", "customer_id", "amount", "txn_ts")
c = F.col


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def first_match(rules: list[tuple[Column, Column]]) -> Column:
    """The value of the first rule that holds; NULL if none does. A NULL condition doesn't hold."""
    return F.coalesce(*[F.when(test, value) for test, value in rules])


def unparsed() -> Column:
    return all_of([c("_raw_payload").isNotNull(), *[c(k).isNull() for k in KEYS]])


def error_type() -> Column:
    missing = any_of([c(k).isNull() for k in ("op_type", "change_ts", "channel")])
    rules = {
        PARSE: [unparsed()],
        SCHEMA: [missing | (c("amount") > CEILING), c("amount") <= 0],
        NULLS: [any_of([c(k).isNull() for k in KEYS])],
        ENUM: [~c("channel").isin(*CHANNELS) | ~c("op_type").isin(*OPS)],
    }
    ordered = [(test, F.lit(kind)) for kind, tests in rules.items() for test in tests]
    return first_match([*ordered, (F.trim("customer_id") == "", F.lit(NULLS))])


#: The order of the reasons, as (what is wrong, field), and their texts.
REASONS = [
    ("unparsed", None),
    ("missing", "op_type"),
    ("missing for", "change_ts"),
    ("missing", "change_ts"),
    ("exceeds ceiling", "amount"),
    ("not positive", "amount"),
    ("null", "transaction_id"),
    ("null", "customer_id"),
    ("empty", "customer_id"),
    ("null", "amount"),
    ("null", "txn_ts"),
    ("not allowed", "channel"),
    ("not allowed", "op_type"),
    ("missing", "channel"),
]
TEXTS = {"unparsed": "raw payload present but all typed fields null", "missing for": "change_ts missing for op_type "}
ALLOWED = {"channel": CHANNELS, "op_type": OPS}


def _reason(wrong: str, field: str | None) -> tuple[Column, Column]:
    """When a reason holds, and its text; reasons about a value end with it."""
    text = TEXTS.get(wrong, f"{field} {wrong}")
    if wrong == "unparsed":
        return unparsed(), F.lit(text)
    if wrong in ("missing", "null"):
        return c(field).isNull(), F.lit(text)
    if wrong == "empty":
        return F.trim(field) == "", F.lit(text)
    if wrong == "missing for":
        return c(field).isNull() & c("op_type").isin(*MUTATIONS), F.concat(F.lit(text), c("op_type"))
    tests = {"exceeds ceiling": lambda: c(field) > CEILING, "not positive": lambda: c(field) <= 0, "not allowed": lambda: ~c(field).isin(*ALLOWED[field])}
    return tests[wrong](), F.concat(F.lit(f"{text}: "), c(field).cast("string"))


def error_detail() -> Column:
    """The reason, in its own order; also for a missing channel, which has a category."""
    return first_match([_reason(*r) for r in REASONS])


def classify(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns({"_error_type": error_type(), "_error_detail": error_detail()})


def split(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    tagged = classify(bronze)
    return tagged.filter("_error_type is null").drop("_error_type", "_error_detail"), tagged.filter("_error_type is not null")


def violations(df: DataFrame, not_null: list[str] = (), unique: list[str] = (), accepted: dict[str, list] | None = None) -> DataFrame:
    """(test, failures): one row for each data test."""
    counts = {f"not_null:{k}": F.count_if(c(k).isNull()) for k in not_null} | {f"accepted:{k}": F.count_if(~c(k).isin(*v)) for k, v in (accepted or {}).items()}
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("test"), c(f"`{n}`").alias("failures")) for n in counts])).alias("x")
    parts = [df.agg(*[v.alias(n) for n, v in counts.items()]).select(pairs).select("x.*")] if counts else []
    parts += [df.filter(c(k).isNotNull()).groupBy(k).count().agg(F.lit(f"unique:{k}").alias("test"), F.count_if(c("count") > 1).alias("failures")) for k in unique]
    return reduce(DataFrame.unionByName, parts)
