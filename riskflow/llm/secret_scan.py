"""Secret scans over a ledger of blobs.

Every version of every text is addressed by the SHA-256 of its content, its blob. The ledger is a Parquet table with one row
for each pair of blob and rule version that was scanned, with the findings. A scan shuffles each distinct blob once, applies
to it the rules whose version the ledger hasn't seen with it, appends these pairs, and joins the findings back to all rows:
all paths and all versions of them. When one rule changes, old blobs are read for that rule alone.

Appending may be repeated (a retried scan, two scans at once): pairs that are there twice count once when they are read.

Spans are in code points, end exclusive, found leftmost and without overlap for each rule.

Nulls and odd input: a null text is the empty blob; equal texts share a blob and get the same findings; a null id or any
other column stays as it is; an empty table gives no row; columns named like the result's replace nothing, since only
the id and the text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, maybe_broadcast, slices


@dataclass(frozen=True)
class Rule:
    """`group` of a match must have `least` characters; `hint` must occur in the lower-case text, where given."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    any_case: bool = False
    hint: tuple[str, ...] = ()


#: The base rules, in the order in which spans with the same start are listed.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True, ("passw", "secret", "token", "api")),
    Rule("access", r"AKIA[A-Z0-9]+", 20, hint=("akia",)),
    Rule("hex", r"[0-9a-f]+", 24),
)
LEDGER = "blob binary, rule string, spans array<struct<start:long,end:long>>"
SPANS = "array<struct<kind:string,start:long,end:long>>"


def rule_version(rule: Rule) -> str:
    return hashlib.sha256(repr(rule).encode()).hexdigest()[:16]


def compiled(rules: tuple[Rule, ...]) -> list[tuple[Rule, re.Pattern]]:
    out = []
    for r in rules:
        # A plain class with a minimum is matched as such; the maximal runs are the same and short ones cost less.
        simple = r.group == 0 and r.pattern.endswith("]+")
        head = re.sub(r"\[.*", "", r.pattern)
        pattern = f"{r.pattern[:-1]}{{{r.least - len(head)},}}" if simple else r.pattern
        out.append((r, re.compile(pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0))))
    return out


def find(text: str, low: str, rule: Rule, pattern: re.Pattern) -> list[tuple[int, int]]:
    """The spans of one rule in a text; `low` is the text in lower case."""
    if rule.hint and not any(h in low for h in rule.hint):
        return []
    return [m.span() for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _scan(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {rule_version(rule): (rule, pattern) for rule, pattern in compiled(rules)}
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches):
            out = []
            for blob, text, todo in zip(*(batch.column(c).to_pylist() for c in ("blob", "text", "todo")), strict=True):
                low = text.lower()
                out += [(blob, version, [{"start": a, "end": b} for a, b in find(text, low, *own[version])]) for version in todo]
            blobs, versions, found = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), pa.array(versions), pa.array(found, spans)], names=["blob", "rule", "spans"])

    return run


def blob_of(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def update_ledger(versions: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scans the pairs of blob of `versions` and rule that the ledger doesn't have; returns the ledger's rows of these rules."""
    spark, names = versions.sparkSession, [rule_version(r) for r in rules]
    blobs = versions.select(blob_of(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    todo = F.array(*[F.lit(n) for n in names])
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(ledger)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        seen = spark.read.schema(LEDGER).parquet(ledger).filter(F.col("rule").isin(names)).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = F.array_except(todo, F.coalesce("seen", F.array().cast("array<string>")))
        blobs = blobs.join(seen, "blob", "left")
    blobs.select("blob", "text", todo.alias("todo")).filter(F.size("todo") > 0).mapInArrow(_scan(rules), LEDGER).write.mode("append").parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger).filter(F.col("rule").isin(names))


def scan_versions(versions: DataFrame, ledger: str | None = None, text: str = "text", rules: tuple[Rule, ...] = RULES, names: tuple[str, str] = ("blob", "spans")) -> DataFrame:
    """`versions` with a column for the blob and one for its spans (by start, then in the order of the rules), other columns kept;
    the ledger outlives the call where its folder is given."""
    ledger = ledger or Scratch(versions.sparkSession, "ledger").path
    found = update_ledger(versions, ledger, text, rules).filter(F.size("spans") > 0).dropDuplicates(["blob", "rule"])
    order = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (rule_version(r), k)])
    kind = F.create_map(*[F.lit(x) for r in rules for x in (rule_version(r), r.kind)])
    each = found.withColumns({"order": order[F.col("rule")], "kind": kind[F.col("rule")]})
    each = each.select("blob", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("order").alias("order"), s["end"].alias("end"), F.col("kind").alias("kind"))).alias("spans"))
    sorted_ = F.transform(F.array_sort(F.flatten(F.collect_list("spans"))), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    lists = each.groupBy(F.col("blob").alias("_rf_found")).agg(sorted_.alias("_rf_list"))
    size = each.agg(F.coalesce(F.sum(120 + 40 * F.size("spans")), F.lit(0))).first()[0]
    kept = [F.col(f"`{c}`") for c in versions.columns if c not in names]
    rows = versions.select(*kept, blob_of(text).alias("_rf_own"))
    joined = rows.join(maybe_broadcast(lists, size, 1), F.col("_rf_own") == F.col("_rf_found"), "left")
    return joined.select(*kept, F.col("_rf_own").alias(names[0]), F.coalesce("_rf_list", F.array().cast(SPANS)).alias(names[1]))


def digest(scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, counts by kind, and the spans as text and as a hash."""
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in rules]
    return scanned.select("doc_id", *counts, F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"))


def redact(docs: DataFrame, mark: str = "[secret]", ledger: str | None = None) -> DataFrame:
    """docs with each span of `text` replaced by a mark (overlapping spans by one) and n_chars to match; no row goes."""

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        def one(text, own):
            out, at = [], 0
            for s in sorted(own, key=lambda s: (s["start"], s["end"])):
                if s["start"] >= at:
                    out += [text[at : s["start"]], mark]
                at = max(at, s["end"])
            return "".join(out) + text[at:]

        return pd.Series([one(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    names = docs.columns
    found = scan_versions(docs, ledger, names=("_rf_blob", "_rf_spans"))
    has = F.size("_rf_spans") > 0
    clean = found.filter(~has).select(*names)
    fixed = found.filter(has).withColumn("text", cut("text", "_rf_spans"))
    if "n_chars" in names:
        fixed = fixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.unionByName(fixed.select(*names))
