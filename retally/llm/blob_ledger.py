"""Secret scanning over an incremental ledger of blobs.

A blob is a text, told by its digest; a path (a document, or a historical version of one) points to a blob.
The ledger keeps, per blob, which versions of which rules have seen it and what they found.  A scan takes
the paths' distinct blobs, leaves out every pair of blob and rule version that the ledger already has, scans the
rest once and adds one batch to the ledger; findings are joined back to all paths of a blob.  A new rule or a
new version of one scans old blobs for that rule only.

DataFrame functions throughout.  A span is (kind, start, end) in code points, end exclusive.  Matches are leftmost
and do not overlap within a kind: the text between them comes from ``split``, their own length from
``regexp_extract_all``, so positions are running sums.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retally.llm.common import kept, unused, workspace


@dataclass(frozen=True)
class Rule:
    """``least``: code points that group ``group`` of a match must have."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


_KEY = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
                for word in ("password", "passwd", "secret", "token", "api_?key"))

#: Forms of the base rules and of well-known credentials.
BASE = (
    Rule("assign", 1, rf"""({_KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, "AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, "[0-9a-f]{32,}"),
)
MORE = (
    Rule("pem", 1, "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("github", 1, "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", 1, "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", 1, "AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE + MORE
SPAN = "struct<start:long,place:int,end:long,kind:string>"


def spans_of(text: Column, rule: Rule, place: int) -> Column:
    """Spans of one rule in a text; null text has none."""
    pattern = F.lit(rule.pattern)
    matches, between = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, rule.pattern, -1)
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit(None).cast(f"array<{SPAN}>").alias("found"))

    def step(acc: Column, one: Column) -> Column:
        start = acc["at"] + F.char_length(one["0"])
        end = start + F.char_length(one["1"])
        span = F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        good = F.char_length(one["2"]) >= rule.least
        nothing = F.array().cast(f"array<{SPAN}>")
        return F.struct(end.alias("at"), F.concat(F.coalesce(acc["found"], nothing),
                                                  F.when(good, F.array(span)).otherwise(nothing)).alias("found"))

    rows = F.arrays_zip(F.slice(between, 1, F.size(matches)).alias("0"), matches.alias("1"), checked.alias("2"))
    found = F.aggregate(rows, state, step)["found"]
    return F.coalesce(F.when(F.regexp_like(text, pattern), found), F.array().cast(f"array<{SPAN}>"))


class Ledger:
    """Batches of scanned blobs ``(blob, rules, spans)`` under one folder."""

    def __init__(self, spark: SparkSession, path: str, new: bool = True):
        self.spark, self.path = spark, path
        if new:
            spark.createDataFrame([], f"blob binary, rules array<string>, spans array<{SPAN}>").write.parquet(f"{path}/batch=0")
            self._last = 0
        else:
            self._last = spark.read.parquet(path).agg(F.max("batch")).first()[0] or 0

    def rows(self) -> DataFrame:
        return self.spark.read.schema(f"blob binary, rules array<string>, spans array<{SPAN}>, batch int").parquet(self.path)

    def scan(self, versions: DataFrame, rules: Sequence[Rule] = RULES) -> None:
        """Scan ``versions(path, text)`` where a blob and a rule version have not met; one more batch."""
        names = F.array(*[F.lit(r.name) for r in rules])
        keyed = versions.select("path", blob_of("text").alias("blob"), "text")
        seen = self.rows().select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(
            F.collect_set("rule").alias("seen"))
        # one path stands for a blob; only its text is scanned.  What a scan that failed had asked for is left behind
        asked = keyed.groupBy("blob").agg(F.min("path").alias("path")).join(seen, "blob", "left").select(
            "blob", "path", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))).alias("rules"))
        asked = kept(asked.where("size(rules) > 0"), f"{self.path}-asked/{self._last + 1}-{uuid.uuid4().hex}")
        work = keyed.join(asked.hint("shuffle_hash"), (keyed.path.eqNullSafe(asked.path)) & (keyed.blob == asked.blob)).select(
            asked.blob, "rules", "text")
        parts = [F.when(F.array_contains("rules", r.name), spans_of(F.col("text"), r, i)).otherwise(
            F.array().cast(f"array<{SPAN}>")) for i, r in enumerate(rules)]
        done = work.select("blob", "rules", F.concat(*parts).alias("spans"))
        done.write.mode("overwrite").parquet(f"{self.path}/batch={self._last + 1}")
        self._last += 1

    def findings(self) -> DataFrame:
        """``(blob, spans)`` of blobs with findings, in order of start, then of kind."""
        one = self.rows().where("size(spans) > 0").select("blob", F.explode("spans").alias("span")).distinct()
        return one.groupBy("blob").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def blob_of(text: str) -> Column:
    """Address of a text; null is the empty text."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def found_secrets(docs: DataFrame, spans: str = "_spans", ledger: Ledger | None = None) -> DataFrame:
    """Every row of ``docs(doc_id, text, ...)`` with its findings in the new column ``spans``.

    The empty and the null text have no spans.  Repeated rows, null ids and copies get the findings of
    their blob; an empty table gives no rows.  Other columns pass through, whatever their names.
    """
    ledger = ledger or Ledger(docs.sparkSession, workspace(docs.sparkSession, "ledger"))
    ledger.scan(docs.select(F.col("doc_id").alias("path"), "text"))
    (blob,) = unused(docs, "_blob")
    found = ledger.findings().select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    return docs.withColumn(blob, blob_of("text")).join(found, blob, "left").withColumn(
        spans, F.coalesce(spans, F.array().cast(f"array<{SPAN}>"))).drop(blob)


def digests(docs: DataFrame, batches: int = 2) -> DataFrame:
    """Counts and digests of the findings per document.

    The documents come as ``batches`` versions of the corpus, dealt by a hash of the id: a later one scans only the blobs that
    no earlier one had.  Null texts are empty, null ids and repeated rows are rows; an empty table gives no rows.
    """
    ledger = Ledger(docs.sparkSession, workspace(docs.sparkSession, "ledger"))
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for number in range(batches):
        ledger.scan(docs.where(batch == number).select(F.col("doc_id").alias("path"), "text"))
    # only ids and addresses travel to the findings
    told = docs.select("doc_id", blob_of("text").alias("blob")).join(ledger.findings(), "blob", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))
    kinds = [r.kind for r in BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return told.select("doc_id", *[_count(k).alias(f"n_{k}") for k in kinds], F.sha2(joined(base), 256).alias("base_sha256"),
                       joined(F.col("spans")).alias("spans"))


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with every secret in ``text`` replaced by a mark, and ``n_chars`` to match."""
    (spans,) = unused(docs, "_spans")
    found = found_secrets(docs, spans)
    clean = redacted(F.col("text"), F.col(spans))
    new = {"text": clean}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.size(spans) == 0, F.col("n_chars")).otherwise(F.char_length(clean).cast(kind))
    return found.withColumns(new).select(*docs.columns)


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span (spans may overlap) replaced by a mark."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        apart = s["start"] >= acc["at"]
        return F.struct(F.when(apart, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"),
                        F.greatest(acc["at"], s["end"]).alias("at"))

    done = F.aggregate(spans, state, step)
    return F.when(F.size(spans) == 0, text).otherwise(
        F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.char_length(text))))
