"""Secret scans over a content-addressed ledger: each blob meets each rule version once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MASK = "[SECRET]"


@dataclass(frozen=True)
class SecretRule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has enough characters.

    Raise ``version`` with every change of the pattern: all blobs are then unseen again for
    this rule, and only for this one.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    @property
    def plain(self) -> str:
        """The pattern for engines that never backtrack and know no possessive repeats."""
        return self.pattern.replace("*+", "*")


# Java runs the patterns and RE2 (without the possessive marks) checks them, so there is no
# look-behind. Repeated groups are possessive: Java then loops over them, whatever their number,
# instead of using its stack. None of them ever has to give a repetition back.
KIND_OF_KEY = r"(?:[A-Z0-9]{1,16} ){0,4}PRIVATE KEY(?: BLOCK)?-----"
# Between lines of a key: white space, line ends written as escapes, quotes of string constants.
BLANK = r"""[ \t\r\n"',>]"""
BETWEEN = rf"(?:{BLANK}|\\[nr]){BLANK}*(?:\\[nr]{BLANK}*)?(?:\\[nr]{BLANK}*)?"
# At least 16 characters.
KEY_LINE = "[A-Za-z0-9+/]" * 16 + "[A-Za-z0-9+/]*=?=?"
# Up to an END line nothing but a run of five hyphens ends a key.
PRIVATE_KEY = (
    rf"-----BEGIN {KIND_OF_KEY}(?:"
    rf"[^-]*+(?:-{{1,4}}[^-]+)*+-----END {KIND_OF_KEY}"
    rf"|(?:{BETWEEN}(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):[^\r\n\\]*)*+"
    rf"(?:{BETWEEN}{KEY_LINE})*+"
    rf"(?:{BETWEEN}(?:[A-Za-z0-9+/]+={{1,2}}|=?[A-Za-z0-9+/]{{1,75}}(?:\r?\n|\z)))?)"
)
# A first part that no other parts follow is matched as well, with an empty group, and does
# not count: the search goes on behind it and so stays linear.
WEB_TOKEN = r"eyJ[A-Za-z0-9_-]{8,}(\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})?"

# Kinds, patterns and least lengths, in the order in which ties are listed.
RULES = (
    SecretRule(
        "assign",
        1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    SecretRule("access", 1, r"AKIA[A-Z0-9]+", least=20),
    SecretRule("hex", 1, r"[0-9a-f]{24,}", least=24),
    # The whole key: header lines, lines of base64 (line ends may be escaped, quoted or indented)
    # and the END line. A body without an END line ends with its last line of base64.
    SecretRule("private_key", 4, PRIVATE_KEY),
    SecretRule("git_token", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("chat_token", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("web_token", 3, WEB_TOKEN, group=1, least=18),
)
BASE_KINDS = ("assign", "access", "hex")

FINDINGS = "blob string, kind string, version int, start long, end long"
LEDGER = "blob string, rule string"


def blob_id(text: Column) -> Column:
    """Content address of a text; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A ledger table; an empty one is made before its first use."""
    columns = [f"cast(null as {kind}) as {name}" for name, kind in (c.split() for c in schema.split(", "))]
    spark.range(0).selectExpr(*columns).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _pieces(rule: SecretRule) -> Column:
    """Per match: length of the text before it, of the match, and of the tested group.

    Null where the rule was already applied to the blob or finds nothing.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all("text", pattern, F.lit(0))
    tested = F.regexp_extract_all("text", pattern, F.lit(rule.group))
    zipped = F.arrays_zip(
        F.transform(F.split("text", rule.pattern, -1), F.length).alias("before"),
        F.transform(matches, F.length).alias("long"),
        F.transform(tested, F.length).alias("tested"),
    )
    unseen = F.array_contains("unseen", rule.key) & F.col("text").rlike(rule.pattern)
    return F.when(unseen, F.filter(zipped, lambda x: x["long"].isNotNull()))


def find_spans(blobs: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
    """FINDINGS of ``blobs`` (blob, text, unseen rule keys). Positions count code points.

    A match starts where the texts and matches before it end: a running sum over the
    matches of one blob and rule.
    """
    per_rule = [
        F.struct(
            F.lit(r.kind).alias("kind"),
            F.lit(r.version).alias("version"),
            F.lit(r.least).alias("least"),
            _pieces(r).alias("pieces"),
        )
        for r in rules
    ]
    by_rule = blobs.select("blob", F.inline(F.array(*per_rule))).where("pieces is not null")
    matched = by_rule.select("blob", "kind", "version", "least", F.posexplode("pieces").alias("at", "m"))
    in_order = W.partitionBy("blob", "kind").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("m.before") + F.col("m.long")).over(in_order).cast("long")
    placed = matched.select("blob", "kind", "version", "least", "m", end.alias("end"))
    return placed.where("m.tested >= least").select(
        "blob", "kind", "version", (F.col("end") - F.col("m.long")).cast("long").alias("start"), "end"
    )


def scan_new(documents: DataFrame, ledger: str, rules: Sequence[SecretRule] = RULES) -> None:
    """Scan the unseen pairs of blob and rule version and add them to the tables at ``ledger``.

    Findings are written before the pairs are marked as seen: a run that breaks off in
    between scans those pairs again and repeats findings, which reading removes.
    """
    spark = documents.sparkSession
    named = documents.select(blob_id(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    seen = _stored(spark, f"{ledger}/seen", LEDGER).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    wanted = F.array(*[F.lit(r.key) for r in rules])
    unseen = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("unseen")
    distinct = named.groupBy("blob").agg(F.first("text").alias("text"))
    todo = distinct.join(seen.hint("merge"), "blob", "left").select("blob", "text", unseen).where(F.size("unseen") > 0)
    find_spans(todo, rules).write.mode("append").parquet(f"{ledger}/findings")
    ids = named.select("blob").distinct().join(seen, "blob", "left").select("blob", F.explode(unseen).alias("rule"))
    ids.write.mode("append").parquet(f"{ledger}/seen")


def findings(spark: SparkSession, ledger: str, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """All stored findings of these rule versions, with the rule's place in the list."""
    stored = _stored(spark, f"{ledger}/findings", FINDINGS)
    place = F.lit(None).cast("int")
    for i, rule in enumerate(rules):
        place = F.when((F.col("kind") == rule.kind) & (F.col("version") == rule.version), i).otherwise(place)
    return stored.withColumn("place", place).where("place is not null").distinct()


def scan(documents: DataFrame, ledger: str, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """One row per document row: doc_id, blob, spans sorted by start, then rule order.

    ``ledger`` is a folder that is kept between runs; a text seen in any earlier run or
    under any other document is not scanned again, yet its findings reach every document
    that has it. Null and empty texts share one blob without findings, repeated rows and
    null ids stay as they are, other columns are not read, an empty table gives an empty
    result. Texts are scanned whole. Columns: spans array of (kind, start, end), end
    exclusive, in code points.
    """
    spark = documents.sparkSession
    scan_new(documents, ledger, rules)
    span = F.struct("start", "place", "end", "kind")
    by_blob = findings(spark, ledger, rules).groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("found"))
    paths = documents.select("doc_id", blob_id(F.col("text")).alias("blob"))
    spans = F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    none = F.array().cast("array<struct<kind:string,start:long,end:long>>")
    return paths.join(by_blob, "blob", "left").select("doc_id", "blob", F.coalesce(spans, none).alias("spans"))


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def spans_text(spans: Column, kinds: Sequence[str] | None = None) -> Column:
    """kind:start:end, comma-joined; only of some kinds if given."""
    kept = of_kinds(spans, kinds) if kinds else spans
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(documents: DataFrame, ledger: str, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """The documents with every finding masked; overlapping findings become one mask.

    Texts without findings stay as they are, null too; n_chars follows the text if there is
    such a column; all other columns are kept.
    """
    spark = documents.sparkSession
    scan_new(documents, ledger, rules)
    by_start = W.partitionBy("blob").orderBy("start", "end")
    reach = F.max("end").over(by_start.rowsBetween(W.unboundedPreceding, -1))
    opened = findings(spark, ledger, rules).withColumn("_reach", reach).where("_reach is null or start > _reach")
    # The text from one mask to the next starts where the findings before it reach to.
    last = findings(spark, ledger, rules).groupBy("blob").agg(F.max("end").alias("_last"))
    part = F.struct(F.coalesce("_reach", F.lit(0).cast("long")).alias("from"), F.col("start").alias("to"))
    parts = opened.groupBy("blob").agg(F.array_sort(F.collect_list(part)).alias("_parts")).join(last, "blob")
    joined = documents.withColumn("_blob", blob_id(F.col("text"))).join(
        parts.withColumnRenamed("blob", "_blob").hint("merge"), "_blob", "left"
    )
    between = F.transform(
        "_parts", lambda p: F.substring(F.col("text"), (p["from"] + 1).cast("int"), (p["to"] - p["from"]).cast("int"))
    )
    tail = F.substring(F.col("text"), (F.col("_last") + 1).cast("int"), F.length("text"))
    masked = F.when(F.col("_parts").isNotNull(), F.concat(F.array_join(between, MASK), F.lit(MASK), tail))
    text = F.coalesce(masked, F.col("text"))
    changed = {"text": text, "n_chars": F.when(F.col("_parts").isNotNull(), F.length(text).cast("long"))}
    return joined.select(
        *[
            (F.coalesce(changed[c], F.col(c)) if c == "n_chars" else changed[c]).alias(c) if c in changed else F.col(c)
            for c in documents.columns
        ]
    )
