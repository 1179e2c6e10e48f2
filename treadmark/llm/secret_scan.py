"""Secret scans over a ledger of content-addressed blobs.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from treadmark.llm.common import only, table, text_of
from treadmark.session import drop_path, staged_path

#: Marks around a match.  Texts that hold them get another control character in their place, which no rule matches.
OPEN, CLOSE, OTHER = "\x01", "\x02", "\x03"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: what matches ``pattern``, leftmost and without overlap, and then passes ``least``.

    ``group`` is what must be at least ``least`` characters long (0: the whole match).  A change of a rule needs another
    ``version``: the ledger then scans every blob for it again.  ``quick``, if given, is a pattern that every text with a
    passing match holds; texts without it are not taken apart.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    version: int = 1
    quick: str = ""


#: The base kinds, in the order of their listing, then those that this scan adds.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20, quick=r"AKIA[A-Z0-9]{16}"),
    Rule("hex", r"[0-9a-f]+", 24, quick=r"[0-9a-f]{24}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("login", r"[a-z]+://[^\x20\x09-\x0D/:@\x01-\x03]+:[^\x20\x09-\x0D/:@\x01-\x03]+@"),
)
BASE = ("assign", "access", "hex")

_LEDGER = "blob string, kind string, version int"
_FINDINGS = "blob string, kind string, version int, start int, end int"


def _found(blobs: DataFrame, rule: Rule) -> DataFrame:
    """blob, start and end (code points, end exclusive) of the rule's spans.

    The matches are marked in the text, the text is cut at the marks, and the lengths of the cuts before a match add up
    to its place.  Only blobs with a match are taken apart.
    """
    held = blobs.filter(F.col("text").rlike(rule.quick or rule.pattern))
    marked = F.regexp_replace("text", f"({rule.pattern})", f"{OPEN}$1{CLOSE}")
    cuts = held.select("blob", F.posexplode(F.split(marked, f"[{OPEN}{CLOSE}]")).alias("at", "cut"))
    whole = F.regexp_extract("cut", rule.pattern, rule.group)
    sized = cuts.select(
        "blob", "at", F.length("cut").alias("n"),
        ((F.col("at") % 2 == 1) & (F.length(whole) >= rule.least)).alias("hit"),
    )
    end = F.sum("n").over(W.partitionBy("blob").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)).cast("int")
    return sized.withColumn("end", end).filter("hit").select(
        "blob", F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), (F.col("end") - F.col("n")).alias("start"), "end"
    )


class Ledger:
    """Which blobs were scanned for which rule versions, and what was found, in a shared folder.

    Without a path of its own it lasts as long as the program.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or staged_path(spark, "blob-ledger")

    def _read(self, name: str, schema: str) -> DataFrame:
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(fs_path)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if there else self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        return self._read("scanned", _LEDGER)

    def findings(self) -> DataFrame:
        return self._read("findings", _FINDINGS)

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
        """Scan what of ``versions`` (one row for each text of any path at any time) the ledger has not seen.

        A blob is addressed by the SHA-256 of its bytes; of all its copies one is scanned, and only for the rules
        that the ledger lacks for it.  Findings are written before the ledger's entry: a run that breaks off in between
        is scanned again, and the same spans found twice are read once.
        """
        body = F.translate(text_of(text), OPEN + CLOSE, OTHER + OTHER)
        rows = only(versions, text).select(F.sha2(text_of(text).cast("binary"), 256).alias("blob"), body.alias("text"))
        pairs = self.spark.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int")
        seen = self.scanned().join(F.broadcast(pairs), ["kind", "version"]).groupBy("blob").agg(F.collect_set("kind").alias("done"))
        # Copies are combined before they move, and the ledger meets the blobs where they then are: texts move once.
        ones = rows.groupBy("blob").agg(F.first("text").alias("text"))
        unseen = ones.join(seen, "blob", "left").filter(F.coalesce(F.size("done"), F.lit(0)) < len(rules))
        blobs = staged_path(self.spark, "unseen")
        try:
            unseen.write.parquet(blobs)
            stored = self.spark.read.schema(unseen.schema).parquet(blobs)
            todo = F.coalesce(F.col("done"), F.array().cast("array<string>"))
            found = None
            for rule in rules:
                own = _found(stored.filter(~F.array_contains(todo, rule.kind)), rule)
                found = own if found is None else found.unionByName(own)
            found.write.mode("append").parquet(f"{self.path}/findings")
            names = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
            new = stored.select("blob", F.explode(F.filter(names, lambda r: ~F.array_contains(todo, r["kind"]))).alias("r"))
            new.select("blob", "r.kind", "r.version").write.mode("append").parquet(f"{self.path}/scanned")
        finally:
            drop_path(self.spark, blobs)  # the texts in the clear

    def by_blob(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """blob and spans: an array of (start, place of the kind in ``rules``, kind, end), sorted."""
        places = self.spark.createDataFrame([(r.kind, r.version, i) for i, r in enumerate(rules)], "kind string, version int, place int")
        own = self.findings().join(F.broadcast(places), ["kind", "version"])
        return own.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("start", "place", "kind", "end"))).alias("spans"))


def secrets(versions: DataFrame, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text", to: str = "spans") -> DataFrame:
    """The rows of ``versions`` with column ``to``, the secrets of their texts: (start, place, kind, end), sorted.

    The texts are scanned into ``ledger`` (a new one if there is none) and the findings of a blob are joined back to all
    rows that hold it.  A null text is an empty one; it has no spans.  Repeated rows share their blob and get the
    same spans each; an empty table gives no rows.  A column of the input with the name ``to`` is replaced.
    """
    ledger = ledger or Ledger(versions.sparkSession)
    ledger.scan(versions, rules, text)
    found = ledger.by_blob(rules)
    # The row travels as one value, so no column of it meets a name of ours.
    kept = [c for c in versions.columns if c != to]
    rows = versions.select(F.struct(*kept).alias("row"), F.sha2(text_of(text).cast("binary"), 256).alias("blob")).join(found, "blob", "left")
    none = F.array().cast(dict(found.dtypes)["spans"])
    return rows.select("row.*", F.coalesce("spans", none).alias(to))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with its spans replaced; spans that overlap or touch become one mark."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        one = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(acc) == 0) | (s["start"] > F.element_at(acc, F.when(F.size(acc) > 0, -1).otherwise(1))["end"]), F.concat(acc, F.array(one))).otherwise(
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(longer))
        )

    ends = F.aggregate(spans, empty, merge)
    # what stands before each span, and after the last
    starts = F.concat(F.array(F.lit(0)), F.transform(ends, lambda s: s["end"]))
    stops = F.concat(F.transform(ends, lambda s: s["start"]), F.array(F.length(text)))
    parts = F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda p: F.substring(text, p["a"] + 1, p["b"] - p["a"]))
    return F.when(F.size(spans) > 0, F.array_join(parts, mark)).otherwise(text)


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    found = secrets(only(table(spark, folder, "documents"), "doc_id", "text"))
    return found.select("doc_id", *map(count, BASE), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(spans).alias("spans"))
