"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of a text is addressed by the SHA-256 of its content.  The
ledger keeps two Parquet tables in the shared folder:

* ``scans`` (blob, rule): blob and rule-version pairs that were scanned;
* ``findings`` (blob, rule, kind, start, end): spans in code points.

``scan`` reads only blobs with a rule version not yet in ``scans`` (each
distinct content once, however many paths or versions hold it), and
``per_row`` joins the findings back to every row that holds the blob.

Spans come from two regular-expression functions: the matches of a rule, and
the texts between them.  Their lengths, summed in order, are the offsets, so
no position is searched for and a text with many matches costs linear work.

Defined cases: null text is the empty text (no findings); rows with equal
texts share one scan; repeated rows and null ids each get their findings; an
empty table gives an empty result; other columns are carried untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abspark.llm.common import new_folder, staged


@dataclass(frozen=True)
class Rule:
    kind: str
    version: str
    pattern: str
    value_group: int = 0
    min_value: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns of the contract.  A run shorter than 16 (hex) or
# 18 (access) holds no longer match of its own, so that length is part of the
# pattern; an assignment with a short value uses up its text and is dropped after.
RULES = (
    Rule("assign", "1", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", "1", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", "1", r"[0-9a-f]{16,}"),
)
PLACEHOLDER = "[REDACTED]"
BLOCK = 1024


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _matches(text: Column, rule: Rule, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group))


class SecretLedger:
    def __init__(self, spark: SparkSession, path: str | None = None, rules: tuple[Rule, ...] = RULES, resume: bool = False):
        """``resume`` goes on with the ledger stored at ``path`` by an earlier session."""
        self.spark, self.path, self.rules = spark, path or new_folder(spark, "secret-ledger"), rules
        self.batches: list[int] = []
        if resume:
            self.batches = sorted(r.batch for r in spark.read.parquet(f"{self.path}/state").collect())  # a row per scan

    def scans(self) -> DataFrame:
        return self._all("scans", "blob string, rule string")

    def findings(self) -> DataFrame:
        return self._all("findings", 'blob string, rule string, kind string, start long, `end` long')

    def _all(self, name: str, schema: str) -> DataFrame:
        if not self.batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{name}/{n}" for n in self.batches])

    def scan(self, docs: DataFrame) -> None:
        """Scan the unseen (blob, rule version) pairs among the texts of ``docs`` and append them to the ledger."""
        names = [r.name for r in self.rules]
        versions = docs.select(F.coalesce("text", F.lit("")).alias("text"), blob_of(F.col("text")).alias("blob"))
        if self.batches:
            seen = self.scans().filter(F.col("rule").isin(names)).groupBy("blob").agg(F.collect_set("rule").alias("done"))
            whole = seen.filter(F.size("done") == len(names))
            blobs = versions.join(whole, "blob", "left_anti").groupBy("blob").agg(F.first("text").alias("text"))
            blobs = blobs.join(seen, "blob", "left").withColumn("done", F.coalesce("done", F.array().cast("array<string>")))
        else:
            # One text of each content; equal contents meet before the shuffle where a task holds several.
            blobs = versions.groupBy("blob").agg(F.first("text").alias("text")).withColumn("done", F.array().cast("array<string>"))
        n = len(self.batches)
        none = F.array().cast("array<string>")
        for i, r in enumerate(self.rules):
            blobs = blobs.withColumn(f"m{i}", F.when(F.array_contains("done", r.name), none).otherwise(_matches(F.col("text"), r)))
        parts = []
        for i, r in enumerate(self.rules):
            hit = F.size(f"m{i}") > 0
            gaps = F.when(hit, F.split("text", r.pattern, -1)).otherwise(none)
            values = F.when(hit, _matches(F.col("text"), r, r.value_group)).otherwise(none) if r.value_group else F.col(f"m{i}")
            lengths = lambda a: F.transform(a, lambda x: F.length(x))
            parts.append(F.struct(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), F.lit(r.min_value).alias("least"),
                                  lengths(F.col(f"m{i}")).alias("m"), lengths(gaps).alias("g"), lengths(values).alias("v")))
        found = blobs.select("blob", F.array_except(F.array(*map(F.lit, names)), "done").alias("rules"),
                             F.filter(F.array(*parts), lambda p: F.size(p["m"]) > 0).alias("parts"))
        found.write.mode("overwrite").parquet(f"{self.path}/matches/{n}")
        found = self.spark.read.schema(found.schema).parquet(f"{self.path}/matches/{n}")
        found.select("blob", F.explode("rules").alias("rule")).write.mode("overwrite").parquet(f"{self.path}/scans/{n}")
        one = found.select("blob", F.explode("parts").alias("p")).select(
            "blob", "p.rule", "p.kind", "p.least",
            F.posexplode(F.arrays_zip(F.col("p.m"), F.slice("p.g", F.lit(1), F.size("p.m")).alias("g"), F.col("p.v"))).alias("i", "x"))
        # A text's matches of one rule, in order: at most as many as the text has characters.
        upto = "sum(x.m + x.g) over (partition by blob, rule order by i rows unbounded preceding)"
        spans = one.select("blob", "rule", "kind", "least", "x.m", "x.v", F.expr(upto).alias("end"))
        spans.filter("v >= least").select("blob", "rule", "kind", F.expr("cast(`end` - m as long)").alias("start"), F.col("end").cast("long")).write.mode("overwrite").parquet(f"{self.path}/findings/{n}")
        # Written last: it makes the scan part of the ledger; one that broke off is written over by the next.
        self.spark.range(1).selectExpr(f"{n} as batch").write.mode("append").parquet(f"{self.path}/state")
        self.batches.append(n)

    def summary(self) -> DataFrame:
        """Per blob with findings of this ledger's rules: counts by kind and the ordered span list."""
        order = F.coalesce(*[F.when(F.col("kind") == r.kind, F.lit(i)) for i, r in enumerate(self.rules)])
        rows = self.findings().filter(F.col("rule").isin([r.name for r in self.rules]))
        spans = F.sort_array(F.collect_list(F.struct("start", order.alias("o"), "end", "kind")))
        text = F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
        counts = [F.count_if(F.col("kind") == r.kind).alias(f"n_{r.kind}") for r in self.rules]
        return rows.groupBy("blob").agg(*counts, text.alias("spans"))

    def cuts(self) -> DataFrame:
        """(blob, cuts): the union of the findings of this ledger's rules, as disjoint (start, end) in order."""
        rows = self.findings().filter(F.col("rule").isin([r.name for r in self.rules]))
        # At most as many rows a content as it has characters; findings that touch are one range.
        before = F.expr("max(`end`) over (partition by blob order by start, `end` rows between unbounded preceding and 1 preceding)")
        rows = rows.select("blob", "start", "end", (F.col("start") > F.coalesce(before, F.lit(-1))).cast("long").alias("opens"))
        rows = rows.withColumn("range", F.expr("sum(opens) over (partition by blob order by start, `end` rows unbounded preceding)"))
        ranges = rows.groupBy("blob", "range").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        return ranges.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))

    def _found(self, rows: DataFrame, blob: str, found: DataFrame) -> DataFrame:
        # Written first, and merged at any size: copies of one content in many rows can be split over tasks.
        found = staged(found, "secret-found").withColumnRenamed("blob", "__found").hint("merge")
        return rows.join(found, F.col(blob) == F.col("__found"), "left").drop("__found")

    def joined(self, rows: DataFrame, blob: str) -> DataFrame:
        """``rows`` with columns n_<kind>... and spans of the content whose address is in column ``blob``."""
        rows = self._found(rows, blob, self.summary())
        counts = {f"n_{r.kind}": F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long") for r in self.rules}
        return rows.withColumns(counts | {"spans": F.coalesce("spans", F.lit(""))})

    def per_row(self, docs: DataFrame) -> DataFrame:
        """Columns (row, n_<kind>..., spans) for every row of ``docs``; rows without findings have zeros and ''."""
        return self.joined(self._rows(docs), "__blob").drop("__blob")

    def redacted(self, docs: DataFrame) -> DataFrame:
        """Columns (row, redacted) for every row of ``docs``: its text with every finding replaced, null if it has none."""
        rows = self._found(self._rows(docs), "__blob", self.cuts())
        return rows.select("row", F.when(F.col("cuts").isNotNull(), redact(F.col("row.text"), F.col("cuts"))).alias("redacted"))

    def _rows(self, docs: DataFrame) -> DataFrame:
        return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), blob_of(docs["text"]).alias("__blob"))


def redact(text: Column, cuts: Column, placeholder: str = PLACEHOLDER) -> Column:
    """``text`` with every range of ``cuts`` replaced: disjoint (start, end) in code points, in order.

    The text is cut into blocks of ``BLOCK`` code points first, so that a range
    costs its own length and a block, wherever in the text it lies.
    """
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda c: c["end"]))
    ends = F.concat(F.transform(cuts, lambda c: c["start"]), F.array(F.char_length(text).cast("long")))

    def between(blocks: Column, gap: Column) -> Column:
        a, b = gap["begins"], gap["ends"]
        first, last = F.floor(a / BLOCK).cast("int"), F.floor((b - 1) / BLOCK).cast("int")
        at = (a - first * BLOCK).cast("int")
        part = lambda i, start, n: F.substring(F.get(blocks, i), start, n)
        inner = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        many = F.concat(part(first, at + 1, F.lit(BLOCK)), inner, part(last, F.lit(1), (b - last * BLOCK).cast("int")))
        return F.when(a >= b, F.lit("")).when(first == last, part(first, at + 1, (b - a).cast("int"))).otherwise(many)

    # As the one element of an array the blocks are a lambda's variable: made once, whatever the plan does with columns.
    gaps = F.arrays_zip(begins.alias("begins"), ends.alias("ends"))
    pieces = F.transform(F.array(F.struct(blocks.alias("blocks"), gaps.alias("gaps"))), lambda x: F.transform(x["gaps"], lambda g: between(x["blocks"], g)))
    return F.array_join(F.get(pieces, F.lit(0)), placeholder)


def op9_secret_ledger(docs: DataFrame) -> DataFrame:
    ledger = SecretLedger(docs.sparkSession)
    ledger.scan(docs.select("text"))
    # The versions' rows carry only their content address from here on.
    out = ledger.joined(docs.select("doc_id", blob_of(F.col("text")).alias("__blob")), "__blob")
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("spans", 256).alias("base_sha256"), "spans")
