"""Secret scans with an incremental ledger of blobs.

Every version of a text is a blob, whose address is the SHA-256 of its bytes. The ledger, a table that outlives the
session, holds which blobs were scanned under which version of the rules, and what was found. A scan first joins
addresses only, for the pairs of blob and rule version that the ledger lacks; a filter of these then says in each task
which texts to scan where they are, so no text leaves its task. Findings are joined back to every path (row) of a blob.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuesheet.scratch import scratch_root

from .common import KeyFilter, join_unique, key_filter, materialise, may_hold, slices, texts

#: Changes whenever RULES or their checks do.
RULES_VERSION = "2"

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Strings of which an ASSIGN match has one, in lower case.
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: What the scan finds besides the base kinds: strings of which one must be there, and the pattern.
FURTHER = {
    "private_key": (("-----BEGIN",), re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?:(?:[^-]|-(?!----BEGIN ))*?-----END (?:[A-Z]+ )*PRIVATE KEY-----)?")),
    "web_token": (("eyJ",), re.compile(r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")),
    "prefixed": (("_", "glpat-"), re.compile(r"\b(?:(?:gh[pousr]|sk_live|rk_live)_[A-Za-z0-9]{20,}|glpat-[A-Za-z0-9_-]{20,})")),
}
BASE = ("assign", "access", "hex")
KINDS = (*BASE, *FURTHER)

_HEX_BYTES = bytes(120 if chr(x) in "0123456789abcdef" else 32 for x in range(256))

Span = tuple[int, int, int]


def find_spans(text: str) -> list[Span]:
    """start, place of the kind in KINDS, end of each finding, in this order; code points, end exclusive."""
    data = text.encode()
    out: list[Span] = []
    low = data.lower()
    if any(x in low for x in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in data:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if b"x" * 32 in data.translate(_HEX_BYTES):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for k, (signs, rule) in enumerate(FURTHER.values(), len(BASE)):
        if any(x in text for x in signs):
            out += [(m.start(), k, m.end()) for m in rule.finditer(text)]
    return sorted(out)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


LEDGER = "blob string, rules string, n_assign long, n_access long, n_hex long, base string, spans string"


def _blob(text: str = "text") -> F.Column:
    """A text's address; null has the empty text's."""
    return F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)


class Ledger:
    """What was found in each blob under each version of the rules: a Parquet table at path, which may exist already.

    Without a path it is a new table in the shared folder. A scan appends to it once, when all of its blobs are done.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or f"{scratch_root(spark)}/cuesheet/ledger-{uuid.uuid4().hex}"
        place = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            # Not from a Python list, even an empty one: that would start Python workers of a second kind, which stay.
            columns = [x.split() for x in LEDGER.split(", ")]
            spark.range(0).select(*(F.lit(None).cast(kind).alias(name) for name, kind in columns)).write.parquet(self.path)

    @property
    def findings(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def unseen(self, blobs: DataFrame, rules: str = RULES_VERSION) -> DataFrame:
        """The rows of blobs (blob, ...) that were not scanned under these rules."""
        return blobs.join(self.findings.filter(F.col("rules") == rules).select("blob"), "blob", "left_anti")

    def scan(self, docs: DataFrame, rules: str = RULES_VERSION) -> DataFrame:
        """Scans the blobs of docs (doc_id, text) that are unseen and adds them; returns doc_id, blob of every row."""
        addressed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _blob().alias("blob"))
        paths = materialise(addressed.select("doc_id", "blob"), compact=True)
        # One path for each unseen blob.
        wanted = materialise(self.unseen(paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id")), rules).withColumn("pair", F.xxhash64("doc_id", "blob")))
        made = key_filter(wanted, "pair")
        asked = self.spark.sparkContext.broadcast((made.words, made.places))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filtered = KeyFilter(*asked.value)
            for batch in slices(batches):
                batch = batch.filter(pa.array(filtered.may_hold(batch.column("pair").to_numpy(zero_copy_only=False))))
                found = [find_spans(x) for x in texts(batch.column("text"))]
                count = [[sum(kind == k for _, kind, _ in x) for x in found] for k in range(3)]
                base = [written([y for y in x if y[1] < len(BASE)]) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("blob"), pa.array([rules] * len(found), pa.string()), *(pa.array(x, pa.int64()) for x in count), pa.array(base, pa.string()), pa.array([written(x) for x in found], pa.string())],
                    ["blob", "rules", "n_assign", "n_access", "n_hex", "base", "spans"],
                )

        found = addressed.select("blob", F.xxhash64("doc_id", "blob").alias("pair"), "text").mapInArrow(scan, LEDGER)
        # What the filter let through by chance, or rows of one identifier and text scanned more than once, go.
        new = materialise(found.dropDuplicates(["blob"]).join(wanted.select("blob"), "blob", "left_semi"))
        new.write.mode("append").parquet(self.path)
        return paths

    def of(self, paths: DataFrame, rules: str = RULES_VERSION) -> DataFrame:
        """The findings of each row of paths (doc_id, blob)."""
        sizes = paths.groupBy("blob").agg(F.count("*").alias("n"))
        own = materialise(self.findings.filter(F.col("rules") == rules).drop("rules").join(sizes, "blob"))
        return join_unique(paths, own, "blob", paths.count(), width="spans")


def scan_secrets(docs: DataFrame, ledger: Ledger | None = None) -> DataFrame:
    """The findings in every row of docs (doc_id, text): doc_id, blob, n_assign, n_access, n_hex, base, spans.

    base and spans list kind:start:end by start, then kind in the order of KINDS, joined by commas. Null counts as the
    empty text, without findings. Rows that repeat a doc_id, a text or both, or have no doc_id, get a row each. Texts of
    any length are scanned whole. An empty table gives no rows. Other columns of docs are not read, whatever their names.
    """
    ledger = ledger or Ledger(docs.sparkSession)
    return ledger.of(ledger.scan(docs))


def redact(text: str, spans: str, mask: str = "<SECRET>") -> str:
    """text with the union of its spans replaced."""
    out, at = [], 0
    for start, end in sorted(tuple(map(int, x.split(":")[1:])) for x in spans.split(",") if x):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mask]
        at = end
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, ledger: Ledger | None = None) -> DataFrame:
    """docs with each secret in its text replaced by a mark, and n_chars, if there is such a column, counted anew.

    A row is joined to its findings by its blob's address, so rows without an identifier and repeated rows are covered
    too. Texts without findings, null and empty ones included, stay as they are and where they are: only rows that may
    have findings are moved. Columns keep their order, whatever their names. An empty table stays empty.
    """
    spark = docs.sparkSession
    ledger = ledger or Ledger(spark)
    paths = ledger.scan(docs)
    hits = ledger.findings.filter((F.col("rules") == RULES_VERSION) & (F.col("spans") != "")).select("blob", "spans")
    sizes = paths.groupBy("blob").agg(F.count("*").alias("n"))
    found = materialise(hits.join(sizes, "blob"))
    hit = may_hold(key_filter(found.select(F.xxhash64("blob").alias("key"))), spark)

    @F.pandas_udf("string")
    def masked(text, spans):
        return text.combine(spans, lambda a, b: None if a is None else redact(a, b))

    keyed = docs.select(F.struct(*[docs[x] for x in docs.columns]).alias("row"), _blob().alias("blob")).withColumn("may", hit(F.xxhash64("blob")))
    # Dealt out anew: texts are masked in other tasks than those that ask the filter, so a task has one Python worker.
    passed = keyed.filter("may").select("blob", "row").hint("rebalance")
    met = join_unique(passed, found, "blob", paths.count(), "left", width="spans")
    dirty = F.col("spans").isNotNull()
    met = met.withColumn("masked", masked(F.when(dirty, F.col("row.text").cast("string")), F.col("spans")))
    changed = {"text": F.col("masked").cast(docs.schema["text"].dataType)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("masked").cast(docs.schema["n_chars"].dataType)
    met = met.select(*(F.when(dirty, changed[x]).otherwise(F.col("row")[x]).alias(x) if x in changed else F.col("row")[x].alias(x) for x in docs.columns))
    return keyed.filter("not may").select("row.*").unionByName(met)
