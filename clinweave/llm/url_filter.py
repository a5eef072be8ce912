"""Allow and block rules on urls, and a block list as a sorted digest array.

The list's entries (host, or host with the beginning of a path) are kept as ascending 64-bit xxhash keys beside their
full strings. The array is one file that Spark hands to every executor; tasks memory-map it, probe all candidate keys of
a batch with a vectorised binary search, and confirm each hit on the stored string, so a colliding digest blocks nothing.
"""

from __future__ import annotations

import os
import struct
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinweave.llm.shared import shared_folder
from clinweave.session import ship_package

#: Bytes of listed strings that one array may hold; a longer list is joined by key instead.
ARRAY_BYTES = 256_000_000

#: Families of hosts that the packaged list blocks, with all their subdomains.
BLOCKED_FAMILIES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
BLOCKED_HOSTS = tuple(f"{name}.example.{top}" for name in BLOCKED_FAMILIES for top in ("com", "net", "org"))


def _after_scheme(url) -> F.Column:
    """What follows the first `://`; empty for null and where there is none."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def host_of(url) -> F.Column:
    """Between the first `://` and the next `/`, `?`, `#` or end, A-Z lower-cased. Empty for null and without `://`."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url) -> F.Column:
    """What follows the host up to `?`, `#` or end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def rule_of(host, path, rules: Sequence[tuple[str, str]]) -> tuple[F.Column, F.Column]:
    """The longest fitting rule and its verdict, null where none fits. A rule is (verdict, "host/path")."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        site, slash, rest = text.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


class DigestArray:
    """Keys and strings in one file: count, keys, string offsets, strings."""

    @staticmethod
    def write(path: str, entries: Sequence[str], digest=None) -> None:
        digest = digest or xxhash.xxh64_intdigest
        texts = sorted({e.encode() for e in entries if e})
        keyed = sorted((digest(t), t) for t in texts)
        ends = np.cumsum([0] + [len(t) for _, t in keyed], dtype=np.uint64)
        with open(path, "wb") as out:
            out.write(struct.pack("<Q", len(keyed)))
            out.write(np.array([k for k, _ in keyed], "<u8").tobytes())
            out.write(ends.astype("<u8").tobytes())
            out.write(b"".join(t for _, t in keyed))

    def __init__(self, path: str, digest=None):
        self.digest = digest or xxhash.xxh64_intdigest
        data = np.memmap(path, np.uint8, mode="r")
        count = struct.unpack("<Q", data[:8].tobytes())[0]
        self.keys = data[8 : 8 + 8 * count].view("<u8")
        self.ends = data[8 + 8 * count : 16 + 16 * count].view("<u8")
        self.texts = data[16 + 16 * count :]

    def holds(self, probes: Sequence[bytes]) -> np.ndarray:
        """For each string whether it is listed."""
        held = np.zeros(len(probes), bool)
        if not len(self.keys) or not len(probes):
            return held
        digest = self.digest
        keys = np.fromiter((digest(p) for p in probes), np.uint64, len(probes))
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        for k in np.flatnonzero(high > low).tolist():
            held[k] = any(self.text(at) == probes[k] for at in range(low[k], high[k]))
        return held

    def text(self, at: int) -> bytes:
        return self.texts[int(self.ends[at]) : int(self.ends[at + 1])].tobytes()


def candidates(host: str, path: str) -> list[bytes]:
    """What a list entry that covers this url may read: the host and every parent domain, alone and with each beginning
    of the path that ends in a slash, or the whole path."""
    if not host:
        return []
    labels = host.split(".")
    sites = [".".join(labels[k:]) for k in range(len(labels))]
    cuts = [k + 1 for k, c in enumerate(path) if c == "/"]
    paths = ["", *(path[:k] for k in cuts), *([path] if path and path[-1] != "/" else [])]
    return [(site + p).encode() for site in sites for p in paths]


@lru_cache(maxsize=4)
def _opened(name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(name))


def _probe(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            array, probes, owners = _opened(name), [], []
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            for row, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                keys = candidates(host, path)
                probes += keys
                owners += [row] * len(keys)
            listed = np.zeros(batch.num_rows, bool)
            listed[np.array(owners, np.int64)[array.holds(probes)]] = True
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(listed)], [*batch.schema.names, "listed"])

    return run


def ship_array(spark: SparkSession, entries: Sequence[str]) -> str:
    """Put the array's file into the shared folder and let Spark copy it to each executor; the name to open it by."""
    name = f"digests-{uuid.uuid4().hex}.bin"
    target = f"{shared_folder(spark).rstrip('/')}/{name}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, name)
        DigestArray.write(path, entries)
        system = hadoop(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.copyFromLocalFile(hadoop(f"file://{path}"), hadoop(target))
    spark.sparkContext.addFile(target)
    return name


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], entries: DataFrame | Sequence[str] = BLOCKED_HOSTS,
    array_bytes: int = ARRAY_BYTES,
) -> DataFrame:
    """`pages` (page_id bigint, url): page_id, host, path, rule, verdict.

    The longest fitting rule decides. Without one, a url is blocked when the list (strings, or a table with a column
    `entry`) holds its host or a parent domain, alone or with the beginning of its path, and allowed otherwise. A null
    url, or one without `://`, has an empty host and path, fits nothing and is allowed. Repeated rows and null ids are
    judged like others; null, empty and repeated entries count for nothing.
    """
    spark = pages.sparkSession
    ship_package(spark)
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    if isinstance(entries, DataFrame):
        entries = entries.select(F.col("entry").cast("string")).where("entry <> ''").distinct()
        size = entries.agg(F.sum(F.octet_length("entry") + 16)).first()[0] or 0
        listed = _listed_by_join(cut, entries) if size > array_bytes else None
        entries = [] if listed is not None else [row[0] for row in entries.toLocalIterator()]
    else:
        listed = None
    if listed is None:
        name = ship_array(spark, list(entries))
        listed = cut.mapInArrow(_probe(name), "page_id bigint, host string, path string, listed boolean")
    return listed.withColumns({"rule": rule, "_verdict": verdict}).select(
        "page_id", "host", "path", "rule",
        F.coalesce("_verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
    )


def _listed_by_join(cut: DataFrame, entries: DataFrame) -> DataFrame:
    """The same answer for a list too long for one array: distinct urls' candidates joined with the list."""
    every = F.udf(lambda host, path: [c.decode() for c in candidates(host, path)], "array<string>")
    urls = cut.select("host", "path").distinct()
    hits = (
        urls.select("host", "path", F.explode(every("host", "path")).alias("entry")).join(entries, "entry")
        .select("host", "path").distinct().withColumn("listed", F.lit(True))
    )
    joined = cut.join(hits, ["host", "path"], "left")
    return joined.select("page_id", "host", "path", F.coalesce("listed", F.lit(False)).alias("listed"))
