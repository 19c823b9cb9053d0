"""URL allow/block rules by a sort-merge range join.

A host is turned round label by label (``blog.example.net`` becomes
``net.example.blog.``), so that a rule's host and all its subdomains are one
interval of keys. URLs are range-partitioned and sorted by key (the page id
breaks ties, so a host with a third of all pages spans many partitions); each
partition gets the rules whose interval meets its own range of keys, and one
sweep over URLs and interval starts keeps the active nested intervals on a
stack. An interval holds its host's path rules, sorted; the longest path prefix
is found by bisection.
"""

from __future__ import annotations

import string
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, stage

#: (host, path, verdict)
DEFAULT_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
                 ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

#: Verdict of a url that no rule fits.
DEFAULT_VERDICT = "allow"


def _lower(column):
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    rest = F.expr(f"substring({url}, locate('://', {url}) + 3)")
    return F.when(F.instr(F.col(url), "://") > 0, _lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))).otherwise(F.lit(""))


def url_path(url):
    """After the host up to ``?``, ``#`` or the end."""
    rest = F.expr(f"substring({url}, locate('://', {url}) + 3)")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(F.col(url), "://") > 0, path).otherwise(F.lit(""))


def reversed_key(host: str) -> str:
    """The canonical key of a host: its labels in reverse, each with a dot after it."""
    return ".".join(reversed(host.split("."))) + "."


def _longest_prefix(paths: list[str], path: str) -> str | None:
    """The longest of the sorted paths that path starts with: only paths that
    sort at or before it can be, and a miss shortens the search to the common part."""
    while path is not None:
        at = bisect_right(paths, path)
        if not at:
            return None
        best = paths[at - 1]
        if path.startswith(best):
            return best
        same = 0
        while same < min(len(best), len(path)) and best[same] == path[same]:
            same += 1
        path = path[:same]
    return None


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (_part, _key, _url): the rules of a key before its URLs."""
    part, stack = None, []   # stack: [key, {path: (rule, verdict)}, sorted paths]
    for batch in batches:
        rules, verdicts = [], []
        names = ("_part", "_key", "_url", "path", "rule", "verdict")
        for p, key, is_url, path, rule, verdict in zip(*(batch.column(c).to_pylist() for c in names)):
            if p != part:
                part, stack = p, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                if not stack or stack[-1][0] != key:
                    stack.append([key, {}, []])
                if path not in stack[-1][1]:
                    stack[-1][2].insert(bisect_left(stack[-1][2], path), path)
                stack[-1][1][path] = (rule, verdict)
                continue
            best = (-1, -1, (None, None))
            for depth, (_, by_path, paths) in enumerate(stack):
                hit = _longest_prefix(paths, path)
                if hit is not None:
                    # The longest rule wins: code points of host and path, then the more specific host.
                    best = max(best, (len(by_path[hit][0]), depth, by_path[hit]), key=lambda b: b[:2])
            rules.append(best[2][0])
            verdicts.append(best[2][1])
        urls = batch.filter(batch.column("_url"))
        yield pa.RecordBatch.from_arrays(
            [*(urls.column(c) for c in ("page_id", "host", "path")), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
            names=["page_id", "host", "path", "rule", "verdict"])


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """pages: page_id, url; rules: host, path, verdict. One row per page:
    page_id, host, path, rule, verdict.

    A null url or one without ``://`` has an empty host and path. Host rules are
    lower-cased; a null host or path is empty; of rules with one host and path the
    smallest verdict counts (allow before block). Repeated pages are judged one by one;
    without rules all pages get the default; other columns play no part."""
    spark = pages.sparkSession
    n = partitions(spark)
    # "x.y" in reverse label order; pages without a host get the key "."
    key = F.concat(F.array_join(F.reverse(F.split("host", r"\.")), "."), F.lit("."))
    urls = pages.select("page_id", url_host("url").alias("host"), url_path("url").alias("path")).withColumn("_key", key)
    spread = F.xxhash64("page_id", "path")
    urls = stage(urls.withColumn("_s", spread).repartitionByRange(n, "_key", "_s").withColumn("_part", F.spark_partition_id()), "urls")
    # One row per partition: the range of keys that it holds.
    bounds = [tuple(r) for r in urls.groupBy("_part").agg(F.min("_key"), F.max("_key")).collect()]
    bounds.sort(key=lambda b: b[0])
    lows, highs, parts = [b[1].encode() for b in bounds], [b[2].encode() for b in bounds], [b[0] for b in bounds]

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for key_, path, rule, verdict in zip(f["_key"], f["path"], f["rule"], f["verdict"]):
                low = key_.encode()
                first, last = bisect_left(highs, low), bisect_right(lows, low + b"\xff")
                out += [(p, key_, path, rule, verdict) for p in parts[first:last]]
            yield pd.DataFrame(out, columns=["_part", "_key", "path", "rule", "verdict"])

    rules = rules.select(F.coalesce(_lower("host"), F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict") \
        .groupBy("host", "path").agg(F.min("verdict").alias("verdict")) \
        .select(key.alias("_key"), "path", F.concat("host", "path").alias("rule"), "verdict")
    rules = rules.mapInPandas(meet, "_part int, _key string, path string, rule string, verdict string")
    both = urls.withColumns({"_url": F.lit(True), "rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")}) \
        .unionByName(rules.withColumn("_url", F.lit(False)), allowMissingColumns=True)
    both = both.repartitionByRange(n, "_part").sortWithinPartitions("_part", "_key", "_url", "path")
    kind = pages.schema["page_id"].dataType.simpleString()
    out = both.select("_part", "_key", "_url", "page_id", "host", "path", "rule", "verdict") \
        .mapInArrow(_sweep, f"page_id {kind}, host string, path string, rule string, verdict string")
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def default_rules(spark) -> DataFrame:
    return spark.createDataFrame(list(DEFAULT_RULES), "host string, path string, verdict string")
