"""URL filter: rules as intervals of reversed-host keys, matched in one sorted sweep."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from oreflow.llm.common import lower_ascii

#: Rows of sample for each partition of the sweep; they only place its borders.
SAMPLE = 64


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """``www.example.net`` as ``net`` 1 ``example`` 1 ``www`` 1: a host's key begins those of its subdomains."""
    labels = F.reverse(F.split(F.translate(host, "\x00\x01\x02", "\x03\x03\x03"), r"\."))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(labels, "\x01"), F.lit("\x01")))


def _place(bounds: list[tuple[str, int]], names: list[str]):
    """Adds the part that a url's key is in, or every part that a rule's interval reaches into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, taken = [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("key", "row", "until")), strict=True)
            for i, (key, row, until) in enumerate(rows):
                first = bisect_right(bounds, (key, row))
                last = first if until is None else bisect_right(bounds, (until, -1))
                parts += range(first, last + 1)
                taken += [i] * (last + 1 - first)
            columns = [c.take(pa.array(taken, pa.int64())) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *columns], names=["part", *names])

    return run


def _sweep(default: str):
    """Walks the sorted rows of a part; the hosts with rules that are open stand on a stack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []
        for batch in batches:
            kept, named, verdicts = [], [], []
            columns = ("part", "key", "until", "path", "rule", "verdict")
            rows = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
            for i, (now, key, until, path, rule, verdict) in enumerate(rows):
                if now != part:
                    part, stack = now, []
                # Intervals of hosts are nested or apart, so those that have ended are on top.
                while stack and stack[-1][0] <= key:
                    stack.pop()
                if until is not None:
                    if not stack or stack[-1][0] != until:
                        stack.append((until, {}, set()))
                    stack[-1][1].setdefault(path, (rule, verdict))
                    stack[-1][2].add(len(path))
                    continue
                best, best_verdict = None, default
                for _, paths, lengths in stack:
                    for n in lengths:
                        fit = paths.get(path[:n]) if n <= len(path) else None
                        if fit and (best is None or len(fit[0]) >= len(best)):
                            best, best_verdict = fit
                kept.append(i)
                named.append(best)
                verdicts.append(best_verdict)
            columns = [batch.column(c).take(pa.array(kept, pa.int64())) for c in ("page_id", "host", "path")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(named, pa.string()), pa.array(verdicts, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return run


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages`` (``page_id``, ``url``).

    ``rules`` has ``verdict``, ``host`` and ``path``; a rule fits its host and all subdomains where the
    url's path begins with its path.  The longest rule (host and path together) wins; of equally
    long ones the one of the longer host.  Of a rule that is given twice the verdict that sorts
    first holds.  No rule: ``default``.  Null, empty and other urls without ``://`` have an empty host
    and path and no rule.

    A rule is the interval of keys that begin with its reversed host, a url is a point.  Rules and urls
    are dealt to parts of the key order and sorted there, and one walk over a part keeps the open
    hosts on a stack.  Borders of parts come from a sample of keys with a row number behind each, so that a
    single url that fills a third of the table is cut too; a rule goes to every part it reaches into.
    """
    host = host_of(F.col("url"))
    points = pages.select("page_id", host.alias("host"), path_of(F.col("url")).alias("path")).select(
        reversed_host(F.col("host")).alias("key"),
        F.monotonically_increasing_id().alias("row"),
        F.lit(None).cast("string").alias("until"),
        "page_id",
        "host",
        "path",
        F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("verdict"),
    )
    key = reversed_host(F.col("host"))
    given = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    spans = given.where("host <> ''").select(
        key.alias("key"),
        F.lit(-1).cast("long").alias("row"),
        F.concat(F.substring(key, F.lit(1), F.length(key) - 1), F.lit("\x02")).alias("until"),
        F.lit(None).cast("long").alias("page_id"),
        "host",
        "path",
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    n_tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_parts = 4 * n_tasks
    # About SAMPLE keys a part, drawn by hash.  They place the borders and change no result.
    share = min(1.0, SAMPLE * n_parts / max(pages.count(), 1))
    drawn = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) <= int(share * (1 << 20))
    keys = sorted((r["key"], r["row"]) for r in points.select("key", "row").where(drawn).collect())
    bounds = sorted({keys[len(keys) * i // n_parts] for i in range(1, n_parts)}) if keys else []
    events = points.unionByName(spans)
    schema = (
        "part int, key string, row long, until string, page_id long, host string, path string, rule string, "
        "verdict string"
    )
    dealt = events.mapInArrow(_place(bounds, events.columns), schema).repartition(n_tasks, "part")
    walked = dealt.sortWithinPartitions("part", "key", "row")
    return walked.mapInArrow(
        _sweep(default), "page_id long, host string, path string, rule string, verdict string"
    )
