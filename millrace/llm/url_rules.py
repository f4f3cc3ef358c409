"""URL filters as a sort-merge range join of urls and rules.

The key of a host is its labels reversed, each ended by a separator that sorts
before every character of a label: ``blog.example.net`` becomes
``net<sep>example<sep>blog<sep>``. A rule's host is then a prefix of the keys
of all hosts it fits, and the prefix is an interval of keys. Urls and interval
starts are sorted together; one sweep over each range of keys keeps a stack of
the rules whose intervals are open, which are nested. A url takes the longest
rule on the stack whose path its own path starts with.

Urls are dealt out by ranges of (key, path, id), so that a host with a third of
all rows covers many ranges. A rule goes to the ranges its interval meets.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and gets the default verdict, as does every url if there are
no rules. Of rules of one length the one with the longer host wins, then block
before allow. Rules with a null or empty host, or no verdict, fit nothing; a
null rule path is empty. Repeated rows are judged once each; an empty table
gives no rows. Other columns of either table are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import saved
from millrace.session import scratch_path

SEPARATOR, ESCAPE = "\x01", "\x02"
DEFAULT = "allow"
RESULT = "page_id long, host string, path string, rule string, verdict string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z in lower case, and the path of a url; empty if it has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def host_key(host: Column) -> Column:
    """Labels reversed, each ended by the separator; empty for an empty host.

    A separator that a host itself holds is escaped, so it ends no label.
    """
    told = F.replace(F.replace(host, F.lit(ESCAPE), F.lit(f"{ESCAPE}b")), F.lit(SEPARATOR), F.lit(f"{ESCAPE}a"))
    key = F.concat(F.array_join(F.reverse(F.split(told, r"\.")), SEPARATOR), F.lit(SEPARATOR))
    return F.when(host == "", F.lit("")).otherwise(key)


def sweep(frames: Iterator[pd.DataFrame], default: str) -> Iterator[pd.DataFrame]:
    """Judge rows sorted by part, key and kind; rules (kind 0) precede the urls they fit.

    The stack holds one list of rules for each open prefix, so it is as deep
    as the labels of a host.
    """
    part, stack = None, []
    for frame in frames:
        out = []
        for row in frame.itertuples(index=False):
            if row.part != part:
                part, stack = row.part, []
            while stack and not row.key.startswith(stack[-1][0]):
                stack.pop()
            if row.kind == 0:
                if not stack or stack[-1][0] != row.key:
                    stack.append((row.key, []))
                stack[-1][1].append((row.path, row.rule, row.verdict))
                continue
            fits = (
                ((len(rule), len(prefix), verdict == "block", rule), rule, verdict)
                for prefix, rules in stack
                for path, rule, verdict in rules
                if row.path.startswith(path)
            )
            best = max(fits, default=(None, None, default))
            out.append((row.page_id, row.host, row.path, best[1], best[2]))
        yield pd.DataFrame(out, columns=["page_id", "host", "path", "rule", "verdict"]).astype(
            {"page_id": "Int64"}
        )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    default: str = DEFAULT,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: page_id, host, path, the rule that decided (or null), verdict.

    ``rules`` has the columns host, path and verdict (``allow`` or ``block``).
    """
    spark = pages.sparkSession
    chosen = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("_url")
    )
    host, path = host_and_path(F.col("_url"))
    urls = chosen.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "key", host_key(F.col("host"))
    )
    ranges = urls.repartitionByRange("key", "path", F.hash("page_id")).withColumn(
        "part", F.spark_partition_id()
    )
    urls = saved(ranges, scratch_path(spark, "urls"))

    lowered = F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    starts = (
        rules.select(
            lowered.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
        )
        .where("host <> '' and verdict is not null")
        .distinct()
        .select(
            host_key(F.col("host")).alias("key"),
            "path",
            F.concat("host", "path").alias("rule"),
            "verdict",
        )
    )
    # One row per range of keys, as many as there are partitions.
    bounds = urls.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    meets = (F.col("key") <= F.col("high")) & (
        (F.col("key") >= F.col("low")) | F.col("low").startswith(F.col("key"))
    )
    dealt = starts.join(bounds, meets).select(
        "part", "key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("page_id"),
        F.lit("").alias("host"), "path", "rule", "verdict",
    )
    nothing = F.lit(None).cast("string")
    rows = urls.select(
        "part", "key", F.lit(1).alias("kind"), "page_id", "host", "path",
        nothing.alias("rule"), nothing.alias("verdict"),
    ).unionByName(dealt)
    in_order = rows.repartition("part").sortWithinPartitions("part", "key", "kind")
    return in_order.mapInPandas(lambda frames: sweep(frames, default), RESULT)
