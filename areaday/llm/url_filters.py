"""URL filters over time: every capture is judged by the list entries that were active when it was fetched.

An entry names a host or a parent domain, a day, and what holds from then on: ``block``, ``allow``, or ``clear`` (no
longer listed). Entries become validity intervals up to the next entry of their key. A capture is joined as of its day
with the intervals of its host and all parent domains; the most specific one decides.

Intervals are cut by month, so a capture meets only the few of its key and month, and captures of a hot host can be
split over tasks. Of entries of one key and day, the strictest counts (block, then allow). Entries with a null or an
unknown action, no key or no day are left out. A capture without a host or without a day matches nothing and passes.
Repeated captures are judged one by one. Other columns of captures are handed on unless they are named like a result.
Only DataFrame functions run here. Empty tables give empty results, or captures that all pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from areaday.session import materialise

#: The action of an entry by its strictness.
ACTIONS = {1: "clear", 2: "allow", 3: "block"}
_HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without a dot at its end; null if there is none."""
    return F.nullif(F.regexp_replace(F.regexp_extract(F.lower(url), _HOST, 1), r"\.+$", ""), F.lit(""))


def parents(host: Column) -> Column:
    """The host and its parent domains, each as ``(labels, key)``."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(
            (F.size(labels) - i + 1).alias("labels"),
            F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".").alias("key"),
        ),
    )


def intervals(entries: DataFrame) -> DataFrame:
    """``key, action, since, until`` of the times at which a key is listed; ``until`` is exclusive, null if open.

    Entries are first reduced to one per key and day, so a key has as many rows as days at most.
    """
    strict = F.create_map(*[x for k, v in ACTIONS.items() for x in (F.lit(v), F.lit(k))])[entries["action"]]
    known = entries.select(F.lower("key").alias("key"), F.col("day").cast("date").alias("since"), strict.alias("strict"))
    daily = known.dropna().groupBy("key", "since").agg(F.max("strict").alias("strict"))
    until = F.lead("since").over(Window.partitionBy("key").orderBy("since"))
    action = F.create_map(*[x for k, v in ACTIONS.items() for x in (F.lit(k), F.lit(v))])[F.col("strict")]
    return daily.select("key", action.alias("action"), "since", until.alias("until")).filter("action != 'clear'")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (with ``url`` and a date ``fetched``) with ``host, verdict, matched, since``.

    ``verdict`` is ``block``, ``allow`` or ``pass``; ``matched`` is the key that decides, listed ``since`` that day.
    """
    added = ["host", "verdict", "matched", "since"]
    handed = [captures[name] for name in captures.columns if name not in added]
    rows = captures.select(*handed, host_of(captures["url"]).alias("host"))
    asked = materialise(rows.select("host", F.col("fetched").cast("date").alias("day")).dropna().distinct())
    last = asked.agg(F.max("day")).first()[0]
    month = lambda day: F.trunc(day, "month")
    listed = intervals(entries).filter(F.col("since") <= F.lit(last))
    end = F.least(F.coalesce(F.date_sub("until", 1), F.lit(last)), F.lit(last))
    listed = listed.withColumn("month", F.explode(F.sequence(month(F.col("since")), month(end), F.expr("interval 1 month"))))

    keys = asked.withColumn("parent", F.explode(parents(F.col("host")))).select(
        "host", "day", month(F.col("day")).alias("month"), "parent.labels", "parent.key"
    )
    in_force = (F.col("since") <= F.col("day")) & (F.col("until").isNull() | (F.col("day") < F.col("until")))
    best = F.max(F.struct("labels", "key", "action", "since")).alias("best")
    decided = materialise(keys.join(materialise(listed), ["key", "month"]).filter(in_force).groupBy("host", "day").agg(best))
    verdicts = decided.select(F.col("host").alias("of"), F.col("day").alias("on"), "best")
    same = (rows["host"] == verdicts["of"]) & (rows["fetched"].cast("date") == verdicts["on"])
    return rows.join(verdicts, same, "left").select(
        *[rows[name] for name in rows.columns],
        F.coalesce(verdicts["best"]["action"], F.lit("pass")).alias("verdict"),
        verdicts["best"]["key"].alias("matched"),
        verdicts["best"]["since"].alias("since"),
    )
