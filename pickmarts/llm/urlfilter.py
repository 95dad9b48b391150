"""Operator 3, URL filters: a temporal list join.

Block lists are histories of dated changes (``add`` or ``remove`` of a pattern).
Per list and pattern they become validity intervals [since, until): a day's
changes count once, ``remove`` wins over ``add`` on one day, repeated adds or
removes change nothing, an interval without a removal is open. Every capture is
then judged by the entries active on its fetch day: an as-of join on its keys.
A capture's keys are its host and every parent domain of it (kind ``host``), and
its host with every leading part of its path (kind ``path``), as deep as the
lists go.

Built-in functions only. Captures are reduced to distinct (url, day) first.
Intervals are dealt to the calendar months they touch, so the join runs on
(kind, pattern, month) and compares a capture with the intervals of one month
only; a host with a third of all captures is spread over its months, and the join
is a plain equi-join whose skewed partitions Spark can split. Nothing is
broadcast by hint.

Defined cases: a capture without url, host or fetch day is not blocked; change
rows with a null list, kind, pattern or day, or another action, are ignored;
repeated captures each get their verdict; empty tables give empty results or
nothing blocked; input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickmarts.llm.columns import drop_named, fresh_prefix


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _path_parts(url: Column) -> Column:
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda p: p != "")


def host_keys(host: Column) -> Column:
    """The host and its parent domains, down to two labels (a single label is its own key)."""
    labels = F.size(F.split(host, r"\."))
    return F.transform(F.sequence(F.least(F.lit(2), labels), labels), lambda k: _last(host, k))


def _last(host: Column, k: Column) -> Column:
    parts = F.split(host, r"\.")
    return F.array_join(F.slice(parts, -k, k), ".")


def path_keys(url: Column, host: Column, depth: int) -> Column:
    """The host with 1 to ``depth`` leading parts of the path."""
    parts = _path_parts(url)
    most = F.least(F.size(parts), F.lit(depth))
    keys = F.transform(
        F.sequence(F.lit(1), F.greatest(most, F.lit(1))),
        lambda k: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), k), "/")),
    )
    return F.when(most > 0, keys).otherwise(F.array().cast("array<string>"))


def validity_intervals(changes: DataFrame) -> DataFrame:
    """list, kind, pattern, since, until (null: open) from rows of list, kind, pattern, action, day."""
    usable = changes.where(
        F.col("action").isin("add", "remove")
        & F.col("list").isNotNull()
        & F.col("kind").isNotNull()
        & F.col("pattern").isNotNull()
        & F.col("day").isNotNull()
    )
    # one row per day at most, summed map-side
    daily = usable.groupBy("list", "kind", "pattern", "day").agg(F.max(F.col("action") == "remove").alias("off"))
    history = Window.partitionBy("list", "kind", "pattern").orderBy("day")
    turns = daily.withColumn("was_off", F.coalesce(F.lag("off").over(history), F.lit(True))).where("off != was_off")
    turns = turns.withColumn("until", F.lead("day").over(history))
    return turns.where("not off").select("list", "kind", "pattern", F.col("day").alias("since"), "until")


def _month(day: Column | str) -> Column:
    return F.year(day) * 12 + F.month(day)


def judge(captures: DataFrame, changes: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """All rows and columns of ``captures`` with blocked, lists (names, comma-separated), entries and since.

    ``entries`` counts the active entries that match, ``since`` is the first day of
    the oldest of them. ``fetched`` is a date column.
    """
    captures = drop_named(captures, "blocked", "lists", "entries", "since")
    prefix = fresh_prefix(captures)
    at, on, verdict = f"{prefix}url", f"{prefix}day", f"{prefix}verdict"
    intervals = validity_intervals(changes)
    reach = captures.agg(F.max(fetched)).first()[0]
    deepest = intervals.where("kind = 'path'").agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    last = F.least(F.coalesce(F.date_sub(F.col("until"), 1), F.lit(reach)), F.lit(reach))
    monthly = intervals.where(F.col("since") <= F.lit(reach)).select(
        "list", "kind", "pattern", "since", "until", F.explode(F.sequence(_month("since"), _month(last))).alias("month")
    )

    seen = captures.where(F.col(url).isNotNull() & F.col(fetched).isNotNull())
    seen = seen.select(F.col(url).alias(at), F.col(fetched).alias(on), host_of(F.col(url)).alias("host"))
    seen = seen.where("host != ''").distinct()
    keys = F.concat(
        F.transform(host_keys(F.col("host")), lambda p: F.struct(F.lit("host").alias("kind"), p.alias("pattern"))),
        F.transform(
            path_keys(F.col(at), F.col("host"), deepest),
            lambda p: F.struct(F.lit("path").alias("kind"), p.alias("pattern")),
        )
        if deepest
        else F.array().cast("array<struct<kind:string,pattern:string>>"),
    )
    keyed = seen.select(at, on, _month(on).alias("month"), F.inline(keys))
    active = (F.col("since") <= F.col(on)) & (F.col("until").isNull() | (F.col(on) < F.col("until")))
    hits = keyed.join(monthly, ["kind", "pattern", "month"]).where(active)
    verdicts = hits.groupBy(at, on).agg(
        F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists"),
        F.count("*").alias("entries"),
        F.min("since").alias("since"),
    )
    # the verdict travels as one column, so that the captures may have columns of any name
    verdicts = verdicts.select(at, on, F.struct("lists", "entries", "since").alias(verdict))
    same = (F.col(url) == F.col(at)) & (F.col(fetched) == F.col(on))
    return captures.join(verdicts, same, "left").select(
        *[F.col(f"`{c}`") for c in captures.columns],
        F.col(verdict).isNotNull().alias("blocked"),
        F.coalesce(F.col(f"{verdict}.lists"), F.lit("")).alias("lists"),
        F.coalesce(F.col(f"{verdict}.entries"), F.lit(0)).alias("entries"),
        F.col(f"{verdict}.since").alias("since"),
    )


def _digits(*parts: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def page_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures: their fetch day in 2024 follows from the page id (the table holds none)."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (_digits(F.lit("day"), F.col("page_id").cast("string")) % 366).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched"))


def page_list_changes(pages: DataFrame) -> DataFrame:
    """A change history for the hosts, domains and first path parts that occur in the pages (the tables hold none).

    About a third of the patterns are ever listed: added on a day of 2023 to 2024,
    mostly removed later, sometimes added again.
    """
    host = host_of(F.col("url"))
    found = pages.where(F.col("url").isNotNull()).select(
        F.explode(
            F.concat(
                F.transform(host_keys(host), lambda p: F.struct(F.lit("host").alias("kind"), p.alias("pattern"))),
                F.transform(path_keys(F.col("url"), host, 1), lambda p: F.struct(F.lit("path").alias("kind"), p.alias("pattern"))),
            )
        ).alias("k")
    )
    patterns = found.select("k.kind", "k.pattern").where("pattern != ''").distinct()
    draw = _digits(F.lit("list"), F.col("pattern"))
    listed = patterns.where(draw % 3 == 0).select(
        F.when(draw % 2 == 0, "spam").otherwise("malware").alias("list"),
        "kind",
        "pattern",
        (_digits(F.lit("add"), F.col("pattern")) % 700).cast("int").alias("a"),
        (_digits(F.lit("stay"), F.col("pattern")) % 200 + 1).cast("int").alias("b"),
        (_digits(F.lit("again"), F.col("pattern")) % 4).cast("int").alias("c"),
    )
    start = F.lit("2023-01-01").cast("date")
    change = lambda action, days: F.struct(F.lit(action).alias("action"), F.date_add(start, days).alias("day"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    changes = F.array(change("add", a), change("add", a + 1))
    changes = F.when(c > 0, F.concat(changes, F.array(change("remove", a + b)))).otherwise(changes)
    changes = F.when(c > 2, F.concat(changes, F.array(change("add", a + b + 40)))).otherwise(changes)
    return listed.select("list", "kind", "pattern", F.inline(changes))


def op3_judge(pages: DataFrame) -> DataFrame:
    """Every page with its fetch day and the verdict of the lists on that day."""
    return judge(page_captures(pages), page_list_changes(pages))


# The same rows in DuckDB SQL: the last change on or before the fetch day decides.
ORACLE_SQL = """
WITH urls AS (
  SELECT page_id, url, DATE '2024-01-01' + (('0x' || substr(md5('day:' || page_id), 1, 8))::BIGINT % 366)::INT AS fetched,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1), '/'), lambda p: p != '') AS path
  FROM pages
),
parts AS (SELECT *, string_split(host, '.') AS l FROM urls),
keys AS (
  SELECT DISTINCT url, fetched, 'host' AS kind, array_to_string(l[k:], '.') AS pattern
  FROM (SELECT *, unnest(range(1, greatest(len(l), 2))) AS k FROM parts)
  UNION ALL
  SELECT DISTINCT url, fetched, 'path', host || '/' || path[1] FROM parts WHERE len(path) > 0
),
patterns AS (SELECT DISTINCT kind, pattern, ('0x' || substr(md5('list:' || pattern), 1, 8))::BIGINT AS draw FROM keys WHERE pattern != ''),
listed AS (
  SELECT CASE WHEN draw % 2 = 0 THEN 'spam' ELSE 'malware' END AS list, kind, pattern,
    (('0x' || substr(md5('add:' || pattern), 1, 8))::BIGINT % 700)::INT AS a,
    (('0x' || substr(md5('stay:' || pattern), 1, 8))::BIGINT % 200 + 1)::INT AS b,
    ('0x' || substr(md5('again:' || pattern), 1, 8))::BIGINT % 4 AS c
  FROM patterns WHERE draw % 3 = 0
),
spans AS (
  SELECT list, kind, pattern, DATE '2023-01-01' + a AS since,
    CASE WHEN c > 0 THEN DATE '2023-01-01' + greatest(a + b, CASE WHEN b = 1 THEN a + 1 ELSE 0 END) END AS until FROM listed
  UNION ALL
  SELECT list, kind, pattern, DATE '2023-01-01' + a + b + 40, NULL FROM listed WHERE c > 2
),
hits AS (
  SELECT url, fetched, array_to_string(list_sort(list(DISTINCT list)), ',') AS lists, count(*) AS entries, min(since) AS since
  FROM keys JOIN spans USING (kind, pattern) WHERE since <= fetched AND (until IS NULL OR fetched < until) GROUP BY ALL
)
SELECT page_id, u.url, u.fetched, h.lists IS NOT NULL AS blocked, coalesce(h.lists, '') AS lists,
  coalesce(entries, 0) AS entries, since
FROM urls u LEFT JOIN hits h ON h.url = u.url AND h.fetched = u.fetched
"""
