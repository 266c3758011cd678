"""Line dedup by winnowing over line hashes, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import same, shuffled, steps, stored, without

_OWN = ["n_lines", "n_removed", "_th", "_h", "_cut", "_id"]


def _normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))


def _lines(text: Column) -> Column:
    """(line number, two hashes, words) of every line that isn't blank."""

    def of(line: Column, n: Column) -> Column:
        body = _normal(line)
        return F.struct(
            n.alias("line"),
            F.xxhash64(body).alias("h1"),
            F.xxhash64(body, F.lit(1)).alias("h2"),
            F.when(body == "", 0).otherwise(F.size(F.split(body, " "))).alias("words"),
        )

    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), of), lambda x: x["words"] > 0)


def _windows(window: int) -> Column:
    """For every window of lines: its first and last line, its fingerprint (the smallest hash of its lines) and its
    key, a hash over all of its lines in order."""

    def at(start: Column) -> Column:
        part = F.slice("_h", start, window)
        return F.struct(
            F.element_at(part, 1)["line"].alias("first"),
            F.element_at(part, -1)["line"].alias("last"),
            F.array_min(F.transform(part, lambda x: x["h1"])).alias("print"),
            F.xxhash64(F.transform(part, lambda x: x["h1"])).alias("k1"),
            F.xxhash64(F.transform(part, lambda x: x["h2"])).alias("k2"),
        )

    starts = F.sequence(F.lit(1), F.size("_h") - window + 1)
    return F.when(F.size("_h") >= window, F.transform(starts, at))


def _long_lines(least: int) -> Column:
    long = F.filter("_h", lambda x: x["words"] >= least)
    return F.transform(
        long,
        lambda x: F.struct(
            x["line"].alias("first"),
            x["line"].alias("last"),
            x["h1"].alias("print"),
            x["h1"].alias("k1"),
            x["h2"].alias("k2"),
        ),
    )


def repeated_lines(docs: DataFrame, window: int = 2, long_line: int = 50) -> DataFrame:
    """(``doc_id``, ``_th``, ``_cut``): for each document with later repeats, the numbers of the lines to delete."""
    hashed = docs.select("doc_id", F.xxhash64("text").alias("_th"), _lines(F.col("text")).alias("_h"))
    none = F.array().cast("array<struct<first:int,last:int,print:bigint,k1:bigint,k2:bigint>>")
    spans = F.concat(F.coalesce(_windows(window), none), F.coalesce(_long_lines(long_line), none))
    runs = stored(hashed.select("doc_id", "_th", F.explode(spans).alias("w")).select("doc_id", "_th", "w.*"), "runs")

    place = F.struct("doc_id", "_th", "first")
    shared = stored(
        runs.groupBy("print")
        .agg(F.min(place).alias("low"), F.max(place).alias("high"))
        .where(~same(F.col("low"), F.col("high")))
        .select("print"),
        "fingerprints",
    )
    found = runs.join(shuffled(shared), "print").withColumn("many", F.col("first") != F.col("last"))
    # Matches grow from the fingerprint to both ends of its windows; overlapping windows make up the whole run.
    found = stored(found.drop("print"), "matches")
    earliest = stored(
        found.groupBy("k1", "k2", "many")
        .agg(F.min(place).alias("origin"), F.max(place).alias("high"))
        .where(~same(F.col("origin"), F.col("high")))
        .drop("high"),
        "origins",
    )
    later = found.join(shuffled(earliest), ["k1", "k2", "many"]).where(~same(place, F.col("origin")))
    cuts = later.groupBy("doc_id", "_th").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    lines = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["last"]))))
    return cuts.select("doc_id", "_th", lines.alias("_cut"))


def dedup_lines(docs: DataFrame, window: int = 2, long_line: int = 50) -> DataFrame:
    """``docs`` without its later repeated runs of lines; columns ``n_lines`` and ``n_removed`` are added.

    A run is ``window`` consecutive lines or more, or one line of ``long_line`` words or more. Lines are compared in
    lower case with runs of white space as one space; blank lines are skipped in comparisons and stay in the text.
    A line goes if it lies in a window (or is a long line) that also starts earlier: in a document with a smaller
    ``doc_id``, or earlier in the same one. Runs are judged on the input, not on what is left.

    In every window the smallest line hash is selected, so two equal windows select equal fingerprints. Windows of
    fingerprints that occur once are dropped by counting; the others are extended to whole windows, compared by 128
    bits, and counted again. Only places and hashes are shuffled until the lines to delete are joined to their texts.

    Null texts come back null with no lines. Null ids count as the smallest id; documents with one id go in the order
    of a hash of their texts, and rows with equal id and text are one document that comes back as often as it came.
    Input columns named like one that is added are replaced; others stay. An empty table gives an empty result.
    """
    with steps(docs.sparkSession) as kept:
        cuts = stored(repeated_lines(docs, window, long_line), "cuts")
        kept.append(cuts)
    cuts = cuts.select(F.col("doc_id").alias("_id"), F.col("_th").alias("_th2"), "_cut")
    rows = without(docs, [*_OWN, "_th2"]).withColumn("_th", F.xxhash64("text"))
    joined = rows.join(shuffled(cuts), same(F.col("doc_id"), F.col("_id")) & (F.col("_th") == F.col("_th2")), "left")
    split = F.split("text", "\n")
    left = F.array_join(F.filter(split, lambda _, n: ~F.array_contains("_cut", n)), "\n")
    others = [F.col(f"`{c}`") for c in rows.columns if c not in ("text", "_th")]
    return joined.select(
        *others,
        F.when(F.col("_cut").isNull(), F.col("text")).otherwise(left).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(split)).alias("n_lines"),
        F.when(F.col("_cut").isNull(), 0).otherwise(F.size("_cut")).alias("n_removed"),
    )


LINE_SQL = """
with split as (
  select doc_id, text, unnest(string_split(text, chr(10))) as raw,
         unnest(range(len(string_split(text, chr(10))))) as line
  from documents
), lines as (
  select doc_id, line, trim(regexp_replace(lower(raw), '[\\x20\\x09-\\x0D]+', ' ', 'g')) as body from split
), kept_lines as (
  select doc_id, line, body, len(string_split(body, ' ')) as words,
         lead(line) over d as line2, lead(body) over d as body2
  from lines where body <> '' window d as (partition by doc_id order by line)
), runs as (
  select doc_id, line as a, line2 as b, 'many' as kind, body || chr(10) || body2 as key
  from kept_lines where line2 is not null
  union all
  select doc_id, line, line, 'one', body from kept_lines where words >= 50
), ranked as (
  select doc_id, a, b, row_number() over (partition by kind, key order by doc_id, a) as nth from runs
), gone as (
  select distinct doc_id, line from (
    select doc_id, a as line from ranked where nth > 1 union all select doc_id, b from ranked where nth > 1)
)
select s.doc_id, cast(count(*) as integer) as n_lines, cast(count(g.line) as integer) as n_removed,
       coalesce(string_agg(s.raw, chr(10) order by s.line) filter (g.line is null), '') as text
from split s left join gone g on s.doc_id = g.doc_id and s.line = g.line
group by s.doc_id
"""
