"""Mixing sources to target weights by systematic sampling.

A source's target over its size is the number of copies expected of each of its documents. Expected
copies are summed along the documents of a source, one random offset is added, and a document is
emitted once per whole number its stretch crosses: every document gets the copies below or above
its expectation, and so does every run of documents. Documents stand in order of size (bins of two
to three per cent), within a bin by hash, so that long and short ones are drawn evenly and a
source's words come as near its target as about one of its longest documents.

The sums need no task that sees a whole source: documents are counted per cell (source, size bin,
slot of the hash), cells are summed in two steps, and only the place inside a cell is numbered row by
row. Everything is DataFrame and SQL functions.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import table
from cardwatch.session import saved

#: Fixed values of the query contract: weights in turn, share of all sizes, copies at most.
WEIGHTS = [3, 1, 2]
SHARE, MOST = 1.5, 2.0
SEED = 42
WHITE = " \t\n\x0b\x0c\r"
#: Hash digits that make a slot, and sources whose names cut the numbering into ranges.
SLOT_DIGITS, NAMES = 3, 256


def word_count(text: Column) -> Column:
    """Number of runs of characters that are no white space; null has none."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marked, WHITE, "")).cast("long")


def drawn(*columns: str, seed: int = SEED) -> Column:
    """Sixteen hexadecimal digits that depend on the values and the seed only."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.substring(F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *parts)), 1, 16)


def size_bin(size: Column) -> Column:
    """A whole number that grows with the size: sizes of the same leading six bits share it."""
    bits = F.length(F.bin(size))
    return (bits * 64 + F.call_function("shiftright", size, F.greatest(bits - 6, F.lit(0)))).cast("int")


def numbered(sources: DataFrame) -> DataFrame:
    """``place`` 0, 1, 2, ... of each source by code point, null last, for any number of sources.

    Names drawn by hash cut the order into ranges; they steer the load and never the result.
    """
    named = sources.filter(F.col("source").isNotNull())
    found = sorted(r[0] for r in named.orderBy(F.xxhash64("source"), "source").select("source").limit(NAMES).collect())
    limits = F.array(*[F.lit(x) for x in found]).cast("array<string>")
    ranged = sources.withColumn("range", F.when(
        F.col("source").isNotNull(), F.size(F.filter(limits, lambda x: x <= F.col("source")))).otherwise(len(found) + 1))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # at most NAMES + 2 rows
    offsets = ranged.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())
    return (ranged.withColumn("place", F.row_number().over(inside)).join(offsets, "range")
            .withColumn("place", F.col("offset") + F.col("place") - 1).drop("range", "offset"))


def targets(sources: DataFrame, weights: list[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds weight, target and rate to (source, size): weights in turn by code point, null last.

    A target stops at ``most`` times its source's size; the excess goes to the others by weight until
    none is above, which is one level per unit of weight that the rest shares. Sources that are full
    stay full as the level rises, so it settles after a few rounds, each one aggregate.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    rows = saved(numbered(sources).withColumns({"weight": w, "cap": F.col("size") * most}).drop("place"), "sources")
    total = rows.agg(F.sum("size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        at = F.col("cap") <= F.lit(level) * F.col("weight") if full >= 0 else F.lit(False)
        found = rows.agg(F.count_if(at), F.sum(F.when(at, F.col("cap"))), F.sum(F.when(~at, F.col("weight")))).first()
        if found[0] == full or not found[2]:
            break
        full, level = found[0], (share * total - (found[1] or 0.0)) / found[2]
    target = F.least("cap", F.lit(level) * F.col("weight"))
    rate = F.when(F.col("size") > 0, target / F.col("size")).otherwise(0.0)
    return rows.withColumns({"target": target, "rate": rate}).drop("cap")


def mix(docs: DataFrame, size: str = "size", source: str = "source", order: str = "drawn",
        weights: list[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Two struct columns: ``row``, all of docs, and ``mix``: size, source_size, target, copies, taken.

    ``size`` is a whole number (null is 0), ``order`` hexadecimal digits (see ``drawn``). A null
    source is a source of its own. Documents without words cost nothing and get copies like others;
    a source without words has target 0. Rows equal in size, source and order are interchangeable:
    as a group they get the same copies in every run. Names cannot clash, an empty table stays empty.
    """
    sized = docs.select(
        F.struct(*docs.columns).alias("row"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"),
        F.col(source).cast("string").alias("source"), F.coalesce(F.col(order).cast("string"), F.lit("")).alias("order"))
    sized = sized.withColumns({"bin": size_bin(F.col("size")), "slot": F.substring("order", 1, SLOT_DIGITS)})
    cells = saved(sized.groupBy("source", "bin", "slot").agg(F.count("*").alias("n"), F.sum("size").alias("size")), "cells")
    rates = targets(cells.groupBy("source").agg(F.sum("size").alias("size")), weights, share, most)

    def before(*keys: str, by: str) -> Column:
        w = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(w), F.lit(0))

    bins = cells.groupBy("source", "bin").agg(F.sum("n").alias("n")).withColumn("earlier", before("source", by="bin"))
    offset = F.conv(F.substring(drawn("source"), 1, 4), 16, 10).cast("long") / 65536.0
    spread = (
        _joined(_joined(cells, bins.drop("n"), ["source", "bin"]), rates.withColumnRenamed("size", "source_size"), ["source"])
        .withColumns({"earlier": F.col("earlier") + before("source", "bin", by="slot"), "offset": offset})
        .select("source", "bin", "slot", "earlier", "source_size", "target", "rate", "offset")
    )
    inside = Window.partitionBy("source", "bin", "slot").orderBy("order", "size")
    upto = F.col("earlier") + F.row_number().over(inside)
    placed = _joined(sized, spread, ["source", "bin", "slot"]).withColumn("upto", upto)
    crossed = [F.floor(F.col("rate") * i + F.col("offset")) for i in (F.col("upto"), F.col("upto") - 1)]
    copies = (crossed[0] - crossed[1]).alias("copies")
    return placed.select("row", F.struct(
        "size", F.col("source_size").cast("long").alias("source_size"), "target", copies,
        (copies * F.col("size")).alias("taken")).alias("mix"))


def emit(mixed: DataFrame) -> DataFrame:
    """The documents of the mix: every row as often as it has copies, in the columns it came with."""
    return mixed.select("row", F.explode(F.array_repeat(F.lit(0), F.col("mix.copies").cast("int")))).select("row.*")


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys of which the first, the source, may be null."""
    pairs = right.withColumnsRenamed({k: f"{k}_" for k in keys})
    on = F.col(keys[0]).eqNullSafe(F.col(f"{keys[0]}_"))
    for k in keys[1:]:
        on = on & (F.col(k) == F.col(f"{k}_"))
    return left.join(pairs, on).drop(*[f"{k}_" for k in keys])


def op13_source_mix(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    slim = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                             drawn("doc_id", "text").alias("drawn")), "sizes")
    return mix(slim).select("row.doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(length(translate(
    regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'x', 'g'),
    concat(chr(32), chr(9), chr(10), chr(11), chr(12), chr(13)), '')) AS BIGINT) AS size,
    substr(md5(concat_ws(chr(31), '42', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))), 1, 16) AS o
  FROM documents),
s AS (SELECT source, size, 2.0::DOUBLE * size AS cap,
    CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM d GROUP BY source)),
o AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS full_caps, sum(w) OVER rest AS free, sum(size) OVER () AS total
  FROM s WINDOW before AS (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT arg_min((1.5::DOUBLE * total - full_caps) / free, cap / w)
    FILTER (WHERE cap / w > (1.5::DOUBLE * total - full_caps) / free) AS level FROM o),
t AS (SELECT source, size AS source_size, least(cap, coalesce(level, 0) * w) AS target,
    CAST(concat('0x', substr(md5(concat_ws(chr(31), '42', coalesce(source, ''))), 1, 4)) AS BIGINT) / 65536.0::DOUBLE AS u
  FROM s, l),
n AS (SELECT doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY length(bin(size)) * 64 + (size >> greatest(length(bin(size)) - 6, 0)), o, size) AS i
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
    CAST(floor(rate * i + u) - floor(rate * (i - 1) + u) AS BIGINT) * size AS taken FROM n"""
