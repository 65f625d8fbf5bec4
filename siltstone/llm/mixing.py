"""Mixing sources to target weights by capped water-filling, then seeded whole and fractional repetitions.

Everything on the path is DataFrame code. The texts are read once, to measure them. The fractional repetition of a
source is the start of its documents in the order of a seeded hash, as far as the words still wanted reach. That
point is found by sums over the first and then the second byte of the hash, so no task ever sees more of a source
than one 65,536th of it in order. It is one value a source, so what becomes of a document follows from the document
and a row of its source: the mix shuffles no texts and joins nothing by id. Only where rows of one hash, which are equal
in id and text, lie across that point are they counted, so that as many of them come once more as the words ask for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.sources.scratch import Scratch

#: Maximal runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Copies of a row that one array may hold.
SPAN = 1 << 16


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """Adds ``target``: sources (``weight``, ``source_size``) share ``budget`` by weight, none above its cap.

    Sources above their cap are clamped and what they leave is shared by weight among the rest, until none is above.
    A round fetches two sums; there are at most as many rounds as sources.
    """
    cap, level, clamped = F.col("source_size") * F.lit(float(max_epochs)), None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        got = sources.agg(F.sum(F.when(above, cap).otherwise(0.0)).alias("caps"), F.sum(F.when(~above, F.col("weight")).otherwise(0)).alias("weights"), F.count_if(above).alias("n")).first()
        if got["n"] == clamped or not got["weights"]:
            break
        clamped, level = got["n"], (budget - got["caps"]) / got["weights"]
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level or 0.0)))


def code(id_: Column, text: Column, seed: int) -> Column:
    """The place of a document in the seeded order of its source: a hash of id and text."""
    parts = (F.coalesce(id_.cast("string"), F.lit("")), F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))
    return F.md5(F.concat_ws(":", F.lit(seed), *parts).cast("binary"))


def plan(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, max_epochs: int = 3, seed: int = 7, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per source: ``of``, ``source_size``, ``target``, ``whole`` repetitions, ``last``, the code below which documents come once
    more, and how many, ``extra``, of the ``edge_rows`` rows of that very code do.

    Sources in order of code points, null last, weigh as ``weights`` says, over and over; together they are to take
    ``share`` of all words, none more than ``max_epochs`` times its own. Null is a source of its own; one without words
    has target 0; an empty table gives no rows. ``last`` is null where nothing comes once more. It is found by sums over
    the first and then the second byte of the codes; only within that cell, a 65,536th of a source, are codes sorted,
    and equal codes are one row before that.
    """
    sized = docs.select(F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"), code(F.col(id_col), F.col(text_col), seed).alias("code"))
    return _plan(Scratch(docs.sparkSession), sized, weights, share, max_epochs)


def _plan(scratch: Scratch, sized: DataFrame, weights: tuple[int, ...], share: float, max_epochs: int) -> DataFrame:
    steps = Scratch(sized.sparkSession)
    sized = steps.save(sized.select("source", "size", "code", F.substring("code", 1, 2).alias("first"), F.substring("code", 3, 2).alias("second")), "sized")
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    sources = steps.save(sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight), "sources")
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    targets = steps.save(
        fill(sources, budget, max_epochs)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .select(F.col("source").alias("of"), "source_size", "target", "whole", "rest"),
        "targets",
    )

    def cut(sums: DataFrame, part: str) -> DataFrame:
        """The value of ``part`` at which the words of each source run over ``rest``, and what is left of it there."""
        so_far = F.sum("words").over(Window.partitionBy("source").orderBy(part).rowsBetween(Window.unboundedPreceding, 0))
        over = sums.withColumn("so_far", so_far).filter("so_far > rest").groupBy("source").agg(F.min_by(F.struct(F.col(part), (F.col("rest") - F.col("so_far") + F.col("words")).alias("rest")), part).alias("at"))
        return steps.save(over.select(F.col("source").alias("of"), F.col(f"at.{part}").alias(f"cut_{part}"), F.col("at.rest").alias(f"rest_{part}")), f"cut-{part}")

    same = F.col("source").eqNullSafe(F.col("of"))
    one = cut(sized.groupBy("source", "first").agg(F.sum("size").alias("words")).join(targets.select("of", "rest"), same).drop("of"), "first")
    at_one = sized.join(one, same & (F.col("first") == F.col("cut_first"))).drop("of")
    two = cut(at_one.groupBy("source", "second").agg(F.sum("size").alias("words"), F.first("rest_first").alias("rest")), "second")
    cell = at_one.join(two, same & (F.col("second") == F.col("cut_second"))).groupBy("source", "code").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"), F.first("rest_second").alias("rest"))
    so_far = F.sum("words").over(Window.partitionBy("source").orderBy("code").rowsBetween(Window.unboundedPreceding, 0))
    over = cell.withColumn("so_far", so_far).filter("so_far > rest").groupBy("source").agg(F.min_by(F.struct("*"), "code").alias("at")).select(F.col("source").alias("at_source"), "at.*")
    inside = over.withColumn("extra", F.floor((F.col("rest") - F.col("so_far") + F.col("words")) * F.col("rows") / F.col("words") + 0.5).cast("long"))
    last = F.when(F.col("cut_first").isNull() & (F.col("t.rest") > 0), "g").otherwise(F.col("code"))  # "g" comes after all codes
    found = (
        targets.alias("t").join(one.alias("a"), F.expr("t.of <=> a.of"), "left").join(inside.alias("c"), F.expr("t.of <=> c.at_source"), "left")
        .select("t.of", "source_size", F.round("target", 6).alias("target"), "whole", last.alias("last"), F.coalesce("extra", F.lit(0)).alias("extra"), F.coalesce("rows", F.lit(0)).alias("edge_rows"))
    )
    found = scratch.save(found, "plan")
    steps.clear()
    return found


def repeats(some: Column) -> Column:
    """How often a row with the columns of a plan is taken, if no other row has its code."""
    more = (F.col("code") < F.col("last")) | ((F.col("code") == F.col("last")) & (F.col("extra") == 1))
    return F.when(some, F.col("whole") + F.coalesce(more, F.lit(False)).cast("long")).otherwise(0)


#: Rows whose code others share and of which some come once more than the rest.
AT_EDGE = "code <=> last AND edge_rows > 1"


def counted_out(rows: DataFrame, total: Column) -> DataFrame:
    """Rows at the edge of their source, each distinct one ``total`` times, numbered from 0 by ``copy``.

    ``total`` may use ``n``, how many equal rows there are, and ``take``, how many of them come once more. Equal rows are one
    before they are shuffled; what a source has at its edge is counted by 4,096 parts of a hash before it is put in
    order; and copies are dealt out by spans, so neither a row nor a source that repeats without end is one task.
    """
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).withColumn("_hash", F.xxhash64(*columns)).withColumn("_part", F.col("_hash").bitwiseAND(4095))
    before = Window.partitionBy("of").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.groupBy("of", "_part").agg(F.sum("n").alias("_sum")).withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    starts = starts.select(F.col("of").alias("_of"), F.col("_part").alias("_p"), "_start")
    so_far = F.sum("n").over(Window.partitionBy("of", "_part").orderBy("_hash").rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumn("_upto", so_far).join(starts, F.col("of").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_p")))
    free = F.col("extra") - F.col("_start") - F.col("_upto") + F.col("n")
    some = placed.withColumn("take", F.greatest(F.lit(0), F.least("n", free))).withColumn("_total", total).filter("_total > 0")
    spans = some.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_total") - 1, F.lit(SPAN).cast("long")))).repartition("of", "_hash", "_from")
    return spans.withColumn("copy", F.explode(F.sequence("_from", F.least(F.col("_total"), F.col("_from") + SPAN) - 1))).select(*columns, "take", "copy")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, max_epochs: int = 3, seed: int = 7, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``source``, ``size`` (words), ``source_size``, ``target``, ``repeats``, ``taken``.

    Targets are those of ``plan``. ``repeats`` says how often the mix takes the document, at most ``max_epochs`` times, and
    ``taken`` is ``repeats * size``. Each source comes within half a row of its target: half the words of the row at which
    the words wanted run out. Documents without words (null or empty text) have size 0 and are taken 0 words. Null ids are
    kept. Rows that are equal in id, text and source are rows of their own: of those at that point as many come once more
    as bring the source nearest its target, whichever of them.
    """
    scratch = Scratch(docs.sparkSession)
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"), code(F.col(id_col), F.col(text_col), seed).alias("code"))
    sized = scratch.save(sized, "sized")
    planned = sized.join(_plan(scratch, sized, weights, share, max_epochs), F.col("source").eqNullSafe(F.col("of")))
    rows = planned.filter(f"NOT ({AT_EDGE})").withColumn("repeats", repeats(F.col("size") > 0))
    edge = counted_out(planned.filter(AT_EDGE), F.col("n")).withColumn("repeats", F.col("whole") + (F.col("copy") < F.col("take")).cast("long"))
    both = rows.unionByName(edge.select(*rows.columns))
    return both.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))


def repeat(docs: DataFrame, planned: DataFrame, seed: int = 7, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the plan made from them says; texts stay where they are.

    A row's place follows from the row and the plan of its source, so no text meets a decision by its id; only rows of
    equal id and text at the edge of their source are counted, if there are any. Rows without words are left out; further
    columns may have any name.
    """
    row = F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns)).alias("row")
    text = F.col(text_col).cast("string")
    placed = docs.select(row, F.col(source_col).alias("source"), code(F.col(id_col), text, seed).alias("code"), F.coalesce(text.rlike(WORD), F.lit(False)).alias("some"))
    met = placed.join(planned, F.col("source").eqNullSafe(F.col("of")))
    taken = met.filter(f"NOT ({AT_EDGE})").withColumn("repeats", repeats(F.col("some"))).filter("repeats > 0")
    mixed = taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))).select("row")
    if not planned.filter("edge_rows > 1").isEmpty():
        edge = met.filter(AT_EDGE).select("row", "of", "whole", "extra")
        mixed = mixed.unionByName(counted_out(edge, F.col("n") * F.col("whole") + F.col("take")).select("row"))
    return mixed.select("row.*")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS code FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sized GROUP BY source
), ranked AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
    sum(weight) OVER (ORDER BY 3 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM sources
), level AS (
  SELECT max(left_over / weights) AS level FROM ranked
), targets AS (
  SELECT source, source_size, least(3 * source_size, weight * level) AS target FROM sources, level
), placed AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
    sum(size) OVER (PARTITION BY sized.source ORDER BY code ROWS UNBOUNDED PRECEDING) AS so_far
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, round(target, 6) AS target,
  CAST(size * (whole + CASE WHEN so_far - size / 2 <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM placed
"""
