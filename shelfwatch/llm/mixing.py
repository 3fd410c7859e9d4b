"""Mixing sources to target weights by entropy balancing.

Documents get rates between 0 and ``ceiling`` that stay as close to even as possible, in relative
entropy, while each source's expected words meet its target. The optimum tilts a rate
exponentially with the document's size: rate = ceiling / (1 + exp(-tilt * size)), one tilt per
source, the multiplier of its token constraint. Newton steps on the convex dual find the tilts;
each step is one aggregation over (source, size) cells. Rates become whole copies by carrying
the rounding error from document to document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import free_names, gapless, materialise, ranked, words_sql

#: documents whose rounding error is carried in one sequence
PER_CHUNK = 2000
#: rows of a line that are listed by one task
PER_PIECE = 10_000
#: a source is settled when its expected words miss the target by less than this share, or a hundredth of a word
NEAR, MOST_STEPS = 1e-7, 80


def targets(units: DataFrame, weights: Sequence[float], share: float, ceiling: float) -> DataFrame:
    """(source, source_size, rows, weight, target) per source of ``units`` (source, size, n).

    Sources in code point order, null last, take ``weights`` in turn and share ``share`` of all
    words; a target stops at ``ceiling`` times its source's words, and the excess is shared again
    until none is above. The common words per weight, one number, is all that reaches the driver.
    """
    sources = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows")
    )
    order = [F.col("source").isNull(), F.col("source").cast("binary")]
    turn = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_turn") % len(weights)).cast("int"))
    out = materialise(ranked(sources, "_turn", order).withColumn("weight", turn).drop("_turn"))
    cap = F.col("source_size") * F.lit(float(ceiling))
    whole, weight = out.agg(F.sum("source_size"), F.sum("weight")).first()
    if not weight:
        return out.withColumn("target", F.lit(0.0))
    total = share * int(whole)
    per_weight = total / weight
    while True:
        above = F.col("weight") * per_weight > cap
        capped, free = out.agg(
            F.sum(F.when(above, cap).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))
        ).first()
        nxt = (total - capped) / free if free else per_weight
        if nxt <= per_weight:
            break
        per_weight = nxt
    return out.withColumn("target", F.least(cap, F.col("weight") * F.lit(per_weight)))


def _rate(ceiling: float) -> str:
    tilt = "greatest(-700D, least(700D, lam * size / scale))"
    return f"if(full, {ceiling}D, {ceiling}D / (1 + exp(-{tilt})))"


def tilts(units: DataFrame, goals: DataFrame, ceiling: float) -> DataFrame:
    """``goals`` with each source's tilt ``lam`` per ``scale`` words, or ``full`` at the ceiling.

    Safeguarded Newton: a step that leaves the bracket of the root is replaced by a wider step or
    the middle. Sums are exact decimals, so that reruns give the same tilts.
    """
    cells = materialise(units.groupBy("source", "size").agg(F.sum("n").alias("n")).where("size > 0"))
    full = (F.col("source_size") > 0) & (F.col("target") >= F.col("source_size") * F.lit(ceiling))
    part = F.col("target") / (F.col("source_size") * F.lit(ceiling))
    start = F.when((F.col("source_size") == 0) | full | (F.col("target") <= 0), 0.0).otherwise(F.log(part / (1 - part)))
    state = goals.withColumns(
        {
            "scale": F.greatest(F.col("source_size") / F.col("rows"), F.lit(1.0)),
            "full": full,
            "lam": start,
            "low": F.lit(None).cast("double"),
            "high": F.lit(None).cast("double"),
            "settled": full | (F.col("source_size") == 0),
        }
    )
    state = materialise(state)
    rate = _rate(ceiling)
    for _ in range(MOST_STEPS):
        if state.where("not settled").isEmpty():
            break
        open_ = state.where("not settled").select(F.col("source").alias("_s"), "lam", "scale", "full")
        sums = (
            cells.join(open_, F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("r", F.expr(rate))
            .groupBy("_s")
            .agg(
                F.expr("cast(sum(cast(n * size * r as decimal(28, 6))) as double)").alias("got"),
                F.expr(f"cast(sum(cast(n * size * size / scale * r * (1 - r / {ceiling}D) as decimal(28, 6))) as double)").alias("slope"),
            )
        )
        miss = F.col("got") - F.col("target")
        low = F.when(miss < 0, F.greatest("low", "lam")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.least("high", "lam")).otherwise(F.col("high"))
        step = F.col("lam") - F.try_divide(miss, F.col("slope"))
        wider = F.when(miss > 0, F.col("lam") - 2 - 2 * F.abs("lam")).otherwise(F.col("lam") + 2 + 2 * F.abs("lam"))
        inside = F.coalesce(step > F.col("_low"), F.lit(True)) & F.coalesce(step < F.col("_high"), F.lit(True))
        bounded = F.col("_low").isNotNull() & F.col("_high").isNotNull()
        small = F.abs(step - F.col("lam")) <= 2 + 2 * F.abs("lam")
        nxt = (
            F.when(inside & (bounded | small), step)
            .when(bounded, (F.col("_low") + F.col("_high")) / 2)
            .otherwise(wider)
        )
        near = F.abs(miss) <= F.greatest(F.col("target") * NEAR, F.lit(0.01))
        state = materialise(
            state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left")
            .withColumns({"_low": low, "_high": high})
            .withColumns({"_near": F.col("settled") | F.coalesce(near, F.lit(True))})
            .select(
                "source", "source_size", "rows", "weight", "target", "scale", "full",
                F.when(F.col("_near"), F.col("lam")).otherwise(nxt).alias("lam"),
                F.col("_low").alias("low"), F.col("_high").alias("high"), F.col("_near").alias("settled"),
            )
        )
    return state


# Copies of a chunk's lines, largest first: each takes the number in all, up to the ceiling per row,
# that brings the words taken so far nearest to the words wanted so far. For a line of one document
# that is the floor or the ceiling of its rate but where a larger one before it has left more than
# its own size over.
_CARRY = """
aggregate(array_sort(collect_list(struct(-size as neg, doc_id, size, n, r))),
  struct(0D as miss, cast(array() as array<struct<doc_id:ID,size:bigint,n:bigint,total:bigint>>) as done),
  (a, x) -> transform(array(
      if(x.size = 0, x.n * cast(round(x.r) as bigint), greatest(0L, least(MOST * x.n,
        cast(round((a.miss + x.n * x.size * x.r) / x.size) as bigint))))), k ->
    struct(a.miss + x.size * (x.n * x.r - k) as miss,
      array_append(a.done, struct(x.doc_id as doc_id, x.size as size, x.n as n, k as total)) as done))[0],
  a -> a.done)
"""


def copies(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, ceiling: float = 2.0
) -> DataFrame:
    """(source, doc_id, size, n, total, source_size, target) for ``docs`` (doc_id, text, source).

    ``size`` is the number of words, 0 for null or empty texts. Rows that agree in source, doc_id
    and size are one line with their number ``n``; together they get ``total`` copies, which
    ``row_copies`` deals out evenly. Documents without words get the rounded rate at size 0, one
    copy, or the ceiling in a full source. Ties go by id. An empty table gives no lines.
    """
    sized = docs.select("doc_id", "source", F.size(F.expr(words_sql("text"))).cast("long").alias("size"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    units = materialise(sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n")))
    goals = targets(units, weights, share, ceiling)
    state = tilts(units, goals, ceiling).withColumnRenamed("source", "_s")
    rated = (
        units.join(state, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("r", F.expr(_rate(ceiling)))
        .withColumn("_chunk", F.expr(f"pmod(xxhash64(doc_id, size), cast(rows div {PER_CHUNK} + 1 as bigint))"))
    )
    done = rated.groupBy("source", "source_size", "target", "_chunk").agg(F.expr(_CARRY.replace("ID", id_type).replace("MOST", f"{int(ceiling)}L")).alias("d"))
    return done.select("source", "source_size", "target", F.explode("d").alias("d")).select(
        "source", "d.doc_id", "d.size", "d.n", "d.total", "source_size", "target"
    )


def row_copies(number: str, n: str = "n", total: str = "total") -> str:
    """SQL for the copies of the row with that number, from 0, in its line: the first ones take one more."""
    return f"{total} div {n} + if({number} < {total} % {n}, 1, 0)"


def rows_of(plan: DataFrame) -> DataFrame:
    """``plan`` with a row and its ``copies`` for every document; long lines are dealt over many tasks."""
    pieces = plan.withColumn("_from", F.expr(f"explode(sequence(0L, n - 1, {PER_PIECE}L))"))
    spread = pieces.repartition("source", "doc_id", "size", "_from")
    numbered = spread.withColumn("_row", F.expr(f"explode(sequence(_from, least(n, _from + {PER_PIECE}L) - 1))"))
    return numbered.withColumn("copies", F.expr(row_copies("_row"))).drop("_from", "_row")


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; rows taken 0 times go.

    All columns of ``docs`` stay, whatever their names. Null ids, texts and sources are values like
    others. Rows that agree in source, id and number of words are numbered, in chunks that no
    repeated row outgrows, and the first of them may be taken once more than the others.
    """
    size, s, i, z, n, total, number = free_names(docs.columns, "size", "s", "id", "z", "n", "total", "number")
    plan = copies(docs.select("doc_id", "text", "source"), **options).where("total > 0").select(
        F.col("source").alias(s), F.col("doc_id").alias(i), F.col("size").alias(z), F.col("n").alias(n), F.col("total").alias(total)
    )
    plan = materialise(plan)
    sized = docs.withColumn(size, F.size(F.expr(words_sql("text"))).cast("long"))
    same = F.col("source").eqNullSafe(F.col(s)) & F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(size) == F.col(z))
    names = [f"`{c}`" for c in docs.columns]
    single = sized.join(plan.where(F.col(n) == 1), same).selectExpr(*names, f"explode(sequence(1, {total})) as {number}").select(*names)
    lines = plan.where(F.col(n) > 1)
    if lines.isEmpty():
        return single
    rows = materialise(sized.join(lines, same).withColumn(f"{number}_", F.monotonically_increasing_id()))
    numbered = gapless(rows, number, [s, i, z], [f"{number}_"])
    taken = F.expr(row_copies(number, n, total))
    more = numbered.withColumn(total, taken).where(F.col(total) > 0)
    return single.unionByName(more.selectExpr(*names, f"explode(sequence(1, {total})) as {number}").select(*names))
