"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A text is cut at line breaks and sentence ends, and longer pieces after words, or in runs without
blanks after characters, that their own hash chooses, so that an edit changes few pieces. Each
piece has a digest that carries its own checksum in its last 16 bits, and a digest is added, by
exclusive or, to one cell of each of three tables. Sketches of two versions subtract cell by cell,
which cancels what they share. A cell left with one digest shows it by its checksum; taking it out
of its other cells frees more (peeling), until every differing digest is known.

To keep any text linear, digests are first dealt by their top bits into blocks, as many as the text
needs; the sketch of a text with more blocks folds onto that of one with fewer. The fingerprint is
the sketch of all blocks. Two versions are compared by subtracting their fingerprints. Blocks that
don't peel, as they differ in too much, are tried again from the digests themselves: in finer blocks
and then with larger tables. All of it is SQL on arrays within the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: cells per table of the fingerprint, and of each further attempt; positions use disjoint bits of the digest from bit 16 up
ATTEMPTS = (4, 4, 8)
#: digests of one version per block of the fingerprint, and of both versions per finer block, at most on average
PER_BLOCK, PER_FINE = 12, 2
#: blocks of a fingerprint, as a power of two, at most
MOST_BITS = 20
#: turns of peeling before a block counts as failed
TURNS = 4
#: a piece ends at a line break, or after one of these signs if a blank follows
SENTENCE_ENDS = ".!?"
#: a piece of more code points than this is cut further
LONG_PIECE = 160
#: a word of more code points than this counts as its characters
LONG_WORD = 32
#: one word in so many, or one run of GRAM characters, ends a part; a part has MOST_PARTS words or characters at most
WORDS, CHARS, GRAM, MOST_PARTS = 8, 32, 4, 128
#: rows per bucket of the id order, and buckets at most
PER_BUCKET, MOST_BUCKETS = 2000, 65_536


def _parts(piece: str) -> str:
    """SQL for the parts of one long piece: cut after words and characters whose hash ends in zeros.

    Where a cut falls depends on one word, or the last few characters, alone. Parts without a cut
    for long are cut by count from their start.
    """
    words = f"split({piece}, '(?<= )')"
    tokens = f"filter(flatten(transform({words}, w -> if(length(w) <= {LONG_WORD}, array(w), split(w, '')))), w -> w <> '')"
    gram = ", ".join(f"coalesce(get(t, i - {k}), '')" for k in range(GRAM, 1, -1))
    ends = (
        f"if(length(get(t, i - 1)) = 1, (xxhash64({gram}, get(t, i - 1)) & {CHARS - 1}L) = 0L,"
        f" (xxhash64(get(t, i - 1)) & {WORDS - 1}L) = 0L)"
    )
    starts = f"filter(sequence(0, size(t) - 1), i -> i = 0 or {ends})"
    finer = f"flatten(transform(s, (p, j) -> sequence(p, coalesce(get(s, j + 1), size(t)) - 1, {MOST_PARTS})))"
    cut = "transform(f, (p, j) -> array_join(slice(t, p + 1, coalesce(get(f, j + 1), size(t)) - p), ''))"
    return (
        f"transform(array({tokens}), t -> transform(array({starts}), s ->"
        f" transform(array({finer}), f -> {cut})[0])[0])[0]"
    )


def _checked(top: str) -> str:
    """SQL for a digest: 47 bits of hash, and 16 of their checksum, the last of which is set."""
    return f"(shiftleft({top}, 16) | (cast(hash({top}) as bigint) & 65535L) | 1L)"


def digests(text: str) -> Column:
    """Distinct digests of the text's pieces, ascending; empty pieces and null texts have none."""
    for sign in SENTENCE_ENDS:
        text = f"replace({text}, '{sign} ', '{sign}\n')"
    pieces = f"filter(split({text}, '\n'), p -> p <> '')"
    fine = f"flatten(transform({pieces}, p -> if(length(p) <= {LONG_PIECE}, array(p), {_parts('p')})))"
    tops = f"transform({fine}, p -> shiftrightunsigned(xxhash64(p), 17))"
    return F.expr(f"coalesce(sort_array(transform(array_distinct({tops}), t -> {_checked('t')})), cast(array() as array<bigint>))")


def _hits(key: str, attempt: int, cell: int) -> str:
    """SQL for whether a digest is in that cell; the tables follow each other."""
    width = [c.bit_length() - 1 for c in ATTEMPTS]
    c = ATTEMPTS[attempt]
    table, place = divmod(cell, c)
    at = 16 + 3 * sum(width[:attempt]) + table * width[attempt]
    return f"({key} & {(c - 1) << at}L) = {place << at}L"


def _toggled(keys: str, attempt: int, start: str) -> str:
    """SQL for cells with each of ``keys`` taken in or out; ``start`` gives a cell's value by its number."""
    cells = (
        f"aggregate({keys}, {start.format(i)}, (x, k) -> if({_hits('k', attempt, i)}, x ^ k, x))"
        for i in range(3 * ATTEMPTS[attempt])
    )
    return f"array({', '.join(cells)})"


def _cells(keys: str, attempt: int) -> str:
    return _toggled(keys, attempt, "0L")


def _peel(cells: str, attempt: int) -> str:
    """SQL for the digests peeled out of a subtracted sketch; null if some remain."""
    pure = "array_distinct(filter(st.cells, x -> (x & 1L) = 1L and (x & 65535L) = ((cast(hash(shiftright(x, 16)) as bigint) & 65535L) | 1L)))"
    out = _toggled("pure", attempt, "get(st.cells, {})")
    step = (
        f"transform(array({pure}), pure -> if(size(pure) = 0, struct(st.cells as cells, st.got as got, false as live),"
        f" transform(array({out}), rest -> struct(rest as cells, concat(st.got, pure) as got, exists(rest, x -> x <> 0L) as live))[0]))[0]"
    )
    return (
        f"aggregate(sequence(1, {TURNS}), struct({cells} as cells, cast(array() as array<bigint>) as got, true as live),"
        f" (st, turn) -> if(st.live, {step}, st),"
        " st -> if(forall(st.cells, x -> x = 0L), st.got, cast(null as array<bigint>)))"
    )


def _blocks(keys: str, bits: str, low: str = "0L", shift: str = "63") -> str:
    """SQL for digests dealt by the next ``bits`` bits below ``shift``: one array per block, empty ones too.

    ``low`` has the bits above. A mark per block, the only even numbers, is sorted in front of its digests.
    """
    marks = f"transform(sequence(0L, shiftleft(1L, {bits}) - 1L), b -> {low} | shiftleft(b, {shift} - {bits}))"
    starts = "filter(sequence(0, size(m) - 1), i -> (get(m, i) & 1L) = 0L)"
    cut = "transform(starts, (p, j) -> slice(m, p + 2, coalesce(get(starts, j + 1), size(m)) - p - 1))"
    return f"transform(array(sort_array(concat({keys}, {marks}))), m -> transform(array({starts}), starts -> {cut})[0])[0]"


def _bits(n: str, per: int, least: int) -> str:
    """SQL for how many bits deal ``n`` digests into blocks of ``per`` at most on average."""
    return f"greatest({least}, least({MOST_BITS}, cast(ceil(log2(greatest({n}, 1) / {per})) as int)))"


ROW = 3 * ATTEMPTS[0]


def sketch(keys: str) -> Column:
    """The fingerprint of ascending distinct digests: the cells of all blocks, one after the other."""
    none = f"array_repeat(0L, {ROW})"
    blocks = _blocks("ks", _bits("size(ks)", PER_BLOCK, 0))
    return F.expr(f"transform(array({keys}), ks -> flatten(transform({blocks}, b -> if(size(b) = 0, {none}, {_cells('b', 0)}))))[0]")


def _folded(cells: str, blocks: str) -> str:
    """SQL for a sketch folded to fewer blocks: neighbours are added up."""
    per = f"(size({cells}) div ({ROW} * {blocks}))"
    one = f"aggregate(sequence(0, {per} - 1), 0L, (x, q) -> x ^ get({cells}, cast(((i div {ROW}) * {per} + q) * {ROW} + i % {ROW} as int)))"
    return f"if({per} = 1, {cells}, transform(sequence(0, cast({ROW} * {blocks} as int) - 1), i -> {one}))"


def _again(keys: str, low: str, shift: str) -> str:
    """SQL for the digests that occur once in ``keys``, those of a block of both versions: in finer blocks, then in larger tables.

    Both versions' digests go into one sketch, where shared ones cancel. The attempts all fail only
    if digests share their cells every time; such are compared as they are.
    """
    tries = ", ".join(_peel(_cells("u", k), k) for k in range(1, len(ATTEMPTS)))
    one = f"coalesce({tries}, filter(u, k -> size(filter(u, y -> y = k)) = 1))"
    # one digest is a difference, and two are one or the same: no table is needed
    small = f"case when size(u) < 2 then u when size(u) = 2 then if(get(u, 0) = get(u, 1), cast(array() as array<bigint>), u) else {one} end"
    fine = _blocks("w", _bits("size(w)", PER_FINE, 1), low, shift)
    return f"transform(array({keys}), w -> flatten(transform({fine}, u -> {small})))[0]"


def difference(a: str, b: str, sketch_a: str, sketch_b: str) -> Column:
    """Digests in which two versions differ, recovered from their fingerprints where these peel.

    ``a`` and ``b`` are the versions' ascending digests, used for blocks whose difference is too large.
    """
    blocks = f"(least(size({sketch_a}), size({sketch_b})) div {ROW})"
    bits = "cast(round(log2(n)) as int)"
    less = f"zip_with({_folded(sketch_a, 'n')}, {_folded(sketch_b, 'n')}, (x, y) -> x ^ y)"
    cells = f"slice(z, {ROW} * j + 1, {ROW})"
    both = "concat(get(p, j), get(q, j))"
    retry = _again(both, "shiftleft(cast(j as bigint), 63 - s)", "(63 - s)")
    one = f"if(forall(c, x -> x = 0L), cast(array() as array<bigint>), coalesce({_peel('c', 0)}, {retry}))"
    each = f"flatten(transform(sequence(0, cast(n as int) - 1), j -> transform(array({cells}), c -> {one})[0]))"
    dealt = f"transform(array({_blocks(a, 's')}), p -> transform(array({_blocks(b, 's')}), q -> {each})[0])[0]"
    return F.expr(f"transform(array({blocks}), n -> transform(array({bits}), s -> transform(array({less}), z -> {dealt})[0])[0])[0]")


def likeness(a: str, b: str, sketch_a: str, sketch_b: str) -> Column:
    """Jaccard likeness of two versions, from the sizes of their digests and the recovered difference.

    1 if both are empty.
    """
    both = F.size(a) + F.size(b)
    # bound to a variable: written twice in a branch, the difference would be recovered twice
    found = F.transform(F.array(F.size(difference(a, b, sketch_a, sketch_b))), lambda d: (both - d) / (both + d))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.get(found, F.lit(0)))


def sketch_text(keys: str, cells: str) -> Column:
    """A fingerprint as text: the number of digests, and the cells."""
    return F.expr(f"concat_ws(' ', size({keys}), array_join(transform({cells}, x -> if(x = 0L, '', lower(hex(x)))), '.'))")


def _place(ids: Column, tie: Column, bounds: list[tuple]) -> Column:
    """How many bounds (id, tie) are not above the row's, by halving; null ids are the highest."""
    known = [b for b in bounds if b[0] is not None]
    nulls = [b for b in bounds if b[0] is None]

    def halved(below, n: int) -> Column:
        def step(s: Column, _: Column) -> Column:
            mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
            up = below(mid)
            go = s["lo"] < s["hi"]
            return F.struct(F.when(go & up, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(go & ~up, mid).otherwise(s["hi"]).alias("hi"))

        turns = F.sequence(F.lit(1), F.lit(max(1, n.bit_length())))
        return F.aggregate(turns, F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi")), step, lambda s: s["lo"])

    def fits(part: list[tuple], compare) -> Column:
        return halved(lambda mid: F.coalesce(compare(mid), F.lit(False)), len(part)) if part else F.lit(0)

    first, second = F.lit([b[0] for b in known]) if known else None, F.lit([b[1] for b in known]) if known else None
    third = F.lit([b[1] for b in nulls]) if nulls else None
    plain = fits(known, lambda m: (F.get(first, m) < ids) | ((F.get(first, m) == ids) & (F.get(second, m) <= tie)))
    return F.when(ids.isNotNull(), plain).otherwise(F.lit(len(known)) + fits(nulls, lambda m: F.get(third, m) <= tie))


def with_next(docs: DataFrame, doc_id: str, columns: dict[str, Column], tie: str) -> DataFrame:
    """``docs`` with ``columns``, computed once per row, and ``next_<column>``: of the next row by (doc_id, tie).

    Null ids come last; the first row follows the last. Rows are dealt into ranges of that order,
    whose first keys are known, so a repeated or null id is cut as well; rows with the first key of
    a range are sent to the range before too, and those with the very first key to the last. Rows
    that repeat one id and tie very often are spread: of such equal rows all but some follow
    themselves. One exchange, no join of rows. ``docs`` is read three times.
    """
    ids, ties = F.col(doc_id), F.col(tie)
    order = [ids.asc_nulls_last(), ties]
    keys = docs.select(doc_id, tie)
    rows = keys.count()
    per = max(PER_BUCKET, rows // MOST_BUCKETS)
    n = max(1, rows // per)
    ranged = keys.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id())
    least = ranged.groupBy("_p").agg(F.min(F.struct(ids.isNull().alias("z"), ids.alias("i"), ties.alias("t"))).alias("k"))
    bounds = [(r["k"]["i"], r["k"]["t"]) for r in least.orderBy("k").collect()]  # one per range
    first, bounds = (bounds[0], bounds[1:]) if bounds else (None, [])
    last = len(bounds)
    hot = keys.groupBy(doc_id, tie).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 4 * per)
    hot = [(r[0], r[1], r["_n"]) for r in hot.collect()]  # fewer than a quarter of the ranges

    def same(key: tuple) -> Column:
        return ids.eqNullSafe(F.lit(key[0])) & (ties == F.lit(key[1]))

    dealt = docs.withColumn("_b", _place(ids, ties, bounds).cast("int"))
    self_next = F.lit(False)
    for i, t, times in hot:
        self_next = self_next | (same((i, t)) & (F.pmod(F.monotonically_increasing_id(), F.lit(times // per)) != 0))
    dealt = dealt.withColumn("_self", self_next)
    starts = [b for b in bounds]
    at_start = F.lit(False)
    if starts:
        known = F.array(*[F.struct(F.lit(i).cast(docs.schema[doc_id].dataType).alias("i"), F.lit(t).alias("t")) for i, t in starts])
        here = F.get(known, F.col("_b") - 1)
        at_start = F.coalesce((F.col("_b") > 0) & here["i"].eqNullSafe(ids) & (here["t"] == ties), F.lit(False))
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(last + 1)).cast("int")
    own = F.struct(F.when(F.col("_self"), spread).otherwise(F.col("_b")).alias("bucket"), F.when(F.col("_self"), 3).otherwise(0).alias("place"))
    before = F.struct((F.col("_b") - 1).alias("bucket"), F.lit(1).alias("place"))
    around = F.struct(F.lit(last).alias("bucket"), F.lit(2).alias("place"))
    opens = same(first) if first else F.lit(False)
    places = F.array_compact(F.array(own, F.when(at_start & ~F.col("_self"), before), F.when(opens & ~F.col("_self"), around)))
    dealt = dealt.select(*docs.columns, F.inline(places)).repartition("bucket").withColumns(columns)
    along = Window.partitionBy("bucket").orderBy("place", *order)
    led = dealt.withColumns({f"next_{c}": F.when(F.col("place") == 3, F.col(c)).otherwise(F.lead(c).over(along)) for c in ("body", *columns)})
    return led.where("place in (0, 3)").drop("bucket", "place")


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    ``edited`` is the text whose last half, rounded down, is replaced by as many first code points
    of the next text, or all it has. The next row is that of the next larger id of any type, nulls
    last; rows of one id go by a hash of their texts, and equal rows are interchangeable. A null
    text counts as empty; a table of one row is its own next, an empty one stays empty. Other
    columns are left out.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    rows = with_next(rows.withColumn("h", F.xxhash64("body")), "doc_id", {"own": digests("body")}, "h")
    n = F.length("body")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("body", F.lit(1), n - half), F.substring("next_body", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "own", "next_own")
    rows = rows.withColumn("new", digests("edited"))
    rows = rows.withColumns({f"{c}_cells": sketch(c) for c in ("own", "next_own", "new")})
    return rows.select(
        "doc_id", "n_chars", "edited",
        sketch_text("own", "own_cells").alias("fingerprint"), sketch_text("new", "new_cells").alias("edited_fingerprint"),
        likeness("own", "new", "own_cells", "new_cells").alias("near_edited"),
        likeness("own", "next_own", "own_cells", "next_own_cells").alias("near_next"),
    )
