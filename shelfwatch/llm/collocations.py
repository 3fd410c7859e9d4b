"""Phrase collocations: relations of sorted occurrences, joined with themselves level by level.

Texts are cut into pieces and words. The occurrences of one language are written in blocks of
about ``BLOCK`` words, sorted by piece and position; a relation of phrases of k words has, per
position, the phrase that starts there. Level k + 1 merge-joins level k with itself on piece and
adjacent position (both sides are sorted, so a position meets the next one), counts the groups over
all blocks, and keeps the occurrences of frequent groups only by a semi-join with them (both by one exchange). A phrase is
known by the pair of k-word phrases that begin and end it, so each level joins and counts two ids.

Words are told apart by their text, phrases by ids given to frequent ones; nothing is hashed. The
tables of frequent phrases are joined by Spark, which broadcasts one only if its measured size is
small. Each block reports a phrase once with its count, so a phrase that makes up a third of all
words is one row per block. A row holds one block; no step sees more than one at a time.
"""

from __future__ import annotations

import itertools
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.llm.common import materialise

#: words of one language in a block; a task holds up to three times as many over all languages
BLOCK = 1 << 21
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
CUT = bytes.maketrans(string.ascii_uppercase.encode() + SEPARATORS, string.ascii_lowercase.encode() + b"\n" * len(SEPARATORS))
#: marks the end of a piece; no byte of a UTF-8 text
END = b"\xff"
_GAP = re.compile(rb"[ \t\n]")


class _Index(dict):
    """Numbers words as they come; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _words(text: str, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in runs of about ``size`` bytes, ``END`` between pieces and at the end."""
    data, at = text.encode("utf-8").translate(CUT), 0
    while at < len(data):
        gap = _GAP.search(data, at + size)
        end = gap.end() if gap else len(data)
        yield data[at:end].replace(b"\n", b" " + END + b" ").split()
        at = end
    yield [END]


def _packed(spots: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(spots.astype("<i4").tobytes())


def _unpacked(spots: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(spots), "<i4")


def occurrences(docs: DataFrame, text: str = "text", lang: str = "lang", block: int = BLOCK) -> DataFrame:
    """(block, lang, words, counts, spots): the words of each block, and where they stand.

    ``spots`` packs the number of the word at each position, from 1, and 0 at the end of a piece.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    schema = "block long, lang string, words array<string>, counts array<long>, spots binary"
    arrow = pa.schema([
        ("block", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())), ("spots", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        held: dict[str, tuple[_Index, list[np.ndarray]]] = {}
        sizes: dict[str, int] = {}

        def full(lang: str) -> pa.RecordBatch:
            index, parts = held.pop(lang)
            del sizes[lang]
            spots = np.concatenate(parts)
            counts = np.bincount(spots, minlength=len(index))
            words = [w.decode("utf-8") for w in itertools.islice(index, 1, None)]
            row = [[next(numbers)], [lang], [words], [counts[1:]], [_packed(spots)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, arrow.types)], schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    if not text:
                        continue
                    if lang not in held:
                        held[lang], sizes[lang] = (_Index(), []), 0
                    index, parts = held[lang]
                    for words in _words(text):
                        parts.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
                        sizes[lang] += len(words)
                    if sizes[lang] >= block:
                        yield full(lang)
                    elif sum(sizes.values()) >= 3 * block:
                        yield full(max(sizes, key=sizes.get))
        for lang in list(held):
            yield full(lang)

    return rows.mapInArrow(run, schema)


def _pairs(ids: np.ndarray, spots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions with a phrase here and one at the next position, and the number of that pair."""
    at = np.flatnonzero((spots[:-1] > 0) & (spots[1:] > 0))
    pairs = spots[at].astype(np.int64)
    pairs -= 1
    pairs *= len(ids)
    pairs += spots[at + 1]
    pairs -= 1
    return at, pairs


def joined(relation: DataFrame) -> DataFrame:
    """(block, a, b, n): adjacent phrases of ``relation`` (block, ids, spots), counted per block."""
    arrow = pa.schema([(c, pa.int64()) for c in ("block", "a", "b", "n")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.column("block")[row].as_py()
                ids = np.asarray(batch.column("ids")[row].values)
                pairs = _pairs(ids, _unpacked(batch.column("spots")[row].as_py()))[1]
                pairs, n = np.unique(pairs, return_counts=True)
                for at in range(0, len(pairs), 65_536):
                    some = pairs[at : at + 65_536]
                    columns = [np.full(len(some), block), ids[some // len(ids)], ids[some % len(ids)], n[at : at + 65_536]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=arrow)

    return relation.mapInArrow(run, "block long, a long, b long, n long")


def _row(block: int, ids: np.ndarray, spots: np.ndarray) -> pa.Table:
    row = {"block": pa.array([block], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())), "spots": pa.array([_packed(spots)], pa.binary())}
    return pa.table(row)


RELATION = "block long, ids array<long>, spots binary"


def frequent_words(blocks: DataFrame, kept: DataFrame) -> DataFrame:
    """The relation of single words: ``blocks`` reduced to the words in ``kept`` (block, spot, id)."""

    def narrow(block: pa.Table, kept: pa.Table) -> pa.Table:
        if not block.num_rows or not kept.num_rows:
            return _row(0, np.array([], np.int64), np.array([], np.int64)).slice(0, 0)
        spots = _unpacked(block.column("spots")[0].as_py())
        ids, order = np.unique(kept.column("id").to_numpy(), return_index=True)
        number = np.zeros(int(spots.max()) + 1, np.int32)
        number[kept.column("spot").to_numpy()[order]] = np.arange(1, len(ids) + 1)
        return _row(block.column("block")[0].as_py(), ids, number[spots])

    return blocks.select("block", "spots").groupBy("block").cogroup(kept.withColumnRenamed("block", "_block").groupBy("_block")).applyInArrow(narrow, RELATION)


def frequent_pairs(relation: DataFrame, kept: DataFrame) -> DataFrame:
    """The next relation: adjacent phrases of ``relation`` that are in ``kept`` (block, a, b, id)."""

    def narrow(block: pa.Table, kept: pa.Table) -> pa.Table:
        if not block.num_rows or not kept.num_rows:
            return _row(0, np.array([], np.int64), np.array([], np.int64)).slice(0, 0)
        before = np.asarray(block.column("ids")[0].values)
        spots = _unpacked(block.column("spots")[0].as_py())
        at, pairs = _pairs(before, spots)
        a, b, ids = (kept.column(c).to_numpy() for c in ("a", "b", "id"))
        wanted = np.searchsorted(before, a) * len(before) + np.searchsorted(before, b)
        order = np.argsort(wanted)
        wanted, number = wanted[order], np.searchsorted(np.sort(ids), ids[order]) + 1
        place = np.minimum(np.searchsorted(wanted, pairs), len(wanted) - 1)
        found = np.zeros(len(spots), np.int32)
        found[at] = np.where(wanted[place] == pairs, number[place], 0)
        return _row(block.column("block")[0].as_py(), np.sort(ids), found)

    return relation.groupBy("block").cogroup(kept.withColumnRenamed("block", "_block").groupBy("_block")).applyInArrow(narrow, RELATION)


def _frequent(rows: DataFrame, by: list[str], least: int) -> DataFrame:
    """``rows`` of groups with at least ``least`` occurrences, with an id of the group; written.

    Counting and semi-join share one exchange: a group has a row per block, and each learns the
    group's sum. One row per group, and no other, has the sum as f.
    """
    group = Window.partitionBy(*by)
    # numbered behind the exchange, which then needn't carry the numbers
    numbered = rows.repartition(*by).withColumn("_m", F.monotonically_increasing_id())
    counted = numbered.withColumns({"_f": F.sum("n").over(group), "id": F.min("_m").over(group)})
    kept = counted.where(F.col("_f") >= least).withColumn("f", F.when(F.col("_m") == F.col("id"), F.col("_f")))
    return materialise(kept.drop("_m", "_f", "n"), "zstd")


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, longest: int = 4, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of 1 to ``longest`` words, and the number of words per language.

    Phrases: (lang, words, f, before, after, most_above). ``before[i]`` and ``after[i]`` count the
    first and the last i + 1 words; ``most_above`` is the highest count of a frequent phrase with
    one more word that begins or ends with this one (null if none). A phrase inside a still longer
    one is inside one of these, which is at least as frequent.
    """
    blocks = materialise(occurrences(docs, text, lang, block))
    spots = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("spot", "w"))
    spots = spots.select("block", "lang", (F.col("spot") + 1).alias("spot"), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    totals = blocks.select("lang", F.expr("aggregate(counts, 0L, (x, y) -> x + y)").alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    words = _frequent(spots, ["lang", "word"], least)
    relation = materialise(frequent_words(blocks, words.select("block", "spot", "id")))
    known = words.where("f is not null").select(
        "id", "lang", F.array("word").alias("words"), "f", F.array("f").alias("before"), F.array("f").alias("after")
    )
    found = []
    for length in range(2, longest + 1):
        pairs = _frequent(joined(relation), ["a", "b"], least)
        groups = pairs.where("f is not null").select("id", "a", "b", "f")
        above = groups.select(F.explode(F.array("a", "b")).alias("id"), "f").groupBy("id").agg(F.max("f").alias("most_above"))
        found.append(known.join(above, "id", "left"))
        first = known.select(F.col("id").alias("a"), "lang", F.col("words").alias("_first"), F.col("before").alias("_before"))
        last = known.select(F.col("id").alias("b"), F.element_at("words", -1).alias("_last"), F.col("after").alias("_after"))
        known = materialise(
            groups.join(first, "a").join(last, "b").select(
                "id", "lang", F.array_append("_first", F.col("_last")).alias("words"), "f",
                F.array_append("_before", F.col("f")).alias("before"), F.array_append("_after", F.col("f")).alias("after"),
            )
        )
        if length < longest:
            relation = materialise(frequent_pairs(relation, pairs.select("block", "a", "b", "id")))
    found.append(known.withColumn("most_above", F.lit(None).cast("long")))
    table = found[0]
    for more in found[1:]:
        table = table.unionByName(more)
    return table.drop("id"), totals


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, longest: int = 4, covered: int = 80, top: int | None = 2000, block: int = BLOCK
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the phrases of 2 to ``longest`` words that stick together best.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line breaks, and those into
    words at blanks and tabs. ``a`` counts a phrase inside pieces, overlaps included, and is
    ``least`` or more. Cut after its first k words it has l and r, the counts of both parts, and
    floor(2000000 a / (l + r)); the lowest counts, ties to the smallest k. A phrase is dropped if a
    longer one that contains it has ``covered`` percent of its count or more. ``n`` is the number
    of words of the language. Ranks go by score and a, descending, then by the phrase's bytes;
    the first ``top`` of each language stay (None: all).

    Null texts have no words, the language null is ``und``. Repeated rows count repeatedly. An
    empty table, or one without frequent phrases, gives no rows. Other columns are left out.
    """
    found, totals = phrases(docs, text, lang, least, longest, block)
    cut = "cast(f as decimal(20, 0)) * 2000000 div cast(l + r as decimal(20, 0))"
    parts = "transform(sequence(1, size(words) - 1), k -> named_struct('k', k, 'l', before[k - 1], 'r', after[size(words) - k - 1]))"
    kept = found.where("size(words) > 1").where(
        f"most_above is null or cast(most_above as decimal(20, 0)) * 100 < cast(f as decimal(20, 0)) * {covered}"
    )
    cuts = kept.withColumn("_cut", F.expr(parts))
    lowest = F.expr(f"array_min(transform(_cut, c -> named_struct('score', {cut.replace('l + r', 'c.l + c.r')}, 'k', c.k, 'l', c.l, 'r', c.r)))")
    scored = cuts.withColumn("_low", lowest).select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "_low.l", "_low.r", "_low.score"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
