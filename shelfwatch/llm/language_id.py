"""Language by compression: the language whose dictionary makes a text smallest.

Each language has a zstandard raw-content dictionary of sampled text. A text is coded in blocks
with every dictionary, each block as it is and turned by half, as sizes are whole bytes; the sizes
add up, so whole texts count and all sizes are treated alike. The winner is rejected if the
runner-up is nearly as small.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.llm.common import map_slices, materialise

#: per language: sampled texts, code points of each, bytes of dictionary; these bound the model
TEXTS, EXCERPT, DICTIONARY = 150, 1500, 110 * 1024
#: parts in which a language's texts are first reduced
PARTS = 16
LEVEL, BLOCK = 6, 1024
#: the lead, as a share of the runner-up's size, below which a prediction counts as rejected
NARROW = 0.01
#: how fast a lead becomes certainty
SHARPNESS = 60.0
UNDECIDED = "und"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Model:
    """Languages, most frequent first, with their dictionaries."""

    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """Dictionaries from up to TEXTS different texts per language, picked by hash.

    The model is a bounded sample: the first EXCERPT code points of each picked text, DICTIONARY
    bytes per language. Rows without text or language are left out, repeated texts count once.
    Only the excerpts reach the driver. Without rows there is no language to predict.
    """
    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    texts = known.groupBy(F.col(lang).alias("lang"), F.xxhash64(text).alias("h")).agg(
        F.min(doc_id).alias("_id"), F.count(F.lit(1)).alias("n")
    )
    totals = {r["lang"]: r["n"] for r in texts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    # the smallest hashes per part of a language first, so that its final choice is among PARTS * TEXTS rows
    picked = texts.withColumn("_part", F.pmod("h", F.lit(PARTS)))
    for within in (["lang", "_part"], ["lang"]):
        spot = F.row_number().over(Window.partitionBy(*within).orderBy("h"))
        picked = picked.withColumn("_k", spot).where(F.col("_k") <= TEXTS)
    picked = materialise(picked.select("lang", "h", "_id"))  # at most TEXTS rows per language
    found = known.join(F.broadcast(picked), (F.col(doc_id) == F.col("_id")) & (F.xxhash64(text) == F.col("h")) & (known[lang] == picked["lang"]))
    rows = found.select(picked["lang"].alias("l"), "h", F.substring(text, 1, EXCERPT).alias("t")).distinct().collect()
    languages = tuple(sorted(totals, key=lambda k: (-totals[k], k)))
    bodies = {k: b"\n".join(r["t"].lower().encode() for r in sorted(rows, key=lambda r: r["h"]) if r["l"] == k) for k in languages}
    return Model(languages, tuple(bodies[k][:DICTIONARY] for k in languages))


class Classifier:
    def __init__(self, model: Model):
        import zstandard

        self.languages = model.languages
        self.coders = []
        for body in model.dictionaries:
            known = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(body) >= 8 else None
            if known:
                known.precompute_compress(level=LEVEL)
            self.coders.append(
                zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False)
            )

    def sizes(self, text: str) -> np.ndarray:
        body = text.lower().encode("utf-8", "surrogatepass")
        blocks = [body[i : i + BLOCK] for i in range(0, len(body), BLOCK)]
        for b in blocks[:]:
            middle = b.find(b" ", len(b) // 2) + 1 or len(b) // 2
            blocks.append(b[middle:] + b" " + b[:middle])
        return np.array([sum(len(c.compress(b)) for b in blocks) for c in self.coders], np.float64)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, lead); equal sizes go to the more frequent language."""
        if not self.coders or text is None or not _LETTER.search(text):
            return UNDECIDED, 0.0, 0.0
        sizes = self.sizes(text)
        best = int(np.argmin(sizes))
        if len(sizes) == 1:
            return self.languages[0], 1.0, 1.0
        leads = (np.delete(sizes, best) - sizes[best]) / np.delete(sizes, best)
        return self.languages[best], float(1 / (1 + np.exp(-SHARPNESS * leads).sum())), float(leads.min())


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` (a narrow lead, or no letters).

    A null text, and one without letters, is ``und`` with score 0. Equal sizes go to the language
    with more texts. Columns of these names are replaced; repeated rows get the same result; an
    empty table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        one = Classifier(sent.value)
        return lambda texts: dict(zip(("lang_pred", "score", "_lead"), zip(*map(one.predict, texts))))

    done = map_slices(docs, "lang_pred string, score double, _lead double", text, make)
    return done.withColumn("rejected", F.col("_lead") < NARROW).drop("_lead")


def fold(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of
