"""Byte-level BPE of whole texts by tree concatenation, and the way back.

A long text is cut into pieces that are encoded apart, each piece a row. Neighbours are then
concatenated pairwise, as a tree. Tokens near a cut may be wrong, so a window around it is encoded
afresh and grown until it agrees with both sides: on the left with the left half's tokens, as far
from the cut as possible, on the right likewise. Tokens that agree on a stretch of text go on
alike in either encoding, since a row of tokens is the encoding of its text exactly if every two
neighbours are the encoding of theirs. A window that covers both halves is right by itself.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import map_slices

#: code points of a piece; a text of up to two pieces is encoded at once
PIECE = 16_384
#: first window, in bytes to each side, and tokens that have to agree
WINDOW, AGREE = 256, 4
#: the pre-tokenizer's split of byte-level BPE, a fixed value
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Codec:
    """Encoder and decoder for a tokenizer file of the ``tokenizers`` library.

    Takes byte-level BPE without normalizer, prefix space or dropout, whose ids follow the order
    of its merges; refuses others.
    """

    def __init__(self, spec: str):
        import tiktoken

        conf = json.loads(spec)
        model, split = conf["model"], conf["pre_tokenizer"]
        plain = model["type"] == "BPE" and not any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        )
        added = conf["added_tokens"]
        exact = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in added)
        if not (plain and exact and conf["normalizer"] is None and split["type"] == "ByteLevel" and not split["add_prefix_space"] and split["use_regex"]):
            raise ValueError("not a plain byte-level BPE file")
        special = {t["content"]: t["id"] for t in added}
        to_byte = self.alphabet()
        ranks = {bytes(to_byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        made = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        order = [model["vocab"][m] for m in made]
        if order != sorted(order):
            raise ValueError("ids do not follow the merges")
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.lengths = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)
        for token, i in special.items():
            self.lengths[i] = len(token.encode())

    @staticmethod
    def alphabet() -> dict[str, int]:
        """The printable stand-ins of byte-level vocabularies: byte -> itself, or the next free above 255."""
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in own]
        return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.bpe.encode(text, allowed_special="all"), np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        return self.bpe.decode_bytes(ids.tolist()).decode("utf-8", "replace")

    def join(self, left: tuple[bytes, np.ndarray], right: tuple[bytes, np.ndarray], window: int = WINDOW) -> tuple[bytes, np.ndarray]:
        """Encoding of two neighbouring texts from theirs."""
        (lb, li), (rb, ri) = left, right
        while lb and rb:
            a, b = max(0, len(lb) - window), min(len(rb), window)
            while a and lb[a] & 0xC0 == 0x80:
                a -= 1
            while b < len(rb) and rb[b] & 0xC0 == 0x80:
                b += 1
            ids = self.encode((lb[a:] + rb[:b]).decode())
            stops = np.cumsum(self.lengths[ids])  # from the window's start
            starts = stops - self.lengths[ids]
            keep, first = (0, 0) if a == 0 else self._left(li, len(lb) - a, ids, starts)
            skip, last = (len(ri), len(ids)) if b == len(rb) else self._right(ri, b, ids, stops - (len(lb) - a))
            if first is not None and last is not None and first <= last:
                return lb + rb, np.concatenate([li[:keep], ids[first:last], ri[skip:]])
            window *= 2
        return lb + rb, np.concatenate([li, ri])

    def _left(self, li, reach, ids, starts):
        """Where the window's tokens first agree with the left half's last ``reach`` bytes."""
        k = min(len(li), reach)
        at = reach - np.cumsum(self.lengths[li[len(li) - k :]][::-1])[::-1]
        _, i, j = np.intersect1d(at, starts, return_indices=True)
        for p, q in zip(i.tolist(), j.tolist()):
            if at[p] >= 0 and p + AGREE <= k and np.array_equal(li[len(li) - k + p :][:AGREE], ids[q : q + AGREE]):
                return len(li) - k + p, q
        return 0, None

    def _right(self, ri, reach, ids, stops):
        """Where they last agree with the right half's first ``reach`` bytes."""
        k = min(len(ri), reach)
        at = np.cumsum(self.lengths[ri[:k]])
        _, i, j = np.intersect1d(at, stops, return_indices=True)
        for p, q in zip(i[::-1].tolist(), j[::-1].tolist()):
            if at[p] <= reach and p + 1 >= AGREE and q + 1 >= AGREE and np.array_equal(ri[p + 1 - AGREE : p + 1], ids[q + 1 - AGREE : q + 1]):
                return p + 1, q + 1
        return 0, None

    def concat(self, parts: list[tuple[bytes, np.ndarray]]) -> np.ndarray:
        """Encoding of the whole text from its pieces', pair by pair, level by level."""
        while len(parts) > 1:
            joined = [self.join(x, y) for x, y in zip(parts[::2], parts[1::2])]
            parts = joined + parts[2 * len(joined) :]
        return parts[0][1]


def _spec(df: DataFrame, path: str):
    """The tokenizer file, read by the driver and sent to the executors; its size is that of a vocabulary."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(
    docs: DataFrame, path: str, text: str = "text", out: str = "ids", decoded: str | None = None, piece: int = PIECE
) -> DataFrame:
    """``docs`` with the ids of every whole text as little-endian unsigned 32-bit integers.

    A null text counts as empty and has no ids. With ``decoded``, a column of that name has the
    ids decoded again by the same worker. Texts of more than two pieces are told apart by their
    SHA-256; copies of one text are encoded once.
    """
    spec = _spec(docs, path)
    docs = docs.drop(*[c for c in (out, decoded, "_key") if c])  # as withColumn would replace them
    long_ = F.coalesce(F.length(text) > 2 * piece, F.lit(False))
    fields = f"`{out}` binary" + (f", `{decoded}` string" if decoded else "")

    def results(codec: Codec, ids: list[np.ndarray]) -> dict[str, list]:
        found: dict[str, list] = {out: [i.astype("<u4").tobytes() for i in ids]}
        return found | ({decoded: [codec.decode(i) for i in ids]} if decoded else {})

    def whole():
        codec = Codec(spec.value)
        return lambda texts: results(codec, [codec.encode(t or "") for t in texts])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, body in zip(batch.column("_key").to_pylist(), batch.column("_text")):
                body = body.as_py()
                cuts = [body[i : i + piece] for i in range(0, len(body), piece)]
                columns = [pa.array([key] * len(cuts)), pa.array(range(len(cuts)), pa.int32()), pa.array(cuts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["_key", "_part", "_piece"])

    def parts():
        codec = Codec(spec.value)
        return lambda texts: {"_ids": [codec.encode(t).astype("<u4").tobytes() for t in texts]}

    made: list[Codec] = []  # one for all groups of a task

    def concat(group: pd.DataFrame) -> pd.DataFrame:
        if not made:
            made.append(Codec(spec.value))
        group = group.sort_values("_part")
        pieces = [(p.encode(), np.frombuffer(i, "<u4")) for p, i in zip(group["_piece"], group["_ids"])]
        found = results(made[0], [made[0].concat(pieces)])
        return pd.DataFrame({"_key": [group["_key"].iloc[0]]} | {k: pd.Series(v, dtype=object) for k, v in found.items()})

    short = map_slices(docs.where(~long_), fields, text, whole)
    rows = docs.where(long_).withColumn("_key", F.sha2(F.col(text), 256))
    pieces = rows.select("_key", F.col(text).alias("_text")).mapInArrow(cut, "_key string, _part int, _piece string")
    pieces = map_slices(pieces.dropDuplicates(["_key", "_part"]), "_ids binary", "_piece", parts, rows=32)
    ids = pieces.groupBy("_key").applyInPandas(concat, f"_key string, {fields}")
    return short.unionByName(rows.join(ids, "_key").drop("_key"))


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids, special tokens included; null for null."""
    spec = _spec(rows, path)

    def back():
        codec = Codec(spec.value)
        return lambda all_: {out: [None if x is None else codec.decode(np.frombuffer(x, "<u4")) for x in all_]}

    return map_slices(rows, f"`{out}` string", ids, back)
