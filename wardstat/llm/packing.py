"""Best-fit packing into sequences of several permitted lengths (operator 8).

Texts are cut into pieces of at most the largest length; nothing is dropped.
Pieces are dealt by hash to shards of about `shard_pieces`, each packed on
its own by best-fit decreasing: a piece goes to the open sequence with the
least room that holds it. If none does, a sequence of the length is opened
that costs least per token it can expect to hold, given the pieces still to
come, so all lengths are weighed against each other at every opening. At the
end every sequence shrinks to the smallest permitted length that holds its
contents, where that costs less.

The cost of a sequence of L tokens is L + L*L / ATTENTION + OVERHEAD.

A text's length is its number of words `[^\\x20\\x09-\\x0D]+` plus one end
mark, so an empty or null text is one token. Defined results: rows with a
null id are packed like others; repeated rows are packed once each; ties go
by id and piece; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIZES = (256, 512, 1024, 2048, 4096)
ATTENTION, OVERHEAD = 16384, 16
SHARD_PIECES = 20_000


def cost(size: int) -> float:
    """Linear work, attention work and what a sequence costs by itself."""
    return size + size * size / ATTENTION + OVERHEAD


def pack_pieces(lengths: np.ndarray, sizes=SIZES, price: Callable[[int], float] = cost):
    """Sequence, place within it, and final sequence sizes of pieces given in
    descending order of length."""
    sizes = sorted(sizes)
    prices = [price(s) for s in sizes]
    total = np.concatenate([np.cumsum(lengths[::-1])[::-1], [0]])
    descending = -lengths
    rooms: list[int] = []                 # distinct rooms of open sequences, ascending
    at_room: dict[int, list[int]] = {}    # room -> sequences, smallest number on top
    size, used = [], []
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        k = bisect_left(rooms, n)
        if k < len(rooms):
            room = rooms[k]
            b = at_room[room].pop()
            if not at_room[room]:
                del at_room[room]
                rooms.pop(k)
        else:
            best = None
            for s, p in zip(sizes, prices):
                if s >= n:
                    # tokens of later pieces that could share the sequence
                    j = max(i + 1, int(np.searchsorted(descending, -(s - n), "left")))
                    score = p / min(s, n + total[j])
                    if best is None or score < best[0]:
                        best = (score, s)
            b, room = len(size), best[1]
            size.append(room)
            used.append(0)
        bin_of[i], offset[i] = b, used[b]
        used[b] += n
        if room > n:
            if room - n not in at_room:
                insort(rooms, room - n)
                at_room[room - n] = []
            at_room[room - n].append(b)
    table = np.array(sizes)
    fit = table[np.searchsorted(table, np.array(used, np.int64))] if used else np.zeros(0, np.int64)
    return bin_of, offset, np.minimum(fit, np.array(size, np.int64)) if size else fit


def pack(spark: SparkSession, docs: DataFrame, sizes=SIZES, shard_pieces: int = SHARD_PIECES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, n_tokens, doc_offset, bin_id, bin_offset, bin_size: one row per piece."""
    top = max(sizes)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                    (F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1)
                    .cast("long").alias("n"))
    pieces = (d.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / top) - 1)))
              .select("doc_id", "piece", (F.col("piece") * top).alias("doc_offset"),
                      F.least(F.lit(top), F.col("n") - F.col("piece") * top).cast("long").alias("n_tokens")))
    shards = max(1, -(-pieces.count() // shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)))

    def run(key, pdf):
        pdf = pdf.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        b, offset, size = pack_pieces(pdf["n_tokens"].to_numpy(np.int64), sizes)
        return pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "piece": pdf["piece"].to_numpy(),
                             "n_tokens": pdf["n_tokens"].to_numpy(), "doc_offset": pdf["doc_offset"].to_numpy(),
                             "bin_id": (int(key[0]) << 32) + b, "bin_offset": offset, "bin_size": size[b]})

    return dealt.groupBy("shard").applyInPandas(
        run, "doc_id long, piece long, n_tokens long, doc_offset long, bin_id long, bin_offset long, bin_size long")
