"""Best-fit packing: large pieces pair at most twice a bin, small ones fill the tightest gaps."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import id_key, id_out, map_batches, materialize, table, text_of

CAPACITY = 2048
END = 0
VOCABULARY = "byte_bpe_50k.json"


def byte_encoder(path: str) -> tiktoken.Encoding:
    """The byte-level tokenizer of a ``tokenizers`` file, whose merges must be in the order of their ids.

    Printable Latin-1 characters stand for their own byte, the other bytes follow from 256 up.
    The file's added tokens are found in texts, as ``tokenizers`` does.
    """
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    model, added = read["model"], read.get("added_tokens") or []
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        raise ValueError(f"{path}: an added token takes its neighbourhood into account")
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    vocab = model["vocab"]
    if any(vocab[a + b] != 256 + i for i, (a, b) in enumerate(merges)):
        raise ValueError(f"{path}: merges are not in the order of their ids")
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={t["content"]: t["id"] for t in added})


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(id, piece, start, length, ids): the token ids of each text and an end id, cut where longer than ``capacity``.

    ``ids`` are little-endian unsigned 32-bit numbers. Of a cut document all pieces are full but
    the first, which takes the rest. A null text is empty and gives the end id alone.
    """

    def step(batch: pa.RecordBatch, encoder: tiktoken.Encoding) -> dict:
        out: dict[str, list] = {"id": [], "piece": [], "start": [], "length": [], "ids": []}
        for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = np.append(encoder.encode_to_numpy(text, allowed_special="all"), np.uint32(end)).astype("<u4")
            first = len(ids) % capacity or capacity
            for piece, stop in enumerate(range(first, len(ids) + 1, capacity)):
                start = max(0, stop - capacity) if piece else 0
                for name, value in zip(out, (doc, piece, start, stop - start, ids[start:stop].tobytes()), strict=True):
                    out[name].append(value)
        return out

    named = docs.select(id_key().alias("id"), text_of().alias("text"))
    return map_batches(named, "id long, piece int, start long, length long, ids binary", step, lambda: byte_encoder(path), f"encoder {path}")


@dataclass
class Plan:
    """Runs of equal lengths: the items of one length with ranks from ``first`` on, ``per_bin`` to a bin."""

    capacity: int
    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # length, first, bin, per_bin, offset
    placed: dict[int, int] = field(default_factory=dict)
    bins: int = 0

    def put(self, length: int, items: int, at: int, per_bin: int, offset: int) -> None:
        first = self.placed.get(length, 0)
        self.runs.append((length, first, at, per_bin, offset))
        self.placed[length] = first + items

    def open(self, n: int) -> int:
        self.bins += n
        return self.bins - n


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Where the items of each length go, given how many there are.

    Items above a third of the capacity go first: the largest with the largest other one that
    fits, at most two to a bin. The smaller ones follow by falling length, each into the bin
    with the tightest gap, else into a new one. Equal items move together, so the work depends
    on the capacity and not on the number of items.
    """
    plan, left = Plan(capacity), dict(counts)
    gaps: dict[int, list[list[int]]] = {g: [] for g in range(capacity + 1)}  # gap: [first bin, bins]
    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for length in large:
        while left[length]:
            partner = next((p for p in large if p <= min(length, capacity - length) and left[p] > (p == length)), 0)
            n = left[length] // 2 if partner == length else min(left[length], left[partner]) if partner else left[length]
            at = plan.open(n)
            plan.put(length, n, at, 1, 0)
            left[length] -= n
            if partner:
                plan.put(partner, n, at, 1, length)
                left[partner] -= n
            gaps[capacity - length - partner].append([at, n])
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        for gap in range(length, capacity + 1):
            if not left[length]:
                break
            per_bin = gap // length
            if gap == capacity:
                gaps[gap].append([plan.open(bins := -(-left[length] // per_bin)), bins])
            waiting, gaps[gap] = gaps[gap], []
            for at, n in waiting:
                full = min(n, left[length] // per_bin)
                if full:
                    plan.put(length, full * per_bin, at, per_bin, capacity - gap)
                    left[length] -= full * per_bin
                    gaps[gap - per_bin * length].append([at, full])
                rest = left[length] if full < n and left[length] < per_bin else 0
                if rest:
                    plan.put(length, rest, at + full, rest, capacity - gap)
                    left[length] = 0
                    gaps[gap - rest * length].append([at + full, 1])
                if n > full + bool(rest):
                    gaps[gap].append([at + full + bool(rest), n - full - bool(rest)])
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (id, piece, length of 1 to ``capacity``, any others) with ``sequence_id`` and ``offset``.

    The driver sees one count for each length. Items are ranked within their length by a range
    partition over (length, id, piece), which splits the hottest length, and the sizes of its
    parts, at most one row for each part and length.
    """
    order = ["length", "id", "piece"]
    ranged = pieces.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_at", 33)
    sizes = stored.groupBy("length", part.alias("_part")).agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    parts = [r.asDict() for r in sizes.orderBy("length", "_part").collect()]  # at most lengths plus partitions
    counts: dict[int, int] = {}
    for p in parts:
        p["_before"] = counts.get(p["length"], 0)
        counts[p["length"]] = p["_before"] + p["_n"]
    plan = plan_bins(counts, capacity)
    runs = np.array(sorted(plan.runs), np.int64).reshape(-1, 5)
    step_of = 1 + max([0, *counts.values()])
    run_key = runs[:, 0] * step_of + runs[:, 1]
    part_key = np.array([p["_from"] for p in sorted(parts, key=lambda p: p["_from"])], np.int64)
    part_before = np.array([p["_before"] for p in sorted(parts, key=lambda p: p["_from"])], np.int64)
    kinds = dict(pieces.dtypes)
    names = pieces.columns
    schema = ", ".join(f"{n} {'long' if kinds[n] == 'bigint' else kinds[n]}" for n in names)

    def step(batch: pa.RecordBatch) -> dict:
        at, length = batch.column("_at").to_numpy(), batch.column("length").to_numpy()
        own = np.searchsorted(part_key, at, "right") - 1
        rank = at - part_key[own] + part_before[own]
        run = np.searchsorted(run_key, length * step_of + rank, "right") - 1
        _, first, bin_, per_bin, offset = runs[run].T
        return {n: batch.column(n) for n in names} | {
            "sequence_id": bin_ + (rank - first) // per_bin,
            "offset": offset + (rank - first) % per_bin * length,
        }

    return map_batches(stored, f"{schema}, sequence_id long, offset long", step)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Texts are read and encoded once; only digests of the ids travel. Repeated rows are packed
    each; a null id stands last.
    """
    pieces = token_pieces(docs, path or public_tokenizers.path(VOCABULARY), capacity)
    thin = materialize(pieces.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    packed = pack(thin, capacity)
    return packed.select(id_out("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every row of ``documents`` with its sequence and place; a null or empty text is its end id alone.

    Rows that share an id or have none are packed each, equal lengths in the order of id and
    piece; an empty table gives no rows.
    """
    return pack_documents(table(spark, sf_dir, "documents"))
