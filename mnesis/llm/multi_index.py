"""Exact top-k search in binary codes by incremental multi-index hashing.

A vector's code has a bit for each dimension, set where the value is above zero. Codes are cut into segments of about
log2(n) bits, each with a table from a segment's value to the codes that have it. A query looks into its own buckets
first, then into those at one bit's distance, segment by segment, then at two bits' distance, and so on. Every code that
it meets is verified by its whole Hamming distance. Once ``s`` segments have been searched to radius r and the others to
r - 1, each code within s + segments * r - 1 bits has been met (the others differ in more bits than that in total), so the
search ends as soon as the k-th verified distance is within this.

Equal codes are one code in the tables with the least k + 1 of its ids, as no more can be answers; Spark keeps just those
on each side of the shuffle. Distinct codes are dealt to shards of about ``SHARD`` by hash; a shard's tables are made once and
written to the shared folder. The distinct codes of the queries travel in blocks of ``BLOCK`` to every shard; a task
reads a shard's tables once for all blocks that it gets and has exact answers for its shard, and the answers of a query's
shards are merged by distance and id.

Defined results: rows without id or vector are neither found nor search; missing or null dimensions are bits of 0; a
query doesn't find its own id; fewer than k other rows give fewer answers; ties go to the lower id; rows that repeat an
id count once; codes may be of any length, shorter ones are filled with 0; an empty table gives an empty table. Other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mnesis.llm.common import settled, shared_folder

#: Codes of a shard, queries of a block, and blocks that read a shard's tables once.
SHARD, BLOCK, TOGETHER = 1 << 18, 1 << 9, 64


def codes(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, code): the code as text of 0 and 1."""
    bits = F.array_join(F.transform(F.col(vector_column), lambda x: F.when(x > 0, F.lit("1")).otherwise(F.lit("0"))), "")
    return vectors.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), bits.alias("code"))


def bit_matrix(texts: list[str], width: int) -> np.ndarray:
    data = np.frombuffer("".join(t.ljust(width, "0") for t in texts).encode(), np.uint8)
    return (data == ord("1")).reshape(len(texts), width) if width else np.zeros((len(texts), 0), bool)


class Tables:
    """The tables of one shard's codes: packed (a row of bits each), cuts (where segments start and end), orders and starts
    of each segment's table, and each code's ids (flat, with their ends)."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays, self.packed, self.cuts = arrays, arrays["packed"], arrays["cuts"]
        widths = np.diff(self.cuts)
        self.segments = [(arrays[f"order{k}"], arrays[f"starts{k}"], int(w)) for k, w in enumerate(widths)]
        self.held, self.ids, self.ends = np.diff(arrays["ends"]), arrays["ids"], arrays["ends"]
        self.flips: dict[tuple[int, int], np.ndarray] = {}

    @classmethod
    def of(cls, bits: np.ndarray, ids: list[list[int]]) -> Tables:
        n, width = bits.shape
        count = max(1, round(width / max(1.0, min(16.0, np.log2(max(n, 2))))))
        cuts = np.linspace(0, width, count + 1).round().astype(int)
        arrays = {"packed": np.packbits(bits, axis=1), "cuts": cuts, "ids": np.array([x for own in ids for x in own], np.int64), "ends": np.cumsum([0, *map(len, ids)])}
        for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            value = bits[:, lo:hi] @ (1 << np.arange(hi - lo))
            arrays[f"order{k}"] = order = np.argsort(value, kind="stable")
            arrays[f"starts{k}"] = np.searchsorted(value[order], np.arange((1 << (hi - lo)) + 1))
        return cls(arrays)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.arrays)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Tables:
        with np.load(io.BytesIO(data)) as arrays:
            return cls(dict(arrays))

    def flip(self, width: int, radius: int) -> np.ndarray:
        if (width, radius) not in self.flips:
            self.flips[width, radius] = np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64)
        return self.flips[width, radius]

    def nearest(self, query: np.ndarray, enough) -> tuple[np.ndarray, np.ndarray]:
        """The codes met and their distances, in no order. enough(codes, distances): the distance within which there are
        as many ids as wanted, or None."""
        packed = np.packbits(query)
        seen = np.zeros(len(self.packed), bool)
        met, far = np.zeros(0, np.int64), np.zeros(0, np.int64)
        values = [int(query[lo:hi] @ (1 << np.arange(hi - lo))) for lo, hi in zip(self.cuts[:-1], self.cuts[1:], strict=True)]
        for radius in range(max(w for _, _, w in self.segments) + 1):
            for s, (order, starts, width) in enumerate(self.segments):
                if radius <= width:
                    bucket = values[s] ^ self.flip(width, radius)
                    lo, size = starts[bucket], starts[bucket + 1] - starts[bucket]
                    at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    found = order[at]
                    found = found[~seen[found]]
                    seen[found] = True
                    met = np.concatenate((met, found))
                    far = np.concatenate((far, np.bitwise_count(self.packed[found] ^ packed).sum(axis=1, dtype=np.int64)))
                covered = s + 1 + len(self.segments) * radius - 1
                within = enough(met, far)
                if (within is not None and within <= covered) or len(met) == len(seen):
                    return met, far
        return met, far


    def answers(self, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k nearest (distance, id), ties by id."""

        def enough(met: np.ndarray, far: np.ndarray) -> int | None:
            if self.held[met].sum() < k:
                return None
            order = np.argsort(far, kind="stable")
            return int(far[order][np.searchsorted(np.cumsum(self.held[met][order]), k)])

        met, far = self.nearest(query, enough)
        within = enough(met, far)
        near = np.flatnonzero(far <= within) if within is not None else np.arange(len(met))
        return sorted((int(far[i]), int(x)) for i in near for x in self.ids[self.ends[met[i]] : self.ends[met[i] + 1]])[:k]


def write_tables(kept: DataFrame, width: int, shards: int) -> DataFrame:
    """(shard, path) of the tables of each shard of (code, ids)."""
    folder = shared_folder(kept.sparkSession, "tables")

    def write(own: pa.Table) -> pa.Table:
        store, path = pafs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        shard = own.column("shard")[0].as_py()
        name = f"{path}/{shard:06d}-{TaskContext.get().taskAttemptId()}.npz"
        own = own.sort_by("code")
        with store.open_output_stream(name, compression=None) as f:
            f.write(Tables.of(bit_matrix(own.column("code").to_pylist(), width), own.column("ids").to_pylist()).to_bytes())
        return pa.table({"shard": pa.array([shard], pa.int32()), "path": pa.array([name]), "folder": pa.array([folder])})

    dealt = kept.withColumn("shard", F.pmod(F.xxhash64("code", F.lit(9)), F.lit(shards)).cast("int"))
    return settled(dealt.groupBy("shard").applyInArrow(write, "shard int, path string, folder string"), "shards")


def search(vectors: DataFrame, queries: DataFrame, k: int, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, neighbour_id, distance) of the k nearest ids of each query. vectors, queries: (id, code)."""
    vectors, queries = settled(vectors, "codes"), settled(queries.dropDuplicates(["id"]), "queries")
    width = vectors.agg(F.max(F.length("code"))).first()[0] or 0
    width = max(width, queries.agg(F.max(F.length("code"))).first()[0] or 0)
    least = Window.partitionBy("code").orderBy("id")
    kept = settled(vectors.distinct().withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1).groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "kept")
    wanted = settled(queries.select("code").distinct(), "wanted")
    shards, blocks = max(1, -(-kept.count() // shard)), max(1, -(-wanted.count() // block))
    tables = write_tables(kept, width, shards)
    asked = wanted.groupBy(F.pmod(F.xxhash64("code", F.lit(9)), F.lit(blocks)).cast("int").alias("block")).agg(F.collect_list("code").alias("codes"))
    grid = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(tables, "shard")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, None
        for b in batches:
            for path, folder, texts in zip(*(b.column(c).to_pylist() for c in ("path", "folder", "codes")), strict=True):
                if path != held:
                    with pafs.FileSystem.from_uri(folder)[0].open_input_file(path) as f:
                        held, own = path, Tables.from_bytes(f.read())
                out = [(text, x, d) for text, bits in zip(texts, bit_matrix(texts, width), strict=True) for d, x in own.answers(bits, k + 1)]
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], t) for n, t in enumerate((pa.string(), pa.int64(), pa.int32()))], ["code", "neighbour_id", "distance"])

    # a task's blocks of one shard follow each other
    near = grid.repartition("shard", F.floor(F.col("block") / TOGETHER)).sortWithinPartitions("shard").select("path", "folder", "codes").mapInArrow(answer, "code string, neighbour_id long, distance int")
    merged = Window.partitionBy("code").orderBy("distance", "neighbour_id")
    best = near.withColumn("n", F.row_number().over(merged)).where(F.col("n") <= k + 1).groupBy("code").agg(F.sort_array(F.collect_list(F.struct("distance", "neighbour_id"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x.neighbour_id != F.col("query_id")), 1, k)
    found = queries.withColumnRenamed("id", "query_id").join(best, "code").select("query_id", F.posexplode(others).alias("at", "x"))
    return found.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.neighbour_id").alias("neighbour_id"), F.col("x.distance").alias("distance"))


#: DuckDB's SQL for the search over embeddings, every id that 100 divides as a query, k = 10.
SQL = """
WITH v AS (SELECT DISTINCT vec_id AS id, list_transform(embedding, lambda x: coalesce(x > 0, false)) AS bits FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
d AS (SELECT q.id AS query_id, v.id AS neighbour_id,
        CAST(list_sum(list_transform(list_zip(q.bits, v.bits), lambda z: CAST(z[1] <> z[2] AS INTEGER))) AS INTEGER) AS distance
      FROM v q JOIN v ON q.id % 100 = 0 AND q.id <> v.id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank FROM d)
SELECT query_id, rank, neighbour_id, distance FROM r WHERE rank <= 10
"""
