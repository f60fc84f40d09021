"""Exact nearest codes by Hamming distance: incremental multi-index hashing.

A vector's code is the signs of its coordinates, cut into segments of ``SEGMENT`` bits. Two codes at distance
d agree within d // segments bits in some segment, so once every segment has been searched to radius s all
codes up to distance segments * (s + 1) - 1 are known. Radii grow one by one; a query leaves when its k-th
verified distance is within what is covered, and a round only opens the segment values at exactly its radius.

Equal codes are one entry with their k smallest ids (more can't be in a result), so a vector that very many
rows share costs one entry. Entries live in blocks by segment and by the leading bits of the segment's value;
a block of more than ``BLOCK`` entries is dealt into chunks and queries visit all of them, so no task holds
more, whatever values are frequent. A visit returns at most k rows per query.

Ties go to the smaller id. Defined results: null vectors and vectors of another length have no code, are not
found and find nothing; NaN and 0 count as not positive; null ids are not found and ask nothing; rows of
one id and code are one; with fewer than k rows all are returned; empty tables give no rows;
other input columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contractframe.llm.common import ground, materialize, ship_package

SEGMENT, BLOCK = 16, 8192


def codes(vectors: DataFrame, dims: int, id_column: str, vector_column: str) -> DataFrame:
    """id and code: a bit per coordinate, the first one lowest, in bytes."""
    import pyarrow as pa

    ship_package(vectors.sparkSession)

    def sign(stream):
        for batch in stream:
            flat = batch.column("v").flatten()
            if flat.null_count:
                flat = flat.fill_null(0.0)
            bits = (np.asarray(flat, "float64").reshape(-1, dims) > 0).astype("uint8")
            packed = np.packbits(bits, axis=1, bitorder="little")
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([r.tobytes() for r in packed], pa.binary())], names=["id", "code"])

    usable = ground(vectors, id=F.col(id_column).cast("bigint"), v=F.col(vector_column).cast("array<double>"))
    usable = usable.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") == dims))
    return usable.mapInArrow(sign, "id bigint, code binary").distinct()


def _entries(coded: DataFrame, k: int, rows: int) -> DataFrame:
    """code and its k smallest ids; first within salted parts of a code, then over them."""
    salt = F.pmod(F.xxhash64("id"), F.lit(1 + rows // 100_000))
    salted = coded.withColumn("_salt", salt)
    for keys in (["code", "_salt"], ["code"]):
        order = Window.partitionBy(*keys).orderBy("id")
        salted = salted.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")
    return salted.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def _segment(code: str, j):
    """Value of segment j: two bytes of the code."""
    pair = F.substring(code, 2 * j + 1, 2)
    return F.conv(F.hex(pair), 16, 10).cast("int")


def _visit(k: int, radius: int):
    """Of the entries of a block at ``radius`` from each query in this segment, each query's k nearest."""
    import pyarrow as pa

    def meet(key, asked, held):
        out = ([], [], [])
        if asked.num_rows and held.num_rows:
            segment = held.column("value").to_numpy()
            order = np.argsort(segment, kind="stable")
            values, first = np.unique(segment[order], return_index=True)
            ends = np.append(first[1:], len(order))
            matrix = np.frombuffer(b"".join(held.column("code").to_pylist()), "uint8").reshape(held.num_rows, -1)
            ids = held.column("ids").to_pylist()
            for query, code, value in zip(asked.column("query").to_pylist(), asked.column("qcode").to_pylist(), asked.column("qvalue").to_pylist()):
                opened = np.flatnonzero(np.bitwise_count(values ^ value) == radius)
                if not len(opened):
                    continue
                rows = np.concatenate([order[first[i] : ends[i]] for i in opened])
                distance = np.bitwise_count(matrix[rows] ^ np.frombuffer(code, "uint8")).sum(axis=1, dtype="int64")
                if len(rows) > k:  # every entry has an id, so only entries up to the k-th distance count
                    near = distance <= np.partition(distance, k - 1)[k - 1]
                    rows, distance = rows[near], distance[near]
                found = sorted((d, i) for d, r in zip(distance.tolist(), rows) for i in ids[r])[:k]
                out[0].extend([query] * len(found))
                out[1].extend(i for _, i in found)
                out[2].extend(d for d, _ in found)
        return pa.table({"query": pa.array(out[0], pa.binary()), "id": pa.array(out[1], pa.int64()), "distance": pa.array(out[2], pa.int64())})

    return meet


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, dims: int = 64, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), id, distance: each query's k nearest rows, its own among them if it is one."""
    if dims % SEGMENT:
        raise ValueError(f"dims must be a multiple of {SEGMENT}")
    segments = dims // SEGMENT
    spark = vectors.sparkSession
    coded = materialize(codes(vectors, dims, id_column, vector_column), "codes")
    entries = materialize(_entries(coded, k, coded.count()), "entries")
    asked = materialize(codes(queries, dims, id_column, vector_column), "queries")
    leading = min(SEGMENT, max(0, math.ceil(math.log2(max(1, entries.count()) / BLOCK))))

    parts = F.array(*[F.struct(F.lit(j).alias("j"), _segment("code", j).alias("value")) for j in range(segments)])
    lead = F.shiftright("value", SEGMENT - leading)
    spread = entries.select("code", "ids", F.explode(parts).alias("s")).select("code", "ids", "s.*").withColumn("lead", lead)
    sizes = spread.groupBy("j", "lead").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    sizes = materialize(sizes.select(F.col("j").alias("_j"), F.col("lead").alias("_lead"), "chunks"), "blocks")
    in_block = (F.col("j") == F.col("_j")) & (F.col("lead") == F.col("_lead"))
    held = spread.join(sizes, in_block).select("j", "lead", F.pmod(F.xxhash64("code"), "chunks").cast("int").alias("chunk"), "value", "code", "ids")
    held = materialize(held, "index")

    open_ = asked.select(F.col("code").alias("query")).distinct()
    best = spark.createDataFrame([], "query binary, id bigint, distance bigint")
    done = None
    for radius in range(SEGMENT + 1):
        probes = open_.select("query", F.explode(F.array(*[F.struct(F.lit(j).alias("j"), _segment("query", j).alias("qvalue")) for j in range(segments)])).alias("s")).select("query", "s.*")
        # Blocks whose leading bits are within the radius; the rest of the value may differ too.
        apart = F.bit_count(F.shiftright("qvalue", SEGMENT - leading).bitwiseXOR(F.col("_lead")))
        visits = probes.join(sizes, (F.col("j") == F.col("_j")) & (apart <= radius) & (apart >= radius - (SEGMENT - leading)))
        visits = visits.select("query", F.col("query").alias("qcode"), "qvalue", "j", F.col("_lead").alias("lead"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        met = visits.groupBy("j", "lead", "chunk").cogroup(held.groupBy("j", "lead", "chunk")).applyInArrow(_visit(k, radius), "query binary, id bigint, distance bigint")
        ranked = best.unionByName(met).distinct().withColumn("_r", F.row_number().over(Window.partitionBy("query").orderBy("distance", "id")))
        ranked = materialize(ranked.where(F.col("_r") <= k), "nearest")
        covered = segments * (radius + 1) - 1
        # Within what is covered, the k-th distance is final, and so is every smaller one.
        final = ranked.where((F.col("_r") == k) & (F.col("distance") <= covered)).select("query")
        left = materialize(open_.join(final, "query", "left_anti"), "open-queries")
        settled = ranked.join(left, "query", "left_anti").select("query", "id", "distance")
        done = settled if done is None else done.unionByName(settled)
        best, open_ = ranked.join(left, "query", "left_semi").select("query", "id", "distance"), left
        if open_.isEmpty():
            break
    done = done.unionByName(best)
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
    results = materialize(done.select("query", rank.alias("rank"), "id", "distance"), "results")
    owners = asked.select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    return owners.join(results, "query").select("query_id", "rank", "id", "distance")
