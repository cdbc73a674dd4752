"""Personal data by bootstrapped contextual extraction.

Identifiers of strict form are the seeds. The words around them are lexical patterns; a
pattern is trusted if enough different known identifiers occur in it and if they are most of
what occurs in it anywhere in the corpus. Looser forms in trusted patterns become known, which
lends trust to further patterns, until nothing new is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.llm import identifiers as I
from pulsemill.llm import words as W
from pulsemill.llm.common import saved, small_batches

LEAST_SUPPORT = 3  # different known identifiers in a pattern
LEAST_CONFIDENCE = 0.5  # their share of all that occurs in it
LEAST_SCORE = 0.8  # of an identifier, from the best pattern on each side
ROUNDS = 5
FILTER_BITS = 24

_SPAN = "array<struct<start:long, kind:int, end:long>>"
_CANDIDATE = ("array<struct<kind:int, value:string, start:long, end:long, seed:boolean, "
              "left1:long, left2:long, right1:long, right2:long>>")
_FOUND = f"row long, doc_id long, spans {_SPAN}, candidates {_CANDIDATE}"
_IDENTIFIER = ["kind", "value"]
_PATTERN = ["kind", "side", "context"]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strict spans of every text, and all seeds and loose forms with their contexts."""
    row = TaskContext.get().partitionId() << 33
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    candidate_type = pa.list_(pa.struct(
        [("kind", pa.int32()), ("value", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()),
         *[(c, pa.int64()) for c in ("left1", "left2", "right1", "right2")]]))
    for batch in batches:
        for part in W.slices(batch, "text"):
            spans, candidates = [], []
            for text in part.column("text").to_pylist():
                strict = I.strict(text) if text else []
                loose = I.loose(text, strict) if text else []
                both = strict + loose
                spans.append(sorted(({"start": s, "kind": k, "end": e} for k, s, e in strict),
                                    key=lambda x: (x["start"], x["kind"])))
                candidates.append([
                    {"kind": k, "value": I.value(k, text[s:e]), "start": s, "end": e, "seed": n < len(strict),
                     "left1": c.left[0], "left2": c.left[1], "right1": c.right[0], "right2": c.right[1]}
                    for n, ((k, s, e), c) in enumerate(zip(both, I.contexts(text, both), strict=True))] if both else [])
            n = part.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + n)), part.column("doc_id"), pa.array(spans, span_type),
                pa.array(candidates, candidate_type)], ["row", "doc_id", "spans", "candidates"])
            row += n


def _edges(candidates: DataFrame) -> DataFrame:
    """Rows (kind, value, side, context, n, seed): how often an identifier occurs in a pattern."""
    patterns = F.explode(F.array(*[
        F.struct(F.lit(side).alias("side"), F.col(f"{side}{i}").alias("context"))
        for side in ("left", "right") for i in (1, 2)]))
    edges = candidates.select(*_IDENTIFIER, "seed", patterns.alias("p")).where("p.context is not null").groupBy(
        *_IDENTIFIER, "p.side", "p.context").agg(F.count("*").alias("n"))
    seeds = candidates.where("seed").select(*_IDENTIFIER).distinct().withColumn("known", F.lit(True))
    return edges.join(seeds, _IDENTIFIER, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def _totals(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """How often each of the patterns' contexts occurs in all texts.

    A bit table of a fixed size keeps most other contexts from being counted.
    """
    wanted = patterns.select("context").distinct()
    slot = F.shiftrightunsigned("context", 64 - FILTER_BITS) + F.lit(1).cast("long")
    pages = wanted.groupBy(F.bitmap_bucket_number(slot).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).toPandas()
    table = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for page, bits in zip(pages.page, pages.bits, strict=True):
        table[(page - 1) * 4096:page * 4096] = np.frombuffer(bits, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                w = W.words(part.column("text"), I.CONTEXT)
                follows = w.text[1:] == w.text[:-1]
                for hashes in (I.single(w.hash), I.double(w.hash[:-1], w.hash[1:])[follows]):
                    bit = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                    hit = hashes[(shared.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1]
                    context, n = np.unique(hit, return_counts=True)
                    yield pa.RecordBatch.from_arrays([W.as_long(context), pa.array(n.astype(np.int64))], ["context", "total"])

    counted = docs.select("text").mapInArrow(count, "context long, total long")
    return counted.groupBy("context").agg(F.sum("total").alias("total")).join(wanted, "context", "left_semi")


def trusted(graph: DataFrame) -> DataFrame:
    """Patterns of the graph and their confidence: the known identifiers' share of all occurrences."""
    return graph.groupBy(*_PATTERN).agg(
        F.count_if("known").alias("support"), F.sum(F.when(F.col("known"), F.col("n"))).alias("hits"),
        F.max("total").alias("total")
    ).where((F.col("support") >= LEAST_SUPPORT) & (F.col("hits") >= LEAST_CONFIDENCE * F.col("total"))).select(
        *_PATTERN, (F.col("hits") / F.greatest("total", "hits")).alias("confidence"))


def extend(graph: DataFrame) -> DataFrame:
    """All identifiers that the graph's patterns lead to from the known ones: (kind, value, score, round)."""
    spark = graph.sparkSession
    learnt = spark.createDataFrame([], "kind int, value string, score double, round int")
    for number in range(1, ROUNDS + 1):
        def best(side: str) -> Column:
            return F.coalesce(F.max(F.when(F.col("side") == side, F.col("confidence"))), F.lit(0.0))

        scored = graph.where("not known").join(trusted(graph), _PATTERN).groupBy(*_IDENTIFIER).agg(
            (1 - (1 - best("left")) * (1 - best("right"))).alias("score"))
        fresh = saved(scored.where(F.col("score") >= LEAST_SCORE).withColumn("round", F.lit(number)), "learnt")
        if fresh.isEmpty():
            break
        learnt = learnt.unionByName(fresh)
        marked = fresh.select(*_IDENTIFIER, F.lit(True).alias("new"))
        graph = saved(graph.join(marked, _IDENTIFIER, "left").withColumn(
            "known", F.col("known") | F.col("new").isNotNull()).drop("new"), "graph")
    return learnt


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in I.KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")


def personal_data(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans of every document, and the identifiers that context has discovered.

    Documents: one row each, as the query's contract names the columns; ``n_learnt`` counts
    the spans that the method adds. A null text is empty, repeated rows and null ids stay.
    Identifiers: (kind, value, score, round). An identifier is known by its digits or its
    lower-cased form, so known ones are found in every spelling. A loose span that touches
    a strict one is left out. Very long texts are scanned whole; a text's spans are in one row.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scanned = saved(texts.mapInArrow(_scan, _FOUND), "scanned")
    candidates = scanned.where(F.size("candidates") > 0).select("row", F.explode("candidates").alias("c")).select(
        "row", "c.*")
    edges = saved(_edges(candidates), "edges")
    patterns = edges.groupBy(*_PATTERN).agg(
        F.count("*").alias("n"), F.count_if("known").alias("seeds")).where(
        (F.col("n") >= LEAST_SUPPORT) & (F.col("seeds") < F.col("n"))).select(*_PATTERN)
    patterns = saved(patterns, "patterns")
    learnt = spark.createDataFrame([], "kind int, value string, score double, round int")
    if not patterns.isEmpty():
        totals = _totals(texts, patterns)
        graph = saved(edges.join(patterns, _PATTERN, "left_semi").join(totals, "context"), "graph")
        learnt = extend(graph)
    known = edges.where("known").select(*_IDENTIFIER).unionByName(learnt.select(*_IDENTIFIER)).distinct()
    more = candidates.where("not seed").join(known, _IDENTIFIER, "left_semi").groupBy("row").agg(
        F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    joined = scanned.select("row", "doc_id", "spans").join(more, "row", "left")
    every = F.sort_array(F.concat("spans", F.coalesce("more", F.array().cast(_SPAN))))
    counts = [_count(k).alias(f"n_{name}") for k, name in enumerate(I.KINDS)]
    return joined.select(
        "doc_id", *counts, F.sha2(_text(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        _text(every).alias("spans"), F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_learnt")), learnt
