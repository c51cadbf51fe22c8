"""Near copies by b-bit MinHash.

Each text becomes a set of word shingles; the set gives minima under many hash functions, of
which the low bits are packed and groups of whole minima are banded. Texts that share a band
are candidates, the packed bits estimate their similarity (corrected for chance collisions),
and those that come near the threshold are confirmed on their full sets.

No bucket lists its pairs. Equal sets are one class first. Every class of a bucket is compared
with the bucket's smallest class only; the links found this way give components. What is left,
classes that share a bucket but not a component, is compared in blocks of bounded size.

Null and empty texts, and texts without words, have no shingles and are linked with nothing.
A null id is linked with nothing and kept. Rows that repeat an id are documents of their own, told apart by their
texts; a component is named after the smallest id among its rows. Empty tables give empty results; other columns
of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import arrays
from millrace.llm.shared import prepared, stored, unused

BANDS = 32
ROWS = 5
BITS = 4
MARGIN = 0.15
"""Estimates this far below the threshold are still confirmed: over four standard errors."""
BLOCK = 256
"""Classes that one task compares with as many others."""

_A = (arrays.factors(BANDS * ROWS, 11) >> np.uint64(31)).astype(np.uint32) | np.uint32(1)
_B = (arrays.factors(BANDS * ROWS, 12) >> np.uint64(32)).astype(np.uint32)
_BAND_FACTORS = arrays.factors(ROWS, 13)
_PACK = np.uint64(1) << (np.arange(16, dtype=np.uint64) * np.uint64(BITS))


def _minima(shingles: np.ndarray) -> np.ndarray:
    x = shingles.astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for begin in range(0, len(x), 2048):
        np.minimum(least, (_A[:, None] * x[begin: begin + 2048] + _B[:, None]).min(axis=1), out=least)
    return least


def _signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed low bits and band keys."""
    least = _minima(shingles).astype(np.uint64)
    low = (least & np.uint64((1 << BITS) - 1)).reshape(-1, 16)
    packed = (low * _PACK).sum(axis=1, dtype=np.uint64)
    bands = (least.reshape(BANDS, ROWS) * _BAND_FACTORS).sum(axis=1, dtype=np.uint64)
    bands = arrays.mix(bands + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return packed.view(np.int64), bands.view(np.int64)


def text_shingles(column: pa.Array, width: int) -> list[np.ndarray]:
    data, offsets = arrays.flat(column)
    data = arrays.lower_ascii(data)
    starts, ends, text = arrays.word_spans(data, offsets)
    return arrays.shingles(arrays.span_hashes(data, starts, ends), text, len(column), width)


def signatures(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark of the text, n_shingles, digest of the set, packed bits, band keys) of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(batches, "text"):
            counts, digests, packed, bands = [], [], [], []
            for found in text_shingles(piece.column("text"), width):
                counts.append(len(found))
                if len(found):
                    low, keys = _signature(found)
                    digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    packed.append(low)
                    bands.append(keys)
                else:
                    digests.append(None)
                    packed.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("mark"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(packed, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                ["id", "mark", "n_shingles", "digest", "packed", "bands"])

    return _texts(docs, id_col, text_col).mapInArrow(
        work, "id bigint, mark bigint, n_shingles bigint, digest binary, packed array<bigint>, bands array<bigint>")


def _mark(text_col: str) -> Column:
    """Tells apart the texts of rows that share an id."""
    return F.xxhash64(F.col(text_col).cast("string"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), _mark(text_col).alias("mark"), F.col(text_col).cast("string").alias("text"))


def estimate(left: Column, right: Column) -> Column:
    """Similarity from the packed low bits, corrected for minima that agree by chance."""
    ones = F.lit(0x1111111111111111)

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(ones))

    total = BANDS * ROWS
    same = F.lit(total) - F.aggregate(F.zip_with(left, right, unequal), F.lit(0), lambda s, n: s + n)
    chance = 1.0 / (1 << BITS)
    return (same / F.lit(float(total)) - chance) / (1.0 - chance)


def _sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(id, members): the full sets of the wanted (rep, id, mark, digest) classes, under their ``rep``.

    Joined by a shuffle at any size: the wanted classes grow with the input.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(batches, "text"):
            found = [s.tobytes() for s in text_shingles(piece.column("text"), width)]
            same = [hashlib.blake2b(f, digest_size=16).digest() == d for f, d in zip(found, piece.column("digest").to_pylist())]
            yield pa.RecordBatch.from_arrays([piece.column("rep"), pa.array(found, pa.binary())], ["id", "members"]).filter(pa.array(same, pa.bool_()))

    joined = texts.join(wanted.hint("merge"), ["id", "mark"]).select("rep", "text", "digest")
    return stored(joined.mapInArrow(work, "id bigint, members binary").dropDuplicates(["id"]))


def _similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether 100 * |intersection| >= percent * |union| of two sorted sets."""
    place = np.searchsorted(left, right)
    both = int((left[np.minimum(place, len(left) - 1)] == right).sum())
    return 100 * both >= percent * (len(left) + len(right) - both)


def _confirm(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose packed bits come near the threshold and whose full sets reach it."""
    side = classes.select("rep", "packed")
    near = stored(
        pairs.join(side.select(F.col("rep").alias("a"), F.col("packed").alias("packed_a")), "a")
        .join(side.select(F.col("rep").alias("b"), F.col("packed").alias("packed_b")), "b")
        .where(estimate(F.col("packed_a"), F.col("packed_b")) >= percent / 100.0 - MARGIN)
        .select("a", "b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, left = [], None, None
            for k in range(batch.num_rows):
                a, raw, other = (batch.column(i)[k] for i in (0, 2, 3))
                if a.as_py() != last:
                    last, left = a.as_py(), np.frombuffer(raw.as_py(), np.uint64)
                keep.append(_similar(left, np.frombuffer(other.as_py(), np.uint64), percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = (near.join(sets.select(F.col("id").alias("b"), F.col("members").alias("members_b")), "b")
            .join(sets.select(F.col("id").alias("a"), F.col("members").alias("members_a")), "a"))
    return stored(full.select("a", "b", "members_a", "members_b").mapInArrow(compare, "a bigint, b bigint"))


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each id of an edge (a, b) can reach.

    Large-star and small-star steps by turns until the edges are stars around the smallest ids;
    each step is an aggregation and a join, so no vertex gathers its neighbours in one place.
    """
    links = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    last = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or tuple(mark) == last:
            break
        last = tuple(mark)
        both = links.union(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        # a vertex whose own minimum is itself keeps its larger neighbours through them
        large = large.where("v <> u").distinct()
        large = stored(large.select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u")).distinct())
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.explode(F.array(
            F.struct(F.col("u").alias("v"), F.col("m").alias("u")),
            F.struct(F.col("v").alias("v"), F.col("m").alias("u")))).alias("e")).select("e.v", "e.u")
        links = stored(small.where("v <> u").distinct())
    roots = links.groupBy("v").agg(F.min("u").alias("u"))
    return stored(roots.select(F.col("v").alias("id"), F.col("u").alias("component"))
                  .union(links.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()))


def _rest(members: DataFrame, classes: DataFrame, component: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes that share a bucket but not a component.

    Buckets that hold several components are taken together by the component of their smallest
    class. There the classes of other components ask, all answer, block by block; of a component that
    a class is linked to already, no second link is looked for. Only links come out.
    """
    named = members.join(component.withColumnRenamed("id", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    mixed = (named.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("least"), F.max("component").alias("most"),
                                      F.min_by("component", "rep").alias("main"))
             .where("n > 2 and least <> most").select("key", "main"))
    left = stored(named.join(mixed, "key").select("main", "rep", "component").distinct()
                  .withColumn("asks", F.col("component") != F.col("main")))
    sizes = left.groupBy("main").agg(F.ceil(F.count_if("asks") / BLOCK).cast("int").alias("asking"),
                                     F.ceil(F.count("*") / BLOCK).cast("int").alias("answering"))
    full = (left.join(sizes, "main").join(classes.select("rep", "packed", "bands"), "rep")
            .join(sets.withColumnRenamed("id", "rep"), "rep"))
    draw = F.xxhash64("rep", F.lit(3))
    column = ["main", "rep", "component", "packed", "bands", "members"]
    asks = full.where("asks").select(*column, F.lit(True).alias("asks"), F.pmod(draw, F.col("asking")).cast("int").alias("i"),
                                     F.explode(F.sequence(F.lit(0), F.col("answering") - 1)).alias("j"))
    answers = full.where("asking > 0").select(*column, F.lit(False).alias("asks"),
                                              F.explode(F.sequence(F.lit(0), F.col("asking") - 1)).alias("i"),
                                              F.pmod(draw, F.col("answering")).cast("int").alias("j"))
    least, chance = percent / 100.0 - MARGIN, 1.0 / (1 << BITS)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        ask, answer = rows[rows.asks], rows[~rows.asks]
        out: list[tuple[int, int]] = []
        if len(ask) and len(answer):
            ids, comp = answer["rep"].to_numpy(), answer["component"].to_numpy()
            packed = np.stack(answer["packed"].to_list()).view(np.uint64)
            bands = np.stack(answer["bands"].to_list())
            sets = [np.frombuffer(m, np.uint64) for m in answer["members"]]
            for rep, own, low, keys, raw in zip(ask["rep"], ask["component"], ask["packed"], ask["bands"], ask["members"]):
                d = packed ^ np.asarray(low).view(np.uint64)
                d |= d >> np.uint64(2)
                d = (d | d >> np.uint64(1)) & np.uint64(0x1111111111111111)
                alike = (1.0 - np.bitwise_count(d).sum(axis=1) / (BANDS * ROWS) - chance) / (1 - chance)
                good = np.flatnonzero((comp != own) & (alike >= least) & (bands == np.asarray(keys)).any(axis=1))
                linked, mine = set(), np.frombuffer(raw, np.uint64)
                for k in good[np.argsort(-alike[good], kind="stable")]:
                    if comp[k] not in linked and _similar(mine, sets[k], percent):
                        linked.add(comp[k])
                        out.append((min(rep, ids[k]), max(rep, ids[k])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return stored(asks.unionByName(answers).groupBy("main", "i", "j").applyInPandas(compare, "a bigint, b bigint").distinct())


def _linked(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, n_shingles, root, component_id) of every row; ``root`` names the component and is null for rows without one."""
    prepared(docs.sparkSession)
    signed = stored(signatures(docs, width, id_col, text_col))
    # classes are numbered once, in the stored table: ids may repeat, so they name none
    classes = stored(
        signed.where("n_shingles > 0 and id is not null").groupBy("digest")
        .agg(F.min(F.struct("id", "mark")).alias("least"), F.min_by("packed", "id").alias("packed"), F.min_by("bands", "id").alias("bands"))
        .withColumn("rep", F.monotonically_increasing_id()))
    spread = classes.select("rep", F.explode("bands").alias("key"))
    heads = spread.groupBy("key").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = stored(spread.join(heads, "key"))
    pairs = members.where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct()
    wanted = classes.select("rep", "least.id", "least.mark", "digest").join(members.select("rep").distinct(), "rep", "left_semi")
    sets = _sets(_texts(docs, id_col, text_col), wanted, width)
    component = components(_confirm(pairs, classes, sets, percent))
    more = _rest(members.select("key", "rep"), classes, component, sets, percent)
    if not more.isEmpty():
        component = components(more.union(component.select(F.col("component").alias("a"), F.col("id").alias("b"))))
    rooted = stored(classes.select("digest", "rep", "least.id").join(component.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "digest", "id", F.coalesce("component", "rep").alias("root")))
    named = rooted.select("digest", "root").join(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "root")
    out = signed.select("id", "mark", "n_shingles", "digest").join(named, "digest", "left")
    return out.select("id", "mark", "n_shingles", F.when(F.col("id").isNotNull(), F.col("root")).alias("root"),
                      F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def near_copies(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row.

    Documents are linked where 100 * |intersection| >= percent * |union| of their sets of
    ``width``-word shingles; ``component_id`` is the smallest id that can be reached.
    """
    return _linked(docs, width, percent, id_col, text_col).select("id", "n_shingles", "component_id").withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id")))


def without_copies(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, that of its smallest id; documents without words or id stay.

    Rows are told apart by id and text, so an unlike text under a repeated id stays.
    """
    rows = stored(_linked(docs, width, percent, id_col, text_col).where("root is not null").groupBy("root", "id", "mark").agg(F.count("*").alias("n")))
    first = rows.groupBy("root").agg(F.min(F.struct("id", "mark")).alias("first"))
    name = {c: unused(docs, f"_{c}") for c in ("id", "mark")}
    judged = rows.join(first, "root").withColumn("stays", F.struct("id", "mark") == F.col("first"))
    gone = stored(judged.where(~F.col("stays")).select(F.col("id").alias(name["id"]), F.col("mark").alias(name["mark"])).distinct())
    same = (F.col(f"`{id_col}`").cast("bigint") == F.col(name["id"])) & (_mark(f"`{text_col}`") == F.col(name["mark"]))
    left = docs.join(gone, same, "left_anti")
    again = judged.where("stays and n > 1").select(F.col("id").alias(name["id"]), F.col("mark").alias(name["mark"]))
    if again.isEmpty():
        return left
    # equal rows: one of each
    again = stored(again.distinct())
    once = docs.join(again, same, "inner").dropDuplicates([name["id"], name["mark"]]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return left.join(again, same, "left_anti").unionByName(once)
