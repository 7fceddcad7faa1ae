"""N-gram Jaccard join of documents by PartEnum signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evalloom.llm.common import as_bytes, fixed, numbered, portions, settle, settled
from evalloom.llm.graph import components
from evalloom.llm.shingles import (
    OWN, SKETCH, SMALLEST, WORDS, WordHashes, differing, fingerprint, shingle_sets, signatures, sketch, wide_sketch,
)
from evalloom.session import stage, stage_alone

PERCENT = 75
CROWD = 8  # signatures of more documents than this do not make pairs by themselves
ENTRIES = 250_000  # signatures of a bucket, about
FLUSH = 1_000_000
LEADERS = 3
SETS = "row long, doc_id long, n long, f1 long, f2 long, own int, below int, signed int, sketch array<long>, wide binary"
DEALT = "bucket int, base long, signatures binary, places binary"
MADE = "a long, b long, kind int"


def _sets(texts: list[bytes | None], hashes: WordHashes, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    for a, b in portions(texts):
        yield a, shingle_sets(*hashes([x or b"" for x in texts[a:b]]), width)


def _described(rows: DataFrame, width: int, similarity: float) -> DataFrame:
    names = [x.split()[0] for x in SETS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()),
             pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out: list[list] = [[] for _ in names[2:]]
            for _, sets in _sets(as_bytes(batch.column("text")), hashes, width):
                for found in sets:
                    _, kind = signatures(found, similarity)
                    filled = np.bincount(kind, minlength=3)
                    row = (len(found), *fingerprint(found), int(filled[0]), int(filled[1]), len(kind), sketch(found),
                           wide_sketch(found))
                    for x, y in zip(out, row, strict=True):
                        x.append(y)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"),
                 *(pa.array(x, k) for x, k in zip(out, kinds[2:], strict=True))], names=names,
            )

    return rows.mapInArrow(settled(run), SETS)


def _dealt(rows: DataFrame, width: int, similarity: float, bits: int, crowd: int) -> DataFrame:
    """Signatures in buckets by their first bits: a row holds the next 32 bits of what one task has for one bucket.

    A set that a task has seen is signed once there, since equal sets are joined by their fingerprints. Of a
    signature that many of a task's documents share, the bucket gets enough to see that; the others go to rows
    with a negative bucket, each of a task of its own, which pass through.
    """
    names = [x.split()[0] for x in DEALT.split(", ")]

    def pack(signature: np.ndarray, place: np.ndarray, base: int) -> Iterator[pa.RecordBatch]:
        order = np.argsort(signature, kind="stable")
        signature, place = signature[order], place[order]
        first = np.flatnonzero(np.concatenate([[True], signature[1:] != signature[:-1]]))
        size = np.diff(np.append(first, len(signature)))
        nth = np.arange(len(signature)) - np.repeat(first, size)
        here = nth <= crowd
        bucket = (signature >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(signature), np.int64)
        out: list[list] = [[] for _ in names]
        for keep, negative in ((here, False), (~here, True)):
            s, p, b = signature[keep], place[keep], bucket[keep]
            if not len(s):
                continue
            cuts = np.arange(0, len(s), ENTRIES) if negative else np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            for x, y in zip(cuts, np.append(cuts[1:], len(s)), strict=True):
                number = -1 - (base * 31 + int(x)) % (1 << 30) if negative else int(b[x])
                low = s[x:y] >> np.uint64(32 - bits)
                row = (number, base, low.astype("<u4").tobytes(), p[x:y].astype("<u4").tobytes())
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, base = 0, None
        for batch in batches:
            rows = batch.column("row").to_pylist()
            for a, sets in _sets(as_bytes(batch.column("text")), hashes, width):
                for row, found in zip(rows[a:], sets, strict=False):
                    print_ = fingerprint(found)
                    if len(found) < SMALLEST or print_ in seen:
                        continue
                    if len(seen) < 100_000:
                        seen.add(print_)
                    base = row if base is None else base
                    signature, kind = signatures(found, similarity)
                    held.append((signature, (np.uint32(row - base) << np.uint32(2)) | kind))
                    size += len(signature)
                    if size >= FLUSH:
                        yield from pack(*map(np.concatenate, zip(*held, strict=True)), base)
                        held, size, base = [], 0, None
        if held:
            yield from pack(*map(np.concatenate, zip(*held, strict=True)), base)

    return rows.mapInArrow(settled(run), DEALT)


def _met(dealt: DataFrame, crowd: int) -> DataFrame:
    """Pairs of documents with a signature in common; of crowded signatures the members instead.

    Signatures that only agree in their bucket and 32 more bits make pairs that go later, or a crowd that is none,
    whose members meet elsewhere.
    """

    def run(table: pa.Table) -> pa.Table:
        settle()
        signature, member = [], []
        for base, raw, places in zip(*(table.column(x).to_pylist() for x in ("base", "signatures", "places")), strict=True):
            signature.append(np.frombuffer(raw, "<u4"))
            at = np.frombuffer(places, "<u4").astype(np.int64)
            member.append(((base + (at >> 2)) << 2) | (at & 3))
        s, m = np.concatenate(signature), np.concatenate(member)
        if table.column("bucket")[0].as_py() < 0:
            crowded, pairs = np.ones(len(s), bool), []
        else:
            order = np.argsort(s, kind="stable")
            s, m = s[order], m[order]
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            size = np.diff(np.append(first, len(s)))
            crowded = np.repeat(size > crowd, size)
            pairs = []
            for n in range(2, crowd + 1):
                group = first[size == n]
                if len(group):
                    rows = np.sort(m[group[:, None] + np.arange(n)] >> 2, axis=1)
                    i, j = np.triu_indices(n, 1)
                    pairs.append(np.stack([rows[:, i].ravel(), rows[:, j].ravel()]))
        both = np.unique(np.concatenate(pairs, axis=1), axis=1) if pairs else np.empty((2, 0), np.int64)
        both = both[:, both[0] != both[1]]
        n, k = both.shape[1], int(crowded.sum())
        return pa.table({
            "a": pa.array(np.concatenate([both[0], m[crowded] >> 2])),
            "b": pa.array(np.concatenate([both[1], np.zeros(k, np.int64)]), mask=np.arange(n + k) >= n),
            "kind": pa.array(np.concatenate([np.zeros(n, np.int64), m[crowded] & 3]).astype(np.int32)),
        })

    return dealt.groupBy("bucket").applyInArrow(run, MADE)


def _possible(percent: int) -> Column:
    """Whether sizes and sketches of two sets leave it open that they are similar."""
    size = (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
    differ = sum(
        (F.bit_count(F.col("a_sketch")[i].bitwiseXOR(F.col("b_sketch")[i])) for i in range(1, SKETCH // 64)),
        F.bit_count(F.col("a_sketch")[0].bitwiseXOR(F.col("b_sketch")[0])),
    )
    return size & (differ * (100 + percent) <= (100 - percent) * (F.col("a_n") + F.col("b_n")))


def _with_sketches(pairs: DataFrame, described: DataFrame) -> DataFrame:
    full = described.select("row", "n", "sketch", "wide")
    return pairs.join(full.toDF("a", "a_n", "a_sketch", "a_wide"), "a").join(full.toDF("b", "b_n", "b_sketch", "b_wide"), "b")


def _by_wide_sketch(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose wide sketches, where both sets are large, leave it open that they are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("a_n").to_numpy() + batch.column("b_n").to_numpy()
            keep = [
                a is None or b is None or differing(a, b) * (100 + percent) <= (100 - percent) * n
                for a, b, n in zip(batch.column("a_wide").to_pylist(), batch.column("b_wide").to_pylist(), sizes.tolist(), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "a_n", "b_n", "a_wide", "b_wide").mapInArrow(run, "a long, b long")


def _common(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`a, b`, the sizes of their sets and what these have in common, exactly."""
    both = pairs.join(sets.select(F.col("row").alias("a"), F.col("members").alias("x")), "a").join(
        sets.select(F.col("row").alias("b"), F.col("members").alias("y")), "b"
    ).select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros((3, batch.num_rows), np.int64)
            for i, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                at = np.searchsorted(x, y)
                counts[:, i] = len(x), len(y), int((x[np.minimum(at, len(x) - 1)] == y).sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *map(pa.array, counts)], names=["a", "b", "a_n", "b_n", "common"]
            )

    return both.mapInArrow(settled(run), "a long, b long, a_n long, b_n long, common long")


def _linked(common: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets have a Jaccard similarity of at least `percent`."""
    return common.filter(100 * F.col("common") >= percent * (F.col("a_n") + F.col("b_n") - F.col("common"))).select(
        F.col("a").alias("u"), F.col("b").alias("v")
    )


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """The rarest shingles of each set: similar sets, which share `percent` of the larger, have one in common.

    With each comes the size of the set and how many shingles it alone has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, raw in zip(batch.column("row").to_pylist(), batch.column("members").to_pylist(), strict=True):
                found = np.frombuffer(raw, "<i8")
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row)), pa.array(found), pa.array(np.full(n, n - -(-n * percent // 100) + 1))],
                    names=["row", "shingle", "most"],
                )

    each = sets.select("row", "members").mapInArrow(run, "row long, shingle long, most long")
    often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    whole = W.partitionBy("row")
    kept = each.join(often, "shingle").select(
        "shingle", "row", "most", "often", F.row_number().over(whole.orderBy("often", "shingle")).alias("place"),
        F.count(F.lit(1)).over(whole).alias("n"), F.sum((F.col("often") == 1).cast("long")).over(whole).alias("alone"),
    ).filter("place <= most and often > 1")
    return kept.select(F.col("shingle").alias("signature"), "row", "n", "alone")


def _cell_pairs(cells: DataFrame, classes: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """Pairs of a cell that may be similar, of different components, one of them near the leader.

    With D the shingles in which a set and the leader differ, two sets differ in |Da| + |Db| - 2 |Da & Db| shingles.
    What a set alone has is in its D and in no other one, so |Da & Db| <= min(|Da| - alone_a, |Db| - alone_b). They
    are similar only if `needs` of each is at most `gives` of the other. Most sets that are left need more than any set
    of their cell gives.
    """
    more, less = 100 + percent, 100 - percent
    member = cells.join(classes, cells.row == classes.node, "left").drop("node").withColumnRenamed("component", "class")
    member = member.withColumn("class", F.coalesce("class", "row")).join(
        classes.toDF("leader", "led"), "leader", "left").withColumn("led", F.coalesce("led", "leader"))
    member = stage(member.select(
        "leader", "row", "n", "alone", "near", "class", "led", (more * F.col("apart") - less * F.col("n")).alias("needs"),
        (less * F.col("n") - more * (2 * F.col("alone") - F.col("apart"))).alias("gives"),
    ), "cells")
    most = member.groupBy("leader").agg(F.max("gives").alias("most_given"), F.min("needs").alias("least_needed"))
    open_ = member.filter("class <> led").join(most, "leader").filter("needs <= most_given and least_needed <= gives")
    names = ["row", "class", "n", "alone", "near", "needs", "gives"]
    one = open_.join(info, "row").select(
        "leader", *(F.col(x).alias(f"a_{x}") for x in names[1:]), F.col("sketch").alias("a_sketch"), F.col("row").alias("a"))
    other = member.join(open_.select("leader").distinct(), "leader", "left_semi").join(info, "row").select(
        "leader", "led", *(F.col(x).alias(f"b_{x}") for x in names[1:]), F.col("sketch").alias("b_sketch"), F.col("row").alias("b"))
    # Of two that are both open, each asks: the pair is one in the end.
    return one.join(other, "leader").filter(
        (F.col("a_class") != F.col("b_class")) & (F.col("a_near") | F.col("b_near"))
        & (F.col("a_needs") <= F.col("b_gives")) & (F.col("b_needs") <= F.col("a_gives"))
        & (more * (F.col("a_alone") + F.col("b_alone")) <= less * (F.col("a_n") + F.col("b_n"))) & _possible(percent)
    ).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _group_pairs(groups: DataFrame, classes: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """Pairs of a group that may be similar, of different components."""
    more, less = 100 + percent, 100 - percent
    full = groups.join(classes, groups.row == classes.node, "left").withColumn("class", F.coalesce("component", "row")).join(info, "row")
    a, b = (
        full.select("signature", *(F.col(x).alias(f"{side}_{x}") for x in ("class", "n", "alone", "sketch")), F.col("row").alias(side))
        for side in "ab"
    )
    return a.join(b, "signature").filter(
        (F.col("a") < F.col("b")) & (F.col("a_class") != F.col("b_class"))
        & (more * (F.col("a_alone") + F.col("b_alone")) <= less * (F.col("a_n") + F.col("b_n"))) & _possible(percent)
    ).select("a", "b")


def _crowded(groups: DataFrame, described: DataFrame, sets: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """All links, with those between members of the same large group that the components need.

    A group's leader is the set with the least share of shingles that it alone has: of a family of near copies the one
    that strays least from what they have in common. The groups of a leader are one cell, and each member's set is held
    against the leader's. Members with a third of the union in common with the leader are near: what is similar to one
    of them has (3 * percent - 200) / 300 in common with the leader (Jaccard distances are a metric) and stays in the cell.
    Only pairs without a near member are left to the next leaders of the group, and in the end to the group itself.
    """
    info = described.select("row", "sketch")
    cells = None
    for _ in range(LEADERS):
        classes = components(links)
        state = stage(
            groups.join(classes, groups.row == classes.node, "left")
            .select("signature", "row", "n", "alone", F.coalesce("component", "row").alias("class")), "groups",
        )
        open_ = state.groupBy("signature").agg(
            F.min_by("row", F.struct(F.col("alone") / F.col("n"), "row")).alias("leader"),
            F.min("class").alias("low"), F.max("class").alias("high"),
        ).filter("low < high").select("signature", "leader")
        left = stage(state.join(open_, "signature").filter("row <> leader").drop("class"), "left")
        if left.isEmpty():
            groups = left.select("signature", "row", "n", "alone")
            break
        pairs = left.select(F.col("leader").alias("a"), F.col("row").alias("b")).distinct()
        held = stage(_common(pairs, sets).withColumn("near", 3 * F.col("common") >= F.col("a_n") + F.col("b_n") - F.col("common")), "held")
        links = stage(links.union(_linked(held, percent)), "links")
        guests = held.filter(300 * F.col("common") >= (3 * percent - 200) * (F.col("a_n") + F.col("b_n") - F.col("common"))).select(
            F.col("a").alias("leader"), F.col("b").alias("row"), "near", (F.col("a_n") + F.col("b_n") - 2 * F.col("common")).alias("apart"))
        alone = left.select("leader", "row", "n", "alone").distinct()
        found = stage(guests.join(alone, ["leader", "row"]), "cells")
        cells = found if cells is None else cells.union(found).distinct()
        far = held.filter(~F.col("near")).select(F.col("a").alias("leader"), F.col("b").alias("row"))
        groups = left.join(far, ["leader", "row"], "left_semi").select("signature", "row", "n", "alone")
    if cells is None:
        return links
    classes = stage(components(links), "classes")
    pairs = _cell_pairs(cells, classes, info, percent).union(_group_pairs(groups, classes, info, percent)).distinct()
    pairs = _by_wide_sketch(_with_sketches(pairs, described), percent)
    return stage(links.union(_linked(_common(pairs, sets), percent)), "links")


def near_text(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", width: int = WORDS, percent: int = PERCENT,
    crowd: int = CROWD, entries: int = ENTRIES,
) -> DataFrame:
    """Per document the size of its shingle set and its component: `row, doc_id, n_shingles, component_id, first_row`.

    Two documents link when 100 * |intersection| >= `percent` * |union| of their sets of `width`-word shingles; the
    component's id is the smallest key in it, `first_row` the first row with that key.

    1. Equal sets are one class (128-bit fingerprint); only classes are compared.
    2. Sets meet by PartEnum signatures (see `shingles.signatures`), dealt in buckets. A signature of up to `crowd`
       documents makes pairs. A set with more partitions outside crowded signatures than its limit has met all its
       links that way. The others, families of near copies as a rule, also meet by their rarest shingles.
    3. Pairs are cut by sizes and sketches, which never lose a link, and then judged on the whole sets. Families are
       held against their cleanest members first, and only pairs that this leaves open are looked at (`_crowded`).
    Shingles are 64-bit numbers: two that differ are taken as equal with a chance of about 1e-19 a pair.

    Nulls: a null text, and one without words, has the empty set and links with nothing. A null key may link but
    names no component; a component of null keys alone has a null id. Repeated rows are classes. An empty table
    gives no rows. Other columns are left out.

    `percent` must be so large that sets of fewer than SMALLEST shingles are similar only if they are equal: they have
    no signatures. Sets sign in their own band and the one below, which holds wherever this does.
    """
    if not 100 * (SMALLEST - 1) < percent * SMALLEST <= 100 * SMALLEST:
        raise ValueError(f"percent must be above {100 * (SMALLEST - 1) / SMALLEST:.2f} and at most 100, not {percent!r}")
    similarity = percent / 100
    rows = numbered(fixed(docs), F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    described = stage(_described(rows, width, similarity), "sets")
    named = ["n", "f1", "f2"]
    first = described.filter("n > 0").groupBy(*named).agg(F.min("row").alias("class"))
    classes = stage(described.join(first, named, "left").select("row", F.coalesce("class", "row").alias("class")), "classes")
    moved = classes.filter("row <> class")
    total = described.agg(F.sum("signed")).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, total / entries)))))
    met = stage(_met(_dealt(rows.select("row", "text"), width, similarity, min(bits, 30), crowd), crowd), "met")

    def of_class(df: DataFrame, column: str) -> DataFrame:
        to = moved.select(F.col("row").alias(column), F.col("class").alias("__to"))
        return df.join(to, column, "left").withColumn(column, F.coalesce("__to", column)).drop("__to")

    pairs = of_class(of_class(met.filter("b is not null").select("a", "b").distinct(), "a"), "b")
    pairs = pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = stage(_by_wide_sketch(_with_sketches(pairs, described).filter(_possible(percent)), percent), "pairs")
    # A set may have missed a link if its partitions outside crowded signatures are not more than its limit.
    crowded = met.filter("b is null").groupBy(F.col("a").alias("row")).agg(
        F.sum((F.col("kind") == OWN).cast("int")).alias("own_crowded"),
        F.sum((F.col("kind") != OWN).cast("int")).alias("other_crowded"),
    )
    own = F.floor(F.col("n") * (100 - percent) / percent + 1e-9)
    below = F.floor(2 * F.col("n") * (100 - percent) / (100 + percent) + 1e-9)
    unsure = of_class(
        crowded.join(described, "row").filter(
            (F.col("own") - F.col("own_crowded") <= own)
            | ((F.col("below") > 0) & (F.col("below") - F.col("other_crowded") <= below))
        ).select("row"), "row",
    ).distinct()
    unsure = stage(unsure, "unsure")
    wanted = stage(pairs.select(F.col("a").alias("row")).union(pairs.select("b")).union(unsure).distinct(), "wanted")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [x.tobytes() for _, sets in _sets(as_bytes(batch.column("text")), hashes, width) for x in sets]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.binary())], names=["row", "members"])

    sets = stage(
        rows.select("row", "text").join(wanted, "row", "left_semi").mapInArrow(settled(members), "row long, members binary"), "members"
    )
    links = stage(_linked(_common(pairs, sets), percent), "links")
    groups = _prefixes(sets.join(unsure, "row", "left_semi"), percent)
    links = _crowded(groups, described, sets, links, percent)
    joined = components(links)
    member = classes.join(joined, F.col("class") == F.col("node"), "left").select(
        "row", F.coalesce("component", "class").alias("component")
    ).join(described.select("row", "doc_id", "n"), "row")
    # Rows in order of their key, null keys last.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    smallest = member.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min_by("row", order).alias("first_row"))
    return member.join(smallest, "component").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), "component_id", "first_row"
    )


def one_of_each(docs: DataFrame, *, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The documents, with all their columns, without those that another row of their component stands for.

    Of each component the row of the smallest key stays, of equal keys the first.
    """
    docs = fixed(docs)
    gone = stage_alone(lambda: near_text(docs, text=text, key=key, **options).filter("row <> first_row").select("row"), "gone")
    name = "__row_of_near_text"
    while name in docs.columns:
        name += "_"
    counted = docs.withColumn(name, F.monotonically_increasing_id())
    return counted.join(gone.withColumnRenamed("row", name), name, "left_anti").drop(name)
