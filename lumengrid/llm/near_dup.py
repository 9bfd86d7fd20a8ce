"""Near-duplicate documents by HyperMinHash sketches, confirmed on full shingle sets.

A document's set holds the distinct hashes of its five-word shingles. Documents of one set form a class, and all else is done with
classes. A sketch has REGISTERS buckets (by a hash's high bits), each with the leading zeros and MANTISSA following bits
of its smallest hash. Bands of ROWS registers that agree bring classes together; the Jaccard similarity that their
registers suggest, less the agreement expected by chance (collisions of the compressed registers), is taken as
possible if it is within SIGMAS standard deviations of the threshold. Possible pairs form clusters, and within these links
are confirmed on full sets.

No bucket or cluster of unbounded size is collected or paired off:
- In a bucket of more than FEW classes only pairs with a leader are estimated. A class close to the leader is settled in
  this bucket: by the triangle inequality of the Jaccard distance, whatever it could be linked with is possible for the
  leader too, and so in one cluster with it. The rest is paired off if it is WIDE classes at most, else it gets another
  leader; what is still larger after ROUNDS of this is paired in blocks.
- Clusters of more than UNIT classes are confirmed in blocks that share some hub classes. Classes outside the largest
  component found so are then compared with every block, so that no link between components is lost.

Edge cases: null text, or text without words, has an empty set and is its own component; with fewer words than five, all
words are one shingle; rows that repeat a text are linked; a null doc_id gets its component's least id and is kept only
where there is none; an empty table gives an empty table; other columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .components import connected

REGISTERS, MANTISSA, ROWS, WORDS = 128, 10, 5, 5
BANDS = REGISTERS // ROWS
SIGMAS, FEW, ROUNDS, WIDE, UNIT, HUBS = 5.0, 8, 3, 512, 1024, 4
#: Shingles of a unit of confirmation (8 bytes each), and registers of the finer sketches that spare it most intersections.
UNIT_SHINGLES, FINE = 2_000_000, 512
#: Distance from its leader within which a class is settled, and the standard deviations by which it must surely be so.
SETTLED, SURE = 0.35, 4.0


def sketch(hashes: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Registers of a set of sorted distinct hashes: 0 if the bucket is empty, else leading zeros + 1 and mantissa of its least hash."""
    p = registers.bit_length() - 1
    out = np.zeros(registers, np.uint16)
    if not len(hashes):
        return out
    which = (hashes >> np.uint64(64 - p)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
    rest = hashes[first] << np.uint64(p) | np.uint64((1 << p) - 1)  # ones below, so that a leading one is always found
    # Bits of the whole number, exactly: the halves fit a double.
    high = rest >> np.uint64(32)
    part = np.where(high > 0, high, rest & np.uint64(0xFFFFFFFF))
    top = np.frexp(part.astype(np.float64))[1] - 1 + np.where(high > 0, 32, 0)
    zeros = 63 - top
    follow = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    out[which[first]] = ((zeros + 1).astype(np.uint16) << np.uint16(MANTISSA)) | follow.astype(np.uint16)
    return out


def band_keys(registers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sketches (rows): row and 64-bit key of each band that has a filled register."""
    cut = registers[:, : BANDS * ROWS].reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * common.GOLDEN, cut.shape[:2]).copy()
    for j in range(ROWS):
        key = common.mix(key ^ cut[:, :, j]) + common.GOLDEN
    row, band = np.nonzero(cut.any(axis=2))
    return row, key[row, band].view(np.int64)


def chance(n_a: np.ndarray, n_b: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Probability that the registers of a bucket agree though their least hashes differ, for sets of these sizes."""
    la, lb = np.maximum(n_a, 1)[:, None] / registers, np.maximum(n_b, 1)[:, None] / registers
    k = np.arange(40)[None, :]
    at = lambda x: np.exp(-x * 2.0 ** (-k - 1)) - np.exp(-x * 2.0**-k)
    full = lambda x: 1 - np.exp(-x[:, 0])
    return (at(la) * at(lb)).sum(axis=1) / (full(la) * full(lb)) * 2.0**-MANTISSA


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate of sketches (rows) and the number of buckets it rests on."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    c = chance(n_a, n_b, a.shape[1])
    return np.clip((same / np.maximum(used, 1) - c) / (1 - c), 0, 1), used


def _sets(col: pa.Array) -> tuple[list[np.ndarray], list[int | None]]:
    """Shingle sets and class ids (64-bit hashes of the sets; None if empty)."""
    sets = common.shingle_sets(col, WORDS)
    ids: list[int | None] = []
    with np.errstate(over="ignore"):
        for s in sets:
            if len(s):
                ids.append(int(common.mix(np.array([common.mix(s ^ common.GOLDEN).sum(dtype=np.uint64) + np.uint64(len(s))]))[0].view(np.int64)))
            else:
                ids.append(None)
    return sets, ids


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, cid, sig) of rows (doc_id, text)."""

    def run(batches):
        for batch in batches:
            for part in common.slices(batch, most=1 << 20):
                sets, ids = _sets(part.column(1))
                sig = [sketch(s).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.int64()), pa.array(sig, pa.binary())], names=["doc_id", "n", "cid", "sig"])
        common.release()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, cid long, sig binary")


def _bands(classes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                row, key = band_keys(regs)
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0).take(pa.array(row))], names=["bk", "cid"])
        common.release()

    return classes.select("cid", "sig").mapInArrow(run, "bk long, cid long")


def _estimated(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """pairs (a, b) with possible (could be linked), near (so close that b settles a) and wide (what a settled class links with is), written."""
    threshold = num / den
    sides = [classes.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}")) for x in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = (batch.column(i).to_numpy() for i in (2, 3))
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (4, 5))
            j, used = estimate(a, b, n_a, n_b)
            one = np.sqrt(1 / np.maximum(used, 1))
            fits = den * np.minimum(n_a, n_b) >= num * np.maximum(n_a, n_b)
            possible = fits & (j >= threshold - SIGMAS * np.sqrt(threshold * (1 - threshold)) * one)
            # What a settled class links with is at most SETTLED + 1 - threshold from the leader.
            near = j >= 1 - SETTLED + SURE * np.sqrt(SETTLED * (1 - SETTLED)) * one
            wide = j >= threshold - SETTLED - SURE * 0.5 * one
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(possible), pa.array(near), pa.array(wide)], names=["a", "b", "possible", "near", "wide"])
        common.release()

    return common.written(both.mapInArrow(run, "a long, b long, possible boolean, near boolean, wide boolean"), "estimates")


def _all_pairs(groups: DataFrame, by: list[str]) -> DataFrame:
    """Distinct pairs (a < b) within groups, whose size the caller has bounded."""
    lists = groups.groupBy(*by).agg(F.sort_array(F.collect_set("cid")).alias("c"))
    one = lists.select("c", F.explode("c").alias("a")).select("a", F.explode(F.filter("c", lambda x: x > F.col("a"))).alias("b"))
    return one.distinct()


def _in_blocks(members: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) that span the possible pairs of buckets; one of more than WIDE classes in blocks of about as many, each
    with itself and with every other one. Of a pair of blocks no more links come out than it has classes."""
    of = F.ceil(F.col("size") / WIDE).cast("int")
    blocks = members.select("bk", "cid", of.alias("of"), F.pmod(F.xxhash64("cid", F.lit("block")), of).cast("int").alias("i"))
    dealt = blocks.select("bk", "cid", "i", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("j"))
    dealt = dealt.select("bk", F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y"), "i", "cid").join(classes.select("cid", "n", "sig"), "cid")
    threshold = num / den

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("cid").sort_values("cid")
        regs = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(-1, REGISTERS)
        n, block, cid = pdf["n"].to_numpy(), pdf["i"].to_numpy(), pdf["cid"].tolist()
        root = np.arange(len(cid))
        out = []
        for k in range(len(cid)):
            # Later classes that the block pair is to compare with this one and that no link has joined to it yet.
            rest = np.flatnonzero(root[k + 1 :] != root[k]) + k + 1
            rest = rest[(block[rest] != block[k]) | (pdf["x"].iat[0] == pdf["y"].iat[0])]
            rest = rest[den * np.minimum(n[rest], n[k]) >= num * np.maximum(n[rest], n[k])]
            if len(rest):
                j, used = estimate(np.broadcast_to(regs[k], (len(rest), REGISTERS)), regs[rest], np.full(len(rest), n[k]), n[rest])
                for m in rest[j >= threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))].tolist():
                    if root[m] != root[k]:
                        out.append((cid[k], cid[m]))
                        root[root == root[m]] = root[k]
        return pd.DataFrame(out, columns=["a", "b"])

    return dealt.groupBy("bk", "x", "y").applyInPandas(run, "a long, b long")


def possible_pairs(classes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) that span the clusters of classes that could be linked."""
    rows, found = _bands(classes), []
    for turn in range(ROUNDS + 1):
        mask = F.lit(int(common.mix(np.array([turn], np.uint64)).view(np.int64)[0]))  # class ids are hashes: each turn has its own order of them
        heads = rows.groupBy("bk").agg(F.count("*").alias("size"), F.min(F.col("cid").bitwiseXOR(mask)).bitwiseXOR(mask).alias("leader")).where("size > 1")
        heads = common.written(heads, "buckets")
        members = common.written(rows.join(heads, "bk").select("bk", "cid", "size", "leader"), "members")
        common.discard(heads)
        if turn:
            common.discard(rows)
        pairs = _all_pairs(members.where(F.col("size") <= FEW), ["bk"])
        # A leader first; after that only in buckets that are too large to be paired off.
        few_enough = FEW if turn == 0 else WIDE if turn < ROUNDS else None
        many = members.where(F.col("size") > few_enough) if few_enough else members.limit(0)
        blocks = members.where(F.col("size") > FEW) if not few_enough else members.where((F.col("size") > FEW) & (F.col("size") <= few_enough))
        if turn and not blocks.isEmpty():
            found.append(common.written(_in_blocks(blocks, classes, num, den), "block-links"))
        if many.isEmpty():
            found.append(_estimated(pairs, classes, num, den).where("possible").select("a", "b"))
            common.discard(members)
            break
        led = many.where("cid <> leader").select(F.col("leader").alias("b"), F.col("cid").alias("a")).distinct().select("a", "b")
        got = _estimated(pairs.union(led).distinct(), classes, num, den)
        found.append(got.where("possible or wide").select("a", "b"))
        settled = got.where("near").select(F.col("a").alias("cid"), F.col("b").alias("leader"))
        rest = many.where("cid <> leader").join(settled, ["cid", "leader"], "left_anti").select("bk", "cid")
        rows = common.written(rest, "unsettled")
        common.discard(members)
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out


def _linked(cids: list[int], sets: list[np.ndarray], labels: list[int], num: int, den: int) -> list[tuple[int, int]]:
    """Links that join the given labels, each confirmed on the full sets; pairs already joined are passed over, and, in
    larger units, pairs whose finer sketches are SIGMAS deviations from the threshold."""
    order = np.argsort([len(x) for x in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    root = np.unique([labels[i] for i in order], return_inverse=True)[1].copy()
    fine = np.stack([sketch(sets[i], FINE) for i in order]) if len(order) > 64 else None
    threshold = num / den
    out = []
    for k in range(1, len(order)):
        first = int(np.searchsorted(sizes[:k] * den, num * sizes[k]))  # shorter ones are too short
        rest = np.arange(first, k)[root[first:k] != root[k]]
        if fine is not None and len(rest):
            mine = fine[k]
            used = ((fine[rest] != 0) | (mine != 0)).sum(axis=1)
            same = ((fine[rest] == mine) & (mine != 0)).sum(axis=1)  # chance agreement only raises it
            rest = rest[same >= used * threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) * used)]
        big = sets[order[k]]
        for m in rest.tolist():
            if root[m] == root[k]:
                continue
            small = sets[order[m]]
            both = int((big[np.minimum(np.searchsorted(big, small), len(big) - 1)] == small).sum())
            if den * both >= num * (len(big) + len(small) - both):
                out.append((cids[order[k]], cids[order[m]]))
                root[root == root[m]] = root[k]
    return out


def _confirm(units: DataFrame, by: list[str], num: int, den: int) -> DataFrame:
    """Confirmed links (a, b) of units: rows (by..., cid, label, body)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("cid")
        sets = [np.frombuffer(x, np.uint64) for x in pdf["body"]]
        out = pd.DataFrame(_linked(pdf["cid"].tolist(), sets, pdf["label"].tolist(), num, den), columns=["a", "b"])
        if len(pdf) > 256:
            del sets
            common.release()
        return out

    return units.groupBy(*by).applyInPandas(run, "a long, b long")


def _bodies(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, body): the full sets of the wanted classes (cid, doc_id of one document)."""

    def run(batches):
        for batch in batches:
            for part in common.slices(batch, most=1 << 20):
                sets, ids = _sets(part.column(0))
                keep = [i for i, (got, want) in enumerate(zip(ids, part.column(1).to_pylist(), strict=True)) if got == want]
                yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in keep], pa.int64()), pa.array([sets[i].tobytes() for i in keep], pa.binary())], names=["cid", "body"])
        common.release()

    want = common.bounded(wanted.select(F.col("doc_id").alias("want_id"), "cid"))
    return docs.join(want, F.col("doc_id").eqNullSafe(F.col("want_id"))).select("text", "cid").mapInArrow(run, "cid long, body binary")


def link_classes(docs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """(node, label) of the classes that are linked with others."""
    with common.tables(docs.sparkSession) as keep:
        clusters = connected(possible_pairs(classes, num, den))
        keep(clusters)
    placed = clusters.select(F.col("node").alias("cid"), F.col("label").alias("cluster")).join(classes.select("cid", "doc_id", "n"), "cid")
    sizes = placed.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / (UNIT - HUBS)), F.ceil(F.sum("n") / UNIT_SHINGLES)).cast("int").alias("of"))
    placed = common.written(placed.join(sizes, "cluster"), "clusters")
    common.discard(clusters)
    bodies = _bodies(docs, placed.select("doc_id", "cid"))
    full = common.written(placed.join(bodies, "cid").select("cid", "cluster", "of", F.col("cid").alias("label"), "body"), "sets")
    links = _confirm(full.where("of = 1"), ["cluster"], num, den)
    large = full.where("of > 1")
    if not large.isEmpty():
        rank = Window.partitionBy("cluster").orderBy(F.xxhash64("cid"), "cid")
        hubs = placed.where("of > 1").withColumn("r", F.row_number().over(rank)).where(F.col("r") <= HUBS).select("cid")
        block = F.pmod(F.xxhash64("cid", F.lit("unit")), F.col("of")).cast("int")
        hub_rows = large.join(hubs, "cid", "left_semi").select("*", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("block"))
        first = common.written(_confirm(large.withColumn("block", block).unionByName(hub_rows), ["cluster", "block"], num, den), "links")
        joined = connected(first)
        state = large.drop("label").join(joined.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        state = common.written(state, "labelled")
        parts = state.groupBy("cluster", "label").count().groupBy("cluster").agg(F.max(F.struct("count", "label"))["label"].alias("main"), F.count("*").alias("labels"), F.sum("count").alias("all"), F.max("count").alias("most"))
        open_ = state.join(common.written(parts.where("labels > 1"), "open"), "cluster")
        loose = F.ceil((F.col("all") - F.col("most")) * F.col("of") / F.col("all")).cast("int")
        i = F.pmod(F.xxhash64("cid", F.lit("loose")), loose).cast("int")
        cols = ["cluster", "cid", "label", "body"]
        # Every class outside its cluster's main component meets every block.
        outside = open_.where("label <> main").select(*cols, i.alias("i"), F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("j"))
        inside = open_.select(*cols, block.alias("j"), loose.alias("n")).select(*cols, F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"), "j")
        more = _confirm(outside.unionByName(inside), ["cluster", "i", "j"], num, den)
        links = links.union(first).union(more)
    return connected(links)


def near_duplicates(docs: DataFrame, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept. Documents are linked if den * intersection >= num * union of their sets."""
    rows = common.pick(docs, doc_id=id_col, text=text_col)
    with common.tables(docs.sparkSession) as keep:
        marks = common.written(sketches(rows), "sketches")
        classes = common.written(marks.where("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("sig").alias("sig")), "classes")
        slim = common.written(marks.drop("sig"), "marks")
        common.discard(marks)
        marks = slim
        labels = link_classes(rows, classes, num, den)
        placed = classes.select("cid", "doc_id").join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        least = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
        final = common.written(placed.join(least, "label").select(F.col("cid").alias("class_id"), "component_id"), "components")
        keep(marks, final)
    out = marks.select("doc_id", "n", "cid").join(final, F.col("cid") == F.col("class_id"), "left")
    component = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2 over the whole of documents."""
    return near_duplicates(common.table(spark, sf_dir, "documents"))
