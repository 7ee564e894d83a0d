"""Near duplicates by HyperMinHash sketches over five-word shingles.

One pass turns a text into its set of shingle hashes. The hash's first bits choose a
register; the register holds the least remaining value in short form: its count of
leading zeros and the mantissa bits after them. Texts whose registers agree on a band
are candidates, the Jaccard estimate from the registers, corrected for registers that
agree by chance, drops the far ones, and full sets decide the rest.

A band's group is never turned into all its pairs. Hub rounds link its members to one
of them each; what then lies outside the group's largest component is compared with the
others block by block, by sketch, and the pairs that remain are checked in rounds until
none is left across two components. A group with many outsiders is first dealt anew by
its members' rarest shingles, so that texts which only share a template do not meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import free_name, keep, python_ready, slices
from loomcast.llm.components import components
from loomcast.llm.shingles import ROW_BITS, shingle_sets

SHINGLE = 5
#: Registers, and those of one band: 32 bands of 4. A pair at 0.85 shares a band with
#: probability 1 - 6e-11.
REGISTERS, BAND_ROWS = 128, 4
BANDS = REGISTERS // BAND_ROWS
#: Mantissa bits. Sparse texts fill few registers of a band, so one register alone must
#: tell shingles apart: with 10 bits the candidates by chance grew with the square of the input.
MANTISSA = 26
EMPTY = 0xFFFFFFFF
#: Link when LINK_BELOW * intersection >= LINK_ABOVE * union.
LINK_BELOW, LINK_ABOVE = 100, 85
#: Sets of fewer shingles link with equal sets only: 5 / 6 is below the limit.
LEAST_LINKED = LINK_ABOVE // (LINK_BELOW - LINK_ABOVE) + 1
#: Standard deviations by which the estimate may fall short of the limit before a
#: candidate is dropped unchecked.
SLACK = 6.0
#: Members of a band's group that are compared in one task at once.
BLOCK = 512
#: Blocks of members outside a group's largest component that are compared as they are; a group
#: with more is dealt anew by its members' rarest shingles.
ODD_BLOCKS = 8
#: Slots in which the shingles of such members are counted, to order them by rarity.
SLOTS = 1 << 20
#: Sketches from this many filled registers on are trusted to drop a candidate.
LEAST_FILLED = 32

SKETCHES = "doc_id long, n_shingles long, fingerprint binary, registers binary"
#: Hub rounds before the members of a group are compared in blocks.
HUB_ROUNDS = 3
#: Texts of up to this many shingles bring their whole sets to the block comparison.
SHORT = 256
#: Rows of blocks that one call compares.
TASK_ROWS = 10_000
#: Pairs of one member that are checked in the first round after the block comparison; the
#: number grows fourfold each round.
FIRST_CHECKS = 4


def registers(shingles: np.ndarray) -> np.ndarray:
    """The HyperMinHash registers (32 bits each: 6 of leading zeros, 26 of mantissa) of sorted shingle hashes."""
    out = np.full(REGISTERS, EMPTY, dtype="<u4")
    if len(shingles):
        rows = (shingles >> np.uint64(64 - ROW_BITS)).astype(np.int64)
        first = np.flatnonzero(np.diff(rows, prepend=-1))  # sorted: the least value of a register comes first
        value = ((shingles[first] << np.uint64(ROW_BITS)) >> np.uint64(11)).astype(np.int64)  # 53 bits
        zeros = 53 - np.frexp(value.astype(np.float64))[1]
        zeros[value == 0] = 53
        after = (value << zeros) >> (52 - MANTISSA) & ((1 << MANTISSA) - 1)
        out[rows[first]] = zeros << MANTISSA | after
    return out


def level_shares(sizes: np.ndarray) -> np.ndarray:
    """For sets of the given sizes: the chance of each count of leading zeros in a register."""
    high = np.exp2(-np.arange(0, 54, dtype=float))
    load = sizes.reshape(-1, 1) / REGISTERS
    return np.exp(-load * (high / 2)) - np.exp(-load * high)


def judged(match: np.ndarray, filled: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Jaccard estimates from counts of equal and of filled registers; -1 where a pair can be dropped.

    Matches expected by chance, which grow as mantissas are short, are taken off first.
    A pair is dropped if the limit lies ``SLACK`` deviations above its estimate, or if
    the set sizes alone rule the link out. The filled registers are a sample, without
    repetition, of the union, whose size follows from the set sizes and the limit.
    """
    limit = LINK_ABOVE / LINK_BELOW
    left_out = np.maximum(1 - filled * (1 + limit) / (n_left + n_right), 0.02)
    floor = limit - SLACK * np.sqrt(limit * (1 - limit) * left_out / np.maximum(filled, 1))
    fits = LINK_BELOW * np.minimum(n_left, n_right) >= LINK_ABOVE * np.maximum(n_left, n_right)
    out = np.full(len(match), -1.0)
    # what chance can only lower is decided first
    open_ = np.flatnonzero(fits & ((match >= floor * filled) | (filled < LEAST_FILLED)))
    if len(open_):
        chance = (level_shares(n_left[open_]) * level_shares(n_right[open_])).sum(axis=1)
        chance *= REGISTERS / (1 << MANTISSA)
        estimate = np.maximum(match[open_] - chance, 0) / np.maximum(filled[open_], 1)
        near = (estimate >= floor[open_]) | (filled[open_] < LEAST_FILLED)
        out[open_[near]] = estimate[near]
    return out


def worth_checking(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """``judged`` for sketch pairs (rows of ``left`` and ``right``)."""
    there = left != EMPTY
    return judged(((left == right) & there).sum(axis=1), (there | (right != EMPTY)).sum(axis=1), n_left, n_right)


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, a 128-bit fingerprint of the shingle set, and its registers."""
    import hashlib

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), SHINGLE)
            columns = [
                part.column("doc_id"),
                pa.array([len(s) for s in sets], type=pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], type=pa.binary()),
                pa.array([registers(s).tobytes() for s in sets], type=pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "fingerprint", "registers"])

    return python_ready(slim).mapInArrow(run, SKETCHES)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(b, dtype="<u4") for b in column.to_pylist()]).reshape(-1, REGISTERS)


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of class ids with their estimate, without those that can be dropped."""
    one = classes.select(F.col("rep").alias("a"), F.col("registers").alias("ra"), F.col("n_shingles").alias("na"))
    two = classes.select(F.col("rep").alias("b"), F.col("registers").alias("rb"), F.col("n_shingles").alias("nb"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = [batch.column(c).to_numpy().astype(float) for c in ("na", "nb")]
            found = worth_checking(_matrix(batch.column("ra")), _matrix(batch.column("rb")), *sizes)
            mask = pa.array(found >= 0)
            columns = [batch.column(c).filter(mask) for c in ("a", "b")] + [pa.array(found[found >= 0])]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "estimate"])

    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a long, b long, estimate double")


def linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) with ``link``: whether their full shingle sets reach the limit."""
    one = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))

    def run(batches):
        for batch in slices(batches, "ta"):
            out = []
            for x, y in zip(shingle_sets(batch.column("ta"), SHINGLE), shingle_sets(batch.column("tb"), SHINGLE)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(LINK_BELOW * both >= LINK_ABOVE * (len(x) + len(y) - both))
            columns = [batch.column("a"), batch.column("b"), pa.array(out, type=pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "link"])

    # the second text moves last: a hub's text is read once a partition, not moved once a pair
    return pairs.select("a", "b").join(two, "b").join(one, "a").mapInArrow(run, "a long, b long, link boolean")


def band_members(classes: DataFrame) -> DataFrame:
    """(band, place, rep) of every class and band whose registers it shares with another class."""
    width = 4 * BAND_ROWS
    blank = F.lit(b"\xff" * width)
    parts = [F.substring("registers", 1 + width * k, width) for k in range(BANDS)]
    keys = F.array(*[F.when(p != blank, F.struct(F.xxhash64(F.lit(k), p).alias("band"), F.lit(k).alias("place"))) for k, p in enumerate(parts)])
    rows = classes.filter(F.col("n_shingles") >= LEAST_LINKED)
    rows = rows.select("rep", F.explode(F.array_compact(keys)).alias("k")).select("rep", "k.band", "k.place")
    shared = rows.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("band")
    return rows.join(shared, "band")


def open_members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(band, place, rep, root) in the bands that still hold more than one component."""
    rows = members.join(roots, "rep")
    mixed = rows.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"))
    return rows.join(mixed.filter("low <> high").select("band", "size"), "band")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def hub_pairs(rows: DataFrame, round_no: int) -> DataFrame:
    """One member of each band paired with its members of other components; pairs once, with shared bands."""
    order = F.col("rep") if round_no == 0 else F.xxhash64("rep", F.lit(round_no))
    hubs = rows.groupBy("band").agg(F.min(F.struct(order.alias("o"), "rep", "root")).alias("hub"))
    hubs = hubs.select("band", F.col("hub.rep").alias("y"), F.col("hub.root").alias("hub_root"))
    pairs = rows.join(keep(hubs, "hubs"), "band").filter("root <> hub_root").withColumnRenamed("rep", "x")
    return _ordered(pairs).distinct()


def short_sets(texts: DataFrame) -> DataFrame:
    """(rep, shingles): the whole shingle set of each short text, as bytes; null for others."""

    def run(batches):
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), SHINGLE)
            held = pa.array([s.tobytes() if len(s) <= SHORT else None for s in sets], type=pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("rep"), held], names=["rep", "shingles"])

    return texts.mapInArrow(run, "rep long, shingles binary")


def main_roots(rows: DataFrame) -> DataFrame:
    """(band, main_root, size, odd): each band's largest component, its members and those outside that component."""
    sizes = rows.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("band").agg(F.max(F.struct("n", "root")).alias("m"), F.sum("n").alias("size"))
    return main.select("band", F.col("m.root").alias("main_root"), "size", (F.col("size") - F.col("m.n")).alias("odd"))


def prefix_members(texts: DataFrame, reps: DataFrame) -> DataFrame:
    """(band, place, rep, root): each class under its rarest shingles, one of which two linked classes must share.

    Linked sets share LINK_ABOVE / LINK_BELOW of either one's shingles. In one order of all
    shingles, the first ones of a set, as many as may be missing from the other and one
    more, therefore meet those of the other. Any order loses nothing; here the shingles
    of the fullest slots of a count over all ``reps`` come last.
    """
    held = texts.join(reps.select("rep"), "rep", "left_semi").select("rep", "text")

    def count(batches):
        full = np.zeros(SLOTS, dtype=np.int64)
        for part in slices(batches, "text"):
            for own in shingle_sets(part.column("text"), SHINGLE):
                np.add.at(full, (own % np.uint64(SLOTS)).astype(np.int64), 1)
        used = np.flatnonzero(full)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(full[used])], names=["slot", "n"])

    counted = held.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    load = np.zeros(SLOTS, dtype=np.int64)
    load[counted["slot"].to_numpy(dtype=np.int64)] = counted["n"].to_numpy(dtype=np.int64)

    def first(batches):
        for part in slices(batches, "text"):
            out = []
            for own in shingle_sets(part.column("text"), SHINGLE):
                least = -(-LINK_ABOVE * len(own) // LINK_BELOW)
                order = np.lexsort((own, load[(own % np.uint64(SLOTS)).astype(np.int64)]))
                out.append(own[order[: len(own) - least + 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(out, type=pa.list_(pa.int64()))], names=["rep", "rare"])

    rows = held.mapInArrow(first, "rep long, rare array<long>").select("rep", F.explode("rare").alias("rare"))
    rows = rows.select(F.xxhash64(F.lit(-1), "rare").alias("band"), F.lit(-1).alias("place"), "rep")
    return rows.join(reps, "rep").select("band", "place", "rep", "root")


def split_large(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The members to compare, without bands of many outsiders as far as rare shingles can take their place.

    A pair of such a band is found under a rare shingle that both hold, if one of the two
    has no rare shingle which is a band of many outsiders itself. Pairs of two classes that
    have one stay in their band.
    """
    rows = rows.select("band", "place", "rep", "root")
    many = F.col("odd") > ODD_BLOCKS * BLOCK
    large = keep(main_roots(rows).filter(many).select("band"), "large")
    if large.isEmpty():
        return rows
    inside = keep(rows.join(large, "band"), "inside")
    rare = keep(prefix_members(texts, inside.select("rep", "root").distinct()), "rare")
    heads = keep(main_roots(rare).filter("odd > 0"), "heads")
    heavy = rare.join(heads.filter(many).select("band"), "band").select("rep").distinct()
    stay = rows.join(large, "band", "left_anti").union(inside.join(heavy, "rep", "left_semi").select(*rows.columns))
    return stay.union(rare.join(heads.filter(~many).select("band"), "band").select(*rows.columns))


def block_pairs(rows: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Every pair of a band across two components that neither its estimate nor its sets drop.

    Members outside the band's largest component are compared with all members, block by
    block; the members of the largest component need no comparison among each other. A
    pair is looked at in the first band that it shares only. Short texts bring their
    whole sets, so of these only true links go on. Both sides are cut: a block has about
    BLOCK members and the outsiders of ODD_BLOCKS blocks.
    """
    rows = keep(split_large(rows, texts), "split")
    main = keep(main_roots(rows).filter("odd > 0"), "main")
    sets = keep(short_sets(texts), "sets")
    full = rows.join(main, "band").join(classes.select("rep", "registers", "n_shingles"), "rep").join(sets, "rep")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    chunks = F.ceil(F.col("odd") / (ODD_BLOCKS * BLOCK)).cast("int")
    # the number of a block: that of its members, then that of its chunk of outsiders
    targets = full.withColumn("_block", F.pmod(F.xxhash64("rep"), blocks).cast("long")).select(
        "band", F.explode(F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: F.col("_block") * chunks + c)).alias("block"), F.lit(False).alias("odd"),
        "place", "rep", "root", "registers", "n_shingles", "shingles",
    )
    odd = full.filter("root <> main_root").withColumn("_chunk", F.pmod(F.xxhash64("rep", F.lit(1)), chunks).cast("long")).select(
        "band", F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: b * chunks + F.col("_chunk"))).alias("block"), F.lit(True).alias("odd"),
        "place", "rep", "root", "registers", "n_shingles", "shingles",
    )

    every = keep(targets.union(odd), "blocks")
    tasks = F.lit(max(1, -(-every.count() // TASK_ROWS)))

    def compare(rows_of: pa.Table) -> pa.Table:
        rows_of = rows_of.sort_by([("band", "ascending"), ("block", "ascending"), ("odd", "ascending"), ("rep", "ascending")])
        band, block, is_odd, place, rep, root, size = (
            rows_of.column(c).combine_chunks().to_numpy(zero_copy_only=False)
            for c in ("band", "block", "odd", "place", "rep", "root", "n_shingles")
        )
        held = rows_of.column("shingles").to_pylist()
        size = size.astype(float)
        codes = _matrix(rows_of.column("registers").combine_chunks())
        there = codes != EMPTY
        starts = np.flatnonzero((np.diff(band, prepend=band[0] - 1) != 0) | (np.diff(block, prepend=block[0] - 1) != 0))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for first, last in zip(starts, [*starts[1:], len(band)]):
            middle = first + int(np.count_nonzero(~is_odd[first:last]))
            for k in range(middle, last):
                other = first + np.flatnonzero(root[first:middle] != root[k])
                if len(other):
                    same = (codes[other] == codes[k]) & there[k]
                    filled = (there[other] | there[k]).sum(axis=1)
                    estimate = judged(same.sum(axis=1), filled, size[other], np.full(len(other), size[k]))
                    hit = estimate >= 0
                    near = np.flatnonzero(hit)
                    if len(near):
                        if place[k] >= 0:  # else a rare shingle, no band of registers
                            hit[near] = _first_shared(codes[other[near]], codes[k], there[k]) == place[k]
                        for n in np.flatnonzero(hit):
                            if held[k] is not None and held[other[n]] is not None:
                                hit[n] = _links(held[k], held[other[n]])
                    if hit.any():
                        found.append((np.full(hit.sum(), rep[k]), rep[other[hit]], estimate[hit]))
        x, y, estimate = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0),) * 3
        return pa.table(
            {"x": pa.array(x.astype(np.int64)), "y": pa.array(y.astype(np.int64)), "estimate": pa.array(estimate.astype(float))}
        )

    # many small blocks share a task's call
    task = F.pmod(F.xxhash64("band", "block"), tasks).alias("task")
    pairs = every.groupBy(task).applyInArrow(compare, "x long, y long, estimate double")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "estimate").distinct()


def _first_shared(codes: np.ndarray, own: np.ndarray, there: np.ndarray) -> np.ndarray:
    """The first band in which each row of ``codes`` agrees with ``own`` on all registers, not all empty."""
    agree = (codes == own).reshape(len(codes), BANDS, BAND_ROWS).all(axis=2)
    return np.argmax(agree & there.reshape(BANDS, BAND_ROWS).any(axis=1), axis=1)


def _links(left: bytes, right: bytes) -> bool:
    x, y = np.frombuffer(left, dtype=np.uint64), np.frombuffer(right, dtype=np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return LINK_BELOW * both >= LINK_ABOVE * (len(x) + len(y) - both)


def _best(pairs: DataFrame, each: int) -> DataFrame:
    """For each larger id its ``each`` pairs of the highest estimate; the others wait for a later round."""
    from pyspark.sql import Window

    order = Window.partitionBy("b").orderBy(F.col("estimate").desc(), "a")
    return pairs.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= each).select("a", "b")


def class_roots(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, root) of every class: the smallest class of its component of links."""
    members = keep(band_members(classes), "bands")
    texts = keep(
        docs.select(F.col("doc_id").alias("rep"), "text")
        .join(members.select("rep").distinct(), "rep", "left_semi")
        .dropDuplicates(["rep"]),
        "texts",
    )
    roots = keep(classes.select("rep", F.col("rep").alias("root")), "roots")
    refused = classes.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0)
    for round_no in range(HUB_ROUNDS):
        rows = keep(open_members(members, roots), "open")
        pairs = estimated(hub_pairs(rows, round_no).join(refused, ["a", "b"], "left_anti"), classes)
        chosen = keep(_best(pairs, 1), "pairs")
        if chosen.isEmpty():
            break
        roots, refused = checked_and_joined(chosen, texts, roots, refused)
    # all pairs that are left to check; components only grow, so none comes to this later
    left = keep(block_pairs(keep(open_members(members, roots), "open"), classes, texts), "left")
    each = FIRST_CHECKS
    while True:
        chosen = keep(_best(across(left, roots).join(refused, ["a", "b"], "left_anti"), each), "pairs")
        if chosen.isEmpty():
            return roots
        roots, refused = checked_and_joined(chosen, texts, roots, refused)
        each *= 4


def across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    ends = roots.select(F.col("rep").alias("a"), F.col("root").alias("ra"))
    both = pairs.join(ends, "a").join(ends.toDF("b", "rb"), "b")
    return both.filter("ra <> rb").select(*pairs.columns)


def checked_and_joined(chosen: DataFrame, texts: DataFrame, roots: DataFrame, refused: DataFrame):
    """Check pairs on full sets: the new roots, and all pairs refused so far."""
    checked = keep(linked(chosen, texts), "checked")
    refused = keep(refused.union(checked.filter("not link").select("a", "b")), "refused")
    links = checked.filter("link").select("a", "b")
    ends = roots.select(F.col("rep").alias("a"), F.col("root").alias("ra"))
    links = links.join(ends, "a").join(ends.toDF("b", "rb"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    moved = components(links).select(F.col("node").alias("root"), F.col("root").alias("to"))
    roots = roots.join(moved, "root", "left").select("rep", F.coalesce("to", "root").alias("root"))
    return keep(roots, "roots"), refused


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Texts are linked where 100 * intersection >= 85 * union of their sets of five-word
    shingles (words split at ASCII white space, A-Z as a-z). A text of one to four words
    has its word sequence as its one shingle. Null, empty and blank texts have an empty
    set and are linked with nothing. component_id is the smallest doc_id that links
    reach; ``kept`` says that this is the row's own. Rows that share a doc_id should hold
    the same text; they are all kept or all dropped. A row whose doc_id is null is a
    document by itself: it links with nothing, its component_id is null and it is kept. Other columns
    are ignored, whatever their names. An empty table gives an empty result.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = keep(sketch(slim), "sketches")
    known = sketches.filter("n_shingles > 0 and doc_id is not null")
    classes = keep(
        known.groupBy("fingerprint", "n_shingles", "registers").agg(F.min("doc_id").alias("rep")), "classes"
    )
    roots = class_roots(classes.select("rep", "n_shingles", "registers"), slim)
    named = classes.select("fingerprint", "rep").join(roots, "rep").select("fingerprint", "root")
    with_text = known.select("doc_id", "n_shingles", "fingerprint").join(keep(named, "named"), "fingerprint")
    alone = sketches.filter("n_shingles = 0 or doc_id is null")
    every = with_text.select("doc_id", "n_shingles", F.col("root").alias("component_id")).union(
        alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    )
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, all columns as they were."""
    stay = free_name(docs, "stay")
    stays = near_duplicates(docs, id_col, text_col).filter("kept").select(F.col("doc_id").alias(stay)).distinct()
    return docs.join(stays, F.col(id_col).cast("long").eqNullSafe(F.col(stay)), "left_semi")
