"""Size-aware heavy-light similarity join of documents on word shingles.

Two documents link when 100 * |A and B| >= percent * |A or B| for their sets of distinct ``width``-word shingles. The
result is each document's component, so copies and near copies never become pairs.

1. ``census`` tells which shingles occur in two documents or more. A document with fewer than ``percent`` of its set
   among them has no partner; the others are candidates, and equal sets become one class.
2. Small sets (up to a boundary) enumerate their subsets of every size c that an overlap may need. Sets that meet in a
   c-subset overlap in c; of those, the smallest is linked with each one the size bound allows. A link between two other
   members implies that both link with the smallest, so this star keeps every component without naming pairs.
3. Large sets scan inverted lists of their rarest shingles (the prefix within which similar sets must meet). First
   passes pair each list's members with a few hubs only, where size, position and parity bounds leave it open; verified
   links make components. A last pass takes the pairs of a list that still lie in different components, so a group of
   near copies costs its size, not its square, and no link between components is lost. A long list travels in
   shares, so no shingle gathers its postings in one task; it is cut by size and into blocks in that last pass, and every pair of blocks that may hold similar sets is compared in a task of its own.
4. The boundary is the size at which enumerating subsets costs more than scanning lists, from counts of sets by size and
   the measured length of the lists.

Shingles are told apart by 64-bit hashes. Defined cases: null and empty texts have no shingles and link with nothing; fewer words
than ``width`` make one shingle of the whole sequence; repeated rows link like other copies; a null id is never a
component's name while the component has another; a very long text is hashed a stretch at a time, its set is held whole;
an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm import census
from cartwright.llm.base import Block, blocks, mixed, rolling, staged, texts
from cartwright.llm.components import components, joined

WIDTH = 5
PERCENT = 80
#: Sets beyond this size never enumerate subsets; their number, C(30, 24) and more, exceeds any list's cost.
MOST_ENUMERATED = 30
#: Bits of a set's parity map.
PARITY_BITS = 512
#: Hubs of a list in one pass.
HUBS = 3
#: Subsets sent at once.
SENT_SUBSETS = 1 << 18
#: Members from which on a list is long: it travels in shares of this many and is cut into blocks of them.
LONG_LIST = LIST_BLOCK = 1_024
#: Keys per long list on the way to learning how many shares it has; they add at most ``DEAL / LONG_LIST`` to the rows.
DEAL = 32
#: Pairs of a cell compared at once.
COMPARED = 1 << 18

_SET = pa.schema([("row_key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("print", pa.binary()),
                  ("tokens", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64())), ("skipped", pa.int32()),
                  ("parity", pa.list_(pa.int64()))])
_SET_DDL = "row_key bigint, id bigint, n bigint, print binary, tokens array<bigint>, prefix array<bigint>, skipped int, parity array<bigint>"


def needed(n, percent: int):
    """The least overlap of a set of size n with any similar set."""
    return -(-percent * n // 100)


def _sets(block: Block, width: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text of a block."""
    hashes, at = block.windows(width)
    cuts = np.searchsorted(at, block.ends)
    found, start, word = [], 0, 0
    for end, stop in zip(cuts.tolist(), block.ends.tolist()):
        if stop - word >= width or stop == word:
            found.append(np.unique(hashes[start:end]))
        else:
            found.append(mixed(rolling(block.hashes[word:stop], stop - word) + np.uint64(stop - word)))
        start, word = end, stop
    return found


def _lowered(group: pa.Table) -> list[bytes | None]:
    return [t and t.lower() for t in texts(group["text"])]


def _keys(group: pa.Table, width: int) -> np.ndarray:
    sets = [s for b in blocks(_lowered(group)) for s in _sets(b, width)]
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64)


def _lists(arrays: list[np.ndarray | None]) -> pa.Array:
    sizes = np.array([0] + [0 if a is None else len(a) for a in arrays])
    real = [a for a in arrays if a is not None]
    values = np.concatenate(real).view(np.int64) if real else np.zeros(0, np.int64)
    offsets = pa.array(np.cumsum(sizes).astype(np.int32), mask=np.array([a is None for a in arrays] + [False]))
    return pa.ListArray.from_arrays(offsets, pa.array(values))


def _candidates(group: pa.Table, repeated: census.Repeated, width: int, percent: int) -> pa.Table:
    """One row per document; those that may have a partner carry their set, and the part of its prefix that others share."""
    n, prints, tokens, prefixes, skipped, parity = [], [], [], [], [], []
    for block in blocks(_lowered(group)):
        sets = _sets(block, width)
        classes = repeated.classes_of(np.concatenate(sets)) if sets else None
        for mine, (start, end) in zip(sets, census.slices([len(s) for s in sets])):
            size, cls = len(mine), classes[start:end]
            alone = size - int(np.count_nonzero(cls))
            n.append(size)
            if not size or size - alone < needed(size, percent):
                prints.append(None), tokens.append(None), prefixes.append(None), skipped.append(None), parity.append(None)
                continue
            order = np.lexsort((mine, cls))
            prints.append(hashlib.blake2b(mine.tobytes(), digest_size=16).digest())
            tokens.append(mine)
            prefixes.append(mine[order[alone:size - needed(size, percent) + 1]])
            skipped.append(alone)
            odd = np.bincount((mine & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
            parity.append(np.packbits(odd.astype(np.uint8)).view(np.uint64))
    return pa.table([group["row_key"], group["id"], pa.array(n, pa.int64()), pa.array(prints, pa.binary()), _lists(tokens),
                     _lists(prefixes), pa.array(skipped, pa.int32()), _lists(parity)], schema=_SET)


# ---- small sets -----------------------------------------------------------------------------------


def _subsets(rows: pa.RecordBatch, percent: int) -> Iterator[pa.RecordBatch]:
    """Every subset a small set may share with a similar one: its size and the hash of its members. A few sets at a time,
    so that memory does not follow the number of sets in a batch."""
    rid, sizes, subset, held = [], [], [], 0
    for key, tokens in zip(rows["rid"].to_pylist(), rows["tokens"].to_pylist()):
        members = mixed(np.array(tokens, np.int64).view(np.uint64))
        whole = members.sum(dtype=np.uint64)
        for left_out in range(len(tokens) - needed(len(tokens), percent) + 1):
            flat = chain.from_iterable(combinations(range(len(tokens)), left_out))
            chosen = np.fromiter(flat, np.int8, comb(len(tokens), left_out) * left_out).reshape(-1, left_out) if left_out else np.zeros((1, 0), np.int8)
            found = whole - members[chosen].sum(axis=1, dtype=np.uint64)
            subset.append(found.view(np.int64))
            sizes.append(np.full(len(found), len(tokens) - left_out))
            rid.append(np.full(len(found), key))
            held += len(found)
        if held >= SENT_SUBSETS:
            yield _subset_batch(rid, sizes, subset)
            rid, sizes, subset, held = [], [], [], 0
    yield _subset_batch(rid, sizes, subset)


def _subset_batch(*columns: list[np.ndarray]) -> pa.RecordBatch:
    flat = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in columns]
    return pa.RecordBatch.from_arrays(flat, ["rid", "c", "subset"])


def small_links(sets: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Links among sets of at most ``boundary`` members: each shared subset's smallest set with all it is similar to."""
    light = sets.where(F.col("n") <= boundary).select("rid", "n", "tokens")
    subsets = light.select("rid", "tokens").mapInArrow(
        lambda batches: (part for b in batches for part in _subsets(b, percent)), "rid bigint, c bigint, subset bigint")
    sized = subsets.join(light.select("rid", "n"), "rid")
    hubs = (sized.groupBy("c", "subset").agg(F.min(F.struct("n", "rid")).alias("hub"), F.count(F.lit(1)).alias("members"))
            .where("members > 1").select("c", "subset", "hub"))
    return (sized.join(hubs, ["c", "subset"])
            .where((F.col("rid") != F.col("hub.rid"))
                   & ((F.col("n") + F.col("hub.n")) * percent <= F.col("c") * (100 + percent)))
            .select(F.col("hub.rid").alias("a"), F.col("rid").alias("b")).distinct())


def boundary_of(sets: DataFrame, lists: DataFrame, percent: int) -> int:
    """The largest size for which enumerating subsets is cheaper than scanning lists.

    A set's lists cost its prefix length times the mean length of the list a posting lies in.
    """
    mean = lists.agg(F.coalesce(F.sum(F.col("members") * F.col("members")) / F.sum("members"), F.lit(1.0)).alias("m")).first()["m"]
    counts = {r["n"]: r["count"] for r in sets.where(F.col("n") <= MOST_ENUMERATED).groupBy("n").count().collect()}
    saved, best, boundary = 0.0, 0.0, 0
    for n in range(1, MOST_ENUMERATED + 1):
        enumerate_ = sum(comb(n, c) for c in range(needed(n, percent), n + 1))
        saved += counts.get(n, 0) * ((n - needed(n, percent) + 1) * mean - enumerate_)
        if saved >= best:
            best, boundary = saved, n
    return boundary


# ---- large sets -----------------------------------------------------------------------------------


def _may_be_similar(a: str, b: str, percent: int) -> Column:
    """Bounds for two postings of one shingle, by size, by position, taking it as the first that both sets share, and
    by parity: bits that say whether a set has an odd number of shingles with that remainder differ in no more places
    than the sets have shingles apart."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    left = F.least(na - F.col(f"{a}.place"), nb - F.col(f"{b}.place"))
    apart = sum(F.bit_count(F.col(f"{a}.parity")[i].bitwiseXOR(F.col(f"{b}.parity")[i])) for i in range(PARITY_BITS // 64))
    return ((F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (left * (100 + percent) >= (na + nb) * percent)
            & (apart * (100 + percent) <= (na + nb) * (100 - percent)))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    one, two = sets.select("rid", "n", "tokens").alias("x"), sets.select("rid", "n", "tokens").alias("y")
    both = F.size(F.array_intersect("x.tokens", "y.tokens"))
    return (pairs.join(one, F.col("a") == F.col("x.rid")).join(two, F.col("b") == F.col("y.rid"))
            .where(both * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent).select("a", "b"))


def _every_share(by_token: DataFrame) -> DataFrame:
    """One row per list becomes one per ``share`` of it, to meet postings on both."""
    return by_token.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")


def in_shares(lists_of: DataFrame, lists: DataFrame, long: int = LONG_LIST, deal: int = DEAL) -> DataFrame:
    """The postings of ``lists (token, members)``, each with its list's number of ``shares`` and its own ``share``.

    From here on a list never meets anything by its token alone: whatever is known of a list is repeated for its shares,
    and a share has about ``long`` members, so no token gathers its postings in one task. Only long lists are looked up,
    and theirs is a table of at most one row per ``long`` postings: Spark broadcasts it where it is small, and otherwise
    a list's postings are dealt to ``deal`` keys on the way.
    """
    shares = F.ceil(F.col("members") / long).cast("int").alias("shares")
    sized = lists.select("token", shares)
    longer = sized.where("shares > 1").withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deal - 1))))
    dealt = lists_of.withColumn("deal", F.pmod(F.xxhash64("rid"), F.lit(deal)).cast("int"))
    known = dealt.join(longer, ["token", "deal"], "left").drop("deal").withColumn("shares", F.coalesce("shares", F.lit(1)))
    share = F.pmod(F.xxhash64("rid", F.lit("share")), F.col("shares")).cast("int")
    return known.withColumn("share", share).join(_every_share(sized), ["token", "share"], "left_semi")


def _hub_pairs(postings: DataFrame, boundary: int, percent: int, seeds: range) -> DataFrame:
    """Each list's members with the list's hubs, one per seed, where they are in different components. A hub is the
    member with the least hash, so the lists of one family of copies mostly agree on theirs."""
    hubs = postings.groupBy("token").agg(F.max("shares").alias("shares"), F.array(*[
        F.min(F.struct(F.xxhash64("rid", F.lit(seed)).alias("o"), "rid", "n", "place", "label", "parity")) for seed in seeds]).alias("hubs"))
    met = (postings.drop("shares").join(_every_share(hubs), ["token", "share"])
           .select("rid", "label", F.struct("n", "place", "parity").alias("m"), F.explode("hubs").alias("h"))
           .where((F.col("label") != F.col("h.label")) & (F.greatest("m.n", "h.n") > boundary) & _may_be_similar("m", "h", percent)))
    return met.select(F.least("rid", "h.rid").alias("a"), F.greatest("rid", "h.rid").alias("b")).distinct()


def _cross_pairs(postings: DataFrame, boundary: int, percent: int, block: int = LIST_BLOCK) -> DataFrame:
    """The pairs of each list that lie in different components. Lists of several shares meet in cells."""
    side = lambda label, name: postings.where("shares = 1").select(
        "token", F.col(label[0]).alias(label[1]), F.struct("rid", "n", "place", "parity").alias(name))
    met = (side(("label", "la"), "x").join(side(("label", "lb"), "y"), "token")
           .where((F.col("la") < F.col("lb")) & _may_be_similar("x", "y", percent) & (F.greatest("x.n", "y.n") > boundary))
           .select(F.least("x.rid", "y.rid").alias("a"), F.greatest("x.rid", "y.rid").alias("b")))
    return met.unionByName(_in_cells(_cells(postings.where("shares > 1"), percent, block), boundary, percent)).distinct()


def _cells(postings: DataFrame, percent: int, block: int) -> DataFrame:
    """Postings of long lists, dealt so that any two that may be similar meet in one cell of at most about two blocks.

    Similar sets differ in size by less than one class of sizes (a class spans the ratio that similarity allows), so a
    list is cut by class, and a class meets itself and the next one up. A class with many members is dealt to blocks by a
    hash, and every pair of blocks that must meet is a cell of its own.
    """
    span = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent))) if percent < 100 else F.col("n")
    classed = postings.withColumn("class", span.cast("int"))
    counts = classed.groupBy("token", "class").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"), F.max("shares").alias("shares"))
    near = lambda step, name: counts.select("token", (F.col("class") + step).alias("class"), F.col("blocks").alias(name))
    known = counts.join(near(1, "below"), ["token", "class"], "left").join(near(-1, "above"), ["token", "class"], "left")
    row = classed.drop("shares").join(_every_share(known), ["token", "class", "share"]).withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    # A cell is (class, its block, step to the other's class, the other's block); within a class the lower block comes first.
    upto = lambda n: F.sequence(F.lit(0), F.coalesce(n, F.lit(0)) - 1)
    there = lambda n, build: F.when(F.coalesce(n, F.lit(0)) > 0, F.transform(upto(n), build)).otherwise(
        F.array().cast("array<struct<class:int,one:int,step:int,two:int,left:boolean,right:boolean>>"))
    cell = lambda class_, one, step, two, left, right: F.struct(
        class_.alias("class"), one.alias("one"), F.lit(step).alias("step"), two.alias("two"), left.alias("left"), right.alias("right"))
    mine, class_ = F.col("block"), F.col("class")
    own = F.transform(upto(F.col("blocks")), lambda other: cell(class_, F.least(mine, other), 0, F.greatest(mine, other), mine <= other, other <= mine))
    up = there(F.col("above"), lambda other: cell(class_, mine, 1, other, F.lit(True), F.lit(False)))
    down = there(F.col("below"), lambda other: cell(class_ - 1, other, 1, mine, F.lit(False), F.lit(True)))
    return row.select("token", "rid", "n", "place", "parity", "label", F.explode(F.concat(own, up, down)).alias("cell")).select(
        "token", "cell.*", "rid", "n", "place", "parity", "label")


def _in_cells(cells: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Compare the two sides of every cell by the same bounds as ``_may_be_similar``."""

    def compare(cell: pa.Table) -> pa.Table:
        column = {c: cell[c].to_numpy() for c in ("rid", "n", "place", "label")}
        parity = cell["parity"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(cell.num_rows, -1)
        left, right = (np.flatnonzero(cell[c].to_numpy(zero_copy_only=False)) for c in ("left", "right"))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        step = max(1, COMPARED // max(1, len(right)))
        for at in range(0, len(left), step):
            x, y = left[at:at + step, None], right[None, :]
            na, nb = column["n"][x], column["n"][y]
            room = np.minimum(na - column["place"][x], nb - column["place"][y])
            open_ = ((column["label"][x] != column["label"][y]) & (np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent)
                     & (room * (100 + percent) >= (na + nb) * percent) & (np.maximum(na, nb) > boundary))
            i, j = np.nonzero(open_)
            i, j = left[at:at + step][i], right[j]
            for k in range(0, len(i), COMPARED):
                a, b = i[k:k + COMPARED], j[k:k + COMPARED]
                apart = np.bitwise_count(parity[a] ^ parity[b]).sum(axis=1, dtype=np.int64)
                near = apart * (100 + percent) <= (column["n"][a] + column["n"][b]) * (100 - percent)
                found.append((column["rid"][a[near]], column["rid"][b[near]]))
        a, b = (np.concatenate(side) for side in zip(*found))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return cells.groupBy("token", "class", "one", "step", "two").applyInArrow(compare, "a bigint, b bigint")


def _still_mixed(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists whose members are in two components or more, with each member's component."""
    named = postings.drop("label").join(labels.withColumnRenamed("node", "rid"), "rid", "left").withColumn(
        "label", F.coalesce("label", "rid"))
    spread = named.groupBy("token").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.max("shares").alias("shares")).where("low < high")
    return staged(named.join(_every_share(spread), ["token", "share"], "left_semi").select(
        "token", "share", "shares", "rid", "n", "place", "parity", "label"), "mixed")


def _pairs_left(postings: DataFrame) -> tuple[int, int]:
    """Postings, and pairs of them in one list and different components."""
    row = (postings.groupBy("token", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("token")
           .agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("same"))
           .agg(F.sum("n").alias("n"), F.sum((F.col("n").cast("double") * F.col("n") - F.col("same")) / 2).alias("pairs")).first())
    return row["n"] or 0, int(row["pairs"] or 0)


def linked(heavy: DataFrame, rows: DataFrame, small: DataFrame, boundary: int, percent: int) -> DataFrame:
    """``node, label`` of every set with a link. Stars around hubs first, as long as each pass takes a third of the
    pairs that are left away and more than one per posting are; then every pair that is left."""
    labels = components(staged(small, "links"))
    mixed_lists, before, round_ = _still_mixed(heavy, labels), None, 0
    while True:
        n, pairs = _pairs_left(mixed_lists)
        last = pairs <= n or (before is not None and pairs > before * 2 / 3)
        found = _cross_pairs(mixed_lists, boundary, percent) if last else _hub_pairs(
            mixed_lists, boundary, percent, range(HUBS * round_, HUBS * (round_ + 1)))
        labels = joined(labels, staged(verified(found, rows, percent), "links"))
        if last:
            return labels
        mixed_lists, round_, before = _still_mixed(mixed_lists, labels), round_ + 1, pairs


def near_duplicates(docs: DataFrame, text: str = "text", id_: str = "doc_id", width: int = WIDTH,
                    percent: int = PERCENT, sizes: census.Sizes = census.Sizes()) -> DataFrame:
    """Per row of ``docs``: row_key (a hash of its id and text), the id, n_shingles, component_id (the smallest id
    reachable by links) and stays (true for one row of each component, that with the smallest id)."""
    lay = census.layout(docs, text, 4, sizes)
    mine = docs.select(F.col(f"`{id_}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    chunked = mine.select(F.xxhash64("id", "text").alias("row_key"), "id", "text", census.chunk_of(lay, mine))
    rows = staged(
        census.census(chunked, lambda g: _keys(g, width), lay, lambda g, r: _candidates(g, r, width, percent), _SET_DDL)
        .withColumn("rid", F.monotonically_increasing_id()), "sets")
    classes = staged(rows.where("print IS NOT NULL").groupBy("print").agg(
        F.min("rid").alias("rid"), F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "rid")).alias("first")), "classes")
    sets = rows.where("print IS NOT NULL").join(classes.select("rid"), "rid", "left_semi")

    lists_of = (sets.select("rid", "n", "skipped", "parity", F.posexplode("prefix").alias("at", "token"))
                .select("token", "rid", "n", (F.col("skipped") + F.col("at")).alias("place"), "parity"))
    lists = staged(lists_of.groupBy("token").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "lengths")
    postings = staged(in_shares(lists_of, lists), "lists")
    boundary = boundary_of(rows.where("print IS NOT NULL"), lists, percent)
    heavy = postings.where(F.col("n") >= needed(boundary + 1, percent))

    labels = linked(heavy, rows, small_links(sets, boundary, percent), boundary, percent)

    named = classes.join(labels.withColumnRenamed("node", "rid"), "rid", "left").select(
        "print", "first", F.coalesce("label", "rid").alias("label"))
    firsts = named.groupBy("label").agg(F.min("first").alias("f"))
    of_print = named.join(firsts, "label").select("print", F.col("f.id").alias("component_id"), F.col("f.rid").alias("stay"))
    plain = rows.select("row_key", F.col("id").alias(id_), F.col("n").alias("n_shingles"), "print", "rid")
    shown = ["row_key", id_, "n_shingles", "component_id", "stays"]
    met = plain.where("print IS NOT NULL").join(of_print, "print").withColumn("stays", F.col("rid") == F.col("stay"))
    alone = plain.where("print IS NULL").withColumns({"component_id": F.col(id_), "stays": F.lit(True)})
    return met.select(*shown).unionByName(alone.select(*shown))


def without_near_duplicates(docs: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component, that with the smallest id; rows equal in id and text are one."""
    judged = staged(near_duplicates(docs, text, id_).select("row_key", "stays"), "judged")
    key = F.xxhash64(F.col(f"`{id_}`").cast("bigint"), F.col(f"`{text}`")).alias("row_key")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key).join(
        judged.where("stays").select("row_key").distinct(), "row_key", "left_semi")
    if not judged.groupBy("row_key").count().where("count > 1").isEmpty():
        held = held.dropDuplicates(["row_key"])
    return held.select("row.*")
