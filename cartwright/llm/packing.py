"""Bound-certified best-fit packing of tokenised documents into sequences.

Documents become token ids with an end token; only longer ones are cut, into pieces of the capacity. Pieces are dealt
to partitions by a hash of their content and each packs its own by best-fit decreasing, so the result does not depend on
how the input is cut into files (but for contents that are hot themselves: their equal pieces are spread). Dual feasible
functions give every partition a lower bound on its bins: a partition that meets it is certified. The partitions with a
gap exchange documents: their bins with room are dealt anew to an eighth of the partitions, which rerun best-fit
decreasing and keep the result only if it has fewer bins. What certified partitions lose at their ends shows in the
bound of all pieces together: as long as the total is above it, they pass on their open bins too. That repeats until
the bound is met or nothing is gained.

Partitions hold at most about ``MOST_PIECES`` pieces; the driver sees counts only. Every round is written to the shared
folder.

A tokenizer that folds case and splits at white space before anything else gives a text the ids of its words in order;
words are then encoded once per worker and remembered, up to a bound, and a text that may hold a special token's string
is encoded whole. Each worker tries that on ``PROBES`` when it loads the file; any other tokenizer encodes whole texts.

Defined cases: null and empty texts are the end token alone; repeated rows and null ids are pieces like others; an
empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm.base import partitions, rest_of, staged, texts, unrest
from cartwright.operators.joins import hot_key_hashes

CAPACITY = 2048
END = b"\x00\x00\x00\x00"
MOST_PIECES = 50_000
LEAST_BINS = 256
#: Words remembered per worker: two generations of this many.
WORDS = 500_000
MARKS = b".,!?;:#$%&*|"
#: A certified partition's bins with at least this part of their capacity free are open.
OPEN = 16
MOST_ROUNDS = 30
#: What a tokenizer must encode word by word as it does whole, for words to be remembered.
PROBES = ("The Quick brown FOX isn't LOUD", " two  spaces\tand\na line\r\n\x0b\x0c ", "end. (and), more; 3.14 x1y2 #tag $5 50% a&b **",
          "naïve Ünïcode — été ΟΔΟΣ İstanbul Å", "日本語 текст don't 'S he'll foo's,bar.", "a... b!? c|d e-f g_h @i", "hello world Hello World HELLO WORLD")


# ---- tokens ---------------------------------------------------------------------------------------


class Ids(dict):
    """Lower-cased word to its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.older: dict[bytes, bytes] = {}
        probes = [p.encode() for p in PROBES]
        self.by_word = all(self._words(p) == self.encoded(p) for p in probes)
        self.clear()

    def encoded(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            # Marks after a letter or digit are a token run of their own.
            stem = word.rstrip(MARKS)
            if len(stem) < len(word) and stem[-1:].isalnum():
                found = self[stem] + self[word[len(stem):]]
            else:
                found = self.encoded(word)
        if len(self) >= WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found

    def text(self, raw: bytes | None) -> bytes:
        if not raw:
            return END
        if not self.by_word or b"<|" in raw:
            return self.encoded(raw) + END
        return self._words(raw) + END

    def _words(self, raw: bytes) -> bytes:
        return b"".join(map(self.__getitem__, raw.lower().split()))


_TOKENIZERS: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Ids(path)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece: the other columns of ``docs``, piece, start, length, ids_crc32 and, ``with_ids``, ids."""
    found = ["piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    rest = rest_of(docs, text, *found)
    kind = docs.select(rest.alias("rest")).schema["rest"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ids_of(tokenizer)
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, raw in enumerate(texts(batch["text"])):
                whole = encoder.text(raw)
                for k, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at:at + 4 * capacity]
                    row.append(i), piece.append(k), start.append(at // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [batch["rest"].take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, ["rest", *found])

    done = docs.select(rest.alias("rest"), F.col(f"`{text}`").alias("text")).mapInArrow(
        cut, f"rest {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else ""))
    return unrest(done, [c for c in docs.columns if c != text], found)


# ---- packing --------------------------------------------------------------------------------------


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every piece, and the room left in every bin, by best-fit decreasing."""
    bins, offsets, rooms = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # a bit for every room that some bin has
    order = np.argsort(-lengths, kind="stable").tolist()
    sizes = lengths.tolist()
    for i in order:
        size = sizes[i]
        fits = open_rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
        else:
            bin_, room = len(rooms), capacity
            rooms.append(capacity)
        bins[i], offsets[i] = bin_, capacity - room
        left = rooms[bin_] = room - size
        if left:
            if not by_room[left]:
                open_rooms |= 1 << left
            by_room[left].append(bin_)
    return bins, offsets, np.array(rooms, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing of these pieces needs."""
    return bound_of(np.bincount(lengths, minlength=capacity + 1), capacity)


def bound_of(count: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, from the number of pieces of each size: the greatest bound of three families of dual
    feasible functions.

    The plain sum; for every threshold t, pieces over capacity - t counting as whole bins and those under t as nothing;
    and for k up to 20, sizes rounded down to multiples of 1/k unless they are multiples of 1/(k+1).
    """
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    below_count, below_sum = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(1, capacity // 2 + 1)
    whole = below_count[-1] - below_count[capacity - t]
    middle = below_sum[capacity - t] - below_sum[t - 1]
    best = max(best, int((whole + -(-middle // capacity)).max(initial=0)))
    for k in range(1, 21):
        scaled = (k + 1) * size
        worth = np.where(scaled % capacity == 0, k * size, (scaled // capacity) * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((count * worth).sum()) // (k * capacity)))
    return best


_PLACED = "sequence_id bigint, offset bigint, room bigint, gap bigint"


def _packed(group: pa.Table, capacity: int, round_: int) -> pa.Table:
    """Pack one partition, or keep its bins as they came if packing anew needs as many."""
    group = group.sort_by("content")  # ties between equal lengths are the same in any order of arrival
    lengths = group["length"].to_numpy()
    bins, offsets, rooms = best_fit(lengths, capacity)
    bound = lower_bound(lengths, capacity)
    names = group.column_names
    if round_ and len(np.unique(group["sequence_id"].to_numpy())) <= len(rooms):
        kept = {n: group[n] for n in names}
        gap = len(np.unique(group["sequence_id"].to_numpy())) - bound
    else:
        part = group["part"][0].as_py()
        base = (round_ << 58) | (part << 24)
        kept = {n: group[n] for n in names} | {
            "sequence_id": pa.array(base + bins), "offset": pa.array(offsets), "room": pa.array(rooms[bins])}
        gap = len(rooms) - bound
    kept["gap"] = pa.array(np.full(len(lengths), gap, np.int64))
    order = [n for n in names if n not in ("sequence_id", "offset", "room", "gap")]
    return pa.table({n: kept[n] for n in [*order, "sequence_id", "offset", "room", "gap"]})


def _dealt(written: DataFrame, parts: int) -> DataFrame:
    """Pieces with a partition each, from their content; equal pieces that are hot are dealt by their place as well."""
    hashable = [f"rest.`{f.name}`" for f in written.schema["rest"].dataType.fields if "map<" not in f.dataType.simpleString()]
    marked = written.withColumn("content", F.xxhash64("length", *hashable))
    hot = hot_key_hashes(marked, {"content": T.LongType()}, max(parts, 2)) if parts > 1 else {}
    spread = F.when(F.xxhash64("content").isin(list(hot)), F.col("at")).otherwise(F.lit(0)) if hot else F.lit(0)
    return marked.withColumn("part", F.pmod(F.xxhash64("content", spread), F.lit(parts)).cast("bigint")).drop("at")


def _bins(frame: DataFrame) -> tuple[int, int]:
    """Pieces and bins: every bin has one piece at its beginning."""
    row = frame.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("offset") == 0).alias("bins")).first()
    return row["n"], row["bins"]


def pack(items: DataFrame, capacity: int = CAPACITY, most_pieces: int = MOST_PIECES) -> DataFrame:
    """``items``, which has ``length`` (1 to capacity), with sequence_id, offset and certified: whether the piece's last
    partition uses no more bins than any packing of its pieces must. Columns of those names, and ``part``, ``room`` and
    ``gap``, are replaced or left out."""
    spark = items.sparkSession
    taken = ["sequence_id", "offset", "certified", "part", "room", "gap"]
    held = items.select(rest_of(items, *taken).alias("rest"), F.col("length").cast("bigint").alias("length"))
    written = staged(held.withColumn("at", F.monotonically_increasing_id()), "pieces")
    kind = written.schema["rest"].dataType.simpleString()
    schema = f"rest {kind}, length bigint, content bigint, part bigint, {_PLACED}"
    sizes = np.zeros(capacity + 1, np.int64)  # at most one row per size
    for r in written.groupBy("length").count().collect():
        sizes[r["length"]] = r["count"]
    count, tokens, bound = int(sizes.sum()), int(sizes @ np.arange(capacity + 1)), bound_of(sizes, capacity)
    # A partition may end with one bin that is nearly empty, so each has sequences enough for that not to matter.
    parts = max(min(partitions(spark), tokens // (capacity * LEAST_BINS)), -(-count // most_pieces), 1)

    def packer(round_: int):
        return lambda group: _packed(group, capacity, round_)

    state = staged(_dealt(written, parts).groupBy("part").applyInArrow(packer(0), schema), "packed")
    done, idle = [], 0
    total = _bins(state)[1]
    for round_ in range(1, MOST_ROUNDS + 1):
        passed = (F.col("gap") > 0) & (F.col("room") > 0)
        if total > bound:
            passed |= F.col("room") >= max(1, capacity // OPEN)
        loose = state.where(passed)
        n, bins = _bins(loose)
        if not n:
            break
        fewer = max(-(-n // most_pieces), parts // 8, 1)
        done.append(state.where(~passed))
        redealt = loose.withColumn("part", F.pmod(F.xxhash64("sequence_id", F.lit(round_)), F.lit(fewer)).cast("bigint"))
        state = staged(redealt.groupBy("part").applyInArrow(packer(round_), schema), "packed")
        gained = bins - _bins(state)[1]
        total -= gained
        # With as many partitions as before a round may gain by new partners alone; one partition has none.
        idle = 0 if gained or fewer < parts else idle + 1
        parts = fewer
        if idle >= 2 or (parts == 1 and n <= most_pieces):
            break
    for one in done:
        state = state.unionByName(one)
    return unrest(state.withColumn("certified", F.col("gap") <= 0), [c for c in items.columns if c not in taken],
                  ["sequence_id", "offset", "certified"])


def sequences(docs: DataFrame, tokenizer: str, text: str = "text", id_: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Per piece: the id, piece, start, length, ids_crc32, sequence_id, offset and certified."""
    return pack(pieces(docs.select(F.col(f"`{id_}`"), F.col(f"`{text}`")), tokenizer, text, capacity), capacity)
